"""Toxicity: obfuscated words are restored by Viterbi decoding under a character language model, then texts are scored."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bits, in_arrow, labelled, map_arrow, materialise, ranked, remainder, scratch, slices, table

#: A feature is used when so many different labelled toxic texts, and a hundredth of them besides, have it, and its log
#: odds are at least so large.
LEAST_TEXTS, LEAST_ODDS = 3, 3.0
#: Passes over the labelled texts at most, steps remembered, share of the first gradient at which learning ends, and decay of weights.
PASSES, MEMORY, SETTLED, DECAY = 40, 8, 1e-4, 1e-3
#: Losses and gradients are summed in steps of 1 / LOSS_GRAIN, as whole numbers, so that the order of texts makes no difference.
LOSS_GRAIN = 1 << 26
#: Tokens whose features a worker remembers before it starts anew, and features that it counts before it hands them over.
TOKENS_READ, FEATURES_COUNTED = 30_000, 100_000
#: Distinct tokens whose weight a worker remembers before it starts anew.
TOKENS_KEPT = 250_000

# Letters that a written character may stand for, besides itself, and the cost of each reading in nats.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "%": "x", "*": "aeiou", "#": "h"}
READ_COST, DROP_COST, EDGE_COST, REPEAT_COST = 0.5, 0.3, 6.0, 0.1
#: Characters whose trigrams a worker holds at a time; the next ones carry on from them, so it makes no difference to any count.
PART_CHARS = 1 << 20
SEPARATORS = "._-*'~=/\\"
#: Letters of the language model, by place: 0 bounds words, LETTERS follow, the last stands for any other letter.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
SIZE = len(LETTERS) + 2
_PLACE = {c: k + 1 for k, c in enumerate(LETTERS)}
_SPACED = re.compile(r"(?<!\S)\S(?:\s{1,3}\S){2,}(?!\S)")
_WORD = re.compile(r"[^\W\d_]+")
_REPEATED = re.compile(r"([^\W\d_])\1\1")
_HIDDEN = re.compile(
    r"[^\W\d_][0-9@$!|+(<€£%*#._\-'~=/\\]+[^\W\d_]"  # signs between letters
    r"|(?<!\S)[0-9@$!|+€£]{1,3}[^\W\d_]"  # ahead of them
    r"|[^\W\d_][0-9@$|+€£]{1,3}[^\w\s]*(?!\S)"  # behind them
)


@lru_cache(maxsize=1)
def places() -> np.ndarray:
    """By code point: the place of its lower-case letter in the language model, 0 for what isn't a letter."""
    out = np.zeros(0x110000, dtype=np.int32)
    for k in range(0x110000):
        c = chr(k)
        if c.isalpha():
            out[k] = _PLACE.get(c.lower(), SIZE - 1)
    return out


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Codes of a text's character trigrams over words bounded by one place, part by part."""
    by_code, carry = places(), np.zeros(1, dtype=np.int32)
    for at in range(0, max(len(text), 1), PART_CHARS):
        part = by_code[np.frombuffer(text[at : at + PART_CHARS].encode("utf-32-le", "replace"), dtype=np.uint32)]
        own = np.concatenate([carry, part, [0] if at + PART_CHARS >= len(text) else []]).astype(np.int64)
        own = own[np.concatenate([[True], (own[1:] > 0) | (own[:-1] > 0)])]
        carry = own[-2:]
        if len(own) > 2:
            yield (own[:-2] * SIZE + own[1:-1]) * SIZE + own[2:]


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(code, n): character trigrams of all texts, over words bounded by one place; at most SIZE ** 3 codes, summed by code."""

    def run(batches):
        total = np.zeros(SIZE**3, dtype=np.int64)
        for batch in slices(batches, 256):
            for text in batch.column(0).to_pylist():
                for codes in trigrams(text or ""):
                    if len(codes) < 50_000:
                        np.add.at(total, codes, 1)
                    else:
                        total += np.bincount(codes, minlength=SIZE**3)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"code": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    rows = docs.select(F.col("text").cast("string").alias("text"))
    return in_arrow(rows, run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


class Channel:
    """A character trigram model and the lattice of what written characters may stand for."""

    def __init__(self, counts: np.ndarray):
        cube = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
        one = cube.sum(axis=(0, 1)) + 0.5
        two = cube.sum(axis=0)
        low = one / one.sum()
        mid = (two + 20 * low) / (two.sum(axis=1, keepdims=True) + 20)
        self.cost = -np.log((cube + 10 * mid[None]) / (cube.sum(axis=2, keepdims=True) + 10)).astype(np.float32)

    @staticmethod
    def lattice(token: str) -> list[list[tuple[str, float]]]:
        """For each written unit its readings: a letter or letters, with a cost; an empty reading drops it.

        A run of three or more equal letters reads as one or two of them. A gap reads as nothing or as a word's border.
        """
        out, at = [], 0
        while at < len(token):
            c = token[at]
            end = at + 1
            while end < len(token) and token[end] == c:
                end += 1
            inner = 0 < at and end < len(token)
            if c == " ":
                out.append([("", DROP_COST), (" ", 0.0)])
            elif c.isalpha():
                out.append([(c, REPEAT_COST), (c + c, REPEAT_COST)] if end - at > 2 else [(token[at:end], 0.0)])
            else:
                readings = [(x * n, READ_COST) for x in LEET.get(c, "") for n in ({1, min(end - at, 2)})]
                if c in SEPARATORS or not readings:
                    readings.append(("", DROP_COST if inner else 0.0))
                elif not inner:  # marks may stand beside a word; digits seldom do
                    readings.append(("", EDGE_COST if c.isdigit() else 0.0))
                out.append(readings)
            at = end
        return out

    def restore(self, token: str) -> str:
        """The likeliest letters behind a lower-case token, by Viterbi search over the last two letters.

        A token with gaps is a run of letters or pieces of words; the search also decides which gaps are borders of words.
        """
        cost = self.cost
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for readings in self.lattice(token):
            ahead: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (so_far, way) in states.items():
                for letters, price in readings:
                    x, y, total = a, b, so_far + price
                    for c in letters:
                        z = 0 if c == " " else _PLACE.get(c, SIZE - 1)
                        if z or y:  # borders count once
                            total += float(cost[x, y, z])
                            x, y = y, z
                    if (x, y) not in ahead or total < ahead[x, y][0]:
                        ahead[x, y] = (total, (way, letters) if letters else way)
            states = ahead
        way = min((so_far + (float(cost[a, b, 0]) if b else 0.0), k, way) for k, ((a, b), (so_far, way)) in enumerate(states.items()))[2]
        parts = []
        while way:
            way, letters = way
            parts.append(letters)
        return "".join(reversed(parts))


def features(word: str) -> list[str]:
    """A word and its beginnings, which inflections and compounds share."""
    return [f"{word}$", *(word[:n] for n in range(4, min(len(word), 8)))]


class Scorer(dict):
    """By lower-case token: the weight of its words, restored where they are hidden. Texts score by the sum over distinct tokens."""

    def __init__(self, channel: Channel, weights: dict[str, float], bias: float):
        self.channel, self.weights, self.bias = channel, weights, bias
        self.whole = {f[:-1] for f in weights if f.endswith("$")}
        self.heads = {w[:k] for w in self.whole for k in range(1, len(w))}
        self.starts = {f[:4] for f in weights if not f.endswith("$")}

    def __reduce__(self):
        return Scorer, (self.channel, self.weights, self.bias)

    def words(self, token: str) -> list[str]:
        if " " in token:
            return self.channel.restore(token).split()
        if _HIDDEN.search(token) or _REPEATED.search(token):
            whole = self.channel.restore(token)
            return [whole, *(w for w in _WORD.findall(token) if w != whole)]
        return _WORD.findall(token)

    def __missing__(self, token: str) -> float:
        plain = token.isalpha() and not _REPEATED.search(token)
        weighty = (w for w in ([token] if plain else self.words(token)) if w[:4] in self.starts or w in self.whole)
        out = sum(max((self.weights.get(f, 0.0) for f in features(w)), default=0.0) for w in weighty)
        if len(token) <= 40:
            if len(self) >= TOKENS_KEPT:
                self.clear()
            self[token] = out
        return out

    def tokens(self, text: str | None) -> set[str]:
        """Distinct lower-case tokens of a text, and tokens with gaps: runs of three or more letters that stand alone, and
        neighbours that together make a word of weight.
        """
        low = (text or "").lower()
        row = low.split()
        own = set(row)
        own.update(" ".join(x.group().split()) for x in _SPACED.finditer(low))
        if self.whole:
            own.update(f"{a} {b}" for a, b in zip(row, row[1:]) if a in self.heads and a + b in self.whole)
        return own

    def restored(self, text: str) -> str:
        """The text, lower-cased, with hidden words restored."""
        low = _SPACED.sub(lambda x: self.channel.restore(" ".join(x.group().split())), text.lower())
        return re.sub(r"\S+", lambda x: self.channel.restore(x.group()) if _HIDDEN.search(x.group()) or _REPEATED.search(x.group()) else x.group(), low)

    def score(self, text: str | None) -> float:
        total = sum(map(self.__getitem__, self.tokens(text)))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.bias + total))))


def word_features(reader: Scorer, keep) -> Callable[[str], list[tuple[str, ...]]]:
    """By text: for each of its tokens what keep() makes of the token's words; tokens are remembered."""
    known: dict[str, tuple[str, ...]] = {}

    def read(text: str) -> list[tuple[str, ...]]:
        out = []
        for token in reader.tokens(text):
            own = known.get(token)
            if own is None:
                own = keep(reader.words(token))
                if len(known) >= TOKENS_READ:
                    known.clear()
                if len(token) <= 40:
                    known[token] = own
            out.append(own)
        return out

    return read


def feature_counts(sample: DataFrame, channel: Channel) -> DataFrame:
    """(feature, bad, good): in how many toxic and other texts of sample (text, toxic) a feature occurs; texts aren't collected."""
    shared = sample.sparkSession.sparkContext.broadcast(Scorer(channel, {}, 0.0))  # SIZE ** 3 numbers

    def batch_of(bad, good):
        own = sorted(bad.keys() | good.keys())
        columns = [pa.array(own, pa.string()), *(pa.array([n[f] for f in own], pa.int64()) for n in (bad, good))]
        return pa.RecordBatch.from_arrays(columns, names=["feature", "bad", "good"])

    def run(batches):
        read = word_features(shared.value, lambda words: tuple({f for w in words for f in features(w)}))
        bad, good = Counter(), Counter()
        for batch in slices(batches, 64):
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (bad if toxic else good).update(set().union(*read(text)))
            if len(bad) + len(good) > FEATURES_COUNTED:
                yield batch_of(bad, good)
                bad, good = Counter(), Counter()
        yield batch_of(bad, good)

    return in_arrow(sample.select("text", "toxic"), run, "feature string, bad long, good long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def examples(sample: DataFrame, channel: Channel, odds: dict[str, float]) -> DataFrame:
    """(toxic, own, n): the chosen features of texts of sample, as places in their sorted order, and how many texts have just these;
    each word counts by one, that with the largest odds.
    """
    shared = sample.sparkSession.sparkContext.broadcast((Scorer(channel, {}, 0.0), odds))  # the chosen features, frequent ones

    def run(batches):
        reader, chosen = shared.value
        place = {f: k for k, f in enumerate(sorted(chosen))}

        def best(words):  # a word and the place of its feature
            found = ((w, max((f for f in features(w) if f in chosen), key=chosen.get, default=None)) for w in words)
            return tuple((w, place[f]) for w, f in found if f)

        read = word_features(reader, best)
        for batch in slices(batches, 64):
            rows = [sorted(k for _, k in set().union(*read(text))) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.int64()))], names=["toxic", "own"])

    return in_arrow(sample.select("text", "toxic"), run, "toxic long, own array<long>").groupBy("toxic", "own").agg(F.count("*").alias("n"))


def sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """toxic and n by row of examples(), and the row and place of each feature."""
    own = batch.column(1)
    lengths = np.diff(own.offsets.to_numpy()).astype(np.int64)
    return batch.column(0).to_numpy(), batch.column(2).to_numpy(), np.repeat(np.arange(batch.num_rows), lengths), own.flatten().to_numpy()


def totals(weights: np.ndarray, n: int, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.bincount(row, weights=weights[place], minlength=n)


def loss(rows: DataFrame, weights: np.ndarray, bias: float, balance: float) -> tuple[float, np.ndarray]:
    """Logistic loss of all rows of examples(), and its gradient by weight and, last, bias; toxic texts count `balance` times.

    Each text adds its decay for the features that it has.
    """
    d = len(weights)

    def run(batches):
        total = np.zeros(d + 2, dtype=np.int64)  # by weight, the bias, the loss
        for batch in slices(batches):
            if not batch.num_rows:
                continue
            toxic, n, row, place = sparse(batch)
            x = np.clip(bias + totals(weights, len(n), row, place), -50.0, 50.0)
            each = n * np.where(toxic == 1, balance, 1.0)
            error = each * (1 / (1 + np.exp(-x)) - toxic)
            whole = lambda v: np.rint(v * LOSS_GRAIN).astype(np.int64)
            np.add.at(total, place, whole(error)[row] + whole(n[row] * DECAY * weights[place]))
            total[d] += whole(error).sum()
            total[d + 1] += whole(each * np.logaddexp(0.0, np.where(toxic == 1, -x, x))).sum() + whole(n[row] * DECAY / 2 * weights[place] ** 2).sum()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"place": pa.array(at, pa.int64()), "total": pa.array(total[at], pa.int64())})

    out = np.zeros(d + 2)
    for r in in_arrow(rows.select("toxic", "own", "n"), run, "place long, total long").groupBy("place").agg(F.sum("total").alias("total")).collect():  # one row per weight
        out[r["place"]] = r["total"] / LOSS_GRAIN
    return out[d + 1], out[: d + 1]


def descent(loss_of, start: np.ndarray) -> np.ndarray:
    """The least of a convex function by limited-memory quasi-Newton steps; loss_of gives value and gradient. All but the last number
    stay at 0 or more: those at 0 whose gradient would lower them are held there.
    """
    x = start.copy()
    value, slope = loss_of(x)
    steps, passes, first = [], 1, None
    while passes < PASSES:
        free = (x > 0) | (slope < 0)
        free[-1] = True
        down = np.where(free, slope, 0.0)
        size = float(np.abs(down).max())
        first = first or size
        if size <= SETTLED * first:
            break
        q, kept = down.copy(), []
        for s, y in reversed(steps):
            s, y = s * free, y * free
            if s @ y > 1e-12:
                a = (s @ q) / (s @ y)
                q -= a * y
                kept.append((a, s, y))
        q *= (kept[0][1] @ kept[0][2]) / (kept[0][2] @ kept[0][2]) if kept else 1 / np.abs(down).sum()
        for a, s, y in reversed(kept):
            q += (a - (y @ q) / (s @ y)) * s
        way = np.where(free, -q, 0.0)
        rate = 1.0
        while passes < PASSES:
            ahead = x + rate * way
            ahead[:-1] = np.maximum(ahead[:-1], 0.0)
            new_value, new_slope = loss_of(ahead)
            passes += 1
            if new_value <= value + 1e-4 * (slope @ (ahead - x)):
                break
            rate /= 4
        if new_value >= value:
            break
        steps = [*steps, (ahead - x, new_slope - slope)][-MEMORY:]
        x, value, slope = ahead, new_value, new_slope
    return x


def fit(rows: DataFrame, chosen: list[str], channel: Channel) -> Scorer:
    """Logistic regression on all rows of examples(), which stay on the executors; gradients come to the driver."""
    number = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.sum("n").alias("n")).collect()}  # two rows
    n_bad, n_good = number.get(1, 0), number.get(0, 0)
    weights, bias = np.zeros(len(chosen)), -3.0
    if n_bad and n_good:
        balance = math.sqrt(max(1.0, n_good / n_bad))
        weights = descent(lambda x: loss(rows, x[:-1], float(x[-1]), balance), np.append(weights, bias))[:-1]

        def summed():
            return lambda batch: {"toxic": batch.column(0), "bits": bits(totals(weights, batch.num_rows, *sparse(batch)[2:])), "n": batch.column(2)}

        found = map_arrow(rows.select("toxic", "own", "n"), summed, "toxic long, bits long, n long").groupBy("toxic", "bits").agg(F.sum("n").alias("n"))
        found = materialise(found, "totals")

        def quantile(toxic: int, n: int, share: float) -> float:  # as numpy interpolates
            at = (n - 1) * share
            low = math.floor(at)
            a, b = (ranked(found.where(F.col("toxic") == toxic), "bits", k, F.col("n")) for k in (low, min(low + 1, n - 1)))
            return a + (b - a) * (at - low)

        # the even score lies a third of the way from what nearly all clean to what nearly all toxic texts reach
        low, high = quantile(0, n_good, 0.999), quantile(1, n_bad, 0.01)
        bias = -max(1.0, low + (high - low) / 3)
    return Scorer(channel, {f: float(weights[k]) for k, f in enumerate(chosen) if weights[k] > 0.05}, float(bias))


def train(docs: DataFrame, labels: DataFrame, learn) -> Scorer:
    """Trigrams of all docs, and weights from all labelled documents where `learn` holds (see labelled).

    Log odds choose the features, logistic regression weighs them. Copies of a text count once, as toxic if one of them is.
    Whole texts are read on the executors; counts of features that enough toxic texts have, and gradients by chosen feature, come
    to the driver.
    """
    counts = np.zeros(SIZE**3, dtype=np.int64)
    found = trigram_counts(docs).toArrow()  # at most SIZE ** 3 rows
    counts[found["code"].to_numpy()] = found["n"].to_numpy()
    channel = Channel(counts)
    with scratch(docs.sparkSession):
        drawn = labelled(docs, labels, "toxic", learn)
        sample = materialise(drawn.groupBy("text").agg(F.max((F.col("toxic") == 1).cast("long")).alias("toxic")), "sample")
        n_bad, n = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
        known = feature_counts(sample, channel).where(F.col("bad") >= LEAST_TEXTS + n_bad // 100).collect()
        odds = {r["feature"]: math.log(r["bad"] / (n_bad + 1)) - math.log((r["good"] + 1) / (n - n_bad + 1)) for r in known}
        odds = {f: x for f, x in odds.items() if x >= LEAST_ODDS}
        return fit(materialise(examples(sample, channel, odds), "examples"), sorted(odds), channel)


def scored(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id and score (0 to 1, higher for toxic) for each row.

    Whole texts are read; null and empty ones score as texts without any word of weight. Repeated rows are scored each; an
    empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # SIZE ** 3 numbers, and features that a share of toxic texts has
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        own = shared.value
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.score(text) for text in batch.column(1).to_pylist()], pa.float64())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_arrow(rows, run, "doc_id long, score double")


def without_toxic(docs: DataFrame, scorer: Scorer, least: float = 0.5) -> DataFrame:
    """The rows of docs, with all columns, whose score is below `least`.

    Null and empty texts stay; repeated rows share their fate; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    place = docs.columns.index("text")

    def run(batches):
        own = shared.value
        for batch in slices(batches):
            yield batch.filter(pa.array([own.score(text) < least for text in batch.column(place).to_pylist()], pa.bool_()))

    return in_arrow(docs, run, docs.schema)


def unhidden(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """docs with the column restored: each text, lower-cased, with hidden words restored; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    names = [c for c in docs.columns if c != "restored"]
    source = docs.select(*names, F.col("text").cast("string").alias("restored"))

    def run(batches):
        own = shared.value
        for batch in slices(batches):
            texts = [None if t is None else own.restored(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, batch.schema.field(batch.num_columns - 1).type)], schema=batch.schema)

    return in_arrow(source, run, source.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learnt from labels whose remainder isn't 0."""
    docs = table(spark, sf_dir, "documents")
    scorer = train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return scored(docs, scorer).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
