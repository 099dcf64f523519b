"""Secret scans: fixed patterns, and a battery of randomness tests for what they miss. DataFrame operations only."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# The base patterns, in the order in which kinds are listed; the group whose length counts, and the least length.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": (ASSIGN, 2, 6), "access": (r"AKIA[A-Z0-9]+", 0, 20), "hex": (r"[0-9a-f]{24,}", 0, 24)}

#: Runs of these characters are tested; shorter ones can't be told from words.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
# Fixed values, by number of symbols: the symbols of each encoding (one case is written small), the share of neighbours of different
# classes (small, large, digit, sign) in even use, and what ordinary text has where the corpus shows little of it: chi-squared excess
# per character and share of neighbours of different classes.
ENCODINGS = {
    16: ("0123456789abcdef", 0.46875, 2.0, 0.1),
    26: (_LOWER, 0.0, 0.7, 0.0),
    32: (_LOWER + "234567", 0.3047, 1.1, 0.1),
    36: (_LOWER + "0123456789", 0.4012, 1.4, 0.1),
    52: (_LOWER.upper() + _LOWER, 0.5, 1.6, 0.3),
    62: (_LOWER.upper() + _LOWER + "0123456789", 0.6223, 2.1, 0.3),
    64: (_LOWER.upper() + _LOWER + "0123456789+/", 0.6445, 2.5, 0.3),
}
#: Characters of the ordinary runs that each length class (floor of log2) is held against, each twice those before; longer classes
#: share the last.
LENGTHS = {4: 24, 5: 48, 6: 96}
#: Letters of ordinary words, by place: 0 is a word's border. Streams of words that the letters' counts make, and characters of each.
LETTERS = "/" + _LOWER + _LOWER.upper() + "0123456789"
STREAMS, STREAM_CHARS = 500, 1000
#: Weight, in runs, of the fixed values; ordinary text changes class at least this often where an encoding has several.
FIT_PRIOR, LEAST_CHANGES = 50, 0.1
#: Expected share of false findings among those of a length class.
FALSE_SHARE = 0.05
#: Scores are counted in bins of 1 / GRAIN deviations.
GRAIN = 16
FOUND = "array<struct<start:int,finish:int,rank:int,kind:string,own:string>>"


def running(numbers: Column, join) -> Column:
    """join() of all elements up to each one, by doubling steps: an array that grows element by element is copied each time."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(1)).cast("double"))).cast("int"))
    step = lambda k: F.pow(F.lit(2), k).cast("int")
    return F.aggregate(rounds, numbers, lambda acc, k: F.transform(acc, lambda v, i: F.when(i >= step(k), join(v, F.get(acc, i - step(k)))).otherwise(v)))


def located(text: Column, pattern: str, group: int, least: int, guard: Column, rank: int, kind: str) -> Column:
    """Leftmost non-overlapping matches with their offsets in code points, where the group has `least` characters or more.

    Structs of start, finish, rank, kind and own, the match. What split() leaves between matches and the matches themselves
    alternate, so running lengths give the offsets.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    parts = F.arrays_zip(matches.alias("own"), F.transform(values, F.char_length).alias("long"))
    ends = running(F.zip_with(gaps, matches, lambda g, m: F.char_length(g) + F.char_length(m)), lambda a, b: a + b)
    placed = F.zip_with(
        parts,
        ends,
        lambda p, e: F.struct(
            (e - F.char_length(p["own"])).alias("start"), e.alias("finish"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), p["own"].alias("own"), p["long"].alias("long")
        ),
    )
    kept = F.transform(F.filter(placed, lambda s: s["long"] >= least), lambda s: F.struct(s["start"], s["finish"], s["rank"], s["kind"], s["own"]))
    return F.when(guard, kept).otherwise(F.array().cast(FOUND))


def bare(found: Column) -> Column:
    """Spans without their matches."""
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["finish"].alias("finish"), s["rank"].alias("rank"), s["kind"].alias("kind")))


def base_spans(text: Column) -> Column:
    """All base spans, by start and then kind as listed."""
    guards = {"assign": (F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))), "access": F.contains(text, F.lit("AKIA")), "hex": F.lit(True)}
    found = [located(text, pattern, group, least, guards[kind] & text.rlike(pattern), rank, kind) for rank, (kind, (pattern, group, least)) in enumerate(BASE.items())]
    return F.array_sort(F.concat(*map(bare, found)))


def battery(token: Column) -> Column:
    """size (symbols of the inferred encoding) and shown (the token as its symbols are written there), for measured().

    The encoding is the smallest alphabet made of the classes of characters that the token uses. Numbers have size 0.
    """
    body = F.rtrim(token, F.lit("="))
    cased = [("^[0-9]+$", 0), ("^([0-9a-f]+|[0-9A-F]+)$", 16), ("^([a-z]+|[A-Z]+)$", 26), ("^[A-Z2-7]+$", 32), ("^([a-z0-9]+|[A-Z0-9]+)$", 36), ("^[A-Za-z]+$", 52), ("^[A-Za-z0-9]+$", 62)]
    size = F.lit(64)
    for pattern, n in reversed(cased):
        size = F.when(body.rlike(pattern), n).otherwise(size)
    return F.struct(size.alias("size"), F.when(size <= 36, F.lower(body)).otherwise(F.translate(body, "-_=", "+//")).alias("shown"))


def measured(size: Column, shown: Column) -> Column:
    """n and the three statistics: chi-squared excess over even use of symbols per character, share of neighbours of different
    classes (runs of a class), lag-1 serial correlation of the symbols' places.
    """
    alphabet = F.lit("")
    for own, (symbols, *_) in ENCODINGS.items():
        alphabet = F.when(size == own, symbols).otherwise(alphabet)
    signs = F.filter(F.split(shown, "", -1), lambda c: c != "")
    runs = F.size(F.regexp_extract_all(shown, F.lit("[a-z]+|[A-Z]+|[0-9]+|[+/]+"), F.lit(0)))
    own = F.struct(size.alias("size"), shown.alias("shown"), F.array_distinct(signs).alias("used"), F.transform(signs, lambda c: F.instr(alphabet, c)).alias("codes"), (runs - 1).alias("changes"))

    def tests(own):
        size, codes, changes = own["size"].cast("double"), own["codes"], own["changes"]
        n = F.size(codes).cast("double")
        squares = F.aggregate(own["used"], F.lit(0.0), lambda acc, c: acc + F.pow(n - F.char_length(F.replace(own["shown"], c, F.lit(""))), F.lit(2.0)))
        neighbours = lambda x: F.zip_with(F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0))), F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        sums = F.aggregate(codes, F.lit(0.0), lambda acc, c: acc + c)
        products = F.aggregate(neighbours(codes), F.lit(0.0), lambda acc, p: acc + p["a"] * p["b"])
        mean, ends = sums / n, F.get(codes, F.lit(0)) + F.get(codes, F.size(codes) - 1)
        spread = F.aggregate(codes, F.lit(0.0), lambda acc, c: acc + c * c) - sums * mean
        joint = products - mean * (2 * sums - ends) + (n - 1) * mean * mean
        return F.struct(
            n.alias("n"), (squares * size / (n * n) - 1 - (size - 1) / n).alias("even"), (changes / F.greatest(n - 1, F.lit(1.0))).alias("changes"), F.when(spread > 1e-9, joint / spread).otherwise(1.0).alias("serial")
        )

    return F.get(F.transform(F.array(own), tests), F.lit(0))


def letter_counts(texts: DataFrame) -> DataFrame:
    """(three, long, n): how often letters follow each other in the words of all texts, a / standing for each border of a word; long is
    the length of the words that end there, else 0.

    Words have fewer than 20 characters. A word counts once by text that has it, and copies of a text count once.
    """
    words = F.regexp_extract_all(F.col("own_text"), F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9]{1,19}(?![A-Za-z0-9+/_=-])"), F.lit(0))
    known = texts.select(F.array_distinct(words).alias("words")).distinct().select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    places = F.explode(F.sequence(F.lit(1), F.char_length("word") + 1))
    step = known.select(F.concat(F.lit("//"), "word", F.lit("/")).alias("whole"), places.alias("at"), "n")
    long = F.when(F.col("at") == F.char_length("whole") - 2, F.col("at") - 1).otherwise(0)
    return step.select(F.col("whole").substr(F.col("at"), F.lit(3)).alias("three"), long.alias("long"), "n").groupBy("three", "long").agg(F.sum("n").alias("n"))


def ordinary_streams(counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """STREAMS rows of STREAM_CHARS places in LETTERS: words in a row, by the counts of each letter after two others and of lengths."""
    size = len(LETTERS)
    upto = np.cumsum(counts.reshape(size * size, size)[:, 1:], axis=1)
    longest = np.cumsum(lengths)
    draw = np.random.default_rng(11)
    out = np.zeros((STREAMS, STREAM_CHARS), dtype=np.int64)
    a = b = left = np.zeros(STREAMS, dtype=np.int64)
    for k in range(STREAM_CHARS):
        left = np.where(b == 0, np.searchsorted(longest, draw.random(STREAMS) * longest[-1], side="right"), left) - 1
        own = upto[a * size + b]
        c = 1 + (own <= (draw.random(STREAMS) * own[:, -1])[:, None]).sum(axis=1)
        c[(left < 0) | (own[:, -1] == 0)] = 0  # the word is long enough, or none goes on like this
        a, b = np.where(c == 0, 0, b), c
        out[:, k] = c
    return out


def ordinary_runs(streams: np.ndarray) -> dict[int, list[np.ndarray]]:
    """By size: for each stream of words the symbols (places from 0) of an ordinary run of that encoding.

    Signs stand between words where an encoding has them, capitals begin them where it has two cases; what the encoding lacks is
    dropped.
    """
    signs = np.array([*LETTERS])
    out = {size: [] for size in ENCODINGS}
    place = {size: {c: k for k, c in enumerate(symbols)} for size, (symbols, *_) in ENCODINGS.items()}
    for row in streams:
        whole = "".join(signs[row]).strip("/")
        named = "".join(w[:1].upper() + w[1:].lower() for w in whole.split("/"))
        for size, shown in ((16, named.lower()), (26, named.lower()), (32, named.lower()), (36, named.lower()), (52, named), (62, named), (64, whole)):
            out[size].append(np.array([place[size][c] for c in shown if c in place[size]], dtype=np.int64))
    return out


def run_statistics(size: int, runs: np.ndarray) -> np.ndarray:
    """even, changes and serial, as measured() has them, for each row of symbols (places from 0)."""
    n = runs.shape[1]
    kinds = np.array([1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4 for c in ENCODINGS[size][0]])[runs]
    counts = np.zeros((len(runs), size))
    np.add.at(counts, (np.arange(len(runs))[:, None], runs), 1)
    centred = runs - runs.mean(axis=1, keepdims=True)
    spread = (centred**2).sum(axis=1)
    joint = (centred[:, 1:] * centred[:, :-1]).sum(axis=1)
    serial = np.where(spread > 1e-9, joint / np.maximum(spread, 1e-9), 1.0)
    return np.stack([(counts**2).sum(axis=1) * size / n**2 - 1 - (size - 1) / n, (kinds[:, 1:] != kinds[:, :-1]).mean(axis=1), serial])


def ordinary_moments(texts: DataFrame) -> dict[tuple[int, int], dict[str, float]]:
    """By size and length: mean and variance (v) of each test in ordinary text, their covariances (c and two places), and k, the
    number of runs that the counted letters are enough for.

    Letters and lengths of words are counted over all texts; the moments are those of the words that these counts make, by a fixed number of streams.
    """
    size = len(LETTERS)
    counts, lengths = np.zeros((size,) * 3, dtype=np.int64), np.zeros(20, dtype=np.int64)
    place = {c: k for k, c in enumerate(LETTERS)}
    for r in letter_counts(texts).collect():  # at most len(LETTERS) ** 3 rows, and 20 times its square
        counts[tuple(place[c] for c in r["three"])] += r["n"]
        lengths[r["long"]] += r["n"] if r["long"] else 0
    if not counts.any():
        return {}
    single = counts.sum(axis=(0, 1))
    out = {}
    for size, rows in ordinary_runs(ordinary_streams(counts, lengths)).items():
        cased = ENCODINGS[size][0] + ENCODINGS[size][0].upper() + ENCODINGS[size][0].lower()
        letters = sum(int(single[k]) for k, c in enumerate(LETTERS) if c in cased)
        for n in LENGTHS.values():
            runs = [row[: len(row) // n * n].reshape(-1, n) for row in rows]
            if letters < n or not any(map(len, runs)):
                continue
            tests = run_statistics(size, np.concatenate(runs))
            both = np.cov(tests, bias=True)
            names = ("even", "changes", "serial")
            own = {"k": letters // n} | dict(zip(names, tests.mean(axis=1).tolist())) | {f"v{c}": float(both[i, i]) for i, c in enumerate(names)}
            out[size, n] = own | {f"c{i}{j}": float(both[i, j]) for i in range(3) for j in range(i + 1, 3)}
    return out


def fitted(texts: DataFrame) -> dict[tuple[int, int], tuple[float, float, float, float]]:
    """By size and length class: c0 to c3, by which c0 + c1 even + c2 changes + c3 serial is the normal score of ordinary text.

    Each test's mean and deviation are those of ordinary runs, by the letters of all texts; Stouffer's sum weighs a test by how far even use of the
    symbols lies from ordinary text, so random tokens score low, and is scaled by the tests' correlations.
    """
    names = ("even", "changes", "serial")
    pairs = [(i, j) for i in range(3) for j in range(i + 1, 3)]
    known = ordinary_moments(texts)
    out = {}
    for size, (_, even_changes, far, rate) in ENCODINGS.items():
        for step, n in LENGTHS.items():
            r = known.get((size, n))
            share = r["k"] / (r["k"] + FIT_PRIOR) if r else 0.0
            usual = [far, rate, 0.0]
            spread = [(2 * (size - 1) + 4 * n * far) / n**2, max(rate * (1 - rate) / (n - 1), 1e-6), 1 / n]
            mean = [share * (r[c] if r else 0.0) + (1 - share) * usual[i] for i, c in enumerate(names)]
            between = [share * (1 - share) * ((r[c] if r else 0.0) - usual[i]) ** 2 for i, c in enumerate(names)]
            var = [share * (r[f"v{c}"] if r else 0.0) + (1 - share) * spread[i] + between[i] for i, c in enumerate(names)]
            if even_changes:
                mean[1] = max(mean[1], LEAST_CHANGES)
                var[1] = max(var[1], mean[1] * (1 - mean[1]) / (n - 1))
            dev = [math.sqrt(v) for v in var]
            weight = [(mean[0]) / dev[0], (even_changes - mean[1]) / dev[1] if even_changes else 0.0, (mean[2] + 1 / n) / dev[2]]
            weight[1] = -max(weight[1], 0.0)  # ordinary text never counts for changing too often
            square = sum(w * w for w in weight) + 2 * sum(weight[i] * weight[j] * share * (r[f"c{i}{j}"] if r else 0.0) / (dev[i] * dev[j]) for i, j in pairs)
            norm = math.sqrt(max(square, 1e-9))
            c = [w / d / norm for w, d in zip(weight, dev)]
            out[size, step] = (-sum(x * m for x, m in zip(c, mean)), *c)
    return out


def scored(tested: Column, fit: dict) -> Column:
    """The score of a battery()'s struct: length class and z, the normal score under ordinary text, low for random tokens."""
    factors = F.expr("map(" + ", ".join(f"{size * 100 + step}, array({', '.join(f'{x!r}D' for x in c)})" for (size, step), c in sorted(fit.items())) + ")")

    def score(x):
        n, size = x["m"]["n"], x["size"]
        long = F.floor(F.log2(F.greatest(n, F.lit(1.0)))).cast("int")
        own = F.least(F.greatest(long, F.lit(min(LENGTHS))), F.lit(max(LENGTHS)))
        c = F.try_element_at(factors, size * 100 + own)
        n_fit = F.element_at(F.create_map(*(F.lit(v) for kv in LENGTHS.items() for v in kv)), own)
        z = (c[0] + c[1] * x["m"]["even"] + c[2] * x["m"]["changes"] + c[3] * x["m"]["serial"]) * F.sqrt(F.least(n, F.lit(float(max(LENGTHS.values())))) / n_fit)
        z = F.when((n < 8) | (size == 0), 0.0).otherwise(F.coalesce(z, F.lit(0.0)))
        return F.struct((size * 100 + long).cast("int").alias("family"), F.floor(F.greatest(F.least(z, F.lit(0.0)), F.lit(-38.0)) * GRAIN).cast("int").alias("bin"))

    both = F.struct(tested["size"].alias("size"), measured(tested["size"], tested["shown"]).alias("m"))
    return F.get(F.transform(F.array(both), score), F.lit(0))


def candidates(text: Column) -> Column:
    """Runs of CANDIDATE characters."""
    return located(text, CANDIDATE, 0, 20, text.rlike(CANDIDATE), len(BASE), "random")


def merged(found: Column, base: Column) -> Column:
    """Candidates and base spans in one array, by start."""
    nothing = F.lit(None).cast("string")
    spans = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["finish"].alias("finish"), s["rank"].alias("rank"), s["kind"].alias("kind"), nothing.alias("own")))
    return F.array_sort(F.concat(found, spans))


def clear_of_base(every: Column) -> Column:
    """The candidates of merged() that overlap no base span.

    The farthest base finish before a candidate, and the nearest base start after it, decide; both are running extremes.
    """
    is_base = lambda s: s["rank"] < len(BASE)
    far = running(F.transform(every, lambda s: F.when(is_base(s), s["finish"]).otherwise(0)), F.greatest)
    near = F.reverse(running(F.reverse(F.transform(every, lambda s: F.when(is_base(s), s["start"]).otherwise(2147483647))), F.least))
    sides = F.zip_with(far, near, lambda a, b: F.struct(a.alias("far"), b.alias("near")))
    beside = F.zip_with(every, sides, lambda s, e: F.struct(s.alias("span"), (~is_base(s) & (e["far"] <= s["start"]) & (e["near"] >= s["finish"])).alias("clear")))
    return F.transform(F.filter(beside, lambda x: x["clear"]), lambda x: x["span"])


def with_scores(docs: DataFrame, fit: dict) -> DataFrame:
    """docs (own_text) with base (spans) and tests: the candidates, with their length class and score bin."""
    text = F.col("own_text")
    step = docs.withColumn("base", base_spans(text))
    step = step.withColumn("tests", candidates(text))
    step = step.withColumn("tests", F.when(F.size("tests") > 0, merged(F.col("tests"), F.col("base"))).otherwise(F.col("tests")))
    step = step.withColumn("tests", F.when(F.size("tests") > 0, clear_of_base(F.col("tests"))).otherwise(F.col("tests")))
    step = step.withColumn("tests", F.transform("tests", lambda c: F.struct(F.struct(*(c[f].alias(f) for f in ("start", "finish", "rank", "kind"))).alias("span"), battery(c["own"]).alias("battery"))))
    return step.withColumn("tests", F.transform("tests", lambda c: F.struct(c["span"].alias("span"), scored(c["battery"], fit).alias("score"))))


def normal_tail(z: Column) -> Column:
    """The share of a normal distribution below z, for z <= 0."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series


def thresholds(scores: DataFrame, false_share: float) -> DataFrame:
    """(family, bin): for each length class the largest score bin that the step-up rule accepts, from counts of bins."""
    from pyspark.sql import Window

    counts = scores.groupBy("family", "bin").agg(F.count("*").alias("n"))
    own = Window.partitionBy("family")
    upto = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.select("family", "bin", F.sum("n").over(upto).alias("rank"), F.sum("n").over(own).alias("all"))
    p = normal_tail((F.col("bin") + 1) / GRAIN)
    return ranked.where(p <= false_share * F.col("rank") / F.col("all")).groupBy("family").agg(F.max("bin").alias("bin"))


def find_secrets(docs: DataFrame, text: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """docs with the column spans: array of (start, finish, rank, kind), by start and then kind (assign, access, hex, random).

    Offsets count code points; finish is exclusive. The letters of all texts' words show what ordinary
    runs look like. A second pass counts the scores of all candidates by length class, which gives each class its threshold at a
    false-discovery share of `false_share`; a third applies them in each row. Only counts of letters after two others, and the
    thresholds, one row per length class, come to the driver. The distinct words of each text, and counts, are shuffled.

    Null and empty texts have no spans. Each row is judged on its own, so repeated rows and ids get equal spans; an empty
    table gives no rows; all columns stay, and an own column named spans is replaced.
    """
    own = docs.drop("spans").withColumn("own_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    fit = fitted(own.select("own_text"))
    # explode() would add a filter on the array, for which the optimiser repeats the whole expression; explode_outer() doesn't
    scores = with_scores(own.select("own_text"), fit).select(F.explode_outer("tests").alias("t")).where("t is not null").select("t.score.*")
    accepted = {r["family"]: r["bin"] for r in thresholds(scores, false_share).collect()}
    found = with_scores(own, fit)
    if accepted:
        cases = " ".join(f"WHEN {family} THEN c.score.bin <= {most}" for family, most in sorted(accepted.items()))
        random = F.expr(f"transform(filter(tests, c -> CASE c.score.family {cases} ELSE false END), c -> c.span)")
        spans = F.array_sort(F.concat("base", random))
    else:
        spans = F.col("base")
    return found.withColumn("spans", spans).drop("own_text", "base", "tests")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch that spans cover replaced by mark; overlapping spans are one stretch."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    steps = F.aggregate(
        spans,
        state,
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["finish"]).alias("at"),
        ),
    )
    rest = F.when(F.size(spans) == 0, text).otherwise(F.concat(steps["out"], F.substring(text, steps["at"] + 1, F.char_length(text))))
    return F.when(text.isNotNull(), rest)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["finish"].cast("string"))), ",")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with base counts and all spans."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    counts = [F.size(F.expr(f"filter(spans, s -> s.kind = '{kind}')")).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
