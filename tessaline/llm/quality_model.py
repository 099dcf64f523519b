"""Quality classifier: random-indexing word vectors pooled per document, under a two-layer numpy network."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_size, in_arrow, labelled, remainder, slices, table

#: Labelled documents for the network, at most.
SAMPLE_ROWS = 12_000
#: Words have WORDS hashed names, written forms the rest of BUCKETS, each with a random index vector of NONZERO signs in WIDTH
#: places. The bound holds whatever the vocabulary: a name stands for the mean context of the words that share it.
BUCKETS, WORDS, WIDTH, NONZERO = 1 << 14, 3 << 12, 32, 2
HIDDEN, EPOCHS, RATE, BATCH, DECAY = 24, 40, 0.01, 64, 1e-4
GOOD_SCORE = 0.7
_AGAIN, _SEEN = 0, 1  # forms of a word equal to the one before, and of a pair of words seen before in the text
_EDGES = ".,;:!?*#$%&|\"'()"
#: By byte: how a word is written there: A for capitals, a for other letters and all bytes beyond ASCII, 9 for digits, else itself.
_KINDS = np.arange(256, dtype=np.uint8)
_KINDS[[*range(97, 123), *range(128, 256)]], _KINDS[65:91], _KINDS[48:58] = ord("a"), ord("A"), ord("9")


def hashed(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte strings that lie one after another in data."""
    place = np.arange(len(data), dtype=np.uint64) - np.repeat(starts, sizes).astype(np.uint64)
    mixed = (data.astype(np.uint64) + np.uint64(1)) * (place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03) | np.uint64(1))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    total = np.concatenate([[np.uint64(0)], np.cumsum(mixed, dtype=np.uint64)])
    out = total[starts + sizes] - total[starts]
    return out ^ (out >> np.uint64(32))


def bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings, one after another, and each string's size."""
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.frombuffer(words.buffers()[1], dtype=np.int64 if pa.types.is_large_string(words.type) else np.int32)[words.offset : words.offset + len(words) + 1]
    return np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]], sizes


def names_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The names of distinct words, lower-cased without marks at their edges, and of their forms: kinds of bytes, runs once."""
    data, sizes = bytes_of(pc.utf8_trim(pc.utf8_lower(words), _EDGES))
    word = hashed(data, np.cumsum(sizes) - sizes, sizes) % np.uint64(WORDS - 2) + np.uint64(2)
    data, sizes = bytes_of(words)
    kinds, starts = _KINDS[data], np.cumsum(sizes) - sizes
    opens = np.zeros(len(kinds), dtype=bool)
    opens[starts[sizes > 0]] = True
    opens[1:] |= kinds[1:] != kinds[:-1]
    so_far = np.concatenate([[0], np.cumsum(opens)])
    kept = so_far[starts + sizes] - so_far[starts]
    form = hashed(kinds[opens], np.cumsum(kept) - kept, kept) % np.uint64(BUCKETS - WORDS) + np.uint64(WORDS)
    return word.astype(np.int64), form.astype(np.int64)


def named(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word of the texts, in order: the text's place, the word's name and its form's."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    parts = lists.flatten().dictionary_encode()
    names, forms = names_of(parts.dictionary)
    codes, text = parts.indices.to_numpy(zero_copy_only=False), np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    empty = pc.index(parts.dictionary, "").as_py()
    if empty >= 0:  # white space at the edges of a text
        real = codes != empty
        codes, text = codes[real], text[real]
    word, shape = names[codes], forms[codes]
    if len(codes) > 1:
        same = np.unique(names * BUCKETS + forms, return_inverse=True)[1][codes].astype(np.int64)
        inside, kinds = text[1:] == text[:-1], len(names)
        pair = (text[1:] * kinds + same[:-1]) * kinds + same[1:]
        seen = pd.Series(pair).duplicated().to_numpy()
        shape[1:][seen & inside] = _SEEN
        shape[1:][(same[1:] == same[:-1]) & inside] = _AGAIN
    return text, word, shape


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each name's sparse random vector."""
    draw = np.random.default_rng(11)
    return draw.integers(0, WIDTH, (BUCKETS, NONZERO)), draw.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def contexts(docs: DataFrame) -> DataFrame:
    """(name, c0, c1, ...): over all texts, the sum of the index vectors of each name's neighbours.

    A word's neighbours are the form before it and its own form, a form's the word it belongs to and the next word. Each task
    sends one row per name that it saw, at most BUCKETS, whatever it read; names are summed by partial aggregation.
    """
    schema = pa.schema([("name", pa.int64()), *((f"c{k}", pa.float64()) for k in range(WIDTH))])

    def run(batches):
        places, signs = index_vectors()
        total = np.zeros(BUCKETS * WIDTH)
        for batch in slices(batches):
            for texts in by_size(batch.column(0), 1 << 22):
                text, word, shape = named(texts)
                inside = text[1:] == text[:-1]
                left, right = np.concatenate([word, shape[:-1][inside]]), np.concatenate([shape, word[1:][inside]])
                for a, b in ((left, right), (right, left)):
                    for k in range(NONZERO):
                        total += np.bincount(a * WIDTH + places[b, k], weights=signs[b, k], minlength=BUCKETS * WIDTH)
        cells = total.reshape(BUCKETS, WIDTH)
        used = np.flatnonzero(cells.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(cells[used, k]) for k in range(WIDTH))], schema=schema)

    partial = in_arrow(docs.select(F.col("text").cast("string").alias("text")), run, "name long, " + ", ".join(f"c{k} double" for k in range(WIDTH)))
    return partial.groupBy("name").agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(WIDTH)))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors by name; BUCKETS * WIDTH numbers reach the driver, whatever the corpus."""
    cells = np.zeros((BUCKETS, WIDTH))
    found = contexts(docs).toArrow()
    if found.num_rows:
        cells[found.column(0).to_numpy()] = np.stack([found.column(k + 1).to_numpy() for k in range(WIDTH)], axis=1)
    return (cells / np.maximum(np.linalg.norm(cells, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: pa.Array, squared: np.ndarray) -> np.ndarray:
    """By text: mean and spread of its vectors, the shares of repeated names, and its length's logarithm; zeros without words.

    squared holds the vectors and, beside them, their squares.
    """
    out = np.zeros((len(texts), 2 * WIDTH + 3))
    text, word, shape = named(texts)
    if len(text):
        starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        own, n = text[starts], np.diff(np.append(starts, len(text)))[:, None]
        both = np.stack([word, shape], axis=1).ravel()
        mean = np.array([squared.take(both[2 * a : 2 * b], axis=0).sum(axis=0) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(text)])]) / (2 * n)
        out[own, :WIDTH] = mean[:, :WIDTH]
        out[own, WIDTH : 2 * WIDTH] = np.sqrt(np.maximum(mean[:, WIDTH:] - mean[:, :WIDTH] ** 2, 0))
        for k, mark in enumerate((_AGAIN, _SEEN)):
            out[own, 2 * WIDTH + k] = np.add.reduceat((shape == mark).astype(np.float64), starts) / n[:, 0]
        out[own, 2 * WIDTH + 2] = np.log1p(n[:, 0]) / 8
    return out


class Network:
    """Pooled vectors, a tanh layer, a logistic output, and a temperature fitted on held-back rows."""

    def __init__(self, rows: np.ndarray, good: np.ndarray, seed: int = 3):
        draw = np.random.default_rng(seed)
        order = draw.permutation(len(rows))
        cut = max(1, len(order) // 8)
        held, train = order[:cut], order[cut:] if len(order) > 1 else order
        self.middle, self.scale = rows[train].mean(axis=0), rows[train].std(axis=0) + 1e-3
        x, y = (rows - self.middle) / self.scale, good.astype(np.float64)
        weight = np.where(y > 0.5, 0.5 / max(1e-3, y[train].mean()), 0.5 / max(1e-3, 1 - y[train].mean()))
        weight = np.sqrt(weight)
        self.w1, self.b1 = draw.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN)
        self.w2, self.b2, self.heat = draw.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1), 1.0
        parts = [self.w1, self.b1, self.w2, self.b2]
        moment, second, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
        for _ in range(EPOCHS):
            shuffled = draw.permutation(train)
            for at in range(0, len(shuffled), BATCH):
                k = shuffled[at : at + BATCH]
                hidden = np.tanh(x[k] @ self.w1 + self.b1)
                error = (sigmoid(hidden @ self.w2 + self.b2) - y[k]) * weight[k] / len(k)
                back = np.outer(error, self.w2) * (1 - hidden * hidden)
                slopes = [x[k].T @ back + DECAY * self.w1, back.sum(axis=0), hidden.T @ error + DECAY * self.w2, np.array([error.sum()])]
                step += 1
                for p, g, m, v in zip(parts, slopes, moment, second):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        raw = self.raw(rows[held])
        loss = lambda t: np.logaddexp(0, np.where(good[held], -1, 1) * raw / t).mean()
        self.heat = float(min(np.geomspace(0.3, 8, 50), key=loss))

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.tanh((rows - self.middle) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(rows) / self.heat)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def pooled_rows(docs: DataFrame, vectors: np.ndarray, network: Network | None, carry: str | None = None) -> DataFrame:
    """doc_id and score for each row, or doc_id, pooled and carry."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))  # BUCKETS * WIDTH numbers and the network
    schema = pa.schema([("doc_id", pa.int64()), *([("pooled", pa.list_(pa.float64())), (carry, pa.int64())] if carry else [("score", pa.float64())])])

    def run(batches):
        own, net = shared.value
        squared = np.concatenate([own, own * own], axis=1)
        for batch in slices(batches):
            rows = np.concatenate([pooled(texts, squared) for texts in by_size(batch.column(1))])
            rest = [pa.array(list(rows), type=schema.field(1).type), batch.column(2)] if carry else [pa.array(net.scores(rows) if net else np.full(len(rows), 0.5))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *rest], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([F.col(carry).cast("long").alias(carry)] if carry else []))
    return in_arrow(rows, run, "doc_id long, " + (f"pooled array<double>, {carry} long" if carry else "score double"))


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, learn) -> Network | None:
    """A network of a bounded sample of the labelled documents where `learn` holds (see labelled); None without both labels."""
    sample = labelled(docs, labels, "quality", learn, SAMPLE_ROWS, 9)
    found = sorted(pooled_rows(sample, vectors, None, "quality").collect())  # SAMPLE_ROWS rows, by doc_id
    good = np.array([r["quality"] == 1 for r in found], dtype=bool)
    return Network(np.array([r["pooled"] for r in found]), good) if len(found) and good.any() and not good.all() else None


def score(docs: DataFrame, vectors: np.ndarray, network: Network | None) -> DataFrame:
    """doc_id and score (calibrated probability of label 1) for each row.

    Whole texts are pooled; null and empty ones pool to zeros and are scored so. Without a network every score is 0.5.
    Repeated rows are scored each; an empty table gives no rows; other columns are ignored.
    """
    return pooled_rows(docs, vectors, network)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learnt from labels whose remainder isn't 2; word vectors come from all texts."""
    docs = table(spark, sf_dir, "documents")
    vectors = word_vectors(docs)
    network = train(docs, table(spark, sf_dir, "labels"), vectors, remainder("doc_id", 4) != 2)
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return score(docs, vectors, network).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= GOOD_SCORE).cast("int").alias("predicted"))
