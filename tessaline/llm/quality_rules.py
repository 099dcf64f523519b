"""Quality rules: exact rule statistics of whole texts, and an isolation forest over them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bits, in_arrow, labelled, map_arrow, materialise, ranked, scratch, ship, slices, table

#: Every row grows one tree or more: so many that a tree has SUBSAMPLE rows, where there are so many, or its share of all.
TREES, SUBSAMPLE, REACH = 128, 512, 1.5
#: Share of labelled good rows that the threshold may reject.
GOOD_LOST = 0.005
_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b"!?.,;:"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Shares that the forest sees. Constants in their divisors draw those of short texts, which vary by chance, to the usual.
FEATURES = ["word_length", "symbols", "dup_lines", "repeats", "reused", "upper", "digits", "marks"]


def repeated(words: list[bytes]) -> int:
    """How many words lie in a 5-word window that occurs twice or more, overlapping occurrences included."""
    n = len(words) - 4
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), dtype=np.uint64, count=len(words))
    if len(names) == len(words):
        return 0
    bits = max(1, len(names).bit_length())
    key = ids[:n].copy()
    for k in range(1, 5):  # exact: wherever the next id doesn't fit, the keys so far are renumbered
        if int(key.max()).bit_length() + bits > 63:
            key = np.unique(key, return_inverse=True)[1].astype(np.uint64)
        key = (key << np.uint64(bits)) | ids[k : n + k]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int32)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + 5, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """BASE and FEATURES of a text; a null one is empty."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    space = len(raw) - len(raw.translate(None, _SPACE))
    word_chars = len(text) - space
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACE)]
    dup = len(lines) - len(set(lines))
    rep = repeated(words)
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / (word_chars + 200)
    features = [
        (word_chars + 100) / (n + 20), symbols / (word_chars + 50), dup / (len(lines) + 8), rep / (n + 40), 1 - (len(set(words)) + 40) / (n + 40),
        share(_UPPER), share(_DIGITS), share(_MARKS),
    ]
    return [n, word_chars, symbols, dup, rep], features


class Forest:
    """Isolation trees as arrays: random splits of random features; short paths mark anomalies.

    Cuts may fall outside a node's own range, by up to `reach` of each feature, so that rows unlike any it grew on are split
    off early too.
    """

    def __init__(self, rows: np.ndarray, reach: np.ndarray, seed: int = 5):
        self.clear(len(rows), reach, seed)
        for t in range(TREES):
            self.grow(t, rows[(t - np.arange(len(rows))) % TREES < self.copies])

    def clear(self, n: int, reach: np.ndarray, seed: int = 5) -> Forest:
        """Trees yet to be grown, for n rows, each in `copies` trees that follow each other."""
        self.reach, self.seed = reach, seed
        self.copies = max(1, min(TREES, -(-SUBSAMPLE * TREES // max(n, 1))))
        self.size = round(n * self.copies / TREES)
        self.depth = max(1, int(np.ceil(np.log2(max(2, min(SUBSAMPLE, self.size))))) + 2)
        nodes = 2 ** (self.depth + 1)
        self.feature = np.full((TREES, nodes), -1, dtype=np.int8)
        self.split = np.zeros((TREES, nodes), dtype=np.float64)
        self.path = np.zeros((TREES, nodes), dtype=np.float64)
        return self

    @classmethod
    def over(cls, rows: DataFrame, n: int, reach: np.ndarray) -> Forest:
        """A forest of all n rows (doc_id, features); each tree grows on an executor, on the rows dealt to it."""
        out = cls.__new__(cls).clear(n, reach)
        copies, types = out.copies, {"tree": pa.int32(), "node": pa.list_(pa.int32()), "feature": pa.list_(pa.int32()), "split": pa.list_(pa.float64()), "path": pa.list_(pa.float64())}

        def run(own: pa.Table) -> pa.Table:
            t = own.column("tree")[0].as_py()
            one = cls.__new__(cls).clear(n, reach)
            one.grow(t, np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in own.column("features").chunks]).reshape(-1, len(reach)))
            used = np.flatnonzero((one.feature[t] >= 0) | (one.path[t] > 0))
            return pa.table({k: pa.array([v], types[k]) for k, v in {"tree": t, "node": used, "feature": one.feature[t, used], "split": one.split[t, used], "path": one.path[t, used]}.items()})

        ship(rows.sparkSession)
        dealt = rows.select("features", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("step"), F.xxhash64("doc_id", F.lit(out.seed)).alias("home"))
        dealt = dealt.select(F.pmod(F.pmod("home", F.lit(TREES)) + F.col("step"), F.lit(TREES)).cast("int").alias("tree"), "features")
        for r in dealt.groupBy("tree").applyInArrow(run, "tree int, node array<int>, feature array<int>, split array<double>, path array<double>").collect():  # TREES rows
            out.feature[r["tree"], r["node"]], out.split[r["tree"], r["node"]], out.path[r["tree"], r["node"]] = r["feature"], r["split"], r["path"]
        return out

    def grow(self, t: int, rows: np.ndarray) -> None:
        """Tree t on its rows, in whatever order they come."""
        self.branch(t, 1, rows, 0, np.random.default_rng([self.seed, t]))

    def branch(self, t: int, node: int, rows: np.ndarray, depth: int, draw) -> None:
        if not len(rows):
            self.path[t, node] = depth
            return
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_ = np.flatnonzero(high - low + self.reach > 0)
        if depth == self.depth or not len(open_) or len(rows) < 2:
            self.path[t, node] = depth + average_path(len(rows))
            return
        f = int(draw.choice(open_))
        cut = draw.uniform(low[f] - self.reach[f], high[f] + self.reach[f])
        left = rows[:, f] <= cut
        self.feature[t, node], self.split[t, node] = f, cut
        self.branch(t, 2 * node, rows[left], depth + 1, draw)
        self.branch(t, 2 * node + 1, rows[~left], depth + 1, draw)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1 by row: 2 to the power of minus the mean path length over that of a random tree."""
        node = np.ones((len(rows), TREES), dtype=np.int64)
        tree, row = np.arange(TREES)[None, :], np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            f = self.feature[tree, node]
            right = rows[row, np.maximum(f, 0)] > self.split[tree, node]
            node = np.where(f >= 0, 2 * node + right, node)
        return 2.0 ** (-self.path[tree, node].mean(axis=1) / average_path(self.size))


def average_path(n: int) -> float:
    return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2) or 1e-9


class Judge:
    """A forest and the anomaly score above which a document is rejected."""

    def __init__(self, forest: Forest, limit: float = 1.0):
        self.forest, self.limit = forest, limit

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.forest.scores(features)


def measured(docs: DataFrame, judge: Judge | None, carry: str | None = None) -> DataFrame:
    """doc_id, BASE, FEATURES (array), anomaly and method_ok for each row; carry is a column to keep."""
    shared = docs.sparkSession.sparkContext.broadcast(judge)  # TREES trees of bounded depth
    names = ["doc_id", *BASE, "features", "anomaly", "method_ok", *([carry] if carry else [])]
    kinds = [pa.int64(), *[pa.int64()] * len(BASE), pa.list_(pa.float64()), pa.float64(), pa.bool_(), *([pa.int64()] if carry else [])]
    schema = pa.schema(list(zip(names, kinds)))

    def run(batches):
        own = shared.value
        for batch in slices(batches):
            found = [statistics(text) for text in batch.column(1).to_pylist()]
            features = np.array([x[1] for x in found]).reshape(len(found), len(FEATURES))
            scores = own.scores(features) if own and len(found) else np.zeros(len(found))
            columns = [batch.column(0), *([x[0][k] for x in found] for k in range(len(BASE))), list(features), scores, scores <= (own.limit if own else 1.0)]
            columns += [batch.column(2)] if carry else []
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) if not isinstance(c, pa.Array) else c for c, k in zip(columns, kinds)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([F.col(carry).cast("long").alias(carry)] if carry else []))
    ddl = f"doc_id long, {', '.join(f'{n} long' for n in BASE)}, features array<double>, anomaly double, method_ok boolean" + (f", {carry} long" if carry else "")
    return in_arrow(rows, run, ddl)


def base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def train(docs: DataFrame, labels: DataFrame) -> Judge | None:
    """A judge of all labelled documents (see labelled) that pass the base rules; None if there are none.

    Quality 1 is good. The forest grows on all good rows if there are any, else on all rows; the threshold loses GOOD_LOST of all
    good rows, which is an exact order statistic. Rows stay on the executors; trees and counts of bins come to the driver.
    """
    with scratch(docs.sparkSession):
        found = measured(labelled(docs, labels, "quality", F.lit(True)), None, "quality").where(~base_failed())
        rows = materialise(found.select("doc_id", "features", (F.col("quality") == 1).alias("good")), "features")
        spread = [F.stddev_pop(F.col("features")[k]).alias(f"s{k}") for k in range(len(FEATURES))]
        r = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("good"), *spread).first()
        if not r["n"]:
            return None
        reach = REACH * np.array([float(f"{r[f's{k}']:.9g}") for k in range(len(FEATURES))])  # the last digits depend on the order of rows
        if not r["good"]:
            return Judge(Forest.over(rows, r["n"], reach))
        good = rows.where("good")
        forest = Forest.over(good, r["good"], reach)
        shared = docs.sparkSession.sparkContext.broadcast(forest)  # TREES trees of bounded depth

        def scored():
            own = shared.value
            return lambda batch: {"bits": bits(own.scores(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))))} if batch.num_rows else None

        scores = materialise(map_arrow(good.select("features"), scored, "bits long"), "scores")
        return Judge(forest, ranked(scores, "bits", int(np.ceil((r["good"] - 1) * (1 - GOOD_LOST)))))


def judged(docs: DataFrame, judge: Judge | None) -> DataFrame:
    """doc_id, BASE counts, anomaly, base_failed and kept for each row.

    base_failed: fewer than 10 words, or over a fifth of the words in repeated 5-word windows. kept: neither base_failed nor
    an anomaly score above the judge's limit; without a judge the base rules alone decide. Null texts are empty, and fail.
    Whole texts are read. Repeated rows are judged each; an empty table gives no rows; other columns are ignored.
    """
    failed = base_failed()
    return measured(docs, judge).select("doc_id", *BASE, "anomaly", failed.alias("base_failed"), (~failed & F.col("method_ok")).alias("kept"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with a forest over labelled ones."""
    docs = table(spark, sf_dir, "documents")
    return judged(docs, train(docs, table(spark, sf_dir, "labels"))).drop("anomaly")
