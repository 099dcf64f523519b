"""Near-duplicate documents: banded MinHash candidates, odd sketches to thin them, full shingle sets to confirm them."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import in_arrow, materialise, scratch, slices, table
from .components import components

#: A pair at the threshold of 0.8 shares no band with probability (1 - 0.8 ** ROWS) ** BANDS, 1.5e-5.
BANDS, ROWS = 28, 5
#: Bits of the odd sketch: 8 long values.
SKETCH_BITS = 512
#: Standard deviations of the sketch's estimate that a pair may lie below the threshold and still be confirmed on full sets.
SLACK = 5.5
#: Hashed words that a worker remembers before it starts anew.
WORDS_KEPT = 100_000
#: Rounds in which members of a bucket meet one centre each.
STARS = 2
_CHUNK = 2048


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """By word (bytes): its 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        out = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 40:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = out
        return out


class Signer:
    """Shingle sets, MinHash bands and odd sketches of texts."""

    def __init__(self, words: int, bands: int, rows: int):
        draw = np.random.default_rng(20240607)
        odd = lambda n: draw.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.words, self.bands, self.rows = words, bands, rows
        self.place, self.factor, self.shift = odd(words), odd(bands * rows), odd(bands * rows)
        self.fold, self.band, self.slot = odd(rows), odd(bands), odd(bands * rows)
        self.hashes = WordHashes()

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted distinct shingles of a text, as 64-bit hashes; A-Z lower-cased, words split at ASCII white space."""
        words = text.encode().lower().split() if text else []
        if not words:
            return np.empty(0, dtype=np.uint64)
        hashes = np.fromiter(map(self.hashes.__getitem__, words), dtype=np.uint64, count=len(words))
        if len(words) < self.words:
            return _mix((hashes * self.place[: len(words)]).sum(keepdims=True) + np.uint64(len(words)))
        n = len(words) - self.words + 1
        joined = np.zeros(n, dtype=np.uint64)
        for k in range(self.words):
            joined += hashes[k : k + n] * self.place[k]
        return np.unique(_mix(joined))

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factor), np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(shingles), _CHUNK):
            values = np.multiply.outer(shingles[at : at + _CHUNK], self.factor)
            values += self.shift
            np.minimum(least, values.min(axis=0), out=least)
        return least

    def signature(self, minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket keys by band, and the odd sketch: the parity, by bit, of the samples that hash there."""
        keys = _mix((minima.reshape(self.bands, self.rows) * self.fold).sum(axis=1) ^ self.band)
        bits = np.bincount((_mix(minima ^ self.slot) % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
        return keys.view(np.int64), np.packbits(bits.astype(np.uint8)).view(np.int64)


@lru_cache(maxsize=4)
def signer(words: int, bands: int, rows: int) -> Signer:
    """One per Python worker."""
    return Signer(words, bands, rows)


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, sig (a 128-bit name of the shingle set), keys and sketch; null beyond n_shingles for empty sets."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sig", pa.binary()), ("keys", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])

    def run(batches):
        own = signer(words, bands, rows)
        for batch in slices(batches):
            sizes, sigs, keys, sketches = [], [], [], []
            for text in batch.column(1).to_pylist():
                shingles = own.shingles(text)
                sizes.append(len(shingles))
                key, sketch = own.signature(own.minima(shingles)) if len(shingles) else (None, None)
                sigs.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                keys.append(key)
                sketches.append(sketch)
            yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip([batch.column(0), sizes, sigs, keys, sketches], schema)], schema=schema)

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_arrow(rows_in, run, "doc_id long, n_shingles long, sig binary, keys array<long>, sketch array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(rep, own): the shingle sets, as bytes, of the classes in wanted (rep, sig, repeats), each from one text of its class.

    Where several rows hold rep and a text of the class (repeats > 1), one of their equal sets stays, by partial aggregation.
    """

    def run(batches):
        own = signer(words, bands, rows)
        for batch in slices(batches, 256):
            reps, sets = [], []
            for rep, sig, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                raw = own.shingles(text).tobytes()
                if xxhash.xxh3_128_digest(raw) == sig:
                    reps.append(rep)
                    sets.append(raw)
            yield pa.RecordBatch.from_pydict({"rep": pa.array(reps, pa.int64()), "own": pa.array(sets, pa.binary())})

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    read = lambda w: in_arrow(w.join(texts, "rep").select("rep", "sig", "text"), run, "rep long, own binary")
    once, more = wanted.where("repeats = 1"), wanted.where("repeats > 1")
    return read(once) if more.isEmpty() else read(once).unionByName(read(more).groupBy("rep").agg(F.min("own").alias("own")))


def most_differing_bits(percent: int, samples: int) -> int:
    """Differing sketch bits beyond which a pair is at least SLACK deviations below the threshold."""
    far = 1 - percent / 100
    differ, spread = 2 * samples * far, 2 * math.sqrt(samples * far * (1 - far))
    bits = lambda m: SKETCH_BITS / 2 * (1 - math.exp(-2 * m / SKETCH_BITS))
    slope = math.exp(-2 * differ / SKETCH_BITS)
    noise = math.sqrt((slope * spread) ** 2 + bits(differ) * (1 - slope))
    return math.ceil(bits(differ) + SLACK * noise)


def alike(pairs: DataFrame, classes: DataFrame, percent: int, samples: int) -> DataFrame:
    """The pairs (a, b) whose sizes and odd sketches allow the threshold."""
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    differ = sum((F.bit_count(F.col("s_a")[k].bitwiseXOR(F.col("s_b")[k])) for k in range(SKETCH_BITS // 64)), F.lit(0))
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(sizes & (differ <= most_differing_bits(percent, samples))).select("a", "b").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in slices(batches, 256):
            a, b, left, right = (batch.column(k) for k in range(4))
            keep = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], schema=schema)

    side = lambda x: sets.select(F.col("rep").alias(x), F.col("own").alias(f"own_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "own_a", "own_b")
    return in_arrow(joined, run, "a long, b long")


def labelled(members: DataFrame, edges: DataFrame | None) -> DataFrame:
    """members (key, rep) with the label of rep's component so far, only buckets that still hold several components."""
    if edges is not None:
        labels = components(edges)
        members = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    else:
        members = members.withColumn("label", F.col("rep"))
    open_keys = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    return materialise(members.select("key", "rep", "weight", "label").join(open_keys, "key"), "open")


def ordered(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def star_pairs(members: DataFrame, turn: int) -> DataFrame:
    """Each member of a bucket with the bucket's centre, where their components differ: a row per member, not per pair.

    The centre is the member with most neighbours over all bands, which lies in the middle of its group and is the same in most
    of its buckets; later turns draw others of the foremost.
    """
    draw = F.pmod(F.xxhash64("rep", F.lit(turn)), F.lit(1024)) / 1024 * (0.4 if turn else 0.0) + 1
    rank = F.struct((-F.col("weight") / draw).alias("w"), F.col("rep").alias("centre"), F.col("label").alias("at"))
    centre = members.groupBy("key").agg(F.min(rank).alias("c")).select("key", "c.centre", "c.at")
    return members.join(centre, "key").where("label <> at").select(*ordered("rep", "centre")).distinct()


def shingle_rows(sets: DataFrame) -> DataFrame:
    """(token, rep, label, size): one row per shingle of each set (rep, label, own)."""

    def run(batches):
        for batch in slices(batches, 256):
            for rep, label, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = np.frombuffer(raw.as_buffer(), dtype=np.int64)
                same = lambda x: pa.array(np.full(len(own), x))  # noqa: E731, B023
                yield pa.RecordBatch.from_pydict({"token": pa.array(own), "rep": same(rep), "label": same(label), "size": same(len(own))})

    return in_arrow(sets.select("rep", "label", "own"), run, "token long, rep long, label long, size long")


def prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of different components among members (rep, label) that exactly holds every pair at the threshold.

    In any one order of all shingles, two sets at the threshold share one of their first n - ceil(threshold * n) + 1. The order
    is by exact frequency among these sets, rarest first, counted by partial aggregation, so it keeps its power however large
    they are: passages that many documents share bring no candidates, and neither do members of a group, or of a family made
    from one template, that differ from all others too much. From the first shared shingle on, the rest of both sets bounds
    what they can share; pairs that can't reach the threshold are left out, too. Where a shingle's documents lie in several
    components, those outside its largest component are paired with the others.
    """
    tokens = materialise(shingle_rows(sets.join(members.select("rep", "label").distinct(), "rep")), "open-shingles")
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    shared = tokens.join(counts.where("n > 1"), "token")
    own = Window.partitionBy("rep")
    shared = shared.withColumn("place", F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("n", "token")))  # after the set's own shingles
    first = f"low < high and place <= size - cast(ceil({percent} * size / 100) as long) + 1"
    prefix = materialise(shared.where(first).select("token", "rep", "label", "size", (F.col("size") - F.col("place") + 1).alias("rest")), "prefixes")
    sizes = prefix.groupBy("token", "label").agg(F.count("*").alias("n")).groupBy("token").agg(F.max(F.struct("n", "label"))["label"].alias("largest"), F.count("*").alias("labels"))
    mixed = prefix.join(sizes.where("labels > 1").select("token", "largest"), "token")
    outside = mixed.where("label <> largest").select("token", F.col("rep").alias("x"), F.col("label").alias("from"), F.col("size").alias("size_x"), F.col("rest").alias("rest_x"))
    enough = f"least(rest, rest_x) * {100 + percent} >= {percent} * (size + size_x) and 100 * least(size, size_x) >= {percent} * greatest(size, size_x)"
    return outside.join(mixed, "token").where(f"label <> from and {enough}").select(*ordered("x", "rep")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (smallest doc_id that links reach), kept (doc_id = component_id).

    Documents link when 100 * shared >= percent * union over their sets of distinct shingles of `words` words. Fewer words
    make one shingle of all; no words, or a null text, make an empty set, which links with nothing.

    Texts with equal sets are one class, named by its least doc_id. Candidates share a band of MinHash values. Star rounds
    compare each member of a bucket with one centre; the members of buckets that still hold several components then meet by an
    exact prefix filter on rare shingles. So no candidate is left out, and groups of copies of any size cost their number of
    members. Odd sketches rule out pairs far below the threshold; the full sets decide.

    What it stores on its way is deleted, but for the table of the result.

    Rows that share a doc_id and have words are one node. Null doc_ids link with nothing: component_id is null, kept is true.
    Empty tables give no rows; other columns are ignored.
    """
    with scratch(docs.sparkSession):
        signed = materialise(signatures(docs, words, bands, rows), "signed")
        named = signed.where("doc_id is not null and n_shingles > 0")
        classes = named.groupBy("sig").agg(F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in ("n_shingles", "keys", "sketch")))
        classes = materialise(classes, "classes")
        members = classes.select("rep", F.explode("keys").alias("key")).select("key", "rep")
        several = members.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count("*").alias("n")).where("low < high").select("key", "n")
        members = materialise(members.join(several, "key"), "members")
        weights = members.groupBy("rep").agg(F.sum("n").alias("weight"))  # members of large buckets again and again lie in the middle of a group
        members = materialise(members.select("key", "rep").join(weights, "rep"), "members")
        repeats = named.groupBy(F.col("doc_id").alias("rep")).agg(F.count("*").alias("repeats")).where("repeats > 1")
        wanted = classes.select("rep", "sig").join(members.select("rep"), "rep", "left_semi").join(repeats, "rep", "left").fillna(1, ["repeats"])
        sets = materialise(shingle_sets(docs, wanted, words, bands, rows), "sets")

        same = named.select("doc_id", "sig").join(classes.select("sig", "rep"), "sig").select(*ordered("doc_id", "rep"))
        shared = same.groupBy("b").agg(F.min("a").alias("low"), F.max("a").alias("high")).where("low < high").select("b")
        edges = materialise(same.join(shared, "b").select("a", "b"), "links")  # doc_ids that several classes hold
        open_members = labelled(members, None)
        for turn in range(STARS + 1):
            pairs = star_pairs(open_members, turn) if turn < STARS else prefix_pairs(open_members, sets, percent)
            found = confirmed(alike(pairs, classes, percent, bands * rows), sets, percent)
            edges = materialise(edges.unionByName(found), "links")
            if turn < STARS:
                open_members = labelled(members, edges)
        labels = components(edges)
        component = classes.select("sig", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("sig", F.coalesce("label", "rep").alias("label"))
        out = signed.select("doc_id", "n_shingles", "sig").join(component, "sig", "left")
        component_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
        out = out.select("doc_id", "n_shingles", component_id.alias("component_id"), F.coalesce(F.col("doc_id") == component_id, F.lit(True)).alias("kept"))
        return materialise(out, "components", lasting=True)


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, with all columns, that near_duplicates() keeps; of rows that share a doc_id one stays; null ids all stay."""
    dropped = near_duplicates(docs, words, percent).where(~F.col("kept")).select("doc_id").distinct()
    left = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return left
    once = left.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return left.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r(node, label) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.x, r.label FROM r JOIN e ON e.y = r.node)
SELECT w.doc_id AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(label) AS component_id, w.doc_id = min(label) AS kept
FROM w JOIN r ON r.node = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""
