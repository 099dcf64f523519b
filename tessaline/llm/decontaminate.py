"""Benchmark decontamination by a stored positional index of the corpus, in DataFrame operations only."""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lean, materialise, scratch, table

#: Consecutive words that make a window; items of fewer words are one window.
WINDOW = 10
#: Positions a word may be off in a proximity match, and the share of a window's words that one needs.
SLOP, NEAR_SHARE = 2, 0.8
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text: A-Z lower-cased, split at ASCII characters that aren't letters or digits; null has none.

    lower() would also change other letters, so it serves only texts of ASCII alone; it is much faster there.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.coalesce(F.filter(F.split(lowered, SEPARATORS, -1), lambda w: w != ""), F.array().cast("array<string>"))


def digest(text: Column) -> Column:
    """A name of a text, by which rows with it are found again; it holds no matter how a table is split."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


class Benchmark:
    """The stored windows of a benchmark.

    terms (window, size, place, code, next): the words of each distinct window, by code, each with the one after it in the window.
    holders (window, item_id): the items with the window. vocabulary (word, code): all words.
    """

    def __init__(self, benchmark: DataFrame):
        items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text").cast("string")).alias("own")).where(F.size("own") > 0)
        starts = F.sequence(F.lit(1), F.greatest(F.size("own") - (WINDOW - 1), F.lit(1)))
        every = items.select("item_id", "own", F.explode(starts).alias("at")).select("item_id", F.slice("own", F.col("at"), F.lit(WINDOW)).alias("own"))
        every = materialise(every, "item-windows")
        windows = materialise(every.select("own").distinct().select(F.monotonically_increasing_id().alias("window"), "own"), "windows")
        self.holders = materialise(every.where("item_id is not null").join(windows, "own").select("window", "item_id").distinct(), "holders")
        placed = windows.select("window", F.size("own").alias("size"), F.posexplode("own").alias("place", "word"))
        self.vocabulary = materialise(placed.select("word").distinct().select("word", F.monotonically_increasing_id().alias("code")), "vocabulary")
        coded = placed.join(self.vocabulary, "word").select("window", "size", "place", "code")
        after = coded.select("window", (F.col("place") - 1).alias("place"), F.col("code").alias("next"))
        self.terms = materialise(coded.join(after, ["window", "place"], "left").select("window", "size", "place", "code", "next"), "terms")


def positional_index(docs: DataFrame, vocabulary: DataFrame, named: bool = False) -> DataFrame:
    """The stored postings of all words of the vocabulary: row, doc_id, pos (from 1), code, next (the code of the word after it).

    One posting with pos 0 stands for each document, with n_words and, if `named`, the digest of its text. row numbers the rows
    of docs; it is given once, as the index is written, and read from there. Each word of the corpus is stored once at most, as
    two numbers. The texts are read and split once, where they lie; only a vocabulary too large to broadcast is joined by shuffle.
    """
    text = F.col("text").cast("string")
    marker = F.array(F.lit(None).cast("string"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words(text).alias("own"), (digest(text) if named else F.lit(None).cast("binary")).alias("name"))
    each = rows.select("row", "doc_id", "name", "own", F.posexplode(F.concat(marker, F.col("own"))).alias("pos", "word"))
    at_start = F.col("pos") == 0
    absent = F.concat(F.lit(" "), F.col("row").cast("string"))  # no word; a join by shuffle deals these out by row
    after = F.when(~at_start, F.get("own", F.col("pos")))
    each = each.select(
        "row", "doc_id", F.when(at_start, F.col("name")).alias("name"), F.when(at_start, F.size("own")).alias("n_words"), "pos", F.coalesce("word", absent).alias("word"), F.coalesce(after, absent).alias("word_after")
    )
    known = lean(vocabulary)
    found = each.join(known, "word", "left").where("pos = 0 or code is not null")
    found = found.join(known.select(F.col("word").alias("word_after"), F.col("code").alias("next")), "word_after", "left")
    return materialise(found.select("row", "doc_id", "name", "n_words", "pos", "code", "next"), "postings")


def phrases(index: DataFrame, benchmark: Benchmark) -> DataFrame:
    """(row, window, start, size): where all words of a window stand in their places.

    The postings of each adjacent pair of a window's words are read off the index. From the rarest of a window's pairs on, the
    lists of its other pairs are intersected at their offsets. Windows with a pair that the corpus lacks are left out at once.
    Windows of one word are that word's postings.
    """
    pairs = materialise(benchmark.terms.where("next is not null").select("code", "next").distinct(), "pairs")
    lists = materialise(index.join(lean(pairs), ["code", "next"]).select("row", "pos", "code", "next"), "pair-lists")
    counts = lists.groupBy("code", "next").agg(F.count("*").alias("n"))
    window = Window.partitionBy("window")
    ranked = benchmark.terms.where("next is not null").join(counts, ["code", "next"])
    ranked = ranked.select("*", F.count("*").over(window).alias("pairs"), F.row_number().over(window.orderBy("n", "place")).alias("rank")).where("pairs = size - 1")
    ranked = materialise(ranked.select("window", "size", "place", "code", "next", "rank"), "ranked")
    first = materialise(ranked.where("rank = 1"), "rarest")
    hits = lists.join(lean(first), ["code", "next"]).select("row", "window", "size", (F.col("pos") - F.col("place")).alias("start")).where("start > 0")
    others = lean(materialise(ranked.where("rank > 1").select("window", "place", "code", "next"), "others"))
    hits = materialise(hits, "rarest-hits")
    wanted = hits.where("size > 2").join(others, "window").select("row", "window", "size", "start", "code", "next", (F.col("start") + F.col("place")).alias("pos"))
    whole = wanted.join(lists, ["row", "code", "next", "pos"]).groupBy("row", "window", "start", "size").agg(F.count("*").alias("n")).where("n = size - 2")
    single = materialise(benchmark.terms.where("size = 1").select("window", "size", "code"), "single")
    alone = index.where("pos > 0").join(lean(single), "code").select("row", "window", F.col("pos").alias("start"), "size")
    return whole.select("row", "window", "start", "size").unionByName(hits.where("size = 2").select("row", "window", "start", "size")).unionByName(alone)


def near(index: DataFrame, benchmark: Benchmark) -> DataFrame:
    """(row, window): full windows of which a share NEAR_SHARE of the words stand within SLOP of their places, seen from one of
    the window's rarest words in its own place.

    The rarest words are two more than may be missing (least counts in the corpus first, then places), so a match holds two of
    them. Their postings are few; each is paired with those that follow it closely, and pairs that no window's rarest words
    could make go at once. Only where some are left all words' lists are intersected, within SLOP.
    """
    missing = WINDOW - math.ceil(WINDOW * NEAR_SHARE)
    counts = index.where("pos > 0").groupBy("code").agg(F.count("*").alias("n"))
    order = Window.partitionBy("window").orderBy(F.coalesce("n", F.lit(0)), "place")
    full = benchmark.terms.where(F.col("size") == WINDOW)
    ranked = full.join(counts, "code", "left").select("window", "place", "code", F.row_number().over(order).alias("rank"))
    anchors = materialise(ranked.where(F.col("rank") <= missing + 2).select("window", "place", "code"), "anchors")
    rare = index.where("pos > 0").select("row", "pos", "code").join(lean(materialise(anchors.select("code").distinct(), "anchor-words")), "code", "left_semi")
    close = Window.partitionBy("row").orderBy("pos").rangeBetween(0, WINDOW - 1 + SLOP)  # itself too, for a word that a window repeats
    two = rare.withColumn("others", F.collect_list(F.struct("pos", "code")).over(close)).select("row", "pos", "code", F.explode("others").alias("other"))
    one, next_ = anchors.select("window", F.col("place").alias("p0"), F.col("code").alias("c0")), anchors.select("window", F.col("place").alias("p1"), F.col("code").alias("c1"))
    couples = lean(materialise(one.join(next_, "window").where("p0 <> p1"), "couples"))
    met = two.select("row", "pos", F.col("code").alias("c0"), F.col("other.pos").alias("then"), F.col("other.code").alias("c1")).join(couples, ["c0", "c1"])
    met = met.select("row", "window", (F.col("pos") - F.col("p0")).alias("s0"), (F.col("then") - F.col("p1")).alias("s1")).where(F.abs(F.col("s0") - F.col("s1")) <= SLOP)
    starts = materialise(met.select("row", "window", F.explode(F.array("s0", "s1")).alias("start")).distinct(), "near-starts")
    rows = materialise(starts.select("row").distinct(), "near-rows")
    part = index.where("pos > 0").select("row", "pos", "code").join(lean(rows), "row", "left_semi")
    offs = F.explode(F.sequence(F.lit(-SLOP), F.lit(SLOP)))
    wanted = starts.join(lean(materialise(full.select("window", "place", "code"), "full")), "window").select("row", "window", "start", "place", "code", offs.alias("off"))
    met = wanted.select("*", (F.col("start") + F.col("place") + F.col("off")).alias("pos")).join(part, ["row", "code", "pos"])
    each = met.groupBy("row", "window", "start").agg(F.count_distinct("place").alias("n"))
    return each.where(F.col("n") >= WINDOW - missing).select("row", "window").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, with_near: bool = True, named: bool = False) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, item_ids (sorted strings), near_ids, contaminated (n_hit > 0).

    A word is hit when it lies inside an occurrence of a window of the benchmark. near_ids are items with a proximity match (see
    near); without `with_near` they are left out. With `named` a column name holds the digest of the text.

    The texts are read once, into a positional index in the shared folder (see positional_index), whose rows are numbered
    there; whatever the size of the benchmark, the index is built once. A word, pair or passage that very many documents hold
    is dealt out with its documents. A document's hits and items are grouped by row, since the result lists them by row. All
    that is stored on the way is deleted, but for the result's table.

    Null texts have no words; items without words have no windows; null item_ids count as hits but aren't listed; repeated
    rows of docs are judged each, repeated item_ids listed once. Empty docs give no rows, an empty benchmark no hits; other
    columns are ignored.
    """
    with scratch(docs.sparkSession):
        own = Benchmark(benchmark)
        index = positional_index(docs, own.vocabulary, named)
        hits = materialise(phrases(index, own), "hits")
        covered = F.aggregate(
            F.array_sort("spans"),
            F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end")),
            lambda acc, s: F.struct(
                (acc["sum"] + F.greatest(s["start"] + s["size"] - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("sum"),
                F.greatest(acc["end"], s["start"] + s["size"]).alias("end"),
            ),
        )
        spans = hits.groupBy("row").agg(F.collect_set(F.struct("start", "size")).alias("spans")).select("row", covered["sum"].cast("long").alias("n_hit"))
        items = lambda found, name: found.select("row", "window").distinct().join(own.holders, "window").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias(name))
        out = index.where("pos = 0").join(spans, "row", "left").join(items(hits, "item_ids"), "row", "left")
        if with_near:
            out = out.join(items(near(index, own), "near_ids"), "row", "left")
        nothing = F.array().cast("array<string>")
        lists = [F.coalesce(c, nothing).alias(c) for c in ("item_ids", "near_ids") if c in out.columns]
        n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
        columns = ["doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), *lists, (n_hit > 0).alias("contaminated")]
        return materialise(out.select(*columns, *(["name"] if named else [])), "contamination", lasting=True)


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all columns, that hold no window of the benchmark.

    Whether a text does depends on the text alone, so rows are dropped by its digest: it makes no difference how docs is split
    or how often it is read. Null and empty texts stay; repeated rows share their fate; an empty benchmark drops nothing.
    """
    with scratch(docs.sparkSession):
        found = contamination(docs, benchmark, with_near=False, named=True).where("contaminated").select(F.col("name").alias("_digest")).distinct()
        found = materialise(found, "contaminated", lasting=True)
    return docs.withColumn("_digest", digest(F.col("text"))).join(lean(found), "_digest", "left_anti").select(*docs.columns)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), with_near=False)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the benchmark items that they match word for word, and those with most words in place."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.array_join("item_ids", ",").alias("item_ids"), F.array_join("near_ids", ",").alias("near_ids"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (SELECT DISTINCT item_id, least(10, len(ws)) AS l, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS g
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
p AS (SELECT doc_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM w) WHERE len(ws) >= l),
m AS (SELECT p.doc_id, p.i, p.l, w.item_id FROM (SELECT doc_id, i, l, array_to_string(ws[i:i + l - 1], ' ') AS g FROM p) p JOIN w ON w.l = p.l AND w.g = p.g),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS x FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
