"""A corpus pipeline: each stage works on all that the one before it kept, and its decisions take effect.

In every stage: an empty table gives an empty one; rows with null or empty texts, or null doc_ids, are kept unless the stage says
otherwise; all but the last return the columns of their input, others of any name included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaline.llm import decontaminate, near_dup, packing, secrets, toxicity
from tessaline.llm.common import discard, materialise, remainder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go.

    Null and empty texts score as clean; repeated rows share their fate. Of several labels of a doc_id the least counts.
    """
    scorer = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return toxicity.without_toxic(docs, scorer)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: shingles of five words, a similarity of 0.8.

    Texts without words link with nothing, nor do null ids, so they stay; of rows that share a doc_id one stays.
    """
    return near_dup.deduplicated(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go.

    The text alone decides, so copies share their fate; texts without words stay; without benchmark items all stay.
    """
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; n_chars follows it.

    All rows stay, repeated ones too; null texts stay null; n_chars changes only where the text does.
    """
    found = secrets.find_secrets(docs)
    found = found.withColumn("text", secrets.redacted(F.col("text"), F.col("spans")))
    changed = F.when(F.size("spans") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 ids; the pieces of each document.

    Null and empty texts are the end id alone; repeated rows and null doc_ids are packed each.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: The trained scores and the tokenizer can't be expressed in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again; a stage's table goes once the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
