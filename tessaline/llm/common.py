"""What several corpus operators share: reading tables, cutting lineage, Arrow plumbing."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group of stored tables: a task holds that much of what it writes, and hands it over at once.
ROW_GROUP = 16 << 20
#: Rows that a worker handles at a time, so that its memory doesn't depend on Spark's batch size.
SLICE_ROWS = 1024
#: Bits that say which keys a join may find, and bits in a row of them: 4 MB are broadcast at most, whatever the number of keys.
MARKS, MARKS_ROW = 1 << 25, 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset (tests), one below the warehouse is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return folder.rstrip("/")


def materialise(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write df as Parquet into the shared folder and read it again, which cuts its lineage.

    Unlike localCheckpoint the rows outlive any executor; unlike a cache they spill nowhere. A scratch() deletes the table at
    its end, unless it is lasting.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written[path] = lasting
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


#: Paths of the tables that this process has written and not deleted, and whether the innermost scratch() keeps them.
_written: dict[str, bool] = {}


def _delete(spark: SparkSession, path: str) -> None:
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)
    _written.pop(path, None)


@contextmanager
def scratch(spark: SparkSession):
    """Deletes the tables that materialise() writes inside; lasting ones are left to an outer scratch(), but go after a failure."""
    before, failed = set(_written), True
    try:
        yield
        failed = False
    finally:
        for path in [p for p in _written if p not in before]:
            if _written[path] and not failed:
                _written[path] = False
            else:
                _delete(spark, path)


def stored_bytes(df: DataFrame) -> int:
    """Size of the files behind a materialised DataFrame."""
    own = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    return own.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getContentSummary(own).getLength()


def lean(df: DataFrame, most: int = 16 << 20) -> DataFrame:
    """A materialised DataFrame, to be broadcast if its files hold at most `most` bytes; a larger one is joined by shuffles."""
    return F.broadcast(df) if stored_bytes(df) <= most else df


def discard(df: DataFrame) -> None:
    """Delete the table behind a materialised DataFrame that no later result reads; others stay as they are."""
    if path := getattr(df, "_stored_at", None):
        _delete(df.sparkSession, path)


def forget(spark: SparkSession) -> int:
    """Delete all tables that materialise() has written in this process, when no result that reads them is needed; their number."""
    paths = list(_written)
    for path in paths:
        _delete(spark, path)
    return len(paths)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their workers can import it."""
    context = spark.sparkContext
    if getattr(context, "_tessaline_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    context._tessaline_code = tempfile.TemporaryDirectory()  # of the driver alone, gone when it ends
    path = os.path.join(context._tessaline_code.name, f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    context._tessaline_shipped = True


def by_size(texts: pa.Array, most: int = 1 << 20) -> Iterator[pa.Array]:
    """The texts in runs of at most `most` bytes together; a longer text is a run of its own."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield texts.slice(start, end - start)
        start = end


def in_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """df.mapInArrow with this package at hand on every executor.

    Batches of more than SLICE_ROWS rows are no faster and fill the memory beside the JVM's heap and the worker's, so a larger
    limit of the session is lowered. A worker gives back what it needed when its task ends.
    """
    spark = df.sparkSession
    ship(spark)
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(limit)) <= SLICE_ROWS:
        spark.conf.set(limit, str(SLICE_ROWS))

    def tidy(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(tidy, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches, cut into at most `rows` rows each."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow over slices; function turns one record batch into a dict of columns, or None for nothing."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        apply = function()
        for batch in slices(batches):
            if (columns := apply(batch)) is not None:
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in target], schema=target)

    return in_arrow(df, run, schema)


def remainder(column: str, modulus: int):
    """crc32 of an id written as text, modulo `modulus`; null ids give null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int | None = None, seed: int = 0) -> DataFrame:
    """(doc_id, text, label) of all labelled documents, one row for each doc_id; with `rows` about so many at most, drawn by a hash
    of doc_id.

    Of several labels of a doc_id the least counts, of several texts the least; null texts are empty; null ids and null labels
    are left out. The bound is on doc_ids before texts are read, so repeated rows don't enlarge the sample. Without a bound texts
    are shuffled; those of other doc_ids, but for what marked() lets through, stay where they are.
    """
    known = labels.where(learn & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    sample = known.groupBy("doc_id").agg(F.min(label).cast("long").alias(label))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if rows is None:
        texts = marked(texts, known, "doc_id")
    else:
        sample = F.broadcast(bounded(sample, "doc_id", rows, seed))  # about `rows` pairs of numbers
    return texts.join(sample, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first(label).alias(label))


def marked(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of df whose `key` is one of keys, and a few others, told without a shuffle of df; a join on `key` is to follow.

    Each key sets one of MARKS bits, by its hash, and a row stays if the bit of its key is set. Of other rows the share that stays
    is that of set bits, 1 - exp(-n / MARKS) for n keys. Keys of unlike types hash differently; df is returned then.
    """
    if df.schema[key].dataType != keys.schema[key].dataType:
        return df
    code = F.pmod(F.xxhash64(key), F.lit(MARKS))
    at, bit = F.floor(code / MARKS_ROW).cast("int").alias("_at"), (code % MARKS_ROW).cast("int")
    rows = keys.select(at, bit.alias("_bit")).repartition("_at").groupBy("_at").agg(F.bitmap_construct_agg("_bit").alias("_set"))
    byte = F.conv(F.hex(F.substring("_set", F.shiftright(bit, 3) + 1, 1)), 16, 10).cast("int")
    return df.withColumn("_at", at).join(F.broadcast(rows), "_at").where(F.getbit(byte, bit % 8) == 1).select(*df.columns)


def bounded(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """A sample of about `rows` rows at most, by a hash of `key`, the same on every run; all rows if there are fewer."""
    total = df.count()
    if total <= rows:
        return df
    grain = 1 << 20
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(grain)) < int(grain * rows / total))


def bits(numbers: np.ndarray) -> np.ndarray:
    """Doubles of 0 or more as whole numbers in the same order."""
    return (numbers + 0.0).view(np.int64)


def ranked(df: DataFrame, column: str, rank: int, weight: Column | None = None) -> float:
    """The double at place `rank`, from 0, of a column of bits() in ascending order, a row counting `weight` times.

    Exact: four counts of at most 65,536 bins, each within the bin of the one before.
    """
    at, own = 0, F.col(column)
    for shift in (48, 32, 16, 0):
        within = df if shift == 48 else df.where(F.shiftright(own, shift + 16) == at)
        counts = within.groupBy(F.shiftright(own, shift).alias("at")).agg(F.sum(weight if weight is not None else F.lit(1)).alias("n"))
        for r in sorted(counts.collect()):  # at most 65,536 rows
            at = r["at"]
            if rank < r["n"]:
                break
            rank -= r["n"]
    return float(np.array([at], dtype=np.int64).view(np.float64)[0])
