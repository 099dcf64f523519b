"""Byte-level BPE ids of whole texts, and the exact histogram of encoded lengths."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import in_arrow, materialise, slices, table

VOCABULARY = "byte_bpe_50k.json"
#: Texts longer than this are encoded in parts, which are cut where no piece of the vocabulary's pattern can span.
PART_CHARS = 200_000
#: Texts with such a run are left to the vocabulary's own library: the faster one backtracks there.
LONG_RUN = re.compile(r"\s{20000}|\S{20000}")
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in the vocabulary, by the published rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE vocabulary file, equal to those of the tokenizers library with add_special_tokens=False.

    The ids of this file are its merge ranks, so the same vocabulary serves tiktoken, which is several times faster. As in the
    library, the vocabulary's special tokens that a text spells out become their own ids; with `literal` they are ordinary text.
    """

    def __init__(self, vocabulary: str | None = None, literal: bool = False):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        path = vocabulary or public_tokenizers.path(VOCABULARY)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        special = {x["content"]: x["id"] for x in content.get("added_tokens", [])}
        of = byte_alphabet()
        self.ranks = {bytes(of[c] for c in piece): rank for piece, rank in content["model"]["vocab"].items() if piece not in special}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.slow = Tokenizer.from_file(str(path))
        self.slow.encode_special_tokens = True  # it sees what lies between special tokens only
        self.special = {} if literal else special
        spelled = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.spelled = re.compile(f"({spelled})") if spelled else None

    def parts(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > PART_CHARS:
            cut = SAFE_CUT.search(text, start + PART_CHARS)
            if not cut:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def ids(self, text: str | None) -> list[int]:
        """Ids of a whole text; null and empty texts have none."""
        if not text:
            return []
        if self.spelled is None or not any(x in text for x in self.special):
            return self.plain_ids(text)
        out: list[int] = []
        for k, part in enumerate(self.spelled.split(text)):
            out += [self.special[part]] if k % 2 else self.plain_ids(part)
        return out

    def plain_ids(self, text: str) -> list[int]:
        """Ids of a text without special tokens."""
        if len(text) <= PART_CHARS and (len(text) < 20_000 or not LONG_RUN.search(text)):
            return self.fast.encode_ordinary(text)
        out: list[int] = []
        for part in self.parts(text):
            out += self.slow.encode(part, add_special_tokens=False).ids if LONG_RUN.search(part) else self.fast.encode_ordinary(part)
        return out

    def ends_sentence(self) -> np.ndarray:
        """By id: whether its last byte ends a sentence or a line."""
        out = np.zeros(max([*self.ranks.values(), *self.special.values()]) + 1, dtype=bool)
        for piece, rank in self.ranks.items():
            out[rank] = piece[-1:] in (b".", b"!", b"?", b"\n")
        return out


@lru_cache(maxsize=2)
def encoder(vocabulary: str | None = None, literal: bool = False) -> Encoder:
    """One per Python worker."""
    return Encoder(vocabulary, literal)


def length_histogram(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(n_tokens, n_docs): how many texts have each encoded length.

    Null and empty texts have length 0. Each task sends one row per length that it saw, so the shuffle holds lengths,
    not documents, and no key is hot. An empty table gives no rows; repeated rows count each; other columns are ignored.
    """

    def run(batches):
        seen: Counter = Counter()
        own = encoder(vocabulary)
        for batch in slices(batches):
            seen.update(len(own.ids(text)) for text in batch.column(0).to_pylist())
        yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(seen.keys(), pa.int64()), "n_docs": pa.array(seen.values(), pa.int64())})

    partial = in_arrow(docs.select(F.col("text").cast("string").alias("text")), run, "n_tokens long, n_docs long")
    return partial.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def context_totals(histogram: DataFrame, block: int = 1024) -> DataFrame:
    """What every context limit would keep, from a length histogram alone.

    One row per length L that occurs: n_docs; docs_le and docs_ge (documents of at most and at least L tokens); tokens_ge (their
    tokens); total_tokens; truncated_tokens (the sum over documents of min(length, L)); quantile (docs_le over all documents).
    Any other limit x has the truncated total of the next smaller L plus (x - L) * docs_ge of the next larger one.

    Prefix sums run inside blocks of lengths; only the totals of blocks, at most longest length / block rows, meet in one task.
    """
    cells = histogram.withColumn("block", F.floor(F.col("n_tokens") / block)).withColumn("mass", F.col("n_tokens") * F.col("n_docs"))
    sums = cells.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("mass").alias("block_mass"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    sums = sums.select(
        "block",
        F.coalesce(F.sum("block_docs").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("block_mass").over(before), F.lit(0)).alias("mass_before"),
        F.sum("block_docs").over(whole).alias("all_docs"),
        F.sum("block_mass").over(whole).alias("all_mass"),
    )
    upto = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    docs_le = F.col("docs_before") + F.sum("n_docs").over(upto)
    mass_le = F.col("mass_before") + F.sum("mass").over(upto)
    rows = cells.join(sums, "block").select("n_tokens", "n_docs", "all_docs", "all_mass", docs_le.alias("docs_le"), mass_le.alias("mass_le"))
    return rows.select(
        "n_tokens",
        "n_docs",
        "docs_le",
        (F.col("all_docs") - F.col("docs_le") + F.col("n_docs")).alias("docs_ge"),
        (F.col("all_mass") - F.col("mass_le") + F.col("n_tokens") * F.col("n_docs")).alias("tokens_ge"),
        F.col("all_mass").alias("total_tokens"),
        (F.col("mass_le") + F.col("n_tokens") * (F.col("all_docs") - F.col("docs_le"))).alias("truncated_tokens"),
        (F.col("docs_le") / F.col("all_docs")).alias("quantile"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents, by encoded length, with the totals of each context limit; texts are encoded once."""
    return context_totals(materialise(length_histogram(table(spark, sf_dir, "documents")), "lengths"))
