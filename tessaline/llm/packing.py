"""Packing documents into sequences in their order, by dynamic programming over cut positions."""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_arrow, slices, table
from .tokens import encoder

WIDTH = 2048
END_ID = 1
#: Cost of a cut, in padding tokens: between documents, after a sentence, and elsewhere.
CUT_COST = {"document": 0, "sentence": 2, "inside": 16}
#: Where boundaries are further apart than the first, cuts inside are allowed at every multiple of the second.
GAP, STEP = 64, 16
#: Ids that one run of the dynamic programme covers; what its last window lacks is carried into the next run.
BLOCK = 1 << 18


def candidates(ends: np.ndarray, sentences: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions (0 first, total last) and their costs, from document ends and sentence ends."""
    cost = np.full(total + 1, -1, dtype=np.int64)
    cost[sentences] = CUT_COST["sentence"]
    cost[ends] = CUT_COST["document"]
    cost[0] = cost[total] = 0
    at = np.flatnonzero(cost >= 0)
    wide = np.flatnonzero(np.diff(at) > GAP)
    if len(wide):
        inside = np.concatenate([np.arange(at[k] + STEP, at[k + 1], STEP) for k in wide])
        cost[inside] = CUT_COST["inside"]
        at = np.flatnonzero(cost >= 0)
    return at, cost[at]


def best_cuts(at: np.ndarray, cost: np.ndarray, width: int, last: bool) -> list[int]:
    """The cut positions that minimise padding plus cut costs, windows being at most `width` long.

    A window from i to j pads width - (j - i), so the best i for j is the least of best(i) + position(i) in a sliding range of
    positions: a queue that stays sorted gives it, and each position enters and leaves once. If this isn't the last run, the
    way ends at the position within the last width from which going on is cheapest.
    """
    places, costs = at.tolist(), cost.tolist()
    best, back = [0] * len(places), [0] * len(places)
    keys, indices = deque([places[0]]), deque([0])
    for j in range(1, len(places)):
        here = places[j]
        low = here - width
        while places[indices[0]] < low:
            indices.popleft()
            keys.popleft()
        key = keys[0]
        back[j] = indices[0]
        best[j] = key - low + costs[j]
        key = best[j] + here
        while keys and keys[-1] >= key:
            keys.pop()
            indices.pop()
        keys.append(key)
        indices.append(j)
    j = len(places) - 1 if last else indices[0]
    cuts = []
    while j:
        cuts.append(places[j])
        j = back[j]
    cuts = cuts[::-1]
    if last and cuts:  # a short end is padded, or cut into powers of two, which need no padding
        start = cuts[-2] if len(cuts) > 1 else 0
        short = cuts[-1] - start
        powers = [1 << k for k in range(width.bit_length() - 1, -1, -1) if short >> k & 1]
        if short & (short - 1) and (len(powers) - 1) * CUT_COST["inside"] < width - short:
            cuts[-1:] = (start + np.cumsum(powers)).tolist()
    return cuts


class Packer:
    """Packs a stream of documents; emits pieces as columns."""

    def __init__(self, width: int, vocabulary: str | None, task: int):
        self.width, self.own = width, encoder(vocabulary)
        self.stops = self.own.ends_sentence()
        self.task, self.sequence = task, 0
        self.held: list[tuple] = []  # (doc_id, ids, ids before these, ids of the document)
        self.size = 0

    def add(self, doc_id, text) -> dict | None:
        ids = np.array([*self.own.ids(text), END_ID], dtype="<u4")
        self.held.append((doc_id, ids, 0, len(ids)))
        self.size += len(ids)
        return self.flush(last=False) if self.size >= BLOCK else None

    def flush(self, last: bool) -> dict | None:
        if not self.held:
            return None
        ids = np.concatenate([x[1] for x in self.held])
        ends = np.cumsum([len(x[1]) for x in self.held])
        at, cost = candidates(ends, np.flatnonzero(self.stops[np.minimum(ids, len(self.stops) - 1)]) + 1, len(ids))
        cuts = np.array(best_cuts(at, cost, self.width, last), dtype=np.int64)
        if not len(cuts):
            return None
        done = int(cuts[-1])
        borders = np.union1d(cuts, ends[ends < done])
        starts = np.concatenate([[0], borders[:-1]])
        document = np.searchsorted(ends, starts, side="right")
        window = np.searchsorted(cuts, starts, side="right")
        opens = np.concatenate([[0], cuts])[window]
        first = np.concatenate([[0], ends[:-1]])[document]
        raw = memoryview(ids.tobytes())
        out = {
            "doc_id": [self.held[d][0] for d in document.tolist()],
            "start": starts - first + np.array([self.held[d][2] for d in document.tolist()], dtype=np.int64),
            "length": borders - starts,
            "ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), borders.tolist())],
            "doc_tokens": [self.held[d][3] for d in document.tolist()],
            "sequence_id": (self.task << 33) + self.sequence + window,
            "offset": starts - opens,
        }
        self.sequence += len(cuts)
        rest = int(np.searchsorted(ends, done, side="right"))
        kept = self.held[rest:]
        if kept:
            inside = done - (int(ends[rest - 1]) if rest else 0)
            doc_id, own, before, total = kept[0]
            kept[0] = (doc_id, own[inside:].copy(), before + inside, total)
        self.held, self.size = kept, len(ids) - done
        return out


def pack(docs: DataFrame, width: int = WIDTH, vocabulary: str | None = None) -> DataFrame:
    """Pieces of documents in sequences of at most `width` ids: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents keep the order of their partition; each task packs its own partition with memory bounded by one block and the
    longest document, so nothing is shuffled. Cuts fall between documents or after sentences, and elsewhere only where no such
    boundary is near. Null and empty texts are the end id alone. Repeated rows and null or repeated doc_ids are packed each;
    an empty table gives no rows; other columns are ignored.
    """

    def run(batches):
        from pyspark import TaskContext

        packer = Packer(width, vocabulary, TaskContext.get().partitionId())
        schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if out := packer.add(doc_id, text):
                    yield pa.RecordBatch.from_pydict(out, schema=schema)
        while out := packer.flush(last=True):
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_arrow(
        rows, run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids."""
    return pack(table(spark, sf_dir, "documents"))
