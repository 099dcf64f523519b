"""Language identification: averaged hashed character n-gram embeddings under a linear softmax, trained by SGD in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, in_arrow, remainder, slices, table

#: Learning rows: at most about SAMPLE_ROWS documents, drawn by a hash of doc_id. Of a text longer than SAMPLE_CHARS characters, so
#: many are learnt from, at a place drawn by the hash, so that texts of any length count; predictions read whole texts.
SAMPLE_ROWS, SAMPLE_CHARS = 6000, 20_000
BUCKET_BITS, WIDTH, ORDERS = 16, 16, 3
EPOCHS, RATE = 3, 0.4
#: Share of right predictions on validation rows that the rejection threshold lets through.
ACCEPTED = 0.995
#: Characters whose n-grams a worker holds at a time; the next ones carry on from them, so it makes no difference to any count.
_SPAN = 1 << 19


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """By code point: the lower-case letter's code point, or that of a space for what isn't a letter."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    for k in range(0x110000):
        c = chr(k)
        if c.isalpha():
            low = c.lower()
            out[k] = ord(low) if len(low) == 1 else k
    return out


def grams(text: str, before: str = " ", after: str = "  ") -> np.ndarray:
    """Buckets of the 1- to 3-grams that start at a letter of text, words being bounded by one kind of space.

    before and after are the character ahead of the text and the two behind it.
    """
    codes = letters()[np.frombuffer(f"{before}{text}{after}".encode("utf-32-le", "replace"), dtype=np.uint32)]
    here = np.flatnonzero(codes[1:-2] != 32) + 1
    factors = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], dtype=np.uint32)
    state = np.zeros(len(here), dtype=np.uint32)
    out = []
    for k in range(ORDERS):
        state = (state + codes[here + k] + np.uint32(k)) * factors[k]
        out.append((state ^ (state >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BUCKET_BITS))
    opens = codes[here - 1] == 32  # word starts say more: their 3-gram counts again, as such
    out.append((state[opens] * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(out)


class Model:
    """languages, a table of logits by bucket (embedding times softmax weights), biases, temperature and rejection threshold."""

    def __init__(self, languages: list[str], logits: np.ndarray, bias: np.ndarray, heat: float = 1.0, least: float = 0.0):
        self.languages, self.logits, self.bias, self.heat, self.least = languages, logits, bias, heat, least

    def raw(self, text: str | None) -> np.ndarray | None:
        """Mean logits, or None where there is no letter."""
        if not text:
            return None
        total, n = np.zeros(len(self.languages)), 0
        for at in range(0, len(text), _SPAN):  # very long texts part by part, so that memory stays bounded
            own = grams(text[at : at + _SPAN], text[at - 1] if at else " ", text[at + _SPAN : at + _SPAN + 2].ljust(2))
            n += len(own)
            total += np.bincount(own, minlength=len(self.logits)).astype(np.float64) @ self.logits if len(own) > 4 * len(self.logits) else self.logits[own].sum(axis=0, dtype=np.float64)
        return total / n + self.bias if n else None

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, rejected."""
        raw = self.raw(text)
        if raw is None:
            return "und", 0.0, True
        p = softmax(raw / self.heat)
        k = int(p.argmax())
        return self.languages[k], float(min(1.0, p[k])), bool(p[k] < self.least)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """Train on (text, language) pairs; a tenth is held back to fit the temperature and the rejection threshold.

    Each text counts as a whole and as one short excerpt, so that short texts are calibrated too.
    """
    draw = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in rows})
    place = {lang: k for k, lang in enumerate(languages)}
    examples = []
    for text, lang in rows:
        words = text.split()
        at = int(draw.integers(0, max(1, len(words) - 4)))
        for part in (text, " ".join(words[at : at + int(draw.integers(2, 12))])):
            own, n = np.unique(grams(part), return_counts=True)
            if len(own):
                examples.append((own, (n / n.sum()).astype(np.float32), place[lang]))
    order = draw.permutation(len(examples))
    cut = max(1, len(order) // 10)
    held, train = order[:cut], order[cut:]
    table_ = (draw.standard_normal((1 << BUCKET_BITS, WIDTH)) / WIDTH).astype(np.float32)
    weights, bias = np.zeros((WIDTH, len(languages)), dtype=np.float32), np.zeros(len(languages), dtype=np.float32)
    steps, step = EPOCHS * len(train), 0
    for _ in range(EPOCHS):
        for k in draw.permutation(train):
            own, share, y = examples[k]
            rate = RATE * (1 - step / steps) + 1e-3
            step += 1
            pooled = share @ table_[own]
            error = softmax(pooled @ weights + bias)
            error[y] -= 1
            back = weights @ error
            weights -= rate * np.outer(pooled, error)
            bias -= rate * 0.1 * error
            table_[own] -= (rate * 20) * np.outer(share, back)
    model = Model(languages, (table_ @ weights).astype(np.float32), bias.astype(np.float64))
    raw = np.array([examples[k][1] @ model.logits[examples[k][0]] + bias for k in held])
    truth = np.array([examples[k][2] for k in held])
    loss = lambda t: -np.log(softmax(raw / t)[np.arange(len(truth)), truth] + 1e-12).mean()
    model.heat = float(min(np.geomspace(0.05, 5, 60), key=loss))
    p = softmax(raw / model.heat)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == truth])
    model.least = float(right[int((1 - ACCEPTED) * len(right))]) if len(right) else 0.0
    return model


def train(docs: DataFrame, learn) -> Model | None:
    """A model of a bounded sample of the documents where `learn` holds and lang is known; None if there are none.

    A doc_id counts once, by its least lang and text. Null ids aren't learnt from. Only ids and languages are read to draw it.
    """
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    rows = bounded(known.select("doc_id", "lang", F.col("text").cast("string").alias("text")), "doc_id", SAMPLE_ROWS, 2)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.greatest(F.char_length("text") - (SAMPLE_CHARS - 1), F.lit(1))).cast("int")
    excerpts = rows.select("doc_id", "lang", F.col("text").substr(drawn + 1, F.lit(SAMPLE_CHARS)).alias("text")).where("text is not null")
    once = excerpts.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("lang").alias("lang"))
    found = [(r["text"], r["lang"]) for r in sorted(once.collect())]
    return fit(found) if found else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score (calibrated probability) and rejected (score below the model's threshold) for each row.

    Null texts and texts without letters are `und` with score 0, rejected; so are all without a model. Whole texts are read.
    Repeated rows are judged each; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BUCKET_BITS rows of one float per language
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches):
        own = shared.value
        for batch in slices(batches):
            found = [own.predict(text) if own else ("und", 0.0, True) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[k] for x in found], type=schema.field(k + 1).type) for k in range(3))], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_arrow(rows, run, "doc_id long, lang_pred string, score double, rejected boolean")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learnt from those whose remainder isn't 2."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = train(docs, remainder("doc_id", 4) != 2)
    return identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
