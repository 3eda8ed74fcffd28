"""Quality scores from compression: how much better a text compresses with good than with bad examples at hand.

Two zstandard dictionaries are trained on labelled texts, one of each quality. A text is compressed with each,
``BLOCK`` bytes at a time so that a long text leans on the dictionary throughout and not on itself; the difference
of the two sizes by the bytes of the text is the only input of the score, so neither length nor repetition can
decide. A logistic curve in it, fitted on labelled texts that trained neither dictionary, makes it a probability.

Fitting takes at most ``per_class`` labelled ids of each class (those with the smallest hash of the id), one text
each (the least in order where rows repeat an id) and of it the first ``SAMPLE`` characters, in the driver, a
bound in rows and bytes that does not grow with the corpus; the dictionaries (``DICTIONARY`` bytes each at most)
and the coefficients go to the tasks with the function, and every whole text is scored where it lies. Ids,
languages, sources and labels are no inputs of a score.

A null text is an empty one and gets the score of zero bytes. A null id is kept, and is held out of nothing.
Repeated rows get equal scores; an empty table gives an empty result. Labels that are null, or of rows without
a document, teach nothing; where one class has no labels the score is the share of label 1 everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

DICTIONARY = 112 << 10
LEVEL, BLOCK = 3, 1024
#: Characters of a text that teach, so at most 2 x ``per_class`` x ``SAMPLE`` reach the driver; scores are of whole texts.
SAMPLE = 16_384


@dataclass
class Model:
    good: bytes
    bad: bytes
    slope: float
    intercept: float


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that never teach: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Sizes:
    """Compressed sizes of a text with either dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.by = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False) for d in (good, bad)]

    def differences(self, texts: list[str | None]) -> np.ndarray:
        """Bytes that the good dictionary saves over the bad one, by the bytes of each text; 0 for empty ones."""
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            raw = (text or "").encode("utf-8", "surrogatepass")
            good, bad = (sum(len(c.compress(raw[at : at + BLOCK])) for at in range(0, len(raw), BLOCK)) for c in self.by)
            out[i] = (bad - good) / max(1, len(raw))
        return out


def _dictionary(texts: list[str]) -> bytes:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts if t]
    try:
        return zstandard.train_dictionary(DICTIONARY, [r[at : at + BLOCK] for r in raw for at in range(0, len(r), BLOCK)]).as_bytes()
    except zstandard.ZstdError:  # too few examples to train on: they are the dictionary themselves
        return b"".join(raw)[-DICTIONARY:] or b"\0" * 8


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept by Newton steps, halved until they lower the penalised loss."""
    spread = float(np.abs(x).mean()) or 1.0
    z, w, penalty = np.column_stack([x / spread, np.ones(len(x))]), np.zeros(2), np.array([ridge, 1e-6])

    def loss(v: np.ndarray) -> float:
        m = z @ v
        return float((np.logaddexp(0, m) - y * m).sum() + (penalty * v * v).sum() / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.diag(penalty), z.T @ (p - y) + penalty * w)
        part = 1.0
        while loss(w - part * step) > loss(w) and part > 1e-6:
            part /= 2
        w = w - part * step
        if np.abs(part * step).max() < 1e-8:
            break
    return float(w[0] / spread), float(w[1])


def fit_texts(good: list[str], bad: list[str]) -> Model:
    """Every other text of a class trains its dictionary; the rest calibrate."""
    prior = len(good) / max(1, len(good) + len(bad))
    a, b = _dictionary(good[::2]), _dictionary(bad[::2])
    rest, y = good[1::2] + bad[1::2], np.array([1.0] * len(good[1::2]) + [0.0] * len(bad[1::2]))
    if len(set(y.tolist())) < 2:
        return Model(a, b, 0.0, float(np.log((prior + 1e-6) / (1 - prior + 1e-6))))
    return Model(a, b, *_logistic(Sizes(a, b).differences(rest), y))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model from at most ``per_class`` ids of each class that are not held out; repeated label rows count once."""
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label")).where(~held_out("__id") & F.col("__label").isin(0, 1)).distinct()
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("__label") == label).orderBy(F.xxhash64("__id"), "__id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(chosen), "__id")  # at most 2 x per_class ids
    sample = texts.groupBy("__label", "__id").agg(F.min(F.substring("__text", 1, SAMPLE)).alias("__text"))
    rows = sample.select("__label", "__text", F.xxhash64("__id").alias("__order")).collect()
    rows.sort(key=lambda r: (r["__order"], r["__text"] or ""))
    return fit_texts(*([r["__text"] or "" for r in rows if r["__label"] == label] for label in (1, 0)))


def score(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted (score reaches ``threshold``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad)
        for batch in batches:
            p = 1 / (1 + np.exp(-np.clip(model.intercept + model.slope * sizes.differences(batch.column(2).to_pylist()), -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p)], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = 3000, threshold: float = 0.7) -> DataFrame:
    """Fit on the labelled rows that are not held out, score all of ``docs``."""
    return score(docs, fit(docs, labels, per_class), threshold)
