"""Quality by compression: two zstandard dictionaries, built from good and from bad labelled text,
compress every text; how many bytes the good dictionary saves over the bad one, per byte of text,
becomes a calibrated score.

Texts are compressed in blocks, each with the fresh dictionary: a long text is then judged by the
dictionaries throughout and not by its own beginning, and memory stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_out, load, map_arrow, pick

#: Bounds of what is learned from: labelled rows per class (those with the smallest hash of their id),
#: half for the dictionaries, half for the calibration; of a text longer than FIT_PARTS times FIT_PART code points, as many parts
#: spread evenly from its first to its last code point.
FIT_ROWS, FIT_PARTS, FIT_PART = 3000, 16, 512
BLOCK, LEVEL, DICTIONARY = 512, 3, 112_640
THRESHOLD = 0.7


@dataclass(frozen=True)
class Model:
    """Dictionaries and a logistic calibration of features(): weights, their means and spreads."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    mean: tuple[float, ...]
    spread: tuple[float, ...]
    prior: float


@lru_cache(4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


def _blocks(text: str) -> list[bytes]:
    data = text.encode("utf-8", "replace")
    return [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]


def features(good: bytes, bad: bytes, text: str) -> tuple[float, float]:
    """(bad size - good size) and good size, both per byte of text."""
    squeeze_good, squeeze_bad = _compressor(good).compress, _compressor(bad).compress
    g = b = n = 0
    for block in _blocks(text):
        g += len(squeeze_good(block))
        b += len(squeeze_bad(block))
        n += len(block)
    return (b - g) / (n + 8), g / (n + 8)


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary, or for too few texts their plain content."""
    samples = [b for t in texts for b in _blocks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def fit(good: list[str], bad: list[str], prior: float) -> Model:
    """Model of texts with label 1 and label 0. ``prior``: share of label 1 among all that could be
    learned from. Without texts of both labels every score is the prior."""
    if min(len(good), len(bad)) < 2:
        return Model(b"", b"", (), (), (), prior)
    g, b = _dictionary(good[::2]), _dictionary(bad[::2])
    x = np.array([features(g, b, t) for t in good[1::2] + bad[1::2]])
    y = np.repeat([1.0, 0.0], [len(good[1::2]), len(bad[1::2])])
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / spread]
    w = np.zeros(3)
    for _ in range(40):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + 0.01 * np.eye(3)
        w = w + np.linalg.solve(curve, z.T @ (weight * (y - p)) - 0.01 * w)
    return Model(g, b, tuple(w), tuple(mean), tuple(spread), prior)


def score(model: Model, text: str | None) -> float:
    """Chance of label 1; the prior for a null or empty text."""
    if not text or not model.weights:
        return model.prior
    x = (np.array(features(model.good, model.bad, text)) - model.mean) / model.spread
    return float(1 / (1 + np.exp(-np.clip(model.weights[0] + x @ model.weights[1:], -30, 30))))


def _spread(text: Column) -> Column:
    """The text, or of a long one its parts for fitting."""
    step = (F.length(text) - FIT_PART) / (FIT_PARTS - 1)
    parts = F.transform(F.sequence(F.lit(0), F.lit(FIT_PARTS - 1)), lambda i: F.substring(text, F.floor(i * step).cast("int") + 1, F.lit(FIT_PART)))
    return F.when(F.length(text) <= FIT_PARTS * FIT_PART, text).otherwise(F.array_join(parts, ""))


def learn(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Model from at most ``rows`` labelled texts of each class that are not held out. The labels are
    chosen first, from the label table alone; the texts then meet a list of bounded size."""
    marks = pick(labels, "doc_id", "quality").filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~fold_out())
    total = {r["quality"]: r["n"] for r in marks.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = total.get(1, 0) / max(1, sum(total.values())) if total else 0.5
    chosen = [marks.filter(F.col("quality") == q).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for q in (0, 1)]
    texts = (pick(docs, "doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
             .select("quality", "doc_id", _spread(F.col("text")).alias("text")).distinct()
             .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(4 * rows).collect())
    return fit([r["text"] for r in texts if r["quality"] == 1][:rows], [r["text"] for r in texts if r["quality"] == 0][:rows], prior)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row of ``docs``. Only doc_id and text are read; ids may be null; repeated
    rows each give their own row; a text's cost is linear in its length."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score(shared.value, t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    slim = pick(docs, "doc_id", "text")
    return map_arrow(slim, run, f"doc_id {dict(slim.dtypes)['doc_id']}, score double")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    scored = classify(docs, learn(docs, load(spark, sf_dir, "labels")))
    return scored.select("doc_id", fold_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
