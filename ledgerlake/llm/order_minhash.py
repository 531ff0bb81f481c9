"""Document fingerprints by order MinHash.

A text's k-mers are numbered by occurrence, so that a repeated k-mer gives distinct items. Each of
``SIGNATURES`` hash functions selects the ``TUPLE`` minimal items, puts them back in text order and
hashes the tuple. Two texts share a component only if they share the items and their order, which
follows the edit distance more closely than a set of k-mers does.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import load, map_arrow, materialize, pick

K, TUPLE, SIGNATURES = 8, 2, 32
#: Items hashed by all functions at once; longer texts are taken in pieces.
PIECE = 8192
_MULTIPLIERS = np.random.default_rng(20).integers(1 << 62, 1 << 63, SIGNATURES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GOLDEN, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


def items(codes: np.ndarray) -> np.ndarray:
    """A hash for each k-mer of the code points and its occurrence number, in text order. A text shorter
    than K is one item."""
    if not len(codes):
        return np.zeros(0, np.uint64)
    n = max(1, len(codes) - K + 1)
    x = np.full(n, len(codes) if len(codes) < K else K, np.uint64)
    for i in range(min(K, len(codes))):
        x = (x ^ codes[i:i + n]) * _GOLDEN
        x ^= x >> np.uint64(32)
    order = np.argsort(x, kind="stable")
    same = np.concatenate([[False], x[order[1:]] == x[order[:-1]]])
    if same.any():
        place = np.arange(n)
        number = np.empty(n, np.uint64)
        number[order] = (place - np.maximum.accumulate(np.where(same, 0, place))).astype(np.uint64)
        x = x + number * _GOLDEN
    return _mixed(x)


def sketch(codes: np.ndarray) -> np.ndarray:
    """The SIGNATURES components, 32 bits each; all 0 for an empty text."""
    x = items(codes)
    if not len(x):
        return np.zeros(SIGNATURES, np.uint32)
    best, at = None, None
    for i in range(0, len(x), PIECE):
        hashed = x[None, i:i + PIECE] * _MULTIPLIERS[:, None]
        low, where = [], []
        for _ in range(min(TUPLE, hashed.shape[1])):
            m = hashed.argmin(axis=1)
            low.append(np.take_along_axis(hashed, m[:, None], 1)[:, 0])
            where.append(m + i)
            np.put_along_axis(hashed, m[:, None], np.uint64(0xFFFFFFFFFFFFFFFF), 1)
        low, where = np.array(low).T, np.array(where).T
        if best is not None:
            low, where = np.concatenate([best, low], 1), np.concatenate([at, where], 1)
            keep = np.argsort(low, axis=1, kind="stable")[:, :TUPLE]
            low, where = np.take_along_axis(low, keep, 1), np.take_along_axis(where, keep, 1)
        best, at = low, where
    out = np.full(SIGNATURES, 1, np.uint64)
    for column in np.sort(at, axis=1).T:
        out = _mixed((out ^ x[column]) * _GOLDEN)
    return (out >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def text_codes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)


class Row(NamedTuple):
    """A document on its way through chain(): id, code points, sketch."""

    doc_id: object
    codes: np.ndarray
    sketch: np.ndarray


def _row(doc_id, text: str | None) -> Row:
    codes = text_codes(text)
    return Row(doc_id, codes, sketch(codes))


def edited_codes(this: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last floor(n / 4) code points replaced by the first as many (or all) of the next text."""
    n = len(this) // 4
    return np.concatenate([this[:len(this) - n], following[:n]]) if n else this


def _answer(row: Row, following: Row) -> tuple:
    codes = edited_codes(row.codes, following.codes)
    edited = row.sketch if codes is row.codes else sketch(codes)
    return (len(row.codes), codes.tobytes().decode("utf-32-le"), row.sketch.tobytes().hex(), edited.tobytes().hex(),
            likeness(row.sketch, edited), likeness(row.sketch, following.sketch))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row
    of ``docs``: the fingerprint of each text and of its edited text, and how like it is to the
    edited text's and to the next text's.

    Next is by doc_id, then text (nulls first); the last row's next is the first row. The rows are sorted
    across the cluster and walked in order, each beside the one after it. Where a partition ends
    the next text lies in another: every partition also writes its first and last row, and
    those two rows per partition are joined by partition number. Null texts are empty ones; a lone
    row is its own next; repeated rows follow each other.
    """
    spark = docs.sparkSession
    slim = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = slim.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("role", T.StringType()), T.StructField("doc_id", kind),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                           *[T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")]])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        part, last, last_text = TaskContext.get().partitionId(), None, None

        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

        for batch in batches:
            found = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = _row(doc_id, text)
                if last is None:
                    found.append((part, "first", doc_id, text) + (None,) * 6)
                else:
                    n, edited, *rest = _answer(last, row)
                    found.append((part, "done", last.doc_id, None, n, hashlib.sha256(edited.encode()).hexdigest(), *rest))
                last, last_text = row, text
                if len(found) >= 1024:
                    yield rows(found)
                    found = []
            if found:
                yield rows(found)
        if last is not None:
            yield rows([(part, "last", last.doc_id, last_text) + (None,) * 6])

    walked = materialize(map_arrow(slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"), walk, schema), "op5")
    ends = walked.filter("role != 'done'").select("part", "role", "doc_id", "text")
    done = walked.filter("role = 'done'").drop("part", "role", "text")
    # Partition numbers, in order: two small rows each, without their texts.
    parts = [r["part"] for r in ends.filter("role = 'first'").select("part").orderBy("part").collect()]
    follows = spark.createDataFrame([(p, q) for p, q in zip(parts, parts[1:] + parts[:1])], "part int, next_part int")
    borders = (ends.filter("role = 'last'").join(F.broadcast(follows), "part")
               .join(ends.filter("role = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text")), "next_part")
               .select("doc_id", "text", "next_text"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(closing)
        for batch in batches:
            found = []
            for doc_id, text, following in zip(*(c.to_pylist() for c in batch.columns)):
                n, edited, *rest = _answer(_row(doc_id, text), _row(None, following))
                found.append((doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), *rest))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    closing = T.StructType([f for f in schema if f.name not in ("part", "role", "text")])
    return done.unionByName(map_arrow(borders, close, closing))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(load(spark, sf_dir, "documents"))
