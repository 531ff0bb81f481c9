"""Token ids in binary files, coded by an adaptive context-mixing range coder (mixing_coder.py).

Texts are dealt by range of doc_id and sorted, so that the parts of the table hold the ids in
ascending order. A part is written as files of one *segment* each. A segment holds whole documents:

    magic, sizes, ids of the part before it    the documents' keys and lengths, the words' lengths, the
    and crc32 of the table                     blocks' sizes and checksums, compressed                     the blocks

The writer cuts texts into the words of the tokenizer. The ids of a segment's different words are coded first, then the numbers of the
words of its documents, so that an id is coded once for each word and a word once for each place.

A block holds up to BLOCK ids or numbers, is coded on its own and has their crc32, so a damaged block is found and
costs no other one. Files are written and committed by Spark (a row of its text writer is a segment, and a line feed
ends it) and read by its binary-file source, so they can be in any store that Spark reaches.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path

from .byte_bpe import ByteBpe, byte_bpe, byte_bpe_path
from .common import load, map_arrow, materialize, pick
from .mixing_coder import BLOCK, WIDEST, decode, encode

MAGIC = b"LLTOKMX2"
#: part, segment, ids of the part before, documents, words (0: documents are ids), ids and numbers, blocks, ids of a block, bits of an id, bytes and crc32 of the table.
HEAD = struct.Struct("<8sIIQQQQIIIII")
#: Blocks coded side by side, about. A segment is closed at so many blocks.
LANES = 4096
#: Bytes of text cut into words at once (a longer text alone).
CUT_BYTES = 1 << 23
END = 0


class DamagedSegment(ValueError):
    """A file whose table or whose blocks do not have their checksum."""


def _lanes(blocks: int) -> int:
    return -(-blocks // max(1, round(blocks / LANES))) or 1


def _pack(part: int, segment: int, before: int, keys: list[str | None], lengths: np.ndarray, numbers: np.ndarray, words: list[bytes]) -> bytes:
    """A segment of documents whose ``lengths`` add up to ``numbers``: of ``words`` (ids of 32 bits), or ids if there are none."""
    sizes = np.array([*map(len, words)], "<u4") // 4
    whole = np.concatenate([np.frombuffer(b"".join(words), np.uint32).astype(np.int64), numbers])
    length = min(BLOCK, max(1, len(whole)))
    width = max(1, int(whole.max(initial=0)).bit_length())
    if width > WIDEST:
        raise ValueError(f"ids of over {WIDEST} bits")
    blocks = -(-len(whole) // length)
    rows = np.concatenate([whole, np.zeros(blocks * length - len(whole), whole.dtype)]).reshape(blocks, length)
    lanes = _lanes(blocks)
    payloads = [p for i in range(0, blocks, lanes) for p in encode(rows[i:i + lanes], width)]
    sums = [zlib.crc32(row) for row in rows.astype("<u4")]
    table = zlib.compress(json.dumps(keys).encode() + b"\n" + lengths.astype("<u8").tobytes() + sizes.tobytes()
                          + np.array([len(p) for p in payloads], "<u4").tobytes() + np.array(sums, "<u4").tobytes(), 1)
    head = HEAD.pack(MAGIC, part, segment, before, len(keys), len(words), len(whole), blocks, length, width, len(table), zlib.crc32(table))
    return head + table + b"".join(payloads)


def _unpack(data: bytes) -> tuple[int, int, int, list[str | None], np.ndarray, np.ndarray]:
    """(part, segment, ids of the part before, keys, how many ids each document has, ids of 32 bits) of _pack()."""
    if len(data) < HEAD.size or data[:8] != MAGIC:
        raise DamagedSegment("no segment")
    _, part, segment, before, docs, words, total, blocks, length, width, size, check = HEAD.unpack_from(data)
    table, at = data[HEAD.size:HEAD.size + size], HEAD.size + size
    if zlib.crc32(table) != check:
        raise DamagedSegment(f"the table of part {part}, segment {segment}")
    keys, table = zlib.decompress(table).split(b"\n", 1)
    lengths, word_sizes = np.frombuffer(table, "<u8", docs).astype(np.int64), np.frombuffer(table, "<u4", words, 8 * docs).astype(np.int64)
    sizes, sums = np.frombuffer(table, "<u4", 2 * blocks, 8 * docs + 4 * words).reshape(2, blocks).astype(np.int64)
    ends = at + np.cumsum(sizes)
    rows, lanes = np.zeros((blocks, length), np.uint32), _lanes(blocks)
    for i in range(0, blocks, lanes):
        rows[i:i + lanes] = decode([data[e - s:e] for e, s in zip(ends[i:i + lanes], sizes[i:i + lanes])], length, width)
    bad = [i for i, row in enumerate(rows.astype("<u4", copy=False)) if zlib.crc32(row) != sums[i]]
    if bad:
        raise DamagedSegment(f"blocks {bad[:9]} of part {part}, segment {segment}")
    ids = rows.ravel()[:total]
    if words:
        spelled, numbers = np.split(ids, [word_sizes.sum()])
        offsets = pa.py_buffer(np.r_[0, 4 * np.cumsum(word_sizes)])
        joined = pa.Array.from_buffers(pa.large_binary(), words, [None, offsets, pa.py_buffer(spelled)]).take(pa.array(numbers))
        ids = np.frombuffer(joined.buffers()[2], np.uint32)
        lengths = np.diff(np.r_[0, np.cumsum(word_sizes[numbers])][np.r_[0, np.cumsum(lengths)]])
    return part, segment, before, json.loads(keys), lengths, ids


def pack(part: int, segment: int, before: int, keys: list[str | None], ids: list[np.ndarray]) -> bytes:
    """A segment of documents (key, ids)."""
    lengths, numbers = np.array([len(x) for x in ids], np.int64), np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
    return _pack(part, segment, before, keys, lengths, numbers, [])


def unpack(data: bytes) -> tuple[int, int, int, list[str | None], list[np.ndarray]]:
    """(part, segment, ids of the part before, keys, ids) of a segment."""
    part, segment, before, keys, lengths, ids = _unpack(data)
    return part, segment, before, keys, np.split(ids.astype(np.int64), np.cumsum(lengths)[:-1]) if keys else []


class _Segment:
    """The documents that a writer has for its next segment, in words."""

    def __init__(self, bpe: ByteBpe):
        self.bpe, self.keys, self.lengths, self.numbers = bpe, [], [], []
        self.known, self.words, self.symbols = {}, [], 0
        self.end = self.learn([b"\xff"], [np.array([END], np.uint32).tobytes()])

    def learn(self, words: list[bytes], ids: list[bytes]) -> int:
        """Numbers new words; the first one's number."""
        first = len(self.words)
        self.known.update(zip(words, range(first, first + len(words))))
        self.words += ids
        self.symbols += sum(map(len, ids)) // 4
        return first

    def add(self, keys: list[str | None], texts: pa.Array) -> None:
        words, plain, places, counts = self.bpe.units(texts)
        numbers = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        unknown = [words[i] for i in new.tolist()]
        numbers[new] = np.arange(len(new)) + self.learn(unknown, self.bpe.spelled(unknown, int((new < plain).sum())))
        numbers = numbers[places]
        numbers = np.insert(numbers, np.cumsum(counts), self.end)
        self.keys += keys
        self.lengths.append(counts + 1)
        self.numbers.append(numbers)
        self.symbols += len(numbers)

    def packed(self, part: int, segment: int, before: int) -> tuple[bytes, int]:
        """The segment, and how many ids its documents have."""
        numbers = np.concatenate(self.numbers)
        total = int((np.array([*map(len, self.words)], np.int64) // 4)[numbers].sum())
        return _pack(part, segment, before, self.keys, np.concatenate(self.lengths), numbers, self.words), total


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Encodes the texts of ``docs``, appends END to each, and writes the files to ``path``.

    Null and empty texts have END alone; equal ids keep the order of the input, null ids come first; repeated rows
    are documents of their own; a very long text makes its segment longer, and about LANES blocks of it are coded at a time; only doc_id and
    text are read; an empty table gives no segment.
    """
    tokenizer = tokenizer or byte_bpe_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, segment, before = byte_bpe(tokenizer, True), TaskContext.get().partitionId(), 0, 0
        now = _Segment(bpe)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).fill_null("")
            ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
            at = 0
            while at < len(keys):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CUT_BYTES, "right")))
                now.add(keys[at:to], texts.slice(at, to - at))
                at = to
                if now.symbols >= LANES * BLOCK:
                    data, total = now.packed(part, segment, before)
                    segment, before, now = segment + 1, before + total, _Segment(bpe)
                    yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["segment"])
        if now.keys:
            yield pa.RecordBatch.from_arrays([pa.array([now.packed(part, segment, before)[0]], pa.binary())], names=["segment"])

    slim = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string"), F.monotonically_increasing_id().alias("row"))
    dealt = slim.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select(F.col("doc_id").cast("string"), "text")
    made = map_arrow(dealt, run, "segment binary")
    made.select(F.col("segment").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read_token_files(spark: SparkSession, path: str, kind: str = "bigint", with_ids: bool = True) -> DataFrame:
    """(doc_id, part, start_in_part, n_tokens, ids_crc32, ids array<int>) of the documents in the files; ``kind`` is the type of doc_id.
    Every id is decoded and checked, also ``with_ids`` off, when only the column is left out. A damaged segment raises DamagedSegment."""
    schema = "doc_id string, part int, start_in_part bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                if not (data := data.as_py()):
                    continue
                part, _, before, keys, n, ids = _unpack(data[:-1])
                ends, said = np.cumsum(n), memoryview(ids.astype("<u4", copy=False)).cast("B")
                sums = [zlib.crc32(said[4 * a:4 * b]) for a, b in zip((ends - n).tolist(), ends.tolist())]
                columns = [pa.array(keys, pa.string()), pa.array([part] * len(keys), pa.int32()), pa.array(before + ends - n), pa.array(n), pa.array(sums, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.r_[0, ends].astype(np.int32), ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return map_arrow(files, run, schema).withColumn("doc_id", F.col("doc_id").cast(kind))


def token_starts(rows: DataFrame) -> DataFrame:
    """Written rows of read_token_files() with ``start``, the number of ids of all documents before. Only one total per
    part comes to the driver; their number is that of the writer's partitions."""
    totals = sorted((r["part"], r["n"]) for r in rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    starts, at = [], 0
    for part, n in totals:
        starts.append((part, at))
        at += n
    parts = rows.sparkSession.createDataFrame(starts, "part int, part_start bigint")
    return rows.join(parts, "part").withColumn("start", F.col("part_start") + F.col("start_in_part"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = load(spark, sf_dir, "documents"), scratch_path(spark, "token_files")
    write_token_files(docs, path)
    rows = read_token_files(spark, path, dict(docs.dtypes)["doc_id"], with_ids=False)
    return token_starts(materialize(rows, "token_rows")).select("doc_id", "start", "n_tokens", "ids_crc32")
