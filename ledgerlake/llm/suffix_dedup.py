"""Removal of repeated byte strings by prefix-free parsing.

A text is parsed at triggers: a window of WINDOW bytes is a trigger if its rolling hash is the least (the last of
equals) among all windows of some LENGTH-byte string. Every string of LENGTH bytes holds such a trigger and
equal strings hold it at the same place, so a string is named by the trigger, what stands left of it (a
phrase suffix) and what follows (the parse). Only order up to the first LENGTH bytes matters here, and in it only
which strings are equal. So phrase suffixes and parse suffixes get names, hashes that group like ranks, where a
suffix array would sort them: grouping is combined before each shuffle and no task gets all copies of a hot string.

The names are refined from coarse to fine, and what a coarse name settles goes no further:
1. a trigger's window: unless another trigger has it, none of its strings repeats; its whole context
   (all bytes of all strings that it may name): if that repeats, all do;
2. for one trigger of each context where windows agree but contexts differ: the same with blocks of neighbouring strings,
   which are known by the bytes that all of them share;
3. single strings of the blocks that stay open.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_key, key_columns, load, map_arrow, materialize

LENGTH, WINDOW = 200, 64
REACH = LENGTH - WINDOW  # a string starts at most this far before its trigger
WIDTH = REACH + LENGTH
#: Neighbouring strings in a block, from coarse to fine; each divides the one before.
BLOCKS = (16, 1)
#: String starts looked at in one array operation.
PIECE = 1 << 18

_random = np.random.default_rng(1)
_TABLE = _random.integers(0, 1 << 64, (2, 256), dtype=np.uint64)
_BASE = _random.integers(1 << 62, 1 << 63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_G1, _G2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_LOW32, _HIGH32 = np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, base))])


_SIZE = PIECE + 4 * WIDTH
_POWER = np.array([_powers(b, _SIZE) for b in _BASE])
_INVERSE = np.array([_powers(np.uint64(pow(int(b), -1, 1 << 64)), _SIZE) for b in _BASE])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _G2
    return x ^ (x >> np.uint64(29))


def _sums(data: np.ndarray, k: int) -> np.ndarray:
    """Running sums of the k-th rolling hash along the last axis."""
    out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
    np.cumsum(_TABLE[k][data] * _POWER[k][:data.shape[-1]], axis=-1, out=out[..., 1:])
    return out


def _between(sums: np.ndarray, start, end, k: int) -> np.ndarray:
    """Hash of the bytes start..end of a text, the same wherever they stand."""
    return _mixed((sums[end] - sums[start]) * _INVERSE[k][start])


def _least(keys: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` neighbouring keys: of the end of one block of that size and the beginning of the next."""
    n = len(keys)
    grid = np.full(-(-n // size) * size, 0xFFFFFFFFFFFFFFFF, np.uint64)
    grid[:n] = keys
    grid = grid.reshape(-1, size)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - size + 1], ahead[size - 1:n])


def triggers(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place, first start, last start, window name, context name) of each trigger of a text: it names the strings that
    start from the first to the last start. The context name covers the bytes from REACH before the trigger
    to LENGTH after it, as far as the text goes, and how far it goes."""
    n, parts, begin = len(data), [], 0
    while begin <= n - LENGTH:
        end = min(begin + PIECE, n - LENGTH + 1)
        left = max(0, begin - REACH)
        piece = data[left:min(n, end + WIDTH + LENGTH)]
        sums = _sums(piece, 0)
        i, j = begin - left, end - left + REACH  # the windows' starts
        names = _mixed((sums[i + WINDOW:j + WINDOW] - sums[i:j]) * _INVERSE[0][i:j])
        # The window's name decides, then its place: the last of equal ones.
        keys = (names & _HIGH32) | (_LOW32 - np.arange(i, j, dtype=np.uint64))
        chosen = (_LOW32 - (_least(keys, REACH + 1) & _LOW32)).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        if end < n - LENGTH + 1 and len(cuts) > 1:  # the last trigger may go on in the next piece
            end = begin + int(cuts[-1])
            cuts, last = cuts[:-1], cuts[1:] - 1
        else:
            last = np.append(cuts[1:], len(chosen)) - 1
        at = chosen[cuts]
        lo, hi = np.maximum(at - REACH, 0), np.minimum(at + LENGTH, len(piece))
        reach = ((at - lo) << 16 | (hi - at)).astype(np.uint64)
        whole = _mixed(_between(_sums(piece, 1), lo, hi, 1) ^ (reach * _G1))
        parts.append((at + left, cuts + begin, last + begin, names[at - (begin - left)], whole))
        begin = end
    if not parts:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _packed(at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place, and how far before it the strings start at most and at least, in one number."""
    return at << 16 | (at - first) << 8 | (at - last)


def _kinds(df: DataFrame) -> str:
    return f"doc_id {dict(df.dtypes)['doc_id']}, rid long"


def _data(text: pa.Scalar) -> np.ndarray:
    return np.frombuffer(text.as_buffer() or b"", np.uint8) if text.is_valid else np.zeros(0, np.uint8)


def _parsed(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, place, window, context): a row per trigger."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                found = [triggers(_data(t)) for t in part.column(2)]
                owner = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
                at, first, last, window, whole = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(owner), part.column(1).take(owner), pa.array(_packed(at, first, last), pa.int64()),
                     pa.array(window.view(np.int64)), pa.array(whole.view(np.int64))],
                    names=["doc_id", "rid", "place", "window", "context"])

    return map_arrow(docs, run, f"{_kinds(docs)}, place long, window long, context long")


class Contexts:
    """A batch of contexts as a matrix, aligned at their triggers: column REACH is the trigger's first byte."""

    def __init__(self, batch: pa.RecordBatch):
        place = batch.column("place").to_numpy(zero_copy_only=False)
        self.most, self.least = place >> 8 & 0xFF, place & 0xFF
        self.left = batch.column("left").to_numpy(zero_copy_only=False).astype(np.int64)
        raw = [np.frombuffer(x.as_buffer(), np.uint8) for x in batch.column("bytes")]
        self.right = np.array([len(x) for x in raw], np.int64) - self.left
        grid = np.zeros((len(raw), WIDTH), np.uint8)
        for row, (x, left) in enumerate(zip(raw, self.left.tolist())):
            grid[row, REACH - left:REACH - left + len(x)] = x
        self.sums = [_sums(grid, k) for k in (0, 1)]
        self.rows = np.arange(len(raw))

    def name(self, k: int, start: np.ndarray, end: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[k][rows, end] - self.sums[k][rows, start]) * _INVERSE[k][start])

    def blocks(self, near: int, size: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(those of the rows that have a string from ``near`` to ``near + size - 1`` bytes before the trigger, name of the bytes
        that all these strings share, name of all their bytes). One string has two names of the same bytes."""
        far = min(near + size - 1, REACH)
        rows = rows[(self.least[rows] <= far) & (self.most[rows] >= near)]
        start, end = np.maximum(REACH - far, REACH - self.left[rows]), np.minimum(REACH - near + LENGTH, REACH + self.right[rows])
        reach = (start << 16 | end).astype(np.uint64)
        shared = self.name(0, np.full(len(rows), REACH - near), np.full(len(rows), REACH - far + LENGTH), rows)
        # Only one place before the trigger can give equal strings, so it is part of the name.
        return rows, _mixed(shared ^ np.uint64(near << 8 | size)), _mixed(self.name(1, start, end, rows) ^ (reach * _G1))


def _settled(rows: DataFrame, coarse: str, fine: str) -> DataFrame:
    """(coarse, mixed): the coarse names that repeat, and whether under one of them the fine names differ."""
    return (rows.groupBy(coarse).agg(F.count(F.lit(1)).alias("_n"), F.min(fine).alias("_a"), F.max(fine).alias("_b"))
            .filter("_n > 1").select(coarse, (F.col("_a") != F.col("_b")).alias("mixed")))


def _block_rows(contexts: DataFrame, size: int, within: int) -> DataFrame:
    """(context, near, shared, whole): the blocks of ``size`` strings of each context, inside its open blocks of ``within``
    strings (``open`` lists where they begin) or, where ``within`` is 0, all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                c, bits = Contexts(part), None
                if within:
                    bits = part.column("open").to_numpy(zero_copy_only=False)
                for near in range(0, REACH + 1, size):
                    rows, shared, whole = c.blocks(near, size, c.rows[bits >> near // within & 1 == 1] if within else c.rows)
                    if len(rows):
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), near, np.int32)),
                             pa.array(shared.view(np.int64)), pa.array(whole.view(np.int64))], names=["context", "near", "shared", "whole"])

    columns = ["context", "place", "left", "bytes", *["open"] * bool(within)]
    return map_arrow(contexts.select(*columns), run, "context long, near int, shared long, whole long")


def _repeated(contexts: DataFrame) -> DataFrame:
    """(context, near, size): blocks of strings that repeat, all of each."""
    out, live, within = None, contexts, 0
    for size in BLOCKS:
        rows = _block_rows(live, size, within)
        if size == 1:  # both names are the string's own
            twice = rows.groupBy("shared", "whole").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("shared", "whole")
            done = rows.join(twice, ["shared", "whole"])
        else:
            told = materialize(rows.join(_settled(rows, "shared", "whole"), "shared").select("context", "near", "mixed"), "op1-told")
            done = told.filter("NOT mixed")
            opened = told.filter("mixed").groupBy("context").agg(F.bit_or(F.expr(f"shiftleft(1L, near div {size})")).alias("open"))
            live, within = contexts.join(opened, "context"), size
        done = done.select("context", "near", F.lit(size).alias("size"))
        out = done if out is None else out.unionAll(done)
    return out


def spans(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings that start in the ranges (first, last)."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], last + LENGTH)
        else:
            out.append((first, last + LENGTH))
    return out


def _row(data: bytes, ranges: list[tuple[int, int]]) -> tuple[int, list, str, str]:
    cut, kept, at = spans(ranges), [], 0
    for start, end in cut:
        kept.append(data[at:start])
        at = end
    kept.append(data[at:])
    rest = b"".join(kept)
    return len(data), [{"start": s, "end": e} for s, e in cut], hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "replace")


_RESULT = "n_bytes long, spans array<struct<start:long,end:long>>, kept_sha256 string"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _starts(places: list[int] | None) -> list[tuple[int, int]]:
    return [((p >> 16) - (p >> 8 & 0xFF), (p >> 16) - (p & 0xFF)) for p in places or ()]


def _block_starts(found: list[dict] | None) -> list[tuple[int, int]]:
    """The starts of the strings of each context's blocks, as ranges."""
    out = []
    for x in found or ():
        at, most, least = x["place"] >> 16, x["place"] >> 8 & 0xFF, x["place"] & 0xFF
        out += [(at - min(most, b["near"] + b["size"] - 1), at - max(least, b["near"])) for b in x["blocks"]]
    return out


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans array<struct<start, end>>, kept_sha256) per row of ``docs``: the maximal runs of bytes covered by
    LENGTH-byte strings that start anywhere else too, and a digest of the other bytes.

    Null texts are empty ones; texts shorter than LENGTH bytes repeat nothing. Repeated rows are copies of each other, so all
    of a long one goes. Ids may be null; only doc_id and text are read. Texts of any length are read piece by piece.
    """
    keyed = key_columns(docs).select("doc_id", "rid", F.col("text").cast("binary").alias("text"))
    parsed = _parsed(keyed)
    repeated = materialize(_settled(parsed, "window", "context"), "op1-windows")
    matched = materialize(parsed.join(repeated, "window"), "op1-triggers")
    mixed = matched.filter("mixed")
    classes = materialize(mixed.groupBy("window", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid", "place")).alias("first")), "op1-classes")
    whole = (matched.filter("NOT mixed").select("doc_id", "rid", "place")
             .unionAll(mixed.join(classes.filter("n > 1"), ["window", "context"], "left_semi").select("doc_id", "rid", "place")))
    per_doc = (whole.withColumn("look", F.lit(False))
               .unionAll(classes.select("first.doc_id", "first.rid", "first.place", F.lit(True)))
               .groupBy("doc_id", "rid").agg(F.collect_list(F.when(~F.col("look"), F.col("place"))).alias("whole"),
                                             F.collect_list(F.when(F.col("look"), F.col("place"))).alias("look")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts with nothing left to look at are done; of the others the text and the contexts go on."""
        names = ["role", "doc_id", "rid", "text", "whole", "place", "left", "bytes", "n_bytes", "spans", "kept_sha256"]
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                rows = []
                for k, (text, full, look) in enumerate(zip(part.column(2), part.column(3).to_pylist(), part.column(4).to_pylist())):
                    data = text.as_py()
                    if not look:
                        rows.append((k, "done", None, None, None, None, None, *_row(data, _starts(full))[:3]))
                        continue
                    rows.append((k, "open", data, full, None, None, None, None, None, None))
                    for p in look:
                        at = p >> 16
                        left = min(at, REACH)
                        rows.append((k, "context", None, None, p, left, data[at - left:at + LENGTH], None, None, None))
                owner, role, *rest = zip(*rows)
                kinds = [pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary(), pa.int64(), _SPANS, pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(role), part.column(0).take(pa.array(owner)), part.column(1).take(pa.array(owner)),
                                                  *[pa.array(v, t) for v, t in zip(rest, kinds)]], names=names)

    split = materialize(map_arrow(
        join_key(keyed, per_doc).select("doc_id", "rid", "text", "whole", "look"), cut,
        f"role string, {_kinds(keyed)}, text binary, whole array<long>, place long, left int, bytes binary, {_RESULT}")
        .withColumn("context", F.monotonically_increasing_id()), "op1-split")
    # A repeated row gives its contexts again; they repeat, so their strings do.
    contexts = split.filter("role = 'context'").select("context", "doc_id", "rid", "place", "left", "bytes")
    blocks = _repeated(contexts).groupBy("context").agg(F.collect_list(F.struct("near", "size")).alias("blocks"))
    more = (contexts.select("context", "doc_id", "rid", "place").join(blocks, "context")
            .groupBy("doc_id", "rid").agg(F.collect_list(F.struct("place", "blocks")).alias("more")))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(t, _starts(w) + _block_starts(m))[:3]
                    for t, w, m in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))]
            n, cuts, digest = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(cuts, _SPANS), pa.array(digest, pa.string())],
                                             names=["doc_id", "n_bytes", "spans", "kept_sha256"])

    rest = join_key(split.filter("role = 'open'").select("doc_id", "rid", "text", "whole"), more).select("doc_id", "text", "whole", "more")
    done = split.filter("role = 'done'").select("doc_id", "n_bytes", "spans", "kept_sha256")
    return done.unionAll(map_arrow(rest, finish, f"doc_id {dict(keyed.dtypes)['doc_id']}, {_RESULT}"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(load(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
