"""Benchmark decontamination by the q-gram lemma.

A text region within e edits of a probe of m characters shares at least m - q + 1 - q * e q-grams with
it, on diagonals (place in the text minus place in the probe) that lie at most e apart. Shared
q-grams are counted in overlapping bands of diagonals; only bands that meet the bound are kept
and verified by a banded alignment. Probes are the benchmark items, long ones as overlapping windows,
so that a copied part of an item is found too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import load, map_arrow, pick, ship, to_blocks

Q, ERRORS = 10, 0.08
#: Code points of a probe, about 14 words, and the step between the probes of a long item: any PROBE + STEP - 1 code
#: points of it hold a whole probe.
PROBE, STEP = 80, 16
#: Bytes of benchmark text that are broadcast at once; a larger benchmark is matched block by block.
BLOCK_BYTES = 16 << 20
#: Shared q-grams and code points looked at in one array operation.
HITS, PIECE = 1 << 20, 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


def _codes(text: str) -> np.ndarray:
    """Code points, letters in lower case and white space as blanks where that is one code point each, so that
    places stay."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32)
    return np.where((codes == 10) | (codes == 9) | (codes == 13) | (codes == 160), np.uint32(32), codes)


def _grams(codes: np.ndarray) -> np.ndarray:
    n = len(codes) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = np.zeros(n, np.uint64)
    for i in range(Q):
        x = (x ^ codes[i:i + n]) * _BASE
        x ^= x >> np.uint64(31)
    return x


class Index:
    """q-grams of the probes of some items: ``grams`` sorted, ``first[k]:first[k + 1]`` the (probe, place) pairs of the
    k-th. Items shorter than 2 * Q code points are too short to tell a copy from chance and are left out."""

    def __init__(self, items: list[tuple[int, str]], errors: float = ERRORS):
        texts: dict[str, list[int]] = {}
        for item_id, text in items:
            texts.setdefault(text, []).append(item_id)
        self.items, self.probes, self.codes, offsets = list(texts.values()), [], [], []
        grams, places = [], []
        for k, text in enumerate(texts):
            codes = _codes(text)
            if len(codes) < 2 * Q:
                continue
            for at in sorted({*range(0, max(1, len(codes) - PROBE), STEP), max(0, len(codes) - PROBE)}):
                part = codes[at:at + PROBE]
                g = _grams(part)
                grams.append(g)
                offsets.append(np.full(len(g), len(self.probes)))
                places.append(np.arange(len(g)))
                self.probes.append(k)
                self.codes.append(part)
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.grams, start = np.unique(flat[order], return_index=True)
        self.first = np.append(start, len(flat))
        self.probe = np.concatenate(offsets)[order] if grams else np.zeros(0, int)
        self.place = np.concatenate(places)[order] if grams else np.zeros(0, int)
        size = np.array([len(c) for c in self.codes], int)
        # Edits allowed, at most as many as leave one shared q-gram to look for.
        self.edits = np.minimum((errors * size).astype(int), (size - Q) // Q)
        self.needed = size - Q + 1 - Q * self.edits
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[self.grams >> np.uint64(64 - _BITS)] = True

    def _shared(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number of the q-gram) of each q-gram of the text that a probe has, where enough of them lie within
        reach of one probe. ``maybe`` tells most others apart before the search."""
        places, numbers = [], []
        for begin in range(0, max(0, len(codes) - Q + 1), PIECE):
            g = _grams(codes[begin:begin + PIECE + Q - 1])
            at = np.flatnonzero(self.maybe[g >> np.uint64(64 - _BITS)])
            k = np.searchsorted(self.grams, g[at])
            k[k == len(self.grams)] = 0
            same = self.grams[k] == g[at]
            places.append(at[same] + begin)
            numbers.append(k[same])
        at, k = (np.concatenate(x) if x else np.zeros(0, int) for x in (places, numbers))
        least, reach = int(self.needed.min()), PROBE + int(self.edits.max())
        first = np.flatnonzero(at[least - 1:] - at[:len(at) - least + 1] <= reach) if len(at) >= least else np.zeros(0, int)
        cover = np.zeros(len(at) + 1, int)
        cover[first] += 1
        np.add.at(cover, first + least, -1)
        near = np.cumsum(cover)[:-1] > 0
        return at[near], k[near]

    def bands(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """(probe, first diagonal) of each band with enough shared q-grams. Bands of a probe are twice
        edits + 1 wide and start every edits + 1, so any run of diagonals that edits can cause lies in one."""
        at, k = self._shared(codes)
        each = self.first[k + 1] - self.first[k]
        ends = np.cumsum(each)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        i = 0
        while i < len(at):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + HITS, side="right")))
            n = each[i:j]
            posting = np.repeat(self.first[k[i:j]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            probe = self.probe[posting]
            diagonal = np.repeat(at[i:j], n) - self.place[posting] + 2 * PROBE  # so that no band is negative
            band = probe.astype(np.int64) << 40 | diagonal // (self.edits[probe] + 1)
            keys, where = np.unique(np.concatenate([keys, band, band - 1]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([counts, np.ones(2 * len(band), np.int64)])).astype(np.int64)
            i = j
        probe, band = keys >> 40, keys & ((1 << 40) - 1)
        enough = counts >= self.needed[probe]
        probe, band = probe[enough], band[enough]
        return list(zip(probe.tolist(), (band * (self.edits[probe] + 1) - 2 * PROBE).tolist()))

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, edits) of each item with a region within the edit budget of one of its probes: from the
        first to the last such region, and the fewest edits."""
        if len(text) < Q or not len(self.grams):
            return []
        codes = _codes(text)
        best: dict[int, tuple[int, int, int]] = {}
        for probe, diagonal in self.bands(codes):
            hit = align(self.codes[probe], codes, diagonal, 2 * int(self.edits[probe]) + 1, int(self.edits[probe]))
            if hit:
                old = best.get(self.probes[probe], hit)
                best[self.probes[probe]] = (min(old[0], hit[0]), max(old[1], hit[1]), min(old[2], hit[2]))
        hits = [(item_id, *span) for k, span in best.items() for item_id in self.items[k]]
        return sorted(hits, key=lambda h: (h[0] is None, 0 if h[0] is None else h[0], h[1:]))


def _ends(probe: np.ndarray, text: np.ndarray, diagonal: int, width: int, free: bool, edits: int) -> np.ndarray:
    """Edits of the best alignment of the whole probe that ends on each diagonal of the band. It starts anywhere on the
    band if ``free``, else at the text's start. The table ends early where all alignments take more than ``edits``. Row i of the table has the text places i + diagonal ... i + diagonal + width."""
    m, n, far = len(probe), len(text), 1 << 20
    steps = np.arange(width + 1)
    padded = np.full(m + width + 1, 0xFFFFFFFF, np.uint32)
    lo, hi = max(0, diagonal), min(n, diagonal + m + width + 1)
    if hi > lo:
        padded[lo - diagonal:hi - diagonal] = text[lo:hi]

    def outside(i: int) -> np.ndarray:
        return (steps + i + diagonal < 0) | (steps + i + diagonal > n)

    row = np.where(outside(0), far, 0 if free else steps + diagonal)
    for i in range(m):
        row = np.minimum(row + (padded[i:i + width + 1] != probe[i]), np.append(row[1:], far) + 1)
        row[outside(i + 1)] = far
        row = np.minimum.accumulate(row - steps) + steps
        if not i & 3 and row.min() > edits:
            break
    return row


def align(probe: np.ndarray, text: np.ndarray, diagonal: int, width: int, edits: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best alignment of the probe within the band, widened by the edits, or None if
    it takes more than ``edits``."""
    low, wide = diagonal - edits, width + 2 * edits
    # A verbatim copy needs no table.
    begin = max(0, low)
    region, whole = text[begin:max(0, low + wide + len(probe))].tobytes(), probe.tobytes()
    at = region.find(whole)
    while at >= 0 and at % 4:
        at = region.find(whole, at + 1)
    if at >= 0:
        return begin + at // 4, begin + at // 4 + len(probe), 0
    row = _ends(probe, text, low, wide, True, edits)
    k = int(row.argmin())
    if row[k] > edits:
        return None
    end = len(probe) + low + k
    # Backwards from the end: where the same alignment starts.
    back = _ends(probe[::-1], text[max(0, end - len(probe) - edits):end][::-1], -edits, 2 * edits, False, edits)
    size = len(probe) - edits + int(back.argmin())
    return max(0, end - size), end, int(row[k])


def _items(bench: DataFrame, block: int, blocks: int) -> list[tuple[int, str]]:
    part = bench.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block) if blocks > 1 else bench
    return [(r["item_id"], r["text"]) for r in part.distinct().orderBy("item_id", "text").collect()]


def _indexes(spark: SparkSession, bench: DataFrame, errors: float, block_bytes: int) -> Iterator[Broadcast]:
    """The broadcast index of each block of the benchmark."""
    bench = pick(bench, "item_id", "text").filter("text IS NOT NULL")
    blocks = to_blocks(bench.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0, block_bytes)
    for block in range(blocks):
        yield spark.sparkContext.broadcast(Index(_items(bench, block, blocks), errors))


def contaminated(docs: DataFrame, bench: DataFrame, errors: float = ERRORS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, rid, item_id, start, end, edits): the benchmark items that each text contains, places in code points.

    ``rid`` is a hash of the text. The benchmark is a stated set of probes held against all texts, in blocks of a checked
    size. Null, empty and short texts contain none; repeated rows give repeated results, repeated items one
    result for each item_id; ids may be null; only doc_id, text and item_id, text are read.
    """
    spark = docs.sparkSession
    slim = pick(docs, "doc_id", "text").filter("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("rid"), "text")
    bench = pick(bench, "item_id", "text")
    schema = f"doc_id {dict(slim.dtypes)['doc_id']}, rid long, item_id {dict(bench.dtypes)['item_id']}, start long, end long, edits int"
    item_kind = to_arrow_type(bench.schema["item_id"].dataType)
    out = []
    for shared in _indexes(spark, bench, errors, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = [(i, *hit) for i, t in enumerate(batch.column(2)) for hit in shared.value.find(t.as_py())]
                if hits:
                    at, item, start, end, edits = zip(*hits)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(item, item_kind),
                         pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(edits, pa.int32())],
                        names=["doc_id", "rid", "item_id", "start", "end", "edits"])

        out.append(map_arrow(slim, run, schema))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _held_by(shared: Broadcast) -> Callable:
    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(t and shared.value.find(t)) for t in texts.tolist()], dtype=bool)

    return run


def holds(text: Column, spark: SparkSession, bench: DataFrame, errors: float = ERRORS, block_bytes: int = BLOCK_BYTES) -> Column:
    """Whether a text contains an item, by contaminated()'s rules: for stages that keep the other columns, without a join."""
    ship(spark)
    out = F.lit(False)
    for shared in _indexes(spark, bench, errors, block_bytes):
        out = out | _held_by(shared)(text)
    return out


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")).drop("rid")
