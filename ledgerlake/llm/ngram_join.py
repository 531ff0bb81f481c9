"""Similarity join on word shingles by MinHash with Bayesian candidate pruning.

Texts with equal shingle sets form one node. Nodes that agree on a band of MinHash values are
candidates. A candidate pair's values are compared a few at a time; after each step the posterior
probability that its Jaccard similarity reaches the threshold, given the matches so far, decides
whether the pair is dropped. The pairs that remain are verified exactly on their shingle sets.

No pair of a bucket is written out: a bucket's members are cut into blocks of bounded size, each
pair of blocks is one unit of work, and a unit returns one row per node: its number of links and
the unit's smallest node that it is linked with. A pair that meets in several bands counts in the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import key_columns, load, map_arrow, materialize
from .components import components

WORDS, THRESHOLD = 5, 0.8
#: A true pair shares none of the bands with probability (1 - t ** ROWS) ** BANDS: 5e-5 at t = 0.8.
BANDS, ROWS = 25, 5
VALUES = BANDS * ROWS
#: Values compared per step, and the posterior probability below which a pair is dropped.
STEP, TOLERANCE = 25, 1e-6
#: Bounds of a block: nodes, and shingles of all its nodes together.
BLOCK_NODES, BLOCK_SHINGLES = 1024, 1 << 22
#: Side of the rows of a unit of one block; in a unit of two blocks the sides are 0 and 1.
DIAGONAL = 2
_MULTIPLIERS = np.random.default_rng(9).integers(1 << 62, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_G1, _G2, _G3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(x: np.ndarray, by: np.uint64 = _G2) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * by
    return x ^ (x >> np.uint64(29))


class Shingles:
    """Distinct shingle hashes of texts; remembers words' hashes, a full table is emptied."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        """Sorted hashes of the runs of WORDS words (lower case, split at white space); a shorter text is one run."""
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > 300_000:
            self.known.clear()
        known = self.known
        for w in {*words}.difference(known):
            known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"))
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(WORDS, len(words))
        n = len(words) - size + 1
        x = np.full(n, size, np.uint64)
        for i in range(size):
            x = _mixed((x ^ codes[i:i + n]) * _G1)
        return np.unique(x)


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the minimum under each hash function."""
    low = np.full(VALUES, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[None, i:i + 4096] * _MULTIPLIERS[:, None]).min(axis=1))
    return (_mixed(low) >> np.uint64(48)).astype(np.uint16)


def node_id(shingles: np.ndarray) -> bytes:
    """128 bits that name the shingle set."""
    with np.errstate(over="ignore"):
        return np.array([_mixed(shingles, _G2).sum(), _mixed(shingles ^ _G1, _G3).sum()], np.uint64).tobytes()


@lru_cache(8)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For each number n of compared values the least matches m that keep a pair: the posterior of
    the similarity is Beta(m + 1, n - m + 1) from a flat prior, and P(similarity >= threshold) is the chance
    of at most m successes among n + 1 trials at the threshold."""
    out = []
    for n in range(VALUES + 1):
        chance, m = 0.0, 0
        for m in range(n + 1):
            chance += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if chance >= tolerance:
                break
        out.append(m)
    return tuple(out)


def surviving(sigs: np.ndarray, a: np.ndarray, b: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the index pairs (a, b) those that meet first in this band and are not dropped by the posterior."""
    least = least_matches()
    for k in range(band):
        apart = (sigs[a, k * ROWS:(k + 1) * ROWS] != sigs[b, k * ROWS:(k + 1) * ROWS]).any(axis=1)
        a, b = a[apart], b[apart]
    matches = np.zeros(len(a), np.int64)
    for at in range(0, VALUES, STEP):
        if not len(a):
            break
        matches += (sigs[a, at:at + STEP] == sigs[b, at:at + STEP]).sum(axis=1)
        keep = matches >= least[at + STEP]
        a, b, matches = a[keep], b[keep], matches[keep]
    return a, b


def _pairs(sides: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a unit, some rows at a time: each against the later ones, or side 0 against side 1. A unit of
    two blocks of which one is empty has none."""
    n = len(sides)
    cross = not (sides == DIAGONAL).any()
    first = np.flatnonzero(sides != 1)
    other = np.flatnonzero(sides == 1)
    step = max(1, (1 << 17) // max(1, n))
    for i in range(0, len(first), step):
        rows = first[i:i + step]
        if cross:
            yield np.repeat(rows, len(other)), np.tile(other, len(rows))
        else:
            a, b = np.repeat(rows, n), np.tile(np.arange(n), len(rows))
            later = b > a
            yield a[later], b[later]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each unit; the partition is sorted by unit and one unit's rows may span batches."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        unit = rest.column("unit").to_numpy()
        cuts = np.flatnonzero(unit[1:] != unit[:-1]) + 1
        if len(cuts):
            starts = [0, *cuts.tolist()]
            for i, j in zip(starts, starts[1:]):
                yield rest.slice(i, j - i)
            rest = rest.slice(starts[-1])
    if rest is not None:
        yield rest


def _matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _bayes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, band, side, node) of the nodes that have a surviving pair in their unit."""
    out = {"unit": [], "band": [], "side": [], "node": []}
    for unit in _units(batches):
        sides = unit.column("side").to_numpy()
        if len(sides) < 2:
            continue
        sigs, band = _matrix(unit.column("sig"), np.uint16), unit.column("band")[0].as_py()
        hit = np.zeros(len(sides), bool)
        for a, b in _pairs(sides):
            a, b = surviving(sigs, a, b, band)
            hit[a] = hit[b] = True
        for i in np.flatnonzero(hit).tolist():
            for name, values in out.items():
                values.append(unit.column(name)[i].as_py())
        if len(out["unit"]) >= 4096:
            yield _batch(out)
            out = {k: [] for k in out}
    if out["unit"]:
        yield _batch(out)


def _batch(columns: dict) -> pa.RecordBatch:
    kinds = {"unit": pa.int64(), "band": pa.int32(), "side": pa.int32(), "node": pa.binary(), "root": pa.binary(), "links": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for k, v in columns.items()], names=list(columns))


def shared_counts(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Size of the intersection of each pair of sets. Only values that two sets have are looked at, as columns of
    a 0/1 matrix, some at a time."""
    n = len(sets)
    if len(a) <= 2 * n:
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a.tolist(), b.tolist())], np.int64)
    values, ids, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    common = times[ids] > 1
    owner, (kept, ids) = owner[common], np.unique(ids[common], return_inverse=True)
    total = np.zeros((n, n), np.float32)
    order = np.argsort(ids, kind="stable")
    ids, owner = ids[order], owner[order]
    for at in range(0, len(kept), 4096):
        i, j = np.searchsorted(ids, [at, at + 4096])
        part = np.zeros((n, min(4096, len(kept) - at)), np.float32)
        part[owner[i:j], ids[i:j] - at] = 1
        total += part @ part.T
    return total[a, b].astype(np.int64)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root, links) of the nodes with exact links in their unit."""
    out = {"node": [], "root": [], "links": []}
    for unit in _units(batches):
        nodes = unit.column("node").to_pylist()
        first = [i for i in range(len(nodes)) if not i or nodes[i] != nodes[i - 1]]  # sorted: repeated rows are neighbours
        unit, nodes = unit.take(first), [nodes[i] for i in first]
        sides = unit.column("side").to_numpy()
        sigs, band = _matrix(unit.column("sig"), np.uint16), unit.column("band")[0].as_py()
        sets = [np.frombuffer(s, np.uint64) for s in unit.column("shingles").to_pylist()]
        size = np.array([len(s) for s in sets])
        links, root = np.zeros(len(nodes), np.int64), list(range(len(nodes)))

        def top(i: int, root=root) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        survivors = [surviving(sigs, a, b, band) for a, b in _pairs(sides)]
        a, b = (np.concatenate([s[k] for s in survivors]) if survivors else np.zeros(0, int) for k in (0, 1))
        both = shared_counts(sets, a, b) if len(a) else np.zeros(0, int)
        # t = p / q exactly: both / union >= t without rounding.
        yes = 5 * both >= 4 * (size[a] + size[b] - both) if THRESHOLD == 0.8 else both >= THRESHOLD * (size[a] + size[b] - both)
        a, b = a[yes], b[yes]
        np.add.at(links, a, 1)
        np.add.at(links, b, 1)
        for i, j in zip(a.tolist(), b.tolist()):
            i, j = top(i), top(j)
            root[max(i, j)] = min(i, j)
        for i in np.flatnonzero(links).tolist():
            out["node"].append(nodes[i])
            out["root"].append(nodes[top(i)])
            out["links"].append(int(links[i]))
        if len(out["node"]) >= 4096:
            yield _batch(out)
            out = {k: [] for k in out}
    if out["node"]:
        yield _batch(out)


def _sketches(keyed: DataFrame) -> DataFrame:
    """(doc_id, rid, node, n, sig) of each text; node is null for a text without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            nodes, sizes, sigs = [], [], []
            for t in batch.column(2):
                s = shingles(t.as_py())
                nodes.append(node_id(s) if len(s) else None)
                sizes.append(len(s))
                sigs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()),
                                              pa.array(sigs, pa.binary())], names=["doc_id", "rid", "node", "n", "sig"])

    return map_arrow(keyed, run, f"doc_id {dict(keyed.dtypes)['doc_id']}, rid long, node binary, n long, sig binary")


def _members(nodes: DataFrame) -> DataFrame:
    """(unit, band, side, node, sig): the members of each bucket of two or more, by pairs of blocks."""
    keys = nodes.select("node", "n", F.posexplode(F.array(*[
        F.xxhash64(F.lit(k), F.substring("sig", 2 * ROWS * k + 1, 2 * ROWS)) for k in range(BANDS)])).alias("band", "bucket"))
    crowded = (keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total")).filter("m > 1")
               .select("bucket", F.ceil(F.greatest(F.col("m") / BLOCK_NODES, F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    cut = keys.join(crowded, "bucket").withColumn("block", F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int"))
    units = cut.select("node", "band", "bucket", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    # A unit (i, j) has block i as side 0 and block j as side 1, either of which may be empty; a unit (i, i) is diagonal.
    units = units.select(F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "band",
                         F.when(F.col("block") == F.col("other"), DIAGONAL).otherwise((F.col("block") > F.col("other")).cast("int")).alias("side"), "node")
    return units.join(nodes.select("node", "sig"), "node").select("unit", "band", "side", "node", "sig")


def _dealt(df: DataFrame) -> DataFrame:
    return df.repartition("unit").sortWithinPartitions("unit", "node")


def links(docs: DataFrame, sketches: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root, links): per unit and node its exact links and the smallest node they lead to."""
    alive = materialize(map_arrow(_dealt(_members(nodes)), _bayes, "unit long, band int, side int, node binary"), "op9-alive")
    wanted = alive.groupBy("node").agg(F.collect_list(F.struct("unit", "band", "side")).alias("units"))
    wanted = wanted.join(nodes.select("node", "sig", "rep"), "node").select("node", "sig", "units", F.col("rep.doc_id").alias("_doc"), F.col("rep.rid").alias("_rid"))
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(F.col("_doc")) & (docs["rid"] == F.col("_rid"))).select("node", "sig", "units", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(
                [shingles(t.as_py()).tobytes() for t in batch.column(3)], pa.binary())], names=["node", "sig", "units", "shingles"])

    full = map_arrow(texts, sets, "node binary, sig binary, units array<struct<unit:long,band:int,side:int>>, shingles binary")
    full = full.select(F.explode("units").alias("u"), "node", "sig", "shingles").select("u.unit", "u.band", "u.side", "node", "sig", "shingles")
    return map_arrow(_dealt(full), _verify, "node binary, root binary, links long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, class_id, n_links, n_copies, node, label) per row of ``docs``.

    ``class_id``: the smallest doc_id of the rows connected by links; ``n_links``: the other shingle sets with a
    Jaccard similarity of at least THRESHOLD to the text's; ``n_copies``: rows with its shingle set, itself included;
    ``node`` and ``label`` name the set and the class. A null or empty text, or one without words, is alone: its class is its
    own id and its label null. Repeated rows are copies of each other; ids may be null and are then no class_id
    unless all of the class are; only doc_id and text are read.
    """
    keyed = key_columns(docs)
    sketches = materialize(_sketches(keyed), "op9-sketches")
    rep = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid")
    nodes = materialize(sketches.filter("node IS NOT NULL").groupBy("node").agg(
        F.count(F.lit(1)).alias("n_copies"), F.min(rep).alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")), "op9-nodes")
    found = materialize(links(keyed, sketches, nodes), "op9-links")
    labels = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degree = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    named = (nodes.select("node", "n_copies", F.col("rep.doc_id").alias("first_id"))
             .join(labels, "node", "left").join(degree, "node", "left")
             .select("node", "n_copies", "first_id", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    named = materialize(named, "op9-named")
    classes = named.groupBy("label").agg(F.min("first_id").alias("class_id"))
    named = named.join(classes, "label").select("node", "label", "class_id", "n_links", "n_copies")
    return (sketches.select("doc_id", "rid", "node").join(named, "node", "left")
            .select("doc_id", "rid", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"), "node", "label"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")
