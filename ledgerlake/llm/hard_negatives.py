"""Hard negatives by inner product, found with a GNAT (a multiway tree of hyperplanes).

Each node of the tree has a few split points; a row goes to the child of the nearest one. For every split point and every
child of its node the tree stores the least and the greatest distance of the child's rows from the split point, and for
every child the least and the greatest norm. As d(a, x)^2 = |a|^2 + |x|^2 - 2 a.x, a window of scores is an annulus of
distances around the anchor; a child is eliminated if, for some split point, its range does not meet what the
annulus and the anchor's distance allow (the triangle inequality). What is left are leaves, scored exactly.

The split points come from a bounded sample; ranges, leaves and searches cover every row. A leaf's rows and the
searches that come to it are dealt in blocks of bounded size, each pair of blocks is a unit of work, and a unit returns the best few rows
of each search. Every search first scores its own leaf, whose results narrow the windows for the rest.

Equal vectors of one label are one *point*: only their first rows by id can be among the first of any
search, and their anchors have the same searches. So a vector that many rows share costs one search, and a few rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import load, map_arrow, materialize, pick, ship

#: Anchors: ids divisible by ANCHOR. Labels of ids divisible by RELABEL move on by one, modulo LABELS.
ANCHOR, RELABEL, LABELS = 50, 7, 10
#: Positives of an anchor, negatives of a positive, and the window of a negative's score in hundredths of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
SCALE = 256
#: Points that the split points are chosen from, split points of a node, and rows of a leaf that the tree aims at.
SAMPLE, ARITY, LEAF_ROWS = 8192, 8, 2048
#: Bounds of a unit: rows of a leaf, and searches.
BLOCK_ROWS, BLOCK_SEARCHES = 4096, 2048
EXACT = 1 << 53


@dataclass
class Node:
    splits: np.ndarray = None
    children: list["Node"] = field(default_factory=list)
    leaf: int = -1
    low: np.ndarray = None  # [split point, child], as high; norms: [child, (least, greatest)]
    high: np.ndarray = None
    norms: np.ndarray = None


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances; the squares are whole numbers and exact."""
    return np.sqrt(np.maximum(0.0, (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)))


class Tree:
    """Split points from ``sample``; a node is a leaf if it stands for at most LEAF_ROWS of the ``rows``."""

    def __init__(self, sample: np.ndarray, rows: int):
        self.leaves, self.nodes = 0, []
        self.share = rows / max(1, len(sample))
        self.root = self._grow(np.unique(sample, axis=0) if len(sample) else sample)

    def _grow(self, points: np.ndarray) -> Node:
        node = Node()
        if len(points) <= 2 * ARITY or len(points) * self.share <= LEAF_ROWS:
            node.leaf, self.leaves = self.leaves, self.leaves + 1
            return node
        # Far apart, as GNAT chooses them: the next split point is the one farthest from those chosen.
        few = points[:: max(1, len(points) // (16 * ARITY))]
        chosen = [int(distances(few, few.mean(0, keepdims=True)).argmax())]
        least = distances(few, few[chosen])[:, 0]
        while len(chosen) < ARITY and least.max() > 0:
            chosen.append(int(least.argmax()))
            least = np.minimum(least, distances(few, few[chosen[-1:]])[:, 0])
        node.splits = few[chosen]
        near = distances(points, node.splits).argmin(1)
        node.low, node.high = np.full((len(chosen),) * 2, np.inf), np.full((len(chosen),) * 2, -np.inf)
        node.norms = np.tile([np.inf, -np.inf], (len(chosen), 1))
        self.nodes.append(node)
        node.children = [self._grow(points[near == j]) for j in range(len(chosen))]
        return node

    def route(self, x: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """The leaf of each row, and what the rows add to the ranges: (node, split point, child, least, greatest) distance and, with
        split point -1, norm."""
        leaf, found = np.zeros(len(x), np.int64), []
        number = {id(n): i for i, n in enumerate(self.nodes)}

        def down(node: Node, at: np.ndarray) -> None:
            if not len(at):
                return
            if node.leaf >= 0:
                leaf[at] = node.leaf
                return
            d = distances(x[at], node.splits)
            near = d.argmin(1)
            for j, child in enumerate(node.children):
                mine = near == j
                if mine.any():
                    norm = (x[at[mine]] ** 2).sum(1)
                    found.append((number[id(node)], -1, j, norm.min(), norm.max()))
                    found.extend((number[id(node)], i, j, lo, hi) for i, (lo, hi) in enumerate(zip(d[mine].min(0), d[mine].max(0))))
                    down(child, at[mine])

        down(self.root, np.arange(len(x)))
        return leaf, found

    def learn(self, ranges: list[tuple]) -> None:
        """Stores the ranges of all rows."""
        for n, i, j, lo, hi in ranges:
            if i < 0:
                self.nodes[n].norms[j] = lo, hi
            else:
                self.nodes[n].low[i, j], self.nodes[n].high[i, j] = lo, hi

    def reached(self, a: np.ndarray, least: np.ndarray, most: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """(anchors, leaf) that may hold a score of one of an anchor's windows. ``least``, ``most``: [anchor, window]; a window with least > most is none."""
        norm, out = (a * a).sum(1), []

        def down(node: Node, at: np.ndarray) -> None:
            if not len(at):
                return
            if node.leaf >= 0:
                out.append((at, node.leaf))
                return
            d = distances(a[at], node.splits)
            for j, child in enumerate(node.children):
                shortest, longest = node.norms[j]
                if shortest > longest:
                    continue
                lo, hi = node.low[:, j], node.high[:, j]
                # By the triangle inequality the child's rows are so far from the anchor at least, at most.
                nearest, farthest = np.maximum(d - hi, lo - d).max(1), (d + hi).min(1)
                outer2, inner2 = norm[at, None] + longest - 2 * least[at], norm[at, None] + shortest - 2 * most[at]
                slack = 1e-6 * (1 + farthest)[:, None]  # roots are rounded
                meets = (least[at] <= most[at]) & (outer2 >= 0) & (nearest[:, None] <= np.sqrt(np.maximum(outer2, 0)) + slack) & (
                    farthest[:, None] + slack >= np.sqrt(np.maximum(inner2, 0)))
                down(child, at[meets.any(1)])

        down(self.root, np.arange(len(a)))
        return out


def cleaned(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v array<bigint>) of the rows that take part; v is padded with zeros to the longest vector. A repeated row counts once."""
    x = pick(vectors, "vec_id", "label", "embedding").select("vec_id", "label", F.transform("embedding", lambda c: c.cast("double")).alias("x"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = x.where(F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    moved = F.when(F.col("vec_id") % RELABEL == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    x = x.select("vec_id", moved.cast("bigint").alias("label"), F.transform("x", lambda c: F.floor(c * SCALE)).alias("v"))
    size = x.agg(F.coalesce(F.max(F.size("v")), F.lit(0)).alias("n")).collect()[0]["n"]
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), F.lit(size) - F.size("v")))
    return x.withColumn("v", padded).distinct()


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return x.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


@dataclass
class Index:
    """rows: (leaf, block, point, vec_id, label, v), the first rows of each point; blocks: {leaf: number of blocks}."""

    tree: Tree
    rows: DataFrame
    blocks: dict[int, int]


def first_rows(rows: DataFrame) -> DataFrame:
    """The rows of cleaned() with their ``point`` and their ``place`` among its rows, written."""
    numbered = rows.withColumn("place", F.row_number().over(W.partitionBy("v", "label").orderBy(F.col("vec_id").asc_nulls_last())))
    first = numbered.where(F.col("place") <= POSITIVES + 1)
    points = materialize(first.where("place = 1").select("v", "label", F.monotonically_increasing_id().alias("point")), "points")
    return materialize(first.join(points, ["v", "label"]).select("point", "vec_id", "label", "v"), "first_rows")


def build(first: DataFrame) -> Index:
    """The index of first_rows()."""
    spark = first.sparkSession
    near = first.where("v is not null").orderBy(F.xxhash64("v"), "vec_id").limit(SAMPLE).select("v").toArrow()
    tree = Tree(_matrix(near.column("v")), first.count())

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, found = tree.route(_matrix(batch.column("v")))
            kinds = [pa.int64()] * 4 + [pa.float64()] * 2
            rows = [pa.array(leaf, pa.int64()), *[pa.nulls(len(leaf), k) for k in kinds[1:]], *(batch.column(n) for n in ("point", "vec_id", "label", "v"))]
            rests = [pa.nulls(len(found), batch.column(n).type) for n in ("point", "vec_id", "label", "v")]
            ranges = [pa.nulls(len(found), pa.int64()), *[pa.array([f[i] for f in found], k) for i, k in enumerate(kinds[1:])], *rests]
            for columns in (rows, ranges):
                yield pa.RecordBatch.from_arrays(columns, names=["leaf", "node", "split", "child", "low", "high", "point", "vec_id", "label", "v"])

    kinds = ", ".join(f"{n} {k}" for n, k in first.dtypes)
    routed = materialize(map_arrow(first, route, f"leaf bigint, node bigint, split bigint, child bigint, low double, high double, {kinds}"), "routed")
    # Bounded by the tree: nodes times ARITY times (ARITY + 1).
    ranges = routed.where("node is not null").groupBy("node", "split", "child").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    tree.learn([(r["node"], r["split"], r["child"], r["low"], r["high"]) for r in ranges.collect()])
    rows = routed.where("leaf is not null")
    blocks = {r["leaf"]: -(-r["n"] // BLOCK_ROWS) for r in rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Index(tree, rows.select("leaf", *first.columns), blocks)


def _spread(spark: SparkSession, parts: dict[int, int], name: str) -> DataFrame:
    return spark.createDataFrame(sorted(parts.items()), f"leaf bigint, {name} int")


def visit(index: Index, searches: DataFrame, keep: int, same: bool) -> DataFrame:
    """(point, slot, vec_id, found, score): of each search and window the first ``keep`` rows of each unit.

    searches: (leaf, point, label, v, least array<double>, most array<double>), one row for each leaf it comes to. Rows of the anchor's own label count if ``same``, else
    those of others; ``found`` is the row's point.
    """
    spark = searches.sparkSession
    come = {r["leaf"]: -(-r["n"] // BLOCK_SEARCHES) for r in searches.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks, lots = _spread(spark, index.blocks, "blocks"), _spread(spark, come, "lots")
    # A row goes to one block and to all lots of searches; a search goes to one lot and to all blocks.
    rows = (index.rows.join(F.broadcast(blocks), "leaf").join(F.broadcast(lots), "leaf")
            .withColumn("block", F.pmod(F.xxhash64("point", "vec_id"), "blocks").cast("int"))
            .withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).drop("blocks", "lots"))
    asked = (searches.join(F.broadcast(blocks), "leaf").join(F.broadcast(lots), "leaf")
             .withColumn("lot", F.pmod(F.xxhash64("point"), "lots").cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "lots"))
    kind = dict(index.rows.dtypes)["vec_id"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by([("vec_id", "ascending")])  # null ids last; argmax takes the first of equal scores
        x, a = _matrix(left.column("v")), _matrix(right.column("v"))
        own = left.column("label").to_numpy()[None, :] == right.column("label").to_numpy()[:, None]
        score = np.zeros((0, 0))
        if len(x) and len(a):
            if np.abs(x).max(initial=0) * np.abs(a).max(initial=0) * x.shape[1] >= EXACT:
                raise ValueError("scores of 2^53 and more")
            score = a @ x.T
        counts = score if not score.size else np.where(own == same, score, -np.inf)
        least, most = _windows(right.column("least")), _windows(right.column("most"))
        out = []
        for w in range(least.shape[1] if score.size else 0):
            inside = np.where((counts >= least[:, w, None]) & (counts <= most[:, w, None]), counts, -np.inf)
            for _ in range(keep):
                j = inside.argmax(1)
                best = inside[np.arange(len(j)), j]
                i = np.flatnonzero(best > -np.inf)
                if not len(i):
                    break
                out.append((i, np.full(len(i), w), j[i], best[i].astype(np.int64)))
                inside[i, j[i]] = -np.inf
        i, w, j, s = (np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else [()] * 4))
        return pa.table({"point": right.column("point").take(i), "slot": pa.array(w, pa.int32()), "vec_id": left.column("vec_id").take(j),
                         "found": left.column("point").take(j), "score": pa.array(s, pa.int64())})

    ship(spark)
    unit = ["leaf", "block", "lot"]
    asked = asked.toDF(*[f"to_{n}" if n in unit else n for n in asked.columns])  # other names: both sides may come from one frame
    return rows.groupBy(*unit).cogroup(asked.groupBy(*[f"to_{n}" for n in unit])).applyInArrow(run, f"point bigint, slot int, vec_id {kind}, found bigint, score bigint")


def _windows(column) -> np.ndarray:
    rows = column.to_pylist()
    out = np.full((len(rows), max(map(len, rows), default=0)), np.nan)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def reached(index: Index, searches: DataFrame, elsewhere: bool) -> DataFrame:
    """A row for each leaf that a search comes to; ``elsewhere``: without its own leaf."""
    tree, kinds = index.tree, ", ".join(f"{n} {k}" for n, k in searches.dtypes if n != "leaf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = batch.column("leaf").to_numpy(zero_copy_only=False)
            least, most = (np.nan_to_num(_windows(batch.column(n)), nan=v, posinf=np.inf, neginf=-np.inf) for n, v in (("least", 1.0), ("most", 0.0)))
            rest = batch.drop_columns(["leaf"])
            for at, leaf in tree.reached(_matrix(batch.column("v")), least, most):
                at = at[home[at] != leaf] if elsewhere else at
                if len(at):
                    part = rest.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([pa.array([leaf] * len(at), pa.int64()), *part.columns], names=["leaf", *part.schema.names])

    return map_arrow(searches, run, f"leaf bigint, {kinds}")


def best(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` rows of each search and window, as a sorted array of (score, vec_id, found)."""
    order = W.partitionBy("point", "slot").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "found")
    ranked = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    return ranked.groupBy("point", "slot").agg(F.array_sort(F.collect_list(F.struct("place", "score", "vec_id", "found"))).alias("rows"))


def search(index: Index, anchors: DataFrame, keep: int, same: bool) -> DataFrame:
    """(point, slot, rows): the first ``keep`` rows by score (ties: smaller id) in each of the windows of each anchor point.

    anchors: (leaf, point, label, v, least, most), written. The own leaf first: a window that has ``keep`` rows there is narrowed to the last of them.
    """
    home = materialize(best(visit(index, anchors, keep, same), keep), "home")
    last = home.where(F.size("rows") == keep).select("point", "slot", F.element_at("rows", -1)["score"].cast("double").alias("score"))
    last = last.groupBy("point").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("last"))
    narrowed = anchors.join(last, "point", "left").withColumn("least", F.transform("least", lambda x, i: F.coalesce(F.try_element_at("last", i), x)))
    there = visit(index, materialize(reached(index, narrowed.select(*anchors.columns), True), "reached"), keep, same)
    known = home.select("point", "slot", F.inline("rows")).select("point", "slot", "vec_id", "found", "score")
    return best(known.unionByName(there), keep)


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows with a null label, a null vector or a null or non-finite component take no part; null ids are no anchors and come
    after all others; shorter vectors end in zeros; a repeated row counts once, rows that share only their id are
    rows of their own; equal scores go by id; only vec_id, label and embedding are read; an empty table gives no rows. Scores
    below 2^53 are exact, greater ones raise an error.
    """
    rows = materialize(cleaned(vectors), "vectors")
    first = first_rows(rows)
    index = build(first)
    points = first.select("point", "label", "v").dropDuplicates(["point"])
    wanted = rows.where(F.col("vec_id") % ANCHOR == 0).select(F.col("vec_id").alias("anchor_id"), "label", "v")
    anchors = materialize(wanted.join(points, ["label", "v"]).select("anchor_id", "point"), "anchors")
    home = index.rows.dropDuplicates(["point"]).join(anchors.select("point").distinct(), "point", "left_semi")
    plain = home.select("leaf", "point", "label", "v", F.array(F.lit(float("-inf"))).alias("least"), F.array(F.lit(float("inf"))).alias("most"))
    positives = materialize(search(index, materialize(plain, "searches"), POSITIVES + 1, True).select("point", "rows"), "positives")
    # The windows of a point: one for each score that one of its positives has; slots are their places.
    scores = positives.select("point", F.array_distinct(F.transform("rows", lambda r: r["score"])).alias("scores"))
    windowed = home.select("leaf", "point", "label", "v").join(scores, "point").select(
        "leaf", "point", "label", "v", "scores",
        F.transform("scores", lambda s: F.ceil(s * LOW / 100).cast("double")).alias("least"), F.transform("scores", lambda s: F.floor(s * HIGH / 100).cast("double")).alias("most"))
    windowed = materialize(windowed, "windows")
    negatives = search(index, windowed.drop("scores"), NEGATIVES, False)
    negatives = negatives.join(windowed.select("point", "scores"), "point").select("point", F.element_at("scores", F.col("slot") + 1).alias("positive_score"), "rows")
    others = F.slice(F.filter("rows", lambda r: ~((r["found"] == F.col("point")) & r["vec_id"].eqNullSafe(F.col("anchor_id")))), 1, POSITIVES)
    pairs = anchors.join(positives, "point").select("anchor_id", "point", F.explode(others).alias("p"))
    pairs = pairs.select("anchor_id", "point", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return pairs.join(negatives, ["point", "positive_score"]).select("anchor_id", "positive_id", "positive_score", F.explode("rows").alias("n")).select(
        F.col("anchor_id").cast("bigint"), F.col("positive_id").cast("bigint"), F.col("n.place").cast("int").alias("rank"), F.col("n.vec_id").cast("bigint").alias("negative_id"),
        "positive_score", F.col("n.score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(load(spark, sf_dir, "embeddings"))


ORACLE = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % {RELABEL} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % {ANCHOR} = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""
