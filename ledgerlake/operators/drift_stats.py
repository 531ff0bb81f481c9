"""DQ17 distribution drift between a reference and a current slice.

* PSI and total variation over binned counts (categorical values, or fixed
  width bins of a numeric column).
* Exact two-sample Kolmogorov-Smirnov for numeric columns, the greatest |F1 - F2| over all values. Quantiles of a
  mergeable sketch cut each column into buckets; the exact counts per bucket give F1 and F2 at their ends, and since both
  only rise, a bound on |F1 - F2| inside each bucket. Only buckets whose bound is above the greatest difference
  at an end can hold the maximum: their values alone are sorted, dealt by range, and summed up exactly.

Three passes over the rows, whatever the number of columns: the sketches, all counts of bins and buckets, and the values of
the buckets that are left. No parity with any drift library is claimed; these are the textbook statistics.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerlake.functions.scalars import MONEY, round2
from ledgerlake.session import materialize

EPS = 0.0001          # probability floor inside PSI (empty bins)
PSI_DRIFT = 0.2       # conventional "significant shift" threshold
BUCKETS = 64          # of a numeric column, for KS


def quantile_edges(df: DataFrame, columns: list[str], buckets: int = BUCKETS) -> dict[str, list[Decimal]]:
    """Where the buckets of each column end: quantiles of its values, from one pass of mergeable sketches. At most
    ``buckets`` - 1 numbers per column come to the driver."""
    sketches = df.agg(*[F.kll_sketch_agg_double(F.col(c).cast("double")).alias(c) for c in columns])
    ranks = [i / buckets for i in range(1, buckets)]
    quantiles = [F.when(F.kll_sketch_get_n_double(c) > 0, F.array(*[F.kll_sketch_get_quantile_double(c, F.lit(r)) for r in ranks])).alias(c) for c in columns]
    found = sketches.select(*quantiles).first()
    return {c: sorted({Decimal(str(x)).quantize(Decimal("0.01")) for x in found[c] or ()}) for c in columns}


def bucket_of(x: Column, edges: list[Decimal], first: int = 0) -> Column:
    """How many edges are below ``x``, by binary search."""
    if not edges:
        return F.lit(first)
    m = len(edges) // 2
    return F.when(x <= F.lit(edges[m]), bucket_of(x, edges[:m], first)).otherwise(bucket_of(x, edges[m + 1:], first + m + 1))


def counts(df: DataFrame, ref: str, categorical: list[str], numeric: dict[str, float], edges: dict[str, list[Decimal]]) -> DataFrame:
    """(kind, column_name, bin, n_ref, n_cur, one_value) from one pass: the bins of PSI (``psi``) and the buckets of KS (``ks``)."""
    def entry(kind: str, column: str, value: Column, x: Column | None = None) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(column).alias("column_name"), value.cast("string").alias("bin"),
                        (F.lit(None) if x is None else x).cast(MONEY).alias("x"))

    entries = [entry("psi", c, F.col(c)) for c in categorical]
    entries += [entry("psi", c, F.floor(F.col(c) / w).cast("bigint")) for c, w in numeric.items()]
    entries += [F.when(F.col(c).isNotNull(), entry("ks", c, bucket_of(F.col(c).cast(MONEY), edges[c]), F.col(c))) for c in numeric]
    rows = df.select(F.col(ref).alias("_ref"), F.inline(F.array_compact(F.array(*entries))))
    return rows.groupBy("kind", "column_name", "bin").agg(F.count_if(F.col("_ref")).alias("n_ref"), F.count_if(~F.col("_ref")).alias("n_cur"),
                                                        (F.min("x") == F.max("x")).alias("one_value"))


def psi_tv(bins: DataFrame) -> DataFrame:
    totals = F.broadcast(bins.groupBy("column_name").agg(F.sum("n_ref").alias("t_ref"),
                                                         F.sum("n_cur").alias("t_cur")))
    p = bins.join(totals, "column_name").select(
        "column_name", F.try_divide("n_ref", "t_ref").alias("p_ref"), F.try_divide("n_cur", "t_cur").alias("p_cur"))
    pr, pc = F.greatest("p_ref", F.lit(EPS)), F.greatest("p_cur", F.lit(EPS))
    return p.groupBy("column_name").agg(F.sum((pc - pr) * F.ln(pc / pr)).alias("psi"),
                                        (F.sum(F.abs(F.col("p_cur") - F.col("p_ref"))) / 2).alias("tv"))


@dataclass
class Bounds:
    """What the bucket counts say of |F1 - F2|: its greatest value at an end, and the buckets that may hold a greater one with
    (reference, current) rows before them."""

    total: tuple[int, int]
    at_ends: float
    open: dict[int, tuple[int, int]]
    rows: int


def bounds(buckets: dict[int, tuple[int, int]], single: set[int]) -> Bounds:
    """From the (reference, current) rows of each bucket. Inside a bucket F1 - F2 is at most F1 at its end - F2 at its start,
    and F2 - F1 likewise; a bucket of a ``single`` value has nothing inside."""
    a, b = (sum(x[i] for x in buckets.values()) for i in (0, 1))
    if not a or not b:
        return Bounds((a, b), 0.0, {}, 0)
    before, x, y, at_ends, most = {}, 0, 0, 0.0, {}
    for n in sorted(buckets):
        before[n] = x, y
        u, v = x + buckets[n][0], y + buckets[n][1]
        most[n] = max(u / a - y / b, v / b - x / a)
        x, y = u, v
        at_ends = max(at_ends, abs(x / a - y / b))
    left = {n: before[n] for n in buckets if most[n] > at_ends and n not in single}
    return Bounds((a, b), at_ends, left, sum(sum(buckets[n]) for n in left))


def refined(df: DataFrame, ref: str, edges: dict[str, list[Decimal]], found: dict[str, Bounds], buckets: dict[str, dict[int, tuple[int, int]]]) -> DataFrame:
    """(column_name, d): the greatest |F1 - F2| over the values of the open buckets of each column.

    Values (with their counts) are dealt by range; offsets per partition are sums of a row per partition and column, and
    the running sums are windows partitioned by partition and column.
    """
    entries, shifts = [], []
    for c, x in found.items():
        value, gone = F.col(c).cast(MONEY), [0, 0]
        bucket = bucket_of(value, edges[c])
        entries.append(F.when(value.isNotNull() & bucket.isin(*x.open), F.struct(F.lit(c).alias("column_name"), bucket.alias("bucket"), value.alias("x"))))
        for n in sorted(x.open):  # rows before the bucket that are not among the refined ones
            shifts.append((c, n, *(x.open[n][i] - gone[i] for i in (0, 1)), *x.total))
            gone = [gone[i] + buckets[c][n][i] for i in (0, 1)]
    rows = df.select(F.col(ref).alias("_ref"), F.inline(F.array_compact(F.array(*entries))))
    v = rows.groupBy("column_name", "bucket", "x").agg(F.count_if(F.col("_ref")).alias("a"), F.count_if(~F.col("_ref")).alias("b"))
    v = materialize(v.repartitionByRange("column_name", "x").withColumn("bk", F.spark_partition_id()), "ks_values")
    per = v.groupBy("column_name", "bk").agg(F.sum("a").alias("pa"), F.sum("b").alias("pb"))
    earlier = W.partitionBy("column_name").orderBy("bk").rowsBetween(W.unboundedPreceding, -1)   # a row per shuffle partition
    offsets = per.select("column_name", "bk", *[F.coalesce(F.sum(f"p{s}").over(earlier), F.lit(0)).alias(f"o{s}") for s in "ab"])
    shift = df.sparkSession.createDataFrame(shifts, "column_name string, bucket int, sa bigint, sb bigint, ta bigint, tb bigint")
    run = W.partitionBy("column_name", "bk").orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow)
    j = v.join(F.broadcast(offsets), ["column_name", "bk"]).join(F.broadcast(shift), ["column_name", "bucket"])
    f1, f2 = ((F.col(f"s{s}") + F.col(f"o{s}") + F.sum(s).over(run)) / F.col(f"t{s}") for s in "ab")
    return j.select("column_name", F.abs(f1 - f2).alias("d")).groupBy("column_name").agg(F.max("d").alias("d"))


def ks_exact(df: DataFrame, ref: str, edges: dict[str, list[Decimal]], bucket_counts: DataFrame) -> DataFrame:
    """(column_name, ks, refined_rows, rows) of each column of ``edges``. ``bucket_counts``: the ``ks`` rows of counts()."""
    buckets: dict[str, dict[int, tuple[int, int]]] = {c: {} for c in edges}
    single: dict[str, set[int]] = {c: set() for c in edges}
    for r in bucket_counts.collect():  # BUCKETS rows a column at most
        buckets[r["column_name"]][int(r["bin"])] = r["n_ref"], r["n_cur"]
        if r["one_value"]:
            single[r["column_name"]].add(int(r["bin"]))
    found = {c: bounds(b, single[c]) for c, b in buckets.items()}
    base = df.sparkSession.createDataFrame([(c, x.at_ends if all(x.total) else None, x.rows, sum(x.total)) for c, x in found.items()],
                                           "column_name string, at_ends double, refined_rows bigint, rows bigint")
    todo = {c: x for c, x in found.items() if x.open}
    if not todo:
        return base.withColumnRenamed("at_ends", "ks")
    inside = refined(df, ref, edges, todo, buckets)
    return base.join(inside, "column_name", "left").select("column_name", F.greatest("at_ends", "d").alias("ks"), "refined_rows", "rows")


def distribution_drift(df: DataFrame, ref: str, categorical: list[str], numeric: dict[str, float]) -> DataFrame:
    """(column_name, psi, total_variation, ks, drifted, refined_share): the share of a numeric column's rows that were sorted for KS."""
    edges = quantile_edges(df, list(numeric)) if numeric else {}
    all_counts = materialize(counts(df, ref, categorical, numeric, edges), "drift_counts")
    none = F.lit(None)
    out = psi_tv(all_counts.where("kind = 'psi'").drop("kind", "one_value")).withColumns({c: none.cast("double") for c in ("ks", "share")})
    if numeric:
        ks = ks_exact(df, ref, edges, all_counts.where("kind = 'ks'"))
        out = out.unionByName(ks.select("column_name", none.cast("double").alias("psi"), none.cast("double").alias("tv"), "ks",
                                        F.try_divide("refined_rows", "rows").alias("share")))
    # A row per column and statistic; they meet by grouping, the columns being few.
    out = out.groupBy("column_name").agg(*[F.max(m).alias(m) for m in ("psi", "tv", "ks", "share")])
    return out.select("column_name", round2("psi", 6).alias("psi"), round2("tv", 6).alias("total_variation"),
                      round2("ks", 6).alias("ks"), (F.col("psi") > PSI_DRIFT).alias("drifted"), round2("share", 6).alias("refined_share"))
