"""Gold tables kept up to date by day: mergeable state per key, with retractions.

    days/_run=N/_day=D/   what the rows of day D add to each key: count, sum
    totals/_run=N/        counts, sum, first and last day of each key over all days
    ledger/               one row per committed run: the days it replaced

A run is given all rows of the days it replaces. The difference between what they add now and what they added before
(the latest committed run of each day) is merged into the totals, so its cost is that of its days and of one
row per key, not of the history. Sums and counts can be taken back; a first or last day can not, so keys that lose theirs
are looked up in the days. Everything a run writes is new until its ledger row is there: one that dies changes nothing.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerlake.functions.scalars import MONEY, round2
from ledgerlake.session import materialize
from ledgerlake.sources.keyed import Ledger

TOTAL = "decimal(28,2)"


class DailyTotals:
    """Rows, rows with an ``amount``, its sum, and first and last ``day`` per ``keys`` at ``path``."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], day: str = "transaction_date", amount: str = "amount"):
        self.spark, self.path, self.keys, self.day, self.amount = spark, path, keys, day, amount
        self.ledger = Ledger(spark, f"{path}/ledger", "run int, days array<string>, all_days boolean, filled array<string>")

    def state(self) -> tuple[int | None, dict[str, int]]:
        """The latest committed run, and for each day with rows the run that wrote it."""
        runs = sorted(self.ledger.rows(), key=lambda r: r["run"])
        days: dict[str, int] = {}
        for r in runs:
            days = {} if r["all_days"] else {d: n for d, n in days.items() if d not in set(r["days"])}
            days |= {d: r["run"] for d in r["filled"]}
        return (runs[-1]["run"] if runs else None), days

    def _days(self, days: dict[str, int]) -> DataFrame | None:
        if not days:
            return None
        folders = [f"{self.path}/days/_run={n}/_day={d}" for d, n in sorted(days.items())]
        return self.spark.read.option("basePath", f"{self.path}/days").parquet(*folders).withColumn("_day", F.col("_day").cast("date"))

    def apply(self, rows: DataFrame, days: list[date] | None = None) -> DataFrame:
        """Replaces ``days`` (None: all) by the given rows, which are all rows of those days; returns the new totals."""
        last, known = self.state()
        run = 0 if last is None else last + 1
        wanted = None if days is None else {str(d) for d in days}
        added = rows.where(F.col(self.day).isNotNull())
        if days is not None:
            added = added.where(F.col(self.day).isin(*days))
        added = added.groupBy(F.col(self.day).alias("_day"), *self.keys).agg(
            F.count(F.lit(1)).alias("n"), F.count(self.amount).alias("priced"), F.coalesce(F.sum(F.col(self.amount).cast(MONEY)), F.lit(0)).cast(TOTAL).alias("total"))
        added.hint("rebalance", "_day").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_day").parquet(f"{self.path}/days/_run={run}")
        filled = self._filled(run)
        new, old = self._days({d: run for d in filled}), self._days({d: n for d, n in known.items() if wanted is not None and d in wanted})
        kept = {} if wanted is None else {d: n for d, n in known.items() if d not in wanted}
        totals = self._merged(new, old, last if wanted is not None else None, kept | {d: run for d in filled}, rows)
        totals.write.mode("overwrite").parquet(f"{self.path}/totals/_run={run}")
        self.ledger.commit(run=run, days=sorted(wanted or ()), all_days=wanted is None, filled=filled)
        return self.totals()

    def _filled(self, run: int) -> list[str]:
        """The days that the run has written, from its folders."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        found = files.load(f"{self.path}/days/_run={run}").select(F.regexp_extract("path", "/_day=([^/]+)/", 1).alias("day"))
        return sorted(r["day"] for r in found.where("day <> ''").distinct().collect())

    def _merged(self, new: DataFrame | None, old: DataFrame | None, last: int | None, days: dict[str, int], rows: DataFrame) -> DataFrame:
        before = None if last is None else self.spark.read.parquet(f"{self.path}/totals/_run={last}")
        parts = [] if before is None else [before.withColumn("from", F.lit("before"))]
        parts += [_as_total(x, source) for x, source in ((new, "new"), (old, "old")) if x is not None]
        if not parts:
            schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in self.keys)
            return self.spark.createDataFrame([], f"{schema}, n bigint, priced bigint, total {TOTAL}, first_day date, last_day date")
        union = parts[0]
        for part in parts[1:]:
            union = union.unionByName(part)

        def ends(name: str, *sources: str) -> list:
            mine = F.col("from").isin(*sources)
            return [F.min(F.when(mine, F.col("first_day"))).alias(f"{name}first_day"), F.max(F.when(mine, F.col("last_day"))).alias(f"{name}last_day")]

        merged = union.groupBy(*self.keys).agg(F.sum("n").alias("n"), F.sum("priced").alias("priced"), F.sum("total").cast(TOTAL).alias("total"), *ends("", "before", "new"),
                                               *ends("new_", "new"), *ends("gone_", "old")).where("n > 0")
        columns = [*self.keys, "n", "priced", "total", "first_day", "last_day"]
        if old is None:
            return merged.select(*columns)
        # A key that had its first (last) day taken back, and did not get it or an earlier (later) one again.
        merged = materialize(merged, "merged_totals")
        doubtful = merged.where((F.col("gone_first_day") <= F.col("first_day")) & (F.col("new_first_day").isNull() | (F.col("new_first_day") > F.col("gone_first_day")))
                                | (F.col("gone_last_day") >= F.col("last_day")) & (F.col("new_last_day").isNull() | (F.col("new_last_day") < F.col("gone_last_day"))))
        right, doubtful = merged.select(*columns), doubtful.select(*self.keys)
        if doubtful.isEmpty():
            return right
        true = _null_safe(self._days(days).select("_day", *self.keys), doubtful, self.keys, "left_semi").groupBy(*self.keys).agg(
            F.min("_day").alias("true_first"), F.max("_day").alias("true_last"))
        return _null_safe(right, true, self.keys, "left").withColumns({
            "first_day": F.coalesce("true_first", "first_day"), "last_day": F.coalesce("true_last", "last_day")}).select(*columns)

    def totals(self) -> DataFrame:
        """(keys, n, priced, total, first_day, last_day) of the latest committed run."""
        last, _ = self.state()
        if last is None:
            raise FileNotFoundError(f"no committed run in {self.path}")
        return self.spark.read.parquet(f"{self.path}/totals/_run={last}")


def _as_total(days: DataFrame, source: str) -> DataFrame:
    sign = -1 if source == "old" else 1
    return days.withColumns({"n": F.col("n") * sign, "priced": F.col("priced") * sign, "total": (F.col("total") * sign).cast(TOTAL), "first_day": F.col("_day"), "last_day": F.col("_day"),
                             "from": F.lit(source)}).drop("_day", "_run")


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(right, cond, how).drop(*[f"_r_{k}" for k in keys])


def ltv_state(spark: SparkSession, path: str) -> DailyTotals:
    """A13's state: completed transactions per customer and payment method."""
    return DailyTotals(spark, path, ["customer_id", "payment_method"])


def customer_ltv(totals: DataFrame) -> DataFrame:
    """A13 from the totals of ltv_state(): equal to ``aggregates.customer_ltv`` over all rows."""
    order = W.partitionBy("customer_id").orderBy(F.col("payment_method").isNull(), F.col("n").desc(), F.col("payment_method"))
    ranked = totals.withColumn("preferred", F.row_number().over(order) == 1)  # a row per payment method of a customer
    priced = F.sum("priced")
    total = F.when(priced > 0, F.sum("total"))
    return ranked.groupBy("customer_id").agg(
        total.cast("double").alias("total_spent"), F.sum("n").alias("total_txns"),
        round2(F.try_divide(total, priced).cast("decimal(22,6)")).alias("avg_txn_value"),
        F.min("first_day").alias("first_txn_date"), F.max("last_day").alias("last_txn_date"),
        F.max(F.when(F.col("preferred"), F.col("payment_method"))).alias("preferred_payment_method"))
