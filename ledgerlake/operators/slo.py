"""SLO, alert and scorecard operators.

SLO documents become evaluated operators: every measure is one aggregate
over the data, every alert rule a one-row frame that exists only when the
rule fires, and the alert table is their union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import pct, round2

# Fixed values of the SLO document and alert rules.
SLO = {
    "freshness_hours": 24,
    "quality_pct": 99.9,
    "quality_warn_pct": 99.85,
    "row_min": 17,
    "row_max": 25,
    "row_buffer_pct": 20.0,
    "runtime_minutes": 120,
    "runtime_warn_share": 0.8,
    "failure_rate_spike_pct": 30,
    "near_bounds_pct": 10.0,
}


def hours_between(earlier: Column, later: Column) -> Column:
    """Exact elapsed hours (microsecond precision)."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / 3.6e9


def freshness(df: DataFrame, ts_col: str, now, threshold_hours: float) -> DataFrame:
    """O1: hours since the newest row vs the threshold."""
    a = df.agg(F.max(ts_col).alias("last_ts"))
    h = hours_between(F.col("last_ts").cast("timestamp"), F.lit(now).cast("timestamp"))
    return a.select("last_ts", round2(h).alias("hours_since"), F.lit(threshold_hours).alias("threshold_hours"),
                    (h > threshold_hours).alias("breached"))


def quality_pct(bronze: DataFrame, merch: DataFrame, threshold: float) -> DataFrame:
    """O2: % rows with id, positive amount and a known merchant."""
    m = merch.select(F.col("merchant_id").alias("_mk"))
    j = bronze.join(m, bronze.merchant_id == m._mk, "left")
    ok = F.col("transaction_id").isNotNull() & (F.col("amount") > 0) & F.col("_mk").isNotNull()
    a = j.agg(F.count(F.lit(1)).alias("rows"), F.count_if(ok).cast("bigint").alias("good_rows"))
    q = pct(F.col("good_rows"), F.col("rows"))
    return a.select("rows", "good_rows", q.alias("quality_pct"), F.lit(threshold).alias("threshold_pct"),
                    (q >= threshold).alias("met"))


def daily_rows(df: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    return df.groupBy(F.col(date_col).alias("day")).agg(F.count(F.lit(1)).alias("rows"))


def row_count_slo(daily: DataFrame, lo: int, hi: int, buffer_pct: float) -> DataFrame:
    """O3: per day, rows within [lo, hi] widened by the buffer %."""
    blo, bhi = round(lo * (1 - buffer_pct / 100), 6), round(hi * (1 + buffer_pct / 100), 6)
    r = F.col("rows")
    return daily.select("day", "rows", F.lit(blo).alias("min_allowed"), F.lit(bhi).alias("max_allowed"),
                        ((r >= blo) & (r <= bhi)).alias("within"))


def near_bounds(daily: DataFrame, lo: int, hi: int, near_pct: float) -> DataFrame:
    """Days inside [lo, hi] but within ``near_pct`` % of a bound."""
    r = F.col("rows")
    inside = (r >= lo) & (r <= hi)
    near = (r <= lo * (1 + near_pct / 100)) | (r >= hi * (1 - near_pct / 100))
    return daily.where(inside & near).select("day", "rows", F.when(r <= lo * (1 + near_pct / 100), "low")
                                                          .otherwise("high").alias("near"))


def run_runtimes(events: DataFrame) -> DataFrame:
    """Run metadata from the event stream: one run per day, started at the
    first and completed at the last event of the day."""
    return (events.groupBy(F.to_date("ts").alias("run_date"))
                  .agg(F.min("ts").alias("started_at"), F.max("ts").alias("completed_at"),
                       F.count(F.lit(1)).alias("events")))


def runtime_slo(runs: DataFrame, limit_minutes: float) -> DataFrame:
    """Run minutes vs the limit."""
    mins = (F.unix_micros(F.col("completed_at").cast("timestamp"))
            - F.unix_micros(F.col("started_at").cast("timestamp"))) / 6e7
    return runs.select("run_date", round2(mins).alias("runtime_minutes"), F.lit(limit_minutes).alias("limit_minutes"),
                       (mins <= limit_minutes).alias("within"))


def new_values(df: DataFrame, date_col: str, columns: list[str], cutoff) -> DataFrame:
    """Values of each column first seen after the cutoff (never before it):
    first-seen date per value is one partial aggregate; no per-value scan."""
    long = df.select(F.col(date_col).alias("d"), *[F.col(c).cast("string").alias(c) for c in columns]) \
             .unpivot(["d"], columns, "column_name", "value").where(F.col("value").isNotNull())
    first = long.groupBy("column_name", "value").agg(F.min("d").alias("first_seen"))
    return first.where(F.col("first_seen") > F.lit(cutoff))


def alert(name: str, severity: str, fired: Column, observed: Column, message: str) -> Column:
    return F.when(fired, F.struct(F.lit(severity).alias("severity"), F.lit(name).alias("rule"),
                                  round2(observed.cast("double"), 4).alias("observed"),
                                  F.lit(message).alias("message")))


def evaluate_alerts(measures: DataFrame) -> DataFrame:
    """The 3 CRITICAL, 3 WARNING and 2 INFO rules over a one-row frame
    of measures; one output row per fired alert (``array_compact`` + inline)."""
    s = SLO
    m = {c: F.col(c) for c in measures.columns}
    rules = [
        alert("data_freshness_exceeded", "CRITICAL", m["freshness_hours"] > s["freshness_hours"],
              m["freshness_hours"], "data older than the freshness limit"),
        alert("data_quality_below_threshold", "CRITICAL", m["quality_pct"] < s["quality_pct"],
              m["quality_pct"], "quality below the SLO"),
        alert("row_count_out_of_bounds", "CRITICAL", m["days_out_of_bounds"] > 0, m["days_out_of_bounds"],
              "daily row count outside the bounds"),
        alert("pipeline_runtime_approaching_limit", "WARNING",
              m["max_runtime_minutes"] > s["runtime_minutes"] * s["runtime_warn_share"], m["max_runtime_minutes"],
              "runtime near or over the limit"),
        alert("data_quality_slightly_below_threshold", "WARNING",
              (m["quality_pct"] >= s["quality_warn_pct"]) & (m["quality_pct"] < s["quality_pct"]), m["quality_pct"],
              "quality slightly below the SLO"),
        alert("merchant_failure_rate_spike", "WARNING", m["spiking_merchants"] > 0, m["spiking_merchants"],
              "a merchant's failure rate is above the spike limit"),
        alert("new_payment_method_detected", "INFO", m["new_methods"] > 0, m["new_methods"],
              "new payment method values"),
        alert("row_count_near_bounds", "INFO", m["days_near_bounds"] > 0, m["days_near_bounds"],
              "daily row count close to a bound"),
    ]
    return measures.select(F.inline(F.array_compact(F.array(*rules))))


def scorecard_verdict(results: DataFrame) -> DataFrame:
    """Passed checks -> score -> SHIP (all) / CONDITIONAL SHIP (>= 3/5) / DOESN'T SHIP."""
    a = results.agg(F.count_if(F.col("status") == "PASS").cast("bigint").alias("passed"),
                    F.count(F.lit(1)).alias("checks"))
    p, n = F.col("passed"), F.col("checks")
    return a.select("passed", "checks", round2(p * 100.0 / n, 2).alias("score_pct"),
                    F.when(p == n, "SHIP").when(p * 5 >= n * 3, "CONDITIONAL SHIP").otherwise("DOESN'T SHIP")
                     .alias("verdict"))


SEVERITY_ORDER = {"CRITICAL": 3, "WARNING": 2, "INFO": 1}


def alert_summary(alerts: DataFrame, next_review) -> DataFrame:
    """Counts by severity, the top issue (highest severity, then name)."""
    rank = F.when(F.col("severity") == "CRITICAL", 3).when(F.col("severity") == "WARNING", 2).otherwise(1)
    return (alerts.agg(*[F.count_if(F.col("severity") == s).cast("bigint").alias(s.lower()) for s in SEVERITY_ORDER],
                       F.min_by("rule", F.struct(-rank, F.col("rule"))).alias("top_issue"))
                  .withColumn("next_review", F.lit(next_review)))
