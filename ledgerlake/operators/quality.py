"""Data-quality operators (DQ1-DQ40).

A suite is a list of check dicts (the Soda / Great Expectations / dbt test
vocabulary). ``run_suite`` compiles all row-level and uniqueness checks into **one**
pass over the frame (grouping sets: one per key, and one of all rows) and adds one
grouped pass per relationship check; the result is one row per check:
``(check, column, observed DOUBLE, expected STRING, status STRING)``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import round2

RESULT_SCHEMA = "check string, column string, observed double, expected string, status string"


def _lit_list(values) -> str:
    return "[" + ", ".join(str(v) for v in values) + "]"


@dataclass
class Compiled:
    name: str
    column: str
    observed: Column                      # aggregate expression (row-level checks)
    expected: str
    passes: Callable[[Column], Column]    # predicate over the observed value
    counts: bool = True                   # a count, which is 0 over no rows


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def compile_check(chk: dict) -> Compiled | None:
    """Row-level checks -> one aggregate expression each; checks of keys -> None."""
    kind = chk["type"]
    col = chk.get("column")
    zero = lambda o: o == 0
    if kind == "row_count_between":
        lo, hi = chk.get("min"), chk.get("max")

        def p(o, lo=lo, hi=hi):
            r = F.lit(True)
            if lo is not None:
                r = r & (o >= lo)
            if hi is not None:
                r = r & (o <= hi)
            return r
        exp = f"between {lo} and {hi}" if hi is not None else f">= {lo}"
        return Compiled(chk.get("name", kind), "", F.count(F.lit(1)), exp, p)
    if kind == "row_count_gt":
        v = chk.get("value", 0)
        return Compiled(chk.get("name", kind), "", F.count(F.lit(1)), f"> {v}", lambda o: o > v)
    if kind == "not_null":
        return Compiled(chk.get("name", kind), col, F.count_if(_q(col).isNull()), "= 0", zero)
    if kind == "min_ge":
        b = chk["bound"]
        return Compiled(chk.get("name", kind), col, F.min(_q(col)), f">= {b}", lambda o: o >= b, counts=False)
    if kind == "rows_below":
        b = chk["bound"]
        return Compiled(chk.get("name", kind), col, F.count_if(_q(col) < b), "= 0", zero)
    if kind == "accepted_values":
        vals = chk["values"]
        bad = _q(col).isNotNull() & ~_q(col).isin(*vals)
        return Compiled(chk.get("name", kind), col, F.count_if(bad), f"in {_lit_list(vals)}", zero)
    if kind == "between":
        lo, hi = chk.get("min"), chk.get("max")
        c = _q(col)
        out = F.lit(False)
        if lo is not None:
            out = out | (c < lo)
        if hi is not None:
            out = out | (c > hi)
        exp = f"between {lo} and {hi}" if hi is not None else f">= {lo}"
        return Compiled(chk.get("name", kind), col, F.count_if(c.isNotNull() & out), exp, zero)
    if kind == "not_match_regex":
        pat = chk["pattern"]
        return Compiled(chk.get("name", kind), col, F.count_if(_q(col).rlike(pat)), f"no match {pat}", zero)
    if kind == "mean_between":
        lo, hi = chk["min"], chk["max"]
        return Compiled(chk.get("name", kind), col, F.avg(_q(col)), f"between {lo} and {hi}",
                        lambda o: (o >= lo) & (o <= hi), counts=False)
    if kind == "length_between":
        lo, hi = chk["min"], chk["max"]
        ln = F.length(_q(col))
        return Compiled(chk.get("name", kind), col, F.count_if(_q(col).isNotNull() & ~ln.between(lo, hi)),
                        f"length between {lo} and {hi}", zero)
    if kind == "expression_true":
        e = chk["expr"]
        return Compiled(chk.get("name", kind), "", F.count_if(~F.coalesce(F.expr(e), F.lit(False))),
                        f"all rows: {e}", zero)
    if kind in ("unique", "duplicate_count", "relationship"):
        return None
    raise ValueError(f"unknown check type {kind}")


def _row(name, column, observed: Column, expected, passes: Column) -> Column:
    obs = F.round(observed.cast("double"), 4)
    return F.struct(F.lit(name).alias("check"), F.lit(column).alias("column"), obs.alias("observed"),
                    F.lit(expected).alias("expected"),
                    F.when(passes, "PASS").otherwise("FAIL").alias("status"))


def _key(chk: dict) -> tuple[str, ...]:
    col = chk["column"]
    return tuple(col) if isinstance(col, (list, tuple)) else (col,)


def run_suite(df: DataFrame, checks: list[dict]) -> DataFrame:
    """DQ11: run a declarative suite in one pass over the rows, turned into rows with ``inline`` (no second job).

    Uniqueness (DQ3: rows beyond the first of their key) and duplicate_count (values occurring more than once) of all keys
    come from one grouping by grouping sets, a set per key. The row-level checks are the aggregates of one more set,
    that of all rows. Rows with a null in the key are no duplicates; partial counts are made before the shuffle.
    """
    row_level = [(i, c) for i, c in ((i, compile_check(c)) for i, c in enumerate(checks)) if c is not None]
    keyed = [(i, _key(c), c) for i, c in enumerate(checks) if c["type"] in ("unique", "duplicate_count")]
    keys = list(dict.fromkeys(k for _, k, _ in keyed))
    observed = [c.observed.alias(f"_o{i}") for i, c in row_level]
    if keys:
        columns = list(dict.fromkeys(c for k in keys for c in k))

        def grouping(key) -> int:
            return sum(1 << (len(columns) - 1 - n) for n, c in enumerate(columns) if c not in key)

        sets = df.groupingSets([[_q(c) for c in k] for k in keys] + [[]], *[_q(c) for c in columns])
        groups = sets.agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"), *observed)
        final = [F.max(F.when(F.col("_set") == grouping(()), F.col(f"_o{i}"))).alias(f"_o{i}") for i, _ in row_level]
        for i, key, chk in keyed:
            mine = F.col("_set") == grouping(key)
            for c in key:
                mine = mine & _q(c).isNotNull()
            one = F.col("_n") - 1 if chk["type"] == "unique" else (F.col("_n") > 1).cast("bigint")
            final.append(F.coalesce(F.sum(F.when(mine, one)), F.lit(0)).alias(f"_o{i}"))
        agg = groups.agg(*final)
    elif row_level:
        agg = df.agg(*observed)
    rows = []
    for i, c in row_level:
        value = F.coalesce(F.col(f"_o{i}"), F.lit(0)) if c.counts else F.col(f"_o{i}")
        rows.append(_row(c.name, c.column, value, c.expected, c.passes(value)))
    rows += [_row(chk.get("name", chk["type"]), ",".join(key), F.col(f"_o{i}"), "= 0", F.col(f"_o{i}") == 0) for i, key, chk in keyed]
    parts = [agg.select(F.inline(F.array(*rows)))] if rows else []
    parts += [relationship_check(df, chk) for chk in checks if chk["type"] == "relationship"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def relationship_check(df: DataFrame, chk: dict) -> DataFrame:
    """dbt ``relationships`` (DQ6): fact rows whose key is missing in the
    dimension, counted with a ``left_anti`` join."""

    col, to, to_col = chk["column"], chk["to"], chk.get("to_column", chk["column"])
    keys = to.select(F.col(to_col).alias("_rk")).distinct()
    src = df.where(_q(col).isNotNull())
    orphans = src.join(keys, src[col] == keys["_rk"], "left_anti")
    agg = orphans.agg(F.count(F.lit(1)).alias("_obs"))
    return agg.select(F.inline(F.array(_row(chk.get("name", "relationship"), col, F.col("_obs"),
                                            f"in {chk.get('to_name', 'dimension')}.{to_col}",
                                            F.col("_obs") == 0))))


# ---------------------------------------------------------------------------
# DQ12-DQ40: single-pass profiles, labels, fixes and rule sets
# ---------------------------------------------------------------------------

def required_columns(log: DataFrame, required: list[str]) -> DataFrame:
    """DQ12: required columns missing per batch of a schema log; the set of
    present names per batch is bounded by the schema width."""
    req = F.array(*[F.lit(c) for c in required])
    return (log.groupBy("batch_id").agg(F.collect_set("column_name").alias("_cols"))
               .select("batch_id", F.explode(F.array_except(req, F.col("_cols"))).alias("column_name")))


def require_columns(columns: list[str], required: list[str]) -> None:
    """Raise, naming every column that a source lacks."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError("missing required columns: " + ", ".join(missing))


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """DQ14: % null per column (4 dp) and a has-nulls flag, one aggregate."""
    n = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = n.unpivot(["_rows"], columns, "column_name", "nulls")
    return long.select("column_name", round2(F.try_divide(F.col("nulls") * 100.0, F.col("_rows")), 4).alias("null_pct"),
                       (F.col("nulls") > 0).alias("has_nulls"))


def layer_profile(df: DataFrame, statuses: list[str]) -> DataFrame:
    """DQ15: rows, columns, status counts and amount min/max/mean in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("n_columns"),
                  *[F.count_if(F.col("status") == s).cast("bigint").alias(s.lower()) for s in statuses],
                  F.min("amount").cast("double").alias("amount_min"), F.max("amount").cast("double").alias("amount_max"),
                  round2(F.avg("amount")).alias("amount_mean"),
                  F.count_distinct("status").alias("distinct_statuses"))


def categorical_drift(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """DQ16: per shared column, do the distinct value sets of A and B differ.

    Only string columns are tested (compared by Spark ``StringType``, X18);
    numeric and date columns count as compared but never drift. The share is
    drifted / compared (2 dp) and the dataset drifts when any column does."""
    from pyspark.sql.window import Window as W

    from ledgerlake.operators.sets import distinct_value_diff
    types = dict(a.dtypes)
    strings = [c for c in columns if types.get(c) == "string"]
    others = [c for c in columns if c not in strings]
    d = distinct_value_diff(a, b, strings).select("column_name", "drifted") if strings else None
    if others:
        rest = a.sparkSession.createDataFrame([(c, False) for c in others], "column_name string, drifted boolean")
        d = rest if d is None else d.unionByName(rest)
    allw = W.partitionBy()  # over the handful of per-column rows only
    nd = F.count_if(F.col("drifted")).over(allw)
    n = F.count(F.lit(1)).over(allw)
    return d.select("column_name", "drifted", nd.cast("bigint").alias("drifted_columns"), n.alias("compared_columns"),
                    round2(nd / n, 2).alias("drift_share"), (nd > 0).alias("dataset_drift"))


def scorecard(df: DataFrame, columns: list[str], key: str, run_date) -> DataFrame:
    """DQ18: null rate, duplicate rate, schema match and overall 0-100 score."""
    nulls = None
    for c in columns:
        e = F.count_if(F.col(c).isNull())
        nulls = e if nulls is None else nulls + e
    a = df.agg(nulls.alias("nulls"), F.count(F.lit(1)).alias("rows"),
               (F.count_if(F.col(key).isNotNull()) - F.count_distinct(key)).alias("dups"))
    match = 1 if set(columns) <= set(df.columns) else 0
    nr = F.col("nulls") / (F.col("rows") * len(columns))
    dr = F.col("dups") / F.col("rows")
    return a.select(round2(nr, 6).alias("null_rate"), round2(dr, 6).alias("duplicate_rate"),
                    F.lit(match).alias("schema_match"),
                    round2((F.lit(1) - nr + F.lit(1) - dr + F.lit(match)) * 100.0 / 3, 2).alias("overall_score"),
                    F.lit(run_date).alias("run_date"))


def dirty_labels(bronze: DataFrame, merch: DataFrame, anchor) -> DataFrame:
    """DQ19: per-row array of labels. Duplicate ids come from a grouped count joined back (AQE splits a hot id). Rows with
    a null id can match none: each gets a join key of its own, so they are spread over the tasks instead of meeting in one."""
    # derived side: AQE broadcasts it from its real (runtime) size — no extra pass to probe it
    dup = (bronze.where(F.col("transaction_id").isNotNull()).groupBy(F.col("transaction_id").alias("_dk"))
                 .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_dk"))
    m = merch.select(F.col("merchant_id").alias("_mk"))
    nobody = F.concat(F.lit("\0"), F.xxhash64("tie1", "merchant_id", "ingestion_ts", "amount").cast("string"))
    own = bronze.withColumn("_jk", F.coalesce("transaction_id", nobody))
    j = own.join(dup, F.col("_jk") == F.col("_dk"), "left").join(m, F.col("merchant_id") == m._mk, "left")
    labels = F.array_compact(F.array(
        F.when(F.col("transaction_id").isNull(), F.lit("null_id")),
        F.when(F.col("amount") < 0, F.lit("negative_amount")),
        F.when(F.col("_dk").isNotNull(), F.lit("duplicate")),
        F.when(F.col("_mk").isNull(), F.lit("unmatched_merchant")),
        F.when((F.col("status") == "COMPLETED") & (F.col("amount") == 0), F.lit("zero_completed")),
        F.when(F.col("transaction_date") > F.lit(anchor), F.lit("future_date"))))
    return j.withColumn("labels", labels).drop("_dk", "_jk", "_mk")


def failure_gate(bronze: DataFrame, threshold_pct: float) -> DataFrame:
    """DQ20: failed share and the decision (HALT above the threshold)."""
    from ledgerlake.functions.scalars import pct
    # A value that did not cast is null, and a null amount or date is a failure.
    bad = (F.col("transaction_id").isNull() | F.col("amount").isNull() | (F.col("amount") < 0)
           | F.col("transaction_date").isNull())
    a = bronze.agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).cast("bigint").alias("failed_rows"))
    p = pct(F.col("failed_rows"), F.col("rows"))
    return a.select("rows", "failed_rows", p.alias("failed_pct"), F.lit(threshold_pct).alias("threshold_pct"),
                    F.when(p > threshold_pct, "HALT").otherwise("PROCEED").alias("decision"))


def enforce_gate(gate: DataFrame) -> dict:
    """Driver side of DQ20: one row comes back; raise when the gate says HALT."""
    row = gate.first().asDict()
    if row["decision"] == "HALT":
        raise RuntimeError(f"quality gate: {row['failed_pct']}% of rows failed (> {row['threshold_pct']}%)")
    return row


def fix_negative_to_zero(df: DataFrame, col: str = "amount") -> DataFrame:
    """DQ22."""
    return df.withColumn(col, F.greatest(F.col(col), F.lit(0).cast(df.schema[col].dataType)))


def fix_nulls(df: DataFrame, anchor) -> DataFrame:
    """DQ23: strings -> 'UNKNOWN', dates -> the anchor."""
    return (df.na.fill("UNKNOWN", ["transaction_id", "payment_method"])
              .withColumn("transaction_date", F.coalesce("transaction_date", F.lit(anchor))))


def cap_outliers(df: DataFrame, k: float, col: str = "amount") -> DataFrame:
    """DQ24: cap at k × mean. The mean is a scalar subquery (``DataFrame.scalar``),
    planned once and broadcast as a value — no cross join."""
    mean = df.agg(F.avg(col)).scalar()
    return df.withColumn(col, F.least(F.col(col), F.lit(k) * mean))


def _treated(anchor, cap: Column) -> dict[str, Column]:
    """The approved fixes of each column: DQ22 (negatives), DQ23 (nulls), future dates to the anchor, DQ24 (``cap``)."""
    return {"transaction_id": F.coalesce("transaction_id", F.lit("UNKNOWN")),
            "payment_method": F.coalesce("payment_method", F.lit("UNKNOWN")),
            "transaction_date": F.least(F.coalesce("transaction_date", F.lit(anchor)), F.lit(anchor)),
            "amount": F.least(F.greatest(F.col("amount"), F.lit(0).cast("decimal(18,2)")), cap)}


def treat(bronze: DataFrame, anchor, k: float) -> DataFrame:
    """DQ21: all approved fixes; outliers are capped at k x the untreated mean."""
    return bronze.withColumns(_treated(anchor, F.lit(k) * bronze.agg(F.avg("amount")).scalar()))


def treatment_before_after(bronze: DataFrame, anchor, k: float) -> DataFrame:
    """DQ21: rows per issue in the untreated and in the treated rows, by the same tests, from one pass over the rows
    beside the one that finds the mean."""
    cap = F.lit(k) * bronze.agg(F.avg("amount")).scalar()
    one = bronze.select("transaction_id", "payment_method", "transaction_date", "amount", cap.alias("_cap"))
    both = one.select("*", *[v.alias(f"_new_{c}") for c, v in _treated(anchor, F.col("_cap")).items()])

    def issues(new: str) -> dict[str, Column]:
        return {"negative_amount": F.col(f"{new}amount") < 0, "null_id": F.col(f"{new}transaction_id").isNull(),
                "future_date": F.col(f"{new}transaction_date") > F.lit(anchor), "outlier": F.col(f"{new}amount") > F.col("_cap")}

    before, after = issues(""), issues("_new_")
    counts = both.agg(*[F.count_if(t).cast("bigint").alias(f"b_{i}") for i, t in before.items()],
                      *[F.count_if(t).cast("bigint").alias(f"a_{i}") for i, t in after.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(i).alias("issue"), F.col(f"b_{i}").alias("before_count"), F.col(f"a_{i}").alias("after_count"))
                                            for i in before])))


def domain_violations(bronze: DataFrame, merch: DataFrame, anchor, method_limit) -> DataFrame:
    """DQ27: one row per (transaction, violated rule) with its severity."""
    m = merch.select(F.col("merchant_id").alias("_mk"))
    j = bronze.join(m, bronze.merchant_id == m._mk, "left")

    def rule(cond, name, sev):
        return F.when(cond, F.struct(F.lit(name).alias("rule"), F.lit(sev).alias("severity")))
    rules = F.array_compact(F.array(
        rule((F.col("payment_method") == method_limit[0]) & (F.col("amount") > method_limit[1]), "method_limit",
             "CRITICAL"),
        rule(~F.col("status").isin("COMPLETED", "FAILED", "PENDING"), "status_domain", "CRITICAL"),
        rule(F.col("_mk").isNull(), "unknown_merchant", "CRITICAL"),
        rule((F.col("status") == "COMPLETED") & (F.col("amount") == 0), "zero_success", "MINOR"),
        rule(F.col("transaction_date") > F.lit(anchor), "future_date", "CRITICAL")))
    return j.select("transaction_id", F.explode(rules).alias("v")).select("transaction_id", "v.rule", "v.severity")


def realism(orders: DataFrame, split_date) -> DataFrame:
    """DQ28: compare two halves of a table: mean, cardinality, null rate, and the distance of the value
    distributions of a category (half the sum of the differences of its shares)."""
    real = F.col("is_real")
    # One pass: by customer and category, then both are summed up. A customer of several categories is counted once.
    h = orders.withColumn("is_real", F.col("o_orderdate").cast("date") < F.lit(split_date))
    g = h.groupingSets([["is_real", "o_custkey"], ["is_real", "o_orderpriority"]], "is_real", "o_custkey", "o_orderpriority").agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"), F.count("o_totalprice").alias("priced"))
    by_customer, by_value = F.col("_set") == 1, F.col("_set") == 2
    sides = {"r": real, "s": ~real}
    flat = g.where(real.isNotNull()).groupBy(F.when(by_value, F.struct("o_orderpriority")).alias("_v")).agg(
        *[F.sum(F.when(side, F.col(c))).alias(f"{p}_{c}") for p, side in sides.items() for c in ("n", "total", "priced")],
        *[F.count_if(side & by_customer & F.col("o_custkey").isNotNull()).alias(f"{p}_customers") for p, side in sides.items()])
    w = _shares(flat)
    dm = F.least(F.lit(1.0), F.abs(F.col("s_mean_price") - F.col("r_mean_price")) / F.col("r_mean_price"))
    dc = F.least(F.lit(1.0), F.abs(F.col("s_card_customers") - F.col("r_card_customers")) / F.col("r_card_customers"))
    return w.select(round2("r_mean_price").alias("real_mean"), round2("s_mean_price").alias("synthetic_mean"),
                    F.col("r_card_customers").alias("real_customers"),
                    F.col("s_card_customers").alias("synthetic_customers"),
                    round2("r_null_rate", 6).alias("real_null_rate"), round2("s_null_rate", 6).alias("synthetic_null_rate"),
                    round2("dist", 6).alias("priority_distance"),
                    round2((F.lit(1) - dm) * 40 + (F.lit(1) - dc) * 30 + (F.lit(1) - F.col("dist")) * 30, 2).alias("realism_score"))


def _shares(flat: DataFrame) -> DataFrame:
    """From a row per category and one of the customers (``_v`` null): mean, customers, null rate of both sides and the distance
    of the categories' shares. The categories' rows are few; those of the customers are one."""
    value = F.col("_v").isNotNull()

    def total(c: str) -> Column:
        return F.coalesce(F.sum(F.when(value, F.col(c))), F.lit(0))

    pairs = F.collect_list(F.when(value, F.struct(F.coalesce("r_n", F.lit(0)).alias("r"), F.coalesce("s_n", F.lit(0)).alias("s"))))
    w = flat.agg(pairs.alias("pairs"), *[x for p in "rs" for x in (
        F.try_divide(total(f"{p}_total"), total(f"{p}_priced")).alias(f"{p}_mean_price"), F.max(F.when(~value, F.col(f"{p}_customers"))).alias(f"{p}_card_customers"),
        total(f"{p}_n").alias(f"{p}_rows"), F.try_divide(F.coalesce(F.sum(F.when(value & F.col("_v.o_orderpriority").isNull(), F.col(f"{p}_n"))), F.lit(0)),
                                                        total(f"{p}_n")).alias(f"{p}_null_rate"))])
    distance = F.aggregate("pairs", F.lit(0.0), lambda s, x: s + F.abs(x["r"] / F.col("r_rows") - x["s"] / F.col("s_rows"))) / 2
    return w.withColumn("dist", distance)


def _merchant_means(enr: DataFrame) -> DataFrame:
    """Per-merchant mean; a derived side, so AQE sizes the join at runtime."""
    return enr.groupBy(F.col("merchant_id").alias("_mm")).agg(F.avg("amount").alias("m_avg"))


def fraud_flags(enr: DataFrame, anchor, k: float, repeated: int) -> DataFrame:
    """DQ29: rule severities with a reason per flagged row."""
    mm = _merchant_means(enr)
    cf = (enr.where(F.col("status") == "FAILED").groupBy(F.col("customer_id").alias("_cf"))
             .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > repeated).select("_cf"))
    j = enr.join(mm, enr.merchant_id == mm._mm).join(cf, F.col("customer_id") == cf._cf, "left")
    fut = F.col("transaction_date") > F.lit(anchor)
    big = F.col("amount") > F.lit(k) * F.col("m_avg")
    rep = F.col("_cf").isNotNull() & (F.col("status") == "FAILED")
    sev = F.when(fut, "HIGH").when(big, "MEDIUM").when(rep, "LOW")
    reason = (F.when(fut, F.lit("dated in the future"))
               .when(big, F.lit(f"amount above {k} x merchant mean"))
               .when(rep, F.lit("customer with repeated failures")))
    return j.select("transaction_id", sev.alias("severity"), reason.alias("reason")).where(F.col("severity").isNotNull())


def false_positives(enr: DataFrame, k: float) -> DataFrame:
    """DQ30: customers blocked at threshold k, and the legitimate ones among them."""
    mm = _merchant_means(enr)
    bad = enr.where(F.col("status") == "FAILED").select(F.col("customer_id").alias("_bad")).distinct()
    j = (enr.join(mm, enr.merchant_id == mm._mm).where(F.col("amount") > F.lit(k) * F.col("m_avg"))
            .join(bad, F.col("customer_id") == bad._bad, "left"))
    return j.agg(F.count_distinct("customer_id").alias("blocked_customers"),
                 F.count_distinct(F.when(F.col("_bad").isNull(), F.col("customer_id"))).alias("false_positive_customers"))


def unusual_merchants(bronze: DataFrame, top: int = 3) -> DataFrame:
    """DQ31: high volume (count >= the mean count) and the most unusual mean
    amount (|z| over merchants), top 3. The mean and standard deviation over
    merchants are global aggregates (scalar subqueries, combined map-side) —
    no key-less window, so the merchant count can grow without limit."""
    m = bronze.where(F.col("amount") > 0).groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n"),
                                                                      F.avg("amount").alias("avg_amount"))
    stats = m.agg(F.avg("avg_amount").alias("mu"), F.stddev_samp("avg_amount").alias("sd"), F.avg("n").alias("mean_n"))
    z = (F.col("avg_amount") - stats.select("mu").scalar()) / stats.select("sd").scalar()
    return (m.where(F.col("n") >= stats.select("mean_n").scalar()).select("merchant_id", "n", "avg_amount", z.alias("z"))
             .orderBy(F.abs("z").desc(), "merchant_id").limit(top)
             .select("merchant_id", "n", round2("avg_amount").alias("avg_amount"), round2("z", 4).alias("z_score")))


SOURCE_ORDER = ["ingestion_ts", "tie1", "merchant_id", "amount", "tie2", "tie3", "tie4", "return_flag"]


def incident_duplicates(bronze: DataFrame, key: str = "transaction_id") -> DataFrame:
    """DQ34: which key crashed a primary-key load, its occurrences, and the
    rows loaded before it. All aggregates: first and second position per key
    (partial min), the global minimum of second positions, then two counts
    as uncorrelated scalar subqueries — no global row_number, nothing
    collected to the driver."""
    from ledgerlake.session import materialize
    # the narrow (key, position) projection is read four times: computed once
    b = materialize(bronze.where(F.col(key).isNotNull()).select(key, F.struct(*SOURCE_ORDER).alias("pos")), "positions")
    # only duplicated keys can crash the load: the join side is the duplicated keys alone
    first = (b.groupBy(F.col(key).alias("_k")).agg(F.min("pos").alias("p1"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1).drop("_n"))
    second = (b.join(first, (b[key] == first._k) & (b.pos > first.p1))
               .groupBy(key).agg(F.min("pos").alias("p2")))
    crash = materialize(second.orderBy("p2").limit(1), "crash")
    crash_key = crash.select(key).scalar()
    crash_pos = crash.select("p2").scalar()
    occurrences = b.where(F.col(key) == crash_key).agg(F.count(F.lit(1))).scalar()
    before = b.where(F.col("pos") < crash_pos).agg(F.count(F.lit(1))).scalar()
    return crash.select(F.col(key).alias("crash_key"), occurrences.alias("occurrences"),
                        before.alias("rows_loaded_before"))


def severity(results: DataFrame, error_checks: list[str], error_above: float) -> DataFrame:
    """DQ40: WARN / ERROR by the check's configured level and a threshold."""
    sev = (F.when(F.col("status") == "PASS", "OK")
            .when(F.col("check").isin(*error_checks), "ERROR")
            .when(F.col("observed") > error_above, "ERROR").otherwise("WARN"))
    return results.select("check", "column", "observed", "status", sev.alias("severity"))


# PII value patterns (email, payment card, phone) and the
# column-name hints of a PII column.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "card": r"(^|[^0-9])([0-9]{13,16}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,4})([^0-9]|$)",
    "phone": r"\+[0-9]{1,3} ?\(?[0-9]{3}\)?[ -]?[0-9]{3}-[0-9]{4}",
}
PII_NAME_HINTS = r"(?i)(email|phone|card|ssn|name)"


def pii_columns(df: DataFrame, table: str) -> DataFrame:
    """DQ35: per string column, rows whose value matches each PII pattern and
    their share — one aggregate over the table (whole texts), then unpivoted."""
    cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    names = []
    for c in cols:
        for p, rx in PII_PATTERNS.items():
            n = f"{c}__{p}"
            aggs.append(F.count_if(F.col(c).rlike(rx)).cast("bigint").alias(n))
            names.append(n)
    long = df.agg(*aggs).unpivot(["_rows"], names, "key", "matching_rows")
    parts = F.split("key", "__")
    return long.select(F.lit(table).alias("table_name"), parts[0].alias("column_name"), parts[1].alias("pii_type"),
                       "matching_rows", round2(F.col("matching_rows") * 100.0 / F.col("_rows"), 4).alias("share_pct"),
                       parts[0].rlike(PII_NAME_HINTS).alias("name_hint"))


def table_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """DQ36: table, column, type, nullable and row count of every table —
    the schema from the catalog, the count from one aggregate per table,
    all tables in one union (one job)."""
    out = None
    for name, df in tables.items():
        cols = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"),
                                  F.lit(f.nullable).alias("nullable")) for f in df.schema.fields])
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"),
                                                                    F.inline(cols), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def layer_lineage(bronze: DataFrame, enr: DataFrame) -> DataFrame:
    """DQ37: rows in / out / dropped for each layer edge, from one aggregate
    per layer (no count() job per edge)."""
    valid = F.col("transaction_id").isNotNull() & (F.col("amount") >= 0)
    b = bronze.agg(F.count(F.lit(1)).alias("b_rows"), F.count_distinct(F.when(valid, F.col("transaction_id")))
                   .alias("s_rows"))
    e = enr.agg(F.count(F.lit(1)).alias("e_rows"),
                F.count_distinct("merchant_id", "merchant_name", "category", "city", "transaction_date").alias("g_merch"),
                F.count_distinct("transaction_date").alias("g_daily"),
                F.count_distinct(F.when(F.col("status") == "COMPLETED", F.col("customer_id"))).alias("g_ltv"))
    row = b.select("b_rows", "s_rows", e.select("e_rows").scalar().alias("e_rows"),
                   e.select("g_merch").scalar().alias("g_merch"), e.select("g_daily").scalar().alias("g_daily"),
                   e.select("g_ltv").scalar().alias("g_ltv"))

    def edge(name, i, o):
        return F.struct(F.lit(name).alias("edge"), F.col(i).alias("rows_in"), F.col(o).alias("rows_out"),
                        (F.col(i) - F.col(o)).alias("dropped"))
    return row.select(F.inline(F.array(edge("bronze->silver", "b_rows", "s_rows"),
                                       edge("silver->enriched", "s_rows", "e_rows"),
                                       edge("enriched->gold.merchant_performance", "e_rows", "g_merch"),
                                       edge("enriched->gold.daily_summary", "e_rows", "g_daily"),
                                       edge("enriched->gold.customer_ltv", "e_rows", "g_ltv"))))


def run_anomaly(runs: DataFrame, metric: str, date_col: str, tolerance: float) -> DataFrame:
    """DQ38: each run's metric vs the mean of all previous runs; anomalous
    when it deviates by more than ``tolerance`` (a share). The window runs on
    the per-run frame (one row per run), never on raw rows."""
    from pyspark.sql.window import Window as W
    prev = W.orderBy(date_col).rowsBetween(W.unboundedPreceding, -1)
    m = F.avg(metric).over(prev)
    return runs.select(date_col, metric, round2(m, 2).alias("prev_mean"),
                       F.coalesce(F.abs(F.col(metric) - m) > F.lit(tolerance) * m, F.lit(False)).alias("anomaly"))
