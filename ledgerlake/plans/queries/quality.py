"""Registered data-quality queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators import aggregates as A
from ledgerlake.operators import quality as Q
from ledgerlake.plans import frames as FR
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import pct_sql, round_sql
from ledgerlake.plans.queries.aggregates import DAILY_SQL, PERF_SQL

ANCHOR = FR.ANCHOR_DATE
STATUSES = ["COMPLETED", "FAILED", "PENDING"]
METHODS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FAILURE_GATE = 5.0                       # DQ20: % of rows allowed to fail
MEAN_MIN, MEAN_MAX = 100, 100000         # DQ9 / GE mean bounds (a parameter, X22)
ROW_MIN, ROW_MAX = 1, 1_000_000_000      # GE row-count bounds re-scaled for the driver data
OUTLIER_K = 3                            # DQ24 cap at k x mean
FRAUD_K = 1.5                            # DQ29 amount > k x merchant mean
REPEATED_FAILURES = 3                    # DQ29 customer failures
METHOD_LIMIT = ("1-URGENT", 100000)      # DQ27 per-method amount limit (UPI 1 lakh analogue)


def _obs(expr):
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), 4) AS DOUBLE)"


def _check_sql(src: str, chk: dict, to_sql: dict | None = None) -> str:
    """Oracle SQL for one check: a one-row SELECT in the result shape."""
    kind, col = chk["type"], chk.get("column")
    name = chk.get("name", kind)
    column = ",".join(col) if isinstance(col, (list, tuple)) else (col or "")
    if kind == "row_count_between":
        lo, hi = chk.get("min"), chk.get("max")
        obs, exp = "COUNT(*)", (f"between {lo} and {hi}" if hi is not None else f">= {lo}")
        conds = ([f"o >= {lo}"] if lo is not None else []) + ([f"o <= {hi}"] if hi is not None else [])
        ok = " AND ".join(conds) or "TRUE"
    elif kind == "row_count_gt":
        v = chk.get("value", 0)
        obs, exp, ok = "COUNT(*)", f"> {v}", f"o > {v}"
    elif kind == "not_null":
        obs, exp, ok = f"COUNT(*) FILTER (WHERE {col} IS NULL)", "= 0", "o = 0"
    elif kind == "unique":
        cols = col if isinstance(col, (list, tuple)) else [col]
        nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        key = cols[0] if len(cols) == 1 else "(" + ", ".join(cols) + ")"
        obs = f"COUNT(*) FILTER (WHERE {nn}) - COUNT(DISTINCT {key}) FILTER (WHERE {nn})"
        exp, ok = "= 0", "o = 0"
    elif kind == "min_ge":
        b = chk["bound"]
        obs, exp, ok = f"MIN({col})", f">= {b}", f"o >= {b}"
    elif kind == "rows_below":
        b = chk["bound"]
        obs, exp, ok = f"COUNT(*) FILTER (WHERE {col} < {b})", "= 0", "o = 0"
    elif kind == "accepted_values":
        vals = chk["values"]
        inlist = ", ".join(f"'{v}'" for v in vals)
        obs = f"COUNT(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN ({inlist}))"
        exp, ok = "in [" + ", ".join(str(v) for v in vals) + "]", "o = 0"
    elif kind == "between":
        lo, hi = chk.get("min"), chk.get("max")
        out = " OR ".join(([f"{col} < {lo}"] if lo is not None else []) + ([f"{col} > {hi}"] if hi is not None else []))
        obs = f"COUNT(*) FILTER (WHERE {col} IS NOT NULL AND ({out}))"
        exp, ok = (f"between {lo} and {hi}" if hi is not None else f">= {lo}"), "o = 0"
    elif kind == "not_match_regex":
        pat = chk["pattern"]
        obs, exp, ok = f"COUNT(*) FILTER (WHERE regexp_matches({col}, '{pat}'))", f"no match {pat}", "o = 0"
    elif kind == "mean_between":
        lo, hi = chk["min"], chk["max"]
        obs, exp, ok = f"AVG({col})", f"between {lo} and {hi}", f"o >= {lo} AND o <= {hi}"
    elif kind == "length_between":
        lo, hi = chk["min"], chk["max"]
        obs = f"COUNT(*) FILTER (WHERE {col} IS NOT NULL AND NOT (length({col}) BETWEEN {lo} AND {hi}))"
        exp, ok = f"length between {lo} and {hi}", "o = 0"
    elif kind == "expression_true":
        e = chk["expr"]
        obs, exp, ok = f"COUNT(*) FILTER (WHERE NOT COALESCE({e}, FALSE))", f"all rows: {e}", "o = 0"
    elif kind == "duplicate_count":
        cols = col if isinstance(col, (list, tuple)) else [col]
        nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        g = ", ".join(cols)
        return (f"SELECT '{name}' AS \"check\", '{column}' AS \"column\", {_obs('o')} AS observed, '= 0' AS expected, "
                f"CASE WHEN o = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT COUNT(*) AS o FROM "
                f"(SELECT {g} FROM {src} WHERE {nn} GROUP BY {g} HAVING COUNT(*) > 1) d) x")
    elif kind == "relationship":
        to_src, to_col = to_sql[chk["to_name"]], chk.get("to_column", col)
        return (f"SELECT '{name}' AS \"check\", '{column}' AS \"column\", {_obs('o')} AS observed, "
                f"'in {chk['to_name']}.{to_col}' AS expected, "
                f"CASE WHEN o = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT COUNT(*) AS o FROM {src} s "
                f"WHERE s.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {to_src} r WHERE r.{to_col} = s.{col})) x")
    else:
        raise ValueError(kind)
    exp = exp.replace("'", "''")
    return (f"SELECT '{name}' AS \"check\", '{column}' AS \"column\", {_obs('o')} AS observed, '{exp}' AS expected, "
            f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT {obs} AS o FROM {src}) x")


def suite_sql(src: str, checks: list[dict], to_sql: dict | None = None) -> str:
    return "\nUNION ALL\n".join(_check_sql(src, c, to_sql) for c in checks)


# ---- suites (lists of checks) ----

ROW_COUNT_SUITE = [{"type": "row_count_gt", "name": "row_count_gt_0", "value": 0},
                   {"type": "row_count_between", "name": "row_count_between", "min": ROW_MIN, "max": ROW_MAX}]
BRONZE_COLS = ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date", "payment_method"]
NOT_NULL_SUITE = [{"type": "not_null", "column": c} for c in BRONZE_COLS]
UNIQUE_SUITE = [{"type": "unique", "column": "transaction_id"},
                {"type": "duplicate_count", "column": "transaction_id"},
                {"type": "unique", "name": "unique_composite", "column": ["transaction_id", "merchant_id"]}]
MIN_SUITE = [{"type": "min_ge", "column": "amount", "bound": 0},
             {"type": "rows_below", "column": "amount", "bound": 0}]
ACCEPTED_SUITE = [{"type": "accepted_values", "column": "status", "values": STATUSES},
                  {"type": "accepted_values", "column": "payment_method", "values": METHODS}]
RANGE_SUITE = [{"type": "between", "name": "rate_0_100", "column": "failure_rate_pct", "min": 0, "max": 100},
               {"type": "between", "name": "revenue_non_negative", "column": "total_revenue", "min": 0}]
REGEX_SUITE = [{"type": "not_match_regex", "column": "transaction_id", "pattern": "[^0-9-]"},
               {"type": "not_match_regex", "column": "payment_method", "pattern": "^ |  $"}]
MEAN_SUITE = [{"type": "mean_between", "column": "amount", "min": MEAN_MIN, "max": MEAN_MAX}]
LENGTH_SUITE = [{"type": "length_between", "column": "c_name", "min": 1, "max": 25},
                {"type": "length_between", "column": "c_mktsegment", "min": 1, "max": 10}]
EXPR_SUITE = [{"type": "expression_true", "name": "completed_has_amount",
               "expr": "status <> 'COMPLETED' OR amount > 0"},
              {"type": "expression_true", "name": "date_not_future", "expr": f"transaction_date <= DATE '{ANCHOR}'"}]

# The Great Expectations suite on the enriched Silver table (10 expectations).
# Names and bounds of the expectation suite.
GE_SUITE = [
    {"type": "row_count_between", "name": "expect_table_row_count_to_be_between", "min": ROW_MIN, "max": ROW_MAX},
    {"type": "not_null", "name": "expect_column_values_to_not_be_null", "column": "transaction_id"},
    {"type": "not_null", "name": "expect_column_values_to_not_be_null", "column": "amount"},
    {"type": "not_null", "name": "expect_column_values_to_not_be_null", "column": "status"},
    {"type": "not_null", "name": "expect_column_values_to_not_be_null", "column": "transaction_date"},
    {"type": "between", "name": "expect_column_values_to_be_between", "column": "amount", "min": 0},
    {"type": "unique", "name": "expect_column_values_to_be_unique", "column": "transaction_id"},
    {"type": "accepted_values", "name": "expect_column_values_to_be_in_set", "column": "status", "values": STATUSES},
    {"type": "accepted_values", "name": "expect_column_values_to_be_in_set", "column": "quality_flag",
     "values": ["CLEAN", "UNMATCHED"]},
    {"type": "mean_between", "name": "expect_column_mean_to_be_between", "column": "amount",
     "min": MEAN_MIN, "max": MEAN_MAX},
]

# The Soda data contract, run on Bronze read as an orders feed.
# Checks of the scan file.
SODA_SUITE = [
    {"type": "row_count_gt", "name": "row_count", "value": 0},
    {"type": "not_null", "name": "missing_count", "column": "transaction_id"},
    {"type": "duplicate_count", "name": "duplicate_count", "column": "transaction_id"},
    {"type": "not_null", "name": "missing_count", "column": "customer_id"},
    {"type": "min_ge", "name": "min", "column": "amount", "bound": 0},
    {"type": "accepted_values", "name": "invalid_count", "column": "status", "values": STATUSES},
]


def _suite_query(key, src_sql, build, checks, doc, to_sql=None):
    def fn(t):
        return Q.run_suite(build(t), checks)
    fn.__doc__ = doc
    query(key, suite_sql(src_sql, checks, to_sql))(fn)


_suite_query("dq_row_count", "silver", FR.silver_frame, ROW_COUNT_SUITE,
             "DQ1: row count > 0 and within bounds.")
_suite_query("dq_not_null", "bronze", FR.bronze_frame, NOT_NULL_SUITE,
             "DQ2: missing count = 0 per column.")
_suite_query("dq_unique", "bronze", FR.bronze_frame, UNIQUE_SUITE,
             "DQ3: single and composite key uniqueness; Soda duplicate_count.")
_suite_query("dq_min_bound", "bronze", FR.bronze_frame, MIN_SUITE, "DQ4: min >= bound; rows below bound.")
_suite_query("dq_accepted_values", "bronze", FR.bronze_frame, ACCEPTED_SUITE, "DQ5: values outside the set.")
_suite_query("dq_range", PERF_SQL + " p", lambda t: A.merchant_performance_total(FR.enr_frame(t)), RANGE_SUITE,
             "DQ7: failure rate in 0..100, revenue >= 0 on merchant Gold.")
_suite_query("dq_not_match_regex", "bronze", FR.bronze_frame, REGEX_SUITE, "DQ8: no value matches a pattern.")
_suite_query("dq_mean_between", "silver", FR.silver_frame, MEAN_SUITE, "DQ9: column mean in bounds.")
_suite_query("dq_value_length", "customer", lambda t: t.customer, LENGTH_SUITE,
             "DQ10: string length between bounds.")
_suite_query("dq_suite", "enr", FR.enr_frame, GE_SUITE,
             "DQ11: the expectation suite on enriched Silver, one aggregate pass.")
_suite_query("dq_suite_soda", "bronze", FR.bronze_frame, SODA_SUITE,
             "DQ11: the Soda contract on Bronze (duplicate_count as one grouped pass).")
_suite_query("dq_expression_true", "bronze", FR.bronze_frame, EXPR_SUITE,
             "DQ39: a row-level boolean expression holds on every row.")


@query("dq_relationship", suite_sql("bronze", [{"type": "relationship", "column": "merchant_id", "to_name": "merch"}],
                                    {"merch": "merch"}))
def dq_relationship(t):
    """DQ6: foreign key exists in the merchant dimension (``left_anti`` count)."""
    return Q.run_suite(FR.bronze_frame(t), [{"type": "relationship", "column": "merchant_id",
                                             "to": FR.merch_frame(t), "to_name": "merch"}])


# ---- schema / stage accounting ----

@query("required_columns", """
WITH feed AS (SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS batch_id,
                     CASE WHEN year(CAST(o_orderdate AS DATE)) = 1998 THEN NULL ELSE o_orderpriority END AS payment_method
              FROM orders),
b AS (SELECT batch_id, COUNT(payment_method) AS n FROM feed GROUP BY batch_id)
SELECT batch_id, 'payment_method' AS column_name FROM b WHERE n = 0""", frames=False)
def required_columns(t):
    """DQ12: required columns missing per batch of the incoming feed (from the
    inferred schema log); the pipeline raises when any is missing."""
    from ledgerlake.operators import drift as SD
    log = SD.infer_schema_log(SD.raw_feed(t.orders))
    return Q.required_columns(log, list(SD.EXPECTED_FEED_SCHEMA))


@query("stage_row_counts", """
SELECT 'input' AS stage, COUNT(*) AS rows FROM bronze
UNION ALL SELECT 'after_cast', COUNT(*) FROM bronze WHERE amount IS NOT NULL AND transaction_date IS NOT NULL
UNION ALL SELECT 'after_filter', COUNT(*) FROM bronze WHERE transaction_id IS NOT NULL AND amount >= 0
UNION ALL SELECT 'after_dedup', COUNT(*) FROM silver
UNION ALL SELECT 'after_enrich', COUNT(*) FROM enr
UNION ALL SELECT 'output', COUNT(*) FROM enr""")
def stage_row_counts(t):
    """DQ13: rows at input / after cast / filter / dedup / enrich / output, each observed on its own
    stage while one job runs through all of them."""
    from ledgerlake.plans import medallion as M
    return M.stage_counts(FR.bronze_frame(t), FR.merch_frame(t))


@query("null_rates", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {round_sql(f'100.0 * COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*)', 4)} AS null_pct, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL) > 0 AS has_nulls FROM bronze" for c in BRONZE_COLS))
def null_rates(t):
    """DQ14: % null per column and whether it has nulls — one aggregate, unpivoted."""
    return Q.null_rates(FR.bronze_frame(t), BRONZE_COLS)


@query("layer_profile", f"""
SELECT COUNT(*) AS rows, 11 AS n_columns,
       COUNT(*) FILTER (WHERE status = 'COMPLETED') AS completed, COUNT(*) FILTER (WHERE status = 'FAILED') AS failed,
       COUNT(*) FILTER (WHERE status = 'PENDING') AS pending, COUNT(*) FILTER (WHERE status = 'APPROVED') AS approved,
       CAST(MIN(amount) AS DOUBLE) AS amount_min, CAST(MAX(amount) AS DOUBLE) AS amount_max,
       {round_sql('AVG(amount)')} AS amount_mean, COUNT(DISTINCT status) AS distinct_statuses
FROM enr""")
def layer_profile(t):
    """DQ15: rows, columns, status counts, amount min/max/mean of a layer."""
    from ledgerlake.plans.queries.joins import SPARK_ENR_COLS
    return Q.layer_profile(FR.enr_frame(t).select(*SPARK_ENR_COLS), ["COMPLETED", "FAILED", "PENDING", "APPROVED"])


DRIFT_COLS = ["transaction_id", "amount", "status", "merchant_id", "customer_id", "transaction_date", "payment_method"]


STRING_DRIFT_COLS = ["transaction_id", "status", "payment_method"]   # the StringType columns of Bronze


@query("categorical_drift", """
WITH l AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, {s} AS side FROM {src} WHERE {c} IS NOT NULL"
    for src, s in (("bronze", 1), ("enr", 2)) for c in STRING_DRIFT_COLS) + """),
v AS (SELECT column_name, value, BIT_OR(side) AS sides FROM l GROUP BY 1, 2),
c AS (SELECT column_name, COUNT(*) FILTER (WHERE sides <> 3) > 0 AS drifted FROM v GROUP BY 1
      UNION ALL SELECT * FROM (VALUES ('amount', FALSE), ('merchant_id', FALSE), ('customer_id', FALSE),
                                      ('transaction_date', FALSE)) AS o(column_name, drifted))
SELECT column_name, drifted, COUNT(*) FILTER (WHERE drifted) OVER () AS drifted_columns,
       COUNT(*) OVER () AS compared_columns,
       """ + round_sql("(COUNT(*) FILTER (WHERE drifted) OVER ()) / (COUNT(*) OVER ())", 2) + """ AS drift_share,
       (COUNT(*) FILTER (WHERE drifted) OVER ()) > 0 AS dataset_drift
FROM c""")
def categorical_drift(t):
    """DQ16: per shared column, do the value sets of Bronze and enriched Silver
    differ (string columns only); drifted share and a dataset flag."""
    return Q.categorical_drift(FR.bronze_frame(t), FR.enr_frame(t), DRIFT_COLS)


SPLIT_DATE = dt.date(1998, 5, 1)        # DQ17/DQ28 reference half vs current half of orders
PSI_BIN = 50000                          # amount bin width


def _dist_sql():
    ref = f"CAST(o_orderdate AS DATE) < DATE '{SPLIT_DATE}'"
    eps = "0.0001"
    cat = lambda col: f"""SELECT '{col}' AS column_name, CAST({col} AS VARCHAR) AS bin,
        COUNT(*) FILTER (WHERE {ref}) AS n_ref, COUNT(*) FILTER (WHERE NOT ({ref})) AS n_cur FROM orders GROUP BY 1, 2"""  # noqa: E731
    num = f"""SELECT 'o_totalprice' AS column_name, CAST(CAST(FLOOR(o_totalprice / {PSI_BIN}) AS BIGINT) AS VARCHAR) AS bin,
        COUNT(*) FILTER (WHERE {ref}) AS n_ref, COUNT(*) FILTER (WHERE NOT ({ref})) AS n_cur FROM orders GROUP BY 1, 2"""
    ks = f"""WITH v AS (SELECT CAST(o_totalprice AS DECIMAL(18,2)) AS x, COUNT(*) FILTER (WHERE {ref}) AS a,
                          COUNT(*) FILTER (WHERE NOT ({ref})) AS b FROM orders GROUP BY 1),
        c AS (SELECT SUM(a) OVER (ORDER BY x) / SUM(a) OVER () AS fa, SUM(b) OVER (ORDER BY x) / SUM(b) OVER () AS fb FROM v)
        SELECT 'o_totalprice' AS column_name, MAX(ABS(fa - fb)) AS ks FROM c"""
    return f"""
WITH bins AS ({cat('o_orderstatus')} UNION ALL {cat('o_orderpriority')} UNION ALL {num}),
p AS (SELECT column_name, bin, n_ref * 1.0 / SUM(n_ref) OVER (PARTITION BY column_name) AS p_ref,
             n_cur * 1.0 / SUM(n_cur) OVER (PARTITION BY column_name) AS p_cur FROM bins),
s AS (SELECT column_name,
             SUM((GREATEST(p_cur, {eps}) - GREATEST(p_ref, {eps})) * LN(GREATEST(p_cur, {eps}) / GREATEST(p_ref, {eps}))) AS psi,
             SUM(ABS(p_cur - p_ref)) / 2 AS tv FROM p GROUP BY column_name),
k AS ({ks})
SELECT s.column_name, {round_sql('s.psi', 6)} AS psi, {round_sql('s.tv', 6)} AS total_variation,
       {round_sql('k.ks', 6)} AS ks, s.psi > 0.2 AS drifted
FROM s LEFT JOIN k ON s.column_name = k.column_name"""


@query("distribution_drift", _dist_sql(), frames=False)
def distribution_drift(t):
    """DQ17: reference half vs current half of orders: PSI and total
    variation over binned counts per column, exact two-sample KS for the
    numeric column (only buckets that can hold the maximum are sorted), drifted when PSI > 0.2."""
    from ledgerlake.operators.drift_stats import distribution_drift as dd
    o = t.orders.withColumn("_ref", F.col("o_orderdate").cast("date") < F.lit(SPLIT_DATE))
    return dd(o, "_ref", categorical=["o_orderstatus", "o_orderpriority"], numeric={"o_totalprice": PSI_BIN}).drop("refined_share")


@query("quality_scorecard", f"""
WITH n AS (SELECT {' + '.join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in BRONZE_COLS)} AS nulls,
                  COUNT(*) AS rows,
                  COUNT(*) FILTER (WHERE transaction_id IS NOT NULL) - COUNT(DISTINCT transaction_id) AS dups
           FROM bronze)
SELECT {round_sql(f'nulls * 1.0 / (rows * {len(BRONZE_COLS)})', 6)} AS null_rate,
       {round_sql('dups * 1.0 / rows', 6)} AS duplicate_rate, 1 AS schema_match,
       {round_sql(f'100.0 * ((1 - nulls * 1.0 / (rows * {len(BRONZE_COLS)})) + (1 - dups * 1.0 / rows) + 1) / 3', 2)} AS overall_score,
       DATE '{ANCHOR}' AS run_date
FROM n""")
def quality_scorecard(t):
    """DQ18: null rate (all cells), duplicate rate, schema match (0/1) and an
    overall score = 100 · mean(1 − null rate, 1 − duplicate rate, match) —
    our definition, as the reference names the score without a formula."""
    return Q.scorecard(FR.bronze_frame(t), BRONZE_COLS, "transaction_id", ANCHOR)


DIRTY_SQL = f"""
WITH d AS (SELECT transaction_id FROM bronze WHERE transaction_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1),
l AS (
  SELECT b.transaction_id, b.tie1, b.tie2, b.tie3, b.tie4, b.ingestion_ts, b.merchant_id, b.amount, b.return_flag,
         list_filter([CASE WHEN b.transaction_id IS NULL THEN 'null_id' END,
                      CASE WHEN b.amount < 0 THEN 'negative_amount' END,
                      CASE WHEN d.transaction_id IS NOT NULL THEN 'duplicate' END,
                      CASE WHEN m.merchant_id IS NULL THEN 'unmatched_merchant' END,
                      CASE WHEN b.status = 'COMPLETED' AND b.amount = 0 THEN 'zero_completed' END,
                      CASE WHEN b.transaction_date > DATE '{ANCHOR}' THEN 'future_date' END], lambda x: x IS NOT NULL) AS labels
  FROM bronze b LEFT JOIN d ON b.transaction_id = d.transaction_id
  LEFT JOIN merch m ON b.merchant_id = m.merchant_id)"""


@query("dirty_classification", DIRTY_SQL + """
SELECT transaction_id, tie1, merchant_id, CAST(amount AS DOUBLE) AS amount, array_to_string(labels, ',') AS labels FROM l""")
def dirty_classification(t):
    """DQ19: every Bronze row with its labels (null id, negative, duplicate, unmatched merchant, zero
    COMPLETED, future date), joined by commas; none for a clean row."""
    lab = Q.dirty_labels(FR.bronze_frame(t), FR.merch_frame(t), ANCHOR)
    return lab.select("transaction_id", "tie1", "merchant_id", F.col("amount").cast("double").alias("amount"),
                      F.array_join("labels", ",").alias("labels"))


@query("failure_gate", f"""
SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE transaction_id IS NULL OR amount IS NULL OR amount < 0 OR transaction_date IS NULL) AS failed_rows,
       {pct_sql('COUNT(*) FILTER (WHERE transaction_id IS NULL OR amount IS NULL OR amount < 0 OR transaction_date IS NULL)', 'COUNT(*)')} AS failed_pct,
       CAST({FAILURE_GATE} AS DOUBLE) AS threshold_pct,
       CASE WHEN {pct_sql('COUNT(*) FILTER (WHERE transaction_id IS NULL OR amount IS NULL OR amount < 0 OR transaction_date IS NULL)', 'COUNT(*)')} > {FAILURE_GATE}
            THEN 'HALT' ELSE 'PROCEED' END AS decision
FROM bronze""")
def failure_gate(t):
    """DQ20: share of rows failing the Silver rules from one aggregate; the
    pipeline halts before writing Silver when it exceeds 5 %."""
    return Q.failure_gate(FR.bronze_frame(t), FAILURE_GATE)


@query("treatment_before_after", f"""
WITH cap AS (SELECT {OUTLIER_K} * AVG(amount) AS c FROM bronze),
f AS (SELECT COALESCE(transaction_id, 'UNKNOWN') AS transaction_id,
             LEAST(GREATEST(amount, 0), (SELECT c FROM cap)) AS amount,
             LEAST(COALESCE(transaction_date, DATE '{ANCHOR}'), DATE '{ANCHOR}') AS transaction_date FROM bronze),
n AS (SELECT 'before' AS side, transaction_id, CAST(amount AS DOUBLE) AS amount, transaction_date FROM bronze
      UNION ALL SELECT 'after', transaction_id, CAST(amount AS DOUBLE), transaction_date FROM f),
i AS (SELECT side, 'negative_amount' AS issue, COUNT(*) FILTER (WHERE amount < 0) AS k FROM n GROUP BY 1
      UNION ALL SELECT side, 'null_id', COUNT(*) FILTER (WHERE transaction_id IS NULL) FROM n GROUP BY 1
      UNION ALL SELECT side, 'future_date', COUNT(*) FILTER (WHERE transaction_date > DATE '{ANCHOR}') FROM n GROUP BY 1
      UNION ALL SELECT side, 'outlier', COUNT(*) FILTER (WHERE amount > (SELECT c FROM cap)) FROM n GROUP BY 1)
SELECT issue, MAX(k) FILTER (WHERE side = 'before') AS before_count, MAX(k) FILTER (WHERE side = 'after') AS after_count
FROM i GROUP BY issue""")
def treatment_before_after(t):
    """DQ21: apply the approved fixes (negative -> 0, null id -> UNKNOWN,
    future date -> anchor, cap outliers) and count each issue before/after."""
    return Q.treatment_before_after(FR.bronze_frame(t), ANCHOR, OUTLIER_K)


@query("fix_negative_to_zero", """
SELECT transaction_id, CAST(GREATEST(amount, 0) AS DOUBLE) AS amount FROM bronze""")
def fix_negative_to_zero(t):
    """DQ22: negatives set to 0."""
    b = Q.fix_negative_to_zero(FR.bronze_frame(t))
    return b.select("transaction_id", F.col("amount").cast("double").alias("amount"))


@query("fix_nulls", f"""
SELECT COALESCE(transaction_id, 'UNKNOWN') AS transaction_id, COALESCE(payment_method, 'UNKNOWN') AS payment_method,
       COALESCE(transaction_date, DATE '{ANCHOR}') AS transaction_date FROM bronze""")
def fix_nulls(t):
    """DQ23: null ids/methods -> 'UNKNOWN', null dates -> the anchor (``na.fill`` / coalesce)."""
    b = Q.fix_nulls(FR.bronze_frame(t), ANCHOR)
    return b.select("transaction_id", "payment_method", "transaction_date")


@query("cap_outliers", f"""
SELECT transaction_id, CAST(LEAST(amount, {OUTLIER_K} * (SELECT AVG(amount) FROM silver)) AS DOUBLE) AS amount
FROM silver""")
def cap_outliers(t):
    """DQ24: amounts capped at 3 × the mean (a scalar subquery, no cross join)."""
    s = Q.cap_outliers(FR.silver_frame(t), OUTLIER_K)
    return s.select("transaction_id", F.col("amount").cast("double").alias("amount"))


@query("future_dates", f"""
SELECT transaction_id, transaction_date FROM bronze WHERE transaction_date > DATE '{ANCHOR}'""")
def future_dates(t):
    """DQ25: rows dated after the anchor."""
    return FR.bronze_frame(t).where(F.col("transaction_date") > F.lit(ANCHOR)).select("transaction_id",
                                                                                      "transaction_date")


@query("zero_value_completed", """
SELECT transaction_id, merchant_id FROM bronze WHERE status = 'COMPLETED' AND amount = 0""")
def zero_value_completed(t):
    """DQ26: COMPLETED with amount 0."""
    return FR.bronze_frame(t).where((F.col("status") == "COMPLETED") & (F.col("amount") == 0)).select(
        "transaction_id", "merchant_id")


@query("domain_rules", f"""
WITH r AS (
  SELECT b.transaction_id, b.tie1, b.ingestion_ts, b.merchant_id AS mid, b.amount,
         [CASE WHEN b.payment_method = '{METHOD_LIMIT[0]}' AND b.amount > {METHOD_LIMIT[1]} THEN {{'rule': 'method_limit', 'severity': 'CRITICAL'}} END,
          CASE WHEN b.status NOT IN ('COMPLETED', 'FAILED', 'PENDING') THEN {{'rule': 'status_domain', 'severity': 'CRITICAL'}} END,
          CASE WHEN m.merchant_id IS NULL THEN {{'rule': 'unknown_merchant', 'severity': 'CRITICAL'}} END,
          CASE WHEN b.status = 'COMPLETED' AND b.amount = 0 THEN {{'rule': 'zero_success', 'severity': 'MINOR'}} END,
          CASE WHEN b.transaction_date > DATE '{ANCHOR}' THEN {{'rule': 'future_date', 'severity': 'CRITICAL'}} END] AS v
  FROM bronze b LEFT JOIN merch m ON b.merchant_id = m.merchant_id)
SELECT transaction_id, x.rule, x.severity
FROM (SELECT transaction_id, unnest(list_filter(v, lambda e: e IS NOT NULL)) AS x FROM r) u""")
def domain_rules(t):
    """DQ27: impossible combinations (method limit, status domain, unknown merchant, zero success, future
    date) with CRITICAL / MINOR severity: a row per transaction and broken rule."""
    return Q.domain_violations(FR.bronze_frame(t), FR.merch_frame(t), ANCHOR, METHOD_LIMIT)


@query("realism_comparison", f"""
WITH h AS (SELECT *, CAST(o_orderdate AS DATE) < DATE '{SPLIT_DATE}' AS is_real FROM orders),
m AS (SELECT is_real, AVG(o_totalprice) AS mean_price, COUNT(DISTINCT o_custkey) AS card_customers,
             COUNT(DISTINCT o_orderpriority) AS card_methods,
             COUNT(*) FILTER (WHERE o_orderpriority IS NULL) * 1.0 / COUNT(*) AS null_rate FROM h GROUP BY 1),
r AS (SELECT * FROM m WHERE is_real), s AS (SELECT * FROM m WHERE NOT is_real),
v AS (SELECT o_orderpriority, COUNT(*) FILTER (WHERE is_real) * 1.0 / (SELECT COUNT(*) FROM h WHERE is_real) AS a,
             COUNT(*) FILTER (WHERE NOT is_real) * 1.0 / (SELECT COUNT(*) FROM h WHERE NOT is_real) AS b FROM h GROUP BY 1),
x AS (SELECT SUM(ABS(a - b)) / 2 AS dist FROM v)
SELECT {round_sql('r.mean_price', 2)} AS real_mean, {round_sql('s.mean_price', 2)} AS synthetic_mean,
       r.card_customers AS real_customers, s.card_customers AS synthetic_customers,
       {round_sql('r.null_rate', 6)} AS real_null_rate, {round_sql('s.null_rate', 6)} AS synthetic_null_rate,
       {round_sql('x.dist', 6)} AS priority_distance,
       {round_sql('40 * (1 - LEAST(1, ABS(s.mean_price - r.mean_price) / r.mean_price)) + 30 * (1 - LEAST(1, ABS(s.card_customers - r.card_customers) * 1.0 / r.card_customers)) + 30 * (1 - x.dist)', 2)} AS realism_score
FROM r, s, x""", frames=False)
def realism_comparison(t):
    """DQ28: 'real' (first half) vs 'synthetic' (second half) orders: mean,
    customer cardinality, null rate, distance of the priority distributions, and a 0-100
    realism score = 40·(1 − |Δmean|/mean) + 30·(1 − |Δcard|/card) + 30·(1 − distance),
    each term floored at 0 (our definition)."""
    return Q.realism(t.orders, SPLIT_DATE)


@query("fraud_flags", f"""
WITH mm AS (SELECT merchant_id, AVG(amount) AS m_avg FROM enr GROUP BY 1),
cf AS (SELECT customer_id FROM enr WHERE status = 'FAILED' GROUP BY 1 HAVING COUNT(*) > {REPEATED_FAILURES}),
f AS (SELECT e.transaction_id,
        CASE WHEN e.transaction_date > DATE '{ANCHOR}' THEN 'HIGH'
             WHEN e.amount > {FRAUD_K} * mm.m_avg THEN 'MEDIUM'
             WHEN cf.customer_id IS NOT NULL AND e.status = 'FAILED' THEN 'LOW' END AS severity,
        CASE WHEN e.transaction_date > DATE '{ANCHOR}' THEN 'dated in the future'
             WHEN e.amount > {FRAUD_K} * mm.m_avg THEN 'amount above {FRAUD_K} x merchant mean'
             WHEN cf.customer_id IS NOT NULL AND e.status = 'FAILED' THEN 'customer with repeated failures' END AS reason
      FROM enr e JOIN mm ON e.merchant_id = mm.merchant_id LEFT JOIN cf ON e.customer_id = cf.customer_id)
SELECT transaction_id, severity, reason FROM f WHERE severity IS NOT NULL""")
def fraud_flags(t):
    """DQ29: severity by rule — future date (HIGH), amount > 1.5 × the
    merchant's mean (MEDIUM), failure of a customer with > 3 failures (LOW) —
    with a one-line reason. Means and failure counts are aggregates joined
    back, not per-key windows; enriched Silver (three branches) is
    materialised once."""
    from ledgerlake.session import materialize
    return Q.fraud_flags(materialize(FR.enr_frame(t), "enr"), ANCHOR, FRAUD_K, REPEATED_FAILURES)


@query("false_positive_count", f"""
WITH mm AS (SELECT merchant_id, AVG(amount) AS m_avg FROM enr GROUP BY 1),
bad AS (SELECT DISTINCT customer_id FROM enr WHERE status = 'FAILED')
SELECT COUNT(DISTINCT e.customer_id) AS blocked_customers,
       COUNT(DISTINCT e.customer_id) FILTER (WHERE bad.customer_id IS NULL) AS false_positive_customers
FROM enr e JOIN mm ON e.merchant_id = mm.merchant_id LEFT JOIN bad ON e.customer_id = bad.customer_id
WHERE e.amount > {FRAUD_K} * mm.m_avg""")
def false_positive_count(t):
    """DQ30: distinct customers blocked by the amount rule at k = 1.5, and how
    many of them are legitimate (never had a FAILED transaction)."""
    from ledgerlake.session import materialize
    return Q.false_positives(materialize(FR.enr_frame(t), "enr"), FRAUD_K)


@query("unusual_merchants", f"""
WITH m AS (SELECT merchant_id, COUNT(*) AS n, AVG(amount) AS avg_amount FROM bronze WHERE amount > 0 GROUP BY 1),
z AS (SELECT *, (avg_amount - AVG(avg_amount) OVER ()) / STDDEV_SAMP(avg_amount) OVER () AS z,
             AVG(n) OVER () AS mean_n FROM m)
SELECT merchant_id, n, {round_sql('avg_amount')} AS avg_amount, {round_sql('z', 4)} AS z_score
FROM z WHERE n >= mean_n ORDER BY ABS(z) DESC, merchant_id LIMIT 3""")
def unusual_merchants(t):
    """DQ31: high-volume merchants (count ≥ mean count) with the most unusual
    mean amount (|z| over merchants), top 3. Windows run on the per-merchant
    aggregate only."""
    return Q.unusual_merchants(FR.bronze_frame(t))


@query("sample_reliability", f"""
SELECT report_date, total_revenue, total_txns,
       CASE WHEN total_txns <= 1 THEN 'UNRELIABLE' WHEN total_txns <= 2 THEN 'WEAK' ELSE 'OK' END AS sample_warning
FROM {DAILY_SQL} d""")
def sample_reliability(t):
    """DQ33: per day, n ≤ 1 unreliable, ≤ 2 weak, else OK."""
    d = A.daily_summary(FR.enr_frame(t))
    n = F.col("total_txns")
    return d.select("report_date", "total_revenue", "total_txns",
                    F.when(n <= 1, "UNRELIABLE").when(n <= 2, "WEAK").otherwise("OK").alias("sample_warning"))


@query("incident_duplicates", """
WITH b AS (SELECT transaction_id, (ingestion_ts, tie1, merchant_id, amount, tie2, tie3, tie4, return_flag) AS pos
           FROM bronze WHERE transaction_id IS NOT NULL),
f AS (SELECT transaction_id, MIN(pos) AS p1 FROM b GROUP BY 1),
s AS (SELECT b.transaction_id, MIN(b.pos) AS p2 FROM b JOIN f ON b.transaction_id = f.transaction_id AND b.pos > f.p1
      GROUP BY 1),
c AS (SELECT transaction_id, p2 FROM s ORDER BY p2 LIMIT 1)
SELECT c.transaction_id AS crash_key,
       (SELECT COUNT(*) FROM bronze x WHERE x.transaction_id = c.transaction_id) AS occurrences,
       (SELECT COUNT(*) FROM b WHERE b.pos < c.p2) AS rows_loaded_before
FROM c""")
def incident_duplicates(t):
    """DQ34: the key that crashed a primary-key load (the earliest second
    occurrence in source order), its occurrences, and how many rows were
    loaded before it. Source order is the total order of the Bronze feed."""
    return Q.incident_duplicates(FR.bronze_frame(t))


@query("dq_severity", f"""
WITH r AS ({suite_sql('enr', GE_SUITE)})
SELECT "check", "column", observed, status,
       CASE WHEN status = 'PASS' THEN 'OK' WHEN "check" IN ('expect_column_values_to_be_unique',
            'expect_column_values_to_not_be_null') THEN 'ERROR'
            WHEN observed > 100 THEN 'ERROR' ELSE 'WARN' END AS severity
FROM r""")
def dq_severity(t):
    """DQ40: failing checks become ERROR (key checks, or more than 100 failing
    rows) or WARN; passing ones OK."""
    res = Q.run_suite(FR.enr_frame(t), GE_SUITE)
    return Q.severity(res, ["expect_column_values_to_be_unique", "expect_column_values_to_not_be_null"], 100)


# ---- DQ32, DQ35-DQ38 ----

FLAGGED_AT = dt.datetime(2001, 8, 1, 9, 0, 0)


@query("flag_merchants", f"""
SELECT merchant_id, 'count >= 2 and mean amount below 50000' AS reason, TIMESTAMP '{FLAGGED_AT}' AS flagged_at
FROM enr GROUP BY merchant_id HAVING COUNT(*) >= 2 AND AVG(amount) < 50000""")
def flag_merchants(t):
    """DQ32: merchants flagged by the suspicious-average rule (A26) written with
    a reason and time as JSON to the shared folder, read back."""
    from ledgerlake.plans.queries.aggregates import SUSPICIOUS_MAX_AVG, SUSPICIOUS_MIN_TXNS
    from ledgerlake.session import scratch_path
    sus = A.suspicious_merchants(FR.enr_frame(t), SUSPICIOUS_MIN_TXNS, SUSPICIOUS_MAX_AVG)
    out = sus.select("merchant_id", F.lit(f"count >= {SUSPICIOUS_MIN_TXNS} and mean amount below {SUSPICIOUS_MAX_AVG}")
                     .alias("reason"), F.lit(FLAGGED_AT).cast("timestamp_ntz").alias("flagged_at"))
    path = scratch_path(t.spark, "flagged_merchants")
    out.write.mode("overwrite").json(path)
    return t.spark.read.schema("merchant_id bigint, reason string, flagged_at timestamp_ntz").json(path)


def _pii_sql(table, cols):
    parts = []
    for c in cols:
        for p, rx in Q.PII_PATTERNS.items():
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{p}' AS pii_type, "
                         f"COUNT(*) FILTER (WHERE regexp_matches({c}, '{rx}')) AS matching_rows, "
                         f"{round_sql(f'COUNT(*) FILTER (WHERE regexp_matches({c}, {chr(39)}{rx}{chr(39)})) * 100.0 / COUNT(*)', 4)} AS share_pct, "
                         f"regexp_matches('{c}', '{Q.PII_NAME_HINTS}') AS name_hint FROM {table}")
    return " UNION ALL ".join(parts)


@query("pii_columns", _pii_sql("documents", ["text", "lang", "source"]) + " UNION ALL "
       + _pii_sql("customer", ["c_name", "c_mktsegment"]), frames=False)
def pii_columns(t):
    """DQ35: per string column of documents and customer, rows matching each
    PII pattern (email, card, phone) over whole texts, their share, and a
    column-name hint."""
    return Q.pii_columns(t.documents, "documents").unionByName(Q.pii_columns(t.customer, "customer"))


CATALOG_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
                  "benchmark labels conversations").split()
_TYPE_SQL = """CASE c.data_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
  ELSE lower(c.data_type) END"""


@query("table_catalog", f"""
WITH n AS ({' UNION ALL '.join(f"SELECT '{x}' AS table_name, COUNT(*) AS row_count FROM {x}" for x in CATALOG_TABLES)})
SELECT c.table_name, c.column_name, {_TYPE_SQL} AS type, c.is_nullable = 'YES' AS nullable, n.row_count
FROM information_schema.columns c JOIN n ON c.table_name = n.table_name""", frames=False)
def table_catalog(t):
    """DQ36: table, column, type, nullable, row count for every driver table."""
    return Q.table_catalog({n: t.read(n) for n in CATALOG_TABLES})


@query("layer_lineage", """
WITH b AS (SELECT COUNT(*) AS b_rows, COUNT(DISTINCT transaction_id) FILTER (WHERE amount >= 0) AS s_rows FROM bronze),
e AS (SELECT COUNT(*) AS e_rows,
             (SELECT COUNT(*) FROM (SELECT DISTINCT merchant_id, merchant_name, category, city, transaction_date FROM enr
                                    WHERE merchant_id IS NOT NULL AND merchant_name IS NOT NULL AND category IS NOT NULL
                                      AND city IS NOT NULL AND transaction_date IS NOT NULL) x) AS g_merch,
             COUNT(DISTINCT transaction_date) AS g_daily,
             COUNT(DISTINCT customer_id) FILTER (WHERE status = 'COMPLETED') AS g_ltv FROM enr)
SELECT 'bronze->silver' AS edge, b_rows AS rows_in, s_rows AS rows_out, b_rows - s_rows AS dropped FROM b
UNION ALL SELECT 'silver->enriched', s_rows, e_rows, s_rows - e_rows FROM b, e
UNION ALL SELECT 'enriched->gold.merchant_performance', e_rows, g_merch, e_rows - g_merch FROM e
UNION ALL SELECT 'enriched->gold.daily_summary', e_rows, g_daily, e_rows - g_daily FROM e
UNION ALL SELECT 'enriched->gold.customer_ltv', e_rows, g_ltv, e_rows - g_ltv FROM e""")
def layer_lineage(t):
    """DQ37: rows in / out / dropped for each layer edge."""
    return Q.layer_lineage(FR.bronze_frame(t), FR.enr_frame(t))


ANOMALY_TOLERANCE = 0.5


@query("run_anomaly", f"""
WITH r AS (SELECT transaction_date AS run_date, COUNT(*) AS input_rows FROM bronze GROUP BY 1)
SELECT run_date, input_rows,
       {round_sql('AVG(input_rows) OVER (ORDER BY run_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)', 2)} AS prev_mean,
       COALESCE(ABS(input_rows - AVG(input_rows) OVER (ORDER BY run_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
                > {ANOMALY_TOLERANCE} * AVG(input_rows) OVER (ORDER BY run_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                FALSE) AS anomaly
FROM r""")
def run_anomaly(t):
    """DQ38: each daily run's input rows vs the mean of the previous runs."""
    runs = FR.bronze_frame(t).groupBy(F.col("transaction_date").alias("run_date")).agg(
        F.count(F.lit(1)).alias("input_rows"))
    return Q.run_anomaly(runs, "input_rows", "run_date", ANOMALY_TOLERANCE)
