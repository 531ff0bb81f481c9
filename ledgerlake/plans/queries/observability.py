"""Registered SLO / alert (§2.11) and log / completeness (§2.12) queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators import aggregates as A
from ledgerlake.operators import filters as P
from ledgerlake.operators import logs as N
from ledgerlake.operators import quality as Q
from ledgerlake.operators import slo as O
from ledgerlake.plans import frames as FR
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import pct_sql, round_sql
from ledgerlake.plans.queries.aggregates import PERF_SQL
from ledgerlake.plans.queries.filters import EXTRACT_SQL, LOG_SQL, _guard_sql
from ledgerlake.plans.queries.quality import GE_SUITE, suite_sql

S = O.SLO
EVENTS_NOW = dt.datetime(2024, 1, 31, 0, 0, 0)        # "now" of the event stream
ORDERS_NOW = dt.datetime(2001, 8, 2, 0, 0, 0)         # "now" of the order tables (day after the anchor)
NEW_VALUE_CUTOFF = dt.date(2001, 1, 1)
NEXT_REVIEW = dt.date(2001, 8, 2)
GROUPS = list(N.EXPECTED_ITEMS)


def _hours_sql(ts, now):
    return f"(epoch_us(TIMESTAMP '{now}') - epoch_us(CAST({ts} AS TIMESTAMP))) / 3.6e9"


@query("slo_freshness", f"""
SELECT MAX(ts) AS last_ts, {round_sql(_hours_sql('MAX(ts)', EVENTS_NOW))} AS hours_since,
       {S['freshness_hours']} AS threshold_hours, {_hours_sql('MAX(ts)', EVENTS_NOW)} > {S['freshness_hours']} AS breached
FROM events""")
def slo_freshness(t):
    """O1: hours since the newest event vs the 24 h freshness SLO."""
    return O.freshness(t.events, "ts", EVENTS_NOW, S["freshness_hours"])


QUALITY_SQL = f"""(SELECT COUNT(*) AS rows,
   COUNT(*) FILTER (WHERE b.transaction_id IS NOT NULL AND b.amount > 0 AND m.merchant_id IS NOT NULL) AS good_rows
 FROM bronze b LEFT JOIN merch m ON b.merchant_id = m.merchant_id)"""


@query("slo_quality_pct", f"""
SELECT rows, good_rows, {pct_sql('good_rows', 'rows')} AS quality_pct, CAST({S['quality_pct']} AS DOUBLE) AS threshold_pct,
       {pct_sql('good_rows', 'rows')} >= {S['quality_pct']} AS met
FROM {QUALITY_SQL} q""")
def slo_quality_pct(t):
    """O2: % of rows with an id, a positive amount and a known merchant vs 99.9 %."""
    return O.quality_pct(FR.bronze_frame(t), FR.merch_frame(t), S["quality_pct"])


BLO = round(S["row_min"] * (1 - S["row_buffer_pct"] / 100), 6)
BHI = round(S["row_max"] * (1 + S["row_buffer_pct"] / 100), 6)
DAILY_ROWS_SQL = "(SELECT transaction_date AS day, COUNT(*) AS rows FROM silver GROUP BY 1)"


@query("slo_row_count", f"""
SELECT day, rows, CAST({BLO} AS DOUBLE) AS min_allowed, CAST({BHI} AS DOUBLE) AS max_allowed, rows >= {BLO} AND rows <= {BHI} AS within
FROM {DAILY_ROWS_SQL} d""")
def slo_row_count(t):
    """O3: per day, Silver rows within [17, 25] widened by the 20 % buffer."""
    return O.row_count_slo(O.daily_rows(FR.silver_frame(t)), S["row_min"], S["row_max"], S["row_buffer_pct"])


RUNS_SQL = "(SELECT CAST(ts AS DATE) AS run_date, MIN(ts) AS started_at, MAX(ts) AS completed_at FROM events GROUP BY 1)"
RUNTIME_SQL = "(epoch_us(CAST(completed_at AS TIMESTAMP)) - epoch_us(CAST(started_at AS TIMESTAMP))) / 6e7"


@query("slo_runtime", f"""
SELECT run_date, {round_sql(RUNTIME_SQL)} AS runtime_minutes, {S['runtime_minutes']} AS limit_minutes,
       {RUNTIME_SQL} <= {S['runtime_minutes']} AS within
FROM {RUNS_SQL} r""")
def slo_runtime(t):
    """Run minutes (first to last event of each day's run) vs the 120-minute limit."""
    return O.runtime_slo(O.run_runtimes(t.events), S["runtime_minutes"])


@query("new_category_values", f"""
WITH l AS (SELECT transaction_date AS d, 'payment_method' AS column_name, CAST(payment_method AS VARCHAR) AS value FROM ord
           UNION ALL SELECT transaction_date, 'customer_id', CAST(customer_id AS VARCHAR) FROM ord)
SELECT column_name, value, MIN(d) AS first_seen FROM l WHERE value IS NOT NULL GROUP BY 1, 2
HAVING MIN(d) > DATE '{NEW_VALUE_CUTOFF}'""")
def new_category_values(t):
    """Values never seen before the cutoff (payment methods, and customers
    as a higher-cardinality example): first-seen date per value."""
    return O.new_values(FR.ord_frame(t), "transaction_date", ["payment_method", "customer_id"], NEW_VALUE_CUTOFF)


@query("failure_rate_spike", f"""
SELECT merchant_id, merchant_name, failure_rate_pct FROM {PERF_SQL} p WHERE failure_rate_pct > {S['failure_rate_spike_pct']}""")
def failure_rate_spike(t):
    """Merchants whose failure rate is above 30 %."""
    p = A.merchant_performance_total(FR.enr_frame(t))
    return p.where(F.col("failure_rate_pct") > S["failure_rate_spike_pct"]).select(
        "merchant_id", "merchant_name", "failure_rate_pct")


LO, HI, NEAR = S["row_min"], S["row_max"], S["near_bounds_pct"]


@query("near_bounds", f"""
SELECT day, rows, CASE WHEN rows <= {LO} * (1 + {NEAR} / 100) THEN 'low' ELSE 'high' END AS near
FROM {DAILY_ROWS_SQL} d WHERE rows >= {LO} AND rows <= {HI}
  AND (rows <= {LO} * (1 + {NEAR} / 100) OR rows >= {HI} * (1 - {NEAR} / 100))""")
def near_bounds(t):
    """Days inside the bounds but within 10 % of one."""
    return O.near_bounds(O.daily_rows(FR.silver_frame(t)), LO, HI, NEAR)


def layers(t):
    """Bronze and the enriched Silver made from it, each written once: one pass over the line items for all that reads them."""
    from ledgerlake.session import materialize
    bronze = materialize(FR.bronze_frame(t), "bronze")
    return bronze, materialize(FR.enrich(FR.dedup_latest(FR.silver_rules(bronze)), FR.merch_frame(t)), "enr")


def measures(t, bronze=None, enr=None):
    """One row of measures for the alert rules; every value is a scalar
    subquery over the data (no join of one-row frames). Bronze feeds one measure and enriched Silver
    three, so both are materialised once, unless given; both daily-count measures
    come from one aggregate over the per-day counts."""
    if enr is None:
        bronze, enr = layers(t)
    fresh = O.freshness(t.events, "ts", EVENTS_NOW, S["freshness_hours"])
    q = O.quality_pct(bronze, FR.merch_frame(t), S["quality_pct"]).select("quality_pct")
    daily = O.daily_rows(enr)
    r = F.col("rows")
    near = (r >= LO) & (r <= HI) & ((r <= LO * (1 + NEAR / 100)) | (r >= HI * (1 - NEAR / 100)))
    day_stats = daily.agg(F.count_if(~((r >= LO) & (r <= HI))).alias("oob"), F.count_if(near).alias("near"))
    rt = O.runtime_slo(O.run_runtimes(t.events), S["runtime_minutes"]).agg(F.max("runtime_minutes"))
    perf = A.merchant_performance_total(enr)
    spikes = perf.where(F.col("failure_rate_pct") > S["failure_rate_spike_pct"]).agg(F.count(F.lit(1)))
    newm = O.new_values(FR.ord_frame(t), "transaction_date", ["payment_method"], NEW_VALUE_CUTOFF).agg(F.count(F.lit(1)))
    return fresh.select(F.col("hours_since").alias("freshness_hours"), q.scalar().alias("quality_pct"),
                        day_stats.select("oob").scalar().alias("days_out_of_bounds"),
                        rt.scalar().alias("max_runtime_minutes"),
                        spikes.scalar().alias("spiking_merchants"), newm.scalar().alias("new_methods"),
                        day_stats.select("near").scalar().alias("days_near_bounds"))


MEASURES_SQL = f"""m AS (SELECT
  (SELECT {round_sql(_hours_sql('MAX(ts)', EVENTS_NOW))} FROM events) AS freshness_hours,
  (SELECT {pct_sql('good_rows', 'rows')} FROM {QUALITY_SQL} q) AS quality_pct,
  (SELECT COUNT(*) FILTER (WHERE NOT (rows >= {LO} AND rows <= {HI})) FROM {DAILY_ROWS_SQL} d) AS days_out_of_bounds,
  (SELECT MAX({round_sql(RUNTIME_SQL)}) FROM {RUNS_SQL} r) AS max_runtime_minutes,
  (SELECT COUNT(*) FROM {PERF_SQL} p WHERE failure_rate_pct > {S['failure_rate_spike_pct']}) AS spiking_merchants,
  (SELECT COUNT(*) FROM (SELECT payment_method FROM ord WHERE payment_method IS NOT NULL GROUP BY 1
                         HAVING MIN(transaction_date) > DATE '{NEW_VALUE_CUTOFF}') x) AS new_methods,
  (SELECT COUNT(*) FROM {DAILY_ROWS_SQL} d WHERE rows >= {LO} AND rows <= {HI}
     AND (rows <= {LO} * (1 + {NEAR} / 100) OR rows >= {HI} * (1 - {NEAR} / 100))) AS days_near_bounds)"""

RULES_SQL = [
    ("data_freshness_exceeded", "CRITICAL", f"freshness_hours > {S['freshness_hours']}", "freshness_hours",
     "data older than the freshness limit"),
    ("data_quality_below_threshold", "CRITICAL", "quality_pct < 99.9", "quality_pct",
     "quality below the SLO"),
    ("row_count_out_of_bounds", "CRITICAL", "days_out_of_bounds > 0", "days_out_of_bounds",
     "daily row count outside the bounds"),
    ("pipeline_runtime_approaching_limit", "WARNING",
     f"max_runtime_minutes > {S['runtime_minutes'] * S['runtime_warn_share']}", "max_runtime_minutes",
     "runtime near or over the limit"),
    ("data_quality_slightly_below_threshold", "WARNING",
     f"quality_pct >= {S['quality_warn_pct']} AND quality_pct < {S['quality_pct']}", "quality_pct",
     "quality slightly below the SLO"),
    ("merchant_failure_rate_spike", "WARNING", "spiking_merchants > 0", "spiking_merchants",
     "a merchant's failure rate is above the spike limit"),
    ("new_payment_method_detected", "INFO", "new_methods > 0", "new_methods", "new payment method values"),
    ("row_count_near_bounds", "INFO", "days_near_bounds > 0", "days_near_bounds", "daily row count close to a bound"),
]
ALERTS_SQL = f"WITH {MEASURES_SQL}\n" + "\nUNION ALL\n".join(
    f"SELECT '{sev}' AS severity, '{name}' AS rule, {round_sql(obs, 4)} AS observed, '{msg.replace(chr(39), chr(39) * 2)}' AS message "
    f"FROM m WHERE {cond}" for name, sev, cond, obs, msg in RULES_SQL)


@query("alert_rules", ALERTS_SQL)
def alert_rules(t):
    """3 CRITICAL, 3 WARNING and 2 INFO rules evaluated; one row per fired alert."""
    return O.evaluate_alerts(measures(t))


@query("scorecard_verdict", f"""
WITH r AS ({suite_sql('enr', GE_SUITE)})
SELECT COUNT(*) FILTER (WHERE status = 'PASS') AS passed, COUNT(*) AS checks,
       {round_sql("COUNT(*) FILTER (WHERE status = 'PASS') * 100.0 / COUNT(*)", 2)} AS score_pct,
       CASE WHEN COUNT(*) FILTER (WHERE status = 'PASS') = COUNT(*) THEN 'SHIP'
            WHEN COUNT(*) FILTER (WHERE status = 'PASS') * 5 >= COUNT(*) * 3 THEN 'CONDITIONAL SHIP'
            ELSE 'DOESN''T SHIP' END AS verdict
FROM r""")
def scorecard_verdict(t):
    """Pass flags of the expectation suite -> score -> verdict."""
    return O.scorecard_verdict(Q.run_suite(FR.enr_frame(t), GE_SUITE))


@query("alert_summary", f"""
WITH a AS ({ALERTS_SQL})
SELECT COUNT(*) FILTER (WHERE severity = 'CRITICAL') AS critical, COUNT(*) FILTER (WHERE severity = 'WARNING') AS warning,
       COUNT(*) FILTER (WHERE severity = 'INFO') AS info,
       (SELECT rule FROM a ORDER BY CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'WARNING' THEN 2 ELSE 1 END DESC, rule
        LIMIT 1) AS top_issue, DATE '{NEXT_REVIEW}' AS next_review
FROM a""")
def alert_summary(t):
    """Alert counts by severity, the top issue and the next review date."""
    return O.alert_summary(O.evaluate_alerts(measures(t)), NEXT_REVIEW)


WARN_HOURS, ERROR_HOURS = 12, 24    # O11 freshness classes


@query("source_freshness", f"""
WITH f AS (
SELECT 'events' AS source, CAST(MAX(ts) AS TIMESTAMP) AS newest, {round_sql(_hours_sql('MAX(ts)', EVENTS_NOW))} AS hours_since FROM events
UNION ALL SELECT 'orders', CAST(MAX(transaction_date) AS TIMESTAMP), {round_sql(_hours_sql('MAX(transaction_date)', ORDERS_NOW))} FROM ord
UNION ALL SELECT 'bronze', CAST(MAX(ingestion_ts) AS TIMESTAMP), {round_sql(_hours_sql('MAX(ingestion_ts)', ORDERS_NOW))} FROM bronze)
SELECT *, CASE WHEN hours_since > {ERROR_HOURS} THEN 'ERROR' WHEN hours_since > {WARN_HOURS} THEN 'WARN' ELSE 'OK' END AS status
FROM f""")
def source_freshness(t):
    """Per source, hours since its newest row and its class: WARN after
    12 h, ERROR after 24 h, else OK."""
    parts = [("events", t.events, "ts", EVENTS_NOW), ("orders", FR.ord_frame(t), "transaction_date", ORDERS_NOW),
             ("bronze", FR.bronze_frame(t), "ingestion_ts", ORDERS_NOW)]
    out = None
    for name, df, c, now in parts:
        f = df.agg(F.max(c).cast("timestamp_ntz").alias("newest")).select(
            F.lit(name).alias("source"), "newest",
            O.round2(O.hours_between(F.col("newest").cast("timestamp"), F.lit(now).cast("timestamp"))).alias("hours_since"))
        out = f if out is None else out.unionByName(f)
    h = F.col("hours_since")
    return out.withColumn("status", F.when(h > ERROR_HOURS, "ERROR").when(h > WARN_HOURS, "WARN").otherwise("OK"))


# ---- §2.12 logs, traces, completeness ----

N1_SQL = """
WITH c AS (SELECT conv_id, COUNT(*) FILTER (WHERE lower(role) = 'assistant') AS n_assistant,
                  COUNT(*) FILTER (WHERE lower(role) = 'system') AS n_system,
                  COUNT(*) FILTER (WHERE lower(role) = 'user') AS n_user FROM conversations GROUP BY conv_id),
s AS (SELECT CAST(conv_id AS VARCHAR) AS entity,
  CASE WHEN NOT (n_user >= 1 OR n_assistant >= 1) THEN 'missing'
       WHEN n_user >= 1 AND n_assistant >= 1 THEN 'complete' ELSE 'partial' END AS opening_status,
  CASE WHEN NOT (n_user >= 2 OR n_assistant >= 2 OR n_system >= 1) THEN 'missing'
       WHEN n_user >= 2 AND n_assistant >= 2 AND n_system >= 1 THEN 'master'
       WHEN n_user >= 2 AND n_assistant >= 2 THEN 'complete' ELSE 'partial' END AS dialogue_status
  FROM c)"""


@query("expected_file_status", N1_SQL + " SELECT * FROM s", frames=False)
def expected_file_status(t):
    """Conversation × expected roles -> missing / partial / complete /
    master per group (the 'dialogue' group has a master tier: core user +
    assistant turns, extra a system turn)."""
    return N.expected_item_status(t.conversations)


@query("status_totals", N1_SQL + """
SELECT g AS "group", COUNT(*) FILTER (WHERE st = 'master') AS master, COUNT(*) FILTER (WHERE st = 'complete') AS complete,
       COUNT(*) FILTER (WHERE st = 'partial') AS partial, COUNT(*) FILTER (WHERE st = 'missing') AS missing,
       COUNT(*) AS total, COUNT(*) FILTER (WHERE st <> 'missing') AS submitted
FROM (SELECT 'opening' AS g, opening_status AS st FROM s UNION ALL SELECT 'dialogue', dialogue_status FROM s) x
GROUP BY g""", frames=False)
def status_totals(t):
    """Entities per status per group (pivot), total and submitted."""
    return N.status_totals(N.expected_item_status(t.conversations), GROUPS)


@query("status_rank_sort", N1_SQL + """
SELECT entity, opening_status, dialogue_status,
       GREATEST(CASE opening_status WHEN 'master' THEN 0 WHEN 'complete' THEN 1 WHEN 'partial' THEN 2 ELSE 3 END,
                CASE dialogue_status WHEN 'master' THEN 0 WHEN 'complete' THEN 1 WHEN 'partial' THEN 2 ELSE 3 END) AS worst_rank,
       (CASE WHEN opening_status = 'complete' THEN 1 ELSE 0 END) + (CASE WHEN dialogue_status = 'complete' THEN 1 ELSE 0 END)
         AS complete_groups
FROM s ORDER BY worst_rank, complete_groups DESC, lower(entity)""", frames=False)
def status_rank_sort(t):
    """T5: custom-rank multi-key sort: worst status, most complete groups, lower(name)."""
    return N.status_rank_sort(N.expected_item_status(t.conversations), GROUPS)


@query("case_insensitive_lookup", """
WITH names AS (SELECT upper(s_name) AS input_name FROM supplier UNION ALL SELECT c_name FROM customer)
SELECT n.input_name, COALESCE(s.s_name, n.input_name) AS canonical_name, s.s_name IS NOT NULL AS known
FROM names n LEFT JOIN supplier s ON lower(n.input_name) = lower(s.s_name)""", frames=False)
def case_insensitive_lookup(t):
    """Names (upper-cased supplier names and customer names) mapped to the
    canonical supplier name by a lower-cased join; unknown names map to themselves."""
    names = t.supplier.select(F.upper("s_name").alias("input_name")).unionByName(
        t.customer.select(F.col("c_name").alias("input_name")))
    return N.case_insensitive_lookup(names, t.supplier, "input_name", "s_name")


GUARD_SQL = f"""(SELECT source, entry_id, sql, {_guard_sql('sql')} AS reason
  FROM (SELECT source, entry_id, turn, {EXTRACT_SQL} AS sql FROM {LOG_SQL} l) e)"""


@query("query_audit_summary", f"""
SELECT CASE WHEN reason = 'ok' THEN 'executed' ELSE 'rejected' END AS status, reason, COUNT(*) AS entries,
       COUNT(DISTINCT source) AS sources
FROM {GUARD_SQL} g GROUP BY 1, 2""", frames=False)
def query_audit_summary(t):
    """The audit log (JSON records of every guarded query) parsed back
    with ``from_json`` and counted by status and reason."""
    g = P.sql_text_guard(P.sql_text_extract(P.query_log(t.orders, t.conversations)))
    return N.audit_summary(N.audit_log(g))


@query("issue_counts_by_severity", f"""
WITH e AS (SELECT entry_id, upper(sql) AS s FROM (SELECT source, entry_id, turn, {EXTRACT_SQL} AS sql FROM {LOG_SQL} l) x
           WHERE sql IS NOT NULL),
i AS (SELECT CASE WHEN contains(s, 'SELECT *') THEN 1 END AS a,
             CASE WHEN regexp_matches(s, '(^|[^A-Z0-9_])(DROP|DELETE|TRUNCATE)([^A-Z0-9_]|$)') THEN 1 END AS b,
             CASE WHEN NOT contains(s, 'WHERE') THEN 1 END AS c,
             CASE WHEN contains(s, 'COUNT(*)') AND NOT contains(s, 'GROUP BY') THEN 1 END AS d FROM e)
SELECT 'LOW' AS severity, 'performance' AS category, COUNT(a) AS issues FROM i HAVING COUNT(a) > 0
UNION ALL SELECT 'CRITICAL', 'security', COUNT(b) FROM i HAVING COUNT(b) > 0
UNION ALL SELECT 'MEDIUM', 'performance', COUNT(c) FROM i HAVING COUNT(c) > 0
UNION ALL SELECT 'LOW', 'readability', COUNT(d) FROM i HAVING COUNT(d) > 0""", frames=False)
def issue_counts_by_severity(t):
    """Lint-style review records (nested JSON with an issues array) for
    every extracted SQL, exploded and counted per severity and category."""
    sqls = P.sql_text_extract(P.query_log(t.orders, t.conversations))
    return N.issue_counts(N.review_issues(sqls))


@query("span_counts", """
SELECT role AS kind, COUNT(*) AS spans, CAST(SUM(length(text)) AS BIGINT) AS total_chars,
       CAST(SUM(CASE WHEN length(trim(text)) > 0 THEN len(regexp_split_to_array(trim(text), '\\s+')) ELSE 0 END) AS BIGINT) AS total_words
FROM conversations GROUP BY role""", frames=False)
def span_counts(t):
    """Spans per kind (conversation role = span kind) with size totals."""
    return N.span_counts(t.conversations)


@query("latency_comparison", f"""
WITH a AS (SELECT user_id, COUNT(*) AS a_n, AVG(value) AS a_avg FROM events WHERE event_type = 'click' GROUP BY 1),
b AS (SELECT user_id, COUNT(*) AS b_n, AVG(value) AS b_avg FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT COALESCE(a.user_id, b.user_id) AS user_id, COALESCE(a_n, 0) AS a_n, {round_sql('a_avg', 4)} AS a_avg,
       COALESCE(b_n, 0) AS b_n, {round_sql('b_avg', 4)} AS b_avg,
       CASE WHEN a_avg < b_avg THEN 'click' WHEN b_avg < a_avg THEN 'view' ELSE 'tie' END AS faster
FROM a FULL OUTER JOIN b ON a.user_id = b.user_id""", frames=False)
def latency_comparison(t):
    """Two systems' timed answers joined by question — per user, click vs view mean value."""
    return N.latency_comparison(t.events, "click", "view")
