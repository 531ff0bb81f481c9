"""Registered schema drift / evolution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import drift as SD
from ledgerlake.operators import sets as U
from ledgerlake.plans import frames as FR
from ledgerlake.plans.catalog import query
from ledgerlake.plans.queries.windows import VERSION_FIELDS, VERSION_TYPES, schema_versions, versioned_rows
from ledgerlake.session import materialize

D = "CAST(o_orderdate AS DATE)"
NEW = f"{D} >= DATE '2000-01-01'"
AMT = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
FEED_SQL = f"""(SELECT strftime({D}, '%Y-%m') AS batch_id, CAST(o_orderkey AS VARCHAR) AS transaction_id,
   CASE WHEN {D} >= DATE '1999-06-01' AND {D} < DATE '2000-01-01' THEN 'USD ' || {AMT} ELSE {AMT} END AS amount,
   o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS customer_id, CAST({D} AS VARCHAR) AS transaction_date,
   CASE WHEN year({D}) = 1998 THEN NULL ELSE o_orderpriority END AS payment_method,
   CASE WHEN {NEW} THEN 'GW' || CAST(o_orderkey % 3 AS VARCHAR) END AS payment_gateway,
   CASE WHEN {NEW} THEN CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS VARCHAR) END AS discount_amount,
   CASE WHEN {NEW} THEN CASE WHEN o_orderkey % 7 = 0 THEN 'true' ELSE 'false' END END AS refund_flag
 FROM orders)"""


def _log_sql(feed=FEED_SQL, columns=SD.FEED_COLUMNS):
    aggs = []
    for c in columns:
        aggs += [f"COUNT({c}) AS {c}__n",
                 f"COUNT(*) FILTER (WHERE lower({c}) IN ('true', 'false')) AS {c}__bool",
                 f"COUNT(*) FILTER (WHERE regexp_matches({c}, '^-?[0-9]{{1,18}}$')) AS {c}__int",
                 f"COUNT(*) FILTER (WHERE regexp_matches({c}, '^-?[0-9]+(\\.[0-9]+)?$')) AS {c}__dec",
                 f"COUNT(*) FILTER (WHERE TRY_CAST({c} AS DATE) IS NOT NULL AND regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$')) AS {c}__date"]
    per = " UNION ALL ".join(
        f"""SELECT batch_id, '{c}' AS column_name, {c}__n AS n,
              CASE WHEN {c}__bool = {c}__n THEN 'boolean' WHEN {c}__int = {c}__n THEN 'bigint'
                   WHEN {c}__dec = {c}__n THEN 'double' WHEN {c}__date = {c}__n THEN 'date' ELSE 'string' END AS type
            FROM wide""" for c in columns)
    return f"""wide AS (SELECT batch_id, {', '.join(aggs)} FROM {feed} f GROUP BY batch_id),
log AS (SELECT batch_id, column_name, type FROM ({per}) p WHERE n > 0)"""


EXP_SQL = "exp AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', '{v}')" for k, v in SD.EXPECTED_FEED_SCHEMA.items()) + ") AS e(column_name, expected_type))"
ORDER = "[" + ", ".join(f"'{x}'" for x in SD.TYPE_ORDER) + "]"


def _widen(e, a):
    return (f"({a} = 'string' OR (COALESCE(list_position({ORDER}, {e}), 0) > 0 AND "
            f"COALESCE(list_position({ORDER}, {a}), 0) > COALESCE(list_position({ORDER}, {e}), 0)))")


DIFF_SQL = f"""WITH {_log_sql()}, {EXP_SQL},
present AS (SELECT l.batch_id, l.column_name,
                   CASE WHEN e.expected_type IS NULL THEN 'new' WHEN e.expected_type <> l.type THEN 'type_changed' END AS change,
                   e.expected_type, l.type AS actual_type
            FROM log l LEFT JOIN exp e ON l.column_name = e.column_name),
diff AS (SELECT * FROM present WHERE change IS NOT NULL
         UNION ALL
         SELECT b.batch_id, e.column_name, 'removed', e.expected_type, NULL
         FROM (SELECT DISTINCT batch_id FROM log) b CROSS JOIN exp e
         WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.batch_id = b.batch_id AND l.column_name = e.column_name))"""


def _diff(t):
    log = SD.infer_schema_log(SD.raw_feed(t.orders))
    return log, SD.schema_diff(log, SD.EXPECTED_FEED_SCHEMA)


@query("schema_log", f"WITH {_log_sql()} SELECT * FROM log", frames=False)
def schema_log(t):
    """The schema log (batch_id, column_name, type) inferred from the incoming feed's values."""
    return SD.infer_schema_log(SD.raw_feed(t.orders))


@query("schema_diff", DIFF_SQL + " SELECT * FROM diff", frames=False)
def schema_diff(t):
    """SD1: new / removed / type-changed columns of every batch vs the expected schema."""
    return _diff(t)[1]


@query("drift_severity", DIFF_SQL + f"""
, r AS (SELECT batch_id, MAX(CASE WHEN change = 'new' THEN 1 WHEN change = 'removed' THEN 3
                                   WHEN {_widen('expected_type', 'actual_type')} THEN 2 ELSE 3 END) AS rank,
               COUNT(*) FILTER (WHERE change = 'new') AS new_columns,
               COUNT(*) FILTER (WHERE change = 'removed') AS removed_columns,
               COUNT(*) FILTER (WHERE change = 'type_changed') AS type_changes
        FROM diff GROUP BY batch_id)
SELECT b.batch_id, (['NONE', 'LOW', 'HIGH', 'BREAKING'])[COALESCE(r.rank, 0) + 1] AS drift_severity,
       COALESCE(r.new_columns, 0) AS new_columns, COALESCE(r.removed_columns, 0) AS removed_columns,
       COALESCE(r.type_changes, 0) AS type_changes, COALESCE(r.rank, 0) > 0 AS has_drift
FROM (SELECT DISTINCT batch_id FROM log) b LEFT JOIN r ON b.batch_id = r.batch_id""", frames=False)
def drift_severity(t):
    """SD2: NONE / LOW / HIGH / BREAKING per batch; the maximum wins."""
    return SD.drift_severity(SD.schema_changes(SD.infer_schema_log(SD.raw_feed(t.orders)), SD.EXPECTED_FEED_SCHEMA))


NUMERIC = "(" + ", ".join(f"'{x}'" for x in SD.NUMERIC_TYPES) + ")"
DECISION_SQL = DIFF_SQL + f"""
, dec AS (SELECT batch_id, column_name, change,
  CASE WHEN change = 'new' AND actual_type IN {NUMERIC} THEN 'FLAG_ANOMALY' WHEN change = 'new' THEN 'ADD_TO_SCHEMA'
       WHEN change = 'removed' THEN 'HALT' WHEN {_widen('expected_type', 'actual_type')} THEN 'ADD_TO_SCHEMA'
       ELSE 'FLAG_ANOMALY' END AS action,
  CASE WHEN change = 'new' AND actual_type IN {NUMERIC} THEN 'new numeric column (' || actual_type || ')'
       WHEN change = 'new' THEN 'new ' || actual_type || ' column' WHEN change = 'removed' THEN 'removed column'
       WHEN {_widen('expected_type', 'actual_type')} THEN 'type widening ' || expected_type || ' -> ' || actual_type
       ELSE 'type narrowing ' || expected_type || ' -> ' || actual_type END AS reason,
  CASE WHEN change = 'new' AND actual_type IN {NUMERIC} THEN 'HIGH' WHEN change = 'new' THEN 'LOW'
       WHEN change = 'removed' THEN 'BREAKING' WHEN {_widen('expected_type', 'actual_type')} THEN 'HIGH'
       ELSE 'BREAKING' END AS risk_level
  FROM diff)"""


@query("drift_decisions", DECISION_SQL + " SELECT * FROM dec", frames=False)
def drift_decisions(t):
    """SD3: ADD_TO_SCHEMA / FLAG_ANOMALY / HALT per batch and column, widening vs narrowing."""
    return SD.drift_decisions(_diff(t)[1])


FEED_OUT = ["batch_id", *SD.FEED_COLUMNS]


@query("apply_evolution", f"""
SELECT {', '.join(FEED_OUT)}, discount_amount IS NULL AS discount_amount_anomaly
FROM {FEED_SQL} f""", frames=False)
def apply_evolution(t):
    """SD4: the feed with the decisions applied — new numeric columns get an
    ``<col>_anomaly`` flag, new string/boolean columns and widened types are
    kept; nothing is dropped silently."""
    return SD.apply_evolution(SD.raw_feed(t.orders), SD.column_actions(SD.drift_decisions(_diff(t)[1]))).select(
        *FEED_OUT, "discount_amount_anomaly")


@query("handle_drift_rows", DECISION_SQL + f"""
SELECT {', '.join('f.' + c for c in FEED_OUT)}, f.discount_amount IS NULL AS discount_amount_anomaly
FROM {FEED_SQL} f WHERE f.batch_id NOT IN (SELECT batch_id FROM dec WHERE action = 'HALT')""", frames=False)
def handle_drift_rows(t):
    """SD5: the evolved rows of the batches that were not held back."""
    return SD.handle_drift(SD.raw_feed(t.orders), SD.EXPECTED_FEED_SCHEMA)[1].select(*FEED_OUT, "discount_amount_anomaly")


@query("handle_drift", DECISION_SQL + f"""
, sev AS (SELECT batch_id, MAX(CASE WHEN action = 'HALT' THEN 1 ELSE 0 END) AS halt,
                 COUNT(*) FILTER (WHERE action = 'FLAG_ANOMALY') AS flagged FROM dec GROUP BY 1),
rows AS (SELECT batch_id, COUNT(*) AS n FROM {FEED_SQL} f GROUP BY 1)
SELECT r.batch_id, r.n AS rows, CASE WHEN COALESCE(s.halt, 0) = 1 THEN 'HALTED' ELSE 'APPLIED' END AS outcome,
       COALESCE(s.flagged, 0) AS flagged_columns
FROM rows r LEFT JOIN sev s ON r.batch_id = s.batch_id""", frames=False)
def handle_drift(t):
    """SD5: detect -> decide -> apply per batch: a batch with a HALT decision
    (a removed column) is held back; others are applied. Report per batch."""
    return SD.handle_drift(SD.raw_feed(t.orders), SD.EXPECTED_FEED_SCHEMA)[0]


VERSION_SQL_LOG = """
WITH s AS (SELECT * FROM silver),
v1 AS (SELECT transaction_id, amount, status, merchant_id, transaction_date FROM s WHERE transaction_date < DATE '1997-01-01'),
v2 AS (SELECT transaction_id, amount, status, merchant_id, transaction_date, customer_id, payment_method FROM s
       WHERE transaction_date >= DATE '1997-01-01' AND transaction_date < DATE '2000-01-01'),
v3 AS (SELECT transaction_id, amount, status, merchant_id, transaction_date, customer_id AS user_id FROM s
       WHERE transaction_date >= DATE '2000-01-01')"""


@query("schema_version_diff", VERSION_SQL_LOG + """,
cols AS (SELECT * FROM (VALUES ('v1', 1, 'transaction_id'), ('v1', 1, 'amount'), ('v1', 1, 'status'),
  ('v1', 1, 'merchant_id'), ('v1', 1, 'transaction_date'),
  ('v2', 2, 'transaction_id'), ('v2', 2, 'amount'), ('v2', 2, 'status'), ('v2', 2, 'merchant_id'),
  ('v2', 2, 'transaction_date'), ('v2', 2, 'customer_id'), ('v2', 2, 'payment_method'),
  ('v3', 3, 'transaction_id'), ('v3', 3, 'amount'), ('v3', 3, 'status'), ('v3', 3, 'merchant_id'),
  ('v3', 3, 'transaction_date'), ('v3', 3, 'user_id')) AS c(version, vn, column_name)),
ch AS (SELECT n.version, n.vn, n.column_name, 'added' AS change FROM cols n
       WHERE n.vn > 1 AND NOT EXISTS (SELECT 1 FROM cols p WHERE p.vn = n.vn - 1 AND p.column_name = n.column_name)
       UNION ALL
       SELECT 'v' || CAST(p.vn + 1 AS VARCHAR), p.vn + 1, p.column_name, 'removed' FROM cols p
       WHERE p.vn < 3 AND NOT EXISTS (SELECT 1 FROM cols n WHERE n.vn = p.vn + 1 AND n.column_name = p.column_name)),
a AS (SELECT DISTINCT customer_id AS v FROM v2), b AS (SELECT DISTINCT user_id AS v FROM v3),
j AS (SELECT (SELECT COUNT(*) FROM a JOIN b ON a.v = b.v) * 1.0 /
             (SELECT COUNT(*) FROM (SELECT v FROM a UNION SELECT v FROM b) u) AS jac)
SELECT ch.version, ch.column_name, ch.change,
       CASE WHEN ch.version = 'v3' AND ch.column_name IN ('customer_id', 'user_id') AND (SELECT jac FROM j) >= 0.5
            THEN 'customer_id -> user_id' END AS proposed_rename
FROM ch""")
def schema_version_diff(t):
    """SD6: consecutive versions diffed (added / removed columns); a removed
    and an added column of the same step whose distinct value sets overlap
    (Jaccard >= 0.5) are proposed as a rename."""
    return SD.version_diff(schema_versions(t, materialize(FR.silver_frame(t), "silver")), 0.5)


@query("silent_break_probe", VERSION_SQL_LOG + """
SELECT 'v1' AS schema_version, COUNT(*) AS rows, 0 AS matching_rows FROM v1
UNION ALL SELECT 'v2', COUNT(*), COUNT(*) FILTER (WHERE payment_method = '1-URGENT') FROM v2
UNION ALL SELECT 'v3', COUNT(*), 0 FROM v3""")
def silent_break_probe(t):
    """SD7: a downstream filter (payment_method = '1-URGENT') per version on the
    unioned versions: v1/v3 return 0 rows although they have data — the silent break."""
    u = U.align_variants(versioned_rows(t), VERSION_TYPES, {"user_id": "customer_id"})
    return u.groupBy("schema_version").agg(F.count(F.lit(1)).alias("rows"),
                                            F.count_if(F.col("payment_method") == "1-URGENT").cast("bigint")
                                             .alias("matching_rows"))


@query("migrate_version", VERSION_SQL_LOG + """
SELECT transaction_id, amount, status, merchant_id, transaction_date, CAST(NULL AS BIGINT) AS user_id, 'v1' AS source_version FROM v1
UNION ALL SELECT transaction_id, amount, status, merchant_id, transaction_date, customer_id, 'v2' FROM v2
UNION ALL SELECT transaction_id, amount, status, merchant_id, transaction_date, user_id, 'v3' FROM v3""")
def migrate_version(t):
    """SD8: v1 -> v2 (add customer_id, payment_method) -> v3 (rename
    customer_id to user_id, drop payment_method); all slices end in v3 shape."""
    v1, v2 = VERSION_FIELDS, [*VERSION_FIELDS, "customer_id", "payment_method"]
    to_v3 = dict(rename={"customer_id": "user_id"}, drop=("payment_method",))
    v3 = [*VERSION_FIELDS, "user_id"]
    sources = {"v1": SD.migration(v1, add=("customer_id", "payment_method"), **to_v3), "v2": SD.migration(v2, **to_v3), "v3": SD.migration(v3)}
    types = {c: VERSION_TYPES.get(c, "bigint") for c in v3}
    return SD.migrate_variants(versioned_rows(t), sources, types)
