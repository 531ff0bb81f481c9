"""Schema drift and evolution (SD1-SD8) on a *schema log* frame.

The reference diffs two dicts; here every arriving batch (or file) has its
schema in a log ``(batch_id, column_name, type)``, so drift over thousands of
batches is one join. The log itself is inferred from data: for each batch
and column, the narrowest type that parses every non-null value, computed in
one ``groupBy(batch).agg`` pass (partial aggregation, so a huge batch is
combined map-side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Severity ranks, and the widening order of types. A change
# to a later type in TYPE_ORDER (or to string) widens; anything else narrows.
SEVERITY_RANK = {"NONE": 0, "LOW": 1, "HIGH": 2, "BREAKING": 3}
TYPE_ORDER = ["boolean", "int", "bigint", "float", "double", "decimal"]
NUMERIC_TYPES = ("int", "bigint", "float", "double", "decimal")

# The schema the feed was built for (name -> Spark simple type).
EXPECTED_FEED_SCHEMA = {
    "transaction_id": "bigint",
    "amount": "double",
    "status": "string",
    "customer_id": "bigint",
    "transaction_date": "date",
    "payment_method": "string",
}
FEED_COLUMNS = list(EXPECTED_FEED_SCHEMA) + ["payment_gateway", "discount_amount", "refund_flag"]


def raw_feed(orders: DataFrame) -> DataFrame:
    """An all-string daily feed derived from ``orders`` with drift injected by date:

    * batches are order months (``batch_id`` = 'yyyy-MM');
    * from 2000 on, three new columns arrive: payment_gateway (string),
      discount_amount (decimal text) and refund_flag (true/false);
    * during 1998 payment_method stops arriving (removed);
    * in 1999-06..1999-12 amount arrives as text ('USD 123.45': type change).
    """
    d = F.col("o_orderdate").cast("date")
    k = F.col("o_orderkey")
    new_cols = d >= F.lit("2000-01-01").cast("date")
    removed = F.year(d) == 1998
    retyped = (d >= F.lit("1999-06-01").cast("date")) & (d < F.lit("2000-01-01").cast("date"))
    amt = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return orders.select(
        F.date_format(d, "yyyy-MM").alias("batch_id"),
        k.cast("string").alias("transaction_id"),
        F.when(retyped, F.concat(F.lit("USD "), amt)).otherwise(amt).alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        d.cast("string").alias("transaction_date"),
        F.when(~removed, F.col("o_orderpriority")).alias("payment_method"),
        F.when(new_cols, F.concat(F.lit("GW"), (k % 3).cast("string"))).alias("payment_gateway"),
        F.when(new_cols, (F.col("o_totalprice").cast("decimal(18,2)") * F.lit(0.05).cast("decimal(3,2)"))
                          .cast("decimal(18,2)").cast("string")).alias("discount_amount"),
        F.when(new_cols, F.when(k % 7 == 0, "true").otherwise("false")).alias("refund_flag"),
    )


def infer_schema_log(feed: DataFrame, batch_col: str = "batch_id", columns=None) -> DataFrame:
    """Schema log ``(batch_id, column_name, type)`` inferred from string data.

    A column is present in a batch when it carries a non-null value; its type
    is the first of boolean / bigint / double / date whose pattern matches
    every value, else string. One aggregate over the feed, then ``unpivot``.
    """
    columns = columns or [c for c in feed.columns if c != batch_col]
    aggs = []
    for c in columns:
        v = F.col(c)
        nn = v.isNotNull()
        is_bool = F.lower(v).isin("true", "false")
        aggs += [F.count_if(nn).alias(f"{c}__n"),
                 F.count_if(nn & is_bool).alias(f"{c}__bool"),
                 F.count_if(nn & v.rlike(r"^-?[0-9]{1,18}$")).alias(f"{c}__int"),
                 F.count_if(nn & v.rlike(r"^-?[0-9]+(\.[0-9]+)?$")).alias(f"{c}__dec"),
                 F.count_if(nn & F.try_to_date(v).isNotNull() & v.rlike(r"^\d{4}-\d{2}-\d{2}$")).alias(f"{c}__date")]
    wide = feed.groupBy(batch_col).agg(*aggs)
    structs = []
    for c in columns:
        n = F.col(f"{c}__n")
        typ = (F.when(F.col(f"{c}__bool") == n, "boolean")
                .when(F.col(f"{c}__int") == n, "bigint")
                .when(F.col(f"{c}__dec") == n, "double")
                .when(F.col(f"{c}__date") == n, "date")
                .otherwise("string"))
        structs.append(F.struct(F.lit(c).alias("column_name"), n.alias("n"), typ.alias("type")))
    return (wide.select(batch_col, F.inline(F.array(*structs)))
                .where(F.col("n") > 0)
                .select(F.col(batch_col).alias("batch_id"), "column_name", "type"))


def expected_frame(spark, expected: dict, required=None) -> DataFrame:
    """The expected schema as a small literal frame (name, type, required)."""
    required = set(required if required is not None else expected)
    rows = [(k, v, k in required) for k, v in expected.items()]
    return spark.createDataFrame(rows, "column_name string, expected_type string, required boolean")


def schema_changes(log: DataFrame, expected: dict) -> DataFrame:
    """Per batch and column, seen or expected: new / removed / type_changed, or null where both agree.

    One row per batch holds its columns' types, a map as wide as the schema, so present and removed columns
    come from one pass over the log, without a join.
    """
    want = F.create_map(*[F.lit(x) for kv in expected.items() for x in kv])
    seen = log.groupBy("batch_id").agg(F.map_from_entries(F.collect_list(F.struct("column_name", "type"))).alias("seen"))
    names = F.array_union(F.map_keys("seen"), F.array(*[F.lit(c) for c in expected]))
    each = seen.select("batch_id", "seen", F.explode(names).alias("column_name"))
    e, a = F.try_element_at(want, F.col("column_name")), F.try_element_at(F.col("seen"), F.col("column_name"))
    return each.select("batch_id", "column_name",
                       F.when(e.isNull(), "new").when(a.isNull(), "removed").when(e != a, "type_changed").alias("change"),
                       e.alias("expected_type"), a.alias("actual_type"))


def schema_diff(log: DataFrame, expected: dict) -> DataFrame:
    """SD1: per batch, new / removed / type-changed columns."""
    return schema_changes(log, expected).where(F.col("change").isNotNull())


def _rank(t):
    return F.array_position(F.array(*[F.lit(x) for x in TYPE_ORDER]), t)


def is_widening(expected_type, actual_type):
    """Widening: to string, or later in the numeric order."""
    e, a = expected_type, actual_type
    return (a == "string") | ((_rank(e) > 0) & (_rank(a) > _rank(e)))


def drift_decisions(diff: DataFrame) -> DataFrame:
    """SD3: per (batch, column) action, reason and risk:
    new string/bool/date -> ADD_TO_SCHEMA (LOW); new numeric -> FLAG_ANOMALY
    (HIGH); removed -> HALT (BREAKING); widening -> ADD_TO_SCHEMA (HIGH);
    narrowing -> FLAG_ANOMALY (BREAKING)."""
    ch, a, e = F.col("change"), F.col("actual_type"), F.col("expected_type")
    numeric = a.isin(*NUMERIC_TYPES)
    action = (F.when((ch == "new") & numeric, "FLAG_ANOMALY")
               .when(ch == "new", "ADD_TO_SCHEMA")
               .when(ch == "removed", "HALT")
               .when(is_widening(e, a), "ADD_TO_SCHEMA")
               .otherwise("FLAG_ANOMALY"))
    reason = (F.when((ch == "new") & numeric, F.concat(F.lit("new numeric column ("), a, F.lit(")")))
               .when(ch == "new", F.concat(F.lit("new "), a, F.lit(" column")))
               .when(ch == "removed", F.lit("removed column"))
               .when(is_widening(e, a), F.concat(F.lit("type widening "), e, F.lit(" -> "), a))
               .otherwise(F.concat(F.lit("type narrowing "), e, F.lit(" -> "), a)))
    risk = (F.when((ch == "new") & numeric, "HIGH")
             .when(ch == "new", "LOW")
             .when(ch == "removed", "BREAKING")
             .when(is_widening(e, a), "HIGH")
             .otherwise("BREAKING"))
    return diff.select("batch_id", "column_name", "change", action.alias("action"), reason.alias("reason"),
                       risk.alias("risk_level"))


def drift_severity(changes: DataFrame) -> DataFrame:
    """SD2: per batch the maximum severity: NONE < LOW (only new nullable columns) < HIGH (type widening)
    < BREAKING (removed column or narrowing). New columns inferred from data are nullable, hence LOW.
    ``changes``: schema_changes(), which has every batch."""
    sev = (F.when(F.col("change").isNull(), 0)
            .when(F.col("change") == "new", 1)
            .when(F.col("change") == "removed", 3)
            .when(is_widening(F.col("expected_type"), F.col("actual_type")), 2)
            .otherwise(3))
    per = changes.groupBy("batch_id").agg(F.max(sev).alias("rank"), *[
        F.count_if(F.col("change") == kind).cast("bigint").alias(name)
        for kind, name in (("new", "new_columns"), ("removed", "removed_columns"), ("type_changed", "type_changes"))])
    names = F.array(*[F.lit(k) for k, _ in sorted(SEVERITY_RANK.items(), key=lambda kv: kv[1])])
    return per.select("batch_id", F.element_at(names, F.col("rank") + 1).alias("drift_severity"),
                      "new_columns", "removed_columns", "type_changes", (F.col("rank") > 0).alias("has_drift"))


def apply_evolution(df: DataFrame, decisions: dict[str, str]) -> DataFrame:
    """SD4: the decisions as one projection: DROP_SILENTLY columns are left out, each FLAG_ANOMALY column
    gets ``<col>_anomaly`` = value is null, the others stay."""
    kept = [F.col(c) for c in df.columns if decisions.get(c) != "DROP_SILENTLY"]
    flags = [F.isnull(c).alias(f"{c}_anomaly") for c in df.columns if decisions.get(c) == "FLAG_ANOMALY"]
    return df.select(*kept, *flags)


def migrate_version(df: DataFrame, add=(), rename=None, drop=()) -> DataFrame:
    """SD8: ALTER TABLE as DataFrame ops — add (null), rename, drop columns."""
    for c, typ in add:
        df = df.withColumn(c, F.lit(None).cast(typ))
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    return df.drop(*drop) if drop else df


def column_actions(decisions: DataFrame) -> dict[str, str]:
    """The decision per column over all batches, as wide as the schema: FLAG_ANOMALY beats ADD_TO_SCHEMA; HALT
    is a matter of the batch. The evolved schema depends on the data, so it is known before the plan is."""
    rows = (decisions.where(F.col("action") != "HALT").groupBy("column_name")
            .agg(F.max(F.col("action") == "FLAG_ANOMALY").alias("flag")).collect())
    return {r.column_name: "FLAG_ANOMALY" if r.flag else "ADD_TO_SCHEMA" for r in rows}


def handle_drift(feed: DataFrame, expected: dict) -> tuple[DataFrame, DataFrame]:
    """SD5: detect -> decide -> apply. Batches with a HALT decision are held back, the rest evolved.

    Returns the report (per batch: rows, outcome, flagged columns) and the evolved rows of the applied
    batches. The decisions are written once; both come from them.
    """
    from ledgerlake.session import materialize
    dec = materialize(drift_decisions(schema_diff(infer_schema_log(feed), expected)), "drift-decisions")
    sev = dec.groupBy("batch_id").agg(F.max(F.when(F.col("action") == "HALT", 1).otherwise(0)).alias("halt"),
                                      F.count_if(F.col("action") == "FLAG_ANOMALY").cast("bigint").alias("flagged"))
    rows = feed.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
    report = rows.join(sev, "batch_id", "left").select(
        "batch_id", "rows", F.when(F.coalesce("halt", F.lit(0)) == 1, "HALTED").otherwise("APPLIED").alias("outcome"),
        F.coalesce("flagged", F.lit(0).cast("bigint")).alias("flagged_columns"))
    halted = dec.where(F.col("action") == "HALT").select("batch_id").distinct()
    return report, apply_evolution(feed.join(halted, "batch_id", "left_anti"), column_actions(dec))


def migration(columns: list[str], add=(), rename=None, drop=()) -> dict[str, str | None]:
    """SD8 on names only: the columns after an ALTER TABLE -> the field each comes from, None for an added one."""
    rename = rename or {}
    out = {rename.get(c, c): c for c in columns} | {rename.get(c, c): None for c in add}
    return {c: source for c, source in out.items() if c not in drop}


def migrate_variants(rows: DataFrame, sources: dict[str, dict[str, str | None]], types: dict[str, str]) -> DataFrame:
    """SD8 over ``sets.with_versions()``: every version's rows in the final shape, in one pass. ``sources``: version -> migration()."""
    from ledgerlake.operators.sets import variant_field
    out = []
    for c, kind in types.items():
        value = F.lit(None).cast(kind)
        for version, fields in sources.items():
            if fields.get(c):
                value = F.when(F.col("schema_version") == version, variant_field(fields[c], kind)).otherwise(value)
        out.append(value.alias(c))
    return rows.select(*out, F.col("schema_version").alias("source_version"))


#: Entries of a set sketch as a power of two, and how far its estimate of a Jaccard similarity may be off (8 standard errors).
SKETCH, SKETCH_SLACK = 12, 0.1


def version_diff(versions: dict[str, DataFrame], rename_jaccard: float) -> DataFrame:
    """SD6: added / removed columns between consecutive versions, and renames proposed where a removed and an
    added column of one type share most distinct values (Jaccard).

    One pass per version makes a theta sketch of each of its changed columns; the sketches of all (removed, added) pairs are
    compared without the data. Pairs that may reach the threshold are counted exactly, all of them in one more pass.
    """
    names = list(versions)
    spark = next(iter(versions.values())).sparkSession
    rows, pairs = [], []
    for before, after in zip(names, names[1:]):
        prev, cur = dict(versions[before].dtypes), dict(versions[after].dtypes)
        added, removed = [c for c in cur if c not in prev], [c for c in prev if c not in cur]
        rows += [(after, c, "added") for c in added] + [(after, c, "removed") for c in removed]
        pairs += [(before, r, after, a) for r in removed for a in added if prev[r] == cur[a]]
    changes = spark.createDataFrame(rows, "version string, column_name string, change string")
    none = changes.withColumn("proposed_rename", F.lit(None).cast("string"))
    if not pairs:
        return none
    wanted = {v: sorted({r for b, r, _, _ in pairs if b == v} | {a for _, _, x, a in pairs if x == v}) for v in names}
    sketches = {v: versions[v].agg(*[F.theta_sketch_agg(F.col(c).cast("string"), SKETCH).alias(c) for c in cols]).first()
                for v, cols in wanted.items() if cols}
    compared = spark.createDataFrame([(n, sketches[b][r], sketches[v][a]) for n, (b, r, v, a) in enumerate(pairs)], "pair int, one binary, other binary")
    estimate = F.try_divide(F.theta_sketch_estimate(F.theta_intersection("one", "other")), F.theta_sketch_estimate(F.theta_union("one", "other")))
    close = {x["pair"] for x in compared.where(estimate >= rename_jaccard - SKETCH_SLACK).select("pair").collect()}
    if not close:
        return none
    values = None
    for v in names:
        mine = [F.struct(F.lit(n).alias("pair"), F.lit(side).alias("side"), F.col(c).cast("string").alias("v"))
                for n in sorted(close) for side, (name, c) in ((1, pairs[n][:2]), (2, pairs[n][2:])) if name == v]
        if mine:
            part = versions[v].select(F.inline(F.array(*mine))).where("v IS NOT NULL")
            values = part if values is None else values.unionByName(part)
    exact = (values.groupBy("pair", "v").agg(F.bit_or("side").alias("sides")).groupBy("pair")
             .agg((F.count_if(F.col("sides") == 3) / F.count(F.lit(1))).alias("jaccard")).where(F.col("jaccard") >= rename_jaccard))
    named = spark.createDataFrame([(n, v, c, f"{r} -> {a}") for n, (_, r, v, a) in enumerate(pairs) for c in (r, a)],
                                  "pair int, version string, column_name string, proposed_rename string")
    best = exact.join(named, "pair").groupBy("version", "column_name").agg(F.max_by("proposed_rename", "jaccard").alias("proposed_rename"))
    return changes.join(best, ["version", "column_name"], "left")
