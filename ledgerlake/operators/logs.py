"""Log, trace and completeness tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The expected items per group and the master tier.
# Items are roles a conversation must contain (>= n turns of that role).
EXPECTED_ITEMS = {
    "opening": {"user": 1, "assistant": 1},
    "dialogue": {"user": 2, "assistant": 2, "system": 1},
}
MASTER_TIER = {"dialogue": {"core": ["user", "assistant"], "extra": ["system"]}}
STATUS_RANK = {"master": 0, "complete": 1, "partial": 2, "missing": 3}


def expected_item_status(turns: DataFrame, entity: str = "conv_id", item_col: str = "role") -> DataFrame:
    """Entity × expected-item matrix -> missing / partial / complete /
    master per group. The matrix is conditional counts in one aggregate per
    entity (the expected list is fixed and small) — no cross join."""
    item = F.lower(F.col(item_col))
    counts = turns.groupBy(entity).agg(*[F.count_if(item == r).alias(f"n_{r}")
                                         for r in sorted({r for g in EXPECTED_ITEMS.values() for r in g})])
    cols = [F.col(entity).cast("string").alias("entity")]
    for g, items in EXPECTED_ITEMS.items():
        found = {r: F.col(f"n_{r}") >= n for r, n in items.items()}
        anyf = F.lit(False)
        allf = F.lit(True)
        for v in found.values():
            anyf, allf = anyf | v, allf & v
        if g in MASTER_TIER:
            core = F.lit(True)
            for r in MASTER_TIER[g]["core"]:
                core = core & found[r]
            extra = F.lit(True)
            for r in MASTER_TIER[g]["extra"]:
                extra = extra & found[r]
            st = F.when(~anyf, "missing").when(core & extra, "master").when(core, "complete").otherwise("partial")
        else:
            st = F.when(~anyf, "missing").when(allf, "complete").otherwise("partial")
        cols.append(st.alias(f"{g}_status"))
    return counts.select(*cols)


def status_totals(status: DataFrame, groups: list[str]) -> DataFrame:
    """Entities per status per group (unpivot + pivot on a fixed status
    list), with the total and the submitted (not missing) entities."""
    long = status.unpivot(["entity"], [f"{g}_status" for g in groups], "group", "status")
    out = (long.groupBy(F.regexp_replace("group", "_status$", "").alias("group"))
               .pivot("status", list(STATUS_RANK)).agg(F.count(F.lit(1)))
               .na.fill(0, list(STATUS_RANK)))
    total = sum(F.col(s) for s in STATUS_RANK)
    return out.withColumn("total", total).withColumn("submitted", total - F.col("missing"))


def status_rank_sort(status: DataFrame, groups: list[str]) -> DataFrame:
    """T5: worst status rank, then most complete groups first, then lower(name)."""
    rank_map = F.create_map(*[x for k, v in STATUS_RANK.items() for x in (F.lit(k), F.lit(v))])
    worst = F.greatest(*[F.coalesce(F.try_element_at(rank_map, F.col(f"{g}_status")), F.lit(2)) for g in groups])
    completes = sum(F.when(F.col(f"{g}_status") == "complete", 1).otherwise(0) for g in groups)
    return (status.withColumn("worst_rank", worst).withColumn("complete_groups", completes)
                  .orderBy("worst_rank", F.col("complete_groups").desc(), F.lower("entity")))


def case_insensitive_lookup(names: DataFrame, known: DataFrame, name_col: str, known_col: str) -> DataFrame:
    """Canonical name via a join on the lower-cased key; unknown names fall back to themselves."""
    k = known.select(F.lower(F.col(known_col)).alias("_lk"), F.col(known_col).alias("_canon"))
    j = names.join(k, F.lower(F.col(name_col)) == k._lk, "left")
    return j.select(F.col(name_col).alias("input_name"), F.coalesce("_canon", F.col(name_col)).alias("canonical_name"),
                    F.col("_canon").isNotNull().alias("known"))


AUDIT_SCHEMA = "source string, entry_id bigint, sql string, status string, reason string"
REVIEW_SCHEMA = ("entry_id bigint, issues array<struct<severity:string, category:string, title:string>>")


def audit_log(guarded: DataFrame) -> DataFrame:
    """Audit records as JSON text, the way the log is persisted."""
    rec = F.struct("source", "entry_id", "sql", F.when(F.col("is_valid"), "executed").otherwise("rejected")
                   .alias("status"), "reason")
    return guarded.select(F.to_json(rec).alias("record"))


def audit_summary(log: DataFrame) -> DataFrame:
    """Parse the JSON audit log and count entries by status and reason."""
    r = log.select(F.from_json("record", AUDIT_SCHEMA).alias("r")).select("r.*")
    return r.groupBy("status", "reason").agg(F.count(F.lit(1)).alias("entries"),
                                              F.count_distinct("source").alias("sources"))


def review_issues(sqls: DataFrame) -> DataFrame:
    """Nested review records derived from SQL texts by lint rules (as JSON)."""
    s = F.upper(F.col("sql"))

    def issue(cond, sev, cat, title):
        return F.when(cond, F.struct(F.lit(sev).alias("severity"), F.lit(cat).alias("category"),
                                     F.lit(title).alias("title")))
    issues = F.array_compact(F.array(
        issue(s.contains("SELECT *"), "LOW", "performance", "SELECT * reads every column"),
        issue(s.rlike(r"(^|[^A-Z0-9_])(DROP|DELETE|TRUNCATE)([^A-Z0-9_]|$)"), "CRITICAL", "security",
              "destructive statement"),
        issue(~s.contains("WHERE"), "MEDIUM", "performance", "no filter"),
        issue(s.contains("COUNT(*)") & ~s.contains("GROUP BY"), "LOW", "readability", "unnamed aggregate")))
    rec = F.struct("entry_id", issues.alias("issues"))
    return sqls.where(F.col("sql").isNotNull()).select(F.to_json(rec).alias("review"))


def issue_counts(reviews: DataFrame) -> DataFrame:
    """Issues per severity and category from nested review JSON."""
    r = reviews.select(F.from_json("review", REVIEW_SCHEMA).alias("r"))
    return (r.select(F.explode("r.issues").alias("i")).groupBy("i.severity", "i.category")
             .agg(F.count(F.lit(1)).alias("issues")))


def span_counts(turns: DataFrame) -> DataFrame:
    """Spans per kind (role), with size totals (characters and words)."""
    words = F.size(F.split(F.trim(F.col("text")), r"\s+"))
    return turns.groupBy(F.col("role").alias("kind")).agg(
        F.count(F.lit(1)).alias("spans"), F.sum(F.length("text")).alias("total_chars"),
        F.sum(F.when(F.length(F.trim(F.col("text"))) > 0, words).otherwise(0)).alias("total_words"))


def latency_comparison(events: DataFrame, a: str, b: str) -> DataFrame:
    """Two systems' timed answers joined by question: per user, the mean
    value of event type ``a`` vs ``b`` (both aggregated before the join)."""
    sa = events.where(F.col("event_type") == a).groupBy("user_id").agg(F.count(F.lit(1)).alias("a_n"),
                                                                       F.avg("value").alias("a_avg"))
    sb = events.where(F.col("event_type") == b).groupBy(F.col("user_id").alias("u")).agg(
        F.count(F.lit(1)).alias("b_n"), F.avg("value").alias("b_avg"))
    j = sa.join(sb, sa.user_id == sb.u, "full_outer")
    from ledgerlake.functions.scalars import round2
    return j.select(F.coalesce("user_id", "u").alias("user_id"), F.coalesce("a_n", F.lit(0)).alias("a_n"),
                    round2("a_avg", 4).alias("a_avg"), F.coalesce("b_n", F.lit(0)).alias("b_n"),
                    round2("b_avg", 4).alias("b_avg"),
                    F.when(F.col("a_avg") < F.col("b_avg"), a).when(F.col("b_avg") < F.col("a_avg"), b)
                     .otherwise("tie").alias("faster"))
