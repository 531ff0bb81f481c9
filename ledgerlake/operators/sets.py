"""Set operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_batches(*batches: DataFrame) -> DataFrame:
    """Bag union by column name."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b)
    return out


def distinct_value_diff(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Per column, distinct values only in A and only in B.

    Both frames are unpivoted to (column, value) once and compared in a single
    aggregation — one shuffle for all columns instead of a job per column.
    Values are compared as strings (the type Bronze carries).
    """
    def long(df, side):
        return (df.select(*[F.col(c).cast("string").alias(c) for c in columns])
                  .unpivot([], columns, "column_name", "value")
                  .where(F.col("value").isNotNull())
                  .select("column_name", "value", F.lit(side).alias("side")))

    both = long(a, 1).unionByName(long(b, 2))
    per_value = both.groupBy("column_name", "value").agg(F.bit_or("side").alias("sides"))
    return (per_value.groupBy("column_name")
                     .agg(F.count_if(F.col("sides") == 1).cast("bigint").alias("only_in_a"),
                          F.count_if(F.col("sides") == 2).cast("bigint").alias("only_in_b"),
                          F.count_if(F.col("sides") == 3).cast("bigint").alias("in_both"))
                     .withColumn("drifted", (F.col("only_in_a") + F.col("only_in_b")) > 0))


def common_columns(a: DataFrame, b: DataFrame, exclude=()) -> list[str]:
    """Columns present in both frames (A's order), minus an exclude list."""
    bset = set(b.columns)
    return [c for c in a.columns if c in bset and c not in set(exclude)]


def align_versions(frames: dict[str, DataFrame], renames: dict[str, str] | None = None) -> DataFrame:
    """Union of schema versions; renamed columns mapped back, missing ones null."""
    renames = renames or {}
    out = None
    for version, df in frames.items():
        for old, new in renames.items():
            if old in df.columns:
                df = df.withColumnRenamed(old, new)
        df = df.withColumn("schema_version", F.lit(version))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def with_versions(df: DataFrame, versions: dict[str, tuple[Column, dict[str, str]]]) -> DataFrame:
    """Rows of several schema versions in one frame: (schema_version, fields), ``fields`` a variant with the version's own
    fields. ``versions``: name -> (which rows, field -> column). One pass, however many versions; a row of none is left out."""
    version = payload = None
    for name, (mine, fields) in versions.items():
        own = F.to_variant_object(F.struct(*[F.col(c).alias(f) for f, c in fields.items()]))
        version = F.when(mine, name) if version is None else version.when(mine, name)
        payload = F.when(mine, own) if payload is None else payload.when(mine, own)
    return df.select(version.alias("schema_version"), payload.alias("fields")).where(F.col("schema_version").isNotNull())


def variant_field(name: str, kind: str) -> Column:
    """A field of ``fields``, null in rows whose version does not have it."""
    return F.try_variant_get("fields", f"$.{name}", kind)


def align_variants(rows: DataFrame, columns: dict[str, str], renames: dict[str, str] | None = None) -> DataFrame:
    """U3 over with_versions(): the columns by name and type, renamed fields (old -> new) mapped back, missing ones null."""
    old = {}
    for before, after in (renames or {}).items():
        old.setdefault(after, []).append(before)
    cols = [F.coalesce(*[variant_field(n, kind) for n in (c, *old.get(c, ()))]).alias(c) for c, kind in columns.items()]
    return rows.select(*cols, "schema_version")


def layer_row_delta(bronze: DataFrame, key: str = "transaction_id", amount: str = "amount") -> DataFrame:
    """U4: Bronze -> Silver row accounting as (reason, rows)."""
    k, a = F.col(key), F.col(amount)
    valid = k.isNotNull() & (a >= 0)
    c = bronze.agg(F.count_if(k.isNull()).cast("bigint").alias("null_id"),
                   F.count_if(k.isNotNull() & (a < 0)).cast("bigint").alias("negative_amount"),
                   F.count_if(valid).cast("bigint").alias("valid"),
                   F.count_distinct(F.when(valid, k)).alias("kept"))
    c = c.withColumn("duplicate", F.col("valid") - F.col("kept"))
    return c.unpivot([], ["null_id", "negative_amount", "duplicate", "kept"], "reason", "rows")
