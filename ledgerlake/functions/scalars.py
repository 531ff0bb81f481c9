"""Column-level helpers (F1-F17): all built-in Spark expressions, so they
stay inside whole-stage codegen; no Python UDF anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct(num, den, digits: int = 2) -> Column:
    """``round(100 * num / den, digits)`` as double; null when den is 0.

    Computed in decimal, so the rounding is exact half-up.
    """
    q = F.try_divide(F.lit(100).cast("decimal(3,0)") * col(num).cast("decimal(20,0)"),
                     col(den).cast("decimal(20,0)"))
    return F.round(q, digits).cast("double")


def ratio(num, den) -> Column:
    """plain safe ratio, null when the denominator is 0."""
    return F.try_divide(col(num), col(den))


def round2(c, digits: int = 2) -> Column:
    """half-up rounding to ``digits``, returned as double."""
    return F.round(col(c), digits).cast("double")


def money_sum(c) -> Column:
    """Exact decimal sum, published as double."""
    return F.sum(col(c).cast(MONEY)).cast("double")


def sum_when(cond: Column, value) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)``."""
    return F.sum(F.when(cond, col(value)).otherwise(F.lit(0)))


def count_when(cond: Column) -> Column:
    """Conditional count as bigint (A4)."""
    return F.count_if(cond).cast("bigint")


def completed_revenue(amount="amount", status="status") -> Column:
    """A3: revenue = sum of amount over COMPLETED rows, exact, as double."""
    return F.coalesce(F.sum(F.when(F.col(status) == "COMPLETED", col(amount).cast(MONEY))),
                      F.lit(0).cast(MONEY)).cast("double")


def failure_pct(status="status") -> Column:
    """Failure rate = FAILED / all rows × 100, 2 dp."""
    return pct(F.count_if(F.col(status) == "FAILED"), F.count(F.lit(1)))


def safe_cast(c, to: str) -> Column:
    """``try_cast`` — dirty strings become null instead of raising."""
    return col(c).try_cast(to)


def parse_date(c, fmt: str | None = None) -> Column:
    """ISO (or ``fmt``) date parse, null on failure."""
    return F.try_to_date(col(c), F.lit(fmt)) if fmt else F.try_to_date(col(c))


def surrogate_key(*cols) -> Column:
    """Deterministic null-safe hash key of the business key columns."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("_null_")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def mask_id(c) -> Column:
    """SHA-256 of an id's text."""
    return F.sha2(col(c).cast("string"), 256)


def last_path_part(c) -> Column:
    """the file name of a path."""
    return F.element_at(F.split(col(c), "/"), -1)


def starts_with_literal(c, prefix: str) -> Column:
    """Literal prefix test (no LIKE wildcards, see X13)."""
    return F.startswith(col(c), F.lit(prefix))


def lookup(mapping: dict, c) -> Column:
    """small literal map lookup, null on miss."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*kv), col(c)) if kv else F.lit(None)
