"""Sort / limit operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, keys: list[str], descending: list[bool], n: int = 20) -> DataFrame:
    """T4: the first ``n`` rows under a total order (TakeOrderedAndProject:
    each task keeps its top n, the driver merges n × tasks rows)."""
    order = [F.col(k).desc() if d else F.col(k).asc() for k, d in zip(keys, descending)]
    return df.orderBy(*order).limit(n)
