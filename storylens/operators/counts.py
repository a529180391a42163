"""A1-A4: the global counts the pipeline reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_users(df: DataFrame, col: str = "username", approx: bool = False,
                   alias: str = "distinct_users") -> Column:
    """Distinct non-NULL usernames (``approx`` for HyperLogLog++ at scale)."""
    c = F.approx_count_distinct(col) if approx else F.countDistinct(col)
    return c.cast("bigint").alias(alias)


def success_rate(outcomes: DataFrame, status_col: str = "status") -> DataFrame:
    """A3: captured profiles over profiles asked."""
    return outcomes.agg(
        F.count_if(F.col(status_col) == "captured").cast("bigint").alias("n_captured"),
        F.count(F.lit(1)).cast("bigint").alias("n_profiles"))


def documents_per_key(items: DataFrame, key_col: str = "key") -> DataFrame:
    """A4: documents grouped by key (counts; the grouped write itself is K4)."""
    return items.groupBy(key_col).agg(F.count(F.lit(1)).cast("bigint").alias("n_items"))
