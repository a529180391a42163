"""First or last row per key by an explicit order column.

Both are a single hash aggregate with ``min_by``/``max_by``: the partial
aggregate keeps one candidate per key per task before the shuffle, so a key
holding a large share of the rows never lands in one task in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: Column, cols: list[str], fn) -> DataFrame:
    payload = F.struct(*[F.col(c) for c in cols])
    picked = df.groupBy(*keys).agg(fn(payload, order).alias("__pick"))
    return picked.select(*keys, *[F.col("__pick").getField(c).alias(c) for c in cols])


def first_per_key(df: DataFrame, keys: list[str], order: Column | str, cols: list[str]) -> DataFrame:
    o = F.col(order) if isinstance(order, str) else order
    return _pick(df, keys, o, cols, F.min_by)


def last_per_key(df: DataFrame, keys: list[str], order: Column | str, cols: list[str]) -> DataFrame:
    o = F.col(order) if isinstance(order, str) else order
    return _pick(df, keys, o, cols, F.max_by)
