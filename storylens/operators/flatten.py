"""Unnest stories, then link stickers.

``explode`` (never ``explode_outer``): a NULL or empty list yields no row,
while a sticker whose ``story_link`` is NULL still yields one row with a NULL
url. Spark does not allow a generator inside an expression, so each unnest is
its own projection and the url expression is computed after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_items(reels: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """G1: one row per story item: ``username``, ``item`` (+ ``keep`` columns)."""
    return reels.select(*keep, F.col("user.username").alias("username"),
                        F.explode("items").alias("item"))


def explode_stickers(items: DataFrame, link_field: str = "url",
                     out_col: str = "story_link_url", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per link sticker with its ``story_link.<link_field>``."""
    stickers = items.select(*keep, "username",
                            F.explode("item.story_link_stickers").alias("sticker"))
    return stickers.select(*keep, "username",
                           F.col("sticker.story_link").getField(link_field).alias(out_col))


def story_links(reels: DataFrame, link_field: str = "url", out_col: str = "story_link_url",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """G1 then G2: ``username`` and the raw sticker link."""
    return explode_stickers(explode_items(reels, keep), link_field, out_col, keep)


def sticker_values(reels: DataFrame, fn, out_col: str, link_field: str = "url",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per sticker whose ``fn(story_link.<link_field>)`` is not NULL.

    The value is computed once per sticker, in generated code, as the input
    of a one-element ``explode_outer``; the NULL filter sits above that
    generator, so Catalyst cannot push it below and inline (recompute) the
    expression in a filter. Stickers whose value is NULL give no row; use
    ``story_links`` to keep them.
    """
    stickers = explode_items(reels, keep).select(
        *keep, "username", F.explode("item.story_link_stickers").alias("__sticker"))
    value = fn(F.col("__sticker").getField("story_link").getField(link_field))
    out = stickers.select(*keep, "username", F.explode_outer(F.array(value)).alias(out_col))
    return out.filter(F.col(out_col).isNotNull())
