"""Q1 / Q2 / Q3: story-link attribution.

Physical shape of Q1 (see ``.explain()``): scan -> explode reels -> explode
items -> explode stickers -> one-element explode of the sticker's label (host
expression + literal-map lookup of the 17 rules) -> NULL filter -> partial
distinct, all in one codegen'd stage; one exchange on (username, origin,
date); final distinct. The label is computed once per sticker as a generator
input, so the not-null filter cannot be pushed below it and recompute it. A rule table given as a DataFrame is
joined instead. The partial distinct collapses a
heavy profile's repeated (origin, date) pairs before anything is shuffled.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylens.functions.strings import display_host, redirect_host
from storylens.operators.flatten import sticker_values, story_links
from storylens.operators.lookup import (
    ORIGIN_RULES_12, ORIGIN_RULES_17, RuleSource, label_hosts, origin_of,
)
from storylens.operators.unwrap import reels_from_raw
from storylens.schemas import EXPORT_STORIES

# Fixed value: the sentence a provider export holds instead of a story list.
NO_STORY_SENTENCE = "No story available"


def run_date_col(run_date: str | _dt.date | None) -> Column:
    """The query date as a DATE literal (``current_date()`` when not given)."""
    if run_date is None:
        return F.current_date()
    return F.lit(str(run_date)).cast("date")


def attribution(reels: DataFrame, run_date: str | _dt.date | None = None,
                rules: RuleSource = ORIGIN_RULES_17, dedup: bool = True,
                drop_unlabelled: bool = True) -> DataFrame:
    """Q1 (defaults) / Q2 (``dedup=False, drop_unlabelled=False``).

    ``reels`` has ``user struct<username>`` and ``items`` (E8). Output is
    ``username, origin, date``.
    """
    if drop_unlabelled and not isinstance(rules, DataFrame):
        # label computed once per sticker inside the generator input; rows
        # without a label never leave the explode
        labelled = sticker_values(reels, lambda u: origin_of(redirect_host(u), rules), "origin")
    elif drop_unlabelled:
        links = sticker_values(reels, redirect_host, "host")
        labelled = label_hosts(links, "host", rules, keep_unmatched=False)
    else:
        links = story_links(reels).select("username", redirect_host("story_link_url").alias("host"))
        labelled = label_hosts(links, "host", rules, keep_unmatched=True)
    out = labelled.select("username", "origin", run_date_col(run_date).alias("date"))
    if drop_unlabelled:
        out = out.filter(F.col("origin").isNotNull())
    return out.distinct() if dedup else out


def daily_attribution(reels: DataFrame, run_date=None, rules: RuleSource = ORIGIN_RULES_17) -> DataFrame:
    """Q1: distinct (username, origin, date) of recognised origins."""
    return attribution(reels, run_date, rules, dedup=True, drop_unlabelled=True)


def attribution_rows(reels: DataFrame, run_date=None, rules: RuleSource = ORIGIN_RULES_17) -> DataFrame:
    """Q2: one row per sticker, unknown origins kept as NULL, no dedup."""
    return attribution(reels, run_date, rules, dedup=False, drop_unlabelled=False)


def daily_attribution_from_raw(raw: DataFrame, run_date=None, doc_col: str = "doc",
                               rules: RuleSource = ORIGIN_RULES_17) -> DataFrame:
    """Q1 straight from raw captured documents (unwrap + attribution in one plan)."""
    return daily_attribution(reels_from_raw(raw, doc_col), run_date, rules)


def has_stories(stories: Column) -> Column:
    """False when the export holds the no-story sentence (NULL stays NULL)."""
    return stories != F.lit(NO_STORY_SENTENCE)


def export_reels(items: DataFrame) -> DataFrame:
    """S3: export items as reels rows; the sentence and non-lists give no stories."""
    # the parse is a generator's input: filters on its result stay above and never parse again
    parsed = items.filter(has_stories(F.col("stories"))).select(
        "requested", F.explode_outer(F.array(F.from_json("stories", EXPORT_STORIES))).alias("items"))
    parsed = parsed.filter(F.col("items").isNotNull())
    return parsed.select(F.struct(F.col("requested").alias("username")).alias("user"), "items")


def link_attribution(items: DataFrame, rules: RuleSource = ORIGIN_RULES_12) -> DataFrame:
    """Q3: ``username, story_link_url, origin`` per sticker of a provider export.

    The host is the first ``/`` segment of the display url, ``www.`` kept.
    """
    links = story_links(export_reels(items), link_field="display_url")
    with_host = links.withColumn("__host", display_host("story_link_url"))
    return label_hosts(with_host, "__host", rules).select("username", "story_link_url", "origin")
