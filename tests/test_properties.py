"""Properties: string functions against a plain model, pipeline invariants."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storylens.functions import display_host, profile_key, redirect_host
from storylens.operators.unwrap import reels_from_raw
from storylens.plans import fixtures as fx
from storylens.plans.attribution import daily_attribution

TOKENS = ["u=", "%2F", "%2f", "www.", "a", "b.c", "/", "&e=1", "é", "", "U="]


def _piece(s, sep, n):
    """1-based piece of a literal split, None when out of range (the SQL semantics)."""
    if s is None:
        return None
    parts = s.split(sep)
    return parts[n - 1] if len(parts) >= n else None


def model_redirect_host(url):
    h = _piece(_piece(url, "u=", 2), "%2F", 3)
    return None if h is None else h.replace("www.", "")


def model_profile_key(link):
    return _piece(link, "/", 4)


strings = st.lists(st.lists(st.sampled_from(TOKENS), max_size=12).map("".join), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None)
@given(strings)
def test_string_functions_match_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v string")
    rows = df.select("v", redirect_host("v").alias("h"), profile_key("v").alias("k"),
                     display_host("v").alias("d")).collect()
    for r in rows:
        assert r.h == model_redirect_host(r.v), r.v
        assert r.k == model_profile_key(r.v), r.v
        assert r.d == _piece(r.v, "/", 1), r.v


def test_inert_documents_change_nothing(spark, sf_dir):
    raw = fx.raw_documents(fx.load(spark, sf_dir, "events"))
    base = daily_attribution(reels_from_raw(raw), fx.RUN_DATE)
    inert = spark.createDataFrame(
        [(None, "u0", 1, json.dumps({"require": [[1]]})), (None, "u0", 2, "[]"), (None, "u0", 3, "{oops")],
        "run_date date, username string, seq long, doc string")
    more = daily_attribution(reels_from_raw(raw.unionByName(inert)), fx.RUN_DATE)
    assert base.exceptAll(more).count() == 0 and more.exceptAll(base).count() == 0


def test_distinct_is_idempotent_and_duplicates_do_not_matter(spark, sf_dir):
    raw = fx.raw_documents(fx.load(spark, sf_dir, "events"))
    once = daily_attribution(reels_from_raw(raw), fx.RUN_DATE)
    twice = daily_attribution(reels_from_raw(raw.unionByName(raw)), fx.RUN_DATE)
    assert once.count() == once.distinct().count()
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert once.filter(F.col("origin").isNull()).count() == 0


def test_approx_distinct_users_is_close(spark, sf_dir):
    from storylens.operators.counts import distinct_users
    ev = fx.load(spark, "/root/testdata/sf0.01", "events") \
        .select(F.concat(F.lit("u"), (F.col("event_id") % 5000).cast("string")).alias("username"))
    exact = ev.agg(distinct_users("username")).first()[0]
    approx = ev.agg(distinct_users("username", approx=True)).first()[0]
    assert exact == 5000 and abs(approx - exact) / exact < 0.1
