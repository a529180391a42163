"""One user holding a third of all events: results stay whole and exact."""

import duckdb
import pytest
from pyspark.sql import functions as F

from storylens.operators import capture as cap
from storylens.operators.picks import last_per_key
from storylens.operators.unwrap import reels_from_raw, unwrap
from storylens.plans import fixtures as fx
from storylens.plans.attribution import attribution_rows, daily_attribution
from storylens.plans.oracle import ORACLE

HOT = "CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END"


@pytest.fixture(scope="module")
def skewed(spark):
    ev = fx.load(spark, "/root/testdata/sf0.01", "events")
    return ev.withColumn("user_id", F.expr(HOT))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("CREATE VIEW raw_events AS SELECT * FROM read_parquet('/root/testdata/sf0.01/events.parquet')")
    c.execute(f"CREATE VIEW events AS SELECT * REPLACE ({HOT} AS user_id) FROM raw_events")
    return c


def _same(df, con, sql):
    cols = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = sorted(tuple(str(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert got == want


def test_skewed_attribution(spark, skewed, con):
    reels = reels_from_raw(fx.raw_documents(skewed))
    _same(daily_attribution(reels, fx.RUN_DATE), con, ORACLE["daily_attribution"])
    _same(attribution_rows(reels, fx.RUN_DATE), con, ORACLE["attribution_rows"])


def test_skewed_unwrap_counts(spark, skewed, con):
    u = unwrap(fx.strict_documents(fx.raw_documents(skewed)))
    _same(u.select("username", "seq", F.col("unwrap_status").alias("reason")), con, ORACLE["path_failures"])


def test_skewed_first_and_last_picks(spark, skewed, con):
    _same(cap.first_matches(fx.capture_log_from_events(skewed)).select("username", "seq", "request_id"),
          con, ORACLE["log_first_match"])
    ev = skewed.filter(F.col("event_type") != "error").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("username"),
        "ts", F.col("event_id").alias("seq"), F.col("props").alias("payload"))
    _same(last_per_key(ev, ["username"], F.struct("ts", "seq"), ["seq", "payload"]),
          con, ORACLE["latest_payload"])


def test_skewed_export_keys(spark, skewed, con):
    items = fx.export_items(skewed)
    keyed = items.select(F.coalesce("requested", F.lit("no_user")).alias("key"))
    _same(keyed.groupBy("key").agg(F.count("*").cast("bigint").alias("n_items")), con, ORACLE["default_key"])
