"""The streaming attribution: incremental, exactly-once, same rows as the batch job."""

from pyspark.sql import functions as F

from storylens.operators.unwrap import reels_from_raw
from storylens.plans import fixtures as fx
from storylens.plans.attribution import daily_attribution
from storylens.session import scratch_path
from storylens.streaming import start_attribution_stream

OUT = "username string, origin string, date date"


def test_stream_matches_batch_and_is_incremental(spark, sf_dir):
    raw = fx.raw_documents(fx.load(spark, sf_dir, "events"))
    first, second = raw.filter(F.col("seq") % 2 == 0), raw.filter(F.col("seq") % 2 == 1)
    base = scratch_path(spark, "stream-test")
    first.write.mode("overwrite").parquet(f"{base}/raw/part=1")
    start_attribution_stream(spark, f"{base}/raw", f"{base}/out", f"{base}/ck").awaitTermination()
    n1 = spark.read.schema(OUT).parquet(f"{base}/out").count()
    second.write.mode("overwrite").parquet(f"{base}/raw/part=2")
    start_attribution_stream(spark, f"{base}/raw", f"{base}/out", f"{base}/ck").awaitTermination()
    out = spark.read.schema(OUT).parquet(f"{base}/out")
    batch = daily_attribution(reels_from_raw(raw), fx.RUN_DATE)
    assert n1 <= out.count()
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0
    # a rerun with no new files emits nothing
    start_attribution_stream(spark, f"{base}/raw", f"{base}/out", f"{base}/ck").awaitTermination()
    assert spark.read.schema(OUT).parquet(f"{base}/out").count() == out.count()


def test_days_in_any_order_give_the_batch_result(spark, sf_dir):
    raw = fx.raw_documents(fx.load(spark, sf_dir, "events"))
    base = scratch_path(spark, "stream-days")
    days = ["2026-12-05", "2026-12-06", "2026-12-01"]
    for day in days:
        raw.withColumn("run_date", F.lit(day).cast("date")).write.parquet(f"{base}/raw/landed={day}")
        start_attribution_stream(spark, f"{base}/raw", f"{base}/out", f"{base}/ck").awaitTermination()
    out = spark.read.schema(OUT).parquet(f"{base}/out")
    for day in days:
        batch = daily_attribution(reels_from_raw(raw), day)
        own = out.filter(F.col("date") == day)
        assert own.exceptAll(batch).count() == 0 and batch.exceptAll(own).count() == 0


def test_stream_takes_rules(spark, sf_dir):
    raw = fx.raw_documents(fx.load(spark, sf_dir, "events"))
    base = scratch_path(spark, "stream-rules")
    raw.write.parquet(f"{base}/raw")
    rules = [("google.com", "G")]
    start_attribution_stream(spark, f"{base}/raw", f"{base}/out", f"{base}/ck", rules=rules).awaitTermination()
    out, batch = spark.read.schema(OUT).parquet(f"{base}/out"), daily_attribution(reels_from_raw(raw), fx.RUN_DATE, rules)
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0
