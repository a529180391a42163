"""The daily job end to end on scratch folders."""

import os

from storylens.operators.unwrap import reels_from_raw
from storylens.plans import fixtures as fx
from storylens.plans.attribution import daily_attribution
from storylens.plans.daily_job import run_daily
from storylens.session import local_path, scratch_path
from storylens.sources.readers import read_snapshot


def test_run_daily(spark, sf_dir):
    base = scratch_path(spark, "daily")
    raw = fx.raw_documents(fx.load(spark, sf_dir, "events"))
    raw.write.partitionBy("run_date").parquet(f"{base}/raw")
    a, b = f"{base}/roster_a", f"{base}/roster_b"
    fx.roster_a(fx.load(spark, sf_dir, "customer")).write.option("header", True).csv(a)
    fx.roster_b(fx.load(spark, sf_dir, "supplier")).write.option("header", True).csv(b)
    rep = run_daily(spark, f"{base}/raw", f"{base}/out", fx.RUN_DATE, curated_path=f"{base}/reels",
                    roster_a=a, roster_b=b, single_file=True)
    expected = daily_attribution(reels_from_raw(raw), fx.RUN_DATE)
    got = read_snapshot(spark, rep["path"])
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    assert rep["distinct_users"] == expected.filter("username is not null").select("username").distinct().count()
    assert rep["profiles"] > 0 and rep["roster_quarantine"] == 0
    assert local_path(rep["path"]).endswith("run_date=20261201")
    # a day without documents publishes a header-only snapshot
    rep2 = run_daily(spark, f"{base}/raw", f"{base}/out", "2026-12-02")
    assert rep2["published"] and rep2["distinct_users"] == 0


def test_capture_to_attribution_chain(spark, sf_dir):
    """Q5 -> K3 -> unwrap -> Q1: captured documents feed the attribution unchanged."""
    from pyspark.sql import functions as F

    from storylens.operators import capture as cap
    from storylens.sinks.writers import write_latest_documents
    from storylens.sources.readers import read_raw_documents

    profiles, log, bodies, errors = fx.capture_inputs(fx.load(spark, sf_dir, "customer"),
                                                      fx.load(spark, sf_dir, "orders"))
    outcomes = cap.capture_outcomes(profiles, log, bodies, errors)
    path = scratch_path(spark, "chain")
    write_latest_documents(outcomes, path, fx.RUN_DATE)
    raw = read_raw_documents(spark, path, fx.RUN_DATE)
    reels = reels_from_raw(raw, keep=("username",)).withColumnRenamed("username", "profile")
    # every captured profile's document holds one reel of that same profile
    same = reels.select(F.col("profile"), F.col("user.username").alias("u"))
    assert same.filter("profile != u").count() == 0
    assert same.count() == outcomes.filter("status = 'captured'").count()
    q1 = daily_attribution(reels.select("user", "items"), fx.RUN_DATE)
    assert q1.count() > 0 and q1.filter("origin is null").count() == 0


def test_daily_job_cli(spark, sf_dir, capsys):
    import json

    from storylens.plans.daily_job import main
    base = scratch_path(spark, "daily-cli")
    fx.raw_documents(fx.load(spark, sf_dir, "events")).write.partitionBy("run_date").parquet(f"{base}/raw")
    main(["--raw", f"{base}/raw", "--out", f"{base}/out", "--run-date", fx.RUN_DATE, "--single-file"])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["published"] and report["distinct_users"] > 0
    assert len([p for p in os.listdir(local_path(report["folder"])) if p.endswith(".csv")]) == 1


def test_duplicate_profiles_change_counts_not_documents(spark, sf_dir):
    from storylens.operators import capture as cap
    from storylens.operators.counts import success_rate

    profiles, log, bodies, errors = fx.capture_inputs(fx.load(spark, sf_dir, "customer"),
                                                      fx.load(spark, sf_dir, "orders"))
    once = cap.capture_outcomes(profiles, log, bodies, errors)
    twice = cap.capture_outcomes(profiles.unionByName(profiles), log, bodies, errors)
    a, b = success_rate(once).first(), success_rate(twice).first()
    assert (b.n_captured, b.n_profiles) == (2 * a.n_captured, 2 * a.n_profiles)
    docs_once = cap.latest_success(once).select("username", "seq", "doc")
    docs_twice = cap.latest_success(twice).select("username", "seq", "doc")
    assert docs_once.exceptAll(docs_twice).count() == 0 and docs_twice.exceptAll(docs_once).count() == 0
