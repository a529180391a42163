"""The export, capture and rows jobs end to end."""

import json

import pytest
from pyspark.sql import functions as F

from storylens.operators import capture as cap
from storylens.operators.unwrap import reels_from_raw
from storylens.plans import fixtures as fx
from storylens.plans.attribution import attribution_rows, link_attribution
from storylens.plans.jobs import main, run_capture, run_export, run_rows
from storylens.session import scratch_path
from storylens.sources.readers import read_link_snapshot, read_raw_documents, read_routed


def test_export_run(spark, sf_dir):
    items = fx.export_items(fx.load(spark, sf_dir, "events"))
    base = scratch_path(spark, "export-job")
    items.select(F.to_json(F.struct("requested", "stories"))).union(
        spark.createDataFrame([("{broken",)], "value string")).write.text(f"{base}/files")
    report = run_export(spark, f"{base}/files", f"{base}/out", "2026-12-01", f"{base}/routed", glob="part-*")
    want = link_attribution(items)
    assert report["published"] and report["items"] == items.count() and report["quarantined"] == 1
    back = read_link_snapshot(spark, report["path"])
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
    assert report["distinct_users"] == want.agg(F.count_distinct("username")).first()[0]
    assert read_routed(spark, f"{base}/routed", "requested string, stories string").count() == items.count()


def test_capture_and_rows_run(spark, sf_dir, capsys):
    profiles, log, bodies, errors = fx.capture_inputs(fx.load(spark, sf_dir, "customer"), fx.load(spark, sf_dir, "orders"))
    base = scratch_path(spark, "capture-job")
    profiles.write.parquet(f"{base}/profiles")
    errors.write.parquet(f"{base}/errors")
    log.write.json(f"{base}/log")
    bodies.write.json(f"{base}/bodies")
    report = run_capture(spark, f"{base}/profiles", f"{base}/log", f"{base}/bodies", f"{base}/raw", "2026-12-01", f"{base}/errors")
    once = cap.capture_outcomes(profiles, log, bodies, errors)
    assert report["n_captured"] == once.filter("status = 'captured'").count() and report["n_profiles"] == once.count()
    raw = read_raw_documents(spark, f"{base}/raw", "2026-12-01")
    assert raw.count() == report["n_captured"]
    rows = run_rows(spark, f"{base}/raw", f"{base}/rows", "2026-12-01")
    want = attribution_rows(reels_from_raw(raw), "2026-12-01")
    assert spark.read.option("header", True).csv(rows["folder"]).count() == want.count()
    # the same from the command line, with rules; a refused target ends with an error code
    rules = f"{base}/rules"
    spark.createDataFrame([(1, "google.com", "G")], "position long, host string, origin string").write.option("header", True).csv(rules)
    main(["rows", "--raw", f"{base}/raw", "--out", f"{base}/ruled", "--run-date", "2026-12-01", "--rules", rules])
    path = json.loads(capsys.readouterr().out.splitlines()[-1])["folder"]
    assert {r.origin for r in spark.read.option("header", True).csv(path).select("origin").distinct().collect()} <= {"G", None}
    with pytest.raises(SystemExit):
        main(["rows", "--raw", f"{base}/raw", "--out", "nosuchscheme://b/x", "--run-date", "2026-12-01"])
