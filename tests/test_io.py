"""Sources and sinks on scratch folders: CSV bytes, empty reruns, JSON files, routing."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from storylens.plans.attribution import daily_attribution
from storylens.schemas import SNAPSHOT
from storylens.session import local_path, scratch_path
from storylens.sinks.folders import folders
from storylens.sinks.writers import (
    append_per_key, publish_snapshot, read_per_key, route_by_story, snapshot_path, write_latest_documents, write_reels_table,
    write_snapshot,
)
from storylens.sources.readers import (
    read_export_items, read_raw_documents, read_reels_files, read_reels_table, read_routed, read_snapshot, tagged_reels_files,
)


def _csv_lines(path):
    parts = sorted(glob.glob(os.path.join(local_path(path), "part-*.csv")))
    assert parts or os.path.isdir(local_path(path))
    lines = []
    for p in parts:
        with open(p, encoding="utf-8") as f:
            lines.extend(f.read().splitlines())
    return lines


def test_snapshot_csv_bytes_and_empty_rerun(spark):
    df = spark.createDataFrame([
        (None, "x", "2026-12-01"), ("", "x", "2026-12-01"), ("a,b", "x", "2026-12-01"),
        ('a,"b"', "Época", "2026-12-01"),
    ], "username string, origin string, d string").select(
        "username", "origin", F.col("d").cast("date").alias("date"))
    base = scratch_path(spark, "k1")
    path = write_snapshot(df, base, "2026-12-01", single_file=True)
    assert path.endswith("run_date=20261201")
    lines = _csv_lines(folders(spark, path)[0])
    assert lines[0] == "username,origin,date"
    assert sorted(lines[1:]) == sorted([",x,2026-12-01", ",x,2026-12-01", '"a,b",x,2026-12-01',
                                        '"a,""b""",Época,2026-12-01'])
    back = read_snapshot(spark, path)
    assert back.count() == 4 and back.schema == SNAPSHOT
    # an empty rerun of the same date replaces the rows by a header-only file
    write_snapshot(df.limit(0), base, "2026-12-01", single_file=True)
    assert [ln for ln in _csv_lines(folders(spark, path)[0]) if ln] in ([], ["username,origin,date"])
    assert read_snapshot(spark, path).count() == 0


def _failing(spark):
    return spark.range(3).select(F.raise_error(F.lit("query fails")).cast("string").alias("username"),
                                 F.lit("x").alias("origin"), F.lit("2026-12-01").cast("date").alias("date"))


def test_publish_tells_storage_errors_and_raises_query_errors(spark):
    df = spark.createDataFrame([("a", "Amazon")], "username string, origin string")
    uri = scratch_path(spark, "k2")
    outcome = publish_snapshot(df, uri, "2026-12-01")
    assert outcome and outcome.error is None and outcome.path == snapshot_path(uri, "2026-12-01")
    refused = publish_snapshot(df, "nosuchscheme://bucket/x", "2026-12-01")
    assert not refused and "nosuchscheme" in refused.error
    with pytest.raises(Exception, match="query fails"):
        publish_snapshot(_failing(spark), uri, "2026-12-01")
    assert spark.read.option("header", True).csv(outcome.folder).count() == 1


def test_failed_write_leaves_the_earlier_snapshot(spark):
    base = scratch_path(spark, "k1-safe")
    df = spark.createDataFrame([("a", "Amazon")], "username string, origin string").withColumn(
        "date", F.lit("2026-12-01").cast("date"))
    path = write_snapshot(df, base, "2026-12-01")
    with pytest.raises(Exception, match="query fails"):
        write_snapshot(_failing(spark), base, "2026-12-01")
    assert read_snapshot(spark, path).count() == 1
    assert os.listdir(local_path(base)) == ["run_date=20261201"]
    assert len(os.listdir(local_path(path))) == 2  # the version and the manifests


def test_latest_documents_add_up_over_a_day(spark):
    path = scratch_path(spark, "k3")
    schema = "username string, status string, seq bigint, doc string"
    write_latest_documents(spark.createDataFrame(
        [("a", "captured", 1, "a1"), ("b", "captured", 2, "b1"), ("c", "captured", 9, "c1")], schema), path, "2026-12-01")
    write_latest_documents(spark.createDataFrame(
        [("a", "captured", 3, "a2"), ("b", "body_error", None, None), ("c", "captured", 4, "c2")], schema), path, "2026-12-01")
    got = {(r.username, r.seq, r.doc) for r in read_raw_documents(spark, path, "2026-12-01").collect()}
    assert got == {("a", 3, "a2"), ("b", 2, "b1"), ("c", 9, "c1")}


def test_values_one_after_another(spark):
    one, two = ({"user": {"username": u}, "items": []} for u in ("a}{", 'b"]['))
    texts = {"concat.json": json.dumps(one) + json.dumps(two), "lines.json": json.dumps(one, indent=2) + "\n" + json.dumps([two, one]),
             "junk.json": json.dumps(one) + " oops", "cut.json": json.dumps(one) + json.dumps(two)[:20],
             "keys.json": '{"user": {"username": "k"}, "items": [], "k": 1, "k": 2}', "nan.json": '{"user": {"username": "n"}, "k": NaN}',
             "mixed.json": json.dumps(one) + " 5", "closed.json": json.dumps(one) + "] x"}
    d = local_path(scratch_path(spark, "s1-values"))
    os.makedirs(d)
    for name, text in texts.items():
        with open(f"{d}/{name}", "w") as f:
            f.write(text)
    good, bad = read_reels_files(spark, d, multi_line=True)
    got = sorted((os.path.basename(r.source_file), r.user.username) for r in good.collect())
    assert got == sorted([("concat.json", "a}{"), ("concat.json", 'b"]['), ("lines.json", "a}{"), ("lines.json", 'b"]['),
                          ("lines.json", "a}{"), ("keys.json", "k"), ("nan.json", "n")])
    reasons = {os.path.basename(r.source_file): (r.reason, r.record) for r in bad.collect()}
    assert reasons == {n: ("wrong_shape" if n == "mixed.json" else "not_json", texts[n])
                       for n in ("junk.json", "cut.json", "mixed.json", "closed.json")}


def test_multiline_array_files_and_truncated_file(spark):
    d = local_path(scratch_path(spark, "s1"))
    os.makedirs(d)
    reels = [{"user": {"username": "a"}, "items": [{"story_link_stickers": [{"story_link": {"url": "u1"}}]}]},
             {"user": {"username": "b"}, "items": []}]
    with open(f"{d}/a_stories.json", "w") as f:
        json.dump(reels, f, indent=4)
    with open(f"{d}/empty.json", "w") as f:
        f.write("[]")
    with open(f"{d}/broken.json", "w") as f:
        f.write(json.dumps(reels, indent=2)[:40])
    with open(f"{d}/notes.txt", "w") as f:
        f.write("not a document")
    good, bad = read_reels_files(spark, d, multi_line=True)
    assert sorted(r.user.username for r in good.collect()) == ["a", "b"]
    assert [os.path.basename(r.source_file) for r in bad.collect()] == ["broken.json"]
    q1 = daily_attribution(good.select("user", "items"), "2026-12-01")
    assert q1.count() == 0  # u1 has no redirect host


def test_export_items_read_keeps_mixed_stories_as_text(spark):
    d = local_path(scratch_path(spark, "s3"))
    os.makedirs(d)
    with open(f"{d}/output_a.json", "w") as f:
        f.write(json.dumps({"requested": "a", "stories": "No story available"}) + "\n")
        f.write(json.dumps({"requested": "b", "stories": [{"story_link_stickers": []}]}) + "\n")
        f.write("{not json\n")
        f.write(json.dumps([{"requested": "c", "stories": "x"}, {"requested": "d"}]) + "\n")
        f.write('{"requested": "e"}{"requested": "e", "stories": "}{"}' + "\n")
        f.write('{"requested": "f"} oops' + "\n")
    good, bad = read_export_items(spark, d)
    items = good.collect()
    assert sorted(r.requested for r in items) == ["a", "b", "c", "d", "e", "e"]
    by_key = {r.requested: r.stories for r in items}
    assert by_key["a"] == "No story available" and by_key["d"] is None
    assert json.loads(by_key["b"]) == [{"story_link_stickers": []}]
    assert sorted((r.record, r.reason) for r in bad.collect()) == [
        ('{"requested": "f"} oops', "not_json"), ("{not json", "not_json")]


def test_keys_of_any_text_in_a_bounded_number_of_folders(spark):
    p = scratch_path(spark, "k4-keys")
    keys = ["", None, "a", "__empty__", "a/b", "a=b", "..", "é\n", "__HIVE_DEFAULT_PARTITION__", "%2F"] + [f"user{i}" for i in range(300)]
    items = spark.createDataFrame([(k, "[]") for k in keys], "requested string, stories string")
    append_per_key(items, p, buckets=8)
    append_per_key(items.limit(10), p, buckets=3)
    schema = "requested string, stories string"
    got = [(r.requested, r.key) for r in read_per_key(spark, p, schema).collect()]
    want = [(k, "no_user" if k is None else k) for k in keys]
    assert sorted(got, key=str) == sorted(want + want[:10], key=str)
    assert len([f for f in os.listdir(local_path(p)) if f.startswith("bucket=")]) <= 8 + 3
    for k in ("", "__empty__", "a/b", "no_user", "user7", "nobody"):
        one = read_per_key(spark, p, schema, k)
        assert [r.key for r in one.collect()] == [k] * sum((w == k) for _, w in want + want[:10])
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "bucket" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0] and "pmod" not in plan.split("FileScan")[0]


def test_good_records_never_meet_python(spark):
    d = local_path(scratch_path(spark, "s1-plan"))
    os.makedirs(d)
    with open(f"{d}/a.json", "w") as f:
        f.write('[{"user": {"username": "a"}, "items": []}]\n{"user": {"username": "b"}, "items": []} oops\n')
    tagged = tagged_reels_files(spark, d, store=f"{d}-store")
    good = tagged.where("reason is null")
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "kind#" in plan
    first, rest = plan.split("ArrowEvalPython")[0], plan.split("ArrowEvalPython")[1]
    assert "kind=whole" not in rest and first.count("Scan") == 1  # the whole records' branch stands before it
    whole = spark.read.parquet(f"{d}-store").where("kind = 'whole'")
    assert whole.count() == 1 and [r.record for r in tagged.where("reason is not null").collect()] == [
        '{"user": {"username": "b"}, "items": []} oops']


def test_append_per_key_and_route(spark):
    items = spark.createDataFrame([("a", "No story available"), (None, "[]"), ("a", "[]")],
                                  "requested string, stories string")
    p = scratch_path(spark, "k4")
    append_per_key(items, p)
    append_per_key(items, p)
    back = spark.read.json(p)
    assert sorted((r.key, r.n) for r in back.groupBy("key").agg(F.count("*").alias("n")).collect()) == [
        ("a", 4), ("no_user", 2)]
    r = scratch_path(spark, "k5")
    route_by_story(items, r)
    routed = read_routed(spark, r, "requested string, stories string")
    assert sorted((x.route, x.n) for x in routed.groupBy("route").agg(F.count("*").alias("n")).collect()) == [
        ("no_stories", 1), ("stories", 2)]


def test_reels_table_is_new_and_rerunnable(spark):
    from storylens.plans import fixtures as fx
    raw = fx.raw_documents(fx.load(spark, "/root/testdata/sf0.001", "events"))
    p = scratch_path(spark, "k6")
    write_reels_table(raw, p)
    write_reels_table(raw, p)  # idempotent: a rerun rewrites the same table
    t = read_reels_table(spark, p)
    assert t.filter("unwrap_status = 'ok'").count() + t.filter("unwrap_status != 'ok'").count() == raw.count()
    assert t.filter("unwrap_status != 'ok'").filter("raw_doc is null").count() == 0


def test_snapshot_path_format():
    assert snapshot_path("s3a://b/out/", "2026-12-01") == "s3a://b/out/run_date=20261201"


def test_capture_log_and_roster_readers(spark):
    from storylens.operators.capture import first_matches
    from storylens.sources.readers import read_capture_log, read_roster
    d = local_path(scratch_path(spark, "s6"))
    os.makedirs(d)
    msg = {"message": {"method": "Network.responseReceived",
                       "params": {"requestId": "r1", "response": {"url": "https://x/ana/?r=1"}}}}
    with open(f"{d}/log.json", "w") as f:
        f.write(json.dumps({"username": "ana", "seq": 2, "message": json.dumps(msg)}) + "\n")
        f.write(json.dumps({"username": "ana", "seq": 1, "message": "{broken"}) + "\n")
    log = read_capture_log(spark, d)
    assert [(r.username, r.seq, r.request_id) for r in first_matches(log).collect()] == [("ana", 2, "r1")]
    r = local_path(scratch_path(spark, "s4"))
    os.makedirs(r)
    with open(f"{r}/roster.csv", "w") as f:
        f.write('LINK,Rede\nhttps://s.example/ana/,Instagram\n"https://s.example/b,c/",TikTok\n')
    roster = read_roster(spark, r, schema="LINK string, Rede string")
    assert sorted(x.LINK for x in roster.collect()) == ["https://s.example/ana/", "https://s.example/b,c/"]


def test_folder_without_matching_files_reads_empty(spark):
    d = local_path(scratch_path(spark, "s1-empty"))
    os.makedirs(d)
    with open(f"{d}/notes.txt", "w") as f:
        f.write("not a document")
    good, bad = read_reels_files(spark, d, multi_line=True)
    assert good.count() == 0 and bad.count() == 0
    assert daily_attribution(good.select("user", "items"), "2026-12-01").count() == 0


def test_multiline_files_are_bounded(spark, sf_dir, tmp_path, monkeypatch):
    from storylens.plans import registry

    rows = {}
    for most in (1, 10**9):
        monkeypatch.setattr(registry, "REELS_IN_FILE", most)
        monkeypatch.setattr(registry, "scratch_path", lambda _, name: str(tmp_path / str(most)))
        rows[most] = sorted(map(str, registry.reels_files_multiline(spark, sf_dir).collect()))
        held = [f.read_text().count(',\n  "items"') for f in (tmp_path / str(most)).glob("part-*")]
        assert max(held) <= most
    assert rows[1] == rows[10**9] and rows[1]


def test_multiline_files_are_few(spark, tmp_path, monkeypatch):
    # many short reels and some long ones: files are bounded by their characters, so their number is not that of the reels
    from storylens.plans import registry

    spark.range(4000).selectExpr("id as event_id", "if(id < 500, 3, id % 997) as user_id").write.parquet(str(tmp_path / "events.parquet"))
    rows, sizes = {}, {}
    for most in (20_000, registry.FILE_CHARS):
        monkeypatch.setattr(registry, "FILE_CHARS", most)
        monkeypatch.setattr(registry, "scratch_path", lambda _, name: str(tmp_path / str(most)))
        rows[most] = sorted(map(str, registry.reels_files_multiline(spark, str(tmp_path)).collect()))
        texts = [f.read_text() for f in (tmp_path / str(most)).glob("part-*")]
        assert all(len(t) <= most or t.count(',\n  "items"') == 1 for t in texts)
        sizes[most] = sorted(map(len, texts))
        assert len(texts) <= 4 + 2 * sum(sizes[most]) / most  # four tasks
    assert len(set(map(tuple, rows.values()))) == 1 and rows[20_000]
    assert sizes[20_000][-1] > 20_000  # a reel longer than the bound is whole
