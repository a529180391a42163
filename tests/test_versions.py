"""Published folders under a storage that fails at any step."""

import os

import pytest
from pyspark.sql import functions as F

from storylens.session import local_path, scratch_path
from storylens.sinks import folders as versions
from storylens.sinks.writers import (
    publish_snapshot, route_by_story, write_latest_documents, write_reels_table, write_snapshot,
)
from storylens.sources.readers import read_raw_documents, read_reels_table, read_routed, read_snapshot, read_users

DAY = "2026-12-01"


class Failing:
    """A file system, or one of its streams, that raises at the n-th call, before or after doing what is asked."""

    def __init__(self, real, state):
        self._real, self._state = real, state

    def __getattr__(self, name):
        def call(*args):
            self._state["calls"] += 1
            fails = self._state["calls"] == self._state["at"]
            if fails and not self._state["after"]:
                raise OSError("storage fails")
            made = getattr(self._real, name)(*args)
            if fails:
                raise OSError("storage fails")
            return Failing(made, self._state) if name in ("create", "open") else made
        return call


@pytest.fixture
def storage(monkeypatch):
    state = {"at": 0, "after": False, "calls": 0}
    real = versions.file_system
    monkeypatch.setattr(versions, "file_system", lambda spark, path: Failing(real(spark, path), state))
    return state


def rows(spark, name):
    return spark.createDataFrame([(name, "Amazon")], "username string, origin string").withColumn("date", F.lit(DAY).cast("date"))


def steps(storage, run, check, when=(False, True)):
    """``run(turn)`` with a failure at each of its steps, and again without; ``check(turn, failed)`` after each."""
    turn = 0
    for after in when:
        for at in range(1, 60):
            turn += 2
            storage.update(at=at, after=after, calls=0)
            try:
                run(turn)
                failed = False
            except OSError:
                failed = True
            reached = storage["calls"] >= at
            storage.update(at=0)
            check(turn, failed)
            if not reached:
                break
            run(turn + 1)  # a rerun mends it, and removes what was left behind
            check(turn + 1, False)
        assert 5 < at < 59  # there were steps to fail at, and an end


def test_a_failure_at_any_step_leaves_a_whole_snapshot(spark, storage):
    base = scratch_path(spark, "versions-k1")
    path = write_snapshot(rows(spark, "0"), base, DAY)
    shown = ["0"]

    def check(turn, failed):
        now = [r.username for r in read_snapshot(spark, path).collect()]
        # a whole snapshot: the new one, or if the run failed perhaps the one before
        assert len(now) == 1 and now[0] in ([shown[-1], str(turn)] if failed else [str(turn)])
        shown.append(now[0])

    steps(storage, lambda turn: write_snapshot(rows(spark, str(turn)), base, DAY), check)
    assert len([n for n in os.listdir(local_path(path)) if n.startswith(".v=")]) == 1 + versions.KEPT


def test_publish_tells_what_failed_and_keeps_what_was(spark, storage):
    base = scratch_path(spark, "versions-k2")
    first = publish_snapshot(rows(spark, "0"), base, DAY)
    failures = 0
    for at in range(1, 60):
        publish_snapshot(rows(spark, "before"), base, DAY)
        storage.update(at=at, calls=0)
        outcome = publish_snapshot(rows(spark, str(at)), base, DAY)
        reached = storage["calls"] >= at
        storage.update(at=0)
        now = [r.username for r in read_snapshot(spark, first.path).collect()]
        assert len(now) == 1 and (now == [str(at)] if outcome else "storage fails" in outcome.error)
        failures += not outcome
        if not reached:
            break
    assert failures and outcome and outcome.path == first.path
    assert spark.read.option("header", True).csv(outcome.folder).count() == 1


def test_a_manifest_cut_short_counts_for_nothing(spark):
    path = write_snapshot(rows(spark, "a"), scratch_path(spark, "versions-cut"), DAY)
    folder = f"{local_path(path)}/{versions.MANIFESTS}"
    with open(f"{folder}/00000009-cut.json", "w") as f:
        f.write('{"folders": [".v=0000')
    assert [r.username for r in read_snapshot(spark, path).collect()] == ["a"]
    write_snapshot(rows(spark, "b"), local_path(path).rsplit("/", 1)[0], DAY)
    assert [r.username for r in read_snapshot(spark, path).collect()] == ["b"]


def test_who_reads_goes_on_with_the_version_listed(spark):
    base = scratch_path(spark, "versions-read")
    path = write_snapshot(rows(spark, "a"), base, DAY)
    reading = read_snapshot(spark, path)
    write_snapshot(rows(spark, "b"), base, DAY)
    assert [r.username for r in reading.collect()] == ["a"]
    write_snapshot(rows(spark, "c"), base, DAY)
    assert len([n for n in os.listdir(local_path(path)) if n.startswith(".v=")]) == 1 + versions.KEPT


def captures(spark, users, seq, status="captured"):
    return spark.createDataFrame([(u, status, seq, f"{u}-{seq}") for u in users], "username string, status string, seq bigint, doc string")


def test_untouched_documents_keep_their_files(spark):
    base = scratch_path(spark, "versions-k3")
    users = [f"u{i}" for i in range(200)]
    write_latest_documents(captures(spark, users, 1), base, DAY, clusters=16)
    files = lambda: {(r.file, r.username, r.seq) for r in read_raw_documents(spark, base, DAY).select(
        F.col("_metadata.file_path").alias("file"), "username", "seq").collect()}
    before = files()
    write_latest_documents(captures(spark, ["u3", "new"], 2).union(captures(spark, ["u5"], 9, "body_error")), base, DAY)
    after = files()
    assert {(u, s) for _, u, s in after} == {(u, 1) for u in users if u != "u3"} | {("u3", 2), ("new", 2)}
    kept, fresh = {f for f, _, _ in before} & {f for f, _, _ in after}, {f for f, _, _ in after} - {f for f, _, _ in before}
    assert len(kept) >= 14 and 1 <= len(fresh) <= 2
    # nothing captured: nothing changes; and an equal seq takes the new document
    write_latest_documents(captures(spark, ["u7"], 3, "page_error"), base, DAY)
    assert files() == after
    write_latest_documents(captures(spark, ["u7"], 1).withColumn("doc", F.lit("again")), base, DAY)
    assert [r.doc for r in read_raw_documents(spark, base, DAY).where("username = 'u7'").collect()] == ["again"]
    # tables of several days, and of other layouts
    write_latest_documents(captures(spark, ["x"], 1), base, "2026-12-02")
    assert read_raw_documents(spark, base).count() == 202 and read_raw_documents(spark, base, "2026-12-02").count() == 1
    write_latest_documents(captures(spark, ["x"], 1, "body_error"), base, "2026-12-03")
    assert read_raw_documents(spark, base, "2026-12-03").count() == 0


def test_failing_merge_of_a_day(spark, storage):
    base = scratch_path(spark, "versions-k3-fail")
    users = [f"u{i}" for i in range(20)]
    write_latest_documents(captures(spark, users, 0), base, DAY, clusters=4)
    shown = [0]

    def check(turn, failed):
        found = {r.username: r.seq for r in read_raw_documents(spark, base, DAY).collect()}
        assert set(found) == set(users) and all(found[u] == 0 for u in users[1:])
        assert found["u0"] in ([shown[-1], turn] if failed else [turn])
        shown.append(found["u0"])

    steps(storage, lambda turn: write_latest_documents(captures(spark, ["u0"], turn), base, DAY), check, (True,))


def test_failing_reruns_leave_routes_and_reels(spark):
    path, table = scratch_path(spark, "versions-k5"), scratch_path(spark, "versions-k6")
    items = spark.createDataFrame([("a", "[]"), ("b", "No story available")], "requested string, stories string")
    route_by_story(items, path)
    raw = spark.createDataFrame([(DAY, "a", 1, '[{"user": {"username": "a"}, "items": []}]')], "run_date string, username string, seq bigint, doc string")
    write_reels_table(raw, table)
    bad = F.raise_error(F.lit("query fails")).cast("string")
    for run in (lambda: route_by_story(items.withColumn("requested", bad), path),
                lambda: write_reels_table(raw.withColumn("doc", bad), table)):
        with pytest.raises(Exception, match="query fails"):
            run()
    assert read_routed(spark, path, "requested string, stories string").count() == 2
    assert [r.unwrap_status for r in read_reels_table(spark, table).collect()] == ["ok"]


def test_sketches_of_days_count_together(spark):
    base = scratch_path(spark, "versions-sketch")
    days = {"2026-12-01": range(0, 3000), "2026-12-02": range(2000, 5000), "2026-12-03": range(0)}
    for day, users in days.items():
        df = spark.range(users.start, users.stop).select(F.concat(F.lit("u"), "id").alias("username"), F.lit("x").alias("origin"))
        write_snapshot(df, base, day, users="username")
    write_snapshot(spark.range(1).select(F.lit("only").alias("username"), F.lit("x").alias("origin")), base, "2026-12-03", users="username")
    found = read_users(spark, base, list(days))
    assert {(r.run_date, r.n_rows) for r in found.collect()} == {("20261201", 3000), ("20261202", 3000), ("20261203", 1)}
    n = found.agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("n")).first().n
    assert abs(n - 5001) <= 0.03 * 5001
    assert read_snapshot(spark, f"{base}/run_date=20261202", spark.createDataFrame([], "username string, origin string").schema).count() == 3000
