"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables and derives its nested inputs from them
(``fixtures.py``), so its work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storylens.functions.binary import body_text
from storylens.functions.strings import date_stamp, display_host, redirect_host
from storylens.operators import capture as cap
from storylens.operators.counts import distinct_users, documents_per_key, success_rate
from storylens.operators.flatten import explode_items, explode_stickers
from storylens.operators.lookup import ORIGIN_RULES_12, ORIGIN_RULES_17, label_hosts
from storylens.operators.pages import page_blocks, page_reels
from storylens.operators.picks import last_per_key
from storylens.operators.roster import prepare_roster, split_profiles
from storylens.operators.unwrap import reels_from_raw, unwrap
from storylens.plans import fixtures as fx
from storylens.plans.attribution import (
    attribution_rows as q2, daily_attribution as q1, has_stories, link_attribution as q3,
)
from storylens.plans.sql import daily_attribution_sql
from storylens.session import scratch_path
from storylens.sinks.writers import (
    SKETCH, append_per_key, publish_snapshot, read_per_key, route_by_story, snapshot_path, store_bodies,
    write_latest_documents, write_reels_table, write_snapshot,
)
from storylens.sources.readers import (
    read_capture_log, read_export_items, read_link_snapshot, read_raw_documents, read_reels_files, read_reels_table,
    read_roster, read_routed, read_snapshot, read_users, tagged_reels_files,
)
from storylens.streaming.incremental import start_attribution_stream

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark, sf_dir, name):
    return fx.load(spark, sf_dir, name)


# --- roster (Q6) -------------------------------------------------------------

def roster_union(spark, sf_dir):
    profiles, _ = prepare_roster(fx.roster_a(_table(spark, sf_dir, "customer")),
                                 fx.roster_b(_table(spark, sf_dir, "supplier")))
    return profiles.select("LINK", "c_custkey", "c_mktsegment", "Rede")


def roster_profile_key(spark, sf_dir):
    links = _table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("LINK"))
    profiles, _ = split_profiles(links)
    return profiles


def key_quarantine(spark, sf_dir):
    _, bad = split_profiles(fx.shortened_links(_table(spark, sf_dir, "pages")))
    return bad.select("page_id", "LINK", "reason")


# --- host functions and lookups -----------------------------------------------

def redirect_host_q(spark, sf_dir):
    p = _table(spark, sf_dir, "pages")
    link = F.concat(F.lit("https://l.example/?u="), F.url_encode("url"), F.lit("&e="),
                    F.col("page_id").cast("string"))
    return p.select("page_id", redirect_host(link).alias("host"))


def display_host_q(spark, sf_dir):
    p = _table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_replace("url", "^[a-z]+://", "").alias("display_url"))
    return p.select("page_id", "display_url", display_host("display_url").alias("host"))


def origin_lookup(spark, sf_dir):
    ev = _table(spark, sf_dir, "events").select(
        "event_id", redirect_host(fx.link_url(F.col("event_id"))).alias("host"))
    return label_hosts(ev, "host").select("event_id", "host", "origin")


def origin_lookup_12(spark, sf_dir):
    ev = _table(spark, sf_dir, "events").select(
        "event_id", display_host(fx.display_url(F.col("event_id"))).alias("host"))
    return label_hosts(ev, "host", ORIGIN_RULES_12).select("event_id", "host", "origin")


# --- flattening ----------------------------------------------------------------

def _order_reels(spark, sf_dir):
    return fx.order_reels(_table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem"))


def unnest_stories(spark, sf_dir):
    items = explode_items(_order_reels(spark, sf_dir))
    s = F.col("item.story_link_stickers")
    return items.select("username", F.when(s.isNotNull(), F.size(s)).cast("bigint").alias("n_stickers"))


def unnest_stickers(spark, sf_dir):
    return explode_stickers(explode_items(_order_reels(spark, sf_dir)))


# --- attribution (Q1-Q3) ----------------------------------------------------------

def _event_reels(spark, sf_dir):
    return reels_from_raw(fx.raw_documents(_table(spark, sf_dir, "events")))


def daily_attribution(spark, sf_dir):
    return q1(_event_reels(spark, sf_dir), fx.RUN_DATE)


def attribution_rows(spark, sf_dir):
    return q2(_event_reels(spark, sf_dir), fx.RUN_DATE)


def link_attribution(spark, sf_dir):
    return q3(fx.export_items(_table(spark, sf_dir, "events")))


def route_no_story(spark, sf_dir):
    items = fx.export_items(_table(spark, sf_dir, "events"))
    return items.select("item_id", "requested", has_stories(F.col("stories")).alias("has_stories"))


def default_key(spark, sf_dir):
    items = fx.export_items(_table(spark, sf_dir, "events"))
    keyed = items.select(F.coalesce("requested", F.lit("no_user")).alias("key"))
    return documents_per_key(keyed, "key")


# --- pages (Q4) -------------------------------------------------------------------

def script_blocks_q(spark, sf_dir):
    return page_blocks(_table(spark, sf_dir, "pages"), pattern=r"(?s)<script[^>]*>(.*?)</script>") \
        .select("page_id", F.col("pos").cast("bigint").alias("pos"), "block")


def embedded_story_json(spark, sf_dir):
    u = page_reels(fx.story_pages(_table(spark, sf_dir, "pages")))
    reels = u.filter(F.col("unwrap_status") == "ok") \
        .select("page_id", F.explode("reels").alias("r")).select("page_id", "r.user", "r.items")
    return explode_stickers(explode_items(reels, keep=("page_id",)), keep=("page_id",))


def path_failures(spark, sf_dir):
    u = unwrap(fx.strict_documents(fx.raw_documents(_table(spark, sf_dir, "events"))))
    return u.select("username", "seq", F.col("unwrap_status").alias("reason"))


# --- capture log (Q5) ---------------------------------------------------------------

def log_first_match(spark, sf_dir):
    log = fx.capture_log_from_events(_table(spark, sf_dir, "events"))
    return cap.first_matches(log).select("username", "seq", "request_id")


def body_decode(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    requests = docs.select(F.col("source").alias("username"), "doc_id",
                           F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("request_id"))
    fetched = requests.join(fx.document_bodies(docs), ["username", "request_id"], "left")
    return fetched.select("doc_id", body_text(F.col("body"), F.col("base64_encoded")).alias("text"))


def _capture(spark, sf_dir):
    profiles, log, bodies, errors = fx.capture_inputs(_table(spark, sf_dir, "customer"),
                                                      _table(spark, sf_dir, "orders"))
    return cap.capture_outcomes(profiles, log, bodies, errors)


def _digest(col):
    return F.md5(F.col(col).cast("binary")).alias(f"{col}_md5")


def capture_outcomes(spark, sf_dir):
    return _capture(spark, sf_dir).select("username", "status", "seq", _digest("doc"))


def capture_outcomes_stored(spark, sf_dir):
    """J2 with bodies stored by visit: neither bodies nor documents move."""
    profiles, log, bodies, errors = fx.capture_inputs(_table(spark, sf_dir, "customer"), _table(spark, sf_dir, "orders"))
    path = scratch_path(spark, "bodies")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    store_bodies(bodies, table, path)
    done = cap.capture_outcomes(profiles, log, spark.table(table), errors, clustered=True)
    return done.select("username", "status", "seq", _digest("doc"))


def capture_summary(spark, sf_dir):
    return success_rate(_capture(spark, sf_dir))


def latest_payload(spark, sf_dir):
    ev = _table(spark, sf_dir, "events").filter(F.col("event_type") != "error").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("username"),
        "ts", F.col("event_id").alias("seq"), F.col("props").alias("payload"))
    return last_per_key(ev, ["username"], F.struct("ts", "seq"), ["seq", "payload"])


# --- counts, sinks and sources ---------------------------------------------------------

def user_counts(spark, sf_dir):
    # one pass over the sticker rows gives both user counts
    users = q2(_event_reels(spark, sf_dir), fx.RUN_DATE).agg(
        F.count_distinct(F.when(F.col("origin").isNotNull(), F.col("username"))).alias("distinct_users"),
        distinct_users("username").alias("users_with_sticker"))
    profiles, _ = prepare_roster(fx.roster_a(_table(spark, sf_dir, "customer")),
                                 fx.roster_b(_table(spark, sf_dir, "supplier")))
    c = profiles.agg(F.count(F.lit(1)).cast("bigint").alias("n_profiles"))
    # two one-row results side by side, without a cross join
    both = users.unionByName(c, allowMissingColumns=True)
    return both.agg(*[F.max(k).alias(k) for k in ("distinct_users", "users_with_sticker", "n_profiles")])


def snapshot_roundtrip(spark, sf_dir):
    base = scratch_path(spark, "snapshot")
    write_snapshot(daily_attribution(spark, sf_dir), base, fx.RUN_DATE)
    return read_snapshot(spark, snapshot_path(base, fx.RUN_DATE))


def permissive_json(spark, sf_dir):
    kind = fx.broken_kind(F.col("user_id"), F.col("block"))
    reels = fx.event_reels(_table(spark, sf_dir, "events"))
    line = F.to_json(F.col("reel"))
    text = reels.select(F.when(kind == 5, F.substring(line, 1, 40)).otherwise(line).alias("value"))
    path = scratch_path(spark, "reels-jsonl")
    text.write.mode("overwrite").text(path)
    tagged = tagged_reels_files(spark, path, glob=None).select(
        F.when(F.col("reason").isNull(), F.lit("ok")).otherwise(F.lit("quarantined")).alias("status"),
        F.explode_outer("rows").alias("r"))
    return tagged.select("status", F.col("r.user.username").alias("username"),
                         F.size("r.items").cast("bigint").alias("n_items"))


#: Reels and characters in a file that is read as one record; a longer reel has a file of its own.
REELS_IN_FILE, FILE_CHARS = 1 << 16, 1 << 22


def _file_texts(reels: DataFrame) -> DataFrame:
    """The reels' texts of each task, joined to the texts of files within ``REELS_IN_FILE`` and ``FILE_CHARS``."""
    most, chars = REELS_IN_FILE, FILE_CHARS

    def run(batches):
        held, size = [], 0

        def text():
            return pa.RecordBatch.from_arrays([pa.array(["\n".join(held)])], ["value"])

        for b in batches:
            for reel in b.column(0).to_pylist():
                if held and (len(held) == most or size + len(reel) + 1 > chars):
                    yield text()
                    held, size = [], 0
                held.append(reel)
                size += len(reel) + 1
        if held:
            yield text()

    return reels.mapInArrow(run, "value string")


def reels_files_multiline(spark, sf_dir):
    """Files that hold several pretty-printed arrays one after another, read whole."""
    reels = fx.event_reels(_table(spark, sf_dir, "events"))
    text = F.replace(F.to_json(F.array("reel")), F.lit(',"items"'), F.lit(',\n  "items"'))
    path = scratch_path(spark, "reels-multiline")
    _file_texts(reels.select(text.alias("value"))).write.option("maxRecordsPerFile", 1).text(path)
    good, _ = read_reels_files(spark, path, multi_line=True, glob="part-*")
    return q1(good, fx.RUN_DATE)


def export_files_roundtrip(spark, sf_dir):
    """S3 then Q3: lines with one item, an array, two items, or an item and junk (item_id % 4)."""
    items = fx.export_items(_table(spark, sf_dir, "events"))
    kind, item = F.col("item_id") % 4, F.to_json(F.struct("requested", "stories"))
    line = (F.when(kind == 0, item).when(kind == 1, F.concat(F.lit("["), item, F.lit("]")))
            .when(kind == 2, F.concat(item, F.lit(" "), item)).otherwise(F.concat(item, F.lit(" oops"))))
    path = scratch_path(spark, "export-files")
    items.select(line.alias("value")).write.text(path)
    read, _ = read_export_items(spark, path, glob="part-*")
    return q3(read)


def roster_files(spark, sf_dir):
    """S4 then Q6: both rosters as CSV sheets."""
    path = scratch_path(spark, "rosters")
    for name, frame in (("a", fx.roster_a(_table(spark, sf_dir, "customer"))),
                        ("b", fx.roster_b(_table(spark, sf_dir, "supplier")))):
        frame.write.option("header", True).csv(f"{path}/{name}")
    profiles, _ = prepare_roster(read_roster(spark, f"{path}/a"), read_roster(spark, f"{path}/b"))
    return profiles.select("LINK", F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_mktsegment", "Rede")


def capture_log_files(spark, sf_dir):
    """S6 then U3: the browser log as JSON lines."""
    path = scratch_path(spark, "capture-log")
    fx.capture_log_from_events(_table(spark, sf_dir, "events")).write.json(path)
    return cap.first_matches(read_capture_log(spark, path)).select("username", "seq", "request_id")


def link_snapshot_roundtrip(spark, sf_dir):
    """Q3 published as a snapshot and read back."""
    base = scratch_path(spark, "link-snapshot")
    write_snapshot(link_attribution(spark, sf_dir), base, fx.RUN_DATE)
    return read_link_snapshot(spark, snapshot_path(base, fx.RUN_DATE))


def publish_roundtrip(spark, sf_dir):
    """K2 then A1b: counts of the published file."""
    outcome = publish_snapshot(daily_attribution(spark, sf_dir), scratch_path(spark, "published"), fx.RUN_DATE)
    back = read_snapshot(spark, outcome.path)
    return back.agg(distinct_users("username").alias("distinct_users"), F.count(F.lit(1)).alias("n_rows"),
                    F.max(date_stamp("date")).alias("stamp"))


#: Days whose snapshots are counted together, and how far a sketch's count may be off (four standard errors).
DAYS = ("2026-12-01", "2026-12-02", "2026-12-03")
SKETCH_ERROR = 4 * 1.04 / 2 ** (SKETCH / 2)


def users_over_days(spark, sf_dir):
    """A1, A1b over days: users of each snapshot and of all, by rows and by the sketches stored with them."""
    base, events = scratch_path(spark, "days"), _table(spark, sf_dir, "events")
    for k, day in enumerate(DAYS):
        reels = reels_from_raw(fx.raw_documents(events.filter(F.col("event_id") % len(DAYS) == k)))
        write_snapshot(q1(reels, day), base, day, users="username")
    stored = [read_snapshot(spark, snapshot_path(base, d)).withColumn("run_date", F.lit(d.replace("-", ""))) for d in DAYS]
    exact = reduce(DataFrame.unionByName, stored).rollup("run_date").agg(distinct_users("username").alias("distinct_users"))
    counted = read_users(spark, base, list(DAYS)).rollup("run_date").agg(
        F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("users")).alias("estimate"))
    both = exact.withColumn("run_date", F.coalesce("run_date", F.lit("all"))).join(
        counted.withColumn("run_date", F.coalesce("run_date", F.lit("all"))), "run_date")
    off = F.abs(F.col("estimate") - F.col("distinct_users"))
    return both.select("run_date", "n_rows", "distinct_users", (off <= SKETCH_ERROR * F.col("distinct_users")).alias("within"))


def origin_lookup_table(spark, sf_dir):
    """J1 with a rule table that repeats hosts: the first rule of a host counts."""
    rules = [(i, h, o) for i, (h, o) in enumerate(ORIGIN_RULES_17)]
    rules += [(len(rules) + i, h, "later") for i, (h, _) in enumerate(ORIGIN_RULES_17[::2])]
    table = spark.createDataFrame(rules, "position long, host string, origin string")
    ev = _table(spark, sf_dir, "events").select(
        "event_id", redirect_host(fx.link_url(F.col("event_id"))).alias("host"))
    return label_hosts(ev, "host", table).select("event_id", "host", "origin")


def stream_attribution(spark, sf_dir):
    """Q1 through the streaming job: raw documents land as files, one
    available-now run processes them, the sink is read back."""
    base = scratch_path(spark, "stream")
    fx.raw_documents(_table(spark, sf_dir, "events")).write.mode("overwrite").parquet(f"{base}/raw")
    q = start_attribution_stream(spark, f"{base}/raw", f"{base}/out", f"{base}/_checkpoint")
    q.awaitTermination()
    return spark.read.schema("username string, origin string, date date").parquet(f"{base}/out")


def reels_table_roundtrip(spark, sf_dir):
    """K6 then Q1: unwrap once into a Parquet table, read the ok partition back."""
    path = scratch_path(spark, "reels-table")
    write_reels_table(fx.raw_documents(_table(spark, sf_dir, "events")), path)
    curated = read_reels_table(spark, path).filter(F.col("unwrap_status") == "ok") \
        .select(F.explode("reels").alias("r")).select("r.user", "r.items")
    return q1(curated, fx.RUN_DATE)


def route_roundtrip(spark, sf_dir):
    """K5: one routed write, read back with its route folder."""
    path = scratch_path(spark, "routed")
    route_by_story(fx.export_items(_table(spark, sf_dir, "events")), path)
    back = read_routed(spark, path, "item_id bigint, requested string, stories string")
    return back.select("item_id", "requested", "route")


def per_key_append(spark, sf_dir):
    """K4: two appends of the same items under per-key folders, counted back."""
    path = scratch_path(spark, "per-key")
    items = fx.export_items(_table(spark, sf_dir, "events"))
    append_per_key(items, path)
    append_per_key(items, path)
    back = read_per_key(spark, path, "item_id bigint, requested string, stories string")
    return back.groupBy("key", "item_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_items"))


def latest_documents(spark, sf_dir):
    """K3: last successful capture per profile written by run date, read back."""
    path = scratch_path(spark, "latest-docs")
    write_latest_documents(_capture(spark, sf_dir), path, fx.RUN_DATE)
    return _stored_documents(spark, path)


def _stored_documents(spark, path):
    return read_raw_documents(spark, path, fx.RUN_DATE).select("run_date", "username", "seq", _digest("doc"))


def latest_documents_rerun(spark, sf_dir):
    """K3 twice on one day: in the second run every other profile fails, the others have a later document."""
    path = scratch_path(spark, "latest-docs")
    captures = _capture(spark, sf_dir)
    write_latest_documents(captures, path, fx.RUN_DATE)
    failed = F.substring("username", 2, 20).cast("bigint") % 2 == 0
    second = captures.select("username", F.when(failed, F.lit(cap.BODY_ERROR)).otherwise(F.col("status")).alias("status"),
                             (F.col("seq") + 1).alias("seq"), F.concat("doc", F.lit(" ")).alias("doc"))
    write_latest_documents(second, path, fx.RUN_DATE)
    return _stored_documents(spark, path)


def sql_daily_attribution(spark, sf_dir):
    """Q1 written as one parameterised SQL string over the raw documents."""
    raw = fx.strict_documents(fx.raw_documents(_table(spark, sf_dir, "events")))
    return daily_attribution_sql(spark, raw, fx.RUN_DATE)


QUERIES: dict[str, Query] = {
    "daily_attribution": daily_attribution,
    "attribution_rows": attribution_rows,
    "link_attribution": link_attribution,
    "route_no_story": route_no_story,
    "default_key": default_key,
    "roster_union": roster_union,
    "roster_profile_key": roster_profile_key,
    "key_quarantine": key_quarantine,
    "redirect_host": redirect_host_q,
    "display_host": display_host_q,
    "origin_lookup": origin_lookup,
    "origin_lookup_12": origin_lookup_12,
    "unnest_stories": unnest_stories,
    "unnest_stickers": unnest_stickers,
    "script_blocks": script_blocks_q,
    "embedded_story_json": embedded_story_json,
    "path_failures": path_failures,
    "log_first_match": log_first_match,
    "body_decode": body_decode,
    "capture_outcomes": capture_outcomes,
    "capture_outcomes_stored": capture_outcomes_stored,
    "capture_summary": capture_summary,
    "latest_payload": latest_payload,
    "user_counts": user_counts,
    "snapshot_roundtrip": snapshot_roundtrip,
    "permissive_json": permissive_json,
    "stream_attribution": stream_attribution,
    "reels_table_roundtrip": reels_table_roundtrip,
    "route_roundtrip": route_roundtrip,
    "per_key_append": per_key_append,
    "latest_documents": latest_documents,
    "sql_daily_attribution": sql_daily_attribution,
    "origin_lookup_table": origin_lookup_table,
    "reels_files_multiline": reels_files_multiline,
    "export_files_roundtrip": export_files_roundtrip,
    "roster_files": roster_files,
    "capture_log_files": capture_log_files,
    "link_snapshot_roundtrip": link_snapshot_roundtrip,
    "publish_roundtrip": publish_roundtrip,
    "users_over_days": users_over_days,
    "latest_documents_rerun": latest_documents_rerun,
}
