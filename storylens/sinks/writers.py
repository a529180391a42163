"""K1-K6: snapshot CSV, publishing, raw-document store, per-key append, routing, unwrap store.

All writers go through Spark's commit protocol: a task retried after a lost
executor never leaves half-written output behind. What is replaced as a whole (all but the
append) is published in versions: see ``folders``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylens.operators.capture import VISIT, latest_success
from storylens.operators.picks import last_per_key
from storylens.operators.unwrap import unwrap_to_store
from storylens.plans.attribution import has_stories
from storylens.session import scratch_path
from storylens.sinks.folders import current, publish

#: Folders that the keys of ``append_per_key`` are dealt over.
KEY_BUCKETS = 64
#: Parts of a day's documents that a rerun replaces on their own.
CLUSTERS = 64
#: Buckets of a table of response bodies.
BODY_BUCKETS = 64
#: log2 of the registers of a snapshot's sketch of users; their relative error is about 1.04 / 2^(SKETCH / 2) at most.
SKETCH = 14
#: Folder of the sketch in a snapshot's version; readers of the CSV files skip it.
SKETCHES = "_users"

# CSV options that give the published bytes: header, comma, NULL and '' both
# as an empty field, quotes doubled inside quoted fields, dates as yyyy-MM-dd.
SNAPSHOT_CSV = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "dateFormat": "yyyy-MM-dd",
    "encoding": "UTF-8",
}


@dataclass(frozen=True)
class Published:
    """Outcome of a publish: true if it succeeded, else with the storage's message.

    ``path`` is the published name, which the readers of this library resolve; ``folder`` is the
    version behind it, plain CSV files that never change.
    """

    path: str
    error: str | None = None
    folder: str | None = None

    def __bool__(self) -> bool:
        return self.error is None


def snapshot_path(base: str, run_date: str | _dt.date) -> str:
    """the folder of a run date, its stamp as ``date_stamp`` has it."""
    day = run_date if isinstance(run_date, _dt.date) else _dt.date.fromisoformat(run_date)
    return f"{base.rstrip('/')}/run_date={day:%Y%m%d}"


def _published_snapshot(df: DataFrame, path: str, single_file: bool, users: str | None) -> str:
    out = df.repartition(1) if single_file else df

    def write(folder: str) -> None:
        out.write.options(**SNAPSHOT_CSV).csv(folder)
        if users:
            sketch = df.agg(F.hll_sketch_agg(users, F.lit(SKETCH)).alias("users"), F.count("*").alias("n_rows"))
            sketch.write.parquet(f"{folder}/{SKETCHES}")

    return publish(df.sparkSession, path, write)[0]


def write_snapshot(df: DataFrame, base: str, run_date: str | _dt.date,
                   single_file: bool = False, users: str | None = None) -> str:
    """K1: one published folder per run date, a new version on rerun (also of an empty result).

    A failing query or storage leaves the earlier snapshot readable as it was. ``single_file`` is for small output: it
    writes one CSV part through one task (``repartition(1)``, so the aggregation before it keeps all its tasks).
    With ``users``, a column, the version also holds a mergeable sketch of its distinct
    values (A1): days can be counted together without reading their rows.
    """
    path = snapshot_path(base, run_date)
    _published_snapshot(df, path, single_file, users)
    return path


def publish_snapshot(df: DataFrame, uri: str, run_date: str | _dt.date,
                     single_file: bool = False, users: str | None = None) -> Published:
    """K2: the snapshot at an object-store URI (``gs://``, ``s3a://``).

    The query runs first, into the shared scratch folder, and its errors are raised. What
    fails afterwards is the storage: the outcome is then false and says why,
    and an earlier snapshot there stays.
    """
    spark = df.sparkSession
    staged = scratch_path(spark, "publish")
    df.write.parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    path = snapshot_path(uri, run_date)
    try:
        return Published(path, folder=_published_snapshot(rows, path, single_file, users))
    except Exception as e:  # noqa: BLE001 - whatever the storage's client raises
        cause = getattr(e, "java_exception", None)
        return Published(path, cause.toString() if cause else f"{type(e).__name__}: {e}")


def write_latest_documents(captures: DataFrame, path: str, run_date: str | _dt.date,
                           keys: tuple[str, ...] = ("username",), clusters: int = CLUSTERS) -> None:
    """K3: per profile the last successful capture's document of a day.

    A rerun of the day adds its successes to the stored ones: a profile that failed this
    time keeps the document of the earlier run; of two the higher ``seq`` stays. A day's profiles are dealt
    into ``clusters`` by a hash of the keys (the number that its first run used holds). A rerun reads and
    writes only the clusters of its successes; the files of all others belong to the next version as they are.
    """
    spark = captures.sparkSession
    day = f"{path.rstrip('/')}/run_date={run_date}"
    earlier = current(spark, day)
    clusters = earlier.notes["clusters"] if earlier else clusters
    cluster = F.pmod(F.xxhash64(*keys), F.lit(clusters)).cast("int")
    staged = scratch_path(spark, "latest-documents")
    latest = latest_success(captures, keys=keys).select(*keys, "seq", "doc").withColumn("cluster", cluster)
    latest.write.parquet(staged)
    latest = spark.read.schema(latest.schema).parquet(staged)
    touched = [r.cluster for r in latest.select("cluster").distinct().collect()]  # no more than there are clusters
    if earlier and not touched:
        return
    stored = {int(f.rsplit("=", 1)[1]): f for f in earlier.folders} if earlier else {}
    merged = [f"{day}/{stored[c]}" for c in touched if c in stored]
    if merged:
        old = spark.read.schema(latest.drop("cluster").schema).parquet(*merged).withColumn("cluster", cluster)
        # of equal seq the new run's document
        both = latest.withColumn("__new", F.lit(1)).unionByName(old.withColumn("__new", F.lit(0)))
        latest = last_per_key(both, ["cluster", *keys], F.struct("seq", "__new"), ["seq", "doc"])

    def write(folder: str) -> list[str]:
        latest.hint("rebalance", "cluster").write.partitionBy("cluster").parquet(folder)
        return [f"cluster={c}" for c in sorted(touched)]

    publish(spark, day, write, [f for c, f in sorted(stored.items()) if c not in touched], {"clusters": clusters})


def store_bodies(bodies: DataFrame, table: str, path: str, keys: tuple[str, ...] = VISIT, buckets: int = BODY_BUCKETS) -> None:
    """Response bodies as a table (its files at ``path``) bucketed and sorted by visit, for ``capture_outcomes(clustered=True)``."""
    (bodies.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).mode("overwrite").saveAsTable(table))


def _bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key), buckets.cast("long"))


def append_per_key(items: DataFrame, path: str, key_col: str = "requested",
                   default_key: str = "no_user", buckets: int = KEY_BUCKETS) -> None:
    """Append items as JSON lines with their key, in folders by a hash of the key.

    A missing or NULL key files under ``default_key``; any other text is a key of its own, the empty
    one too, and stands in the rows as ``key`` (no folder name has to spell it). The number of folders is that of
    ``buckets``, however many keys there are; a folder's name has both its number and theirs, so
    that appends of different numbers can be read together. Line-delimited output
    keeps repeated keys readable. Rows are rebalanced by bucket before the write: each bucket's rows land in few tasks
    (few files per folder instead of one per task and bucket), and AQE splits a
    bucket holding a large share of the rows into advisory-size partitions.
    """
    key = F.coalesce(F.col(key_col), F.lit(default_key))
    bucket = F.concat_ws("of", _bucket(key, F.lit(buckets)).cast("string"), F.lit(str(buckets)))
    keyed = items.withColumns({"key": key, "bucket": bucket})
    keyed.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").json(path)


def read_per_key(spark, path: str, schema: str, key: str | None = None) -> DataFrame:
    """What ``append_per_key`` wrote, with its ``key``; of one key only the folders that can hold it are read."""
    back = spark.read.schema(f"{schema}, key string, bucket string").json(path)
    if key is not None:
        own = F.split("bucket", "of")
        back = back.where((_bucket(F.lit(key), own[1]) == own[0].cast("long")) & (F.col("key") == key))
    return back.drop("bucket")


def route_by_story(items: DataFrame, path: str) -> None:
    """K5: one pass, items with stories under ``route=stories``, the rest under ``route=no_stories``.

    Published as a version: a failing rerun leaves what was there.
    """
    route = F.when(has_stories(F.col("stories")) | F.col("stories").isNull(), F.lit("stories")) \
        .otherwise(F.lit("no_stories"))
    routed = items.withColumn("route", route)
    publish(items.sparkSession, path, lambda p: routed.write.partitionBy("route").json(p))


def write_reels_table(raw: DataFrame, path: str, doc_col: str = "doc",
                      keep: tuple[str, ...] = ("run_date", "username", "seq")) -> None:
    """K6: unwrapped documents as a new Parquet table, never in place.

    One pass writes both outcomes: ``unwrap_status=ok`` holds the reels
    list, other partitions keep the raw text and are the quarantine. Published as a version: a failing
    rerun leaves the earlier table.
    """
    out = unwrap_to_store(raw, keep, doc_col)
    publish(raw.sparkSession, path, lambda p: out.write.partitionBy("unwrap_status").parquet(p))
