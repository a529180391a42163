"""Scaling check: Q1 on $REPLICAS copies of the sf0.1 lineitem documents, Spark vs DuckDB.

Copies shift the order keys, users stay the same (each user gets REPLICAS
times more stickers). With HOT=1 a third of all lines move to one supplier, so
one user holds a third of all stickers. Documents are stored as Parquet (raw and curated) and
as JSON lines for DuckDB before timing; each engine's time is the median of
3 runs after a warm-up. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from storylens.operators.lookup import ORIGIN_RULES_17  # noqa: E402
from storylens.operators.unwrap import reels_from_raw  # noqa: E402
from storylens.plans import fixtures as fx  # noqa: E402
from storylens.plans.attribution import daily_attribution  # noqa: E402
from storylens.plans.oracle import case_sql, host_sql  # noqa: E402
from storylens.session import build_session, local_path, scratch_path  # noqa: E402
from storylens.sinks.writers import write_reels_table  # noqa: E402
from storylens.sources.readers import read_reels_table  # noqa: E402


def _median(fn, runs=3):
    fn()
    ts = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        ts.append(time.perf_counter() - t0)
    return round(statistics.median(ts), 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    replicas = int(os.environ.get("REPLICAS", "10"))
    hot = os.environ.get("HOT", "0") == "1"
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", cpus, "storylens-scale", {"spark.driver.memory": "16g"})
    base = scratch_path(spark, "scale")
    li = fx.load(spark, sf_dir, "lineitem")
    big = li.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))).alias("rep")) \
        .withColumn("l_orderkey", F.col("l_orderkey") + F.col("rep") * F.lit(10_000_000)).drop("rep")
    if hot:
        big = big.withColumn("l_suppkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1))
                             .otherwise(F.col("l_suppkey")))
    fx.lineitem_raw_documents(big).write.parquet(f"{base}/raw")
    raw = spark.read.parquet(f"{base}/raw")
    write_reels_table(raw, f"{base}/reels")
    reels = reels_from_raw(spark.read.parquet(f"{base}/raw"))
    reels.select(F.to_json(F.struct("user", "items")).alias("value")).write.text(f"{base}/jsonl")
    n = big.count()

    def curated():
        return read_reels_table(spark, f"{base}/reels").filter(F.col("unwrap_status") == "ok") \
            .select(F.explode("reels").alias("r")).select("r.user", "r.items")

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    spark_cur = _median(lambda: noop(daily_attribution(curated(), fx.RUN_DATE)))
    spark_raw = _median(lambda: noop(daily_attribution(reels_from_raw(spark.read.parquet(f"{base}/raw")),
                                                       fx.RUN_DATE)))
    rows = daily_attribution(curated(), fx.RUN_DATE).count()
    spark.stop()
    files = os.path.join(local_path(f"{base}/jsonl"), "*.txt")
    sql = f"""
    WITH items AS (SELECT r.user.username AS username, unnest(r.items) AS item
                   FROM read_json('{files}', format='newline_delimited', records=false) AS t(r)),
    links AS (SELECT username, {host_sql('unnest(item.story_link_stickers).story_link.url')} AS host
              FROM items)
    SELECT DISTINCT username, {case_sql('host', ORIGIN_RULES_17)} AS origin, DATE '{fx.RUN_DATE}' AS date
    FROM links WHERE {case_sql('host', ORIGIN_RULES_17)} IS NOT NULL"""
    con = duckdb.connect()
    duck_rows = len(con.execute(sql).fetchall())
    duck = _median(lambda: con.execute(sql).fetchall())
    print(json.dumps({"stickers": n, "replicas": replicas, "hot_user": hot, "rows": rows, "duckdb_rows": duck_rows,
                      "spark_curated_sec": spark_cur, "spark_raw_sec": spark_raw,
                      "duckdb_jsonl_sec": duck, "cpus": cpus}))


if __name__ == "__main__":
    main()
