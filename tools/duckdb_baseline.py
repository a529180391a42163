"""Single-node reference point: DuckDB on the same reels, stored as JSON lines.

Builds the bench's lineitem documents with Spark, writes the unwrapped reels
as JSON-lines files, then times DuckDB's flatten -> host -> label -> distinct
over them (median of 3, after one warm-up). Prints one JSON line.
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
from storylens.plans.oracle import case_sql, host_sql  # noqa: E402
from storylens.session import build_session, local_path, scratch_path  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = build_session("local[8]", 8)
    path = scratch_path(spark, "duckdb-reels")
    reels = reels_from_raw(fx.lineitem_raw_documents(fx.load(spark, sf_dir, "lineitem")))
    reels.select(F.to_json(F.struct("user", "items")).alias("value")).write.text(path)
    spark.stop()
    files = os.path.join(local_path(path), "*.txt")
    sql = f"""
    WITH items AS (SELECT r.user.username AS username, unnest(r.items) AS item
                   FROM read_json('{files}', format='newline_delimited', records=false) AS t(r)),
    links AS (SELECT username, {host_sql('unnest(item.story_link_stickers).story_link.url')} AS host
              FROM items)
    SELECT DISTINCT username, {case_sql('host', ORIGIN_RULES_17)} AS origin, DATE '{fx.RUN_DATE}' AS date
    FROM links WHERE {case_sql('host', ORIGIN_RULES_17)} IS NOT NULL"""
    con = duckdb.connect()
    n = len(con.execute(sql).fetchall())
    times = []
    for _ in range(3):
        t0 = time.perf_counter()
        con.execute(sql).fetchall()
        times.append(time.perf_counter() - t0)
    print(json.dumps({"engine": "duckdb", "query": "daily_attribution", "rows": n,
                      "sec": round(statistics.median(times), 3), "threads": os.cpu_count()}))


if __name__ == "__main__":
    main()
