"""The daily job: roster -> raw documents -> curated reels -> snapshot -> counts.

Acquisition (visiting pages) happens elsewhere and lands raw documents in a
table ``(run_date, username, seq, doc)``; this job is the data part of a run.

    python -m storylens.plans.daily_job --raw s3a://b/raw --out s3a://b/attribution \
        --run-date 2026-12-01 [--curated s3a://b/reels] [--roster-a a.csv --roster-b b.csv]
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from storylens.operators.counts import distinct_users
from storylens.operators.lookup import ORIGIN_RULES_17, RuleSource
from storylens.operators.roster import DEFAULT_NETWORK, prepare_roster
from storylens.operators.unwrap import UNWRAP_OK, reels_from_raw
from storylens.plans.attribution import daily_attribution
from storylens.sinks.writers import publish_snapshot, write_reels_table
from storylens.sources.readers import read_raw_documents, read_reels_table, read_roster, read_snapshot


def rules_of(spark: SparkSession, path: str | None, default: RuleSource = ORIGIN_RULES_17) -> RuleSource:
    """Rules from a CSV ``position,host,origin`` with a header, or those in code."""
    if path is None:
        return default
    return spark.read.schema("position long, host string, origin string").option("header", True).csv(path)


def run_daily(spark: SparkSession, raw_path: str, out_base: str, run_date: str,
              curated_path: str | None = None, roster_a: str | None = None,
              roster_b: str | None = None, network: str = DEFAULT_NETWORK,
              single_file: bool = False, rules: str | None = None) -> dict:
    """Run one day; returns the published path and the reported counts.

    With ``curated_path`` the day's documents are unwrapped once into a
    Parquet table (one pass, quarantine included) and the snapshot is read
    from it; otherwise unwrapping happens inside the snapshot query. The snapshot has a sketch of its users
    beside it, so that days can be counted together (``sources.read_users``).
    """
    report: dict = {"run_date": run_date}
    if roster_a and roster_b:
        profiles, bad = prepare_roster(read_roster(spark, roster_a), read_roster(spark, roster_b), network)
        counts = profiles.select(F.lit(1).alias("p"), F.lit(0).alias("q")).unionByName(
            bad.select(F.lit(0).alias("p"), F.lit(1).alias("q"))).agg(
            F.sum("p").alias("profiles"), F.sum("q").alias("quarantined")).first()
        report["profiles"] = int(counts.profiles or 0)
        report["roster_quarantine"] = int(counts.quarantined or 0)
    raw = read_raw_documents(spark, raw_path, run_date)
    if curated_path:
        day = f"{curated_path.rstrip('/')}/run_date={run_date.replace('-', '')}"
        write_reels_table(raw, day)
        curated = read_reels_table(spark, day)
        reels = curated.filter(F.col("unwrap_status") == UNWRAP_OK) \
            .select(F.explode("reels").alias("r")).select("r.user", "r.items")
    else:
        reels = reels_from_raw(raw)
    snapshot = daily_attribution(reels, run_date, rules_of(spark, rules))
    outcome = publish_snapshot(snapshot, out_base, run_date, single_file=single_file, users="username")
    report["published"] = bool(outcome)
    if not outcome:
        report["error"] = outcome.error
    else:
        report["path"], report["folder"] = outcome.path, outcome.folder
        written = read_snapshot(spark, outcome.path)
        report["distinct_users"] = int(written.agg(distinct_users("username")).first()[0])
    return report


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--raw", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--run-date", default=_dt.date.today().isoformat())
    ap.add_argument("--curated")
    ap.add_argument("--roster-a")
    ap.add_argument("--roster-b")
    ap.add_argument("--network", default=DEFAULT_NETWORK)
    ap.add_argument("--rules", help="CSV position,host,origin in place of the rules in code")
    ap.add_argument("--single-file", action="store_true", help="write the snapshot as one CSV file, through one task: for small output")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("storylens-daily").getOrCreate()
    report = run_daily(spark, a.raw, a.out, a.run_date, a.curated, a.roster_a, a.roster_b,
                       a.network, a.single_file, a.rules)
    print(json.dumps(report))
    if not report["published"]:
        raise SystemExit(1)


if __name__ == "__main__":
    main()
