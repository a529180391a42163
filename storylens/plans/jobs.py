"""The other two runs as jobs: a provider export, and a browser capture.

    python -m storylens.plans.jobs export --files s3a://b/export --out s3a://b/links --run-date 2026-12-01
    python -m storylens.plans.jobs capture --profiles p --log l --bodies b --documents s3a://b/raw --run-date 2026-12-01
    python -m storylens.plans.jobs rows --raw s3a://b/raw --out s3a://b/rows --run-date 2026-12-01
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from storylens.operators.capture import capture_outcomes
from storylens.operators.counts import distinct_users, success_rate
from storylens.operators.lookup import ORIGIN_RULES_12
from storylens.operators.unwrap import reels_from_raw
from storylens.plans.attribution import attribution_rows, link_attribution
from storylens.plans.daily_job import rules_of
from storylens.schemas import BODIES
from storylens.session import scratch_path
from storylens.sinks.writers import publish_snapshot, route_by_story, write_latest_documents
from storylens.sources.readers import (
    read_capture_log, read_link_snapshot, read_raw_documents, read_snapshot, tagged_export_files,
)


def _published(outcome, count) -> dict:
    return {"published": True, "path": outcome.path, "folder": outcome.folder, "distinct_users": count(outcome.path)} if outcome else \
        {"published": False, "error": outcome.error}


def run_export(spark: SparkSession, files: str, out_base: str, run_date: str, routed: str | None = None,
               rules: str | None = None, glob: str | None = "*.json", multi_line: bool = False) -> dict:
    """S3 -> K5 -> Q3 -> K2 -> S7 -> A1b: read, route, label, publish, read back, count.

    The files are read and parsed once; what could not be read is counted and stays in the scratch table.
    """
    read = tagged_export_files(spark, files, multi_line, glob, scratch_path(spark, "export-run"))
    items = read.filter(F.col("reason").isNull()).select(F.explode("rows").alias("i")).select("i.requested", "i.stories")
    report: dict = {"run_date": run_date, "items": items.count(),
                    "quarantined": read.filter(F.col("reason").isNotNull()).count()}
    if routed:
        route_by_story(items, routed)
    outcome = publish_snapshot(link_attribution(items, rules_of(spark, rules, ORIGIN_RULES_12)), out_base, run_date)
    return report | _published(outcome, lambda p: int(
        read_link_snapshot(spark, p).agg(distinct_users("username")).first()[0]))


def run_capture(spark: SparkSession, profiles: str, log: str, bodies: str, documents: str, run_date: str,
                page_errors: str | None = None) -> dict:
    """Q5 -> K3: outcomes of the visits, captured documents into the day's store."""
    outcomes = capture_outcomes(
        spark.read.parquet(profiles), read_capture_log(spark, log), spark.read.schema(BODIES).json(bodies),
        spark.read.parquet(page_errors) if page_errors else None)
    done = scratch_path(spark, "capture-run")
    outcomes.write.parquet(done)
    outcomes = spark.read.parquet(done)
    write_latest_documents(outcomes, documents, run_date)
    return {"run_date": run_date, **{k: int(v) for k, v in success_rate(outcomes).first().asDict().items()}}


def run_rows(spark: SparkSession, raw: str, out_base: str, run_date: str, rules: str | None = None) -> dict:
    """Q2: one row per sticker, unknown origins kept."""
    rows = attribution_rows(reels_from_raw(read_raw_documents(spark, raw, run_date)), run_date, rules_of(spark, rules))
    outcome = publish_snapshot(rows, out_base, run_date)
    return {"run_date": run_date} | _published(outcome, lambda p: int(
        read_snapshot(spark, p).agg(distinct_users("username")).first()[0]))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    sub = ap.add_subparsers(dest="job", required=True)
    jobs = {"export": (run_export, ("files", "out-base"), ("routed", "rules", "glob")),
            "capture": (run_capture, ("profiles", "log", "bodies", "documents"), ("page-errors",)),
            "rows": (run_rows, ("raw", "out-base"), ("rules",))}
    for name, (_, needed, optional) in jobs.items():
        p = sub.add_parser(name)
        for a in needed:
            p.add_argument(f"--{a}", *(["--out"] if a == "out-base" else []), required=True)
        for a in optional:
            p.add_argument(f"--{a}", default=argparse.SUPPRESS)
        p.add_argument("--run-date", default=_dt.date.today().isoformat())
    a = vars(ap.parse_args(argv))
    spark = SparkSession.builder.appName(f"storylens-{a['job']}").getOrCreate()
    report = jobs[a.pop("job")][0](spark, **a)
    print(json.dumps(report))
    if report.get("published") is False:
        raise SystemExit(1)


if __name__ == "__main__":
    main()
