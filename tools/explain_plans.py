"""Write the physical plans of the headline queries to docs/PLANS.md.

Builds the bench inputs (as Parquet, like bench.py) at $BENCH_SF_DIR and
records ``explain("formatted")`` for each headline query.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from storylens.operators import capture as cap  # noqa: E402
from storylens.operators.pages import page_reels  # noqa: E402
from storylens.operators.unwrap import reels_from_raw  # noqa: E402
from storylens.plans import fixtures as fx  # noqa: E402
from storylens.plans.attribution import attribution_rows, daily_attribution, link_attribution  # noqa: E402
from storylens.plans.sql import daily_attribution_sql  # noqa: E402
from storylens.session import build_session, scratch_path  # noqa: E402
from storylens.sinks.writers import write_reels_table  # noqa: E402
from storylens.sources.readers import read_reels_table  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01").rstrip("/")
    spark = build_session("local[8]", 8)
    base = scratch_path(spark, "plans")
    t = lambda n: fx.load(spark, sf_dir, n)
    fx.lineitem_raw_documents(t("lineitem")).write.parquet(f"{base}/raw")
    fx.lineitem_export_items(t("lineitem")).write.parquet(f"{base}/export")
    fx.story_pages(t("pages")).write.parquet(f"{base}/pages")
    fx.capture_log_from_events(t("events")).write.parquet(f"{base}/log")
    profiles, log, bodies, errors = fx.capture_inputs(t("customer"), t("orders"))
    for name, df in (("profiles", profiles), ("clog", log), ("bodies", bodies), ("errors", errors)):
        df.write.parquet(f"{base}/{name}")
    write_reels_table(spark.read.parquet(f"{base}/raw"), f"{base}/reels")
    p = lambda n: spark.read.parquet(f"{base}/{n}")
    curated = read_reels_table(spark, f"{base}/reels").filter(F.col("unwrap_status") == "ok") \
        .select(F.explode("reels").alias("r")).select("r.user", "r.items")
    queries = {
        "daily_attribution (curated reels)": daily_attribution(curated, fx.RUN_DATE),
        "daily_attribution (raw documents)": daily_attribution(reels_from_raw(p("raw")), fx.RUN_DATE),
        "daily_attribution (SQL text, raw documents)": daily_attribution_sql(spark, p("raw"), fx.RUN_DATE),
        "attribution_rows": attribution_rows(curated, fx.RUN_DATE),
        "link_attribution": link_attribution(p("export")),
        "embedded_story_json": page_reels(p("pages")),
        "log_first_match": cap.first_matches(p("log")),
        "capture_outcomes": cap.capture_outcomes(p("profiles"), p("clog"), p("bodies"), p("errors")),
    }
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/explain_plans.py` at `{os.path.basename(sf_dir)}` "
           "(`local[8]`, AQE on; scratch paths shortened). Each query is run once "
           "first, so these are the final adaptive plans; `*` and `[codegen id]` mark "
           "whole-stage codegen. At other sizes AQE may choose differently (partition "
           "counts, broadcast of small join sides, skew splits).", ""]
    for name, df in queries.items():
        df.collect()  # run this plan itself (small at sf0.01) so explain shows the final adaptive plan
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue().replace(base, "<scratch>")
        out += [f"## {name}", "", "```", text.strip(), "```", ""]
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(os.path.join(here, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
