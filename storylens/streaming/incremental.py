"""Q1 as a Structured Streaming job over newly captured raw documents.

Raw documents land as Parquet files under one folder (``run_date``,
``username``, ``seq``, ``doc``). Each trigger reads only files it has not
seen (the file source keeps its own log in the checkpoint), unwraps and
labels them with the same expressions as the batch job, and appends the
``(username, origin, date)`` rows not emitted before. There is no watermark: a
backfill of any day, in any order, gives the rows that the batch job gives, and no
input is dropped for being late. The price is state: one entry for each
distinct row emitted so far (keep it in RocksDB,
``spark.sql.streaming.stateStore.providerClass``, beyond some tens of millions). The file sink commits each
micro-batch exactly once, so a lost executor or a restarted driver never
duplicates or loses output.

The dedup state has as many partitions as ``spark.sql.shuffle.partitions``
when the stream first starts (AQE does not re-plan streaming state, and the
count is kept in the checkpoint): size it for the expected distinct pairs per
day before the first run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from storylens.functions.strings import redirect_host
from storylens.operators.flatten import sticker_values
from storylens.operators.lookup import ORIGIN_RULES_17, RuleSource, label_hosts, origin_of
from storylens.operators.unwrap import reels_from_raw
from storylens.schemas import RAW_DOCUMENTS


def attribution_stream(raw: DataFrame, rules: RuleSource = ORIGIN_RULES_17) -> DataFrame:
    """Streaming (or batch) DataFrame of first-seen ``username, origin, date``.

    ``rules`` must be Python pairs or a static DataFrame (stream-static join).
    """
    reels = reels_from_raw(raw, keep=("run_date",))
    if isinstance(rules, DataFrame):
        links = sticker_values(reels, redirect_host, "host", keep=("run_date",))
        labelled = label_hosts(links, "host", rules, keep_unmatched=False)
    else:  # the label once per sticker, as in the batch job
        labelled = sticker_values(reels, lambda u: origin_of(redirect_host(u), rules), "origin", keep=("run_date",))
    rows = labelled.select("username", "origin", F.col("run_date").alias("date"))
    return rows.dropDuplicates(["username", "origin", "date"])


def start_attribution_stream(spark: SparkSession, raw_path: str, out_path: str, checkpoint: str,
                             available_now: bool = True, processing_time: str | None = None,
                             max_files_per_trigger: int | None = None,
                             rules: RuleSource = ORIGIN_RULES_17) -> StreamingQuery:
    """Run the stream from ``raw_path`` into a Parquet table at ``out_path``.

    ``available_now`` processes everything new and stops (a scheduled daily
    run); otherwise a ``processing_time`` trigger keeps it running.
    """
    reader = spark.readStream.schema(RAW_DOCUMENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = attribution_stream(reader.parquet(raw_path), rules)
    writer = out.writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", checkpoint).partitionBy("date")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(out_path)
