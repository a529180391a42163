"""File sources with explicit schemas and a quarantine for malformed input."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storylens.functions.jsonpath import bind, closed, strict_text, strict_variant
from storylens.schemas import CAPTURE_LOG, EXPORT_ITEM, LINK_SNAPSHOT, RAW_DOCUMENTS, REELS, SNAPSHOT
from storylens.session import scratch_path
from storylens.sinks.folders import folders, names
from storylens.sinks.writers import SKETCHES

_REELS_DDL = REELS.simpleString()
_REEL_DDL = REELS.elementType.simpleString()

# Why a record is in the quarantine.
NOT_JSON = "not_json"
WRONG_SHAPE = "wrong_shape"


@F.pandas_udf(T.ArrayType(T.StringType()))
def json_values(text: pd.Series) -> pd.Series:
    """The texts of all JSON values that stand one after another in a text; NULL if anything else does."""
    decoder, gap = json.JSONDecoder(), re.compile(r"[ \t\r\n]*")

    def split(s: str | None) -> list[str] | None:
        if s is None:
            return None
        out, at = [], gap.match(s).end()
        while at < len(s):
            try:
                _, end = decoder.raw_decode(s, at)
            except (ValueError, RecursionError):
                return None
            out.append(s[at:end])
            at = gap.match(s, end).end()
        return out or None

    return text.map(split)


def _records(spark: SparkSession, path: str, multi_line: bool, glob: str | None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    text = reader.text(path, wholetext=multi_line).select(
        F.col("value").alias("record"), F.col("_metadata.file_path").alias("source_file"))
    return text.filter(F.trim("record") != "")


def _reels_of(value: Column) -> Column:
    """The reels of one whole JSON value, a list or a lone reel; NULL for anything else. One parse."""
    def from_variant(v: Column) -> Column:
        lone = F.try_variant_get(v, "$[0]", _REEL_DDL)
        return F.coalesce(F.try_variant_get(v, "$[0]", _REELS_DDL), F.when(lone.isNotNull(), F.array(lone)))

    return bind(F.try_parse_json(closed(value)), lambda v: F.when(strict_variant(v), from_variant(v)).otherwise(
        F.from_json(strict_text(value), REELS)))


def _items_of(value: Column) -> Column:
    """The export items of one whole JSON value, a list or a lone item; NULL for anything else."""
    text = strict_text(value)
    return bind(text, lambda t: F.when(F.ltrim(t).startswith("["), F.from_json(t, T.ArrayType(EXPORT_ITEM))).when(
        F.ltrim(t).startswith("{"), F.from_json(t, T.ArrayType(EXPORT_ITEM))))


def _parsed(records: DataFrame, parse, store: str | None) -> DataFrame:
    """``record, source_file, rows, reason``: all rows of a record, or none, its text and the reason.

    Most records are one JSON value. Each is parsed once and stored with its rows, or as text if it has
    none; only those texts, read back, are split into their values. If one of the values has another shape,
    or anything else stands between them, the record as a whole has no rows.
    """
    spark = records.sparkSession
    store = store or scratch_path(spark, "records")
    once = records.select("record", "source_file", F.explode_outer(F.array(parse(F.col("record")))).alias("rows"))
    whole = F.col("rows").isNotNull()
    once.select(F.when(~whole, F.col("record")).alias("record"), "source_file", "rows",
                F.when(whole, F.lit("whole")).otherwise(F.lit("rest")).alias("kind")).write.partitionBy("kind").parquet(store)
    stored = spark.read.schema(f"record string, source_file string, rows {once.schema['rows'].dataType.simpleString()}, kind string") \
        .parquet(store)
    good = stored.where("kind = 'whole'").select("record", "source_file", "rows", F.lit(None).cast("string").alias("reason"))
    split = stored.where("kind = 'rest'").select("record", "source_file", json_values("record").alias("texts"))
    many = F.transform("texts", parse)
    rows = F.when(~F.exists(many, lambda r: r.isNull()), F.flatten(many))
    reason = F.when(F.col("texts").isNull(), F.lit(NOT_JSON)).otherwise(F.lit(WRONG_SHAPE))
    out = split.select("record", "source_file", F.explode_outer(F.array(F.struct(
        rows.alias("rows"), reason.alias("reason")))).alias("x"))
    none = F.col("x.rows").isNull()
    return good.unionByName(out.select(F.when(none, F.col("record")).alias("record"), "source_file", F.col("x.rows").alias("rows"),
                                       F.when(none, F.col("x.reason")).alias("reason")))


def tagged_reels_files(spark: SparkSession, path: str, multi_line: bool = False,
                       glob: str | None = "*.json", store: str | None = None) -> DataFrame:
    """S1 + S2 + P14: one frame ``record, source_file, rows, reason`` over story files.

    Line-delimited JSON by default; ``multi_line=True`` reads whole files (they cannot be
    split, so at scale store line-delimited JSON or Parquet). A line or file may hold a reel, an array
    of reels, or several of these one after another. What does not parse
    whole has a ``reason`` and no rows: never a part of a record. ``record`` is the text of those alone.

    The files are read and parsed here, once, into ``store`` (a folder of the shared
    scratch space by default); the frame reads what is there.
    """
    return _parsed(_records(spark, path, multi_line, glob), _reels_of, store)


def read_reels_files(spark: SparkSession, path: str, multi_line: bool = False,
                     glob: str | None = "*.json") -> tuple[DataFrame, DataFrame]:
    """``tagged_reels_files`` as (reels rows, quarantine)."""
    tagged = tagged_reels_files(spark, path, multi_line, glob)
    reels = tagged.filter(F.col("reason").isNull()).select(F.explode("rows").alias("r"), "source_file") \
        .select("r.user", "r.items", "source_file")
    return reels, tagged.filter(F.col("reason").isNotNull()).select("record", "source_file", "reason")


def tagged_export_files(spark: SparkSession, path: str, multi_line: bool = False,
                        glob: str | None = "*.json", store: str | None = None) -> DataFrame:
    """S3: one frame ``record, source_file, rows, reason`` over provider exports.

    A line (or file, with ``multi_line``) holds an item, an array of items, or several of these one
    after another, as an export has them that files a profile twice. Read and stored as by ``tagged_reels_files``.
    """
    return _parsed(_records(spark, path, multi_line, glob), _items_of, store)


def read_export_items(spark: SparkSession, path: str, multi_line: bool = False,
                      glob: str | None = "*.json") -> tuple[DataFrame, DataFrame]:
    """S3: (items, quarantine); ``stories`` keeps an array or a sentence as text."""
    tagged = tagged_export_files(spark, path, multi_line, glob)
    items = tagged.filter(F.col("reason").isNull()).select(F.explode("rows").alias("i"), "source_file") \
        .select("i.requested", "i.stories", "source_file")
    return items, tagged.filter(F.col("reason").isNotNull()).select("record", "source_file", "reason")


def read_roster(spark: SparkSession, path: str, fmt: str = "csv",
                schema: T.StructType | str | None = None) -> DataFrame:
    """A roster sheet exported as CSV (header row) or Parquet."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", False)
    return r.csv(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved pages ``(page_id, url, html)``."""
    return spark.read.parquet(path)


def read_capture_log(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Browser log saved as a table ``(username, seq, message)``."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.schema(CAPTURE_LOG).json(path)


def read_raw_documents(spark: SparkSession, path: str, run_date: str | None = None) -> DataFrame:
    """Raw captured documents table; ``run_date`` prunes to one capture day.

    Days that ``write_latest_documents`` published are read at their current versions. A table of
    other layouts is read as it is.
    """
    path = path.rstrip("/")
    days = [d for d in names(spark, path) if d.startswith("run_date=") and (not run_date or d == f"run_date={run_date}")]
    read = [f for d in sorted(days) for f in folders(spark, f"{path}/{d}")]
    if read:
        df = spark.read.schema(RAW_DOCUMENTS).option("basePath", path).parquet(*read).select(*RAW_DOCUMENTS.names)
    else:
        df = spark.read.schema(RAW_DOCUMENTS).parquet(path)
    return df.filter(F.col("run_date") == F.lit(run_date).cast("date")) if run_date else df


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType = SNAPSHOT) -> DataFrame:
    """A published CSV snapshot, ``username, origin, date`` by default, at its current version.

    Empty fields read as NULL, like the published NULLs.
    """
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(folders(spark, path))


def read_users(spark: SparkSession, base: str, run_dates: list[str]) -> DataFrame:
    """A1 over days: ``(run_date, users, n_rows)``, the sketches of users in the snapshots of some days."""
    days = [f"{base.rstrip('/')}/run_date={d.replace('-', '')}" for d in run_dates]
    read = [f"{f}/{SKETCHES}" for d in days for f in folders(spark, d)]
    schema = "run_date string, users binary, n_rows bigint"
    return spark.read.schema(schema).option("basePath", base.rstrip("/")).parquet(*read)


def read_reels_table(spark: SparkSession, path: str) -> DataFrame:
    """K6 read back: ``run_date, username, seq, reels, raw_doc, unwrap_status`` at the current version."""
    return spark.read.parquet(*folders(spark, path))


def read_routed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """K5 read back, with its ``route``, at the current version."""
    return spark.read.schema(f"{schema}, route string").json(folders(spark, path))


def read_link_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A published link-level snapshot ``username, story_link_url, origin``."""
    return read_snapshot(spark, path, LINK_SNAPSHOT)
