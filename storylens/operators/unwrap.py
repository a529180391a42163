"""Raw captured documents -> reels rows, failures quarantined.

A document whose path does not resolve (missing key, index out of range, a
NULL on the way) or that is not JSON at all is kept with a reason instead of
being rewritten in place, so the step is idempotent and reruns are safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylens.functions.jsonpath import (
    REELS_PATH, bind, closed, strict_text, strict_variant, unwrap_reels_json,
)
from storylens.schemas import REELS

UNWRAP_OK = "ok"
REASON_NOT_JSON = "not_json"
REASON_PATH = "path_not_found"
REASON_NOT_LIST = "not_a_list"


def _result(status: Column, reels: Column | None = None) -> Column:
    reels = F.lit(None).cast(REELS) if reels is None else reels
    return F.struct(reels.alias("reels"), status.alias("unwrap_status"))


def _failed(status: str) -> Column:
    return _result(F.lit(status))


def from_variant(v: Column, path: str) -> Column:
    """The outcome from the VARIANT of a ``closed`` document: no second parse."""
    at = "$[0]" + path[1:]
    listed = F.coalesce(F.try_variant_get(v, at, REELS.simpleString()),
                        F.when(F.try_variant_get(v, at, "string").isNull(),
                               F.try_variant_get(v, "$[0]", REELS.simpleString())))
    # a lone object at the path counts as a list of one
    lone = F.try_variant_get(v, at, REELS.elementType.simpleString())
    return bind(F.coalesce(listed, F.when(lone.isNotNull(), F.array(lone))), lambda reels: (
        F.when(reels.isNotNull(), _result(F.lit(UNWRAP_OK), reels))
        .when(F.try_variant_get(v, at, "string").isNull(), _failed(REASON_PATH))
        .otherwise(_failed(REASON_NOT_LIST))))


def from_text(text: Column, path: str) -> Column:
    """The outcome of a document that the VARIANT parser refuses; ``text`` is NULL if it is not JSON."""
    listed = unwrap_reels_json(text, path)
    return bind(F.struct(listed.alias("json"), F.from_json(listed, REELS).alias("reels")), lambda x: (
        F.when(text.isNull(), _failed(REASON_NOT_JSON))
        .when(x.getField("reels").isNotNull(), _result(F.lit(UNWRAP_OK), x.getField("reels")))
        .when(x.getField("json").isNull(), _failed(REASON_PATH))
        .otherwise(_failed(REASON_NOT_LIST))))


def unwrapped_col(doc: Column, path: str = REELS_PATH) -> Column:
    """``struct<reels, unwrap_status>`` of a document, P5 and P6 in one expression.

    A document is valid if it is one JSON value and nothing else. It is parsed once
    into a VARIANT, and path and reason are read from that; only what the VARIANT parser
    refuses (repeated keys, NaN, size limit) or what is not JSON takes the text path, which
    gives the same value and the same reasons.
    """
    return bind(F.try_parse_json(closed(doc)), lambda v: (
        F.when(strict_variant(v), from_variant(v, path))
        .otherwise(bind(strict_text(doc), lambda t: from_text(t, path)))))


def unwrap(raw: DataFrame, doc_col: str = "doc", path: str = REELS_PATH) -> DataFrame:
    """Add ``reels`` (array of reel structs) and ``unwrap_status`` to each raw row.

    The outcome is the input of a one-element generator, so filters on it
    stay above and never parse a document again; its fields come out as columns, without another copy.
    """
    kept = [c for c in raw.columns if c not in ("reels", "unwrap_status")]
    return raw.select(*kept, F.inline_outer(F.array(unwrapped_col(F.col(doc_col), path))))


def unwrap_to_store(raw: DataFrame, keep: tuple[str, ...], doc_col: str = "doc", path: str = REELS_PATH) -> DataFrame:
    """K6: ``keep…, reels, unwrap_status, raw_doc``; only documents that did not unwrap go on as text."""
    doc = F.col(doc_col)
    outcome = bind(unwrapped_col(doc, path), lambda o: F.struct(
        o.getField("reels").alias("reels"), o.getField("unwrap_status").alias("unwrap_status"),
        F.when(o.getField("unwrap_status") != UNWRAP_OK, doc).alias("raw_doc")))
    return raw.select(*keep, F.inline_outer(F.array(outcome)))


def reels_col(doc: Column, path: str = REELS_PATH) -> Column:
    """P5 as one expression: the parsed reels list, NULL when the document fails."""
    return unwrapped_col(doc, path).getField("reels")


def reels_rows(unwrapped: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """K6 content: one row per reel (``user``, ``items``) of an ``unwrap`` result."""
    ok = unwrapped.filter(F.col("unwrap_status") == UNWRAP_OK)
    return ok.select(*keep, F.explode("reels").alias("reel")).select(*keep, "reel.user", "reel.items")


def quarantine(unwrapped: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents that did not unwrap, with the reason."""
    return unwrapped.filter(F.col("unwrap_status") != UNWRAP_OK) \
        .select(*keep, F.col("unwrap_status").alias("reason"))


def reels_from_raw(raw: DataFrame, doc_col: str = "doc", keep: tuple[str, ...] = (),
                   path: str = REELS_PATH) -> DataFrame:
    """Reels rows straight from raw documents, parsing each document once.

    ``explode_outer`` + a NULL filter instead of ``explode``: a failed document
    (NULL list) and a NULL reel both yield nothing either way, but the outer
    form keeps the optimizer from inferring a ``size(from_json(...)) > 0``
    filter that would parse every document a second time.
    """
    reel = raw.select(*keep, F.explode_outer(reels_col(F.col(doc_col), path)).alias("reel"))
    return reel.filter(F.col("reel").isNotNull()).select(*keep, "reel.user", "reel.items")
