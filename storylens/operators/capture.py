"""Q5: capture log -> documents -> outcome per profile.

The browser log of each profile visit is stored as a table
``(username, seq, message)``; response bodies as
``(username, request_id, body, base64_encoded)``. The first matching
response in log order decides the outcome, even if its body later fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylens.functions.binary import body_text
from storylens.functions.jsonpath import STORY_MARKER, bind, embedded_require_document
from storylens.operators.picks import first_per_key, last_per_key
from storylens.schemas import LOG_MESSAGE

# Fixed values of the capture protocol.
RESPONSE_RECEIVED = "Network.responseReceived"
ENDPOINT_SUFFIX = "/?r="

CAPTURED = "captured"
PAYLOAD_NOT_FOUND = "payload_not_found"
BODY_ERROR = "body_error"
NOT_AVAILABLE = "not_available"
PAGE_ERROR = "page_error"


VISIT = ("username",)


def parse_log(log: DataFrame, keys: tuple[str, ...] = VISIT) -> DataFrame:
    """S6 + F10: ``message`` JSON text parsed; malformed entries give NULL fields.

    The parse is the input of a one-element generator, so filters on the
    parsed fields stay above it instead of re-parsing every message.
    """
    parsed = log.select(*keys, "seq", F.explode_outer(
        F.array(F.from_json("message", LOG_MESSAGE).getField("message"))).alias("__m"))
    m = F.col("__m")
    return parsed.select(
        *keys, "seq",
        F.coalesce(m.getField("method"), F.lit("")).alias("method"),
        m.getField("params").getField("requestId").alias("request_id"),
        m.getField("params").getField("response").getField("url").alias("url"))


def matching_responses(log: DataFrame, exact: bool = False,
                       keys: tuple[str, ...] = VISIT) -> DataFrame:
    """P8 + P9: response events whose url contains ``<username>/?r=``.

    The match is a literal substring, so ``ana`` also matches ``…/joana/?r=``;
    ``exact=True`` requires a ``/`` before the username.
    """
    # Cheap byte search before the parse: a response event names its method
    # literally, unless the text spells it with \u escapes (always parsed).
    msg = F.col("message")
    candidates = log.filter(msg.contains(RESPONSE_RECEIVED) | msg.contains("\\u"))
    p = parse_log(candidates, keys)
    key = F.concat(F.lit("/") if exact else F.lit(""), F.col("username"), F.lit(ENDPOINT_SUFFIX))
    return p.filter((F.col("method") == RESPONSE_RECEIVED)
                    & F.col("url").contains(key)
                    & F.col("request_id").isNotNull())


def first_matches(log: DataFrame, exact: bool = False, keys: tuple[str, ...] = VISIT) -> DataFrame:
    """The first matching response per visit by ``seq``.

    A visit is one profile page load; ``keys`` names it (``username`` when the
    log holds one run, e.g. ``("run_date", "username")`` when it holds many).
    """
    return first_per_key(matching_responses(log, exact, keys), list(keys), "seq", ["seq", "request_id"])


def capture_outcomes(profiles: DataFrame, log: DataFrame, bodies: DataFrame,
                     page_errors: DataFrame | None = None, exact: bool = False,
                     marker: str = STORY_MARKER, keys: tuple[str, ...] = VISIT, clustered: bool = False) -> DataFrame:
    """``keys…, status, seq, doc`` per profile row (duplicates kept).

    ``clustered`` says that ``bodies`` is a table bucketed by the visit keys (``store_bodies``): bodies meet
    the visits where they lie, and neither they nor the documents move. Without it bodies are
    joined by visit and request, which may split a visit of very many bodies.

    ``profiles``, ``bodies`` and ``page_errors`` carry the visit ``keys``
    (``username`` by default). ``page_errors`` (optional) lists visits whose
    page load itself failed. ``doc`` is the ``{"require": …}`` document of
    captured visits.
    """
    k = list(keys)
    matches = first_matches(log, exact, keys)
    # Only bodies that some visit picked are parsed and go further: a sort-merge join, whose
    # sides may spill and whose body side the runtime join filter thins out before it moves.
    b = bodies.select(*k, "request_id", "body", "base64_encoded")
    if clustered:
        picked = matches.withColumnRenamed("request_id", "__picked").hint("merge")
        # a condition beside the join's keys: as one of them it would have the bodies move to it
        met = b.join(picked, k).where((F.col("request_id") == F.col("__picked")).eqNullSafe(F.lit(True)))
    else:
        met = b.join(matches.hint("merge"), [*k, "request_id"])
    fetched = met.select(
        *k, "seq", F.explode_outer(F.array(_outcome_of(marker))).alias("__o"))
    # bodies stored more than once for a request count once: the best outcome, then the smallest document
    best = fetched.groupBy(*k).agg(F.min(F.struct(
        F.col("__o.rank").alias("rank"), F.col("__o.doc").alias("doc"))).alias("__best"))
    decided = matches.join(best.hint("merge"), k, "left").select(
        *k, "seq", F.lit(True).alias("__matched"),
        F.when(F.col("__best.rank") == 0, F.lit(CAPTURED)).when(F.col("__best.rank") == 1, F.lit(PAYLOAD_NOT_FOUND))
         .otherwise(F.lit(BODY_ERROR)).alias("__status"), F.col("__best.doc").alias("doc"))
    # documents stay where their visit is: the profiles come to them
    out = profiles.select(*k).join(decided.hint("merge"), k, "left")
    status = F.when(F.col("__matched").isNull(), F.lit(NOT_AVAILABLE)).otherwise(F.col("__status"))
    if page_errors is not None:
        errs = page_errors.select(*k).distinct().withColumn("__page_error", F.lit(True))
        out = out.join(errs, k, "left")
        status = F.when(F.col("__page_error"), F.lit(PAGE_ERROR)).otherwise(status)
    return out.select(*k, status.alias("status"),
                      F.when(status == CAPTURED, F.col("seq")).alias("seq"),
                      F.when(status == CAPTURED, F.col("doc")).alias("doc"))


def _outcome_of(marker: str) -> Column:
    """``struct<rank, doc>`` of a response body: 0 captured, 1 without payload, 2 undecodable. One decode, one parse."""
    text = body_text(F.col("body"), F.col("base64_encoded"))
    return bind(text, lambda t: bind(embedded_require_document(t, marker), lambda d: F.struct(
        F.when(t.isNull(), F.lit(2)).when(d.isNull(), F.lit(1)).otherwise(F.lit(0)).alias("rank"), d.alias("doc"))))


def latest_success(captures: DataFrame, status_col: str = "status",
                   cols: tuple[str, ...] = ("doc",), keys: tuple[str, ...] = VISIT) -> DataFrame:
    """K3 / U4: per profile (``keys``) the last successful capture by ``seq`` (last write wins)."""
    ok = captures.filter(F.col(status_col) == CAPTURED)
    return last_per_key(ok, list(keys), "seq", ["seq", *cols])
