"""SQL surface (X2, X3): the same functions as temporary SQL functions, and Q1
as one parameterised SQL string over a raw-document view.

For users who keep their queries as SQL text. The SQL functions are
expressions, not Python: Spark inlines them into the plan. They restate the
Column functions in SQL; ``tests/test_sql.py`` checks both give the same
values on random inputs.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from storylens.functions.jsonpath import END, REELS_PATH
from storylens.operators.lookup import ORIGIN_RULES_12, ORIGIN_RULES_17
from storylens.schemas import REELS

PREFIX = "storylens_"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _map(rules) -> str:
    return "map(" + ", ".join(f"{_lit(h)}, {_lit(o)}" for h, o in rules) + ")"


def _piece(expr: str, sep: str, n: int) -> str:
    """1-based piece of a literal split, NULL out of range (as ``split_get``)."""
    return f"get(split({expr}, {_lit(chr(92) + 'Q' + sep + chr(92) + 'E')}, -1), {n - 1})"


def _bound(value: str, name: str, then: str) -> str:
    """``then``, where ``name`` is the value, computed once."""
    return f"get(transform(array({value}), {name} -> {then}), 0)"


def _reels_body(doc: str) -> str:
    """P5 and P6 as ``operators.unwrap.unwrapped_col`` has them: a document is one whole JSON value, parsed once."""
    kind, one = _lit(REELS.simpleString()), _lit(REELS.elementType.simpleString())
    end = json.loads(END)
    closed, path = f"concat('[', {doc}, ',{END}]')", _lit("$[0]" + REELS_PATH[1:])
    found = (f"coalesce(try_variant_get(v, {path}, {kind}), "
             f"CASE WHEN try_variant_get(v, {path}, 'string') IS NULL THEN try_variant_get(v, '$[0]', {kind}) END, "
             f"CASE WHEN try_variant_get(v, {path}, {one}) IS NOT NULL THEN array(try_variant_get(v, {path}, {one})) END)")
    text = _bound(f"from_json({closed}, 'array<string>')", "x", f"CASE WHEN size(x) = 2 AND get(x, 1) = {_lit(END)} THEN get(x, 0) END")
    listed = f"coalesce(get_json_object(t, {_lit(REELS_PATH)}), CASE WHEN startswith(ltrim(t), '[') THEN t END)"
    refused = _bound(text, "t", f"from_json({listed}, {kind})")
    whole = f"coalesce(try_variant_get(v, '$[1].{next(iter(end))}', 'boolean'), false)"
    return _bound(f"try_parse_json({closed})", "v", f"CASE WHEN {whole} THEN {found} ELSE {refused} END")


FUNCTIONS = {
    "redirect_host": ("url STRING", "STRING",
                      f"replace({_piece(_piece('url', 'u=', 2), '%2F', 3)}, 'www.', '')"),
    "display_host": ("display_url STRING", "STRING", _piece("display_url", "/", 1)),
    "profile_key": ("link STRING", "STRING", "get(split(link, '/', -1), 3)"),
    "origin": ("host STRING", "STRING", f"element_at({_map(ORIGIN_RULES_17)}, host)"),
    "origin12": ("host STRING", "STRING", f"element_at({_map(ORIGIN_RULES_12)}, host)"),
    "reels": ("doc STRING", REELS.simpleString(), _reels_body("doc")),
}


def register_sql_functions(spark: SparkSession, prefix: str = PREFIX) -> list[str]:
    """Create (or replace) the temporary SQL functions; returns their names."""
    names = []
    for name, (params, returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({params}) "
                  f"RETURNS {returns} RETURN {body}")
        names.append(prefix + name)
    return names


# Q1 as SQL over a view of raw documents ``(…, doc)``; ``:run_date`` is bound at
# run time. SQL functions may not appear inside a generator, so each value is
# computed in a projection and exploded in the next step; the label goes
# through a one-element explode so the NULL filter cannot be pushed below it.
DAILY_ATTRIBUTION_SQL = """
WITH parsed AS (
  SELECT {p}reels(doc) AS reels FROM {{raw}}
), reels AS (
  SELECT explode_outer(reels) AS reel FROM parsed
), items AS (
  SELECT reel.user.username AS username, explode(reel.items) AS item
  FROM reels WHERE reel IS NOT NULL
), stickers AS (
  SELECT username, explode(item.story_link_stickers) AS sticker FROM items
), labels AS (
  SELECT username, {p}origin({p}redirect_host(sticker.story_link.url)) AS label FROM stickers
), labelled AS (
  SELECT username, explode_outer(array(label)) AS origin FROM labels
)
SELECT DISTINCT username, origin, CAST(:run_date AS DATE) AS date
FROM labelled WHERE origin IS NOT NULL
""".format(p=PREFIX)


def daily_attribution_sql(spark: SparkSession, raw: DataFrame, run_date: str) -> DataFrame:
    """Run :data:`DAILY_ATTRIBUTION_SQL` on ``raw`` with ``run_date`` bound."""
    register_sql_functions(spark)
    return spark.sql(DAILY_ATTRIBUTION_SQL, args={"run_date": run_date}, raw=raw)
