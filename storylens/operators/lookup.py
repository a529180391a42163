"""Host -> retailer label, from rules in code or a rule table."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storylens.schemas import ORIGIN_RULES

# Host -> origin label rules, in the order the labelling was
# specified. Keys are exact, case-sensitive and disjoint.
ORIGIN_RULES_17 = (
    ("amzlink.to", "Amazon"),
    ("mercadolivre.com", "Mercado Livre"),
    ("mercadolivre.com.br", "Mercado Livre"),
    ("produto.mercadolivre.com.br", "Mercado Livre"),
    ("s.shopee.com.br", "Shopee"),
    ("minhaloja.natura.com", "Natura"),
    ("magazinevoce.com.br", "Magazine Luiza"),
    ("elausa.com.br", "Ela Usa"),
    ("epocacosmeticos.com.br", "Época Cosméticos"),
    ("natura.com.br", "Natura"),
    ("sminhaloja.natura.com", "Natura"),
    ("api.whatsapp.com", "WhatsApp"),
    ("google.com", "Google"),
    ("encurtador.com.br", "Encurtador"),
    ("tinyurl.com", "Encurtador"),
    ("br.shp.ee", "Shopee"),
    ("instagram.com", "Instagram"),
)

# The older 12-rule set used for provider exports (display hosts).
ORIGIN_RULES_12 = (
    ("amzlink.to", "Amazon"),
    ("mercadolivre.com", "Mercado Livre"),
    ("s.shopee.com.br", "Shopee"),
    ("minhaloja.natura.com", "Natura"),
    ("magazinevoce.com.br", "Magazine Luiza"),
    ("elausa.com.br", "Ela Usa"),
    ("epocacosmeticos.com.br", "Época Cosméticos"),
    ("natura.com.br", "Natura"),
    ("sminhaloja.natura.com", "Natura"),
    ("api.whatsapp.com", "WhatsApp"),
    ("google.com", "Google"),
    ("encurtador.com.br", "Encurtador"),
)

RuleSource = DataFrame | tuple | list


def origin_of(host: Column, rules: tuple | list = ORIGIN_RULES_17) -> Column:
    """F5 as an expression: label of ``host`` from in-code rules (NULL if none)."""
    keys = [h for h, _ in rules]
    if len(keys) != len(set(keys)):
        raise ValueError("origin rules must have unique hosts")
    m = F.create_map(*chain.from_iterable((F.lit(h), F.lit(o)) for h, o in rules))
    return F.element_at(m, host)


def rules_frame(spark: SparkSession, rules: RuleSource = ORIGIN_RULES_17) -> DataFrame:
    """Rule table as a DataFrame; Python pairs become a literal array expanded
    with ``inline`` on the JVM side (no Python worker needed to scan it)."""
    if isinstance(rules, DataFrame):
        return rules.select(F.col("host").cast("string"), F.col("origin").cast("string"),
                            *([F.col("position").cast("long")] if "position" in rules.columns else []))
    keys = [h for h, _ in rules]
    if len(keys) != len(set(keys)):
        raise ValueError("origin rules must have unique hosts")
    if not rules:
        return spark.createDataFrame([], ORIGIN_RULES)
    pairs = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(o).alias("origin")) for h, o in rules])
    return spark.range(1).select(F.inline(pairs))


def _first_wins(rules: DataFrame) -> DataFrame:
    """One label for each host, as a CASE has it: the rule of the lowest ``position``, else of the smallest label."""
    order = F.struct("position", "origin") if "position" in rules.columns else F.struct("origin")
    return rules.filter(F.col("host").isNotNull()).groupBy("host").agg(F.min_by("origin", order).alias("origin"))


def label_hosts(df: DataFrame, host_col: str = "host", rules: RuleSource = ORIGIN_RULES_17,
                origin_col: str = "origin", keep_unmatched: bool = True) -> DataFrame:
    """Add ``origin`` = label of ``host_col`` (NULL if no rule matches or host is NULL).

    Rules in code are a literal-map lookup in the same stage. A rule table is reduced to one
    label for each host (``position`` decides, if it has that column) and joined; the planner picks
    the join by the table's size. ``keep_unmatched=False`` drops rows without a label.
    """
    if not isinstance(rules, DataFrame):
        origin = origin_of(F.col(host_col), rules) if rules else F.lit(None).cast("string")
        out = df.withColumn(origin_col, origin)
        return out if keep_unmatched else out.filter(F.col(origin_col).isNotNull())
    r = _first_wins(rules_frame(df.sparkSession, rules)).withColumnRenamed("host", "__rule_host") \
        .withColumnRenamed("origin", "__rule_origin")
    joined = df.join(r, df[host_col] == r["__rule_host"], "left" if keep_unmatched else "inner")
    return joined.drop("__rule_host").withColumnRenamed("__rule_origin", origin_col)
