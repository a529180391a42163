"""Q6: roster preparation.

Two rosters with different columns are appended by name; only the second is
restricted to one network. The link column is then replaced by the profile
key; links too short to have one go to a quarantine instead of aborting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storylens.functions.strings import profile_key

REASON_SHORT_LINK = "short_or_missing_link"

# Fixed value: the network name a second roster is restricted to (exact case).
DEFAULT_NETWORK = "Instagram"


def network_rows(roster: DataFrame, network: str = DEFAULT_NETWORK, link_col: str = "LINK",
                 network_col: str = "Rede") -> DataFrame:
    """P1 + P2: keep the link and network columns, exact-case network match (NULL drops)."""
    return roster.select(link_col, network_col).filter(F.col(network_col) == F.lit(network))


def union_rosters(*rosters: DataFrame) -> DataFrame:
    """Append by column name; a column missing from one roster is NULL there."""
    out = rosters[0]
    for r in rosters[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out


def split_profiles(roster: DataFrame, link_col: str = "LINK",
                   strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return (profiles with key, quarantine with the original link and a reason).

    ``strict=True`` makes a bad link fail the job, as the original script did.
    """
    key = profile_key(F.col(link_col))
    if strict:
        key = F.when(key.isNull(), F.raise_error(
            F.concat(F.lit("no profile key in link: "),
                     F.coalesce(F.col(link_col).cast("string"), F.lit("NULL"))))).otherwise(key)
    tagged = roster.withColumn("__key", key)
    profiles = tagged.filter(F.col("__key").isNotNull()) \
        .withColumn(link_col, F.col("__key")).drop("__key")
    bad = tagged.filter(F.col("__key").isNull()).drop("__key") \
        .withColumn("reason", F.lit(REASON_SHORT_LINK))
    return profiles, bad


def prepare_roster(roster_a: DataFrame, roster_b: DataFrame, network: str = DEFAULT_NETWORK,
                   link_col: str = "LINK") -> tuple[DataFrame, DataFrame]:
    """Full Q6: (profiles, quarantine). ``profiles[link_col]`` holds usernames."""
    u = union_rosters(roster_a, network_rows(roster_b, network, link_col))
    return split_profiles(u, link_col)


def profile_count(profiles: DataFrame) -> DataFrame:
    """A2: number of profiles, duplicates counted."""
    return profiles.agg(F.count(F.lit(1)).alias("n_profiles"))
