"""Sharding by a two-pass external shuffle, in DataFrame functions alone.

The first pass scatters the records into buckets by seeded hashes of their ids:
the shard is the one whose hash with the id is largest, so a further shard
takes records only into itself; each shard has as many buckets as keep one at
about ``BUCKET`` bytes. The second pass shuffles each bucket in memory
(``shuffle`` is a Fisher-Yates shuffle) and writes it to its shard's folder.

A null text has no bytes and a null id hashes like an id of its own; repeated rows
are records of their own, in the shard of their id. Any other columns are
written along; ``shard``, ``bucket`` and ``slot`` are the operator's, and input
columns of these names are replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storylens.llm.common import partitions
from storylens.session import scratch_path

SHARDS = 40
SEED = 8
#: Bytes of a bucket, about.
BUCKET = 4 << 20
#: Bytes that a record counts besides its text.
OVERHEAD = 16


def size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def _best(doc_id: Column, shards: int, seed: int) -> Column:
    draws = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                        lambda i: F.struct(F.xxhash64(doc_id, F.lit(seed), i).alias("draw"), i.alias("shard")))
    return F.array_max(draws)


def shard_of(doc_id: Column, shards: int = SHARDS, seed: int = SEED) -> Column:
    """The shard of an id among ``shards``: id and number decide."""
    return _best(doc_id, shards, seed)["shard"]


def write(docs: DataFrame, path: str | None = None, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shuffled shards and return them as read back, with ``slot``: the place in the shard, from 0."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, f"shards-{uuid.uuid4().hex}")
    own = [c for c in docs.columns if c not in ("shard", "bucket", "slot")]
    total = docs.agg(F.sum(size(F.col(text_col)))).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    n = max(partitions(spark), -(-total // (32 * bucket_bytes)))
    # an id that many rows share still spreads over its shard's buckets
    scattered = docs.select(*own).withColumns({
        "shard": shard_of(F.col(id_col), shards, seed),
        "bucket": F.pmod(F.xxhash64(id_col, text_col, F.lit(seed + 1)), F.lit(buckets)).cast("int")})
    counts = scattered.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("rows")
    # partitioned as the buckets are, so that these stay where they are for the join
    first = counts.select("shard", "bucket", before.alias("first")).repartition(n, "shard", "bucket").hint("merge")
    # a bucket's records in one order, so that the seed decides their places
    order = F.struct(F.xxhash64(id_col, F.lit(seed + 2)).alias("_order"), *own)
    gathered = (scattered.repartition(n, "shard", "bucket").groupBy("shard", "bucket")
                .agg(F.sort_array(F.collect_list(order)).alias("rows")).join(first, ["shard", "bucket"])
                .sortWithinPartitions("shard", "bucket"))
    shuffled = gathered.select("shard", "bucket", "first", F.posexplode(F.shuffle("rows", seed)).alias("place", "row"))
    written = shuffled.select("shard", "bucket", (F.col("first") + F.col("place")).alias("slot"),
                              *(F.col("row")[c].alias(c) for c in own))
    written.write.partitionBy("shard").parquet(path)
    schema = written.select(*(c for c in written.columns if c != "shard"), "shard").schema
    return spark.read.schema(schema).parquet(path).select(*own, "shard", "bucket", "slot")


def grown_shard(doc_id: Column, shard: Column, shards: int = SHARDS, seed: int = SEED) -> Column:
    """The shard of an id if there is one more."""
    new = F.xxhash64(doc_id, F.lit(seed), F.lit(shards))
    return F.when(new > _best(doc_id, shards, seed)["draw"], F.lit(shards)).otherwise(shard).cast("int")
