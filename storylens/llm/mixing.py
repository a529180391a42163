"""Mixing sources to target weights, by blocks of words.

Words of a source are packed into blocks of ``BLOCK`` words, document after
document. The mix has a quota of block slots for each source. For each output
shard the numbers of slots by source are drawn from a multinomial distribution
over what is left of the quotas, so that the totals meet them. A slot's running
number within its source goes through a pseudorandom permutation of the
source's block numbers (again for each round through them), and the slots are
joined with the blocks by that number. A block taken twice repeats its words.

Blocks are packed within chunks of a source, those of about ``CHUNK`` documents by
the hash of the document id, so that no task holds a whole source; the last
block of a chunk is shorter. Sources are ordered by code point, null last. The
table of sources, one row each, is configuration (each has a weight) and
passes through the driver; nothing else does, and more than ``SOURCES`` of them raise a ValueError.

Null and empty texts have no words and are never taken, but stand in the
result. A null source is a source. Repeated rows are packed one by one. Draws
and permutations depend on the seed and the input's rows alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storylens.llm.common import map_columns, partitions, ship_package, unused, written

BLOCK = 64
CHUNK = 1024
#: Slots made at once, and parts in which the rows of one id are numbered.
PIECE = 1 << 16
PARTS = 1 << 10
SHARDS = 64
SEED = 5
#: Sources at most: their table passes through the driver, and each gets a run of slots in each shard.
SOURCES = 10_000
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
WORD = r"[^\x20\x09-\x0D]+"


@dataclass
class Source:
    name: str | None
    place: int
    size: int
    rows: int
    weight: float
    target: float = 0.0
    blocks: int = 0
    slots: int = 0


def targets(sources: list[Source], share: float = SHARE, most: float = MOST) -> None:
    """Share ``share`` times all sizes by weight; nothing goes beyond ``most`` times a source's size.

    Sharing the excess again and again ends where each source has the smaller of its limit and its
    weight times a common level.
    """
    left = share * sum(s.size for s in sources)
    weight = sum(s.weight for s in sources)
    for s in sorted(sources, key=lambda s: (most * s.size / s.weight, s.place)):
        s.target = min(most * s.size, left * s.weight / weight) if weight > 0 else 0.0
        left -= s.target
        weight -= s.weight


def permuted(number: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n-1 at the given numbers: a Feistel network, walked until below n."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = np.asarray(number, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for turn in range(4):
            left, right = right, left ^ (_mixed(right, key * 4 + turn) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """64 well-mixed bits of each number and the key (the finaliser of splitmix64)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (key + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(slots: list[int], shards: int, seed: int) -> list[tuple[int, int, int, int]]:
    """``(shard, source, first slot number, slots)`` drawn for each shard, with totals as given."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left = np.array(slots, np.int64)
    first = np.zeros(len(left), np.int64)
    out = []
    for shard in range(shards):
        n = int(-(-left.sum() // (shards - shard)))
        drawn = np.zeros(len(left), np.int64)
        while n > 0:  # what a source has no slots left for is drawn again
            open_ = left - drawn
            more = np.minimum(rng.multinomial(n, open_ / open_.sum()), open_)
            drawn += more
            n -= int(more.sum())
        out += [(shard, s, int(first[s]), int(drawn[s])) for s in np.flatnonzero(drawn).tolist()]
        first += drawn
        left -= drawn
    return out


@dataclass
class Mix:
    """``rows``: doc_id, n (which of the rows of that id), source, size, place, chunk, start.
    ``slots``: shard, slot, place, block, round. ``segments``: the blocks' pieces of documents."""

    sources: list[Source]
    rows: DataFrame
    slots: DataFrame
    segments: DataFrame

    def mixed(self) -> DataFrame:
        """Blocks by index: the words ``first`` to ``last - 1`` of a document for each slot that takes them."""
        # the planner can't know how many slots there are: neither side may be broadcast
        return self.slots.hint("merge").join(self.segments, ["place", "block"])


def _number(doc_id: str, source: str, text_hash: str):
    """Tells rows of one id apart. They are numbered by parts, those of a hash of the text, so that an id of
    very many rows (the null one, say) spreads over as many tasks; rows alike in id, source and text are interchangeable."""
    part = F.pmod(F.col(text_hash), F.lit(PARTS))
    same = Window.partitionBy(F.col(doc_id).cast("long"), part).orderBy(source, text_hash)
    return F.row_number().over(same).cast("long") * PARTS + part


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
        block: int = BLOCK, shards: int = SHARDS, seed: int = SEED,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mix:
    spark = docs.sparkSession
    ship_package(spark)
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                        F.xxhash64(text_col).alias("hash"))
    sized = written(sized.withColumn("n", _number("doc_id", "source", "hash")).drop("hash"), "mixing-sizes")
    found = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).limit(SOURCES + 1).collect()
    if len(found) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources: the table of sources and weights passes through the driver")
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    sources = [Source(r.source, i, r["size"], r["rows"], float(weights[i % len(weights)])) for i, r in enumerate(found)]
    targets(sources, share, most)
    known = F.broadcast(spark.createDataFrame(
        [(s.name, s.place, -(-s.rows // CHUNK)) for s in sources], "name string, place int, chunks int"))
    order = Window.partitionBy("place", "chunk").orderBy("doc_id", "n")
    rows = (sized.join(known, sized.source.eqNullSafe(known.name))
            .withColumn("chunk", F.pmod(F.xxhash64("doc_id", "n"), F.col("chunks")).cast("int"))
            .withColumn("start", F.sum("size").over(order) - F.col("size"))
            .select("doc_id", "n", "source", "size", "place", "chunk", "start"))
    rows = written(rows, "mixing-rows")
    chunks = rows.groupBy("place", "chunk").agg(F.expr(f"(sum(size) + {block - 1}) div {block}").alias("blocks"))
    before = Window.partitionBy("place").orderBy("chunk")
    chunks = written(chunks.withColumn("before", F.sum("blocks").over(before) - F.col("blocks")), "mixing-chunks")
    for r in chunks.groupBy("place").agg(F.sum("blocks").alias("blocks")).collect():
        sources[r.place].blocks = r.blocks
    for s in sources:
        s.slots = min(round(s.target * s.blocks / s.size), int(most * s.blocks)) if s.size else 0

    segments = (rows.where("size > 0")
                .withColumn("own", F.explode(F.expr(
                    f"sequence(start div {block}, (start + size - 1) div {block})")))
                .join(chunks, ["place", "chunk"])
                .select("place", (F.col("before") + F.col("own")).alias("block"), "doc_id", "n",
                        F.greatest(F.col("own") * block - F.col("start"), F.lit(0)).alias("first"),
                        F.least((F.col("own") + 1) * block - F.col("start"), F.col("size")).alias("last"), "size"))
    return Mix(sources, rows, _slots(spark, sources, shards, seed), segments)


def _slots(spark, sources: list[Source], shards: int, seed: int) -> DataFrame:
    runs = draws([s.slots for s in sources], shards, seed) if sources else []
    totals: dict[int, int] = {}
    plan = []
    for shard, place, first, count in runs:
        plan.append((shard, place, first, count, totals.get(shard, 0), sources[place].blocks))
        totals[shard] = totals.get(shard, 0) + count
    plan = [(*p, totals[p[0]]) for p in plan]
    frame = spark.createDataFrame(plan, "shard int, place int, first long, count long, at long, blocks long, total long")

    def run(batches):
        for b in batches:
            for shard, place, first, count, at, blocks, total, piece in zip(*(c.to_pylist() for c in b.columns)):
                for k in range(piece * PIECE, min(count, (piece + 1) * PIECE), PIECE):
                    j = np.arange(k, min(count, k + PIECE))
                    number = first + j
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array(np.full(len(j), shard, np.int32)),
                        "slot": permuted(at + j, total, seed * 7919 + shard),
                        "place": pa.array(np.full(len(j), place, np.int32)),
                        "block": permuted(number % blocks, blocks, seed * 104729 + place * 31 + 1),
                        "round": pa.array((number // blocks).astype(np.int32))})

    # the runs of sources and shards in pieces, dealt out to as many tasks as they are worth; a number keeps them apart
    pieces = frame.where("count > 0").withColumn("piece", F.explode(F.expr(f"sequence(0, cast((count - 1) div {PIECE} as int))")))
    n = max(1, min(len(plan) + sum(p[3] for p in plan) // PIECE, partitions(spark)))
    return pieces.repartition(n, "shard", "place", "piece").mapInArrow(run, "shard int, slot long, place int, block long, round int")


def taken(m: Mix) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for each row of the input."""
    spark = m.rows.sparkSession
    counted = m.mixed().select("doc_id", "n", (F.col("last") - F.col("first")).alias("taken"))
    keys = ["doc_id", "n"]
    everyone = m.rows.select(*keys, "place", "size", F.lit(0).cast("long").alias("taken"))
    both = everyone.unionByName(counted, allowMissingColumns=True)
    sums = both.groupBy(*keys).agg(F.max("place").alias("place"), F.max("size").alias("size"), F.sum("taken").alias("taken"))
    known = F.broadcast(spark.createDataFrame(
        [(s.place, s.size, s.target) for s in m.sources], "place int, source_size long, target double"))
    return sums.join(known, "place").select("doc_id", "size", "source_size", "target", "taken")


def documents_of(m: Mix, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source") -> DataFrame:
    """The mix as documents: for each round that takes of a row, the row with the words taken.

    A row that is taken whole keeps its text; of others the words stay in order, joined by spaces.
    """
    doc_id, number, turn, size, hash_, cuts = unused(docs, "_mix_doc_id", "_mix_n", "_mix_round", "_mix_size", "_mix_hash", "_mix_cuts")
    picked = (m.mixed().groupBy(F.col("doc_id").alias(doc_id), F.col("n").alias(number), F.col("round").alias(turn), F.col("size").alias(size))
              .agg(F.sort_array(F.collect_list(F.struct(
                  F.col("first").cast("int").alias("first"), F.col("last").cast("int").alias("last")))).alias(cuts)))
    # the rows of one id get the numbers that they had
    named = docs.withColumn(hash_, F.xxhash64(text_col))
    own, = unused(named, "_mix_number")
    rows = named.withColumn(own, _number(id_col, source_col, hash_))
    rows = rows.join(picked, F.col(id_col).cast("long").eqNullSafe(F.col(doc_id)) & (F.col(own) == F.col(number)))

    def make():
        def run(texts, every, sizes):
            out = []
            for t, c, n in zip(texts, every, sizes):
                if sum(x["last"] - x["first"] for x in c) < n:
                    own = t.encode("utf-8").split()  # at the same white space as WORD
                    t = b" ".join(b" ".join(own[x["first"]:x["last"]]) for x in c).decode("utf-8")
                out.append(t)
            return [out]
        return run

    columns = list(docs.columns)
    rows = map_columns(rows.select(*columns, cuts, size), [text_col, cuts, size], f"`{text_col}` string", make)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)
