"""SimHash near-duplicates: a byte-position inverted index with count filtering.

A fingerprint has one bit for each of 64 places: set if more than half of the
document's shingle hashes have it. Fingerprints of at most four differing
bits differ in at most four of their eight bytes, so they share at least four
positional bytes: the guaranteed number of matches. The index posts each
distinct fingerprint under sets of three positions with their bytes. The 20
sets come from Turan's construction: any four of eight positions hold one of
them, so no pair with four shared bytes is missed. Pairs that meet in a
posting list are tallied (shared positional bytes), those below the minimum
dropped, and the rest verified by their differing bits.

Only a spanning forest of the links leaves a posting list: the components of
all links are those of the forests. A list longer than ``LIST`` is posted anew
with one more position, which again loses no pair with four shared bytes. What is
still longer is linked through midpoints: two fingerprints four bits apart
have a common neighbour at most two bits from both.

A null text counts as empty. Documents without a word have fingerprint 0 and
link like any other. Rows with the same document id and text repeat in the
output; rows of null id take part and may only give a component its id if it
has no other. Columns other than id and text are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storylens.llm.common import documents, map_columns, partitions, ship_package, unused, written
from storylens.llm.components import components

SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: Bytes that fingerprints of at most MAX_BITS differing bits share, of eight.
MIN_SHARED = 8 - MAX_BITS
#: Fingerprints in a posting list that are compared with one another at once.
LIST = 2048


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of the shingles of a whole text, repeats included, as an unsigned number."""
    # bytes.lower changes A-Z only, bytes.split cuts at \x20 and \x09-\x0D
    words = text.encode("utf-8").lower().split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:n - 1].tolist()]
    digest = xxhash.xxh64_intdigest
    votes, done = np.zeros(64, np.int64), 0
    ends = (ends[shingle - 1:] - 1).tolist()
    for k in range(0, n, 1 << 16):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[k:k + (1 << 16)], ends[k:k + (1 << 16)])]
        done += len(hashes)
        votes += np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > done).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, text, fp)``: the fingerprint as a signed 64-bit number with the same bits."""

    def make():
        return lambda texts: [np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)]

    return map_columns(documents(df, id_col, text_col), ["text"], "fp bigint", make)


def position_sets() -> list[tuple[int, ...]]:
    """Sets of three of eight positions of which any four positions contain one (Turan's construction)."""
    parts = [range(0, 3), range(3, 6), range(6, 8)]
    sets = [c for p in parts for c in combinations(p, 3)]
    for i, p in enumerate(parts):
        sets += [(*two, one) for two in combinations(p, 2) for one in parts[(i + 1) % 3]]
    return [tuple(sorted(s)) for s in sets]


def _mask(positions) -> int:
    bits = sum(0xFF << (8 * p) for p in positions)
    return bits - (1 << 64) if bits >> 63 else bits


def _postings(fps: DataFrame) -> DataFrame:
    masks = F.array(*(F.lit(_mask(s)).cast("long") for s in position_sets()))
    return (fps.select("fp", F.explode(masks).alias("mask"))
            .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bytes"), "fp"))


def _longer_postings(lists: DataFrame) -> DataFrame:
    """One more position in each key."""
    more = F.array(*(F.lit(_mask([p])).cast("long") for p in range(8)))
    return (lists.select("fp", "mask", F.explode(more).alias("more"))
            .where(F.col("mask").bitwiseAND(F.col("more")) == 0)
            .select(F.col("mask").bitwiseOR(F.col("more")).alias("mask"), "fp")
            .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bytes"), "fp").distinct())


def linked(fps: np.ndarray, max_bits: int = MAX_BITS, min_shared: int = MIN_SHARED) -> np.ndarray:
    """Edges of a spanning forest of all links among distinct fingerprints (unsigned)."""
    n = len(fps)
    root = np.arange(n)
    edges = []
    octets = np.ascontiguousarray(fps).view(np.uint8).reshape(n, 8)
    for i in range(n - 1):
        shared = (octets[i + 1:] == octets[i]).sum(1)
        j = i + 1 + np.flatnonzero(shared >= min_shared)
        j = j[np.bitwise_count(fps[j] ^ fps[i]) <= max_bits]
        for k in j[root[j] != root[i]]:
            if root[k] != root[i]:
                edges.append((i, k))
                root[root == root[k]] = root[i]
    return np.array(edges, np.int64).reshape(-1, 2)


def _within_lists(postings: DataFrame) -> DataFrame:
    """``(mask, a, b)``: links inside posting lists; for the members of a list that is too long, b is null."""
    ship_package(postings.sparkSession)
    n = partitions(postings.sparkSession)

    def run(batches):
        rest = None
        for b in batches:
            now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            mask, key, fp = now
            if not len(fp):
                continue
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            last = cuts[-1] if len(cuts) else 0
            yield from _links(mask[:last], fp[:last], np.concatenate(([0], cuts)) if len(cuts) else cuts)
            rest = [x[last:] for x in now]
            if len(rest[2]) > 64 * LIST:  # of a list that long the members are told piece by piece
                yield _rows(rest[0][LIST + 1:], rest[2][LIST + 1:], None)
                rest = [x[:LIST + 1] for x in rest]
        if rest is not None and len(rest[2]):
            yield from _links(rest[0], rest[2], np.array([0, len(rest[2])]))

    ordered = postings.repartition(n, "mask", "bytes").sortWithinPartitions("mask", "bytes", "fp")
    return ordered.mapInArrow(run, "mask bigint, a bigint, b bigint")


def _rows(mask, a, b):
    b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(mask, pa.int64()), pa.array(a, pa.int64()), b], ["mask", "a", "b"])


def _links(mask, fp, cuts):
    out_a, out_b, out_mask = [], [], []
    sizes = np.diff(cuts)
    for k in np.flatnonzero(sizes > 1):
        s, e = cuts[k], cuts[k + 1]
        if e - s > LIST:
            yield _rows(mask[s:e], fp[s:e], None)
        else:
            own = fp[s:e]
            edges = linked(own.view(np.uint64))
            out_a.append(own[edges[:, 0]]), out_b.append(own[edges[:, 1]]), out_mask.append(mask[s:s + len(edges)])
    if out_a:
        yield _rows(np.concatenate(out_mask), np.concatenate(out_a), np.concatenate(out_b))


def _midpoints(fps: DataFrame) -> DataFrame:
    """Links by common neighbours: all that are at most two bits from one point are linked in a star."""
    ones = [1 << i for i in range(64)]
    flips = [0, *ones, *(x | y for x, y in combinations(ones, 2))]
    signed = F.array(*(F.lit(x - (1 << 64) if x >> 63 else x).cast("long") for x in flips))
    near = fps.select("fp", F.explode(signed).alias("flip")).select(F.col("fp").bitwiseXOR("flip").alias("mid"), "fp")
    stars = near.groupBy("mid").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    return near.join(stars, "mid").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def links(fps: DataFrame) -> DataFrame:
    """``(a, b)`` over distinct fingerprints ``fp``: links with the same components as all links."""
    found = written(_within_lists(_postings(fps)), "simhash-links")
    edges = found.where("b is not null").select("a", "b")
    long = found.where("b is null").select(F.col("a").alias("fp"), "mask").distinct()
    if long.isEmpty():
        return edges
    again = written(_within_lists(_longer_postings(long)), "simhash-links")
    edges = edges.unionByName(again.where("b is not null").select("a", "b"))
    long = again.where("b is null").select(F.col("a").alias("fp")).distinct()
    return edges if long.isEmpty() else edges.unionByName(_midpoints(long))


def _roots(distinct: DataFrame) -> DataFrame:
    """Each of the distinct fingerprints ``fp`` with the smallest one that links lead to."""
    nodes = components(links(distinct.select("fp")), "simhash-components")
    return distinct.join(nodes, distinct.fp == nodes.node, "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row for each row of ``df``."""
    own = written(fingerprints(df, id_col, text_col).select("doc_id", "fp"), "simhash-fingerprints")
    grouped = _roots(written(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct"))
    ids = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = grouped.join(ids, "root").select("fp", "component_id")
    return own.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: that of the smallest id (null last), of equal ids the one of the smaller text hash."""
    def row(i, t):  # two hashes of id and text name a row
        return (F.struct(F.col(i).isNull().alias("none"), F.col(i).cast("long").alias("id"),
                         F.xxhash64(t, i).alias("a"), F.xxhash64(i, t, F.lit(1)).alias("b")))

    own = fingerprints(df, id_col, text_col)
    least = own.groupBy("fp").agg(F.min(row("doc_id", "text")).alias("row"))
    grouped = _roots(written(least, "simhash-distinct"))
    text, number, a, b = unused(df, "_simhash_text", "_simhash_id", "_simhash_a", "_simhash_b")
    chosen = grouped.groupBy("root").agg(F.min("row").alias("row")).select(F.col("row.a").alias(a), F.col("row.b").alias(b))
    named = df.withColumns({text: F.coalesce(F.col(text_col), F.lit("")), number: F.col(id_col).cast("long")})
    keys = row(number, text)
    named = named.withColumns({a: keys["a"], b: keys["b"]})
    return named.join(chosen, [a, b], "left_semi").dropDuplicates([a, b]).select(*df.columns)
