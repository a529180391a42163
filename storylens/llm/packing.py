"""Token rows of one length: best-fit-decreasing packing with a segment tree over capacities.

Documents longer than a row are split into parts without loss. Parts are dealt
out by a seeded hash; each task packs groups of ``GROUP`` of them: from the longest on, a part goes to the
row with the least room that still holds it, found in a segment tree that
counts the rows of each remaining capacity. A packed row has its ids, padded, the
cumulative lengths of its segments and the position of each token in its segment.

A null or empty text has no tokens and no part. Repeated rows are packed one by
one, null ids too. Columns other than id and ids are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storylens.llm.common import partitions, ship_package

ROW = 2048
GROUP = 4096
SEED = 4
PAD = 0

_PACKED = ("row bigint, n_tokens int, doc_ids array<bigint>, parts array<int>, cu_seqlens array<int>, "
           "ids binary, positions binary")


class Capacities:
    """Numbers of rows by remaining capacity, 0 to ``most``; finds the least capacity that suffices."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        at = capacity + self.leaves
        while at:
            self.tree[at] += n
            at >>= 1

    def at_least(self, need: int) -> int | None:
        at = need + self.leaves
        if not self.tree[at]:
            while at > 1 and (at & 1 or not self.tree[at + 1]):  # up, until something stands to the right
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        return at - self.leaves


def pack(lengths: list[int], row: int = ROW) -> list[list[int]]:
    """Rows of part numbers, best fit from the longest part on."""
    free, open_, rows = Capacities(row), {}, []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        room = free.at_least(lengths[i])
        if room is None:
            rows.append([])
            at, room = len(rows) - 1, row
        else:
            at = open_[room].pop()
            free.add(room, -1)
        rows[at].append(i)
        open_.setdefault(room - lengths[i], []).append(at)
        free.add(room - lengths[i], 1)
    return rows


def packed(encoded: DataFrame, row: int = ROW, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Packed rows of documents with packed ids (little-endian unsigned 32-bit integers)."""
    ship_package(encoded.sparkSession)
    n = partitions(encoded.sparkSession)
    bytes_ = 4 * row
    parts = (encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
             .where(F.length("ids") > 0)
             .withColumn("part", F.explode(F.expr(f"sequence(0, cast((length(ids) - 1) div {bytes_} as int))")))
             .select("doc_id", "part", F.expr(f"substring(ids, part * {bytes_} + 1, {bytes_})").alias("ids")))
    # rows that are alike in all else spread by their running numbers
    dealt = parts.withColumn("_row", F.monotonically_increasing_id()) \
        .repartition(n, F.xxhash64("doc_id", "part", "_row", F.lit(SEED))) \
        .sortWithinPartitions(F.xxhash64("doc_id", "part", F.lit(SEED)), "doc_id", "part", F.xxhash64("ids")) \
        .select("doc_id", "part", "ids")
    types = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary())
    names = ("row", "n_tokens", "doc_ids", "parts", "cu_seqlens", "ids", "positions")

    def run(batches):
        from pyspark import TaskContext

        number, doc, part, ids = TaskContext.get().partitionId() << 33, [], [], []
        every = np.arange(row, dtype="<u4")

        def made(n):
            nonlocal number
            out = []
            for own in pack([len(x) for x in ids[:n]], row):
                sizes = [len(ids[i]) for i in own]
                left = row - sum(sizes)
                out.append((number, row - left, [doc[i] for i in own], [part[i] for i in own], np.cumsum([0, *sizes]).tolist(),
                            b"".join([*(ids[i].tobytes() for i in own), PAD.to_bytes(4, "little") * left]),
                            b"".join([*(every[:k].tobytes() for k in sizes), bytes(4 * left)])))
                number += 1
            del doc[:n], part[:n], ids[:n]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        # groups go on over the borders of Arrow batches
        for b in batches:
            doc += b.column(0).to_pylist()
            part += b.column(1).to_pylist()
            ids += [np.frombuffer(x, "<u4") for x in b.column(2).to_pylist()]
            while len(ids) >= GROUP:
                yield made(GROUP)
        if ids:
            yield made(len(ids))

    return dealt.mapInArrow(run, _PACKED)


def write(rows: DataFrame, path: str) -> DataFrame:
    """Write packed rows as Parquet and return them as read back: a matrix row of ids and positions, and the cumulative lengths."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
