"""Exact top-k by inner product on a bit-sliced index.

Components are quantised to integers, floor(scale * x). The index holds, for a
block of vectors, one bitmap for each bit of each component. A query's scores
are the sum of the slices weighted by the bits of its own components (a
negative component takes the complement): bitmaps of one weight are added
three at a time into a sum and a carry, so that whole words of rows are added
at once. The result is one bitmap for each bit of the score. The top rows are
taken from the most significant slice downward: rows that are above what is
needed are in, those below are out. What stays undecided after the last slice
has equal scores and goes by the smaller id.

Queries travel to the blocks of the index, one copy for each, and stream past them; a
block returns k rows for each query, and the best k of those are ranked.

Vectors that are null or hold null or non-finite components take no part, nor
do rows of a null id. A shorter vector counts as padded with zeros. There are as many
slices as the largest component needs; scores must fit 64 bits, and vectors whose scores might
not raise a ValueError. Repeated rows of a query are one query; as
candidates they count each. All rows with a query's own id are left out of its
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storylens.llm.common import meet, ship_package, written

SCALE = 1024
#: Vectors in a block of the index.
ROWS = 8192


def quantised(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(vec_id, parts)``: vectors that take part, as integers."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    return (df.where(x.isNotNull() & F.col(id_col).isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("vec_id"), whole.cast("array<bigint>").alias("parts")))


def _matrix(parts: list[list[int]]) -> np.ndarray:
    width = max(map(len, parts), default=0)
    return np.array([p + [0] * (width - len(p)) for p in parts], np.int64).reshape(len(parts), width)


class Block:
    """Bit slices of some vectors."""

    def __init__(self, ids: np.ndarray, slices: np.ndarray, low: int):
        self.ids, self.slices, self.low = ids, slices, low

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> Block:
        low = int(vectors.min()) if vectors.size else 0
        if vectors.size and max(-low, int(vectors.max())) >= 1 << 61:
            raise ValueError("scores of these vectors may not fit 64 bits")
        above = vectors - low
        bits = max(int(above.max()).bit_length(), 1) if vectors.size else 1
        words = -(-len(ids) // 64)
        slices = np.zeros((vectors.shape[1], bits, words * 8), np.uint8)
        for b in range(bits):
            packed = np.packbits(((above >> b) & 1).astype(np.uint8).T, axis=1, bitorder="little")
            slices[:, b, :packed.shape[1]] = packed
        return cls(ids, slices.view(np.uint64), low)

    def sums(self, query: np.ndarray) -> tuple[list[np.ndarray | None], int]:
        """Bitmaps of the scores' bits from the least on, and what to add to each score."""
        n = min(len(query), len(self.slices))
        q, (bits, words) = query[:n], self.slices.shape[1:]
        slices = self.slices[:n].copy()
        slices[q < 0] = ~slices[q < 0]
        size = np.abs(q)
        most = (1 << bits) - 1
        # what the sums of slices can reach, and the score besides
        if n * (most + abs(self.low)) * int(size.max(initial=0)) >= 1 << 62 or size.min(initial=0) < 0:
            raise ValueError("scores of these vectors may not fit 64 bits")
        base = int((q[q > 0] * self.low).sum()) - int((size[q < 0] * (most + self.low)).sum())
        columns: list[list[np.ndarray]] = []
        for i in range(int(size.max()).bit_length() if n else 0):
            chosen = slices[(size >> i) & 1 == 1]
            columns += [[] for _ in range(i + bits - len(columns))]
            for b in range(bits):
                columns[i + b].append(chosen[:, b])
        out: list[np.ndarray | None] = []
        at = 0
        while at < len(columns):
            maps = np.concatenate(columns[at]) if columns[at] else np.zeros((0, words), np.uint64)
            while len(maps) > 1:
                t = max(len(maps) // 3, 1)
                a, b = maps[:t], maps[t:2 * t]
                c = maps[2 * t:3 * t] if len(maps) > 2 else np.zeros_like(a)
                if at + 1 == len(columns):
                    columns.append([])
                columns[at + 1].append((a & b) | (c & (a ^ b)))
                maps = np.concatenate((a ^ b ^ c, maps[3 * t:]))
            out.append(maps[0] if len(maps) else None)
            at += 1
        return out, base

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, ties by the smaller id."""
        sums, base = self.sums(query)
        words = self.slices.shape[2]
        valid = np.zeros(words * 8, np.uint8)
        packed = np.packbits(self.ids != query_id, bitorder="little")
        valid[:len(packed)] = packed
        sure, open_ = np.zeros(words, np.uint64), valid.view(np.uint64)
        for s in reversed(sums):
            above = open_ & s if s is not None else np.zeros(words, np.uint64)
            if _count(sure) + _count(above) > k:
                open_ = above
            else:
                sure, open_ = sure | above, open_ & ~above
        rows, ties = _rows(sure), _rows(open_)
        left = k - len(rows)
        if len(ties) > left:
            ties = ties[np.lexsort((ties, self.ids[ties]))[:left]]
        rows = np.concatenate((rows, ties))
        score = np.full(len(rows), base, np.int64)
        for b, s in enumerate(sums):
            if s is not None:
                score += ((s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << b
        return self.ids[rows], score


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


_INDEX = "block bigint, n int, width int, bits int, low bigint, ids binary, slices binary"


def index(vectors: DataFrame, rows: int = ROWS) -> DataFrame:
    """The bit-sliced index of ``(vec_id, parts)``: one row for each block."""
    ship_package(vectors.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        number, ids, parts = TaskContext.get().partitionId() << 32, [], []

        def made():
            b = Block.build(np.array(ids[:rows], np.int64), _matrix(parts[:rows]))
            return pa.RecordBatch.from_pydict({
                "block": pa.array([number], pa.int64()), "n": pa.array([len(b.ids)], pa.int32()),
                "width": pa.array([b.slices.shape[0]], pa.int32()), "bits": pa.array([b.slices.shape[1]], pa.int32()),
                "low": pa.array([b.low], pa.int64()), "ids": pa.array([b.ids.tobytes()], pa.binary()),
                "slices": pa.array([b.slices.tobytes()], pa.binary())})

        for b in batches:
            ids += b.column(0).to_pylist()
            parts += b.column(1).to_pylist()
            while len(ids) >= rows:
                yield made()
                number, ids, parts = number + 1, ids[rows:], parts[rows:]
        if ids:
            yield made()

    return written(vectors.mapInArrow(run, _INDEX), "bitsliced-index")


def search(queries: DataFrame, indexed: DataFrame, k: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows for each of ``(vec_id, parts)``."""
    queries = queries.select(F.col("vec_id").alias("query_id"), F.col("parts").alias("query")).distinct()

    def load(row):
        slices = np.frombuffer(row["slices"], np.uint64).reshape(row["width"], row["bits"], -(-row["n"] // 64))
        return Block(np.frombuffer(row["ids"], np.int64), slices, row["low"])

    def answer(block, row):
        ids, scores = block.top(row["query_id"], np.array(row["query"], np.int64), k)
        return [(row["query_id"], i, s) for i, s in zip(ids.tolist(), scores.tolist())]

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (meet(indexed, queries, load, answer, "query_id long, vec_id long, score long")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
