"""Hard negatives by an inverted multi-index.

A vector is cut into two halves, and each half has a codebook of its own; a
cell of the index is a pair of codes. For a query the halves' scores against
the codes are bounded by the score of the code's centre plus the query's length
times the code's radius. A heap visits cells in the order of the summed bounds
(multi-sequence: of a cell visited, its successors in either codebook come in).
The positives of an anchor are certain once the last of them scores more than
the next cell's bound. A positive opens a window of scores for negatives; a
window is certified once it is full and its last negative scores more than the
next cell's bound, or once that bound is below the window. So the result is
exact, whatever the codebooks.

Codebooks are fitted on a bounded sample (``SAMPLE`` vectors, about); every vector is
indexed. The index is cut into blocks of at most ``ROWS`` vectors. Queries
travel to the blocks, one copy for each, and stream past the block in its task;
what comes back is a handful of rows for each query and block.

Scores are inner products of whole numbers and must fit 64 bits; vectors whose
products might not raise a ValueError. Rows of a null id, a null label, a null
vector or any null or non-finite component take no part. A shorter vector counts as
padded with zeros, an empty one scores 0. Rows of the anchor's own id are left out of its
results. Repeated rows of an anchor are one anchor; as candidates they count each, ties
in any order among them. Without other rows of its label an anchor has no result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storylens.llm.common import hash_bound, meet, partitions, ship_package, written

SCALE = 256
CODES = 32
SAMPLE = 16_384
ROUNDS = 8
SEED = 11
#: Vectors in a block at most, and (of few vectors) at least.
ROWS, FEW = 65_536, 2_048
#: Rows scored at once.
STEP = 256

POSITIVES = 5
NEGATIVES = 10
#: Hundredths of a positive's score between which a hard negative's score lies.
LOW, HIGH = 30, 90


def quantised(df: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
              scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, parts)`` of rows that take part: components as floor(scale * x)."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))
    return (df.where(x.isNotNull() & F.col(id_col).isNotNull() & label.isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                    F.transform(x, lambda v: F.floor(v.cast("double") * scale)).cast("array<bigint>").alias("parts")))


def matrix(parts: list[list[int]], width: int) -> np.ndarray:
    return np.array([p + [0] * (width - len(p)) for p in parts], np.int64).reshape(len(parts), width)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(1) - 2 * (x @ centres.T), axis=1)


def codebook(x: np.ndarray, codes: int = CODES, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Centres of some vectors by Lloyd's rounds from a seeded draw; one centre of zeros if there are none."""
    x = np.unique(x.astype(float), axis=0)
    if not len(x):
        return np.zeros((1, x.shape[1]))
    centres = x[np.sort(np.random.default_rng(seed).choice(len(x), min(codes, len(x)), replace=False))]
    for _ in range(rounds):
        own = _nearest(x, centres)
        centres = np.array([x[own == k].mean(0) if (own == k).any() else centres[k] for k in range(len(centres))])
    return centres


class Codebooks:
    """Two codebooks over the halves of vectors of one width."""

    def __init__(self, width: int, sample: np.ndarray, codes: int = CODES):
        self.width, self.cut = width, (width + 1) // 2
        self.centres = [codebook(half, codes) for half in (sample[:, :self.cut], sample[:, self.cut:])]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[..., :self.cut], x[..., self.cut:]


def fit(vectors: DataFrame, codes: int = CODES, sample: int = SAMPLE) -> tuple[Codebooks, int]:
    """Codebooks from about ``sample`` different vectors, and the number of all."""
    n, width = vectors.agg(F.count("*"), F.max(F.size("parts"))).first()
    width = max(width or 0, 0)
    share = hash_bound(sample / max(n, 1))
    rows = vectors.where(F.xxhash64("parts", F.lit(SEED)) <= share).select("parts").distinct().limit(4 * sample)
    return Codebooks(width, matrix([r.parts for r in rows.collect()], width), codes), n


class Block:
    """Vectors in the order of their cells."""

    def __init__(self, books: Codebooks, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.books = books
        x = vectors.astype(float)
        codes, self.radii = [], []
        for half, centres in zip(books.halves(x), books.centres):
            own = _nearest(half, centres)
            away = np.sqrt(((half - centres[own]) ** 2).sum(1))
            radius = np.full(len(centres), -np.inf)  # of a code without a vector
            np.maximum.at(radius, own, away)
            codes.append(own)
            self.radii.append(radius)
        cells = codes[0] * len(books.centres[1]) + codes[1]
        order = np.lexsort((ids, cells))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.starts = np.searchsorted(cells[order], np.arange(len(books.centres[0]) * len(books.centres[1]) + 1))
        self.most = int(np.abs(vectors).max()) if vectors.size else 0

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        most = len(query) * max(self.most, 1) * max(int(np.abs(query).max()) if len(query) else 0, 1)
        if most >= 1 << 63:
            raise ValueError("inner products of these vectors may not fit 64 bits")
        if most < 1 << 53:  # floating point is exact, and faster
            return (self.vectors[rows].astype(float) @ query.astype(float)).astype(np.int64)
        return self.vectors[rows] @ query

    def visited(self, query: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
        """Rows of cells in the order of their bounds, and the bound of all rows still to come."""
        bounds, orders = [], []
        for q, centres, radius in zip(self.books.halves(query.astype(float)), self.books.centres, self.radii):
            length = np.sqrt((q ** 2).sum())
            # what rounding may take off is given on top
            slack = 1e-11 * length * (np.sqrt((centres ** 2).sum(1)) + np.maximum(radius, 0)) + 1e-6
            bound = np.where(np.isfinite(radius), centres @ q + length * np.maximum(radius, 0) + slack, -np.inf)
            order = np.argsort(-bound, kind="stable")
            orders.append(order.tolist())
            bounds.append(bound[order].tolist())
        (first, second), (a, b) = orders, bounds
        starts, across = self.starts, len(second)
        heap, rows, found = [(-(a[0] + b[0]), 0, 0)], [], 0
        while heap and heap[0][0] < np.inf:
            _, i, j = heapq.heappop(heap)
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
            cell = first[i] * across + second[j]
            if starts[cell + 1] > starts[cell]:
                rows.append(np.arange(starts[cell], starts[cell + 1]))
                found += len(rows[-1])
            if found >= STEP:
                yield np.concatenate(rows), -heap[0][0] if heap else -np.inf
                rows, found = [], 0
        if rows:
            yield np.concatenate(rows), -np.inf

    def positives(self, own_id: int, label: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows of the same label."""
        best = _Best(k)
        for rows, bound in self.visited(query):
            rows = rows[(self.labels[rows] == label) & (self.ids[rows] != own_id)]
            best.add(self.ids[rows], self.scores(rows, query))
            if best.certain(bound):
                break
        return best.ids, best.scores

    def negatives(self, own_id: int, label: int, query: np.ndarray, windows: list[tuple[int, int]],
                  k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window of scores the ids and scores of its k best rows of other labels."""
        bests = [_Best(k) for _ in windows]
        open_ = [w for w, (low, high) in enumerate(windows) if low <= high]
        for rows, bound in self.visited(query) if open_ else ():
            rows = rows[(self.labels[rows] != label) & (self.ids[rows] != own_id)]
            scores, ids = self.scores(rows, query), self.ids[rows]
            for w in open_:
                inside = (scores >= windows[w][0]) & (scores <= windows[w][1])
                bests[w].add(ids[inside], scores[inside])
            open_ = [w for w in open_ if bound >= windows[w][0] and not bests[w].certain(bound)]
            if not open_:
                break
        return [(b.ids, b.scores) for b in bests]


class _Best:
    """The k best of what has been added: higher scores first, ties by the smaller id."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(self.scores) == self.k and self.k:
            good = scores >= self.scores[-1]
            ids, scores = ids[good], scores[good]
        if len(ids):
            ids, scores = np.concatenate((self.ids, ids)), np.concatenate((self.scores, scores))
            order = np.lexsort((ids, -scores))[:self.k]
            self.ids, self.scores = ids[order], scores[order]

    def certain(self, bound: float) -> bool:
        return len(self.scores) == self.k and (not self.k or float(self.scores[-1]) > bound)


_INDEX = "block long, size int, ids binary, labels binary, vectors binary"


def index(vectors: DataFrame, books: Codebooks, n: int, rows: int = ROWS) -> DataFrame:
    """Blocks of ``(vec_id, label, parts)``, ``n`` rows of which there are about; a row for each block."""
    spark = vectors.sparkSession
    ship_package(spark)
    width = books.width
    blocks = max(1, -(-n // rows), min(partitions(spark), n // FEW))

    def run(batches):
        from pyspark import TaskContext

        ids, labels, found = [], [], []
        for b in batches:
            ids.append(b.column(0).to_numpy(zero_copy_only=False))
            labels.append(b.column(1).to_numpy(zero_copy_only=False))
            found.append(matrix(b.column(2).to_pylist(), width))
        if sum(map(len, ids)):
            x = np.concatenate(found)
            most = int(np.abs(x).max()) if x.size else 0
            kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([TaskContext.get().partitionId()], pa.int64()),
                "size": pa.array([np.dtype(kind).itemsize], pa.int32()),
                "ids": pa.array([np.concatenate(ids).astype("<i8").tobytes()], pa.binary()),
                "labels": pa.array([np.concatenate(labels).astype("<i8").tobytes()], pa.binary()),
                "vectors": pa.array([x.astype(kind).tobytes()], pa.binary())})

    return written(vectors.select("vec_id", "label", "parts").repartition(blocks).mapInArrow(run, _INDEX), "multiindex")


def mine(anchors: DataFrame, indexed: DataFrame, books: Codebooks, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    For each row of ``anchors`` (``vec_id, label, parts``) and each of its best rows of the same label the best rows of
    other labels whose score is ``low`` to ``high`` hundredths of the positive's.
    """
    width = books.width

    def load(row):
        ids, labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        vectors = np.frombuffer(row["vectors"], f"<i{row['size']}").astype(np.int64)
        return Block(books, ids, labels, vectors.reshape(len(ids), width))

    anchors = written(anchors.select("vec_id", "label", "parts").distinct()
                      .withColumn("number", F.monotonically_increasing_id()), "multiindex-anchors")

    def same(block, r):
        ids, scores = block.positives(r["vec_id"], r["label"], matrix([r["parts"]], width)[0], positives)
        return [(r["number"], i, s) for i, s in zip(ids.tolist(), scores.tolist())]

    found = meet(indexed, anchors, load, same, "number long, positive_id long, positive_score long")
    best = Window.partitionBy("number").orderBy(F.desc("positive_score"), "positive_id")
    found = (found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
             .groupBy("number").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("found")))
    opened = written(anchors.join(found, "number").select("number", "vec_id", "label", "parts", "found"), "multiindex-positives")

    def other(block, r):
        scores = [p["positive_score"] for p in r["found"]]
        windows = [(-(-low * s // 100), high * s // 100) for s in scores]
        made = block.negatives(r["vec_id"], r["label"], matrix([r["parts"]], width)[0], windows, negatives)
        return [(r["number"], r["vec_id"], p["place"], p["positive_id"], p["positive_score"], i, s)
                for p, (ids, own) in zip(r["found"], made) for i, s in zip(ids.tolist(), own.tolist())]

    hard = meet(indexed, opened, load, other, "number long, anchor_id long, place long, positive_id long, "
                                                   "positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("number", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
