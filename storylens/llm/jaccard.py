"""Jaccard join of documents by their word shingles: pivots, regions, windows, exactly.

Jaccard distance is a metric, so a pivot tells documents apart: two documents
that link are at distances from any pivot that differ by the threshold at
most. But documents without a common shingle are at distance 1 from each
other, and so from nearly every pivot; a plain nearest-pivot partition would have
to copy each of them into nearly all regions. So only documents that can have
a link take part, and a document lies in the regions of the pivots with which
it shares a rare shingle. In detail:

1. Documents with equal sets of shingles are one set. A set needs four fifths
   of its shingles in common with a partner. So of its first shingles in the order of their
   hashes (its signature, about three tenths) a known number must stand in another
   set's signature, too. Sets with fewer are done: they have no link. What a batch of
   texts has in common is counted there, so that a shingle goes to the shuffle at most once for each batch.
2. Of the sets that are left each counts its shingles that others of them have, too; fewer than four
   fifths, and it is done. Sets that link share one of the first fifth of their shingles, in
   the order of how many sets have them, and shingles of one set alone are of no use: what remains of that
   fifth are a set's rare shingles. Each of them picks a pivot among its sets, one with few shingles of its own.
   The regions of the pivots hold all links.
3. In a region distances to the pivot decide. Sets within the threshold link
   with it, and need not be compared with one another: they are one component. What is
   farther away goes on, with those linked sets that the window of the
   triangle inequality leaves as partners. Regions with many such sets are split again,
   by pivots among them; the others, and those that further pivots do not split, are joined block by
   block, counting common shingles in an inverted list.

Shingles are 64-bit hashes, and so are the names of sets. Only a spanning forest
of the links is kept, and the components come from it.

A null or empty text, or one without words, has no shingles and links with nothing. Of fewer than
``SHINGLE`` words the whole sequence is the only shingle. Rows of a null id take part and give
a component its id only if it has no other. Repeated rows repeat in the output.
Tables may be empty. Columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storylens.llm.common import partitions, ship_package, written
from storylens.llm.components import components

SHINGLE = 5
#: Hundredths of the shingles of two sets together that they must have in common.
SIMILAR = 80
SEED = 12
#: Rows and shingles of a batch whose common shingles are counted before the shuffle.
ROWS, SHINGLES = 4096, 1 << 21
#: Sets of a region, and shingles in them, that are compared with all others of it at once.
BLOCK, HELD = 1024, 1 << 22
#: How often large regions are split by further pivots.
SPLITS = 3


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text."""
    words = text.lower().split()  # bytes.lower changes A-Z only, bytes.split cuts at \x20 and \x09-\x0D
    if not words:
        return np.zeros(0, np.int64)
    joined = b" ".join(words)
    digest, n = xxhash.xxh64_intdigest, len(words) - size + 1
    if n <= 1:
        return np.array([digest(joined, SEED)], np.uint64).view(np.int64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, ends = [0, *ends[:n - 1].tolist()], (ends[size - 1:] - 1).tolist()
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, n).view(np.int64))


def needed(n: int, similar: int = SIMILAR) -> int:
    """Shingles that a set of n has in common with any partner, at least."""
    return -(-similar * n // 100)


def spare(n: int) -> int:
    """Common shingles of two signatures, if both sets have n shingles, at least."""
    return n // 10 + 1


def signature_size(n: int, similar: int = SIMILAR) -> int:
    """The first so many shingles hold the first ``spare`` common ones of any linked pair."""
    return min(n, n - needed(n, similar) + spare(n))


def _arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values, pa.int64()))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("text")).withColumn(
        "key", F.xxhash64("doc_id", "text"))


_SCANNED = "doc_id long, key long, sid long, n long, batch long, known long, shingles array<long>"


def scanned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
            similar: int = SIMILAR) -> DataFrame:
    """A row for each document, and rows (of null ``known``) for what the documents of a batch have in common.

    ``sid`` names the set; ``known`` counts shingles of the signature that other sets of the
    batch share, and ``shingles`` are the rest of it.
    """
    ship_package(df.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        number, rows, held = TaskContext.get().partitionId() << 32, [], 0

        def made():
            first: dict[int, np.ndarray] = {}
            for _, _, sid, n, own in rows:
                if sid is not None and sid not in first:
                    first[sid] = own
            sizes = np.array([len(s) for s in first.values()], np.int64)
            every = np.concatenate([np.zeros(0, np.int64), *first.values()])
            owner = np.repeat(np.arange(len(first)), sizes)
            different, at, times = np.unique(every, return_inverse=True, return_counts=True)
            common = times[at] > 1
            known = dict(zip(first, np.bincount(owner[common], minlength=len(first)).tolist()))
            left = dict(zip(first, np.split(every[~common], np.cumsum(np.bincount(owner[~common], minlength=len(first)))[:-1])))
            rest = [left.pop(sid, every[:0]) for _, _, sid, _, _ in rows]  # a set's shingles go with its first row
            frequent = different[times > 1]
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows] + [None], pa.int64()), pa.array([r[1] for r in rows] + [None], pa.int64()),
                pa.array([r[2] for r in rows] + [None], pa.int64()), pa.array([r[3] for r in rows] + [None], pa.int64()),
                pa.array([number] * (len(rows) + 1), pa.int64()),
                pa.array([known.get(r[2], 0) for r in rows] + [None], pa.int64()),
                _lists(np.concatenate([*rest, frequent]), [*map(len, rest), len(frequent)])], schema.names)

        for b in batches:
            for k in range(b.num_rows):
                own = shingles(b.column(1)[k].as_py() or b"", size)
                sid = xxhash.xxh64_intdigest(own.tobytes(), SEED) if len(own) else None
                sid = sid - (1 << 64) if sid is not None and sid >> 63 else sid
                rows.append((b.column(0)[k].as_py(), b.column(2)[k].as_py(), sid, len(own), own[:signature_size(len(own), similar)]))
                held += len(rows[-1][4])
                if held >= SHINGLES or len(rows) >= ROWS:
                    yield made()
                    number, rows, held = number + 1, [], 0
        if rows:
            yield made()

    schema = pa.schema([(f.split()[0], pa.int64()) for f in _SCANNED.split(", ")])
    return _keyed(df, id_col, text_col).mapInArrow(run, _SCANNED)


def _shared(scan: DataFrame) -> DataFrame:
    """``(sid, batch, shared)``: how many shingles of a set's signature, beyond those known in its batch, other sets share."""
    spark = scan.sparkSession
    # batch -1: the shingle is common in some batch
    single = scan.where("known is not null").select(F.explode("shingles").alias("shingle"), "sid", "batch")
    common = scan.where("known is null").select(F.explode("shingles").alias("shingle"), F.lit(0).cast("long").alias("sid"),
                                                F.lit(-1).cast("long").alias("batch"))
    dealt = single.unionByName(common).repartition(partitions(spark), "shingle").sortWithinPartitions("shingle", "batch")

    def told(shingle, sid, batch):
        """The sets and batches of shared shingles; of a shingle there are at most a few rows for each batch of texts."""
        starts = np.concatenate(([0], np.flatnonzero(shingle[1:] != shingle[:-1]) + 1))
        marked = batch < 0
        shared = marked[starts] | (np.minimum.reduceat(sid, starts) != np.maximum.reduceat(sid, starts))
        of = np.repeat(shared, np.diff(np.append(starts, len(shingle)))) & ~marked
        return pa.RecordBatch.from_arrays([pa.array(sid[of], pa.int64()), pa.array(batch[of], pa.int64())], ["sid", "batch"])

    def run(batches):
        rest = None
        for b in batches:
            now = _arrays(b)
            now = [np.concatenate(x) for x in zip(rest, now)] if rest is not None else now
            if not len(now[0]):
                continue
            last = int(np.searchsorted(now[0], now[0][-1]))
            if last:
                yield told(*(x[:last] for x in now))
            rest = [x[last:] for x in now]
        if rest is not None and len(rest[0]):
            yield told(*rest)

    return dealt.mapInArrow(run, "sid long, batch long").groupBy("sid", "batch").agg(F.count("*").alias("shared"))


def _candidates(scan: DataFrame, shared: DataFrame, similar: int) -> DataFrame:
    """``(sid, key)``: sets that may have a link, and a row that has the set."""
    counted = scan.where("sid is not null").select("sid", "batch", "n", "key", F.col("known").alias("shared")).unionByName(
        shared, allowMissingColumns=True)
    # rows that repeat a set in a batch have the same count
    known = counted.groupBy("sid", "batch").agg(F.max("n").alias("n"), F.min("key").alias("key"), (
        F.coalesce(F.max(F.when(F.col("n").isNotNull(), F.col("shared"))), F.lit(0))
        + F.coalesce(F.max(F.when(F.col("n").isNull(), F.col("shared"))), F.lit(0))).alias("shared"))
    sets = known.groupBy("sid").agg(F.max("n").alias("n"), F.min("key").alias("key"), F.max("shared").alias("shared"))
    least = F.expr(f"(({similar} * n + 99) div 100) div 10 + 1")
    return sets.where(F.col("shared") >= least).select("sid", "key")


def _sets(df: DataFrame, candidates: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``(sid, shingles)`` of candidates, sorted; a set may come a few times."""
    # candidates have no bound that would allow for a broadcast
    rows = _keyed(df, id_col, text_col).select("key", "text").join(candidates.hint("merge"), "key").select("text", "sid")

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            sids, sets = [], []
            for k, sid in enumerate(b.column(1).to_pylist()):
                if sid in seen:
                    continue
                seen.add(sid)
                sids.append(sid)
                sets.append(shingles(b.column(0)[k].as_py() or b"", size))
            if sids:
                yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), _lists(np.concatenate(sets), list(map(len, sets)))],
                                                 ["sid", "shingles"])

    return rows.mapInArrow(run, "sid long, shingles array<long>")


def _rare(members: DataFrame, similar: int) -> DataFrame:
    """``(region, shingle, sid, active, rank)``: the rare shingles of each set, as far as it can have a link in its region.

    Of the first shingles in the order of how many sets have them, those that a set has alone can't be in common.
    ``rank`` is their share.
    """
    postings = members.select("region", "sid", "active", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    shared = postings.groupBy("region", "shingle").agg(F.count("*").alias("sets")).where("sets > 1")
    sets = postings.join(shared, ["region", "shingle"]).groupBy("region", "sid").agg(
        F.max("active").alias("active"), F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("sets", "shingle"))).alias("shared"))
    spared = F.expr(f"size(shared) - ({similar} * n + 99) div 100 + 1")
    return (sets.where(spared > 0)
            .select("region", "sid", "active", F.expr("1000 * (n - size(shared)) div n").alias("rank"),
                    F.explode(F.slice("shared", F.lit(1), spared.cast("int"))).alias("rare"))
            .select("region", F.col("rare.shingle").alias("shingle"), "sid", "active", "rank"))


def _regions(prefixes: DataFrame) -> DataFrame:
    """``(pivot, region, sid)``: each shingle's sets meet the pivot that it picks among the active ones."""
    order = F.struct((1 - F.col("active")).alias("passive"), "rank", "sid")
    pivots = (prefixes.groupBy("region", "shingle").agg(F.min(order).alias("pivot"), F.count("*").alias("sets"))
              .where("sets > 1 and pivot.passive = 0").select("region", "shingle", F.col("pivot.sid").alias("pivot")))
    met = prefixes.join(pivots, ["region", "shingle"]).where("sid <> pivot")
    return met.select("pivot", "region", "sid").distinct()


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets have in common."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum()) if len(b) else 0


def _distances(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """``(region, pivot, sid, n, linked, away)``: distances of sets from their region's pivot, which the new region is named by."""
    own = pairs.join(sets.select("sid", F.col("shingles").alias("own")), "sid")
    both = own.join(sets.select(F.col("sid").alias("pivot"), F.col("shingles").alias("other")), "pivot")

    def run(batches):
        for b in batches:
            own, other = b.column(3), b.column(4)
            n = len(own)
            sizes, linked, away = np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n)
            for k in range(n):
                x, y = (c[k].values.to_numpy(zero_copy_only=False) for c in (own, other))
                same = common(x, y)
                union = len(x) + len(y) - same
                sizes[k], linked[k], away[k] = len(x), 100 * same >= similar * union, 1 - same / union
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sizes), pa.array(linked), pa.array(away)],
                                             ["pivot", "region", "sid", "n", "linked", "away"])

    return both.select("pivot", "region", "sid", "own", "other").mapInArrow(
        run, "pivot long, region long, sid long, n long, linked boolean, away double").select(
        F.xxhash64("region", "pivot").alias("region"), "pivot", "sid", "n", "linked", "away")


def _left_over(distances: DataFrame, similar: int) -> DataFrame:
    """``(region, sid, active, blocks)``: sets beyond the pivot's reach, and linked ones in the window of such a set.

    ``blocks`` is the number of blocks that the region's active sets, those beyond, fill.
    """
    window = 1 - similar / 100 + 1e-9
    beyond = ~F.col("linked")
    regions = distances.groupBy("region").agg(
        F.count(F.when(beyond, True)).alias("outside"), F.sum(F.when(beyond, F.col("n"))).alias("held"),
        F.min(F.when(beyond, F.col("away"))).alias("nearest"), F.count("*").alias("sets")).where("outside > 0 and sets > 1")
    blocks = F.expr(f"greatest((outside + {BLOCK - 1}) div {BLOCK}, (held + {HELD - 1}) div {HELD})")
    return (distances.join(regions, "region").where(beyond | (F.col("away") >= F.col("nearest") - window))
            .select("region", "sid", beyond.cast("long").alias("active"), blocks.cast("int").alias("blocks")))


class _Inverted:
    """Inverted lists of some sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array(list(map(len, sets)), np.int64)
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(every, kind="stable")
        self.every, self.owner = every[order], owner[order]

    def linked(self, own: np.ndarray, similar: int) -> np.ndarray:
        """Numbers of the sets that link with ``own``."""
        first, last = np.searchsorted(self.every, own), np.searchsorted(self.every, own, side="right")
        n = last - first
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        same = np.bincount(self.owner[at], minlength=len(self.sizes))
        return np.flatnonzero(100 * same >= similar * (self.sizes + len(own) - same))


def _in_blocks(members: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """``(a, b)``: a spanning forest of links of the regions' active sets with all of their region, block by block.

    Active sets are dealt into blocks. A block comes first in its group; the passive sets of the region
    and the active ones of later blocks stream past it.
    """
    spark = members.sparkSession
    n = partitions(spark)
    own = F.pmod(F.xxhash64("sid", F.lit(SEED)), F.col("blocks")).cast("int")
    dealt = members.withColumn("own", F.when(F.col("active") == 1, own))
    copies = dealt.withColumn("block", F.explode(F.expr("sequence(0, coalesce(own, blocks - 1))"))).select(
        "region", "block", (~F.col("own").eqNullSafe(F.col("block"))).cast("int").alias("later"), "sid")
    rows = copies.join(sets.select("sid", "shingles"), "sid").select("region", "block", "later", "sid", "shingles")
    grouped = rows.repartition(n, "region", "block").sortWithinPartitions("region", "block", "later", "sid")

    def run(batches):
        group, block = None, None
        for b in batches:
            edges: list[tuple[int, int]] = []
            regions, numbers, later, sids = (b.column(i).to_pylist() for i in range(4))
            for k, sid in enumerate(sids):
                if (regions[k], numbers[k]) != group:
                    if block:
                        edges += block.among()
                    group, block = (regions[k], numbers[k]), _Block(similar)
                own = b.column(4)[k].values.to_numpy(zero_copy_only=False)
                if later[k]:
                    edges += block.among()
                    edges += block.links(sid, own)
                else:
                    block.add(sid, own)
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges)], ["a", "b"])
        if block and (edges := block.among()):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges)], ["a", "b"])

    return grouped.mapInArrow(run, "a long, b long")


class _Block:
    """Active sets of a region; finds a spanning forest of their links with one another and with sets that come later."""

    def __init__(self, similar: int):
        self.similar, self.sids, self.sets = similar, [], []
        self.root: list[int] = []
        self.inverted: _Inverted | None = None

    def add(self, sid: int, own: np.ndarray) -> None:
        self.sids.append(sid)
        self.sets.append(own)

    def _find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def among(self) -> list[tuple[int, int]]:
        """Links among the sets, once all are there."""
        if self.inverted or not self.sets:
            return []
        self.inverted, self.root = _Inverted(self.sets), list(range(len(self.sets)))
        return [e for k, own in enumerate(self.sets) for e in self.links(self.sids[k], own, k)]

    def links(self, sid: int, own: np.ndarray, number: int | None = None) -> list[tuple[int, int]]:
        """A link to each component of the block's sets that the set (of that number, if it is one of them) joins."""
        if not self.inverted:
            return []
        edges, joined = [], None if number is None else self._find(number)
        for k in self.inverted.linked(own, self.similar).tolist():
            root = self._find(k)
            if root != joined:
                edges.append((sid, self.sids[k]))
                if joined is not None:
                    self.root[root] = joined
                else:
                    joined = root
        return edges


def links(sets: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """``(a, b)`` over ``(sid, shingles)``, which may repeat: links with the same components as all links."""
    edges, blocks, near = [], [], None
    members = sets.select(F.lit(0).cast("long").alias("region"), "sid", F.lit(1).cast("long").alias("active"), "shingles")
    for turn in range(SPLITS + 1):
        pairs = written(_regions(written(_rare(members, similar), "jaccard-rare")), "jaccard-pairs")
        if near is None:  # most sets are in no region; the others' copies go here
            met = pairs.select("sid").unionByName(pairs.select(F.col("pivot").alias("sid"))).distinct()
            near = sets.groupBy("sid").agg(F.first("shingles").alias("shingles"))
            near = written(near.join(met, "sid", "left_semi"), "jaccard-near")
        distances = written(_distances(pairs, near, similar), "jaccard-distances")
        edges.append(distances.where("linked").select(F.col("sid").alias("a"), F.col("pivot").alias("b")))
        left = written(_left_over(distances, similar), "jaccard-left")
        large = left.where("blocks > 1")
        if turn == SPLITS or large.isEmpty():
            blocks.append(left)
            break
        blocks.append(left.where("blocks = 1"))
        members = large.join(near, "sid").select("region", "sid", "active", "shingles")
    for left in blocks:
        edges.append(_in_blocks(left, near, similar))
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return written(out, "jaccard-links")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    similar: int = SIMILAR) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row for each row of ``df``."""
    scan = written(scanned(df, id_col, text_col, size, similar), "jaccard-scan")
    shared = written(_shared(scan), "jaccard-shared")
    sets = written(_sets(df, _candidates(scan, shared, similar), id_col, text_col, size), "jaccard-sets")
    nodes = components(links(sets, similar), "jaccard-components")
    own = scan.where("known is not null").select("doc_id", "n", "sid")
    classes = own.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("first"))
    classes = classes.join(nodes, classes.sid == nodes.node, "left").withColumn("root", F.coalesce("root", "sid"))
    ids = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = classes.join(ids, "root").select("sid", "component_id")
    found = own.where("sid is not null").join(named, "sid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return found.unionByName(own.where("sid is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
