"""Document fingerprints by winnowing.

All k-grams of a text's code points get a rolling hash; of each window of
successive hashes the smallest is kept, of equal ones the rightmost. Kept hashes
and their positions are the fingerprint. Any passage of ``WINDOW + GRAM - 1``
code points that two texts share leaves a common hash in both.

A text shorter than a window is one window, one shorter than a k-gram is one
gram; a null text counts as empty, and an empty text keeps nothing. Equal
texts have equal fingerprints. Likeness is twice the number of common
hashes over the number of both texts' different hashes (1 for two empty ones).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storylens.llm.common import documents, map_columns, partitions, ship_package

GRAM = 16
WINDOW = 32
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Code points of result texts in a batch, about.
FLUSH = 4_000_000


def rolling(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of each run of ``gram`` codes, or of the whole if it is shorter.

    The polynomial of a run comes from those of its two parts, so a run takes as many steps as its length has bits.
    """
    gram = min(gram, len(codes))
    if not gram:
        return np.zeros(0, np.uint64)
    one = _mixed(codes.astype(np.uint64) + np.uint64(1))
    out, done, length, factor = None, 0, 1, BASE  # factor: BASE to the power of the length
    while True:
        if gram & length:
            out = one.copy() if out is None else one[:len(codes) - done - length + 1] * power + out[length:][:len(codes) - done - length + 1]
            done += length
            power = factor if done == length else power * factor
        if length * 2 > gram:
            break
        one = one[:-length] * factor + one[length:]
        factor, length = factor * factor, length * 2
    return _mixed(out[:len(codes) - gram + 1])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of each window's smallest hash, the rightmost of equal ones."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    window = min(window, len(hashes))
    least, place, span = hashes, np.arange(len(hashes)), 1

    def joined(step):
        right = least[step:] <= least[:-step]
        return np.where(right, least[step:], least[:-step]), np.where(right, place[step:], place[:-step])

    while span * 2 <= window:
        least, place = joined(span)
        span *= 2
    if span < window:  # two windows that overlap
        least, place = joined(window - span)
    return place[np.concatenate(([True], place[1:] != place[:-1]))]


def marks(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The kept hashes and their positions."""
    with np.errstate(over="ignore"):
        hashes = rolling(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), gram)
    place = winnow(hashes, window)
    return hashes[place], place


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Of sorted arrays of different hashes."""
    if not len(a) and not len(b):
        return 1.0
    return 2 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


def fingerprint(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Append ``marks`` and ``positions``, packed as little-endian 64-bit and 32-bit integers."""

    def make():
        def run(texts):
            made = [marks(t or "") for t in texts]
            return [[h.astype("<u8").tobytes() for h, _ in made], [p.astype("<u4").tobytes() for _, p in made]]
        return run

    return map_columns(df, [text_col], "marks binary, positions binary", make)


def in_order(docs: DataFrame) -> DataFrame:
    """Rows dealt into ranges of ids, each in order and followed by the first row of the next one.

    ``(range, after, doc_id, text)`` of ``(doc_id, text)``: ascending ids (null first, equal ids by a hash of the
    text, then by text); ``after`` marks the row of the next range, of which the last one's is the first range. An
    id that fills several ranges (the null one, say) is dealt over as many by that hash.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    docs = docs.withColumns({"_key": F.coalesce("doc_id", F.lit(-(1 << 63))), "_hash": F.xxhash64("text")})
    ranges = 4 * n  # several for each task: their sizes even out
    shares = [i / ranges for i in range(1, ranges)]
    bounds = docs.agg(F.percentile_approx("_key", shares).alias("b")).first().b or []
    bounds = np.sort(np.array(bounds, np.int64))

    @F.pandas_udf("int")
    def range_of(key: pd.Series, text_hash: pd.Series) -> pd.Series:
        first, last = (np.searchsorted(bounds, key.to_numpy(), side=s) for s in ("left", "right"))
        # 0 to 1 in the order of the hashes
        part = (text_hash.to_numpy().astype(np.float64) + 2.0**63) / 2.0**64
        own = first + 1 + np.minimum((part * (last - first)).astype(np.int64), last - first - 1)
        return pd.Series(np.where(last - first > 1, own, last).astype(np.int32))

    docs = docs.withColumn("range", range_of("_key", "_hash"))
    least = docs.groupBy("range").agg(F.min(F.struct("_key", "_hash")).alias("least")).collect()  # one row for each range
    if not least:
        return docs.select("range", F.lit(False).alias("after"), "doc_id", "text")
    least.sort(key=lambda r: r.range)
    firsts = F.broadcast(spark.createDataFrame(
        [(*r.least, least[i - 1].range) for i, r in enumerate(least)], "_key long, _hash long, before int"))
    first_rows = (docs.drop("range").join(firsts, ["_key", "_hash"]).groupBy("before")
                  .agg(F.min(F.struct("doc_id", "_hash", "text")).alias("row"))
                  .select(F.col("before").alias("range"), F.lit(True).alias("after"), "row.doc_id", "row._hash", "row.text"))
    both = docs.select("range", F.lit(False).alias("after"), "doc_id", "_hash", "text").unionByName(first_rows)
    return (both.repartition(n, "range").sortWithinPartitions("range", "after", "doc_id", "_hash", "text")
            .select("range", "after", "doc_id", "text"))


_PAIRS = ("doc_id bigint, n_chars bigint, edited string, marks binary, positions binary, "
          "edited_marks binary, edited_positions binary, near_edited double, near_next double")


def against_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, and of the text whose second half is the next document's beginning."""
    docs = documents(df, id_col, text_col)
    ship_package(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()),
                        ("marks", pa.binary()), ("positions", pa.binary()), ("edited_marks", pa.binary()),
                        ("edited_positions", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches):
        before, out, size = None, [], 0
        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(4))):
                where, after, doc_id, text = r
                kept, place = marks(text)
                different = np.unique(kept)
                if before is not None and before[0] == where:
                    _, own_id, own, own_kept, own_place, own_different = before
                    half = len(own) // 2
                    edited = own[:len(own) - half] + text[:half]
                    new_kept, new_place = marks(edited)
                    out.append((own_id, len(own), edited, own_kept.astype("<u8").tobytes(),
                                own_place.astype("<u4").tobytes(), new_kept.astype("<u8").tobytes(),
                                new_place.astype("<u4").tobytes(), likeness(own_different, np.unique(new_kept)),
                                likeness(own_different, different)))
                    size += len(edited)
                    if size > FLUSH:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                        out, size = [], 0
                before = None if after else (where, doc_id, text, kept, place, different)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return in_order(docs).mapInArrow(run, _PAIRS)
