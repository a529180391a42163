"""Target-distribution importance resampling on hashed n-grams, texts scanned batch by batch.

The texts of a batch are joined with separator sentinels, and one regular
expression finds all words of the joined bytes. The documents' offsets, looked
up with ``searchsorted``, tell whose word each is, so that n-grams that would
reach into the next document are masked out before the buckets are counted.
What two sets of documents (the raw corpus and the target) have in each bucket
gives a bucket's gain; a document's weight is the mean gain of its features.
Adding Gumbel noise that depends on the document's id and taking the highest
sums draws documents without replacement in proportion to their weights.

Counts cover all documents; only the ``buckets`` sums pass through the driver.
The drawn documents are ranked by ranges of the score: ranges are sorted on
their own, and a range's ranks follow the rows of the ranges before it.

A null or empty text has no words, no feature and weight 0. A null id hashes
like an empty one and comes after the others of its score. Repeated rows are
documents of their own, in any order among themselves. Tables may be empty:
without a target all that counts is the smoothing. Columns other than id and
text are not read. Very long texts are scanned in pieces that end between words.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storylens.llm.common import SLICE, map_columns, partitions, ship_package, written

BUCKETS = 10_000
SEED = 7
#: Documents of fewer words are never drawn.
LEAST_WORDS = 20
#: Documents drawn of a hundred that may be.
PERCENT = 25
#: Bytes of joined texts whose words are Python objects at once.
PIECE = 1 << 20

# Words of lower-cased UTF-8: digits, a to z, and every byte of a character beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
_IN_WORD = np.array([bool(_WORD.match(bytes([b]))) for b in range(256)])
#: Stands between two texts; it is in no word.
SENTINEL = b"\x00"


def features(texts: list[bytes], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(bucket, document, document of each word)`` by pieces: all one- and two-word features of some texts."""
    joined = SENTINEL.join(texts).lower()  # bytes.lower changes A-Z only
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    at, last_crc, last_doc = 0, 0, -1
    while at < len(joined):
        gap = _GAP.search(joined, at + PIECE)
        end = gap.start() if gap else len(joined)
        piece = joined[at:end]
        words = _WORD.findall(piece)
        inside = _IN_WORD[np.frombuffer(piece, np.uint8)]
        starts = np.flatnonzero(np.diff(inside, prepend=False) & inside)
        whose = np.searchsorted(offsets, starts + at, side="right") - 1
        at = end
        if not words:
            continue
        one = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        # the checksum of two words goes on from that of the first and a space
        before = np.concatenate(([last_crc], one[:-1])).astype(np.uint32)
        two = np.fromiter(map(zlib.crc32, words, map(zlib.crc32, repeat(b" "), before.tolist())), np.uint32, len(words))
        own = whose == np.concatenate(([last_doc], whose[:-1]))
        last_crc, last_doc = one[-1], whose[-1]
        yield np.concatenate((one, two[own])) % buckets, np.concatenate((whose, whose[own])), whose


def counts(df: DataFrame, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    ship_package(df.sparkSession)
    texts = df.select(F.col(text_col).cast("string").cast("binary").alias("text"))

    def run(batches):
        sums = np.zeros(buckets, np.int64)
        for b in (whole.slice(k, SLICE) for whole in batches for k in range(0, whole.num_rows, SLICE)):
            for bucket, _, _ in features([t or b"" for t in b.column(0).to_pylist()], buckets):
                sums += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": some, "n": sums[some]})

    found = texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():  # a row for each bucket at most
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the target's smoothed share over the raw corpus's, by bucket."""
    n = len(raw)
    of_raw, of_target = float(int(raw.sum()) + n), float(int(target.sum()) + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * of_raw / ((s + 1.0) * of_target)))
                     for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(df: DataFrame, gain: np.ndarray, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_features, n_words, weight, score)`` for each row."""
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def make():
        def run(texts):
            n_words, n_features, sums = (np.zeros(len(texts), np.int64) for _ in range(3))
            for bucket, document, whose in features([t or b"" for t in texts], len(gain)):
                n_words += np.bincount(whose, minlength=len(texts))
                n_features += np.bincount(document, minlength=len(texts))
                # sums of whole numbers far below 2^53 are exact
                sums += np.bincount(document, gain[bucket], minlength=len(texts)).astype(np.int64)
            return [n_features, n_words, np.where(n_features > 0, sums // np.maximum(n_features, 1), 0)]
        return run

    rows = map_columns(texts, ["text"], "n_features bigint, n_words bigint, weight bigint", make)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.select("doc_id", "n_features", "n_words", "weight", (F.col("weight") + noise).cast("long").alias("score"))


def drawn(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``weighed`` rows with ``rank``: 1, 2, 3 ... of those drawn in the order of their scores, else null."""
    spark = rows.sparkSession
    # the rows' numbers, as written, tell rows apart that are alike in all else
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "resampling-weights")
    n = rows.where(F.col("n_words") >= least_words).count()
    order = [(F.col("n_words") < least_words).asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row").asc()]
    in_order = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    in_order = written(in_order.withColumn("_row", F.monotonically_increasing_id()), "resampling-order")
    part, place = F.shiftright("_row", 33), F.col("_row").bitwiseAND((1 << 33) - 1)
    before, firsts = 0, []
    for r in in_order.groupBy(part.alias("part")).count().orderBy("part").collect():  # a row for each range
        firsts.append((r.part, before))
        before += r["count"]
    firsts = F.broadcast(spark.createDataFrame(firsts, "_part long, _before long"))
    rank = F.col("_before") + place + 1
    return (in_order.join(firsts, part == F.col("_part"))
            .withColumn("rank", F.when(rank <= percent * n // 100, rank)).drop("_row", "_part", "_before"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, buckets: int = BUCKETS, seed: int = SEED,
             id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """``(doc_id, n_features, n_words, weight, score, rank)`` for each row of ``docs``."""
    gain = gains(counts(docs, buckets, text_col), counts(target, buckets, target_text_col))
    return drawn(weighed(docs, gain, seed, id_col, text_col), percent)
