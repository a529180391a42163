"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram is bound from its
letters' vectors, each rotated by its place and multiplied; a document is
the bundle (sum) of its n-grams, and a language the bundle of its documents, each at
length 1. A document's language is the one whose prototype has the largest
cosine with it. The prototypes' mean is what all languages share; it is taken
out of them.

Prototypes are learned from a bounded sample: about ``SAMPLE`` documents of a language,
those of the smallest hashes of their ids. All rows are predicted, over whole texts. Letters are
those of Unicode, lower-cased; everything else separates words.

A null text counts as empty; texts without a letter are ``und`` with score 0, as
are all if nothing could be learned. Ties go to the language first by code point.
Rows with a null id don't train; equal texts get equal predictions.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storylens.llm.common import hash_bound, map_columns, ship_package, worker_state

DIM = 1024
GRAM = 3
SEED = 20
#: Training documents of a language, about.
SAMPLE = 1500
UNDETERMINED = "und"
#: Rows of n-gram vectors that a worker keeps, and n-grams counted at once.
KEPT, BLOCK = 40_000, 400_000


def training_rows(doc_id: Column) -> Column:
    """Rows that languages may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class Profiles:
    """Vectors of documents."""

    def __init__(self, dim: int = DIM, gram: int = GRAM, seed: int = SEED):
        self.dim, self.gram, self.seed = dim, gram, seed
        self.letter: dict[int, np.ndarray] = {}
        self.row: dict[int, int] = {}
        self.rows = np.zeros((KEPT, dim), np.int8)

    def letter_vector(self, code: int) -> np.ndarray:
        v = self.letter.get(code)
        if v is None:
            bits = np.random.Generator(np.random.PCG64([self.seed, code])).integers(0, 2, self.dim, np.int8)
            v = self.letter[code] = bits * np.int8(2) - np.int8(1)
        return v

    def gram_vector(self, key: int) -> np.ndarray:
        v = np.ones(self.dim, np.int8)
        for place in range(self.gram):
            v = v * np.roll(self.letter_vector((key >> (21 * place)) & 0x1FFFFF), place)
        return v

    def keys(self, text: str) -> np.ndarray:
        """The n-grams of the words, with one space between and around them; none without a letter."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        letter = _letters()[codes]
        if not letter.any():
            return np.zeros(0, np.int64)
        codes = np.concatenate(([32], np.where(letter, codes, 32), [32]))
        codes = codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]
        n = max(len(codes) - self.gram + 1, 0)
        key = np.zeros(n, np.int64)
        for i in range(self.gram):
            key = (key << 21) | codes[i:i + n]
        return key

    def vectors(self, texts: list[str]) -> np.ndarray:
        """The bundles of whole texts, one row each; all 0 without a letter."""
        out = np.zeros((len(texts), self.dim), np.float32)
        block, size = [], 0
        for i, t in enumerate(texts):
            key = self.keys(t)
            for k in range(0, len(key), BLOCK):  # a very long text in several blocks
                block.append((i, key[k:k + BLOCK]))
                size += len(block[-1][1])
                if size >= BLOCK or len(block) >= 128:
                    self._bundle(block, out)
                    block, size = [], 0
        self._bundle(block, out)
        return out

    def _bundle(self, block: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
        if not block:
            return
        seen, place = np.unique(np.concatenate([k for _, k in block]), return_inverse=True)
        owner = np.repeat(np.arange(len(block)), [len(k) for _, k in block])
        for a in range(0, len(seen), 8192):
            n = min(8192, len(seen) - a)
            here = (place >= a) & (place < a + n) if len(seen) > 8192 else slice(None)
            counts = np.bincount(owner[here] * n + place[here] - a, minlength=len(block) * n)
            made = counts.reshape(len(block), n).astype(np.float32) @ self._matrix(seen[a:a + n])
            np.add.at(out, [i for i, _ in block], made)

    def _matrix(self, keys: np.ndarray) -> np.ndarray:
        missing = [k for k in keys.tolist() if k not in self.row]
        if len(self.row) + len(missing) > len(self.rows):
            self.row.clear()
            missing = keys.tolist()
        for k in missing:
            self.rows[len(self.row)] = self.gram_vector(k)
            self.row[k] = len(self.row)
        return self.rows[[self.row[k] for k in keys.tolist()]].astype(np.float32)


def _profiles() -> Profiles:
    return worker_state(("langid",), Profiles)


def _length(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(np.float64) ** 2).sum(1, keepdims=True))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """The languages in order, and their prototypes at length 1."""
    spark = docs.sparkSession
    ship_package(spark)
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = known.where("lang is not null and doc_id is not null").where(training_rows(F.col("doc_id")))
    hashed = F.xxhash64("doc_id", F.lit("langid"))
    # one row for each language: its share that the sample takes
    counts = known.groupBy("lang").count().collect()
    if not counts:
        return [], np.zeros((0, DIM))
    most = spark.createDataFrame([(r.lang, hash_bound(sample / r["count"])) for r in counts], "lang string, most long")
    rows = known.withColumn("hashed", hashed).join(F.broadcast(most), "lang").where("hashed <= most")

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            lang, text = b.column(0).to_pylist(), b.column(1).to_pylist()
            made = _profiles().vectors(text)
            made = made / np.maximum(_length(made), 1e-9)
            for i, x in enumerate(lang):
                sums[x] = sums.get(x, 0) + made[i].astype(np.float64)
        for x, v in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([x] * len(v), pa.string()), "place": np.arange(len(v)),
                                              # sums of rounded numbers don't depend on their order
                                              "value": np.round(v * 2**30).astype(np.int64)})

    parts = rows.select("lang", "text").mapInArrow(bundle, "lang string, place bigint, value bigint")
    total = parts.groupBy("lang", "place").agg(F.sum("value").alias("value")).toPandas()
    total = total.pivot(index="lang", columns="place", values="value").sort_index()
    langs, proto = list(total.index), total.to_numpy(np.float64)
    proto = proto / np.maximum(_length(proto), 1e-9) if len(langs) else np.zeros((0, DIM))
    if len(langs) > 1:
        proto = proto - proto.mean(0)
        proto = proto / np.maximum(_length(proto), 1e-9)
    return langs, proto


def predict(docs: DataFrame, learned: tuple[list[str], np.ndarray], text_col: str = "text",
            pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """Append the language and its cosine, not below 0."""
    langs, proto = learned
    proto = np.ascontiguousarray(proto.T, np.float32)

    def make():
        def run(texts):
            pred, score = [], []
            for k in range(0, len(texts), 512):
                v = _profiles().vectors([t or "" for t in texts[k:k + 512]])
                size = _length(v)[:, 0]
                cos = (v @ proto) / np.maximum(size, 1e-9)[:, None]
                best = cos.argmax(1) if langs else np.zeros(len(v), int)
                for i, s in enumerate(size):
                    known = s > 0 and langs
                    pred.append(langs[best[i]] if known else UNDETERMINED)
                    score.append(float(min(max(cos[i, best[i]], 0.0), 1.0)) if known else 0.0)
            return [pred, score]
        return run

    return map_columns(docs, [text_col], f"`{pred_col}` string, `{score_col}` double", make)
