"""Importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from storylens.llm import resampling
from storylens.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id bigint, text string"


def brute_words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_buckets(text, buckets=10_000):
    w = brute_words(text)
    return [zlib.crc32(f.encode()) % buckets for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]


def brute(docs, target):
    """``doc_id: (n_features, weight, score, rank)`` of different ids."""
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            np.add.at(counts, brute_buckets(x), 1)
    gain = [math.floor(1000 * math.log((b + 1) * (int(s.sum()) + 10_000) / ((a + 1) * (int(t.sum()) + 10_000)))) for a, b in zip(s.tolist(), t.tolist())]
    out, words = {}, {}
    for i, x in docs:
        own = brute_buckets(x)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out[i] = [len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))]
        words[i] = len(brute_words(x))
    may = sorted((i for i in out if words[i] >= 20), key=lambda i: (-out[i][2], i is None, i))
    rank = {i: k + 1 for k, i in enumerate(may[:25 * len(may) // 100])}
    return {i: (*v, rank.get(i)) for i, v in out.items()}


def test_query_equals_brute_force(spark, sf_dir):
    found = entry.queries()["op13_resampling"](spark, sf_dir)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert [t for _, t in found.dtypes] == ["bigint"] * 5
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    want = brute(docs, [r.text for r in table(spark, sf_dir, "benchmark").collect()])
    assert {r.doc_id: tuple(r)[1:] for r in found.collect()} == want
    assert found.count() == len(docs)


def test_batches_keep_documents_apart(monkeypatch):
    # pieces of a few bytes: words of two pieces still make a pair, those of two documents never do
    rng = np.random.default_rng(1)
    parts = ["a", "B", "zz9", "é", "日本", " ", "  ", "\n", "-", "\x00", "1"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(300)]
    for piece in (1, 7, 1 << 20):
        monkeypatch.setattr(resampling, "PIECE", piece)
        whose = [[] for _ in texts]
        words = np.zeros(len(texts), int)
        for bucket, document, word in resampling.features([t.encode() for t in texts]):
            words += np.bincount(word, minlength=len(texts))
            for b, d in zip(bucket.tolist(), document.tolist()):
                whose[d].append(b)
        assert [sorted(b) for b in whose] == [sorted(brute_buckets(t)) for t in texts]
        assert words.tolist() == [len(brute_words(t)) for t in texts]


def test_odd_rows(spark):
    twenty = " ".join(f"Wort{i}" for i in range(20))
    docs = [(1, None), (2, ""), (3, " \x00\t"), (4, twenty), (5, "wort1 " * 200_000), (None, twenty), (6, "É é"), (7, "x" * 3_000_000)]
    docs += [(i, twenty + f" {i}") for i in range(10, 30)]
    df = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit("0") for c in ("score", "rank", "weight", "bucket", "n", "_row", "part")})
    target = spark.createDataFrame([(twenty,), (None,), ("",)], "text string")
    found = resampling.resample(df, target).collect()
    want = brute(docs, [twenty, None, ""])
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in found} == want
    assert want[1][:2] == want[2][:2] == want[3][:2] == (0, 0)


def test_repeated_rows_and_ties(spark):
    twenty = " ".join(f"wort{i}" for i in range(20))
    rows = [(1, twenty)] * 30 + [(None, twenty)] * 30 + [(2, "few words")] * 5
    found = resampling.resample(spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame([], "text string")).collect()
    assert len(found) == 65 and sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 16))
    assert len({(r.doc_id, r.score) for r in found}) == 3 and all(r["rank"] is None for r in found if r.doc_id == 2)
    none = spark.createDataFrame([], DOCS)
    assert resampling.resample(none, none).collect() == []
