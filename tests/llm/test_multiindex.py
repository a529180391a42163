"""Hard negatives against all pairs."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from storylens.llm import multiindex

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, anchors):
    out = []
    for i, q, label in anchors:
        others = [(sum(a * b for a, b in zip(q, v)), -j, lab) for j, v, lab in rows if j != i]
        best = sorted((s for s in others if s[2] == label), reverse=True)[:5]
        for p, pid, _ in best:
            hard = sorted(((s, j) for s, j, lab in others if lab != label and 30 * p <= 100 * s <= 90 * p), reverse=True)[:10]
            out += [(i, -pid, k + 1, -j, p, s) for k, (s, j) in enumerate(hard)]
    return sorted(out)


def searched(spark, rows, every, **kw):
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(0) for c in ("parts", "block", "kind", "number", "size", "ids")})
    vectors = multiindex.quantised(df, F.col("label"))
    books, n = multiindex.fit(vectors, **kw)
    anchors = vectors.where(F.col("vec_id") % every == 0)
    own = [(r.vec_id, r.parts, r.label) for r in vectors.collect()]
    found = multiindex.mine(anchors, multiindex.index(vectors, books, n), books)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect())), own


def test_query_equals_sql(spark, sf_dir):
    found = entry.queries()["op11_hard_negatives"](spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_dir}/embeddings.parquet')")
    cur = con.execute(entry.oracle_sql()["op11_hard_negatives"])
    assert found.columns == [d[0] for d in cur.description]
    assert sorted(map(tuple, found.collect())) == sorted(cur.fetchall())


@pytest.mark.parametrize("blocks", [1, 4])
def test_equals_all_pairs(spark, monkeypatch, blocks):
    # coarse components make many ties
    monkeypatch.setattr(multiindex, "FEW", 600 // blocks)
    rng = np.random.default_rng(blocks)
    rows = [(int(i), (rng.integers(-3, 4, 6) / 64 + (i % 3) / 32).tolist(), int(rng.integers(3))) for i in range(600)]
    found, own = searched(spark, rows, 20, codes=6)
    assert found == brute(own, [r for r in own if r[0] % 20 == 0]) and found


def test_stops_before_the_end():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 400, (64, 16))
    x = np.rint(centres[rng.integers(0, 64, 20_000)] + rng.normal(0, 8, (20_000, 16))).astype(np.int64)
    books = multiindex.Codebooks(16, x[:4000])
    block = multiindex.Block(books, np.arange(len(x)), rng.integers(0, 10, len(x)), x)
    seen = []
    whole = block.scores
    block.scores = lambda rows, q: seen.append(len(rows)) or whole(rows, q)
    ids, scores = block.positives(5, int(block.labels[list(block.ids).index(5)]), x[5], 5)
    assert sum(seen) < 2_000 and len(ids) == 5 and (np.diff(scores) <= 0).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [0.5, 1.0], 2), (2, [0.5, 1.0], 2),
            (3, None, 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 2), (7, [1.0, 1.0], None), (None, [1.0, 2.0], 1),
            (8, [], 1), (9, [1.0], 2), (10, [0.5, 1.0, 9.0], 2), (20, [0.0, 0.0, 1.0], 3)]
    found, own = searched(spark, rows, 10)
    distinct = {(i, tuple(v), lab) for i, v, lab in own if i % 10 == 0}
    assert found == brute(own, distinct) and {r[0] for r in found} >= {0}
    assert searched(spark, [], 10)[0] == []
    assert searched(spark, [(10, [], 1), (11, [], 1), (12, [], 2)], 10)[0] == [(10, 11, 1, 12, 0, 0)]


def test_large_components(spark):
    rows = [(0, [3e5, 1.0], 1), (1, [3e5, 2.0], 1), (2, [1.5e5, 1.0], 2)]
    found, own = searched(spark, rows, 10)
    assert found == brute(own, [r for r in own if r[0] == 0]) and len(found) == 1
    with pytest.raises(Exception, match="64 bits"):
        searched(spark, [(0, [1e30], 1), (1, [1e30], 1)], 10)
