"""Packing: best fit against brute force, and a lossless round trip."""

from collections import defaultdict

import numpy as np

from storylens.llm import packing


def brute(lengths, row):
    rooms, rows = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fitting = [r for r in rooms if r >= lengths[i]]
        if fitting:
            k = rooms.index(min(fitting))
            rooms[k] -= lengths[i]
        else:
            rooms.append(row - lengths[i])
    return sorted(rooms)


def test_pack_is_best_fit_decreasing():
    rng = np.random.default_rng(0)
    for row in (1, 7, 64, 100):
        for _ in range(30):
            lengths = rng.integers(1, row + 1, rng.integers(0, 80)).tolist()
            rows = packing.pack(lengths, row)
            assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
            assert sorted(row - sum(lengths[i] for i in r) for r in rows) == brute(lengths, row)


def test_round_trip(spark):
    rng = np.random.default_rng(1)
    docs = [(i, rng.integers(0, 50000, int(rng.integers(0, 90))).astype("<u4").tobytes()) for i in range(200)]
    docs += [(None, b"\x01\0\0\0"), (500, None)]
    frame = spark.createDataFrame(docs, "doc_id bigint, ids binary")
    back = defaultdict(dict)
    rows = packing.packed(frame, row=32).collect()
    for r in rows:
        ids, place = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == 32 and r.cu_seqlens[-1] == r.n_tokens <= 32
        for d, p, a, b in zip(r.doc_ids, r.parts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert place[a:b].tolist() == list(range(b - a))
            back[d][p] = ids[a:b].tobytes()
    got = {d: b"".join(x for _, x in sorted(parts.items())) for d, parts in back.items()}
    assert got == {d: x for d, x in docs if x} and len({r.row for r in rows}) == len(rows)
    assert packing.packed(frame.limit(0)).count() == 0


def test_groups_go_over_arrow_batches(spark, tmp_path):
    rng = np.random.default_rng(2)
    frame = spark.createDataFrame([(i, rng.bytes(4 * int(rng.integers(1, 900)))) for i in range(5000)], "doc_id bigint, ids binary")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, counts = spark.conf.get(name), set()
    try:
        for most in ("100", "10000"):
            spark.conf.set(name, most)
            back = packing.write(packing.packed(frame), str(tmp_path / most))
            counts.add((back.count(), back.agg({"n_tokens": "sum"}).first()[0]))
    finally:
        spark.conf.set(name, before)
    assert len(counts) == 1


def test_repeated_rows_spread_and_pack_alike(spark):
    rows = [(None, b"\x05\0\0\0" * 7)] * 400 + [(1, b"\x06\0\0\0" * 5)] * 100 + [(1, b"\x07\0\0\0" * 5)] * 100 + [(2, b"")]
    frame = spark.createDataFrame(rows, "doc_id bigint, ids binary").repartition(3)
    frame = frame.selectExpr("*", "'x' AS part", "'y' AS `row`", "'z' AS _row")
    packed = packing.packed(frame, row=64)
    assert packed.rdd.glom().filter(len).count() > 1
    runs = [sorted((tuple(-1 if d is None else d for d in r.doc_ids), bytes(r.ids)) for r in packed.collect()) for _ in range(2)]
    assert runs[0] == runs[1] and sum(len(d) for d, _ in runs[0]) == 600
    long = packing.packed(spark.createDataFrame([(3, bytes(range(256)) * 1000)], "doc_id bigint, ids binary"), row=64).collect()
    assert b"".join(bytes(r.ids) for r in sorted(long, key=lambda r: r.parts)) == bytes(range(256)) * 1000
