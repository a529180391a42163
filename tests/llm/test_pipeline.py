"""The corpus pipeline and the registered queries on small tables."""

from __future__ import annotations

import hashlib
import shutil
import zlib
from collections import Counter

import duckdb
import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from storylens.llm import langid, mixing, toxicity
from storylens.llm.common import table, written
from storylens.session import local_path, scratch_path
from tests_llm_brute import brute_components, brute_fingerprint, edited, reference


def words(text):
    return (text or "").encode().split()


def brute_stages(spark, rows, sf_dir, outputs):
    """Each stage's rows by plain Python (the toxicity model itself is tested on held-out labels)."""
    first = [r for r in rows if any(c.isalpha() for c in r.text or "")]
    assert Counter(outputs[0]) == Counter(first)

    docs = spark.createDataFrame(first, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).collect()
    assert Counter(outputs[1]) == Counter(r[:-1] for r in scored if r.score < corpus_pipeline.TOXIC)

    order = sorted(outputs[1], key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or ""))
    prints = [brute_fingerprint(r.text) for r in order]
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    kept = {roots[i]: order[i] for i in range(len(order) - 1, -1, -1)}
    assert Counter(outputs[2]) == Counter(kept.values())

    size, source = Counter(), {}
    for r in outputs[2]:
        size[r.source] += len(words(r.text))
        source[r.doc_id] = r
    names = sorted(size, key=lambda s: (s is None, s or ""))
    own = [mixing.Source(s, i, size[s], 1, float((5, 2, 1)[i % 3])) for i, s in enumerate(names)]
    mixing.targets(own)
    taken, per_doc = Counter(), Counter()
    for r in outputs[3]:
        taken[r.source] += len(words(r.text))
        per_doc[r.doc_id] += len(words(r.text))
        assert Counter(words(r.text)) <= Counter(words(source[r.doc_id].text)) and r.n_chars == len(r.text)
    for s in own:
        assert abs(taken[s.name] - s.target) <= max(2 * mixing.BLOCK, 0.02 * s.target)
    assert all(n <= 2 * len(words(source[i].text)) for i, n in per_doc.items())

    ref = reference()
    want = Counter((r.doc_id, np.array(ref.encode_ordinary(r.text), "<u4").tobytes()) for r in outputs[3])
    assert Counter((r.doc_id, bytes(r.ids)) for r in outputs[4]) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in outputs[4])


def run_stages(spark, sf_dir):
    docs, outputs = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), f"test-{name}")
        outputs.append(docs.collect())
    return outputs


def test_pipeline_against_brute_force(spark, sf_dir):
    outputs = run_stages(spark, sf_dir)
    brute_stages(spark, table(spark, sf_dir, "documents").collect(), sf_dir, outputs)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "simhash_near_dedup", "mixing", "byte_bpe"]
    whole = entry.queries()["pipeline"](spark, sf_dir).collect()
    key = lambda rows: Counter((r.doc_id, hashlib.sha256(r.ids).digest()) for r in rows)
    assert key(whole) == key(outputs[-1])


def test_pipeline_on_odd_rows(spark, sf_dir):
    d = local_path(scratch_path(spark, "odd"))
    text = "The the and of words stand here in a row for the test of the stages."
    rows = [(1, text, "en", "a", 1), (2, text, "en", None, 1), (2, text, "en", None, 1), (None, text + " More words.", None, "b", None),
            (3, None, None, None, None), (4, "", "en", "a", 0), (5, "123 456", "en", "a", 7), (6, "Lang " * 30000, "de", "b", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint") \
        .write.parquet(f"{d}/documents.parquet")
    shutil.copy(f"{sf_dir}/labels.parquet", f"{d}/labels.parquet")
    brute = run_stages(spark, d)
    assert len(brute[0]) == 5 and sorted(r.doc_id for r in brute[2] if r.doc_id is not None) == [1, 6]
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint") \
        .write.parquet(f"{d}/none/documents.parquet")
    shutil.copy(f"{sf_dir}/labels.parquet", f"{d}/none/labels.parquet")
    assert all(rows == [] for rows in run_stages(spark, f"{d}/none"))


def test_stages_leave_clashing_columns_alone(spark, sf_dir):
    names = ["_lang", "_score", "__lang", "_mix_n", "_mix_cuts", "_mix_size", "_mix_hash", "_mix_number", "_mix_round", "_mix_doc_id",
             "_simhash_a", "_simhash_b", "_simhash_text", "_simhash_id", "_MIX_Words", "component_id", "fp"]
    docs = table(spark, sf_dir, "documents").where("doc_id < 60").selectExpr(
        "*", *(f"concat('{n}', doc_id) AS `{n}`" for n in names))
    docs = written(docs, "clashing")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"clashing-{name}")
        assert docs.columns[-len(names):] == names
    rows = docs.collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


CONTRACT = {
    "op1_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2_winnowing": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3_toxicity": "doc_id held_out score predicted",
    "op5_mixing": "doc_id size source_size target taken",
    "op6_html_extraction": "page_id url text n_chars",
    "op7_language_id": "doc_id held_out lang_pred score",
    "op8_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op9_bitsliced_topk": "query_id rank vec_id score",
    "op10_simhash": "doc_id fingerprint component_id",
    "op12_jaccard_join": "doc_id n_shingles component_id",
    "op13_resampling": "doc_id n_features weight score rank",
    "op4_packing": "row n_tokens doc_ids parts cu_seqlens ids_sha256 positions_sha256",
}


def test_queries_return_what_they_should(spark, sf_dir):
    queries = entry.queries()
    out = {n: queries[n](spark, sf_dir) for n in CONTRACT}
    assert {n: d.columns[:len(CONTRACT[n].split())] for n, d in out.items()} == {n: c.split() for n, c in CONTRACT.items()}
    rows = {n: d.collect() for n, d in out.items()}
    docs = {r.doc_id: r for r in table(spark, sf_dir, "documents").collect()}
    assert all(len(rows[n]) == len(docs) for n in CONTRACT if n not in ("op4_packing", "op6_html_extraction", "op9_bitsliced_topk"))
    ref = reference()
    for r in rows["op1_byte_bpe"]:
        ids = ref.encode_ordinary(docs[r.doc_id].text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].text.encode()).hexdigest()
    parts = {}
    for r in rows["op4_packing"]:
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 2048
        for d, p, a, b in zip(r.doc_ids, r.parts, r.cu_seqlens, r.cu_seqlens[1:]):
            parts[d, p] = ref.encode_ordinary(docs[d].text)[2048 * p:2048 * (p + 1)]
            assert len(parts[d, p]) == b - a
        flat = np.zeros(2048, "<u4")
        place = np.zeros(2048, "<u4")
        flat[:r.n_tokens] = sum((parts[k] for k in zip(r.doc_ids, r.parts)), [])
        place[:r.n_tokens] = np.concatenate([np.arange(b - a) for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:])])
        assert (r.ids_sha256, r.positions_sha256) == tuple(hashlib.sha256(x.tobytes()).hexdigest() for x in (flat, place))
    assert sum(map(len, parts.values())) == sum(r.n_tokens for r in rows["op1_byte_bpe"])
    order = sorted(docs)
    want = dict(zip(order, edited([docs[i].text for i in order])))
    assert all(r.edited_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest() for r in rows["op2_winnowing"])
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows["op3_toxicity"])
    assert all(r.predicted == int(r.score >= 0.7) for r in rows["op3_toxicity"])
    held = [r for r in rows["op7_language_id"] if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows["op7_language_id"])
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.95
    for r in rows["op8_sharding"]:
        text = docs[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.law) == (len(text) + 16, zlib.crc32(text), "key")
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
    roots = brute_components([int(r.fingerprint, 16) for r in sorted(rows["op10_simhash"])],
                             lambda a, b: (a ^ b).bit_count() <= 4)
    assert [order[k] for k in roots] == [r.component_id for r in sorted(rows["op10_simhash"])]
    assert all(int(r.fingerprint, 16) == brute_fingerprint(docs[r.doc_id].text) for r in rows["op10_simhash"])

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_dir}/embeddings.parquet')")
    cur = con.execute(entry.oracle_sql()["op9_bitsliced_topk"])
    assert [d[0] for d in cur.description] == CONTRACT["op9_bitsliced_topk"].split()
    assert sorted(cur.fetchall()) == sorted(map(tuple, rows["op9_bitsliced_topk"]))


def test_language_stage_keeps_all_that_have_a_letter(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.learn(docs)).where("lang_pred = 'und'").collect()
    assert all(not any(c.isalpha() for c in r.text or "") for r in found)
