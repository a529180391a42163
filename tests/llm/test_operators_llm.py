"""The training-data operators against brute force, and on nulls, empty and long texts, ties, repeated rows,
empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from storylens.llm import bitsliced, bpe, components, langid, mixing, sharding, simhash, toxicity, winnowing
from storylens.llm.kneser_ney import Ratios, _spelled, logistic, ngrams
from tests_llm_brute import brute_components, brute_fingerprint, edited, reference

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"wort{i % 977} und{i % 13}" for i in range(60_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a", 1),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a", 1),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a", 1),
    (3, "", "en", None, 0),
    (4, None, None, "b", None),
    (5, "  \n\t ", "de", "b", 5),
    (6, LONG, "de", "ä", len(LONG)),
    (7, "Straße über Größe, naïve 日本語 😀 don't 123 it's\r\n\r\n  x", "de", "b", 3),
    (8, "one", None, None, 3),
    (None, "text without an id stands here alone", "en", "a", 9),
    (9, "1234 5678 !!! ...", "en", "c", 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    # names that operators use for their outputs and inner columns
    extra = {c: "0" for c in ("ids", "fp", "score", "text_crc32", "shard", "slot", "bucket", "place", "size", "n", "marks",
                              "block", "range", "label", "fold", "a", "b", "root", "row")}
    from pyspark.sql import functions as F

    return spark.createDataFrame(ROWS, DOCS).withColumns({k: F.lit(v) for k, v in extra.items()})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# byte-level BPE

def test_bpe_equals_tiktoken(docs):
    ref = reference()
    rows = bpe.decode(bpe.encode(docs)).select("doc_id", "text", "ids", "decoded").collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == ref.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_bpe_on_random_texts():
    ref = reference()
    tokens = bpe.read_ranks(bpe.VOCABULARY)
    own = bpe.Encoder(tokens, bpe.merge_table(tokens), public_tokenizers.PATTERN)
    rng = np.random.default_rng(1)
    pieces = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "1", "!", "'s", "\x1c", "\x85", "\xa0", "日", "😀", "½", "_",
              "<|endoftext|>", "ing", " the", "\r\n", "aaaaaaaa", "        ", "́", " "]
    texts = ["".join(rng.choice(pieces, rng.integers(0, 50))) for _ in range(1500)]
    texts += ["a" * 3000, " " * 3000, "=-" * 2000, "".join(map(chr, rng.integers(32, 0x2FFF, 4000)))]
    for t in texts:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == ref.encode_ordinary(t), t[:80]
        assert own.decode(own.encode(t)) == t.encode()


def test_bpe_of_texts_together(monkeypatch):
    # new words of many texts are merged side by side: only long ones are encoded one at a time
    ref = reference()
    tokens = bpe.read_ranks(bpe.VOCABULARY)
    own = bpe.Encoder(tokens, bpe.merge_table(tokens), public_tokenizers.PATTERN)
    alone, rng = [], np.random.default_rng(2)
    one = own.encode_piece
    monkeypatch.setattr(own, "encode_piece", lambda p: alone.append(p) or one(p))
    syllables = ["an", "th", "Ein", "é", "ß", "日", "ab", "a", "a", ",", "\n", "7"]
    words = ["".join(rng.choice(syllables, rng.integers(1, 30))).strip("\n") for _ in range(3000)]
    texts = [" ".join(rng.choice(words, rng.integers(0, 60))) for _ in range(200)]
    texts += ["", "x", " y", "tab\there", "two  spaces", "a" * 65, "b " + "a" * 1000 + "!"] + words[:50]
    want = [ref.encode_ordinary(t) for t in texts]
    for together in (bpe.TOGETHER, 500, 1):
        monkeypatch.setattr(bpe, "TOGETHER", together)
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_all(texts)] == want
    assert b"a" * 65 in alone and b" " + b"a" * 1000 in alone
    assert min(map(len, alone)) > 64
    assert own.encode_all([]) == []


def test_bpe_of_a_pattern_with_spaces_inside():
    tokens = bpe.read_ranks(bpe.VOCABULARY)
    own = bpe.Encoder(tokens, bpe.merge_table(tokens), r"\w+ \w+|.|\n")
    ids = np.frombuffer(own.encode("of the two words"), "<u4").tolist()
    assert ids == own.encode_piece(b"of the") + own.encode_piece(b" ") + own.encode_piece(b"two words")


def test_bpe_small_vocabulary():
    # compatible pairs against plain merges, over all short strings of two letters
    tokens = [bytes([i]) for i in range(256)] + [b"ab", b"aa", b"aab", b"ba", b"abab", b"bb"]
    ranks = {t: i for i, t in enumerate(tokens)}
    own = bpe.Encoder(tokens, bpe.merge_table(tokens), r".+")
    for n in range(1, 9):
        for k in range(2 ** n):
            s = bytes(b"ab"[(k >> i) & 1] for i in range(n))
            want = [ranks[p] for p in bpe.plain_merges(s, ranks)[0]]
            assert own.encode_piece(s) == ([ranks[s]] if s in ranks else want)


def test_bpe_side_by_side_small_vocabulary():
    # all short strings of two letters at once; overlapping pairs merge from the left
    tokens = [bytes([i]) for i in range(256)] + [b"ab", b"aa", b"aab", b"ba", b"abab", b"bb"]
    ranks = {t: i for i, t in enumerate(tokens)}
    own = bpe.Encoder(tokens, bpe.merge_table(tokens), r".+")
    strings = [bytes(b"ab"[(k >> i) & 1] for i in range(n)) for n in range(1, 9) for k in range(2 ** n)]
    want = [[ranks[p] for p in bpe.plain_merges(s, ranks)[0]] for s in strings]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_all([s.decode() for s in strings])] == want
    # a token that no merge reaches stands for a whole piece; a byte that is no token is an error
    tokens = [bytes([i]) for i in range(255)] + [b"ab", b"xyz", b"aba"]
    own = bpe.Encoder(tokens, bpe.merge_table(tokens), r"\S+|\s")
    assert np.frombuffer(own.encode("xyz xyzx aba"), "<u4").tolist() == [256, 32, 120, 121, 122, 120, 32, 257]
    with pytest.raises(ValueError):
        bpe.Encoder([b"a", b"b"], [None, None], r"\S+|\s").encode("abc")


def test_bpe_ranks_must_be_gapless(tmp_path):
    path = tmp_path / "bad.tiktoken"
    path.write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(str(path))


def test_bpe_empty(empty):
    assert bpe.decode(bpe.encode(empty)).count() == 0


# winnowing

def test_winnow_windows():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n, window = int(rng.integers(0, 60)), int(rng.integers(1, 12))
        h = rng.integers(0, 6, n).astype(np.uint64)
        w, want = min(window, n), []
        for s in range(n - w + 1 if n else 0):
            p = s + w - 1 - int(np.argmin(h[s:s + w][::-1]))
            if not want or want[-1] != p:
                want.append(p)
        assert winnowing.winnow(h, window).tolist() == want


def test_rolling_hash_is_a_polynomial():
    codes = np.random.default_rng(2).integers(0, 500, 50).astype(np.uint32)

    def one(run):
        r = 0
        for c in winnowing._mixed(run.astype(np.uint64) + np.uint64(1)).tolist():
            r = (r * int(winnowing.BASE) + c) % 2**64
        return int(winnowing._mixed(np.array([r], np.uint64))[0])

    with np.errstate(over="ignore"):
        for g in (1, 2, 3, 7, 16, 21):
            assert winnowing.rolling(codes, g).tolist() == [one(codes[i:i + g]) for i in range(len(codes) - g + 1)]


def test_shared_passage_leaves_a_common_mark():
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(400)]
    for _ in range(50):
        passage = "".join(rng.choice(words, 20))[:winnowing.WINDOW + winnowing.GRAM - 1]
        a, b = ("".join(rng.choice(words, 30)) + passage + "".join(rng.choice(words, 30)) for _ in range(2))
        assert set(winnowing.marks(a)[0]) & set(winnowing.marks(b)[0])


def test_against_next(docs):
    rows = winnowing.against_next(docs).collect()
    order = sorted(((r[0] if r[0] is not None else -2**63, r[1] or "") for r in ROWS))
    want = Counter(zip((i for i, _ in order), edited([t for _, t in order])))
    assert Counter((r.doc_id if r.doc_id is not None else -2**63, r.edited) for r in rows) == want
    by_text = defaultdict(set)
    for r in rows:
        if r.doc_id in (1, 2):
            by_text[r.n_chars].add((bytes(r.marks), bytes(r.positions)))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(v) == 1 for v in by_text.values())


def test_against_next_single_and_empty(spark, empty):
    assert winnowing.against_next(empty).count() == 0
    r = winnowing.against_next(spark.createDataFrame([(5, "abcdef", None, None, None)], DOCS)).first()
    assert r.edited == "abcabc" and r.near_next == 1.0


def test_hot_ids_and_slots_of_a_mix_spread(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(None if i % 3 == 0 else i, " ".join(map(str, rng.integers(0, 99, 40))), "en", "a" if i % 2 else "b", 1) for i in range(600)]
    rows += [rows[0]] * 5 + [rows[1]] * 5
    docs = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(mixing, "PIECE", 64)  # pieces are cut by the planner's side, which workers then fill
    m = mixing.mix(docs)
    numbers = [(r.doc_id, r.n) for r in m.rows.collect()]
    assert len(set(numbers)) == len(rows)
    assert len({n % mixing.PARTS for i, n in numbers if i is None}) > 50  # parts that different tasks number
    assert m.slots.rdd.glom().filter(len).count() > 1
    slots = [(r.shard, r.slot) for r in m.slots.collect()]
    assert len(set(slots)) == len(slots)
    words = Counter(t for r in mixing.documents_of(m, docs).collect() for t in (r.text or "").split())
    taken = sum(r.taken for r in mixing.taken(m).collect())
    assert sum(words.values()) == taken > 0
    with pytest.raises(ValueError, match="sources"):
        monkeypatch.setattr(mixing, "SOURCES", 1)
        mixing.mix(docs)


def test_hot_ids_fill_many_ranges(spark):
    rng = np.random.default_rng(6)
    rows = [(None if i % 3 == 0 else 77 if i % 3 == 1 else int(i), f"text {rng.integers(1 << 40)}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = [r for r in winnowing.in_order(frame).collect() if not r.after]
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    by_range = defaultdict(list)
    for r in found:
        by_range[r.range].append(-1 if r.doc_id is None else r.doc_id)
    assert max(map(len, by_range.values())) < 600 and len(by_range) > 10
    assert sum(-1 in ids for ids in by_range.values()) > 2 and sum(77 in ids for ids in by_range.values()) > 2
    order = [i for k in sorted(by_range) for i in sorted(by_range[k])]
    assert order == sorted(order)
    pairs = winnowing.against_next(frame).select("doc_id", "n_chars").collect()
    assert len(pairs) == 3000


# toxicity

def toxic_rows(n=600):
    rng = np.random.default_rng(4)
    syllables = ["ba", "ko", "li", "mu", "te", "ra", "sin", "dor", "vel", "pa"]

    def word():
        return "".join(rng.choice(syllables, rng.integers(1, 4)))

    docs, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = [word() for _ in range(60)]
        if bad:  # endings that training has not seen
            for _ in range(3):
                text[int(rng.integers(60))] = "grux" + word()
        docs.append((i, " ".join(text), "en", "a", 0))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity_held_out(spark):
    docs, labels = toxic_rows()
    frame = spark.createDataFrame(docs, DOCS)
    fitted = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    rows = toxicity.score(frame, fitted).collect()
    held = [(r.score, labels[r.doc_id][2]) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([(s >= 0.7) == bool(t) for s, t in held]) > 0.97
    again = toxicity.score(frame, toxicity.fit(frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")))
    assert sorted((r.doc_id, r.score) for r in again.collect()) == sorted((r.doc_id, r.score) for r in rows)


def test_toxicity_ignores_held_out_labels(spark):
    docs, labels = toxic_rows(300)
    frame = spark.createDataFrame(docs, DOCS)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    schema = "doc_id bigint, quality int, toxic int"
    a, b = (toxicity.score(frame, toxicity.fit(frame, spark.createDataFrame(x, schema))).select("doc_id", "score").collect()
            for x in (labels, flipped))
    assert sorted(a) == sorted(b)


def test_toxicity_edge_cases(spark, docs, empty):
    schema = "doc_id bigint, quality int, toxic int"
    none = spark.createDataFrame([], schema)
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    only = spark.createDataFrame([(i, None, 1) for i in (1, 2, 3, 6, 7, 8)], schema)
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, only)).collect()} == {1.0}
    both = spark.createDataFrame([(1, 0, 0), (2, 0, 0), (2, 0, 1), (None, 0, 1), (3, 0, None), (6, 1, 0), (7, 1, 1), (8, 1, 0)], schema)
    scored = toxicity.score(docs, toxicity.fit(docs, both)).collect()
    assert len(scored) == len(ROWS) and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if not (r.text or "").strip()}) == 1
    assert toxicity.score(empty, toxicity.fit(empty, both)).count() == 0


def test_kneser_ney_is_a_distribution():
    words = ["abc", "abd", "bcd", "aab", "cab", "dab"]
    r = Ratios(words, np.array([[5, 9], [7, 2], [4, 4], [9, 3], [0, 8], [6, 0]]), order=3)
    # what neither class has seen speaks for neither
    assert r.score(["zzz"])[0] == pytest.approx(r.score(["zzzz"])[0], abs=1e-9)
    assert r.score(["dab"])[0] > 0 > r.score(["cab"])[0]
    assert len(r.score([])) == 0


def test_toxicity_counts_all_training_rows(spark):
    docs, labels = toxic_rows(300)
    docs += [(1000 + i, docs[i][1], "en", "a", 0) for i in range(3)]  # equal texts train once
    fitted, _ = toxicity.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(
        labels + [(1000 + i, 1, labels[i][2]) for i in range(3)], "doc_id bigint, quality int, toxic int"), toxic=30, ordinary=60)
    words = defaultdict(lambda: [0, 0])
    bad = dict((i, t) for i, _, t in labels + [(1000 + i, 1, labels[i][2]) for i in range(3)])
    texts = {t: bad[i] for i, t, *_ in docs if zlib.crc32(str(i).encode()) % 3 != 1}
    for t, toxic in texts.items():
        for w in set(t.split()):
            words[w][1 - toxic] += 1
    want = Ratios(list(words), np.array(list(words.values())))
    assert fitted.symbols == want.symbols and set(fitted.keys) == set(want.keys)
    for k in want.keys:
        assert fitted.keys[k].tolist() == want.keys[k].tolist() and np.allclose(fitted.ratio[k], want.ratio[k])


def plain_kneser_ney(words, counts, order, wanted):
    """The log ratio of a word by dictionaries: fixed discounts for either class over pooled, estimated lower orders."""
    grams = [defaultdict(lambda: np.zeros(2)) for _ in range(order + 1)]
    for w, c in zip(words, counts):
        w = f"\1{w}\2"
        for k in range(1, order + 1):
            for i in range(len(w) - k + 1):
                if k > 1 or i:
                    grams[k][w[i:i + k]] += c
    symbols = len(grams[1]) + 2
    pooled = []
    for k in range(order + 1):
        if k in (0, order):
            pooled.append({g: c.sum() for g, c in grams[k].items()})
        else:  # how many letters stand before it, but for the start of a word
            before = Counter(g[1:] for g in grams[k + 1])
            pooled.append({g: c.sum() if g[0] == "\1" else before[g] for g, c in grams[k].items()})

    def mixed(table, gram, discount, below):
        context = {g: c for g, c in table.items() if g[:-1] == gram[:-1]}
        total = sum(context.values())
        if not total:
            return below
        back = sum(min(c, discount) for c in context.values()) / total
        return max(context.get(gram, 0) - discount, 0) / total + back * below

    def lower(gram):  # the pooled probability
        if not gram:
            return 1 / symbols
        once, twice = (sum(c == n for c in pooled[len(gram)].values()) for n in (1, 2))
        return mixed(pooled[len(gram)], gram, once / (once + 2 * twice) if once and twice else 0.75, lower(gram[1:]))

    out, w = 0.0, f"\1{wanted}\2"
    for i in range(1, len(w)):
        gram = w[max(0, i - order + 1):i + 1]
        p = [mixed({g: c[k] for g, c in grams[len(gram)].items()}, gram, 2.0, lower(gram[1:])) for k in (0, 1)]
        out += np.log(p[0] / p[1])
    return out


def test_ratios_against_plain_kneser_ney():
    rng = np.random.default_rng(8)
    for letters in ("abc", "aé日本"):
        words = sorted({"".join(rng.choice(list(letters), rng.integers(1, 6))) for _ in range(60)})
        counts = rng.integers(0, 12, (len(words), 2)) + [1, 0]
        spelled = [w.replace("日", "\u0265\u03e5").replace("本", "\u0267\u032c") for w in words]
        for order in (2, 3, 6):
            got = Ratios(words, counts, order).score([*words[:15], "cab", "x"])
            want = [plain_kneser_ney(spelled, counts, order, w) for w in (*spelled[:15], "cab", "x")]
            assert np.allclose(got, want)


def test_all_letters_are_told_apart():
    letters = [chr(c) for c in (*range(0x4e00, 0x4e00 + 2000), 0x20000, 0x20001, 0x10400, 0x3b1, 0x430, 0xe9)]
    _, length = _spelled(letters)
    high, low, _ = ngrams(letters, np.ones((len(letters), 2), int))
    whole = length == 4
    assert len(length) == len(letters) and whole.sum() >= 2000
    r = Ratios([c + "x" for c in letters], np.array([[9, 0] if i % 2 else [0, 9] for i in range(len(letters))]))
    scores = r.score([c + "x" for c in letters])
    assert all((s > 0) == bool(i % 2) for i, s in enumerate(scores))


def test_ngram_counts():
    words, n = ["abcabc", "bca", "日本", "a"], np.array([[1, 0], [2, 5], [0, 3], [4, 4]])
    want = defaultdict(lambda: np.zeros(2, int))
    for w, c in zip(words, n):
        w = "".join(c if ord(c) < 512 else chr(512 + (ord(c) >> 8)) + chr(768 + (ord(c) & 255)) for c in f"\1{w}\2")
        for k in range(1, 7):
            for i in range(len(w) - k + 1):
                if k > 1 or i:
                    want[w[i:i + k]] += c
    high, low, counts = ngrams(words, n)
    got = {"".join(chr(p) for x in (h, l) for p in (x >> 42, x >> 21 & 0x1fffff, x & 0x1fffff) if p): c.tolist()
           for h, l, c in zip(high.tolist(), low.tolist(), counts)}
    assert len(high) == len(got) and got == {w: c.tolist() for w, c in want.items()}


def test_best_cut_meets_the_labels():
    rng = np.random.default_rng(3)
    for _ in range(200):
        found, labels = rng.integers(0, 12, 20).astype(float), rng.integers(0, 2, 20)
        labels[0] = 1

        def f1(cut):
            p = found >= cut
            return 2 * (p & (labels == 1)).sum() / (p.sum() + labels.sum())

        cut = toxicity.best_cut(found, labels)
        assert f1(cut) == max(f1(v) for v in found) and (found != cut).all() or cut == found.min()


def test_logistic_separates():
    x = np.array([[-2.0], [-1.0], [1.0], [2.0]] * 20)
    w = logistic(x, np.array([0, 0, 1, 1] * 20))
    assert w[0] > 1


# language identification

def language_rows():
    rng = np.random.default_rng(5)
    parts = {"xx": ["tor", "gra", "mik", "ul"], "yy": ["sei", "nao", "lua", "mei"], "zz": ["čok", "žrd", "vič", "skr"]}
    rows = []
    for i in range(240):
        lang = list(parts)[i % 3]
        text = " ".join("".join(rng.choice(parts[lang], rng.integers(1, 4))) for _ in range(30))
        rows.append((i, text, lang if i % 7 else None, "a", 0))
    return rows


def test_language_held_out(spark):
    rows = language_rows()
    frame = spark.createDataFrame(rows, DOCS)
    found = {r.doc_id: r for r in langid.predict(frame, langid.learn(frame)).collect()}
    held = [i for i in found if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(found[i].lang_pred == ["xx", "yy", "zz"][i % 3] and 0 <= found[i].score <= 1 for i in held)


def test_language_vectors_are_bundles():
    p = langid.Profiles(dim=64)
    want = np.zeros(64)
    for gram in (" ab", "abc", "bc ", "c d", " de", "de "):
        v = np.ones(64)
        for place, c in enumerate(reversed(gram)):
            v = v * np.roll(p.letter_vector(ord(c)).astype(int), place)
        want += v
    assert p.vectors(["abC, de!"])[0].tolist() == want.tolist()


def test_language_edge_cases(spark, docs, empty):
    frame = spark.createDataFrame(language_rows(), DOCS)
    rows = langid.predict(docs, langid.learn(frame)).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0.0)
    assert {r.lang_pred for r in langid.predict(docs, langid.learn(empty)).collect()} == {"und"}
    assert langid.predict(empty, langid.learn(docs)).count() == 0


# mixing

def water(sizes, weights):
    """The excess shared again and again, in exact steps."""
    from fractions import Fraction

    total, target, open_ = Fraction(3, 2) * sum(sizes), [Fraction(0)] * len(sizes), set(range(len(sizes)))
    left = total
    while open_ and left > 0:
        weight = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / weight for i in open_}
        over = {i for i in open_ if target[i] + share[i] >= 2 * sizes[i]}
        if not over:
            for i in open_:
                target[i] += share[i]
            break
        for i in open_:
            target[i] += share[i]
        left = sum(target[i] - 2 * sizes[i] for i in over)
        for i in over:
            target[i] = Fraction(2 * sizes[i])
        open_ -= over
    return [float(t) for t in target]


def test_targets():
    rng = np.random.default_rng(6)
    for _ in range(100):
        sizes = rng.integers(0, 1000, rng.integers(1, 9)).tolist()
        sources = [mixing.Source(str(i), i, s, 1, float((5, 2, 1)[i % 3])) for i, s in enumerate(sizes)]
        mixing.targets(sources)
        assert [s.target for s in sources] == pytest.approx(water(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))]), abs=1e-6)


def test_permutations_and_draws():
    for n in (1, 2, 3, 10, 257, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 7)) == list(range(n))
    runs = mixing.draws([100, 0, 7, 1000], 5, 1)
    assert [sum(r[3] for r in runs if r[1] == s) for s in range(4)] == [100, 0, 7, 1000]
    assert {sum(r[3] for r in runs if r[0] == k) for k in range(5)} <= {221, 222}


def mix_rows():
    rng = np.random.default_rng(7)
    return ROWS + [(100 + i, " ".join(f"w{j}" for j in range(int(rng.integers(1, 400)))), "en", ["a", "b", "c", None][i % 4], 0)
                   for i in range(80)]


def test_mix(spark):
    rows = mix_rows()
    frame = spark.createDataFrame(rows, DOCS)
    m = mixing.mix(frame, block=8, shards=4)
    got = mixing.taken(m).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len((r[1] or "").encode().split())) for r in rows)
    assert all(r.taken <= 2 * r.size for r in got)
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    assert [s.name for s in m.sources] == names
    for s in m.sources:
        own = {r.doc_id for r in got if r.target == s.target and r.source_size == s.size}
        assert own and abs(sum(r.taken for r in got if r.source_size == s.size and r.target == s.target) - s.target) <= max(64, 0.02 * s.target)
    assert sorted(got, key=str) == sorted(mixing.taken(mixing.mix(frame, block=8, shards=4)).collect(), key=str)
    # slots of a shard are numbered without gaps, and no block is taken more than twice
    slots = m.slots.collect()
    for shard in {r.shard for r in slots}:
        own = sorted(r.slot for r in slots if r.shard == shard)
        assert own == list(range(len(own)))
    assert max(Counter((r.place, r.block) for r in slots).values()) <= 2


def test_mix_documents(spark, docs):
    frame = spark.createDataFrame(mix_rows(), DOCS)
    m = mixing.mix(frame, block=8, shards=4)
    taken = Counter()
    for r in mixing.taken(m).collect():
        taken[r.doc_id] += r.taken
    texts = defaultdict(set)
    for r in mix_rows():
        texts[r[0]] |= set((r[1] or "").split())
    words = Counter()
    for r in mixing.documents_of(m, frame).collect():
        words[r.doc_id] += len(r.text.encode().split())
        assert set(r.text.split()) <= texts[r.doc_id] and r.n_chars == len(r.text)
    assert {k: v for k, v in taken.items() if v} == dict(words)
    assert mixing.taken(mixing.mix(docs)).count() == len(ROWS)


def test_mix_empty(empty):
    m = mixing.mix(empty)
    assert mixing.taken(m).count() == 0 and mixing.documents_of(m, empty).count() == 0


# sharding

def test_shards(spark, docs):
    rows = sharding.write(docs, bucket_bytes=2000).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in ROWS)
    frame = spark.createDataFrame([(i, f"text {i}" * (i % 5), None, None, None) for i in range(3000)], DOCS)
    rows = sharding.write(frame, bucket_bytes=500).collect()
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append((r.slot, r.doc_id))
    assert len(by_shard) == sharding.SHARDS
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in by_shard.values())
    assert any([i for _, i in sorted(v)] != sorted(i for _, i in v) for v in by_shard.values())
    again = sharding.write(frame, bucket_bytes=500).collect()
    assert Counter((r.doc_id, r.shard, r.slot) for r in again) == Counter((r.doc_id, r.shard, r.slot) for r in rows)


def test_one_more_shard_takes_rows_only_into_itself(spark):
    from pyspark.sql import functions as F

    ids = spark.range(5000).select(F.col("id").alias("doc_id")).withColumn("shard", sharding.shard_of(F.col("doc_id")))
    rows = ids.select("shard", sharding.grown_shard(F.col("doc_id"), F.col("shard")).alias("grown"),
                      sharding.shard_of(F.col("doc_id"), sharding.SHARDS + 1).alias("direct")).collect()
    assert all(r.grown == r.direct and r.grown in (r.shard, sharding.SHARDS) for r in rows)
    assert 60 < sum(r.grown == sharding.SHARDS for r in rows) < 190


def test_shards_empty(empty):
    assert sharding.write(empty).count() == 0


def test_sharding_has_no_python(spark, docs):
    plan = sharding.write(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan


# bit-sliced index

def brute_top(vectors, k, every=100):
    out = {}
    for i, q in vectors:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in vectors if j != i)
            out[i] = [(j, -s) for s, j in scores[:k]]
    return out


def test_block_top_with_ties_and_signs():
    rng = np.random.default_rng(8)
    for spread in (2, 50, 3000, 1 << 24):
        ids = rng.permutation(500)[:200]
        vectors = rng.integers(-spread, spread, (200, 7))
        vectors[50:120] = vectors[50]
        block = bitsliced.Block.build(ids, vectors)
        for q in (*vectors[:5], np.zeros(7, np.int64), vectors[60][:4]):
            got = sorted((-s, i) for i, s in zip(*block.top(int(ids[0]), q, 10)))
            want = sorted((-int((v[:len(q)] * q).sum()), i) for i, v in zip(ids, vectors) if i != ids[0])[:10]
            assert got == want


def test_search(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6).astype(np.float32)]) for i in range(450)]
    rows[20:60] = [(i, rows[20][1]) for i, _ in rows[20:60]]
    bad = [(1000, None), (1001, [0.1, None]), (1002, [float("nan")]), (1003, [float("inf")]), (None, [0.1]), (1100, None)]
    frame = spark.createDataFrame(rows + bad + [rows[100]], "vec_id bigint, embedding array<float>")
    vectors = bitsliced.quantised(frame)
    got = bitsliced.search(vectors.where("vec_id % 100 = 0"), bitsliced.index(vectors, rows=64)).collect()
    whole = [(i, [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v]) for i, v in rows + [rows[100]]]
    want = brute_top(whole, 10)
    assert {i: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == i] for i in want} == want
    assert len(got) == 50 and [r.rank for r in sorted(got)][:10] == list(range(1, 11))


def test_search_of_lengths_and_empty(spark):
    schema = "vec_id bigint, embedding array<float>"
    few = bitsliced.quantised(spark.createDataFrame([(0, [0.5]), (1, [0.5, 0.5]), (2, []), (3, [2e9])], schema))
    got = bitsliced.search(few.where("vec_id % 100 = 0"), bitsliced.index(few)).collect()
    assert [(r.vec_id, r.score) for r in sorted(got)] == [(3, 512 * 2_000_000_000 * 1024), (1, 512 * 512), (2, 0)]
    # components beyond 16,384 count in full; scores beyond 64 bits raise
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 60_000, 5).astype(np.float32)]) for i in range(60)]
    large = bitsliced.quantised(spark.createDataFrame(rows, schema))
    got = bitsliced.search(large.where("vec_id % 20 = 0"), bitsliced.index(large, rows=16)).collect()
    want = brute_top([(i, [int(np.floor(1024 * np.float64(x))) for x in v]) for i, v in rows], 10, 20)
    assert {i: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == i] for i in want} == want
    for most in (1e15, 1e30):
        vast = bitsliced.quantised(spark.createDataFrame([(0, [most]), (1, [most])], schema))
        with pytest.raises(Exception, match="64 bits"):
            bitsliced.search(vast.where("vec_id = 0"), bitsliced.index(vast)).collect()
    none = bitsliced.quantised(spark.createDataFrame([], schema))
    assert bitsliced.search(none, bitsliced.index(none)).count() == 0


# SimHash near-duplicates

def test_fingerprints():
    for r in ROWS[:5] + ROWS[7:]:
        assert simhash.fingerprint(r[1] or "") == brute_fingerprint(r[1])
    assert simhash.fingerprint(LONG[:5000]) == brute_fingerprint(LONG[:5000])


def test_position_sets_cover():
    from itertools import combinations

    sets = [set(s) for s in simhash.position_sets()]
    assert len(sets) == 20 and all(any(s <= set(four) for s in sets) for four in combinations(range(8), 4))


def clustered(n, rng):
    centre = rng.integers(0, 2**63, 6).astype(np.uint64)
    out = set()
    while len(out) < n:
        x = int(rng.choice(centre))
        for b in rng.integers(0, 64, rng.integers(0, 8)):
            x ^= 1 << int(b)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("list_size", [2048, 6, 2])
def test_links_have_all_components(spark, monkeypatch, list_size):
    # short lists take the longer postings and the midpoints
    monkeypatch.setattr(simhash, "LIST", list_size)
    rng = np.random.default_rng(list_size)
    fps = clustered(150, rng)
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp bigint")
    roots = {r.fp: r.root for r in simhash._roots(frame).collect()}
    assert len(roots) == len(fps)
    want = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    got = [roots[x - (1 << 64) if x >> 63 else x] for x in fps]
    groups = lambda labels: {frozenset(i for i, x in enumerate(labels) if x == y) for y in labels}
    assert groups(got) == groups(want)


def test_near_duplicates(docs):
    rows = simhash.near_duplicates(docs).collect()
    texts = {(r[0], r[1]) for r in ROWS}
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].component_id == 1 and by_id[4].component_id == 3 and by_id[5].component_id == 3
    assert by_id[3].fingerprint == "0" * 16
    assert {r.fingerprint for r in rows} == {f"{brute_fingerprint(t):016x}" for _, t in texts}


def test_keep_first(docs, empty):
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id) for r in kept.collect())
    assert [i for _, i in ids] == [1, 3, 6, 7, 8, 9, None]
    assert simhash.keep_first(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_sha_of_packed_ids(docs):
    r = bpe.encode(docs).where("doc_id = 8").first()
    assert hashlib.sha256(r.ids).hexdigest() == hashlib.sha256(np.array(reference().encode_ordinary("one"), "<u4").tobytes()).hexdigest()
