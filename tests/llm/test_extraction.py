"""HTML extraction: the reader, the trees, the decoding, and held-out layouts."""

from __future__ import annotations

import html
import re

import numpy as np
import pytest

from storylens.llm import dom, extraction
from storylens.llm.trees import Boosted


@pytest.fixture(scope="module")
def sources(spark, sf_dir):
    return [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id").select("html").collect()]


@pytest.fixture(scope="module")
def extractor(sources):
    return extraction.train(sources)


def article(source):
    parts = re.split(r"</?(?:p|h1)>|<br>", re.search(r"<article>(.*?)</article>", source, re.S)[1])
    parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts]
    return "\n".join(p for p in parts if p)


def runs(source):
    return [t for t in dom.read(source).text if t]


def test_reader_of_blocks():
    assert runs("<ul><li>a<li>b <b>c</b></ul><p>x<p>y<div>z</div>w") == ["a", "b c", "x", "y", "z", "w"]
    assert runs("<table><tr><td>1<td>2<tr><td>3</table>after") == ["1", "2", "3", "after"]
    assert runs("<p><b>one<br>two<p>three</b> more") == ["one two", "three more"]
    assert runs("a&nbsp;&amp; &eacute;&#x41;\n\t b") == ["a & éA b"]
    assert runs("<script>if (a < b) '</p>'</script>t<style>p{}</style><!-- <p>no</p> -->") == ["t"]
    assert runs("<head><title>t</title><body>x") == ["x"] and runs("<script>never closed") == []
    assert runs('<p title="a > b">x</p><p title=\'>\'>y') == ["x", "y"] and runs("1 < 2 <") == ["1 < 2 <"]
    assert runs("") == [] and runs("<") == ["<"]
    assert dom.attribute_tokens(" class='post-Body adBox' id=side_bar role=main") == ("post", "body", "ad", "box", "side", "bar", "main")


def test_links_and_controls():
    page = dom.read("<div>ab<a href=x>cde</a></div><form><input><button>go</button></form>")
    assert page.linked[page.tag.index("#text")] == 3 and page.controls[page.tag.index("form")] == 2


def test_boosted_trees_learn_a_rule():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 5))
    y = np.where(x[:, 1] > 0.6, 2, (x[:, 3] > 0.5).astype(int))
    trees = Boosted(x[:2000], y[:2000], 3, rounds=20)
    assert (trees.log_probabilities(x[2000:]).argmax(1) == y[2000:]).mean() > 0.95


def test_decoding_has_no_contradictions_and_is_the_most_likely():
    # brute force over all states of a small tree
    from itertools import product

    rng = np.random.default_rng(1)
    parent = np.array([-1, 0, 1, 1, 0, 4, 4])
    leaf = np.array([False, False, True, True, False, True, True])
    for _ in range(40):
        p = rng.random((7, 3)) + 0.01
        log_p = np.log(p / p.sum(1, keepdims=True))
        best, kept = -np.inf, None
        for states in product(range(3), repeat=7):
            if any(leaf[i] and s == extraction.MIXED for i, s in enumerate(states)):
                continue
            if any(i and states[parent[i]] != extraction.MIXED and states[i] != states[parent[i]] for i in range(7)):
                continue
            total = sum(log_p[i, s] for i, s in enumerate(states))
            if total > best:
                best, kept = total, [leaf[i] and s == extraction.KEEP for i, s in enumerate(states)]
        assert extraction.decode(log_p, parent, leaf).tolist() == kept


def test_pages_give_their_articles(sources, extractor):
    assert extractor.texts(sources) == [article(s) for s in sources]


def test_held_out_layouts(sources, extractor):
    want_chars = wrong = 0
    for k, s in enumerate(sources):
        rng = np.random.default_rng(5000 + k)
        paragraphs = article(s).split("\n")[1:][:int(rng.integers(1, 20))]
        if not paragraphs:
            continue
        made = extraction.Layouts(rng, paragraphs).page()
        want = [t.replace(extraction.MARK, "") for t in runs(made) if extraction.MARK in t]
        got = extractor.texts([made.replace(extraction.MARK, "")])[0].split("\n")
        want_chars += sum(map(len, want))
        wrong += sum(map(len, set(want) ^ set(got)))
    assert wrong < 0.05 * want_chars


def test_extract_edge_cases(spark, sources, extractor):
    rows = [(1, None), (2, ""), (3, "just text, no tags"), (4, sources[0]), (4, sources[0]), (None, "<nav><a href=x>m</a></nav>"),
            (5, "<article>" + "<p>word word, word.</p>" * 20000 + "</article>"), (6, "<div>" * 3000 + "deep")]
    frame = spark.createDataFrame(rows, "page_id bigint, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = extraction.extract(frame, extractor).collect()
    assert len(got) == len(rows) and got[0].text == "" and got[1].text == "" and got[3].text == got[4].text == article(sources[0])
    assert got[6].text == "\n".join(["word word, word."] * 20000)
    assert [r.text for r in extraction.extract(frame, None).collect()] == [""] * len(rows)
    assert extraction.fit(frame.limit(0)) is None and extraction.extract(frame.limit(0), extractor).count() == 0


def test_training_is_the_same_again(sources, extractor):
    again = extraction.train(sources)
    assert again.texts(sources[:5]) == extractor.texts(sources[:5]) and again.words == extractor.words


def test_long_pages_alone_are_trained_on(spark, monkeypatch):
    long = ["<nav><a href=x>menu</a></nav><article>" + f"<p>Page {i} has many words, all of them its own.</p>" * 60 + "</article>" for i in range(3)]
    monkeypatch.setattr(extraction, "LONGEST", 500)
    frame = spark.createDataFrame(list(enumerate(long)), "page_id bigint, html string")
    got = extraction.extract(frame, extraction.fit(frame)).orderBy("page_id").collect()
    assert [r.text for r in got] == ["\n".join([f"Page {i} has many words, all of them its own."] * 60) for i in range(3)]


def test_copies_do_not_thin_the_sample(spark, sources, monkeypatch):
    taken = []
    monkeypatch.setattr(extraction, "train", taken.extend)
    frame = spark.createDataFrame([(s,) for s in sources[:8] for _ in range(500)], "html string")
    extraction.fit(frame)
    assert taken == sorted(set(sources[:8]))
    taken.clear()
    extraction.fit(frame, sample=3)
    assert len(taken) == 3


def test_pages_without_paragraphs_still_train():
    linked = "<div><a href=x>only a link, and one more</a></div>"
    for sample in ([linked], ["<img src=x>"], []):
        own = extraction.train(sample)
        assert own.texts(["<nav><a href=x>m</a></nav><article><p>" + "Some words, and then more of them. " * 9 + "</article>"])[0]
