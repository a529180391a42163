"""The reader of HTML: what hidden elements end with."""

from __future__ import annotations

import pytest

from storylens.llm import dom


def runs(source):
    return [t for t in dom.read(source).text if t]


@pytest.mark.parametrize("source, want", [
    ("<head><title>t</title><meta charset=x><style>p{}</style><p>a</p><p>b</p>", ["a", "b"]),
    ("<html><head><title>t</title></head><body>x", ["x"]),
    ("<div><svg><path d=x></div><p>after</p>", ["after"]),
    ("<svg><text>no</text><p>after</p>", ["after"]),
    ("<svg><g><svg><text>no</text></svg><text>no</text></g></svg>yes", ["yes"]),
    ("<svg><foreignObject><div>no</div></foreignObject></svg>yes", ["yes"]),
    ("<div>a<noscript><img src=x></div><p>b", ["a", "b"]),
    ("<section><object data=x><p>no</p></section>yes", ["yes"]),
    ("<div><template><div>no</div></div><p>yes</p></template>", ["yes"]),
    ("<p>a<noscript><p>no</p><a href=x>no</a></noscript> b", ["a b"]),
    ("<div>a<noscript><p>no</noscript> b<p>c</div>", ["a b", "c"]),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</article>", ["Let x=2 be."]),
    ("<script>if (a < b) '<p>no'", []),
])
def test_hidden_elements_end_with_what_is_around_them(source, want):
    assert runs(source) == want


@pytest.mark.parametrize("source, want", [
    ("<p>a</p><!--><p>b</p>", ["a", "b"]),
    ("<p>a</p><!---><p>b</p>", ["a", "b"]),
    ("<p>a</p><!-- x --!><p>b</p><!-- never <p>c</p>", ["a", "b"]),
    ("<p>a</p><!-- -> <p>no</p> --><p>b</p>", ["a", "b"]),
    ('<p title="x>a</p><p title="y">b</p>', ["b"]),
    ('<p>a</p><p title="x>b</p>', ["a", "b"]),
    ("<p title='x>y'>a</p>", ["a"]),
    ("<p title=it's>a</p><p>b</p>", ["a", "b"]),
    ('<p data-x=5" id=y>a</p>', ["a"]),
    ("<p>a</p><p class='x", ["a"]),
    ("<p>1 < 2 and <3</p>", ["1 < 2 and <3"]),
])
def test_comments_and_quotes_end_as_in_browsers(source, want):
    assert runs(source) == want


def test_long_open_tags_take_linear_time():
    assert runs("<p>a</p>" + "<p x=" * 20_000) == ["a"]
    assert runs("<p>a</p><p " + "x='y" * 20_001 + "><p>b") in (["a", "b"], ["a"])
