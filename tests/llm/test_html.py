import html as entities
import itertools
import random
import re

import numpy as np
import pytest

from calipers.llm import html as h


def test_blocks():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
    <nav class='Main-Menu'><a href="/">Home</a></nav><!-- <p>no</p> --><article><h1>A &amp; B</h1><p>one<br>two &lt;3\n  x<p>three
    <b>bold</b>&nbsp;end</article><p hidden>secret</p><textarea><p>no</p></textarea>tail <i"""
    got = h.blocks_of(page)
    assert [b.text for b in got] == ["T", "Home", "A & B", "one two <3 x", "three bold end", "secret", "tail"]
    assert got[1].names == {"main", "menu"} and got[1].links == 4 and "hidden" in got[5].names
    assert got[3].above[-2:] == ("article", "p") and got[-1].above == ("html", "body")


def test_viterbi_against_all_sequences():
    rng = np.random.default_rng(4)
    for n in range(1, 8):
        s, steps, first = rng.normal(size=n), rng.normal(size=(2, 2)), rng.normal(size=2)
        value = lambda y: first[y[0]] + sum(s[i] * y[i] for i in range(n)) + sum(steps[a][b] for a, b in itertools.pairwise(y))  # noqa: E731, B023
        assert h.viterbi(s, steps, first) == list(max(itertools.product((0, 1), repeat=n), key=value))


def test_gradient_against_differences():
    rng = np.random.default_rng(5)
    n = 5
    s, steps, first, gold = rng.normal(size=n), rng.normal(size=(2, 2)), rng.normal(size=2), rng.integers(0, 2, n)

    def likelihood(s, steps, first):
        value = lambda y: first[y[0]] + sum(s[i] * y[i] for i in range(n)) + sum(steps[a][b] for a, b in itertools.pairwise(y))
        return value(gold) - np.logaddexp.reduce([value(y) for y in itertools.product((0, 1), repeat=n)])

    d_node, d_steps, d_first = h._gradient(s, steps, first, gold)
    for i in range(n):
        up = s.copy()
        up[i] += 1e-6
        assert abs((likelihood(up, steps, first) - likelihood(s, steps, first)) / 1e-6 - d_node[i]) < 1e-4
    for a in range(2):
        for b in range(2):
            up = steps.copy()
            up[a, b] += 1e-6
            assert abs((likelihood(s, up, first) - likelihood(s, steps, first)) / 1e-6 - d_steps[a, b]) < 1e-4
        up = first.copy()
        up[a] += 1e-6
        assert abs((likelihood(s, steps, up) - likelihood(s, steps, first)) / 1e-6 - d_first[a]) < 1e-4


def plain_article(source):
    body = source[source.index("<article>"):source.index("</article>")]
    parts = (" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1|article)>", body))
    return "\n".join(p for p in parts if p)


def test_pages_and_unseen_layouts(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pages.collect()
    got = {r.page_id: r for r in h.extract_rows(pages).collect()}
    assert len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert sum(got[r.page_id].text == plain_article(r.html) for r in rows) >= 0.97 * len(rows)
    sources = [r.html for r in rows]
    model = h.train(h.labelled_pages(sources[:100]))
    wrong = total = 0
    for blocks in h.labelled_pages(sources[100:160], 4, seed=99):
        found = h.viterbi(model.scores(h.features(blocks)), model.steps, model.first)
        known = h.viterbi(model.block_scores(blocks, {}), model.steps, model.first)
        assert found == known
        wrong += sum(a != b.gold for a, b in zip(found, blocks, strict=True))
        total += len(blocks)
    assert wrong <= 0.03 * total


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p"), (4, "u", "plain words only"), (None, None, "<p>x</p>"), (None, None, "<p>x</p>"),
            (5, "u", "<div>" * 20_000 + "deep"), (6, "u", "&#x;&#99999999;&bogus; &lt"), (7, "u", "".join(rng.choice("<>/p a\"'=!-") for _ in range(5_000)))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text")
    got = h.extract_rows(pages).collect()
    assert len(got) == len(rows) and all(r.text is not None for r in got)
    assert h.extract_rows(pages.limit(0)).count() == 0


def without_marks(source):
    return re.sub(r"<(/?)article>", lambda m: "</div>" if m[1] else '<div class="content">', source)


def test_tables_without_or_with_few_labelled_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").limit(100).collect()
    want = [plain_article(r.html) for r in rows]
    for keep in (0, 5):
        pages = spark.createDataFrame(
            [(r.page_id, r.html if i < keep else without_marks(r.html)) for i, r in enumerate(rows)], "page_id long, html string"
        )
        model = h.fit(pages)
        got = [h.main_text(r.html, model) for r in pages.orderBy("page_id").collect()]
        assert sum(set(a.split("\n")) <= set(b.split("\n")) for a, b in zip(want, got, strict=True)) >= 0.8 * len(want)


def test_sample_is_drawn_among_labelled_pages(spark, monkeypatch):
    drawn = []
    monkeypatch.setattr(h, "train", drawn.append)
    rows = [(i, "<article><p>one</p></article>" if i % 100 == 0 else "<p>none</p>") for i in range(3_000)]
    h.fit(spark.createDataFrame(rows, "page_id long, html string"), most=30)
    assert sum([b.text for b in blocks] == ["one"] for blocks in drawn[0]) >= 30


def test_foreign_elements_that_close_themselves():
    page = '<p>one <svg class="i"/>two</p><math/><p>three<svg a="/>"><p>no</p></svg> four<svg><p>no</p></svg></p><svg d=\'x\' /><p>five</p>'
    assert [b.text for b in h.blocks_of(page)] == ["one two", "three four", "five"]


ARTICLE = "<h1>About tides</h1><p>The first part tells of it.</p><p>The second part, too.</p>"
TEXTS = ["About tides", "The first part tells of it.", "The second part, too."]


@pytest.mark.parametrize("page", [
    '<article class="x"">' + ARTICLE + "</article>", "<article title=it's>" + ARTICLE + "</article>", "<!--><article>" + ARTICLE + "</article>",
    "<!---><article>" + ARTICLE + "</article>", '<article a"b c\'d>' + ARTICLE + "</article>", '<article class="a"class=b x=>' + ARTICLE + "</article>",
    "<article data-x = 'a > b' y=\"c > d\">" + ARTICLE + "</article>", '<svg a=b" /><article>' + ARTICLE, "<article =\">" + ARTICLE,
    "<article a==b>" + ARTICLE, "<!-- a -- > b --!><article>" + ARTICLE,
])
def test_bad_markup_keeps_the_article(page):
    got = h.blocks_of("<body>" + page + "</body>")
    assert [b.text for b in got] == TEXTS and all("article" in b.above for b in got)


def test_bare_signs_and_open_values():
    assert [b.text for b in h.blocks_of("<p>a < b and c <3 d</p><p>e</p>")] == ["a < b and c <3 d", "e"]
    assert [b.text for b in h.blocks_of('<p>a</p><p title="open>b</p>')] == ["a"]


def nested(source, rng):
    """A page with reader comments, a form and an aside put inside its article element, and their texts."""
    parts = [
        '<div class="comments"><p>Reader one does not agree.</p><p>Reader two says so as well.</p></div>',
        '<form action="/s"><label>Your mail address</label><button>Send it</button></form>', "<aside><p>See what others have read today.</p></aside>",
    ]
    at = source.index("</article>")
    rng.shuffle(parts)
    return source[:at] + "".join(parts) + source[at:]


def test_parts_inside_the_article_are_left_out(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").select("html").limit(160).collect()
    rng = random.Random(3)
    sources = [nested(r.html, rng) for r in pages if "</article>" in r.html]
    model = h.train(h.labelled_pages(sources[:60]))
    found = wrong = missed = 0
    for source in sources[60:]:
        got = set(h.main_text(source, model).split("\n"))
        want = {b.text for b in h.blocks_of(source) if h.inside_article(b)}
        found, wrong, missed = found + len(got & want), wrong + len(got - want), missed + len(want - got)
        assert not got & {"Reader one does not agree.", "Send it", "See what others have read today."}
    assert 2 * found / (2 * found + wrong + missed) > 0.97
