from __future__ import annotations

import numpy as np
import pytest

from rollstate.llm import dom, html_text, page_templates, queries


def test_held_out_templates():
    trees, right, wrong = html_text.train(), 0, 0
    for source, labels in page_templates.pages(80, seed=2_024):
        page = dom.parse(source)
        assert len(page.tags) == len(labels)
        got = html_text.decode(page.parents, trees.log_odds(dom.features(page, trees.tag_odds, trees.token_odds)))
        for node, _ in page.runs:
            same = (got[node] == html_text.KEEP) == (labels[node] == page_templates.KEEP)
            right, wrong = right + same, wrong + (not same)
    assert right / (right + wrong) > 0.97


def test_decoding_is_the_best_consistent_labelling():
    rng = np.random.default_rng(0)

    def best(parents, scores):
        def of(i, labels):
            if i == len(parents):
                return sum(scores[k][y] for k, y in enumerate(labels) if k), labels
            above = labels[parents[i]]
            allowed = {html_text.DROP: [1], html_text.KEEP: [0, 1], html_text.PASS: [0, 1, 2]}[above]
            return max(of(i + 1, [*labels, y]) for y in allowed)

        return of(1, [html_text.PASS])[0]

    for _ in range(40):
        n = int(rng.integers(2, 8))
        parents = [-1, *[int(rng.integers(0, i)) for i in range(1, n)]]
        scores = np.log(rng.dirichlet(np.ones(3), n))
        labels = html_text.decode(parents, scores)
        for i in range(1, n):
            above = labels[parents[i]]
            assert above != html_text.DROP or labels[i] == html_text.DROP
            assert above != html_text.KEEP or labels[i] != html_text.PASS
        assert abs(sum(scores[i][labels[i]] for i in range(1, n)) - best(parents, scores)) < 1e-9


def test_malformed_pages():
    def runs(source):
        return [t for _, t in dom.parse(source).runs]

    assert runs("<p>a<p>b<ul><li>c<li>d</ul>e") == ["a", "b", "c", "d", "e"]
    assert runs("<script>var t='</p>'</script><style>p{}</style><!-- <p>x</p> -->y") == ["y"]
    assert runs("a &amp; b&nbsp;&lt;c<br>d <b>e</b>f") == ["a & b <c d ef"]
    assert runs("<p title='a>b'>x</p></div><p>y") == ["x", "y"]
    assert runs("<div><!-- never closed <p>x") == []
    assert runs("1 < 2 and <") == ["1 < 2 and <"]
    assert runs("") == []
    assert len(runs("<div>" * 3000 + "deep")) == 1


PAGE = """<html><head><title>T</title></head><body><header class="site"><a href=/>Home</a></header>
<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class="cookie-notice">We use cookies, all right?</div>
<article><h1>Head &amp; line</h1><p>First   part of the
text, with some words in it, and more of them.<div class="ad">Buy now, it is cheap.</div><p>Second part, again of some length, which says a thing.</article>
<section class="comments"><h3>Comments</h3><div class="comment"><p>I do not agree, this is all wrong, said at length by a reader.</p></div></section>
<aside class="sidebar"><ul><li><a href=/x>More</a></ul></aside><form><label>Mail</label><input><button>Go</button></form>
<footer>&copy; site, all rights</footer></body></html>"""


def test_article_without_furniture(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (1, "u", PAGE, "x"), (4, "u", "<nav><a href=/>menu</a></nav>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, Text string")
    out = html_text.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    want = (
        "Head & line\nFirst part of the text, with some words in it, and more of them.\n"
        "Second part, again of some length, which says a thing."
    )
    got = [(r.page_id, r.text, r.n_chars) for r in out.collect()]
    assert got == [(1, want, len(want)), (2, "", 0), (3, "", 0), (1, want, len(want)), (4, "", 0)]
    assert html_text.extract(df.limit(0)).count() == 0


def test_query_keeps_articles_and_drops_the_rest(spark):
    sf = "/root/testdata/sf0.001"
    sources = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op3_html_extraction(spark, sf).collect()
    assert len(rows) == len(sources)
    for r in rows:
        page = dom.parse(sources[r.page_id])
        article = [i for i, t in enumerate(page.tags) if t == "article"]

        def inside(node, page=page, article=article):
            while node >= 0:
                if node in article:
                    return True
                node = page.parents[node]
            return False

        assert r.text == "\n".join(t for node, t in page.runs if inside(node))


PARAGRAPHS = [
    "The river had been rising since Tuesday, and by the weekend the lower fields were under water again.",
    "Nobody in the village could remember a spring like it; the old mill stood in a lake of its own.",
    "When the water went down at last, the farmers found that the banks had moved by several metres.",
]


@pytest.mark.parametrize(
    "page, want",
    [
        (" ".join(PARAGRAPHS), " ".join(PARAGRAPHS)),
        ("<html><body>" + "".join(f"<span>{p}</span> " for p in PARAGRAPHS) + "</body></html>", " ".join(PARAGRAPHS)),
        ("<body>" + "<br>".join(PARAGRAPHS) + "</body>", " ".join(PARAGRAPHS)),
        ("plain &amp; short", "plain & short"),
        ("<body><article><h1>High water</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS) + "</article></body>", "\n".join(["High water", *PARAGRAPHS])),
        ("<body><article>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS) + "<noscript><img src=x></article></body>", "\n".join(PARAGRAPHS)),
        ("<body><article><p>" + PARAGRAPHS[0] + "</p><iframe src=x><p>" + PARAGRAPHS[1] + "</p><svg><p>" + PARAGRAPHS[2] + "</p></article></body>", "\n".join(PARAGRAPHS)),
        ("<body><article><p>" + PARAGRAPHS[0] + "</p></article><script>var a = '<p>" + PARAGRAPHS[1] + "</p>'", PARAGRAPHS[0]),
    ],
)
def test_pages_of_every_shape_keep_their_text(page, want):
    assert html_text.main_texts([page], html_text.train()) == [want]


def test_text_beside_paragraphs_in_a_wrapper_stays():
    page = "<body><nav><a href=a>Home</a><a href=b>News</a></nav><div class=content>" + PARAGRAPHS[0] + "".join(f"<p>{p}</p>" for p in PARAGRAPHS[1:]) + "</div></body>"
    assert html_text.main_texts([page], html_text.train()) == ["\n".join(PARAGRAPHS)]
