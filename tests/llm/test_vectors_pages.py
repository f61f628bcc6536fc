"""Top-k search, page extraction and the pipeline."""

from __future__ import annotations

import os
import time

import numpy as np
import pytest

import corpus_pipeline
from campanile.llm import html_text, queries, top_k

FOLDER = "/root/testdata/sf0.001"


def brute_top(rows, asked, k):
    sound = [(i, np.floor(1024 * np.array(v, float)).astype(object)) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in sound:
        if i in asked:
            scored = sorted((-int(sum(int(a) * int(b) for a, b in zip(q, v))), j) for j, v in sound if j != i and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e4])
def test_top_k_with_ties_copies_and_bad_vectors(spark, scale):
    rng = np.random.default_rng(5)
    rows = [(i, (scale * rng.integers(-3, 3, 4) / 4).tolist()) for i in range(90)]
    rows += [(100, None), (101, [1.0, None, 0.0, 0.0]), (102, [float("nan")] * 4), (103, [float("inf"), 0.0, 0.0, 0.0]),
             (104, [1.0, 2.0]), (105, []), (None, [1.0] * 4), (106, rows[3][1]), (107, rows[3][1])]
    vectors = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<double>, score string, rank int").repartition(3)
    asked = {0, 3, 7, 100, 104, 107}
    got = top_k.top_k(vectors, vectors.filter(vectors.vec_id.isin(*asked)), 10)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, asked, 10)


def test_top_k_of_few_or_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    few = spark.createDataFrame([(1, [1.0]), (2, [0.5]), (3, [0.5])], schema)
    got = top_k.top_k(few, few.filter("vec_id = 1"), 10)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 2, 524288), (1, 2, 3, 524288)]
    none = spark.createDataFrame([], schema)
    assert top_k.top_k(none, none, 10).count() == 0 and top_k.top_k(few, none, 10).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu entry</a></li></ul></nav><div class="ad">Buy this now</div>
<article><h1>Title &amp; more</h1><p>First  <b>bold</b>\n words<br>go on<p>second &lt;block&gt; here<form>name <input></form>
<div class="comments"><p>reader says things</p></div><ul><li>one</li><li>two</li></ul><!-- no --></article>
<aside>side words</aside><footer>&copy; foot words</footer>"""


def test_extraction_of_nested_and_unclosed_markup():
    want = "Title & more\n\nFirst bold words go on\n\nsecond <block> here\n\none\n\ntwo"
    assert html_text.main_text(PAGE, {}) == want
    assert [html_text.main_text(p, {}) for p in (None, "", "<p></p>", "plain text", "<nav>only menu</nav>")] == ["", "", "", "plain text", ""]


@pytest.mark.parametrize("tag, names", [
    ("article", 'class="post comments-open"'), ("main", 'class="has-sidebar"'), ("article", 'class="category-social"'), ("main", "id=menu")])
def test_content_elements_outdo_hints_in_their_names(tag, names):
    page = PAGE.replace("<article>", f"<{tag} {names}>").replace("</article>", f"</{tag}>")
    assert html_text.main_text(page, {}) == html_text.main_text(PAGE, {}) != ""
    assert any(inside for *_, inside in html_text.events(page))


def test_comments_in_articles_of_their_own_stay_out():
    comment = '<article class="comment-body"><p>reader says things</p></article>'
    for page in (PAGE.replace("</article>", comment + "</article>"), PAGE.replace("<aside>", f'<div id="comments">{comment}</div><aside>'),
                 PAGE.replace("<aside>", '<article class="comment"><p>reader says things</p></article><aside>')):
        assert html_text.main_text(page, {}) == html_text.main_text(PAGE, {})


def test_extraction_learns_from_marked_pages(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x"), (1, "u", PAGE, "x")],
                                  "page_id bigint, url string, html string, text string")
    weights = html_text.fit(pages)
    assert weights["word article"] > 0 > weights["word nav"]
    got = html_text.extract(pages, weights, "page_id", "url").collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, len(html_text.main_text(PAGE, weights)))] * 1 + [
        (1, len(html_text.main_text(PAGE, weights))), (2, 0)]
    assert html_text.extract(pages.limit(0), html_text.fit(pages.limit(0)), "page_id", "url").count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_pipeline_stages_keep_columns_and_take_effect(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "n-gram Jaccard join", "mixing sources", "byte-level BPE"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), "stage")
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > counts[3] > 0 < counts[4]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert len(out) == counts[4] and all(r.intact for r in out)


def test_each_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.all_queries()) == list(range(1, 14))


def pipeline_rows(spark, rows):
    return spark.createDataFrame([(*r, "en", "s", 1, "clash") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, print string")


def test_two_texts_of_one_id_are_judged_apart(spark):
    a, b, c = ("word%d " * 12 % tuple(range(k, k + 12)) for k in (0, 100, 200))
    docs = pipeline_rows(spark, [(1, a), (5, a), (5, b), (7, c), (7, c), (9, None), (9, ""), (None, a), (3, b + "more")])
    kept = corpus_pipeline.one_of_each_group(spark, docs, FOLDER)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(1, a), (3, b + "more"), (7, c), (9, None), (None, a)], key=repr) or got == sorted(
        [(1, a), (3, b + "more"), (7, c), (9, ""), (None, a)], key=repr)


def test_pipeline_stages_on_nulls_empty_tables_and_clashing_columns(spark):
    long = " ".join(f"w{i % 7000}x{i}" for i in range(30_000))
    docs = pipeline_rows(spark, [(1, None), (2, ""), (2, ""), (None, "a b"), (3, long), (4, "plain words " * 3)])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0, name
        out = stage(spark, docs, FOLDER)
        texts = [r.text for r in out.collect()] if "text" in out.columns else None
        assert name in ("toxicity", "mixing sources", "byte-level BPE") or long in texts, name
        if name == "toxicity":
            assert len(texts) == 6
        if name == "byte-level BPE":
            assert out.filter("intact").count() == 6


AROUND = "<html><body><nav><a>Menu one</a></nav><article><p>First words of text here</p>{}<p>More words after that thing</p></article><footer>foot</footer>"


@pytest.mark.parametrize("markup", [
    '<embed src="a">', "<svg/>", "<svg><text>no</text></svg>", "<math/>", "<button>Go", "<button>Go</button>", "<select><option>x", "<canvas>",
    "<audio controls>", "<video src=x>", "<video>no video</video>", "<object data=y>", "<iframe src=z></iframe>", "<template><p>no</p></template>"])
def test_no_element_takes_the_rest_of_a_page_along(markup):
    assert html_text.main_text(AROUND.format(markup), {}) == html_text.main_text(AROUND.format(""), {}) == (
        "First words of text here\n\nMore words after that thing")


@pytest.mark.parametrize("page", [
    "<head><title>T</title><article><p>Some words are here now</p></article>", "<head><meta x><p>Some words are here now",
    "<head><title>t</title><style>p{}</style></head><body>Some words are here now", "<head>Some words are here now"])
def test_a_head_ends_where_it_must(page):
    assert html_text.main_text(page, {}) == "Some words are here now"


@pytest.mark.parametrize("piece", ["<div>x ", "<div>x</span> ", "<video>x ", "<article>x ", "<button>x "])
def test_extraction_takes_linear_time(piece):
    def seconds(n):
        start = time.process_time()
        html_text.main_text(piece * n, {})
        return time.process_time() - start

    assert seconds(40_000) < 12 * max(seconds(10_000), 0.02)


def brute_region(scores):
    """The best contiguous region over all pairs of places; of equal ones the one that ends first, then starts last."""
    best, at = 0.0, (0, 0)
    for j in range(1, len(scores) + 1):
        for i in range(j - 1, -1, -1):
            if sum(scores[i:j]) > best + 1e-9:
                best, at = sum(scores[i:j]), (i, j)
    return best, at


def test_the_region_is_the_best_of_all(monkeypatch):
    rng = np.random.default_rng(4)
    for _ in range(60):
        scores = rng.integers(-3, 4, 12).tolist()
        found = [(f"word {i}", 1, f"w{i} ", False, False) for i in range(12)]
        monkeypatch.setattr(html_text, "events", lambda page, found=found: found)
        weights = {f"word {i}": float(s) for i, s in enumerate(scores)}
        best, _ = brute_region(scores)
        got = html_text.main_text("x", weights).split()
        places = [int(w[1:]) for w in got]
        # Words that score below zero are left out of the text, not of the region.
        assert (not places) == (best <= 0)
        if places:
            assert sum(scores[places[0]:places[-1] + 1]) == best
