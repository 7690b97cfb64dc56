"""Classifiers by held-out accuracy and gradients, HTML rules on hand-made pages,
the pipeline by its stages' rules."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from surgecast.llm import html_extract, langid, quality, queries

DIR = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    net = langid.Network.new(["a", "b"], 3)
    for name in ("e", "u", "o", "c"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    x = np.array([[97, 98, 99], [200, 97, 97]], np.uint8)
    goal = np.array([[1.0, 0.0], [0.3, 0.7]])

    def loss():
        p = net.states(x).astype(np.float64) @ net.o + net.c
        p = p - p.max(-1, keepdims=True)
        p -= np.log(np.exp(p).sum(-1, keepdims=True))
        return -(p * goal[None]).sum() / p[..., 0].size

    for param, got in zip((net.e, net.u, net.o, net.c), net.gradients(x, goal)):
        at = np.unravel_index(np.argmax(np.abs(got)), got.shape)
        old = param[at]
        param[at] = old + 1e-2
        up = loss()
        param[at] = old - 1e-2
        down = loss()
        param[at] = old
        assert got[at] == pytest.approx((up - down) / 2e-2, rel=0.02, abs=1e-4)


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    got = queries.op4_language_id(spark, DIR).join(docs, "doc_id").where("held_out and lang is not null").select("lang", "lang_pred").collect()
    assert len(got) > 100 and np.mean([r.lang == r.lang_pred for r in got]) >= 0.97


def test_language_of_odd_texts(spark):
    rows = [(i, t, "x") for i, t in enumerate([None, "", "12 !!", "—…", "abc", "é", "\x00\x01", "Ab" * 4000])]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    net = langid.Network.new(["en", "fr"], 4)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(df, net).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 6)] == [("und", 0.0)] * 5
    assert all(got[i][0] in ("en", "fr") and 0 < got[i][1] <= 1 for i in (4, 5, 7))
    assert {r.lang_pred for r in langid.identify(df, None).collect()} == {"und"}
    assert langid.identify(df.limit(0), net).count() == 0
    assert langid.train(spark.createDataFrame([], "doc_id long, text string, lang string")) is None


def test_prediction_takes_little_memory_beside_the_texts():
    net = langid.Network.new(["a", "b", "c"], 4)
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(["ab ", "cd ", "é ", "efg, ", "hi "], 900)) for _ in range(600)]
    col = pa.array([None, "", *texts, "..."])
    tracemalloc.start()
    try:
        p, n = langid.predict(net, col)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 48e6, peak
    assert n[:2].tolist() == [0, 0] and n[-1] == 0 and not p[[0, 1, -1]].any()
    for i in (2, 300, 601):
        q, m = langid.predict(net, col.slice(i, 1))
        assert m[0] == n[i] and np.allclose(q[0], p[i], rtol=1e-9)


def test_hold_out_rule(spark):
    got = spark.range(200).select("id", langid.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == langid.crc_held_out(r.id) for r in got)


def test_quality_model_orders_grades():
    rng = np.random.default_rng(2)
    grade = rng.integers(0, 3, 600)
    rows = [np.unique(np.r_[rng.integers(100, 5000, 30), {0: [1, 2], 1: [3], 2: [4]}[g]]).astype(np.int32) for g in grade]
    model = quality.fit(rows[:400], grade[:400], 3)
    assert np.all(np.diff(model.thresholds) > 0)
    p = model.probabilities(np.array([model.weights[r].sum() for r in rows[400:]]))
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()
    assert np.mean((p @ np.arange(3)).round() == grade[400:]) > 0.95


def test_quality_of_tables(spark):
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")
    got = queries.op3_quality_classifier(spark, DIR).join(labels, "doc_id").toPandas()
    assert got.keep[got.toxic == 1].mean() < 0.05 and got.keep[(got.toxic == 0) & (got.quality == 1)].mean() > 0.95
    odd = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "a" * 100_000, 0), (3, "a" * 100_000, 0)], "doc_id long, text string, keep int")
    none = quality.train(docs, labels.limit(0).selectExpr("doc_id", "quality AS grade"))
    out = quality.score(odd, none, 2)
    assert out.columns == ["doc_id", "text", "expected_grade", "tail_prob", "keep"] and out.count() == 4
    assert quality.score(odd.limit(0), none, 2).count() == 0


def test_quality_features_see_whole_texts():
    tail = "word " * 400_000
    a, b = quality.features(pa.array([tail + "pathetic", tail + "sympathetic"]))
    assert set(a) != set(b)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="no-sidebar">
<header><p>The site of the year and the best of all the sites that there are in the world, for you and for all of us.</p></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies and this is the notice for you to read and to accept.</div>
<script>var t="</p><p>not the text of it</p>";</script><!-- <p>nor this</p> -->
<article><header><h1>The &quot;title&quot;</h1></header><p>The first paragraph&nbsp;of the <b>art</b>icle is about the way of the
world and it is long enough to be a good one, with a lot of the words that are in all of the texts of this kind, as you can see &amp; read.</p>
<p>Short.</p><aside>Read the other article about this and that</aside><form><p>Sign up for the letter</p></form>
<section id="comments"><p>I do not like the article and this is what I have to say about it, as a reader of the site.</p></section></article>
<div class="ad">Buy the best of all</div><footer>&copy; the site</footer></body></html>"""


def test_main_text_of_a_page():
    expected = (
        'The "title" The first paragraph of the article is about the way of the world and it is long enough to be a good one, '
        "with a lot of the words that are in all of the texts of this kind, as you can see & read. Short."
    )
    assert html_extract.main_text(PAGE) == expected


def test_main_text_without_article_tags():
    long = "It was the best of the times and it was the worst of the times, as all of us have read in the book that they gave to us. " * 3
    page = f"<div><a href=1>One</a> <a href=2>Two</a></div><div>{long}</div><div>It was so.</div><div>{long}</div><ul><li><a href=3>Three of the links</a></li></ul>"
    assert html_extract.main_text(page) == " ".join(f"{long} It was so. {long}".split())


def test_main_text_neighbours_decide():
    blocks = [html_extract.Block(t, 0, p, False) for t, p in (("x" * 80, "open"), ("short", "open"), ("the of and to in " * 15, "open"), ("also", "open"))]
    html_extract.classify(blocks)
    assert [b.label for b in blocks] == ["bad", "bad", "good", "good"]


def test_main_text_neighbours_at_any_distance():
    long = "It was the best of the times and it was the worst of the times, as all of us have read in the book that they gave to us. " * 3
    lines = [f"Line {i} here" for i in range(50)]
    body = "".join(f"<p>{x}</p>" for x in lines)
    assert html_extract.main_text(f"<p>{long}</p>{body}<p>{long}</p>") == " ".join([long.strip(), *lines, long.strip()])
    assert html_extract.main_text(f"<h2>Verse</h2>{body}<p>{long}</p>") == " ".join(["Verse", *lines, long.strip()])


@pytest.mark.parametrize("box", ["article", "div"])
def test_main_text_rules_hold_in_articles(box):
    long = "It was the best of the times and it was the worst of the times, as all of us have read in the book that they gave to us. " * 3
    linked = "See <a href=1>the list</a> of the winners."
    links = "<p><a href=2>Two of the links</a></p><p>Mehr Videos</p><p><a href=3>Three of the links</a></p>"
    page = f"<{box}><p>{long}</p><p>{linked}</p><p>{long}</p>{links}</{box}>"
    assert html_extract.main_text(page) == f"{long.strip()} See the list of the winners. {long.strip()}"


def test_main_text_of_articles_without_decided_blocks():
    assert html_extract.main_text("<article><h1>Title</h1><p>One line</p></article>") == "Title One line"


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<p>a", "&am", "<article><p>It is the", "<!--", "<script>x", '<a href="', "<p>\x00</p>", "<nav>" * 500, "text only"])
def test_main_text_of_broken_pages(page):
    assert isinstance(html_extract.main_text(page), str)


LONG = "It was the best of the times and it was the worst of the times, as all of us have read in the book that they gave to us. " * 3


@pytest.mark.parametrize("attr", ['title="Hidden treasures of the city"', 'data-title="the hidden city"', 'data-id="menu"', 'class="legal-history"', "id=comments-of-a-king", 'title="a > b" lang=en', "x='"])
def test_main_text_of_named_containers(attr):
    assert html_extract.main_text(f"<nav>Menu of the site</nav><div {attr}><p>{LONG}</p></div><p>short</p>").startswith(LONG.strip())


def test_main_text_keeps_quotes_and_drops_named_boxes():
    page = f'<article><p>{LONG}</p><blockquote cite="https://x.org/hidden-gem"><p>{LONG}</p></blockquote><div class="comments"><p>{LONG}</p></div></article>'
    assert html_extract.main_text(page) == f"{LONG.strip()} {LONG.strip()}"
    page = f'<div class="legal-history"><p>{LONG}</p><p>{LONG}</p><div class="comment"><p>{LONG}</p></div></div>'
    assert html_extract.main_text(page) == f"{LONG.strip()} {LONG.strip()}"


def test_blocks_inside_links_count_as_linked():
    found = html_extract.blocks("<div><a href=1><div>linked text</div></a><p>free</p></div><p><a href=2>open link<p>next</p>")
    assert [(b.text, b.in_links) for b in found] == [("linked text", 11), ("free", 0), ("open link", 9), ("next", 0)]


@pytest.mark.parametrize("piece", ["<p '", '<p a="', "<p a='\"", "<script", "<a <b", "<!-", "</", "<p a='>", "<svg><div "])
def test_a_megabyte_of_broken_page_is_read_once(piece):
    import time

    page = piece * (1_000_000 // len(piece))
    began = time.process_time()
    html_extract.main_text(f"<p>{LONG}</p>" + page)
    assert time.process_time() - began < 10


def test_blocks_hold_all_text_of_real_pages():
    """Every character that a plain parser finds outside raw elements lies in one block."""
    from html.parser import HTMLParser

    import pyarrow.parquet as pq

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.text, self.raw = [], []

        def handle_starttag(self, tag, attrs):
            self.text.append(" " if tag in html_extract.BLOCKS | html_extract.BAD_TAGS else "")
            if tag in html_extract.RAW_TAGS:
                self.raw.append(tag)

        def handle_endtag(self, tag):
            self.text.append(" " if tag in html_extract.BLOCKS | html_extract.BAD_TAGS else "")
            if self.raw and self.raw[-1] == tag:
                self.raw.pop()

        def handle_data(self, data):
            if not self.raw:
                self.text.append(data)

    pages = pq.read_table(f"{DIR}/pages.parquet")["html"].to_pylist()
    assert len(pages) > 100
    for page in pages:
        plain = Plain()
        plain.feed(page or "")
        plain.close()
        got = "".join(b.text for b in html_extract.blocks(page or ""))
        assert "".join(got.split()) == "".join("".join(plain.text).split())


def test_extract_tables(spark):
    df = spark.createDataFrame([(1, "u", PAGE, 1), (1, "u", PAGE, 1), (2, None, None, 1)], "page_id long, url string, html string, text int")
    out = html_extract.extract(df)
    assert out.columns == ["page_id", "url", "html", "text"] and out.count() == 3
    assert {r.text for r in out.where("page_id = 2").collect()} == {""}
    assert html_extract.extract(df.limit(0)).count() == 0


def test_pipeline_judges_rows_not_doc_ids(spark, tmp_path):
    import corpus_pipeline as cp

    text = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    item = text("bench", 20)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, text("a")), (None, item), (None, text("b")), (7, text("c")), (7, item), (7, text("c")), (8, item)]
    clean = cp.decontamination(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()
    assert sorted(map(tuple, clean), key=str) == sorted([rows[i] for i in (0, 2, 3, 5)], key=str)

    near = lambda name: text(name) + " more"
    rows = [
        (None, text("a")), (None, near("a")), (None, text("a")),  # a group without ids
        (None, text("b")), (3, near("b")), (5, text("b")),  # the smallest id stays, null isn't one
        (4, text("c")), (4, near("c")), (4, near("c")), (9, text("c")),  # one id, several near copies
        (None, text("d")), (4, text("e")), (4, text("e")),
    ]
    kept = cp.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), str(tmp_path)).collect()
    got = sorted((r.text[0], r.doc_id) for r in kept)
    assert got == [("a", None), ("b", 3), ("c", 4), ("d", None), ("e", 4)]


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{DIR}/documents.parquet").where("doc_id < 150")
    more = [(10_000, docs.first().text, "en", "copy", 1), (10_001, None, None, "null", 0), (10_002, "12 34", None, "none", 5), (10_003, "", "en", "empty", 0)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    kept = cp.language(spark, docs, DIR)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    lines = cp.lines(spark, kept, DIR)
    assert lines.columns == docs.columns and lines.where("n_chars != length(text)").count() == 0
    first = cp.near_duplicates(spark, kept, DIR)
    assert first.where("doc_id = 10000").count() == 0 and first.count() == first.select("doc_id").distinct().count()
    clean = cp.decontamination(spark, first, DIR)
    assert clean.columns == docs.columns and clean.count() <= first.count()
    out = cp.tokens(spark, clean, DIR)
    assert out.count() == clean.count() and out.where("size(ids) != n_tokens").count() == 0


def test_pipeline_keeps_clashing_columns(spark):
    import corpus_pipeline as cp

    names = ["own", "kept", "n_lines", "n_dropped", "score", "lang_pred", "row", "size", "hits", "component_id", "_col0", "item_id", "win", "dotted"]
    docs = spark.read.parquet(f"{DIR}/documents.parquet").where("doc_id < 40")
    docs = docs.withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in names})
    want = {r.doc_id: tuple(r[n] for n in names) for r in docs.collect()}
    now = docs
    for name, stage in cp.STAGES[:-1]:
        now = stage(spark, now, DIR)
        assert now.columns == docs.columns
        rows = now.collect()
        assert rows and all(tuple(r[n] for n in names) == want[r.doc_id] for r in rows), name
    out = cp.tokens(spark, now, DIR).collect()
    assert len(out) == len(rows) and all(tuple(r[n] for n in names) == want[r.doc_id] for r in out)
