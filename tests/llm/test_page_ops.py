"""Vector search, web-archive derivatives and language id."""

import json
import random
import time
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.llm import hamming, language, webarchive

# ---- vector search


def vectors(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.withColumn("id", F.lit(1)).withColumn("v", F.lit("x")).withColumn("score", F.lit(0)) if extra else df


def exact(rows, is_query, k=5):
    use = {i: np.array(v, "f8") for i, v, _ in rows}
    out = {}
    for q, v in use.items():
        if is_query(q):
            s = [(-(v @ w) / (np.linalg.norm(v) * np.linalg.norm(w)), i) for i, w in use.items() if i != q]
            out[q] = [i for _, i in sorted(s)[:k]]
    return out


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(64).astype("f4").tolist(), 0) for i in range(1500)]
    found = {}
    for r in hamming.nearest(vectors(spark, rows, extra=True), lambda i: i % 50 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    want = exact([(i, np.float32(v), 0) for i, v, _ in rows], lambda i: i % 50 == 0)
    assert set(found) == set(want) and all(len(v) == 5 for v in found.values())
    assert np.mean([len(set(found[q]) & set(want[q])) / 5 for q in want]) >= 0.95


def test_within_radius_is_complete():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (800, 8), dtype=np.uint8)
    index = hamming.Index(codes)
    for radius in (0, 3, 9, 20, 31, 64):
        assert hamming.probe_radii(radius, 8) and sum(r + 1 for r in hamming.probe_radii(radius, 8)) == radius + 1
        near = np.flatnonzero(np.bitwise_count(codes ^ codes[5]).sum(axis=1) <= radius)
        assert index.within(codes[5], radius).tolist() == near.tolist()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [0.0, 1.0], 0), (50, [1.0, 1.0], 0), (3, [0.0, 1.0], 0),
        (4, None, 0), (5, [0.0, 0.0], 0), (6, [nan, 1.0], 0), (7, [inf, 1.0], 0), (8, [None, 1.0], 0), (9, [], 0), (10, [1.0, 2.0, 3.0], 0), (None, [1.0, 1.0], 0),
    ]
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in hamming.nearest(vectors(spark, rows), lambda i: i % 50 == 0).collect()]
    assert sorted(got) == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (0, 4, 3), (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 3)]
    assert hamming.nearest(vectors(spark, rows).limit(0), lambda i: i % 50 == 0).collect() == []
    alone = hamming.nearest(vectors(spark, [(0, [1.0], 0)]), lambda i: i % 50 == 0).collect()
    assert alone == []


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0], 0) for i in range(300)]
    got = hamming.nearest(vectors(spark, rows), lambda i: i % 50 == 0).collect()
    want = {(q, k + 1, v) for q in range(0, 300, 50) for k, v in enumerate([x for x in range(7) if x != q][:5])}
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in got} == want


# ---- web archive

PAGE = """<!DOCTYPE html><html lang="de-AT"><head><title> A &amp; B </title><style>p{x}</style><script>var t="</p>";</script></head>
<body><!-- no --><h1>Head</h1><p>One <b>two</b><br>three &lt;4&gt;</p><a href='/x?a=1&amp;b=2'>go</a><img src=pic.png></body></html>"""
PAGES = [(1, "https://a.example.org/de/1", PAGE), (2, None, None), (3, "http://[bad", "plain <"), (1, "https://a.example.org/de/1", PAGE), (None, "x", "")]


class Visible(HTMLParser):
    def __init__(self):
        super().__init__()
        self.words, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.skip:
            self.words += data.split()


def test_plain_text_words_against_a_parser(spark):
    import duckdb

    for (page,) in duckdb.sql("select html from '/root/testdata/sf0.001/pages.parquet' where length(html) < 20000 limit 60").fetchall() + [(PAGE,)]:
        v = Visible()
        v.feed(page)
        v.close()
        assert "".join(webarchive.plain_text(page).split()) == "".join(v.words)


def test_derivatives_keep_what_they_refer_to(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("block", F.lit(1))
    source = webarchive.responses(pages)
    by_id = {r["record_id"]: r for r in source.collect()}
    made = webarchive.derivatives(source)
    rows = made.collect()
    assert len(rows) == 2 * len(PAGES)
    for r in rows:
        s = by_id[r["refers_to"]]
        assert (r["target_uri"], r["date"], r["payload_digest"], r["source_headers"]) == (s["target_uri"], s["date"], s["payload_digest"], s["http_headers"])
        assert r["block_digest"] == webarchive.digest(bytes(r["block"])) and r["content_length"] == len(r["block"])
    meta = json.loads(next(bytes(r["block"]) for r in rows if r["page_id"] == 1 and r["type"] == "metadata"))
    assert meta["title"] == "A & B" and meta["language"] == "de" and meta["http_headers"]["Content-Type"].startswith("text/html")
    assert [x["url"] for x in meta["links"]] == ["https://a.example.org/x?a=1&b=2", "https://a.example.org/de/pic.png"]
    text = next(bytes(r["block"]).decode() for r in rows if r["page_id"] == 1 and r["type"] == "conversion")
    assert text.split("\n") == ["A & B", "Head", "One two", "three <4>", "go"]
    assert webarchive.derivatives(source.limit(0)).collect() == []


def test_files_read_back(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    made = webarchive.derivatives(webarchive.responses(pages))
    got = []
    for r in webarchive.write_files(made).collect():
        with open(r["file"].removeprefix("file://").removeprefix("file:"), "rb") as f:
            records = list(webarchive.read_records(f.read()))
        assert len(records) == r["records"]
        got += [(h["WARC-Record-ID"], h["WARC-Refers-To"], h["WARC-Block-Digest"], b) for h, b in records]
    assert sorted(got) == sorted((r["record_id"], r["refers_to"], r["block_digest"], bytes(r["block"])) for r in made.collect())


# ---- language


def corpus(spark):
    rng = random.Random(1)
    words = {"en": "the of and with that this from".split(), "de": "der die und ist nicht für über".split(), "fr": "le les des une pour être où".split()}
    text = lambda lang: " ".join(rng.choice(words[lang]) for _ in range(40))
    docs = [(i, text(lang), lang) for i, lang in enumerate(["en", "de", "fr"] * 30)] + [(900, None, "en"), (901, "x", None)]
    pages, truth = [], {}
    for i in range(150):
        lang = ["en", "de", "fr"][i % 3]
        host = {"en": "a.example.com", "de": "b.example.de", "fr": "c.example.fr"}[lang]
        short = i >= 135  # no text: only address, markup and host tell
        pages.append((i, f"https://{host}/{lang}/{i}", f'<html lang="{lang}"><p>{"" if short else text(lang)}</p></html>'))
        truth[i] = lang
    # a page that declares another language than its text
    pages.append((500, "https://a.example.com/en/z", '<html lang="fr"><p>' + text("en") + "</p></html>"))
    pages += [(600, None, None), (0, pages[0][1], pages[0][2])]
    truth[500] = "en"
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(pages, "page_id long, url string, html string"), truth


def test_fusion(spark):
    docs, pages, truth = corpus(spark)
    model = language.train(docs)
    assert model.langs == ["de", "en", "fr"]
    rows = language.identified(pages.withColumn("host", F.lit(1)), model).collect()
    assert len(rows) == 153
    assert {r["page_id"]: r["lang"] for r in rows if r["page_id"] in truth} == truth
    assert all(0 <= r["confidence"] <= 1 for r in rows)
    assert language.identified(pages.limit(0), model).collect() == []
    none = language.train(docs.limit(0))
    assert {r["lang"] for r in language.identified(pages.limit(3), none).collect()} == {""}


def test_address():
    assert language.address("https://m.a.example.co/de-at/x?y#z") == ("m.a.example.co", "example.co", "co", "co/de-at")
    assert language.address("") == ("", "", "", "/") and language.address("http://[bad") == ("", "", "", "")


@pytest.mark.parametrize("piece", ["<a", "<a ", "<title>", "<html ", "<p ", "<!--", "<script", "<script>", "</script ", "<a href='", '<a href="x ', "<", "< lang=", "&#"])
def test_hostile_pages_take_linear_time(piece):
    page = piece * (1_000_000 // len(piece))
    start = time.process_time()
    webarchive.plain_text(page)
    webarchive.links(page, "http://a.example/")
    webarchive.title(page)
    webarchive.declared_language(page)
    assert time.process_time() - start < 8  # four readers of 1 MB; quadratic ones took minutes


def test_reading_of_tags():
    page = (
        "<!doctype html><HTML  data-x=1 lang='de-AT'><title> A &amp; <b>B</b></title ><p>one<br/>two <!-- <p> hidden --> three"
        "<script src=a.js>var x = '<a href=q>';</script><STYLE>p{}</style><a title=x href = \"b>c\">four</a> 1 < 2 <img src='d'>"
        "<a href>five</a><link\nhref=e/f><a name=g"
    )
    # a tag ends at the first sign for it, in a quoted value too
    assert webarchive.plain_text(page) == 'A & B\none\ntwo three c">four 1 < 2 five<a name=g'
    assert [x["path"] for x in webarchive.links(page, "http://h/")] == ["script@/src", "a@/href", "img@/src", "link@/href"]
    assert [x["url"] for x in webarchive.links(page, "http://h/")] == ["http://h/a.js", "http://h/b>c", "http://h/d", "http://h/e/f"]
    assert webarchive.title(page) == " A &amp; <b>B</b>"
    assert webarchive.declared_language(page) == "de"
    assert webarchive.title("no <title>end") is None and webarchive.declared_language("<html>") is None


def test_a_rare_language_is_learned(spark):
    """One language holds nearly all rows, one text of it most of those; the
    others still give their share of the sample and can be returned."""
    from cadence.llm.language import _sample, train

    rows = [(1, "the same words again and again", "en")] * 3000
    rows += [(i, f"the river and the house number {i} with many words", "en") for i in range(2, 1500)]
    rows += [(9000 + i, f"der fluss und das haus nummer {i} mit vielen worten", "de") for i in range(5)]
    rows += [(9100, None, "de"), (9101, "kein name", None), (9102, "", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = {r["lang"]: r["count"] for r in _sample(docs, 300).groupBy("lang").count().collect()}
    assert got == {"en": 100, "de": 5, "fr": 1}
    model = train(docs, 300)
    assert "de" in model.langs and model.langs[int(model.evidence("das haus mit worten").argmax())] == "de"
    assert model.langs[int(model.evidence("the house with words").argmax())] == "en"
    assert _sample(docs.limit(0), 300).count() == 0
