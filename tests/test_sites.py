"""Page structure, fetch interfaces, writers and joins by time on hand-made cases."""

import bisect
import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from doclathe.functions import text as T
from doclathe.operators import htmlops as H
from doclathe.operators import incremental as I
from doclathe.operators import records as R
from doclathe.operators import relational as RL
from doclathe.operators import report as RP
from doclathe.operators import store as S
from doclathe.operators import validation as V
from doclathe.sources import files as FS
from doclathe.sources import paged as P

T0 = datetime(2025, 1, 1)


def test_as_of_against_bisection(spark):
    rng = random.Random(1)
    at = lambda: T0 + timedelta(hours=rng.randrange(400))
    left = [(i, rng.choice(["hot"] * 4 + ["a", "b", None]), rng.choice([at(), at(), at(), None]), "x") for i in range(400)]
    right = [(rng.choice(["hot"] * 4 + ["a", None, "never"]), at(), rng.randrange(50)) for _ in range(300)] + [("hot", None, 1), ("hot", T0, 7), ("hot", T0, 7)]
    held = {}
    for k, t, v in right:
        if t is not None:
            held.setdefault(k, []).append((t, v))
    for v in held.values():
        v.sort()

    def last(k, t):
        have = held.get(k, [])
        at = bisect.bisect_right(have, (t, 10**9)) if t is not None else 0
        return have[at - 1][1] if at else None

    ld, rd = spark.createDataFrame(left, "id int, k string, t timestamp, v string"), spark.createDataFrame(right, "k string, t timestamp, v int")
    got = {r.id: r.last.v if r.last else None for r in RL.as_of(ld, rd, ["k"], "t", 36_000).collect()}
    assert got == {i: last(k, t) for i, k, t, _ in left}
    assert RL.as_of(ld.where("false"), rd, ["k"], "t").count() == 0 and RL.as_of(ld, rd.where("false"), ["k"], "t").where("last is not null").count() == 0


def test_interval_and_band_joins_against_all_pairs(spark):
    rng = random.Random(2)
    at = lambda: T0 + timedelta(minutes=rng.randrange(9000))
    points = [(i, rng.choice("ab"), rng.choice([at(), at(), None])) for i in range(120)]
    spans = [(i, rng.choice("ab"), s, rng.choice([s + timedelta(minutes=rng.randrange(1, 4000)), s, None])) for i in range(60) for s in [at()]]
    pd, sd = spark.createDataFrame(points, "p int, k string, t timestamp"), spark.createDataFrame(spans, "s int, k string, a timestamp, b timestamp")
    want = sorted((p, s) for p, k, t in points for s, l, a, b in spans if k == l and t is not None and b is not None and a <= t < b)
    assert rows(RL.interval_join(pd, sd, "t", "a", "b", ["k"], 3600).select("p", "s")) == sorted(want, key=repr)
    near = sorted(((p, s) for p, k, t in points for s, l, a, _ in spans if k == l and t is not None and abs(t - a) <= timedelta(minutes=30)), key=repr)
    assert rows(RL.band_join(pd, sd.select("s", "k", "a"), "t", "a", 1800, ["k"]).select("p", "s")) == near


def test_batches_number_every_row_once(spark):
    data = [(k, n, f"t{i}") for i, (k, n) in enumerate([("hot", i % 50) for i in range(500)] + [("a", 1), (None, 3), (None, None)])]
    got = R.batches(spark.createDataFrame(data, "k string, n int, text string"), ["k"], ["n"], 30).collect()
    assert {(r.k, r.n, r.text) for r in got} == set(data) and len(got) == len(data)
    hot = sorted((r.pos, r.n, r.batch) for r in got if r.k == "hot")
    assert [p for p, _, _ in hot] == list(range(500)) and [n for _, n, _ in hot] == sorted(n for _, n, _ in hot) and all(b == p // 30 for p, _, b in hot)


PAGE = """<html><head><title>Name - Site</title></head><body><div class="x"><h2>First</h2><p>A paragraph of some length here.</p><ul><li>An item that is long enough<p>with a paragraph inside it</p></li><li>short</li></ul>
<table><tr><th>A</th><th>B</th></tr><tr><td>1</td></tr></table><h3>Second</h3>A text that stands on its own<p></p></div></body></html>"""


def test_section_walk():
    got = H.section_walk(PAGE)
    assert got[0] == {"heading": "First", "body": "A paragraph of some length here. An item that is long enough with a paragraph inside it | A | B |\n| --- | --- |\n| 1 |  |"}
    assert got[1] == {"heading": "Second", "body": "A text that stands on its own"}
    assert H.section_walk(PAGE, doubled=True)[0]["body"].startswith("A paragraph of some length here. A paragraph of some length here. An item")
    assert H.section_walk("") == [] == H.accordion("<p>x</p>")


def test_links_of_pages(spark):
    html = '<a class="teaser partner big" href="/a">1</a><a class="teaser partner" href="https://other.org/">2</a><a class="partner teaser" href="#x">3</a><a class="teaser partner" href="/a">4</a>'
    assert H.teaser_links(html, "https://w.site.example/p", ("teaser", "partner"), "site.example") == ["https://w.site.example/a"]
    base = "https://l.example/legal-content/EN/TXT/?uri=CELEX:32006R1107"
    links = '<a href="?uri=CELEX:32006R1107&tab=2#a">x</a><a href="?uri=CELEX:32006R1107&tab=2">x</a><a href="?uri=CELEX:1">y</a><a href="/other/?uri=CELEX:32006R1107">z</a><a href="https://m.example/legal-content/EN/?uri=CELEX:32006R1107">m</a>'
    assert H.same_document_links(links, base) == ["https://l.example/legal-content/EN/TXT/?uri=CELEX:32006R1107&tab=2"]
    assert H.legal_metadata('<title>T</title><time datetime="2001-02-03">x</time>') == {"title": "T", "published": "2001-02-03", "reference": ""}
    assert H.plain_text("<p> a <b>b</b></p>\n<script>x</script>c &amp; d") == "a\nb\nc & d"
    df = spark.createDataFrame([(1, "<p>ok</p>"), (2, None), (3, "<![x")], "k int, html string")
    assert {r.k for r in H.page_problems(df, "k").collect()} <= {3}


def test_clean_records(spark):
    data = [(1, '{"article": {"title": "t", "body": "<h2>Head</h2><p>A line of some length</p><p>a LINE of some  length</p><nav><p>Not this line at all</p></nav>"}}'), (2, "\\u003ch3\\u003eTop\\u003c/h3\\u003e<div>Fifteen or more here</div>"), (3, ""), (4, None), (5, "plain")]
    got = {r.k: r.text for r in H.clean_records(spark.createDataFrame(data, "k int, text string"), "k").collect()}
    assert got == {1: "## Head\n\nA line of some length", 2: "### Top\n\nFifteen or more here", 3: "", 4: "", 5: ""}


@pytest.mark.parametrize(
    "html, wall",
    [("Please wait: ONE MORE STEP", True), ("<script>window._cf_chl_opt={}</script>", True), ("ak_bmsc=1", True), ("x" * 5000 + "not a bot", False), ("access denied", False), ("captcha", False), ("just a moment", False), ("While the website verifies you", True)],
)
def test_walls(spark, html, wall):
    assert spark.createDataFrame([(html,)], "h string").select(T.is_bot_wall(F.col("h")).alias("w")).first().w is wall


def test_scrape_cascade(spark):
    big, text = "x" * 5000, "t" * 200
    data = [
        (1, big, text, None, None), (2, big + "<details", text, big, text), (3, big[1:], text, big, "t"), (4, "checking your browser" + big, text, "b" * 9, text), (5, None, None, "b", text), (6, big, "t" * 199, "one more step", text), (7, None, None, None, None), (8, "", text, "", text),
    ]
    df = spark.createDataFrame(data, "k int, a string, b string, c string, d string")
    got = {r.k: (r.o.via, len(r.o.text), r.o.html[:3]) for r in df.select("k", T.scrape_cascade(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("o")).collect()}
    assert got == {1: ("static", 200, "xxx"), 2: ("browser", 200, "xxx"), 3: ("failed", 0, "xxx"), 4: ("browser", 200, "bbb"), 5: ("browser", 200, "b"), 6: ("failed", 0, "one"), 7: ("failed", 0, ""), 8: ("failed", 0, "")}


def test_fetch_and_pdf(spark):
    def get(url):
        if url == "boom":
            raise OSError("no route")
        return (200, "<p>x</p>") if url == "ok" else (404, "gone")

    urls = spark.createDataFrame([("ok", 1), ("missing", 2), ("boom", 3), (None, 4)], "url string, html_ int")
    assert {r.html_: (r.html, r.problem) for r in FS.fetch(urls, get).collect()} == {1: ("<p>x</p>", None), 2: (None, "404"), 3: (None, "OSError: no route"), 4: (None, "0")}
    pdfs = spark.createDataFrame([(1, b"%PDF short"), (2, b"bad"), (3, None), (4, b"%PDF " + b"l" * 600)], "k int, content binary")
    read = lambda b: (_ for _ in ()).throw(ValueError("broken")) if b == b"bad" else b.decode()
    got = {r.k: (r.text and len(r.text), r.problem) for r in FS.extract_pdf(pdfs, "k", "content", read, lambda b: "o" * 100).collect()}
    assert got == {1: (100, None), 2: (None, "ValueError: broken"), 3: (None, None), 4: (605, None)}
    kinds = spark.createDataFrame([(b"%PDF-1", None), (b"x", "Application/PDF; x"), (None, "text/html")], "c binary, t string")
    assert [r.p for r in kinds.select(FS.is_pdf(F.col("c"), F.col("t")).alias("p")).collect()] == [True, True, False]


def test_snapshots_cache_and_json_files(spark, tmp_path):
    rules = spark.createDataFrame([("R1", "a", "t", "c", "s", 1), ("R2", "b", None, "c", "s", 2)], "rule_id string, content_hash string, title string, category string, source string, version int")
    folder = str(tmp_path / "snapshots")
    assert I.load_snapshot(spark, folder).count() == 0
    I.save_snapshot(rules, folder, "20250101T000000")
    I.save_snapshot(rules.where("rule_id = 'R1'"), folder, "20250102T000000")
    assert [r.rule_id for r in I.load_snapshot(spark, folder).collect()] == ["R1"] and I.load_snapshot(spark, folder, "20250101T000000").count() == 2
    assert I.load_snapshot(spark, folder, "1999").count() == 0 and I.load_snapshot(spark, folder).first().snapshot_at == "20250102T000000"
    cache = FS.ResultCache(spark, str(tmp_path / "cache"), "source string, v int")
    assert cache.read()[0].count() == 0 == cache.read()[1].count()
    for n in (1, 2):
        cache.write(spark.createDataFrame([("s", n)], "source string, v int"), spark.createDataFrame([("s", f"h{n}")], "source string, content_hash string"))
    assert rows(cache.read()[0]) == [("s", 2)] and rows(cache.read()[1]) == [("s", "h2")]
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "b.json").write_text("[1]")
    (tmp_path / "j" / "a.json").write_text("[1")
    assert [tuple(r) for r in FS.json_files(spark, str(tmp_path / "j")).collect()] == [("a.json", None), ("b.json", "[1]")]
    assert FS.file_count(spark, str(tmp_path / "j")) == 2 and FS.file_count(spark, str(tmp_path / "none")) == 0 == FS.json_files(spark, str(tmp_path / "none")).count()


def test_push_documents(spark):
    ents = spark.createDataFrame([(1, "Halgrad Wings", "airline", "s1"), (2, "New Port", "airport", "s2"), (3, "Board", "regulator", "s3"), (4, "HALGRAD wings", "airline", "s4"), (5, None, "airport", None)], "entity_no int, entity_name string, entity_type string, services string")
    docs = spark.createDataFrame([("A1", "airline", "Halgrad Wings", "old", "t0", {"icon": "i"}), ("A2", "airline", "Other", "old", "t0", {})], "doc_id string, entity_type string, name string, services string, updated_at string, fields map<string,string>")
    index = spark.createDataFrame([("halgrad wings", "A1", "airline")], "key string, doc string, kind string")
    got = {r.doc_id: r for r in S.push_documents(ents, docs, index, "t1").collect()}
    assert (got["A1"].services, got["A1"].updated_at, got["A1"].fields) == ("s4", "t1", {"icon": "i"}) and got["A2"].services == "old"
    assert got["new:new port"].fields["full_name"] == "New Port" and set(got["new:new port"].fields) == set(S.NEW_DOCUMENT["airport"])
    assert rows(S.push_report(ents)) == [(5, 3, 1, 1)]


def test_help_centre_and_tags(spark):
    urls = spark.createDataFrame([("/hc/en/articles/5-x",), ("https://h.example/hc/en/sections/1",), ("/hc/en/categories/9-c",), ("/hc/en/users/1",), ("/x",), (None,)], "url string")
    sections, articles = spark.createDataFrame([(1, 9), (2, 9), (3, 8)], "id long, category_id long"), spark.createDataFrame([(5, 1, None), (6, 1, "<p>b</p>"), (7, 2, ""), (8, 3, "z")], "id long, section_id long, body string")
    got = P.articles_of(urls, sections, articles)
    assert {(r.url[:9], r.id) for r in got.collect()} == {("/hc/en/ar", 5), ("https://h", 5), ("https://h", 6), ("/hc/en/ca", 5), ("/hc/en/ca", 6), ("/hc/en/ca", 7)}
    assert P.unresolved(urls).count() == 3
    full = articles.select("id", F.lit(None).cast("string").alias("title"), F.lit("u").alias("html_url"), "section_id", F.lit("en").alias("locale"), "body", F.lit(None).cast("string").alias("created_at"), F.lit(None).cast("string").alias("updated_at"))
    assert {(r.id, r.title, r.url, r.body) for r in P.normalise_articles(full).collect()} == {(5, "", "u", ""), (6, "", "u", "b"), (7, "", "u", ""), (8, "", "u", "z")}
    posts = spark.createDataFrame([(1, "Dog and lift"), (2, "lift"), (3, "Dog and lift"), (4, None), (5, "LIFT two")], "post_id int, text string")
    assert rows(P.tagged(posts, ["lift", "dog"]).select("tag", "post_id")) == [("lift", 1), ("lift", 2), ("lift", 5)]
    assert rows(P.tagged(posts, ["dog", "lift"], per_tag=1).select("tag", "post_id")) == [("dog", 1)]


def test_small_reports(spark):
    df = spark.createDataFrame([("a\nb\nc", "k"), ("x", None), (None, "k")], "t string, c string")
    assert [r.l for r in df.select(RP.tail_lines(F.col("t"), 2).alias("l")).collect()] == ["b\nc", "x", None]
    assert [r.l for r in df.select(RP.tail(F.col("t"), 3).alias("l")).collect()] == ["b\nc", "x", None]
    rules = spark.createDataFrame([("Lift  use", "a", "one"), ("lift use", "b", "two"), ("Lift use", "b", "Two "), ("Dog", "a", "x"), ("Dog", "b", "X"), (None, "a", "y")], "title string, source string, description string")
    assert rows(V.cross_source(rules)) == [("lift use", 2, 2)]
