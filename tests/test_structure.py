"""JSON, HTML, enrichment, streams and sources."""

import hashlib
import json
import os

from conftest import rows
from pyspark.sql import functions as F

from doclathe.operators import enrich as E
from doclathe.operators import htmlops as H
from doclathe.operators import jsonops as J
from doclathe.operators import report as RP
from doclathe.sources import files, paged
from doclathe.streaming import ingest


def test_unwrap(spark):
    cases = {
        '{"body": "text", "title": "T"}': "text", '{"title": "T"}': "## T", '{"result": {"content": "in"}}': "in", '{"x": 1}': "", "plain": "plain",
        '{"broken": \n"a_b": "v",\nkept line}': '{"broken": \nkept line}', '[{"body": "a"}, {"description": "b"}]': "a\n\nb", "[]": "", '{"body": "{\\"html\\": \\"deep\\"}"}': "deep",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string")
    assert {r.t: r.u for r in df.select("t", J.unwrap(F.col("t")).alias("u")).collect()} == {**cases, None: None}


def test_salvage_and_validation(spark):
    item = json.dumps({"section": "S", "text": "x" * 31, "parent_id": "p"})
    raws = {f"[{item}]": 1, f"```json\n[{item}]\n```": 1, f"talk [{item}, 3, null] talk": 1, "[" + item: 0, "none": 0, "": 0, json.dumps([{"section": "S", "text": "x" * 30}, {"section": " ", "text": "y" * 40}]): 0}
    df = spark.createDataFrame([(k,) for k in raws] + [(None,)], "t string")
    got = {r.t: r.n for r in df.select("t", F.size(J.valid_chunks(J.salvage(F.col("t")))).alias("n")).collect()}
    assert {k: v for k, v in got.items() if k is not None} == raws
    svc = [{"type": " Quiet Room ", "description": {"en": "e" * 20}}, {"type": "a", "description": "text"}, {"type": "", "description": {"en": "e" * 20}}]
    one = spark.createDataFrame([(json.dumps(svc),)], "t string").select(J.valid_services(J.salvage(F.col("t"))).alias("s")).first().s
    assert [(s.type, s.description.ro, s.is_presented) for s in one] == [("quiet_room", "e" * 20, True)]


def test_posts(spark):
    result = lambda **k: {"entryId": k.pop("id", "tweet-1"), "content": {"itemContent": {"tweet_results": {"result": k}}}}
    entries = [result(__typename="Tweet", rest_id="1", legacy={"full_text": " a  b "}), result(__typename="Other", tweet={"legacy": {"id_str": "2", "text": "c"}}), result(__typename="Tweet", rest_id="3", legacy={"text": " "}), {"entryId": "cursor-1", "content": {}}, result(id="promoted-1", rest_id="9", legacy={"text": "x"})]
    raw = json.dumps({"data": {"search_by_raw_query": {"search_timeline": {"timeline": {"instructions": [{"entries": entries}, {"k": 1}]}}}}})
    assert rows(J.posts(spark.createDataFrame([(raw,), ("{",), (None,), ('{"data": 1}',)], "raw string"))) == [("1", "a b"), ("2", "c")]


def test_html(spark):
    page = '<!DOCTYPE html><!-- c --><html><head><title>t</title><script>"</p>"</script></head><body><div class="main-nav">no</div><h1>Head</h1><p>One <b>bold<p>Two<div id="Cookie-bar">no</div><table><tr><th>A<th>B<tr><td>1</table>Go to footer<a href="/x?q=1">l</a><a href="mailto:a">m</a></body></html>'
    df = spark.createDataFrame([(1, page, "https://h.example/a/b"), (2, None, None), (3, "", None), (4, "<p>unclosed <i>x", None)], "id int, html string, url string")
    assert {r.id: r.text for r in H.clean_pages(df, "id").collect()} == {1: "Head\n\nOne bold\n\nTwo\n\nA\n\nB\n\n1\n\nlm", 2: None, 3: "", 4: "unclosed x"}
    assert rows(H.page_links(df, "id")) == [(1, 0, "https://h.example/x?q=1"), (1, 1, "mailto:a")]
    assert rows(H.page_tables(df, "id")) == [(1, 0, "| A | B |\n| --- | --- |\n| 1 |  |")]
    blocks = spark.createDataFrame([(1, "<h2>Fees</h2><div><p>A paragraph long enough.</p><p>short</p><h3>Sub</h3><li>Another item long enough</li></div>")], "id int, html string")
    assert rows(H.page_blocks(blocks, "id")) == [(1, 0, "Fees", 2, "A paragraph long enough."), (1, 1, "Sub", 3, "Another item long enough")]


def test_html_content():
    page = '<head><title>T</title><meta property="og:title" content="Own"></head><body><div>outside</div><main><h1>Head</h1><p>Text of 2024-05-06.</p><table><tr><td>1.</td><td>First rule</td></tr></table><h2>Next</h2><p>A longer text below the heading.</p></main></body>'
    assert H.content_text(page) == "Head\n\nText of 2024-05-06.\n\n1.  First rule\n\nNext\n\nA longer text below the heading."
    assert H.metadata(page) == {"title": "Own", "published": "2024-05-06"} and H.metadata("") == {"title": None, "published": None}
    assert H.heading_sections(page) == [{"heading": "Next", "body": "A longer text below the heading."}]
    assert H.heading_sections("<p>only text</p>") == [{"heading": None, "body": "only text"}] and H.heading_sections("") == []
    assert H.related_links('<a href="/a/b/c#x">1</a><a href="/a/b/c?q">2</a><a href="/z">3</a><a href="https://o.example/a/b/d">4</a><a href="/a/b/">5</a>', "https://h.example/a/b") == ["https://h.example/a/b/c"]


def test_report(spark):
    logs = spark.createDataFrame([(1, "start ... half"), (2, "start"), (3, ""), (4, None)], "run int, output string")
    got = {r.run: (r.share, r.label) for r in RP.progress(logs, [("start", 0.1, "a"), ("half", 0.5, "b")]).collect()}
    assert got == {1: (0.5, "b"), 2: (0.1, "a"), 3: (0.0, ""), 4: (0.0, "")}
    df = spark.createDataFrame([("a", "X"), ("b", None), ("a", "y"), (None, "x")], "k string, t string")
    assert rows(RP.browse(df, {"k": ["a"]}, "X", ["t"])) == [("a", "X")] and RP.browse(df, {"k": []}).count() == 4
    assert rows(RP.top_counts(df, "k", "t", 1)) == [("a", 2)] and [r.k for r in RP.first_values(df, "k").collect()] == ["a", "b"]
    assert df.agg(RP.distinct_count(F.col("k")).alias("n")).first().n == 3


def test_backends(spark):
    class Flaky:
        def __init__(self):
            self.n = 0

        def __call__(self, request):
            self.n += 1
            if self.n == 1 or request == "never":
                raise RuntimeError("busy")
            return request.upper()

    df = spark.createDataFrame([("a",), ("never",), (None,)], "r string").coalesce(1)
    assert {r.r: r.reply for r in E.ask(df, "r", Flaky(), tries=2, wait=0.0).collect()} == {"a": "A", "never": None, None: None}
    text = "The first sentence is long enough here. The second sentence is long enough too."
    chunks = spark.createDataFrame([(i, "s" if i % 3 else "t", f"id{i}", "Sec", text, i == 5, "Ent" if i else None, "airline", "u") for i in range(9)] + [(99, "s", "n", None, None, None, None, None, None)], "chunk_no int, source_id string, id string, section string, text string, sent boolean, entity string, entity_type string, source string")
    refined = E.refine(chunks, E.SentenceBackend(), size=2)
    assert {(r.source_id, r.text) for r in refined.collect()} == {(s, t) for s in "st" for t in (text[:39], text[40:])}
    found = E.extract_services(chunks, E.KeywordBackend({"second": "kind"}))
    assert {(r.source_id, r.type) for r in found.collect()} == {("s", "kind"), ("t", "kind")}
    assert rows(E.entities(chunks, found).select("source_id", "entity_name")) == [("s", "Ent"), ("t", "t")]
    assert E.refine(chunks.where("false"), E.SentenceBackend()).count() == 0


def test_streams(spark, tmp_path):
    src, schema = str(tmp_path / "in"), "k string, v int, text string, at timestamp"
    write = lambda data: spark.createDataFrame(data, "k string, v int, text string, at string").select("k", "v", "text", F.to_timestamp("at").alias("at")).coalesce(1).write.mode("append").parquet(src)
    write([("a", 1, "x", "2025-01-01 00:00:00"), ("b", 1, "y", "2025-01-01 01:00:00"), ("a", 2, "x", "2025-01-01 02:00:00"), (None, 0, None, "2025-01-01 03:00:00")])
    struct = spark.read.schema(schema).parquet(src).schema
    table = ingest.VersionedTable(spark, str(tmp_path / "table"), "k", 4, 2)
    sink = ingest.upsert_sink(table, ["v"])
    seen = lambda: ingest.run_available(ingest.unseen(ingest.read_files(spark, src, struct), "text", "at", "1 day").select("content_id"), str(tmp_path / "c1"), out=str(tmp_path / "ids"))
    apply = lambda: ingest.run_available(ingest.read_files(spark, src, struct), str(tmp_path / "c2"), sink)
    seen(), apply()
    assert rows(table.read().select("k", "v")) == [("a", 2), ("b", 1)]
    write([("b", 5, "z", "2025-01-01 04:00:00"), ("a", 0, "y", "2025-01-01 04:00:00")])
    seen(), apply(), apply()
    assert rows(table.read().select("k", "v")) == [("a", 2), ("b", 5)]
    assert spark.read.parquet(str(tmp_path / "ids")).count() == 4
    again = table.versions()[-1]
    sink(spark.read.parquet(src), again)
    assert rows(table.read().select("k", "v")) == [("a", 2), ("b", 5)]
    before = table.folders(again)
    new = spark.createDataFrame([("b", 9, "z", None)], struct)
    sink(new, again + 1)
    now = table.folders(again + 1)
    assert sum(before[b] != now[b] for b in before) == 1 and rows(table.read().select("k", "v")) == [("a", 2), ("b", 9)]
    for n in range(2, 5):
        sink(new, again + n)
    assert len(table.versions()) == 2 and rows(table.read().select("k", "v")) == [("a", 2), ("b", 9)]


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("Café. Next".encode("latin-1"))
    (tmp_path / "b.txt").write_text("ONE LINE. second")
    (tmp_path / "c.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "d.json").write_text("[]")
    got = {os.path.basename(r.path): (r.kind, r.text, r.problem) for r in files.local_documents(spark, str(tmp_path)).collect()}
    assert got["b.txt"][1] == "ONE LINE.\n\nsecond".replace("ONE LINE.", "\n## ONE LINE.\n") and got["a.txt"][1] == "Caf .\n\nNext"
    assert got["c.pdf"][2] == "needs a PDF reader" and got["d.json"] == ("json", "[]", None)
    chunks = tmp_path / "chunks"
    chunks.mkdir()
    (chunks / "x.json").write_text(json.dumps([{"id": "1", "text": "t", "source_id": "x"}], indent=1))
    (chunks / "x_partial.json").write_text(json.dumps([{"id": "2"}]))
    (chunks / "empty.json").write_text("[]")
    assert [r.id for r in files.chunk_files(spark, str(chunks)).collect()] == ["1"]
    assert rows(files.file_hashes(spark, str(chunks)).where("source = 'empty'")) == [("empty", hashlib.sha256(b"[]").hexdigest())] and files.file_hashes(spark, str(chunks)).count() == 2
    words = spark.createDataFrame([(1, 5.0, 10.02, "b"), (1, 1.0, 10.0, "a"), (1, 1.0, 30.0, "c")], "page int, x0 double, top double, word string")
    assert rows(files.pdf_lines(words, ["page"]).select("line_no", "line")) == [(0, "a b"), (1, "c")]


def test_paged_source(spark):
    pages = {"u1": {"articles": [{"id": 1}], "next_page": "u2"}, "u2": {"articles": [{"id": 2}], "next_page": None}, "loop": {"articles": [{"id": 3}], "next_page": "loop"}}
    spark.dataSource.register(paged.paged_source("paged_test", lambda u: json.dumps(pages[u])))
    got = spark.read.format("paged_test").option("urls", json.dumps(["u1", "loop"])).load()
    assert rows(got) == [("loop", '{"id": 3}'), ("u1", '{"id": 1}'), ("u1", '{"id": 2}')]
    assert paged.resource_kind("/hc/en/sections/123-a-b") == ("sections", "123")


def test_command_line(capsys):
    from doclathe.__main__ import main

    assert main([]) == 0 and "chunk_counts" in capsys.readouterr().out and main(["none"]) == 1
