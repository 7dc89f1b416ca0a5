"""Matching, crawling, change detection, validation and stores on small tables."""

from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from doclathe.operators import crawl as CR
from doclathe.operators import incremental as I
from doclathe.operators import matching as M
from doclathe.operators import store as S
from doclathe.operators import validation as V

SVC = "array<struct<type:string,description:struct<en:string,ro:string>,is_presented:boolean>>"


def test_token_match(spark):
    index = spark.createDataFrame([("swiss", "D1"), ("swiss air", "D2"), ("porto", "D3")], "key string, doc string")
    names = spark.createDataFrame([("Swiss Air",), ("The Swiss porto lines",), ("porto swiss",), ("none",), (None,), ("",)] + [("SWISS",)] * 50, "name string")
    got = {(r.name, r.doc) for r in M.token_match(names, index).collect()}
    assert got == {("Swiss Air", "D2"), ("The Swiss porto lines", "D1"), ("porto swiss", "D3"), ("none", None), (None, None), ("", None), ("SWISS", "D1")}
    assert M.token_match(names, index).count() == 56 and M.token_match(names.where("false"), index).count() == 0


def test_index_last_wins(spark):
    docs = spark.createDataFrame([("a", "X", "Full X", 1), ("b", " x ", None, 2), ("bad", "x", None, 3)], "doc_id string, name string, full string, doc_no int")
    assert rows(M.name_index(docs, [F.col("name"), F.col("full")], skip=["bad"])) == [("full x", "a"), ("x", "b")]


def plain_shared(name, others):
    for o in others:
        if name.strip().lower() == o.strip().lower() or set(name.lower().split()) & set(o.lower().split()):
            return o
    return None


def test_shared_token_and_partition(spark):
    local, other = ["Alpha Air", "Beta", "gamma port", "Beta"], ["Zeta Air", "Alpha Air", "Port Gamma", "Only"]
    a = spark.createDataFrame([(x,) for x in local] + [("",), (None,)], "name string")
    b = spark.createDataFrame([(x, i) for i, x in enumerate(other)] + [(None, 9)], "other string, no int")
    got = {r.name: r.match for r in M.shared_token_match(a, b).collect()}
    assert all(got[n] == plain_shared(n, other) for n in local) and got[None] is None
    states = rows(M.tri_partition(a, b.withColumnRenamed("other", "name")))
    assert states == sorted([("Alpha Air", "in_sync"), ("Beta", "not_pushed"), ("Beta", "not_pushed"), ("gamma port", "in_sync"), ("Alpha Air", "only_in_db"), ("Only", "only_in_db")], key=repr)


def test_crawl_against_queue(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "a"), ("d", "e"), ("b", "x/login"), ("e", "f"), ("a", "b"), ("c", "bad"), ("bad", "z"), (None, "q")]
    pages = spark.createDataFrame([(u, u != "bad") for u in "abcdefz"] + [("bad", False)], "url string, accepted boolean")
    links = spark.createDataFrame(edges, "from_url string, to_url string")
    starts = spark.createDataFrame([("s", "a"), ("t", "d"), ("u", None), ("v", "missing")], "start string, url string")
    got = rows(CR.crawl(starts, links, pages).drop("place"))
    assert got == sorted([("s", "a", 0), ("s", "b", 1), ("s", "c", 1), ("s", "d", 2), ("s", "e", 3), ("s", "f", 4), ("t", "d", 0), ("t", "a", 1), ("t", "e", 1), ("t", "b", 2), ("t", "c", 2), ("t", "f", 2)], key=repr)
    limits = spark.createDataFrame([("s", 2), ("t", None)], "start string, max_pages int")
    assert [r.url for r in CR.first_pages(CR.crawl(starts, links, pages), limits).where("start = 's'").orderBy("rank").collect()] == ["a", "b"]
    assert {r.depth for r in CR.crawl(starts, links, pages, depth=1).collect()} == {0, 1}


def test_crawl_in_order_of_discovery(spark):
    """A queue met z before b, as z stands first on its page; what z links to comes before what b links to."""
    links = spark.createDataFrame([("a", "z", 0), ("a", "b", 1), ("b", "c", 0), ("z", "y", 5), ("z", "x", 2), ("b", "y", 0)], "from_url string, to_url string, pos int")
    starts, limits = spark.createDataFrame([("s", "a")], "start string, url string"), spark.createDataFrame([("s", 9)], "start string, max_pages int")
    assert [r.url for r in CR.first_pages(CR.crawl(starts, links), limits).orderBy("rank").collect()] == ["a", "z", "b", "x", "y", "c"]
    assert CR.crawl(starts.where("false"), links).count() == 0
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}", 0) for i in range(14)], "from_url string, to_url string, pos int")
    assert CR.crawl(spark.createDataFrame([("s", "n0")], "start string, url string"), chain).count() == 15


def test_reuse_plan_and_merge(spark):
    cur = spark.createDataFrame([("same", "h", 1), ("nocache", "h", 1), ("changed", "h2", 1), ("new", "h", 1), ("empty", "h9", 0)], "source string, content_hash string, n_rows int")
    man = spark.createDataFrame([("same", "h"), ("nocache", "h"), ("changed", "h1"), ("empty", "h8")], "source string, content_hash string")
    cached = spark.createDataFrame([("same", 1), ("changed", 2), ("empty", 3)], "source string, v int")
    plan = I.plan_reuse(cur, man, cached)
    assert {r.source: r.action for r in plan.collect()} == {"same": "reuse", "nocache": "extract", "changed": "extract", "new": "new", "empty": "skip"}
    fresh = spark.createDataFrame([("nocache", 10), ("same", 99)], "source string, v int")
    assert rows(I.merge_results(plan, cached, fresh)) == [("nocache", 10), ("same", 1)]
    assert rows(I.merge_results(plan, cached, fresh, keep_stale=True)) == [("changed", 2), ("empty", 3), ("nocache", 10), ("same", 1)]


def test_changes_and_versions(spark):
    schema = "rule_id string, category string, title string, description string, source string, version int, no int"
    old = spark.createDataFrame([("R1", "c", "T", "d", "s", 1, 0), ("R2", "c", "T", "d", "s", 3, 0), ("R3", "c", "T", "d", "s", 1, 0), ("R1", "c", "first", "d", "s", 1, -1)], schema)
    new = spark.createDataFrame([("R1", "c", " t ", "D", "s", 1, 0), ("R2", "c", "T", "new", "s", 3, 0), ("R4", "c", "T", "d", "s", None, 0)], schema)
    a, b = I.snapshot(new, ["no", "title"]), I.snapshot(old, ["no", "title"])
    assert rows(I.detect_changes(a, b)) == [("R1", "unchanged"), ("R2", "modified"), ("R3", "removed"), ("R4", "added")]
    assert {r.rule_id: r.version for r in I.apply_versions(a, b).collect()} == {"R1": 1, "R2": 4, "R4": 1}
    assert {r.change: r.n for r in I.change_report(I.detect_changes(a, a)).collect()} == {"added": 0, "removed": 0, "modified": 0, "unchanged": 3}
    assert {r.change for r in I.detect_changes(a, b.where("false")).collect()} == {"added"}


def entity(name, kind, services, source="s"):
    return (name, kind, source, services, 1)


def test_entity_issues(spark):
    good = ("a", ("x" * 20, "r"), True)
    data = [entity("Ok", "airline", [good]), entity(None, None, None), entity(" ", "hotel", []), entity("Bad", "airport", [("a", ("x" * 19, " "), True), ("A ", None, True), None, (None, ("y" * 20, "r"), None)])]
    df = spark.createDataFrame(data, f"entity_name string, entity_type string, source_id string, services {SVC}, entity_no int")
    issues = V.entity_issues(df)
    found = {(r.entity_id, r.check, r.severity, r.svc_no) for r in issues.collect()}
    assert {x for x in found if x[0] == "Ok"} == set()
    assert {x[1:] for x in found if x[0] == "s"} == {("entity_structure", "error", -1), ("entity_type", "error", -1), ("services_present", "error", -1)}
    assert {x[1:] for x in found if x[0] == "Bad"} == {("service_structure", "error", 0), ("service_structure", "warning", 0), ("service_structure", "error", 1), ("service_structure", "warning", 1), ("service_structure", "error", 2), ("service_structure", "error", 3), ("duplicate_types", "warning", -1)}
    assert [r.entity_name for r in V.clean_entities(df, issues).collect()] == ["Ok"]
    assert V.totals(df, issues).first()[:4] == (4, 1, 3, 25)
    assert V.totals(df.where("false"), issues.where("false")).first().pass_rate is None


def test_shapes(spark):
    data = [(1, "[]"), (2, '{"a": 1}'), (3, "no json"), (4, None), (5, '[1, {"description": "s"}, {"is_presented": "x"}, {"is_presented": null, "description": {}}]')]
    got = rows(V.shape_issues(spark.createDataFrame(data, "entity_no int, services_json string")))
    assert [(a, b) for a, b, _ in got] == [(2, None), (3, None), (4, None), (5, 0), (5, 1), (5, 2)] or {a for a, _, _ in got} == {2, 3, 4, 5}
    assert len([g for g in got if g[0] == 5]) == 3


def test_gaps_and_rules(spark):
    ids = spark.createDataFrame([(i,) for i in [1, 2, 5, 6, 6, 9, 100]] + [(None,)], "n int")
    assert rows(V.id_gaps(ids, F.col("n"))) == [(2, 5), (6, 9), (9, 100)]
    rule = spark.createDataFrame([("R1", "c", "t", "SHORT", "s"), ("X", None, "t", "A description that may vary from case to case.", "s")], "rule_id string, category string, title string, description string, source string")
    assert rows(V.rule_issues(rule)) == [("R1", "quality", "description is in capitals"), ("R1", "quality", "description is short"), ("X", "quality", "description is vague"), ("X", "structure", "category is missing"), ("X", "structure", "rule_id has another form")]


def test_upsert_is_idempotent(spark):
    base = spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], "k string, v int, at int")
    new = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", 5, 1), (None, 6, 1)], "k string, v int, at int")
    once = S.upsert(base, new, "k", ["at", "v"])
    assert rows(once) == [("a", 1, 0), ("b", 4, 2), ("c", 5, 1)] == rows(S.upsert(once, new, "k", ["at", "v"]))
    assert S.outcomes(new, "k").first()[:3] == (4, 3, 1)
    assert rows(S.upsert(base.where("false"), new, "k", ["at", "v"])) == [("b", 4, 2), ("c", 5, 1)]


def test_push(spark):
    e = spark.createDataFrame([(1, "Alpha", "airline", "new"), (2, "alpha air", "airline", "newer"), (3, "Nowhere", "airport", "x"), (4, "Law", "regulator", "x"), (5, None, "airline", "y")], "entity_no int, entity_name string, entity_type string, services string")
    docs = spark.createDataFrame([("D1", "airline", "old"), ("D2", "airport", "old")], "doc_id string, entity_type string, services string")
    index = spark.createDataFrame([("alpha", "D1", "airline"), ("nowhere", "D9", "airline")], "key string, doc string, kind string")
    got = {(r.doc_id, r.services, r.outcome) for r in S.push_services(e, docs, index).collect()}
    assert got == {("D1", "newer", "updated"), ("new:nowhere", "x", "inserted"), (None, "x", "skipped"), ("new:", "y", "inserted"), ("D2", "old", "kept")}


def test_listing_and_deletes(spark):
    t = datetime(2025, 3, 4, 5)
    air = spark.createDataFrame([("a", "", None, t)], "doc_id string, name string, services array<int>, updated_at timestamp")
    port = spark.createDataFrame([("p", None, "Full", [1, 2], None)], "doc_id string, name string, full_name string, services array<int>, updated_at timestamp")
    reg = spark.createDataFrame([("r", "Reg", None, [1], t)], "doc_id string, name string, entity_type string, services array<int>, updated_at timestamp")
    assert rows(S.listing(air, port, reg)) == [("Full", "airport", "p", 2, "", "airports"), ("Reg", "reference", "r", 1, "2025-03-04", "regulations"), ("a", "airline", "a", 0, "2025-03-04", "airlines")]
    assert S.delete_keys(air, ["a"]).count() == 0 and S.delete_keys(air, []).count() == 1
    got = S.sync_metadata(spark.createDataFrame([("a",), ("z",)], "doc_id string"), air, ["services"])
    assert {(r.doc_id, r.state) for r in got.collect()} == {("a", "present"), ("z", "placeholder")} and "services" not in got.columns
