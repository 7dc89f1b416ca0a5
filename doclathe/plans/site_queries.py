"""Queries of page structure, help centres, posts by tag, writers and joins by time, with the SQL that checks them."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from doclathe.functions import text as T
from doclathe.operators import chunking as C
from doclathe.operators import htmlops as H
from doclathe.operators import incremental as I
from doclathe.operators import relational as RL
from doclathe.operators import report as RP
from doclathe.operators import store as S
from doclathe.operators import validation as V
from doclathe.plans.record_queries import _index, _index_sql, _issue_sql, _issues, _nk, _ok
from doclathe.plans.text_queries import lit, strip, sub, words
from doclathe.runtime import shared_dir, table
from doclathe.sources import files as FS
from doclathe.sources import paged as P

QUERIES, ORACLES = {}, {}
WS = T.WS


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _folder(spark) -> str:
    return os.path.join(shared_dir(spark), f"doclathe-files-{uuid.uuid4().hex}")


# --- pages made of lines: what each element must give is known ---------------------------------------------------------------------------------

_escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _pages(spark, d):
    """page_texts as pages: the source as title and heading, menus and scripts around, lines as paragraphs, the page's number in a table and a teaser."""
    t = table(spark, d, "page_texts").where("text is not null").select("page_id", "source", F.coalesce("source_id", F.lit("none")).alias("sid"), F.split("text", "\n").alias("l"))
    body = F.array_join(F.transform("l", lambda x: F.concat(F.lit("<p>"), _escaped(x), F.lit("</p>"))), "\n")
    no = F.col("page_id").cast("string")
    html = F.concat(
        F.lit("<!doctype html><html><head><title>"), "sid", F.lit("</title><style>p{}</style></head><body><nav><a href='/menu'>Menu of the whole site</a></nav><div class='cookie-box'>We use cookies on this site</div><main><h2>"), "sid",
        F.lit("</h2>"), body, F.lit("<ul class='acc'><li class='accordion-box'><b class='accordion-title'>Box "), no, F.lit("</b><div class='accordion-content'>Unfolded text "), no, F.lit("</div></li><li class='accordion-box'><b class='accordion-title'>Empty</b></li></ul>"),
        F.lit("<table><tr><th>No</th><th>Page</th></tr><tr><td>1</td><td>"), no, F.lit("</td></tr></table><a class='teaser partner' href='/t/"), no, F.lit("#x'>T</a><a class='teaser partner' href='/t/"), no,
        F.lit("#x'>T</a><a class='teaser' href='/u'>U</a><a href='https://x.example/legal-content/EN/TXT/?uri=CELEX:"), no, F.lit("&tab=2#y'>L</a><p class='oj-hd-date'>1.2.2003</p><p class='oj-hd-oj'>L "), no,
        F.lit("/1</p><p class='oj-doc-ti'>REGULATION</p><p class='oj-doc-ti'>of page "), no, F.lit("</p></main><footer>Footer</footer><script>var x = '</p>';</script></body></html>"),
    )
    return t.select("page_id", html.alias("html"), F.concat(F.lit("https://x.example/legal-content/EN/TXT/?uri=CELEX:"), no).alias("url"))


_line = lambda x: strip(sub(x, WS + "+", " "))
_p = "p AS (SELECT page_id, coalesce(source_id, 'none') AS sid, string_split(text, chr(10)) AS l FROM page_texts WHERE text IS NOT NULL)"
_tail = "['Box ' || page_id, 'Unfolded text ' || page_id, 'Empty', 'No', 'Page', '1', page_id::VARCHAR, 'TTUL', '1.2.2003', 'L ' || page_id || '/1', 'REGULATION', 'of page ' || page_id]"


@query(f"WITH {_p} SELECT page_id, md5(array_to_string(list_filter(list_concat([sid], list_transform(l, lambda x: {_line('x')}), {_tail}), lambda x: x <> '' AND NOT regexp_matches(x, '^[-–—_=~*#|─-▟ ]+$')), chr(10) || chr(10))) AS md5 FROM p")
def q_html_clean(spark, d):
    return H.clean_pages(_pages(spark, d), "page_id").select("page_id", F.md5("text").alias("md5"))


@query(f"""WITH {_p}, b AS (SELECT page_id, sid, unnest(list_concat(list_filter(list_transform(l, lambda x: {_line('x')}), lambda x: length(x) >= 15), ['Unfolded text ' || page_id])) AS text FROM p)
    SELECT page_id, sid AS heading, 2 AS heading_level, md5(text) AS md5, count(*) AS n FROM b GROUP BY ALL""")
def q_html_blocks(spark, d):
    return H.page_blocks(_pages(spark, d), "page_id").groupBy("page_id", "heading", "heading_level", F.md5("text").alias("md5")).agg(F.count("*").alias("n"))


_main = "['Box ' || page_id, 'Unfolded text ' || page_id, 'Empty', 'No', 'Page', '1  ' || page_id, 'T T U L', '1.2.2003', 'L ' || page_id || '/1', 'REGULATION', 'of page ' || page_id]"


@query(f"WITH {_p} SELECT page_id, sid AS title, md5(array_to_string(list_filter(list_concat([sid], list_transform(l, lambda x: {_line('x')}), {_main}), lambda x: x <> ''), chr(10) || chr(10))) AS md5 FROM p")
def q_html_content(spark, d):
    return H.page_content(_pages(spark, d), "page_id").select("page_id", "title", F.md5("text").alias("md5"))


@query(f"""WITH {_p}, k AS (SELECT page_id, sid, list_filter(list_transform(l, lambda x: {_line('x')}), lambda x: length(x) >= 21) AS k, array_to_string(list_filter(list_concat([sid], list_transform(l, lambda x: {_line('x')}), {_tail}), lambda x: x <> '' AND NOT regexp_matches(x, '^[-–—_=~*#|─-▟ ]+$')), chr(10) || chr(10)) AS whole FROM p)
    SELECT page_id, 0 AS pos, CASE WHEN len(k) > 0 THEN sid END AS heading, md5(left(CASE WHEN len(k) > 0 THEN array_to_string(k, chr(10)) ELSE whole END, 2000)) AS md5 FROM k""")
def q_html_sections(spark, d):
    return H.page_heading_sections(_pages(spark, d), "page_id").select("page_id", "pos", "heading", F.md5("body").alias("md5"))


@query(f"WITH {_p} SELECT page_id, 'REGULATION — of page ' || page_id AS title, '1.2.2003' AS published, 'L ' || page_id || '/1' AS reference FROM p")
def q_legal_metadata(spark, d):
    return H.page_legal_metadata(_pages(spark, d), "page_id")


@query(f"WITH {_p} SELECT page_id, 0 AS pos, 'Box ' || page_id AS heading, 'Unfolded text ' || page_id AS body FROM p")
def q_accordion(spark, d):
    return H.page_sections_by(_pages(spark, d), "page_id", H.accordion)


@query(f"""WITH {_p}, w AS (SELECT page_id, sid, list_concat(list_filter(list_transform(l, lambda x: {_line('x')}), lambda x: length(x) > 15), list_filter(['Box ' || page_id || ' Unfolded text ' || page_id, '| No | Page |' || chr(10) || '| --- | --- |' || chr(10) || '| 1 | ' || page_id || ' |', 'of page ' || page_id], lambda x: length(x) > 15)) AS b FROM p)
    SELECT page_id, 0 AS pos, sid AS heading, md5(array_to_string(b, ' ')) AS md5 FROM w""")
def q_section_walk(spark, d):
    return H.page_sections_by(_pages(spark, d), "page_id", H.section_walk).where("heading <> ''").select("page_id", F.lit(0).alias("pos"), "heading", F.md5("body").alias("md5"))


@query(f"WITH {_p} SELECT page_id, 0 AS pos, 'https://x.example/t/' || page_id || '#x' AS link FROM p")
def q_teaser_links(spark, d):
    return H.page_links_by(_pages(spark, d), "page_id", lambda h, b: H.teaser_links(h, b, ("teaser", "partner"), "x.example"))


@query(f"WITH {_p} SELECT page_id, 0 AS pos, 'https://x.example/legal-content/EN/TXT/?uri=CELEX:' || page_id || '&tab=2' AS link FROM p")
def q_same_document_links(spark, d):
    return H.page_links_by(_pages(spark, d), "page_id", H.same_document_links)


@query(f"WITH {_p} SELECT page_id, 0 AS pos, '| No | Page |' || chr(10) || '| --- | --- |' || chr(10) || '| 1 | ' || page_id || ' |' AS text FROM p")
def q_tables(spark, d):
    return H.page_tables(_pages(spark, d), "page_id")


@query(f"""WITH {_p}, k AS (SELECT page_id, sid, list_filter(list_transform(l, lambda x: {_line('x')}), lambda x: length(x) >= 15) AS l FROM p), u AS (SELECT page_id, sid, list_concat(l, ['Unfolded text ' || page_id]) AS l FROM k),
    f AS (SELECT page_id, sid, list_transform(list_filter(list_zip(l, range(1, 1 + len(l))), lambda z: list_position(list_transform(l, lambda x: lower(x)), lower(z[1])) = z[2]), lambda z: z[1]) AS l FROM u)
    SELECT page_id, md5('## ' || sid || chr(10) || chr(10) || array_to_string(l, chr(10) || chr(10))) AS md5 FROM f""")
def q_clean_records(spark, d):
    """Pages in an envelope of JSON, with the escapes of an API."""
    raw = F.concat(F.lit('{"article":'), F.to_json(F.struct(F.lit("t").alias("title"), F.col("html").alias("body"))), F.lit("}"))
    pages = _pages(spark, d).select("page_id", F.replace(raw, F.lit("&"), F.lit("\\u0026")).alias("text"))
    return H.clean_records(pages, "page_id").select("page_id", F.md5("text").alias("md5"))


# --- help centres and posts by tag -----------------------------------------------------------------------------------------------------------


def _help(spark, d):
    t = table(spark, d, "documents")
    articles = t.select(F.col("doc_id").alias("id"), (F.col("doc_id") % 97).alias("section_id"), F.col("section").alias("title"), F.col("url").alias("html_url"), F.col("lang").alias("locale"), F.concat(F.lit("<p>"), _escaped(F.coalesce("source", F.lit(""))), F.lit("</p>\n<p>two</p>")).alias("body"), F.lit(None).cast("string").alias("created_at"), F.col("loaded_at").cast("string").alias("updated_at"))
    sections = t.select((F.col("doc_id") % 97).alias("id")).distinct().withColumn("category_id", F.col("id") % 7)
    urls = t.select(F.explode(F.array(*(F.concat(F.lit(a), F.col("doc_id").cast("string"), F.lit(b)) for a, b in (("https://h.example/hc/en/articles/", "-a-name"), ("/hc/en/sections/", ""), ("/hc/en/categories/", "-c"), ("/hc/en/users/", ""), ("/hc/", ""))))).alias("url"))
    return urls, sections, articles


@query("""
    WITH a AS (SELECT doc_id AS id, doc_id % 97 AS section_id FROM documents), s AS (SELECT DISTINCT section_id AS id, section_id % 7 AS category_id FROM a)
    SELECT 'https://h.example/hc/en/articles/' || id || '-a-name' AS url, section_id, count(*) AS n FROM a GROUP BY ALL
    UNION ALL SELECT '/hc/en/sections/' || d.doc_id, a.section_id, count(*) FROM documents d JOIN a ON a.section_id = d.doc_id GROUP BY ALL
    UNION ALL SELECT '/hc/en/categories/' || d.doc_id || '-c', a.section_id, count(*) FROM documents d JOIN s ON s.category_id = d.doc_id JOIN a ON a.section_id = s.id GROUP BY ALL""")
def q_help_centre(spark, d):
    return P.articles_of(*_help(spark, d)).groupBy("url", "section_id").agg(F.count("*").alias("n"))


@query("SELECT unnest(['/hc/en/users/' || doc_id, '/hc/' || doc_id]) AS url, 'no resource of a help centre' AS problem FROM documents")
def q_unresolved_urls(spark, d):
    return P.unresolved(_help(spark, d)[0])


@query(f"""SELECT doc_id AS id, coalesce(section, '') AS title, coalesce(url, '') AS url, doc_id % 97 AS section_id, coalesce(lang, '') AS locale, CASE WHEN {strip("coalesce(source, '')")} = '' THEN 'two' ELSE {strip('source')} || chr(10) || 'two' END AS body, '' AS created_at FROM documents""")
def q_articles(spark, d):
    return P.normalise_articles(_help(spark, d)[2]).drop("updated_at")


_TAGS = ("oxygen", "Wheelchair", "dog", "liftul", "hund")


@query("""
    WITH t AS (SELECT unnest(range(1, 6)) AS no, unnest(['oxygen', 'Wheelchair', 'dog', 'liftul', 'hund']) AS tag), h AS (SELECT no, tag, doc_id, text FROM documents JOIN t ON contains(lower(text), lower(tag)))
    SELECT tag, doc_id FROM h QUALIFY row_number() OVER (PARTITION BY text ORDER BY no, doc_id) = 1""")
def q_tag_fan_out(spark, d):
    return P.tagged(table(spark, d, "documents").select("doc_id", "text"), _TAGS, "text", "doc_id", "doc_id").select("tag", "doc_id")


# --- writers, read back ----------------------------------------------------------------------------------------------------------------------


@query("SELECT entity_id, source_id, entity_name, coalesce(len(services), 0)::INT AS n, count(*) AS copies FROM clean_entities GROUP BY ALL")
def q_combined_output(spark, d):
    t, out = table(spark, d, "clean_entities"), _folder(spark)
    FS.write_combined(t, out)
    back = spark.read.schema(t.schema).json(out)
    return back.groupBy("entity_id", "source_id", "entity_name", F.when(F.col("services").isNull(), 0).otherwise(F.size("services")).alias("n")).agg(F.count("*").alias("copies"))


@query(f'WITH {_issue_sql} SELECT \'issues\' AS part, "check" AS name, count(*) AS n FROM i GROUP BY ALL UNION ALL SELECT \'summary\', "check", count(*) FROM i GROUP BY ALL UNION ALL SELECT \'clean\', entity_type, count(*) FROM ({_ok}) GROUP BY ALL')
def q_report_files(spark, d):
    e, out = table(spark, d, "clean_entities"), _folder(spark)
    issues = _issues(spark, d)
    clean = V.clean_entities(e.withColumnRenamed("entity_id", "eid"), issues).withColumnRenamed("eid", "entity_id")
    FS.write_report(issues, clean, out)
    part = lambda name, schema, column, n: spark.read.schema(schema).json(f"{out}/{name}").groupBy(F.lit(name).alias("part"), F.col(column).alias("name")).agg(n.alias("n"))
    counted = part("summary", "check string, error long, warning long", "check", F.sum(F.col("error") + F.col("warning")))
    return part("issues", "check string", "check", F.count("*")).unionByName(counted).unionByName(part("clean", "entity_type string", "entity_type", F.count("*")))


@query("""
    WITH h AS (SELECT source_id AS source, count(*) AS n FROM page_texts WHERE source_id IS NOT NULL GROUP BY ALL), early AS (SELECT source_id AS source, count(*) AS n FROM page_texts WHERE source_id IS NOT NULL AND page_no <= 20 GROUP BY ALL)
    SELECT h.source, CASE WHEN early.n = h.n THEN 'reuse' WHEN early.n IS NULL THEN 'new' ELSE 'extract' END AS action, h.n AS pages FROM h LEFT JOIN early USING (source)""")
def q_cache_manifest(spark, d):
    """Two runs over a cache: first the pages up to the twentieth of each source, then all; results that nothing changed for come from the cache."""
    t = table(spark, d, "page_texts").where("source_id is not null")
    cache = FS.ResultCache(spark, _folder(spark), "source string, pages long")
    plan = None
    for part in (t.where("page_no <= 20"), t):
        hashes = I.source_hashes(part, "source_id", ["page_id"], "text").join(part.groupBy(F.col("source_id").alias("source")).agg(F.count("*").alias("n_rows")), "source")
        results, manifest = cache.read()
        plan = I.plan_reuse(hashes, manifest, results)
        fresh = part.groupBy(F.col("source_id").alias("source")).agg(F.count("*").alias("pages"))
        cache.write(I.merge_results(plan, results, fresh), hashes)
    return plan.select("source", "action").join(cache.read()[0], "source")


_snap = f"""SELECT upper({strip('rule_id')}) AS rule_id, sha256(lower({strip("coalesce(title, '')")}) || '||' || lower({strip("coalesce(description, '')")})) AS content_hash FROM rule_snapshots WHERE rule_id IS NOT NULL AND snapshot_no = (SELECT max(snapshot_no) FROM rule_snapshots)
    QUALIFY row_number() OVER (PARTITION BY upper({strip('rule_id')}) ORDER BY loaded_at DESC NULLS LAST, title DESC NULLS LAST, description DESC NULLS LAST, version DESC NULLS LAST, category DESC NULLS LAST, source DESC NULLS LAST) = 1"""


@query(f"""WITH s AS ({_snap}) SELECT rule_id, content_hash, (SELECT sha256('[' || string_agg('{{"hash": "' || content_hash || '", "rule_id": "' || rule_id || '"}}', ', ' ORDER BY rule_id, content_hash) || ']') FROM s) AS ruleset_hash FROM s""")
def q_snapshot_files(spark, d):
    """Every snapshot saved, the latest loaded."""
    t, out = table(spark, d, "rule_snapshots").withColumn("rule_id", F.upper(T.strip(F.col("rule_id")))), _folder(spark)
    rules = I.snapshot(t, ["loaded_at", "title", "description", "version", "category", "source"], ["snapshot_no"])
    for (no,) in rules.select("snapshot_no").distinct().orderBy("snapshot_no").collect():  # a handful of snapshots
        I.save_snapshot(rules.where(F.col("snapshot_no") == no).drop("snapshot_no"), out, f"{no:05d}")
    return I.load_snapshot(spark, out).select("rule_id", "content_hash", "ruleset_hash")


@query("SELECT id || '.json' AS file, CASE WHEN length(id) % 3 <> 0 THEN '{\"source\":\"' || id || '\"}' END AS value, count(*) OVER () AS files FROM (SELECT DISTINCT id FROM sources)")
def q_json_files(spark, d):
    """A file per source, some of them broken."""
    out = _folder(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for r in table(spark, d, "sources").select("id").distinct().collect():  # forty at every scale
        stream = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"{r.id}.json"))
        stream.write(bytearray((f'{{"source":"{r.id}"}}' if len(r.id) % 3 else f'{{"source": {r.id}').encode()))
        stream.close()
    return FS.json_files(spark, out).withColumn("files", F.lit(FS.file_count(spark, out)).cast("long"))


_push = f"""
    e AS (SELECT *, rank() OVER (ORDER BY entity_id, updated_at) AS no FROM (SELECT DISTINCT entity_id, updated_at, entity_name, entity_type FROM clean_entities)),
    n AS (SELECT DISTINCT entity_name AS name, entity_type AS kind FROM e WHERE entity_type IN ('airline', 'airport') AND entity_name IS NOT NULL), i AS ({_index_sql}),
    t AS (SELECT name, kind, 0 AS pos, {_nk('name')} AS key FROM n UNION ALL SELECT name, kind, k, w[k] FROM (SELECT name, kind, w, unnest(range(1, 1 + len(w))) AS k FROM (SELECT name, kind, {words(_nk('name'))} AS w FROM n))),
    h AS (SELECT name, kind, arg_min(doc, pos) AS doc FROM t JOIN i USING (key, kind) GROUP BY ALL),
    p AS (SELECT coalesce(h.doc, 'new:' || {_nk("coalesce(entity_name, '')")}) AS doc_id, h.doc IS NULL AS new, e.entity_name, e.entity_type, e.entity_id, no FROM e LEFT JOIN h ON h.name = e.entity_name AND h.kind = e.entity_type WHERE e.entity_type IN ('airline', 'airport')),
    l AS (SELECT doc_id, arg_max(new, no) AS new, arg_max(entity_name, no) AS entity_name, arg_max(entity_type, no) AS entity_type, arg_max(entity_id, no) AS services FROM p GROUP BY doc_id),
    docs AS (SELECT airline_id AS doc_id, 'airline' AS entity_type, min(name) AS name FROM airlines GROUP BY ALL UNION ALL SELECT airport_id, 'airport', min(name) FROM airports GROUP BY ALL)"""


@query(f"""WITH {_push} SELECT d.doc_id, d.entity_type, d.name, CASE WHEN NOT l.new THEN l.services ELSE '' END AS services, CASE WHEN NOT l.new THEN 'now' ELSE 'before' END AS updated_at, 'kept' AS icon, NULL AS full_name, 1::BIGINT AS fields FROM docs d LEFT JOIN l ON l.doc_id = d.doc_id AND NOT l.new
    UNION ALL SELECT doc_id, entity_type, entity_name, services, 'now', CASE WHEN entity_type = 'airline' THEN '' END, CASE WHEN entity_type = 'airport' THEN entity_name END, CASE WHEN entity_type = 'airline' THEN 6 ELSE 7 END FROM l WHERE new""".replace("CASE WHEN NOT l.new THEN l.services ELSE '' END", "CASE WHEN l.doc_id IS NOT NULL THEN l.services ELSE '' END").replace("CASE WHEN NOT l.new THEN 'now'", "CASE WHEN l.doc_id IS NOT NULL THEN 'now'"))
def q_push_documents(spark, d):
    """The entity's id stands for its services, so that what a document got can be seen."""
    e = table(spark, d, "clean_entities").select("entity_id", "updated_at", "entity_name", "entity_type").distinct().withColumn("services", F.col("entity_id")).withColumn("entity_no", F.struct("entity_id", "updated_at"))
    part = lambda name, key, kind: table(spark, d, name).groupBy(F.col(key).alias("doc_id"), F.lit(kind).alias("entity_type")).agg(F.min("name").alias("name"))
    docs = part("airlines", "airline_id", "airline").unionByName(part("airports", "airport_id", "airport")).select("*", F.lit("").alias("services"), F.lit("before").alias("updated_at"), F.create_map(F.lit("icon"), F.lit("kept")).alias("fields"))
    out = S.push_documents(e, docs, _index(spark, d), "now")
    return out.select("doc_id", "entity_type", "name", "services", "updated_at", F.try_element_at("fields", F.lit("icon")).alias("icon"), F.try_element_at("fields", F.lit("full_name")).alias("full_name"), F.size("fields").cast("long").alias("fields"))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE entity_type IN ('airline', 'airport')) - count(*) FILTER (WHERE entity_type IN ('airline', 'airport') AND services IS NULL AND coalesce(entity_name, '') = '') AS updated, count(*) FILTER (WHERE coalesce(entity_type, '') NOT IN ('airline', 'airport')) AS skipped, count(*) FILTER (WHERE entity_type IN ('airline', 'airport') AND services IS NULL AND coalesce(entity_name, '') = '') AS errors FROM clean_entities")
def q_push_report(spark, d):
    return S.push_report(table(spark, d, "clean_entities"))


@query(f"WITH {_issue_sql} SELECT entity_id, updated_at, count(*) AS n FROM e WHERE eid IN (SELECT entity_id FROM i WHERE severity = 'error') GROUP BY ALL")
def q_failed_entities(spark, d):
    return V.failed_entities(table(spark, d, "clean_entities"), _issues(spark, d)).groupBy("entity_id", "updated_at").agg(F.count("*").alias("n"))


_folded = lambda c: f"lower({strip(sub(f"coalesce({c}, '')", WS + '+', ' '))})"


@query(f"SELECT title, count(DISTINCT source) AS sources, count(DISTINCT text) AS texts FROM (SELECT {_folded('title')} AS title, source, {_folded('description')} AS text FROM rule_snapshots) WHERE title <> '' AND text <> '' AND source IS NOT NULL GROUP BY title HAVING count(DISTINCT source) > 1 AND count(DISTINCT text) > 1")
def q_cross_source(spark, d):
    return V.cross_source(table(spark, d, "rule_snapshots"))


@query("SELECT doc_id, md5(array_to_string(list_slice(l, greatest(len(l) - 2, 1), len(l)), chr(10))) AS lines, md5(right(text, 100)) AS tail FROM (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)")
def q_log_tails(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.md5(RP.tail_lines(F.col("text"), 3)).alias("lines"), F.md5(RP.tail(F.col("text"), 100)).alias("tail"))


@query("SELECT rpad(coalesce(category, '-'), 24, ' ') || ' ' || lpad(count(*)::VARCHAR, 10, ' ') AS line FROM rule_snapshots GROUP BY category")
def q_text_report(spark, d):
    return RP.text_report(table(spark, d, "rule_snapshots").groupBy("category").agg(F.count("*").alias("n")), "category")


@query("SELECT id, row_number() OVER (ORDER BY entity, id) AS place FROM (SELECT DISTINCT entity, id FROM sources) WHERE id IS NOT NULL")
def q_sorted_values(spark, d):
    """A global order without one task for all: places by range partitions."""
    from doclathe.operators.records import numbered

    return numbered(table(spark, d, "sources").where("id is not null").select("entity", "id").distinct(), ["entity", "id"], "place").select("id", "place")


# --- joins by time and grouping --------------------------------------------------------------------------------------------------------------


@query("""
    WITH r AS (SELECT user_id, ts, max(event_id) AS id FROM events WHERE value > 50 AND ts IS NOT NULL GROUP BY ALL), b AS (SELECT event_id, user_id, ts, NULL AS id FROM events UNION ALL SELECT NULL, user_id, ts, id FROM r)
    SELECT event_id, last_id FROM (SELECT event_id, ts, last_value(id IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_id FROM b) WHERE event_id IS NOT NULL""")
def q_as_of(spark, d):
    """Each event with the last one of its user, at its time or before, whose value is over 50."""
    t = table(spark, d, "events")
    right = t.where("value > 50").groupBy("user_id", "ts").agg(F.max("event_id").alias("id"))
    return RL.as_of(t.select("event_id", "user_id", "ts"), right, ["user_id"], "ts").select("event_id", F.col("last.id").alias("last_id"))


@query("""
    WITH s AS (SELECT snapshot_no, min(snapshot_at) AS a FROM rule_snapshots GROUP BY 1), i AS (SELECT snapshot_no, a, lead(a) OVER (ORDER BY snapshot_no) AS b FROM s)
    SELECT snapshot_no, source_id, count(*) AS n FROM semantic_chunks JOIN i ON fetched_at >= a AND fetched_at < b GROUP BY ALL""")
def q_interval_join(spark, d):
    """Chunks fetched between one snapshot and the next."""
    from pyspark.sql import Window as W

    s = table(spark, d, "rule_snapshots").groupBy("snapshot_no").agg(F.min("snapshot_at").alias("a"))
    spans = s.withColumn("b", F.lead("a").over(W.orderBy("snapshot_no")))  # a handful of snapshots
    found = RL.interval_join(table(spark, d, "semantic_chunks").select("source_id", "fetched_at"), spans, "fetched_at", "a", "b")
    return found.groupBy("snapshot_no", "source_id").agg(F.count("*").alias("n"))


@query("SELECT p.source_id, count(*) AS n FROM page_texts p JOIN scrape_results s ON p.source_id = s.source_id AND abs(epoch_us(p.fetched_at) - epoch_us(s.fetched_at)) <= 43200000000 GROUP BY ALL")
def q_band_join(spark, d):
    """Pages and scrapes of one source within half a day of each other."""
    p, s = table(spark, d, "page_texts").select("source_id", F.col("fetched_at").alias("a")), table(spark, d, "scrape_results").select("source_id", F.col("fetched_at").alias("b"))
    return RL.band_join(p, s, "a", "b", 43_200, ["source_id"]).groupBy("source_id").agg(F.count("*").alias("n"))


@query("SELECT GROUPING(entity_type)::INT AS no_type, GROUPING(source_id)::INT AS no_source, entity_type, source_id, count(*) AS n, count(DISTINCT section) AS sections FROM semantic_chunks GROUP BY CUBE (entity_type, source_id)")
def q_cube(spark, d):
    t = table(spark, d, "semantic_chunks").cube("entity_type", "source_id")
    return t.agg(F.grouping("entity_type").cast("int").alias("no_type"), F.grouping("source_id").cast("int").alias("no_source"), F.count("*").alias("n"), F.count_distinct("section").alias("sections"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(1 - l_discount AS DECIMAL(4, 2)))::DOUBLE AS revenue FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def q_rollup(spark, d):
    money = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount")).cast("decimal(4,2)")
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(money).cast("double").alias("revenue"))


_SQL = "SELECT lang, source, count(*) AS n FROM documents GROUP BY GROUPING SETS ((lang), (source), ())"


def catalog(spark, d: str, names: list[str]) -> None:
    """Temporary views of tables, for queries in SQL."""
    for name in names:
        table(spark, d, name).createOrReplaceTempView(name)


@query(_SQL)
def q_sql_text(spark, d):
    """The same SQL text, run by Spark over registered views."""
    catalog(spark, d, ["documents"])
    return spark.sql(_SQL)


@query("SELECT coalesce(lang, '') AS lang, quantile_cont(n_chars, 0.5)::DOUBLE AS median, quantile_cont(n_chars, 0.9)::DOUBLE AS p90, true AS near FROM documents GROUP BY ALL")
def q_quantiles(spark, d):
    """Exact quantiles by language, and whether the approximate ones and distinct counts are near."""
    t = table(spark, d, "documents").groupBy(F.coalesce("lang", F.lit("")).alias("lang"))
    near = F.abs(F.approx_count_distinct("text", 0.02) - F.count_distinct("text")) <= 0.15 * F.count_distinct("text") + 1
    return t.agg(F.percentile("n_chars", F.lit(0.5)).alias("median"), F.percentile("n_chars", F.lit(0.9)).alias("p90"), near.alias("near"))


@query("SELECT o_orderkey, (o_orderdate + INTERVAL 1 MONTH)::TIMESTAMP AS next_month, date_diff('day', o_orderdate::DATE, (date_trunc('month', o_orderdate) + INTERVAL 1 MONTH)::DATE)::INT AS days_left, quarter(o_orderdate)::INT AS quarter, round(sqrt(abs(o_totalprice)), 6) AS root, (CAST(o_totalprice AS DECIMAL(15, 2)) % 7)::DOUBLE AS rest FROM orders")
def q_date_math(spark, d):
    at, price = F.col("o_orderdate"), F.col("o_totalprice")
    return table(spark, d, "orders").select(
        "o_orderkey", (at + F.expr("interval 1 month")).alias("next_month"), F.date_diff(F.add_months(F.trunc(at.cast("date"), "month"), 1), at.cast("date")).alias("days_left"), F.quarter(at).alias("quarter"),
        F.round(F.sqrt(F.abs(price)), 6).alias("root"), (price.cast("decimal(15,2)") % 7).cast("double").alias("rest"),
    )


@query("SELECT source_id, upper(type) AS type, 10 * n AS tens FROM (SELECT source_id, type, count(*) AS n FROM semantic_chunks WHERE type IS NOT NULL GROUP BY ALL) WHERE n >= 2")
def q_map_functions(spark, d):
    counts = table(spark, d, "semantic_chunks").where("type is not null").groupBy("source_id", "type").agg(F.count("*").alias("n"))
    maps = counts.groupBy("source_id").agg(F.map_from_entries(F.collect_list(F.struct("type", "n"))).alias("m"))
    changed = F.transform_values(F.transform_keys(F.map_filter("m", lambda k, v: v >= 2), lambda k, v: F.upper(k)), lambda k, v: v * 10)
    return maps.select("source_id", F.explode(changed).alias("type", "tens"))


@query("SELECT format, l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem, (SELECT unnest(['csv', 'orc', 'parquet', 'json']) AS format) GROUP BY ALL")
def q_formats(spark, d):
    """A table written in each format and read back."""
    t, out, found = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity"), _folder(spark), None
    for kind in ("csv", "orc", "parquet", "json"):
        t.write.format(kind).save(f"{out}/{kind}")
        back = spark.read.format(kind).schema(t.schema).load(f"{out}/{kind}").groupBy(F.lit(kind).alias("format"), "l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
        found = back if found is None else found.unionByName(back)
    return found
