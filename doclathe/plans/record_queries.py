"""Queries of chunks, JSON, HTML, matching, change detection, validation, stores and reports, with the SQL that checks them."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from doclathe.functions import text as T
from doclathe.operators import chunking as C
from doclathe.operators import crawl as CR
from doclathe.operators import enrich as E
from doclathe.operators import htmlops as H
from doclathe.operators import incremental as I
from doclathe.operators import jsonops as J
from doclathe.operators import matching as M
from doclathe.operators import records as R
from doclathe.operators import report as RP
from doclathe.operators import store as S
from doclathe.operators import validation as V
from doclathe.plans.text_queries import chunks_sql, has, lit, n_words, strip, sub, upper, words
from doclathe.runtime import shared_dir, table
from doclathe.streaming import ingest

QUERIES, ORACLES = {}, {}
WS = T.WS


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


# --- chunks, packs, sections -----------------------------------------------------------------------------------------------------------------


@query(f"WITH {chunks_sql('documents', 'doc_id')} SELECT key AS doc_id, chunk_no, id, section, length(text)::INT AS size, md5(text) AS md5 FROM chunk")
def q_semantic_chunks(spark, d):
    chunks = C.semantic_chunks(table(spark, d, "documents"), ["doc_id"])
    return chunks.select("doc_id", "chunk_no", "id", "section", F.length("text").alias("size"), F.md5("text").alias("md5"))


@query(f"""
    WITH RECURSIVE d AS (SELECT doc_id, text, list_filter(string_split(text, chr(10) || chr(10)), lambda p: {strip('p')} <> '') AS l FROM documents WHERE text IS NOT NULL),
    p AS (SELECT doc_id, unnest(range(1, 1 + len(l))) AS i, unnest(l) AS t FROM d WHERE length(text) > 600), e AS (SELECT * FROM p UNION ALL SELECT doc_id, max(i) + 1, NULL FROM p GROUP BY doc_id),
    r AS (SELECT DISTINCT doc_id, 0::BIGINT AS i, NULL::VARCHAR AS held, 0::BIGINT AS n, NULL::VARCHAR AS given FROM p
      UNION ALL SELECT r.doc_id, e.i, CASE WHEN e.t IS NULL THEN NULL WHEN held IS NOT NULL AND n + length(e.t) <= 600 THEN held || chr(10) || chr(10) || e.t ELSE e.t END, CASE WHEN held IS NOT NULL AND n + length(e.t) <= 600 THEN n + length(e.t) ELSE length(e.t) END,
        CASE WHEN e.t IS NULL OR n + length(e.t) > 600 THEN held END FROM r JOIN e ON e.doc_id = r.doc_id AND e.i = r.i + 1),
    o AS (SELECT doc_id, 0::BIGINT AS i, text AS t FROM d WHERE length(text) <= 600 UNION ALL SELECT doc_id, i, given FROM r WHERE given IS NOT NULL)
    SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS pack_no, length(t)::INT AS size, md5(t) AS md5 FROM o""")
def q_greedy_pack(spark, d):
    packs = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(C.pack_text(F.col("text"), 600)).alias("pack_no", "t"))
    return packs.select("doc_id", "pack_no", F.length("t").alias("size"), F.md5("t").alias("md5"))


@query("SELECT chunk_no, source_id, n - 1 AS pos, (n - 1) // 30 AS batch FROM (SELECT chunk_no, source_id, row_number() OVER (PARTITION BY source_id ORDER BY chunk_no) AS n FROM semantic_chunks)")
def q_fixed_batches(spark, d):
    return R.batches(table(spark, d, "semantic_chunks").select("chunk_no", "source_id"), ["source_id"], ["chunk_no"], 30)


@query(f"""
    WITH b AS (SELECT *, (row_number() OVER (PARTITION BY source_id ORDER BY chunk_no) - 1) // 30 AS batch FROM semantic_chunks),
    p AS (SELECT source_id, batch, chunk_no, {strip("coalesce(section, '') || chr(10) || text")} AS piece FROM b WHERE coalesce({strip('text')}, '') <> '')
    SELECT source_id, batch, count(*)::INT AS pieces, md5(string_agg(piece, chr(10) || chr(10) ORDER BY chunk_no)) AS md5 FROM p GROUP BY source_id, batch""")
def q_batch_assembly(spark, d):
    rows = R.batches(table(spark, d, "semantic_chunks").select("chunk_no", "source_id", "section", "text"), ["source_id"], ["chunk_no"], 30)
    return C.assemble(rows, ["source_id", "batch"], ["chunk_no"]).select("source_id", "batch", "pieces", F.md5("text").alias("md5"))


_title = r"^[^\p{L}]*(\p{Lu}[\p{Ll}\p{M}]*[^\p{L}]*)*\z"
_head = f"(s LIKE '%?' OR (length(s) < 80 AND {n_words('s')} > 0 AND {has('s', r'\p{L}')} AND len(list_filter({words('s')}, lambda w: NOT {has('w', _title)})) = 0) OR (length(s) < 60 AND {upper('s')}))"


@query(f"""
    WITH l AS (SELECT page_id, i, {strip('l[i]')} AS s FROM (SELECT page_id, l, unnest(range(1, 1 + len(l))) AS i FROM (SELECT page_id, string_split(text, chr(10)) AS l FROM raw_pages WHERE text IS NOT NULL))),
    h AS (SELECT *, {_head} AS head FROM l WHERE s <> ''), g AS (SELECT *, (sum(head::INT) OVER (PARTITION BY page_id ORDER BY i))::INT AS section_no FROM h)
    SELECT page_id, section_no, max(CASE WHEN head THEN s END) AS heading, md5(string_agg(CASE WHEN NOT head THEN s END, chr(10) ORDER BY i)) AS md5 FROM g WHERE section_no > 0 GROUP BY ALL HAVING count(*) > 1""")
def q_sections(spark, d):
    return C.sections(table(spark, d, "raw_pages").select("page_id", "text"), ["page_id"]).select("page_id", "section_no", "heading", F.md5("content").alias("md5"))


@query(f"""
    WITH l AS (SELECT page_id, (i - 1)::INT AS line_no, {strip('l[i]')} AS s FROM (SELECT page_id, l, unnest(range(1, 1 + len(l))) AS i FROM (SELECT page_id, string_split(text, chr(10)) AS l FROM page_texts WHERE text IS NOT NULL)))
    SELECT page_id, line_no, last_value(CASE WHEN {_head} THEN s END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY line_no) AS context FROM l WHERE s <> ''""")
def q_carry_heading(spark, d):
    rows = table(spark, d, "page_texts").select("page_id", F.posexplode(F.transform(F.split("text", "\n"), T.strip)).alias("line_no", "line")).where("line <> ''")
    return C.carry_forward(rows.withColumn("heading", F.when(C.is_section_head(F.col("line")), F.col("line"))), ["page_id"], "line_no").select("page_id", "line_no", "context")


_blocks = f"SELECT page_id, (i - 1)::INT AS pos, l[i] AS text FROM (SELECT page_id, l, unnest(range(1, 1 + len(l))) AS i FROM (SELECT page_id, string_split(text, chr(10)) AS l FROM raw_pages WHERE text IS NOT NULL))"


@query(f"SELECT page_id, min(pos) AS pos, md5(lower({strip(sub('text', WS + '+', ' '))})) AS md5 FROM ({_blocks}) GROUP BY page_id, md5(lower({strip(sub('text', WS + '+', ' '))}))")
def q_block_dedupe(spark, d):
    rows = table(spark, d, "raw_pages").select("page_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    return C.dedupe_blocks(rows, ["page_id"], "pos").select("page_id", "pos", F.md5(F.lower(T.collapse(F.col("text")))).alias("md5"))


@query("""
    WITH b AS (SELECT page_id, source_id, text, lag(source_id) OVER (PARTITION BY source ORDER BY page_id) AS before, source FROM page_texts WHERE text IS NOT NULL AND source IS NOT NULL)
    SELECT source, md5(string_agg(CASE WHEN source_id IS NOT NULL AND source_id IS DISTINCT FROM before THEN source_id || chr(10) || chr(10) || text ELSE text END, chr(10) || chr(10) ORDER BY page_id)) AS md5 FROM b GROUP BY source""")
def q_flatten_blocks(spark, d):
    rows = table(spark, d, "page_texts").where("text is not null and source is not null").select("page_id", "source", "source_id", "text")
    return C.flatten_blocks(rows, ["source"], "page_id", "source_id").select("source", F.md5("text").alias("md5"))


# --- deduplication ---------------------------------------------------------------------------------------------------------------------------


@query("SELECT min(chunk_no) AS chunk_no FROM semantic_chunks GROUP BY source_id, substr(text, 1, 200), section")
def q_chunk_dedupe(spark, d):
    return R.chunk_dedupe(table(spark, d, "semantic_chunks").select("chunk_no", "source_id", "section", "text"), ["chunk_no"]).select("chunk_no")


_key = f"lower({strip('s.type')})"


@query(f"""
    WITH x AS (SELECT entity_id, updated_at, i, services[i] AS s FROM (SELECT *, unnest(range(1, 1 + len(services))) AS i FROM clean_entities) WHERE services[i] IS NOT NULL)
    SELECT entity_id, {_key} AS type, min(updated_at) AS first_at FROM x GROUP BY ALL""")
def q_service_dedupe(spark, d):
    rows = table(spark, d, "clean_entities").select("entity_id", "updated_at", F.posexplode("services").alias("no", "s")).where("s is not null")
    key = F.lower(T.strip(F.col("s.type")))
    return R.keep_first(rows, ["entity_id", key], ["updated_at", "no"]).select("entity_id", key.alias("type"), F.col("updated_at").alias("first_at"))


@query(f"SELECT substr(sha256(t), 1, 32) AS id, min(chunk_no) AS chunk_no FROM (SELECT chunk_no, {strip(sub('text', WS + '+', ' '))} AS t FROM semantic_chunks) WHERE t <> '' GROUP BY t")
def q_post_dedupe(spark, d):
    rows = table(spark, d, "semantic_chunks").select("chunk_no", F.substring(F.sha2(T.collapse(F.col("text")), 256), 1, 32).alias("id"), T.collapse(F.col("text")).alias("t")).where("t <> ''").drop("t")
    return R.keep_first(rows, ["id"], ["chunk_no"])


@query("SELECT 'category' AS kind, category AS value FROM rule_snapshots GROUP BY ALL UNION ALL SELECT 'entity_type', entity_type FROM clean_entities GROUP BY ALL UNION ALL SELECT 'domain', split_part(source, '/', 3) FROM raw_pages WHERE contains(source, '://') GROUP BY ALL")
def q_distinct_values(spark, d):
    a = table(spark, d, "rule_snapshots").select(F.lit("category").alias("kind"), F.col("category").alias("value")).distinct()
    b = table(spark, d, "clean_entities").select(F.lit("entity_type").alias("kind"), F.col("entity_type").alias("value")).distinct()
    c = table(spark, d, "raw_pages").where(F.col("source").contains("://")).select(F.lit("domain").alias("kind"), T.domain(F.col("source")).alias("value")).distinct()
    return a.unionByName(b).unionByName(c)


# --- JSON ------------------------------------------------------------------------------------------------------------------------------------

_json = f"((starts_with({strip('text')}, '[') AND ends_with({strip('text')}, ']')) OR (starts_with({strip('text')}, '{{') AND ends_with({strip('text')}, '}}')))"


@query(f"""SELECT chunk_no, md5(CASE WHEN text IS NULL THEN NULL WHEN {_json} AND json_valid(text) THEN array_to_string(list_transform(json_extract_string(text, '$[*].title'), lambda t: '## ' || t), chr(10) || chr(10)) ELSE text END) AS md5 FROM semantic_chunks""")
def q_json_unwrap(spark, d):
    return table(spark, d, "semantic_chunks").select("chunk_no", F.md5(J.unwrap(F.col("text"))).alias("md5"))


@query("""
    WITH j AS (SELECT chunk_no, text::JSON AS j FROM semantic_chunks WHERE regexp_matches(text, '^\\s*\\[\\s*\\{"url"')), p AS (SELECT chunk_no, i - 1 AS page_no, j[(i - 1)::INT] AS p FROM (SELECT *, unnest(range(1, 1 + json_array_length(j)::INT)) AS i FROM j))
    SELECT chunk_no, page_no::INT AS page_no, p->>'title' AS title, (k - 1)::INT AS section_no, p->'sections'->((k - 1)::INT)->>'heading' AS heading, md5(p->'sections'->((k - 1)::INT)->>'body') AS md5
    FROM (SELECT *, unnest(range(1, 1 + json_array_length(p->'sections')::INT)) AS k FROM p)""")
def q_page_sections(spark, d):
    return J.page_sections(table(spark, d, "semantic_chunks"), "chunk_no").select("chunk_no", "page_no", "title", "section_no", "heading", F.md5("body").alias("md5"))


def _replies(spark, d):
    """A reply of each form for every chunk: plain, fenced, amid talk with entries that are no objects, broken."""
    t = table(spark, d, "semantic_chunks")
    item = F.to_json(F.struct("section", "text", F.col("id").alias("parent_id")))
    forms = F.array(F.concat(F.lit("["), item, F.lit("]")), F.concat(F.lit("```json\n["), item, F.lit("]\n```")), F.concat(F.lit("Sure: [1, "), item, F.lit(', "x"] Done')), F.concat(F.lit("["), item))
    return t.select("chunk_no", F.posexplode(forms).alias("form", "raw"))


_t, _sec = strip("text"), strip("section")


@query(f"SELECT chunk_no, f::INT AS form, md5({_t}) AS id, id AS parent_id FROM semantic_chunks, (SELECT unnest([0, 1, 2]) AS f) WHERE length({_t}) > 30 AND {_sec} <> ''")
def q_reply_chunks(spark, d):
    rows = _replies(spark, d).select("chunk_no", "form", F.explode(J.valid_chunks(J.salvage(F.col("raw")))).alias("c"))
    return rows.select("chunk_no", "form", "c.id", "c.parent_id")


_en, _ro, _ty = strip("s.description.en"), strip("s.description.ro"), f"replace(lower({strip('s.type')}), ' ', '_')"


@query(f"""
    SELECT entity_id, updated_at, {_ty} AS type, {_en} AS en, coalesce(nullif({_ro}, ''), {_en}) AS ro FROM (SELECT entity_id, updated_at, unnest(services) AS s FROM store_entities)
    WHERE length({_en}) >= 20 AND {_ty} <> ''""")
def q_reply_services(spark, d):
    rows = table(spark, d, "store_entities").select("entity_id", "updated_at", F.concat(F.lit("Reply: "), F.to_json("services")).alias("raw"))
    each = rows.select("entity_id", "updated_at", F.explode(J.valid_services(J.salvage(F.col("raw")))).alias("s"))
    return each.select("entity_id", "updated_at", "s.type", "s.description.en", "s.description.ro")


@query(f"SELECT doc_id::VARCHAR AS post_id, md5({strip(sub('text', WS + '+', ' '))}) AS md5 FROM documents WHERE {strip(sub('text', WS + '+', ' '))} <> ''")
def q_post_flatten(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("post"), "text")
    tweet = F.struct(F.lit("Tweet").alias("__typename"), F.col("post").alias("rest_id"), F.struct(F.col("text").alias("full_text")).alias("legacy"))
    wrapped = F.struct(F.lit("TweetWithVisibilityResults").alias("__typename"), F.struct(F.struct(F.col("post").alias("id_str"), F.col("text")).alias("legacy")).alias("tweet"))
    entry = lambda r: F.to_json(F.struct(F.concat(F.lit("tweet-"), "post").alias("entryId"), F.struct(F.struct(F.struct(r.alias("result")).alias("tweet_results")).alias("itemContent")).alias("content")))
    one = F.when(F.col("doc_id") % 2 == 0, entry(tweet)).otherwise(entry(wrapped))
    raw = F.concat(F.lit('{"data":{"search_by_raw_query":{"search_timeline":{"timeline":{"instructions":[{"entries":['), one, F.lit(',{"entryId":"cursor-top","content":{}}]},{"other":1}]}}}}}'))
    return J.posts(t.select(raw.alias("raw"))).select("post_id", F.md5("text").alias("md5"))


# --- HTML and links --------------------------------------------------------------------------------------------------------------------------


_links = "SELECT scrape_id, url, (i - 1)::INT AS pos, l[i] AS h FROM (SELECT *, unnest(range(1, 1 + len(l))) AS i FROM (SELECT scrape_id, url, regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1) AS l FROM scrape_results))"


@query(f"SELECT scrape_id, pos, regexp_extract(url, '^[a-z]+://[^/]*') || h AS link FROM ({_links})")
def q_links(spark, d):
    return H.page_links(table(spark, d, "scrape_results"), "scrape_id")


@query(f"""
    SELECT scrape_id, pos, {' AND '.join(f"NOT contains(link, {lit(s)})" for s in CR.SKIP)} AS follow, len(allowed_domains) = 0 OR len(list_filter(allowed_domains, lambda x: contains(split_part(link, '/', 3), x))) > 0 AS allowed
    FROM (SELECT l.scrape_id, pos, regexp_extract(l.url, '^[a-z]+://[^/]*') || h AS link, coalesce(s.allowed_domains, []) AS allowed_domains FROM ({_links}) l JOIN scrape_results r USING (scrape_id) LEFT JOIN (SELECT id, any_value(allowed_domains) AS allowed_domains FROM sources GROUP BY id) s ON s.id = r.source_id)""")
def q_link_filter(spark, d):
    t = table(spark, d, "scrape_results")
    sources = table(spark, d, "sources").groupBy("id").agg(F.first("allowed_domains").alias("allowed_domains"))
    rows = H.page_links(t, "scrape_id").join(t.select("scrape_id", "source_id"), "scrape_id").join(sources, F.col("source_id") == F.col("id"), "left")
    return rows.select("scrape_id", "pos", CR.followable(F.col("link")).alias("follow"), M.allowed(T.domain(F.col("link")), F.col("allowed_domains")).alias("allowed"))


_REGISTRY = (("help.", "help centre"), ("info.", "guide"), ("www.", "site"))


@query("SELECT page_id, " + "CASE " + " ".join(f"WHEN contains(split_part(source, '/', 3), '{p}') THEN '{e}'" for p, e in _REGISTRY) + " END AS scraper FROM raw_pages")
def q_registry(spark, d):
    t = table(spark, d, "raw_pages")
    return t.select("page_id", M.registry_match(t, _REGISTRY, F.split_part("source", F.lit("/"), F.lit(3))).alias("scraper"))


_graph = "SELECT doc_id::VARCHAR AS from_url, unnest([(2 * doc_id + 1)::VARCHAR, (2 * doc_id)::VARCHAR, (doc_id // 3)::VARCHAR]) AS to_url, unnest([0, 1, 2]) AS pos FROM documents"


def _crawled(spark, d):
    docs = table(spark, d, "documents")
    links = docs.select(F.col("doc_id").cast("string").alias("from_url"), F.posexplode(F.array(*(x.cast("string") for x in (2 * F.col("doc_id") + 1, 2 * F.col("doc_id"), F.floor(F.col("doc_id") / 3))))).alias("pos", "to_url"))
    pages = docs.select(F.col("doc_id").cast("string").alias("url"), (F.length(F.coalesce("text", F.lit(""))) >= 150).alias("accepted"))
    starts = table(spark, d, "sources").select(F.col("id").alias("start"), F.length("id").cast("string").alias("url"))
    return CR.crawl(starts, links, pages)


_bfs = f"""
    WITH RECURSIVE e AS ({_graph}), ok AS (SELECT doc_id::VARCHAR AS url FROM documents WHERE length(coalesce(text, '')) >= 150),
    r AS (SELECT id AS start, [length(id)::VARCHAR] AS urls, [length(id)::VARCHAR] AS seen, [[]::INT[]] AS places, 0 AS depth FROM sources WHERE length(id)::VARCHAR IN (SELECT url FROM ok)
          UNION ALL SELECT r.start, n.urls, list_concat(r.seen, n.urls), n.places, r.depth + 1 FROM r, LATERAL (
            SELECT list(to_url ORDER BY place) AS urls, list(place ORDER BY place) AS places FROM (
              SELECT e.to_url, min(list_concat(f.place, [e.pos])) AS place FROM (SELECT unnest(r.urls) AS url, unnest(r.places) AS place) f JOIN e ON e.from_url = f.url
              WHERE e.to_url IN (SELECT url FROM ok) AND NOT list_contains(r.seen, e.to_url) GROUP BY e.to_url)) n WHERE len(n.urls) > 0),
    m AS (SELECT start, unnest(urls) AS url, unnest(places) AS place, depth FROM r)"""


@query(_bfs + " SELECT start, url, depth FROM m")
def q_bfs(spark, d):
    return _crawled(spark, d).select("start", "url", "depth")


@query(_bfs + """, k AS (SELECT m.*, row_number() OVER (PARTITION BY start ORDER BY depth, place) AS rank, coalesce(max_pages, 5) AS most FROM m JOIN sources ON id = start)
    SELECT start, url, depth, rank FROM k WHERE rank <= most""")
def q_crawl_limits(spark, d):
    """The feature is the limit: the first max_pages pages of each start, in order of discovery."""
    return CR.first_pages(_crawled(spark, d), table(spark, d, "sources").select(F.col("id").alias("start"), "max_pages"))


# --- matching --------------------------------------------------------------------------------------------------------------------------------


def _index(spark, d):
    airports = table(spark, d, "airports").select(F.col("airport_id").alias("doc_id"), "name", "full_name", F.col("airport_id").alias("doc_no"))
    airlines = table(spark, d, "airlines").select(F.col("airline_id").alias("doc_id"), "name", F.lit(None).cast("string").alias("full_name"), F.col("airline_id").alias("doc_no"))
    return M.name_index(airports, [F.col("name"), F.col("full_name")]).withColumn("kind", F.lit("airport")).unionByName(M.name_index(airlines, [F.col("name")]).withColumn("kind", F.lit("airline")))


_nk = lambda c: f"lower({strip(c)})"
_index_sql = f"""SELECT {_nk('n')} AS key, max(doc) AS doc, kind FROM (SELECT airport_id AS doc, unnest([name, full_name]) AS n, 'airport' AS kind FROM airports UNION ALL SELECT airline_id, name, 'airline' FROM airlines) WHERE {_nk('n')} <> '' GROUP BY ALL"""
_names = "(SELECT entity_name AS name FROM clean_entities UNION ALL SELECT city FROM clean_entities UNION ALL SELECT name || ' of the south' FROM airports UNION ALL SELECT full_name FROM airports)"


def _all_names(spark, d):
    e, a = table(spark, d, "clean_entities"), table(spark, d, "airports")
    return e.select(F.col("entity_name").alias("name")).union(e.select("city")).union(a.select(F.concat("name", F.lit(" of the south")))).union(a.select("full_name"))


@query(f"""
    WITH i AS (SELECT key, max(doc) AS doc FROM ({_index_sql} UNION ALL SELECT {_nk('city')}, max(airport_id), 'city' FROM airports WHERE {_nk('city')} <> '' GROUP BY ALL) GROUP BY key), n AS (SELECT DISTINCT name FROM {_names} WHERE name IS NOT NULL),
    t AS (SELECT name, 0 AS pos, {_nk('name')} AS key FROM n UNION ALL SELECT name, k, w[k] FROM (SELECT name, w, unnest(range(1, 1 + len(w))) AS k FROM (SELECT name, {words(_nk('name'))} AS w FROM n))),
    h AS (SELECT name, arg_min(doc, pos) AS doc FROM t JOIN i USING (key) GROUP BY name)
    SELECT a.name, h.doc, count(*) AS n FROM {_names} a LEFT JOIN h USING (name) GROUP BY ALL""")
def q_token_match(spark, d):
    city = M.name_index(table(spark, d, "airports").select(F.col("airport_id").alias("doc_id"), "city", F.col("airport_id").alias("doc_no")), [F.col("city")])
    index = _index(spark, d).select("key", "doc").unionByName(city).groupBy("key").agg(F.max("doc").alias("doc"))
    return M.token_match(_all_names(spark, d), index).groupBy("name", "doc").agg(F.count("*").alias("n"))


_shared = f"""
    w AS (SELECT w, arg_min(name, airport_id) AS name, min(airport_id) AS no FROM (SELECT airport_id, name, unnest({words(_nk('name'))}) AS w FROM airports) GROUP BY w),
    n AS (SELECT DISTINCT entity_name AS name FROM clean_entities WHERE entity_name IS NOT NULL), t AS (SELECT name, unnest({words(_nk('name'))}) AS w FROM n),
    h AS (SELECT t.name, arg_min(w.name, w.no) AS match FROM t JOIN w USING (w) GROUP BY t.name)"""


@query(f"WITH {_shared} SELECT a.entity_name AS name, h.match, count(*) AS n FROM clean_entities a LEFT JOIN h ON h.name = a.entity_name GROUP BY ALL")
def q_shared_token_match(spark, d):
    others = table(spark, d, "airports").select(F.col("name").alias("other"), F.col("airport_id").alias("no"))
    return M.shared_token_match(table(spark, d, "clean_entities").select(F.col("entity_name").alias("name")), others).groupBy("name", "match").agg(F.count("*").alias("n"))


@query(f"""
    WITH {_shared}, l AS (SELECT entity_name AS name FROM clean_entities WHERE coalesce(entity_name, '') <> ''), m AS (SELECT l.name, h.match FROM l LEFT JOIN h ON h.name = l.name)
    SELECT name, state, count(*) AS n FROM (SELECT name, CASE WHEN match IS NULL THEN 'not_pushed' ELSE 'in_sync' END AS state FROM m
      UNION ALL SELECT name, 'only_in_db' FROM airports WHERE coalesce(name, '') <> '' AND {_nk('name')} NOT IN (SELECT {_nk('match')} FROM m WHERE match IS NOT NULL)) GROUP BY ALL""")
def q_tri_partition(spark, d):
    local = table(spark, d, "clean_entities").select(F.col("entity_name").alias("name"))
    return M.tri_partition(local, table(spark, d, "airports").select("name", F.col("airport_id").alias("no"))).groupBy("name", "state").agg(F.count("*").alias("n"))


@query("SELECT c.source_id, count(*) AS n, count(p.id) AS resolved, count(*) FILTER (WHERE c.parent IS NULL) AS without FROM (SELECT source_id, CASE WHEN text <> '' THEN md5(text) END AS parent FROM semantic_chunks) c LEFT JOIN (SELECT DISTINCT id FROM semantic_chunks) p ON p.id = c.parent GROUP BY c.source_id")
def q_parent_child(spark, d):
    t = table(spark, d, "semantic_chunks")
    child = t.select("source_id", F.when(F.col("text") != "", F.md5("text")).alias("parent"))
    joined = child.join(t.select("id").distinct(), F.col("parent") == F.col("id"), "left")
    return joined.groupBy("source_id").agg(F.count("*").alias("n"), F.count("id").alias("resolved"), F.count_if(F.col("parent").isNull()).alias("without"))


# --- change detection ------------------------------------------------------------------------------------------------------------------------


def _sources(spark, d, before: str | None = None):
    t = table(spark, d, "semantic_chunks")
    return t if before is None else t.where(F.col("loaded_at") < F.lit(before).cast("timestamp"))


_CUT = "2026-01-01 00:00:00"
_sh = "SELECT source_id AS source, sha256(string_agg(md5(coalesce(text, chr(0))), '' ORDER BY chunk_no, md5(coalesce(text, chr(0))))) AS content_hash, count(*) AS n_rows FROM semantic_chunks {} GROUP BY source_id"


@query(f"""
    WITH c AS ({_sh.format('')}), m AS ({_sh.format(f"WHERE loaded_at < '{_CUT}'")}), k AS (SELECT DISTINCT id AS source FROM sources WHERE dedup)
    SELECT c.source, c.content_hash, CASE WHEN m.content_hash = c.content_hash AND k.source IS NOT NULL THEN 'reuse' WHEN n_rows = 0 THEN 'skip' WHEN m.content_hash IS NULL THEN 'new' ELSE 'extract' END AS action FROM (SELECT * FROM c) c LEFT JOIN (SELECT source, content_hash FROM m) m USING (source) LEFT JOIN k ON k.source = c.source""".replace(chr(0), ""))
def q_manifest_plan(spark, d):
    current = _sources(spark, d)
    now = I.source_hashes(current, "source_id", ["chunk_no"], "text").join(current.groupBy(F.col("source_id").alias("source")).agg(F.count("*").alias("n_rows")), "source")
    before = I.source_hashes(_sources(spark, d, _CUT), "source_id", ["chunk_no"], "text")
    return I.plan_reuse(now, before, table(spark, d, "sources").where("dedup").select(F.col("id").alias("source")))


@query("SELECT id FROM sources WHERE id NOT IN (SELECT source_id FROM page_texts WHERE source_id IS NOT NULL) OR id IS NULL")
def q_pending_sources(spark, d):
    return I.pending(table(spark, d, "sources").select("id"), table(spark, d, "page_texts").select(F.col("source_id").alias("id")), ["id"])


def _snaps(spark, d):
    """Each snapshot's rules and, as previous, those of the snapshot numbered one less."""
    t = table(spark, d, "rule_snapshots").withColumn("rule_id", F.upper(T.strip(F.col("rule_id"))))
    rules = I.snapshot(t, ["loaded_at", "title", "description", "version", "category", "source"], ["snapshot_no"])
    numbers = rules.select("snapshot_no").distinct()
    before = rules.withColumn("snapshot_no", F.col("snapshot_no") + 1).join(numbers, "snapshot_no", "left_semi")
    return rules.join(before.select("snapshot_no").distinct(), "snapshot_no", "left_semi"), before


_own = f"sha256(lower({strip("coalesce(title, '')")}) || '||' || lower({strip("coalesce(description, '')")}))"
_both = f"""
    WITH s AS (SELECT snapshot_no, rule_id, {_own} AS content_hash, title, category, source, coalesce(version, 1) AS version FROM (SELECT * REPLACE (upper({strip('rule_id')}) AS rule_id) FROM rule_snapshots WHERE rule_id IS NOT NULL)
      QUALIFY row_number() OVER (PARTITION BY snapshot_no, rule_id ORDER BY loaded_at DESC NULLS LAST, title DESC NULLS LAST, description DESC NULLS LAST, version DESC NULLS LAST, category DESC NULLS LAST, source DESC NULLS LAST) = 1),
    a AS (SELECT * FROM s WHERE snapshot_no - 1 IN (SELECT snapshot_no FROM s)), b AS (SELECT * REPLACE (snapshot_no + 1 AS snapshot_no) FROM s WHERE snapshot_no + 1 IN (SELECT snapshot_no FROM s))"""
_change = "CASE WHEN b.content_hash IS NULL THEN 'added' WHEN a.content_hash IS NULL THEN 'removed' WHEN a.content_hash <> b.content_hash THEN 'modified' ELSE 'unchanged' END"


@query(f"{_both} SELECT snapshot_no, rule_id, {_change} AS change FROM a FULL JOIN b USING (snapshot_no, rule_id)")
def q_detect_changes(spark, d):
    return I.detect_changes(*_snaps(spark, d), per=["snapshot_no"])


@query(f"{_both}, c AS (SELECT snapshot_no, {_change} AS change FROM a FULL JOIN b USING (snapshot_no, rule_id)), n AS (SELECT DISTINCT snapshot_no FROM c) SELECT n.snapshot_no, k AS change, count(c.change) AS n FROM n CROSS JOIN (SELECT unnest(['added', 'removed', 'modified', 'unchanged']) AS k) LEFT JOIN c ON c.change = k AND c.snapshot_no = n.snapshot_no GROUP BY ALL")
def q_change_counts(spark, d):
    return I.change_report(I.detect_changes(*_snaps(spark, d), per=["snapshot_no"]), per=["snapshot_no"])


@query(f"{_both} SELECT snapshot_no, a.rule_id, a.content_hash, CASE WHEN b.content_hash IS NULL THEN 1 WHEN b.content_hash <> a.content_hash THEN a.version + 1 ELSE a.version END AS version FROM a LEFT JOIN b USING (snapshot_no, rule_id)")
def q_apply_versions(spark, d):
    return I.apply_versions(*_snaps(spark, d), per=["snapshot_no"]).select("snapshot_no", "rule_id", "content_hash", "version")


@query(f"{_both} SELECT snapshot_no, a.rule_id, CASE WHEN a.version > 1 THEN 'updated' WHEN (snapshot_no, a.content_hash) NOT IN (SELECT (snapshot_no, content_hash) FROM b) THEN 'new' ELSE 'unchanged' END AS state FROM a")
def q_version_states(spark, d):
    return I.version_states(*_snaps(spark, d), per=["snapshot_no"]).select("snapshot_no", "rule_id", "state")


# --- validation ------------------------------------------------------------------------------------------------------------------------------


def _issues(spark, d):
    return V.entity_issues(table(spark, d, "clean_entities").withColumn("entity_no", F.col("entity_id")))


_bl = lambda c: f"coalesce({strip(c)}, '') = ''"
_eid = "coalesce(nullif(entity_name, ''), nullif(source_id, ''), 'UNKNOWN')"
_issue_sql = f"""
    e AS (SELECT *, {_eid} AS eid FROM clean_entities), s AS (SELECT eid, entity_id AS no, i - 1 AS k, services[i] AS s FROM (SELECT *, unnest(range(1, 1 + len(services))) AS i FROM e)),
    i AS (SELECT eid AS entity_id, entity_id AS no, 'entity_structure' AS "check", 'error' AS severity, 'Missing or empty required field: ''' || f || '''' AS message FROM e, (SELECT unnest(['entity_name', 'entity_type', 'source_id']) AS f) WHERE CASE f WHEN 'entity_name' THEN {_bl('entity_name')} WHEN 'entity_type' THEN {_bl('entity_type')} ELSE {_bl('source_id')} END
      UNION ALL SELECT eid, entity_id, 'entity_type', 'error', 'entity_type must be ''airline'' or ''airport'', got ' || coalesce('''' || entity_type || '''', 'None') FROM e WHERE coalesce(entity_type, '') NOT IN ('airline', 'airport')
      UNION ALL SELECT eid, entity_id, 'services_present', 'error', 'Field ''services'' is missing or not a list' FROM e WHERE services IS NULL
      UNION ALL SELECT eid, entity_id, 'services_present', 'error', 'Entity has an empty services array' FROM e WHERE len(services) = 0
      UNION ALL SELECT eid, no, 'service_structure', 'error', 'services[' || k || ']: is not an object' FROM s WHERE s IS NULL
      UNION ALL SELECT eid, no, 'service_structure', 'error', 'services[' || k || ']: ''type'' is missing or empty' FROM s WHERE s IS NOT NULL AND {_bl('s.type')}
      UNION ALL SELECT eid, no, 'service_structure', 'error', 'services[' || k || ']: description.en is missing or too short' FROM s WHERE s IS NOT NULL AND length(coalesce({_en}, '')) < 20
      UNION ALL SELECT eid, no, 'service_structure', 'warning', 'services[' || k || ']: description.ro is empty' FROM s WHERE s IS NOT NULL AND {_bl('s.description.ro')}
      UNION ALL SELECT eid, no, 'duplicate_types', 'warning', 'Service type ''' || t || ''' appears ' || n || ' times' FROM (SELECT eid, no, r, t, count(*) AS n FROM (SELECT eid, entity_id AS no, r, unnest(list_transform(services, lambda x: lower({strip('x.type')}))) AS t FROM (SELECT *, row_number() OVER () AS r FROM e)) WHERE t <> '' GROUP BY ALL) WHERE n > 1)"""


@query(f'WITH {_issue_sql} SELECT entity_id, no AS entity_no, "check", severity, message, count(*) AS n FROM i GROUP BY ALL')
def q_validate_issues(spark, d):
    return _issues(spark, d).groupBy("entity_id", "entity_no", "check", "severity", "message").agg(F.count("*").alias("n"))


@query(f'WITH {_issue_sql} SELECT "check", count(*) FILTER (WHERE severity = \'error\') AS error, count(*) FILTER (WHERE severity = \'warning\') AS warning FROM i GROUP BY "check"')
def q_validate_summary(spark, d):
    return V.summary(_issues(spark, d))


_ok = f"SELECT * FROM e WHERE eid NOT IN (SELECT entity_id FROM i WHERE severity = 'error')"


@query(f"WITH {_issue_sql} SELECT entity_id, updated_at, count(*) AS n FROM ({_ok}) GROUP BY ALL")
def q_clean_entities(spark, d):
    e = table(spark, d, "clean_entities")
    issues = _issues(spark, d).withColumnRenamed("entity_id", "display")
    good = V.clean_entities(e.withColumnRenamed("entity_id", "eid"), issues.withColumnRenamed("display", "entity_id"))
    return good.groupBy(F.col("eid").alias("entity_id"), "updated_at").agg(F.count("*").alias("n"))


@query(f"WITH {_issue_sql}, t AS (SELECT (SELECT count(*) FROM e) AS total, (SELECT count(*) FROM ({_ok})) AS passed) SELECT total, passed, total - passed AS excluded, round_even(100.0 * passed / total, 0)::INT AS pass_rate FROM t")
def q_pass_rate(spark, d):
    e = table(spark, d, "clean_entities").withColumnRenamed("entity_id", "eid")
    return V.totals(e, _issues(spark, d))


@query("SELECT entity_id, updated_at, CASE entity_type WHEN 'airport' THEN 'services is not a list' WHEN 'regulator' THEN p END AS problem, count(*) AS n FROM clean_entities, (SELECT unnest(['service is not an object', 'description is not an object', 'is_presented is not a boolean']) AS p) WHERE entity_type = 'regulator' OR (entity_type = 'airport' AND p = 'service is not an object') GROUP BY ALL")
def q_shape_issues(spark, d):
    """Services as JSON: lists of airlines as they are, an object for airports, a list of ill-formed entries for regulators."""
    raw = F.when(F.col("entity_type") == "airline", F.to_json(F.coalesce("services", F.expr("array()").cast("array<struct<type:string,description:struct<en:string,ro:string>,is_presented:boolean>>"))))
    raw = raw.when(F.col("entity_type") == "airport", F.lit('{"services": 1}')).when(F.col("entity_type") == "regulator", F.lit('["x", {"type": "a", "description": "text"}, {"type": "b", "description": {"en": "x"}, "is_presented": "yes"}]')).otherwise(F.lit("[]"))
    e = table(spark, d, "clean_entities").select("entity_id", "updated_at", raw.alias("services_json")).withColumn("entity_no", F.struct("entity_id", "updated_at"))
    return V.shape_issues(e).select("entity_no.entity_id", "entity_no.updated_at", "problem").groupBy("entity_id", "updated_at", "problem").agg(F.count("*").alias("n"))


@query(f"""SELECT entity_id, updated_at, array_to_string(list_filter([CASE WHEN {_bl('entity_id')} THEN 'id' END, CASE WHEN {_bl('entity_name')} THEN 'name' END, CASE WHEN {_bl('source_id')} THEN 'source' END,
    CASE WHEN len(list_filter(coalesce(services, []), lambda s: coalesce({_bl('s.type')} OR length(coalesce({_en}, '')) < 20, true))) > 0 THEN 'services' END], lambda x: x IS NOT NULL), ',') AS rejects, count(*) AS n FROM clean_entities GROUP BY ALL""")
def q_model_rejects(spark, d):
    rows = V.reject(table(spark, d, "clean_entities"), V.model_conditions())
    return rows.groupBy("entity_id", "updated_at", F.array_join("rejects", ",").alias("rejects")).agg(F.count("*").alias("n"))


_d, _ti = strip("coalesce(description, '')"), strip("coalesce(title, '')")


@query(f"""
    WITH i AS (SELECT rule_id, 'structure' AS "check", f || ' is missing' AS problem FROM rule_snapshots, (SELECT unnest(['rule_id', 'category', 'title', 'description', 'source']) AS f) WHERE CASE f WHEN 'rule_id' THEN {_bl('rule_id')} WHEN 'category' THEN {_bl('category')} WHEN 'title' THEN {_bl('title')} WHEN 'description' THEN {_bl('description')} ELSE {_bl('source')} END
      UNION ALL SELECT rule_id, 'structure', 'rule_id has another form' FROM rule_snapshots WHERE NOT {has('rule_id', '^R[0-9]+' + chr(92) + 'z')}
      UNION ALL SELECT rule_id, 'quality', p FROM (SELECT *, {_d} AS d, {_ti} AS t FROM rule_snapshots), (SELECT unnest(['description is short', 'description is in capitals', 'description is vague', 'description repeats the title']) AS p)
        WHERE d <> '' AND CASE p WHEN 'description is short' THEN length(d) < 30 WHEN 'description is in capitals' THEN {upper('d')} WHEN 'description is vague' THEN {has('lower(d)', T.any_phrase(V.VAGUE))} ELSE lower(d) = lower(t) END)
    SELECT rule_id, "check", problem, count(*) AS n FROM i GROUP BY ALL""")
def q_rule_issues(spark, d):
    return V.rule_issues(table(spark, d, "rule_snapshots")).groupBy("rule_id", "check", "problem").agg(F.count("*").alias("n"))


@query(f"WITH n AS (SELECT DISTINCT try_cast(substr(upper({strip('rule_id')}), 2) AS BIGINT) AS n FROM rule_snapshots), w AS (SELECT n, lag(n) OVER (ORDER BY n) AS p FROM n WHERE n IS NOT NULL) SELECT p AS after, n AS before FROM w WHERE n - p > 1")
def q_id_gaps(spark, d):
    return V.id_gaps(table(spark, d, "rule_snapshots"), F.substring(F.upper(T.strip(F.col("rule_id"))), 2, 20).try_cast("long"))


_CATEGORIES = ["parking", "booking", "dog"]


@query("SELECT category, count(*) AS n FROM rule_snapshots WHERE category IS NULL OR category NOT IN ('parking', 'booking', 'dog') GROUP BY category")
def q_unknown_categories(spark, d):
    return V.unknown_categories(table(spark, d, "rule_snapshots"), _CATEGORIES)


@query(f"SELECT min(rule_id) AS rule_id, count(DISTINCT rule_id) AS n FROM (SELECT rule_id, lower({strip(sub('description', WS + '+', ' '))}) AS k FROM rule_snapshots) WHERE k <> '' GROUP BY k HAVING count(DISTINCT rule_id) > 1")
def q_rule_duplicates(spark, d):
    return V.normalised_duplicates(table(spark, d, "rule_snapshots"))


@query("SELECT page_id, 'R' || CASE WHEN n < 1000 THEN lpad(n::VARCHAR, 3, '0') ELSE n::VARCHAR END AS rule_id FROM (SELECT page_id, row_number() OVER (ORDER BY page_id) AS n FROM raw_pages)")
def q_resequence(spark, d):
    return R.resequence(table(spark, d, "raw_pages").select("page_id"), ["page_id"])


# --- filters and reports ---------------------------------------------------------------------------------------------------------------------


@query("SELECT snapshot_no, rule_id, title, count(*) AS n FROM rule_snapshots WHERE category IN ('parking', 'booking', 'dog') AND (contains(lower(title), 'battery') OR contains(lower(description), 'battery')) GROUP BY ALL")
def q_rule_browse(spark, d):
    found = RP.browse(table(spark, d, "rule_snapshots"), {"category": _CATEGORIES}, "Battery", ["title", "description"])
    return found.groupBy("snapshot_no", "rule_id", "title").agg(F.count("*").alias("n"))


@query(f'WITH {_issue_sql} SELECT entity_id, "check", message, count(*) AS n FROM i WHERE severity = \'warning\' AND "check" IN (\'service_structure\', \'duplicate_types\') GROUP BY ALL')
def q_issue_browse(spark, d):
    found = RP.browse(_issues(spark, d), {"severity": ["warning"], "check": ["service_structure", "duplicate_types"]})
    return found.groupBy("entity_id", "check", "message").agg(F.count("*").alias("n"))


@query("SELECT entity_id, updated_at, count(*) AS n FROM clean_entities WHERE entity_type IN ('airport') AND contains(lower(entity_name), 'south') GROUP BY ALL")
def q_store_browse(spark, d):
    found = RP.browse(table(spark, d, "clean_entities"), {"entity_type": ["airport"]}, "south", ["entity_name"])
    return found.groupBy("entity_id", "updated_at").agg(F.count("*").alias("n"))


@query(f'WITH {_issue_sql}, k AS (SELECT eid, max(updated_at) AS updated_at FROM e GROUP BY eid) SELECT i.entity_id, k.updated_at, count(*) AS n FROM i LEFT JOIN k ON k.eid = i.entity_id GROUP BY ALL')
def q_issue_join(spark, d):
    e = table(spark, d, "clean_entities")
    last = e.groupBy(V.display_id(F.col("entity_name"), F.col("source_id")).alias("entity_id")).agg(F.max("updated_at").alias("updated_at"))
    return _issues(spark, d).join(last, "entity_id", "left").groupBy("entity_id", "updated_at").agg(F.count("*").alias("n"))


@query("SELECT chunk_no FROM semantic_chunks WHERE NOT coalesce(sent, false)")
def q_unsent(spark, d):
    return table(spark, d, "semantic_chunks").where(~F.coalesce("sent", F.lit(False))).select("chunk_no")


@query("SELECT source_id, arg_min(coalesce(entity_type, ''), chunk_no) AS entity_type FROM semantic_chunks GROUP BY source_id HAVING arg_min(coalesce(entity_type, ''), chunk_no) NOT IN ('airline', 'airport')")
def q_regulation_sources(spark, d):
    first = table(spark, d, "semantic_chunks").groupBy("source_id").agg(F.min_by(F.coalesce("entity_type", F.lit("")), "chunk_no").alias("entity_type"))
    return first.where(~F.col("entity_type").isin("airline", "airport"))


@query("SELECT s.id, CASE WHEN c.n > 0 THEN 'Processed' WHEN p.n > 0 THEN 'Partial' ELSE 'Pending' END AS status, coalesce(c.n, 0) AS segments, split_part(s.url, '/', 3) AS website FROM sources s LEFT JOIN (SELECT source_id, count(*) AS n FROM semantic_chunks GROUP BY 1) c ON c.source_id = s.id LEFT JOIN (SELECT source_id, count(*) AS n FROM page_texts GROUP BY 1) p ON p.source_id = s.id")
def q_source_status(spark, d):
    return RP.source_status(table(spark, d, "sources"), table(spark, d, "semantic_chunks"), table(spark, d, "page_texts")).select("id", "status", "segments", "website")


@query("SELECT count(*) FILTER (WHERE c.n > 0) AS processed, count(*) FILTER (WHERE c.n IS NULL AND p.n IS NULL) AS pending, coalesce(sum(c.n), 0)::BIGINT AS segments FROM sources s LEFT JOIN (SELECT source_id, count(*) AS n FROM semantic_chunks GROUP BY 1) c ON c.source_id = s.id LEFT JOIN (SELECT source_id, count(*) AS n FROM page_texts GROUP BY 1) p ON p.source_id = s.id")
def q_status_totals(spark, d):
    return RP.status_totals(RP.source_status(table(spark, d, "sources"), table(spark, d, "semantic_chunks"), table(spark, d, "page_texts")))


@query("SELECT category, count(*) AS n FROM rule_snapshots GROUP BY category ORDER BY n DESC, min(rule_id) LIMIT 8")
def q_top_categories(spark, d):
    """A top-k report: the eight most frequent, ties by first rule."""
    return RP.top_counts(table(spark, d, "rule_snapshots"), "category", "rule_id")


@query("SELECT category, count(DISTINCT rule_id) AS rules, count(DISTINCT source) + max((source IS NULL)::INT) AS sources FROM rule_snapshots GROUP BY category")
def q_category_counts(spark, d):
    return table(spark, d, "rule_snapshots").groupBy("category").agg(F.count_distinct("rule_id").alias("rules"), RP.distinct_count(F.col("source")).alias("sources"))


_MARKERS = (("lift", 0.2, "lifts"), ("oxygen", 0.5, "oxygen"), ("wheelchair", 0.8, "wheelchairs"), ("companion", 1.0, "companions"))


@query("SELECT doc_id, CASE " + " ".join(f"WHEN contains(text, '{m}') THEN {x}" for m, x, _ in _MARKERS[::-1]) + " ELSE 0 END AS share, CASE " + " ".join(f"WHEN contains(text, '{m}') THEN '{lb}'" for m, _, lb in _MARKERS[::-1]) + " ELSE '' END AS label FROM documents")
def q_progress(spark, d):
    return RP.progress(table(spark, d, "documents"), _MARKERS, "doc_id", "text")


@query("SELECT entity_type, count(*) AS n, sum(coalesce(len(services), 0))::BIGINT AS services, count(DISTINCT source_id) + max((source_id IS NULL)::INT) AS sources FROM clean_entities GROUP BY entity_type")
def q_type_counts(spark, d):
    size = F.when(F.col("services").isNull(), 0).otherwise(F.size("services"))
    return table(spark, d, "clean_entities").groupBy("entity_type").agg(F.count("*").alias("n"), F.sum(size).alias("services"), RP.distinct_count(F.col("source_id")).alias("sources"))


# --- stores ----------------------------------------------------------------------------------------------------------------------------------

_last = "SELECT * FROM {} WHERE entity_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY updated_at DESC, entity_name DESC NULLS LAST, source_id DESC NULLS LAST, entity_type DESC NULLS LAST) = 1"


@query(f"WITH c AS ({_last.format('clean_entities')}), s AS ({_last.format('store_entities')}) SELECT entity_id, entity_name, updated_at FROM c UNION ALL SELECT entity_id, entity_name, updated_at FROM s WHERE entity_id NOT IN (SELECT entity_id FROM c)")
def q_upsert(spark, d):
    cols = ["entity_id", "source_id", "entity_name", "entity_type", "updated_at"]
    store = R.keep_first(table(spark, d, "store_entities").select(*cols), ["entity_id"], ["updated_at", "entity_name", "source_id", "entity_type"], last=True)
    return S.upsert(store, table(spark, d, "clean_entities").select(*cols), "entity_id", ["updated_at", "entity_name", "source_id", "entity_type"]).select("entity_id", "entity_name", "updated_at")


_idx = f"SELECT key, doc, kind FROM ({_index_sql})"


@query(f"""
    WITH i AS ({_idx}), e AS (SELECT *, rank() OVER (ORDER BY entity_id, updated_at) AS no FROM (SELECT DISTINCT entity_id, updated_at, entity_name, entity_type FROM clean_entities)),
    n AS (SELECT DISTINCT entity_name AS name, entity_type AS kind FROM e WHERE entity_type IN ('airline', 'airport') AND entity_name IS NOT NULL),
    t AS (SELECT name, kind, 0 AS pos, {_nk('name')} AS key FROM n UNION ALL SELECT name, kind, k, w[k] FROM (SELECT name, kind, w, unnest(range(1, 1 + len(w))) AS k FROM (SELECT name, kind, {words(_nk('name'))} AS w FROM n))),
    h AS (SELECT name, kind, arg_min(doc, pos) AS doc FROM t JOIN i USING (key, kind) GROUP BY ALL),
    p AS (SELECT coalesce(h.doc, 'new:' || {_nk("coalesce(entity_name, '')")}) AS doc_id, CASE WHEN h.doc IS NULL THEN 'inserted' ELSE 'updated' END AS outcome, no FROM e LEFT JOIN h ON h.name = e.entity_name AND h.kind = e.entity_type WHERE e.entity_type IN ('airline', 'airport')),
    l AS (SELECT doc_id, arg_max(outcome, no) AS outcome FROM p GROUP BY doc_id), docs AS (SELECT DISTINCT airline_id AS doc_id FROM airlines UNION SELECT airport_id FROM airports)
    SELECT outcome, count(*) AS n FROM (SELECT outcome FROM l UNION ALL SELECT 'skipped' FROM e WHERE coalesce(entity_type, '') NOT IN ('airline', 'airport') UNION ALL SELECT 'kept' FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM l)) GROUP BY outcome""")
def q_push_services(spark, d):
    e = table(spark, d, "clean_entities").select("entity_id", "updated_at", "entity_name", "entity_type").distinct().withColumn("services", F.lit(1)).withColumn("entity_no", F.struct("entity_id", "updated_at"))
    docs = table(spark, d, "airlines").select(F.col("airline_id").alias("doc_id"), F.lit("airline").alias("entity_type")).union(table(spark, d, "airports").select("airport_id", F.lit("airport"))).distinct().withColumn("services", F.lit(0))
    return S.push_services(e, docs, _index(spark, d)).groupBy("outcome").agg(F.count("*").alias("n"))


@query("SELECT entity_type, count(*) AS n FROM store_entities WHERE source_id IS NULL OR source_id NOT IN ('fenorra_prm_guide', 'wexovar_accessible_travel') GROUP BY entity_type")
def q_delete_keys(spark, d):
    return S.delete_keys(table(spark, d, "store_entities"), ["fenorra_prm_guide", "wexovar_accessible_travel"], "source_id").groupBy("entity_type").agg(F.count("*").alias("n"))


@query("""
    SELECT entity_name, entity_type, source_id, n_services::INT AS n_services, updated_at, collection, count(*) AS n FROM (
      SELECT coalesce(nullif(name, ''), airline_id) AS entity_name, 'airline' AS entity_type, airline_id AS source_id, coalesce(len(services), 0) AS n_services, '' AS updated_at, 'airlines' AS collection FROM airlines
      UNION ALL SELECT coalesce(nullif(name, ''), nullif(full_name, ''), airport_id), 'airport', airport_id, coalesce(len(services), 0), '', 'airports' FROM airports
      UNION ALL SELECT coalesce(nullif(entity_name, ''), entity_id), coalesce(entity_type, 'reference'), entity_id, coalesce(len(services), 0), coalesce(substr(updated_at::VARCHAR, 1, 10), ''), 'regulations' FROM store_entities WHERE coalesce(entity_type, '') NOT IN ('airline', 'airport')) GROUP BY ALL""")
def q_store_listing(spark, d):
    none = F.lit(None).cast("timestamp").alias("updated_at")
    airlines = table(spark, d, "airlines").select(F.col("airline_id").alias("doc_id"), "name", "services", none)
    airports = table(spark, d, "airports").select(F.col("airport_id").alias("doc_id"), "name", "full_name", "services", none)
    rest = table(spark, d, "store_entities").where(~F.coalesce("entity_type", F.lit("")).isin("airline", "airport")).select(F.col("entity_id").alias("doc_id"), F.col("entity_name").alias("name"), "entity_type", "services", "updated_at")
    return S.listing(airlines, airports, rest).groupBy("entity_name", "entity_type", "source_id", "n_services", "updated_at", "collection").agg(F.count("*").alias("n"))


@query("WITH k AS (SELECT DISTINCT id AS doc_id FROM sources), x AS (SELECT source_id AS doc_id, count(*) AS pages FROM page_texts GROUP BY source_id) SELECT k.doc_id, x.pages, CASE WHEN x.doc_id IS NULL THEN 'placeholder' ELSE 'present' END AS state FROM k LEFT JOIN x USING (doc_id)")
def q_sync_metadata(spark, d):
    docs = table(spark, d, "page_texts").groupBy(F.col("source_id").alias("doc_id")).agg(F.count("*").alias("pages"), F.max("text").alias("services"))
    return S.sync_metadata(table(spark, d, "sources").select(F.col("id").alias("doc_id")), docs, ["services"])


# --- enrichment and streams ------------------------------------------------------------------------------------------------------------------


@query(f"""
    WITH u AS (SELECT source_id, chunk_no, id AS parent_id, coalesce(nullif(section, ''), 'General') AS section, text, row_number() OVER (PARTITION BY source_id ORDER BY chunk_no) - 1 AS pos FROM semantic_chunks WHERE NOT coalesce(sent, false) AND text IS NOT NULL),
    l AS (SELECT *, string_split({sub('text', rf'([.!?]){WS}+', chr(92) + '1' + chr(29))}, chr(29)) AS l FROM u), e AS (SELECT source_id, pos // 30 AS batch, pos AS place, parent_id, {strip('section')} AS section, unnest(range(1, 1 + len(l))) AS k, {strip('unnest(l)')} AS text FROM l),
    v AS (SELECT source_id, batch, row_number() OVER (PARTITION BY source_id, batch ORDER BY place, k) - 1 AS pos, md5(text) AS id, parent_id, section, text FROM e WHERE length(text) > 30 AND section <> '')
    SELECT source_id, batch, pos::INT AS pos, id, parent_id, section FROM v QUALIFY row_number() OVER (PARTITION BY source_id, substr(text, 1, 200), section ORDER BY batch, v.pos) = 1""")
def q_refine_chunks(spark, d):
    return E.refine(table(spark, d, "semantic_chunks"), E.SentenceBackend()).select("source_id", "batch", "pos", "id", "parent_id", "section")


_KINDS = {"oxygen": "oxygen_on_board", "wheelchair": "wheelchair_assistance", "dog": "assistance_dog", "scooter": "mobility_equipment"}


@query()
def q_entity_assembly(spark, d):
    chunks = table(spark, d, "semantic_chunks").where(F.col("entity_type").isin("airline", "airport"))
    found = E.extract_services(chunks, E.KeywordBackend(_KINDS))
    return E.entities(chunks, found).select("source_id", "entity_name", "entity_type", "source_url", F.size("services").alias("n"))


def _stream_dir(spark) -> str:
    return os.path.join(shared_dir(spark), f"doclathe-stream-{uuid.uuid4().hex}")


@query("SELECT substr(sha256(coalesce(text, '')), 1, 32) AS content_id FROM page_texts GROUP BY 1")
def q_stream_dedupe(spark, d):
    """Content ids of all pages, as a stream that ends with what is there. The watermark is wider than the data, so each content comes once."""
    out, folder = _stream_dir(spark), f"{d}/page_texts.parquet"
    schema = spark.read.parquet(folder).schema
    stream = ingest.unseen(ingest.read_files(spark, folder if os.path.isdir(folder) else f"{d}/page_texts*.parquet", schema), "text", "fetched_at", "3650 days").select("content_id")
    ingest.run_available(stream, f"{out}/checkpoint", out=f"{out}/rows")
    return spark.read.schema("content_id string").parquet(f"{out}/rows")


@query(f"SELECT entity_id, entity_name, updated_at FROM ({_last.format('store_entities')})")
def q_stream_upsert(spark, d):
    out, folder = _stream_dir(spark), f"{d}/store_entities.parquet"
    schema = spark.read.parquet(folder).schema
    stream = ingest.read_files(spark, folder if os.path.isdir(folder) else f"{d}/store_entities*.parquet", schema, 4).select("entity_id", "updated_at", "entity_name", "source_id", "entity_type")
    held = ingest.VersionedTable(spark, f"{out}/table", "entity_id", 8)
    ingest.run_available(stream, f"{out}/checkpoint", ingest.upsert_sink(held, ["updated_at", "entity_name", "source_id", "entity_type"]))
    return held.read().select("entity_id", "entity_name", "updated_at")


@query("""SELECT * FROM (SELECT date_trunc('day', fetched_at) AS window_start, source_id, count(*) AS n FROM semantic_chunks WHERE fetched_at IS NOT NULL GROUP BY ALL)
    WHERE window_start + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max(fetched_at)) - INTERVAL 2 DAY FROM semantic_chunks)""")
def q_daily_counts(spark, d):
    """Counts per day and source as a stream that ends with what is there: the days that the watermark, two days behind the latest row, has closed."""
    out, folder = _stream_dir(spark), f"{d}/semantic_chunks.parquet"
    schema = spark.read.parquet(folder).schema
    stream = ingest.read_files(spark, folder if os.path.isdir(folder) else f"{d}/semantic_chunks*.parquet", schema, 1_000_000)
    ingest.run_available(ingest.windowed_counts(stream, "fetched_at", ["source_id"], "2 days"), f"{out}/checkpoint", out=f"{out}/rows")
    return spark.read.schema("window_start timestamp, source_id string, n long").parquet(f"{out}/rows")


@query("SELECT window_start, source_id, count(*) AS n FROM (SELECT source_id, unnest([date_trunc('hour', fetched_at), date_trunc('hour', fetched_at) - INTERVAL 1 HOUR]) AS window_start FROM page_texts WHERE fetched_at IS NOT NULL) GROUP BY ALL")
def q_sliding_counts(spark, d):
    t = table(spark, d, "page_texts").where("fetched_at is not null").withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    return t.groupBy(F.window("fetched_at", "2 hours", "1 hour").alias("w"), "source_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "source_id", "n")


@query("""
    WITH g AS (SELECT user_id, ts, coalesce((ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE)::INT, 0) AS new FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) AS last_ts, count(*) AS n FROM s GROUP BY user_id, no""")
def q_session_windows(spark, d):
    t = table(spark, d, "events").where("ts is not null and user_id is not null").withColumn("ts", F.col("ts").cast("timestamp"))
    return t.groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.max("ts").alias("last_ts"), F.count("*").alias("n")).select("user_id", F.col("w.start").alias("session_start"), "last_ts", "n")
