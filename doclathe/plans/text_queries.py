"""Queries of the text rules and the quality gate, with the SQL that checks them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclathe.functions import quality as Q
from doclathe.functions import text as T
from doclathe.runtime import spread, table

WS, CH = T.WS, T.WS_CHARS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, 'g')"


def strip(x: str) -> str:
    return sub(x, rf"^{WS}+|{WS}+\z")


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {lit(pattern)})"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {lit(WS + '+')}), lambda w: w <> '')"


def n_words(x: str) -> str:
    return f"len({words(x)})"


def count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {lit(pattern)}))"


def upper(x: str) -> str:
    return f"({has(x, '[[:upper:]]|\\p{Lu}')} AND NOT {has(x, '\\p{Ll}')})"


def clean(x: str) -> str:
    x = reduce(lambda y, step: sub(y, step[0], step[1]), T.CLEAN_STEPS, x)
    return strip(sub(f"translate({x}, {lit(T.CLEAN_FROM)}, {lit(T.CLEAN_TO)})", "  +", " "))


def normal(x: str) -> str:
    return strip(sub(sub(sub(clean(x), r"\n+", "\n\n"), rf"([.!?]){WS}+", "\\1\n\n"), r"\n{3,}", "\n\n"))


def headings(x: str) -> str:
    return f"array_to_string(list_transform(list_transform(string_split({x}, chr(10)), lambda s: {strip('s')}), lambda s: CASE WHEN length(s) < 80 AND {upper('s')} THEN chr(10) || '## ' || s || chr(10) ELSE s END), chr(10))"


QUERIES, ORACLES = {}, {}


def add(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


def _texts(name: str, make, sql: str, source: str = "documents", key: str = "doc_id", text: str = "text") -> None:
    """A query of the md5 and length of a transformed text of every row."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return spread(table(spark, d, source).select(key, text)).select(key, make(F.col(text)).alias("t")).select(key, F.md5("t").alias("md5"), F.length("t").alias("size"))

    add(name, run, f"SELECT {key}, md5(t) AS md5, length(t)::INT AS size FROM (SELECT {key}, {sql} AS t FROM {source})")


_texts("q_clean_text", T.clean_text, clean("text"))
_texts("q_normalize_text", T.normalize_text, normal("text"))
_texts("q_finalise", T.finalise, strip(sub(sub("text", r"\n+", " "), "  +", " ")))
_texts("q_plain_clean", T.plain_clean, strip(sub(sub(sub("text", WS + "+", " "), rf"\.{WS}+", ".\n\n"), r"[^\x{0}-\x{7F}]+", " ")))
_texts("q_detect_headings", T.detect_headings, headings("text"), "page_texts", "page_id")
_texts("q_collapse", T.collapse, strip(sub("text", WS + "+", " ")), "scrape_results", "scrape_id")
for _name, _extracted in (("q_page_clean_raw", False), ("q_page_clean_extracted", True)):
    _lines = f"list_filter(list_transform(string_split({sub(sub('text', chr(13), chr(10)), rf'([.!?]){WS}+', chr(92) + '1' + chr(10) * 2)}, chr(10)), lambda s: {strip('s')}), lambda s: length(s) >= {3 if _extracted else 20})"
    _kept = f"list_transform(list_filter(list_zip({_lines}, range(1, 1 + len({_lines}))), lambda p: list_position({_lines}, p[1]) = p[2]), lambda p: p[1])"
    _texts(_name, lambda c, e=_extracted: T.page_clean(c, e), f"CASE WHEN text IS NOT NULL THEN {headings(f'array_to_string({_kept}, chr(10))')} END", "page_texts", "page_id")


def q_paragraphs(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.posexplode(T.paragraphs(F.col("text"))).alias("para_no", "p"))
    return t.select("doc_id", "para_no", F.md5("p").alias("md5"))


add("q_paragraphs", q_paragraphs, f"""
    WITH p AS (SELECT doc_id, list_filter(list_transform(string_split({normal('text')}, chr(10) || chr(10)), lambda s: {strip('s')}), lambda s: s <> '') AS l FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, (i - 1)::INT AS para_no, md5(l[i]) AS md5 FROM (SELECT doc_id, l, unnest(range(1, 1 + len(l))) AS i FROM p)""")


def q_sentences(spark, d):
    return table(spark, d, "semantic_chunks").select("chunk_no", F.size(T.sentences(F.col("text"))).alias("n")).where("n >= 0")


add("q_sentences", q_sentences, f"SELECT chunk_no, len(list_filter(string_split({sub('text', rf'([.!?]){WS}+', chr(92) + '1' + chr(29))}, chr(29)), lambda s: {strip('s')} <> ''))::INT AS n FROM semantic_chunks WHERE text IS NOT NULL")


def q_clean_section(spark, d):
    """Sections, and the pages' URLs as sections."""
    t = table(spark, d, "semantic_chunks").select("chunk_no", F.explode(F.array("section", "source", F.concat(F.lit("## "), "section"))).alias("s"))
    return t.select("chunk_no", F.coalesce("s", F.lit("")).alias("raw"), T.clean_section(F.col("s")).alias("clean"))


_bare = strip(sub(sub(strip("raw"), rf"^#{{1,6}}{WS}+"), rf"^Source:{WS}*https?://[^{CH}]+"))
add("q_clean_section", q_clean_section, f"""
    WITH s AS (SELECT chunk_no, coalesce(x, '') AS raw FROM (SELECT chunk_no, unnest([section, source, '## ' || section]) AS x FROM semantic_chunks)),
    b AS (SELECT *, {_bare} AS bare FROM s), u AS (SELECT *, {sub("regexp_extract(bare, '^https?://[^/?#]*([^?#]*)', 1)", "/+\\z")} AS path, regexp_extract(bare, '^https?://([^/?#]*)', 1) AS host FROM b)
    SELECT chunk_no, raw, CASE WHEN bare = '' THEN 'General' WHEN NOT {has('bare', '^https?://')} THEN bare ELSE replace(coalesce(nullif(string_split(path, '/')[-1], ''), host), '-', ' ') END AS clean FROM u""")


def _page_lines(spark, d, name="page_texts", key="page_id"):
    return spread(table(spark, d, name).select(key, "text")).select(key, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _page_lines_sql(name="page_texts", key="page_id") -> str:
    return f"SELECT {key}, (i - 1)::INT AS line_no, l[i] AS line FROM (SELECT {key}, l, unnest(range(1, 1 + len(l))) AS i FROM (SELECT {key}, string_split(text, chr(10)) AS l FROM {name} WHERE text IS NOT NULL))"


def q_line_classes(spark, d):
    line = F.col("line")
    return _page_lines(spark, d).select("page_id", "line_no", T.is_heading(line).alias("heading"), T.is_fragment(line).alias("fragment"), T.is_truncated(line).alias("truncated"), T.is_bullet(line).alias("bullet"), T.is_json_artifact(line).alias("json"))


_cap = r"^[\p{Lu}\p{Lt}]"


def heading_sql(s: str) -> str:
    """is_heading of a trimmed line."""
    alpha = f"list_filter({words(s)}, lambda w: {has('w', '^' + chr(92) + 'p{L}+' + chr(92) + 'z')})"
    title = f"(len({alpha}) > 0 AND {n_words(s)} <= 10 AND len(list_filter({alpha}, lambda w: NOT {has('w', _cap)})) = 0)"
    return f"""({s} <> '' AND {s} NOT IN ('{{', '}}', '[', ']') AND NOT {has(s, T.JSON_FIELD)} AND ({has(s, rf'^#{{1,6}}{WS}+')} OR ({s} LIKE '%?' AND length({s}) < 120)
        OR (length({s}) < 100 AND ({upper(s)} OR {s} LIKE '%:' OR {has(s, rf'^[0-9]+(\.[0-9]+)*\.{WS}+[A-Z]')})) OR {title}))"""


def bullet_sql(s: str) -> str:
    return has(s, rf"^([-•*]|[0-9]+\.|[a-zA-Z]\)){WS}+")


def fragment_sql(s: str) -> str:
    return f"({s} IN ('{{', '}}', '[', ']') OR {has(s, T.JSON_FIELD)} OR {has(s, r'^[)\]}\p{Ll}]')})"


def truncated_sql(s: str) -> str:
    last = f"regexp_extract({s}, {lit(rf'([^{CH}]+)' + chr(92) + 'z')}, 1)"
    return f"({s} = '' OR ({has(s, r'\p{L}\z')} AND ((length({last}) <= 4 AND {has(last, r'\p{Ll}')} AND NOT {has(last, r'\p{Lu}')}) OR {has(last, rf'[^aeiouAEIOU{CH}]{{3}}' + chr(92) + 'z')})))"


def section_sql(x: str) -> str:
    """clean_section."""
    bare = strip(sub(sub(strip(f"coalesce({x}, '')"), rf"^#{{1,6}}{WS}+"), rf"^Source:{WS}*https?://[^{CH}]+"))
    path = sub(f"regexp_extract({bare}, '^https?://[^/?#]*([^?#]*)', 1)", "/+\\z")
    host = f"regexp_extract({bare}, '^https?://([^/?#]*)', 1)"
    return f"CASE WHEN {bare} = '' THEN 'General' WHEN NOT {has(bare, '^https?://')} THEN {bare} ELSE replace(coalesce(nullif(string_split({path}, '/')[-1], ''), {host}), '-', ' ') END"


add("q_line_classes", q_line_classes, f"""
    SELECT page_id, line_no, {bullet_sql('line')} AS bullet, {has('s', T.JSON_FIELD)} AS json, {heading_sql('s')} AS heading, {fragment_sql('s')} AS fragment, {truncated_sql('s')} AS truncated FROM (SELECT *, {strip('line')} AS s FROM ({_page_lines_sql()}))""")


def chunks_sql(source: str, key: str, size: int = 1200) -> str:
    """WITH clauses up to `chunk`: (key, chunk_no, id, section, text) of semantic_chunks over (key, text) of a source."""
    one = f"(length(text) + CASE kind WHEN 'B' THEN 1 ELSE 2 END)"
    full = f"(r.len + {one} > {size})"
    return f"""
    RECURSIVE para AS (SELECT {key} AS key, unnest(range(1, 1 + len(l))) AS n, unnest(l) AS text FROM (SELECT {key}, list_filter(list_transform(string_split({normal('text')}, chr(10) || chr(10)), lambda s: {strip('s')}), lambda s: s <> '') AS l FROM {source} WHERE text IS NOT NULL)),
    kept AS (SELECT key, row_number() OVER (PARTITION BY key ORDER BY n) AS i, text, CASE WHEN {heading_sql('text')} THEN 'H' WHEN {bullet_sql('text')} THEN 'B' WHEN length(text) > {size} THEN 'L' ELSE 'P' END AS kind FROM para WHERE NOT {fragment_sql('text')}),
    part AS (SELECT key, i, text, kind, CASE WHEN kind = 'H' THEN {section_sql('text')} END AS named FROM kept UNION ALL SELECT key, max(i) + 1, '', 'E', NULL FROM kept GROUP BY key),
    r AS (SELECT DISTINCT key, 0::BIGINT AS i, 'General' AS section, '' AS held, 0 AS len, NULL::VARCHAR AS raw, NULL::VARCHAR AS site, NULL::VARCHAR AS head FROM part
      UNION ALL SELECT r.key, p.i, coalesce(p.named, r.section), CASE kind WHEN 'H' THEN '' WHEN 'E' THEN '' WHEN 'L' THEN held ELSE CASE WHEN {full} THEN '' ELSE held END || text || CASE kind WHEN 'B' THEN chr(10) ELSE chr(10) || chr(10) END END,
        (CASE kind WHEN 'H' THEN 0 WHEN 'E' THEN 0 WHEN 'L' THEN r.len ELSE CASE WHEN {full} AND held <> '' THEN 0 ELSE r.len END + {one} END)::INT,
        CASE WHEN kind = 'L' THEN text WHEN held <> '' AND (kind IN ('H', 'E') OR {full}) THEN held END, CASE kind WHEN 'L' THEN 'l' WHEN 'H' THEN 'h' ELSE 'f' END, r.section
      FROM r JOIN part p ON p.key = r.key AND p.i = r.i + 1),
    out AS (SELECT key, (row_number() OVER (PARTITION BY key ORDER BY i) - 1)::INT AS chunk_no, head AS section, site, {strip('raw')} AS raw, {strip(sub(sub('raw', r"\n+", ' '), '  +', ' '))} AS flat FROM r WHERE raw IS NOT NULL),
    chunk AS (SELECT key, chunk_no, section, CASE site WHEN 'l' THEN raw ELSE flat END AS text, md5(CASE site WHEN 'f' THEN flat ELSE raw END) AS id FROM out WHERE NOT {truncated_sql("CASE site WHEN 'f' THEN flat ELSE raw END")})"""


def q_pdf_line_filters(spark, d):
    flags = T.pdf_line_flags(F.col("line"))
    kept = ~reduce(lambda a, b: a | b, flags.values())
    return _page_lines(spark, d).select("page_id", "line_no", *(f.alias(n) for n, f in flags.items()), kept.alias("kept"))


def _pdf_flags_sql(s: str) -> dict[str, str]:
    low = f"lower({s})"
    return {
        "low_value": f"({low} = '' OR {has(low, T.LOW_VALUE)} OR {has(low, '^[0-9]+' + chr(92) + 'z')} OR {has(low, rf'^[.{chr(92)}-{CH}]{{10,}}' + chr(92) + 'z')} OR (length({low}) < 40 AND {has(low, f'{T.BEFORE}(page|chapter|table|figure){T.AFTER}')}))",
        "toc": f"({has(low, r'\.{3,}')} OR {has(low, rf'^[0-9]+{WS}+[0-9]+(\.[0-9]+)*\.{WS}+')})",
        "chart": f"({has(low, f'{T.BEFORE}(0|10|20|30|40|50|60|70|80|90|100)%{T.WORD}')} OR {count(low, '[0-9]+%')} > 3)",
        "numeric": f"({n_words(s)} = 0 OR {count(s, '[0-9]+[,.]?[0-9]*%?')} > 0.4 * greatest({n_words(s)}, 1))",
        "repeated": f"(length({s}) < 5 OR {has(low, f'page{WS}*[0-9]+')} OR (len(list_distinct(string_split({s}, ''))) < 5 AND length({s}) > 20))",
        "reference": f"(({has(s, f'{T.BEFORE}(19|20)[0-9]{{2}}[a-z]?{T.AFTER}')} AND {n_words(s)} < 12) OR {has(s, rf'^[A-Z][a-z]+,{WS}[A-Z]\.')} OR (length({s}) - length(replace({s}, ',', '')) >= 2 AND {has(s, '[0-9]{4}')}))",
        "ocr": rf"({has(s, f'{T.BEFORE}{T.WORD}{WS}{T.WORD}{WS}{T.WORD}{T.AFTER}')} OR len(list_filter(string_split_regex({s}, '[^\p{{L}}\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-zA-Z]'))) > 3 OR (length({s}) > 20 AND length({s}) - length(replace({s}, ' ', '')) > 0.25 * length({s})))",
        "form": f"(contains({low}, 'observations and/or suggestions') OR contains({low}, 'thank you') OR {has(low, '_{3,}')} OR ({count(low, '[a-z]')} < 5 AND contains({low}, '_')))",
    }


_flags = _pdf_flags_sql("s")
add("q_pdf_line_filters", q_pdf_line_filters, f"SELECT page_id, line_no, {', '.join(f'{v} AS {k}' for k, v in _flags.items())}, NOT ({' OR '.join(_flags.values())}) AS kept FROM (SELECT page_id, line_no, {strip('line')} AS s FROM ({_page_lines_sql()}))")
_flat = strip(sub(sub(f"translate({sub('text', r'\x{FFFD}')}, ' –—', ' --')", rf"([\p{{L}}\p{{N}}_]){WS}{{2,}}([\p{{L}}\p{{N}}_])", "\\1 \\2"), " +", " "))
_texts("q_pdf_clean", T.pdf_clean, f"CASE WHEN text IS NOT NULL THEN array_to_string(list_filter(list_transform(string_split({_flat}, chr(10)), lambda s: {strip('s')}), lambda s: NOT ({' OR '.join(_flags.values())})), chr(10)) END", "raw_pages", "page_id")


def q_format_sniff(spark, d):
    t = table(spark, d, "scrape_results")
    return t.select("scrape_id", T.is_html(F.col("html")).alias("html_is_html"), T.is_html(F.col("text")).alias("text_is_html"), T.is_json(F.col("text")).alias("text_is_json"))


_html = "coalesce(regexp_matches(lower({0}), '<html|<body|<div|<a '), false)"
add("q_format_sniff", q_format_sniff, f"""SELECT scrape_id, {_html.format('html')} AS html_is_html, {_html.format('text')} AS text_is_html,
    coalesce((starts_with({strip('text')}, '{{') AND ends_with({strip('text')}, '}}')) OR (starts_with({strip('text')}, '[') AND ends_with({strip('text')}, ']')), false) AS text_is_json FROM scrape_results""")


def q_failure_diagnosis(spark, d):
    return table(spark, d, "scrape_results").select("scrape_id", T.failure(F.col("html")).alias("failure"), T.is_bot_wall(F.col("html")).alias("bot_wall"), T.is_bot_wall(F.col("text"), T.LEGAL_SITE_SIGNS, None).alias("site_wall"))


_low = "lower(coalesce(html, ''))"
_wall = "regexp_matches(lower(substr({0}, 1, 5000)), 'not a bot|are you a robot|security verification|security service to protect|malicious bots|while the website verifies|checking your browser|enable javascript and cookies|browser security check|ddos protection|cloudflare ray id|cf-browser-verification|one more step|_cf_chl|ak_bmsc')"
add("q_failure_diagnosis", q_failure_diagnosis, f"""SELECT scrape_id, CASE WHEN {_low} = '' THEN 'no response'
    WHEN regexp_matches({_low}, 'are you a robot|verify you are human|captcha|cloudflare|ray id|security check|ddos protection|access denied|unusual traffic|checking your browser') THEN 'bot detection'
    WHEN regexp_matches({_low}, 'subscribe to read|sign in to continue|members only|login required|subscription required|unlock this article|create an account') THEN 'paywall'
    WHEN regexp_matches({_low}, 'page not found|404 not found|doesn''t exist|no longer available|has been removed') THEN 'page not found'
    WHEN length({_low}) < 1000 THEN 'near-empty response' ELSE 'structure not recognised' END AS failure, coalesce({_wall.format('html')}, false) AS bot_wall,
    coalesce(regexp_matches(lower(text), 'access denied|unusual behaviour|security check|please enable cookies|cf-error|ray id|verify you are human|captcha|403 forbidden'), false) AS site_wall FROM scrape_results""")


def q_scrape_cascade(spark, d):
    """Which way a page's content is had. The pages of the table are both what a plain fetch and, twice over, what a browser gives."""
    t = table(spark, d, "scrape_results")
    got = T.scrape_cascade(F.col("html"), F.col("text"), F.concat("html", "html"), F.col("text"))
    small = T.scrape_cascade(F.col("html"), F.col("text"), F.lit(None).cast("string"), F.lit(None).cast("string"), least_html=500)
    return t.select("scrape_id", got["via"].alias("via"), F.length(got["text"]).alias("size"), F.length(got["html"]).alias("html_size"), small["via"].alias("small_via"))


_scripted = "regexp_matches(html, 'aria-expanded=\"false\"|data-state=\"closed\"|data-state=\"inactive\"|<details|window\\.__NEXT_DATA__|window\\.__NUXT__|__vue_app__|ng-version|data-reactroot|svelte-announcer')"
_plain = f"coalesce(html, '') <> '' AND NOT {_wall.format('html')} AND NOT {_scripted} AND length(coalesce(text, '')) >= 200"
add("q_scrape_cascade", q_scrape_cascade, f"""
    WITH v AS (SELECT *, CASE WHEN {_plain} AND length(html) >= 5000 THEN 'static' WHEN coalesce(html, '') <> '' AND NOT {_wall.format('html || html')} AND length(coalesce(text, '')) >= 200 THEN 'browser' ELSE 'failed' END AS way FROM scrape_results)
    SELECT scrape_id, way AS via, CASE WHEN way = 'failed' THEN 0 ELSE length(text) END::INT AS size, (CASE WHEN way = 'browser' OR (way = 'failed' AND coalesce({_wall.format('html || html')}, false)) THEN 2 ELSE 1 END * length(coalesce(html, '')))::INT AS html_size,
      CASE WHEN {_plain} AND length(html) >= 500 THEN 'static' ELSE 'failed' END AS small_via FROM v""")


def _gate(spark, d) -> DataFrame:
    return spread(table(spark, d, "scrape_results").select("scrape_id", "text")).select("scrape_id", Q.reason(F.col("text")).alias("reason"), Q.detail(F.col("text")).alias("detail"))


_s = strip("coalesce(text, '')")
_structural = r"^[|/\-_=+*•·\s]+\z"
_lines = f"list_filter(list_transform(string_split_regex(s, {lit(T.LINE_BREAK)}), lambda l: {strip('l')}), lambda l: l <> '' AND NOT {has('l', _structural)})"
_gate_sql = f"""
    WITH a AS (SELECT @KEY, {_s} AS s FROM @FROM), b AS (SELECT *, lower(substr(s, 1, 1000)) AS sample, {_lines} AS l FROM a),
    c AS (SELECT *, len(l)::INT AS n, len(list_filter(l, lambda x: {n_words('x')} <= 2)) / nullif(len(l), 0)::DOUBLE AS short_share,
          coalesce(list_max(list_transform(list_distinct(l), lambda x: len(list_filter(l, lambda y: y = x)))), 0)::INT AS top FROM b)"""


def _gated(key: str, source: str) -> str:
    return _gate_sql.replace("@KEY", key).replace("@FROM", source)


_why = "CASE WHEN s = '' THEN 'empty' WHEN length(s) < 150 THEN 'too_short' " + " ".join(f"WHEN {has('sample', T.any_phrase(p))} THEN '{n}'" for n, p in Q.PHRASES) + " WHEN n > 15 AND short_share > 0.75 THEN 'noise_ratio' WHEN n > 10 AND top > 5 THEN 'repetition' ELSE 'ok' END"
_found = "CASE why WHEN 'too_short' THEN length(s)::VARCHAR " + " ".join(f"WHEN '{n}' THEN list_filter([{', '.join(lit(x) for x in p)}], lambda x: contains(sample, x))[1]" for n, p in Q.PHRASES) + " WHEN 'noise_ratio' THEN round_even(100 * short_share, 0)::INT::VARCHAR WHEN 'repetition' THEN top::VARCHAR END"
add("q_quality_gate", _gate, _gated("scrape_id", "scrape_results") + f", d AS (SELECT *, {_why} AS why FROM c) SELECT scrape_id, why AS reason, {_found} AS detail FROM d")


def q_quality_counts(spark, d):
    t = spread(table(spark, d, "documents").select("source", "text")).select(F.coalesce("source", F.lit("")).alias("source"), Q.reason(F.col("text")).alias("reason"))
    return t.groupBy("source", "reason").agg(F.count("*").alias("n"))


add("q_quality_counts", q_quality_counts, _gated("coalesce(source, '') AS source", "documents") + f" SELECT source, {_why} AS reason, count(*) AS n FROM c GROUP BY ALL")


def q_line_stats(spark, d):
    t = F.col("text")
    return table(spark, d, "raw_pages").where("text is not null").select("page_id", F.size(Q.lines(t)).alias("n"), F.round(Q.short_share(t), 6).alias("short_share"), Q.top_count(t).alias("top"))


add("q_line_stats", q_line_stats, _gated("page_id", "raw_pages WHERE text IS NOT NULL") + " SELECT page_id, n, round(short_share, 6) AS short_share, top FROM c")


def q_language(spark, d):
    t = table(spark, d, "documents").select(F.coalesce(F.lower("lang"), F.lit("")).alias("lang"), T.language(F.col("text")).alias("guess"))
    return t.groupBy("lang", "guess").agg(F.count("*").alias("n"))


add("q_language", q_language, "SELECT coalesce(lower(lang), '') AS lang, CASE WHEN coalesce(text, '') = '' THEN 'unknown' WHEN regexp_matches(lower(text), ' el | la | los | una |servicios ') THEN 'es' WHEN regexp_matches(lower(text), ' o | de | para |serviços ') THEN 'pt' ELSE 'en' END AS guess, count(*) AS n FROM documents GROUP BY ALL")


def q_decode_text(spark, d):
    return table(spark, d, "scrape_results").where("text is not null").select("scrape_id", F.md5(T.decode_text(F.col("text"))).alias("md5"))


_decoded = "replace(replace(replace(text, chr(92) || 'u003c', '<'), chr(92) || 'u003e', '>'), chr(92) || 'u0026', '&')"
for _entity, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
    _decoded = f"replace({_decoded}, '{_entity}', '{_char}')"
add("q_decode_text", q_decode_text, f"SELECT scrape_id, md5({_decoded}) AS md5 FROM scrape_results WHERE text IS NOT NULL")


def _classified(rules, default=T.DEFAULT_LABEL):
    def run(spark, d):
        t = table(spark, d, "documents").select(T.classify(F.col("text"), rules, default).alias("label"))
        return t.groupBy("label").agg(F.count("*").alias("n"))

    case = "CASE " + " ".join("WHEN " + has("lower(text)", r"(^|[^\p{L}\p{N}_])(" + T.any_phrase(k) + r")($|[^\p{L}\p{N}_])") + f" THEN {lit(v)}" for k, v in rules) + f" ELSE {lit(default)} END"
    return run, f"SELECT {case} AS label, count(*) AS n FROM documents GROUP BY ALL"


add("q_classify_travel", *_classified(T.TRAVEL_RULES))
add("q_classify_general", *_classified(T.GENERAL_RULES))
add("q_classify_custom", *_classified(((("electric scooter", "scuterul electric"), "Scooters"), (("dog", "câine", "hund"), "Dogs"), (("oxygen", "oxigen"), "Oxygen"), (("lift", "liftul", "aufzug"), "Lifts")), "Other"))


def q_content_hash(spark, d):
    t = table(spark, d, "rule_snapshots")
    own = T.content_hash(F.col("title"), F.col("description"))
    return t.select("snapshot_no", "rule_id", own.alias("hash"), F.coalesce(F.lower("content_hash") == own, F.lit(False)).alias("fresh"))


_hash = f"sha256(lower({strip("coalesce(title, '')")}) || '||' || lower({strip("coalesce(description, '')")}))"
add("q_content_hash", q_content_hash, f"SELECT snapshot_no, rule_id, {_hash} AS hash, coalesce(lower(content_hash) = {_hash}, false) AS fresh FROM rule_snapshots")


def q_ruleset_hash(spark, d):
    """One hash of all rules of a snapshot, in order of rule and hash."""
    t = table(spark, d, "rule_snapshots").select("snapshot_no", F.coalesce("rule_id", F.lit("")).alias("rule_id"), T.content_hash(F.col("title"), F.col("description")).alias("hash"))
    entry = F.concat(F.lit('{"hash": "'), "hash", F.lit('", "rule_id": "'), "rule_id", F.lit('"}'))
    rows = t.groupBy("snapshot_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("rule_id", "hash"))), lambda s: F.concat(F.lit('{"hash": "'), s["hash"], F.lit('", "rule_id": "'), s["rule_id"], F.lit('"}'))).alias("e"))
    return rows.select("snapshot_no", F.sha2(F.concat(F.lit("["), F.array_join("e", ", "), F.lit("]")), 256).alias("ruleset_hash"))


add("q_ruleset_hash", q_ruleset_hash, f"""SELECT snapshot_no, sha256('[' || string_agg('{{"hash": "' || hash || '", "rule_id": "' || rule_id || '"}}', ', ' ORDER BY rule_id, hash) || ']') AS ruleset_hash FROM (SELECT snapshot_no, coalesce(rule_id, '') AS rule_id, {_hash} AS hash FROM rule_snapshots) GROUP BY snapshot_no""")


def q_url_parts(spark, d):
    u = F.col("source")
    t = table(spark, d, "raw_pages").where("source is not null")
    return t.select("page_id", T.domain(u).alias("domain"), T.market(u)["market"].alias("market"), T.path_part(u, 2).alias("part2"), T.last_segment_title(u).alias("last"), T.slug_id(F.regexp_extract(u, r"([^/]*)\z", 1)).alias("slug_id"))


_path = "list_filter(string_split(regexp_extract(source, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda p: p <> '')"
_tail = sub(sub(sub("regexp_extract(source, '^[a-z]+://[^/?#]*([^?#]*)', 1)", r"/+\z").join(("string_split(", ", '/')[-1]")), r"\.[a-z]+\z"), "[-_]+", " ")
_title = lambda x: f"array_to_string(list_transform(string_split({x}, ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')"
add("q_url_parts", q_url_parts, f"SELECT page_id, CASE WHEN contains(source, '://') THEN split_part(source, '/', 3) ELSE source END AS domain, coalesce({_path}[1], '') AS market, coalesce({_path}[2], '') AS part2, {_title(_tail)} AS last, split_part(regexp_extract(source, '([^/]*)\\z', 1), '-', 1) AS slug_id FROM raw_pages WHERE source IS NOT NULL")


def q_celex(spark, d):
    """Legal identifiers of URLs made of document ids: after uri, after from, in neither, and in another form."""
    t = table(spark, d, "documents").select("doc_id", F.explode(F.array(*(F.concat(F.lit(a), F.col("doc_id").cast("string"), F.lit(b)) for a, b in (("https://l.example/legal-content/EN/TXT/?uri=CELEX:3", "R&from=EN"), ("https://l.example/legal-content/EN/TXT/?x=1&from=celex%3A3", ""), ("https://l.example/legal-content/EN/some-page-", "/?uri=OJ:L:1"), ("https://l.example/plain-", ""))))).alias("url"))
    return t.select("doc_id", "url", T.celex(F.col("url")).alias("celex"), T.url_section(F.col("url")).alias("section"))


add("q_celex", q_celex, """SELECT doc_id, unnest(['https://l.example/legal-content/EN/TXT/?uri=CELEX:3' || doc_id || 'R&from=EN', 'https://l.example/legal-content/EN/TXT/?x=1&from=celex%3A3' || doc_id, 'https://l.example/legal-content/EN/some-page-' || doc_id || '/?uri=OJ:L:1', 'https://l.example/plain-' || doc_id]) AS url,
    unnest(['3' || doc_id || 'R', '3' || doc_id, '', '']) AS celex, unnest(['CELEX:3' || doc_id || 'R', 'CELEX:3' || doc_id, 'Some Page ' || doc_id, 'Plain ' || doc_id]) AS section FROM documents""")


def q_labels(spark, d):
    t = table(spark, d, "sources")
    return t.select("id", T.label(F.col("id")).alias("label"), T.name_key(F.col("entity")).alias("name_key"), F.coalesce("max_pages", F.lit(5)).alias("max_pages"))


add("q_labels", q_labels, f"SELECT id, array_to_string(list_transform(string_split(replace(id, '_', ' '), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS label, lower({strip('entity')}) AS name_key, coalesce(max_pages, 5) AS max_pages FROM sources")


def q_social_records(spark, d):
    """Documents as posts: cleaned, hashed, classified, blank ones dropped, the first of equal texts kept."""
    clean = T.collapse(F.col("text"))
    posts = table(spark, d, "documents").select("doc_id", clean.alias("text")).where("text <> ''")
    first = posts.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    return first.select(F.substring(F.sha2("text", 256), 1, 32).alias("id"), T.classify(F.col("text"), T.TRAVEL_RULES, T.DEFAULT_LABEL).alias("section"), F.concat(F.lit("x_tweet_"), F.col("doc_id").cast("string")).alias("source_id"), F.lit("social").alias("type"), F.lit(False).alias("sent"))


_case = "CASE " + " ".join("WHEN " + has("lower(t)", r"(^|[^\p{L}\p{N}_])(" + T.any_phrase(k) + r")($|[^\p{L}\p{N}_])") + f" THEN {lit(v)}" for k, v in T.TRAVEL_RULES) + f" ELSE {lit(T.DEFAULT_LABEL)} END"
add("q_social_records", q_social_records, f"SELECT substr(sha256(t), 1, 32) AS id, {_case} AS section, 'x_tweet_' || min(doc_id)::VARCHAR AS source_id, 'social' AS type, false AS sent FROM (SELECT doc_id, {strip(sub('text', WS + '+', ' '))} AS t FROM documents) WHERE t <> '' GROUP BY t")

