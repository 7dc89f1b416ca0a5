"""JSON kept in texts: envelopes, sectioned pages, model replies and posts of an API."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclathe.functions import text as T

#: Keys that hold a page's body, and keys that envelop it, in the order they are tried.
BODY_KEYS, ENVELOPES = ("body", "html", "content", "description"), ("article", "result", "data", "results")

_PAGE = "array<struct<url:string,market:string,locale:string,title:string,sections:array<struct<heading:string,body:string>>>>"


def _texts(v: Column, keys: tuple[str, ...]) -> Column:
    """The first of the fields of a parsed object that isn't empty, as text; objects and lists stay JSON."""
    return F.coalesce(*(F.when(x != "", x) for k in keys for x in [F.try_variant_get(v, f"$.{k}", "string")]))


def _object(v: Column) -> Column:
    """The text of a parsed JSON object: its first body, or its title as a heading. A body that is JSON itself is opened once."""
    body, title = _texts(v, BODY_KEYS), F.try_variant_get(v, "$.title", "string")
    opened = F.when(body.rlike(r"^\s*\{"), F.try_parse_json(body))
    return F.coalesce(F.when(body.rlike(r"^\s*\{"), _texts(opened, BODY_KEYS)), body, F.when(title != "", F.concat(F.lit("## "), title)), F.lit(""))


def unwrap(c: Column) -> Column:
    """The body of a text that is a JSON object or list, through one envelope; other texts pass. Of invalid JSON the lines that aren't fields stay. Null
    stays null. The text is parsed once."""

    def of(parsed: Column) -> Column:
        envelopes = [F.try_variant_get(parsed, f"$.{k}", "variant") for k in ENVELOPES]
        kind = lambda v: F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)")
        whole = F.coalesce(*(F.when(kind(e), e) for e in envelopes), parsed)
        items = F.try_variant_get(whole, "$", "array<variant>")
        listed = F.array_join(F.filter(F.transform(items, lambda v: T.let(v, _object)), lambda s: s != ""), "\n\n")
        return F.when(items.isNotNull(), listed).otherwise(T.let(whole, _object))

    broken = F.array_join(F.filter(F.split(c, "\n"), lambda line: ~T.is_json_artifact(line)), "\n")
    parsed = T.let(F.when(T.is_json(c), F.try_parse_json(c)), lambda p: F.when(p.isNotNull(), of(p)))
    return F.when(c.isNull(), None).when(~T.is_json(c), c).otherwise(F.coalesce(parsed, broken))


def page_sections(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, page_no, title, section_no, heading, body) of texts that are JSON lists of sectioned pages; others give no rows."""
    rows = df.where(F.col(text).rlike(r'^\s*\[\s*\{"url"')).select(key, F.from_json(text, _PAGE).alias("p"))
    pages = rows.select(key, F.posexplode("p").alias("page_no", "p"))
    return pages.select(key, "page_no", F.col("p.title").alias("title"), F.posexplode("p.sections").alias("section_no", "s")).select(key, "page_no", "title", "section_no", "s.heading", "s.body")


def salvage(c: Column) -> Column:
    """The JSON objects in a model's reply as an array of texts: the whole reply, else what stands from the first [ to the last ]; [] if neither is a list."""
    first = F.from_json(F.when(F.try_parse_json(c).isNotNull(), c), "array<string>")
    part = F.regexp_extract(c, r"(?s)\[.*\]", 0)
    second = F.from_json(F.when(F.try_parse_json(part).isNotNull(), part), "array<string>")
    found = F.when(c.rlike(r"^\s*\[") & first.isNotNull(), first).when((part != "") & second.isNotNull(), second).otherwise(F.array().cast("array<string>"))
    return F.filter(found, lambda x: x.rlike(r"^\s*\{"))


def valid_chunks(objects: Column, least: int = 30) -> Column:
    """Refined chunks of a reply: section and text not blank, text of more than `least` characters, id by content, parent kept."""
    def row(x: Column) -> Column:
        text, section = T.strip(F.get_json_object(x, "$.text")), T.strip(F.get_json_object(x, "$.section"))
        return F.struct(F.md5(text).alias("id"), F.get_json_object(x, "$.parent_id").alias("parent_id"), section.alias("section"), text.alias("text"))

    return F.filter(F.transform(objects, row), lambda s: (F.coalesce(s["section"], F.lit("")) != "") & (F.length(F.coalesce(s["text"], F.lit(""))) > least))


def valid_services(objects: Column, least: int = 20) -> Column:
    """Services of a reply: type in snake case, a description object with English of at least `least` characters; Romanian defaults to English."""
    def row(x: Column) -> Column:
        en, ro = T.strip(F.get_json_object(x, "$.description.en")), T.strip(F.get_json_object(x, "$.description.ro"))
        described = F.struct(en.alias("en"), F.when(F.coalesce(ro, F.lit("")) != "", ro).otherwise(en).alias("ro"))
        return F.struct(T.type_key(F.get_json_object(x, "$.type")).alias("type"), described.alias("description"), F.lit(True).alias("is_presented"))

    return F.filter(F.transform(objects, row), lambda s: s["type"].isNotNull() & (F.length(F.coalesce(s["description"]["en"], F.lit(""))) >= least))


def posts(df: DataFrame, raw: str = "raw") -> DataFrame:
    """(post_id, text) of the tweet entries in search replies; wrapped results are unwrapped, other entries and blank texts dropped, broken replies give nothing."""
    entries = F.from_json(F.get_json_object(raw, "$.data.search_by_raw_query.search_timeline.timeline.instructions"), "array<struct<entries:array<struct<entryId:string,content:string>>>>")
    each = df.select(F.explode(F.flatten(F.transform(entries, lambda i: F.coalesce(i["entries"], F.array().cast("array<struct<entryId:string,content:string>>"))))).alias("e")).where(F.col("e.entryId").startswith("tweet-"))
    result = F.get_json_object("e.content", "$.itemContent.tweet_results.result")
    plain = each.select(result.alias("r")).select(F.when(F.get_json_object("r", "$.__typename") == "Tweet", F.col("r")).otherwise(F.coalesce(F.get_json_object("r", "$.tweet"), F.col("r"))).alias("r"))
    field = lambda *paths: F.coalesce(*(F.when(F.get_json_object("r", p) != "", F.get_json_object("r", p)) for p in paths))
    found = plain.select(field("$.rest_id", "$.legacy.id_str").alias("post_id"), T.collapse(field("$.legacy.full_text", "$.legacy.text")).alias("text"))
    return found.where("post_id is not null and text <> ''")
