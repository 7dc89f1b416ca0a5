"""A Spark data source for paged interfaces: each partition is one starting address, followed by its next_page until there is none."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from doclathe.operators.htmlops import page_plain
from doclathe.operators.records import keep_first


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, fetch: Callable[[str], str]):
        self.urls, self.key, self.fetch = json.loads(options["urls"]), options.get("key", "articles"), fetch

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(u) for u in self.urls]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        url, seen = partition.value, set()
        while url and url not in seen:
            seen.add(url)
            page = json.loads(self.fetch(url))
            for item in page.get(self.key) or []:
                yield partition.value, json.dumps(item, ensure_ascii=False)
            url = page.get("next_page")


def paged_source(name: str, fetch: Callable[[str], str]) -> type[DataSource]:
    """A data source class to register: spark.dataSource.register(paged_source("help_centre", fetch)). fetch gets an address and returns JSON text."""

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "start string, item string"

        def reader(self, schema) -> DataSourceReader:
            return PagedReader(self.options, fetch)

    return Paged


def resource_kind(path: str) -> tuple[str, str]:
    """(kind, id) of a help-centre path like /hc/en/sections/123-name; other paths raise ValueError."""
    parts = [p for p in path.split("/") if p]
    if len(parts) < 4 or parts[2] not in ("categories", "sections", "articles"):
        raise ValueError(f"no resource of a help centre: {path}")
    return parts[2], parts[3].split("-")[0]


def articles_of(urls: DataFrame, sections: DataFrame, articles: DataFrame, url: str = "url") -> DataFrame:
    """(url, article columns): the articles that help-centre URLs stand for: those of all sections of a category, those of a section, or the one named.

    sections: id, category_id. articles: id, section_id and more. URLs of another kind have no rows here; see unresolved()."""
    named = urls.select(url, F.regexp_extract(url, r"^(?:[a-z]+://[^/]+)?/hc/[^/]+/([^/?#]+)/", 1).alias("__kind"), F.regexp_extract(url, r"^(?:[a-z]+://[^/]+)?/hc/[^/]+/[^/]+/([0-9]+)", 1).cast("long").alias("__id"))
    of = named.where("__kind = 'categories'").join(sections.select(F.col("id").alias("section_id"), F.col("category_id").alias("__id")), "__id").select(url, "section_id")
    of = of.unionByName(named.where("__kind = 'sections'").select(url, F.col("__id").alias("section_id")))
    rest = [c for c in articles.columns if c not in ("section_id", url)]
    by_section = of.join(articles, "section_id").select(url, "section_id", *(articles[c] for c in rest))
    single = named.where("__kind = 'articles'").select(url, F.col("__id").alias("id")).join(articles, "id").select(url, "section_id", *(F.col(c) for c in rest))
    return by_section.unionByName(single)


def unresolved(urls: DataFrame, url: str = "url") -> DataFrame:
    """(url, problem) of the URLs that name no category, section or article."""
    kind = F.regexp_extract(url, r"^(?:[a-z]+://[^/]+)?/hc/[^/]+/([^/?#]+)/[0-9]+", 1)
    return urls.where(~kind.isin("categories", "sections", "articles") | F.col(url).isNull()).select(url, F.lit("no resource of a help centre").alias("problem"))


def normalise_articles(articles: DataFrame) -> DataFrame:
    """(id, title, url, section_id, locale, body, created_at, updated_at): html_url renamed, body as text, missing texts ''. Ids must be unique."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias("url" if c == "html_url" else c)
    bodies = page_plain(articles.select("id", "body"), "id", "body").withColumnRenamed("text", "__body")
    return articles.join(bodies, "id", "left").select("id", text("title"), text("html_url"), "section_id", text("locale"), F.col("__body").alias("body"), text("created_at"), text("updated_at"))


def tagged(posts: DataFrame, tags: Sequence[str], text: str = "text", key: str = "post_id", order: str = "post_id", per_tag: int | None = None) -> DataFrame:
    """(tag, posts' columns): the posts found by each tag, case aside, the first `per_tag` of each by order if given; a text that several tags or posts share
    is given out once, for the first tag and then the first post."""
    listed = F.array(*(F.struct(F.lit(i).alias("no"), F.lit(t).alias("tag")) for i, t in enumerate(tags)))
    hits = posts.withColumn("__hit", F.explode(F.filter(listed, lambda x: F.contains(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lower(x["tag"])))))
    if per_tag is not None:
        hits = hits.withColumn("__n", F.row_number().over(W.partitionBy("__hit.no").orderBy(order, key))).where(F.col("__n") <= per_tag).drop("__n")
    rows = hits.withColumn("__no", F.col("__hit.no"))
    first = keep_first(rows, [F.sha2(F.coalesce(text, F.lit("")), 256)], ["__no", order, key])
    return first.select(F.col("__hit.tag").alias("tag"), *posts.columns)
