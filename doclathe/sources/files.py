"""Files of documents and of chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doclathe.functions import text as T
from doclathe.operators.validation import summary

CHUNK_SCHEMA = "id string, parent_id string, section string, text string, sent boolean, source string, source_id string, type string, entity string, entity_type string"


def local_documents(spark: SparkSession, folder: str, glob: str = "*.{pdf,txt,html,json}") -> DataFrame:
    """(path, kind, text, problem) of the files in a folder and below. Texts are UTF-8, or else Latin-1; PDF and unknown kinds have a problem instead
    of a text, so that one file doesn't end the job (a PDF reader is not part of Spark)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    decoded = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string")).otherwise(F.decode("content", "ISO-8859-1"))
    pdf = F.col("content").startswith(F.lit(b"%PDF"))
    suffix = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    kind = F.when(pdf, "pdf").otherwise(suffix)
    text = F.when(F.col("kind") == "txt", T.detect_headings(T.plain_clean(decoded))).when(F.col("kind").isin("html", "json"), decoded)
    rows = files.select("path", "content", kind.alias("kind"))
    return rows.orderBy("path").select("path", "kind", text.alias("text"), F.when(F.col("kind") == "pdf", "needs a PDF reader").when(~F.col("kind").isin("txt", "html", "json"), "unknown kind").alias("problem"))


def file_hashes(spark: SparkSession, folder: str, glob: str = "*.json") -> DataFrame:
    """(source, content_hash) of the files in a folder: the name without extension, and SHA-256 of the bytes. Partial files are left out."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    name = F.regexp_extract("path", r"([^/]+)\.[A-Za-z0-9]+$", 1)
    return found.select(name.alias("source"), F.sha2("content", 256).alias("content_hash")).where(~F.col("source").endswith("_partial"))


def pdf_lines(words: DataFrame, per: list[str], x: str = "x0", top: str = "top", word: str = "word") -> DataFrame:
    """(per, line_no, line): words of a PDF page put into lines by their rounded height, and in reading order."""
    rows = words.groupBy(*per, F.round(F.col(top), 1).alias("y")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(x, word))), lambda s: s[word]), " ").alias("line"))
    from pyspark.sql import Window as W

    return rows.withColumn("line_no", F.row_number().over(W.partitionBy(*per).orderBy("y")) - 1).drop("y")


def longer(primary, fallback, least: int = 500):
    """The primary text, unless it is short and the fallback longer."""
    return F.when((F.length(primary) < least) & (F.length(fallback) > F.length(primary)), fallback).otherwise(F.coalesce(primary, fallback))


def chunk_files(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks of JSON array files, one per source, with file; partial files and files that can't be read are left out."""
    rows = spark.read.schema(CHUNK_SCHEMA).option("multiLine", True).option("mode", "DROPMALFORMED").option("pathGlobFilter", "*.json").json(folder)
    return rows.withColumn("file", F.col("_metadata.file_name")).where(~F.col("file").endswith("_partial.json"))


def write_chunks(chunks: DataFrame, folder: str) -> None:
    """One folder per source. Rows are spread within a source by a hash too, so that a large source is written by many tasks."""
    chunks.repartition("source_id", F.pmod(F.xxhash64("id"), F.lit(16))).write.mode("overwrite").partitionBy("source_id").json(folder)


def json_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, value) of the JSON files of a folder in order of their names: the text of each, null where it is no JSON. A missing folder has no rows."""
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder)
    except AnalysisException:
        return spark.createDataFrame([], "file string, value string")
    text = F.col("content").cast("string")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return found.select(name.alias("file"), F.when(F.try_parse_json(text).isNotNull(), text).alias("value")).orderBy("file")


def file_count(spark: SparkSession, folder: str, glob: str = "*.json") -> int:
    """How many files of a folder fit a pattern; 0 if there is no folder."""
    try:
        return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path").count()
    except AnalysisException:
        return 0


def write_combined(entities: DataFrame, folder: str) -> None:
    """All entities as JSON lines in one folder, in order of source; large ones in many files, since one file of everything is one task."""
    entities.repartitionByRange("source_id").sortWithinPartitions("source_id").write.mode("overwrite").json(folder)


def write_report(issues: DataFrame, clean: DataFrame, folder: str) -> None:
    """The validation report: every issue, the counts per check, and the entities that passed, each a folder below."""
    issues.write.mode("overwrite").json(f"{folder}/issues")
    summary(issues).coalesce(1).write.mode("overwrite").json(f"{folder}/summary")
    clean.write.mode("overwrite").json(f"{folder}/clean")


class ResultCache:
    """Results per source and the hashes they were made from. Each write is a new generation; the manifest is written last, so readers see whole ones."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder, schema

    def generation(self) -> int:
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return 0
        done = [s.getPath().getName() for s in fs.listStatus(root) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "manifest/_SUCCESS"))]
        return max((int(n[1:]) for n in done if n[0] == "g"), default=0)

    def read(self) -> tuple[DataFrame, DataFrame]:
        """(results, manifest) of the last whole generation; both empty at first."""
        n = self.generation()
        if not n:
            return self.spark.createDataFrame([], self.schema), self.spark.createDataFrame([], "source string, content_hash string")
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/g{n}/results"), self.spark.read.schema("source string, content_hash string").parquet(f"{self.folder}/g{n}/manifest")

    def write(self, results: DataFrame, manifest: DataFrame) -> None:
        n = self.generation() + 1
        results.write.mode("overwrite").parquet(f"{self.folder}/g{n}/results")
        manifest.select("source", "content_hash").write.mode("overwrite").parquet(f"{self.folder}/g{n}/manifest")


def extract_pdf(df: DataFrame, key: str, content: str, primary: Callable[[bytes], str], ocr: Callable[[bytes], str] | None = None, least: int = 500) -> DataFrame:
    """(key, text, problem) of PDF bytes by an extractor given as a function; where its text is shorter than `least`, that of `ocr` if longer. An extractor
    that raises gives a problem instead of ending the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, problems = [], []
            for b in batch.column(1).to_pylist():
                try:
                    text = primary(b) if b is not None else None
                    again = ocr(b) if ocr and text is not None and len(text) < least else ""
                    texts.append(again if text is not None and len(again) > len(text) else text)
                    problems.append(None)
                except Exception as e:  # whatever an extractor raises is this file's problem
                    texts.append(None)
                    problems.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(problems, pa.string())], names=[key, "text", "problem"])

    return df.select(key, content).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, text string, problem string")


def is_pdf(content: Column, content_type: Column) -> Column:
    """By what the server says or by the first bytes."""
    return F.coalesce(F.contains(F.lower(content_type), F.lit("application/pdf")), F.lit(False)) | F.coalesce(content.startswith(F.lit(b"%PDF")), F.lit(False))


def fetch(urls: DataFrame, get: Callable[[str], tuple[int, str]], url: str = "url") -> DataFrame:
    """urls with html: what a fetcher given as a function returns for status 200, else null with the status or error as problem."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema)
    at = urls.columns.index(url)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, problems = [], []
            for u in batch.column(at).to_pylist():
                try:
                    status, html = get(u) if u is not None else (0, None)
                except Exception as e:  # a page that can't be had is no reason to end
                    status, html = f"{type(e).__name__}: {e}", None
                pages.append(html if status == 200 else None)
                problems.append(None if status == 200 else str(status))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pages, pa.string()), pa.array(problems, pa.string())], names=[*batch.schema.names, "html", "problem"])

    return urls.mapInArrow(run, f"{fields}, html string, problem string")
