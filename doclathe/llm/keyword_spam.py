"""Pages of repeated keywords, links and tags: shares of words, pairs of words, lines, links, separators and function words per segment, with thresholds calibrated per language."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclathe.runtime import materialize, spread

# Common function words of the languages that can be told apart.
FUNCTION_WORDS = {
    "en": "a an the and or but if of to in on at by for from with without as is are was were be been must may can cannot should will would have has not no that this these those it its they their them we our you your who which when where what how than then also only each any before after until within so do does",
    "ro": "și sau dar dacă de la în pe cu fără pentru din prin ca este sunt fi poate trebuie nu o un al ai ale lor lui îi îl puteți aveți care când unde ce cum după înainte până iar chiar cel cea cei spre a este se să",
    "de": "der die das den dem des ein eine einen und oder aber wenn von zu zur zum in im am an auf mit ohne für aus bei nach vor bis als ist sind wird werden muss kann können soll haben hat nicht kein auch sich sie ihre wir wer wie wo mehr jedoch sofern",
    "es": "el la los las un una y o pero si de del a al en con sin por para que es son debe deben puede pueden no se su sus lo le cuando donde como más desde hasta entre antes hay tras quien quienes",
}
#: A word is heavy in a text if it stands there at least so often, and makes up at least this share of its words.
HEAVY_COUNT, HEAVY_SHARE = 4, 0.03
#: A word, pair of words or line that stands in a text so often is repeated.
OFTEN = 3
#: A segment is spam if this share of it is links or tags.
LINKS = 0.3
#: It also is if its heavy words exceed what is usual in its language (the upper quartile of the language's segments of WORDS words or more) by this
#: share of its words; or if function words are missing and the repeated words, repeated pairs of words or separators do so, or it is a repeated line.
ABOVE = {"heavy": 0.4, "repeated": 0.2, "pairs": 0.3, "separators": 0.4}
#: No share above this is usual, however much of a language's text is spam.
MOST = 0.65
#: Function words are missing below this part of their usual share. A language whose usual share is under KNOWN isn't known; texts without any function
#: word in Latin letters are measured by the strictest of the known languages.
MISSING, WORDS, KNOWN = 0.27, 8, 0.1
#: A list has at least so many words between separators; in a text without any function word a run has at least that many words; neither holds more numbers than TABLE.
LIST, RUN, TABLE = 12, 30, 0.1
#: Segments mostly of numbers are tables of times and phones.
NUMBERS = 0.5
#: Texts with fewer characters in their segments are too short to judge.
LEAST = 150

_SETS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}
_url = re.compile(r"(?:https?://|www\.)\S+")
_word = re.compile(r"[^\W_]+")
_tag = re.compile(r"#\w+")
_end = re.compile(r"(?<=[.!?])\s+")
_separator = re.compile(r"[,;/•·]")
_foreign = re.compile(r"[^\W\d_a-zà-ɏ]")

#: Shares of a segment, in thousandths.
SHARES = ("links", "function", "repeated", "heavy", "pairs", "separators", "numbers")
_SEGMENT = pa.struct([("size", pa.int32()), ("words", pa.int32()), ("copies", pa.int32()), *((c, pa.int16()) for c in SHARES)])


def _share(n: int, of: int) -> int:
    return min(9999, round(1000 * n / of)) if of else 0


def segments(text: str) -> tuple[str, list[dict]]:
    """The text's language by function words, and for each sentence or line its size and shares. Without any function word the language is '' in Latin
    letters and ? in others."""
    low = text.lower()
    parts, total = [], 0
    count: Counter[str] = Counter()
    pairs: Counter[tuple[str, str]] = Counter()
    for line in low.split("\n"):
        for s in _end.split(line) if "." in line or "!" in line or "?" in line else (line,):
            if not s or s.isspace():
                continue
            rest, linked = s, 0
            if "http" in s or "www." in s:
                linked, rest = sum(map(len, _url.findall(s))), _url.sub(" ", s)
            if "#" in rest:
                linked += sum(map(len, _tag.findall(rest)))
            found = _word.findall(rest)
            plain = [w for w in found if not w.isdigit()]
            count.update(plain)
            pairs.update(zip(plain, plain[1:]))
            total += len(found)
            parts.append((s, linked, len(found), plain, len(_separator.findall(rest))))
    hits = {k: sum(count[w] for w in count.keys() & v) for k, v in _SETS.items()}
    lang = max(hits, key=hits.get)
    known, least = _SETS[lang], max(HEAVY_COUNT, HEAVY_SHARE * total)
    copies = Counter(tuple(p[3]) for p in parts)
    out = []
    for s, linked, found, plain, separators in parts:
        n = len(plain)
        content = [count[w] for w in plain if w not in known]
        often = sum(pairs[p] >= OFTEN for p in zip(plain, plain[1:]))
        out.append(
            {
                "size": len(s), "words": n, "copies": copies[tuple(plain)], "links": _share(linked, len(s)), "function": _share(n - len(content), n), "repeated": _share(sum(c >= OFTEN for c in content), n),
                "heavy": _share(sum(c >= least for c in content), n), "pairs": _share(often, n - 1), "separators": _share(separators, n), "numbers": _share(found - n, found),
            }
        )
    return lang if hits[lang] else "?" if len(_foreign.findall(low)) * 2 > sum(map(len, count.elements())) else "", out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [segments(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.list_(_SEGMENT))], names=["doc", "lang", "segments"])


def spam_shares(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang, share): the part of each text, by length, that is repeated keywords, links or tags. Texts that are null or hold fewer than
    LEAST characters of segments have no row. The thresholds of each language come from all its texts (the language is read off the text, not a
    column); where a language's function words aren't known, only links, tags and heavy words count. Equal texts get equal shares; nothing is
    compared between documents but the quartiles of each language (six rows at most). Extra columns are never read."""
    rows = df.select(F.col(key).alias("doc"), F.col(text).alias("text")).where(F.length("text") >= LEAST)
    rows = spread(rows)
    kind = df.schema[key].dataType.simpleString()
    parts = ",".join(["size:int", "words:int", "copies:int", *(f"{c}:smallint" for c in SHARES)])
    measured = materialize(rows.mapInArrow(_measure, f"doc {kind}, lang string, segments array<struct<{parts}>>"))
    quartiles = [F.percentile_approx(F.col("s")[c], 0.75, 1000).cast("double").alias(c) for c in ("function", *ABOVE)]
    usual = measured.select("lang", F.explode("segments").alias("s")).where(F.col("s.words") >= WORDS).groupBy("lang").agg(*quartiles)
    usual = usual.withColumn("known", (F.col("function") >= 1000 * KNOWN) & ~F.col("lang").isin("", "?")).select(
        "lang", "known", (MISSING * F.col("function")).alias("least"), *(F.least(F.col(c) + 1000 * above, F.lit(1000 * MOST)).alias(f"most_{c}") for c, above in ABOVE.items())
    )
    strict = usual.where("known").agg(F.min("least").alias("least"), *(F.max(f"most_{c}").alias(f"most_{c}") for c in ABOVE)).withColumn("lang", F.lit(""))
    strict = strict.select("lang", F.lit(True).alias("known"), F.coalesce("least", F.lit(1000 * KNOWN * MISSING)).alias("least"), *(F.coalesce(f"most_{c}", F.lit(1000.0 * above)).alias(f"most_{c}") for c, above in ABOVE.items()))
    usual = materialize(usual.where("lang <> ''").unionByName(strict))
    joined = measured.join(F.broadcast(usual), "lang", "left")
    most = lambda c: F.coalesce(f"most_{c}", F.lit(1000.0 * ABOVE[c]))

    def spam(s: Column) -> Column:
        missing = F.coalesce("known", F.lit(False)) & (s["function"] < F.col("least"))
        items = (s["words"] >= LIST) & (s["numbers"] <= 1000 * TABLE) & (s["separators"] >= most("separators"))
        run = (F.col("lang") == "") & (s["words"] >= RUN) & (s["numbers"] <= 1000 * TABLE) & (s["function"] == 0)
        strung = (s["repeated"] >= most("repeated")) | (s["pairs"] >= most("pairs")) | (s["copies"] >= OFTEN) | items | run
        return (s["links"] >= 1000 * LINKS) | ((s["words"] > 0) & (s["numbers"] <= 1000 * NUMBERS) & ((s["heavy"] >= most("heavy")) | (missing & strung)))

    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda n, s: n + s["size"])
    sized = joined.select("doc", "lang", total(F.col("segments")).alias("total"), total(F.filter("segments", spam)).alias("spam"))
    return sized.where(F.col("total") >= LEAST).select(F.col("doc").alias(key), "lang", (F.col("spam") / F.col("total")).alias("share"))
