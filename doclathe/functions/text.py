"""Text rules of the document pipeline as Column functions. A null text gives null unless said otherwise.

Patterns are written so that Java and RE2 read them alike: white space is a class of its own (WS), `(?md)` lets only a line feed end a line, and
nothing looks around."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Unicode white space, as a regular-expression class body.
WS_CHARS = r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WS = f"[{WS_CHARS}]"
#: Breaks between lines, as text editors know them.
LINE_BREAK = r"\x{D}\x{A}|[\x{A}-\x{D}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
#: A character of a word, and what may stand before and after a whole word.
WORD = r"[\p{L}\p{N}_]"
BEFORE, AFTER = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
JSON_FIELD = rf'^"[a-z_]+":{WS}*("[^"]*"|[0-9-]+),?{WS}*\z'


def let(value: Column, f) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{WS}+|{WS}+\z", "")


def words(c: Column) -> Column:
    """Pieces between white space; an empty text has none."""
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def is_upper(c: Column) -> Column:
    """Has upper-case letters and no lower-case ones."""
    return c.rlike(r"\p{Lu}") & ~c.rlike(r"\p{Ll}")


def _chain(c: Column, steps: Sequence[tuple[str, str]]) -> Column:
    for pattern, to in steps:
        c = F.regexp_replace(c, pattern, to)
    return c


#: Steps of clean_text before characters are mapped: field prefixes, trailing quotes, escapes, heading marks, source lines, box drawing, rule-only lines.
CLEAN_STEPS = (
    (rf'(?m)^"[a-z_]+":{WS}*"?', ""),
    (r'(?m)",$', ""),
    (r"\\[nt]", " "),
    (r"\\r", ""),
    (rf"(?m)^#{{1,6}}{WS}+", ""),
    (rf"(?m)^Source:{WS}*https?://[^{WS_CHARS}]+", ""),
    (r"[\x{2500}-\x{259F}]+", ""),
    (rf"(?m)^[{WS_CHARS}\-–—_=~*#|]+$", ""),
    (r"\x{FFFD}", ""),
)
CLEAN_FROM, CLEAN_TO = " –—“”‘\t", " --\"\"' "


def _line_mode(pattern: str) -> str:
    return pattern.replace("(?m)", "(?md)")


def clean_text(c: Column) -> Column:
    """Extraction artefacts removed, quotes, dashes and blanks plain, ends trimmed."""
    c = _chain(c, [(_line_mode(p), to) for p, to in CLEAN_STEPS])
    return strip(F.regexp_replace(F.translate(c, CLEAN_FROM, CLEAN_TO), "  +", " "))


def normalize_text(c: Column) -> Column:
    """clean_text with a blank line after every line and sentence."""
    return strip(_chain(clean_text(c), [(r"\n+", "\n\n"), (rf"([.!?]){WS}+", "$1\n\n"), (r"\n{3,}", "\n\n")]))


def paragraphs(c: Column) -> Column:
    return F.filter(F.transform(F.split(normalize_text(c), "\n\n"), strip), lambda p: p != "")


def sentences(c: Column) -> Column:
    """Pieces that end with . ! or ? before white space."""
    return F.filter(F.transform(F.split(F.regexp_replace(c, rf"([.!?]){WS}+", "$1\x1d"), "\x1d"), strip), lambda s: s != "")


def finalise(c: Column) -> Column:
    """One line with single spaces."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"\n+", " "), "  +", " "))


def clean_section(c: Column) -> Column:
    """A section heading without marks and source prefix; a bare URL becomes its last path segment, or its host; null or nothing left is 'General'."""
    bare = strip(_chain(strip(c), [(rf"^#{{1,6}}{WS}+", ""), (rf"^Source:{WS}*https?://[^{WS_CHARS}]+", "")]))
    host = F.regexp_extract(bare, r"^https?://([^/?#]*)", 1)
    path = F.regexp_replace(F.regexp_extract(bare, r"^https?://[^/?#]*([^?#]*)", 1), r"/+\z", "")
    last = F.element_at(F.split(path, "/"), -1)
    named = F.when(bare.rlike(r"^https?://"), F.translate(F.when(last != "", last).otherwise(host), "-", " ")).otherwise(bare)
    return F.coalesce(F.when(named != "", named), F.lit("General"))


def is_json_artifact(c: Column) -> Column:
    return strip(c).rlike(JSON_FIELD)


def is_bullet(c: Column) -> Column:
    return c.rlike(rf"^([-•*]|[0-9]+\.|[a-zA-Z]\)){WS}+")


def heading_of(s: Column, w: Column) -> Column:
    """is_heading of a trimmed line and its words."""
    alpha = F.filter(w, lambda x: x.rlike(r"^\p{L}+\z"))
    title = (F.size(w) <= 10) & let(alpha, lambda a: (F.size(a) > 0) & F.forall(a, lambda x: x.rlike(r"^[\p{Lu}\p{Lt}]")))
    short = (F.length(s) < 100) & (is_upper(s) | s.endswith(":") | s.rlike(rf"^[0-9]+(\.[0-9]+)*\.{WS}+[A-Z]"))
    marked = s.rlike(rf"^#{{1,6}}{WS}+") | (s.endswith("?") & (F.length(s) < 120))
    return (s != "") & ~s.isin("{", "}", "[", "]") & ~s.rlike(JSON_FIELD) & (marked | short | title)


def is_heading(c: Column) -> Column:
    """A line that introduces what follows: marked, a question, in capitals, ending with a colon, numbered, or in title case."""
    return let(strip(c), lambda s: let(words(s), lambda w: heading_of(s, w)))


def fragment_of(s: Column) -> Column:
    return s.isin("{", "}", "[", "]") | s.rlike(r"^[)\]}\p{Ll}]") | s.rlike(JSON_FIELD)


def is_fragment(c: Column) -> Column:
    """A line broken off a sentence or structure."""
    return let(strip(c), fragment_of)


def is_truncated(c: Column) -> Column:
    """Ends within a word: nothing at all, or a last letter whose word is short and in lower case or ends with three consonants."""

    def of(s: Column) -> Column:
        last = F.regexp_extract(s, rf"([^{WS_CHARS}]+)\z", 1)
        cut = lambda w: ((F.length(w) <= 4) & w.rlike(r"\p{Ll}") & ~w.rlike(r"\p{Lu}")) | w.rlike(rf"[^aeiouAEIOU{WS_CHARS}]{{3}}\z")
        return (s == "") | (s.rlike(r"\p{L}\z") & let(last, cut))

    return let(strip(c), of)


def plain_clean(c: Column) -> Column:
    """Text of PDF and text files: a paragraph per full stop, ASCII only."""
    return strip(_chain(c, [(f"{WS}+", " "), (rf"\.{WS}+", ".\n\n"), (r"[^\x{0}-\x{7F}]+", " ")]))


def detect_headings(c: Column) -> Column:
    """Lines trimmed; short lines in capitals set off as level-2 headings."""
    mark = lambda s: F.when((F.length(s) < 80) & is_upper(s), F.concat(F.lit("\n## "), s, F.lit("\n"))).otherwise(s)
    return F.array_join(F.transform(F.transform(F.split(c, "\n"), strip), mark), "\n")


# Marks of lines without value, and of forms.
LOW_VALUE = "table of contents|list of tables|list of acronyms|acknowledgements|contents"


def _pdf_flags(t: Column, low: Column, n_words: Column) -> dict[str, Column]:
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern))
    spaces = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
    commas = F.length(t) - F.length(F.replace(t, F.lit(","), F.lit("")))
    return {
        "low_value": (low == "") | low.rlike(LOW_VALUE) | low.rlike(r"^[0-9]+\z") | low.rlike(rf"^[.\-{WS_CHARS}]{{10,}}\z") | ((F.length(low) < 40) & low.rlike(f"{BEFORE}(page|chapter|table|figure){AFTER}")),
        "toc": low.rlike(r"\.{3,}") | low.rlike(rf"^[0-9]+{WS}+[0-9]+(\.[0-9]+)*\.{WS}+"),
        "chart": low.rlike(f"{BEFORE}(0|10|20|30|40|50|60|70|80|90|100)%{WORD}") | (count(low, r"[0-9]+%") > 3),
        "numeric": (n_words == 0) | (count(t, r"[0-9]+[,.]?[0-9]*%?") > 0.4 * F.greatest(n_words, F.lit(1))),
        "repeated": (F.length(t) < 5) | low.rlike(rf"page{WS}*[0-9]+") | ((F.length(t) > 20) & (F.size(F.array_distinct(F.split(t, ""))) < 5)),
        "reference": ((n_words < 12) & t.rlike(f"{BEFORE}(19|20)[0-9]{{2}}[a-z]?{AFTER}")) | t.rlike(rf"^[A-Z][a-z]+,{WS}[A-Z]\.") | ((commas >= 2) & t.rlike("[0-9]{4}")),
        "ocr": t.rlike(f"{BEFORE}{WORD}{WS}{WORD}{WS}{WORD}{AFTER}") | (F.size(F.filter(F.split(t, r"[^\p{L}\p{N}_]+"), lambda w: w.rlike(r"^[a-zA-Z]\z"))) > 3) | ((F.length(t) > 20) & (spaces > 0.25 * F.length(t))),
        "form": low.contains("observations and/or suggestions") | low.contains("thank you") | low.rlike("_{3,}") | (low.contains("_") & (count(low, "[a-z]") < 5)),
    }


def pdf_line_flags(c: Column) -> dict[str, Column]:
    """The eight reasons to drop a line of a PDF."""
    t = strip(c)
    return _pdf_flags(t, F.lower(t), F.size(words(t)))


def _pdf_keep(t: Column) -> Column:
    """No flag of a trimmed line is set; later flags are looked at only if no earlier one is."""

    def of(v: Column) -> Column:
        drop = F.lit(False)
        for flag in _pdf_flags(v["t"], v["low"], v["n"]).values():
            drop = drop | flag
        return ~drop

    return let(F.struct(t.alias("t"), F.lower(t).alias("low"), F.size(words(t)).alias("n")), of)


def pdf_clean(c: Column) -> Column:
    """Text of a PDF without the lines that any flag drops."""
    flat = F.translate(F.regexp_replace(c, r"\x{FFFD}", ""), " –—", " --")
    flat = strip(F.regexp_replace(F.regexp_replace(flat, rf"({WORD}){WS}{{2,}}({WORD})", "$1 $2"), " +", " "))
    return F.array_join(F.filter(F.transform(F.split(flat, "\n"), strip), _pdf_keep), "\n")


def page_clean(c: Column, extracted: bool = False) -> Column:
    """Text of a web page: a line per sentence, short lines dropped (under 3 characters if extracted, else 20), the first of equal lines kept, headings set off."""
    least = 3 if extracted else 20
    split_ = F.split(_chain(c, [("\r", "\n"), (rf"([.!?]){WS}+", "$1\n\n")]), "\n")
    return detect_headings(F.array_join(F.array_distinct(F.filter(F.transform(split_, strip), lambda s: F.length(s) >= least)), "\n"))


def is_html(c: Column) -> Column:
    return F.coalesce(F.lower(c).rlike("<html|<body|<div|<a "), F.lit(False))


def is_json(c: Column) -> Column:
    s = strip(c)
    return F.coalesce((s.startswith("{") & s.endswith("}")) | (s.startswith("[") & s.endswith("]")), F.lit(False))


# Phrases by which pages say why they hold nothing, in the order they are tried.
FAILURES = (
    ("bot detection", ("are you a robot", "verify you are human", "captcha", "cloudflare", "ray id", "security check", "ddos protection", "access denied", "unusual traffic", "checking your browser")),
    ("paywall", ("subscribe to read", "sign in to continue", "members only", "login required", "subscription required", "unlock this article", "create an account")),
    ("page not found", ("page not found", "404 not found", "doesn't exist", "no longer available", "has been removed")),
)


def any_phrase(phrases: Sequence[str]) -> str:
    """One alternation of literal phrases."""
    quoted = ("".join("\\" + ch if ch in r"\.[]{}()*+?^$|" else ch for ch in p) for p in phrases)
    return "|".join(quoted)


def failure(html_: Column) -> Column:
    """Why a page gave no content; null counts as no response."""
    low = F.lower(F.coalesce(html_, F.lit("")))
    out = F.when(low == "", "no response")
    for name, phrases in FAILURES:
        out = out.when(low.rlike(any_phrase(phrases)), name)
    return out.when(F.length(low) < 1000, "near-empty response").otherwise("structure not recognised")


# Signs of a wall against robots, looked for at the start of a page.
BOT_SIGNS = (
    "verifies you are not a bot",
    "not a bot",
    "are you a robot",
    "performing security verification",
    "security verification",
    "security service to protect",
    "protect against malicious bots",
    "malicious bots",
    "while the website verifies",
    "checking your browser",
    "enable javascript and cookies",
    "browser security check",
    "ddos protection",
    "cloudflare ray id",
    "cf-browser-verification",
    "one more step",
    "_cf_chl",
    "ak_bmsc",
)
# Such signs of one kind of site, looked for in the whole page.
LEGAL_SITE_SIGNS = (
    "access denied",
    "unusual behaviour",
    "security check",
    "please enable cookies",
    "cf-error",
    "ray id",
    "verify you are human",
    "captcha",
    "403 forbidden",
)
# Marks of pages that scripts fill or unfold.
SCRIPT_SIGNS = (
    'aria-expanded="false"',
    'data-state="closed"',
    'data-state="inactive"',
    "<details",
    "window.__NEXT_DATA__",
    "window.__NUXT__",
    "__vue_app__",
    "ng-version",
    "data-reactroot",
    "svelte-announcer",
)
#: Characters below which a page is taken to need a browser, and below which an extracted text is too thin.
LEAST_HTML, LEAST_TEXT = 5000, 200


def is_bot_wall(html_: Column, signs: Sequence[str] = BOT_SIGNS, within: int | None = 5000) -> Column:
    """Any sign stands in the first characters, or with None in the whole of a page, case aside; null is no wall."""
    part = html_ if within is None else F.substring(html_, 1, within)
    return F.coalesce(F.lower(part).rlike(any_phrase(signs)), F.lit(False))


def needs_browser(html_: Column, least: int = LEAST_HTML, signs: Sequence[str] = SCRIPT_SIGNS) -> Column:
    """A page that is short or that scripts fill; null needs one."""
    return F.coalesce((F.length(html_) < least) | html_.rlike(any_phrase(signs)), F.lit(True))


def scrape_cascade(static_html: Column, static_text: Column, browser_html: Column, browser_text: Column, least_html: int = LEAST_HTML, least_text: int = LEAST_TEXT, signs: Sequence[str] = BOT_SIGNS) -> Column:
    """(via, text, html) of a page fetched plainly and, where that isn't enough, by a browser: static if there is no bot wall, no need for a browser and
    text enough; else browser under the same tests of wall and text; else failed, with no text and the html of the last fetch that gave any."""
    enough = lambda h, t: h.isNotNull() & ~is_bot_wall(h, signs) & (F.length(F.coalesce(t, F.lit(""))) >= least_text)
    out = lambda via, t, h: F.struct(F.lit(via).alias("via"), t.alias("text"), F.coalesce(h, F.lit("")).alias("html"))
    walled = F.when(is_bot_wall(browser_html, signs), browser_html).otherwise(static_html)
    first = F.when((F.coalesce(static_html, F.lit("")) != "") & ~needs_browser(static_html, least_html) & enough(static_html, static_text), out("static", static_text, static_html))
    return first.when((F.coalesce(browser_html, F.lit("")) != "") & enough(browser_html, browser_text), out("browser", browser_text, browser_html)).otherwise(out("failed", F.lit(""), walled))


def language(c: Column) -> Column:
    """A rough guess: es or pt by a few common words, else en; unknown for nothing."""
    low = F.lower(c)
    spanish = low.rlike(" el | la | los | una |servicios ")
    portuguese = low.rlike(" o | de | para |serviços ")
    return F.when(F.coalesce(c, F.lit("")) == "", "unknown").when(spanish, "es").when(portuguese, "pt").otherwise("en")


def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else html.unescape(x))


def decode_text(c: Column) -> Column:
    r"""Escapes of < > & as six characters, and HTML entities, become the characters. Only texts with an ampersand cross to Python."""
    c = F.replace(F.replace(F.replace(c, F.lit("\\u003c"), F.lit("<")), F.lit("\\u003e"), F.lit(">")), F.lit("\\u0026"), F.lit("&"))
    return F.coalesce(F.pandas_udf(_unescape, StringType())(F.when(c.contains("&"), c)), c)


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, f"{WS}+", " "))


def classify(c: Column, rules: Sequence[tuple[Sequence[str], str]], default: str) -> Column:
    """The label of the first rule of which any keyword stands in the text as a whole word; null texts get the default."""
    low = F.lower(c)
    out = None
    for keywords, label in rules:
        hit = low.rlike(f"{BEFORE}({any_phrase(keywords)}){AFTER}")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)


# Subjects of posts by keyword; the first that fits counts.
TRAVEL_RULES = (
    (("complaint", "discrimination", "refused", "denied", "ignored"), "Discrimination & Complaints"),
    (("regulation", "rule", "law", "acaa", "dot rule", "policy", "cfr"), "Regulatory Reference"),
    (("tip", "advice", "recommend", "suggest", "guide", "how to"), "Passenger Tips & Advice"),
    (("wheelchair", "mobility aid", "power chair", "rollator"), "Passenger Mobility Feedback"),
    (("damage", "broken", "destroyed", "lost", "crack", "bent", "scooter"), "Equipment Damage"),
    (("gate", "boarding", "jetbridge", "aisle", "deplaning", "ramp"), "Boarding & Deplaning"),
    (("staff", "crew", "agent", "attendant", "helped"), "Staff Assistance Feedback"),
    (("delay", "late", "wait", "waiting", "hours", "stranded"), "Passenger Assistance Delays"),
)
GENERAL_RULES = (
    (("complaint", "discrimination", "refused", "denied"), "Complaints"),
    (("regulation", "law", "policy", "rule"), "Regulatory Reference"),
    (("tip", "advice", "recommend", "guide"), "Tips & Advice"),
    (("wheelchair", "mobility", "disabled"), "Mobility Feedback"),
    (("damage", "broken", "lost"), "Equipment Damage"),
    (("staff", "helped", "assisted"), "Staff Feedback"),
    (("delay", "wait", "stranded"), "Assistance Delays"),
)
DEFAULT_LABEL = "General Accessibility Feedback"


def content_hash(title: Column, description: Column) -> Column:
    """SHA-256 of title and description, trimmed and in lower case; null equals empty."""
    part = lambda c: F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.sha2(F.concat(part(title), F.lit("||"), part(description)), 256)


def domain(c: Column) -> Column:
    """The third field between slashes of a URL, or the whole source name."""
    return F.when(c.contains("://"), F.split_part(c, F.lit("/"), F.lit(3))).otherwise(c)


def path_part(c: Column, n: int) -> Column:
    """The n-th part of a URL's path, '' if there is none."""
    path = F.regexp_extract(c, r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.get(F.filter(F.split(path, "/"), lambda p: p != ""), F.lit(n - 1)), F.lit(""))


def last_segment_title(c: Column) -> Column:
    """The last path segment as a title, without its extension."""
    path = F.regexp_extract(c, r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    last = F.element_at(F.split(F.regexp_replace(path, r"/+\z", ""), "/"), -1)
    return F.initcap(F.regexp_replace(F.regexp_replace(last, r"\.[a-z]+\z", ""), "[-_]+", " "))


def query_value(c: Column, name: str) -> Column:
    """The value of a parameter of a URL's query, percent signs decoded; null if it isn't there."""
    return F.try_url_decode(F.try_parse_url(c, F.lit("QUERY"), F.lit(name)))


def celex(c: Column) -> Column:
    """The identifier after CELEX: in the parameters uri or from of a legal site's URL; '' if there is none."""
    of = lambda name: F.when(F.upper(query_value(c, name)).startswith("CELEX:"), F.regexp_replace(query_value(c, name), "^[^:]*:", ""))
    return F.coalesce(of("uri"), of("from"), F.lit(""))


def url_section(c: Column) -> Column:
    """A name for a page: its CELEX identifier, or its last path segment with blanks for hyphens, as a title."""
    path = F.regexp_replace(F.regexp_extract(c, r"^[a-z]+://[^/?#]*([^?#]*)", 1), r"/+\z", "")
    last = F.element_at(F.split(path, "/"), -1)
    return F.when(celex(c) != "", F.concat(F.lit("CELEX:"), celex(c))).otherwise(F.initcap(F.replace(last, F.lit("-"), F.lit(" "))))


def market(c: Column) -> Column:
    """(market, locale): the first two parts of a URL's path."""
    return F.struct(path_part(c, 1).alias("market"), path_part(c, 2).alias("locale"))


def slug_id(c: Column) -> Column:
    """The id before the first hyphen of a slug."""
    return F.substring_index(c, "-", 1)


def label(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def name_key(c: Column) -> Column:
    return F.lower(strip(c))


def type_key(c: Column) -> Column:
    """A service type in snake case; null if nothing is left."""
    t = F.replace(F.lower(strip(c)), F.lit(" "), F.lit("_"))
    return F.when(t != "", t)
