"""The quality gate for page texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from doclathe.functions.text import LINE_BREAK, any_phrase, let, strip, words

# Phrases of pages that hold no content, looked for in the first 1000 characters, in the order they are tried.
PHRASES = (
    ("soft_404", ("page not found", "404 not found", "404 error", "doesn't exist", "does not exist", "no longer available", "has been removed", "has been deleted", "we couldn't find", "we could not find", "nothing found", "oops! that page", "oops, that page", "the page you requested", "the page you are looking for", "the requested page", "this page is gone")),
    ("paywall", ("sign in to continue", "log in to continue", "subscribe to read", "subscribe to continue", "subscription required", "create an account to", "create a free account", "members only", "member only", "login required", "please log in", "please sign in", "unlock this article", "unlock full access", "start your free trial", "this content is for subscribers", "already a subscriber", "get full access")),
    ("captcha", ("are you a robot", "are you human", "verify you are human", "verify you're human", "verifies you are not a bot", "not a bot", "complete the captcha", "please verify", "one more step", "security verification", "security service to protect", "protect against malicious bots", "malicious bots", "performing security verification", "security check", "bot protection", "ddos protection", "checking your browser", "cloudflare ray id", "enable javascript and cookies", "browser security check", "while the website verifies")),
    ("maintenance", ("maintenance mode", "under maintenance", "be right back", "temporarily unavailable", "down for maintenance", "under construction", "scheduled maintenance", "site is currently unavailable", "coming soon")),
    ("access_denied", ("access denied", "403 forbidden", "you don't have permission", "you do not have permission", "not authorized", "unauthorised", "unauthorized", "restricted content", "this content is restricted")),
)
LEAST, SAMPLE = 150, 1000


def is_structural(c: Column) -> Column:
    """A line of separators only."""
    return c.rlike(r"^[|/\-_=+*•·\s]+\z")


def lines(c: Column) -> Column:
    """Trimmed lines that are neither blank nor structural."""
    return F.filter(F.transform(F.split(strip(c), LINE_BREAK), strip), lambda s: (s != "") & ~is_structural(s))


def share_of_short(every: Column) -> Column:
    """Share of an array of lines with at most two words; null without lines."""
    return F.size(F.filter(every, lambda s: F.size(words(s)) <= 2)) / F.nullif(F.size(every), F.lit(0))


def most_frequent(every: Column) -> Column:
    """How often the most frequent line of an array stands. Sorting puts equal lines together, so one fold counts them."""
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(a: Column, s: Column) -> Column:
        run = F.when(a["last"].eqNullSafe(s), a["run"] + 1).otherwise(1)
        return let(run, lambda r: F.struct(s.alias("last"), r.alias("run"), F.greatest(a["most"], r).alias("most")))

    return F.aggregate(F.array_sort(every), start, step, lambda a: a["most"])


def short_share(c: Column) -> Column:
    return let(lines(c), share_of_short)


def top_count(c: Column) -> Column:
    return let(lines(c), most_frequent)


def first_phrase(sample: Column, phrases: tuple[str, ...]) -> Column:
    """The first phrase of the list that the sample holds."""
    return F.get(F.filter(F.array(*map(F.lit, phrases)), lambda p: F.contains(sample, p)), F.lit(0))


def _line_check(every: Column) -> Column:
    n = F.size(every)
    return F.when((n > 15) & (share_of_short(every) > 0.75), "noise_ratio").when((n > 10) & (most_frequent(every) > 5), "repetition").otherwise("ok")


def reason(c: Column) -> Column:
    """'ok', or the first failed check: empty, too_short, a class of PHRASES, noise_ratio, repetition. Null counts as empty.

    Cheap checks come first; CASE evaluates the line statistics only for texts that pass them, and lines are split once."""

    def of(s: Column) -> Column:
        sample = F.lower(F.substring(s, 1, SAMPLE))
        out = F.when(s == "", "empty").when(F.length(s) < LEAST, "too_short")
        for name, phrases in PHRASES:
            out = out.when(sample.rlike(any_phrase(phrases)), name)
        return out.otherwise(let(lines(s), _line_check))

    return let(strip(F.coalesce(c, F.lit(""))), of)


def detail(c: Column) -> Column:
    """What the failed check found: a length, the first phrase, a share or a count; null where all is well or nothing is there."""

    def of(v: Column) -> Column:
        s, why = v["s"], v["why"]
        sample = F.lower(F.substring(s, 1, SAMPLE))
        out = F.when(why == "too_short", F.length(s).cast("string"))
        for name, phrases in PHRASES:
            out = out.when(why == name, first_phrase(sample, phrases))
        return out.when(why == "noise_ratio", F.format_number(100 * short_share(s), 0)).when(why == "repetition", top_count(s).cast("string"))

    return let(F.struct(strip(F.coalesce(c, F.lit(""))).alias("s"), reason(c).alias("why")), of)
