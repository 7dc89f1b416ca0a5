"""Labels and features of the lines of web pages."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

BODY, CHROME, BOX = 0, 1, 2

# Words that web pages use for navigation, in the languages at hand.
MENU = frozenset(
    """home|menu|open menu|close|search|search this site|login|log in|register|sign in|sign up|help|faq|press|careers|jobs|investors|tenders|corporate|business|groups|fleet|cargo|loyalty|seats|apps|gift cards|destinations|departures|arrivals|flight status|my trips|check-in|book|booking|buchen|reservas|reservar|rezervări|gepäck|bagaje|baggage|equipaje|offers|angebote|oferte|ofertas|lounges|parking|shops and food|travel classes|special care|accessible travel|about us|contact|contact us|kontakt|contacto|news|blog|sitemap|imprint|privacy|terms of use|accessibility statement|cookies|shop|services|support|start|inicio|acasă|startseite|suche|buscar|caută|über uns|sobre nosotros|despre noi|english|română|deutsch|español""".split("|")
)
# Whole lines around the body of web pages.
AROUND = (
    r"(?:skip|jump) to (?:the )?(?:main |page )?(?:content|navigation|search|footer)|open menu|close|loading\W*|search(?: this site)?|select (?:currency|language)|language\W.*|chat with us|back to top|print this page|print|accept all|reject all|manage (?:choices|cookies)|alle akzeptieren|aceptar todo|acceptă tot|cookie settings|strictly necessary\b.*|statistics and marketing partners\b.*|advertisement|anzeige|publicidad|publicitate",
    r"(?:sitemap|site map|imprint|impressum(?: und datenschutz)?|datenschutz|aviso legal|privacy policy|privacy|terms (?:and|&) conditions|terms of (?:use|service)|termeni și condiții|política de privacidad|legal notice|follow us|payment methods\b.*|download our app\b.*|customer service\b.*|choose your (?:country|language)\b.*)",
    r"(?:share|share on .{1,30}|share (?:this page|or print).*|seite teilen.*|was this (?:page )?helpful\b.*|subscribe to (?:our|the) newsletter.*|sign up for (?:our|the) .*newsletter.*|enter your e-?mail address\b.*|log ?in to see\b.*|facepage\b.*|(?:\w+  ){2,}\w+)",
    r"(?:©|\(c\)|copyright\b).*|all rights reserved\b.*|.{1,60} is a member of the .{1,40} alliance\b.*|.*\| ?(?:imprint|privacy|terms of use)\b.*",
    r"(?:we|this (?:web)?site|our (?:web)?site) (?:uses? .{0,40}cookies|and \d+ partners|stores? (?:small )?files)\b.*|.*\b(?:our|the) use of cookies\b.*|you can withdraw your consent\b.*|your privacy matters\b.*|.*\bverwenden cookies\b.*|.*\bfolosește (?:module )?cookie.*|.*\bmodule cookie\b.*|usamos cookies\b.*|utilizamos cookies\b.*|.*\bcookies propias\b.*",
    r".*\bup to \d+ ?% off\b.*|.*\b(?:deals|fares|offers) from .{1,60}:.*|.*\bfrom only \d+.*",
)
# Headings of boxes beside the body.
BOXES = r"(?:latest news|news|read next|read more|you may also like|you might also like|popular now|most read|trending|quick links|useful links|related (?:topics|articles|pages|links)|more (?:from|about|on) .{1,60}|see also|vezi și|citește și|articole similare|das könnte sie (?:auch )?interessieren|auch interessant|weitere themen|también (?:te|le) puede interesar|ver también|relacionado)\W*"

_around = re.compile("|".join(f"(?:{a})" for a in AROUND), re.I)
_box = re.compile(BOXES, re.I)
_list = re.compile(r"^\s*[-•*–▪◦·]\s+\S")
_date = re.compile(r"^\s*\d{1,2}[./]\d{1,2}[./]\d{2,4}\b")
_more = re.compile(r"(?:\.\.\.|…) ?(?:read more|mehr|más|citește)\s*$|\bread more\s*$", re.I)
_time = re.compile(r"\b\d{1,2}:\d{2}\b")
_cut = re.compile(r"\s(?:[>»›/·|])\s|\s{2,}|\s[-–]\s(?=[A-Z])")
_crumb = re.compile(r"\s[>»›/]\s")
_trail = re.compile(r"(?:[-_]\d+)?(?:\.\w{2,5})?$")
# One of these stands in every line that _around matches; looked for in all distinct lines at once.
_AROUND_HAS = "skip to|jump to|open menu|close|loading|search|select |language|chat with|back to top|print|accept|reject|manage|akzeptieren|aceptar|cookie|strictly|statistics|advertise|anzeige|publicid|publicit|site ?map|impr|datenschutz|aviso|privac|terms|termeni|legal|follow|payment|download|customer|choose|share|teilen|was this|subscribe|sign up|enter your|log ?in|facepage|©|\\(c\\)|copyright|rights|member|partner|store|consent| off|deals|fares|offers|from only|  "

_simple = re.compile(r"[\W_]+")


def simple(s: str) -> str:
    """A line in lower case, whatever is no letter or digit one space."""
    return _simple.sub(" ", s.lower()).strip()


def simples(lines: list[str]) -> list[str]:
    """The same for many lines at once."""
    return pc.utf8_trim_whitespace(pc.replace_substring_regex(pc.utf8_lower(pa.array(lines, pa.string())), r"[^\p{L}\p{N}]+", " ")).to_pylist()


def undecorated(lines: list[str]) -> list[str | None]:
    """The keys of teasers without their date and invitation to read more; None for other lines."""
    out: list[str | None] = [None] * len(lines)
    dressed = pc.match_substring_regex(pa.array(lines, pa.string()), r"(?i)^\s*\d{1,2}[./]\d|(?:read more|mehr|más|citește)\s*$").to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(dressed).tolist():
        s = lines[i].strip()
        bare = _more.sub("", _date.sub("", s)).strip()
        if bare != s and len(s.split()) <= 14:
            out[i] = simple(bare)
    return out


def key_hash(keys: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(keys, dtype=object), categorize=False) if keys else np.zeros(0, np.uint64)


@dataclass
class Shares:
    """Of how many of all pages a line stands on, plain and in a teaser's dress; lines by the hash of their key, sorted."""

    line: np.ndarray
    plain: np.ndarray
    dressed: np.ndarray
    pages: int

    @classmethod
    def of(cls, plain: dict[str, int], dressed: dict[str, int], pages: int) -> Shares:
        h = key_hash(list(plain))
        order = np.argsort(h)
        return cls(h[order], np.array(list(plain.values()), np.int64)[order], np.array([dressed.get(k, 0) for k in plain], np.int64)[order], pages)

    def __call__(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(pages with the line plain, pages with it dressed) of each key."""
        h = key_hash(keys)
        if not len(self.line) or not len(h):
            return np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.line, h), len(self.line) - 1)
        known = self.line[at] == h
        return np.where(known, self.plain[at], 0), np.where(known, self.dressed[at], 0)


NOTHING = Shares(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0)

#: A short line that stands plain on this share of all pages, and on none in a teaser's dress, is a heading and no teaser; under 4,000 pages the share
#: is less than EVIDENCE pages, which are too few to tell, so that many are asked for.
PLAIN, EVIDENCE = 0.0025, 10


def is_plain(keys: list[str], shares: Shares) -> np.ndarray:
    n, dressed = shares(keys)
    return (n >= PLAIN * shares.pages) & (n >= EVIDENCE) & (dressed == 0)


def slug(url: str | None) -> str:
    return simple(_trail.sub("", (url or "").split("?")[0].rstrip("/").rsplit("/", 1)[-1]))


#: Words that are as well headings of a body: navigation only beside other words of a menu, and not right before a paragraph, list or table.
UNSURE = frozenset({"contact", "kontakt", "contacto"})


NAMES = ("bias", "around", "menu", "box", "paragraph", "list", "table", "teaser", "short")
_KIND = {k: i for i, k in enumerate(NAMES)}
_SHORT, _MENU, _PARAGRAPH, _BOX, _TEASER = (_KIND[k] for k in ("short", "menu", "paragraph", "box", "teaser"))
#: Upper ends of the classes of a line's share of all pages.
SHARES = (0.002, 0.01, 0.03, 0.1)
_SHAPES = 12
_OWN = len(NAMES) + _SHAPES + len(SHARES)
#: Kinds of the two lines before and after, places in the page, distances to the last box heading, and whether the line is known as a heading only.
FEATURES = _OWN + 4 * len(NAMES) + 6 + 10


@dataclass
class Lines:
    """The lines of many pages, and what distinct lines are by themselves: rough kind, key, shape, last part of a path of links."""

    page: np.ndarray
    kind: np.ndarray
    key: np.ndarray  # of each line the index in keys
    keys: list[str]
    shape: np.ndarray
    crumb: np.ndarray  # of each line the index in crumbs, or -1
    crumbs: list[str]


def _alone(line: str, near_around: bool) -> tuple[int, bool, bool]:
    """(kind, single entry of a menu, entry that may be a heading) of a line by itself."""
    s = line.strip()
    words = s.split()
    low = s.lower()
    parts = [p.strip().lower() for p in _cut.split(s) if p.strip()]
    menu = low in MENU
    if _box.fullmatch(s):
        kind = "box"
    elif near_around and _around.fullmatch(s):
        kind = "around"
    elif menu or len(parts) >= 3 and sum(p in MENU for p in parts) >= 0.5 * len(parts):
        kind = "menu"
    elif _crumb.search(s) and len(words) <= 24 and s[-1] not in ".!?" or len(parts) == 2 and all(p in MENU for p in parts):
        kind = "menu"
    elif _list.match(line) or "(max" in low and re.search(r"\(max\.? \d", s):
        kind = "list"
    elif " | " in s:
        kind = "table"
    elif _more.search(s) or _date.match(s) and len(words) <= 14:
        kind = "teaser"
    elif len(words) >= 8 and s[-1] in ".!?:;\"”" or len(words) >= 16 or s[-1] == "?" and len(words) >= 4:
        kind = "paragraph"
    elif len(words) >= 4 and s[-1] in ".!":
        kind = "paragraph"
    else:
        kind = "short"
    single = kind == "menu" and not _cut.search(s)
    return _KIND[kind], single, single and low in UNSURE


def read(pages: list[list[str]]) -> Lines:
    """Pages' non-blank lines; each distinct line is looked at once."""
    flat = [line for p in pages for line in p]
    page = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
    coded = pa.array(flat, pa.string()).dictionary_encode()
    code, every = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
    bare = [x.strip() for x in every]
    around = pc.match_substring_regex(pc.utf8_lower(pa.array(bare, pa.string())), _AROUND_HAS).to_numpy(zero_copy_only=False)
    alone = [_alone(x, a) for x, a in zip(every, around)]
    kind, single, unsure = (np.array([a[i] for a in alone], (np.int64, bool, bool)[i]) for i in range(3))
    words = np.fromiter((len(x.split()) for x in bare), np.int64, len(bare))
    arr = pa.array(bare, pa.string())
    seen = lambda pattern: pc.match_substring_regex(arr, pattern).to_numpy(zero_copy_only=False)
    shape = np.zeros((len(every), _SHAPES), np.float32)
    for i, x in enumerate((words <= 1, (words >= 2) & (words <= 3), (words >= 4) & (words <= 7), words > 20, seen(r"[.!?]$"), seen(r"\?$"), seen(r"\b\d{1,2}:\d{2}\b"), seen(r"^\d{1,2}[./]\d{1,2}[./]\d{2,4}\b"))):
        shape[:, i] = x
    shape[:, 8] = [bool(_more.search(x)) for x in bare]
    shape[:, 9] = seen(": ")
    crumbs: list[str] = []
    crumb = np.full(len(every), -1, np.int64)
    for i in np.flatnonzero((kind == _MENU) & seen(r"\s[>»›/]\s")).tolist():
        crumb[i] = len(crumbs)
        crumbs.append(simple(_crumb.split(every[i])[-1]))
    kinds = kind[code]
    start = np.searchsorted(page, page, "left")
    end = np.searchsorted(page, page, "right")
    sure = (single & ~unsure)[code]
    for i in np.flatnonzero(unsure[code]).tolist():
        before, after = sure[max(start[i], i - 2) : i].any(), sure[i + 1 : min(end[i], i + 3)].any()
        solid = i + 1 < end[i] and kind[code[i + 1]] in _SOLID
        beside = (before or after) if bare[code[i]].lower() == "contact" else (before and after)
        kinds[i] = _MENU if beside and not solid else _SHORT
    return Lines(page, kinds, code, simples(every), shape, crumb[code], crumbs)


_SOLID = (_KIND["paragraph"], _KIND["list"], _KIND["table"])


def _titles(lines: Lines, urls: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(may be the page's title, page has a title to look for) by URL and paths of links, and the first and last solid line of each line's page."""
    at = np.searchsorted(lines.page, np.arange(len(urls) + 1))
    is_title, sought = np.zeros(len(lines.page), bool), np.zeros(len(lines.page), bool)
    for p, url in enumerate(urls):
        a, b = at[p], at[p + 1]
        names = {lines.crumbs[c] for c in lines.crumb[a:b][lines.crumb[a:b] >= 0].tolist()} | {slug(url)} - {""}
        sought[a:b] = bool(names)
        if names:
            is_title[a:b] = [bool(lines.keys[k]) and lines.keys[k] in names for k in lines.key[a:b].tolist()]
    return is_title & np.isin(lines.kind, (_SHORT, _PARAGRAPH)), sought, at


def rule_labels(pages: list[list[str]], urls: list[str | None], shares: Shares = NOTHING) -> list[list[int]]:
    """The labels that trusted rules give to the non-blank lines of pages. A box heading takes in up to six short lines after it, but not the page's
    title, nor a line that all pages know as a heading only."""
    lines = read(pages)
    titled, _, at = _titles(lines, urls)
    plain = is_plain(lines.keys, shares)[lines.key] if len(lines.key) else np.zeros(0, bool)
    out = []
    for p in range(len(pages)):
        part = slice(at[p], at[p + 1])
        kinds, known = [NAMES[k] for k in lines.kind[part].tolist()], plain[part].tolist()
        title = next(iter(np.flatnonzero(titled[part]).tolist()), None)
        solid = [i for i, k in enumerate(kinds) if k in ("paragraph", "list", "table")]
        first, last = (solid[0], solid[-1]) if solid else (len(kinds), -1)
        own: list[int] = []
        box = 0
        for i, k in enumerate(kinds):
            if k == "box":
                own.append(BOX)
                box = 6
            elif k == "teaser":
                own.append(BOX)
                box = max(0, box - 1)
            elif k in ("around", "menu"):
                own.append(CHROME)
                box = 0
            elif k == "short" and box and i != title and not known[i]:
                own.append(BOX)
                box -= 1
            elif k == "short" and i != title and (i > last and not (solid and own[i - 1] == BODY and i <= last + 8) or i < first - 3 and (title is None or i < title)):
                own.append(CHROME)
                box = 0
            else:
                own.append(BODY)
                box = 0
        out.append(own)
    return out


def features(pages: list[list[str]], urls: list[str | None], shares: Shares = NOTHING) -> np.ndarray:
    """A 0/1 row per non-blank line: its own kind and shape, its share of all pages, its neighbours, and its place."""
    lines = read(pages)
    n = len(lines.page)
    x = np.zeros((n, FEATURES), np.float32)
    if not n:
        return x
    titled, sought, at = _titles(lines, urls)
    i, kind = np.arange(n), lines.kind
    start, end = at[lines.page], at[lines.page + 1]
    x[:, 0] = 1
    x[i, kind] = 1
    x[:, len(NAMES) : len(NAMES) + _SHAPES] = lines.shape[lines.key]
    before = np.cumsum(titled) - titled
    before = before - before[start]  # titles before on the page
    x[:, len(NAMES) + 10], x[:, len(NAMES) + 11] = titled, titled & (before == 0)
    share = shares(lines.keys)[0][lines.key]
    for j, least in enumerate(SHARES):
        x[:, len(NAMES) + _SHAPES + j] = (share > 0) & (share >= least * shares.pages)
    for j, step in enumerate((-2, -1, 1, 2)):
        to = i + step
        inside = (to >= start) & (to < end)
        x[i, _OWN + j * len(NAMES) + np.where(inside, kind[np.clip(to, 0, n - 1)], 0)] = 1
    solid = np.isin(kind, _SOLID)
    own = i - start
    first = np.minimum.reduceat(np.where(solid, own, n + 9), at[:-1][np.diff(at) > 0])
    last = np.maximum.reduceat(np.where(solid, own, -1), at[:-1][np.diff(at) > 0])
    filled = np.cumsum(np.diff(at) > 0) - 1
    first, last = first[filled[lines.page]], last[filled[lines.page]]
    first = np.where(last < 0, end - start, first)
    seen = (before > 0) | titled
    place = _OWN + 4 * len(NAMES)
    for j, flag in enumerate((own < first, own > last, own < first - 3, before > 0, sought & ~seen, last < 0)):
        x[:, place + j] = flag
    plain = (kind == _SHORT) & is_plain(lines.keys, shares)[lines.key]
    goes_on = ((kind == _SHORT) | (kind == _TEASER)) & ~plain & ~(titled & (before == 0))
    reset = np.maximum.accumulate(np.where(~goes_on, i, -1))
    reset = np.where(reset < start, start - 1, reset)
    boxed = (reset >= start) & (kind[np.maximum(reset, 0)] == _BOX)
    since = np.where(boxed, 0, 99) + i - reset
    x[i, place + 6 + np.minimum(since, 7)] = since < 99
    x[:, place + 14] = since == 99
    x[:, place + 15] = plain
    return x
