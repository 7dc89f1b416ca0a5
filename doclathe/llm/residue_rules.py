"""Trusted labels of passages: unfilled templates, filler, and messages that stand in for content."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from doclathe.llm.words import distinct, words

# The ways in which common template languages mark a value to be filled in.
_IDENT = r"(?:[a-z]\w*(?:[._]\w+)+|[a-z]+[A-Z]\w*|[A-Z][A-Z0-9]*(?:[._][A-Z0-9]+)+|[A-Z]{3,}|date|name|city|phone|station|airport|email|time|title|value|country|code)"
PLACEHOLDERS = (
    r"\{\{[^{}\n]{1,80}\}\}",
    r"\{%[^%{}\n]{1,80}%\}",
    r"<%[^%\n]{1,80}%>",
    r"[$#]\{[^{}\n]{1,80}\}",
    r"\$\([\w.]{1,60}\)",
    r"%\([\w.]{1,60}\)[sd]\b",
    r"\[\[[^\[\]\n]{1,80}\]\]",
    r"@@\s?[\w.]{1,60}\s?@@",
    r"(?<![\w%])%[A-Za-z_][\w.]{1,60}%(?!\w)",
    r"\b__[A-Za-z][\w.]*?__\b",
    r"(?<!\S):[A-Za-z_][\w.]{1,60}:(?![\w:])",
    rf"(?<![\w$#~^|!?%])([$#~^|!?%]{{1,2}}){_IDENT}\1(?!\w)",
    rf"(?:«|‹|<<)\s?{_IDENT}\s?(?:»|›|>>)",
    r"(?<![\w{$#])\{\s?\$?(?:[a-z][\w.]*|[A-Z][A-Z0-9_.]+|[A-Za-z]\w*[_.]\w+)\s?\}(?!\})",
    r"\{\d{1,2}(?::[^{}\n]{0,60})?\}",
    r"\[\s?(?:[Ii]nsert|INSERT|[Ee]nter|ENTER|[Aa]dd|ADD|[Yy]our|YOUR|[Pp]ut|PUT|[Pp]laceholder|PLACEHOLDER)\b[^\]\n]{0,60}\]",
    r"\[\w{1,40} (?:here|goes here|hier|aquí|aici)\]",
    r"\[(?:[a-z]+[A-Z]\w*|[a-z]\w*(?:[._]\w+)+|[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+|NAME|CITY|DATE|PHONE|STATION|AIRPORT|EMAIL|TIME|TITLE|VALUE|COUNTRY|CODE)\]",
    rf"(?:&lt;|<)\s?{_IDENT}\s?(?:&gt;|>)",
)
# What programs print for a value that is not there.
MISSING = (
    r"\[object Object\]",
    r"(?<![\w'])NaN(?![\w'])",
    r":\s?(?:null|None|undefined|NULL|nil)\b",
    r"\((?:null|None|undefined|NULL)\)",
    r"\b(?:null|None|undefined),\s?(?:null|None|undefined)\b",
    r"\b(?:Dear|Hello|Hi|Welcome|Mr|Ms|from|to|number|by|at|of|until|on|for|with|is) (?:null|undefined|NULL)(?=[\s,.!?;:]*(?:$|\n|[.,!?;)]|to\b|from\b|was\b|and\b|is\b|at\b))",
    r"\bTB[DAC]\b(?:\W+TB[DAC]\b)+",
    r"(?<![\w-])(?:TBD|TODO|FIXME)\b(?![\w-])",
    r"\bX{4,}\b",
)
# Sentences that fill a layout until content comes, in the languages at hand: how such a passage begins, and what stands anywhere in one.
FILLER = (
    r"(?:this is )?(?:a )?(?:dummy|sample|placeholder|filler|example) (?:text|paragraph|copy|content)\b",
    r"(?:your|the) (?:content|text|title|headline) (?:goes )?here\b",
    r"to be (?:written|completed|added|defined|announced) by\b",
    r"coming soon:? ?content\b",
    r"text de umplutur[ăa]\b",
    r"texto de (?:ejemplo|relleno|prueba)\b",
    r"(?:blindtext|platzhaltertext|beispieltext|mustertext)\b",
    r"(?:hier steht|hier folgt) (?:ihr|der|ein) text\b",
    r"(?:insert|enter|add) (?:\w+ ){1,8}here\W*$",
    r"headline \d+ subline\b",
    r"(?:aici vine|aici va fi) (?:un )?text",
)
FILLER_WITHIN = (r"\blorem ipsum\b", r"\b(?:asdf|qwerty?|jkl|xxxx)\W+(?:asdf|qwerty?|jkl|x{3,})\b", r"\bbody copy \d+")
# The words of the usual Latin filler, by their first five letters.
LATIN = frozenset(
    w[:5]
    for w in "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
# Error, blocking, maintenance and scripts-required messages of web servers and browsers.
MESSAGES = (
    r"\b(?:http|error|eroarea?|fehler|status(?: code)?|code) ?[:#]? ?\(?[1-5]\d\d\b(?! (?:on|in|of|at|for|from)\b)",
    r"^(?:\W|\w+ ){0,5}(?:gone|not found|unauthori[sz]ed)\b\W*$",
    r"\bsomething went wrong\b|\betwas ist schiefgelaufen\b|\balgo salió mal\b|\bceva nu a mers\b",
    r"\b(?:error|eroare|fehler) \d+ ?[:.]",
    r"^(?:\W|\w+ ){0,6}[45]\d\d\b\W{0,4}(?:page not found|not found|forbidden|unauthori[sz]ed|bad request|bad gateway|internal|service|gateway|too many|error|gone|request)",
    r"\((?:4|5)\d\d\)",
    r"\bpage (?:was )?not found\b|^\W*not found\W*$|\bwas not found on this server\b|\bpage you (?:asked|were looking|requested|are looking) \w* ?(?:for )?\b.*\b(?:not exist|found|moved)|\bcan(?:'|’|no)?t find (?:that|the|this) page\b|\bno longer available\W*$",
    r"\bpagina (?:nu a fost găsită|nu există)|\bseite (?:wurde )?nicht gefunden|\bno se (?:encuentra|ha encontrado) la página|\bpágina no encontrada|\binhalt ist nicht mehr verfügbar",
    r"\baccess (?:is )?denied\b|^(?:\W|\w+ ){0,5}forbidden\b|\bdon(?:'|’)?t have permission to\b|\brequest was blocked\b|\bzugriff verweigert\b|\bacces (?:interzis|respins)\b|\bacceso denegado\b",
    r"\btoo many requests\b|\brequest timed out\b|\btook too long to respond\b|\bsite can(?:'|’)?t be reached\b|\bbad gateway\b|\binternal (?:server )?error\b|\bunexpected condition was met\b|\bgateway time-?out\b|\bservice (?:is )?(?:temporarily )?unavailable\b",
    r"\bis under maintenance\b|\bplanned (?:work|maintenance)\b|\bscheduled maintenance\b|\bbe (?:right )?back (?:soon|shortly)\b|\bin mentenanță\b|\bwartungsarbeiten\b|\ben mantenimiento\b|\bdown for maintenance\b",
    r"\bsession has expired\b|\bverify (?:that )?you are (?:a )?human\b|\bchecking your browser\b|\bneeds to review the security of your connection\b|\bunusual traffic\b|\bcompleting the (?:action|captcha)\b|\bare you a robot\b",
    r"\b(?:enable|activate|allow|turn on|switch on) (?:javascript|scripts?|scripting|cookies and javascript)\b|\bjavascript (?:is|must be|has to be) (?:disabled|off|required|enabled|turned off|switched off)\b|\brequires (?:javascript|scripts)\b|\bscripting switched off\b|\bbrowser is not supported\b",
    r"\baktivieren sie javascript\b|\bjavascript aktivieren\b|\bactiva(?:ți|ti) javascript\b|\bactiv[ea] javascript\b|\bhabilite javascript\b",
    r"\btraceback \(most recent call last\)|\bconnection refused in\b|\b(?:fatal|parse) error\b|^warning: \w+\(|\bstack trace\b|\bnullpointerexception\b|\buncaught (?:type|reference)?error\b",
    r"\bsome features (?:of .{1,60} )?(?:will|may) not work\b|\bif nothing happens, (?:allow|enable)\b",
    r"\bcould not load this content\b|\bweb server (?:reported|returned)\b",
)

placeholder = re.compile("|".join(PLACEHOLDERS))
missing = re.compile("|".join(MISSING))
_filler = re.compile(rf"\W*(?:{'|'.join(FILLER)})", re.I)
_filler_within = re.compile("|".join(FILLER_WITHIN), re.I)
_message = re.compile("|".join(MESSAGES), re.I)
# What every placeholder or missing value, and every filler, has in it; cheap to look for, so that most texts need no more.
_MARKED = r"[{\[<@%$#«‹]|&lt;|__|:[A-Za-z_]|[~^|!?][A-Za-z]"
_VALUES = r"NaN|null|None|undefined|NULL|nil|TB[DAC]|TODO|FIXME|XXXX|\[object"
_FILLS = "dummy|sample|placeholder|filler|example| here|to be |coming soon|umplutur|texto de|blindtext|platzhalter|beispieltext|mustertext|hier |subline|aici v|lorem|asdf|qwert|jkl|xxxx|body copy"
_quoted = re.compile(r"[\"“”„«»][^\"“”„«»]{2,60}[\"“”„«»]")
_vowels = re.compile("[aeiouăâîäöüáéíóú]")


def has_placeholder(texts: list[str]) -> list[bool]:
    """Whether each text holds an unfilled placeholder or a value that was never filled in."""
    arr = pa.array(texts, pa.string())
    marked, valued = (pc.match_substring_regex(arr, p).to_pylist() for p in (_MARKED, _VALUES))
    return [bool(m and placeholder.search(t) or v and missing.search(t)) for t, m, v in zip(texts, marked, valued)]


@lru_cache(200_000)
def _bones(word: str) -> str:
    """The first consonants of a word: what garbled Latin keeps of it."""
    return _vowels.sub("", word)[:3]


_LATIN_BONES = frozenset(b for w in LATIN if len(b := _bones(w)) >= 2)

# One of these, or a number that ends like a status code, stands in every message; passages without are not matched at all.
HINTS = (
    "error", "eroare", "fehler", "gone", "not found", "unauthori", "went wrong", "schiefgelaufen", "salió mal", "nu a mers", "page you", "find th", "no longer", "pagina nu", "seite", "página", "inhalt", "denied", "forbidden",
    "permission", "blocked", "verweigert", "interzis", "respins", "denegado", "too many", "timed out", "too long", "be reached", "gateway", "unexpected", "unavailable", "maintenance", "planned", "back soon", "back shortly",
    "mentenan", "wartung", "mantenimiento", "session", "human", "browser", "security of", "unusual traffic", "completing", "robot", "script", "traceback", "refused", "warning:", "stack trace", "nullpointer", "could not load",
    "web server", "nothing happens", "not work",
)
_HINTED = "|".join(map(re.escape, HINTS)) + r"|[1-5]\d\d\b"

OTHER, FILL, MESSAGE = 0, 1, 2


def labels(passages: list[str]) -> np.ndarray:
    """FILL, MESSAGE or OTHER of each passage, of any length. What a passage quotes doesn't make it a message."""
    arr, n = pa.array(passages, pa.string()), len(passages)
    out = np.full(n, OTHER, np.int64)
    doc, code, vocabulary = words(arr, r"[^\p{L}]+")
    each = vocabulary.to_pylist()
    latin = np.fromiter((len(w) > 2 and w[:5] in LATIN for w in each), float, len(each))
    bones = np.fromiter((len(w) > 3 and _bones(w) in _LATIN_BONES for w in each), float, len(each))
    size = np.bincount(doc, minlength=n)
    kinds = np.bincount(distinct(doc * (len(each) + 1) + code) // (len(each) + 1), minlength=n)
    fill = (size >= 9) & (kinds <= 3) | (size >= 4) & (np.bincount(doc, latin[code], n) >= 0.6 * size) | (size >= 6) & (np.bincount(doc, bones[code], n) >= 0.75 * size)
    low = pc.utf8_lower(arr)
    for i in np.flatnonzero(~fill & pc.match_substring_regex(low, _FILLS).to_numpy(zero_copy_only=False)).tolist():
        fill[i] = bool(_filler.match(passages[i]) or _filler_within.search(passages[i]))
    for i in np.flatnonzero(~fill & pc.match_substring_regex(low, _HINTED).to_numpy(zero_copy_only=False)).tolist():
        bare = _quoted.sub(" ", passages[i]) if "Traceback" not in passages[i] else passages[i]
        out[i] = MESSAGE if _message.search(bare) else OTHER
    out[fill] = FILL
    return out


def label(passage: str) -> int:
    return int(labels([passage])[0])
