"""Matching of entities across sources without keys: soft-logic rules as a convex hinge-loss problem, solved by alternating directions."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclathe.runtime import materialize, small

# Words of names that only say what is named, in the languages at hand, and legal forms. They carry no identity.
KIND_WORDS = {
    "airport": "airport airfield arpt apt aeroport aeroportul aeropuerto aeroporto flughafen",
    "airline": "fluggesellschaft aerolinea compania aeriana airline",
    "none": "inc ltd plc gmbh group srl sa s a ag llc co corp accessibility prm of the de din la main",
}
# Short forms of words of names.
SHORT_FORMS = {"intl": "international", "int": "international", "reg": "regional", "nth": "north", "sth": "south"}
#: Weights of a word in a name: telling words, words that many reference names share, and words of kind.
TELLING, SHARED, KIND = 1.0, 0.5, 0.12
#: A word of at least this share of the reference names, and of FEW at least, is shared; alone it is no reason to compare two records. There are at most
#: 1 / COMMON times as many such words as a mean name has, however many references.
COMMON, FEW = 0.007, 10
#: Similarity of names from which they agree in full, and below which they contradict in full.
AGREES, CONTRADICTS = 0.95, 0.55
#: What a name that is only the airport's city counts.
CITY_ONLY = 0.8
#: How far a phone speaks for a match where a record has no name but a code.
NAMELESS = 0.8
#: Rules: weight of each, for and against a match. What is missing on either side says nothing.
FOR = {"domain": 6.0, "code": 2.0, "phone and name": 1.5, "name and city": 1.5, "name and country": 1.0, "name": 0.9, "code and phone": 3.5}
AGAINST = {"name": 4.5, "country": 2.0, "city": 1.2, "code": 1.5, "domain": 1.0, "phone": 0.5, "prior": 0.75}
#: Weight of agreement between the states of one record.
SAME = 2.0
#: A problem is solved when no variable moves, or differs from its copies, by more than this; or after so many rounds.
NEAR, ROUNDS = 1e-4, 5000
#: Matches have at least this value; over a half, so an entity has one at most.
CONFIDENCE = 0.52

_words = re.compile(r"[a-z0-9]+")
_brackets = re.compile(r"\(([^()]*)\)")
_kind = {w: k for k, ws in KIND_WORDS.items() for w in ws.split()}


@lru_cache(200_000)
def fold(s: str | None) -> str:
    flat = unicodedata.normalize("NFKD", s or "").lower()
    return "".join(c for c in flat if not unicodedata.combining(c)).replace("ß", "ss").replace("ø", "o").replace("ł", "l")


@lru_cache(200_000)
def phone_key(s: str | None) -> str:
    digits = re.sub(r"\D", "", re.sub(r"\(0\)", "", s or ""))
    return digits[2:] if digits.startswith("00") else digits


@lru_cache(200_000)
def domain_key(s: str | None) -> str:
    host = re.sub(r"^[a-z]+://", "", (s or "").strip().lower()).split("/")[0].split(":")[0]
    return re.sub(r"^(?:www|help|prm|info|support)\.", "", host)


@lru_cache(200_000)
def name_words(s: str | None) -> tuple[tuple[str, ...], str]:
    """(words, code): the words of a name, short forms spelt out; code is what stands in brackets or instead of a name."""
    flat = fold(s)
    inside = [x.strip() for x in _brackets.findall(flat)]
    code = next((x.upper() for x in inside if re.fullmatch(r"[a-z0-9]{2,4}", x)), "")
    words = [SHORT_FORMS.get(w, w) for w in _words.findall(_brackets.sub(" ", flat))]
    for i in range(len(words) - 2, -1, -1):
        if _alike(words[i], "air") and _alike(words[i + 1], "lines"):
            words[i : i + 2] = ["airlines"]
    if len(words) == 1 and re.fullmatch(r"[a-z0-9]{2,3}", words[0]):
        return (), words[0].upper()
    return tuple(w for w in words if _kind.get(w) != "none"), code


def _deletions(w: str) -> set[str]:
    return {w} | ({w[:i] + w[i + 1 :] for i in range(len(w))} if len(w) >= 6 else set())


def block_keys(name: str | None, full: str | None, code: str | None, city: str | None, phone: str | None, web: str | None, common: frozenset[str]) -> list[int]:
    """Hashes of everything that two records of one thing may share: phone, host, code, telling words of names or city, each also with any one letter left
    out, and the words of a whole name, which may be shared ones alone."""
    keys = set()
    if p := phone_key(phone):
        keys.add("p" + p)
    if d := domain_key(web):
        keys.add("d" + d)
    words, inside = name_words(name)
    for c in (inside, (code or "").strip().upper()):
        if c:
            keys.add("c" + c)
    for one in (words, name_words(full)[0]):
        if own := sorted({w for w in one if w not in _kind}):
            keys.add("n" + " ".join(own))
    for w in set(words) | set(name_words(full)[0]) | set(_words.findall(fold(_brackets.sub(" ", city or "")))):
        if len(w) >= 4 and w not in common and w not in _kind:
            keys |= {"w" + x for x in _deletions(w)}
    return pd.util.hash_array(np.array(sorted(keys), dtype=object), categorize=False).view(np.int64).tolist() if keys else []


@lru_cache(200_000)
def _alike(a: str, b: str) -> float:
    """Ratio of common letters, if spelling alone may tell the words apart: from 0.8, of short words from 0.85."""
    if a == b:
        return 1.0
    least = min(len(a), len(b))
    if least < 3 or abs(len(a) - len(b)) > 2:
        return 0.0
    enough = 0.8 if least >= 5 else 0.85
    if 2 * sum((Counter(a) & Counter(b)).values()) < enough * (len(a) + len(b)):  # common letters in any order are no fewer
        return 0.0
    ratio = SequenceMatcher(None, a, b, autojunk=False).ratio()
    return ratio if ratio >= enough else 0.0


def name_similarity(a: tuple[str, ...], b: tuple[str, ...], weight) -> float:
    """Weighted share of common words, near spellings in part; a word of kind agrees with any other of its kind."""
    if not a or not b:
        return 0.0
    left, common = list(b), 0.0
    for w in a:
        scored = [(1.0 if _kind.get(w) and _kind.get(w) == _kind.get(v) else _alike(w, v), v) for v in left]
        best, v = max(scored, default=(0.0, ""))
        if best:
            common += best * (weight(w) + weight(v)) / 2
            left.remove(v)
    return 2 * common / (sum(map(weight, a)) + sum(map(weight, b)))


@lru_cache(200_000)
def _same_city(a: str, b: str) -> bool:
    x, y = fold(_brackets.sub(" ", a)).strip(), fold(b).strip()
    return x == y or SequenceMatcher(None, x, y, autojunk=False).ratio() >= 0.85


@lru_cache(200_000)
def _same_country(a: str, b: str) -> bool:
    x, words = fold(a).strip(), _words.findall(fold(b))
    return x == " ".join(words) or x in words or len(x) <= 3 and "".join(words).startswith(x) or len(x) >= 5 and SequenceMatcher(None, x, " ".join(words), autojunk=False).ratio() >= 0.85


def evidence(e: tuple, r: tuple, weight) -> list[float]:
    """Truth of the rules' bodies for a state of an entity and a reference record: those of FOR, then of AGAINST.
    e: name, code, city, country, phone, web; r: name, full, code, city, country, phone, web."""
    words, inside = name_words(e[0])
    code = (e[1] or "").strip().upper()
    names = [name_words(r[0])[0], name_words(r[1])[0]]
    sim = max(name_similarity(words, n, weight) for n in names) if words else 0.0
    kind = [w for w in names[0] if _kind.get(w) == "airport"]
    if kind and words and r[3]:  # an airport called by its city alone, which other airports there may be as well
        sim = max(sim, CITY_ONLY * name_similarity(words, (*_words.findall(fold(r[3])), *kind[:1]), weight))
    agree = min(1.0, max(0.0, (sim - CONTRADICTS) / (AGREES - CONTRADICTS)))
    known = lambda x, y: bool(x and y)
    p, d = phone_key(e[4]), domain_key(e[5])
    phone = known(p, r[5]) and p == phone_key(r[5])
    domain = known(d, r[6]) and d == domain_key(r[6])
    own = (r[2] or "").strip().upper()
    same_code = bool(own) and own in (code, inside)
    city = known(e[2], r[3]) and _same_city(e[2], r[3])
    country = known(e[3], r[4]) and _same_country(e[3], r[4])
    both = lambda x, y: max(0.0, x + y - 1)
    pro = [float(domain), float(same_code), both(phone, agree if words else NAMELESS), both(agree, city), both(agree, country), agree if sim >= AGREES else 0.0, float(same_code and phone)]
    con = [
        1 - agree if words else 0.0, float(known(e[3], r[4]) and not country), float(known(e[2], r[3]) and not city), float(bool(own and (code or inside)) and not same_code),
        float(known(d, r[6]) and not domain), float(known(p, r[5]) and not phone), 1.0,
    ]
    return pro + con


def solve(pair: np.ndarray, group: np.ndarray, body: np.ndarray, rounds: int = ROUNDS, near: float = NEAR, rho: float = 1.0) -> np.ndarray:
    """Values of the pairs: the minimum of the rules' weighted hinge losses, by consensus ADMM.

    One variable per state (row of body) and one per pair. Potentials: each rule for pushes its state up to its truth, each against down to one
    minus it; a state and its pair are drawn together both ways (transitivity); the pairs of a group sum to one at most (exclusivity). Groups
    share no variable; each is left alone once its primal and dual residuals are small."""
    out, left = np.zeros(len(group)), np.arange(len(group))
    k = len(FOR)
    rules = body.shape[1]
    sign = np.r_[np.ones(k), -np.ones(rules - k)]
    weight = np.array([*FOR.values(), *AGAINST.values()])
    x, y = np.full(len(pair), 0.5), np.full(len(group), 0.5)
    u_rule, u_x, u_y, u_g = np.zeros((len(pair), rules)), np.zeros(len(pair)), np.zeros(len(pair)), np.zeros(len(group))
    goal = np.where(sign > 0, body, 1 - body)
    for turn in range(1, rounds + 1):
        m = len(left)
        # rules: min w max(0, sign (goal - z)) + rho/2 (z - v)^2
        v = x[:, None] - u_rule
        gap = sign * (goal - v)
        z_rule = np.where(gap <= 0, v, np.where(gap >= weight / rho, v + sign * weight / rho, goal))
        # transitivity: min SAME |a - b| + rho/2 ((a - va)^2 + (b - vb)^2)
        va, vb = x - u_x, y[pair] - u_y
        step = np.clip((va - vb) / 2, -SAME / rho, SAME / rho)
        z_x, z_y = va - step, vb + step
        # exclusivity: projection on sum <= 1
        vg = y - u_g
        over = np.maximum(0, np.bincount(group, weights=vg) - 1)
        z_g = vg - over[group] / np.bincount(group)[group]
        x_old, y_old = x, y
        x = np.clip(((z_rule + u_rule).sum(1) + z_x + u_x) / (rules + 1), 0, 1)
        y = np.clip((np.bincount(pair, weights=z_y + u_y, minlength=m) + z_g + u_g) / (np.bincount(pair, minlength=m) + 1.0), 0, 1)
        u_rule += z_rule - x[:, None]
        u_x += z_x - x
        u_y += z_y - y[pair]
        u_g += z_g - y
        out[left] = y
        if turn % 20 == 0:
            moved = np.maximum.reduce([np.abs(x - x_old), np.abs(z_rule - x[:, None]).max(1), np.abs(z_x - x), np.abs(z_y - y[pair]), np.abs(y - y_old)[pair], np.abs(z_g - y)[pair]])
            open_ = np.zeros(group.max() + 1, bool)
            np.logical_or.at(open_, group[pair], moved > near)
            stay = open_[group]
            if not stay.any():
                break
            states = stay[pair]
            to = np.cumsum(stay) - 1
            left, pair, group = left[stay], to[pair[states]], np.unique(group[stay], return_inverse=True)[1]
            x, y, goal, u_rule, u_x, u_y, u_g = x[states], y[stay], goal[states], u_rule[states], u_x[states], u_y[states], u_g[stay]
    return out


_OUT = pa.schema([("entity", pa.string()), ("ref", pa.string()), ("confidence", pa.float64())])


def _solve_rows(entity: list[str], ref: list[str], body: np.ndarray) -> pa.RecordBatch:
    """Groups are entities, whose rows lie together in order of ref; rows are distinct, so equal evidence of one pair is one state. Entities with the same
    evidence have the same problem, which is solved once."""
    start = [i for i in range(len(entity)) if not i or entity[i] != entity[i - 1]]
    problems: dict[tuple, int] = {}
    members, places, names = [], [], []
    pair, group, rows = [], [], []
    for a, b in zip(start, [*start[1:], len(entity)]):
        refs = sorted(set(ref[a:b]))
        local = {r: i for i, r in enumerate(refs)}
        states = sorted((local[ref[i]], body[i].tobytes(), i) for i in range(a, b))
        at = problems.setdefault(tuple((p, x) for p, x, _ in states), len(group))
        if at == len(group):
            pair += [at + p for p, _, _ in states]
            rows += [i for _, _, i in states]
            group += [len(problems) - 1] * len(refs)
        members += [entity[a]] * len(refs)
        places += range(at, at + len(refs))
        names += refs
    value = solve(np.array(pair), np.array(group), body[rows])
    return pa.RecordBatch.from_arrays([pa.array(members, pa.string()), pa.array(names, pa.string()), pa.array(value[places])], schema=_OUT)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Problems of one partition, whose rows are sorted by entity, some thousand rows at a time; an entity is never cut."""
    entity: list[str] = []
    ref: list[str] = []
    body: list[list[float]] = []
    for b in batches:
        entity += b.column(0).to_pylist()
        ref += b.column(1).to_pylist()
        body += b.column(2).to_pylist()
        if len(entity) >= 5000:
            cut = len(entity)
            while cut and entity[cut - 1] == entity[-1]:
                cut -= 1
            if cut:
                yield _solve_rows(entity[:cut], ref[:cut], np.array(body[:cut]))
                entity, ref, body = entity[cut:], ref[cut:], body[cut:]
    if entity:
        yield _solve_rows(entity, ref, np.array(body))


def match_entities(entities: DataFrame, references: DataFrame) -> DataFrame:
    """(entity, ref, confidence) of every candidate pair; an entity's confidences sum to one at most.

    entities: entity, kind, name, code, city, country, phone, web (several states of an entity are several rows; all count). references: ref, kind,
    name, full, code, city, country, phone, web. A null kind may match any; other kinds only their own. Candidates share a phone, host, code or
    telling word (up to one letter). Rows with a null id are left out; whatever else is null or blank is no evidence; repeated rows count once;
    either side may be empty. Problems of different entities share no variable, so partitions are solved by themselves; states of an entity are
    combined to distinct evidence before, so a record repeated over and over is no larger than one. Reference words are counted over all
    references; the common ones (each on a share COMMON of the names or more) are sent to the tasks, and references only if they are few (else joins
    shuffle). Several entities may match one reference, since several sources describe it; exclusivity binds entities only."""
    spark = entities.sparkSession
    e = entities.where("entity is not null").distinct()
    r = materialize(references.where("ref is not null").distinct())
    common = max(FEW, COMMON * r.count())
    counts = r.select(F.explode(F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(F.concat_ws(" ", "name", "full")), "[^a-z0-9]+", " "), " "), lambda w: w != ""))).alias("w")).groupBy("w").count()
    shared = spark.sparkContext.broadcast(frozenset(x.w for x in counts.where(F.col("count") >= common).collect()) | {"airlines"})

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [block_keys(*row, shared.value) for row in zip(*(b.column(i).to_pylist() for i in range(3, 9)))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.list_(pa.int64()))], names=[*b.schema.names, "keys"])

    text = "kind string, country string, name string, full string, code string, city string, phone string, web string, keys array<long>"
    ek = e.select("entity", "kind", "country", "name", F.lit(None).cast("string").alias("full"), "code", "city", "phone", "web").mapInArrow(keyed, f"entity string, {text}")
    rk = r.select("ref", "kind", "country", "name", "full", "code", "city", "phone", "web").mapInArrow(keyed, f"ref string, {text}")
    left = ek.select("entity", "kind", *(F.col(c).alias(f"e_{c}") for c in ("name", "code", "city", "country", "phone", "web")), F.explode("keys").alias("key"))
    right = materialize(rk.select(F.explode("keys").alias("key"), "ref", F.col("kind").alias("r_kind")))
    met = left.join(small(right), "key").where(F.col("kind").isNull() | (F.col("kind") == F.col("r_kind"))).drop("key", "kind", "r_kind").distinct()
    full = met.join(small(r.select("ref", *(F.col(c).alias(f"r_{c}") for c in ("name", "full", "code", "city", "country", "phone", "web")))), "ref")

    def weight(w: str) -> float:
        return KIND if w in _kind else SHARED if w in shared.value else TELLING

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(b.num_columns)]
            body = [[round(x, 2) for x in evidence(row[2:8], row[8:15], weight)] for row in zip(*cols)]  # so few are distinct
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(0), pa.array(body, pa.list_(pa.float64()))], names=["entity", "ref", "body"])

    judged = full.select("ref", "entity", *(f"e_{c}" for c in ("name", "code", "city", "country", "phone", "web")), *(f"r_{c}" for c in ("name", "full", "code", "city", "country", "phone", "web"))).mapInArrow(measure, "entity string, ref string, body array<double>")
    states = judged.distinct().repartition("entity").sortWithinPartitions("entity")
    return states.mapInArrow(_solve, "entity string, ref string, confidence double")
