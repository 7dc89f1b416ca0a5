"""Corpus operators against brute force, exact round trips and held-out rows."""

import itertools
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from doclathe.llm import crf, leakage, linkage, page_body, page_rules, residue, residue_rules, tokenizer, visible
from doclathe.llm.keyword_spam import spam_shares
from doclathe.llm.near_duplicates import _agree, _bands, _large, _links, bounds, near_duplicate_classes, near_duplicate_rows
from doclathe.llm.site_lines import repeated_lines, strip_repeated_lines
from doclathe.llm.words import occurrence, words

EXTRA = "id int, class int, key string, line string, n int"
LOST = (1, 2, "k", "l", 3)


# --- 1: repeated lines


def lines_by_force(data, support=0.2):
    key = lambda s: re.sub(r"[\W\d_]+", " ", s.lower()).strip()
    pages, on = defaultdict(set), defaultdict(set)
    for i, src, page, text in data:
        p = page if page is not None else ("row", i)
        pages[src].add(p)
        for x in (text or "").split("\n"):
            if key(x):
                on[src, key(x)].add(p)
    return {(i, n) for i, src, page, text in data for n, x in enumerate((text or "").split("\n")) if text is not None and key(x) and len(on[src, key(x)]) >= support * len(pages[src]) - 1e-9}


def test_lines_against_brute_force(spark):
    rng = random.Random(2)
    pool = ["Legal notice 1", "legal NOTICE 22", "Share", "", "  ", "42", "by X"] + [f"body {chr(97 + i % 26)}{chr(97 + i // 26)} text" for i in range(80)]
    data = [(i, rng.choice(["hot"] * 3 + ["a", "b", None, ""]), rng.choice([f"u{i % 40}", None]), rng.choice([None, ""] + ["\n".join(rng.choices(pool[:7], k=2) + rng.choices(pool, k=6))] * 8)) for i in range(300)]
    df = spark.createDataFrame([(*d, *LOST) for d in data], f"page_id long, source_id string, source string, text string, {EXTRA}")
    found = repeated_lines(df)
    assert {(r.page_id, r.line_no) for r in found.collect()} == lines_by_force(data)
    kept = {r.page_id: r.text for r in strip_repeated_lines(df).collect()}
    gone = lines_by_force(data)
    assert all(kept[i] == (t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)) for i, _, _, t in data)
    assert repeated_lines(df.where("false")).count() == 0


def test_blocks_join_consecutive_lines(spark):
    data = [(i, "s", f"u{i}", f"own {'abcdefghij'[i]}\nTerms apply\nAll rights\nmore {'abcdefghij'[i]}\nShare this") for i in range(10)]
    found = rows(repeated_lines(spark.createDataFrame(data, "page_id long, source_id string, source string, text string")).where("page_id = 3"))
    block = {n: b for _, n, b in found}
    assert set(block) == {1, 2, 4} and block[1] == block[2] != block[4]


# --- 2: linkage


def test_admm_against_grid():
    body = np.array([[1, 0, 0.5, 0.5, 0, 1, 0, 0, 0, 0, 0, 0, 0, 1], [0, 1, 0, 0.2, 0, 0, 1, 1, 0, 1, 0, 1, 0, 1], [0, 0, 0.9, 0.9, 0.9, 0.9, 0, 0, 0, 0, 0, 0, 0, 1]], float)
    pair, group = np.array([0, 1, 1]), np.array([0, 0])
    w_for, w_con, k = np.array(list(linkage.FOR.values())), np.array(list(linkage.AGAINST.values())), len(linkage.FOR)

    def loss(x, y):
        hinge = sum((w_for * np.maximum(0, body[i, :k] - x[i])).sum() + (w_con * np.maximum(0, x[i] - (1 - body[i, k:]))).sum() for i in range(3))
        return hinge + linkage.SAME * np.abs(np.array(x) - np.array(y)[pair]).sum()

    grid = np.linspace(0, 1, 11)
    best = min(loss(x, y) for y in itertools.product(grid, grid) if sum(y) <= 1 + 1e-9 for x in itertools.product(grid, grid, grid))
    y = linkage.solve(pair, group, body)
    assert np.abs(y - linkage.solve(pair, group, body, rounds=20_000, near=1e-9)).max() < 0.01
    mine = min(loss(x, y) for x in itertools.product(np.linspace(0, 1, 41), repeat=3))
    assert y.sum() <= 1.01 and mine <= best + 0.1


def test_linkage_cases(spark):
    e = "entity string, kind string, name string, code string, city string, country string, phone string, web string, ref string"
    ents = [
        ("E1", "airline", "Hálgrad  Wíngs (HW)", None, "Jorm", "Esk", "0099 41 12", None, "x"), ("E1", "airline", "Halgrad Wings", None, None, None, None, "https://www.halgrad.example/en", "x"),
        ("E2", "airline", "Halgrad Holidays", None, "Jorm", "Eskmere", "+99 (0)41 12", "halgradholidays.example", "x"), ("E3", "airline", "Halgrad Wings", "Q9", "Other", "Zorvia", "+99 5", "halgradwings.web.example", "x"),
        ("E4", "airport", "XYZ", "XYZ", None, None, None, None, "x"), ("E5", None, "Aeropuerto de Tarvik", None, "Tarvik (main)", "ZO", None, None, "x"), (None, "airline", "Halgrad Wings", "HW", None, None, None, None, "x"),
        ("E6", "airport", None, None, None, None, None, None, "x"), ("E7", "airport", "Tarvik North Intl Arpt.", None, "Tarvik", "Zorvia", None, None, "x"), ("E8", "regulator", "Halgrad Wings", "HW", "Jorm", "Eskmere", None, None, "x"),
    ] + [("E1", "airline", "Halgrad Wings", None, None, None, None, "https://www.halgrad.example/en", "x")] * 500
    refs = [
        ("A1", "airline", "Halgrad Wings", None, "HW", "Jorm", "Eskmere", "+99 4112", "https://halgrad.example/"), ("A1", "airline", "Halgrad Wings", None, "HW", "Jorm", "Eskmere", "+99 4112", "https://halgrad.example/"), ("A2", "airline", "Halgrad Cargo", None, "HC", "Jorm", "Eskmere", "+99 7", None),
        ("P1", "airport", "Tarvik Airport", None, "XYZ", "Tarvik", "Zorvia", None, None), ("P2", "airport", "Tarvik North International Airport", None, None, "Tarvik", "Zorvia", None, None), (None, "airport", "Null", None, None, None, None, None, None),
    ]
    ed = spark.createDataFrame(ents, e)
    rd = spark.createDataFrame(refs, "ref string, kind string, name string, full string, code string, city string, country string, phone string, web string")
    every = linkage.match_entities(ed.drop("ref"), rd)
    found = {(r.entity, r.ref) for r in every.where(f"confidence >= {linkage.CONFIDENCE}").collect()}
    assert found == {("E1", "A1"), ("E4", "P1"), ("E5", "P1"), ("E7", "P2")}
    twice = linkage._solve_rows(["a", "a", "b", "b", "c"], ["x", "y", "y", "z", "x"], np.array([[1.0] + [0] * 12 + [1], [0] * 13 + [1], [1.0] + [0] * 12 + [1], [0] * 13 + [1], [0] * 13 + [1]]))
    assert twice.column(1).to_pylist() == ["x", "y", "y", "z", "x"] and twice.column(2)[0] == twice.column(2)[2] and twice.column(2)[0].as_py() > 0.9 > 0.1 > twice.column(2)[4].as_py()
    assert every.groupBy("entity").agg(F.sum("confidence").alias("s")).where("s > 1.02").count() == 0
    assert linkage.match_entities(ed.drop("ref").where("false"), rd).count() == 0 == linkage.match_entities(ed.drop("ref"), rd.where("false")).count()


# --- 3: page body


def test_crf_gradient_and_viterbi():
    rng = np.random.default_rng(1)
    n = np.array([4, 1, 3])
    x, y = rng.normal(size=(8, 5)), rng.integers(0, 3, 8)
    m = crf.Crf(rng.normal(size=(5, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    value, slope = m.gradient(x, y, n)
    for w, g in zip((m.emit, m.move, m.start), slope):
        for at in np.ndindex(w.shape):
            w[at] += 1e-6
            assert abs((m.gradient(x, y, n)[0] - value) / 1e-6 - g[at]) < 1e-4
            w[at] -= 1e-6
    got, start = m.decode(x, n), 0
    for size in n:
        s = x[start : start + size] @ m.emit
        score = lambda p: m.start[p[0]] + sum(s[i, v] for i, v in enumerate(p)) + sum(m.move[a, b] for a, b in zip(p, p[1:]))  # noqa: B023, E731
        assert tuple(got[start : start + size]) == max(itertools.product(range(3), repeat=int(size)), key=score)
        start += size


PAGE = "Skip to main content\nHome\nLogin\nContact\nHome > Guide > Lift access\nLift access\nThe lift in hall two is open to all passengers with reduced mobility every day.\n• White cane (max. 3 kg)\nStation | Desk | Hours\nTarvik | desk one | 08:00-12:00\nRead next\nFees in Tarvik\n1.2.2025 Seats\nThe desk answers calls about the lift from eight until twelve.\n\nSitemap\n© 2025 Tarvik"


def test_rules_and_model_on_a_page():
    labels = page_rules.rule_labels([page_body.split(PAGE)[1], []], ["https://x.example/lift-access-7.html", None])
    assert "".join("BcX"[v] for v in labels[0]) == "cccccBBBBBXXXBcc" and labels[1] == []


def test_known_headings_end_a_box():
    page = ["The lift in hall two is open to all passengers every day.", "Read next", "Fees", "1.2.2025 Seats", "La bord", "Pasagerii sunt rugați să vină la lift în ziua călătoriei."]
    shares = page_rules.Shares.of({"fees": 100, "la bord": 100}, {"fees": 100}, 1000)
    assert page_rules.rule_labels([page], [None]) == [[0, 2, 2, 2, 2, 0]]
    assert page_rules.rule_labels([page], [None], shares) == [[0, 2, 2, 2, 0, 0]]
    assert page_rules.undecorated(["1.2.2025 Fees", "Fees ... Read more", "Fees"]) == ["fees", "fees", None]


def test_features_of_a_page_alone_and_among_others():
    pages = [page_body.split(PAGE)[1], [], ["One"], page_body.split(PAGE)[1][3:9], ["Contact", "Home", "Contact", "Contact", "Login"]]
    urls = ["https://x.example/lift-access-7.html", None, "u", None, "https://x.example/one"]
    shares = page_rules.Shares.of({"home": 30, "one": 50}, {}, 100)
    together = page_rules.features(pages, urls, shares)
    assert together.shape == (sum(map(len, pages)), page_rules.FEATURES)
    assert (together == np.concatenate([page_rules.features([p], [u], shares) for p, u in zip(pages, urls)])).all()


def test_a_single_teaser_counts_against_a_heading(spark):
    notice = "we store small files " * 40
    data = [(i, "\n".join(["La bord"] * (i < 30) + ["Echipaj"] * (i < 40) + ["1.2.2025 La bord"] * (i == 500) + [notice] * (i < 700) + [f"Own {i}"])) for i in range(1000)]
    shares = page_body.line_shares(spark.createDataFrame(data, "id long, text string"))
    plain, dressed = shares(["la bord", "echipaj", page_rules.simple(notice), "own 7"])
    assert plain.tolist() == [30, 40, 700, 0] and dressed.tolist() == [1, 0, 0, 0]
    assert page_rules.is_plain(["la bord", "echipaj"], shares).tolist() == [False, True]
    assert not page_rules.is_plain(["x"], page_rules.Shares.of({"x": 12}, {}, 10_000))[0]


def test_held_out_agreement(spark, data):
    df = spark.read.parquet(f"{data}/raw_pages.parquet")
    pages = df.select(F.col("page_id").alias("id"), F.col("source").alias("url"), "text").where(F.col("text").rlike(r"\S"))
    model = page_body.PageModel.from_json(page_body.fit(pages, 20).to_json())
    held = pages.orderBy(F.xxhash64("id"), "id").offset(20).collect()
    lines, urls = [page_body.split(r.text)[1] for r in held], [r.url for r in held]
    x = page_rules.features(lines, urls, model.shares)
    truth = np.concatenate(page_rules.rule_labels(lines, urls, model.shares))
    got = page_body.decode(model.crf, np.split(x, np.cumsum([len(p) for p in lines])[:-1]))
    assert (np.concatenate(got) == truth).mean() > 0.97
    kept = page_body.body_lines(df, model=model)
    assert kept.where("not body").count() > 0 and kept.exceptAll(page_body.body_lines(df, model=model)).isEmpty()


def test_body_lines_edges(spark):
    data = [(1, PAGE, "https://x.example/lift-access-7.html"), (2, None, "u"), (3, "  \n ", "u"), (4, "\n".join([PAGE] * 400), None)]
    df = spark.createDataFrame(data, "page_id long, text string, source string").withColumn("id", F.lit(1)).withColumn("url", F.lit("clash")).drop("url")
    got = page_body.body_lines(df).groupBy("page_id").agg(F.count("*").alias("n")).collect()
    assert {r.page_id: r.n for r in got} == {1: 16, 4: 16 * 400}
    assert page_body.body_lines(df.where("false")).count() == 0
    assert {r.page_id for r in page_body.main_text(df).collect()} == {1, 2, 3, 4}


# --- 4: near-duplicates


def classes_by_force(texts, threshold=0.8):
    bags = {i: Counter(re.findall(r"[^\W_]+", t.lower())) for i, t in texts if t and re.search(r"[^\W_]", t)}
    parent = {i: i for i in bags}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(bags, 2):
        common, total = sum((bags[a] & bags[b]).values()), sum(bags[a].values()) + sum(bags[b].values())
        if 2 * common >= threshold * total:
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    size = Counter(map(top, bags))
    return {(i, top(i)) for i in bags if size[top(i)] > 1}


def edited(rng, text, vocabulary, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(vocabulary)
    rng.shuffle(w) if rng.random() < 0.1 else None
    return " ".join(w)


def test_classes_against_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}x" for i in range(400)]
    base = [" ".join(rng.choices(vocabulary, k=rng.randrange(40, 90))) for _ in range(60)]
    texts = list(enumerate(base + [edited(rng, rng.choice(base), vocabulary, rng.randrange(0, 5)) for _ in range(120)] + [None, "", " ", "...", "one", "One!", base[0].upper() + "."]))
    df = spark.createDataFrame([(i, t, *LOST[1:]) for i, t in texts], "chunk_no long, text string, class int, key string, line string, n int")
    assert {(r["id"], r["class"]) for r in near_duplicate_classes(df).collect()} == classes_by_force(texts)
    assert near_duplicate_classes(df.where("false")).count() == 0
    assert near_duplicate_classes(df.where("chunk_no < 5")).count() == len(classes_by_force(texts[:5]))


def test_links_do_not_depend_on_the_place_of_a_key():
    """Three rows of one key, the first near both others, which are near each other: alone, first and last in their partition."""
    bits = np.array([3, 3, 3, 1 << 40], np.int64)
    rows_ = lambda keys, ids: pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array([100] * len(ids), pa.int32()), *(pa.array(bits[: len(ids)]) for _ in range(3))], names=["key", "id", "n", "s0", "s1", "s2"])
    for batch in (rows_([5, 5, 5], [1, 2, 3]), rows_([5, 5, 5, 9], [1, 2, 3, 4])):
        out = [r for b in _links(iter([batch]), 0.8, 0.002) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert set(out) == {(1, 2), (1, 3), (2, 3)}


def test_rows_with_links(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "j i h g f e d c b a"), (3, "a b c d e f g h i x"), (4, "quite another text")], "chunk_no long, text string")
    assert set(rows(near_duplicate_rows(df))) == {(1, 1, 2), (2, 1, 1), (3, 1, 1)}


def test_hot_group_of_copies_and_edits(spark):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(3000)]
    hot = " ".join(rng.choices(vocabulary, k=80))
    data = [(i, hot) for i in range(1500)] + [(2000 + i, edited(random.Random(i), hot, vocabulary, 2)) for i in range(1500)] + [(9000 + i, " ".join(rng.choices(vocabulary, k=60))) for i in range(1500)]
    got = near_duplicate_classes(spark.createDataFrame(data, "chunk_no long, text string")).groupBy("class").count().collect()
    assert [(r["class"], r["count"]) for r in got] == [(0, 3000)]


def test_thinned_buckets_keep_groups():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, (2, 3)).astype(np.uint64)
    which = rng.integers(0, 2, 2500)
    noise = sum((np.uint64(1) << rng.integers(0, 64, (2500, 3)).astype(np.uint64)) for _ in range(3))
    rows_ = [np.zeros(2500, np.int64), np.arange(2500), np.full(2500, 100, np.int32), *((base[which] ^ noise)[:, i] for i in range(3))]
    least, certain = bounds(0.8 / 1.2, 0.002)
    pairs, stand = _large(rows_, least, certain, 0.8)
    linked = {x for a, b in pairs for x in (*a.tolist(), *b.tolist())}
    assert len(stand[0]) < 100 and len(linked) >= 2498 and _links and _bands
    i, j, _ = _agree(rows_, np.array([0]), np.array([1]), least, 0.8)
    assert (len(i) == 1) == (which[0] == which[1]) and len(j) == len(i)


def test_pairs_at_the_threshold_are_met_in_any_order(spark):
    rng = random.Random(8)
    vocabulary, data = [f"w{i}" for i in range(5000)], []
    for i in range(600):
        a = rng.sample(vocabulary, 100)
        b = [f"new{rng.randrange(9**9)}" if k in set(range(0, 100, 5)) else w for k, w in enumerate(a)]
        rng.shuffle(b) if i % 2 else None
        data += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    found = {r["id"] for r in near_duplicate_classes(spark.createDataFrame(data, "chunk_no long, text string")).collect()}
    assert all(sum(2 * i in found for i in range(odd, 600, 2)) >= 0.95 * 300 for odd in (0, 1))


def test_hot_bucket_keeps_chains_of_edits(spark):
    base = [f"w{i}" for i in range(100)]
    data, far = {}, {}
    for i in range(1200):
        data[i] = [*base[:-1], f"own{i}"]
    for k in range(150):
        step = [*base[:-2], f"b{k}", f"c{k}"]
        data[2000 + k], data[4000 + k] = step, [f"d{k}x{j}" if j % 5 == 0 and j < 95 else w for j, w in enumerate(step)]
        far[4000 + k] = 2000 + k
    near = {a: [b for b in data if b != a and 2 * len({*data[a]} & {*data[b]}) >= 0.8 * 200] for a in far}
    assert near == {a: [b] for a, b in far.items()}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in data.items()], "chunk_no long, text string")
    got = {r["id"]: r["class"] for r in near_duplicate_classes(df).collect()}
    assert all(got.get(i) == 0 for i in data if i < 4000) and sum(got.get(a) == 0 for a in far) >= 0.95 * len(far)


def test_bounds_grow_and_words():
    least, certain = bounds(2 / 3, 0.002)
    assert least == sorted(least) and 32 < least[0] < 64 and least[-1] < certain <= 192
    doc, code, vocabulary = words(pa.array(["A a, b", None, "", "b"]))
    assert [vocabulary[int(c)].as_py() for c in code] == ["a", "a", "b", "b"] and doc.tolist() == [0, 0, 0, 3] and occurrence(doc, code).tolist() == [0, 1, 0, 0]


# --- 7: residue


@pytest.mark.parametrize(
    "text",
    ["Hello {{ name }}, welcome.", "Call [[assistance_type]] now", "Fee: ${fee}", "Dear undefined, your flight is late.", "The desk in [object Object] is open.", "Phone: null", "Opening %HOURS% today", "TBD TBD TBD", "At <flight_no> we wait", "Meet &lt;deskHours&gt; there"],
)
def test_placeholders(text):
    assert residue_rules.placeholder.search(text) or residue_rules.missing.search(text)


@pytest.mark.parametrize("text", ["Write the name in braces, for example {Tarmovik}.", "Fees are 50 % or 10 % [see table 2] and <5 kg is free.", "Passengers named None or Null should tell us.", "If undefined terms appear in the permit, ask.", "The word placeholder on a card."])
def test_content_that_looks_like_it(text):
    assert not residue_rules.placeholder.search(text) and not residue_rules.missing.search(text) and residue_rules.label(text) == residue_rules.OTHER


def test_residue_rows(spark):
    body = "Passengers with reduced mobility are met at the lift by the staff every day."
    data = [
        (1, body, None), (2, body + " Lorem ipsum dolor sit amet, consectetur adipiscing elit.", None), (3, "404 Page not found\nGo home", None), (4, 'If the tool shows "404 page not found", call the desk. ' + body, None),
        (5, None, f"<html><body><noscript>Please enable JavaScript.</noscript><p>{body}</p><div hidden>404 not found</div></body></html>"), (6, "", "<html><body><noscript>Please enable JavaScript to continue.</noscript></body></html>"),
        (7, None, None), (8, " ", ""), (9, "Access denied. " + body, None), (10, "Tarvik Airport\nPleaze enable JavaScript to continue using our site", None), (11, "Hi {{name}}", None), (11, body * 3000, None), (None, "Error 503", None),
    ]
    df = spark.createDataFrame([(*d, "x", 1) for d in data], "scrape_id long, text string, html string, mask string, label int")
    assert {(r.scrape_id, r.reason) for r in residue.residue_rows(df).collect()} == {(2, "filler"), (3, "message"), (6, "message"), (10, "message"), (11, "placeholder"), (None, "message")}
    assert residue.residue_rows(df.where("false")).count() == 0


def test_likeness_carries_labels(spark):
    known = "Our little web page is having a tiny rest right now, scheduled maintenance until nine"
    near = known.replace("scheduled maintenance", "scheduled maintenence")
    assert residue_rules.label(known) == residue_rules.MESSAGE and residue_rules.label(near) == residue_rules.OTHER
    df = spark.createDataFrame([(1, known, None), (2, near, None), (3, "A quiet sentence about lifts and ramps", None)], "scrape_id long, text string, html string")
    assert {r.scrape_id for r in residue.residue_rows(df).collect()} == {1, 2}


def test_likeness_goes_as_far_as_its_chain(spark):
    """Each text differs from the next by a word; labels reach the last, however many links away, and passages of any length."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("bdfghkvwz", k=3)) + "o" + "".join(rng.choices("bdfghkvwz", k=3))
    chain = [["lorem", "ipsum", *(word() for _ in range(90))]]
    for k in range(24):
        chain.append([word() if i // 3 == k else w for i, w in enumerate(chain[-1])])
    data = [(k, " ".join(w), None) for k, w in enumerate(chain)] + [(99, "A quiet sentence about lifts and ramps", None)]
    got = {r.scrape_id: r.by for r in residue.residue_rows(spark.createDataFrame(data, "scrape_id long, text string, html string")).collect()}
    assert got == {k: "rule" if k == 0 else "likeness" for k in range(25)}


def simhash_by_force(mask):
    _, gram = residue.grams([mask])
    h = residue.mix(gram)
    return sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > len(h))


def test_every_near_passage_is_met():
    rng = random.Random(5)
    vocabulary = ["lift", "ramp", "desk", "page", "error", "missing", "server", "please", "return", "later", "access", "blocked", "service", "closed", "shortly", "today"]
    masks = [" ".join(rng.choices(vocabulary, k=rng.randrange(6, 14))) for _ in range(400)]
    edits = [" ".join(rng.choice(vocabulary) if i == at else w for i, w in enumerate(m.split())) for m in masks for at in [rng.randrange(len(m.split()))]]
    both = [residue.grams(x) for x in (masks, edits)]
    text = lambda m: {f" {m} "[i : i + 4] for i in range(len(m) - 1)}
    like = [len(text(x) & text(y)) >= residue.SIMILARITY * len(text(x) | text(y)) for x, y in zip(masks, edits)]
    near = [i for i in range(400) if like[i] and masks[i] != edits[i]]
    assert [len(text(m)) for m in masks] == np.bincount(both[0][0]).tolist()
    every = np.sort(both[0][1])
    common = np.unique(every, return_counts=True)
    for order in (None, common):
        tables = [[{*k} for k in residue.prefixes(*g, 400, order).to_pylist()] for g in both]
        assert len(near) > 30 and all(tables[0][i] & tables[1][i] for i in near)
    a, b = (residue.simhashes(*g, 400) for g in both)
    assert [int(x) for x in a[:20]] == [simhash_by_force(m) for m in masks[:20]]
    far = [int(a[i] ^ b[i]).bit_count() for i in near]
    assert sum(d <= residue.HAMMING for d in far) >= 0.95 * len(far)
    assert residue.grams([""])[0].tolist() == [0] and len(residue.prefixes(np.zeros(0, np.int64), np.zeros(0, np.uint64), 0)) == 0


def test_visible():
    assert visible.visible("<head><title>t</title></head><nav>menu</nav><p>One <b>two</b></p><div style='display: none'>x</div><footer>f</footer>") == "One two"
    assert visible.visible("<nav>menu</nav><noscript>Turn on scripts</noscript>") == "Turn on scripts"


# --- 8: tokenizer


@pytest.fixture(scope="module")
def ranks():
    if not os.path.exists(tokenizer.RANKS):
        pytest.skip("no vocabulary here")
    return tokenizer.Ranks(open(tokenizer.RANKS, "rb").read())


TEXTS = ["", None, "Hello world", "aaaaaaaaa" * 50, "  two  spaces\n\n\ttab", "don't we'll 12345 ăîșț €", "🛫🧑‍🦽 مساعدة", "<|endoftext|>", " " * 500, "x" * 3000, "ab" * 999]


def test_ids_against_library(ranks, spark):
    tk = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer.RANKS.replace(".tiktoken", ".json"))
    tk.encode_special_tokens = True
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("ids", F.lit(1))
    got = {r.doc_id: r.ids for r in tokenizer.encode(df).collect()}
    assert got == {i: tk.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(TEXTS)}
    assert tokenizer.encode(df.where("false")).count() == 0


def test_long_text_is_cut_between_words_only(ranks, monkeypatch):
    long = " ".join(random.Random(1).choices(["lift", "wheelchair", "überall", "42"], k=3000))
    whole = tokenizer.encode_batch(ranks, [long, ""])
    monkeypatch.setattr(tokenizer, "CHARS", 1000)
    parts = tokenizer.encode_batch(ranks, [long])
    assert whole[0].tolist() == parts[0].tolist() and parts[1].tolist() == [0, len(parts[0])]


# --- 9: leakage


def leaks_by_force(docs, items):
    w = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for d, text in docs:
        have = w(text)
        grams = {tuple(have[k : k + 5]) for k in range(len(have) - 4)}
        for i, p, q in items:
            for needle, least in ((w(p), leakage.PASSAGE), (w(q), leakage.QUESTION)):
                covered = {k + j for k in range(len(needle) - 4) if tuple(needle[k : k + 5]) in grams for j in range(5)}
                if needle and len(covered) / len(needle) >= least - 1e-9 and covered:
                    out.add((d, i))
    return out


def test_leaks_against_brute_force(spark):
    rng = random.Random(7)
    v = [f"word{i}" for i in range(500)]
    say = lambda n: " ".join(rng.choices(v, k=n))
    items = [(f"I{i}", say(80), say(24)) for i in range(12)] + [("I0", "again " + say(50), None), ("short", "a b", ""), (None, say(30), say(30))]
    docs = [(i, say(rng.randrange(3, 1500))) for i in range(60)]
    for i in range(60, 120):
        _, p, q = rng.choice(items[:12])
        w = p.split()
        cut = rng.randrange(15, 80)
        docs.append((i, " ".join([say(rng.randrange(5, 1200)), rng.choice([p, q, " ".join(w[:cut]), " ".join(w[:cut][:20] + ["edit"] + w[21:cut]).upper().replace(" ", ",\n")]), say(rng.randrange(5, 900))])))
    docs += [(200, None), (201, ""), (202, docs[70][1]), (203, docs[70][1])]
    dd = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, item string")
    di = spark.createDataFrame([(i, p, q, "x") for i, p, q in items], "item_id string, passage string, question string, doc string")
    assert set(rows(leakage.leaked_items(dd, di))) == leaks_by_force(docs, [x for x in items if x[0]])
    assert leakage.leaked_items(dd.where("false"), di).count() == 0 == leakage.leaked_items(dd, di.where("false")).count()


def test_common_phrases_are_no_leak(spark):
    sentences = [f"by article {i} whoever stored the {w} at {w}ville had already paid for the {w} quay" for i, w in enumerate(["red", "blue", "old", "new", "wet"])]
    item = " ".join(sentences)
    other = " and then ".join(f"by article 9{i} whoever stored the {w} thing at town {i} had already paid for the rest of it" for i, w in enumerate(["green", "grey", "big", "low", "dry"]))
    items = spark.createDataFrame([("I", item, None)], "item_id string, passage string, question string")
    docs = spark.createDataFrame([(1, other), (2, "so " + item[: len(item) // 2] + " end")], "doc_id long, text string")
    assert rows(leakage.leaked_items(docs, items)) == [(2, "I")]


@pytest.mark.parametrize("size", range(4, 16))
def test_whole_questions_of_any_length(spark, size):
    question = " ".join(f"ask{i}" for i in range(size))
    docs = spark.createDataFrame([(1, "some text before it " + question.upper() + "? and more words behind"), (2, " ".join(question.split()[: size // 2]) + " and nothing else of it"), (None, question)], "doc_id long, text string")
    items = spark.createDataFrame([("I", None, question)], "item_id string, passage string, question string")
    assert rows(leakage.leaked_items(docs, items)) == ([(1, "I")] if size >= leakage.SHINGLE else [])


def test_candidates_prune_and_do_not_depend_on_what_is_known(spark, monkeypatch):
    rng = random.Random(11)
    v = [f"word{i}" for i in range(300)]
    say = lambda n: " ".join(rng.choices(v, k=n))
    phrase = "in the terms of carriage"
    items = [(f"I{i}", say(40) + " " + phrase + " " + say(40), None) for i in range(40)]
    docs = [(i, say(rng.randrange(50, 1500)) + " " + phrase) for i in range(150)] + [(1000 + i, " ".join([say(700), " ".join(items[i % 40][1].split()[5:45]), say(rng.randrange(1, 600))])) for i in range(150)]
    dd = spark.createDataFrame(docs, "doc_id long, text string")
    di = spark.createDataFrame(items, "item_id string, passage string, question string")
    needles = leakage.needles_of(di, "item_id", "passage", "question")
    of = {r.needle: r["item"] for r in needles.collect()}
    source = dd.select(F.col("doc_id").alias("doc"), "text")
    met = {(r.doc, of[r.needle]) for r in leakage.candidates(source, needles).collect()}
    want = {(1000 + i, f"I{i % 40}") for i in range(150)}
    shared = 150 * 40 + 150  # pairs with a common shingle at least
    assert len(want - met) <= 1 and len(met) < 0.3 * shared
    found = set(rows(leakage.leaked_items(dd, di)))
    assert found == want & met
    monkeypatch.setattr(leakage, "KNOWN", 10)
    assert {(r.doc, of[r.needle]) for r in leakage.candidates(source, needles).collect()} == met
    assert set(rows(leakage.leaked_items(dd, di))) == found


def test_needed_shingles():
    assert leakage.needed(80, 0, 0.4) == (2, False) and leakage.needed(5, 0, 0.75) == (1, True) and leakage.needed(24, 0, 0.75)[1]


# --- 10: keyword spam


KEYWORDS = [a + b for a in ("vol", "tar", "jor", "pel", "zum", "hex") for b in ("ba", "de", "ki")]


def test_spam_shares(spark):
    real = "The lift in the hall is open to all passengers who need it. Ask at the desk if you want to be met by the staff before the flight. We will help you with the bags and with the way to the gate. "
    data = [
        (1, real * 3), (2, "cheap wheelchair taxi Tarvik, wheelchair taxi hire, taxi wheelchair Tarvik, best wheelchair taxi, wheelchair taxi price, wheelchair taxi Tarvik deal, wheelchair taxi Tarvik review"),
        (3, "\n".join(f"https://x{i}.example/wheelchair-taxi-{i}" for i in range(20))), (4, real + real + "More at https://a.example/page"), (5, None), (6, ""), (7, "wheelchair taxi wheelchair taxi"), (8, "x" * 500), (9, "#wheelchair_taxi #taxi_hire " * 20),
        (12, " ".join(f"{w}ra {w}lo {w}mi" for w in KEYWORDS) * 3), (13, ", ".join(f"{w}stad" for w in KEYWORDS * 3)), (14, "\n".join(["Wheelchair taxi"] * 40)), (15, "Где находится лифт для пассажиров " * 9),
        (10, "\n".join(f"Tarvik | help desk | +99 12{i} 4567 | 08:00-12:00" for i in range(20))), (11, ("To use the lift wheelchair taxi Tarvik wheelchair taxi hire cheap taxi. ") * 9), (2, "cheap wheelchair taxi Tarvik, wheelchair taxi hire, taxi wheelchair Tarvik, best wheelchair taxi, wheelchair taxi price, wheelchair taxi Tarvik deal, wheelchair taxi Tarvik review"),
    ]
    df = spark.createDataFrame([(*d, "xx", 1.0) for d in data], "doc_id long, text string, lang string, share double")
    assert {r.doc_id for r in spam_shares(df).where("share > 0.5").collect()} == {2, 3, 9, 11, 12, 13, 14, 15}
    assert spam_shares(df).where("doc_id = 2").count() == 2 and spam_shares(df.where("false")).count() == 0


def test_queries_run(spark, data):
    from doclathe.llm.queries import QUERIES

    want = {"p1_found": ["page_id", "line_no"], "p2_found": ["entity_id", "ref_id"], "p3_found": ["page_id", "line_no"], "p4_found": ["chunk_a", "chunk_b"], "p4_classes": ["chunk_no", "class", "links"], "p7_found": ["scrape_id"], "p8_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id"]}
    for name, columns in want.items():
        got = QUERIES[name](spark, data)
        assert got.columns == columns and got.count() == got.distinct().count()
