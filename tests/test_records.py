import hashlib
import random

from conftest import rows
from pyspark.sql import functions as F

from doclathe.operators import chunking as C
from doclathe.operators import records as R


def test_keep_first_with_ties_nulls_and_clashing_names(spark):
    data = [(1, None, "b", 0, 0), (1, None, "a", 0, 1), (2, "x", "c", 1, 2), (2, "x", "d", 0, 3), (3, "x", "e", None, 4)]
    df = spark.createDataFrame(data, "k int, s string, v string, no int, `__row` int")
    assert rows(R.keep_first(df, ["k", "s"], ["no", "v"]).select("k", "v")) == [(1, "a"), (2, "d"), (3, "e")]
    assert rows(R.keep_first(df, ["k"], ["no", "v"], last=True).select("k", "v")) == [(1, "b"), (2, "c"), (3, "e")]
    assert R.keep_first(df.where("false"), ["k"], ["no"]).count() == 0
    once = R.keep_first(df, ["k", "s"], ["no", "v"])
    assert rows(R.keep_first(once, ["k", "s"], ["no", "v"])) == rows(once)


def test_batches_and_numbers(spark):
    rng = random.Random(1)
    data = [("hot" if i % 3 == 0 else f"s{i % 7}" if i % 11 else None, i) for i in rng.sample(range(3000), 900)]
    got = rows(R.batches(spark.createDataFrame(data, "s string, i int"), ["s"], ["i"], 30))
    groups = {}
    for s, i in data:
        groups.setdefault(s, []).append(i)
    want = [(s, i, n, n // 30) for s, ids in groups.items() for n, i in enumerate(sorted(ids))]
    assert got == sorted(want, key=repr)
    ids = rows(R.resequence(spark.createDataFrame([(i,) for i in rng.sample(range(5000), 1200)], "n int"), ["n"]).select("n", "rule_id"))
    assert [r for _, r in sorted(ids)] == [f"R{i:03d}" for i in range(1, 1201)]


def test_chunks_by_hand(spark):
    text = "# Intro Part\nThe first sentence of it. lower case fragment. The second sentence of it.\nFees:\n- one item\n- two items.\n" + "The " + "b" * 90 + " end."
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "Only a cut off wor")], "d int, t string")
    got = [tuple(r) for r in C.semantic_chunks(df, ["d"], "t", size=80).orderBy("d", "chunk_no").select("d", "section", "text").collect()]
    assert got == [(1, "Intro Part", "The first sentence of it. The second sentence of it."), (1, "Fees:", "The " + "b" * 90 + " end."), (1, "Fees:", "- one item - two items.")]
    ids = {r.text: r.id for r in C.semantic_chunks(df, ["d"], "t", size=80).collect()}
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert ids[got[0][2]] == md5("The first sentence of it.\n\nThe second sentence of it.") and ids[got[2][2]] == md5(got[2][2])


def plain_fold(parts, size):
    """The fold as text, one paragraph at a time."""
    out, cur, sec = [], "", "General"
    for p in parts:
        if p["kind"] == "H":
            if cur:
                out.append((sec, cur, "h"))
            cur, sec = "", p["section"]
        elif p["kind"] == "L":
            out.append((sec, p["text"], "l"))
        elif p["kind"] == "B":
            if len(cur + p["text"] + "\n") > size and cur:
                out.append((sec, cur, "f"))
                cur = ""
            cur += p["text"] + "\n"
        else:
            if len(cur) + len(p["text"]) + 2 > size and cur:
                out.append((sec, cur, "f"))
                cur = ""
            cur += p["text"] + "\n\n"
    return out + ([(sec, cur, "f")] if cur else [])


def test_fold_against_plain_text():
    rng = random.Random(3)
    for _ in range(300):
        parts = [{"kind": k, "text": "x" * rng.randrange(1, 130 if k == "L" else 60), "section": "S"} for k in rng.choices("HBLP", k=rng.randrange(12))]
        assert C._fold(parts, 100, False) == plain_fold(parts, 100)
    parts = [{"kind": "P", "text": "a", "section": None}, {"kind": "L", "text": "b" * 200, "section": None}]
    assert [c[1] for c in C._fold(parts, 100, True)] == ["a\n\n", "b" * 200]


def plain_pack(parts, size):
    out, cur, n = [], None, 0
    for p in parts:
        if cur is not None and n + len(p) <= size:
            cur, n = cur + "\n\n" + p, n + len(p)
        else:
            out += [] if cur is None else [cur]
            cur, n = p, len(p)
    return out + ([] if cur is None else [cur])


def test_packs_against_plain_lists(spark):
    rng = random.Random(4)
    texts = ["\n\n".join("y" * rng.randrange(1, 40) for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.p for r in df.select("i", C.pack_text(F.col("t"), 50).alias("p")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == ([t] if len(t) <= 50 else plain_pack([p for p in t.split("\n\n") if p.strip()], 50))


def test_blocks_and_sections(spark):
    df = spark.createDataFrame([(1, 0, "A", "one"), (1, 1, "A", "two"), (1, 2, None, "ONE "), (1, 3, "B", "three")], "d int, pos int, heading string, text string")
    assert C.flatten_blocks(df, ["d"], "pos").first().text == "A\n\none\n\ntwo\n\nONE \n\nB\n\nthree"
    assert [r.pos for r in C.dedupe_blocks(df, ["d"], "pos").orderBy("pos").collect()] == [0, 1, 3]
    page = spark.createDataFrame([(1, "lost text\nWhat now?\nfirst\nsecond\nEMPTY\nMore Titles\nthird"), (2, None)], "d int, text string")
    assert rows(C.sections(page, ["d"])) == [(1, 1, "What now?", "first\nsecond"), (1, 3, "More Titles", "third")]
    assert C.assemble(page.where("false").withColumn("section", F.lit("s")), ["d"], ["text"]).count() == 0
