"""Text rules at their boundaries."""

import pytest
from pyspark.sql import functions as F

from doclathe.functions import quality as Q
from doclathe.functions import text as T


@pytest.fixture()
def ev(spark):
    def run(f, *texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r[0] for r in df.orderBy("i").select(f(F.col("t"))).collect()]

    return run


def test_headings(ev):
    yes = ["# Title", "What is this?", "ALL CAPS LINE", "Opening hours:", "1.2. Access", "Lounge Access In Town", "Fees"]
    no = ["", "{", '"key": "v",', "this is prose", "x" * 120 + "?", "A" + "b" * 99 + ":", "We call the passenger", "10 kg and more", "10", None]
    assert ev(T.is_heading, *yes) == [True] * len(yes)
    assert ev(T.is_heading, *no) == [False] * (len(no) - 1) + [None]


def test_fragments_and_truncation(ev):
    assert ev(T.is_fragment, "}", ") rest", "lower", "Upper", "", '"a_b": 3,', "început") == [True, True, True, False, False, True, True]
    assert ev(T.is_truncated, "", "ends here.", "ends with the", "ends with months", "in 2024", "About Rome", "quote’") == [True, False, True, True, False, False, False]


def test_clean_text(ev):
    assert ev(T.clean_text, '"body": "Hello",\n## Head\nSource: https://x.y z\n────\n--- ---\na  b – “q” ‘s’ it’s\\nnext') == ["Hello\nHead\n z\n\na b - \"q\" 's’ it’s next"]
    assert ev(T.normalize_text, "One. Two! Three\nFour", None, "") == ["One.\n\nTwo!\n\nThree\n\nFour", None, ""]


def test_sections_and_urls(ev):
    assert ev(T.clean_section, "## Fees", "https://a.b/c/extra-fees/", "https://a-b.c/", "", None, "Source: http://x y") == ["Fees", "extra fees", "a b.c", "General", "General", "y"]
    assert ev(T.domain, "https://a.b/c", "plain", None) == ["a.b", "plain", None]
    assert ev(lambda c: T.path_part(c, 2), "https://a.b/en/x/y", "https://a.b") == ["x", ""]
    assert ev(T.last_segment_title, "https://a.b/c/lost-and_found.html") == ["Lost And Found"]


def test_gate_lengths_and_phrases(ev):
    long = "word " * 40
    got = ev(Q.reason, None, " ", "x" * 149, "x" * 150, long + "Page Not Found", "y" * 1001 + " page not found", long + "please log in", "\n".join(["a b"] * 16) + "z" * 120, "\n".join(f"line of text number {i}" for i in range(10)) + "\nsame line here" * 6, "\n".join(f"line of text number {i}" for i in range(6)) + "\nsame line here" * 5)
    assert got == ["empty", "empty", "too_short", "ok", "soft_404", "ok", "paywall", "noise_ratio", "repetition", "ok"]
    assert ev(Q.detail, "x" * 20, long + "404 error and page not found") == ["20", "page not found"]


def test_structural_lines_do_not_count(ev):
    assert ev(lambda c: F.size(Q.lines(c)), "a\n| |\n---\n b\r\nc") == [3]
    assert ev(Q.top_count, "a\nb\na", "|", "") == [2, 0, 0]


def test_pdf_lines(ev):
    flags = lambda name: (lambda c: T.pdf_line_flags(c)[name])
    assert ev(flags("chart"), "50%x", "50%", "1% 2% 3% 4%") == [True, False, True]
    assert ev(flags("numeric"), "", "1 2 three", "one two three 4") == [True, True, False]
    assert ev(flags("reference"), "Smith, J. 2001", "in the year 2001 " + "w " * 12, "a, b, c 1234") == [True, False, True]
    assert ev(flags("ocr"), "T x i s", "plain words here", "ă b c d") == [True, False, True]
    assert ev(T.pdf_clean, "Good line of text here\nTable of contents\n12\nAnother  good line", None) == ["Good line of text here\nAnother good line", None]


def test_page_clean_keeps_first(ev):
    assert ev(lambda c: T.page_clean(c, True), "Yes.\nNo.\nYes.\nab\nBIG TITLE") == ["Yes.\nNo.\n\n## BIG TITLE\n"]
    assert ev(T.page_clean, "short\nthis line is long enough to stay") == ["this line is long enough to stay"]


def test_classifier_order_and_words(ev):
    run = lambda c: T.classify(c, T.TRAVEL_RULES, "none")
    assert ev(run, "my complaint about policy", "The RULE.", "unruly", "how to board", None, "") == ["Discrimination & Complaints", "Regulatory Reference", "none", "Passenger Tips & Advice", "none", "none"]


def test_small_rules(ev):
    assert ev(T.language, "x el y", "x de y", "x", "", None) == ["es", "pt", "en", "unknown", "unknown"]
    assert ev(T.decode_text, "\\u003cb\\u003e &amp;eacute;", "plain", None) == ["<b> &eacute;", "plain", None]
    assert ev(T.type_key, " Quiet Room ", " ", None) == ["quiet_room", None, None]
    assert ev(T.is_json, " [1] ", "{a", None) == [True, False, False]
    assert ev(T.failure, None, "captcha", "x" * 999, "x" * 1000) == ["no response", "bot detection", "near-empty response", "structure not recognised"]
    assert ev(lambda c: T.content_hash(c, F.lit(None)), " A ", "a", None)[0:2] == ev(lambda c: T.content_hash(c, F.lit("")), "a", "A")


def test_very_long_text(ev):
    long = "A sentence of a very long text. " * 40_000
    assert ev(lambda c: F.size(T.paragraphs(c)), long) == [40_000]
    assert ev(Q.reason, long) == ["ok"]
