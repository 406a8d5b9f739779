import json
import sys

import numpy as np
from pyspark.sql import functions as F

from sheafmill import fixed
from sheafmill.functions import text as tx
from sheafmill.operators import corpus

WHITESPACE = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()]

TEXTS = [
    "", "plain", 'say "hi"', "back\\slash", "tab\there", "line\nend\r", "\x01\x0b\x1f", "\x1f\\u001F\x1f",
    "\\\\u001F", "\\\x1f", "\b\f", "\x7f", "é 你好 😀", "/", " ", "\\u000B\x0b\\\x0b", "'", "<&>",
    "".join(map(chr, range(0, 160))), "\x1a\x1b\x1c\x1d\x1e\x1f" * 3,
]


def values(df):
    return [r[0] for r in df.collect()]


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema).coalesce(1)


def test_strip_takes_every_unicode_space(spark):
    texts = [f"{w}a{w}b{w}" for w in WHITESPACE] + ["".join(WHITESPACE), "x", "", "\u200bx\u200b"]
    got = values(table(spark, [(t,) for t in texts], "t string").select(tx.strip("t")))
    assert got == [t.strip() for t in texts]
    assert set(fixed.STRIP_CHARS) == set(WHITESPACE)


def test_json_string_equals_json_dumps(spark):
    got = values(table(spark, [(t,) for t in TEXTS], "t string").select(tx.json_string("t")))
    assert got == [json.dumps(t, ensure_ascii=False) for t in TEXTS]


def plain_rule(title, body):
    lines = [(title or "").strip(), (body or "").strip()]
    if lines[1] in fixed.REMOVED_BODIES:
        lines.pop()
    return "\n".join(filter(None, lines))


def json_rule(title, body):
    title, body = (title or "").strip(), (body or "").strip()
    if not body or body in ("[removed]", "[deleted]"):
        fields = {"confession": title} if title else None
    else:
        fields = {"title": title, "confession": body} if title else {"confession": body}
    return json.dumps(fields, ensure_ascii=False) if fields else ""


POSTS = [
    (t, b)
    for t in [None, "", " ", "A title", 'q"t', "\u3000wide\u3000"]
    for b in [None, "", "body", "[removed]", " [deleted]\n", "[Removed]", "two\nlines \x1f end"]
]


def test_documents_follow_the_rules(spark):
    posts = table(spark, [(i, *p) for i, p in enumerate(POSTS)], "i int, title string, selftext string")
    as_json = {r["i"]: r["text"] for r in corpus.combine_json(posts).collect()}
    as_plain = {r["i"]: r["text"] for r in corpus.combine_plain(posts).collect()}
    for i, post in enumerate(POSTS):
        assert as_json[i] == json_rule(*post), post
        assert as_plain[i] == plain_rule(*post), post


def test_length_bounds_are_inclusive_and_measured_on_the_document(spark):
    frame = len(json_rule("", "x")) - 1
    sizes = [39, 40, 2000, 2001]
    posts = table(spark, [("", "y" * (n - frame)) for n in sizes] + [("", '"' * 1000)], "title string, selftext string")
    kept = values(corpus.clean(posts).select(F.char_length("text")))
    assert sorted(kept) == [40, 2000]


def test_cuts(spark):
    texts = ["a" * n for n in (42, 45, 46, 800, 801)]
    rows = table(spark, [(t,) for t in texts], "t string").select(tx.chart_label("t"), tx.sample_text("t")).collect()
    assert [len(r[0]) for r in rows] == [42, 45, 45, 45, 45]
    assert rows[2][0] == "a" * 42 + "..."
    assert rows[3][1] == texts[3] and rows[4][1] == "a" * 800 + "...[truncated]"


def test_numbers_and_status(spark):
    cells = ["1.5", " 2 ", "x", None, "NaN", "1e-3", ""]
    assert values(table(spark, [(c,) for c in cells], "c string").select(tx.number("c"))) == [1.5, 2.0, None, None, None, 0.001, None]
    labels = [" keep ", "Crash", "keep-sa", None]
    got = values(table(spark, [(c,) for c in labels], "c string").select(tx.status_label("c")))
    assert got == ["KEEP", "CRASH", "KEEP-SA", None]


def test_display_bytes_counts_malformed_parts(spark):
    tokens = [b"a", "é".encode(), b"\xc3", b"\xe4\xbd", b"\xff\xfe", b"a\xf0\x9f\x98", b"\x80\x80", b""]
    got = values(table(spark, [(bytearray(t),) for t in tokens], "t binary").select(tx.display_bytes("t")))
    assert got == [len(t.decode("utf-8", "replace").encode()) for t in tokens]


def test_percent_and_bar(spark):
    share = table(spark, [(0.5,), (0.019,), (1.0,)], "s double")
    rows = share.select(tx.percent_text(F.col("s")), tx.bar_text(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [("50.0%", "█" * 25), ("1.9%", ""), ("100.0%", "█" * 50)]


def test_bits_per_byte(spark):
    row = table(spark, [(10.0, 4), (1.0, 0)], "n double, b long").select(tx.bits_per_byte(F.col("n"), F.col("b")))
    got = values(row)
    assert np.isclose(got[0], 10 / (np.log(2) * 4)) and got[1] is None


def test_no_python_in_document_plan(spark):
    posts = table(spark, [("a", "b")], "title string, selftext string")
    plan = corpus.clean(posts)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
