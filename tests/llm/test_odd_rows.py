"""Every operator over nulls, empty and very long texts, repeats, an empty table and clashing columns."""

import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_operators import gapless
from sheafmill.llm import (
    byte_bpe, exact_dedup, html_text, packing, private_terms, quality_rules, sharding, simhash, suffix_dedup,
    token_counts,
)

TABLE = sharding.fill(sharding.names(3), 13)
OPERATORS = {
    "exact_dedup": exact_dedup.exact_dedup,
    "token_counts": token_counts.edit_counts,
    "suffix_dedup": suffix_dedup.remove_repeats,
    "sharding": lambda docs: sharding.place(docs, TABLE).select("doc_id", F.xxhash64("doc_id") % 13),
    "packing": packing.pack_documents,
    "simhash": simhash.near_duplicates,
    "private_terms": private_terms.report,
    "byte_bpe": byte_bpe.round_trip,
    "quality_rules": lambda docs: quality_rules.quality_rules(docs, None),
}


def plain(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(name, odd, odd_clashing, nothing):
    apply = OPERATORS[name]
    rows = apply(odd)
    assert rows.select("doc_id").distinct().count() == 10  # nine ids and the null
    if name == "packing":  # sequence numbers may differ from run to run
        keep = ("doc_id", "piece", "start", "length", "ids_crc32")
        assert plain(rows.select(*keep)) == plain(apply(odd_clashing).select(*keep))
    else:
        assert rows.count() == 11
        assert plain(rows) == plain(apply(odd_clashing))
    assert apply(nothing).count() == 0


def test_odd_pages(spark):
    rows = [
        (1, "u", None), (1, "u", None), (None, None, ""), (3, "u", "<p"), (4, "u", "plain"), (5, "u", "<script>x"),
        (6, "u", "<article><p>" + "the word of it " * 20_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = {(r.page_id, r.text[:9], r.n_chars) for r in html_text.extract(pages).collect()}
    assert got == {
        (1, "", 0), (None, "", 0), (3, "", 0), (4, "", 0), (5, "", 0), (6, "the word ", 299_999),
    }
    assert html_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stages_on_odd_rows(spark, number, odd, odd_clashing, nothing, sf_dir):
    name, stage = corpus_pipeline.STAGES[number]
    out = stage(spark, odd_clashing, sf_dir)
    if number < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == odd_clashing.columns
        assert out.schema["doc_id"].dataType == odd.schema["doc_id"].dataType
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in out.select("doc_id").collect())
    every = sorted((r[0] is None, r[0] or 0) for r in odd.select("doc_id").collect())
    expected = {
        "quality_rules": [],  # too short, or repetitive
        "exact_dedup": [(False, 4), (False, 5), (False, 7), (False, 8), (False, 9), (True, 0)],
        "private_terms": every,
        "best_fit_packing": every,
        # 1, -4 and both 5 are one group; 2, 3 and 4 another; the rest stand alone
        "simhash_near_dedup": [(False, -4), (False, 2), (False, 7), (False, 8), (False, 9), (True, 0)],
    }[name]
    if name == "best_fit_packing":  # pieces of 4,096 tokens at most, every document there
        assert sorted(set(ids)) == sorted(set(expected))
        gapless(out.toPandas())
    else:
        assert ids == expected
    assert stage(spark, nothing, sf_dir).count() == 0


def test_places_keep_clashing_columns(odd_clashing, odd):
    placed = sharding.place(odd_clashing.withColumn("shard", F.lit("mine")), TABLE)
    assert placed.columns[-2:] == ["_slot", "_shard"]
    assert {(r.slot, r.shard) for r in placed.collect()} == {("other", "mine")}
    own = sharding.place(odd, TABLE)
    assert plain(placed.select("doc_id", "_slot", "_shard").toDF("doc_id", "slot", "shard")) == plain(own.select("doc_id", "slot", "shard"))


def written(df, tmp_path):
    df.repartition(3).write.parquet(str(tmp_path / "docs"))
    return str(tmp_path / "docs")


def test_dedup_stages_go_by_rows_not_ids(spark, sf_dir, tmp_path):
    """Rows that share or lack an id stay and go by their texts alone."""
    rows = [
        (None, "alpha"), (None, "beta"), (7, "gamma"), (7, "delta"), (1, "alpha"), (5, "alpha"), (5, "beta longer"),
        (3, "be ta"), (9, "g amma "), (None, "alpha"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = corpus_pipeline.exact(spark, docs, sf_dir)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(1, "alpha"), (3, "be ta"), (5, "beta longer"), (7, "delta"), (9, "g amma ")], key=repr)
    stored = spark.read.schema(docs.schema).parquet(written(docs, tmp_path))  # known by file and place
    assert corpus_pipeline.numbered(stored).select(corpus_pipeline.ROW).distinct().count() == 10
    assert plain(corpus_pipeline.exact(spark, stored, sf_dir)) == plain(out)
    long = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, long), (None, long.upper()), (4, long + "\n"), (4, "quite another text altogether"), (None, "a third one")]
    out = corpus_pipeline.near(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(4, long + "\n"), (4, "quite another text altogether"), (None, "a third one")], key=repr)


def timed(limit, work):
    started = time.time()
    out = work()
    assert time.time() - started < limit
    return out


def test_long_odd_texts_take_seconds():
    count = token_counts.counter()
    for text, mails in (("x" * 1_000_000, 0), ("a@b" + ".c" * 300_000, 1), ("a@" * 300_000, 0), (" " * 1_000_000, 0)):
        edits = timed(10, lambda text=text: token_counts.release_edits(text, None))
        assert len(edits) == mails + 1
    timed(10, lambda: token_counts.Tree(count, " " * 1_000_000))
    for data in (b" " * 1_000_000, b" \n" * 500_000, b"x" * 1_000_000):
        timed(10, lambda data=data: quality_rules.assess(data, None))
    deep = "<div>" * 100_000 + "the end" + "</span>" * 100_000 + "</div>" * 100_000
    timed(20, lambda: html_text.main_text(deep))
    assert html_text.main_text("<article>" + "<p>of it" * 50_000).count("\n") == 49_999
    timed(20, lambda: html_text.main_text("<p>x y" * 100_000))
    timed(20, lambda: html_text.main_text("<article>" + "<h2><b>x" * 50_000))
    timed(10, lambda: byte_bpe.coder()(["-" * 100_000]))


LONG_TEXT = "the story of the day and the night and it is what it was "


@pytest.mark.parametrize("page, text", [
    (f"<div class='has-sidebar'><article><p>{LONG_TEXT}</p></article></div>", LONG_TEXT),
    (f"<article class='post comments-open'><p>{LONG_TEXT}</p></article>", LONG_TEXT),
    (f"<main class='content no-sidebar'><p>{LONG_TEXT}</p></main>", LONG_TEXT),
    (f"<div class='main-nav-wrap page-related'><article><p>{LONG_TEXT}</p></article></div>", LONG_TEXT),
    (f"<article><p class='social-science'>{LONG_TEXT * 3}</p></article>", LONG_TEXT * 3),
    (f"<article><button>Press<p>{LONG_TEXT}</p><p>{LONG_TEXT}</article>", f"{LONG_TEXT.strip()}\n{LONG_TEXT}"),
    (f"<article><object data=x><p>{LONG_TEXT}</p></article>", LONG_TEXT),
    (f"<article><p>{LONG_TEXT} <math><mi>x</mi></math> {LONG_TEXT}</p></article>", f"{LONG_TEXT} x {LONG_TEXT}"),
    (f"<article><p>so <button>Buy</button> it is</p><p>{LONG_TEXT}</p></article>", f"so it is\n{LONG_TEXT}"),
    (f"<div class='comments-list'><p>{LONG_TEXT}</p></div><article><p>{LONG_TEXT}</p></article>", LONG_TEXT),
    (f"<div class='comments'><article class=comment><p>{LONG_TEXT}</p></article></div>", ""),
    (f"<template><p>{LONG_TEXT}</p></template><article><p>{LONG_TEXT}</p></article>", LONG_TEXT),
])
def test_names_and_controls_on_pages(page, text):
    assert html_text.main_text(page) == "\n".join(" ".join(x.split()) for x in text.split("\n"))


def test_states_go_on_without_encoding_again(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat " * 500), (2, None), (3, "left alone " * 50)], "doc_id long, text string")
    kind = "array<struct<seq:long,start:long,removed:long,inserted:string>>"
    first = spark.createDataFrame([(1, [(1, 4000, 3, "dog")]), (2, [(1, 0, 0, "new words")])], f"doc_id long, edits {kind}")
    second = spark.createDataFrame([(1, [(1, 40, 3, "hen"), (2, 11_000, 99, None)])], f"doc_id long, edits {kind}")
    once = token_counts.advance(token_counts.states(docs), first)
    twice = {r.doc_id: r for r in token_counts.advance(once, second).collect()}
    text = "the cat sat on the mat " * 500
    text = text[:4000] + "dog" + text[4003:]
    text = text[:40] + "hen" + text[43:]
    text = text[:11_000] + text[11_099:]
    count = token_counts.counter()
    assert twice[1].text == text and twice[1].n_tokens == len(count.encode(text)) and 0 < twice[1].n_encoded < 20
    assert (twice[2].text, twice[2].n_encoded, twice[3].n_encoded) == ("new words", 0, 0)
    assert {r.doc_id: r.n_encoded for r in once.collect()}[3] == 0
    whole = token_counts.Tree(count, text)
    assert twice[1].piece_tokens == [n for _, n in whole.leaves()] and twice[1].sum_tokens[0] == whole.n_tokens()


def slow_terms(rows):
    """Spans of disclosing terms per row number, from the definitions alone."""
    near, held, holds = defaultdict(dict), defaultdict(set), Counter()
    places = defaultdict(list)
    for i, text in enumerate(rows):
        text = text or ""
        holds.update(set(re.findall(r"[^\W\d_]+", text.lower())))
        for r in private_terms.surroundings(text, private_terms.base_spans(text)):
            held[r["entity"]].add(i)
            if r["term"]:
                key = r["entity"], r["term"]
                near[key][i] = min(r["around"], near[key].get(i, r["around"]))
                places[key].append((i, r["start"], r["stop"]))
    import math

    out = defaultdict(set)
    for (entity, term), of in near.items():
        carried = math.log2(len(rows) / len(held[entity]))
        shared = math.log2(len(of) * len(rows) / (len(held[entity]) * holds[term])) if holds[term] else 0
        if len(set(of.values())) >= private_terms.SUPPORT and carried > 0 and shared >= private_terms.DISCLOSES * carried:
            for i, start, stop in places[entity, term]:
                out[i].add(f"term:{start}:{stop}")
    return out


def test_all_term_spans(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    twice = "Zanzibar knows x.y@example.org and Zanzibar is x.y@example.org of old"
    rows += [(10_000, twice)] + [(10_001 + k, f"w{k} told me Qwertine q@example.org again {'abcde'[k]}") for k in range(5)]
    want = slow_terms([t for _, t in rows])
    got = private_terms.report(spark.createDataFrame(rows, "doc_id long, text string")).toPandas().set_index("doc_id")
    for i, (k, _) in enumerate(rows):
        assert {s for s in got.spans[k].split(",") if s.startswith("term:")} == want[i], k
    assert not want[len(rows) - 6]  # one text is no evidence, however often it says so
    assert any(want.values())
