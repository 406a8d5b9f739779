"""Language-model scores, phrases and search against plain versions."""

import itertools
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sheafmill.llm import lexical, markov, phrases

SPACE = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower_words(text):
    return SPACE.findall((text or "").translate(LOWER)) + ["\n"]


@pytest.fixture(scope="module")
def learnt(documents):
    model, written, history = markov.fit(markov.training(documents), rounds=3)
    return model, markov.score(written, model).toPandas(), history


def test_base_scores(learnt, text_of):
    _, got, _ = learnt
    held = {k: crc32(str(k).encode()) % 7 == 2 for k in text_of}
    c = Counter(w for k, t in text_of.items() if not held[k] for w in lower_words(t))
    n, v = sum(c.values()), len(c)
    for r in got.itertuples():
        own = lower_words(text_of[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), n)
        assert r.n_known == sum(c[w] > 0 for w in own)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own), abs=1e-5)


def test_training_raises_the_likelihood_and_scores_beat_counts(learnt):
    _, got, history = learnt
    assert history[0] < history[1] < history[2]
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()
    assert (got.score < 0).all()


def slow_recursions(classes, start, move, emit):
    """Likelihood and expected counts over all paths, one by one."""
    states = range(len(start))
    total, first, moved, emitted = 0.0, np.zeros(len(start)), np.zeros_like(move), np.zeros_like(emit)
    for path in itertools.product(states, repeat=len(classes)):
        p = start[path[0]] * np.prod([move[a, b] for a, b in zip(path, path[1:])])
        p *= np.prod([emit[s, c] for s, c in zip(path, classes)])
        total += p
        first[path[0]] += p
        for a, b in zip(path, path[1:]):
            moved[a, b] += p
        for s, c in zip(path, classes):
            emitted[s, c] += p
    return total, first / total, moved / total, emitted / total


def test_recursions_equal_the_sum_over_all_paths():
    draw = np.random.default_rng(5)
    start, move, emit = draw.dirichlet(np.ones(3)), draw.dirichlet(np.ones(3), 3), draw.dirichlet(np.ones(4), 3)
    texts = [draw.integers(0, 4, n) for n in (1, 5, 3, 5, 2)]
    side = markov.Together([np.array(t, "<u2") for t in texts])
    slow = [slow_recursions(t, start, move, emit) for t in texts]
    assert np.allclose(markov.likelihoods(side, start, move, emit), [math.log10(s[0]) for s in slow])
    first, moved, emitted, log = markov.expected(side, start, move, emit)
    for got, k in ((first, 1), (moved, 2), (emitted, 3)):
        assert np.allclose(got, sum(s[k] for s in slow), rtol=1e-4)
    assert log == pytest.approx(sum(math.log10(s[0]) for s in slow), rel=1e-5)


def test_score_is_the_models_probability(learnt, text_of):
    """The forward sum in plain numbers, with the words' shares in their classes."""
    model, got, _ = learnt
    counts = {bytes(r.word): r.c for r in model.counts.collect()}
    own = len(model.mass) - markov.TAIL
    for r in got.sort_values("n_tokens").head(30).itertuples():
        words = [w.encode() for w in lower_words(text_of[r.doc_id])]
        assert max(map(len, words)) <= markov.LONG
        classes = [model.listed[w][0] if w in model.listed else own + markov.tail_class(w) for w in words]
        now, log = None, 0.0
        for w, k in zip(words, classes):
            now = (model.start if now is None else now @ model.move) * model.emit[:, k]
            log += math.log10((counts.get(w, 0) + 1) / model.mass[k]) + math.log10(now.sum())
            now /= now.sum()
        assert r.score == pytest.approx(log, abs=1e-4)


def test_shares_in_a_class_add_up_to_one(learnt):
    model, _, _ = learnt
    own = len(model.mass) - markov.TAIL
    total = np.ones(len(model.mass))  # the unknown words of each class
    for r in model.counts.collect():
        w = bytes(r.word)
        total[model.listed[w][0] if w in model.listed else own + markov.tail_class(w)] += r.c + 1
    assert np.allclose(total, model.mass)


def test_scores_of_odd_rows(spark, odd, odd_clashing, nothing):
    got = markov.language_scores(odd).toPandas()
    assert len(got) == 11 and np.isfinite(got.score).all()
    assert sorted(got.n_tokens)[:3] == [1, 1, 1] and got.n_tokens.max() == 40_001
    again = markov.language_scores(odd_clashing).toPandas()
    assert sorted(got.base_score) == sorted(again.base_score)
    assert markov.language_scores(nothing).count() == 0
    long = spark.createDataFrame([(1, "x" * 3_000_000 + " y"), (2, None)], "doc_id long, text string")
    assert sorted(markov.language_scores(long).toPandas().n_tokens) == [1, 3]
    held = next(k for k in range(100) if crc32(str(k).encode()) % 7 == 2)
    alone = markov.language_scores(long.limit(1).withColumn("doc_id", F.lit(held))).first()
    assert (alone.held_out, alone.train_tokens, alone.base_score, alone.score) == (True, 0, 0.0, 0.0)


def slow_phrases(rows, least, reported):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(ws)
            for k in range(1, 6):
                f[lang or "und"].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, every in f.items():
        every = {p: a for p, a in every.items() if a >= least}
        covered = {
            q[i : i + k] for q, a in every.items() for k in range(2, len(q)) for i in range(len(q) - k + 1)
            if 100 * a >= 100 * every[q[i : i + k]]
        }
        found = []
        for p, a in every.items():
            if len(p) > 1 and p not in covered:
                score, k = min((1000 * a * n[lang] // (every[p[:k]] * every[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), every[p[:k]], every[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:reported], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("least, reported", [(100, 2000), (7, 50)])
def test_phrases(documents, least, reported):
    rows = [(r.lang, r.text) for r in documents.collect()]
    got = phrases.collocations(documents, least, reported)
    assert sorted(map(tuple, got.collect())) == slow_phrases(rows, least, reported)


@pytest.mark.parametrize("sample", [1, 3, 10_000])
def test_any_sample_gives_all_frequent_phrases(documents, sample):
    got, passes = phrases.frequent_phrases(documents, 20, sample)
    want, _ = phrases.frequent_phrases(documents, 20, 1)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.groupBy("lang", "phrase").count().filter("count > 1").isEmpty()
    assert passes == (1 if sample == 1 else 2)


def test_phrases_of_odd_rows(spark, odd, odd_clashing, nothing):
    want = slow_phrases([(r.lang, r.text) for r in odd.collect()], 2, 2000)
    for rows in (odd, odd_clashing):
        assert sorted(map(tuple, phrases.collocations(rows, 2).collect())) == want
    assert phrases.collocations(nothing, 2).count() == 0
    long = spark.createDataFrame([(None, "a b. " * 3_000_000), ("en", None)], "lang string, text string")
    assert [tuple(r) for r in phrases.collocations(long).collect()] == [
        ("und", 1, "a b", 3_000_000, 3_000_000, 3_000_000, 6_000_000, 2000)
    ]


TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_search(docs, items, k):
    of = {i: Counter(TERM.findall((t or "").translate(LOWER))) for i, (_, t) in enumerate(docs)}
    n = {i: sum(c.values()) for i, c in of.items()}
    n_docs, total = sum(x > 0 for x in n.values()), sum(n.values())
    df = Counter(t for c in of.values() for t in c)
    out = []
    for item, text in items:
        found = []
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        for i, c in of.items():
            if not n[i]:
                continue
            m = 25 + 75 * n[i] * n_docs // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, times in asked.items() if t in c
            )
            if score:
                found.append((-score, docs[i][0] is None, docs[i][0] or 0))
        out += [(item, r, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k, block, long", [(10, 128, 24), (3, 2, 2), (1, 16, 1000)])
def test_search(spark, sf_dir, documents, monkeypatch, k, block, long):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "LONG", long)
    want = slow_search([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()], k)
    assert sorted(map(tuple, lexical.search(documents, items, k).collect()), key=repr) == want


def test_search_in_blocks_of_items(spark, sf_dir, documents, monkeypatch):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = sorted(map(tuple, lexical.search(documents, items).collect()))
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 500)
    assert sorted(map(tuple, lexical.search(documents, items).collect())) == whole


def test_skipping_reads_fewer_blocks():
    """Blocks whose bounds stay below the floor are not walked, and nothing that ranks is lost."""
    draw = np.random.default_rng(3)
    ids = [np.array([0, 1] if i % 500 == 7 else [0], "<i4").tobytes() for i in range(5000)]
    counts = [np.array([draw.integers(1, 4)] * (len(x) // 4), "<i8").tobytes() for x in ids]
    lists = lexical.Lists(np.full(5000, 20), ids, counts, np.array([1, 9000]), 5000, 100_000)
    asked, reads = {0: 1, 1: 1}, []
    get = lists.get
    lists.get = lambda term: reads.append(term) or get(term)
    best = lexical.Best(5)
    docs, scores = lexical.walk(lists, asked, best)
    whole = np.zeros(5000, np.int64)
    for term in (0, 1):
        doc, value = get(term)
        whole[doc] += value
    order = np.lexsort((np.arange(5000), -whole))[:5]
    got = sorted(zip((-scores).tolist(), docs.tolist()))[:5]
    assert [d for _, d in got] == order.tolist()
    assert reads.count(0) < lists.blocks


def test_search_of_odd_rows(spark, odd, odd_clashing, nothing):
    items = spark.createDataFrame(
        [(1, "The CAT sat, word"), (1, "cat"), (None, "日本語 Straße é"), (4, None), (5, "..."), (6, "absent")],
        "item_id long, text string",
    ).selectExpr("*", "1 AS rank", "2 AS no", "3 AS score", "4 AS doc_id")
    want = slow_search([(r.doc_id, r.text) for r in odd.collect()], [(r.item_id, r.text) for r in items.collect()], 10)
    for rows in (odd, odd_clashing):
        assert sorted(map(tuple, lexical.search(rows, items).collect()), key=repr) == want
    assert lexical.search(nothing, items).count() == 0
    assert lexical.search(odd, items.limit(0)).count() == 0


def test_only_phrases_that_can_be_frequent_are_counted_by_their_words(spark):
    """The first reading of a pass rules out rare phrases by short hashes, and never a frequent one."""
    texts = ["alpha beta gamma"] * 120 + [f"rare{k} alpha word{k}" for k in range(300)]
    rows = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    proposed = phrases.propose(rows, 1.0)
    often = phrases.common(rows, proposed, None, 100)
    seed = xxhash.xxh64_intdigest(b"en")
    a, b, c = (np.array([xxhash.xxh64_intdigest(w, seed)], np.uint64) for w in (b"alpha", b"beta", b"gamma"))
    ab, bc = phrases._follow(a, b), phrases._follow(b, c)
    assert all(phrases._has(often, h)[0] for h in (a, b, c, ab, bc, phrases._follow(ab, c)))
    rare = np.array([xxhash.xxh64_intdigest(f"rare{k}".encode(), seed) for k in range(300)], np.uint64)
    assert phrases._has(proposed, rare).all() and phrases._has(often, rare).sum() < 10
    got = {r.phrase: r.f for r in phrases.count(rows, proposed, None, 100).collect()}
    assert got == {"": 1260, "alpha": 420, "beta": 120, "gamma": 120, "alpha beta": 120, "beta gamma": 120, "alpha beta gamma": 120}
