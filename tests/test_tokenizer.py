import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from sheafmill import fixed
from sheafmill.operators import corpus, sequence
from sheafmill.operators import tokenizer as tk

GREETING = "Hello world! Numbers: 123. Unicode: 你好"
TEXTS = [
    GREETING, "aaaa aaaaa", "abab ababab", "I'LL they'Ve don't", "12345 678", "a   b\n\n  c \n", "<|reserved_0|>",
    "", "émigré 😀😀", "x" * 300, "=" * 120, "the theme then there these the the", "ab" * 40, "   ",
]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def reference_encoding(vocab):
    return tiktoken.Encoding(
        name="check", pat_str=fixed.SPLIT_PATTERN,
        mergeable_ranks={t: i for i, t in enumerate(vocab.tokens)},
        special_tokens={s: vocab.bos_id + i for i, s in enumerate(vocab.specials)},
    )


def train_one_by_one(texts, size):
    """Textbook training: one merge at a time, ties by bytes."""
    words = Counter()
    for text in texts:
        words.update(regex.findall(fixed.SPLIT_PATTERN, text))
    words = {tuple(bytes([b]) for b in w.encode()): n for w, n in words.items()}
    tokens, merges = [bytes([b]) for b in range(256)], []
    while len(tokens) < size:
        pairs = Counter()
        for w, n in words.items():
            for pair in zip(w, w[1:]):
                pairs[pair] += n
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        merges.append(best)
        if best[0] + best[1] not in tokens:
            tokens.append(best[0] + best[1])
        merged = {}
        for w, n in words.items():
            out, i = [], 0
            while i < len(w):
                if w[i : i + 2] == best:
                    out.append(w[i] + w[i + 1])
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            merged[tuple(out)] = merged.get(tuple(out), 0) + n
        words = merged
    return tokens, merges


def test_pieces_equal_the_pattern(spark):
    got = {r.id: r.p for r in docs(spark, TEXTS).select("id", tk.pieces_of("text").alias("p")).collect()}
    for i, text in enumerate(TEXTS):
        assert "".join(got[i]) == text
    # With one token per byte pair of a piece, the encoder's own splitting shows.
    pieces = {p.encode() for ps in got.values() for p in ps if len(p.encode()) > 1}
    ranks = {bytes([b]): b for b in range(256)} | {p: 256 + i for i, p in enumerate(sorted(pieces))}
    encoder = tiktoken.Encoding(name="p", pat_str=fixed.SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, text in enumerate(TEXTS):
        whole = [encoder.decode_single_token_bytes(t) for t in encoder.encode_ordinary(text)]
        assert whole == [p.encode() for p in got[i]], text


@pytest.fixture(scope="module")
def corpus_texts(spark, sf_dir):
    return [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(40).collect()]


def test_training_equals_one_by_one(spark, corpus_texts):
    texts = corpus_texts + TEXTS
    vocab = tk.train_bpe(docs(spark, texts), 256 + 60 + 4)
    tokens, merges = train_one_by_one(texts, 256 + 60)
    assert vocab.merges == merges and vocab.tokens == tokens


@pytest.mark.parametrize("seed", [1, 2])
def test_training_on_small_alphabets(spark, seed):
    rng = random.Random(seed)
    texts = [" ".join("".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(30)) for _ in range(4)]
    vocab = tk.train_bpe(docs(spark, texts), 256 + 25 + 4)
    tokens, merges = train_one_by_one(texts, 256 + 25)
    assert vocab.merges == merges and vocab.tokens == tokens


def test_training_ends_when_no_pair_is_left(spark):
    vocab = tk.train_bpe(docs(spark, ["ab"]), 400)
    assert vocab.tokens[256:] == [b"ab"] and vocab.size == 261 and vocab.bos_id == 257


@pytest.fixture(scope="module")
def vocab(spark, corpus_texts):
    tokens, merges = train_one_by_one(corpus_texts + TEXTS, 256 + 300)
    return tk.Vocabulary(tokens, merges)


def test_encoding_equals_the_reference_encoder(spark, vocab, corpus_texts):
    texts = corpus_texts + TEXTS
    expected = reference_encoding(vocab)
    table = docs(spark, texts + [None])
    got = {r.id: r.tokens for r in tk.encode(table, vocab).collect()}
    for i, text in enumerate(texts):
        assert got[i] == expected.encode_ordinary(text), text
    assert got[len(texts)] == []
    with_bos = {r.id: r.tokens for r in tk.encode(table, vocab, prepend_bos=True).collect()}
    assert all(with_bos[i] == [vocab.bos_id] + got[i] for i in got)


def test_encoding_where_a_merge_opens_an_earlier_one(spark):
    base = [bytes([b]) for b in range(256)]
    odd = tk.Vocabulary(base + [b"bc", b"abc", b"ab", b"aba", b"abab", b"xab", b"aa", b"aaa"])
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcx", k=rng.randint(1, 14))) for _ in range(200)]
    expected = reference_encoding(odd)
    for r in tk.encode(docs(spark, texts), odd).collect():
        assert r.tokens == expected.encode_ordinary(r.text), r.text


def test_decoding_gives_the_texts_back(spark, vocab, corpus_texts):
    table = docs(spark, corpus_texts + TEXTS)
    assert tk.round_trip_failures(table, vocab).isEmpty()
    broken = spark.createDataFrame([([0xE4, 0xBD],), ([vocab.bos_id, 104],)], "tokens array<int>")
    got = [r[0] for r in broken.select(tk.decoded("tokens", vocab)).collect()]
    assert got == ["�", "<|reserved_0|>h"]
    with pytest.raises(Exception, match="outside the vocabulary"):
        spark.createDataFrame([([9999],)], "tokens array<int>").select(tk.decoded("tokens", vocab)).collect()


def test_encoding_needs_no_shuffle(spark, vocab):
    plan = tk.encode(docs(spark, TEXTS), vocab)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_vocabulary_facts(spark, vocab):
    frame = vocab.vocab_frame(spark)
    (facts,) = tk.vocabulary_facts(frame).collect()
    assert (facts.vocab_size, facts.n_special, facts.bos_id) == (vocab.size, 4, vocab.bos_id)
    encoding = reference_encoding(vocab)
    for r in frame.collect():
        want = 0 if r.is_special else len(encoding.decode([r.token_id]).encode())
        assert r.nbytes == want


def test_training_corpus_respects_cap_and_budget(spark):
    sharded = corpus.split_and_shard(docs(spark, [f"{i:03d}" + "x" * (i % 50) for i in range(200)]).select("text"), val_rows=20, shard_rows=30)
    rows = sorted(sharded.where("split = 'train'").collect(), key=lambda r: r.pos)
    want, used = [], 0
    for r in rows:
        if used >= 1000:
            break
        want.append(r.text[:30])
        used += len(want[-1])
    got = sorted(tk.training_corpus(sharded, 1000, 30).collect(), key=lambda r: r.pos)
    assert [r.text for r in got] == want


def test_training_rows(spark):
    sizes = [0, 3, 4, 5, 6, 9]
    rows = [(i, [7] + list(range(100, 100 + n - 1)) if n else []) for i, n in enumerate(sizes)]
    encoded = spark.createDataFrame(rows, "pos long, tokens array<int>")
    for r in sequence.training_rows(encoded, bos=7, length=4).collect():
        row = (rows[r.pos][1] + [7] * 5)[:5]
        assert r.inputs == row[:-1] and r.targets == row[1:]
    placed = {r.pos: (r.batch_no, r.row_in_batch) for r in sequence.assign_batches(encoded, 4).collect()}
    assert placed == {0: (0, 0), 1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 0), 5: (1, 1)}


@pytest.mark.parametrize("n,tokens", [(10, 13 * 8), (10, 4 * 8), (3, 35 * 8), (10, 0)])
def test_evaluation_rows_wrap_around(spark, n, tokens):
    batch, length = 2, 8
    needed = tokens // (batch * length) * batch
    want = Counter(i % n for i in range(needed))
    rows = sequence.evaluation_rows(spark.range(n).withColumnRenamed("id", "pos"), batch, tokens, length)
    assert {r.pos: r.weight for r in rows.collect()} == dict(want)


def test_bits_per_byte_skips_special_tokens(spark, vocab):
    import math

    losses = [(97, 1.0, 1), (98, 2.0, 3), (vocab.bos_id, 500.0, 1), (256, 0.5, 1)]
    table = spark.createDataFrame(losses, "token_id int, nats double, weight long")
    (row,) = sequence.bits_per_byte(table, vocab.vocab_frame(spark)).collect()
    nbytes = 1 + 3 + len(vocab.tokens[256])
    assert row.total_bytes == nbytes and row.bpb == pytest.approx(7.5 / (math.log(2) * nbytes))


def next_fit(sizes, limit):
    windows, room = [], -1
    for size in sizes:
        if size <= room:
            windows[-1] += 1
            room -= size
        else:
            windows.append(1)
            room = limit - size
    return windows


CASES = [
    ([10, 20, 5, 40, 3], 30), ([40, 1, 40], 30), ([1, 2, 40], 30), ([40, 0, 0, 40, 0], 30), ([0, 0, 0], 30),
    ([], 30), ([30], 30), ([31], 30), ([15, 15, 15, 15], 30),
]


@pytest.mark.parametrize("sizes,limit,chunk_rows", [(*c, 1000) for c in CASES] + [(*CASES[0], 2), (*CASES[3], 2)])
def test_packing_small_cases(spark, sizes, limit, chunk_rows):
    table = spark.createDataFrame(list(enumerate(sizes)), "pos long, n long")
    got = sorted(r.documents for r in sequence.packed_rows(table, limit, chunk_rows=chunk_rows).collect())
    assert got == sorted(next_fit(sizes, limit))


@pytest.mark.parametrize("chunk_rows", [40, 100_000])
def test_packing_in_chunks_equals_one_pass(spark, chunk_rows):
    rng = random.Random(8)
    sizes = [rng.choice([0, 3, 17, 60, 250]) for _ in range(400)]
    table = spark.createDataFrame(list(enumerate(sizes)), "pos long, n long")
    packed = sequence.packed_rows(table, 200, chunk_rows=chunk_rows)
    want = next_fit(sizes, 200)
    assert sorted(r.documents for r in packed.collect()) == sorted(want)
    (facts,) = sequence.packing_profile(packed).collect()
    assert facts.windows == len(want) and facts.max_documents == max(want)
    assert facts.mean_documents == pytest.approx(len(sizes) / len(want))
    spread = {r.documents: r.windows for r in sequence.packing_distribution(packed).collect()}
    assert spread == Counter(want)


def test_long_piece_equals_one_by_one():
    from sheafmill.operators import bpe

    rng = np.random.default_rng(4)
    pairs = [(97, 98, 0, 256), (256, 97, 1, 257), (98, 98, 2, 258), (257, 258, 3, 259), (97, 97, 4, 260)]
    table = bpe.PairTable.of(pairs)
    for size in (1, 50, 400):
        text = rng.integers(97, 99, size).astype(np.int32)
        slow = text.tolist()
        while True:
            ranks = [(r, i, out) for i in range(len(slow) - 1) for a, b, r, out in pairs if slow[i : i + 2] == [a, b]]
            if not ranks:
                break
            _, i, out = min(ranks)
            slow[i : i + 2] = [out]
        fast, _ = bpe.merge_pieces(text, np.zeros(size, int), table, one_by_one=True)
        assert fast.tolist() == slow
    bpe.merge_pieces(np.full(300_000, 97, np.int32), np.zeros(300_000, int), table, one_by_one=True)


@pytest.mark.parametrize("chunk_rows, fan", [(1, 3), (7, 2), (1000, 1000)])
def test_packing_of_equal_lengths_takes_few_jobs(spark, chunk_rows, fan, monkeypatch):
    from sheafmill.operators import fold

    monkeypatch.setattr(fold, "FAN", fan)
    table = spark.createDataFrame([(k, 70) for k in range(60)], "pos long, n long")
    got = sorted(r.documents for r in sequence.packed_rows(table, 200, chunk_rows=chunk_rows).collect())
    assert got == [2] * 30


@pytest.mark.parametrize("sample, fewest, per_table", [(0, 3, 5), (7, 16, 512), (50_000, 16, 512)])
def test_training_does_not_depend_on_what_is_foreseen(spark, corpus_texts, monkeypatch, sample, fewest, per_table):
    """Poor guesses cost rounds, never a merge."""
    from sheafmill.operators import merges

    texts = corpus_texts[:40] + ["aaaa aaa aaaaa abab ababab", "aab aab aab baab"]
    want = tk.train_bpe(docs(spark, texts), 256 + 45 + 4).merges
    for name, value in (("SAMPLE", sample), ("FEWEST", fewest), ("PER_TABLE", per_table)):
        monkeypatch.setattr(merges, name, value)
    assert tk.train_bpe(docs(spark, texts), 256 + 45 + 4).merges == want


def test_differences_touch_only_words_that_hold_a_merge(spark):
    from sheafmill.operators import merges

    words = spark.createDataFrame([([1, 2, 3], 5), ([2, 3, 2, 3], 2), ([4, 4, 4], 7), ([9, 9], 1)], merges.WORDS)
    got = {(r.step, r.pair >> 32, r.pair & 0xFFFFFFFF): r.n for r in merges.differences(words, [], [(2, 3, 10), (4, 4, 11), (1, 10, 12)]).collect()}
    assert got == {
        (0, 1, 2): -5, (0, 2, 3): -9, (0, 3, 2): -2, (0, 1, 10): 5, (0, 10, 10): 2,
        (1, 4, 4): -14, (1, 11, 4): 7, (2, 1, 10): -5,
    }
    assert {tuple(r.symbols) for r in merges.rewritten(words, [(2, 3, 10), (10, 10, 11)]).collect()} == {
        (1, 10), (11,), (4, 4, 4), (9, 9)
    }


def test_long_training_takes_many_merges_a_round(spark, monkeypatch):
    """A thousand merges equal the walk on plain words, in far fewer rounds than merges."""
    from sheafmill.operators import merges

    rng = random.Random(4)
    syllables = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 2))) for _ in range(60)]
    texts = [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(400)) for _ in range(20)]
    rounds, differences = [], merges.differences
    monkeypatch.setattr(merges, "differences", lambda *a: rounds.append(1) or differences(*a))
    vocab = tk.train_bpe(docs(spark, texts), 256 + 300 + 4)
    counts = Counter(p for t in texts for p in regex.findall(fixed.SPLIT_PATTERN, t))
    words, slow = {tuple(bytes([b]) for b in p.encode()): n for p, n in counts.items()}, []
    for _ in range(300):
        pairs = Counter()
        for w, n in words.items():
            for pair in zip(w, w[1:]):
                pairs[pair] += n
        left, right = min(pairs, key=lambda p: (-pairs[p], p))
        slow.append((left, right))
        merged = Counter()
        for w, n in words.items():
            out, k = [], 0
            while k < len(w):
                both = w[k : k + 2] == (left, right)
                out.append(left + right if both else w[k])
                k += 1 + both
            merged[tuple(out)] += n
        words = merged
    assert vocab.merges[:300] == slow and len(rounds) < 60


@pytest.mark.parametrize("seed", range(60))
def test_foreseen_merges_change_places_exactly(seed):
    """Whatever order merges are taken in, their differences are those of taking them in that order."""
    from sheafmill.operators import merges

    rng = random.Random(seed)
    words = [[rng.randrange(6) for _ in range(rng.randint(2, 9))] for _ in range(60)]
    weight = np.array([rng.randint(1, 9) for _ in words])

    def pairs(lists):
        counts = Counter()
        for w, n in zip(lists, weight.tolist()):
            for pair in zip(w, w[1:]):
                counts[pair] += n
        return counts

    def merged(lists, step):
        out = []
        for w in lists:
            new, k = [], 0
            while k < len(w):
                both = tuple(w[k : k + 2]) == step[:2]
                new.append(step[2] if both else w[k])
                k += 1 + both
            out.append(new)
        return out

    now, steps, changes = words, [], {}
    for k in range(8):
        choices = sorted(pairs(now))
        if not choices:
            break
        result = 6 + k if rng.random() < 0.8 else rng.randrange(6)
        steps.append((*rng.choice(choices), result))
        after = merged(now, steps[-1])
        diff = pairs(after)
        diff.subtract(pairs(now))
        changes[k] = {p: n for p, n in diff.items() if n}
        now = after
    flat = np.array([s for w in words for s in w], np.int32), np.array([len(w) for w in words])
    own = merges.Words(*flat, steps)
    for number, before, word, after, after_word in own.merged():
        diff = Counter()
        for symbols, of, sign in ((before, word, -1), (after, after_word, 1)):
            for a, b, v, w in zip(symbols, symbols[1:], of, of[1:]):
                diff[a, b] += sign * int(weight[v]) if v == w else 0
        assert {p: n for p, n in diff.items() if n} == changes[number]
    left = own.symbols[merges._places(own.starts, own.sizes)].tolist()
    assert left == [s for w in now for s in w]

    ahead, state = merges.Round(steps, {k: dict(c) for k, c in changes.items()}, 6), words
    while ahead.waiting:
        tried = rng.sample(ahead.waiting, len(ahead.waiting))
        number, found = next(got for i in tried if (got := ahead.take(steps[i][:2])))
        after = merged(state, steps[number])
        diff = pairs(after)
        diff.subtract(pairs(state))
        assert {p: n for p, n in found.items() if n} == {p: n for p, n in diff.items() if n}
        state = after
    assert state == now


def test_training_takes_most_of_a_round(spark, sf_dir, monkeypatch):
    """Order foreseen wrongly ends no round by itself: 600 merges took 43 rounds without that."""
    from sheafmill.operators import merges

    rounds, differences = [], merges.differences
    monkeypatch.setattr(merges, "differences", lambda *a: rounds.append(1) or differences(*a))
    monkeypatch.setattr(merges, "SAMPLE", 5_000)
    tk.train_bpe(spark.read.parquet(f"{sf_dir}/documents.parquet"), 256 + 600 + 4)
    assert len(rounds) <= 20, len(rounds)


def test_encoding_works_on_groups_of_bounded_size(monkeypatch):
    """The working memory of a task does not grow with its Arrow batch; the ids stay the same."""
    vocab = tk.Vocabulary([bytes([b]) for b in range(256)] + [b"ab", b"abc"])
    rows = [["abc", "abd"], [], ["x"] * 9, ["abab", "é"], ["abc"], []] * 20
    batch = pa.array(rows, pa.list_(pa.string())).slice(1)
    whole = tk.encoder(vocab).func(batch).to_pylist()
    seen, merge_pieces = [], tk.merge_pieces
    monkeypatch.setattr(tk, "TOGETHER", 8, raising=False)
    monkeypatch.setattr(tk, "merge_pieces", lambda symbols, *a, **k: seen.append(len(symbols)) or merge_pieces(symbols, *a, **k))
    assert tk.encoder(vocab).func(batch).to_pylist() == whole
    assert whole[:4] == [[], [120] * 9, [256, 256, 195, 169], [257]] and len(seen) > 40
    assert tk.encoder(vocab).func(batch.slice(0, 0)).to_pylist() == []


def test_a_ranking_keeps_no_more_than_its_counts_need():
    from sheafmill.operators import merges

    ranking = merges.Ranking({(97, 98): 5, (98, 99): 4}, [bytes([b]) for b in range(256)])
    for k in range(20_000):
        ranking.change((98, 99), 1 if k % 2 else -1)
    assert len(ranking.heap) < 2_000 and ranking.first() == (97, 98) and ranking.counts[98, 99] == 4


@pytest.mark.parametrize("other", [0, 1200])
def test_pieces_side_by_side_equal_one_by_one(other):
    """With all pairs in a grid, and with more symbols than a grid takes."""
    from sheafmill.operators import bpe

    rng = random.Random(5)
    base = [bytes([b]) for b in range(256)] + [b"zq%d" % i for i in range(other)]
    for _ in range(20):
        longer = list({bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(12)})
        table = tk.Vocabulary(base + longer).pair_table()
        words = [bytes(rng.choices(b"abcd", k=rng.choice([1, 2, 5, 9, bpe.LONG, bpe.LONG + 1]))) for _ in range(40)]
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int32)
        piece = np.repeat(np.arange(40), [len(w) for w in words])
        symbols, of = bpe.merge_pieces(flat, piece, table, one_by_one=True)
        for k, word in enumerate(words):
            assert symbols[of == k].tolist() == bpe.merge_long(list(word), table.as_dict())


def test_a_merge_looks_up_only_the_pairs_beside_it(monkeypatch):
    from sheafmill.operators import bpe

    base = [bytes([b]) for b in range(256)] + [b"zq%d" % i for i in range(1200)]
    table = tk.Vocabulary(base + [b"ab", b"cd", b"abcd"]).pair_table()
    seen, look_up = [], bpe.PairTable.look_up
    monkeypatch.setattr(bpe.PairTable, "look_up", lambda t, a, b: seen.append(len(a)) or look_up(t, a, b))
    flat = np.frombuffer(b"abcd" * 5 * 100, np.uint8).astype(np.int32)
    symbols, _ = bpe.merge_pieces(flat, np.repeat(np.arange(100), 20), table, one_by_one=True)
    assert len(symbols) == 500
    assert sum(seen) <= len(flat) + 3 * (len(flat) - len(symbols))


def test_decoding_keeps_the_ids_in_python(spark, vocab, monkeypatch):
    frame = docs(spark, TEXTS)
    plan = tk.encode(frame, vocab).select(tk.decoded("tokens", vocab).alias("t"))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("ArrowEvalPython") == 1 and "transform" not in plan.toString()
    rows = [([104, 105],), ([],), (None,), ([0xC3],), ([0xC3, 0xA9],)] * 3
    broken = spark.createDataFrame(rows, "tokens array<int>").coalesce(1)
    monkeypatch.setattr(tk, "TOGETHER", 3)
    assert [r[0] for r in broken.select(tk.decoded("tokens", vocab)).collect()] == ["hi", "", None, "�", "é"] * 3
    for unknown in ([104, -1], [104, None]):
        with pytest.raises(Exception, match="outside the vocabulary"):
            spark.createDataFrame([(unknown,)], "tokens array<int>").select(tk.decoded("tokens", vocab)).collect()
