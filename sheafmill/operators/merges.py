"""Byte-pair merges of a whole corpus, in the order that one-by-one training would take them.

The count of every neighbour pair is kept and changed by differences: it has at most as many entries as the
vocabulary has pairs, so it lives on the driver, while the words stay in a written table. A round foresees the
next merges from a bounded sample of the words, and one job applies them to all words that hold
them and returns, merge by merge, by how much each pair's count changes. With these exact differences the
driver walks the merges one by one and takes the pair that truly ranks first. Where another one was foreseen, the
true one is brought forward past those foreseen before it, and the differences are changed with it; where it
was not foreseen at all, or cannot change places, the rest of the round is dropped. The first merge of a round is
always right, so the outcome is that of taking one merge a round; how many rounds that needs depends on the sample alone.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.session import materialise

#: Commonest words that merges are foreseen from, and about as many others; merges foreseen in a round; merges between two written tables.
SAMPLE, FEWEST, MOST, PER_TABLE = 50_000, 16, 512, 512
#: Symbols of words that a task takes merges on together.
TOGETHER = 1 << 20
WORDS = "symbols array<int>, n long"
Merge = tuple[int, int, int]  # left, right, result
Changes = dict[tuple[int, int], int]  # by how much the count of a pair changes


def merge(symbols: np.ndarray, word: np.ndarray, step: Merge) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat symbols and their words after one merge, left to right; and the places merged, before it."""
    left, right, result = step
    at = np.flatnonzero((symbols[:-1] == left) & (symbols[1:] == right) & (word[:-1] == word[1:]))
    if len(at) and left == right:  # in a run of overlapping pairs every other one
        run = np.maximum.accumulate(np.where(np.append(True, np.diff(at) != 1), np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
    if not len(at):
        return symbols, word, at
    symbols = symbols.copy()
    symbols[at] = result
    kept = np.ones(len(symbols), bool)
    kept[at + 1] = False
    return symbols[kept], word[kept], at


def _flat(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of words in a row, how many each word has, and how often each occurs."""
    lists = [b.column(0) for b in batches]
    symbols = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in lists])
    sizes = np.concatenate([np.diff(x.offsets.to_numpy()) for x in lists]).astype(np.int64)
    return symbols, sizes, np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in batches])


def _together(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words in groups of some TOGETHER symbols, since every merge costs something in each group."""
    waiting, size = [], 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            size += len(batch.column(0).flatten())
        if size >= TOGETHER:
            yield _flat(waiting)
            waiting, size = [], 0
    if waiting:
        yield _flat(waiting)


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where the symbols of words are that start and have as many as told."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Words:
    """Words in a row on which merges are taken one after the other; each looks only at words that may hold it."""

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray, steps: list[Merge]):
        self.symbols, self.sizes, self.steps = symbols.copy(), sizes.copy(), steps
        self.starts = np.cumsum(sizes) - sizes
        codes = np.array([left << 32 | right for left, right, _ in steps], np.int64)
        self.wanted, self.of = np.unique(codes, return_inverse=True)
        self.holders: list[list[np.ndarray]] = [[] for _ in self.wanted]
        if steps:
            self.note(*_codes(symbols, np.repeat(np.arange(len(sizes)), sizes)))

    def note(self, pairs: np.ndarray, word: np.ndarray) -> None:
        """Remember which words hold a pair that is merged sometime."""
        at = np.minimum(np.searchsorted(self.wanted, pairs), len(self.wanted) - 1)
        hits = np.flatnonzero(self.wanted[at] == pairs)
        hits = hits[np.argsort(at[hits], kind="stable")]
        found, first = np.unique(at[hits], return_index=True)
        for k, own in zip(found, np.split(word[hits], first[1:])):
            self.holders[k].append(own)

    def merged(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Merge by merge: its number, and symbols and words before and after it, of words that hold it."""
        for number, step in enumerate(self.steps):
            held, self.holders[self.of[number]] = self.holders[self.of[number]], []
            if not held:
                continue
            own = np.unique(np.concatenate(held))
            at, sizes = self.starts[own], self.sizes[own]
            before, word = self.symbols[_places(at, sizes)], np.repeat(own, sizes)
            after, after_word, places = merge(before, word, step)
            if not len(places):
                continue
            self.sizes[own] = np.diff(np.searchsorted(after_word, np.append(own, own[-1] + 1)))
            self.symbols[_places(at, self.sizes[own])] = after
            pairs, of = _codes(after, after_word)
            new = (pairs >> 32 == step[2]) | (pairs & 0xFFFFFFFF == step[2])
            self.note(pairs[new], of[new])
            yield number, before, word, after, after_word


def _codes(symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbour pairs as one number each, and their words."""
    inside = word[:-1] == word[1:]
    return (symbols[:-1].astype(np.int64) << 32 | symbols[1:])[inside], word[:-1][inside]


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, which = np.unique(keys, return_inverse=True)
    out = np.zeros(len(distinct), np.int64)
    np.add.at(out, which, values)
    return distinct, out


def pair_table(words: DataFrame) -> DataFrame:
    """pair and n: how often each neighbour pair occurs in all words."""

    def run(batches):
        for symbols, sizes, weight in _together(batches):
            pairs, word = _codes(symbols, np.repeat(np.arange(len(sizes)), sizes))
            pairs, n = _summed(pairs, weight[word])
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])

    return words.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def differences(words: DataFrame, done: list[Merge], steps: list[Merge]) -> DataFrame:
    """step, pair, n: by how much each merge of `steps` changes the count of a pair; only words that hold one
    of them are looked at, and per merge only those that hold it."""

    def run(batches):
        for symbols, sizes, weight in _together(batches):
            for number, before, word, after, after_word in Words(symbols, sizes, done + steps).merged():
                if number < len(done):
                    continue
                gone, gone_word = _codes(before, word)
                made, made_word = _codes(after, after_word)
                pairs, n = _summed(
                    np.concatenate([gone, made]), np.concatenate([-weight[gone_word], weight[made_word]])
                )
                pairs, n = pairs[n != 0], n[n != 0]
                own = pa.array(np.full(len(pairs), number - len(done), np.int32))
                yield pa.RecordBatch.from_arrays([own, pa.array(pairs), pa.array(n)], ["step", "pair", "n"])

    made = words.mapInArrow(run, "step int, pair long, n long")
    return made.groupBy("step", "pair").agg(F.sum("n").alias("n"))


def rewritten(words: DataFrame, done: list[Merge]) -> DataFrame:
    """The words after the merges, written."""

    def run(batches):
        for symbols, sizes, weight in _together(batches):
            own = Words(symbols, sizes, done)
            for _ in own.merged():
                pass
            offsets = np.concatenate([[0], np.cumsum(own.sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(own.symbols[_places(own.starts, own.sizes)]))
            yield pa.RecordBatch.from_arrays([lists, pa.array(weight)], ["symbols", "n"])

    return materialise(words.mapInArrow(run, WORDS), "words")


def drawn(words: DataFrame) -> list[tuple[list[int], float]]:
    """The SAMPLE commonest words, and some SAMPLE others drawn by a hash that stand for all the rest."""
    common = words.orderBy(F.desc("n"), "symbols").limit(SAMPLE).collect()
    if len(common) < SAMPLE or not common:
        return [(r.symbols, r.n) for r in common]
    last = common[-1]
    rest = words.filter((F.col("n") < last.n) | ((F.col("n") == last.n) & (F.col("symbols") > F.lit(last.symbols))))
    share = max(rest.count() / SAMPLE, 1.0)
    some = rest.filter(F.pmod(F.xxhash64("symbols"), F.lit(1 << 20)) < int((1 << 20) / share)).limit(2 * SAMPLE)
    return [(r.symbols, r.n) for r in common] + [(r.symbols, r.n * share) for r in some.collect()]


class Sample:
    """Words to foresee from what a merge does to other pairs; merges can be taken back."""

    def __init__(self, rows: list[tuple[list[int], float]]):
        self.words = [list(symbols) for symbols, _ in rows]
        self.n = [n for _, n in rows]
        self.holders: dict[tuple[int, int], set[int]] = defaultdict(set)  # may name words that no longer hold it
        for i, symbols in enumerate(self.words):
            for pair in zip(symbols, symbols[1:]):
                self.holders[pair].add(i)

    def merge(self, step: Merge) -> tuple[int, dict[tuple[int, int], int], list[tuple[int, list[int]]]]:
        """Occurrences of the pair, changes of all pairs, and what undo() needs."""
        left, right, result = step
        seen, changes, before = 0, defaultdict(int), []
        for i in self.holders.get((left, right), ()):
            old, new, k = self.words[i], [], 0
            while k < len(old):
                if k + 1 < len(old) and old[k] == left and old[k + 1] == right:
                    new.append(result)
                    k += 2
                else:
                    new.append(old[k])
                    k += 1
            if len(new) == len(old):
                continue
            n = self.n[i]
            seen += n * (len(old) - len(new))
            for pair in zip(old, old[1:]):
                changes[pair] -= n
            for pair in zip(new, new[1:]):
                changes[pair] += n
            before.append((i, old))
            self.words[i] = new
        for i, _ in before:
            for pair in zip(self.words[i], self.words[i][1:]):
                self.holders[pair].add(i)
        return seen, changes, before

    def undo(self, before: list[tuple[int, list[int]]]) -> None:
        for i, old in before:
            self.words[i] = old

    def forget(self, dropped: set[int]) -> None:
        """Of symbols that no word holds any more."""
        for pair in [p for p in self.holders if p[0] in dropped or p[1] in dropped]:
            del self.holders[pair]


class Ranking:
    """Exact counts of all pairs, the first by count, then left bytes, then right bytes."""

    def __init__(self, counts: dict[tuple[int, int], int], tokens: list[bytes]):
        self.counts, self.tokens = counts, tokens
        self.clean()

    def clean(self) -> None:
        """The heap without counts that are out of date."""
        self.heap = [self.entry(pair, n) for pair, n in self.counts.items()]
        heapq.heapify(self.heap)

    def entry(self, pair: tuple[int, int], n: int, tokens: list[bytes] | None = None) -> tuple:
        tokens = tokens or self.tokens
        return -n, tokens[pair[0]], tokens[pair[1]], pair

    def change(self, pair: tuple[int, int], by: int) -> None:
        n = self.counts.get(pair, 0) + by
        if n:
            self.counts[pair] = n
            heapq.heappush(self.heap, self.entry(pair, n))
            if len(self.heap) > 2 * len(self.counts) + 1000:
                self.clean()
        else:
            self.counts.pop(pair, None)

    def first(self) -> tuple[int, int] | None:
        while self.heap and self.counts.get(self.heap[0][3]) != -self.heap[0][0]:
            heapq.heappop(self.heap)
        return self.heap[0][3] if self.heap else None

    def foresee(self, sample: Sample, many: int, known: dict[bytes, int]) -> tuple[list[Merge], list]:
        """The next merges as far as the sample tells, and what takes each back in the sample."""
        tokens, ids = list(self.tokens), {}
        guessed: dict[tuple[int, int], float] = {}
        moved, own, steps, undo = [], [], [], []
        while len(steps) < many:
            first = self.first()
            while first is not None and first in guessed:  # its exact count is out of date by now
                moved.append(heapq.heappop(self.heap))
                first = self.first()
            while own and -own[0][0] != guessed[own[0][3]]:
                heapq.heappop(own)
            choices = [own[0]] if own else []
            if first is not None:
                choices.append(self.heap[0])
            if not choices or -min(choices)[0] < 1:
                break
            count, left, right, pair = min(choices)
            spelled = left + right
            result = known.get(spelled, ids.get(spelled))
            if result is None:
                result = ids[spelled] = len(tokens)
                tokens.append(spelled)
            steps.append((*pair, result))
            seen, changes, before = sample.merge(steps[-1])
            undo.append(before)
            scale = -count / seen if seen else 0.0
            for other, by in changes.items():
                if by:
                    now = guessed.get(other, self.counts.get(other, 0)) + by * scale
                    guessed[other] = float(max(round(now), 0))
                    heapq.heappush(own, self.entry(other, guessed[other], tokens))
            guessed[pair] = 0.0
        for entry in moved:
            heapq.heappush(self.heap, entry)
        return steps, undo


class Round:
    """Foreseen merges with the exact differences of each after those before it, as long as they are not taken.

    Two merges that follow each other, first A and then B, can change places if no occurrence of one can overlap
    one of the other and neither makes a symbol the other takes. Both together change the same counts in
    either order. B before A finds, next to its own occurrences, A's right symbol in front and A's left
    symbol behind where it would find what A makes, and the same pairs otherwise; as only A has made
    that symbol in this round, the differences of B alone follow from those after A, and those of A from the sum.
    """

    def __init__(self, steps: list[Merge], changes: dict[int, Changes], made: int):
        self.steps, self.changes = steps, changes
        self.waiting = list(range(len(steps)))
        seen, self.fresh = set(), []  # steps whose result no word held before them
        for _, _, result in steps:
            self.fresh.append(result >= made and result not in seen)
            seen.add(result)

    def swappable(self, a: int, b: int) -> bool:
        (left, right, result), (left_b, right_b, result_b) = self.steps[a], self.steps[b]
        apart = right != left_b and right_b != left and (left, right) != (left_b, right_b)
        return self.fresh[a] and apart and result not in (left_b, right_b, result_b) and result_b not in (left, right)

    def take(self, pair: tuple[int, int]) -> tuple[int, Changes] | None:
        """The step that merges `pair`, brought forward to be the next, and its differences."""
        place = next((k for k, i in enumerate(self.waiting) if self.steps[i][:2] == pair), None)
        if place is None:
            return None
        b = self.waiting[place]
        passed = self.waiting[:place]
        if not all(self.swappable(a, b) for a in passed):
            return None
        makers = {self.steps[a][2]: k for k, a in enumerate(passed)}
        own = self.changes.pop(b, {})
        beside: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for found in own if makers else ():
            for symbol in found:
                if symbol in makers:
                    beside[makers[symbol]].add(found)
        while beside:
            k = max(beside)  # the last of those passed changes places first
            left, right, result = self.steps[passed[k]]
            other = self.changes[passed[k]]
            for found in beside.pop(k):
                n = own.pop(found, 0)
                before = right if found[0] == result else found[0], left if found[1] == result else found[1]
                own[before] = own.get(before, 0) + n
                other[found] = other.get(found, 0) + n
                other[before] = other.get(before, 0) - n
                for symbol in before:
                    if makers.get(symbol, k) < k:
                        beside[makers[symbol]].add(before)
        del self.waiting[place]
        return b, own


def learn(words: DataFrame, tokens: list[bytes], target: int) -> tuple[list[tuple[bytes, bytes]], int]:
    """Append to `tokens` until there are `target` or no pair is left; returns the merges and the number of rounds.

    `words` has WORDS: token numbers of each distinct word and how often it occurs.
    """
    known = {t: i for i, t in enumerate(tokens)}
    symbols = list(tokens)  # by number: also of merges foreseen and dropped, whose numbers stay unused
    sample = Sample(drawn(words))
    first = pair_table(words).toArrow()  # at most one row per pair of tokens
    counts = {(p >> 32, p & 0xFFFFFFFF): n for p, n in zip(first["pair"].to_pylist(), first["n"].to_pylist())}
    ranking = Ranking(counts, symbols)
    merges, done, many, rounds = [], [], FEWEST, 0
    while len(tokens) < target and ranking.first() is not None:
        made = len(symbols)
        steps, undo = ranking.foresee(sample, many, known)
        for left, right, result in steps:
            if result == len(symbols):
                symbols.append(symbols[left] + symbols[right])
        found = differences(words, done, steps).toArrow()
        changes: dict[int, Changes] = defaultdict(dict)
        for number, pair, n in zip(*(found[c].to_pylist() for c in ("step", "pair", "n"))):
            changes[number][pair >> 32, pair & 0xFFFFFFFF] = n
        ahead, taken = Round(steps, changes, made), []
        while len(tokens) < target and (pair := ranking.first()) is not None and (step := ahead.take(pair)):
            number, own = step
            left, right, result = steps[number]
            merges.append((symbols[left], symbols[right]))
            if symbols[result] not in known:
                tokens.append(symbols[result])
                known[symbols[result]] = result
            for other, by in own.items():
                if by:
                    ranking.change(other, by)
            taken.append(number)
        kept = next((k for k, number in enumerate(taken) if k != number), len(taken))
        for before in reversed(undo[kept:]):
            sample.undo(before)
        for number in taken[kept:]:
            sample.merge(steps[number])
        sample.forget(set(range(made, len(symbols))) - {steps[number][2] for number in taken})
        done += [steps[number] for number in taken]
        many, rounds = min(max(FEWEST, 2 * len(taken)), MOST), rounds + 1
        if len(done) >= PER_TABLE:
            words, done = rewritten(words, done), []
    return merges, rounds
