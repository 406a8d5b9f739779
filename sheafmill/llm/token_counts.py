"""Token counts that follow edits.

A document's pre-tokens stand in buckets of some 64; a binary tree over the buckets holds sums of characters
and tokens. An edit walks down the tree to its place, takes the pre-tokens it touches, the one before and
white space before that (what the split pattern looks at beyond its match), splits and encodes anew until a border falls on an old border
behind the edit, and updates the sums on the way up. The rest of the document is neither split nor encoded.

The state of a document is one row: its text, characters and tokens of each pre-token, and the sums. states() makes
it, advance() takes it with new edits to the next state, and encodes nothing but what the edits touch.

Defined results: null text is empty and has no tokens; edits apply in the order of seq, each to the text that
the ones before left; an edit beyond the end is cut to the text, a null start or length counts as 0 and a
null insertion as empty; rows that repeat an id each get all edits of that id; edits of an unknown or null
id are left out; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.byte_bpe import splitter
from sheafmill.llm.common import arrow_type, id_type, map_rows, texts
from sheafmill.llm.private_terms import emails

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Pre-tokens in a bucket when a tree is built; a bucket of four times as many has the tree rebuilt.
BUCKET = 64
REMEMBERED, SHORT = 400_000, 48


class Counter(dict):
    """Tokens of a pre-token; short ones are remembered, what is in use stays."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        def library(split: str):
            return tiktoken.Encoding("own", pat_str=split, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        # the library's splitter fails on very long white space; a pre-token needs no splitting
        self.encode, self.encode_piece = library(pattern), library(r"[\s\S]+")
        self.pattern, self.split, self.old = regex.compile(pattern), splitter(pattern), {}

    def __missing__(self, piece: str) -> int:
        n = self.old.get(piece) or len(self.encode_piece(piece))
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = n
        return n


@lru_cache(maxsize=2)
def counter(path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> Counter:
    return Counter(path, pattern)


class Tree:
    """Buckets of (pre-token, tokens) with sums of characters and tokens over them."""

    def __init__(self, count: Counter, text: str = ""):
        self.count, self.encoded = count, 0
        pieces = count.split(text)
        self._build(list(zip(pieces, map(count.__getitem__, pieces))))

    @classmethod
    def restored(cls, count: Counter, text: str, chars: list[int], tokens: list[int]) -> Tree:
        """The tree of a stored state; nothing is split or encoded."""
        tree = cls(count)
        ends = list(accumulate(chars))
        tree._build([(text[i:j], n) for i, j, n in zip([0, *ends], ends, tokens)])
        return tree

    def _build(self, leaves: list[tuple[str, int]]) -> None:
        self.buckets = [leaves[k : k + BUCKET] for k in range(0, len(leaves), BUCKET)] or [[]]
        self.size = 1 << (len(self.buckets) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for k, bucket in enumerate(self.buckets):
            self.chars[self.size + k] = sum(len(p) for p, _ in bucket)
            self.tokens[self.size + k] = sum(n for _, n in bucket)
        for k in range(self.size - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(p for bucket in self.buckets for p, _ in bucket)

    def leaves(self) -> list[tuple[str, int]]:
        return [leaf for bucket in self.buckets for leaf in bucket]

    def _find(self, place: int) -> tuple[int, int]:
        """Bucket that holds the character at `place`, and where the bucket starts."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if place >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        return min(node - self.size, len(self.buckets) - 1), start

    def _piece(self, place: int) -> tuple[int, int, int]:
        """Bucket, number in it and first character of the pre-token that holds `place`."""
        bucket, at = self._find(place)
        for k, (piece, _) in enumerate(self.buckets[bucket]):
            if place < at + len(piece):
                return bucket, k, at
            at += len(piece)
        return bucket, len(self.buckets[bucket]), at

    def _set(self, k: int, bucket: list[tuple[str, int]]) -> None:
        self.buckets[k] = bucket
        node = self.size + k
        self.chars[node], self.tokens[node] = sum(len(p) for p, _ in bucket), sum(n for _, n in bucket)
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def replace(self, start: int, removed: int, inserted: str) -> int:
        """Replace characters; returns how many pre-tokens were encoded."""
        whole = self.chars[1]
        start = min(max(start, 0), whole)
        removed = min(max(removed, 0), whole - start)
        first, index, offset = self._piece(max(start - 1, 0))
        while offset:  # how white space is split depends on what follows all of it
            before = self._piece(offset - 1)
            if not self.buckets[before[0]][before[1]][0].isspace():
                break
            first, index, offset = before
        head, old = self.buckets[first][:index], self.buckets[first][index:]
        last, after = first, list(old)
        behind = offset + sum(len(p) for p, _ in after)  # end of what was taken from the tree

        def more() -> bool:
            nonlocal last, behind
            if last + 1 >= len(self.buckets):
                return False
            last += 1
            after.extend(self.buckets[last])
            behind += self.chars[self.size + last]
            return True

        while behind < start + removed and more():
            pass
        while True:
            taken = "".join(p for p, _ in after)
            text = taken[: start - offset] + inserted + taken[start - offset + removed :]
            shift = len(inserted) - removed
            borders, reach = {}, offset
            for k, (piece, _) in enumerate(after):
                if reach >= start + removed:
                    borders[reach + shift - offset] = k
                reach += len(piece)
            final = last + 1 >= len(self.buckets)
            fresh, place, joint = [], 0, None
            for match in self.count.pattern.finditer(text):
                if place in borders and place >= start - offset + len(inserted):
                    joint = borders[place]
                    break
                # the last pieces of what was taken may go on in the next bucket
                if not final and match.end() >= len(text) - 1:
                    place = None
                    break
                fresh.append(match.group())
                place = match.end()
            if place is None or (joint is None and not final):
                if more():
                    continue
            break
        tail = after[joint:] if joint is not None else []
        made = [(p, self.count[p]) for p in fresh]
        self.encoded += len(made)
        self._set(first, head + made + tail)
        for k in range(first + 1, last + 1):
            self._set(k, [])
        if len(self.buckets[first]) > 4 * BUCKET:
            self._build(self.leaves())
        return len(made)


def _apply(tree: Tree, edits: list[dict] | None) -> None:
    for e in sorted(edits or (), key=lambda e: e["seq"] or 0):
        tree.replace(e["start"] or 0, e["removed"] or 0, e["inserted"] or "")


def _stored(rows: DataFrame, path: str, pattern: str, tree: Callable[..., Tree]) -> DataFrame:
    """The trees that `tree` makes of a counter and the columns behind the id, as rows of STATE."""
    kind = id_type(rows)

    def make():
        count = counter(path, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [tree(count, *own) for own in zip(*(c.to_pylist() for c in batch.columns[1:]))]
            lists = [
                [[len(p) for p, _ in t.leaves()] for t in made], [[n for _, n in t.leaves()] for t in made],
                [t.chars[1:] for t in made], [t.tokens[1:] for t in made],
            ]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_type(kind)), pa.array([t.text() for t in made])]
                + [pa.array(v, pa.int64()) for v in ([t.n_tokens() for t in made], [t.encoded for t in made])]
                + [pa.array(v, pa.list_(pa.int64())) for v in lists],
                ["doc_id", "text", "n_tokens", "n_encoded", *LISTS],
            )

        return step

    lists = ", ".join(f"{c} array<long>" for c in LISTS)
    return map_rows(rows, f"doc_id {kind}, text string, n_tokens long, n_encoded long, {lists}", make)


#: Per pre-token, and per node of the tree from its root on.
LISTS = ("piece_chars", "piece_tokens", "sum_chars", "sum_tokens")


def states(docs: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The trees as rows: doc_id, text, n_tokens, n_encoded (0: no edit yet), and LISTS."""
    return _stored(texts(docs), path, pattern, Tree)


def advance(
    stored: DataFrame, edits: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """The states after `edits` (as for count_edited()) of states that were stored.

    n_encoded is the number of pre-tokens that these edits had encoded; rows without edits encode none.
    """

    def tree(count: Counter, text: str, chars: list[int], tokens: list[int], own: list[dict] | None) -> Tree:
        made = Tree.restored(count, text, chars, tokens)
        _apply(made, own)
        return made

    found = edits.select(F.col("doc_id").alias("edited_id"), "edits")
    rows = stored.join(found, stored["doc_id"] == found["edited_id"], "left")
    return _stored(rows.select(stored["doc_id"], "text", "piece_chars", "piece_tokens", "edits"), path, pattern, tree)


def count_edited(
    docs: DataFrame, edits: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """Counts before and after edits.

    `edits` has one row per document: doc_id and edits, an array of (seq, start, removed, inserted). Returns
    doc_id, n_tokens, n_tokens_edited, n_pieces, n_edits and n_encoded, the pre-tokens that edits had encoded.
    """
    own = texts(docs)
    found = edits.select(F.col("doc_id").alias("edited_id"), "edits")
    return _counted(own.join(found, own["doc_id"] == found["edited_id"], "left").drop("edited_id"), path, pattern)


def _counted(
    rows: DataFrame, path: str, pattern: str, edits_of: Callable[[str, object], list[dict] | None] = lambda _, edits: edits
) -> DataFrame:
    """As count_edited(), over rows of doc_id, text and what `edits_of` turns into the edits of the text."""
    kind = id_type(rows)

    def make():
        count = counter(path, pattern)

        def one(text: str, given: object) -> tuple[int, int, int, int, int]:
            tree, edits = Tree(count, text), edits_of(text, given)
            before, pieces = tree.n_tokens(), sum(map(len, tree.buckets))
            _apply(tree, edits)
            return before, tree.n_tokens(), pieces, len(edits or ()), tree.encoded

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = zip(*map(one, batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_type(kind)), *[pa.array(v, pa.int64()) for v in made]],
                ["doc_id", *COUNTS],
            )

        return step

    return map_rows(rows, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS), make)


COUNTS = ("n_tokens", "n_tokens_edited", "n_pieces", "n_edits", "n_encoded")


def release_edits(text: str, source: str | None) -> list[dict]:
    """The edits of a release: e-mail addresses replaced, the source named on a last line.

    One walk over the text finds the addresses; the last place comes first, so that no edit moves another.
    """
    named = "\nSource: " + ("unknown" if source is None else source)
    return [{"seq": -len(text) - 1, "start": len(text), "removed": 0, "inserted": named}] + [
        {"seq": -start, "start": start, "removed": end - start, "inserted": "[email]"} for start, end in emails(text)
    ]


def edit_counts(docs: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Counts of each text before and after release_edits()."""
    return _counted(texts(docs, "doc_id", "text", "source"), path, pattern, release_edits)
