"""Byte-level byte-pair encoding and decoding by dynamic programming over byte prefixes.

For each prefix of a piece there is exactly one token that its encoding ends with. It is found among
the tokens that are suffixes of the prefix, longest first, as a trie over reversed tokens lists them: the one that
may stand behind the last token of the shorter prefix that it leaves. Pieces that are new to a worker are taken
in sorted order, so that one begins with the stored prefixes it shares with the one before. Storing that token for each prefix makes appending exact, since stored
prefixes never change, and an edit needs work only from its place to where the stored tokens agree
again for as many bytes as the longest token has. Time is linear in the piece.

Two tokens may stand side by side when merging their bytes from scratch keeps the border between them.
That is read off the tokens that lie at the border while both are being built.

Defined results: null text is empty and has no tokens; invalid UTF-8 is read with replacement
characters; null and repeated ids keep their rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sheafmill.llm.common import arrow_type, as_bytes, id_type, map_rows, texts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Pieces up to this many characters are remembered, so many of them in each of two generations.
SHORT, REMEMBERED = 48, 400_000
#: Bytes of text that are split and looked up together.
TOGETHER = 2 << 20
#: Stands for the beginning of a piece where a token has none before it.
_FIRST = -1


class Vocabulary:
    """Ranked tokens, and which of them may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks))
        #: Trie over reversed tokens, and for each node the tokens that end its string, longest first.
        self.child: dict[int, int] = {}
        self.endings: list[tuple] = [()]
        for token in sorted(ranks, key=len):
            node = 0
            for byte in reversed(token):
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.endings)
                    self.endings.append(self.endings[node])
                node = self.child[key]
            self.endings[node] = ((len(token) - 1, ranks[token]), *self.endings[node])
        self.sizes = list(map(len, self.tokens))
        #: Token that one more byte makes of a token.
        self.grown = {ranks[t[:-1]] << 8 | t[-1]: rank for t, rank in ranks.items() if t[:-1] in ranks}
        self._right: dict[int, tuple] = {}
        self._left: dict[int, tuple] = {}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._beside: dict[tuple[int, int], bool] = {}

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merge into this one; None for bytes and for tokens no merge makes."""
        if token not in self._parts:
            self._parts[token] = self._unmerge(token)
        return self._parts[token]

    def _unmerge(self, token: int) -> tuple[int, int] | None:
        data = self.tokens[token]
        pieces = [data[i : i + 1] for i in range(len(data))]
        while len(pieces) > 2:
            joined = [(self.ranks.get(a + b, token), i) for i, (a, b) in enumerate(zip(pieces, pieces[1:]))]
            rank, i = min(joined)
            if rank >= token:
                return None
            pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        return (self.ranks[pieces[0]], self.ranks[pieces[1]]) if len(pieces) == 2 else None

    def reachable(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self.parts(token) is not None

    def _edge(self, token: int, side: int) -> tuple:
        """(bytes, rank of what absorbs it) of the tokens at one end, from the whole token inwards."""
        known = self._left if side == 0 else self._right
        if token not in known:
            found, absorbed, at = [], len(self.tokens), token
            while True:
                found.append((self.tokens[at], absorbed))
                parts = self.parts(at)
                if parts is None:
                    break
                absorbed, at = at, parts[side]
            known[token] = tuple(found)
        return known[token]

    def beside(self, a: int, b: int) -> bool:
        """Whether b can be made, and the border between a and b survives when their joined bytes are encoded."""
        key = (a, b)
        known = self._beside.get(key)
        if known is None:
            if len(self._beside) > 1_000_000:
                self._beside.clear()
            get, none = self.ranks.get, len(self.tokens)
            known = self.reachable(b) and (a == _FIRST or not any(
                (rank := get(x + y, none)) < x_ends and rank <= y_ends and rank < none
                for x, x_ends in self._edge(a, 1)
                for y, y_ends in self._edge(b, 0)
            ))
            self._beside[key] = known
        return known

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> list[int]:
        """`last`, the last token of each known prefix, grown to all prefixes of `data`."""
        child, endings, known, beside = self.child.get, self.endings, self._beside.get, self.beside
        grown, sizes, token = self.grown.get, self.sizes, last[-1] if last else _FIRST
        for end in range(len(last), len(data) if stop is None else stop):
            if end:  # the last token and one more byte is what fits most often, and only one token fits
                longer = grown(token << 8 | data[end])
                if longer is not None:
                    start = end - sizes[token]
                    left = last[start - 1] if start else _FIRST
                    if known((left, longer)) or beside(left, longer):
                        last.append(longer)
                        token = longer
                        continue
            node = 0
            for at in range(end, -1, -1):
                longer = child(node << 8 | data[at])
                if longer is None:
                    break
                node = longer
            for before, token in endings[node]:
                left = last[end - before - 1] if before < end else _FIRST
                if known((left, token)) or beside(left, token):
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends the first {end + 1} bytes")
        return last

    def ids(self, last: list[int]) -> list[int]:
        """The encoding that the stored last tokens spell, read from the end."""
        found, at = [], len(last)
        while at:
            found.append(last[at - 1])
            at -= len(self.tokens[found[-1]])
        return found[::-1]

    def encode_piece(self, data: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(data)
        return (whole,) if whole is not None else tuple(self.ids(self.extend(data, [])))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Encoded:
    """A piece with its prefix table: append exactly, or replace a range and re-encode nearby."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data = vocabulary, data
        self.last = vocabulary.extend(data, [])

    def ids(self) -> list[int]:
        return self.vocabulary.ids(self.last)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.data, self.last)

    def replace(self, start: int, end: int, by: bytes) -> int:
        """Put `by` for data[start:end]; returns how many prefixes were computed."""
        data = self.data[:start] + by + self.data[end:]
        old, shift, need = self.last, start + len(by) - end, self.vocabulary.longest
        last, same = old[:start], 0
        while len(last) < len(data):
            self.vocabulary.extend(data, last, len(last) + 1)
            at = len(last) - 1
            inside = at >= start + len(by)
            same = same + 1 if inside and old[at - shift] == last[at] else 0
            if same == need:
                last += old[len(last) - shift :]
                break
        done = len(data) if same < need else at + 1
        self.data, self.last = data, last
        return done - start


class Pieces:
    """Encodings of pieces by their text; short ones are remembered, what is in use stays."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.young, self.old = vocabulary, {}, {}

    def of(self, lists: list[list[str]]) -> dict[str, tuple[int, ...]]:
        """Encodings of at least the pieces in `lists`."""
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        long, unseen = {}, []
        for piece in set().union(*lists).difference(young):
            if piece in old:
                young[piece] = old[piece]
            else:
                unseen.append((piece.encode(), piece))
        ranks, extend, ids = self.vocabulary.ranks, self.vocabulary.extend, self.vocabulary.ids
        before, last = b"", []
        for data, piece in sorted(unseen):
            whole = ranks.get(data)
            if whole is None:
                shared = 0
                for a, b in zip(before, data):
                    if a != b:
                        break
                    shared += 1
                before, last = data, extend(data, last[:shared])
                made = tuple(ids(last))
            else:
                made = (whole,)
            (young if len(piece) <= SHORT else long)[piece] = made
        return {**young, **long} if long else young


@lru_cache(maxsize=4)
def vocabulary(path: str = RANKS) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


@lru_cache(maxsize=4)
def splitter(pattern: str = public_tokenizers.PATTERN):
    """Texts to pieces. Texts of Latin letters take the standard library's engine, for which the pattern's
    classes are spelled out; all others take the pattern itself."""
    whole = regex.compile(pattern).findall
    if pattern != public_tokenizers.PATTERN:
        return whole
    odd = re.compile(r"[^\t\n\r -~À-ÖØ-öø-ſ]").search
    quick = re.compile(
        r" ?[A-Za-zÀ-ÖØ-öø-ſ]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ſ]+|\s+(?!\S)|\s+"
    ).findall
    return lambda text: whole(text) if odd(text) else quick(text)


@lru_cache(maxsize=4)
def coder(path: str = RANKS, pattern: str = public_tokenizers.PATTERN):
    """One per Python worker: texts to lists of ids, by the pieces that the pattern matches."""
    known, split = Pieces(vocabulary(path)), splitter(pattern)

    def encode(texts: list[str]) -> list[list[int]]:
        lists = list(map(split, texts))
        find = known.of(lists).__getitem__
        return [list(chain.from_iterable(map(find, pieces))) for pieces in lists]

    return encode


def together(texts: list[bytes]) -> Iterator[list[str]]:
    """Texts in groups of some TOGETHER bytes, decoded."""
    group, size = [], 0
    for text in texts:
        group.append(text.decode("utf-8", "replace"))
        size += len(text)
        if size > TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and ids of each row."""
    kind = id_type(docs)

    def make():
        ids = coder(path, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [x for group in together(as_bytes(batch.column(1))) for x in ids(group)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_type(kind)), pa.array(made, pa.list_(pa.int32()))],
                ["doc_id", "ids"],
            )

        return step

    return map_rows(texts(docs), f"doc_id {kind}, ids array<int>", make)


def decode(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id and the bytes that the ids stand for."""
    kind = id_type(encoded)

    def make():
        back = vocabulary(path).decode

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [back(ids or ()) for ids in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_type(kind)), pa.array(made, pa.binary())], ["doc_id", "data"]
            )

        return step

    return map_rows(encoded.select("doc_id", "ids"), f"doc_id {kind}, data binary", make)


def round_trip(docs: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes decoded from them, in one pass."""
    kind = id_type(docs)

    def make():
        ids_of, known = coder(path, pattern), vocabulary(path)
        spelled = list(map(str, range(len(known.tokens))))

        def one(ids: list[int]) -> tuple[int, str, str]:
            listed = " ".join(map(spelled.__getitem__, ids)).encode()
            return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(known.decode(ids)).hexdigest()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = (one(x) for group in together(as_bytes(batch.column(1))) for x in ids_of(group))
            n, ids, data = zip(*made)
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_type(kind)), pa.array(n, pa.int64()), pa.array(ids), pa.array(data)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return step

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(texts(docs), schema, make)
