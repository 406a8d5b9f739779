"""Byte-pair merging of many pieces at once, on flat arrays inside one task."""

from __future__ import annotations

import heapq
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

#: Symbols of a piece from which on single merges go through a heap.
LONG = 48
#: Pieces of one size that are merged side by side, and symbols up to which a grid holds every pair.
SIDE_BY_SIDE, GRID = 1 << 14, 1 << 10
NO_RANK = np.iinfo(np.int32).max
_WIDTH = np.int64(1 << 32)


@dataclass(frozen=True)
class PairTable:
    """Which neighbouring symbols merge, how early, and into what; sorted by pair code."""

    codes: np.ndarray
    ranks: np.ndarray
    results: np.ndarray

    @classmethod
    def of(cls, pairs: list[tuple[int, int, int, int]]) -> PairTable:
        """From (left, right, rank, result) entries."""
        table = np.array(pairs, dtype=np.int64).reshape(-1, 4)
        codes = table[:, 0] * _WIDTH + table[:, 1]
        order = np.argsort(codes, kind="stable")
        return cls(codes[order], table[order, 2].astype(np.int32), table[order, 3].astype(np.int32))

    def as_dict(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.codes.tolist(), zip(self.ranks.tolist(), self.results.tolist())))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = left.astype(np.int64) * _WIDTH + right
        at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        return at, self.codes[at] == wanted

    def places(self, top: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """A function from left and right symbols, all below `top`, to the entry of each pair; one past the last if it has none."""
        none = len(self.codes)
        top = max(top, int((self.codes >> 32).max()) + 1, int((self.codes & 0xFFFFFFFF).max()) + 1, int(self.results.max()) + 1)
        if top <= GRID:
            grid = np.full(top * top, none, np.int32)
            grid[(self.codes >> 32) * top + (self.codes & 0xFFFFFFFF)] = np.arange(none, dtype=np.int32)
            return lambda left, right: grid[left * top + right]

        def searched(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            at, found = self.look_up(left, right)
            return np.where(found, at, none)

        return searched


def merge_long(symbols: list[int], pairs: dict[int, tuple[int, int]]) -> list[int]:
    """One merge after the other, earliest rank and then leftmost first: a heap over linked symbols."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [
        (found[0], i, symbols[i], symbols[i + 1])
        for i in range(n - 1)
        if (found := pairs.get(symbols[i] << 32 | symbols[i + 1]))
    ]
    heapq.heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if gone[i] or j >= n or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i] = pairs[left << 32 | right][1]
        gone[j], after[i] = 1, after[j]
        if after[i] < n:
            before[after[i]] = i
        for at in (before[i], i):
            if at >= 0 and after[at] < n:
                found = pairs.get(symbols[at] << 32 | symbols[after[at]])
                if found:
                    heapq.heappush(heap, (found[0], at, symbols[at], symbols[after[at]]))
    return [s for s, g in zip(symbols, gone) if not g]


def _merge_columns(
    columns: np.ndarray, piece: np.ndarray, table: PairTable, places: Callable
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Pieces of one size, one in each column, with one merge in every piece a step until none has a pair left.

    Pieces that go on all lose one symbol a step, so they stay of one size. The ranks of their pairs are kept and
    moved along; only the two pairs beside a merge are looked up anew.
    """
    ranks, results = np.append(table.ranks, NO_RANK), np.append(table.results, 0).astype(columns.dtype)
    rank = ranks[places(columns[:-1], columns[1:])]
    done_symbols, done_piece = [], []
    while len(rank):
        best = rank.min(axis=0)
        open_ = best != NO_RANK
        if not open_.all():
            done_symbols.append(columns[:, ~open_].T.ravel())
            done_piece.append(np.repeat(piece[~open_], len(columns)))
            on = np.flatnonzero(open_)
            columns, rank, piece, best = columns.take(on, 1), rank.take(on, 1), piece[on], best[on]
        if not len(piece):
            return done_symbols, done_piece
        at = np.zeros(len(piece), np.int8)
        for k in range(len(rank) - 1, -1, -1):  # the leftmost of those that rank first
            np.copyto(at, np.int8(k), where=rank[k] == best)
        every = np.arange(len(piece))
        made = results[places(columns[at, every], columns[at + 1, every])]
        row = np.arange(len(rank), dtype=np.int8)[:, None]
        columns = np.where(row > at, columns[1:], columns[:-1])
        columns[at, every] = made
        rank = np.where(row[:-1] >= at, rank[1:], rank[:-1])
        own = np.flatnonzero(at > 0)
        left = at[own] - 1
        rank[left, own] = ranks[places(columns[left, own], made[own])]
        own = np.flatnonzero(at < len(rank))
        rank[at[own], own] = ranks[places(made[own], columns[at[own] + 1, own])]
    return [*done_symbols, columns.T.ravel()], [*done_piece, np.repeat(piece, len(columns))]


def merge_pieces(
    symbols: np.ndarray, piece: np.ndarray, table: PairTable, one_by_one: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Merge the earliest-ranked pair of every piece until no piece has one left.

    `symbols` are the symbols of all pieces in a row, `piece` tells which piece each belongs to.
    All pieces advance together; finished ones drop out. `one_by_one` merges a single pair per
    piece and step, which matters when a merged symbol can be part of an earlier-ranked pair; that
    would take as many passes as a piece has symbols, so pieces above LONG go through a heap and the others
    side by side with those of their size.
    """
    done_symbols, done_piece = [], []
    if one_by_one and len(symbols) and len(table.codes):
        starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
        sizes = np.diff(np.append(starts, len(piece)))
        pairs = table.as_dict() if (sizes > LONG).any() else {}
        for start, size in zip(starts[sizes > LONG], sizes[sizes > LONG]):
            merged = merge_long(symbols[start : start + size].tolist(), pairs)
            done_symbols.append(np.array(merged, symbols.dtype))
            done_piece.append(np.full(len(merged), piece[start]))
        places = table.places(int(symbols.max()) + 1)
        for size in np.unique(sizes[sizes <= LONG]):
            own = starts[sizes == size]
            for at in range(0, len(own), SIDE_BY_SIDE):
                some = own[at : at + SIDE_BY_SIDE]
                merged = _merge_columns(symbols[some + np.arange(size)[:, None]], piece[some], table, places)
                done_symbols += merged[0]
                done_piece += merged[1]
        symbols, piece = symbols[:0], piece[:0]
    while len(symbols) and len(table.codes):
        at, found = table.look_up(symbols[:-1], symbols[1:])
        found &= piece[:-1] == piece[1:]
        rank = np.append(np.where(found, table.ranks[at], NO_RANK), NO_RANK)
        starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
        sizes = np.diff(np.append(starts, len(piece)))
        best = np.repeat(np.minimum.reduceat(rank, starts), sizes)

        open_ = best != NO_RANK
        if not open_.all():
            done_symbols.append(symbols[~open_])
            done_piece.append(piece[~open_])
        chosen = open_ & (rank == best)
        if one_by_one:
            hits = np.flatnonzero(chosen)
            first = np.append(True, piece[hits[1:]] != piece[hits[:-1]]) if len(hits) else chosen[:0]
            chosen = np.zeros_like(chosen)
            chosen[hits[first]] = True
        else:
            chosen = _every_other(chosen)
        left = np.flatnonzero(chosen)
        symbols = symbols.copy()
        symbols[left] = table.results[at[left]]
        open_[left + 1] = False
        symbols, piece = symbols[open_], piece[open_]
    done_symbols.append(symbols)
    done_piece.append(piece)
    symbols, piece = np.concatenate(done_symbols), np.concatenate(done_piece)
    order = np.argsort(piece, kind="stable")
    return symbols[order], piece[order]


def _every_other(chosen: np.ndarray) -> np.ndarray:
    """In runs of overlapping pairs keep the 1st, 3rd, ...: a pair uses up its right neighbour."""
    at = np.flatnonzero(chosen)
    if not len(at):
        return chosen
    run_start = np.maximum.accumulate(np.where(np.append(True, np.diff(at) != 1), np.arange(len(at)), 0))
    kept = np.zeros_like(chosen)
    kept[at[(np.arange(len(at)) - run_start) % 2 == 0]] = True
    return kept
