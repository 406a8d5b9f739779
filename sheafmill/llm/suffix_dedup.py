"""Removal of byte strings that occurred before, by column-wise Burrows-Wheeler construction.

The kernel takes a collection of byte strings and inserts one symbol of each string per round, from the
right: a round turns the transform of all suffixes of up to j symbols into that of up to j + 1, and
updates the common prefixes of neighbours along with it. Its arrays are read and rewritten from front
to back each round, as sequential files would be. Suffixes that stand side by side with WINDOW or more
common symbols are equal windows; all but the earliest are repeats.

Rounds are as many as the longest string has symbols, so whole documents cannot be strings: a text of
100 KB would take 100,000 passes over everything. Instead every window is handed, by its content alone,
to an anchor: its GRAM-byte substring with the least hash. Equal windows have equal anchors at equal
places. The run of windows that share one anchor is a context of at most 2 * WINDOW - GRAM bytes.

1. Contexts go to their anchor's hash. An equal context further on is a repeat as a whole; a context whose
   anchor has no second context is unique. (Within a batch, equal contexts meet before the shuffle.)
2. The first of each class of contexts, where an anchor has several, is split at the middle, so that all
   its windows share half the bytes beside the anchor too, and goes to the hash of these bytes.
3. Contexts that share those bytes make collections of bounded size for the kernel. Where more than CROWD
   do, their windows are grouped by a 128-bit hash instead, as rows.
4. Ranges of repeats meet their document again, which is cut and digested.

Texts travel compressed. Nothing is kept outside Spark's own shuffles and the checkpoint folder.

Defined results: null text is empty; texts under WINDOW bytes are left whole; every row is a document of its
own, also where rows share an id or have none: such rows follow each other by the SHA-256 of their texts, null
ids first, so that a passage stays in the first of them; an empty table gives an empty result; other columns
are not read. Ids must be integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import as_bytes, materialise, texts

WINDOW, GRAM = 100, 32
#: Contexts with the same bytes in the middle that one task takes into collections, at most.
CROWD = 2048
#: Bytes of one collection for the kernel.
COLLECTION = 1 << 18
_BLOCK = 1 << 19
_A, _B, _C = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_LOW = np.uint64((1 << 20) - 1)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _A
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> np.uint64(32))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def grams(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte substrings, by doubling."""
    h = _BYTE[data]
    size = 1
    while size < GRAM:
        h = (h[:-size] * _A ^ (h[:-size] >> np.uint64(29))) + h[size:] * _C
        size *= 2
    return h ^ (h >> np.uint64(32))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - width + size], values[width - size :]) if size < width else values


def contexts(data: np.ndarray, window: int = WINDOW) -> Iterator[tuple[np.ndarray, ...]]:
    """Per block of a text: first window, last window, anchor place and two hashes of each context."""
    for at in range(0, max(0, len(data) - window + 1), _BLOCK):
        g = grams(data[at : at + _BLOCK + window - 1])
        tagged = (g & ~_LOW) | np.arange(len(g), dtype=np.uint64)
        anchor = (least(tagged, window - GRAM + 1) & _LOW).astype(np.int64)
        cut = np.flatnonzero(np.diff(anchor)) + 1
        first, last = np.append(0, cut), np.append(cut, len(anchor)) - 1
        end, place = last + window - GRAM, anchor[first]
        whole = mix(g[end] + (last - first).astype(np.uint64))
        for step in range(0, 2 * window, GRAM):
            whole = mix(whole * _C + g[np.minimum(first + step, end)])
        yield first + at, last + at, place + at, g[place], whole


def _anchor_rows(window: int):
    """Batches of (id, text) to (key, ctx, doc, place, stop): contexts, and with stop > 0 sure repeats."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for doc, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            for first, last, place, g, whole in contexts(np.frombuffer(text, np.uint8), window):
                packed = (first << 14) | ((place - first) << 7) | (place - last)
                found.append((np.full(len(first), doc), packed, last + window, g, whole))
        doc, packed, stop, g, whole = (
            (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 5
        )
        key = ((g.astype(np.uint64) >> np.uint64(24) << np.uint64(24)) | (whole.astype(np.uint64) >> np.uint64(40)))
        key, ctx = key.view(np.int64), whole.astype(np.uint64).astype(np.uint32).view(np.int32)
        order = np.lexsort((packed, doc, ctx, key))
        key, ctx, doc, packed, stop = (c[order] for c in (key, ctx, doc, packed, stop))
        again = np.append(False, (key[1:] == key[:-1]) & (ctx[1:] == ctx[:-1]))[: len(key)]
        same = np.append(False, (doc[1:] == doc[:-1]) & (packed[1:] == packed[:-1]))[: len(key)] & again
        own, start, end = merged(doc[again & ~same], packed[again & ~same] >> 14, stop[again & ~same])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([key[~again], mix(own.astype(np.uint64)).view(np.int64)])),
                pa.array(np.concatenate([ctx[~again], np.zeros(len(own), np.int32)])),
                pa.array(np.concatenate([doc[~again], own])),
                pa.array(np.concatenate([packed[~again], start])),
                pa.array(np.concatenate([np.zeros(int((~again).sum()), np.int64), end])),
            ],
            ["key", "ctx", "doc", "place", "stop"],
        )

    return step


def merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges with those that touch or overlap in one document joined."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    change = np.append(True, doc[1:] != doc[:-1])
    run = np.cumsum(change)
    # a running maximum of stops that begins anew with each document
    base = run * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + base) - base
    head = change.copy()
    head[1:] |= start[1:] > reach[:-1]
    heads = np.flatnonzero(head)
    return doc[heads], start[heads], reach[np.append(heads[1:], len(doc)) - 1]


def _ranges(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        if len(part[0]):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in part], names)


def _classes(window: int):
    """Sorted rows of _anchor_rows to (doc, place, stop): repeats, and with stop 0 contexts to look into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = cls = rep = pending = None  # of the last row: anchor, class, first of the class, lone context
        for batch in batches:
            key, ctx, doc, place, stop = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            sure = stop > 0
            yield from _ranges([(doc[sure], place[sure], stop[sure])], ["doc", "place", "stop"])
            key, ctx, doc, place = (c[~sure] for c in (key, ctx, doc, place))
            n = len(key)
            if not n:
                continue
            anchor = key >> 24
            new_group = np.append((group is None) or anchor[0] != group, anchor[1:] != anchor[:-1])
            new_class = new_group | np.append(
                cls is None or (key[0], ctx[0]) != cls, (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])
            )
            at = np.maximum.accumulate(np.where(new_class, np.arange(n), -1))
            first_doc = np.where(at >= 0, doc[at], rep[0] if rep else 0)
            first_place = np.where(at >= 0, place[at], rep[1] if rep else 0)
            again = ~new_class & ((doc != first_doc) | (place != first_place))
            run_of = np.cumsum(new_group)  # 0: goes on from the batch before
            counts = np.bincount(run_of[new_class], minlength=int(run_of[-1]) + 1)
            held = group is not None and not new_group[0]
            if held:
                counts[0] += 1 if pending else 2
            look = new_class & (counts[run_of] >= 2)
            parts = [
                (doc[again], place[again] >> 14, (place[again] >> 14) + _span(place[again]) + window),
                (doc[look], place[look], np.zeros(int(look.sum()), np.int64)),
            ]
            if held and pending and counts[0] >= 2:
                parts.append(tuple(np.array([v], np.int64) for v in (*pending, 0)))
            yield from _ranges(parts, ["doc", "place", "stop"])
            if new_group.any() or counts[0] >= 2:
                pending = None
            if counts[run_of[-1]] == 1 and new_group.any():
                lone = np.flatnonzero(new_class)[-1]
                pending = (doc[lone], place[lone])
            group, cls, rep = anchor[-1], (key[-1], ctx[-1]), (first_doc[-1], first_place[-1])

    return run


def _span(place: np.ndarray) -> np.ndarray:
    """Windows of a packed context, less one."""
    return (place >> 7 & 127) - (place & 127)


def _halves(window: int):
    """(doc, places, packed text) to (part, doc, start, bytes): contexts split so that more bytes are shared."""
    side = (window - GRAM) // 2
    wide = GRAM + side

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        unpack = zstandard.ZstdDecompressor().decompress
        parts, docs, starts, held = [], [], [], []
        for doc, places, packed in zip(*(c.to_pylist() for c in batch.columns)):
            text = unpack(packed)
            if len(text) < window:
                continue
            g = grams(np.frombuffer(text, np.uint8))
            place = np.array(places, np.int64)
            first = place >> 14
            q, last = first + (place >> 7 & 127), first + _span(place)
            fits = last + window <= len(text)  # an id may repeat with another text
            for left in (True, False):
                low = first if left else np.maximum(first, q - side + 1)
                high = np.minimum(last, q - side) if left else last
                use = np.flatnonzero(fits & (low <= high))
                at = q[use] - side if left else q[use]
                key = mix(mix(g[at] + np.uint64(left)) * _C + g[at + wide - GRAM]).view(np.int64)
                parts += key.tolist()
                docs += [doc] * len(use)
                starts += low[use].tolist()
                held += [text[a : b + window] for a, b in zip(low[use].tolist(), high[use].tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int64()), pa.array(docs, pa.int64()), pa.array(starts, pa.int64()),
             pa.array(held, pa.binary())],
            ["part", "doc", "start", "bytes"],
        )

    return step


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all suffixes in order: preceding symbol + 1 (0: none), common prefix with the one before,
    string number and length. Strings end with markers that differ and come first."""
    m = len(strings)
    sizes = np.array([len(s) for s in strings])
    longest = int(sizes.max(initial=0))
    whole = np.frombuffer(b"".join(strings), np.uint8)
    kind = np.uint8 if not len(whole) or whole.max() < 255 else np.uint16
    columns = np.zeros((longest + 1, m), kind)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(m), sizes)
    columns[ends[owner] - 1 - np.arange(len(whole)), owner] = whole.astype(kind) + kind(1)
    before, common = columns[0].copy(), np.zeros(m, np.int32)
    code, at = np.arange(m, dtype=np.int64) << 32, np.arange(m)
    for size in range(longest):
        active = np.flatnonzero(sizes > size)
        order = np.argsort(before, kind="stable")
        none = int(np.searchsorted(before[order], 1))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        new = rank[at[active]]
        # common prefixes of the new suffixes and of those right behind them
        touched = np.unique(np.concatenate([new, new[new + 1 < len(order)] + 1]))
        prior = order[np.maximum(touched - 1, 0)]
        same = (touched > none) & (before[order[touched]] == before[prior])
        low, high = prior[same], order[touched[same]]
        descending = np.argsort(-low, kind="stable")
        pairs = np.stack([low[descending] + 1, high[descending] + 1], 1).ravel()
        shared = np.zeros(len(touched), np.int32)
        if len(pairs):
            found = np.empty(len(low), np.int32)
            found[descending] = np.minimum.reduceat(np.append(common, np.int32(0)), pairs)[::2] + 1
            shared[same] = found
        put = new - none + m
        fresh = np.zeros(len(order) - none + m, bool)
        fresh[put] = True
        old = ~fresh
        grown = [np.empty(len(fresh), a.dtype) for a in (before, common, code)]
        for target, source in zip(grown, (before, common, code)):
            target[old] = source
        before, common, code = grown
        before[put] = columns[size + 1, active]
        code[put] = active << 32 | (size + 1)
        common[touched - none + m] = shared
        at[active] = put
    return before, common, code >> 32, code & 0xFFFFFFFF


def repeated(
    strings: list[bytes], doc: np.ndarray, start: np.ndarray, window: int = WINDOW
) -> tuple[np.ndarray, np.ndarray]:
    """doc and place of each window of the collection that also begins earlier in it."""
    _, common, string, size = transform(strings)
    group = np.cumsum(common < window)
    shared = np.append(common[1:] >= window, False) | (common >= window)
    group, string, size = group[shared], string[shared], size[shared]
    sizes = np.array([len(s) for s in strings])
    own, place = doc[string], start[string] + sizes[string] - size
    order = np.lexsort((place, own, group))
    group, own, place = group[order], own[order], place[order]
    first = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1])[: len(group)], np.arange(len(group)), 0))
    again = (own != own[first]) | (place != place[first])
    return own[again], place[again]


def _collections(window: int, crowd: int):
    """Sorted (part, doc, start, bytes) to ranges of repeats; windows of crowded parts go on with a hash."""
    names = ["doc", "place", "stop", "h1", "h2"]

    def found(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        _, doc, start, held = zip(*rows)
        own, place = repeated(list(held), np.array(doc), np.array(start), window)
        own, place, stop = merged(own, place, place + window)
        none = np.zeros(len(own), np.int64)
        yield from _ranges([(own, place, stop, none, none)], names)

    def spread(row: tuple) -> tuple[np.ndarray, ...]:
        _, doc, start, held = row
        g = grams(np.frombuffer(held, np.uint8))
        n = len(held) - window + 1
        h1, h2 = np.full(n, _A), np.full(n, _B)
        for k in (*range(0, window - GRAM, GRAM), window - GRAM):
            h1, h2 = mix(h1 * _C + g[k : k + n]), mix(h2 * _A ^ g[k : k + n])
        place = start + np.arange(n)
        return np.full(n, doc), place, np.zeros(n, np.int64), h1.view(np.int64), h2.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []  # whole parts of two rows or more
        part: list[tuple] = []
        crowded = None
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if part and row[0] != part[-1][0]:
                    if len(part) > 1:
                        ready += part
                        size += sum(len(r[3]) for r in part)
                    part = []
                    if size > COLLECTION:
                        yield from found(ready)
                        ready, size = [], 0
                if row[0] == crowded:
                    yield from _ranges([spread(row)], names)
                    continue
                part.append(row)
                if len(part) > crowd:
                    crowded = row[0]
                    for r in part:
                        yield from _ranges([spread(r)], names)
                    part = []
        if len(part) > 1:
            ready += part
        if ready:
            yield from found(ready)

    return run


def _kept(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(id, packed text, ranges) to the figures of the document without its repeats."""
    unpack = zstandard.ZstdDecompressor().decompress
    rows = []
    for packed, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
        text = unpack(packed)
        spans, at, kept = 0, 0, hashlib.sha256()
        removed, reach = 0, -1
        for r in sorted(ranges or (), key=lambda r: (r["place"], r["stop"])):
            start, stop = r["place"], min(r["stop"], len(text))
            if stop <= max(at, start):
                continue
            if start > reach:
                spans += 1
                kept.update(text[at:start])
            removed += stop - max(at, start)
            at = reach = stop
        kept.update(text[at:])
        rows.append((len(text), removed, spans, kept.hexdigest()))
    columns = [pa.array(c) for c in zip(*rows)]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    )


def _each(step):
    return lambda batches: (step(b) for b in batches if b.num_rows)


def _packed(docs: DataFrame) -> DataFrame:
    """(doc, text, any longs) with the text compressed."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=1).compress
        made = pa.array([pack(t) for t in as_bytes(batch.column(1))], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), made, *batch.columns[2:]], names)

    names = ["doc", "packed", *docs.columns[2:]]
    more = "".join(f", {c} long" for c in docs.columns[2:])
    return docs.mapInArrow(_each(step), f"doc long, packed binary{more}")


def repeated_ranges(docs: DataFrame, window: int = WINDOW, crowd: int = CROWD) -> DataFrame:
    """(doc, place, stop): bytes of `docs` (doc, text) inside a window that also begins earlier."""
    if not GRAM + 2 <= window <= GRAM + 100:
        raise ValueError("the window must exceed the gram by 2 to 100 bytes")
    rows = docs.mapInArrow(_each(_anchor_rows(window)), "key long, ctx int, doc long, place long, stop long")
    dealt = rows.repartition(F.shiftright("key", 24)).sortWithinPartitions("key", "ctx", "doc", "place")
    classes = materialise(dealt.mapInArrow(_classes(window), "doc long, place long, stop long"), "repeat-classes")
    look = classes.filter("stop = 0").groupBy("doc").agg(F.collect_list("place").alias("places"))
    texts_of = _packed(docs).join(look, "doc").select("doc", "places", "packed")
    halves = texts_of.mapInArrow(_each(_halves(window)), "part long, doc long, start long, bytes binary")
    parts = halves.repartition("part").sortWithinPartitions("part")
    found = materialise(
        parts.mapInArrow(_collections(window, crowd), "doc long, place long, stop long, h1 long, h2 long"),
        "repeat-windows",
    )
    windows = found.filter("stop = 0")
    first = windows.groupBy("h1", "h2").agg(F.min(F.struct("doc", "place")).alias("at")).select("h1", "h2", "at.*")
    # all but the firsts; place and document are in the key, so that a window in every text is no hot key
    crowds = windows.join(first, ["h1", "h2", "doc", "place"], "left_anti")
    return (
        classes.filter("stop > 0")
        .unionByName(found.filter("stop > 0").select("doc", "place", "stop"))
        .unionByName(crowds.select("doc", "place", (F.col("place") + window).alias("stop")))
    )


def _numbered(own: DataFrame) -> DataFrame:
    """`own` (doc_id, text) with `doc`, a number for each row that ascends with the id.

    Ids that differ are such numbers. Where some are shared or missing, rows are sorted by id and digest and
    numbered in a written table; rows of one id are spread by their digests.
    """
    shared = own.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL")
    if shared.isEmpty():
        return own.withColumn("doc", F.col("doc_id"))
    order = ("doc_id", F.sha2("text", 256))
    dealt = own.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(dealt.withColumn("doc", F.monotonically_increasing_id()), "repeat-rows")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, crowd: int = CROWD
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 per row of `docs`."""
    rows = _numbered(texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")))
    own = rows.select("doc", "text")
    ranges = repeated_ranges(own, window, crowd).groupBy("doc").agg(
        F.collect_list(F.struct("place", "stop")).alias("ranges")
    )
    packed = _packed(rows.select("doc", "text", "doc_id"))
    joined = packed.join(ranges, "doc", "left").select("doc_id", "packed", "ranges")
    return joined.mapInArrow(
        _each(_kept), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
