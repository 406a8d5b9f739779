"""Personal data, and the terms around it that would give it away.

Base spans are e-mail addresses, IP addresses, card and telephone numbers. Beyond them, the corpus tells which
terms reveal a protected entity: with N texts, of which n(e) hold the entity, n(t) the term and n(e, t) the
term among the NEAR words on either side of the entity, words in base spans left aside, pointwise mutual
information log2(n(e, t) N / (n(e) n(t))) is compared with the information log2(N / n(e)) that the entity
itself carries. A term at DISCLOSES of it or more is generalised, at REMOVES of it or more removed, where it
stands near that entity. A text counts once however often it holds both. Evidence must come from SUPPORT texts
with different surroundings (of several in a text the one with the least hash counts), so that neither copies of
a text nor repetition inside it are evidence.

Counts are over all texts. Term counts need only the terms that stand near entities often enough; those are
announced to all tasks by a bitmap of fixed size, and what its collisions let through is dropped by the join.

Defined results: null text is empty and has no spans; rows that repeat an id are texts of their own; a null id
keeps its row; an empty table gives an empty result; other columns are kept by sanitise() and not read else.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import arrow_type, as_bytes, id_type, map_rows, materialise, texts

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
NEAR = 5
SUPPORT = 2
DISCLOSES, REMOVES = 0.8, 1.0
#: Bits of the map that announces terms: half a megabyte, whatever the corpus.
MAP_BITS = 22

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"[0-9]")


def emails(text: str):
    """Each @ with the longest name before it and a dotted domain behind it; linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = domain.end()
                yield start, done
                at = text.find("@", done)
                continue
        at = text.find("@", at + 1)


def addresses(text: str):
    for chain in _DOTTED.finditer(text):
        if "." not in chain.group():
            continue
        parts, at = chain.group().split("."), chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def cards(text: str):
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGITS.findall(m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in order."""
    found = []
    for kind, find in enumerate((emails, addresses, cards, phones)):
        if kind != 3 or "+" in text:
            found += [(start, kind, end) for start, end in find(text)]
    return sorted(found)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(*KINDS, TERM)[kind]}:{start}:{end}" for start, kind, end in spans)


def words_outside(text: str, spans: list[tuple[int, int, int]]) -> tuple[array, array]:
    """Starts and ends of the words that touch no span, in order; one walk along text and spans."""
    starts, stops = array("q"), array("q")
    k, taken = 0, 0
    for m in _WORD.finditer(text):
        while k < len(spans) and spans[k][0] < m.end():
            taken = max(taken, spans[k][2])
            k += 1
        if m.start() >= taken:
            starts.append(m.start())
            stops.append(m.end())
    return starts, stops


def surroundings(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """The NEAR words on either side of each entity, of those outside all spans: entity, term, place, hash of
    the surroundings. An entity without any has one row with an empty term, so that its text counts."""
    if not spans:
        return []
    rows = []
    starts, stops = words_outside(text, spans)
    for start, kind, end in spans:
        at = bisect_left(starts, start)
        near = range(max(0, at - NEAR), min(len(starts), at + NEAR))
        words = [text[starts[i] : stops[i]].lower() for i in near]
        around = crc32(" ".join(words).encode())
        entity = f"{KINDS[kind]}:{text[start:end].lower()}"
        rows += [
            {"entity": entity, "term": word, "start": starts[i], "stop": stops[i], "around": around}
            for i, word in zip(near, words)
        ] or [{"entity": entity, "term": "", "start": start, "stop": start, "around": around}]
    return rows


_NEAR_TYPE = "array<struct<entity:string,term:string,start:long,stop:long,around:long>>"
_NEAR_ARROW = pa.list_(pa.struct([
    ("entity", pa.string()), ("term", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
    ("around", pa.int64()),
]))
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64())]))


def find(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_crc, base spans, and the terms near them."""
    kind = id_type(docs)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            crcs, spans, near = [], [], []
            for data in as_bytes(batch.column(1)):
                text = data.decode("utf-8", "replace")
                own = base_spans(text)
                crcs.append(crc32(data))
                spans.append([{"start": s, "kind": k, "stop": e} for s, k, e in own])
                near.append(surroundings(text, own))
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_type(kind)), pa.array(crcs, pa.int64()),
                 pa.array(spans, _SPAN_ARROW), pa.array(near, _NEAR_ARROW)],
                ["doc_id", "text_crc", "base", "near"],
            )

        return step

    schema = f"doc_id {kind}, text_crc long, base array<struct<start:long,kind:int,stop:long>>, near {_NEAR_TYPE}"
    return map_rows(texts(docs), schema, make)


def announce(terms: DataFrame) -> bytes:
    """The bitmap of the hashes of `terms` (column term)."""
    bit = F.crc32(F.encode("term", "UTF-8")).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    rows = terms.select(F.shiftright(bit, 3).cast("int").alias("at"), bit.bitwiseAND(F.lit(7)).alias("bit"))
    made = bytearray(1 << (MAP_BITS - 3))
    marks = rows.distinct().groupBy("at").agg(F.sum(F.expr("shiftleft(1, int(bit))")).alias("bits"))
    for row in marks.collect():  # at most one row per byte of the map
        made[row["at"]] = row["bits"]
    return bytes(made)


def term_counts(docs: DataFrame, announced: bytes) -> DataFrame:
    """term and n_term, the number of texts that hold it, for all announced terms."""
    sent, mask = docs.sparkSession.sparkContext.broadcast(announced), (1 << MAP_BITS) - 1

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts: dict[str, int] = {}
            bits = sent.value
            for data in as_bytes(batch.column(1)):
                for word in set(_WORD.findall(data.decode("utf-8", "replace").lower())):
                    h = crc32(word.encode()) & mask
                    if bits[h >> 3] >> (h & 7) & 1:
                        counts[word] = counts.get(word, 0) + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"]
            )

        return step

    return map_rows(texts(docs), "term string, n long", make).groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosures(docs: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """(entity, term, removed) for the terms that reveal an entity."""
    near = found.select("row", F.explode("near").alias("w")).select("row", "w.entity", "w.term", "w.around")
    held = near.groupBy("entity", "row").agg(F.lit(1)).groupBy("entity").agg(F.count("*").alias("n_entity"))
    texts_of = near.filter("term <> ''").groupBy("entity", "term", "row").agg(F.min("around").alias("around"))
    alike = texts_of.groupBy("entity", "term", "around").agg(F.count("*").alias("n"))
    pairs = alike.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("support"))
    pairs = materialise(pairs.filter(F.col("support") >= SUPPORT).join(held, "entity"), "near-terms")
    counts = term_counts(docs, announce(pairs.select("term")))
    carried = F.log2(F.lit(float(max(total, 1))) / F.col("n_entity"))
    shared = F.log2(F.col("n_both") * F.lit(float(max(total, 1))) / (F.col("n_entity") * F.col("n_term")))
    judged = pairs.join(counts, "term").withColumns({"carried": carried, "shared": shared})
    return judged.filter((F.col("carried") > 0) & (F.col("shared") >= DISCLOSES * F.col("carried"))).select(
        "entity", "term", (F.col("shared") >= REMOVES * F.col("carried")).alias("removed")
    )


def all_spans(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, text_crc, base, and terms, an array of (start, stop, removed)."""
    # Numbered before they are written: a second scan may cut the files differently.
    found = materialise(find(docs).withColumn("row", F.monotonically_increasing_id()), "private-spans")
    told = disclosures(docs, found, found.count())
    near = found.select("row", F.explode("near").alias("w")).select("row", "w.entity", "w.term", "w.start", "w.stop")
    terms = (
        near.join(told, ["entity", "term"])
        .groupBy("row", "start", "stop").agg(F.max("removed").alias("removed"))
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "removed"))).alias("terms"))
    )
    return found.join(terms, "row", "left").select("doc_id", "text_crc", "base", "terms")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_term per row."""
    kind = id_type(docs)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for base, terms in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = [(s["start"], s["kind"], s["stop"]) for s in base or ()]
                more = [(t["start"], len(KINDS), t["stop"]) for t in terms or ()]
                digest = hashlib.sha256(spelled(own).encode()).hexdigest()
                counts = [[k for _, k, _ in own].count(n) for n in range(len(KINDS))]
                rows.append((*counts, digest, spelled(sorted(own + more)), len(more)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_type(kind))] + [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_term"],
            )

        return step

    schema = (
        f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
        + ", base_sha256 string, spans string, n_term long"
    )
    return map_rows(all_spans(docs).select("doc_id", "base", "terms"), schema, make)


def rewrite(text: str, base: list, terms: list) -> str:
    """The text with entities named by kind, disclosing terms generalised or removed; overlaps as one."""
    base, terms = (() if x is None else x for x in (base, terms))  # pandas hands over numpy arrays
    marks = [(s["start"], s["stop"], f"[{KINDS[s['kind']].upper()}]") for s in base]
    marks += [(t["start"], t["stop"], "" if t["removed"] else "[TERM]") for t in terms]
    made, at = [], 0
    for start, stop, by in sorted(marks):
        if start >= at:
            made += [text[at:start], by]
        at = max(at, stop)
    return "".join([*made, text[at:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs`, all columns, with texts rewritten; n_chars, where there is one, follows the text."""
    own = texts(docs, id_col, text_col)
    spans = all_spans(own).filter("size(base) > 0").groupBy("doc_id", "text_crc").agg(
        F.first("base").alias("_base"), F.first("terms").alias("_terms")
    ).select(F.col("doc_id").alias("_id"), F.col("text_crc").alias("_crc"), "_base", "_terms")
    crc = F.crc32(F.encode(F.coalesce(docs[text_col].cast("string"), F.lit("")), "UTF-8"))
    joined = docs.join(spans, docs[id_col].eqNullSafe(spans["_id"]) & (crc == spans["_crc"]), "left")

    @F.pandas_udf("string")
    def rewritten(text, base, terms):
        made = [t if b is None else rewrite(t, b, t2) for t, b, t2 in zip(text, base, terms)]
        return text.__class__(made, dtype=object)

    none = spans["_base"].isNull()
    new = F.when(none, docs[text_col]).otherwise(
        rewritten(docs[text_col].cast("string"), spans["_base"], spans["_terms"])
    )
    changed = {text_col: new}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(none, docs["n_chars"]).otherwise(F.char_length(new).cast(kind))
    return joined.select(*[changed.get(c, docs[c]).alias(c) for c in docs.columns])
