"""Queries about pre-tokens, vocabularies, token rows, packing and bits per byte."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill import fixed
from sheafmill.catalog.base import CHUNK_ROWS, CLEAN_SQL, documents, posts, query, rounded, table
from sheafmill.catalog.corpus import _PLACED_SQL, _PROFILE_FLOATS, _PROFILE_SQL, _sharded
from sheafmill.functions import text as tx
from sheafmill.operators import corpus, profile, sequence
from sheafmill.operators import tokenizer as tk
from sheafmill.operators.ordered import with_position
from sheafmill.session import scratch_path
from sheafmill.sources import vocab as vocab_source

MERGES = 64
VOCAB_SIZE = 256 + MERGES + 4
SEQ_LEN = 512
BATCH = 16


@lru_cache(maxsize=4)
def _trained(app: str, sf_dir: str) -> tk.Vocabulary:
    return tk.train_bpe(documents(SparkSession.active(), sf_dir), VOCAB_SIZE)


def vocabulary(spark: SparkSession, d: str) -> tk.Vocabulary:
    """Trained on all documents, once per application and folder."""
    return _trained(spark.sparkContext.applicationId, d)


# A small vocabulary given beforehand, so that SQL can encode with it: each token has one split.
GIVEN = ("th", "the", "in", "ing", "er", "an", "and", "on", " t", " a")


def given_vocabulary() -> tk.Vocabulary:
    return tk.Vocabulary([bytes([b]) for b in range(256)] + [t.encode() for t in GIVEN])


# Pre-tokens in SQL. The dialect has no look-ahead and needs no possessive marks here, so the last
# space of a run that a word follows is cut off by a private character first.
_SPACE = r"\x{9}-\x{d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_BLANK = _SPACE.replace(r"\x{9}-\x{d}", r"\x{9}\x{b}\x{c}")
_CUT = r"\x{e000}"
_PATTERN = (
    fixed.SPLIT_PATTERN.replace("?+", "?").replace("++", "+").replace(r"|\s+(?!\S)", "")
    .replace(r"[^\s", f"[^{_SPACE}{_CUT}").replace(r"[^\r", rf"[^{_CUT}\r").replace(r"\s", f"[{_SPACE}]")
    .replace("'", "''")
)


def pieces_sql(text: str) -> str:
    parted = f"regexp_replace({text}, '([{_SPACE}])([{_BLANK}])([^{_SPACE}])', '\\1' || chr(57344) || '\\2\\3', 'g')"
    return f"list_filter(regexp_extract_all({parted}, '{_PATTERN}|{_CUT}'), lambda p: p <> chr(57344))"


def _merge_sql(spelled: str) -> str:
    known = set()
    for token in GIVEN:
        cut = next(c for c in range(1, len(token)) if all(len(t) == 1 or t in known for t in (token[:c], token[c:])))
        left, right = token[:cut].encode().hex().upper(), token[cut:].encode().hex().upper()
        spelled = f"replace({spelled}, '<{left}><{right}>', '<{left}{right}>')"
        known.add(token)
    return spelled


def tokens_sql(text: str) -> str:
    """Token ids of a text under the given vocabulary, as a list."""
    piece = _merge_sql("regexp_replace(hex(encode(p)), '(..)', '<\\1>', 'g')")
    names = ", ".join(f"'{t.encode().hex().upper()}'" for t in GIVEN)
    joined = f"array_to_string(list_transform({pieces_sql(text)}, lambda p: {piece}), '')"
    number = f"CASE WHEN length(t) = 2 THEN ('0x' || t)::INT ELSE 255 + list_position([{names}], t) END"
    return (
        f"CASE WHEN {text} = '' THEN [] ELSE "
        f"list_transform(string_split(rtrim(ltrim({joined}, '<'), '>'), '><'), lambda t: {number}) END"
    )


@query(
    "pretoken_counts",
    f"""WITH p AS (SELECT unnest({pieces_sql("text")}) AS piece FROM documents)
    SELECT md5(piece) AS piece_digest, count(*) AS n FROM p GROUP BY piece""",
)
def pretoken_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = tk.piece_counts(documents(spark, d))
    return counts.select(F.md5(F.col("piece").cast("binary")).alias("piece_digest"), "n")


@query(
    "pretokenize",
    f"""WITH p AS (SELECT doc_id, {pieces_sql("text")} AS pieces FROM documents)
    SELECT doc_id, len(pieces)::BIGINT AS n_pieces, md5(array_to_string(pieces, chr(0))) AS pieces_digest FROM p""",
)
def pretokenize(spark: SparkSession, d: str) -> DataFrame:
    pieces = tx.once(documents(spark, d).select("doc_id", "text"), {"pieces": tk.pieces_of("text")})
    return pieces.select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"),
        F.md5(F.array_join("pieces", "\0").cast("binary")).alias("pieces_digest"),
    )


@query(
    "pretoken_cover",
    "SELECT doc_id, md5(text) AS digest, length(text)::BIGINT AS n_chars FROM documents",
)
def pretoken_cover(spark: SparkSession, d: str) -> DataFrame:
    """Pre-tokens put together again, piece by piece, must be the text."""
    pieces = documents(spark, d).select("doc_id", tk.pieces_of("text").alias("pieces"))
    again = tx.once(pieces, {"text": F.array_join("pieces", "")})
    return again.select(
        "doc_id", F.md5(F.col("text").cast("binary")).alias("digest"),
        F.char_length("text").cast("long").alias("n_chars"),
    )


@query(
    "pair_counts",
    f"""WITH p AS (SELECT unnest({pieces_sql("text")}) AS piece FROM documents),
    c AS (SELECT hex(encode(piece)) AS h, count(*) AS n FROM p GROUP BY piece),
    q AS (SELECT h, n, unnest(range(1, length(h) - 2, 2)) AS i FROM c)
    SELECT substring(h, i, 4) AS pair, sum(n)::BIGINT AS n FROM q GROUP BY 1""",
)
def pair_counts(spark: SparkSession, d: str) -> DataFrame:
    return tk.pair_counts(documents(spark, d)).select(F.hex("pair").alias("pair"), "n")


_WALK_SQL = f"""words AS MATERIALIZED (
      SELECT regexp_replace(hex(encode(piece)), '(..)', '<\\1>', 'g') AS w, count(*)::BIGINT AS n
      FROM (SELECT unnest({pieces_sql("text")}) AS piece FROM documents) GROUP BY piece),
    walk AS (
      SELECT 0 AS step, w, n, '' AS l, '' AS r FROM words WHERE length(w) > 4
      UNION ALL
      SELECT s.step + 1, replace(s.w, '<' || b.l || '><' || b.r || '>', '<' || b.l || b.r || '>'), s.n, b.l, b.r
      FROM walk s, (
        SELECT l, r FROM (
          SELECT t[i] AS l, t[i + 1] AS r, n FROM (
            SELECT t, n, unnest(range(1, len(t))) AS i FROM (SELECT string_split(w[2:-2], '><') AS t, n FROM walk)))
        GROUP BY l, r ORDER BY sum(n) DESC, l, r LIMIT 1) b
      WHERE s.step < {MERGES}),
    learned AS (SELECT DISTINCT (step - 1)::INT AS rank, l, r FROM walk WHERE step > 0)"""


@query("bpe_merges", f'WITH RECURSIVE {_WALK_SQL} SELECT rank, l AS "left", r AS "right" FROM learned')
def bpe_merges(spark: SparkSession, d: str) -> DataFrame:
    trained = vocabulary(spark, d)
    return trained.merges_frame(spark).select("rank", F.hex("left").alias("left"), F.hex("right").alias("right"))


_CHARACTERS = "<(C[2-9A-F]|D[0-9A-F])><[89AB][0-9A-F]>"
_TOKENS_SQL = f"""{_WALK_SQL},
    tokens AS (
      SELECT i::INT AS token_id, printf('%02X', i) AS token, false AS is_special FROM range(256) t(i)
      UNION ALL SELECT 256 + rank, l || r, false FROM learned
      UNION ALL SELECT {256 + MERGES} + i::INT, hex(encode('<|reserved_' || i || '|>')), true FROM range(4) t(i)),
    spelled AS (SELECT *, regexp_replace(token, '(..)', '<\\1>', 'g') AS s FROM tokens),
    parts AS (SELECT *, regexp_replace(s, '{_CHARACTERS}', 'cc', 'g') AS p FROM spelled)"""


@query(
    "vocabulary_facts",
    f"""WITH RECURSIVE {_TOKENS_SQL} SELECT count(*) AS vocab_size, count(*) FILTER (WHERE is_special) AS n_special,
    min(token_id) FILTER (WHERE is_special) AS bos_id FROM tokens""",
)
def vocabulary_facts(spark: SparkSession, d: str) -> DataFrame:
    return tk.vocabulary_facts(vocabulary(spark, d).vocab_frame(spark))


@query(
    "token_byte_totals",
    f"""WITH e AS (SELECT doc_id, unnest({tokens_sql("text")}) AS t FROM documents)
    SELECT doc_id, count(*) AS n_tokens, sum(CASE WHEN t < 128 THEN 1 WHEN t < 256 THEN 3
      ELSE length(list_extract({list(GIVEN)}, t - 255)) END)::BIGINT AS n_bytes FROM e GROUP BY doc_id""",
)
def token_byte_totals(spark: SparkSession, d: str) -> DataFrame:
    """Bytes the metric would count per document: a token that is part of a character counts three."""
    known = given_vocabulary()
    tokens = tk.encode(documents(spark, d), known).select("doc_id", F.explode("tokens").alias("token_id"))
    return tk.with_token_bytes(tokens, known).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.sum("nbytes").alias("n_bytes")
    )


# Decoded alone, a token counts its whole characters, and three bytes for each malformed part.
_TOKEN_BYTES_SQL = f"""WITH RECURSIVE {_TOKENS_SQL}
    SELECT token_id, token, is_special, CASE WHEN is_special THEN 0 ELSE
      (length(regexp_replace(p, '<[89A-F][0-9A-F]>', '', 'g')) - 2 * len(regexp_extract_all(p, 'cc'))) // 4
      + 2 * len(regexp_extract_all(p, 'cc')) + 3 * len(regexp_extract_all(p, '<[89A-F][0-9A-F]>')) END::INT AS nbytes
    FROM parts"""


@query("token_bytes", _TOKEN_BYTES_SQL)
def token_bytes(spark: SparkSession, d: str) -> DataFrame:
    frame = vocabulary(spark, d).vocab_frame(spark)
    return frame.select("token_id", F.hex("token").alias("token"), "is_special", "nbytes")


# What is not a whole character becomes one replacement mark for each longest beginning of a character.
_WHOLE = "<[0-7].>|<(C[2-9A-F]|D.)><[89AB].>|" + "|".join(
    f"{first}{'<[89AB].>' * rest}"
    for first, rest in (
        ("<E0><[AB].>", 1), ("<(E[1-9ABCEF])><[89AB].>", 1), ("<ED><[89].>", 1),
        ("<F0><[9AB].>", 2), ("<F[123]><[89AB].>", 2), ("<F4><8.>", 2),
    )
)
_BEGUN = "<E0><[AB].>|<E[1-9ABCEF]><[89AB].>|<ED><[89].>|<F0><[9AB].>(<[89AB].>)?|<F[123]><[89AB].>(<[89AB].>)?|<F4><8.>(<[89AB].>)?|<..>"
_VOCAB_JSON_SQL = f"""WITH RECURSIVE {_TOKENS_SQL},
    marked AS (SELECT token_id, is_special, list_transform(regexp_extract_all(s, '{_WHOLE}|{_BEGUN}'),
      lambda c: CASE WHEN regexp_full_match(c, '{_WHOLE}') THEN c ELSE '<EF><BF><BD>' END) AS parts FROM spelled),
    texts AS (SELECT token_id, is_special,
      decode(unhex(regexp_replace(array_to_string(parts, ''), '[<>]', '', 'g'))) AS token FROM marked),
    entries AS (SELECT token, min(token_id) AS id FROM texts GROUP BY token),
    first AS (SELECT min(token_id) FILTER (WHERE is_special) AS bos_id FROM texts)
    SELECT '{{"vocab":{{' || string_agg(to_json(token)::VARCHAR || ':' || id, ',' ORDER BY encode(token)) || '}},"bos_id":'
      || any_value(bos_id) || '}}' AS value FROM entries, first"""


@query("vocab_json", _VOCAB_JSON_SQL)
def vocab_json(spark: SparkSession, d: str) -> DataFrame:
    return vocab_source.vocab_json(vocabulary(spark, d).vocab_frame(spark))


@query(
    "encode_bytes",
    "SELECT doc_id, octet_length(encode(text))::BIGINT AS n_tokens FROM documents",
)
def encode_bytes(spark: SparkSession, d: str) -> DataFrame:
    """Without merges every byte is a token."""
    plain = tk.Vocabulary([bytes([b]) for b in range(256)])
    encoded = tk.encode(documents(spark, d), plain)
    return encoded.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"))


@query("vocab_saved", _TOKEN_BYTES_SQL)
def vocab_saved(spark: SparkSession, d: str) -> DataFrame:
    """Saved, kept by a second save, read back into a vocabulary, and laid out again."""
    path = scratch_path(spark, "vocab")
    vocab_source.write_vocab(spark, vocabulary(spark, d), path)
    if vocab_source.write_vocab(spark, tk.Vocabulary([b"x"]), path):
        raise ValueError("a finished vocabulary was replaced")
    frame = vocab_source.read_vocab(spark, path).vocab_frame(spark)
    return frame.select("token_id", F.hex("token").alias("token"), "is_special", "nbytes")


# Ids and number of tokens of every pre-token of every document, under the vocabulary SQL has trained itself.
_ENCODED_SQL = f"""{_WALK_SQL},
    ids AS (SELECT printf('%02X', i) AS token, i::INT AS id FROM range(256) t(i) UNION ALL SELECT l || r, 256 + rank FROM learned),
    final AS (SELECT regexp_replace(w, '[<>]', '', 'g') AS h, w[2:-2] AS parts FROM walk WHERE step = {MERGES}),
    spelled AS (SELECT f.h, string_agg(i.id, ',' ORDER BY f.k) AS ids, count(*) AS n FROM (
        SELECT h, unnest(string_split(parts, '><')) AS t, generate_subscripts(string_split(parts, '><'), 1) AS k FROM final) f
      JOIN ids i ON i.token = f.t GROUP BY f.h),
    p AS (SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS k FROM (
        SELECT doc_id, {pieces_sql("text")} AS pieces FROM documents)),
    e AS (SELECT doc_id, k, coalesce(s.ids, i.id::VARCHAR) AS ids, coalesce(s.n, 1) AS n FROM p
      LEFT JOIN spelled s ON s.h = hex(encode(piece)) LEFT JOIN ids i ON i.token = hex(encode(piece)) AND length(i.token) = 2)"""


@query(
    "encode_trained",
    f"""WITH RECURSIVE {_ENCODED_SQL}
    SELECT doc_id, (sum(n) + 1)::INT AS n_tokens, md5('{256 + MERGES},' || string_agg(ids, ',' ORDER BY k)) AS tokens_digest
    FROM e GROUP BY doc_id""",
)
def encode_trained(spark: SparkSession, d: str) -> DataFrame:
    encoded = tk.encode(documents(spark, d), vocabulary(spark, d), prepend_bos=True)
    digest = F.md5(F.array_join("tokens", ",").cast("binary"))
    return encoded.select("doc_id", F.size("tokens").alias("n_tokens"), digest.alias("tokens_digest"))


@query(
    "encode_rows",
    f"""WITH e AS (SELECT doc_id, list_prepend({256 + len(GIVEN)}, {tokens_sql("text")}) AS tokens FROM documents)
    SELECT doc_id, len(tokens)::INT AS n_tokens, md5(array_to_string(tokens, ',')) AS tokens_digest FROM e""",
)
def encode_rows(spark: SparkSession, d: str) -> DataFrame:
    encoded = tk.encode(documents(spark, d), given_vocabulary(), prepend_bos=True)
    digest = F.md5(F.array_join("tokens", ",").cast("binary"))
    return encoded.select("doc_id", F.size("tokens").alias("n_tokens"), digest.alias("tokens_digest"))


@query("decode_round_trip", "SELECT doc_id, md5(text) AS digest FROM documents")
def decode_round_trip(spark: SparkSession, d: str) -> DataFrame:
    known = vocabulary(spark, d)
    encoded = tk.encode(documents(spark, d), known)
    return encoded.select("doc_id", F.md5(tk.decoded("tokens", known).cast("binary")).alias("digest"))


@query("round_trip_check", "SELECT 0::BIGINT AS n_failures")
def round_trip_check(spark: SparkSession, d: str) -> DataFrame:
    failures = tk.round_trip_failures(documents(spark, d), vocabulary(spark, d))
    return failures.agg(F.count(F.lit(1)).alias("n_failures"))


def _token_sizes(spark: SparkSession, d: str) -> DataFrame:
    encoded = tk.encode(corpus.clean(posts(spark, d)), given_vocabulary())
    return encoded.select(F.size("tokens").alias("n"), tx.shuffle_key("text").alias("k"))


_SIZES_SQL = f"""{CLEAN_SQL},
sizes AS MATERIALIZED (SELECT text, len({tokens_sql("text")}) AS n FROM clean)"""


@query(
    "token_length_profile",
    f"WITH {_SIZES_SQL}, s AS (SELECT n::DOUBLE AS len FROM sizes) SELECT {_PROFILE_SQL} FROM s",
)
def token_length_profile(spark: SparkSession, d: str) -> DataFrame:
    whole = profile.length_profile(_token_sizes(spark, d), F.col("n"))
    return rounded(whole, *_PROFILE_FLOATS, places=4)


@query(
    "context_fit",
    f"""WITH {_SIZES_SQL} SELECT context, round(avg((n <= context)::INT), 6) AS share
    FROM sizes, (SELECT unnest([64, 128, 256, 512, 1024, 2048])::INT AS context) GROUP BY context""",
)
def context_fit(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.context_fit(_token_sizes(spark, d), F.col("n")), "share")


@query(
    "implications",
    f"""WITH {_SIZES_SQL}, m AS (SELECT floor(median(n))::BIGINT AS m FROM sizes)
    SELECT m AS median_tokens, m * 2 AS two_per_row_len FROM m""",
)
def implications(spark: SparkSession, d: str) -> DataFrame:
    return profile.implications(profile.length_profile(_token_sizes(spark, d), F.col("n")))


def _windows_sql(limit: int) -> str:
    """Next-fit over `placed(i, n)`, row by row."""
    return f"""fill AS (
      SELECT 0::BIGINT AS i, 0::BIGINT AS win, (-1)::BIGINT AS room
      UNION ALL
      SELECT p.i, CASE WHEN p.n <= f.room THEN f.win ELSE f.win + 1 END,
             CASE WHEN p.n <= f.room THEN f.room - p.n ELSE {limit} - p.n END
      FROM fill f JOIN placed p ON p.i = f.i + 1),
    windows AS (SELECT win, count(*) AS documents FROM fill WHERE i > 0 GROUP BY win)"""


@query(
    "packing_profile",
    f"""WITH RECURSIVE {_SIZES_SQL},
    placed AS MATERIALIZED (SELECT n::BIGINT AS n, row_number() OVER (ORDER BY md5('42:' || text)) AS i FROM sizes),
    {_windows_sql(2048)}
    SELECT count(*) AS windows, round(avg(documents), 6) AS mean_documents,
           quantile_cont(documents, 0.5)::DOUBLE AS median_documents, min(documents) AS min_documents,
           max(documents) AS max_documents, round(avg((documents = 1)::INT), 6) AS single_share FROM windows""",
)
def packing_profile(spark: SparkSession, d: str) -> DataFrame:
    placed = with_position(_token_sizes(spark, d), "k")
    return rounded(sequence.packing_profile(sequence.packed_rows(placed, chunk_rows=CHUNK_ROWS // 10)), "mean_documents", "single_share")


PACK_CHARS = 5000


@query(
    "packing_profile_chars",
    f"""WITH RECURSIVE {CLEAN_SQL},
    placed AS MATERIALIZED (SELECT length(text)::BIGINT AS n, row_number() OVER (ORDER BY md5('42:' || text)) AS i FROM clean),
    {_windows_sql(PACK_CHARS)}
    SELECT documents, count(*) AS windows, round(count(*) / sum(count(*)) OVER (), 6) AS share
    FROM windows GROUP BY documents""",
)
def packing_profile_chars(spark: SparkSession, d: str) -> DataFrame:
    """The same rule on character lengths, where SQL can follow it."""
    docs = corpus.clean(posts(spark, d))
    placed = with_position(docs.select(F.char_length("text").alias("n"), tx.shuffle_key("text").alias("k")), "k")
    return rounded(sequence.packing_distribution(sequence.packed_rows(placed, PACK_CHARS, chunk_rows=CHUNK_ROWS // 10)), "share")


@query(
    "packing_table_chars",
    f"""WITH RECURSIVE {CLEAN_SQL},
    placed AS MATERIALIZED (SELECT length(text)::BIGINT AS n, row_number() OVER (ORDER BY md5('42:' || text)) AS i FROM clean),
    {_windows_sql(PACK_CHARS)},
    shares AS (SELECT documents, count(*) AS windows, count(*) / sum(count(*)) OVER () AS share FROM windows GROUP BY documents)
    SELECT documents, windows, printf('%.1f%%', share * 100) AS percent, repeat('█', floor(share * 50)::BIGINT) AS bar
    FROM shares""",
)
def packing_table_chars(spark: SparkSession, d: str) -> DataFrame:
    docs = corpus.clean(posts(spark, d))
    placed = with_position(docs.select(F.char_length("text").alias("n"), tx.shuffle_key("text").alias("k")), "k")
    packed = sequence.packed_rows(placed, PACK_CHARS, chunk_rows=CHUNK_ROWS // 10)
    return sequence.packing_table(packed).select("documents", "windows", "percent", "bar")


_BOS = 256 + len(GIVEN)


@query(
    "training_rows",
    f"""WITH {_PLACED_SQL},
    e AS (SELECT split, pos, list_resize(list_prepend({_BOS}, {tokens_sql("text")}), {SEQ_LEN + 1}, {_BOS}) AS r
          FROM sharded)
    SELECT split, pos, md5(array_to_string(r[1:{SEQ_LEN}], ',') || '|' || array_to_string(r[2:{SEQ_LEN + 1}], ','))
      AS row_digest FROM e""",
)
def training_rows(spark: SparkSession, d: str) -> DataFrame:
    known = given_vocabulary()
    encoded = tk.encode(_sharded(spark, d), known, prepend_bos=True)
    rows = sequence.training_rows(encoded, known.bos_id, SEQ_LEN)
    digest = F.md5(F.concat_ws("|", F.array_join("inputs", ","), F.array_join("targets", ",")).cast("binary"))
    return rows.select("split", "pos", digest.alias("row_digest"))


@query(
    "training_row_shape",
    f"""WITH {_PLACED_SQL} SELECT split, count(*) AS n, {SEQ_LEN} AS min_len, {SEQ_LEN} AS max_len,
    count(*) AS n_start_with_bos, count(*) AS n_shifted FROM sharded GROUP BY split""",
)
def training_row_shape(spark: SparkSession, d: str) -> DataFrame:
    """Every row starts with BOS, has the full length, and its targets are its inputs moved by one."""
    known = vocabulary(spark, d)
    encoded = tk.encode(_sharded(spark, d), known, prepend_bos=True)
    rows = sequence.training_rows(encoded, known.bos_id, SEQ_LEN)
    shifted = F.slice("inputs", 2, SEQ_LEN - 1) == F.slice("targets", 1, SEQ_LEN - 1)
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.least(F.min(F.size("inputs")), F.min(F.size("targets"))).alias("min_len"),
        F.greatest(F.max(F.size("inputs")), F.max(F.size("targets"))).alias("max_len"),
        F.count_if(F.get("inputs", F.lit(0)) == known.bos_id).alias("n_start_with_bos"),
        F.count_if(shifted).alias("n_shifted"),
    )


@query(
    "batch_assignment",
    f"""WITH {_PLACED_SQL} SELECT pos, pos // {BATCH} AS batch_no, (pos % {BATCH})::INT AS row_in_batch
    FROM sharded WHERE split = 'train'""",
)
def batch_assignment(spark: SparkSession, d: str) -> DataFrame:
    train = _sharded(spark, d).where(F.col("split") == "train").select("pos")
    return sequence.assign_batches(train, BATCH)


EPOCHS = 3


@query(
    "batches_over_epochs",
    f"""WITH {_PLACED_SQL},
    train AS (SELECT pos, count(*) OVER () AS n FROM sharded WHERE split = 'train'),
    run AS (SELECT pos, epoch, (epoch - 1) * n + pos AS place FROM train, (SELECT unnest(range(1, {EPOCHS + 1}))::INT AS epoch))
    SELECT pos, epoch, place // {BATCH} AS batch_no, (place % {BATCH})::INT AS row_in_batch FROM run""",
)
def batches_over_epochs(spark: SparkSession, d: str) -> DataFrame:
    train = _sharded(spark, d).where(F.col("split") == "train").select("pos")
    return sequence.batches_over_epochs(train, BATCH, EPOCHS)


EVAL_TOKENS = 1_000_000


@query(
    "evaluation_weights",
    f"""WITH {CLEAN_SQL},
    placed AS (SELECT row_number() OVER (ORDER BY md5('42:' || text)) - 1 AS pos, count(*) OVER () AS total FROM clean),
    needed AS (SELECT {EVAL_TOKENS} // ({BATCH} * {SEQ_LEN}) * {BATCH} AS n)
    SELECT pos, (n - 1 - pos) // total + 1 AS weight FROM placed, needed WHERE pos < n""",
)
def evaluation_weights(spark: SparkSession, d: str) -> DataFrame:
    keyed = corpus.clean(posts(spark, d)).select(tx.shuffle_key("text").alias("k"))
    rows = with_position(keyed, "k").select("pos")
    return sequence.evaluation_rows(rows, BATCH, EVAL_TOKENS, SEQ_LEN)


@query(
    "bpb_ratio",
    """WITH l AS (SELECT l_discount AS nats, CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE l_partkey % 5 + 1 END AS nbytes,
                         l_linenumber AS weight FROM lineitem)
    SELECT round(sum(nats * weight), 6) AS total_nats, sum(nbytes * weight)::BIGINT AS total_bytes,
           round(sum(nats * weight) / (ln(2) * sum(nbytes * weight)), 6) AS bpb FROM l WHERE nbytes > 0""",
)
def bpb_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Losses from line items: the part plays the token, the discount its loss."""
    items = table(spark, d, "lineitem")
    losses = items.selectExpr("l_partkey AS token_id", "l_discount AS nats", "l_linenumber AS weight")
    size = F.when(F.col("p_partkey") % 97 == 0, 0).otherwise(F.col("p_partkey") % 5 + 1)
    tokens = table(spark, d, "part").select(F.col("p_partkey").alias("token_id"), size.alias("nbytes"))
    return rounded(sequence.bits_per_byte(losses, tokens), "total_nats", "bpb")


# The token reports once more, under the trained vocabulary and over all documents.
_TRAINED_SIZES_SQL = f"""{_ENCODED_SQL},
    sizes AS MATERIALIZED (SELECT d.doc_id, coalesce(sum(e.n), 0)::BIGINT AS n FROM documents d LEFT JOIN e USING (doc_id)
      GROUP BY d.doc_id)"""


def _trained_sizes(spark: SparkSession, d: str) -> DataFrame:
    encoded = tk.encode(documents(spark, d), vocabulary(spark, d))
    return encoded.select(
        "doc_id", F.size("tokens").cast("long").alias("n"), tx.shuffle_key(F.col("doc_id").cast("string")).alias("k")
    )


@query(
    "trained_token_profile",
    f"""WITH RECURSIVE {_TRAINED_SIZES_SQL}, s AS (SELECT n::DOUBLE AS len FROM sizes) SELECT {_PROFILE_SQL} FROM s""",
)
def trained_token_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.length_profile(_trained_sizes(spark, d), F.col("n")), *_PROFILE_FLOATS, places=4)


@query(
    "trained_context_fit",
    f"""WITH RECURSIVE {_TRAINED_SIZES_SQL} SELECT context, round(avg((n <= context)::INT), 6) AS share
    FROM sizes, (SELECT unnest([64, 128, 256, 512, 1024, 2048])::INT AS context) GROUP BY context""",
)
def trained_context_fit(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.context_fit(_trained_sizes(spark, d), F.col("n")), "share")


@query(
    "trained_implications",
    f"""WITH RECURSIVE {_TRAINED_SIZES_SQL}, m AS (SELECT floor(median(n))::BIGINT AS m FROM sizes)
    SELECT m AS median_tokens, m * 2 AS two_per_row_len FROM m""",
)
def trained_implications(spark: SparkSession, d: str) -> DataFrame:
    return profile.implications(profile.length_profile(_trained_sizes(spark, d), F.col("n")))


@query(
    "trained_packing_table",
    f"""WITH RECURSIVE {_TRAINED_SIZES_SQL},
    placed AS MATERIALIZED (SELECT n, row_number() OVER (ORDER BY md5('42:' || doc_id)) AS i FROM sizes),
    {_windows_sql(fixed.PACK_LEN)},
    shares AS (SELECT documents, count(*) AS windows, count(*) / sum(count(*)) OVER () AS share FROM windows GROUP BY documents)
    SELECT documents, windows, printf('%.1f%%', share * 100) AS percent, repeat('█', floor(share * 50)::BIGINT) AS bar
    FROM shares""",
)
def trained_packing_table(spark: SparkSession, d: str) -> DataFrame:
    placed = with_position(_trained_sizes(spark, d), "k")
    packed = sequence.packed_rows(placed, chunk_rows=CHUNK_ROWS // 10)
    return sequence.packing_table(packed).select("documents", "windows", "percent", "bar")


@query(
    "trained_training_rows",
    f"""WITH RECURSIVE {_ENCODED_SQL},
    t AS (SELECT d.doc_id, string_split(concat_ws(',', '{256 + MERGES}', string_agg(e.ids, ',' ORDER BY e.k)), ',') AS ids
      FROM documents d LEFT JOIN e USING (doc_id) GROUP BY d.doc_id),
    r AS (SELECT doc_id, list_resize(ids, {SEQ_LEN + 1}, '{256 + MERGES}') AS r FROM t)
    SELECT doc_id, md5(array_to_string(r[1:{SEQ_LEN}], ',') || '|' || array_to_string(r[2:{SEQ_LEN + 1}], ','))
      AS row_digest FROM r""",
)
def trained_training_rows(spark: SparkSession, d: str) -> DataFrame:
    known = vocabulary(spark, d)
    rows = sequence.training_rows(tk.encode(documents(spark, d), known, prepend_bos=True), known.bos_id, SEQ_LEN)
    digest = F.md5(F.concat_ws("|", F.array_join("inputs", ","), F.array_join("targets", ",")).cast("binary"))
    return rows.select("doc_id", digest.alias("row_digest"))


@lru_cache(maxsize=4)
def _full(app: str, sf_dir: str) -> tk.Vocabulary:
    return tk.train_bpe(documents(SparkSession.active(), sf_dir), fixed.VOCAB_SIZE)


def full_vocabulary(spark: SparkSession, d: str) -> tk.Vocabulary:
    """The vocabulary at its real size, trained on all documents, once per application and folder."""
    return _full(spark.sparkContext.applicationId, d)


@query("full_vocabulary")
def full_merges(spark: SparkSession, d: str) -> DataFrame:
    """All merges of the full vocabulary; a walk in SQL would take hours, so tests walk a smaller corpus."""
    trained = full_vocabulary(spark, d)
    return trained.merges_frame(spark).select("rank", F.hex("left").alias("left"), F.hex("right").alias("right"))


@query("full_token_profile")
def full_token_profile(spark: SparkSession, d: str) -> DataFrame:
    """Token lengths of all documents under the full vocabulary."""
    encoded = tk.encode(documents(spark, d), full_vocabulary(spark, d))
    whole = profile.length_profile(encoded.select(F.size("tokens").cast("long").alias("n")), F.col("n"))
    return rounded(whole, *_PROFILE_FLOATS, places=4)


@query("full_context_fit")
def full_context_fit(spark: SparkSession, d: str) -> DataFrame:
    """Shares of documents that fit context lengths under the full vocabulary."""
    encoded = tk.encode(documents(spark, d), full_vocabulary(spark, d))
    sized = encoded.select(F.size("tokens").cast("long").alias("n"))
    return rounded(profile.context_fit(sized, F.col("n")), "share")
