"""The operators as queries over the given tables, each with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheafmill.catalog.base import Query, table
from sheafmill.llm import (
    byte_bpe, exact_dedup, html_text, lexical, markov, packing, phrases, private_terms, quality_rules, sharding,
    simhash, suffix_dedup, token_counts,
)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_exact_dedup", """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]', '', 'g')) AS h FROM documents),
w AS (
  SELECT h, first(doc_id ORDER BY n DESC, doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM d JOIN w USING (h)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query("op2_edit_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.edit_counts(table(spark, sf_dir, "documents"))


@query("op3_html_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op4_suffix_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


#: Shards of the registered query.
SHARDS = 256


@query("op5_table_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, sharding.fill(sharding.names(SHARDS)))


@query("op6_pattern_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_private_terms")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_terms.report(table(spark, sf_dir, "documents"))


@query("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


@query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.quality_rules(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


@query("op11_hidden_markov")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markov.language_scores(table(spark, sf_dir, "documents"))


@query("op12_collocations", """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS ws FROM pieces),
grams AS (
  SELECT lang, k::INTEGER AS k, unnest([array_to_string(ws[i : i + k - 1], ' ') for i in range(1, len(ws) - k + 2)]) AS phrase
  FROM split CROSS JOIN range(1, 6) AS sizes(k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
every AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM split GROUP BY lang),
kept AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f
  WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM f AS q WHERE q.lang = f.lang AND q.k > f.k AND 100 * q.f >= 100 * f.f
      AND contains(concat(' ', q.phrase, ' '), concat(' ', f.phrase, ' ')))),
cuts AS (
  SELECT lang, kept.phrase, a, n, cut, h.f AS l, t.f AS r, (1000::HUGEINT * a * n) // (h.f::HUGEINT * t.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) AS kept JOIN every USING (lang)
  JOIN f AS h USING (lang) JOIN f AS t USING (lang)
  WHERE h.phrase = array_to_string(kept.ws[1 : cut], ' ') AND t.phrase = array_to_string(kept.ws[cut + 1 : kept.k], ' ')),
weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM weakest)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op13_lexical_search", """
WITH own AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
times AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
size AS (SELECT doc_id, count(*) AS n FROM own GROUP BY doc_id),
every AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS total FROM size),
tf AS (SELECT doc_id, term, count(*) AS tf FROM own WHERE term IN (SELECT term FROM times) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf CROSS JOIN every GROUP BY term),
scored AS (
  SELECT item_id, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // total))))::BIGINT AS score
  FROM tf JOIN w USING (term) JOIN times USING (term) JOIN size USING (doc_id) CROSS JOIN every GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
