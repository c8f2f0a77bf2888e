"""One query for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm import collocations, decontaminate, html_extract, language_id, ngram_join, packing, pair_search, quality_rules, sharding, suffix_dedup, token_count, token_shards, url_filter
from daymark.llm.catalog import ORACLES, QUERIES, query, table  # noqa: F401

URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]

_RULE_ROWS = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in URL_RULES)
URL_SQL = f"""
WITH rules AS (
  SELECT rule, verdict, split_part(rule, '/', 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path
  FROM (VALUES {_RULE_ROWS}) AS t(rule, verdict)),
urls AS (
  SELECT row_number() OVER () AS rid, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fits AS (
  SELECT rid, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM urls JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN fits USING (rid)
"""


@query("op1_url_filter", URL_SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every URL of `pages` under the fixed rules; URLs that no rule fits are allowed."""
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of `documents` in sequences of at most 4096 ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


@query("op3_token_shards")
def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of `documents` in training order, as read back from the shards."""
    docs = table(spark, sf_dir, "documents").select("text")
    path, manifest = token_shards.write_shards(docs, public_tokenizers.path("word_bpe_49k.json"))
    return token_shards.read_sequences(manifest, path)


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes inside 200-byte strings that occur elsewhere."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.floor(F.size("runs") / 2).cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under the base rules and the rules learned from `labels`."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge_quality(docs, table(spark, sf_dir, "labels"))


@query("op6_ngram_join")
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies."""
    return ngram_join.near_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens under the piece model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = language_id.learn(docs)
    judged = language_id.identify(docs.select("doc_id", "text", language_id.held_out().alias("held_out")), models)
    return judged.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that lie in runs of benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.drop("text")


@query("op10_html_extraction")
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html_extract.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


# Checksums by table, two hex digits of the text at a time; products of the generator in 128 bits.
SHARD_SQL = """
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body, coalesce(doc_id, 0)::HUGEINT AS id FROM documents),
entries AS (
  SELECT list(list_reduce([b::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY b) AS entry
  FROM range(256) AS t(b)),
sums AS (
  SELECT rid, doc_id, id, (strlen(body) + 1)::BIGINT AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(body)), '..'),
      lambda x: ('0x' || x)::BIGINT)), lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1])))::BIGINT AS text_crc32
  FROM docs, entries),
walk AS (
  SELECT rid, (CASE WHEN id < 0 THEN id + 18446744073709551616 ELSE id END)::UHUGEINT AS state, 0::BIGINT AS place, 0::BIGINT AS next
  FROM docs
  UNION ALL
  SELECT rid, drawn, next, floor((next + 1)::DOUBLE * (2147483648.0::DOUBLE / ((drawn >> 33) + 1)::DOUBLE))::BIGINT
  FROM (SELECT rid, next, ((state * 2862933555777941757 + 1) % 18446744073709551616)::UHUGEINT AS drawn FROM walk WHERE next <= 16)),
found AS (
  SELECT rid, CAST(max(place) FILTER (place < 16) AS INTEGER) AS shard, CAST(max(place) AS INTEGER) AS grown_shard FROM walk GROUP BY rid),
spreads AS (
  SELECT *, (((CASE WHEN id < 0 THEN id + 18446744073709551616 ELSE id END)::UHUGEINT * 2862933555777941757 + 1)
    % 18446744073709551616) >> 32 AS spread
  FROM sums JOIN found USING (rid))
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY spread, text_crc32, size, doc_id NULLS FIRST) - 1 AS slot
FROM spreads
"""


@query("op13_sharding", SHARD_SQL)
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard among 16, its number there and its shard among 17."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
SEARCH_SQL = f"""
WITH listed AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS terms FROM documents),
docs AS (SELECT *, len(terms) AS n FROM listed WHERE len(terms) > 0),
totals AS (SELECT count(*) AS big_n, sum(n) AS big_l FROM docs),
tfs AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
asked AS (SELECT row_number() OVER () AS qid, item_id, terms FROM (SELECT DISTINCT item_id, {_TERMS} AS terms FROM benchmark)),
parts AS (SELECT qid, item_id, unnest(terms) AS term FROM asked),
scores AS (
  SELECT qid, item_id, rid, doc_id, sum(
    floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2.0::DOUBLE * df + 1)))::BIGINT
    * ((1000000000 * tf) // (1000 * tf + 12 * (75 + ((25 * n * big_n) // big_l)))))::BIGINT AS score
  FROM parts JOIN tfs USING (term) JOIN dfs USING (term), totals GROUP BY ALL),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query("op12_pair_search", SEARCH_SQL)
def op12_pair_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each item of `benchmark`."""
    return pair_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


PHRASE_SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
pieces AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words FROM texts),
spans AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS s FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(words[s:s + k - 1], ' ') AS phrase
  FROM spans, range(1, 5) AS t(k) WHERE s + k - 1 <= len(words)),
counts AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, count(*) AS n FROM spans GROUP BY lang),
candidates AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS words FROM counts WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.a AS l, r.a AS r, (2000000 * c.a::HUGEINT) // (l.a + r.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[cut + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(words[s:s + w - 1], ' ') AS phrase
    FROM candidates, range(1, 4) AS t(s), range(2, 4) AS u(w) WHERE w < k AND s + w - 1 <= k) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score::BIGINT AS score
FROM best LEFT JOIN inside USING (lang, phrase) JOIN totals USING (lang)
WHERE longer IS NULL OR 100 * longer < 80 * a
QUALIFY rank <= 2000
"""


@query("op11_collocations", PHRASE_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of each language of `documents`."""
    return collocations.mine(table(spark, sf_dir, "documents"))
