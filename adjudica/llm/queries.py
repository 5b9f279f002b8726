"""The registered queries of this folder and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.llm import (
    alignment, collocations, embedding_dedup, host_rules, jaccard_join, language_id, neighbours, packing, pieces, quality,
    substring_dedup, toxicity, url_filter,
)
from adjudica.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: (host glob + path glob, verdict) of the registered URL query.
URL_RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids", "source")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(quality.learnable(docs), quality.learnable(labels))
    return quality.quality_scores(docs, model)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.languages(docs, language_id.train(quality.learnable(docs, folds=3, held_out=1)))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(quality.learnable(docs), quality.learnable(labels))
    return toxicity.toxicity_scores(docs, model)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.token_alignment(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


def op12_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.host_rules(table(spark, sf_dir, "documents")).drop("host", "host_rejected")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Query]:
    return {
        q.__name__: q
        for q in (
            op1_packing, op2_sentencepiece, op3_url_filter, op4_jaccard_join, op5_quality, op6_substring_dedup, op7_embedding_dedup,
            op8_language_id, op9_nearest_neighbours, op10_toxicity, op11_alignment, op12_host_rules, op13_collocations,
        )
    }


_URL_SQL = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), cut AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM parts
), judged AS (
  SELECT page_id, translate(raw_host, '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM cut
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fitting AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM judged JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT j.page_id, j.host, j.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM judged j LEFT JOIN fitting f ON j.page_id = f.page_id
"""


_JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM words
), sizes AS (SELECT doc_id, len(s) AS n FROM sets
), items AS (SELECT doc_id, unnest(s) AS shingle FROM sets
), met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM met JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * o >= 85 * (a.n + b.n - o)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN both_ways l ON r.other = l.x
)
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id FROM sizes s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n
"""


_HOST_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT rid, doc_id, host, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM docs
), windows AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM cut)
), repeated AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), held AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM repeated, (VALUES (0), (1), (2)) t(k) GROUP BY rid
), counts AS (
  SELECT c.rid, doc_id, host, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines
  FROM cut c LEFT JOIN held h ON c.rid = h.rid
), failed AS (
  SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2, word_chars < 3 * n_words OR word_chars > 10 * n_words AS f3,
    100 * n_symbols > 10 * n_words AS f4, 100 * n_dup_lines > 30 * n_lines AS f5 FROM counts
), totals AS (
  SELECT host, rule, count(*)::HUGEINT AS n, count(*) FILTER (f)::HUGEINT AS x
  FROM (SELECT host, unnest([1, 2, 3, 4, 5]) AS rule, unnest([f1, f2, f3, f4, f5]) AS f FROM failed WHERE host IS NOT NULL) GROUP BY host, rule
), moments AS (
  SELECT rule, count(*) AS hosts, sum(x * 1000000000 // n)::DOUBLE / (count(*) * 1e9) AS m1,
    sum(x * (x - 1) * 1000000000 // (n * (n - 1)))::DOUBLE / (count(*) * 1e9) AS m2
  FROM totals WHERE n > 1 GROUP BY rule
), priors AS (
  SELECT r.rule, m1, CASE WHEN hosts IS NULL THEN 1.0::DOUBLE WHEN m2 - m1 * m1 > 0 THEN m1 * ((m1 - m2) / (m2 - m1 * m1)) END AS a,
    CASE WHEN hosts IS NULL THEN 1.0::DOUBLE WHEN m2 - m1 * m1 > 0 THEN (1 - m1) * ((m1 - m2) / (m2 - m1 * m1)) END AS b
  FROM (SELECT DISTINCT rule FROM totals) r LEFT JOIN moments m ON r.rule = m.rule
), verdicts AS (
  SELECT host, max(coalesce((a + x::DOUBLE) / (a + b + n::DOUBLE), m1)) > 0.5 AS rejected FROM totals t JOIN priors p ON t.rule = p.rule GROUP BY host
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
  NOT (f1 OR f2) AND NOT coalesce(rejected, false) AS kept
FROM failed f LEFT JOIN verdicts v ON f.host = v.host
"""


_COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS pid, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
), places AS (SELECT pid, lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), totals AS (SELECT lang, count(*)::HUGEINT AS n FROM places GROUP BY lang
), grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM places, (VALUES (1), (2), (3), (4), (5)) s(size) WHERE i + size - 1 <= len(w)
), counted AS (
  SELECT lang, size, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size > 1
), inside AS (
  SELECT DISTINCT lang, array_to_string(w[s:s + size - 2], ' ') AS phrase, a FROM candidates, (VALUES (1), (2)) t(s) WHERE size > 2
), cuts AS (
  SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, n, (1000 * a * n) // (l.f * r.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:c.size], ' ')
  JOIN totals t ON t.lang = c.lang
), weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM weakest w WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = w.lang AND i.phrase = w.phrase AND i.a >= w.a)
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op3_url_filter": _URL_SQL, "op4_jaccard_join": _JACCARD_SQL, "op12_host_rules": _HOST_SQL, "op13_collocations": _COLLOCATION_SQL,
    }
