"""The driver's queries over the operators of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import (bpe, decontaminate, exact_dedup, hard_negatives, hmm_lm, html_extract,
                           line_rules, near_dup, phrases, quality, token_store, toxicity, warc)
from tickframe.llm.common import crc_mod, scratch_path, table


def vocabulary(name: str) -> str:
    """A public tokenizer's file; operators take the path as a parameter."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_store.write(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return token_store.checksums(token_store.read(spark, path))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary("word_bpe_49k.json")
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), words), words)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"),
                                  table(spark, sf_dir, "labels"), crc_mod("doc_id", 4) == 2)


def op4_crf_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(table(spark, sf_dir, "pages"))


def op6_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.text_scores(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark"))


def op8_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) == 1)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(warc.mark_revisits(table(spark, sf_dir, "pages")), path)
    return warc.verified(spark, path)


OP9_SQL = """
WITH n AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM n)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM m
"""


def op11_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_quality(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "labels"))


def op12_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", F.expr(
        "CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END"))
    return hard_negatives.mine(vectors, F.expr("vec_id % 100 = 0"))


OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, a.label = b.label AS same, b.r AS br, b.vec_id,
         CAST(list_inner_product(a.c, b.c) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (
  SELECT ar, anchor_id, vec_id AS positive_id, score AS positive_score, br AS pr
  FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, br) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id,
         CAST(row_number() OVER (PARTITION BY p.ar, p.pr
                                 ORDER BY s.score DESC, s.vec_id, s.br) AS INTEGER) AS rank,
         s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM p JOIN s ON s.ar = p.ar AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT * FROM n WHERE rank <= 10
"""


def op13_dynamic_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH w AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')),
                                  '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents)),
o AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
                         lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3), (4)) AS t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM o GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM o WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (
  SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS p, array_to_string(w[j + 1:k], ' ') AS q
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (
  SELECT cuts.lang, cuts.phrase, a, j, x.f AS l, y.f AS r,
         CAST((CAST(2000000 AS HUGEINT) * a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p
       JOIN f y ON y.lang = cuts.lang AND y.phrase = q
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, j) = 1),
around AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS m FROM c WHERE k > 2))
  GROUP BY ALL),
t AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM s LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM t JOIN n USING (lang) WHERE rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_store": op1_token_store,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_bpe": op3_bpe,
        "op4_crf_extract": op4_crf_extract,
        "op5_quality": op5_quality,
        "op6_hidden_markov": op6_hidden_markov,
        "op7_decontaminate": op7_decontaminate,
        "op8_chosen_path_join": op8_chosen_path_join,
        "op9_warc": op9_warc,
        "op10_toxicity": op10_toxicity,
        "op11_line_crf": op11_line_crf,
        "op12_kronecker_negatives": op12_kronecker_negatives,
        "op13_dynamic_itemsets": op13_dynamic_itemsets,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op9_warc": OP9_SQL,
            "op12_kronecker_negatives": OP12_SQL, "op13_dynamic_itemsets": OP13_SQL}
