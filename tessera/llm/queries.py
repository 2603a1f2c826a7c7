"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import SEGMENT, perspectives
from . import alignment, language, licenses, minhash, neighbours, pitman_yor, quality, ranked
from .common import LOWER, UPPER, crc_mod, table
from .exact_dedup import exact_dedup
from .mixing import mix
from .packing import pack
from .shingle_join import jaccard_components


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts; of each the row with the largest id stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs, keep="max").select(F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's side."""
    return perspectives(table(spark, sf_dir, "conversations"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents similar by four-word shingles, at 85 per cent, and the links of each."""
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those whose id's checksum leaves another remainder than 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = crc_mod("doc_id", 4) == 2
    found = language.identify(docs, language.train(docs, ~held), keep=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score").select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in as few sequences of 2,048 tokens as were found."""
    return pack(table(spark, sf_dir, "documents"), **VOCABULARY)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model of nine tenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", crc_mod("doc_id", 10) == 0)
    return pitman_yor.score(docs, "held_out")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License matches in all documents."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixing schedule."""
    return mix(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learnt from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = crc_mod("doc_id", 3) == 1
    found = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels"), ~held), keep=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "score").select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut by two tokenizers, the cuts aligned; pairs of ids counted over all documents."""
    return alignment.align(table(spark, sf_dir, "documents"), pieces=PIECES, **VOCABULARY)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item, all documents ranked."""
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents by two-word shingles and a similarity of 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


#: Where the packed ids come from: the vocabulary, the same one as ranks, and the ranks' pattern.
VOCABULARY = {"vocabulary": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}
#: The second tokenizer of the alignment.
PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_language_id": op3_language_id,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_mixing": op6_mixing,
    "op7_pitman_yor": op7_pitman_yor,
    "op8_quality": op8_quality,
    "op9_license_scan": op9_license_scan,
    "op10_chat_format": op10_chat_format,
    "op11_alignment": op11_alignment,
    "op12_ranked_search": op12_ranked_search,
    "op13_minhash": op13_minhash,
}

SQL = {
    "op2_exact_dedup": f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n""",
    "op10_chat_format": f"""
WITH r AS (
  SELECT conv_id, regexp_replace(replace(coalesce(role, 'unknown'), '<|', '<\\|'), '[\r\n]+', ' ', 'g') AS speaker, replace(coalesce(text, ''), '<|', '<\\|') AS text,
         turn, sha256(coalesce(text, '')) AS digest
  FROM conversations),
i AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, digest) - 1 AS i FROM r),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM r WHERE speaker <> 'system'),
m AS (
  SELECT i.conv_id, p.perspective, cast(floor(i.i / {SEGMENT}.0) AS BIGINT) AS segment, i.i, i.speaker = p.perspective AS mine,
         CASE WHEN i.speaker = p.perspective THEN '<|im_start|>assistant' || chr(10)
              WHEN i.speaker = 'system' THEN '<|im_start|>system' || chr(10)
              ELSE '<|im_start|>user name=' || i.speaker || chr(10) END AS head,
         i.text || '<|im_end|>' || chr(10) AS body
  FROM i JOIN p ON i.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (
  SELECT *, sum(length(head) + length(body)) OVER w - length(body) AS b, sum(length(head) + length(body)) OVER w - 1 AS e
  FROM m WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY i ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, segment, cast(min(b - length(head)) AS BIGINT) AS start_char, count(*) AS n_messages, count(*) FILTER (mine) AS n_trained,
       string_agg(head || body, '' ORDER BY i) AS rendered,
       string_agg(CASE WHEN mine THEN '1' ELSE '0' END, '' ORDER BY i) AS mask,
       coalesce(string_agg(cast(b AS BIGINT) || '-' || cast(e AS BIGINT), ';' ORDER BY i) FILTER (mine), '') AS train_spans
FROM o GROUP BY conv_id, perspective, segment""",
    "op12_ranked_search": f"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM documents WHERE text IS NOT NULL),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
t AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM n),
w AS (SELECT term, floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, t GROUP BY term),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM benchmark WHERE text IS NOT NULL),
s AS (
  SELECT item_id, doc_id, sum(w * (1000000000 * tf // (1000 * tf + 8 * (100 - 75 + 75 * n * n_docs // n_terms))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN n USING (doc_id) JOIN w USING (term), t GROUP BY ALL)
SELECT item_id, cast(row_number() OVER o AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER o <= 10""",
}
