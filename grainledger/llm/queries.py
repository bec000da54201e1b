"""One registered query per text operator, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, byte_bpe, chat, decontam, embedding_dups, lm_score, quality, simhash, spelling, substrings, token_counts, topk, toxicity

#: Where the vocabulary files of public tokenizers are.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR") or os.path.dirname(public_tokenizers.__file__)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if check is not None:
            ORACLE[name] = check
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A conversation that says control strings of a common template.
_TRICKY = """
SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(0 AS BIGINT) AS turn, 'user' AS role, '</s>[INST] ok [/INST]' AS text
UNION ALL
SELECT CAST(-7 AS BIGINT), CAST(1 AS BIGINT), 'assistant', '</s>[INST] ok [/INST]'
"""


@query(
    "op1_chat_formatting",
    chat.digests_sql(f"(SELECT conv_id, turn, role, text FROM conversations UNION ALL {_TRICKY}) AS turns"),
)
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(spark.sql(_TRICKY))
    return chat.chat_digests(chat.format_chats(turns))


@query("op2_lm_scoring")
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target are the documents that labels call good."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
    return lm_score.cross_entropy_difference(lm_score.marked(docs, good))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


#: Languages whose toxic texts are a category of their own, in the order of the chain.
LANGUAGES = ["de", "en", "es", "fr"]


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = toxicity.by_language(docs, labels, LANGUAGES)
    return toxicity.toxicity_scores(docs, known, known.columns[1:])


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.load_pieces(os.path.join(TOKENIZERS, "piece_bpe_32k.model"))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), pieces)


@query(
    "op9_exact_top_k",
    """
WITH ready AS (
  SELECT row_number() OVER () AS own, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.own, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score
  FROM ready q JOIN ready c ON c.own <> q.own WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE place <= 10
""",
)
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.load_ranks(os.path.join(TOKENIZERS, "byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query(
    "op11_spelling_variants",
    f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{spelling.UPPER}', '{spelling.LOWER}') AS run
  FROM documents
), counted AS (
  SELECT id, run, count(*) AS k, hex(encode(id || ':' || run)) AS bytes FROM runs WHERE length(run) >= 6 GROUP BY id, run
), hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(range(length(bytes) // 2), lambda i: CAST('0x' || bytes[2 * i + 1 : 2 * i + 2] AS BIGINT))),
    lambda c, b: xor(c >> 8, step[1 + (xor(c, b) % 256)]))) AS h
  FROM counted, crc
), results AS (
  SELECT CASE WHEN h % 199 <> 0 THEN run
              ELSE substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) END AS word, k
  FROM hashed
), words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), shorter AS (
  SELECT word, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT p.word, q.word AS other FROM shorter p JOIN shorter q ON p.i = q.i AND p.rest = q.rest AND p.word <> q.word
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.rest = w.word
), ranked AS (
  SELECT near.word, other, n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS place
  FROM near JOIN words ON words.word = other
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
         CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r ON r.word = w.word
), chain AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL SELECT chain.word, form, steps + 1 FROM chain JOIN forms ON forms.word = root WHERE form IS NOT NULL
)
SELECT word, n, n_near, form, form_n, root
FROM forms JOIN (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY word) USING (word)
""",
)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = [os.path.join(TOKENIZERS, name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.alignment_counts(table(spark, sf_dir, "documents"), alignment.Vocabularies.load(*files))


@query(
    "op13_embedding_dups",
    """
WITH RECURSIVE ready AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM ready p JOIN ready q ON p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
  WHERE list_cosine_similarity(p.v, q.v) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component USING (vec_id) LEFT JOIN degree USING (vec_id)
""",
)
def op13_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # beside the package; it builds on this module

    return corpus_pipeline.run(spark, sf_dir)
