"""One query for each operator over the whole given tables, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.llm.decontaminate import contamination
from surveyloom.llm.fill_in_middle import fill_in_middle, restore
from surveyloom.llm.hard_negatives import hard_negatives
from surveyloom.llm.hashed import fold
from surveyloom.llm.html_text import extract_text, fit_labeller
from surveyloom.llm.jaccard_join import jaccard_join
from surveyloom.llm.language_model import fit, lm_scores
from surveyloom.llm.mixing import mix_report
from surveyloom.llm.quality import fit_quality, quality_scores
from surveyloom.llm.recompression import recompression_dedup
from surveyloom.llm.suffix_dedup import suffix_dedup
from surveyloom.llm.token_files import read_tokens, write_tokens
from surveyloom.llm.topk import exact_topk
from surveyloom.llm.toxicity import fit_toxicity, toxicity_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _removed():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])


@query
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of each document that a 50-byte string of an earlier document covers."""
    found = suffix_dedup(table(spark, folder, "documents"), 50)
    return found.select(
        "doc_id",
        F.col("n_units").alias("n_bytes"),
        _removed().alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op10_recompression_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document that a window of 50 words of an earlier document covers."""
    found = recompression_dedup(table(spark, folder, "documents"), 50)
    return found.select(
        "doc_id",
        F.col("n_units").alias("n_words"),
        _removed().alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


@query
def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to source weights 5, 2, 1 in turn, 150% of all words, at most two epochs."""
    return mix_report(table(spark, folder, "documents"), weights=(5, 2, 1), share=1.5, most=2)


@query
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded, written as flat files, and read back."""
    return read_tokens(write_tokens(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")))


ORACLES["op5_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         length(translate(text, '|#*%&$!<>{}[]^~=_\', '')) / length(text) AS share
  FROM documents
), keyed AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)
           / greatest(0.01, CASE WHEN share IS NULL OR isnan(share) THEN 0.0 ELSE share * share END) AS k
  FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source
), filled AS (
  SELECT *, 2 * source_size AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget, sum(w) OVER () AS ws,
         coalesce(sum(2 * source_size) OVER before, 0) AS caps, coalesce(sum(w) OVER before, 0) AS gone
  FROM sources
  WINDOW before AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), stopped AS (
  SELECT *, (budget - caps) * w >= cap * (ws - gone) AS stops FROM filled
), aims AS (
  SELECT source, source_size,
         CASE WHEN stops THEN cap::DOUBLE
              ELSE (budget - coalesce(sum(CASE WHEN stops THEN cap END) OVER (), 0))::DOUBLE
                   / sum(CASE WHEN NOT stops THEN w END) OVER () * w END AS target
  FROM stopped
), rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM aims
), ordered AS (
  SELECT doc_id, size, r.source_size, r.target, r.epochs, r.target - r.epochs * r.source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS past
  FROM keyed d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source
), picked AS (
  SELECT *, epochs + CASE WHEN rest > 0 AND past + size / 2 <= rest THEN 1 ELSE 0 END AS n FROM ordered
)
SELECT doc_id, size, source_size, target, (n * size)::BIGINT AS taken, n::INTEGER AS times FROM picked
"""


@query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learned on four of five folds."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, folder, "labels"), fold(F.col("doc_id"), 5) != 0)
    return _scored(toxicity_scores(docs, model), F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)), 0.5)


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents, learned on three of four folds."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, folder, "labels"), fold(F.col("doc_id"), 4) != 2)
    return _scored(quality_scores(docs, model), F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)), 0.7)


def _scored(scores: DataFrame, held_out, threshold: float) -> DataFrame:
    predicted = (F.col("_score") >= threshold).cast("int").alias("predicted")
    return scores.select("doc_id", held_out.alias("held_out"), F.col("_score").alias("score"), predicted)


@query
def op4_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector with all others."""
    return exact_topk(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)


ORACLES["op4_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings WHERE vec_id IS NOT NULL
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share three quarters of their five-word shingles."""
    return jaccard_join(table(spark, folder, "documents"), 5, 75)


ORACLES["op1_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) >= 5 THEN list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.root AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) c ON c.node = d.doc_id
"""


@query
def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that hold a benchmark item, with the item and its edit distance in words."""
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of all pages."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return extract_text(pages, fit_labeller(pages)).withColumn("n_chars", F.length("text").cast("long"))


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """For every hundredth vector and each of its five positives, the first five negatives close below. Each seventh label is moved on."""
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), mined AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM mined WHERE rank <= 5
"""


@query
def op12_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored by a Kneser-Ney model of order 3, learned on four of five folds."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, fold(F.col("doc_id"), 5) != 1)
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 1, F.lit(False)).alias("held_out")
    known = F.lit(model.words.total).cast("long").alias("train_tokens")
    return lm_scores(docs, model).select("doc_id", held_out, "n_tokens", "n_known", known, "base_score", "score", "perplexity")


@query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents cut at lines and rearranged, half prefix first and half suffix first, and rebuilt."""
    made = restore(fill_in_middle(table(spark, folder, "documents").select("doc_id", "text"), seed=7, percent=100, spm_percent=50))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


ORACLES["op13_fill_in_middle"] = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines
  FROM documents
), drawn AS (
  SELECT *, len(lines)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM hashed
), placed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), pieces AS (
  SELECT *, coalesce(array_to_string(lines[1:a], ''), '') AS p, coalesce(array_to_string(lines[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(lines[b + 1:n], ''), '') AS s
  FROM placed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM pieces
"""
