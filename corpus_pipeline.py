"""A training corpus in five stages, each over all that the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveyloom.llm.chunks import written
from surveyloom.llm.decontaminate import decontaminated
from surveyloom.llm.extras import carried
from surveyloom.llm.jaccard_join import jaccard_join
from surveyloom.llm.mixing import mix
from surveyloom.llm.quality import fit_quality, quality_scores
from surveyloom.llm.token_files import read_tokens, write_tokens
from surveyloom.session import new_folder

QUALITY = 0.7
ORACLE_SQL = None


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose quality scores at least 0.7."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return carried(docs, ("doc_id", "text"), lambda slim: quality_scores(slim, model).where(F.col("_score") >= QUALITY))


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the smallest doc_id; rows without a doc_id all stay.

    Rows that repeat a doc_id are documents of their own if their texts differ, the smallest digest first; of equal texts, one stays.
    """
    number = F.col("doc_id").cast("long")
    digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    firsts_of = docs.where("doc_id IS NOT NULL").select(number.alias("_id"), digest.alias("_text")).groupBy("_id").agg(F.min("_text").alias("_first"), F.max("_text").alias("_last"))
    clashes = written(firsts_of.where("_first <> _last").drop("_last"), "clashes")
    if clashes.isEmpty():
        others, keyed = None, docs
    else:
        others = _numbered(docs, docs.select(number.alias("_id"), digest.alias("_text")).join(clashes, "_id").where("_text <> _first").select("_id", "_text").distinct())
        keyed = _keyed(docs.select("doc_id", "text"), others, number, digest).drop("doc_id").withColumnRenamed("_key", "doc_id")
    joined = jaccard_join(keyed)
    first = joined.where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    if others is not None:
        members = joined.where("doc_id IS NOT NULL").join(others, joined["doc_id"] == others["_key"], "left")
        rank = F.struct(F.coalesce("_id", "doc_id"), F.coalesce("_text", F.lit("")), F.col("doc_id").alias("_kept"))
        first = members.groupBy("component_id").agg(F.min(rank).alias("_rank")).select("_rank._kept")
    one = W.partitionBy("_key").orderBy("text")

    def firsts(slim: DataFrame) -> DataFrame:
        rows = slim.withColumn("_key", number) if others is None else _keyed(slim, others, number, digest)
        kept = rows.join(first, F.col("_key") == F.col("_kept"), "left_semi")
        return kept.withColumn("_n", F.row_number().over(one)).where("_n = 1")

    return carried(docs, ("doc_id", "text"), firsts).unionByName(docs.where("doc_id IS NULL"))


def _numbered(docs: DataFrame, others: DataFrame) -> DataFrame:
    """The rows of `others` with a `_key` that no doc_id is."""
    low, high = docs.agg(F.min(F.col("doc_id").cast("long")), F.max(F.col("doc_id").cast("long"))).first()
    row = F.monotonically_increasing_id()
    return written(others.withColumn("_key", F.lit(high + 1) + row if high < 1 << 61 else F.lit(low - 1) - row), "others")


def _keyed(rows: DataFrame, others: DataFrame, number: Column, digest: Column) -> DataFrame:
    """The rows with their `_key`: their own number of `others`, or else the doc_id."""
    named = rows.withColumns({"_id": number, "_text": digest})
    return named.join(others, ["_id", "_text"], "left").withColumn("_key", F.coalesce("_key", "_id")).drop("_id", "_text")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them: a row for each time."""
    return mix(docs, weights=(5, 2, 1), share=1.5, most=2)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a document out of the written files: doc_id, start, n_tokens, ids_crc32."""
    return read_tokens(write_tokens(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", classify_quality),
    ("n-gram Jaccard join", join_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = new_folder(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
