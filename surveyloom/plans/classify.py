"""One model call per survey: category, confidence, severity and readable text, as the triage reads them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.replies import classification_body, read_classification
from surveyloom.operators import model as M
from surveyloom.plans.comments import daily_slice, fuse_comments
from surveyloom.session import scratch
from surveyloom.settings import Settings
from surveyloom.sources.tables import read_table, rewrite_table, upsert_table

KEY = ("survey_h_hid", "invitation_date")
FIELDS = ("category", "confidence", "severity", "translation")


def classify_comments(answers: DataFrame, client: M.ClientFactory, settings: Settings = Settings()) -> DataFrame:
    """One row per commented survey: its key, `comment`, the four fields, `reply` and `problem`.

    The reply is read by one schema, bare or fenced. `problem` is null if it may be used, else the first of: the error of a failed
    call, `unreadable`, `unknown category`, `confidence` or `severity` (missing or outside 0 to 1), `no text`.
    """
    comments = M.with_prompt(fuse_comments(answers, *KEY), M.classify_prompt(settings.category_labels))
    replied = M.generate_text(comments, client, settings.classification_options, store=settings.reply_store)
    # Exploded from arrays of one: what is read once stays read, where a plain column would be worked out again for each use.
    once = lambda col, name: F.explode(F.array(col)).alias(name)
    said = replied.select(*KEY, "comment", F.col(M.RESULT).alias("reply"), F.col(M.STATUS).alias("_status"), once(classification_body(F.col(M.RESULT)), "_body"))
    read = said.select(*KEY, "comment", "reply", "_status", once(read_classification(F.col("_body")), "_r"))
    rows = read.select(*KEY, "comment", "reply", "_status", *[F.col(f"_r.{f}").alias(f) for f in FIELDS])
    share = lambda name: F.coalesce(F.col(name).between(0, 1), F.lit(False))
    problem = (
        F.when(F.col("_status") != "", F.col("_status"))
        .when(F.coalesce(*[F.col(f).cast("string") for f in FIELDS]).isNull(), "unreadable")
        .when(~F.coalesce(F.col("category").isin(*settings.category_labels), F.lit(False)), "unknown category")
        .when(~share("confidence"), "confidence")
        .when(~share("severity"), "severity")
        .when(F.coalesce(F.trim("translation"), F.lit("")) == "", "no text")
    )
    return rows.withColumn("problem", problem).drop("_status")


def accepted(rows: DataFrame) -> DataFrame:
    """The rows that may be used, without reply and problem."""
    return rows.filter("problem IS NULL").drop("reply", "problem")


def refused(rows: DataFrame) -> DataFrame:
    """Key, comment, reply and problem of the others: for a look, and for another try."""
    return rows.filter("problem IS NOT NULL").select(*KEY, "comment", "reply", "problem")


def for_triage(classified: DataFrame) -> DataFrame:
    """Accepted rows as the triage reads them; the text is the readable one."""
    return classified.select(
        F.col("survey_h_hid").alias("survey_id"), F.to_date("invitation_date").alias("arrived"), F.lit("en").alias("lang"),
        "category", "confidence", "severity", F.col("translation").alias("text"),
    )


def classify_day(
    spark: SparkSession,
    path: str,
    refused_path: str,
    answers: DataFrame,
    client: M.ClientFactory,
    settings: Settings = Settings(),
    as_of: dt.date | None = None,
    tolerant: bool = False,
) -> None:
    """The daily classification job: slice, classify, upsert the accepted rows into `path` and the refused ones into `refused_path`.

    A survey that is accepted in a later run leaves the refused ones; one that is refused later keeps what is stored.
    """
    with scratch(classify_comments(daily_slice(answers, as_of, tolerant), client, settings), "classified") as rows:
        upsert_table(spark, path, accepted(rows), KEY)
        upsert_table(spark, refused_path, refused(rows), KEY)
    left = read_table(spark, refused_path).join(read_table(spark, path).select(*KEY), list(KEY), "left_anti")
    rewrite_table(left, refused_path)
