"""Comment jobs: daily slice, translation, categorisation, word cloud."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.dates import on_previous_day
from surveyloom.functions.replies import parse_category, parse_translation
from surveyloom.functions.text import prefix_label
from surveyloom.operators import model as M
from surveyloom.operators.buckets import for_partition, with_partition_int
from surveyloom.operators.dimensions import with_banner
from surveyloom.operators.words import explode_words, remove_stopwords
from surveyloom.settings import Settings
from surveyloom.sources.tables import append_table, rewrite_table, upsert_table

COMMENT_PARTS = (
    "opt_ltr_followup_comment",
    "sun_ltr_followup_comment",
    "product_ltr_followup_comment",
    "verbatim",
)


def daily_slice(results: DataFrame, as_of: dt.date | None = None, tolerant: bool = False) -> DataFrame:
    """The answers of the day before `as_of`, with their bucket."""
    day = results.filter(on_previous_day(F.col("invitation_date"), as_of))
    return with_partition_int(day, tolerant=tolerant)


def fuse_comments(answers: DataFrame, *keep: str | Column, trim: bool = False) -> DataFrame:
    """`keep` and the fused comment, for answers that have one."""
    return M.fused_comment(answers, COMMENT_PARTS, keep, trim)


def brand_comments(answers: DataFrame, prefixes: Sequence[tuple[str, str]], trim: bool = False) -> DataFrame:
    """Comments of the brands that a prefix rule names; the other brands drop."""
    brand = prefix_label(F.col("brand_id"), prefixes).alias("brand")
    fused = fuse_comments(answers, "survey_h_hid", "invitation_date", brand, trim=trim)
    return fused.filter(F.col("brand").isNotNull())


def translate_comments(
    answers: DataFrame,
    client: M.ClientFactory,
    settings: Settings = Settings(),
    multiline: bool = False,
    status: bool = False,
) -> DataFrame:
    """Translated comments, ready for the upsert by `survey_h_hid` and `invitation_date`.

    A reply that cannot be read gives a null translation; the row and the reply stay.
    `status` adds that column, "" for an answered call and the error for a failed one.
    """
    comments = M.with_prompt(brand_comments(answers, settings.brand_prefixes), M.TRANSLATE_PROMPT)
    replied = M.generate_text(comments, client, settings.translation_options, store=settings.reply_store)
    return replied.select(
        "survey_h_hid",
        "invitation_date",
        "comment",
        "brand",
        F.col(M.RESULT).alias("result"),
        parse_translation(F.col(M.RESULT), multiline).alias("translated_comment"),
        *([F.col(M.STATUS).alias("status")] if status else []),
    )


def categorise_comments(
    answers: DataFrame,
    client: M.ClientFactory,
    settings: Settings = Settings(),
    validate: bool = False,
    status: bool = False,
) -> DataFrame:
    """Category of each comment, in its original language and for all brands.

    All buckets run in one job; filter `answers` by `for_partition` to run one. Categories
    are taken as the model gives them; `validate` adds whether they are on the list, and
    `status` adds that column, "" for an answered call and the error for a failed one.
    """
    comments = fuse_comments(answers, "survey_h_hid", "invitation_date")
    prompted = M.with_prompt(comments, M.category_prompt(settings.category_labels))
    replied = M.generate_text(prompted, client, settings.category_options, store=settings.reply_store)
    result = replied.select(
        "survey_h_hid",
        "invitation_date",
        "comment",
        parse_category(F.col(M.RESULT)).alias("comment_category"),
        *([F.col(M.STATUS).alias("status")] if status else []),
    )
    if validate:
        known = F.col("comment_category").isin(*settings.category_labels)
        result = result.withColumn("known_category", F.coalesce(known, F.lit(False)))
    return result


def cloud_comments(
    answers: DataFrame, brands: DataFrame, translations: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Comments for the word cloud: originals of the banners that are not translated, of
    all dates, and all translations of the others."""
    original = fuse_comments(
        with_banner(answers, brands), "survey_h_hid", "invitation_date", "banner"
    )
    translated = settings.translated_banners
    if translated:
        original = original.filter(~F.col("banner").isin(*translated))
    return original.unionByName(
        translations.select(
            "survey_h_hid",
            "invitation_date",
            F.col("brand").alias("banner"),
            F.col("translated_comment").alias("comment"),
        )
    )


def wordcloud_rows(comments: DataFrame, stopwords: Iterable[str] | DataFrame) -> DataFrame:
    """One row per occurrence of a word in a comment. No row leaves its task."""
    words = explode_words(comments, "comment", keep=("survey_h_hid", "invitation_date", "banner"))
    return remove_stopwords(words, stopwords).select("survey_h_hid", "invitation_date", "word", "banner")


KEY = ("survey_h_hid", "invitation_date")


def answered(rows: DataFrame) -> DataFrame:
    """The rows whose call succeeded, without `status`; a failed call must not replace what is stored."""
    return rows.filter(F.col("status") == "").drop("status")


def translate_day(
    spark: SparkSession,
    path: str,
    results: DataFrame,
    client: M.ClientFactory,
    settings: Settings = Settings(),
    as_of: dt.date | None = None,
    tolerant: bool = False,
) -> None:
    """The daily translation job: slice, translate, upsert into the table at `path`.

    Failed calls write nothing, so a stored translation stays and the next run asks again.
    """
    slim = daily_slice(results, as_of, tolerant)
    upsert_table(spark, path, answered(translate_comments(slim, client, settings, status=True)), KEY)


def categorise_bucket(
    spark: SparkSession,
    path: str,
    results: DataFrame,
    bucket: int,
    client: M.ClientFactory,
    settings: Settings = Settings(),
    as_of: dt.date | None = None,
    tolerant: bool = False,
) -> None:
    """The daily categorisation of one bucket: slice, pick, categorise, append to the table at `path`."""
    slim = for_partition(daily_slice(results, as_of, tolerant), bucket)
    append_table(answered(categorise_comments(slim, client, settings, status=True)), path)


def publish_cloud(path: str, rows: DataFrame) -> None:
    """Replace the word-cloud table by `rows`, from `wordcloud_rows`; they may read a table that is replaced."""
    rewrite_table(rows, path)
