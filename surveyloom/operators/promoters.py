"""Promoter scorecard: receipt flags, counts of voters, product views, scores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom import settings as S
from surveyloom.functions.codes import any_flag, family_of, percent_score, unify_score
from surveyloom.functions.dates import dated_rule
from surveyloom.operators.dimensions import NO_KEY, left_join_sparse, spread_nulls
from surveyloom.session import fine_partitions

FLAGS = (
    "optical_flag",
    "plano_flag",
    "contact_lens_flag",
    "dr_service_exams_flag",
    "accessory_flag",
    "reader_flag",
)

SURVEY_DIMENSIONS = (
    "survey_type",
    "fiscal_date",
    "fiscal_year",
    "fiscal_month",
    "source_site",
    "site_name",
    "region",
    "country",
    "banner",
    "distribution_channel",
    "type",
    "channel",
)

MEASURES = (
    "survey_sent",
    "voters",
    "detractors",
    "passive",
    "promoters",
    "doctor_voters",
    "doctor_detractors",
    "doctor_passive",
    "doctor_promoters",
)

SCORE_COLUMNS = ("opt_ltr_score", "sun_ltr_score", "product_ltr_score", "score")


def pack(tests: Sequence[Column]) -> Column:
    """Booleans as the bits of one integer: one column to shuffle and to aggregate."""
    packed = F.lit(0)
    for i, test in enumerate(tests):
        packed = packed.bitwiseOR(F.when(test, 1 << i).otherwise(0))
    return packed


def bit(packed: Column, i: int) -> Column:
    return F.shiftright(packed, i).bitwiseAND(F.lit(1))


def line_flags() -> list[Column]:
    """What one receipt line says about the six products, in the order of `FLAGS`."""
    c = F.col
    lens_only = any_flag(c("lens_focal_type"), c("lens_only_ophth"), c("lens_only_sun"))
    return [
        any_flag(c("complete_ophth"), c("complete_sun"), lens_only, c("frame_only_ophth")),
        any_flag(c("plano_sun")),
        any_flag(c("contact_lens")),
        any_flag(c("dr_service_exams")),
        any_flag(c("accessory")),
        any_flag(c("reader")),
    ]


def receipt_flags(receipts: DataFrame) -> DataFrame:
    """One row per receipt that raises any flag, with the flags packed.

    The lines are reduced before they meet the surveys: lines that raise no flag drop in
    the scan, the rest combine in each task, so a receipt with very many lines costs no
    more than any other.
    """
    lines = receipts.select("receipt_h_hid", pack(line_flags()).alias("flags"))
    marked = lines.filter((F.col("flags") != 0) & F.col("receipt_h_hid").isNotNull())
    return marked.groupBy("receipt_h_hid").agg(F.bit_or("flags").alias("flags"))


def product_flags(surveys: DataFrame, receipts: DataFrame) -> DataFrame:
    """Packed flags per survey and dimensions: set if any line of any receipt raises it.

    `surveys` holds the dimensions, `survey_h_hid` and `receipt_h_hid`. The result is
    partitioned by survey, which the join with the answers and the count per survey use
    as it is: this stage folds whole rows five times, so its partitions are small and aren't
    coalesced. Surveys without an id are taken apart by their dimensions.
    """
    flagged = left_join_sparse(surveys, receipt_flags(receipts), "receipt_h_hid", "survey_h_hid")
    return (
        flagged.withColumn("_survey", spread_nulls(F.col("survey_h_hid"), *SURVEY_DIMENSIONS))
        .repartition(fine_partitions(surveys.sparkSession), "_survey")
        .groupBy("_survey", *SURVEY_DIMENSIONS)
        .agg(F.coalesce(F.bit_or("flags"), F.lit(0)).alias("flags"))
    )


def survey_id() -> Column:
    """The survey id of a frame that `product_flags` made; null where there was none."""
    return F.when(~F.col("_survey").startswith(NO_KEY), F.col("_survey"))


def unpack_flags(df: DataFrame) -> DataFrame:
    """The packed flags as six boolean columns."""
    flags = {name: bit(F.col("flags"), i) == 1 for i, name in enumerate(FLAGS)}
    return df.withColumns(flags).drop("flags")


def with_scores(
    flagged: DataFrame,
    answers: DataFrame,
    families: Sequence[tuple[str, Sequence[str]]] = S.SURVEY_FAMILIES,
    strict: bool = False,
) -> DataFrame:
    """Add the unified score and the doctor score, and turn survey types into families.

    A survey with several answers yields several rows.
    """
    scored = answers.select(
        F.col("survey_h_hid").alias("_answered"),
        unify_score(*[F.col(c) for c in SCORE_COLUMNS], strict=strict).alias("score"),
        F.col("doctor_ltr_score").alias("doctor_score"),
    )
    joined = flagged.join(scored, F.col("_survey") == F.col("_answered"), "left").drop("_answered")
    return joined.withColumn("survey_type", family_of(F.col("survey_type"), families))


def survey_marks(scored: DataFrame) -> DataFrame:
    """One row per survey, dimensions and flags, with nine 0/1 marks named as the measures.

    A count of distinct surveys is a sum of these marks. Nine distinct counts in one plan
    would copy each row nine times; this folds the rows of one survey inside the
    partitioning that the join left.
    """
    has_id = ~F.col("_survey").startswith(NO_KEY)
    score, doctor = F.col("score"), F.col("doctor_score")
    tests = [
        has_id,
        has_id & score.isNotNull(),
        has_id & score.isin(*S.DETRACTOR_SCORES),
        has_id & score.isin(*S.PASSIVE_SCORES),
        has_id & score.isin(*S.PROMOTER_SCORES),
        has_id & doctor.isin(*S.VALID_SCORES),
        has_id & doctor.isin(*S.DETRACTOR_SCORES),
        has_id & doctor.isin(*S.PASSIVE_SCORES),
        has_id & doctor.isin(*S.PROMOTER_SCORES),
    ]
    keys = (*SURVEY_DIMENSIONS, "flags")
    folded = scored.groupBy("_survey", *keys).agg(F.bit_or(pack(tests)).alias("_marks"))
    marks = [bit(F.col("_marks"), i).cast("bigint").alias(name) for i, name in enumerate(MEASURES)]
    return folded.select(*keys, *marks)


def promoter_counts(marks: DataFrame) -> DataFrame:
    """Distinct surveys per dimensions and flags, by kind of answer."""
    return marks.groupBy(*SURVEY_DIMENSIONS, "flags").agg(*[F.sum(m).alias(m) for m in MEASURES])


def product_rollup(counts: DataFrame, cutover: dt.date = S.EXAM_CUTOVER) -> DataFrame:
    """Sums per product view, from marks or from counts.

    The views overlap: a row counts in each view it qualifies for. The examination view
    takes, before the cut-over, surveys of the examination family only. Sums are taken
    over the dimensions and flags, so a survey under two sets of flags counts twice in
    the overall view, by design.
    """
    flag = lambda name: bit(F.col("flags"), FLAGS.index(name)) == 1
    exam_rule = dated_rule(
        F.col("fiscal_date"), cutover, F.col("survey_type") == S.EXAM_FAMILY, F.lit(True)
    )
    views = F.array(
        F.lit("OVERALL"),
        F.when(flag("optical_flag"), "OPTICAL"),
        F.when(flag("plano_flag"), "PLANO SUN"),
        F.when(flag("contact_lens_flag"), "CONTACTS"),
        F.when(flag("accessory_flag"), "ACCESSORY"),
        F.when(flag("reader_flag"), "READER"),
        F.when(flag("dr_service_exams_flag") & exam_rule, "DR EXAM"),
    )
    # Nulls go right after the explode: dropping them inside the array leaves generated code.
    viewed = counts.select(*SURVEY_DIMENSIONS, F.explode(views).alias("product"), *MEASURES)
    return (
        viewed.filter(F.col("product").isNotNull())
        .groupBy(*SURVEY_DIMENSIONS, "product")
        .agg(*[F.sum(m).alias(m) for m in MEASURES])
    )


def with_promoter_scores(rollup: DataFrame) -> DataFrame:
    """Promoters minus detractors in percent of voters; null without voters."""
    c = F.col
    return rollup.withColumns(
        {
            "score": percent_score(c("promoters"), c("detractors"), c("voters")),
            "doctor_score": percent_score(
                c("doctor_promoters"), c("doctor_detractors"), c("doctor_voters")
            ),
        }
    )
