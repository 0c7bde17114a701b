"""The promoter scorecard of the last closed months, from invitations to scores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.codes import channel_of, period_key
from surveyloom.functions.dates import in_previous_months
from surveyloom.operators import promoters as P
from surveyloom.operators.dimensions import banner_prep, left_join_sparse, with_fiscal_period
from surveyloom.operators.merging import join_null_safe, replace_by_key, replace_by_text_key
from surveyloom.session import materialise
from surveyloom.settings import Settings
from surveyloom.sources.tables import Sources

OUTPUT = (
    "fiscal_year",
    "fiscal_month",
    "fiscal_date",
    "survey_type",
    "source_site",
    "site_name",
    "region",
    "country",
    "banner",
    "distribution_channel",
    "type",
    "channel",
    "product",
    *P.MEASURES,
    "score",
    "doctor_score",
)


def invited(
    sources: Sources, settings: Settings = Settings(), as_of: dt.date | None = None, months: int = 2
) -> DataFrame:
    """Invitations of the last `months` closed months that are in scope, with fiscal period."""
    url = sources.read("survey_url").select(
        "survey_h_hid",
        "txnheader_h_hid",
        "invitation_date",
        "survey_type",
        channel_of(F.col("purchase_channel")).alias("channel"),
        "source_site",
    )
    in_scope = url.filter(
        in_previous_months(F.col("invitation_date"), as_of, months)
        & ~F.col("survey_type").isin(*settings.excluded_survey_types)
    )
    return with_fiscal_period(in_scope, sources.read("calendar")).drop("invitation_date")


def surveys_with_header(invitations: DataFrame, sources: Sources) -> DataFrame:
    """Add header, banner and site columns; an invitation without a header stays."""
    headers = sources.read("transaction_headers").select(
        "txnheader_h_hid", "distribution_channel", "sales_organization", "site_h_hid", "receipt_h_hid"
    )
    # A table, because a join's own size is over-estimated; Spark broadcasts it by its true one.
    banners = materialise(
        banner_prep(
            sources.read("dim_distribution_channel_country"),
            sources.read("dim_country"),
            sources.read("dim_brand_type"),
        ),
        "banners",
    )
    sites = sources.read("sites").select("site_h_hid", "site_name")
    joined = left_join_sparse(invitations, headers, "txnheader_h_hid", "survey_h_hid")
    return (
        joined.join(banners, ["distribution_channel", "sales_organization"], "left")
        .join(sites, "site_h_hid", "left")
        .select("survey_h_hid", *P.SURVEY_DIMENSIONS, "receipt_h_hid")
    )


def scored_surveys(
    sources: Sources,
    settings: Settings = Settings(),
    as_of: dt.date | None = None,
    months: int = 2,
    strict: bool = False,
) -> DataFrame:
    """One row per survey, dimensions and answer, with flags and scores."""
    surveys = surveys_with_header(invited(sources, settings, as_of, months), sources)
    flagged = P.product_flags(surveys, sources.read("transaction_receipt"))
    return P.with_scores(flagged, sources.read("survey_results"), settings.survey_families, strict)


def promoter_scorecard(
    sources: Sources,
    settings: Settings = Settings(),
    as_of: dt.date | None = None,
    months: int = 2,
    strict: bool = False,
) -> DataFrame:
    """Counts and scores per day, dimensions and product view."""
    marks = P.survey_marks(scored_surveys(sources, settings, as_of, months, strict))
    rollup = P.product_rollup(marks, settings.exam_cutover)
    in_scope = rollup.filter(~F.col("distribution_channel").isin(*settings.excluded_channels))
    return P.with_promoter_scores(in_scope).select(*OUTPUT)


KEYS = ("fiscal_year", "fiscal_month", "banner", "country")


def refresh_scorecard(target: DataFrame, batch: DataFrame, parity: bool = False) -> DataFrame:
    """The scorecard table after a run: the batch's (month, banner, country) are replaced.

    By default columns are compared one by one, null with null. With `parity` the key is
    one text without separators: rows with a null part are kept and come again, and
    different pairs with the same text count as one.
    """
    if not parity:
        return replace_by_key(target, batch, KEYS)
    return replace_by_text_key(
        target,
        batch,
        lambda df: period_key(df["fiscal_year"], df["fiscal_month"], df["banner"], df["country"]),
    )


def uncovered_days(target: DataFrame, batch: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Days that a refresh would delete and not bring back.

    Runs cover calendar months, the replaced key is a fiscal month. Where the two differ,
    earlier days of a fiscal month vanish; this lists them before the write.
    """
    columns = (*keys, "fiscal_date")
    replaced = join_null_safe(target.select(*columns).distinct(), batch, keys, "left_semi")
    return join_null_safe(replaced, batch, columns, "left_anti")
