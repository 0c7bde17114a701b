"""Survey marts over two regions: invitations, results, case management."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import codes
from surveyloom.functions.dates import in_rolling_years
from surveyloom.operators.dimensions import (
    with_banner,
    with_business_type,
    with_global_max,
    with_sales_organization,
)
from surveyloom.settings import NA_CODE, Settings
from surveyloom.sources.tables import Sources

RESULT_COLUMNS = (
    "google_review_yn",
    "survey_h_hid",
    "survey_id",
    "survey_type",
    "transaction_id",
    "verbatim",
    "opt_ltr_score",
    "sun_ltr_score",
    "doctor_ltr_score",
    "product_ltr_score",
    "opt_ltr_followup_comment",
    "sun_ltr_followup_comment",
    "product_ltr_followup_comment",
)

CASE_COLUMNS = (
    "survey_h_hid",
    "survey_id",
    "survey_type",
    "cmmacro0",
    "dispositioncode1",
    "lcccomment",
    "incidentid",
    "incidentstatus",
    "verifiedcategory1",
)


def with_country(fact: DataFrame, countries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add `country_description` and `region` by the code at the end of the brand id.

    North America overrides the dimension; an unknown code gives nulls.
    """
    known = countries.select("country", "region", "country_description").distinct()
    coded = fact.withColumn("_code", codes.country_code(F.col("brand_id"), settings.na_suffixes))
    joined = coded.join(known, coded["_code"] == known["country"], "left")
    code = F.col("_code")
    return joined.select(
        *[coded[c] for c in fact.columns],
        codes.country_name(code, known["country_description"]).alias("country_description"),
        codes.country_region(code, known["region"]).alias("region"),
    )


def regional_invitations(
    sources: Sources, keep: Column, settings: Settings = Settings(), as_of: dt.date | None = None
) -> DataFrame:
    """One region's invitations of the rolling years with their dimensions.

    `keep` may use `country_description` and `banner`.
    """
    url = sources.read("survey_url").filter(in_rolling_years(F.col("invitation_date"), as_of))
    placed = with_country(url, sources.read("dim_country"), settings)
    kept = with_banner(placed, sources.read("dim_brand_nps")).filter(keep)
    typed = with_business_type(kept, sources.read("dim_brand_type"))
    sited = with_sales_organization(typed, sources.read("sites"))
    return sited.select(
        "invitation_date",
        "source_site",
        F.upper("store_name").alias("store_name"),
        "survey_h_hid",
        "txnheader_h_hid",
        "survey_id",
        "survey_type",
        "receipt_number",
        "brand_name",
        "brand_id",
        "zone",
        "date_of_purchase",
        codes.channel_of(F.col("purchase_channel")).alias("purchase_channel"),
        F.col("banner").alias("brand_corr"),
        "business_type",
        "region",
        "country_description",
        "sales_organization",
    )


def invitation_mart(
    first: Sources,
    second: Sources,
    settings: Settings = Settings(),
    as_of: dt.date | None = None,
    handover: dt.date | None = None,
) -> DataFrame:
    """Invitations of both regions, 18 columns.

    The first region gives North America whole and, elsewhere, all banners but the
    excluded ones; the two conditions are one filter over one scan. The second region
    gives its own banners outside North America. A banner on the second list that is not
    excluded from the first comes from both; with `handover` it comes from the first
    before that day and from the second from then on.
    """
    country, banner = F.col("country_description"), F.col("banner")
    elsewhere = country != NA_CODE
    shared = banner.isin(*settings.second_region_banners)
    in_first = (country == NA_CODE) | (
        elsewhere & ~banner.isin(*settings.first_region_excluded_banners)
    )
    in_second = elsewhere & shared
    if handover is not None:
        early = F.col("invitation_date") < F.lit(handover)
        in_first = in_first & ((country == NA_CODE) | early | ~shared)
        in_second = in_second & ~early
    both = regional_invitations(first, in_first, settings, as_of).unionByName(
        regional_invitations(second, in_second, settings, as_of)
    )
    # The maximum is taken over the source timestamps, before the cast to a date.
    dated = with_global_max(both, "invitation_date", "max_invitation_date")
    names = settings.brand_names_without_blanks
    country = codes.split_north_america(F.col("country_description"), F.col("sales_organization"))
    return dated.withColumns(
        {
            "invitation_date": F.to_date("invitation_date"),
            "brand_name": codes.without_blanks(F.col("brand_name"), names),
            "country_description": country,
        }
    ).drop("sales_organization")


def regional_results(
    sources: Sources, keep: Column, as_of: dt.date | None = None
) -> DataFrame:
    """One region's answers of the rolling years; answers of an unknown brand drop with `keep`."""
    results = sources.read("survey_results").filter(in_rolling_years(F.col("invitation_date"), as_of))
    kept = with_banner(results, sources.read("dim_brand_nps"), "left").filter(keep)
    return kept.select(
        "banner", F.to_date("invitation_date").alias("invitation_date"), "score", *RESULT_COLUMNS
    )


def results_mart(
    first: Sources, second: Sources, settings: Settings = Settings(), as_of: dt.date | None = None
) -> DataFrame:
    """Answers of both regions, 16 columns."""
    banner = F.col("banner")
    return regional_results(
        first, ~banner.isin(*settings.first_region_excluded_banners), as_of
    ).unionByName(regional_results(second, banner.isin(*settings.second_region_banners), as_of))


def case_mart(first: Sources, second: Sources | None = None) -> DataFrame:
    """Case management rows, 9 columns; of the second region too if it is given."""
    rows = first.read("survey_ctl").select(*CASE_COLUMNS)
    if second is None:
        return rows
    return rows.unionByName(second.read("survey_ctl").select(*CASE_COLUMNS))
