import datetime as dt

import pytest

from surveyloom.operators.dimensions import with_global_max
from surveyloom.plans import marts
from surveyloom.settings import Settings
from surveyloom.sources.tables import Sources

AS_OF = dt.date(2026, 3, 1)
T = dt.datetime
SETTINGS = Settings(second_region_banners=("Shared", "Local"), first_region_excluded_banners=("Local",), brand_names_without_blanks=("Two Words",))
URL = "survey_h_hid string, invitation_date timestamp, brand_id string, brand_name string, source_site string, purchase_channel string"
REST = ("txnheader_h_hid", "survey_id", "survey_type", "receipt_number", "zone", "date_of_purchase", "store_name")


def region(spark, *url):
    df = spark.createDataFrame(list(url), URL)
    for name in REST:
        df = df.selectExpr("*", f"'{name}' AS {name}")
    make = spark.createDataFrame
    return Sources(
        spark,
        {
            "survey_url": df,
            "dim_country": make([("IT", "Italy", "EUROPE", "S1"), ("IT", "Italy", "EUROPE", "S2"), ("NA", "Namibia", "AFRICA", "S3")], "country string, country_description string, region string, sales_organization string"),
            "dim_brand_nps": make([(f"{b}{c}", n) for b, n in (("SH", "Shared"), ("LC", "Local"), ("OT", "Other")) for c in ("IT", "LO", "XX")], "brand_id string, banner string"),
            "dim_brand_type": make([("L", "Shared", "Retail"), ("M", "Shared", "Retail"), ("L", "Other", "Outlet"), ("L", "Other", "Retail")], "distribution_channel string, brand string, type string"),
            "sites": make([("1", "CA10"), ("2", "US10")], "site_number string, sales_organization string"),
        },
    )


DAY = T(2026, 1, 5, 13, 30)


def test_invitation_mart(spark):
    first = region(
        spark,
        ("a", DAY, "OTIT", "Two Words", "1", "Internet"),
        ("b", DAY, "LCIT", "n", "1", None),
        ("c", DAY, "LCLO", "Two  Other", "1", None),
        ("d", DAY, "OTLO", "n", "2", None),
        ("e", DAY, "OTLO", "n", "9", None),
        ("f", DAY, "OTXX", "n", "1", None),
        ("g", DAY, "ZZIT", "n", "1", None),
        ("h", T(2023, 12, 31), "OTIT", "n", "1", None),
        ("i", T(2024, 1, 1), "SHIT", "n", "1", None),
    )
    second = region(spark, ("j", T(2026, 2, 1, 8), "SHIT", "n", "1", None), ("k", DAY, "OTIT", "n", "1", None), ("l", DAY, "SHLO", "n", "1", None))
    df = marts.invitation_mart(first, second, SETTINGS, AS_OF)
    rows = df.collect()
    assert len(df.columns) == 18
    places = sorted({(r.survey_h_hid, r.country_description, r.region) for r in rows})
    assert places == [
        ("a", "Italy", "EUROPE"), ("c", "Canada", "North America"), ("d", "United States", "North America"),
        ("e", "NA", "North America"), ("i", "Italy", "EUROPE"), ("j", "Italy", "EUROPE"),
    ]
    by = {r.survey_h_hid: r for r in rows}
    assert sum(r.survey_h_hid == "a" for r in rows) == 2  # two business types
    assert by["a"].brand_name == "TwoWords" and by["c"].brand_name == "Two  Other"
    assert by["a"].purchase_channel == "E-commerce" and by["a"].store_name == "STORE_NAME"
    assert by["a"].invitation_date == DAY.date()
    assert {r.max_invitation_date for r in rows} == {T(2026, 2, 1, 8)}


def test_handover_gives_a_shared_banner_from_one_region(spark):
    early, late = T(2025, 3, 1), T(2025, 5, 1)
    url = [("e", early, "SHIT", "n", "1", None), ("l", late, "SHIT", "n", "1", None)]
    both = region(spark, *url), region(spark, *url)
    assert marts.invitation_mart(*both, SETTINGS, AS_OF).count() == 4
    single = marts.invitation_mart(*both, SETTINGS, AS_OF, handover=dt.date(2025, 4, 1)).collect()
    assert sorted(r.survey_h_hid for r in single) == ["e", "l"]


def test_results_mart_drops_unknown_brands(spark):
    schema = "brand_id string, invitation_date timestamp, score string, " + ", ".join(f"{c} string" for c in marts.RESULT_COLUMNS)
    fill = (None,) * len(marts.RESULT_COLUMNS)
    rows = [(b, DAY, b, *fill) for b in ("OTIT", "LCIT", "SHIT", "ZZIT")]
    base = region(spark)
    tables = {**base.tables, "survey_results": spark.createDataFrame(rows, schema)}
    both = Sources(spark, tables), Sources(spark, tables)
    df = marts.results_mart(*both, SETTINGS, AS_OF)
    assert len(df.columns) == 16
    assert sorted(r.score for r in df.collect()) == ["LCIT", "OTIT", "SHIT", "SHIT"]


def test_case_mart_of_one_or_two_regions(spark):
    rows = spark.createDataFrame([("x",) * 9 + ("y",)], ", ".join(f"{c} string" for c in (*marts.CASE_COLUMNS, "other")))
    source = Sources(spark, {"survey_ctl": rows})
    assert marts.case_mart(source).count() == 1 and marts.case_mart(source, source).count() == 2
    assert tuple(marts.case_mart(source).columns) == marts.CASE_COLUMNS


def test_global_max_needs_no_window_and_no_join(spark):
    df = with_global_max(spark.range(100).toDF("x"), "x", "top")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "CartesianProduct" not in plan
    assert {r.top for r in df.collect()} == {99}


def test_region_filters_reach_the_scan(spark, tmp_path):
    base = region(spark, ("a", DAY, "OTIT", "n", "1", None))
    base.read("survey_url").write.parquet(str(tmp_path / "url"))
    sources = Sources(spark, {**base.tables, "survey_url": str(tmp_path / "url")})
    plan = marts.invitation_mart(sources, base, SETTINGS, AS_OF)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(invitation_date,2024-01-01" in plan
