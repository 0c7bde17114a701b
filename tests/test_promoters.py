"""The scorecard on small tables, and its rewrites against the plain forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from surveyloom import settings as S
from surveyloom.operators import promoters as P
from surveyloom.plans import scorecard
from surveyloom.settings import Settings
from surveyloom.sources.tables import Sources

AS_OF = dt.date(2026, 2, 10)
FLAG_COLUMNS = (
    "complete_ophth", "complete_sun", "plano_sun", "contact_lens", "dr_service_exams", "lens_focal_type",
    "lens_only_ophth", "lens_only_sun", "frame_only_ophth", "accessory", "reader",
)


def build(spark, url, headers=None, receipts=(), results=()):
    """Sources around a list of invitations (id, day, type, channel, header)."""
    days = {u[1] for u in url}
    headers = [(u[4], "L", "S1", "site", f"r{u[4]}") for u in url if u[4]] if headers is None else headers
    lines = [(r, *[flags.get(f) for f in FLAG_COLUMNS]) for r, flags in receipts]
    make = spark.createDataFrame
    return Sources(
        spark,
        {
            "survey_url": make([(u[0], u[1], u[2], u[3], u[4], "7") for u in url], "survey_h_hid string, invitation_date timestamp, survey_type string, purchase_channel string, txnheader_h_hid string, source_site string"),
            "calendar": make([(d.date(), str(d.year), str(d.month)) for d in days], "fiscal_date date, fiscal_year string, fiscal_month string"),
            "transaction_headers": make(headers, "txnheader_h_hid string, distribution_channel string, sales_organization string, site_h_hid string, receipt_h_hid string"),
            "dim_distribution_channel_country": make([("S1", "L"), ("S1", "H1")], "sales_organization string, distribution_channel string"),
            "dim_country": make([("S1", "IT", "Italy", "EUROPE")], "sales_organization string, country string, country_description string, region string"),
            "dim_brand_type": make([("L", "Banner", "Retail"), ("H1", "Banner", "Retail")], "distribution_channel string, brand string, type string"),
            "sites": make([("site", "Centre")], "site_h_hid string, site_name string"),
            "transaction_receipt": make(lines, "receipt_h_hid string, " + ", ".join(f"{f} boolean" for f in FLAG_COLUMNS)),
            "survey_results": make(list(results), "survey_h_hid string, opt_ltr_score string, sun_ltr_score string, product_ltr_score string, score string, doctor_ltr_score string"),
        },
    )


def answer(survey, score=None, doctor=None):
    return (survey, score, None, None, None, doctor)


JAN = dt.datetime(2026, 1, 15, 9)
DEC = dt.datetime(2025, 12, 31, 9)


def card(sources, **kw):
    rows = scorecard.promoter_scorecard(sources, as_of=AS_OF, **kw).collect()
    return {(r.product, r.survey_type): r for r in rows}


def test_scope_of_invitations(spark):
    url = [
        ("in", JAN, "Optical", None, "h1"),
        ("no type", JAN, None, None, "h2"),
        ("excluded", JAN, "PICKUP_Optical", None, "h3"),
        ("old", dt.datetime(2025, 11, 30), "Optical", None, "h4"),
        ("this month", dt.datetime(2026, 2, 1), "Optical", None, "h5"),
    ]
    rows = scorecard.invited(build(spark, url), as_of=AS_OF).collect()
    assert [(r.survey_h_hid, r.channel) for r in rows] == [("in", "Brick and Mortar")]


def test_invitation_without_header_is_counted_but_not_published(spark):
    sources = build(spark, [("1", JAN, "Optical", None, "h1"), ("2", JAN, "Optical", None, None)])
    counts = P.promoter_counts(P.survey_marks(scorecard.scored_surveys(sources, as_of=AS_OF))).collect()
    assert sum(r.survey_sent for r in counts) == 2
    assert card(sources)["OVERALL", "NPS"].survey_sent == 1


def test_excluded_channel(spark):
    headers = [("h1", "H1", "S1", "site", "r1")]
    assert card(build(spark, [("1", JAN, "Optical", None, "h1")], headers)) == {}


def test_two_lines_raise_two_flags_for_one_survey(spark):
    receipts = [("rh1", {"plano_sun": True}), ("rh1", {"reader": True}), ("rh1", {})]
    rows = card(build(spark, [("1", JAN, "Optical", None, "h1")], receipts=receipts))
    assert set(rows) == {("OVERALL", "NPS"), ("PLANO SUN", "NPS"), ("READER", "NPS")}
    assert {r.survey_sent for r in rows.values()} == {1}


@pytest.mark.parametrize("flag", ["complete_ophth", "complete_sun", "lens_focal_type", "lens_only_ophth", "lens_only_sun", "frame_only_ophth"])
def test_optical_flags(spark, flag):
    assert ("OPTICAL", "NPS") in card(build(spark, [("1", JAN, "Optical", None, "h1")], receipts=[("rh1", {flag: True})]))


def test_one_survey_with_two_answers_counts_on_both_sides(spark):
    sources = build(spark, [("1", JAN, "Optical", None, "h1")], results=[answer("1", "9"), answer("1", "3")])
    row = card(sources)["OVERALL", "NPS"]
    assert (row.voters, row.promoters, row.detractors, row.score) == (1, 1, 1, 0.0)


def test_no_voters_no_score(spark):
    row = card(build(spark, [("1", JAN, "Optical", None, "h1")], results=[answer("1", "11", "x")]))["OVERALL", "NPS"]
    assert (row.voters, row.score, row.doctor_voters, row.doctor_score) == (0, None, 0, None)


def test_doctor_scores(spark):
    results = [answer("1", None, "10"), answer("2", None, "8"), answer("3", None, "0")]
    url = [(i, JAN, "Optical", None, f"h{i}") for i in "123"]
    row = card(build(spark, url, results=results))["OVERALL", "NPS"]
    assert (row.doctor_voters, row.doctor_promoters, row.doctor_passive, row.doctor_detractors, row.doctor_score) == (3, 1, 1, 1, 0.0)


def test_exam_view_before_and_after_the_cutover(spark):
    url = [
        ("1", DEC, "EXAM_Optical", None, "h1"),
        ("2", DEC, "Optical", None, "h2"),
        ("3", JAN, "Optical", None, "h3"),
    ]
    receipts = [(f"rh{i}", {"dr_service_exams": True}) for i in "123"]
    rows = scorecard.promoter_scorecard(build(spark, url, receipts=receipts), as_of=AS_OF).filter("product = 'DR EXAM'")
    assert sorted((r.fiscal_date, r.survey_type) for r in rows.collect()) == [(DEC.date(), "EXAM NPS"), (JAN.date(), "NPS")]


def test_surveys_without_id_make_a_group_but_no_count(spark):
    url = [(None, JAN, "Optical", None, "h1"), (None, JAN, "Optical", None, "h2"), ("3", JAN, "Sun", "Internet", "h3")]
    rows = scorecard.promoter_scorecard(build(spark, url, results=[answer(None, "9"), answer("3", "9")]), as_of=AS_OF).collect()
    assert sorted((r.channel, r.survey_sent, r.promoters) for r in rows) == [("Brick and Mortar", 0, 0), ("E-commerce", 1, 1)]


@pytest.fixture(scope="module")
def scored(spark):
    """Random scored surveys with repeated ids, nulls and a few flag sets."""
    rng = random.Random(5)
    pick = lambda *values: rng.choice(values)
    rows = []
    for _ in range(600):
        survey = pick("\u00001", *[f"s{i}" for i in range(60)])
        dims = (pick("NPS", "EXAM NPS"), pick(DEC.date(), JAN.date()), "2026", "1", "7", pick("x", None), "EU", pick("IT", None), "B", "L", "R", "c")
        rows.append((survey, *dims, rng.randrange(64), pick(None, *S.VALID_SCORES), pick(None, "x", *S.VALID_SCORES)))
    names = ["_survey", *P.SURVEY_DIMENSIONS, "flags", "score", "doctor_score"]
    kinds = {"fiscal_date": "date", "flags": "int"}
    return spark.createDataFrame(rows, ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)).cache()


def as_set(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def plain_counts(scored):
    survey = F.when(~F.col("_survey").startswith("\u0000"), F.col("_survey"))
    count = lambda test: F.countDistinct(F.when(test, survey))
    score, doctor = F.col("score"), F.col("doctor_score")
    tests = [F.lit(True), score.isNotNull(), score.isin(*S.DETRACTOR_SCORES), score.isin(*S.PASSIVE_SCORES), score.isin(*S.PROMOTER_SCORES)]
    tests += [doctor.isin(*v) for v in (S.VALID_SCORES, S.DETRACTOR_SCORES, S.PASSIVE_SCORES, S.PROMOTER_SCORES)]
    return scored.groupBy(*P.SURVEY_DIMENSIONS, "flags").agg(*[count(t).alias(m) for t, m in zip(tests, P.MEASURES)])


def test_marks_equal_distinct_counts(scored):
    assert as_set(P.promoter_counts(P.survey_marks(scored))) == as_set(plain_counts(scored))


def test_rollup_equals_one_branch_per_view(scored):
    counts = P.unpack_flags(plain_counts(scored))
    exam = (F.col("fiscal_date") >= F.lit(S.EXAM_CUTOVER)) | (F.col("survey_type") == S.EXAM_FAMILY)
    tests = {
        "OVERALL": F.lit(True), "OPTICAL": F.col("optical_flag"), "PLANO SUN": F.col("plano_flag"), "CONTACTS": F.col("contact_lens_flag"),
        "ACCESSORY": F.col("accessory_flag"), "READER": F.col("reader_flag"), "DR EXAM": F.col("dr_service_exams_flag") & exam,
    }
    parts = [
        counts.filter(test).groupBy(*P.SURVEY_DIMENSIONS).agg(*[F.sum(m).alias(m) for m in P.MEASURES]).withColumn("product", F.lit(name))
        for name, test in tests.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    marks = P.survey_marks(scored)
    assert as_set(P.product_rollup(marks)) == as_set(union)
    assert as_set(P.product_rollup(P.promoter_counts(marks))) == as_set(union)


def test_kinds_add_up_with_one_answer_per_survey(scored):
    single = scored.dropDuplicates(["_survey"])
    row = P.product_rollup(P.survey_marks(single)).agg(
        F.bool_and(F.expr("promoters + passive + detractors = voters")).alias("sum"), F.bool_and(F.expr("voters <= survey_sent")).alias("part")
    ).first()
    assert row.sum and row.part


def test_overall_covers_every_view(scored):
    rolled = P.product_rollup(P.survey_marks(scored))
    overall = rolled.filter("product = 'OVERALL'").select(*P.SURVEY_DIMENSIONS, F.col("survey_sent").alias("all"))
    same = None
    for d in P.SURVEY_DIMENSIONS:
        test = rolled[d].eqNullSafe(overall[d])
        same = test if same is None else same & test
    assert rolled.join(overall, same).filter("survey_sent > all").count() == 0


def test_result_does_not_depend_on_partitions(spark, scored):
    before = as_set(P.product_rollup(P.survey_marks(scored)))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert as_set(P.product_rollup(P.survey_marks(scored))) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_survey_key_is_shuffled_once(spark):
    """The count per survey and the join with the answers use one partitioning."""
    sources = build(spark, [("1", JAN, "Optical", None, "h1")], results=[answer("1", "9")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marks = P.survey_marks(scorecard.scored_surveys(sources, as_of=AS_OF))
        plan = marks._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(_survey") == 1


def test_wide_rows_are_folded_in_small_partitions(spark):
    """Small by bytes, the partitions of the survey fold must not be put together: its rows stand in memory several times."""
    sources = build(spark, [(str(i), JAN, "Optical", None, "h1") for i in range(2000)], results=[answer("1", "9")])
    scored = scorecard.scored_surveys(sources, as_of=AS_OF)
    sizes = [r["count"] for r in scored.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 100
    assert len(sizes) > 8 * spark.sparkContext.defaultParallelism


def test_hot_null_header_is_spread(spark):
    """A third of the rows without a header must not meet in one task."""
    from surveyloom.operators.dimensions import spread_nulls

    df = spark.range(3000).select(F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("k"), "id")
    keyed = df.withColumn("key", spread_nulls(F.col("k"), "id"))
    sizes = [r["count"] for r in keyed.repartition(8, "key").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 600
    assert keyed.filter("k IS NULL").join(df.selectExpr("k AS other"), F.col("key") == F.col("other")).count() == 0
