import datetime as dt
import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import quality, triage
from surveyloom.operators.ranking import ranked
from surveyloom.plans import triage as job
from surveyloom.settings import Routing, Settings, SlaRule

DAY = dt.date(2025, 1, 1)


def order(i, seed=""):
    return (hashlib.md5(f"{i}{seed}".encode()).hexdigest(), i)


@pytest.mark.parametrize("digits", [1, 2])
def test_ranks_inside_hot_and_null_groups(spark, digits):
    rng = random.Random(2)
    rows = [(i, None if i % 3 == 0 else rng.choice("ab")) for i in range(900)]
    df = spark.createDataFrame(rows, "survey_id long, g string")
    got = {r.survey_id: r["rank"] for r in ranked(df, ["g"], "survey_id", "s", digits=digits).collect()}
    groups = defaultdict(list)
    for i, g in rows:
        groups[g].append(i)
    expected = {i: n + 1 for members in groups.values() for n, i in enumerate(sorted(members, key=lambda i: order(i, "s")))}
    assert got == expected


SIGNAL = "survey_id long, lang string, severity double, text string"


@pytest.mark.parametrize(
    "lang, severity, body, hits, critical",
    [
        ("en", 0.1, "They sold me a FRAUD, pure fraud!", 1, True),
        ("it", 0.1, "fraud", 0, False),
        ("it", 0.1, "chiedo un reso per danno", 2, True),
        ("fr", 0.9, "merci", 0, True),
        (None, None, None, 0, False),
    ],
)
def test_signals(spark, lang, severity, body, hits, critical):
    row = triage.critical_signals(spark.createDataFrame([(1, lang, severity, body)], SIGNAL)).first()
    assert (max(row.hits, 0), row.is_critical) == (hits, critical)


CLUSTER = "cluster_id long, category string, volume long, mean_confidence double, severity double, is_critical boolean, is_new boolean, first_day date, example_id long, score double"


@pytest.mark.parametrize(
    "volume, confidence, critical, new, route, reason",
    [
        (1, 0.1, True, True, "review", "critical signal"),
        (1, 0.9, False, True, "archive", "low volume"),
        (9, 0.9, False, True, "review", "new pattern"),
        (9, 0.1, False, False, "review", "low confidence"),
        (9, 0.9, False, False, "auto_ticket", "confident known pattern"),
    ],
)
def test_routes_and_reasons(spark, volume, confidence, critical, new, route, reason):
    df = spark.createDataFrame([(1, "c", volume, confidence, 0.2, critical, new, DAY, 1, 0.5)], CLUSTER)
    row = triage.route_clusters(df).first()
    assert (row.route, row.reason, row.rules_version) == (route, reason, "v1")
    strict = Routing(version="v2", min_volume=100)
    assert triage.route_clusters(df, strict).first().route == ("review" if critical else "archive")


def test_decisions_and_tickets(spark):
    routed = spark.createDataFrame(
        [(i, "c", 7, 0.9, 0.2, False, False, DAY, i, 0.5) for i in range(5)], CLUSTER
    )
    routed = routed.withColumn("route", F.element_at(F.array(*[F.lit(r) for r in ("review", "review", "review", "auto_ticket", "archive")]), (F.col("cluster_id") + 1).cast("int")))
    at = lambda h: dt.datetime(2025, 1, 1, h)
    decisions = spark.createDataFrame(
        [(0, "ann", at(1), "approve", None), (0, "bob", at(2), "correct", "d"), (1, "ann", at(1), "discard", None)],
        "cluster_id long, reviewer string, decided_at timestamp, action string, new_category string",
    )
    decided = triage.apply_decisions(routed, decisions)
    assert {r.cluster_id: (r.outcome, r.final_category, r.reviewer) for r in decided.collect()} == {
        0: ("ticket", "d", "bob"), 1: ("discarded", "c", "ann"), 2: ("waiting", "c", None), 3: ("ticket", "c", None), 4: ("archived", "c", None)
    }
    members = spark.range(35).select(F.col("id").alias("survey_id"), (F.col("id") % 5).alias("cluster_id"))
    tickets = triage.ticket_rows(decided, members, max_size=3).collect()
    assert sorted((t.ticket_id, t.survey_count, t.category) for t in tickets) == [
        ("0-0", 3, "d"), ("0-1", 3, "d"), ("0-2", 1, "d"), ("3-0", 3, "c"), ("3-1", 3, "c"), ("3-2", 1, "c")
    ]
    listed = sorted(int(i) for t in tickets for i in t.survey_ids.split(","))
    assert listed == sorted(i for i in range(35) if i % 5 in (0, 3))


def test_an_approval_keeps_the_correction(spark):
    routed = spark.createDataFrame([(0, "c", 7, 0.9, 0.2, False, False, DAY, 0, 0.5)], CLUSTER).withColumn("route", F.lit("review"))
    at = lambda h: dt.datetime(2025, 1, 1, h)
    schema = "cluster_id long, reviewer string, decided_at timestamp, action string, new_category string, new_priority string"
    rows = [(0, "ann", at(1), "correct", "d", None), (0, "bob", at(2), "approve", None, "urgent"), (0, "eve", at(3), "approve", None, None)]
    row = triage.apply_decisions(routed, spark.createDataFrame(rows, schema)).first()
    assert (row.final_category, row.priority, row.corrected, row.action, row.reviewer) == ("d", "urgent", True, "approve", "eve")


def surveys(spark, n=40):
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows = [(i, DAY + dt.timedelta(i % 4), "en", "c", 0.9, 0.1, " ".join(words[i % 3 :][:3]) + (" safety" if i % 10 == 0 else "")) for i in range(n)]
    return spark.createDataFrame(rows, "survey_id long, arrived date, lang string, category string, confidence double, severity double, text string")


def test_triage_job(spark, tmp_path):
    df = surveys(spark)
    history = str(tmp_path / "history")
    run = job.run(df, history)
    routed = run.routed.collect()
    assert sum(r.volume for r in routed) == 40
    assert len({r.cluster_id for r in routed}) == len(routed)
    assert all(r.reason and r.route in ("auto_ticket", "review", "archive") and r.is_new for r in routed)
    job.remember(spark, history, run, 0)
    again = job.run(df, history)
    assert {r.is_new for r in again.routed.collect()} == {False}
    queue = triage.review_queue(run.routed, df).collect()
    assert [r.severity for r in queue] == sorted((r.severity for r in queue), reverse=True)
    assert all("safety" in r.example_text or r.reason != "critical signal" for r in queue if r.volume == 1)


def test_qa_sample_is_whole_and_reproducible(spark):
    rows = [(i, DAY + dt.timedelta(i % 3), "auto" if i % 7 else "archive") for i in range(300)]
    df = spark.createDataFrame(rows, "survey_id long, day date, route string")
    got = {r.survey_id for r in quality.qa_sample(df, 20).collect()}
    expected = set()
    for d in range(3):
        expected |= set(sorted((i for i in range(300) if i % 3 == d), key=lambda i: order(i, "qa"))[:20])
    assert got == expected == {r.survey_id for r in quality.qa_sample(df.repartition(5), 20).collect()}
    assert got != {r.survey_id for r in quality.qa_sample(df, 20, seed="other").collect()}
    plan = quality.qa_sample(df, 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_qa_share_rounds_up_per_stratum(spark):
    rows = [(i, DAY, "auto" if i % 10 else None) for i in range(101)]
    df = spark.createDataFrame(rows, "survey_id long, day date, route string")
    sizes = Counter(r.route for r in quality.qa_sample_share(df, 0.25).collect())
    assert sizes == {"auto": math.ceil(90 * 0.25), None: math.ceil(11 * 0.25)}


def test_error_rate_and_curve(spark):
    df = spark.createDataFrame([(0.5, True), (0.7, False), (0.9, True), (0.9, None)], "confidence double, is_correct boolean")
    curve = {r.threshold: (r.automated, r.correct, r.coverage, r.precision) for r in quality.threshold_curve(df, (0.6, 0.95)).collect()}
    assert curve == {0.6: (3, 1, 0.75, 0.333333), 0.95: (0, 0, 0.0, None)}
    rate = quality.error_rate(df.withColumn("is_wrong", ~F.col("is_correct"))).first()
    assert (rate.reviewed, rate.errors, rate.error_rate) == (3, 1, 0.333333)


def test_trend(spark):
    at = lambda d: dt.datetime(2025, 1, d, 12)
    df = spark.createDataFrame([(at(1), "a"), (at(1), "a"), (at(1), "b"), (at(2), "a")], "ts timestamp, category string")
    got = {(r.day.day, r.category): (r.n, r.share, r.change) for r in quality.category_trend(df).collect()}
    assert got == {(1, "a"): (2, 0.666667, None), (1, "b"): (1, 0.333333, None), (2, "a"): (1, 1.0, -1)}


def test_sla(spark):
    t = dt.datetime
    rules = (SlaRule("high", 0.8, 4, "boss"), SlaRule("low", 0.0, 72, "lead"))
    df = spark.createDataFrame(
        [(1, 0.9, t(2025, 1, 1, 0), t(2025, 1, 1, 5)), (2, 0.9, t(2025, 1, 1, 0), t(2025, 1, 1, 3)), (3, 0.1, t(2025, 1, 1, 0), None), (4, 0.1, t(2024, 12, 1, 0), None), (5, None, t(2025, 1, 1), None)],
        "id int, severity double, opened_at timestamp, handled_at timestamp",
    )
    got = {r.id: (r.band, r.breached, r.escalate_to) for r in triage.sla_state(df, rules, t(2025, 1, 2)).collect()}
    assert got == {1: ("high", True, "boss"), 2: ("high", False, None), 3: ("low", False, None), 4: ("low", True, "lead"), 5: ("high", True, "boss")}


def test_settings_reach_the_job(spark):
    df = surveys(spark, 9)
    settings = Settings(routing=Routing(version="v7", min_volume=1000), critical_keywords={})
    run = job.run(df, settings=settings)
    assert {(r.route, r.rules_version) for r in run.routed.collect()} == {("archive", "v7")}
