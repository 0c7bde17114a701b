"""Classification replies, signals of any language, and the QA sample of a fixed size."""

import datetime as dt
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import quality, triage
from surveyloom.operators.signals import signal_hits
from surveyloom.plans import classify
from surveyloom.plans import triage as job
from surveyloom.settings import CATEGORY_LABELS, Settings

DAY = dt.date(2025, 3, 1)
PARTS = ("opt_ltr_followup_comment", "sun_ltr_followup_comment", "product_ltr_followup_comment", "verbatim")
ONE = CATEGORY_LABELS[0]


def answers(spark, texts, day=DAY):
    rows = [(str(i), f"{i:04}", dt.datetime.combine(day, dt.time()), t, None, None, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "survey_h_hid string, survey_id string, invitation_date timestamp_ntz, " + ", ".join(f"{p} string" for p in PARTS))


def saying(replies):
    """A client that answers a prompt by the text at its end."""

    def build():
        def call(prompts, options):
            found = [next(r for t, r in replies.items() if p.endswith(f"Text: {t}")) for p in prompts]
            if any(r == "fail" for r in found):
                raise ConnectionError("refused")
            return found

        return call

    return build


def good(**other):
    return json.dumps({"category": ONE, "confidence": 0.5, "severity": 1, "translation": "fine"} | other)


def test_replies_are_read_or_refused(spark):
    replies = {
        "bare": good(), "fenced": f"```json\n{good()}\n```", "none": None, "prose": "I think it is fine", "more": good() + " {}",
        "other": good(category="x"), "sure": good(confidence=2), "unsure": good(confidence=None), "severe": good(severity=-0.1),
        "empty": good(translation=" "), "words": good(confidence="high"), "list": json.dumps([1]),
    }
    rows = classify.classify_comments(answers(spark, [*replies, "", None]), saying(replies)).collect()
    assert {r.comment: r.problem for r in rows} == {
        "bare": None, "fenced": None, "none": "no reply", "prose": "unreadable", "more": "unreadable", "other": "unknown category",
        "sure": "confidence", "unsure": "confidence", "severe": "severity", "empty": "no text", "words": "confidence", "list": "unreadable",
    }
    assert [(r.category, r.confidence, r.severity, r.translation) for r in rows if r.problem is None] == [(ONE, 0.5, 1.0, "fine")] * 2


def test_a_refused_survey_leaves_the_refused_table_once_it_is_accepted(spark, tmp_path):
    path, other = str(tmp_path / "classified"), str(tmp_path / "refused")
    as_of, texts = DAY + dt.timedelta(1), ["first", "second"]
    run = lambda replies: classify.classify_day(spark, path, other, answers(spark, texts), saying(replies), as_of=as_of)
    stored = lambda p: sorted(r.comment for r in spark.read.parquet(p).collect())
    run({"first": good(), "second": "no"})
    assert (stored(path), stored(other)) == (["first"], ["second"])
    run({"first": "no", "second": good()})  # what is accepted once stays
    assert (stored(path), stored(other)) == (["first", "second"], [])


def test_triage_reads_the_classification(spark):
    texts = ["broken lens in the box"] * 3 + ["all fine here"] * 2
    replies = {"broken lens in the box": good(severity=0.1, translation="damaged lens in the box"), "all fine here": good(severity=0.1, confidence=0.9, translation="all fine here")}
    rows = classify.for_triage(classify.accepted(classify.classify_comments(answers(spark, texts), saying(replies))))
    routed = {r.volume: (r.route, r.reason, r.mean_confidence) for r in job.run(rows).routed.collect()}
    assert routed == {3: ("review", "critical signal", 0.5), 2: ("review", "new pattern", 0.9)}


@pytest.mark.parametrize(
    "text, found",
    [
        ("They were DAMAGED, on arrival!", ["damag*"]), ("una fraude legal", ["fraud*", "legal"]), ("I returned it", ["return*"]),
        ("legal\n action now", ["legal", "legal act*"]), ("illegal, paralegals", []), ("safe", []), ("safety.", ["safety"]), (None, []), ("", []),
        ("un returned", ["return*"]), ("legal legal", ["legal"]), ("legal, act", ["legal", "legal act*"]),
    ],
)
def test_signals(spark, text, found):
    df = spark.createDataFrame([(1, text)], "survey_id long, text string")
    assert signal_hits(df, ("damag*", "fraud*", "legal", "return*", "legal act*", "safety")).first()["signals"] == found


def test_thousands_of_signals_in_one_pass(spark):
    signals = [f"w{i}x*" if i % 3 else f"w{i}x end" for i in range(6000)]
    df = spark.createDataFrame([(1, " ".join(f"w{i}xy" for i in range(6000))), (2, "w0x end w3x ending")], "survey_id long, text string")
    got = {r.survey_id: r.signals for r in signal_hits(df, signals).collect()}
    assert got == {1: sorted(s for i, s in enumerate(signals) if i % 3), 2: ["w0x end"]}
    assert signal_hits(df, ()).first()["signals"] == []
    with pytest.raises(ValueError):
        signal_hits(df, (" * ",))


def test_signals_make_a_survey_critical(spark):
    df = spark.createDataFrame([(1, "en", 0.0, "was damaged"), (2, "fr", 0.0, "ok"), (3, "en", None, "safety")], "survey_id long, lang string, severity double, text string")
    got = {r.survey_id: (r.hits, r.is_critical) for r in triage.critical_signals(df, signals=Settings().critical_signals).collect()}
    assert got == {1: (1, True), 2: (0, False), 3: (1, True)}


@pytest.mark.parametrize("per_day", [1, 7, 50, 1000])
def test_qa_sample_of_a_fixed_size(spark, per_day):
    rows = []
    for d in range(3):
        for i in range(40 * (d + 1)):
            route = "review" if i % 4 == 0 else "archive" if i % 4 == 1 else "auto_ticket"
            rows.append((1000 * d + i, DAY + dt.timedelta(d), route, "abc"[i % 7 % 3], None if i % 5 == 0 else "en"))
    df = spark.createDataFrame(rows, "survey_id long, day date, route string, category string, lang string")
    got = quality.qa_sample_fixed(df, per_day).collect()
    unseen = Counter(r[1] for r in rows if r[2] != "review")
    assert Counter(r.day for r in got) == {d: min(per_day, n) for d, n in unseen.items()}
    assert len({r.survey_id for r in got}) == len(got) and all(r.route != "review" for r in got)
    drawn, sizes = Counter(tuple(r)[1:] for r in got), Counter(r[1:] for r in rows if r[2] != "review")
    for stratum, n in sizes.items():  # each by its share, to less than one
        assert abs(drawn[stratum] - min(per_day, unseen[stratum[0]]) * n / unseen[stratum[0]]) < 1
    assert {r.survey_id for r in quality.qa_sample_fixed(df.repartition(5), per_day).collect()} == {r.survey_id for r in got}


def test_a_reply_is_read_once_however_often_it_is_asked_about(spark):
    """A filter on what was read must not read the reply again for each field and each use."""
    rows = classify.classify_comments(answers(spark, ["bare"]), saying({"bare": good()}))
    for part in (classify.accepted(rows), classify.refused(rows)):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == plan.count("regexp_extract") == 1
