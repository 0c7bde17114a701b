"""Streams over several files against the batch results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from surveyloom.operators.quality import window_volume
from surveyloom.settings import SlaRule
from surveyloom.streaming import deadlines, jobs

T0 = dt.datetime(2025, 1, 1)
SCHEMA = "survey_h_hid string, ts timestamp, category string, value double"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def feed(spark, tmp_path, *files, schema=SCHEMA):
    """A stream that takes the given files one by one, in order."""
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/f{i}"))
        for part in (tmp_path / f"in/f{i}").glob("*.parquet"):
            import os

            os.utime(part, (1_700_000_000 + i * 60,) * 2)
    names = str(tmp_path / "in/*")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(names)


def run(query):
    query.awaitTermination()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_repeats_within_the_delay_drop(spark, tmp_path):
    stream = feed(spark, tmp_path, [("a", at(0), "c", 1.0), ("b", at(1), "c", 1.0)], [("a", at(2), "c", 1.0), ("c", at(3), "c", 1.0)])
    run(jobs.start_table(jobs.arrivals(stream), str(tmp_path / "out"), str(tmp_path / "cp")))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.survey_h_hid for r in out.collect()) == ["a", "b", "c"]


def test_window_volume_equals_batch_without_the_late_rows(spark, tmp_path):
    first = [("a", at(0.1), "c", 1.0), ("b", at(0.2), "d", 2.0), ("c", at(9), "c", 4.0)]
    more = [("x", at(9), "d", 64.0)]
    late = [("d", at(0.5), "c", 8.0)]  # rows are cut by the watermark of the batch before
    last = [("e", at(9.5), "c", 16.0), ("f", at(30), "c", 32.0)]
    stream = feed(spark, tmp_path, first, more, late, last)
    run(jobs.start_table(jobs.stream_volume(stream), str(tmp_path / "out"), str(tmp_path / "cp")))
    batch = window_volume(spark.createDataFrame(first + more + last, SCHEMA)).filter(F.col("window_start") < F.lit(at(27)))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(batch)


def test_cluster_deltas_equal_batch_and_survive_a_replay(spark, tmp_path):
    schema = "cluster_id long, ts timestamp, confidence double, severity double"
    files = [[(1, at(0), 0.5, 0.1), (2, at(1), 0.7, 0.2)], [(1, at(2), 0.9, 0.8)]]
    path = str(tmp_path / "out")
    for run_no in ("a", "b"):  # a lost checkpoint replays every batch
        stream = feed(spark, tmp_path / run_no, *files, schema=schema)
        run(jobs.start_deltas(stream, jobs.fold_clusters, path, str(tmp_path / f"cp-{run_no}")))
        assert rows(jobs.current_clusters(spark, path)) == [(1, 2, 0.7, 0.8, at(0), at(2)), (2, 1, 0.7, 0.2, at(1), at(1))]


def test_upsert_keeps_the_latest(spark, tmp_path):
    stream = feed(spark, tmp_path, [("a", at(0), "c", 1.0), ("a", at(3), "d", 2.0), ("b", at(0), "c", 1.0)], [("b", at(5), "e", 9.0)])
    run(jobs.start_upsert(stream, ["survey_h_hid"], "ts", str(tmp_path / "out"), str(tmp_path / "cp")))
    out = spark.read.parquet(str(tmp_path / "out")).select("survey_h_hid", "ts", "category", "value")
    assert rows(out) == [("a", at(3), "d", 2.0), ("b", at(5), "e", 9.0)]


def test_upsert_ignores_late_files(spark, tmp_path):
    stream = feed(spark, tmp_path, [("a", at(9), "c", 1.0)], [("a", at(3), "d", 2.0), ("b", at(4), "c", 1.0)], [("b", at(2), "e", 9.0)])
    run(jobs.start_upsert(stream, ["survey_h_hid"], "ts", str(tmp_path / "out"), str(tmp_path / "cp")))
    out = spark.read.parquet(str(tmp_path / "out")).select("survey_h_hid", "ts")
    assert rows(out) == [("a", at(9)), ("b", at(4))]


def test_deadlines(spark, tmp_path):
    rules = (SlaRule("high", 0.8, 4, "boss"), SlaRule("low", 0.0, 10, "lead"))
    opened = [
        [("quick", at(0), 0.9), ("slow", at(0), 0.9), ("unknown", at(0), None), ("never", at(0), 0.1), ("low in time", at(0), 0.1)],
        [("tick high", at(50), 0.9), ("tick low", at(50), 0.1)],
        [("tick high 2", at(51), 0.9), ("tick low 2", at(51), 0.1)],
    ]
    handled = [[("quick", at(4)), ("slow", at(5)), ("low in time", at(9))], [("other", at(50))], [("other", at(51))]]
    streams = [
        feed(spark, tmp_path / "opened", *opened, schema="case_id string, ts timestamp, severity double"),
        feed(spark, tmp_path / "handled", *handled, schema="case_id string, ts timestamp"),
    ]
    missed = deadlines.missed_deadlines(*streams, rules)
    query = jobs.start_table(missed, str(tmp_path / "out"), str(tmp_path / "cp"), 2, timers=True)
    run(query)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("never", "low", at(10), "lead"), ("slow", "high", at(4), "boss"), ("unknown", "high", at(4), "boss")]
    sizes = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(sizes) > sizes[-1]  # cases that were handled or given out are gone


def test_a_case_handled_before_it_arrives_and_one_opened_twice(spark, tmp_path):
    rules = (SlaRule("high", 0.8, 4, "boss"), SlaRule("low", 0.2, 10, "lead"))
    opened = [[("a", at(0), 0.9)], [("b", at(1), 0.9), ("c", at(1), 0.9), ("c", at(2), 0.3), ("early", at(3), 0.9), ("below", at(1), 0.1)], [("tick", at(60), 0.9)], [("tock", at(61), 0.9)]]
    handled = [[("b", at(2)), ("early", at(1))], [("a", at(9))], [("tick", at(60))], [("tock", at(61))]]
    streams = [
        feed(spark, tmp_path / "opened", *opened, schema="case_id string, ts timestamp, severity double"),
        feed(spark, tmp_path / "handled", *handled, schema="case_id string, ts timestamp"),
    ]
    missed = deadlines.missed_deadlines(*streams, rules)
    run(jobs.start_table(missed, str(tmp_path / "out"), str(tmp_path / "cp"), 2, timers=True))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [("a", "high", at(4), "boss"), ("c", "high", at(5), "boss"), ("early", "high", at(7), "boss")]


def test_cases_share_a_row_of_state_and_none_is_lost(spark, tmp_path):
    rules = (SlaRule("high", 0.8, 4, "boss"), SlaRule("low", 0.0, 10, "lead"))
    case = lambda i: (f"case {i}", at(i % 7), 0.9 if i % 3 else 0.1)
    end = [[(f"tick {i}", at(50 + i), 0.9)] for i in range(2)]
    opened = [[case(i) for i in range(200)], [case(i) for i in range(200, 400)], *end]
    done = {i: i % 7 + i % 13 for i in range(400) if i % 5}  # the hour in which a case is handled
    handled = [[(f"case {i}", at(h)) for i, h in done.items() if i % 2 == batch] for batch in range(2)] + [[row[:2] for row in rows] for rows in end]
    streams = [
        feed(spark, tmp_path / "opened", *opened, schema="case_id string, ts timestamp, severity double"),
        feed(spark, tmp_path / "handled", *handled, schema="case_id string, ts timestamp"),
    ]
    missed = deadlines.missed_deadlines(*streams, rules, delay="12 hours")
    query = jobs.start_table(missed, str(tmp_path / "out"), str(tmp_path / "cp"), 2, timers=True)
    run(query)
    want = []
    for i in range(400):
        band, hours, owner = ("high", 4, "boss") if i % 3 else ("low", 10, "lead")
        if i not in done or done[i] - i % 7 > hours:
            want.append((f"case {i}", band, at(i % 7 + hours), owner))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == sorted(want, key=str)
    counts = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]

    few = deadlines.missed_deadlines(*streams, rules, delay="12 hours", buckets=3)
    query = jobs.start_table(few, str(tmp_path / "few"), str(tmp_path / "cp-few"), 2, timers=True)
    run(query)
    assert rows(spark.read.parquet(str(tmp_path / "few"))) == sorted(want, key=str)
    assert 0 < max(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators) < max(counts) / 20
