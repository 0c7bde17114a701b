"""Kept replies: each prompt is paid for once, over runs, lost tasks and lost runs."""

import os
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from surveyloom.operators import model, replies
from surveyloom.settings import ModelOptions


def counting(log, dies_on=None, refuses=None):
    """A client that notes each prompt that it answers. It ends its worker's task on one prompt, or refuses one."""

    def build():
        def call(prompts, options):
            if dies_on in prompts and not os.path.exists(f"{log}.died"):
                open(f"{log}.died", "w").close()
                raise SystemExit("worker lost")
            if refuses in prompts:
                raise RuntimeError("refused")
            with open(log, "a") as fh:
                fh.write("".join(f"{p}\n" for p in prompts))
            return [f"re {p}" for p in prompts]

        return call

    return build


def asked(log):
    return Counter(open(log).read().split("\n")[:-1]) if os.path.exists(log) else Counter()


def prompts(spark, start, stop):
    return spark.range(start, stop).select("id", F.when(F.col("id") % 10 != 0, F.concat(F.lit("p"), F.col("id") % 50)).alias("prompt"))


def run(df, log, store, **more):
    rows = model.generate_text(df, counting(log, **more), batch_size=2, retries=0, pause=0, tasks=3, store=store, per_file=2).collect()
    return {r.id: (r.prompt, r[model.RESULT], r[model.STATUS]) for r in rows}


def test_two_runs_ask_once(spark, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    first = run(prompts(spark, 0, 40), log, store)
    again = run(prompts(spark, 20, 100), log, store)
    assert len(first) == 40 and len(again) == 80
    for p, reply, status in [*first.values(), *again.values()]:
        assert (reply, status) == ((None, None) if p is None else (f"re {p}", ""))
    assert set(asked(log).values()) == {1} and len(asked(log)) == 45
    assert sorted(d.split("=")[0] for d in os.listdir(store)) == ["batch", "batch"]


def test_a_lost_run_keeps_what_it_got(spark, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    df = prompts(spark, 0, 50)
    with pytest.raises(Exception):
        run(df, log, store, dies_on="p33")
    got = run(df, log, store, dies_on="p33")
    assert all(reply == (p and f"re {p}") for p, reply, _ in got.values())
    count = asked(log)
    assert len(count) == 45 and sum(count.values()) <= 45 + 3 * 4  # two batches of two prompts in each of three tasks
    third = Counter(asked(log))
    run(df, log, store)
    assert asked(log) == third


def test_a_task_that_runs_again_reads_its_own_files(tmp_path):
    frame = pd.DataFrame({"_key": [f"k{i}" for i in range(10)], "_prompt": [f"p{i}" for i in range(10)]})
    seen = []

    def ask(part, dies):
        if dies and "p6" in part:
            raise SystemExit
        seen.extend(part)
        return [f"re {p}" if p != "p1" else None for p in part], ["" if p != "p1" else "refused" for p in part]

    folder = str(tmp_path / "part=0")
    with pytest.raises(SystemExit):
        list(replies.asked_once(iter([frame]), folder, lambda p: ask(p, True), 2, 1))
    failed = pd.concat(replies.asked_once(iter([frame]), folder, lambda p: ask(p, False), 2, 1))
    assert Counter(seen) == {**{f"p{i}": 1 for i in range(10)}, "p1": 2}
    assert failed.values.tolist() == [["k1", "refused"]]


def test_failures_are_told_and_asked_again(spark, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    df = prompts(spark, 0, 30)
    first = run(df, log, store, refuses="p7")
    assert first[7] == ("p7", None, "RuntimeError: refused") and sum(r is None for _, r, _ in first.values()) == 4
    assert run(df, log, store)[7] == ("p7", "re p7", "")
    assert set(asked(log).values()) == {1}


def test_options_are_part_of_the_key(spark, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    df = prompts(spark, 1, 4)
    for t in (0.1, 0.2, 0.1):
        model.generate_text(df, counting(log), ModelOptions(temperature=t), store=store, tasks=2)
    assert set(asked(log).values()) == {2}


def test_nothing_to_ask(spark, tmp_path):
    store = str(tmp_path / "store")
    assert run(prompts(spark, 0, 1), str(tmp_path / "log"), store) == {0: (None, None, None)}
    assert run(prompts(spark, 0, 0), str(tmp_path / "log"), store) == {}
