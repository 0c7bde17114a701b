"""Cases that are not handled within the time their severity allows, as a stream.

The keyed state holds what is known of a case: when it was opened and how severe it is, or that it was handled before its opening
arrived. Handling in time removes the case; if the watermark passes the deadline first, the case is given out and removed.
A call to the state store costs far more than a case, so cases share buckets by the hash of their id: a bucket is
read and written once per batch, and one timer in event time stands at the first deadline in it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from surveyloom.session import ship_package
from surveyloom.settings import SlaRule

#: One array a field, with an entry for each case of the bucket. `expires` is where its timer would stand, `timer` where that of the bucket does.
STATE = (
    "case_id array<string>, opened array<long>, deadline array<long>, band array<string>, owner array<string>, handled array<long>,"
    " expires array<long>, timer long"
)
OUTPUT = "case_id string, band string, deadline timestamp, escalate_to string"
BUCKETS = 1024


class DeadlineTimers(StatefulProcessor):
    """One bucket of cases a key. Times are microseconds since 1970, those of timers milliseconds."""

    def __init__(self, rules: Sequence[SlaRule], keep_ms: int):
        self.rules = sorted(rules, key=lambda r: r.min_severity)
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("cases", STATE)

    def rule(self, severity: float | None) -> SlaRule | None:
        """The rule of the highest bar that the severity reaches; the strictest where it is unknown."""
        if severity is None or pd.isna(severity):
            return self.rules[-1]
        return next((r for r in reversed(self.rules) if severity >= r.min_severity), None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        cases, timer = self.read()
        touched = {}  # each case of this batch, and where its timer stood
        for frame in rows:
            frame = frame[frame["at"].notna()]
            ids = (x if isinstance(x, str) else None for x in frame["case_id"])
            for case, at, severity, is_opening in zip(ids, frame["at"].astype("int64").tolist(), frame["severity"].tolist(), frame["is_opening"].tolist()):
                opened, deadline, band, owner, handled, expires = cases.get(case, (None,) * 6)
                touched.setdefault(case, (opened, expires))
                if not is_opening:
                    handled = at if handled is None else min(handled, at)
                elif opened is None and (rule := self.rule(severity)) is not None:
                    opened, band, owner = at, rule.band, rule.second_owner
                    deadline = at + rule.hours * 3_600_000_000
                cases[case] = (opened, deadline, band, owner, handled, expires)
        for case, (before, expires) in touched.items():
            opened, deadline, band, owner, handled, _ = cases[case]
            if opened is not None and handled is not None and opened <= handled <= deadline:
                del cases[case]
            elif opened is not None:
                if handled is not None and handled > deadline:
                    handled = None
                cases[case] = (opened, deadline, band, owner, handled, deadline // 1000 if before is None else expires)
            elif handled is not None:  # the opening may still come; longer than the watermark's delay it can't be late
                cases[case] = (None, None, None, None, handled, handled // 1000 + self.keep_ms if expires is None else expires)
            else:
                del cases[case]
        if touched:
            self.write(cases, timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        cases, _ = self.read()
        now = timerValues.getCurrentWatermarkInMs()
        due = {case: x for case, x in cases.items() if x[5] < now}
        self.write({case: x for case, x in cases.items() if case not in due}, None)  # Spark deletes the timer that has expired
        missed = [(case, x[2], x[1], x[3]) for case, x in due.items() if x[0] is not None]
        if missed:
            ids, bands, deadlines, owners = zip(*missed)
            moments = pd.to_datetime(np.array(deadlines, np.int64), unit="us", utc=True)
            yield pd.DataFrame({"case_id": ids, "band": bands, "deadline": moments, "escalate_to": owners})

    def read(self) -> tuple[dict, int | None]:
        """The cases of the bucket, and where its timer stands."""
        state = self.bucket.get()
        if state is None:
            return {}, None
        ids, *fields, timer = state
        return dict(zip(ids, zip(*fields))), timer

    def write(self, cases: dict, timer: int | None) -> None:
        """Keep these cases, and move the timer to the first that expires."""
        first = min((x[5] for x in cases.values()), default=None)
        if timer != first:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        if cases:
            self.bucket.update((list(cases), *map(list, zip(*cases.values())), first))
        else:
            self.bucket.clear()

    def close(self) -> None:
        pass


def missed_deadlines(
    opened: DataFrame, handled: DataFrame, rules: Sequence[SlaRule], delay: str = "1 hour", buckets: int = BUCKETS
) -> DataFrame:
    """`case_id`, `band`, `deadline` and `escalate_to` of each case that runs out of time.

    `opened` has case_id, ts and severity, `handled` has case_id and ts. A case handled later is reported too; a handling before
    the opening does not count. A case of unknown severity falls under the strictest rule, one below all bars under none. The first opening of a
    case counts. A handling that arrives before its opening waits for it as long as the longest rule and an hour.

    A batch reads and writes all open cases of the buckets it touches; `buckets` that hold some thousands each suit. Like the
    number of state partitions, it must stay what the stream was first started with.
    """
    ship_package(opened.sparkSession)
    case = F.col("case_id").cast("string").alias("case_id")
    opening = opened.select(case, "ts", F.col("severity").cast("double").alias("severity"), F.lit(True).alias("is_opening"))
    closing = handled.select(case, "ts", F.lit(None).cast("double").alias("severity"), F.lit(False).alias("is_opening"))
    rows = opening.withWatermark("ts", delay).unionByName(closing.withWatermark("ts", delay))
    keep = (max((r.hours for r in rules), default=0) + 1) * 3_600_000
    placed = rows.withColumns({"at": F.unix_micros("ts"), "bucket": F.pmod(F.xxhash64("case_id"), F.lit(buckets))})
    return placed.groupBy("bucket").transformWithStateInPandas(DeadlineTimers(rules, keep), outputStructType=OUTPUT, outputMode="append", timeMode="eventTime")
