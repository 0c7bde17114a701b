"""Triage by exception: signals, cluster scores, routes, review, tickets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.text import keyword_hits, token_set
from surveyloom.operators.ranking import ranked
from surveyloom.operators.signals import signal_hits
from surveyloom.settings import CRITICAL_KEYWORDS, Routing, SlaRule

AUTO, REVIEW, ARCHIVE = "auto_ticket", "review", "archive"


def critical_signals(
    surveys: DataFrame,
    keywords: dict[str, Iterable[str]] = CRITICAL_KEYWORDS,
    critical_severity: float = Routing().critical_severity,
    signals: Sequence[str] = (),
    text_col: str = "text",
) -> DataFrame:
    """Add `hits`, the number of high-risk words of the row's language and of `signals` of any, and `is_critical`.

    For `signals` see `signal_hits`; they are looked for in `text_col`, such as a translation.
    """
    words = keyword_hits(token_set(F.col("text")), F.col("lang"), keywords)
    found = signal_hits(surveys, signals, text_col, "_signals") if signals else surveys
    hits = F.size(F.array_union(words, F.col("_signals"))) if signals else F.size(words)
    severe = F.coalesce(F.col("severity") >= critical_severity, F.lit(False))
    return found.withColumn("hits", hits).withColumn("is_critical", (F.col("hits") > 0) | severe).drop("_signals")


def cluster_profile(members: DataFrame, surveys: DataFrame) -> DataFrame:
    """One row per cluster: volume, mean confidence, worst severity, critical or not, the
    first day, and the most severe survey as its example (the smallest id among equals)."""
    rows = members.join(surveys, "survey_id")
    example = F.min(F.struct((-F.col("severity")).alias("_s"), "survey_id"))
    return (
        rows.groupBy("cluster_id")
        .agg(
            F.min("category").alias("category"),
            F.count("*").alias("volume"),
            F.round(F.avg("confidence"), 6).alias("mean_confidence"),
            F.max("severity").alias("severity"),
            F.bool_or("is_critical").alias("is_critical"),
            F.min("arrived").alias("first_day"),
            example.alias("_example"),
        )
        .withColumn("example_id", F.col("_example.survey_id"))
        .drop("_example")
    )


def with_novelty(profiles: DataFrame, members: DataFrame, seen: DataFrame) -> DataFrame:
    """Add `is_new`: no member of the cluster is among `seen`, the surveys (`survey_id`) that are similar to a known pattern."""
    clusters = members.join(seen.select("survey_id").distinct(), "survey_id", "left_semi").select("cluster_id").distinct()
    hit = clusters.withColumn("_seen", F.lit(True))
    return profiles.join(hit, "cluster_id", "left").withColumn("is_new", F.col("_seen").isNull()).drop("_seen")


def with_score(profiles: DataFrame, rule: Routing = Routing()) -> DataFrame:
    """Add `score`, a weighted sum of volume, uncertainty, severity and novelty, in 0..1."""
    volume, doubt, severity, novelty = rule.weights
    share = F.least(F.col("volume") / rule.volume_reference, F.lit(1.0))
    total = (
        share * volume
        + (1 - F.col("mean_confidence")) * doubt
        + F.col("severity") * severity
        + F.when(F.col("is_new"), novelty).otherwise(0.0)
    )
    return profiles.withColumn("score", F.round(total, 4))


def route_clusters(scored: DataFrame, rule: Routing = Routing()) -> DataFrame:
    """Add `route`, `reason` and `rules_version`. The first rule that holds decides.

    A critical signal always goes to review. A cluster that is small and harmless is
    archived. A new pattern or a doubtful classification goes to review; the rest becomes
    a ticket.
    """
    rules = [
        (F.col("is_critical"), REVIEW, "critical signal"),
        (F.col("volume") < rule.min_volume, ARCHIVE, "low volume"),
        (F.col("is_new"), REVIEW, "new pattern"),
        (F.col("mean_confidence") < rule.min_confidence, REVIEW, "low confidence"),
    ]
    route, reason = F.lit(AUTO), F.lit("confident known pattern")
    for test, to, why in reversed(rules):
        route, reason = F.when(test, to).otherwise(route), F.when(test, why).otherwise(reason)
    return scored.withColumns({"route": route, "reason": reason, "rules_version": F.lit(rule.version)})


def review_queue(routed: DataFrame, surveys: DataFrame) -> DataFrame:
    """Clusters that wait for a reviewer, worst first, each with one example text."""
    queue = routed.filter(F.col("route") == REVIEW)
    texts = surveys.select(F.col("survey_id").alias("example_id"), F.col("text").alias("example_text"))
    return (
        queue.join(texts, "example_id", "left")
        .select("cluster_id", "category", "volume", "severity", "score", "reason", "example_id", "example_text")
        .orderBy(F.desc("severity"), F.desc("score"), "cluster_id")
    )


def apply_decisions(routed: DataFrame, decisions: DataFrame) -> DataFrame:
    """Add the latest decision on each cluster and what holds after all of them.

    `decisions` is append-only: cluster_id, reviewer, decided_at, action, new_category, and
    optionally new_priority. The latest action counts, and the latest category and priority
    that any decision set: an approval keeps an earlier correction. `corrected` is true if
    any decision was a correction. `outcome` is `ticket` for clusters routed or approved to a ticket, `discarded`,
    `archived`, or `waiting` for review.
    """
    row = F.struct("decided_at", "reviewer", "action", "new_category")
    last_set = lambda name: F.max(F.when(F.col(name).isNotNull(), F.struct("decided_at", "reviewer", name)))[name]
    priority = last_set("new_priority") if "new_priority" in decisions.columns else F.max(F.lit(None).cast("string"))
    last = decisions.groupBy("cluster_id").agg(
        F.max(row).alias("_d"),
        last_set("new_category").alias("_category"),
        priority.alias("_priority"),
        F.bool_or(F.col("action") == "correct").alias("_corrected"),
    )
    joined = routed.join(last, "cluster_id", "left")
    action = F.col("_d.action")
    outcome = (
        F.when(action == "discard", "discarded")
        .when(action.isin("approve", "correct"), "ticket")
        .when(F.col("route") == AUTO, "ticket")
        .when(F.col("route") == ARCHIVE, "archived")
        .otherwise("waiting")
    )
    return joined.select(
        *routed.columns,
        action.alias("action"),
        F.col("_d.reviewer").alias("reviewer"),
        F.col("_d.decided_at").alias("decided_at"),
        F.coalesce(F.col("_category"), F.col("category")).alias("final_category"),
        F.col("_priority").alias("priority"),
        F.coalesce(F.col("_corrected"), F.lit(False)).alias("corrected"),
        outcome.alias("outcome"),
    )


def ticket_rows(decided: DataFrame, members: DataFrame, max_size: int = Routing().max_ticket_size) -> DataFrame:
    """One ticket per cluster, or several for a large one, with references to its surveys.

    A ticket holds at most `max_size` surveys, so the list of a ticket is bounded however
    large the cluster.
    """
    tickets = decided.filter(F.col("outcome") == "ticket").select("cluster_id", "final_category")
    chosen = members.join(tickets, "cluster_id")
    numbered = ranked(chosen, ["cluster_id"], "survey_id")
    part = F.floor((F.col("rank") - 1) / max_size).cast("bigint")
    return (
        numbered.withColumn("part", part)
        .groupBy("cluster_id", "part")
        .agg(
            F.min("final_category").alias("category"),
            F.count("*").alias("survey_count"),
            F.concat_ws(",", F.array_sort(F.collect_list("survey_id")).cast("array<string>")).alias("survey_ids"),
        )
        .withColumn("ticket_id", F.concat_ws("-", F.col("cluster_id").cast("string"), F.col("part").cast("string")))
    )


def sla_state(
    cases: DataFrame, rules: Sequence[SlaRule], as_of: dt.datetime | None = None
) -> DataFrame:
    """Add band, deadline, `breached` and `escalate_to` to cases.

    Cases have `severity`, `opened_at` and `handled_at`, null while open. An open case is
    breached once `as_of` (in the session's time zone, unless it names its own) is past its
    deadline. The rule with the highest bar that a case reaches counts; a case of unknown
    severity falls under the strictest, so that it can't be forgotten.
    """
    moment = cases.schema["opened_at"].dataType
    now = (F.current_timestamp() if as_of is None else F.lit(as_of.isoformat(" "))).cast(moment)
    band, hours, owner = F.lit(None), F.lit(None).cast("int"), F.lit(None)
    for rule in sorted(rules, key=lambda r: r.min_severity):
        here = F.coalesce(F.col("severity") >= rule.min_severity, F.lit(True))
        band = F.when(here, rule.band).otherwise(band)
        hours = F.when(here, rule.hours).otherwise(hours)
        owner = F.when(here, rule.second_owner).otherwise(owner)
    judged = cases.withColumns({"band": band, "_hours": hours, "_owner": owner})
    deadline = F.col("opened_at") + F.make_dt_interval(hours=F.col("_hours"))
    timed = judged.withColumn("deadline", deadline)
    late = F.coalesce(F.col("handled_at"), now) > F.col("deadline")
    return (
        timed.withColumn("breached", F.coalesce(late, F.lit(False)))
        .withColumn("escalate_to", F.when(F.col("breached"), F.col("_owner")))
        .drop("_hours", "_owner")
    )
