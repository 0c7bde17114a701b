"""Triage by exception, from classified surveys to routed clusters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.operators import similarity, triage
from surveyloom.session import materialise
from surveyloom.settings import Settings
from surveyloom.sources.patterns import append_patterns, similar_patterns


@dataclass(frozen=True)
class Triage:
    """The tables a run leaves: who is in which cluster, the surveys' word sets, routed clusters."""

    members: DataFrame
    sets: DataFrame
    routed: DataFrame


def run(surveys: DataFrame, history: str | None = None, settings: Settings = Settings()) -> Triage:
    """Cluster, score and route surveys.

    `surveys` have survey_id, arrived, lang, category, confidence, severity and text. `history` is the folder of the index of
    known patterns, as `remember` keeps it; without one, or before its first batch, every cluster is new.
    Settings without critical keywords turn the signals off, too.
    """
    rule = settings.similarity
    sets = materialise(similarity.word_sets(surveys), "words")
    sketched = materialise(similarity.sketches(sets, rule), "sketches")
    links = similarity.similar_links(sets, sketched, rule)
    members = materialise(similarity.cluster_members(surveys, links), "members")
    signals = settings.critical_signals if settings.critical_keywords else ()
    signalled = triage.critical_signals(
        surveys, settings.critical_keywords, settings.routing.critical_severity, signals
    )
    profiles = triage.cluster_profile(members, signalled)
    found = similar_patterns(surveys.sparkSession, history, sets, rule) if history else None
    seen = members.limit(0) if found is None else found
    scored = triage.with_score(triage.with_novelty(profiles, members, seen), settings.routing)
    routed = materialise(triage.route_clusters(scored, settings.routing), "routed")
    return Triage(members, sets, routed)


def remember(spark: SparkSession, history: str, done: Triage, batch: int, settings: Settings = Settings()) -> None:
    """Add the examples of a run's clusters to the index of known patterns, as one batch."""
    examples = done.routed.select(F.col("example_id").alias("survey_id"))
    append_patterns(spark, history, done.sets.join(examples, "survey_id", "left_semi"), batch, settings.similarity)
