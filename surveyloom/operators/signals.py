"""High-risk words, stems and phrases of any language, found in one pass over a text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.text import clean_token


def plain_words(text: Column) -> Column:
    """The text in lower case without the marks that words lose, its words between single blanks, one at each end."""
    folded = F.regexp_replace(F.lower(clean_token(F.coalesce(text, F.lit("")))), r"[\s\u00a0]+", " ")
    return F.concat(F.lit(" "), F.trim(folded), F.lit(" "))


def _needle(signal: str) -> str:
    """What stands in a text of single blanks: a word or phrase as a whole, a stem (ending in *) from its start."""
    stem = signal.endswith("*")
    words = " ".join(signal.removesuffix("*").lower().split())
    return f" {words}" if stem else f" {words} "


def signal_hits(surveys: DataFrame, signals: Sequence[str], text_col: str = "text", name: str = "signals") -> DataFrame:
    """Add the distinct signals that the text holds, sorted.

    A signal is a word (`safety`), a phrase (`legal action`), or either with a last word cut to its stem (`damag*`, `legal
    act*`). All are put into one automaton, built once per task, which reads each text once however many signals there
    are. A null text holds none.
    """
    if not signals:
        return surveys.withColumn(name, F.array().cast("array<string>"))
    needles: dict[str, list[str]] = {}
    for signal in signals:
        if not signal.strip(" *"):
            raise ValueError(f"{signal!r} is no signal")
        needles.setdefault(_needle(signal), []).append(signal)

    @F.pandas_udf("array<string>")
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for needle, names in needles.items():
            automaton.add_word(needle, names)
        automaton.make_automaton()
        for part in texts:
            yield part.map(lambda text: sorted({x for _, names in automaton.iter(text) for x in names}))

    return surveys.withColumn(name, find(plain_words(F.col(text_col))))
