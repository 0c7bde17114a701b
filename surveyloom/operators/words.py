"""Word rows for word clouds."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.text import clean_token, words_of
from surveyloom.settings import MIN_TOKEN_LENGTH


def explode_words(
    df: DataFrame, text_col: str = "comment", keep: Sequence[str] = (), min_length: int = MIN_TOKEN_LENGTH
) -> DataFrame:
    """One row per occurrence of a word: cleaned, long enough, lower case.

    The symbols are stripped from the whole text before it is cut, which gives the same
    words; the length is taken after that. A null text gives no rows.
    """
    words = df.select(*keep, F.explode(words_of(clean_token(F.col(text_col)))).alias("word"))
    return words.filter(F.length("word") >= min_length).withColumn("word", F.lower("word"))


def remove_stopwords(df: DataFrame, stopwords: Iterable[str] | DataFrame, word_col: str = "word") -> DataFrame:
    """Drop listed words. A word list becomes a hash-set test inside the scan stage; a
    table of words (one column) is anti-joined."""
    if isinstance(stopwords, DataFrame):
        listed = stopwords.select(F.lower(F.col(stopwords.columns[0])).alias("_stop")).distinct()
        return df.join(listed, df[word_col] == listed["_stop"], "left_anti")
    words = sorted({w.lower() for w in stopwords})
    return df.filter(~F.col(word_col).isin(words)) if words else df
