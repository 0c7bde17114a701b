"""Column expressions on free text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyloom.settings import MIN_TOKEN_LENGTH, TOKEN_SYMBOLS


def fuse_text(*cols: Column) -> Column:
    """Concatenate nullable texts with no separator; a null part counts as empty."""
    return F.concat(*[F.coalesce(c, F.lit("")) for c in cols])


def has_text(col: Column, trim: bool = False) -> Column:
    """Only the empty string is "no text"; with `trim`, a text of blanks is none either."""
    return (F.trim(col) if trim else col) != ""


def prefix_label(col: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the first rule whose prefix matches, else null."""
    if not rules:
        return F.lit(None).cast("string")
    label = None
    for prefix, name in rules:
        test = col.startswith(prefix)
        label = F.when(test, name) if label is None else label.when(test, name)
    return label


def clean_token(col: Column) -> Column:
    """Delete the punctuation marks that word rows strip; other symbols stay."""
    return F.translate(col, TOKEN_SYMBOLS, "")


def words_of(col: Column) -> Column:
    """Raw tokens: cut at each single blank. Tabs and line ends stay inside a token."""
    return F.split(col, " ", -1)


def token_set(col: Column, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    """Distinct cleaned, lower-cased words of a text, as an array."""
    words = words_of(F.lower(clean_token(col)))
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= min_length))


def keyword_hits(tokens: Column, lang: Column, keywords: dict[str, Iterable[str]]) -> Column:
    """Words of `tokens` that are on the keyword list of the row's language."""
    empty = F.array().cast("array<string>")
    hits = None
    for code, words in keywords.items():
        found = F.array_intersect(tokens, F.array(*[F.lit(w) for w in words]))
        hits = F.when(lang == code, found) if hits is None else hits.when(lang == code, found)
    return empty if hits is None else F.coalesce(hits.otherwise(empty), empty)
