"""Mappings between codes and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyloom import settings as S


def channel_of(col: Column) -> Column:
    """Online or in-store; a null channel counts as in-store."""
    return F.when(col == S.ONLINE_CHANNEL, S.ONLINE_LABEL).otherwise(S.OFFLINE_LABEL)


def family_of(
    col: Column,
    families: Sequence[tuple[str, Sequence[str]]] = S.SURVEY_FAMILIES,
    other: str = S.OTHER_FAMILY,
) -> Column:
    """Survey family of a survey type; unknown and null types fall to `other`."""
    result = F.lit(other)
    for name, types in reversed(list(families)):
        result = F.when(col.isin(*types), name).otherwise(result)
    return result


def country_code(brand_id: Column, na_suffixes: Sequence[str] = S.NA_SUFFIXES) -> Column:
    """The last two characters; some suffixes stand for North America."""
    suffix = F.substring(brand_id, -2, 2)
    return F.when(suffix.isin(*na_suffixes), S.NA_CODE).otherwise(suffix)


def country_name(code: Column, description: Column) -> Column:
    return F.when(code == S.NA_CODE, S.NA_CODE).otherwise(description)


def country_region(code: Column, region: Column) -> Column:
    return F.when(code == S.NA_CODE, S.NA_REGION).otherwise(region)


def split_north_america(country: Column, sales_organization: Column) -> Column:
    """Name the country of a North America row from the sales organisation's prefix."""
    result = country
    for prefix, name in S.NA_COUNTRIES:
        here = (country == S.NA_CODE) & sales_organization.startswith(prefix)
        result = F.when(here, name).otherwise(result)
    return result


def without_blanks(col: Column, names: Sequence[str]) -> Column:
    """Remove the blanks from the listed names only."""
    return F.when(col.isin(*names), F.replace(col, F.lit(" "), F.lit(""))).otherwise(col)


def any_flag(*cols: Column) -> Column:
    """True if any flag is true; null flags count as false."""
    result = F.lit(False)
    for c in cols:
        result = result | F.coalesce(c, F.lit(False))
    return result


def unify_score(*cols: Column, strict: bool = False) -> Column:
    """One score out of several nullable score columns, as text, or null.

    The values are concatenated and then checked against the list of valid scores, so
    two filled columns can read as another score ("1" and "0" give "10"). With `strict`
    only a row with exactly one filled column has a score.
    """
    joined = F.concat(*[F.coalesce(c, F.lit("")) for c in cols])
    valid = joined.isin(*S.VALID_SCORES)
    if strict:
        valid = valid & (sum(c.isNotNull().cast("int") for c in cols) == 1)
    return F.when(valid, joined)


def period_key(year: Column, month: Column, *parts: Column) -> Column:
    """`yyyymm` followed by the parts, no separators; null if any part is null."""
    number = year.cast("bigint") * 100 + month.cast("bigint")
    return F.concat(number.cast("string"), *parts)


def percent_score(plus: Column, minus: Column, total: Column) -> Column:
    """Rounded percentage difference of two counts; null when the total is zero."""
    base = F.nullif(total, F.lit(0))
    return F.round((plus / base - minus / base) * 100)
