"""Reading the JSON text that a model returns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fence patterns of a reply, with `.` stopping at line feed only.
BLANKS = r"[\t\n\f\r ]*"
ONE_LINE_FENCE = rf"(?d)^{BLANKS}```json{BLANKS}(.+?){BLANKS}```{BLANKS}$"
ANY_FENCE = rf"(?d)```json{BLANKS}(\{{[\s\S]*?\}}){BLANKS}```"


def extract_or_null(col: Column, pattern: str) -> Column:
    """First group of the pattern, null when it does not match."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, 1))


def _closed(col: Column) -> Column:
    """The text as the first of two elements of a JSON array, null unless it is one JSON value.

    Spark's readers stop at the end of the first value and accept what follows. Here the
    second element is the text's digest: more values, or a bracket in between, displace it.
    """
    pair = F.concat(F.lit("["), col, F.lit(',"'), F.md5(col), F.lit('"]'))
    second = F.try_variant_get(F.try_parse_json(pair), "$[1]", "string")
    return F.when(second == F.md5(col), pair)


def json_scalar(col: Column, key: str) -> Column:
    """Text of a scalar member of a JSON object.

    Null for a missing key, a JSON null, an object or array value, malformed text, and
    an object with more text after it.
    """
    pair, path = _closed(col), f"$[0]['{key}']"
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(pair), path, "variant"))
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(kind.isNotNull() & ~nested, F.get_json_object(pair, path))


def parse_translation(reply: Column, multiline: bool = False) -> Column:
    """Translation out of a bare reply or one fenced on a single line.

    A fence that spans lines gives null; `multiline` reads it as well.
    """
    body = F.coalesce(extract_or_null(reply, ONE_LINE_FENCE), reply)
    value = json_scalar(body, "translation")
    if multiline:
        value = F.coalesce(value, json_scalar(extract_or_null(reply, ANY_FENCE), "translation"))
    return value


def parse_category(reply: Column) -> Column:
    """Category out of a bare reply, else out of a fenced one, on one line or several."""
    key = "Comment Category"
    return F.coalesce(json_scalar(reply, key), json_scalar(extract_or_null(reply, ANY_FENCE), key))


def classification_body(reply: Column) -> Column:
    """What is inside the fence of a reply, else the reply."""
    fenced = F.nullif(F.regexp_extract(reply, ANY_FENCE, 1), F.lit(""))  # a match holds two braces at least
    return F.coalesce(fenced, reply)


def read_classification(body: Column) -> Column:
    """Struct of category, confidence, severity and readable text; null fields if unreadable."""
    schema = "category string, confidence double, severity double, translation string"
    return F.from_json(F.when(_closed(body).isNotNull(), body).otherwise(F.lit("{}")), schema)


def parse_classification(reply: Column) -> Column:
    """Both steps. Each use of a column is evaluated again, so long replies better take them one after the other."""
    return read_classification(classification_body(reply))
