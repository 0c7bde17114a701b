import datetime as dt

import pytest
from pyspark.sql import functions as F

from surveyloom.functions import codes, dates, replies, text
from surveyloom.settings import Settings

c = F.col
FOUR = "a string, b string, c string, d string"


@pytest.mark.parametrize(
    "parts, expected",
    [(("good", None, "fit", None), "goodfit"), ((None,) * 4, ""), (("  ", None, None, None), "  ")],
)
def test_fused_text_has_no_separator(one, parts, expected):
    assert one(text.fuse_text(*[c(x) for x in "abcd"]), FOUR, *parts) == expected


def test_blanks_count_as_text_unless_trimmed(one):
    assert one(text.has_text(c("x")), "x string", "  ") is True
    assert one(text.has_text(c("x"), trim=True), "x string", "  ") is False
    assert one(text.has_text(c("x")), "x string", "") is False


def test_first_matching_prefix_wins(one):
    rules = (("ab", "first"), ("a", "second"))
    assert one(text.prefix_label(c("x"), rules), "x string", "abc") == "first"
    assert one(text.prefix_label(c("x"), rules), "x string", "axc") == "second"
    assert one(text.prefix_label(c("x"), rules), "x string", "xa") is None
    assert one(text.prefix_label(c("x"), ()), "x string", "abc") is None


@pytest.mark.parametrize(
    "scores, loose, strict",
    [
        (("1", None, None, "0"), "10", None),
        (("9", "9", None, None), None, None),
        ((None,) * 4, None, None),
        (("11", None, None, None), None, None),
        ((None, "7", None, None), "7", "7"),
    ],
)
def test_scores_unify(one, scores, loose, strict):
    cols = [c(x) for x in "abcd"]
    assert one(codes.unify_score(*cols), FOUR, *scores) == loose
    assert one(codes.unify_score(*cols, strict=True), FOUR, *scores) == strict


def test_channel_and_flags(one):
    assert one(codes.channel_of(c("x")), "x string", None) == "Brick and Mortar"
    assert one(codes.channel_of(c("x")), "x string", "Internet") == "E-commerce"
    flags = "a boolean, b boolean, c boolean"
    assert one(codes.any_flag(c("a"), c("b"), c("c")), flags, None, None, None) is False
    assert one(codes.any_flag(c("a"), c("b"), c("c")), flags, None, False, True) is True


@pytest.mark.parametrize(
    "kind, family",
    [("Optical", "NPS"), ("PICKUP_Optical", "NPS"), ("SNOVA_Sun", "Meta NPS"), ("NUANCE_Product", "Nuance CEPS"), (None, "OTHER"), ("x", "OTHER")],
)
def test_family(one, kind, family):
    assert one(codes.family_of(c("x")), "x string", kind) == family


def test_country(one):
    assert one(codes.country_code(c("x")), "x string", "BRLO") == "NA"
    assert one(codes.country_code(c("x")), "x string", "BRIT") == "IT"
    assert one(codes.country_name(c("x"), F.lit("Laos")), "x string", "NA") == "NA"
    assert one(codes.country_region(c("x"), F.lit("ASIA")), "x string", "NA") == "North America"
    split = codes.split_north_america(c("a"), c("b"))
    for place, organisation, expected in [
        ("NA", "CA10", "Canada"), ("NA", "US10", "United States"), ("NA", "MX10", "NA"), ("NA", None, "NA"), ("Italy", "CA10", "Italy"), (None, "CA10", None)
    ]:
        assert one(split, "a string, b string", place, organisation) == expected


def test_brand_name_loses_blanks_only_if_listed(one):
    assert one(codes.without_blanks(c("x"), ("A B C",)), "x string", "A B C") == "ABC"
    assert one(codes.without_blanks(c("x"), ("A B C",)), "x string", "D E") == "D E"


def test_period_key(one):
    key = codes.period_key(c("y"), c("m"), c("a"), c("b"))
    schema = "y string, m string, a string, b string"
    assert one(key, schema, "2025", "3", "A", "BC") == "202503ABC"
    assert one(key, schema, "2025", "3", "A", None) is None


@pytest.mark.parametrize(
    "plus, minus, total, score",
    [(101, 0, 200, 51.0), (0, 0, 0, None), (1, 2, 3, -33.0), (0, 1, 200, -1.0), (1, 0, 8, 13.0)],
)
def test_percent_score_rounds_half_away(one, plus, minus, total, score):
    expr = codes.percent_score(c("p"), c("m"), c("t"))
    assert one(expr, "p long, m long, t long", plus, minus, total) == score


DAY = dt.date(2025, 3, 31)


@pytest.mark.parametrize("moment, inside", [("2025-03-29 23:59:59", False), ("2025-03-30 00:00:00", True), ("2025-03-30 23:59:59", True), ("2025-03-31 00:00:00", False)])
def test_previous_day(one, moment, inside):
    assert one(dates.on_previous_day(c("t"), DAY), "t timestamp", dt.datetime.fromisoformat(moment)) is inside


@pytest.mark.parametrize("day, inside", [("2024-12-31", False), ("2025-01-01", True), ("2025-02-28", True), ("2025-03-01", False)])
def test_previous_months_clamp(one, day, inside):
    """On 31 March the months before are January and February."""
    assert one(dates.in_previous_months(c("d"), DAY), "d date", dt.date.fromisoformat(day)) is inside


def test_previous_months_equal_year_and_month_tests_on_each_day(spark):
    """The range form against the form by parts, for each run date of two years."""
    days = spark.sql("SELECT explode(sequence(DATE'2023-09-01', DATE'2026-01-31')) AS d")
    runs = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2025-12-31')) AS run")
    month = lambda n: (F.year("d") == F.year(F.add_months("run", -n))) & (F.month("d") == F.month(F.add_months("run", -n)))
    by_range = (c("d") >= F.trunc(F.add_months("run", -2), "month")) & (c("d") < F.trunc("run", "month"))
    assert days.join(runs, by_range != (month(1) | month(2))).count() == 0


def test_rolling_years_have_no_upper_bound(one):
    rule = dates.in_rolling_years(c("d"), DAY)
    for day, inside in [("2022-12-31", False), ("2023-01-01", True), ("2031-01-01", True)]:
        assert one(rule, "d date", dt.date.fromisoformat(day)) is inside


def test_dated_rule(one):
    rule = dates.dated_rule(c("d"), dt.date(2026, 1, 1), c("x") == "EXAM NPS", F.lit(True))
    for day, family, inside in [("2025-12-31", "EXAM NPS", True), ("2025-12-31", "NPS", False), ("2026-01-01", "NPS", True)]:
        assert one(rule, "d date, x string", dt.date.fromisoformat(day), family) is inside


REPLIES = {
    "bare": '{"translation": "a b", "Comment Category": "Pricing"}',
    "one line": ' ```json {"translation": "a b", "Comment Category": "Pricing"} ``` ',
    "lines": '```json\n{\n"translation": "a b",\n"Comment Category": "Pricing"\n}\n```',
    "prose": "I would say a b",
    "trailing": '{"translation": "a b", "Comment Category": "Pricing"} as asked',
    "second object": '{"translation": "a b", "Comment Category": "Pricing"} {"note": "y"}',
    "second after a comma": '{"translation": "a b", "Comment Category": "Pricing"}, {"note": "y"}',
    "brackets between": '{"translation": "a b", "Comment Category": "Pricing"}] [{"note": "y"}',
    "prose with a brace": '{"translation": "a b", "Comment Category": "Pricing"} that is all }',
    "object": '{"translation": {"x": 1}, "Comment Category": ["Pricing"]}',
    "null": '{"translation": null, "Comment Category": null}',
    "number": '{"translation": 5, "Comment Category": 5}',
    "braces": '{"translation": "{a} b", "Comment Category": "[x]"}',
    "none": None,
}


@pytest.mark.parametrize(
    "shape, translation, multiline, category",
    [
        ("bare", "a b", "a b", "Pricing"),
        ("one line", "a b", "a b", "Pricing"),
        ("lines", None, "a b", "Pricing"),
        ("prose", None, None, None),
        ("trailing", None, None, None),
        ("second object", None, None, None),
        ("second after a comma", None, None, None),
        ("brackets between", None, None, None),
        ("prose with a brace", None, None, None),
        ("object", None, None, None),
        ("null", None, None, None),
        ("number", "5", "5", "5"),
        ("braces", "{a} b", "{a} b", "[x]"),
        ("none", None, None, None),
    ],
)
def test_replies(one, shape, translation, multiline, category):
    reply = REPLIES[shape]
    assert one(replies.parse_translation(c("x")), "x string", reply) == translation
    assert one(replies.parse_translation(c("x"), multiline=True), "x string", reply) == multiline
    assert one(replies.parse_category(c("x")), "x string", reply) == category


def test_classification_reply(one):
    reply = '```json\n{"category": "Other", "confidence": 0.5, "severity": 1, "translation": "t"}\n```'
    assert one(replies.parse_classification(c("x")), "x string", reply).asDict() == {
        "category": "Other", "confidence": 0.5, "severity": 1.0, "translation": "t"
    }
    assert one(replies.parse_classification(c("x")), "x string", "sorry").category is None
    assert one(replies.parse_classification(c("x")), "x string", '{"category": "Other"} {"note": "y"}').category is None


def test_settings_from_file(tmp_path):
    path = tmp_path / "settings.json"
    path.write_text(
        '{"brand_prefixes": [["AA", "Alpha"], ["AB", "Alpha"]], "stopwords": ["ciao"], "exam_cutover": "2027-01-01",'
        ' "routing": {"version": "v9", "weights": [1, 0, 0, 0]}, "sla": [{"band": "x", "min_severity": 0, "hours": 1, "second_owner": "y"}]}'
    )
    settings = Settings.load(str(path))
    assert settings.translated_banners == ("Alpha",)
    assert settings.exam_cutover == dt.date(2027, 1, 1)
    assert settings.routing.version == "v9" and settings.routing.min_volume == 2
    assert settings.sla[0].hours == 1
    path.write_text('{"colour": 1}')
    with pytest.raises(ValueError, match="colour"):
        Settings.load(str(path))
