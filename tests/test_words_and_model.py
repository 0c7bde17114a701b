import datetime as dt

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import buckets, model, words
from surveyloom.plans import comments as jobs
from surveyloom.settings import Settings


def cloud(spark, text, **kw):
    df = spark.createDataFrame([("s", text)], "id string, comment string")
    return [r.word for r in words.explode_words(df, keep=("id",), **kw).collect()]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Great, lens (nice)", ["great", "lens", "nice"]),
        ("abc! abcd! abcd", ["abcd", "abcd"]),
        ("ab\ncd", ["ab\ncd"]),
        ("what? 'quoted'", ["what?", "'quoted'"]),
        ("  ", []),
        ("", []),
        (None, []),
        ("glasses.", ["glasses"]),
    ],
)
def test_words(spark, text, expected):
    assert sorted(cloud(spark, text)) == sorted(expected)


def test_stopwords_as_list_and_as_table(spark):
    df = spark.createDataFrame([("your",), ("lens",), ("glasses",)], "word string")
    table = spark.createDataFrame([("YOUR",), ("glasses.",)], "w string")
    for listed in (["Your", "glasses."], table):
        assert sorted(r.word for r in words.remove_stopwords(df, listed).collect()) == ["glasses", "lens"]
    assert words.remove_stopwords(df, []).count() == 3


def test_word_rows_need_no_shuffle(spark):
    df = spark.createDataFrame([("s", dt.datetime(2025, 1, 1), "b", "some words here")], "survey_h_hid string, invitation_date timestamp, banner string, comment string")
    plan = jobs.wordcloud_rows(df, ["some"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("survey_id, bucket", [("S12399", 19), ("S12300", 0), ("S1-5", -1), ("S07", 1)])
def test_bucket(spark, survey_id, bucket):
    df = spark.createDataFrame([(survey_id,)], "survey_id string")
    assert buckets.with_partition_int(df).first().partition_int == bucket


def test_bucket_of_a_bad_suffix(spark):
    df = spark.createDataFrame([("S123x9",)], "survey_id string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        buckets.with_partition_int(df).collect()
    assert buckets.with_partition_int(df, tolerant=True).first().partition_int is None


def counting_client(path, fail_first=0):
    """Writes a line per batch sent, so calls can be counted across processes."""

    def build():
        state = {"calls": 0}

        def call(prompts, options):
            state["calls"] += 1
            with open(path, "a") as fh:
                fh.write(f"{len(prompts)}\n")
            if state["calls"] <= fail_first:
                raise RuntimeError("busy")
            return [f"{p}|{options.temperature}" for p in prompts]

        return call

    return build


def test_equal_prompts_are_sent_once_and_null_never(spark, tmp_path):
    log = tmp_path / "log"
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, prompt string")
    rows = model.generate_text(df, counting_client(str(log)), model.ModelOptions(0.5)).collect()
    assert {r.id: r[model.RESULT] for r in rows} == {1: "a|0.5", 2: "a|0.5", 3: "b|0.5", 4: None}
    assert sum(int(x) for x in log.read_text().split()) == 2


def test_retries_then_gives_up_with_a_status(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, prompt string")
    ok = model.generate_text(df, counting_client(str(tmp_path / "a"), 2), retries=2, pause=0).first()
    assert ok[model.RESULT] == "a|0.2" and ok[model.STATUS] == ""
    lost = model.generate_text(df, counting_client(str(tmp_path / "b"), 9), retries=1, pause=0).first()
    assert lost[model.RESULT] is None and "busy" in lost[model.STATUS]


def refusing_client(path, refused):
    """Fails every batch that holds the refused prompt."""

    def build():
        def call(prompts, options):
            with open(path, "a") as fh:
                fh.write("".join(f"{p}\n" for p in prompts))
            if any(refused in p for p in prompts):
                raise RuntimeError("refused")
            return ['{"translation": "good"}'] * len(prompts)

        return call

    return build


def test_a_refused_prompt_costs_the_others_nothing(spark, tmp_path):
    df = spark.range(40).select("id", F.concat(F.lit("p"), F.format_string("%02d", "id")).alias("prompt"))
    rows = model.generate_text(df, refusing_client(str(tmp_path / "log"), "p17"), retries=1, pause=0, tasks=1).collect()
    assert [r.id for r in rows if r[model.RESULT] is None] == [17]
    assert {r.id: r[model.STATUS] for r in rows}[17] == "RuntimeError: refused"


ANSWER = "survey_h_hid string, invitation_date timestamp, brand_id string, opt_ltr_followup_comment string, sun_ltr_followup_comment string, product_ltr_followup_comment string, verbatim string"
NOW = dt.datetime(2025, 1, 1)
SETTINGS = Settings(brand_prefixes=(("AA", "Alpha"),))


def answers(spark):
    return spark.createDataFrame(
        [
            ("1", NOW, "AA1", "buono", None, None, None),
            ("2", NOW, "BB1", "troppo caro", None, None, None),
            ("3", NOW, "AA1", "", None, None, None),
            ("4", NOW, None, None, None, None, "senza marca"),
        ],
        ANSWER,
    )


def reply_with(body):
    return lambda: lambda prompts, options: [body] * len(prompts)


def test_translation_keeps_rows_it_cannot_read(spark):
    rows = jobs.translate_comments(answers(spark), reply_with("no json"), SETTINGS).collect()
    assert [(r.survey_h_hid, r.brand, r.result, r.translated_comment) for r in rows] == [("1", "Alpha", "no json", None)]


def test_categories_cover_all_brands_and_are_not_corrected(spark):
    rows = jobs.categorise_comments(answers(spark), reply_with('{"Comment Category": "Prices"}'), SETTINGS, validate=True).collect()
    assert sorted(r.survey_h_hid for r in rows) == ["1", "2", "4"]
    assert {(r.comment_category, r.known_category) for r in rows} == {("Prices", False)}


def test_cloud_takes_originals_of_untranslated_banners_only(spark):
    brands = spark.createDataFrame([("AA1", "Alpha"), ("BB1", "Beta")], "brand_id string, banner string")
    translations = jobs.translate_comments(answers(spark), reply_with('{"translation": "good"}'), SETTINGS)
    rows = jobs.cloud_comments(answers(spark), brands, translations, SETTINGS).collect()
    assert sorted((r.survey_h_hid, r.banner, r.comment) for r in rows) == [("1", "Alpha", "good"), ("2", "Beta", "troppo caro")]


def test_prompt_of_an_empty_comment_is_null(spark):
    df = spark.createDataFrame([("",), ("x",)], "comment string")
    assert [r.prompt for r in model.with_prompt(df, "Do: ").collect()] == [None, "Do: x"]


def test_daily_translation_asks_once_and_keeps_what_a_failed_call_would_replace(spark, tmp_path):
    rows = [(str(i), NOW, "AA1", f"text {i}", None, None, None, f"{i:02d}") for i in range(12)]
    results = spark.createDataFrame(rows, ANSWER + ", survey_id string")
    path, day = str(tmp_path / "out"), dt.date(2025, 1, 2)
    jobs.translate_day(spark, path, results, refusing_client(str(tmp_path / "log"), "no such"), SETTINGS, day)
    assert len((tmp_path / "log").read_text().split("\n")) - 1 == 12
    jobs.translate_day(spark, path, results, refusing_client(str(tmp_path / "again"), "text 7"), SETTINGS, day)
    stored = spark.read.parquet(path).collect()
    assert sorted(r.survey_h_hid for r in stored) == sorted(str(i) for i in range(12))
    assert {r.translated_comment for r in stored} == {"good"}
