"""One Spark query per operator, over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bindings import ALL_MONTHS, AS_OF, COMMENT_DAY, SETTINGS, Tables, c
from surveyloom import settings as S
from surveyloom.functions import codes, dates, replies
from surveyloom.operators import buckets, calibration, dimensions, merging, model, promoters, quality, signals, similarity, triage, words
from surveyloom.plans import comments as jobs
from surveyloom.plans import classify, marts, scorecard
from surveyloom.plans import triage as job
from surveyloom.session import materialise, new_folder
from surveyloom.sources import tables as io
from surveyloom.sources.patterns import append_patterns
from surveyloom.streaming import clusters, deadlines
from surveyloom.streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RECENT = dt.date(2001, 8, 1)
MART_DAY = dt.date(1998, 6, 1)
QA_CUT = dt.date(2024, 1, 16)
SLA_NOW = dt.datetime(2024, 2, 1)
THRESHOLDS = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95)
#: Stems of all three-letter beginnings out of some letters, with some words and phrases.
SIGNALS = (
    *(f"{a}{b}{d}*" for a in "bcdfglmprst" for b in "aeiou" for d in "lnrst"),
    "thatre", "schen", "paeaux", "question", "the answer", "please contact", "contact u*", "of the", "legal act*",
)
STOPWORDS = ("that", "this", "with", "thion", "tion", "eaux", "thth", "erth")


def query(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
    return f


# --- buckets, date slices, predicates and mappings ---


@query
def partition_bucket(t):
    return buckets.with_partition_int(t.events()).select("event_id", "survey_id", "category", "partition_int")


@query
def partition_slice(t):
    return buckets.for_partition(partition_bucket(t), 7)


@query
def previous_day_slice(t):
    return t.events().filter(dates.on_previous_day(c("ts"), COMMENT_DAY)).select("event_id", "category", "value")


@query
def daily_slice(t):
    return jobs.daily_slice(t.comments(), COMMENT_DAY).select("survey_h_hid", "survey_id", "brand_id", "partition_int")


@query
def previous_months_slice(t):
    return t.survey_url().filter(dates.in_previous_months(c("invitation_date"), RECENT)).select("survey_h_hid", "survey_type")


@query
def rolling_years_slice(t):
    return t.survey_url().filter(dates.in_rolling_years(c("invitation_date"), RECENT)).select("survey_h_hid", "brand_id")


@query
def comment_fusion(t):
    return jobs.fuse_comments(t.comments(), "survey_h_hid", "brand_id")


@query
def brand_prefix_map(t):
    return jobs.brand_comments(t.comments(), SETTINGS.brand_prefixes).select("survey_h_hid", "brand", "comment")


@query
def exclude_list_filter(t):
    return t.survey_url().filter(~c("survey_type").isin(*S.EXCLUDED_SURVEY_TYPES)).select("survey_h_hid", "survey_type")


@query
def include_list_filter(t):
    return t.survey_url().filter(c("survey_type").isin("Optical", "Sun")).select("survey_h_hid", "survey_type")


@query
def channel_map(t):
    return t.survey_url().select("survey_h_hid", codes.channel_of(c("purchase_channel")).alias("channel"))


@query
def survey_family_map(t):
    return t.survey_url().select("survey_h_hid", codes.family_of(c("survey_type")).alias("family"))


@query
def country_code_suffix(t):
    return t.survey_url().select(
        "survey_h_hid", codes.country_code(c("brand_id"), SETTINGS.na_suffixes).alias("country_brand_id")
    )


@query
def country_resolution(t):
    placed = marts.with_country(t.survey_url(), t.dim_country(), SETTINGS)
    sited = dimensions.with_sales_organization(placed, t.sites())
    country = codes.split_north_america(c("country_description"), c("sales_organization"))
    return sited.select("survey_h_hid", "region", country.alias("country"))


@query
def brand_name_normalise(t):
    return t.raw("part").select("p_partkey", codes.without_blanks(c("p_name"), ("red widget", "small ring")).alias("name"))


@query
def dated_rule_filter(t):
    rule = dates.dated_rule(F.to_date("ts"), COMMENT_DAY, c("category") == "error", c("value") >= 0)
    return t.events().filter(rule).select("event_id", "category")


@query
def score_unify(t):
    score = codes.unify_score(*[c(n) for n in promoters.SCORE_COLUMNS])
    invited = t.survey_url().select("survey_h_hid", "survey_type")
    return invited.join(t.survey_results().select("survey_h_hid", score.alias("score")), "survey_h_hid", "left")


@query
def score_unify_strict(t):
    score = codes.unify_score(*[c(n) for n in promoters.SCORE_COLUMNS], strict=True)
    return t.survey_results().select("survey_h_hid", score.alias("score"))


# --- joins ---


@query
def fact_dim_inner(t):
    return dimensions.with_banner(t.survey_url(), t.dim_brand_nps()).select("survey_h_hid", "brand_id", "banner")


@query
def calendar_join(t):
    return dimensions.with_fiscal_period(t.survey_url(), t.calendar()).select(
        "survey_h_hid", "fiscal_date", "fiscal_year", "fiscal_month"
    )


@query
def banner_prep(t):
    return dimensions.banner_prep(t.dim_distribution_channel_country(), t.dim_country(), t.dim_brand_type())


def _surveys(t):
    return scorecard.surveys_with_header(scorecard.invited(t.sources(), SETTINGS, AS_OF, ALL_MONTHS), t.sources())


@query
def left_join_chain(t):
    """Header, banner and site joined to the invitation, and all lines of its receipt."""
    lines = t.transaction_receipt().select("receipt_h_hid", "plano_sun", "reader")
    joined = dimensions.left_join_sparse(_surveys(t), lines, "receipt_h_hid", "survey_h_hid")
    return joined.select(
        "survey_h_hid", "site_name", "region", "country", "banner", "distribution_channel", "type", "plano_sun", "reader"
    )


@query
def business_type_join(t):
    typed = dimensions.with_business_type(dimensions.with_banner(t.survey_url(), t.dim_brand_nps()), t.dim_brand_type())
    return dimensions.with_sales_organization(typed, t.sites()).select(
        "survey_h_hid", "banner", "business_type", "sales_organization"
    )


@query
def global_max_column(t):
    url = t.survey_url().select("survey_h_hid", "invitation_date")
    return dimensions.with_global_max(url, "invitation_date", "max_invitation_date")


# --- table maintenance ---


def _keyed_orders(t, version: str, *status: str):
    """Orders as keyed rows; a fifth of the second key part is null."""
    day = F.when(c("o_orderpriority") != "5-LOW", F.to_date("o_orderdate"))
    return t.raw("orders").filter(c("o_orderstatus").isin(*status)).select(
        c("o_orderkey").alias("k"), day.alias("day"), F.lit(version).alias("version"), c("o_totalprice").alias("price")
    )


@query
def upsert_null_safe(t):
    return merging.upsert(_keyed_orders(t, "old", "F", "O"), _keyed_orders(t, "new", "O", "P"), ["k", "day"])


@query
def append_rows(t):
    return merging.append(_keyed_orders(t, "old", "F", "O"), _keyed_orders(t, "new", "O", "P"))


def _periods(t, version: str, *status: str):
    """Order totals per month, segment and nation; a tenth of the customers has no nation."""
    nation = F.when(c("c_custkey") % 10 != 0, c("c_nationkey").cast("string"))
    rows = t.buyers().filter(c("o_orderstatus").isin(*status))
    return (
        rows.groupBy(
            F.year("o_orderdate").cast("string").alias("fiscal_year"),
            F.month("o_orderdate").cast("string").alias("fiscal_month"),
            c("c_mktsegment").alias("banner"),
            nation.alias("country"),
        )
        .agg(F.count("*").alias("n"))
        .withColumn("version", F.lit(version))
    )


@query
def replace_by_key(t):
    return scorecard.refresh_scorecard(_periods(t, "old", "F", "O"), _periods(t, "new", "P"))


@query
def replace_by_key_parity(t):
    return scorecard.refresh_scorecard(_periods(t, "old", "F", "O"), _periods(t, "new", "P"), parity=True)


@query
def upserted_table(t):
    """Two upserts into a table on disk."""
    path = new_folder(t.spark, "upserted")
    io.ensure_table(t.spark, path, _keyed_orders(t, "old", "F").schema)
    io.upsert_table(t.spark, path, _keyed_orders(t, "old", "F", "O"), ["k", "day"])
    io.upsert_table(t.spark, path, _keyed_orders(t, "new", "O", "P"), ["k", "day"])
    return t.spark.read.parquet(path)


@query
def switched_table(t):
    """Two upserts and an append into a table with versions, the append between them."""
    path = new_folder(t.spark, "switched")
    io.ensure_table(t.spark, path, _keyed_orders(t, "old", "F").schema, versioned=True)
    io.upsert_table(t.spark, path, _keyed_orders(t, "old", "O"), ["k", "day"])
    io.append_table(_keyed_orders(t, "old", "F"), path)
    io.upsert_table(t.spark, path, _keyed_orders(t, "new", "O", "P"), ["k", "day"])
    return io.read_table(t.spark, path)


@query
def appended_table(t):
    path = new_folder(t.spark, "appended")
    io.replace_table(_keyed_orders(t, "old", "F", "O"), path)
    io.append_table(_keyed_orders(t, "new", "O", "P"), path)
    return t.spark.read.parquet(path)


@query
def replaced_periods(t):
    """Replace-by-key in a table partitioned by month, rewriting the batch's months only."""
    path = new_folder(t.spark, "periods")
    old = _periods(t, "old", "F", "O")
    new = _periods(t, "new", "P").filter("fiscal_year >= '2000'")
    period = ["fiscal_year", "fiscal_month"]
    io.replace_table(old, path, period)
    io.replace_periods(t.spark, path, new, list(scorecard.KEYS), period)
    return t.spark.read.schema(old.schema).parquet(path).select(*old.columns)


@query
def upserted_periods(t):
    """Upsert in a table partitioned by year, rewriting the batch's years only."""
    path = new_folder(t.spark, "years")
    dated = lambda version, *status: _keyed_orders(t, version, *status).withColumn("year", F.year("day"))
    io.replace_table(dated("old", "F", "O"), path, ["year"])
    io.upsert_periods(t.spark, path, dated("new", "O", "P"), ["k", "day", "year"], ["year"])
    return t.spark.read.parquet(path).select("k", "day", "version", "price")


@query
def partitioned_table(t):
    """Events written by bucket; one bucket read back as one directory."""
    path = new_folder(t.spark, "bucketed")
    io.write_partitioned(partition_bucket(t), path, "partition_int")
    return buckets.for_partition(t.spark.read.parquet(path), 7).select(
        "event_id", "survey_id", "category", c("partition_int").cast("bigint").alias("partition_int")
    )


@query
def clustered_table(t):
    path = new_folder(t.spark, "clustered")
    io.write_clustered(marts.case_mart(t.sources()), path, "survey_h_hid")
    return t.spark.read.parquet(path)


# --- promoter scorecard ---


def _scored(t):
    return scorecard.scored_surveys(t.sources(), SETTINGS, AS_OF, ALL_MONTHS)


@query
def product_flags(t):
    flagged = promoters.product_flags(_surveys(t), t.transaction_receipt())
    return promoters.unpack_flags(flagged.withColumn("survey_h_hid", promoters.survey_id())).drop("_survey")


@query
def promoter_counts(t):
    return promoters.unpack_flags(promoters.promoter_counts(promoters.survey_marks(_scored(t))))


@query
def product_rollup(t):
    return promoters.product_rollup(promoters.promoter_counts(promoters.survey_marks(_scored(t))), dt.date(1998, 1, 1))


@query
def promoter_scorecard(t):
    return scorecard.promoter_scorecard(t.sources(), SETTINGS, AS_OF, ALL_MONTHS)


@query
def promoter_scorecard_recent(t):
    return scorecard.promoter_scorecard(t.sources(), SETTINGS, RECENT)


# --- marts ---


@query
def invitation_mart(t):
    return marts.invitation_mart(t.sources(), t.second_region(), SETTINGS, MART_DAY)


@query
def invitation_mart_handover(t):
    return marts.invitation_mart(t.sources(), t.second_region(), SETTINGS, MART_DAY, handover=dt.date(1999, 1, 1))


@query
def results_mart(t):
    return marts.results_mart(t.sources(), t.second_region(), SETTINGS, MART_DAY)


@query
def case_mgmt_projection(t):
    return marts.case_mart(t.sources())


# --- model calls and replies ---


@query
def prompt_build(t):
    prompted = model.with_prompt(jobs.fuse_comments(t.comments(), "survey_h_hid"), model.TRANSLATE_PROMPT)
    return prompted.select("survey_h_hid", "prompt")


@query
def model_stub_roundtrip(t):
    prompted = model.with_prompt(jobs.fuse_comments(t.comments(), "survey_h_hid", "brand_id"), model.category_prompt())
    return model.generate_text(prompted, model.offline_categoriser()).drop("prompt")


@query
def parse_translation(t):
    return t.replies().select("doc_id", replies.parse_translation(c("translation_reply")).alias("translation"))


@query
def parse_translation_multiline(t):
    return t.replies().select("doc_id", replies.parse_translation(c("translation_reply"), multiline=True).alias("translation"))


@query
def parse_category(t):
    return t.replies().select("doc_id", replies.parse_category(c("category_reply")).alias("comment_category"))


@query
def translated_comments(t):
    return jobs.translate_comments(t.comments(), model.offline_translator(), SETTINGS).drop("result")


def _refusing():
    """A client that answers nothing."""

    def call(prompts, options):
        raise RuntimeError("asked again")

    return call


@query
def stored_replies(t):
    """Translated twice with a reply store; the second client refuses every call, so all replies come from the store."""
    settings = replace(SETTINGS, reply_store=new_folder(t.spark, "replies"))
    jobs.translate_comments(t.comments(), model.offline_translator(), settings)
    return jobs.translate_comments(t.comments(), _refusing, settings).drop("result")


@query
def categorised_comments(t):
    return jobs.categorise_comments(t.comments(), model.offline_categoriser(), SETTINGS, validate=True)


@query
def translated_table(t):
    """The daily translation job, run twice: slice, translate, upsert."""
    path = new_folder(t.spark, "translated")
    for _ in range(2):
        jobs.translate_day(t.spark, path, t.comments(), model.offline_translator(), SETTINGS, COMMENT_DAY)
    return t.spark.read.parquet(path).drop("result")


@query
def categorised_table(t):
    """The daily categorisation job for two buckets: slice, pick, categorise, append."""
    path = new_folder(t.spark, "categorised")
    for bucket in (2, 8):
        jobs.categorise_bucket(t.spark, path, t.comments(), bucket, model.offline_categoriser(), SETTINGS, COMMENT_DAY)
    return t.spark.read.parquet(path)


def _classified_replies(t):
    return classify.classify_comments(t.comments(), model.offline_classifier(), SETTINGS)


@query
def classified_comments(t):
    """Surveys with what one model reply says of each; the replies that can't be used are in `refused_comments`."""
    return classify.accepted(_classified_replies(t))


@query
def refused_comments(t):
    return classify.refused(_classified_replies(t)).drop("reply")


@query
def classified_table(t):
    """The daily classification job, run twice, with the tables of accepted and of refused rows read back."""
    path, refused = new_folder(t.spark, "classified"), new_folder(t.spark, "refused")
    for _ in range(2):
        classify.classify_day(t.spark, path, refused, t.comments(), model.offline_classifier(), SETTINGS, COMMENT_DAY)
    rows = [t.spark.read.parquet(p).select("survey_h_hid", F.lit(p == path).alias("is_accepted")) for p in (path, refused)]
    return rows[0].unionByName(rows[1])


# --- words ---


@query
def comment_union(t):
    translations = jobs.translate_comments(t.comments(), model.offline_translator(), SETTINGS)
    return jobs.cloud_comments(t.comments(), t.comment_brands(), translations, SETTINGS)


@query
def word_explode(t):
    return words.explode_words(jobs.fuse_comments(t.comments(), "survey_h_hid"), keep=("survey_h_hid",))


@query
def word_stopword_filter(t):
    return words.remove_stopwords(word_explode(t), STOPWORDS)


@query
def wordcloud_rows(t):
    return jobs.wordcloud_rows(comment_union(t), STOPWORDS)


# --- triage ---


@query
def classification_parse(t):
    docs = t.raw("documents")
    confidence = F.lpad((c("n_chars") % 1000).cast("string"), 3, "0")
    reply = F.format_string(
        '{"category": "%s", "confidence": 0.%s, "severity": 0.%d, "translation": "%s"}',
        c("source"), confidence, c("n_chars") % 10, c("lang"),
    )
    shaped = F.when(c("doc_id") % 3 == 0, reply).when(c("doc_id") % 3 == 1, F.concat(F.lit("```json\n"), reply, F.lit("\n```")))
    return docs.select("doc_id", replies.parse_classification(F.coalesce(shaped, F.lit("no answer"))).alias("r")).select(
        "doc_id", "r.*"
    )


def _signalled(t):
    return triage.critical_signals(t.classified(), SETTINGS.critical_keywords, signals=SETTINGS.critical_signals)


@query
def critical_signals(t):
    return _signalled(t).select("survey_id", "hits", "is_critical")


@query
def signal_hits(t):
    """Words, phrases and stems of all languages in every text, by one automaton."""
    found = signals.signal_hits(t.classified(), SIGNALS).select("survey_id", c("signals"))
    return found.select("survey_id", F.size("signals").alias("hits"), F.concat_ws(",", "signals").alias("signals"))


def _sketched(t):
    sets = materialise(similarity.word_sets(t.classified()), "words")
    return sets, materialise(similarity.sketches(sets), "sketches")


@query
def similar_links(t):
    links = similarity.similar_links(*_sketched(t))
    return links.select("survey_id", "leader", F.round("similarity", 6).alias("similarity"))


@query
def cluster_assign(t):
    return similarity.cluster_members(t.classified(), similarity.similar_links(*_sketched(t)))


_TRIAGE: dict[tuple[str, str], job.Triage] = {}


def _triage(t):
    """The triage job, run once per session and folder; what follows reads its tables.

    Surveys that arrived in the first half of the month are the known patterns.
    """
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _TRIAGE:
        surveys = t.classified()
        history = new_folder(t.spark, "history")
        append_patterns(t.spark, history, similarity.word_sets(surveys.filter(c("arrived") < F.lit(QA_CUT))), 0)
        _TRIAGE[key] = job.run(surveys, history, SETTINGS)
    return _TRIAGE[key]


@query
def cluster_members(t):
    """Cluster sizes, with the surveys that were lost on the way (none)."""
    members, surveys = _triage(t).members, t.classified()
    lost = similarity.lost_surveys(surveys, members).withColumn("cluster_id", F.lit(None).cast("bigint"))
    return members.unionByName(lost).groupBy("cluster_id").agg(F.count("*").alias("surveys"))


@query
def novelty_flag(t):
    return _routed(t).select("cluster_id", "is_new")


@query
def cluster_score(t):
    return _triage(t).routed.drop("category", "route", "reason", "rules_version")


def _routed(t):
    return _triage(t).routed


@query
def route_clusters(t):
    return _routed(t).select("cluster_id", "volume", "route", "reason", "rules_version")


@query
def review_queue(t):
    return triage.review_queue(_routed(t), t.classified())


def _decisions(t):
    """Decisions on the labelled clusters; harmful ones are decided twice."""
    labels = t.raw("labels")
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=(c("doc_id") % 100).cast("int"))
    action = F.when(c("quality") == 0, "discard").when(c("toxic") == 1, "correct").otherwise("approve")
    first = labels.select(
        c("doc_id").alias("cluster_id"),
        F.concat(F.lit("r"), (c("doc_id") % 3).cast("string")).alias("reviewer"),
        at.alias("decided_at"),
        action.alias("action"),
        F.when(action == "correct", "reviewed").alias("new_category"),
    )
    again = first.join(labels.filter("toxic = 1").select(c("doc_id").alias("cluster_id")), "cluster_id", "left_semi")
    return first.unionByName(
        again.withColumns(
            {
                "decided_at": c("decided_at") + F.expr("INTERVAL 1 DAY"),
                "action": F.lit("approve"),
                "new_category": F.lit(None).cast("string"),
            }
        )
    )


def _decided(t):
    return triage.apply_decisions(_routed(t), _decisions(t))


@query
def apply_decisions(t):
    return _decided(t).select("cluster_id", "route", "action", "reviewer", "decided_at", "final_category", "corrected", "outcome")


def _tickets(t):
    return triage.ticket_rows(_decided(t), _triage(t).members, max_size=3)


@query
def ticket_rows(t):
    return _tickets(t)


@query
def routed_trend(t):
    return quality.routed_trend(_routed(t))


# --- quality control, trends, deadlines ---


def _sampled(t):
    route = F.when(c("severity") >= 0.5, triage.AUTO).otherwise(triage.ARCHIVE)
    return t.classified().select("survey_id", c("arrived").alias("day"), route.alias("route"), "category")


@query
def qa_sample(t):
    return quality.qa_sample(_sampled(t), 10)


@query
def qa_sample_share(t):
    return quality.qa_sample_share(_sampled(t), 0.2)


@query
def qa_sample_fixed(t):
    """Ten surveys a day out of automatic tickets and archive, by route, category and source."""
    route = F.when(c("survey_id") % 5 == 0, triage.REVIEW).when(c("severity") >= 0.5, triage.AUTO).otherwise(triage.ARCHIVE)
    rows = t.classified().join(t.raw("documents").select(c("doc_id").alias("survey_id"), "source"), "survey_id")
    rows = rows.select("survey_id", c("arrived").alias("day"), route.alias("route"), "category", "source")
    return quality.qa_sample_fixed(rows, 10, strata=("route", "category", "source"))


def _reviews(t):
    labels = t.raw("labels").select(c("doc_id").alias("survey_id"), (c("quality") == 0).alias("is_wrong"))
    return t.classified().select("survey_id", "category", "confidence").join(labels, "survey_id")


@query
def qa_error_rate(t):
    return quality.error_rate(_reviews(t), "category")


@query
def threshold_curve(t):
    return quality.threshold_curve(_reviews(t).withColumn("is_correct", ~c("is_wrong")), THRESHOLDS)


TARGETS = (0.5, 0.6, 0.7, 0.75, 0.8, 0.99)


def _calibration(t):
    return calibration.calibration(_reviews(t).withColumn("is_correct", ~c("is_wrong")), ["category"])


@query
def calibration_blocks(t):
    return _calibration(t).withColumn("calibrated", F.round("calibrated", 6))


@query
def calibrated_threshold(t):
    return calibration.calibrated_threshold(_calibration(t), TARGETS, ["category"])


@query
def calibrated_confidence(t):
    """Every classified survey with its confidence as the reviews bear it out."""
    rows = t.classified().select("survey_id", "category", "confidence")
    return calibration.calibrated(rows, _calibration(t), ["category"]).withColumn("calibrated", F.round("calibrated", 6))


@query
def category_trend(t):
    return quality.category_trend(t.events())


@query
def window_volume(t):
    return quality.window_volume(t.events())


@query
def management_summary(t):
    return quality.management_summary(t.events())


def _cases(t):
    handled = F.when(c("category") != "error", c("ts") + F.make_dt_interval(hours=F.floor("value").cast("int")))
    return t.events().select(
        "event_id",
        F.least(c("value") / 100, F.lit(1.0)).alias("severity"),
        c("ts").alias("opened_at"),
        handled.alias("handled_at"),
    )


def _sla(t):
    return triage.sla_state(_cases(t), SETTINGS.sla, SLA_NOW)


@query
def sla_breaches(t):
    return _sla(t).select("event_id", "band", "deadline", "breached", "escalate_to")


@query
def process_kpis(t):
    status = F.when(F.length("ticket_id") % 2 == 0, "worked").otherwise("dropped")
    tickets = _tickets(t).withColumn("status", status)
    return quality.process_kpis(_decided(t), _reviews(t), tickets, _sla(t))


@query
def updated_clusters(t):
    """Clusters after three batches of surveys, each looked up in the index that the ones before have left."""
    path, surveys = new_folder(t.spark, "clusters"), t.classified()
    for batch in range(3):
        clusters.update_clusters(t.spark, path, surveys.filter(c("survey_id") % 3 == batch), batch)
    return clusters.cluster_state(t.spark, path)


# --- streams: each takes what is there, then stops, and the result is read as a table ---


def _without_zone(df):
    """Times as the given tables hold them, without a zone."""
    times = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({n: c(n).cast("timestamp_ntz") for n in times})


def _event_stream(t):
    schema = t.raw("events").schema
    raw = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    return raw.select(
        c("event_id").cast("string").alias("survey_h_hid"),
        c("ts").cast("timestamp").alias("ts"),
        "user_id",
        c("event_type").alias("category"),
        "value",
    )


@query
def stream_arrivals(t):
    """Every event arrives twice; one of each stays."""
    doubled = _event_stream(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    path = new_folder(t.spark, "arrivals")
    streams.start_table(streams.arrivals(doubled), path, new_folder(t.spark, "progress"), 8).awaitTermination()
    return _without_zone(t.spark.read.parquet(path)).select("survey_h_hid", "ts", "category")


@query
def stream_window_volume(t):
    """Hourly volumes of the windows that the watermark has closed."""
    path = new_folder(t.spark, "volume")
    streams.start_table(streams.stream_volume(_event_stream(t)), path, new_folder(t.spark, "progress"), 8).awaitTermination()
    return _without_zone(t.spark.read.parquet(path))


@query
def stream_cluster_deltas(t):
    """Running figures per user and category as clusters."""
    rows = _event_stream(t).select(
        F.concat_ws("-", c("user_id").cast("string"), "category").alias("cluster_id"),
        "ts",
        (c("value") / 1000).alias("confidence"),
        c("value").alias("severity"),
    )
    path = new_folder(t.spark, "deltas")
    streams.start_deltas(rows, streams.fold_clusters, path, new_folder(t.spark, "progress")).awaitTermination()
    return _without_zone(streams.current_clusters(t.spark, path))


@query
def stream_upsert(t):
    """Latest event per user."""
    rows = _event_stream(t).select("user_id", "ts", "survey_h_hid", "category")
    path = new_folder(t.spark, "latest")
    streams.start_upsert(rows, ["user_id"], "ts", path, new_folder(t.spark, "progress")).awaitTermination()
    return _without_zone(t.spark.read.parquet(path))


@query
def stream_deadlines(t):
    """Cases that the watermark leaves unhandled beyond their deadline."""
    opened = _event_stream(t).select(
        c("survey_h_hid").alias("case_id"), "ts", F.least(c("value") / 100, F.lit(1.0)).alias("severity")
    )
    handled = _event_stream(t).filter("category <> 'error'").select(
        c("survey_h_hid").alias("case_id"), (c("ts") + F.make_dt_interval(hours=F.floor("value").cast("int"))).alias("ts")
    )
    missed = deadlines.missed_deadlines(opened, handled, SETTINGS.sla)
    path = new_folder(t.spark, "missed")
    streams.start_table(missed, path, new_folder(t.spark, "progress"), 8, timers=True).awaitTermination()
    return _without_zone(t.spark.read.parquet(path))
