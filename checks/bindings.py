"""The survey tables read out of the given tables (orders, customer, documents, ..)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.session import ship_package, spread
from surveyloom.settings import Settings
from surveyloom.sources.tables import Sources

AS_OF = dt.date(2001, 9, 1)
ALL_MONTHS = 120
COMMENT_DAY = dt.date(2024, 1, 16)

SETTINGS = Settings(
    brand_prefixes=(("src10", "Brand Ten"), ("src1", "Brand One"), ("src2", "Brand Two"), ("src5", "Brand Five")),
    second_region_banners=("FURNITURE", "MACHINERY"),
    first_region_excluded_banners=("FURNITURE",),
    brand_names_without_blanks=("HOUSE HOLD",),
    excluded_channels=("H", "Y1"),
    na_suffixes=("07",),
    critical_keywords={
        "en": ("thatre", "thble", "erthes", "blees"),
        "fr": ("eauaux", "leaux", "paeaux"),
        "de": ("schen", "ungder"),
    },
    critical_signals=("please contact", "question*", "lefour*"),
)


SCHEMAS = {}


def c(name: str):
    return F.col(name)


def two_digits(name: str):
    """The number as text with at least two digits."""
    text = c(name).cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


class Tables:
    """The given tables below one folder, and the survey tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        ship_package(spark)
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        """One given table. Its schema is read once, not once for each use."""
        path = f"{self.folder}/{name}.parquet"
        if path not in SCHEMAS:
            SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(SCHEMAS[path]).parquet(path)

    def documents(self) -> DataFrame:
        return spread(self.raw("documents"))

    def buyers(self) -> DataFrame:
        return self.raw("orders").join(self.raw("customer"), c("o_custkey") == c("c_custkey"))

    def brand_id(self):
        return F.concat(F.substring("c_mktsegment", 1, 2), two_digits("c_nationkey"))

    def survey_url(self) -> DataFrame:
        priority, status = c("o_orderpriority"), c("o_orderstatus")
        survey_type = (
            F.when(priority == "1-URGENT", "Optical")
            .when(priority == "2-HIGH", "Sun")
            .when(priority == "3-MEDIUM", "EXAM_Optical")
            .when(priority == "5-LOW", "Product")
            .when((priority == "4-NOT SPECIFIED") & (c("o_orderkey") % 2 == 0), "CCSMS")
        )
        return self.buyers().select(
            c("o_orderkey").cast("string").alias("survey_h_hid"),
            c("o_orderkey").cast("string").alias("survey_id"),
            F.when(c("o_custkey") % 10 != 0, c("o_orderkey").cast("string")).alias("txnheader_h_hid"),
            c("o_orderdate").alias("invitation_date"),
            survey_type.alias("survey_type"),
            F.when(status == "P", "Internet").when(status == "F", "Store").alias("purchase_channel"),
            (c("o_custkey") % 100).alias("source_site"),
            c("c_name").alias("store_name"),
            F.when(c("c_mktsegment") == "HOUSEHOLD", "HOUSE HOLD").otherwise(c("c_mktsegment")).alias("brand_name"),
            self.brand_id().alias("brand_id"),
            c("c_mktsegment").alias("zone"),
            c("o_orderkey").alias("receipt_number"),
            c("o_orderdate").alias("date_of_purchase"),
        )

    def survey_results(self) -> DataFrame:
        k = c("o_orderkey")
        value = (k % 12).cast("string")
        filled = k % 7 != 0
        column = lambda n: F.when(filled & (k % 4 == n), value)
        score = F.when(filled & (k % 4 == 3), value).when((k % 60).isin(1, 8), "0")
        return self.buyers().select(
            k.cast("string").alias("survey_h_hid"),
            k.cast("string").alias("survey_id"),
            c("o_orderdate").alias("invitation_date"),
            self.brand_id().alias("brand_id"),
            column(0).alias("opt_ltr_score"),
            column(1).alias("sun_ltr_score"),
            column(2).alias("product_ltr_score"),
            score.alias("score"),
            F.when(k % 3 == 0, (k % 13).cast("string")).alias("doctor_ltr_score"),
            c("o_orderstatus").alias("google_review_yn"),
            c("o_orderpriority").alias("survey_type"),
            c("o_custkey").cast("string").alias("transaction_id"),
            c("c_name").alias("verbatim"),
            F.when(filled, c("o_orderpriority")).alias("opt_ltr_followup_comment"),
            F.when(~filled, c("o_orderpriority")).alias("sun_ltr_followup_comment"),
            c("c_mktsegment").alias("product_ltr_followup_comment"),
        )

    def transaction_headers(self) -> DataFrame:
        return self.buyers().select(
            c("o_orderkey").cast("string").alias("txnheader_h_hid"),
            F.when(c("o_custkey") % 50 != 0, F.substring("c_mktsegment", 1, 1)).alias("distribution_channel"),
            F.concat(F.lit("S"), two_digits("c_nationkey")).alias("sales_organization"),
            (c("o_custkey") % 100).alias("site_h_hid"),
            c("o_orderkey").cast("string").alias("receipt_h_hid"),
        )

    def transaction_receipt(self) -> DataFrame:
        line = c("l_linenumber")
        none = F.lit(None).cast("boolean")
        return self.raw("lineitem").select(
            c("l_orderkey").cast("string").alias("receipt_h_hid"),
            (c("l_returnflag") == "R").alias("complete_ophth"),
            ((c("l_linestatus") == "O") & (c("l_discount") > 0.08)).alias("complete_sun"),
            (c("l_quantity") < 5).alias("plano_sun"),
            (c("l_quantity") > 45).alias("contact_lens"),
            (c("l_tax") > 0.06).alias("dr_service_exams"),
            F.when(line != 1, line == 7).alias("lens_focal_type"),
            none.alias("lens_only_ophth"),
            none.alias("lens_only_sun"),
            none.alias("frame_only_ophth"),
            (c("l_discount") == 0).alias("accessory"),
            (c("l_extendedprice") > 80000).alias("reader"),
        )

    def calendar(self) -> DataFrame:
        """Every day between the first and the last order."""
        span = self.raw("orders").agg(
            F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last")
        )
        day = span.select(F.explode(F.sequence("first", "last")).alias("fiscal_date"))
        return day.select(
            "fiscal_date",
            F.year("fiscal_date").cast("string").alias("fiscal_year"),
            F.month("fiscal_date").cast("string").alias("fiscal_month"),
        )

    def dim_country(self) -> DataFrame:
        return (
            self.raw("nation")
            .join(self.raw("region"), c("n_regionkey") == c("r_regionkey"))
            .select(
                two_digits("n_nationkey").alias("country"),
                c("n_name").alias("country_description"),
                c("r_name").alias("region"),
                F.concat(F.lit("S"), two_digits("n_nationkey")).alias("sales_organization"),
            )
        )

    def _segments(self, *skipped_regions: str) -> DataFrame:
        """Distinct (segment, nation, type). At most 10 values for each of 25 nations, which
        bounds what is broadcast below."""
        kind = (
            F.when(c("c_mktsegment").isin("BUILDING", "MACHINERY"), "Wholesale")
            .when((c("c_mktsegment") == "AUTOMOBILE") & (c("c_acctbal") <= 5000), "Wholesale")
            .otherwise("Retail")
        )
        pairs = self.raw("customer").select("c_mktsegment", "c_nationkey", kind.alias("type")).distinct()
        if not skipped_regions:
            return pairs
        nations = (
            self.raw("nation")
            .join(self.raw("region"), c("n_regionkey") == c("r_regionkey"))
            .filter(~c("r_name").isin(*skipped_regions))
        )
        return pairs.join(nations, c("c_nationkey") == c("n_nationkey"), "left_semi")

    def dim_brand_nps(self) -> DataFrame:
        known = self._segments("AFRICA").select(self.brand_id().alias("brand_id"), c("c_mktsegment").alias("banner"))
        return F.broadcast(known.distinct())

    def dim_brand_type(self) -> DataFrame:
        known = self._segments().select(
            F.substring("c_mktsegment", 1, 1).alias("distribution_channel"),
            c("c_mktsegment").alias("brand"),
            "type",
        )
        return F.broadcast(known.distinct())

    def dim_distribution_channel_country(self) -> DataFrame:
        known = self._segments("MIDDLE EAST").select(
            F.concat(F.lit("S"), two_digits("c_nationkey")).alias("sales_organization"),
            F.substring("c_mktsegment", 1, 1).alias("distribution_channel"),
        )
        return F.broadcast(known.distinct())

    def sites(self) -> DataFrame:
        region = F.when(c("s_nationkey") % 2 == 0, "CA").otherwise("US")
        return self.raw("supplier").select(
            c("s_suppkey").alias("site_h_hid"),
            c("s_suppkey").alias("site_number"),
            c("s_name").alias("site_name"),
            F.concat(region, two_digits("s_nationkey")).alias("sales_organization"),
        )

    def survey_ctl(self) -> DataFrame:
        conv = c("conv_id").cast("string")
        return self.raw("conversations").select(
            conv.alias("survey_h_hid"),
            F.concat(conv, F.lit("-"), c("turn").cast("string")).alias("survey_id"),
            c("role").alias("survey_type"),
            F.when(c("role") == "user", "Request").otherwise("Reply").alias("cmmacro0"),
            F.when(c("turn") == 0, "opened").alias("dispositioncode1"),
            c("text").alias("lcccomment"),
            conv.alias("incidentid"),
            F.when(c("turn") > 4, "closed").otherwise("open").alias("incidentstatus"),
            F.lit(None).cast("string").alias("verifiedcategory1"),
            c("text").alias("raw_payload"),
        )

    def comments(self) -> DataFrame:
        """Survey answers whose comments are the documents."""
        lang, text = c("lang"), c("text")
        tail = F.when(c("n_chars") % 2 == 1, " extra").otherwise("")
        return self.documents().select(
            c("doc_id").cast("string").alias("survey_h_hid"),
            two_digits("doc_id").alias("survey_id"),
            F.date_add(F.lit(dt.date(2024, 1, 1)), (c("doc_id") % 30).cast("int")).cast("timestamp_ntz").alias("invitation_date"),
            c("source").alias("brand_id"),
            F.when(lang == "en", text).alias("opt_ltr_followup_comment"),
            F.when(lang == "fr", text).alias("sun_ltr_followup_comment"),
            F.when(lang == "es", text).alias("product_ltr_followup_comment"),
            F.when(lang == "de", text).otherwise(tail).alias("verbatim"),
        )

    def comment_brands(self) -> DataFrame:
        """Brand dimension of the comments; one row per source."""
        from surveyloom.functions.text import prefix_label

        label = F.coalesce(
            prefix_label(c("source"), SETTINGS.brand_prefixes), F.concat(F.lit("Banner "), c("source"))
        )
        return self.raw("documents").select(c("source").alias("brand_id"), label.alias("banner")).distinct()

    def replies(self) -> DataFrame:
        """Model replies in seven shapes; the payload is the language and the length."""
        style = c("doc_id") % 7
        payload = F.concat(c("lang"), F.lit(" "), c("n_chars").cast("string"))
        body = lambda key: F.concat(F.lit('{"' + key + '": "'), payload, F.lit('"}'))

        def shaped(key: str):
            return (
                F.when(style == 0, body(key))
                .when(style == 1, F.concat(F.lit(" ```json "), body(key), F.lit(" ``` ")))
                .when(style == 2, F.concat(F.lit('```json\n{\n"' + key + '": "'), payload, F.lit('"\n}\n```')))
                .when(style == 3, F.concat(F.lit("I would say "), payload))
                .when(style == 4, F.concat(body(key), F.lit(' {"note": "y"}')))
                .when(style == 5, F.concat(body(key), F.lit(" that is all }")))
                .otherwise(F.concat(F.lit('{"' + key + '": {"x": "'), payload, F.lit('"}}')))
            )

        return self.raw("documents").select(
            "doc_id", shaped("translation").alias("translation_reply"), shaped("Comment Category").alias("category_reply")
        )

    def classified(self) -> DataFrame:
        """Surveys with category, confidence, severity and text, as the triage reads them."""
        docs, labels = self.documents(), self.raw("labels").select("doc_id", "toxic")
        joined = docs.join(labels, "doc_id", "left")
        return joined.select(
            c("doc_id").alias("survey_id"),
            F.date_add(F.lit(dt.date(2024, 1, 1)), (c("doc_id") % 30).cast("int")).alias("arrived"),
            "lang",
            c("lang").alias("category"),
            ((c("n_chars") % 500 + 500) / 1000.0).alias("confidence"),
            F.when(c("toxic") == 1, 0.9).otherwise((c("n_chars") % 8) / 10.0).alias("severity"),
            "text",
        )

    def events(self) -> DataFrame:
        return self.raw("events").select(
            "event_id",
            two_digits("event_id").alias("survey_id"),
            "ts",
            "user_id",
            c("event_type").alias("category"),
            "value",
        )

    def sources(self) -> Sources:
        names = (
            "survey_url",
            "survey_results",
            "transaction_headers",
            "transaction_receipt",
            "calendar",
            "dim_country",
            "dim_brand_nps",
            "dim_brand_type",
            "dim_distribution_channel_country",
            "sites",
            "survey_ctl",
        )
        return Sources(self.spark, {n: getattr(self, n) for n in names})

    def second_region(self) -> Sources:
        """The other region's copy of the tables: the same, for customers in Europe."""
        europe = (
            self.raw("nation")
            .join(self.raw("region"), c("n_regionkey") == c("r_regionkey"))
            .filter(c("r_name") == "EUROPE")
            .select(two_digits("n_nationkey").alias("_code"))
        )
        inside = lambda df: df.join(europe, F.right(df["brand_id"], F.lit(2)) == europe["_code"], "left_semi")
        base = self.sources()
        tables = dict(base.tables)
        tables["survey_url"] = lambda: inside(self.survey_url())
        tables["survey_results"] = lambda: inside(self.survey_results())
        return Sources(self.spark, tables)
