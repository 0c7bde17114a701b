"""The SQL twin of each query, written the plain way for another engine."""

from __future__ import annotations

import re

from surveyloom.functions.sketch import PRIME, multipliers
from surveyloom.operators.model import TRANSLATE_PROMPT, category_prompt
from surveyloom.settings import CATEGORY_LABELS, DETRACTOR_SCORES, PASSIVE_SCORES, PROMOTER_SCORES, VALID_SCORES, Similarity

ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def listed(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def with_views(body: str) -> str:
    """Prefix the body with the views it uses, and those they use, in order of definition."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\bd_\w+", text)):
            if name in VIEWS and name not in needed:
                needed.add(name)
                visit(VIEWS[name])

    visit(body)
    parts = [f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in needed]
    head = "WITH RECURSIVE " if any("d_reach" in p for p in parts) else "WITH "
    return (head + ",\n".join(parts) + "\n" if parts else "") + body


def oracle(name: str, body: str) -> None:
    ORACLES[name] = with_views(body)


# --- views: the survey tables out of the given tables ---

VIEWS["d_buyer"] = """SELECT *, substr(c_mktsegment, 1, 2) || lpad(cast(c_nationkey AS varchar), 2, '0') AS brand_id
  FROM orders JOIN customer ON o_custkey = c_custkey"""

VIEWS["d_survey_url"] = """SELECT cast(o_orderkey AS varchar) AS survey_h_hid, cast(o_orderkey AS varchar) AS survey_id,
  CASE WHEN o_custkey % 10 <> 0 THEN cast(o_orderkey AS varchar) END AS txnheader_h_hid,
  o_orderdate AS invitation_date,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Optical' WHEN o_orderpriority = '2-HIGH' THEN 'Sun'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'EXAM_Optical' WHEN o_orderpriority = '5-LOW' THEN 'Product'
       WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderkey % 2 = 0 THEN 'CCSMS' END AS survey_type,
  CASE o_orderstatus WHEN 'P' THEN 'Internet' WHEN 'F' THEN 'Store' END AS purchase_channel,
  o_custkey % 100 AS source_site, c_name AS store_name,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'HOUSE HOLD' ELSE c_mktsegment END AS brand_name,
  brand_id, c_mktsegment AS zone, o_orderkey AS receipt_number, o_orderdate AS date_of_purchase
  FROM d_buyer"""

VIEWS["d_survey_results"] = """SELECT cast(o_orderkey AS varchar) AS survey_h_hid, cast(o_orderkey AS varchar) AS survey_id,
  o_orderdate AS invitation_date, brand_id,
  CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 4 = 0 THEN cast(o_orderkey % 12 AS varchar) END AS opt_ltr_score,
  CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 4 = 1 THEN cast(o_orderkey % 12 AS varchar) END AS sun_ltr_score,
  CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 4 = 2 THEN cast(o_orderkey % 12 AS varchar) END AS product_ltr_score,
  CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 4 = 3 THEN cast(o_orderkey % 12 AS varchar)
       WHEN o_orderkey % 60 IN (1, 8) THEN '0' END AS score,
  CASE WHEN o_orderkey % 3 = 0 THEN cast(o_orderkey % 13 AS varchar) END AS doctor_ltr_score,
  o_orderstatus AS google_review_yn, o_orderpriority AS survey_type, cast(o_custkey AS varchar) AS transaction_id,
  c_name AS verbatim,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS opt_ltr_followup_comment,
  CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority END AS sun_ltr_followup_comment,
  c_mktsegment AS product_ltr_followup_comment
  FROM d_buyer"""

VIEWS["d_header"] = """SELECT cast(o_orderkey AS varchar) AS txnheader_h_hid,
  CASE WHEN o_custkey % 50 <> 0 THEN substr(c_mktsegment, 1, 1) END AS distribution_channel,
  'S' || lpad(cast(c_nationkey AS varchar), 2, '0') AS sales_organization,
  o_custkey % 100 AS site_h_hid, cast(o_orderkey AS varchar) AS receipt_h_hid
  FROM d_buyer"""

VIEWS["d_receipt"] = """SELECT cast(l_orderkey AS varchar) AS receipt_h_hid,
  l_returnflag = 'R' AS complete_ophth, l_linestatus = 'O' AND l_discount > 0.08 AS complete_sun,
  l_quantity < 5 AS plano_sun, l_quantity > 45 AS contact_lens, l_tax > 0.06 AS dr_service_exams,
  CASE WHEN l_linenumber <> 1 THEN l_linenumber = 7 END AS lens_focal_type,
  l_discount = 0 AS accessory, l_extendedprice > 80000 AS reader
  FROM lineitem"""

VIEWS["d_calendar"] = """SELECT DISTINCT cast(o_orderdate AS date) AS fiscal_date,
  cast(year(o_orderdate) AS varchar) AS fiscal_year, cast(month(o_orderdate) AS varchar) AS fiscal_month FROM orders"""

VIEWS["d_country"] = """SELECT lpad(cast(n_nationkey AS varchar), 2, '0') AS country, n_name AS country_description,
  r_name AS region, 'S' || lpad(cast(n_nationkey AS varchar), 2, '0') AS sales_organization
  FROM nation JOIN region ON n_regionkey = r_regionkey"""

VIEWS["d_place"] = """SELECT c_mktsegment, c_nationkey, c_acctbal, r_name,
  substr(c_mktsegment, 1, 2) || lpad(cast(c_nationkey AS varchar), 2, '0') AS brand_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

VIEWS["d_brand_nps"] = "SELECT DISTINCT brand_id, c_mktsegment AS banner FROM d_place WHERE r_name <> 'AFRICA'"

VIEWS["d_brand_type"] = """SELECT DISTINCT substr(c_mktsegment, 1, 1) AS distribution_channel, c_mktsegment AS brand,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Wholesale'
       WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal <= 5000 THEN 'Wholesale' ELSE 'Retail' END AS type
  FROM customer"""

VIEWS["d_channel_country"] = """SELECT DISTINCT 'S' || lpad(cast(c_nationkey AS varchar), 2, '0') AS sales_organization,
  substr(c_mktsegment, 1, 1) AS distribution_channel FROM d_place WHERE r_name <> 'MIDDLE EAST'"""

VIEWS["d_site"] = """SELECT s_suppkey AS site_h_hid, s_suppkey AS site_number, s_name AS site_name,
  CASE WHEN s_nationkey % 2 = 0 THEN 'CA' ELSE 'US' END || lpad(cast(s_nationkey AS varchar), 2, '0') AS sales_organization
  FROM supplier"""

VIEWS["d_comment"] = """SELECT cast(doc_id AS varchar) AS survey_h_hid,
  CASE WHEN doc_id < 10 THEN '0' || doc_id ELSE cast(doc_id AS varchar) END AS survey_id,
  TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (doc_id % 30) AS invitation_date, source AS brand_id,
  CASE WHEN lang = 'en' THEN text END AS a, CASE WHEN lang = 'fr' THEN text END AS b,
  CASE WHEN lang = 'es' THEN text END AS c,
  CASE WHEN lang = 'de' THEN text WHEN n_chars % 2 = 1 THEN ' extra' ELSE '' END AS d
  FROM documents"""

VIEWS["d_fused"] = """SELECT *, CASE WHEN brand_id LIKE 'src10%' THEN 'Brand Ten' WHEN brand_id LIKE 'src1%' THEN 'Brand One'
    WHEN brand_id LIKE 'src2%' THEN 'Brand Two' WHEN brand_id LIKE 'src5%' THEN 'Brand Five' END AS brand
  FROM (SELECT *, coalesce(a, '') || coalesce(b, '') || coalesce(c, '') || coalesce(d, '') AS comment FROM d_comment)
  WHERE comment <> ''"""

VIEWS["d_event"] = """SELECT event_id, CASE WHEN event_id < 10 THEN '0' || event_id ELSE cast(event_id AS varchar) END AS survey_id,
  ts, user_id, event_type AS category, value FROM events"""

VIEWS["d_bucket"] = """SELECT event_id, survey_id, category,
  cast(floor(cast(right(survey_id, 2) AS bigint) / 5.0) AS bigint) AS partition_int FROM d_event"""

# --- buckets, slices, mappings ---

oracle("partition_bucket", "SELECT * FROM d_bucket")
oracle("partition_slice", "SELECT * FROM d_bucket WHERE partition_int = 7")
oracle("partitioned_table", "SELECT * FROM d_bucket WHERE partition_int = 7")
oracle("previous_day_slice", "SELECT event_id, category, value FROM d_event WHERE cast(ts AS date) = DATE '2024-01-15'")
oracle(
    "daily_slice",
    """SELECT survey_h_hid, survey_id, brand_id, cast(floor(cast(right(survey_id, 2) AS bigint) / 5.0) AS bigint) AS partition_int
  FROM d_comment WHERE cast(invitation_date AS date) = DATE '2024-01-15'""",
)
oracle(
    "previous_months_slice",
    """SELECT survey_h_hid, survey_type FROM d_survey_url
  WHERE (year(invitation_date) = 2001 AND month(invitation_date) = 7) OR (year(invitation_date) = 2001 AND month(invitation_date) = 6)""",
)
oracle("rolling_years_slice", "SELECT survey_h_hid, brand_id FROM d_survey_url WHERE year(invitation_date) >= 2001 - 2")
oracle("comment_fusion", "SELECT survey_h_hid, brand_id, comment FROM d_fused")
oracle("brand_prefix_map", "SELECT survey_h_hid, brand, comment FROM d_fused WHERE brand IS NOT NULL")
oracle(
    "exclude_list_filter",
    "SELECT survey_h_hid, survey_type FROM d_survey_url WHERE survey_type NOT IN ('CCEMAIL', 'CCSMS', 'PICKUP_Optical')",
)
oracle("include_list_filter", "SELECT survey_h_hid, survey_type FROM d_survey_url WHERE survey_type IN ('Optical', 'Sun')")
CHANNEL = "CASE purchase_channel WHEN 'Internet' THEN 'E-commerce' ELSE 'Brick and Mortar' END"
oracle("channel_map", f"SELECT survey_h_hid, {CHANNEL} AS channel FROM d_survey_url")
FAMILY = """CASE WHEN survey_type IN ('Optical', 'Sun') THEN 'NPS' WHEN survey_type = 'EXAM_Optical' THEN 'EXAM NPS'
  WHEN survey_type = 'Product' THEN 'CEPS' ELSE 'OTHER' END"""
oracle("survey_family_map", f"SELECT survey_h_hid, {FAMILY} AS family FROM d_survey_url")
CODE = "CASE WHEN right(brand_id, 2) = '07' THEN 'NA' ELSE right(brand_id, 2) END"
oracle("country_code_suffix", f"SELECT survey_h_hid, {CODE} AS country_brand_id FROM d_survey_url")
VIEWS["d_placed"] = f"""SELECT u.*, CASE WHEN code = 'NA' THEN 'NA' ELSE country_description END AS place,
  CASE WHEN code = 'NA' THEN 'North America' ELSE n.region END AS area
  FROM (SELECT *, {CODE} AS code FROM d_survey_url) u LEFT JOIN d_country n ON u.code = n.country"""
SPLIT = """CASE WHEN place = 'NA' AND sales_organization LIKE 'CA%' THEN 'Canada'
  WHEN place = 'NA' AND sales_organization LIKE 'US%' THEN 'United States' ELSE place END"""
oracle(
    "country_resolution",
    f"SELECT survey_h_hid, area AS region, {SPLIT} AS country FROM d_placed LEFT JOIN d_site ON source_site = site_number",
)
oracle(
    "brand_name_normalise",
    "SELECT p_partkey, CASE WHEN p_name IN ('red widget', 'small ring') THEN replace(p_name, ' ', '') ELSE p_name END AS name FROM part",
)
oracle(
    "dated_rule_filter",
    "SELECT event_id, category FROM d_event WHERE (category = 'error' AND cast(ts AS date) < DATE '2024-01-16') OR (cast(ts AS date) >= DATE '2024-01-16' AND value >= 0)",
)
JOINED = "coalesce(opt_ltr_score, '') || coalesce(sun_ltr_score, '') || coalesce(product_ltr_score, '') || coalesce(score, '')"
VIEWS["d_answer"] = f"""SELECT survey_h_hid, CASE WHEN {JOINED} IN ({listed(VALID_SCORES)}) THEN {JOINED} END AS score,
  doctor_ltr_score AS doctor_score,
  (opt_ltr_score IS NOT NULL)::int + (sun_ltr_score IS NOT NULL)::int + (product_ltr_score IS NOT NULL)::int + (score IS NOT NULL)::int AS filled
  FROM d_survey_results"""
oracle(
    "score_unify",
    "SELECT u.survey_h_hid, u.survey_type, a.score FROM d_survey_url u LEFT JOIN d_answer a ON u.survey_h_hid = a.survey_h_hid",
)
oracle("score_unify_strict", "SELECT survey_h_hid, CASE WHEN filled = 1 THEN score END AS score FROM d_answer")

# --- joins ---

oracle("fact_dim_inner", "SELECT survey_h_hid, u.brand_id, banner FROM d_survey_url u JOIN d_brand_nps b ON u.brand_id = b.brand_id")
oracle(
    "calendar_join",
    "SELECT survey_h_hid, fiscal_date, fiscal_year, fiscal_month FROM d_survey_url JOIN d_calendar ON fiscal_date = cast(invitation_date AS date)",
)
VIEWS["d_banner_prep"] = """SELECT DISTINCT region, country_description AS country, a.sales_organization, brand AS banner, a.distribution_channel, type
  FROM d_channel_country a JOIN d_country b ON a.sales_organization = b.sales_organization
  JOIN d_brand_type c ON a.distribution_channel = c.distribution_channel"""
oracle("banner_prep", "SELECT * FROM d_banner_prep")


def surveys_view(months: str) -> str:
    return f"""SELECT u.survey_h_hid, survey_type, fiscal_date, fiscal_year, fiscal_month, {CHANNEL} AS channel, source_site,
  site_name, region, country, banner, t.distribution_channel, type, t.receipt_h_hid
  FROM d_survey_url u JOIN d_calendar ON fiscal_date = cast(invitation_date AS date)
  LEFT JOIN d_header t ON u.txnheader_h_hid = t.txnheader_h_hid
  LEFT JOIN d_banner_prep b ON t.distribution_channel = b.distribution_channel AND t.sales_organization = b.sales_organization
  LEFT JOIN d_site s ON t.site_h_hid = s.site_h_hid
  WHERE survey_type NOT IN ('CCEMAIL', 'CCSMS', 'PICKUP_Optical') AND ({months})"""


DIMS = "survey_type, fiscal_date, fiscal_year, fiscal_month, source_site, site_name, region, country, banner, distribution_channel, type, channel"
FLAGS = "optical_flag, plano_flag, contact_lens_flag, dr_service_exams_flag, accessory_flag, reader_flag"
MEASURES = ["survey_sent", "voters", "detractors", "passive", "promoters", "doctor_voters", "doctor_detractors", "doctor_passive", "doctor_promoters"]


def some(test: str) -> str:
    return f"sum(CASE WHEN {test} THEN 1 ELSE 0 END) > 0"


def distinct_ids(name: str, test: str) -> str:
    return f"count(DISTINCT CASE WHEN {test} THEN survey_h_hid END) AS {name}"


def define_scorecard(prefix: str, months: str) -> None:
    VIEWS[f"{prefix}_surveys"] = surveys_view(months)
    VIEWS[f"{prefix}_flags"] = f"""SELECT survey_h_hid, {DIMS},
  {some("complete_ophth OR complete_sun OR lens_focal_type")} AS optical_flag, {some("plano_sun")} AS plano_flag,
  {some("contact_lens")} AS contact_lens_flag, {some("dr_service_exams")} AS dr_service_exams_flag,
  {some("accessory")} AS accessory_flag, {some("reader")} AS reader_flag
  FROM {prefix}_surveys s LEFT JOIN d_receipt r ON s.receipt_h_hid = r.receipt_h_hid GROUP BY ALL"""
    dims = DIMS.replace("survey_type", f"{FAMILY} AS survey_type", 1)
    VIEWS[f"{prefix}_scored"] = f"""SELECT f.survey_h_hid, {dims}, {FLAGS}, a.score, a.doctor_score
  FROM {prefix}_flags f LEFT JOIN d_answer a ON f.survey_h_hid = a.survey_h_hid"""
    kinds = [("voters", "{} IS NOT NULL"), ("detractors", f"{{}} IN ({listed(DETRACTOR_SCORES)})")]
    kinds += [("passive", f"{{}} IN ({listed(PASSIVE_SCORES)})"), ("promoters", f"{{}} IN ({listed(PROMOTER_SCORES)})")]
    counts = [distinct_ids("survey_sent", "true")] + [distinct_ids(n, k.format("score")) for n, k in kinds]
    kinds[0] = ("voters", f"{{}} IN ({listed(VALID_SCORES)})")
    counts += [distinct_ids(f"doctor_{n}", k.format("doctor_score")) for n, k in kinds]
    VIEWS[f"{prefix}_counts"] = f"SELECT {DIMS}, {FLAGS}, {', '.join(counts)} FROM {prefix}_scored GROUP BY ALL"


def rollup(prefix: str, cutover: str) -> str:
    views = {
        "OVERALL": "true",
        "OPTICAL": "optical_flag",
        "PLANO SUN": "plano_flag",
        "CONTACTS": "contact_lens_flag",
        "ACCESSORY": "accessory_flag",
        "READER": "reader_flag",
        "DR EXAM": f"dr_service_exams_flag AND (fiscal_date >= DATE '{cutover}' OR survey_type = 'EXAM NPS')",
    }
    sums = ", ".join(f"cast(sum({m}) AS bigint) AS {m}" for m in MEASURES)
    return "\nUNION ALL\n".join(
        f"SELECT {DIMS}, '{name}' AS product, {sums} FROM {prefix}_counts WHERE {test} GROUP BY ALL" for name, test in views.items()
    )


def scorecard(prefix: str) -> str:
    score = "CASE WHEN {0}voters = 0 THEN NULL ELSE round(({0}promoters / {0}voters - {0}detractors / {0}voters) * 100) + 0.0 END"
    return f"""SELECT {DIMS}, product, {', '.join(MEASURES)}, {score.format('')} AS score, {score.format('doctor_')} AS doctor_score
  FROM ({rollup(prefix, '2026-01-01')}) WHERE distribution_channel NOT IN ('H', 'Y1')"""


define_scorecard("d_all", "invitation_date < DATE '2001-09-01'")
define_scorecard("d_recent", "year(invitation_date) = 2001 AND month(invitation_date) IN (6, 7)")
oracle(
    "left_join_chain",
    """SELECT survey_h_hid, site_name, region, country, banner, distribution_channel, type, plano_sun, reader
  FROM d_all_surveys s LEFT JOIN d_receipt r ON s.receipt_h_hid = r.receipt_h_hid""",
)
oracle("product_flags", "SELECT * FROM d_all_flags")
oracle("promoter_counts", "SELECT * FROM d_all_counts")
oracle("product_rollup", rollup("d_all", "1998-01-01"))
oracle("promoter_scorecard", scorecard("d_all"))
oracle("promoter_scorecard_recent", scorecard("d_recent"))
oracle(
    "business_type_join",
    """SELECT survey_h_hid, b.banner, d.type AS business_type, s.sales_organization
  FROM d_survey_url u JOIN d_brand_nps b ON u.brand_id = b.brand_id
  LEFT JOIN (SELECT DISTINCT brand, type FROM d_brand_type) d ON b.banner = d.brand
  LEFT JOIN d_site s ON u.source_site = s.site_number""",
)
oracle("global_max_column", "SELECT survey_h_hid, invitation_date, max(invitation_date) OVER () AS max_invitation_date FROM d_survey_url")

# --- table maintenance ---


def keyed(version: str, status: str) -> str:
    return f"""SELECT o_orderkey AS k, CASE WHEN o_orderpriority <> '5-LOW' THEN cast(o_orderdate AS date) END AS day,
  '{version}' AS version, o_totalprice AS price FROM orders WHERE o_orderstatus IN ({status})"""


VIEWS["d_old"], VIEWS["d_new"] = keyed("old", "'F', 'O'"), keyed("new", "'O', 'P'")
UPSERT = """SELECT * FROM d_old o WHERE NOT EXISTS (SELECT 1 FROM d_new n
  WHERE n.k IS NOT DISTINCT FROM o.k AND n.day IS NOT DISTINCT FROM o.day) UNION ALL SELECT * FROM d_new"""
oracle("upsert_null_safe", UPSERT)
oracle("upserted_table", UPSERT)
oracle("switched_table", UPSERT)
oracle("upserted_periods", UPSERT)
oracle("append_rows", "SELECT * FROM d_old UNION ALL SELECT * FROM d_new")
oracle("appended_table", "SELECT * FROM d_old UNION ALL SELECT * FROM d_new")


def periods(version: str, test: str) -> str:
    return f"""SELECT cast(year(o_orderdate) AS varchar) AS fiscal_year, cast(month(o_orderdate) AS varchar) AS fiscal_month,
  c_mktsegment AS banner, CASE WHEN c_custkey % 10 <> 0 THEN cast(c_nationkey AS varchar) END AS country,
  count(*) AS n, '{version}' AS version FROM d_buyer WHERE {test} GROUP BY 1, 2, 3, 4"""


VIEWS["d_period_old"] = periods("old", "o_orderstatus IN ('F', 'O')")
VIEWS["d_period_new"] = periods("new", "o_orderstatus = 'P'")
VIEWS["d_period_late"] = "SELECT * FROM d_period_new WHERE fiscal_year >= '2000'"
REPLACE = """SELECT * FROM d_period_old o WHERE NOT EXISTS (SELECT 1 FROM {0} n WHERE n.fiscal_year = o.fiscal_year
  AND n.fiscal_month = o.fiscal_month AND n.banner = o.banner AND n.country IS NOT DISTINCT FROM o.country) UNION ALL SELECT * FROM {0}"""
oracle("replace_by_key", REPLACE.format("d_period_new"))
oracle("replaced_periods", REPLACE.format("d_period_late"))
PERIOD_KEY = "cast(cast(fiscal_year AS bigint) * 100 + cast(fiscal_month AS bigint) AS varchar) || banner || country"
oracle(
    "replace_by_key_parity",
    f"""SELECT * FROM d_period_old WHERE coalesce({PERIOD_KEY} NOT IN (SELECT {PERIOD_KEY} FROM d_period_new
  WHERE {PERIOD_KEY} IS NOT NULL), true) UNION ALL SELECT * FROM d_period_new""",
)

# --- marts ---

VIEWS["d_europe"] = "SELECT country FROM d_country WHERE region = 'EUROPE'"
INVITATION = f"""SELECT invitation_date, source_site, upper(store_name) AS store_name, survey_h_hid, txnheader_h_hid, survey_id,
  survey_type, receipt_number, brand_name, u.brand_id, zone, date_of_purchase, {CHANNEL} AS purchase_channel, b.banner AS brand_corr,
  d.type AS business_type, area AS region, place, s.sales_organization
  FROM d_placed u JOIN d_brand_nps b ON u.brand_id = b.brand_id
  LEFT JOIN (SELECT DISTINCT brand, type FROM d_brand_type) d ON b.banner = d.brand
  LEFT JOIN d_site s ON u.source_site = s.site_number WHERE year(invitation_date) >= 1998 - 2 AND """
EARLY = "invitation_date < DATE '1999-01-01'"


def invitation_mart(first: str = "true", second: str = "true") -> str:
    return f"""SELECT cast(invitation_date AS date) AS invitation_date, source_site, store_name, survey_h_hid, txnheader_h_hid,
  survey_id, survey_type, receipt_number,
  CASE WHEN brand_name = 'HOUSE HOLD' THEN replace(brand_name, ' ', '') ELSE brand_name END AS brand_name, brand_id, zone,
  date_of_purchase, purchase_channel, brand_corr, business_type, region, {SPLIT} AS country_description,
  max(invitation_date) OVER () AS max_invitation_date
  FROM ({INVITATION} place <> 'NA' AND b.banner NOT IN ('FURNITURE') AND {first}
  UNION ALL {INVITATION} place = 'NA'
  UNION ALL {INVITATION} place <> 'NA' AND b.banner IN ('FURNITURE', 'MACHINERY') AND {second}
    AND right(u.brand_id, 2) IN (SELECT country FROM d_europe))"""


oracle("invitation_mart", invitation_mart())
oracle(
    "invitation_mart_handover",
    invitation_mart(f"({EARLY} OR b.banner NOT IN ('FURNITURE', 'MACHINERY'))", f"NOT {EARLY}"),
)
RESULT = """SELECT banner, cast(invitation_date AS date) AS invitation_date, score, google_review_yn, survey_h_hid, survey_id, survey_type,
  transaction_id, verbatim, opt_ltr_score, sun_ltr_score, doctor_ltr_score, product_ltr_score, opt_ltr_followup_comment,
  sun_ltr_followup_comment, product_ltr_followup_comment FROM d_survey_results r LEFT JOIN d_brand_nps b ON r.brand_id = b.brand_id
  WHERE year(invitation_date) >= 1998 - 2 AND """
oracle(
    "results_mart",
    f"""{RESULT} banner NOT IN ('FURNITURE') UNION ALL {RESULT} banner IN ('FURNITURE', 'MACHINERY')
  AND right(r.brand_id, 2) IN (SELECT country FROM d_europe)""",
)
CASES = """SELECT cast(conv_id AS varchar) AS survey_h_hid, conv_id || '-' || turn AS survey_id, role AS survey_type,
  CASE WHEN role = 'user' THEN 'Request' ELSE 'Reply' END AS cmmacro0, CASE WHEN turn = 0 THEN 'opened' END AS dispositioncode1,
  text AS lcccomment, cast(conv_id AS varchar) AS incidentid, CASE WHEN turn > 4 THEN 'closed' ELSE 'open' END AS incidentstatus,
  cast(NULL AS varchar) AS verifiedcategory1 FROM conversations"""
oracle("case_mgmt_projection", CASES)
oracle("clustered_table", CASES)

# --- model calls and replies ---

oracle("prompt_build", f"SELECT survey_h_hid, {quoted(TRANSLATE_PROMPT)} || comment AS prompt FROM d_fused")
VIEWS["d_digest"] = "SELECT *, ('0x' || substr(md5(comment), 1, 7))::BIGINT AS digest FROM d_fused"
LABEL = f"list_extract([{listed(CATEGORY_LABELS)}], cast(digest % {len(CATEGORY_LABELS)} + 1 AS int))"
MEMBER = f"('\"Comment Category\": \"' || {LABEL} || '\"')"
oracle(
    "model_stub_roundtrip",
    f"""SELECT survey_h_hid, brand_id, comment, CASE digest % 3 WHEN 0 THEN '{{' || {MEMBER} || '}}'
  WHEN 1 THEN '```json {{' || {MEMBER} || '}} ```' ELSE '```json' || chr(10) || '{{' || chr(10) || {MEMBER} || chr(10) || '}}' || chr(10) || '```' END
  AS ml_generate_text_llm_result, '' AS ml_generate_text_status FROM d_digest""",
)
VIEWS["d_translated"] = """SELECT survey_h_hid, invitation_date, comment, brand,
  CASE WHEN digest % 3 < 2 THEN '[en] ' || comment END AS translated_comment FROM d_digest WHERE brand IS NOT NULL"""
oracle("translated_comments", "SELECT * FROM d_translated")
oracle("stored_replies", "SELECT * FROM d_translated")
oracle(
    "categorised_comments",
    f"SELECT survey_h_hid, invitation_date, comment, {LABEL} AS comment_category, true AS known_category FROM d_digest",
)
oracle("translated_table", "SELECT * FROM d_translated WHERE cast(invitation_date AS date) = DATE '2024-01-15'")
oracle(
    "categorised_table",
    f"""SELECT survey_h_hid, invitation_date, comment, {LABEL} AS comment_category FROM d_digest
  WHERE cast(invitation_date AS date) = DATE '2024-01-15' AND floor(cast(right(survey_id, 2) AS bigint) / 5.0) IN (2, 8)""",
)


VIEWS["d_read"] = f"""SELECT survey_h_hid, invitation_date, comment, survey_id, {LABEL} AS category, (digest % 1000) / 1000::double AS confidence,
  (digest % 100) / 100::double AS severity, '[en] ' || comment AS translation, CASE WHEN digest % 11 = 0 THEN 'unreadable' WHEN digest % 13 = 0 THEN 'unknown category'
  WHEN digest % 17 = 0 THEN 'confidence' WHEN digest % 19 = 0 THEN 'severity' END AS problem FROM d_digest"""
oracle("classified_comments", "SELECT * EXCLUDE (problem, survey_id) FROM d_read WHERE problem IS NULL")
oracle("refused_comments", "SELECT survey_h_hid, invitation_date, comment, problem FROM d_read WHERE problem IS NOT NULL")
oracle("classified_table", "SELECT survey_h_hid, problem IS NULL AS is_accepted FROM d_read WHERE cast(invitation_date AS date) = DATE '2024-01-15'")


def reply(key: str) -> str:
    body = f"""'{{"{key}": "' || payload || '"}}'"""
    spread = f"""'{{' || chr(10) || '"{key}": "' || payload || '"' || chr(10) || '}}'"""
    nested = f"""'{{"{key}": {{"x": "' || payload || '"}}}}'"""
    return f"""CASE doc_id % 7 WHEN 0 THEN {body} WHEN 1 THEN ' ```json ' || {body} || ' ``` '
  WHEN 2 THEN '```json' || chr(10) || {spread} || chr(10) || '```' WHEN 3 THEN 'I would say ' || payload
  WHEN 4 THEN {body} || ' {{"note": "y"}}' WHEN 5 THEN {body} || ' that is all }}' ELSE {nested} END"""


VIEWS["d_reply"] = f"""SELECT doc_id, {reply('translation')} AS tr, {reply('Comment Category')} AS cat
  FROM (SELECT doc_id, lang || ' ' || n_chars AS payload FROM documents)"""


def json_text(expr: str, key: str) -> str:
    return f"""CASE WHEN json_valid({expr}) THEN CASE WHEN json_type({expr}, '$."{key}"') NOT IN ('OBJECT', 'ARRAY', 'NULL')
  THEN json_extract_string({expr}, '$."{key}"') END END"""


# The fence patterns, in the syntax of the other engine.
ONE_LINE = r"'^\s*```json\s*(.+?)\s*```\s*$'"
ANY_FENCE = r"'```json\s*(\{[\s\S]*?\})\s*```'"
VIEWS["d_unfenced"] = f"""SELECT doc_id, tr, cat, CASE WHEN regexp_matches(tr, {ONE_LINE}) THEN regexp_extract(tr, {ONE_LINE}, 1) ELSE tr END AS one_line,
  nullif(regexp_extract(tr, {ANY_FENCE}, 1), '') AS any_line, nullif(regexp_extract(cat, {ANY_FENCE}, 1), '') AS cat_line FROM d_reply"""
oracle("parse_translation", f"SELECT doc_id, {json_text('one_line', 'translation')} AS translation FROM d_unfenced")
oracle(
    "parse_translation_multiline",
    f"SELECT doc_id, coalesce({json_text('one_line', 'translation')}, {json_text('any_line', 'translation')}) AS translation FROM d_unfenced",
)
oracle(
    "parse_category",
    f"SELECT doc_id, coalesce({json_text('cat', 'Comment Category')}, {json_text('cat_line', 'Comment Category')}) AS comment_category FROM d_unfenced",
)

# --- words ---

VIEWS["d_cloud"] = """SELECT survey_h_hid, invitation_date, 'Banner ' || brand_id AS banner, comment FROM d_fused WHERE brand IS NULL
  UNION ALL SELECT survey_h_hid, invitation_date, brand, translated_comment FROM d_translated"""
STOPS = listed(("that", "this", "with", "thion", "tion", "eaux", "thth", "erth"))


def exploded(keep: str, source: str) -> str:
    return f"""SELECT {keep}, lower(regexp_replace(token, '[,.:;!()]', '', 'g')) AS word
  FROM (SELECT {keep}, unnest(string_split(comment, ' ')) AS token FROM {source})
  WHERE length(regexp_replace(token, '[,.:;!()]', '', 'g')) > 3"""


VIEWS["d_word"] = exploded("survey_h_hid", "d_fused")
VIEWS["d_cloud_word"] = exploded("survey_h_hid, invitation_date, banner", "d_cloud")
oracle("comment_union", "SELECT * FROM d_cloud")
oracle("word_explode", "SELECT * FROM d_word")
oracle("word_stopword_filter", f"SELECT * FROM d_word WHERE word NOT IN ({STOPS})")
oracle("wordcloud_rows", f"SELECT * FROM d_cloud_word WHERE word NOT IN ({STOPS})")

# --- triage ---

oracle(
    "classification_parse",
    """SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN source END AS category,
  CASE WHEN doc_id % 3 < 2 THEN (n_chars % 1000) / 1000::double END AS confidence,
  CASE WHEN doc_id % 3 < 2 THEN (n_chars % 10) / 10::double END AS severity,
  CASE WHEN doc_id % 3 < 2 THEN lang END AS translation FROM documents""",
)
VIEWS["d_classified"] = """SELECT d.doc_id AS survey_id, cast(DATE '2024-01-01' + INTERVAL 1 DAY * (d.doc_id % 30) AS date) AS arrived, lang,
  lang AS category, (n_chars % 500 + 500) / 1000::double AS confidence,
  CASE WHEN toxic = 1 THEN 0.9::double ELSE (n_chars % 8) / 10::double END AS severity, text,
  list_distinct(list_filter(string_split(lower(translate(text, ',.:;!()', '')), ' '), lambda w: length(w) > 3)) AS words
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
VIEWS["d_plain"] = r"""SELECT doc_id, ' ' || trim(regexp_replace(lower(translate(coalesce(text, ''), ',.:;!()', '')), '[\s\x{00a0}]+', ' ', 'g')) || ' ' AS plain FROM documents"""
HOLDS = "list_filter([{}], lambda s: contains(plain, ' ' || CASE WHEN ends_with(s, '*') THEN rtrim(s, '*') ELSE s || ' ' END))"
VIEWS["d_signal"] = f"""SELECT *, hits > 0 OR severity >= 0.8 AS is_critical FROM (SELECT c.*, cast(len({HOLDS.format("'please contact', 'question*', 'lefour*'")}) + len(list_intersect(words,
  CASE lang WHEN 'en' THEN ['thatre', 'thble', 'erthes', 'blees'] WHEN 'fr' THEN ['eauaux', 'leaux', 'paeaux']
  WHEN 'de' THEN ['schen', 'ungder'] ELSE [] END)) AS int) AS hits FROM d_classified c JOIN d_plain ON doc_id = survey_id)"""
oracle("critical_signals", "SELECT survey_id, hits, is_critical FROM d_signal")

SIGNALS = [a + b + d + "*" for a in "bcdfglmprst" for b in "aeiou" for d in "lnrst"] + [
    "thatre", "schen", "paeaux", "question", "the answer", "please contact", "contact u*", "of the", "legal act*",
]
oracle(
    "signal_hits",
    f"""SELECT doc_id AS survey_id, cast(len(found) AS int) AS hits, array_to_string(list_sort(found), ',') AS signals
  FROM (SELECT doc_id, {HOLDS.format(listed(SIGNALS))} AS found FROM d_plain)""",
)

RULE = Similarity()
MINIMA = ", ".join(f"min((h * {a} + {b}) % {PRIME}) AS m{i}" for i, (a, b) in enumerate(multipliers(RULE.n_hashes)))
KEYS = ", ".join(
    "concat_ws('-', " + ", ".join(f"m{band * RULE.rows_per_band + r}" for r in range(RULE.rows_per_band)) + ")"
    for band in range(RULE.bands)
)
VIEWS["d_sketch"] = f"""SELECT survey_id, category, [{KEYS}] AS keys FROM (SELECT survey_id, category, {MINIMA} FROM (
  SELECT survey_id, category, ('0x' || substr(md5(word), 1, 8))::BIGINT % {PRIME} AS h
  FROM (SELECT survey_id, category, unnest(words) AS word FROM d_classified)) GROUP BY survey_id, category)"""
VIEWS["d_bucket_of"] = """SELECT survey_id, category, cast(band AS int) AS band, keys[band + 1] AS bucket
  FROM d_sketch, (SELECT unnest(range(16)) AS band)"""
SHARED = "len(list_intersect(a.words, b.words))"
JACCARD = f"{SHARED} / (len(a.words) + len(b.words) - {SHARED})::double"
VIEWS["d_class"] = """SELECT *, min(survey_id) OVER (PARTITION BY category, list_sort(words)) AS class_id FROM d_classified WHERE len(words) > 0"""
VIEWS["d_stand"] = "SELECT * FROM d_class WHERE survey_id = class_id"
VIEWS["d_like"] = f"""SELECT b.survey_id, a.survey_id AS leader, {JACCARD} AS similarity FROM d_stand a JOIN d_stand b
  ON a.category = b.category AND a.survey_id < b.survey_id
  WHERE least(len(a.words), len(b.words)) >= {RULE.threshold} * greatest(len(a.words), len(b.words)) - 0.000001 AND {JACCARD} >= {RULE.threshold}"""


def reached(name: str, edges: str, nodes: str) -> None:
    """The smallest node that each of `nodes` reaches along `edges` (x, y), itself included."""
    VIEWS[f"d_reach_{name}"] = f"SELECT DISTINCT x AS node, x AS other FROM {edges} UNION SELECT node, y FROM d_reach_{name} JOIN {edges} ON other = x"
    VIEWS[f"d_root_{name}"] = f"SELECT node, min(other) AS root FROM d_reach_{name} GROUP BY node"
    VIEWS[f"d_{name}"] = f"SELECT survey_id, coalesce(root, survey_id) AS cluster_id FROM {nodes} LEFT JOIN d_root_{name} ON survey_id = node"


VIEWS["d_led"] = """SELECT DISTINCT survey_id, leader FROM (SELECT survey_id, min(survey_id) OVER (PARTITION BY category, band, bucket) AS leader
  FROM d_bucket_of SEMI JOIN d_stand USING (survey_id)) JOIN d_like USING (survey_id, leader)"""
VIEWS["d_led_edge"] = "SELECT survey_id AS x, leader AS y FROM d_led UNION SELECT leader, survey_id FROM d_led"
reached("first", "d_led_edge", "d_stand")
oracle(
    "similar_links",
    """SELECT survey_id, class_id AS leader, 1.0::double AS similarity FROM d_class WHERE survey_id <> class_id
  UNION ALL SELECT survey_id, leader, round(similarity, 6) FROM d_like JOIN d_led USING (survey_id, leader)
  UNION ALL SELECT CASE WHEN a.cluster_id < b.cluster_id THEN p.survey_id ELSE p.leader END, CASE WHEN a.cluster_id < b.cluster_id THEN p.leader ELSE p.survey_id END,
    round(similarity, 6) FROM d_like p JOIN d_first a ON a.survey_id = p.leader JOIN d_first b ON b.survey_id = p.survey_id WHERE a.cluster_id <> b.cluster_id""",
)
VIEWS["d_edge"] = """SELECT survey_id AS x, leader AS y FROM d_like UNION SELECT leader, survey_id FROM d_like
  UNION SELECT survey_id, class_id FROM d_class WHERE survey_id <> class_id UNION SELECT class_id, survey_id FROM d_class WHERE survey_id <> class_id"""
reached("member", "d_edge", "d_classified")
oracle("cluster_assign", "SELECT * FROM d_member")
oracle("cluster_members", "SELECT cluster_id, count(*) AS surveys FROM d_member GROUP BY cluster_id")
oracle("updated_clusters", "SELECT * FROM d_member")
VIEWS["d_known"] = "SELECT DISTINCT class_id FROM d_class WHERE arrived < DATE '2024-01-16'"
VIEWS["d_seen"] = """SELECT DISTINCT cluster_id FROM d_member JOIN d_class USING (survey_id) JOIN (SELECT class_id FROM d_known
  UNION SELECT survey_id FROM d_like JOIN d_known ON leader = class_id UNION SELECT leader FROM d_like JOIN d_known ON survey_id = class_id) USING (class_id)"""
VIEWS["d_profile"] = """SELECT cluster_id, min(category) AS category, count(*) AS volume, round(avg(confidence), 6) AS mean_confidence,
  max(severity) AS severity, bool_or(is_critical) AS is_critical, min(arrived) AS first_day,
  list(survey_id ORDER BY severity DESC, survey_id)[1] AS example_id FROM d_member JOIN d_signal USING (survey_id) GROUP BY cluster_id"""
VIEWS["d_scored"] = """SELECT *, round(least(volume / 50::double, 1.0::double) * 0.4::double + (1 - mean_confidence) * 0.2::double + severity * 0.3::double
  + CASE WHEN is_new THEN 0.1::double ELSE 0.0::double END, 4) AS score
  FROM (SELECT p.*, p.cluster_id NOT IN (SELECT cluster_id FROM d_seen) AS is_new FROM d_profile p)"""
oracle("novelty_flag", "SELECT cluster_id, is_new FROM d_scored")
oracle("cluster_score", "SELECT * EXCLUDE (category) FROM d_scored")
VIEWS["d_routed"] = """SELECT *, CASE WHEN is_critical THEN 'review' WHEN volume < 2 THEN 'archive' WHEN is_new OR mean_confidence < 0.75 THEN 'review'
  ELSE 'auto_ticket' END AS route, CASE WHEN is_critical THEN 'critical signal' WHEN volume < 2 THEN 'low volume' WHEN is_new THEN 'new pattern'
  WHEN mean_confidence < 0.75 THEN 'low confidence' ELSE 'confident known pattern' END AS reason, 'v1' AS rules_version FROM d_scored"""
oracle("route_clusters", "SELECT cluster_id, volume, route, reason, rules_version FROM d_routed")
oracle(
    "review_queue",
    """SELECT cluster_id, r.category, volume, r.severity, score, reason, example_id, text AS example_text FROM d_routed r
  LEFT JOIN d_classified ON survey_id = example_id WHERE route = 'review'""",
)
VIEWS["d_first_decision"] = """SELECT doc_id AS cluster_id, 'r' || (doc_id % 3) AS reviewer, TIMESTAMP '2024-02-01' + INTERVAL 1 HOUR * (doc_id % 100) AS decided_at,
  CASE WHEN quality = 0 THEN 'discard' WHEN toxic = 1 THEN 'correct' ELSE 'approve' END AS action,
  CASE WHEN quality <> 0 AND toxic = 1 THEN 'reviewed' END AS new_category, toxic FROM labels"""
VIEWS["d_decision"] = """SELECT cluster_id, reviewer, decided_at, action, new_category FROM d_first_decision UNION ALL
  SELECT cluster_id, reviewer, decided_at + INTERVAL 1 DAY, 'approve', NULL FROM d_first_decision WHERE toxic = 1"""
VIEWS["d_last"] = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY decided_at DESC) AS n,
  arg_max(new_category, decided_at) FILTER (new_category IS NOT NULL) OVER (PARTITION BY cluster_id) AS set_category,
  bool_or(action = 'correct') OVER (PARTITION BY cluster_id) AS corrected FROM d_decision) WHERE n = 1"""
VIEWS["d_decided"] = """SELECT r.*, action, reviewer, decided_at, coalesce(set_category, category) AS final_category, coalesce(corrected, false) AS corrected,
  CASE WHEN action = 'discard' THEN 'discarded' WHEN action IN ('approve', 'correct') OR route = 'auto_ticket' THEN 'ticket'
  WHEN route = 'archive' THEN 'archived' ELSE 'waiting' END AS outcome FROM d_routed r LEFT JOIN d_last l ON r.cluster_id = l.cluster_id"""
oracle("apply_decisions", "SELECT cluster_id, route, action, reviewer, decided_at, final_category, corrected, outcome FROM d_decided")
VIEWS["d_ticket"] = """SELECT cluster_id, part, min(final_category) AS category, count(*) AS survey_count,
  string_agg(cast(survey_id AS varchar), ',' ORDER BY survey_id) AS survey_ids, cluster_id || '-' || part AS ticket_id
  FROM (SELECT cluster_id, survey_id, final_category, cast(floor((row_number() OVER (PARTITION BY cluster_id
    ORDER BY md5(cast(survey_id AS varchar)), survey_id) - 1) / 3) AS bigint) AS part
    FROM d_member JOIN d_decided USING (cluster_id) WHERE outcome = 'ticket') GROUP BY cluster_id, part"""
oracle("ticket_rows", "SELECT * FROM d_ticket")
oracle(
    "routed_trend",
    """SELECT first_day AS day, rules_version, route, count(*) AS clusters, cast(sum(volume) AS bigint) AS surveys
  FROM d_routed GROUP BY 1, 2, 3""",
)

# --- quality control, trends, deadlines ---

VIEWS["d_sampled"] = """SELECT survey_id, arrived AS day, CASE WHEN severity >= 0.5 THEN 'auto_ticket' ELSE 'archive' END AS route, category FROM d_classified"""
oracle(
    "qa_sample",
    """SELECT survey_id, day, route, category FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY md5(survey_id || 'qa'), survey_id) AS n
  FROM d_sampled) WHERE n <= 10""",
)
oracle(
    "qa_sample_share",
    """SELECT survey_id, day, route, category FROM (SELECT *, row_number() OVER (PARTITION BY day, route ORDER BY md5(survey_id || 'qa'), survey_id) AS n,
  count(*) OVER (PARTITION BY day, route) AS total FROM d_sampled) WHERE n <= ceil(total * 0.2::double)""",
)
VIEWS["d_unseen"] = """SELECT survey_id, arrived AS day, CASE WHEN severity >= 0.5 THEN 'auto_ticket' ELSE 'archive' END AS route, category, source
  FROM d_classified JOIN documents ON doc_id = survey_id WHERE survey_id % 5 <> 0"""
VIEWS["d_stratum"] = "SELECT day, route, category, source, count(*) AS n FROM d_unseen GROUP BY ALL"
VIEWS["d_share"] = "SELECT *, least(10, total) * n // total AS whole, least(10, total) * n % total AS rest FROM (SELECT *, sum(n) OVER (PARTITION BY day) AS total FROM d_stratum)"
VIEWS["d_quota"] = """SELECT day, route, category, source, whole + CASE WHEN row_number() OVER (PARTITION BY day ORDER BY rest DESC, route, category NULLS FIRST,
  source NULLS FIRST) <= least(10, total) - sum(whole) OVER (PARTITION BY day) THEN 1 ELSE 0 END AS quota FROM d_share"""
oracle(
    "qa_sample_fixed",
    """SELECT u.survey_id, u.day, u.route, u.category, u.source FROM (SELECT *, row_number() OVER (PARTITION BY day, route, category, source
  ORDER BY md5(survey_id || 'qa'), survey_id) AS n FROM d_unseen) u JOIN d_quota q ON u.day = q.day AND u.route = q.route
  AND u.category IS NOT DISTINCT FROM q.category AND u.source IS NOT DISTINCT FROM q.source WHERE u.n <= q.quota""",
)
VIEWS["d_review"] = """SELECT survey_id, category, confidence, quality = 0 AS is_wrong FROM d_classified JOIN labels ON survey_id = doc_id"""
oracle(
    "qa_error_rate",
    """SELECT category, count(*) AS reviewed, cast(sum(is_wrong::int) AS bigint) AS errors, round(avg(is_wrong::int), 6) AS error_rate
  FROM d_review GROUP BY category""",
)
oracle(
    "threshold_curve",
    """SELECT threshold, automated, correct, round(automated / total::double, 6) AS coverage,
  round(correct / nullif(automated, 0)::double, 6) AS precision FROM (SELECT threshold, count(*) FILTER (confidence >= threshold) AS automated,
    count(*) FILTER (confidence >= threshold AND NOT is_wrong) AS correct, count(*) AS total
    FROM d_review, (SELECT unnest([0.5, 0.6, 0.7, 0.8, 0.9, 0.95]::double[]) AS threshold) GROUP BY threshold)""",
)
VIEWS["d_confidence"] = """SELECT category, confidence AS x, count(*) AS n, cast(sum((NOT is_wrong)::int) AS bigint) AS ok,
  row_number() OVER (PARTITION BY category ORDER BY confidence) AS i FROM d_review GROUP BY category, confidence"""
VIEWS["d_running"] = """SELECT *, sum(n) OVER w AS upto_n, sum(ok) OVER w AS upto_ok FROM d_confidence WINDOW w AS (PARTITION BY category ORDER BY i)"""
VIEWS["d_span"] = """SELECT a.category, a.i AS a, b.i AS b, (b.upto_ok - a.upto_ok + a.ok) / (b.upto_n - a.upto_n + a.n)::double AS share
  FROM d_running a JOIN d_running b ON a.category = b.category AND a.i <= b.i"""
VIEWS["d_isotonic"] = """SELECT category, b AS i, max(least_share) AS calibrated FROM (SELECT *, min(share) OVER (PARTITION BY category, a ORDER BY b
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS least_share FROM d_span) GROUP BY category, b"""
VIEWS["d_block"] = """SELECT category, min(x) AS low, max(x) AS high, cast(sum(n) AS bigint) AS reviewed, cast(sum(ok) AS bigint) AS correct, calibrated
  FROM d_confidence JOIN d_isotonic USING (category, i) GROUP BY category, calibrated"""
oracle("calibration_blocks", "SELECT * REPLACE (round(calibrated, 6) AS calibrated) FROM d_block")
VIEWS["d_tail"] = """SELECT category, low, n, ok, (ok / n + 1.959964 * 1.959964 / (2 * n) - 1.959964 * sqrt(ok / n * (1 - ok / n) / n
  + 1.959964 * 1.959964 / (4 * n * n))) / (1 + 1.959964 * 1.959964 / n) AS bound FROM (SELECT category, low,
    (sum(reviewed) OVER w)::double AS n, (sum(correct) OVER w)::double AS ok FROM d_block WINDOW w AS (PARTITION BY category ORDER BY low DESC))"""
oracle(
    "calibrated_threshold",
    """SELECT category, target, arg_min(low, low) FILTER (bound >= target) AS threshold, cast(arg_min(n, low) FILTER (bound >= target) AS bigint) AS automated,
  cast(arg_min(ok, low) FILTER (bound >= target) AS bigint) AS correct, round(arg_min(bound, low) FILTER (bound >= target), 6) AS lower_bound
  FROM d_tail, (SELECT unnest([0.5, 0.6, 0.7, 0.75, 0.8, 0.99]::double[]) AS target) GROUP BY category, target""",
)
oracle(
    "calibrated_confidence",
    """SELECT survey_id, c.category, confidence, round(coalesce(b.calibrated, f.calibrated), 6) AS calibrated FROM d_classified c
  ASOF LEFT JOIN d_block b ON c.category = b.category AND c.confidence >= b.low
  LEFT JOIN (SELECT category, min(calibrated) AS calibrated FROM d_block GROUP BY category) f ON c.category = f.category""",
)
oracle(
    "category_trend",
    """SELECT *, round(n / (sum(n) OVER (PARTITION BY day))::double, 6) AS share, n - lag(n) OVER (PARTITION BY category ORDER BY day) AS change
  FROM (SELECT cast(ts AS date) AS day, category, count(*) AS n FROM d_event GROUP BY 1, 2)""",
)
HOURLY = """SELECT date_trunc('hour', ts) AS window_start, category, count(*) AS n, round(sum(value), 2) AS total FROM d_event GROUP BY 1, 2"""
oracle("window_volume", HOURLY)
oracle(
    "management_summary",
    """SELECT *, round(n / (sum(n) OVER (PARTITION BY month))::double, 6) AS share, row_number() OVER (PARTITION BY month ORDER BY n DESC, category) AS place
  FROM (SELECT cast(date_trunc('month', ts) AS date) AS month, category, count(*) AS n FROM d_event GROUP BY 1, 2)""",
)
VIEWS["d_sla"] = """SELECT *, coalesce(handled_at, TIMESTAMP '2024-02-01') > deadline AS breached FROM (SELECT *, opened_at + CASE band WHEN 'high'
    THEN INTERVAL 4 HOUR WHEN 'medium' THEN INTERVAL 24 HOUR ELSE INTERVAL 72 HOUR END AS deadline
  FROM (SELECT event_id, ts AS opened_at, CASE WHEN category <> 'error' THEN ts + INTERVAL 1 HOUR * cast(floor(value) AS int) END AS handled_at,
    CASE WHEN least(value / 100, 1.0) >= 0.8 THEN 'high' WHEN value / 100 >= 0.5 THEN 'medium' ELSE 'low' END AS band FROM d_event))"""
oracle(
    "sla_breaches",
    """SELECT event_id, band, deadline, breached, CASE WHEN breached THEN CASE band WHEN 'high' THEN 'duty manager' WHEN 'medium' THEN 'team lead'
  ELSE 'pipeline owner' END END AS escalate_to FROM d_sla""",
)
METRICS = {
    ("efficiency", "share to handle"): "SELECT sum(CASE WHEN route = 'review' THEN volume ELSE 0 END) / sum(volume)::double FROM d_decided",
    ("efficiency", "share without a human"): "SELECT 1 - sum(CASE WHEN route = 'review' THEN volume ELSE 0 END) / sum(volume)::double FROM d_decided",
    ("efficiency", "hours from cluster to ticket"): "SELECT avg((epoch(decided_at) - epoch(first_day::timestamp)) / 3600) FROM d_decided WHERE outcome = 'ticket'",
    ("quality", "correction rate"): "SELECT count(*) FILTER (corrected) / count(action)::double FROM d_decided",
    ("quality", "sampled error rate"): "SELECT avg(is_wrong::int) FROM d_review",
    ("quality", "share of tickets worked"): "SELECT avg((length(ticket_id) % 2 = 0)::int) FROM d_ticket",
    ("coverage", "critical within deadline"): "SELECT avg((NOT breached)::int) FROM d_sla WHERE band = 'high'",
}
oracle(
    "process_kpis",
    "\nUNION ALL\n".join(f"SELECT '{f}' AS family, '{m}' AS metric, round(({q}), 6)::double AS value" for (f, m), q in METRICS.items()),
)

# --- streams ---

oracle("stream_arrivals", "SELECT cast(event_id AS varchar) AS survey_h_hid, ts, category FROM d_event")
oracle(
    "stream_window_volume",
    f"SELECT * FROM ({HOURLY}) WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM d_event)",
)
oracle(
    "stream_cluster_deltas",
    """SELECT user_id || '-' || category AS cluster_id, count(*) AS volume, round(avg(value / 1000), 6) AS mean_confidence, max(value) AS severity,
  min(ts) AS first_seen, max(ts) AS last_seen FROM d_event GROUP BY 1""",
)
oracle(
    "stream_upsert",
    """SELECT user_id, ts, cast(event_id AS varchar) AS survey_h_hid, category FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC, cast(event_id AS varchar) DESC) AS n FROM d_event) WHERE n = 1""",
)
VIEWS["d_case"] = """SELECT cast(event_id AS varchar) AS case_id, band, deadline, handled_at, opened_at,
  CASE band WHEN 'high' THEN 'duty manager' WHEN 'medium' THEN 'team lead' ELSE 'pipeline owner' END AS escalate_to FROM d_sla"""
oracle(
    "stream_deadlines",
    """SELECT case_id, band, deadline, escalate_to FROM d_case WHERE (handled_at IS NULL OR handled_at > deadline)
  AND deadline < (SELECT least(max(opened_at), max(handled_at)) - INTERVAL 1 HOUR FROM d_case)""",
)
