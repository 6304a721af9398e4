"""Queries from texts to consolidated phone numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlens.functions import fixed, phones
from firmlens.operators import contacts, reports
from firmlens.plans.web import read

_RUNS = "|".join([str(d) * 5 for d in range(10)] + [*phones.RISING, *phones.FALLING])
_SAME = "|".join(f"^{d}{{6,}}$" for d in range(10))


def s_e164(raw: str) -> str:
    d = f"regexp_replace({raw}, '[^0-9]', '', 'g')"
    full = rf"""CASE WHEN regexp_matches({raw}, '^\(?\+') THEN {d} WHEN starts_with({d}, '00') THEN substr({d}, 3) WHEN starts_with({d}, '0') THEN '1' || regexp_replace({d}, '^0+', '')
        WHEN starts_with({d}, '1') AND length({d}) > 10 THEN {d} ELSE '1' || {d} END"""
    return f"CASE WHEN regexp_matches({full}, '^[1-9][0-9]{{6,14}}$') THEN '+' || {full} END"


def s_valid(raw: str, nsn: str) -> str:
    date = r"\b(\d{1,2})[./-](\d{1,2})[./-](\d{2,4})\b"
    part = lambda i: f"TRY_CAST(regexp_extract({raw}, '{date}', {i}) AS INT)"
    year = f"CASE WHEN {part(3)} < 100 THEN {part(3)} + 2000 ELSE {part(3)} END"
    holder = lambda c: f"(regexp_matches({c}, '^(000000|123456)') OR regexp_matches({c}, '{_SAME}'))"
    return f"""NOT coalesce({year} BETWEEN 1900 AND 2099 AND {part(2)} BETWEEN 1 AND 12 AND {part(1)} BETWEEN 1 AND 31, false) AND NOT {holder(raw)} AND NOT {holder(nsn)}
        AND length({nsn}) >= 7 AND NOT regexp_matches({nsn}, '{_RUNS}')"""


_CODES = r"^\+(49|43|41|1)"
CANDIDATES = rf"""
SELECT doc_id, lang, source, i - 1 AS pos, trim(m) AS raw, {s_e164('trim(m)')} AS number, regexp_replace({s_e164('trim(m)')}, '{_CODES}', '') AS national, text, start, start + length(m) AS finish
FROM (SELECT doc_id, lang, source, text, m, i, CAST(coalesce(list_sum(list_transform(ps[1:i], lambda p: length(p))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda p: length(p))), 0) AS BIGINT) AS start
      FROM (SELECT doc_id, lang, source, text, ms, ps, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS i
            FROM (SELECT doc_id, lang, source, text, regexp_extract_all(text, '{phones.CANDIDATE}') AS ms, string_split_regex(text, '{phones.CANDIDATE}') AS ps FROM documents)))
"""
VALID = f"SELECT * FROM ({CANDIDATES}) WHERE number IS NOT NULL AND {s_valid('raw', 'national')}"


def found(spark, sf_dir):
    return contacts.candidates(read(spark, sf_dir, "documents"))


def phone_candidates(spark, sf_dir):
    return found(spark, sf_dir).select("doc_id", "pos", "raw", "number", "national", F.md5("snippet").alias("snippet_md5"))


PHONE_CANDIDATES = f"""
SELECT doc_id, CAST(pos AS INT) AS pos, raw, number, national,
       md5(trim(CASE WHEN start > 150 THEN regexp_extract(substr(text, 1, start - 150), '([^ ]*)$', 1) ELSE '' END || substr(text, greatest(start - 150, 0) + 1, finish + 150 - greatest(start - 150, 0))
                || regexp_extract(substr(text, finish + 151), '^([^ ]*)', 1))) AS snippet_md5
FROM ({VALID})
"""


def sourced(spark, sf_dir):
    """Candidates of each source as a site, with a page per document; every fourth document stands for a contact page."""
    page = F.concat(F.lit("http://"), F.col("source"), F.when(F.pmod("doc_id", F.lit(4)) == 0, "/kontakt/").otherwise("/p/"), F.col("doc_id").cast("string"))
    return found(spark, sf_dir).withColumn("source_url", page).withColumn("snippet", F.concat(F.lit("tel "), F.col("lang")))


def candidate_rank_cap(spark, sf_dir):
    order = [F.col("doc_id"), F.col("pos")]
    c = contacts.cap_per_page(sourced(spark, sf_dir), ["source", "source_url"], "number", order)
    c = contacts.rank_and_cap(c, "source", order, most=20)
    return c.select("source", "place", "score", "number", "source_url")


_SOURCED = f"SELECT *, 'http://' || source || CASE WHEN doc_id % 4 = 0 THEN '/kontakt/' ELSE '/p/' END || doc_id AS source_url FROM ({VALID})"
CANDIDATE_RANK_CAP = f"""
WITH p AS (SELECT * FROM ({_SOURCED}) QUALIFY row_number() OVER (PARTITION BY source, source_url, number ORDER BY doc_id, pos) <= 3),
s AS (SELECT *, CASE WHEN doc_id % 4 = 0 THEN 100 ELSE 0 END + 30 + least(50, 10 * count(*) OVER (PARTITION BY source, number)) AS score FROM p),
d AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY source, number, source_url ORDER BY doc_id, pos) = 1)
SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id, pos) AS INT) AS place, CAST(score AS INT) AS score, number, source_url FROM d
QUALIFY row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id, pos) <= 20
"""

_CLASSES, _TYPES = ("Primary", "Secondary", "Support", "Non-Business"), ("Main Line", "Sales", "Fax", "Mobile", "Unknown")


def classified(spark, sf_dir):
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.col("doc_id") + F.col("pos") * by, F.lit(len(values))) + 1).cast("int"))
    c = sourced(spark, sf_dir)
    return c.withColumns({"classification": pick(_CLASSES, 3), "type": pick(_TYPES, 2), "original_full_url": F.col("source_url")})


def s_pick(values, by):
    return "(['" + "', '".join(values) + f"'])[(doc_id + pos * {by}) % {len(values)} + 1]"


def s_priority():
    cls = " ".join(f"WHEN '{k}' THEN {v}" for k, v in fixed.CLASS_PRIORITY.items())
    typ = " ".join(f"WHEN '{k}' THEN {v}" for k, v in fixed.TYPE_PRIORITY.items())
    return f"CASE classification {cls} ELSE 99 END * 1000 + CASE type {typ} ELSE 90 END"


_CLASSIFIED = f"SELECT *, {s_priority()} AS prio FROM (SELECT *, {s_pick(_CLASSES, 3)} AS classification, {s_pick(_TYPES, 2)} AS type FROM ({_SOURCED}))"


def consolidate_numbers(spark, sf_dir):
    n = contacts.consolidate(classified(spark, sf_dir), "source", ["doc_id", "pos"])
    return n.select("source", "number", "classification", "sightings", F.size("sources").cast("long").alias("n_sources"), F.array_join(F.array_sort("types"), ", ").alias("types"))


CONSOLIDATE_NUMBERS = f"""
SELECT source, number, arg_min(classification, (prio, doc_id, pos)) AS classification, count(*) AS sightings, count(DISTINCT (source_url, type)) AS n_sources,
       array_to_string(list_sort(list(DISTINCT type)), ', ') AS types FROM ({_CLASSIFIED}) GROUP BY source, number
"""


def call_list(spark, sf_dir):
    n = contacts.consolidate(classified(spark, sf_dir), "source", ["doc_id", "pos"])
    n = contacts.callable_numbers(n).withColumn("type", F.col("types")[0])
    return contacts.top_numbers(n, "source", [F.col("priority.class"), F.col("priority.type"), F.col("number")])


CALL_LIST = f"""
WITH c AS (SELECT source, number, arg_min(classification, (prio, doc_id, pos)) AS classification, min(prio) AS prio, bool_or(NOT contains(lower(type), 'fax')) AS fine,
             arg_min(type, (doc_id, pos)) AS type FROM ({_CLASSIFIED}) GROUP BY source, number),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY prio, number) AS n FROM c WHERE fine AND lower(classification) <> 'non-business')
SELECT source, {", ".join(f"max(CASE WHEN n = {i} THEN {c} END) AS {c}_{i}" for i in (1, 2, 3) for c in ("number", "type"))} FROM r WHERE n <= 3 GROUP BY source
"""


def domain_status(spark, sf_dir):
    status = F.when(F.pmod("doc_id", F.lit(7)) == 0, "Success").when(F.pmod("doc_id", F.lit(3)) == 0, "Error_Timeout").otherwise("NoContent")
    d = read(spark, sf_dir, "documents").select(F.concat_ws("-", "source", "lang", F.pmod("n_chars", F.lit(16)).cast("string")).alias("site"), "doc_id", status.alias("status"))
    return contacts.domain_status(d, "site", ["doc_id"])


DOMAIN_STATUS = """
WITH d AS (SELECT concat_ws('-', source, lang, n_chars % 16) AS site, doc_id, CASE WHEN doc_id % 7 = 0 THEN 'Success' WHEN doc_id % 3 = 0 THEN 'Error_Timeout' ELSE 'NoContent' END AS status FROM documents)
SELECT site, arg_min(status, (CASE WHEN status = 'Success' THEN 0 WHEN starts_with(status, 'Error') THEN 2 ELSE 1 END, doc_id)) AS status FROM d GROUP BY site
"""


def phone_shapes(spark, sf_dir):
    """Numbers made of order keys in four notations: how they normalize and whether they may be kept."""
    k = F.col("o_orderkey").cast("string")
    raw = F.element_at(F.array(F.concat(F.lit("+1 212 "), k, F.lit("555")), F.concat(F.lit("0041 44"), k, k), F.concat(F.lit("'(212) "), k), F.concat(F.lit("0"), k, F.lit("1122"))), (F.pmod("o_orderkey", F.lit(4)) + 1).cast("int"))
    o = read(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    o = o.withColumn("number", phones.e164(F.col("raw"), "US")).withColumn("national", phones.national(F.col("number")))
    return o.select("o_orderkey", "number", phones.is_target(F.col("number")).alias("target"), F.coalesce(phones.valid(F.col("raw"), F.col("national")), F.lit(False)).alias("fine"), phones.needs_retrieval(F.col("raw")).alias("needs"))


_RAW = "CASE o_orderkey % 4 WHEN 0 THEN '+1 212 ' || o_orderkey || '555' WHEN 1 THEN '0041 44' || o_orderkey || o_orderkey WHEN 2 THEN '''(212) ' || o_orderkey ELSE '0' || o_orderkey || '1122' END"
PHONE_SHAPES = f"""
WITH o AS (SELECT o_orderkey, {_RAW} AS raw FROM orders),
s AS (SELECT *, trim(regexp_replace(trim(raw), '^''', '')) AS x FROM o),
n AS (SELECT *, {s_e164('x')} AS number FROM s),
v AS (SELECT *, regexp_replace(number, '{_CODES}', '') AS national, regexp_replace(x, '[^0-9]', '', 'g') AS d FROM n)
SELECT o_orderkey, number, coalesce(regexp_matches(number, '^\\+(49|41|43)'), false) AS target, coalesce({s_valid('raw', 'national')}, false) AS fine, length(d) < 5 OR length(d) > 17 AS needs FROM v
"""


def role_scores(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    return p.select("p_partkey", phones.role_score(F.col("p_name")).alias("score"), phones.is_fax(F.col("p_type")).alias("fax"), phones.split_number_type(F.concat(F.lit("+1 "), F.col("p_partkey").cast("string"), F.lit(" ("), F.col("p_type"), F.lit(")")))["type"].alias("type"))


_TIERS = " ".join(f"WHEN regexp_matches(lower(trim(p_name)), '{'|'.join(words)}') THEN {score}" for score, words in fixed.ROLE_TIERS)
ROLE_SCORES = f"SELECT p_partkey, CAST(CASE WHEN trim(coalesce(p_name, '')) = '' THEN 0 {_TIERS} ELSE 10 END AS INT) AS score, contains(lower(p_type), 'fax') AS fax, p_type AS type FROM part"

def detailed_report(spark, sf_dir):
    """Documents as input rows with every number of their source, in class order."""
    n = contacts.consolidate(classified(spark, sf_dir), "source", ["doc_id", "pos"]).select("source", "number", "classification")
    rows = read(spark, sf_dir, "documents").select("source", "lang").distinct()
    return reports.detailed(rows, n, "source").select("source", "lang", "number", "classification", "class_place")


DETAILED_REPORT = f"""
SELECT source, lang, number, classification, CASE classification WHEN 'Primary' THEN 0 WHEN 'Secondary' THEN 1 WHEN 'Support' THEN 2 WHEN 'Low Relevance' THEN 3 WHEN 'Non-Business' THEN 4 ELSE 5 END AS class_place
FROM (SELECT DISTINCT source, lang FROM documents) JOIN ({CONSOLIDATE_NUMBERS}) USING (source)
"""


def contact_report(spark, sf_dir):
    n = contacts.consolidate(classified(spark, sf_dir), "source", ["doc_id", "pos"]).withColumn("types", F.array_sort("types"))
    return reports.short_contacts(n, "source")


CONTACT_REPORT = f"""
WITH n AS (SELECT source, number, classification, types, CASE classification WHEN 'Primary' THEN 0 WHEN 'Secondary' THEN 1 WHEN 'Support' THEN 2 ELSE 4 END AS place FROM ({CONSOLIDATE_NUMBERS})),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY place, number) AS k FROM n
      WHERE classification <> 'Non-Business' AND len(list_filter(string_split(types, ', '), lambda t: t IN ('Unknown', 'Fax', 'Mobile', 'Date', 'ID'))) = 0)
SELECT source, string_agg(number || ' (' || types || ')', '; ' ORDER BY k) AS contacts FROM r WHERE k <= 3 GROUP BY source
"""


def number_verification(spark, sf_dir):
    """Whether a customer's number is among those of its nation, and whether the site moved."""
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    given = F.when(F.pmod(k, F.lit(4)) == 0, F.lit("n/a")).otherwise(F.concat(F.lit("+49 30 "), (k + 100000).cast("string")))
    found = F.when(F.pmod(k, F.lit(3)) == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("+4930"), (k + 100000 + F.when(F.pmod(k, F.lit(5)) == 0, 1).otherwise(0)).cast("string"))))
    moved = F.when(F.pmod(k, F.lit(7)) == 0, "https://www.new.example.com/x").otherwise("http://old.example.com")
    v = reports.verification(given, found, F.lit("old.example.com/a"), moved)
    return c.select(v["status"].alias("status"), v["redirected"].alias("redirected")).groupBy("status", "redirected").agg(F.count(F.lit(1)).alias("n"))


NUMBER_VERIFICATION = """
SELECT CASE WHEN c_custkey % 4 = 0 THEN CASE WHEN c_custkey % 3 > 0 THEN 'Found' ELSE 'Missing' END WHEN c_custkey % 3 = 0 THEN 'Unverified' WHEN c_custkey % 5 > 0 THEN 'Verified' ELSE 'Different' END AS status,
       c_custkey % 7 = 0 AS redirected, count(*) AS n FROM customer GROUP BY ALL
"""

QUERIES = {
    "detailed_report": (detailed_report, DETAILED_REPORT), "contact_report": (contact_report, CONTACT_REPORT), "number_verification": (number_verification, NUMBER_VERIFICATION),
    "phone_candidates": (phone_candidates, PHONE_CANDIDATES), "candidate_rank_cap": (candidate_rank_cap, CANDIDATE_RANK_CAP), "consolidate_numbers": (consolidate_numbers, CONSOLIDATE_NUMBERS),
    "call_list": (call_list, CALL_LIST), "domain_status": (domain_status, DOMAIN_STATUS), "phone_shapes": (phone_shapes, PHONE_SHAPES), "role_scores": (role_scores, ROLE_SCORES),
}
