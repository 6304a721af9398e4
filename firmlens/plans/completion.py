"""Queries of what fills rows and reports: fallback texts, phone columns, artifacts, files, partner texts, golden sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlens.functions import fixed, phones
from firmlens.operators import completion, relations
from firmlens.plans.matching import s_list
from firmlens.plans.ranking import _pick, _s_pick
from firmlens.plans.web import read
from firmlens.shared import shared_folder
from firmlens.sources import files


def _mod(c, n):
    return F.pmod(F.col(c), F.lit(n))


def text_fallbacks(spark, sf_dir):
    """Documents as company rows: some with a scraped text, some with a description, categories or nothing."""
    d = read(spark, sf_dir, "documents")
    rows = d.select(
        "doc_id", F.when(_mod("doc_id", 3) == 0, F.col("text")).otherwise("  ").alias("scraped"), F.lit("Success").alias("status"), F.concat(F.lit("C"), F.col("doc_id").cast("string")).alias("CompanyName"),
        F.lit("http://x/").alias("GivenURL"), F.when(_mod("doc_id", 3) == 1, F.col("text")).otherwise("nan").alias("Description"), F.when(_mod("doc_id", 5) == 0, "pipes").alias("categories"),
        F.when(_mod("doc_id", 10) == 0, "steel").alias("products"), F.when(_mod("doc_id", 7) == 0, "Trade").otherwise("").alias("Industry"), F.when(_mod("doc_id", 2) == 0, "a, b").alias("keywords"))
    out = completion.fallback_text(rows, "scraped", "status")
    made = completion.fallback_text(rows, "scraped", "status", synthesize=True)
    j = out.select("doc_id", F.md5("text").alias("text_md5"), "text_status", F.md5(completion.context_blob(rows)).alias("blob_md5"))
    return j.join(made.select("doc_id", F.md5("text").alias("made_md5")), "doc_id")


TEXT_FALLBACKS = """
WITH d AS (SELECT doc_id, trim(text) AS text, doc_id % 3 AS m, CASE WHEN doc_id % 5 = 0 THEN 'pipes' END AS cat, CASE WHEN doc_id % 3 = 1 AND trim(text) <> '' THEN trim(text) END AS said FROM documents),
f AS (SELECT *, CASE WHEN m = 0 AND text <> '' THEN text END AS own, coalesce(said, cat) AS other FROM d)
SELECT doc_id, md5(coalesce(own, other)) AS text_md5, CASE WHEN own IS NOT NULL THEN 'Success' WHEN other IS NOT NULL THEN 'Used_Fallback_Description' ELSE 'LLM_Input_NoTextAvailable' END AS text_status,
       md5(concat_ws(chr(10) || chr(10), 'Short description:' || chr(10) || said, CASE WHEN doc_id % 2 = 0 THEN 'Keywords:' || chr(10) || 'a, b' END)) AS blob_md5,
       md5(coalesce(own, other, 'C' || doc_id || ' — Website: http://x/.' || CASE WHEN doc_id % 7 = 0 THEN ' Industry: Trade.' ELSE '' END)) AS made_md5 FROM f
"""


def _phones(spark, sf_dir):
    k = F.col("c_custkey")
    num = lambda p: F.concat(F.lit(p), (k + 1234567).cast("string"))
    return read(spark, sf_dir, "customer").select(
        "c_custkey", F.when(_mod("c_custkey", 4) == 0, num("'030 ")).when(_mod("c_custkey", 4) == 1, "n/a").alias("PhoneNumber"), F.when(_mod("c_custkey", 3) == 0, num("+4940")).otherwise("").alias("primary"),
        F.when(_mod("c_custkey", 5) == 0, num("+4950")).alias("secondary"), F.when(_mod("c_custkey", 6) == 0, num("+4940")).when(_mod("c_custkey", 6) == 5, num("+4999")).alias("top_number"),
        F.when(_mod("c_custkey", 12) == 0, "Fax line").when(_mod("c_custkey", 6) == 5, "Sales").otherwise(" ").alias("top_type"))


def phone_fills(spark, sf_dir):
    """Which number a row ends with, found or given, and its status."""
    p = completion.phone_columns(_phones(spark, sf_dir))
    return p.select("c_custkey", "phone_status", "found_number", "top_number", "top_type", "primary_number", "retrieved_phone_number", "has_phone")


PHONE_FILLS = """
WITH p AS (SELECT c_custkey AS k, '030 ' || (c_custkey + 1234567) AS given, c_custkey % 4 = 0 AS usable, CASE WHEN c_custkey % 3 = 0 THEN '+4940' || (c_custkey + 1234567) END AS pri, CASE WHEN c_custkey % 5 = 0 THEN '+4950' || (c_custkey + 1234567) END AS sec,
  CASE WHEN c_custkey % 6 = 0 THEN '+4940' || (c_custkey + 1234567) WHEN c_custkey % 6 = 5 THEN '+4999' || (c_custkey + 1234567) END AS top, CASE WHEN c_custkey % 12 = 0 THEN 'Fax line' WHEN c_custkey % 6 = 5 THEN 'Sales' END AS kind FROM customer),
s AS (SELECT *, CASE WHEN usable THEN 'Provided_In_Input' WHEN pri IS NOT NULL THEN 'Found_Primary' WHEN sec IS NOT NULL THEN 'Found_Secondary' ELSE 'No_Main_Line_Found' END AS status,
  CASE WHEN usable THEN given WHEN coalesce(pri, sec) IS NOT NULL THEN coalesce(CASE WHEN kind IS DISTINCT FROM 'Fax line' THEN top END, pri, sec) END AS f FROM p),
n AS (SELECT *, CASE WHEN kind = 'Fax line' AND f = top THEN NULL ELSE f END AS found, coalesce(top, CASE WHEN usable THEN given END, pri, sec) AS tn FROM s)
SELECT k AS c_custkey, status AS phone_status, found AS found_number, tn AS top_number, coalesce(kind, CASE WHEN tn IS NULL THEN NULL WHEN usable THEN 'Provided_In_Input' WHEN coalesce(pri, sec) IS NOT NULL THEN 'Retrieved' END) AS top_type,
       CASE WHEN usable THEN given ELSE pri END AS primary_number, CASE WHEN status LIKE 'Found%' THEN coalesce(CASE WHEN kind IS DISTINCT FROM 'Fax line' THEN top END, found) END AS retrieved_phone_number, found IS NOT NULL AS has_phone FROM n
"""


def report_again(spark, sf_dir):
    """A report from a live table that was written and read: usable rows, normalized numbers, renamed and missing columns."""
    path = shared_folder(spark, "live")
    status = _pick(("Found_Primary", "Provided_In_Input", "No_Main_Line_Found", "Other"), "c_custkey")
    live = _phones(spark, sf_dir).select(F.col("c_custkey").cast("string").alias("CompanyName"), status.alias("PhoneNumber_Status"), F.coalesce("primary", F.lit("")).alias("found_number"), "PhoneNumber", F.lit("x").alias("__meta_row"))
    assert files.finalize(spark, live, path)
    back = spark.read.options(header=True, quote='"', escape='"').csv(path)
    return completion.report_again(back, {"CompanyName": "Company Name"}, ["Company Name", "found_number", "sales_pitch"]).withColumn("meta", F.lit("__meta_row" in back.columns))


REPORT_AGAIN = f"""
SELECT CAST(c_custkey AS VARCHAR) AS "Company Name", CASE {_s_pick(('f', 'p', 'n', 'o'), 'c_custkey')} WHEN 'f' THEN CASE WHEN c_custkey % 3 = 0 THEN '+4940' || (c_custkey + 1234567) ELSE '' END
  WHEN 'p' THEN CASE WHEN c_custkey % 4 = 0 THEN '+4930' || (c_custkey + 1234567) ELSE '' END ELSE '' END AS found_number, '' AS sales_pitch, false AS meta FROM customer WHERE c_custkey % 4 <> 2
"""


def processed_contacts(spark, sf_dir):
    k = F.col("s_suppkey")
    s = read(spark, sf_dir, "supplier").select(
        "s_suppkey", F.when(_mod("s_suppkey", 2) == 0, F.col("s_name")).otherwise("").alias("CompanyNameSummary"), F.when(_mod("s_suppkey", 3) > 0, "makes parts").alias("SummaryDescription"),
        F.concat(F.lit("https://www.firm"), k.cast("string"), F.lit(".co.uk/x")).alias("CanonicalEntryURL"), F.lit("Trade").alias("Industry"),
        F.concat(F.lit("+49 30 "), k.cast("string"), F.when(_mod("s_suppkey", 4) > 0, " (Main Line)").otherwise("")).alias("PhoneNumber_1"), F.lit("http://s").alias("SourceURL_1"))
    return completion.processed_contacts(s)


PROCESSED_CONTACTS = """
SELECT CASE WHEN s_suppkey % 2 = 0 THEN s_name WHEN s_suppkey % 3 > 0 THEN 'firm' || s_suppkey END AS company, 'https://www.firm' || s_suppkey || '.co.uk/x' AS url, '+49 30 ' || s_suppkey AS number,
       CASE WHEN s_suppkey % 4 > 0 THEN 'Main Line' END AS number_type, 'Trade' AS industry, CASE WHEN s_suppkey % 3 > 0 THEN 'makes parts' END AS description, 'http://s' AS found_at FROM supplier
"""


def artifact_rows(spark, sf_dir):
    """Suppliers' pitches and matches as a model's answers in files, read back and merged by row."""
    path = shared_folder(spark, "artifacts")
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey").cast("string")
    pitch = F.concat(F.lit('Well } {"note": "none\n```json\n{"phone_sales_line": "Say \\"'), k, F.lit('\\" {now}"}\n``` and } more {x}'))
    match = F.concat(F.lit('{"matched_partner_name": "P'), k, F.lit('", "match_rationale_features": ["a", "b"]} tail ]'))
    both = s.select(F.concat(F.lit("Row"), k, F.lit("_pitch.txt")).alias("name"), pitch.alias("value")).unionByName(s.where("s_suppkey % 3 > 0").select(F.concat(F.lit("Row"), k, F.lit("_match.txt")).alias("name"), match.alias("value")))
    files.write_texts(both.withColumnRenamed("value", "text"), path)
    return completion.artifact_rows(files.read_texts(spark, path))


ARTIFACT_ROWS = """
SELECT s_suppkey AS row_index, 'Say "' || s_suppkey || '" {now}' AS sales_pitch, CASE WHEN s_suppkey % 3 > 0 THEN 'P' || s_suppkey END AS matched_partner,
       CASE WHEN s_suppkey % 3 > 0 THEN 'a; b' END AS match_reasoning, s_suppkey % 3 > 0 AS complete FROM supplier
"""


def phone_files(spark, sf_dir):
    """Customers' numbers in text files, found again."""
    path = shared_folder(spark, "texts")
    c = read(spark, sf_dir, "customer").select(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("nation"), F.concat(F.lit("Tel: +49 30 "), (F.col("c_custkey") * 37 + 7040601).cast("string"), F.lit(" am 01.02.2024")).alias("value"))
    c.write.partitionBy("nation").text(path)
    return files.phones_of_files(spark, path).select("raw", "number")


PHONE_FILES = f"""
SELECT '+49 30 ' || (c_custkey * 37 + 7040601) AS raw, '+4930' || (c_custkey * 37 + 7040601) AS number FROM customer
WHERE NOT regexp_matches('30' || (c_custkey * 37 + 7040601), '{"|".join([str(d) * 5 for d in range(10)] + [*phones.RISING, *phones.FALLING])}')
"""


def contact_blocks(spark, sf_dir):
    """Customers as contact pages with noise, headings, roles, phones and mail addresses."""
    k = F.col("c_custkey")
    who = _pick(("Ada Byron", "Emmy Noether", "Max von Laue", "Grace Hopper"), "c_custkey")
    lines = F.concat_ws(
        "\n", F.lit("Alan Turing"), F.lit("+44 1 234567"), F.when(_mod("c_custkey", 2) == 0, "Team"), F.lit("Mehr lesen: hier"), who, F.when(_mod("c_custkey", 3) > 0, "Leiterin Vertrieb"),
        F.when(_mod("c_custkey", 5) > 0, F.concat(F.lit("Tel. 030 "), (k + 100).cast("string"))), F.lit("E-Mail senden"), F.when(_mod("c_custkey", 7) > 0, F.concat(F.lit("x"), k.cast("string"), F.lit("@example.com"))))
    return files.contact_blocks(read(spark, sf_dir, "customer").select("c_custkey", lines.alias("page")), "c_custkey", "page")


def partner_texts(spark, sf_dir):
    """Parts as partners: summary, aliases, prompt payload, and the older accept rule on them."""
    p = read(spark, sf_dir, "part")
    f = {"industry": F.col("p_brand"), "usp": F.when(_mod("p_partkey", 3) > 0, F.col("p_type")), "target_audience": F.when(_mod("p_partkey", 2) == 0, "N/A").otherwise("Makers "), "name": F.col("p_name"), "partner_id": F.col("p_partkey").cast("string")}
    features = F.when(_mod("p_partkey", 4) == 0, F.array(F.lit(" Gemeinsame  Zielgruppe"))).when(_mod("p_partkey", 4) == 1, F.array(F.lit("Innovation"), F.lit("Transparenz"))).otherwise(F.array(F.lit(" ")))
    score = _pick(("high", "mittel", "low", "?"), "p_partkey", 4)
    ok = completion.accept_match(F.col("p_name"), score, features, _mod("p_partkey", 9) > 0, _mod("p_partkey", 25) == 0)
    host = F.concat(F.lit("p"), F.col("p_partkey").cast("string"), F.lit(".example.com"))
    aliases = completion.partner_aliases(F.concat("p_brand", F.lit(" GmbH")), host)
    return p.select("p_partkey", completion.partner_summary(f).alias("summary"), F.array_join(aliases, "|").alias("aliases"), F.get_json_object(completion.prompt_payload(f), "$.usp").alias("payload_usp"), ok["accepted"].alias("accepted"), ok["reason"].alias("reason"))


PARTNER_TEXTS = f"""
WITH p AS (SELECT *, (p_partkey // 4) % 4 AS s, p_partkey % 4 AS f FROM part)
SELECT p_partkey, concat_ws('; ', 'Industry: ' || p_brand, CASE WHEN p_partkey % 3 > 0 THEN 'USP: ' || p_type END, CASE WHEN p_partkey % 2 > 0 THEN 'Target Audience: Makers' END) AS summary,
       p_brand || ' GmbH|' || p_brand || '|p' || p_partkey || '.example.com|p' || p_partkey AS aliases, CASE WHEN p_partkey % 3 > 0 THEN p_type ELSE '' END AS payload_usp, p_partkey % 25 = 0 OR (p_partkey % 9 > 0 AND ((s = 0 AND f = 0) OR (s = 1 AND f = 0))) AS accepted,
       CASE WHEN p_partkey % 25 = 0 THEN 'accepted_strong_validated_evidence' WHEN p_partkey % 9 = 0 THEN 'matched_partner_data_missing' WHEN s = 2 THEN 'low_match_score' WHEN f > 1 THEN 'missing_match_rationale'
            WHEN s = 0 AND f = 1 THEN 'high_match_but_rationale_too_generic' WHEN s = 0 THEN 'accepted_high_match' WHEN s = 1 AND f = 0 THEN 'accepted_medium_match_with_specific_rationale' WHEN s = 1 THEN 'medium_match_too_generic' ELSE 'rejected_weak_missing_evidence' END AS reason FROM p
"""


def golden_sets(spark, sf_dir):
    """Customers as judged cases of numbers and of matches, all but every thirteenth with a result."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("case_id"), "c_custkey", "c_mktsegment")
    seen, seg = c.where(_mod("c_custkey", 13) > 0), F.col("c_mktsegment")
    cases = c.select("case_id", F.when(_mod("c_custkey", 3) > 0, F.col("case_id")).alias("expected_number"), F.when(_mod("c_custkey", 4) == 0, "ok").alias("required_outcome"), F.array(F.concat(F.lit("f"), F.pmod("c_custkey", F.lit(5)).cast("string"))).alias("forbidden"))
    rows = seen.select("case_id", F.when(_mod("c_custkey", 7) > 0, F.col("case_id")).alias("top_1"), F.lit(None).cast("string").alias("top_2"), F.lit("f2 ").alias("top_3"), F.when(_mod("c_custkey", 8) > 0, "ok").alias("outcome"))
    n = completion.golden_numbers(cases, rows)
    cases = c.select("case_id", F.when(_mod("c_custkey", 2) == 0, seg).alias("expected"), F.when(_mod("c_custkey", 5) == 0, F.array(F.lit("Building "), F.lit("machinery"))).alias("allowed"), F.array(F.lit("household")).alias("forbidden"), F.when(_mod("c_custkey", 3) == 0, "Strong").alias("confidence"), (_mod("c_custkey", 6) == 1).alias("expect_no_match"), (_mod("c_custkey", 4) == 0).alias("requires_pitch"))
    rows = seen.select("case_id", F.when(_mod("c_custkey", 9) == 0, "No suitable match found").otherwise(F.lower(seg)).alias("matched"), F.when(_mod("c_custkey", 12) == 1, "no_match").otherwise("strong").alias("confidence_found"), F.when(_mod("c_custkey", 8) == 0, " ").otherwise("hi").alias("pitch"), F.array(seg).alias("shortlist"))
    m = completion.golden_matches(cases, rows)
    long = lambda df: df.select(F.explode(F.map_from_arrays(F.array(*[F.lit(x) for x in df.columns]), F.array(*[F.col(x).cast("double") for x in df.columns]))).alias("name", "value"))
    gate = n.withColumn("release_gate", F.col("release_gate").cast("int"))
    return long(gate).withColumn("name", F.concat(F.lit("numbers "), "name")).unionByName(long(m).withColumn("name", F.concat(F.lit("matches "), "name")))


GOLDEN_SETS = """
WITH c AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS id, lower(c_mktsegment) AS seg, c_custkey % 13 > 0 AS seen FROM customer),
n AS (SELECT count(*) AS n, count(*) FILTER (NOT seen) AS missing, count(*) FILTER (seen AND (k % 3 = 0 OR k % 7 > 0)) AS num, count(*) FILTER (seen AND (k % 4 > 0 OR k % 8 > 0)) AS outc, count(*) FILTER (seen AND k % 5 = 2) AS forb FROM c),
m AS (SELECT *, k % 6 = 1 AS no, k % 9 = 0 OR k % 12 = 1 AS none, CASE WHEN k % 9 = 0 THEN 'no suitable match found' ELSE seg END AS name FROM c),
j AS (SELECT *, CASE WHEN k % 5 = 0 THEN name IN ('building', 'machinery') ELSE k % 2 = 1 OR name = seg END AND name <> 'household' AS named FROM m),
x AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (NOT seen) AS missing, count(*) FILTER (seen AND CASE WHEN no THEN none ELSE named END) AS ok, count(*) FILTER (seen AND (k % 3 > 0 OR k % 12 <> 1)) AS conf, count(*) FILTER (seen AND (k % 4 > 0 OR k % 8 > 0)) AS pitch,
  count(*) FILTER (seen AND no AND none) AS tp, count(*) FILTER (seen AND no AND NOT none) AS fp, count(*) FILTER (seen AND NOT no AND NOT named AND none) AS fn, count(*) FILTER (seen AND NOT no AND NOT named) AS neg, count(*) FILTER (no) AS no,
  count(*) FILTER (seen AND k % 5 = 0) AS listed, count(*) FILTER (seen AND k % 5 = 0 AND seg IN ('building', 'machinery')) AS hits FROM j)
SELECT 'numbers ' || name AS name, value FROM (SELECT unnest(['cases', 'missing', 'number_pass_rate', 'outcome_pass_rate', 'forbidden_failures', 'release_gate']) AS name,
  unnest([n, missing, round(num / n, 6), round(outc / n, 6), forb, (missing = 0 AND forb = 0 AND num = n AND outc = n)::INT]::DOUBLE[]) AS value FROM n)
UNION ALL SELECT 'matches ' || name, value FROM (SELECT unnest(['cases', 'missing', 'partner_pass_rate', 'confidence_pass_rate', 'pitch_pass_rate', 'no_match_precision', 'no_match_recall', 'false_positive_rate', 'false_negative_rate', 'shortlist_recall']) AS name,
  unnest([n, missing, round(ok / n, 6), round(conf / n, 6), round(pitch / n, 6), round(coalesce(tp / nullif(tp + fp, 0), 0), 6), round(coalesce(tp / nullif(tp + fn, 0), 0), 6), round(coalesce(fp / nullif(no, 0), 0), 6), round(coalesce(neg / nullif(n - no, 0), 0), 6), round(coalesce(hits / nullif(listed, 0), 0), 6)]::DOUBLE[]) AS value FROM x)
"""


def stitched(spark, sf_dir):
    """Customers and their urgent orders stitched by key: rows of both sides without the other, and the summary."""
    base = read(spark, sf_dir, "customer").where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("key"), "c_name")
    extra = read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("key"), "o_orderkey")
    return relations.stitch_summary(base, extra, ["key"])


STITCHED = """
WITH b AS (SELECT c_custkey AS key FROM customer WHERE c_custkey % 3 > 0), e AS (SELECT o_custkey AS key FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT 'base' AS name, count(*) AS n FROM b UNION ALL SELECT 'extra', count(*) FROM e UNION ALL SELECT 'matched', count(*) FROM b WHERE key IN (SELECT key FROM e)
UNION ALL SELECT 'base_only', count(*) FROM b WHERE key NOT IN (SELECT key FROM e) UNION ALL SELECT 'extra_only', count(*) FROM e WHERE key NOT IN (SELECT key FROM b)
"""


def jobs_and_merge(spark, sf_dir):
    """Orders dealt to seven workers by ranges of rows; what they return is merged in order of jobs and rows, cached rows first:
    per job where its rows came to stand."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), "o_custkey")
    high = o.agg(F.max("row_id")).first()[0]
    out = relations.merge_jobs(relations.row_jobs(o, "row_id", 1, high, 7), "row_id", F.pmod("o_custkey", F.lit(10)) == 0)
    return out.groupBy("job", "first_row", "last_row").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first_place"), F.max("place").alias("last_place"), F.sum(F.col("place") * F.pmod("row_id", F.lit(97))).alias("check_sum"))


JOBS_AND_MERGE = """
WITH h AS (SELECT max(o_orderkey) AS h FROM orders), s AS (SELECT h, greatest(1, (h + 6) // 7) AS size FROM h), o AS (SELECT o_orderkey, o_custkey, (o_orderkey - 1) // size AS job, size, h FROM orders, s WHERE o_orderkey >= 1),
p AS (SELECT *, row_number() OVER (ORDER BY o_custkey % 10 <> 0, job, o_orderkey) AS place FROM o)
SELECT job, job * size + 1 AS first_row, least(h, (job + 1) * size) AS last_row, count(*) AS rows, min(place) AS first_place, max(place) AS last_place, CAST(sum(place * (o_orderkey % 97)) AS BIGINT) AS check_sum FROM p GROUP BY ALL
"""


def sheet_rows(spark, sf_dir):
    """Line items as rows of sheets: results written back by (sheet, row), and what each sheet kept."""
    l = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("sheet"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row"), F.when(F.col("l_quantity") > 10, F.col("l_quantity").cast("string")).otherwise("").alias("phone"))
    found = l.where("row % 3 = 0").select("sheet", "row", F.concat(F.lit("n"), F.col("row").cast("string")).alias("found"))
    back = relations.write_back(l, found, ["sheet", "row"], "phone", "found")
    return relations.sheet_summary(back, "sheet", F.col("phone") != "")


SHEET_ROWS = """
WITH l AS (SELECT l_returnflag AS sheet, l_orderkey * 10 + l_linenumber AS row, l_quantity > 10 AS given FROM lineitem)
SELECT sheet, count(*) AS total, count(*) FILTER (given OR row % 3 = 0) AS kept, count(*) FILTER (NOT given AND row % 3 > 0) AS dropped FROM l GROUP BY 1
"""


def site_inputs(spark, sf_dir):
    """Documents as input rows of sites: names and rows per site, cached sites merged where absent, only listed hosts, each
    address once."""
    d = read(spark, sf_dir, "documents")
    rows = d.select("doc_id", F.col("source").alias("site"), F.concat_ws("/", "source", F.pmod("n_chars", F.lit(50)).cast("string")).alias("address"), F.col("lang").alias("name"))
    new = relations.site_inputs(rows.where("doc_id % 4 > 0"), "site", "name", "doc_id")
    cached = relations.site_inputs(rows, "site", "name", "doc_id")
    out = relations.merge_absent(new, cached, "site").withColumn("addresses", F.lit(None).cast("long"))
    seen = relations.first_seen_rows(relations.only_inputs(rows, rows.where("doc_id % 2 = 0"), ["site"]), "address", "doc_id")
    return relations.stack(out, seen.agg(F.lit("all").alias("site"), F.count(F.lit(1)).alias("addresses"), F.sum("doc_id").alias("rows")))


SITE_INPUTS = """
WITH d AS (SELECT doc_id, source AS site, concat_ws('/', source, n_chars % 50) AS address, lang AS name FROM documents),
n AS (SELECT site, string_agg(DISTINCT name, ', ' ORDER BY name) AS names, count(*) AS rows FROM d WHERE doc_id % 4 > 0 GROUP BY site),
c AS (SELECT site, string_agg(DISTINCT name, ', ' ORDER BY name) AS names, count(*) AS rows FROM d GROUP BY site),
s AS (SELECT address, min(doc_id) AS doc_id FROM d WHERE site IN (SELECT site FROM d WHERE doc_id % 2 = 0) GROUP BY address)
SELECT site, names, rows, CAST(NULL AS BIGINT) AS addresses FROM n UNION ALL SELECT site, names, rows, NULL FROM c WHERE site NOT IN (SELECT site FROM n) UNION ALL SELECT 'all', NULL, CAST(sum(doc_id) AS BIGINT), count(*) FROM s
"""


def run_outputs(spark, sf_dir):
    """Orders written as a run's tables, one for each status and a file a task: what the inventory lists of them, and their rows."""
    path = shared_folder(spark, "run")
    o = read(spark, sf_dir, "orders").withColumn("table", F.col("o_orderstatus"))
    o.write.partitionBy("table").options(header=True, quote='"', escape='"').csv(path)
    listed = files.inventory(spark, path).where(F.col("relative_path").rlike(r"part-[^/]*\.csv$"))
    listed = listed.groupBy(F.regexp_extract("relative_path", "^table=([^/]+)/", 1).alias("name")).agg((F.min("size_bytes") > 0).alias("filled"))
    rows = spark.read.options(header=True, quote='"', escape='"').csv(path).groupBy(F.col("table").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(listed, "name")


RUN_OUTPUTS = "SELECT o_orderstatus AS name, count(*) AS rows, true AS filled FROM orders GROUP BY 1"

QUERIES = {
    "text_fallbacks": (text_fallbacks, TEXT_FALLBACKS), "phone_fills": (phone_fills, PHONE_FILLS), "report_again": (report_again, REPORT_AGAIN), "processed_contacts": (processed_contacts, PROCESSED_CONTACTS),
    "artifact_rows": (artifact_rows, ARTIFACT_ROWS), "phone_files": (phone_files, PHONE_FILES), "contact_blocks": (contact_blocks, None), "partner_texts": (partner_texts, PARTNER_TEXTS), "golden_sets": (golden_sets, GOLDEN_SETS),
    "stitched": (stitched, STITCHED), "jobs_and_merge": (jobs_and_merge, JOBS_AND_MERGE), "sheet_rows": (sheet_rows, SHEET_ROWS), "site_inputs": (site_inputs, SITE_INPUTS), "run_outputs": (run_outputs, RUN_OUTPUTS),
}
