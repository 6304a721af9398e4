"""Queries of reconciliation, duplicates, outcomes and profiles over the business tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from firmlens.functions.text import age_text, rank_value
from firmlens.operators import relations
from firmlens.plans.web import read
from firmlens.shared import written


def orders_to_resume(spark, sf_dir):
    """Customers without a partly done order; those without a key (every eleventh here) stay."""
    done = read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("key"))
    todo = read(spark, sf_dir, "customer").select(F.when(F.pmod("c_custkey", F.lit(11)) > 0, F.col("c_custkey")).alias("key"), "c_name")
    return relations.remaining(todo, done, ["key"])


ORDERS_TO_RESUME = """
SELECT CASE WHEN c_custkey % 11 > 0 THEN c_custkey END AS key, c_name FROM customer
WHERE c_custkey % 11 = 0 OR c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus = 'P')
"""


def overlay_stitch(spark, sf_dir):
    base = read(spark, sf_dir, "customer").select("c_custkey", F.when(F.pmod("c_nationkey", F.lit(2)) == 0, " ").otherwise(F.col("c_mktsegment")).alias("note"))
    extra = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("note"), "o_orderkey")
    return relations.overlay(base, extra, ["c_custkey"], ["note"], "o_orderkey")


OVERLAY_STITCH = """
WITH e AS (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS note FROM orders GROUP BY 1)
SELECT c_custkey, CASE WHEN c_nationkey % 2 <> 0 AND trim(c_mktsegment) <> '' THEN trim(c_mktsegment) ELSE note END AS note FROM customer LEFT JOIN e ON o_custkey = c_custkey
"""


def partner_upsert(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    new = s.where(F.pmod("s_suppkey", F.lit(3)) > 0).select(F.when(F.pmod("s_suppkey", F.lit(3)) == 1, F.upper("s_name")).otherwise(F.concat(F.lit("New "), F.col("s_name"))).alias("s_name"), F.when(F.pmod("s_suppkey", F.lit(2)) == 0, F.lit("")).otherwise((F.col("s_nationkey") + 100).cast("string")).alias("s_nationkey"))
    return relations.upsert(s.select("s_name", F.col("s_nationkey").cast("string").alias("s_nationkey")), new, F.lower("s_name"), ["s_name", "s_nationkey"])


PARTNER_UPSERT = """
WITH n AS (SELECT CASE WHEN s_suppkey % 3 = 1 THEN upper(s_name) ELSE 'New ' || s_name END AS s_name, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE CAST(s_nationkey + 100 AS VARCHAR) END AS s_nationkey FROM supplier WHERE s_suppkey % 3 > 0)
SELECT coalesce(n.s_name, o.s_name) AS s_name, coalesce(nullif(n.s_nationkey, ''), CAST(o.s_nationkey AS VARCHAR)) AS s_nationkey FROM supplier o FULL JOIN n ON lower(o.s_name) = lower(n.s_name)
"""


def completeness_gap(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    high = o.agg(F.max("o_orderkey")).first()[0]
    shipped = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return relations.missing_numbers(shipped, "o_orderkey", 0, high)


COMPLETENESS_GAP = "SELECT r AS o_orderkey FROM (SELECT unnest(range(0, (SELECT max(o_orderkey) + 1 FROM orders))) AS r) WHERE r NOT IN (SELECT l_orderkey FROM lineitem)"


def last_event(spark, sf_dir):
    return relations.last_wins(read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", F.get_json_object("props", "$.k").alias("k")), ["user_id"], "event_id")


LAST_EVENT = "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, arg_max(json_extract_string(props, '$.k'), event_id) AS k FROM events GROUP BY user_id"


def cascade_join(spark, sf_dir):
    """Customers by segment name, else by nation: the first level that matches wins, then the least key."""
    c = read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("NATION_"), F.when(F.pmod("c_custkey", F.lit(3)) == 0, F.col("c_nationkey"))).alias("nation_name"), F.col("c_nationkey").cast("string").alias("nation_key"))
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").cast("string").alias("region"))
    out = relations.cascade(c, n, "c_custkey", [("nation_name", "n_name"), ("nation_key", "region")], "n_nationkey")
    return out.select("c_custkey", "level", F.col("matched.n_nationkey").alias("n_nationkey"))


CASCADE_JOIN = """
SELECT c_custkey, CAST(CASE WHEN c_custkey % 3 = 0 AND a.n_nationkey IS NOT NULL THEN 0 WHEN b.k IS NOT NULL THEN 1 END AS INT) AS level, CASE WHEN c_custkey % 3 = 0 AND a.n_nationkey IS NOT NULL THEN a.n_nationkey ELSE b.k END AS n_nationkey
FROM customer LEFT JOIN nation a ON a.n_name = 'NATION_' || c_nationkey LEFT JOIN (SELECT n_regionkey, min(n_nationkey) AS k FROM nation GROUP BY 1) b ON b.n_regionkey = c_nationkey
"""


def dup_stats(spark, sf_dir):
    return relations.duplicate_stats(read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority"), ["o_custkey", "o_orderdate", "o_orderpriority"])


DUP_STATS = " UNION ALL ".join(f"SELECT '{c}' AS name, count(*) AS distinct_values, count(*) FILTER (n > 1) AS dup_values, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS dup_rows FROM (SELECT {c}, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1)" for c in ("o_custkey", "o_orderdate", "o_orderpriority"))


def dup_flags(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("text_md5"), "n_chars")
    return relations.duplicate_flags(written(d, "keys"), ["text_md5", "n_chars"]).select("doc_id", "n_text_md5", "is_dup_text_md5", "n_n_chars", "is_dup_n_chars")


DUP_FLAGS = """
SELECT doc_id, count(*) OVER (PARTITION BY text) AS n_text_md5, count(*) OVER (PARTITION BY text) > 1 AS is_dup_text_md5,
       count(*) OVER (PARTITION BY n_chars) AS n_n_chars, count(*) OVER (PARTITION BY n_chars) > 1 AS is_dup_n_chars FROM documents
"""


def chunk_jobs(spark, sf_dir):
    l = relations.chunk_jobs(read(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity"), "l_suppkey", [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity")], 10, 50)
    return l.groupBy("l_suppkey", "chunk").agg(F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("first_order"))


CHUNK_JOBS = """
WITH c AS (SELECT l_suppkey, l_orderkey, CAST((row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity) - 1) // 10 AS INT) AS chunk FROM lineitem)
SELECT l_suppkey, chunk, count(*) AS n, min(l_orderkey) AS first_order FROM c WHERE chunk < 50 GROUP BY ALL
"""


def class_order(spark, sf_dir):
    """Orders by a custom order of classes, with each class's rank value and its oldest waiting time."""
    rank = F.when(F.col("o_orderstatus") == "P", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    o = read(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    o = o.withColumn("place", F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(rank, F.desc("n"))))
    return o.select("o_orderstatus", "o_orderpriority", "n", "place", rank_value(F.substring_index("o_orderpriority", "-", 1)).alias("rank_value"), age_text(F.col("n") * 7).alias("age"))


CLASS_ORDER = """
WITH o AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
SELECT *, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, n DESC) AS INT) AS place, CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS rank_value,
  CASE WHEN n * 7 < 60 THEN n * 7 || 's' WHEN n * 7 < 3600 THEN printf('%dm %02ds', n * 7 // 60, n * 7 % 60) ELSE printf('%dh %02dm', n * 7 // 3600, n * 7 % 3600 // 60) END AS age FROM o
"""


def stop_after_blanks(spark, sf_dir):
    """Lines of the documents, blank where a line has fewer than 30 characters, up to the first two blanks in a row."""
    lines = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.withColumn("line", F.when(F.length("line") < 30, F.lit("")).otherwise(F.col("line")))
    kept = relations.stop_after_blanks(lines, "doc_id", "pos", "line", 2)
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("kept"), F.max("pos").alias("last_pos"))


STOP_AFTER_BLANKS = """
WITH l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
b AS (SELECT *, length(line) < 30 OR trim(line) = '' AS blank FROM l),
r AS (SELECT *, max(CASE WHEN blank AND p THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS stop FROM (SELECT *, coalesce(lag(blank) OVER (PARTITION BY doc_id ORDER BY pos), false) AS p FROM b))
SELECT doc_id, count(*) AS kept, CAST(max(pos) AS INT) AS last_pos FROM r WHERE stop = 0 AND NOT blank GROUP BY doc_id
"""


def text_budget(spark, sf_dir):
    t = relations.text_budget(read(spark, sf_dir, "conversations"), "conv_id", [F.col("turn"), F.col("role"), F.col("text")], "text", 400)
    return t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.sum(F.length("text").cast("long")).alias("chars"))


TEXT_BUDGET = """
WITH b AS (SELECT conv_id, length(text) AS n, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM conversations)
SELECT conv_id, count(*) AS turns, CAST(sum(least(n, 400 - before)) AS BIGINT) AS chars FROM b WHERE before < 400 GROUP BY conv_id
"""


def prequalify_gate(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    b2b = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "No").when(F.col("c_mktsegment") == "FURNITURE", F.lit(None)).otherwise("Yes")
    serves = F.when(F.col("c_acctbal") < 0, "No").when(F.col("c_acctbal") < 1000, "Unknown").when(F.col("c_acctbal") < 9000, "Yes")
    return c.withColumn("reason", F.coalesce(relations.prequalify(b2b, serves), F.lit("passed"))).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


PREQUALIFY_GATE = """
WITH c AS (SELECT CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'No' WHEN 'FURNITURE' THEN NULL ELSE 'Yes' END AS b, CASE WHEN c_acctbal < 0 THEN 'No' WHEN c_acctbal < 1000 THEN 'Unknown' WHEN c_acctbal < 9000 THEN 'Yes' END AS s FROM customer)
SELECT CASE WHEN b IS NULL AND s IS NULL THEN 'B2B_Capacity_Check_Failed' WHEN coalesce(b, '') <> 'Yes' THEN 'Not_B2B' WHEN s = 'No' THEN 'Capacity_Under_1000' ELSE 'passed' END AS reason, count(*) AS n FROM c GROUP BY 1
"""


def _outcomes(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    m = lambda n: F.pmod("event_id", F.lit(n))
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.col("user_id"), F.lit(len(values))) + 1).cast("int"))
    c = {
        "status": F.when(m(17) == 0, "InvalidURL").when(m(19) == 0, "MaxRedirects_InputURL").when(m(13) == 0, "Already_Processed").otherwise("Success"),
        "base": F.when(m(11) > 0, F.lit("b")), "base_status": F.when(F.col("event_type") == "error", "Error").otherwise("Success"),
        "page_statuses": F.array(pick(("Timeout", "HTTP_403", "NotFound", "Other")), pick(("DNS_Error", "Robots", "404", "Timeout"))),
        "regex_found": m(5) > 0, "has_numbers": F.col("event_type") == "purchase", "has_bundle": m(7) > 0, "n_raw": m(3), "llm_error": F.when(m(14) == 0, F.lit("x")),
        "has_top": m(2) == 0, "rerank_requested": m(4) == 1, "rerank_error": F.when(m(6) == 1, F.lit("x"))}
    e = e.withColumn("outcome", relations.row_outcome(c))
    return e.withColumn("fault", relations.fault(F.col("outcome"), c["rerank_requested"]))


def outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir).groupBy("outcome", "fault").agg(F.count(F.lit(1)).alias("n"))


OUTCOMES = """
WITH e AS (SELECT *, CASE WHEN event_id % 17 = 0 THEN 'InvalidURL' WHEN event_id % 19 = 0 THEN 'MaxRedirects_InputURL' WHEN event_id % 13 = 0 THEN 'Already_Processed' ELSE 'Success' END AS status, user_id % 4 AS p FROM events),
o AS (SELECT event_id, CASE WHEN status = 'InvalidURL' THEN 'Input_URL_Invalid' WHEN status = 'MaxRedirects_InputURL' THEN 'Pipeline_Skipped_MaxRedirects_ForInputURL'
  WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'Contact_Successfully_Extracted' WHEN event_type = 'purchase' AND event_id % 6 = 1 THEN 'Contact_Consolidated_RerankFailed_NoOperationalCallList'
  WHEN event_type = 'purchase' THEN 'Contact_Consolidated_NoOperationalCallList' WHEN event_id % 11 = 0 AND status = 'Already_Processed' THEN 'ScrapingFailure_InputURL_Already_Processed' WHEN event_id % 11 = 0 THEN 'Unknown_NoCanonicalURLDetermined'
  WHEN event_type = 'error' THEN (['Scraping_AllAttemptsFailed_Network', 'Scraping_AllAttemptsFailed_AccessDenied', 'Scraping_ContentNotFound_AllAttempts', 'ScrapingFailed_Canonical_Error'])[p + 1]
  WHEN status = 'Already_Processed' THEN 'Canonical_Duplicate_SkippedProcessing' WHEN event_id % 5 = 0 THEN 'Canonical_NoRegexCandidatesFound'
  WHEN event_id % 14 = 0 THEN 'LLM_Processing_Error_AllAttempts' WHEN event_id % 7 = 0 THEN 'LLM_NoInput_NoRegexCandidates'
  WHEN event_id % 3 = 0 THEN 'LLM_Output_NoNumbersFound_AllAttempts' ELSE 'LLM_Output_NumbersFound_NoneRelevant_AllAttempts' END AS outcome FROM e),
f AS (SELECT outcome, CASE WHEN outcome = 'Contact_Successfully_Extracted' THEN 'N/A' WHEN outcome = 'Contact_Consolidated_RerankFailed_NoOperationalCallList' THEN 'LLM Issue'
  WHEN outcome = 'Contact_Consolidated_NoOperationalCallList' THEN CASE WHEN event_id % 4 = 1 THEN 'LLM Issue' ELSE 'Pipeline Logic/Configuration' END
  WHEN outcome = 'Input_URL_Invalid' THEN 'Input Data Issue' WHEN outcome LIKE 'Scraping%' OR outcome LIKE 'Pipeline%' THEN 'Website Issue' WHEN outcome LIKE 'Unknown%' THEN 'Unknown'
  WHEN outcome LIKE 'Canonical%' OR outcome = 'LLM_NoInput_NoRegexCandidates' THEN 'Pipeline Logic/Configuration' ELSE 'LLM Issue' END AS fault FROM o)
SELECT outcome, fault, count(*) AS n FROM f GROUP BY ALL
"""


def fill_rates(spark, sf_dir):
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return relations.fill_rates(d, ["text", "lang", "source", "quality", "toxic"])


FILL_RATES = """
WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)), n AS (SELECT count(*) AS n FROM d),
f AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS name, count(*) FILTER (trim(CAST({c} AS VARCHAR)) <> '') AS filled FROM d" for c in ("text", "lang", "source", "quality", "toxic")) + """)
SELECT name, filled, n AS rows, round(filled / n, 6) AS rate FROM f, n
"""


def frequencies(spark, sf_dir):
    return relations.frequencies(read(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


FREQUENCIES = " UNION ALL ".join(f"SELECT '{c}' AS name, coalesce(CAST({c} AS VARCHAR), '') AS value, count(*) AS n FROM lineitem GROUP BY 2" for c in ("l_returnflag", "l_linestatus", "l_linenumber"))


def golden_eval(spark, sf_dir):
    """Labelled documents as judged cases; the languages found stand for the partners matched."""
    cases = read(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("case_id"), F.array(F.lit("EN"), F.lit("de ")).alias("allowed"), (F.col("quality") == 0).alias("expect_no_match"))
    d = read(spark, sf_dir, "documents")
    rows = d.select(F.col("doc_id").cast("string").alias("case_id"), F.when(F.pmod("doc_id", F.lit(5)) == 0, F.lit("No suitable match found")).otherwise(F.col("lang")).alias("matched"), F.when(F.pmod("doc_id", F.lit(9)) == 0, "no_match").otherwise("strong").alias("confidence"))
    return relations.golden_eval(cases, rows)


GOLDEN_EVAL = """
WITH r AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'no suitable match found' ELSE lang END AS matched, CASE WHEN doc_id % 9 = 0 THEN 'no_match' ELSE 'strong' END AS conf, true AS seen FROM documents),
j AS (SELECT quality = 0 AS nm, coalesce(seen, false) AS seen, matched IS NULL OR matched = 'no suitable match found' OR conf = 'no_match' AS none, coalesce(matched IN ('en', 'de'), false) AS hit FROM labels LEFT JOIN r USING (doc_id)),
k AS (SELECT *, seen AND CASE WHEN nm THEN none ELSE hit END AS ok FROM j)
SELECT count(*) AS cases, count(*) FILTER (NOT seen) AS missing, count(*) FILTER (ok) AS passes, round(count(*) FILTER (ok) / count(*), 6) AS pass_rate,
       round(count(*) FILTER (seen AND nm AND none) / count(*) FILTER (seen AND nm), 6) AS no_match_recall, count(*) FILTER (seen AND nm AND NOT none) AS false_positives, count(*) FILTER (seen AND NOT nm AND NOT hit) AS false_negatives FROM k
"""


def run_metrics(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("calls"), F.round(F.sum("value"), 2).alias("tokens"), F.round(F.try_divide(F.sum("value"), F.count_if(F.col("value") > 0)), 4).alias("avg_tokens"))


RUN_METRICS = "SELECT event_type, count(*) AS calls, round(sum(value), 2) AS tokens, round(sum(value) / nullif(count(*) FILTER (value > 0), 0), 4) AS avg_tokens FROM events GROUP BY 1"


def attrition(spark, sf_dir):
    """Rows that ended without a contact, with the domain's verdict: two left joins."""
    o = _outcomes(spark, sf_dir).where("outcome <> 'Contact_Successfully_Extracted'").select("event_id", "user_id", "outcome", "fault")
    domains = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return o.join(domains, "user_id", "left").join(nations, "c_nationkey", "left").groupBy("outcome", F.coalesce("n_name", F.lit("")).alias("domain")).agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_row"))


QUERIES = {
    "orders_to_resume": (orders_to_resume, ORDERS_TO_RESUME), "overlay_stitch": (overlay_stitch, OVERLAY_STITCH), "partner_upsert": (partner_upsert, PARTNER_UPSERT),
    "completeness_gap": (completeness_gap, COMPLETENESS_GAP), "last_event": (last_event, LAST_EVENT), "cascade_join": (cascade_join, CASCADE_JOIN), "dup_stats": (dup_stats, DUP_STATS),
    "dup_flags": (dup_flags, DUP_FLAGS), "chunk_jobs": (chunk_jobs, CHUNK_JOBS), "class_order": (class_order, CLASS_ORDER), "stop_after_blanks": (stop_after_blanks, STOP_AFTER_BLANKS),
    "text_budget": (text_budget, TEXT_BUDGET), "prequalify_gate": (prequalify_gate, PREQUALIFY_GATE), "outcomes": (outcomes, OUTCOMES), "fill_rates": (fill_rates, FILL_RATES),
    "frequencies": (frequencies, FREQUENCIES), "golden_eval": (golden_eval, GOLDEN_EVAL), "run_metrics": (run_metrics, RUN_METRICS),
    "attrition": (attrition, OUTCOMES[: OUTCOMES.rindex("f AS (")].rstrip().rstrip(",").replace("SELECT event_id, CASE", "SELECT event_id, user_id, CASE") + """
SELECT outcome, coalesce(n_name, '') AS domain, count(*) AS n, min(event_id) AS first_row FROM o LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey
WHERE outcome <> 'Contact_Successfully_Extracted' GROUP BY ALL"""),
}
