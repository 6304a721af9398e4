"""Queries of the tasks from a company's texts to a pitch, with the rule provider."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlens.functions import fixed
from firmlens.operators import enrichment, gate, inference
from firmlens.plans.matching import s_list, s_match_text, s_tokens
from firmlens.plans.web import read


def enriched(spark, sf_dir):
    """Documents as scraped texts: summary, then capacity and attributes of it, then a pitch from the attributes."""
    ask = lambda rows, task: enrichment.run_task(rows, task, templates, cache, enrichment.rule_provider)
    templates, cache = enrichment.read_templates(spark), spark.createDataFrame([], inference.CALLS)
    rows = ask(read(spark, sf_dir, "documents").select("doc_id", "text"), "summary").drop("text")
    rows = ask(ask(rows, "capacity"), "attributes")
    about = F.when(F.col("attributes_status") == "ok", enrichment.attributes_json())
    rows = rows.withColumns({"attributes_json": about, "partner_json": F.lit('{"name": "Acme"}'), "rationale": F.lit("- same trade")})
    return ask(rows, "pitch").select(
        "doc_id", F.md5("summary").alias("summary_md5"), F.col("extracted_company_name_from_summary").alias("company"), F.array_join("key_topics_mentioned", ",").alias("topics"), "is_b2b", "serves_1000_customers",
        "b2b_indicator", "industry", F.array_join("products_services_offered", ",").alias("products"), "phone_sales_line", "summary_status", "pitch_status")


ENRICHED = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(left(text, 20000), '[ \t\n\f\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, w, array_to_string(w[1:12], ' ') AS s, len(w) > 0 AS ok FROM w),
n AS (SELECT *, length(s) AS n, coalesce(w[least(12, len(w))], '') AS last FROM s)
SELECT doc_id, CASE WHEN ok THEN md5(s) END AS summary_md5, CASE WHEN ok THEN w[1] END AS company, CASE WHEN ok THEN array_to_string(w[2:4], ',') END AS topics,
       CASE WHEN ok THEN (['Yes', 'No', 'Unknown'])[n % 3 + 1] END AS is_b2b, CASE WHEN ok THEN (['No', 'Yes', 'Unknown'])[n % 3 + 1] END AS serves_1000_customers, CASE WHEN ok THEN n % 2 = 0 END AS b2b_indicator,
       CASE WHEN ok THEN last END AS industry, CASE WHEN ok THEN array_to_string(w[1:2], ',') END AS products, CASE WHEN ok THEN 'Guten Tag, es geht um ' || last || '.' END AS phone_sales_line,
       CASE WHEN ok THEN 'ok' ELSE 'no_input' END AS summary_status, CASE WHEN ok THEN 'ok' ELSE 'no_input' END AS pitch_status
FROM n
"""

QUERIES = {"enriched": (enriched, ENRICHED)}


def match_assessments(spark, sf_dir):
    """Made-up choices of a model for documents as companies, checked against short texts of both sides."""
    d = read(spark, sf_dir, "documents")
    i = F.col("doc_id")
    pick = lambda *values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(i, F.lit(len(values))) + 1).cast("int"))
    head = F.left("text", F.lit(60))
    rows = d.select(
        "doc_id", pick("Acme", "No suitable match found", "", "Beta", "Gamma").alias("matched_partner_name"), pick("strong", "medium", "odd", "no match").alias("match_confidence"), pick("hoch", "mittel", "low").alias("match_score"),
        pick("Buyer", "use-case", None, "Process", "audience + workflow", "Region").alias("overlap_type"), F.array(F.left("text", F.lit(25)), F.lit("same workflow"), F.lit("a team")).alias("match_rationale_features"),
        F.when(F.pmod(i, F.lit(2)) == 0, F.array(F.substring("text", 5, 30), F.lit("n/a"), F.lit("nothing such"))).alias("target_evidence"), F.array(F.substring("text", 20, 20)).alias("partner_evidence"),
        F.array(head, F.col("source"), F.lit("")).alias("target_texts"), F.array(F.when(F.pmod(i, F.lit(3)) > 0, head).otherwise("Acme")).alias("partner_texts"), (F.pmod(i, F.lit(11)) > 0).alias("partner_known"),
        (F.pmod(i, F.lit(8)) / 100).alias("shortlist_score"), F.when(F.pmod(i, F.lit(7)) > 0, F.array(F.lit("x"))).alias("shortlist_overlap_features"))
    out = gate.match_assessment(rows)
    return out.select("doc_id", "decision", "reason", "match_confidence", "overlap_type", F.size("target_evidence").alias("n_target"), F.size("partner_evidence").alias("n_partner"), F.md5(F.array_join(F.concat("target_evidence", "partner_evidence"), "|")).alias("evidence_md5"))


def _s_clean(c):
    return f"CASE WHEN lower({_s_squeeze(c)}) IN {s_list(fixed.MATCH_BLANKS)} THEN '' ELSE {_s_squeeze(c)} END"


def _s_squeeze(c):
    return rf"trim(regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g'))"


def _s_backed(x, texts):
    tokens, t = f"list_distinct({s_tokens(x)})", s_match_text("y")
    return f"(len({tokens}) > 0 AND len(list_filter({texts}, lambda y: {t} <> '' AND (contains({t}, {s_match_text(x)}) OR len(list_intersect({tokens}, list_distinct({s_tokens('y')}))) >= least(2, len({tokens}))))) > 0)"


def _s_side(evidence, texts):
    own = f"list_filter(list_filter(list_transform({evidence}, lambda x: {_s_clean('x')}), lambda x: x <> ''), lambda x: {_s_backed('x', texts)})"
    return f"CASE WHEN len({own}) > 0 THEN {own} ELSE (list_filter(fs, lambda x: {_s_backed('x', texts)}))[1:2] END"


_SPECIFIC = " OR ".join(f"contains(lower(x), '{m}')" for m in fixed.SPECIFIC_MARKERS)
MATCH_ASSESSMENTS = f"""
WITH d AS (SELECT doc_id, (['Acme', 'No suitable match found', '', 'Beta', 'Gamma'])[doc_id % 5 + 1] AS name, (['strong', 'medium', 'odd', 'no match'])[doc_id % 4 + 1] AS conf, (['hoch', 'mittel', 'low'])[doc_id % 3 + 1] AS score,
    (['audience', 'use_case', 'mixed', 'workflow', 'mixed', 'region'])[doc_id % 6 + 1] AS kind, list_filter([{_s_squeeze('left(text, 25)')}, 'same workflow', 'a team'], lambda x: x <> '') AS fs,
    CASE WHEN doc_id % 2 = 0 THEN [substr(text, 5, 30), 'n/a', 'nothing such'] ELSE [] END AS te, [substr(text, 20, 20)] AS pe, [left(text, 60), source, ''] AS tt, [CASE WHEN doc_id % 3 > 0 THEN left(text, 60) ELSE 'Acme' END] AS pt FROM documents),
e AS (SELECT *, {_s_side('te', 'tt')} AS t, {_s_side('pe', 'pt')} AS p FROM d),
c AS (SELECT *, CASE WHEN conf IN ('strong') THEN 'strong' WHEN conf = 'medium' THEN 'weak' WHEN conf = 'no match' THEN 'no_match' WHEN score = 'hoch' THEN 'strong' WHEN score = 'mittel' THEN 'weak' ELSE 'no_match' END AS c FROM e),
r AS (SELECT *, CASE WHEN name = '' THEN 'missing_partner_name' WHEN name = 'No suitable match found' OR c = 'no_match' THEN 'explicit_no_match' WHEN doc_id % 11 = 0 THEN 'matched_partner_data_missing'
    WHEN c = 'strong' AND len(t) > 0 AND len(p) > 0 THEN 'accepted_strong_validated_evidence' WHEN c = 'strong' AND doc_id % 8 >= 3 AND doc_id % 7 > 0 AND len(list_filter(fs, lambda x: {_SPECIFIC})) >= 1 THEN 'downgraded_strong_missing_direct_evidence'
    WHEN c = 'strong' THEN 'rejected_strong_missing_evidence' WHEN len(t) > 0 OR len(p) > 0 OR doc_id % 7 > 0 THEN 'accepted_weak_match' ELSE 'rejected_weak_missing_evidence' END AS reason FROM c),
s AS (SELECT *, reason IN ('missing_partner_name', 'explicit_no_match', 'matched_partner_data_missing') AS early FROM r)
SELECT doc_id, CASE reason WHEN 'accepted_strong_validated_evidence' THEN 'strong_match' WHEN 'downgraded_strong_missing_direct_evidence' THEN 'weak_match' WHEN 'accepted_weak_match' THEN 'weak_match' ELSE 'no_match' END AS decision, reason,
       CASE reason WHEN 'accepted_strong_validated_evidence' THEN 'strong' WHEN 'downgraded_strong_missing_direct_evidence' THEN 'weak' WHEN 'accepted_weak_match' THEN 'weak' ELSE 'no_match' END AS match_confidence,
       CASE WHEN NOT early THEN kind END AS overlap_type, CASE WHEN early THEN 0 ELSE CAST(len(t) AS INT) END AS n_target, CASE WHEN early THEN 0 ELSE CAST(len(p) AS INT) END AS n_partner,
       md5(CASE WHEN early THEN '' ELSE array_to_string(list_concat(t, p), '|') END) AS evidence_md5 FROM s
"""
QUERIES |= {"match_assessments": (match_assessments, MATCH_ASSESSMENTS)}
