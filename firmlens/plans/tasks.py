"""Queries of model tasks over the rule provider: numbers classified and ranked, partners matched."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlens.operators import completion, inference, ranking, tasks
from firmlens.plans import matching
from firmlens.plans.ranking import NUMBERS, _callable, numbers
from firmlens.plans.web import read
from firmlens.shared import shared_folder


def _empty_cache(spark):
    shared_folder(spark, "calls")  # finds the package for workers
    return spark.createDataFrame([], inference.CALLS)


def classify_numbers(spark, sf_dir):
    """Customers' numbers in chunks a nation; some answers are missing in long lists, some always."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("site"), F.concat(F.lit("+4930"), (F.col("c_custkey") + 1000000).cast("string")).alias("number"), F.lit("http://s").alias("source_url"))
    return tasks.classify_numbers(c, _empty_cache(spark), tasks.rule_provider, site="site", row="row").select("row", "type", "classification", "status", "tries")


CLASSIFY_NUMBERS = """
WITH c AS (SELECT c_custkey AS row, c_custkey % 10 AS last, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n, count(*) OVER (PARTITION BY c_nationkey) AS of FROM customer),
s AS (SELECT *, last = 8 AS gone, last = 7 AND least(10, of - 10 * ((n - 1) // 10)) > 1 AS late FROM c)
SELECT row, CASE WHEN gone THEN 'Unknown' ELSE (['Sales', 'Main Office', 'Fax', 'Unknown'])[last % 4 + 1] END AS type, CASE WHEN gone THEN 'Non-Business' ELSE (['Primary', 'Secondary', 'Non-Business'])[last % 3 + 1] END AS classification,
       CASE WHEN gone THEN 'error' ELSE 'ok' END AS status, CASE WHEN gone OR late THEN 2 ELSE 1 END AS tries FROM s
"""


def rank_numbers(spark, sf_dir):
    """Nations' numbers ranked by the provider and brought back to the callable numbers."""
    n = _callable(numbers(spark, sf_dir)).withColumn("site", F.concat(F.lit("n"), F.col("site").cast("string")))
    payload = ranking.rerank_payload(n, "site", [F.desc("c_acctbal"), F.col("k")])
    r = tasks.rank_numbers(payload, _empty_cache(spark), tasks.rule_provider, site="site")
    items = r.select("site", F.posexplode("answer.ranked_numbers").alias("pos", "i")).select("site", "pos", "i.*")
    listed = lambda c: r.select("site", F.posexplode(F.col(f"answer.{c}")).alias("pos", "number"))
    backups = r.select("site", F.col("answer.main_office_backup_number").alias("number"), F.lit("").alias("type"))
    out = ranking.outreach(n, n, items, backups, listed("deprioritized_numbers"), listed("suspected_other_org_numbers"), "site")
    return out.select("site", "number_1", "number_2", "number_3", "type_1", "main_office", "deprioritized", "other_org")


RANK_NUMBERS = f"""
WITH c AS (SELECT 'n' || site AS site, number, type, k, person, role, path, row_number() OVER (PARTITION BY site ORDER BY c_acctbal DESC, k) AS place FROM ({NUMBERS}) WHERE classification <> 'Non-Business' AND type <> 'Fax'),
p AS (SELECT * FROM c WHERE place <= 25),
r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY number DESC) AS n FROM p WHERE NOT ends_with(number, '3') AND NOT (person IS NOT NULL AND role <> 'Vertrieb' AND path = '/imprint'))
SELECT site, max(CASE WHEN n = 1 THEN number END) AS number_1, max(CASE WHEN n = 2 THEN number END) AS number_2, max(CASE WHEN n = 3 THEN number END) AS number_3, max(CASE WHEN n = 1 THEN type END) AS type_1, main_office, deprioritized, other_org
FROM (SELECT site, min(number) AS main_office, string_agg(number, '; ' ORDER BY number DESC) FILTER (ends_with(number, '5')) AS deprioritized, CAST(NULL AS VARCHAR) AS other_org FROM p GROUP BY site) LEFT JOIN r USING (site) GROUP BY ALL
"""


def match_partners(spark, sf_dir):
    """The shortlist of each document, as a provider chooses from it, and the older accept rule on that."""
    short = matching.partner_shortlist(spark, sf_dir)
    payload = completion.prompt_payload({"partner_id": F.col("partner"), "name": F.concat(F.lit("item "), F.col("partner").cast("string"))})
    s = short.select("target", "place", F.lit("prose").alias("profile"), payload.alias("payload"))
    m = tasks.match_partners(s, _empty_cache(spark), tasks.rule_provider, target="target")
    a = F.col("answer")
    ok = completion.accept_match(a["matched_partner_name"], a["match_score"], a["match_rationale_features"], a["matched_partner_id"].isNotNull(), F.lit(False))
    return m.select("target", a["matched_partner_id"].cast("long").alias("partner"), ok["accepted"].alias("accepted"), ok["reason"].alias("reason"))


MATCH_PARTNERS = f"SELECT target, partner, true AS accepted, 'accepted_high_match' AS reason FROM ({matching.PARTNER_SHORTLIST}) WHERE place = 1"

QUERIES = {"classify_numbers": (classify_numbers, CLASSIFY_NUMBERS), "rank_numbers": (rank_numbers, RANK_NUMBERS), "match_partners": (match_partners, MATCH_PARTNERS)}
