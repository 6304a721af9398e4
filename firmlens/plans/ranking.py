"""Queries of ranked numbers: customers stand for numbers, their nations for sites, balances for a model's ranking."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from firmlens.functions import fixed
from firmlens.operators import ranking
from firmlens.plans.web import read

_CLASSES, _TYPES, _PATHS = ("Primary", "Secondary", "Support", "Non-Business"), ("Main Line", "Sales", "Fax", "Mobile", "Direct Dial"), ("/imprint", "/contact", "/team")


def _pick(values, by: str, n: int = 1):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.floor(F.col(by) / n), F.lit(len(values))) + 1).cast("int"))


def _s_pick(values, by: str, n: int = 1) -> str:
    return "(['" + "', '".join(values) + f"'])[({by} // {n}) % {len(values)} + 1]"


def numbers(spark, sf_dir):
    """A number a customer: class, type and page by its key; every sixth has a named person."""
    c = read(spark, sf_dir, "customer").withColumn("k", F.col("c_custkey"))
    person = F.when(F.pmod("k", F.lit(6)) == 0, F.concat(F.lit("P"), F.col("k").cast("string")))
    source = F.struct(_pick(_TYPES, "k").alias("type"), F.concat(F.lit("http://n"), F.col("c_nationkey").cast("string"), F.lit(".example.com"), _pick(_PATHS, "k")).alias("original_full_url"), _pick(_PATHS, "k").alias("source_path"), person.alias("associated_person_name"), F.when(F.pmod("k", F.lit(12)) == 0, "Vertrieb").otherwise("Office").alias("associated_person_role"))
    return c.select(F.col("c_nationkey").alias("site"), F.concat(F.lit("+4930"), (F.col("k") + 100000).cast("string")).alias("number"), _pick(_CLASSES, "k", 2).alias("classification"), F.array(_pick(_TYPES, "k")).alias("types"), F.array(source).alias("sources"), "k", "c_acctbal")


NUMBERS = f"""SELECT c_nationkey AS site, '+4930' || (100000 + c_custkey) AS number, {_s_pick(_CLASSES, 'c_custkey', 2)} AS classification, {_s_pick(_TYPES, 'c_custkey')} AS type, {_s_pick(_PATHS, 'c_custkey')} AS path,
  'http://n' || c_nationkey || '.example.com' || {_s_pick(_PATHS, 'c_custkey')} AS url, CASE WHEN c_custkey % 6 = 0 THEN 'P' || c_custkey END AS person, CASE WHEN c_custkey % 12 = 0 THEN 'Vertrieb' ELSE 'Office' END AS role, c_custkey AS k, c_acctbal FROM customer"""


def _callable(n):
    return n.where((F.col("classification") != "Non-Business") & (F.col("types")[0] != "Fax"))


def outreach_numbers(spark, sf_dir):
    """Each nation's numbers as a model ranks them (by balance; some low in value, some unknown), with backup and others."""
    n = numbers(spark, sf_dir)
    k = F.col("k")
    place = F.row_number().over(Window.partitionBy("site").orderBy(F.desc("c_acctbal"), "k"))
    items = n.select("site", place.alias("pos"), F.when(F.pmod(k, F.lit(7)) == 0, F.concat("number", F.lit("9"))).otherwise(F.col("number")).alias("number"), F.when(F.pmod(k, F.lit(4)) > 0, F.col("types")[0]).otherwise(" ").alias("type"), F.when(F.pmod(k, F.lit(5)) == 0, "Low Value ").otherwise("High").alias("priority_label"), "k")
    backups = n.where(F.pmod("k", F.lit(2)) == 0).groupBy("site").agg(F.min("number").alias("number")).withColumn("type", F.lit(""))
    listed = lambda m: items.where(F.pmod("k", F.lit(m)) == 1).select("site", "pos", "number")
    return ranking.outreach(n, _callable(n), items, backups, listed(13), listed(17).unionByName(listed(34)), "site")


OUTREACH_NUMBERS = f"""
WITH n AS ({NUMBERS}), c AS (SELECT * FROM n WHERE classification <> 'Non-Business' AND type <> 'Fax'),
i AS (SELECT site, row_number() OVER (PARTITION BY site ORDER BY c_acctbal DESC, k) AS pos, CASE WHEN k % 7 = 0 THEN number || '9' ELSE number END AS number, CASE WHEN k % 4 > 0 THEN type END AS kind, k FROM n),
r AS (SELECT i.site, c.number, coalesce(i.kind, c.type) AS type, row_number() OVER (PARTITION BY i.site ORDER BY pos) AS place FROM i JOIN c ON c.site = i.site AND c.number = i.number
      WHERE i.k % 5 > 0 AND NOT ((contains(lower(coalesce(kind, '')), 'mobile') OR contains(lower(coalesce(kind, '')), 'direct') OR c.person IS NOT NULL) AND c.role <> 'Vertrieb' AND c.path = '/imprint')),
t AS (SELECT site, {", ".join(f"max(CASE WHEN place = {p} THEN {x} END) AS {x}_{p}" for p in (1, 2, 3) for x in ("number", "type"))} FROM r GROUP BY site),
b AS (SELECT b.site, c.number AS main_office, 'Main Office' AS main_office_type, c.url AS main_office_urls FROM (SELECT site, min(number) AS number FROM n WHERE k % 2 = 0 GROUP BY site) b JOIN c ON c.site = b.site AND c.number = b.number),
d AS (SELECT i.site, string_agg(i.number, '; ' ORDER BY pos) AS deprioritized FROM i JOIN c ON c.site = i.site AND c.number = i.number WHERE i.k % 13 = 1 GROUP BY i.site),
o AS (SELECT i.site, string_agg(i.number, '; ' ORDER BY pos) AS other_org FROM i JOIN c ON c.site = i.site AND c.number = i.number WHERE i.k % 17 = 1 GROUP BY i.site)
SELECT * FROM (SELECT DISTINCT site FROM n) LEFT JOIN t USING (site) LEFT JOIN b USING (site) LEFT JOIN d USING (site) LEFT JOIN o USING (site)
"""


def greedy_numbers(spark, sf_dir):
    """Three numbers a nation by slots: the best person's, a sales line, a main line, then by balance."""
    n = _callable(numbers(spark, sf_dir))
    best = n.where(F.pmod("k", F.lit(12)) == 0).groupBy("site").agg(F.min("number").alias("number"))
    return ranking.greedy_top(n, best, "site", [F.desc("c_acctbal"), F.col("k")])


GREEDY_NUMBERS = f"""
WITH c AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY c_acctbal DESC, k) AS pos FROM ({NUMBERS}) WHERE classification <> 'Non-Business' AND type <> 'Fax'),
p AS (SELECT site, arg_min(pos, number) AS p FROM c WHERE k % 12 = 0 GROUP BY site),
s AS (SELECT site, min(pos) AS s FROM c LEFT JOIN p USING (site) WHERE type = 'Sales' AND pos IS DISTINCT FROM p GROUP BY site),
m AS (SELECT site, min(pos) AS m FROM c LEFT JOIN p USING (site) LEFT JOIN s USING (site) WHERE type = 'Main Line' AND pos IS DISTINCT FROM p AND pos IS DISTINCT FROM s GROUP BY site),
r AS (SELECT site, number, row_number() OVER (PARTITION BY site ORDER BY CASE WHEN pos = p THEN 1 WHEN pos = s THEN 2 WHEN pos = m THEN 3 ELSE 4 END, pos) AS place FROM c LEFT JOIN p USING (site) LEFT JOIN s USING (site) LEFT JOIN m USING (site))
SELECT site, CAST(place AS INT) AS place, number FROM r WHERE place <= 3
"""


def primary_secondary(spark, sf_dir):
    return ranking.legacy_columns(numbers(spark, sf_dir), "site")


PRIMARY_SECONDARY = f"""
WITH s AS (SELECT *, CASE classification WHEN 'Primary' THEN 100 ELSE 80 END + CASE type WHEN 'Main Line' THEN 30 WHEN 'Fax' THEN -30 ELSE 0 END + CASE WHEN person IS NOT NULL THEN 10 ELSE 0 END AS score FROM ({NUMBERS}) WHERE classification IN ('Primary', 'Secondary')),
r AS (SELECT *, row_number() OVER (PARTITION BY site, classification ORDER BY score DESC, number) AS n FROM s)
SELECT site, max(CASE WHEN classification = 'Primary' AND n = 1 THEN number END) AS primary_1, max(CASE WHEN classification = 'Secondary' AND n = 1 THEN number END) AS secondary_1, max(CASE WHEN classification = 'Secondary' AND n = 2 THEN number END) AS secondary_2
FROM r WHERE n <= 2 GROUP BY site
"""


def snippet_evidence(spark, sf_dir):
    """Orders as sightings of their customers' numbers; comments of various lengths as snippets."""
    o = read(spark, sf_dir, "orders")
    said = F.repeat(F.concat("o_orderpriority", F.lit(" "), "o_orderstatus", F.lit(" ")), (F.pmod("o_orderkey", F.lit(25))).cast("int"))
    c = o.select(F.pmod("o_custkey", F.lit(25)).alias("site"), F.concat(F.lit(" +49"), F.col("o_custkey").cast("string")).alias("number"), said.alias("snippet"), F.concat(F.lit("http://s/"), "o_orderstatus").alias("source_url"), "o_orderkey")
    return ranking.snippet_evidence(c, "site", [F.col("o_orderkey")])


SNIPPET_EVIDENCE = """
WITH c AS (SELECT o_custkey % 25 AS site, '+49' || o_custkey AS number, trim(repeat(o_orderpriority || ' ' || o_orderstatus || ' ', CAST(o_orderkey % 25 AS INT))) AS said, 'http://s/' || o_orderstatus AS source_url, o_orderkey FROM orders),
e AS (SELECT site, number, source_url, CASE WHEN length(said) > 220 THEN rtrim(left(said, 219)) || '…' ELSE said END AS excerpt, min(o_orderkey) AS pos FROM c WHERE said <> '' GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY site, number ORDER BY pos) AS INT) AS place FROM e)
SELECT site, number, place, source_url, excerpt FROM r WHERE place <= 3
"""


def rerank_payload(spark, sf_dir):
    n = ranking.rerank_payload(_callable(numbers(spark, sf_dir)), "site", [F.desc("c_acctbal"), F.col("k")])
    kind = "number string, classification string, types_seen array<string>, evidence_sources array<struct<source_url:string,type:string,person:string>>"
    j = n.withColumn("j", F.from_json("payload", kind))
    return j.select("site", "place", "number", F.col("j.classification").alias("classification"), F.col("j.types_seen")[0].alias("type"), F.col("j.evidence_sources")[0]["source_url"].alias("url"), F.col("j.evidence_sources")[0]["person"].alias("person"))


RERANK_PAYLOAD = f"""
WITH r AS (SELECT *, CAST(row_number() OVER (PARTITION BY site ORDER BY c_acctbal DESC, k) AS INT) AS place FROM ({NUMBERS}) WHERE classification <> 'Non-Business' AND type <> 'Fax')
SELECT site, place, number, classification, type, url, person FROM r WHERE place <= 25
"""


def best_outputs(spark, sf_dir):
    """Customers' numbers as inputs, orders as a model's outputs for them: spelled the same or not, with the page or not."""
    c = read(spark, sf_dir, "customer")
    url = lambda k: F.concat(F.lit("http://P/"), F.pmod(k, F.lit(3)).cast("string"))
    inputs = c.select(F.col("c_custkey").alias("row"), F.concat(F.lit("030 "), (F.col("c_custkey") + 1000000).cast("string")).alias("number"), url("c_custkey").alias("source_url"))
    o = read(spark, sf_dir, "orders")
    k = (F.col("o_custkey") + 1000000).cast("string")
    number = F.when(F.pmod("o_orderkey", F.lit(3)) == 0, F.concat(F.lit("+4930"), k)).when(F.pmod("o_orderkey", F.lit(3)) == 1, F.concat(F.lit("030 "), k)).otherwise(F.concat(F.lit("0049 30 "), k))
    person = F.when(F.pmod("o_orderkey", F.lit(5)) == 0, "Ada").otherwise("")
    outputs = o.select(F.col("o_orderkey").alias("out_id"), number.alias("number"), F.when(F.pmod("o_orderkey", F.lit(2)) == 0, F.lower(url("o_custkey"))).alias("source_url"), (F.pmod("o_orderkey", F.lit(4)) > 0).alias("is_valid"), _pick(_CLASSES, "o_orderkey").alias("classification"), _pick(tuple(fixed.OUTPUT_TYPES), "o_orderkey").alias("type"), person.alias("person"), F.lit(None).cast("string").alias("role"))
    return ranking.best_outputs(inputs, outputs, "row").select("row", "out_id", "classification", "type", "score", "needs_retry")


_BONUS = " ".join(f"WHEN '{k}' THEN {v}" for k, v in fixed.OUTPUT_TYPES.items())
BEST_OUTPUTS = f"""
WITH o AS (SELECT o_custkey AS row, o_orderkey AS out_id, {_s_pick(_CLASSES, 'o_orderkey')} AS classification, {_s_pick(tuple(fixed.OUTPUT_TYPES), 'o_orderkey')} AS type FROM orders),
s AS (SELECT *, CASE WHEN out_id % 4 > 0 THEN 100 ELSE 0 END + CASE classification WHEN 'Primary' THEN 30 WHEN 'Secondary' THEN 10 WHEN 'Non-Business' THEN -50 ELSE 0 END + CASE type {_BONUS} ELSE 0 END + CASE WHEN out_id % 5 = 0 THEN 5 ELSE 0 END AS score FROM o),
b AS (SELECT row, arg_max({{'id': out_id, 'c': classification, 't': type, 's': score}}, (score, -out_id)) AS b FROM s GROUP BY row)
SELECT c_custkey AS row, b.id AS out_id, b.c AS classification, b.t AS type, CAST(b.s AS INT) AS score, b IS NULL AS needs_retry FROM customer LEFT JOIN b ON row = c_custkey
"""


def domain_outcomes(spark, sf_dir):
    """Users as domains, their events as pages: each domain's journey and outcome."""
    e = read(spark, sf_dir, "events")
    m = lambda n: F.pmod("event_id", F.lit(n))
    status = F.when((F.pmod("user_id", F.lit(3)) > 0) & (m(3) > 0), "Success").when(m(4) == 0, "Error_Timeout").otherwise("Timeout_404")
    d = ranking.domain_journey(e.select("user_id", "event_id", status.alias("status"), (m(5) == 0).alias("regex_found"), F.concat(F.lit("C"), F.col("event_id").cast("string")).alias("company")), "user_id", "event_id")
    u = lambda n: F.pmod("user_id", F.lit(n))
    pages = F.when(u(4) == 0, F.array().cast("array<string>")).when(u(4) == 1, F.array(F.lit("Timeout"), F.lit("DNS"))).when(u(4) == 2, F.array(F.lit("HTTP_403"), F.lit("Robots"))).otherwise(F.array(F.lit("404"), F.lit("x")))
    o = ranking.domain_outcome({"has_numbers": u(10) == 0, "status": F.col("status"), "page_statuses": pages, "regex_found": F.col("regex_found"), "pages": F.col("pages"), "llm_called": u(7) > 0, "llm_error": u(11) == 0, "n_raw": u(2)})
    return d.select("user_id", "pages", "status", "regex_found", "company", o["outcome"].alias("outcome"), o["fault"].alias("fault"))


DOMAIN_OUTCOMES = """
WITH p AS (SELECT user_id, event_id, CASE WHEN user_id % 3 > 0 AND event_id % 3 > 0 THEN 'Success' WHEN event_id % 4 = 0 THEN 'Error_Timeout' ELSE 'Timeout_404' END AS status FROM events),
d AS (SELECT user_id, count(*) AS pages, arg_max(status, (CASE WHEN status = 'Success' THEN 2 WHEN status LIKE 'Error%' THEN 0 ELSE 1 END, event_id)) AS status, bool_or(event_id % 5 = 0) AS regex_found, min('C' || event_id) AS company FROM p GROUP BY user_id),
o AS (SELECT *, CASE WHEN user_id % 10 = 0 THEN 'Contact_Successfully_Extracted_For_Domain' WHEN status <> 'Success' AND user_id % 4 = 0 THEN 'Scraping_NoPathfulURLs_Processed_ForDomain'
  WHEN status <> 'Success' AND user_id % 4 = 1 THEN 'Scraping_AllPathfulsFailed_Network_ForDomain' WHEN status <> 'Success' AND user_id % 4 = 2 THEN 'Scraping_AllPathfulsFailed_AccessDenied_ForDomain'
  WHEN status <> 'Success' THEN 'ScrapingFailed_Domain_' || status WHEN NOT regex_found THEN 'Domain_NoRegexCandidatesFound_OnAnyPage' WHEN user_id % 7 = 0 THEN 'LLM_NotCalled_DespiteRegexCandidates_ForDomain'
  WHEN user_id % 11 = 0 THEN 'LLM_Processing_Error_Encountered_For_Domain' WHEN user_id % 2 = 0 THEN 'LLM_Output_NoRawNumbersFound_ForDomain' ELSE 'LLM_Output_RawNumbersFound_NoneConsolidated_ForDomain' END AS outcome FROM d)
SELECT *, CASE WHEN outcome LIKE 'Contact%' THEN 'N/A' WHEN outcome LIKE 'Scraping%' THEN 'Website Issue' WHEN outcome LIKE 'Domain%' OR outcome LIKE 'LLM_NotCalled%' THEN 'Pipeline Logic/Configuration' ELSE 'LLM Issue' END AS fault FROM o
"""


def worker_status(spark, sf_dir):
    """Suppliers as workers of a run: how many are done, running or stalled, and the ten silent for longest."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.pmod("s_suppkey", F.lit(20)).alias("done"), F.lit(15).alias("expected"), F.pmod(F.col("s_suppkey") * 37, F.lit(1000)).alias("last_seen"))
    counts, oldest = ranking.workers(s, "s_suppkey", F.lit(1000), stalled_after=600)
    c = counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("long").alias("value")) for n in counts.columns])).alias("x")).select("x.*")
    return c.unionByName(oldest.select(F.concat(F.lit("worker "), F.col("s_suppkey").cast("string")).alias("name"), F.col("age").cast("long").alias("value")))


WORKER_STATUS = """
WITH w AS (SELECT s_suppkey, s_suppkey % 20 >= 15 AS complete, 1000 - s_suppkey * 37 % 1000 AS age FROM supplier)
SELECT 'workers' AS name, count(*) AS value FROM w UNION ALL SELECT 'completed', count(*) FROM w WHERE complete UNION ALL SELECT 'running', count(*) FROM w WHERE NOT complete AND age <= 600
UNION ALL SELECT 'stalled', count(*) FROM w WHERE NOT complete AND age > 600
UNION ALL SELECT * FROM (SELECT 'worker ' || s_suppkey, age FROM w WHERE NOT complete ORDER BY age DESC, s_suppkey LIMIT 10)
"""

QUERIES = {
    "outreach_numbers": (outreach_numbers, OUTREACH_NUMBERS), "greedy_numbers": (greedy_numbers, GREEDY_NUMBERS), "primary_secondary": (primary_secondary, PRIMARY_SECONDARY),
    "snippet_evidence": (snippet_evidence, SNIPPET_EVIDENCE), "rerank_payload": (rerank_payload, RERANK_PAYLOAD), "best_outputs": (best_outputs, BEST_OUTPUTS),
    "domain_outcomes": (domain_outcomes, DOMAIN_OUTCOMES), "worker_status": (worker_status, WORKER_STATUS),
}
