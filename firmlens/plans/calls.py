"""Queries of the last steps: who to call, what backs a match, what to say, what is cached, which runs there were."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlens.functions import phones
from firmlens.functions.text import pitch
from firmlens.operators import contacts, matching, relations
from firmlens.plans.matching import s_match_text, s_tokens
from firmlens.plans.people import _CLASSIFIED, classified
from firmlens.plans.web import read

_ROLES = ("CEO", "Vertrieb", "IT", "Hausmeister", "")


def best_person(spark, sf_dir):
    """Each source's best contact among the numbers of its documents, with made-up names and roles by document."""
    role = F.element_at(F.array(*[F.lit(r) for r in _ROLES]), (F.pmod("doc_id", F.lit(5)) + 1).cast("int"))
    c = classified(spark, sf_dir).withColumns({"associated_person_name": F.when(F.pmod("doc_id", F.lit(3)) == 0, "null").otherwise(F.concat(F.lit("P"), F.col("doc_id").cast("string"))), "associated_person_role": role, "is_direct_dial": F.pmod("doc_id", F.lit(2)) == 0})
    n = contacts.consolidate(c, "source", ["doc_id", "pos"])
    return contacts.best_person(contacts.person_contacts(n, "source"), "source")


BEST_PERSON = f"""
WITH c AS (SELECT *, CASE WHEN doc_id % 3 > 0 THEN 'P' || doc_id END AS name, nullif((['CEO', 'Vertrieb', 'IT', 'Hausmeister', ''])[doc_id % 5 + 1], '') AS role, doc_id % 2 = 0 AS direct FROM ({_CLASSIFIED})),
d AS (SELECT *, arg_min(classification, (prio, doc_id, pos)) OVER (PARTITION BY source, number) AS cls FROM c QUALIFY row_number() OVER (PARTITION BY source, number, source_url, type ORDER BY doc_id, pos) = 1),
s AS (SELECT *, CASE WHEN direct THEN 40 ELSE 0 END + CASE role WHEN 'CEO' THEN 100 WHEN 'Vertrieb' THEN 80 WHEN 'IT' THEN 50 WHEN 'Hausmeister' THEN -50 ELSE 0 END
        + CASE lower(cls) WHEN 'primary' THEN 20 WHEN 'secondary' THEN 10 ELSE 0 END AS score FROM d WHERE lower(cls) <> 'non-business' AND NOT contains(lower(type), 'fax') AND (name IS NOT NULL OR direct)),
b AS (SELECT source, arg_max({{'name': name, 'role': role, 'number': number, 'score': score}}, (score, number)) AS b FROM s GROUP BY source)
SELECT source, b.name AS name, b.role AS role, b.number AS number, CAST(b.score AS INT) AS score FROM b WHERE b.score >= 90
"""


def diagnostic_rank(spark, sf_dir):
    n = contacts.consolidate(classified(spark, sf_dir), "source", ["doc_id", "pos"])
    score = contacts.diagnostic_score(F.col("classification"), F.col("types"), F.lit(False))
    return n.select("source", "number", score.cast("int").alias("score"), F.exists("types", phones.is_fax).alias("fax"))


DIAGNOSTIC_RANK = f"""
SELECT source, number, CAST(CASE lower(arg_min(classification, (prio, doc_id, pos))) WHEN 'primary' THEN 100 WHEN 'secondary' THEN 80 WHEN 'support' THEN 50 ELSE 0 END
  + CASE WHEN bool_or(lower(type) IN ('main line', 'mainline', 'zentrale', 'headquarters')) THEN 30 ELSE 0 END - CASE WHEN bool_or(contains(lower(type), 'fax')) THEN 30 ELSE 0 END AS INT) AS score, bool_or(contains(lower(type), 'fax')) AS fax
FROM ({_CLASSIFIED}) GROUP BY source, number
"""


def evidence_support(spark, sf_dir):
    """Whether a document backs the benchmark item with its number, and whether the item backs the document's source name."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source")
    b = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("item"))
    j = d.join(b, "doc_id", "left").withColumn("item", F.coalesce("item", F.lit("")))
    backed = lambda e, *ts: matching.supported(F.col(e), F.array(*[F.col(t) for t in ts]))
    return j.select("doc_id", backed("item", "text").alias("backed"), backed("source", "item", "text").alias("source_backed"))


def _backed(texts):
    tests = [f"({s_match_text(t)} <> '' AND (contains({s_match_text(t)}, e) OR len(list_intersect(ts, list_distinct({s_tokens(t)}))) >= least(2, len(ts))))" for t in texts]
    return "len(ts) > 0 AND (" + " OR ".join(tests) + ")"


EVIDENCE_SUPPORT = f"""
WITH j AS (SELECT d.doc_id, coalesce(d.text, '') AS text, d.source, coalesce(b.text, '') AS item FROM documents d LEFT JOIN benchmark b ON item_id = doc_id),
i AS (SELECT *, {s_match_text('item')} AS e, list_distinct({s_tokens('item')}) AS ts FROM j),
k AS (SELECT doc_id, source, item, text, {_backed(['text'])} AS backed FROM i),
l AS (SELECT *, {s_match_text('source')} AS e, list_distinct({s_tokens('source')}) AS ts FROM k)
SELECT doc_id, backed, {_backed(['item', 'text'])} AS source_backed FROM l
"""


def pitch_lines(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    decision = F.element_at(F.array(F.lit("strong_match"), F.lit("weak_match"), F.lit("no_match")), (F.pmod("s_suppkey", F.lit(3)) + 1).cast("int"))
    features = F.when(F.pmod("s_suppkey", F.lit(2)) == 0, F.array(F.lit("reach"), F.lit("price"))).otherwise(F.array().cast("array<string>"))
    return s.select("s_suppkey", pitch(decision, F.lit("Acme"), F.col("s_name"), features, F.col("s_nationkey") / 4.0).alias("line"))


PITCH_LINES = r"""
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 AND s_suppkey % 2 = 0 THEN 'Acme fits ' || s_name || ': reach, price (' || regexp_replace(regexp_replace(printf('%.2f', s_nationkey / 4.0::DOUBLE), '0+$', ''), '\.$', '') || ' leads a day)'
  WHEN s_suppkey % 3 < 2 THEN 'Would ' || s_name || ' be of use to Acme?' END AS line FROM supplier
"""


def response_cache(spark, sf_dir):
    """Orders whose customer and status an urgent order has had answered, and the others."""
    o = read(spark, sf_dir, "orders").withColumn("key", F.sha1(F.concat_ws("|", F.col("o_custkey").cast("string"), "o_orderstatus").cast("binary")))
    cache = o.where("o_orderpriority = '1-URGENT'").groupBy("key").agg(F.max("o_orderkey").alias("answer"))
    hits, misses = relations.cached(o, cache, "key")
    return relations.stack(hits.agg(F.lit("hit").alias("kind"), F.count(F.lit(1)).alias("n"), F.max("answer").alias("last")), misses.agg(F.lit("miss").alias("kind"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("last")))


RESPONSE_CACHE = """
WITH c AS (SELECT o_custkey, o_orderstatus, max(o_orderkey) AS answer FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL),
j AS (SELECT answer FROM orders LEFT JOIN c USING (o_custkey, o_orderstatus))
SELECT CASE WHEN answer IS NULL THEN 'miss' ELSE 'hit' END AS kind, count(*) AS n, max(answer) AS last FROM j GROUP BY 1
"""


def run_history(spark, sf_dir):
    """Orders as runs: each customer's newest completed one."""
    o = read(spark, sf_dir, "orders")
    runs = o.select(F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_custkey").alias("input"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("status"), F.col("o_orderkey").alias("started_at"), F.lit("p").alias("pipeline_name"))
    return relations.newest_completed(runs, "input").select("input", "run_id", "started_at")


RUN_HISTORY = "SELECT o_custkey AS input, CAST(max(o_orderkey) AS VARCHAR) AS run_id, max(o_orderkey) AS started_at FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"

QUERIES = {
    "best_person": (best_person, BEST_PERSON), "diagnostic_rank": (diagnostic_rank, DIAGNOSTIC_RANK), "evidence_support": (evidence_support, EVIDENCE_SUPPORT),
    "pitch_lines": (pitch_lines, PITCH_LINES), "response_cache": (response_cache, RESPONSE_CACHE), "run_history": (run_history, RUN_HISTORY),
}
