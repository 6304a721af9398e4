"""Queries of sources, sinks, the model seam and incremental runs: tables written and read the way a batch run does."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlens.functions import urls
from firmlens.operators import inference, relations
from firmlens.plans.web import read
from firmlens.shared import shared_folder
from firmlens.sources import delimited, records
from firmlens.streaming import rows


def csv_scan(spark, sf_dir):
    """Customers as semicolon lists, with quotes, separators and line ends inside of values, read back by the whole loader."""
    path = shared_folder(spark, "csv")
    name = F.when(F.pmod("c_custkey", F.lit(3)) == 0, F.concat(F.lit('The "'), F.col("c_name"), F.lit('"; Inc'))).when(F.pmod("c_custkey", F.lit(3)) == 1, F.concat(F.col("c_name"), F.lit("\nand sons"))).otherwise(F.col("c_name"))
    phone = F.when(F.pmod("c_custkey", F.lit(4)) > 0, F.concat(F.lit("'030 "), (F.col("c_custkey") + 1234567).cast("string"))).otherwise("n/a")
    c = read(spark, sf_dir, "customer").select(name.alias("company"), phone.alias("PhoneNumber"), F.concat(F.lit("http://c"), F.col("c_custkey").cast("string"), F.lit(".example.com")).alias("Website"), F.col("c_mktsegment").alias("Industry"))
    c.write.options(header=True, sep=";", quote='"', escape='"', quoteAll=True).csv(path)
    t = delimited.load_companies(spark, path, phone_region="DE")
    return t.select("CompanyName", urls.host(F.col("GivenURL")).alias("host"), "Industry", "Description", F.col("NormalizedGivenPhoneNumber").alias("phone"))


CSV_SCAN = """
SELECT CASE c_custkey % 3 WHEN 0 THEN 'The "' || c_name || '"; Inc' WHEN 1 THEN c_name || chr(10) || 'and sons' ELSE c_name END AS CompanyName, 'c' || c_custkey || '.example.com' AS host,
       c_mktsegment AS Industry, '' AS Description, CASE WHEN c_custkey % 4 > 0 THEN '+4930' || (c_custkey + 1234567) END AS phone FROM customer
"""


def jsonl_last(spark, sf_dir):
    """Orders as JSON lines, some of them broken, the last line of a customer read back."""
    path = shared_folder(spark, "jsonl")
    o = read(spark, sf_dir, "orders")
    line = F.when(F.pmod("o_orderkey", F.lit(50)) == 0, F.lit('{"o_custkey": 1, "o_ord')).otherwise(F.to_json(F.struct("o_custkey", "o_orderkey", "o_orderstatus")))
    o.select(line.alias("value")).write.text(path)
    t = records.read_jsonl(spark, path, "o_custkey long, o_orderkey long, o_orderstatus string").where("o_orderkey IS NOT NULL")
    return records.last_by_row(t, "o_custkey", "o_orderkey")


JSONL_LAST = "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders WHERE o_orderkey % 50 <> 0 GROUP BY 1"


def cached_texts(spark, sf_dir):
    """Page texts of a host, newest first, up to a budget."""
    p = read(spark, sf_dir, "pages")
    files = p.select(urls.host(F.col("url")).alias("host"), F.col("url").alias("path"), F.col("page_id").alias("mtime"), F.col("html").alias("text"))
    return records.newest_texts(files).select("host", F.md5("text").alias("text_md5"), "files")


CACHED_TEXTS = r"""
WITH f AS (SELECT regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), '^www\.', '') AS host, url AS path, page_id AS mtime, html AS text FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY mtime DESC, path) AS n FROM f QUALIFY n <= 3),
t AS (SELECT host, left(string_agg(text, chr(10) ORDER BY n), 40000) AS text, count(*) AS files FROM r GROUP BY host)
SELECT host, md5(text) AS text_md5, files FROM t WHERE length(text) >= 50
"""


def model_calls(spark, sf_dir):
    """Prompts over customers by segment and nation, half of them cached, the rest to the rule provider."""
    shared_folder(spark, "calls")
    c = read(spark, sf_dir, "customer")
    prompt = inference.fill("Is {segment} in {nation} a business ?", {"segment": F.col("c_mktsegment"), "nation": F.when(F.pmod("c_nationkey", F.lit(5)) > 0, F.col("c_nationkey").cast("string"))})
    c = c.withColumn("prompt", prompt)
    cache = c.where("c_nationkey < 12").select(F.lit("b2b").alias("task"), F.sha2(F.concat_ws("\n", F.lit("b2b"), "prompt"), 256).alias("prompt_sha256"), "prompt", F.lit('{"is_b2b": "cached", "words": 0}').alias("response_text"), F.lit("ok").alias("status"), F.lit(0).cast("long").alias("tokens")).distinct()
    calls = inference.answers(inference.ask(c, cache, "b2b", inference.rule_provider), "is_b2b string, words long")
    j = c.join(calls.select("prompt", "answer"), "prompt")
    return j.groupBy(F.col("answer.is_b2b").alias("is_b2b"), F.col("answer.words").alias("words")).agg(F.count(F.lit(1)).alias("n"))


MODEL_CALLS = """
WITH c AS (SELECT c_nationkey, 'Is ' || c_mktsegment || ' in ' || CASE WHEN c_nationkey % 5 > 0 THEN CAST(c_nationkey AS VARCHAR) ELSE 'N/A' END || ' a business ?' AS prompt FROM customer),
k AS (SELECT DISTINCT prompt FROM c WHERE c_nationkey < 12),
r AS (SELECT CASE WHEN prompt IN (SELECT prompt FROM k) THEN 'cached' WHEN len(string_split(prompt, ' ')) % 2 = 0 THEN 'Yes' ELSE 'No' END AS is_b2b, CASE WHEN prompt IN (SELECT prompt FROM k) THEN 0 ELSE len(string_split(prompt, ' ')) END AS words FROM c)
SELECT is_b2b, CAST(words AS BIGINT) AS words, count(*) AS n FROM r GROUP BY ALL
"""


def stream_rows(spark, sf_dir):
    """Events through a stream into two outputs, read back."""
    target = shared_folder(spark, "stream")
    schema = read(spark, sf_dir, "events").schema
    events = rows.row_events(spark, sf_dir, schema, "events.parquet")
    rows.write_outputs(events, {"rows": lambda b: b.select("event_id", "event_type", "value"), "failed": lambda b: b.where("event_type = 'error'").select("event_id")}, target, f"{target}/checkpoint")
    kept = rows.read_output(spark, target, "rows").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))
    failed = rows.read_output(spark, target, "failed").agg(F.lit("failed").alias("event_type"), F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))
    return relations.stack(kept, failed)


STREAM_ROWS = "SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY 1 UNION ALL SELECT 'failed', count(*), max(event_id) FROM events WHERE event_type = 'error'"


def outreach_report(spark, sf_dir):
    """Match outputs (orders) onto input rows (customers) by key, the last duplicate wins, as a written CSV report."""
    path = shared_folder(spark, "report")
    out = relations.last_wins(read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority"), ["c_custkey"], "o_orderkey")
    r = read(spark, sf_dir, "customer").select("c_custkey", "c_name").join(out, "c_custkey", "left")
    r.write.option("header", True).csv(path)
    return spark.read.option("header", True).schema("c_custkey long, c_name string, o_orderkey long, o_orderpriority string").csv(path)


OUTREACH_REPORT = "SELECT c_custkey, c_name, o_orderkey, o_orderpriority FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1) ON o_custkey = c_custkey"

QUERIES = {
    "csv_scan": (csv_scan, CSV_SCAN), "jsonl_last": (jsonl_last, JSONL_LAST), "cached_texts": (cached_texts, CACHED_TEXTS), "model_calls": (model_calls, MODEL_CALLS),
    "stream_rows": (stream_rows, STREAM_ROWS), "outreach_report": (outreach_report, OUTREACH_REPORT),
}
