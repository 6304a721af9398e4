"""Queries of workbooks, keyed caches and numbering plans."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from firmlens.operators import numbering, outreach, profile
from firmlens.plans.web import read
from firmlens.shared import shared_folder, written
from firmlens.sources import workbook
from firmlens.sources.cache import KeyedCache


def _phone():
    return F.concat(F.lit("+49 30 "), (F.col("c_custkey") + 1_000_000).cast("string"))


def _sheets(spark, sf_dir):
    """Customers as rows of workbooks: a file for each region and 20,000 customers, a sheet for each nation, of which every other
    has a fourth column. A nation's customers of a file are few enough for a sheet."""
    where = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = read(spark, sf_dir, "customer").join(F.broadcast(where.select("n_nationkey", "n_name", "r_name")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows
    file = F.concat("r_name", F.lit("-"), F.floor(F.col("c_custkey") / 20_000).cast("string"), F.lit(".xlsx"))
    cells = [F.col("c_name"), F.when(F.pmod("c_custkey", F.lit(7)) > 0, F.concat(F.lit("http://c"), F.col("c_custkey").cast("string"), F.lit(".example.com?a=1&b=<2>"))), F.when(F.pmod("c_custkey", F.lit(3)) > 0, _phone())]
    wide = F.pmod("c_nationkey", F.lit(2)) == 1
    c = c.select(file.alias("file"), F.col("n_name").alias("sheet"), F.col("c_nationkey").cast("int").alias("sheet_no"), "c_custkey", F.when(wide, F.array(*cells, "c_mktsegment")).otherwise(F.array(*cells)).alias("cells"))
    rows = c.withColumn("row_no", F.row_number().over(Window.partitionBy("file", "sheet").orderBy("c_custkey")).cast("long") + 1)
    names = [F.lit(x) for x in ("Name", "Website", "Phone")]
    head = c.select("file", "sheet", "sheet_no").distinct().withColumns({"row_no": F.lit(1).cast("long"), "cells": F.when(F.pmod("sheet_no", F.lit(2)) == 1, F.array(*names, F.lit("Industry"))).otherwise(F.array(*names)), "c_custkey": F.lit(None).cast("long")})
    return rows.unionByName(head)


_PLACED = """
WITH c AS (SELECT *, r_name || '-' || (c_custkey // 20000) || '.xlsx' AS f FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
p AS (SELECT *, row_number() OVER (PARTITION BY f, n_name ORDER BY c_custkey) + 1 AS n FROM c)
"""


def workbook_union(spark, sf_dir):
    """Customers written as workbooks, and all sheets of all files read back as one table; rows without a website go."""
    folder = shared_folder(spark, "workbooks")
    workbook.write_workbooks(_sheets(spark, sf_dir), folder)
    return workbook.union_sheets(written(workbook.sheet_rows(spark, folder), "rows"))


WORKBOOK_UNION = f"""{_PLACED}
SELECT f AS SourceWorkbook, n_name AS SourceSheet, n AS SourceSheetRowNumber, c_name AS Name, 'http://c' || c_custkey || '.example.com?a=1&b=<2>' AS Website,
       CASE WHEN c_custkey % 3 > 0 THEN '+49 30 ' || (c_custkey + 1000000) ELSE '' END AS Phone, CASE WHEN c_nationkey % 2 = 1 THEN c_mktsegment END AS Industry FROM p WHERE c_custkey % 7 > 0
"""


def workbook_back(spark, sf_dir):
    """The last order of each customer appended to its row of the sheets, and put into the third column where that is empty."""
    folder, target = shared_folder(spark, "workbooks"), shared_folder(spark, "written-back")
    workbook.write_workbooks(_sheets(spark, sf_dir), folder)
    last = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("Order"))
    found = _sheets(spark, sf_dir).join(last, "c_custkey").select("file", "sheet", "row_no", "Order", F.when(F.pmod("c_custkey", F.lit(3)) == 0, F.concat(F.lit("#"), F.col("Order").cast("string"))).alias("Phone"))
    raw = written(workbook.sheet_rows(spark, folder), "rows")  # sheets are read once, not for each of the joins
    workbook.write_workbooks(workbook.append_columns(workbook.set_column(raw, found.where("Phone IS NOT NULL"), 2, "Phone"), found, ["Order"]), target)
    out = workbook.union_sheets(written(workbook.sheet_rows(spark, target), "rows"), website=None)
    return out.select("SourceWorkbook", "SourceSheet", "SourceSheetRowNumber", "Name", "Phone", "Industry", "Order")


WORKBOOK_BACK = f"""{_PLACED},
o AS (SELECT o_custkey, CAST(max(o_orderkey) AS VARCHAR) AS last FROM orders GROUP BY 1)
SELECT f AS SourceWorkbook, n_name AS SourceSheet, n AS SourceSheetRowNumber, c_name AS Name, CASE WHEN c_custkey % 3 > 0 THEN '+49 30 ' || (c_custkey + 1000000) ELSE coalesce('#' || last, '') END AS Phone,
       CASE WHEN c_nationkey % 2 = 1 THEN c_mktsegment END AS Industry, coalesce(last, '') AS "Order" FROM p LEFT JOIN o ON o_custkey = c_custkey
"""


def keyed_cache(spark, sf_dir):
    """Orders put into a cache by customer in ten writes, by order number, so that it puts itself together on the way; looked up
    for all customers."""
    cache = KeyedCache(spark, shared_folder(spark, "cache"), ["c_custkey"], "c_custkey long, o_orderkey long, o_orderstatus string")
    orders = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    for n in range(10):
        cache.put(orders.where(F.pmod("o_orderkey", F.lit(10)) == n))
    hits, misses = cache.look_up(read(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    return hits.unionByName(misses, allowMissingColumns=True)


KEYED_CACHE = """
WITH l AS (SELECT o_custkey, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 10 DESC, o_orderkey DESC) AS n FROM orders)
SELECT c_custkey, c_name, o_orderkey, o_orderstatus FROM customer LEFT JOIN l ON o_custkey = c_custkey AND n = 1
"""

_BEGINS = ("+4930", "+49151", "+49800", "+49900", "+49 137 ", "+4366", "+43676", "+41 79 ", "+4122", "+4", "+331", "")


def number_plan(spark, sf_dir):
    """Numbers of many lengths by the longest prefix of a plan."""
    begin = F.element_at(F.array(*[F.lit(x) for x in _BEGINS]), (F.pmod("c_custkey", F.lit(len(_BEGINS))) + 1).cast("int"))
    rest = F.repeat(F.pmod("c_custkey", F.lit(10)).cast("string"), F.pmod(F.floor(F.col("c_custkey") / len(_BEGINS)), F.lit(13)).cast("int"))
    c = read(spark, sf_dir, "customer").select("c_custkey", F.when(F.pmod("c_custkey", F.lit(50)) > 0, F.concat(begin, rest)).alias("number"))
    out = numbering.number_kinds(c, spark.createDataFrame(list(numbering.DACH), numbering.PLAN), key="c_custkey", number="number")
    return out.withColumn("impossible", numbering.impossible(F.col("possibility")))


NUMBER_PLAN = f"""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 50 > 0 THEN ([{', '.join(f"'{x}'" for x in _BEGINS)}])[c_custkey % {len(_BEGINS)} + 1] || repeat(CAST(c_custkey % 10 AS VARCHAR), CAST(c_custkey // {len(_BEGINS)} % 13 AS BIGINT)) END AS number FROM customer),
d AS (SELECT *, nullif(regexp_replace(number, '[^0-9]', '', 'g'), '') AS digits FROM c),
p(prefix, country, kind, shortest, longest) AS (VALUES {', '.join(map(str, numbering.DACH))}),
m AS (SELECT d.*, p.*, row_number() OVER (PARTITION BY c_custkey ORDER BY length(prefix) DESC) AS r FROM d LEFT JOIN p ON starts_with(digits, prefix)),
l AS (SELECT *, length(digits) - CASE WHEN digits[1:2] IN ('49', '43', '41') THEN 2 ELSE 0 END AS n FROM m WHERE r = 1),
k AS (SELECT c_custkey, number, country, kind, CASE WHEN digits IS NULL THEN NULL WHEN prefix IS NULL THEN 'unknown' WHEN n < shortest THEN 'too_short' WHEN n > longest THEN 'too_long' ELSE 'possible' END AS possibility FROM l)
SELECT *, coalesce(possibility IN ('too_short', 'too_long'), FALSE) AS impossible FROM k
"""

QUERIES = {
    "workbook_union": (workbook_union, WORKBOOK_UNION), "workbook_back": (workbook_back, WORKBOOK_BACK), "keyed_cache": (keyed_cache, KEYED_CACHE), "number_plan": (number_plan, NUMBER_PLAN),
}


def sales_report(spark, sf_dir):
    """Orders as match outputs of the companies behind their customers, pairs of which share an address, written as a CSV report and
    read back."""
    path = shared_folder(spark, "sales-report")
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    site = lambda k: F.concat(F.lit("http://c"), F.floor(k / 2).cast("string"), F.lit(".example.com"))
    k = F.col("c_custkey")
    inputs = c.select(
        k.alias("row_id"), F.when(F.pmod(k, F.lit(9)) > 0, site(k)).alias("GivenURL"), F.col("c_name").alias("CompanyName"), F.when(F.pmod(k, F.lit(3)) == 0, _phone()).otherwise(" ").alias("PhoneNumber"),
        F.lit("n").alias("Number"), F.col("c_mktsegment").alias("Industry"), F.col("c_name").alias("Description"), F.lit("+49 1").alias("Top_Number_1"))
    odd = F.pmod("o_orderkey", F.lit(2)) == 1
    outputs = o.select(
        site(F.col("o_custkey") * 2).alias("analyzed_company_url"), F.when(odd, F.col("o_orderpriority")).alias("summary"), F.lit("Ruf an: {programmatic placeholder} Leads").alias("phone_sales_line"),
        F.when(odd, F.floor(F.col("o_orderkey") / 4) + F.when(F.pmod("o_orderkey", F.lit(4)) == 1, 0.5).otherwise(0.25)).alias("avg_leads_per_day"), F.col("o_orderkey").alias("rank"), F.col("o_orderstatus").alias("matched_partner_name"),
        F.array("o_orderstatus", "o_orderpriority").alias("match_rationale_features"), odd.alias("b2b_indicator"), F.when(odd, F.lit("Trade")).alias("industry"))
    outreach.sales_report(outputs, inputs).write.options(header=True, quote='"', escape='"', emptyValue="").csv(path)
    report = spark.read.options(header=True, quote='"', escape='"').csv(path)  # empty cells are null again
    return report.select(F.col("Rank").cast("long").alias("order_no"), *[F.col(f"`{n}`").alias(a) for n, a in _SALES.items()], F.lit(len(report.columns)).alias("n_columns"))


_SALES = {"Company Name": "company", "Original_Number": "number", "URL": "url", "Top_Number_1": "top", "CanonicalEntryURL": "entry", "sales_pitch": "pitch", "Short German Description": "description", "matched_golden_partner": "partner", "match_reasoning": "reasoning", "Industry": "industry", "B2B Indicator": "b2b", "Business Model": "model", "Original Row Number": "row_number"}
SALES_REPORT = """
WITH i AS (SELECT 'http://c' || (c_custkey // 2) || '.example.com' AS site, c_custkey AS k, c_name, c_mktsegment, row_number() OVER (PARTITION BY c_custkey // 2 ORDER BY c_custkey DESC) AS n FROM customer WHERE c_custkey % 9 > 0),
o AS (SELECT *, 'http://c' || o_custkey || '.example.com' AS url, o_orderkey % 2 = 1 AS odd, o_orderkey // 4 + CASE WHEN o_orderkey % 4 = 1 THEN 0.5 ELSE 0.25 END AS leads FROM orders)
SELECT o_orderkey AS order_no, c_name AS company, CASE WHEN k % 3 = 0 THEN '+49 30 ' || (k + 1000000) WHEN k IS NOT NULL THEN 'n' END AS number, url, CASE WHEN k IS NOT NULL THEN '+49 1' END AS top, CAST(NULL AS VARCHAR) AS entry,
       'Ruf an: ' || CASE WHEN odd THEN CAST(CAST(round_even(leads, 0) AS BIGINT) AS VARCHAR) ELSE '{programmatic placeholder}' END || ' Leads' AS pitch, CASE WHEN odd THEN o_orderpriority ELSE c_name END AS description,
       o_orderstatus AS partner, o_orderstatus || '; ' || o_orderpriority AS reasoning, CASE WHEN odd THEN 'Trade' ELSE c_mktsegment END AS industry, CASE WHEN odd THEN 'True' END AS b2b, CAST(NULL AS VARCHAR) AS model,
       CAST(k + 1 AS VARCHAR) AS row_number, 65 AS n_columns
FROM o LEFT JOIN i ON i.site = o.url AND i.n = 1
"""
QUERIES |= {"sales_report": (sales_report, SALES_REPORT)}


def output_profile(spark, sf_dir):
    """Customers as a run's rows."""
    k = F.col("c_custkey")
    m = lambda n: F.pmod(k, F.lit(n))
    item = lambda kind, cls, who: F.struct(F.lit(kind).alias("type"), F.lit(cls).alias("classification"), who.alias("associated_person_name"))
    nobody = F.lit(None).cast("string")
    rows = read(spark, sf_dir, "customer").select(
        k.alias("row_id"), F.col("c_name").alias("CompanyName"), F.col("c_mktsegment").alias("Final_Row_Outcome_Reason"), F.when(m(3) == 0, "Website Issue").alias("Determined_Fault_Category"),
        F.when(m(2) == 0, "+49").alias("Top_Number_1"), F.when(m(4) == 0, "Sales").when(m(4) == 2, " ").alias("Top_Type_1"), F.when(m(5) > 0, "+49").alias("Primary_Number_1"), F.when(m(50) == 1, "Fax line").when(m(5) > 1, "Main").alias("Primary_Type_1"),
        F.lit(" ").alias("Secondary_Number_1"), F.when(m(6) == 0, F.array(F.lit("x"))).alias("RegexCandidateSnippets"),
        F.when(m(7) > 0, F.array(item("Sales", "Primary", nobody), item("Main", "Secondary", F.when(m(3) == 0, "Ada")), item("Fax", "Support", nobody))).alias("LLMExtractedNumbers"), F.when(m(9) == 0, "Ada").alias("BestPersonContactName"))
    return profile.output_profile(rows)


_FLAGS = {"Top_Number_1": "k % 2 = 0", "Primary_Number_1": "k % 5 > 0", "Secondary_Number_1": "FALSE", "RegexCandidateSnippets": "k % 6 = 0", "LLMExtractedNumbers": "k % 7 > 0", "a person in LLMExtractedNumbers": "k % 7 > 0 AND k % 3 = 0", "BestPersonContactName": "k % 9 = 0"}
OUTPUT_PROFILE = """
WITH c AS (SELECT c_custkey AS k, c_name, c_mktsegment FROM customer), n AS (SELECT count(*) AS n FROM c)
SELECT 'rows' AS section, '' AS name, n, CAST(NULL AS DOUBLE) AS share FROM n
""" + "".join(f"UNION ALL SELECT 'filled', '{name}', (SELECT count(*) FROM c WHERE {when}), round((SELECT count(*) FROM c WHERE {when}) / n, 6) FROM n\n" for name, when in _FLAGS.items()) + """
UNION ALL SELECT 'Final_Row_Outcome_Reason', c_mktsegment, count(*), NULL FROM c GROUP BY 2
UNION ALL SELECT 'Determined_Fault_Category', CASE WHEN k % 3 = 0 THEN 'Website Issue' ELSE '' END, count(*), NULL FROM c GROUP BY 2
UNION ALL SELECT 'Top_Type_1', 'Sales', count(*), NULL FROM c WHERE k % 4 = 0 HAVING count(*) > 0
UNION ALL SELECT 'Primary_Type_1', CASE WHEN k % 50 = 1 THEN 'Fax line' ELSE 'Main' END, count(*), NULL FROM c WHERE k % 50 = 1 OR k % 5 > 1 GROUP BY 2
UNION ALL SELECT 'LLM type', x.t, count(*), NULL FROM c, (VALUES ('Sales'), ('Main'), ('Fax')) x(t) WHERE k % 7 > 0 AND (t <> 'Fax' OR k % 3 > 0) GROUP BY 2
UNION ALL SELECT 'LLM classification', x.t, count(*), NULL FROM c, (VALUES ('Primary'), ('Secondary'), ('Support')) x(t) WHERE k % 7 > 0 AND (t <> 'Support' OR k % 3 > 0) GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'fax as primary', c_name, k, NULL FROM c WHERE k % 50 = 1 ORDER BY k LIMIT 10)
"""
QUERIES |= {"output_profile": (output_profile, OUTPUT_PROFILE)}
