"""Reports of a run as DataFrames: what goes to call lists, attrition files and summaries. Sinks only write them."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmlens.functions import phones, urls
from firmlens.functions.text import blank_to_null, report_cell

#: Types that the short contact report leaves out, and the order of classes in the detailed one.
EXCLUDED_TYPES = ("Unknown", "Fax", "Mobile", "Date", "ID")
MAX_METRICS = 1000
CLASS_ORDER = ("Primary", "Secondary", "Support", "Low Relevance", "Non-Business")


def class_place(c: Column) -> Column:
    out = None
    for i, name in enumerate(CLASS_ORDER):
        out = F.when(c == name, i) if out is None else out.when(c == name, i)
    return out.otherwise(len(CLASS_ORDER))


def detailed(rows: DataFrame, numbers: DataFrame, site: str) -> DataFrame:
    """A row per input row and number of its site, with the place of its class."""
    return rows.join(numbers, site).withColumn("class_place", class_place(F.col("classification")))


def short_contacts(numbers: DataFrame, site: str, most: int = 3) -> DataFrame:
    """Per site up to `most` eligible numbers as text: business ones, and no type that the report leaves out."""
    left_out = F.array(*[F.lit(t) for t in EXCLUDED_TYPES])
    fine = numbers.where((F.col("classification") != "Non-Business") & ~F.arrays_overlap("types", left_out))
    said = F.struct(class_place(F.col("classification")).alias("place"), F.col("number"), F.format_string("%s (%s)", "number", F.array_join("types", ", ")).alias("said"))
    fine = fine.select(site, said.alias("_said")).withColumn("_n", F.row_number().over(Window.partitionBy(site).orderBy("_said"))).where(F.col("_n") <= most)
    out = fine.groupBy(site).agg(F.sort_array(F.collect_list("_said")).alias("top"))
    return out.select(site, F.array_join(F.transform("top", lambda x: x["said"]), "; ").alias("contacts"))


def verification(given: Column, found: Column, given_url: Column, landed_url: Column) -> Column:
    """struct(status, redirected): whether the given number is among the found ones, and whether the site's host changed."""
    g = phones.e164_any(given)
    status = F.when(phones.needs_retrieval(given), F.when(F.size(found) > 0, "Found").otherwise("Missing")).when(F.array_contains(found, g), "Verified").when(F.size(found) > 0, "Different").otherwise("Unverified")
    return F.struct(status.alias("status"), (urls.host_key(given_url) != urls.host_key(landed_url)).alias("redirected"))


def augmented(source: DataFrame, results: DataFrame, key: str, phone: str) -> DataFrame:
    """The input rows with their results; an empty phone cell takes the best number found."""
    more = [c for c in results.columns if c not in source.columns or c == key]
    out = source.join(results.select(*more), key, "left")
    best = F.col("number_1") if "number_1" in more else F.lit(None).cast("string")
    return out.withColumn(phone, F.coalesce(blank_to_null(F.col(phone)), best)).withColumns({c: report_cell(F.col(c)) for c, t in out.dtypes if t == "string" and c != phone})


def failed_rows(rows: DataFrame, stage: Column, reason: Column, run_time: str) -> DataFrame:
    """The failure log: one line a row, line ends as spaces."""
    flat = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"[\r\n]+", " ")
    return rows.select(F.lit(run_time).alias("log_timestamp"), "row_id", "CompanyName", "GivenURL", flat(stage).alias("stage_of_failure"), flat(reason).alias("error_reason"))


def metrics_markdown(metrics: DataFrame, title: str) -> str:
    """A small metrics table (name, value) as Markdown text for a report file; more than MAX_METRICS rows are an error."""
    lines = [f"# {title}", "", "| metric | value |", "| --- | --- |"]
    rows = metrics.orderBy("name").limit(MAX_METRICS + 1).collect()
    if len(rows) > MAX_METRICS:
        raise ValueError(f"more than {MAX_METRICS} metrics for one report")
    return "\n".join([*lines, *(f"| {r['name']} | {r['value']} |" for r in rows)])


def redact(text: Column, words: tuple[str, ...] = ("key", "token", "secret", "password")) -> Column:
    """Configuration text with the values of telling names masked."""
    return F.regexp_replace(text, r'(?i)("?[A-Za-z0-9_]*(' + "|".join(words) + r')[A-Za-z0-9_]*"?\s*[:=]\s*"?)[^",}\s]+', "$1***")


def run_id(now: datetime, name: str = "") -> str:
    """The name of a run that starts now: day and time, and what it is called."""
    stamp = now.strftime("%Y%m%d_%H%M%S")
    return f"{stamp}_{name}" if name else stamp


def redacted(value: object, words: tuple[str, ...] = ("key", "token", "secret", "password")) -> object:
    """A setting without the values of telling names, at any depth."""
    if isinstance(value, dict):
        return {k: "***" if any(w in str(k).lower() for w in words) and not isinstance(v, (dict, list)) else redacted(v, words) for k, v in value.items()}
    return [redacted(v, words) for v in value] if isinstance(value, list) else value


def manifest(spark: SparkSession, name: str, started: datetime, finished: datetime, *, status: str, pipeline: str, source: str, settings: dict, outputs: DataFrame) -> DataFrame:
    """One row of a run's history: when it ran, on what, with which settings (secrets masked), its output files and bytes.
    outputs: an inventory of files."""
    written = outputs.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes")).first()
    row = (name, pipeline, status, started, finished, source, json.dumps(redacted(settings), sort_keys=True), written["files"], written["bytes"])
    return spark.createDataFrame([row], "run_id string, pipeline_name string, status string, started_at timestamp, finished_at timestamp, input string, settings string, files long, bytes long")


def append_history(manifests: DataFrame, path: str) -> None:
    """Add manifests to a history of JSON lines, which `relations.history` reads."""
    manifests.write.mode("append").json(path)


def examples_markdown(rows: DataFrame, title: str, columns: Sequence[str], most: int = 20) -> str:
    """The first rows as a Markdown page: a section a row, blank values left out. `most` is the page's own limit."""
    out = [f"# {title}"]
    for i, r in enumerate(rows.select(*columns).orderBy(*columns).limit(most).collect(), 1):
        out += ["", f"## {i}", *[f"- {c}: {r[c]}" for c in columns if r[c] not in (None, "")]]
    return "\n".join(out)
