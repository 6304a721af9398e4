"""Relational operators of the batch runs: joins of repeated and partial outputs, duplicates, outcomes, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlens.functions import fixed
from firmlens.functions.text import blank_to_null, contains_any
from firmlens.operators.running import numbered, running_totals
from firmlens.shared import written


# ---------------------------------------------------------------- joins

def last_wins(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row of each key with the greatest order value; a partial aggregate runs before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def overlay(base: DataFrame, extra: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str) -> DataFrame:
    """base with blanks of columns filled from the newest extra row of the same key."""
    e = last_wins(extra.select(*keys, *columns, order), keys, order).select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    keep = [c for c in base.columns if c not in columns]
    return base.join(e, list(keys), "left").select(*keep, *[F.coalesce(blank_to_null(F.col(c).cast("string")), F.col(f"_{c}").cast("string")).alias(c) for c in columns])


def remaining(todo: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows not done yet; rows without a key stay."""
    return todo.join(done.select(*keys).distinct(), list(keys), "left_anti")


def missing_numbers(rows: DataFrame, number: str, low: int, high: int) -> DataFrame:
    """Numbers low … high that no row has."""
    all_numbers = rows.sparkSession.range(low, high + 1).select(F.col("id").alias(number))
    return all_numbers.join(rows.select(F.col(number).cast("long").alias(number)).distinct(), number, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: Column, columns: Sequence[str]) -> DataFrame:
    """old with non-blank values of new by key, and new's other rows appended."""
    o = old.select(key.alias("_k"), *[F.col(c).alias(f"o_{c}") for c in columns])
    n = new.select(key.alias("_k"), *[F.col(c).alias(f"n_{c}") for c in columns])
    joined = o.join(n, "_k", "full")
    return joined.select(*[F.coalesce(blank_to_null(F.col(f"n_{c}").cast("string")), F.col(f"o_{c}").cast("string")).alias(c) for c in columns])


def cascade(left: DataFrame, right: DataFrame, row: str, keys: Sequence[tuple[str, str]], order: str) -> DataFrame:
    """Each left row with the right row of the first key pair that matches, then the least order. One join on (level, key)."""
    pack = lambda cols: F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.col(c).cast("string").alias("key")) for i, c in enumerate(cols)]))
    a = left.select(row, pack([x for x, _ in keys]).alias("k")).select(row, "k.*").where(F.col("key").isNotNull())
    b = right.select(F.struct(*right.columns).alias("_r"), F.col(order).alias("_o"), pack([y for _, y in keys]).alias("k")).select("_r", "_o", "k.*").where(F.col("key").isNotNull())
    best = a.join(b, ["level", "key"]).groupBy(row).agg(F.min_by(F.struct("level", "_r"), F.struct("level", "_o")).alias("b"))
    return left.join(best.select(row, F.col("b.level").alias("level"), F.col("b._r").alias("matched")), row, "left")


def cached(rows: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that a response cache answers, and the others."""
    return rows.join(cache, key), rows.join(cache.select(key).distinct(), key, "left_anti")


def stack(*frames: DataFrame) -> DataFrame:
    """All rows, columns in order of first sight, missing ones null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------- duplicates and rollups

def duplicate_flags(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """rows with n_<column> (rows of the same value) and is_dup_<column>.

    Values are counted before the shuffle; only those of several rows, a short list as a rule, are joined back, sent to all
    tasks where a count shows that they are few. Null counts rows too and is no duplicate. rows is read once for each
    column and once more, so what is dear to compute is written before.
    """
    for c in columns:
        n = rows.groupBy(F.col(c).alias(f"_{c}")).agg(F.count(F.lit(1)).alias(f"n_{c}")).where(F.col(f"n_{c}") > 1)
        rows = rows.join(few(written(n, "repeated")), F.col(c).eqNullSafe(F.col(f"_{c}")), "left").drop(f"_{c}")
        rows = rows.withColumn(f"n_{c}", F.coalesce(f"n_{c}", F.lit(1).cast("long"))).withColumn(f"is_dup_{c}", (F.col(f"n_{c}") > 1) & F.col(c).isNotNull())
    return rows


def few(table: DataFrame, most: int = 100_000) -> DataFrame:
    """A written table of short values with a broadcast hint where a count shows that it is small."""
    return F.broadcast(table) if table.count() <= most else table


def duplicate_stats(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: distinct values, values on several rows, rows on those."""
    out = None
    for c in columns:
        per = rows.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        one = per.agg(F.lit(c).alias("name"), F.count(F.lit(1)).alias("distinct_values"), F.count_if(F.col("n") > 1).alias("dup_values"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("dup_rows"))
        out = one if out is None else out.unionByName(one)
    return out


def chunk_jobs(rows: DataFrame, group: str, order: list[Column], size: int = 10, most: int | None = None) -> DataFrame:
    """rows with a chunk number of `size` rows within the group, chunks over `most` left out. With a limit a task sends no more
    than that of a group; without one numbers come from running totals, so that a group may have any size."""
    if most is None:
        rows = numbered(rows, group, order)
    else:
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_n") <= most * size)
    return rows.withColumn("chunk", F.floor((F.col("_n") - 1) / size).cast("int")).drop("_n")


def stop_after_blanks(lines: DataFrame, group: str, order: str, text: str, most: int = 3) -> DataFrame:
    """Non-blank lines before the first run of `most` blank ones. Blank lines that follow as many filled ones make a run, so runs are
    counts by (group, filled lines so far), whatever a group's size."""
    filled = F.trim(F.coalesce(text, F.lit(""))) != ""
    lines = running_totals(lines, group, [F.col(order)], {"_filled": filled.cast("long")})
    runs = lines.where(~filled).groupBy(F.col(group).alias("_g"), F.col("_filled").alias("_f")).agg(F.count(F.lit(1)).alias("n"))
    stops = runs.where(F.col("n") >= most).groupBy("_g").agg(F.min("_f").alias("_stop"))
    lines = lines.where(filled).join(stops, F.col(group).eqNullSafe(F.col("_g")), "left")
    return lines.where(F.col("_stop").isNull() | (F.col("_filled") <= F.col("_stop"))).drop("_filled", "_g", "_stop")


def text_budget(rows: DataFrame, group: str, order: list[Column], text: str, budget: int) -> DataFrame:
    """Rows up to the budget of characters of each group, the last one cut. Only lengths are summed up over a group; texts behind
    the budget go before anything is joined."""
    size = F.coalesce(F.length(text).cast("long"), F.lit(0).cast("long"))
    rows = running_totals(rows, group, order, {"_upto": size}).withColumn("_before", F.col("_upto") - size).where(F.col("_before") < budget)
    return rows.withColumn(text, F.left(F.col(text), (F.lit(budget) - F.col("_before")).cast("int"))).drop("_before", "_upto")


# ---------------------------------------------------------------- gates, outcomes, profiles

def prequalify(is_b2b: Column, serves: Column) -> Column:
    """null for a row that passes (unknown capacity does), else why not."""
    return F.when(is_b2b.isNull() & serves.isNull(), "B2B_Capacity_Check_Failed").when(F.coalesce(is_b2b, F.lit("")) != "Yes", "Not_B2B").when(serves == "No", "Capacity_Under_1000")


def row_outcome(c: dict[str, Column]) -> Column:
    """Outcome of an input row. c: status, base, base_status, page_statuses (array), regex_found, has_numbers, has_bundle,
    n_raw, llm_error, has_top, rerank_requested, rerank_error."""
    every = lambda words: F.forall(c["page_statuses"], lambda s: contains_any(s, words))
    failed = c["base_status"] != "Success"
    return (
        F.when(c["status"] == "InvalidURL", "Input_URL_Invalid").when(c["status"] == "MaxRedirects_InputURL", "Pipeline_Skipped_MaxRedirects_ForInputURL")
        .when(c["has_numbers"] & c["has_top"], "Contact_Successfully_Extracted")
        .when(c["has_numbers"] & c["rerank_error"].isNotNull(), "Contact_Consolidated_RerankFailed_NoOperationalCallList")
        .when(c["has_numbers"], "Contact_Consolidated_NoOperationalCallList")
        .when(c["base"].isNull() & ~F.coalesce(c["status"], F.lit("")).isin("", "Success", "Not_Run"), F.concat(F.lit("ScrapingFailure_InputURL_"), c["status"]))
        .when(c["base"].isNull(), "Unknown_NoCanonicalURLDetermined")
        .when(failed & (F.size(c["page_statuses"]) == 0), "Scraping_NoPathfulURLs_ForCanonical")
        .when(failed & every(("Timeout", "DNS", "Network", "Unreachable")), "Scraping_AllAttemptsFailed_Network")
        .when(failed & every(("403", "AccessDenied", "Robots")), "Scraping_AllAttemptsFailed_AccessDenied")
        .when(failed & every(("404", "NotFound")), "Scraping_ContentNotFound_AllAttempts")
        .when(failed, F.concat(F.lit("ScrapingFailed_Canonical_"), c["base_status"]))
        .when(F.contains(F.coalesce(c["status"], F.lit("")), F.lit("Already_Processed")), "Canonical_Duplicate_SkippedProcessing")
        .when(~c["regex_found"], "Canonical_NoRegexCandidatesFound")
        .when(~c["has_bundle"] & c["llm_error"].isNotNull(), "LLM_Processing_Error_AllAttempts")
        .when(~c["has_bundle"], "LLM_NoInput_NoRegexCandidates")
        .when(c["n_raw"] == 0, "LLM_Output_NoNumbersFound_AllAttempts")
        .otherwise("LLM_Output_NumbersFound_NoneRelevant_AllAttempts"))


def fault(outcome: Column, rerank_requested: Column) -> Column:
    """Fault category of an outcome; N/A for a success."""
    table = F.create_map(*[F.lit(x) for kv in fixed.FAULTS.items() for x in kv])
    return (
        F.when(outcome == "Contact_Successfully_Extracted", "N/A").when(outcome == "Contact_Consolidated_RerankFailed_NoOperationalCallList", fixed.FAULTS["LLM_Reranker_NoOperationalCallList"])
        .when(outcome == "Contact_Consolidated_NoOperationalCallList", F.when(rerank_requested, fixed.FAULTS["LLM_Reranker_NoOperationalCallList"]).otherwise(fixed.FAULTS["OperationalCallList_NotExported"]))
        .when(outcome == "Unknown_NoCanonicalURLDetermined", "Unknown").when(outcome.rlike("^Scraping"), F.coalesce(table[outcome], F.lit("Website Issue"))).otherwise(F.coalesce(table[outcome], F.lit("Unknown"))))


def fill_rates(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, filled, rows, rate) of each column, in one pass."""
    counts = rows.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(blank_to_null(F.col(c).cast("string")).isNotNull()).alias(c) for c in columns])
    return counts.select("_n", F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*columns))).alias("name", "filled")).select("name", "filled", F.col("_n").alias("rows"), F.round(F.try_divide("filled", "_n"), 6).alias("rate"))


def frequencies(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, value, n) of all columns: one shuffle for all of them."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns]))
    return rows.select(pairs.alias("p")).groupBy("p.name", "p.value").agg(F.count(F.lit(1)).alias("n"))


def golden_eval(cases: DataFrame, rows: DataFrame) -> DataFrame:
    """One row of metrics of cases(case_id, allowed array, expect_no_match) against rows(case_id, matched, confidence)."""
    norm = lambda c: F.trim(F.lower(F.coalesce(c, F.lit(""))))
    j = cases.join(rows.withColumn("_seen", F.lit(True)), "case_id", "left")
    seen = F.coalesce("_seen", F.lit(False))
    none = (norm(F.col("matched")) == "") | (norm(F.col("matched")) == "no suitable match found") | (norm(F.col("confidence")) == "no_match")
    hit = F.array_contains(F.transform("allowed", norm), norm(F.col("matched")))
    ok = F.when(F.col("expect_no_match"), none).otherwise(hit) & seen
    return j.agg(
        F.count(F.lit(1)).alias("cases"), F.count_if(~seen).alias("missing"), F.count_if(ok).alias("passes"),
        F.round(F.try_divide(F.count_if(ok), F.count(F.lit(1))), 6).alias("pass_rate"),
        F.round(F.try_divide(F.count_if(seen & F.col("expect_no_match") & none), F.count_if(seen & F.col("expect_no_match"))), 6).alias("no_match_recall"),
        F.count_if(seen & F.col("expect_no_match") & ~none).alias("false_positives"), F.count_if(seen & ~F.col("expect_no_match") & ~hit).alias("false_negatives"))


# ---------------------------------------------------------------- run history

def history(runs: DataFrame, *, pipeline: str | None = None, status: str | None = None, contains: str | None = None, last: int = 20) -> DataFrame:
    """The last runs(run_id, pipeline_name, status, started_at) that fit, newest first."""
    if pipeline:
        runs = runs.where(F.col("pipeline_name") == pipeline)
    if status:
        runs = runs.where(F.col("status") == status)
    if contains:
        runs = runs.where(F.contains(F.lower("run_id"), F.lit(contains.lower())))
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(last)


def newest_completed(runs: DataFrame, by: str) -> DataFrame:
    """The newest completed run of each input."""
    done = runs.where(F.col("status") == "completed")
    return last_wins(done, [by], "started_at")


# ---------------------------------------------------------------- workers, sheets, sites

def stitch_summary(base: DataFrame, extra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(name, n): rows of either side, matched base rows, and rows of either side that the other lacks."""
    b, e, k = base.select(*keys), extra.select(*keys), list(keys)
    counts = {"base": b, "extra": e, "matched": b.join(e.distinct(), k, "left_semi"), "base_only": b.join(e.distinct(), k, "left_anti"), "extra_only": e.join(b.distinct(), k, "left_anti")}
    return stack(*[df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")) for name, df in counts.items()])


def row_jobs(rows: DataFrame, row_id: str, first: int, last: int, jobs: int) -> DataFrame:
    """Rows first … last with the number and the bounds of their job: ranges of equal length, so that workers' results are
    merged in order of rows by sorting on (job, row_id) alone."""
    size = max(1, -(-(last - first + 1) // max(1, jobs)))
    job = F.floor((F.col(row_id) - first) / size)
    rows = rows.where(F.col(row_id).between(first, last)).withColumn("job", job)
    return rows.withColumns({"first_row": first + F.col("job") * size, "last_row": F.least(F.lit(last).cast("long"), first + (F.col("job") + 1) * size - 1)})


def merge_jobs(rows: DataFrame, row_id: str, cached: Column) -> DataFrame:
    """Workers' rows (with the job of row_jobs) with their place, from 1, in the merged output: rows that a cache had first, then by job
    and row. Places come from running totals, so no task holds more than a range of the output."""
    return numbered(rows.withColumn("_all", F.lit(0)), "_all", [~cached, F.col("job"), F.col(row_id)], "place").drop("_all")


def write_back(sheet: DataFrame, results: DataFrame, keys: Sequence[str], column: str, found: str) -> DataFrame:
    """The rows of sheets with the result of the same place (of several the greatest) in an empty cell."""
    r = results.groupBy(*keys).agg(F.max(found).alias("_found"))
    return sheet.join(r, list(keys), "left").withColumn(column, F.coalesce(blank_to_null(F.col(column)), blank_to_null(F.col("_found")), F.lit(""))).drop("_found")


def sheet_summary(rows: DataFrame, sheet: str, kept: Column) -> DataFrame:
    return rows.groupBy(sheet).agg(F.count(F.lit(1)).alias("total"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))


def site_inputs(rows: DataFrame, site: str, name: str, row: str) -> DataFrame:
    """Per site its names, in order, and its input rows' number."""
    return rows.groupBy(site).agg(F.array_join(F.array_sort(F.collect_set(name)), ", ").alias("names"), F.count(row).alias("rows"))


def merge_absent(new: DataFrame, cached: DataFrame, key: str) -> DataFrame:
    """New rows, and cached ones whose key no new row has."""
    return new.unionByName(cached.join(new.select(key).distinct(), key, "left_anti"))


def only_inputs(rows: DataFrame, inputs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that share one of the keys with an input row."""
    marked = rows.withColumn("_row", F.monotonically_increasing_id()) if len(keys) > 1 else rows
    parts = [marked.join(inputs.select(k).where(F.col(k).isNotNull()).distinct(), k, "left_semi").select(*marked.columns) for k in keys]
    return parts[0] if len(parts) == 1 else stack(*parts).dropDuplicates(["_row"]).drop("_row")


def first_seen_rows(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key by order, whatever workers saw it."""
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r"))
    return best.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def failure_counts(rows: DataFrame, stage: str) -> DataFrame:
    return rows.where(F.col(stage).isNotNull()).groupBy(stage).agg(F.count(F.lit(1)).alias("n"))


def average_durations(tasks: DataFrame, task: str, seconds: str) -> DataFrame:
    """Average time of each task as text, N/A where nothing was measured."""
    mean = F.try_divide(F.sum(seconds), F.count_if(F.col(seconds) > 0))
    return tasks.groupBy(task).agg(F.when(mean.isNotNull(), F.format_string("%.2f", mean.cast("double"))).otherwise("N/A").alias("average"))
