"""What a run's rows look like: how often fields are filled, which values they have, what looks wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.functions.phones import is_fax
from firmlens.operators.relations import stack

#: Rows that an anomaly is shown by, at most.
SHOWN = 10


def _said(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))


def output_profile(rows: DataFrame, row: str = "row_id") -> DataFrame:
    """(section, name, n, share) of a run's output rows: `rows` (their number), `filled` (rows with each of seven things, and their
    share), a section for each of six fields with its values' numbers ('' for none, where the field is about the row), and
    `fax as primary` (the first SHOWN rows by `row` whose primary number is a fax line, n: their row).

    rows: Final_Row_Outcome_Reason, Determined_Fault_Category, Top_Number_1, Top_Type_1, Primary_Number_1, Primary_Type_1,
    Secondary_Number_1, RegexCandidateSnippets (array), LLMExtractedNumbers (array of struct with type, classification,
    associated_person_name), BestPersonContactName, CompanyName. Of a row's extracted numbers those up to the first with a
    person count. One pass for the rates, one for all values, which are counted before they are sent. An empty table gives a
    row: no rows.
    """
    person = lambda x: F.coalesce(F.trim(x["associated_person_name"]), F.lit("")) != ""
    items = F.coalesce("LLMExtractedNumbers", F.array().cast(dict(rows.dtypes)["LLMExtractedNumbers"]))
    at = F.array_position(F.transform(items, person), True)
    counted = F.when(at > 0, F.slice(items, F.lit(1), at.cast("int"))).otherwise(items)
    flags = {
        "Top_Number_1": _said("Top_Number_1") != "", "Primary_Number_1": _said("Primary_Number_1") != "", "Secondary_Number_1": _said("Secondary_Number_1") != "",
        "RegexCandidateSnippets": F.coalesce(F.size("RegexCandidateSnippets"), F.lit(0)) > 0, "LLMExtractedNumbers": F.size(items) > 0, "a person in LLMExtractedNumbers": at > 0, "BestPersonContactName": _said("BestPersonContactName") != "",
    }
    one = rows.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(f).alias(f"_{k}") for k, f in enumerate(flags.values())])
    share = lambda c: F.round(F.try_divide(c, F.col("_rows")), 6)
    parts = [F.struct(F.lit("rows").alias("section"), F.lit("").alias("name"), F.col("_rows").alias("n"), F.lit(None).cast("double").alias("share"))]
    parts += [F.struct(F.lit("filled").alias("section"), F.lit(name).alias("name"), F.col(f"_{k}").alias("n"), share(F.col(f"_{k}")).alias("share")) for k, name in enumerate(flags)]
    rates = one.select(F.explode(F.array(*parts)).alias("x")).select("x.*").where("section = 'rows' OR share IS NOT NULL")
    value = lambda section, c: F.struct(F.lit(section).alias("section"), c.alias("name"))
    always = [value(c, _said(c)) for c in ("Final_Row_Outcome_Reason", "Determined_Fault_Category")]
    filled = [F.when(_said(c) != "", value(c, _said(c))) for c in ("Top_Type_1", "Primary_Type_1")]
    said = lambda f: F.transform(counted, lambda x: value(f"LLM {f}", F.coalesce(F.trim(x[f]), F.lit(""))))
    of_items = [said("classification"), said("type")]
    values = rows.select(F.explode(F.concat(F.array_compact(F.array(*always, *filled)), *of_items)).alias("x")).groupBy("x.section", "x.name").agg(F.count(F.lit(1)).alias("n"))
    odd = rows.where(is_fax(F.col("Primary_Type_1"))).select(F.lit("fax as primary").alias("section"), _said("CompanyName").alias("name"), F.col(row).cast("long").alias("n")).orderBy("n", "name").limit(SHOWN)
    return stack(rates, values, odd)
