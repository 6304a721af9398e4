"""Delimited company lists: delimiter, row range, blank rows, header cleanup, profiles, defaults."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmlens.functions import phones
from firmlens.functions.text import blank_to_null

DELIMITERS = (",", ";", "\t", "|", ":")
#: Source column to canonical column, by profile name; names that start with _ are remarks.
PROFILES: dict[str, dict[str, str]] = {
    "default": {"Company": "CompanyName", "Website": "GivenURL", "PhoneNumber": "GivenPhoneNumber"},
    "final_80k": {"Company": "CompanyName", "Website": "GivenURL", "Company Phone": "PhoneNumber", "Combined_Description": "Combined_Description", "Industry_Category_Standardized": "Industry"},
}


def sniff_delimiter(head: str) -> str:
    """The delimiter that stands equally often in every line of the head, else the most frequent one, else a comma."""
    lines = [x for x in head.splitlines() if x.strip()][:20]
    for d in DELIMITERS:
        counts = {line.count(d) for line in lines}
        if len(counts) == 1 and counts != {0}:
            return d
    best = max(DELIMITERS, key=head.count)
    return best if head.count(best) else ","


def parse_range(text: str | None, total: int | None = None) -> tuple[int, int | None]:
    """`N-M`, `N-`, `-M`, `N` (the first N), `0` or nothing (all) as first row and last row or None, from 1.

    With total, bounds are clamped to it. What can't be read means all rows.
    """
    t = (text or "").strip()
    m = re.fullmatch(r"(\d*)\s*-\s*(\d*)", t)
    if m and (m[1] or m[2]):
        low, high = int(m[1] or 1), int(m[2]) if m[2] else None
    elif t.isdigit() and int(t):
        low, high = 1, int(t)
    else:
        low, high = 1, None
    low = max(1, low)
    if high is not None and high < low:
        low, high = 1, None
    if total is not None:
        high = min(high or total, total)
        low = min(low, max(total, 1))
    return low, high


def row_gaps(rows: DataFrame, first: int) -> DataFrame:
    """rows(row_id) with gap: how many numbers are missing right before it, from `first` on. Rows are dealt by range; a
    partition's first row follows the last one of the partitions before, of which there is a row each."""
    dealt = rows.select("row_id").repartitionByRange("row_id").withColumn("_p", F.spark_partition_id())
    dealt = dealt.withColumn("_before", F.lag("row_id").over(Window.partitionBy("_p").orderBy("row_id")))
    ends = dealt.groupBy(F.col("_p").alias("_q")).agg(F.max("row_id").alias("_end"))
    ends = ends.select("_q", F.max("_end").over(Window.orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)).alias("_end"))
    dealt = dealt.join(F.broadcast(ends), F.col("_p") == F.col("_q"))  # a row a partition
    return dealt.select("row_id", (F.col("row_id") - F.coalesce("_before", "_end", F.lit(first - 1)) - 1).alias("gap"))


def read_delimited(spark: SparkSession, path: str, *, delimiter: str | None = None, rows: str | None = None, stop_blank: int | None = 3) -> DataFrame:
    """Delimited files with a header, all columns text, with row_id from 1: the row's place in its file, files by name.

    Values may be quoted, hold doubled quotes and line ends. Rows outside the range go; with stop_blank so do blank rows,
    and all rows after so many blank ones in a row. A file is read by one task (line ends inside of quotes leave no place
    to cut it), so large lists come as several files, each with the header.
    """
    head = [r["value"] for r in spark.read.text(path).limit(20).collect()]
    delimiter = delimiter or sniff_delimiter("\n".join(head))
    options = {"sep": delimiter, "quote": '"', "escape": '"', "multiLine": True, "inferSchema": False, "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw = spark.read.options(header=True, **options).csv(path)
    header = next(csv.reader(head[:1], delimiter=delimiter), raw.columns)  # as written: the reader renames repeated names
    names = unique_names([c.removeprefix("\ufeff").strip() for c in (header if len(header) == len(raw.columns) else raw.columns)])
    # a file's rows stand together in one task and in order, so their ids count up from the file's first
    table = raw.select("*", F.col("_metadata.file_path").alias("_f"), F.monotonically_increasing_id().alias("_at")).toDF(*names, "_f", "_at")
    files = table.groupBy(F.col("_f").alias("_g")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_g", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # a row a file
    table = table.join(files, F.col("_f") == F.col("_g"))
    table = table.withColumn("row_id", F.col("_before") + F.col("_at") - F.col("_first") + 1).drop("_at", "_f", "_g", "_first", "_before")
    low, high = parse_range(rows)
    table = table.where(F.col("row_id") >= low)
    if high is not None:
        table = table.where(F.col("row_id") <= high)
    if stop_blank:
        filled = F.lit(False)
        for c in names:
            filled = filled | blank_to_null(F.col(f"`{c}`")).isNotNull()
        table = table.where(filled)
        stop = row_gaps(table, low).where(F.col("gap") >= stop_blank).agg(F.min("row_id")).first()[0]
        table = table if stop is None else table.where(F.col("row_id") < stop)
    return table.select("row_id", *[F.col(f"`{c}`") for c in names])


def count_rows(spark: SparkSession, path: str, **options) -> int:
    """Rows that read_delimited gives."""
    return read_delimited(spark, path, **options).count()


def read_partners(spark: SparkSession, path: str, renames: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """A partner table: columns renamed (in any case of the header), those of `columns` kept, as text, '' for nothing."""
    table = read_delimited(spark, path)
    by_case = {c.lower().strip(): c for c in table.columns}
    table = table.withColumnsRenamed({by_case[k.lower()]: v for k, v in renames.items() if k.lower() in by_case})
    cell = lambda c: F.coalesce(blank_to_null(F.col(f"`{c}`"), ("nan", "none", "null")), F.lit("")) if c in table.columns else F.lit("")
    return table.select("row_id", *[cell(c).alias(c) for c in columns])


def load_companies(spark: SparkSession, path: str, *, profile: str = "default", rows: str | None = None, phone_region: str | None = None) -> DataFrame:
    """The whole loader: a list by profile with its repeated columns joined, default columns added; with phone_region also
    NormalizedGivenPhoneNumber (E.164; InvalidFormat where a number can't be read, null where none is given)."""
    table = apply_profile(coalesce_repeated(read_delimited(spark, path, rows=rows)), profile, {"GivenPhoneNumber": "", "Description": ""})
    if phone_region is None:
        return table
    given = phones.strip_excel(F.col("GivenPhoneNumber"))
    return table.withColumn("NormalizedGivenPhoneNumber", F.when(given.isNotNull(), F.coalesce(phones.e164(given, phone_region), F.lit("InvalidFormat"))))


def unique_names(names: Sequence[str]) -> list[str]:
    """Repeated names get __2, __3 and so on."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}__{seen[n]}")
    return out


def coalesce_repeated(df: DataFrame) -> DataFrame:
    """Columns name, name__2, … as one: the first that isn't blank, at the first one's place."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        groups.setdefault(re.sub(r"__\d+$", "", c), []).append(c)
    quoted = lambda c: F.col(f"`{c}`")
    return df.select(*[(F.coalesce(*[blank_to_null(quoted(c)) for c in cs]) if len(cs) > 1 else quoted(cs[0])).alias(n) for n, cs in groups.items()])


def apply_profile(df: DataFrame, profile: str | Mapping[str, str] = "default", defaults: Mapping[str, str] | None = None) -> DataFrame:
    """Canonical names by profile (in any case), missing default columns added, repeated header rows dropped."""
    mapping = profile if isinstance(profile, Mapping) else PROFILES.get(profile, PROFILES["default"])
    by_case = {c.lower(): c for c in df.columns}
    renames = {by_case[k.lower()]: v for k, v in mapping.items() if not k.startswith("_") and k.lower() in by_case and v not in df.columns}
    df = df.withColumnsRenamed(renames)
    for name, value in (defaults or {}).items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value).cast("string"))
    if "CompanyName" in df.columns:
        headers = [*mapping, "CompanyName"]
        df = df.where(~F.coalesce(F.trim("CompanyName").isin(*headers), F.lit(False)))
    return df
