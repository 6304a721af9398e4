"""From texts to call lists: candidates, caps, consolidation by domain, ranked numbers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmlens.functions import fixed, phones, urls
from firmlens.functions.text import contains_any
from firmlens.shared import find_package

#: Characters of snippets that a step gives on at a time.
FOUND_CHARS = 4_000_000
SOURCE_FIELDS = ("type", "source_path", "original_full_url", "original_input_company_name", "associated_person_name", "associated_person_role", "associated_person_department", "is_direct_dial")


def candidates(texts: DataFrame, *, text: str = "text", pattern: str = phones.CANDIDATE, region: str = "US", window: int = 150) -> DataFrame:
    """A row per phone-like run of each text: its columns but the text, pos, raw, number, national, start and snippet.

    Runs are found in an Arrow step that reads a text once, from run to run, so a text's cost grows with its length, not with
    runs by length; numbers are columns. The snippet reaches `window` characters to either side, on to the next space. Dates,
    stand-ins and malformed numbers go.
    """
    find_package(texts.sparkSession)
    others = [f for f in texts.schema.fields if f.name != text]
    run_of = re.compile(pattern)

    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            rows, size = [], 0
            for at in range(frame.num_rows):
                t = frame.column(frame.num_columns - 1)[at].as_py()
                for pos, m in enumerate(run_of.finditer(t)):
                    low, high = max(0, m.start() - window), m.end() + window
                    space = t.find(" ", high)
                    snippet = t[t.rfind(" ", 0, low) + 1 : space if space >= 0 else len(t)].strip(" ")
                    rows.append((at, pos, m[0].strip(" "), m.start(), snippet))
                    size += len(snippet)
                    if size > FOUND_CHARS:
                        yield found(frame, rows)
                        rows, size = [], 0
            yield found(frame, rows)

    def found(frame: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        at, pos, raw, start, snippet = zip(*rows, strict=True) if rows else ((),) * 5
        at = pa.array(at, pa.int64())
        columns = [*(c.take(at) for c in frame.columns[:-1]), pa.array(pos, pa.int32()), pa.array(raw, pa.string()), pa.array(start, pa.int32()), pa.array(snippet, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in others), "pos", "raw", "start", "snippet"])

    more = [("pos", T.IntegerType()), ("raw", T.StringType()), ("start", T.IntegerType()), ("snippet", T.StringType())]
    schema = T.StructType([*others, *[T.StructField(name, kind) for name, kind in more]])
    t = texts.where(F.col(text).rlike(pattern)).select(*[f"`{f.name}`" for f in others], text).mapInArrow(find, schema)
    t = t.withColumn("number", phones.e164(F.col("raw"), region)).where("number IS NOT NULL")
    t = t.withColumn("national", phones.national(F.col("number"))).where(phones.valid(F.col("raw"), F.col("national")))
    return t.select(*[f"`{f.name}`" for f in others], "pos", "raw", "start", "number", "national", "snippet")


def cap_per_page(rows: DataFrame, page: list[str], number: str, order: list[Column], most: int = 3) -> DataFrame:
    """At most so many rows of one number on a page, the first ones."""
    w = Window.partitionBy(*page, number).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def rank_and_cap(rows: DataFrame, site: str, order: list[Column], *, url: str = "source_url", most: int = 120, min_score: int = 0) -> DataFrame:
    """Candidates of a site by score (path keyword 100, snippet keyword 30, 10 a sighting up to 50), once a (number, url),
    the best `most`; rows under min_score go unless all would."""
    counts = rows.groupBy(F.col(site).alias("_site"), F.col("number").alias("_number")).agg(F.count(F.lit(1)).alias("_seen"))
    rows = rows.join(counts, F.col(site).eqNullSafe(F.col("_site")) & F.col("number").eqNullSafe(F.col("_number")))
    seen = F.col("_seen")
    score = (
        F.when(contains_any(F.lower(url), fixed.CANDIDATE_PATHS), 100).otherwise(0) + F.when(contains_any(F.lower("snippet"), fixed.SNIPPET_KEYWORDS), 30).otherwise(0)
        + F.least(F.lit(50), seen * 10))
    rows = rows.withColumn("score", score.cast("int")).drop("_site", "_number", "_seen")
    first = F.row_number().over(Window.partitionBy(site, "number", url).orderBy(*order))
    rows = rows.withColumn("_first", first).where("_first = 1").drop("_first")
    if min_score > 0:
        best = rows.groupBy(F.col(site).alias("_site")).agg(F.max("score").alias("_best"))
        rows = rows.join(best, F.col(site).eqNullSafe(F.col("_site"))).where((F.col("score") >= min_score) | (F.col("_best") < min_score)).drop("_site", "_best")
    place = F.row_number().over(Window.partitionBy(site).orderBy(F.desc("score"), *order))
    return rows.withColumn("place", place).where(F.col("place") <= most)


def consolidate(rows: DataFrame, site: str, order: list[str]) -> DataFrame:
    """One row for each number of a site: best classification, its sources (once a (url, type), in first-seen order), types.

    The classification is that of the least (classification, type) priority over all its rows, which doesn't depend on
    the order of rows. Sources keep the order columns, so the result is the same however rows are dealt out.
    """
    kept = [c for c in SOURCE_FIELDS if c in rows.columns]
    rows = rows.withColumn("_p", phones.class_priority(F.col("classification"), F.col("type")))
    # sightings are put together before they are sent: a number that a site shows on every page is a row a (url, type) and task
    seen = rows.groupBy(site, "number", F.col("original_full_url").alias("_u"), F.col("type").alias("_t")).agg(
        F.min(F.struct(*order, *kept)).alias("_source"), F.min(F.struct("_p", *order, "classification")).alias("_best"), F.count(F.lit(1)).alias("_n"))
    out = seen.groupBy(site, "number").agg(F.min("_best").alias("_best"), F.sort_array(F.collect_list("_source")).alias("sources"), F.sum("_n").alias("sightings"))
    out = out.select(site, "number", F.col("_best.classification").alias("classification"), F.col("_best._p").alias("priority"), "sources", "sightings")
    return out.withColumn("types", first_seen(F.transform("sources", lambda s: s["type"])))


def first_seen(values: Column) -> Column:
    """An array without nulls and repeats in any case, each value as it is first seen."""
    keyed = F.transform(F.filter(values, lambda t: t.isNotNull()), lambda t, i: F.struct(F.lower(F.trim(t)).alias("k"), i.alias("i"), t.alias("t")))
    first = lambda s: F.filter(s, lambda e, j: ~F.get(s, j - 1)["k"].eqNullSafe(e["k"]))
    kept = F.transform(F.array(F.array_sort(keyed)), first)[0]
    return F.transform(F.array_sort(F.transform(kept, lambda e: F.struct(e["i"], e["t"]))), lambda e: e["t"])


def callable_numbers(numbers: DataFrame) -> DataFrame:
    """Numbers that may be called: business ones with a type that is no fax."""
    return numbers.where((F.lower("classification") != "non-business") & F.exists("types", lambda t: ~phones.is_fax(t)))


def diagnostic_score(classification: Column, types: Column, has_person: Column) -> Column:
    """Order for display: class 100, 80, 50 or 0, main lines up 30, faxes down 30, a named person 10."""
    c = F.lower(classification)
    base = F.when(c == "primary", 100).when(c == "secondary", 80).when(c == "support", 50).otherwise(0)
    low = F.transform(types, lambda t: F.lower(t))
    return base + F.when(F.exists(low, lambda t: t.isin("main line", "mainline", "zentrale", "headquarters")), 30).otherwise(0) - F.when(F.exists(low, phones.is_fax), 30).otherwise(0) + F.when(has_person, 10).otherwise(0)


def top_numbers(numbers: DataFrame, site: str, order: list[Column], most: int = 3) -> DataFrame:
    """Top_1 … of each site in one row: number, type and source columns."""
    place = F.row_number().over(Window.partitionBy(site).orderBy(*order))
    ranked = numbers.withColumn("_n", place).where(F.col("_n") <= most)
    pick = lambda c, i: F.max(F.when(F.col("_n") == i, F.col(c)))
    return ranked.groupBy(site).agg(*[pick(c, i).alias(f"{c}_{i}") for i in range(1, most + 1) for c in ("number", "type") if c in numbers.columns])


def person_contacts(numbers: DataFrame, site: str) -> DataFrame:
    """Named persons or direct dials behind business numbers, once a (name, role, number), with a score; no fax lines."""
    s = numbers.where(F.lower("classification") != "non-business").withColumn("s", F.explode("sources"))
    s = s.select(site, "number", "classification", F.col("s.type").alias("type"), phones.person_text(F.col("s.associated_person_name")).alias("name"), phones.person_text(F.col("s.associated_person_role")).alias("role"), F.col("s.is_direct_dial").alias("direct"))
    s = s.where(~phones.is_fax(F.col("type")) & (F.col("name").isNotNull() | F.coalesce("direct", F.lit(False))))
    s = s.withColumns({"_n": F.lower("name"), "_r": F.lower("role")}).dropDuplicates([site, "number", "_n", "_r"]).drop("_n", "_r")
    cls = F.lower("classification")
    return s.withColumn("score", F.when(F.col("direct"), 40).otherwise(0) + phones.role_score(F.col("role")) + F.when(cls == "primary", 20).when(cls == "secondary", 10).otherwise(0))


def best_person(contacts: DataFrame, site: str, least: int = 90) -> DataFrame:
    """The best contact of a site, if it is good enough; ties by number."""
    best = contacts.groupBy(site).agg(F.max_by(F.struct("name", "role", "number", "score"), F.struct("score", F.col("number"))).alias("best"))
    return best.where(F.col("best.score") >= least).select(site, "best.*")


def skip_private(item_type: Column, person: Column, roles: Column, paths: Column) -> Column:
    """A personal or mobile number that only an imprint or legal page shows, and no commercial role: not for the call list."""
    private = contains_any(F.lower(F.coalesce(item_type, F.lit(""))), ("mobile", "mobil", "handy", "cell", "direct", "personal")) | phones.person_text(person).isNotNull()
    commercial = F.exists(roles, lambda r: phones.role_score(r) >= 80)
    legal = F.exists(paths, lambda p: contains_any(F.lower(p), ("impressum", "imprint", "legal", "legal-notice", "privacy", "datenschutz", "terms", "agb")))
    return private & ~commercial & legal


def domain_rollup(pages: DataFrame, url: str = "url") -> DataFrame:
    """Per web host: pages, page types, counts by type as JSON, whether a contact page exists."""
    p = pages.withColumns({"host": urls.host(F.col(url)), "page_type": urls.page_type(F.col(url))})
    per = p.groupBy("host", "page_type").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_page"))
    return per.groupBy("host").agg(
        F.sum("n").alias("pages"), F.min("first_page").alias("first_page"), F.array_join(F.array_sort(F.collect_set("page_type")), ", ").alias("page_types"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "page_type", F.col("n").cast("string")))), ",").alias("type_counts"),
        F.bool_or(F.col("page_type") == "contact").alias("has_contact"))


def domain_status(rows: DataFrame, site: str, order: list[str]) -> DataFrame:
    """Status of a site: Success beats all, what isn't an error beats errors, else the first seen."""
    rank = F.when(F.col("status") == "Success", 0).when(~F.col("status").rlike("^Error"), 1).otherwise(2)
    return rows.groupBy(site).agg(F.min_by("status", F.struct(rank, *order)).alias("status"))
