"""Numbering plans: what a phone number is by the longest prefix of a plan that it begins with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.operators.matching import small

#: A plan: digits that numbers begin with (country code first, no +), the country, what kind of number that is, and how many
#: digits such a number has behind the country code (shortest, longest).
PLAN = "prefix string, country string, kind string, shortest int, longest int"
#: Parts of the public numbering plans of three countries; any other plan is a parameter of the same form.
DACH = (
    ("49", "DE", "fixed_line", 5, 11), ("4915", "DE", "mobile", 10, 11), ("4916", "DE", "mobile", 9, 11), ("4917", "DE", "mobile", 9, 11), ("49180", "DE", "shared_cost", 7, 11),
    ("49800", "DE", "toll_free", 10, 13), ("49900", "DE", "premium_rate", 10, 10), ("49137", "DE", "premium_rate", 8, 10), ("49700", "DE", "personal", 11, 11), ("49116", "DE", "short_code", 6, 6),
    ("43", "AT", "fixed_line", 4, 13), ("43650", "AT", "mobile", 10, 13), ("43660", "AT", "mobile", 7, 13), ("43664", "AT", "mobile", 10, 13), ("43676", "AT", "mobile", 10, 13), ("43699", "AT", "mobile", 10, 13),
    ("43800", "AT", "toll_free", 9, 13), ("43900", "AT", "premium_rate", 9, 13), ("43720", "AT", "voip", 6, 13),
    ("41", "CH", "fixed_line", 9, 9), ("4174", "CH", "pager", 9, 9), ("4175", "CH", "mobile", 9, 9), ("4176", "CH", "mobile", 9, 9), ("4177", "CH", "mobile", 9, 9), ("4178", "CH", "mobile", 9, 9), ("4179", "CH", "mobile", 9, 9),
    ("41800", "CH", "toll_free", 9, 9), ("41900", "CH", "premium_rate", 9, 9), ("4184", "CH", "shared_cost", 9, 9),
)
CODES = ("49", "43", "41")
#: Digits of the longest number that E.164 allows.
MOST_DIGITS = 15


def number_kinds(numbers: DataFrame, plan: DataFrame, *, key: str, number: str, codes: tuple[str, ...] = CODES) -> DataFrame:
    """(key, number, country, kind, possibility) of rows by the longest prefix in plan (PLAN) that the digits begin with.

    possibility: possible, too_short or too_long by the prefix's lengths behind the country code (one of codes), unknown without
    a prefix in the plan, null without a number. Each distinct number meets the plan once, by an equi join on its prefixes of
    the plan's lengths, of which there are MOST_DIGITS at most; a small plan is broadcast behind a count, so a number that a
    third of all rows have is looked up once and joined back. Of equal prefixes the greatest entry counts. Null numbers and
    those without digits: null columns. Repeated rows stay; further columns are not read.
    """
    digits = F.regexp_replace(F.col(number), r"\D", "")
    rows = numbers.select(key, number, F.nullif(digits, F.lit("")).alias("_digits"))
    lengths = [r[0] for r in plan.select(F.length("prefix").alias("n")).where(f"n BETWEEN 1 AND {MOST_DIGITS}").distinct().orderBy("n").collect()]
    tried = rows.select("_digits").where("_digits IS NOT NULL").distinct()
    tried = tried.select("_digits", F.explode(F.array_distinct(F.array(*[F.left("_digits", F.lit(n)) for n in lengths]) if lengths else F.array().cast("array<string>"))).alias("prefix"))
    found = tried.join(small(plan), "prefix").groupBy("_digits").agg(F.max(F.struct(F.length("prefix").alias("n"), "country", "kind", "shortest", "longest")).alias("p"))
    out = rows.join(found, "_digits", "left")
    code = F.lit(0)
    for c in codes:
        code = F.when(F.startswith("_digits", F.lit(c)), F.lit(len(c))).otherwise(code)
    n = F.length("_digits") - code
    possibility = F.when(F.col("_digits").isNull(), None).when(F.col("p").isNull(), "unknown").when(n < F.col("p.shortest"), "too_short").when(n > F.col("p.longest"), "too_long").otherwise("possible")
    return out.select(key, number, F.col("p.country").alias("country"), F.col("p.kind").alias("kind"), possibility.alias("possibility"))


def impossible(possibility: Column) -> Column:
    """Whether no number of the plan can have that many digits."""
    return F.coalesce(possibility.isin("too_short", "too_long"), F.lit(False))
