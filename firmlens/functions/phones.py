"""Columns of phone numbers. Without a numbering-plan library this knows shapes: E.164, 00 and national forms of a region."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmlens.functions import fixed
from firmlens.functions.text import blank_to_null, let

#: A phone-like run: a plus or bracket or digit, then at least seven more digits or separators, then a digit.
CANDIDATE = r"[+(]?[0-9][0-9 ()./\-]{6,18}[0-9]"
#: Country code, and most digits after it, by region; the national prefix is 0 (none in the North American plan).
REGIONS = {"DE": ("49", 13), "AT": ("43", 13), "CH": ("41", 9), "US": ("1", 10)}
TARGET_CODES = ("49", "41", "43")
MIN_NATIONAL, MAX_RUN = 7, 4
#: Runs of five digits that rise or fall.
RISING = tuple("".join(str(d + k) for k in range(5)) for d in range(6))
FALLING = tuple(r[::-1] for r in RISING)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def strip_excel(c: Column) -> Column:
    """Without the apostrophe that keeps a spreadsheet from reading a number; null for blanks."""
    return blank_to_null(F.regexp_replace(F.trim(c), "^'", ""), fixed.PHONE_BLANKS)


def looks_like_date(c: Column) -> Column:
    """Day, month and year of 1900 to 2099 in the text, two-digit years as 20xx."""
    pattern = r"\b(\d{1,2})[./-](\d{1,2})[./-](\d{2,4})\b"
    part = lambda i: F.regexp_extract(c, pattern, i).try_cast("int")
    year = F.when(part(3) < 100, part(3) + 2000).otherwise(part(3))
    return F.coalesce(year.between(1900, 2099) & part(2).between(1, 12) & part(1).between(1, 31), F.lit(False))


def is_placeholder(c: Column) -> Column:
    return c.rlike("^(000000|123456)") | c.rlike(r"^(.)\1{5,}$")


def national_fine(nsn: Column) -> Column:
    """Long enough, no digit five times in a row, no five digits that rise or fall."""
    runs = "|".join(RISING + FALLING)
    return (F.length(nsn) >= MIN_NATIONAL) & ~nsn.rlike(r"(\d)\1{%d}" % MAX_RUN) & ~nsn.rlike(runs)


def e164(c: Column, region: str = "DE") -> Column:
    """+ and digits: of +…, 00…, the region's own code or a national form; null if the length can't be right."""
    code, longest = REGIONS[region]

    def full(raw: Column, d: Column) -> Column:
        return (
            F.when(raw.rlike(r"^\(?\+"), d).when(d.rlike("^00"), F.substring(d, 3, 30)).when(d.rlike("^0"), F.concat(F.lit(code), F.regexp_replace(d, "^0+", "")))
            .when(d.rlike(f"^{code}") & (F.length(d) > longest), d).otherwise(F.concat(F.lit(code), d)))

    fine = lambda x: F.when(x.rlike("^[1-9][0-9]{6,14}$"), F.concat(F.lit("+"), x))
    return let(strip_excel(c), lambda raw: let(let(digits(raw), lambda d: full(raw, d)), fine))


def e164_any(c: Column, regions: tuple[str, ...] = ("DE", "AT", "CH")) -> Column:
    """The first region's reading that is of a target country, else the first reading, else the raw text."""
    readings = [e164(c, r) for r in regions]
    return F.coalesce(*[F.when(is_target(r), r) for r in readings], *readings, F.trim(c))


def is_target(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\+(" + "|".join(TARGET_CODES) + ")"), F.lit(False))


def national(c: Column) -> Column:
    """National digits of an E.164 number of a known country, else all its digits."""
    return F.regexp_replace(c, r"^\+(" + "|".join(code for code, _ in REGIONS.values()) + ")", "")


def valid(raw: Column, nsn: Column) -> Column:
    """What a candidate must be: no date, no placeholder, a fine national number."""
    return ~looks_like_date(raw) & ~is_placeholder(raw) & ~is_placeholder(nsn) & national_fine(nsn)


def needs_retrieval(c: Column) -> Column:
    """Whether a given phone value is missing, a stand-in, or too short to be one."""
    t = F.trim(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), "^'(?=.)", ""))
    return (t == "") | F.lower(t).isin(*fixed.RETRIEVAL_BLANKS) | (F.length(digits(t)) < 5) | (F.length(digits(t)) > 17)


def is_fax(c: Column) -> Column:
    return F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit("fax"))


def split_number_type(c: Column) -> Column:
    """`+49 … (Type)` as number and type."""
    return F.struct(F.trim(F.regexp_extract(c, r"^\s*([^()]+?)\s*(?:\(([^)]*)\))?\s*$", 1)).alias("number"), F.nullif(F.trim(F.regexp_extract(c, r"\(([^()]*)\)\s*$", 1)), F.lit("")).alias("type"))


def class_priority(classification: Column, kind: Column) -> Column:
    """Order of a number by classification, then type; lower comes first."""
    def of(table, c, other):
        return F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[c], F.lit(other))

    return F.struct(of(fixed.CLASS_PRIORITY, classification, 99).alias("class"), of(fixed.TYPE_PRIORITY, kind, 90).alias("type"))


def role_score(role: Column) -> Column:
    """Score of a person's role by keyword tiers."""
    r = F.lower(F.trim(F.coalesce(role, F.lit(""))))
    out = F.when(r == "", 0)
    for score, words in fixed.ROLE_TIERS:
        out = out.when(r.rlike("|".join(words)), score)
    return out.otherwise(10)


def parse_regions(given: str | None, default: tuple[str, ...] = ("DE", "AT", "CH")) -> tuple[str, ...]:
    """Region codes of a setting: a list literal or separated by commas; the default where there is none."""
    found = re.findall(r"[A-Za-z]{2}", given or "") if re.fullmatch(r"[\s\[\](){}'\",;A-Za-z]*", given or "") else []
    return tuple(dict.fromkeys(x.upper() for x in found)) or default


def other_numbers(every: Column, best: Column) -> Column:
    """Of an array of numbers those that are not among the best, in order, once each."""
    return F.array_except(every, F.coalesce(best, F.array().cast("array<string>")))


def person_text(c: Column) -> Column:
    return blank_to_null(c, fixed.PERSON_BLANKS)
