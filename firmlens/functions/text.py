"""Columns of text: blanks, normalization, tokens, boilerplate lines, JSON pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from firmlens.functions import fixed, jsonscan
from firmlens.shared import find_package

#: Latin letters whose decomposition starts with an ASCII letter, and that letter; ß and others without one are deleted.
_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"
#: ASCII characters that end a token of lower-case text.
_BLANK = "".join(chr(i) for i in range(128) if not (chr(i).isdigit() or chr(i).isalpha()))


def blank_to_null(c: Column, blanks: Iterable[str] = ()) -> Column:
    """The trimmed text; null where it is empty or, in lower case, one of blanks."""
    t = F.trim(c)
    return F.when((t != "") & ~F.lower(t).isin(*blanks) if blanks else t != "", t)


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it (an array of one and a lambda)."""
    return F.transform(F.array(c), f)[0]


def first_usable(*columns: Column, blanks: Iterable[str] = ()) -> Column:
    """The first column that isn't blank."""
    return F.coalesce(*[blank_to_null(c, blanks) for c in columns])


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_text(c: Column, blanks: Iterable[str] = fixed.MATCH_BLANKS) -> Column:
    """Squeezed text, '' for null and blanks."""
    t = squeeze(F.coalesce(c, F.lit("")))
    return F.when(F.lower(t).isin(*blanks), F.lit("")).otherwise(t)


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """Whether the text holds one of words as a substring."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return F.coalesce(out, F.lit(False))


def fold_ascii(c: Column) -> Column:
    """Accents off Latin letters, other non-ASCII characters deleted: what NFKD and ASCII give for these languages."""
    return F.regexp_replace(F.translate(c, _ACCENTED, _PLAIN), r"[^\x00-\x7F]", "")


def match_text(c: Column) -> Column:
    """Text for matching: ASCII, lower case, & as and, one space between runs of letters and digits."""
    return F.trim(F.regexp_replace(_folded(c), r"[^a-z0-9]+", " "))


def _folded(c: Column) -> Column:
    return F.replace(F.lower(fold_ascii(F.coalesce(c, F.lit("")))), F.lit("&"), F.lit(" and "))


def match_tokens(c: Column) -> Column:
    """Tokens of match_text without short ones (but for known abbreviations), stop words and numbers."""
    keep = lambda t: (
        (t != "") & ((F.length(t) > 2) | t.isin(*fixed.SHORT_TOKENS)) & ~t.isin(*fixed.STOPWORDS) & ~t.rlike("^[0-9]+$"))
    # character by character, which is quicker than runs by a pattern; of a run of spaces '' is left, which isn't kept
    return F.filter(F.split(F.translate(_folded(c), _BLANK, " " * len(_BLANK)), " "), keep)


def match_phrases(texts: Column, limit: int = 8) -> Column:
    """Of an array of texts, the first `limit` distinct phrases: without stop words, of 2 words and 8 characters at least, 8 words at most."""
    words = lambda t: F.filter(F.split(match_text(t), " "), lambda w: (w != "") & ~w.isin(*fixed.STOPWORDS))
    phrases = F.transform(F.filter(F.transform(texts, words), lambda w: F.size(w) >= 2), lambda w: F.array_join(F.slice(w, 1, 8), " "))
    return F.slice(F.array_distinct(F.filter(phrases, lambda p: F.length(p) >= 8)), 1, limit)


def is_cookie_line(c: Column) -> Column:
    """Cookie boilerplate: two markers, or cookie or consent in a short line; never with a phone number or address. Blank lines count."""
    low = F.lower(F.trim(c))
    hits = sum((F.contains(low, F.lit(m)).cast("int") for m in fixed.COOKIE_MARKERS), F.lit(0))
    short = contains_any(low, ("cookie", "consent")) & (F.length(low) <= 240)
    return (low == "") | (((hits >= 2) | short) & ~low.rlike(fixed.PHONE_OR_EMAIL))


def clean_lines(c: Column) -> Column:
    """Lines of a text, squeezed, without cookie boilerplate, each kept where it is first seen (in any case)."""
    lines = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), squeeze), lambda x: ~is_cookie_line(x))
    keyed = F.array_sort(F.transform(lines, lambda x, i: F.struct(F.lower(x).alias("k"), i.alias("i"), x.alias("x"))))
    first = lambda s: F.filter(s, lambda e, j: ~F.get(s, j - 1)["k"].eqNullSafe(e["k"]))
    # arrays of one array name a value, so that it is computed once
    kept = F.transform(F.array(keyed), first)[0]
    return F.array_join(F.transform(F.array_sort(F.transform(kept, lambda e: F.struct(e["i"], e["x"]))), lambda e: e["x"]), "\n")


def first_words(c: Column, n: int = 100) -> Column:
    """The first n words, with single spaces."""
    return F.array_join(F.slice(F.split(squeeze(F.coalesce(c, F.lit(""))), " "), 1, n), " ")


def looks_english(c: Column, markers: Sequence[str] = ("the", "and", "with", "for", "your"), longest: int = 90) -> Column:
    """Two marker words or more, or longer than `longest` characters."""
    words = F.split(F.lower(squeeze(c)), " ")
    return (F.size(F.filter(words, lambda w: w.isin(*markers))) >= 2) | (F.length(c) > longest)


def json_field(c: Column, name: str) -> Column:
    """A string field of a JSON text, also of one that is cut short."""
    return F.nullif(F.trim(F.regexp_extract(c, f'"{name}"\\s*:\\s*"([^"]+)"', 1)), F.lit(""))


def _scanned(c: Column, name: str) -> Column:
    """A function of jsonscan over a column, in Arrow batches; null where it finds nothing."""
    find_package(SparkSession.active())

    @F.pandas_udf("string")
    def scan(texts: pd.Series) -> pd.Series:
        found = getattr(jsonscan, name)
        return texts.map(lambda t: found(t) or None, na_action="ignore")

    return scan(c.cast("string"))


def balanced_json(c: Column) -> Column:
    """The first object or array of a text whose brackets close, '' if there is none: jsonscan.first_balanced."""
    return F.coalesce(_scanned(c, "first_balanced"), F.lit(""))


def fenced_json(c: Column) -> Column:
    """The JSON of a model's answer: of the first code fence that holds a closed object or array, else of the whole text;
    null without one."""
    return _scanned(c, "answer_json")


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(match_text(c), " ", "-"), "^-+|-+$", "")


def partner_id(name: Column, website: Column) -> Column:
    """A slug of the name and the first eight digits of a SHA-1 of name and host."""
    return F.concat(slug(name), F.lit("-"), F.left(F.sha1(F.concat_ws("|", F.lower(F.trim(name)), website).cast("binary")), F.lit(8)))


def age_text(seconds: Column) -> Column:
    """Seconds as 12s, 3m 05s or 2h 07m."""
    s = F.floor(seconds).cast("long")
    return (
        F.when(s < 60, F.concat(s.cast("string"), F.lit("s")))
        .when(s < 3600, F.format_string("%dm %02ds", F.floor(s / 60), s % 60))
        .otherwise(F.format_string("%dh %02dm", F.floor(s / 3600), F.floor(s % 3600 / 60))))


def rank_value(c: Column) -> Column:
    """A rank as a number, 9999 where it is blank or no number."""
    return F.coalesce(F.trim(c).try_cast("double"), F.lit(9999.0))


def report_cell(c: Column) -> Column:
    """Text without the control characters that spreadsheets refuse."""
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def leads_text(c: Column) -> Column:
    """A number of leads with up to two decimals, without closing zeros."""
    two = F.format_string("%.2f", c.cast("double"))
    return F.regexp_replace(F.regexp_replace(two, "0+$", ""), r"\.$", "")


def fill_placeholder(template: Column, name: str, value: Column, missing: str = "") -> Column:
    """{name} in a template replaced by the value, or by `missing` where there is none."""
    return F.replace(template, F.lit("{" + name + "}"), F.coalesce(value, F.lit(missing)))


def pitch(decision: Column, company: Column, partner: Column, features: Column, leads: Column) -> Column:
    """The line a call starts with: for a strong match its features, for a weak one a question, none without a match."""
    strong = F.format_string("%s fits %s: %s (%s leads a day)", company, partner, F.array_join(F.slice(features, 1, 3), ", "), leads_text(leads))
    weak = F.format_string("Would %s be of use to %s?", partner, company)
    return F.when((decision == "strong_match") & (F.size(features) > 0), strong).when(decision.isin("strong_match", "weak_match"), weak)
