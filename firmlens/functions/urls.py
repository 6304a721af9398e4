"""Columns of URLs, with plain string functions so that filters on them stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmlens.functions import fixed
from firmlens.functions.text import contains_any

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def host(url: Column) -> Column:
    """Authority in lower case, without a leading www. and without what follows it; '' if there is no scheme."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)), r"^www\.", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def with_scheme(url: Column, default: str = "https") -> Column:
    u = F.trim(url)
    return F.when(u.rlike("^[a-zA-Z]+://"), u).otherwise(F.concat(F.lit(f"{default}://"), u))


def normalize(url: Column) -> Column:
    """Fragment, www., index file, closing slash and `fallback` parameter off; parameters sorted."""
    p = path(url)
    index = "/(" + "|".join(f.replace(".", r"\.") for f in fixed.INDEX_FILES) + ")$"
    p = F.regexp_replace(p, index, "/")
    p = F.when(p == "", F.lit("/")).when(p == "/", p).otherwise(F.regexp_replace(p, "/$", ""))
    params = F.filter(F.split(query(url), "&"), lambda q: (F.lower(F.substring_index(q, "=", 1)) != "fallback") & (q != ""))
    q = F.array_join(F.array_sort(params), "&")
    return F.concat(scheme(url), F.lit("://"), host(url), p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))


def base(url: Column) -> Column:
    """scheme://host without www.; http for a bare domain; null for a bare word without a dot."""
    bare = ~url.rlike("^https?://")
    word = bare & ~F.contains(F.substring_index(url, "/", 1), F.lit("."))
    full = F.when(bare, F.concat(F.lit("http://"), url)).otherwise(url)
    h = F.regexp_replace(F.regexp_extract(full, r"^https?://([^/?#]*)", 1), r"^www\.", "")
    return F.when(~word & (h != ""), F.concat(F.regexp_extract(full, "^(https?)", 1), F.lit("://"), h))


def key(url: Column) -> Column:
    """host and path without closing slashes: joins runs over the same pages; '' for a blank."""
    u = with_scheme(F.coalesce(url, F.lit("")))
    return F.when(F.trim(F.coalesce(url, F.lit(""))) == "", F.lit("")).otherwise(F.concat(host(u), F.regexp_replace(path(u), "/+$", "")))


def host_key(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    return F.when(F.trim(u) == "", F.lit("")).otherwise(host(with_scheme(u)))


def source_path(url: Column) -> Column:
    """path?query, / if both are empty."""
    q = query(url)
    p = F.concat(path(url), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
    return F.when(p == "", F.lit("/")).otherwise(p)


def page_type(url: Column) -> Column:
    """contact, imprint or legal by path, then by the whole URL; homepage; general_content; unknown for a blank."""
    u = F.lower(url)
    p = path(u)
    out = F.when(F.coalesce(url, F.lit("")) == "", "unknown")
    for where in (p, u):
        for name, words in (("contact", fixed.CONTACT_KEYWORDS), ("imprint", fixed.IMPRINT_KEYWORDS), ("legal", fixed.LEGAL_KEYWORDS)):
            out = out.when(contains_any(where, words), name)
    return out.when(p.isin("", "/"), "homepage").otherwise("general_content")


def summary_page_type(url: Column) -> Column:
    """about, product_service, homepage or general_content, for the summary pipeline."""
    u = F.lower(url)
    p = path(u)
    out = F.when(F.coalesce(url, F.lit("")) == "", "unknown")
    for where in (p, u):
        for name, words in (("about", fixed.ABOUT_KEYWORDS), ("product_service", fixed.PRODUCT_KEYWORDS)):
            out = out.when(contains_any(where, words), name)
    return out.when(p.isin("", "/"), "homepage").otherwise("general_content")


def label(url: Column, suffixes: Sequence[str] = ("com", "de", "org", "net", "uk", "io", "co", "eu", "info", "biz", "at", "ch")) -> Column:
    """The registrable label of a URL's host: example of https://www.example.co.uk/x; null without a URL."""
    h = F.regexp_replace(F.regexp_extract(url, r"https?://([^\s/?#]+)", 1), r"^www\.", "")
    parts = F.split(h, r"\.")
    n = F.size(parts)
    known = F.element_at(parts, -1).isin(*suffixes)
    return (
        F.when(h == "", F.lit(None).cast("string")).when(n == 1, h)
        .when(known & (n > 2) & (F.get(parts, n - 2) == "co"), F.get(parts, n - 3))
        .when(known, F.get(parts, n - 2)).otherwise(F.get(parts, F.lit(0))))


def host_variants(url: Column) -> Column:
    """Hosts to try when a name doesn't resolve: the host, up to its first hyphen with the same ending, .de as .com."""
    h = host(with_scheme(url))
    ending = F.regexp_extract(h, r"(\.[^.]+)$", 1)
    cut = F.when(F.contains(h, F.lit("-")), F.concat(F.substring_index(h, "-", 1), ending))
    com = F.when(F.endswith(h, F.lit(".de")), F.regexp_replace(h, r"\.de$", ".com"))
    return F.array_distinct(F.filter(F.array(h, cut, com), lambda x: x.isNotNull()))


def input_status(url: Column) -> Column:
    """Cleaned URL and whether it can be used: spaces out of the host, http:// where no scheme stands, / for no path."""
    u = F.trim(F.coalesce(url, F.lit("")))
    u = F.when(u.rlike("^[a-zA-Z]+://"), u).otherwise(F.concat(F.lit("http://"), u))
    h = F.regexp_replace(F.regexp_extract(u, r"^[a-zA-Z]+://([^/?#]*)", 1), " ", "")
    tail = F.replace(F.regexp_extract(u, r"^[a-zA-Z]+://[^/?#]*(.*)$", 1), F.lit(" "), F.lit("%20"))
    tail = F.when(tail.rlike("^/"), tail).otherwise(F.concat(F.lit("/"), tail))
    fine = (h != "") & h.rlike(r"^[^\s@]+$") & scheme(u).isin("http", "https")
    return F.struct(F.when(fine, F.concat(scheme(u), F.lit("://"), h, tail)).alias("url"), F.when(fine, "Valid").otherwise("InvalidURL").alias("status"))


def sales_url(canonical: Column, given: Column) -> Column:
    """The canonical address, else the given one."""
    return F.coalesce(F.nullif(F.trim(canonical), F.lit("")), F.nullif(F.trim(given), F.lit("")))


def safe_name(url: Column, longest: int = 100) -> Column:
    """A file name for a URL: a prefix of it and eight digits of its SHA-256."""
    plain = F.regexp_replace(F.regexp_replace(url, "^https?://", ""), r"[^0-9A-Za-z_.\-]", "_")
    return F.concat(F.left(plain, F.lit(longest)), F.lit("_"), F.left(F.sha2(url.cast("binary"), 256), F.lit(8)))


def link_score(url: Column, text: Column, most_segments: int = 3, *, critical: Sequence[str] = fixed.CRITICAL_KEYWORDS, high: Sequence[str] = fixed.HIGH_KEYWORDS, target: Sequence[str] = fixed.TARGET_LINK_KEYWORDS, force: Sequence[str] = fixed.CONTACT_KEYWORDS + fixed.IMPRINT_KEYWORDS) -> Column:
    """Score of a link for the crawl order: contact and imprint paths 100, critical and high keywords 100 and 90 less 5
    for each segment over most_segments, keyword anywhere 80 less 5 a position, another target keyword as a segment 70
    less 3 a segment, keyword inside a segment 50, in the text 40."""
    segments = F.filter(F.split(F.lower(path(url)), "/"), lambda s: s != "")
    n = F.size(segments)
    has = lambda words: F.arrays_overlap(segments, F.array(*[F.lit(w) for w in words]).cast("array<string>"))
    deep = lambda most, each=5: F.least(F.lit(most), F.greatest(F.lit(0), n - most_segments) * each)
    both = F.array(*[F.lit(w) for w in (*critical, *high)]).cast("array<string>")
    first = F.array_position(F.transform(segments, lambda s: F.array_contains(both, s)), True)
    others = [w for w in target if w not in critical and w not in high]
    scores = (
        F.when(has(force), 100), F.when(has(critical), 100 - deep(20)), F.when(has(high), 90 - deep(20)), F.when(first > 0, 80 - (first - 1) * 5 - deep(15)),
        F.when(has(others), 70 - deep(10, 3)), F.when(F.exists(segments, lambda s: contains_any(s, target)), 50), F.when(contains_any(F.lower(text), target), 40))
    return F.coalesce(F.greatest(*scores), F.lit(0)).cast("int")


def is_target_link(url: Column, text: Column, *, target: Sequence[str] = fixed.TARGET_LINK_KEYWORDS, force: Sequence[str] = fixed.CONTACT_KEYWORDS + fixed.IMPRINT_KEYWORDS, **_) -> Column:
    """Whether a link has a target keyword in its address or text, or a contact or imprint path: others aren't scored."""
    return contains_any(F.lower(url), target) | contains_any(F.lower(text), target) | F.exists(F.split(F.lower(path(url)), "/"), lambda s: s.isin(*force))


def excluded(url: Column, patterns: Sequence[str]) -> Column:
    """Whether the path holds one of the patterns that keep a link out of the crawl order."""
    return contains_any(F.lower(path(url)), [p.lower() for p in patterns if p])
