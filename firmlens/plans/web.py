"""Queries over web pages and their links."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlens.functions import fixed, urls
from firmlens.functions.text import clean_lines, first_words, looks_english
from firmlens.operators import contacts, crawl
from firmlens.shared import written
from firmlens.sources import html


def read(spark, sf_dir: str, table: str):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# ---------------------------------------------------------------- SQL pieces

_AUTH = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def s_scheme(u):
    return rf"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1))"


def s_host(u):
    return rf"regexp_replace(lower(regexp_extract({u}, '{_AUTH}([^/?#]*)', 1)), '^www\.', '')"


def s_path(u):
    return rf"regexp_extract({u}, '{_AUTH}[^/?#]*([^?#]*)', 1)"


def s_query(u):
    return rf"regexp_extract({u}, '^[^?#]*\?([^#]*)', 1)"


def s_any(c, words):
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


def s_page_type(u, kinds):
    cases = [f"WHEN {s_any(where, words)} THEN '{name}'" for where in (s_path(f"lower({u})"), f"lower({u})") for name, words in kinds]
    return f"CASE WHEN coalesce({u}, '') = '' THEN 'unknown' {' '.join(cases)} WHEN {s_path(f'lower({u})')} IN ('', '/') THEN 'homepage' ELSE 'general_content' END"


PHONE_KINDS = (("contact", fixed.CONTACT_KEYWORDS), ("imprint", fixed.IMPRINT_KEYWORDS), ("legal", fixed.LEGAL_KEYWORDS))
SUMMARY_KINDS = (("about", fixed.ABOUT_KEYWORDS), ("product_service", fixed.PRODUCT_KEYWORDS))


# ---------------------------------------------------------------- queries

def url_normalize(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.normalize(F.col("url")).alias("url_norm"))


_INDEX = "|".join(f.replace(".", r"\.") for f in fixed.INDEX_FILES)
URL_NORMALIZE = rf"""
WITH a AS (SELECT page_id, url, regexp_replace({s_path('url')}, '/({_INDEX})$', '/') AS p, {s_query('url')} AS q FROM pages),
b AS (SELECT *, array_to_string(list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND lower(split_part(x, '=', 1)) <> 'fallback')), '&') AS qs FROM a)
SELECT page_id, {s_scheme('url')} || '://' || {s_host('url')} || CASE WHEN p = '' THEN '/' WHEN p = '/' THEN p ELSE regexp_replace(p, '/$', '') END
       || CASE WHEN qs <> '' THEN '?' || qs ELSE '' END AS url_norm FROM b
"""


def url_keys(spark, sf_dir):
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", urls.base(u).alias("base"), urls.key(u).alias("url_key"), urls.host_key(u).alias("host_key"), urls.source_path(u).alias("source_path"), urls.label(u).alias("label"))


URL_KEYS = rf"""
WITH a AS (SELECT page_id, url, {s_host('url')} AS h, {s_path('url')} AS p, {s_query('url')} AS q, string_split({s_host('url')}, '.') AS parts FROM pages)
SELECT page_id, regexp_extract(url, '^(https?)', 1) || '://' || h AS base, h || regexp_replace(p, '/+$', '') AS url_key, h AS host_key,
       CASE WHEN p || q = '' THEN '/' ELSE p || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS source_path,
       CASE WHEN len(parts) = 1 THEN h WHEN parts[-1] IN ('com', 'de', 'org', 'net', 'uk', 'io', 'co', 'eu', 'info', 'biz', 'at', 'ch')
            THEN CASE WHEN len(parts) > 2 AND parts[-2] = 'co' THEN parts[-3] ELSE parts[-2] END ELSE parts[1] END AS label
FROM a
"""


def url_input(spark, sf_dir):
    bare = F.regexp_replace("url", "^https?://", "")
    given = F.when(F.pmod("page_id", F.lit(3)) == 0, bare).when(F.pmod("page_id", F.lit(3)) == 1, F.replace("url", F.lit("."), F.lit(" ."))).otherwise(F.col("url"))
    s = urls.input_status(given)
    return read(spark, sf_dir, "pages").select("page_id", s["url"].alias("clean_url"), s["status"].alias("status"), F.array_join(urls.host_variants(given), ",").alias("variants"), urls.safe_name(F.col("url")).alias("safe_name"))


URL_INPUT = rf"""
WITH g AS (SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN regexp_replace(url, '^https?://', '') WHEN 1 THEN replace(url, '.', ' .') ELSE url END AS g FROM pages),
u AS (SELECT *, CASE WHEN regexp_matches(trim(g), '^[a-zA-Z]+://') THEN trim(g) ELSE 'http://' || trim(g) END AS u, CASE WHEN regexp_matches(trim(g), '^[a-zA-Z]+://') THEN trim(g) ELSE 'https://' || trim(g) END AS v FROM g),
h AS (SELECT *, replace(regexp_extract(u, '^[a-zA-Z]+://([^/?#]*)', 1), ' ', '') AS h, replace(regexp_extract(u, '^[a-zA-Z]+://[^/?#]*(.*)$', 1), ' ', '%20') AS t, {s_host('v')} AS vh FROM u),
k AS (SELECT *, h <> '' AND regexp_matches(h, '^[^\s@]+$') AND {s_scheme('u')} IN ('http', 'https') AS fine FROM h)
SELECT page_id, CASE WHEN fine THEN {s_scheme('u')} || '://' || h || CASE WHEN starts_with(t, '/') THEN t ELSE '/' || t END END AS clean_url, CASE WHEN fine THEN 'Valid' ELSE 'InvalidURL' END AS status,
       vh || CASE WHEN contains(vh, '-') AND split_part(vh, '-', 1) || regexp_extract(vh, '(\.[^.]+)$', 1) <> vh THEN ',' || split_part(vh, '-', 1) || regexp_extract(vh, '(\.[^.]+)$', 1) ELSE '' END
          || CASE WHEN ends_with(vh, '.de') THEN ',' || regexp_replace(vh, '\.de$', '.com') ELSE '' END AS variants,
       left(regexp_replace(regexp_replace(url, '^https?://', ''), '[^0-9A-Za-z_.\-]', '_', 'g'), 100) || '_' || left(sha256(url), 8) AS safe_name
FROM k
"""


def page_type_counts(spark, sf_dir):
    p = read(spark, sf_dir, "pages").select(urls.page_type(F.col("url")).alias("page_type"), urls.summary_page_type(F.col("url")).alias("summary_type"))
    return p.groupBy("page_type", "summary_type").agg(F.count(F.lit(1)).alias("n"))


PAGE_TYPE_COUNTS = f"SELECT {s_page_type('url', PHONE_KINDS)} AS page_type, {s_page_type('url', SUMMARY_KINDS)} AS summary_type, count(*) AS n FROM pages GROUP BY ALL"


def host_rollup(spark, sf_dir):
    return contacts.domain_rollup(read(spark, sf_dir, "pages"))


HOST_ROLLUP = f"""
WITH p AS (SELECT page_id, {s_host('url')} AS host, {s_page_type('url', PHONE_KINDS)} AS page_type FROM pages),
t AS (SELECT host, page_type, count(*) AS n, min(page_id) AS first_page FROM p GROUP BY ALL)
SELECT host, CAST(sum(n) AS BIGINT) AS pages, min(first_page) AS first_page, string_agg(page_type, ', ' ORDER BY page_type) AS page_types,
       string_agg(page_type || ':' || n, ',' ORDER BY page_type || ':' || n) AS type_counts, bool_or(page_type = 'contact') AS has_contact FROM t GROUP BY host
"""


def html_text(spark, sf_dir):
    t = html.page_text(read(spark, sf_dir, "pages"))
    return t.select("page_id", F.length("text").cast("long").alias("n_chars"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"), F.md5("text").alias("text_md5"))


LINK_WORDS = {"critical": ("the",), "high": ("de", "in"), "target": ("the", "de", "in", "is", "en", "la", "er"), "force": ("was",)}


def link_topk(spark, sf_dir):
    """The best links of each page, by common words as keywords: the pages' links are such words."""
    return html.top_links(read(spark, sf_dir, "pages"), most=3, exclude=(*fixed.EXCLUDED_PATHS, "/los"), **LINK_WORDS)


def crawl_tables(spark, sf_dir):
    """Entries and links of all pages: a host's first page begins its crawl, its others are known from a site map."""
    p = read(spark, sf_dir, "pages")
    at = urls.normalize(F.col("url"))
    first = p.groupBy(urls.host(F.col("url")).alias("site")).agg(F.min("page_id").alias("first"))
    own = p.select("page_id", urls.host(F.col("url")).alias("site"), at.alias("url"), urls.link_score(at, F.lit(""), **LINK_WORDS).alias("own"))
    entries = own.join(first, "site").select("site", "url", F.when(F.col("page_id") == F.col("first"), 100).otherwise(F.col("own")).alias("score"), F.col("page_id").alias("position"))
    return entries, html.page_links(p, exclude=(*fixed.EXCLUDED_PATHS, "/los"), **LINK_WORDS)


def crawl_order(spark, sf_dir):
    """What a crawl of all hosts would fetch, in which order."""
    entries, links = crawl_tables(spark, sf_dir)
    return crawl.crawl_order(entries, written(links, "links"))


def text_lines(spark, sf_dir):
    t = read(spark, sf_dir, "documents").select("doc_id", clean_lines(F.col("text")).alias("t"), first_words(F.col("text")).alias("w"), looks_english(F.col("text")).alias("english"))
    return t.select("doc_id", F.md5("t").alias("lines_md5"), F.when(F.col("t") == "", 0).otherwise(F.size(F.split("t", "\n"))).cast("long").alias("n_lines"), F.md5("w").alias("words_md5"), "english")


_MARKERS = "[" + ", ".join(f"'{m}'" for m in fixed.COOKIE_MARKERS) + "]"
_PHONE_MAIL = fixed.PHONE_OR_EMAIL
_SQ = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
TEXT_LINES = rf"""
WITH l AS (SELECT doc_id, text, list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {_SQ.format('x')}) AS ls FROM documents),
k AS (SELECT doc_id, text, list_filter(ls, lambda x: x <> '' AND (regexp_matches(lower(x), '{_PHONE_MAIL}') OR NOT (
        len(list_filter({_MARKERS}, lambda m: contains(lower(x), m))) >= 2 OR ((contains(lower(x), 'cookie') OR contains(lower(x), 'consent')) AND length(x) <= 240)))) AS ls FROM l),
f AS (SELECT doc_id, text, list_filter(ls, lambda x, i: list_position(list_transform(ls, lambda y: lower(y)), lower(x)) = i) AS ls FROM k),
w AS (SELECT *, string_split({_SQ.format("coalesce(text, '')")}, ' ') AS ws FROM f)
SELECT doc_id, md5(array_to_string(ls, chr(10))) AS lines_md5, CAST(len(ls) AS BIGINT) AS n_lines, md5(array_to_string(ws[1:100], ' ')) AS words_md5,
       len(list_filter(string_split(lower({_SQ.format('text')}), ' '), lambda x: x IN ('the', 'and', 'with', 'for', 'your'))) >= 2 OR length(text) > 90 AS english
FROM w
"""

QUERIES = {
    "url_normalize": (url_normalize, URL_NORMALIZE), "url_keys": (url_keys, URL_KEYS), "url_input": (url_input, URL_INPUT),
    "page_type_counts": (page_type_counts, PAGE_TYPE_COUNTS), "host_rollup": (host_rollup, HOST_ROLLUP),
    "html_text": (html_text, None), "link_topk": (link_topk, None), "crawl_order": (crawl_order, None), "text_lines": (text_lines, TEXT_LINES),
}
