"""Queries of partner matching: benchmark items stand for partners, documents for companies."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlens.functions import fixed
from firmlens.functions.text import match_tokens, partner_id, slug
from firmlens.operators import keywords, matching
from firmlens.plans.web import read

_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def s_match_text(c):
    fold = f"regexp_replace(translate(coalesce({c}, ''), '{_ACCENTED}', '{_PLAIN}'), '[^\\x00-\\x7F]', '', 'g')"
    return f"trim(regexp_replace(replace(lower({fold}), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


def s_list(words):
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def s_tokens(c):
    return f"list_filter(string_split({s_match_text(c)}, ' '), lambda t: t <> '' AND (length(t) > 2 OR t IN {s_list(fixed.SHORT_TOKENS)}) AND t NOT IN {s_list(fixed.STOPWORDS)} AND NOT regexp_matches(t, '^[0-9]+$'))"


#: A small taxonomy over the words of the part names and types; the operator takes any.
TAXONOMY = (
    ("audience", "small_buyers", "small"), ("audience", "large_buyers", "large"), ("workflow", "economy_ops", "economy"), ("workflow", "promo_ops", "promo"),
    ("domain", "construction", "steel"), ("domain", "construction", "ring"), ("domain", "healthcare", "widget"), ("domain", "document_software", "bolt"), ("domain", "mobility", "red"),
)


def _tags(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("text"))
    return keywords.tag_texts(p, spark.createDataFrame(list(TAXONOMY), "category string, tag string, keyword string"), key="p_partkey", text="text")


def taxonomy_tags(spark, sf_dir):
    return _tags(spark, sf_dir)


_TAXONOMY = ", ".join(f"('{c}', '{t}', '{k}')" for c, t, k in TAXONOMY)
TAXONOMY_TAGS = f"""
SELECT DISTINCT p_partkey, category, tag FROM (SELECT p_partkey, {s_match_text("concat_ws(' ', p_name, p_type)")} AS flat FROM part) JOIN (VALUES {_TAXONOMY}) x(category, tag, keyword) ON contains(flat, keyword)
"""


def taxonomy_alignment(spark, sf_dir):
    """Tag sets of brands (tags that eight of its parts have) against each other: brands are both targets and partners."""
    p = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    tags = _tags(spark, sf_dir).join(p, "p_partkey").groupBy("p_brand", "category", "tag").agg(F.count(F.lit(1)).alias("n")).where("n >= 8")
    t = tags.select(F.col("p_brand").alias("target"), "category", "tag")
    q = tags.select(F.col("p_brand").alias("partner"), "category", "tag")
    brands = p.select("p_brand").distinct()
    pairs = matching.all_pairs(brands.select(F.col("p_brand").alias("target")), brands.select(F.col("p_brand").alias("partner"))).where("target <> partner")
    return matching.taxonomy_alignment(t, q, pairs)


_W = "CASE " + " ".join(f"WHEN tag = '{t}' THEN {w}" for t, w in fixed.GENERIC_TAG_WEIGHTS.items()) + " " + " ".join(f"WHEN category = '{c}' THEN {w}" for c, w in fixed.TAG_WEIGHTS.items()) + " ELSE 0 END"
_PEN = ", ".join(f"('{t}', '{p}', {v})" for t, ps in fixed.DOMAIN_PENALTIES.items() for p, v in ps.items())
TAXONOMY_ALIGNMENT = f"""
WITH g AS (SELECT p_brand, category, tag FROM ({TAXONOMY_TAGS}) JOIN part USING (p_partkey) GROUP BY ALL HAVING count(*) >= 8),
b AS (SELECT DISTINCT p_brand FROM part),
s AS (SELECT t.p_brand AS target, p.p_brand AS partner, sum({_W.replace('tag =', 't.tag =').replace('category =', 't.category =')}) AS overlap, string_agg(DISTINCT t.tag, ',' ORDER BY t.tag) AS shared, bool_or(t.category IN ('audience', 'workflow')) AS close
      FROM g t JOIN g p ON t.category = p.category AND t.tag = p.tag GROUP BY ALL),
o AS (SELECT t.p_brand AS target, p.p_brand AS partner, sum(v) AS off FROM g t JOIN (VALUES {_PEN}) x(a, b, v) ON t.category = 'domain' AND t.tag = a JOIN g p ON p.category = 'domain' AND p.tag = x.b GROUP BY ALL),
r AS (SELECT t.p_brand AS target, p.p_brand AS partner, coalesce(overlap, 0) AS overlap, coalesce(shared, '') AS shared, CASE WHEN coalesce(close, false) THEN 0 ELSE coalesce(off, 0) END AS penalty
      FROM b t JOIN b p ON t.p_brand <> p.p_brand LEFT JOIN s ON s.target = t.p_brand AND s.partner = p.p_brand LEFT JOIN o ON o.target = t.p_brand AND o.partner = p.p_brand)
SELECT target, partner, CAST(overlap - penalty AS BIGINT) AS score, shared, CAST(penalty AS BIGINT) AS penalty FROM r
"""


def _scored(spark, sf_dir, **asked):
    """Documents as companies against benchmark items as partners, in list order from the last item to the first."""
    tokens = match_tokens(F.col("text")).alias("tokens")
    one, both = matching.hashed_terms(F.col("tokens"))
    d = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    if asked.get("dimensions"):
        d = matching.deal_targets(d)
    d = d.select(F.col("doc_id").alias("target"), tokens, match_tokens(F.col("source")).alias("names"))
    targets = d.select("target", one.alias("own"), matching.hashed_terms(F.col("names"))[0].alias("listed"), both.alias("dense"))
    b = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("partner"), tokens)
    partners = b.select("partner", (-F.col("partner")).alias("position"), one.alias("sparse"), both.alias("dense"))
    return matching.score_partners(targets, partners, {"own": 4, "listed": 2}, **asked)


def token_overlap(spark, sf_dir):
    return _scored(spark, sf_dir, dense=False).where("sparse_rank IS NOT NULL").select("target", "partner", "score", "terms", "sparse_rank")


_TT = f"SELECT target, token, sum(w) AS weight FROM (SELECT doc_id AS target, unnest({s_tokens('text')}) AS token, 4 AS w FROM documents UNION ALL SELECT doc_id, unnest({s_tokens('source')}), 2 FROM documents) GROUP BY ALL"
_PT = f"SELECT DISTINCT item_id AS partner, unnest({s_tokens('text')}) AS token FROM benchmark"
TOKEN_OVERLAP = f"""
SELECT target, partner, CAST(sum(weight) AS BIGINT) AS score, count(*) AS terms, CAST(row_number() OVER (PARTITION BY target ORDER BY sum(weight) DESC, partner DESC) AS INT) AS sparse_rank FROM ({_TT}) t JOIN ({_PT}) p USING (token) GROUP BY target, partner QUALIFY sparse_rank <= 10
"""


def tfidf_cosine(spark, sf_dir):
    return _scored(spark, sf_dir, sparse=False).where("dense_rank IS NOT NULL").select("target", "partner", "cosine", "dense_rank")


def lowrank_cosine(spark, sf_dir):
    """As tfidf_cosine, after a truncated SVD of each document with all partners."""
    return _scored(spark, sf_dir, sparse=False, dimensions=32).where("dense_rank IS NOT NULL").select("target", "partner", "cosine", "dense_rank")


def _grams(key, table):
    ts = f"SELECT {key[0]} AS {key[1]}, {s_tokens('text')} AS ts FROM {table}"
    return f"SELECT {key[1]}, token, count(*) AS n FROM (SELECT {key[1]}, unnest(list_concat(ts, list_transform(range(1, len(ts)), lambda i: ts[i] || ' ' || ts[i + 1]))) AS token FROM ({ts})) GROUP BY ALL"


TFIDF_COSINE = f"""
WITH p AS ({_grams(('item_id', 'partner'), 'benchmark')}), t AS ({_grams(('doc_id', 'target'), 'documents')}),
n AS (SELECT CAST(count(*) + 1 AS DOUBLE) AS n FROM benchmark), df AS (SELECT token, CAST(count(*) AS DOUBLE) AS df FROM p GROUP BY token),
pw AS (SELECT partner, token, 1 + ln(p.n) AS tf, df FROM p JOIN df USING (token)),
pn AS (SELECT partner, sum((tf * (ln((1 + n.n) / (1 + df)) + 1)) ** 2) AS plain FROM pw, n GROUP BY partner),
tw AS (SELECT target, token, 1 + ln(t.n) AS tf, ln((1 + n.n) / (2 + coalesce(df, 0))) + 1 AS idf FROM t LEFT JOIN df USING (token), n),
tn AS (SELECT target, sum((tf * idf) ** 2) AS norm FROM tw GROUP BY target),
b AS (SELECT target, partner, sum(tw.tf * idf * pw.tf * idf) AS dot, sum((pw.tf * idf) ** 2 - (pw.tf * (ln((1 + n.n) / (1 + df)) + 1)) ** 2) AS more FROM tw JOIN pw USING (token), n GROUP BY ALL),
c AS (SELECT target, partner, round(dot / sqrt(norm * (plain + more)), 6) AS cosine FROM b JOIN tn USING (target) JOIN pn USING (partner))
SELECT *, CAST(row_number() OVER (PARTITION BY target ORDER BY cosine DESC, partner DESC) AS INT) AS dense_rank FROM c WHERE cosine > 0 QUALIFY dense_rank <= 10
"""


def partner_shortlist(spark, sf_dir):
    return _scored(spark, sf_dir).where("place <= 5").select("target", "partner", "place", F.round("fused", 6).alias("fused"), "sparse_rank", "dense_rank")


PARTNER_SHORTLIST = f"""
WITH f AS (SELECT target, partner, coalesce(cosine, 0) AS cosine, sparse_rank, dense_rank, coalesce(1.0::DOUBLE / (60 + sparse_rank), 0) + coalesce(1.0::DOUBLE / (60 + dense_rank), 0) AS fused
           FROM ({TOKEN_OVERLAP}) s FULL JOIN ({TFIDF_COSINE}) d USING (target, partner))
SELECT target, partner, CAST(row_number() OVER (PARTITION BY target ORDER BY fused DESC, cosine DESC, partner DESC) AS INT) AS place, round(fused, 6) AS fused, sparse_rank, dense_rank FROM f
QUALIFY place <= 5
"""


def dense_rank(spark, sf_dir):
    """Each vector against the mean vectors of the labels, the best three."""
    e = read(spark, sf_dir, "embeddings")
    flat = e.select("vec_id", "label", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.col("x").cast("double"))
    centre = flat.groupBy("label", "i").agg(F.avg("x").alias("c"))
    means = centre.groupBy(F.col("label").alias("partner")).agg(F.array_sort(F.collect_list(F.struct("i", "c"))).alias("cs")).select("partner", F.transform("cs", lambda x: x["c"]).alias("m"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    both = matching.all_pairs(e.select("vec_id", "embedding"), means)
    cos = dot(F.col("embedding"), F.col("m")) / F.sqrt(dot(F.col("embedding"), F.col("embedding")) * dot(F.col("m"), F.col("m")))
    both = both.select("vec_id", "partner", F.round(cos, 6).alias("cosine"))
    from pyspark.sql import Window

    w = Window.partitionBy("vec_id").orderBy(F.desc("cosine"), "partner")
    return both.withColumn("place", F.row_number().over(w)).where(F.col("place") <= 3)


DENSE_RANK = """
WITH f AS (SELECT vec_id, label, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings),
m AS (SELECT label, list(c ORDER BY i) AS m FROM (SELECT label, i, avg(CAST(x AS DOUBLE)) AS c FROM f GROUP BY ALL) GROUP BY label),
c AS (SELECT vec_id, m.label AS partner, round(list_cosine_similarity(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), m), 6) AS cosine FROM embeddings e, m)
SELECT vec_id, partner, cosine, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, partner) AS INT) AS place FROM c QUALIFY place <= 3
"""


def match_gate(spark, sf_dir):
    """The decision table over labelled documents: made-up model outputs that differ by document number."""
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.col("doc_id"), F.lit(n)) + 1).cast("int"))
    flag = lambda n: F.pmod("doc_id", F.lit(n)) == 0
    out = matching.assess(pick(("Acme", "No suitable match found", "", "Beta", "Gamma", "Delta", "Eta"), 7), pick(("strong", "medium", "no match", "other", "HIGH"), 5), pick(("hoch", "mittel", "low"), 3), ~flag(11), F.col("quality") == 1, F.col("toxic") == 0, F.col("n_chars") / 100000.0, F.pmod("doc_id", F.lit(2)), F.pmod("doc_id", F.lit(3)))
    return d.groupBy(out["decision"].alias("decision"), out["reason"].alias("reason"), out["confidence"].alias("confidence")).agg(F.count(F.lit(1)).alias("n"))


MATCH_GATE = """
WITH d AS (SELECT *, (['Acme', 'No suitable match found', '', 'Beta', 'Gamma', 'Delta', 'Eta'])[doc_id % 7 + 1] AS name, (['strong', 'medium', 'no match', 'other', 'HIGH'])[doc_id % 5 + 1] AS conf, (['hoch', 'mittel', 'low'])[doc_id % 3 + 1] AS score FROM documents JOIN labels USING (doc_id)),
c AS (SELECT *, CASE WHEN lower(conf) IN ('strong', 'high') THEN 'strong' WHEN conf IN ('weak', 'medium') THEN 'weak' WHEN conf = 'no match' THEN 'no_match' WHEN score = 'hoch' THEN 'strong' WHEN score = 'mittel' THEN 'weak' WHEN score = 'low' THEN 'no_match' ELSE 'weak' END AS c FROM d),
r AS (SELECT CASE WHEN name = '' THEN 'missing_partner_name' WHEN lower(name) = 'no suitable match found' OR c = 'no_match' THEN 'explicit_no_match' WHEN doc_id % 11 = 0 THEN 'matched_partner_data_missing'
        WHEN c = 'strong' AND quality = 1 AND toxic = 0 THEN 'accepted_strong_validated_evidence' WHEN c = 'strong' AND n_chars / 100000.0 >= 0.03 AND doc_id % 2 > 0 AND doc_id % 3 >= 1 THEN 'downgraded_strong_missing_direct_evidence'
        WHEN c = 'strong' THEN 'rejected_strong_missing_evidence' WHEN quality = 1 OR toxic = 0 OR doc_id % 2 > 0 THEN 'accepted_weak_match' ELSE 'rejected_weak_missing_evidence' END AS reason FROM c)
SELECT CASE reason WHEN 'accepted_strong_validated_evidence' THEN 'strong_match' WHEN 'downgraded_strong_missing_direct_evidence' THEN 'weak_match' WHEN 'accepted_weak_match' THEN 'weak_match' ELSE 'no_match' END AS decision, reason,
       CASE reason WHEN 'accepted_strong_validated_evidence' THEN 'strong' WHEN 'downgraded_strong_missing_direct_evidence' THEN 'weak' WHEN 'accepted_weak_match' THEN 'weak' ELSE 'no_match' END AS confidence, count(*) AS n
FROM r GROUP BY ALL
"""


def partner_dimension(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    site = F.concat(F.lower(F.regexp_replace("s_name", "[^A-Za-z0-9]", "")), F.lit(".example.com"))
    return s.select("s_suppkey", slug(F.col("s_name")).alias("slug"), partner_id(F.col("s_name"), site).alias("partner_id"), F.array_join(F.array_distinct(F.array(F.lower("s_name"), site, F.substring_index(site, ".", 1))), ";").alias("aliases"))


PARTNER_DIMENSION = f"""
WITH s AS (SELECT s_suppkey, s_name, replace({s_match_text('s_name')}, ' ', '-') AS slug, lower(regexp_replace(s_name, '[^A-Za-z0-9]', '', 'g')) || '.example.com' AS site FROM supplier)
SELECT s_suppkey, slug, slug || '-' || left(sha1(lower(trim(s_name)) || '|' || site), 8) AS partner_id, lower(s_name) || ';' || site || ';' || split_part(site, '.', 1) AS aliases FROM s
"""


def partner_choice(spark, sf_dir):
    """Customers name a supplier by id, by name in another case, by an alias or loosely; each finds its partner."""
    p = read(spark, sf_dir, "supplier").select(F.concat(F.lit("p"), F.col("s_suppkey").cast("string")).alias("partner_id"), F.col("s_name").alias("name"), F.array(F.concat(F.lit("alias "), F.col("s_suppkey").cast("string"))).alias("aliases"), F.col("s_suppkey").alias("position"))
    k, mod = F.col("c_custkey").cast("string"), F.pmod("c_custkey", F.lit(4))
    nine = F.lpad(k, 9, "0")
    name = F.when(mod == 1, F.concat(F.lit("SUPPLIER#"), nine)).when(mod == 2, F.concat(F.lit("Alias "), k)).when(mod == 3, F.concat(F.lit("supplier - "), nine)).otherwise("?")
    o = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"), F.when(mod == 0, F.concat(F.lit("P"), k)).alias("partner_id"), name.alias("partner_name"))
    return matching.canonical_partner(o, p).select("row_id", "matched_id", "matched_name", "level")


PARTNER_CHOICE = """
SELECT c_custkey AS row_id, CASE WHEN s_suppkey IS NOT NULL THEN 'p' || s_suppkey END AS matched_id, s_name AS matched_name, CAST(CASE WHEN s_suppkey IS NOT NULL THEN c_custkey % 4 END AS INT) AS level
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
"""

QUERIES = {
    "taxonomy_tags": (taxonomy_tags, TAXONOMY_TAGS), "taxonomy_alignment": (taxonomy_alignment, TAXONOMY_ALIGNMENT), "token_overlap": (token_overlap, TOKEN_OVERLAP),
    "tfidf_cosine": (tfidf_cosine, TFIDF_COSINE), "lowrank_cosine": (lowrank_cosine, None), "partner_shortlist": (partner_shortlist, PARTNER_SHORTLIST), "dense_rank": (dense_rank, DENSE_RANK),
    "match_gate": (match_gate, MATCH_GATE), "partner_dimension": (partner_dimension, PARTNER_DIMENSION), "partner_choice": (partner_choice, PARTNER_CHOICE),
}
