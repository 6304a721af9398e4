"""Quality rules at document and host level, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import WS, WS_RUN, materialize

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A document fails a host-level rule beyond these; shares are of its words, or of its lines with a word, as the name says.
MAX_SYMBOLS_PER_WORD = 0.5
MAX_DUP_LINES_PER_LINE = 0.3
MEAN_WORD_CHARS = (2.0, 15.0)
RULES = ("base", "symbols", "dup_lines", "word_chars")
#: A host is dropped when its shrunk failure rate in a rule is above so many times the mean rate of that rule, but never at
#: rates up to LEAST_LIMIT and always above MOST_LIMIT.
TIMES_MEAN, LEAST_LIMIT, MOST_LIMIT = 3.0, 0.1, 0.5
#: Documents that the prior may count for: a host of more speaks mostly for itself.
STRENGTH = (2.0, 100.0)


def repeat_words(grams: Column) -> Column:
    """Words inside 3-word windows that stand twice or more in the text; grams: a hash per window, by first word.

    Sorting (hash, position) puts equal windows side by side, so the work is n log n however often a text repeats.
    """
    once = F.size(F.array_distinct(grams)) == F.size(grams)
    ranked = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        return F.filter(s, lambda x, j: (F.get(s, j - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, j + 1)["h"].eqNullSafe(x["h"])))

    # an array of one array: the lambda names the sorted windows, so that they are sorted once
    found = F.transform(F.array(ranked), starts)[0]
    covered = F.flatten(F.transform(found, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return F.when(once, F.lit(0)).otherwise(F.size(F.array_distinct(covered))).cast("long")


def document_stats(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, source) to doc_id, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed.

    One pass over the text, no shuffle. Equal windows are found by 64-bit hashes of their words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", "source", text.alias("text"))
    bare = F.btrim(F.col("text"), F.lit(WS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WS_RUN))
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: F.btrim(x, F.lit(WS)) != "")
    d = d.select(
        "doc_id", "source", words.alias("words"), lines.alias("lines"),
        F.length(F.regexp_replace("text", WS_RUN, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"))
    at = lambda i: F.get(F.col("words"), i)
    windows = F.when(F.size("words") >= 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2))))
    d = d.select(
        "doc_id", "source", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(windows, F.array().cast("array<bigint>")).alias("grams"))
    d = d.withColumn("n_repeat_words", repeat_words(F.col("grams"))).drop("grams")
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def rule_failures() -> dict[str, Column]:
    """Whether a document (a row of document_stats) fails each of RULES."""
    n_words = F.greatest(F.col("n_words"), F.lit(1))
    mean_chars = F.col("word_chars") / n_words
    return {
        "base": F.col("base_failed"), "symbols": F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n_words,
        "dup_lines": F.col("n_dup_lines") > MAX_DUP_LINES_PER_LINE * F.col("n_lines"),
        "word_chars": (F.col("n_words") > 0) & ((mean_chars < MEAN_WORD_CHARS[0]) | (mean_chars > MEAN_WORD_CHARS[1]))}


def host_verdicts(stats: DataFrame) -> DataFrame:
    """Per (source, rule): n, failures, shrunk rate, its limit, ok; a host is fine if all its rules are.

    For each rule a Beta prior is fitted to the hosts' rates by moments, each host counting once, less what binomial
    counts alone scatter; its strength stays within STRENGTH. A host's rate is the posterior mean
    (failures + a) / (n + a + b): a small host follows the others until its own documents speak. It fails the rule above
    TIMES_MEAN times the prior mean, within LEAST_LIMIT and MOST_LIMIT. Counts are summed before the shuffle; a null
    source is a host of its own.
    """
    failures = rule_failures()
    hosts = stats.groupBy("source").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(failures[r]).alias(r) for r in RULES])
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("failures")) for r in RULES]))
    hosts = materialize(hosts.select("source", "n", each.alias("x")).select("source", "n", "x.*"), "hosts")
    own = F.col("failures") / F.col("n")
    prior = hosts.groupBy("rule").agg(F.avg(own).alias("rate"), F.avg(own * own).alias("square"), F.avg(1 / F.col("n")).alias("noise"))
    mean = F.least(F.greatest(F.col("rate"), F.lit(1e-6)), F.lit(1 - 1e-6))
    prior = prior.select(F.col("rule").alias("_rule"), mean.alias("mean"), "square", "noise")
    spread = F.greatest(F.col("square") - F.col("mean") * F.col("mean") - F.col("mean") * (1 - F.col("mean")) * F.col("noise"), F.lit(1e-9))
    strength = F.least(F.greatest(F.col("mean") * (1 - F.col("mean")) / spread - 1, F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))
    prior = prior.withColumn("strength", strength)
    limit = F.least(F.lit(MOST_LIMIT), F.greatest(F.lit(LEAST_LIMIT), TIMES_MEAN * F.col("mean")))
    rate = (F.col("failures") + F.col("mean") * F.col("strength")) / (F.col("n") + F.col("strength"))
    out = hosts.join(F.broadcast(prior), F.col("rule") == F.col("_rule"))  # a row a rule
    return out.select("source", "rule", "n", "failures", rate.alias("rate"), limit.alias("limit"), (rate <= limit).alias("ok"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """document_stats with kept: false if base_failed, else the verdict on the document's host.

    Null text: no words, so base_failed. Long texts are read whole. Repeated rows are judged each. An empty table gives no
    rows; further columns are not read. The host join is a plain join of small rows, which adaptive execution splits
    where a host holds many documents.
    """
    stats = materialize(document_stats(docs), "stats")
    hosts = host_verdicts(stats).groupBy(F.col("source").alias("_source")).agg(F.bool_and("ok").alias("host_ok"))
    joined = stats.join(hosts, F.col("source").eqNullSafe(F.col("_source")))
    return joined.select(*stats.columns, (~F.col("base_failed") & F.col("host_ok")).alias("kept"))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP4_SQL = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls, row_number() OVER () AS rid FROM t),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM l WHERE len(w) >= 3)),
r AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i + k) AS n FROM r, range(3) ks(k) GROUP BY rid),
s AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, len(ls) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words FROM l LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
f AS (SELECT *, [base_failed, n_symbols > 0.5 * greatest(n_words, 1), n_dup_lines > 0.3::DOUBLE * n_lines,
        n_words > 0 AND (word_chars / greatest(n_words, 1) < 2 OR word_chars / greatest(n_words, 1) > 15)] AS fails FROM b),
h AS (SELECT source, rule, count(*)::DOUBLE AS n, sum(fails[rule]::INT)::DOUBLE AS f FROM f, range(1, 5) x(rule) GROUP BY ALL),
p AS (SELECT rule, least(greatest(avg(f / n), 1e-6), 1 - 1e-6) AS m, avg((f / n) ** 2) AS mm, avg(1 / n) AS noise FROM h GROUP BY rule),
q AS (SELECT rule, m, least(greatest(m * (1 - m) / greatest(mm - m * m - m * (1 - m) * noise, 1e-9) - 1, 2), 100) AS z FROM p),
v AS (SELECT source, bool_and((f + m * z) / (n + z) <= least(0.5, greatest(0.1, 3 * m))) AS host_ok FROM h JOIN q USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND host_ok) AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
