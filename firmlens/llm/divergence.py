"""Source divergence audit: how far the sources of a language lie apart by their terms, over dense tiles of term blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmlens.llm.common import batches_of, enter, find_package, materialize, parallelism, release_memory, text_bytes

#: Documents that a kept term is in, ranks of the term part, the scale of a share and what is added to each count.
LEAST_DOCS, RANKS, SCALE, PRIOR = 10, 10, 10**9, 2
#: Terms of a tile, sources of a side of it, and bytes of text after which a task gives its counts away.
TERMS, SOURCES, BLOCK = 2048, 64, 32 << 20
#: Bytes of the table of sources that may be broadcast; above that it is joined by a shuffle.
BROADCAST = 4 << 20

#: Bytes of terms stay (A-Z in lower case), all others become spaces.
_TERM = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


# ---------------------------------------------------------------- counts

class TermCounts:
    """Occurrences and documents of (source, term) over many documents."""

    def __init__(self):
        self.codes: dict[bytes, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = self.merged = 0

    def add(self, texts: list[bytes], sources: np.ndarray) -> None:
        split = [t.translate(_TERM).split() for t in texts]
        flat = [w for ws in split for w in ws]
        codes = self.codes
        for w in flat:
            if w not in codes:
                codes[w] = len(codes)
        code = np.fromiter(map(codes.__getitem__, flat), np.int64, len(flat))
        doc = np.repeat(np.arange(len(texts)), list(map(len, split)))
        key, n = np.unique(doc << 32 | code, return_counts=True)
        self.parts.append((sources[key >> 32] << 32 | key & 0xFFFFFFFF, n, np.ones(len(n), np.int64)))
        self.held += len(n)
        if self.held > 2 * self.merged + (1 << 18):
            self.merge()

    def merge(self) -> None:
        key, n, docs = (np.concatenate(c) for c in zip(*self.parts))
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
        if len(key):
            key, n, docs = key[first], np.add.reduceat(n[order], first), np.add.reduceat(docs[order], first)
        self.parts, self.held, self.merged = [(key, n, docs)], len(key), len(key)

    def rows(self):
        """Batches of source, term, occurrences, documents."""
        self.merge()
        key, n, docs = self.parts[0]
        terms = pa.array(list(self.codes), pa.binary()).cast(pa.string())
        for a in range(0, len(key), 1 << 16):
            own = slice(a, a + (1 << 16))
            yield pa.array(key[own] >> 32), terms.take(pa.array(key[own] & 0xFFFFFFFF)), pa.array(n[own]), pa.array(docs[own])


def term_counts(docs: DataFrame) -> DataFrame:
    """docs(text, lang_no, source_no) to lang_no, source_no, term, n, docs: partial counts, one row a task's block, source and
    term."""

    def run(frames):
        enter("terms")
        counts: dict[int, TermCounts] = {}
        names, size = ["lang_no", "source_no", "term", "n", "docs"], 0

        def flush():
            for lang, c in counts.items():
                for columns in c.rows():
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), lang, np.int64)), *columns], names=names)
            counts.clear()

        for frame in batches_of(frames, 1 << 20):
            body, offsets = text_bytes(frame.column(0))
            view = body.tobytes()
            texts = [view[a:b] for a, b in zip(offsets, offsets[1:])]
            lang, source = (frame.column(i).to_numpy() for i in (1, 2))
            for one in np.unique(lang).tolist():
                own = np.flatnonzero(lang == one)
                counts.setdefault(one, TermCounts()).add([texts[i] for i in own], source[own])
            size += len(view)
            if size >= BLOCK:
                yield from flush()
                size = 0
        yield from flush()
        release_memory()

    return docs.select("text", "lang_no", "source_no").mapInArrow(run, "lang_no long, source_no long, term string, n long, docs long")


# ---------------------------------------------------------------- tiles

def shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), three decimal places at a time, so that no product is
    above 2 ** 63 while totals are below 9e15."""
    below = total + PRIOR * terms
    rest, out = count + PRIOR, np.zeros(np.broadcast(count, total).shape, np.int64)
    whole, rest = np.divmod(rest, below)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + step
    return 1 + whole * SCALE + out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    apart = p - q
    return apart * apart // (p + q)


def tile_sums(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sums over the terms of the divergence of each row of p to each of q: all pairs by broadcasting, some rows at a time."""
    out = np.empty((len(p), len(q)), np.int64)
    step = max(1, (1 << 20) // max(1, q.size))
    for a in range(0, len(p), step):
        out[a : a + step] = divergence(p[a : a + step, None], q[None]).sum(axis=2)
    return out


def tile_rows(terms: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """A tile's partial results. terms: term, total, sources, counts; groups: side, source_no, size, lang_size, lang_terms.

    Pairs: for each source of side 0 and each of side 1 the sum of divergences over the tile's terms. Terms (where both
    sides are the same sources): of each source the RANKS terms that it has more of than its language and that diverge
    most.
    """
    out = {"source_no": [], "other_no": [], "term": [], "value": []}
    v, in_lang = int(groups["lang_terms"].iloc[0]), groups["lang_size"].iloc[0]
    sides, counts = [], None
    column = np.repeat(np.arange(len(terms)), terms["sources"].map(len))
    source, n = np.concatenate(terms["sources"].to_list()), np.concatenate(terms["counts"].to_list())
    for side in sorted(groups["side"].unique()):
        own = groups[groups["side"] == side].sort_values("source_no")
        number, size = own["source_no"].to_numpy(), own["size"].to_numpy()
        row = np.searchsorted(number, source)
        mine = (row < len(number)) & (number[np.minimum(row, len(number) - 1)] == source)
        counts = np.zeros((len(number), len(terms)), np.int64)
        counts[row[mine], column[mine]] = n[mine]
        sides.append((number, shares(counts, size[:, None], v)))
    (left, p), (right, q) = sides[0], sides[-1]
    out["source_no"] += np.repeat(left, len(right)).tolist()
    out["other_no"] += np.tile(right, len(left)).tolist()
    out["value"] += tile_sums(p, q).reshape(-1).tolist()
    out["term"] += [None] * (len(left) * len(right))
    if len(sides) == 1:
        whole = shares(terms["total"].to_numpy(), np.int64(in_lang), v)
        names = terms["term"].to_numpy()
        place = np.argsort(np.argsort(np.array([t.encode() for t in names], object), kind="stable"))
        for i, number in enumerate(left):
            over = np.flatnonzero((counts[i] > 0) & (p[i] > whole))
            value = divergence(p[i, over], whole[over])
            best = np.lexsort((place[over], -value))[:RANKS]
            out["source_no"] += [number] * len(best)
            out["other_no"] += [None] * len(best)
            out["term"] += names[over[best]].tolist()
            out["value"] += value[best].tolist()
    return pd.DataFrame({"source_no": pd.array(out["source_no"], "Int64"), "other_no": pd.array(out["other_no"], "Int64"), "term": pd.Series(out["term"], dtype=object), "value": pd.array(out["value"], "Int64")})


def audit_sources(docs: DataFrame) -> DataFrame:
    """docs(text, lang, source) to lang, source, part, item, value, rank: for each source of each language how far it lies
    from each other one (part pair), and the terms that set it apart from its language most (part term, RANKS at most).

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z in lower case; a language keeps those in at least
    LEAST_DOCS of its documents. A share is p = 1 + floor(1e9 * (count + 2) / (N + 2 V)), a divergence floor((p - q) ** 2 /
    (p + q)); all in whole numbers of 64 bits, exact while a language has fewer than 9e15 kept occurrences.

    1. Tasks count (language, source, term) over blocks of text, so a frequent term or large source is a few rows a task.
    2. A term's counts meet by (language, term); kept ones are written, with one list of counts a term.
    3. Terms are dealt in blocks of about TERMS a language, sources in runs of SOURCES: each block of terms and two runs of
       sources make a tile, a dense matrix of shares, whose pairs are all taken by broadcasting. Tiles' sums are added,
       tiles' best terms merged.

    Null text, lang and source are ''. A (lang, source) without terms takes part, with value 0 to all if its language keeps
    no term. Long texts are whole; repeated rows count as often as they come. Ties go by the item's UTF-8 bytes. An empty
    table gives no rows; further columns are not read. The pairs of a language are the square of its sources, as asked.
    """
    spark = docs.sparkSession
    find_package(spark)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = docs.select(text("text").alias("text"), text("lang").alias("lang"), text("source").alias("source"))
    pairs = materialize(docs.select("lang", "source").distinct().withColumn("source_no", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1), "pairs")
    ids = materialize(pairs.select(F.col("lang").alias("_lang")).distinct().withColumn("lang_no", F.monotonically_increasing_id()), "language-numbers")
    numbered = materialize(pairs.join(ids, F.col("lang") == F.col("_lang")).drop("_lang"), "sources")
    on = numbered.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "lang_no", "source_no")
    if numbered.agg(F.coalesce(F.sum(F.octet_length("lang").cast("long") + F.octet_length("source") + 64), F.lit(0)).alias("n")).first()["n"] <= BROADCAST:
        on = F.broadcast(on)
    counted = term_counts(docs.join(on, (F.col("lang") == F.col("_lang")) & (F.col("source") == F.col("_source"))))
    met = counted.repartition(parallelism(spark), "lang_no", "term").groupBy("lang_no", "term", "source_no").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = met.groupBy("lang_no", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list("source_no").alias("sources"), F.collect_list("n").alias("counts"))
    kept = materialize(kept.where(F.col("docs") >= LEAST_DOCS).drop("docs"), "terms")
    sizes = kept.select("lang_no", F.explode(F.arrays_zip("sources", "counts")).alias("c")).groupBy(F.col("lang_no").alias("_lang_no"), F.col("c.sources").alias("_source_no")).agg(F.sum("c.counts").alias("size"))
    langs = kept.groupBy(F.col("lang_no").alias("_lang_no")).agg(F.count(F.lit(1)).alias("lang_terms"), F.sum("total").alias("lang_size"))
    runs = numbered.groupBy(F.col("lang_no").alias("_l")).agg(F.floor(F.max("source_no") / SOURCES).alias("runs"))
    langs = materialize(langs.join(runs, F.col("_lang_no") == F.col("_l")).drop("_l").withColumn("blocks", F.ceil(F.col("lang_terms") / TERMS)), "languages", 1)
    groups = numbered.select("lang_no", "source_no").join(sizes, (F.col("lang_no") == F.col("_lang_no")) & (F.col("source_no") == F.col("_source_no")), "left")
    groups = groups.select("lang_no", "source_no", F.coalesce("size", F.lit(0).cast("long")).alias("size")).join(langs, F.col("lang_no") == F.col("_lang_no"))
    # a run of sources is in the tiles (run, later run) as side 0 and (earlier run, run) as side 1
    run = F.floor(F.col("source_no") / SOURCES)
    tiles = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("runs")), lambda r: F.struct(F.least(r, run).alias("x"), F.greatest(r, run).alias("y"), F.when(r < run, 1).otherwise(0).alias("side"))))
    groups = groups.withColumn("t", tiles).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    groups = groups.select("lang_no", "block", "t.x", "t.y", "t.side", "source_no", "size", "lang_size", "lang_terms")
    every = F.sequence(F.lit(0).cast("long"), F.col("runs"))
    both = F.explode(F.flatten(F.transform(every, lambda x: F.transform(F.sequence(x, F.col("runs")), lambda y: F.struct(x.alias("x"), y.alias("y"))))))
    terms = kept.join(langs.select("_lang_no", "runs", "blocks"), F.col("lang_no") == F.col("_lang_no")).withColumn("t", both)
    terms = terms.select("lang_no", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "t.x", "t.y", "term", "total", "sources", "counts")

    def tile(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        enter("tiles")
        out = tile_rows(left, right) if len(left) and len(right) else pd.DataFrame({"source_no": [], "other_no": [], "term": [], "value": []}, dtype=object)
        out.insert(0, "lang_no", key[0])
        return out

    keys = ("lang_no", "block", "x", "y")
    made = terms.groupBy(*keys).cogroup(groups.groupBy(*keys)).applyInPandas(tile, "lang_no long, source_no long, other_no long, term string, value long")
    made = materialize(made, "tiles")
    one_way = made.where("term IS NULL").groupBy("lang_no", "source_no", "other_no").agg(F.sum("value").alias("value"))
    sums = one_way.unionByName(one_way.where(F.floor(F.col("source_no") / SOURCES) != F.floor(F.col("other_no") / SOURCES)).select("lang_no", F.col("other_no").alias("source_no"), F.col("source_no").alias("other_no"), "value"))
    sums = sums.select(F.col("lang_no").alias("_l"), F.col("source_no").alias("_s"), F.col("other_no").alias("_o"), "value")
    others = numbered.select(F.col("lang").alias("_lang"), F.col("source").alias("item"), F.col("source_no").alias("other_no"))
    pair = numbered.join(others, (F.col("lang") == F.col("_lang")) & (F.col("source_no") != F.col("other_no")))
    pair = pair.join(sums, (F.col("lang_no") == F.col("_l")) & (F.col("source_no") == F.col("_s")) & (F.col("other_no") == F.col("_o")), "left")
    pair = pair.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    best = made.where("term IS NOT NULL").select(F.col("lang_no").alias("_l"), F.col("source_no").alias("_s"), "term", "value")
    best = numbered.join(best, (F.col("lang_no") == F.col("_l")) & (F.col("source_no") == F.col("_s"))).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return pair.withColumn("rank", place).unionByName(best.withColumn("rank", place).where(F.col("rank") <= RANKS))


def op11_divergence_audit(spark, sf_dir: str) -> DataFrame:
    return audit_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS BIGINT) AS total FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= {LEAST_DOCS}),
l AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(total) AS HUGEINT) AS size FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, CAST(count(*) AS BIGINT) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT g.lang, g.source, CAST(coalesce(sum(n), 0) AS HUGEINT) AS size FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (SELECT s.lang, s.source, k.term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (s.size + 2 * v) AS p,
        1 + (1000000000::HUGEINT * (total + 2)) // (l.size + 2 * v) AS q
    FROM s JOIN l ON l.lang = s.lang JOIN k ON k.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
t AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
u AS (SELECT * FROM o UNION ALL SELECT * FROM t)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u) WHERE part = 'pair' OR rank <= {RANKS}
"""
