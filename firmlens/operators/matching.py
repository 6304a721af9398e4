"""Partner matching: taxonomy tags, term overlap, TF-IDF cosine, reciprocal rank fusion, the evidence gate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlens.functions import fixed
from firmlens.functions.eigen import largest
from firmlens.functions.text import clean_text, match_text, match_tokens
from firmlens.shared import find_package

#: Rows that a partner or taxonomy table may have to be broadcast; larger ones are joined by their keys.
SMALL_TABLE = 100_000
#: Terms of all partners that are sent to every task as postings (about 24 bytes each).
MAX_TERMS = 4_000_000
#: Partners whose rows may be decomposed with each target.
LOW_RANK_PARTNERS = 1_000
#: Tasks that targets are dealt over before decompositions, times the cores or the partitions they come in.
LOW_RANK_TASKS = 8


def small(table: DataFrame) -> DataFrame:
    """The table with a broadcast hint where a count shows that it is small."""
    return F.broadcast(table) if table.limit(SMALL_TABLE + 1).count() <= SMALL_TABLE else table


def all_pairs(rows: DataFrame, few: DataFrame) -> DataFrame:
    """Every row with every row of a table that a count shows to be small; a larger one is an error."""
    if few.limit(SMALL_TABLE + 1).count() > SMALL_TABLE:
        raise ValueError(f"a table of more than {SMALL_TABLE} rows against all others")
    return rows.crossJoin(F.broadcast(few))


def tag_weight(category: Column, tag: Column) -> Column:
    out = F.lit(None).cast("int")
    for t, w in fixed.GENERIC_TAG_WEIGHTS.items():
        out = F.coalesce(out, F.when(tag == t, w))
    for c, w in fixed.TAG_WEIGHTS.items():
        out = F.coalesce(out, F.when(category == c, w))
    return F.coalesce(out, F.lit(0))


def domain_penalties(spark) -> DataFrame:
    rows = [(t, p, v) for t, ps in fixed.DOMAIN_PENALTIES.items() for p, v in ps.items()]
    return spark.createDataFrame(rows, "target_domain string, partner_domain string, penalty int")


def taxonomy_alignment(targets: DataFrame, partners: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs(target, partner) with score, shared and penalty: weights of shared tags, less the domain penalties of pairs
    without a shared audience or workflow tag. targets and partners: (target or partner, category, tag)."""
    both = targets.join(partners, ["category", "tag"])
    shared = both.groupBy("target", "partner").agg(
        F.sum(tag_weight(F.col("category"), F.col("tag"))).alias("overlap"), F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("shared"),
        F.bool_or(F.col("category").isin("audience", "workflow")).alias("close"))
    td = targets.where("category = 'domain'").select("target", F.col("tag").alias("target_domain"))
    pd = partners.where("category = 'domain'").select("partner", F.col("tag").alias("partner_domain"))
    off = td.join(F.broadcast(domain_penalties(targets.sparkSession)), "target_domain").join(pd, "partner_domain").groupBy("target", "partner").agg(F.sum("penalty").alias("off"))
    out = pairs.join(shared, ["target", "partner"], "left").join(off, ["target", "partner"], "left")
    penalty = F.when(F.coalesce("close", F.lit(False)), F.lit(0)).otherwise(F.coalesce("off", F.lit(0)))
    return out.select("target", "partner", (F.coalesce("overlap", F.lit(0)) - penalty).alias("score"), F.coalesce("shared", F.lit("")).alias("shared"), penalty.alias("penalty"))


def weighted_terms(rows: DataFrame, key: str, columns: dict[str, int]) -> DataFrame:
    """(key, token, weight): each token of the columns, weighted by the column and by how often it stands there."""
    weigh = lambda w: lambda t: F.struct(t.alias("token"), F.lit(w).alias("w"))
    parts = F.concat(*[F.transform(match_tokens(F.col(c)), weigh(w)) for c, w in columns.items()])
    return rows.select(key, F.explode(parts).alias("_x")).groupBy(key, F.col("_x.token").alias("token")).agg(F.sum("_x.w").alias("weight"))


def term_overlap(targets: DataFrame, partners: DataFrame) -> DataFrame:
    """(target, partner, score, terms): sums of target weights over the tokens both have. An equi join on the token: pairs
    without one never exist."""
    p = partners.select("partner", "token").distinct()
    return targets.join(p, "token").groupBy("target", "partner").agg(F.sum("weight").alias("score"), F.count(F.lit(1)).alias("terms"))


def tfidf_cosine(targets: DataFrame, partners: DataFrame) -> DataFrame:
    """(target, partner, cosine) of TF-IDF vectors with sublinear counts and smooth idf; the corpus of a target is itself and
    all partners. targets and partners: (target or partner, token, n).

    The idf differs by target only for its own tokens (one document more), so partners' norms are a sum over the plain
    corpus plus a correction over the shared tokens, and everything is joins on tokens.
    """
    size = partners.select("partner").distinct().count() + 1
    tf = 1 + F.log(F.col("n").cast("double"))
    idf = lambda df: F.log((1.0 + size) / (1.0 + df)) + 1.0
    df = partners.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    p = partners.withColumn("tf", tf).join(df, "token").select("partner", "token", F.col("tf").alias("ptf"), "df")
    norms = p.groupBy("partner").agg(F.sum(F.pow(F.col("ptf") * idf(F.col("df")), 2)).alias("plain"))
    t = targets.withColumn("ttf", tf).join(df, "token", "left").withColumn("tidf", idf(F.coalesce("df", F.lit(0)) + 1)).drop("n", "df")
    tn = t.groupBy("target").agg(F.sum(F.pow(F.col("ttf") * F.col("tidf"), 2)).alias("tnorm"))
    both = t.join(p, "token").groupBy("target", "partner").agg(
        F.sum(F.col("ttf") * F.col("tidf") * F.col("ptf") * F.col("tidf")).alias("dot"),
        F.sum(F.pow(F.col("ptf") * F.col("tidf"), 2) - F.pow(F.col("ptf") * idf(F.col("df")), 2)).alias("more"))
    out = both.join(tn, "target").join(norms, "partner")
    return out.select("target", "partner", (F.col("dot") / F.sqrt(F.col("tnorm") * (F.col("plain") + F.col("more")))).alias("cosine"))


def hashed_terms(tokens: Column) -> tuple[Column, Column]:
    """Of an array of tokens: their 64-bit hashes, and those with the hashes of pairs of neighbours (1- and 2-grams)."""
    one = F.transform(tokens, lambda t: F.xxhash64(t))
    two = F.transform(F.sequence(F.lit(1), F.size(tokens) - 1), lambda i: F.xxhash64(F.get(tokens, i - 1), F.get(tokens, i)))
    return one, F.concat(one, F.when(F.size(tokens) > 1, two).otherwise(F.array().cast("array<bigint>")))


def _distinct(rows: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) with their summed weights, in order."""
    order = np.lexsort((terms, rows))
    r, t = rows[order], terms[order]
    first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (t[1:] != t[:-1])])) if len(r) else np.zeros(0, np.int64)
    return r[first], t[first], np.add.reduceat(weights[order], first) if len(first) else np.zeros(0)


class PartnerIndex:
    """Postings of a small partner table: by term, which partners have it, how often; and each partner's plain norm."""

    def __init__(self, sparse: list, dense: list):
        self.size = len(sparse)
        flat = lambda xs: (np.repeat(np.arange(len(xs)), [len(x) for x in xs]), np.array([t for x in xs for t in x], np.int64))
        self.sparse = self.postings(*_distinct(*flat(sparse), np.ones(sum(map(len, sparse)))))
        p, t, n = _distinct(*flat(dense), np.ones(sum(map(len, dense))))
        tf = 1 + np.log(n) if len(n) else n
        terms, df = np.unique(t, return_counts=True)
        self.plain = np.bincount(p, (tf * self.idf(df[np.searchsorted(terms, t)])) ** 2, self.size) if len(p) else np.zeros(self.size)
        self.dense = self.postings(p, t, tf)
        self._gram: np.ndarray | None = None

    def gram(self) -> np.ndarray:
        """Products of all partners' plain vectors, a block of terms at a time."""
        if self._gram is None:
            terms, bounds, partner, tf = self.dense
            self._gram = np.zeros((self.size, self.size))
            weight = tf * np.repeat(self.idf(np.diff(bounds)), np.diff(bounds))
            for a in range(0, len(terms), 4096):
                b = min(a + 4096, len(terms))
                own = slice(bounds[a], bounds[b])
                block = np.zeros((self.size, b - a))
                block[partner[own], np.repeat(np.arange(b - a), np.diff(bounds[a : b + 1]))] = weight[own]
                self._gram += block @ block.T
        return self._gram

    def reduced_cosines(self, term: np.ndarray, count: np.ndarray, most: int) -> np.ndarray:
        """all_reduced_cosines() of one target."""
        return self.all_reduced_cosines([(term, count)], most)[0]

    def all_reduced_cosines(self, targets: list[tuple[np.ndarray, np.ndarray]], most: int) -> np.ndarray:
        """Cosines of targets, each its distinct terms and their counts, to all partners after a truncated SVD of the TF-IDF rows of
        the target and all partners to at most `most` dimensions.

        The rows' products say all: with G = V diag(l) V', the reduced rows are the first columns of V by l, times the root of
        l. Fewer than four rows or terms: the rows themselves. A target that shares no term is at right angles to all.
        """
        out = np.zeros((len(targets), self.size))
        rows = self.size + 1
        held = np.empty((max(1, min(128, (1 << 26) // (8 * rows * rows))), rows, rows))
        of: list[int] = []  # whose products are held, and the number of dimensions that all of them are reduced to
        k = 0

        def reduce() -> None:
            g = held[: len(of)]
            if k:
                values, vectors = largest(g, k)
                reduced = vectors * np.sqrt(np.maximum(values, 0))[:, None]
                first, square = (reduced @ reduced[:, 0, :, None])[:, :, 0], np.einsum("bij,bij->bi", reduced, reduced)
            else:
                first, square = g[:, 0], np.diagonal(g, axis1=1, axis2=2)
            own = np.sqrt(np.maximum(square, 0))
            out[of] = np.where((own[:, 1:] > 1e-9) & (own[:, :1] > 1e-9), first[:, 1:] / np.maximum(own[:, 1:] * own[:, :1], 1e-300), 0.0)
            of.clear()

        for i, (term, count) in enumerate(targets):
            last = len(of)
            features = self.products(term, count, held[last])
            if not features:
                continue
            wanted = max(2, min(most, rows - 1, features - 1)) if rows >= 4 and features >= 4 else 0
            if of and wanted != k:
                reduce()
                held[0] = held[last]
            k = wanted
            of.append(i)
            if len(of) == len(held):
                reduce()
        if of:
            reduce()
        return out

    def products(self, term: np.ndarray, count: np.ndarray, g: np.ndarray) -> int:
        """Into g: the products of the unit rows of a target (the first) and all partners. Gives the number of all their terms, or 0
        and nothing where the target shares none.

        The target moves the weights of its own terms only (always down), so the partners' products are the plain ones less
        these terms' parts; a term of one partner counts in that partner's length only.
        """
        hit, n, partner, ptf = self.find(self.dense, term)
        if not len(hit):
            return 0
        df = np.zeros(len(term))
        df[hit] = n
        ttf, tidf = 1 + np.log(np.maximum(count, 1)), self.idf(df + 1)
        lost = self.idf(df[hit]) ** 2 - tidf[hit] ** 2
        g[1:, 1:] = self.gram()
        single, column = np.repeat(n == 1, n), np.repeat(np.arange(len(hit)), n)
        both = ~single
        if both.any():
            place = np.cumsum(n > 1) - 1
            tf = np.zeros((self.size, place[-1] + 1))
            tf[partner[both], place[column[both]]] = ptf[both] * np.sqrt(lost)[column[both]]
            g[1:, 1:] -= tf @ tf.T
        g[np.arange(1, self.size + 1), np.arange(1, self.size + 1)] -= np.bincount(partner[single], ptf[single] ** 2 * lost[column[single]], self.size)
        g[0, 1:] = g[1:, 0] = np.bincount(partner, ptf * (ttf[hit] * tidf[hit] ** 2)[column], self.size)
        g[0, 0] = ((ttf * tidf) ** 2).sum()
        length = np.sqrt(np.maximum(np.diag(g), 0))
        length[length < 1e-12] = np.inf  # rows without terms
        g *= (1 / length)[:, None]
        g *= 1 / length
        return len(self.dense[0]) + len(term) - len(hit)

    def idf(self, df: np.ndarray) -> np.ndarray:
        return np.log((2.0 + self.size) / (1.0 + df)) + 1.0

    @staticmethod
    def postings(partner, term, weight):
        order = np.argsort(term, kind="stable")
        terms, first = np.unique(term[order], return_index=True)
        return terms, np.append(first, len(term)), partner[order], weight[order]

    @staticmethod
    def find(index, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For terms: which of them are known, how many partners have each of these, and those partners and weights."""
        known, bounds, partner, weight = index
        at = np.minimum(np.searchsorted(known, terms), max(len(known) - 1, 0))
        hit = np.flatnonzero(known[at] == terms) if len(known) else np.zeros(0, np.int64)
        low = bounds[at[hit]]
        n = bounds[at[hit] + 1] - low
        where = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return hit, n, partner[where], weight[where]

    def scores(self, n_rows: int, sparse: tuple | None, dense: tuple | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of rows against all partners: sums of shared weights, numbers of shared terms, cosines; zeros for what isn't given."""
        shape = (n_rows, self.size)
        cells = lambda rows, partners, w: np.bincount(rows * self.size + partners, w, n_rows * self.size).reshape(shape)
        score = terms = np.zeros(shape)
        if sparse:
            row, term, weight = sparse
            hit, n, partner, _ = self.find(self.sparse, term)
            rows = np.repeat(row[hit], n)
            score, terms = cells(rows, partner, np.repeat(weight[hit], n)), cells(rows, partner, None)
        if not dense:
            return score, terms, np.zeros(shape)
        row, term, count = dense
        hit, n, partner, ptf = self.find(self.dense, term)
        df = np.zeros(len(term))
        df[hit] = n
        ttf, tidf = 1 + np.log(np.maximum(count, 1)), self.idf(df + 1)
        norm = np.bincount(row, (ttf * tidf) ** 2, n_rows) if len(row) else np.zeros(n_rows)
        rows, t, i, plain = np.repeat(row[hit], n), np.repeat(ttf[hit], n), np.repeat(tidf[hit], n), np.repeat(self.idf(df[hit]), n)
        dot = cells(rows, partner, t * i * ptf * i)
        more = cells(rows, partner, (ptf * i) ** 2 - (ptf * plain) ** 2)
        return score, terms, dot / np.sqrt(np.maximum(norm[:, None] * (self.plain + more), 1e-300))


SCORED = "partner long, score long, terms long, cosine double, sparse_rank int, dense_rank int, fused double, place int"


def score_partners(targets: DataFrame, partners: DataFrame, weights: dict[str, int], *, k: int = 60, top: int = 10, sparse: bool = True, dense: bool = True, dimensions: int | None = None) -> DataFrame:
    """Per row of targets(target, dense, and array columns of terms by weights): the partners among its first `top` by
    shared terms, or by TF-IDF cosine of 1- and 2-grams (each SCORED column null where a partner is not among them), and
    their place by reciprocal rank fusion.

    partners: partner, position (its place in the list, which breaks ties), sparse, dense. All are arrays of hashed terms.
    The partner table is a parameter of a run: MAX_TERMS terms and SMALL_TABLE rows at most are sent to every task as
    postings, and each target's terms are folded against them in place, so that nothing is shuffled; a larger table is an
    error (term_overlap, tfidf_cosine and rank_fusion join on terms instead). Cosines count to six decimals in ranks. The
    corpus of a target is itself and all partners. Targets without any shared term give no rows.

    sparse, dense: which of the two are asked for; what isn't is neither computed nor counted. dimensions: cosines after a
    truncated SVD to as many (32 is usual), for each target of its own, from products of rows that all targets share; its
    cost grows with the third power of the partners' number, so at most LOW_RANK_PARTNERS of them.
    """
    find_package(targets.sparkSession)
    size = partners.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("sparse") + F.size("dense")), F.lit(0)).alias("terms")).first()
    if size["rows"] > SMALL_TABLE or size["terms"] > MAX_TERMS:
        raise ValueError(f"{size['rows']} partners with {size['terms']} terms are too many to send to every task")
    if dimensions and size["rows"] > LOW_RANK_PARTNERS:
        raise ValueError(f"{size['rows']} partners are too many for a decomposition with each target")
    rows = partners.select("partner", "position", "sparse", "dense").orderBy("position", "partner").collect()
    names = np.array([r["partner"] for r in rows], np.int64)
    index = PartnerIndex([r["sparse"] for r in rows], [r["dense"] for r in rows])
    if dimensions:
        index.gram()
    shared = targets.sparkSession.sparkContext.broadcast(index)
    columns = list(weights.items())
    kind = dict(targets.dtypes)["target"]

    def ranks(values: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Places of the first `top` by value among those that are some, else 0; the list's order breaks ties."""
        order = np.argsort(-values, kind="stable")
        order = order[some[order]][:top]
        out = np.zeros(len(values), np.int64)
        out[order] = np.arange(1, len(order) + 1)
        return out

    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        sizes = np.diff(lists.offsets.to_numpy())
        return np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy(zero_copy_only=False)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        step = max(1, min(512, 4_000_000 // max(index.size, 1)))
        for whole in frames:
            for start in range(0, whole.num_rows, step):
                frame = whole.slice(start, step)
                listed = counted = None
                if sparse:
                    parts = [(*flat(frame.column(frame.schema.get_field_index(c))), w) for c, w in columns]
                    listed = _distinct(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([np.full(len(p[0]), float(p[2])) for p in parts]))
                if dense:
                    own = flat(frame.column(frame.schema.get_field_index("dense")))
                    counted = _distinct(*own, np.ones(len(own[0])))
                score, terms, cosine = index.scores(frame.num_rows, listed, None if dimensions else counted)
                if dense and dimensions:
                    cuts = np.searchsorted(counted[0], np.arange(frame.num_rows + 1))
                    cosine = index.all_reduced_cosines([(counted[1][a:b], counted[2][a:b]) for a, b in zip(cuts, cuts[1:])], dimensions)
                cosine = np.round(cosine, 6)
                out: list[tuple] = []
                for i in range(frame.num_rows):
                    s, d = ranks(score[i], terms[i] > 0), ranks(cosine[i], cosine[i] > 0)
                    at = np.flatnonzero((s > 0) | (d > 0))
                    fused = np.where(s[at] > 0, 1.0 / (k + s[at]), 0.0) + np.where(d[at] > 0, 1.0 / (k + d[at]), 0.0)
                    places = np.empty(len(at), np.int64)
                    places[np.lexsort((at, -np.where(d[at] > 0, cosine[i][at], 0.0), -fused))] = np.arange(1, len(at) + 1)
                    for a, f, p in zip(at, fused, places, strict=True):
                        x, y = s[a] > 0, d[a] > 0
                        out.append((i, int(names[a]), int(score[i][a]) if x else None, int(terms[i][a]) if x else None, float(cosine[i][a]) if y else None, int(s[a]) if x else None, int(d[a]) if y else None, float(f), int(p)))
                if out:
                    cols = list(zip(*out, strict=True))
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.int32())
                    target = frame.column(frame.schema.get_field_index("target")).take(pa.array(cols[0], pa.int64()))
                    yield pa.RecordBatch.from_arrays([target, *[pa.array(c, t) for c, t in zip(cols[1:], types, strict=True)]], names=["target", *[x.split()[0] for x in SCORED.split(", ")]])

    return targets.select("target", *(["dense"] if dense else []), *(weights if sparse else [])).mapInArrow(run, f"target {kind}, {SCORED}")


def deal_targets(rows: DataFrame) -> DataFrame:
    """Rows dealt evenly over many tasks, for a step whose cost is each row's: a file is read by as many tasks as it has row
    groups at most, however many cores there are."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    return rows.repartition(LOW_RANK_TASKS * tasks)


def rank_fusion(sparse: DataFrame, dense: DataFrame, *, k: int = 60, top: int = 10, keep: int = 5) -> DataFrame:
    """Reciprocal rank fusion of sparse(target, partner, score) and dense(target, partner, cosine): the first `top` of each
    count 1 / (k + rank); the best `keep` pairs of a target by (fused, cosine, partner)."""
    s = sparse.withColumn("sparse_rank", F.row_number().over(Window.partitionBy("target").orderBy(F.desc("score"), "partner"))).where(F.col("sparse_rank") <= top)
    d = dense.withColumn("dense_rank", F.row_number().over(Window.partitionBy("target").orderBy(F.desc("cosine"), "partner"))).where(F.col("dense_rank") <= top)
    both = s.select("target", "partner", "sparse_rank").join(d.select("target", "partner", "dense_rank", "cosine"), ["target", "partner"], "full")
    part = lambda c: F.coalesce(1.0 / (k + F.col(c)), F.lit(0.0))
    both = both.withColumn("fused", part("sparse_rank") + part("dense_rank"))
    w = Window.partitionBy("target").orderBy(F.desc("fused"), F.desc(F.coalesce("cosine", F.lit(0.0))), "partner")
    return both.withColumn("place", F.row_number().over(w)).where(F.col("place") <= keep)


def confidence(value: Column, score: Column) -> Column:
    """strong, weak or no_match from a confidence or score word; null if neither says."""
    v, s = match_text(value), F.lower(F.trim(F.coalesce(score, F.lit(""))))
    return (
        F.when(v.isin("strong", "high"), "strong").when(v.isin("weak", "medium"), "weak").when(v.isin("no match", "nomatch", "low"), "no_match")
        .when(s.isin("high", "hoch"), "strong").when(s.isin("medium", "mittel"), "weak").when(s.isin("low", "niedrig"), "no_match"))


def supported(evidence: Column, texts: Column) -> Column:
    """Whether one of an array of texts backs the evidence: holds it, or shares two of its tokens (its only one, if one)."""
    e, tokens = match_text(evidence), F.array_distinct(match_tokens(evidence))
    enough = F.least(F.lit(2), F.size(tokens))
    return (F.size(tokens) > 0) & F.exists(texts, lambda t: (match_text(t) != "") & (F.contains(match_text(t), e) | (F.size(F.array_intersect(tokens, F.array_distinct(match_tokens(t)))) >= enough)))


def assess(output_name: Column, conf: Column, score: Column, partner_known: Column, target_ok: Column, partner_ok: Column, shortlist_score: Column, shortlist_features: Column, specific: Column) -> Column:
    """The match decision as struct(decision, reason, confidence). target_ok, partner_ok: backed evidence on either side."""
    name = clean_text(output_name)
    c = F.coalesce(confidence(conf, score), F.lit("weak"))
    said = lambda d, r, x: F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"), F.lit(x).alias("confidence"))
    return (
        F.when(output_name.isNull() & conf.isNull() & score.isNull(), said("no_match", "missing_partner_match_output", "no_match"))
        .when(name == "", said("no_match", "missing_partner_name", "no_match"))
        .when((F.lower(name) == "no suitable match found") | (c == "no_match"), said("no_match", "explicit_no_match", "no_match"))
        .when(~partner_known, said("no_match", "matched_partner_data_missing", "no_match"))
        .when((c == "strong") & target_ok & partner_ok, said("strong_match", "accepted_strong_validated_evidence", "strong"))
        .when((c == "strong") & (shortlist_score >= 0.03) & (shortlist_features > 0) & (specific >= 1), said("weak_match", "downgraded_strong_missing_direct_evidence", "weak"))
        .when(c == "strong", said("no_match", "rejected_strong_missing_evidence", "no_match"))
        .when(target_ok | partner_ok | (shortlist_features > 0), said("weak_match", "accepted_weak_match", "weak"))
        .otherwise(said("no_match", "rejected_weak_missing_evidence", "no_match")))


def canonical_partner(outputs: DataFrame, partners: DataFrame) -> DataFrame:
    """outputs(row_id, partner_id, partner_name) with the partner each means: by id, else name, alias, normalized name.

    Every way is an equi join; the best level wins, then the first partner in list order. partners: partner_id, name,
    aliases, position.
    """
    p = small(partners)
    ways = (
        (0, F.lower(clean_text(F.col("partner_id"))), F.array(F.lower(F.trim("p_id")))), (1, F.lower(clean_text(F.col("partner_name"))), F.array(F.lower(F.trim("p_name")))),
        (2, F.lower(clean_text(F.col("partner_name"))), F.transform("p_aliases", lambda a: F.lower(F.trim(a)))), (3, match_text(F.col("partner_name")), F.array(match_text(F.col("p_name")))))
    keys = outputs.select("row_id", F.explode(F.array(*[F.struct(F.lit(i).alias("level"), k.alias("key")) for i, k, _ in ways])).alias("k")).select("row_id", "k.*").where("key <> ''")
    level = lambda i: lambda x: F.struct(F.lit(i).alias("level"), x.alias("key"))
    named = p.select(F.col("partner_id").alias("p_id"), F.col("name").alias("p_name"), F.col("aliases").alias("p_aliases"), "position")
    lookup = named.select("p_id", "p_name", "position", F.explode(F.flatten(F.array(*[F.transform(ks, level(i)) for i, _, ks in ways]))).alias("k"))
    lookup = lookup.select("p_id", "p_name", "position", "k.*").where("key <> ''")
    best = keys.join(lookup, ["level", "key"]).groupBy("row_id").agg(F.min_by(F.struct("p_id", "p_name", "level"), F.struct("level", "position")).alias("b"))
    return outputs.join(best.select("row_id", F.col("b.p_id").alias("matched_id"), F.col("b.p_name").alias("matched_name"), F.col("b.level").alias("level")), "row_id", "left")
