"""Cosines after a truncated SVD against numpy's SVD of each target's whole matrix; scores that aren't asked for."""

import math
import random

import numpy as np
import pytest
from conftest import TINY

from firmlens.functions import eigen
from firmlens.operators import matching
from firmlens.plans import catalog


def by_svd(target, partners, most):
    """TF-IDF rows (sublinear counts, smooth idf, unit length) of the target and all partners, decomposed as a whole."""
    docs = [target, *partners]
    terms = sorted({t for d in docs for t in d})
    m = np.zeros((len(docs), len(terms)))
    for j, t in enumerate(terms):
        df = sum(t in d for d in docs)
        for i, d in enumerate(docs):
            if t in d:
                m[i, j] = (1 + math.log(d.count(t))) * (math.log((1 + len(docs)) / (1 + df)) + 1)
    norm = np.linalg.norm(m, axis=1)
    m /= np.where(norm > 0, norm, 1)[:, None]
    if len(docs) >= 4 and len(terms) >= 4:
        u, s, _ = np.linalg.svd(m, full_matrices=False)
        k = max(2, min(most, len(docs) - 1, len(terms) - 1))
        m = u[:, :k] * s[:k]
    norm = np.linalg.norm(m, axis=1)
    return np.where((norm[1:] > 1e-9) & (norm[0] > 1e-9), m[1:] @ m[0] / np.maximum(norm[1:] * norm[0], 1e-300), 0)


@pytest.mark.parametrize("n, most", [(2, 32), (3, 32), (6, 3), (20, 32), (40, 8), (40, 32)])
def test_reduced_cosines(n, most):
    rng = random.Random(n)
    partners = [[rng.randint(0, 30) for _ in range(rng.randint(0 if n > 3 else 1, 25))] for _ in range(n)]
    index = matching.PartnerIndex(partners, partners)
    for size in (0, 1, 5, 60):
        target = [rng.randint(0, 45) for _ in range(size)]
        terms, counts = np.unique(np.array(target, np.int64), return_counts=True)
        got = index.reduced_cosines(terms, counts.astype(float), most)
        assert np.abs(got - by_svd(target, partners, most)).max() < 1e-6


def test_scores_that_are_not_asked_for(spark):
    rows = [(i, [1, 2, i], [1, 2, 2, i]) for i in range(5)]
    t = spark.createDataFrame(rows, "target long, own array<long>, dense array<long>")
    p = spark.createDataFrame([(7, 1, [1, 3], [1, 3]), (8, 2, [9, 2], [9, 2]), (9, 3, [], [])], "partner long, position long, sparse array<long>, dense array<long>")
    whole = {(r.target, r.partner): r for r in matching.score_partners(t, p, {"own": 2}).collect()}
    for asked, columns in (({"dense": False}, ("score", "terms", "sparse_rank")), ({"sparse": False}, ("cosine", "dense_rank"))):
        got = {(r.target, r.partner): r for r in matching.score_partners(t, p, {"own": 2}, **asked).collect()}
        assert {k: [r[c] for c in columns] for k, r in got.items()} == {k: [r[c] for c in columns] for k, r in whole.items() if r[columns[0]] is not None}
    few = matching.score_partners(t, p, {"own": 2}, sparse=False, dimensions=32).where("target = 1").collect()
    want = by_svd([1, 2, 2, 1], [[1, 3], [9, 2], []], 32)
    assert {r.partner: r.cosine for r in few} == pytest.approx({q: c for q, c in zip((7, 8, 9), want) if c > 0}, abs=2e-6)


def test_query_against_svd(spark):
    documents = {r.target: r.dense for r in _terms(spark, "documents", "doc_id")}
    partners = sorted(_terms(spark, "benchmark", "item_id"), key=lambda r: -r.target)
    got = {}
    for r in catalog.QUERIES["lowrank_cosine"](spark, TINY).collect():
        got.setdefault(r.target, {})[r.partner] = r.cosine
    for target in sorted(documents)[:12]:
        want = np.round(by_svd(documents[target], [p.dense for p in partners], 32), 6)
        best = sorted((c for c in want if c > 0), reverse=True)[:10]
        assert sorted(got.get(target, {}).values(), reverse=True) == pytest.approx(best, abs=2e-6)


def _terms(spark, table, key):
    from pyspark.sql import functions as F

    from firmlens.functions.text import match_tokens

    df = spark.read.parquet(f"{TINY}/{table}.parquet").select(F.col(key).alias("target"), match_tokens(F.col("text")).alias("tokens"))
    return df.select("target", matching.hashed_terms(F.col("tokens"))[1].alias("dense")).collect()


def test_targets_are_dealt_evenly(spark):
    """A file of one row group is one task's; the decompositions of its rows must not be."""
    from pyspark.sql import functions as F

    found = catalog.QUERIES["lowrank_cosine"](spark, TINY).select("target").distinct().count()
    tasks = catalog.QUERIES["lowrank_cosine"](spark, TINY).groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("target").alias("n")).collect()
    assert sum(r.n for r in tasks) == found and len(tasks) > 8 and max(r.n for r in tasks) <= found / 4


def test_tokens_are_those_of_match_text(spark):
    from pyspark.sql import functions as F

    from firmlens.functions.text import match_text, match_tokens

    ascii_ = "".join(map(chr, range(128)))
    rows = ["", None, " ", "&", "R&D AI", "x Straße Großhändler", "abc\x00def\x7fghi\tjkl\r\nmno", "ÉCOLE-école_12 123 4th", "xyz".join(ascii_), "İstanbul ok'ay", "a.b.c;...;erp", " ".join(ascii_ * 2)]
    df = spark.createDataFrame([(t,) for t in rows], "t string").select(match_text(F.col("t")).alias("flat"), match_tokens(F.col("t")).alias("tokens"))
    whole = df.select("tokens", match_tokens(F.col("flat")).alias("again"), F.split("flat", " ").alias("words")).collect()
    for r in whole:
        assert r.tokens == r.again and set(r.tokens) <= set(r.words)
        assert [w for w in r.words if len(w) > 2 and not w.isdigit() and w in r.tokens] == [w for w in r.tokens if len(w) > 2]


def symmetric(kind, n, rng):
    if kind == "rows":  # near right angles, as partners are
        a = rng.normal(size=(n, 3 * n)) * (rng.random((n, 3 * n)) < 0.2)
        a /= np.maximum(np.linalg.norm(a, axis=1), 1e-9)[:, None]
        return a @ a.T
    if kind == "ties":
        return np.kron(np.eye(n // 2 + 1), np.array([[1.0, 0.5], [0.5, 1.0]]))[:n, :n]
    return {"zero": np.zeros((n, n)), "one": np.eye(n), "low": np.outer(np.arange(n), np.arange(n)) / n, "diagonal": np.diag(np.arange(n) / n),
            "large": 1e6 * symmetric("rows", n, rng) if kind == "large" else 0}[kind]


@pytest.mark.parametrize("n, k", [(2, 1), (4, 2), (30, 29), (30, 8), (90, 32)])
def test_largest_eigenvalues_are_those_of_eigh(n, k):
    rng = np.random.default_rng(n)
    kinds = ["rows", "rows", "ties", "zero", "one", "rows", "low", "diagonal", "large"]
    g = np.stack([symmetric(x, n, rng) for x in kinds])
    values, vectors = eigen.largest(g.copy(), k)
    for kind, a, value, v in zip(kinds, g, values, vectors):
        scale = max(np.abs(a).max(), 1)
        assert np.abs(value - np.linalg.eigvalsh(a)[-k:]).max() < 1e-10 * scale
        assert np.abs(v.T @ v - np.eye(k)).max() < 1e-8 and np.abs(a @ v - v * value).max() < 1e-8 * scale, kind


def test_most_matrices_need_no_whole_decomposition(monkeypatch):
    """Which is what a document's cost was: all 201 vectors for the 32 that count."""
    if not eigen._routines():
        pytest.skip("numpy has another LAPACK")
    rng = np.random.default_rng(1)
    g = np.stack([symmetric("rows", 120, rng) for _ in range(20)])
    whole, calls = np.linalg.eigh, []
    monkeypatch.setattr(np.linalg, "eigh", lambda *a: calls.append(1) or whole(*a))
    found = eigen.largest(g.copy(), 32)
    assert len(calls) <= 2
    monkeypatch.setattr(eigen, "_routines", lambda: None)
    plain = eigen.largest(g.copy(), 32)
    assert len(calls) >= 20
    for (a, b), (c, d) in zip(zip(*found), zip(*plain)):
        assert np.abs((b * a) @ b.T - (d * c) @ d.T).max() < 1e-8


def test_targets_of_a_block_are_reduced_each_by_its_own():
    """Targets without a shared term, with few terms, and more than a block of them, in any order."""
    rng = random.Random(5)
    for n, words in ((40, 30), (2, 4), (12, 6)):
        partners = [[rng.randint(0, words) for _ in range(rng.randint(1, 25))] for _ in range(n)]
        targets = [[rng.randint(0, words + 15) for _ in range(rng.choice([0, 1, 5, 60]))] for _ in range(140)] + [[900], [900, 901, 0]]
        index = matching.PartnerIndex(partners, partners)
        got = index.all_reduced_cosines([(t, c.astype(float)) for t, c in (np.unique(np.array(x, np.int64), return_counts=True) for x in targets)], 8)
        assert max(np.abs(row - by_svd(t, partners, 8)).max() for row, t in zip(got, targets)) < 1e-6
