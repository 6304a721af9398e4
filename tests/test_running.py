"""Running totals, chunks, budgets and blank runs of groups of any size against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from firmlens.operators import ranking, relations, running


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice(["x" * rng.randint(1, 9), "", " ", None])) for i in range(400)]
    rows += [("c", i, "") for i in range(5)] + [("d", 1, "only")]
    return rows, spark.createDataFrame(rows, "g string, i long, t string").repartition(7)


def groups(rows):
    out = {}
    for g, i, t in sorted(rows, key=lambda r: r[1]):
        out.setdefault(g, []).append((i, t))
    return out


def test_running_totals(lines):
    rows, df = lines
    got = {(r.g, r.i): (r.n, r.s) for r in running.running_totals(df, "g", [F.desc("i")], {"n": F.lit(1).cast("long"), "s": F.col("i")}).collect()}
    want = {}
    for g, own in groups(rows).items():
        total = 0
        for n, (i, _) in enumerate(reversed(own), 1):
            total += i
            want[g, i] = (n, total)
    assert got == want and not running.numbered(df.limit(0), "g", [F.col("i")]).count()


@pytest.mark.parametrize("most", [1, 2, 3])
def test_stop_after_blanks(lines, most):
    rows, df = lines
    want = []
    for g, own in groups(rows).items():
        run = 0
        for i, t in own:
            run = 0 if (t or "").strip() else run + 1
            if run >= most:
                break
            if not run:
                want.append((g, i, t))
    assert sorted(map(tuple, relations.stop_after_blanks(df, "g", "i", "t", most).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("budget", [0, 1, 40, 10_000])
def test_text_budget(lines, budget):
    rows, df = lines
    want = []
    for g, own in groups(rows).items():
        before = 0
        for i, t in own:
            if before < budget:
                want.append((g, i, None if t is None else t[: budget - before]))
            before += len(t or "")
    assert sorted(map(tuple, relations.text_budget(df, "g", [F.col("i")], "t", budget).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("most", [None, 2])
def test_chunk_jobs(lines, most):
    rows, df = lines
    want = [(g, i, t, n // 7) for g, own in groups(rows).items() for n, (i, t) in enumerate(own) if most is None or n < 7 * most]
    assert sorted(map(tuple, relations.chunk_jobs(df, "g", [F.col("i")], 7, most).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("most", [100_000, 0])
def test_duplicate_flags(lines, monkeypatch, most):
    rows, df = lines
    monkeypatch.setattr(relations, "few", lambda t, few=relations.few: few(t, most))
    got = {r.i: tuple(r)[3:] for r in relations.duplicate_flags(df.where("i >= 10"), ["t", "i"]).collect()}
    own = [r for r in rows if r[1] >= 10]
    count = lambda t: sum(r[2] == t for r in own)
    assert got == {i: (count(t), count(t) > 1 and t is not None, 1, False) for _, i, t in own}


def test_greedy_top(spark):
    """Against taking the slots one after the other."""
    rng = random.Random(11)
    kinds = ["Sales", "Main Line", "Support", "Vertrieb", "Zentrale"]
    rows = [(f"s{rng.randint(0, 14)}", f"n{i}", [rng.choice(kinds) for _ in range(rng.randint(0, 2))], i) for i in range(160)]
    persons = [(s, n) for s, n, _, _ in rows if rng.random() < 0.15]
    got = {}
    for r in ranking.greedy_top(spark.createDataFrame(rows, "site string, number string, types array<string>, k int"), spark.createDataFrame(persons, "site string, number string"), "site", [F.desc("k")]).orderBy("site", "place").collect():
        got.setdefault(r.site, []).append(r.number)
    for site in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == site), key=lambda r: -r[3])
        named = {n for s, n in persons if s == site}
        has = lambda r, *words: any(w in ", ".join(r[2]).lower() for w in words)
        chosen = [r for r in own if r[1] in named][:1]
        sales = [r for r in own if has(r, "sales", "vertrieb")]
        if sales and sales[0] in chosen:
            sales = [r for r in sales if r[1] not in named]
        chosen += sales[:1]
        chosen += [r for r in own if has(r, "main", "zentrale") and r not in chosen][:1]
        chosen += [r for r in own if r not in chosen]
        assert got[site] == [r[1] for r in chosen[:3]], site


def test_unique_and_left_over_items(spark):
    items = spark.createDataFrame([("s", 0, " 1 ", "a"), ("s", 1, "1", "b"), ("s", 2, "2", "c"), ("s", 3, " ", "d"), ("s", 4, None, "e"), ("t", 0, "1", "f")], "site string, pos int, number string, type string")
    assert sorted(tuple(r) for r in ranking.unique_items(items, "site").collect()) == [("s", 0, "1", "a"), ("s", 2, "2", "c"), ("t", 0, "1", "f")]
    found = spark.createDataFrame([("s", k, str(k % 4), f"x{k}") for k in range(12)], "site string, at int, number string, snippet string")
    excluded, rest = ranking.left_over(items, found, spark.createDataFrame([("s", "1 "), ("s", "0"), ("s", None)], "site string, number string"), "site", [F.col("at")])
    assert sorted(r.type for r in excluded.collect()) == ["c", "f"] and sorted(r.snippet for r in rest.collect()) == ["x2", "x3"]


def test_merge_jobs(spark):
    rows = spark.createDataFrame([(i, i % 5 == 0) for i in range(1, 101)], "row_id long, cached boolean").repartition(6)
    out = relations.merge_jobs(relations.row_jobs(rows, "row_id", 1, 100, 7), "row_id", F.col("cached")).orderBy("place").collect()
    assert [r.place for r in out] == list(range(1, 101)) and [r.row_id for r in out] == [i for i in range(1, 101) if i % 5 == 0] + [i for i in range(1, 101) if i % 5]
