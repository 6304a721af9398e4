"""Provider cooldowns that tasks share, keyed caches whose writes are killed, numbering plans."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from firmlens.operators import inference, numbering, pressure
from firmlens.sources import cache as caches


class Clock:
    def __init__(self):
        self.now, self.slept = 1000.0, []

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.slept.append(s)
        self.now += s


def test_a_burst_of_errors_begins_a_cooldown_for_all(tmp_path):
    clock = Clock()
    make = lambda: pressure.Pressure(f"file://{tmp_path}/p", burst=3, cooldown=30, clock=clock, sleep=clock.sleep)
    a, b = make(), make()
    a.failed()
    clock.now += 1
    b.failed()
    assert b.wait() == 0
    clock.now += 1
    a.succeeded()  # the burst is over
    clock.now += 1
    for p in (a, b):
        p.failed()
        clock.now += 1
    assert b.wait() == 0
    b.failed()
    assert a.until() == clock.now + 30 and a.wait() == 30 and b.wait() == 0 and clock.slept == [30]
    for _ in range(2):
        clock.now += 1
        a.failed()
    assert a.wait() == 0  # errors before a cooldown don't count again
    clock.now += 100
    a.succeeded()
    for _ in range(3):
        clock.now += 1
        a.failed()
    assert b.until() == clock.now + 30
    assert len(list((tmp_path / "p").iterdir())) < 10  # old notes go


def test_a_provider_is_left_alone_while_it_cools_down(tmp_path):
    clock, calls = Clock(), []
    p = pressure.Pressure(f"file://{tmp_path}/p", burst=2, cooldown=30, clock=clock, sleep=clock.sleep)

    def provider(prompt):
        calls.append(clock.now)
        if len(calls) < 4:
            raise RuntimeError("429 Too Many Requests")
        return "fine", 1

    assert pressure.call(provider, "x", p, tries=5, sleep=clock.sleep) == ("fine", 1)
    assert calls[2] - calls[1] > 29.99 and len(calls) == 4
    with pytest.raises(RuntimeError):
        pressure.call(lambda _: (_ for _ in ()).throw(RuntimeError("503")), "x", p, tries=2, sleep=clock.sleep)
    with pytest.raises(KeyError):  # other errors are not tried again
        pressure.call(lambda _: {}["x"], "x", p, tries=9, sleep=clock.sleep)
    assert pressure.overloaded(type("RateLimitError", (Exception,), {})()) and not pressure.overloaded(ValueError("no"))


def test_notes_of_many_tasks_at_once(tmp_path):
    p = pressure.Pressure(f"file://{tmp_path}/p", burst=40, cooldown=5)
    threads = [threading.Thread(target=lambda: [p.failed() for _ in range(5)]) for _ in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert p.until() > 0  # none was lost


def test_ask_with_pressure(spark, tmp_path):
    folder = f"file://{tmp_path}/p"

    def make():
        seen = {"n": 0}

        def answer(prompt):
            seen["n"] += 1
            if seen["n"] % 2:
                raise RuntimeError("rate limit")
            return prompt.upper(), 1

        return answer

    prompts = spark.createDataFrame([("a",), ("b",), (None,)], "prompt string").coalesce(1)
    calls = inference.ask(prompts, spark.createDataFrame([], inference.CALLS), "t", make, workers=9, ceiling=1, pressure=pressure.Pressure(folder, burst=2, cooldown=0.2), tries=3).collect()
    assert {(r["prompt"], r["response_text"], r["status"]) for r in calls} == {("a", "A", "ok"), ("b", "B", "ok")}
    assert list((tmp_path / "p").iterdir())


# ---------------------------------------------------------------- keyed cache

def test_cache_keeps_the_last_writer(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(caches, "COMPACT", 3)
    c = caches.KeyedCache(spark, f"file://{tmp_path}/c", ["url", "k"], "url string, k int, v string, w double")
    assert c.read().count() == 0 and c.pointer()["n"] == 0
    rng, want, sizes = random.Random(1), {}, []
    for n in range(9):
        rows = {(f"u{rng.randint(0, 9)}", 1): (f"v{n}", n / 2 if n % 3 else None) for _ in range(4)}
        want |= rows
        c.put(spark.createDataFrame([(*k, *v) for k, v in rows.items()] + [(None, 1, "lost", 0.0)], c.schema).withColumn("extra", F.lit(1)))
        assert {(r.url, r.k): (r.v, r.w) for r in c.read().collect()} == want
        sizes.append(len(c.pointer()["parts"]))
    assert sizes == [1, 2, 3, 1, 2, 3, 1, 2, 3] and c.pointer()["n"] == 9
    assert len([p for p in (tmp_path / "c").iterdir() if p.name.startswith("v")]) <= 7 and not [p for p in (tmp_path / "c").iterdir() if p.name.startswith("_current")]
    hits, misses = c.look_up(spark.createDataFrame([("u1", 1, "mine"), ("none", 1, "mine"), (None, 1, "x")], "url string, k int, own string"))
    assert [r.own for r in hits.collect()] == ["mine"] * (("u1", 1) in want) and {r.url for r in misses.collect()} >= {"none", None}


def test_a_killed_write_leaves_the_version_before(spark, tmp_path, monkeypatch):
    c = caches.KeyedCache(spark, f"file://{tmp_path}/c", ["k"], "k int, v int")
    c.put(spark.createDataFrame([(1, 1)], "k int, v int"))
    before = c.read()
    with pytest.raises(Exception, match="boom"):
        c.put(spark.createDataFrame([(1, 2)], "k int, v int").select("k", F.raise_error(F.lit("boom")).cast("int").alias("v")))
    monkeypatch.setattr(caches.KeyedCache, "_swap", lambda self, pointer: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        c.put(spark.createDataFrame([(1, 3)], "k int, v int"))
    assert [tuple(r) for r in c.read().collect()] == [tuple(r) for r in before.collect()] == [(1, 1)]


# ---------------------------------------------------------------- numbering plan

def test_number_kinds(spark):
    plan = spark.createDataFrame(list(numbering.DACH) + [("4930", "DE", "berlin", 6, 10)], numbering.PLAN)
    numbers = ["+49 30 123456", "+4930 1234", "+49 151 23456789", "+491512345678901", "+41 44 123 45 67", "+43 676 123", "+1 212 5551234", "", None, "abc", "+4"]
    rows = [(i, n) for i, n in enumerate(numbers)] + [(1, numbers[1])]
    got = numbering.number_kinds(spark.createDataFrame(rows, "id long, number string").withColumn("prefix", F.lit("x")), plan, key="id", number="number").orderBy("id").collect()
    assert [tuple(r)[2:] for r in got] == [
        ("DE", "berlin", "possible"), ("DE", "berlin", "possible"), ("DE", "berlin", "possible"), ("DE", "mobile", "possible"), ("DE", "mobile", "too_long"), ("CH", "fixed_line", "possible"), ("AT", "mobile", "too_short"),
        (None, None, "unknown"), (None, None, None), (None, None, None), (None, None, None), (None, None, "unknown")]
    assert numbering.number_kinds(spark.createDataFrame(rows, "id long, number string"), plan.limit(0), key="id", number="number").count() == len(rows)
