"""Streams with state over restarts and replayed batches, the status file, live tables."""

import json
import random
import types

from pyspark.sql import functions as F

from firmlens.operators import relations
from firmlens.streaming import live, stateful

SCHEMA = "job string, n long, url string, v double"


def put(spark, folder, data, name):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, folder, make, out, checkpoint):
    """Everything that is there, a folder a batch; rows come back by batch, in the order in which they were written."""
    events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)

    def each(batch, number):
        batch.withColumn("batch", F.lit(number)).withColumn("place", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{out}/b={number:05d}")

    make(events).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return [tuple(r)[:4] for r in spark.read.parquet(out).orderBy("batch", "place").collect()]


def test_in_order_over_batches_and_a_restart(spark, tmp_path):
    rng = random.Random(3)
    data = [(j, n, f"u{n}", None if n % 5 == 0 else n / 2) for j in ("a", "b", None) for n in range(40)]
    rng.shuffle(data)
    late = [r for r in data if (r[0], r[1]) in {("a", 7), ("b", 0)}]
    rest = [r for r in data if r not in late]
    src, out, cp = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp"
    for k in range(4):
        put(spark, src, rest[k::4] + rest[k : k + 3], f"f{k}")  # some rows come twice
    make = lambda e: stateful.in_order(e, "job", "n")
    got = run(spark, src, make, out, cp)
    by = lambda rows: {j: [r[1] for r in rows if r[0] == j] for j in ("a", "b", None)}
    assert by(got) == {"a": list(range(7)), "b": [], None: list(range(40))}
    put(spark, src, [*late, ("a", None, "x", 1.0), ("a", -1, "y", 1.0), ("b", 50, "behind a gap", 1.0)], "late")
    got = run(spark, src, make, out, cp)
    assert by(got) == {j: list(range(40)) for j in ("a", "b", None)}
    assert sorted(got, key=repr) == sorted(data, key=repr)


def test_first_seen_equals_the_batch_form(spark, tmp_path):
    rng = random.Random(4)
    data = [("j", n, rng.choice([f"u{k}" for k in range(20)] + [None]), 0.5) for n in range(120)]
    src, out, cp = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp"
    make = lambda e: stateful.first_seen(e, "url", "n")
    for k in range(2):
        put(spark, src, rng.sample(data[k * 30 : k * 30 + 30], 30), f"f{k}")
        run(spark, src, make, out, cp)
    for k in range(2, 4):  # after two restarts
        put(spark, src, data[k * 30 : k * 30 + 30] + data[:5], f"f{k}")
    got = run(spark, src, make, out, cp)
    want = relations.first_seen_rows(spark.createDataFrame(data, SCHEMA), "url", "n").select("job", "n", "url", "v").collect()
    assert sorted(got, key=repr) == sorted(map(tuple, want), key=repr)


# ---------------------------------------------------------------- status

def progress(batch, name="status", run="r", **sums):
    observed = {name: types.SimpleNamespace(asDict=lambda: sums)}
    return types.SimpleNamespace(progress=types.SimpleNamespace(observedMetrics=observed, batchId=batch, runId=run))


def test_status_file_is_whole_rare_and_counts_each_batch_once(tmp_path):
    now = [0.0]
    path = f"file://{tmp_path}/run/status.json"
    s = live.StatusListener(path, "status", {"jobs_expected": 3}, clock=lambda: now[0])
    s.onQueryProgress(progress(0, rows_written=5, jobs_started=2, jobs_done=0))
    assert s.read()["observed"]["rows_written"] == 5 and s.read()["jobs_in_flight"] == 2
    now[0] = 1.5
    s.onQueryProgress(progress(1, rows_written=4, jobs_started=1, jobs_done=1))
    s.onQueryProgress(progress(1, rows_written=4, jobs_started=1, jobs_done=1))  # again
    s.onQueryProgress(progress(1, name="other", rows_written=100))
    assert s.read()["observed"]["rows_written"] == 5  # not yet
    now[0] = 2.5
    s.onQueryProgress(progress(2, rows_written=1, jobs_started=0, jobs_done=2))
    assert s.read()["observed"] == {"rows_written": 10, "jobs_started": 3, "jobs_done": 3} and s.read()["jobs_in_flight"] == 0 and s.read()["jobs_expected"] == 3
    after = live.StatusListener(path, "status", clock=lambda: now[0])  # a restart whose first batch was counted already
    after.onQueryProgress(progress(2, rows_written=1, jobs_started=0, jobs_done=2))
    after.onQueryProgress(progress(3, rows_written=7, jobs_started=0, jobs_done=0))
    after.onQueryTerminated(types.SimpleNamespace(runId="another"))
    after.onQueryTerminated(types.SimpleNamespace(runId="r"))
    assert after.read()["observed"]["rows_written"] == 17 and sorted(p.name for p in (tmp_path / "run").iterdir()) == ["status.json"]


def test_live_outputs_with_a_replayed_batch(spark, tmp_path):
    src, out, cp = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp"
    for k in range(3):
        put(spark, src, [("a", 10 * k + i, 'x;"\nü' if i else "", None) for i in range(4)], f"f{k}")
    wide = lambda b: b.select("n", "url", F.struct("job", "v").alias("s"), F.array("n").alias("l"))
    outputs = {"csv": ("csv", wide), "json": ("json", wide), "failed": ("parquet", lambda b: b.where("n % 2 = 1"))}
    events = lambda: live.observed(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src), "live", "job", started="a")
    listener = live.StatusListener(f"file://{out}/status.json", "live")
    live.write_live(events(), outputs, out, cp, listener)
    last = max(int(p.name) for p in (tmp_path / "cp" / "commits").iterdir() if p.name.isdigit())
    for p in (tmp_path / "cp" / "commits").iterdir():  # the last batch was written, but the stream died before it was noted
        if p.name.strip(".").startswith(str(last)):
            p.unlink()
    live.write_live(events(), outputs, out, cp, live.StatusListener(f"file://{out}/status.json", "live"))
    assert listener.read()["observed"] == {"rows_written": 0, "jobs_started": 12, "jobs_done": 0}
    want = sorted((10 * k + i, 'x;"\nü' if i else "") for k in range(3) for i in range(4))
    got = live.read_live(spark, f"{out}/csv", "csv", "n long, url string, s string, l string").collect()
    assert sorted((r[0], r[1] or "") for r in got) == want and {r[2] for r in got} == {'{"job":"a"}'} and all(json.loads(r[3]) == [r[0]] for r in got)
    got = live.read_live(spark, f"{out}/json", "json", "n long, url string, s struct<job:string,v:double>, l array<long>").collect()
    assert sorted((r[0], r[1]) for r in got) == want
    assert live.read_live(spark, f"{out}/failed", "parquet", SCHEMA).count() == 6


def test_csv_header_of_its_own(spark, tmp_path):
    live.append(spark.createDataFrame([(1, "b")], "x int, y string"), 0, f"{tmp_path}/t", "csv", ["y", "z", "x"])
    assert live.read_live(spark, f"{tmp_path}/t", "csv", "y string, z string, x int").collect()[0] in [("b", "", 1), ("b", None, 1)]
