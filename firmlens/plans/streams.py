"""Queries of streams with state, and of live tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from firmlens.operators import relations
from firmlens.plans.web import read
from firmlens.shared import shared_folder
from firmlens.streaming import live, rows, stateful


def _in_parts(spark, parts, make, folder):
    """Each of some tables added to a folder and a stream over the folder started again, which takes a batch a time; back come
    the rows with their batch and their place in it."""

    def each(batch, number):
        batch.withColumns({"batch": F.lit(number), "place": F.monotonically_increasing_id()}).write.mode("overwrite").parquet(f"{folder}/out/b={number}")

    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        events = make(rows.row_events(spark, f"{folder}/in", part.schema, "*.parquet", per_batch=1_000_000))
        events.writeStream.foreachBatch(each).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("b")


def stream_in_order(spark, sf_dir):
    """Events as the rows of jobs of 500, in four parts without order: each goes out only behind the ones before it."""
    e = read(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 500).alias("job"), F.pmod("event_id", F.lit(500)).alias("n"), "event_id", "event_type")
    parts = [e.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k) for k in range(4)]
    out = _in_parts(spark, parts, lambda events: stateful.in_order(events, "job", "n"), shared_folder(spark, "in-order"))
    place = F.row_number().over(Window.partitionBy("job").orderBy("batch", "place")) - 1
    return out.withColumn("in_order", F.col("n") == place).select("job", "n", "event_id", "event_type", "in_order")


STREAM_IN_ORDER = "SELECT event_id // 500 AS job, event_id % 500 AS n, event_id, event_type, TRUE AS in_order FROM events"


def stream_first_seen(spark, sf_dir):
    """The first event of each user, from four parts of the events one after the other."""
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    last = e.agg(F.max("event_id")).first()[0] or 0
    parts = [e.where(F.floor(F.col("event_id") * 4 / (last + 1)) == k) for k in range(4)]
    return _in_parts(spark, parts, lambda events: stateful.first_seen(events, "user_id", "event_id"), shared_folder(spark, "first-seen")).select("user_id", "event_id", "event_type")


STREAM_FIRST_SEEN = "SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY 1"


def stream_live(spark, sf_dir):
    """Events through a stream into live tables as CSV and JSON lines, with a status file; rows by type in each."""
    target = shared_folder(spark, "live")
    schema = read(spark, sf_dir, "events").schema
    events = live.observed(rows.row_events(spark, sf_dir, schema, "events.parquet"), "run", started="signup", done="purchase")
    status = live.StatusListener(f"{target}/status.json", "run")
    wide = lambda b: b.select("event_id", "event_type", F.struct("user_id", "value").alias("more"))
    live.write_live(events, {"csv": ("csv", wide), "json": ("json", wide)}, target, f"{target}/checkpoint", status)
    seen = status.read()["observed"]
    csv = live.read_live(spark, f"{target}/csv", "csv", "event_id long, event_type string, more string").withColumn("user_id", F.get_json_object("more", "$.user_id").cast("long"))
    lines = live.read_live(spark, f"{target}/json", "json", "event_id long, event_type string, more struct<user_id:long,value:double>").withColumn("user_id", F.col("more.user_id"))
    count = lambda name, df: df.groupBy(F.lit(name).alias("kind"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"))
    said = spark.createDataFrame([("status", k, v) for k, v in seen.items()], "kind string, event_type string, n long").withColumn("users", F.lit(None).cast("long"))
    return relations.stack(count("csv", csv), count("json", lines), said)


STREAM_LIVE = """
WITH k AS (SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY 1)
SELECT 'csv' AS kind, * FROM k UNION ALL SELECT 'json', * FROM k
UNION ALL SELECT 'status', 'rows_written', count(*), NULL FROM events WHERE event_type NOT IN ('signup', 'purchase') OR event_type IS NULL
UNION ALL SELECT 'status', 'jobs_started', count(*), NULL FROM events WHERE event_type = 'signup' UNION ALL SELECT 'status', 'jobs_done', count(*), NULL FROM events WHERE event_type = 'purchase'
"""

QUERIES = {"stream_in_order": (stream_in_order, STREAM_IN_ORDER), "stream_first_seen": (stream_first_seen, STREAM_FIRST_SEEN), "stream_live": (stream_live, STREAM_LIVE)}
