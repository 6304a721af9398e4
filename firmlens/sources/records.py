"""JSON lines and cached texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmlens.operators.relations import last_wins


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A row per JSON line; lines that can't be read are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def expected_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    """The number of rows that a run's log (lines of text) says it expects: the last `… 123 rows` in it."""
    n = F.regexp_extract(value, r"(?i)(\d+) rows", 1).try_cast("long")
    return lines.select(n.alias("rows"), F.monotonically_increasing_id().alias("_at")).where("rows IS NOT NULL").agg(F.max_by("rows", "_at").alias("rows"))


def last_by_row(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with one key the last one written."""
    return last_wins(rows, [key], order)


def newest_texts(files: DataFrame, *, most: int = 3, budget: int = 40_000, least: int = 50) -> DataFrame:
    """files(host, path, mtime, text) to one text a host: the newest files, joined up to the budget of characters; hosts
    with fewer than `least` go."""
    w = Window.partitionBy("host").orderBy(F.desc("mtime"), "path")
    f = files.withColumn("n", F.row_number().over(w)).where(F.col("n") <= most)
    text = F.left(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda x: x["text"]), "\n"), F.lit(budget))
    return f.groupBy("host").agg(text.alias("text"), F.count(F.lit(1)).alias("files")).where(F.length("text") >= least)
