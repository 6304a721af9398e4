"""Row events as a stream: several outputs a batch, resumable by checkpoint, no row twice."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_events(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*", per_batch: int = 64) -> DataFrame:
    """A stream over the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", per_batch).parquet(folder)


def write_outputs(events: DataFrame, outputs: Mapping[str, Callable[[DataFrame], DataFrame]], target: str, checkpoint: str) -> None:
    """Run the stream over all that is there: each batch's outputs go to target/<name>, a folder for each batch.

    A batch that is written again after a failure overwrites its own folder, so outputs hold each row once.
    """

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for name, make in outputs.items():
                make(batch).write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")
        finally:
            batch.unpersist()

    query = events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_output(spark: SparkSession, target: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{target}/{name}")


def progress(events: DataFrame) -> DataFrame:
    """Rows by type and the last time of each: what a status file would say."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.max("ts").alias("last"))
