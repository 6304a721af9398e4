"""What a running stream shows: a status file, and live tables as CSV or JSON lines that hold each row once."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from firmlens.shared import open_store

#: Seconds between two status files, at least.
EVERY = 2.0


class StatusListener(StreamingQueryListener):
    """Writes what a stream has done so far to a JSON file in the shared folder: at most every EVERY seconds, when the stream ends
    in any case, and by rename, so that a reader sees a whole file. Attach with spark.streams.addListener.

    The numbers are those of an observation `name` in the stream (see observed), added up over batches; a batch that runs
    again counts once. A file that is there from before a restart is gone on from. Other queries are passed over.
    """

    def __init__(self, path: str, name: str, fixed: Mapping[str, object] | None = None, clock: Callable[[], float] = time.monotonic):
        self.path, self.name, self.fixed, self.clock = path, name, dict(fixed or {}), clock
        self.last, self.runs, self.lock = None, set(), threading.Lock()
        before = self.read()
        self.sums: dict[str, int] = {k: v for k, v in (before or {}).get("observed", {}).items()}
        self.batch = before["batch"] if before else -1

    def read(self) -> dict | None:
        """The status as it stands in the file."""
        fs, path = open_store(self.path)
        try:
            with fs.open_input_stream(path) as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def write(self) -> None:
        fs, path = open_store(self.path)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        started, done = self.sums.get("jobs_started", 0), self.sums.get("jobs_done", 0)
        body = {"ts": datetime.now(timezone.utc).isoformat(), "batch": self.batch, **self.fixed, "observed": self.sums, "jobs_in_flight": max(0, started - done)}
        with fs.open_output_stream(f"{path}.tmp") as f:
            f.write(json.dumps(body, ensure_ascii=False, indent=2).encode())
        fs.move(f"{path}.tmp", path)
        self.last = self.clock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.add(event.progress) and (self.last is None or self.clock() - self.last > EVERY):
            self.write()

    def add(self, progress) -> bool:
        """Count a batch, unless it was; whether it was new."""
        with self.lock:
            if self.name not in (progress.observedMetrics or {}) or progress.batchId <= self.batch:
                return False
            self.runs.add(str(progress.runId))
            for k, v in progress.observedMetrics[self.name].asDict().items():
                self.sums[k] = self.sums.get(k, 0) + (v or 0)
            self.batch = progress.batchId
            return True

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.runs:
            self.write()


def observed(events: DataFrame, name: str, kind: str = "event_type", *, started: str = "job_started", done: str = "job_done") -> DataFrame:
    """The stream with an observation that a StatusListener of that name adds up: rows that are no job's start or end, and those."""
    of = lambda k: F.count_if(F.col(kind) == k)
    return events.observe(name, F.count_if(F.coalesce(~F.col(kind).isin(started, done), F.lit(True))).alias("rows_written"), of(started).alias("jobs_started"), of(done).alias("jobs_done"))


def _cell(column: Column, kind: T.DataType) -> Column:
    """A cell of a CSV file: nested values as JSON."""
    return F.to_json(column) if isinstance(kind, T.StructType | T.ArrayType | T.MapType) else column.cast("string")


def append(batch: DataFrame, number: int, folder: str, kind: str, header: list[str] | None = None) -> None:
    """Write a batch's rows to a live table: `csv` (columns of header, in that order, missing ones empty, nested values as JSON)
    or `json` (a line an object). Each batch has a folder of its own, which a batch that runs again replaces whole."""
    path = f"{folder}/batch={number}"
    if kind == "csv":
        names = header or batch.columns
        types = {f.name: f.dataType for f in batch.schema}
        cells = [(_cell(F.col(f"`{c}`"), types[c]) if c in types else F.lit("")).alias(c) for c in names]
        batch.select(*cells).write.mode("overwrite").options(header=True, quote='"', escape='"', emptyValue="").csv(path)
    elif kind == "json":
        batch.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    else:
        batch.write.mode("overwrite").parquet(path)


def read_live(spark: SparkSession, folder: str, kind: str, schema: str) -> DataFrame:
    """All rows of a live table so far; batches that are being written are not seen."""
    reader = spark.read.schema(schema)
    rows = reader.options(header=True, quote='"', escape='"', multiLine=True).csv(folder) if kind == "csv" else reader.json(folder) if kind == "json" else reader.parquet(folder)
    return rows.drop("batch")


def write_live(events: DataFrame, outputs: Mapping[str, tuple[str, Callable[[DataFrame], DataFrame]]], target: str, checkpoint: str, status: StatusListener | None = None) -> None:
    """Run the stream over all that is there into live tables target/<name>, by name (kind, what of a batch). status: attached
    while it runs; its file is up to date when this returns."""

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for name, (kind, make) in outputs.items():
                append(make(batch), number, f"{target}/{name}", kind)
        finally:
            batch.unpersist()

    streams = events.sparkSession.streams
    if status:
        streams.addListener(status)
    try:
        query = events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        if status:
            streams.removeListener(status)
    if status:
        for progress in query.recentProgress:  # listeners are told a little later than the stream ends
            status.add(progress)
        status.write()
