"""Streams that remember: rows let through in order only, and each key's first row once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from firmlens.shared import find_package

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _rows(frame: pd.DataFrame) -> list[tuple]:
    return list(frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None))


class _InOrder(StatefulProcessor):
    """Of a key: the number that goes out next, and the rows that wait for it."""

    def __init__(self, columns: StructType, sequence: str, first: int):
        self.columns, self.at, self.first = columns, columns.names.index(sequence), first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.next = handle.getValueState("next", StructType([StructField("n", LongType())]))
        self.held = handle.getListState("held", self.columns)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        turn = self.next.get()[0] if self.next.exists() else self.first
        waiting = {r[self.at]: tuple(r) for r in self.held.get()} if self.held.exists() else {}
        had = len(waiting)
        for frame in rows:
            for r in _rows(frame[self.columns.names]):
                if r[self.at] is not None and r[self.at] >= turn:
                    waiting.setdefault(int(r[self.at]), r)  # a row that comes again is the same row
        out = []
        while turn in waiting:
            out.append(waiting.pop(turn))
            turn += 1
        if out or len(waiting) != had:
            self.next.update((turn,))
            if waiting:
                self.held.put([waiting[n] for n in sorted(waiting)])
            else:
                self.held.clear()
        if out:
            yield pd.DataFrame(out, columns=self.columns.names)

    def close(self) -> None:
        pass


class _First(StatefulProcessor):
    """Of a key: that it has been seen."""

    def __init__(self, columns: StructType, order: str, keep_ms: int | None):
        self.columns, self.at, self.keep_ms = columns, columns.names.index(order), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", StructType([StructField("n", LongType())]), self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for frame in rows:  # nothing but the first one is held
            for r in _rows(frame[self.columns.names]):
                if best is None or (r[self.at] is not None and (best[self.at] is None or r[self.at] < best[self.at])):
                    best = r
        if best is not None and not self.seen.exists():
            self.seen.update((1,))
            yield pd.DataFrame([best], columns=self.columns.names)

    def close(self) -> None:
        pass


def _with_state(events: DataFrame, key: str, processor: StatefulProcessor, timed: bool = False) -> DataFrame:
    spark = events.sparkSession
    find_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return events.groupBy(key).transformWithStateInPandas(processor, events.schema, "Append", "ProcessingTime" if timed else "None")


def in_order(events: DataFrame, job: str, sequence: str, first: int = 0) -> DataFrame:
    """The stream's rows, each only after all rows of its job with smaller numbers have gone out, from `first` on.

    Rows that come early wait in the state store, which a restart finds as it was; a number that comes again, as after a
    replayed batch, is left out. Within a batch a job's rows come out together and in order. Jobs are independent, so their
    number is what spreads over tasks (relations.row_jobs cuts a run into jobs of bounded length); what waits of one job is
    read and written as a whole when rows of it come. Rows without a number, or with one below first, never go out; rows
    behind a gap wait until it is filled. Null job: a job of its own.
    """
    return _with_state(events, job, _InOrder(events.schema, sequence, first))


def first_seen(events: DataFrame, key: str, order: str, keep_ms: int | None = None) -> DataFrame:
    """The first row of each key that the stream ever brings; of rows in one batch the first by order.

    What was seen is a few bytes a key in the state store (RocksDB: on disk, spread by key, kept over restarts), so the answer
    is exact however long ago a key came; with keep_ms a key is forgotten that long after it was seen, and would go out
    again. As relations.first_seen_rows gives it, if batches come in order. Null key: a key of its own. A key's rows of a batch are
    read one after another, never held.
    """
    return _with_state(events, key, _First(events.schema, order, keep_ms), keep_ms is not None)
