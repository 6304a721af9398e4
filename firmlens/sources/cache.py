"""A cache by key in the shared folder: versions of a table, and a pointer to those that count, swapped by rename."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Added versions after which a write puts all rows together anew.
COMPACT = 8


class KeyedCache:
    """Rows by key columns, the last writer of a key wins. Readers see a whole version or the one before, never half of one.

    Each write is a Parquet folder of its own; when it is whole, a file `current` that names the folders in order is replaced
    by rename. A write that is killed leaves a folder that nothing names. After COMPACT writes the next one writes all
    rows together; folders that the pointer before that named stay until the one after, for readers that still have them open. One
    writer at a time, as a run has.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], schema: str):
        self.spark, self.folder, self.keys, self.schema = spark, folder.rstrip("/"), keys, schema

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def pointer(self) -> dict:
        """What counts now: {"n": number of the write, "parts": folders in order of writing, "old": folders before that}."""
        fs, path = self._files(), self._path("current")
        if not fs.exists(path):
            return {"n": 0, "parts": [], "old": []}
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _swap(self, pointer: dict) -> None:
        """Write the pointer beside the one that counts and rename it over that."""
        jvm, name = self.spark._jvm, f"_current-{uuid.uuid4().hex}"
        out = self._files().create(self._path(name))
        out.write(bytearray(json.dumps(pointer).encode()))
        out.close()
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        overwrite = self.spark.sparkContext._gateway.new_array(kind, 1)
        overwrite[0] = kind.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self.spark._jsc.hadoopConfiguration()).rename(self._path(name), self._path("current"), overwrite)

    def read(self) -> DataFrame:
        """One row a key: that of the last write that has it. Of equal keys in one write the greatest row."""
        parts = self.pointer()["parts"]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = None
        for n, part in enumerate(parts):
            own = self.spark.read.schema(self.schema).parquet(f"{self.folder}/{part}").withColumn("_n", F.lit(n))
            rows = own if rows is None else rows.unionByName(own)
        rest = [c for c in rows.columns if c not in (*self.keys, "_n")]
        best = rows.groupBy(*self.keys).agg(F.max(F.struct("_n", *rest)).alias("_r"))
        return best.select(*[F.col(c) if c in self.keys else F.col(f"_r.{c}").alias(c) for c in (*self.keys, *rest)])

    def put(self, rows: DataFrame) -> None:
        """Rows (of the schema, null keys are left out) become what the cache has of their keys."""
        now = self.pointer()
        names = [f.name for f in self.spark.createDataFrame([], self.schema).schema]
        rows = rows.select(*names).dropna("any", subset=self.keys)
        part = f"v{now['n'] + 1:06d}-{uuid.uuid4().hex[:8]}"
        if len(now["parts"]) < COMPACT:
            rows.write.parquet(f"{self.folder}/{part}")
            self._swap({"n": now["n"] + 1, "parts": [*now["parts"], part], "old": now["old"]})
            return
        new = rows.select(*self.keys).distinct()
        kept = self.read().join(new, self.keys, "left_anti").unionByName(rows)
        kept.write.parquet(f"{self.folder}/{part}")
        self._swap({"n": now["n"] + 1, "parts": [part], "old": now["parts"]})
        for old in now["old"]:
            self._files().delete(self._path(old), True)

    def look_up(self, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(hits, misses) of rows with the key columns: hits have the cache's other columns behind their own."""
        held = self.read()
        return asked.join(held, self.keys), asked.join(held.select(*self.keys), self.keys, "left_anti")
