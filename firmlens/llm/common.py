"""What the operators share: the cluster's shared folder, written tables, byte-level word hashing."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import gc
import sys
import tempfile
import time
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts have it: space and \t to \r.
WS = " \t\n\x0b\x0c\r"
WS_RUN = r"[\x20\x09-\x0D]+"


# ---------------------------------------------------------------- shared folder

def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it stands; where it is shipped (--py-files) this does nothing."""
    root = str(Path(__file__).resolve().parents[2])
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in have.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{have}".rstrip(":")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one in local mode."""
    sc = spark.sparkContext
    find_package(spark)
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spark-firmlens-")
        spark.conf.set("spark.checkpoint.dir", path)
        sc.setCheckpointDir(path)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


#: Folders named so far, oldest first: those of the innermost scratch(), else of the process.
_FOLDERS: contextvars.ContextVar[list[str]] = contextvars.ContextVar("folders", default=[])  # noqa: B039


@contextlib.contextmanager
def scratch() -> Iterator[list[str]]:
    """The folders that are named inside of the block, in this thread."""
    folders: list[str] = []
    token = _FOLDERS.set(folders)
    try:
        yield folders
    finally:
        _FOLDERS.reset(token)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder."""
    folder = f"{shared_dir(spark)}/firmlens/{name}-{uuid.uuid4().hex[:12]}"
    _FOLDERS.get().append(folder)
    return folder


def materialize(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: cuts the lineage, survives lost executors.
    parts: how many tasks write it, where the caller knows that the table is small."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    (df if parts is None else df.coalesce(parts)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, folders: list[str] | None = None) -> None:
    """Delete folders (all named outside of scratch(), if not given). Call when no result made of them is read any more."""
    named = _FOLDERS.get() if folders is None else folders
    for folder in list(named):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        named.remove(folder)


def release_shuffles(spark: SparkSession) -> None:
    """Let the driver's JVM collect plans that nothing refers to any more: with them their shuffle files go, which otherwise
    stay on the executors' disks until the driver happens to collect. Call between steps whose results are written."""
    for _ in range(2):  # Python's own references first; what they held is found the second time
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path of a folder URI; used inside tasks. file:/x, file:///x and other schemes."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def put_file(uri: str, name: str, body: bytes) -> None:
    """Write a whole file, seen under its name only when complete; writing it again (a retried task) is harmless."""
    fs, path = open_store(uri)
    fs.create_dir(path, recursive=True)
    part = f"{path}/_{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(body)
    fs.move(part, f"{path}/{name}")


def get_file(uri: str, name: str) -> bytes:
    fs, path = open_store(uri)
    with fs.open_input_stream(f"{path}/{name}", compression=None) as f:
        return f.read()


# ---------------------------------------------------------------- columns

def parallelism(spark: SparkSession) -> int:
    """How many pieces a shuffle is cut into: the session's own setting."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text as an array; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WS_RUN), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words as a long, without building them twice."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, WS_RUN))).cast("long")


def text_size(docs: DataFrame) -> int:
    """Bytes of all texts."""
    return int(docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)


def in_order(docs: DataFrame) -> DataFrame:
    """Each partition in order of (doc_id, text's hash): so a task that runs again, on rows that a shuffle gives in another
    order, makes the same blocks under the same names."""
    return docs.sortWithinPartitions("doc_id", F.xxhash64("text"))


def prefix_sums(df: DataFrame, order: list[Column], sums: dict[str, Column], groups: list[str] | None = None) -> DataFrame:
    """Inclusive running totals in a total order, per group, without gathering a group in one task.

    Rows are dealt by range of (groups, order); each partition sums its own rows; the partitions' totals, one row per
    (partition, group), give the offsets. order must make ties interchangeable. Group values may be null.
    """
    from pyspark.sql import Window

    groups = groups or []
    flags = [F.col(g).isNull() for g in groups]
    dealt = df.repartitionByRange(parallelism(df.sparkSession), *flags, *[F.col(g) for g in groups], *order)
    dealt = materialize(dealt.withColumn("_pid", F.spark_partition_id()), "dealt")
    keys = ["_pid", *groups]
    own = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = dealt.groupBy(*keys).agg(*[F.sum(c).alias(f"_t_{k}") for k, c in sums.items()])
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("_pid").alias("_p"), *[F.col(g).alias(f"_g_{g}") for g in groups], *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums])
    on = [F.col("_pid") == F.col("_p"), *[F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups]]
    local = dealt.withColumns({f"_l_{k}": F.sum(c).over(own) for k, c in sums.items()})
    return local.join(totals, on).withColumns({k: F.col(f"_l_{k}") + F.col(f"_o_{k}") for k in sums}).select(*df.columns, *sums)


# ---------------------------------------------------------------- bytes and words in tasks

PRIME = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xFF51AFD7ED558CCD)
MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
#: Inverse of PRIME modulo 2 ** 64 (PRIME is odd).
PRIME_INV = np.uint64(pow(int(PRIME), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, in place."""
    h ^= h >> np.uint64(33)
    h *= MIX1
    h ^= h >> np.uint64(29)
    h *= MIX2
    h ^= h >> np.uint64(32)
    return h


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; the longest is kept."""
    have = _POWERS.get(str(base))
    if have is None or len(have) < n:
        have = np.ones(max(n, 1 << 16), np.uint64)
        have[1:] = base
        np.multiply.accumulate(have, out=have)
        _POWERS[str(base)] = have
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, end to end, and the n + 1 offsets; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


#: What a worker process keeps between tasks of one kind, as things to clear; and the kind of its last task.
CACHES: list = [_POWERS]
_LAST = ""


def enter(kind: str) -> None:
    """Called where a task begins: caches of another kind of task go, for a worker process lives through all of them."""
    global _LAST
    if kind != _LAST:
        for cache in CACHES:
            cache.clear()
        _LAST = kind
        release_memory()


def release_memory() -> None:
    """Give freed memory back to the system after a large group; worker processes live on between tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts that stand end to end, and the n + 1 offsets of each text's words."""
    n = len(body)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[body]
    starts_at = inside.copy()
    starts_at[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    starts_at[heads] = inside[heads]
    ends_at = inside.copy()
    ends_at[:-1] &= ~inside[1:]
    tails = offsets[1:][np.diff(offsets) > 0] - 1
    ends_at[tails] = inside[tails]
    starts, ends = np.flatnonzero(starts_at), np.flatnonzero(ends_at) + 1
    hashes = np.empty(len(starts), np.uint64)
    step = 1 << 18  # bytes whose running hash is held at a time; a word is never cut, for chunks end with a word
    at = 0
    while at < len(starts):
        low = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, low + step, side="right")))
        high = ends[upto - 1]
        run = np.empty(high - low + 1, np.uint64)
        run[0] = 0
        np.cumsum((body[low:high].astype(np.uint64) + np.uint64(1)) * powers(PRIME, high - low), out=run[1:])
        s, e = starts[at:upto] - low, ends[at:upto] - low
        hashes[at:upto] = mix((run[e] - run[s]) * powers(PRIME_INV, int(s[-1]) + 1)[s] + (e - s).astype(np.uint64) * MIX1)
        at = upto
    return hashes, np.searchsorted(starts, offsets)


def batches_of(frames, limit: int):
    """Arrow batches in slices of about `limit` bytes of their `text` column, at least a row each. A batch is let go before the
    next one is read."""
    for batch in frames:
        column = batch.column(batch.schema.get_field_index("text"))
        sizes = np.diff(text_bytes(column)[1])
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < len(sizes):
            yield batch.slice(start, len(sizes) - start)
        del batch, column
