"""The folder that all executors share, for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it stands; where it is shipped (--py-files) this does nothing."""
    root = str(Path(__file__).resolve().parents[1])
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in have.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{have}".rstrip(":")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir; below a temporary one only in local mode without that setting."""
    find_package(spark)
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-firmlens-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/firmlens/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to a fresh shared folder and read back: what was dear to make, model calls above all, is made once."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path of a URI or path; used inside of tasks."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)
