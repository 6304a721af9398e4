"""The training-data pipeline over documents: five stages, each written and read again before the next."""

from __future__ import annotations

import functools
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.llm.bpe import bpe_encode_decode, with_digests
from firmlens.llm.classifier import classify
from firmlens.llm.common import materialize, release, scratch
from firmlens.llm.mixing import mix_sources
from firmlens.llm.near_dedup import near_dedup
from firmlens.llm.suffix_dedup import suffix_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Ids that may be broadcast (about 40 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

#: Tables of the stage that a thread ran last on an input, where stages are called one by one: (thread, sf_dir) to the
#: stage's place and its folders. run() needs none of this.
_LAST: dict[tuple[int, str], tuple[int, list[str]]] = {}


def staged(place: int):
    """A stage, called by itself, that first deletes the tables of the stage before it, which this thread has run on this
    input and whose result it now gets, written and read again. Tables that docs still reads stay."""

    def wrap(stage):
        @functools.wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            key = threading.get_ident(), sf_dir
            before, folders = _LAST.pop(key, (0, []))
            if folders and before == place - 1:
                read = [f.split(":", 1)[-1].lstrip("/") for f in docs.inputFiles()]
                bare = lambda f: f.split(":", 1)[-1].strip("/") + "/"
                release(spark, [f for f in folders if not any(x.startswith(bare(f)) for x in read)])
            with scratch() as folders:
                out = stage(spark, docs, sf_dir)
            _LAST[key] = place, folders
            return out

        return run_stage

    return wrap


def without(docs: DataFrame, ids: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Rows of docs whose keys (columns of ids, by name, as docs has them) are not in ids; null counts as a value. Few ids
    (counted) are broadcast, so that the texts aren't shuffled."""
    ids = materialize(ids.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct(), "gone")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    same = functools.reduce(lambda a, b: a & b, [c.eqNullSafe(F.col(f"_{k}")) for k, c in keys.items()])
    return docs.join(ids, same, "left_anti")


@staged(1)
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, with the columns of documents. Rows with one doc_id (null is one) go or
    stay together: any kept row keeps them. Null, empty and blank texts go. An empty table stays empty; further columns
    are left out."""
    judged = classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    gone = judged.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("NOT kept")
    return without(docs.select(*COLUMNS), gone, {"doc_id": F.col("doc_id")})


@staged(2)
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that with the least doc_id (null is less than all); of its equal rows
    one. Different texts with one doc_id (null is one) are documents of their own. Texts without a word are copies of
    equal texts only. An empty table stays empty; further columns are left out."""
    classes = materialize(near_dedup(docs), "classes")
    docs = docs.select(*COLUMNS)
    rows = classes.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    gone = classes.where("NOT representative").select("doc_id", "text_hash")
    if rows["rows"] == rows["ids"]:
        return without(docs, gone, {"doc_id": F.col("doc_id")})
    out = without(docs, gone, {"doc_id": F.col("doc_id"), "text_hash": F.xxhash64(F.coalesce("text", F.lit("")))})
    return out.withColumn("_hash", F.xxhash64(F.coalesce("text", F.lit("")))).dropDuplicates(["doc_id", "_hash"]).drop("_hash")


@staged(3)
def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has too; n_chars follows where something went. Texts
    that nothing is left of go; texts that were null or empty before stay. Null ids count as larger than all others; rows
    with one doc_id don't match each other. An empty table stays empty; further columns are left out."""
    out = suffix_dedup(docs, keep_text=True, carry=("lang", "source", "n_chars")).where((F.col("n_bytes") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*COLUMNS)


@staged(4)
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times), all columns kept. Documents without a word have no size,
    and may be taken or not. Rows of one (doc_id, source, text) are the same document: their copies are summed, and the row
    with the least other columns stands for all. Null ids and sources count as values. An empty table stays empty; further
    columns are left out."""
    key = {"doc_id": F.col("doc_id"), "source": F.col("source"), "text_hash": F.xxhash64("text")}
    copies = mix_sources(docs).groupBy(*key).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    copies = materialize(copies.select(*[F.col(k).alias(f"_{k}") for k in key], "copies", "rows"), "copies")
    same = functools.reduce(lambda a, b: a & b, [c.eqNullSafe(F.col(f"_{k}")) for k, c in key.items()])
    joined = docs.select(*COLUMNS).join(copies, same)
    if copies.where("rows > 1").head(1):
        several = joined.where("rows > 1").groupBy(*[f"_{k}" for k in key]).agg(F.min(F.struct(*COLUMNS)).alias("_row"), F.first("copies").alias("copies"))
        joined = joined.where("rows = 1").select(*COLUMNS, "copies").unionByName(several.select("_row.*", "copies"))
    return joined.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


@staged(5)
def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every document: doc_id, n_tokens, ids (token ids, little-endian 32-bit), decoded (their text) and the SHA-256
    digests of both. Null text: empty, so no tokens. Repeated rows: a row each. An empty table stays empty; further columns
    are left out."""
    import public_tokenizers

    return with_digests(bpe_encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_classifier", quality_stage),
    ("near_dedup", near_stage),
    ("suffix_dedup", suffix_stage),
    ("mixing", mixing_stage),
    ("bpe", encode_stage),
]

#: Near duplicates, suffix sorting and BPE aren't expressible in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents: each stage's rows are written as Parquet in the shared folder and read by the next. A
    stage's own tables go once its rows are written, those rows once the next stage's are; the last ones are the result."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with scratch() as written:
            with scratch() as inner:
                rows = stage.__wrapped__(spark, docs, sf_dir)
            docs = materialize(rows, name)
        release(spark, inner)
        release(spark, before)
        before = written
    return docs
