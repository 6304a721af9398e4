"""Steps whose cost must not grow faster than their input: files of texts, pages, sheets, numbers."""

import os

import pyarrow as pa
import pytest
from conftest import TINY
from pyspark.sql import functions as F

from firmlens.operators import ranking
from firmlens.plans import office, tasks
from firmlens.shared import shared_folder
from firmlens.sources import files, html


def test_many_texts_are_not_a_folder_each(spark, monkeypatch):
    monkeypatch.setattr(files, "FOLDERS", 4)
    folder = shared_folder(spark, "texts")
    rows = [(f"Row{i}_a.txt", f"text {i}\nü") for i in range(60)] + [("Row60_b.txt", None)]
    df = spark.createDataFrame(rows, "name string, text string")
    for _ in range(2):  # a second time changes nothing
        files.write_texts(df, folder)
        got = {r["path"].rsplit("/", 1)[1]: r["text"] for r in files.read_texts(spark, folder).collect()}
        assert {k: v for k, v in got.items() if v} == dict(rows[:-1])
    local = "/" + folder.split(":", 1)[-1].lstrip("/")
    assert len([x for x in os.listdir(local) if os.path.isdir(f"{local}/{x}")]) <= 4
    assert not [f for _, _, names in os.walk(local) for f in names if f.startswith("_")]
    empty = shared_folder(spark, "texts")
    files.write_texts(df.limit(0), empty)
    assert files.read_texts(spark, empty).count() == 0


def test_pages_are_parsed_in_slices(monkeypatch):
    monkeypatch.setattr(html, "HTML_BYTES", 100)
    pages = ["x" * 60, None, "y" * 30, "ü" * 200, "", "z" * 99, "z"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(["u"] * 8), pa.array(["skipped", *pages])], names=["page_id", "url", "html"]).slice(1)
    got = list(html.slices([batch, batch.slice(0, 0)]))
    assert [x for g in got for x in g.column(2).to_pylist()] == pages
    assert all(g.num_rows == 1 or sum(len((x or "").encode()) for x in g.column(2).to_pylist()) <= 100 for g in got) and len(got) == 3


@pytest.mark.parametrize("query", ["workbook_back", "workbook_union"])
def test_sheets_are_read_once(spark, query):
    out = getattr(office, query)(spark, TINY)
    assert "BatchScan" not in out._jdf.queryExecution().executedPlan().toString()  # rows of sheets stand in a table by then


def test_a_number_is_normalized_once(spark):
    a = spark.range(9).select(F.col("id").alias("row"), F.concat(F.lit("+49 30 123"), F.col("id") + 1000).alias("number"), F.lit("u").alias("source_url"))
    b = a.select(F.col("row").alias("out_id"), "number", "source_url", F.lit(True).alias("is_valid"), *[F.lit("x").alias(c) for c in ("classification", "type", "person", "role")])
    out = ranking.best_outputs(a, b, "row")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[1-9][0-9]{6,14}") <= 20, plan.count("[1-9][0-9]{6,14}")
    assert {(r["row"], r["out_id"], r["needs_retry"]) for r in out.collect()} == {(i, i, False) for i in range(9)}


@pytest.mark.parametrize("query", ["match_partners", "rank_numbers"])
def test_prompts_are_made_once(spark, query):
    out = getattr(tasks, query)(spark, TINY)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "prompts-" in plan and "documents.parquet" not in plan  # prompts stand in a table by then
    assert out.count() > 0
