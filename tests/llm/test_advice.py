"""What a review found: places where an operator did less than the whole job."""

import pytest

from firmlens.llm import classifier

LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def verdicts(spark):
    """Share kept of labelled documents whose labels the classifier doesn't see, by (quality, toxic)."""
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    out = classifier.classify(spark.read.parquet(f"{LARGE}/documents.parquet"), labels.where("doc_id % 4 > 0"))
    rows = out.join(labels.where("doc_id % 4 = 0"), "doc_id").groupBy("quality", "toxic").agg({"kept": "count", "*": "count"}).collect()
    kept = out.join(labels.where("doc_id % 4 = 0"), "doc_id").where("kept").groupBy("quality", "toxic").count().collect()
    kept, of = {(r["quality"], r["toxic"]): r["count"] for r in kept}, {(r["quality"], r["toxic"]): r["count(kept)"] for r in rows}
    print({k: (kept.get(k, 0), n) for k, n in of.items()})
    return {k: kept.get(k, 0) / n for k, n in of.items()}


def test_classifier_drops_toxic_and_junk(verdicts):
    assert verdicts[1, 1] < 0.1 and verdicts[0, 0] < 0.05 and verdicts[0, 1] < 0.05


def test_classifier_keeps_clean(verdicts):
    assert verdicts[1, 0] > 0.93
