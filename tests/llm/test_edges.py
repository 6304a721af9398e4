"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for each operator and stage."""

import collections
import glob
import math
import os
import random
import re
import shutil
import weakref

import numpy as np
import pyarrow as pa
import pytest
from conftest import TINY
from oracle import compare
from pyspark.sql import functions as F
from test_ops import removed, shingle_classes

import corpus_pipeline
from firmlens.llm import bpe, chat, classifier, mixing, near_dedup, quality_rules, suffix_dedup, token_files, topk, warc
from firmlens.llm.common import batches_of, new_folder, shared_dir

LONG = "lorem ipsum dolor " * 20_000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _id long, key string, label int, node long, n long"
ROWS = [
    (1, "a b c d e f g", "en", "s1", 13, 1, "k", 1, 1, 1), (2, None, None, None, None, None, None, None, None, None), (3, "", "en", "", 0, 1, "k", 1, 1, 1),
    (4, " \n\t ", "de", "s1", 4, 1, "k", 1, 1, 1), (5, LONG, "en", "s2", len(LONG), 1, "k", 1, 1, 1), (5, LONG, "en", "s2", len(LONG), 1, "k", 1, 1, 1),
    (6, "Käse 中文 😀 " * 30, "xx", "s2", 9, 1, "k", 1, 1, 1), (None, "a b c d e f g", "en", "s1", 13, 1, "k", 1, 1, 1), (7, "x", None, "s1", 1, 1, "k", 1, 1, 1),
]


@pytest.fixture(params=["rows", "empty"])
def docs(spark, request):
    return spark.createDataFrame(ROWS if request.param == "rows" else [], DOCS)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (5, 1, 0), (6, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")


def test_mixing(docs):
    out = mixing.mix_sources(docs).collect()
    assert len(out) == docs.count() and all(r["taken"] <= 3 * r["size"] for r in out)


def test_mixing_comes_near_its_targets(spark):
    """A source's words are off its target by less than its largest document."""
    out = mixing.mix_sources(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    sums = out.groupBy("source").agg({"target": "first", "taken": "sum", "size": "max"}).collect()
    assert len(sums) == 20 and all(abs(r["sum(taken)"] - r["first(target)"]) < r["max(size)"] for r in sums)
    print("worst source", max(abs(r["sum(taken)"] / r["first(target)"] - 1) for r in sums))


def test_mixing_keeps_each_document_s_expectation(spark):
    """Over 200 offsets spread evenly over [0, 1) each document's mean copies are target / source_size, up to a step."""
    rows = [(i, " ".join(["w"] * (3000 if i < 3 else 5 + i % 17)), f"s{i % 4}") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    total, rate = collections.Counter(), {}
    original = mixing.source_offset
    try:
        drawn = []
        for at in range(200):
            mixing.source_offset = lambda source, seed, at=at: mixing.F.lit((at + 0.5) / 200)
            if not drawn:
                drawn = mixing.mix_sources(docs).collect()
                for r in drawn:
                    rate[r["doc_id"]] = r["target"] / r["source_size"]
                place = {}
                for s in {r["source"] for r in drawn}:
                    own = sorted((r for r in drawn if r["source"] == s), key=lambda r: (-r["size"], r["doc_id"]))
                    place |= {r["doc_id"]: k + 1 for k, r in enumerate(own)}
            got = {r["doc_id"]: r["copies"] for r in (drawn if at == 0 else mixing.mix_sources(docs).collect() if at % 50 == 0 else [])}
            want = {d: math.floor(k * rate[d] + (at + 0.5) / 200) - math.floor((k - 1) * rate[d] + (at + 0.5) / 200) for d, k in place.items()}
            assert not got or got == want
            total.update(want)
    finally:
        mixing.source_offset = original
    assert all(abs(total[d] / 200 - r) <= 0.01 for d, r in rate.items())


def test_hosts_with_many_failures_go(spark):
    """A small host whose documents all fail, and a large one that is several times worse than the others, lose all their
    documents; a host of one failed document, and a host a little worse than the others, don't."""
    good = " ".join(f"word{i}" for i in range(60))
    bad, symbols = "short text", good + " ###" * 60
    rows, i = [], 0
    for host, n, failed, text in [*[(f"h{k}", 100, 8 + k % 5, bad) for k in range(40)], ("small", 60, 59, bad), ("large", 2000, 900, bad), ("one", 2, 1, bad), ("worse", 300, 60, bad), ("symbols", 100, 80, symbols), (None, 100, 99, symbols)]:
        for k in range(n):
            rows.append((i, text if k < failed else good, host))
            i += 1
    stats = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["source"]: r["n"] for r in quality_rules.quality_rules(stats).where("kept").groupBy("source").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert set(kept) == {f"h{k}" for k in range(40)} | {"one", "worse"} and kept["one"] == 1 and kept["worse"] == 240
    verdicts = {(r["source"], r["rule"]): r for r in quality_rules.host_verdicts(quality_rules.document_stats(stats)).collect()}
    rates = np.array([r["failures"] / r["n"] for (_, rule), r in verdicts.items() if rule == "base"])
    sizes = np.array([r["n"] for (_, rule), r in verdicts.items() if rule == "base"])
    mean = rates.mean()
    spread = max((rates**2).mean() - mean**2 - mean * (1 - mean) * (1 / sizes).mean(), 1e-9)
    strength = min(max(mean * (1 - mean) / spread - 1, 2), 100)
    for (_, rule), r in verdicts.items():
        if rule == "base":
            assert r["rate"] == pytest.approx((r["failures"] + mean * strength) / (r["n"] + strength)) and r["limit"] == pytest.approx(min(0.5, max(0.1, 3 * mean)))


def test_quality_rules(docs):
    out = {r["doc_id"]: r for r in quality_rules.quality_rules(docs).collect()}
    assert len(out) == docs.select("doc_id").distinct().count()
    if out:
        assert out[2]["n_words"] == out[3]["n_words"] == out[4]["n_words"] == 0 and out[5]["n_repeat_words"] == 60_000 and out[5]["base_failed"]


def test_classifier(docs, labels):
    out = classifier.classify(docs, labels).collect()
    assert len(out) == docs.count()
    assert all((r["perplexity"] is None) == (r["n_words"] == 0) and (r["kept"] or r["n_words"] == 0 or r["perplexity"] > r["threshold"]) for r in out)
    assert len(classifier.classify(docs, labels.where("false")).collect()) == docs.count()


def test_near_dedup(docs):
    out = near_dedup.near_dedup(docs).collect()
    assert len(out) == docs.count()
    by = {r["doc_id"]: r["class_id"] for r in out}
    if by:
        assert by[1] is None and by[None] is None and by[2] == by[3] == 2 and by[4] == 4 and by[5] == 5 and by[7] == 7


def test_near_dedup_by_occurrences(spark):
    """A text and the same text twice over have equal sets of shingles, but half of the occurrences."""
    d = spark.createDataFrame([(1, "a b c d e f g h " * 20), (2, "a b c d e f g h " * 40), (3, "a b c d e f g h " * 21), (4, "q w e r t y u")], "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in near_dedup.near_dedup(d).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}


def test_near_dedup_of_several_texts_with_one_id(spark):
    """Different texts with one id, or without, are documents of their own; equal rows are one."""
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(None, a), (None, b), (None, b), (7, a), (7, "else " * 9), (7, "else " * 9), (8, b), (9, "alone")]
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["class_id"] or 0, r["representative"]) for r in got) == [(0, 0, True)] * 3 + [(7, 0, False), (7, 7, True), (7, 7, True), (8, 0, False), (9, 9, True)]


def test_near_dedup_with_several_ways_into_a_class(spark, monkeypatch):
    """A chain of texts, each like the next only, is one class; large buckets are compared in slices."""
    monkeypatch.setattr(near_dedup, "SLICE", 2)
    base = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join([*[f"x{k}_{j}" for j in range(k * 3)], *base[k * 3 :]])) for k in range(8)]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got.values()) == {0}


def test_suffix_dedup(docs):
    out = suffix_dedup.suffix_dedup(docs, keep_text=True, carry=("lang", "n_chars")).collect()
    assert len(out) == docs.count()
    if out:
        by = {r["doc_id"]: r for r in out}
        assert by[2]["text"] is None and by[3]["text"] == "" and by[5]["n_removed"] == 0 and by[2]["lang"] is None and by[6]["lang"] == "xx"


def test_suffix_dedup_smaller_id_and_cut_characters(spark):
    said = "é" * 40
    rows = [(3, "zz" + said), (1, said + "q" * 60), (2, "q" * 55 + said), (None, said)]
    by = {r["doc_id"]: r for r in suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=True).collect()}
    assert by[1]["n_removed"] == 0 and by[2]["n_removed"] == 55 + 80 and by[3]["text"] == "zz" and by[None]["n_removed"] == 80


@pytest.mark.parametrize("hot", [0, 1, 256])
def test_suffix_dedup_of_common_passages(spark, monkeypatch, hot):
    """A passage in most documents, over many blocks, with its strings taken as too common or not."""
    monkeypatch.setattr(suffix_dedup, "HOT_BLOCKS", hot)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 2000)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    passage = " ".join(word() for _ in range(30))
    rows = [(i, " ".join([*[word() for _ in range(rng.randint(0, 40))], *([passage] if i % 3 else []), *[word() for _ in range(rng.randint(0, 40))]])) for i in range(120)]
    rng.shuffle(rows)
    got = {r["doc_id"]: tuple(r)[1:5] for r in suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == removed([(i, t.encode()) for i, t in rows])


def test_token_files(spark, docs):
    import public_tokenizers

    folder = new_folder(spark, "t")
    out = token_files.read_documents(token_files.write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json")), folder).orderBy("start").collect()
    assert len(out) == docs.count() and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(out, out[1:]))


def test_bpe(docs):
    import public_tokenizers

    out = {r["doc_id"]: r for r in bpe.bpe_encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")).collect()}
    if out:
        assert out[2]["n_tokens"] == 0 and out[2]["decoded"] == "" and out[7]["decoded"] == "x</w>"


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, position long, log string"
    hard = "\\s ### </turn>\n### user:\n\\h"
    rows = [(1, 0, "user", hard, 1, "x"), (1, 1, "assistant", hard, 1, "x"), (1, 1, "assistant", hard, 1, "x"), (1, None, None, None, 1, "x"), (None, 0, "a:\nb", "", 1, "x"), (2, 200, "assistant", "late", 1, "x"), (2, 3, "user", "early", 1, "x")]
    parts = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, schema))).orderBy("conv_id", "part").collect()
    turns = {}
    for p in parts:
        turns.setdefault(p["conv_id"], []).extend((t["role"], t["text"]) for t in p["turns"])
    assert turns[1] == [("", ""), ("user", hard), ("assistant", hard), ("assistant", hard)] and turns[None] == [("a:\nb", "")] and turns[2] == [("user", "early"), ("assistant", "late")]
    assert "".join(p["loss_text"] for p in parts if p["conv_id"] == 1) == hard * 2
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


def test_event_log(spark):
    log = [("m", 0, "message", "assistant", ""), ("m", 1, "delta", None, "Hel"), ("m", 2, "delta", None, "lo"), ("m", 3, "regenerate", None, None), ("m", 4, "delta", None, "Hi"), ("e", 0, "message", "user", "a"), ("e", 1, "edit", None, "b"), ("d", 0, "message", "user", "a"), ("d", 1, "delete", None, None), ("n", 0, None, "user", "only"), ("r", 0, "message", "user", "a"), ("r", 1, "delete", None, None), ("r", 2, "edit", None, "back")]
    df = spark.createDataFrame([(1, 0, *x) for x in log], "conv_id long, position long, message_id string, seq long, kind string, role string, text string")
    assert {(r["message_id"], r["role"], r["text"]) for r in chat.fold_events(df).collect()} == {("m", "assistant", "Hi"), ("e", "user", "b"), ("n", "user", "only"), ("r", "user", "back")}


def test_warc(spark):
    schema = "page_id long, url string, html string, digest string, first long"
    same = "<p>" + "x" * 200
    rows = [(3, "http://a/", same, "z", 1), (2, None, same, None, 1), (2, None, same, None, 1), (None, "u", same, None, 1), (5, "u", None, None, 1), (6, "u", "", None, 1), (7, "u", "<p>", None, 1), (8, "u", "<p>", None, 1), (9, "u", LONG, None, 1)]
    folder = new_folder(spark, "w")
    out = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, schema), folder), folder).collect()
    assert len(out) == len(rows) and not any(r["error"] for r in out)
    names = [re.search(rb"WARC-Record-ID: (<[^>]*>)", raw)[1] for p in glob.glob(f"{folder.removeprefix('file://')}/*.warc.zst") for raw in warc.read_frames(open(p, "rb").read())]
    assert len(set(names)) == len(names) > len(rows)
    kinds = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in out)
    assert kinds == [(-1, "revisit", 2), (2, "response", None), (2, "response", None), (3, "revisit", 2), *[(i, "response", None) for i in (5, 6, 7, 8, 9)]]
    folder = new_folder(spark, "w")
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], schema), folder), folder).count() == 0


def test_topk_over_many_blocks(spark, monkeypatch):
    """Small blocks, repeated rows, clashing columns: the same as by all pairs."""
    monkeypatch.setattr(topk, "CANDIDATES", 16)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 0.0, rng.uniform(-2, 2)]) for _ in range(5)], 7, "x") for i in range(150)] + [(33, [1.0] * 5, 7, "x")] * 2
    got = {}
    for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, bucket string"), lambda i: i % 20 == 0, k=6).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ints = [(r[0], [math.floor(64 * x) for x in r[1]]) for r in rows]
    for q, v in ints:
        if q % 20 == 0:
            best = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints if i != q))[:6]
            assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]


def test_topk_sends_no_side_through_the_driver(spark):
    """Query blocks stand once a bucket, which their file's size doesn't tell: the join must not broadcast them."""
    rows = spark.range(400).select(F.col("id").alias("vec_id"), F.array(F.col("id") % 7 / 7.0, F.col("id") % 5 / 5.0).alias("embedding"))
    plan = topk.top_k(rows, lambda i: i % 20 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("high, bytes_each", [(0, 1), (127, 1), (128, 2), (2**15, 4), (2**31, 8), (2**63 - 1, 8)])
def test_topk_narrow_integers(high, bytes_each):
    values = np.array([high, -high, 1 if high else 0], np.int64)
    body = topk.narrow(values)
    assert len(body) == 3 * bytes_each and topk.widen(body, 3).tolist() == values.tolist()
    assert topk.widen(topk.narrow(values[:0]), 0).tolist() == [] and len(topk.narrow(np.array([-128]))) == 2


def test_topk_empty(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>, rank int"), lambda i: i % 20 == 0).count() == 0
    assert topk.top_k(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>"), lambda i: i % 20 == 0).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, name, tmp_path):
    shutil.copy(f"{TINY}/labels.parquet", tmp_path / "labels.parquet")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
    if name != "bpe":
        assert out.columns == list(corpus_pipeline.COLUMNS)
    rows = out.collect()
    if not docs.head(1):
        assert rows == []
    elif name == "near_dedup":
        assert sorted(r["doc_id"] or 0 for r in rows) == [0, 2, 4, 5, 6, 7]
    elif name == "suffix_dedup":
        want = removed_text([(i, (t or "").encode()) for i, t, *_ in ROWS])
        assert collections.Counter((r["doc_id"], r["text"] or "") for r in rows) == collections.Counter(want)
    elif name == "bpe":
        assert sorted(r["n_tokens"] for r in rows)[:3] == [0, 0, 0] and len(rows) == len(ROWS) and all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)


def removed_text(rows):
    """(id, what is left) of those of whose text something is left or that were empty; null ids are larger than all."""
    key = lambda i: 1 << 62 if i is None else i
    first = {}
    for i, t in sorted(rows, key=lambda r: key(r[0])):
        for k in range(len(t) - 49):
            first.setdefault(t[k : k + 50], key(i))
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < key(i):
                gone[k : k + 50] = True
        left = bytes(np.frombuffer(t, np.uint8)[~gone])
        if left or not t:
            yield i, left.decode("utf-8", "ignore")


def test_mixing_stage_copies(spark, tmp_path):
    """Repeated rows, and rows without an id, get together what the mix takes of them, no more."""
    text = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(i % 40 if i % 7 else None, text(i % 50, 20 + i % 30), "en", f"s{i % 3}" if i % 5 else None, i) for i in range(200)]
    rows += [(1, text(1, 30), "en", "s1", 1)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = collections.Counter((r["doc_id"], r["source"], r["text"]) for r in corpus_pipeline.mixing_stage(spark, docs, str(tmp_path)).collect())
    hashes = {r["h"]: r["text"] for r in docs.selectExpr("xxhash64(text) AS h", "text").distinct().collect()}
    want = collections.Counter()
    for r in mixing.mix_sources(docs).collect():
        want[r["doc_id"], r["source"], hashes[r["text_hash"]]] += r["copies"]
    assert out == +want


def test_pipeline_stage_by_stage(spark):
    """run() gives what the stages give, each against brute force; it leaves its result's table only."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    labels = spark.read.parquet(f"{TINY}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = corpus_pipeline.quality_stage(spark, docs, TINY).select("doc_id").collect()
    verdicts = {r["doc_id"]: r["kept"] for r in classifier.classify(docs, labels).collect()}
    assert sorted(r["doc_id"] for r in kept) == sorted(i for i, k in verdicts.items() if k)
    good = {r["doc_id"] for r in labels.where("quality = 1 AND toxic = 0").collect()}
    assert len([i for i in good if not verdicts[i]]) <= 0.05 * len(good)
    rows = [(r["doc_id"], texts[r["doc_id"]]) for r in kept]
    classes = shingle_classes(rows)
    rows = [(i, t) for i, t in rows if classes[i] == i]
    rows = dict(removed_text([(i, t.encode()) for i, t in rows]))
    left = spark.createDataFrame(list(rows.items()), "doc_id long, text string").join(docs.drop("text"), "doc_id").select(*corpus_pipeline.COLUMNS)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(left).collect()}
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for i, n in copies.items():
        ids = tokenizer.encode(rows[i], add_special_tokens=False).ids
        want[i, np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)] += n
    before = set(folders_of(spark))
    out = corpus_pipeline.run(spark, TINY)
    assert collections.Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in out.collect()) == +want
    assert len(set(folders_of(spark)) - before) == 1


def folders_of(spark):
    base = shared_dir(spark).removeprefix("file://")
    return os.listdir(f"{base}/firmlens")


def test_two_runs_keep_their_tables(spark):
    """A stage that another thread's or input's stage follows still has its tables."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    first = corpus_pipeline.near_stage(spark, docs, TINY)
    corpus_pipeline.near_stage(spark, docs, TINY)
    chained = corpus_pipeline.suffix_stage(spark, first, TINY)
    assert chained.count() == first.count() > 0


def test_mixing_counts_words_as_its_sql_does(spark, tmp_path):
    """Words end at each of the six characters of white space, in the SQL as in the code."""
    rows = [(i, f"a{c}b{c}c c" * (1 + i % 3), f"s{i % 2}") for i, c in enumerate(" \t\n\x0b\x0c\r" * 3)] + [(90, "x-y,z", "s0"), (91, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert compare(spark, str(tmp_path), mixing.op6_mix_sources, mixing.OP6_SQL) == 20
    assert {r["size"] for r in mixing.op6_mix_sources(spark, str(tmp_path)).where("doc_id = 4").collect()} == {7}


def test_a_block_is_judged_in_parts(monkeypatch):
    """Parts give what the whole block gives, bit by bit, and bound what is held beside the block's own entries."""
    import tracemalloc

    rng = np.random.default_rng(3)
    counts = rng.integers(0, 900, 2000)
    words, trusted = (rng.zipf(1.3, counts.sum()) % 5000 + 1).astype(np.uint32), rng.random(2000) < 0.5
    size = 1 << classifier.VOCAB_BITS
    tables = rng.integers(0, 50, size).astype("f4"), rng.random(size).astype("f4"), rng.integers(0, 9, size).astype("u4")
    entries = classifier.pair_table(classifier.pairs(words, np.concatenate([[0], np.cumsum(counts)])), counts)
    keys, number, doc, times = entries
    own = np.bincount(number[trusted[doc]], times[trusted[doc]], len(keys)).astype(np.int64) + 1
    model = (0.5, 0.7, 0.9), (0.4, 0.6, 0.8), len(keys), 1000.0
    tracemalloc.start()
    got = classifier.log_probabilities(*entries, own, trusted, tables, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * len(doc), (peak, len(doc))
    for most in (1, 1 << 12, 1 << 40):
        monkeypatch.setattr(classifier, "PART_ENTRIES", most)
        assert classifier.log_probabilities(*entries, own, trusted, tables, model).tobytes() == got.tobytes()


def test_encoded_words_are_kept_small():
    """Of a word its ids are kept, not their decoded string too, and of so many words only."""
    import tracemalloc

    import public_tokenizers

    model = bpe.WordBPE(public_tokenizers.path("word_bpe_49k.json"))
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + d for a in letters[:11] for b in letters for c in letters for d in letters]
    want = [model.merge(w) for w in words[:50]]
    tracemalloc.start()
    for i in range(0, len(words), 10_000):
        got = model.encode_batch([" ".join(words[i : i + 10_000])])
        if not i:
            assert np.frombuffer(got[0][0], "<u4").tolist()[: sum(map(len, want))] == [x for w in want for x in w]
            assert got[0][1].startswith(" ".join(model.decode(w) for w in want))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 32e6, held


def test_a_batch_is_let_go_before_the_next():
    last = []

    def frames():
        for i in range(3):
            batch = pa.RecordBatch.from_arrays([pa.array(["x" * 9, None, "y" * 9]), pa.array([i] * 3)], names=["text", "n"])
            last.append(weakref.ref(batch))
            yield batch
            del batch
            assert last[-1]() is None

    assert [s.num_rows for s in batches_of(frames(), 10)] == [2, 1] * 3 and len(last) == 3
