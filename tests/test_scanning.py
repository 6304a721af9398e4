"""Keyword automata and bracket matching against brute force."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlens.functions import jsonscan
from firmlens.functions.text import balanced_json, fenced_json
from firmlens.operators import keywords
from firmlens.operators.keywords import KeywordAutomaton


# ---------------------------------------------------------------- brackets

def by_definition(text):
    """From each start in turn, character by character."""
    for i, first in enumerate(text):
        if first not in "{[":
            continue
        last, depth, quoted, skip = {"{": "}", "[": "]"}[first], 0, False, False
        for j, c in enumerate(text[i:], i):
            if skip:
                skip = False
            elif quoted and c == "\\":
                skip = True
            elif c == '"':
                quoted = not quoted
            elif not quoted:
                depth += (c == first) - (c == last)
                if not depth:
                    return text[i : j + 1].strip()
    return ""


def test_first_balanced_on_random_texts():
    rng = random.Random(2)
    for k in range(20_000):
        text = "".join(rng.choices('{}[]"\\a\n', [3, 3, 2, 2, 2, k % 3, 1, 1], k=rng.randint(0, 24)))
        assert jsonscan.first_balanced(text) == by_definition(text), text


def test_first_balanced_is_linear():
    for text in ("{" * 200_000, "[{" * 100_000, '{"\\"' * 50_000, "{}" * 5 + "[" * 200_000, '"{\\"' * 60_000 + "}"):
        began = time.time()
        jsonscan.first_balanced(text)
        assert time.time() - began < 5


def test_json_columns(spark):
    rows = [('x { y [ z { {"a":1}',), ('a { b { {"k":"v"} c',), (None,), ("",), ("none { [",), ('Sure:\n```json\n{ "a": "}" }\n```\n```\n[1]\n```',), ("``` nothing ``` [1, [2]] {3}",), ("{" * 50_000 + "[1]",)]
    got = spark.createDataFrame(rows, "t string").select(balanced_json(F.col("t")), fenced_json(F.col("t"))).collect()
    assert [r[0] for r in got] == ['{ {"a":1}'[2:], '{"k":"v"}', "", "", "", '{ "a": "}" }', "[1, [2]]", "[1]"]
    assert [r[1] for r in got] == ['{"a":1}', '{"k":"v"}', None, None, None, '{ "a": "}" }', "[1, [2]]", "[1]"]


# ---------------------------------------------------------------- keywords

def held(words, texts):
    return {(i, w) for i, t in enumerate(texts) for w, x in enumerate(words) if x in t}


@pytest.mark.parametrize("table, piece", [(1 << 15, 1024), (3, 7), (40, 1)])
def test_automaton_finds_all_substrings(monkeypatch, table, piece):
    monkeypatch.setattr(keywords, "TABLE", table)
    monkeypatch.setattr(keywords, "PIECE", piece)
    rng = random.Random(5)
    for _ in range(30):
        words = sorted({"".join(rng.choices("ab c", k=rng.randint(1, 6))).encode() for _ in range(rng.randint(1, 40))})
        texts = ["".join(rng.choices("ab cé", k=rng.choice([0, 1, 5, 60]))).encode() for _ in range(20)]
        offsets = np.cumsum([0, *map(len, texts)])
        row, word = KeywordAutomaton(words).found(np.frombuffer(b"".join(texts), np.uint8), offsets)
        assert set(zip(row.tolist(), word.tolist())) == held(words, texts) and len(row) == len(held(words, texts))
    assert not len(KeywordAutomaton([]).found(np.frombuffer(b"abc", np.uint8), np.array([0, 3]))[0])


@pytest.mark.parametrize("most", [4 << 20, 60])
def test_tag_texts(spark, monkeypatch, most):
    monkeypatch.setattr(keywords, "KEYWORD_BYTES", most)
    rng = random.Random(9)
    taxonomy = [(rng.choice("xy"), f"t{k % 9}", "".join(rng.choices("abc &", k=rng.randint(1, 4)))) for k in range(40)] + [("x", "blank", " - "), ("x", "none", None), (None, "t", "Äb"), ("x", "t1", "whole phrase")]
    rows = [(k, "".join(rng.choices("abcÄ& -", k=rng.randint(0, 30)))) for k in range(60)] + [(60, None), (61, ""), (62, "the WHOLE  phrase"), (62, "the WHOLE  phrase"), (63, "c" * 300_000), (None, "aäb")]
    from firmlens.functions.text import match_text

    df = spark.createDataFrame(rows, "k long, text string").withColumn("keyword", F.lit("a"))
    words = spark.createDataFrame(taxonomy, "category string, tag string, keyword string").withColumn("text", F.lit(1))
    flat = [r[0] for r in spark.createDataFrame([(k,) for _, _, k in taxonomy], "k string").select(match_text(F.col("k"))).collect()]
    texts = [r[0] for r in df.select(match_text(F.col("text"))).collect()]
    want = sorted(((k, c, t) for (k, _), x in zip(rows, texts) for c, t in {(c, t) for (c, t, _), w in zip(taxonomy, flat) if w and w in x}), key=repr)
    assert sorted(map(tuple, keywords.tag_texts(df, words, key="k", text="text").collect()), key=repr) == want
    assert not keywords.tag_texts(df, words.limit(0), key="k", text="text").count() and not keywords.tag_texts(df.limit(0), words, key="k", text="text").count()


def test_many_keywords_cost_as_few(spark):
    rng = random.Random(1)
    pool = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(4, 12))) for _ in range(100_000)]
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    took = {}
    for n in (100, 100_000):
        words = spark.createDataFrame([("c", f"t{k}", w) for k, w in enumerate(pool[:n])], "category string, tag string, keyword string").cache()
        words.count()
        for _ in range(2):
            began = time.time()
            keywords.tag_texts(docs, words, key="doc_id", text="text").write.format("noop").mode("overwrite").save()
            took[n] = time.time() - began
    print(took)
    assert took[100_000] < 3 * took[100] + 6, took


def test_phone_runs_of_a_long_text(spark):
    """A text's cost grows with its length: 30,000 runs of one text, each with its place and its surroundings."""
    from firmlens.operators import contacts

    lines = [f"Tel: +49 30 {7040601 + 37 * i} am 01.02.2024" for i in range(30_000)]
    text = "\n".join(lines)
    df = spark.createDataFrame([("a", text), ("b", None), ("c", "none"), ("d", "ü " * 100 + "0171 7040602" + " é" * 100)], "file string, text string")
    began = time.monotonic()
    got = {(r["file"], r["pos"]): r for r in contacts.candidates(df, region="DE").collect()}
    assert time.monotonic() - began < 60
    own = [r for r in got.values() if r["file"] == "a"]
    assert len(own) > 25_000 and all(r["pos"] % 2 == 0 and text[r["start"] :].startswith(r["raw"]) and r["raw"] == f"+49 30 {7040601 + 37 * (r['pos'] // 2)}" for r in own)
    for r in own[:50] + own[-50:]:
        low, high = max(0, r["start"] - 150), r["start"] + len(r["raw"]) + 150
        head, tail = text[:low].rpartition(" ")[2] if low else "", text[high:].partition(" ")[0]
        assert r["snippet"] == (head + text[low:high] + tail).strip(" ")
    d = got["d", 0]
    assert (d["start"], d["raw"], d["number"], d["national"]) == (200, "0171 7040602", "+491717040602", "1717040602") and not [k for k in got if k[0] in "bc"]
    assert d["snippet"] == ("ü " * 75 + "0171 7040602" + " é" * 75).strip(" ")
