"""The operators' queries against SQL, brute force and the tokenizers library, on the small tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import TINY
from oracle import compare

from firmlens.llm import bpe, classifier, near_dedup, queries, suffix_dedup, token_files, topk, warc
from firmlens.llm.common import new_folder, text_bytes, word_hashes


def documents():
    return pq.read_table(f"{TINY}/documents.parquet").to_pandas().sort_values("doc_id")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    compare(spark, TINY, queries.QUERIES[name], queries.ORACLE_SQL[name])


# ---------------------------------------------------------------- brute force

def removed(rows):
    """(id, bytes) to (size, removed, spans, digest), window by window."""
    first = {}
    for d, t in sorted(rows):
        for i in range(len(t) - 49):
            first.setdefault(t[i : i + 50], d)
    out = {}
    for d, t in rows:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < d:
                gone[i : i + 50] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[d] = (len(t), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest())
    return out


def test_op2_brute_force(spark):
    got = {r[0]: tuple(r)[1:5] for r in queries.QUERIES["op2_suffix_dedup"](spark, TINY).collect()}
    d = documents()
    assert got == removed([(i, t.encode()) for i, t in zip(d.doc_id, d.text)])


def test_two_stage_sorting():
    rng = random.Random(5)
    for trial in range(30):
        letters = (b"ab", b"aab\x00\xff")[trial % 2]
        pieces = list({bytes(rng.choice(letters) for _ in range(rng.randint(50, 90))) for _ in range(rng.randint(1, 8))} | ({b"a" * 80} if trial % 3 == 0 else set()))
        piece, offset, group = suffix_dedup.repeated_windows(pieces, 50)
        got = [pieces[i][j : j + 50] for i, j in zip(piece, offset)]
        assert got == sorted(p[j : j + 50] for p in pieces for j in range(len(p) - 49))
        assert list(group) == [0, *np.cumsum([a != b for a, b in zip(got, got[1:])])]


def test_sampling_takes_one_string_in_every_window():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 100, 600_000).astype(np.uint8)
    offsets = np.array([0, 30, 30, 80, 270_000, 600_000])
    where, _ = suffix_dedup.sample(body, offsets)
    for a, b in zip(offsets, offsets[1:]):
        own = where[(where >= a) & (where + suffix_dedup.GRAM <= b)]
        if b - a >= suffix_dedup.MATCH:
            gaps = np.diff(np.concatenate([[a - 1], own, [b - suffix_dedup.GRAM + 1]]))
            assert gaps.max() <= suffix_dedup.MATCH - suffix_dedup.GRAM + 1


def shingle_classes(rows):
    """Classes by all pairs: equal texts, or weighted Jaccard of 5-word shingles, by occurrences, of 0.8 or more."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen = collections.Counter([tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else []))
        sets.append({(x, k) for x, n in seen.items() for k in range(n)})
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if rows[a][1] == rows[b][1] or (both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both)):
                x, y = find(rows[a][0]), find(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


@pytest.mark.parametrize("folder", [TINY, "/root/testdata/sf0.01"])
def test_op3_brute_force(spark, folder):
    got = {r["doc_id"]: r["class_id"] for r in queries.QUERIES["op3_near_dedup"](spark, folder).collect()}
    d = pq.read_table(f"{folder}/documents.parquet").to_pandas()
    assert got == shingle_classes(list(zip(d.doc_id, d.text)))


@pytest.mark.parametrize("weighted", [False, True])
def test_dart_minhash_estimates_weighted_jaccard(weighted):
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 2**63, 100).astype(np.uint64)])
    wa, wb = rng.integers(1, 9, 400).astype(float), rng.integers(1, 9, 400).astype(float)
    sig = near_dedup.dart_minhash(np.concatenate([a, b]), np.concatenate([wa, wb]) if weighted else None, np.array([0, 400, 800]), 4096)
    x, y = (dict(zip(a, wa)), dict(zip(b, wb))) if weighted else (dict.fromkeys(a, 1), dict.fromkeys(b, 1))
    want = sum(min(x.get(k, 0), y.get(k, 0)) for k in {*x, *y}) / sum(max(x.get(k, 0), y.get(k, 0)) for k in {*x, *y})
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03


@pytest.mark.parametrize("small", [0, 5, 100_000])
def test_components_of_paths_and_stars(spark, monkeypatch, small):
    monkeypatch.setattr(near_dedup, "SMALL_EDGES", small)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(129, 200)]
    random.Random(2).shuffle(edges)
    got = {r["node"]: r["label"] for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in [*range(100, 130), 200]} == {100}


def test_op5_brute_force(spark):
    """Perplexities by plain counting: of a document that the model has counted, by all others' counts."""
    got = {r["doc_id"]: r["perplexity"] for r in queries.QUERIES["op5_quality_classifier"](spark, TINY).collect()}
    d, labels = documents(), pq.read_table(f"{TINY}/labels.parquet").to_pandas()
    fold = {r["i"]: r["h"] for r in spark.createDataFrame([(int(i),) for i in d.doc_id], "i long").selectExpr("i", "pmod(xxhash64(i), 10) AS h").collect()}
    trusted = set(labels[(labels.quality == 1) & (labels.toxic == 0)].doc_id)
    bits, pairs, counts = classifier.VOCAB_BITS, {}, collections.Counter()
    for i, t in zip(d.doc_id, d.text):
        keys = classifier.restore(classifier.pairs(*classifier.text_words(*text_bytes(pa.array([t])))))
        pairs[i] = [(int(k) >> bits, int(k) & (2**bits - 1)) for k in keys]
        if i in trusted and fold[i] >= 2:
            counts.update(pairs[i])
    of = collections.Counter(counts.values())
    d2 = classifier.discounts(*[of[k] for k in (1, 2, 3, 4)])
    of = collections.Counter(collections.Counter(w for _, w in counts).values())
    d1 = classifier.discounts(*[of[k] for k in (1, 2, 3, 4)])

    def model(counts):
        total, lower, into = collections.Counter(), collections.Counter(), collections.Counter()
        for (v, w), c in counts.items():
            total[v] += c
            lower[v] += d2[min(c, 3) - 1]
            into[w] += 1
        n = len(counts)
        rest = sum(d1[min(c, 3) - 1] for c in into.values()) / n

        def p(v, w):
            single = ((into[w] - d1[min(into[w], 3) - 1]) if into[w] else 0) / n + rest / (2**bits - 1)
            c = counts.get((v, w), 0)
            return ((c - d2[min(c, 3) - 1] if c else 0) + lower[v] * single) / total[v] if total[v] else single

        return p

    whole, checked = model(counts), 0
    for i, ps in pairs.items():
        p = whole
        if i in trusted and fold[i] >= 2:
            if checked > 40:
                continue
            checked += 1
            p = model(counts - collections.Counter(ps))
        if ps:
            assert got[i] == pytest.approx(math.exp(-sum(math.log(p(*x)) for x in ps) / len(ps)), rel=1e-5)
    assert checked > 20
    contexts = collections.Counter(v for v, _ in counts)
    assert sum(whole(contexts.most_common(1)[0][0], w) for w in {w for _, w in counts}) <= 1 + 1e-9  # a distribution over word numbers


def test_op5_verdicts(spark, monkeypatch):
    """Thresholds and verdicts from the scores, by plain loops."""
    scored = []
    monkeypatch.setattr(classifier, "judge", lambda df, judge=classifier.judge: scored.append(df) or judge(df))
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_quality_classifier"](spark, folder).collect()}
    rows = [r for r in scored[0].collect()]
    log_p = {r["doc_id"]: -r["log_prob"] / r["n_words"] for r in rows if r["n_words"]}
    held = [r for r in rows if r["fold"] in (2, 4, 6) and r["n_words"]]
    fine = [r for r in held if r["fold"] == 2]
    low = lambda xs, q: sorted(xs)[max(math.ceil(q * len(xs)), 1) - 1]
    langs = collections.defaultdict(list)
    for r in fine:
        langs[r["lang"]].append(log_p[r["doc_id"]])
    overall = low([x for xs in langs.values() for x in xs], 0.5)
    middle = lambda r: low(langs[r["lang"]], 0.5) if len(langs[r["lang"]]) >= classifier.LEAST_HELD else overall
    short = lambda r: 1 / math.sqrt(max(r["n_words"], 1))
    x, y = np.array([short(r) for r in fine]), np.array([abs(log_p[r["doc_id"]] - middle(r)) for r in fine])
    slope, level = np.polyfit(x, y, 1)
    if slope <= 0 or level <= 0:
        slope, level = 0.0, y.mean()
    far = lambda r: (log_p[r["doc_id"]] - middle(r)) / (slope * short(r) + level)
    measures = [far, lambda r: r["odds"], lambda r: r["repeats"]]
    limits = [[low([f(r) for r in fine], q) for q in classifier.LEVELS] for f in measures]
    own = {}
    for r in fine:
        own.setdefault(r["lang"], []).append(far(r))
    own = {lang: [low(xs, q) for q in classifier.LEVELS] for lang, xs in own.items() if len(xs) >= classifier.LEAST_HELD}
    limit = lambda r, m, k: own.get(r["lang"], limits[0])[k] if m == 0 else limits[m][k]  # noqa: E731  perplexity: each language's own quantile
    assert own and len({tuple(x) for x in own.values()}) == len(own)
    best = None
    for k in np.ndindex(*[len(classifier.LEVELS)] * 3):
        passes = lambda r: all(f(r) <= limit(r, m, k[m]) + 1e-12 for m, f in enumerate(measures))  # noqa: B023, E731
        share = lambda n: np.mean([passes(r) for r in held if r["fold"] == n]) if any(r["fold"] == n for r in held) else None  # noqa: B023, E731
        others = [s for s in (share(4), share(6)) if s is not None]
        value = share(2) - sum(others) / len(others)
        if best is None or (value, k) > (best[0] - 1e-12, best[1]) and value > best[0] - 1e-12:
            best = (value, k)
    chosen = [limits[m][i] for m, i in enumerate(best[1])]
    at = lambda r: limit(r, 0, best[1][0])
    off = 0
    for r in rows:
        out = got[r["doc_id"]]
        if r["n_words"]:
            passed = r["odds"] <= chosen[1] and r["repeats"] <= chosen[2]
            assert out["threshold"] == pytest.approx(math.exp(middle(r) + at(r) * (slope * short(r) + level)) if passed else 0.0, rel=1e-5)
            off += out["kept"] != (passed and far(r) <= at(r) + 1e-9)
        else:
            assert not out["kept"] and out["perplexity"] is None
    assert off == 0 and 0 < sum(r["kept"] for r in got.values()) < len(got)


@pytest.mark.parametrize("write", [lambda d, f: suffix_dedup.write_blocks(d, f, 5), lambda d, f: classifier.write_blocks(d, f, 5, [])])
def test_blocks_do_not_depend_on_the_order_of_rows(spark, write):
    """A map task that runs again on rows in another order gives the same blocks, shards and rows."""
    docs = spark.read.parquet(f"{TINY}/documents.parquet").selectExpr("doc_id", "text", "lang", "CAST(NULL AS INT) AS fold").coalesce(1)
    made = []
    for seed in (1, 2):
        mixed = docs.selectExpr("*", f"xxhash64(doc_id, {seed}) AS r").sortWithinPartitions("r").drop("r")
        made.append(sorted(tuple(map(str, r)) for r in write(mixed, new_folder(spark, "blocks")).collect()))
    assert made[0] == made[1]


def test_op8_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    d = documents()
    for i, t in zip(d.doc_id, d.text):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.QUERIES["op8_token_files"](spark, TINY).collect())) == want


def test_cached_encoder_and_codes():
    import public_tokenizers

    rng = random.Random(3)
    enc = token_files.CachedEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    letters = "ab c\n\t \r'sé “ ß<|!?½中😀\x1c\x85　 -1"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + ["<|endoftext|>", "a <|endoftext|> b", "", " x", "x ", "x\n\ny"]
    ids, at = enc.encode(*text_bytes(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids
    for n in (0, 1, 511, 512, 513, 3000):
        for high in (200, 300, 70_000, 2**31):
            x = np.random.default_rng(n).integers(0, high, n).astype(np.uint32)
            codes = token_files.Codes.load(token_files.Codes.encode(x).dump())
            for _ in range(10):
                a, b = sorted(rng.randint(0, n) for _ in range(2))
                assert (codes.decode(a, b) == x[a:b]).all()


def test_cached_encoder_refuses_other_files():
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        token_files.CachedEncoder(public_tokenizers.path("word_bpe_49k.json"))


def test_token_file_ranges(tmp_path):
    """Any token of any document, by reading its own bytes only."""
    rng = np.random.default_rng(7)
    lengths = [0, 1, 700, 3, 0, 5000, 40]
    for high in (200, 70_000, 2**31):
        ids = rng.integers(0, high, sum(lengths)).astype(np.uint32)
        body = token_files.dump_file(list(range(len(lengths))), lengths, ids)
        (tmp_path / "f").write_bytes(body)
        f, at = token_files.TokenFile(f"file://{tmp_path}", "f"), 0
        read, sizes = f._read, []
        f._read = lambda at, n: (sizes.append(n), read(at, n))[1]
        for d, n in enumerate(lengths):
            assert (f.tokens(d) == ids[at : at + n]).all()
            for _ in range(5):
                a, b = sorted(rng.integers(0, n + 1, 2).tolist())
                assert (f.tokens(d, a, b) == ids[at + a : at + b]).all()
            at += n
        sizes.clear()
        assert f.tokens(5, 4000, 4001) == ids[704 + 4000] and sum(sizes) < 1000
        f.close()


def test_op10_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, own, rng = Tokenizer.from_file(path), bpe.WordBPE(path), random.Random(4)
    letters = "abcdeΣσİIıßÅéÅ   \t\n\r'sre<|>!?½²٣中文日本😀👩‍👩\x00\x1c\x85ﬁǅ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + ["<|endoftext|>", "a<|startoftext|>b<|endoftext|>", "<|ENDOFTEXT|>", "", " "]
    for t in texts:
        e = tokenizer.encode(t, add_special_tokens=False)
        assert own.encode(t) == e.ids
        assert own.encode_batch([t])[0][1] == own.decode(e.ids) == tokenizer.decode(e.ids, skip_special_tokens=False)
    want = {}
    d = documents()
    for i, t in zip(d.doc_id, d.text):
        e = tokenizer.encode(t, add_special_tokens=False)
        want[i] = (len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tokenizer.decode(e.ids, skip_special_tokens=False).encode()).hexdigest())
    assert {r[0]: tuple(r)[1:] for r in queries.QUERIES["op10_bpe"](spark, TINY).collect()} == want


def test_word_hashes_tell_words():
    hashes, at = word_hashes(*text_bytes(pa.array(["a b\ta", "", None, " \n ", "b\x0bab"])))
    assert at.tolist() == [0, 3, 3, 3, 3, 5]
    assert hashes[0] == hashes[2] != hashes[1] == hashes[3] and len(set(hashes.tolist())) == 3


# ---------------------------------------------------------------- archives

def test_archive_round_trip_and_checks():
    writer = warc.ArchiveWriter(b"some raw dictionary WARC/1.1 HTTP/1.1 200 OK", first=warc.info("0-0", "2000-01-01T00:00:00Z"))
    digest = hashlib.sha256(b"<p>x</p>").hexdigest()
    good = warc.record(1, "http://a.b/c d\r\nX: y", digest, b"<p>x</p>", None, "2000-01-01T00:00:00Z")
    writer.add(good)
    writer.add(warc.record(2, None, digest, b"<p>x</p>", 1, "2000-01-01T00:00:00Z"))
    about, one, two = [warc.parse(r) for r in warc.read_frames(writer.bytes())]
    assert about["record_type"] == "warcinfo" and about["page_id"] is None
    assert (one["page_id"], one["payload"], one["url"]) == (1, b"<p>x</p>", "http://a.b/c%20d%0D%0AX:%20y")
    assert (two["record_type"], two["refers_to"], two["payload_bytes"], two["payload"]) == ("revisit", 1, 8, None)
    for bad in (good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"Content-Length: 8", b"Content-Length: 9"), good[:-5], good.replace(b"<p>x", b"<p>y"), good.replace(b"WARC-Date", b"WARC-Dote")):
        with pytest.raises(ValueError):
            warc.parse(bad)
    with pytest.raises(ValueError):
        list(warc.read_frames(writer.bytes()[:-3]))


def test_topk_ties_and_odd_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100, [float("nan"), 1.0]), (120, None), (140, [None, 1.0]), (160, [2.0]), (180, [-1.0, 5.0]), (None, [1.0, 1.0]), (20, [0.5, 0.5])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 20 == 0, k=3).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(by) == {0, 20, 40, 160, 180}
    assert by[0] == [(160, 8192), (1, 4096), (2, 4096)] and by[160][0] == (0, 8192)
