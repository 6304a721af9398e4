"""The source audit, SimHash and tokenizer alignment against brute force, and their edge cases."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
import xxhash
from conftest import SF, TINY
from oracle import compare
from tokenizers import Tokenizer

from firmlens.llm import alignment, divergence, queries, simhash

ODD = [
    (1, None, "en", None), (2, "", None, "s"), (3, " \t\n\x0b", "en", "s"), (4, "One two", "en", "s"), (4, "One two", "en", "s"),
    (None, "one TWO", "en", None), (7, "a  b\n\nc \t d<|endoftext|> <s>\n", "de", "s"), (8, "x▁y and <0x0A>", "de", "t"), (9, "été ﬁ①  日本語 \U0001f600", None, None),
    (10, "\nlead and trail ", "fr", "s"), (11, "word " * 3000, "en", "t"), (12, "y" * 5000, "en", "t"), (13, "a\x00b \x1c c", "fr", "u"),
]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    return df.selectExpr("'x' AS fp", "doc_id", "text", "lang", "source", "1 AS n", "'y' AS term", "2 AS pair")


def table(folder):
    return pq.read_table(f"{folder}/documents.parquet").to_pydict()


# ---------------------------------------------------------------- SimHash

def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_rows(ids, texts):
    fps = [fingerprint(t) for t in texts]
    distinct = sorted(set(fps))
    up = {f: f for f in distinct}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    a = np.array(distinct, np.uint64)
    for i, f in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ np.uint64(f)) <= 2):
            up[root(distinct[i + 1 + j])] = root(f)
    least = {}
    for i, f in zip(ids, fps):
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return collections.Counter((i, f"{f:016x}", least.get(root(f))) for i, f in zip(ids, fps))


@pytest.mark.parametrize("folder", [TINY, SF])
def test_op12_brute_force(spark, folder):
    got = queries.QUERIES["op12_simhash_dedup"](spark, folder).collect()
    d = table(folder)
    assert collections.Counter(map(tuple, got)) == simhash_rows(d["doc_id"], d["text"])


def test_simhash_odd_rows(odd):
    got = simhash.simhash_dedup(odd).collect()
    assert collections.Counter(map(tuple, got)) == simhash_rows([r[0] for r in ODD], [r[1] for r in ODD])
    assert not simhash.simhash_dedup(odd.limit(0)).count()


def test_shingles_of_long_texts_in_pieces(monkeypatch):
    text = "  Aa bb\tcc  dd ee\nff gg  ".encode()
    want = np.concatenate(list(simhash.shingle_hashes(text)))
    for piece in range(1, 30):
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert (np.concatenate(list(simhash.shingle_hashes(text))) == want).all()
        assert [len(list(simhash.shingle_hashes(t))) for t in (b"", b" \n ", b"one  two ")] == [0, 0, 1]


def near_pairs(rng, n):
    """Random fingerprints, with families a few bits apart."""
    out = set()
    while len(out) < n:
        f = rng.getrandbits(64)
        out.add(f)
        for _ in range(rng.randint(0, 12)):
            for b in rng.sample(range(64), rng.randint(1, 3)):
                f ^= 1 << b
            out.add(f)
    return sorted(out)


def test_gray_index_finds_what_comparing_all_finds():
    rng = random.Random(3)
    for n in (1, 2, 9, 300, 1500):
        fps = np.array(near_pairs(rng, n), np.uint64)
        bucket = np.sort(np.array([rng.randint(0, 3) for _ in fps]))
        order = np.lexsort((simhash.gray_rank(fps), bucket))
        fps, bucket = fps[order], bucket[order]
        index = simhash.GrayIndex(fps, bucket)
        roots = np.unique(bucket, return_inverse=True)[1]
        q, place = index.search(fps, roots)
        want = {(i, j) for i in range(len(fps)) for j in np.flatnonzero((np.bitwise_count(fps ^ fps[i]) <= 2) & (bucket == bucket[i])).tolist()}
        assert set(zip(q.tolist(), place.tolist())) == want
        label = index.link_labels()
        assert all(label[i] == label[j] for i, j in want) and (label <= np.arange(len(fps))).all()


@pytest.mark.parametrize("bucket", [1 << 16, 40])
def test_links_in_split_buckets(spark, bucket):
    rng = random.Random(8)
    base = rng.getrandbits(64)
    fps = set(near_pairs(rng, 200)) | {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(600)}
    df = spark.createDataFrame([(simhash.signed(f),) for f in sorted(fps)], "fp long")
    edges = [(a % 2**64, b % 2**64) for a, b in simhash.fingerprint_links(df, bucket).collect()]
    rows = simhash.components(spark.createDataFrame([(simhash.signed(a), simhash.signed(b)) for a, b in edges], "a long, b long")).collect()
    label = {r[0] % 2**64: r[1] for r in rows}
    up, all_fps = {}, np.array(sorted(fps), np.uint64)
    todo = {int(f) for f in all_fps}
    while todo:  # components by breadth-first search
        front = [todo.pop()]
        own = set(front)
        while front:
            f = front.pop()
            near = {int(x) for x in all_fps[np.bitwise_count(all_fps ^ np.uint64(f)) <= 2]} - own
            own |= near
            front += near
        todo -= own
        assert len({label.get(f, f) for f in own}) == 1, len(own)
        up.update(dict.fromkeys(own, min(own)))
    assert len({label.get(f, simhash.signed(f)) for f in fps}) == len(set(up.values()))


# ---------------------------------------------------------------- source audit

def audit_rows(rows):
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), lang or "", s or "") for _, t, lang, s in rows]
    out = []
    for lang in {x[1] for x in docs}:
        own = [x for x in docs if x[1] == lang]
        df = collections.Counter(t for x in own for t in set(x[0]))
        kept = sorted(t for t in df if df[t] >= divergence.LEAST_DOCS)
        count = {s: collections.Counter(t for x in own if x[2] == s for t in x[0] if t in set(kept)) for s in {x[2] for x in own}}
        whole = sum(count.values(), collections.Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s, c in count.items():
            pair = [(o, sum(f(share(c, t), share(d, t)) for t in kept)) for o, d in count.items() if o != s]
            term = [(t, f(share(c, t), share(whole, t))) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, items, most in (("pair", pair, None), ("term", term, 10)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, i, v, r + 1) for r, (i, v) in enumerate(ranked)]
    return collections.Counter(out)


def test_op11_sql(spark):
    assert compare(spark, TINY, queries.QUERIES["op11_divergence_audit"], queries.ORACLE_SQL["op11_divergence_audit"]) > 100


@pytest.mark.parametrize("sources, terms, block", [(64, 2048, 32 << 20), (2, 3, 2000)])
def test_audit_in_many_tiles(spark, monkeypatch, sources, terms, block):
    for k, v in (("SOURCES", sources), ("TERMS", terms), ("BLOCK", block), ("BROADCAST", 4 << 20 if sources > 2 else -1)):
        monkeypatch.setattr(divergence, k, v)
    rng = random.Random(4)
    vocabulary = [f"{'Äbc'[k % 3]}w{'xyz'[k % 3]}" + "q" * (k // 3) for k in range(40)]
    rows = [(i, " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(40)], k=rng.randint(0, 30))), rng.choice(["en", "de"]), rng.choice(["a", "b", "c", "d", "e", None])) for i in range(200)]
    rows += ODD
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    assert collections.Counter(map(tuple, divergence.audit_sources(df).collect())) == audit_rows(rows)


def test_audit_odd_rows(odd):
    assert collections.Counter(map(tuple, divergence.audit_sources(odd).collect())) == audit_rows(ODD)
    assert not divergence.audit_sources(odd.limit(0)).count()


def test_shares_are_exact():
    rng = random.Random(1)
    for _ in range(300):
        total, v = rng.randint(0, 8 * 10**15), rng.randint(1, 10**9)
        c = rng.randint(0, total)
        assert int(divergence.shares(np.array([c]), np.array([total]), v)[0]) == 1 + 10**9 * (c + 2) // (total + 2 * v)


# ---------------------------------------------------------------- tokenizer alignment

def alignment_rows(ids, texts):
    """Both libraries on whole texts; groups by equal ends."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    code = {c: i for i, c in enumerate(alignment.byte_alphabet())}
    docs = []
    for text in texts:
        groups = []
        if text:
            a = t.encode(" " + text, add_special_tokens=False).ids
            b = m.encode(text)
            ab = [bytes(code[c] for c in t.id_to_token(i)) for i in a]
            bb = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(ab) == b"".join(bb) == b" " + text.encode():
                ends = [dict(zip(np.cumsum(list(map(len, x))).tolist(), range(len(x)))) for x in (ab, bb)]
                i = j = 0
                for end in sorted(ends[0].keys() & ends[1].keys()):
                    groups.append((a[i : ends[0][end] + 1], b[j : ends[1][end] + 1]))
                    i, j = ends[0][end] + 1, ends[1][end] + 1
        docs.append(groups)
    held = collections.Counter(p for g in docs for p in {(x, y) for a, b in g for x in a for y in b})
    most = collections.defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for i, groups in zip(ids, docs):
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return collections.Counter(out)


@pytest.mark.parametrize("folder", [TINY, SF])
def test_op13_brute_force(spark, folder):
    got = queries.QUERIES["op13_tokenizer_alignment"](spark, folder).collect()
    d = table(folder)
    assert collections.Counter(map(tuple, got)) == alignment_rows(d["doc_id"], d["text"])


def both_files():
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_alignment_odd_rows(spark, odd, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 100)
    pairs, docs = alignment.align_documents(odd, *both_files())
    assert collections.Counter(map(tuple, docs.collect())) == alignment_rows([r[0] for r in ODD], [r[1] for r in ODD])
    assert not pairs.groupBy("a_id").agg({"best": "max"}).where("NOT `max(best)`").count()
    assert not alignment.align_documents(odd.limit(0), *both_files())[1].count()
    groups = {r.doc_id: r.groups for r in alignment.token_groups(odd.where("doc_id IN (4, 8)").dropDuplicates(["doc_id"]), *both_files()).collect()}
    assert groups[8] == [] and [len(g.a) for g in groups[4]] == [1, 1]


def test_units_are_read_as_whole_texts_are():
    both = alignment.Aligner(*both_files())
    rng = random.Random(6)
    letters = ["a", "B", "é", "'s", "9", ".", " ", "  ", "\n", "\n ", "\t", " ", "\x1c", "日", "▁", "<|endoftext|>", "\r\n", " ", "don't", "\x00"]
    for _ in range(400):
        text = "".join(rng.choices(letters, k=rng.randint(1, 14)))
        got = both.align(both.units(text))
        own = ";".join(got.groups) if got.good.all() else ""
        want = next(iter(alignment_rows([1], [text])))
        assert (hashlib.sha256(own.encode()).hexdigest() if own else "") == want[-1], repr(text)


def test_overlap_groups():
    left, right = alignment.overlap_groups(np.array([1, 3, 6, 7]), np.array([2, 3, 7]))
    assert left.tolist() == [0, 0, 1, 1] and right.tolist() == [0, 0, 1]
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 40)
        a, b = (sorted({n, *rng.sample(range(1, n + 1), rng.randint(0, n - 1) // k)}) for k in (1, 3))
        common = sorted(set(a) & set(b))
        left, right = alignment.overlap_groups(np.array(a), np.array(b))
        assert left.tolist() == np.searchsorted(common, a).tolist() and right.tolist() == np.searchsorted(common, b).tolist()


@pytest.mark.parametrize("many", [1 << 12, 2])
def test_links_of_large_groups(monkeypatch, many):
    monkeypatch.setattr(alignment, "MANY", many)
    a, b, of_a, of_b = np.array([5, 5, 6, 7, 5]), np.array([1, 2, 2, 9]), np.array([0, 0, 0, 1, 2]), np.array([0, 0, 1, 2])
    got = collections.Counter()
    for p, n, g in zip(*alignment.bipartite(a, b, of_a, of_b)):
        got[int(p) >> 32, int(p) & 0xFFFFFFFF, int(g)] += int(n)
    assert got == {(5, 1, 0): 2, (5, 2, 0): 2, (6, 1, 0): 1, (6, 2, 0): 1, (7, 2, 1): 1, (5, 9, 2): 1}


def test_aligner_refuses_other_files():
    with pytest.raises(ValueError, match="byte-level"):
        alignment.Aligner(public_tokenizers.path("word_bpe_49k.json"), both_files()[1])
