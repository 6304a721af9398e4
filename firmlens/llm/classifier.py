"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text, by sharded count joins,
with the words of rejected text and repeats."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import CACHES, batches_of, in_order, text_size, enter, find_package, get_file, materialize, new_folder, parallelism, put_file, release_memory, release_shuffles, text_bytes, word_hashes
from firmlens.llm.near_dedup import hinted
from firmlens.llm.suffix_dedup import NULL_ID, pack, unpack

#: Words are hashed into 2 ** VOCAB_BITS - 1 numbers, so tables over words have a fixed size; number 0 is a text's start.
VOCAB_BITS = 21
KEY_BITS = 2 * VOCAB_BITS
#: Text bytes of a block: a pair that its documents hold is asked for once.
BLOCK_BYTES = 12 << 20
#: Text bytes for a shard of pairs; a shard's asks are counted in one task's memory.
SHARD_BYTES = 8 << 20
#: Entries (pair, document) of a block that are judged at a time.
PART_ENTRIES = 1 << 18
#: Ranges of word numbers in which the lower orders are summed.
RANGES = 64
RANGE = (1 << VOCAB_BITS) // RANGES
#: Of ten labelled documents two are held out of the counts; they give the limits.
HELD_OUT = 2
#: What a labelled document is, as its fold: trusted, junk (quality 0) or toxic, counted or held out.
TRUSTED, TRUSTED_HELD, JUNK, JUNK_HELD, TOXIC, TOXIC_HELD = 1, 2, 3, 4, 5, 6
#: Quantiles of held-out trusted text that may be limits; QUANTILE is the limit of perplexity, and the last the others',
#: where no rejected text is held out. Held-out documents that a language needs for a median and quantiles of its own.
LEVELS, QUANTILE, LEAST_HELD = (0.9, 0.95, 0.97, 0.98, 0.99, 0.995, 1.0), 0.95, 20
#: Standard deviations by which a word's log odds of rejected to trusted documents are lowered: few sightings prove little.
SURE = 2.0
#: Labelled ids that may be broadcast (16 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_MASK = np.uint64((1 << KEY_BITS) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15 & ((1 << KEY_BITS) - 1) | 1)
_ODD_INV = np.uint64(pow(int(_ODD), -1, 1 << KEY_BITS))


def scramble(pair: np.ndarray) -> np.ndarray:
    """A bijection of KEY_BITS-bit numbers that spreads pairs evenly over the range, so that shards are ranges."""
    x = pair * _ODD
    x &= _MASK
    x ^= x >> np.uint64(VOCAB_BITS)
    x *= _ODD
    x &= _MASK
    return x


def restore(key: np.ndarray) -> np.ndarray:
    x = (key * _ODD_INV) & _MASK
    x ^= x >> np.uint64(VOCAB_BITS)
    return (x * _ODD_INV) & _MASK


def shard_cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    return np.searchsorted(keys, ((np.arange(shards + 1, dtype=object) << KEY_BITS) // shards).astype(np.uint64))


def word_numbers(hashes: np.ndarray) -> np.ndarray:
    return np.maximum(hashes >> np.uint64(64 - VOCAB_BITS), np.uint64(1)).astype(np.uint32)


def text_words(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of texts that stand end to end, and n + 1 offsets."""
    hashes, at = word_hashes(body, offsets)
    return word_numbers(hashes), at


def pairs(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Scrambled (word before, word) of each word; the first of a text has the start mark before it."""
    before = np.concatenate([np.zeros(1, np.uint32), words[:-1]]) if len(words) else words
    before[at[:-1][np.diff(at) > 0]] = 0
    both = before.astype(np.uint64)
    both <<= np.uint64(VOCAB_BITS)
    both |= words
    return scramble(both)


def pair_table(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (pair, document) of a block in order: the distinct pairs, and per entry pair number, document, times.
    counts: words of each document; a block has fewer than 2 ** (64 - KEY_BITS) documents. keys are used up."""
    keys <<= np.uint64(64 - KEY_BITS)
    at = 0
    for i, n in enumerate(counts.tolist()):
        keys[at : at + n] |= np.uint64(i)
        at += n
    keys.sort()
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    new = np.flatnonzero(new).astype(np.int32)
    times = np.empty(len(new), np.int32)
    np.subtract(new[1:], new[:-1], out=times[:-1])
    times[-1:] = len(keys) - new[-1:]
    both = keys[new]
    del new
    doc = np.empty(len(both), np.int32)
    np.bitwise_and(both, np.uint64((1 << (64 - KEY_BITS)) - 1), out=doc, casting="unsafe")
    both >>= np.uint64(64 - KEY_BITS)
    head = np.concatenate([[True], both[1:] != both[:-1]]) if len(both) else np.zeros(0, bool)
    both = both[head]
    return both, np.cumsum(head, dtype=np.int32) - np.int32(1), doc, times


def planes(x: np.ndarray, bits: int = KEY_BITS) -> list[np.ndarray]:
    """Numbers of so many bits as byte planes: the random low bytes stay as they are, the others pack to little."""
    return [(x >> x.dtype.type(k)).astype("u1") for k in range(0, bits, 8)]


def from_planes(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for k, part in enumerate(parts):
        out |= part.astype(np.uint64) << np.uint64(8 * k)
    return out


def fold_words(words: np.ndarray) -> list[np.ndarray]:
    """The words by rank of frequency, as byte planes of their differences, and each word's rank in three byte planes."""
    unique, inverse, n = np.unique(words, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(unique), np.uint32)
    rank[order] = np.arange(len(unique), dtype=np.uint32)
    r = rank[inverse]
    listed = unique[order].astype(np.uint32)  # equally frequent words stand in order, so differences are small
    return [*planes(np.diff(listed, prepend=np.zeros(1, np.uint32)), 32), r.astype("u1"), (r >> 8).astype("u1"), (r >> 16).astype("u1")]


def unfold_words(*parts: np.ndarray) -> np.ndarray:
    *listed, low, mid, high = parts
    unique = np.cumsum(from_planes(listed).astype(np.uint32), dtype=np.uint32)
    return unique[low.astype(np.int32) | mid.astype(np.int32) << 8 | high.astype(np.int32) << 16]


# ---------------------------------------------------------------- words of rejected text

def document_words(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (word, document) in order of words."""
    order = np.argsort(words, kind="stable")
    doc = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))[order]
    words = words[order]
    head = np.concatenate([[True], (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])]) if len(words) else np.zeros(0, bool)
    return words[head], doc[head]


def log_odds(rejected: np.ndarray, trusted: np.ndarray, documents: tuple[int, int]) -> np.ndarray:
    """Log odds of words by the rejected and trusted documents that hold them, lowered by SURE standard deviations."""
    a, b = rejected + 0.5, trusted + 0.5
    return np.log(a / b) + np.log((documents[1] + 1) / (documents[0] + 1)) - SURE * np.sqrt(1 / a + 1 / b)


def rejected_words(docs: DataFrame, folder: str, shards: int) -> list[str]:
    """Files of the words (64-bit hashes) that speak for rejected text, with their log odds, from docs(text, fold) of all
    counted labelled documents: each block's distinct words meet in shards of hashes, a file a shard."""
    number = {r["fold"]: r["n"] for r in docs.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    documents = number.get(JUNK, 0) + number.get(TOXIC, 0), number.get(TRUSTED, 0)
    if not documents[0]:
        return []
    ends = ((np.arange(1, shards, dtype=object) << 64) // shards).astype(np.uint64)

    def run(frames):
        enter("classifier")
        held, size = [], 0

        def close():
            words, at = np.concatenate([h[0] for h in held]), np.concatenate([[0], np.cumsum(np.concatenate([h[1] for h in held]))])
            words, doc = document_words(words, at)
            trusted = np.concatenate([h[2] for h in held])[doc] == TRUSTED
            unique, number = np.unique(words, return_inverse=True)
            a, b = (np.bincount(number, x, len(unique)).astype("<u4") for x in (~trusted, trusted))
            cuts = np.concatenate([[0], np.searchsorted(unique, ends), [len(unique)]])
            some = [i for i in range(shards) if cuts[i] < cuts[i + 1]]
            shares = [pack(*planes(np.diff(unique[i:j], prepend=np.zeros(1, np.uint64)), 64), a[i:j], b[i:j]) for i, j in zip(cuts[some], cuts[np.array(some, int) + 1])]
            release_memory()
            return pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(shares, pa.binary())], names=["shard", "words"])

        for frame in batches_of(frames, BLOCK_BYTES // 8):
            body, offsets = text_bytes(frame.column(0))
            words, at = word_hashes(body, offsets)
            held.append((words, np.diff(at), frame.column(1).to_numpy(zero_copy_only=False)))
            size += len(body)
            if size >= BLOCK_BYTES:
                yield close()
                held, size = [], 0
        if held:
            yield close()

    def add(part: pd.DataFrame) -> pd.DataFrame:
        enter("classifier")
        got = [unpack(raw, *["u1"] * 8, "<u4", "<u4") for raw in part["words"]]
        words, number = np.unique(np.concatenate([np.cumsum(from_planes(g[:8]), dtype=np.uint64) for g in got]), return_inverse=True)
        a, b = (np.bincount(number, np.concatenate([g[k] for g in got]), len(words)) for k in (8, 9))
        odds = log_odds(a, b, documents)
        more = (a > 0) & (odds > 0)
        body = pack(words[more], odds[more])
        name = hashlib.sha256(body).hexdigest()[:24]
        put_file(folder, name, body)
        release_memory()
        return pd.DataFrame({"name": [name]})

    shares = docs.select("text", "fold").mapInArrow(run, "shard long, words binary")
    return sorted({r["name"] for r in shares.groupBy("shard").applyInPandas(add, "name string").collect()})


def word_odds(words: np.ndarray, at: np.ndarray, folder: str, names: list[str]) -> np.ndarray:
    """Per text the largest log odds of its words, 0 if none speaks for rejected text. A file is read at a time."""
    out = np.zeros(len(at) - 1)
    if not len(words):
        return out
    unique, doc = document_words(words, at)
    for name in names:
        known, odds = unpack(get_file(folder, name), "<u8", "<f8")
        if len(known):
            i, j = np.searchsorted(unique, known[0]), np.searchsorted(unique, known[-1], side="right")
            k = np.minimum(np.searchsorted(known, unique[i:j]), len(known) - 1)
            same = known[k] == unique[i:j]
            np.maximum.at(out, doc[i:j][same], odds[k[same]])
    return out


# ---------------------------------------------------------------- blocks

BLOCK_KINDS = ("<i8", "<i4", "i1", "<f8", "u1", *["u1"] * 7)


def write_blocks(docs: DataFrame, folder: str, shards: int, names: list[str]) -> DataFrame:
    """docs(doc_id, text, lang, fold) into block files, with the documents' ids, folds, word odds, languages and words; a table of
    (block, shard, asks), to be read once: the block's distinct pairs and how often its training documents hold each."""

    def run(frames):
        enter("classifier")
        held, size, docs_held = [], 0, 0

        def close():
            ids, folds = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            langs = [x for h in held for x in h[2]]
            hashes, counts = np.concatenate([h[3] for h in held]), np.concatenate([h[4] for h in held])
            held.clear()
            at = np.concatenate([[0], np.cumsum(counts)])
            odds, words = word_odds(hashes, at, folder, names), word_numbers(hashes)
            del hashes
            tags = np.frombuffer("\n".join("" if x is None else "=" + x for x in langs).encode(), np.uint8)
            body = pack(ids.astype("<i8"), counts.astype("<i4"), folds.astype("i1"), odds, tags, *fold_words(words))
            block = hashlib.sha256(body).hexdigest()[:24]
            put_file(folder, block, body)
            del body
            unique, number, doc, times = pair_table(pairs(words, at), counts)
            mine = folds[doc] == TRUSTED
            learned = np.bincount(number[mine], times[mine], len(unique)).astype("<u4") if len(unique) else np.zeros(0, "<u4")
            del words, number, doc, times, mine
            cuts = shard_cuts(unique, shards)
            some = [s for s in range(shards) if s == 0 or cuts[s] < cuts[s + 1]]  # at least one row names the block
            asks = []
            for s in some:
                keys = unique[cuts[s] : cuts[s + 1]]
                asks.append(pack(*planes(np.diff(keys, prepend=np.zeros(1, np.uint64))), learned[cuts[s] : cuts[s + 1]]))
            release_memory()
            return pa.RecordBatch.from_arrays([pa.array([block] * len(some)), pa.array(some, pa.int64()), pa.array(asks, pa.binary())], names=["block", "shard", "asks"])

        for frame in batches_of(frames, BLOCK_BYTES // 8):
            body, offsets = text_bytes(frame.column(1))
            words, at = word_hashes(body, offsets)
            held.append((frame.column(0).to_numpy(zero_copy_only=False), frame.column(3).to_numpy(zero_copy_only=False), frame.column(2).to_pylist(), words, np.diff(at)))
            size, docs_held = size + len(body), docs_held + frame.num_rows
            if size >= BLOCK_BYTES or docs_held >= 1 << 19:
                yield close()
                held, size, docs_held = [], 0, 0
        if held:
            yield close()

    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), "text", "lang", F.coalesce("fold", F.lit(0)).cast("int").alias("fold"))
    return in_order(d).mapInArrow(run, "block string, shard long, asks binary")


# ---------------------------------------------------------------- the model

def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the numbers of counts 1 to 4; safe for few counts."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), d, strict=True))


def discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def count_shards(blocks: DataFrame) -> DataFrame:
    """Counts joined to asks per shard: a written table of (block, shard, answer, words). A row with a block has the
    training count of each pair it asked for; rows without one have a shard's share of what the lower orders need of a
    range of words, whose number stands as shard."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        enter("classifier")
        got = [unpack(raw, *["u1"] * -(-KEY_BITS // 8), "<u4") for raw in part["asks"]]
        asked = [np.cumsum(from_planes(g[:-1]), dtype=np.uint64) for g in got]
        keys, number = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, number, np.concatenate([g[-1] for g in got]))
        back = np.split(counts[number].astype("<u4"), np.cumsum([len(a) for a in asked])[:-1])
        keys, counts = keys[counts > 0], counts[counts > 0]
        pair = restore(keys)
        before, word = (pair >> np.uint64(VOCAB_BITS)).astype(np.int64), (pair & np.uint64((1 << VOCAB_BITS) - 1)).astype(np.int64)
        b, at = np.unique(before, return_inverse=True)
        stats = [np.bincount(at, w, len(b)).astype("<u4") for w in (counts, counts == 1, counts == 2, counts >= 3)]
        w, into = np.unique(word, return_counts=True)
        of = np.bincount(np.minimum(counts, 5), minlength=6)[1:5].astype("<i8")
        b_cuts, w_cuts = (np.searchsorted(x, np.arange(RANGES + 1) * RANGE) for x in (b, w))
        rows = [*zip(part["block"], part["shard"], [pack(x) for x in back], [None] * len(part), strict=True)]
        for r in range(RANGES):
            i, j = slice(b_cuts[r], b_cuts[r + 1]), slice(w_cuts[r], w_cuts[r + 1])
            if r == 0 or i.start < i.stop or j.start < j.stop:
                ids = [np.diff((x % RANGE).astype("<u2"), prepend=np.zeros(1, "<u2")) for x in (b[i], w[j])]
                rows.append((None, r, None, pack(ids[0], *[x[i] for x in stats], ids[1], into[j].astype("<u4"), of if r == 0 else of[:0])))
        release_memory()
        return pd.DataFrame(rows, columns=["block", "shard", "answer", "words"])

    return materialize(blocks.groupBy("shard").applyInPandas(run, "block string, shard long, answer binary, words binary"), "counts")


def lower_orders(counted: DataFrame, folder: str) -> tuple:
    """Files of tables over the word numbers, one a range: count as context, sum of the discounts of a context's pairs, number
    of words that a word follows. Returned: the files' names, the discounts of pairs and of continuations, the number of
    distinct pairs and the sum of the discounts of continuations. Shards' shares are summed by ranges of words in tasks;
    the driver gets a few numbers a range."""

    def merged(part: pd.DataFrame):
        tables = np.zeros((5, RANGE), np.int64)
        of = np.zeros(4, np.int64)
        for raw in part["words"]:
            b, *stats, w, n, o = unpack(raw, "<u2", "<u4", "<u4", "<u4", "<u4", "<u2", "<u4", "<i8")
            b, w = (np.cumsum(x, dtype=np.uint16) for x in (b, w))
            for table, x in zip(tables, stats):
                table[b] += x
            tables[4][w] += n
            of += o if len(o) else 0
        return tables, of

    def add(part: pd.DataFrame) -> pd.DataFrame:
        enter("classifier")
        tables, of = merged(part)
        body = pack(tables.astype("<i8"))
        name = hashlib.sha256(body).hexdigest()[:24]
        put_file(folder, name, body)
        into = np.bincount(np.minimum(tables[4], 5), minlength=6)[1:5]
        twos = np.bincount(np.minimum(tables[4], 3), tables[4], 4)
        return pd.DataFrame({"range": [int(part["shard"].iloc[0])], "name": [name], "of": [of.tolist()], "into": [into.tolist()], "three": [int((tables[4] >= 3).sum())], "kinds": [int(twos.sum())]})

    shares = counted.where(F.col("words").isNotNull()).select("shard", "words")
    rows = shares.groupBy("shard").applyInPandas(add, "range int, name string, of array<long>, into array<long>, three long, kinds long").collect()
    d2, d1 = (discounts(*(sum(r[c][k] for r in rows) for k in range(4))) for c in ("of", "into"))
    ones, twos, three = sum(r["into"][0] for r in rows), sum(r["into"][1] for r in rows), sum(r["three"] for r in rows)
    return {r["range"]: r["name"] for r in rows}, d2, d1, sum(r["kinds"] for r in rows), d1[0] * ones + d1[1] * twos + d1[2] * three


_TABLES: dict[tuple, tuple] = {}
CACHES.append(_TABLES)


def load_tables(folder: str, names: dict[int, str], d2: tuple[float, float, float]) -> tuple:
    """Count as context, sum of its pairs' discounts and number of words before, by word number; kept by a worker process."""
    key = folder, *sorted(names.items())
    if key not in _TABLES:
        _TABLES.clear()
        total, gamma, into = np.zeros(1 << VOCAB_BITS, "f4"), np.zeros(1 << VOCAB_BITS, "f4"), np.zeros(1 << VOCAB_BITS, "u4")
        for r, name in names.items():
            t, ones, twos, more, n = unpack(get_file(folder, name), "<i8")[0].reshape(5, RANGE)
            own = slice(r * RANGE, (r + 1) * RANGE)
            total[own], gamma[own], into[own] = t, d2[0] * ones + d2[1] * twos + d2[2] * more, n
        _TABLES[key] = total, gamma, into
    return _TABLES[key]


def sums_by(keys: np.ndarray, *values: np.ndarray) -> tuple:
    """Sums of values over equal keys: the place of each key among the distinct ones, and the sums by place."""
    _, at = np.unique(keys, return_inverse=True)
    return at, *[np.bincount(at, v) for v in values]


def pair_probability(c, total, gamma, into, model) -> np.ndarray:
    """Of pairs: count, context's count and sum of discounts, words before; model: see lower_orders."""
    d2, d1, kinds, rest = model
    single = (into - discount(into, d1)) / np.maximum(kinds, 1) + (rest / np.maximum(kinds, 1) if np.any(kinds) else 1.0) / ((1 << VOCAB_BITS) - 1)
    return np.where(total > 0, (c - discount(c, d2) + gamma * single) / np.maximum(total, 1), single)


def log_probabilities(keys, number, doc, times, counts, trusted, tables, model) -> np.ndarray:
    """Natural log of the probability of each document, from its entries (pair number, document, times). Documents that
    the counts hold (trusted) are judged as if they had never been counted: their own pairs are taken out of the pair
    counts, of the contexts and of the continuations; the discounts stay."""
    total, gamma, into = tables
    d2, d1, kinds, rest = model
    pair = restore(keys)
    before, word = (pair >> np.uint64(VOCAB_BITS)).astype(np.int64), (pair & np.uint64((1 << VOCAB_BITS) - 1)).astype(np.int64)
    logs = np.log(pair_probability(counts, total[before].astype("f8"), gamma[before].astype("f8"), into[word].astype("i8"), model)) if len(keys) else np.zeros(0)
    out = np.zeros(len(trusted))
    ends = np.cumsum(np.bincount(doc, minlength=len(trusted))) // PART_ENTRIES  # documents in parts: what is held at a time is bounded
    low = 0
    while low < len(trusted):
        high = int(np.searchsorted(ends, ends[low], side="right"))
        some = np.flatnonzero((doc >= low) & (doc < high)) if high - low < len(trusted) else slice(None)
        out[low:high] = _part(number[some], doc[some] - low, times[some], logs, counts, before, word, trusted[low:high], tables, model)
        low = high
    return out


def _part(number, doc, times, logs, counts, before, word, trusted, tables, model) -> np.ndarray:
    """log_probabilities of some documents that stand together."""
    total, gamma, into = tables
    d2, d1, kinds, rest = model
    mine = trusted[doc]
    n_docs = len(trusted)
    out = np.bincount(doc[~mine], logs[number[~mine]] * times[~mine], n_docs).astype(float)  # of nothing it gives integers
    if mine.any():
        number, doc, times = number[mine], doc[mine], times[mine].astype(np.int64)
        c, v, w = counts[number], before[number], word[number]
        left = c - times
        at, gone, more = sums_by(doc.astype(np.int64) << VOCAB_BITS | v, times, discount(left, d2) - discount(c, d2))
        context, weight = total[v].astype("f8") - gone[at], gamma[v] + more[at]
        at, vanished = sums_by(doc.astype(np.int64) << VOCAB_BITS | w, left == 0)
        into_all = into[w].astype("i8")
        into_left = into_all - vanished[at].astype(np.int64)
        first = np.zeros(len(vanished), np.int64)
        first[at] = np.arange(len(at))  # an entry for each (document, word)
        change = np.bincount(doc[first], (discount(into_left, d1) - discount(into_all, d1))[first], n_docs)
        lost = np.bincount(doc, left == 0, n_docs)
        model = d2, d1, (kinds - lost)[doc], (rest + change)[doc]
        p = pair_probability(left, context, weight, into_left, model)
        out += np.bincount(doc, np.log(p) * times, n_docs)
    return out


def score_blocks(counted: DataFrame, folder: str, lower: tuple) -> DataFrame:
    """Per document: doc_id, lang, fold, n_words, log_prob (natural), repeats (the share of words whose pair stood before in
    the document) and odds, from each block's file, the counts it asked for and the tables of the lower orders."""
    files, *model = lower

    def gather(part: pd.DataFrame) -> pd.DataFrame:
        enter("classifier")
        tables = load_tables(folder, files, model[0])
        ids, n, folds, odds, langs, *folded = unpack(get_file(folder, part["block"].iloc[0]), *BLOCK_KINDS)
        words = unfold_words(*folded)
        del folded
        keys, number, doc, times = pair_table(pairs(words, np.concatenate([[0], np.cumsum(n)])), n)
        del words
        counts = np.concatenate([unpack(raw, "<u4")[0] for raw in part.sort_values("shard")["answer"]]).astype(np.int64)
        logs = log_probabilities(keys, number, doc, times, counts, folds == TRUSTED, tables, model)
        repeats = 1 - np.bincount(doc, minlength=len(ids)) / np.maximum(n, 1)
        names = [x[1:] if x else None for x in langs.tobytes().decode().split("\n")]
        release_memory()
        return pd.DataFrame({"doc_id": pd.array([None if i == NULL_ID else i for i in ids.tolist()], "Int64"), "lang": names, "fold": folds.astype("int32"), "n_words": n.astype("int64"), "log_prob": logs, "repeats": repeats, "odds": odds})

    # answers are small, the blocks behind them aren't: a fixed number of partitions keeps them from being put together
    answers = counted.where(F.col("block").isNotNull()).select("block", "shard", "answer").repartition(parallelism(counted.sparkSession), "block")
    return materialize(answers.groupBy("block").applyInPandas(gather, "doc_id long, lang string, fold int, n_words long, log_prob double, repeats double, odds double"), "scored")


def fit_levels(held: DataFrame, limits: dict[str, Column]) -> dict[str, int]:
    """Which of LEVELS is the limit of each measure, by arrays of the measures' quantiles at LEVELS over held-out trusted text:
    those that together keep most of the held-out trusted documents less the mean share kept of the held-out kinds of
    rejected ones. The driver gets one row for each kind and combination of quantiles passed."""
    measures = list(limits)
    passed = [sum((F.col(m) > F.get(q, F.lit(k))).cast("int") for k in range(len(LEVELS))).alias(m) for m, q in limits.items()]
    rows = held.select("fold", *passed).groupBy("fold", *measures).agg(F.count(F.lit(1)).alias("n")).collect()
    number = {f: np.zeros([len(LEVELS) + 1] * len(measures)) for f in {r["fold"] for r in rows}}
    for r in rows:
        number[r["fold"]][tuple(r[m] for m in measures)] += r["n"]
    kept = {}
    for f, x in number.items():
        for axis in range(len(measures)):
            x = x.cumsum(axis)
        kept[f] = x / x.flat[-1]
    rejected = [x for f, x in kept.items() if f != TRUSTED_HELD]
    if not rejected:
        best = [LEVELS.index(QUANTILE)] + [len(LEVELS) - 1] * (len(measures) - 1)
    else:
        gain = kept[TRUSTED_HELD] - sum(rejected) / len(rejected)
        best = max(itertools.product(range(len(LEVELS)), repeat=len(measures)), key=lambda k: (gain[k], k))
    return dict(zip(measures, best, strict=True))


def judge(scored: DataFrame) -> DataFrame:
    """Threshold and verdict of scored documents, from the held-out ones among them."""
    scored = scored.withColumn("perplexity", F.when(F.col("n_words") > 0, F.exp(-F.col("log_prob") / F.col("n_words"))))
    short = 1 / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))  # a mean over n words scatters so
    held = scored.where(F.col("fold").isin(TRUSTED_HELD, JUNK_HELD, TOXIC_HELD) & F.col("perplexity").isNotNull())
    trusted = held.where(F.col("fold") == TRUSTED_HELD)
    middle = F.percentile_approx(F.log("perplexity"), 0.5, 10_000).alias("own")
    overall = trusted.agg(middle).first()["own"]
    if overall is None:
        return scored.withColumns({"threshold": F.lit(float("inf")), "kept": F.col("perplexity").isNotNull()})
    of_lang = lambda df, *c: df.groupBy(F.col("lang").alias("_lang")).agg(*c, F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_HELD).drop("n")
    medians = hinted(materialize(of_lang(trusted, middle), "medians", 1))

    def centred(df: DataFrame) -> DataFrame:
        return df.join(medians, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang").withColumns({"middle": F.coalesce("own", F.lit(overall)), "short": short}).drop("own")

    off = F.abs(F.log("perplexity") - F.col("middle"))
    fit = centred(trusted).agg(F.regr_slope(off, F.col("short")).alias("slope"), F.regr_intercept(off, F.col("short")).alias("level"), F.avg(off).alias("mean")).first()
    slope, level = (fit["slope"], fit["level"]) if fit["slope"] is not None and fit["slope"] > 0 and fit["level"] > 0 else (0.0, fit["mean"] or 1.0)
    width = F.lit(slope) * F.col("short") + F.lit(level)
    far = ((F.log("perplexity") - F.col("middle")) / width).alias("far")
    if trusted.count() < LEAST_HELD:  # too few to fit: nothing trusted, counted or held out, is dropped
        known = centred(scored.where(F.col("fold").isin(TRUSTED, TRUSTED_HELD) & F.col("perplexity").isNotNull()))
        limit, most_odds, most_repeats = known.select(far, "odds", "repeats").agg(F.max("far"), F.max("odds"), F.max("repeats")).first()
        limited = centred(scored).withColumn("limit", F.lit(limit))
    else:
        sample = centred(trusted).select("lang", far, "odds", "repeats")
        quantiles = lambda m: F.percentile_approx(m, list(LEVELS), 10_000)
        every = sample.agg(*[quantiles(m).alias(m) for m in ("far", "odds", "repeats")]).first()
        given = {m: F.array(*[F.lit(x) for x in every[m]]) for m in ("far", "odds", "repeats")}
        own = hinted(materialize(of_lang(sample, quantiles("far").alias("limits")), "quantiles", 1))
        with_limits = lambda df: centred(df).join(own, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang").withColumn("limits", F.coalesce("limits", given["far"]))
        levels = fit_levels(with_limits(held).select("fold", far, "odds", "repeats", "limits"), {"far": F.col("limits"), "odds": given["odds"], "repeats": given["repeats"]})
        most_odds, most_repeats = every["odds"][levels["odds"]], every["repeats"][levels["repeats"]]
        limited = with_limits(scored).withColumn("limit", F.get("limits", F.lit(levels["far"])))
    threshold = F.when((F.col("odds") > most_odds) | (F.col("repeats") > most_repeats), 0.0).otherwise(F.exp(F.col("middle") + F.col("limit") * width) * (1 + 1e-9))
    return limited.withColumn("threshold", threshold).withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of docs(doc_id, text, lang): doc_id, lang, n_words, perplexity, threshold, kept.

    Trusted are documents labelled quality 1 and toxic 0, rejected those of quality 0 or toxic 1; eight in ten of both (by
    a hash of the id) are counted, two give the limits. Three measures are limited: the log of the perplexity under the
    trusted pair model, as its distance from the median of the held-out trusted text of its language (of all languages
    where a language, null is one, has fewer than LEAST_HELD of them), in units of the distances usual at its length; the
    largest log odds of a word for rejected text; and the share of repeated pairs. fit_levels chooses a quantile of each
    measure over the held-out trusted text; of the perplexity it is each language's own quantile (with the same exception
    for small ones). Where fewer than LEAST_HELD are held out in all, the largest of all trusted documents count. A document
    is kept if its perplexity is not above its threshold, which is 0 where one of the other two limits is passed. Counts
    are over all labelled text, perplexities over all words of every document; a document that the model has counted is
    judged without its own counts. docs is read three times.

    Null text or no word: perplexity null, not kept; without any held-out trusted text (or labels) all others are kept.
    Ids labelled twice: trusted if every label says so, else toxic if one does. Repeated rows are scored each. An empty
    table gives no rows; further columns are not read.
    """
    find_package(docs.sparkSession)
    spark = docs.sparkSession
    ok, toxic, junk = (F.col("quality") == 1) & (F.col("toxic") == 0), F.col("toxic") == 1, F.col("quality") == 0
    labelled = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min(ok).alias("ok"), F.max(toxic).alias("toxic"), F.max(junk).alias("junk"))
    kind = F.when(F.col("ok"), TRUSTED).when(F.col("toxic"), TOXIC).when(F.col("junk"), JUNK)
    fold = kind + F.when(F.pmod(F.xxhash64("_id"), F.lit(10)) < HELD_OUT, 1).otherwise(0)
    labelled = materialize(labelled.select("_id", fold.alias("fold")).where("fold IS NOT NULL"), "labelled")
    few = labelled.count() <= BROADCAST_IDS
    folder, shards = new_folder(spark, "classifier"), 1 + text_size(docs) // SHARD_BYTES

    def labelled_docs(labelled: DataFrame, how: str) -> DataFrame:
        d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
        return d.join(F.broadcast(labelled) if few else labelled, F.col("doc_id") == F.col("_id"), how)

    counted_docs = labelled_docs(labelled.where(F.col("fold").isin(TRUSTED, JUNK, TOXIC)), "inner")
    names = rejected_words(counted_docs.select("text", "fold"), folder, shards)
    release_shuffles(spark)
    counted = count_shards(write_blocks(labelled_docs(labelled, "left").select("doc_id", "text", "lang", "fold"), folder, shards, names))
    release_shuffles(spark)
    judged = judge(score_blocks(counted, folder, lower_orders(counted, folder)))
    return judged.select("doc_id", "lang", "n_words", "perplexity", "threshold", "kept")


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
