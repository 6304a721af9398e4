"""SimHash near-dedup: fingerprints of word shingles, linked through a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import batches_of, enter, find_package, materialize, parallelism, release_memory, text_bytes
from firmlens.llm.near_dedup import components, hinted

#: Words of a shingle, the seed of its hash, and the bits in which linked fingerprints may differ.
SHINGLE, SEED, LIMIT = 3, 42, 2
#: Members of a node of the index, fingerprints searched for at a time, and bytes of text whose words are held at a time.
FAN, QUERIES, PIECE = 8, 2048, 1 << 20
#: Fingerprints of a bucket above which it is split by further bits.
BUCKET = 1 << 16

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)


# ---------------------------------------------------------------- fingerprints

def word_runs(text: bytes) -> Iterator[tuple[bytes, list[int]]]:
    """Words, A-Z lower-cased, joined by single spaces, and their numbers of bytes: of a long text in runs that overlap by
    SHINGLE - 1 words, so that each shingle is in one of them. A run of fewer words is the whole text."""
    at, kept, short = 0, [], True
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end : end + 1].strip():  # a word is never cut
            end += 1
        kept = kept + text[at:end].translate(_LOWER).split()
        at = end
        if len(kept) >= SHINGLE:
            yield b" ".join(kept), list(map(len, kept))
            kept, short = kept[1 - SHINGLE :], False
    if short and kept:
        yield b" ".join(kept), list(map(len, kept))


def shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    """XXH64 of each shingle, repeats kept; of a text of fewer words, but at least one, that of all its words."""
    digest = xxhash.xxh64_intdigest
    for joined, sizes in word_runs(text):
        if len(sizes) < SHINGLE:
            yield np.array([digest(joined, SEED)], np.uint64)
            continue
        ends = np.cumsum(np.array(sizes) + 1) - 1
        starts = ends - sizes
        spans = zip(starts[: len(sizes) - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
        yield np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(sizes) - SHINGLE + 1)


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """A bit is one if more than half of a text's hashes have it; zero without words."""
    ones, count = np.zeros((len(texts), 64)), np.zeros(len(texts))
    held: list[np.ndarray] = []
    owner: list[int] = []

    def add() -> None:
        if not held:
            return
        sizes = [len(h) for h in held]
        docs, own = np.unique(owner, return_inverse=True)
        lanes = np.concatenate(held).astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        lanes += np.repeat(own, sizes)[:, None] * 2048 + np.arange(8) * 256
        seen = np.bincount(lanes.reshape(-1), minlength=len(docs) * 2048).reshape(-1, 256)
        ones[docs] += (seen @ _BITS).reshape(-1, 64)
        np.add.at(count, owner, sizes)
        held.clear()
        owner.clear()

    for i, text in enumerate(texts):
        for hashes in shingle_hashes(text):
            held.append(hashes)
            owner.append(i)
            if len(held) >= 256 or len(hashes) > 1 << 16:
                add()
    add()
    return np.packbits(2 * ones > count[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) as doc_id, fp: the fingerprint's 64 bits as a long. One pass, no shuffle."""

    def run(frames):
        enter("simhash")
        for frame in batches_of(frames, PIECE):
            body, offsets = text_bytes(frame.column(1))
            view = body.tobytes()
            fps = fingerprints([view[a:b] for a, b in zip(offsets, offsets[1:])])
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])
        release_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- index

def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of a bit pattern in the reflected Gray code: neighbours in that order differ in few bits."""
    rank = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Fingerprints of several buckets, each in Gray order, under nodes of FAN members; a bucket has a root of its own.

    A node keeps the bits in which all fingerprints below it agree and its parent's don't: so what differs between these
    bits and a query's adds up on the way down to the whole distance, and a node whose sum is above the limit is left
    out with all that is below it.
    """

    def __init__(self, fps: np.ndarray, bucket: np.ndarray):
        """fps in order of (bucket, Gray rank); bucket: ascending numbers."""
        self.fps, self.levels = fps, []
        low, high, own = fps, fps, np.unique(bucket, return_inverse=True)[1]  # node's bits that all or some below it have; its bucket
        last = np.arange(len(fps))
        rows = [(low, np.zeros(len(fps), np.uint64), np.zeros(len(fps), np.int64), np.zeros(len(fps), np.int64), last)]
        while len(own) > (own[-1] + 1 if len(own) else 0):
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            place = np.arange(len(own)) - first[own]
            heads = np.flatnonzero(place % FAN == 0)
            low, high, own = np.bitwise_and.reduceat(low, heads), np.bitwise_or.reduceat(high, heads), own[heads]
            ends = np.append(heads[1:], len(place))
            last = last[ends - 1]
            rows.append((low, low ^ high, heads, ends, last))
        for k, (pattern, loose, start, end, last) in enumerate(rows):
            above = np.full(len(pattern), ~np.uint64(0))  # of a root nothing is known from above
            if k + 1 < len(rows):
                above = np.repeat(rows[k + 1][1], rows[k + 1][3] - rows[k + 1][2])
            self.levels.append((pattern, above & ~loose, start, end, last))

    def search(self, queries: np.ndarray, root: np.ndarray, limit: int = LIMIT, after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query's number, fingerprint's place) of all within the limit, in the buckets `root`; after: only places behind
        these."""
        q, node, apart = np.arange(len(queries)), root, np.zeros(len(queries), np.uint8)
        for k in range(len(self.levels) - 1, -1, -1):
            pattern, mask, start, end, last = self.levels[k]
            apart = apart + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            near = apart <= limit
            if after is not None:
                near &= last[node] > after[q]
            q, node, apart = q[near], node[near], apart[near]
            if k:
                n = end[node] - start[node]
                node = np.repeat(start[node] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                q, apart = np.repeat(q, n), np.repeat(apart, n)
        return q, node

    def link_labels(self, limit: int = LIMIT) -> np.ndarray:
        """For each fingerprint the first place of those that links inside of its bucket reach."""
        label = np.arange(len(self.fps))
        root = np.searchsorted(self.levels[-1][4], label)
        for at in range(0, len(self.fps), QUERIES):
            own = np.arange(at, min(at + QUERIES, len(self.fps)))
            q, place = self.search(self.fps[own], root[own], limit, own)
            a, b = own[q], place
            while len(a):  # hook roots to smaller ones, then flatten
                a, b = label[a], label[b]
                apart = a != b
                a, b = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
                np.minimum.at(label, b, a)
                while True:
                    up = label[label]
                    if (up == label).all():
                        break
                    label = up
        return label


def parts_of(mask: int) -> list[int]:
    """mask with a third of its other bits, three ways: two that agree in mask and differ in at most two bits agree in one of
    these."""
    free = [i for i in range(63, -1, -1) if not mask >> i & 1]
    cuts = [len(free) * k // (LIMIT + 1) for k in range(LIMIT + 2)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def linked_inside(rows: DataFrame) -> DataFrame:
    """rows(mask, key, fp) to edges (a, b): a star for each connected set of fingerprints of a bucket (mask, key)."""

    def run(frames):
        enter("simhash")
        parts: list[np.ndarray] = []

        def edges(table: np.ndarray):
            if len(table) < 2:
                return
            mask, key, fp = (table[:, i].view(np.uint64) for i in range(3))
            order = np.lexsort((gray_rank(fp & ~mask), key, mask))
            mask, key, fp = mask[order], key[order], fp[order]
            new = np.concatenate([[True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
            bucket = np.cumsum(new) - 1
            several = np.bincount(bucket)[bucket] > 1
            if not several.any():
                return
            fp, bucket = fp[several], bucket[several]
            label = GrayIndex(fp, bucket).link_labels()
            own = np.flatnonzero(label != np.arange(len(fp)))
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(fp[label[own]].view(np.int64)), pa.array(fp[own].view(np.int64))], names=["a", "b"])

        held = 0
        for frame in frames:  # rows come by bucket; whole buckets are handled together, many small ones at a time
            table = np.stack([frame.column(i).to_numpy() for i in range(3)], axis=1)
            parts.append(table)
            held += len(table)
            if held < BUCKET:
                continue
            table = np.concatenate(parts)
            others = np.flatnonzero((table[:, :2] != table[-1, :2]).any(axis=1))
            last = int(others[-1]) + 1 if len(others) else 0
            yield from edges(table[:last])
            parts, held = [table[last:]], len(table) - last
        if parts:
            yield from edges(np.concatenate(parts))
        release_memory()

    dealt = rows.repartition(parallelism(rows.sparkSession), "mask", "key").sortWithinPartitions("mask", "key")
    return dealt.select("mask", "key", "fp").mapInArrow(run, "a long, b long")


def fingerprint_links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints fp that join all whose bits differ in at most LIMIT places.

    Two such agree in one of three thirds of their bits, so each fingerprint goes to three buckets. A bucket above `bucket`
    rows is split by a third of the bits that are left, three ways again, and so is what is still too large; after the
    third time 19 bits are left, so no bucket can hold more than 2 ** 19. Nothing is left out.
    """
    masks, found = parts_of(0), None
    for depth in range(3):
        if depth == 0:
            rows = fps.select("fp", F.explode(F.array(*[F.lit(signed(m)) for m in masks])).alias("mask"))
        else:
            finer = F.create_map(*[x for m in masks for x in (F.lit(signed(m)), F.array(*[F.lit(signed(c)) for c in parts_of(m)]))])
            rows = large.select("fp", F.explode(F.element_at(finer, F.col("mask"))).alias("mask"))
            masks = [c for m in masks for c in parts_of(m)]
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        heavy = None
        if depth < 2:
            heavy = rows.groupBy("mask", "key").count().where(F.col("count") > bucket).select(F.col("mask").alias("_mask"), F.col("key").alias("_key"))
            heavy = materialize(heavy, "heavy")
            heavy = hinted(heavy) if heavy.head(1) else None
        on = None if heavy is None else [F.col("mask") == F.col("_mask"), F.col("key") == F.col("_key")]
        own = linked_inside(rows if heavy is None else rows.join(heavy, on, "left_anti"))
        found = own if found is None else found.union(own)
        if heavy is None:
            break
        large = materialize(rows.join(heavy, on, "left_semi"), "large")
    return found


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """Per row of docs(doc_id, text): doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id of all
    documents that links reach from it.

    Words are runs of anything but white space, A-Z in lower case; a shingle is three words in a row, or all of a shorter
    text; a bit of the fingerprint is one if it is in more than half of the shingles' hashes (XXH64). Fingerprints that
    differ in at most two bits are linked. Equal fingerprints meet before anything is searched, so copies cost a row.

    Null or empty text, or one of white space: fingerprint zero, linked like any other. Texts of any length are read in
    pieces. Repeated rows: a row each. Null doc_id: takes part, and is no component_id but where all of a component are null. An
    empty table gives no rows; further columns are not read.
    """
    find_package(docs.sparkSession)
    known = materialize(fingerprint_documents(docs), "fingerprints")
    distinct = materialize(known.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    labels = components(fingerprint_links(distinct.select("fp")))
    named = distinct.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    named = materialize(named, "labelled-fingerprints")
    roots = named.groupBy(F.col("label").alias("_label")).agg(F.min("least").alias("component_id"))
    named = materialize(named.join(roots, F.col("label") == F.col("_label")).select(F.col("fp").alias("_fp"), "component_id"), "component-ids")
    out = known.join(named, F.col("fp") == F.col("_fp"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    return simhash_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
