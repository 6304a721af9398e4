"""MinHash near-dedup: DartMinHash signatures of word shingles, banded joining, exact verification, classes."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import MIX1, MIX2, PRIME, batches_of, enter, find_package, materialize, mix, parallelism, powers, release_memory, text_bytes, word_hashes

#: Words of a shingle, and the weighted Jaccard similarity of two texts' shingles from which they are near duplicates.
SHINGLE, SIMILARITY = 5, 0.8
#: A pair at 0.8 shares none of the bands with probability (1 - 0.8 ** 6) ** 32 = 6e-5.
BANDS, ROWS = 32, 6
COORDS = BANDS * ROWS
#: Rows, and bytes of shingles, of a slice of a bucket that is compared inside; ids that may be broadcast (8 bytes each).
SLICE, SLICE_BYTES, BROADCAST_IDS = 256, 4 << 20, 400_000
#: Edges between components that one task may join (16 bytes each); more take distributed rounds until so few are left.
SMALL_EDGES = 100_000


# ---------------------------------------------------------------- shingles

def shingles(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of SHINGLE words, repeats kept, and n + 1 offsets. A text of fewer words, but at least
    one, has one shingle: all its words."""
    words, at = word_hashes(body, offsets)
    n = np.diff(at)
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, (n > 0).astype(n.dtype))
    starts = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(at[:-1] - starts[:-1], count) + np.arange(int(starts[-1]))
    weights = powers(PRIME, SHINGLE + 1)
    h = np.full(len(first), np.uint64(SHINGLE)) * MIX2
    full = np.repeat(n >= SHINGLE, count)
    for k in range(SHINGLE):
        h[full] += words[first[full] + k] * weights[k + 1]
    for i in np.flatnonzero((n > 0) & (n < SHINGLE)):
        own = words[at[i] : at[i + 1]]
        h[starts[i]] = (own * weights[1 : len(own) + 1] + MIX1).sum()
    return mix(h), starts


# ---------------------------------------------------------------- DartMinHash

def unit(h: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def dart_minhash(elements: np.ndarray, weights: np.ndarray | None, starts: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """Signatures of sparse weighted sets that stand end to end (starts: n + 1 offsets); weights None: one each.

    For each element darts fall at unit rate on the plane of weight and rank. Weights are cut in regions
    [2 ** v - 1, 2 ** (v + 1) - 1); the darts of (element, region) come by rank, gaps, weights and coordinates all drawn
    from a hash, so that equal elements see equal darts whatever set they are in. A dart counts if it lies under the
    element's weight; each coordinate keeps the earliest. Ranks are searched up to about coords * (ln coords + 2) darts
    a set, further for sets with an empty coordinate. Two sets agree in a coordinate with probability equal to their
    weighted Jaccard similarity. A value holds 40 bits of the rank and 24 of the dart's hash; an empty set has all ones.
    """
    n = len(starts) - 1
    out = np.full((n, coords), ~np.uint64(0))
    size = np.diff(starts)
    mass = size.astype(np.float64)
    if weights is not None:
        mass = np.bincount(np.repeat(np.arange(n), size), weights, n)
    todo = np.flatnonzero(mass > 0)
    darts = coords * (math.log(coords) + 2)
    while len(todo):
        take = size[todo]
        at = np.repeat(starts[todo] - (np.cumsum(take) - take), take) + np.arange(int(take.sum()))
        own = np.repeat(todo, take)
        limit = darts / mass[own]
        x = np.ones(len(at)) if weights is None else weights[at]
        v = 0
        while len(at):
            width, low = 2.0**v, 2.0**v - 1
            alive, rank, j = np.arange(len(at)), np.zeros(len(at)), 0
            while len(alive):
                h = mix(elements[at[alive]] + np.uint64((v * 0x9E3779B97F4A7C15 + (j + 1) * 0xD1B54A32D192ED03) % (1 << 64)))
                rank = rank - np.log(unit(h)) / width
                near = rank < limit[alive]
                alive, rank, h = alive[near], rank[near], h[near]
                h2 = mix(h.copy() * MIX1)
                hit = slice(None) if weights is None else low + unit(h2) * width <= x[alive]
                h3 = mix(h2[hit] + MIX2)
                value = (rank[hit].view(np.uint64) >> np.uint64(24) << np.uint64(24)) | (h3 >> np.uint64(40))
                cell = own[alive[hit]] * coords + (h3 % np.uint64(1 << 20) * np.uint64(coords) >> np.uint64(20)).astype(np.int64)
                np.minimum.at(out.reshape(-1), cell, value)
                j += 1
            v += 1
            more = x > 2.0**v - 1
            at, own, limit, x = at[more], own[more], limit[more], x[more]
        todo = todo[(out[todo] == ~np.uint64(0)).any(axis=1)]
        darts *= 2
    return out


def counted(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each set, in order, with their numbers of occurrences."""
    own = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((hashes, own))
    h, o = hashes[order], own[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])) if len(h) else np.zeros(0, np.int64)
    return h[new], np.diff(np.append(new, len(h))).astype(np.float64), np.searchsorted(o[new], np.arange(len(starts)))


def bags(body: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Of each text its shingles as sorted 64-bit hashes, the second and later sightings of one as elements of their own:
    the Jaccard similarity of two such sets is the weighted one by numbers of occurrences."""
    hashes, weights, starts = counted(*shingles(body, offsets))
    times = weights.astype(np.int64)
    nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    elements, own = np.repeat(hashes, times), np.repeat(np.repeat(np.arange(len(starts) - 1), np.diff(starts)), times)
    again = nth > 0
    elements[again] = mix(elements[again] + nth[again].astype(np.uint64) * MIX1)
    cuts = np.searchsorted(own, np.arange(len(starts)))
    return [np.sort(elements[i:j]) for i, j in zip(cuts, cuts[1:])]


# ---------------------------------------------------------------- tables

def signatures(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, tie) to a written table doc_id, tie, text_key (128 bits of the whole text), bands (keys; none
    where the text has no word). Darts fall by the shingles' numbers of occurrences."""

    def run(frames):
        enter("near")
        mults = powers(PRIME, ROWS + 1)[1:]
        for frame in batches_of(frames, 2 << 20):
            body, offsets = text_bytes(frame.column(1))
            view = body.tobytes()
            keys = [hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(offsets, offsets[1:])]
            hashes, weights, starts = counted(*shingles(body, offsets))
            sig = dart_minhash(hashes, weights, starts)
            some = np.diff(starts) > 0
            bands = (sig.reshape(-1, BANDS, ROWS) * mults).sum(axis=2) + np.arange(1, BANDS + 1, dtype=np.uint64) * MIX1
            bands = mix(bands.reshape(-1)).view(np.int64).reshape(-1, BANDS)
            yield pa.RecordBatch.from_arrays([
                frame.column(0), frame.column(2), pa.array(keys, pa.binary()),
                pa.array([b if s else [] for b, s in zip(bands, some, strict=True)], pa.list_(pa.int64())),
            ], names=["doc_id", "tie", "text_key", "bands"])
        release_memory()

    return materialize(docs.mapInArrow(run, "doc_id long, tie long, text_key binary, bands array<long>"), "signatures")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of distinct values."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(len(a) + len(b) - both, 1)


def hinted(ids: DataFrame) -> DataFrame:
    """With a broadcast hint where a count shows at most BROADCAST_IDS rows."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """node and text of the rows whose node is in ids(_id), one row a node. If there are few ids, the other rows are left
    out before the shuffle."""
    return docs.select("node", "text").join(hinted(ids), F.col("node") == F.col("_id"), "left_semi").dropDuplicates(["node"])


def verify(pairs: DataFrame, docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """Whether the exact similarity of pairs(a, b) reaches the threshold; a written table (a, b, linked).

    Both texts come by plain joins; a document in many pairs is a skewed side that adaptive execution splits.
    """
    ids = materialize(pairs.select(F.col("a").alias("_id")).union(pairs.select(F.col("b").alias("_id"))).distinct(), "ids")
    texts = materialize(only(docs, ids), "texts")
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    joined = joined.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", F.col("tb").alias("text"))

    def run(frames):
        enter("near")
        for frame in batches_of(frames, 2 << 20):
            left, right = (bags(*text_bytes(frame.column(c))) for c in (2, 3))
            linked = [jaccard(x, y) >= threshold for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([frame.column(0), frame.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])
        release_memory()

    return materialize(joined.mapInArrow(run, "a long, b long, linked boolean"), "verified")


def joined_nodes(edges: DataFrame) -> DataFrame:
    """components of at most SMALL_EDGES edges, in one task."""

    def run(frames):
        enter("near")
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for frame in frames:
            for a, b in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True):
                a, b = root(up.setdefault(a, a)), root(up.setdefault(b, b))
                up[max(a, b)] = min(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(list(up), pa.int64()), pa.array([root(x) for x in up], pa.int64())], names=["node", "label"])

    return materialize(edges.select("a", "b").coalesce(1).mapInArrow(run, "node long, label long"), "labels", 1)


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node of each connected component of edges(a, b); nodes without an edge are left out.

    Each round every node hooks to its least neighbour, the chains are flattened by doubling, and edges between the new
    labels are what is left; rounds end when few are (SMALL_EDGES, counted), which one task joins. Tables shrink, so their
    number of files follows the edges.
    """
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    left = edges.count()
    if left <= SMALL_EDGES:
        return joined_nodes(edges)
    parts = min(parallelism(edges.sparkSession), 1 + left // 50_000)
    labels = materialize(edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct().withColumn("label", F.col("node")), "labels", parts)
    while left > SMALL_EDGES:
        both = edges.select(F.col("a").alias("n"), F.col("b").alias("m")).union(edges.select(F.col("b").alias("n"), F.col("a").alias("m")))
        parent = materialize(both.groupBy("n").agg(F.min("m").alias("m")).select("n", F.least("n", "m").alias("p")), "parents", parts)
        while True:
            up = parent.select(F.col("n").alias("_n"), F.col("p").alias("_p"))
            jumped = materialize(parent.join(up, F.col("p") == F.col("_n"), "left").select("n", F.coalesce("_p", "p").alias("p"), (F.coalesce("_p", "p") != F.col("p")).alias("moved")), "parents", parts)
            parent = jumped.select("n", "p")
            if not jumped.where("moved").head(1):
                break
        up = parent.select(F.col("n").alias("_n"), F.col("p").alias("_p"))
        labels = materialize(labels.join(up, F.col("label") == F.col("_n"), "left").select("node", F.coalesce("_p", "label").alias("label")), "labels", parts)
        low = edges.join(up, F.col("a") == F.col("_n")).select(F.col("_p").alias("a"), "b")
        low = low.join(up, F.col("b") == F.col("_n")).select("a", F.col("_p").alias("b"))
        edges = materialize(low.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges", parts)
        left = edges.count()
    if not left:
        return labels
    up = joined_nodes(edges).select(F.col("node").alias("_n"), F.col("label").alias("_p"))
    return materialize(labels.join(up, F.col("label") == F.col("_n"), "left").select("node", F.coalesce("_p", "label").alias("label")), "labels", parts)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """docs(node, text) as node, n_bytes and its bag of shingles."""

    def run(frames):
        enter("near")
        for frame in batches_of(frames, 2 << 20):
            sets = [x.tobytes() for x in bags(*text_bytes(frame.column(1)))]
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(sets, pa.binary())], names=["node", "n_bytes", "shingles"])
        release_memory()

    return docs.mapInArrow(run, "node long, n_bytes long, shingles binary")


def links_of_slice(node: np.ndarray, label: np.ndarray, sets: list[np.ndarray], asking: np.ndarray) -> list[tuple[int, int]]:
    """Links of the asking documents to documents of other labels, one (to the least node) for each label.

    All elements are sorted once; an asking document's elements then find the documents that hold them, and counting
    those gives the exact similarity to all at once.
    """
    size = np.array([len(s) for s in sets])
    doc = np.repeat(np.arange(len(sets)), size)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, doc = flat[order], doc[order]
    out = []
    for i in np.flatnonzero(asking & (size > 0)):
        low, high = np.searchsorted(flat, sets[i]), np.searchsorted(flat, sets[i], side="right")
        n = high - low
        where = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        both = np.bincount(doc[where], minlength=len(sets))
        near = np.flatnonzero((both / np.maximum(size + size[i] - both, 1) >= SIMILARITY) & ~asking & (label != label[i]))
        near = near[np.argsort(node[near], kind="stable")]
        for k in near[np.unique(label[near], return_index=True)[1]]:
            out.append((min(node[i], node[k]), max(node[i], node[k])))
    return out


def cross_links(members: DataFrame, labels: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between documents of different components that share a bucket: a written table (a, b).

    Only buckets with several components count. There each document outside of the bucket's largest component asks all
    documents of other components; its exact similarity to them (by 64-bit hashes) decides, and one link to each
    component is kept, for one joins the two. So what is sent grows with the number of such documents, not with the
    square of the bucket. Askers and asked are dealt in slices of about SLICE rows or SLICE_BYTES, so that no task holds
    a large bucket. A bucket of n documents in about n components still costs n * n / SLICE rows.
    """
    labels = labels.select(F.col("node").alias("_node"), "label")
    m = members.select("key", "node").join(labels, F.col("node") == F.col("_node"), "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    m = materialize(m, "bucket-labels")
    per = m.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
    mixed = per.where("labels > 1").select(F.col("key").alias("_key"), "main")
    m = materialize(m.join(mixed, F.col("key") == F.col("_key")).drop("_key"), "mixed")
    if not m.head(1):
        return m.select(F.col("node").alias("a"), F.col("node").alias("b"))
    ids = materialize(m.select(F.col("node").alias("_id")).distinct(), "mixed-ids")
    sets = materialize(shingle_sets(only(docs, ids)), "mixed-sets")
    m = m.join(sets.select(F.col("node").alias("_node"), "n_bytes"), F.col("node") == F.col("_node")).drop("_node")
    slices = lambda n, b: F.greatest(F.ceil(n / F.lit(SLICE)), F.ceil(b / F.lit(SLICE_BYTES))).cast("long")
    asks = F.col("label") != F.col("main")
    sizes = m.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("b"), F.count_if(asks).alias("q"), F.sum(F.when(asks, F.col("n_bytes"))).alias("qb"))
    sizes = materialize(sizes.select(F.col("key").alias("_key"), slices(F.col("n"), F.col("b")).alias("others"), slices(F.col("q"), F.col("qb")).alias("askers")), "mixed-sizes")
    m = m.join(sizes, F.col("key") == F.col("_key")).drop("_key", "n_bytes")
    own = lambda n: F.pmod(F.xxhash64("node"), n)
    every = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    asked = m.select("key", "node", "label", F.lit(False).alias("asking"), F.explode(every(F.col("askers"))).alias("x"), own(F.col("others")).alias("y"))
    asking = m.where(asks).select("key", "node", "label", F.lit(True).alias("asking"), own(F.col("askers")).alias("x"), F.explode(every(F.col("others"))).alias("y"))
    m = asked.unionByName(asking).join(sets.select(F.col("node").alias("_node"), "shingles"), F.col("node") == F.col("_node")).drop("_node")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        enter("near")
        part = part.sort_values(["key", "x", "y", "node"])
        node, label, key, x, y, asking = (part[c].to_numpy() for c in ("node", "label", "key", "x", "y", "asking"))
        sets = [np.frombuffer(s, "<u8") for s in part["shingles"]]
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
        out: list = []
        for a, b in zip(first, np.append(first[1:], len(part)), strict=True):
            if asking[a:b].any():
                out += links_of_slice(node[a:b], label[a:b], sets[a:b], asking[a:b])
        release_memory()
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64").drop_duplicates()

    groups = F.pmod(F.xxhash64("key", "x", "y"), F.lit(16 * parallelism(members.sparkSession)))  # many slices to a call
    return materialize(m.withColumn("_group", groups).groupBy("_group").applyInPandas(run, "a long, b long").distinct(), "cross")


def near_dedup(docs: DataFrame) -> DataFrame:
    """Per row of docs(doc_id, text): doc_id, class_id (the least doc_id of its class of near duplicates), text_hash (xxhash64
    of the text) and representative (whether the row stands for its class).

    Two different texts are linked if the weighted Jaccard similarity of their 5-word shingles, by numbers of occurrences
    (sum of the smaller over sum of the larger ones), is 0.8 or more; equal texts are copies; a class is a connected
    component of both. Words are runs of anything but white space.

    1. Copies are found by a 128-bit key of the whole text; one of them stands for all.
    2. Weighted signatures are cut in bands; each bucket's documents are paired with its least document only (a star, so
       a bucket of n gives n - 1 pairs), and the pairs verified exactly. Components follow.
    3. Buckets that still hold several components are compared inside: every document outside of the largest one with
       those of the others. A link inside a component changes no class, so it need not be looked at. Components of these
       links alone, between the former components, give the classes.

    Null or empty text: no shingle, so a copy of other such texts only. Fewer than five words: one shingle of all of them.
    Null doc_id: smaller than all others. Rows with one doc_id (null is one) and one text are one document; with
    different texts they are documents of their own, whose classes may share a class_id. Of equal rows each is a
    representative if one is. An empty table gives no rows; further columns are not read.
    """
    find_package(docs.sparkSession)
    null_id = -(1 << 63)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(null_id)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("tie", F.xxhash64("text"))
    sigs = signatures(docs)
    # ids with several texts (there are mostly none) get a node for each text
    several = materialize(sigs.groupBy("doc_id").agg(F.min("tie").alias("low"), F.max("tie").alias("high")).where("low <> high").select(F.col("doc_id").alias("_several")), "several")
    plain = not several.head(1)

    def with_node(df: DataFrame) -> DataFrame:
        if plain:
            return df.withColumn("node", F.col("doc_id"))
        return df.join(hinted(several), F.col("doc_id") == F.col("_several"), "left").withColumn("node", F.when(F.col("_several").isNull(), F.col("doc_id")).otherwise(F.xxhash64("doc_id", "tie"))).drop("_several")

    docs, keyed = with_node(docs), with_node(sigs) if plain else materialize(with_node(sigs), "nodes")
    firsts = keyed.groupBy("text_key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last").select(F.col("text_key").alias("_key"), "first")
    firsts = hinted(materialize(firsts, "firsts"))  # on its own, so that the join below can be split where a text has many copies
    copies = materialize(keyed.select("node", "text_key").join(firsts, F.col("text_key") == F.col("_key")).where("node <> first").select(F.col("node").alias("_copy"), "first").distinct(), "copies")
    gone = hinted(copies.select("_copy"))
    single = keyed.select("node", "bands").join(gone, F.col("node") == F.col("_copy"), "left_anti")
    banded = single.select("node", F.explode("bands").alias("key"))
    leaders = banded.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("most")).where("leader <> most").select(F.col("key").alias("_key"), "leader")
    leaders = hinted(materialize(leaders, "leaders"))
    members = materialize(banded.join(leaders, F.col("key") == F.col("_key")).select("key", "node", "leader"), "members")
    pairs = materialize(members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    labels = components(verify(pairs, docs).where("linked").select("a", "b"))
    # links found inside of buckets tie components together
    of = lambda c, name: labels.select(F.col("node").alias(f"_{c}"), F.col("label").alias(name))
    ties = cross_links(members, labels, docs)
    ties = ties.join(of("a", "la"), F.col("a") == F.col("_a"), "left").join(of("b", "lb"), F.col("b") == F.col("_b"), "left")
    upper = components(ties.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    upper = upper.select(F.col("node").alias("_low"), F.col("label").alias("high"))
    out = keyed.select("doc_id", "tie", "node").join(copies, F.col("node") == F.col("_copy"), "left").withColumn("node", F.coalesce("first", "node"))
    out = out.join(of("n", "label"), F.col("node") == F.col("_n"), "left").withColumn("label", F.coalesce("label", "node"))
    out = out.join(upper, F.col("label") == F.col("_low"), "left").select("doc_id", "tie", F.coalesce("high", "label").alias("label"))
    if plain:  # a node is an id, and so is the least of a class
        out = out.select("doc_id", F.col("label").alias("class_id"), F.col("tie").alias("text_hash"), (F.col("doc_id") == F.col("label")).alias("representative"))
    else:
        out = materialize(out, "labelled")
        least = out.groupBy("label").agg(F.min(F.struct("doc_id", "tie")).alias("least")).select(F.col("label").alias("_label"), "least")
        out = out.join(least, F.col("label") == F.col("_label")).select("doc_id", F.col("least.doc_id").alias("class_id"), F.col("tie").alias("text_hash"), (F.struct("doc_id", "tie") == F.col("least")).alias("representative"))
    return out.withColumns({c: F.nullif(F.col(c), F.lit(null_id)) for c in ("doc_id", "class_id")})


def op3_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id")
