"""Suffix-array dedup: repeated byte strings across documents, found by two-stage suffix sorting of shared stretches."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import MIX1, MIX2, batches_of, enter, get_file, in_order, materialize, mix, new_folder, parallelism, put_file, release_memory, text_bytes, text_size

#: Bytes of a match, of the sampled strings inside it, and so sampled strings in a window of which one is taken.
MATCH, GRAM = 50, 24
#: Text bytes of a block (a unit of work that is kept in the shared folder), and of a chunk that is hashed at a time.
BLOCK_BYTES, CHUNK = 8 << 20, 1 << 18
#: Text bytes for a shard: its suffixes are sorted in one task's memory.
SHARD_BYTES = 2 << 20
#: Blocks that may hold a sampled string whose stretches stay together.
HOT_BLOCKS = 256
NO_HASH = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---------------------------------------------------------------- two-stage suffix sorting

def sort_by_bytes(text: np.ndarray, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Order of the strings text[at : at + depth] (a shorter one before its extensions), equal ones in any order.

    Eight bytes decide first, then four more at a time among those still equal; text is padded and its symbols are > 0.
    """
    def word(where, d, shift, n):
        key = np.zeros(len(where), np.uint64)
        for k in range(n):
            b = text[where + shift + k].astype(np.uint64)
            key = (key << np.uint64(9)) | np.where(d > shift + k, b, np.uint64(0))
        return key

    if not len(at):
        return np.zeros(0, np.int64)
    key = word(at, depth, 0, 7)
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    shift, most = 7, int(depth.max())
    while shift < most:
        group = np.cumsum(new) - 1
        size = np.diff(np.append(np.flatnonzero(new), len(order)))
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        own = order[tied]
        # group numbers take the high bits and three more symbols of nine bits the low ones: one sort of plain integers
        key = (group[tied].astype(np.uint64) << np.uint64(27)) | word(at[own], depth[own], shift, 3)
        by = np.argsort(key)
        key = key[by]
        order[tied] = own[by]
        new[tied] = np.concatenate([[True], key[1:] != key[:-1]])
        shift += 3
    return order


def two_stage(text: np.ndarray, ends: np.ndarray, want: np.ndarray, most: int) -> np.ndarray:
    """Suffixes of pieces that stand end to end in text, sorted by their first `most` bytes: the positions in want (a
    mask), and the few that decide their order.

    text: symbols 1 .. 256 with a 0 after each piece, and padding; ends: for each position its piece's 0. Stage one sorts
    directly the suffixes that are smaller than their successors; stage two gets all others by scans over the buckets of
    first symbols in ascending order: the suffix one to the left of a sorted suffix, if larger than it, is next in its
    own bucket.
    """
    n = len(ends)
    nxt = text[1 : n + 1]
    here = text[:n]
    # larger than the successor: by the first differing symbol; in a run of equal symbols by what follows the run
    decides = np.where(here == nxt, n - 1, np.arange(n)).astype(np.int32)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    large = here[decides] > nxt[decides]
    del decides
    # wanted suffixes that are larger need their successors, up to one that is sorted directly
    need = want.copy()
    run = want & large
    while True:
        step = np.flatnonzero(run) + 1
        step = step[step < n]
        step = step[~need[step]]
        if not len(step):
            break
        need[step] = True
        run = np.zeros(n, bool)
        run[step] = large[step]
    direct = np.flatnonzero(need & ~large)
    order = direct[sort_by_bytes(text, direct, np.minimum(ends[direct] - direct, most) + 1)]
    heads = here[order]
    # each bucket: first what is induced (larger than its successor), then what was sorted directly
    bounds = np.searchsorted(heads, np.arange(258))
    induced: list[list[np.ndarray]] = [[] for _ in range(258)]
    induces = need & large
    sorted_parts = []
    for c in range(257):
        front = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        lows = [front]
        while len(front):  # the runs of c: left neighbours in the same bucket
            left = front[front > 0] - 1
            front = left[(here[left] == c) & induces[left]]
            if len(front):
                lows.append(front)
        bucket = np.concatenate([*lows, order[bounds[c] : bounds[c + 1]]])
        induced[c] = []
        sorted_parts.append(bucket)
        left = bucket[bucket > 0] - 1
        left = left[induces[left] & (here[left] > c)]
        if len(left):
            symbols = here[left]
            by = np.argsort(symbols, kind="stable")
            left, symbols = left[by], symbols[by]
            cuts = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
            for a, b in zip(cuts, np.append(cuts[1:], len(left)), strict=True):
                induced[symbols[a]].append(left[a:b])
    out = np.concatenate(sorted_parts)
    return out[want[out]]


def common_prefix_ranks(text: np.ndarray, suffixes: np.ndarray, length: int) -> np.ndarray:
    """Group number of each sorted suffix; neighbours whose common prefix is at least `length` share one."""
    new = np.zeros(len(suffixes), bool)
    if not len(suffixes):
        return new.astype(np.int64)
    left, right = suffixes[:-1], suffixes[1:]
    equal = np.arange(len(left))  # pairs whose first symbols have been equal so far
    for k in range(length):
        equal = equal[text[left[equal] + k] == text[right[equal] + k]]
    new[1:] = True
    new[1 + equal] = False
    return np.cumsum(new)


def repeated_windows(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of `length` bytes of distinct pieces: piece number, offset in it, and group of equal windows."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    n = int(sizes.sum()) + len(pieces)
    raw = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    zero = starts + sizes
    text = np.ones(n + 64, np.uint16)  # padding above the last 0
    text[:n] = raw.astype(np.uint16) + 1
    text[zero] = 0
    ends = np.repeat(zero.astype(np.int32), sizes + 1)
    want = (np.arange(n, dtype=np.int32) + length) <= ends
    suffixes = two_stage(text, ends, want, length)
    group = common_prefix_ranks(text, suffixes, length)
    piece = np.searchsorted(starts, suffixes, side="right") - 1
    return piece, suffixes - starts[piece], group


# ---------------------------------------------------------------- sampled strings

def _window(x: np.ndarray, w: int, f) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        x = f(x[:-size], x[size:])
        size *= 2
    return f(x[: len(x) - (w - size)], x[w - size :]) if size < w else x


def gram_hashes(body: np.ndarray) -> np.ndarray:
    """A hash of each GRAM bytes, from hashes of 8 and 16 by doubling."""
    h = (body.astype(np.uint64) + np.uint64(1)) * MIX1
    base, halves = int(MIX2), {}
    for size in (1, 2, 4, 8):
        h = h[:-size] * np.uint64(base) + h[size:]
        h ^= h >> np.uint64(31)
        base = (base * base + 2) % (1 << 64)  # odd
        halves[size * 2] = h
    n = len(body) - GRAM + 1
    return mix(halves[16][:n] * MIX1 + halves[8][16 : 16 + n])


def sample(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the sampled strings: in each MATCH bytes of one text, the string with the least hash.

    Equal windows of MATCH bytes so have an equal sampled string at an equal place. Texts stand end to end.
    """
    w = MATCH - GRAM + 1
    n = len(body)
    where, hashes = [], []
    step = CHUNK
    for low in range(0, max(n - GRAM + 1, 0), step):
        # strings starting in low - (w - 1) .. low + step + w - 2 decide those in low .. low + step - 1
        a, b = max(0, low - w + 1), min(n - GRAM + 1, low + step + w - 1)
        h = gram_hashes(body[a : b + GRAM - 1])
        over = np.searchsorted(offsets, [a, b + GRAM], side="left")
        for e in offsets[max(over[0], 1) : over[1] + 1]:  # strings that reach over a text's end
            h[max(0, e - GRAM + 1 - a) : max(0, min(e, b) - a)] = NO_HASH
        pad = np.full(w - 1, NO_HASH, np.uint64)
        ext = np.concatenate([pad if a == 0 else pad[:0], h, pad if b == n - GRAM + 1 else pad[:0]])
        shift = len(pad) if a == 0 else 0
        least = _window(ext, w, np.minimum)
        top = _window(least, w, np.maximum)  # of ext[w - 1 : len(ext) - w + 1]
        mid = ext[w - 1 : len(ext) - w + 1]
        at = np.flatnonzero((mid == top) & (mid != NO_HASH))
        pos = at + (w - 1) - shift + a
        keep = (pos >= low) & (pos < low + step)
        where.append(pos[keep])
        hashes.append(mid[at[keep]])
    if not where:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(where), np.concatenate(hashes)


# ---------------------------------------------------------------- blocks in the shared folder

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed body; in large ones repeats are found over all of it (copies of texts)."""
    body = struct.pack(f"<{len(arrays)}Q", *[a.nbytes for a in arrays]) + b"".join(a.tobytes() for a in arrays)
    if len(body) < 1 << 20:
        return zstandard.ZstdCompressor(level=1).compress(body)
    far = zstandard.ZstdCompressionParameters.from_level(1, window_log=24, enable_ldm=True)
    return zstandard.ZstdCompressor(compression_params=far).compress(body)


def unpack(raw: bytes, *kinds: str) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(raw)
    sizes = struct.unpack_from(f"<{len(kinds)}Q", body)
    at, out = 8 * len(kinds), []
    for size, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(body, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def load_block(folder: str, block: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, offsets and bytes of a block's documents."""
    ids, offsets, body, _ = unpack(get_file(folder, block), "<i8", "<i8", "u1", "u1")
    return ids, offsets, body


def load_carried(folder: str, block: str) -> pd.DataFrame:
    """The other columns of a block's documents."""
    raw = unpack(get_file(folder, block), "<i8", "<i8", "u1", "u1")[3]
    return pa.ipc.open_stream(pa.py_buffer(raw.tobytes())).read_all().to_pandas()


NULL_ID = (1 << 63) - 1


def write_blocks(docs: DataFrame, folder: str, shards: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Documents, with the columns to carry, into block files; a table of (block, shard, grams), to be read once: the block's sampled strings by shard, as
    32-bit fingerprints: first those that two documents of the block have, then the others."""

    def run(frames):
        enter("suffix")
        held, size = [], 0

        def close():
            ids = np.concatenate([x[0] for x in held])
            sizes = np.concatenate([np.diff(x[1]) for x in held])
            offsets, body = np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([x[2] for x in held])
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches([x[3] for x in held])
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            raw = pack(ids.astype("<i8"), offsets.astype("<i8"), body, np.frombuffer(sink.getvalue(), np.uint8))
            block = hashlib.sha256(raw).hexdigest()[:24]
            put_file(folder, block, raw)
            where, hashes = sample(body, offsets)
            doc = np.searchsorted(offsets, where, side="right") - 1
            order = np.lexsort((ids[doc], hashes))
            h, d = hashes[order], ids[doc][order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            last = np.append(first[1:], len(h)) - 1
            shared = d[first] != d[last] if len(h) else np.zeros(0, bool)
            h = h[first] if len(h) else h
            shard = (h >> np.uint64(32)) % np.uint64(shards)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            small = h.astype(np.uint32)
            blobs = []
            some = [s for s in range(shards) if s == 0 or cuts[s] < cuts[s + 1]]  # at least one row names the block
            for s in some:
                own = order[cuts[s] : cuts[s + 1]]
                yes = shared[own]
                blobs.append(pack(np.sort(small[own[yes]]), np.sort(small[own[~yes]])))
            return pa.RecordBatch.from_arrays([pa.array([block] * len(some)), pa.array(some, pa.int64()), pa.array(blobs, pa.binary())], names=["block", "shard", "grams"])

        for frame in batches_of(frames, BLOCK_BYTES // 4):
            body, offsets = text_bytes(frame.column(1))
            held.append((frame.column(0).to_numpy(zero_copy_only=False), offsets, body, frame.select(["null_text", *carry])))
            size += len(body) + 64 * frame.num_rows
            if size >= BLOCK_BYTES:
                yield close()
                held, size = [], 0
        if held:
            yield close()

    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), "text", F.col("text").isNull().alias("null_text"), *carry)
    return in_order(d).mapInArrow(run, "block string, shard long, grams binary")


def shared_grams(grams: DataFrame) -> DataFrame:
    """A written table (block, shard, shared), a row at least for each block: of each block, the fingerprints that another
    of its documents or another block has too; after them those that more than HOT_BLOCKS blocks have."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        enter("suffix")
        got = [unpack(raw, "<u4", "<u4") for raw in part["grams"]]
        every, blocks = np.unique(np.concatenate([x for pair in got for x in pair]), return_counts=True)
        shared = blocks > 1
        shared[np.searchsorted(every, np.concatenate([a for a, _ in got]))] = True
        twice, hot = every[shared], every[blocks > HOT_BLOCKS]
        out = []
        for a, b in got:
            own = np.sort(np.concatenate([a, b]))
            out.append(pack(*[own[np.isin(own, x, assume_unique=True)] for x in (twice, hot)]))
        release_memory()
        return pd.DataFrame({"block": part["block"], "shard": part["shard"], "shared": out})

    return materialize(grams.groupBy("shard").applyInPandas(run, "block string, shard long, shared binary"), "shared")


def stretches(shared: DataFrame, folder: str, shards: int) -> DataFrame:
    """(shard, block, body): the distinct stretches of bytes around a block's shared sampled strings, which the windows
    led by them cover, each with the least and the greatest id of the documents that hold it; by the string's shard.

    So a passage that many documents of a block hold is sent once. Where each stretch stands is kept in a file beside the
    block's. A string of more than HOT_BLOCKS blocks would bring too many distinct stretches (the ends of a very common
    passage) to one shard: its windows go one by one, to shards by their own hash.
    """
    w = MATCH - GRAM + 1

    def run(part: pd.DataFrame) -> pd.DataFrame:
        enter("suffix")
        block = part["block"].iloc[0]
        ids, offsets, body = load_block(folder, block)
        where, hashes = sample(body, offsets)
        shard = ((hashes >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
        small = hashes.astype(np.uint32)
        hit, hot = np.zeros(len(where), bool), np.zeros(len(where), bool)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        for s, raw in zip(part["shard"], part["shared"], strict=True):
            own = order[cuts[s] : cuts[s + 1]]
            for known, flag in zip(unpack(raw, "<u4", "<u4"), (hit, hot), strict=True):
                if len(known) and len(own):
                    i = np.minimum(np.searchsorted(known, small[own]), len(known) - 1)
                    flag[own] = known[i] == small[own]
        doc = np.searchsorted(offsets, where, side="right") - 1
        # windows whose least hash is this string's: those that reach neither a smaller string to the left nor to the
        # right; a window belongs to the leftmost of equal strings, and to have it twice is harmless
        n = len(where)
        prev = np.full(n, -1, np.int64)
        nxt = np.full(n, 1 << 60, np.int64)
        for step in range(1, w):
            same = doc[step:] == doc[:-step] if n > step else np.zeros(0, bool)
            near = same & (where[step:] - where[:-step] < w) if n > step else same
            if not near.any():
                break
            smaller = near & (hashes[:-step] < hashes[step:])
            i = np.flatnonzero(smaller) + step
            prev[i] = np.maximum(prev[i], where[i - step])
            smaller = near & (hashes[step:] < hashes[:-step])
            i = np.flatnonzero(smaller)
            nxt[i] = np.minimum(nxt[i], where[i + step])
        low, high = offsets[doc], offsets[doc + 1]
        first = np.maximum.reduce([low, where - w + 1, prev + 1])
        last = np.minimum.reduce([high - MATCH, where, nxt - w])  # start of the last window
        use = np.flatnonzero(hit & (first <= last))
        start, end, owner, to = first[use], last[use] + MATCH, doc[use], shard[use]
        if hot[use].any():  # windows of their own
            one = hot[use]
            n = (end - start - MATCH + 1)[one]
            each = np.repeat(start[one] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            by = np.array([zlib.crc32(body[i : i + MATCH].tobytes()) % shards for i in each], np.int64)
            start, end, owner, to = (np.concatenate([x[~one], y]) for x, y in ((start, each), (end, each + MATCH), (owner, np.repeat(owner[one], n)), (to, by)))
        order = np.lexsort((start, to))
        start, end, owner, to = start[order], end[order], owner[order], to[order]
        cuts = np.searchsorted(to, np.arange(shards + 1))
        view = body.tobytes()
        number = np.empty(len(start), np.int32)
        rows = []
        for s in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[s], cuts[s + 1])
            names: dict[bytes, int] = {}
            number[own] = [names.setdefault(view[x:y], len(names)) for x, y in zip(start[own].tolist(), end[own].tolist())]
            low, high = np.full(len(names), NULL_ID, np.int64), np.full(len(names), -NULL_ID, np.int64)
            np.minimum.at(low, number[own], ids[owner[own]])
            np.maximum.at(high, number[own], ids[owner[own]])
            size = np.fromiter(map(len, names), np.int64, len(names))
            rows.append((int(s), block, pack(low.astype("<i8"), high.astype("<i8"), size.astype("u1"), np.frombuffer(b"".join(names), np.uint8))))
        put_file(folder, block + ".at", pack(cuts.astype("<i4"), number.astype("<i4"), owner.astype("<i4"), (start - offsets[owner]).astype("<i4")))
        release_memory()
        return pd.DataFrame(rows, columns=["shard", "block", "body"])

    # rows are small, the blocks behind them aren't: a fixed number of partitions keeps them from being put together
    return shared.repartition(parallelism(shared.sparkSession), "block").groupBy("block").applyInPandas(run, "shard long, block string, body binary")


def repeated_spans(pieces: DataFrame) -> DataFrame:
    """(block, shard, spans): of the block's stretches in the shard, runs of windows with the least id that has them:
    number of the stretch, first window, windows, id; runs that are of no use to any document of the block are left out."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        enter("suffix")
        names: dict[bytes, int] = {}
        numbers, lows, highs = [], [], []
        for raw in part["body"]:
            low, high, size, body = unpack(raw, "<i8", "<i8", "u1", "u1")
            view, cut = body.tobytes(), np.concatenate([[0], np.cumsum(size.astype(np.int64))]).tolist()
            numbers.append(np.array([names.setdefault(view[x:y], len(names)) for x, y in zip(cut, cut[1:])], np.int64))
            lows.append(low)
            highs.append(high)
        distinct = list(names)
        # the smallest id of each distinct stretch, of each group of equal windows, then back to each window
        least = np.full(len(distinct), NULL_ID, np.int64)
        np.minimum.at(least, np.concatenate(numbers), np.concatenate(lows))
        piece, offset, group = repeated_windows(distinct, MATCH)
        low = np.full(int(group.max(initial=0)) + 1, NULL_ID, np.int64)
        np.minimum.at(low, group, least[piece])
        counts = np.array([len(p) - MATCH + 1 for p in distinct], np.int64)
        base = np.cumsum(counts) - counts
        owner = np.empty(int(counts.sum()), np.int64)
        owner[base[piece] + offset] = low[group]
        # runs of windows with one owner, by stretch
        new = np.concatenate([[True], owner[1:] != owner[:-1]])
        new[base] = True
        head = np.flatnonzero(new)
        length = np.diff(np.append(head, len(owner)))
        of = np.searchsorted(base, head, side="right") - 1
        first = np.searchsorted(head, base)
        runs = np.diff(np.append(first, len(head)))
        rows = []
        for block, shard, number, high in zip(part["block"], part["shard"], numbers, highs, strict=True):
            n = runs[number]
            own = np.repeat(np.arange(len(number)), n)
            r = np.repeat(first[number] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            use = owner[head[r]] < high[own]
            own, r = own[use], r[use]
            if len(r):
                rows.append((block, shard, pack(own.astype("<i4"), (head[r] - base[of[r]]).astype("u1"), length[r].astype("u1"), owner[head[r]].astype("<i8"))))
        release_memory()
        return pd.DataFrame(rows, columns=["block", "shard", "spans"])

    return pieces.groupBy("shard").applyInPandas(run, "block string, shard long, spans binary")


def place_spans(spans: pd.DataFrame, at: tuple, ids: np.ndarray) -> np.ndarray:
    """Rows of (document, start, end) to cut: each run at each place of its stretch whose document's id is above the owner."""
    cuts, number, doc, start = at
    out = [np.zeros((0, 3), np.int64)]
    for shard, raw in zip(spans["shard"], spans["spans"], strict=True):
        piece, first, length, owner = unpack(raw, "<i4", "u1", "u1", "<i8")
        own = slice(cuts[shard], cuts[shard + 1])
        order = np.argsort(number[own], kind="stable") + cuts[shard]
        low = np.searchsorted(number[order], piece)
        n = np.searchsorted(number[order], piece, side="right") - low
        where = order[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        run = np.repeat(np.arange(len(piece)), n)
        use = owner[run] < ids[doc[where]]
        where, run = where[use], run[use]
        begin = start[where].astype(np.int64) + first[run]
        out.append(np.stack([doc[where].astype(np.int64), begin, begin + length[run].astype(np.int64) + MATCH - 1], 1))
    return np.concatenate(out)


def cut(body: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, int]:
    """The bytes outside of the spans (rows of start, end), and the number of maximal removed runs."""
    if not len(spans):
        return body, 0
    step = np.zeros(len(body) + 1, np.int32)
    np.add.at(step, spans[:, 0], 1)
    np.add.at(step, spans[:, 1], -1)
    gone = np.cumsum(step[:-1]) > 0
    return body[~gone], int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())


def suffix_dedup(docs: DataFrame, *, keep_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove from each of docs(doc_id, text) every byte that a MATCH-byte string covers which starts in a document with
    a smaller doc_id too: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with keep_text also text (what is left; of a
    character cut in two nothing; null stays null); and the columns named in carry.

    1. Documents go into blocks in the shared folder; of every MATCH bytes one GRAM-byte string is sampled by least hash,
       so equal windows share one. Per shard of strings, those that two documents have are found.
    2. A block's distinct stretches around shared strings go to the string's shard. There the suffixes of the distinct
       stretches are sorted in two stages, common prefixes of neighbours give groups of equal windows, and the smallest
       doc_id of a group decides. A passage that many documents hold is one stretch a block, and one text in the shard.
    3. The runs of windows with their owners go back to the blocks, which cut them out of documents with larger ids.

    Null text: empty. Null doc_id: larger than all others. Rows with one doc_id do not match each other. Repeated rows
    stay rows of their own. An empty table gives no rows; further columns are not read. docs is read twice.
    """
    spark = docs.sparkSession
    folder, shards = new_folder(spark, "blocks"), 1 + text_size(docs) // SHARD_BYTES
    shared = shared_grams(write_blocks(docs, folder, shards, carry))
    spans = repeated_spans(stretches(shared, folder, shards))
    blocks = shared.select("block").distinct()
    columns = ["doc_id long", "n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string", *["text string"] * keep_text]
    columns += [f"`{c}` {t}" for c, t in docs.select(*carry).dtypes] if carry else []

    def once(own: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        enter("suffix")
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["text"] * keep_text]
        if not len(own):
            return pd.DataFrame({c: [] for c in [*names, *carry]})
        block = own["block"].iloc[0]
        ids, offsets, body = load_block(folder, block)
        gone = place_spans(found, tuple(unpack(get_file(folder, block + ".at"), "<i4", "<i4", "<i4", "<i4")), ids) if len(found) else np.zeros((0, 3), np.int64)
        gone = gone[np.argsort(gone[:, 0], kind="stable")]
        both, cuts = gone[:, 1:], np.searchsorted(gone[:, 0], np.arange(len(ids) + 1))
        carried = load_carried(folder, block)
        empty = carried.pop("null_text").to_numpy()
        rows = []
        for i in range(len(ids)):
            whole = body[offsets[i] : offsets[i + 1]]
            kept, n = cut(whole, both[cuts[i] : cuts[i + 1]])
            raw = kept.tobytes()
            row = (None if ids[i] == NULL_ID else int(ids[i]), len(whole), len(whole) - len(kept), n, hashlib.sha256(raw).hexdigest())
            rows.append((*row, None if empty[i] else raw.decode("utf-8", "ignore")) if keep_text else row)
        release_memory()
        out = pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
        return pd.concat([out, carried], axis=1) if carry else out

    return blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInPandas(once, ", ".join(columns))


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
