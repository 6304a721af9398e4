"""Many keywords in many texts: an Aho-Corasick automaton in compact arrays, read over by whole batches of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.functions.text import match_text
from firmlens.shared import find_package

#: Symbols of normalized text: space, digits, letters; 37 stands for any other byte.
SYMBOLS = 38
SYMBOL = np.full(256, 37, np.int64)
SYMBOL[np.frombuffer(b" 0123456789abcdefghijklmnopqrstuvwxyz", np.uint8)] = np.arange(37)
#: States, the shallowest first, whose steps are a table; deeper ones look their edges up.
TABLE = 1 << 15
#: Bytes that a text is cut into (with an overlap), and bytes of texts that are read at a time.
PIECE, BATCH = 1024, 4 << 20
#: Bytes of keywords of one automaton (about 25 bytes of arrays each); more keywords are read over in several passes.
KEYWORD_BYTES = 4 << 20


class KeywordAutomaton:
    """States are prefixes of the keywords, numbered by length. Edges lead to prefixes that are a symbol longer; `fail` to the
    longest proper suffix that is a prefix too; `link` to the longest one that is a keyword (0: none)."""

    def __init__(self, keywords: list[bytes]):
        """keywords: distinct, without empty ones, over the symbols."""
        self.longest = max(map(len, keywords), default=0)
        size = np.array(list(map(len, keywords)), np.int64)
        body = SYMBOL[np.frombuffer(b"".join(keywords), np.uint8)]
        start = np.cumsum(size) - size
        at, n, levels = np.zeros(len(keywords), np.int64), 1, []
        self.table = np.zeros((1, SYMBOLS), np.int32)
        self.edges, self.children, self.fail = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(1, np.int32)
        for depth in range(self.longest):
            long = np.flatnonzero(size > depth)
            key, which = np.unique(at[long] * SYMBOLS + body[start[long] + depth], return_inverse=True)
            child = n + np.arange(len(key))
            at[long] = child[which]
            parent, symbol = key // SYMBOLS, key % SYMBOLS
            fail = self.step(self.fail[parent].astype(np.int64), symbol) if depth else np.zeros(len(key), np.int64)
            known = parent < len(self.table)
            self.table[parent[known], symbol[known]] = child[known]
            if len(self.table) == n:  # a state steps as its suffix does, but for its own edges, which the next level adds
                self.table = np.concatenate([self.table, self.table[fail[: TABLE - n]]])
            self.edges, self.children = np.concatenate([self.edges, key]), np.concatenate([self.children, child.astype(np.int32)])
            self.fail = np.concatenate([self.fail, fail.astype(np.int32)])
            levels.append(slice(n, n + len(key)))
            n += len(key)
        self.word = np.full(n, -1, np.int32)
        self.word[at] = np.arange(len(keywords))
        self.link = np.zeros(n, np.int32)
        for level in levels:  # by length, so that those of shorter prefixes are known
            fail = self.fail[level]
            self.link[level] = np.where(self.word[fail] >= 0, fail, self.link[fail])
        self.ends = (self.word >= 0) | (self.link > 0)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The next state of each."""
        near = state < len(self.table)
        if near.all():
            return self.table[state, symbol].astype(np.int64)
        out = np.zeros(len(state), np.int64)
        out[near] = self.table[state[near], symbol[near]]
        rest = np.flatnonzero(~near)
        at = state[rest]
        while len(rest):
            key = at * SYMBOLS + symbol[rest]
            place = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            hit = self.edges[place] == key
            out[rest[hit]] = self.children[place[hit]]
            rest, at = rest[~hit], self.fail[at[~hit]].astype(np.int64)
            near = at < len(self.table)
            out[rest[near]] = self.table[at[near], symbol[rest[near]]]
            rest, at = rest[~near], at[~near]
        return out

    def found(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, keyword) of all keywords that the texts hold, each once. All texts are read side by side, a symbol of each
        a step; long ones in pieces that overlap by the longest keyword, so that a batch's longest text doesn't hold the others up."""
        size = np.diff(offsets)
        pieces = np.maximum(1, -(-size // PIECE))
        text = np.repeat(np.arange(len(size)), pieces)
        nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = offsets[:-1][text] + nth * PIECE
        length = np.minimum(start + PIECE + max(self.longest - 1, 0), offsets[1:][text]) - start
        order = np.argsort(-length, kind="stable")
        text, start, length = text[order], start[order], length[order]
        symbols = SYMBOL[body]
        state = np.zeros(len(text), np.int64)
        hits = []
        alive = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1), side="right") if len(length) else []
        for t, n in enumerate(alive):  # the first n pieces have a symbol more
            state = self.step(state[:n], symbols[start[:n] + t])
            own = np.flatnonzero(self.ends[state])
            if len(own):
                hits.append(text[own] * len(self.word) + state[own])
        key = np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
        out = []
        while len(key):  # a state's own keyword, then those that are its suffixes
            row, at = np.divmod(key, len(self.word))
            held = self.word[at] >= 0
            out.append(row[held] * len(self.word) + self.word[at[held]])
            up = self.link[at] > 0
            key = np.unique(row[up] * len(self.word) + self.link[at[up]])
        return np.divmod(np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64), len(self.word))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column end to end, and n + 1 offsets; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    body = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and offsets[-1] else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Of about BATCH bytes of the last column, a row at least."""
    size = np.cumsum(np.diff(_bytes(batch.column(batch.num_columns - 1))[1]))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + BATCH, side="right")))
        yield batch.slice(a, b - a)
        a = b


def tag_texts(rows: DataFrame, taxonomy: DataFrame, *, key: str, text: str | Column) -> DataFrame:
    """(key, category, tag) for each tag of taxonomy(category, tag, keyword) one of whose keywords the text holds.

    Keywords count as substrings of the normalized text. They make an automaton that is sent to the tasks once and reads
    each text once, whatever their number: nothing is shuffled and no row multiplied before it matches. Keywords of more than
    KEYWORD_BYTES in all make several automata, which read one after another; the result is the same.

    Null and blank texts have no tag; keywords that are blank when normalized are in none. Each tag comes once a row,
    repeated rows as often as they come; texts of any length; further columns are not read.
    """
    spark = rows.sparkSession
    find_package(spark)
    words = taxonomy.select("category", "tag", match_text(F.col("keyword")).alias("keyword")).where("keyword <> ''").distinct()
    size = words.agg(F.coalesce(F.sum(F.length("keyword").cast("long") + 1), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-size // KEYWORD_BYTES))
    tags_type = "array<struct<category:string,tag:string>>"
    tagged = rows.select(key, F.array().cast(tags_type).alias("_tags"), match_text(F.col(text) if isinstance(text, str) else text).alias("_flat"))
    schema = f"`{key}` {dict(rows.dtypes)[key]}, _tags {tags_type}, _flat string, _more {tags_type}"

    def reader(part: int):
        held = words if parts == 1 else words.where(F.pmod(F.xxhash64("keyword"), F.lit(parts)) == part)
        got = held.orderBy("keyword", "category", "tag").collect()
        distinct = sorted({r["keyword"] for r in got})
        tags = sorted({(r["category"], r["tag"]) for r in got}, key=str)
        number, place = {t: i for i, t in enumerate(tags)}, {w: i for i, w in enumerate(distinct)}
        pairs = sorted((place[r["keyword"]], number[r["category"], r["tag"]]) for r in got)
        first = np.searchsorted([w for w, _ in pairs], np.arange(len(distinct) + 1))
        sent = spark.sparkContext.broadcast((KeywordAutomaton([w.encode() for w in distinct]), first, np.array([t for _, t in pairs], np.int64), pa.array([{"category": c, "tag": t} for c, t in tags], pa.struct([("category", pa.string()), ("tag", pa.string())]))))

        def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton, first, tag_of, names = sent.value
            for frame in frames:
                for batch in _slices(frame):
                    row, word = automaton.found(*_bytes(batch.column(2)))
                    n = first[word + 1] - first[word]
                    own = np.repeat(first[word] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    both = np.unique(np.repeat(row, n) * max(len(names), 1) + tag_of[own])
                    row, tag = np.divmod(both, max(len(names), 1))
                    new = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32()), names.take(pa.array(tag)))
                    yield pa.RecordBatch.from_arrays([*batch.columns, new], names=[key, "_tags", "_flat", "_more"])

        return run

    for part in range(parts if size else 0):
        tagged = tagged.mapInArrow(reader(part), schema).select(key, F.array_union("_tags", "_more").alias("_tags"), "_flat")
    return tagged.select(key, F.explode("_tags").alias("_t")).select(key, "_t.category", "_t.tag")
