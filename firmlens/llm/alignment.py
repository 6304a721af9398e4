"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same text, and how often pairs of ids meet."""

from __future__ import annotations

import hashlib
import io
import os
import re
import uuid
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.bpe import byte_alphabet
from firmlens.llm.common import batches_of, enter, find_package, get_file, materialize, new_folder, put_file, release_memory, text_bytes

#: Bytes of text of a block, and of the slices in which texts are read.
BLOCK, SLICE = 16 << 20, 1 << 20
#: New units that are encoded at a time; links of a group above which equal ids are counted before they are paired.
RUN, MANY = 4096, 1 << 12

#: Where neither tokenizer can join what stands on both sides: before a single space or line end between other characters.
_SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)")


# ---------------------------------------------------------------- groups of tokens

def overlap_groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of two sequences over the same bytes the number of its group, by order in the text.

    Tokens are nodes of a bipartite graph with an edge where byte ranges overlap; union-find joins them: roots hook to
    smaller ones over all edges at once, and paths are halved until they are flat. Its connected components are the smallest
    groups that begin and end together.
    """
    n = len(a_ends)
    ends = np.union1d(a_ends, b_ends)  # what lies before one of these, behind the last, is in one token of each
    left, right = np.searchsorted(a_ends, ends), n + np.searchsorted(b_ends, ends)
    root = np.arange(n + len(b_ends))
    while True:
        x, y = root[left], root[right]
        apart = x != y
        if not apart.any():
            break
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root = root[root]
    first, of_a = np.unique(root[:n], return_inverse=True)
    return of_a, np.searchsorted(first, root[n:])


def bipartite(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All links of groups' members as (pair of ids, how often, group), by group. Small groups are listed link by link, in a
    large one equal ids are counted first."""
    groups = int(of_a[-1]) + 1
    na, nb = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
    at_a, at_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    large = na * nb > MANY
    n = np.where(large, 0, na * nb)
    group = np.repeat(np.arange(groups), n)
    nth = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    pairs = a[at_a[group] + nth // nb[group]] << 32 | b[at_b[group] + nth % nb[group]]
    times = np.ones(len(pairs), np.int64)
    if not large.any():
        return pairs, times, group
    parts = [(pairs, times, group)]
    for g in np.flatnonzero(large):
        x, m = np.unique(a[at_a[g] : at_a[g] + na[g]], return_counts=True)
        y, k = np.unique(b[at_b[g] : at_b[g] + nb[g]], return_counts=True)
        parts.append(((x[:, None] << 32 | y).reshape(-1), (m[:, None] * k).reshape(-1), np.full(len(x) * len(y), g)))
    pairs, times, group = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(group, kind="stable")
    return pairs[order], times[order], group[order]


class Units:
    """What is known of some units: whether their tokens' bytes are their own, numbers (tokens of both, groups, links), groups as
    text, and the id pairs of their links with how often each stands there (n + 1 offsets)."""

    def __init__(self, n: int):
        self.good, self.counts, self.groups = np.zeros(n, bool), np.zeros((n, 4), np.int64), [""] * n
        self.pairs: list[np.ndarray] = [np.zeros(0, np.int64)] * n
        self.times: list[np.ndarray] = [np.zeros(0, np.int64)] * n


class Aligner:
    """Both tokenizers, unit by unit. A text with the space before it is cut at every place where neither can join across
    (checked against both files), and each distinct unit is encoded once a block."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True  # their strings in texts are text
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        code = {c: i for i, c in enumerate(byte_alphabet())}
        self.a_bytes = [bytes(code[c] for c in s) if (s := self.a.id_to_token(i)) and all(c in code for c in s) else (s or "").encode() for i in range(self.a.get_vocab_size())]
        strings = [self.b.id_to_piece(i) for i in range(len(self.b))]
        self.b_bytes = [bytes([int(s[3:5], 16)]) if self.b.is_byte(i) else s.replace("▁", " ").encode() for i, s in enumerate(strings)]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.spelled = [f"{i}{mark}" for i in range(max(len(self.a_bytes), len(self.b_bytes))) for mark in ",|;"]
        self.spelled_sizes = np.array(list(map(len, self.spelled)), np.int64)
        self.check(byte_level, pieces, strings)

    def check(self, byte_level: str, pieces: str, strings: list[str]) -> None:
        """Refuse files that join where units are cut, or that change the text before it is cut."""
        import json

        spec = json.loads(self.a.to_str())
        before = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError(f"{byte_level}: a byte-level tokenizer that splits words and changes no text is asked for")
        crossing = [s for i, s in enumerate(strings) if not self.b.is_byte(i) and ("\n" in s or "▁" in s.lstrip("▁"))]
        if crossing or self.b.encode("ﬁ  x\n", out_type=str)[0][:1] != "▁" or bytes().join(self.b_bytes[i] for i in self.b.encode("ﬁ  x\n")) != " ﬁ  x\n".encode():
            raise ValueError(f"{pieces}: pieces that begin with their only spaces, a leading space and unchanged text are asked for")

    def units(self, text: str) -> list[str]:
        """The units of a space and a text that isn't empty. A regular unit is a word after a space (here without it) or
        after a line end (here with it); others begin with a space or line end of their own."""
        plain = text.replace("\n", " ")
        if " ".join(plain.split()) == plain and "▁" not in text:
            return text.replace("\n", " \n").split(" ")
        out = []
        for u in _SAFE.split(" " + text):
            out.append(u[1:] if u[0] == " " and u[1:].split() == [u[1:]] else u)
        return out

    def align(self, units: list[str]) -> Units:
        """Of each unit its groups. Regular units are encoded in runs, as one text, others each on its own."""
        out = Units(len(units))
        fit = [i for i, u in enumerate(units) if "▁" not in u and (w := u[1:] if u[0] == "\n" else u) and w.split() == [w]]
        alone = sorted(set(range(len(units))) - set(fit))
        todo = [[i] for i in alone] + [fit[k : k + RUN] for k in range(0, len(fit), RUN)]
        while todo:
            run = todo.pop()
            if not self.align_run([u if u[0] in " \n" else " " + u for u in map(units.__getitem__, run)], run, out) and len(run) > 1:
                todo += [run[: len(run) // 2], run[len(run) // 2 :]]
        return out

    def align_run(self, texts: list[str], run: list[int], out: Units) -> bool:
        """Whether the tokens' bytes are the texts'; then out has what is known of these."""
        text = "".join(texts)
        body = text.encode()
        lead = text[0] != " "  # the second tokenizer puts a space of its own before the text
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text if lead else text[1:], num_threads=1)
        if lead:
            b = b[1:] if b and self.b_bytes[b[0]] == b" " else []
        if b"".join([self.a_bytes[i] for i in a]) != body or b"".join([self.b_bytes[i] for i in b]) != body:
            return False
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_ends = np.cumsum(self.a_sizes[a])
        of_a, of_b = overlap_groups(a_ends, np.cumsum(self.b_sizes[b]))
        groups = int(of_a[-1]) + 1
        na, nb = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        of_group = np.searchsorted(np.cumsum([len(t.encode()) for t in texts]), a_ends[np.cumsum(na) - 1])  # its unit
        n = len(run)
        numbers = [np.bincount(of_group, w, n) for w in (na, nb, np.ones(groups), na * nb)]
        out.counts[run] = np.stack(numbers, axis=1).astype(np.int64)
        out.good[run] = True
        # as text: each id with what follows it: a comma, a bar behind the last of the first side, a semicolon behind the group
        order = np.lexsort((np.repeat([0, 1], [len(a), len(b)]), np.concatenate([of_a, of_b])))
        last_a, last_b = np.cumsum(na + nb) - nb - 1, np.cumsum(na + nb) - 1
        mark = np.zeros(len(order), np.int64)
        mark[last_a], mark[last_b] = 1, 2
        index = np.concatenate([a, b])[order] * 3 + mark
        said = "".join(map(self.spelled.__getitem__, index.tolist()))
        ends = np.cumsum(self.spelled_sizes[index])[last_b]
        cuts = [0, *ends[np.searchsorted(of_group, np.arange(n), side="right") - 1].tolist()]
        pairs, times, group = bipartite(a, b, of_a, of_b)
        bounds = np.searchsorted(of_group[group], np.arange(n + 1)).tolist()
        for k, i in enumerate(run):
            out.groups[i] = said[cuts[k] : cuts[k + 1] - 1]
            out.pairs[i], out.times[i] = pairs[bounds[k] : bounds[k + 1]], times[bounds[k] : bounds[k + 1]]
        return True


# ---------------------------------------------------------------- blocks

class Block:
    """Documents of a task: their distinct units, the distinct pairs of ids of these, and which document has which units."""

    def __init__(self, aligner: Aligner):
        self.aligner, self.bytes = aligner, 0
        self.codes: dict[str, int] = {}
        self.groups: list[str] = []
        self.good, self.counts = np.zeros(0, bool), np.zeros((0, 4), np.int64)
        self.known, self.known_codes = np.zeros(0, np.int64), np.zeros(0, np.int64)  # pairs in order, and their codes
        self.pairs, self.times, self.bounds = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)  # of units, codes of pairs
        self.documents = np.zeros(0, np.int64)  # of each pair, documents that hold it
        self.ids: list = []
        self.rows: list[tuple] = []
        self.bags: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # of a slice's documents: units, occurrences, sizes

    def pair_codes(self, pairs: np.ndarray) -> np.ndarray:
        """Numbers of pairs, new ones counted on."""
        distinct, which = np.unique(pairs, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        new = self.known[at] != distinct if len(self.known) else np.ones(len(distinct), bool)
        codes = np.zeros(len(distinct), np.int64)
        codes[~new] = self.known_codes[at[~new]]
        codes[new] = len(self.known) + np.arange(int(new.sum()))
        known, numbers = np.concatenate([self.known, distinct[new]]), np.concatenate([self.known_codes, codes[new]])
        order = np.argsort(known, kind="stable")
        self.known, self.known_codes = known[order], numbers[order]
        return codes[which]

    def learn(self, units: list[str]) -> None:
        new = [u for u in dict.fromkeys(units) if u not in self.codes]
        if not new:
            return
        got = self.aligner.align(new)
        self.codes.update(zip(new, range(len(self.codes), len(self.codes) + len(new)), strict=True))
        self.groups += got.groups
        self.good, self.counts = np.concatenate([self.good, got.good]), np.concatenate([self.counts, got.counts])
        self.pairs = np.concatenate([self.pairs, self.pair_codes(np.concatenate(got.pairs))])
        self.times = np.concatenate([self.times, *got.times])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(list(map(len, got.pairs)))])

    def add(self, ids: list, texts: list[str | None]) -> None:
        split = [self.aligner.units(t) if t else [] for t in texts]
        self.bytes += sum(len(t or "") for t in texts)
        flat = list(chain.from_iterable(split))
        self.learn(flat)
        unit = np.fromiter(map(self.codes.__getitem__, flat), np.int64, len(flat))
        doc = np.repeat(np.arange(len(texts)), list(map(len, split)))
        whole = np.ones(len(texts), bool)
        whole[doc[~self.good[unit]]] = False  # a text that doesn't come back whole has no tokens
        unit, doc = unit[whole[doc]], doc[whole[doc]]
        sums = [np.bincount(doc, self.counts[unit, k], len(texts)).astype(np.int64).tolist() for k in range(4)]
        cuts = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
        said = list(map(self.groups.__getitem__, unit.tolist()))
        digests = [hashlib.sha256(";".join(said[i:j]).encode()).hexdigest() if j > i else "" for i, j in zip(cuts, cuts[1:])]
        self.ids += ids
        self.rows += zip(*sums, digests, strict=True)
        key, times = np.unique(doc << 32 | unit, return_counts=True)
        doc, unit = key >> 32, key & 0xFFFFFFFF
        self.bags.append((unit.astype(np.uint32), times.astype(np.uint32), np.bincount(doc, minlength=len(texts)).astype(np.uint32)))
        low = self.bounds[unit]
        n = self.bounds[unit + 1] - low
        where = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        seen = np.unique(np.repeat(doc, n) << 32 | self.pairs[where]) & 0xFFFFFFFF
        more = np.bincount(seen, minlength=len(self.known))
        more[: len(self.documents)] += self.documents
        self.documents = more

    def pair_values(self) -> np.ndarray:
        """The pairs by code."""
        out = np.zeros(len(self.known), np.int64)
        out[self.known_codes] = self.known
        return out

    def dump(self) -> bytes:
        """All that the second pass needs, as one compressed Arrow file."""
        columns = {
            "unit_pairs": self.pairs.astype(np.uint32), "unit_times": self.times, "unit_sizes": np.diff(self.bounds).astype(np.uint32),
            **{name: np.concatenate([b[i] for b in self.bags]) if self.bags else np.zeros(0, np.uint32) for i, name in enumerate(("units", "times", "sizes"))},
            "pairs": self.pair_values(),
        }
        lists = pa.RecordBatch.from_arrays([pa.array([v], pa.list_(pa.from_numpy_dtype(v.dtype))) for v in columns.values()], names=list(columns))
        rows = list(zip(*self.rows)) or [()] * 5
        table = pa.RecordBatch.from_arrays([pa.array(self.ids, pa.int64()), *[pa.array(c, pa.int64()) for c in rows[:4]], pa.array(rows[4], pa.string())], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
        out = []
        for batch in (lists, table):
            sink = io.BytesIO()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(batch)
            out.append(sink.getvalue())
        return len(out[0]).to_bytes(8, "little") + out[0] + out[1]


def load(body: bytes) -> tuple[dict[str, np.ndarray], pa.Table]:
    cut = 8 + int.from_bytes(body[:8], "little")
    lists = pa.ipc.open_stream(body[8:cut]).read_all().combine_chunks()
    return {n: lists.column(n).chunk(0).values.to_numpy() for n in lists.column_names}, pa.ipc.open_stream(body[cut:]).read_all()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_level: str, pieces: str) -> Aligner:
    """One for each worker process."""
    key = (byte_level, pieces)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(byte_level, pieces)
    return _ALIGNERS[key]


def token_groups(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """docs(doc_id, text) to doc_id, groups: of each group in order the ids of both tokenizers, `a` and `b`. None for null and
    empty texts, and texts whose tokens' bytes aren't a space and the text. One pass, no shuffle; rows as they came."""
    find_package(docs.sparkSession)
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(frames):
        enter("align")
        both = aligner(byte_level, pieces)
        for frame in batches_of(frames, SLICE):
            out = []
            for text in frame.column(1).to_pylist():
                got = both.align(both.units(text) if text else [])
                whole = ";".join(got.groups) if got.good.all() else ""
                out.append([dict(zip("ab", [list(map(int, side.split(","))) for side in g.split("|")])) for g in whole.split(";") if g])
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(out, kind)], names=["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")


def align_documents(docs: DataFrame, byte_level: str, pieces: str) -> tuple[DataFrame, DataFrame]:
    """Of docs(doc_id, text): the table of id pairs (a_id, b_id, n_docs, best) and a row per document: doc_id, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256.

    Both tokenizers read a space and the text. Tokens are grouped by union-find over overlapping byte ranges, so a group
    is the smallest stretch where tokens of both end; every token of a group is linked with each of the other side's. A
    pair's n_docs is the number of documents that hold it linked; best: no pair of its a_id has more. n_best counts a
    document's links that are best, count_sum adds up n_docs over its links.

    1. Tasks align blocks of about BLOCK bytes: each distinct unit once. A block is written as a file (units of each
       document, pairs of each unit); its distinct pairs, with numbers of documents, are rows.
    2. Those rows are added up by pair, the most by a_id; joined back, each block gets the counts of its own pairs, opens
       its file and adds up by document. Texts are tokenized once and never shuffled.

    Null and empty texts, and those whose tokens' bytes aren't a space and the text, have no tokens: zeros and ''. Texts of
    any length are whole. Repeated rows and null ids: a row and a document each. An empty table gives no rows; further
    columns are not read.
    """
    spark = docs.sparkSession
    find_package(spark)
    folder = new_folder(spark, "aligned")

    def run(frames):
        enter("align")
        both = aligner(byte_level, pieces)
        block = Block(both)

        def close():
            name = uuid.uuid4().hex  # a task that runs again writes another file; only those in the written list are read
            put_file(folder, name, block.dump())
            pairs = block.pair_values()
            n = np.concatenate([block.documents, np.zeros(len(pairs) - len(block.documents), np.int64)])
            held = np.flatnonzero(n)  # none of those that only texts without tokens have
            pairs, n = np.append(pairs[held], -1), np.append(n[held], 0)  # one row at least, so that no block is lost
            for a in range(0, len(pairs), 1 << 16):
                own = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(pairs[own])), pa.array(pairs[own]), pa.array(n[own])], names=["block", "pair", "n"])

        for frame in batches_of(frames, SLICE):
            block.add(frame.column(0).to_pylist(), frame.column(1).to_pylist())
            if block.bytes >= BLOCK:
                yield from close()
                block = Block(both)
        if block.ids:
            yield from close()
        del block
        release_memory()

    held = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "block string, pair long, n long"), "pairs")
    counted = held.where("pair >= 0").groupBy("pair").agg(F.sum("n").alias("n_docs"))
    counted = materialize(counted.select(F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("pair").bitwiseAND((1 << 32) - 1).cast("int").alias("b_id"), "n_docs", "pair"), "counts")
    most = counted.groupBy(F.col("a_id").alias("_a")).agg(F.max("n_docs").alias("most"))
    pairs = materialize(counted.join(most, F.col("a_id") == F.col("_a")).select("a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"), "pair"), "best")
    known = pairs.select(F.col("pair").alias("_pair"), "n_docs", "best")
    told = held.select("block", "pair").join(known, F.col("pair") == F.col("_pair"), "left").select("block", "pair", "n_docs", "best")

    def finish(key, answers: pd.DataFrame) -> pd.DataFrame:
        enter("answers")
        lists, table = load(get_file(folder, key[0]))
        answers = answers[answers["pair"] >= 0].sort_values("pair")
        asked = answers["pair"].to_numpy(np.int64)
        at = np.searchsorted(asked, lists["pairs"])
        known = np.zeros(len(at), bool)
        known[at < len(asked)] = asked[at[at < len(asked)]] == lists["pairs"][at < len(asked)]
        n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        n[known], best[known] = answers["n_docs"].to_numpy(np.int64)[at[known]], answers["best"].to_numpy(bool)[at[known]]

        def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])
            ends = np.cumsum(sizes.astype(np.int64))
            return total[ends] - total[ends - sizes]

        unit = {k: sums(v[lists["unit_pairs"]] * lists["unit_times"], lists["unit_sizes"]) for k, v in (("n_best", best), ("count_sum", n))}
        out = table.to_pandas(integer_object_nulls=True)
        for k, v in unit.items():
            out[k] = sums(v[lists["units"]] * lists["times"], lists["sizes"]).astype("int64")
        release_memory()
        return out

    fields = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    done = told.groupBy("block").applyInPandas(finish, fields)
    return pairs.drop("pair"), done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))[1]
