"""Token-id files of directly addressable codes: any token is read without decoding a block."""

from __future__ import annotations

import hashlib
import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import CACHES, batches_of, enter, get_file, materialize, new_folder, open_store, parallelism, prefix_sums, put_file, text_bytes

MAGIC = b"DACIDS01"
#: Bits of a chunk, and bits between two entries of a level's rank directory.
CHUNK_BITS, RANK_STEP = 8, 512
#: Tokens after which a file is closed, and the id that ends a document.
FILE_TOKENS, END_ID = 4 << 20, 2


# ---------------------------------------------------------------- codes

class Codes:
    """A sequence of non-negative ids: level k holds the k-th 8-bit chunk of those ids that have one, with a bitmap of
    which go on to the next level and, every RANK_STEP bits, the number of ones before."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int):
        self.levels, self.n = levels, n

    @classmethod
    def encode(cls, ids: np.ndarray) -> Codes:
        rest, levels = np.asarray(ids), []
        while True:
            more = rest > 0xFF
            ones = np.add.reduceat(more.astype(np.uint32), np.arange(0, len(more), RANK_STEP)) if len(more) else np.zeros(0, np.uint32)
            rank = np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])
            levels.append((rest.astype(np.uint8), np.packbits(more), rank))
            rest = rest[more] >> CHUNK_BITS
            if not len(rest):
                return cls(levels, len(ids))

    def decode(self, start: int, end: int) -> np.ndarray:
        """Ids start .. end - 1; only their own chunks are touched."""
        if not 0 <= start <= end <= self.n:
            raise IndexError(f"{start}:{end} of {self.n}")
        out = np.zeros(end - start, np.uint64)
        where = slice(None)
        for k, (chunks, bitmap, rank) in enumerate(self.levels):
            out[where] |= chunks[start:end].astype(np.uint64) << np.uint64(CHUNK_BITS * k)
            base = start // RANK_STEP * RANK_STEP  # from the directory's entry on, bits are counted
            bits = np.unpackbits(bitmap[base // 8 : -(-end // 8)])[: end - base]
            own = np.flatnonzero(bits[start - base :])
            if not len(own):
                break
            start = int(rank[base // RANK_STEP]) + int(bits[: start - base].sum())
            end = start + len(own)
            where = own if isinstance(where, slice) else where[own]
        return out.astype(np.uint32) if len(self.levels) <= 4 else out

    def dump(self) -> bytes:
        parts = [struct.pack("<QI", self.n, len(self.levels))]
        for chunks, bitmap, rank in self.levels:
            parts += [struct.pack("<QQQ", len(chunks), len(bitmap), len(rank)), chunks.tobytes(), bitmap.tobytes(), rank.astype("<u4").tobytes()]
        return b"".join(parts)

    @classmethod
    def load(cls, body: bytes, at: int = 0) -> Codes:
        n, depth = struct.unpack_from("<QI", body, at)
        at, levels = at + 12, []
        for _ in range(depth):
            sizes = struct.unpack_from("<QQQ", body, at)
            at, got = at + 24, []
            for size, kind in zip(sizes, ("u1", "u1", "<u4"), strict=True):
                got.append(np.frombuffer(body, kind, size, at))
                at += got[-1].nbytes
            levels.append(tuple(got))
        return cls(levels, n)


def dump_file(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    """A file: magic, number of documents, their ids (and which are null), n + 1 starts, then the codes."""
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d if d is not None else 0 for d in doc_ids], "<i8")
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
    return MAGIC + struct.pack("<Q", len(doc_ids)) + numbers.tobytes() + known.tobytes() + starts.tobytes() + Codes.encode(ids).dump()


def load_file(body: bytes) -> tuple[list, np.ndarray, Codes]:
    if body[:8] != MAGIC:
        raise ValueError("not a file of token ids")
    (n,) = struct.unpack_from("<Q", body, 8)
    numbers = np.frombuffer(body, "<i8", n, 16).tolist()
    known = np.frombuffer(body, "u1", n, 16 + 8 * n)
    starts = np.frombuffer(body, "<i8", n + 1, 16 + 9 * n)
    return [d if k else None for d, k in zip(numbers, known, strict=True)], starts, Codes.load(body, 24 + 17 * n)


class TokenFile:
    """A file of token ids, read by ranges: of any document, only the bytes that its ids need."""

    def __init__(self, uri: str, name: str):
        fs, path = open_store(uri)
        self.file = fs.open_input_file(f"{path}/{name}")
        if self._read(0, 8) != MAGIC:
            raise ValueError("not a file of token ids")
        (self.documents,) = struct.unpack("<Q", self._read(8, 8))
        at = 24 + 17 * self.documents
        _, depth = struct.unpack("<QI", self._read(at, 12))
        at, self.levels = at + 12, []
        for _ in range(depth):
            sizes = struct.unpack("<QQQ", self._read(at, 24))
            starts = (at + 24, at + 24 + sizes[0], at + 24 + sizes[0] + sizes[1])
            self.levels.append(starts)
            at = starts[2] + 4 * sizes[2]

    def _read(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def tokens(self, document: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids first … last - 1 (to its end) of the document at that place in the file."""
        if not 0 <= document < self.documents:
            raise IndexError(document)
        low, high = struct.unpack("<qq", self._read(16 + 9 * self.documents + 8 * document, 16))
        start, end = low + first, high if last is None else min(low + last, high)
        if not low <= start <= end:
            raise IndexError(f"{first}:{last} of {high - low}")
        out = np.zeros(end - start, np.uint64)
        where = np.arange(end - start)
        for k, (chunks, bitmap, rank) in enumerate(self.levels):
            out[where] |= np.frombuffer(self._read(chunks + start, end - start), np.uint8).astype(np.uint64) << np.uint64(CHUNK_BITS * k)
            base = start // RANK_STEP * RANK_STEP
            bits = np.unpackbits(np.frombuffer(self._read(bitmap + base // 8, -(-end // 8) - base // 8), np.uint8))[: end - base]
            own = np.flatnonzero(bits[start - base :])
            if not len(own):
                break
            start = struct.unpack("<I", self._read(rank + 4 * (base // RANK_STEP), 4))[0] + int(bits[: start - base].sum())
            end, where = start + len(own), where[own]
        return out.astype(np.uint32) if len(self.levels) <= 4 else out

    def close(self) -> None:
        self.file.close()


# ---------------------------------------------------------------- encoding by the library

class CachedEncoder:
    """The library's ids of whole texts, for byte-level BPE with GPT-2's splitting: each distinct unit is encoded once.

    A unit is a run without spaces and line ends, with the one before it, if any. Where a text has only single spaces
    and line ends between such runs, the library never merges across units. Other texts, and those with a special
    token's string, are encoded whole. Two generations of units are kept, LIMIT each at most.
    """

    LIMIT = 500_000
    #: Units that are new are encoded so many at a time.
    RUN = 256

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        splits = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or splits.get("type") != "ByteLevel" or splits.get("add_prefix_space") or not splits.get("use_regex", True) or spec["model"].get("type") != "BPE":
            raise ValueError(f"{path} isn't a byte-level tokenizer that splits words and changes no text")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.widths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)  # a character stands for a byte
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def irregular(self, body: np.ndarray, offsets: np.ndarray, gaps: np.ndarray) -> np.ndarray:
        """Which texts have white space other than single spaces and line ends inside them, or a special string."""
        at = [np.flatnonzero(((body >= 9) & (body <= 13) & (body != 10)) | ((body >= 0x1C) & (body <= 0x1F)))]
        padded = np.concatenate([body, np.zeros(2, np.uint8)])
        for lead, tails in ((0xC2, ((0x85, None), (0xA0, None))), (0xE1, ((0x9A, {0x80}),)), (0xE2, ((0x80, {*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF}), (0x81, {0x9F}))), (0xE3, ((0x80, {0x80}),))):
            here = np.flatnonzero(body == lead)
            for second, thirds in tails:
                found = here[padded[here + 1] == second]
                at.append(found if thirds is None else found[np.isin(padded[found + 2], list(thirds))])
        where = np.flatnonzero(gaps)
        some = offsets[:-1][np.diff(offsets) > 0]
        at += [where[:-1][np.diff(where) == 1], some[gaps[some]], offsets[1:][np.diff(offsets) > 0] - 1]
        at[-1] = at[-1][gaps[at[-1]]]
        view = body.tobytes()
        for s in self.special:
            i = view.find(s)
            while i >= 0:
                at.append(np.array([i]))
                i = view.find(s, i + 1)
        out = np.zeros(len(offsets) - 1, bool)
        out[np.searchsorted(offsets, np.concatenate(at), side="right") - 1] = True
        return out

    def look_up(self, units: list[bytes]) -> list[bytes]:
        if len(self.young) > self.LIMIT:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        found = list(map(young.get, units))
        missing = [i for i, v in enumerate(found) if v is None]
        need = []
        for i in missing:
            if (v := old.get(units[i])) is not None:
                young[units[i]] = found[i] = v
            else:
                need.append(i)
        # units that begin with a space or line end can follow one another in one text; ids have known numbers of bytes
        runs = [i for i in need if units[i][:1] in b" \n"]
        for at in range(0, len(runs), self.RUN):
            own = runs[at : at + self.RUN]
            ids = np.array(self.tokenizer.encode_batch_fast([b"".join([units[i] for i in own]).decode()], add_special_tokens=False)[0].ids, np.int64)
            cuts = np.searchsorted(np.cumsum(self.widths[ids]), np.cumsum([len(units[i]) for i in own])) + 1
            raw = ids.astype(self.kind).tobytes()
            cuts = [0, *(cuts * self.kind.itemsize).tolist()]
            for i, a, b in zip(own, cuts, cuts[1:]):
                young[units[i]] = found[i] = raw[a:b]
        alone = [i for i in need if found[i] is None]
        for i, e in zip(alone, self.tokenizer.encode_batch_fast([units[i].decode() for i in alone], add_special_tokens=False), strict=True):
            young[units[i]] = found[i] = np.array(e.ids, self.kind).tobytes()
        return found

    def encode(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that stand end to end in body, and the n + 1 offsets of each text's ids."""
        gaps = (body == 32) | (body == 10)
        odd = self.irregular(body, offsets, gaps)
        cut = gaps
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(body))), pa.py_buffer(body)])
        upto = np.searchsorted(starts, offsets)
        if odd.any():
            regular = np.repeat(~odd, np.diff(upto))
            units = units.filter(pa.array(regular))
            upto = np.concatenate([[0], np.cumsum(np.where(odd, 0, np.diff(upto)))])
        coded = units.dictionary_encode()
        index = coded.indices.to_numpy()
        values = self.look_up(coded.dictionary.to_pylist())
        table = np.frombuffer(b"".join(values), self.kind)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.kind.itemsize
        base = (np.cumsum(sizes) - sizes)[index]
        size = sizes[index]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = table[np.repeat(base - total[:-1], size) + np.arange(total[-1])]
        tokens = total[upto]
        if odd.any():
            parts = [ids[tokens[i] : tokens[i + 1]] for i in range(len(odd))]
            for i in np.flatnonzero(odd):
                text = body[offsets[i] : offsets[i + 1]].tobytes().decode()
                parts[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)
            ids, tokens = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, tokens


_ENCODERS: dict[str, CachedEncoder] = {}
CACHES.append(_ENCODERS)


def encoder(path: str) -> CachedEncoder:
    """One for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = CachedEncoder(path)
    return _ENCODERS[path]


# ---------------------------------------------------------------- tables

FILES = "pid int, seq int, file string, docs long, tokens long, bytes long"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, *, end_id: int = END_ID) -> DataFrame:
    """Encode docs(doc_id, text) into files in folder, in ascending doc_id order over all files; a written table FILES.

    Rows are dealt by ranges of (doc_id, hash of the text), so that one id with many rows is spread too; equal ids
    stand in order of that hash. Null doc_id: first; null text: empty, so the end id alone. Each file is named by its
    content and put in place whole; readers take the files of the returned table only. An empty table gives no file.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("tie", F.xxhash64("text"))
    n = parallelism(docs.sparkSession)
    d = d.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def write(frames):
        enter("tokens")
        enc, pid = encoder(tokenizer), TaskContext.get().partitionId()
        doc_ids, lengths, parts, held, seq = [], [], [], 0, 0

        def close():
            body = dump_file(doc_ids, lengths, np.concatenate(parts))
            name = f"{pid:06d}-{seq:06d}-{hashlib.sha256(body).hexdigest()[:16]}.dac"
            put_file(folder, name, body)
            row = (pid, seq, name, len(doc_ids), held, len(body))
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[f.split()[0] for f in FILES.split(", ")])

        for frame in batches_of(frames, 4 << 20):
            ids, at = enc.encode(*text_bytes(frame.column(1)))
            parts.append(np.insert(ids, at[1:], end_id))
            lengths += (np.diff(at) + 1).tolist()
            doc_ids += frame.column(0).to_pylist()
            held += len(parts[-1])
            if held >= FILE_TOKENS:
                yield close()
                doc_ids, lengths, parts, held, seq = [], [], [], 0, seq + 1
        if doc_ids:
            yield close()

    return materialize(d.mapInArrow(write, FILES), "token-files")


def read_documents(files: DataFrame, folder: str, each=None, schema: str = "ids_crc32 long") -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, and what each(ids) gives.

    each: ids as unsigned 32-bit integers to one value of schema's type; by default their CRC-32, little-endian.
    """
    each = each or (lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))
    placed = prefix_sums(files, [F.col("pid"), F.col("seq")], {"upto": F.col("tokens")})
    placed = placed.select("file", (F.col("upto") - F.col("tokens")).alias("base")).repartition(parallelism(files.sparkSession))
    kind = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[schema.split()[1]]

    def read(frames):
        enter("tokens")
        for frame in frames:
            for name, base in zip(frame.column(0).to_pylist(), frame.column(1).to_pylist(), strict=True):
                doc_ids, starts, codes = load_file(get_file(folder, name))
                values = [each(codes.decode(int(a), int(b))) for a, b in zip(starts, starts[1:])]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(base + starts[:-1]), pa.array(np.diff(starts)), pa.array(values, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", schema.split()[0]])

    return placed.mapInArrow(read, f"doc_id long, start long, n_tokens long, {schema}")


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark, "tokens")
    files = write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(files, folder)
