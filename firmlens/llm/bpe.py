"""BPE encoding and decoding: a priority queue of merge ranks over a doubly linked symbol list."""

from __future__ import annotations

import heapq
import json
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import CACHES, batches_of, enter, find_package


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 bytes stand for
    themselves, the others for code points from 256 on, in order."""
    own = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordBPE:
    """The encoder that a tokenizer file of kind BPE with an end-of-word suffix describes.

    Text: special strings are cut out first; NFC, lower case per character; words by the pattern, all else dropped;
    bytes as printable characters; merges by rank, leftmost first among equals.
    """

    WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+").findall
    #: What of a tokenizer file decides how text becomes words, and words ids; other files are refused.
    KIND = {
        "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
        "decoder": None}
    MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "byte_fallback": None, "ignore_merges": None}
    #: Two generations of distinct words are kept, so many each at most.
    LIMIT = 60_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        others = [k for k, v in self.KIND.items() if spec.get(k) != v] + [f"model.{k}" for k, v in self.MODEL.items() if (model.get(k) or None) != v]
        if others:
            raise ValueError(f"{path} isn't a tokenizer of this kind: {', '.join(others)}")
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.vocab | self.special).items()}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.bytes = byte_alphabet()
        self.cut = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, word: str) -> list[int]:
        """Ids of one word. The queue holds (rank, position, left, right, merged); an entry whose symbols have since been
        merged into others is stale and skipped."""
        chars = [self.bytes[b] for b in word.encode("utf-8")]
        if not chars:
            return []
        chars[-1] += self.suffix
        ids = [i for c in chars if (i := self.vocab.get(c)) is not None]
        n = len(ids)
        if n < 2:
            return ids
        before, after, merges = list(range(-1, n - 1)), [*range(1, n), -1], self.merges
        queue = [(*m, i) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        queue = [(rank, i, ids[i], ids[i + 1], to) for rank, to, i in queue]
        heapq.heapify(queue)
        while queue:
            _, i, left, right, to = heapq.heappop(queue)
            j = after[i]
            if j < 0 or ids[i] != left or ids[j] != right:
                continue
            ids[i], ids[j], k = to, -1, after[j]
            after[i] = k
            if k >= 0:
                before[k] = i
                if m := merges.get((to, ids[k])):
                    heapq.heappush(queue, (m[0], i, to, ids[k], m[1]))
            h = before[i]
            if h >= 0 and (m := merges.get((ids[h], to))):
                heapq.heappush(queue, (m[0], h, ids[h], to, m[1]))
        return [i for i in ids if i >= 0]

    def decode(self, ids) -> str:
        """The vocabulary strings one after another; the file names no decoder, so with spaces between."""
        strings = self.strings
        return " ".join([strings[i] for i in ids if i in strings])

    def words(self, text: str) -> list[str]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return self.WORDS(text.replace("Σ", "σ").lower())

    def pieces(self, text: str) -> list[str]:
        """Words and special strings, in order; a special string never equals a word, for words are lower case."""
        if "<|" not in text or not self.cut.search(text):
            return self.words(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [*self.words(text[at : m.start()]), "\0" + m[0]]
            at = m.end()
        return out + self.words(text[at:])

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Per text its ids as little-endian 32-bit integers, and their decoded string."""
        units = [self.pieces(t) for t in texts]
        flat = list(chain.from_iterable(units))
        if len(self.young) > self.LIMIT:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        found = list(map(young.get, flat))
        for i in [i for i, v in enumerate(found) if v is None]:
            u = flat[i]
            v = young.get(u)
            if v is None:
                v = old.get(u)
                if v is None:
                    ids = [self.special[u[1:]]] if u[0] == "\0" and u[1:] in self.special else self.merge(u)
                    v = np.array(ids, "<u4").tobytes()
                young[u] = v
            found[i] = v
        out, at = [], 0
        for u in units:
            ids = b"".join(found[at : at + len(u)])
            at += len(u)
            out.append((ids, self.decode(np.frombuffer(ids, "<u4").tolist())))
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0][0], "<u4").tolist()


#: Bytes of texts that are encoded at a time.
SLICE = 1 << 18

_MODELS: dict[str, WordBPE] = {}
CACHES.append(_MODELS)


def model(path: str) -> WordBPE:
    """One for each worker process."""
    if path not in _MODELS:
        _MODELS[path] = WordBPE(path)
    return _MODELS[path]


def bpe_encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """docs(doc_id, text) to doc_id, n_tokens, ids (little-endian 32-bit), decoded. One pass, no shuffle.

    Null text: empty, so no tokens and the empty string. Whole texts of any length; a word is encoded once per worker
    while it is kept. Repeated rows and null ids: a row each, as they came. An empty table gives no rows; further columns
    are not read.
    """
    find_package(docs.sparkSession)

    def run(frames):
        enter("bpe")
        bpe = model(tokenizer)
        for frame in batches_of(frames, SLICE):
            got = bpe.encode_batch([t or "" for t in frame.column(1).to_pylist()])
            ids = [a for a, _ in got]
            keys = frame.column(0).take(pa.array(range(frame.num_rows)))  # a copy: a column of the frame would hold its whole batch
            del frame
            columns = [keys, pa.array([len(a) // 4 for a in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([b for _, b in got], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def with_digests(encoded: DataFrame) -> DataFrame:
    """bpe_encode_decode's rows with the SHA-256 digests of the ids and of the text."""
    return encoded.withColumns({"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256)})


def op10_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encoded = bpe_encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
    return with_digests(encoded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
