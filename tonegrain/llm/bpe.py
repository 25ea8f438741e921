"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

A text is cut before each single space or line break that stands between two other
characters.  The pattern of the rank files never matches across such a cut, so the parts can
be encoded one by one, and each different part once per batch.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tonegrain.llm.common import pieces, ragged, released, texts_of

#: Entries of a worker's cache of parts, and bytes of a part that is kept in it.
CACHE_PARTS, CACHE_BYTES = 1 << 17, 48


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The bytes of each id of a rank file (base64 and rank on each line)."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * (max(int(r) for _, r in pairs) + 1)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


@lru_cache(maxsize=4)
def rank_tokenizer(path: str, pattern: str):
    """A tokenizer that merges as the ranks say: of all neighbours that form a token, the lowest rank first.

    Every way to cut a token into two tokens is one of its merges.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    tokens, chars = read_ranks(path), byte_characters()
    known = {t for t in tokens if t}
    spelled = {t: "".join([chars[b] for b in t]) for t in known}
    merges = [
        (spelled[t[:i]], spelled[t[i:]])
        for t in tokens for i in range(len(t) - 1, 0, -1) if t[:i] in known and t[i:] in known
    ]
    made = Tokenizer(models.BPE(vocab={spelled[t]: i for i, t in enumerate(tokens) if t}, merges=merges))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


#: Bytes of text that are encoded at once.
ENCODE_BYTES = 2 << 20


def cut_parts(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The parts of all texts behind one another, and each text's first part (n + 1 marks)."""
    joined = b"".join(texts)
    marks = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64))).astype(np.int64)
    b = np.frombuffer(joined, dtype=np.uint8)
    starts = marks[:-1][np.diff(marks) > 0]
    if len(b) > 2:
        at = np.flatnonzero(((b[1:-1] == 0x20) | (b[1:-1] == 0x0A)) & (b[:-2] > 0x20) & (b[2:] > 0x20)) + 1
        # White space beyond ASCII starts with one of these bytes; next to it nothing is cut.
        wide = np.zeros(256, dtype=bool)
        wide[[0xC2, 0xE1, 0xE2, 0xE3]] = True
        before = (b[at - 1] >= 0x80) & (wide[b[np.maximum(at - 2, 0)]] | wide[b[np.maximum(at - 3, 0)]])
        begins = np.zeros(len(b), dtype=bool)
        begins[starts] = True
        begins[at[~before & ~wide[b[at + 1]]]] = True
        starts = np.flatnonzero(begins)
    offsets = np.append(starts, len(b)).astype(np.int32)
    parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
    return parts, np.searchsorted(starts, marks)


def cut_words(texts: list[bytes], lower: bool) -> tuple[pa.Array, np.ndarray]:
    """Like ``cut_parts``, for tokenizers that drop white space.

    Cuts at ASCII white space, which goes, and between an ASCII letter and another ASCII
    character that is no apostrophe; ``lower`` folds A-Z first.
    """
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    marks = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64))).astype(np.int64)
    kind = _KINDS[joined]
    begins = np.ones(len(joined), dtype=bool)
    before, here = kind[:-1], kind[1:]
    begins[1:] = (before == 0) | (before == 1) & (here == 2) | (before == 2) & (here == 1)
    begins[marks[:-1][np.diff(marks) > 0]] = True
    solid = kind > 0
    starts = np.flatnonzero(begins & solid)
    kept = joined[solid]
    if lower:
        kept = kept + ((kept >= 65) & (kept <= 90)).astype(np.uint8) * np.uint8(32)
    offsets = np.append(np.flatnonzero(begins[solid]), len(kept)).astype(np.int32)
    parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept.tobytes())])
    return parts, np.searchsorted(starts, marks)


#: Kinds of bytes: 0 white space, 1 letter, 2 other ASCII, 3 apostrophe, 4 beyond ASCII.
_KINDS = np.full(256, 4, dtype=np.uint8)
_KINDS[:128] = 2
_KINDS[[9, 10, 11, 12, 13, 32]] = 0
_KINDS[[*range(65, 91), *range(97, 123)]] = 1
_KINDS[ord("'")] = 3


class PartEncoder:
    """Encodes texts part by part, each different part of a batch once."""

    def __init__(self, tokenizer):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = tokenizer
        self.known: dict[bytes, bytes] = {}

    def forget(self) -> None:
        self.known = {}

    def cut(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        return cut_parts(texts)

    def encode_new(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part as bytes, by the library."""
        encoded = self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in parts], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def _ids_of(self, parts: list[bytes]) -> list[bytes]:
        found = list(map(self.known.get, parts))
        new = [i for i, f in enumerate(found) if f is None]
        for k in range(0, len(new), 4096):
            some = new[k:k + 4096]
            for i, ids in zip(some, self.encode_new([parts[i] for i in some])):
                found[i] = ids
                if len(parts[i]) <= CACHE_BYTES:
                    self.known[parts[i]] = ids
        if len(self.known) > CACHE_PARTS:
            self.known.clear()
        return found

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind one another, and the marks of the texts."""
        parts, marks = self.cut(texts)
        coded = parts.dictionary_encode()
        lists = self._ids_of(coded.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(lists), dtype=np.uint32)
        offsets = np.concatenate(([0], np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)) // 4))).astype(np.int64)
        ids, lens = ragged(flat, offsets, coded.indices.to_numpy())
        return ids, np.concatenate(([0], np.cumsum(lens)))[marks]


class WordEncoder(PartEncoder):
    """For tokenizers that drop white space and mark the end of each word, like ``</w>``.

    New parts that are letters only go to the library many at a time, a space between them; the
    end marks tell their ids apart.  If the marks are not as many as the parts, they go singly.
    """

    GROUP = 64

    def __init__(self, tokenizer, end: str = "</w>"):
        super().__init__(tokenizer)
        self.lower = tokenizer.normalizer is not None and tokenizer.normalizer.normalize_str("Az") == "az"
        self.ends = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith(end)]] = True

    def cut(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        return cut_words(texts, self.lower)

    def encode_new(self, parts: list[bytes]) -> list[bytes]:
        words = [p.decode("utf-8", "replace") for p in parts]
        plain = [i for i, w in enumerate(words) if w.isalpha()]
        groups = [plain[k:k + self.GROUP] for k in range(0, len(plain), self.GROUP)]
        encoded = self.tokenizer.encode_batch_fast([" ".join([words[i] for i in g]) for g in groups], add_special_tokens=False)
        out: list[bytes | None] = [None] * len(parts)
        for group, e in zip(groups, encoded):
            ids = np.array(e.ids, dtype=np.uint32)
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(cuts) == len(group):
                raw, start = ids.tobytes(), 0
                for i, cut in zip(group, cuts.tolist()):
                    out[i], start = raw[start:cut], cut
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, super().encode_new([parts[i] for i in rest])):
            out[i] = ids
        return out


class Decoder:
    """Ids to bytes and text, by the byte table reversed."""

    def __init__(self, tokens: list[bytes]):
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens], dtype=np.int64))).astype(np.int64)

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return (self.offsets[1:] - self.offsets[:-1])[ids]

    def to_bytes(self, ids: np.ndarray) -> bytes:
        return ragged(self.flat, self.offsets, ids)[0].tobytes()

    def to_text(self, ids: np.ndarray) -> str:
        return self.to_bytes(ids).decode("utf-8", "replace")

    def stream(self, lists: Iterable[np.ndarray]) -> Iterator[str]:
        """Text of consecutive id lists; a character split between two comes with the later one."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in lists:
            yield decoder.decode(self.to_bytes(ids))
        if rest := decoder.decode(b"", True):
            yield rest


@lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str) -> PartEncoder:
    """A worker's encoder, built once."""
    return PartEncoder(rank_tokenizer(path, pattern))


@lru_cache(maxsize=4)
def rank_decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


def character_starts(text: bytes, byte_starts: np.ndarray) -> np.ndarray:
    """The character that holds each byte offset."""
    begins = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    return (np.cumsum(begins) - 1)[byte_starts]


def encode(docs: DataFrame, path: str, pattern: str, packed: bool = False) -> DataFrame:
    """(doc_id, ids, byte_starts, char_starts) of each row of ``docs`` (doc_id, text, ...).

    ``byte_starts`` and ``char_starts``: where each token begins; tokens inside one character
    share its place.  ``packed``: only (doc_id, ids), the ids as 32-bit little-endian bytes.
    A null text counts as empty and has no ids; repeated rows, null ids and other columns do
    not matter; long texts are encoded whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = rank_encoder(path, pattern), rank_decoder(path)
        encoder.forget()  # idle workers must not keep what other tasks have seen
        for batch in batches:
            for piece in pieces(batch, "text", ENCODE_BYTES):
                texts = texts_of(piece.column("text"))
                ids, marks = encoder.encode(texts)
                spans = list(zip(marks[:-1].tolist(), marks[1:].tolist()))
                doc_ids = piece.column("doc_id").cast(pa.int64())
                if packed:
                    columns = [doc_ids, pa.array([ids[a:b].tobytes() for a, b in spans], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])
                    continue
                lens = decoder.lengths(ids)
                starts = [np.cumsum(lens[a:b]) - lens[a:b] for a, b in spans]
                offsets = pa.array(marks, pa.int32())
                lists = [ids.astype(np.int32), *[np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int32) for x in (
                    starts, [character_starts(t, s) for t, s in zip(texts, starts)])]]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, *[pa.ListArray.from_arrays(offsets, pa.array(v)) for v in lists]],
                    ["doc_id", "ids", "byte_starts", "char_starts"])
        encoder.forget()

    schema = "doc_id long, ids binary" if packed else "doc_id long, ids array<int>, byte_starts array<int>, char_starts array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids): incomplete characters become U+FFFD; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = rank_decoder(path)
        for batch in batches:
            texts = [None if x is None else decoder.to_text(np.array(x, dtype=np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row: the texts encoded, and the ids decoded.

    ``keep_ids`` adds the ids as 32-bit little-endian bytes.  A null text counts as empty: no ids, and the
    digests of nothing.  Texts of any length are encoded whole.  Each row is encoded by itself, so repeated
    rows and rows of null or equal ids come out alike and as often as they are there.  An empty table gives no
    rows; columns other than doc_id and text are not looked at, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = rank_encoder(path, pattern), rank_decoder(path)
        encoder.forget()  # idle workers must not keep what other tasks have seen
        digits = [str(i) for i in range(len(decoder.offsets) - 1)]
        for batch in batches:
            for piece in pieces(batch, "text", ENCODE_BYTES):
                ids, marks = encoder.encode(texts_of(piece.column("text")))
                lists = [ids[a:b] for a, b in zip(marks[:-1].tolist(), marks[1:].tolist())]
                columns = [
                    piece.column("doc_id").cast(pa.int64()), pa.array([len(x) for x in lists], pa.int64()),
                    pa.array([hashlib.sha256(" ".join([digits[i] for i in x.tolist()]).encode()).hexdigest() for x in lists], pa.string()),
                    pa.array([hashlib.sha256(decoder.to_bytes(x)).hexdigest() for x in lists], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns, names = [*columns, pa.array([x.tobytes() for x in lists], pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)
        encoder.forget()

    # One Python step: two would be two workers for each task, and both keep their memory.
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(lambda batches: released(run(batches)), schema)
