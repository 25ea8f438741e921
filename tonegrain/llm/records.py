"""Token ids as length-delimited binary records, with an offset index beside them.

A record is framed like this, all numbers little-endian: length (8 bytes), masked CRC-32C of
the length (4), data, masked CRC-32C of the data (4).  The data is a flag byte (1: has a
document id; 2: 32-bit ids), the document id (8 bytes) and the token ids (2 or 4 bytes each).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tonegrain.llm.bpe import ENCODE_BYTES, WordEncoder
from tonegrain.llm.common import open_folder, pieces, shared_folder, temp_name, texts_of

FILE_BYTES = 256 << 20
_BLOCK = 512
_POLYNOMIAL = 0x82F63B78  # fixed value: Castagnoli, reflected
_MASK = 0xA282EAD8  # fixed value of the framing


# ---------------------------------------------------------------------- checksum
@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Tables for eight bytes at a time, and for skipping one block of zeros."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, (first >> 1) ^ np.uint32(_POLYNOMIAL), first >> 1).astype(np.uint32)
    tables = [first]
    for _ in range(7):
        tables.append(first[tables[-1] & 255] ^ (tables[-1] >> 8))
    eight = np.stack(tables)
    registers = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    zeros = np.zeros((_BLOCK // 4, len(registers)), dtype=np.uint32)
    return eight, _run(eight, registers, zeros).reshape(4, 256)


def _run(eight: np.ndarray, register: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Feed each register its column of 32-bit words."""
    for i in range(0, len(words), 2):
        x, y = words[i] ^ register, words[i + 1]
        register = (
            eight[7][x & 255] ^ eight[6][x >> 8 & 255] ^ eight[5][x >> 16 & 255] ^ eight[4][x >> 24]
            ^ eight[3][y & 255] ^ eight[2][y >> 8 & 255] ^ eight[1][y >> 16 & 255] ^ eight[0][y >> 24])
    return register


def crc32c(buffers: list[bytes]) -> np.ndarray:
    """CRC-32C of each buffer of four bytes or more, all buffers side by side.

    Zeros in front do not change a register of zero, so buffers are padded to whole blocks;
    the usual start value is the same as inverting the first four bytes.
    """
    if not buffers:
        return np.empty(0, dtype=np.uint32)
    eight, skip = _tables()
    blocks = np.array([-(-len(b) // _BLOCK) for b in buffers])
    ends = np.cumsum(blocks)
    data = np.zeros(int(ends[-1]) * _BLOCK, dtype=np.uint8)
    for b, end in zip(buffers, (ends * _BLOCK).tolist()):
        data[end - len(b):end] = np.frombuffer(b, dtype=np.uint8)
        data[end - len(b):end - len(b) + 4] ^= 255
    each = _run(eight, np.zeros(int(ends[-1]), dtype=np.uint32), np.ascontiguousarray(data.view(np.uint32).reshape(-1, _BLOCK // 4).T))
    crc = np.zeros(len(buffers), dtype=np.uint32)
    order = np.argsort(-blocks, kind="stable")
    starts, blocks = (ends - blocks)[order], blocks[order]
    for k in range(int(blocks[0])):
        n = int(np.searchsorted(-blocks, -k, side="left"))  # buffers of more than k blocks
        at = order[:n]
        moved = crc[at]
        crc[at] = skip[0][moved & 255] ^ skip[1][moved >> 8 & 255] ^ skip[2][moved >> 16 & 255] ^ skip[3][moved >> 24] ^ each[starts[:n] + k]
    return crc ^ np.uint32(0xFFFFFFFF)


def crc32c_of_lengths(lengths: np.ndarray) -> np.ndarray:
    """CRC-32C of each length as eight bytes."""
    words = lengths.astype("<u8").view("<u4").reshape(-1, 2).T.copy()
    words[0] ^= np.uint32(0xFFFFFFFF)
    return _run(_tables()[0], np.zeros(len(lengths), dtype=np.uint32), words) ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(_MASK)


# ----------------------------------------------------------------------- framing
def pack(doc_id: int | None, ids: np.ndarray, wide: bool) -> bytes:
    flags = (doc_id is not None) | (2 if wide else 0)
    return struct.pack("<Bq", flags, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()


def unpack(data: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = struct.unpack_from("<Bq", data)
    return doc_id if flags & 1 else None, np.frombuffer(data, dtype="<u4" if flags & 2 else "<u2", offset=9).astype(np.uint32)


def frame(records: list[bytes]) -> list[bytes]:
    lengths = np.array([len(r) for r in records], dtype="<u8")
    heads, tails = masked(crc32c_of_lengths(lengths)).astype("<u4"), masked(crc32c(records)).astype("<u4")
    return [b"".join((lengths[i].tobytes(), heads[i].tobytes(), r, tails[i].tobytes())) for i, r in enumerate(records)]


class DamagedRecord(ValueError):
    """A length or checksum does not hold."""


def check(frames: list[bytes], where: str) -> list[bytes]:
    """The data of whole frames, after both checksums."""
    if not frames:
        return []
    lengths = np.frombuffer(b"".join([f[:8] for f in frames]), dtype="<u8")
    data = [f[12:-4] for f in frames]
    heads, tails = masked(crc32c_of_lengths(lengths)).astype("<u4"), masked(crc32c(data)).astype("<u4")
    for i, f in enumerate(frames):
        if len(data[i]) != lengths[i] or f[8:12] != heads[i].tobytes() or f[-4:] != tails[i].tobytes():
            raise DamagedRecord(f"checksum of record {i} of {where}")
    return data


# ----------------------------------------------------------------------- writing
@lru_cache(maxsize=2)
def file_encoder(path: str) -> WordEncoder:
    """The tokenizer of a file; strings of its special tokens are ordinary text."""
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return WordEncoder(made)


_INDEX = "part int, file string, file_no int, doc_id long, offset long, length long, n_tokens long, start_in_file long"


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Tokenize ``docs`` in ascending doc_id order (null last), write record files, return the offset index.

    Rows travel once, to ranges of (doc_id, hash of the text).  Files of every attempt have new
    names; the index, written by Spark as ``folder/index``, names those that count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = file_encoder(tokenizer)
        encoder.forget()  # idle workers must not keep what other tasks have seen
        wide = encoder.tokenizer.get_vocab_size() > 1 << 16 or end_id >= 1 << 16
        system, path = open_folder(folder)
        system.create_dir(path, recursive=True)
        out, file_no, at, tokens = None, -1, 0, 0
        for batch in batches:
            for piece in pieces(batch, "text", ENCODE_BYTES):
                ids, marks = encoder.encode(texts_of(piece.column("text")))
                lists = [np.append(ids[a:b], np.uint32(end_id)) for a, b in zip(marks[:-1].tolist(), marks[1:].tolist())]
                doc_ids = piece.column("doc_id").to_pylist()
                rows = []
                for doc_id, own, framed in zip(doc_ids, lists, frame([pack(d, x, wide) for d, x in zip(doc_ids, lists)])):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        file_no, at, tokens, name = file_no + 1, 0, 0, temp_name("tokens", ".rec")
                        out = system.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(framed)
                    rows.append((part, name, file_no, doc_id, at, len(framed), len(own), tokens))
                    at, tokens = at + len(framed), tokens + len(own)
                columns = list(zip(*rows))
                kinds = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in _INDEX.split(", ")])
        if out is not None:
            out.close()
        encoder.forget()

    key = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    slim.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(run, _INDEX).write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(_INDEX).parquet(f"{folder}/index")


# ----------------------------------------------------------------------- reading
def read_files(files: DataFrame, folder: str, digest: bool = False) -> DataFrame:
    """(file, at, doc_id, ids) of every record of the named files, in order; ids as 32-bit little-endian bytes.

    ``digest``: (file, at, doc_id, start, n_tokens, ids_crc32) instead, start counting the ids
    before the record from ``base`` on, a column of ``files``.  A file is read as a stream; a wrong length or checksum raises
    ``DamagedRecord``.
    """

    def frames(name: str) -> Iterator[list[bytes]]:
        system, path = open_folder(folder)
        left = system.get_file_info(f"{path}/{name}").size
        with system.open_input_stream(f"{path}/{name}", compression=None, buffer_size=1 << 20) as source:
            held, size = [], 0
            while left > 0:
                head = source.read(12)
                length = struct.unpack_from("<Q", head)[0] + 4 if len(head) == 12 else left
                left -= 12 + length
                if left < 0 or length < 13:  # the checksum of the length is looked at with the others
                    raise DamagedRecord(f"length in {name}")
                held.append(head + source.read(length))
                size += length
                if size >= 4 << 20:
                    yield held
                    held, size = [], 0
            if held:
                yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("file").to_pylist()
            for name, total in zip(names, batch.column("base").to_pylist() if digest else [0] * len(names)):
                at = 0
                for some in frames(name):
                    read = [unpack(d) for d in check(some, name)]
                    numbers = range(at, at + len(read))
                    at += len(read)
                    if not digest:
                        yield _rows([name] * len(read), numbers, read)
                        continue
                    sizes = np.array([len(x) for _, x in read], dtype=np.int64)
                    starts = total + np.cumsum(sizes) - sizes
                    total += int(sizes.sum())
                    crcs = [zlib.crc32(x.astype("<u4").tobytes()) for _, x in read]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * len(read)), pa.array(numbers, pa.int64()), pa.array([d for d, _ in read], pa.int64()),
                        pa.array(starts), pa.array(sizes), pa.array(crcs, pa.int64())], columns)

    columns = ["file", "at", "doc_id", "start", "n_tokens", "ids_crc32"]
    schema = "file string, at long, doc_id long, " + ("start long, n_tokens long, ids_crc32 long" if digest else "ids binary")
    return files.select("file", *(["base"] if digest else [])).mapInArrow(run, schema)


def _rows(names, at, read) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(names, pa.string()), pa.array(at, pa.int64()), pa.array([d for d, _ in read], pa.int64()),
        pa.array([x.astype("<u4").tobytes() for _, x in read], pa.binary())], ["file", "at", "doc_id", "ids"])


def read_at(index: DataFrame, folder: str) -> DataFrame:
    """(file, at, doc_id, ids) of the records that the rows of ``index`` (file, offset, length) name, in their order.

    Shuffle the index, not the records: each is fetched by its offset.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        for batch in batches:
            names, offsets, lengths = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            sources = {name: system.open_input_file(f"{path}/{name}") for name in set(names)}
            for k in range(0, len(names), 1000):
                some = range(k, min(k + 1000, len(names)))
                frames = [sources[names[i]].read_at(lengths[i], offsets[i]) for i in some]
                read = [unpack(d) for d in check(frames, "the index")]
                yield _rows([names[i] for i in some], [offsets[i] for i in some], read)
            for source in sources.values():
                source.close()

    return index.select("file", "offset", "length").mapInArrow(run, "file string, at long, doc_id long, ids binary")


def file_starts(index: DataFrame) -> DataFrame:
    """(file, base): tokens of all files before; the window has one row for each file."""
    files = index.groupBy("part", "file_no", "file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def token_records(docs: DataFrame, tokenizer: str, end_id: int, **options) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each row of ``docs``, from record files just written.

    A null text counts as empty and has the end id alone.  Rows of one doc_id follow one another
    by the hash of their text; null ids come last; repeated rows are repeated records; an empty
    table writes none.  Other columns are not looked at.
    """
    folder = shared_folder(docs.sparkSession, "records")
    index = write_records(docs, folder, tokenizer, end_id, **options)
    starts = file_starts(index)
    n = max(1, docs.sparkSession.sparkContext.defaultParallelism * 4)

    read = read_files(starts.repartition(n, "file"), folder, digest=True)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")
