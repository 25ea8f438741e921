import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import rows_of
from tonegrain.llm.common import shared_folder
from tonegrain.llm.records import (
    DamagedRecord, check, crc32c, crc32c_of_lengths, file_encoder, frame, masked, pack, read_at, token_records, unpack, write_records,
)

PATH = P.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True
PIECES = st.sampled_from([" ", "\n", "\t", " ", "a", "The", "'s", "'", "é", "É", "12", "日", "!", "🙂", "\x1c", "İ", "Σ", "<|endoftext|>", "é", "!'s", "ß", "١", ".", "́"])


def slow_crc(data):
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksum():
    assert slow_crc(b"123456789") == 0xE3069283  # the published check value
    rng = np.random.default_rng(0)
    buffers = [rng.bytes(n) for n in (4, 5, 511, 512, 513, 1024, 1500, 9, 5000)]
    assert crc32c(buffers).tolist() == [slow_crc(b) for b in buffers]
    assert crc32c_of_lengths(np.array([0, 7, 2**40])).tolist() == [slow_crc(struct.pack("<Q", n)) for n in (0, 7, 2**40)]
    assert masked(np.array([1 << 15], dtype=np.uint32))[0] == (1 + 0xA282EAD8) & 0xFFFFFFFF


@pytest.mark.parametrize("wide", [False, True])
def test_frames_round_trip_and_damage(wide):
    data = [pack(i, np.arange(abs(i or 0), dtype=np.uint32), wide) for i in (None, 5, -300)]
    frames = frame(data)
    assert check(frames, "x") == data
    for at in (0, 9, 14, len(frames[1]) - 1):
        broken = bytearray(frames[1])
        broken[at] ^= 1
        with pytest.raises(DamagedRecord):
            check([frames[0], bytes(broken)], "x")
    doc_id, ids = unpack(pack(None, np.array([1, 65_535], dtype=np.uint32), wide))
    assert doc_id is None and ids.tolist() == [1, 65_535]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), max_size=4))
def test_ids_are_those_of_the_library(texts):
    ids, marks = file_encoder(PATH).encode([t.encode() for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(marks[:-1], marks[1:])] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]


def test_records_in_order(documents):
    long = "word another " * 50_000
    rows = [(9, "nine words"), (2, None), (4, ""), (7, long), (None, "last"), (5, "twice"), (5, "twice")]
    got = token_records(documents(*rows, more=True).repartition(3), PATH, 2, file_bytes=200)
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*PLAIN.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    assert token_records(documents(), PATH, 2).collect() == []


def test_shuffled_reads_by_index(spark, documents):
    folder = shared_folder(spark, "records-test")
    index = write_records(documents(*[(i, f"text {i} " * i) for i in range(50)]), folder, PATH, 2)
    shuffled = index.orderBy("n_tokens", ascending=False)
    read = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), dtype="<u4").tolist() for r in read_at(shuffled, folder).collect()}
    assert read == {i: [*PLAIN.encode(f"text {i} " * i, add_special_tokens=False).ids, 2] for i in range(50)}
