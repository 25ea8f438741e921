import base64
import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings, strategies as st

from tests.llm.conftest import rows_of
from tonegrain.llm.bpe import PartEncoder, character_starts, cut_parts, decode, encode, rank_decoder, rank_tokenizer, round_trip

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
PLAIN = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = PartEncoder(rank_tokenizer(PATH, P.PATTERN))
PIECES = st.sampled_from([" ", "\n", "  ", "\t", " ", "　", " ", "a", "the", "'s", "é", "ö", "12", "日", "!", "🙂", "\x1c", "aaa", "ababa", "<|endoftext|>", "é"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(PIECES, max_size=12).map("".join), st.text(max_size=30)), max_size=4))
def test_ids_are_those_of_the_rank_library(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    ids, marks = ENCODER.encode([t.encode() for t in texts])
    got = [ids[a:b].tolist() for a, b in zip(marks[:-1], marks[1:])]
    assert got == [PLAIN.encode_ordinary(t) for t in texts]
    assert [rank_decoder(PATH).to_bytes(np.array(x, dtype=np.int64)).decode() for x in got] == texts


def test_parts_cover_the_texts():
    parts, marks = cut_parts([b"ab cd\nef  g", b"", b" x"])
    assert parts.to_pylist() == [b"ab", b" cd", b"\nef  g", b" x"] and marks.tolist() == [0, 3, 3, 4]


def test_offsets(documents):
    row = encode(documents((1, "é 🙂 日本 abc")), PATH, P.PATTERN).first()
    data = "é 🙂 日本 abc".encode()
    lens = [len(PLAIN.decode_single_token_bytes(i)) for i in row["ids"]]
    assert list(row["byte_starts"]) == np.cumsum([0, *lens[:-1]]).tolist()
    assert list(row["char_starts"]) == [_char(data, b) for b in row["byte_starts"]]
    assert character_starts("aé".encode(), np.array([0, 1, 2])).tolist() == [0, 1, 1]


def _char(data, at):
    return sum((b & 0xC0) != 0x80 for b in data[:at + 1]) - 1


def test_split_characters():
    decoder = rank_decoder(PATH)
    ids = np.array(PLAIN.encode_ordinary("🙂 und 日本"))
    assert "".join(decoder.stream([ids[k:k + 1] for k in range(len(ids))])) == "🙂 und 日本"
    assert "".join(decoder.stream([ids[:1]])) == "�"


def test_edges(documents):
    long = "word ändern 123 " * 40_000
    docs = documents((1, None), (2, ""), (3, long), (None, "x"), (4, "a  b"), (4, "a  b"), more=True)
    want = []
    for i, t in ((1, ""), (2, ""), (3, long), (None, "x"), (4, "a  b"), (4, "a  b")):
        ids = PLAIN.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = round_trip(docs, PATH, P.PATTERN)
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert round_trip(documents(), PATH, P.PATTERN).collect() == []
    assert rows_of(decode(encode(docs, PATH, P.PATTERN), PATH), "doc_id", "text") == sorted(((i, t or "") for i, t in (
        (1, ""), (2, ""), (3, long), (None, "x"), (4, "a  b"), (4, "a  b"))), key=repr)
