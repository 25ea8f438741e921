import gzip
import hashlib
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows_of
from tonegrain.llm.common import open_folder, shared_folder
from tonegrain.llm.warc import Salvage, archive_pages, gzip_member, make_record, read_archives, with_revisits, write_archives

SCHEMA = "page_id long, url string, html string, file string"


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def _records(n=8, size=3000):
    rng = random.Random(1)
    return [make_record(i, f"http://x/{i}", rng.randbytes(size * (i % 3)), None, "1970-01-01T00:00:00Z") for i in range(n)]


def _salvaged(data):
    salvage = Salvage(Bytes(data), len(data))
    found = [int(fields["x-page-id"]) for _, _, fields, _ in salvage]
    return found, salvage.gaps


@pytest.mark.parametrize("pack", [gzip_member, bytes])
def test_damage_costs_only_its_record(pack):
    parts = [pack(r) for r in _records()]
    starts = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
    assert _salvaged(b"".join(parts)) == (list(range(8)), [])
    for k in range(8):
        broken = bytearray(parts[k])
        broken[len(broken) - 9] ^= 0x55  # in the block, or in the last bytes of the member
        found, gaps = _salvaged(b"".join([*parts[:k], bytes(broken), *parts[k + 1:]]))
        assert found == [i for i in range(8) if i != k]
        assert [(a, n) for a, n, _ in gaps] == [(starts[k], len(parts[k]))]


@pytest.mark.parametrize("pack", [gzip_member, bytes])
def test_truncation_and_noise(pack):
    parts = [pack(r) for r in _records()]
    noise = random.Random(2).randbytes(700_000) + b"\x1f\x8b\x08WARC/1.1\r\nno header"
    found, gaps = _salvaged(noise + parts[0] + parts[1][:-9] + parts[2] + b"junk" + parts[4] + parts[5][:40])
    assert found == [0, 2, 4]
    assert [(a, n) for a, n, _ in gaps] == [
        (0, len(noise)), (len(noise) + len(parts[0]), len(parts[1]) - 9),
        (len(noise) + len(parts[0]) + len(parts[1]) - 9 + len(parts[2]), 4),
        (len(noise) + sum(map(len, (parts[0], parts[1], parts[2], parts[4]))) - 5, 40)]
    assert _salvaged(b"") == ([], []) and _salvaged(b"x")[1] == [(0, 1, "version line")]


def test_archives_are_plain_gzip():
    record = make_record(1, "http://x/ä b\r\n", b"payload", None, "1970-01-01T00:00:00Z")
    text = gzip.GzipFile(fileobj=io.BytesIO(gzip_member(record))).read()
    assert text == record and b"WARC-Target-URI: http://x/\xc3\xa4%20b%0D%0A\r\n" in record and record.endswith(b"payload\r\n\r\n")


def test_round_trip_and_revisits(spark):
    big, other = "ä" * 600, "b" * 999
    rows = [(1, "u1", big), (5, "u5", big), (3, "u3", big), (4, None, other), (6, "u6", other), (7, "u7", None), (8, "u8", ""), (None, "un", big),
            (9, "u9", "z" * 300_000), (10, "a", "q" * 1000), (10, "a", "q" * 1000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = archive_pages(pages.repartition(3))
    assert got.where("kind = 'gap'").count() == 0
    keeper = {big: 5, "q" * 1000: 10}
    want = []
    for i, u, h in rows:
        data = (h or "").encode()
        refers = keeper.get(h) if h in keeper and i != keeper[h] else None
        want.append((i, u, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", refers, None if refers else data))
    read = [(r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in got.collect()]
    assert sorted(read, key=repr) == sorted(want, key=repr)
    assert archive_pages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_reader_logs_gaps_of_files(spark):
    folder = shared_folder(spark, "warc-test")
    pages = spark.createDataFrame([(i, f"u{i}", "text " * i * 50, "x") for i in range(30)], SCHEMA).coalesce(1)
    manifest = write_archives(with_revisits(pages).coalesce(1), folder, file_bytes=700)
    names = [r["file"] for r in manifest.collect()]
    assert len(names) > 1
    system, path = open_folder(folder)
    with system.open_input_file(f"{path}/{names[0]}") as f:
        data = bytearray(f.read())
    data[60] ^= 0xFF
    with system.open_output_stream(f"{path}/{names[0]}", compression=None) as out:
        out.write(bytes(data))
    got = read_archives(manifest, folder)
    assert got.where("kind = 'record'").count() == 29
    assert rows_of(got.where("kind = 'gap'"), "file", "offset")[0] == (names[0], 0)


def test_line_ends_of_unicode_in_urls(spark):
    odd = ["http://x/a\u0085b", "http://x/a\u2028b:c", "\u2029", "http://x/\u00a0", "\x1c:\x1e"]
    parts = [make_record(i, u, b"p", None, "1970-01-01T00:00:00Z") for i, u in enumerate(odd)]
    assert _salvaged(b"".join(map(gzip_member, parts))) == (list(range(len(odd))), [])
    for i, u in enumerate(odd[:4]):  # as other writers leave them
        raw = re.sub(rb"(?<=Target-URI: )[^\r]*", u.encode(), parts[i])
        (_, _, fields, _), = Salvage(Bytes(raw), len(raw))
        assert fields["warc-target-uri"] == u
    got = archive_pages(spark.createDataFrame([(i, u, "same " * 400, "x") for i, u in enumerate(odd)], SCHEMA))
    assert rows_of(got, "kind", "page_id", "url", "refers_to") == sorted([
        ("record", 0, "http://x/a%C2%85b", 4), ("record", 1, "http://x/a%E2%80%A8b:c", 4), ("record", 2, "%E2%80%A9", 4),
        ("record", 3, "http://x/\u00a0", 4), ("record", 4, "%1C:%1E", None)], key=repr)


def test_a_record_that_is_not_read_is_an_error(spark):
    folder = shared_folder(spark, "warc-whole")
    pages = spark.createDataFrame([(i, f"u{i}", "text", "x") for i in range(5)], SCHEMA)
    manifest = write_archives(with_revisits(pages).coalesce(1), folder)
    assert read_archives(manifest, folder, whole=True).count() == 5
    with pytest.raises(Exception, match="5 records read, 6 written"):
        read_archives(manifest.withColumn("records", F.col("records") + 1), folder, whole=True).count()
