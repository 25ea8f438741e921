import csv
import json
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tonegrain.functions import structured as sx
from tonegrain.operators.chunking import assemble_chunks, chunk_array, chunk_count, chunk_size
from tonegrain.operators.numbering import number_lines
from tonegrain.sources import lines as src
from tonegrain.sources.formats import format_of
from tonegrain.sources.tables import decode_lists, rows_to_lines


def put(folder, name, content):
    path = folder / name
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def lines_of(df):
    rows = df.orderBy("file_name", "line_no").collect()
    assert len({(r.file_path, r.line_no) for r in rows}) == len(rows)
    return [r.line for r in rows]


@contextmanager
def small_splits(spark, size):
    """Cut files into splits of so many bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def both_ways(spark, path, **options):
    """Lines read as whole files, and read by splits; they must agree."""
    whole = lines_of(src.read_lines(spark, path, **options))
    split = lines_of(src.read_lines(spark, path, whole_file_limit=0, **options))
    assert whole == split
    return whole


def test_text_lines(spark, tmp_path):
    p = put(tmp_path, "a.LOG", b"one\r\n \t\r\n\xa0\n two\rthree \n\xc2\xa0\xe2\x80\x83four\xc2\xa0\n\xff bad")
    assert both_ways(spark, p) == ["one", "�", "two", "three", "four", "� bad"]


def test_encodings(spark, tmp_path):
    p = put(tmp_path, "a.txt", "café\nnaïve".encode("latin-1"))
    assert both_ways(spark, p, encoding="ISO-8859-1") == ["café", "naïve"]
    p = put(tmp_path, "b.txt", "café\nnaïve".encode("utf-16"))
    assert both_ways(spark, p, encoding="UTF-16") == ["café", "naïve"]


@pytest.mark.parametrize("charset, mark", [("UTF-16", b"\xff\xfe"), ("UTF-32", b"")])
def test_wide_charsets_by_splits(spark, tmp_path, charset, mark):
    """Letters whose bytes look like a line feed between them, cut into splits of a few bytes."""
    plain = charset[:6] + ("LE" if mark[:1] == b"\xff" else "BE")
    rnd = random.Random(len(charset))
    text = "".join(rnd.choice(["\u0a05", "\u0a00", "\u1000", "\u000a", "a", "\n", "\r\n", "\r", " ", "é", "\U0001f600", "\u0d0a"]) for _ in range(200))
    p = put(tmp_path, "w.txt", mark + text.encode(plain))
    want = [x.strip() for x in text.replace("\r\n", "\n").replace("\r", "\n").split("\n") if x.strip()]
    assert lines_of(src.read_lines(spark, p, encoding=charset)) == want
    csv_text = "".join(rnd.choice(['"\u0a05\n\u1000",', "b,", "\n", '"x\r\ny"\n']) for _ in range(25))
    q = put(tmp_path, "w.csv", mark + csv_text.encode(plain))
    with small_splits(spark, 101):
        assert lines_of(src.read_lines(spark, p, encoding=charset, whole_file_limit=0)) == want
        assert lines_of(src.read_lines(spark, q, encoding=charset, whole_file_limit=0)) == records_of(csv_text)


CSV_TEXT = (
    'name,note\n"Smith, J"," said ""hi"" "\n,,\n a ,,b,c,d,e,f,g,h\n"open""close"tail,x\nmid"quote,"y"\n\r\n"",z\r\n'
)


def test_delimited_rows(spark, tmp_path):
    want = [
        " ".join(c.strip() for c in row if c.strip())
        for row in csv.reader(CSV_TEXT.splitlines(keepends=True))
    ]
    want = [w for w in want if w]
    assert both_ways(spark, put(tmp_path, "a.csv", CSV_TEXT)) == want
    assert both_ways(spark, put(tmp_path, "a.tsv", CSV_TEXT.replace(",", "\t"))) == [
        w for w in (
            " ".join(c.strip() for c in row if c.strip())
            for row in csv.reader(CSV_TEXT.replace(",", "\t").splitlines(keepends=True), delimiter="\t")
        ) if w
    ]


def test_quoted_line_break(spark, tmp_path):
    text = 'a,"b\nc ",d\r\n"e\r\n""f""",g\nlast,"unclosed\nrest'
    p = put(tmp_path, "a.csv", text)
    import io
    want = [" ".join(c.strip() for c in row if c.strip()) for row in csv.reader(io.StringIO(text, newline=""))]
    assert both_ways(spark, p) == want


def records_of(text, sep=","):
    import io
    rows = [" ".join(c.strip() for c in r if c.strip()) for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep)]
    return [r for r in rows if r]


@pytest.mark.parametrize("size", [40])
def test_records_across_splits(spark, tmp_path, size):
    """Random files with quoted line breaks of all kinds, cut into splits of a few bytes."""
    rnd = random.Random(size)
    texts = {f"f{i}.csv": "".join(rnd.choice(['a', 'b ', ',', '"', '"', '""', '\n', '\r\n', 'é', '\r', ' "x', '",']) for _ in range(rnd.randint(0, 60 if size < 50 else 400))) for i in range(10)}
    texts["long.csv"] = "".join(f'{i},"two\nlines, {i}",end\n' if i % 7 else f"plain,{i},x\n" for i in range(size // 5 + 10))
    texts["open.csv"] = "a,b\n" * 9 + 'c,"never\nclosed\n' + "d,e\n" * 9
    for name, text in texts.items():
        put(tmp_path, name, text)
    with small_splits(spark, size):
        rows = src.read_lines(spark, str(tmp_path), whole_file_limit=0).collect()
    for name, text in texts.items():
        own = sorted((r.line_no, r.line) for r in rows if r.file_name == name)
        assert [line for _, line in own] == records_of(text), (name, text)
        assert [n for n, _ in own] == list(range(len(own)))


def test_many_records_across_lines(spark, tmp_path):
    """Too many for a broadcast: the splits are gathered again, with the same lines."""
    text = "".join(f'"r{i}\n{i}",x\nplain {i}\n' for i in range(300))
    path = put(tmp_path, "a.tsv", text.replace(",", "\t"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert both_ways(spark, path) == records_of(text)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_text_is_shuffled_once(spark, tmp_path):
    """Lines of large files move for their chunks alone, not to meet the offsets of their splits."""
    path = put(tmp_path, "a.txt", "some line\n" * 5000)
    chunks = src.read_chunks(spark, path, whole_file_limit=0)
    chunks.collect()
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert final.count(" Exchange ") == 1 and "SortMergeJoin" not in final


def test_random_csv_agrees_with_a_csv_reader(spark):
    import io
    rnd = random.Random(3)
    texts = ["".join(rnd.choice('ab,"\n ') for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", sx.delimited_lines("t").alias("x")).orderBy("i").collect()
    for text, row in zip(texts, rows):
        want = [" ".join(c.strip() for c in r if c.strip()) for r in csv.reader(io.StringIO(text, newline=""))]
        assert row.x == [w for w in want if w], repr(text)


def expected_json(text):
    """The rule in plain Python; nested values as compact JSON."""
    def show(v):
        return json.dumps(v, separators=(",", ":")) if isinstance(v, (dict, list)) else str(v)

    def joined(d):
        return " ".join(show(v) for v in d.values() if v).strip()

    out = []
    try:
        data = json.loads(text)
    except json.JSONDecodeError:
        for raw in text.splitlines():
            raw = raw.strip()
            if not raw:
                continue
            try:
                obj = json.loads(raw)
            except json.JSONDecodeError:
                out.append(raw)
                continue
            if isinstance(obj, str):
                out.append(obj)
            elif isinstance(obj, dict) and joined(obj):
                out.append(joined(obj))
        return out
    for item in data if isinstance(data, list) else [data]:
        if isinstance(item, str) and isinstance(data, list):
            out.append(item.strip())
        elif isinstance(item, dict) and joined(item):
            out.append(joined(item))
    return out


JSON_TEXTS = [
    '["a ", "", "{\\"x\\": 1}", 5, null, true, ["x"], {"k": "v", "n": 0}]',
    '{"b": 1.50, "a": "0", "c": 0, "d": null, "e": [1, 2], "f": {}, "g": true, "h": 1e7, "i": "x y", "j": false, "k": -0.0, "l": {"z": "q"}, "m": [], "n": ""}',
    '{"tiny": 1e-5, "small": 0.00012, "big": 1e16, "bigger": 1.5e300, "int": 12345678901234567890, "neg": -2.5, "half": 123456789.25}',
    '{"a": 0, "b": ""}', '"abc"', "5", "", "  ", "[]", "null",
    '{"a": 1}\n\n "plain string" \n{broken\n7\n[1]\n{"x": null}\n{"y": "z "}',
    '{"a": 1}{"b": 2}', "1] [2", '{"s": "  "}', '[{"a": {"b": [1, "2"]}}]',
]


def test_json_texts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(JSON_TEXTS)], "i int, t string")
    for row in df.select("i", sx.json_lines("t").alias("x")).orderBy("i").collect():
        assert row.x == expected_json(JSON_TEXTS[row.i]), JSON_TEXTS[row.i]


JSON_FILES = [
    *JSON_TEXTS, '[1, 2,]', '[1, 2],', '[1] x', '[1][2]', '[{"a": "x, y ] \\\\"}, "b\\", [", {"c": [1, {"d": "}"}]}]', '[]', ' [ ] ', '["only"]', "[,]", "[1}", "{]", '["a",,"b"]',
    '\n [ {"a": 1} ,\n "s,t" , [1, 2], {"b": {"c": [",", "]"]}} ]\n', '{"a": [1, 2,\n 3], "b": "x,y"}\n', '{"a": 1}\n{"b": "u, v"}\n\n[1, 2]\n"z"', "plain, text\nmore", '["unclosed, "x"]',
]


@pytest.mark.parametrize("size", [60])
def test_json_by_splits(spark, tmp_path, size):
    """Arrays, single values and newline-delimited text, cut into splits of a few bytes."""
    texts = {f"j{i}.json": t for i, t in enumerate(JSON_FILES) if t}
    texts["large.json"] = json.dumps([{"n": i, "t": f'q", [{{ {i}', "l": [i, "x"]} if i % 3 else f"s, {i}" for i in range(size // 5 + 10)], indent=1)
    for name, text in texts.items():
        put(tmp_path, name, text)
    put(tmp_path, "mark.json", b'\xef\xbb\xbf["a", "b"]')
    put(tmp_path, "wide.JSON", "[\"é, x\", {\"k\": \"\u2c00\"}]".encode())
    whole = {}
    for r in src.read_lines(spark, str(tmp_path)).collect():
        whole.setdefault(r.file_name, []).append((r.line_no, r.line, r.total_lines))
    with small_splits(spark, size):
        rows = src.read_lines(spark, str(tmp_path), whole_file_limit=0).collect()
    split = {}
    for r in rows:
        split.setdefault(r.file_name, []).append((r.line_no, r.line, r.total_lines))
    for name in {*whole, *split}:
        assert sorted(split.get(name, [])) == sorted(whole.get(name, [])), (name, texts.get(name))
    assert [line for _, line, _ in sorted(split["large.json"])] == expected_json(texts["large.json"])


@pytest.mark.parametrize("size", [50])
def test_markup_by_splits(spark, tmp_path, size):
    rnd = random.Random(size)
    bits = ["<b>", "</b>", "<a href='x>y'>", "<>", "<<p>>", " ", "\n", ". ", "! ", "?\n", ".", "word and more words", "é\u2003", "x < y", "a > b", "<br\n/>", "<"]
    for i in range(10):
        put(tmp_path, f"m{i}.html", "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40 if size < 50 else 200))))
    put(tmp_path, "end.xml", "<r>First sentence here. Second one is here</r>")
    put(tmp_path, "mark.xml", b"\xef\xbb\xbfThe first sentence. The second <i>one")
    read = lambda **o: sorted((r.file_name, r.line_no, r.line, r.total_lines) for r in src.read_lines(spark, str(tmp_path), **o).collect())
    whole = read()
    with small_splits(spark, size):
        assert read(whole_file_limit=0) == whole
    assert len(whole) > 15


def test_json_files(spark, tmp_path):
    lines = '{"a": 1}\n "s" \n{bad\n7\n\n{"b": "x", "c": false}\n'
    assert lines_of(src.read_lines(spark, put(tmp_path, "a.json", JSON_TEXTS[0]))) == expected_json(JSON_TEXTS[0])
    assert both_ways(spark, put(tmp_path, "b.jsonl", lines)) == expected_json(lines)


def test_markup(spark, tmp_path):
    html = "<p>Tiny one. 0123456789.  01234567890. A <b>bold</b>\n claim! Really&amp;so?</p><script>var x = 1;</script>"
    p = put(tmp_path, "a.html", html)
    assert lines_of(src.read_lines(spark, p)) == ["0123456789.", "01234567890.", "A bold claim!", "Really&amp;so?"]


def test_router(spark, tmp_path):
    put(tmp_path, "a.txt", "t1\nt2")
    put(tmp_path, "b.CSV", "c1,c2")
    put(tmp_path, "c.json", '["j"]')
    assert lines_of(src.read_lines(spark, str(tmp_path))) == ["t1", "t2", "c1 c2", "j"]
    assert format_of("x.Md").name == "text"
    put(tmp_path, "d.exe", "x")
    with pytest.raises(ValueError, match="Unsupported file type '.exe'.*\\.csv"):
        src.read_lines(spark, str(tmp_path))
    with pytest.raises(ValueError):
        format_of("noext")


def test_sheet_rows(spark):
    df = spark.createDataFrame([(1, " a", None), (2, "", "c"), (3, None, None)], "i int, x string, y string")
    rows = rows_to_lines(df, ["x", "y"], ["i"]).orderBy("i").collect()
    assert [(r.i, r.line) for r in rows] == [(1, "a"), (2, "c")]
    rows = rows_to_lines(df, ["i", "x", "y"], ["i"]).orderBy("i").collect()
    assert [r.line for r in rows] == ["1  a", "2  c", "3"]
    rows = rows_to_lines(df, ["i", "x", "y"], ["i"], keep_empty_cells=False).orderBy("i").collect()
    assert [r.line for r in rows] == ["1 a", "2 c", "3"]


def test_typed_text_and_line_count(spark, tmp_path):
    rows = src.lines_from_text(spark, " a \n\n b").collect()
    assert [(r.file_name, r.line_no, r.line) for r in rows] == [("raw_input.txt", 0, "a"), ("raw_input.txt", 1, "b")]
    p = put(tmp_path, "a.txt", "x\n\n y\r\n\r\nz")
    assert src.line_counts(spark, p).collect()[0].n_lines == 5
    assert src.file_list(spark, p).collect()[0].file_size == 10


@pytest.mark.parametrize("split_bytes", [2_000, 20_000])
def test_large_file_lines_are_numbered_across_splits(spark, tmp_path, split_bytes):
    rnd = random.Random(5)
    want = {}
    for name, n in (("hot.txt", 6_000), ("b.txt", 700), ("c.txt", 3)):
        raw = [("" if rnd.random() < 0.2 else f"  {name} line {i} " + "x" * rnd.randint(0, 40)) for i in range(n)]
        put(tmp_path, name, "\n".join(raw))
        want[name] = [x.strip() for x in raw if x.strip()]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        rows = src.read_lines(spark, str(tmp_path), whole_file_limit=0).collect()
        chunks = src.read_chunks(spark, str(tmp_path), whole_file_limit=0)
        got = {(r.file_name, r.chunk_index): (r.chunk_text, r.chunk_lines, r.total_chunks) for r in chunks.collect()}
        mixed = src.read_chunks(spark, str(tmp_path), whole_file_limit=5_000).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
    for name, lines in want.items():
        mine = sorted((r for r in rows if r.file_name == name), key=lambda r: r.line_no)
        assert [r.line_no for r in mine] == list(range(len(lines))) and [r.line for r in mine] == lines
        assert {r.total_lines for r in mine} == {len(lines)}
    whole = {(r.file_name, r.chunk_index): (r.chunk_text, r.chunk_lines, r.total_chunks)
             for r in src.read_chunks(spark, str(tmp_path)).collect()}
    assert got == whole
    assert {(r.file_name, r.chunk_index): (r.chunk_text, r.chunk_lines, r.total_chunks) for r in mixed} == whole


def test_chunk_sizes(spark):
    bounds = [(0, 10), (499, 10), (500, 50), (4_999, 50), (5_000, 200), (49_999, 200), (50_000, 500), (499_999, 500), (500_000, 1_000)]
    df = spark.createDataFrame([(n,) for n, _ in bounds], "n long")
    rows = df.select(chunk_size("n").alias("s"), chunk_count("n").alias("c"), "n").collect()
    assert [r.s for r in rows] == [s for _, s in bounds]
    assert [r.c for r in rows] == [-(-n // s) for n, s in bounds]


def test_chunks_partition_the_lines(spark):
    for n in (0, 1, 10, 11, 499, 500, 503):
        lines = [f"l{i}" for i in range(n)]
        df = spark.createDataFrame([(lines,)], "lines array<string>")
        chunks = df.select(chunk_array(F.col("lines")).alias("c")).collect()[0].c
        assert " ".join(c.chunk_text for c in chunks).split() == lines
        assert [c.chunk_index for c in chunks] == list(range(len(chunks)))
        size = 10 if n < 500 else 50
        assert [c.chunk_lines for c in chunks] == [min(size, n - i) for i in range(0, n, size)]


def test_numbering_with_a_hot_file(spark):
    # One file holds most rows; pieces are far smaller than the file.
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("file_name"), (F.col("id") * 3 + 7).alias("k"),
        F.col("id").cast("string").alias("line"),
    )
    rows = number_lines(df, ["file_name"], "k", span=1_000).collect()
    for name in ("hot", "cold"):
        mine = sorted((r.k, r.line_no) for r in rows if r.file_name == name)
        assert [n for _, n in mine] == list(range(len(mine)))
    chunks = assemble_chunks(number_lines(df, ["file_name"], "k", span=1_000), ["file_name"]).filter("file_name = 'hot'")
    text = " ".join(r.chunk_text for r in chunks.orderBy("chunk_index").collect())
    assert text.split() == [str(i) for i in range(20_000) if i % 10 < 8]


@pytest.mark.parametrize("span", [1, 7, 1 << 16])
def test_numbering_of_sparse_keys(spark, span):
    # Keys far apart: nearly every row is a piece of its own.
    rnd = random.Random(11)
    keys = sorted(rnd.sample(range(-(1 << 40), 1 << 62), 500) + list(range(100)))
    df = spark.createDataFrame([("f", k) for k in keys], "file_name string, k long").repartition(5)
    rows = number_lines(df, ["file_name"], "k", span=span).orderBy("k").collect()
    assert [(r.k, r.line_no, r.total_lines) for r in rows] == [(k, i, 600) for i, k in enumerate(keys)]


def test_stored_lists_are_decoded(spark):
    df = spark.createDataFrame([('["a","b"]', None, "oops", "[]")], "positive_words string, negative_words string, tags string, pattern_matches string")
    assert list(decode_lists(df).collect()[0]) == [["a", "b"], [], [], []]


def test_numbering_counts_the_input_once(spark, small):
    df = spark.read.parquet(f"{small}/events.parquet").select("event_type", "event_id", "ts")
    numbered = number_lines(df, ["event_type"], "event_id")
    numbered.collect()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    final = numbered._jdf.queryExecution().explainString(mode).split("Initial Plan")[0]
    assert final.count("FileScan") == 2 and final.count("ReusedExchange") == 2


def test_same_lines_at_every_file_size(spark, tmp_path):
    (tmp_path / "bom.txt").write_bytes(b"\xef\xbb\xbffirst\r\nsecond\n\n third ")
    (tmp_path / "rows.ndjson").write_text('["one good","two bad"]\n{"a": "x", "b": 0}\n"plain"\n7\nbroken {\n\n{\n"a": "y"\n}\n')
    (tmp_path / "rows.csv").write_text('﻿a,"b, c",,d\n,\n e , "f" \n')
    (tmp_path / "rows.tsv").write_text("a\tb\t\tc\n\t\nx")

    def rows(**options):
        return sorted((r.file_name, r.line_no, r.line, r.total_lines) for r in src.read_lines(spark, str(tmp_path), **options).collect())

    whole = rows()
    assert whole == rows(whole_file_limit=0) and ("bom.txt", 0, "first", 3) in whole
    assert {line for name, _, line, _ in whole if name == "rows.csv"} == {"a b, c d", 'e "f"'}


def test_records_by_splits_are_put_together_once(spark, tmp_path):
    folder = tmp_path / "once"
    folder.mkdir()
    (folder / "a.json").write_text('[{"a": "x"}, 1, "y", {"b": null}, {"a": "z"}]')
    lines = src.read_lines(spark, str(folder), whole_file_limit=0)
    plan = plan_of(lines)
    # The lines come from a stored table: no file is scanned or parsed again for them.
    assert "from_json" not in plan and "MapInArrow" not in plan and "FileScan text" not in plan
    assert sorted(map(tuple, lines.select("line_no", "line", "total_lines").collect())) == [(0, "x", 3), (1, "y", 3), (2, "z", 3)]
