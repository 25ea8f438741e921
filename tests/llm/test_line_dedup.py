import random

import pytest

from tests.llm.brute import WORD
from tests.llm.conftest import rows_of
from tonegrain.llm.line_dedup import dedup_lines


def brute(docs):
    """{doc_id: text} with all lines out that a later occurrence of a window covers."""
    seen, gone = {}, {i: set() for i in docs}
    for i in sorted(docs):
        lines = docs[i].split("\n")
        at = [k for k, line in enumerate(lines) if WORD.search(line)]
        for k in range(len(at) - 2):
            own = at[k:k + 3]
            d, last = seen.setdefault(tuple(lines[x] for x in own), (i, own[-1]))
            if (d, last) != (i, own[-1]):
                gone[i] |= {x for x in own if d != i or x > last}
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in docs.items()}


def test_equal_to_brute_force(documents):
    rng = random.Random(3)
    docs = {i: "\n".join(rng.choice(["a", "b", "c", "d", "", " ", "e f", "a "]) for _ in range(rng.randrange(25))) for i in range(60)}
    got = dedup_lines(documents(*docs.items(), more=True).repartition(4))
    assert rows_of(got, "doc_id", "text") == sorted(brute(docs).items(), key=repr)
    assert any(brute(docs)[i] != docs[i] for i in docs)


def test_passages_go_and_other_lines_stay(documents):
    passage = "p one\np two\np three\np four"
    docs = documents((1, f"start\n{passage}\nend"), (2, f"other\n\n{passage}\nlast"), (3, "p one\np two"), (4, passage.upper()))
    got = dedup_lines(docs, removed="gone")
    assert rows_of(got, "doc_id", "text", "gone") == [
        (1, f"start\n{passage}\nend", 0), (2, "other\n\nlast", 4), (3, "p one\np two", 0), (4, passage.upper(), 0)]


def test_edges(documents):
    long = "\n".join(f"line {i}" for i in range(50_000))
    rows = [(1, None), (2, ""), (3, "x\n" * 5 + "y"), (4, long), (5, long + "\nmore"), (None, "a\nb\nc"), (7, "a\nb\nc"), (8, "q\nr\ns"), (8, "q\nr\ns")]
    docs = documents(*rows, more=True)
    got = dedup_lines(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    assert rows_of(got, "doc_id", "text") == sorted([
        (1, None), (2, ""), (3, "x\nx\nx\ny"), (4, long), (5, "more"), (None, ""), (7, "a\nb\nc"), (8, "q\nr\ns"), (8, "q\nr\ns")], key=repr)
    assert dedup_lines(documents()).collect() == []


def test_other_columns_come_through(documents):
    docs = documents((1, "a\nb\nc"), (2, "a\nb\nc\nd"), (None, None), more=True)
    got = dedup_lines(docs, removed="gone")
    same = [c for c in docs.columns if c != "text"]
    assert got.columns == [*docs.columns, "gone"] and rows_of(got, *same) == rows_of(docs, *same)
    with pytest.raises(ValueError):
        dedup_lines(docs, removed="Covered")
