from tonegrain import batch_stats, process_files, search_page
from tonegrain.sources.tables import read_records


def test_files_to_statistics(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "chunks")
    inbox.mkdir()
    (inbox / "a.txt").write_text("\n".join(["very good bank", "not good", "the table"] * 10))
    (inbox / "b.csv").write_text('score,text\n1,"fraud, and worse"\n')
    (inbox / "blank.md").write_text(" \n\n")
    done = {r.file_name: r for r in process_files(spark, str(inbox), table, "b1").collect()}
    assert {n: (r.total_chunks, r.status) for n, r in done.items()} == {
        "a.txt": (3, "completed"), "b.csv": (1, "completed"), "blank.md": (0, "error")}
    assert done["a.txt"].file_size == (inbox / "a.txt").stat().st_size
    process_files(spark, str(inbox), table, "b1").collect()
    process_files(spark, str(inbox / "a.txt"), table).collect()
    records = read_records(spark, table)
    assert records.count() == 4 + 3
    panels = batch_stats(records, "b1")
    assert panels.statistics.collect()[0].total_chunks == 4
    assert {r.word for r in panels.top_negative_words.collect()} == {"good", "fraud", "worse"}
    assert {r.domain: r.n for r in panels.domains.collect()}["finance"] == 3
    assert sum(r.n for r in panels.labels.collect()) == sum(r.n for r in panels.histogram.collect()) == 4
    assert sum(r.n for r in panels.trend.collect()) == 4
    total, rows = search_page(records, 1, 50, keyword="FRAUD")
    assert total.collect()[0].total == 1 and rows.collect()[0].chunk_text == "score text 1 fraud, and worse"


def test_a_batch_of_blank_files_only(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "chunks")
    inbox.mkdir()
    (inbox / "blank.txt").write_text("\n \n")
    assert [(r.status, r.total_chunks) for r in process_files(spark, str(inbox), table, "007").collect()] == [("error", 0)]
    (inbox / "blank.txt").write_text("good")
    assert [r.status for r in process_files(spark, str(inbox), table, "007").collect()] == ["completed"]
    (inbox / "blank.txt").write_text(" \n")
    assert [(r.status, r.total_chunks) for r in process_files(spark, str(inbox), table, "007").collect()] == [("error", 0)]
