from collections import Counter

import __spark_entry__ as entry
from auditlake.operators.segment import documents
from auditlake.plans import catalog
from auditlake.sources import files
from auditlake.streaming.ingest import start_segmenting


def test_every_query_with_sql_exists():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flatten_and_combine(spark):
    df = spark.createDataFrame([(1, ("x", ["a", "é"]))], "id int, s struct<b:string,c:array<string>>")
    flat = files.flattened(df)
    assert flat.columns == ["id", "s.b", "s.c"] and tuple(flat.first()) == ("1", "x", '["a","é"]')
    assert files.flattened(df, ("id", "none")).first()["none"] == ""
    assert files.combined(df, df).select("ord").distinct().count() == 2


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x-v2.0.md").write_text("# T\n")
    got = files.read_markdown(spark, str(tmp_path)).first()
    assert got.doc_id == "a_x-v2.0" and got.markdown == "# T\n"
    (tmp_path / "r.txt").write_text("# c\nhttps://github.com/o/r\n\np/q\n")
    assert {tuple(r) for r in files.read_repo_list(spark, str(tmp_path / "r.txt")).collect()} == {("o", "r"), ("p", "q")}
    (tmp_path / "f.json").write_text('[{"id":1},{"id":2}]')
    assert files.read_findings(spark, str(tmp_path / "f.json"), spark.createDataFrame([], "id int").schema).count() == 2


def test_stream_segments_what_arrives(spark, tmp_path):
    reports = spark.createDataFrame([("d", "issue", "# High\n\n## [H-01] A\nx\n")], "doc_id string, origin string, markdown string")
    reports.write.parquet(str(tmp_path / "in"))
    from auditlake.streaming.ingest import report_stream

    start_segmenting(report_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).first().finding_id == "H-01"


def test_documents_drop_nulls(spark):
    assert documents(spark.createDataFrame([("a", None)], "doc_id string, markdown string")).count() == 0


def test_flagship_segments_every_report(spark, tmp_path):
    rows = [
        ("i", "issue", "# High\n\n## [H-01] A\nx\n"),
        ("n", "native", "# Findings\n\n### One\nx\n```\n### [L-09] code\n```\n\n### [M-01] Two\ny\n\n### Uses all gas\n\n#### Inner\nz\n"),
        ("p", "pdf", "# T\n\n| F-01 | Three |\n\nx\n\n| F-02 | Four |\n\ny\n"),
        ("o", None, "# T\n\n## [C-01] Five\n"),
    ]
    spark.createDataFrame(rows, "doc_id string, origin string, markdown string").write.parquet(str(tmp_path / "report.parquet"))
    got = Counter((r.doc_id, r.severity or "null") for r in catalog.q_segments_of_reports(spark, str(tmp_path)).collect())
    assert got == {("i", "High"): 1, ("n", "Medium"): 1, ("n", "Gas"): 1, ("p", "null"): 2, ("o", "Critical"): 1}
    assert {tuple(r) for r in catalog.flagship(spark, str(tmp_path)).collect()} == {("High", 1), ("Medium", 1), ("Gas", 1), ("null", 2), ("Critical", 1)}
