"""Reports to records: title cleaning, sections, repositories, issues, records, models, sources."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlake.functions import text as T
from auditlake.operators import classify, dedup, issues, models, normalize, query, repos, sections, segment, validate
from auditlake.plans import pipeline
from auditlake.sources import files, issues_api


def test_heading_is_cleaned(spark):
    rows = [
        ("2. Title Severity: High Type: X", 2, "", "Title"),
        ("3. T (from Detailed Findings)", 3, "| 2. No |\n | 3. Row<br>title | x |", "Row title"),
        ("4. Severity: Low", 4, "", "4. Severity: Low"[3:]),
        ("Plain Difficulty: Low", 5, "", "Plain"),
        ("6. 7. Twice", 6, "", "Twice"),
    ]
    df = spark.createDataFrame(rows, "h string, i int, m string, want string")
    got = [tuple(r) for r in df.select(T.cleaned_heading(F.col("h"), F.col("i"), F.col("m")), "want").collect()]
    assert [g for g, _ in got] == [w for _, w in got]


def test_clean_markdown_strips_before_it_looks(spark):
    text = "  ![](x.png)\n {5}-----\n![alt](x.png)\n[](a.PNG)\n![](a.txt)\nt"
    assert spark.createDataFrame([(text,)], "t string").select(T.clean_markdown(F.col("t"))).first()[0] == "![alt](x.png)\n![](a.txt)\nt\n"


def test_labels_and_other_sections():
    assert [sections.bold_label(x) for x in ("**Impact:** x", " __A b__:", "**no", "plain", "**9x:**", "** Fix : ** y", "**a*b**")] == ["Impact", "A b", None, None, None, "Fix", None]
    got = sections.sections_of("## Vulnerability Detail\nv\n## Tools Used\nhand\n**Team:**\nfixed\n**Team:**\nagain\n## Fix\ndone\n")
    assert got["other"] == "**container:**\n## Vulnerability Detail\nv\n\n**tools_used:**\n## Tools Used\nhand\n\n**Team:**\nfixed\nagain\n" and got["fix_status"] == "## Fix\ndone\n"
    assert sections.sections_of("# T\n| AB-01 | t |\n|---|---|\n| Asset | x |\n\nreal text\n")["description"] == "real text\n"


def test_description_cascade():
    assert sections.cascaded_description("a\n#### **Description**\nd\n\n### Fix\nf") == "#### **Description**\nd\n"
    assert sections.cascaded_description("**Background** b\nc\n**Impact:** i") == "**Background** b\nc\n"
    assert sections.cascaded_description("| AB-01 | t |\n|--|--|\ntext\n## Resolution\nr") == "text\n"
    assert sections.cascaded_description("one\ntwo here\nthree", lambda t: "two here") == "two here\nthree\n"
    assert sections.cascaded_description("nothing") is None and sections.cascaded_description("") is None


def test_sections_keep_rows(spark):
    df = spark.createDataFrame([("a", "x" * 200_000), ("a", "x" * 200_000), ("b", ""), ("c", None)], "k string, t string")
    got = sections.split_sections(df, "k", "t").collect()
    assert sorted(r.k for r in got) == ["a", "a", "b"] and {r.k: r.description for r in got}["b"] is None


def test_shapes_of_segments():
    assert segment.by_severity("", []) == [] and segment.by_anchor("x", ["x"]) == [] and segment.by_id_table("x", ["x"]) == []
    nested = "# High\n## Low risk\n### A\nx\n"
    assert [(p[1], p[3 + 2], p[6]) for p in segment.by_severity(nested, nested.splitlines())] == [(1, "High", "Low risk"), (2, "High", "A"), (2, "Low", "A")]


def test_project_targets(spark):
    text = (
        '# <span id="page-1-0"></span>Intro\nsee https://github.com/o/first/tree/abcdef0\n# <span id="page-7-0"></span>Project Targets\n#### One\nRepository https://github.com/o/r\n'
        "Version abcdef1234\nabcdef9 more\n#### Two\nVersion abcdef5678\n" + '# <span id="page-9-0"></span>Next\nVersion abcdef7777\n'
    )
    df = spark.createDataFrame([("d", text), ("n", None), ("e", "")], "doc_id string, markdown string")
    got = [(r.ord, r.repo, r.commit_sha, r.page) for r in repos.extract_repos(df).orderBy("ord").collect()]
    assert got == [(0, "first", "abcdef0", 1), (1, "r", None, 7), (2, "r", "abcdef1234", 7), (3, "r", "abcdef9", 7)]


def test_issue_report_names_repositories(spark):
    rows = [
        (2, "https://github.com/o/r", "T2", "**Impact:** big\nhttps://github.com/x/y", [("high",)], None, None),
        (1, "https://github.com/o/r", None, "see https://github.com/x/y and https://github.com/x/z", [("medium",)], None, None),
        (3, "https://github.com/o/r", "T3", "b", [("invalid",)], None, None),
        (4, "https://github.com/o/r", "T4", "b", [("low",)], ("pr",), None),
    ]
    df = spark.createDataFrame(rows, files.ISSUE)
    got = issues.issue_reports(df).first()
    assert got.doc_id == "github:o/r" and got.n_sections == 2 and [(x.repo, x.issue) for x in got.repositories] == [("y", 1), ("z", 1)]
    one = {r.idx: r for r in issues.issue_sections(df).collect()}
    assert one[1].heading == "1. (untitled)" and one[2].sections.impact.startswith("**Impact:** big") and one[2].severity == "High"
    skipped = spark.createDataFrame([([("invalid",), ("bug",)],)], "l array<struct<name:string>>")
    assert skipped.select(issues.label_category(F.col("l"))).first()[0] is None
    assert issues.issue_reports(df.where("false")).count() == 0


REPORT = "doc_id string, origin string, source_pdf string, markdown string, extra int"
BODY = "# High\n\n## [H-01] Reentrancy in vault\n\nSeverity: Low\n| Target | src/Vault.sol |\n\n**Description:** The call re-enters.\n\n**Recommendation:** Guard it.\n\n**Resolution:** fixed in abcdef1234\n"


def test_records_of_a_report(spark):
    rows = [("d", "native", None, BODY + "\nhttps://github.com/o/r/tree/1234567\n", 1), ("n", "native", None, None, 1), ("e", "pdf", "e.pdf", "", 1)]
    got = pipeline.finding_records(spark.createDataFrame(rows, REPORT), "2025-01-01T00:00:00Z").collect()
    assert len(got) == 1
    r = got[0]
    assert (r.scvd_id, r.title, r.severity, r.severity_source, r.finding_id) == ("SCVD-d-001", "Reentrancy in vault", "High", "id_prefix", "H-01")
    assert r.target.path == "src/Vault.sol" and r.repo.name == "r" and r.repo.commit_sha == "1234567" and r.status.fixed_in_commit == "abcdef1234"
    frame = pipeline.finding_records(spark.createDataFrame(rows, REPORT), "2025-01-01T00:00:00Z")
    assert frame.where(query.Search(q="GUARD IT", texts=query.RECORD_TEXTS).predicate()).count() == 1 and frame.where(query.Search(q="absent words", texts=query.RECORD_TEXTS).predicate()).count() == 0
    assert frame.select(T.preferred(F.lit(""), F.col("sections.recommendation_md"))).first()[0].startswith("**Recommendation:**")
    assert r.description_md.startswith("**Description:**") and r.sections.impact_md == "" and r.provenance.source_pdf == "d.pdf"


def test_pipeline_dedups_records(spark):
    other = BODY.replace("[H-01] Reentrancy", "[H-02] Overflow").replace("The call re-enters.", "Numbers wrap around at the top of the range.").replace("Guard it.", "Use wider words.").replace("src/Vault.sol", "src/Math.sol")
    rows = [(k, "native", None, t, 1) for k, t in (("a", BODY), ("b", BODY), ("c", other))]
    records = pipeline.finding_records(spark.createDataFrame(rows, REPORT), "2025-01-01T00:00:00Z")
    for exact in (100, 0):
        got = {r.doc_id: r.decision for r in pipeline.deduplicated(records, threshold=0.97, exact_rows=exact).collect()}
        assert got == {"a": "canonical", "b": "duplicate", "c": "unique"}


def test_metadata_comes_from_elsewhere(spark):
    seg = spark.createDataFrame([("d", 1, 0, 3, None, "X-1", None, "1. T", "body")], "doc_id string, idx int, start_line int, end_line int, page_start int, finding_id string, severity string, heading string, markdown string")
    rep = spark.createDataFrame([("d", None, "")], "doc_id string, source_pdf string, markdown string")
    given = {"Finding ID": "Y-9", "Severity": "crit", "Target": "p/q"}
    r = normalize.records(seg, rep, "2025-01-01", metadata=lambda body, label: F.lit(given.get(label)).cast("string")).first()
    assert (r.finding_id, r.severity, r.severity_source, r.repo.relative_file) == ("Y-9", "Critical", "metadata", "p/q")


def test_hyperplanes_reach_their_recall(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((150, 24))
    v = np.concatenate([base, base + 0.5 * rng.standard_normal(base.shape), np.repeat(base[:1], 200, 0) + 0.1 * rng.standard_normal((200, 24))])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "k int, v array<double>")
    want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if v[i] @ v[j] >= 0.8}
    got = {(r.a, r.b) for r in dedup.lsh_pairs(df, "k", "v", 0.8, bits=6, block_rows=64).collect()}
    assert got <= want and len(got) >= 0.9 * len(want)  # a third of the rows share one bucket, cut into blocks
    assert dedup.lsh_pairs(df.where("false"), "k", "v", 0.8).count() == 0


def test_whole_contract(spark):
    good = {"schema_version": "0.1", "scvd_id": "a", "doc_id": "d", "finding_index": 1, "title": "t", "provenance": {"scvd_normalized_at": "x", "scvd_normalizer_version": "y"}, "repo": {"lines": [1, 2]}, "dedup": None}
    bad = good | {"finding_index": True, "repo": {"lines": [1], "x": 1}, "taxonomy": {"swc": ["a", 5, None]}, "dedup": {"decision": "other"}, "status": {"cvss": [1]}, "target": {}}
    df = spark.createDataFrame([(1, json.dumps(good)), (2, json.dumps(bad))], "n int, line string")
    got = {tuple(r)[:3] for r in validate.validate_json(df, "n", "line", validate.CONTRACT).collect()}
    assert got == {
        (2, "finding_index", "type"), (2, "repo", "additionalProperties"), (2, "repo/lines", "anyOf"), (2, "taxonomy/swc/1", "type"), (2, "taxonomy/swc/2", "type"), (2, "dedup/decision", "enum"),
        (2, "status/cvss", "type"), (2, "target", "required:path"),
    }
    with pytest.raises(ValueError):
        validate.validate_json(df, "n", "line", None)


def test_lines_of_a_file(spark, tmp_path):
    (tmp_path / "f.jsonl").write_text('{"a":1}\n\n{broken\n{"a":"x"}\n')
    schema = {"type": "object", "properties": {"a": {"type": "integer"}}}
    got = {(r.line_no, r.path, r.message) for r in validate.validate_file(spark, str(tmp_path / "f.jsonl"), schema).collect()}
    assert got == {(3, "", "invalid JSON"), (4, "a", "\"x\" is not of type 'integer'")}


def test_cursor_pages(spark):
    rows = spark.createDataFrame([(f"s{i:02d}", i) for i in range(25)], "scvd_id string, ord int")
    seen, cursor = [], None
    for _ in range(9):
        page = query.cursor_page(query.ordered(rows, None), cursor, 10).collect()
        seen += [r.ord for r in page]
        cursor = page[0].next_cursor
        if cursor is None:
            break
    assert seen == list(range(25)) and query.cursor_page(query.ordered(rows, None), "??", 3).first().ord == 0


def test_remote_issues_follow_pages_and_wait(spark):
    answers = iter([(401, {}, ""), (503, {}, ""), (403, {"X-RateLimit-Remaining": "0", "X-RateLimit-Reset": "7"}, ""), (200, {"Link": '<http://h/2>; rel="next"'}, '[{"number":1,"labels":[{"name":"high"}]}]'), (200, {}, '[{"number":2,"pull_request":{"url":"u"}}]')])
    asked, slept = [], []

    def transport(url, headers):
        asked.append((url, headers.get("Authorization")))
        return next(answers)

    rows = list(issues_api.issue_rows("http://h", "o", "r", "all", "secret", transport, sleep=slept.append, clock=lambda: 5.0))
    assert [(r[0], r[4], r[5]) for r in rows] == [(1, [("high",)], None), (2, [], ("u",))]
    assert [a for _, a in asked] == ["Bearer secret", None, None, None, "Bearer secret"] and slept[1] == 3.0
    with pytest.raises(RuntimeError):
        issues_api.fetched("http://h", {}, lambda u, h: (404, {}, ""))
    fake = lambda url, headers: (200, {}, '[{"number":5,"title":"t","labels":[],"created_at":"2024-01-02T00:00:00Z"}]')
    got = issues_api.read_remote_issues(spark, [("o", "r"), ("o", "q")], "http://h", transport=fake)
    assert {(r.issue_no, r.repo_url, r.pull_request) for r in got.collect()} == {(5, "o/r", None), (5, "o/q", None)}


def test_models_are_optional_and_read_leniently(spark):
    assert models.metadata_of(None, "x") == dict.fromkeys(models.DEFAULT_ITEMS) and models.inferred_items(None, []) == models.DEFAULT_ITEMS
    answers = iter(['text {"Severity": "High", "Type": "none"} more', '{"Type": "Logic"}'])
    got = models.metadata_of(lambda prompt, shape: next(answers), "x")
    assert got["Severity"] == "High" and got["Type"] == "Logic" and got["Target"] is None
    assert models.inferred_items(lambda p, s: '{"items": ["A", " A ", "", 3]}', ["s"]) == ("A",)
    assert models.first_sentence(lambda p, s: "broken {")("x") is None
    chunks = spark.createDataFrame([("d", 0, 50, "one"), ("d", 40, 50, "two")], "doc_id string, first_line int, n_lines int, text string")
    answer = '{"findings": [{"start_line": 3, "end_line": 99, "finding_id": "A-1", "heading": "h"}, {"start_line": 9, "end_line": 9}, {"x": 1}]}'
    found = [tuple(r) for r in models.model_segments(chunks, lambda p, s: answer).collect()]
    assert found == [("d", 1, 2, 50, "A-1", "h")] and models.model_segments(chunks, None).count() == 0


def test_small_sources(spark, tmp_path):
    assert files.csv_source(None, "a/b.jsonl", "c.jsonl") == ("a/b.jsonl", "a/b.csv") and files.csv_source("x.y/z", None, None)[1] == "x.y/z.csv"
    with pytest.raises(ValueError):
        files.csv_source(None, None, None)
    df = spark.createDataFrame([("a", "2024-01-31 10:00:00", ["x"]), ("b", "2024-02-01 10:00:00", None), ("c", None, None)], "scvd_id string, at string, tags array<string>").withColumn("normalized_at", F.col("at").cast("timestamp")).drop("at")
    files.write_snapshot(df.where("normalized_at is not null"), str(tmp_path / "s"))
    assert [r.period for r in files.snapshots(spark, str(tmp_path / "s")).collect()] == ["2024-01", "2024-02"]
    assert files.snapshot(spark, str(tmp_path / "s"), "2024-02").first().scvd_id == "b"
    files.write_csv(df, str(tmp_path / "c"), ("scvd_id", "tags", "gone"), files=1)
    assert {tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "c")).select("scvd_id", "gone").collect()} == {("a", None), ("b", None), ("c", None)}
    files.write_jsonl(df.select("scvd_id", "tags"), str(tmp_path / "j"))
    assert '"tags":null' in "".join(p.read_text() for p in (tmp_path / "j").glob("*.json"))
    found = spark.createDataFrame([("a",), ("z",), (None,)], "doc_id string")
    assert {r.doc_id for r in files.unprocessed(found, df.select(F.col("scvd_id").alias("doc_id"))).collect()} == {"z", None}
    assert spark.range(1).select(files.output_path(F.lit("x-v2.0"), "json")).first()[0] == "x-v2.0.json"
    (tmp_path / "p.pdf").write_bytes(b"%PDF")
    assert files.read_documents(spark, str(tmp_path), lambda b: b.decode()).first().markdown == "%PDF"
    broken = files.read_documents(spark, str(tmp_path), lambda b: 1 / 0).first()
    assert broken.markdown is None and broken.error.startswith("ZeroDivisionError")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "z.md").write_text("z")
    (tmp_path / "a.MD").write_text("a")
    assert [(r.doc_id, r.kind) for r in files.discovered(spark, str(tmp_path)).collect()] == [("a", "md"), ("b_z", "md"), ("p", "pdf")]
    with pytest.raises(ValueError):
        files.read_documents(spark, str(tmp_path))


def test_links_in_texts(spark):
    urls = F.array(F.lit("https://github.com/o/r"), F.lit("https://github.com/o/r/blob/abcdef0/src/a.sol#L3-L9"))
    got = spark.range(1).select(T.blob_reference(urls).alias("b"), T.line_of_offset(F.lit("a\nb\nc"), F.lit(4)).alias("n")).first()
    assert (got.b.path, got.b.line_span, got.n) == ("src/a.sol", [3, 9], 2)
    ids = spark.createDataFrame([(None, 3), ("x", 4)], "k string, o int")
    assert {r.k for r in dedup.with_ids(ids, "k", "o").collect()} == {"idx-3", "x"}


def test_rules_of_a_file(spark, tmp_path):
    items = [{"id": "S-1", "aliases": ["Reentrancy"], "keywords": ["re-enter"], "regex": ["call\\{", "(bad"], "relationships": {"cwe": [{"id": "CWE-841"}]}}, {"id": "S-2"}]
    (tmp_path / "v.json").write_text(json.dumps({"matching_defaults": {"regex_flags": "ix"}, "items": items}))
    one, two = classify.load_rules(str(tmp_path / "v.json"))
    assert (one.regex, one.cwe, two.keyword) == (["(?i)call\\{"], ["CWE-841"], [])
    df = spark.createDataFrame([("a", "T", "they RE-ENTER by CALL{", "reentrancy"), ("b", None, None, None)], "k string, title string, description string, type string")
    got = {(r.k, r.rule_id): r.score for r in classify.scores(df, "k", {"title": F.col("title"), "description": F.col("description")}, F.col("type"), [one, two]).collect()}
    assert got == {("a", "S-1"): 6.5, ("a", "S-2"): 0.0, ("b", "S-1"): 0.0, ("b", "S-2"): 0.0}


def test_issue_dump_in_order(spark, tmp_path):
    lines = [{"issue_no": n, "repo_url": "https://github.com/o/r", "title": f"t{n}", "body": "b", "labels": [{"name": "low"}], "opened_at": "2024-01-01T00:00:00Z"} for n in (9, 2, 5)]
    (tmp_path / "i.json").write_text("\n".join(map(json.dumps, lines)))
    got = issues.ordered_sections(files.read_issues(spark, str(tmp_path / "i.json"))).orderBy("place").collect()
    assert [(r.place, r.idx) for r in got] == [(1, 2), (2, 5), (3, 9)]


def test_windows_of_event_time(spark, tmp_path):
    from auditlake.streaming.ingest import windowed_counts

    rows = [("2024-01-01 01:00:00", "a"), ("2024-01-01 23:00:00", "a"), ("2024-01-02 01:00:00", "b")]
    spark.createDataFrame(rows, "at string, k string").withColumn("at", F.col("at").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("at timestamp, k string").parquet(str(tmp_path / "in"))
    counts = windowed_counts(stream, "at", "k")
    counts.writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert {(str(r.window_start)[:10], r.k, r.n) for r in spark.table("windows").collect()} == {("2024-01-01", "a", 2), ("2024-01-02", "b", 1)}
