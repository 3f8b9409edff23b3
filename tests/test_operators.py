import random

from pyspark.sql import functions as F

from auditlake.operators import classify, dedup, issues, query, repos, sections, segment, validate
from auditlake.operators.graph import chase_roots, connected_components


def test_components_against_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 340)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    for small in (1_000, 0):  # in one task, and in rounds
        got = connected_components(spark.createDataFrame([*edges, (None, 1)], "a int, b int"), small_links=small)
        assert {r.node: r.component for r in got.collect()} == want
        assert connected_components(spark.createDataFrame([], "a int, b int"), small_links=small).count() == 0
    names = spark.createDataFrame([("b", "c"), ("a", "b"), ("x", "y")], "a string, b string")
    assert {tuple(r) for r in connected_components(names).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}


def test_roots_of_chains_and_cycles(spark):
    rows = [("b", "a"), ("c", "b"), ("d", "c"), ("x", "y"), ("y", "x"), ("z", "x"), ("q", None)]
    got = chase_roots(spark.createDataFrame(rows, "id string, parent string"), "id", "parent")
    assert {tuple(r) for r in got.collect()} == {("b", "a"), ("c", "a"), ("d", "a")}


MD = """# Report

# High Risk Findings

## [H-01] First
### Description
text
## Second
body

# Low

## [M-02] Third
x

# Notes
## [L-03] Outside
"""


def test_severity_blocks(spark):
    df = spark.createDataFrame([("d", MD), ("e", ""), ("n", None)], "doc_id string, markdown string")
    got = [(r.idx, r.finding_id, r.severity, r.heading) for r in segment.severity_blocks(df).orderBy("idx").collect()]
    assert got == [(1, "H-01", "High", "1. First"), (2, None, "High", "2. Second"), (3, "M-02", "Medium", "3. Third"), (4, "L-03", "Low", "4. Outside")]


def test_span_and_table_segments(spark):
    span = '# <span id="page-1-0"></span>Intro\n# <span id="page-2-0"></span>1. One\na\n# <span id="page-3-0"></span>\n| 2.<br>x\n# <span id="page-4-0"></span>2. Two\nb\n# <span id="page-9-0"></span>A. Categories\nz'
    ids = "| ID | Description | Severity | Status |\n|---|---|---|---|\n| ADX-01 | One | Low | Open |\n\n{3}----\n| ADX-01 | One |\ntext\n| ZZZ-09 | no |\n# Appendix\nend"
    df = spark.createDataFrame([("s", span), ("t", ids), ("u", "plain")], "doc_id string, markdown string")
    got = [(r.doc_id, r.idx, r.page_start, r.finding_id, r.heading, r.start_line, r.end_line) for r in segment.segments(df, native=F.lit(False)).orderBy("doc_id", "idx").collect()]
    assert got == [("s", 1, 2, None, "1. One", 1, 5), ("s", 2, 4, None, "2. Two", 5, 7), ("t", 1, 3, "ADX-01", "1. One", 5, 8)]


def test_sections(spark):
    body = "# T\n\npre\n\n**Impact:** i\n\n## Proof of Concept\n```\n**Not:** a label\n```\n\n**Vendor:** seen\n"
    df = spark.createDataFrame([("k", body), ("plain", "just text\n"), ("empty", "")], "k string, body string")
    got = {r.k: r for r in sections.split_sections(df, "k", "body").collect()}
    assert got["k"].description == "pre\n" and got["k"].impact == "**Impact:** i\n" and "Not" in got["k"].poc and got["k"].other == "**Vendor:** seen\n"
    assert got["plain"].description == "just text\n" and got["empty"].description is None


def test_attribution_prefers_evidence(spark):
    f = spark.createDataFrame([("f", "d", 4, "src/A.sol"), ("g", "none", None, None)], "scvd_id string, doc_id string, page_start int, path string")
    r = spark.createDataFrame([("d", 0, "u0", "o", "publications", None, None, ""), ("d", 1, "u1", "o", "a", "abc", 30, "x"), ("d", 2, "u2", "o", "b", None, 6, "see A.sol")], "doc_id string, ord int, url string, org string, repo string, commit_sha string, page int, snippet string")
    got = {x.scvd_id: (x.url, x.score) for x in repos.attribute(f, r).collect()}
    assert got == {"f": ("u2", 5), "g": (None, None)}


def test_issue_rules(spark):
    rows = [(["high"], "t"), (["QA (Quality Assurance)"], "t"), (["gas-opt"], "t"), ([], "t"), (None, "t"), (["allowed"], "Gas optimizations"), (["allowed"], None)]
    df = spark.createDataFrame([([(x,) for x in a] if a is not None else None, t) for a, t in rows], "labels array<struct<name:string>>, title string")
    assert [r[0] for r in df.select(issues.is_included(F.col("labels"), F.col("title"))).collect()] == [True, True, False, False, False, False, True]
    assert [r[0] for r in df.select(issues.label_severity(F.col("labels"))).collect()][-1] == "Low"


def test_similar_pairs_in_blocks_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    v = rng.standard_normal((60, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(99, None)], "k int, v array<double>")
    got = {(r.a, r.b) for r in dedup.similar_pairs(df, "k", "v", 0.5, block_rows=16).collect()}
    assert got == {(i, j) for i in range(60) for j in range(i + 1, 60) if v[i] @ v[j] >= 0.5}


def test_scores_and_decisions(spark):
    pairs = spark.createDataFrame([("a", "b", 0.75), ("b", "c", 0.81), ("c", "d", 0.9)], "a string, b string, cos double")
    rows = spark.createDataFrame([(k, "r", None, "p" if k in "ab" else None, ["", "x"]) for k in "abcde"], "id string, repo_url string, commit_sha string, path string, tags array<string>")
    scored = dedup.scored_pairs(pairs, rows, "id")
    assert {(r.a, r.b) for r in scored.collect()} == {("a", "b"), ("c", "d")}  # a repository alone lifts nothing
    got = {r.id: r.decision for r in dedup.decisions(rows, "id", scored.select("a", "b")).collect()}
    assert got == {"a": "canonical", "b": "duplicate", "c": "canonical", "d": "duplicate", "e": "unique"}


def test_validation(spark):
    lines = ['{"scvd_id":"a","doc_id":"d","finding_index":1,"title":"t","provenance":{"source_pdf":null}}', "  ", "{broken", '{"scvd_id":"","doc_id":"d","finding_index":true,"title":"t","provenance":{},"x":1,"repo":{"line_span":[1]}}']
    df = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    found = validate.validate_json(df, "n", "line", validate.FINDING_SCHEMA)
    assert found.where("keyword = 'type'").first().message == "true is not of type 'integer', 'string'"
    got = {tuple(r) for r in found.drop("message").collect()}
    assert got == {(2, "", "json"), (3, "scvd_id", "minLength"), (3, "finding_index", "type"), (3, "", "additionalProperties"), (3, "provenance", "required:source_pdf"), (3, "repo/line_span", "anyOf")}


def test_winners_take_k_then_delta(spark):
    scored = spark.createDataFrame([("x", "A", 0, 3.0), ("x", "B", 1, 2.5), ("x", "C", 2, 2.4), ("y", "A", 0, 0.0), ("z", "A", 0, 5.0), ("z", "B", 1, 3.0)], "k string, rule_id string, rule_ord int, score double")
    assert {(r.k, r.rule_id) for r in classify.winners(scored, "k").collect()} == {("x", "A"), ("x", "B"), ("z", "A")}


def test_pages_concatenate_to_the_order(spark):
    rows = spark.createDataFrame([(f"s{i}", "High" if i % 3 else None, i) for i in range(25)], "scvd_id string, severity string, ord int")
    whole = [r.ord for r in query.ordered(rows, "severity").collect()]
    assert [r.ord for k in range(0, 30, 10) for r in query.page(query.ordered(rows, "severity"), k, 10).collect()] == whole
