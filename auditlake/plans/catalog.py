"""All queries of the core, with the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditlake.functions import text as T
from auditlake.functions.headings import md_headings
from auditlake.operators import classify, dedup, issues, query, repos, sections, segment, validate
from auditlake.plans import pipeline
from auditlake.runtime import table
from auditlake.sources import files

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
#: Hosts of repositories in the test tables.
HOSTS = ("git.ledgerforge.example", "code.harborlane.test")
_HOST = "(?:git\\.ledgerforge\\.example|code\\.harborlane\\.test)"
_BLANK = "[\\s\\x{a0}\\x{2007}\\x{202f}]"


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        _QUERIES[query.__name__] = query
        if sql:
            _SQL[query.__name__] = sql
        return query

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return q_segments_by_severity(spark, d)


def _findings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "findings")


def _once(rows: DataFrame) -> DataFrame:
    """Redelivered rows once; their content is the same, so conditions and projections come first."""
    return rows.dropDuplicates(["scvd_id"])


_ONCE = "f AS (SELECT * FROM findings QUALIFY row_number() OVER (PARTITION BY scvd_id ORDER BY loaded_at DESC) = 1)"
_RANK = "CASE lower(severity) WHEN 'informational' THEN 0 WHEN 'not critical' THEN 1 WHEN 'low' THEN 2 WHEN 'medium' THEN 3 WHEN 'high' THEN 4 WHEN 'critical' THEN 5 WHEN 'gas' THEN 6 WHEN 'qa' THEN 7 ELSE -1 END"


# filters, orders, pages, aggregates


@register(f"""WITH {_ONCE} SELECT scvd_id, title FROM f
WHERE contains(lower(array_to_string(list_filter([title, description_md, recommendation_md, poc_md], lambda x: x IS NOT NULL AND x <> ''), ' ')), 'withdrawal queue')""")
def q_findings_text_search(spark: SparkSession, d: str) -> DataFrame:
    return _once(_findings(spark, d).where(query.Search(q="Withdrawal Queue").predicate()).select("scvd_id", "title"))


@register(f"""WITH {_ONCE} SELECT scvd_id, severity, target.chain AS chain FROM f
WHERE lower(coalesce(severity, '')) = 'high' AND lower(coalesce(target.chain, '')) = 'borealis' AND contains(lower(coalesce(repo.url, '')), 'ledgerforge')""")
def q_findings_multi_filter(spark: SparkSession, d: str) -> DataFrame:
    search = query.Search(severity="HIGH", chain="Borealis", repo="LedgerForge")
    return _once(_findings(spark, d).where(search.predicate()).select("scvd_id", "severity", F.col("target.chain").alias("chain")))


@register(f"""WITH {_ONCE} SELECT scvd_id FROM f WHERE list_contains(list_transform(taxonomy.swc, lambda x: lower(x)), 'swc-107')""")
def q_findings_by_class(spark: SparkSession, d: str) -> DataFrame:
    return _once(_findings(spark, d).where(query.Search(swc="swc-107").predicate()).select("scvd_id"))


@register(f"""WITH {_ONCE} SELECT scvd_id FROM f WHERE provenance.scvd_normalized_at::TIMESTAMPTZ >= TIMESTAMPTZ '2023-01-01 00:00:00+00'
AND provenance.scvd_normalized_at::TIMESTAMPTZ < TIMESTAMPTZ '2023-07-01 00:00:00+00'""")
def q_findings_time_range(spark: SparkSession, d: str) -> DataFrame:
    search = query.Search(since="2023-01-01T00:00:00Z", until="2023-07-01T00:00:00Z")
    return _once(_findings(spark, d).where(search.predicate()).select("scvd_id"))


@register(f"""WITH {_ONCE} SELECT scvd_id, {_RANK} AS sev_rank FROM f ORDER BY sev_rank DESC, scvd_id LIMIT 100 OFFSET 200""")
def q_findings_sort_severity_page(spark: SparkSession, d: str) -> DataFrame:
    rows = _once(_findings(spark, d).select("scvd_id", "severity", T.severity_rank(F.col("severity")).alias("sev_rank")))
    return query.page(query.ordered(rows, "severity", "desc", "scvd_id"), 200, 100).select("scvd_id", "sev_rank")


@register("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 200000 OR (o_totalprice = 200000 AND o_orderkey > 0)
ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""")
def q_findings_sorted_keyset(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return query.after(rows, F.col("o_totalprice"), "o_orderkey", 200000.0, 0, 50)


@register("""SELECT scvd_id, max(loaded_at) AS loaded_at, count(*) AS n_deliveries FROM findings GROUP BY scvd_id""")
def q_point_lookup_last_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "findings").select("scvd_id", "loaded_at", F.col("loaded_at").alias("ord"))
    counts = rows.groupBy("scvd_id").agg(F.count("*").alias("n_deliveries"))
    return query.last_by_id(rows).drop("ord").join(counts, "scvd_id")


@register("""SELECT o_orderkey AS off, replace(replace(base64(encode(o_orderkey::VARCHAR)), '+', '-'), '/', '_') AS cursor, o_orderkey AS decoded, 0 AS bad FROM orders""")
def q_cursor_codec(spark: SparkSession, d: str) -> DataFrame:
    cursor = T.cursor_encode(F.col("o_orderkey"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("off"), cursor.alias("cursor"), T.cursor_decode(cursor).alias("decoded"), T.cursor_decode(F.lit("??")).cast("int").alias("bad"))


@register("""SELECT count(*) AS n_findings, count(DISTINCT doc_id) + coalesce(max(CASE WHEN doc_id IS NULL THEN 1 END), 0) AS n_reports FROM findings""")
def q_stats_totals(spark: SparkSession, d: str) -> DataFrame:
    return query.totals(table(spark, d, "findings"))


@register("""SELECT coalesce(nullif(severity, ''), 'null') AS severity, count(*) AS n, min(scvd_id) AS first_seen FROM findings GROUP BY 1""")
def q_stats_by_severity(spark: SparkSession, d: str) -> DataFrame:
    return query.by_severity(table(spark, d, "findings"), "scvd_id")


@register("""WITH e AS (SELECT scvd_id, unnest(taxonomy.tags) AS tag, generate_subscripts(taxonomy.tags, 1) AS p FROM findings)
SELECT tag, count(*) AS n, min(scvd_id) AS first_seen FROM e GROUP BY tag ORDER BY n DESC, min((scvd_id, p)) LIMIT 20""")
def q_stats_top_tags(spark: SparkSession, d: str) -> DataFrame:
    return query.top_tags(table(spark, d, "findings"), "taxonomy.tags", 20, "scvd_id")


@register("""SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_docs, count(DISTINCT repo.url) AS n_repos FROM findings""")
def q_dashboard_kpis(spark: SparkSession, d: str) -> DataFrame:
    return query.kpis(table(spark, d, "findings"))


@register(f"""WITH {_ONCE} SELECT doc_id, finding_index, title, coalesce(nullif(severity, ''), 'unknown') AS severity,
row_number() OVER (PARTITION BY doc_id ORDER BY finding_index, scvd_id) AS place FROM f""")
def q_dashboard_table(spark: SparkSession, d: str) -> DataFrame:
    by = W.partitionBy("doc_id").orderBy("finding_index", "scvd_id")
    rows = _once(_findings(spark, d).select("scvd_id", "doc_id", "finding_index", "title", "severity"))
    return rows.select("doc_id", "finding_index", "title", F.coalesce(T.absent(F.col("severity")), F.lit("unknown")).alias("severity"), F.row_number().over(by).alias("place"))


@register("""SELECT scvd_id, doc_id, title, target.chain AS "target.chain", target.path AS "target.path", repo.url AS "repo.url", repo.commit_sha AS "repo.commit_sha",
'' AS "severity.level" FROM findings""")
def q_flatten_csv_projection(spark: SparkSession, d: str) -> DataFrame:
    wanted = ("scvd_id", "doc_id", "title", "target.chain", "target.path", "repo.url", "repo.commit_sha", "severity.level")
    return files.flattened(table(spark, d, "findings"), wanted)


# text functions


@register("""WITH l AS (SELECT unnest(labels).name AS name FROM issues)
SELECT name, regexp_replace(regexp_replace(lower(trim(name, chr(32) || chr(9) || chr(10) || chr(160))), '[_\\-:/]+', ' ', 'g'), '\\s+', ' ', 'g') AS norm, count(*) AS n FROM l WHERE name IS NOT NULL GROUP BY 1, 2""")
def q_label_norm(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "issues").select(F.explode("labels").alias("l")).select("l.name").where("name is not null")
    return names.groupBy("name", T.label_norm(F.col("name")).alias("norm")).agg(F.count("*").alias("n"))


@register("""SELECT scvd_id, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) AS key FROM findings""")
def q_heading_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "findings").select("scvd_id", T.heading_key(F.col("title")).alias("key"))


_WORDS = "CASE " + " ".join(f"WHEN regexp_matches(t, '(^|[^a-z0-9_]){w}([^a-z0-9_]|$)') THEN '{v}'" for w, v in T.SEVERITY_WORDS) + " END"


@register(f"""WITH l AS (SELECT doc_id, unnest(string_split(markdown, chr(10))) AS line FROM report),
h AS (SELECT doc_id, line, lower(regexp_replace(line, '^#+\\s+', '')) AS t FROM l WHERE regexp_matches(line, '^#{{1,6}}\\s+\\S'))
SELECT doc_id, line, CASE WHEN contains(t, 'criteria') OR contains(t, 'summary') THEN NULL ELSE {_WORDS} END AS severity FROM h""")
def q_heading_severity(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "report").select("doc_id", F.explode(F.split("markdown", "\n")).alias("line")).where(F.col("line").rlike(r"^#{1,6}\s+\S"))
    return lines.select("doc_id", "line", T.heading_severity(F.regexp_replace("line", r"^#+\s+", "")).alias("severity"))


@register(f"""SELECT scvd_id, coalesce(CASE upper(string_split(finding_id, '-')[1]) WHEN 'C' THEN 'Critical' WHEN 'H' THEN 'High' WHEN 'M' THEN 'Medium' WHEN 'L' THEN 'Low' WHEN 'NC' THEN 'Informational' END,
CASE regexp_replace(regexp_replace(lower(regexp_replace(severity, '^{_BLANK}+|{_BLANK}+$', '', 'g')), '[_-]', ' ', 'g'), '^{_BLANK}+|{_BLANK}+$', '', 'g')
WHEN 'crit' THEN 'Critical' WHEN 'critical' THEN 'Critical' WHEN 'high' THEN 'High' WHEN 'med' THEN 'Medium' WHEN 'medium' THEN 'Medium' WHEN 'low' THEN 'Low'
WHEN 'info' THEN 'Informational' WHEN 'informational' THEN 'Informational' WHEN 'non critical' THEN 'Informational' WHEN 'nc' THEN 'Informational' END) AS effective,
CASE WHEN upper(string_split(finding_id, '-')[1]) IN ('C', 'H', 'M', 'L', 'NC') THEN 'id_prefix'
WHEN regexp_replace(regexp_replace(lower(regexp_replace(severity, '^{_BLANK}+|{_BLANK}+$', '', 'g')), '[_-]', ' ', 'g'), '^{_BLANK}+|{_BLANK}+$', '', 'g')
IN ('crit', 'critical', 'high', 'med', 'medium', 'low', 'info', 'informational', 'non critical', 'nc') THEN 'metadata' END AS source FROM findings""")
def q_severity_canonical(spark: SparkSession, d: str) -> DataFrame:
    value, source = T.effective_severity(F.col("finding_id"), F.col("severity"), F.lit(None).cast("string"))
    return table(spark, d, "findings").select("scvd_id", value.alias("effective"), source.alias("source"))


@register("""SELECT scvd_id, nullif(regexp_extract(fix_status, '([0-9a-fA-F]{7,40})', 1), '') AS fix_commit FROM findings""")
def q_fix_commit(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "findings").select("scvd_id", T.first_commit(F.col("fix_status")).alias("fix_commit"))


@register("""SELECT l_orderkey, l_linenumber, 'SCVD-' || l_orderkey || '-' || CASE WHEN l_linenumber * 300 < 1000 THEN lpad((l_linenumber * 300)::VARCHAR, 3, '0') ELSE (l_linenumber * 300)::VARCHAR END AS id FROM lineitem""")
def q_scvd_id(spark: SparkSession, d: str) -> DataFrame:
    key = T.finding_key(F.col("l_orderkey").cast("string"), (F.col("l_linenumber") * 300).cast("string"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", key.alias("id"))


@register("""SELECT scvd_id, CASE WHEN lower(trim(target.contract_name)) IN ('', 'null', 'none') THEN NULL ELSE target.contract_name END AS folded FROM findings""")
def q_null_fold(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "findings").select("scvd_id", T.null_folded(F.col("target.contract_name")).alias("folded"))


@register("""SELECT scvd_id, epoch_us(provenance.scvd_normalized_at::TIMESTAMPTZ) AS micros FROM findings""")
def q_iso_instant(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "findings").select("scvd_id", F.unix_micros(T.iso_instant(F.col("provenance.scvd_normalized_at"))).alias("micros"))


_SPACE = "[\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def _trimmed(sql: str) -> str:
    return f"regexp_replace({sql}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _signature_sql() -> str:
    part = lambda c: _trimmed(f"regexp_replace(coalesce({c}, ''), '{_SPACE}+', ' ', 'g')") if c else "''"
    parts = ", ".join(map(part, ("title", "description_md", "", "recommendation_md", "poc_md", "target.path", "repo.relative_file")))
    return "sha256(" + _trimmed(f"array_to_string([{parts}, coalesce(array_to_string(taxonomy.swc, ' '), '')], chr(10))") + ")"


@register(f"""WITH {_ONCE}, s AS (SELECT scvd_id, {_signature_sql()} AS signature FROM f)
SELECT scvd_id, signature, min(scvd_id) OVER (PARTITION BY signature) AS canonical, count(*) OVER (PARTITION BY signature) AS n FROM s""")
def q_sha_signature_groups(spark: SparkSession, d: str) -> DataFrame:
    text = T.signature_text(*[F.col(c) for c in ("title", "description_md")], F.lit(None).cast("string"), *[F.col(c) for c in ("recommendation_md", "poc_md", "target.path", "repo.relative_file", "taxonomy.swc")])
    signed = _once(_findings(spark, d).select("scvd_id", F.sha2(text, 256).alias("signature")))
    return dedup.signature_groups(signed, "scvd_id")


@register("""SELECT doc_id, sha256(text) AS signature, min(doc_id) OVER (PARTITION BY sha256(text)) AS canonical, count(*) OVER (PARTITION BY sha256(text)) AS n
FROM documents WHERE text IS NOT NULL""")
def q_exact_dup_canonical(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact_signatures(table(spark, d, "documents").where("text is not null"), "doc_id", F.col("text"))


_PARTS = "array_to_string(list_filter([title, description_md, recommendation_md, poc_md], lambda x: x IS NOT NULL AND x <> ''), chr(10) || chr(10))"


@register(f"""WITH {_ONCE} SELECT scvd_id, md5({_trimmed(_PARTS)}) AS digest FROM f""")
def q_embed_text(spark: SparkSession, d: str) -> DataFrame:
    text = T.embed_text(*[F.col(c) for c in ("title", "description_md", "recommendation_md", "poc_md")])
    return _once(_findings(spark, d).select("scvd_id", F.md5(text).alias("digest")))


@register("""WITH b AS (SELECT scvd_id, CASE WHEN severity IS NULL THEN title || ' Type: x' ELSE '7. ' || title || ' Severity: ' || severity || ' Type: y' END AS heading, title FROM findings)
SELECT scvd_id, regexp_replace(trim(string_split(title, 'Type:')[1], ' '), '^\\s*\\d+\\.\\s*', '') AS cleaned, 'Row ' || left(scvd_id, 4) AS by_row FROM b""")
def q_cleaned_heading(spark: SparkSession, d: str) -> DataFrame:
    """Headings with metadata run into them, and headings that only repeat one, for which the title row counts."""
    title, none = F.col("title"), F.lit(None).cast("string")
    heading = F.when(F.col("severity").isNull(), F.concat(title, F.lit(" Type: x"))).otherwise(F.concat(F.lit("7. "), title, F.lit(" Severity: "), F.col("severity"), F.lit(" Type: y")))
    row = F.concat(F.lit("text\n| 6. Not this |\n | 7. Row<br>"), F.substring("scvd_id", 1, 4), F.lit(" | x |\n| 7. Nor this |"))
    repeated = T.cleaned_heading(F.lit("7. T (from Detailed Findings)"), F.lit(7), row)
    return _findings(spark, d).select("scvd_id", T.cleaned_heading(heading, F.lit(7), none).alias("cleaned"), repeated.alias("by_row"))


@register("""WITH l AS (SELECT doc_id, unnest(string_split(markdown, chr(10))) AS line, generate_subscripts(string_split(markdown, chr(10)), 1) AS i FROM report),
k AS (SELECT doc_id, i, rtrim(regexp_replace(regexp_replace(line, '<br\\s*/?>', ' ', 'gi'), '</?span[^>]*>', '', 'gi'), ' ' || chr(9)) AS line FROM l
WHERE NOT regexp_matches(trim(line, ' ' || chr(9) || chr(13)), '^\\{\\d+\\}\\s*-+$') AND NOT regexp_matches(trim(line, ' ' || chr(9) || chr(13)), '(?i)^!?\\[\\]\\([^)]*\\.(?:jpe?g|png|gif)\\)$'))
SELECT doc_id, md5(trim(string_agg(line, chr(10) ORDER BY i), ' ' || chr(9) || chr(10)) || chr(10)) AS digest FROM k GROUP BY doc_id""")
def q_clean_markdown(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "report").select("doc_id", F.md5(T.clean_markdown(F.col("markdown"))).alias("digest"))


# issues


_INCLUDED = """labels IS NOT NULL AND len(labels) > 0
AND NOT list_bool_or([n IN ('qa', 'quality assurance', 'qa report', 'gas', 'gas optimization', 'gas optimizations', 'gas optimisation', 'invalid', 'unsatisfactory')
  OR (starts_with(n, 'gas') AND contains(n, 'opt')) OR starts_with(n, 'quality assurance')
  FOR n IN list_transform(list_filter(list_transform(labels, lambda x: x.name), lambda x: x IS NOT NULL AND x <> ''), lambda x: regexp_replace(regexp_replace(lower(trim(x, chr(32) || chr(9) || chr(10) || chr(160))), '[_\\-:/]+', ' ', 'g'), '\\s+', ' ', 'g'))] || [false])
AND NOT regexp_matches(coalesce(title, ''), '(?i)\\bqa(\\s*report)?\\b') AND NOT regexp_matches(coalesce(title, ''), '(?i)\\bgas\\s+optimization(s)?\\b')"""


@register(f"""SELECT DISTINCT repo_url, issue_no FROM issues WHERE pull_request IS NULL AND {_INCLUDED}""")
def q_issue_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "issues").where(F.col("pull_request").isNull() & issues.is_included(F.col("labels"), F.col("title")))
    return rows.select("repo_url", "issue_no").distinct()


_LOW = "list_transform(list_filter(list_transform(labels, lambda x: x.name), lambda x: x IS NOT NULL AND x <> ''), lambda x: lower(x))"
_HAS = lambda words: "CASE " + " ".join(f"WHEN len(list_filter({_LOW}, lambda x: contains(x, '{w}'))) > 0 THEN '{v}'" for w, v in words) + " END"


@register(f"""SELECT DISTINCT repo_url, issue_no, CASE WHEN len(list_filter({_LOW}, lambda x: x IN ('invalid', 'unsatisfactory'))) > 0 THEN NULL ELSE {_HAS(issues.SEVERITY_LABELS)} END AS severity,
CASE WHEN len(list_filter({_LOW}, lambda x: x IN ('invalid', 'unsatisfactory'))) = 0 THEN {_HAS(issues.CATEGORY_LABELS)} END AS category FROM issues WHERE labels IS NOT NULL""")
def q_issue_severity(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "issues").where("labels is not null")
    return rows.select("repo_url", "issue_no", issues.label_severity(F.col("labels")).alias("severity"), issues.label_category(F.col("labels")).alias("category")).distinct()


@register(f"""WITH o AS (SELECT * FROM issues WHERE pull_request IS NULL AND {_INCLUDED} QUALIFY row_number() OVER (PARTITION BY repo_url, issue_no ORDER BY opened_at DESC, title DESC) = 1)
SELECT repo_url, 'github:' || regexp_extract(repo_url, '([^/]+/[^/]+?)/*$', 1) AS doc_id, count(*) AS n_sections, min(issue_no) AS first_issue, max(issue_no) AS last_issue FROM o GROUP BY repo_url""")
def q_issue_reports(spark: SparkSession, d: str) -> DataFrame:
    return issues.issue_reports(table(spark, d, "issues")).select("repo_url", "doc_id", "n_sections", "first_issue", "last_issue")


# vectors


_DOT = "list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"


@register(f"""SELECT a.vec_id AS a, b.vec_id AS b, round({_DOT}, 6) AS cos FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {_DOT} >= 0.35""")
def q_embedding_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.similar_pairs(table(spark, d, "embeddings"), "vec_id", "embedding", 0.35).select("a", "b", F.round("cos", 6).alias("cos"))


def _vector_rows(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return table(spark, d, "embeddings").select(
        "vec_id", none.alias("repo_url"), none.alias("commit_sha"), F.col("label").cast("string").alias("path"), F.array(F.col("label").cast("string"), F.lit("x")).alias("tags")
    )


def _scored(spark: SparkSession, d: str, threshold: float = 0.42, boost: float = 0.1) -> DataFrame:
    pairs = dedup.similar_pairs(table(spark, d, "embeddings"), "vec_id", "embedding", threshold - boost)
    return dedup.scored_pairs(pairs, _vector_rows(spark, d), "vec_id", threshold, boost)


_SCORED = f"""s AS (SELECT a.vec_id AS a, b.vec_id AS b, {_DOT} AS cos, {_DOT} + CASE WHEN a.label = b.label THEN 0.1 ELSE 0 END AS score, a.label AS la, b.label AS lb
FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id), p AS (SELECT * FROM s WHERE score >= 0.42 AND cos > 0)"""


@register(f"""WITH {_SCORED} SELECT a, b, round(score, 6) AS score, CASE WHEN la = lb THEN 1.0 ELSE 0.0 END::DOUBLE AS path_match, CASE WHEN la = lb THEN la::VARCHAR END AS shared_path,
CASE WHEN la = lb THEN 1.0 ELSE round(1.0::DOUBLE / 3, 6) END::DOUBLE AS tag_overlap FROM p""")
def q_dedup_score_boost(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("a", "b", F.round("score", 6).alias("score"), "path_match", "shared_path", F.round("tag_overlap", 6).alias("tag_overlap"))


@register(f"""WITH RECURSIVE {_SCORED}, e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT vec_id AS node, vec_id AS reach FROM embeddings UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a),
c AS (SELECT node, min(reach) AS root, count(*) AS size FROM r GROUP BY node)
SELECT node AS vec_id, CASE WHEN size > 1 THEN root END AS canonical_id, CASE WHEN size = 1 THEN 'unique' WHEN root = node THEN 'canonical' ELSE 'duplicate' END AS decision FROM c""")
def q_dedup_components(spark: SparkSession, d: str) -> DataFrame:
    return dedup.decisions(table(spark, d, "embeddings"), "vec_id", _scored(spark, d).select("a", "b"))


@register(f"""WITH {_SCORED}, n AS (SELECT a AS id, b AS other, score FROM p UNION ALL SELECT b, a, score FROM p)
SELECT id, other, round(score, 6) AS score, row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS place FROM n
QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, other) <= 5""")
def q_dedup_topk(spark: SparkSession, d: str) -> DataFrame:
    return dedup.neighbours(_scored(spark, d)).select("id", "other", F.round("score", 6).alias("score"), "place")


@register("""WITH b AS (SELECT l_orderkey, list(DISTINCT l_partkey % 50) AS parts FROM lineitem GROUP BY l_orderkey)
SELECT x.l_orderkey AS a, y.l_orderkey AS b, round(len(list_intersect(x.parts, y.parts))::DOUBLE / len(list_distinct(list_concat(x.parts, y.parts))), 6) AS jac
FROM b x JOIN b y ON y.l_orderkey = x.l_orderkey + 1""")
def q_jaccard_tags(spark: SparkSession, d: str) -> DataFrame:
    baskets = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set((F.col("l_partkey") % 50).cast("string")).alias("parts"))
    x, y = baskets.select(F.col("l_orderkey").alias("a"), F.col("parts").alias("pa")), baskets.select(F.col("l_orderkey").alias("b"), F.col("parts").alias("pb"))
    return x.join(y, F.col("b") == F.col("a") + 1).select("a", "b", F.round(dedup.jaccard(F.col("pa"), F.col("pb")), 6).alias("jac"))


# segmentation: every query reads the whole report table


_SPLIT = "string_split_regex(regexp_replace(markdown, '(\\r\\n|[\\r\\n])$', ''), '\\r\\n|[\\r\\n\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]')"
_LINES = f"l AS (SELECT doc_id, unnest({_SPLIT}) AS line, generate_subscripts({_SPLIT}, 1) - 1 AS i FROM report WHERE markdown <> '')"
_HEADS = f"""{_LINES}, size AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id),
fence AS (SELECT *, (count(*) FILTER (regexp_matches(line, '^ {{0,3}}(```|~~~)')) OVER (PARTITION BY doc_id ORDER BY i)) % 2 AS inside FROM l),
t AS (SELECT doc_id, i, length(regexp_extract(line, '^ {{0,3}}(#{{1,6}})\\s', 1)) AS level, regexp_extract(line, '^ {{0,3}}#{{1,6}}\\s+(.*?)(?:\\s+#+)?\\s*$', 1) AS title FROM fence
  WHERE inside = 0 AND regexp_matches(line, '^ {{0,3}}#{{1,6}}\\s+\\S'))"""
_BLOCKS = f"""{_HEADS}, w AS (SELECT *, CASE split_part(upper(regexp_extract(title, '^\\[([A-Za-z]{{1,6}}-\\d{{1,4}})\\]\\s+\\S', 1)), '-', 1) WHEN 'C' THEN 'Critical' WHEN 'H' THEN 'High' WHEN 'M' THEN 'Medium' WHEN 'L' THEN 'Low' WHEN 'NC' THEN 'Informational' END AS by_id,
  nullif(regexp_extract(title, '^\\[([A-Za-z]{{1,6}}-\\d{{1,4}})\\]\\s+\\S', 1), '') AS finding_id,
  regexp_matches(lower(title), 'description|impact|proof of concept|proof-of-concept|poc|exploit|recommended mitigation|recommendations|mitigation|resolution|fix status|test case|background|overview') AS sub,
  CASE WHEN regexp_matches(lower(title), 'criteria|summary') THEN NULL WHEN regexp_matches(lower(title), '\\bcritical\\b') THEN 'Critical' WHEN regexp_matches(lower(title), '\\bhigh\\b') THEN 'High'
  WHEN regexp_matches(lower(title), '\\bmedium\\b') THEN 'Medium' WHEN regexp_matches(lower(title), '\\blow\\b') THEN 'Low' WHEN regexp_matches(lower(title), '\\b(informational|info|non-critical|nc)\\b') THEN 'Informational'
  WHEN regexp_matches(lower(title), '\\bgas\\b') THEN 'Gas' WHEN regexp_matches(lower(title), '\\bqa\\b') THEN 'QA' END AS severity FROM t),
h AS (SELECT w.*, coalesce((SELECT min(x.i) FROM w x WHERE x.doc_id = w.doc_id AND x.i > w.i AND x.level <= w.level), size.n) AS stop,
  last_value(severity IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS latest FROM w JOIN size USING (doc_id)),
inside AS (SELECT c.doc_id, c.i, least(c.stop, b.stop) AS stop, c.finding_id, coalesce(c.by_id, b.severity) AS severity FROM h b JOIN h c ON c.doc_id = b.doc_id AND c.i > b.i AND c.i < b.stop AND c.level > b.level WHERE b.severity IS NOT NULL AND NOT c.sub),
blocks AS (SELECT * FROM inside UNION ALL SELECT doc_id, i, stop, finding_id, coalesce(by_id, latest) FROM h WHERE finding_id IS NOT NULL AND (doc_id, i) NOT IN (SELECT doc_id, i FROM inside))"""
_SPAN = "^#{1,6}\\s+<span id=\"page-(\\d+)-\\d+\"></span>\\s*(\\d+)\\."
_SPANS = f"""p AS (SELECT *, nullif(regexp_extract(line, '<span id="page-(\\d+)-\\d+"></span>', 1), '')::INTEGER AS page FROM l),
spans AS (SELECT doc_id, i, regexp_extract(line, '{_SPAN}', 1)::INTEGER AS page, regexp_extract(line, '{_SPAN}', 2)::INTEGER AS idx FROM l WHERE regexp_matches(line, '{_SPAN}')),
last AS (SELECT doc_id, i FROM l WHERE regexp_matches(line, '^#{{1,6}}\\s+<span id="page-(\\d+)-\\d+"></span>\\s*[A-Z]\\.')),
ended AS (SELECT s.*, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), (SELECT min(i) FROM last WHERE last.doc_id = s.doc_id AND last.i > s.i), (SELECT max(i) + 1 FROM l WHERE l.doc_id = s.doc_id)) AS stop FROM spans s)"""
_TABLES = """r AS (SELECT doc_id, i, trim(regexp_extract(line, '^\\|\\s*([A-Za-z0-9]+-\\d{2,})\\s*\\|', 1)) AS fid FROM l WHERE regexp_matches(line, '^\\|\\s*[A-Za-z0-9]+-\\d{2,}\\s*\\|\\s*[^|]+\\|')),
top AS (SELECT doc_id, min(i) AS head FROM l WHERE starts_with(lower(trim(line)), '| id') AND contains(lower(line), 'severity') AND contains(lower(line), 'status') GROUP BY doc_id),
past AS (SELECT top.doc_id, head, coalesce(min(i) FILTER (i > head AND NOT starts_with(trim(line), '|')), max(i) + 1) AS behind FROM top JOIN l USING (doc_id) GROUP BY ALL),
named AS (SELECT r.doc_id, fid FROM r JOIN past ON r.doc_id = past.doc_id AND r.i > head AND r.i < behind),
detail AS (SELECT r.* FROM r LEFT JOIN past USING (doc_id) WHERE r.i > coalesce(behind, -1) AND (doc_id NOT IN (SELECT doc_id FROM named) OR (doc_id, fid) IN (SELECT doc_id, fid FROM named))),
rows_of AS (SELECT * FROM detail UNION ALL SELECT * FROM r WHERE doc_id NOT IN (SELECT doc_id FROM detail) AND doc_id NOT IN (SELECT doc_id FROM named)),
marks AS (SELECT doc_id, i, nullif(regexp_extract(line, '^\\{(\\d+)\\}\\s*-+', 1), '')::INTEGER AS page FROM l WHERE regexp_matches(line, '^\\{\\d+\\}\\s*-+')),
tables AS (SELECT d.*, (SELECT max_by(page, m.i) FROM marks m WHERE m.doc_id = d.doc_id AND m.i <= d.i) AS page, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i),
  (SELECT min(i) FROM l WHERE l.doc_id = d.doc_id AND l.i > d.i AND regexp_matches(line, '(?i)^\\s*#{1,6}.*\\bAppendix\\b')), (SELECT max(i) + 1 FROM l WHERE l.doc_id = d.doc_id)) AS stop FROM rows_of d)"""
_ALL_SEGMENTS = f"""{_BLOCKS}, {_SPANS}, {_TABLES}, native AS (SELECT DISTINCT doc_id FROM blocks JOIN report USING (doc_id) WHERE origin IS NULL OR origin <> 'pdf'),
segs AS (SELECT blocks.doc_id, i, stop, NULL::INTEGER AS page, finding_id, severity FROM blocks JOIN native USING (doc_id)
  UNION ALL SELECT doc_id, i, stop, page, NULL, NULL FROM ended WHERE doc_id NOT IN (FROM native)
  UNION ALL SELECT doc_id, i, stop, page, fid, NULL FROM tables WHERE doc_id NOT IN (FROM native) AND doc_id NOT IN (SELECT doc_id FROM ended))"""


def _native() -> Column:
    return F.coalesce(F.col("origin") != "pdf", F.lit(True))


@register(f"""WITH {_HEADS} SELECT doc_id, i::INTEGER AS start_line, level::INTEGER AS level FROM t""")
def q_md_headings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "report").select("doc_id", F.inline(md_headings(F.col("markdown")))).select("doc_id", "start_line", "level")


@register(f"""WITH {_BLOCKS} SELECT doc_id, i::INTEGER AS start_line, stop::INTEGER AS end_line, finding_id, severity FROM blocks""")
def q_md_roundtrip_sections(spark: SparkSession, d: str) -> DataFrame:
    """Severity blocks of all reports, whatever their shape."""
    return segment.severity_blocks(table(spark, d, "report")).select("doc_id", "start_line", "end_line", "finding_id", "severity")


@register(f"""WITH {_ALL_SEGMENTS}, e AS (SELECT segs.doc_id, segs.i, string_agg(line, chr(10) ORDER BY l.i) AS body FROM segs JOIN l ON l.doc_id = segs.doc_id AND l.i >= segs.i AND l.i < segs.stop GROUP BY ALL)
SELECT DISTINCT doc_id, i::INTEGER AS start_line, md5(regexp_replace(body, '{_SPACE}+$', '') || chr(10)) AS digest FROM e""")
def q_md_roundtrip_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Texts of the segments of all reports."""
    found = segment.segments(table(spark, d, "report"), native=_native())
    return found.select("doc_id", "start_line", F.md5("markdown").alias("digest")).distinct()


@register(f"""WITH {_LINES}, {_SPANS}, b AS (SELECT *, count(page) OVER (PARTITION BY doc_id ORDER BY i) AS block FROM p)
SELECT doc_id, block, max(page) AS page, min(i)::INTEGER AS start_line FROM b WHERE block > 0 GROUP BY doc_id, block""")
def q_md_span_blocks(spark: SparkSession, d: str) -> DataFrame:
    return segment.span_blocks(table(spark, d, "report")).select("doc_id", "block", "page", "start_line")


@register(f"""WITH {_LINES}, {_SPANS} SELECT doc_id, idx, page AS page_start, i::INTEGER AS start_line, stop::INTEGER AS end_line FROM ended""")
def q_md_span_segments(spark: SparkSession, d: str) -> DataFrame:
    return segment.span_segments(table(spark, d, "report")).select("doc_id", "idx", "page_start", "start_line", "end_line")


@register(f"""WITH {_LINES}, {_TABLES} SELECT doc_id, i::INTEGER AS start_line, stop::INTEGER AS end_line, page AS page_start, fid AS finding_id FROM tables""")
def q_md_id_table(spark: SparkSession, d: str) -> DataFrame:
    return segment.id_table_segments(table(spark, d, "report")).select("doc_id", "start_line", "end_line", "page_start", "finding_id")


@register(f"""WITH {_LINES} SELECT doc_id, i::INTEGER AS line_no, last_value(nullif(regexp_extract(line, '^\\{{(\\d+)\\}}\\s*-+', 1), '')::INTEGER IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS page FROM l""")
def q_page_asof(spark: SparkSession, d: str) -> DataFrame:
    return repos.pages_of(table(spark, d, "report"))


@register(f"""WITH RECURSIVE {_LINES}, p AS (SELECT doc_id, coalesce(last_value(nullif(regexp_extract(line, '^\\{{(\\d+)\\}}\\s*-+', 1), '')::INTEGER IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i), 0) AS page, length(line) + 1 AS size FROM l),
s AS (SELECT doc_id, page, sum(size)::BIGINT AS size, row_number() OVER (PARTITION BY doc_id ORDER BY page) AS k FROM p GROUP BY doc_id, page),
r AS (SELECT doc_id, k, page, size AS fill, 1 AS chunk FROM s WHERE k = 1
  UNION ALL SELECT s.doc_id, s.k, s.page, CASE WHEN r.fill + s.size > 8000 THEN s.size ELSE r.fill + s.size END, CASE WHEN r.fill + s.size > 8000 THEN r.chunk + 1 ELSE r.chunk END FROM r JOIN s ON s.doc_id = r.doc_id AND s.k = r.k + 1)
SELECT doc_id, chunk, min(page) AS first_page, max(page) AS last_page, count(*) AS n_pages FROM r GROUP BY doc_id, chunk""")
def q_page_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Pages packed into chunks of 8 000 characters at most."""
    lines = segment.page_of_lines(segment.line_table(segment.documents(table(spark, d, "report"))))
    pages = lines.groupBy("doc_id", F.coalesce("page", F.lit(0)).alias("page")).agg(F.sum(F.char_length("line") + 1).cast("int").alias("size"))
    return segment.page_chunks(pages, 8_000)


@register(f"""WITH {_ALL_SEGMENTS} SELECT coalesce(severity, 'null') AS severity, count(*) AS n FROM segs GROUP BY 1""")
def q_segments_by_severity(spark: SparkSession, d: str) -> DataFrame:
    """How many segments of all reports have each severity."""
    return q_segments_of_reports(spark, d).groupBy(F.coalesce("severity", F.lit("null")).alias("severity")).agg(F.count("*").alias("n"))


@register(f"""WITH {_ALL_SEGMENTS} SELECT doc_id, i::INTEGER AS start_line, stop::INTEGER AS end_line, page AS page_start, finding_id, severity FROM segs""")
def q_segments_of_reports(spark: SparkSession, d: str) -> DataFrame:
    """Segments of all reports by the first shape that yields any."""
    return segment.segments(table(spark, d, "report"), native=_native()).select("doc_id", "start_line", "end_line", "page_start", "finding_id", "severity")


@register(f"""WITH {_ALL_SEGMENTS}, k AS (SELECT segs.*, CASE WHEN doc_id IN (SELECT doc_id FROM ended) AND doc_id NOT IN (FROM native) THEN (SELECT idx FROM ended WHERE ended.doc_id = segs.doc_id AND ended.i = segs.i)
  ELSE row_number() OVER (PARTITION BY doc_id ORDER BY i) END AS idx FROM segs)
SELECT 'SCVD-' || k.doc_id || '-' || CASE WHEN idx < 1000 THEN lpad(idx::VARCHAR, 3, '0') ELSE idx::VARCHAR END AS scvd_id, k.doc_id, i::INTEGER AS start_line, stop::INTEGER AS end_line, page AS page_start,
coalesce(report.source_pdf, k.doc_id || '.pdf') AS source_pdf, report.extracted_at AS report_extracted_at FROM k JOIN report USING (doc_id)""")
def q_finding_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of all reports as the pipeline normalises them: keys, places and provenance."""
    records = pipeline.finding_records(table(spark, d, "report"), "2025-01-01T00:00:00Z", classify.DEFAULT_RULES, HOSTS)
    return records.select("scvd_id", "doc_id", "start_line", "end_line", "page_start", "provenance.source_pdf", "provenance.report_extracted_at")


@register("""WITH r AS (SELECT l_orderkey, CASE WHEN l_linenumber % 2 = 1 THEN 'id:P-' || (l_partkey % 3) ELSE 'h:part:' || floor(l_suppkey * 20 / 200)::BIGINT END AS k, l_suppkey * 20 AS s, l_suppkey * 20 + l_quantity::BIGINT AS e FROM lineitem)
SELECT l_orderkey::VARCHAR AS doc_id, count(*) AS n, min(s) AS first_line, max(e) AS last_line FROM (SELECT l_orderkey, k, min(s) AS s, max(e) AS e FROM r GROUP BY 1, 2) GROUP BY 1""")
def q_llm_merge(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    start = F.col("l_suppkey") * 20
    raw = lines.select(
        F.col("l_orderkey").cast("string").alias("doc_id"), F.when(F.col("l_linenumber") % 2 == 1, F.concat(F.lit("P-"), F.col("l_partkey") % 3)).alias("finding_id"),
        F.lit("Part!").alias("heading"), start.alias("start_line"), (start + F.col("l_quantity").cast("bigint")).alias("end_line"),
    )
    return segment.merged_segments(raw).groupBy("doc_id").agg(F.count("*").alias("n"), F.min("start_line").alias("first_line"), F.max("end_line").alias("last_line"))


# sections, repositories, rules, validation


@register("""WITH r AS (SELECT o_orderkey AS k FROM orders) SELECT k, 'Text of ' || k || chr(10) AS description, '**Impact:** none ' || (k % 7) || chr(10) AS impact,
'## Recommendation' || chr(10) || chr(10) || 'Pay ' || k || chr(10) AS recommendation, '**Vendor:** Seen.' || chr(10) AS other FROM r""")
def q_md_roundtrip_split(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    body = F.concat(F.lit("# Finding\n\nText of "), k, F.lit("\n\n**Impact:** none "), k % 7, F.lit("\n\n## Recommendation\n\nPay "), k, F.lit("\n\n**Vendor:** Seen.\n"))
    return sections.split_sections(table(spark, d, "orders").select(k.alias("k"), body.alias("body")), "k", "body").select("k", "description", "impact", "recommendation", "other")


@register("""WITH i AS (SELECT l_orderkey, l_suppkey AS s, l_suppkey + l_quantity::BIGINT AS e FROM lineitem WHERE l_quantity >= 1),
m AS (SELECT *, max(e) OVER (PARTITION BY l_orderkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT l_orderkey, min(s) AS s, max(e) AS e, count(*) AS n FROM g GROUP BY l_orderkey, g""")
def q_interval_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("s"), (F.col("l_suppkey") + F.col("l_quantity").cast("bigint")).alias("e"))
    return sections.merged_intervals(rows, "l_orderkey", "s", "e")


@register(f"""WITH l AS (SELECT doc_id, unnest(string_split(markdown, chr(10))) AS line, generate_subscripts(string_split(markdown, chr(10)), 1) AS i FROM report),
u AS (SELECT doc_id, i, regexp_replace(unnest(regexp_extract_all(line, '(?i)https?://{_HOST}/[^\\s)\\]>]+')), '[).,>]+$', '') AS url FROM l),
p AS (SELECT doc_id, regexp_extract(url, '^https?://{_HOST}/([^/\\s]+)/([^/\\s)]+)(/.*)?$', 1) AS org, regexp_extract(url, '^https?://{_HOST}/([^/\\s]+)/([^/\\s)]+)(/.*)?$', 2) AS repo,
nullif(regexp_extract(regexp_extract(url, '^https?://{_HOST}/([^/\\s]+)/([^/\\s)]+)(/.*)?$', 3), '/(?:tree|commit|blob)/([0-9a-fA-F]{{7,40}})', 1), '') AS commit_sha FROM u
WHERE regexp_matches(url, '^https?://{_HOST}/([^/\\s]+)/([^/\\s)]+)(/.*)?$'))
SELECT DISTINCT doc_id, org, repo, commit_sha FROM p""")
def q_repo_extract(spark: SparkSession, d: str) -> DataFrame:
    return repos.extract_repos(table(spark, d, "report"), hosts=HOSTS).select("doc_id", "org", "repo", "commit_sha")


@register(f"""WITH {_ONCE}, d AS (SELECT DISTINCT doc_id, url, org, repo, commit_sha, evidence.page AS page, evidence.snippet AS snippet FROM report_repos),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY url NULLS FIRST, commit_sha NULLS FIRST, page NULLS FIRST, snippet NULLS FIRST) AS ord FROM d),
s AS (SELECT f.scvd_id, r.url, r.commit_sha, r.ord, CASE WHEN r.doc_id IS NULL THEN NULL ELSE
 (CASE WHEN nullif(r.commit_sha, '') IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN abs(r.page - f.page_start) <= 5 THEN 2 ELSE 0 END
 + CASE WHEN regexp_extract(f.target.path, '([^/]+)/*$', 1) <> '' AND contains(lower(coalesce(r.snippet, '')), lower(regexp_extract(f.target.path, '([^/]+)/*$', 1))) THEN 3 ELSE 0 END
 + CASE WHEN contains(lower(coalesce(r.snippet, '')), lower(nullif(regexp_extract(f.target.path, '^(.*)/[^/]+/*$', 1), ''))) THEN 1 ELSE 0 END
 - CASE WHEN contains(lower(r.repo), 'publications') THEN 1 ELSE 0 END) END AS score FROM f LEFT JOIN r USING (doc_id))
SELECT scvd_id, url, commit_sha, score::INTEGER AS score FROM s QUALIFY row_number() OVER (PARTITION BY scvd_id ORDER BY score DESC NULLS LAST, ord) = 1""")
def q_repo_attribution(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "report_repos").select("doc_id", "url", "org", "repo", "commit_sha", "evidence.page", "evidence.snippet").distinct()
    named = named.withColumn("ord", F.row_number().over(W.partitionBy("doc_id").orderBy("url", "commit_sha", "page", "snippet")))
    rows = _once(_findings(spark, d).select("scvd_id", "doc_id", "page_start", F.col("target.path").alias("path")))
    return repos.attribute(rows, named).select("scvd_id", "url", "commit_sha", "score")


def _rule_scores(spark: SparkSession, d: str) -> DataFrame:
    fields = {"title": F.col("title"), "description": F.col("description_md"), "poc": F.col("poc_md")}
    rows = _once(_findings(spark, d).select("scvd_id", "title", "description_md", "poc_md", "type"))
    return classify.scores(rows, "scvd_id", fields, F.col("type"), classify.DEFAULT_RULES)


def _rule_sql() -> str:
    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    parts = []
    for i, r in enumerate(classify.DEFAULT_RULES):
        t = "lower(trim(coalesce(type, ''), chr(32) || chr(9) || chr(10) || chr(13) || chr(160)))"
        score = ["greatest(" + " + ".join(f"CASE WHEN {t} = {text(a.lower())} THEN 3.5 ELSE 0 END" for a in r.aliases) + ", " + ", ".join(
            f"CASE WHEN j >= 0.5 THEN 2.0 * j ELSE 0 END".replace("j", f"(len(list_intersect({{m}}, {w}))::DOUBLE / greatest(len(list_distinct(list_concat({{m}}, {w}))), 1))")
            for w in ("[" + ", ".join(text(x) for x in dict.fromkeys(a.lower().replace("-", " ").split())) + "]" for a in r.aliases)) + ")"]
        score[0] = score[0].replace("{m}", f"list_distinct(list_filter(regexp_split_to_array({t}, '[^a-z0-9_]+'), lambda w: w <> ''))")
        for column, boost in (("title", 1.5), ("description_md", 1.0), ("poc_md", 1.0)):
            c = f"coalesce({column}, '')"
            for what in ("keyword", "anti_keyword", "signal"):
                score += [f"CASE WHEN contains(lower({c}), {text(p.lower())}) THEN {classify.WEIGHTS[what] * boost} ELSE 0 END" for p in getattr(r, what)]
            score += [f"CASE WHEN regexp_matches({c}, {text(p)}) THEN {classify.WEIGHTS['regex'] * boost} ELSE 0 END" for p in r.regex]
        parts.append(f"SELECT scvd_id, '{r.id}' AS rule_id, {i} AS rule_ord, ({' + '.join(score)})::DOUBLE AS score FROM f")
    return f"{_ONCE}, s AS (" + " UNION ALL ".join(parts) + ")"


@register(f"WITH {_rule_sql()} SELECT scvd_id, rule_id, round(score, 6) AS score FROM s")
def q_rule_scores(spark: SparkSession, d: str) -> DataFrame:
    return _rule_scores(spark, d).select("scvd_id", "rule_id", F.round("score", 6).alias("score"))


@register(f"""WITH {_rule_sql()}, k AS (SELECT *, row_number() OVER (PARTITION BY scvd_id ORDER BY score DESC, rule_ord) AS place, max(score) OVER (PARTITION BY scvd_id) AS best FROM s)
SELECT scvd_id, rule_id, place FROM k WHERE place <= 2 AND score > 0 AND score >= best - 1.0""")
def q_rule_topk_delta(spark: SparkSession, d: str) -> DataFrame:
    return classify.winners(_rule_scores(spark, d), "scvd_id").select("scvd_id", "rule_id", "place")


@register("""SELECT scvd_id, 'type' AS keyword, 'page_start' AS path FROM findings WHERE false
UNION ALL SELECT scvd_id, 'const', 'schema_version' FROM findings WHERE schema_version <> '0.1'
UNION ALL SELECT scvd_id, 'minLength', 'title' FROM findings WHERE title = ''
UNION ALL SELECT scvd_id, 'additionalProperties', '' FROM findings WHERE severity IS NOT NULL AND length(severity) < 3
UNION ALL SELECT scvd_id, 'anyOf', 'repo/line_span' FROM findings WHERE repo IS NOT NULL AND repo.line_span IS NOT NULL AND len(repo.line_span) <> 2
UNION ALL SELECT scvd_id, 'json', '' FROM findings WHERE severity IS NULL""")
def q_validate_errors(spark: SparkSession, d: str) -> DataFrame:
    """Findings as JSON lines, some broken or with a key too many, against the contract."""
    rows = table(spark, d, "findings")
    record = F.struct(
        "scvd_id", "doc_id", "schema_version", "finding_index", "page_start", "title", "severity", F.struct("repo.url", "repo.line_span").alias("repo"), F.struct("provenance.source_pdf").alias("provenance")
    )
    line = F.to_json(F.when(F.col("repo").isNotNull(), record), {"ignoreNullFields": "false"})
    bare = F.to_json(F.struct(*[c for c in ("scvd_id", "doc_id", "schema_version", "finding_index", "page_start", "title", "severity")], F.struct("provenance.source_pdf").alias("provenance")), {"ignoreNullFields": "false"})
    line = F.coalesce(line, bare)
    line = F.when(F.char_length("severity") < 3, F.regexp_replace(line, r"^\{", '{"surplus":1,')).when(F.col("severity").isNull(), F.substring(line, 2, 1000000)).otherwise(line)
    return validate.validate_json(rows.select("scvd_id", line.alias("line")), "scvd_id", "line", validate.FINDING_SCHEMA).drop("message")


@register("""SELECT 'documents' AS src, doc_id AS key, row_number() OVER () AS place FROM documents UNION ALL SELECT 'eval_items', item_id, row_number() OVER () FROM eval_items""")
def q_combine_union_ordered(spark: SparkSession, d: str) -> DataFrame:
    """Rows of two sources, each by its order in the union."""
    docs = table(spark, d, "documents").select(F.lit("documents").alias("src"), F.col("doc_id").alias("key"))
    items = table(spark, d, "eval_items").select(F.lit("eval_items").alias("src"), F.col("item_id").alias("key"))
    return files.combined(docs, items).select("src", "key", F.row_number().over(W.partitionBy("src").orderBy("ord")).alias("place"))


@register("""SELECT DISTINCT sha256(text) AS key FROM documents WHERE text IS NOT NULL AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 3 = 0 AND text IS NOT NULL)""")
def q_cache_miss_anti(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    cache = docs.where("doc_id % 3 = 0 and text is not null").select(F.sha2("text", 256).alias("key"))
    return files.cache_misses(docs, cache).select("key")


@register(f"""WITH {_ONCE} SELECT scvd_id, strftime(provenance.scvd_normalized_at::TIMESTAMPTZ AT TIME ZONE 'UTC', '%Y-%m') AS period FROM f""")
def q_snapshot_periods(spark: SparkSession, d: str) -> DataFrame:
    rows = _once(_findings(spark, d).select("scvd_id", T.iso_instant(F.col("provenance.scvd_normalized_at")).alias("normalized_at")))
    return files.with_period(rows).drop("normalized_at")
