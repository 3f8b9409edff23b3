"""Driver queries of the operators in this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm import canon, leaks, lookalikes, markup, overlap, pages, split, survivors, tokens
from auditlake.runtime import table

REPORT_LIMIT, FINDING_LIMIT = 30_000, 2_400
CANON_FIELDS = ("severity", "difficulty", "type")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """A compound parted at its own hyphen ends inside a word as well; only its repair differs."""
    _, found = pages.scan_findings(table(spark, d, "report"))
    kind = F.when(F.col("kind") == "compound", "hyphen").otherwise(F.col("kind"))
    return found.select("doc_id", "field_name", "line_no", kind.alias("kind")).distinct()


def p1_repaired(spark: SparkSession, d: str) -> DataFrame:
    return pages.repaired(table(spark, d, "report"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    entries = table(spark, d, "canon_values")
    mapped = canon.map_fields(table(spark, d, "findings"), "scvd_id", CANON_FIELDS, entries)
    exact = entries.select("field_name", F.col("canon_value").alias("value"))
    return mapped.join(exact, ["field_name", "value"], "left_anti").select("scvd_id", "field_name", "canon_id").distinct()


def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The values that mean no entry, with the number of findings that hold them."""
    mapped = canon.map_fields(table(spark, d, "findings"), "scvd_id", CANON_FIELDS, table(spark, d, "canon_values"))
    return mapped.where("canon_id = 0").groupBy("field_name", "value").agg(F.count("*").alias("n_findings"))


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    """All pieces of reports and descriptions above their limits."""
    reports = split.split_items(table(spark, d, "report").where(F.char_length("markdown") > REPORT_LIMIT), "markdown", REPORT_LIMIT, keys=("doc_id",))
    long = table(spark, d, "findings").where(F.char_length("description_md") > FINDING_LIMIT).select("scvd_id", "description_md").distinct()
    findings = split.split_items(long, "description_md", FINDING_LIMIT, keys=("scvd_id",))
    return (
        reports.withColumnRenamed("doc_id", "item_key").withColumn("item_kind", F.lit("report"))
        .unionByName(findings.withColumnRenamed("scvd_id", "item_key").withColumn("item_kind", F.lit("finding")))
        .select("item_kind", "item_key", "piece_no", "start_pos", "end_pos", "overlap", "boundary", "piece")
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_pieces(spark, d).where("piece_no = 2").select("item_kind", "item_key").distinct()


def _marked_texts(spark: SparkSession, d: str) -> DataFrame:
    """(item_key, field_name, text) of the three fields, redelivered rows once."""
    fields = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in ("description_md", "poc_md")])
    findings = table(spark, d, "findings").select(F.col("scvd_id").alias("item_key"), F.inline(fields))
    reports = table(spark, d, "report").select(F.col("doc_id").alias("item_key"), F.lit("markdown").alias("field_name"), F.col("markdown").alias("text"))
    return findings.unionByName(reports).where("text is not null")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    cleaned = markup.clean_texts(_marked_texts(spark, d), "text").select("item_key", "field_name", F.explode("markups").alias("markup"))
    return cleaned.distinct()


def p4_clean(spark: SparkSession, d: str) -> DataFrame:
    """The clean texts, one row for each item and field (of redelivered rows one)."""
    return markup.clean_texts(_marked_texts(spark, d), "text").select("item_key", "field_name", "clean").distinct()


def _finding_texts(spark: SparkSession, d: str) -> tuple[DataFrame, object]:
    return table(spark, d, "findings").where("description_md is not null"), overlap.text_of("title", "description_md", "recommendation_md")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rows, text = _finding_texts(spark, d)
    return overlap.group_pairs(overlap.overlap_groups(rows, "scvd_id", text), "scvd_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    long = survivors.finding_members(table(spark, d, "findings"))
    return survivors.voted_values(long, "scvd_id", "origin", "normalized_at", half_life_days=0).select("root_id", "field_name", "scvd_id")


def p6_records(spark: SparkSession, d: str) -> DataFrame:
    """One record for each group, every field by the votes of all members; the latest instant in the table is now."""
    findings = table(spark, d, "findings")
    now = findings.agg(F.max(survivors.instant(F.col("provenance.scvd_normalized_at")))).first()[0]
    winners = survivors.voted_values(survivors.finding_members(findings), "scvd_id", "origin", "normalized_at", F.lit(now).cast("timestamp"))
    return survivors.pivoted(winners, tuple(survivors.FINDING_FIELDS))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_texts(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p8_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Documents with leaked passages, the passages cut out."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = leaks.find_leaks(docs, table(spark, d, "eval_items"))
    return leaks.remove_leaks(docs, found).where(~F.col("text").eqNullSafe(F.col("cleaned"))).select("doc_id", "cleaned")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.equal_looking_pairs(table(spark, d, "documents").select("doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        p1_found, p1_repaired, p2_found, p2_unmatched, p3_found, p3_pieces, p4_found, p4_clean, p5_found, p6_found, p6_records, p7_ids,
        p8_found, p8_cleaned, p9_found,
    )
    return {f.__name__: f for f in named}


P3_FOUND = f"""
SELECT 'report' AS item_kind, doc_id AS item_key FROM report WHERE length(markdown) > {REPORT_LIMIT}
UNION
SELECT 'finding', scvd_id FROM findings WHERE length(description_md) > {FINDING_LIMIT}
"""

P5_FOUND = """
WITH RECURSIVE f AS (SELECT DISTINCT scvd_id, lower(coalesce(title, '') || ' ' || description_md || ' ' || coalesce(recommendation_md, '')) AS t FROM findings WHERE description_md IS NOT NULL),
w AS (SELECT scvd_id, regexp_extract_all(t, '[a-z0-9_]+') AS words FROM f),
r AS (SELECT DISTINCT scvd_id, unnest([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FOR i IN range(1, len(words) - 1)]) AS run FROM w),
n AS (SELECT scvd_id, count(*) AS n FROM r GROUP BY scvd_id),
o AS (SELECT a.scvd_id AS a, b.scvd_id AS b, count(*) AS shared FROM r a JOIN r b ON a.run = b.run AND a.scvd_id < b.scvd_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.scvd_id = a JOIN n y ON y.scvd_id = b WHERE 5 * shared > 3 * (x.n + y.n - shared)),
linked AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
c AS (SELECT a AS node, b AS reach FROM linked UNION SELECT c.node, linked.b FROM c JOIN linked ON c.reach = linked.a)
SELECT node AS scvd_id_a, reach AS scvd_id_b FROM c WHERE node < reach
"""

_MISSING = ", ".join(f"'{w}'" for w in survivors.MISSING)
_P6_USABLE = f"""
WITH RECURSIVE f AS (
  SELECT scvd_id, any_value(duplicate_of) AS parent, any_value(origin) AS origin,
         any_value(provenance.scvd_normalized_at)::TIMESTAMPTZ AS ts,
         any_value(repo.url) AS repo_url, any_value(repo.commit_sha) AS commit_sha, any_value(target.path) AS target_path,
         any_value(target.contract_name) AS contract_name, any_value(severity) AS severity
  FROM findings GROUP BY scvd_id),
g AS (
  SELECT scvd_id, scvd_id AS root_id FROM f WHERE parent IS NULL OR parent = scvd_id
  UNION
  SELECT f.scvd_id, g.root_id FROM f JOIN g ON f.parent = g.scvd_id WHERE f.parent <> f.scvd_id),
linked AS (SELECT * FROM g QUALIFY count(*) OVER (PARTITION BY root_id) > 1),
long AS (
  SELECT scvd_id, origin, ts, u.field_name, u.value
  FROM f, LATERAL (VALUES ('repo_url', repo_url), ('commit_sha', commit_sha), ('target_path', target_path),
                          ('contract_name', contract_name), ('severity', severity)) AS u(field_name, value)),
worded AS (SELECT *, trim(regexp_replace(lower(value), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS words FROM long WHERE value IS NOT NULL),
usable AS (
  SELECT * FROM worded
  WHERE words <> '' AND words NOT IN ({_MISSING}) AND NOT regexp_matches(trim(value), '^<[\\w .-]*>$')
    AND (field_name <> 'commit_sha' OR (regexp_matches(lower(trim(value)), '^[0-9a-f]{{7,64}}$') AND NOT regexp_matches(trim(value), '^0+$')))
    AND (field_name <> 'repo_url' OR NOT regexp_matches(trim(value), '^[A-Za-z][A-Za-z0-9+.-]*:/*$')))
"""
P6_FOUND = f"""{_P6_USABLE}
SELECT root_id, field_name, scvd_id FROM usable JOIN linked USING (scvd_id)
QUALIFY row_number() OVER (PARTITION BY root_id, field_name ORDER BY
  CASE origin WHEN 'native' THEN 1 WHEN 'pdf' THEN 2 WHEN 'issue' THEN 3 ELSE 4 END, ts DESC NULLS LAST, scvd_id) = 1
"""
P6_RECORDS = f"""{_P6_USABLE},
v AS (SELECT root_id, field_name, value, lower(trim(value)) AS norm, scvd_id, ts, CASE origin WHEN 'native' THEN 3.0 WHEN 'pdf' THEN 2.0 WHEN 'issue' THEN 1.0 ELSE 0.5 END::DOUBLE AS trust FROM usable JOIN linked USING (scvd_id)),
b AS (SELECT *, round(trust * pow(0.5, greatest(coalesce((epoch_us((SELECT max(ts) FROM f)) - epoch_us(ts)) / 86400e6, 3650.0), 0.0) / 365.0), 9) AS vote,
  row_number() OVER (PARTITION BY root_id, field_name, norm ORDER BY trust DESC, ts DESC NULLS LAST, scvd_id) AS best FROM v),
s AS (SELECT root_id, field_name, norm, round(sum(vote), 6) AS votes, max(value) FILTER (best = 1) AS value FROM b GROUP BY ALL),
w AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY root_id, field_name ORDER BY votes DESC, norm) = 1)
SELECT root_id, {", ".join(f"max(value) FILTER (field_name = '{n}') AS {n}" for n in survivors.FINDING_FIELDS)} FROM w GROUP BY root_id
"""


def oracle_sql() -> dict[str, str]:
    return {"p3_found": P3_FOUND, "p5_found": P5_FOUND, "p6_found": P6_FOUND, "p6_records": P6_RECORDS}
