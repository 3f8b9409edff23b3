"""Segments of reports as finding records: ids, titles, severities, sections, repository and classes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.functions import text as T
from auditlake.operators import classify, repos
from auditlake.operators.sections import split_sections

TOOL, VERSION = "auditlake", "0.1"
#: Metadata a model may find in a segment; without one, only what the text states in plain cells is known.
METADATA = ("Severity", "Difficulty", "Type", "Finding ID", "Target")


def stated(body: Column, label: str) -> Column:
    """What a line or table cell "label: value" of a segment says; null where nothing does or it says null or none."""
    cell = rf"(?im)(?:^|\|)[ \t]*\**{label}:?\**:?[ \t]*(?:\|[ \t]*)?([A-Za-z0-9_./][^|\n]*?)[ \t]*(?:\||$)"
    return T.null_folded(T.absent(F.regexp_extract(body, cell, 1)))


def records(
    segments: DataFrame, reports: DataFrame, run_ts: str, rules: list[classify.Rule] | None = None, hosts: tuple[str, ...] = T.REPO_HOSTS,
    metadata: Callable[[Column, str], Column] = stated, anchor: Callable[[str], str | None] | None = None,
) -> DataFrame:
    """One record for each segment, in the nested form of the contract (flat columns come by select("target.path")).

    run_ts is the instant written into all of them, so that runs can be repeated. reports: doc_id, source_pdf,
    source_mtime, extracted_at, extractor_version, markdown, as far as they exist. ``metadata`` gives the value of a
    label (stated reads it off the text), ``anchor`` a description's first sentence where no rule finds one. Segments
    of one number keep their own rows; without rules no class is assigned.
    """
    index = F.coalesce(F.col("idx").cast("string"), F.lit("UNKNOWN"))
    base = segments.withColumn("body", T.clean_markdown(F.col("markdown")))
    about = {label: metadata(F.col("body"), label) for label in METADATA}
    fid = F.coalesce(T.absent(about["Finding ID"]), F.col("finding_id"))
    severity, source = T.effective_severity(fid, about["Severity"], F.col("severity"))
    title = T.finding_title(T.cleaned_heading(F.col("heading"), F.col("idx"), F.col("body")), F.col("heading"), index)
    named = base.select(
        T.finding_key(F.col("doc_id"), index).alias("scvd_id"), "doc_id", index.alias("finding_index"), "page_start", fid.alias("finding_id"), severity.alias("severity"), source.alias("severity_source"),
        about["Difficulty"].alias("difficulty"), about["Type"].alias("type"), about["Target"].alias("path"), "start_line", "end_line", title.alias("title"), F.col("body").alias("full_markdown"), F.col("markdown").alias("markdown_raw"),
    )
    whole = F.struct(*named.columns).alias("whole")
    parts = split_sections(named.select(whole, "full_markdown"), "whole", "full_markdown", anchor)
    out = parts.select("whole.*", *[c for c in parts.columns if c != "whole"])

    found = repos.extract_repos(reports, hosts=hosts)
    best = repos.attribute(out.select("scvd_id", "doc_id", "page_start", "path").distinct(), found, "scvd_id")
    repo = F.struct("url", "org", F.col("repo").alias("name"), "commit_sha")
    out = out.join(best.select("scvd_id", repo.alias("repo")), "scvd_id", "left")
    kept = [c for c in ("source_mtime", "extracted_at", "extractor_version") if c in reports.columns]
    source_pdf = F.coalesce("source_pdf", F.concat("doc_id", F.lit(".pdf"))).alias("source_pdf")
    out = out.join(reports.select("doc_id", F.struct(source_pdf, *kept).alias("_report")), "doc_id", "left")
    if rules:
        fields = {"title": F.col("title"), "description": F.col("description"), "impact": F.col("impact"), "poc": F.col("poc"), "other": F.col("other")}
        won = classify.winners(classify.scores(out, "scvd_id", fields, F.col("type"), rules), "scvd_id")
        cwe: Column = F.create_map(*[x for r in rules for x in (F.lit(r.id), F.array(*[F.lit(c) for c in r.cwe]))])
        tags = won.groupBy("scvd_id").agg(F.array_sort(F.collect_list(F.struct("place", "rule_id"))).alias("w")).select(
            "scvd_id", F.array_distinct(F.transform("w", lambda x: x.rule_id)).alias("swc"), F.array_distinct(F.flatten(F.transform("w", lambda x: cwe[x.rule_id]))).alias("cwe")
        )
        out = out.join(tags, "scvd_id", "left")
    none, empty, blank = F.lit(None).cast("string"), F.array().cast("array<string>"), F.lit("")
    swc, cwes = (F.coalesce("swc", empty), F.coalesce("cwe", empty)) if rules else (empty, empty)
    when = F.lit(run_ts).try_cast("timestamp")
    report = {c: F.col(f"_report.{c}").cast("string") if c in kept else none for c in ("source_mtime", "extracted_at", "extractor_version")}
    return out.select(
        F.lit("0.1").alias("schema_version"), "scvd_id", "doc_id", "finding_index", "page_start", "title", F.col("description").alias("description_md"), "full_markdown",
        "severity", "severity_source", "difficulty", "type", "finding_id", "start_line", "end_line",
        F.struct(
            F.col("description").alias("description_md"), F.coalesce("impact", blank).alias("impact_md"), F.col("recommendation").alias("recommendation_md"), F.coalesce("poc", blank).alias("poc_md"),
            F.col("fix_status").alias("fix_status_md"), F.coalesce("other", blank).alias("other_md"), F.col("markdown_body").alias("full_markdown_body"), "markdown_raw",
        ).alias("sections"),
        F.struct(F.col("path").alias("path")).alias("target"),
        F.struct("repo.url", "repo.org", "repo.name", "repo.commit_sha", F.col("path").alias("relative_file")).alias("repo"),
        F.struct(swc.alias("swc"), cwes.alias("cwe"), empty.alias("tags")).alias("taxonomy"),
        F.struct(F.col("fix_status").alias("fix_status"), T.first_commit(F.col("fix_status")).alias("fixed_in_commit")).alias("status"),
        F.struct(
            F.coalesce("_report.source_pdf", F.concat("doc_id", F.lit(".pdf"))).alias("source_pdf"), report["source_mtime"].alias("source_mtime"), report["extracted_at"].alias("report_extracted_at"),
            report["extractor_version"].alias("report_extractor_version"), F.lit(TOOL).alias("report_extraction_tool"), when.alias("scvd_normalized_at"), F.lit(VERSION).alias("scvd_normalizer_version"),
        ).alias("provenance"),
    )
