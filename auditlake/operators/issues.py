"""Issues of trackers as findings: which count, how labels are read, and a report for each repository."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditlake.functions import text as T
from auditlake.operators.repos import extract_repos
from auditlake.operators.sections import split_sections

# Labels that exclude an issue, words of labels in order of precedence.
EXCLUDED_LABELS = (
    "qa", "quality assurance", "qa report", "gas", "gas optimization", "gas optimizations", "gas optimisation", "invalid", "unsatisfactory",
)
# Fixed value: a collective title about gas.
COLLECTIVE_GAS = r"(?U)\bgas\s+optimizations?\b"
SKIPPED_LABELS = ("invalid", "unsatisfactory")
SEVERITY_LABELS = (
    ("critical", "Critical"), ("4 (critical risk)", "Critical"), ("high", "High"), ("3 (high risk)", "High"), ("medium", "Medium"), ("med", "Medium"),
    ("2 (med risk)", "Medium"), ("low", "Low"), ("1 (low risk)", "Low"),
)
CATEGORY_LABELS = (("gas optimization", "gas"), ("qa", "qa"), ("quality assurance", "qa"), ("bug", "bug"))


def label_names(labels: Column) -> Column:
    return F.filter(F.transform(labels, lambda x: x["name"]), lambda x: x.isNotNull() & (x != ""))


def is_included(labels: Column, title: Column) -> Column:
    """Whether an issue counts: it has labels, none of an excluded family, and no title of a collective report."""
    norm = F.transform(label_names(labels), T.label_norm)
    bad = F.exists(norm, lambda n: n.isin(*EXCLUDED_LABELS) | (n.startswith("gas") & n.contains("opt")) | n.startswith("quality assurance"))
    # the words of the title, between signs: a report of quality assurance or of gas says so in one or two of them
    words = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"(?U)\W+", " ")
    spaced = F.concat(F.lit(" "), words, F.lit(" "))
    adjacent = F.lower(F.coalesce(title, F.lit(""))).rlike(COLLECTIVE_GAS)
    return F.coalesce((F.size(labels) > 0) & ~bad & ~spaced.contains(" qa ") & ~adjacent, F.lit(False))


def _some_contain(texts: Column, word: str) -> Column:
    return F.exists(texts, lambda x: x.contains(word))


def _first_word(labels: Column, words: tuple) -> Column:
    low = F.transform(label_names(labels), F.lower)
    return T.first_case([(_some_contain(low, w), F.lit(v)) for w, v in words])


def is_skipped(labels: Column) -> Column:
    return F.exists(F.transform(label_names(labels), F.lower), lambda x: x.isin(*SKIPPED_LABELS))


def label_severity(labels: Column) -> Column:
    """Severity by the first word, in order of precedence, that any label contains; null for skipped issues."""
    return F.when(~is_skipped(labels), _first_word(labels, SEVERITY_LABELS))


def label_category(labels: Column) -> Column:
    """Category by the first word that any label contains; null for skipped issues."""
    return F.when(~is_skipped(labels), _first_word(labels, CATEGORY_LABELS))


def issue_sections(issues: DataFrame) -> DataFrame:
    """(repo_url, idx, heading, heading_cleaned, markdown, markdown_raw, sections, severity, category) of the issues that count.

    Pull requests, excluded and skipped issues and repeats don't; of an issue delivered more than once the latest
    opening counts. sections holds what split_sections finds in the body.
    """
    one = issues.where(F.col("pull_request").isNull() & is_included(F.col("labels"), F.col("title")) & ~is_skipped(F.col("labels")))
    best = F.max_by(F.struct("title", "body", "labels"), F.struct("opened_at", "title"))
    title = F.coalesce(T.absent(F.col("i.title")), F.lit("(untitled)"))
    once = one.groupBy("repo_url", "issue_no").agg(best.alias("i")).select(
        "repo_url", F.col("issue_no").alias("idx"), F.concat(F.col("issue_no"), F.lit(". "), title).alias("heading"), title.alias("heading_cleaned"),
        T.clean_markdown(F.coalesce("i.body", F.lit(""))).alias("markdown"), T.absent(F.col("i.body")).alias("markdown_raw"),
        label_severity(F.col("i.labels")).alias("severity"), label_category(F.col("i.labels")).alias("category"),
    )
    whole = F.struct(*once.columns).alias("whole")
    parts = split_sections(once.select(whole, "markdown"), "whole", "markdown")
    return parts.select("whole.*", F.struct(*[c for c in parts.columns if c != "whole"]).alias("sections"))


def report_id(repo_url: Column) -> Column:
    """The document id of a repository's issues: github:owner/name by the last two parts of its url."""
    return F.concat(F.lit("github:"), F.regexp_extract(repo_url, r"([^/]+/[^/]+?)/*$", 1))


def issue_reports(issues: DataFrame, hosts: tuple[str, ...] = T.REPO_HOSTS) -> DataFrame:
    """(repo_url, doc_id, n_sections, first_issue, last_issue, text_chars, repositories): one report for each repository.

    The sections themselves stay rows of issue_sections. repositories are those named in any body, in the order of
    issues, each once: an issue's mentions are found where it lies, and only first mentions meet.
    """
    sections = issue_sections(issues)
    sums = sections.groupBy("repo_url").agg(
        F.count("*").alias("n_sections"), F.min("idx").alias("first_issue"), F.max("idx").alias("last_issue"), F.sum(F.char_length("markdown")).alias("text_chars")
    )
    named = extract_repos(sections.select(F.struct("repo_url", "idx").alias("i"), "markdown"), doc="i", hosts=hosts)
    first = named.groupBy("doc_id.repo_url", "org", "repo", "commit_sha").agg(F.min(F.struct("doc_id.idx", "ord", "url", "page", "snippet")).alias("m"))
    entry = F.struct(F.col("m.idx").alias("issue"), F.col("m.ord").alias("ord"), "m.url", "org", "repo", "commit_sha", "m.page", "m.snippet")
    listed = first.groupBy("repo_url").agg(F.sort_array(F.collect_list(entry)).alias("repositories"))
    return sums.join(listed, "repo_url", "left").withColumn("doc_id", report_id(F.col("repo_url")))


def ordered_sections(issues: DataFrame) -> DataFrame:
    """issue_sections with their place in the repository's report, by issue number."""
    return issue_sections(issues).withColumn("place", F.row_number().over(W.partitionBy("repo_url").orderBy("idx")))
