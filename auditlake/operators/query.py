"""Filters, orders, pages and aggregates over findings."""

from __future__ import annotations

import base64
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditlake.functions import text as T

#: Rows of a page: default and most.
PAGE, MOST = 100, 500


# What a text search looks at in the flat table, and in nested records.
FLAT_TEXTS = ("title", "description_md", "recommendation_md", "poc_md")
RECORD_TEXTS = ("title", "description_md", "full_markdown", "sections.description_md", "sections.full_markdown_body", "sections.markdown_raw")


@dataclass
class Search:
    """Conditions that all must hold; an empty one doesn't restrict.

    q: part of the searched text. swc, cwe: an element of taxonomy. severity, doc_id, chain, contract_address: equal
    without regard to case. repo: part of the repository's url. since, until: half-open range of the normalisation
    time; rows without a readable time fall out if either is given, an unreadable bound counts as not given.
    """

    q: str | None = None
    swc: str | None = None
    cwe: str | None = None
    severity: str | None = None
    doc_id: str | None = None
    chain: str | None = None
    contract_address: str | None = None
    repo: str | None = None
    since: str | None = None
    until: str | None = None
    #: Columns that q is sought in, joined by blanks; records of the pipeline have more than the flat table.
    texts: tuple[str, ...] = FLAT_TEXTS

    def predicate(self) -> Column:
        parts: list[Column] = []
        if self.q:
            texts = F.filter(F.array(*self.texts), lambda x: x.isNotNull() & (x != ""))
            parts.append(F.lower(F.array_join(texts, " ")).contains(self.q.lower()))
        for value, column in ((self.swc, F.col("taxonomy.swc")), (self.cwe, F.col("taxonomy.cwe"))):
            if value:
                parts.append(F.coalesce(F.array_contains(F.transform(column, F.lower), value.lower()), F.lit(False)))
        equal = (("severity", self.severity), ("doc_id", self.doc_id), ("target.chain", self.chain), ("target.contract_address", self.contract_address))
        parts += [T.lower_or_empty(F.col(c)) == v.lower() for c, v in equal if v]
        if self.repo:
            parts.append(T.lower_or_empty(F.col("repo.url")).contains(self.repo.lower()))
        at = T.iso_instant(F.col("provenance.scvd_normalized_at"))
        low, high = (F.lit(x).try_cast("timestamp") if x else None for x in (self.since, self.until))
        if low is not None or high is not None:
            parts.append(at.isNotNull())
            parts += [c for c in ((low.isNull() | (at >= low)) if low is not None else None, (high.isNull() | (at < high)) if high is not None else None) if c is not None]
        return reduce(lambda a, b: a & b, parts, F.lit(True))


def sort_key(name: str) -> Column:
    """What an order sorts by; unknown names mean scvd_id. Absent texts sort as empty, absent times first."""
    keys = {
        "doc_id": T.lower_or_empty(F.col("doc_id")),
        "chain": T.lower_or_empty(F.col("target.chain")),
        "severity": T.severity_rank(F.col("severity")),
        "normalized_at": F.coalesce(T.iso_instant(F.col("provenance.scvd_normalized_at")), F.lit("0001-01-01 00:00:00").cast("timestamp")),
    }
    return keys.get(name, T.lower_or_empty(F.col("scvd_id")))


def ordered(df: DataFrame, sort: str | None, order: str = "desc", ord_column: str = "ord") -> DataFrame:
    """df by a key, ties in input order in both directions; without a key in input order."""
    if not sort:
        return df.orderBy(ord_column)
    key = sort_key(sort)
    return df.orderBy(key.asc() if order == "asc" else key.desc(), ord_column)


def page(df: DataFrame, offset: int = 0, limit: int = PAGE) -> DataFrame:
    return df.offset(max(0, offset)).limit(min(MOST, max(1, limit)))


def cursor_page(df: DataFrame, cursor: str | None = None, limit: int = PAGE) -> DataFrame:
    """The page of an ordered frame that a cursor names, with next_cursor on its rows: null if nothing follows.

    One row more than the page is read to know. Unreadable cursors mean the first page.
    """
    limit = min(MOST, max(1, limit))
    try:
        offset = max(0, int(base64.urlsafe_b64decode((cursor or "").encode()).decode()))
    except ValueError:
        offset = 0
    rows = df.offset(offset).limit(limit + 1).withColumn("_at", F.monotonically_increasing_id())
    counted = rows.withColumn("_n", F.count("*").over(W.partitionBy())).withColumn("_place", F.row_number().over(W.orderBy("_at")))
    following = T.cursor_encode(F.lit(offset + limit))
    return counted.withColumn("next_cursor", F.when(F.col("_n") > limit, following)).where(F.col("_place") <= limit).drop("_at", "_n", "_place")


def after(df: DataFrame, key: Column, ord_column: str, last_key: object, last_ord: object, limit: int = PAGE, order: str = "desc") -> DataFrame:
    """The page behind a row, found by its key and position instead of counting rows: no page is read before it."""
    beyond = key > F.lit(last_key) if order == "asc" else key < F.lit(last_key)
    rest = df.where(beyond | ((key == F.lit(last_key)) & (F.col(ord_column) > F.lit(last_ord))))
    return rest.orderBy(key.asc() if order == "asc" else key.desc(), ord_column).limit(limit)


def last_by_id(df: DataFrame, key: str = "scvd_id", ord_column: str = "ord") -> DataFrame:
    """One row for each id, the last delivered."""
    columns = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), F.col(ord_column)).alias("r")).select(key, "r.*")


def totals(df: DataFrame) -> DataFrame:
    """(n_findings, n_reports); findings without a report count as one more report."""
    return df.agg(F.count("*").alias("n_findings"), (F.countDistinct("doc_id") + F.coalesce(F.max(F.when(F.col("doc_id").isNull(), 1)), F.lit(0))).alias("n_reports"))


def by_severity(df: DataFrame, ord_column: str = "ord") -> DataFrame:
    """(severity, n, first_seen): absent and empty ones as 'null'."""
    return df.groupBy(F.coalesce(T.absent(F.col("severity")), F.lit("null")).alias("severity")).agg(F.count("*").alias("n"), F.min(ord_column).alias("first_seen"))


def top_tags(df: DataFrame, tags: str, k: int = 20, ord_column: str = "ord") -> DataFrame:
    """(tag, n, first_seen) of the k most frequent elements of an array, ties by first appearance."""
    each = df.select(F.col(ord_column).alias("o"), F.posexplode(tags).alias("p", "tag"))
    seen = each.groupBy("tag").agg(F.count("*").alias("n"), F.min(F.struct("o", "p")).alias("first"))
    return seen.orderBy(F.desc("n"), "first").limit(k).select("tag", "n", F.col("first.o").alias("first_seen"))


def kpis(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct("doc_id").alias("n_docs"), F.countDistinct("repo.url").alias("n_repos"))
