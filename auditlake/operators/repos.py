"""Repositories named in reports, and the repository each finding belongs to."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.functions import text as T
from auditlake.operators.segment import documents, line_table, page_of_lines
from auditlake.runtime import in_slices

# Formats of page marks, page anchors on headings, and stated versions.
_PAGE_MARK = re.compile(r"^\{(\d+)\}\s*-+")
_SPAN_HEADING = re.compile(r'^#{1,6}\s+<span id="page-(\d+)-\d+"></span>(.*)$')
_STATED = re.compile(r"^(?:Version\s+)?([0-9a-fA-F]{7,40})\b")
SNIPPET = 200
REPO = ("doc_id", "ord", "url", "org", "repo", "commit_sha", "page", "snippet")


class Links:
    """Repository links of lines: where each begins, and how far it reaches in a Markdown link, an autolink or plain text."""

    def __init__(self, hosts: tuple[str, ...]):
        self.hosts = hosts
        self.start = re.compile(rf"https?://(?:{'|'.join(map(re.escape, hosts))})/", re.I)

    def __call__(self, line: str) -> list[str]:
        linked, auto, bare = [], [], []
        for m in self.start.finditer(line):
            at, before = m.start(), line[: m.start()]
            if before.endswith("](") and "[" in before[:-2]:
                end = line.find(")", at)
                linked += [line[at:end]] if end > m.end() else []
            if before.endswith("<"):
                end = line.find(">", at)
                auto += [line[at:end]] if end > m.end() else []
            plain = re.match(r"[^\s)\]>]+", line[m.end() :])
            bare += [line[at : m.end() + plain.end()]] if plain else []
        return [x.rstrip(".,>") for x in linked + auto + bare]

    def parts(self, link: str) -> tuple[str, str, str, str | None] | None:
        """(url, owner, name, commit) of a link to a repository or a place in it."""
        scheme, _, rest = link.partition("://")
        host, _, path = rest.partition("/")
        owner, _, rest = path.partition("/")
        name, slash, place = rest.partition("/")
        if host not in self.hosts or scheme not in ("http", "https") or not owner or not name or re.search(r"\s", owner) or re.search(r"[\s)]", name) or "\n" in place:
            return None
        commit = re.search(r"/(?:tree|commit|blob)/([0-9a-fA-F]{7,40})", slash + place)
        return f"https://{host}/{owner}/{name}", owner, name, commit.group(1) if commit else None


def _snippet(line: str) -> str:
    return line if len(line) <= SNIPPET else line[:SNIPPET] + "..."


def named_in(lines: list[str], links: Links) -> Iterator[tuple]:
    """(url, org, repo, commit, page, snippet) of every link, with the page of the last mark or anchor before it."""
    page = None
    for line in lines:
        if (m := _PAGE_MARK.match(line.strip())) if "{" in line else None:
            page = int(m.group(1))
        if m := _SPAN_HEADING.match(line) if "<span" in line else None:
            page = int(m.group(1))
        if "://" in line:
            for link in links(line):
                if parts := links.parts(link):
                    yield *parts, page, _snippet(line.strip())


def project_targets(lines: list[str], links: Links) -> Iterator[tuple]:
    """The same of the block headed Project Targets: lines Repository <link>, and the versions stated below one."""
    heads = [(i, m) for i, line in enumerate(lines) if "<span" in line and (m := _SPAN_HEADING.match(line))]
    k = next((k for k, (_, m) in enumerate(heads) if "project targets" in m.group(2).lower()), None)
    if k is None:
        return
    (start, head), end = heads[k], heads[k + 1][0] if k + 1 < len(heads) else len(lines)
    page, now = int(head.group(1)), None
    for line in (x.strip() for x in lines[start + 1 : end]):
        if line.startswith("#### "):
            now = None
        elif "Repository" in line:
            if parts := next(filter(None, map(links.parts, links(line)[::-1][:1])), None):
                now = parts[:3]
                yield *now, None, page, _snippet(line)
        elif now and (m := _STATED.match(line)):
            yield *now, m.group(1), page, _snippet(line)


def extract_repos(df: DataFrame, doc: str = "doc_id", text: str = "markdown", hosts: tuple[str, ...] = T.REPO_HOSTS) -> DataFrame:
    """(doc_id, ord, url, org, repo, commit_sha, page, snippet): the first mention of each repository and commit.

    The page is the last page mark or anchor before; the snippet is the line, cut at 200 characters. Stated project
    targets follow the links. Null texts name nothing; each text is read where it lies.
    """
    kind = df.schema[doc].dataType.simpleString()

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        links = Links(hosts)
        for part in in_slices(batches):
            out = []
            for d, t in zip(part["d"], part["t"]):
                if "://" not in t:
                    continue
                lines, first = t.splitlines(), {}
                for url, org, repo, commit, page, snippet in (*named_in(lines, links), *project_targets(lines, links)):
                    first.setdefault((org, repo, commit), (url, org, repo, commit, page, snippet))
                out += [(d, k, *x) for k, x in enumerate(first.values())]
            yield pd.DataFrame(out, columns=list(REPO)).astype({"page": "Int32"})

    rows = df.where(F.col(text).isNotNull()).select(F.col(doc).alias("d"), F.col(text).alias("t"))
    return rows.mapInPandas(extract, f"doc_id {kind}, ord int, url string, org string, repo string, commit_sha string, page int, snippet string")


def attribution_score(page_start: Column, path: Column, page: Column, snippet: Column, commit: Column, repo: Column) -> Column:
    """How well a repository's evidence fits a finding."""
    clear = F.lower(F.coalesce(snippet, F.lit("")))
    name = F.lower(F.regexp_extract(path, r"([^/]+)/*$", 1))
    parent = F.lower(T.absent(F.regexp_extract(path, r"^(.*)/[^/]+/*$", 1)))
    points = (
        F.when(T.absent(commit).isNotNull(), 1).otherwise(0)
        + F.when(F.abs(page - page_start) <= 5, 2).otherwise(0)
        + F.when((name != "") & clear.contains(name), 3).otherwise(0)
        + F.when(clear.contains(parent), 1).otherwise(0)
        - F.when(F.lower(repo).contains("publications"), 1).otherwise(0)
    )
    return points.cast("int")


def attribute(findings: DataFrame, repos: DataFrame, key: str = "scvd_id") -> DataFrame:
    """(key, url, org, repo, commit_sha, score) of the best repository of each finding's report, nulls if it has none.

    findings: key, doc_id, page_start, path. repos: doc_id, ord and evidence as made by extract_repos. A join within
    documents and a running maximum per finding; of equal scores the first repository counts.
    """
    pairs = findings.select(key, "doc_id", "page_start", "path").join(repos, "doc_id", "left")
    score = attribution_score(F.col("page_start"), F.col("path"), F.col("page"), F.col("snippet"), F.col("commit_sha"), F.col("repo"))
    best = F.max_by(F.struct("url", "org", "repo", "commit_sha", score.alias("score")), F.when(F.col("ord").isNotNull(), F.struct(score.alias("s"), (-F.col("ord")).alias("o"))))
    return pairs.groupBy(key).agg(best.alias("b")).select(key, "b.*")


def pages_of(df: DataFrame, doc: str = "doc_id", text: str = "markdown") -> DataFrame:
    """(doc_id, line_no, page) of all lines, by the last page mark at or before them."""
    return page_of_lines(line_table(documents(df, doc, text))).select("doc_id", "line_no", "page")
