"""Issues of trackers over HTTP as a data source: one partition for each repository, pages followed to the last.

The transport is a function the caller brings (url, headers) -> (status, headers, body), so nothing here opens a
connection by itself; the default uses the standard library.
"""

from __future__ import annotations

import json
import random
import re
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from auditlake.sources.files import ISSUE

Transport = Callable[[str, dict], tuple[int, dict, str]]
# Answers after which a request is tried again, and how often and how long.
AGAIN = (429, 502, 503, 504)
TRIES, LONGEST, PAGE = 8, 60.0, 100


def over_http(url: str, headers: dict) -> tuple[int, dict, str]:
    from urllib import error, request

    try:
        with request.urlopen(request.Request(url, headers=headers), timeout=60) as answer:
            return answer.status, dict(answer.headers), answer.read().decode()
    except error.HTTPError as e:
        return e.code, dict(e.headers), ""


def fetched(url: str, headers: dict, transport: Transport, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.time) -> tuple[dict, str]:
    """(headers, body) of a page; waits where the answer says so, else longer each time; a refused token is dropped once."""
    pause, headers = 1.0, dict(headers)
    for _ in range(TRIES):
        status, got, body = transport(url, headers)
        low = {k.lower(): v for k, v in got.items()}
        if status == 200:
            return low, body
        if status == 401 and headers.pop("Authorization", None):
            continue
        if "retry-after" in low:
            sleep(float(low["retry-after"]))
        elif status == 403 and low.get("x-ratelimit-remaining") == "0":
            sleep(max(0.0, float(low.get("x-ratelimit-reset", 0)) - clock()) + 1)
        elif status in AGAIN:
            sleep(min(pause, LONGEST) + random.random())
            pause *= 2
        else:
            raise RuntimeError(f"{url}: answer {status}")
    raise RuntimeError(f"{url}: no answer after {TRIES} tries")


def issue_rows(base: str, owner: str, repo: str, state: str, token: str | None, transport: Transport, **timing: Callable) -> Iterator[tuple]:
    """Rows of ISSUE of one repository, page by page; pull requests are told by their column and not left out here."""
    headers = {"Accept": "application/json"} | ({"Authorization": f"Bearer {token}"} if token else {})
    url: str | None = f"{base}/repos/{owner}/{repo}/issues?state={state}&per_page={PAGE}"
    while url:
        got, body = fetched(url, headers, transport, **timing)
        for x in json.loads(body):
            pull = x.get("pull_request")
            yield x.get("number"), f"{owner}/{repo}", x.get("title"), x.get("body"), [(n.get("name"),) for n in x.get("labels") or []], (pull.get("url"),) if pull is not None else None, x.get("created_at")
        following = re.search(r'<([^>]+)>;\s*rel="next"', got.get("link", ""))
        url = following.group(1) if following else None


def read_remote_issues(spark: SparkSession, repos: list[tuple[str, str]], base: str, state: str = "all", token: str | None = None, transport: Transport = over_http) -> DataFrame:
    """ISSUE rows of repositories; each is read by its own task, so a failure repeats one repository only."""
    if not repos:
        return spark.createDataFrame([], ISSUE)
    listed = spark.createDataFrame(repos, "owner string, repo string").repartition(len(repos))
    kinds = "issue_no bigint, repo_url string, title string, body string, labels string, pull_url string, is_pull boolean, opened_at string"

    def read(batches):
        import pandas as pd

        for part in batches:
            for owner, repo in zip(part["owner"], part["repo"]):
                rows = [(n, u, t, b, json.dumps([{"name": x[0]} for x in names]), pull[0] if pull else None, pull is not None, at) for n, u, t, b, names, pull, at in issue_rows(base, owner, repo, state, token, transport)]
                yield pd.DataFrame(rows, columns=[k.split()[0] for k in kinds.split(", ")]).astype({"issue_no": "Int64"})

    raw = listed.mapInPandas(read, kinds)
    return raw.selectExpr(
        "issue_no", "repo_url", "title", "body", "from_json(labels, 'array<struct<name:string>>') AS labels",
        "CASE WHEN is_pull THEN named_struct('url', pull_url) END AS pull_request", "try_cast(opened_at AS timestamp) AS opened_at",
    )
