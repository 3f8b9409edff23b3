"""Interfaces of the optional operators that ask a language model; none is configured, and without one nothing changes.

A model is a function from a prompt and the shape of the answer to a JSON object. Answers are read leniently, and what
can't be read counts as not found, so a failing model never fails a job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.functions import text as T
from auditlake.operators.segment import clamped_segments, merged_segments

JsonModel = Callable[[str, dict], str]
# The items of metadata that a report states for its findings where no model says otherwise.
DEFAULT_ITEMS = ("Severity", "Difficulty", "Type", "Finding ID", "Target")
SAMPLES, SAMPLE_CHARS = 3, 4_000


def read_object(answer: str | None) -> dict:
    """The first JSON object of an answer; an empty one if there is none."""
    text = answer or ""
    at = text.find("{")
    while at >= 0:
        try:
            found, _ = json.JSONDecoder().raw_decode(text[at:])
            return found if isinstance(found, dict) else {}
        except ValueError:
            at = text.find("{", at + 1)
    return {}


def complete(model: JsonModel | None, prompt: str, shape: dict) -> dict:
    if model is None:
        return {}
    try:
        return read_object(model(prompt, shape))
    except Exception:  # noqa: BLE001 - a model is outside of the job
        return {}


def inferred_items(model: JsonModel | None, segments: list[str]) -> tuple[str, ...]:
    """Items of metadata that a report's first findings state; the default ones without a model or an answer."""
    prompt = "Name the items of metadata that every finding states.\n\n" + "\n\n".join(s[:SAMPLE_CHARS] for s in segments[:SAMPLES])
    items = complete(model, prompt, {"items": ["string"]}).get("items")
    named = dict.fromkeys(x.strip() for x in items if isinstance(x, str) and x.strip()) if isinstance(items, list) else ()
    return tuple(named) or DEFAULT_ITEMS


def metadata_of(model: JsonModel | None, segment: str, items: tuple[str, ...] = DEFAULT_ITEMS) -> dict[str, str | None]:
    """The value of each item; what is missing is asked for once more, and empty words count as nothing."""
    found: dict[str, str | None] = dict.fromkeys(items)
    for _ in range(2):
        open_items = [k for k, v in found.items() if v is None]
        if not open_items:
            break
        got = complete(model, f"Give {', '.join(open_items)} of this finding.\n\n{segment}", dict.fromkeys(open_items, "string"))
        found |= {k: v for k in open_items if isinstance(v := got.get(k), str) and v.strip().lower() not in ("", "null", "none")}
    return found


def first_sentence(model: JsonModel | None) -> Callable[[str], str | None]:
    """The anchor that cascaded descriptions take: the first sentence of the description, word for word."""

    def anchor(segment: str) -> str | None:
        said = complete(model, "Copy the first sentence of the description.\n\n" + segment[: 2 * SAMPLE_CHARS], {"first_sentence": "string"}).get("first_sentence")
        return said if isinstance(said, str) else None

    return anchor


def model_segments(chunks: DataFrame, model: JsonModel | None) -> DataFrame:
    """(doc_id, idx, start_line, end_line, finding_id, heading): what a model sees in chunks of a document's lines.

    chunks: doc_id, first_line, n_lines, text. Lines of answers count from 1 inside a chunk; they are moved into the
    document, and sightings of one finding from several chunks merge.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = []
            for d, first, n, text in zip(part["doc_id"], part["first_line"], part["n_lines"], part["text"]):
                for x in complete(model, "Where do findings begin and end?\n\n" + text, {"findings": [{"start_line": "int", "end_line": "int"}]}).get("findings") or []:
                    if isinstance(x, dict) and all(isinstance(x.get(k), int) for k in ("start_line", "end_line")):
                        rows.append((d, first, n, x["start_line"], x["end_line"], x.get("finding_id"), str(x.get("heading") or "")))
            yield pd.DataFrame(rows, columns=["doc_id", "first_line", "n_lines", "start_line", "end_line", "finding_id", "heading"])

    kind = chunks.schema["doc_id"].dataType.simpleString()
    seen = chunks.select("doc_id", "first_line", "n_lines", "text").mapInPandas(ask, f"doc_id {kind}, first_line int, n_lines int, start_line int, end_line int, finding_id string, heading string")
    return merged_segments(clamped_segments(seen, "first_line", "n_lines").withColumn("finding_id", T.null_folded(F.col("finding_id"))))
