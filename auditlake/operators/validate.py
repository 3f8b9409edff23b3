"""Checking JSON records against a Draft-7 schema: the schema is compiled to Columns, rows stay in the JVM.

Known keywords: type (also unions), required, properties, additionalProperties false, const, enum, minLength, minItems,
maxItems, items, anyOf. Every violation is one row; a line that isn't JSON is one, blank lines are none.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TYPES = {
    "string": "^STRING", "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))", "number": "^(BIGINT|DECIMAL|DOUBLE|FLOAT)", "boolean": "^BOOLEAN",
    "null": "^VOID", "object": "^OBJECT", "array": "^ARRAY",
}


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is(v: Column, names: str | list[str]) -> Column:
    names = [names] if isinstance(names, str) else names
    kind = _kind(v)
    found = reduce(lambda a, n: a | kind.rlike(_TYPES[n]), names, F.lit(False))
    if "integer" in names:  # 1.0 is a whole number
        found = found | (kind.rlike("^(DECIMAL|DOUBLE)") & (F.try_variant_get(v, "$", "double") == F.floor(F.try_variant_get(v, "$", "double"))))
    return found


def _text(v: Column) -> Column:
    return F.when(_kind(v).rlike("^STRING"), F.try_variant_get(v, "$", "string"))


def _key(name: str) -> str:
    return f"$['{name}']"


def _violations(v: Column, schema: dict, path: Column) -> list[Column]:
    """Arrays of struct(path, keyword, message), null or empty where nothing is violated, for a value that is present."""
    told = F.to_json(v)

    def bad(condition: Column, keyword: str, message: Column) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), F.array(F.struct(path.alias("path"), F.lit(keyword).alias("keyword"), message.alias("message"))))

    def said(text: str) -> Column:
        return F.concat(F.coalesce(told, F.lit("null")), F.lit(" " + text))

    out: list[Column] = []
    if "type" in schema:
        names = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        out.append(bad(~_is(v, names), "type", said("is not of type " + ", ".join(repr(n) for n in names))))
    if "const" in schema:
        out.append(bad(~F.coalesce(_same(v, schema["const"]), F.lit(False)), "const", F.lit(f"{schema['const']!r} was expected")))
    if "enum" in schema:
        out.append(bad(~reduce(lambda a, x: a | F.coalesce(_same(v, x), F.lit(False)), schema["enum"], F.lit(False)), "enum", said(f"is not one of {schema['enum']!r}")))
    if "minLength" in schema:
        out.append(bad(F.char_length(_text(v)) < schema["minLength"], "minLength", said("is too short")))
    if "anyOf" in schema:
        fits = [F.size(_all(_violations(v, s, path))) == 0 for s in schema["anyOf"]]
        out.append(bad(~reduce(lambda a, b: a | b, fits), "anyOf", said("is not valid under any of the given schemas")))
    is_object, is_array = _kind(v).rlike("^OBJECT"), _kind(v).rlike("^ARRAY")
    if "minItems" in schema or "maxItems" in schema or "items" in schema:
        items = F.when(is_array, F.try_variant_get(v, "$", "array<variant>"))
        if "minItems" in schema:
            out.append(bad(F.size(items) < schema["minItems"], "minItems", said("is too short")))
        if "maxItems" in schema:
            out.append(bad(F.size(items) > schema["maxItems"], "maxItems", said("is too long")))
        if "items" in schema:
            each = lambda x, i: _all(_violations(x, schema["items"], F.concat_ws("/", F.nullif(path, F.lit("")), i.cast("string"))))
            out.append(F.flatten(F.transform(items, each)))
    if "properties" in schema or "required" in schema:
        present = F.when(is_object, F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")))
        for name in schema.get("required", []):
            out.append(bad(~F.array_contains(present, name), f"required:{name}", F.lit(f"{name!r} is a required property")))
        if schema.get("additionalProperties") is False:
            known = F.array(*[F.lit(k) for k in schema.get("properties", {})])
            surplus = F.array_except(present, known)
            out.append(bad(F.size(surplus) > 0, "additionalProperties", F.concat(F.lit("Additional properties are not allowed: "), F.array_join(F.array_sort(surplus), ", "))))
        for name, inner in schema.get("properties", {}).items():
            child = F.try_variant_get(v, _key(name), "variant")
            there = F.coalesce(F.array_contains(present, name), F.lit(False))
            out.append(F.when(there, _all(_violations(child, inner, F.concat_ws("/", F.nullif(path, F.lit("")), F.lit(name))))))
    return out


def _all(found: list[Column]) -> Column:
    """All violations as one array; without rules there are none."""
    return F.flatten(F.filter(F.array(F.array().cast(_FOUND), *found), lambda x: x.isNotNull()))


_FOUND = "array<struct<path:string,keyword:string,message:string>>"


def _same(v: Column, value: object) -> Column:
    if value is None:
        return F.is_variant_null(v)
    if isinstance(value, bool):
        return _kind(v).rlike("^BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == value)
    if isinstance(value, (int, float)):
        return _is(v, "number") & (F.try_variant_get(v, "$", "double") == float(value))
    return _text(v) == value


def _parsed(raw: Column) -> Column:
    """The value of a text that is one JSON value and nothing more; the parser alone would pass over what follows it."""
    whole = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    return F.when(F.size(F.try_variant_get(whole, "$", "array<variant>")) == 1, F.try_variant_get(whole, "$[0]", "variant"))


def validate_json(df: DataFrame, key: str, raw: str, schema: dict | str | None) -> DataFrame:
    """(key, path, keyword, message), one row for each violation; path is empty for the record itself, parts joined by /.

    key is what tells lines apart, such as their number; blank lines count but say nothing. A missing schema is an error.
    """
    if schema is None:
        raise ValueError("no schema to validate against")
    schema = json.loads(schema) if isinstance(schema, str) else schema
    rows = df.where(F.trim(raw) != "").select(key, _parsed(F.col(raw)).alias("_v"))
    broken = F.array(F.struct(F.lit("").alias("path"), F.lit("json").alias("keyword"), F.lit("invalid JSON").alias("message")))
    found = F.when(F.col("_v").isNull(), broken).otherwise(_all(_violations(F.col("_v"), schema, F.lit(""))))
    return rows.select(key, F.inline(found))


def validate_file(spark: SparkSession, path: str, schema: dict | str | None) -> DataFrame:
    """(line_no, path, keyword, message) of one JSON Lines file, lines counted from 1."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("n", "line"))
    return validate_json(lines.select((F.col("n") + 1).alias("line_no"), "line"), "line_no", "line", schema)


#: The part of the findings' contract that the flat tables carry.
FINDING_SCHEMA = {
    "type": "object",
    "required": ["scvd_id", "doc_id", "finding_index", "title", "provenance"],
    "additionalProperties": False,
    "properties": {
        "scvd_id": {"type": "string", "minLength": 1},
        "doc_id": {"type": "string", "minLength": 1},
        "schema_version": {"type": "string", "const": "0.1"},
        "finding_index": {"type": ["integer", "string"]},
        "page_start": {"type": ["integer", "null"]},
        "title": {"type": "string", "minLength": 1},
        "severity": {"type": ["string", "null"]},
        "repo": {
            "type": ["object", "null"],
            "additionalProperties": False,
            "properties": {"url": {"type": ["string", "null"]}, "line_span": {"anyOf": [{"type": "null"}, {"type": "array", "minItems": 2, "maxItems": 2, "items": {"type": "integer"}}]}},
        },
        "provenance": {"type": "object", "required": ["source_pdf"], "properties": {"source_pdf": {"type": ["string", "null"]}}},
    },
}


def _object(required: tuple[str, ...] = (), nullable: bool = False, **properties: dict) -> dict:
    return {"type": ["object", "null"] if nullable else "object", "additionalProperties": False, "required": list(required), "properties": properties}


_TEXT, _KEY, _STRINGS = {"type": ["string", "null"]}, {"type": "string", "minLength": 1}, {"type": "array", "items": {"type": "string"}}


def _texts(*names: str) -> dict:
    return dict.fromkeys(names, _TEXT)


# The whole contract of a finding record, version 0.1.
CONTRACT = _object(
    ("schema_version", "scvd_id", "doc_id", "finding_index", "title", "provenance"),
    schema_version={"type": "string", "const": "0.1"}, scvd_id=_KEY, doc_id=_KEY, finding_index={"type": ["integer", "string"]}, page_start={"type": ["integer", "null"]}, title=_KEY,
    **_texts("short_summary", "description_md", "full_markdown", "severity", "difficulty", "type", "finding_id", "duplicate_of"),
    target=_object(("path",), **_texts("path", "language", "chain", "contract_name", "contract_address", "function", "bytecode_hash", "caip_id")),
    repo=_object(**_texts("url", "org", "name", "commit", "branch", "relative_file"), lines={"anyOf": [{"type": "null"}, {"type": "array", "items": {"type": "integer"}, "minItems": 2, "maxItems": 2}]}),
    taxonomy=_object(swc=_STRINGS, cwe=_STRINGS, tags=_STRINGS),
    status=_object(
        **_texts("fix_status", "fixed_in_commit", "bounty_reference", "fix_status_text_md"), fixed_in_pr=_STRINGS, exploited_in_the_wild={"type": ["boolean", "null"]},
        cvss={"type": ["string", "number", "object", "null"]},
    ),
    references=_STRINGS,
    provenance=_object(
        ("scvd_normalized_at", "scvd_normalizer_version"), **_texts("source_pdf", "source_mtime", "report_extracted_at", "report_extractor_version", "report_extraction_tool"),
        scvd_normalized_at={"type": "string"}, scvd_normalizer_version={"type": "string"},
    ),
    metadata_raw={"type": ["object", "null"]},
    sections=_object(**_texts("description_md", "impact_md", "recommendation_md", "poc_md", "fix_status_md", "other_md", "full_markdown_body", "markdown_raw")),
    dedup=_object(
        nullable=True, decision={"enum": ["canonical", "duplicate", "unique", "uncertain", None]}, **_texts("canonical_id", "model", "run_at"),
        sim_threshold={"type": ["number", "null"]}, hard_boost={"type": ["number", "null"]},
    ),
    duplicates={
        "type": "array",
        "items": _object(
            ("scvd_id", "score"), scvd_id={"type": "string"}, score={"type": "number"},
            signals=_object(**dict.fromkeys(("text_sim", "swc_overlap", "repo_match", "commit_match", "path_match"), {"type": ["number", "null"]})), shared=_object(**_texts("repo", "commit", "path")),
        ),
    },
)
