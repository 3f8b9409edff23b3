"""Readers and writers: Markdown trees, issue dumps, findings as JSON Lines, JSON arrays or CSV, snapshots, vector caches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISSUE = "issue_no bigint, repo_url string, title string, body string, labels array<struct<name:string>>, pull_request struct<url:string>, opened_at timestamp"


def doc_id(path: Column, root: str) -> Column:
    """Path below root without extension, its parts joined by underscores."""
    base = root.rstrip("/")
    inside = F.when(F.locate(base + "/", path) > 0, F.substring_index(path, base + "/", -1)).otherwise(F.substring_index(path, "/", -1))
    return F.replace(F.regexp_replace(inside, r"\.[^./]*$", ""), F.lit("/"), F.lit("_"))


def read_markdown(spark: SparkSession, root: str) -> DataFrame:
    """(doc_id, path, source_mtime, markdown) of all *.md files below root."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    return files.select(doc_id(path, root).alias("doc_id"), path.alias("path"), F.col("_metadata.file_modification_time").alias("source_mtime"), F.col("value").alias("markdown"))


def discovered(spark: SparkSession, root: str, kinds: tuple[str, ...] = ("pdf", "md")) -> DataFrame:
    """(doc_id, path, kind, source_mtime, size) of all documents below root, in the order of their paths; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    kind = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    named = files.select(doc_id(F.col("path"), root).alias("doc_id"), "path", kind.alias("kind"), F.col("modificationTime").alias("source_mtime"), F.col("length").alias("size"))
    return named.where(F.col("kind").isin(*kinds)).orderBy("path")


def read_documents(spark: SparkSession, root: str, convert: Callable[[bytes], str] | None = None, pattern: str = "*.pdf") -> DataFrame:
    """(doc_id, path, markdown, error) of binary documents by a converter, which the caller brings.

    A document that can't be converted has no markdown but says why; the others go on.
    """
    if convert is None:
        raise ValueError("no converter from documents to Markdown is configured")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)

    def run(batches):
        import pandas as pd

        def one(content: bytes) -> tuple[str | None, str | None]:
            try:
                return convert(content), None
            except Exception as e:  # noqa: BLE001 - the converter is outside of the job
                return None, f"{type(e).__name__}: {e}"

        for part in batches:
            rows = [(p, *one(bytes(c))) for p, c in zip(part["path"], part["content"])]
            yield pd.DataFrame(rows, columns=["path", "markdown", "error"], dtype=object)

    done = files.select("path", "content").mapInPandas(run, "path string, markdown string, error string")
    return done.select(doc_id(F.col("path"), root).alias("doc_id"), "path", "markdown", "error")


def output_path(doc: Column, kind: str) -> Column:
    """Where the outcome of a document goes below a root: its id with the ending of the kind, every other dot kept."""
    return F.concat(doc, F.lit("." + kind.lstrip(".")))


def csv_source(given: str | None, deduplicated: str | None, combined_path: str | None) -> tuple[str, str]:
    """(what a CSV export reads, its default name): what is given, else deduplicated records, else combined ones."""
    source = given or deduplicated or combined_path
    if not source:
        raise ValueError("nothing to export")
    head, dot, _ = source.rpartition(".")
    return source, (head if dot and "/" not in source[len(head) :] else source) + ".csv"


def unprocessed(found: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """What isn't in ``done`` yet; null keys are passed on."""
    return found.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ISSUE).json(path)


def read_repo_list(spark: SparkSession, path: str) -> DataFrame:
    """(owner, repo) of a list with one owner/repo or url a line; blank lines and comments are skipped."""
    line = F.trim("value")
    short = F.when(line.rlike("^https?://"), F.regexp_extract(line, r"([^/]+/[^/]+?)/*$", 1)).otherwise(line)
    rows = spark.read.text(path).where((line != "") & ~line.startswith("#") & line.contains("/")).select(short.alias("s"))
    return rows.select(F.split("s", "/", 2)[0].alias("owner"), F.split("s", "/", 2)[1].alias("repo"))


def read_findings(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Findings of JSON Lines or of one JSON array, told apart by the first sign that isn't blank."""
    head = spark.read.text(path).where(F.trim("value") != "").head()
    array = head is not None and head[0].lstrip().startswith("[")
    return spark.read.schema(schema).option("multiLine", array).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object a line; absent values are written as null."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def combined(*frames: DataFrame) -> DataFrame:
    """All rows with ``ord``, by source and position; ord grows within a source and from one to the next."""
    placed = [df.withColumn("ord", F.monotonically_increasing_id() + F.lit(i) * F.lit(1 << 60)) for i, df in enumerate(frames)]
    out = placed[0]
    for df in placed[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def flattened(df: DataFrame, fields: tuple[str, ...] | None = None) -> DataFrame:
    """Nested columns as dotted names in sorted order, arrays and maps as JSON; names asked for that don't exist are empty."""
    columns: dict[str, Column] = {}

    def walk(kind: T.DataType, at: Column, name: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, at[f.name] if name else F.col(f"`{f.name}`"), f"{name}.{f.name}" if name else f.name)
        elif isinstance(kind, (T.ArrayType, T.MapType)):
            columns[name] = F.to_json(at)
        else:
            columns[name] = at.cast("string")

    walk(df.schema, F.lit(None), "")
    wanted = fields or tuple(sorted(columns))
    return df.select(*[columns.get(n, F.lit("")).alias(n) for n in wanted])


def write_csv(df: DataFrame, path: str, fields: tuple[str, ...] | None = None, files: int | None = None) -> None:
    """Flattened rows with a header; absent values are empty. Many files unless a number is given."""
    flat = flattened(df, fields)
    flat = flat.coalesce(files) if files else flat
    flat.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", "").option("emptyValue", "").csv(path)


def with_period(df: DataFrame, at: str = "normalized_at") -> DataFrame:
    """df with the month of an instant; null where it is unknown."""
    return df.withColumn("period", F.date_format(at, "yyyy-MM"))


def write_snapshot(df: DataFrame, path: str, at: str = "normalized_at") -> None:
    """Findings by month, so that a period is a partition."""
    with_period(df, at).repartition("period").write.mode("overwrite").partitionBy("period").parquet(path)


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(F.col("period").cast("string").alias("period")).distinct().orderBy("period")


def snapshot(spark: SparkSession, path: str, period: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("period").cast("string") == period)


def cache_misses(texts: DataFrame, cache: DataFrame, text: str = "text") -> DataFrame:
    """(key, text) of distinct texts whose SHA-256 isn't in the cache."""
    keyed = texts.where(F.col(text).isNotNull()).select(F.sha2(text, 256).alias("key"), F.col(text).alias("text")).dropDuplicates(["key"])
    return keyed.join(cache.select("key"), "key", "left_anti")
