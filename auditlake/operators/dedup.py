"""Semantic duplicates by vectors: pair scores, clusters, decisions and nearest neighbours."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from auditlake.operators.graph import connected_components

THRESHOLD, HARD_BOOST, TOP_K = 0.82, 0.10, 5
#: Vectors of one block; a task multiplies two blocks, so its memory is fixed whatever the number of rows.
BLOCK_ROWS = 4_096


def dot(a: Column, b: Column) -> Column:
    """Inner product in double, summed in the order of the vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def jaccard(a: Column, b: Column) -> Column:
    """Share of common values; null where either set is empty once empty strings are left out."""
    x, y = (F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda v: v.isNotNull() & (v != "")) for c in (a, b))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def match_flag(a: Column, b: Column) -> Column:
    """1.0 if both hold the same non-empty value, else 0.0."""
    return F.when((a != "") & (a == b), 1.0).otherwise(0.0)


def shared_value(a: Column, b: Column) -> Column:
    return F.when(a == b, a)


def with_ids(df: DataFrame, key: str, order: str) -> DataFrame:
    """df with a key for rows that lack one, made of their position."""
    return df.withColumn(key, F.coalesce(key, F.concat(F.lit("idx-"), F.col(order).cast("string"))))


def exact_signatures(df: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, signature, canonical, n): SHA-256 of each text, the smallest key with it, and how many have it."""
    return signature_groups(df.select(key, F.sha2(text, 256).alias("signature")), key)


def signature_groups(signed: DataFrame, key: str) -> DataFrame:
    """The same for texts that are signed already: (key, signature)."""
    groups = signed.groupBy("signature").agg(F.min(key).alias("canonical"), F.count("*").alias("n"))
    return signed.join(groups, "signature").select(key, "signature", "canonical", "n")


def similar_pairs(df: DataFrame, key: str, vector: str, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b, cos), a < b, of all pairs with a cosine of unit vectors from ``threshold`` on, none missing.

    Exact, and meant for the sizes where all pairs of blocks are affordable; lsh_pairs is the way beyond them.
    Repeated keys count once, null keys and vectors don't.
    """
    rows = df.select(F.col(key).alias("k"), F.col(vector).alias("v"), F.lit(0).alias("bucket")).where("k is not null and v is not null")
    return _multiplied(rows, df.schema[key].dataType.simpleString(), threshold, block_rows)


def lsh_tables(threshold: float, bits: int, recall: float) -> int:
    """How many tables of ``bits`` random hyperplanes find a pair at the threshold with this probability."""
    same = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(same, 1 - 1e-9))))


def lsh_pairs(df: DataFrame, key: str, vector: str, threshold: float, bits: int = 8, recall: float = 0.95, block_rows: int = BLOCK_ROWS, seed: int = 7) -> DataFrame:
    """(a, b, cos) like similar_pairs, of the pairs that share a bucket of hyperplanes in any table: a pair at the
    threshold is found with probability ``recall``, closer ones more surely, and none is reported wrongly.

    Work grows with the sizes of buckets; 2^bits should grow with the rows. Every row is in one bucket a table, and a
    bucket of any size is cut into blocks, so a hot one is spread over many tasks like all rows are in similar_pairs.
    """
    rows = df.select(F.col(key).alias("k"), F.col(vector).alias("v")).where("k is not null and v is not null")
    first = rows.select(F.size("v")).head()
    tables = lsh_tables(threshold, bits, recall)
    planes = np.random.default_rng(seed).standard_normal((first[0] if first else 1, bits * tables))

    @F.pandas_udf("array<int>")
    def buckets(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        signs = (np.stack(vectors.to_numpy()).astype(np.float64) @ planes) > 0
        codes = signs.reshape(len(vectors), tables, bits) @ (1 << np.arange(bits))
        return pd.Series(list((codes + np.arange(tables) * (1 << bits)).astype(np.int32)), dtype=object)

    hashed = rows.select("k", "v", F.explode(buckets("v")).alias("bucket"))
    found = _multiplied(hashed, df.schema[key].dataType.simpleString(), threshold, block_rows)
    return found.groupBy("a", "b").agg(F.max("cos").alias("cos"))


def _multiplied(rows: DataFrame, kind: str, threshold: float, block_rows: int) -> DataFrame:
    """Pairs within buckets (k, v, bucket). A bucket's rows get a block by hash; each pair of its blocks is one group
    whose product is one matrix multiplication, so a task's memory is fixed whatever the size of a bucket."""
    sizes = rows.groupBy("bucket").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))  # a row a bucket: bounded by their number
    own = F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int")
    # block i meets every block j >= i under the key (i, j)
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    spread = rows.join(F.broadcast(sizes), "bucket").withColumn("block", own).select("k", "v", "bucket", "block", F.inline(others))

    def multiply(part: pd.DataFrame) -> pd.DataFrame:
        i, j = int(part["i"].iloc[0]), int(part["j"].iloc[0])
        left, right = part[part["block"] == i], part[part["block"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": left["k"].iloc[:0], "b": right["k"].iloc[:0], "cos": np.empty(0)})
        x, y = (np.stack(p["v"].to_numpy()).astype(np.float64) for p in (left, right))
        at, bt = np.nonzero(x @ y.T >= threshold - 1e-9)
        a, b = left["k"].to_numpy()[at], right["k"].to_numpy()[bt]
        cos = np.einsum("ij,ij->i", x[at], y[bt])
        a, b = np.where(a < b, a, b), np.where(a < b, b, a)
        out = pd.DataFrame({"a": a, "b": b, "cos": cos})
        return out[out["a"] != out["b"]].drop_duplicates(["a", "b"])

    found = spread.groupBy("bucket", "i", "j").applyInPandas(multiply, f"a {kind}, b {kind}, cos double")
    return found.where(F.col("cos") >= threshold)


def scored_pairs(pairs: DataFrame, rows: DataFrame, key: str, threshold: float = THRESHOLD, boost: float = HARD_BOOST) -> DataFrame:
    """Pairs (a, b, cos) with their signals and final score, those from ``threshold`` on.

    rows: key, repo_url, commit_sha, path, tags. An equal commit or path adds the boost once; an equal repository
    adds nothing. The score isn't clipped. Give pairs from threshold - boost on, so that none lifted by it is missing.
    """
    side = lambda s: rows.select(F.col(key).alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("repo_url", "commit_sha", "path", "tags")])
    both = pairs.where("cos > 0").join(side("a"), "a").join(side("b"), "b")
    flags = {c: match_flag(F.col(f"{c}_a"), F.col(f"{c}_b")) for c in ("repo_url", "commit_sha", "path")}
    score = F.col("cos") + F.when((flags["commit_sha"] == 1.0) | (flags["path"] == 1.0), boost).otherwise(0.0)
    return both.select(
        "a", "b", "cos", score.alias("score"), flags["repo_url"].alias("repo_match"), flags["commit_sha"].alias("commit_match"), flags["path"].alias("path_match"),
        jaccard(F.col("tags_a"), F.col("tags_b")).alias("tag_overlap"), shared_value(F.col("repo_url_a"), F.col("repo_url_b")).alias("shared_repo"),
        shared_value(F.col("commit_sha_a"), F.col("commit_sha_b")).alias("shared_commit"), shared_value(F.col("path_a"), F.col("path_b")).alias("shared_path"),
    ).where(F.col("score") >= threshold)


def decisions(rows: DataFrame, key: str, pairs: DataFrame) -> DataFrame:
    """(key, canonical_id, decision): unique, or canonical for the smallest key of its cluster, else duplicate."""
    groups = connected_components(pairs).withColumnsRenamed({"node": key, "component": "canonical_id"})
    joined = rows.select(key).distinct().join(groups, key, "left")
    kind = F.when(F.col("canonical_id").isNull(), "unique").when(F.col("canonical_id") == F.col(key), "canonical").otherwise("duplicate")
    return joined.select(key, "canonical_id", kind.alias("decision"))


def neighbours(pairs: DataFrame, k: int = TOP_K) -> DataFrame:
    """(id, other, score, place): the k best partners of each row in both directions, ties by the partner; k <= 0 keeps all."""
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("other"), "score").union(pairs.select(F.col("b"), F.col("a"), "score"))
    ranked = both.withColumn("place", F.row_number().over(W.partitionBy("id").orderBy(F.desc("score"), "other")))
    return ranked.where(F.col("place") <= k) if k > 0 else ranked


def hashed_vectors(df: DataFrame, key: str, text: Column, size: int = 256) -> DataFrame:
    """(key, v): unit vectors of hashed character 4-grams, the stand-in where no model is configured."""

    @F.pandas_udf("array<float>")
    def embed(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            raw = np.frombuffer((t or "").lower().encode(), np.uint8).astype(np.uint64)
            grams = raw[:-3] << np.uint64(24) | raw[1:-2] << np.uint64(16) | raw[2:-1] << np.uint64(8) | raw[3:] if len(raw) > 3 else raw[:0]
            mixed = (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            v = np.bincount((mixed % np.uint64(size)).astype(np.int64), np.where(mixed >> np.uint64(31), 1.0, -1.0), size)
            n = float(np.linalg.norm(v))
            out.append((v / n if n else v).astype(np.float32).tolist())
        return pd.Series(out, dtype=object)

    return df.select(key, embed(text).alias("v"))
