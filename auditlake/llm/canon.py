"""Problem 2: mapping freely typed values to the entries of a reference list.

Distinct values are normalised, candidates come from an inverted index of character n-grams, a weighted cosine ranks
them, and an alignment of words checks them. Nothing is mapped below a threshold or without a margin.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.1
MARGIN = 0.03
#: Share of an entry's letters that may be mistyped in a value of several words.
SLIPS = 0.28
#: Cosine from which a value may hold a word besides all words of an entry.
SURE = 0.55
#: Reference lists up to this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 20_000
# Words that add nothing to a typed value, and short forms no rule derives.
FILLERS = ("risk", "risks", "sev", "severity", "level", "difficulty", "type", "and", "of", "the", "issue", "issues", "bug", "write", "writes")
SYNONYMS = {"moderate": "medium", "mid": "medium", "middle": "medium", "x": "cross", "xchain": "cross chain", "d ?o ?s": "denial service"}


def normalised(value: Column) -> Column:
    """Lower-case words of a typed value: no decoration, no list number, no field label, CamelCase parted."""
    words = F.regexp_replace(value, r"([a-z])([A-Z][a-z])", "$1 $2")
    words = F.lower(words)
    words = F.regexp_replace(words, r"[^\p{L}\p{N}]+", " ")
    words = F.regexp_replace(F.trim(words), r"^(severity|difficulty|type) (?=\S)", "")
    words = F.regexp_replace(words, r"^\p{N}+ (?=\p{L})", "")
    words = F.regexp_replace(words, r"\bnot (?=determined)", "un")
    filler = "|".join(FILLERS)
    bare = F.trim(F.regexp_replace(F.regexp_replace(words, rf"\b({filler})\b", " "), r"\s+", " "))
    for short, full in SYNONYMS.items():
        bare = F.regexp_replace(bare, rf"\b{short}\b", full)
    return bare


def grams(words: Column) -> Column:
    """Distinct character 2- and 3-grams; word starts are marked, so that short forms find their word."""
    each = F.transform(F.filter(F.split(words, " "), lambda w: w != ""), lambda w: F.concat(F.lit("^"), w))
    def cut(n: int) -> Column:
        return F.flatten(F.transform(each, lambda w: F.transform(
            F.sequence(F.lit(1), F.greatest(F.char_length(w) - n + 1, F.lit(1))), lambda i: F.substring(w, i, n))))
    return F.array_distinct(F.concat(cut(2), cut(3)))


def _swapped(a: str, b: str) -> int:
    """Edits between two words, a swap of neighbours being one (optimal string alignment)."""
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(now[-1] + 1, row[j] + 1, row[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        before, row = row, now
    return row[-1]


def _shortens(short: str, word: str) -> bool:
    """Whether short is word cut off, or its first letter and some later ones in order."""
    if word.startswith(short):
        return True
    if len(short) > 4 or short[:1] != word[:1]:
        return False
    letters = iter(word)
    return all(c in letters for c in short) and not set(short[1:]) <= set("aeiou")


def _same_word(a: str, word: str) -> bool:
    if a == word or (len(a) < len(word) and _shortens(a, word)):
        return True
    if len(a) > 3 and a.endswith("s") and (a[:-1] == word or _shortens(a[:-1], word)):
        return True
    shared = next((i for i, (x, y) in enumerate(zip(a, word)) if x != y), min(len(a), len(word)))
    if shared >= 5 and shared >= 0.66 * max(len(a), len(word)):
        return True  # another ending of the same stem
    return _swapped(a, word) <= (0 if len(word) < 3 else 1 if len(word) < 8 else 2)


@lru_cache(maxsize=100_000)
def aligned(value: str, entry: str, score: float = 0.0) -> bool:
    """Whether the words of a value are those of an entry, in any order, joined or parted, shortened or mistyped.

    A surplus word is let pass only beside all words of an entry of several words, and if the cosine is SURE.
    """
    have, want = value.split(), [w for w in entry.split() if w not in FILLERS]
    whole, goal = "".join(have), "".join(want)
    if not whole or not goal:
        return False
    slips = int(SLIPS * len(goal)) if len(want) > 1 else 1 if len(goal) < 8 else 2
    if len(whole) > 2 and _swapped(whole, goal) <= slips:
        return True
    if len(want) == 1:
        return len(have) == 1 and _same_word(have[0], want[0]) or len(whole) > 3 and goal.startswith(whole)
    free, surplus = list(want), 0
    for w in have:
        hit = next((x for x in free if x == w), None) or next((x for x in free if _same_word(w, x)), None)
        if hit is not None:
            free.remove(hit)
            continue
        pair = next((i for i in range(len(free) - 1) if len(w) > len(free[i]) and _same_word(w, free[i] + free[i + 1])), None)
        if pair is None:
            surplus += 1
        else:
            del free[pair : pair + 2]
    if surplus and score >= SURE and not free:
        return surplus == 1
    if surplus and score >= SURE:
        spare = " ".join(have[:-1])
        return len(have) > len(want) and _swapped(spare.replace(" ", ""), goal) <= slips
    return not free and not surplus


def match_values(
    values: DataFrame, entries: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN
) -> DataFrame:
    """(field_name, value, canon_id, score) for every distinct non-null value; canon_id is 0 where none is meant.

    values: field_name, value (repeats allowed). entries: canon_id, field_name, canon_value. A value equal to an
    entry maps to it; of equal entries the smallest canon_id counts. Empty, blank and unknown values, and values
    whose two best entries are closer than the margin, are unmatched. Work grows with the distinct values only:
    repeats are combined before the first shuffle, and candidates come from shared n-grams, never from all pairs.
    """
    spark = values.sparkSession
    distinct = values.select("field_name", "value").where("value is not null and field_name is not null").distinct()
    entries = entries.where("canon_value is not null").groupBy("field_name", "canon_value").agg(F.min("canon_id").alias("canon_id"))
    few = entries.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    small = F.broadcast if few else (lambda df: df)

    listed = entries.select("canon_id", "field_name", "canon_value", normalised(F.col("canon_value")).alias("entry"))
    index = listed.select("canon_id", "field_name", "entry", F.explode(grams(F.col("entry"))).alias("gram"))
    size = listed.groupBy("field_name").agg(F.count("*").alias("n"))
    weight = index.groupBy("field_name", "gram").agg(F.count("*").alias("df")).join(small(size), "field_name")
    weight = weight.select("field_name", "gram", F.log1p(F.col("n") / F.col("df")).alias("w"))
    index = index.join(small(weight), ["field_name", "gram"])
    length = index.groupBy("field_name", "canon_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("entry_norm"))
    index = index.join(small(length), ["field_name", "canon_id"])

    typed = distinct.withColumn("words", normalised(F.col("value")))
    forms = typed.select("field_name", "words").where("words <> ''").distinct()
    mine = forms.select("field_name", "words", F.explode(grams(F.col("words"))).alias("gram"))
    mine = mine.join(small(size), "field_name").join(small(weight), ["field_name", "gram"], "left")
    mine = mine.withColumn("w", F.coalesce("w", F.log1p(F.col("n").cast("double"))))
    norms = mine.groupBy("field_name", "words").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    hits = (
        mine.select("field_name", "words", "gram")
        .join(small(index), ["field_name", "gram"])
        .groupBy("field_name", "words", "canon_id", "entry", "entry_norm")
        .agg(F.sum(F.col("w") * F.col("w")).alias("dot"))
        .join(norms, ["field_name", "words"])
        .select("field_name", "words", "canon_id", "entry", (F.col("dot") / (F.col("norm") * F.col("entry_norm"))).alias("score"))
        .where(F.col("score") >= threshold)
    )

    @F.pandas_udf("boolean")
    def agrees(words: pd.Series, entry: pd.Series, score: pd.Series) -> pd.Series:
        return pd.Series([aligned(*x) for x in zip(words, entry, score)], dtype=bool)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a fixed number: the alignment costs more than its few bytes suggest
    best = (
        hits.repartition(parts, "field_name", "words").where(agrees("words", "entry", "score"))
        .groupBy("field_name", "words")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("score", (-F.col("canon_id")).alias("minus_id"))), False), 1, 2).alias("top"))
        .select(
            "field_name", "words", (-F.col("top")[0].minus_id).alias("found"), F.col("top")[0].score.alias("score"),
            F.coalesce(F.get("top", F.lit(1)).score, F.lit(0.0)).alias("second"),
        )
        .where(F.col("score") - F.col("second") >= margin)
    )
    same = listed.select("field_name", F.col("canon_value").alias("value"), F.col("canon_id").alias("same_id"))
    return (
        typed.join(best, ["field_name", "words"], "left")
        .join(small(same), ["field_name", "value"], "left")
        .select(
            "field_name", "value", F.coalesce("same_id", "found", F.lit(0)).cast("int").alias("canon_id"),
            F.when(F.col("same_id").isNotNull(), 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"),
        )
    )


def map_fields(df: DataFrame, key: str, fields: tuple[str, ...], entries: DataFrame, **limits: float) -> DataFrame:
    """(key, field_name, value, canon_id, score), one row for each key and field with a value; repeated rows count once."""
    long = df.select(F.col(key).alias("_key"), F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields])).alias("x"))
    long = long.select("_key", "x.field_name", "x.value").where("value is not null").distinct()
    return long.join(match_values(long, entries, **limits), ["field_name", "value"]).select(F.col("_key").alias(key), "field_name", "value", "canon_id", "score")
