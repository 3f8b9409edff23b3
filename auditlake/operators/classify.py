"""Weakness classes by rules: phrases and patterns score fields, the best classes within a distance win."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Weights of kinds of evidence and of fields.
WEIGHTS = {"keyword": 1.0, "anti_keyword": -1.0, "signal": 1.5, "regex": 2.0, "regex_negative": -2.0}
FIELD_BOOSTS = {"title": 1.5, "description": 1.0, "poc": 1.0, "impact": 0.8, "other": 0.5}
ALIAS_PRIOR, TOP_K, TOP_DELTA = 3.5, 2, 1.0


@dataclass
class Rule:
    id: str
    aliases: list[str] = field(default_factory=list)
    keyword: list[str] = field(default_factory=list)
    anti_keyword: list[str] = field(default_factory=list)
    signal: list[str] = field(default_factory=list)
    regex: list[str] = field(default_factory=list)
    regex_negative: list[str] = field(default_factory=list)
    cwe: list[str] = field(default_factory=list)


def load_rules(path: str) -> list[Rule]:
    """Rules of a vocabulary file; patterns that don't compile are skipped, missing lists are empty."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    flags = "".join(c for c in (data.get("matching_defaults") or {}).get("regex_flags") or "" if c in "ims")

    def patterns(values: list[str] | None) -> list[str]:
        good = []
        for p in values or []:
            try:
                re.compile(p)
            except re.error:
                continue
            good.append(f"(?{flags}){p}" if flags else p)
        return good

    return [
        Rule(
            x["id"], x.get("aliases") or [], x.get("keywords") or [], x.get("anti_keywords") or [], x.get("solidity_signals") or [], patterns(x.get("regex")),
            patterns(x.get("regex_negative")), [c["id"] for c in (x.get("relationships") or {}).get("cwe") or []],
        )
        for x in data["items"]
    ]


def type_prior(kind: Column, rule: Rule) -> Column:
    """Points for a stated type: each equal alias 3.5; else twice the word overlap with an alias, from one half on."""
    t = F.lower(F.regexp_replace(F.coalesce(kind, F.lit("")), r"(?U)^\s+|\s+$", ""))
    mine = F.array_distinct(F.filter(F.split(t, r"\W+"), lambda w: w != ""))
    exact, fuzzy = F.lit(0.0), F.lit(0.0)
    for alias in rule.aliases:
        words = F.array(*[F.lit(w) for w in dict.fromkeys(re.findall(r"\w+", alias.lower()))])
        share = F.size(F.array_intersect(mine, words)) / F.greatest(F.size(F.array_union(mine, words)), F.lit(1))
        exact = exact + F.when(t == alias.lower(), ALIAS_PRIOR).otherwise(0.0)
        fuzzy = F.greatest(fuzzy, F.when(share >= 0.5, 2.0 * share).otherwise(0.0))
    return F.greatest(exact, fuzzy)


def rule_score(fields: dict[str, Column], kind: Column, rule: Rule) -> Column:
    """Score of one rule: literal patterns unrolled into one expression, so that no pattern is compiled per row."""
    total = type_prior(kind, rule)
    for name, boost in FIELD_BOOSTS.items():
        if name not in fields:
            continue
        text = F.coalesce(fields[name], F.lit(""))
        low = F.lower(text)
        for what in ("keyword", "anti_keyword", "signal"):
            for phrase in getattr(rule, what):
                total = total + F.when(low.contains(phrase.lower()), WEIGHTS[what] * boost).otherwise(0.0)
        for what in ("regex", "regex_negative"):
            for pattern in getattr(rule, what):
                total = total + F.when(text.rlike(pattern), WEIGHTS[what] * boost).otherwise(0.0)
    return total


def scores(df: DataFrame, key: str, fields: dict[str, Column], kind: Column, rules: list[Rule], allowed: tuple[str, ...] | None = None) -> DataFrame:
    """(key, rule_id, rule_ord, score) with one row for each record and rule; rules are few, so this is a projection."""
    used = [(i, r) for i, r in enumerate(rules) if allowed is None or r.id in allowed]
    each = F.array(*[F.struct(F.lit(r.id).alias("rule_id"), F.lit(i).alias("rule_ord"), rule_score(fields, kind, r).alias("score")) for i, r in used])
    return df.select(key, F.inline(each))


def winners(scored: DataFrame, key: str, k: int = TOP_K, delta: float = TOP_DELTA) -> DataFrame:
    """The first k rules of each record that score above 0 and within delta of its best, ties in the rules' order."""
    by = W.partitionBy(key).orderBy(F.desc("score"), "rule_ord")
    ranked = scored.withColumn("place", F.row_number().over(by)).withColumn("best", F.max("score").over(W.partitionBy(key)))
    return ranked.where((F.col("place") <= k) & (F.col("score") > 0) & (F.col("score") >= F.col("best") - delta)).drop("best")


#: A small vocabulary of public weakness classes, used where no file is given.
DEFAULT_RULES = [
    Rule("SWC-107", ["Reentrancy", "Reentrant Calls"], ["re-entry", "reentran", "entered again", "external call returns"], ["cannot be entered"], ["call{value"], [r"(?i)\.call\{value:"], [], ["CWE-841"]),
    Rule("SWC-101", ["Arithmetic Precision", "Integer Overflow"], ["rounds the result", "overflow", "multiplies after dividing", "divides by"], [], ["unchecked {"], [r"(?i)narrower type"], [], ["CWE-682"]),
    Rule("SWC-105", ["Access Control"], ["open until somebody calls", "does not enforce it", "anyone"], [], ["onlyowner"], [r"(?i)initialiser open"], [], ["CWE-284"]),
    Rule("SWC-116", ["Time Handling"], ["block time", "deadline in minutes", "timestamp"], [], ["block.timestamp"], [], [], ["CWE-829"]),
    Rule("SWC-117", ["Signature Handling"], ["signature", "same proof", "replay"], [], ["ecrecover"], [r"(?i)more than one chain"], [], ["CWE-347"]),
    Rule("SWC-128", ["Denial of Service", "Gas Consumption"], ["unbounded list", "reverts for all users", "units of gas"], [], [], [r"(?i)for \(uint256 i"], [], ["CWE-400"]),
    Rule("SWC-114", ["Front-Running"], ["front-run", "notice period"], [], [], [], [], ["CWE-362"]),
]
