"""Problem 6: one record per group of linked records, each field from the member that serves it best."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.operators.graph import chase_roots

# Words that stand for a missing value, compared in lower case with signs as blanks.
MISSING = (
    "na", "n a", "nil", "null", "none", "none given", "nothing", "not given", "not set", "not known", "not specified", "not stated", "not provided",
    "not applicable", "not available", "no value", "no data", "unknown", "unspecified", "undefined", "undisclosed", "unavailable", "missing", "empty", "blank",
    "tbd", "tba", "tbc", "to be determined", "to be announced", "to be confirmed", "to be added", "todo", "pending", "placeholder", "xxx",
    "see report", "see text", "see above", "see below", "various", "multiple", "several",
)
TRUST = {"native": 3.0, "pdf": 2.0, "issue": 1.0}
HALF_LIFE_DAYS = 365.0


def usable(value: Column) -> Column:
    """Whether a value says anything; false for null, for signs alone, names in angle brackets, and words for a missing value."""
    words = F.trim(F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}]+", " "))
    return F.coalesce((words != "") & ~words.isin(*MISSING) & ~F.trim(value).rlike(r"^<[\w .-]*>$"), F.lit(False))


def is_address(value: Column) -> Column:
    """Whether a link holds more than its scheme."""
    return ~F.trim(value).rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:/*$")


def is_hash(value: Column) -> Column:
    """Whether a value is a commit hash: 7 to 64 hex digits, not all zero."""
    bare = F.lower(F.trim(value))
    return F.coalesce(bare.rlike("^[0-9a-f]{7,64}$") & ~bare.rlike("^0+$"), F.lit(False))


def instant(value: Column) -> Column:
    """The instant of an ISO time with any offset; null where it can't be read."""
    return value.try_cast("timestamp")


def members(df: DataFrame, key: str, parent: str) -> DataFrame:
    """(key, root_id) of every member of a group of linked records: all that lead to a record without parent, and that record.

    Records that nothing links are in no group, nor are those whose chain ends outside the table or runs into a cycle.
    A record that names itself as parent is a root. Redelivered rows count once.
    """
    rows = df.select(key, parent).where(F.col(key).isNotNull())
    is_root = F.col(parent).isNull() | (F.col(parent) == F.col(key))
    roots = rows.where(is_root).select(F.col(key).alias("root_id"))
    led = chase_roots(rows.where(~is_root).distinct(), key, parent).select(key, F.col("root").alias("root_id")).join(roots, "root_id", "left_semi").select(key, "root_id")
    return led.unionByName(led.select(F.col("root_id").alias(key), "root_id").distinct())


def long_fields(df: DataFrame, key: str, fields: dict[str, Column], tests: dict[str, Column] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, carried columns, field_name, value): one row per record and usable field."""
    tests = tests or {}
    each = [
        F.when(usable(c) & tests.get(name, F.lit(True)), F.struct(F.lit(name).alias("field_name"), c.cast("string").alias("value")))
        for name, c in fields.items()
    ]
    return df.select(key, *carry, F.inline(F.array_compact(F.array(*each))))


def voted_values(long: DataFrame, key: str, origin: str, when: str, now: Column | None = None, half_life_days: float = HALF_LIFE_DAYS) -> DataFrame:
    """(root_id, field_name, key, value, votes): of each field the value with the most votes, and its best voter.

    long: root_id, field_name, value, key, origin, when. Each member votes for its value, without case and outer
    blanks, with its origin's trust, halved for every half-life of age; votes are summed per value. Ties go to the
    smallest normalised value. A half-life of 0 is the limit: origins lie further apart than any sum, a later vote
    outweighs all earlier ones, and of equal ones the smaller key's does; a sum is then its greatest term, so the
    order is strict, and votes is the number of voters. Unknown origins count least, unreadable times as the oldest.
    Both aggregations combine before their shuffle, so a group of any size is never gathered.
    """
    trust = F.coalesce(F.create_map(*[x for k, v in TRUST.items() for x in (F.lit(k), F.lit(v))])[F.col(origin)], F.lit(0.5))
    micros = F.coalesce(F.unix_micros(when), F.lit(-(2**62)))
    strict = half_life_days == 0
    age = F.lit(0.0) if strict else F.greatest(F.coalesce((F.unix_micros(now) - F.unix_micros(when)) / 86_400e6, F.lit(10 * half_life_days)), F.lit(0.0)) / half_life_days
    vote = F.lit(1.0) if strict else F.round(trust * F.pow(F.lit(0.5), age), 9)
    summed = (
        long.withColumn("term", F.struct((-trust).alias("t"), (-micros).alias("w"), F.col(key).alias("k")))
        .withColumn("norm", F.lower(F.regexp_replace("value", r"(?U)^\s+|\s+$", "")))
        .groupBy("root_id", "field_name", "norm")
        .agg(F.round(F.sum(vote), 6).alias("votes"), F.min("term").alias("term"), F.min_by("value", "term").alias("value"))
    )
    first = F.col("term") if strict else F.struct((-F.col("votes")).alias("v"), "norm")
    best = summed.groupBy("root_id", "field_name").agg(F.min_by(F.struct(F.col("term.k").alias(key), "value", "votes"), first).alias("m"))
    return best.select("root_id", "field_name", "m.*")


def pivoted(winners: DataFrame, fields: tuple[str, ...], value: str = "value") -> DataFrame:
    """One row per root with a column per field, null where no member has a usable value."""
    return winners.groupBy("root_id").pivot("field_name", list(fields)).agg(F.first(value))


FINDING_FIELDS = {
    "repo_url": "repo.url",
    "commit_sha": "repo.commit_sha",
    "target_path": "target.path",
    "contract_name": "target.contract_name",
    "severity": "severity",
}


def finding_members(findings: DataFrame) -> DataFrame:
    """Usable fields of linked findings in long form with their groups: what the members vote with."""
    wide = findings.select("scvd_id", "origin", instant(F.col("provenance.scvd_normalized_at")).alias("normalized_at"), *[F.col(p).alias(n) for n, p in FINDING_FIELDS.items()])
    wide = wide.join(members(findings, "scvd_id", "duplicate_of"), "scvd_id").dropDuplicates(["scvd_id"])
    tests = {"commit_sha": is_hash(F.col("commit_sha")), "repo_url": is_address(F.col("repo_url"))}
    return long_fields(wide, "scvd_id", {n: F.col(n) for n in FINDING_FIELDS}, tests, ("root_id", "origin", "normalized_at"))
