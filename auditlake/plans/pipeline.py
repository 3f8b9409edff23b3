"""From reports and issues to deduplicated finding records, in one lazy plan with two written stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.functions import text as T
from auditlake.operators import classify, dedup, normalize
from auditlake.operators.segment import SEGMENT, segments
from auditlake.runtime import cut_lineage


def finding_records(reports: DataFrame, run_ts: str, rules: list[classify.Rule] | None = None, hosts: tuple[str, ...] = T.REPO_HOSTS) -> DataFrame:
    """Records of all findings of reports (doc_id, source_pdf, origin, markdown)."""
    native = F.coalesce(F.col("origin") != "pdf", F.lit(True))
    return normalize.records(segments(reports, native=native).select(*SEGMENT), reports, run_ts, rules, hosts)


#: Records up to this many are compared exactly, block by block; more through hyperplanes.
EXACT_ROWS = 50_000


def deduplicated(
    records: DataFrame, vectors: DataFrame | None = None, threshold: float = dedup.THRESHOLD, boost: float = dedup.HARD_BOOST, embed: Column | None = None, exact_rows: int = EXACT_ROWS
) -> DataFrame:
    """records with canonical_id and decision; vectors (scvd_id, v) come from a model, else from hashed n-grams.

    Above ``exact_rows`` pairs come from lsh_pairs with buckets that grow with the rows and a recall of 0.95 at the
    lowest cosine that a boost can lift.
    """
    parts = [F.col(f"sections.{c}_md") for c in ("description", "impact", "recommendation", "poc", "other")]
    text = T.embed_text(F.col("title"), F.col("description_md"), *parts) if embed is None else embed
    vectors = vectors if vectors is not None else dedup.hashed_vectors(records, "scvd_id", text)
    vectors = cut_lineage(vectors)
    n = vectors.count()
    if n <= exact_rows:
        pairs = dedup.similar_pairs(vectors, "scvd_id", "v", threshold - boost)
    else:
        pairs = dedup.lsh_pairs(vectors, "scvd_id", "v", threshold - boost, bits=max(8, (n // dedup.BLOCK_ROWS).bit_length()))
    rows = records.select("scvd_id", F.col("repo.url").alias("repo_url"), F.col("repo.commit_sha").alias("commit_sha"), F.col("target.path").alias("path"), F.col("taxonomy.swc").alias("tags"))
    scored = dedup.scored_pairs(pairs, rows, "scvd_id", threshold, boost)
    return records.join(dedup.decisions(records, "scvd_id", scored.select("a", "b")), "scvd_id")
