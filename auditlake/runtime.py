"""Session, table access and lineage helpers shared by all operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Rows of one slice of texts; the engine bounds an Arrow batch in bytes, a slice bounds what Python makes of it.
SLICE_ROWS = 512


def session(app: str = "auditlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session for tests, benches and scripts; clusters bring their own settings."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    defaults = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    return builder.config(map=defaults | conf).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_slices(batches: Iterator[pd.DataFrame], rows: int = SLICE_ROWS) -> Iterator[pd.DataFrame]:
    """The same rows, at most ``rows`` at a time."""
    for part in batches:
        for k in range(0, len(part), rows):
            yield part.iloc[k : k + rows]


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint in the shared folder the session names in spark.checkpoint.dir.

    Where none is named, a session on one machine gets a folder of its own, removed at the end; a cluster is refused,
    since a folder of one machine would be lost with it.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if shared is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="auditlake-")
            atexit.register(shutil.rmtree, shared, ignore_errors=True)
        sc.setCheckpointDir(shared)
    return df.checkpoint(eager=eager)
