"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.  Only a ``local`` master without
    one gets a temp folder; a cluster without one is an error, because its
    machines do not see each other's folders."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerlens-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage,
    and later readers do not recompute it when an executor is lost."""
    path = f"{shared_folder(df.sparkSession)}/ledgerlens-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside hands at most ``rows`` rows at once to Python workers: for rows that hold long
    lists, whose buffers count beside the heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from its folder, as the driver does.
    (A cluster without that folder on its machines ships the package with --py-files.)"""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    known = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known and root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join([*known, root])
