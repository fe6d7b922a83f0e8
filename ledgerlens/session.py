"""Session helpers.

On a cluster the session (and its ``spark.checkpoint.dir``) comes from the
cluster; ``local_session`` is only for tests and the local bench.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on.  AQE re-plans joins (broadcast when the
# *measured* size is small), coalesces shuffle partitions and splits skewed
# join partitions at runtime.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Settings that keep tasks small and their code compiled.  HotSpot interprets methods of more than 8000 bytes,
# and Spark puts a wide projection in one method unless told of that limit.  Shuffled rows of this library hold short
# repeated strings, so that a compressed MB is some 40 MB of a task's memory.
TASK_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


#: Spark's setting that deletes the shuffle files of an action at its end.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession):
    """Actions inside leave no shuffle files: those of a finished write would stay on the executors' disks until the
    driver's next garbage collection finds them, beside all that later actions shuffle."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


def small_tasks(spark: SparkSession) -> None:
    """Settings of ``TASK_CONF`` that the session's owner has not set."""
    for name, value in TASK_CONF.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlens") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """The session's checkpoint folder: ``spark.checkpoint.dir`` as the cluster names it,
    else ``folder``, else a temp folder for a ``local`` master.

    A cluster without a folder is an error: its machines do not see each other's disks,
    so a machine-local fallback would lose data.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if folder is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


class JobStore:
    """Intermediates of one job, in a folder of its own under the session's checkpoint folder
    (the shared one on a cluster).

    ``keep`` writes a frame once as a Parquet table and reads it back: consumers read it instead of
    recomputing it, the lineage is cut, and a lost executor does not force recomputation.
    Used as a context, the store deletes its folder at the end, when the job's outputs are written;
    no other job's files are touched.
    """

    def __init__(self, spark: SparkSession, name: str = "job"):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/ledgerlens-jobs/{name}-{uuid.uuid4().hex}"
        #: Rows of what was kept, by name, counted by the writes.
        self.rows: dict[str, int] = {}

    def keep(self, df: DataFrame, name: str = "intermediate") -> DataFrame:
        path, seen = f"{self.folder}/{name}-{uuid.uuid4().hex}", Observation()
        with shuffles_deleted(self.spark):
            df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        self.rows[name] = seen.get["n"]
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        remove_folder(self.spark, self.folder)

    def __enter__(self) -> JobStore:
        return self

    def __exit__(self, *_) -> None:
        self.remove()


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint_shared(df: DataFrame, name: str = "intermediate", store: JobStore | None = None) -> DataFrame:
    """Materialise an intermediate that feeds several outputs of one job: in the job's ``store``, which deletes
    it, or (a frame that is returned lazily has no end) in a store of its own, which the cluster clears."""
    return (store or JobStore(df.sparkSession)).keep(df, name)
