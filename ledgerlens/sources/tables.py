"""Sources and sinks (SRC-1..4, SNK-1..4).

Parquet (optionally catalogued) and JDBC only, as in the jobs being rebuilt.
Sinks never force a number of output files: at scale one file means one task.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import remove_folder, shuffles_deleted

__all__ = [
    "read_table",
    "read_ingestion_day",
    "snapshot_jdbc",
    "counted",
    "write_table",
    "bucket_count",
    "write_bucketed",
    "append_log",
    "write_month",
    "write_if_nonempty",
    "lower_case_columns",
]


def read_table(spark: SparkSession, name: str | None = None, path: str | list[str] | None = None,
               fmt: str = "parquet", database: str | None = None) -> DataFrame:
    """SRC-1 / SRC-3: a catalogued table by (database and) name, or files by path or glob."""
    if path is None and name is None:
        raise ValueError("read_table needs a table name or a path")
    if path is None:
        return spark.table(f"{database}.{name}" if database else name)
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format(fmt).load(paths)


def read_ingestion_day(df: DataFrame, day: _dt.date, year_col: str = "ingestionyear",
                       month_col: str = "ingestionmonth", day_col: str = "ingestionday") -> DataFrame:
    """SRC-2: one ingestion partition.  On partition columns Catalyst prunes the
    directories.  On text columns the values are read as numbers first (so nothing is
    pushed into the scan); a malformed value belongs to no day."""
    def number(c: str):
        return F.col(c).try_cast("int")

    return df.where((number(year_col) == day.year) & (number(month_col) == day.month) & (number(day_col) == day.day))


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def snapshot_jdbc(spark: SparkSession, url: str, table: str, dest: str, properties: dict | None = None,
                  partition_column: str | None = None, lower_bound: int | None = None,
                  upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """SRC-4: copy a JDBC table to Parquet with lower-case column names.

    Give ``partition_column``, bounds and ``num_partitions`` for a parallel read of a big
    table; each partition is read and written by a task of its own.  Returns the written
    data read back.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    lower_case_columns(reader.load()).write.mode("overwrite").parquet(dest)
    return spark.read.parquet(dest)


def counted(df: DataFrame, condition: Column | None = None) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its rows (``n``; only those of ``condition``), filled by the
    action that writes it: nothing runs a second time to learn whether there are any."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1) if condition is None else F.when(condition, 1)).alias("n")), seen


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """SNK-1: write Parquet.  AQE sizes the output tasks; partitioned output is gathered
    by partition first."""
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


#: Rows of one bucket, as one task writes and reads them.
BUCKET_ROWS = 500_000


def bucket_count(df: DataFrame, rows: int = BUCKET_ROWS, least: int = 8) -> int:
    """Buckets for the rows of ``df``: as many as keep a bucket near ``rows``, so that a task's share does not
    grow with the table.  Counts ``df`` once, without its columns."""
    return max(least, -(-df.count() // rows))


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None, database: str = "default") -> None:
    """SNK-1 into the catalogue: a Parquet table bucketed and sorted by ``keys``, for the jobs that group
    or join on them: their first aggregate then needs no exchange.

    A bucket is one file (``bucket_count`` says how many suit a frame), written and later read by one task, so this suits keys of which none
    holds a large part of the rows; a table with such a key is better left unbucketed (its partial
    aggregates are then spread).  ``path`` makes the table external."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    with shuffles_deleted(df.sparkSession):
        (writer.option("path", path) if path else writer).saveAsTable(f"{database}.{name}")


def _replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Overwrite only the partitions present in ``df``, as an option of this one write.
    The rebalance gathers a partition's rows, splits large ones, and so bounds the files."""
    (df.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*columns).parquet(path))


def append_log(df: DataFrame, path: str, date_col: str = "date", day: _dt.date | None = None) -> int:
    """SNK-2: add a day's log rows; returns how many were written.

    Partitioned by day: re-running a day replaces that day instead of appending
    duplicates.  With ``day`` that day is replaced by the rows given even if there are none:
    its partition then goes, and no other.  Without it, a run without rows leaves what is there.
    """
    rows, seen = counted(df)
    own, of_day = counted(rows, None if day is None else F.col(date_col) == F.lit(day))
    _replace_partitions(own, path, date_col)
    if day is not None and not of_day.get["n"]:
        remove_folder(df.sparkSession, f"{path}/{date_col}={day.isoformat()}")
    return seen.get["n"]


def write_month(df: DataFrame, path: str, year_col: str = "year", month_col: str = "month") -> None:
    """SNK-3: (re)write only the ``year=/month=`` partitions present in ``df``."""
    _replace_partitions(df, path, year_col, month_col)


def write_if_nonempty(df: DataFrame, write, path: str, seen: Observation | None = None, **kwargs) -> bool:
    """SNK-4: skip empty inputs.  The rows are counted by the write itself, which goes to a folder beside
    ``path``; that takes its place only if there are any.  Returns whether it did.

    ``seen`` is an observation (see :func:`counted`) below ``df`` that decides instead of its own rows."""
    spark, staged = df.sparkSession, f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    if seen is None:
        df, seen = counted(df)
    write(df, staged, **kwargs)
    if not seen.get["n"]:
        remove_folder(spark, staged)
        return False
    remove_folder(spark, path)
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{staged} was not moved to {path}")
    return True
