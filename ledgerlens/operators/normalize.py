"""Normalisation operators (NRM-1 ... NRM-10): one ``select`` each, all native."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerlens.functions.columns import as_date, environment_uk, lenient_integer, month_end

__all__ = [
    "cast_columns", "rename_columns", "clean_strings", "normalize_environment", "current_records",
    "null_sentinel_date", "drop_metadata", "month_end", "METADATA_COLUMNS",
]

# Lineage / ingestion columns of the raw snapshot tables (fixed names).
METADATA_COLUMNS = [
    "meta_hash", "meta_isdeleted", "meta_lastupdateprocessid", "meta_load_enddts", "meta_load_startdts",
    "meta_processid", "meta_source", "ingestionyear", "ingestionmonth", "ingestionday",
]


def cast_columns(df: DataFrame, integers: Iterable[str] = (), longs: Iterable[str] = (),
                 timestamps: Iterable[str] = (), booleans: Iterable[str] = (), doubles: Iterable[str] = (),
                 floats: Iterable[str] = (), dates: Iterable[str] = ()) -> DataFrame:
    """NRM-1: typed casts in one projection; values that do not parse become NULL.

    A column named in several lists is cast in the order timestamp, int, long,
    boolean, double, float, date (the last one wins, as chained casts would).
    """
    exprs = {c: F.col(c) for c in df.columns}
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    plan = [(timestamps, "timestamp"), (integers, "int"), (longs, "bigint"), (booleans, "boolean"),
            (doubles, "double"), (floats, "float"), (dates, "date")]
    lower = {c.lower(): c for c in df.columns}
    for names, kind in plan:
        for n in names:
            real = lower.get(n.lower())
            if real is not None:
                whole = kind in ("int", "bigint") and real in text
                exprs[real] = lenient_integer(exprs[real], kind) if whole else exprs[real].try_cast(kind)
    return df.select(*[e.alias(c) for c, e in exprs.items()])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """NRM-2: rename by mapping; names that are absent are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def clean_strings(df: DataFrame, upper: Iterable[str] = (), all_columns: bool = False) -> DataFrame:
    """NRM-3: trim string columns and upper-case ``upper``.

    ``all_columns=True`` trims every column, turning all of them into strings
    (the behaviour of the original cleaning helper).
    """
    upper = {u.lower() for u in upper}
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, StringType):
            c = F.trim(c)
        elif all_columns:
            c = F.trim(c.cast("string"))
        if f.name.lower() in upper:
            c = F.upper(c if isinstance(f.dataType, StringType) or all_columns else c.cast("string"))
        out.append(c.alias(f.name))
    return df.select(*out)


def normalize_environment(df: DataFrame, column: str = "environment") -> DataFrame:
    """NRM-4: site code GB -> UK."""
    return df.withColumn(column, environment_uk(column))


def current_records(df: DataFrame, end_col: str = "meta_load_enddts", deleted_col: str = "meta_isdeleted") -> DataFrame:
    """NRM-5: open (no end timestamp), non-deleted type-2 records.  A NULL deleted flag is not current."""
    return df.where(F.col(end_col).isNull() & ~F.col(deleted_col))


def null_sentinel_date(df: DataFrame, column: str = "cancellationdate", sentinel="9999-12-31") -> DataFrame:
    """NRM-6: the sentinel date means "none"."""
    return df.withColumn(column, F.when(F.col(column) != as_date(sentinel), F.col(column)))


def drop_metadata(df: DataFrame, extra: Iterable[str] = (), columns: Iterable[str] = METADATA_COLUMNS) -> DataFrame:
    """NRM-7: drop lineage/ingestion columns, case-insensitively; absent ones are ignored."""
    wanted = {c.lower() for c in list(columns) + list(extra)}
    return df.drop(*[c for c in df.columns if c.lower() in wanted])
