"""K1 K2 K3 K7: file sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


def _time_clump(df: DataFrame, sort_by: list[str] | None, clump: str | None) -> Column | None:
    """The stretch of time a row lies in, by the first time column it is sorted by."""
    times = [c for c in sort_by or [] if isinstance(df.schema[c].dataType, (TimestampType, TimestampNTZType, DateType))]
    return F.date_trunc(clump, times[0]) if clump and times else None


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", sort_by: list[str] | None = None, clump: str | None = "month") -> None:
    """Parquet, optionally partitioned, each task's rows sorted by the partition columns and then by ``sort_by`` (O2), so
    row-group min/max statistics let later range filters skip row groups.

    A table partitioned and sorted by time is first dealt out by partition value and ``clump`` of time (a unit of ``date_trunc``):
    a folder gets at most one file per clump, not one from every task, and a hot value is split between tasks by its clumps.  With
    ``clump=None``, or without a time column to sort by, rows are written where they are.  Rows of null time are one clump."""
    w = df
    stretch = _time_clump(df, sort_by, clump)
    if partition_by and stretch is not None:
        w = w.repartition(*partition_by, stretch)
    order = [*(partition_by or []), *(sort_by or [])]
    if order:
        w = w.sortWithinPartitions(*order)
    writer = w.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None,
              mode: str = "overwrite", header: bool = False) -> None:
    """K7: header-less CSV (the archive's format), one folder per partition value."""
    w = df.sortWithinPartitions(*partition_by) if partition_by else df
    writer = w.write.mode(mode).option("header", str(header).lower())
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_lines(lines: DataFrame, path: str, name: str, order: list[str], line: str = "line", mode: str = "overwrite") -> None:
    """One text file per value of ``name`` (in a folder ``name=value``) with its ``line`` values in the given order,
    each ended by a newline.  A file is written by one task, so ``name`` must be as fine as a file may be large."""
    w = lines.repartition(name).sortWithinPartitions(name, *order).select(name, line)
    w.write.mode(mode).option("lineSep", "\n").partitionBy(name).text(path)
