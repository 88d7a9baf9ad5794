"""Cleaned tables in month folders, their rows clustered by station.

A question about one day or one month then reads one folder: a filter on the month is answered by the
folder names, and a join with a day found at run time prunes the folders when that day is
known (dynamic partition pruning).  Within a file rows are sorted by station and date, so row groups
can be skipped by station too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.functions.dates import as_date, month_key

MONTH = "month"


def month_of(df: DataFrame, date: str = "date") -> Column:
    """``yyyy-MM``; rows without a date lie in a folder of their own."""
    return month_key(as_date(df, date))


def write_by_month(df: DataFrame, path: str, date: str = "date", cluster: Sequence[str] = ("station_id", "date"), mode: str = "overwrite",
                   compression: str = "gzip") -> None:
    """Write ``df`` into month folders; a large month is split over tasks by the size of its shuffled data.

    ``overwrite`` replaces only the months that ``df`` holds, so a job can write its month again.
    """
    rows = df.withColumn(MONTH, month_of(df, date)).hint("rebalance", MONTH)
    order = [c for c in cluster if c in df.columns]
    (rows.sortWithinPartitions(MONTH, *order).write.mode(mode).option("compression", compression)
     .option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path))


def read_by_month(spark: SparkSession, path: str) -> DataFrame:
    """The table with its ``month`` column, as text."""
    schema = spark.read.parquet(path).schema
    fields = [f for f in schema.fields if f.name != MONTH]
    return spark.read.schema(type(schema)([*fields]).add(MONTH, "string")).parquet(path)


def on_days(rows: DataFrame, days: DataFrame, date: str = "date") -> DataFrame:
    """``rows`` of the days in ``days`` (column ``date``, few rows), with the other columns of ``days``.

    Where ``rows`` has month folders, only those of the days are read: the months of ``days`` reach the
    scan when they are known.
    """
    if MONTH not in rows.columns:
        return rows.join(F.broadcast(days), date)
    found = days.withColumn(MONTH, month_of(days, date)).filter(F.col(MONTH) > "")  # a filter, so that pruning is worth its while
    return rows.join(F.broadcast(found), [MONTH, date])
