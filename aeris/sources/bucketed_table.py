"""Facts and statistics bucketed alike, so that they join without a shuffle.

Rows are bucketed by station and month: one file per bucket, sorted within.  A join or an aggregate whose keys hold both
columns then reads each bucket where it lies.  A station that holds a third of all rows is spread over its
months, which a bucketing by station alone would not do.  Null keys never meet in an equi-join;
tables of the cleaning jobs have none.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BUCKET_KEYS = ("station_id", "month")


def write_bucketed(df: DataFrame, path: str, buckets: int, keys: Sequence[str] = BUCKET_KEYS, name: str | None = None) -> str:
    """Write ``df`` below ``path`` in ``buckets`` buckets and give the name it has in the session's catalog."""
    table = name or f"bucketed_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite")
     .format("parquet").saveAsTable(table))
    return table


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def attach_month_stats(facts: DataFrame, stats: DataFrame, keys: Sequence[str] = BUCKET_KEYS) -> DataFrame:
    """Left join of per-month statistics to their rows by plain equality; no exchange where both are bucketed by ``keys``."""
    return facts.join(stats, list(keys), "left")
