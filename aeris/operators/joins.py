"""Joins of facts with dimensions and per-key statistics.

No side is persisted, counted or hinted: Spark broadcasts a side whose byte
size is known (scans) or has been measured (AQE) to be below
``spark.sql.autoBroadcastJoinThreshold``; anything larger is a shuffle join, where
AQE splits a hot key's partition.  A table that changes between two
runs is read again each time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_group_stats(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Left join per-group statistics back to their rows.

    Null keys form their own group, as in ``groupBy``; the join therefore
    matches null to null.
    """
    right = stats.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & df[k].eqNullSafe(right[f"__k_{k}"])
    return df.join(right, cond, "left").drop(*[f"__k_{k}" for k in keys])


def reference_keys(df: DataFrame, column: str, reference: DataFrame, key: Column) -> DataFrame:
    """Distinct reference keys as ``__ref_key``, in the type of the checked column.

    A key that has no value of that type (text against a number) cannot match and is left out.
    """
    typed = key.try_cast(df.schema[column].dataType)
    return reference.select(typed.alias("__ref_key")).filter("__ref_key IS NOT NULL").distinct()


def semi_join_reference(df: DataFrame, reference: DataFrame | list, column: str,
                        ref_column: str | None = None, anti: bool = False) -> DataFrame:
    """Keep (or with ``anti`` drop) rows whose key exists in the reference.

    The reference may be a DataFrame or a plain list of allowed values.
    """
    if not isinstance(reference, DataFrame):
        cond = F.col(column).isin(list(reference))
        return df.filter(~cond | F.col(column).isNull() if anti else cond)
    keys = reference_keys(df, column, reference, F.col(ref_column or column))
    return df.join(keys, df[column] == keys["__ref_key"], "left_anti" if anti else "left_semi")
