"""Column profiles that add up.

``column_profile`` gives a row for each column of a batch: rows, nulls, NaNs, least and greatest value, and
two sketches as bytes, one of distinct values (HLL) and one of quantiles (KLL, numbers only).  Profiles of
batches are merged by ``merge_profiles`` without a look at the rows, so the report over a table needs its new batch
only.  Counts and extremes are exact.  The number of distinct values of an HLL sketch of ``LG_K`` = 12 is off by
1.6 % (one standard error), ranks of a KLL sketch of ``K`` = 200 by 1.33 % at most in 99 of 100 cases.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, FloatType, NumericType, TimestampNTZType, TimestampType

LG_K, K = 12, 200
MEASURES = ["total_rows", "null_count", "nan_count", "min_number", "max_number", "min_text", "max_text", "distinct_sketch", "quantile_sketch"]


def _number(df: DataFrame, c: str) -> Column | None:
    """The column as a double where it has one: numbers, and dates as days."""
    kind, col = df.schema[c].dataType, F.col(f"`{c}`")
    if isinstance(kind, NumericType):
        return col.cast("double")
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.datediff(col, F.lit("1970-01-01")).cast("double")
    return None


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, total_rows, null_count, nan_count, min_number, max_number, min_text, max_text, distinct_sketch,
    quantile_sketch), one aggregate over ``df``; sketches are null where a column has no value."""
    names = columns or df.columns
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for i, c in enumerate(names):
        col, number = F.col(f"`{c}`"), _number(df, c)
        floating = isinstance(df.schema[c].dataType, (DoubleType, FloatType))
        real = F.when(~F.isnan(number), number) if floating else number
        text = col.cast("string") if number is None else F.lit(None).cast("string")
        value = col.cast("int") if isinstance(df.schema[c].dataType, BooleanType) else F.when(number == 0, F.lit(0.0)).otherwise(
            number).cast("string") if number is not None else text
        nothing = F.lit(None).cast("double")
        aggs += [F.count_if(col.isNull()).alias(f"nulls{i}"), (F.count_if(F.isnan(number)) if floating else F.lit(0).cast("long")).alias(f"nans{i}"),
                 F.min(real if number is not None else nothing).alias(f"low{i}"), F.max(real if number is not None else nothing).alias(f"high{i}"),
                 F.min(text).alias(f"first{i}"), F.max(text).alias(f"last{i}"),
                 F.hll_sketch_agg(value.cast("string"), F.lit(LG_K)).alias(f"distinct{i}"),
                 (F.kll_sketch_agg_double(real, F.lit(K)) if number is not None else F.lit(None).cast("binary")).alias(f"quantiles{i}")]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.col("n").alias("total_rows"), *[
            F.col(f"{a}{i}").alias(b) for a, b in zip(("nulls", "nans", "low", "high", "first", "last", "distinct", "quantiles"),
                                                      MEASURES[1:], strict=True)]))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def merge_profiles(*profiles: DataFrame) -> DataFrame:
    """The profile of all batches from the profiles of each."""
    both = reduce(DataFrame.unionByName, profiles)
    return both.groupBy("column_name").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("null_count").alias("null_count"), F.sum("nan_count").alias("nan_count"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"), F.min("min_text").alias("min_text"),
        F.max("max_text").alias("max_text"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def profile_report(profile: DataFrame, ranks: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Counts, extremes, completeness, and what the sketches tell: distinct values and quantiles (null where there is no number)."""
    quantiles = F.when((F.col("total_rows") > F.col("null_count") + F.col("nan_count")) & F.col("min_number").isNotNull(),
                       F.array(*[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(r)) for r in ranks]))
    return profile.select(
        "column_name", "total_rows", "null_count", "nan_count", "min_number", "max_number", "min_text", "max_text",
        F.when(F.col("total_rows") > 0, F.round((F.col("total_rows") - F.col("null_count")) / F.col("total_rows") * 100, 2)).otherwise(
            0.0).alias("completeness_pct"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"), quantiles.alias("quantiles"))
