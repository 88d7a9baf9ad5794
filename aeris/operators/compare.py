"""Before and after a cleaning step, column by column.

Both tables are binned at the same cut points, found from the extremes of both, so their histograms can be laid over one
another; ``distance`` is half the sum of the differences of their shares (0: alike, 1: nothing in common).
Each table is read once, for the counts of each column's different values; extremes, histograms and numbers of
different values follow from these counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.session import materialize, remove_paths

BINS = 20


def _value_counts(df: DataFrame, columns: Sequence[str], paths: list[str]) -> DataFrame:
    """(column number, value as a double, null or not, number of rows) for each different value of each column, written once."""
    sets = [[c] for c in columns]
    counts = df.groupingSets(sets, *columns).agg(F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("__n"))
    picked = F.lit(None)
    for i, c in enumerate(columns):
        column_set = (1 << len(columns)) - 1 - (1 << (len(columns) - 1 - i))   # the other columns' bits
        picked = F.when(F.col("__set") == column_set, F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v"),
                                                              F.col(c).isNull().alias("gone"))).otherwise(picked)
    return materialize(counts.select(picked.alias("s"), F.col("__n").alias("n")).select("s.*", "n"), "value-counts", paths)


def _counts(values: DataFrame, cuts: dict[int, tuple[float, float]], bins: int) -> dict[int, dict]:
    """Rows, nulls, different values and rows by bin of each column that has rows."""
    v, spot = F.col("v"), F.lit(None).cast("long")
    for i, (low, high) in cuts.items():
        inside = F.least(F.greatest(F.floor((v - low) / (high - low) * bins), F.lit(0)), F.lit(bins - 1)) if high > low else F.lit(0)
        spot = F.when((F.col("i") == i) & v.isNotNull(), inside).otherwise(spot)
    found: dict[int, dict] = {}
    for r in values.groupBy("i", spot.alias("bin")).agg(
            F.sum("n").alias("n"), F.sum(F.when(F.col("gone"), F.col("n")).otherwise(0)).alias("nulls"), F.count_if(~F.col("gone")).alias("distinct")).collect():
        c = found.setdefault(r["i"], {"n": 0, "nulls": 0, "distinct": 0, "bins": {}})
        for k in ("n", "nulls", "distinct"):
            c[k] += r[k]
        if r["bin"] is not None:
            c["bins"][r["bin"]] = r["n"]
    return found


def compare(before: DataFrame, after: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """(column_name, rows, nulls, distinct values and histogram before and after, distance) for numeric ``columns``.

    A column without any value has null histograms and a null distance.
    """
    spark, paths = before.sparkSession, []
    names = list(dict.fromkeys(columns))
    values = [_value_counts(df, names, paths) for df in (before, after)]
    ends = values[0].unionByName(values[1]).groupBy("i").agg(F.min("v").alias("low"), F.max("v").alias("high")).collect()
    cuts = {r["i"]: (r["low"], r["high"]) for r in ends if r["low"] is not None}
    found = [_counts(v, cuts, bins) for v in values]
    remove_paths(spark, paths)
    rows = []
    for c in columns:
        i = names.index(c)
        a, b = (f.get(i, {"n": 0, "nulls": 0, "distinct": 0, "bins": {}}) for f in found)
        hists = [[r["bins"].get(k, 0) for k in range(bins)] if i in cuts else None for r in (a, b)]
        sums = [sum(h) if h else 0 for h in hists]
        far = sum(abs(x / sums[0] - y / sums[1]) for x, y in zip(*hists, strict=True)) / 2 if all(sums) else None
        rows.append((c, a["n"], b["n"], a["nulls"], b["nulls"], a["distinct"], b["distinct"], *hists, round(far, 6) if far is not None else None))
    return spark.createDataFrame(rows, "column_name string, rows_before long, rows_after long, nulls_before long, nulls_after long, "
                                       "distinct_before long, distinct_after long, histogram_before array<long>, "
                                       "histogram_after array<long>, distance double")
