"""Stored state of the precipitation index, which new months update without a look at history.

Two small tables hold what ``enrich.spi_table`` finds in one pass over all rows:

    month states    (station, year, month): rows, values, their exact total
    station states  (station): rows, mean and summed squared deviations of the monthly means

Month states add up.  Station states are merged pairwise (counts, means and squared deviations of two
parts give those of both), which keeps the deviations of a station of constant rain at exactly zero, as a difference of sums of
squares would not.  A batch that adds rows to a month that is already stored changes that
month's mean; the stations this happens to are found by key and their states are made
again from their month states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.functions.dates import as_date
from aeris.functions.numeric import EXACT
from aeris.operators.joins import attach_group_stats

MONTH_KEY = ["station_id", "year", "month"]


def month_states(df: DataFrame, station: str = "station_id", date: str = "date", precip: str = "precipitation_mm") -> DataFrame:
    """(station_id, year, month, rows, values, total) of a batch of observations."""
    d = as_date(df, date)
    return df.select(F.col(station).alias("station_id"), F.year(d).alias("year"), F.month(d).alias("month"),
                     F.col(precip).cast("double").try_cast(EXACT).alias("p")).groupBy(*MONTH_KEY).agg(
        F.count(F.lit(1)).alias("rows"), F.count("p").alias("values"), F.coalesce(F.sum("p"), F.lit(0)).cast(EXACT).alias("total"))


def merge_month_states(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy(*MONTH_KEY).agg(
        F.sum("rows").alias("rows"), F.sum("values").alias("values"), F.sum("total").cast(EXACT).alias("total"))


def _mean() -> Column:
    """Mean of a month, null where it has no value."""
    return F.try_divide(F.col("total"), F.when(F.col("values") > 0, F.col("values")).cast("decimal(10,0)")).cast(EXACT)


def station_states(months: DataFrame) -> DataFrame:
    """(station_id, n, mean, squares): every month counts by its rows; two passes over the month states."""
    own = months.withColumn("m", _mean()).filter("m IS NOT NULL")
    means = own.groupBy("station_id").agg(F.sum("rows").alias("n"), F.sum((F.col("rows").cast("decimal(12,0)") * F.col("m")).cast(EXACT)).alias("t")).select(
        "station_id", "n", F.try_divide("t", F.col("n").cast("decimal(12,0)")).cast(EXACT).alias("mean"))
    off = (F.col("m") - F.col("mean")).cast("double")
    return attach_group_stats(own, means, ["station_id"]).groupBy("station_id").agg(
        F.max("n").alias("n"), F.max("mean").alias("mean"), F.sum((F.col("rows") * off * off).cast(EXACT)).cast(EXACT).alias("squares"))


def merge_station_states(*states: DataFrame) -> DataFrame:
    """States of the union of disjoint batches, merged pairwise in a fixed order; a row for each batch and station goes in."""
    rows = states[0]
    for more in states[1:]:
        rows = rows.unionByName(more)
    double = "n bigint, mean decimal(38,12), squares decimal(38,12)"
    zero = F.from_json(F.lit('{"n": 0, "mean": 0, "squares": 0}'), double)

    def pair(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], (b["mean"] - a["mean"]).cast("double")
        share = b["n"] / n
        return F.struct(n.alias("n"), F.when(a["n"] == 0, b["mean"]).otherwise((a["mean"] + (gap * share).cast(EXACT)).cast(EXACT)).alias("mean"),
                        F.when(a["n"] == 0, b["squares"]).otherwise(
                            (a["squares"] + b["squares"] + (gap * gap * share * a["n"]).cast(EXACT)).cast(EXACT)).alias("squares"))

    parts = F.sort_array(F.collect_list(F.struct("n", "mean", "squares")))
    return rows.groupBy("station_id").agg(F.aggregate(parts, zero, pair).alias("s")).select("station_id", "s.*")


def update(months: DataFrame, stations: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(month states, station states) after ``batch`` (month states of new rows)."""
    both = merge_month_states(months, batch)
    late = attach_group_stats(batch.select(*MONTH_KEY), months.select(*MONTH_KEY, F.lit(True).alias("there")), MONTH_KEY).filter("there").select(
        "station_id", F.lit(True).alias("late")).distinct()

    def split(df: DataFrame, again: bool) -> DataFrame:
        marked = attach_group_stats(df, late, ["station_id"])
        return marked.filter("late" if again else "late IS NULL").drop("late")

    merged = merge_station_states(split(stations, False), station_states(split(batch, False)))
    return both, merged.unionByName(station_states(split(both, True)))


def spi(months: DataFrame, stations: DataFrame) -> DataFrame:
    """(station_id, year, month, spi_index) of the given months."""
    std = F.sqrt(F.col("squares").cast("double") / (F.col("n") - 1))
    value = (F.col("m") - F.col("mean")).cast("double") / std
    return attach_group_stats(months.withColumn("m", _mean()), stations, ["station_id"]).select(
        *MONTH_KEY, F.round(F.when((F.col("n") > 1) & (F.col("squares") > 0), value), 1).alias("spi_index"))
