"""Derived weather and emission attributes.

The standardized precipitation index compares each station-month's mean
precipitation with that station's history:

    W1  monthly mean   avg(precip) per (station, year, month)
    W2  station mean   mean of W1 over the station's rows
    W3  station spread sample stddev of W1 over the station's rows
    SPI                round((W1 - W2) / W3, 1), null when W3 is null or 0

W2 and W3 weigh every month by its row count.  Rather than window passes
over the rows (which shuffle and sort the whole table by station and put a
hot station into one task), the statistics come from a station-month
aggregate (partial aggregation, small output), a weighted mean and a
two-pass variance as windows over that aggregate, and one join of the
station-month SPI back to the rows.  Means and squares are summed as decimals, so
the index does not depend on the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeris.functions import buckets
from aeris.functions.dates import as_date
from aeris.functions.numeric import exact_avg, exact_sums_over, with_exact
from aeris.operators.joins import attach_group_stats


def spi_from_monthly(monthly: DataFrame, station: str = "station_id") -> DataFrame:
    """Add ``spi_index`` to a station-month table with ``__mavg`` (mean) and ``__n`` (rows).

    The station's weighted mean and two-pass sample variance are windows over
    that small table partitioned by station, which share one exchange.
    """
    by_station = Window.partitionBy(station)
    # rows of a month without any precipitation value carry no monthly mean
    n = F.when(F.col("__mavg").isNotNull(), F.col("__n"))
    with_mean = monthly.withColumns(exact_sums_over({"__total": n * F.col("__mavg")}, by_station) | {"__cnt": F.sum(n).over(by_station)})
    with_mean = with_exact(with_mean, "__total").withColumn("__mean", F.col("__total") / F.col("__cnt")).drop("__total")
    with_ss = with_exact(with_mean.withColumns(exact_sums_over({"__ss": n * (F.col("__mavg") - F.col("__mean")) ** 2}, by_station)), "__ss")
    std = F.when(F.col("__cnt") > 1, F.sqrt(F.col("__ss") / (F.col("__cnt") - 1)))
    spi = F.when(std.isNull() | (std == 0), F.lit(None).cast("double")).otherwise(
        (F.col("__mavg") - F.col("__mean")) / std)
    return with_ss.withColumn("spi_index", F.round(spi, 1)).drop("__cnt", "__mean", "__ss")


def spi_table(df: DataFrame, station: str = "station_id", date: str = "date",
              precip: str = "precipitation_mm") -> DataFrame:
    """SPI per (station, year, month): columns station, __y, __m, spi_index.

    One aggregate gives each station-month's mean and row count; the station
    statistics follow from it (``spi_from_monthly``).
    """
    d = as_date(df, date)
    monthly = (df.select(F.col(station), F.year(d).alias("__y"), F.month(d).alias("__m"),
                         F.col(precip).cast("double").alias("__p"))
               .groupBy(station, "__y", "__m")
               .agg(exact_avg("__p").alias("__mavg"), F.count(F.lit(1)).alias("__n")))
    return spi_from_monthly(monthly, station).select(station, "__y", "__m", "spi_index")


def add_spi_index(df: DataFrame, station: str = "station_id", date: str = "date",
                  precip: str = "precipitation_mm", out: str = "spi_index") -> DataFrame:
    """Attach the station-month SPI to every row."""
    d = as_date(df, date)
    keyed = df.withColumns({"__y": F.year(d), "__m": F.month(d)})
    table = spi_table(df, station, date, precip).withColumnRenamed("spi_index", out)
    joined = attach_group_stats(keyed.drop(out) if out in df.columns else keyed,
                                table, [station, "__y", "__m"])
    return joined.drop("__y", "__m")


def add_weather_attributes(df: DataFrame) -> DataFrame:
    """temp_range_c, temp_category, precipitation_category where inputs exist (P16, P17a-b)."""
    exprs = {}
    if {"max_temp_c", "min_temp_c"}.issubset(df.columns):
        exprs["temp_range_c"] = buckets.temp_range()
    if "avg_temp_c" in df.columns:
        exprs["temp_category"] = buckets.temp_category()
    if "precipitation_mm" in df.columns:
        exprs["precipitation_category"] = buckets.precipitation_category()
    return df.withColumns(exprs) if exprs else df


def add_risk_scores(df: DataFrame) -> DataFrame:
    """climate_risk_score and climate_risk_level (P18a-e); helper scores never materialise."""
    scored = df.withColumn("climate_risk_score", buckets.climate_risk_score())
    return scored.withColumn("climate_risk_level", buckets.climate_risk_level())


def enrich_weather(df: DataFrame) -> DataFrame:
    """Range, categories, SPI and risk in the order the scores depend on them."""
    out = add_weather_attributes(df)
    out = add_spi_index(out)
    return add_risk_scores(out)


def enrich_emissions(df: DataFrame, emission: str = "MtCO2_per_day", sector: str = "sector",
                     case_sensitive_sector: bool = False) -> DataFrame:
    """emission_level and sector_category (P17c, P17d)."""
    exprs = {}
    if emission in df.columns:
        exprs["emission_level"] = buckets.emission_level(emission)
    if sector in df.columns:
        exprs["sector_category"] = buckets.sector_category(sector, case_sensitive_sector)
    return df.withColumns(exprs) if exprs else df
