"""Presentation selects of the query results.

The upstream notebooks round and relabel small result tables before showing
them; these are the same projections as DataFrames, so a caller can
``show()`` or write them.  Rounding: emission totals 4 places, risk and
temperatures 2 places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def extreme_weather_report(df: DataFrame) -> DataFrame:
    """Q-B result as the report table."""
    return df.select(
        F.col("country").alias("Country"), F.col("date").alias("Date"),
        F.col("extreme_events").alias("Extreme Events"), F.col("max_temp").alias("Max Temp (°C)"),
        F.round("avg_risk", 2).alias("Avg Risk Score"),
        F.round("total_emission", 4).alias("Total Emission (MtCO₂/day)"))


def top_day_report(df: DataFrame) -> DataFrame:
    """Q-A result: one row per listed city (the day itself when none is listed)."""
    return df.select(
        F.col("date").alias("Date"), F.col("country").alias("Country"),
        F.round("total_emission", 4).alias("Total CO₂"),
        F.explode_outer("hottest_cities").alias("c")).select(
        "Date", "Country", "Total CO₂", F.col("c.city_name").alias("City"),
        F.col("c.max_temp").alias("Max Temp (°C)"))


def monthly_report(df: DataFrame) -> DataFrame:
    """Q-C result as the report table."""
    return df.select(
        F.col("country").alias("Country"), F.col("month").alias("Month"),
        F.round("monthly_avg_temp", 2).alias("Monthly Avg Temp (°C)"),
        F.round("monthly_total_co2", 2).alias("Monthly Total CO₂"))


def hot_cities_report(df: DataFrame) -> DataFrame:
    """Q-D result as the report table."""
    return df.select(
        F.col("city").alias("City"), F.col("country").alias("Country"),
        F.col("hot_days_count").alias("Hot Days Count"),
        F.round("avg_co2", 2).alias("Avg CO₂ (MtCO₂/day)"))
