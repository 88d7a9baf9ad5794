"""Country climate vulnerability (Q-E), one definition for batch and stream.

scored weather -> left join city dimension on city name -> unknown country labelled "Unknown" -> per-country risk
aggregate (partial aggregation; the state of the streaming form is one row
per country) -> percentages, ratio, index and category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.functions.buckets import pct, vulnerability_category
from aeris.functions.dates import parse_iso_timestamp
from aeris.functions.numeric import exact_avg
from aeris.operators.cleaning import dedup_by_key

# The result's columns in order.
VULNERABILITY_COLUMNS = [
    "country", "avg_risk_score", "max_risk_score", "min_risk_score",
    "low_cnt", "moderate_cnt", "high_cnt", "critical_cnt", "events",
    "pct_low", "pct_moderate", "pct_high", "pct_critical", "pct_worst",
    "high_risk_days_ratio", "climate_vulnerability_index", "vulnerability_category",
]


def city_dimension(cities: DataFrame, city_col: str = "city_name", country_col: str = "country",
                   key_col: str = "station_id", standardize: bool = True) -> DataFrame:
    """City name -> country, one row per name.

    With ``standardize`` the names get the same trim + initcap as the cleaned
    weather names, so hyphenated names still match (decision Q9); without it
    the raw names are used, as upstream does.
    """
    dim = cities.select(city_col, country_col, *([key_col] if key_col in cities.columns else []))
    if standardize:
        dim = dim.withColumn(city_col, F.initcap(F.trim(F.col(city_col))))
    dim = dim.na.drop(subset=[city_col])
    order = [key_col] if key_col in dim.columns else None
    return dedup_by_key(dim, [city_col], order).select(city_col, country_col)


def risk_events(weather: DataFrame, dimension: DataFrame, city_col: str = "city_name",
                country_col: str = "country") -> DataFrame:
    """Weather rows labelled with their country, "Unknown" when unmatched."""
    activity = weather
    if "date" in weather.columns:
        activity = weather.withColumn("date", parse_iso_timestamp("date"))
    drop_existing = [country_col] if country_col in activity.columns else []
    joined = activity.drop(*drop_existing).join(dimension, city_col, "left")
    return joined.withColumn(country_col, F.coalesce(F.col(country_col), F.lit("Unknown")))


def aggregate_risk(events: DataFrame, country_col: str = "country") -> DataFrame:
    """Per-country risk statistics and counts."""
    level = F.col("climate_risk_level")
    return events.groupBy(country_col).agg(
        F.round(exact_avg("climate_risk_score"), 2).alias("avg_risk_score"),
        F.max("climate_risk_score").alias("max_risk_score"),
        F.min("climate_risk_score").alias("min_risk_score"),
        F.count_if(level == "LOW").alias("low_cnt"),
        F.count_if(level == "MODERATE").alias("moderate_cnt"),
        F.count_if(level == "HIGH").alias("high_cnt"),
        F.count_if(level == "CRITICAL").alias("critical_cnt"),
        F.count(F.lit(1)).alias("events"),
    )


def vulnerability_metrics(grouped: DataFrame) -> DataFrame:
    """Percentages, high-risk ratio, vulnerability index and category."""
    high, crit, events = F.col("high_cnt"), F.col("critical_cnt"), F.col("events")
    out = grouped.withColumns({
        "pct_low": pct(F.col("low_cnt"), events),
        "pct_moderate": pct(F.col("moderate_cnt"), events),
        "pct_high": pct(high, events),
        "pct_critical": pct(crit, events),
        "pct_worst": pct(high + crit, events),
        "high_risk_days_ratio": F.round((high + crit) / events, 2),
    })
    out = out.withColumn(
        "climate_vulnerability_index",
        F.round(F.col("high_risk_days_ratio") * 0.6 + F.col("avg_risk_score") / 10 * 0.4, 2))
    out = out.withColumn("vulnerability_category", vulnerability_category())
    return out.select(*VULNERABILITY_COLUMNS)


def country_vulnerability(scored_weather: DataFrame, cities: DataFrame,
                          standardize_dimension: bool = True) -> DataFrame:
    """Batch form of Q-E over a scored (risk-enriched) weather table."""
    dim = city_dimension(cities, standardize=standardize_dimension)
    return vulnerability_metrics(aggregate_risk(risk_events(scored_weather, dim)))
