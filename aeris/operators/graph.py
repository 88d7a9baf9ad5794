"""Property-graph tables (G1-G8, S16): one node table per label, one edge
table per relationship type, built with joins instead of a graph store.

Nodes are merged on all their properties (exact duplicate rows collapse, a
hash aggregate with map-side combine); dates are ISO strings as in the store.
Each edge row carries the natural key of both ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.functions.dates import graph_dates
from aeris.sources.keyed_table import upsert


def nodes(df: DataFrame, assume_unique: bool = False) -> DataFrame:
    """Node table for one label: ISO dates, duplicates on all properties merged (G1).

    The merge is a shuffle of the whole table.  A cleaned table is already
    unique on its key, so no two of its rows can be equal; ``assume_unique``
    skips the merge for such input.
    """
    iso = graph_dates(df)
    return iso if assume_unique else iso.dropDuplicates()


def located_in(cities: DataFrame, countries: DataFrame, source: str = "cities.csv") -> DataFrame:
    """City -[:LOCATED_IN {source}]-> Country where iso3 matches."""
    country = countries.select(F.col("iso3"), F.col("country").alias("country_name")).dropDuplicates()
    return (nodes(cities).select("station_id", "city_name", "iso3")
            .join(country, "iso3")
            .select("station_id", "city_name", F.col("country_name").alias("country"),
                    F.lit(source).alias("source")))


def has_co2(countries: DataFrame, co2: DataFrame, emission: str = "MtCO2_per_day",
            assume_unique: bool = False) -> DataFrame:
    """Country -[:HAS_CO2]-> Co2 on country; the Co2 end gains ``emissions``."""
    names = countries.select("country").dropDuplicates()
    return (nodes(co2, assume_unique).join(names, "country")
            .withColumn("emissions", F.col(emission)))


def has_weather(cities: DataFrame, weather: DataFrame, assume_unique: bool = False) -> DataFrame:
    """City -[:HAS_WEATHER]-> Weather on station_id (G4); the City end's name is ``city``."""
    city = nodes(cities).select("station_id", F.col("city_name").alias("city"))
    return nodes(weather, assume_unique).join(city, "station_id")


def date_nodes(weather: DataFrame, date: str = "date") -> DataFrame:
    """Distinct observation dates (G5); a null date cannot be a node key."""
    return (nodes(weather).select(F.col(date).alias("value"))
            .filter(F.col("value").isNotNull()).distinct())


def on_date(weather: DataFrame, keys: Sequence[str] = ("station_id", "date"),
            assume_unique: bool = False, merge_edges: bool = False) -> DataFrame:
    """Weather -[:ON_DATE]-> Date.

    ``merge_edges`` merges equal edges too, for a store that holds each once.  Equal nodes have equal edges, so the
    merge on the edge's columns does for both, and only these columns are shuffled.
    """
    w = nodes(weather, assume_unique or merge_edges)
    edges = w.filter(F.col("date").isNotNull()).select(*keys, F.col("date").alias("date_value"))
    return edges.dropDuplicates() if merge_edges else edges


def sector_nodes(co2: DataFrame) -> DataFrame:
    """Distinct non-null sectors."""
    return nodes(co2).filter(F.col("sector").isNotNull()).select(F.col("sector").alias("name")).distinct()


def emit_from(co2: DataFrame, assume_unique: bool = False) -> DataFrame:
    """Co2 -[:EMIT_FROM]-> Sector for rows with a sector."""
    c = nodes(co2, assume_unique)
    return c.filter(F.col("sector").isNotNull()).withColumn("sector_name", F.col("sector"))


EMISSION_KEY = ["date", "country", "sector"]


def emission_value_nodes(co2: DataFrame, emission: str = "MtCO2_per_day") -> DataFrame:
    """EmissionValue keyed (date, country, sector).

    The store overwrites mtCo2PerDay on every re-match, so the surviving
    value depends on match order; here it is the largest value, a fixed choice.
    Merging equal rows first would not change a maximum, so one aggregate does.
    """
    keyed = graph_dates(co2.select(*EMISSION_KEY, emission)).na.drop(subset=EMISSION_KEY)
    return keyed.groupBy(*EMISSION_KEY).agg(F.max(emission).alias("mtCo2PerDay"))


def has_value(co2: DataFrame, emission: str = "MtCO2_per_day", assume_unique: bool = False) -> DataFrame:
    """Co2 -[:HAS_VALUE]-> EmissionValue on (date, country, sector)."""
    return nodes(co2, assume_unique).join(emission_value_nodes(co2, emission), EMISSION_KEY)


def merge_edges(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Idempotent re-link (G8): add each edge whose key, nulls included, is not present yet, once."""
    have = existing.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & new[k].eqNullSafe(have[f"__{k}"])
    return existing.unionByName(new.join(have, same, "left_anti").dropDuplicates(list(keys)))


def link_edges(new: DataFrame, path: str, keys: Sequence[str], buckets: int = 64, batch_id: str | None = None) -> None:
    """G8 on a stored table: add the edges whose key is not there yet; only their buckets are read and written."""
    upsert(new, path, keys, buckets, batch_id=batch_id, update=False)


def write_nodes(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Node/edge sink (S16): replace the label's table."""
    df.write.mode(mode).parquet(path)
