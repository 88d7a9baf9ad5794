"""Nested document tables (P12, P13a-d, S15).

Each reshaping is a projection: flat columns move into ``struct`` columns and
dates become ISO strings.  A sub-document field whose source column is absent
is null, so every document of a collection has the same shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.functions.dates import document_dates
from aeris.sources.keyed_table import upsert


def _field(df: DataFrame, name: str, alias: str) -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).alias(alias)


def _nest(df: DataFrame, nests: dict[str, list[tuple[str, str]]],
          renames: dict[str, str] | None = None) -> DataFrame:
    moved = {src for fields in nests.values() for src, _ in fields}
    structs = [F.struct(*[_field(df, src, alias) for src, alias in fields]).alias(name)
               for name, fields in nests.items()]
    keep = [F.col(c).alias((renames or {}).get(c, c)) for c in df.columns if c not in moved]
    return df.select(*keep, *structs)


def weather_documents(df: DataFrame) -> DataFrame:
    """temperature{avg,min,max,range,category}, precipitation{value,category}, risk{score,level}."""
    return _nest(document_dates(df), {
        "temperature": [("avg_temp_c", "avg"), ("min_temp_c", "min"), ("max_temp_c", "max"),
                        ("temp_range_c", "range"), ("temp_category", "category")],
        "precipitation": [("precipitation_mm", "value"), ("precipitation_category", "category")],
        "risk": [("climate_risk_score", "score"), ("climate_risk_level", "level")],
    })


def co2_documents(df: DataFrame) -> DataFrame:
    """sector{type,category}; MtCO2_per_day renamed mt_co2_per_day."""
    return _nest(document_dates(df),
                 {"sector": [("sector", "type"), ("sector_category", "category")]},
                 renames={"MtCO2_per_day": "mt_co2_per_day"})


def country_documents(df: DataFrame) -> DataFrame:
    """capital{name,lat,long}."""
    return _nest(document_dates(df), {
        "capital": [("capital", "name"), ("capital_lat", "lat"), ("capital_lng", "long")]})


def city_documents(df: DataFrame) -> DataFrame:
    """coordinates{lat,long}."""
    return _nest(document_dates(df), {
        "coordinates": [("latitude", "lat"), ("longitude", "long")]})


def upsert_documents(df: DataFrame, path: str, keys: list[str], buckets: int = 64, batch_id: str | None = None) -> None:
    """Keyed sink (S15): documents replace those of the same key, nothing is there twice after a repeated load."""
    upsert(df, path, keys, buckets, batch_id=batch_id)


def write_documents(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "json") -> None:
    """Document-collection sink (S15): one JSON document per row, or parquet."""
    writer = df.write.mode(mode)
    if fmt == "json":
        writer.option("ignoreNullFields", "false").json(path)
    else:
        writer.parquet(path)
