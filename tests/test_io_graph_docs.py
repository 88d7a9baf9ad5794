import datetime as dt
import os
import tempfile

import pytest
from pyspark.errors import AnalysisException

from aeris.operators import documents, graph
from aeris.plans.cleaning import write_cleaned
from aeris.sources import readers
from aeris.sources.schemas import CITY_SCHEMA
from aeris.streaming import ingest
from aeris.sources.readers import read_any
from tests.conftest import rows

D = dt.date(2020, 1, 1)


def test_read_any_dispatch_and_read_many(spark):
    base = tempfile.mkdtemp(prefix="io-")
    csv = os.path.join(base, "cities.csv")
    with open(csv, "w") as f:
        f.write("station_id,city_name,country,state,iso2,iso3,latitude,longitude\n"
                "D1051,Bonn,Germany,NRW,DE,DEU,50.7,7.1\n54511,Beijing,China,Beijing,CN,CHN,39.9,116.4\n")
    typed = readers.read_any(spark, csv, CITY_SCHEMA)
    assert dict(typed.dtypes)["latitude"] == "double"
    assert rows(typed, "station_id") == [("54511",), ("D1051",)]
    raw = readers.read_csv(spark, csv)
    assert all(t == "string" for _, t in raw.dtypes)
    typed.write.parquet(os.path.join(base, "cities_pq"))
    assert readers.read_any(spark, os.path.join(base, "cities_pq") + "/").count() == 2
    assert readers.read_any(spark, os.path.join(base, "cities_pq")).count() == 2   # no suffix: parquet first
    got = readers.read_many(spark, [("cities", csv), ("missing", None)], {"cities": CITY_SCHEMA})
    assert set(got) == {"cities"}


def test_write_cleaned_and_publish(spark):
    base = tempfile.mkdtemp(prefix="w-")
    df = spark.createDataFrame([(i, f"r{i}") for i in range(100)], "k int, v string")
    write_cleaned(df.repartition(8), f"{base}/out", files=2)
    files = [f for f in os.listdir(f"{base}/out") if f.endswith(".parquet")]
    assert len(files) == 2 and all(".gz" in f for f in files)
    assert spark.read.parquet(f"{base}/out").count() == 100
    ingest.publish_json(df, f"{base}/events")
    assert spark.read.text(f"{base}/events").count() == 100


def test_documents_nest_and_rename(spark):
    w = spark.createDataFrame([("1", D, 10.0, 5.0, 15.0, 10.0, "Mild", 2.0, "Light Rain", 0.3, "LOW")],
                              "station_id string, date date, avg_temp_c double, min_temp_c double, "
                              "max_temp_c double, temp_range_c double, temp_category string, "
                              "precipitation_mm double, precipitation_category string, "
                              "climate_risk_score double, climate_risk_level string")
    doc = documents.weather_documents(w).collect()[0].asDict(recursive=True)
    assert doc["date"] == "2020-01-01"
    assert doc["temperature"] == {"avg": 10.0, "min": 5.0, "max": 15.0, "range": 10.0, "category": "Mild"}
    assert doc["precipitation"] == {"value": 2.0, "category": "Light Rain"}
    assert doc["risk"] == {"score": 0.3, "level": "LOW"}
    c = spark.createDataFrame([("China", D, "Power", 1.0)], "country string, date date, sector string, MtCO2_per_day double")
    cdoc = documents.co2_documents(c).collect()[0].asDict(recursive=True)
    assert cdoc["sector"] == {"type": "Power", "category": None} and cdoc["mt_co2_per_day"] == 1.0
    base = tempfile.mkdtemp(prefix="docs-")
    documents.write_documents(documents.co2_documents(c), f"{base}/co2")
    text = "".join(open(os.path.join(f"{base}/co2", f)).read() for f in os.listdir(f"{base}/co2")
                   if f.endswith(".json"))
    assert '"category":null' in text


def test_graph_nodes_edges_and_idempotent_merge(spark):
    cities = spark.createDataFrame([("1", "A", "ALA"), ("1", "A", "ALA"), ("2", "B", "BLA")],
                                   "station_id string, city_name string, iso3 string")
    countries = spark.createDataFrame([("Aland", "ALA"), ("Bland", "BLA")], "country string, iso3 string")
    co2 = spark.createDataFrame([("Aland", D, "Power", 1.0), ("Aland", D, "Power", 2.0), ("Aland", D, None, 3.0)],
                                "country string, date date, sector string, MtCO2_per_day double")
    assert graph.nodes(cities).count() == 2                     # exact duplicates merge
    assert rows(graph.located_in(cities, countries)) == [("1", "A", "Aland", "cities.csv"),
                                                        ("2", "B", "Bland", "cities.csv")]
    assert rows(graph.emission_value_nodes(co2)) == [("2020-01-01", "Aland", "Power", 2.0)]
    assert rows(graph.sector_nodes(co2)) == [("Power",)]
    assert graph.emit_from(co2).count() == 2                    # rows without a sector do not link
    assert graph.has_value(co2).count() == 2
    edges = graph.located_in(cities, countries)
    again = graph.merge_edges(edges, edges, ["station_id", "country"])
    assert again.count() == edges.count()


def test_graph_edges_on_unique_input_skip_the_merge(spark):
    co2 = spark.createDataFrame([("Aland", D, "Power", 1.0), ("Aland", D, "Transport", 2.0)],
                                "country string, date date, sector string, MtCO2_per_day double")
    assert rows(graph.has_value(co2, assume_unique=True)) == rows(graph.has_value(co2))
    plan_rows = graph.nodes(co2, assume_unique=True)
    assert plan_rows.count() == 2


def test_relink_adds_each_missing_edge_once_and_knows_null_keys(spark):
    edges = spark.createDataFrame([("a", None), ("b", "1")], "x string, y string")
    new = spark.createDataFrame([("a", None), ("c", "2"), ("c", "2"), ("b", "1")], "x string, y string")
    assert rows(graph.merge_edges(edges, new, ["x", "y"])) == rows(
        spark.createDataFrame([("a", None), ("b", "1"), ("c", "2")], "x string, y string"))


def test_has_value_takes_the_largest_value_of_a_key(spark):
    co2 = spark.createDataFrame([("Aland", D, "Power", 1.0), ("Aland", D, "Power", 2.0)],
                                "country string, date date, sector string, MtCO2_per_day double")
    for flag in (False, True):
        got = sorted((r["MtCO2_per_day"], r["mtCo2PerDay"]) for r in graph.has_value(co2, assume_unique=flag).collect())
        assert got == [(1.0, 2.0), (2.0, 2.0)]


def test_documents_keep_text_dates_and_print_timestamps_as_iso(spark):
    df = spark.createDataFrame([("05/01/2020", dt.datetime(2020, 1, 5, 6, 7, 8), dt.datetime(2020, 1, 5, 6, 7, 8, 90))],
                               "date string, at timestamp, fine timestamp")
    got = documents.city_documents(df).collect()[0]
    assert (got["date"], got["at"], got["fine"]) == ("05/01/2020", "2020-01-05T06:07:08", "2020-01-05T06:07:08.000090")
    nodes = graph.nodes(df)
    assert nodes.schema["at"].dataType.simpleString() == "timestamp"
    assert nodes.collect()[0]["date"] is None


def test_paths_without_a_suffix_are_told_by_their_files(spark):
    base = tempfile.mkdtemp(prefix="kind-")
    spark.range(3).write.parquet(f"{base}/p")
    spark.range(3).write.option("header", "true").csv(f"{base}/c")
    assert read_any(spark, f"{base}/p").count() == 3
    assert read_any(spark, f"{base}/c").columns == ["id"]
    with pytest.raises(AnalysisException):
        read_any(spark, f"{base}/none")
