"""The command line over small climate-shaped files (raw CSVs as upstream ships them)."""

import json
import os
import tempfile

from aeris.cli import run
from aeris.sources import keyed_table
from aeris.streaming import vulnerability_stream

CITIES = """station_id,city_name,country,state,iso2,iso3,latitude,longitude
1,Paris,France,IDF,FR,FRA,48.8,2.3
2,Rostov-on-Don,Russia,Rostov,RU,RUS,47.2,39.7
"""
COUNTRIES = """country,native_name,iso2,iso3,population,area,capital,capital_lat,capital_lng,region,continent
France,France,FR,FRA,66000000.0,640679.0,Paris,48.8,2.3,Western Europe,Europe
Russia,Rossiya,RU,RUS,146000000.0,17000000.0,Moscow,55.7,37.6,Eastern Europe,Europe
"""


def _weather_json(folder):
    rows = []
    for st, city in (("1", "paris"), ("2", "rostov-on-don")):
        for day in range(1, 61):
            month, dom = (7, day) if day <= 31 else (8, day - 31)
            rows.append({"station_id": st, "city_name": city, "date": f"2020-{month:02d}-{dom:02d}", "season": "summer",
                         "avg_temp_c": 25.0 + day % 9, "min_temp_c": 15.0, "max_temp_c": 36.0 + day % 3,
                         "precipitation_mm": float(day % 4), "snow_depth_mm": None, "avg_wind_dir_deg": 1.0,
                         "avg_wind_speed_kmh": 1.0, "peak_wind_gust_kmh": 1.0,
                         "avg_sea_level_pres_hpa": 1.0, "sunshine_total_min": 1.0})
    with open(os.path.join(folder, "part-0.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + "\n")


def _co2_csv(path):
    with open(path, "w") as f:
        f.write("country,date,sector,MtCO2_per_day\n")
        for day in range(1, 31):
            for sector in ("Power", "Aviation", "Industry"):
                f.write(f"France,{day:02d}/07/2020,{sector},{0.1 * day}\nRussia,2020-07-{day:02d},{sector},{0.2 * day}\n")


def test_cli_end_to_end(spark):
    base = tempfile.mkdtemp(prefix="cli-")
    os.makedirs(f"{base}/events")
    _weather_json(f"{base}/events")
    open(f"{base}/cities.csv", "w").write(CITIES)
    open(f"{base}/countries.csv", "w").write(COUNTRIES)
    _co2_csv(f"{base}/co2.csv")
    run(spark, ["ingest", "--source", f"{base}/events", "--sink", f"{base}/raw_weather",
                "--checkpoint", f"{base}/ckpt", "--dataset", "weather"])
    w = run(spark, ["clean-weather", "--input", f"{base}/raw_weather/", "--cities", f"{base}/cities.csv",
                    "--output", f"{base}/weather"])
    assert w["count.final_count"] == 120 and w["steps"]["weather_input"] == 120
    c = run(spark, ["clean-co2", "--input", f"{base}/co2.csv", "--countries", f"{base}/countries.csv",
                    "--output", f"{base}/co2", "--as-of", "2025-01-01"])
    assert c["count.final_count"] == 180
    dims = ["--cities", f"{base}/cities.csv", "--countries", f"{base}/countries.csv"]
    data = ["--weather", f"{base}/weather/", "--co2", f"{base}/co2/"]
    for q in ("top-day", "extreme", "monthly", "hot-cities", "countries"):
        run(spark, ["query", q, *data, *dims, "--output", f"{base}/q"])
        assert spark.read.parquet(f"{base}/q/{q}").count() > 0, q
    run(spark, ["documents", *data, *dims, "--output", f"{base}/docs"])
    assert spark.read.json(f"{base}/docs/weathers").select("temperature.avg").count() == 120
    run(spark, ["graph", *data, *dims, "--output", f"{base}/graph"])
    assert spark.read.parquet(f"{base}/graph/edges/HAS_WEATHER").count() == 120
    run(spark, ["vulnerability", "--weather", f"{base}/weather/", "--cities", f"{base}/cities.csv",
                "--output", f"{base}/v"])
    got = {r["country"] for r in spark.read.parquet(f"{base}/v/vulnerability").collect()}
    assert got == {"France", "Russia"}


def test_cli_sinks(spark):
    """Month folders, repeated loads with upsert and append, one file per batch, the stream into a keyed table."""
    base = tempfile.mkdtemp(prefix="cli-")
    os.makedirs(f"{base}/events")
    _weather_json(f"{base}/events")
    open(f"{base}/cities.csv", "w").write(CITIES)
    open(f"{base}/countries.csv", "w").write(COUNTRIES)
    _co2_csv(f"{base}/co2.csv")
    run(spark, ["ingest", "--source", f"{base}/events", "--sink", f"{base}/raw", "--checkpoint", f"{base}/ckpt", "--dataset", "weather",
                "--files-per-batch", "1", "--max-bytes-per-trigger", "1000000"])
    assert len([f for f in os.listdir(f"{base}/raw/batch_id=0") if f.endswith(".parquet")]) == 1
    run(spark, ["clean-weather", "--input", f"{base}/raw/", "--cities", f"{base}/cities.csv", "--output", f"{base}/weather", "--by-month"])
    assert sorted(f for f in os.listdir(f"{base}/weather") if f.startswith("month=")) == ["month=2020-07", "month=2020-08"]
    dims = ["--cities", f"{base}/cities.csv", "--countries", f"{base}/countries.csv"]
    data = ["--weather", f"{base}/weather/", "--co2", f"{base}/co2.csv"]
    for _ in range(2):
        run(spark, ["documents", *data, *dims, "--output", f"{base}/docs", "--mode", "upsert"])
        run(spark, ["documents", *data, *dims, "--output", f"{base}/twice", "--mode", "append"])
    assert keyed_table.read(spark, f"{base}/docs/weathers").count() == 120
    assert keyed_table.read(spark, f"{base}/docs/carbons").select("sector.type").count() == 180
    assert spark.read.json(f"{base}/twice/cities").count() == 4
    run(spark, ["vulnerability", "--weather", f"{base}/weather/", "--cities", f"{base}/cities.csv", "--stream", "--output", f"{base}/v",
                "--checkpoint", f"{base}/vc", "--trigger-seconds", "1", "--timeout-seconds", "20", "--max-files-per-trigger", "1"])
    assert {r["country"] for r in vulnerability_stream.latest_state(spark, f"{base}/v").collect()} == {"France", "Russia"}
