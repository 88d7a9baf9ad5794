"""Command line for the jobs a user of the upstream scripts runs.

    python -m aeris ingest        --source DIR --sink DIR --checkpoint DIR --dataset weather|co2
                                  [--max-files-per-trigger N] [--max-bytes-per-trigger B] [--files-per-batch N]
    python -m aeris clean-weather --input PATH --cities CSV --output DIR [--by-month]
    python -m aeris clean-co2     --input PATH --countries CSV --output DIR [--floor D] [--as-of D] [--mode append]
    python -m aeris documents     --weather P --co2 P --cities CSV --countries CSV --output DIR [--mode append|upsert]
    python -m aeris graph         --weather P --co2 P --cities CSV --countries CSV --output DIR [--mode append|upsert]
    python -m aeris query NAME    --weather P --co2 P --cities CSV --countries CSV [--output DIR] [--report]
                                  [--threshold T] [--risk-levels L ...] [--limit N] [--country C] [--true-sum]
    python -m aeris vulnerability --weather DIR --cities CSV [--output DIR] [--stream] [--checkpoint DIR]
                                  [--max-files-per-trigger N]

Paths may be parquet or CSV (``read_any``); the city and country CSVs are
read with their fixed schemas.  Results go to parquet (``--output``) or are
shown on the console.  The session is the caller's ``spark-submit`` session;
``spark.checkpoint.dir`` names the shared folder for lineage cuts.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from aeris.operators import documents, graph
from aeris.plans import climate_queries as cq
from aeris.plans import cleaning as jobs
from aeris.plans import reports
from aeris.plans.vulnerability import country_vulnerability
from aeris.sources.readers import read_any
from aeris.sources.schemas import (
    CITY_SCHEMA,
    CO2_CLEAN_SCHEMA,
    CO2_RAW_SCHEMA,
    COUNTRY_SCHEMA,
    WEATHER_CLEAN_SCHEMA,
    WEATHER_RAW_SCHEMA,
)
from aeris.streaming import ingest, vulnerability_stream

REPORTS = {"top-day": reports.top_day_report, "extreme": reports.extreme_weather_report,
           "monthly": reports.monthly_report, "hot-cities": reports.hot_cities_report}
# Fields that tell the documents of a collection apart.
DOCUMENT_KEYS = {"weathers": ["station_id", "date"], "carbons": ["country", "date", "sector"], "cities": ["station_id"],
                 "countries": ["country"]}
QUERY_NAMES = ["top-day", "extreme", "monthly", "hot-cities", "countries"]


def _emit(df: DataFrame, output: str | None, name: str, show: int = 20) -> None:
    if output:
        df.write.mode("overwrite").parquet(f"{output.rstrip('/')}/{name}")
    else:
        df.show(show, truncate=False)


def _dims(spark: SparkSession, args) -> tuple[DataFrame | None, DataFrame | None]:
    cities = read_any(spark, args.cities, CITY_SCHEMA) if getattr(args, "cities", None) else None
    countries = read_any(spark, args.countries, COUNTRY_SCHEMA) if getattr(args, "countries", None) else None
    return cities, countries


def run(spark: SparkSession, argv: list[str]) -> dict:
    """Parse ``argv`` and run one command; returns a small summary dict."""
    p = argparse.ArgumentParser(prog="aeris")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest")
    for a in ("--source", "--sink", "--checkpoint"):
        i.add_argument(a, required=True)
    i.add_argument("--dataset", choices=["weather", "co2"], required=True)
    i.add_argument("--rejects")
    for a in ("--max-files-per-trigger", "--max-bytes-per-trigger", "--files-per-batch"):
        i.add_argument(a, type=int)
    for name, extra in (("clean-weather", "--cities"), ("clean-co2", "--countries")):
        c = sub.add_parser(name)
        c.add_argument("--input", required=True)
        c.add_argument(extra, required=True)
        c.add_argument("--output", required=True)
        c.add_argument("--files", type=int)
        c.add_argument("--floor", default="2019-01-01")
        c.add_argument("--as-of")
        c.add_argument("--min-rows", type=int)
        c.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
        c.add_argument("--by-month", action="store_true")
    for name in ("documents", "graph", "query"):
        c = sub.add_parser(name)
        if name == "query":
            c.add_argument("name", choices=QUERY_NAMES)
            c.add_argument("--country")
            c.add_argument("--limit", type=int)
            c.add_argument("--true-sum", action="store_true")
            c.add_argument("--report", action="store_true")
            c.add_argument("--threshold", type=float)
            c.add_argument("--risk-levels", nargs="+", default=["HIGH", "SEVERE"])
        else:
            c.add_argument("--mode", choices=["overwrite", "append", "upsert"], default="overwrite")
        for a in ("--weather", "--co2", "--cities", "--countries", "--output"):
            c.add_argument(a)
    v = sub.add_parser("vulnerability")
    v.add_argument("--weather", required=True)
    v.add_argument("--cities", required=True)
    v.add_argument("--stream", action="store_true")
    v.add_argument("--checkpoint")
    v.add_argument("--output")
    v.add_argument("--max-files-per-trigger", type=int)
    v.add_argument("--trigger-seconds", type=int, default=20)
    v.add_argument("--timeout-seconds", type=float)
    args = p.parse_args(argv)

    if args.cmd == "ingest":
        schema = WEATHER_RAW_SCHEMA if args.dataset == "weather" else CO2_RAW_SCHEMA
        ingest.await_query(ingest.ingest(spark, args.source, args.sink, args.checkpoint, schema,
                                         max_per_trigger=args.max_files_per_trigger, rejects=args.rejects,
                                         max_bytes_per_trigger=args.max_bytes_per_trigger, files_per_batch=args.files_per_batch))
        return {"ingested": args.sink}

    if args.cmd in ("clean-weather", "clean-co2"):
        raw = read_any(spark, args.input, WEATHER_RAW_SCHEMA if args.cmd == "clean-weather" else CO2_RAW_SCHEMA)
        cities, countries = _dims(spark, args)
        gate = {"min_rows": args.min_rows} if args.min_rows is not None else {}
        if args.cmd == "clean-weather":
            valid, result = jobs.clean_weather(raw, cities, spec=jobs.weather_spec(**gate))
        else:
            valid, result = jobs.clean_co2(raw, countries,
                                           spec=jobs.co2_spec(floor=args.floor, as_of=args.as_of, **gate))
        summary = result.check_gates()          # raises before anything is written (V7)
        jobs.write_cleaned(valid, args.output, mode=args.mode, files=args.files, by_month=args.by_month)
        result.release(spark)
        summary["steps"] = jobs.step_counts(result.steps)
        summary["issues_found"] = result.issues_found()
        summary["checks"] = result.checks()
        print(json.dumps(summary, default=str))
        return summary

    cities, countries = _dims(spark, args)
    weather = read_any(spark, args.weather, known=WEATHER_CLEAN_SCHEMA) if args.weather else None
    co2 = read_any(spark, args.co2, known=CO2_CLEAN_SCHEMA) if getattr(args, "co2", None) else None

    if args.cmd == "documents":
        out = args.output.rstrip("/")
        for name, df, shape in [("weathers", weather, documents.weather_documents),
                                ("carbons", co2, documents.co2_documents),
                                ("cities", cities, documents.city_documents),
                                ("countries", countries, documents.country_documents)]:
            if df is not None and args.mode == "upsert":
                documents.upsert_documents(shape(df), f"{out}/{name}", DOCUMENT_KEYS[name])
            elif df is not None:
                documents.write_documents(shape(df), f"{out}/{name}", mode=args.mode)
        return {"documents": out}

    if args.cmd == "graph":
        out = args.output.rstrip("/")
        tables = {
            "nodes/City": graph.nodes(cities), "nodes/Country": graph.nodes(countries),
            "nodes/Weather": graph.nodes(weather),
            "nodes/Co2": graph.nodes(co2),
            "nodes/Date": graph.date_nodes(weather), "nodes/Sector": graph.sector_nodes(co2),
            "nodes/EmissionValue": graph.emission_value_nodes(co2),
            "edges/LOCATED_IN": graph.located_in(cities, countries),
            "edges/HAS_CO2": graph.has_co2(countries, co2),
            "edges/HAS_WEATHER": graph.has_weather(cities, weather),
            "edges/ON_DATE": graph.on_date(weather),
            "edges/EMIT_FROM": graph.emit_from(co2),
            "edges/HAS_VALUE": graph.has_value(co2),
        }
        for name, df in tables.items():
            if args.mode == "upsert":  # merged on all properties, as the store does
                graph.link_edges(df, f"{out}/{name}", df.columns)
            else:
                graph.write_nodes(df, f"{out}/{name}", mode=args.mode)
        return {"graph": out}

    if args.cmd == "query":
        limit = args.limit
        if args.name == "countries":
            df = cq.list_countries(countries)
        elif args.name == "top-day":
            df = cq.top_emission_day_with_cities(co2, weather, cities, country=args.country)
        elif args.name == "extreme":
            df = cq.emission_vs_extreme_weather(weather, cities, co2, limit=limit or 50, risk_levels=args.risk_levels,
                                                temp_threshold=35.0 if args.threshold is None else args.threshold)
        elif args.name == "monthly":
            df = cq.monthly_temp_and_co2(weather, cities, countries, co2, limit=limit or 30,
                                         dedup_fanout=args.true_sum)
        else:
            df = cq.hot_cities_vs_co2(weather, cities, countries, co2, limit=limit or 20,
                                      hot_threshold=30.0 if args.threshold is None else args.threshold)
        if args.report and args.name in REPORTS:
            df = REPORTS[args.name](df)
        _emit(df, args.output, args.name)
        return {"query": args.name}

    if args.cmd == "vulnerability":
        if args.stream:
            vulnerability_stream.process_stream(spark, args.weather, cities, checkpoint=args.checkpoint,
                                                trigger_seconds=args.trigger_seconds,
                                                timeout_seconds=args.timeout_seconds, output=args.output,
                                                max_files_per_trigger=args.max_files_per_trigger)
            return {"stream": "stopped"}
        _emit(country_vulnerability(weather, cities), args.output, "vulnerability")
        return {"vulnerability": "batch"}
    raise ValueError(args.cmd)


def main() -> None:
    import sys

    spark = SparkSession.builder.getOrCreate()
    run(spark, sys.argv[1:])


if __name__ == "__main__":
    main()
