"""Registered queries over the driver's test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed over
whole tables.  Column names match the DuckDB oracle in ``oracle_queries.py``.
Report-style outputs round floating aggregates (2 to 6 places, as the
upstream reports do) so that summation order cannot change the hash.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from aeris.functions import buckets
from aeris.functions.dates import month_key, parse_iso_timestamp, parse_multi_format_date
from aeris.operators import cleaning, compare, documents, enrich, graph, impute, profile, spi_state, validate
from aeris.operators.joins import semi_join_reference
from aeris.plans import cleaning as jobs
from aeris.plans import climate_queries as cq
from aeris.plans import reports
from aeris.plans.vulnerability import country_vulnerability
from aeris.session import materialize, scratch_path
from aeris.sources import bucketed_table, keyed_table, month_table, readers
from aeris.sources import testdata as td
from aeris.sources.schemas import WEATHER_RAW_SCHEMA
from aeris.streaming import gates, ingest, vulnerability_stream

Query = Callable[[SparkSession, str], DataFrame]
WEATHER_ID = ["l_orderkey", "l_linenumber", "l_partkey", "station_id", "date"]
TEMPS = ["avg_temp_c", "min_temp_c", "max_temp_c"]
LOADS, BYTES_PER_LOAD_FILE = 3, 32 << 20   # the state's stream: loads, and the input that a file of a load is made of, about
CO2_FLOOR, CO2_AS_OF = "1996-01-01", "2001-06-30"   # the test dates span 1995-2001


def scored_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_weather(td.weather_obs(spark, sf_dir))


# -- scrubbing, cleaning, standardising ---------------------------------------

def q_scrub_alpha(spark, sf_dir):
    c = td.table(spark, sf_dir, "customer")
    return cleaning.scrub_columns(c.select("c_custkey", "c_name"), alpha=["c_name"]) \
        .withColumnRenamed("c_name", "c_name_alpha")


def q_scrub_double(spark, sf_dir):
    e = td.table(spark, sf_dir, "events").select("event_id", "props", "value")
    return cleaning.scrub_columns(e, double=["props", "value"])


def q_scrub_int(spark, sf_dir):
    o = td.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return cleaning.scrub_columns(o, integer=["o_orderpriority"])


def q_drop_columns(spark, sf_dir):
    return cleaning.drop_columns(td.table(spark, sf_dir, "lineitem"), ["l_tax", "l_discount", "no_such_column"])


def q_drop_null_rows(spark, sf_dir):
    return cleaning.drop_null_rows(td.weather_obs(spark, sf_dir), TEMPS).select(*WEATHER_ID, *TEMPS)


def q_dedup_by_key(spark, sf_dir):
    return cleaning.dedup_by_key(td.weather_obs(spark, sf_dir), ["station_id", "date"])


def respelled_order_dates(spark, sf_dir):
    o = td.table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    raw = (F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.lit("bad"))
           .when(F.col("o_orderkey") % 5 == 0, F.date_format(d, "dd/MM/yyyy"))
           .when(F.col("o_orderkey") % 5 == 1, F.date_format(d, "d/M/yyyy"))
           .when(F.col("o_orderkey") % 5 == 2, F.date_format(d, "yyyy-MM-dd"))
           .when(F.col("o_orderkey") % 5 == 3, F.date_format(d, "yyyy/MM/dd"))
           .otherwise(F.date_format(d, "ddMMyyyy")))
    return o.select("o_orderkey", raw.alias("raw_date"))


def q_parse_dates(spark, sf_dir):
    return respelled_order_dates(spark, sf_dir).withColumn("parsed_date", parse_multi_format_date("raw_date"))


def q_standardize_text(spark, sf_dir):
    e = td.emissions(spark, sf_dir).select("o_orderkey", "country", "sector")
    return cleaning.standardize_text(e, ["country", "sector"])


def q_round_measures(spark, sf_dir):
    e = td.emissions(spark, sf_dir).select("o_orderkey", "MtCO2_per_day")
    return cleaning.round_columns(e, ["MtCO2_per_day"], 2)


def q_temp_order_filter(spark, sf_dir):
    return cleaning.filter_temp_order(td.weather_obs(spark, sf_dir)).select(*WEATHER_ID, *TEMPS)


def q_global_median_fill(spark, sf_dir):
    return impute.global_median_fill(td.emissions(spark, sf_dir), ["MtCO2_per_day"])


def q_group_median(spark, sf_dir):
    stats = impute.group_stats(td.weather_obs(spark, sf_dir), ["station_id"],
                               median_cols=["max_temp_c"])
    return stats.withColumnRenamed("__max_temp_c_median", "median_max_temp")


def q_impute_temps(spark, sf_dir):
    out = impute.impute_temperatures(td.weather_obs(spark, sf_dir))
    return out.select(*WEATHER_ID, *[F.round(c, 6).alias(c) for c in TEMPS])


# -- derived attributes -------------------------------------------------------

def q_temp_range(spark, sf_dir):
    return td.weather_obs(spark, sf_dir).select(*WEATHER_ID, buckets.temp_range().alias("temp_range_c"))


def q_temp_category(spark, sf_dir):
    return td.weather_obs(spark, sf_dir).select(*WEATHER_ID, buckets.temp_category().alias("temp_category"))


def q_precip_category(spark, sf_dir):
    return td.weather_obs(spark, sf_dir).select(
        *WEATHER_ID, buckets.precipitation_category().alias("precipitation_category"))


def q_emission_level(spark, sf_dir):
    e = enrich.enrich_emissions(td.emissions(spark, sf_dir))
    return e.select("o_orderkey", "MtCO2_per_day", "emission_level")


def q_sector_category(spark, sf_dir):
    e = enrich.enrich_emissions(td.emissions(spark, sf_dir))
    return e.select("o_orderkey", "sector", "sector_category")


def q_spi_index(spark, sf_dir):
    return enrich.add_spi_index(td.weather_obs(spark, sf_dir)).select(*WEATHER_ID, "spi_index")


def q_risk_score(spark, sf_dir):
    return scored_weather(spark, sf_dir).select(
        *WEATHER_ID, "spi_index", "climate_risk_score", "climate_risk_level")


def q_risk_level(spark, sf_dir):
    return scored_weather(spark, sf_dir).groupBy("climate_risk_level").agg(
        F.count(F.lit(1)).alias("n_rows"))


# -- validation ---------------------------------------------------------------

def _report(result) -> DataFrame:
    r = result.report.filter(F.col("item") != "processing_time")
    return r.select("section", "item", F.round("value", 6).alias("value"))


def weather_validation(spark, sf_dir):
    return validate.validate(scored_weather(spark, sf_dir), jobs.weather_spec(),
                             td.stations(spark, sf_dir))


def co2_job(spark, sf_dir):
    return jobs.clean_co2(td.emissions(spark, sf_dir), td.countries(spark, sf_dir), spec=jobs.co2_spec(floor=CO2_FLOOR, as_of=CO2_AS_OF))


def q_null_profile(spark, sf_dir):
    return validate.null_profile(td.weather_obs(spark, sf_dir))


def q_rule_violations_weather(spark, sf_dir):
    return _report(weather_validation(spark, sf_dir))


def q_rule_violations_co2(spark, sf_dir):
    return _report(co2_job(spark, sf_dir)[1])


def q_co2_quality_metrics(spark, sf_dir):
    m = validate.co2_quality_metrics(co2_job(spark, sf_dir)[0])
    return m.withColumn("avg_emission", F.round("avg_emission", 6))


def q_fk_valid_rows(spark, sf_dir):
    w = td.weather_obs(spark, sf_dir).select(*WEATHER_ID)
    return semi_join_reference(w, td.stations(spark, sf_dir), "station_id")


def q_clean_valid_rows(spark, sf_dir):
    return weather_validation(spark, sf_dir).valid


# -- documents ----------------------------------------------------------------

def q_doc_weather(spark, sf_dir):
    d = documents.weather_documents(scored_weather(spark, sf_dir))
    return d.select(*WEATHER_ID, *[F.col(f"{s}.{f}").alias(f"{s}_{f}") for s, fs in [
        ("temperature", ["avg", "min", "max", "range", "category"]),
        ("precipitation", ["value", "category"]), ("risk", ["score", "level"])] for f in fs])


def q_doc_co2(spark, sf_dir):
    d = documents.co2_documents(enrich.enrich_emissions(td.emissions(spark, sf_dir)))
    return d.select("o_orderkey", "country", "date", F.col("sector.type").alias("sector_type"),
                    F.col("sector.category").alias("sector_category"), "mt_co2_per_day", "emission_level")


def q_doc_city(spark, sf_dir):
    d = documents.city_documents(td.stations(spark, sf_dir))
    return d.select("station_id", "city_name", "country", "iso3",
                    F.col("coordinates.lat").alias("coordinates_lat"),
                    F.col("coordinates.long").alias("coordinates_long"))


def q_doc_country(spark, sf_dir):
    d = documents.country_documents(td.countries(spark, sf_dir))
    return d.select("country", "iso3", "region", F.col("capital.name").alias("capital_name"),
                    F.col("capital.lat").alias("capital_lat"), F.col("capital.long").alias("capital_long"))


# -- joined questions ---------------------------------------------------------

def q_list_countries(spark, sf_dir):
    return cq.list_countries(td.countries(spark, sf_dir))


def q_top_emission_day(spark, sf_dir):
    t = cq.top_emission_day(td.emissions(spark, sf_dir))
    return t.select("date", "country", F.round("total_emission", 4).alias("total_emission"))


def q_top_day_hottest_cities(spark, sf_dir):
    return _top_day_rows(cq.top_emission_day_with_cities(td.emissions(spark, sf_dir), td.weather_obs(spark, sf_dir),
                                                         td.stations(spark, sf_dir)))


def _top_day_rows(r):
    return r.select("date", "country", F.round("total_emission", 4).alias("total_emission"),
                    F.posexplode_outer("hottest_cities").alias("city_rank", "city")).select(
        "date", "country", "total_emission", "city_rank",
        F.col("city.city_name").alias("city_name"), F.col("city.max_temp").alias("max_temp"))


def q_extreme_weather_emissions(spark, sf_dir):
    r = cq.emission_vs_extreme_weather(scored_weather(spark, sf_dir), td.stations(spark, sf_dir),
                                       td.emissions(spark, sf_dir))
    return r.select("country", "date", "extreme_events", "max_temp",
                    F.round("avg_risk", 2).alias("avg_risk"),
                    F.round("total_emission", 4).alias("total_emission"))


def _monthly(spark, sf_dir, dedup_fanout=False):
    return cq.monthly_temp_and_co2(td.weather_obs(spark, sf_dir), td.stations(spark, sf_dir),
                                   td.countries(spark, sf_dir), td.emissions(spark, sf_dir),
                                   limit=None, dedup_fanout=dedup_fanout)


def _monthly_report(df):
    return df.select("country", "month", F.round("monthly_avg_temp", 2).alias("monthly_avg_temp"),
                     F.round("monthly_total_co2", 2).alias("monthly_total_co2"))


def q_monthly_temp_co2(spark, sf_dir):
    return _monthly_report(_monthly(spark, sf_dir))


def q_monthly_temp_co2_true(spark, sf_dir):
    return _monthly_report(_monthly(spark, sf_dir, dedup_fanout=True))


def q_monthly_daily_sample(spark, sf_dir):
    m = _monthly(spark, sf_dir)
    return m.select("country", "month", F.posexplode("daily_sample").alias("sample_idx", "s")).select(
        "country", "month", "sample_idx", F.col("s.date").alias("date"),
        F.round("s.avg_temp", 2).alias("avg_temp"), F.round("s.co2", 2).alias("co2"))


def q_monthly_temp_pivot(spark, sf_dir):
    countries = td.countries(spark, sf_dir)
    # the names of the country dimension are the columns of the result
    names = sorted(r[0] for r in countries.select("country").distinct().collect())
    m = _monthly(spark, sf_dir).withColumn("monthly_avg_temp", F.round("monthly_avg_temp", 2))
    return cq.monthly_temp_pivot(m, names)


def q_hot_cities_co2(spark, sf_dir):
    r = cq.hot_cities_vs_co2(td.weather_obs(spark, sf_dir), td.stations(spark, sf_dir),
                             td.countries(spark, sf_dir), td.emissions(spark, sf_dir))
    return r.select("city", "country", "hot_days_count", F.round("avg_co2", 2).alias("avg_co2"))


def q_vulnerability_batch(spark, sf_dir):
    return country_vulnerability(scored_weather(spark, sf_dir), td.stations(spark, sf_dir))


# -- graph tables -------------------------------------------------------------

def _node_rows(label: str, df: DataFrame, cols: list[str]) -> DataFrame:
    """Every node as (label, properties joined by a bar), so that tables of any shape compare."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols]
    return df.select(F.lit(label).alias("label"), F.concat_ws("|", *text).alias("node"))


def q_graph_nodes(spark, sf_dir):
    w, e = td.weather_obs(spark, sf_dir), td.emissions(spark, sf_dir)
    parts = [_node_rows("City", graph.nodes(td.stations(spark, sf_dir)), ["station_id", "city_name", "country", "iso3"]),
             _node_rows("Country", graph.nodes(td.countries(spark, sf_dir)), ["country", "iso3", "capital", "region"]),
             _node_rows("Weather", graph.nodes(w), ["l_orderkey", "l_linenumber", "l_partkey", "station_id", "city_name",
                                                    "date", "season"]),
             _node_rows("Co2", graph.nodes(e), ["o_orderkey", "country", "date", "sector"]),
             _node_rows("Date", graph.date_nodes(w), ["value"]), _node_rows("Sector", graph.sector_nodes(e), ["name"]),
             _node_rows("EmissionValue", graph.emission_value_nodes(e), ["date", "country", "sector"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_edge_relinked(spark, sf_dir):
    """One half of the edges linked, then all of them twice; each is there once."""
    e = graph.on_date(td.weather_obs(spark, sf_dir), keys=WEATHER_ID[:-1])
    keys = [*WEATHER_ID[:-1], "date_value"]
    return graph.merge_edges(e.filter(F.col("l_linenumber") % 2 == 0), e.unionByName(e), keys)


def q_edge_located_in(spark, sf_dir):
    return graph.located_in(td.stations(spark, sf_dir), td.countries(spark, sf_dir))


def q_edge_has_co2(spark, sf_dir):
    return graph.has_co2(td.countries(spark, sf_dir), td.emissions(spark, sf_dir))


def q_edge_has_weather(spark, sf_dir):
    e = graph.has_weather(td.stations(spark, sf_dir), td.weather_obs(spark, sf_dir))
    return e.select(*WEATHER_ID, "city")


def q_edge_on_date(spark, sf_dir):
    return graph.on_date(td.weather_obs(spark, sf_dir), keys=WEATHER_ID[:-1])


def q_edge_emit_from(spark, sf_dir):
    return graph.emit_from(td.emissions(spark, sf_dir)).select("o_orderkey", "country", "date", "sector_name")


def q_edge_has_value(spark, sf_dir):
    return graph.has_value(td.emissions(spark, sf_dir)).select(
        "o_orderkey", "date", "country", "sector", "mtCo2PerDay")


# -- JSON and streams ---------------------------------------------------------

def q_json_round_trip(spark, sf_dir):
    return ingest.json_round_trip(td.table(spark, sf_dir, "events"))


def _ingest_events(spark, sf_dir):
    """Events and some bad payloads through the ingest query; gives (sink, rejects, schema)."""
    events = td.table(spark, sf_dir, "events")
    base = scratch_path(spark, "ingest")
    bad = events.filter("event_id % 50 = 0").select(F.concat(
        F.element_at(F.array(*map(F.lit, BAD_PAYLOADS)), (F.col("event_id") / 50 % len(BAD_PAYLOADS) + 1).cast("int")),
        F.when(F.col("event_id") % 100 == 0, F.lit("")).otherwise(F.lit(" "))).alias("value"))
    ingest.to_json_lines(events).unionByName(bad).write.text(f"{base}/source")
    query = ingest.ingest(spark, f"{base}/source", f"{base}/sink", f"{base}/checkpoint", events.schema)
    ingest.await_query(query)
    return f"{base}/sink", f"{base}/sink_rejects", events.schema


# Not one JSON object each: an array, null, cut short, something after the object, no JSON at all.
BAD_PAYLOADS = ["[1, 2]", "null", '{"event_id": 1', '{"event_id": 1} tail', "event"]


def q_ingest_stream(spark, sf_dir):
    sink, _, schema = _ingest_events(spark, sf_dir)
    return ingest.ingested(spark, sink, schema)


def q_ingest_rejects(spark, sf_dir):
    _, rejects, _ = _ingest_events(spark, sf_dir)
    return ingest.refused(spark, rejects).groupBy("payload").agg(F.count(F.lit(1)).alias("n"))


def q_vulnerability_stream(spark, sf_dir):
    base = scratch_path(spark, "vulnerability")
    scored_weather(spark, sf_dir).write.parquet(f"{base}/weather")
    plan = vulnerability_stream.vulnerability_plan(spark, f"{base}/weather", td.stations(spark, sf_dir))
    q = vulnerability_stream.start(plan, sink="table", path=f"{base}/state",
                                   checkpoint=f"{base}/checkpoint", available_now=True)
    q.awaitTermination()
    return vulnerability_stream.latest_state(spark, f"{base}/state")


def q_stream_state(spark, sf_dir):
    """The stream over three loads of files, its state on disk with changelogs, read back from the checkpoint."""
    base = scratch_path(spark, "state")
    scored = scored_weather(spark, sf_dir)
    files = max(1, math.ceil(readers.input_bytes(scored) / (LOADS * BYTES_PER_LOAD_FILE)))   # of a load
    scored.repartition(LOADS * files).write.parquet(f"{base}/weather")
    settings = {**vulnerability_stream.STREAM_CONF, **vulnerability_stream.ROCKSDB_CONF}
    before = {k: spark.conf.get(k, None) for k in settings}
    vulnerability_stream.configure_stream_session(spark, settings)
    try:
        plan = vulnerability_stream.vulnerability_plan(spark, f"{base}/weather", td.stations(spark, sf_dir), max_files_per_trigger=files)
        q = vulnerability_stream.start(plan, sink="table", path=f"{base}/table", checkpoint=f"{base}/checkpoint", available_now=True)
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return vulnerability_stream.stored_state(spark, f"{base}/checkpoint")


def _publish_parts(df: DataFrame, base: str, parts: int) -> str:
    """Events as ``parts`` text files, by event_id; gives a path that takes them all."""
    for k in range(parts):
        part = df.filter(F.pmod("event_id", F.lit(parts)) == k).drop("event_id")
        part.coalesce(1).write.text(f"{base}/source/part{k}")
    return f"{base}/source/part*"


def q_gated_ingest(spark, sf_dir):
    """V4-V10 on a stream: of four files one has a third of its payloads cut short and is diverted; counts by place."""
    events = td.table(spark, sf_dir, "events")
    base = scratch_path(spark, "gated")
    lines = events.select("event_id", F.to_json(F.struct("*"), ingest.JSON_OPTIONS).alias("value"))
    cut = (F.pmod("event_id", F.lit(4)) == 2) & (F.pmod("event_id", F.lit(3)) == 0) | (F.pmod("event_id", F.lit(100)) == 1)
    source = _publish_parts(lines.withColumn("value", F.when(cut, F.expr("substring(value, 1, 9)")).otherwise(F.col("value"))), base, 4)
    gate = gates.Gate(keys=["event_id"], rules=[validate.Rule("negative_value", lambda: F.col("value") >= 0)], min_rows=10, max_bad_ratio=0.1)
    q = gates.gated_ingest(spark, source, f"{base}/sink", f"{base}/checkpoint", events.schema, gate, max_per_trigger=1)
    ingest.await_query(q)
    good = ingest.ingested(spark, f"{base}/sink", events.schema).select(F.lit("admitted").alias("place"))
    away = gates.quarantined(spark, f"{base}/sink").select(F.concat(F.lit("away: "), F.coalesce("fault", F.lit("batch"))).alias("place"))
    report = gates.gate_report(spark, f"{base}/sink").select(
        F.concat(F.lit("report: "), F.when(F.col("admitted"), "admitted").otherwise("diverted")).alias("place"))
    return good.unionByName(away).unionByName(report).groupBy("place").agg(F.count(F.lit(1)).alias("n"))


def q_ingest_unique(spark, sf_dir):
    """Events sent in three files, a third of them twice, arrive once."""
    events = td.table(spark, sf_dir, "events")
    base = scratch_path(spark, "unique")
    lines = events.select("event_id", F.to_json(F.struct("*"), ingest.JSON_OPTIONS).alias("value"))
    again = lines.filter("event_id % 3 = 0").withColumn("event_id", F.col("event_id") + 1)
    source = _publish_parts(lines.unionByName(again), base, 3)
    schema = StructType([f if f.name != "ts" else StructField("ts", TimestampType()) for f in events.schema.fields])
    q = ingest.ingest_unique(spark, source, f"{base}/sink", f"{base}/checkpoint", events.schema, ["event_id"], "ts", "3650 days", max_per_trigger=1)
    ingest.await_query(q)
    return spark.read.schema(schema).parquet(f"{base}/sink").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# -- cleaning jobs ------------------------------------------------------------

def q_weather_cleaned(spark, sf_dir):
    valid, _ = jobs.clean_weather(td.weather_obs(spark, sf_dir), td.stations(spark, sf_dir))
    return valid.drop("processing_time")


def q_co2_cleaned(spark, sf_dir):
    return co2_job(spark, sf_dir)[0].drop("processing_time")


# -- single operators that the jobs above contain -----------------------------

def q_country_top_day(spark, sf_dir):
    """the top day of one country."""
    t = cq.top_emission_day(td.emissions(spark, sf_dir), country="NATION_7")
    return t.select("date", "country", F.round("total_emission", 4).alias("total_emission"))


def q_processing_time(spark, sf_dir):
    e = cleaning.add_processing_time(td.emissions(spark, sf_dir).select("o_orderkey"), as_of=dt.datetime(2024, 5, 6, 7, 8, 9))
    return e.select("o_orderkey", F.date_format("processing_time", "yyyy-MM-dd HH:mm:ss").alias("processing_time"))


def q_mode_value_fill(spark, sf_dir):
    e = impute.mode_fill(td.emissions(spark, sf_dir).select("o_orderkey", "sector", "country"), ["sector"])
    return impute.value_fill(e, {"country": "nowhere"})


def q_string_date_documents(spark, sf_dir):
    """Text that looks like a date stays as it is, timestamps become ISO text."""
    d = respelled_order_dates(spark, sf_dir).join(td.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"),
                                                  "o_orderkey")
    return documents.country_documents(d.withColumnRenamed("raw_date", "date")).select("o_orderkey", "date", "o_orderdate")


def q_timestamp_weather_cleaned(spark, sf_dir):
    """The weather job on timestamp dates gives what it gives on dates."""
    raw = td.weather_obs(spark, sf_dir).withColumn("date", F.col("date").cast("timestamp"))
    valid, _ = jobs.clean_weather(raw, td.stations(spark, sf_dir))
    return valid.drop("processing_time")


def q_csv_round_trip(spark, sf_dir):
    """The city dimension written as CSV and read with its schema."""
    path = f"{scratch_path(spark, 'csv')}/stations.csv"
    s = td.stations(spark, sf_dir)
    s.select("station_id", "city_name", "country", "iso3", "latitude", "longitude").write.option(
        "header", "true").csv(path)
    schema = "station_id string, city_name string, country string, iso3 string, latitude double, longitude double"
    return readers.read_many(spark, [("stations", path), ("none", None)], {"stations": schema})["stations"]


def q_raw_feed_round_trip(spark, sf_dir):
    """The raw weather feed as CSV, read with its schema, written by the cleaned-table sink and read again."""
    base = scratch_path(spark, "feed")
    w = td.weather_obs(spark, sf_dir)
    have = [f.name for f in WEATHER_RAW_SCHEMA.fields if f.name in w.columns]
    feed = w.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in WEATHER_RAW_SCHEMA.fields])
    feed.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(f"{base}/raw.csv")
    jobs.write_cleaned(readers.read_any(spark, f"{base}/raw.csv", WEATHER_RAW_SCHEMA), f"{base}/raw.parquet", files=4)
    return readers.read_any(spark, f"{base}/raw.parquet").select(*have)


def q_observation_timestamps(spark, sf_dir):
    """The stream's reading of a date text."""
    w = td.weather_obs(spark, sf_dir).withColumn("date", F.when(F.col("l_orderkey") % 19 == 0, "bad").otherwise(F.col("date").cast("string")))
    return w.select("l_orderkey", "l_linenumber", "l_partkey",
                    F.date_format(parse_iso_timestamp("date"), "yyyy-MM-dd HH:mm:ss").alias("observed"))


def q_cleaning_steps(spark, sf_dir):
    """Row counts after each step of the CO2 job and what its gates say."""
    valid, result = co2_job(spark, sf_dir)
    summary = result.check_gates()
    valid.write.format("noop").mode("overwrite").save()
    rows = [("step", k, float(v)) for k, v in jobs.step_counts(result.steps).items()]
    rows += [("gate", "final_count", summary["count.final_count"]), ("gate", "warnings", float(len(result.warnings)))]
    result.release(spark)
    return spark.createDataFrame(rows, "kind string, name string, value double")


def q_impute_average_only(spark, sf_dir):
    """With statistics for the average alone the bounds are filled by nothing."""
    w = impute.impute_temperatures(td.weather_obs(spark, sf_dir), mean_cols=("avg_temp_c", "precipitation_mm"))
    return w.select(*WEATHER_ID, *[F.round(c, 6).alias(c) for c in TEMPS])


# -- stored tables and states ---------------------------------------------------

def q_top_day_month_table(spark, sf_dir):
    """Q-A over a weather table in month folders, of which the winning day's month is read."""
    path = f"{scratch_path(spark, 'months')}/weather"
    jobs.write_cleaned(td.weather_obs(spark, sf_dir), path, by_month=True)
    return _top_day_rows(cq.top_emission_day_with_cities(td.emissions(spark, sf_dir), month_table.read_by_month(spark, path),
                                                         td.stations(spark, sf_dir)))


def q_emissions_upserted(spark, sf_dir):
    """Three loads into a keyed table, the second one twice: half without values, all, a revised hundredth."""
    path = f"{scratch_path(spark, 'keyed')}/emissions"
    e = td.emissions(spark, sf_dir)
    load = {"keys": ["o_orderkey"], "buckets": 32}
    keyed_table.upsert(e.filter("o_orderkey % 2 = 0").withColumn("MtCO2_per_day", F.lit(None).cast("double")), path, **load)
    for _ in range(2):
        keyed_table.upsert(e, path, batch_id="all", **load)
    keyed_table.upsert(e.filter("o_orderkey % 100 = 0").withColumn("sector", F.lit("revised")), path, **load)
    return keyed_table.read(spark, path)


def q_edges_upserted(spark, sf_dir):
    """Edges linked into a keyed table, then all of them twice over; those that are there are left alone."""
    path = f"{scratch_path(spark, 'keyed')}/on_date"
    e = graph.on_date(td.weather_obs(spark, sf_dir), keys=WEATHER_ID[:-1], merge_edges=True)
    graph.link_edges(e.filter("l_linenumber % 2 = 0"), path, e.columns, buckets=32)
    graph.link_edges(e.unionByName(e), path, e.columns)
    return keyed_table.read(spark, path)


def q_spi_from_state(spark, sf_dir):
    """The index from a stored state of the history and a batch that starts in the middle of its last month."""
    w = td.weather_obs(spark, sf_dir)
    new = F.coalesce(F.col("date") >= F.lit("1998-01-15").cast("date"), F.lit(False))
    history = materialize(spi_state.month_states(w.filter(~new)), "month-states")
    stations = materialize(spi_state.station_states(history), "station-states")
    months, states = spi_state.update(history, stations, materialize(spi_state.month_states(w.filter(new)), "batch-states"))
    return spi_state.spi(months, states)


def q_spi_bucketed(spark, sf_dir):
    """Facts and the index bucketed alike by station and month, joined without a shuffle."""
    base = scratch_path(spark, "bucketed")
    w = td.weather_obs(spark, sf_dir).filter("station_id IS NOT NULL AND date IS NOT NULL").withColumn("month", month_key("date"))
    facts = bucketed_table.write_bucketed(w.select(*WEATHER_ID, "month", "precipitation_mm"), f"{base}/facts", 8)
    rows = bucketed_table.read_bucketed(spark, facts)
    index = enrich.spi_table(rows).select("station_id", F.format_string("%04d-%02d", "__y", "__m").alias("month"), "spi_index")
    stats = bucketed_table.write_bucketed(index, f"{base}/index", 8)
    return bucketed_table.attach_month_stats(rows, bucketed_table.read_bucketed(spark, stats)).select(*WEATHER_ID, "spi_index")


def q_profile_merged(spark, sf_dir):
    """The profile of four batches of emissions, added up; ``distinct_near`` holds the sketch against a count."""
    e = td.emissions(spark, sf_dir)
    parts = [materialize(profile.column_profile(e.filter(F.pmod("o_orderkey", F.lit(4)) == k)), f"profile-{k}") for k in range(4)]
    report = profile.profile_report(profile.merge_profiles(*parts))
    exact = e.agg(*[F.count_distinct(c).alias(c) for c in e.columns]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("exact")) for c in e.columns])))
    return report.join(exact, "column_name").select(
        "column_name", "total_rows", "null_count", "nan_count", "min_number", "max_number", "min_text", "max_text", "completeness_pct",
        (F.abs(F.col("distinct_estimate") - F.col("exact")) <= 0.06 * F.col("exact")).alias("distinct_near"))


def q_before_after_cleaning(spark, sf_dir):
    """Raw weather against cleaned weather, histograms over shared cut points."""
    raw = td.weather_obs(spark, sf_dir)
    valid, _ = jobs.clean_weather(raw, td.stations(spark, sf_dir))
    c = compare.compare(raw, valid, [*TEMPS, "precipitation_mm"])
    return c.select("column_name", "rows_before", "rows_after", "nulls_before", "nulls_after", "distinct_before", "distinct_after", "distance",
                    F.posexplode(F.arrays_zip(F.col("histogram_before").alias("b"), F.col("histogram_after").alias("a"))).alias("bin", "h")).select(
        "*", F.col("h.b").alias("n_before"), F.col("h.a").alias("n_after")).drop("h")


def q_top_day_report(spark, sf_dir):
    """The report select of the top-day question."""
    return reports.top_day_report(cq.top_emission_day_with_cities(td.emissions(spark, sf_dir), td.weather_obs(spark, sf_dir),
                                                                  td.stations(spark, sf_dir)))


def q_monthly_report(spark, sf_dir):
    """The report select of the monthly question."""
    return reports.monthly_report(_monthly(spark, sf_dir, dedup_fanout=True))


def q_hot_cities_report(spark, sf_dir):
    """The report select of the hot-cities question, with its threshold and length given."""
    return reports.hot_cities_report(cq.hot_cities_vs_co2(td.weather_obs(spark, sf_dir), td.stations(spark, sf_dir),
                                                          td.countries(spark, sf_dir), td.emissions(spark, sf_dir), limit=7, hot_threshold=35.0))


def q_extreme_weather_report(spark, sf_dir):
    """The report select of the extreme-weather question."""
    r = cq.emission_vs_extreme_weather(scored_weather(spark, sf_dir), td.stations(spark, sf_dir), td.emissions(spark, sf_dir),
                                       temp_threshold=38.0, risk_levels=("CRITICAL",), limit=None)
    return reports.extreme_weather_report(r)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
