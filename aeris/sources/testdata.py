"""Climate-shaped views over the driver's TPC-H-style test tables.

The driver ships no weather or emission data, so the four climate inputs are
derived from its tables.  The same derivations are written as SQL in
``oracle_queries.py`` so DuckDB computes the identical input.

weather_obs   one row per lineitem: station = supplier, observation date =
              ship date, temperatures from quantity/tax/discount, precipitation
              from discount x quantity.
emissions     one row per order: country = customer nation, sector = market
              segment or a real sector name, emission = total price / 10 000.
stations      supplier + nation (the city dimension).
countries     nation + region (the country dimension).

Faults are injected by order key, so that every cleaning and validation rule
finds some: null and unknown keys, implausible temperatures, negative rain and
emissions, emissions above the ceiling, cities that no dimension knows, null,
blank, padded and differently written labels, stations with constant rain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (projections and filters reach the parquet scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso3(nationkey: Column) -> Column:
    return F.concat(F.lit("N"), F.lpad(nationkey.cast("string"), 2, "0"))


def _season(ts: Column) -> Column:
    m = F.month(ts)
    return (F.when(m.isin(12, 1, 2), "winter")
            .when(m.isin(3, 4, 5), "spring")
            .when(m.isin(6, 7, 8), "summer")
            .otherwise("autumn"))


def weather_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    q, tax, disc, key = F.col("l_quantity"), F.col("l_tax"), F.col("l_discount"), F.col("l_orderkey")
    supp = F.col("l_suppkey")
    hot = key % 101 == 0   # in order, but above any plausible average
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(key % 97 == 0, F.lit(None)).when(key % 89 == 0, F.concat(F.lit("D"), supp.cast("string")))
         .otherwise(supp.cast("string")).alias("station_id"),
        F.when(key % 113 == 0, F.lit(None)).when(key % 83 == 0, F.lit(" old harbour-town "))
         .otherwise(F.concat(F.lit("Supplier#"), F.lpad(supp.cast("string"), 9, "0"))).alias("city_name"),
        F.col("l_shipdate").cast("date").alias("date"),
        _season(F.col("l_shipdate")).alias("season"),
        F.when(hot, F.lit(75.0)).when(key % 13 == 0, F.lit(None)).otherwise(q - 10).alias("avg_temp_c"),
        F.when(hot, F.lit(70.0)).when(key % 11 == 0, F.lit(None))
         .when((F.col("l_returnflag") == "R") & (tax > 0.06), q - 10 + tax * 100)
         .otherwise(q - 10 - tax * 100).alias("min_temp_c"),
        F.when(hot, F.lit(80.0)).when(key % 7 == 0, F.lit(None)).otherwise(q - 10 + disc * 100).alias("max_temp_c"),
        F.when(supp % 50 == 7, F.lit(5.0)).when(key % 107 == 0, F.lit(None)).when(key % 103 == 0, F.lit(-1.5))
         .otherwise(F.round(disc * q * 12, 1)).alias("precipitation_mm"),
    )


def _sector(key: Column, segment: Column) -> Column:
    return (F.when(key % 109 == 0, F.lit(None)).when(key % 107 == 0, F.lit("  "))
            .when(key % 113 == 0, F.lit(" ground transport ")).when(key % 16 == 0, F.lit("POWER"))
            .when(key % 8 == 0, F.lit("power")).when(key % 8 == 1, F.lit("Industry")).when(key % 8 == 2, F.lit("aviation"))
            .when(key % 8 == 3, F.lit("residential")).otherwise(segment))


def emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    key = F.col("o_orderkey")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            "o_orderkey",
            F.when(key % 127 == 0, F.lit(None)).when(key % 131 == 0, F.lit("lost atlantis"))
             .otherwise(F.col("n_name")).alias("country"),
            F.col("o_orderdate").cast("date").alias("date"),
            _sector(key, F.col("c_mktsegment")).alias("sector"),
            F.when(key % 17 == 0, F.lit(None)).when(key % 103 == 0, F.lit(-3.0)).when(key % 101 == 0, F.lit(2500.0))
             .when(key % 59 == 0, F.lit(0.0)).when(key % 61 == 0, F.lit(0.05))
             .otherwise(F.col("o_totalprice") / 10000).alias("MtCO2_per_day"),
        )
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("city_name"),
        F.col("n_name").alias("country"),
        _iso3(F.col("n_nationkey")).alias("iso3"),
        (F.col("s_acctbal") / 200).alias("latitude"),
        (F.col("n_nationkey") * 7.0).alias("longitude"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("country"),
        _iso3(F.col("n_nationkey")).alias("iso3"),
        F.concat(F.col("n_name"), F.lit("_CAPITAL")).alias("capital"),
        (F.col("n_nationkey") * 3.5 - 40).alias("capital_lat"),
        (F.col("n_regionkey") * 60.0 - 150).alias("capital_lng"),
        F.col("r_name").alias("region"),
    )
