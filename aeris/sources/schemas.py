"""Fixed schemas of the climate feeds and their dimensions."""

from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

# Field names and types of the two raw feeds and two dimensions.
WEATHER_RAW_SCHEMA = StructType(
    [
        StructField("station_id", StringType(), True),
        StructField("city_name", StringType(), True),
        StructField("date", StringType(), True),
        StructField("season", StringType(), True),
        StructField("avg_temp_c", DoubleType(), True),
        StructField("min_temp_c", DoubleType(), True),
        StructField("max_temp_c", DoubleType(), True),
        StructField("precipitation_mm", DoubleType(), True),
        StructField("snow_depth_mm", DoubleType(), True),
        StructField("avg_wind_dir_deg", DoubleType(), True),
        StructField("avg_wind_speed_kmh", DoubleType(), True),
        StructField("peak_wind_gust_kmh", DoubleType(), True),
        StructField("avg_sea_level_pres_hpa", DoubleType(), True),
        StructField("sunshine_total_min", DoubleType(), True),
    ]
)

CO2_RAW_SCHEMA = StructType(
    [
        StructField("country", StringType(), True),
        StructField("date", StringType(), True),
        StructField("sector", StringType(), True),
        StructField("MtCO2_per_day", DoubleType(), True),
    ]
)

# What cleaning makes of the feeds: a date for its text, and the derived columns.
WEATHER_CLEAN_SCHEMA = StructType(
    [f if f.name != "date" else StructField("date", DateType()) for f in WEATHER_RAW_SCHEMA.fields]
    + [StructField(c, DoubleType()) for c in ("temp_range_c", "spi_index", "climate_risk_score")]
    + [StructField(c, StringType()) for c in ("temp_category", "precipitation_category", "climate_risk_level")]
)

CO2_CLEAN_SCHEMA = StructType(
    [f if f.name != "date" else StructField("date", DateType()) for f in CO2_RAW_SCHEMA.fields]
    + [StructField(c, StringType()) for c in ("emission_level", "sector_category")]
)

CITY_SCHEMA = StructType(
    [
        StructField("station_id", StringType(), True),
        StructField("city_name", StringType(), True),
        StructField("country", StringType(), True),
        StructField("state", StringType(), True),
        StructField("iso2", StringType(), True),
        StructField("iso3", StringType(), True),
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
    ]
)

COUNTRY_SCHEMA = StructType(
    [
        StructField("country", StringType(), True),
        StructField("native_name", StringType(), True),
        StructField("iso2", StringType(), True),
        StructField("iso3", StringType(), True),
        StructField("population", DoubleType(), True),
        StructField("area", DoubleType(), True),
        StructField("capital", StringType(), True),
        StructField("capital_lat", DoubleType(), True),
        StructField("capital_lng", DoubleType(), True),
        StructField("region", StringType(), True),
        StructField("continent", StringType(), True),
    ]
)

# Columns the cleaned weather table must carry before validation (V1).
WEATHER_REQUIRED = [
    "station_id", "city_name", "date", "season",
    "avg_temp_c", "min_temp_c", "max_temp_c", "precipitation_mm",
]
CO2_REQUIRED = ["country", "sector", "date", "MtCO2_per_day"]
