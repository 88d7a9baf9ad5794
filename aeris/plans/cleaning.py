"""The two cleaning jobs (Q-F weather, Q-G CO2).

Both are lazy chains of the operators in ``aeris.operators``:

    stamp -> drop columns -> scrub -> (weather: order filter) -> dedup ->
    drop null rows -> impute -> standardize -> enrich -> validate -> write

and return the valid rows together with a validation result whose report is
computed in two aggregate passes.  Nothing is collected except that report.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from aeris.functions.dates import as_date, parse_multi_format_date
from aeris.functions.numeric import EXACT, exact_avg, not_exact
from aeris.operators import cleaning, enrich, impute, validate
from aeris.operators.joins import attach_group_stats
from aeris.operators.validate import ReferenceCheck, ValidationResult, ValidationSpec
from aeris.session import materialize
from aeris.sources.schemas import CO2_REQUIRED, WEATHER_REQUIRED
from aeris.sources.month_table import write_by_month
from aeris.sources.readers import input_bytes

BYTES_PER_FILE = 256 << 20   # input that one task of a capped write takes, about


@dataclass(frozen=True)
class CleaningConfig:
    """Per-dataset cleaning rules (the upstream config object, frozen)."""

    primary_key: Sequence[str]
    remove_cols: Sequence[str] = ()
    mean_cols: Sequence[str] = ()
    median_cols: Sequence[str] = ()
    mode_cols: Sequence[str] = ()          # declared upstream, never applied (I7)
    value_fills: dict = field(default_factory=dict)  # declared upstream, never applied (I7)
    required_non_null: Sequence[str] = ()
    alpha_cols: Sequence[str] = ()
    double_cols: Sequence[str] = ()
    integer_cols: Sequence[str] = ()
    median_accuracy: int = impute.DEFAULT_ACCURACY
    apply_declared_fills: bool = False     # opt in to mode/value fills


# The shipped configurations of the two datasets.
WEATHER_CONFIG = CleaningConfig(
    primary_key=("station_id", "date"),
    alpha_cols=("season",),
    double_cols=("avg_temp_c", "min_temp_c", "max_temp_c", "precipitation_mm"),
    remove_cols=("snow_depth_mm", "avg_wind_dir_deg", "avg_wind_speed_kmh", "peak_wind_gust_kmh",
                 "avg_sea_level_pres_hpa", "sunshine_total_min"),
    required_non_null=("station_id", "date", "city_name", "precipitation_mm"),
    mean_cols=("avg_temp_c", "min_temp_c", "max_temp_c"),
    mode_cols=("season",),
)

CO2_CONFIG = CleaningConfig(
    primary_key=("country", "date", "sector"),
    alpha_cols=("sector",),
    double_cols=("MtCO2_per_day",),
    required_non_null=("country", "date", "sector"),
    median_cols=("MtCO2_per_day",),
)


def _prepare(df: DataFrame, config: CleaningConfig, as_of_time: _dt.datetime | None) -> DataFrame:
    out = cleaning.add_processing_time(df, as_of=as_of_time)
    out = cleaning.drop_columns(out, config.remove_cols)
    return cleaning.scrub_columns(out, config.alpha_cols, config.integer_cols, config.double_cols)


def _count_step(df: DataFrame, steps: dict[str, Observation], name: str) -> DataFrame:
    """Row count after a step (A16), collected by the next action without a job of its own."""
    obs = Observation(name)
    steps[name] = obs
    return df.observe(obs, F.count(F.lit(1)).alias("rows"))


def step_counts(steps: dict[str, Observation]) -> dict[str, int]:
    """Counts of the observed steps; call after an action has run on the job's output."""
    return {name: obs.get["rows"] for name, obs in steps.items()}


def _declared_fills(df: DataFrame, config: CleaningConfig) -> DataFrame:
    if not config.apply_declared_fills:
        return df
    return impute.value_fill(impute.mode_fill(df, config.mode_cols), config.value_fills)


def weather_spec(min_rows: int = 100, max_invalid_ratio: float = 0.02) -> ValidationSpec:
    return ValidationSpec(
        required=WEATHER_REQUIRED, keys=("station_id", "date"), dedup_keys=("station_id", "date"),
        rules=validate.weather_rules(), reference=ReferenceCheck("station_id"),
        min_rows=min_rows, max_invalid_ratio=max_invalid_ratio,
        recorded_issues=("duplicates", "referential_integrity"))


def co2_spec(floor: str = "2019-01-01", as_of: str | _dt.date | None = None, min_rows: int = 50,
             max_invalid_ratio: float = 0.05, standardize_reference: bool = True) -> ValidationSpec:
    transform = (lambda c: F.initcap(F.trim(c))) if standardize_reference else None
    return ValidationSpec(
        required=CO2_REQUIRED, keys=("country", "date", "sector"),
        dedup_keys=("country", "sector", "date"),
        rules=validate.co2_rules(floor=floor, as_of=as_of),
        reference=ReferenceCheck("country", transform=transform),
        min_rows=min_rows, max_invalid_ratio=max_invalid_ratio, min_countries=5, min_sectors=3)


def _dedup_survives_standardizing(raw: DataFrame, config: CleaningConfig, spec: ValidationSpec) -> bool:
    """True when the first dedup already makes the validation keys unique.

    That holds when validation dedups on the primary key, the date arrives as a
    DATE (standardising maps it to itself) and no other key column is
    rewritten.  A string date can gain duplicates when parsed (decision Q8).
    """
    keys = set(config.primary_key)
    rewritten = set(config.alpha_cols) | set(config.double_cols) | set(config.integer_cols) | {
        "city_name", "season"}
    return (set(spec.dedup_keys) == keys and "date" in raw.columns
            and isinstance(raw.schema["date"].dataType, DateType)
            and not (keys - {"date"}) & rewritten)


def _impute_and_standardize_fused(df: DataFrame, config: CleaningConfig, std: dict, hits: DataFrame | None = None) -> DataFrame:
    """Imputation (I1-I4) + standardising + SPI (W1-W4) from one station-month aggregate.

    Per (station, year, month of the standardised date) the aggregate keeps
    the exact decimal sum and count of each temperature column and the mean
    and row count of the standardised precipitation.  Windows by station over
    that small table give the station means (sum of sums / sum of counts, the
    same decimal division as an average) and the SPI.  One join brings both back
    to the rows.  ``hits`` (station keys as ``__ref_key``, with a ``__ref_hit``) is joined to the small table too, so the
    rows need no second join for the referential rule.
    """
    temps = [c for c in config.mean_cols if c in impute.TEMP_COLUMNS and c in df.columns]
    d = as_date(df, "date")
    keyed = df.withColumns({"__y": F.year(d), "__m": F.month(d)})
    aggs = [exact_avg(F.round(F.col("precipitation_mm").cast("double"), 1)).alias("__mavg"),
            F.count(F.lit(1)).alias("__n")]
    for c in temps:
        value = F.col(c).cast("double")
        aggs += [F.try_sum(value.try_cast(EXACT)).alias(f"__s_{c}"), F.sum(value).alias(f"__p_{c}"), F.count(c).alias(f"__c_{c}"),
                 F.count_if(not_exact(value)).alias(f"__o_{c}")]
    # a station's month has a row a day after the dedup, so nothing is gained by summing before the shuffle: the values
    # are smaller than the sums
    month = ["station_id", "__y", "__m"]
    monthly = keyed.select(*month, *temps, "precipitation_mm").repartition(*month).groupBy(*month).agg(*aggs)
    by_station = Window.partitionBy("station_id")
    # each sum is a column of its own: an expression that names it twice would have it summed twice
    totals = monthly.withColumns({f"__{f}_{c}": (F.try_sum if f == "s" else F.sum)(f"__{f}_{c}").over(by_station) for c in temps for f in "spco"})
    means = {}
    for c in temps:
        total, plain, count, outside = (F.col(f"__{f}_{c}") for f in "spco")
        mean = F.when(outside == 0, F.coalesce((total / count).cast("double"), plain / count)).otherwise(plain / count)
        means[f"__{c}_mean"] = F.when(count > 0, mean)
    stats = enrich.spi_from_monthly(totals.withColumns(means).drop(*[f"__{f}_{c}" for c in temps for f in "spco"])).select(
        "station_id", "__y", "__m", "spi_index", *means)
    if hits is not None:
        stats = stats.join(hits, stats["station_id"] == hits["__ref_key"], "left").drop("__ref_key")
    joined = attach_group_stats(keyed, stats, ["station_id", "__y", "__m"])
    filled = impute.fill_temperatures(joined, {c: F.col(f"__{c}_mean") for c in temps})
    filled = _declared_fills(filled.drop(*means, "__y", "__m"), config)
    return filled.withColumns(std)


def clean_weather(raw: DataFrame, stations: DataFrame | list | None = None,
                  config: CleaningConfig = WEATHER_CONFIG, as_of_time: _dt.datetime | None = None,
                  spec: ValidationSpec | None = None, materialize_stage: bool = True,
                  fuse_statistics: bool = True) -> tuple[DataFrame, ValidationResult]:
    """Weather cleaning job (Q-F).

    With ``materialize_stage`` the deduplicated rows are written to the shared
    checkpoint folder once; the statistics and the output read that table
    instead of repeating the dedup shuffle.  With ``fuse_statistics`` the
    station means (imputation) and the SPI come from one station-month
    aggregate and reach the rows through one join.
    """
    steps: dict[str, Observation] = {}
    scratch: list[str] = []
    out = _count_step(_prepare(raw, config, as_of_time), steps, "weather_input")
    out = _count_step(cleaning.filter_temp_order(out), steps, "weather_after_order_filter")
    out = _count_step(cleaning.dedup_by_key(out, config.primary_key), steps, "weather_after_dedup")
    out = _count_step(cleaning.drop_null_rows(out, config.required_non_null), steps,
                      "weather_after_null_drop")
    if materialize_stage:
        out = materialize(out, "weather-dedup", scratch)
    std = {}
    if "date" in out.columns:
        std["date"] = as_date(out, "date")
    for c in ("city_name", "season"):
        if c in out.columns:
            std[c] = F.initcap(F.trim(F.col(c)))
    for c in config.double_cols:
        if c in out.columns:
            std[c] = F.round(F.col(c).cast("double"), 1)
    spec = spec or weather_spec()
    if fuse_statistics and not config.median_cols and {"station_id", "date", "precipitation_mm"} <= set(out.columns):
        hits = None
        if isinstance(stations, DataFrame) and spec.reference is not None and spec.reference.column == "station_id":
            hits = validate.reference_hits(out, spec.reference, stations)
            spec = dataclasses.replace(spec, reference=dataclasses.replace(spec.reference, hit="__ref_hit"))
        out = _impute_and_standardize_fused(out, config, std, hits)
    else:
        out = impute.impute_temperatures(out, mean_cols=config.mean_cols, median_cols=config.median_cols,
                                         accuracy=config.median_accuracy, paths=scratch)
        out = _declared_fills(out, config)
        out = enrich.add_spi_index(out.withColumns(std))
    out = enrich.add_risk_scores(enrich.add_weather_attributes(out))
    out = out.select(*[c for c in out.columns if c not in ("spi_index", "climate_risk_score",
                                                            "climate_risk_level")],
                     "spi_index", "climate_risk_score", "climate_risk_level")
    # counted here, the finished columns are computed once: filters on them would else be rewritten in terms of the raw ones
    out = out.observe("weather_standardized", F.count(F.lit(1)).alias("rows"))
    if _dedup_survives_standardizing(raw, config, spec):
        spec = dataclasses.replace(spec, keys_unique=True)
    result = validate.validate(out, spec, stations)
    result.steps, result.scratch = steps, scratch
    return result.valid, result


def clean_co2(raw: DataFrame, countries: DataFrame | list | None = None,
              config: CleaningConfig = CO2_CONFIG, as_of_time: _dt.datetime | None = None,
              spec: ValidationSpec | None = None,
              materialize_stage: bool = True) -> tuple[DataFrame, ValidationResult]:
    """CO2 cleaning job (Q-G); ``materialize_stage`` as in ``clean_weather``."""
    steps: dict[str, Observation] = {}
    scratch: list[str] = []
    out = _count_step(_prepare(raw, config, as_of_time), steps, "co2_input")
    out = _count_step(cleaning.dedup_by_key(out, config.primary_key), steps, "co2_after_dedup")
    out = _count_step(cleaning.drop_null_rows(out, config.required_non_null), steps, "co2_after_null_drop")
    if materialize_stage:
        out = materialize(out, "co2-dedup", scratch)
    out = impute.global_median_fill(out, config.median_cols, config.median_accuracy)
    out = _declared_fills(out, config)
    std = {}
    if "date" in out.columns:
        std["date"] = as_date(out, "date", parse_multi_format_date)
    for c in ("country", "sector"):
        if c in out.columns:
            std[c] = F.initcap(F.trim(F.col(c)))
    for c in config.double_cols:
        if c in out.columns:
            std[c] = F.round(F.col(c), 6)
    out = enrich.enrich_emissions(out.withColumns(std))
    result = validate.validate(out, spec or co2_spec(), countries,
                               metrics=validate.co2_report_metrics())
    result.steps, result.scratch = steps, scratch
    return result.valid, result


def write_cleaned(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None,
                  compression: str = "gzip", by_month: bool = False) -> None:
    """Cleaned-table sink (S12): compressed parquet, optionally capped file count, or in month folders.

    ``files=None`` lets AQE size the output (one file per shuffle partition);
    a cap goes through ``coalesce`` so it adds no shuffle.  It holds while a file is made of ``BYTES_PER_FILE`` of input
    at most; larger tables get more files, so that no task's share grows with the table.  ``by_month`` is for tables that are asked by day or month
    (``month_table``); read them with ``read_by_month``.
    """
    if by_month:
        write_by_month(df, path, mode=mode, compression=compression)
        return
    out = df.coalesce(max(files, math.ceil(input_bytes(df) / BYTES_PER_FILE))) if files else df
    out.write.mode(mode).option("compression", compression).parquet(path)
