"""DuckDB oracle SQL for every registered query that SQL can express.

Each string runs in DuckDB over the driver's pre-registered views (lineitem,
orders, customer, supplier, nation, region, events, ...).  The climate
inputs are re-derived in SQL with the same rules as ``aeris.sources.testdata``.

Rounding: Spark rounds a double half-up on its shortest decimal form
(1.005 -> 1.01) while DuckDB rounds the binary value (1.005 -> 1.0), so the
oracle rounds through DECIMAL(38,12) first (``rnd``).  DuckDB has no
``initcap``; ``initcap1`` builds it word by word (words end at a blank).
"""

from __future__ import annotations


def rnd(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def xavg(expr: str) -> str:
    """Exact (order-independent) average, as aeris.functions.numeric.exact_avg."""
    return f"CAST(avg(CAST(({expr}) AS DECIMAL(38,12))) AS DOUBLE)"


def xsum(expr: str) -> str:
    """Exact (order-independent) sum, as aeris.functions.numeric.exact_sum."""
    return f"CAST(sum(CAST(({expr}) AS DECIMAL(38,12))) AS DOUBLE)"


def initcap1(expr: str) -> str:
    return (f"array_to_string(list_transform(string_split(({expr}), ' '), "
            "lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), ' ')")


ALPHA_RE = "[^a-zA-Z\\s\\-''·\\.]"  # same class as aeris.functions.scrub.ALPHA_PATTERN

WEATHER_OBS = f"""
weather_obs AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN 'D' || l_suppkey ELSE CAST(l_suppkey AS VARCHAR) END AS station_id,
    CASE WHEN l_orderkey % 113 = 0 THEN NULL WHEN l_orderkey % 83 = 0 THEN ' old harbour-town '
         ELSE 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') END AS city_name,
    CAST(l_shipdate AS DATE) AS date,
    CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 'winter'
         WHEN month(l_shipdate) IN (3, 4, 5) THEN 'spring'
         WHEN month(l_shipdate) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
    CASE WHEN l_orderkey % 101 = 0 THEN 75.0 WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_quantity - 10 END AS avg_temp_c,
    CASE WHEN l_orderkey % 101 = 0 THEN 70.0 WHEN l_orderkey % 11 = 0 THEN NULL
         WHEN l_returnflag = 'R' AND l_tax > 0.06 THEN l_quantity - 10 + l_tax * 100
         ELSE l_quantity - 10 - l_tax * 100 END AS min_temp_c,
    CASE WHEN l_orderkey % 101 = 0 THEN 80.0 WHEN l_orderkey % 7 = 0 THEN NULL
         ELSE l_quantity - 10 + l_discount * 100 END AS max_temp_c,
    CASE WHEN l_suppkey % 50 = 7 THEN 5.0 WHEN l_orderkey % 107 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN -1.5
         ELSE {rnd('l_discount * l_quantity * 12', 1)} END AS precipitation_mm
  FROM lineitem
)"""

EMISSIONS = """
emissions AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 127 = 0 THEN NULL WHEN o_orderkey % 131 = 0 THEN 'lost atlantis' ELSE n_name END AS country,
    CAST(o_orderdate AS DATE) AS date,
    CASE WHEN o_orderkey % 109 = 0 THEN NULL WHEN o_orderkey % 107 = 0 THEN '  '
         WHEN o_orderkey % 113 = 0 THEN ' ground transport ' WHEN o_orderkey % 16 = 0 THEN 'POWER'
         WHEN o_orderkey % 8 = 0 THEN 'power' WHEN o_orderkey % 8 = 1 THEN 'Industry' WHEN o_orderkey % 8 = 2 THEN 'aviation'
         WHEN o_orderkey % 8 = 3 THEN 'residential' ELSE c_mktsegment END AS sector,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN -3.0 WHEN o_orderkey % 101 = 0 THEN 2500.0
         WHEN o_orderkey % 59 = 0 THEN 0.0 WHEN o_orderkey % 61 = 0 THEN 0.05
         ELSE o_totalprice / 10000 END AS MtCO2_per_day
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

STATIONS = """
stations AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS city_name, n_name AS country,
    'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso3,
    s_acctbal / 200 AS latitude, CAST(n_nationkey AS DOUBLE) * 7.0 AS longitude
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

COUNTRIES = """
countries AS (
  SELECT n_name AS country, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso3,
    n_name || '_CAPITAL' AS capital, CAST(n_nationkey AS DOUBLE) * 3.5 - 40 AS capital_lat,
    CAST(n_regionkey AS DOUBLE) * 60.0 - 150 AS capital_lng, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def spi_cte(src: str, name: str = "spi") -> str:
    """Window form of W1-W4 over ``src`` (adds spi_index)."""
    return f"""
{name}_w1 AS (
  SELECT *, avg(precipitation_mm) OVER (PARTITION BY station_id, year(date), month(date)) AS mavg FROM {src}
),
{name}_w2 AS (
  SELECT *, avg(mavg) OVER (PARTITION BY station_id) AS pmean,
            stddev_samp(mavg) OVER (PARTITION BY station_id) AS pstd FROM {name}_w1
),
{name} AS (
  SELECT * EXCLUDE (mavg, pmean, pstd),
    CASE WHEN pstd IS NULL OR pstd = 0 THEN NULL ELSE {rnd('(mavg - pmean) / pstd', 1)} END AS spi_index
  FROM {name}_w2
)"""


RISK_SCORE = rnd(
    "(CASE WHEN max_temp_c > 35 THEN 3 WHEN max_temp_c > 30 THEN 2 WHEN min_temp_c < -10 THEN 2 "
    "WHEN min_temp_c < 0 THEN 1 ELSE 0 END) * 0.5 + "
    "(CASE WHEN precipitation_mm > 50 THEN 3 WHEN precipitation_mm > 25 THEN 2 "
    "WHEN precipitation_mm = 0 THEN 1 ELSE 0 END) * 0.3 + "
    "(CASE WHEN abs(spi_index) >= 2.0 THEN 3 WHEN abs(spi_index) >= 1.5 THEN 2 "
    "WHEN abs(spi_index) >= 1.0 THEN 1 ELSE 0 END) * 0.2", 2)

RISK_LEVEL = ("CASE WHEN climate_risk_score >= 2.5 THEN 'CRITICAL' WHEN climate_risk_score >= 1.5 THEN 'HIGH' "
              "WHEN climate_risk_score >= 0.5 THEN 'MODERATE' ELSE 'LOW' END")

TEMP_RANGE = (f"CASE WHEN max_temp_c IS NULL OR min_temp_c IS NULL THEN NULL "
              f"ELSE {rnd('greatest(max_temp_c, min_temp_c) - least(max_temp_c, min_temp_c)', 1)} END")
TEMP_CATEGORY = ("CASE WHEN avg_temp_c IS NULL THEN NULL WHEN avg_temp_c < 0 THEN 'Freezing' "
                 "WHEN avg_temp_c < 10 THEN 'Cold' WHEN avg_temp_c < 20 THEN 'Mild' "
                 "WHEN avg_temp_c < 30 THEN 'Warm' ELSE 'Hot' END")
PRECIP_CATEGORY = ("CASE WHEN precipitation_mm IS NULL THEN NULL WHEN precipitation_mm <= 0 THEN 'No Rain' "
                   "WHEN precipitation_mm < 2.5 THEN 'Light Rain' WHEN precipitation_mm < 10 THEN 'Moderate Rain' "
                   "WHEN precipitation_mm < 50 THEN 'Heavy Rain' ELSE 'Very Heavy Rain' END")
EMISSION_LEVEL = ("CASE WHEN MtCO2_per_day = 0 THEN 'Zero' WHEN MtCO2_per_day < 0.1 THEN 'Very Low' "
                  "WHEN MtCO2_per_day < 1 THEN 'Low' WHEN MtCO2_per_day < 10 THEN 'Medium' "
                  "WHEN MtCO2_per_day < 50 THEN 'High' ELSE 'Very High' END")
SECTOR_CATEGORY = ("CASE WHEN lower(sector) IN ('power', 'electricity', 'energy') THEN 'Energy' "
                   "WHEN lower(sector) IN ('transport', 'aviation', 'shipping') THEN 'Transportation' "
                   "WHEN lower(sector) IN ('industry', 'manufacturing') THEN 'Industrial' "
                   "WHEN lower(sector) IN ('residential', 'commercial') THEN 'Buildings' ELSE 'Other' END")


def scored_weather_cte(src: str = "weather_obs", name: str = "scored") -> str:
    """Range, categories, SPI and risk over ``src`` (enrich_weather)."""
    return f"""
{name}_a AS (
  SELECT *, {TEMP_RANGE} AS temp_range_c, {TEMP_CATEGORY} AS temp_category,
    {PRECIP_CATEGORY} AS precipitation_category FROM {src}
),{spi_cte(f'{name}_a', f'{name}_s')},
{name}_r AS (SELECT *, {RISK_SCORE} AS climate_risk_score FROM {name}_s),
{name} AS (SELECT *, {RISK_LEVEL} AS climate_risk_level FROM {name}_r)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def vulnerability_sql(scored: str) -> str:
    pct = lambda n: f"{rnd(f'CASE WHEN events > 0 THEN CAST({n} AS DOUBLE) / events * 100.0 ELSE 0.0 END', 2)}"
    return f"""
dim AS (
  SELECT city_name, country FROM (
    SELECT {initcap1('trim(city_name)')} AS city_name, country,
      row_number() OVER (PARTITION BY {initcap1('trim(city_name)')} ORDER BY (country IS NULL)::INT, station_id, country) AS rn
    FROM stations WHERE {initcap1('trim(city_name)')} IS NOT NULL) WHERE rn = 1
),
labelled AS (
  SELECT s.*, coalesce(d.country, 'Unknown') AS country FROM {scored} s LEFT JOIN dim d ON s.city_name = d.city_name
),
grouped AS (
  SELECT country, {rnd(xavg('climate_risk_score'), 2)} AS avg_risk_score,
    max(climate_risk_score) AS max_risk_score, min(climate_risk_score) AS min_risk_score,
    CAST(count_if(climate_risk_level = 'LOW') AS BIGINT) AS low_cnt,
    CAST(count_if(climate_risk_level = 'MODERATE') AS BIGINT) AS moderate_cnt,
    CAST(count_if(climate_risk_level = 'HIGH') AS BIGINT) AS high_cnt,
    CAST(count_if(climate_risk_level = 'CRITICAL') AS BIGINT) AS critical_cnt,
    count(*) AS events
  FROM labelled GROUP BY country
),
metrics AS (
  SELECT *, {pct('low_cnt')} AS pct_low, {pct('moderate_cnt')} AS pct_moderate, {pct('high_cnt')} AS pct_high,
    {pct('critical_cnt')} AS pct_critical, {pct('high_cnt + critical_cnt')} AS pct_worst,
    {rnd('(high_cnt + critical_cnt) / events', 2)} AS high_risk_days_ratio
  FROM grouped
),
indexed AS (
  SELECT *, {rnd('high_risk_days_ratio * 0.6 + avg_risk_score / 10 * 0.4', 2)} AS climate_vulnerability_index FROM metrics
)
SELECT country, avg_risk_score, max_risk_score, min_risk_score, low_cnt, moderate_cnt, high_cnt, critical_cnt,
  events, pct_low, pct_moderate, pct_high, pct_critical, pct_worst, high_risk_days_ratio,
  climate_vulnerability_index,
  CASE WHEN climate_vulnerability_index > 0.7 THEN 'EXTREME' WHEN climate_vulnerability_index > 0.5 THEN 'HIGH'
       WHEN climate_vulnerability_index > 0.3 THEN 'MODERATE' ELSE 'LOW' END AS vulnerability_category
FROM indexed"""


WEATHER_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "station_id", "city_name", "date", "season",
                "avg_temp_c", "min_temp_c", "max_temp_c", "precipitation_mm"]
SCORED_EXTRA = ["temp_range_c", "temp_category", "precipitation_category", "spi_index",
                "climate_risk_score", "climate_risk_level"]
WID = "l_orderkey, l_linenumber, l_partkey, station_id, date"
TEMPS = "avg_temp_c, min_temp_c, max_temp_c"
F2 = ("(min_temp_c IS NULL OR avg_temp_c IS NULL OR max_temp_c IS NULL "
      "OR (min_temp_c <= avg_temp_c AND avg_temp_c <= max_temp_c))")


def dedup_cte(name: str, src: str, keys: list[str], cols: list[str]) -> str:
    """Survivor = fewest nulls outside the key, then smallest in the remaining columns, nulls last."""
    rest = [c for c in cols if c not in keys]
    order = ", ".join([" + ".join(f"({c} IS NULL)::INT" for c in rest), *[f"{c} NULLS LAST" for c in rest]])
    return f"""
{name} AS (
  SELECT * EXCLUDE (__rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS __rn FROM {src})
  WHERE __rn = 1
)"""


def impute_ctes(src: str, name: str = "imp") -> str:
    i1 = ("CASE WHEN avg_temp_c IS NULL AND min_temp_c IS NOT NULL AND max_temp_c IS NOT NULL THEN "
          "(CASE WHEN pavg >= min_temp_c AND pavg <= max_temp_c THEN pavg ELSE (min_temp_c + max_temp_c) / 2 END) "
          "WHEN avg_temp_c IS NULL AND min_temp_c IS NOT NULL AND max_temp_c IS NULL THEN greatest(pavg, min_temp_c) "
          "WHEN avg_temp_c IS NULL AND min_temp_c IS NULL AND max_temp_c IS NOT NULL THEN least(pavg, max_temp_c) "
          "WHEN avg_temp_c IS NULL THEN pavg ELSE avg_temp_c END")
    i2 = ("CASE WHEN min_temp_c IS NULL AND avg_temp_c IS NOT NULL THEN least(pmin, avg_temp_c) "
          "WHEN min_temp_c IS NULL AND max_temp_c IS NOT NULL THEN least(pmin, max_temp_c) "
          "WHEN min_temp_c IS NULL THEN pmin ELSE min_temp_c END")
    i3 = ("CASE WHEN max_temp_c IS NULL AND avg_temp_c IS NOT NULL THEN greatest(pmax, avg_temp_c) "
          "WHEN max_temp_c IS NULL AND min_temp_c IS NOT NULL THEN greatest(pmax, min_temp_c) "
          "WHEN max_temp_c IS NULL THEN pmax ELSE max_temp_c END")
    return f"""
{name}_st AS (
  SELECT station_id AS st_id, {xavg('avg_temp_c')} AS pavg, {xavg('min_temp_c')} AS pmin, {xavg('max_temp_c')} AS pmax
  FROM {src} GROUP BY station_id
),
{name}_1 AS (SELECT s.*, t.pavg, t.pmin, t.pmax FROM {src} s LEFT JOIN {name}_st t
             ON s.station_id IS NOT DISTINCT FROM t.st_id),
{name}_2 AS (SELECT * REPLACE ({i1} AS avg_temp_c) FROM {name}_1),
{name}_3 AS (SELECT * REPLACE ({i2} AS min_temp_c) FROM {name}_2),
{name}_4 AS (SELECT * REPLACE ({i3} AS max_temp_c) FROM {name}_3),
{name} AS (
  SELECT * EXCLUDE (pavg, pmin, pmax) REPLACE (
    CASE WHEN min_temp_c IS NOT NULL AND avg_temp_c IS NOT NULL AND min_temp_c > avg_temp_c
         THEN avg_temp_c ELSE min_temp_c END AS min_temp_c,
    CASE WHEN max_temp_c IS NOT NULL AND avg_temp_c IS NOT NULL AND max_temp_c < avg_temp_c
         THEN avg_temp_c ELSE max_temp_c END AS max_temp_c)
  FROM {name}_4
)"""


def union_long(rows: list[tuple[str, str, str]], src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{sec}' AS section, '{item}' AS item, CAST({expr} AS DOUBLE) AS value FROM {src}"
        for sec, item, expr in rows)


def null_rows(cols: list[str], src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT 'null_count' AS section, '{c}' AS item, CAST(count(*) - count({c}) AS DOUBLE) AS value FROM {src}"
        for c in cols)


def report_sql(src: str, keys: list[str], dedup_keys: list[str], cols: list[str],
               rules: list[tuple[str, str]], ref: tuple[str, str] | None, metrics: list[tuple[str, str]] = ()) -> tuple[str, str]:
    """CTEs for validation over ``src`` -> (ctes, final SELECT of the long report); also defines v_valid."""
    key_ok = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    flag = "CASE " + " ".join(f"WHEN NOT coalesce({cond}, false) THEN '{n}'" for n, cond in rules)
    if ref:
        flag += f" WHEN NOT coalesce({ref[0]} IN (SELECT {ref[1]} FROM v_refkeys), false) THEN 'referential_integrity'"
    flag += " END"
    names = [n for n, _ in rules] + (["referential_integrity"] if ref else [])
    ctes = f"""
v_keyed AS (SELECT * FROM {src} WHERE {key_ok}),{dedup_cte('v_dedup', 'v_keyed', dedup_keys, cols)},
v_refkeys AS (SELECT DISTINCT {ref[1] if ref else 'NULL AS k'} FROM {ref[2] if ref and len(ref) > 2 else 'v_keyed'}),
v_flag AS (SELECT *, {flag} AS first_failed_rule FROM v_dedup),
v_valid AS (SELECT * EXCLUDE (first_failed_rule) FROM v_flag WHERE first_failed_rule IS NULL),
v_before AS (SELECT count(*) AS initial_count, count_if({key_ok}) AS non_null_keys FROM {src}),
v_counts AS (SELECT count(*) AS after_dedup, count_if(first_failed_rule IS NULL) AS final_count,
  {', '.join(f"count_if(first_failed_rule = '{n}') AS rule_{i}" for i, n in enumerate(names))} FROM v_flag),
v_one AS (SELECT * FROM v_before, v_counts)"""
    rows = [("count", "initial_count", "initial_count"), ("issue", "null_keys", "initial_count - non_null_keys"),
            ("issue", "duplicates", "non_null_keys - after_dedup")]
    rows += [("issue", n, f"rule_{i}") for i, n in enumerate(names)]
    rows += [("count", "final_count", "final_count"),
             ("count", "drop_ratio", "CASE WHEN initial_count > 0 THEN (initial_count - final_count) / initial_count ELSE 0 END")]
    body = union_long(rows, "v_one")
    if metrics:
        body += " UNION ALL " + union_long([("metric", n, e) for n, e in metrics], "v_valid")
    body += " UNION ALL " + null_rows(cols, src)
    return ctes, f"SELECT section, item, {rnd('value', 6)} AS value FROM ({body})"


WEATHER_RULES = [
    ("temperature_logic", F2),
    ("temperature_range", "avg_temp_c IS NULL OR (avg_temp_c >= -60 AND avg_temp_c <= 60)"),
    ("negative_precipitation", "precipitation_mm IS NULL OR precipitation_mm >= 0"),
]


def co2_rules(floor: str, as_of: str) -> list[tuple[str, str]]:
    return [
        ("negative_emissions", "MtCO2_per_day IS NULL OR MtCO2_per_day >= 0"),
        ("unrealistic_emissions", "MtCO2_per_day IS NULL OR MtCO2_per_day <= 1000"),
        ("invalid_dates", f"date IS NULL OR (date >= DATE '{floor}' AND date <= DATE '{as_of}')"),
        ("empty_country_sector", "country IS NOT NULL AND length(country) > 0 AND sector IS NOT NULL AND length(sector) > 0"),
    ]


CO2_FLOOR, CO2_AS_OF = "1996-01-01", "2001-06-30"
EMISSION_COLS = ["o_orderkey", "country", "date", "sector", "MtCO2_per_day"]


def co2_job_ctes() -> tuple[str, str]:
    """Q-G over emissions: scrub, dedup, null keys, median fill, standardise, enrich, validate."""
    ctes = f"""
c_scrub AS (SELECT o_orderkey, country, date, regexp_replace(sector, '{ALPHA_RE}', '', 'g') AS sector,
            MtCO2_per_day FROM emissions),{dedup_cte('c_dedup', 'c_scrub', ['country', 'date', 'sector'], EMISSION_COLS)},
c_keys AS (SELECT * FROM c_dedup WHERE country IS NOT NULL AND date IS NOT NULL AND sector IS NOT NULL),
c_fill AS (SELECT * REPLACE (coalesce(MtCO2_per_day, (SELECT quantile_disc(MtCO2_per_day, 0.5) FROM c_keys)) AS MtCO2_per_day)
           FROM c_keys),
c_std AS (SELECT o_orderkey, {initcap1('trim(country)')} AS country, date, {initcap1('trim(sector)')} AS sector,
          {rnd('MtCO2_per_day', 6)} AS MtCO2_per_day FROM c_fill),
c_enriched AS (SELECT *, {EMISSION_LEVEL} AS emission_level, {SECTOR_CATEGORY} AS sector_category FROM c_std),
c_ref AS (SELECT {initcap1('trim(country)')} AS ref_country FROM countries)"""
    cols = EMISSION_COLS + ["emission_level", "sector_category"]
    metrics = [("min_date", "CAST(strftime(min(date), '%Y%m%d') AS DOUBLE)"),
               ("max_date", "CAST(strftime(max(date), '%Y%m%d') AS DOUBLE)"),
               ("countries", "count(DISTINCT country)"), ("sectors", "count(DISTINCT sector)"),
               ("min_emission", "min(MtCO2_per_day)"), ("max_emission", "max(MtCO2_per_day)"),
               ("avg_emission", xavg("MtCO2_per_day")), ("emission_count", "count(MtCO2_per_day)")]
    vctes, report = report_sql("c_enriched", ["country", "date", "sector"], ["country", "sector", "date"], cols,
                               co2_rules(CO2_FLOOR, CO2_AS_OF), ("country", "ref_country", "c_ref"), metrics)
    return ctes + "," + vctes, report


def weather_job_ctes() -> str:
    """Q-F over weather_obs up to (and including) validation; valid rows in v_valid."""
    std = (f"SELECT l_orderkey, l_linenumber, l_partkey, station_id, {initcap1('trim(city_name)')} AS city_name, date, "
           f"{initcap1('trim(season)')} AS season, {rnd('avg_temp_c', 1)} AS avg_temp_c, {rnd('min_temp_c', 1)} AS min_temp_c, "
           f"{rnd('max_temp_c', 1)} AS max_temp_c, {rnd('precipitation_mm', 1)} AS precipitation_mm FROM w_imp")
    ctes = f"""
w_scrub AS (SELECT * REPLACE (regexp_replace(season, '{ALPHA_RE}', '', 'g') AS season) FROM weather_obs),
w_order AS (SELECT * FROM w_scrub WHERE {F2}),{dedup_cte('w_dedup', 'w_order', ['station_id', 'date'], WEATHER_COLS)},
w_nn AS (SELECT * FROM w_dedup WHERE station_id IS NOT NULL AND date IS NOT NULL AND city_name IS NOT NULL
         AND precipitation_mm IS NOT NULL),{impute_ctes('w_nn', 'w_imp')},
w_std AS ({std}),{scored_weather_cte('w_std', 'w_scored')}"""
    vctes, _ = report_sql("w_scored", ["station_id", "date"], ["station_id", "date"], WEATHER_COLS + SCORED_EXTRA,
                          WEATHER_RULES, ("station_id", "station_id", "stations"))
    return ctes + "," + vctes


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    W = with_(WEATHER_OBS)
    q["vulnerability_batch"] = with_(WEATHER_OBS, STATIONS, scored_weather_cte(), vulnerability_sql("scored"))
    q["spi_index"] = with_(WEATHER_OBS, spi_cte("weather_obs")) + f" SELECT {WID}, spi_index FROM spi"
    q["risk_score"] = with_(WEATHER_OBS, scored_weather_cte()) + (
        f" SELECT {WID}, spi_index, climate_risk_score, climate_risk_level FROM scored")
    q["risk_level"] = with_(WEATHER_OBS, scored_weather_cte()) + (
        " SELECT climate_risk_level, count(*) AS n_rows FROM scored GROUP BY climate_risk_level")

    q["scrub_alpha"] = f"SELECT c_custkey, regexp_replace(c_name, '{ALPHA_RE}', '', 'g') AS c_name_alpha FROM customer"
    q["scrub_double"] = ("SELECT event_id, TRY_CAST(regexp_replace(props, '[^0-9.-]', '', 'g') AS DOUBLE) AS props, "
                         "value FROM events")
    q["scrub_int"] = ("SELECT o_orderkey, TRY_CAST(regexp_replace(o_orderpriority, '[^0-9]', '', 'g') AS INTEGER) "
                      "AS o_orderpriority FROM orders")
    q["drop_columns"] = "SELECT * EXCLUDE (l_tax, l_discount) FROM lineitem"
    q["drop_null_rows"] = W + (f" SELECT {WID}, {TEMPS} FROM weather_obs WHERE avg_temp_c IS NOT NULL "
                               "AND min_temp_c IS NOT NULL AND max_temp_c IS NOT NULL")
    q["dedup_by_key"] = with_(WEATHER_OBS, dedup_cte("d", "weather_obs", ["station_id", "date"], WEATHER_COLS)) + (
        " SELECT * FROM d")
    raw = ("CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'bad' "
           "WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') "
           "WHEN o_orderkey % 5 = 1 THEN strftime(o_orderdate, '%-d/%-m/%Y') "
           "WHEN o_orderkey % 5 = 2 THEN strftime(o_orderdate, '%Y-%m-%d') "
           "WHEN o_orderkey % 5 = 3 THEN strftime(o_orderdate, '%Y/%m/%d') "
           "ELSE strftime(o_orderdate, '%d%m%Y') END")
    q["parse_dates"] = (
        f"WITH r AS (SELECT o_orderkey, {raw} AS raw_date FROM orders) "
        "SELECT o_orderkey, raw_date, CAST(coalesce("
        "CASE WHEN regexp_matches(raw_date, '^\\d{1,2}/\\d{1,2}/\\d{4}$') THEN try_strptime(raw_date, '%d/%m/%Y') END, "
        "CASE WHEN regexp_matches(raw_date, '^\\d{4}-\\d{2}-\\d{2}$') THEN try_strptime(raw_date, '%Y-%m-%d') END, "
        "CASE WHEN regexp_matches(raw_date, '^\\d{4}/\\d{2}/\\d{2}$') THEN try_strptime(raw_date, '%Y/%m/%d') END, "
        "CASE WHEN regexp_matches(raw_date, '^\\d{8}$') THEN try_strptime(raw_date, '%d%m%Y') END) AS DATE) AS parsed_date "
        "FROM r")
    q["standardize_text"] = with_(EMISSIONS) + (
        f" SELECT o_orderkey, {initcap1('trim(country)')} AS country, {initcap1('trim(sector)')} AS sector FROM emissions")
    q["round_measures"] = with_(EMISSIONS) + f" SELECT o_orderkey, {rnd('MtCO2_per_day', 2)} AS MtCO2_per_day FROM emissions"
    q["temp_order_filter"] = W + f" SELECT {WID}, {TEMPS} FROM weather_obs WHERE {F2}"
    q["global_median_fill"] = with_(EMISSIONS) + (
        " SELECT * REPLACE (coalesce(MtCO2_per_day, (SELECT quantile_disc(MtCO2_per_day, 0.5) FROM emissions)) "
        "AS MtCO2_per_day) FROM emissions")
    q["group_median"] = W + " SELECT station_id, quantile_disc(max_temp_c, 0.5) AS median_max_temp FROM weather_obs GROUP BY station_id"
    q["impute_temps"] = with_(WEATHER_OBS, impute_ctes("weather_obs")) + (
        f" SELECT {WID}, {rnd('avg_temp_c', 6)} AS avg_temp_c, {rnd('min_temp_c', 6)} AS min_temp_c, "
        f"{rnd('max_temp_c', 6)} AS max_temp_c FROM imp")
    q["temp_range"] = W + f" SELECT {WID}, {TEMP_RANGE} AS temp_range_c FROM weather_obs"
    q["temp_category"] = W + f" SELECT {WID}, {TEMP_CATEGORY} AS temp_category FROM weather_obs"
    q["precip_category"] = W + f" SELECT {WID}, {PRECIP_CATEGORY} AS precipitation_category FROM weather_obs"
    q["emission_level"] = with_(EMISSIONS) + f" SELECT o_orderkey, MtCO2_per_day, {EMISSION_LEVEL} AS emission_level FROM emissions"
    q["sector_category"] = with_(EMISSIONS) + f" SELECT o_orderkey, sector, {SECTOR_CATEGORY} AS sector_category FROM emissions"

    # validation
    q["null_profile"] = W + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS total_rows, "
        f"CASE WHEN count(*) > 0 THEN {rnd(f'(count(*) - (count(*) - count({c}))) / count(*) * 100', 2)} ELSE 0.0 END "
        f"AS completeness_pct FROM weather_obs" for c in WEATHER_COLS)
    vctes, vreport = report_sql("scored", ["station_id", "date"], ["station_id", "date"], WEATHER_COLS + SCORED_EXTRA,
                                WEATHER_RULES, ("station_id", "station_id", "stations"))
    wv = with_(WEATHER_OBS, STATIONS, scored_weather_cte()) + "," + vctes
    q["rule_violations_weather"] = wv + " " + vreport
    q["clean_valid_rows"] = wv + " SELECT * FROM v_valid"
    cctes, creport = co2_job_ctes()
    cj = with_(EMISSIONS, COUNTRIES) + "," + cctes
    q["rule_violations_co2"] = cj + " " + creport
    q["co2_cleaned"] = cj + " SELECT * FROM v_valid"
    q["co2_quality_metrics"] = cj + (
        f" SELECT count(DISTINCT country) AS countries, count(DISTINCT sector) AS sectors, min(date) AS min_date, "
        f"max(date) AS max_date, min(MtCO2_per_day) AS min_emission, max(MtCO2_per_day) AS max_emission, "
        f"{rnd(xavg('MtCO2_per_day'), 6)} AS avg_emission, count(MtCO2_per_day) AS emission_count FROM v_valid")
    q["fk_valid_rows"] = with_(WEATHER_OBS, STATIONS) + (
        f" SELECT {WID} FROM weather_obs WHERE station_id IN (SELECT station_id FROM stations)")
    q["weather_cleaned"] = with_(WEATHER_OBS, STATIONS) + "," + weather_job_ctes() + " SELECT * FROM v_valid"

    # documents
    q["doc_weather"] = with_(WEATHER_OBS, scored_weather_cte()) + (
        " SELECT l_orderkey, l_linenumber, l_partkey, station_id, strftime(date, '%Y-%m-%d') AS date, "
        "avg_temp_c AS temperature_avg, min_temp_c AS temperature_min, max_temp_c AS temperature_max, "
        "temp_range_c AS temperature_range, temp_category AS temperature_category, "
        "precipitation_mm AS precipitation_value, precipitation_category, "
        "climate_risk_score AS risk_score, climate_risk_level AS risk_level FROM scored")
    q["doc_co2"] = with_(EMISSIONS) + (
        f" SELECT o_orderkey, country, strftime(date, '%Y-%m-%d') AS date, sector AS sector_type, "
        f"{SECTOR_CATEGORY} AS sector_category, MtCO2_per_day AS mt_co2_per_day, {EMISSION_LEVEL} AS emission_level "
        "FROM emissions")
    q["doc_city"] = with_(STATIONS) + (
        " SELECT station_id, city_name, country, iso3, latitude AS coordinates_lat, longitude AS coordinates_long FROM stations")
    q["doc_country"] = with_(COUNTRIES) + (
        " SELECT country, iso3, region, capital AS capital_name, capital_lat, capital_lng AS capital_long FROM countries")

    # joined questions
    daily = ("SELECT date, country, coalesce(" + xsum("MtCO2_per_day") + ", 0.0) AS total_emission "
             "FROM emissions GROUP BY date, country")
    top = f"top AS ({daily} ORDER BY total_emission DESC, date ASC, country ASC LIMIT 1)"
    q["list_countries"] = with_(COUNTRIES) + " SELECT country FROM countries"
    q["top_emission_day"] = with_(EMISSIONS, top) + f" SELECT date, country, {rnd('total_emission', 4)} AS total_emission FROM top"
    q["top_day_hottest_cities"] = with_(WEATHER_OBS, EMISSIONS, STATIONS, top, f"""
per_city AS (
  SELECT t.date AS d, t.country AS c, st.city_name, max(w.max_temp_c) AS max_temp
  FROM weather_obs w JOIN top t ON w.date = t.date JOIN stations st ON w.station_id = st.station_id
  WHERE st.country = t.country GROUP BY t.date, t.country, st.city_name
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY d, c ORDER BY max_temp DESC NULLS LAST, city_name) AS rk FROM per_city
)""") + (f" SELECT t.date, t.country, {rnd('t.total_emission', 4)} AS total_emission, "
         "CAST(r.rk - 1 AS INTEGER) AS city_rank, r.city_name, r.max_temp "
         "FROM top t LEFT JOIN (SELECT * FROM ranked WHERE rk <= 5) r ON t.date = r.d AND t.country = r.c")
    q["extreme_weather_emissions"] = with_(WEATHER_OBS, EMISSIONS, STATIONS, scored_weather_cte(), f"""
daily AS ({daily}),
j AS (
  SELECT s.date, st.country, s.max_temp_c, s.climate_risk_score, d.total_emission
  FROM scored s JOIN stations st ON s.station_id = st.station_id
  JOIN daily d ON d.date = s.date AND d.country = st.country
  WHERE s.climate_risk_level IN ('HIGH', 'SEVERE') OR s.max_temp_c >= 35.0
),
g AS (
  SELECT country, date, count(*) AS extreme_events, max(max_temp_c) AS max_temp,
    {xavg('climate_risk_score')} AS avg_risk, max(total_emission) AS total_emission
  FROM j GROUP BY country, date HAVING max(max_temp_c) > 35.0
  ORDER BY total_emission DESC, country, date LIMIT 50
)""") + (f" SELECT country, date, extreme_events, max_temp, {rnd('avg_risk', 2)} AS avg_risk, "
         f"{rnd('total_emission', 4)} AS total_emission FROM g")

    fan = f"""
cc AS (SELECT st.station_id, st.city_name, co.country FROM stations st JOIN countries co ON st.iso3 = co.iso3),
pat AS (
  SELECT cc.country, w.date, w.avg_temp_c, e.MtCO2_per_day
  FROM weather_obs w JOIN cc ON w.station_id = cc.station_id
  JOIN emissions e ON e.country = cc.country AND e.date = w.date
),
daily_f AS (
  SELECT country, date, avg(avg_temp_c) AS daily_avg_temp, coalesce({xsum('MtCO2_per_day')}, 0.0) AS daily_total_co2,
    strftime(date, '%Y-%m') AS month FROM pat GROUP BY country, date
),
wd AS (SELECT cc.country, w.date, {xavg('w.avg_temp_c')} AS daily_avg_temp FROM weather_obs w
       JOIN cc ON w.station_id = cc.station_id WHERE w.date IS NOT NULL GROUP BY cc.country, w.date),
cd AS (SELECT e.country, e.date, coalesce({xsum('e.MtCO2_per_day')}, 0.0) AS co2 FROM emissions e
       WHERE e.country IN (SELECT country FROM countries) AND e.date IS NOT NULL GROUP BY e.country, e.date),
daily_t AS (SELECT wd.country, wd.date, wd.daily_avg_temp, cd.co2 AS daily_total_co2, strftime(wd.date, '%Y-%m') AS month
            FROM wd JOIN cd ON wd.country = cd.country AND wd.date = cd.date)"""
    monthly = lambda d: (f" SELECT country, month, {rnd(xavg('daily_avg_temp'), 2)} AS monthly_avg_temp, "  # noqa: E731
                         f"{rnd(xsum('daily_total_co2'), 2)} AS monthly_total_co2 FROM {d} GROUP BY country, month")
    base = with_(WEATHER_OBS, EMISSIONS, STATIONS, COUNTRIES, fan)
    q["monthly_temp_co2"] = base + monthly("daily_f")
    q["monthly_temp_co2_true"] = base + monthly("daily_t")
    q["monthly_daily_sample"] = base + (
        " SELECT country, month, CAST(rn - 1 AS INTEGER) AS sample_idx, date, "
        f"{rnd('daily_avg_temp', 2)} AS avg_temp, {rnd('daily_total_co2', 2)} AS co2 FROM ("
        " SELECT *, row_number() OVER (PARTITION BY country, month ORDER BY date) AS rn FROM daily_f) WHERE rn <= 5")
    pivot_cols = ", ".join(f"max(CASE WHEN country = 'NATION_{i}' THEN t END) AS \"NATION_{i}\"" for i in range(25))
    q["monthly_temp_pivot"] = base + (
        f", m AS (SELECT country, month, {rnd(xavg('daily_avg_temp'), 2)} AS t FROM daily_t GROUP BY country, month)"
        f" SELECT month, {pivot_cols} FROM m GROUP BY month")
    q["hot_cities_co2"] = with_(WEATHER_OBS, EMISSIONS, STATIONS, COUNTRIES, f"""
hot AS (SELECT station_id, count(date) AS hot_days_count FROM weather_obs WHERE avg_temp_c > 30 GROUP BY station_id),
cc AS (SELECT st.station_id, st.city_name, co.country FROM stations st JOIN countries co ON st.iso3 = co.iso3),
pc AS (SELECT country, {xavg('MtCO2_per_day')} AS avg_co2 FROM emissions GROUP BY country),
r AS (SELECT DISTINCT cc.city_name AS city, cc.country, hot.hot_days_count, pc.avg_co2
      FROM hot JOIN cc ON hot.station_id = cc.station_id JOIN pc ON pc.country = cc.country
      ORDER BY hot_days_count DESC, city, country LIMIT 20)""") + (
        f" SELECT city, country, hot_days_count, {rnd('avg_co2', 2)} AS avg_co2 FROM r")

    # graph tables
    wnodes = "(SELECT DISTINCT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM weather_obs)"
    enodes = "(SELECT DISTINCT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM emissions)"
    def node_rows(label, src, cols):
        text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in cols)
        return f"SELECT '{label}' AS label, concat_ws('|', {text}) AS node FROM {src}"

    q["graph_nodes"] = with_(WEATHER_OBS, EMISSIONS, STATIONS, COUNTRIES) + " " + " UNION ALL ".join([
        node_rows("City", "(SELECT DISTINCT * FROM stations)", ["station_id", "city_name", "country", "iso3"]),
        node_rows("Country", "(SELECT DISTINCT * FROM countries)", ["country", "iso3", "capital", "region"]),
        node_rows("Weather", wnodes, ["l_orderkey", "l_linenumber", "l_partkey", "station_id", "city_name", "date", "season"]),
        node_rows("Co2", enodes, ["o_orderkey", "country", "date", "sector"]),
        node_rows("Date", f"(SELECT DISTINCT date FROM {wnodes} WHERE date IS NOT NULL)", ["date"]),
        node_rows("Sector", f"(SELECT DISTINCT sector FROM {enodes} WHERE sector IS NOT NULL)", ["sector"]),
        node_rows("EmissionValue", f"(SELECT DISTINCT date, country, sector FROM {enodes} "
                  "WHERE date IS NOT NULL AND country IS NOT NULL AND sector IS NOT NULL)", ["date", "country", "sector"])])
    q["edge_relinked"] = with_(WEATHER_OBS) + (
        f" SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, station_id, date AS date_value FROM {wnodes} WHERE date IS NOT NULL")
    q["edge_located_in"] = with_(STATIONS, COUNTRIES) + (
        " SELECT DISTINCT s.station_id, s.city_name, c.country, 'cities.csv' AS source FROM (SELECT DISTINCT * FROM stations) s"
        " JOIN (SELECT DISTINCT iso3, country FROM countries) c ON s.iso3 = c.iso3")
    q["edge_has_co2"] = with_(EMISSIONS, COUNTRIES) + (
        f" SELECT e.*, e.MtCO2_per_day AS emissions FROM {enodes} e JOIN (SELECT DISTINCT country FROM countries) c"
        " ON e.country = c.country")
    q["edge_has_weather"] = with_(WEATHER_OBS, STATIONS) + (
        f" SELECT w.l_orderkey, w.l_linenumber, w.l_partkey, w.station_id, w.date, s.city_name AS city FROM {wnodes} w"
        " JOIN (SELECT DISTINCT station_id, city_name FROM stations) s ON w.station_id = s.station_id")
    q["edge_on_date"] = with_(WEATHER_OBS) + (
        f" SELECT l_orderkey, l_linenumber, l_partkey, station_id, date AS date_value FROM {wnodes} WHERE date IS NOT NULL")
    q["edge_emit_from"] = with_(EMISSIONS) + (
        f" SELECT o_orderkey, country, date, sector AS sector_name FROM {enodes} WHERE sector IS NOT NULL")
    q["edge_has_value"] = with_(EMISSIONS) + (
        f" SELECT e.o_orderkey, e.date, e.country, e.sector, v.mtCo2PerDay FROM {enodes} e JOIN ("
        f"SELECT date, country, sector, max(MtCO2_per_day) AS mtCo2PerDay FROM {enodes} WHERE date IS NOT NULL "
        "AND country IS NOT NULL AND sector IS NOT NULL GROUP BY date, country, sector) v "
        "ON e.date = v.date AND e.country = v.country AND e.sector = v.sector")

    # JSON and streams: the decoded rows equal the source table
    q["json_round_trip"] = "SELECT * FROM events"
    q["ingest_stream"] = "SELECT * FROM events"
    bad = ["[1, 2]", "null", '{"event_id": 1', '{"event_id": 1} tail', "event"]
    pick = " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(bad))
    q["ingest_rejects"] = (
        f"SELECT (CASE (event_id // 50) % {len(bad)} {pick} END) || (CASE WHEN event_id % 100 = 0 THEN '' ELSE ' ' END) AS payload, "
        "count(*) AS n FROM events WHERE event_id % 50 = 0 GROUP BY 1")
    q["vulnerability_stream"] = q["vulnerability_batch"]

    q["stream_state"] = ("SELECT country, max_risk_score, min_risk_score, low_cnt, moderate_cnt, high_cnt, critical_cnt, events "
                         f"FROM ({q['vulnerability_batch']})")
    q["ingest_unique"] = "SELECT * FROM events"
    q["gated_ingest"] = """
WITH e AS (SELECT event_id % 4 AS part, CASE WHEN event_id % 4 = 2 AND event_id % 3 = 0 OR event_id % 100 = 1 THEN 'payload'
                                             WHEN value IS NULL OR value < 0 THEN 'negative_value' END AS fault FROM events),
b AS (SELECT part, count(*) AS n, count(*) FILTER (WHERE fault IS NULL) AS good FROM e GROUP BY part),
p AS (SELECT e.fault, good >= 10 AND n - good <= 0.1 * n AS ok FROM e JOIN b USING (part))
SELECT CASE WHEN ok AND fault IS NULL THEN 'admitted' ELSE 'away: ' || coalesce(fault, 'batch') END AS place, count(*) AS n FROM p GROUP BY 1
UNION ALL SELECT CASE WHEN good >= 10 AND n - good <= 0.1 * n THEN 'report: admitted' ELSE 'report: diverted' END, count(*) FROM b GROUP BY 1"""

    # single operators
    q["country_top_day"] = with_(EMISSIONS) + (
        f" SELECT date, country, {rnd(xsum('MtCO2_per_day'), 4)} AS total_emission FROM emissions WHERE country = 'NATION_7' "
        f"GROUP BY date, country ORDER BY coalesce({xsum('MtCO2_per_day')}, 0) DESC, date LIMIT 1")
    q["processing_time"] = "SELECT o_orderkey, '2024-05-06 07:08:09' AS processing_time FROM orders"
    q["mode_value_fill"] = with_(EMISSIONS) + (
        ", m AS (SELECT sector AS common FROM emissions WHERE sector IS NOT NULL GROUP BY sector ORDER BY count(*) DESC, sector LIMIT 1)"
        " SELECT o_orderkey, coalesce(sector, (SELECT common FROM m)) AS sector, coalesce(country, 'nowhere') AS country FROM emissions")
    q["string_date_documents"] = (
        f"SELECT o_orderkey, {raw} AS date, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || "
        "CASE WHEN microsecond(o_orderdate) % 1000000 = 0 THEN '' ELSE strftime(o_orderdate, '.%f') END AS o_orderdate FROM orders")
    q["timestamp_weather_cleaned"] = q["weather_cleaned"]
    q["csv_round_trip"] = with_(STATIONS) + (
        " SELECT station_id, city_name, country, iso3, latitude, longitude FROM stations")
    q["raw_feed_round_trip"] = W + (
        " SELECT station_id, city_name, strftime(date, '%Y-%m-%d') AS date, season, avg_temp_c, min_temp_c, max_temp_c, precipitation_mm FROM weather_obs")
    q["observation_timestamps"] = W + (
        " SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 19 <> 0 THEN strftime(date, '%Y-%m-%d %H:%M:%S') END AS observed FROM weather_obs")
    q["cleaning_steps"] = cj + (
        " SELECT 'step' AS kind, 'co2_input' AS name, count(*)::DOUBLE AS value FROM emissions"
        " UNION ALL SELECT 'step', 'co2_after_dedup', count(*)::DOUBLE FROM c_dedup"
        " UNION ALL SELECT 'step', 'co2_after_null_drop', count(*)::DOUBLE FROM c_keys"
        " UNION ALL SELECT 'gate', 'final_count', final_count::DOUBLE FROM v_one"
        " UNION ALL SELECT 'gate', 'warnings', ((initial_count - final_count) / initial_count > 0.05)::INT"
        " + ((SELECT count(DISTINCT country) FROM v_valid) < 5)::INT + ((SELECT count(DISTINCT sector) FROM v_valid) < 3)::INT FROM v_one")
    only = ("CASE WHEN avg_temp_c IS NOT NULL THEN avg_temp_c WHEN pavg >= coalesce(min_temp_c, pavg) AND pavg <= coalesce(max_temp_c, pavg) THEN pavg "
            "ELSE (coalesce(min_temp_c, max_temp_c) + coalesce(max_temp_c, min_temp_c)) / 2 END")
    q["impute_average_only"] = W + (
        f", st AS (SELECT station_id AS st_id, {xavg('avg_temp_c')} AS pavg FROM weather_obs GROUP BY station_id)"
        f", a AS (SELECT w.* REPLACE ({only} AS avg_temp_c) FROM weather_obs w LEFT JOIN st ON w.station_id IS NOT DISTINCT FROM st_id)"
        f" SELECT {WID}, {rnd('avg_temp_c', 6)} AS avg_temp_c, {rnd('CASE WHEN min_temp_c IS NOT NULL THEN least(min_temp_c, avg_temp_c) END', 6)} AS min_temp_c, "
        f"{rnd('CASE WHEN max_temp_c IS NOT NULL THEN greatest(max_temp_c, avg_temp_c) END', 6)} AS max_temp_c FROM a")

    # stored tables and states
    q["top_day_month_table"] = q["top_day_hottest_cities"]
    q["emissions_upserted"] = with_(EMISSIONS) + (
        " SELECT * REPLACE (CASE WHEN o_orderkey % 100 = 0 THEN 'revised' ELSE sector END AS sector) FROM emissions")
    q["edges_upserted"] = q["edge_relinked"]
    q["spi_from_state"] = with_(WEATHER_OBS, spi_cte("weather_obs")) + (
        " SELECT DISTINCT station_id, year(date)::INTEGER AS year, month(date)::INTEGER AS month, spi_index FROM spi")
    q["spi_bucketed"] = (f"WITH {WEATHER_OBS}, kept AS (SELECT * FROM weather_obs WHERE station_id IS NOT NULL AND date IS NOT NULL),"
                         + spi_cte("kept") + f" SELECT {WID}, spi_index FROM spi")
    numbers, texts = {"o_orderkey": "o_orderkey", "date": "date_diff('day', DATE '1970-01-01', date)", "MtCO2_per_day": "MtCO2_per_day"}, ["country", "sector"]
    parts = []
    for c in EMISSION_COLS:
        low, high = (f"min({numbers[c]})::DOUBLE", f"max({numbers[c]})::DOUBLE") if c in numbers else ("NULL::DOUBLE", "NULL::DOUBLE")
        first, final = (f"min({c})", f"max({c})") if c in texts else ("NULL::VARCHAR", "NULL::VARCHAR")
        parts.append(f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_count, 0::BIGINT AS nan_count, {low} AS min_number, "
                     f"{high} AS max_number, {first} AS min_text, {final} AS max_text, {rnd(f'count({c}) / count(*) * 100', 2)} AS completeness_pct, "
                     "true AS distinct_near FROM emissions")
    q["profile_merged"] = with_(EMISSIONS) + " " + " UNION ALL ".join(parts)
    measured = ["avg_temp_c", "min_temp_c", "max_temp_c", "precipitation_mm"]
    long = " UNION ALL ".join(f"SELECT '{c}' AS c, 0 AS t, {c}::DOUBLE AS v FROM weather_obs UNION ALL SELECT '{c}', 1, {c}::DOUBLE FROM v_valid" for c in measured)
    q["before_after_cleaning"] = with_(WEATHER_OBS, STATIONS) + "," + weather_job_ctes() + f""",
b_long AS ({long}),
b_cut AS (SELECT c, min(v) AS low, max(v) AS high FROM b_long GROUP BY c),
b_bin AS (SELECT c, t, least(greatest(floor((v - low) / (high - low) * 20), 0), 19)::INTEGER AS bin FROM b_long JOIN b_cut USING (c) WHERE v IS NOT NULL),
b_hist AS (SELECT c, bin, count(*) FILTER (WHERE t = 0) AS n0, count(*) FILTER (WHERE t = 1) AS n1 FROM b_bin GROUP BY c, bin),
b_grid AS (SELECT g.c, g.bin, coalesce(h.n0, 0) AS n0, coalesce(h.n1, 0) AS n1 FROM (SELECT c, i::INTEGER AS bin FROM b_cut CROSS JOIN range(20) r(i)) g
           LEFT JOIN b_hist h ON h.c = g.c AND h.bin = g.bin),
b_far AS (SELECT c, round(sum(abs(n0 / s0 - n1 / s1)) / 2, 6) AS distance FROM
          (SELECT *, sum(n0) OVER (PARTITION BY c) AS s0, sum(n1) OVER (PARTITION BY c) AS s1 FROM b_grid) GROUP BY c),
b_sum AS (SELECT c, count(*) FILTER (WHERE t = 0) AS rows_before, count(*) FILTER (WHERE t = 1) AS rows_after,
          count(*) FILTER (WHERE t = 0 AND v IS NULL) AS nulls_before, count(*) FILTER (WHERE t = 1 AND v IS NULL) AS nulls_after,
          count(DISTINCT v) FILTER (WHERE t = 0) AS distinct_before, count(DISTINCT v) FILTER (WHERE t = 1) AS distinct_after FROM b_long GROUP BY c)
SELECT c AS column_name, rows_before, rows_after, nulls_before, nulls_after, distinct_before, distinct_after, distance, bin, n0 AS n_before, n1 AS n_after
FROM b_grid JOIN b_far USING (c) JOIN b_sum USING (c)"""
    q["top_day_report"] = ("SELECT date AS \"Date\", country AS \"Country\", total_emission AS \"Total CO₂\", city_name AS \"City\", "
                           f"max_temp AS \"Max Temp (°C)\" FROM ({q['top_day_hottest_cities']})")
    q["monthly_report"] = ("SELECT country AS \"Country\", month AS \"Month\", monthly_avg_temp AS \"Monthly Avg Temp (°C)\", "
                           f"monthly_total_co2 AS \"Monthly Total CO₂\" FROM ({q['monthly_temp_co2_true']})")
    q["hot_cities_report"] = ("SELECT city AS \"City\", country AS \"Country\", hot_days_count AS \"Hot Days Count\", avg_co2 AS \"Avg CO₂ (MtCO₂/day)\" "
                              f"FROM ({q['hot_cities_co2'].replace('avg_temp_c > 30', 'avg_temp_c > 35').replace('LIMIT 20', 'LIMIT 7')})")
    q["extreme_weather_report"] = with_(WEATHER_OBS, EMISSIONS, STATIONS, scored_weather_cte(), f"""
daily AS ({daily}),
j AS (
  SELECT s.date, st.country, s.max_temp_c, s.climate_risk_score, d.total_emission
  FROM scored s JOIN stations st ON s.station_id = st.station_id
  JOIN daily d ON d.date = s.date AND d.country = st.country
  WHERE s.climate_risk_level = 'CRITICAL' OR s.max_temp_c >= 38.0
)""") + (f" SELECT country AS \"Country\", date AS \"Date\", count(*) AS \"Extreme Events\", "
         f"max(max_temp_c) AS \"Max Temp (°C)\", {rnd(xavg('climate_risk_score'), 2)} AS \"Avg Risk Score\", "
         f"{rnd('max(total_emission)', 4)} AS \"Total Emission (MtCO₂/day)\" FROM j GROUP BY country, date HAVING max(max_temp_c) > 38.0")
    return q


ORACLE_SQL = build()
