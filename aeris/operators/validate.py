"""Data-quality validation in a few passes.

The source runs about 28 actions per dataset (one count per column, two per
rule).  Here a row's fate is one column, ``first_failed_rule``: the name of
the first rule (in order) it breaks, or null.  A row that breaks two rules is
counted once, under the first, exactly as sequential filtering would count
it.  The report then needs two aggregates: the null profile of the input
and one pass of conditional counts over the flagged rows.

Order of work: schema check (no job) -> null profile -> drop null keys ->
deterministic dedup -> rule flags (referential rule as a left join against
the distinct reference keys, cast to the data's type) -> counts.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.functions.numeric import exact_avg
from aeris.operators.cleaning import dedup_by_key, temp_order_ok
from aeris.operators.joins import reference_keys
from aeris.session import remove_paths

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Rule:
    name: str
    keep: Callable[[], Column]  # a valid row satisfies it; null counts as a failure


@dataclass(frozen=True)
class ReferenceCheck:
    column: str
    ref_column: str | None = None
    transform: Callable[[Column], Column] | None = None  # applied to reference keys
    name: str = "referential_integrity"
    hit: str | None = None  # column of the checked rows that is true where the reference has the key; spares the join


@dataclass(frozen=True)
class ValidationSpec:
    required: Sequence[str]
    keys: Sequence[str]
    dedup_keys: Sequence[str]
    rules: Sequence[Rule]
    reference: ReferenceCheck | None = None
    min_rows: int = 100
    max_invalid_ratio: float = 0.02
    min_countries: int | None = None
    min_sectors: int | None = None
    recorded_issues: Sequence[str] | None = None  # None: record every check
    keys_unique: bool = False   # caller guarantees dedup_keys are unique: skip the dedup shuffle


@dataclass
class ValidationResult:
    valid: DataFrame
    flagged: DataFrame
    spec: ValidationSpec
    build_report: Callable[[], DataFrame]
    warnings: list[str] = field(default_factory=list)
    steps: dict = field(default_factory=dict)   # step name -> pyspark Observation (A16)
    scratch: list[str] = field(default_factory=list)   # folders of the job's lineage cuts
    _report: DataFrame | None = None
    _summary: dict[str, float] | None = None

    @property
    def report(self) -> DataFrame:
        """Long report (section, item, value); its plan is built on first use."""
        if self._report is None:
            self._report = self.build_report()
        return self._report

    def summary(self) -> dict[str, float]:
        """The long report as a dict (a few dozen rows at most); computed once."""
        if self._summary is None:
            self._summary = {f"{r['section']}.{r['item']}": r["value"] for r in self.report.collect()}
        return dict(self._summary)

    def checks(self) -> list[str]:
        """Names of the checks that the report covers, in order."""
        named = [r.name for r in self.spec.rules]
        done = ["required_columns", "null_keys", "duplicates", *named]
        return done + ([self.spec.reference.name] if f"issue.{self.spec.reference.name}" in self.summary() else []) \
            if self.spec.reference is not None else done

    def release(self, spark) -> None:
        """Delete the job's lineage cuts; call when its results have been written."""
        remove_paths(spark, self.scratch)

    def issues_found(self) -> dict[str, int]:
        """Non-zero issue counts among the recorded ones.

        The weather spec records only duplicates and referential integrity,
        the CO2 spec every rule; the long ``report`` always has all counts.
        """
        s = self.summary()
        recorded = self.spec.recorded_issues
        return {k.split(".", 1)[1]: int(v) for k, v in s.items()
                if k.startswith("issue.") and v > 0
                and (recorded is None or k.split(".", 1)[1] in recorded)}

    def check_gates(self) -> dict[str, float]:
        """Raise below ``min_rows`` (V7); warn on drop ratio and coverage (V8, V9)."""
        s = self.summary()
        self.warnings.clear()
        final = s["count.final_count"]
        if final < self.spec.min_rows:
            raise ValueError(f"too few valid rows: {int(final)}, at least {self.spec.min_rows} are wanted")
        ratio = s["count.drop_ratio"]
        if ratio > self.spec.max_invalid_ratio:
            self.warnings.append(f"drop ratio {ratio:.2%} exceeds {self.spec.max_invalid_ratio:.2%}")
        if self.spec.min_countries is not None and s.get("metric.countries", 0) < self.spec.min_countries:
            self.warnings.append(f"only {int(s.get('metric.countries', 0))} countries")
        if self.spec.min_sectors is not None and s.get("metric.sectors", 0) < self.spec.min_sectors:
            self.warnings.append(f"only {int(s.get('metric.sectors', 0))} sectors")
        for w in self.warnings:
            log.warning(w)
        return s


def check_required(df: DataFrame, required: Sequence[str]) -> None:
    """Schema validation (V1): raises on missing columns without running a job."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"columns not found: {missing}")


def _null_counts(df: DataFrame, extra: list[Column] = ()) -> tuple[DataFrame, list[str]]:
    """One-row aggregate: ``__n`` rows, ``__c{i}`` nulls of column i, plus ``extra``."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__c{i}") for i, c in enumerate(cols)],
                 *extra)
    return row, cols


def _profile_rows(row: DataFrame, cols: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__c{i}").alias("null_count"))
                      for i, c in enumerate(cols)])
    return row.select(F.col("__n").alias("total_rows"), F.inline(pairs))


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count, total_rows, completeness_pct) in one aggregate."""
    row, cols = _null_counts(df)
    long = _profile_rows(row, cols)
    return long.select(
        "column_name", "null_count", "total_rows",
        F.when(F.col("total_rows") > 0,
               F.round((F.col("total_rows") - F.col("null_count")) / F.col("total_rows") * 100, 2))
         .otherwise(0.0).alias("completeness_pct"))


def reference_hits(df: DataFrame, reference: ReferenceCheck, reference_df: DataFrame) -> DataFrame:
    """The reference's distinct keys as ``__ref_key``, with a true ``__ref_hit``."""
    key = F.col(reference.ref_column or reference.column)
    if reference.transform is not None:
        key = reference.transform(key)
    return reference_keys(df, reference.column, reference_df, key).withColumn("__ref_hit", F.lit(True))


def flag_rules(df: DataFrame, rules: Sequence[Rule], reference: ReferenceCheck | None = None,
               reference_df: DataFrame | list | None = None) -> DataFrame:
    """Add ``first_failed_rule`` (V4, V5)."""
    out = df
    ref_ok = None
    if reference is not None and reference_df is not None:
        if reference.hit is not None:
            ref_ok = F.col(reference.hit)
        elif isinstance(reference_df, DataFrame):
            keys = reference_hits(df, reference, reference_df)
            out = out.join(keys, out[reference.column] == keys["__ref_key"], "left").drop("__ref_key")
            ref_ok = F.col("__ref_hit").isNotNull()
        else:
            ref_ok = F.col(reference.column).isin(list(reference_df))
    expr = None
    for rule in rules:
        fails = ~F.coalesce(rule.keep(), F.lit(False))
        expr = F.when(fails, rule.name) if expr is None else expr.when(fails, rule.name)
    if ref_ok is not None:
        fails = ~F.coalesce(ref_ok, F.lit(False))
        expr = F.when(fails, reference.name) if expr is None else expr.when(fails, reference.name)
    flag = expr if expr is not None else F.lit(None).cast("string")
    out = out.withColumn("first_failed_rule", flag.cast("string"))
    return out.drop("__ref_hit", *([reference.hit] if reference is not None and reference.hit else []))


def validate(df: DataFrame, spec: ValidationSpec, reference_df: DataFrame | list | None = None,
             metrics: Callable[[DataFrame], DataFrame] | None = None) -> ValidationResult:
    """Run the checks; return valid rows, flagged rows and a long report.

    ``metrics`` maps the valid rows to a one-row aggregate of numeric metrics
    that is appended to the report (V6).
    """
    check_required(df, spec.required)
    key_ok = _all([F.col(k).isNotNull() for k in spec.keys])
    keyed = df.filter(key_ok)
    deduped = keyed if spec.keys_unique else dedup_by_key(keyed, spec.dedup_keys)
    flagged = flag_rules(deduped, spec.rules, spec.reference, reference_df)
    valid = flagged.filter(F.col("first_failed_rule").isNull()).drop("first_failed_rule")

    def build_report() -> DataFrame:
        names = [r.name for r in spec.rules]
        if spec.reference is not None and reference_df is not None:
            names.append(spec.reference.name)
        rule = F.col("first_failed_rule")
        counts = flagged.agg(
            F.count(F.lit(1)).alias("after_dedup"),
            F.count_if(rule.isNull()).alias("final_count"),
            *[F.count_if(rule == n).alias(f"rule_{i}") for i, n in enumerate(names)],
        )
        # one pass over the input gives its row count, non-null keys and null profile; the
        # one row enters the flagged side as a scalar
        hit = [spec.reference.hit] if spec.reference is not None and spec.reference.hit else []
        before, cols = _null_counts(df.drop(*hit), [F.count_if(key_ok).alias("non_null_keys")])
        both = counts.withColumn("__b", before.select(F.struct("*")).scalar())
        total, non_null, final = F.col("__b.__n"), F.col("__b.non_null_keys"), F.col("final_count")
        items = [("count", "initial_count", total),
                 ("issue", "null_keys", total - non_null),
                 ("issue", "duplicates", non_null - F.col("after_dedup")),
                 *[("issue", n, F.col(f"rule_{i}")) for i, n in enumerate(names)],
                 ("count", "final_count", final),
                 ("count", "drop_ratio", F.when(total > 0, (total - final) / total).otherwise(0.0)),
                 *[("null_count", c, F.col(f"__b.__c{i}")) for i, c in enumerate(cols)]]
        report = _long(both, items)
        if metrics is not None:
            m = metrics(valid)
            report = report.unionByName(_long(m, [("metric", c, F.col(c)) for c in m.columns]))
        return report

    return ValidationResult(valid=valid, flagged=flagged, spec=spec, build_report=build_report)


def _long(one_row: DataFrame, items) -> DataFrame:
    """Unpivot a one-row frame into (section, item, value) rows."""
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("section"), F.lit(i).alias("item"), v.cast("double").alias("value"))
        for s, i, v in items])))


def _all(conds: list[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


# ---------------------------------------------------------------------------
# Rule sets of the two datasets


def weather_rules(min_col="min_temp_c", avg_col="avg_temp_c", max_col="max_temp_c",
                  precip_col="precipitation_mm", low=-60.0, high=60.0) -> list[Rule]:
    """F2 temperature order, F3 plausible average, F4 non-negative precipitation."""
    return [
        Rule("temperature_logic", lambda: temp_order_ok(min_col, avg_col, max_col)),
        Rule("temperature_range", lambda: F.col(avg_col).isNull()
             | ((F.col(avg_col) >= low) & (F.col(avg_col) <= high))),
        Rule("negative_precipitation", lambda: F.col(precip_col).isNull() | (F.col(precip_col) >= 0)),
    ]


def co2_rules(emission="MtCO2_per_day", date="date", country="country", sector="sector",
              floor="2019-01-01", as_of=None, ceiling=1000.0) -> list[Rule]:
    """F5 non-negative, F6 plausible emission, F7 date window, F8 non-empty labels."""
    top = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return [
        Rule("negative_emissions", lambda: F.col(emission).isNull() | (F.col(emission) >= 0)),
        Rule("unrealistic_emissions", lambda: F.col(emission).isNull() | (F.col(emission) <= ceiling)),
        Rule("invalid_dates", lambda: F.col(date).isNull()
             | ((F.col(date) >= F.lit(floor).cast("date")) & (F.col(date) <= top))),
        Rule("empty_country_sector", lambda: F.col(country).isNotNull() & (F.length(country) > 0)
             & F.col(sector).isNotNull() & (F.length(sector) > 0)),
    ]


def co2_report_metrics(country="country", sector="sector", emission="MtCO2_per_day", date="date"):
    """Quality metrics for the report (A13, A14); the date range as numbers yyyyMMdd."""
    def day(c):
        return F.date_format(c, "yyyyMMdd").cast("double")

    def build(valid: DataFrame) -> DataFrame:
        return valid.agg(
            day(F.min(date)).alias("min_date"),
            day(F.max(date)).alias("max_date"),
            F.count_distinct(country).alias("countries"),
            F.count_distinct(sector).alias("sectors"),
            F.min(emission).alias("min_emission"),
            F.max(emission).alias("max_emission"),
            exact_avg(emission).alias("avg_emission"),
            F.count(emission).alias("emission_count"),
        )
    return build


def co2_quality_metrics(df: DataFrame, country="country", sector="sector", date="date",
                        emission="MtCO2_per_day") -> DataFrame:
    """One aggregate: distinct counts, date range, emission min/max/avg/count (V6)."""
    return df.agg(
        F.count_distinct(country).alias("countries"),
        F.count_distinct(sector).alias("sectors"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        F.min(emission).alias("min_emission"),
        F.max(emission).alias("max_emission"),
        exact_avg(emission).alias("avg_emission"),
        F.count(emission).alias("emission_count"),
    )
