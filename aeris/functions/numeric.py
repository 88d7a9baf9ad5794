"""Order-independent aggregation of doubles.

A floating-point sum depends on the order rows arrive in, which depends on
partitioning; a value that is mathematically on a rounding boundary (19.375
rounded to two places) can then round either way from run to run.  Summing
the values as DECIMAL(38,12) is exact, so the result is the same for every
partitioning.  Inputs are first rounded to 12 decimal places, which is far
below the precision any report keeps.

A group that holds a value outside that type (NaN, an infinity, 1e26 or
more), or whose total leaves it, is summed as doubles instead: NaN stays NaN and nothing is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

EXACT = "decimal(38,12)"
BEYOND = 1e26   # from here on a double does not fit EXACT


def _c(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def not_exact(value: Column) -> Column:
    """True for a double that does not fit ``EXACT`` (null for null), without the cast."""
    return F.isnan(value) | (F.abs(value) >= BEYOND)


def _or_plain(value: Column, exact: Column, plain: Column) -> Column:
    outside = F.count_if(not_exact(value))
    return F.when(outside == 0, F.coalesce(exact.cast("double"), plain)).otherwise(plain)


def exact_sum(col: str | Column) -> Column:
    c = _c(col)
    return _or_plain(c, F.try_sum(c.try_cast(EXACT)), F.sum(c))


def exact_avg(col: str | Column) -> Column:
    c = _c(col)
    return _or_plain(c, F.try_avg(c.try_cast(EXACT)), F.avg(c))


def exact_sums_over(values: dict[str, Column], window: WindowSpec) -> dict[str, Column]:
    """The parts of ``exact_sum`` of each value as window functions; ``with_exact`` makes the sum of them.

    Each part is a column, since an expression that names a window function twice has it computed twice.
    """
    out = {}
    for name, value in values.items():
        c = _c(value)
        out |= {f"{name}_exact": F.try_sum(c.try_cast(EXACT)).over(window), f"{name}_plain": F.sum(c).over(window),
                f"{name}_beyond": F.count_if(not_exact(c)).over(window)}
    return out


def with_exact(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the sum ``name`` in place of its parts."""
    exact, plain = F.col(f"{name}_exact").cast("double"), F.col(f"{name}_plain")
    total = F.when(F.col(f"{name}_beyond") == 0, F.coalesce(exact, plain)).otherwise(plain)
    return df.withColumn(name, total).drop(f"{name}_exact", f"{name}_plain", f"{name}_beyond")
