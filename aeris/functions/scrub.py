"""Character scrubbing of raw text fields.

Only string input is scrubbed.  A column that is already numeric passes
through unchanged: scrubbing the printed form of a double would turn
``1.0E-4`` into ``1.0-4`` and lose the value (see README, decision Q1).
Casts use ``try_cast`` so text that is still not a number becomes null
instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

# The three scrub patterns (characters NOT matched are removed).
ALPHA_PATTERN = r"[^a-zA-Z\s\-''·\.]"
INTEGER_PATTERN = r"[^0-9]"
DOUBLE_PATTERN = r"[^0-9.-]"


def keep_alpha(col: str | Column) -> Column:
    """Remove everything but letters, whitespace, hyphen, apostrophe, middle dot, period."""
    return F.regexp_replace(F.col(col) if isinstance(col, str) else col, ALPHA_PATTERN, "")


def to_double(col: str | Column, dtype: DataType | None = None) -> Column:
    """Strip non-numeric characters and read the rest as a double."""
    c = F.col(col) if isinstance(col, str) else col
    if dtype is not None and isinstance(dtype, NumericType):
        return c.cast("double")
    return F.regexp_replace(c.cast("string"), DOUBLE_PATTERN, "").try_cast("double")


def to_int(col: str | Column, dtype: DataType | None = None) -> Column:
    """Strip every non-digit (the sign too) and read the rest as an int."""
    c = F.col(col) if isinstance(col, str) else col
    if dtype is not None and isinstance(dtype, NumericType):
        return c.try_cast("int")
    return F.regexp_replace(c.cast("string"), INTEGER_PATTERN, "").try_cast("int")
