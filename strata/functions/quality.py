"""Shared data-quality rules as Spark column expressions.

Everything here is a built-in ``pyspark.sql.functions`` expression, so it is
evaluated inside whole-stage code generation; no Python runs per row.  Full
refresh and incremental jobs both use these rules, so a value is cleaned the
same way on either path (SURVEY §2.14-2/3/4).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Fixed values that must equal the reference's for equal results.
CUSTOMER_ID_PATTERN = r"^CUST_\d+$"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
LINE_TOTAL_TOLERANCE = 0.01
DEFAULT_MARK = datetime(1900, 1, 1)  # first-run high-water mark

FRACTION = "fraction"
PERCENT = "percent"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """A boolean flag that is never NULL: an unknown condition is false."""
    return F.coalesce(condition, F.lit(False))


def trimmed(names: list[str]) -> dict[str, Column]:
    """Strip leading and trailing spaces (tabs and newlines stay)."""
    return {n: F.trim(F.col(n)) for n in names}


def normalized_email(c: Column | str = "email") -> Column:
    return F.lower(F.trim(col(c)))


def valid_email(c: Column | str = "email") -> Column:
    """Checked on the normalized value: `` A@B.co `` is valid."""
    return flag(normalized_email(c).rlike(EMAIL_PATTERN))


def valid_customer_id(c: Column | str = "customer_id") -> Column:
    """Ids are not trimmed first: a padded id fails the pattern."""
    return col(c).isNotNull() & col(c).rlike(CUSTOMER_ID_PATTERN)


def clamp_at_zero(c: Column | str, dtype: DataType) -> Column:
    """Negative values become 0 in the column's own type; NULL stays NULL."""
    c = col(c)
    return F.when(c < 0, F.lit(0).cast(dtype)).otherwise(c)


def clamped(df: DataFrame, names: list[str]) -> dict[str, Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return {n: clamp_at_zero(n, types[n]) for n in names}


def discount_upper(unit: str) -> float:
    if unit not in (FRACTION, PERCENT):
        raise ValueError(f"discount unit must be {FRACTION!r} or {PERCENT!r}, not {unit!r}")
    return 1.0 if unit == FRACTION else 100.0


def clamped_discount(c: Column | str = "discount_pct", unit: str = FRACTION) -> Column:
    """Discount forced into [0, 1] (fraction) or [0, 100] (percent)."""
    c = col(c)
    upper = discount_upper(unit)
    return F.when(c < 0, F.lit(0.0)).when(c > upper, F.lit(upper)).otherwise(c.cast("double"))


def discount_fraction(c: Column | str = "discount_pct", unit: str = FRACTION) -> Column:
    """The discount as a fraction, NULL read as no discount."""
    return F.coalesce(col(c), F.lit(0.0)) / F.lit(discount_upper(unit))


def expected_line_total(
    quantity: str = "quantity",
    unit_price: str = "unit_price",
    discount: str = "discount_pct",
    unit: str = FRACTION,
) -> Column:
    """quantity * unit_price * (1 - discount), as a double."""
    return (
        F.col(quantity).cast("double")
        * F.col(unit_price).cast("double")
        * (F.lit(1.0) - discount_fraction(discount, unit))
    )


def line_total_matches(line_total: str = "line_total", expected: str = "calculated_line_total") -> Column:
    return flag(F.abs(F.col(line_total).cast("double") - F.col(expected)) < LINE_TOTAL_TOLERANCE)


def line_checks(df: DataFrame, unit: str = FRACTION) -> DataFrame:
    """Clamp quantity / price / discount, then derive the line-level flags.

    ``withColumns`` replaces columns in place, so the flags are computed on
    the clamped values, as in the reference.
    """
    df = df.withColumns({**clamped(df, ["quantity", "unit_price"]), "discount_pct": clamped_discount(unit=unit)})
    df = df.withColumn("calculated_line_total", expected_line_total(unit=unit))
    return df.withColumns(
        {
            "is_valid_line_total": line_total_matches(),
            "has_discount": flag(F.col("discount_pct") > 0),
            "is_returned": flag(F.col("return_flag") == F.lit(True)),
        }
    )


def parsed_timestamp(c: Column | str, formats: tuple[str, ...]) -> Column:
    """First format that parses wins; unparsable text becomes NULL.

    Returns a TIMESTAMP_NTZ (wall-clock time, no zone), like the driver's
    parquet timestamps.
    """
    c = col(c)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats])


def parsed_date(c: Column | str, formats: tuple[str, ...]) -> Column:
    """First date format that parses wins; unparsable text becomes NULL."""
    return parsed_timestamp(c, formats).cast("date")


def wall_clock(value: datetime) -> Column:
    """A TIMESTAMP_NTZ literal built from its text, so neither the Python
    process's nor the session's time zone can shift it."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def batch_time(batch_ts: datetime | None) -> Column:
    """One processing timestamp per run."""
    if batch_ts is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return wall_clock(batch_ts)


def safe_ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """numerator / denominator * scale as a double; NULL when dividing by 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double")) * F.lit(scale)
