"""Scalar expressions P9-P17 and the exact-mean helpers.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``; no
Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    """A column name or a Column, as a Column."""
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- dates

def day_from_int(c: ColumnOrName) -> Column:
    """YYYYMMDD integer → DATE; a malformed value gives NULL, not an error."""
    return F.try_to_date(as_col(c).cast("string"), "yyyyMMdd")


def is_weekend(day: ColumnOrName) -> Column:
    """Saturday or Sunday. ``weekday`` counts Monday=0 … Sunday=6 (P10)."""
    return F.weekday(as_col(day)) >= 5


def period(c: ColumnOrName, unit: str, int_digits: int | None = None) -> Column:
    """Year or month of a date key.

    Integer keys (YYYYMMDD / YYYYMMDDHHMMSS) are cut by integer division so
    the result stays a number; DATE / timestamp keys give ``year*100+month``.
    """
    if unit not in ("year", "month"):
        raise ValueError(f"unit must be 'year' or 'month', not {unit!r}")
    if int_digits:
        return period_of_int(c, unit, int_digits)
    return period_of_date(c, unit)


def period_of_int(c: ColumnOrName, unit: str, digits: int = 8) -> Column:
    """Year / month prefix of an integer YYYYMMDD… key."""
    drop = {"year": digits - 4, "month": digits - 6}[unit]
    return F.floor(as_col(c) / F.lit(10 ** drop)).cast("long")


def period_of_date(c: ColumnOrName, unit: str) -> Column:
    """Year, or ``year*100+month``, of a DATE / timestamp column."""
    c = as_col(c)
    if unit == "year":
        return F.year(c).cast("long")
    return (F.year(c) * 100 + F.month(c)).cast("long")


def starts_with(c: ColumnOrName, prefix: str) -> Column:
    """Prefix match on the text form of a column."""
    return as_col(c).cast("string").startswith(prefix)


def slice_floor(ts: ColumnOrName, minutes: int = 15, start: ColumnOrName | None = None) -> Column:
    """Floor a TIMESTAMP_NTZ to its ``minutes``-wide slice, counted from ``start``.

    Any width works: slices are counted in minutes from ``start`` (a TIMESTAMP_NTZ
    at a whole minute; 1970-01-01 by default), in days and minutes of the day, so
    no time zone plays a part.
    """
    ts = as_col(ts)
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) if start is None else as_col(start)
    passed = (F.datediff(F.to_date(ts), F.to_date(start)).cast("long") * 1440
              + F.hour(ts) * 60 + F.minute(ts) - F.hour(start) * 60 - F.minute(start))
    floored = F.floor(passed / F.lit(minutes)) * F.lit(minutes)
    return start + F.make_dt_interval(F.floor(floored / 1440).cast("int"), F.lit(0),
                                      F.pmod(floored, F.lit(1440)).cast("int"), F.lit(0))


def slice_from_file_name(name: ColumnOrName, pattern: str = r"^([0-9]{14})") -> Column:
    """Slice start from a ``YYYYMMDDHHMMSS…`` file name (TIMESTAMP_NTZ); NULL if malformed.

    ``pattern``'s first group must capture the 14-digit stamp.
    """
    stamp = F.regexp_extract(as_col(name), pattern, 1)

    def part(start: int, length: int) -> Column:
        return F.substring(stamp, start, length).cast("int")

    # Built from its parts: time-zone free, and an impossible date gives NULL.
    return F.when(stamp != F.lit(""),
                  F.try_make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2), part(9, 2),
                                           part(11, 2), part(13, 2)))


# ---------------------------------------------------------------- labels

def pair_label(a: ColumnOrName, b: ColumnOrName, sep: str = " → ") -> Column:
    """``"A → B"``; a missing side shows as an empty string, not a dropped one."""
    return F.concat(F.coalesce(as_col(a).cast("string"), F.lit("")), F.lit(sep),
                    F.coalesce(as_col(b).cast("string"), F.lit("")))


def entity_bucket(code: ColumnOrName, entity_type: ColumnOrName,
                  null_label: str = "null", unknown_label: str = "unknown_code") -> Column:
    """Null code / code absent from the dimension / its entity type."""
    return (F.when(as_col(code).isNull(), F.lit(null_label))
            .when(as_col(entity_type).isNull(), F.lit(unknown_label))
            .otherwise(as_col(entity_type)))


# ---------------------------------------------------------------- ratios

def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as DOUBLE; NULL when den is 0 or NULL (ANSI-safe, T5/T6)."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def pct(num: ColumnOrName, den: ColumnOrName) -> Column:
    """100 * num / den as DOUBLE, multiplied first; NULL when den is 0."""
    return F.try_divide(F.lit(100.0) * as_col(num).cast("double"), as_col(den).cast("double"))


def null_flag(c: ColumnOrName) -> Column:
    """1 when NULL, else 0."""
    return F.when(as_col(c).isNull(), F.lit(1)).otherwise(F.lit(0))


# ---------------------------------------------------------------- exact mean

def scaled_sum(c: ColumnOrName, scale: int = 4) -> Column:
    """Aggregate: sum of ``round(v * 10^scale)`` as BIGINT.

    A long sum is exact and independent of row order, so the mean is the same
    on every cluster layout and in any SQL engine, and it stays inside
    whole-stage codegen (a DECIMAL(28,4) buffer would not). Values are taken
    to ``scale`` decimals; NaN, infinities and values beyond the range of BIGINT
    fail the job, so use it where the data's scale is known.
    """
    return F.sum(F.round(as_col(c) * F.lit(float(10 ** scale))).cast("long"))


def mean_from_scaled(total: ColumnOrName, n: ColumnOrName, scale: int = 4) -> Column:
    """Finish an exact mean from ``scaled_sum`` and ``count`` partials."""
    return F.try_divide(F.try_divide(as_col(total).cast("double"), F.lit(float(10 ** scale))),
                        as_col(n).cast("double"))


def exact_mean(c: ColumnOrName, scale: int | None = None) -> Column:
    """Aggregate: order-independent mean to ``scale`` decimals; NULLs ignored.

    ``scale=None`` falls back to Spark's floating ``avg``.
    """
    if scale is None:
        return F.avg(as_col(c))
    return mean_from_scaled(scaled_sum(c, scale), F.count(as_col(c)), scale)
