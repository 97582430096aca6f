"""Date column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from harborlake.functions.text import ColumnOrName, as_column

# Fixed value: day zero of SAS day numbers.
SAS_EPOCH = date(1960, 1, 1)


def sas_date(days: ColumnOrName) -> Column:
    """Date of a SAS day number held as text or number (``20573.0`` -> 2016-04-29).

    Fractions are cut off; anything that is not a number of days gives null.
    """
    number = as_column(days).try_cast("double").try_cast("int")
    return F.date_add(F.lit(SAS_EPOCH), number)


def day_difference(end: ColumnOrName, start: ColumnOrName) -> Column:
    return F.datediff(as_column(end), as_column(start))


def calendar_parts(moment: ColumnOrName) -> dict[str, Column]:
    """Day of month, hour, ISO week and hour stamp of a timestamp, for ``withColumns``."""
    value = as_column(moment)
    return {
        "day": F.dayofmonth(value),
        "hour": F.hour(value),
        "week": F.weekofyear(value),
        "hour_stamp": F.date_format(value, "yyyy-MM-dd HH"),
    }


def exact_avg(value: ColumnOrName, scale: int | None = None) -> Column:
    """Average that ignores nulls, and NaN as if it were null.

    A sum of doubles depends on the order in which tasks finish. With ``scale``, the
    number of decimals the data has, the sum is taken over decimals, so the result is
    the same on every run and every cluster size. Six more decimals are kept, so values that
    are finer than announced are not cut.
    """
    measure = as_column(value)
    measure = F.when(~F.isnan(measure.cast("double")), measure)
    if scale is None:
        return F.avg(measure)
    exact = measure.cast(f"decimal(28,{scale + 6})")
    return F.try_divide(F.sum(exact).cast("double"), F.count(exact).cast("double"))
