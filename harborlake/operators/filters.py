"""Row filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from harborlake.functions.dates import day_difference


def _as_of(as_of: date | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def recent(df: DataFrame, date_column: str, max_days: int, as_of: date | Column | None = None) -> DataFrame:
    """Rows dated less than ``max_days`` days before ``as_of`` (today by default).

    Future dates stay, null dates go. The column is compared with a constant, so a
    Parquet scan skips row groups and a table partitioned by the date skips directories.
    A timestamp is compared by its date: it must not lie before the day after the bound.
    """
    column = F.col(date_column)
    kind = df.schema[date_column].dataType
    first_day = F.date_sub(_as_of(as_of), max_days - 1)
    if isinstance(kind, T.DateType):
        return df.where(column >= first_day)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return df.where(column >= first_day.cast(kind))
    return df.where(column.try_cast("date") >= first_day)  # other text is no date


def recent_by_difference(
    df: DataFrame, date_column: str, max_days: int, as_of: date | Column | None = None
) -> DataFrame:
    """Same rows as :func:`recent`, with the number of days kept as ``date_diff``.

    The comparison bound goes to the scan; the difference is computed for kept rows only.
    """
    return recent(df, date_column, max_days, as_of).withColumn(
        "date_diff", day_difference(_as_of(as_of), date_column)
    )


def lines_matching(df: DataFrame, text_column: str, pattern: str) -> DataFrame:
    """Rows whose text contains a match of the regular expression."""
    return df.where(F.col(text_column).rlike(pattern))
