"""Cleaning of category and money text, names and time formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The patterns removed from categories and from money text.
PREFIX = "z_"
PREFIX_OR_LESS_THAN = "z_|<"
MONEY_SIGNS = r"\$|,"
# Fixed value: day-month-year with the time in brackets.
TIME_FORMAT = "dd-MMM-yyyy (HH:mm:ss.SSSSSS)"


def strip_pattern(column: Column, pattern: str = PREFIX) -> Column:
    """Remove every match of ``pattern``, wherever it stands in the text."""
    return F.regexp_replace(column, pattern, "")


def money_to_double(column: Column) -> Column:
    """``$1,234.50`` becomes 1234.5; text that is no number becomes NULL."""
    return F.regexp_replace(column, MONEY_SIGNS, "").try_cast("double")


def clean_columns(df: DataFrame, strip: dict[str, str], money: list[str]) -> DataFrame:
    """Clean category columns (name -> pattern) and money columns in one projection.

    Untouched columns come first in their order, then the cleaned ones in the order given.
    """
    touched = [*strip, *money]
    missing = [c for c in touched if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    if len(set(touched)) < len(touched):
        raise ValueError("a column is listed twice")
    return df.select(
        *[F.col(c) for c in df.columns if c not in touched],
        *[strip_pattern(F.col(c), pattern).alias(c) for c, pattern in strip.items()],
        *[money_to_double(F.col(c)).alias(c) for c in money],
    )


def padded_name(prefix: str, number: Column, width: int = 2) -> Column:
    """``prefix`` followed by ``number``, zero-padded to ``width`` but never cut."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def padded_names(prefix: str, count: int, width: int = 2) -> list[str]:
    """The same names as Python strings, numbered from 1."""
    return [f"{prefix}{n:0{width}d}" for n in range(1, count + 1)]


def format_time(column: Column) -> Column:
    """A timestamp as ``05-Mar-2024 (13:07:59.123456)``."""
    return F.date_format(column, TIME_FORMAT)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end``, one decimal."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.round(micros / F.lit(1e6), 1)


def scale(column: Column, factor: float) -> Column:
    """``column`` times ``factor``; NULL stays NULL."""
    return column * F.lit(factor)
