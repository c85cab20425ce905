"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsgrid.schema import MEASURES, SEASON_LABELS


def season(month: Column | str = "month") -> Column:
    """Season number = calendar quarter of the month, 1..4 (int)."""
    m = F.col(month) if isinstance(month, str) else month
    return F.ceil(m / F.lit(3)).cast("int")


def season_label(season_col: Column | str = "season", labels: Mapping[int, str] = SEASON_LABELS) -> Column:
    """Label a season number by key (a missing season stays a missing row)."""
    s = F.col(season_col) if isinstance(season_col, str) else season_col
    pairs = []
    for k, v in sorted(labels.items()):
        pairs += [F.lit(int(k)), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), s)


def with_calendar(df: DataFrame, ts: str = "valid_date") -> DataFrame:
    """Add year..minute from ``ts`` where they are not stored already.

    A frame without ``ts`` keeps the calendar columns it has (say, year and
    month only); it must hold year and month.
    """
    have = set(df.columns)
    if ts not in have:
        missing = [c for c in ("year", "month") if c not in have]
        if missing:
            raise ValueError(f"need {ts!r} or stored {missing} columns")
        return df
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour, "minute": F.minute}
    for name, fn in parts.items():
        if name not in have:
            df = df.withColumn(name, fn(ts).cast("int"))
    return df


def with_season(df: DataFrame) -> DataFrame:
    if "season" in df.columns:
        return df
    if "month" not in df.columns:
        df = with_calendar(df)
    return df.withColumn("season", season("month"))


def all_present(cols: Iterable[str]) -> Column:
    """TRUE when none of ``cols`` is NULL. NaN and 0 count as present."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def complete_rows(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep rows where every listed column is non-NULL (not ``dropna``: NaN stays)."""
    return df.where(all_present(cols))


def display_round(c: str, dtype: T.DataType, digits: int = 2) -> Column:
    """Round a shown value to ``digits`` decimals when it is numeric; leave others."""
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.bround(F.col(c).cast("double"), digits)
    return F.col(c)


def month_bounds(first_month: str, last_month: str, compat_end: bool = False) -> tuple[dt.datetime, dt.datetime, bool]:
    """Bounds of the month range ``'YYYY-MM'..'YYYY-MM'`` as (lo, hi, hi_inclusive).

    Default: half-open ``[first day of first month, first day after the last month)``.
    ``compat_end``: the end is day 31 at 00:00 inclusive when the last month has a
    31st, otherwise the whole last month.
    """
    def ym(text: str) -> tuple[int, int]:
        parts = text.split("-")
        if len(parts) < 2 or not (parts[0].strip().isdigit() and parts[1].strip().isdigit()) \
                or not 1 <= int(parts[1]) <= 12:
            raise ValueError(f"month {text!r} is not 'YYYY-MM'")
        return int(parts[0]), int(parts[1])

    y0, m0 = ym(first_month)
    y1, m1 = ym(last_month)
    lo = dt.datetime(y0, m0, 1)
    nxt = dt.datetime(y1 + (m1 == 12), m1 % 12 + 1, 1)
    if compat_end:
        last_day = (nxt - dt.timedelta(days=1)).day
        if last_day == 31:
            return lo, dt.datetime(y1, m1, 31), True
    return lo, nxt, False


def ts_literal(value: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (independent of the session time zone)."""
    return F.make_timestamp_ntz(
        F.lit(value.year), F.lit(value.month), F.lit(value.day),
        F.lit(value.hour), F.lit(value.minute), F.lit(value.second),
    )


def require_measure(df: DataFrame, name: str, numeric: bool = False, measures: Sequence[str] = MEASURES) -> str:
    """Check a measure picked by name (P5): one of ``measures``, in the frame, and a number if asked."""
    if name not in measures:
        raise ValueError(f"unknown measure {name!r}; pick one of {', '.join(measures)}")
    if name not in df.columns:
        raise ValueError(f"the observations have no column {name!r}")
    if numeric and not isinstance(df.schema[name].dataType, T.NumericType):
        raise ValueError(f"measure {name!r} is {df.schema[name].dataType.simpleString()}, not numeric")
    return name


def round_scaled(c: Column | str, digits: int) -> Column:
    """round(x * 10^digits) / 10^digits, half away from zero, in double arithmetic.

    The same arithmetic SQL engines commonly use for round(double, d), so a
    value on a tie rounds the same way in both.
    """
    col = F.col(c) if isinstance(c, str) else c
    scale = F.lit(float(10 ** digits))
    return F.round(col * scale, 0) / scale
