"""Date helpers.  The clock is always an explicit ``as_of`` date, never
``current_timestamp()``, so a run is reproducible and testable."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the reference's rolling-window units, in days
UNIT_DAYS = {"day": 1, "month": 30, "year": 365}


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clock(as_of) -> _dt.datetime:
    """The reference time: a date means its midnight, a timestamp (or ISO
    text with a time) is used as is, like the reference's ``now``."""
    if isinstance(as_of, _dt.datetime):
        return as_of
    if isinstance(as_of, _dt.date):
        return _dt.datetime(as_of.year, as_of.month, as_of.day)
    return _dt.datetime.fromisoformat(str(as_of))


def as_date(as_of) -> _dt.date:
    return clock(as_of).date()


def compact_date(col: Column | str) -> Column:
    """date / timestamp -> ``yyyyMMdd`` int (1982-01-11 -> 19820111)."""
    return F.date_format(_c(col), "yyyyMMdd").cast("int")


def compact_text_date(col: Column | str) -> Column:
    """``yyyy-MM-dd`` text -> ``yyyyMMdd`` int; malformed text -> null."""
    digits = F.regexp_replace(_c(col), "-", "")
    return F.when(digits.rlike(r"^\d{8}$"), digits.cast("int"))


def epoch_to_ts(col: Column | str) -> Column:
    """epoch seconds (number or numeric text) -> timestamp."""
    c = _c(col)
    return F.when(c.cast("string").rlike(r"^\s*-?\d+\s*$"),
                  F.timestamp_seconds(c.cast("string").cast("long")))


def days_since(ts: Column | str, as_of) -> Column:
    """Calendar days from the date of ``ts`` to ``as_of``."""
    return F.datediff(F.lit(as_date(as_of)), F.to_date(_c(ts)))


def window_bounds(amount: int, unit: str, as_of) -> tuple[_dt.date, _dt.date]:
    """Rolling window ``field#unit#amount``: inclusive date bounds
    ``[as_of - 1 - amount*unit_days, as_of - 1]`` (yesterday backwards)."""
    if unit not in UNIT_DAYS:
        raise ValueError(f"unknown window unit {unit!r}; expected one of {sorted(UNIT_DAYS)}")
    if int(amount) < 0:
        raise ValueError("window amount must be >= 0")
    yesterday = as_date(as_of) - _dt.timedelta(days=1)
    return yesterday - _dt.timedelta(days=int(amount) * UNIT_DAYS[unit]), yesterday


def event_time(df, col: str) -> Column:
    """The event-time column as a timestamp: typed dates / timestamps pass
    through; numbers are epoch seconds; text is epoch seconds when all
    digits, else a timestamp literal (malformed text -> null)."""
    from pyspark.sql import types as T
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c
    if isinstance(dtype, T.NumericType):
        return F.timestamp_seconds(c.cast("long"))
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(r"^-?\d+$"), F.timestamp_seconds(text.cast("long"))) \
        .otherwise(F.try_to_timestamp(text))


def _typed_time(dtype) -> bool:
    from pyspark.sql import types as T
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))


def with_event_time(df, ts_col: str):
    """``df`` with ``ts_col`` as a date / timestamp (converted only when it is
    text or a number, so typed columns keep their Parquet pushdown)."""
    if _typed_time(df.schema[ts_col].dataType):
        return df
    return df.withColumn(ts_col, event_time(df, ts_col))


def is_before_clock(df, ts_col: str, as_of) -> Column:
    """Condition ``ts_col`` strictly before the clock (``as_of`` as a date =
    its midnight, or a timestamp); ``ts_col`` must be a date or timestamp
    (see ``with_event_time``).  Compared with a typed literal."""
    from pyspark.sql import types as T
    t = clock(as_of)
    dtype = df.schema[ts_col].dataType
    col = F.col(ts_col)
    if isinstance(dtype, T.DateType):
        day = F.lit(t.date())
        return col < day if t.time() == _dt.time(0) else col <= day
    if not _typed_time(dtype):
        raise TypeError(f"{ts_col} is {dtype.simpleString()}; convert it with with_event_time first")
    return col < F.lit(t.isoformat(sep=" ")).cast(dtype)


def before_as_of(df, ts_col: str, as_of):
    """Rows before the clock with ``ts_col`` as a date / timestamp.  A typed
    column is compared with a typed literal, so Parquet gets it as a pushed
    filter; other columns are converted first."""
    out = with_event_time(df, ts_col)
    return out.where(is_before_clock(out, ts_col, as_of))
