"""Time functions. Timestamps are UTC instants; the session time zone is UTC
(``timestamp_ntz`` input is read as UTC wall-clock time)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.schemas import ANALYSIS_TZ


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def utc_instant(ntz_col) -> Column:
    """A ``timestamp_ntz`` holding UTC wall-clock time -> the instant
    (``timestamp``), whatever the session time zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), _c(ntz_col)).cast("timestamp")


def eastern_date(col, tz: str = ANALYSIS_TZ) -> Column:
    """Calendar date of an instant (``timestamp``) in ``tz``, DST aware and
    independent of the session time zone."""
    local = _c(col).cast("timestamp_ntz")  # wall clock in the session zone
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit(tz), local))


def instant(col) -> Column:
    """ISO-8601 text -> instant; text without an offset is UTC; null where it
    can't be parsed. Independent of the session time zone."""
    c = F.trim(_c(col).cast("string"))
    zoned = c.rlike(r"(?i)(z|[+-]\d{2}(:?\d{2})?)$") & c.contains(":")
    dated = F.when(c.contains(":"), F.concat(c, F.lit("Z"))).otherwise(F.concat(c, F.lit("T00:00:00Z")))
    return F.when(zoned, c).otherwise(dated).try_cast("timestamp")


def week_start(date_col) -> Column:
    """The strictly previous Sunday (a Sunday maps to the Sunday before)."""
    return F.next_day(F.date_sub(_c(date_col), 8), "Sun")


def trailing_window(df: DataFrame, ts_col: str, as_of, days: int = 60) -> DataFrame:
    """Rows with ``ts >= as_of - days``; ``as_of`` (a datetime or ISO string,
    UTC) is a parameter so results are repeatable. The literal has the
    column's own type (UTC wall clock for ``timestamp_ntz``, an instant for
    ``timestamp``), so the comparison needs no cast of the column and is
    pushed to the Parquet scan."""
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    cutoff = (as_of - _dt.timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S.%f")
    ntz = F.to_timestamp_ntz(F.lit(cutoff))
    is_ntz = isinstance(df.schema[ts_col].dataType, T.TimestampNTZType)
    return df.filter(_c(ts_col) >= (ntz if is_ntz else utc_instant(ntz)))


def format_rec_mod_dtm(col) -> Column:
    """Record-modification stamp (UTC) in the index's text format, whatever
    the session time zone."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), _c(col).cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd HH:mm:ss")
