"""Column builders for the scalar functions of the engine.

Every function returns a ``Column`` made of built-in expressions, so it
stays inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- dates and times ----------------------------------------------------------

def session_date(ts="DateTime") -> Column:
    return F.to_date(col(ts))


def hour(ts="DateTime") -> Column:
    return F.hour(col(ts))


def minute(ts="DateTime") -> Column:
    return F.minute(col(ts))


def day_of_week(ts="DateTime") -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col(ts))


def cyclic_hour(ts="DateTime") -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*hour/24."""
    a = F.hour(col(ts)) * F.lit(2 * math.pi / 24)
    return F.sin(a), F.cos(a)


def wall_micros(ts="DateTime") -> Column:
    """Microseconds since 1970 of the wall-clock time, read as UTC.

    Built from the fields of a TIMESTAMP_NTZ value, so it does not depend
    on the session time zone (a cast to TIMESTAMP would, and gaps across a
    daylight-saving change would shift). A TIMESTAMP input is first taken
    as its wall time in the session zone, like the reference's naive times.
    """
    t = col(ts).cast("timestamp_ntz")
    days = F.unix_date(F.to_date(t)).cast("long")
    hms = (F.hour(t) * 3600 + F.minute(t) * 60).cast("long")
    sec = F.extract(F.lit("SECOND"), t)            # seconds with microseconds
    return (days * 86_400 + hms) * 1_000_000 + (sec * 1_000_000).cast("long")


def epoch_seconds(ts="DateTime") -> Column:
    """Seconds since 1970 as a double (wall time as UTC); null stays null."""
    return wall_micros(ts) / F.lit(1_000_000.0)


def parse_datetime(c, fmt: str | None = None) -> Column:
    """String to timestamp; bad values become null (``errors='coerce'``)."""
    if fmt is None:
        return F.try_to_timestamp(col(c))
    return F.try_to_timestamp(col(c), F.lit(fmt))


def parse_datetime_dayfirst(c) -> Column:
    """Day-first text such as ``31/12/2017 23:59``; other forms via ISO."""
    return F.coalesce(
        F.try_to_timestamp(col(c), F.lit("d/M/yyyy H:mm[:ss]")),
        F.try_to_timestamp(col(c), F.lit("d-M-yyyy H:mm[:ss]")),
        F.try_to_timestamp(col(c)),
    )


# Fixed values that must equal the reference's: the five time-of-day bins.
# Morning [8, 13), Afternoon [13, 18), Evening [18, 21),
# Night [21, 24) or [0, 1), Early Morning [1, 8), null -> Unknown.
TIME_OF_DAY_BINS = [
    ("Morning", 8, 13),
    ("Afternoon", 13, 18),
    ("Evening", 18, 21),
    ("Night", 21, 1),
    ("Early Morning", 1, 8),
]


def time_of_day(ts="DateTime") -> Column:
    h = F.hour(col(ts))
    expr = None
    for name, lo, hi in TIME_OF_DAY_BINS:
        cond = ((h >= lo) | (h < hi)) if lo > hi else ((h >= lo) & (h < hi))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("Unknown"))


def early_morning(ts="DateTime") -> Column:
    """2 <= hour < 6, or 6:00 to 6:30 inclusive."""
    h, m = F.hour(col(ts)), F.minute(col(ts))
    return ((h > 1) & (h < 6)) | ((h == 6) & (m <= 30))


# -- numbers ------------------------------------------------------------------

def clip_upper(c, upper) -> Column:
    """pandas ``clip(upper=n)``: null stays null (``least`` alone skips nulls)."""
    c = col(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(c, F.lit(upper)))


def ceil(c) -> Column:
    return F.ceil(col(c))


def round_half_even(c, scale: int = 0) -> Column:
    """Python ``round``: banker's rounding."""
    return F.bround(col(c), scale)


def safe_ratio(num, den) -> Column:
    """num / den as double, null when den is 0 or null."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


# -- conditions, labels, nulls -------------------------------------------------

def select_case(pairs, default=None) -> Column:
    """First true condition wins, like ``np.select``."""
    expr = None
    for cond, val in pairs:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return expr.otherwise(d)


def format_key(*parts, sep: str = "_") -> Column:
    """String key made of the parts; numbers printed as integers."""
    return F.concat_ws(sep, *[col(p).cast("string") for p in parts])


def behavior_label(sessions, clicks) -> Column:
    """``"{n}_sessions_{k}_clicks"``."""
    return F.concat(col(sessions).cast("string"), F.lit("_sessions_"),
                    col(clicks).cast("string"), F.lit("_clicks"))


def is_missing(c) -> Column:
    return col(c).isNull()


def is_present(c) -> Column:
    return col(c).isNotNull()


def fill_null(c, value) -> Column:
    return F.coalesce(col(c), F.lit(value))


def null_if(c, value) -> Column:
    return F.nullif(col(c), F.lit(value))


def value_sort_key(df: DataFrame, c: str) -> Column:
    """A double that orders a column's values like the column itself (exact
    for integers below 2**53 and microsecond timestamps); null for text."""
    t = df.schema[c].dataType
    if isinstance(t, T.TimestampNTZType):
        return wall_micros(c).cast("double")
    if isinstance(t, T.TimestampType):
        return F.unix_micros(F.col(c)).cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(c)).cast("double")
    if isinstance(t, (T.NumericType, T.BooleanType)):
        return F.col(c).cast("double")
    return F.lit(None).cast("double")
