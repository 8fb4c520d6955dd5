"""Calendar functions: local business date and commercial month.

None of them read the session time zone, so results do not depend on how
the cluster is configured.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The business runs on this zone; every timestamp that carries an offset is
# re-expressed in it before taking the calendar date (fixed value).
BUSINESS_TZ = "America/Argentina/Buenos_Aires"

# First day of a commercial month (days 1..5 belong to the previous month).
COMMERCIAL_MONTH_FIRST_DAY = 6

_DAY_MICROS = 86_400_000_000
_BARE_DATE = r"^\d{4}-\d{2}-\d{2}$"
_HAS_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def wall_date_of_instant(ts: Column, tz: str = BUSINESS_TZ) -> Column:
    """Calendar date of an instant as seen in ``tz``.

    ``from_utc_timestamp`` shifts the epoch micros by the zone offset valid at
    that instant; flooring the shifted micros to days gives the wall date
    without involving the session zone.
    """
    shifted = F.unix_micros(F.from_utc_timestamp(ts, tz))
    return F.date_from_unix_date(F.floor(shifted / F.lit(_DAY_MICROS)).cast("int"))


def local_date(x, tz: str = BUSINESS_TZ, dtype: T.DataType | None = None) -> Column:
    """Business calendar date of a text or timestamp value.

    * ``'2026-08-19'`` (no time) → that date, unchanged;
    * text with an offset (``-04:00``, ``+0000``, ``Z``) → converted to ``tz``;
    * text with a time but no offset → already local, date part;
    * ``TIMESTAMP`` (an instant) → converted; ``TIMESTAMP_NTZ`` → date part;
    * anything unparsable → null.
    """
    c = _c(x)
    if isinstance(dtype, T.TimestampType):
        return wall_date_of_instant(c, tz)
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return F.to_date(c)
    s = F.trim(c.cast("string"))
    return (F.when(s.rlike(_BARE_DATE), s.try_cast("date"))
             .when(s.rlike(_HAS_OFFSET), wall_date_of_instant(s.try_cast("timestamp"), tz))
             .otherwise(F.to_date(s.try_cast("timestamp_ntz"))))


def commercial_month(d) -> Column:
    """``yyyy-MM`` of the commercial month: day ≥ 6 → same month, else the
    previous one.  Null → null."""
    d = _c(d)
    shift = F.when(F.dayofmonth(d) >= COMMERCIAL_MONTH_FIRST_DAY, 0).otherwise(-1)
    first = F.add_months(d, shift)
    return month_text(F.year(first), F.month(first), F.date_format(first, "yyyy-MM"))


def month_text(year: Column, month: Column, otherwise: Column) -> Column:
    """``yyyy-MM`` of numbers, put together without a formatter; ``otherwise`` for a null
    and for years that are not of four digits."""
    text = F.concat(year.cast("string"), F.when(month < 10, F.lit("-0")).otherwise(F.lit("-")), month.cast("string"))
    return F.when(year.between(1000, 9999), text).otherwise(otherwise)


def text_floor(cutoff_date, slack_days: int = 1) -> str:
    """Sargable floor for an ISO-text date column: compare the raw text to
    ``cutoff − slack`` (so a predicate reaches Parquet statistics) and apply the
    exact ``local_date >= cutoff`` filter afterwards."""
    import datetime as _dt

    return (cutoff_date - _dt.timedelta(days=slack_days)).isoformat()
