"""Date handling: local days at a fixed offset, date windows, date cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: offset of the reporting zone (Asia/Kolkata), which has no DST.
IST_MINUTES = 330


def minutes(n: int | Column) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))


def local_time(ts: Column, offset_minutes: int = IST_MINUTES) -> Column:
    """Shift a UTC time without zone to local wall-clock time."""
    return ts + minutes(offset_minutes)


def local_day(ts: Column, offset_minutes: int = IST_MINUTES) -> Column:
    return local_time(ts, offset_minutes).cast("date")


def minute_diff(later: Column, earlier: Column) -> Column:
    """Whole minutes between two times, rounded down."""
    return F.floor(second_diff(later, earlier) / 60).cast("long")


def second_diff(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("SECOND", earlier, later)


def _rolled_date(s: Column, pattern: str, y: int, m: int, d: int) -> Column:
    """A numeric date as text; a day past the month's end rolls into the next."""
    year, month, day = (F.regexp_extract(s, pattern, g).try_cast("int") for g in (y, m, d))
    first = F.when(month.between(1, 12) & day.between(1, 31), F.make_date(year, month, F.lit(1)))
    return F.date_add(first, day - 1).cast("string")


def normalize_date(s: Column, offset_minutes: int = IST_MINUTES) -> Column:
    """ISO dates stay; a full timestamp becomes its local date; month-first and
    slashed numeric dates are read as local dates; otherwise a leading date is
    cut out; anything else is returned unchanged."""
    iso = s.rlike(r"^\d{4}-\d{2}-\d{2}\z")
    zoned = s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})\z")
    bare = s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\z")
    wall = F.regexp_extract(s, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)", 1)
    sign = F.when(F.regexp_extract(s, r"([+-])\d{2}:\d{2}\z", 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    hh = F.regexp_extract(s, r"[+-](\d{2}):\d{2}\z", 1).try_cast("int")
    mm = F.regexp_extract(s, r"[+-]\d{2}:(\d{2})\z", 1).try_cast("int")
    own_offset = F.when(s.endswith("Z"), F.lit(0)).otherwise(sign * (hh * 60 + mm))
    wall_ts = wall.try_cast("timestamp_ntz")
    shifted = wall_ts + minutes(F.lit(offset_minutes) - own_offset)
    lead = F.regexp_extract(s, r"^(\d{4}-\d{2}-\d{2})", 1)
    mdy, ymd = r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})\z", r"^(\d{4})/(\d{1,2})/(\d{1,2})\z"
    by_month = _rolled_date(s, mdy, 3, 1, 2)
    by_year = _rolled_date(s, ymd, 1, 2, 3)
    return (
        F.when(iso, s)
        .when(zoned & shifted.isNotNull(), shifted.cast("date").cast("string"))
        .when(bare & wall_ts.isNotNull(), wall_ts.cast("date").cast("string"))
        .when(by_month.isNotNull(), by_month)
        .when(by_year.isNotNull(), by_year)
        .when(lead != "", lead)
        .otherwise(s)
    )


def widen_end(from_day: Column, to_day: Column) -> Column:
    """A single-day window ends at the last second of that day."""
    single = (from_day == to_day) & ~to_day.contains("T")
    return F.when(single, F.concat(to_day, F.lit("T23:59:59"))).otherwise(to_day)


def serial_to_date(n: Column) -> Column:
    """Spreadsheet day number to date (day 25569 is 1970-01-01)."""
    return F.date_add(F.lit("1970-01-01").cast("date"), (F.floor(n) - 25569).cast("int"))
