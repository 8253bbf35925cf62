"""Load time. It is an argument of every feed, so a re-run gives the same rows."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: zone of the validity columns (US Central, daylight saving included).
DEFAULT_ZONE = "America/Chicago"

LoadTime = datetime | str | Column


# An offset or zone at the end of a time of day.
OFFSET = r"\d{1,2}:\d{2}.*(Z|[+-]\d{1,2}(:?\d{2}){0,2}|[A-Za-z]+(/[A-Za-z_]+)*)$"


def utc_wall(instant: Column) -> Column:
    """The UTC wall clock (timestamp_ntz) of a timestamp. The session's zone takes no part."""
    seconds = (F.unix_micros(instant).cast("decimal(24, 0)") / 1_000_000).cast("decimal(18, 6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def instant_of(wall: Column, zone: str = "UTC") -> Column:
    """The timestamp at which the clocks of ``zone`` show ``wall``; the session's zone takes no part."""
    utc = wall if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    days = F.datediff(F.to_date(utc), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = F.hour(utc) * 3600 + F.minute(utc) * 60
    micros = (F.date_part(F.lit("SECOND"), utc) * 1_000_000).cast("bigint")
    return F.timestamp_micros((days * 86_400 + seconds) * 1_000_000 + micros)


def utc_time(load_ts: LoadTime) -> Column:
    """Load time as a UTC wall-clock value that no session time zone can shift.

    Without zone a value is UTC already. An aware datetime, a timestamp column and text that ends in
    an offset or zone name an instant, which is told in UTC.
    """
    if isinstance(load_ts, str):
        try:
            load_ts = datetime.fromisoformat(load_ts)
        except ValueError:
            load_ts = F.lit(load_ts)  # Spark reads more spellings
    if isinstance(load_ts, datetime):
        if load_ts.tzinfo is not None:
            load_ts = load_ts.astimezone(UTC).replace(tzinfo=None)
        return F.lit(load_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    kind = F.typeof(load_ts)
    zoned = (kind == "timestamp") | ((kind == "string") & load_ts.cast("string").rlike(OFFSET))
    return F.when(zoned, utc_wall(load_ts.cast("timestamp"))).otherwise(load_ts.cast("timestamp_ntz"))


def local_time(load_ts: LoadTime, zone: str = DEFAULT_ZONE) -> Column:
    """The same instant on the wall clock of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_time(load_ts))
