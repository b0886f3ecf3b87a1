"""Date and time column functions (SCL-11..14).

Timestamps are parsed row by row (the first format that fits wins), so one
column may mix RFC-822 feed dates and ISO-8601 API dates.  ``try_to_timestamp``
keeps ANSI mode from raising on bad input; unparsable values become NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicloom.functions.fixed import BANNER_MONTHS

# Accepted published_at formats, tried in order after the weekday prefix is cut.
PUBLISHED_FORMATS = [
    "dd MMM yyyy HH:mm:ss z",      # 01 Jan 2024 05:30:00 GMT
    "dd MMM yyyy HH:mm:ss Z",      # 01 Jan 2024 05:30:00 +0200
    "yyyy-MM-dd'T'HH:mm:ssXXX",    # 2024-01-01T05:00:00Z / +02:00
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
]
# Zone-less forms are read as UTC (decision D4), whatever the session time zone.
ZONELESS_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
]
# Literal characters of the formats: the first that a format has tells whether it can fit.
MUST_HAVE = ("-", " ")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_published(col: Column | str) -> Column:
    """SCL-11: string -> UTC timestamp, NULL when no format fits.

    The weekday of RFC-822 dates is dropped rather than validated (Spark's
    parser rejects ``EEE`` pattern letters and feeds get it wrong anyway).  A format that
    can't fit is not tried, as each failure raises an exception inside: all begin with a
    number and have ``MUST_HAVE``'s character where their pattern has it.
    """
    s = F.trim(F.regexp_replace(_c(col), r"^[A-Za-z]{3},\s*", ""))

    def tried(fmt: str, parsed: Column) -> Column:
        return F.when(F.instr(s, next(c for c in MUST_HAVE if c in fmt)) > 0, parsed)

    zoned = [tried(f, F.try_to_timestamp(s, F.lit(f))) for f in PUBLISHED_FORMATS]
    utc = [tried(f, F.try_to_timestamp(F.concat(s, F.lit(" +0000")), F.lit(f + " Z"))) for f in ZONELESS_FORMATS]
    return F.when(s.rlike(r"^[\p{Nd}+-]"), F.coalesce(*zoned, *utc))


def utc_wall_clock(ts: Column | str) -> Column:
    """A timestamp whose session-zone rendering is its UTC wall clock, so
    hour / day-name extraction is UTC independent of ``spark.sql.session.timeZone``."""
    return F.to_utc_timestamp(_c(ts), F.current_timezone())


def publication_hour(ts: Column | str) -> Column:
    """SCL-12: hour of day 0-23 in UTC."""
    return F.hour(utc_wall_clock(ts))


def publication_day_of_week(ts: Column | str) -> Column:
    """SCL-12: English day name (UTC), NULL for NULL."""
    return F.date_format(utc_wall_clock(ts), "EEEE")


def time_features(df, src: str = "published_at"):
    parsed = parse_published(src)
    return (
        df.withColumn("published_at_parsed", parsed)
        .withColumn("publication_hour", publication_hour("published_at_parsed"))
        .withColumn("publication_day_of_week", publication_day_of_week("published_at_parsed"))
    )


def banner_date(col: Column | str) -> Column:
    """SCL-13: ``YYYY-MM-DD`` -> ``DD.MON.YYYY`` with the dashboard's month labels;
    anything unparsable is returned unchanged."""
    s = _c(col)
    d = F.try_to_date(s, "yyyy-MM-dd")
    months = F.array(*[F.lit(m) for m in BANNER_MONTHS])
    formatted = F.format_string("%02d.%s.%d", F.dayofmonth(d), F.element_at(months, F.month(d)), F.year(d))
    return F.when(d.isNull(), s).otherwise(formatted)


def window_start(run_date: Column | str, days: int = 3) -> Column:
    """SCL-14: first day of an inclusive ``days``-long window ending at run_date."""
    return F.date_sub(F.to_date(_c(run_date)), days - 1)
