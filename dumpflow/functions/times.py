"""Dates in file names and the time-stamp shapes found in dump data.

All results are UTC whatever the session time zone is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dumpflow.fixed_values import FILE_DATE_PATTERNS

_DUMP_STAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,6})?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"


def file_date_text(file_name: Column) -> Column:
    """`YYYY-MM-DD` from a dump file name, the first day when it names only a month."""
    found = []
    for pattern in FILE_DATE_PATTERNS:
        day = "$3" if pattern.count("(\\d{") == 3 else "01"
        # One pass per pattern: the whole name is replaced by the date when it matches.
        found.append(
            F.when(
                file_name.rlike(pattern),
                F.regexp_replace(file_name, rf"(?s)^.*?{pattern}.*$", f"$1-$2-{day}"),
            )
        )
    return F.coalesce(*found)


def file_date(file_name: Column) -> Column:
    """Date in a dump file name; NULL if there is none or it is no real date."""
    return file_date_text(file_name).try_cast("date")


def file_year_month(file_name: Column) -> Column:
    return F.substring(file_date_text(file_name), 1, 7)


def file_wiki_code(file_name: Column) -> Column:
    """Wiki code that starts a dump file name, or follows `clickstream-`; NULL if none."""
    return F.nullif(F.regexp_extract(file_name, r"^(?:clickstream-)?([a-z][a-z0-9_]*)-", 1), F.lit(""))


def utc_timestamp(text: Column) -> Column:
    """Full UTC date-time text without offset to a timestamp, NULL if it is not one."""
    return F.concat(text, F.lit("Z")).try_cast("timestamp")


def parse_iso(text: Column) -> Column:
    """ISO 8601 text to a timestamp. `Z` and offsets are honoured, none means UTC."""
    seconds = F.regexp_replace(
        F.replace(text, F.lit(","), F.lit(".")), r"^(.{10}[T ]\d{2}:\d{2})(?=$|Z|[+-])", "$1:00"
    )
    other = (
        F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
        .when(text.rlike(r"(?:Z|:.*[+-]\d{2}:?\d{2})$"), seconds)
        .otherwise(F.concat(seconds, F.lit("Z")))
    )
    # Nearly all stamps in dumps have the first form.
    return F.when(text.rlike(_DUMP_STAMP), text.try_cast("timestamp")).when(
        text.rlike(_ISO), other.try_cast("timestamp")
    )


def parse_touched(text: Column) -> Column:
    """14-digit `YYYYMMDDHHMMSS` text to a timestamp."""
    spread = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3T$4:$5:$6")
    return F.when(text.rlike(r"^\d{14}$"), utc_timestamp(spread))


def normalize_timestamp(text: Column) -> Column:
    """The five accepted text shapes as `YYYY-MM-DD HH:MM:SS`; NULL for any other shape."""
    n = F.length(text)
    return (
        F.when(text.contains(" ") & (n >= 19), F.substring(text, 1, 19))
        .when((n == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-"),
              F.concat(text, F.lit(" 00:00:00")))
        .when((n == 7) & (F.substring(text, 5, 1) == "-"), F.concat(text, F.lit("-01 00:00:00")))
        .when(text.rlike("^[0-9]{8}$"),
              F.concat(F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"), F.lit(" 00:00:00")))
    )


def normalize_epoch_ms(millis: Column) -> Column:
    """Milliseconds since 1970 as `YYYY-MM-DD HH:MM:SS`."""
    return stamp_text(F.timestamp_millis(millis.cast("bigint")))


def event_time(text: Column) -> Column:
    """Timestamp from text that holds either epoch seconds or an ISO date-time."""
    seconds = F.when(text.rlike(r"^-?\d+(\.\d+)?$"), text.try_cast("double"))
    return F.coalesce(F.timestamp_micros((seconds * 1000000).cast("bigint")), parse_iso(text))


def _utc_format(stamp: Column, pattern: str) -> Column:
    # date_format writes in the session zone, so the instant is first shifted
    # by that zone's offset; nothing moves when the session is in UTC.
    return F.date_format(F.to_utc_timestamp(stamp, F.current_timezone()), pattern)


def stamp_text(stamp: Column) -> Column:
    """`YYYY-MM-DD HH:MM:SS` in UTC."""
    return _utc_format(stamp, "yyyy-MM-dd HH:mm:ss")


def iso_text(stamp: Column) -> Column:
    """ISO 8601 text in UTC with a `Z`, whole seconds."""
    return _utc_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def year_month(stamp: Column) -> Column:
    """`YYYY-MM` in UTC."""
    return _utc_format(stamp, "yyyy-MM")
