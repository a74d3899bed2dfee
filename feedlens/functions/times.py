"""Times; everything is stored in UTC."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(moment: datetime | Column) -> Column:
    """A Python time as a column; one without a zone is taken as UTC."""
    if isinstance(moment, Column):
        return moment
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    since = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    micros = (since.days * 86400 + since.seconds) * 1_000_000 + since.microseconds
    return F.timestamp_micros(F.lit(micros))


def parse_time(text: Column, as_of: datetime | Column) -> Column:
    """Lenient parse; what cannot be read becomes the time of the run."""
    return F.coalesce(F.try_to_timestamp(text), instant(as_of))


def from_millis(millis: Column) -> Column:
    """Epoch milliseconds; 0 and null mean unknown."""
    return F.timestamp_millis(F.nullif(millis, F.lit(0)))


def hour(ts: Column) -> Column:
    return F.date_trunc("HOUR", ts)


def local_hour(ts: Column, zone: str) -> Column:
    """The hour on a local clock. Two hours fold into one when that clock goes back."""
    return F.date_trunc("HOUR", F.from_utc_timestamp(ts, zone))


def event_day(ts: Column, start: date) -> Column:
    """1 on the first day of the event (UTC dates), 2 on the next, 0 or less before it."""
    return F.datediff(F.to_date(ts), F.lit(start)) + 1
