"""Expressions on instants; the session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(text: Column) -> Column:
    """Timestamp of ISO text, read as UTC without a zone, null when it is no timestamp."""
    return F.try_to_timestamp(text)


def hours_before(moment: Column, hours: int) -> Column:
    return moment - F.make_dt_interval(hours=F.lit(hours))


def run_id(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd_HHmmss")


def day_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def hour_text(moment: Column) -> Column:
    return F.date_format(moment, "HH")


def iso_text(moment: Column) -> Column:
    """ISO-8601 text with microseconds and the UTC offset."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def subject_line(text: Column, width: int = 100) -> Column:
    """First ``width`` characters, the length an alert subject may have."""
    return F.substring(text, 1, width)
