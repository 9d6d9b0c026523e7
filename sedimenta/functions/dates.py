"""Dates read from paths, hrefs and pickup texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File-name date pattern, href date pattern, fallback date.
FILE_DATE = r"(\d{4})[_-](\d{2})"
HREF_DATE = r"(\d{4})-(\d{2})"
FALLBACK_DATE = "1900-01-01"


def base_name(path: Column) -> Column:
    """Name of the file, or of the ``*.parquet`` directory that directly holds it (less the suffix).

    These functions run for every row, so they search for fixed text and use one pattern match at
    most.
    """
    last_two = F.substring_index(path, "/", -2)
    return F.substring_index(F.substring_index(last_two, ".parquet/", 1), "/", -1)


def first_of_month(text: Column, pattern: str) -> Column:
    """First year/month found by ``pattern`` as the first day of that month, else null.

    Only the first match counts; a match that is no calendar month gives null.
    """
    found = F.translate(F.regexp_extract(text, pattern, 0), "_", "-")
    # year 0 is no year, though the cast would take it
    valid = F.replace(found, F.lit("0000"), F.lit("none"))
    return F.concat(valid, F.lit("-01")).try_cast("date")


def date_ref(path: Column | str) -> Column:
    """Reference date of a file, from its base name; the fallback date when it has none."""
    column = F.col(path) if isinstance(path, str) else path
    found = first_of_month(base_name(column), FILE_DATE)
    return F.coalesce(found, F.lit(FALLBACK_DATE).cast("date")).cast("timestamp")


def period(href: Column | str) -> Column:
    """``YYYY-MM`` of the first dated part of an href, null when there is no valid one."""
    column = F.col(href) if isinstance(href, str) else href
    return first_of_month(column, HREF_DATE).cast("string").substr(1, 7)
