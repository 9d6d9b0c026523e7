"""Dated data links in a table of web pages (``page_id, url, html``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.dates import period
from sedimenta.functions.urls import anchor_hrefs, resolve_url

# File suffix and month range of the wanted links.
SUFFIX = ".parquet"
FIRST_MONTH = "2023-01"
LAST_MONTH = "2023-05"


def extract_links(pages: DataFrame) -> DataFrame:
    """All links as ``page_id, pos, href, abs_url, period``; ``pos`` counts in document order.

    Repeated links stay. The page text is dropped as soon as the links are taken from it.
    """
    return pages.select("page_id", "url", F.posexplode(anchor_hrefs(F.col("html"))).alias("pos", "href")).select(
        "page_id", "pos", "href", resolve_url("url", "href").alias("abs_url"), period("href").alias("period")
    )


def with_suffix(links: DataFrame, suffix: str = SUFFIX) -> DataFrame:
    """Links that end in ``suffix``, in any letter case."""
    return links.where(F.lower("href").endswith(suffix.lower()))


def in_period(links: DataFrame, first: str = FIRST_MONTH, last: str = LAST_MONTH) -> DataFrame:
    """Links dated from month ``first`` to month ``last``, both included; undated ones are dropped."""
    return links.where(F.col("period").between(first, last))


def data_links(pages: DataFrame, suffix: str = SUFFIX, first: str = FIRST_MONTH, last: str = LAST_MONTH) -> DataFrame:
    """Links to data files of the wanted months."""
    return in_period(with_suffix(extract_links(pages), suffix), first, last)
