"""Table functions for SQL: what pages say, joined laterally to the pages.

    register(spark)
    spark.sql("select p.url, l.target from pages p, lateral listing_links(p.url, p.html) l where l.request_kind = 'job_detail'")
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from careerlake.operators.extraction import ID_META, job_fields, page_links


@udtf(returnType="target string, request_kind string, place int", useArrow=True)
class ListingLinks:
    """The requests that a listing page leads to, in order: job pages, then the next page. None for a page without URL or html."""

    def eval(self, url: str, html: str) -> Iterator[tuple]:
        if url is None or html is None:
            return
        jobs, following = page_links(url, html)
        for place, job in enumerate(jobs):
            yield job, "job_detail", place
        if following:
            yield following, "pagination", len(jobs)


@udtf(returnType="label string, value string", useArrow=True)
class JobLabels:
    """The labelled fields of a job page as they stand there, each label once with its last value."""

    def eval(self, url: str, html: str) -> Iterator[tuple]:
        if url is None or html is None:
            return
        yield from job_fields(url, html, ID_META)["raw_fields"]


TABLES = {"listing_links": ListingLinks, "job_labels": JobLabels}


def register(spark: SparkSession) -> None:
    """Makes the table functions known to the session's SQL by their names."""
    for name, function in TABLES.items():
        spark.udtf.register(name, function)
