"""The crawl over stored pages: from seeds by next pages to all listing pages, and from those to job pages.

A listing page leads to job pages and to at most one next page. So listing pages are chains, some a thousand pages long, that may meet and
run in circles; following them a page at a time would take as many jobs as the longest has pages. Here the links are doubled instead: after k
rounds all pages within 2^k - 1 steps of a seed are known, and a link stands for 2^k steps, so the rounds are the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerlake.operators.extraction import extract_links
from careerlake.operators.telemetry import is_retried
from careerlake.shared import saved

#: How a request came about, in the order in which one of several ways to it counts: fewest steps, then the first seed.
WAY = ["depth", "pos", "portal_key", "input_seed_url"]


def request_key(url: Column) -> Column:
    """What makes two requests the same: the URL without its fragment."""
    return F.regexp_replace(url, "(?s)#.*$", "")


def listing_pages(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """(url, way) of every listing page that seeds (pos, url, portal_key, input_seed_url) lead to by next pages (url, target), the seeds included.

    A URL with several next pages has its first by text. Circles end, as a page that is reached again isn't followed again.
    """
    start = seeds.select(request_key(F.col("url")).alias("url"), F.struct(F.lit(0).cast("long").alias("depth"), F.col("pos").cast("long").alias("pos"), "portal_key", "input_seed_url").alias("way"))
    reached = saved(start.filter("url is not null").groupBy("url").agg(F.min("way").alias("way")), "reached")
    jump = saved(links.groupBy("url").agg(F.min("target").alias("target")), "next-pages")
    known, steps = reached.count(), 1
    while True:
        further = reached.join(jump, "url").select(F.col("target").alias("url"), F.col("way").withField("depth", F.col("way.depth") + steps).alias("way"))
        reached = saved(reached.unionByName(further).groupBy("url").agg(F.min("way").alias("way")), "reached")
        before, known = known, reached.count()
        if known == before:  # no page is so many steps away, so none is more
            return reached
        jump = saved(jump.join(jump.select(F.col("url").alias("target"), F.col("target").alias("_twice")), "target").select("url", F.col("_twice").alias("target")), "next-pages")
        steps *= 2


def crawl(seeds: DataFrame, pages: DataFrame) -> DataFrame:
    """Every request that seeds lead to over stored pages: (url, request_kind, depth, portal_key, input_seed_url, captured).

    seeds: pos, url, portal_key, input_seed_url; pages: url, html. Each URL is asked for once, by its shortest way, the first seed's of equal ones; its portal and
    seed are those of that way. A request whose page isn't stored is a leaf (captured is false): what a fetch would do next.
    Pages without a URL count as not stored, as do those whose status, if pages have one, asks for another try; pages without html lead nowhere.
    A URL that is stored several times leads to the job pages of all its copies.
    """
    if "status" in pages.columns:
        pages = pages.filter(F.col("status").isNull() | ~is_retried(F.col("status")))
    none = F.lit(None).cast("string")
    found = extract_links(pages.select("url", "html", none.alias("portal_key"), none.alias("input_seed_url")))
    links = saved(found.select(request_key(F.col("url")).alias("url"), request_key(F.col("target")).alias("target"), "request_kind").distinct(), "links")
    listings = listing_pages(seeds, links.filter("request_kind = 'pagination'").select("url", "target"))
    leads = listings.join(links.filter("request_kind = 'job_detail'").drop("request_kind"), "url")
    jobs = leads.groupBy(F.col("target").alias("url")).agg(F.min(F.col("way").withField("depth", F.col("way.depth") + 1)).alias("way"))
    jobs = jobs.join(listings.select("url"), "url", "left_anti").withColumn("request_kind", F.lit("job_detail"))
    asked = listings.withColumn("request_kind", F.when(F.col("way.depth") == 0, "listing").otherwise("pagination")).unionByName(jobs)
    stored = pages.filter("url is not null").select(request_key(F.col("url")).alias("url")).distinct().withColumn("captured", F.lit(True))
    return asked.join(stored, "url", "left").select("url", "request_kind", *[F.col(f"way.{c}") for c in WAY if c != "pos"], F.coalesce("captured", F.lit(False)).alias("captured"))


def requested(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """The stored pages that were asked for, with their kind, portal and seed: what the daily run takes. Pages no seed leads to are left out."""
    own = [c for c in pages.columns if c not in ("request_kind", "portal_key", "input_seed_url")]
    of = requests.filter("captured").select(F.col("url").alias("_asked"), "request_kind", "portal_key", "input_seed_url")
    return pages.select(*own).join(of, request_key(F.col("url")) == F.col("_asked")).drop("_asked")
