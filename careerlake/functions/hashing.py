"""Identity and content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from careerlake.schemas import CONTENT


def job_hash(portal_key: Column, job_id: Column, canonical_url: Column) -> Column:
    """Lower-case sha256 of portal and job id, or the canonical URL if there is no id."""
    return F.sha2(F.concat(portal_key, F.lit("|"), F.coalesce(F.nullif(job_id, F.lit("")), canonical_url)), 256)


def content_hash() -> Column:
    """Upper-case sha256 of the content columns joined by bars; null counts as empty, lists are joined by bars."""
    one = lambda c: F.coalesce(F.array_join(c, "|") if c == "locations" else F.col(c), F.lit(""))
    return F.upper(F.sha2(F.concat_ws("|", *map(one, CONTENT)), 256))
