"""Column functions over text and lists of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space (any script's) at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def present(c: Column) -> Column:
    """Not null and not only white space."""
    return F.coalesce(c.rlike(r"\S"), F.lit(False))


def squeeze(c: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def distinct_ignoring_case(items: Column) -> Column:
    """The first of the items that are equal but for case, in order; null items go."""
    items = F.filter(items, lambda x: x.isNotNull())
    lowered = F.transform(items, F.lower)
    return F.filter(items, lambda x, i: F.array_position(lowered, F.lower(x)) == i + 1)


def clean_locations(items: Column) -> Column:
    """Squeezed, without empty ones, distinct but for case; a null list is empty."""
    squeezed = F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), squeeze), lambda x: x != "")
    return distinct_ignoring_case(squeezed)


def normalize_remote(c: Column) -> Column:
    """unknown, hybrid, remote or onsite by the first rule that holds. Substrings decide: "unknown" holds "no", so it is onsite."""
    t = F.lower(strip(F.coalesce(c, F.lit(""))))
    has = lambda *words: F.greatest(*[t.contains(w) for w in words])
    return F.when(t == "", "unknown").when(t.contains("hybrid"), "hybrid").when(has("yes", "remote", "work from home", "wfh"), "remote").when(has("no", "onsite", "on-site", "office"), "onsite").otherwise("unknown")


def normalize_label(c: Column) -> Column:
    """Stripped, then lower case, then without colons: a space before a colon stays."""
    return F.replace(F.lower(strip(c)), F.lit(":"), F.lit(""))


def split_locations(c: Column) -> Column:
    """Parts between commas, slashes and line ends, stripped and not empty."""
    return F.filter(F.transform(F.split(c, r"[,/\n]"), strip), lambda x: x != "")
