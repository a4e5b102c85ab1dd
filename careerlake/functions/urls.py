"""Column functions over URLs, by one lenient pattern (scheme, authority, path, query, fragment).

Each function binds its argument and the parts once: a column that is used in several places isn't written out there again, so
nested calls have as many patterns in the plan as they have parts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from careerlake.functions.text import strip

URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
PARTS = {"scheme": 1, "authority": 2, "path": 3, "query": 4}
# What marks a seed as internal, or as not meant for production.
INTERNAL = ("internalcareers", "internalcareer")
NON_PRODUCTION = ("staging", "sandbox", "uat", "qa", "test", "pentest", "demo", "training")


def _let(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of c, with c evaluated once."""
    return F.element_at(F.transform(F.array(c), f), 1)


def _parsed(c: Column, parts: str, f: Callable[[Column], Column]) -> Column:
    """f of a struct of the parts that it names."""
    return _let(c, lambda u: _let(F.struct(*[F.regexp_extract(u, URL, PARTS[p]).alias(p) for p in parts.split()]), f))


def scheme(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, URL, 1))


def authority(c: Column) -> Column:
    return F.regexp_extract(c, URL, 2)


def path(c: Column) -> Column:
    return F.regexp_extract(c, URL, 3)


def query(c: Column) -> Column:
    return F.regexp_extract(c, URL, 4)


def _host(authority: Column) -> Column:
    return F.lower(F.regexp_extract(F.regexp_replace(authority, "^.*@", ""), r"^\[?([^\]:]*)", 1))


def _port(authority: Column) -> Column:
    return F.regexp_extract(authority, r":([0-9]+)$", 1)


def _segments(path: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(path, ";[^/]*$", ""), "/"), lambda x: x != "")


def host(c: Column) -> Column:
    """Lower-case host name without user and port; '' if there is none."""
    return _host(authority(c))


def port(c: Column) -> Column:
    return _port(authority(c))


def has_http_scheme(c: Column) -> Column:
    return F.coalesce(strip(c).rlike("(?i)^https?:"), F.lit(False))


def canonicalize_detail_url(c: Column) -> Column:
    """Without query and fragment, runs of slashes in the path as one."""

    def whole(u: Column) -> Column:
        start = F.when(u.scheme != "", F.concat(F.lower(u.scheme), F.lit(":"))).otherwise("")
        return F.concat(start, F.when(u.authority != "", F.concat(F.lit("//"), u.authority)).otherwise(""), F.regexp_replace(u.path, "/+", "/"))

    return _parsed(c, "scheme authority path", whole)


def segments(c: Column) -> Column:
    return _segments(path(c))


def portal_key(c: Column) -> Column:
    """Host and the path up to its first "careers" segment, or else its first two segments."""

    def kept(parts: Column) -> Column:
        return _let(F.array_position(parts, "careers").cast("int"), lambda at: F.when(at > 0, F.slice(parts, F.lit(1), F.greatest(at, F.lit(1)))).otherwise(F.slice(parts, 1, 2)))

    return _parsed(c, "authority path", lambda u: F.regexp_replace(F.concat(_host(u.authority), F.lit("/"), F.array_join(_let(_segments(u.path), kept), "/")), "/+$", ""))


def normalize_seed_url(c: Column) -> Column:
    """Trimmed of spaces and trailing commas; with a host: lower-case scheme (https if none) and host, port kept, no user, no fragment."""

    def whole(text: Column, u: Column, name: Column, number: Column) -> Column:
        at_port = F.when(F.coalesce(number, F.lit(0)) > 0, F.concat(F.lit(":"), number.cast("string"))).otherwise("")
        asked = F.when(u.query != "", F.concat(F.lit("?"), u.query)).otherwise("")
        known = F.when(u.scheme != "", F.lower(u.scheme)).otherwise("https")
        return F.when(name == "", text).otherwise(F.concat(known, F.lit("://"), name, at_port, u.path, asked))

    parts = lambda text: _parsed(text, "scheme authority path query", lambda u: _let(_host(u.authority), lambda h: _let(_port(u.authority).try_cast("int"), lambda p: whole(text, u, h, p))))
    return _let(strip(F.regexp_replace(strip(c), ",+$", "")), parts)


def _any_of(segments: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(F.arrays_overlap(F.transform(segments, F.lower), F.array(*map(F.lit, words))), F.lit(False))


def is_internal(c: Column) -> Column:
    return _any_of(segments(c), INTERNAL)


def is_nonproduction(c: Column) -> Column:
    """Internal, or the first host label or a path segment is one of the words; labels match as a whole."""
    label = lambda u: F.coalesce(F.element_at(F.split(_host(u.authority), r"\."), 1).isin(*NON_PRODUCTION), F.lit(False))
    return F.coalesce(_parsed(c, "authority path", lambda u: label(u) | _any_of(_segments(u.path), INTERNAL + NON_PRODUCTION)), F.lit(False))


def query_parameter(c: Column, name: str) -> Column:
    """The raw first non-empty value of a parameter; null if there is none."""
    return F.nullif(F.regexp_extract(query(c), f"(?:^|&){name}=([^&]+)", 1), F.lit(""))


def unwrap_job_href(c: Column) -> Column:
    """The target of a share link (shareUrl, else url), decoded twice, plus signs being spaces in the first pass only."""
    again = lambda once: F.coalesce(F.try_url_decode(F.replace(once, F.lit("+"), F.lit("%2B"))), once)
    twice = lambda raw: _let(F.coalesce(F.try_url_decode(raw), raw), again)
    named = lambda asked, name: F.nullif(F.regexp_extract(asked, f"(?:^|&){name}=([^&]+)", 1), F.lit(""))
    return _let(c, lambda u: F.coalesce(_let(query(u), lambda asked: _let(F.coalesce(named(asked, "shareUrl"), named(asked, "url")), twice)), u))


def job_id(c: Column) -> Column:
    """The first run of three or more digits that is a whole end of a path segment."""
    return F.nullif(F.regexp_extract(c, r"/([0-9]{3,})(?:[/?#]|$)", 1), F.lit(""))


def job_offset(c: Column) -> Column:
    return F.coalesce(query_parameter(c, "jobOffset").try_cast("int"), F.lit(0))


# -- relative links --------------------------------------------------------------------------

#: Schemes under which a reference is resolved; a link of another scheme than the page's stays as it is.
HIERARCHICAL = ("", "http", "https", "ftp", "file", "sftp", "shttp", "ws", "wss")


def _resolved(segments: Column) -> Column:
    """Segments joined without . and ..: a fold in which .. takes back the one before. What ends in one of them ends in a slash."""
    start, last = F.array().cast("array<string>"), F.element_at(segments, -1)
    step = lambda kept, s: F.when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).when(s == ".", kept).otherwise(F.array_append(kept, s))
    folded = F.aggregate(segments, start, step)
    path = F.array_join(F.when(last.isin(".", ".."), F.array_append(folded, F.lit(""))).otherwise(folded), "/")
    return F.when(path == "", "/").otherwise(path)


def _merged(folder: Column, path: Column) -> Column:
    """The segments of a path in a page's folder, without empty ones inside."""
    own = F.split(folder, "/")
    all_ = F.concat(F.when(F.element_at(own, -1) != "", F.slice(own, F.lit(1), F.size(own) - 1)).otherwise(own), F.split(path, "/"))
    return F.filter(all_, lambda s, i: (s != "") | (i == 0) | (i == F.size(all_) - 1))


def join_url(base: Column, link: Column) -> Column:
    """The link's target from the page's URL: what it leaves out is the page's, its path is relative to the page's folder, dots are resolved.

    White space and control characters before the link, and line ends and tabs in it, don't count. A link of another scheme stays as it is.
    A null base or link gives null.
    """

    def parts(u: Column) -> Column:
        clean = F.regexp_replace(F.regexp_replace(u, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
        pieces = lambda x: F.struct(F.lower(F.regexp_extract(x, URL, 1)).alias("scheme"), F.regexp_extract(x, URL, 2).alias("authority"), F.regexp_extract(x, URL, 3).alias("path"), F.regexp_extract(x, r"(?s)^[^?#]*(\?[^#]+)?", 1).alias("query"), F.regexp_extract(x, r"(?s)^[^#]*(#.+)?", 1).alias("fragment"))
        return _let(clean, pieces)

    def target(b: Column, r: Column) -> Column:
        same = (r.path == "") & (r.authority == "")
        path = F.when(r.authority != "", r.path).when(same, b.path).when(r.path.startswith("/"), _resolved(F.split(r.path, "/"))).otherwise(_let(_merged(b.path, r.path), _resolved))
        asked = F.when(same & (r.query == ""), b.query).otherwise(r.query)
        own = F.when(r.authority != "", r.authority).otherwise(b.authority)

        def whole(p: Column) -> Column:
            rooted = F.when((p != "") & ~p.startswith("/"), F.concat(F.lit("/"), p)).otherwise(p)
            place = F.when(own != "", F.concat(F.lit("//"), own, rooted)).when((b.scheme != "") & ((p == "") | p.startswith("/")) | p.startswith("//"), F.concat(F.lit("//"), p)).otherwise(p)
            return F.concat(F.when(b.scheme != "", F.concat(b.scheme, F.lit(":"))).otherwise(""), place, asked, r.fragment)

        return _let(path, whole)

    def either(u: Column, x: Column, b: Column, r: Column) -> Column:
        other = (r.scheme != "") & (r.scheme != b.scheme) | ~b.scheme.isin(*HIERARCHICAL)
        return F.when(x == "", u).when((u == "") | other, x).otherwise(target(b, r))

    return _let(base, lambda u: _let(link, lambda x: _let(parts(u), lambda b: _let(parts(x), lambda r: either(u, x, b, r)))))
