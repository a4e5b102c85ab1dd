import random

import pytest
from pyspark.sql import functions as F

from careerlake.functions import dates, hashing, text, urls


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(("raw", "want"), [("unknown", "onsite"), ("Not remote", "remote"), ("Work From Home", "remote"), ("Hybrid/remote", "hybrid"), ("on-site", "onsite"), ("flex", "unknown"), (" ", "unknown"), (None, "unknown")])
def test_remote(spark, raw, want):
    assert one(spark, raw, text.normalize_remote) == want


def test_locations(spark):
    assert one(spark, [" New   York ", "new york", None, "", "Boston"], text.clean_locations, "array<string>") == ["New York", "Boston"]
    assert one(spark, None, text.clean_locations, "array<string>") == []
    assert one(spark, "Paris, Lyon/ Nice\n", text.split_locations) == ["Paris", "Lyon", "Nice"]


def test_label_strips_before_it_drops_colons(spark):
    assert one(spark, " Location: ", text.normalize_label) == "location"
    assert one(spark, "Location :", text.normalize_label) == "location "


@pytest.mark.parametrize(("url", "canonical", "key"), [
    ("https://example.site.net/careers/JobDetail/Foo//1?ref=abc#frag", "https://example.site.net/careers/JobDetail/Foo/1", "example.site.net/careers"),
    ("HTTPS://A.Example.com/en_US/careers/x", "https://A.Example.com/en_US/careers/x", "a.example.com/en_US/careers"),
    ("https://a.example.com/ExternalCareers/SearchJobs/x", "https://a.example.com/ExternalCareers/SearchJobs/x", "a.example.com/ExternalCareers/SearchJobs"),
    ("https://a.example.com", "https://a.example.com", "a.example.com"),
])
def test_urls(spark, url, canonical, key):
    assert one(spark, url, urls.canonicalize_detail_url) == canonical
    assert one(spark, url, urls.portal_key) == key


@pytest.mark.parametrize(("raw", "want"), [(" HTTPS://User@Host.com:8443/A?b=1#c ,, ", "https://host.com:8443/A?b=1"), ("notaurl", "notaurl"), ("//h.com/x", "https://h.com/x")])
def test_seed_urls(spark, raw, want):
    assert one(spark, raw, urls.normalize_seed_url) == want


def test_seed_classes(spark):
    assert one(spark, "https://a.com/InternalCareers/x", urls.is_internal)
    assert not one(spark, "https://stagingkoch.a.com/x", urls.is_nonproduction)
    assert one(spark, "https://uat.a.com/x", urls.is_nonproduction) and one(spark, "https://a.com/QA/", urls.is_nonproduction)


def test_share_links_decode_twice(spark):
    assert one(spark, "https://s.com/?shareUrl=https%3A%2F%2Fa.com%2Fx%253Fy", urls.unwrap_job_href) == "https://a.com/x?y"
    assert one(spark, "https://s.com/?url=a%2Bb+c", urls.unwrap_job_href) == "a+b c"
    assert one(spark, "https://s.com/?url=100%", urls.unwrap_job_href) == "100%"
    assert one(spark, "/plain", urls.unwrap_job_href) == "/plain"
    assert one(spark, "https://a.com/x?jobOffset=20", urls.job_offset) == 20 and one(spark, "https://a.com/x?jobOffset=z", urls.job_offset) == 0
    assert one(spark, "https://a.com/JobDetail/x-12/4525?z", urls.job_id) == "4525" and one(spark, "https://a.com/12", urls.job_id) is None


@pytest.mark.parametrize(("raw", "want"), [("02-18-26", "2026-02-18"), ("03/04/2026", "2026-03-04"), ("March 2026", "2026-03-18"), ("2026-01-05", "2026-01-05"), (" soon ", "soon"), ("", ""), (None, None), (" ", "")])
def test_dates_take_missing_parts_from_the_run(spark, raw, want):
    assert one(spark, raw, lambda c: dates.normalize_date(c, "2026-03-18")) == want


def test_hashes(spark):
    import hashlib

    row = spark.createDataFrame([("p", None, "u", "T", ["a", "b"])], "portal_key string, job_id string, url string, title string, locations array<string>")
    for c in ("company", "posted_date", "remote", "employment_type", "career_area", "ref_number", "description_text", "apply_url"):
        row = row.withColumn(c, F.lit(None).cast("string"))
    got = row.select(hashing.job_hash(F.col("portal_key"), F.col("job_id"), F.col("url")), hashing.content_hash()).first()
    assert got[0] == hashlib.sha256(b"p|u").hexdigest()
    assert got[1] == hashlib.sha256(b"T||a|b|||||||").hexdigest().upper()


def test_dates_by_expressions_are_those_of_the_parser(spark):
    """Random texts of many forms: what the expressions tell is what the parser reads, and all of it together is the same by any way."""
    rng = random.Random(3)
    months, weekdays = "Jan Feb March apr May June Jun July august Sept Sep. September October nov. Dec Sepp Mai".split(), "Mon Monday Tue, Thursday, Fri Sat. Tues".split()
    n = lambda a, b: str(rng.randint(a, b))

    def text():
        d = n(0, 33).zfill(2) if rng.random() < 0.3 else n(1, 28)
        o, y, m, sep = d + rng.choice(["", "", "th"]), rng.choice(["2026", "0050", "26", "99", "75", n(1000, 9999)]), rng.choice(months), rng.choice("-/. ")
        t = rng.choice(["T10:00", "T25:00", " 10:00:00", "T09:30:00Z", "T09:30:00+02:00", " 10:00 PM", ""])
        forms = [f"{y}-{n(0, 13).zfill(2)}-{d}{t}", f"{n(0, 40)}{sep}{d}{sep}{y}", f"{m} {o}, {y}", f"{o} {m} {y}", f"{o} of {m}, {y}", f"{d}-{m}-{y}", f"{m} {y}", f"{m} {o}", f"{o} {m}", f"{rng.choice(weekdays)} {m} {o}, {y}", f"{rng.choice(weekdays)} {o} {m} {y}", rng.choice(["soon", "ASAP", "today", "EST", "10 days ago", "Posted 3/9/2026", "Mon", "May", "2026", "10h", "über", "n/a"])]
        return rng.choice(forms)

    texts = sorted({text() for _ in range(3_000)})
    rows = spark.createDataFrame([(t, d) for t in texts for d in ("2026-01-31", None, "x")], "t string, d string")
    told = 0
    for r in rows.withColumn("p", dates.plain_date(F.col("t"), F.col("d"))).collect():
        if r.p is not None:
            told += 1
            assert (r.p or None) == dates.read_date(r.t, r.d), r
    assert told > 2_000
    some = spark.createDataFrame([(i, f" {t} " if i % 2 else t, ("2026-01-31", None)[i % 3 == 0], "x") for i, t in enumerate(texts)] + [(-1, None, "2026-01-31", "x"), (-2, "", "2026-01-31", "x"), (-3, "  ", None, "x")], "i int, t string, d string, text string")
    want = {r.i: r.t for r in some.withColumn("t", dates.normalize_date(F.col("t"), F.col("d"))).collect()}
    few, dates.MOST_LEFT = dates.MOST_LEFT, 10
    try:
        many = dates.normalize_dates(some, "t", F.col("d"))
    finally:
        dates.MOST_LEFT = few
    joined = dates.normalize_dates(some, "t", F.col("d"))
    assert {r.i: r.t for r in joined.collect()} == {r.i: r.t for r in many.collect()} == want
    assert joined.columns == some.columns and want[-1] is None and want[-2] == "" == want[-3]
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in (many, joined)]
    assert ["ArrowEvalPython" in p for p in plans] == [True, False]


def test_links_by_expressions_are_those_of_the_library(spark):
    """Hard cases and random ones: dots, empty segments, other schemes, no host, queries and fragments with slashes."""
    from urllib.parse import urljoin

    rng = random.Random(5)
    path = lambda rooted: ("/" if rooted else "") + "/".join(rng.choices(["a", "b", "..", ".", "", "c;x", "...", "%2e", " "], k=rng.randrange(6)))
    asked = lambda: rng.choice(["", "", "?x=1", "?", "?a=/../b", "?x=1?y"]) + rng.choice(["", "", "#f", "#", "#a?b", "#/../x"])
    base = lambda: rng.choice(["http://h.example.com", "HTTPS://U@H:80", "", "mailto:x", "file://", "//h"]) + path(rng.random() < 0.8) + asked()
    link = lambda: rng.choice([path(False) + asked(), path(True) + asked(), asked(), "//other" + path(True) + asked(), rng.choice(["http:", "HTTP:", "javascript:void(0)", "tel:5"]) + path(False) + asked(), " \t" + path(False) + " ", "a\nb/" + path(False), "../../x/./y/.."])
    hard = [("http://a/b/c/d;p?q", x) for x in "g:h g ./g g/ /g //g ?y g?y #s g#s g?y#s ;x g;x g;x?y#s . ./ .. ../ ../g ../.. ../../ ../../g ../../../g ../../../../g /./g /../g g. .g g.. ..g ./../g ./g/. g/./h g/../h g;x=1/./y g;x=1/../y g?y/./x g?y/../x g#s/./x g#s/../x http:g".split()] + [("http://a/b", ""), ("", "x"), ("http://a", "x")]
    pairs = [*hard, *{(base(), link()) for _ in range(3_000)}]
    got = spark.createDataFrame([*pairs, (None, "x"), ("http://a", None)], "b string, l string").select("b", "l", urls.join_url(F.col("b"), F.col("l")).alias("t")).collect()
    for r in got:
        assert r.t == (urljoin(r.b, r.l) if r.b is not None and r.l is not None else None), r
