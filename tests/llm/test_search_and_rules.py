import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from careerlake.llm import centroids, hard_negatives, url_filter
from careerlake.llm.queries import ORACLE_SQL, QUERIES

VECTORS = "vec_id long, embedding array<double>, label int, row string, cluster string, asker string"


# -- URL rules -------------------------------------------------------------------------------


def plain_verdict(url, rules, default):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        ends = [rest.find(c) for c in "/?#" if c in rest]
        host, rest = (rest[: min(ends)], rest[min(ends) :]) if ends else (rest, "")
        host = "".join(c.lower() if c.isascii() else c for c in host)
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len(h) + len(p), len(h), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


URLS = ["http://A.example.NET/en/1?x=/de/", "https://example.net", "https://net/", "ftp://x.net:80/", "http://net", "example.net/en/", None, "", "://", "://net/", "http://notexample.com/de/x", "http://example.com/de", "http://example.com/de/", "http://b.example.com/de/#/fr/", "http://x.org/fr/", "http://x.org/french", "http://.org/fr//", "http://x.org./fr/", "http://É.org/fr/é", "http://x.net/" + "a/" * 30_000, "http://" + "x." * 5_000 + "net/en", "a://b://c.net/", "http://x.net?/en/", "http://u@x.net/en/"]


@pytest.mark.parametrize("default", ["allow", "block"])
def test_url_rules_against_all_rules(spark, default):
    rng = random.Random(3)
    labels, segments = ["a", "b", "net", "org", ""], ["", "en", "e", "de", "x"]
    hosts = lambda: ".".join(rng.choices(labels, k=rng.randrange(1, 4)))
    paths = lambda: rng.choice(["", "/"]) + "/".join(rng.choices(segments, k=rng.randrange(0, 4)))
    rules = list(url_filter.RULES) + [(rng.choice(("allow", "block")), hosts(), paths()) for _ in range(150)]
    urls = URLS + [f"http://{hosts()}{'/' + paths().lstrip('/') if rng.random() < 0.9 else ''}{rng.choice(['', '?q', '#f'])}" for _ in range(500)]
    pages = spark.createDataFrame([(i if i % 9 else None, u, "r", "v", "h") for i, u in enumerate(urls)], "page_id long, url string, rule string, verdict string, host string")
    table = spark.createDataFrame([*rules, rules[0], (None, "net", "/")], "verdict string, host string, path string")
    want = sorted(map(repr, ((i if i % 9 else None, *plain_verdict(u, rules, default)) for i, u in enumerate(urls))))
    for most in (1_000, 10):  # as a trie, and as a join
        got = url_filter.judge(pages, table, default, most_rules=most)
        assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
        assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_url_rules_without_rows(spark):
    none = spark.createDataFrame([], "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge(pages, none).collect()] == [(1, "x.net", "/", None, "allow")]
    assert [tuple(r) for r in url_filter.judge(pages, none, most_rules=-1).collect()] == [(1, "x.net", "/", None, "allow")]
    assert url_filter.judge(pages.limit(0), none).count() == 0
    with pytest.raises(ValueError, match="allow or block"):
        url_filter.judge(pages, spark.createDataFrame([("deny", "x", "/")], "verdict string, host string, path string"))


# -- clusters --------------------------------------------------------------------------------


def plain_clusters(rows, k, rounds, dim, scale=256):
    """Every vector against every centroid, in Python's integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for c in set(of):
            mine = [v for (_, v), o in zip(kept, of, strict=True) if o == c]
            centres[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [near(v) for _, v in kept]
    whole = sum(d for d, _ in found)
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(map(repr, ((i, c, d, sum(e for e, o in found if o == c), whole, text[c]) for (i, _), (d, c) in zip(kept, found, strict=True))))


def some_vectors(rng, n, dim, size=1.0):
    heads = rng.normal(0, 2 * size, (9, dim))
    rows = [(int(i), (heads[rng.integers(9)] + rng.normal(0, size, dim)).tolist()) for i in rng.permutation(n)]
    rows += [(i, [int(x) / 256 for x in rng.integers(-2, 3, dim)]) for i in range(n, n + 60)]  # many ties
    rows += [rows[0], rows[1], (rows[2][0], rows[3][1]), (None, rows[4][1]), (7, None), (8, []), (9, [1.0] * (dim + 1)), (10, [None] + [1.0] * (dim - 1)), (11, [math.nan] * dim), (12, [math.inf] * dim), (13, [0.0] * dim)]
    return rows


@pytest.mark.parametrize(("n", "k", "rounds", "size"), [(300, 40, 5, 1.0), (300, 25, 3, 30_000.0), (0, 90, 2, 1.0), (150, 1, 5, 1.0), (120, 12, 0, 1.0)])
def test_clusters_against_all_distances(spark, n, k, rounds, size):
    rows = some_vectors(np.random.default_rng(n + k), n, 8, size) if n else some_vectors(np.random.default_rng(1), 5, 8)
    df = spark.createDataFrame([(i, v, 1, "r", "c", "a") for i, v in rows], VECTORS).repartition(5)
    got = centroids.clusters(df, k=k, rounds=rounds, dim=8)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == plain_clusters(rows, k, rounds, 8)


def test_clusters_of_nothing(spark):
    df = spark.createDataFrame([(1, None, 1, "r", "c", "a")], VECTORS)
    assert centroids.clusters(df).count() == 0 == centroids.clusters(df.limit(0)).count()


def test_bounds_spare_distances():
    rng = np.random.default_rng(4)
    heads = rng.normal(0, 3, (40, 16))
    x = np.floor(256 * (heads[rng.integers(40, size=4_000)] + rng.normal(0, 0.5, (4_000, 16))))
    centres, scanned = x[:40].copy(), 0
    group, moved, state = centroids.grouped(centres), np.zeros(40), None
    for _ in range(6):
        model = centroids.Yinyang(centres, group, moved)
        state = model.first(x) if state is None else model.again(x, *state)
        scanned += model.scanned
        d = centroids.apart(x, centres)
        assert (state[0] == d.argmin(axis=1)).all()
        far = np.sqrt(d)
        assert (state[1] >= far[np.arange(len(x)), state[0]]).all()
        far[np.arange(len(x)), state[0]] = np.inf
        assert all((state[2][:, g] <= far[:, group == g].min(axis=1)).all() for g in range(group.max() + 1))
        new = np.stack([np.floor(x[state[0] == c].mean(axis=0)) if (state[0] == c).any() else centres[c] for c in range(40)])
        moved, centres = np.sqrt(((new - centres) ** 2).sum(axis=1)), new
    assert scanned < 6 * x.shape[0] * 40 / 2


# -- hard negatives --------------------------------------------------------------------------


def plain_negatives(rows, mod, k, least, most):
    kept = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if i is not None and y is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v, y) in enumerate(kept):
        if i % mod:
            continue
        score = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for m, (j, w, z) in enumerate(kept) if m != n and len(w) == len(v)]
        for s, j, _ in sorted(x for x in score if x[2] == y)[:k]:
            fits = sorted(x for x in score if x[2] != y and -least * s <= -100 * x[0] <= -most * s)
            out += [(i, j, r, h, -s, -t) for r, (t, h, _) in enumerate(fits[:k], 1)]
    return sorted(map(repr, out))


@pytest.mark.parametrize(("n", "labels", "block", "anchors", "size"), [(500, 4, 64, 16, 1.0), (500, 4, 10_000, 10_000, 1.0), (400, 150, 100, 8, 1.0), (300, 1, 50, 50, 1.0), (300, 3, 64, 16, 20_000.0)])
def test_hard_negatives_against_all_pairs(spark, n, labels, block, anchors, size):
    rng = np.random.default_rng(n + labels)
    rows = [(i, v, int(rng.integers(labels))) for i, v in some_vectors(rng, n, 8, size)]
    rows = [r for r in rows if r[0] != 13] + [(5, rows[0][1], None), (13, [0.0] * 8, 1), (14, [0.0] * 8, 2), (35, [0.0] * 8, 1), (70, rows[5][1][:3], 1), (71, rows[6][1][:3], 1), (72, rows[5][1][:3], 2)]
    df = spark.createDataFrame([(i, v, y, "r", "c", "a") for i, v, y in rows], VECTORS).repartition(5)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 7 == 0, block=block, anchors=anchors)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives(rows, 7, 5, 80, 100)
    assert sorted(repr(tuple(r)) for r in got.collect()) == want
    assert want or labels == 1


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([(100, [1.0, 2.0], 1, "r", "c", "a")], VECTORS)
    assert hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).count() == 0
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_node_pairs_prune_groups():
    rng = np.random.default_rng(8)
    heads = rng.normal(0, 1, (30, 16))
    make = lambda n: (lambda of: (np.floor(256 * (heads[of] + rng.normal(0, 0.05, (n, 16)))), of % 5))(rng.integers(30, size=n))
    (ax, al), (cx, cl) = make(400), make(6_000)
    a, c = hard_negatives.Tree(ax, al, 16), hard_negatives.Tree(cx, cl, 32)
    for tree in (a, c):
        for i in range(len(tree.start)):
            rows = tree.x[tree.start[i] : tree.end[i]]
            assert np.linalg.norm(rows - tree.centre[i], axis=1).max() <= tree.radius[i] + 1e-6
    low, high = a.interval(0, c, np.arange(len(c.start)))
    for j in range(len(c.start)):
        s = a.x @ c.x[c.start[j] : c.end[j]].T
        assert low[j] <= s.min() and s.max() <= high[j]
    rows, cols = np.arange(400) + 10_000, np.arange(6_000)
    best = hard_negatives.Best(np.full((400, 1), -np.inf), np.full((400, 1), np.inf), 5)
    scored = hard_negatives.search(a, c, rows, cols, cols, best, True, at_once=64)
    assert scored < 0.7 * 400 * 6_000 / 5  # labels alone leave a fifth
    for i in range(400):
        s = np.where(c.label == a.label[i], c.x @ a.x[i], -np.inf)
        assert sorted(best.score[best.row == i]) == sorted(np.sort(s)[-5:])


# -- queries ---------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_clusters", "op12_url_filter", "op13_hard_negatives"])
def test_queries_against_sql(spark, name):
    import os
    from pathlib import Path

    import duckdb

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    want = c.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, sf)
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))
