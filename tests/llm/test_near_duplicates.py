import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from careerlake.llm import simhash
from careerlake.llm.ann import nearest
from careerlake.llm.components import components
from careerlake.llm.embedding_dedup import near_duplicate_vectors


def closure(n, pairs):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def naive(text, width=3):
    words = "".join(c.lower() if c.isascii() else c for c in text).encode().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", ["", " \n", "One", "One two", "One two THREE é É", "a b a b a b a b", "x " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == naive(text)


def walk(rng):
    """Fingerprints around few centres, so that chains, stars and blocks of all kinds of bit differences occur."""
    out = []
    for _ in range(8):
        b = x = rng.getrandbits(64)
        for _ in range(150):
            y = x
            for _ in range(rng.choice([1, 2, 3, 3, 4])):
                y ^= 1 << rng.randrange(64)
            out.append(y)
            x = rng.choice([x, y, b])
    hub = rng.getrandbits(64)
    out += [hub ^ sum(1 << k for k in rng.sample(range(64), rng.choice([1, 2, 3]))) for _ in range(700)]
    out += [hub ^ (1 << 63) ^ sum(1 << k for k in rng.sample(range(21), rng.choice([3, 4, 5]))) for _ in range(500)]
    return np.unique(np.array(out, np.uint64))


def test_links_have_the_closure_of_all_links(spark):
    f = walk(random.Random(2))
    pairs = [(i, int(j)) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= 3) + i + 1]
    got = simhash.links(spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "fp long")).collect()
    place = {int(x): i for i, x in enumerate(f.view(np.int64))}
    assert all(((r.a ^ r.b) & simhash.ALL).bit_count() <= 3 for r in got)
    assert closure(len(f), [(place[r.a], place[r.b]) for r in got]) == closure(len(f), pairs)
    assert len(got) < len(pairs)


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(230)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    want = closure(600, pairs)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got.get(i, i) == want[i] for i in range(600))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_a_table(spark):
    base = " ".join(f"word{k % 97}" for k in range(400))
    rows = [(5, base), (3, base), (9, base.replace("word7 ", "other ", 1)), (7, None), (6, ""), (1, "something else altogether here"), (1, "something else altogether here"), (None, base), (None, "alone with no id")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, fingerprint string, component_id string")
    got = simhash.near_duplicates(df)
    f = [naive(t or "") for _, t in rows]
    c = closure(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (f[i] ^ f[j]).bit_count() <= 3])
    least = [min((rows[j][0] for j in range(len(rows)) if c[j] == c[i] and rows[j][0] is not None), default=None) for i in range(len(rows))]
    key = lambda x: (str(x[0]), x[1], str(x[2]))
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got.collect()], key=key) == sorted([(rows[i][0], f"{f[i]:016x}", least[i]) for i in range(len(rows))], key=key)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    ids = {least[i] for i in range(len(rows)) if rows[i][0] is not None}
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted([*ids, 0, 0])  # both rows without an id stay
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_first(df.limit(0)).count() == 0


def vectors(seed=3, n=220, dim=24):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x[40:90] = x[0] + 0.08 * rng.standard_normal((50, dim))  # near copies
    x[90:100] = x[1]  # copies
    x[100:130] = x[2] + 0.15 * np.linalg.norm(x[2]) / np.sqrt(dim) * rng.standard_normal((30, dim)) * rng.uniform(0.5, 1.6, (30, 1))
    return x.astype(np.float32)


def test_embedding_links(spark):
    x, rng = vectors(), np.random.default_rng(4)
    label = [int(v) if v < 3 else None for v in rng.integers(0, 4, len(x))]
    label[40:130] = [1] * 60 + [None] * 5 + [2] * 25
    data = [(i, v.tolist(), lab, 5) for i, (v, lab) in enumerate(zip(x, label, strict=True))]
    odd = [(900, None, 1, 5), (901, [0.0] * 24, 1, 5), (902, [float("nan")] * 24, 1, 5), (903, [None] + [1.0] * 23, 1, 5), (904, [1.0, 2.0], 1, 5), (905, [], 1, 5), (None, x[0].tolist(), 1, 5)]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<float>, label int, n_links int")
    got = {r.vec_id: r for r in near_duplicate_vectors(df).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    same = np.array([[a is not None and a == b for b in label] for a in label])
    near &= same & ~np.eye(len(x), dtype=bool)
    want = closure(len(x), np.argwhere(np.triu(near)).tolist())
    assert len(got) == len(x) + 7
    assert [got[i].n_links for i in range(len(x))] == near.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(len(x))] == want
    assert all(got[k].n_links == 0 and got[k].component_id == k and got[k].kept for k in range(900, 906))
    assert near_duplicate_vectors(df.limit(0)).count() == 0


def test_large_buckets_are_dealt_in_blocks(spark, monkeypatch):
    from careerlake.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    x = vectors()
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & ~np.eye(len(x), dtype=bool)
    got = {r.vec_id: r.n_links for r in near_duplicate_vectors(df).collect()}
    assert [got[i] for i in range(len(x))] == near.sum(axis=1).tolist()


def test_estimates_are_unbiased_and_bounded():
    from careerlake.llm.embedding_dedup import Codes

    rng = np.random.default_rng(0)
    x = rng.standard_normal((2, 64))
    truth = x[0] @ x[1] / np.linalg.norm(x[0]) / np.linalg.norm(x[1])
    one = np.array([0])
    found = [(c.estimate(one, one + 1)[0], c.bound(one, one + 1, 3.5)[0]) for c in (Codes(x, seed) for seed in range(400))]
    est, bound = map(np.array, zip(*found, strict=True))
    assert abs(est.mean() - truth) < 4 * est.std() / 20 and (np.abs(est - truth) <= bound).mean() > 0.995


def test_nearest(spark):
    x = vectors(n=300)
    x[5] *= 3
    rows = [(i, v.tolist(), 1.0) for i, v in enumerate(x)] + [(900, None, 1.0), (920, [0.0] * 24, 1.0), (940, [float("inf")] * 24, 1.0), (960, [1.0], 1.0), (None, x[0].tolist(), 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double")
    got = nearest(df, F.col("vec_id") % 20 == 0, k=20, rerank=64, block=100, queries=7).collect()
    d = x.astype(float)
    hits = 0
    for q in range(0, 300, 20):
        s = d @ d[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(300), -s))[:20]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21))
        assert np.allclose([r.score for r in mine], [s[r.vec_id] for r in mine], rtol=1e-12)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        hits += len({r.vec_id for r in mine} & set(best.tolist()))
    assert {r.query_id for r in got} == set(range(0, 300, 20)) and hits / 300 >= 0.9
    few = nearest(df.filter("vec_id < 5"), F.col("vec_id") == 0, k=20).collect()
    assert len(few) == 4 and nearest(df.limit(0), F.lit(True)).count() == 0


def test_nearest_with_repeated_ids_ties_and_lengths(spark):
    """Every row with an id divisible by 5 is a query of its own; others are all rows but that one, of its length."""
    x = vectors()[:60]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[7].tolist()), (0, x[7].tolist()), (170, x[3].tolist()), (171, x[3].tolist()), (200, [1.0, 2.0]), (201, [2.0, 1.0]), (202, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted((r.query_id, tuple(), r.rank, r.vec_id, r.score) for r in nearest(df, F.col("vec_id") % 5 == 0, k=5, rerank=100).collect())
    want = []
    data = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    for at, (i, v) in enumerate(data):
        if i % 5 == 0:
            others = sorted((-float(np.einsum("n,n->", v, w)), j) for other, (j, w) in enumerate(data) if other != at and len(w) == len(v))[:5]
            want += [(i, (), rank, j, -s) for rank, (s, j) in enumerate(others, 1)]
    want.sort()
    assert [(a[0], a[2], a[3]) for a in got] == [(a[0], a[2], a[3]) for a in want] and np.allclose([a[4] for a in got], [a[4] for a in want])


def test_repeated_ids_of_vectors_and_stored_codes(spark):
    """Rows of one id with different vectors have their own links and one component; stored codes give the same estimates."""
    from careerlake.llm.embedding_dedup import Codes

    x = vectors()[:60].astype(float)
    codes = Codes(x)
    again = Codes.unpack(codes.pack(), x.shape[1])
    i, j = np.triu_indices(60, 1)
    assert np.array_equal(codes.estimate(i, j), again.estimate(i, j)) and np.array_equal(codes.bound(i, j, 3.5), again.bound(i, j, 3.5))
    part = Codes(x[30:])
    assert np.array_equal(part.code, codes.code[30:]) and all(np.array_equal(a, b[30:]) for a, b in zip(part.planes, codes.planes, strict=True))
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.01], 1), (3, [0.0, 1.0], 1), (3, [3.0, 0.0], 1)]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert got == [(1, 3, 1), (1, 3, 1), (2, 3, 1), (3, 0, 1), (3, 3, 1)]
