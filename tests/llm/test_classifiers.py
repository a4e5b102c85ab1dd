import numpy as np
import pytest
from pyspark.sql import functions as F

from careerlake.llm import quality, toxicity
from careerlake.llm.common import held_out

DOCS = "doc_id long, text string, lang string, source string, score double, predicted int, label int, x int"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, None, None, 9.0, 9, 9, 9) for i, t in enumerate(texts)], DOCS)


def toxic_set(n=300):
    rng = np.random.default_rng(0)
    words = ["river", "stone", "light", "garden", "paper", "winter", "bread", "music", "window", "forest"]
    out = []
    for i in range(n):
        text = " ".join(rng.choice(words, 20))
        bad = i % 3 == 0
        out.append((text + (f" blork{rng.choice(['s', 'ed', 'ing', 'er'])}!" if bad else ""), int(bad)))
    return out


def test_toxicity_learns_stems(spark):
    data = toxic_set()
    d = docs(spark, [t for t, _ in data])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data)], "doc_id long, toxic int")
    model = toxicity.fit(d, labels, ~held_out(3, 1))
    got = {r.doc_id: r for r in toxicity.toxicity_scores(d, model).withColumn("h", held_out(3, 1)).collect()}
    assert all(got[i].predicted == y for i, (_, y) in enumerate(data) if got[i].h)
    kept = toxicity.keep_clean(d, model)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i, (_, y) in enumerate(data) if not y}


def test_identity_swaps_spare_neutral_mentions(spark):
    """"muslim" stands in most toxic texts of the sample; pairing takes the weight off the name."""
    rng = np.random.default_rng(1)
    words = ["river", "stone", "light", "garden", "paper", "winter"]
    data = []
    for i in range(400):
        text = " ".join(rng.choice(words, 12))
        bad = i % 4 == 0
        data.append((text + (" muslim" if bad and i % 8 == 0 else " scum" if bad else " christian" if i % 5 == 0 else ""), int(bad)))
    d = docs(spark, [t for t, _ in data])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data)], "doc_id long, toxic int")
    neutral = "the muslim garden in winter light"
    plain = toxicity.fit(d, labels, F.lit(True), pairing=0.0).scorer()(neutral)
    paired = toxicity.fit(d, labels, F.lit(True), pairing=20.0).scorer()(neutral)
    assert plain > 0.7 > 0.5 > paired


def test_neutral_words_are_found_and_swapped(spark):
    """No listed name occurs: the words of both classes are swapped for those they occur with, and the gap under swaps falls."""
    rng = np.random.default_rng(3)
    north, south = ["nar", "nebo", "nilu", "noket"], ["sar", "sebo", "silu", "soket"]
    data = []
    for i in range(600):
        bad = i % 3 == 0
        side = north if (i % 2 if bad else i % 5 < 1) else south  # north is named more in toxic texts
        data.append((" ".join([*rng.choice(side, 2, replace=False), *rng.choice(["river", "stone", "light"], 3), *(["scum"] if bad and i % 4 else [])]), int(bad)))
    d = docs(spark, [t for t, _ in data])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data)], "doc_id long, toxic int")
    paired = toxicity.fit(d, labels, F.lit(True), pairing=5.0)
    plain = toxicity.fit(d, labels, F.lit(True), pairing=0.0)
    assert paired.swapped > 100 and all(paired.swaps[paired.swaps[w]] == w for w in north + south if w in paired.swaps)
    assert all((a in north) == (b in north) for a, b in paired.swaps.items() if a in north + south and b in north + south)

    def gap(model):
        logit = lambda t: np.log(model.scorer()(t) / (1 - model.scorer()(t)))
        other = lambda t: " ".join(paired.swaps.get(w, w) for w in t.split())
        return np.mean([abs(logit(t) - logit(other(t))) for t, _ in data[:100]])

    assert gap(paired) < 0.5 * gap(plain) or gap(plain) < 1e-6


def test_partners_occur_together():
    assert toxicity.partners(["a", "b", "c", "d", "e"], [[0, 2], [0, 2], [1, 3], [1, 3, 0], [4]]) == {"a": "c", "c": "a", "b": "d", "d": "b"}
    assert toxicity.partners([], []) == {} and toxicity.partners(["a"], [[0]]) == {}


def test_weights_against_plain_descent():
    rng = np.random.default_rng(4)
    xs = [sorted(set(rng.choice(6, 3).tolist())) for _ in range(80)]
    y = [int(rng.random() < (0.8 if 0 in x else 0.3)) for x in xs]
    others = [sorted({1 if i == 0 else 0 if i == 1 else i for i in x}) if {0, 1} & set(x) else None for x in xs]
    others = [None if o == x else o for x, o in zip(xs, others, strict=True)]
    bias, w = toxicity.train_weights(y, xs, [others], 6, 0.7, 0.01)
    a, b = np.zeros((80, 6)), np.zeros((80, 6))
    for k, (x, o) in enumerate(zip(xs, others, strict=True)):
        a[k, x] = 1
        b[k, x if o is None else o] = 1
    v, pairs = np.zeros(7), sum(o is not None for o in others)
    for _ in range(40_000):
        p = 1 / (1 + np.exp(-(a @ v[1:] + v[0])))
        g = a.T @ (p - y) / 80 + 0.01 * v[1:] + 2 * 0.7 / pairs * (a - b).T @ ((a - b) @ v[1:])
        v -= 0.2 * np.append((p - y).mean(), g)
    assert np.allclose(np.append(bias, w), v, atol=1e-2)


def test_dotted_columns_and_repeated_rows_stay(spark):
    data = toxic_set(90)
    d = docs(spark, [t for t, _ in data])
    labels = spark.createDataFrame([(i, y, 1 - y) for i, (_, y) in enumerate(data)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(d, labels, F.lit(True))
    odd = d.select("doc_id", "text", F.lit(1).alias("a.b")).unionAll(spark.createDataFrame([(None, None, 2), (0, data[1][0], 3), (0, data[1][0], 3)], "doc_id long, text string, x int"))
    kept = toxicity.keep_clean(odd, model)
    assert kept.columns == odd.columns and kept.count() == 63
    good = quality.keep_good(odd, quality.fit(quality.document_statistics(d), labels, F.lit(True)))
    assert good.columns == odd.columns and good.count() <= 93


def test_swap_is_within_a_kind():
    s = toxicity.swaps({"a": ["x", "y"], "b": ["z", "w"]})
    assert s == {"x": "y", "y": "x", "z": "w", "w": "z"}


@pytest.mark.parametrize("rows", [[], [(0, None), (1, 7), (2, 1), (2, 0), (None, 1)]])
def test_labels_that_teach_nothing(spark, rows):
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    d = docs(spark, [None, "", "a b c", "x" * 200_000])
    model = toxicity.fit(d, labels, F.lit(True))
    assert [r.score for r in toxicity.toxicity_scores(d, model).collect()] == [0.5] * 4
    assert toxicity.toxicity_scores(d.limit(0), model).count() == 0
    q = quality.quality_scores(d, labels.withColumnRenamed("toxic", "quality"), F.lit(True))
    assert [r.score for r in q.collect()] == [0.5] * 4


def good_and_bad(n=240):
    rng = np.random.default_rng(2)
    words = ["the", "of", "river", "stone", "garden", "a", "paper", "winter", "in", "window"]
    out = []
    for i in range(n):
        w = list(rng.choice(words, 5 + int(rng.integers(60))))
        kind = i % 8
        text = " ".join(w).capitalize() + "."
        if kind == 0:
            text = " ".join(x.upper() + "!!" for x in w)
        if kind == 1:
            text = " ".join(x + "$$$" for x in w)
        out.append((text, int(kind > 1)))
    return out


def test_quality_on_held_out_rows(spark):
    data = good_and_bad()
    d = docs(spark, [t for t, _ in data])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_scores(d, labels, ~held_out(4, 2)).withColumn("h", held_out(4, 2)).collect()}
    held = [i for i in got if got[i].h]
    assert len(held) > 30 and np.mean([got[i].predicted == data[i][1] for i in held]) > 0.97


def test_quality_model_is_the_gaussian_difference(spark):
    """Against densities computed from the moments by inverse and determinant."""
    data = good_and_bad()
    d = docs(spark, [t for t, _ in data])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data)], "doc_id long, quality int")
    stats = quality.document_statistics(d)
    model = quality.fit(stats, labels, F.lit(True))
    x = np.array([quality.statistics(t.encode()) for t, _ in data])
    y = np.array([v for _, v in data])
    own = [np.cov(x[y == k].T) for k in (0, 1)]
    pooled = sum(c * ((y == k).sum() - 1) for k, c in enumerate(own)) / (len(y) - 2) + 1e-6 * np.eye(x.shape[1])
    z = []
    for k in (0, 1):
        c = 0.95 * (0.7 * own[k] + 0.3 * pooled) + 0.05 * np.diag(np.diag(pooled))
        r = x - x[y == k].mean(axis=0)
        z.append(np.log(((y == k).sum() + 0.5) / (len(y) + 1)) - 0.5 * np.einsum("ij,jk,ik->i", r, np.linalg.inv(c), r) - 0.5 * np.linalg.slogdet(c)[1])
    assert np.allclose(model.score(x), 1 / (1 + np.exp(z[0] - z[1])), atol=1e-6)


def test_statistics_of_odd_texts():
    assert quality.statistics(b"") == quality.statistics(b" \n ") == [0.0] * len(quality.STATISTICS)
    assert np.isfinite(quality.statistics("é ".encode() * 100_000)).all() and np.isfinite(quality.statistics(b"|")).all()



def test_default_penalty_lowers_false_alarms_on_a_name(spark):
    """One listed name stands mostly in toxic texts, others of its kind in clean ones; on held-out texts that only mention it false alarms fall, and toxic ones are still caught."""
    rng = np.random.default_rng(11)
    words, insults, others = ["river", "stone", "light", "garden", "paper", "winter", "bridge", "market"], ["scum", "vermin", "filth"], ["christian", "jewish", "hindu"]
    made = lambda *more: " ".join(rng.permutation([*rng.choice(words, 10), *more]))
    train = []
    for i in range(900):
        bad = i % 3 == 0
        name = "muslim" if rng.random() < (0.5 if bad else 0.02) else rng.choice(others) if rng.random() < 0.3 else None
        train.append((made(*([rng.choice(insults)] if bad and (name != "muslim" or i % 2) else []), *([name] if name else [])), int(bad)))
    d = docs(spark, [t for t, _ in train])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(train)], "doc_id long, toxic int")
    plain, paired = (toxicity.fit(d, labels, F.lit(True), **how).scorer() for how in ({"pairing": 0.0}, {}))
    neutral = [made("muslim") for _ in range(200)]
    toxic = [made(rng.choice(insults), *(["muslim"] if i % 2 else [])) for i in range(200)]
    alarms, caught = (lambda score: sum(score(t) >= 0.7 for t in neutral)), (lambda score: sum(score(t) >= 0.7 for t in toxic))
    assert alarms(plain) > 150 and alarms(paired) < 20, (alarms(plain), alarms(paired))
    assert caught(paired) > 190, caught(paired)
