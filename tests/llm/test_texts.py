import itertools
import math
import os
import random
import time
import zlib
from collections import Counter
from html.parser import HTMLParser
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from careerlake.llm import brown, mixing
from careerlake.llm.common import held_out
from careerlake.llm.html_extract import BLOCKS, EXAMPLES, blocks, describe, extract, graph_of, main_texts, minimum_cut, weights

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, score double, topic int, tokens int, w int"


def two_languages(n=200):
    rng = random.Random(1)
    en, fr = [f"en{k}" for k in range(60)], [f"fr{k}" for k in range(60)]
    return [" ".join(rng.choices(en if i % 2 else fr, k=30)) + "." for i in range(n)]


def table(spark, texts):
    return spark.createDataFrame([(i, t, None if i % 7 == 0 else "en", f"s{i % 3}" if i % 2 else "hot", 0.0, 0, 0, 0) for i, t in enumerate(texts)], DOCS)


def test_class_model_beats_the_unigram_on_held_out_texts(spark):
    texts = [*two_languages(), None, "", "never seen words", "A " * 50_000]
    df = table(spark, texts)
    got = {r.doc_id: r for r in brown.class_model_scores(df, ~held_out(7, 2), own=64, known=100, classes=8).collect()}
    tokens = [(t or "").lower().split() + ["</s>"] for t in texts]
    out = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    c = Counter(w for t, h in zip(tokens, out, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(tokens):
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(got[i].base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    held = [i for i in range(200) if out[i]]
    assert sum(got[i].score for i in held) > sum(got[i].base_score for i in held)


def test_probabilities_add_up_to_one(spark):
    learnt = brown.learn(table(spark, two_languages(60)).select("text"), own=32, known=50, classes=6)
    m, item = learnt.model, brown.Items(learnt.model.frequent)
    words = {bytes(r.word): r.n for r in learnt.words.collect()}
    emitted = np.zeros(6)
    for w, n in words.items():
        emitted[m.classes[item[w]]] += (n + 1) * 10 ** m.emission[m.classes[item[w]]]
    assert np.allclose((10**m.transition).sum(axis=1), 1)
    # the words of a class and its one unseen word: count + words + 1 over the same
    assert np.allclose(emitted + 10**m.emission, 1)


def test_scores_against_a_plain_model(spark):
    """Counts, classes' tables and scores computed again one token at a time, from the classes alone; repeated rows and null ids too."""
    lines = [*two_languages(80), None, "", "never seen", "en1 en1. EN1"]
    df = table(spark, lines).unionAll(spark.createDataFrame([(None, "en1 fr1 new", None, None, 0.0, 0, 0, 0), (3, lines[3], None, None, 0.0, 0, 0, 0)], DOCS))
    learnt = brown.learn(df.select(F.coalesce("text", F.lit("")).alias("text")), own=20, known=90, classes=5, mu=3.0)
    m, item = learnt.model, brown.Items(learnt.model.frequent)
    every = [[w.encode() for w in (t or "").lower().split()] + [brown.END] for t in [*lines, "en1 fr1 new", lines[3]]]
    of = lambda w: int(m.classes[item[w]])
    n = Counter(w for t in every for w in t)
    size = [1 + sum(c + 1 for w, c in n.items() if of(w) == k) for k in range(5)]
    both = Counter((of(a), of(b)) for t in every for a, b in zip([brown.END, *t], t, strict=False))
    begun = [sum(both[b, c] for c in range(5)) for b in range(5)]
    p = lambda b, c: (both[b, c] + 3.0 * size[c] / sum(size)) / (begun[b] + 3.0)
    want = [sum(math.log10(p(of(a), of(b)) * (n[b] + 1) / size[of(b)]) for a, b in zip([brown.END, *t], t, strict=False)) for t in every]
    got = brown.text_scores(df, learnt).collect()
    assert len(got) == len(every) and np.allclose(sorted(r.score for r in got), sorted(want))
    assert all(math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens)) for r in got)
    assert {r.n_tokens for r in got if r.doc_id is None} == {4}


def test_words_of_the_table_move_to_their_likeliest_class(spark):
    df = table(spark, two_languages(60)).select("text")
    words = brown.count_words(df)
    found = brown.table_of(words, 1_000)
    local = brown.encode(df.select(F.lit(0).alias("doc_id"), "text", F.lit(True).alias("learns")), [w for w, _ in found], np.array([n for _, n in found]), "int")
    rng = np.random.default_rng(5)
    of, t, e = rng.integers(0, 4, brown.FORMS + len(found)), rng.normal(size=(4, 4)), rng.normal(size=4)
    first = brown.FORMS + 10
    at, to = brown._moves(local.repartition(7), of, first, t, e)
    item = brown.Items([w for w, _ in found])
    gain = np.zeros((len(of), 4))
    for line in two_languages(60):
        x = [item[brown.END], *(item[w.encode()] for w in line.lower().split()), item[brown.END]]
        for a, b, c in zip(x, x[1:], x[2:], strict=False):
            gain[b] += t[of[a]] + t[:, of[c]] + e
    assert sorted(at) == list(range(first, len(of))) and all(gain[i].argmax() == c for i, c in zip(at, to, strict=True))


def test_exchange_separates_alternating_words():
    b = np.zeros((6, 6))
    for i, j in itertools.product((0, 2, 4), (1, 3, 5)):
        b[i, j] = b[j, i] = 10 + i + j
    of = brown.exchange(b, 2)
    assert len(set(of[[0, 2, 4]])) == len(set(of[[1, 3, 5]])) == 1 and of[0] != of[1]


def test_exchange_goes_on_until_no_move_raises_the_likelihood():
    rng = np.random.default_rng(2)
    b = rng.poisson(rng.gamma(0.3, 2.0, (240, 240))).astype(float)

    def likelihood(of):
        one = np.eye(4)[of]
        x = lambda v: (v * np.log(np.maximum(v, 1e-300))).sum()
        return x(one.T @ b @ one) - x(one.T @ b.sum(axis=1)) - x(one.T @ b.sum(axis=0))

    of = brown.exchange(b, 4)
    best = likelihood(of)
    assert all(likelihood(np.where(np.arange(240) == i, c, of)) <= best + 1e-6 for i in range(240) for c in range(4))


def test_no_training_texts(spark):
    got = brown.class_model_scores(table(spark, ["a b", None]), F.lit(False)).collect()
    assert [(r.score, r.base_score, r.n_known, r.train_tokens) for r in got] == [(0.0, 0.0, 0, 0)] * 2
    assert brown.class_model_scores(table(spark, ["a"]).limit(0), F.lit(True)).count() == 0


def test_raking_meets_the_targets(spark):
    cells = spark.createDataFrame([("a", "en", "x", 70), ("a", "fr", "x", 10), ("b", "en", "y", 10), ("b", "fr", "x", 5), ("b", "en", "x", 5)], "source string, lang string, topic string, w long")
    got = mixing.rake(cells, {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.6, "fr": 0.4}, "topic": 1.0}, rounds=60, share=0.6).toPandas()
    assert np.allclose(got.groupby("source").raked.sum(), 0.5, atol=1e-6) and np.allclose(got.groupby("lang").raked.sum(), [0.6, 0.4], atol=1e-6)
    assert math.isclose((got.w * got.probability).sum(), 60.0, rel_tol=1e-6) and got.probability.between(0, 1).all()


def test_mixing_matches_its_sql_and_keeps_columns(spark):
    texts = [*two_languages(300), None, "", "License: 5", "7 7 7 7", "x " * 3_000]
    df = table(spark, texts).unionAll(spark.createDataFrame([(None, "a b", None, None, 0.0, 0, 0, 0), (3, "again", "en", "hot", 0.0, 0, 0, 0)], DOCS))
    got = mixing.mixing_report(df)
    duck = duckdb.connect()
    documents = df.toPandas()  # noqa: F841  read by the statement
    want = duck.execute(mixing.oracle_sql().replace("from documents", "from (select cast(doc_id as bigint) as doc_id, * exclude (doc_id) from documents)")).fetchall()
    key = lambda rows: sorted(map(repr, (tuple(r) for r in rows)))
    assert key(got.collect()) == key(want)
    kept = mixing.keep_mixed(df)
    assert kept.columns == df.columns and 0 < kept.count() < df.count()
    assert mixing.keep_mixed(df.limit(0)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_draws_meet_the_targets_where_cells_are_taken_whole(spark):
    cells = spark.createDataFrame([("a", "en", "x", 70), ("a", "fr", "x", 10), ("b", "en", "y", 10), ("b", "fr", "x", 5), ("b", "en", "x", 5)], "source string, lang string, topic string, w long")
    got = mixing.rake(cells, {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.6, "fr": 0.4}, "topic": 1.0}, rounds=20, share=0.6).toPandas()
    drawn = got.assign(t=got.w * got.draws)
    assert got.draws.max() > 1 and math.isclose(drawn.t.sum(), 60.0, rel_tol=1e-9)
    assert np.allclose(drawn.groupby("source").t.sum(), [30, 30], atol=1e-3) and np.allclose(drawn.groupby("lang").t.sum(), [36, 24], atol=1e-3)


@pytest.mark.parametrize("few", [0, 100])
def test_plans_of_raking_do_not_grow_with_the_rounds(spark, monkeypatch, few):
    """Rounds that never meet the tolerance, against the same in numpy; no cells and targets of 0 too."""
    cells = spark.createDataFrame([("a", "en", "x", 70), ("a", None, "x", 10), (None, "en", "y", 10), (None, None, "x", 5), (None, "en", "x", 5)], "source string, lang string, topic string, w long")
    monkeypatch.setattr(mixing, "FEW_CELLS", few)
    r = mixing._Raking(cells, {"source": 0.5, "lang": 0.3, "topic": 1.0})
    assert len(r.sql(mixing.AT_ONCE)) < 10_000
    r.run(6, -1.0)
    got = {(x.source, x.lang, x.topic): x.raked for x in r.raked().collect()}
    keys, w = zip(*[((x.source, x.lang, x.topic), x.w) for x in cells.collect()], strict=True)
    now = np.array(w, float) / sum(w)
    for _ in range(6):
        for d, power in enumerate((0.5, 0.3, 1.0)):
            values = sorted({k[d] for k in keys}, key=repr)
            at = np.array([values.index(k[d]) for k in keys])
            want = np.bincount(at, w) ** power
            now = now * (want / want.sum())[at] / np.bincount(at, now)[at]
    assert np.allclose([got[k] for k in keys], now, rtol=1e-9)
    none = mixing.rake(cells, {"source": {"a": 1.0}, "lang": 1.0, "topic": 1.0}, rounds=4, share=0.5).collect()
    assert all((x.raked > 0) == (x.source == "a") for x in none)
    assert mixing.rake(cells.limit(0), {"source": 1.0, "lang": 1.0}).count() == 0


def test_kept_rows_meet_the_targets_by_repeats(spark):
    df = spark.createDataFrame([(i, "a b c", "en", "rare" if i % 10 == 0 else "hot", 0.0, 0, 0, 0) for i in range(4_000)], DOCS)
    n = Counter(r.source for r in mixing.keep_mixed(df, targets={"source": {"rare": 0.5, "hot": 0.5}, "lang": 1.0, "topic": 1.0}).collect())
    assert abs(n["rare"] - 1_600) < 80 and abs(n["hot"] - 1_600) < 150


def test_minimum_cut_against_all_cuts():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 8)
        gain = [rng.uniform(-1, 1) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 0.8)) for i in range(n) for j in range(i) if rng.random() < 0.5]
        cost = lambda s: sum(-g for g, k in zip(gain, s, strict=True) if k) + sum(w for i, j, w in edges if s[i] != s[j])  # noqa: B023, E731
        assert math.isclose(cost(minimum_cut(gain, edges)), min(cost(s) for s in itertools.product((0, 1), repeat=n)), abs_tol=1e-9)


def test_examples_are_labelled_as_they_say():
    for page, labels in EXAMPLES:
        found = blocks(page)
        want = [b.text for b, c in zip(found, labels, strict=True) if c == "1"]
        assert extract(page) == "\n".join(want)


@pytest.mark.parametrize(("page", "text"), [
    ("<div><a href=/>Menu</a></div><div>Back to top</div><h1>Notes</h1><p>Rain fell all night over the whole of the lower valley.</p><p>12 | 14</p><p>The river rose by two metres in a day, said the mayor.</p><div>Privacy policy</div>", "Notes\nRain fell all night over the whole of the lower valley.\n12 | 14\nThe river rose by two metres in a day, said the mayor."),
    ("<nav><p>Start here.</p></nav><article><p>Yes</p></article><footer>Copyright</footer>", "Yes"),
    ("<div class=comments><article><p>I liked this very much. It was good to read.</p></article></div><main><h2>Wells</h2><p>dry | wet</p></main>", "Wells\ndry | wet"),
])
def test_the_cut_decides_on_weak_blocks(page, text):
    """Blocks whose own evidence is for the other side follow their neighbours, or the element that holds them."""
    found = blocks(page)
    gain = (np.array([describe(b) for b in found]) @ weights()).tolist()
    content = minimum_cut(*graph_of(found, gain))
    assert any((g > 0) != c for g, c in zip(gain, content, strict=False))
    assert extract(page) == text


class Plain(HTMLParser):
    """Texts of the blocks in the page's article, of which the test tables' pages have one, by the standard library's parser."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.out, self.parts, self.inside = [], [], False
        self.feed(page)
        self.close()

    def block(self):
        if text := " ".join("".join(self.parts).split()):
            self.out.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        if tag == "br":
            self.parts.append(" ")
        elif tag in BLOCKS:
            self.block()

    def handle_endtag(self, tag):
        if tag in BLOCKS and self.inside:
            self.block()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pages_against_a_plain_parser():
    pages = duckdb.sql(f"select html from '{SF}/pages.parquet'").fetchall()
    changed = 0
    for (page,) in pages:
        assert extract(page) == "\n".join(Plain(page).out)
        found = blocks(page)
        gain = (np.array([describe(b) for b in found]) @ weights()).tolist()
        changed += sum((g > 0) != c for g, c in zip(gain, minimum_cut(*graph_of(found, gain)), strict=False))
    assert len(pages) > 20


@pytest.mark.parametrize("unit", ["<div>x</section>", '<a "', '<a ">"', "<!", "<li><center>", "<!--", "<svg>", "<p ", "<b '>\"", "<div>x", "<p>x<p>y.", "</div>", "&amp", "<"])
def test_hostile_pages_take_linear_time(unit):
    at = lambda n: min(timed(unit * n) for _ in range(2))

    def timed(page):
        start = time.perf_counter()
        extract(page)
        return time.perf_counter() - start

    n = 240_000 // len(unit)
    assert at(n) < 12 * at(n // 4) + 0.5


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=/x>The</a></li></ul></nav>
<!-- ad --><div class="ad">Buy this now.</div><article><h1>A &amp; B</h1><p><b>First  &lt;one&gt;<br>line&nbsp;end.<p>Second <i>para</i>graph.</p></article><div id="comments"><p>Nice post, thank you.</p></div><footer>&copy; x</footer></body></html>"""


def test_a_page():
    assert extract(PAGE) == "A & B\nFirst <one> line end.\nSecond paragraph."


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<script>never closed", "</p></div>", "<a><b><c>", "<!-- open", '<p title="x', "&#xD800;&bogus;"])
def test_broken_pages(page):
    assert isinstance(extract(page), str)


def test_pages_of_a_table(spark):
    deep = "<div>" * 3_000 + "<p>Deep text is here.</p>"
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, "t"), (3, "v", "", "t"), (None, "w", deep, "t"), (4, "x", "<article>" + "<p>One more line.</p>" * 5_000 + "</article>", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_texts(df).collect()
    assert [r.n_chars for r in got[:4]] == [len(extract(PAGE))] * 2 + [0, 0] and got[2].url is None
    assert got[5].text == "\n".join(["One more line."] * 5_000) and main_texts(df.limit(0)).count() == 0




@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(str(Path(SF) / "documents.parquet"))
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert kept <= ids and kept, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            docs, ids = out, kept
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).filter("lossless").collect()} == ids
