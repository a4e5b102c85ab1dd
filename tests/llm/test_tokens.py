import random

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from careerlake.llm.merge_dropout import Segmenter, decoded, segmentations
from careerlake.llm.token_counts import PrefixCounter, prefix_counts, token_counts, within_budget

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "th", "e", " ", " ", "  ", "\n", "\n ", "'s", "'", "'ll", "é", "中", "12", "!", "?!", " \t", " ", "<|endoftext|>", "ing", "tion", "▁", "<s>", "😀"]


def texts(n, seed, without=()):
    rng = random.Random(seed)
    return ["".join(p for p in rng.choices(PARTS, k=rng.randint(0, 14)) if p not in without) for _ in range(n)]


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(BPE)


def test_every_prefix_and_budget_matches_the_library(counter):
    t = Tokenizer.from_file(BPE)
    n = lambda s: len(t.encode(s, add_special_tokens=False).ids)
    for s in texts(400, 1):
        want = [n(s[:i]) for i in range(len(s) + 1)]
        assert prefix_counts(counter, s) == want
        assert counter.count(s.encode()) == want[-1]
        for budget in (0, 1, 3, 6):
            longest = max(len(s[:i].encode()) for i in range(len(s) + 1) if want[i] <= budget)
            assert counter.fit(s.encode(), budget) == (want[-1], longest)


def test_budgets_at_special_tokens(counter):
    t = Tokenizer.from_file(BPE)
    rng = random.Random(3)
    units = ["a", "é", " ", "  ", "\n", "'s", "12", "<|endoftext|>", "<|endof", "<|", "text|>", "!", "word", " the", "\t"]
    for s in ["é  \n <|endoftext|>", *("".join(rng.choices(units, k=rng.randint(1, 9))) for _ in range(600))]:
        want = [len(t.encode(s[:i], add_special_tokens=False).ids) for i in range(len(s) + 1)]
        for budget in (0, 2, 5):
            longest = max(len(s[:i].encode()) for i in range(len(s) + 1) if want[i] <= budget)
            assert counter.fit(s.encode(), budget) == (want[-1], longest), (s, budget)


def test_any_budget_from_the_stored_counts(spark):
    t = Tokenizer.from_file(BPE)
    rows = [(i, s, i % 9) for i, s in enumerate([*texts(60, 5), "", "one two  three\n four <|endoftext|> five"])] + [(None, None, 3), (7, "again and again", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, budget int").withColumn("a.b", F.lit(1))
    counted = token_counts(df, BPE).select("doc_id", "n_tokens", "prefix_tokens").distinct()
    both = df.join(counted, df.doc_id.eqNullSafe(counted.doc_id)).drop(counted.doc_id).filter((F.col("doc_id") != 7) | F.col("doc_id").isNull())
    got = within_budget(both, BPE, F.col("budget")).collect()
    assert len(got) == len(rows) - 2
    for r in got:
        n = lambda s: len(t.encode(s, add_special_tokens=False).ids)
        s = r.text or ""
        assert r.fits == max(len(s[:i].encode()) for i in range(len(s) + 1) if n(s[:i]) <= r.budget) and r["a.b"] == 1
        assert (r.prefix_tokens or [0])[-1] == n(s) == r.n_tokens
    assert [r.fits for r in within_budget(both.limit(3), BPE, -1).collect()] == [0, 0, 0] and within_budget(both.limit(0), BPE, 5).count() == 0


def test_one_very_long_word(counter):
    t = Tokenizer.from_file(BPE)
    word = "abcthe" * 5_000
    assert counter.count(word.encode()) == len(t.encode(word).ids)


def test_token_counts_of_a_table(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "two words", 0), (3, "two words", 0), (None, "x" * 100_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = token_counts(df, BPE, limit=1).collect()
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit, r.fit_bytes) for r in got[:4]] == [(1, 0, 0, False, 0), (2, 0, 0, False, 0), (3, 9, 2, True, 3), (3, 9, 2, True, 3)]
    assert got[4].n_bytes == 100_000 and token_counts(df.limit(0), BPE).count() == 0


def test_without_dropout_the_library_is_matched():
    sp, s = sentencepiece.SentencePieceProcessor(model_file=PIECES), Segmenter(PIECES, rate=0.0)
    for t in texts(500, 2, without=("▁",)):
        assert s.encode(t).tolist() == sp.encode(t)


def test_dropout_is_lossless_and_seeded():
    a, b, c = Segmenter(PIECES, 0.3, seed=1), Segmenter(PIECES, 0.3, seed=1), Segmenter(PIECES, 0.3, seed=2)
    for t in texts(500, 3):
        assert a.decode(a.encode(t, 1)) == t and a.encode(t).tolist() == b.encode(t).tolist()
    long = "The committee met again on Tuesday to weigh the proposal"
    assert a.encode(long).tolist() != c.encode(long).tolist() and a.encode(long, 0).tolist() != a.encode(long, 1).tolist()
    assert Segmenter(PIECES, 1.0).encode("the cat").tolist() == [a.ids[x] for x in "▁the▁cat"]


def test_both_agendas_agree():
    s, rng = Segmenter(PIECES, 0.2), random.Random(4)
    for _ in range(60):
        w = "▁" + "".join(rng.choices(["ab", "the", "e", "n", "tion", "中"], k=12))
        assert s.merge_short(list(w), w.encode(), 1) == s.merge_long(list(w), w.encode(), 1)


def test_segmentations_of_a_table(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "  two  words ", 0), (3, "  two  words ", 0), (None, "▁a\n" * 20_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = segmentations(df, PIECES)
    assert [(r.n_chars, r.lossless) for r in got.collect()] == [(0, True), (0, True), (13, True), (13, True), (60_000, True)]
    assert [r.text for r in decoded(got, PIECES).collect()] == ["", "", "  two  words ", "  two  words ", "▁a\n" * 20_000]
    assert segmentations(df.limit(0), PIECES).count() == 0


def test_words_are_the_same_by_the_library_and_beside_marks():
    s, plain = Segmenter(PIECES, 0.2, seed=7), Segmenter(PIECES, 0.2, seed=7)
    plain.library = None
    for t in [*texts(300, 5), "Another committee, gathering.\nEs war (einmal) eine a,b,c", "\n", ".", "é.", "a" * 70 + ",b"]:
        assert s.encode(t, 1).tolist() == plain.encode(t, 1).tolist() and s.decode(s.encode(t, 1)) == t
    word, comma = (s.segment(x, 0) for x in ("▁committee", "▁committee,"))
    assert comma.startswith(word) and len(comma) > len(word)
    long = "▁" + "ab,cd.\n" * 20
    assert s.segment(long, 0) == plain.segment(long, 0)


def test_each_occurrence_has_draws_of_its_own(spark):
    s = Segmenter(PIECES, 0.1, seed=5)
    word = "committee"
    # repeats in a text, and copies in many documents
    ids, cut = s.encode(" ".join([word] * 400)).tolist(), s.ids["▁committee"] if "▁committee" in s.ids else None
    found, one = set(), []
    for i in ids:
        if s.spell[i].startswith(b" ") and one:
            found.add(tuple(one))
            one = []
        one.append(i)
    assert len(found) > 10 and (cut is None or (cut,) in found)
    df = spark.createDataFrame([(i, "The committee met again on Tuesday") for i in range(200)], "doc_id long, text string")
    got = segmentations(df, PIECES, seed=5).collect()
    assert len({tuple(r.ids) for r in got}) > 50 and all(r.lossless for r in got)


def test_what_is_kept_changes_nothing():
    import careerlake.llm.merge_dropout as m

    s, rng = Segmenter(PIECES, 0.2, seed=3), random.Random(6)
    words = ["committee", "Tuesday,", "e.g.", "naïve", "中文", "12,000.5", "a", "gathering.\nAnother", "x" * 80]
    for k in range(60):
        t = " ".join(rng.choices(words, k=30))
        fresh = Segmenter.__new__(Segmenter)
        fresh.__dict__ = s.__dict__ | {"begin": {}, "later": {}, "old_begin": {}, "old_later": {}, "made": 0, "library": None}
        assert s.encode(t, k).tolist() == fresh.encode(t, k).tolist() and s.decode(s.encode(t, k)) == t
        s.made = m.KEPT if k % 7 == 0 else s.made  # the older generation goes


def test_skips_are_as_frequent_as_the_rate():
    s = Segmenter(PIECES, 0.1, seed=1)
    n = sum(len(s.skipped(k, 10_000)) - 1 for k in range(50))
    assert abs(n / 500_000 - 0.1) < 0.003 and s.skipped(1, 100)[:-1] == [x for x in s.skipped(1, 1_000) if x < 100]


def plain_agenda(s, text, key):
    """The ids of a text of single spaces, by trying every neighbouring pair at each turn; draws from the counter's formula."""
    start, turn, out = xxhash.xxh64_intdigest(b"%d:%d" % (s.seed, key)), 0, []

    def drawn(k):
        z = (start + (k // 4 + 1) * 0x9E3779B97F4A7C15) % 2**64
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        z = (z ^ z >> 27) * 0x94D049BB133111EB % 2**64
        return (z ^ z >> 31) >> 16 * (k % 4) & 0xFFFF

    for word in text.split(" "):
        for mark, rest in s.parts("▁" + word) or [("▁", word)]:
            symbols, skipped = [(c, object()) for c in mark + rest], set()
            while True:
                pairs = [(s.rank[a + b], i) for i, ((a, x), (b, y)) in enumerate(zip(symbols, symbols[1:])) if a + b in s.rank and (x, y) not in skipped]  # noqa: B905
                if not pairs:
                    break
                _, i = min(pairs)
                turn += 1
                (a, x), (b, y) = symbols[i : i + 2]
                if drawn(turn - 1) < s.limit:
                    skipped.add((x, y))
                else:
                    symbols[i : i + 2] = [(a + b, object())]
            for piece, _ in symbols:
                out += [s.ids[piece]] if piece in s.ids else [s.bytes[b] for b in piece.encode()]
    return out


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_dropout_against_a_plain_agenda(rate):
    rng = random.Random(6)
    s = Segmenter(public_tokenizers.path("piece_bpe_32k.model"), rate, 5)
    words = ["the", "internationalization", "of", "naïve", "state-of-the-art.", "don't", "1234", "x" * 80, "Überraschung!", "日本", "a"]
    seen = set()
    for key in range(60):
        text = " ".join(rng.choices(words, k=rng.randint(1, 12)))
        got = s.encode(text, key).tolist()
        assert got == plain_agenda(s, text, key)
        seen.add(tuple(s.encode("internationalization", key).tolist()))
    assert (len(seen) > 5) == (0 < rate < 1)


def test_tasks_hold_slices_and_a_bounded_store(spark, monkeypatch):
    import careerlake.llm.merge_dropout as m
    from careerlake.llm.common import map_arrow

    def make():
        return lambda b: pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    df = spark.range(200).coalesce(1)
    assert [r.n for r in map_arrow(df, make, "n long", m.ROWS).collect()] == [64, 64, 64, 8] and [r.n for r in map_arrow(df, make, "n long").collect()] == [200]
    monkeypatch.setattr(m, "KEPT", 500)
    rng, s, plain = random.Random(8), Segmenter(PIECES, 0.2, seed=3), Segmenter(PIECES, 0.2, seed=3)
    for k in range(60):
        t = " ".join("".join(rng.choices("abehinorst,", k=rng.randint(3, 60))) for _ in range(40)) + " the committee, again"
        plain.begin, plain.later, plain.old_begin, plain.old_later = {}, {}, {}, {}
        assert s.encode(t, k).tolist() == plain.encode(t, k).tolist()
        kept = [s.begin, s.later, s.ways, s.old_begin, s.old_later, s.old_ways]
        assert sum(map(len, kept[:3])) <= m.KEPT + 200 and sum(map(len, kept)) <= 2 * (m.KEPT + 200)
    assert s.ways and s.old_ways
    for k in range(300):  # of words that are known, new ways
        s.encode("anotherhabitation nonhabitation thenorthernhabitations " * 10, k)
        assert len(s.ways) <= m.KEPT


@pytest.mark.parametrize(("rate", "seed"), [(0.1, 5), (0.0, 5), (0.6, 2), (1.0, 5)])
def test_texts_encoded_together_are_as_one_by_one(rate, seed, monkeypatch):
    import careerlake.llm.merge_dropout as m

    monkeypatch.setattr(m, "LEAST", 4)
    monkeypatch.setattr(m, "GROUP", 30_000)
    rng = random.Random(seed)
    words = ["the", "internationalization", "of", "naïve", "state-of-the-art.", "don't", "1234", "gathering.\nAnother", "Überraschung!", "日本", "😀", "e.g.", "(a,b)", "\n", "Straße", "\x00"]
    odd = ["", " ", "a", " lead", "trail ", "two  spaces", "with ▁ mark", "x" * 80 + " after", "ab" * 300, "é😀" * 40, "\n\n", "."]
    docs = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(300)] + odd + [" ".join(rng.choices(words, k=4_000))]
    rng.shuffle(docs)
    keys = [rng.randrange(1 << 64) for _ in docs]
    s, one = Segmenter(PIECES, rate, seed), Segmenter(PIECES, rate, seed)
    got = s.encode_all(docs, keys)
    assert [i.tolist() for i in got] == [one.encode(t, k).tolist() for t, k in zip(docs, keys, strict=True)]
    assert all(i.dtype.str == "<i4" and s.decode(i) == t for i, t in zip(got, docs, strict=True)) and s.encode_all([], []) == []


def test_few_texts_of_a_batch_go_through_the_agenda_alone(monkeypatch):
    s, alone, rest = Segmenter(PIECES, 0.1, seed=5), [], []
    encode, encode_rest = s.encode, s.encode_rest
    monkeypatch.setattr(s, "encode", lambda t, k=0: alone.append(t) or encode(t, k))
    monkeypatch.setattr(s, "encode_rest", lambda t, k, n: rest.append(t) or encode_rest(t, k, n))
    rng = random.Random(9)
    docs = [" ".join("".join(rng.choices(["an", "the", "tion", "er", "en"], k=rng.randint(1, 5))) for _ in range(rng.randint(90, 110))) for _ in range(400)]
    s.encode_all(docs, list(range(len(docs))))
    assert not alone and sum(map(len, rest)) < 0.05 * sum(map(len, docs))
