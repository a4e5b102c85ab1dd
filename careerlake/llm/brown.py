"""Scoring texts with a Brown class-based bigram model.

Words are put into classes by exchange clustering, in two steps. The most frequent words, and all other words by their form (script,
ending, last mark), are items that move one at a time to the class that raises the likelihood of the class bigrams most, until
nothing moves. Then every word of a large table, starting where its form is, moves to the class that raises the likelihood of its own
occurrences most, by its neighbours' classes, in rounds in which all move at once and the class tables follow. The table grows with
the vocabulary up to a bound that a task can hold; only words beyond it, and unknown ones, keep the class of their form. A
text's probability is the product of smoothed class transitions and word emissions:

    P(w_i | w_i-1) = P(c_i | c_i-1) * (count(w_i) + 1) / (count(c_i) + words(c_i) + 1)
    P(c | b) = (count(b, c) + mu * P(c)) / (count(b) + mu),  P(c) = (count(c) + words(c) + 1) / sum of the same over all classes

so that each class keeps one unseen word's share. An end token closes each text and is the context of the first word.

Counts cover all training texts. Texts are read twice: to count words, and to write each text as a list of items, from which the
rounds and the scores are taken. A round sums (word, neighbour's class) by word, in rows that are added up in each task before. Word
counts stay distributed: a task knows those of the table, and each rarer word of a text is looked up by a join on the word, where no
word can be hot, since every word with more than a bounded share of the tokens is in the table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerlake.llm.common import Saved, as_bytes, texts

END = b"\n"  # no word holds it
FORMS = 256


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def form(word: bytes) -> int:
    """The item of a word that isn't frequent: from its last letters, its last mark and whether it has marks or digits inside."""
    core = word.rstrip(b".,;:!?\"')]}%&*$#")
    kind = 0 if core.isalpha() else 1 if core.isdigit() else 2 if any(48 <= c < 58 for c in core) else 3 if core.translate(None, bytes(range(97, 123))).isascii() else 4
    return zlib.crc32(b"%d %d %s" % (kind, len(word) > len(core), core[-2:])) % FORMS


class Items(dict):
    """word -> item: the table's words from FORMS on, forms below; some others are kept for when they come again."""

    def __init__(self, frequent: list[bytes]):
        self.frequent, self.others = frequent, 0
        self.begin()

    def begin(self) -> None:
        self.clear()
        self.update(zip(self.frequent, range(FORMS, FORMS + len(self.frequent)), strict=True))

    def __missing__(self, word: bytes) -> int:
        item = form(word)
        if len(word) <= 64:
            self.others += 1
            if self.others > 100_000:
                self.others = 0
                self.begin()
            self[word] = item
        return item


def exchange(bigrams: np.ndarray, classes: int) -> np.ndarray:
    """A class for each item: moves one item at a time to where sum n log n over class bigrams, less 2 sum n log n over classes, grows most, until none moves.

    Each move makes the sum grow by more than rounding, so no classes come again and it ends.
    """
    n = len(bigrams)
    total = bigrams.sum(axis=1) + bigrams.sum(axis=0)
    order = np.argsort(-total, kind="stable")
    of = np.zeros(n, np.int64)
    of[order] = np.arange(n) % classes
    one = np.zeros((n, classes))
    one[np.arange(n), of] = 1
    right, left = bigrams @ one, bigrams.T @ one  # item -> class after it, class before it
    both = one.T @ right
    rows, columns = bigrams.sum(axis=1), bigrams.sum(axis=0)
    out, into = one.T @ rows, one.T @ columns
    xlogx = lambda v: v * np.log(np.maximum(v, 1e-300))
    least = 1e-9 + 1e-13 * xlogx(bigrams.sum())  # what a move must gain: above rounding, or it might not end
    moved = True
    while moved:
        moved = False
        for i in order:
            if not total[i]:
                continue
            a, loop = of[i], bigrams[i, i]
            r, l = right[i].copy(), left[i].copy()
            r[a] -= loop
            l[a] -= loop
            # take i out of its class
            both[a] -= r
            both[:, a] -= l
            both[a, a] -= loop
            out[a] -= rows[i]
            into[a] -= columns[i]
            # what putting it into each class adds; k's own row and column change in one cell twice
            gain = (xlogx(both + r[None]) - xlogx(both)).sum(axis=1) + (xlogx(both + l[:, None]) - xlogx(both)).sum(axis=0)
            d = np.diag(both)
            gain += xlogx(d + r + l + loop) - xlogx(d + r) - xlogx(d + l) + xlogx(d)
            gain -= xlogx(out + rows[i]) - xlogx(out) + xlogx(into + columns[i]) - xlogx(into)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + least:
                b = int(a)
            both[b] += r
            both[:, b] += l
            both[b, b] += loop
            out[b] += rows[i]
            into[b] += columns[i]
            if b != a:
                moved = True
                of[i] = b
                right[:, a] -= bigrams[:, i]
                right[:, b] += bigrams[:, i]
                left[:, a] -= bigrams[i]
                left[:, b] += bigrams[i]
    return of


@dataclass
class Model:
    """All of bounded size: the table's words (END first, the most frequent next), their counts, and the class tables."""

    frequent: list[bytes]  # the table's words, in order of items from FORMS on
    counts: np.ndarray  # theirs
    classes: np.ndarray  # item -> class
    transition: np.ndarray  # log10 P(c | b)
    emission: np.ndarray  # log10 of 1 / (count(c) + words(c) + 1)
    train_tokens: int
    vocabulary: int
    clustered: float  # the share of training tokens whose words are in the table


@dataclass
class Counts:
    words: DataFrame  # word, n: all words of the training texts
    model: Model


def count_words(train: DataFrame) -> DataFrame:
    """(word, n) of a table's column text, ends included."""

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return b

        for b in batches:
            for t in as_bytes(b.column(0)):
                seen.update(tokens(t))
                seen[END] += 1
                if len(seen) > 300_000:
                    yield out()
        if seen:
            yield out()

    return Saved(train.select("text").mapInArrow(counting, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words").df


def table_of(words: DataFrame, known: int) -> list[tuple[bytes, int]]:
    """The words of the least count such that at most `known` words have it, END first, then by count."""
    # from a histogram: no task sends more than its share of them
    sizes = words.groupBy(F.floor(F.log2("n") * 16).alias("size")).count().collect()
    least, room = None, known
    for r in sorted(sizes, key=lambda r: -r["size"]):
        if r["count"] > room:
            break
        room -= r["count"]
        least = r["size"]
    rows = words.filter((F.floor(F.log2("n") * 16) >= least) & (F.col("word") != F.lit(END))).toArrow() if least is not None else None
    found = list(zip(rows.column("word").to_pylist(), rows.column("n").to_pylist(), strict=True)) if rows is not None else []
    end = words.filter(F.col("word") == F.lit(END)).first()
    return [(END, end["n"] if end else 0), *sorted(found, key=lambda x: (-x[1], x[0]))]


def encode(docs: DataFrame, frequent: list[bytes], counts: np.ndarray, kind: str) -> DataFrame:
    """Per row of docs (doc_id, text, learns): its items, how many tokens are in the table, the sum of log10(count + 1) over those, and its other words."""
    lift = np.log10(counts + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = Items(frequent)
        for b in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):  # words of few texts at once
            ids, known, gain, rare = [], [], [], []
            for t in as_bytes(b.column(1)):
                found = [*tokens(t), END]
                x = np.fromiter(map(item.__getitem__, found), np.int32, len(found))
                own = x[x >= FORMS] - FORMS
                ids.append(x)
                known.append(len(own))
                gain.append(float(lift[own].sum()))
                rare.append(Counter([found[i] for i in np.flatnonzero(x < FORMS).tolist()]))
            ends = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            each = ends([len(w) for w in rare])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(2),
                    pa.ListArray.from_arrays(ends([len(x) for x in ids]), pa.array(np.concatenate(ids))),
                    pa.array(known, pa.int64()),
                    pa.array(gain, pa.float64()),
                    pa.ListArray.from_arrays(each, pa.array([w for r in rare for w in r], pa.binary())),
                    pa.ListArray.from_arrays(each, pa.array([n for r in rare for n in r.values()], pa.int32())),
                ],
                names=["doc_id", "learns", "ids", "n_known", "gain", "rare", "times"],
            )

    local = docs.select("doc_id", "text", "learns").mapInArrow(run, f"doc_id {kind}, learns boolean, ids array<int>, n_known long, gain double, rare array<binary>, times array<int>")
    return Saved(local.withColumn("row", F.monotonically_increasing_id()), "encoded").df


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The items of a task's texts one after another, an end before each."""
    end = np.array([FORMS], np.int32)
    for b in batches:
        if b.num_rows:
            yield np.concatenate([end, b.column(0).flatten().to_numpy()])


def _bigrams(local: DataFrame, of: np.ndarray, n: int) -> np.ndarray:
    """How often a token of one group is followed by one of another; of: each item's group, of n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(n * n, np.int64)
        for x in _sequences(batches):
            c = of[x]
            cells += np.bincount(c[:-1] * n + c[1:], minlength=n * n)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], names=["cell", "n"])

    got = local.select("ids").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # n^2 rows at most
    out = np.zeros((n, n))
    out.ravel()[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out


def _moves(local: DataFrame, of: np.ndarray, first: int, transition: np.ndarray, emission: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items from first on, and the class of each that makes its occurrences likeliest beside its neighbours' classes."""
    classes = len(emission)
    width = 2 * classes

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _sequences(batches):
            at = np.flatnonzero(x >= first)  # never the first token, an end, nor the last
            item, c = x[at].astype(np.int64) - first, of[x]
            cell, n = np.unique(np.concatenate([item * width + c[at - 1], item * width + classes + c[at + 1]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((cell // width).astype(np.int32)), pa.array((cell % width).astype(np.int16)), pa.array(n.astype(np.int32))], names=["item", "c", "n"])

    def moving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def add() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([cells, *(c for c, _ in waiting)])
            found, at = np.unique(every, return_inverse=True)
            total = np.bincount(at, np.concatenate([sums, *(n for _, n in waiting)]), minlength=len(found)).astype(np.int64)
            waiting.clear()
            return found, total

        for b in batches:
            item, c, n = (b.column(i).to_numpy().astype(np.int64) for i in range(3))
            waiting.append((item * width + c, n))
            if sum(len(c) for c, _ in waiting) > 2_000_000:
                cells, sums = add()
        cells, sums = add()
        items, row = np.unique(cells // width, return_inverse=True)
        best = np.zeros(len(items), np.int32)
        # a word before class d, after class b, and its own emission, each time
        gain = np.concatenate([transition + emission[None] / 2, transition.T + emission[None] / 2])
        for at in range(0, len(items), 4096):
            here = (row >= at) & (row < at + 4096)
            m = np.zeros((min(4096, len(items) - at), width))
            m[row[here] - at, cells[here] % width] = sums[here]
            best[at : at + 4096] = np.argmax(m @ gain, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(items.astype(np.int32)), pa.array(best)], names=["item", "c"])

    pairs = local.select("ids").mapInArrow(counting, "item int, c short, n int").repartition("item")
    got = pairs.mapInArrow(moving, "item int, c int").toArrow()  # a row for each word of the table
    return got.column("item").to_numpy() + first, got.column("c").to_numpy()


def cluster(words: DataFrame, table: list[tuple[bytes, int]], local: DataFrame, own: int, classes: int, mu: float, rounds: int) -> Model:
    """Classes for the table's words and the forms, from the encoded training texts."""
    frequent, counts = [w for w, _ in table], np.array([n for _, n in table], np.int64)
    items, first = FORMS + len(frequent), FORMS + min(own, len(frequent))
    start = np.arange(items)
    start[first:] = [form(w) for w in frequent[first - FORMS :]]
    of = exchange(_bigrams(local, start, first), classes)[start]

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, n = Items(frequent), np.zeros(items, np.int64)
        for b in batches:
            n += np.bincount(np.fromiter(map(item.__getitem__, b.column(0).to_pylist()), np.int64, b.num_rows), minlength=items)
        at = np.flatnonzero(n[:FORMS])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["item", "n"])

    sums = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, vocabulary = int(sums["n"] or 0), int(sums["v"])
    distinct = np.zeros(items)
    distinct[FORMS:] = counts > 0
    for r in words.select("word").mapInArrow(forms, "item long, n long").groupBy("item").agg(F.sum("n").alias("n")).collect():
        distinct[r["item"]] = r["n"]

    def tables(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = _bigrams(local, of, classes)
        size = both.sum(axis=0) + np.bincount(of, distinct, minlength=classes) + 1
        share = size / size.sum()
        return np.log10((both + mu * share) / (both.sum(axis=1, keepdims=True) + mu)), -np.log10(size)

    if not total:
        return Model(frequent, counts, of, np.zeros((classes, classes)), np.zeros(classes), 0, vocabulary, 0.0)
    transition, emission = tables(of)
    for _ in range(rounds if first < items else 0):
        at, to = _moves(local, of, first, transition, emission)
        of = of.copy()
        of[at] = to
        transition, emission = tables(of)
    return Model(frequent, counts, of, transition, emission, total, vocabulary, float(counts.sum() / total))


def learn(train: DataFrame, own: int = 768, known: int = 196_608, classes: int = 64, mu: float = 20.0, rounds: int = 3) -> Counts:
    """Counts all training texts (column text) and fits the model.

    own: words that move on their own first; known: words of the table, which tasks hold (both bound what is sent out);
    classes: how many; mu: smoothing of transitions; rounds: how often all words of the table move. No training texts: every probability is 1.
    """
    words = count_words(train)
    table = table_of(words, known)
    rows = train.select(F.lit(0).alias("doc_id"), "text", F.lit(True).alias("learns"))
    local = encode(rows, [w for w, _ in table], np.array([n for _, n in table]), "int")
    return Counts(words, cluster(words, table, local, own, classes, mu, rounds))


def score(local: DataFrame, learnt: Counts, id_col: str) -> DataFrame:
    """The scores of encoded texts."""
    model = learnt.model
    fixed = -np.log10(model.train_tokens + model.vocabulary + 1) if model.train_tokens else 0.0
    of, transition, emission = model.classes, model.transition, model.emission

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(1)
            c = of[np.concatenate([[FORMS], ids.flatten().to_numpy()])]
            each = transition[c[:-1], c[1:]] + emission[c[1:]]
            n = ids.value_lengths().to_numpy()
            fit = np.add.reduceat(each, np.concatenate([[0], np.cumsum(n)[:-1]]))  # no text is without its end
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n.astype(np.int64)), pa.array(fit), *b.columns[2:]], names=["row", "n_tokens", "fit", *b.schema.names[2:]])

    kind = local.schema["doc_id"].dataType.simpleString()
    scored = local.select("row", "ids", "doc_id", "n_known", "gain").mapInArrow(run, f"row long, n_tokens long, fit double, doc_id {kind}, n_known long, gain double")
    rare = local.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("k"))
    found = rare.join(learnt.words, "word").groupBy("row").agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("others"))
    both = scored.join(found, "row", "left")
    gain = F.col("gain") + F.coalesce("others", F.lit(0.0))
    n_known = (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known")
    n, whole = F.col("n_tokens"), F.col("fit") + gain
    if not model.train_tokens:
        n_known, gain, whole = F.lit(0).cast("long").alias("n_known"), F.lit(0.0), F.lit(0.0)
    return both.select(F.col("doc_id").alias(id_col), "n_tokens", n_known, F.lit(model.train_tokens).cast("long").alias("train_tokens"), (gain + n * fixed).alias("base_score"), whole.alias("score"), F.pow(F.lit(10.0), -whole / n).alias("perplexity"))


def text_scores(docs: DataFrame, learnt: Counts, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    base_score is the add-one unigram log10 probability, score the model's, perplexity 10^(-score / n_tokens). A null text is empty; an
    empty text is its end token. Repeated rows each give a row, rows with a null id too; further columns are ignored; an empty table
    gives an empty result. With no training texts base_score and score are 0.
    """
    rows = texts(docs, id_col, text_col).withColumn("learns", F.lit(False))
    return score(encode(rows, learnt.model.frequent, learnt.model.counts, docs.schema[id_col].dataType.simpleString()), learnt, id_col)


def class_model_scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", own: int = 768, known: int = 196_608, classes: int = 64, mu: float = 20.0, rounds: int = 3) -> DataFrame:
    """Learns from the rows for which train (a condition on doc_id) holds and scores all, as learn and text_scores do with the texts encoded once."""
    rows = texts(docs, id_col, text_col).withColumn("learns", F.coalesce(train, F.lit(False)))
    words = count_words(rows.filter("learns"))
    table = table_of(words, known)
    local = encode(rows, [w for w, _ in table], np.array([n for _, n in table]), docs.schema[id_col].dataType.simpleString())
    return score(local, Counts(words, cluster(words, table, local.filter("learns"), own, classes, mu, rounds)), id_col)
