"""Toxicity: a logistic classifier whose training also penalises score changes under identity swaps.

Features are the presence of words and of word beginnings (3 to 6 letters, so that inflected forms of a
stem count together). Those that tell the classes apart are chosen by a z statistic over a bounded sample of
labelled rows. The fit adds to the usual loss, for every labelled text that names a group, the square of
the difference between its logit and that of the same text with the group's name swapped for another of
its kind. Weights that rest on which group is named are so driven together, and neutral mentions of a group
score like mentions of any other.

What counts as a name is given, by kind, and found in the labelled texts as well: words that tell the classes apart a little, though both
use them much, are more likely what is spoken of than an insult. Each of them is swapped for the one that it occurs
with most, so for a word of the same language. Invented or unlisted names of groups are so covered too.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerlake.llm.common import Saved, as_bytes, filter_arrow, map_arrow, texts

#: Names of groups, by kind; a swap stays within the kind.
IDENTITY = {
    "gender": ["man", "woman", "men", "women", "male", "female", "transgender"],
    "religion": ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"],
    "origin": ["african", "american", "asian", "european", "latino", "arab", "mexican", "chinese", "indian"],
    "colour": ["black", "white", "brown"],
    "orientation": ["gay", "straight", "lesbian", "bisexual", "heterosexual"],
    "ability": ["deaf", "blind", "disabled", "autistic"],
    "age": ["young", "old", "elderly", "teenage"],
    "gender_de": ["mann", "frau", "männer", "frauen", "männlich", "weiblich"],
    "religion_de": ["christen", "muslime", "juden", "hindus", "buddhisten", "atheisten"],
    "origin_de": ["afrikaner", "amerikaner", "asiaten", "europäer", "araber", "türken", "deutsche"],
    "gender_fr": ["homme", "femme", "hommes", "femmes", "masculin", "féminin"],
    "religion_fr": ["chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"],
    "origin_fr": ["africains", "américains", "asiatiques", "européens", "arabes", "français"],
    "gender_es": ["hombre", "mujer", "hombres", "mujeres", "masculino", "femenino"],
    "religion_es": ["cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"],
    "origin_es": ["africanos", "americanos", "asiáticos", "europeos", "árabes", "mexicanos"],
}
LETTERS = re.compile(r"[^\W\d_]+")


def swaps(kinds: dict[str, list[str]]) -> dict[str, str]:
    """Each term's replacement: the next of its kind, around."""
    return {w: names[(i + 1) % len(names)] for names in kinds.values() for i, w in enumerate(names)}


def partners(names: list[str], found: list[list[int]]) -> dict[str, str]:
    """Each name's replacement: the one it occurs with most for their frequencies (cosine), of those not taken yet, frequent names first.

    found: the places in names of those that each text holds. A name left alone, or never met with another, has none.
    """
    n = len(names)
    on = np.zeros((len(found), n))
    for row, at in enumerate(found):
        on[row, at] = 1
    both, times = on.T @ on, on.sum(axis=0)
    near = both / np.sqrt(np.outer(times, times).clip(1))
    np.fill_diagonal(near, -1)
    out: dict[str, str] = {}
    free = np.ones(n, bool)
    for i in sorted(range(n), key=lambda i: (-times[i], names[i])):
        if not free[i]:
            continue
        free[i] = False
        if not free.any():
            break
        j = int(np.argmax(np.where(free, near[i], -1)))
        if near[i, j] > 0:
            free[j] = False
            out[names[i]], out[names[j]] = names[j], names[i]
    return out


def features(word: str) -> list[str]:
    """A word's features: itself, and its first 3 to 6 letters if it is longer."""
    return [word, *(word[:k] + "-" for k in range(3, min(7, len(word) + 1)))]


def words(token: str) -> list[str]:
    return LETTERS.findall(token)


def document_words(text: str) -> set[str]:
    return {w for t in set(text.lower().split()) for w in words(t)}


@dataclass
class Model:
    """bias and weights by feature; few thousand entries at most. swaps: the terms swapped in the fit; swapped: texts that this changed."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)
    swaps: dict[str, str] = field(default_factory=dict)
    swapped: int = 0

    def scorer(self):
        index = {f: i for i, f in enumerate(self.weights)}
        value = list(self.weights.values())

        class Known(dict):
            def __missing__(self, token):
                found = tuple({index[f] for w in words(token) for f in features(w) if f in index})
                if len(token) <= 64:
                    if len(self) > 500_000:
                        self.clear()
                    self[token] = found
                return found

        known, bias = Known(), self.bias

        def score(text: str) -> float:
            on: set[int] = set()
            for f in map(known.__getitem__, set(text.lower().split())):
                if f:
                    on.update(f)
            z = bias + sum(value[i] for i in sorted(on))
            return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

        return score


def clean_labels(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """One row for each id whose labels are 0 or 1 and agree; others, and null ids, teach nothing."""
    return (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("_most"))
        .filter("label = _most")
        .drop("_most")
    )


def fit(docs: DataFrame, labels: DataFrame, train: Column, label_col: str = "toxic", sample: int = 20_000, most_features: int = 6_000, least_z: float = 5.0, pairing: float = 1.0, l2: float = 3e-6, kinds: dict[str, list[str]] | None = None, neutral: int = 128) -> Model:
    """Learns from labelled rows for which train (a condition on doc_id) holds.

    sample bounds the labelled rows used: of more, a share is drawn by the id's hash so that about so many are
    expected. Null texts are empty; labels that are null, neither 0 nor 1, or that differ for one id aren't used.
    neutral: how many words that pull towards a class (z of 2 or more) though both have them (rates within a factor of 4, 5 texts of
    each at least) are swapped besides those of kinds, and are features. The model says how many texts the swaps changed; a warning says that there was none, so that pairing did nothing.
    Without labels of both classes the model gives 0.5 (no labels) or the class's smoothed share to every text.
    """
    kinds = IDENTITY if kinds is None else kinds
    swap = swaps(kinds)
    known = clean_labels(labels, label_col).filter(train)
    n = known.count()
    if n > sample:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    # the sample is bounded by its parameter, so it is sent to all tasks and no text is shuffled
    # they are written, so that the documents are read once
    rows = Saved(texts(docs).join(F.broadcast(known), "doc_id").select("label", "text"), "labelled").df

    def counting():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            seen: dict[str, list[int]] = {}
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for f in {f for w in document_words(text) for f in features(w)}:
                    seen.setdefault(f, [0, 0])[y] += 1
            both = list(seen.values())
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([b[0] for b in both], pa.int64()), pa.array([b[1] for b in both], pa.int64())], names=["feature", "n0", "n1"])

        return run

    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return Model(float(np.log((n1 + 0.5) / (n0 + 0.5))))
    p0, p1 = (F.col("n0") + 0.5) / (n0 + 1), (F.col("n1") + 0.5) / (n1 + 1)
    z = (p1 - p0) / F.sqrt(p0 * (1 - p0) / n0 + p1 * (1 - p1) / n1 + F.lit(1e-12))
    lift = F.log(p1 / p0)
    counts = Saved(map_arrow(rows, counting, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "features").df
    chosen = counts.filter(F.col("n0") + F.col("n1") >= 4).withColumn("z", F.abs(z)).filter((F.col("z") >= least_z) | (F.col("z") >= 2) & (F.abs(lift) >= 3)).orderBy(F.desc("z"), "feature").limit(most_features)
    picked = {r["feature"] for r in chosen.select("feature").collect()}
    # words that tell the classes apart a little though they are usual in both: those with the most pull first
    like = counts.filter((F.least("n0", "n1") >= 5) & (F.abs(lift) < float(np.log(4))) & ~F.col("feature").endswith("-") & ~F.col("feature").isin(list(swap))).withColumn("z", F.abs(z))
    usual = sorted(r["feature"] for r in like.filter("z >= 2").orderBy(F.desc("z"), "feature").limit(neutral).collect())
    place = {w: i for i, w in enumerate(usual)}

    def meeting():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [sorted(place[w] for w in document_words(t) & place.keys()) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], names=["at"])

        return run

    neutrals = {}
    if usual:
        neutrals = partners(usual, map_arrow(rows, meeting, "at array<int>").toArrow().column("at").to_pylist())  # as many rows as the sample
    names = sorted(picked | {*swap, *neutrals})
    index = {f: i for i, f in enumerate(names)}

    def indexing():
        def on(found: set[str]) -> list[int]:
            return sorted({index[f] for w in found for f in features(w) if f in index})

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            xs, others = [], ([], [])
            for text in batch.column(1).to_pylist():
                found = document_words(text)
                xs.append(on(found))
                for kind, to in zip(others, (swap, neutrals), strict=True):
                    now = on({to.get(w, w) for w in found}) if not to.keys().isdisjoint(found) else xs[-1]
                    kind.append(None if now == xs[-1] else now)
            kind = pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, kind) for v in (xs, *others))], names=["label", "x", "named", "usual"])

        return run

    got = map_arrow(rows, indexing, "label int, x array<int>, named array<int>, usual array<int>").toArrow()  # as many rows as the sample
    # rows arrive in any order; a fixed one makes the sums the same at every run
    known_rows = sorted(zip(*(got.column(c).to_pylist() for c in ("label", "x", "named", "usual")), strict=True), key=lambda r: (r[0], r[1], r[2] or [], r[3] or []))
    swapped = sum(a is not None or b is not None for _, _, a, b in known_rows)
    if pairing and not swapped:
        warnings.warn("no labelled text names a group, so the counterfactual term has no effect", stacklevel=2)
    y, xs, named, usually = map(list, zip(*known_rows, strict=True))
    bias, w = train_weights(y, xs, [named, usually], len(names), pairing, l2)
    return Model(bias, {f: float(v) for f, v in zip(names, w, strict=True) if v}, swap | neutrals, swapped)


def train_weights(y: list[int], xs: list[list[int]], others: list[list[list[int] | None]], n: int, pairing: float, l2: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Minimises mean log loss + l2 |w|^2 / 2 + pairing * mean squared logit change under swaps, by limited-memory BFGS.

    others: for each kind of swap the texts swapped, null where that changes nothing; each kind's mean counts once.
    """
    label = np.array(y, float)
    rows = np.repeat(np.arange(len(xs)), [len(x) for x in xs])
    cols = np.fromiter((i for x in xs for i in x), np.int64, len(rows))
    pairs = [(x, o, g) for g, one in enumerate(others) for x, o in zip(xs, one, strict=True) if o is not None]
    share_of = 1 / np.bincount([g for _, _, g in pairs], minlength=1).clip(1)
    part_of = share_of[[g for _, _, g in pairs]] if pairs else np.zeros(1)
    signed = [(k, i, s) for k, (x, o, _) in enumerate(pairs) for part, s in ((set(x) - set(o), 1.0), (set(o) - set(x), -1.0)) for i in part]
    prow = np.array([a for a, _, _ in signed], np.int64)
    pcol = np.array([b for _, b, _ in signed], np.int64)
    psign = np.array([c for _, _, c in signed], float)
    m, k = len(label), max(1, len(pairs))
    share = min(max(label.mean(), 1e-6), 1 - 1e-6)

    def loss_and_slope(v: np.ndarray) -> tuple[float, np.ndarray]:
        b, w = v[0], v[1:]
        z = b + np.bincount(rows, w[cols], minlength=m)
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        d = (p - label) / m
        g = np.bincount(cols, d[rows], minlength=n) + l2 * w
        loss = float(np.mean(np.logaddexp(0, z) - label * z) + l2 / 2 * w @ w)
        if len(psign):
            change = np.bincount(prow, psign * w[pcol], minlength=k)
            loss += pairing * float(part_of @ change**2)
            g += 2 * pairing * np.bincount(pcol, psign * (part_of * change)[prow], minlength=n)
        return loss, np.concatenate([[d.sum()], g])

    v = np.concatenate([[np.log(share / (1 - share))], np.zeros(n)])
    loss, g = loss_and_slope(v)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, undo = g.copy(), []
        for s, t in reversed(past):
            a = (s @ q) / (s @ t)
            q -= a * t
            undo.append(a)
        if past:
            s, t = past[-1]
            q *= (s @ t) / (t @ t)
        for (s, t), a in zip(past, reversed(undo), strict=True):
            q += s * (a - (t @ q) / (s @ t))
        slope, length = g @ q, 1.0
        while length > 1e-8:
            following, g2 = loss_and_slope(v - length * q)
            if following <= loss - 1e-4 * length * slope:
                break
            length /= 2
        else:
            break
        s, t = -length * q, g2 - g
        if s @ t > 1e-14:
            past = [*past[-9:], (s, t)]
        v, gain, loss, g = v + s, loss - following, following, g2
        if gain < 1e-8:
            break
    return float(v[0]), v[1:]


def toxicity_scores(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score (0 to 1) and predicted (1 if score >= threshold).

    Null texts are empty; empty texts have the score of a text without any feature. Repeated rows each give a
    row, further columns are ignored, an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        score = model.scorer()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            s = [score(t) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array([int(v >= threshold) for v in s], pa.int32())], names=["doc_id", "score", "predicted"])

        return run

    return map_arrow(texts(docs, id_col, text_col), make, f"doc_id {kind}, score double, predicted int").withColumnRenamed("doc_id", id_col)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are whatever their names, whose texts aren't predicted toxic.

    Null texts are empty, repeated rows are judged alike, rows with a null id too; an empty table gives an empty result.
    """
    at = docs.columns.index(text_col)

    def make():
        score = model.scorer()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([score((t or b"").decode("utf-8", "replace")) < threshold for t in as_bytes(batch.column(at))], pa.bool_()))

        return run

    return filter_arrow(docs, make)
