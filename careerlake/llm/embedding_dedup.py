"""Near-duplicate vectors by randomised-rotation binary codes with stored correction factors.

A unit vector o is turned by a random rotation and only the signs are kept, as o' = signs / sqrt(d). With the stored factor
<o', o>, the estimate <o', q> / <o', o> of <o, q> is unbiased for any q, and its error is within
e * sqrt((1 - f^2) / f^2 / (d - 1)), f the factor, but for a chance that falls as exp(-c e^2). q is turned likewise and
rounded to 4 bits, at thresholds drawn once, so that the estimate is four population counts and the same on every run. Each vector is coded
once; codes with their factors are what is dealt out to the hash tables. Vectors without a pair whose upper bound reaches the threshold
are done with; only the others' vectors are sent to their buckets, for exact cosines in double precision.

Which pairs meet: bits of further rotations make the keys of several hash tables. Keys have about as many bits as it takes to
give each vector of the largest label a key of its own, and there are so many tables that a pair at the threshold meets
with probability 1 - miss; both follow from the row count. A pair is handled in the first table where it meets only. Copies
are collapsed to one class before. Buckets above a size are dealt out as pairs of blocks, so no task holds one whole; a task
gives each class the number of vectors linked to it and a spanning forest of the links, never the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerlake.llm.common import Saved
from careerlake.llm.components import Forest, components
from careerlake.llm.vectors import matrix, rotations, usable

SEED = 9
BLOCK = 1024
BROADCAST_ROWS = 50_000


def _words(d: int) -> int:
    return -(-d // 64)


class Codes:
    """Binary codes, correction factors and 4-bit roundings of vectors of one length; pack gives each as bytes, of which unpack makes them again."""

    def __init__(self, x: np.ndarray, seed: int = SEED):
        n, d = x.shape
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        z = unit @ rotations(d, d, seed)[:d].T
        pad = _words(d) * 64 - d
        pack = lambda bits: np.ascontiguousarray(np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1)).view(np.uint64)
        factor = np.abs(z).sum(axis=1) / math.sqrt(d)
        low, high = z.min(axis=1), z.max(axis=1)
        self.factors = np.stack([factor, low, np.maximum((high - low) / 15, 1e-12)], axis=1).astype(np.float32)
        _, low, width = self.factors.T.astype(float)
        q = np.clip(np.floor((z - low[:, None]) / width[:, None] + np.random.default_rng(seed).random(d)), 0, 15).astype(np.uint8)
        self.bits = np.stack([pack(z > 0), *(pack(((q >> b) & 1).astype(bool)) for b in range(4))], axis=1)
        self.ready(d)

    def ready(self, d: int) -> None:
        self.d = d
        self.factor, self.low, self.width = self.factors.T.astype(float)
        self.error = np.sqrt(np.maximum(0.0, 1 - self.factor**2) / self.factor**2 / max(1, d - 1))
        self.code, *self.planes = (self.bits[:, i] for i in range(5))
        self.ones = np.bitwise_count(self.code).sum(axis=1, dtype=np.int64)
        self.total = sum((1 << b) * np.bitwise_count(p).sum(axis=1, dtype=np.int64) for b, p in enumerate(self.planes))

    def pack(self) -> list[bytes]:
        return [b.tobytes() + f.tobytes() for b, f in zip(self.bits, self.factors, strict=True)]

    @classmethod
    def unpack(cls, raw: list[bytes], d: int) -> Codes:
        self = cls.__new__(cls)
        each = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)
        at = 5 * 8 * _words(d)
        self.bits = np.ascontiguousarray(each[:, :at]).view(np.uint64).reshape(len(raw), 5, _words(d))
        self.factors = np.ascontiguousarray(each[:, at:]).view(np.float32)
        self.ready(d)
        return self

    def estimate(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """<i, j> from i's signs and j's rounding: sum of sign * (low + width * q) over the dimensions, corrected."""
        c = self.code[i]
        on = sum((1 << b) * np.bitwise_count(c & p[j]).sum(axis=-1, dtype=np.int64) for b, p in enumerate(self.planes))
        signed = self.low[j] * (2 * self.ones[i] - self.d) + self.width[j] * (2 * on - self.total[j])
        return signed / math.sqrt(self.d) / self.factor[i]

    def bound(self, i: np.ndarray, j: np.ndarray, e: float) -> np.ndarray:
        """How much the true value may be above the estimate; the rounding's share is within one width's random walk."""
        return e * (self.error[i] + 0.5 * self.width[j] / self.factor[i])


#: What goes with a class to each of its places: run, table, label, keys of all tables, class, its vectors, blocks of the bucket, pair and own block.
PLACE = "g long, t int, label long, keys array<int>, c long, n long, blocks int, pair int, block int"
PLACES = [x.split()[0] for x in PLACE.split(", ")]


def _pairs(t: pa.Table, small: int = 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of t, which has whole runs in order, that meet in this run: of different classes, not met in an earlier table."""
    group, table, label, ids, blocks, pair, block = (t.column(c).to_numpy() for c in ("g", "t", "label", "c", "blocks", "pair", "block"))
    n = t.num_rows
    if not n:
        return
    keys = t.column("keys").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    lengths = t.column("d").to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, n))

    def met(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = (label[i] == label[j]) & (table[i] == table[j]) & (ids[i] != ids[j]) & (lengths[i] == lengths[j])
        own &= (blocks[i] == 1) | (pair[i] == np.minimum(block[i], block[j]) * blocks[i] + np.maximum(block[i], block[j]))
        i, j = i[own], j[own]
        first = np.argmax(keys[i] == keys[j], axis=1) == table[i]
        return i[first], j[first]

    few = np.flatnonzero(np.repeat(sizes <= small, sizes))
    for k in range(1, small):
        if len(few) <= k:
            break
        i, j = few[:-k], few[k:]
        same = group[i] == group[j]
        yield met(i[same], j[same])
    for at, m in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist(), strict=True):
        for row in range(0, m, 64):
            i, j = np.meshgrid(np.arange(row, min(m, row + 64)), np.arange(row + 1, m), indexing="ij")
            later = j > i
            yield met(at + i[later], at + j[later])


def _by_length(t: pa.Table, make) -> tuple[dict, np.ndarray]:
    """make of each length's rows, and each row's place among those of its length."""
    lengths, made, place = t.column("d").to_numpy(), {}, np.zeros(t.num_rows, np.int64)
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        made[d] = make(t.take(pa.array(rows)), d)
        place[rows] = np.arange(len(rows))
    return made, place


def _split(codes: dict, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[tuple]:
    for d, code in codes.items():
        here = lengths[i] == d
        if here.any():
            yield code, i[here], j[here]


def _close(t: pa.Table, threshold: float, e: float) -> pa.Table:
    """The rows that have a pair whose upper bound reaches the threshold, without their codes."""
    on = np.zeros(t.num_rows, bool)
    codes, place = _by_length(t, lambda rows, d: Codes.unpack(rows.column("code").to_pylist(), d))
    lengths = t.column("d").to_numpy()
    for i, j in _pairs(t):
        for code, a, b in _split(codes, lengths, i, j):
            x, y = place[a], place[b]
            maybe = code.estimate(x, y) + code.bound(x, y, e) >= threshold
            on[a[maybe]] = on[b[maybe]] = True
    return t.select(PLACES).filter(pa.array(on)).combine_chunks()


def _links(t: pa.Table, threshold: float) -> pa.Table:
    """By exact cosines: each class's links, and a spanning forest of them between the smallest ids."""

    def unit(rows: pa.Table, d: int) -> np.ndarray:
        x = matrix(rows.column("v").combine_chunks())
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    vectors, place = _by_length(t, unit)
    ids, size, lengths, node = (t.column(c).to_numpy() for c in ("c", "n", "d", "least"))
    degree, forest, edges = np.zeros(t.num_rows, np.int64), Forest(), []
    for i, j in _pairs(t):
        for x, a, b in _split(vectors, lengths, i, j):
            near = np.einsum("ij,ij->i", x[place[a]], x[place[b]]) >= threshold
            a, b = a[near], b[near]
            np.add.at(degree, a, size[b])
            np.add.at(degree, b, size[a])
            edges.extend(p for p in zip(node[a].tolist(), node[b].tolist(), strict=True) if forest.join(*p))
    some, k = np.flatnonzero(degree), len(edges)
    return pa.table(
        {
            "a": pa.concat_arrays([pa.array(ids[some], pa.int64()), pa.array([a for a, _ in edges], pa.int64())]),
            "b": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array([b for _, b in edges], pa.int64())]),
            "links": pa.concat_arrays([pa.array(degree[some], pa.int64()), pa.array([0] * k, pa.int64())]),
        }
    )


def _runs(work):
    """For mapInArrow over rows in order of g: work gets tables of whole runs, without runs of one row."""

    def shared(t: pa.Table) -> pa.Table:
        group = t.column("g").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = np.diff(np.append(starts, len(group)))
        return t.filter(pa.array(np.repeat(sizes > 1, sizes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            if not b.num_rows:
                continue
            kept.append(b)
            rows += b.num_rows
            last = b.column(0)[-1].as_py()
            if rows < 30_000 or kept[0].column(0)[0].as_py() == last:
                continue
            t = pa.Table.from_batches(kept)
            cut = int(np.searchsorted(t.column(0).to_numpy(), last))
            yield from work(shared(t.slice(0, cut))).to_batches()
            kept = t.slice(cut).combine_chunks().to_batches()
            rows -= cut
        if kept:
            yield from work(shared(pa.Table.from_batches(kept))).to_batches()

    return run


def near_duplicate_vectors(df: DataFrame, threshold: float = 0.98, miss: float = 1e-3, e: float = 3.5, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per row: id, n_links (vectors linked directly, itself not counted), component_id (smallest id reachable) and kept.

    Vectors are linked if their labels are equal and not null, their lengths are equal and their cosine, in double
    precision, reaches the threshold. Vectors that are null, zero or hold null or non-finite components, and rows with a
    null label or id, link with nothing: 0 links, a component of their own, kept. A row that repeats an id and a vector counts as a
    copy of it; rows of one id with different vectors have their own links, and are one node of the components. Further columns are ignored; an empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    takes_part = usable("v") & F.col("label").isNotNull() & F.col("id").isNotNull()
    classes = rows.filter(takes_part).groupBy("label", "v").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = Saved(classes.withColumn("c", F.monotonically_increasing_id()), "vector-classes").df  # ids may repeat, so classes have a number
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits = min(30, max(8, math.ceil(math.log2(most))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    tables = max(1, math.ceil(math.log(miss) / math.log1p(-meet)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn: dict[int, np.ndarray] = {}
        for b in batches:
            v = b.column(3)
            lengths = v.value_lengths().to_numpy()
            keys = np.zeros((b.num_rows, tables), np.int32)
            for d in np.unique(lengths):
                if d not in turn:
                    turn[d] = rotations(int(d), tables * bits, SEED + 1)[: tables * bits]
                at = np.flatnonzero(lengths == d)
                on = (matrix(v.take(pa.array(at))) @ turn[d].T > 0).reshape(len(at), tables, bits)
                keys[at] = on @ (1 << np.arange(bits, dtype=np.int32))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), tables).cast(pa.list_(pa.int32()))
            codes = np.empty(b.num_rows, object)
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                codes[at] = Codes(matrix(v.take(pa.array(at)))).pack()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(lengths, pa.int32()), pa.array(codes.tolist(), pa.binary()), flat], names=["c", "n", "label", "d", "code", "keys"])

    hashed = Saved(classes.select("c", "n", "label", "v").mapInArrow(keyed, "c long, n long, label long, d int, code binary, keys array<int>"), "vector-codes").df
    bucket = ["label", "t", "key"]
    large = Saved(hashed.select("label", F.posexplode("keys").alias("t", "key")).groupBy(*bucket).count().filter(F.col("count") > BLOCK).select(*bucket, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "large-buckets").df
    placed = hashed.select("c", "n", "label", "d", "code", "keys", F.posexplode("keys").alias("t", "key"))
    how_many = large.count()
    if how_many:
        placed = placed.join(F.broadcast(large) if how_many <= BROADCAST_ROWS else large, bucket, "left")
    else:
        placed = placed.withColumn("blocks", F.lit(1))
    placed = placed.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("c", F.lit("block")), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("pair", (F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).cast("int"))
    sorted_rows = dealt.select(F.xxhash64(*bucket, "pair").alias("g"), *PLACES[1:], "d", "code").repartition("g").sortWithinPartitions("g")
    close = Saved(sorted_rows.mapInArrow(_runs(lambda t: _close(t, threshold, e)), PLACE), "close-vectors").df
    kind = "array<float>" if _floats(df, vector_col) else "array<double>"
    vectors = close.join(classes.select("c", "least", F.size("v").alias("d"), F.col("v").cast(kind).alias("v")), "c")
    sorted_rows = vectors.select(*PLACES, "least", "d", "v").repartition("g").sortWithinPartitions("g")
    found = Saved(sorted_rows.mapInArrow(_runs(lambda t: _links(t, threshold)), "a long, b long, links long"), "vector-links").df
    roots = components(found.filter("b is not null").select("a", "b"))
    counts = found.filter("b is null").groupBy(F.col("a").alias("c")).agg(F.sum("links").alias("links"))
    known = classes.join(counts, "c", "left").join(roots.select(F.col("node").alias("least"), "root"), "least", "left")
    known = Saved(known.select("label", "v", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("root", "least").alias("root")), "vector-components").df
    joined = rows.filter(takes_part).join(known, ["label", "v"])
    alone = rows.filter(~F.coalesce(takes_part, F.lit(False))).select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("root"))
    whole = joined.select("id", "links", "root").unionByName(alone)
    return whole.select(F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("root").alias("component_id"), F.col("id").eqNullSafe(F.col("root")).alias("kept"))


def _floats(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.simpleString() == "array<float>"
