"""SimHash near-duplicates, found by meet-in-the-middle ball hashing.

A fingerprint is linked to all that differ from it in at most 3 bits. Two fingerprints that differ in 2 bits have
a variant in common among their one-bit variants: they meet in the middle. The third bit is absorbed by leaving out, in
turn, each of three blocks of bits: whatever the differing bits are, some block left out holds one of 3 of them (or
all 3), so that every fingerprint emits all variants within half of the remaining radius, for each block left out:
3 * 44 keys (one of them unused by the third block). Fingerprints that share a key are colliding pairs; those within 3 bits are linked.

Copies share a fingerprint and are collapsed before. A key's fingerprints are never paired all with all: in a large
bucket those with equal left-out bits are linked in a chain (they differ in 2 bits at most), the chains of left-out bits
that differ in one place are linked (3 bits at most), and what differs only in left-out bits is looked up by flipping
them. Links whose ends are joined already are dropped at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerlake.llm.common import Saved, as_bytes, map_arrow, texts
from careerlake.llm.components import Forest, components

RADIUS = 3
BLOCKS = ((0, 21), (21, 21), (42, 22))  # first bit and width of each block
ALL = (1 << 64) - 1
BLOCK_OF_WORDS = 65_536


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """64 bits: each set if it is set in over half of the hashes of the shingles, repeats included; 0 without words."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    ones, total = np.zeros(64, np.int64), max(1, n - width + 1)
    for at in range(0, total, BLOCK_OF_WORDS):
        part = words[at : min(at + BLOCK_OF_WORDS, total) + width - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(width)), strict=False)) if n >= width else [b" ".join(part)]
        raw = np.frombuffer(b"".join([xxhash.xxh64_digest(s, seed) for s in shingles]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row's whole text as a signed 64-bit number; null texts are empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            f = np.array([fingerprint(t, width) for t in as_bytes(batch.column(1))], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(f)], names=["doc_id", "fp"])

        return run

    return map_arrow(texts(docs, id_col, text_col), make, f"doc_id {kind}, fp long")


def variants(fps: DataFrame) -> DataFrame:
    """(key, fp): for each block left out, the remaining bits (packed, the block's number above) and all one-bit variants."""
    fp, keep = F.col("fp"), []
    for k, (at, size) in enumerate(BLOCKS):
        low = fp.bitwiseAND(F.lit((1 << at) - 1))
        above = at + size
        high = F.shiftleft(F.shiftrightunsigned(fp, above), at) if above < 64 else F.lit(0).cast("long")
        keep.append(low.bitwiseOR(high).bitwiseOR(F.lit(k << 44)))
    flips = F.array(*[F.lit(0).cast("long"), *(F.lit(1 << b).cast("long") for b in range(43))])
    based = fps.select("fp", F.explode(F.array(*keep)).alias("base"))
    each = based.select("fp", "base", F.explode(flips).alias("flip"))
    return each.select(F.col("base").bitwiseXOR(F.col("flip")).alias("key"), "fp")


def _masked(fps: np.ndarray, key: int) -> tuple[np.ndarray, np.ndarray]:
    """The left-out bits of each fingerprint, and whether its other bits are those of the key itself."""
    at, size = BLOCKS[key >> 44]
    u = fps.view(np.uint64)
    out = (u >> np.uint64(at)) & np.uint64((1 << size) - 1)
    low = u & np.uint64((1 << at) - 1)
    high = (u >> np.uint64(at + size)) << np.uint64(at) if at + size < 64 else np.zeros_like(u)
    return out.astype(np.int64), (low | high) == np.uint64(key & ((1 << 44) - 1))


def bucket_links(fps: np.ndarray, key: int) -> list[tuple[int, int]]:
    """A spanning forest of the links that a large bucket stands for; see the module's text."""
    out, exact = _masked(fps, key)
    size = BLOCKS[key >> 44][1]
    order = np.argsort(out, kind="stable")
    fps, out, exact = fps[order], out[order], exact[order]
    forest, links = Forest(), []

    def link(a: np.ndarray, b: np.ndarray) -> None:
        links.extend(p for p in zip(a.tolist(), b.tolist(), strict=True) if forest.join(*p))

    same = out[1:] == out[:-1]
    link(fps[:-1][same], fps[1:][same])

    def flip(m: np.ndarray, f: np.ndarray, sizes: tuple[int, ...]) -> None:
        if not len(m):
            return
        first = np.concatenate([[True], m[1:] != m[:-1]])
        m, f = m[first], f[first]
        for k in sizes:
            for bits in combinations(range(size), k):
                want = m ^ sum(1 << b for b in bits)
                at = np.minimum(np.searchsorted(m, want), len(m) - 1)
                hit = (m[at] == want) & (m < want)
                if hit.any():
                    link(f[hit], f[at[hit]])

    flip(out, fps, (1,))
    flip(out[exact], fps[exact], (2, 3))
    return links


def run_links(keys: np.ndarray, fps: np.ndarray, small: int = 8, middle: int = 64) -> np.ndarray:
    """Links (n x 2) of rows sorted by key, whole buckets only."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    found = []
    few = np.repeat((sizes > 1) & (sizes <= small), sizes)
    k, f = keys[few], fps[few]
    for d in range(1, small):
        if len(k) <= d:
            break
        a, b = f[:-d], f[d:]
        near = (k[:-d] == k[d:]) & (np.bitwise_count((a ^ b).view(np.uint64)) <= RADIUS) & (a != b)
        found.append(np.stack([a[near], b[near]], axis=1))
    for at, n in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist(), strict=True):
        f = fps[at : at + n]
        if n <= middle:
            i, j = np.nonzero(np.triu(np.bitwise_count((f[:, None] ^ f[None, :]).view(np.uint64)) <= RADIUS, 1))
            forest = Forest()
            links = [p for p in zip(f[i].tolist(), f[j].tolist(), strict=True) if forest.join(*p)]
        else:
            links = bucket_links(f, int(keys[at]))
        if links:
            found.append(np.array(links, np.int64))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return np.unique(np.sort(pairs, axis=1), axis=0) if len(pairs) else pairs


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links between different fingerprints (column fp, distinct) whose closure is that of all links within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []  # of a bucket that may go on, and of whole ones before it

        def out(keys: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            pairs = run_links(keys, f)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["a", "b"])

        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            kept.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
            size += b.num_rows
            if size < 200_000 or kept[0][0][0] == kept[-1][0][-1]:
                continue
            keys, f = (np.concatenate([x[i] for x in kept]) for i in (0, 1))
            cut = int(np.searchsorted(keys, keys[-1]))
            yield out(keys[:cut], f[:cut])
            kept, size = [(keys[cut:], f[cut:])], len(keys) - cut
        if kept:
            yield out(*(np.concatenate([x[i] for x in kept]) for i in (0, 1)))

    spread = variants(fps).repartition("key").sortWithinPartitions("key")
    return spread.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits) and component_id, the smallest id that links lead to, its own included.

    Null and empty texts have fingerprint 0 and are linked like any other. Copies are in one component by their common
    fingerprint. Rows with a null id have their component's smallest id, null if it has none. Repeated rows each
    give a row; further columns are ignored; an empty table gives an empty result. No links, components or fingerprints
    come to the driver.
    """
    rows = Saved(fingerprints(docs, id_col, text_col, width), "fingerprints").df
    classes = Saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes").df
    roots = components(links(classes.select("fp")))
    rooted = Saved(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted").df
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    known = Saved(rooted.join(least, "root").select("fp", "component_id"), "components").df
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(known, "fp").select(F.col("doc_id").alias(id_col), hexed, "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, that stand for their component: the one with its smallest id.

    Of rows that repeat that id one stays. Rows with a null id can't be told apart by it and all stay.
    """
    marked = near_duplicates(docs, id_col, text_col)
    first = Saved(marked.filter(F.col(id_col) == F.col("component_id")).groupBy(F.col(id_col).alias("_first")).agg(F.count("*").alias("_rows")), "first").df
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    at = F.col("_row")[id_col]
    # dealt by id at every size, the ids hashed in each task: the wide rows are neither sorted nor is the list of ids sent out
    stay = packed.join(first.hint("shuffle_hash"), at == F.col("_first"))
    if first.filter("_rows > 1").limit(1).count():
        again = stay.filter("_rows > 1").groupBy("_first").agg(F.first("_row").alias("_row")).select("_row")
        stay = stay.filter("_rows = 1").select("_row").unionByName(again)
    return stay.select("_row").unionByName(packed.filter(at.isNull())).select("_row.*")
