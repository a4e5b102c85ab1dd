"""Maximum inner product search by score-aware (anisotropic) product quantisation.

Each vector is coded in 4 bits for every two dimensions. For large inner products the part of the residual that is
parallel to the vector matters most, so codes and codebooks minimise |r|^2 + (eta - 1) <r, x/|x|>^2, where eta follows
from the dimension and a score threshold. As the parallel error couples the subspaces, codes are found by coordinate descent
and codebooks by weighted least squares. A search adds up a query's table entries, two codes at a time, over a block of codes;
the best of each block, and all others whose estimate is within three standard errors of the k-th best, are scored again with the
original vectors in double precision.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careerlake.llm.common import Saved
from careerlake.llm.vectors import matrix, usable

CENTRES = 16
WIDTH = 2


class Quantiser:
    """Codebooks (subspaces x 16 x 2) fitted to a sample under the anisotropic loss."""

    def __init__(self, sample: np.ndarray, share: float = 0.2, rounds: int = 6, seed: int = 6):
        n, d = sample.shape
        self.d, self.subspaces = d, -(-d // WIDTH)
        self.eta = max(1.0, (d - 1) * share**2 / (1 - share**2))
        rng = np.random.default_rng(seed)
        parts = self.parts(sample)
        pick = rng.integers(0, n, (self.subspaces, CENTRES))
        self.books = parts[pick, np.arange(self.subspaces)[:, None]].copy()
        self.books += rng.normal(0, 1e-6 + 0.01 * sample.std(), self.books.shape)
        for k in range(rounds):
            codes = self.encode(sample, passes=2)
            if k + 1 < rounds:
                self.improve(sample, codes)

    def parts(self, x: np.ndarray) -> np.ndarray:
        """n x subspaces x 2; an odd last dimension is followed by 0."""
        return np.pad(x, ((0, 0), (0, self.subspaces * WIDTH - self.d))).reshape(len(x), self.subspaces, WIDTH)

    def encode(self, x: np.ndarray, passes: int = 3) -> np.ndarray:
        """A code (0 to 15) for each vector and subspace, by coordinate descent from the nearest centres."""
        parts, n = self.parts(x), len(x)
        unit = parts / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None, None]
        codes = np.zeros((n, self.subspaces), np.uint8)
        parallel = np.zeros((n, self.subspaces))
        for p in range(passes + 1):
            for s in range(self.subspaces):
                r = parts[:, s, None, :] - self.books[s][None]
                along = np.einsum("nkw,nw->nk", r, unit[:, s])
                cost = np.einsum("nkw,nkw->nk", r, r)
                if p:
                    rest = parallel.sum(axis=1) - parallel[:, s]
                    cost = cost + (self.eta - 1) * (rest[:, None] + along) ** 2
                codes[:, s] = best = np.argmin(cost, axis=1)
                parallel[:, s] = along[np.arange(n), best]
        return codes

    def improve(self, x: np.ndarray, codes: np.ndarray) -> None:
        parts = self.parts(x)
        unit = parts / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None, None]
        chosen = self.books[np.arange(self.subspaces)[None], codes]
        parallel = np.einsum("nsw,nsw->ns", parts - chosen, unit)
        for s in range(self.subspaces):
            rest = parallel.sum(axis=1) - parallel[:, s]
            u, v = unit[:, s], parts[:, s]
            left = np.eye(WIDTH)[None] + (self.eta - 1) * u[:, :, None] * u[:, None, :]
            right = v + (self.eta - 1) * (rest + np.einsum("nw,nw->n", v, u))[:, None] * u
            for c in range(CENTRES):
                of = codes[:, s] == c
                if of.any():
                    self.books[s, c] = np.linalg.solve(left[of].sum(axis=0), right[of].sum(axis=0))

    def pack(self, codes: np.ndarray) -> np.ndarray:
        """Two codes to a byte."""
        codes = np.pad(codes, ((0, 0), (0, codes.shape[1] % 2)))
        return codes[:, 0::2] | codes[:, 1::2] << 4

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """queries x bytes x 256: what each byte of a packed code adds to the score."""
        one = np.einsum("qsw,skw->qsk", self.parts(queries), self.books)
        one = np.pad(one, ((0, 0), (0, one.shape[1] % 2), (0, 0)))
        return (one[:, 1::2, :, None] + one[:, 0::2, None, :]).reshape(len(queries), -1, CENTRES * CENTRES).astype(np.float32)


def inner(q: np.ndarray, x: np.ndarray, row: np.ndarray, col: np.ndarray, at_once: int = 100_000) -> np.ndarray:
    """q[row] . x[col] for each pair, in bounded memory."""
    parts = [np.einsum("nd,nd->n", q[row[i : i + at_once]], x[col[i : i + at_once]]) for i in range(0, len(row), at_once)]
    return np.concatenate(parts) if parts else np.zeros(0)


def search_block(quantiser: Quantiser, q_rows: np.ndarray, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, x: np.ndarray, packed: np.ndarray, k: int, rerank: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query rows, ids and exact scores of each query's k best in a block whose rows are in order of id; rows tell rows of one id apart."""
    columns = np.ascontiguousarray(packed.T)
    out = []
    for at in range(0, len(q), 128):
        qs, own = q[at : at + 128], q_rows[at : at + 128]
        tables = quantiser.tables(qs)
        score = np.zeros((len(qs), len(x)), np.float32)
        for b, codes in enumerate(columns):
            score += np.take(tables[:, b], codes, axis=1)
        score[own[:, None] == rows[None]] = -np.inf
        if rerank < len(x):
            least = -np.partition(-score, rerank - 1, axis=1)[:, rerank - 1]
            above = score > least[:, None]
            level = score == least[:, None]
            room = rerank - above.sum(axis=1)
            take = above | level & (np.cumsum(level, axis=1) <= room[:, None])  # ties: smaller ids first
        else:
            take = np.ones_like(score, bool)
        take &= score > -np.inf
        row, col = np.nonzero(take)
        exact = inner(qs, x, row, col)
        # further rows that the codes can't tell from the k-th best: within 3 standard errors of the scan below its exact score
        off = exact - score[row, col]
        n = np.maximum(np.bincount(row, minlength=len(qs)), 1)
        mean = np.bincount(row, off, minlength=len(qs)) / n
        spread = np.sqrt(np.maximum(np.bincount(row, off**2, minlength=len(qs)) / n - mean**2, 0))
        order = np.lexsort((-exact, row))
        first = np.searchsorted(row, np.arange(len(qs)))
        worst = np.full(len(qs), -np.inf)
        full = n >= k
        worst[full] = exact[order][first[full] + k - 1]
        more = (score >= (worst - mean - 3 * spread - 1e-5)[:, None]) & ~take & (score > -np.inf)
        more_row, more_col = np.nonzero(more)
        row, col, exact = np.append(row, more_row), np.append(col, more_col), np.append(exact, inner(qs, x, more_row, more_col))
        order = np.lexsort((ids[col], -exact, row))
        row, col, exact = row[order], col[order], exact[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        best = rank < k
        out.append((own[row[best]], ids[col[best]], exact[best]))
    return tuple(np.concatenate(p) for p in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)


def nearest(df: DataFrame, is_query, k: int = 20, rerank: int = 160, sample: int = 16_384, block: int = 32_768, queries: int = 16_384, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row for which is_query (a condition) holds: query_id, rank (from 1), id and score of its k nearest others.

    Nearness is the inner product of the original vectors in double precision; ties go to the smaller id; fewer than k
    others give all of them. Others are all rows but the query's own: rows that repeat an id are candidates and queries of their own, each
    query row with its own ranks. Vectors are compared with those of their length. Vectors that are null, zero, hold null or non-finite
    components, and rows with a null id take no part. Further columns are ignored; an empty table gives an empty result.

    The codebooks are fitted to about `sample` rows, drawn by the id's hash; every row is coded and searched. Queries and
    candidates meet in blocks of about `queries` and `block` rows at most, and smaller ones while that gives fewer groups than would keep a
    small cluster busy; `rerank` of each block are scored exactly. A candidate is sent out once for each block of queries.
    """
    kind = "array<float>" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")).filter(usable("v") & F.col("id").isNotNull())
    found = []
    for size in rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("long")).alias("q")).filter("q > 0 and n > 1").orderBy("d").collect():
        found.append(_nearest(rows.filter(F.size("v") == size["d"]), kind, size["n"], size["q"], k, rerank, sample, block, queries))
    none = rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    return reduce(DataFrame.unionAll, found or [none]).withColumnRenamed("vec_id", id_col)


def _nearest(rows: DataFrame, kind: str, n: int, q: int, k: int, rerank: int, sample: int, block: int, queries: int) -> DataFrame:
    chance = min(1.0, sample / n)
    drawn = rows.filter(F.pmod(F.xxhash64("id", F.lit("codebook")), F.lit(1 << 20)) < int(chance * (1 << 20))).select("id", "v").toArrow()
    drawn = drawn.sort_by("id") if drawn.num_rows else rows.select("id", "v").limit(1).toArrow()
    quantiser = Quantiser(matrix(drawn.column(1).combine_chunks()))

    def coding(batches):
        for b in batches:
            if b.num_rows:
                packed = quantiser.pack(quantiser.encode(matrix(b.column(1))))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in packed], pa.binary())], names=["id", "v", "asks", "code"])

    coded = rows.mapInArrow(coding, f"id long, v {kind}, asks boolean, code binary").withColumn("row", F.monotonically_increasing_id())
    coded = Saved(coded, "codes").df
    c_blocks = max(-(-n // block), min(24, -(-n // 1024)))
    q_blocks = -(-q // queries)
    place = lambda n: F.pmod(F.xxhash64("row", F.lit("block")), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = coded.select(place(c_blocks).alias("c"), every(q_blocks).alias("q"), F.lit(False).alias("asks"), "id", "row", "v", "code")
    asking = coded.filter("asks").select(every(c_blocks).alias("c"), place(q_blocks).alias("q"), "asks", "id", "row", "v", F.lit(None).cast("binary").alias("code"))

    def search(t: pa.Table) -> pa.Table:
        asks = t.column("asks").to_numpy()
        t_q, t_c = t.filter(pa.array(asks)), t.filter(pa.array(~asks)).sort_by([("id", "ascending"), ("row", "ascending")])
        vectors = lambda x: matrix(x.column("v").combine_chunks())
        if not t_q.num_rows or not t_c.num_rows:
            found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        else:
            packed = np.frombuffer(b"".join(t_c.column("code").to_pylist()), np.uint8).reshape(t_c.num_rows, -1)
            found = search_block(quantiser, t_q.column("row").to_numpy(), vectors(t_q), t_c.column("id").to_numpy(), t_c.column("row").to_numpy(), vectors(t_c), packed, k, rerank)
        ids = dict(zip(t_q.column("row").to_pylist(), t_q.column("id").to_pylist(), strict=True))
        return pa.table({"asker": found[0], "query_id": [ids[r] for r in found[0].tolist()], "id": found[1], "score": found[2]}, pa.schema([("asker", pa.int64()), ("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())]))

    found = candidates.unionByName(asking).groupBy("c", "q").applyInArrow(search, "asker long, query_id long, id long, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), "id"))).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
