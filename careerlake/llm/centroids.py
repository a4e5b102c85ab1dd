"""Centroid clustering with Yinyang bounds, in whole numbers.

Components become floor(scale * x), centroids are the exact floor of their vectors' mean, and a vector belongs to the centroid of the
smallest squared distance, the smaller number of equal ones: the same rows give the same clusters on any cluster.

The centroids are put into groups once, by where they start. Each vector keeps an upper bound of the distance to its centroid and, for each
group, a lower bound of the distance to the group's other centroids. When centroids have moved, bounds give way by as much. A vector whose upper
bound is below all of its lower bounds stays where it is, without a distance being computed; else its own distance is, and then only groups whose
bound it doesn't stay below are scanned, exactly. Bounds are kept a little loose, so that rounding never hides a tie.

Each round is one job: tasks read the vectors with their bounds, write them with the new ones, and write besides, for each centroid,
the count and sums of its vectors. Of those, added up by Spark, the driver sees k rows of sums; nothing else leaves the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerlake.llm.common import Saved
from careerlake.llm.vectors import countable, exact, integers

LOOSE = 1e-11
#: Vectors of a centroid in a group of its own: so many centroids share a bound.
GROUP = 10


def squares(x: np.ndarray) -> np.ndarray:
    """Squared lengths of rows of integers, exactly."""
    return np.einsum("ij,ij->i", x, x) if np.abs(x).max(initial=0) < 1 << 20 else (x.astype(np.int64) ** 2).sum(axis=1)


def apart(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x and c, exactly."""
    a, b, p = squares(x), squares(c), exact(x, c)
    if a.dtype != float or b.dtype != float:  # doubles don't hold all of these
        a, b, p = (y.astype(np.int64) for y in (a, b, p))
    return a[:, None] - 2 * p + b[None]


def own_apart(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x to the same rows of c."""
    return squares(x - c)


def grouped(centres: np.ndarray, rounds: int = 5) -> np.ndarray:
    """The group of each centroid: a few rounds of clustering of the centroids themselves, the first of each ten being where groups start."""
    n = max(1, len(centres) // GROUP)
    heads = centres[:: max(1, len(centres) // n)][:n].astype(float)
    for _ in range(rounds):
        of = np.argmin(((centres[:, None] - heads[None]) ** 2).sum(axis=2), axis=1)
        heads = np.stack([centres[of == g].mean(axis=0) if (of == g).any() else heads[g] for g in range(n)])
    return np.unique(of, return_inverse=True)[1]


class Yinyang:
    """One round: the centroids, their groups, and how far each has moved since the bounds were taken."""

    def __init__(self, centres: np.ndarray, group: np.ndarray, moved: np.ndarray):
        self.centres, self.group = centres, group
        self.members = [np.flatnonzero(group == g) for g in range(group.max() + 1)]
        self.moved = moved * (1 + LOOSE)
        self.most = np.array([self.moved[m].max() for m in self.members])
        self.scanned = 0  # distances computed, for tests

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cluster, upper bound and lower bounds of vectors that have none."""
        d = apart(x, self.centres)
        self.scanned += d.size
        cluster = np.argmin(d, axis=1)
        rows = np.arange(len(x))
        upper = np.sqrt(d[rows, cluster].astype(float)) * (1 + LOOSE)
        far = np.sqrt(d.astype(float))
        far[rows, cluster] = np.inf
        return cluster, upper, np.stack([far[:, m].min(axis=1) for m in self.members], axis=1) * (1 - LOOSE)

    def again(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for vectors with the cluster and bounds of the round before."""
        cluster = cluster.copy()
        upper = (upper + self.moved[cluster]) * (1 + LOOSE)
        lower = np.maximum(0.0, (lower - self.most) * (1 - LOOSE))
        open_ = np.flatnonzero(upper >= lower.min(axis=1))  # the global filter
        near = own_apart(x[open_], self.centres[cluster[open_]])
        self.scanned += len(open_)
        upper[open_] = np.sqrt(near.astype(float)) * (1 + LOOSE)
        still = upper[open_] >= lower[open_].min(axis=1)
        open_, near = open_[still], near[still]
        for g, members in enumerate(self.members):  # the group filter
            at = np.flatnonzero(upper[open_] >= lower[open_, g])
            if not len(at):
                continue
            rows = open_[at]
            d = apart(x[rows], self.centres[members])
            self.scanned += d.size
            here = members[None] == cluster[rows][:, None]
            found = np.where(here, np.inf, d.astype(float)) if d.dtype == float else np.where(here, np.iinfo(np.int64).max, d)
            best = np.argmin(found, axis=1)
            least = found[np.arange(len(rows)), best]
            lower[rows, g] = np.sqrt(least.astype(float)) * (1 - LOOSE)
            won = (least < near[at]) | (least == near[at]) & (members[best] < cluster[rows])
            if not won.any():
                continue
            changed, left = rows[won], self.group[cluster[rows[won]]]
            # the centroid that is left counts for its group's bound, and the next best of this group for its own
            second = found[won].copy()
            second[np.arange(len(changed)), best[won]] = np.inf if d.dtype == float else np.iinfo(np.int64).max
            lower[changed, g] = np.sqrt(second.min(axis=1).astype(float)) * (1 - LOOSE)
            lower[changed, left] = np.minimum(lower[changed, left], np.sqrt(near[at][won].astype(float)) * (1 - LOOSE))
            cluster[changed] = members[best[won]]
            near[at[won]] = least[won]
            upper[changed] = np.sqrt(least[won].astype(float)) * (1 + LOOSE)
        return cluster, upper, lower


def _texts(x: np.ndarray) -> list[str]:
    return [",".join(str(int(v)) for v in row) for row in x]


def clusters(df: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: float = 256, salt: str = "2", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector that takes part: id, cluster, distance (squared), cluster_inertia and inertia (distance summed over its cluster and over all), centroid_sha256.

    Vectors of dim components, none null or non-finite, take part, zero vectors included; so large ones that squared distances may not fit a long don't (see countable). Centroids start as
    the k vectors of smallest sha256 of `salt:id`, in that order (a null id counts as the empty text, ties by the vector); fewer vectors make
    fewer. Rows that repeat an id are vectors of their own. Each of the rounds assigns all vectors and then moves each centroid to the floor of its vectors' mean, an empty one staying;
    vectors are assigned once more at the end. If nothing moves, later rounds, which would change nothing, are left out.
    centroid_sha256 is of the centroid's integers, joined by commas. Further columns are ignored; an empty table gives an empty result.
    """
    kind = "float" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("v")).filter(countable("v", scale) & (F.size("v") == dim))
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    seeds = rows.orderBy(digest, "v").limit(k).toArrow()
    names = [id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    if not seeds.num_rows:
        none = rows.select("id", F.lit(0).alias("c"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit("")).limit(0)
        return none.toDF(*names)
    centres = integers(seeds.column("v").combine_chunks(), scale)
    group, moved = grouped(centres), np.zeros(len(centres))
    before, now = None, rows.withColumns({"cluster": F.lit(-1), "upper": F.lit(0.0), "lower": F.array().cast("array<double>")})
    for _ in range(rounds):
        after = _round(now, kind, scale, Yinyang(centres, group, moved), before is None)
        new = _moved(after.df, centres)
        if before is not None:
            before.drop()
        before, now = after, after.df.filter("part = 'rows'").drop("part", "n", "sums")
        moved = np.sqrt(own_apart(new, centres).astype(float))
        centres = new
        if not moved.any():
            break
    final = _round(now, kind, scale, Yinyang(centres, group, moved), before is None, last=True)
    if before is not None:
        before.drop()
    totals = final.df.filter("part = 'sums'").groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # a row for each centroid
    known = {r["cluster"]: r["cluster_inertia"] for r in totals}
    whole = sum(known.values())
    about = [(c, known.get(c, 0), whole, hashlib.sha256(t.encode()).hexdigest()) for c, t in enumerate(_texts(centres))]
    table = df.sparkSession.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return final.df.filter("part = 'rows'").join(F.broadcast(table), "cluster").select(F.col("id").alias(id_col), *names[1:])  # k rows


def _round(now: DataFrame, kind: str, scale: float, model: Yinyang, first: bool, last: bool = False) -> Saved:
    """The vectors with their clusters and bounds (the last time: distances), and the parts of the new centroids' sums."""
    k, d = model.centres.shape
    names = ["id", "v", "cluster", "upper", "lower", "distance", "n", "sums", "part"]
    types = [pa.int64(), pa.list_(pa.float32() if kind == "float" else pa.float64()), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string()]

    def batch(columns: dict, part: str, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part] * n) if c == "part" else columns[c].cast(t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, far = np.zeros(k, np.int64), np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = integers(b.column(1), scale)
            if first:
                cluster, upper, lower = model.first(x)
            else:
                bounds = b.column(4).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                cluster, upper, lower = model.again(x, b.column(2).to_numpy(), b.column(3).to_numpy(), bounds)
            out = {"id": b.column(0), "cluster": pa.array(cluster)}
            if last:
                near = own_apart(x, model.centres[cluster]).astype(np.int64)
                np.add.at(far, cluster, near)
                out["distance"] = pa.array(near)
            else:
                order = np.argsort(cluster, kind="stable")
                starts = np.flatnonzero(np.diff(cluster[order], prepend=-1))
                total[cluster[order][starts]] += np.add.reduceat(x[order].astype(np.int64), starts, axis=0)
                width = lower.shape[1]
                out |= {"v": b.column(1), "upper": pa.array(upper), "lower": pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * width + 1, width, dtype=np.int32)), pa.array(lower.ravel()))}
            count += np.bincount(cluster, minlength=k)
            yield batch(out, "rows", len(x))
        some = np.flatnonzero(count)
        if len(some):
            sums = {} if last else {"sums": pa.array(total[some].tolist(), types[7])}
            yield batch({"cluster": pa.array(some), "n": pa.array(count[some]), "distance": pa.array(far[some]), **sums}, "sums", len(some))

    schema = f"id long, v array<{kind}>, cluster int, upper double, lower array<double>, distance long, n long, sums array<long>, part string"
    return Saved(now.select("id", "v", "cluster", "upper", "lower").mapInArrow(run, schema), "yinyang")


def _moved(state: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The centroids at the floor of their vectors' means: k x dim sums, added up by Spark."""
    parts = state.filter("part = 'sums'").select("cluster", "n", F.posexplode("sums").alias("i", "x"))
    new = centres.copy()
    for r in parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect():
        new[r["cluster"], r["i"]] = r["x"] // r["n"]
    return new


def oracle_sql(k: int = 40, rounds: int = 5) -> str:
    """The query's result by plain SQL: every vector against every centroid in every round."""
    steps = [
        """kept as materialized (select row_number() over () as n, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
          where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0)""",
        f"c0 as materialized (select row_number() over (order by h, v) - 1 as c, v from (select sha256('2:' || vec_id) as h, v from kept order by h, v limit {k}))",
    ]
    for r in range(rounds + 1):
        away = "list_sum(list_transform(list_zip(kept.v, o.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        steps.append(f"a{r} as materialized (select n, min(struct_pack(d := cast(d as bigint), c := c)) as best from (select n, o.c, {away} as d from kept, c{r} o) group by n)")
        if r < rounds:
            steps.append(f"""c{r + 1} as materialized (select o.c, coalesce(m.v, o.v) as v from c{r} o left join (select c, list(f order by i) as v from (
              select c, i, cast((s - ((s % t) + t) % t) // t as bigint) as f from (select c, i, sum(x) as s, count(*) as t from (select best.c as c, unnest(v) as x, generate_subscripts(v, 1) as i from a{r} join kept using (n)) group by c, i)) group by c) m using (c))""")
    return f"""with {", ".join(steps)} select vec_id, cast(best.c as int) as cluster, best.d as distance, cast(sum(best.d) over (partition by best.c) as bigint) as cluster_inertia,
      cast(sum(best.d) over () as bigint) as inertia, sha256(array_to_string(o.v, ',')) as centroid_sha256 from a{rounds} join kept using (n) join c{rounds} o on o.c = best.c"""
