"""Hard negatives by a dual-tree search, in whole numbers.

Components become floor(scale * x), so scores are exact integers. Anchors and candidates each hang in trees: a node is a run of rows with the
least and largest label, a centre and a radius; it is halved by label until it holds one, then along the direction in which its rows
spread most. For two nodes the inner product of the centres, give or take the radii, is an interval that holds all of their rows'
scores. Anchors go down their tree in groups, each with the list of candidate nodes that may still matter to one of them: a candidate node
goes for the whole group if its labels can't be wanted, if its interval ends below what every anchor has already, or if it begins
above all that they may take. What is left when both are leaves is scored exactly, best intervals first, so that bounds rise early.

Two searches: the best of an anchor's own label are its positives; their scores bound a window for each, in which the best
of the other labels are looked for. Anchors and candidates are dealt to blocks by number, and each pair of blocks is a
task with its own two trees; hot labels are spread over all blocks. Each task returns a few rows by anchor, of which a window keeps the best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careerlake.llm.common import Saved
from careerlake.llm.vectors import countable, exact, integers

LEAF = 128
LOOSE = 1e-9


class Tree:
    """Rows in order of the tree; nodes with their run, label range, centre and radius. Children of i: left[i] and left[i] + 1, or none (0)."""

    def __init__(self, x: np.ndarray, label: np.ndarray, leaf: int = LEAF):
        self.order = np.lexsort((label,))
        starts, ends, left = [0], [len(x)], [0]
        i = 0
        while i < len(starts):
            s, e = starts[i], ends[i]
            rows = self.order[s:e]
            of = label[rows]
            if e - s > leaf:
                if of[0] != of[-1]:  # rows of a mixed node are in order of label
                    cut = int(np.searchsorted(of, of[len(of) // 2]))
                    cut = cut if cut else int(np.searchsorted(of, of[0], "right"))
                else:
                    y = x[rows]
                    y = y - y.mean(axis=0)
                    along = y @ y[np.argmax(np.einsum("ij,ij->i", y, y))]  # towards the row farthest out
                    cut = len(rows) // 2
                    self.order[s:e] = rows[np.argsort(along, kind="stable")]
                left[i] = len(starts)
                starts += [s, s + cut]
                ends += [s + cut, e]
                left += [0, 0]
            i += 1
        self.start, self.end, self.left = (np.array(a) for a in (starts, ends, left))
        self.x, self.label = x[self.order], label[self.order]
        runs = [self.x[s:e] for s, e in zip(starts, ends, strict=True)]
        self.centre = np.stack([r.mean(axis=0) for r in runs])
        self.radius = np.array([np.sqrt(np.einsum("ij,ij->i", r - c, r - c).max()) for r, c in zip(runs, self.centre, strict=True)])
        self.far = np.linalg.norm(self.centre, axis=1)
        of = [self.label[s:e] for s, e in zip(starts, ends, strict=True)]
        self.low, self.high = np.array([a.min() for a in of]), np.array([a.max() for a in of])

    def interval(self, i: int, other: Tree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Between what the scores of node i's rows with rows of the other's nodes lie."""
        middle = other.centre[nodes] @ self.centre[i]
        give = self.radius[i] * other.far[nodes] + other.radius[nodes] * self.far[i] + self.radius[i] * other.radius[nodes]
        give = give + LOOSE * (1 + np.abs(middle) + give)
        return middle - give, middle + give


class Best:
    """For each of n askers, of which each has slots, the k best (score, id) of what it has been offered; floor is the least score that may still enter."""

    def __init__(self, least: np.ndarray, most: np.ndarray, k: int):
        self.k, self.most = k, most
        self.least = least  # n x slots
        self.floor = least.copy()
        n, slots = least.shape
        self.row = np.zeros(0, np.int64)  # asker * slots + slot
        self.slots = slots
        self.score, self.col = np.zeros(0), np.zeros(0, np.int64)

    def offer(self, askers: np.ndarray, score: np.ndarray, wanted: np.ndarray, cols: np.ndarray, ids: np.ndarray) -> None:
        """Scores of askers (rows) and candidates (columns), and which of them may be taken; ids orders equal scores."""
        rows, values, at = [], [], []
        for s in range(self.slots):
            i, j = np.nonzero(wanted & (score >= self.floor[askers, s][:, None]) & (score <= self.most[askers, s][:, None]))
            rows.append(askers[i] * self.slots + s)
            values.append(score[i, j])
            at.append(cols[j])
        row, value, col = np.concatenate(rows), np.concatenate(values), np.concatenate(at)
        if not len(row):
            return
        mine = np.isin(self.row, row)
        r, v, c = np.append(self.row[mine], row), np.append(self.score[mine], value), np.append(self.col[mine], col)
        order = np.lexsort((c, ids[c], -v, r))
        r, v, c = r[order], v[order], c[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        keep = rank < self.k
        full = rank == self.k - 1
        self.floor.ravel()[r[full]] = v[full]
        self.row, self.score, self.col = np.append(self.row[~mine], r[keep]), np.append(self.score[~mine], v[keep]), np.append(self.col[~mine], c[keep])


def search(anchors: Tree, candidates: Tree, a_row: np.ndarray, c_row: np.ndarray, c_id: np.ndarray, best: Best, same: bool, at_once: int = 1024) -> int:
    """Offers best all pairs that may matter, of one label (same) or of two; rows are by place in the trees, and a row isn't paired with itself.
    Returns how many scores were computed."""
    scored = 0
    todo = [(0, np.array([0]))]
    while todo:
        i, nodes = todo.pop()
        group = np.arange(anchors.start[i], anchors.end[i])
        if same:
            nodes = nodes[(candidates.low[nodes] <= anchors.high[i]) & (candidates.high[nodes] >= anchors.low[i])]
        else:
            nodes = nodes[~((anchors.low[i] == anchors.high[i]) & (candidates.low[nodes] == anchors.low[i]) & (candidates.high[nodes] == anchors.low[i]))]
        low, high = anchors.interval(i, candidates, nodes)
        open_ = (high >= best.floor[group].min()) & (low <= best.most[group].max())
        nodes, high = nodes[open_], high[open_]
        if not len(nodes):
            continue
        inner = candidates.left[nodes] > 0
        if anchors.left[i]:
            below = candidates.left[nodes[inner]]
            following = np.concatenate([nodes[~inner], below, below + 1])
            todo += [(anchors.left[i], following), (anchors.left[i] + 1, following)]
        elif inner.any():
            below = candidates.left[nodes[inner]]
            todo.append((i, np.concatenate([nodes[~inner], below, below + 1])))
        else:
            order = np.argsort(-high, kind="stable")
            nodes, high = nodes[order], high[order]
            size = candidates.end[nodes] - candidates.start[nodes]
            at = 0
            while at < len(nodes):
                if high[at] < best.floor[group].min():
                    break  # all that follow end below it
                upto = max(at + 1, int(np.searchsorted(np.cumsum(size[at:]), at_once, "right")) + at)
                cols = np.concatenate([np.arange(candidates.start[n], candidates.end[n]) for n in nodes[at:upto]])
                score = exact(anchors.x[group], candidates.x[cols])
                scored += score.size
                alike = anchors.label[group][:, None] == candidates.label[cols][None]
                wanted = (alike if same else ~alike) & (a_row[group][:, None] != c_row[cols][None])
                best.offer(group, score, wanted, cols, c_id)
                at = upto
    return scored


def hard_negatives(df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100, scale: float = 256, block: int = 32_768, anchors: int = 4_096, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """For each anchor (a row for which the condition holds) and each of its positives: its hard negatives.

    Score: the inner product of floor(scale * x). Higher scores come first, ties go to the smaller id. Positives are the anchor's first other rows of its
    label; negatives of a positive are the first rows of other labels whose score, times 100, is between least and most times the positive's.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score; an anchor without positives, and a positive without negatives, has no rows.

    Rows with a null id or label, or whose vector is null, empty, holds null or non-finite components or is so large that scores may not fit a long (see countable), take no part; zero vectors do.
    Vectors meet those of their length only. Rows that repeat an id are rows of their own, anchors and candidates alike. Further columns are ignored; an empty table gives an empty result.

    Every anchor block of about `anchors` rows meets every candidate block of about `block` rows at most, smaller ones on small tables.
    """
    kind = "array<float>" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v"), F.col(label_col).cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = Saved(rows.filter(countable("v", scale) & F.col("label").isNotNull() & F.col("id").isNotNull()).withColumn("row", F.monotonically_increasing_id()).withColumn("d", F.size("v")), "vectors").df
    size = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("a")).first()
    c_blocks = max(1, -(-size["n"] // block), min(24, -(-size["n"] // 1024)))
    a_blocks = max(1, -(-size["a"] // anchors))
    place = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    window = "array<struct<id:long,row:long,score:long>>"
    offered = rows.select(place(c_blocks, "block").alias("c"), every(a_blocks).alias("a"), "d", "id", "row", "v", "label", F.lit(False).alias("asks"), F.lit(None).cast(window).alias("pos"))

    def best_of(asking: DataFrame, slots: int, k: int, same: bool) -> DataFrame:
        """By block pair: (asker, slot, row, id, score) of the k best of each anchor's slot."""
        asked = asking.select(every(c_blocks).alias("c"), place(a_blocks, "anchors").alias("a"), "d", "id", "row", "v", "label", F.lit(True).alias("asks"), "pos")
        make = lambda t: _search(t, slots, k, same, least, most, scale)
        return offered.unionByName(asked).groupBy("c", "a", "d").applyInArrow(make, "asker long, slot int, row long, id long, score long")

    asking = rows.filter("asks").withColumn("pos", F.lit(None).cast(window))
    first = best_of(asking, 1, positives, True)
    by = Window.partitionBy("asker").orderBy(F.desc("score"), "id", "row")
    first = first.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= positives)
    chosen = Saved(first.groupBy("asker").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "id", "row", "score"))), lambda p: F.struct(p.id.alias("id"), p.row.alias("row"), p.score.alias("score"))).alias("pos")), "positives").df
    asking = asking.drop("pos").join(chosen, F.col("row") == F.col("asker")).drop("asker")
    found = best_of(asking, positives, negatives, False)
    by = Window.partitionBy("asker", "slot").orderBy(F.desc("score"), "id", "row")
    found = found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= negatives)
    of = asking.select(F.col("row").alias("asker"), F.col("id").alias("anchor_id"), F.posexplode("pos").alias("slot", "p"))
    return found.join(of, ["asker", "slot"]).select("anchor_id", F.col("p.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))


def _search(t: pa.Table, slots: int, k: int, same: bool, least: int, most: int, scale: float) -> pa.Table:
    schema = pa.schema([("asker", pa.int64()), ("slot", pa.int32()), ("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
    asks = t.column("asks").to_numpy()
    t_a, t_c = t.filter(pa.array(asks)), t.filter(pa.array(~asks))
    if not t_a.num_rows or not t_c.num_rows:
        return schema.empty_table()
    tree = lambda x, leaf: Tree(integers(x.column("v").combine_chunks(), scale), x.column("label").to_numpy(), leaf)
    a, c = tree(t_a, 32), tree(t_c, LEAF)
    a_row, c_row, c_id = t_a.column("row").to_numpy()[a.order], t_c.column("row").to_numpy()[c.order], t_c.column("id").to_numpy()[c.order]
    if same:
        low, high = np.full((len(a_row), slots), -np.inf), np.full((len(a_row), slots), np.inf)
    else:
        # a slot without a positive takes nothing
        low, high = np.full((len(a_row), slots), np.inf), np.full((len(a_row), slots), -np.inf)
        pos = t_a.column("pos").to_pylist()
        for i, place in enumerate(a.order.tolist()):
            for s, p in enumerate(pos[place]):
                low[i, s], high[i, s] = -(-least * p["score"] // 100), most * p["score"] // 100  # whole scores between the two
    best = Best(low, high, k)
    search(a, c, a_row, c_row, c_id, best, same)
    return pa.table([pa.array(a_row[best.row // slots]), pa.array((best.row % slots).astype(np.int32)), pa.array(c_row[best.col]), pa.array(c_id[best.col]), pa.array(best.score.astype(np.int64))], schema=schema)


def oracle_sql() -> str:
    """The query's result by plain SQL: every anchor against every row."""
    return """with r as materialized (select row_number() over () as n, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
        from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
      s as materialized (select a.n as a, a.vec_id as anchor_id, b.n as b, b.vec_id as id, a.label = b.label as alike, cast(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) as bigint) as score
        from r a join r b on a.vec_id % 100 = 0 and a.n <> b.n and len(a.v) = len(b.v)),
      p as (select * from (select *, row_number() over (partition by a order by score desc, id, b) as place from s where alike) where place <= 5),
      g as (select p.anchor_id, p.id as positive_id, row_number() over (partition by p.a, p.b order by s.score desc, s.id, s.b) as rank, s.id as negative_id, p.score as positive_score, s.score as negative_score
        from p join s on s.a = p.a and not s.alike and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score)
      select * from g where rank <= 5"""
