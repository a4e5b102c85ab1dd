"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Token weights are summed by (source, language, topic) cell. Rounds of raking scale the cells' weights to the target
marginals of source, language and topic in turn. A cell's factor is its raked weight over its observed one.

keep_mixed draws each document share * factor times (of shares that add up to 1): the whole part of that surely, once more with the
rest as the probability. So cells that the targets want larger are repeated, and the expected tokens drawn are the wanted share
and meet the targets, however large a factor is. mixing_report says how often each document is drawn so (draws, times), and besides what
a sample without repeats would take: with probability min(1, scale * factor), the scale such that the expected tokens kept are the
wanted share; where cells are taken whole that sample doesn't meet the targets.

Targets follow from the observed marginals by an exponent (1: as they are, 0: all values alike), or are given by value. The
first dimension may have any number of values. A round is one window by it over the table of cells, and a sum by the combinations
of the other dimensions, of which there are few; their factors are a table of their own, written each round, so that plans
have one size whatever the number of rounds, and no task gets all cells. Rounds end when no marginal is further than
the tolerance from its target. Up to FEW_CELLS cells are arrays of one row instead, over which one expression folds the rounds: the
same weights without a job for each round. The documents' texts are not shuffled unless the table of cells is too large to be sent out by the
engine's own size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careerlake.llm.common import Saved

#: The production parameters: exponents of the marginals, raking rounds, share of tokens kept, seed.
EXPONENTS = {"source": 0.7, "lang": 0.7, "topic": 0.9}
ROUNDS, SHARE, SEED = 12, 0.8, "mix-1"
TOLERANCE = 1e-10  # of a marginal, as a share of its target
AT_ONCE = 1  # rounds in one plan; more are slower, as their code is compiled anew
FEW_CELLS, BROADCAST_ROWS = 4_096, 50_000


def token_weight(text: Column) -> Column:
    """Words and one end; a null text is empty."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def topic_of(text: Column, weight: Column) -> Column:
    """A coarse topic from the surface of the text: legal lines, figures, brief, long or prose."""
    t = F.coalesce(text, F.lit(""))
    figures = F.length(t) - F.length(F.translate(t, "0123456789", ""))
    return F.when(t.contains("icense") | t.contains("ights reserved"), "legal").when(figures * 20 > F.length(t), "figures").when(weight <= 100, "brief").when(weight > 2000, "long").otherwise("prose")


def uniform(id_col: Column, seed: str) -> Column:
    """A number in [0, 1) from the id alone: the first 52 bits of an md5."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / float(1 << 52)


def _target(d: str, mass: Column, target: float | dict[str, float]) -> Column:
    if not isinstance(target, dict):
        return F.pow(mass, F.lit(float(target)))
    named = F.create_map(*[F.lit(x) for value, share in target.items() for x in (value, float(share))]) if target else None
    return F.coalesce(F.element_at(named, F.col(d)), F.lit(0.0)) if target else F.lit(0.0)


class _Raking:
    """The cells, and by combination of all dimensions but the first the factors of the last two rounds (old, new)."""

    def __init__(self, cells: DataFrame, targets: dict[str, float | dict[str, float]]):
        dims = list(targets)
        self.wide, self.few = dims[0], dims[1:] or ["_all"]
        cells = cells if dims[1:] else cells.withColumn("_all", F.lit(0))
        mass = F.sum("w").over(Window.partitionBy(self.wide))
        by_value = cells.groupBy(self.wide).agg(F.sum(F.col("w").cast("double")).alias("w")).select(F.sum(_target(self.wide, F.col("w"), targets[self.wide])).alias("t"), F.sum("w").alias("w"))
        sums = by_value.first()
        self.total, self.cells = sums["w"], None
        if not self.total or not sums["t"]:
            return
        self.cells = Saved(cells.select(*dims, *([] if dims[1:] else ["_all"]), F.col("w").cast("double").alias("w")).withColumn("want", _target(self.wide, mass, targets[self.wide]) / sums["t"]), "raking-cells").df
        grid = self.cells.groupBy(*self.few).agg(F.sum("w").alias("w")).coalesce(1)
        for d in self.few:
            own = F.sum("w").over(Window.partitionBy(d))
            grid = grid.withColumn(f"_m_{d}", own).withColumn(f"_t_{d}", _target(d, F.col(f"_m_{d}"), targets.get(d, 1.0)))
            # each value counts once: by its combinations' shares of its weight
            grid = grid.withColumn(f"_t_{d}", F.try_divide(F.col(f"_t_{d}"), F.sum(F.col(f"_t_{d}") * F.col("w") / F.col(f"_m_{d}")).over(Window.partitionBy()))).drop(f"_m_{d}")
        self.grid = Saved(grid.drop("w").withColumn("old", F.lit(None).cast("double")).withColumn("new", F.lit(1.0)), "raking")

        self.grid.df = self.grid.df.coalesce(1)
        self.hint = "/*+ broadcast(g) */ " if self.grid.df.count() <= BROADCAST_ROWS else ""

    def sql(self, rounds: int) -> str:
        """So many rounds as one statement over the tables cells and g0; off is how far marginals are off before the last round.

        Text, as a plan built column by column takes longer to make than a round to run.
        """
        few, wide = self.few, self.wide
        keys, ts = ", ".join(few), ", ".join(f"_t_{d}" for d in few)
        scaled = lambda by: f"coalesce(try_divide(want, sum(w * {by}) over (partition by {wide})), 0d)"
        steps = []
        for k in range(rounds):
            same = " and ".join(f"c.{d} <=> g.{d}" for d in few)  # nulls are a value of their own
            steps.append(f"j{k} as (select {self.hint}c.*, g.old, g.new, {ts} from cells c join g{k} g on {same})")
            steps.append(f"s{k} as (select *, {scaled('old')} as _then, {scaled('new')} as _now from j{k})")
            off = "max(case when want > 0 then abs(coalesce(try_divide(_then, _now), 2d) - 1) end)"
            steps.append(f"m{k} as (select /*+ coalesce(1) */ {keys}, old, new, {ts}, sum(w * new * _then) as before, sum(w * new * _now) as mass0, {off} as off from s{k} group by {keys}, old, new, {ts})")
            factor, at = "1d", f"m{k}"
            for i, d in enumerate(few):
                far = f"case when _t_{d} > 0 then abs(try_divide(sum(before) over (partition by {d}), _t_{d}) - 1) end"
                by = f"coalesce(try_divide(_t_{d}, sum(mass{i}) over (partition by {d})), 0d)"
                steps.append(f"n{k}_{i} as (select *, mass{i} * by{i} as mass{i + 1} from (select *, {by} as by{i}, {far} as off{i} from {at}))")
                factor, at = f"{factor} * by{i}", f"n{k}_{i}"
            offs = ", ".join(f"off{i}" for i in range(len(few)))
            steps.append(f"g{k + 1} as (select {keys}, {ts}, new as old, new * ({factor}) as new, greatest(0d, off, {offs}) as off from {at})")
        return f"with {', '.join(steps)} select * from g{rounds}"

    def run(self, rounds: int, tolerance: float) -> None:
        """A few rounds are one plan, whose factors are written."""
        done, spark = 0, self.cells.sparkSession
        while done < rounds:
            now = min(AT_ONCE, rounds - done)
            after = Saved(spark.sql(self.sql(now).replace("from cells", "from {cells}").replace("join g0 g", "join {g0} g"), cells=self.cells, g0=self.grid.df), "raking")
            self.grid.drop()
            after.df = after.df.coalesce(1)
            self.grid, done = after, done + now
            if done > 1 and after.df.agg(F.max("off")).first()[0] <= tolerance:
                break

    def raked(self) -> DataFrame:
        """The cells with their raked weights: the last round's, its first dimension scaled before the others."""
        few = self.few
        same = " and ".join(f"c.{d} <=> g.{d}" for d in few)
        # old is null before the first round: as observed
        found = f"case when old is null then w / {self.total!r}d else w * new * coalesce(try_divide(want, sum(w * old) over (partition by {self.wide})), 0d) end"
        both = f"select {self.hint}c.*, g.old, g.new from {{cells}} c join {{grid}} g on {same}"
        return self.cells.sparkSession.sql(f"select *, {found} as raked from ({both})", cells=self.cells, grid=self.grid.df)


def _rake_few(cells: DataFrame, targets: dict[str, float | dict[str, float]], rounds: int) -> DataFrame:
    """The same for a bounded number of cells, in one statement: they are arrays of one row, over which all rounds are folded."""
    dims, at = list(targets), cells.select(*targets, F.col("w").cast("double").alias("w"))
    ranks = ", ".join(f"dense_rank() over (order by {d}) as _k_{d}" for d in dims)
    numbered = Saved(at.sparkSession.sql(f"select *, row_number() over (order by {', '.join(dims)}) as _i, {ranks} from {{at}}", at=at.coalesce(1)), "few-cells").df
    sides = []
    for d, target in targets.items():
        share = F.expr(f"pow(sum(w), {float(target)!r}d)") if not isinstance(target, dict) else F.first(_target(d, F.col("w"), target))
        one = numbered.groupBy(f"_k_{d}").agg(F.sort_array(F.collect_list("_i")).alias("m"), share.alias("t")).coalesce(1)
        sides.append(one.agg(F.expr(f"transform(array_sort(collect_list(struct(_k_{d}, m, t))), x -> struct(x.m as m, x.t as t))").alias(f"_s_{d}")))
    keys = ", ".join(f"transform(c, x -> x._k_{d})" for d in dims)
    row = numbered.coalesce(1).agg(F.expr("array_sort(collect_list(struct(_i, w, " + ", ".join(f"_k_{d}" for d in dims) + ")))").alias("c"))
    for side in sides:
        row = row.crossJoin(F.broadcast(side))  # of one row each
    row = row.selectExpr(
        "transform(c, x -> x.w / aggregate(c, 0d, (a, y) -> a + y.w)) as x0",
        f"array({keys}) as k",
        "array(" + ", ".join(f"transform(_s_{d}, x -> x.m)" for d in dims) + ") as m",
        "array(" + ", ".join(f"transform(_s_{d}, x -> try_divide(x.t, aggregate(_s_{d}, 0d, (a, y) -> a + y.t)))" for d in dims) + ") as t",
    )
    n = len(dims)
    d = f"(r - 1) % {n}"
    sums = f"transform(m[{d}], mine -> aggregate(mine, 0d, (a, i) -> a + x[i - 1]))"
    scaled = f"transform(x, (e, i) -> e * coalesce(try_divide(t[{d}][k[{d}][i] - 1], s[k[{d}][i] - 1]), 0d))"
    fold = f"aggregate(sequence(1, {rounds * n}), x0, (x, r) -> transform(array({sums}), s -> {scaled})[0])" if rounds else "x0"
    found = row.selectExpr(f"posexplode({fold}) as (_at, raked)")
    return numbered.join(F.broadcast(found), F.col("_i") == F.col("_at") + 1).select(*dims, "w", "raked")


def rake(cells: DataFrame, targets: dict[str, float | dict[str, float]], rounds: int = ROUNDS, share: float = SHARE, tolerance: float = TOLERANCE) -> DataFrame:
    """cells: the dimensions and w > 0. Adds raked (weights that meet the targets), draws (expected ones of a document, above 1 too) and probability (of drawing it once at most).

    Rounds end at the tolerance, or after so many. A target of 0 gives weights of 0. No cells, or targets that are all 0: an empty result.
    """
    dims = list(targets)
    size = cells.agg(F.count("*"), F.sum(F.col("w").cast("double"))).first()
    budget = float(share) * (size[1] or 0.0)
    if size[0] <= FEW_CELLS:
        raked = _rake_few(cells, targets, rounds) if size[0] else None
    else:
        r = _Raking(cells, targets)
        if r.cells is not None:
            r.run(rounds, tolerance)
        raked = r.raked() if r.cells is not None else None
    if raked is None:
        empty = cells.limit(0).select(*dims, F.col("w").cast("double").alias("w"))
        return empty.select("*", *[F.lit(0.0).alias(c) for c in ("raked", "draws", "probability")])
    found = Saved(raked.select(*dims, "w", "raked").withColumn("factor", F.col("raked") / F.col("w")), "raked-cells").df
    mass = found.agg(F.sum("raked")).first()[0]
    # cells whose chance would be above 1 are taken whole and the scale of the rest rises, until none of the rest is above 1
    scale = 0.0 if not mass else budget / found.agg(F.sum(F.col("w") * F.col("factor"))).first()[0]
    while scale:
        over = scale * F.col("factor") > 1
        whole, rest = found.agg(F.sum(F.when(over, F.col("w"))), F.sum(F.when(~over, F.col("w") * F.col("factor")))).first()
        following = (budget - whole) / rest if whole is not None and rest else scale
        if following <= scale * (1 + 1e-15):
            break
        scale = following
    chance = F.lit(1.0) if share >= 1 else F.least(F.lit(1.0), F.lit(scale) * F.col("factor"))
    return found.select(*dims, "w", "raked", (F.lit(budget / mass if mass else 0.0) * F.col("factor")).alias("draws"), chance.alias("probability"))


def _described(docs: DataFrame, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    """Each row as _row, with what raking needs of it."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    at = row.select("_row", F.col("_row")[source_col].cast("string").alias("source"), F.col("_row")[lang_col].cast("string").alias("lang"), token_weight(F.col("_row")[text_col]).alias("tokens"))
    return at.withColumn("topic", topic_of(F.col("_row")[text_col], F.col("tokens")))


def _weighed(at: DataFrame, targets: dict | None, rounds: int, share: float, id_col: Column, seed: str) -> DataFrame:
    """at (source, lang, topic, tokens and more) with probability, selected (both of drawing once at most) and times (drawn with repeats)."""
    cells = Saved(at.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("w")), "cells").df
    raked = Saved(rake(cells, EXPONENTS if targets is None else targets, rounds, share), "raked").df.select(*[F.col(d).alias(f"_{d}") for d in ("source", "lang", "topic")], "probability", "draws")
    joined = at.join(raked, at.source.eqNullSafe(raked._source) & at.lang.eqNullSafe(raked._lang) & (at.topic == raked._topic))
    at_random, whole = uniform(id_col, seed), F.floor("draws")
    times = (whole + (at_random < F.col("draws") - whole).cast("long")).cast("int")
    return joined.withColumn("selected", at_random < F.col("probability")).withColumn("times", times)


def mixing_report(docs: DataFrame, targets: dict | None = None, rounds: int = ROUNDS, share: float = SHARE, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """doc_id, source, lang, topic, tokens, draws (expected, 6 digits) and times (drawn, with repeats: the sample that meets the targets) of every row, and
    probability (6 digits) and selected (drawn once at most).

    Null sources and languages are values of their own; null texts are empty and weigh one token. Rows with one id are drawn together,
    those with a null id too. Further columns are ignored; an empty table gives an empty result. Texts are read once: their topics
    and weights are kept in a table.
    """
    at = _described(docs, text_col, source_col, lang_col).select(F.col("_row")[id_col].alias("doc_id"), F.col("_row")[source_col].alias("_source_as_is"), F.col("_row")[lang_col].alias("_lang_as_is"), "source", "lang", "topic", "tokens")
    done = _weighed(Saved(at, "described").df, targets, rounds, share, F.col("doc_id"), seed)
    return done.select("doc_id", F.col("_source_as_is").alias("source"), F.col("_lang_as_is").alias("lang"), "topic", "tokens", F.round("draws", 6).alias("draws"), "times", F.round("probability", 6).alias("probability"), "selected")


def keep_mixed(docs: DataFrame, targets: dict | None = None, rounds: int = ROUNDS, share: float = SHARE, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """The rows drawn, all columns as they are, each as many times as it is drawn.

    Nulls, empty texts, repeated ids and empty tables as in mixing_report; further columns stay whatever their names.
    """
    done = _weighed(_described(docs, text_col, source_col, lang_col), targets, rounds, share, F.col("_row")[id_col], seed)
    return done.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("_row.*")


def oracle_sql(rounds: int = ROUNDS, share: float = SHARE, seed: str = SEED, table: str = "documents") -> str:
    """DuckDB SQL for mixing_report."""
    steps = [
        f"""d as (select doc_id, source, lang, coalesce(text, '') as t, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) + 1 as bigint) as tokens from {table})""",
        """k as (select *, case when contains(t, 'icense') or contains(t, 'ights reserved') then 'legal' when (length(t) - length(regexp_replace(t, '[0-9]', '', 'g'))) * 20 > length(t) then 'figures' when tokens <= 100 then 'brief' when tokens > 2000 then 'long' else 'prose' end as topic from d)""",
        "c0 as (select source, lang, topic, cast(sum(tokens) as double) as w from k group by all)",
    ]
    marginals = ", ".join(f"sum(w) over (partition by {d}) as m_{d}" for d in EXPONENTS)
    steps.append(f"c1 as (select *, {marginals} from c0)")
    wanted = ", ".join(f"pow(m_{d}, {x}) / sum(pow(m_{d}, {x}) * w / m_{d}) over () as t_{d}" for d, x in EXPONENTS.items())
    steps.append(f"r0 as (select source, lang, topic, w, {wanted}, w / sum(w) over () as raked from c1)")
    n = 0
    for _ in range(rounds):
        for d in EXPONENTS:
            steps.append(f"r{n + 1} as (select * replace (raked * t_{d} / sum(raked) over (partition by {d}) as raked) from r{n})")
            n += 1
    steps.append(f"f as (select source, lang, topic, w, raked / w as factor, {share} * sum(w) over () / sum(raked) over () as budget from r{n})")
    order = "order by factor desc, source, lang, topic"
    steps.append(f"s as (select *, ({share} * sum(w) over () - coalesce(sum(w) over ({order} rows between unbounded preceding and 1 preceding), 0)) / sum(w * factor) over ({order} rows between current row and unbounded following) as scale from f)")
    steps.append(f"o as (select *, row_number() over ({order}) as place from s)")
    steps.append("q as (select *, min(case when scale * factor <= 1 then place end) over () as first_place from o)")
    steps.append("p as (select source, lang, topic, max(budget) over () * factor as draws, least(1.0, coalesce(max(case when place = first_place then scale end) over () * factor, 1.0)) as probability from q)")
    draw = f"cast(('0x' || substr(md5('{seed}:' || coalesce(cast(doc_id as varchar), '')), 1, 13)) as bigint) / 4503599627370496.0"
    return "with " + ", ".join(steps) + f" select k.doc_id, k.source, k.lang, k.topic, k.tokens, round(p.draws, 6) as draws, cast(floor(p.draws) + case when {draw} < p.draws - floor(p.draws) then 1 else 0 end as int) as times, round(p.probability, 6) as probability, {draw} < p.probability as selected from k join p on k.source is not distinct from p.source and k.lang is not distinct from p.lang and k.topic = p.topic"
