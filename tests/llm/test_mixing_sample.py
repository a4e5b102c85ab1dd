from pyspark.sql import functions as F

from careerlake.llm import mixing


def test_sample_with_repeats_meets_its_targets(spark):
    """Targets that want some cells several times over: the sample without repeats can't meet them, that with repeats does."""
    text = F.array_join(F.array_repeat(F.lit("word"), (200 + F.col("id") % 13).cast("int")), " ")
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), text.alias("text"), F.concat(F.lit("s"), (F.col("id") % 3 % 2).cast("string")).alias("source"), F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("lang"))
    targets = {"source": {"s0": 0.5, "s1": 0.5}, "lang": {"rare": 0.5, "common": 0.5}, "topic": 1.0}
    got = mixing.mixing_report(docs, targets, share=0.9)
    rows = got.groupBy("lang").agg(F.sum(F.col("times") * F.col("tokens")).alias("t"), F.sum(F.when(F.col("selected"), F.col("tokens"))).alias("s"), F.max("times").alias("most")).collect()
    share = {r.lang: r.t / sum(x.t for x in rows) for r in rows}
    once = {r.lang: r.s / sum(x.s for x in rows) for r in rows}
    assert abs(share["rare"] - 0.5) < 0.01 and abs(once["rare"] - 0.5) > 0.3
    assert {r.lang: r.most for r in rows}["rare"] >= 4
    by_source = {r.source: r.t for r in got.groupBy("source").agg(F.sum(F.col("times") * F.col("tokens")).alias("t")).collect()}
    assert abs(by_source["s0"] / sum(by_source.values()) - 0.5) < 0.01
    whole = got.agg(F.sum(F.col("times") * F.col("tokens")) / F.sum("tokens")).first()[0]
    assert abs(whole - 0.9) < 0.01
