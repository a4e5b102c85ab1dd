"""The corpus pipeline: toxicity, quality, near duplicates, mixing, encoding, each over all that the stage before kept.

In every stage a null text counts as an empty one; rows that repeat an id are judged, drawn and encoded alike, but that one of them stays
for near duplicates, where rows with a null id all stay; further columns stay but for the last stage, whatever their names; an empty
table gives an empty result. The simhash stage keeps to the terms of op2 (three-word shingles, 3 bits), not to five words and a similarity of
0.8: fingerprints of texts as similar as 0.8 differ in some ten bits of 64, which no ball of bits reaches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from careerlake.llm import merge_dropout, mixing, quality, simhash, toxicity
from careerlake.llm.common import Saved, held_out, read
from careerlake.llm.queries import vocabulary

THRESHOLD = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject; it learns as op10 does."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, read(spark, sf_dir, "labels"), ~held_out(3, 1)), THRESHOLD)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; it learns as op3 does."""
    stats = Saved(quality.document_statistics(docs), "statistics")
    return quality.keep_good(docs, quality.fit(stats.df, read(spark, sf_dir, "labels"), ~held_out(4, 2)), THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return simhash.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample, with repeats, whose expected tokens meet the target shares of source, language and topic."""
    return mixing.keep_mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, with merge-dropout, and whether they decode to its text."""
    return merge_dropout.segmentations(docs, vocabulary("piece_bpe_32k.model"), rate=0.1, seed=5)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("simhash", drop_near_duplicates),
    ("mixing", mix),
    ("encoding", encode),
]

#: SQL can't express the classifiers, the fingerprints' components or the encoder; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's are written to the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Saved(stage(spark, docs, sf_dir), f"stage-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)
