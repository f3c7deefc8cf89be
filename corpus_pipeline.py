"""A corpus from raw documents to packed sequences: the stages and their run.

Every stage takes its whole input: texts of any length, null and empty ones, null ids, ids and rows that come twice, empty
tables, and further columns of any name, which it hands on. The first four only drop rows and keep the columns.
A null text is not toxic unless texts without terms are, has the statistics of an empty one,
is nobody's near duplicate, holds no benchmark passage, and packs as an empty document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listloom.llm import decontamination, ngram_join, packing, quality, toxicity
from listloom.llm.common import prepare, stored
from listloom.llm.queries import table, tokenizer_path
from listloom.scale import broadcast_if_small

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Documents whose id and text hash are not among the rejected ones; null ids are compared too."""
    side = broadcast_if_small(stored(rejected.select("_id", "_hash").distinct(), "rejected"), rows=ngram_join.BROADCAST_CLASSES)
    same = docs["doc_id"].eqNullSafe(side["_id"]) & (F.xxhash64(docs["text"]) == side["_hash"])
    return docs.join(side, same, "left_anti")


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(_marked(docs), model, keep=("doc_id", "_hash"))
    return _without(docs, scored.where("predicted = 1").withColumnRenamed("doc_id", "_id"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learnt decision list keeps; short but clean ones stay."""
    stats = stored(quality.text_statistics(_marked(docs), keep=("doc_id", "_hash")), "quality-stats")
    rules = quality.learn(quality.labelled_statistics(stats, table(spark, sf_dir, "labels")))
    return _without(docs, stats.where(~quality.keep_column(rules)).withColumnRenamed("doc_id", "_id"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word n-grams, similarity of 0.8 or more."""
    return ngram_join.keep_one_of_each(docs, ngram_join.Similarity(words=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no benchmark passage."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens from what is left."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Two stages learn their rules from labels and one encodes tokens, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
