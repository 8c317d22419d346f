"""Corpus pipeline: language, quality, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. Its result is
written as Parquet and read again as the next stage's docs, so each stage works
on all that the one before kept, and a lost executor repeats one stage at most.
All stages but the last return the columns of docs, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import jaccard, langid, packing, quality
from shelfrank.llm.common import table
from shelfrank.llm.queries import tokenizer_path
from shelfrank.session import scratch_path


def _columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; null texts, texts without a
    letter and texts far from what held-out documents of their language take
    (`langid.limits`) go."""
    model = langid.train(docs)
    rows, (lang, _, rate) = langid.identify(docs, model)
    foreign = langid.is_foreign(langid.limits(docs, model), lang, rate)
    return _columns(rows.where((F.col(lang) != langid.UNDETERMINED) & ~foreign), docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from
    `labels` on these documents."""
    rows, names = quality.judge(docs, quality.learn(docs, table(spark, sf_dir, "labels")))
    return _columns(rows.where(F.col(names["kept"])), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class, that of the smallest id (`jaccard.one_of_each`). A
    row is judged by its own text: rows of one id and several texts may stay,
    rows of one id and one text stay once, and null ids take part."""
    return _columns(jaccard.one_of_each(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents packed into sequences of 4096 ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("ngram_jaccard", near_duplicates),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned models, reachability and packing are not for SQL; tests compare the
#: stages with brute-force versions.
ORACLE_SQL = None
