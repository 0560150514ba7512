"""Documents through the stages of a training-data pipeline, each stage written and read again."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from docsync.llm.common import scratch, ship, table
from docsync.llm.jaccard import one_per_group
from docsync.llm.mixing import take
from docsync.llm.packing import placed
from docsync.llm.quality import keep_good
from docsync.llm.queries import tokenizer
from docsync.llm.suffixes import cut_repeats
from docsync.storage import delete, new_folder

#: Folders of the tables that the last stage staged.
_LEFT: list[str] = []


def step(function):
    """A stage. Its predecessor's result is written before it starts, so it first deletes the
    tables that the predecessor had staged; its own stay until its result is written too."""
    @wraps(function)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        while _LEFT:
            delete(spark, _LEFT.pop())
        with scratch() as made:
            out = function(spark, docs, sf_dir)
        _LEFT.extend(made)
        return out
    return run_step


@step
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their host's verdict reject go."""
    return keep_good(docs)


@step
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return one_per_group(docs)


@step
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur more than once are cut out of the texts."""
    return cut_repeats(docs)


@step
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, so also not at all or twice."""
    return take(docs)


@step
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, with their ids."""
    out = placed(docs, tokenizer(), carry=["doc_id", "lang", "source"], with_ids=True)
    return out.select("row.*", *[c for c in out.columns if c != "row"])


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    while _LEFT:
        delete(spark, _LEFT.pop())
    return docs


#: Dependent rounding and the packing's linear program have no counterpart in SQL.
ORACLE_SQL = None
