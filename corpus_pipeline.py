"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Between
stages the rows are written as Parquet and read again, so a lost executor costs no more than the stage it was working for; what a
stage has read is deleted as soon as the next one is written.

Defined cases, for every stage: rows are told apart as rows, so ids may be null or repeated; a null text counts as empty; an empty
table gives no rows; other columns are carried, whatever their names, up to packing."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import quality
from tessera.llm.common import removed, shared, table
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.mixing import mix
from tessera.llm.packing import pack
from tessera.llm.queries import VOCABULARY
from tessera.llm.shingle_join import one_of_each


#: Target weight of each source; None: the square root of its rows, so that a hot source does not drown the others.
WEIGHTS: dict[str, float] | None = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on all labels, does not reject; a null or empty text scores by the intercept."""
    weights = quality.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return quality.score(docs, weights).where("score >= 0.5").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased), the row with the smallest id, nulls last; of rows that share that, too, one."""
    return exact_dedup(docs).where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, a similarity of 0.8), the row with the smallest id, nulls last; texts without words stay."""
    return one_of_each(docs)


def interleave(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, written in the order of the mixing schedule with WEIGHTS."""
    return mix(docs, WEIGHTS, carry=True).repartitionByRange("position").sortWithinPartitions("position").select("row.*")


def fill(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence; of equally long pieces those that come first in the mixing order are placed first."""
    return pack(docs, **VOCABULARY)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", interleave),
    ("best-fit packing", fill),
]

#: Training and packing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the table documents."""
    shared(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            atexit.register(removed, spark, folder)
            return out
        out.write.parquet(f"{folder}/{i}")
        if i:
            removed(spark, f"{folder}/{i - 1}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
