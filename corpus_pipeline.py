"""A corpus pipeline: quality rules, near duplicates, personal data, mixing and encoding, each on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citeloom.llm.common import cut
from citeloom.llm.jaccard import keep_one_of_each
from citeloom.llm.mixing import in_order, mixed
from citeloom.llm.pii import pseudonymise
from citeloom.llm.quality import quality_filter
from citeloom.llm.queries import PII_KEY, TOKENIZERS, WEIGHTS
from citeloom.llm.sentencepieces import encode


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by links (five words, similarity 0.8), the one with the smallest doc_id stays."""
    return keep_one_of_each(docs, 5, (8, 10))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts get pseudonyms; no document goes."""
    return pseudonymise(docs, PII_KEY)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: the decision is the order of rows in the files."""
    return mixed(docs, WEIGHTS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and its position in the mix: the place of its row in the files."""
    return encode(in_order(docs), f"{TOKENIZERS}/piece_bpe_32k.model", ["position"])


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixing", mixing), ("encoding", encoding)]

#: Keyed pseudonyms and token ids are not SQL's to express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
