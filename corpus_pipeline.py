"""From raw documents to packed token sequences: the stages, each of which works on all that its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again for the next. All but the last return the columns of ``documents``.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from asterlap.llm import dart_minhash, packing, positional_index, quality_rules, repeated_windows
from asterlap.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that many documents of a host share go from the others."""
    return quality_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return dart_minhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur more than once go; a document without any words left goes."""
    return repeated_windows.cleaned(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return positional_index.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences."""
    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packed),
]
#: Signatures and tokens have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
