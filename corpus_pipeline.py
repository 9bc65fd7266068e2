"""A corpus from documents to packed token sequences, by five of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hertzmill.llm.common import discard, materialize
from hertzmill.llm.jaccard import one_of_each
from hertzmill.llm.mixing import mixed
from hertzmill.llm.packing import pack
from hertzmill.llm.passages import repeated_passages, without_passages
from hertzmill.llm.quality import without_rejected


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is too low go, also null, empty and word-free texts.

    Other columns, of any name, and the rows that stay are as they were; repeated rows are
    judged alike; texts of any length are measured whole. No rows: no rows.
    """
    return without_rejected(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the document with the smallest id stays.

    Rows with that id all stay, repeated or not. Null, empty and word-free texts are
    alike with nothing and stay; so does a row with a null id unless its text equals that
    of a row with one. Rows that stay are as they were. No rows: no rows.
    """
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has are cut out.

    n_chars follows the text; a row of which nothing is left goes; other rows and columns
    are as they were, null texts and null ids among them. Rows that repeat an id are cut
    by word position. No rows: no rows.
    """
    return without_passages(docs, repeated_passages(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to their weights: a document comes zero, one or two times.

    A null source is a source of its own; null texts have size 0; equal ids stand or fall
    together; columns are as they were. No rows: no rows.
    """
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens.

    A null text is an empty one: a single end id. Repeated rows give repeated pieces, a null
    id stays null. No rows: no rows.
    """
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: Expectation-maximisation, components and packing have no plain SQL form. Tests compare operators 1, 2, 6, 8 and 10 with plain versions
#: and check what each stage of a run keeps; the pipeline as a whole has no plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is written and read again as the next one's input, then deleted when that is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
