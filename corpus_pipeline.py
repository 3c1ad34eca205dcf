"""The corpus pipeline: five stages over documents, each written as Parquet and read again for the next.

For all stages: a null text counts as an empty one and stays null where it is
kept; empty texts stay, as copies of each other but for one; very long texts
are taken whole; rows that repeat are copies, of which one stays after
near_dedup; ties go to the lowest doc_id, null lowest, then to the lowest hash
of the text; empty tables give empty results; further columns of documents are
kept up to packing, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import load, remove_path, shared_path
from eventide.llm.line_dedup import dedup_lines
from eventide.llm.near_copies import keep_first_copy
from eventide.llm.packing import pack
from eventide.llm.substring_dedup import dedup_substrings
from eventide.llm.toxicity import keep_clean

#: Path of the tokenizer file, and the id that ends a document.
TOKENIZER, END_ID = public_tokenizers.path("word_bpe_49k.json"), 1
#: Words from which a repeated run of one or two lines goes; of three lines or more all go.
LINE_WORDS = 8
#: Words of a shingle, and the Jaccard similarity from which texts are near copies.
SHINGLE, SIMILARITY = 5, 0.8


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_clean(docs, load(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go where they occur later."""
    return dedup_lines(docs, words=LINE_WORDS).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: SimHash through BK-trees, then exact similarity."""
    return keep_first_copy(docs, SHINGLE, SIMILARITY)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat go."""
    return dedup_substrings(docs).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of what is left, packed into sequences."""
    out = pack(docs, TOKENIZER, END_ID)
    return out.select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("packing", packing)]

#: The learned classifier and the packing can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
        # What the stage before has written isn't read again.
        if before:
            remove_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir).withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
