"""Corpus pipeline: language ID, line dedup, near-duplicate removal, mixing, BPE.

Each stage takes (spark, docs, sf_dir), works on everything that its predecessor kept and returns
a DataFrame, which is written as Parquet and reread as the next one's ``docs``. All but the last
return the columns of documents.

Files belong to the cluster's shared folder (``spark.checkpoint.dir``); a run has a folder of its
own there. What a stage wrote is deleted when the next one has read it, the rest when the driver
ends.

An empty table passes all stages and gives an empty result. Columns beyond those of documents are
kept by all stages but the last, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillspark.llm.bpe import encode_documents
from quillspark.llm.common import new_path
from quillspark.llm.lang_cnn import fit_language_model, keep_identified
from quillspark.llm.line_templates import without_recurring_lines
from quillspark.llm.mixing import measured_weights, mix
from quillspark.llm.near_copies import without_near_copies

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: no text, no letter, or a score under one half.

    Null and empty texts go, and null ids do not matter. Very long texts are read whole. Equal texts are judged alike, so repeated
    rows stay or go together. Without any labelled document no language is known, and all documents go.
    """
    return keep_identified(docs, fit_language_model(docs))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go from all documents but the first; a document of nothing else goes with them.

    The first is the document with the least id (null before others), then the least hash of id and text. Null and empty texts stay.
    Lines are compared whole, however long. Repeated rows (equal id and text) count as one document and are treated alike.
    """
    return without_recurring_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5-word Jaccard similarity of 0.8 or more) stays: the one with the least id.

    Texts without a word are copies of each other, null ones too. Very long texts are compared whole. Ties (one id, several texts)
    go to the least hash of the text; repeated rows fall together. Rows without an id cannot be named and stay.
    """
    return without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in mixed order: sources take turns in proportion to their size to the power 0.7.

    Every row stays exactly once, repeated ones as often as they came. Rows without a source come last. Ids and texts may be null,
    empty or very long; they only settle the order within a source, and equal rows take places of their own.
    """
    return mix(docs, measured_weights(docs))


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and digests of every document, in the order of its input.

    Null and empty texts have no tokens; very long ones are encoded whole. Ids are carried along, null or repeated as they are.
    """
    return encode_documents(docs, VOCABULARY)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_recurring_lines),
    ("near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("BPE", encode_bpe),
]

#: SQL can express neither the network of the first stage nor XXH64.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = new_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            gone = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{k - 1}")
            gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return STAGES[-1][1](spark, docs, sf_dir)
