"""Reading abstracts and stage tables, writing results."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.dictionaries import Dictionaries, Lists, ListTables
from quillspark.functions.durable import exists
from quillspark.operators.records import with_metadata
from quillspark.sources.splits import read_records
from quillspark.sources.workbooks import register, write_workbook

#: Columns of the pairs table by their names in exchanged files.
PAIR_COLUMNS = {
    "miRNA": "mirna", "Target Gene": "gene", "Relation Confidence": "confidence", "Relation Type": "relation_type", "Source Sentence": "sentence",
    "Article Title": "title", "PMID": "pmid", "DOI": "doi", "Species": "species", "#": "idx",
    "LLM Review Result": "review_result", "LLM Rationale": "rationale", "Manual Keep": "manual_keep",
}


def read_abstracts(spark: SparkSession, path: str) -> DataFrame:
    """Records with metadata from UTF-8 text files of any size: file_id (path), abstract_index, block, pmid, doi, title, body."""
    return with_metadata(read_records(spark, path))


def read_pairs(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """A pairs or reviewed table (Parquet, CSV or xlsx); columns may have their exchanged names. Whether review columns exist is read from the header."""
    options = {"header": "true", "multiLine": "true", "escape": '"'} if form == "csv" else {}
    if form == "xlsx":
        register(spark)
    found = spark.read.format(form).options(**options).load(path)
    named = found.select(*[F.col(f"`{c}`").alias(PAIR_COLUMNS.get(c, c)) for c in found.columns])
    return named.withColumn("idx", F.col("idx").cast("long")) if "idx" in named.columns else named


def write_table(df: DataFrame, path: str, form: str = "parquet", exchanged: bool = False) -> None:
    """Write a result; ``exchanged`` gives columns their exchanged names."""
    back = {v: k for k, v in PAIR_COLUMNS.items()} if exchanged else {}
    named = df.select(*[F.col(c).alias(back.get(c, c)) for c in df.columns])
    if form == "xlsx":
        return write_workbook({"Sheet1": named}, path, {"Sheet1": tuple(c for c in ("#", "no") if c in named.columns)})
    options = {"header": "true", "escape": '"'} if form == "csv" else {}
    named.write.mode("overwrite").format(form).options(**options).save(path)


#: Longer lists are joined as tables: expressions cannot hold them.
MOST_LITERALS = 5000


def read_dictionaries(spark: SparkSession, path: str) -> Lists:
    """The current version of both lists (list, name): literals if they are short, else a table."""
    names = spark.read.parquet(path).select("list", "name").distinct()
    rows = names.limit(MOST_LITERALS + 1).collect()
    if len(rows) > MOST_LITERALS:
        return ListTables(names)
    return Dictionaries(*(tuple(sorted(r.name for r in rows if r.list == kind)) for kind in ("blacklist", "whitelist")))


def write_dictionaries(lists: DataFrame, folder: str) -> str:
    """Write a new version of the lists beside the old ones, which stay as backups; returns its path."""
    path = f"{folder.rstrip('/')}/version-{datetime.datetime.now(datetime.timezone.utc):%Y%m%dT%H%M%S%f}"
    lists.select("list", "name").coalesce(1).write.parquet(path)
    return path


VERDICTS = "idx long, is_gene boolean, is_target boolean, relevance string, relation_type string, explanation string"


def first_existing(spark: SparkSession, *paths: str) -> str:
    """The first of some paths that exists: the reviewed table, say, else the pairs as mined."""
    for path in paths:
        if path and exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these exists: {', '.join(filter(None, paths))}")


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """The verdicts given so far; none before the first ones are appended. A pair that was answered twice keeps one answer."""
    if not exists(spark, path):
        return spark.createDataFrame([], VERDICTS)
    return spark.read.schema(VERDICTS).parquet(path).dropDuplicates(["idx"])


def append_verdicts(verdicts: DataFrame, path: str) -> None:
    """Add verdicts to those on file, from where a later run goes on."""
    verdicts.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in verdicts.sparkSession.createDataFrame([], VERDICTS).schema]).write.mode("append").parquet(path)
