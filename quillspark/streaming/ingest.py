"""Incremental mining: new abstract files as a stream through the same plan as in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspark.functions.dictionaries import Dictionaries, Lists
from quillspark.functions.durable import exists
from quillspark.functions.evidence import combined
from quillspark.operators import normalize
from quillspark.operators.pairs import mine_pairs, with_mentions
from quillspark.operators.records import split_records, with_metadata


def mine_files(files: DataFrame, lists: Lists = Dictionaries()) -> DataFrame:
    """Pairs from file_id, content rows."""
    return mine_pairs(with_mentions(with_metadata(split_records(files)), lists))


def start_ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, **options: str) -> StreamingQuery:
    """Mine each batch of new text files in ``folder`` once and append the pairs to ``out``.

    Batches are written under their number, so a batch that is run again replaces its own rows.
    """
    stream = spark.readStream.format("text").option("wholetext", "true").options(**options).load(folder)
    files = stream.select(F.col("_metadata.file_path").alias("file_id"), F.col("value").alias("content"))

    def write(batch: DataFrame, number: int) -> None:
        mine_files(batch).write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_batch(batch: DataFrame, number: int, out: str) -> None:
    """Add a batch of pairs (idx and the columns of a reviewed table) to the groups kept at ``out``.

    Pairs that an earlier batch has brought (by idx) count once. What a batch adds stands under its number, so one that is run again
    replaces itself.
    """
    spark = batch.sparkSession
    once = batch.dropDuplicates(["idx"])
    if exists(spark, f"{out}/ids"):
        known = spark.read.schema("idx long, batch long").parquet(f"{out}/ids").filter(F.col("batch") != number)
        once = once.join(known.select("idx"), "idx", "left_anti")
    # read back: what counts as new must not change between the two tables
    once.write.mode("overwrite").parquet(f"{out}/pairs/batch={number}")
    fresh = spark.read.schema(once.schema).parquet(f"{out}/pairs/batch={number}")
    normalize.group_evidence(normalize.normalized(normalize.kept_pairs(fresh))).write.mode("overwrite").parquet(f"{out}/evidence/batch={number}")
    fresh.select("idx").write.mode("overwrite").parquet(f"{out}/ids/batch={number}")


def start_merging(pairs: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Keep merged groups up to date from a stream of pairs: each batch adds the distinct values of its own rows, so the work follows what is new."""
    place = out.rstrip("/")
    return pairs.writeStream.foreachBatch(lambda batch, number: merge_batch(batch, number, place)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_groups(spark: SparkSession, out: str) -> DataFrame:
    """The merged groups of all batches so far, as normalize.merge_pairs gives them for all pairs at once."""
    return normalize.merged_groups(combined(spark.read.parquet(f"{out.rstrip('/')}/evidence"), normalize.GROUP))
