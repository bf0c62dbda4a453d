"""Shared helpers: reading tables, bounded Arrow batches, joins and expansions that hold when one key has a third of all rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.durable import durable, new_path, shared_folder, written
from quillspark.functions.shipping import ship_package

__all__ = ["durable", "even_join", "expanded", "hot_bound", "new_path", "rebatched", "shared_folder", "ship_package", "table", "utf8_texts", "written"]

#: Upper bounds of what a Python worker handles at once.
BATCH_ROWS = 256
BATCH_BYTES = 8 << 20
#: A key with more rows than this, and with more than one in MOST_HOT of all rows, is spread over several tasks.
UNIT = 4096
MOST_HOT = 1024
#: Copies of one row that a task makes at a stretch.
RUN = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without a round trip through ``str``."""
    return column.cast(pa.large_binary()).to_pylist()


def rebatched(batches: Iterator[pa.RecordBatch], column: int, most: int = BATCH_BYTES, rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches sliced to at most ``rows`` rows whose values of a column add up to at most ``most`` bytes, or to one value."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if i > start and (total + size > most or i - start == rows):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def hot_bound(total: int) -> int:
    """The most rows of one key, of ``total`` rows, that a single task may get."""
    return max(UNIT, -(-total // MOST_HOT))


def even_join(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: str, total: int, spread: Column, how: str = "inner", grows: bool = False) -> DataFrame:
    """``left`` joined with ``right`` (one row for each key) such that no task gets a whole hot key.

    ``rows`` is the column of ``right`` that says how many rows of ``left`` have the key, ``total`` the number of rows of ``left``
    (an upper bound will do). Keys of many rows get several salts; they are at most MOST_HOT and are broadcast to tell rows of
    ``left`` of their salts, which ``spread`` (any integer that differs between rows) deals out. Rows with a null key match nothing
    and are dealt out likewise. ``how``: inner or left. ``grows`` says that ``right`` grows with the input: then both sides are
    sorted and merged at every size, where a small one would be broadcast instead.
    """
    unit = hot_bound(total)
    sized = right.withColumn("e_salts", F.greatest(F.ceil(F.col(rows) / F.lit(unit)), F.lit(1)).cast("int"))
    hot = sized.filter("e_salts > 1").select(*keys, "e_salts")
    lone = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    salts = F.when(lone, MOST_HOT).otherwise(F.coalesce("e_salts", F.lit(1)))
    dealt = left.join(F.broadcast(hot), list(keys), "left").withColumn("e_salt", F.pmod(spread, salts).cast("int")).drop("e_salts")
    copies = sized.withColumn("e_salt", F.explode(F.sequence(F.lit(0), F.col("e_salts") - 1))).drop("e_salts")
    return dealt.join(copies.hint("merge") if grows else copies, [*keys, "e_salt"], how).drop("e_salt")


def expanded(df: DataFrame, copies: str, nth: str, keys: Sequence[str]) -> DataFrame:
    """Each row ``copies`` (a long) times, numbered from 0 in ``nth``. A row that stands for many is first cut into runs, which are spread over tasks by ``keys``."""
    n, zero = F.col(copies), F.lit(0).cast("long")
    few = df.filter(n <= RUN).withColumn(nth, F.explode(F.sequence(zero, n - 1)))
    runs = df.filter(n > RUN).withColumn("e_run", F.explode(F.sequence(zero, n - 1, F.lit(RUN).cast("long")))).repartition(*keys, "e_run")
    many = runs.withColumn(nth, F.explode(F.sequence(F.col("e_run"), F.least(F.col("e_run") + RUN, n) - 1))).drop("e_run")
    return few.unionByName(many)
