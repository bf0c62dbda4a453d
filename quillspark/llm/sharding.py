"""Sharding by rendezvous hashing (native).

Every shard gets a score from a hash of the record's key and the shard's number, and
the record goes to the best score. A record's shard depends on nothing but its key and
the weights, so a new shard only takes records into itself: about ``1/(n+1)`` of them
move, none between old shards.

Null keys hash like any other value (all go to one shard); an empty table gives an
empty result; repeated rows share a shard and get different slots. Keys and texts of any length
count whole. Columns other than key and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import durable, expanded

#: Different rows that are numbered under one part number on average, and the fewest parts of a shard.
PART_ROWS, LEAST_PARTS = 65_536, 256


def rendezvous_shard(keys: Sequence[Column], weights: Sequence[float]) -> Column:
    """The shard of a record: an int column from 0, for shards of the given weights.

    A shard's cost is -ln(u)/weight with u uniform in (0, 1) from xxHash64 of (key, shard);
    the least cost wins, the smaller number on a tie. Weights of zero get nothing.
    """
    if not weights or any(w < 0 for w in weights) or not any(weights):
        raise ValueError("weights must be non-negative and not all zero")
    record = F.xxhash64(*keys)
    live = [i for i, w in enumerate(weights) if w > 0]

    def cost(shard: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(record, shard), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        c = -F.log(u)
        if len({weights[i] for i in live}) > 1:
            c = c / F.element_at(F.array(*[F.lit(float(w)) for w in weights]), shard + 1)
        return F.struct(c.alias("cost"), shard.alias("shard"))

    return F.array_min(F.transform(F.array(*[F.lit(i) for i in live]), cost))["shard"]


def number_slots(df: DataFrame, shard: str, slot: str = "slot") -> DataFrame:
    """Number the rows of each shard without gaps from 0.

    All columns of ``df`` together form the order, so the numbering depends on content and the
    number of rows alone; columns must be groupable. Equal rows are counted before the shuffle,
    which keeps a key that holds a third of all rows from reaching one task; they are made again
    in runs that are spread over tasks. A shard's numbering is split into parts, whose number
    follows that of the rows.
    """
    columns = df.columns
    fresh = [c for c in ("_part", "_n", "_hash", "_before", "_offset", "_at", "e_run") if c in columns]
    if fresh or slot in columns:
        raise ValueError(f"columns {fresh or [slot]} are taken")
    order = F.xxhash64(*[F.col(c) for c in columns])
    counted = durable(df.withColumn("_hash", order).groupBy(*columns, "_hash").agg(F.count(F.lit(1)).alias("_n")))
    size = counted.count()
    counted = counted.withColumn("_part", F.pmod("_hash", F.lit(max(LEAST_PARTS, -(-size // PART_ROWS)))))
    parts = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counted.groupBy(shard, "_part")
        .agg(F.sum("_n").alias("_n"))
        .select(F.col(shard).alias("_shard"), F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(parts), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy(shard, "_part").orderBy("_hash", *columns).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col(shard).eqNullSafe(F.col("_shard")) & (F.col("_part") == F.col("_of"))
    numbered = counted.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(offsets, same)
    rows = expanded(numbered, "_n", "_at", [shard, "_hash"])
    return rows.select(*columns, (F.col("_offset") + F.col("_before") + F.col("_at")).alias(slot))


def shard_documents(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shards of equal weight by document key, with sizes and gapless slots.

    Null texts count as empty. ``grown_shard`` is the shard under ``shards + 1``. Other
    columns are left behind: join on the key to bring them along.
    """
    key, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    placed = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        rendezvous_shard([key], [1.0] * shards).alias("shard"),
        rendezvous_shard([key], [1.0] * (shards + 1)).alias("grown_shard"),
    )
    return number_slots(placed, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
