"""Mixing sources to target weights by Pfair scheduling (native).

Each source is a periodic task whose share of the slots is its weight. Its i-th block (from 0)
is released at slot floor(i/w) and due by slot ceil((i+1)/w); every slot goes to the released
block with the earliest deadline. Shares that add up to one are always schedulable this way, so
after any number of slots a source has had its exact share to within less than one block.

Releases and deadlines are computed from the weights as they are, in whole numbers, so the bound
holds at every size and for any number of sources. A block has ``block`` rows, or more where
that would make more than MOST_BLOCKS blocks: the schedule (one number for each block) has a
size that does not grow with the table. It is worked out with one block of each source in a heap
and read back from a file in the shared folder; rows meet it in a join. The rows of a source are
numbered without gaps by hash order in parts, whose number follows that of the rows.

Sources that run out early leave their slots empty: the others keep their order and proportions
and everything is kept exactly once. Sources without a weight and null sources come after all
weighted rows, in hash order. Equal rows (in all columns) are counted before they are sent and
made again afterwards, each with a place of its own, in runs that are spread over tasks; so a row
that makes up a third of the table crowds no task. Null ids, null and empty texts are values like
any other; texts of any length are kept whole. An empty table gives an empty result; other
columns are kept, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import durable, expanded, new_path

#: Most blocks of a schedule, apart from one more for each source.
MOST_BLOCKS = 1 << 20
#: Different rows that are numbered under one part number on average, and the fewest parts of a source.
PART_ROWS, LEAST_PARTS = 65_536, 1024
#: From this slot on (no real table gets there) blocks only keep their order.
LAST = 1 << 62
#: Bytes of the schedule that are handed to the file system at once.
PIECE = 1 << 20


def block_slots(weights: Mapping[str, float], blocks: Mapping[str, int]) -> Iterator[tuple[str, int, int]]:
    """source, nth, slot of every block, by slot: the released block with the earliest deadline, then the source that comes first by name."""
    live = {s: Fraction(w) for s, w in weights.items() if w > 0}
    scale = math.lcm(*(w.denominator for w in live.values()))
    share = {s: int(w * scale) for s, w in live.items()}
    total = sum(share.values())
    waiting = [(0, s, 0) for s in live if blocks.get(s, 0) > 0]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, min(waiting[0][0], LAST))
        while waiting and (waiting[0][0] <= slot or not ready):
            _, s, n = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(n + 1) * total // share[s]), s, n))
        _, s, n = heapq.heappop(ready)
        yield s, n, slot
        slot += 1
        if n + 1 < blocks[s]:
            heapq.heappush(waiting, ((n + 1) * total // share[s], s, n + 1))


def slot_table(spark: SparkSession, weights: Mapping[str, float], blocks: Mapping[str, int]) -> DataFrame:
    """source, nth, slot of every block, read from a file of one line for each source."""
    slots: dict[str, list[int]] = {}
    for source, _, slot in block_slots(weights, blocks):
        slots.setdefault(source, []).append(slot)
    text = "".join(json.dumps({"source": s, "slots": x}) + "\n" for s, x in slots.items()).encode()
    path = f"{new_path(spark, 'schedule')}/slots.json"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(jvm_path)
    for at in range(0, len(text), PIECE):
        out.write(bytearray(text[at : at + PIECE]))
    out.close()
    return spark.read.schema("source string, slots array<long>").json(path).select("source", F.posexplode("slots").alias("nth", "slot"))


def row_values(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Columns whose hash tells rows apart: hashes skip nulls, and know no maps."""
    simple = lambda c: not dict(df.dtypes)[c].startswith(("map", "array", "struct", "variant"))
    value = lambda c: F.col(c) if simple(c) else F.to_json(F.struct(c), {"ignoreNullFields": "false"})
    return [x for c in columns for x in (value(c), F.col(c).isNull())]


def _placed(docs: DataFrame, weights: Mapping[str, float], block: int, source_col: str, key_cols: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """Rows under names of their own (no name can clash inside) with slot and place, and those names by column."""
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(c).alias(a) for c, a in own.items()])
    values = row_values(renamed, list(own.values()))
    marked = renamed.select(
        "*", F.col(own[source_col]).cast("string").alias("m_source"), F.xxhash64(*[own[c] for c in key_cols]).alias("m_key"),
        F.xxhash64(*values).alias("m_row"), F.xxhash64(F.lit(1), *values).alias("m_proof"),
    )
    keyed = durable(marked.groupBy("m_source", "m_key", "m_row", "m_proof").agg(F.count(F.lit(1)).alias("copies")))
    counts = keyed.groupBy("m_source").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("different")).collect()  # a small row for each source
    size = max(block, -(-sum(r.n for r in counts) // MOST_BLOCKS))
    blocks = {r.m_source: -(-r.n // size) for r in counts if r.m_source is not None and weights.get(r.m_source, 0) > 0}
    keyed = keyed.withColumn("part", F.pmod("m_key", F.lit(max(LEAST_PARTS, -(-sum(r.different for r in counts) // PART_ROWS)))))
    before = Window.partitionBy("o_source").orderBy("o_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = keyed.groupBy(F.col("m_source").alias("o_source"), F.col("part").alias("o_part")).agg(F.sum("copies").alias("size"))
    offsets = sizes.select("o_source", "o_part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    running = Window.partitionBy("m_source", "part").orderBy("m_key", "m_row", "m_proof").rowsBetween(Window.unboundedPreceding, -1)
    ahead = keyed.withColumn("ahead", F.coalesce(F.sum("copies").over(running), F.lit(0)))
    numbered = ahead.join(offsets, F.col("m_source").eqNullSafe(F.col("o_source")) & (F.col("part") == F.col("o_part")))
    first = numbered.select(F.col("m_row").alias("p_row"), F.col("m_proof").alias("p_proof"), (F.col("offset") + F.col("ahead")).alias("p_first"))
    # equal rows fall together before they are sent; what is left meets its number, and is made again
    once = marked.groupBy("m_row", "m_proof").agg(*[F.first(c).alias(c) for c in (*own.values(), "m_source")], F.count(F.lit(1)).alias("copies"))
    joined = once.join(first, (F.col("m_row") == F.col("p_row")) & (F.col("m_proof") == F.col("p_proof")))
    rows = expanded(joined, "copies", "p_at", ["m_row"]).withColumn("p_place", F.col("p_first") + F.col("p_at"))
    rows = rows.withColumn("p_nth", F.expr(f"p_place div {size}"))
    if not blocks:
        return rows.withColumn("p_slot", F.lit(None).cast("long")), own
    slots = slot_table(docs.sparkSession, weights, blocks).select(F.col("source").alias("s_source"), F.col("nth").cast("long").alias("s_nth"), F.col("slot").alias("p_slot"))
    slots = F.broadcast(slots) if sum(blocks.values()) <= 2 * MOST_BLOCKS else slots
    return rows.join(slots, (F.col("m_source") == F.col("s_source")) & (F.col("p_nth") == F.col("s_nth")), "left"), own


def mixed_places(
    docs: DataFrame, weights: Mapping[str, float], block: int = 64, source_col: str = "source", key_cols: Sequence[str] = ("doc_id", "text")
) -> DataFrame:
    """The columns of ``docs`` with _slot (of its source's block; null without a weight) and _place (the row's number in its source, which orders a slot).

    The hash of ``key_cols`` gives each source an order that is random and independent of files. Columns of ``docs`` named
    _slot or _place give way.
    """
    placed, own = _placed(docs, weights, block, source_col, key_cols)
    return placed.select(*[F.col(a).alias(c) for c, a in own.items() if c not in ("_slot", "_place")], F.col("p_slot").alias("_slot"), F.col("p_place").alias("_place"))


def mix(docs: DataFrame, weights: Mapping[str, float], block: int = 64, source_col: str = "source", key_cols: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """``docs`` in mixed order: sorted over the whole table by slot and place, weighted rows first."""
    placed, own = _placed(docs, weights, block, source_col, key_cols)
    return placed.orderBy(F.col("p_slot").asc_nulls_last(), "p_place").select(*[F.col(a).alias(c) for c, a in own.items()])


def measured_weights(docs: DataFrame, power: float = 0.7, source_col: str = "source") -> dict[str, float]:
    """Target weights by temperature: each source's size to ``power``. One small row per source comes to the driver."""
    sizes = docs.filter(F.col(source_col).isNotNull()).groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return {r.source: float(r.n) ** power for r in sizes.orderBy(F.desc("n"), "source").collect()}
