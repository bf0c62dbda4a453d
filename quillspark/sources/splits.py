"""Records of text files of any size, read split by split.

Spark's text source deals a file out over tasks by its offsets. Each task puts the lines of its
split together: whole records go out at once, numbered within the split; the lines before the first
record, and the last record, which the next split may go on with, are fragments. Only fragments and
counts are shuffled: fragments are stitched in the order of their offsets and split again, and the
counts give each split its first number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions.durable import written
from quillspark.functions.shipping import ship_package
from quillspark.operators.records import LEAST, blocks_of

#: A record's first line; one that may be, if a word follows in the next lines; and a line of white space.
FIRST, MAYBE = re.compile(r"\d+\.\s+\w"), re.compile(r"\d+\.\s*\Z")
#: What a split gives: lines before its first record, records, and its last record.
HEAD, WHOLE, TAIL = 0, 1, 2
#: Most splits whose first numbers are broadcast.
MOST_BROADCAST = 1_000_000
SCHEMA = "file_id string, split long, kind int, seq int, block string"


class Assembler:
    """Puts the lines of one split together."""

    def __init__(self, least: int = LEAST) -> None:
        self.least, self.lines, self.doubtful, self.kind, self.seq = least, [], [], HEAD, 0

    def add(self, line: str) -> Iterator[tuple[int, int, str | None]]:
        """(kind, seq, text) of what a line completes."""
        if self.doubtful and line.strip():  # a number stood alone: it begins a record if a word follows
            begins, held = bool(re.match(r"\s*\w", line)), self.doubtful
            self.doubtful = []
            if begins:
                yield from self.close()
            self.lines += held
        if self.doubtful:
            self.doubtful.append(line)
        elif FIRST.match(line):
            yield from self.close()
            self.lines.append(line)
        elif MAYBE.match(line):
            self.doubtful.append(line)
        else:
            self.lines.append(line)

    def close(self) -> Iterator[tuple[int, int, str | None]]:
        """A record begins: what came before is complete, but for the lines that the split began with."""
        if self.kind == HEAD:
            yield HEAD, 0, "\n".join(self.lines) if self.lines else None
        else:
            block = "\n".join(self.lines).strip()
            if len(block) > self.least:
                self.seq += 1
                yield WHOLE, self.seq, block
        self.lines, self.kind = [], TAIL

    def end(self) -> Iterator[tuple[int, int, str | None]]:
        yield self.kind, self.seq + 1, "\n".join(self.lines + self.doubtful)


def assembled(lines: DataFrame, least: int) -> DataFrame:
    """SCHEMA from lines (file_id, split, value) in the order of their splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, maker, out = None, Assembler(least), []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string()), strict=True)], names=["file_id", "split", "kind", "seq", "block"])

        for read in batches:
            size = 0
            for file_id, split, line in zip(*(c.to_pylist() for c in read.columns), strict=True):
                if (file_id, split) != key:
                    if key is not None:
                        out.extend((*key, *made) for made in maker.end())
                    key, maker = (file_id, split), Assembler(least)
                for made in maker.add(line):
                    out.append((*key, *made))
                    size += len(made[2] or "")
                if size > 4 << 20:
                    yield batch()
                    size = 0
            if out:
                yield batch()
        if key is not None:
            out.extend((*key, *made) for made in maker.end())
            yield batch()

    ship_package(lines.sparkSession)
    return lines.select("file_id", "split", "value").mapInArrow(run, SCHEMA)


def stitched(parts: DataFrame, least: int) -> DataFrame:
    """file_id, split, seq, block of the records that fragments make: a last record, and all that follows it up to the next one."""
    narrow = parts.filter(F.col("kind") != WHOLE).select("file_id", "split", "kind", "seq")
    so_far = Window.partitionBy("file_id").orderBy("split", "kind").rowsBetween(Window.unboundedPreceding, 0)
    # narrow rows, two for a split: the text follows by its place
    placed = narrow.withColumn("owner", F.coalesce(F.max(F.when(F.col("kind") == TAIL, F.struct("split", "seq"))).over(so_far), F.struct(F.lit(-1).cast("long").alias("split"), F.lit(1).alias("seq"))))
    texts = parts.filter(F.col("kind") != WHOLE).select("file_id", "split", "kind", "block").join(placed.select("file_id", "split", "kind", "owner"), ["file_id", "split", "kind"])
    joined = texts.groupBy("file_id", "owner").agg(F.array_sort(F.collect_list(F.struct("split", "kind", "block"))).alias("xs"))
    # array_join leaves out null: a split that begins with a record has no lines in front of it
    lines = F.transform("xs", lambda x: x["block"])
    made = joined.select("file_id", "owner", F.posexplode(blocks_of(F.array_join(lines, "\n"), least)).alias("i", "block"))
    return made.select("file_id", F.col("owner.split").alias("split"), (F.col("owner.seq") + F.col("i")).alias("seq"), "block")


def read_records(spark: SparkSession, path: str, least: int = LEAST) -> DataFrame:
    """file_id (path), abstract_index (from 1 in each file), block of UTF-8 text files, whatever their size. Line ends may be of any kind.

    What the splits give is written once: a second scan might cut the files elsewhere.
    """
    lines = spark.read.text(path).select(F.input_file_name().alias("file_id"), F.col("_metadata.file_block_start").alias("split"), "value")
    parts = written(assembled(lines, least))
    rest = written(stitched(parts, least))
    found = parts.filter(F.col("kind") == WHOLE).select("file_id", "split", "seq", "block").unionByName(rest)
    counts = parts.filter(F.col("kind") == WHOLE).groupBy("file_id", "split").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.unionByName(rest.groupBy("file_id", "split").agg(F.count(F.lit(1)).alias("n"))).groupBy("file_id", "split").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("file_id").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    # splits that begin a file need no offset
    offsets = written(counts.withColumn("before", F.sum("n").over(before)).filter("before IS NOT NULL").select("file_id", "split", "before"))
    few = offsets.count() <= MOST_BROADCAST
    numbered = found.join(F.broadcast(offsets) if few else offsets, ["file_id", "split"], "left")
    return numbered.select("file_id", (F.coalesce("before", F.lit(0)) + F.col("seq")).cast("int").alias("abstract_index"), "block")
