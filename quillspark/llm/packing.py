"""Packed token-id matrices by best-fit-decreasing with a segment tree.

Documents become ids with an end mark each; ones longer than a row are split into pieces
without loss. Pieces are packed into rows of fixed length, longest first, each into the row
with the least room that still takes it. A segment tree over room sizes finds that row in
logarithmic time. Every row comes with its ids padded to the full length, the cumulative
lengths of its segments, the document and piece of each segment, and positions that start
anew in every segment.

Documents are dealt into groups by a hash of id and text, the groups' number following the
number of rows; a group is packed in windows of at most WINDOW_TOKENS ids, which bounds the
memory of a task whatever the group holds. Packing is a function of content and row count
alone: neither files nor partitions matter, except which of many equal rows share a group (rows
that repeat more often than a group is long are dealt among several groups).

Ids may be of any type; null ids are kept. Null and empty texts give a single end mark. Texts of
any length are packed whole. Repeated rows are packed repeatedly. Documents of equal length are
placed in the order of their hash. Columns other than id and text are not looked at. An empty
table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.bpe import PRETOKEN
from quillspark.llm.common import MOST_HOT, rebatched, ship_package

#: Documents of a group on average, and the most ids that are packed together.
GROUP_ROWS = 1024
WINDOW_TOKENS = 4 << 20
#: Partitions follow the number of groups up to here; beyond, a partition holds several groups, one after the other.
MOST_PARTITIONS = 50_000
#: The columns of the packed matrix, for the ids' type.
MATRIX_SCHEMA = "grp long, window int, row int, ids binary, n_tokens int, cu_seqlens array<int>, positions binary, doc_ids array<{}>, pieces array<int>"


class RoomTree:
    """Which room sizes 0 to ``size`` are open, and the stack of rows of each."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.leaves
        while at and not self.any[at]:
            self.any[at] = 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least room of at least ``need``, and that room."""
        at = need + self.leaves
        if need >= self.leaves:
            return None
        while not self.any[at]:  # up until something lies to the right
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.leaves:  # down to the leftmost
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        room = at - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.any[at] = 0
            at >>= 1
            while at:
                self.any[at] = self.any[2 * at] | self.any[2 * at + 1]
                if self.any[at]:
                    break
                at >>= 1
        return row, room


def best_fit_decreasing(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Rows of indices into ``lengths``, none over ``size`` in total."""
    tree, rows = RoomTree(size), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = tree.take(need)
        if found is None:
            row, room = len(rows), size
            rows.append([i])
        else:
            row, room = found
            rows[row].append(i)
        if room > need:
            tree.put(room - need, row)
    return rows


def pieces_of(n: int, size: int) -> list[tuple[int, int]]:
    """Start and end of the pieces of n ids: full rows, then the rest."""
    return [(a, min(a + size, n)) for a in range(0, n, size)]


def pack_matrix(docs: list[tuple[Any, np.ndarray]], size: int, pad: int) -> Iterator[tuple]:
    """ids, n_tokens, cu_seqlens, positions, doc_ids, pieces of each packed row."""
    spans = [(d, k, a, b) for d, (_, ids) in enumerate(docs) for k, (a, b) in enumerate(pieces_of(len(ids), size))]
    lengths = np.array([b - a for _, _, a, b in spans], dtype=np.int64)
    for members in best_fit_decreasing(lengths, size):
        row, positions = np.full(size, pad, dtype="<u4"), np.zeros(size, dtype="<u4")
        ends = [0]
        for i in members:
            d, _, a, b = spans[i]
            start, end = ends[-1], ends[-1] + b - a
            row[start:end] = docs[d][1][a:b]
            positions[start:end] = np.arange(b - a, dtype=np.uint32)
            ends.append(end)
        yield row.tobytes(), ends[-1], ends, positions.tobytes(), [docs[spans[i][0]][0] for i in members], [spans[i][1] for i in members]


@lru_cache(maxsize=2)
def tokenizer_of(ranks: bytes) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines())
    return tiktoken.Encoding("packing", pat_str=PRETOKEN, mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs}, special_tokens={})


def spread_copies(docs: DataFrame, total: int, id_col: str, text_col: str) -> DataFrame:
    """id, text and key (a hash that names a row's group), with several keys for rows that repeat very often.

    At most MOST_HOT rows stand out so, and only these are broadcast.
    """
    bound = max(GROUP_ROWS, -(-total // MOST_HOT))
    key = F.xxhash64(id_col, text_col).alias("key")
    hot = docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bound).select("key", F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("keys"))
    rows = docs.select(F.col(id_col).alias("doc_id"), key, F.col(text_col).cast("string").alias("text")).join(F.broadcast(hot), "key", "left")
    salt = F.pmod(F.monotonically_increasing_id(), F.col("keys"))
    return rows.select("doc_id", F.when(F.col("keys").isNull(), F.col("key")).otherwise(F.xxhash64("key", salt)).alias("key"), "text")


def tokenized(docs: DataFrame, vocabulary: str, end: int) -> DataFrame:
    """doc_id, key, ids (little-endian unsigned 32-bit, with the end mark) of every whole text; strings of special tokens are ordinary text."""
    with open(vocabulary, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    mark = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer_of(ranks.value).encode_to_numpy
        for batch in rebatched(batches, 2):
            ids = [encode(x.as_py() or "", disallowed_special=()).astype("<u4", copy=False).tobytes() + mark for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["doc_id", "key", "ids"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, key long, ids binary")


def packed_rows(docs: DataFrame, vocabulary: str, size: int = 2048, end: int = 50256, pad: int = 50256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed matrix (MATRIX_SCHEMA, doc_ids of the ids' type): one row for each row of ``size`` ids. ``vocabulary``: a ``tiktoken`` rank file."""
    ship_package(docs.sparkSession)
    total = docs.count()
    groups = max(1, -(-total // GROUP_ROWS))
    dealt = tokenized(spread_copies(docs, total, id_col, text_col), vocabulary, end).withColumn("grp", F.pmod("key", F.lit(groups)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[Any, np.ndarray]] = []
        kind: pa.DataType = pa.null()
        group, window, tokens = None, 0, 0
        for batch in batches:
            kind = batch.column(1).type
            for g, doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if held and (g != group or tokens >= WINDOW_TOKENS):
                    yield from matrix_batches(group, window, held, kind)
                    window, held, tokens = (window + 1 if g == group else 0), [], 0
                group = g
                held.append((doc_id, np.frombuffer(ids.as_buffer(), dtype="<u4").copy()))
                tokens += len(held[-1][1])
        if held:
            yield from matrix_batches(group, window, held, kind)

    def matrix_batches(group: int, window: int, held: list, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for i, packed in enumerate(pack_matrix(held, size, pad)):
            rows.append((group, window, i, *packed))
            if len(rows) == 128:
                yield matrix_batch(rows, kind)
                rows = []
        if rows:
            yield matrix_batch(rows, kind)

    sorted_in = dealt.select("grp", "doc_id", "ids", "key").repartition(min(groups, MOST_PARTITIONS), "grp").sortWithinPartitions("grp", "key", "doc_id", "ids")
    return sorted_in.select("grp", "doc_id", "ids").mapInArrow(run, MATRIX_SCHEMA.format(dict(dealt.dtypes)["doc_id"]))


def matrix_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = {
        "grp": pa.int64(), "window": pa.int32(), "row": pa.int32(), "ids": pa.binary(), "n_tokens": pa.int32(), "cu_seqlens": pa.list_(pa.int32()),
        "positions": pa.binary(), "doc_ids": pa.list_(kind), "pieces": pa.list_(pa.int32()),
    }
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))


def write_matrix(packed: DataFrame, path: str) -> None:
    """Write the matrix as Parquet files of fixed-width rows, sorted by group, window and row within a file."""
    packed.sortWithinPartitions("grp", "window", "row").write.mode("overwrite").parquet(path)
