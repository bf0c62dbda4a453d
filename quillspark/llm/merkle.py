"""Merkle manifest of a table: a subtree for each language, a root over the subroots, and a proof for every row.

H is the lowercase hex SHA-256 of its concatenated inputs. A leaf is H of a row's fields, each ``-``
if null, else its length in UTF-8 bytes, ``:`` and its value. Nodes of a language are hashed in
pairs, level by level; a last node without a partner is hashed alone.

Rows are numbered within their language by one distributed sort. Blocks of ``BLOCK`` consecutive
leaves are reduced in tasks of their own, which also gives every leaf its siblings inside the block.
While more than ``TOP`` nodes are left, they are reduced in blocks again, so the driver never gets
more than that: it builds the top of the tree, and each block's path from there to the root is
broadcast. Executors then finish each row's proof and fold its leaf, tampered with or not, up to
the root. With more than ``TOP`` languages the subroots are numbered and reduced like leaves.

Only ids and digests are shuffled, texts never. Rows without a language are a group of their own, in
front of all others. Rows without an id come first in their language; equal ids are ordered by their
leaves' digests, so repeated rows, which have equal leaves, stand side by side. Null and empty texts
differ in their leaves. Very long texts are hashed whole, in place. Columns beyond the five are not
looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructField, StructType

from quillspark.llm.common import even_join, ship_package, written
from quillspark.operators.review import number_rows

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of the tree that one task reduces at a time, and the nodes of a block.
LEVELS = 10
BLOCK = 1 << LEVELS
#: Most nodes that the driver builds the top from, and whose paths are broadcast.
TOP = 1 << 14


def encoded(value: Column) -> Column:
    """A field of a leaf."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, values)).cast("binary"), 256)


def tampered(doc_id: Column) -> Column:
    """Whether 7 divides the unsigned CRC-32 of an id (none: of an empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 0


def group_key(lang: Column) -> Column:
    """The language as a text that is never null; the null one sorts first."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """pos (from 0) and size beside the nodes of each group ``g``, in an order."""
    placed = number_rows(nodes, "g", *order, name="at")
    groups = placed.groupBy("g").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    joined = even_join(placed, groups, ["g"], "size", nodes.count(), F.col("at"))
    return joined.withColumn("pos", F.col("at") - F.col("first")).drop("at", "first")


def levels_of(nodes: list[bytes], most: int) -> list[list[bytes]]:
    """The levels of a tree over hex digests, ``most`` above the nodes themselves."""
    levels = [nodes]
    for _ in range(most):
        below = levels[-1]
        levels.append([sha256(b"".join(below[i : i + 2])).hexdigest().encode() for i in range(0, len(below), 2)])
    return levels


def sibling_path(levels: list[list[bytes]], at: int) -> list[bytes]:
    """The siblings of a node from its level up to the top: L or R for their side and their digest, or nothing where there is none."""
    path = []
    for nodes in levels[:-1]:
        other = at ^ 1
        path.append((b"LR"[other > at :][:1] + nodes[other]) if other < len(nodes) else b"")
        at >>= 1
    return path


def rise(size: int) -> int:
    """Levels above ``size`` nodes."""
    return max(0, (size - 1).bit_length())


def blocks_reduced(nodes: DataFrame) -> DataFrame:
    """path (siblings inside the block) beside nodes (g, pos, size, digest and others), and in the first row of each block its top."""
    schema = StructType([*nodes.schema.fields, StructField("path", ArrayType(BinaryType())), StructField("top", BinaryType())])
    g, pos, size, own = (nodes.columns.index(c) for c in ("g", "pos", "size", "digest"))

    def reduced(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        block = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        levels = levels_of(block.column(own).to_pylist(), min(LEVELS, rise(block.column(size)[0].as_py())))
        paths = pa.array([sibling_path(levels, i) for i in range(block.num_rows)], pa.list_(pa.binary()))
        tops = pa.array([levels[-1][0], *[None] * (block.num_rows - 1)], pa.binary())
        return pa.RecordBatch.from_arrays([*block.columns, paths, tops], names=[*block.schema.names, "path", "top"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            keys = list(zip(batch.column(g).to_pylist(), [p >> LEVELS for p in batch.column(pos).to_pylist()], strict=True))
            start = 0
            for i, k in enumerate([*keys, None]):
                if i == len(keys) or k != key:
                    if i > start:
                        rows.append(batch.slice(start, i - start))
                    if i < len(keys):
                        if rows:
                            yield reduced(rows)
                        key, rows, start = k, [], i
        if rows:
            yield reduced(rows)

    block = F.shiftright("pos", LEVELS)
    return nodes.repartition("g", block).sortWithinPartitions("g", "pos").mapInArrow(run, schema)


def suffixes(nodes: DataFrame, tops: int) -> DataFrame:
    """g, pos, subroot, root and path (siblings up to the root) of the nodes (g, pos, size, digest). ``tops``: how many there are."""
    spark = nodes.sparkSession
    schema = "g string, pos long, subroot string, root string, path array<binary>"
    if tops <= TOP:
        return spark.createDataFrame(built_top(nodes.select("g", "pos", "digest").orderBy("g", "pos").collect()), schema)
    if nodes.filter("size > 1").isEmpty():  # too many languages: their subroots become the leaves of one group
        alone = numbered(nodes.select(F.lit("").alias("g"), F.col("g").alias("lang_key"), "digest"), "lang_key").select("g", "pos", "size", "digest", "lang_key")
        above = suffixes_of_blocks(alone)
        return above.select(F.col("lang_key").alias("g"), F.lit(0).cast("long").alias("pos"), F.col("digest").cast("string").alias("subroot"), "root", "path")
    return suffixes_of_blocks(nodes).select("g", "pos", "subroot", "root", "path")


def suffixes_of_blocks(nodes: DataFrame) -> DataFrame:
    """subroot, root and the whole path beside nodes, by way of their blocks."""
    ship_package(nodes.sparkSession)
    done = written(blocks_reduced(nodes))
    parents = done.filter("top IS NOT NULL").select("g", F.shiftright("pos", LEVELS).alias("pos"), F.ceil(F.col("size") / BLOCK).alias("size"), F.col("top").alias("digest"))
    tops = parents.count()
    above = suffixes(parents, tops).select("g", F.col("pos").alias("block"), "subroot", "root", F.col("path").alias("above"))
    joined = done.withColumn("block", F.shiftright("pos", LEVELS)).join(F.broadcast(above) if tops <= TOP else above, ["g", "block"])
    return joined.withColumn("path", F.concat("path", "above")).drop("above", "block", "top")


def built_top(rows: list) -> list[tuple]:
    """The top of the tree over at most TOP nodes, sorted by group and place."""
    groups: dict[str, list[bytes]] = {}
    for r in rows:
        groups.setdefault(r.g, []).append(bytes(r.digest))
    trees = {g: levels_of(nodes, rise(len(nodes))) for g, nodes in groups.items()}
    # names of groups sort by their UTF-8 bytes here as in Spark
    names = sorted(trees, key=lambda g: g.encode())
    over = levels_of([trees[g][-1][0] for g in names], rise(len(names)))
    out = []
    for n, g in enumerate(names):
        up = sibling_path(over, n)
        out += [(g, i, trees[g][-1][0].decode(), over[-1][0].decode(), sibling_path(trees[g], i) + up) for i in range(len(groups[g]))]
    return out


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""

    def step(acc: Column, sibling: Column) -> Column:
        other = F.substring(sibling, 2, 64)
        pair = F.when(sibling.startswith("L"), F.concat(other, acc)).when(sibling.startswith("R"), F.concat(acc, other)).otherwise(acc)
        return F.sha2(pair.cast("binary"), 256)

    return F.aggregate(path, leaf, step)


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row."""
    doc_id, source, lang, n_chars, text = (F.col(c) for c in FIELDS)
    original = leaf_of(doc_id, source, lang, n_chars, text)
    changed = F.when(tampered(doc_id) & n_chars.isNotNull(), leaf_of(doc_id, source, lang, n_chars.cast("decimal(20,0)") + 1, text))
    leaves = docs.select(
        group_key(lang).alias("g"), doc_id.alias("doc_id"), original.cast("binary").alias("digest"), changed.alias("changed"), F.monotonically_increasing_id().alias("row")
    )
    # the row number lets a sort cut a crowd of equal rows
    proved = suffixes_of_blocks(numbered(written(leaves), "doc_id", "digest", "row").drop("row"))
    leaf, path = F.col("digest").cast("string"), F.transform("path", lambda x: x.cast("string"))
    siblings = F.array_join(F.transform("path", lambda x: F.substring(x.cast("string"), 2, 64)), "")
    found = proved.select(
        "doc_id", leaf.alias("leaf"), "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        folded(F.coalesce("changed", leaf), path).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
