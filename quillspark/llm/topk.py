"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights by term (dimension). Candidates are laid out in
blocks, each with a posting list of (row, weight) for every term; for one query at a time each of
its terms scatters weight products along the term's postings into a dense array of scores.
Partition selection takes the best k of a block; blocks are merged by ranking.

Blocks hold so many rows that their vectors fit a bound of bytes. Every query block meets every candidate block once (an equi-join of block rows on the query
block's number, with candidates replicated for each query block; no cross join, nothing on the
driver). Memory is bounded by one block of each.

Weights and scores are exact whole numbers whatever their size. A block of candidates and a query
whose weights could add up beyond a long are multiplied as Python integers, and such scores rank
by their true values; the column ``score`` then holds the nearest long.

Ids are integers; repeated ids stand for separate candidates, except that no row competes for a
query of the same id. A repeated query id is asked once, with its least vector. Ties go to the
smaller id. Vectors that are null, or hold a null or a value that is not finite, take no part;
empty vectors score 0. Vectors may differ in length: missing terms weigh 0. Null ids take no part.
Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import durable, ship_package

#: Most rows of a block: queries share a candidate block's postings, candidates share a score array.
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192
#: Small tables are cut into blocks of at least this many candidates, so that all cores have some.
LEAST_BLOCK = 2048
#: Query vectors are broadcast up to this many bytes; beyond, queries and candidates meet in a shuffle.
BROADCAST_BYTES = 32 << 20
#: A block's vectors take no more than this, unless a single one does: rows of long vectors make small blocks.
BLOCK_BYTES = 64 << 20
MOST_PARTS = 100_000
LONG = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(True))


def integer_weights(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: longs, or Python integers where one might not fit."""
    scaled = np.floor(values * scale)
    if not len(scaled) or np.abs(scaled).max() < 1 << 62:
        return scaled.astype(np.int64)
    # beyond the largest double, x itself is a whole number
    return np.array([int(y) if np.isfinite(y) else int(x) * scale for x, y in zip(values, scaled, strict=True)], dtype=object)


def largest(weights: np.ndarray) -> int:
    """The largest size of a weight."""
    return max((abs(int(x)) for x in (weights.min(), weights.max())), default=0) if len(weights) else 0


class PostingBlock:
    """Posting lists of a block of candidates."""

    def __init__(self, ids: np.ndarray, weights: list[np.ndarray]) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        sizes = np.array([len(weights[i]) for i in order])
        values = np.concatenate([weights[i] for i in order]) if len(order) else np.zeros(0, dtype=np.int64)
        self.largest = largest(values)
        rows = np.repeat(np.arange(len(order)), sizes)
        terms = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        used = np.flatnonzero(values)
        by_term = used[np.argsort(terms[used], kind="stable")]
        names, starts = np.unique(terms[by_term], return_index=True)
        ends = [*starts[1:].tolist(), len(by_term)]
        self.postings = {}
        for term, a, b in zip(names.tolist(), starts.tolist(), ends, strict=True):
            span = by_term[a:b]
            full = b - a == len(order)  # every row has the term: no scattering needed
            self.postings[term] = (slice(None) if full else rows[span], values[span])

    def scores(self, query: np.ndarray) -> np.ndarray:
        """The inner product with every candidate, term at a time: longs where all sums surely fit, else Python integers."""
        exact = sum(abs(int(x)) for x in query) * self.largest > LONG
        out = np.zeros(len(self.ids), dtype=object if exact else np.int64)
        for term in np.flatnonzero(query).tolist():
            if term in self.postings:
                rows, values = self.postings[term]
                out[rows] += int(query[term]) * (values.astype(object) if exact else values)
        return out

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k candidates, ties to smaller ids; the query's own id is left out."""
        scores, own = self.scores(query), self.ids != query_id
        ids, scores = (self.ids, scores) if own.all() else (self.ids[own], scores[own])
        if len(ids) > k:
            if scores.dtype == object:
                chosen = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], i))[:k])  # ids ascend
            else:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                above = np.flatnonzero(scores > least)
                chosen = np.concatenate((above, np.flatnonzero(scores == least)[: k - len(above)]))
            ids, scores = ids[chosen], scores[chosen]
        return ids, scores


def rank_key(score: int) -> tuple[int, bytes | None, int]:
    """side (-1, 0, 1: below, among or above the longs), bytes that order the scores of either outer side, and the nearest long."""
    if -LONG - 1 <= score <= LONG:
        return 0, None, score
    size = abs(score)
    n = (size.bit_length() + 7) // 8
    ordered = n.to_bytes(4, "big") + size.to_bytes(n, "big")
    return (1, ordered, LONG) if score > 0 else (-1, bytes(255 - b for b in ordered), -LONG - 1)


def block_count(rows: int, components: int, most: int) -> int:
    """Blocks of about ``most`` rows at most, and of half of BLOCK_BYTES: rows are dealt by hash, so some blocks get more."""
    return max(1, -(-rows // most), -(-components * 16 // BLOCK_BYTES))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k candidates of the highest integer inner product for each query."""
    spark = vectors.sparkSession
    ship_package(spark)
    own = lambda df: df.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("w")
    )
    # the row number tells equal rows apart, which keeps them from meeting in one block; it is fixed by the checkpoint
    candidates = durable(own(vectors).withColumn("row", F.monotonically_increasing_id()))
    asked = durable(own(queries).groupBy("id").agg(F.min("w").alias("w")))
    n_queries, numbers = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("w") + 2), F.lit(0))).first()
    cores = spark.sparkContext.defaultParallelism
    measured = lambda df: df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("w").cast("long")), F.lit(0))).first()
    n_candidates, components = measured(candidates)
    query_blocks = block_count(n_queries, numbers, QUERY_BLOCK)
    candidate_blocks = max(block_count(n_candidates, components, CANDIDATE_BLOCK), min(3 * cores, -(-n_candidates // LEAST_BLOCK)))
    pack = F.collect_list(F.struct("id", "w")).alias("rows")
    numbered = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.groupBy(F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("q")).agg(pack).withColumnRenamed("rows", "queries")
    block = F.pmod(F.xxhash64("row"), F.lit(candidate_blocks)).cast("int").alias("c")
    if numbers * 8 <= BROADCAST_BYTES:
        # each block in a task of its own, beside all queries
        parts = min(candidate_blocks, MOST_PARTS)
        right = candidates.select(block, "id", "w").withColumn("p", F.col("c") % parts).repartitionById(parts, F.col("p")).groupBy("p", "c").agg(pack)
        pairs = right.withColumn("q", numbered(query_blocks)).join(F.broadcast(left), "q")
    else:
        parts = min(4 * query_blocks * candidate_blocks, MOST_PARTS)
        right = candidates.groupBy(block).agg(pack).withColumn("q", numbered(query_blocks)).repartition(parts, "q", "c")
        pairs = right.join(left.withColumn("c", numbered(candidate_blocks)).repartition(parts, "q", "c"), ["q", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = PostingBlock(*unpack(batch.column(1), i, scale))
                ids, weights = unpack(batch.column(0), i, scale)
                for start in range(0, len(ids), 512):
                    asked = ids[start : start + 512]
                    found = [block.best(int(q), w, k) for q, w in zip(asked, weights[start : start + 512], strict=True)]
                    yield ranked_batch(asked, found)

    schema = "query_id long, vec_id long, side int, beyond binary, score long"
    found = pairs.select("queries", "rows").mapInArrow(run, schema)
    rank = Window.partitionBy("query_id").orderBy(F.desc("side"), F.desc("beyond"), F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def ranked_batch(asked: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """The rows of some queries' best candidates."""
    query_ids = np.repeat(asked, [len(f[0]) for f in found])
    ids = np.concatenate([f[0] for f in found])
    if any(f[1].dtype == object for f in found):
        side, beyond, scores = zip(*[rank_key(int(x)) for f in found for x in f[1]], strict=True) if len(ids) else ((), (), ())
    else:
        side, beyond, scores = np.zeros(len(ids), dtype=np.int32), [None] * len(ids), np.concatenate([f[1] for f in found])
    columns = [pa.array(query_ids, pa.int64()), pa.array(ids, pa.int64()), pa.array(side, pa.int32()), pa.array(beyond, pa.binary()), pa.array(scores, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "side", "beyond", "score"])


def unpack(column: pa.Array, i: int, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ids and integer weights of one packed block."""
    rows = column[i].values
    ids = rows.field("id").to_numpy(zero_copy_only=False)
    lists = rows.field("w")
    offsets = lists.offsets.to_numpy()
    values = integer_weights(lists.values.to_numpy(zero_copy_only=False), scale)
    return ids, [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
