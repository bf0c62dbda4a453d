"""Near-duplicate groups by SimHash and a byte-position inverted index.

Fingerprints of 64 bits are eight positional bytes. Two that differ in at most ``bits`` (4)
bits differ in at most 4 bytes, so they share at least 4 positional bytes: the guaranteed
minimum. The index posts each distinct fingerprint under sets of (position, byte) pairs; the
position sets are chosen such that any 4 positions contain one of them, so every such pair of
fingerprints meets. There shared positional bytes are tallied, pairs below the minimum are
dropped and the rest is verified by Hamming distance.

Only distinct fingerprints are indexed, so exact copies cost nothing. A posting list is dealt
into blocks by hash and compared block pair by block pair, which bounds a task's memory however
long the list is; each task hands on a spanning forest of its links, never all pairs of a group.
Groups are the connected components of the links (large-star/small-star over checkpoints).

Null texts count as empty; texts without a word have fingerprint zero and are linked like any
other. Rows without an id take part in linking, but give no component id. Repeated rows
repeat in the result. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import durable, even_join, hot_bound, rebatched, ship_package, utf8_texts

SEED = 42
WIDTH = 8
#: Most fingerprints of a posting list that one block holds.
BLOCK = 2048
#: Shingles whose hashes are counted at once; below 256 a byte holds a count.
RUN = 255
EDGE_SCHEMA = "u long, v long"


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The SimHash of a text's word shingles, unsigned; zero if it has no word."""
    return int(fingerprints([text], shingle)[0])


def shingle_hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()  # of bytes: A-Z, and the six ASCII spaces
    if not words:
        return []
    joined, hash64 = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [hash64(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    return [hash64(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]


def fingerprints(texts: list[bytes | None], shingle: int = 4) -> np.ndarray:
    """SimHashes of texts as uint64: a bit is set if over half of the shingle hashes have it."""
    hashed = [shingle_hashes(t or b"", shingle) for t in texts]
    sizes = np.fromiter(map(len, hashed), dtype=np.int64, count=len(hashed))
    counts = np.zeros((len(texts), 64), dtype=np.int64)
    for i, hashes in enumerate(hashed):
        if hashes:
            counts[i] = bit_counts(np.array(hashes, dtype=np.uint64))
    over = (2 * counts > sizes[:, None]).astype(np.uint64)
    return (over << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit: eight counts at once in the bytes of a 64-bit sum."""
    counts, ones = np.zeros((8, 8), dtype=np.int64), np.uint64(0x0101010101010101)
    runs = np.arange(0, len(hashes), RUN)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & ones, runs)
        counts[:, bit] = sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.reshape(64)


def with_fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) of each row. One pass, no shuffle."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, 1):
            fp = fingerprints(utf8_texts(batch.column(1)), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["doc_id", "fp"])

    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {dict(docs.dtypes)[id_col]}, fp long")


def position_sets(size: int = 3) -> list[tuple[int, ...]]:
    """Sets of ``size`` (2 or 3) byte positions such that any 4 of the 8 contain one (Turan's construction).

    Positions are dealt into three circles. Of 4 positions two share a circle; that pair is a set of two.
    For sets of three take the triples within a circle, and those with two in one circle and one in the next.
    """
    circle = [p % 3 for p in range(WIDTH)]
    if size == 2:
        return [s for s in combinations(range(WIDTH), 2) if circle[s[0]] == circle[s[1]]]
    if size == 3:
        kinds = {tuple(sorted((c, c, d))) for c in range(3) for d in (c, (c + 1) % 3)}
        return [s for s in combinations(range(WIDTH), 3) if tuple(sorted(circle[p] for p in s)) in kinds]
    raise ValueError("size must be 2 or 3")


def linked(xor: np.ndarray, bits: int) -> np.ndarray:
    """Which differences are links: the tally of shared bytes first, then the distance."""
    shared = (xor.reshape(-1, 1).view(np.uint8) == 0).sum(axis=1)
    near = shared >= WIDTH - min(bits, WIDTH)
    near[near] = np.bitwise_count(xor[near]) <= bits
    return near


def forest(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect what all links among distinct fingerprints connect: one less per component than its members."""
    rest, links = fps, []
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = linked(rest ^ at, bits)
            if near.any():
                found = rest[near]
                rest = rest[~near]
                links.extend((int(x), int(at)) for x in found.view(np.int64))
                frontier.extend(found)
    return [(u, int(np.uint64(v).astype(np.int64))) for u, v in links]


def index_links(distinct: DataFrame, bits: int = 4, positions: int = 3, block: int = BLOCK) -> DataFrame:
    """Links u, v between distinct fingerprints (column fp) that connect all within ``bits`` bits (at most 4)."""
    if not 0 <= bits <= 4:
        raise ValueError("bits must be 0 to 4")
    masks = [sum(0xFF << 8 * p for p in s) for s in position_sets(positions)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    postings = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("k", "bytes"))
    lists = postings.groupBy("k", "bytes").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    lists = lists.withColumn("blocks", F.ceil(F.col("n") / F.lit(block)).cast("int"))
    ship_package(distinct.sparkSession)
    dealt = (
        even_join(postings, lists, ["k", "bytes"], "n", distinct.count() * len(masks), F.xxhash64("fp"))
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("k", "bytes", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp")
    )
    keys = ["k", "bytes", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps in posting_runs(batches):
            if links := forest(fps.view(np.uint64), bits):
                u, v = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, EDGE_SCHEMA)


def posting_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The fingerprints of each posting list's block pair, from rows sorted by (k, bytes, a, b)."""
    held: list[np.ndarray] = []
    key = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, dtype=bool)
        for c in columns[:4]:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change).tolist()
        for a, b in zip([0, *starts], [*starts, n], strict=True):
            now = tuple(c[a] for c in columns[:4])
            if now != key:
                if held:
                    yield np.concatenate(held)
                held, key = [], now
            held.append(columns[4][a:b])
    if held:
        yield np.concatenate(held)


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node connected) for every node of u-v links, by alternating stars.

    Each round is checkpointed; the number of rounds grows with the logarithm of the longest chain. In rounds where a node has so
    many links that they would crowd a task, they are spread over several; other rounds keep the shorter plan.
    """
    edges = durable(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before, total = None, 2 * edges.count()
    while True:
        degrees = edges.select(F.explode(F.array("u", "v")).alias("u")).groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        crowded = (degrees.agg(F.max("n")).first()[0] or 0) > hot_bound(total)
        meet = (lambda left, right, bound=total: even_join(left, right, ["u"], "n", bound, F.xxhash64("v"))) if crowded else (lambda left, right: left.join(right, "u"))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = meet(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every u is now above its v: link the neighbours below it, and itself, to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = meet(large, low).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = durable(small.filter("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, total = now, 2 * now[0]


def near_duplicates(docs: DataFrame, bits: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the least id among the documents connected by links.

    Fingerprints of many documents and groups of many fingerprints are spread over several tasks.
    """
    marked = durable(with_fingerprints(docs, shingle, id_col, text_col))
    distinct = durable(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    total = distinct.agg(F.count(F.lit(1)).alias("fps"), F.coalesce(F.sum("n"), F.lit(0)).alias("docs")).first()
    rooted = components(index_links(distinct.select("fp"), bits))
    rooted = distinct.join(rooted, F.col("fp") == F.col("node"), "left").select("fp", "n", "least", F.coalesce("root", "fp").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
    named = even_join(rooted, heads, ["root"], "members", total.fps, F.xxhash64("fp")).select("fp", "n", "component_id")
    found = even_join(marked, named, ["fp"], "n", total.docs, F.monotonically_increasing_id())
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
