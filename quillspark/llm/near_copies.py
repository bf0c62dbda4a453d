"""One document of each group of near copies: SimHash, byte-position inverted index, tally, exact Jaccard similarity.

A text is the set of its shingles of ``shingle`` (5) words. Two texts are linked if the Jaccard
similarity of their sets is ``similarity`` (0.8) or more; groups are the connected components.

The method is that of simhash.py, with a fingerprint that reaches as far as the similarity does. At 0.8
at most 0.152 of the bits of two SimHashes differ, ten of 64, so a positional byte is shared with
0.268. Fingerprints have ``WORDS`` x 64 bits here, and the index posts each under its ``KEYS`` disjoint
pairs of (position, byte), one of which is shared with 0.0722: all are missed with probability
(1 - 0.0722)**128 = 7e-5 at 0.8, and with less above it. Signs of very small sets are coarser: 4
shingles of 5 are missed with 0.009, all other pairs at 0.8 or more with less than 4e-4.

A posting carries the first 128 bits. In its list each fingerprint meets the others, and lists fall apart
into bunches connected by at most ``MOST_BITS`` different bits (mean 19, deviation 4 at 0.8, 64 between
unrelated texts); what is alone leaves the list. Of two members of a bunch that meet, all shared positional
bytes are tallied. Fewer than the minimum, ``LEAST_SHARED`` of 256 (mean 69, deviation 7 at 0.8, 1 between
unrelated texts), are no links, and the rest is verified by the sets themselves.

Sets meet only in the bunches of the keys that they share, never because others connect them. First every
set is compared with the least set of each of its bunches, which settles groups of copies in linear work.
Bunches whose sets are then not all connected are compared in full, in blocks, but for sets that are
connected already, and each pair at its first shared key alone. Tasks hand on bunches and links, never
all pairs of a group. A list has one of 65,536 of the unrelated fingerprints, so their comparison, of
16 bytes each, grows with the square of the table: 128 / 65,536 / 2 of all pairs.

Only distinct sets are indexed, so exact copies cost nothing, and only sets of a bunch are
read again. Sets are told by 128-bit hashes. Null texts count as empty; texts without a word have
the empty set and are copies of each other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import durable, even_join, hot_bound, rebatched, ship_package, utf8_texts, written
from quillspark.llm.simhash import EDGE_SCHEMA, components, shingle_hashes

#: 64-bit words of a fingerprint; each gives four keys of two positional bytes.
WORDS = 32
KEYS = WORDS * 4
#: Most different bits, of the first 128, between neighbours in a bunch, and fewest shared bytes of all 256 of a link.
MOST_BITS, LEAST_SHARED = 40, 24
#: Most sets of a bunch that one block holds, or so.
BLOCK = 256
#: Shingles whose bits are counted at once; below 256 a byte holds a count.
RUN = 255
#: Lists of at most this many members are compared many at once; others by STEP members with REST members.
SHORT, STEP, REST = 32, 256, 8192
#: One set in so many tells which lists are hot; only how they are cut depends on it.
PROBE = 16
ONES = np.uint64(0x0101010101010101)
_RNG = np.random.default_rng(42)
MASKS, FACTORS = (_RNG.integers(0, 1 << 63, (WORDS, 1), dtype=np.uint64) << np.uint64(1) | np.uint64(1) for _ in range(2))


def shingle_set(text: bytes | None, shingle: int = 5) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending."""
    return np.unique(np.array(shingle_hashes(text or b"", shingle), dtype=np.uint64))


def mixed(hashes: np.ndarray) -> np.ndarray:
    """WORDS rows of hashes made of each shingle's hash."""
    x = (hashes[None, :] ^ MASKS) * FACTORS
    x ^= x >> np.uint64(32)
    x *= FACTORS
    x ^= x >> np.uint64(32)
    return x


def wide_fingerprint(found: np.ndarray) -> np.ndarray:
    """The SimHash of a set in WORDS words: a bit is set if over half of its hashes have it. None for the empty set."""
    if not len(found):
        return np.zeros(0, dtype=np.int64)
    counts = np.zeros((WORDS, 8, 8), dtype=np.int64)  # word, byte, bit
    for start in range(0, len(found), RUN):
        x = mixed(found[start : start + RUN])
        for bit in range(8):
            sums = ((x >> np.uint64(bit)) & ONES).sum(axis=1, dtype=np.uint64)
            counts[:, :, bit] += sums.astype("<u8").view(np.uint8).reshape(WORDS, 8)
    return np.packbits(2 * counts > len(found), axis=2, bitorder="little").reshape(-1).view("<i8")


def shared_bytes(mine: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The tally of positional bytes that fingerprints (int64, the last axis) share."""
    return (mine.view(np.uint8) == others.view(np.uint8)).sum(axis=-1)


def bunches(prints: np.ndarray) -> np.ndarray:
    """The bunch of each member of a list, named by one of its members' places. ``prints``: the first 128 bits, two columns of uint64."""
    roots = todo = np.arange(len(prints))
    roots = roots.copy()
    while len(todo) > 1:
        kinds, counts = np.unique(roots[todo], return_counts=True)
        if counts.max() >= STEP:  # members of one bunch need only meet the others
            one = roots[todo] == kinds[counts.argmax()]
            at, rest = todo[one], todo[~one]
            todo = rest
        else:
            at, rest = todo[:STEP], todo
            todo = todo[STEP:]
        for a in range(0, len(at) if len(rest) else 0, STEP):
            for b in range(0, len(rest), REST):
                step, others = at[a : a + STEP], rest[b : b + REST]
                near = bits_apart(prints[step, None], prints[None, others]) <= MOST_BITS
                for row in np.flatnonzero(near.any(axis=1)):
                    own, met = roots[step[row]], roots[others[near[row]]]
                    if (met != own).any():
                        roots[np.isin(roots, np.append(met, own))] = own
    return roots


def bits_apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one[..., 0] ^ other[..., 0]) + np.bitwise_count(one[..., 1] ^ other[..., 1])


def bunch_heads(at: np.ndarray, sets: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """The least set of each row's bunch, for whole lists in turn (equal ``at``); a row that is alone has its own."""
    heads = sets.copy()
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    sizes = np.diff(np.append(starts, len(at)))
    short = np.repeat(sizes <= SHORT, sizes)
    pairs = []
    for step in range(1, min(SHORT, int(sizes.max()))):
        i = np.flatnonzero((at[step:] == at[:-step]) & short[step:])
        i = i[bits_apart(prints[i], prints[i + step]) <= MOST_BITS]
        pairs.append(np.stack([i, i + step]))
    if pairs:
        i, j = np.concatenate(pairs, axis=1)
        while (heads[i] != heads[j]).any():
            low = np.minimum(heads[i], heads[j])
            np.minimum.at(heads, i, low)
            np.minimum.at(heads, j, low)
    for start, size in zip(starts[sizes > SHORT].tolist(), sizes[sizes > SHORT].tolist(), strict=True):
        roots, mine = bunches(prints[start : start + size]), heads[start : start + size]
        least = np.full(size, np.iinfo(np.int64).max)
        np.minimum.at(least, roots, mine)
        heads[start : start + size] = least[roots]
    return heads


def shared_counts(mine: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many values of a set are in each of the others, which are not empty."""
    sizes = np.array([len(s) for s in others], dtype=np.int64)
    values = np.concatenate(others)
    place = np.minimum(np.searchsorted(mine, values), len(mine) - 1)
    return np.add.reduceat((mine[place] == values).astype(np.int64), np.cumsum(sizes) - sizes)


def cross_links(k: int, ids: np.ndarray, roots: np.ndarray, own: np.ndarray, sets: list[np.ndarray], bands: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links between sets of two blocks (or one) of a bunch of key ``k`` that are not connected so far. Pairs that share an earlier key meet there."""
    least, links = Fraction(str(similarity)), []
    p, q = least.numerator, least.denominator
    sizes, comp = np.array([len(s) for s in sets], dtype=np.int64), roots.copy()
    two, keys = own.min() != own.max(), bands.view(np.uint16)
    for at in range(len(ids) - 1):
        rest = np.arange(at + 1, len(ids))
        fit = (comp[rest] != comp[at]) & (np.minimum(sizes[rest], sizes[at]) * q >= np.maximum(sizes[rest], sizes[at]) * p)
        if two:
            fit &= own[rest] != own[at]
        rest = rest[fit]
        rest = rest[(keys[rest] == keys[at]).argmax(axis=1) == k]
        rest = rest[shared_bytes(bands[at], bands[rest]) >= LEAST_SHARED]
        if not len(rest):
            continue
        # shared / (a + b - shared) >= p / q
        near = rest[shared_counts(sets[at], [sets[i] for i in rest]) * (p + q) >= p * (sizes[rest] + sizes[at])]
        for i in near:
            if comp[i] != comp[at]:
                links.append((int(ids[i]), int(ids[at])))
                comp[comp == comp[i]] = comp[at]
    return links


def text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def with_sets(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (hash of the text), sig (hash of its shingle set) and bands (the words of its fingerprint) of each row. One pass, no shuffle."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, 2):
            found = [shingle_set(t, shingle) for t in utf8_texts(batch.column(2))]
            sigs = pa.array([xxhash.xxh128_digest(s.tobytes()) for s in found], pa.binary())
            bands = pa.array([wide_fingerprint(s) for s in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sigs, bands], names=["doc_id", "key", "sig", "bands"])

    narrow = docs.select(docs[id_col].alias("doc_id"), text_key(text_col).alias("key"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {dict(docs.dtypes)[id_col]}, key long, sig binary, bands array<long>")


def key_lists(sets: DataFrame) -> DataFrame:
    """set, k, band: the bunches of two sets or more in the lists of keys that they share. ``sets``: set, bands.

    A list of very many members is dealt into blocks and bunched block pair by block pair.
    """
    ship_package(sets.sparkSession)
    words = sets.select("set", F.get("bands", F.lit(0)).alias("p"), F.get("bands", F.lit(1)).alias("q"), F.posexplode("bands").alias("w", "word"))
    pairs = F.array(*[F.shiftrightunsigned("word", 16 * j).bitwiseAND(F.lit(0xFFFF)) for j in range(4)])
    postings = words.select("set", "p", "q", "w", F.posexplode(pairs).alias("j", "bytes"))
    postings = postings.select("set", "p", "q", ((F.col("w") * 4 + F.col("j")) * 0x10000 + F.col("bytes")).alias("key"))
    unit = hot_bound(sets.count() * KEYS)
    probed = postings.filter(F.pmod(F.xxhash64("set"), F.lit(PROBE)) == 0).groupBy("key").agg((F.count(F.lit(1)) * PROBE).alias("n"))
    hot = probed.filter(F.col("n") > unit).select("key", F.least(F.ceil(F.col("n") / F.lit(unit)), F.lit(255)).cast("int").alias("blocks"))
    dealt = postings.join(F.broadcast(hot), "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    at = F.col("key") * 0x10000 + F.least("own", "other") * 256 + F.greatest("own", "other")
    met = dealt.select(at.alias("at"), "set", "p", "q").repartition("at").sortWithinPartitions("at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, ids, p, q in whole_lists(batches):
            heads = bunch_heads(at, ids, np.stack([p, q], axis=1).view(np.uint64))
            order = np.lexsort((heads, at))
            at, ids, heads = at[order], ids[order], heads[order]
            same = (at[1:] == at[:-1]) & (heads[1:] == heads[:-1])
            more = np.concatenate((same, [False])) | np.concatenate(([False], same))
            yield pa.RecordBatch.from_arrays([pa.array(c[more]) for c in (at, ids, heads)], names=["at", "set", "head"])

    bunched = met.mapInArrow(run, "at long, set long, head long")
    return written(bunched.select("set", F.shiftright("at", 32).cast("int").alias("k"), F.xxhash64("at", "head").alias("band")))


def whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of rows sorted by the first one, cut only where it changes."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not batch.num_rows:
            continue
        last = int(np.searchsorted(columns[0], columns[0][-1]))
        if held and (last or held[-1][0][-1] != columns[0][0]):
            yield [np.concatenate(c) for c in zip(*held, [c[:last] for c in columns], strict=True)]
            held = []
        elif last:
            yield [c[:last] for c in columns]
        held.append([c[last:] for c in columns])
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def packed_sets(docs: DataFrame, sets: DataFrame, lists: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """set, packed, bands of the sets of a bunch, made again from one document of each."""
    n_docs = sets.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    wanted = sets.join(lists.select("set").distinct(), "set").select("set", "bands", F.xxhash64("who.doc_id").alias("r_hid"), F.col("who.key").alias("r_key"), F.col("who.n").alias("w_n"))
    # a document is told by two hashes, of its text and of its id
    read = docs.select(F.xxhash64(id_col).alias("r_hid"), text_key(text_col).alias("r_key"), F.col(text_col).cast("string").alias("r_text"))
    met = even_join(read, wanted, ["r_key", "r_hid"], "w_n", n_docs, F.monotonically_increasing_id(), grows=True).dropDuplicates(["set"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, 2):
            packed = pa.array([shingle_set(t, shingle).tobytes() for t in utf8_texts(batch.column(2))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["set", "bands", "packed"])

    return written(met.select("set", "bands", "r_text").mapInArrow(encode, "set long, bands array<long>, packed binary"))


def star_links(lists: DataFrame, packed: DataFrame, similarity: float) -> DataFrame:
    """Links u, v between each set and the least one of each of its bunches."""
    total = lists.count()
    heads = lists.groupBy("k", "band").agg(F.min("set").alias("head"), F.count(F.lit(1)).alias("n"))
    pairs = written(even_join(lists, heads, ["k", "band"], "n", total, F.xxhash64("set")).filter("set <> head").select("set", "head").distinct())
    sizes = pairs.groupBy("head").agg(F.count(F.lit(1)).alias("n"))
    own = packed.select(F.col("set").alias("head"), F.col("packed").alias("other"), F.col("bands").alias("its")).join(sizes, "head")
    members = pairs.join(packed.select("set", "packed", "bands").hint("merge"), "set")
    met = even_join(members, own, ["head"], "n", total, F.xxhash64("set"), grows=True)
    least = Fraction(str(similarity))
    p, q = least.numerator, least.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, 2):
            links = []
            mine, its = (c.flatten().to_numpy(zero_copy_only=False).reshape(-1, WORDS) for c in batch.columns[4:])
            batch = batch.filter(pa.array(shared_bytes(mine, its) >= LEAST_SHARED))
            for u, v, *both in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
                a, b = (np.frombuffer(x, dtype=np.uint64) for x in both)
                if min(len(a), len(b)) * q >= max(len(a), len(b)) * p and shared_counts(a, [b])[0] * (p + q) >= p * (len(a) + len(b)):
                    links.append((u, v))
            u, v = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return met.select("set", "head", "packed", "other", "bands", "its").mapInArrow(run, EDGE_SCHEMA)


def open_lists(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """set, k, band, root, n of the bunches whose ``n`` sets are not all connected."""
    total = lists.count()
    placed = written(lists.join(roots.select(F.col("node").alias("set"), "root"), "set", "left").withColumn("root", F.coalesce("root", "set")))
    mixed = placed.groupBy("k", "band").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return even_join(placed, mixed.select("k", "band", "n"), ["k", "band"], "n", total, F.xxhash64("set"))


def full_links(lists: DataFrame, packed: DataFrame, similarity: float, block: int) -> DataFrame:
    """Links u, v between sets of a bunch that are not connected so far, block pair by block pair, which bounds a task's memory however large a bunch is."""
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    dealt = lists.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("k", "band", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "set", "root")
    keys = ["k", "band", "a", "b"]
    met = dealt.join(packed.hint("merge"), "set").select(*keys, "own", "set", "root", "packed", "bands")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, members in list_runs(batches):
            own, ids, roots, packed, bands = zip(*members, strict=True)
            found = [np.frombuffer(x, dtype=np.uint64) for x in packed]
            if links := cross_links(k, np.array(ids), np.array(roots), np.array(own), found, np.array(bands), similarity):
                u, v = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, EDGE_SCHEMA)


def list_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The key's number and the members (own, set, root, packed, bands) of each bunch's block pair, from rows sorted by (k, band, a, b)."""
    members, key = [], None
    for batch in batches:
        for *place, own, set_id, root, packed, bands in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if place != key:
                if len(members) > 1:
                    yield key[0], members
                members, key = [], place
            members.append((own, set_id, root, packed, bands))
    if len(members) > 1:
        yield key[0], members


def set_links(docs: DataFrame, sets: DataFrame, similarity: float, shingle: int, id_col: str, text_col: str, block: int = BLOCK) -> DataFrame:
    """Links u, v between distinct sets that connect all of at least ``similarity``. ``sets``: set, bands, who (doc_id, key, n: its rows), docs."""
    lists = key_lists(sets)
    packed = packed_sets(docs, sets, lists, shingle, id_col, text_col)
    stars = written(star_links(lists, packed, similarity))
    return stars.unionByName(full_links(open_lists(lists, components(stars)), packed, similarity, block))


def without_near_copies(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the least id of each group, whole and once, with the columns of ``docs``.

    Rows without an id cannot be named in a group and stay. Rows of one id with different texts are documents of their own:
    of those in one group the one with the least hash of its text stays. Of rows of one id and text the one with the least hash of its
    other columns stays.
    """
    marked = durable(with_sets(docs, shingle, id_col, text_col))
    told = marked.groupBy("sig", "doc_id", "key").agg(F.first("bands").alias("bands"), F.count(F.lit(1)).alias("n"))
    sets = told.groupBy("sig").agg(F.first("bands").alias("bands"), F.min(F.struct("doc_id", "key", "n")).alias("who"), F.sum("n").alias("docs"))
    sets = written(sets.withColumn("set", F.monotonically_increasing_id()))
    rooted = components(set_links(docs, sets, similarity, shingle, id_col, text_col))
    named = marked.filter("doc_id IS NOT NULL").groupBy("sig").agg(F.min(F.struct("doc_id", "key")).alias("who")).join(sets.select("sig", "set"), "sig")
    named = named.join(rooted, F.col("set") == F.col("node"), "left").select("who", F.coalesce("root", "set").alias("root"))
    heads = named.groupBy("root").agg(F.min("who").alias("who")).select(F.col("who.doc_id").alias("h_id"), F.col("who.key").alias("h_key")).distinct()
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    inner = docs.filter(F.col(id_col).isNotNull()).select(*[F.col(c).alias(a) for c, a in own.items()], text_key(text_col).alias("d_key"))
    # copies of one id and text fall together before rows are sent, so none of them can crowd a task
    told_apart = [a for c, a in own.items() if "map<" not in dict(docs.dtypes)[c]]
    once = inner.groupBy(own[id_col], "d_key").agg(F.min_by(F.struct(*[a for c, a in own.items() if c != id_col]), F.xxhash64(*told_apart)).alias("rest"))
    kept = once.join(heads, (F.col(own[id_col]) == F.col("h_id")) & (F.col("d_key") == F.col("h_key")), "left_semi")
    back = [F.col(a).alias(c) if c == id_col else F.col("rest")[a].alias(c) for c, a in own.items()]
    return kept.select(*back).unionByName(docs.filter(F.col(id_col).isNull()))
