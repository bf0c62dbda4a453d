"""Importance resampling of documents towards a target distribution of hashed word n-grams.

Words are runs of digits, letters a to z (A to Z are lower-cased) and characters beyond ASCII.
Features are all runs of one to three words, hashed by CRC-32 into ``BUCKETS`` buckets. The shares of
the buckets in all documents and in the target texts give each bucket a gain (the logarithm of the
smoothed ratio, in thousandths); a document's weight is the sum of its features' gains, and its score
adds Gumbel noise from a hash of its id. The best ``percent`` of the documents that are long enough are
drawn, which samples without replacement in proportion to the exponential of the weight.

Texts of more than ``LONG`` bytes are cut at word boundaries into chunks of about ``CHUNK`` bytes that
are dealt out like rows of their own. A chunk carries the next two words, too, and owns the features
that start in it, so every feature is counted once. Counts and weights are summed by document.

Hashes of a run come from those of its words: CRC-32 is linear, so appending n bytes is a table lookup
by n, which numpy does for a whole batch. Tasks hold one batch of texts and one array of bucket counts;
the driver gets the counts of the buckets, whatever the input's size. Ranks come from one distributed sort.

Null texts have no words. Rows without an id take noise as of an empty id, and ties go to them before
others. Repeated rows are documents of their own: equal ones tie, in any order. Other columns are not
looked at. An empty table gives an empty result, and without target texts all targets count zero.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import rebatched, ship_package, utf8_texts, written
from quillspark.operators.review import number_rows

BUCKETS = 10_000
#: Documents of fewer words are not drawn, and how many of the others are, in percent.
LEAST_WORDS, PERCENT = 20, 5
#: Words of the longest feature.
ORDER = 3
#: Longer texts are cut into chunks, and the size of these, in bytes.
LONG, CHUNK = 1 << 16, 1 << 15
#: Texts that a task hashes at once, in bytes.
AT_ONCE = 2 << 20

#: Bytes of words, in lower case; all others as spaces.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_CARRY = re.compile(rb" *([^ ]+(?: +[^ ]+){0,%d})?" % (ORDER - 2))


def as_words(text: bytes) -> bytes:
    """A text with only its words, kept apart by spaces, byte for byte."""
    return text.translate(_WORDS)


def cut(words: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """Chunks of a text and how many of their bytes they own: cut at spaces, with the next words carried behind."""
    start = 0
    while start < len(words):
        end = words.find(b" ", start + size)
        end = len(words) if end < 0 else end
        yield words[start : _CARRY.match(words, end).end()], end - start
        start = end


def zero_bytes_tables(most: int) -> np.ndarray:
    """(most + 1, 4, 256): what appending n zero bytes makes of each byte of a CRC register."""
    base = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        base = np.where(base & 1, (base >> 1) ^ np.uint32(0xEDB88320), base >> 1).astype(np.uint32)
    tables = np.empty((most + 1, 4, 256), dtype=np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, most + 1):
        tables[n] = base[tables[n - 1] & 255] ^ (tables[n - 1] >> 8)
    return tables


SHORT = 64
_TABLES = zero_bytes_tables(SHORT)
#: The same for 2**k zero bytes, up to the longest text there can be.
_POWERS = [_TABLES[1]]


def through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0, crc & 255] ^ table[1, (crc >> 8) & 255] ^ table[2, (crc >> 16) & 255] ^ table[3, crc >> 24]


for _ in range(31):
    _POWERS.append(through(_POWERS[-1], _POWERS[-1]))


def appended(crc: np.ndarray, tail: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of texts of known CRC-32 with tails of known CRC-32 and size behind them."""
    near = np.minimum(size, SHORT)
    out = _TABLES[near, 0, crc & 255] ^ _TABLES[near, 1, (crc >> 8) & 255] ^ _TABLES[near, 2, (crc >> 16) & 255] ^ _TABLES[near, 3, crc >> 24]
    for at in np.flatnonzero(size > SHORT):
        moved = crc[at]
        for k, table in enumerate(_POWERS):
            if int(size[at]) >> k & 1:
                moved = through(table, moved)
        out[at] = moved
    return out ^ tail


class Features:
    """Buckets of the features of some texts' words, by the word that they start with."""

    def __init__(self, texts: list[bytes], owned: list[int] | None = None) -> None:
        split = [t.split() for t in texts]
        words = [w for ws in split for w in ws]
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
        lone = np.fromiter(map(zlib.crc32, number), dtype=np.uint32, count=len(number))[ids]
        spaced = np.fromiter((zlib.crc32(w, _SPACE) for w in number), dtype=np.uint32, count=len(number))[ids]
        size = np.fromiter(map(len, number), dtype=np.int64, count=len(number))[ids] + 1
        counts = np.array([len(ws) for ws in split], dtype=np.int64)
        self.own = counts if owned is None else np.array([len(t[:n].split()) for t, n in zip(texts, owned, strict=True)], dtype=np.int64)
        self.text = np.repeat(np.arange(len(texts)), counts)
        starts = np.cumsum(counts) - counts
        place = np.arange(len(words)) - starts[self.text]
        mine = place < self.own[self.text]
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []  # the text and bucket of each feature, by length
        crc = lone
        for n in range(ORDER):
            if n:
                crc = appended(crc[:-1], spaced[n:], size[n:])
            # a run that leaves its text is none
            whole = mine[: len(words) - n] & (place[: len(words) - n] + n < counts[self.text[: len(words) - n]]) if len(words) > n else np.zeros(0, dtype=bool)
            at = np.flatnonzero(whole)
            self.runs.append((self.text[at], (crc[at] % BUCKETS).astype(np.int64)))

    def counted(self) -> np.ndarray:
        """Features in each bucket."""
        return sum(np.bincount(buckets, minlength=BUCKETS) for _, buckets in self.runs)

    def weights(self, gains: np.ndarray) -> np.ndarray:
        """The sum of gains of each text."""
        out = np.zeros(len(self.own), dtype=np.int64)
        for texts, buckets in self.runs:  # sums of whole numbers, exact in doubles
            out += np.bincount(texts, weights=gains[buckets], minlength=len(out)).astype(np.int64)
        return out

    def sizes(self) -> np.ndarray:
        """The number of features of each text."""
        return sum(np.bincount(texts, minlength=len(self.own)) for texts, _ in self.runs)


_SPACE = zlib.crc32(b" ")


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Texts that are short enough as they are (row, doc_id, text), and the chunks of the others (row, doc_id, text, own), dealt out evenly."""
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), text.alias("text"))
    short, long = narrow.filter(F.octet_length("text") <= LONG), narrow.filter(F.octet_length("text") > LONG)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, 2, rows=1):
            for i, text in enumerate(utf8_texts(batch.column(2))):
                found = list(cut(as_words(text), CHUNK))
                for start in range(0, len(found), 64):
                    part = found[start : start + 64]
                    where = pa.array([i] * len(part))
                    columns = [batch.column(0).take(where), batch.column(1).take(where), pa.array(range(start, start + len(part)), pa.int32())]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([c for c, _ in part], pa.binary()), pa.array([n for _, n in part], pa.int32())], names=["row", "doc_id", "chunk", "text", "own"])

    kind = dict(narrow.dtypes)["doc_id"]
    chunks = long.mapInArrow(run, f"row long, doc_id {kind}, chunk int, text binary, own int")
    return short, chunks.repartition("row", "chunk").drop("chunk")


def grouped(batch: pa.RecordBatch) -> Features:
    """The features of a batch whose columns text and, for chunks, own come last."""
    chunked = batch.schema.names[-1] == "own"
    texts = [as_words(t or b"") for t in utf8_texts(batch.column(batch.schema.names.index("text")))]
    return Features(texts, batch.column(batch.num_columns - 1).to_pylist() if chunked else None)


def bucket_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Features of all texts in each bucket. Every task hands on one row for each bucket that it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in rebatched(iter([batch]), batch.schema.names.index("text"), AT_ONCE, 4096):
                total += grouped(part).counted()
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met], pa.int64())], names=["bucket", "n"])

    counted = [part.mapInArrow(run, "bucket int, n long") for part in pieces(docs, id_col, text_col)]
    out = np.zeros(BUCKETS, dtype=np.int64)
    for row in counted[0].unionByName(counted[1]).groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio of shares) of each bucket."""
    s_all, t_all = int(source.sum()), int(target.sum())
    ratio = ((int(t) + 1) * (s_all + BUCKETS) / ((int(s) + 1) * (t_all + BUCKETS)) for s, t in zip(source, target, strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, n_words, weight of every document."""
    short, chunks = pieces(docs, id_col, text_col)
    kind = dict(short.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in rebatched(iter([batch]), batch.schema.names.index("text"), AT_ONCE, 4096):
                found = grouped(part)
                made = [pa.array(x, pa.int64()) for x in (found.sizes(), found.own, found.weights(gains))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], names=["row", "doc_id", "n_features", "n_words", "weight"])

    schema = f"row long, doc_id {kind}, n_features long, n_words long, weight long"
    # a row's number is its place in the scan, so the chunks of a row find together again
    summed = chunks.mapInArrow(run, schema).groupBy("row", "doc_id").agg(*[F.sum(c).alias(c) for c in ("n_features", "n_words", "weight")])
    return short.mapInArrow(run, schema).unionByName(summed).drop("row")


def gumbel(doc_id: Column, seed: int = 42) -> Column:
    """Noise of an id in thousandths."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank (null for those not drawn) of every document. ``target``: a table with a column text."""
    gains = bucket_gains(bucket_counts(docs, id_col, text_col), bucket_counts(target.select(F.lit(None).cast("long").alias("doc_id"), "text")))
    scored = written(weighed(docs, gains, id_col, text_col).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"))))
    eligible = scored.filter(F.col("n_words") >= least)
    drawn = percent * eligible.count() // 100
    # the last column lets a sort cut a crowd of equal rows
    ranked = number_rows(eligible.withColumns({"less": -F.col("score"), "row": F.monotonically_increasing_id()}), "less", "doc_id", "row", name="rank")
    columns = [F.col(c) for c in ("doc_id", "n_features", "weight", "score")]
    first = ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return first.unionByName(scored.filter(F.col("n_words") < least).select(*columns, F.lit(None).cast("long").alias("rank")))
