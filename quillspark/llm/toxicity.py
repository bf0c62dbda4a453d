"""Toxicity by a factorization machine over hashed terms, trained in numpy.

A text's words, lower-cased, are hashed into ``TERMS`` terms. The machine scores a window of ``WINDOW``
words by its distinct terms: a bias, a weight for each term, and for each pair of terms the product of
their factor vectors, so that an insult next to the mention of a group can weigh more than the two
alone. Windows overlap by half and cover the whole text; a text scores as its worst window, so a few
words in a very long text count as much as in a short one.

Labels come from ``labels`` and are joined by id; rows in the held-out fold (remainder 2 of the CRC-32
of the id, modulo 4) are never learned from. Equal texts are one example, whose target is the mean of
its labels. The sample is bounded: at most ``SAMPLE`` examples that are mostly toxic and as many that
are not, chosen by hash, and ``SAMPLE_WINDOWS`` windows of each, spread over the text. Examples count
alike, so where toxic texts are rarer than in the sample, scores lean towards them. Terms in fewer than
``SUPPORT`` examples, or whose examples are not clearly more or less toxic than others, get no weight. Training picks each example's worst window by the weights so far.

Scoring is one pass without a shuffle. Null and empty texts score as a window without terms. Without
any usable label the score is zero. Rows without an id are scored, and held out or not as of an
empty id. Repeated rows get equal scores. Null labels do not count. Other columns are not looked at.
An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import rebatched, ship_package, written

TERMS = 1 << 20
FACTORS = 4
WINDOW = 64
#: Bounds of the training sample: examples of either kind, and windows of each.
SAMPLE = 4000
SAMPLE_WINDOWS = 64
#: The share of its log odds that a term's weight starts from and is drawn to.
PRIOR = 1.0
#: A term needs this many examples, and this likelihood ratio (twice its logarithm) of its examples against all, to get weights.
SUPPORT, CLEAR = 3, 16.0
#: Texts of this score or more are predicted to be toxic.
LEAST = 0.3
#: Windows that are scored at once, and bytes of texts.
AT_ONCE, BYTES = 4096, 2 << 20
WORD = re.compile(r"[^\W_]+")


def terms_of(texts: list[str], known: dict[int, int] | None = None) -> list[np.ndarray]:
    """The terms of each text's words, from 1; or the places of ``known`` terms in a model, 0 for others."""
    split = [WORD.findall(t.lower()) for t in texts]
    number = {w: 0 for ws in split for w in ws}
    for w in number:
        term = zlib.crc32(w.encode()) % TERMS + 1
        number[w] = term if known is None else known.get(term, 0)
    return [np.fromiter(map(number.__getitem__, ws), dtype=np.int32, count=len(ws)) for ws in split]


def windows_of(terms: np.ndarray) -> np.ndarray:
    """(n, WINDOW): windows that cover all terms, half of each in the next one; 0 stands for no term and for a repeated one."""
    step = WINDOW // 2
    n = max(1, -(-(len(terms) - WINDOW) // step) + 1)
    padded = np.zeros((n - 1) * step + WINDOW, dtype=np.int32)
    padded[: len(terms)] = terms
    size = padded.itemsize
    out = np.sort(np.lib.stride_tricks.as_strided(padded, (n, WINDOW), (step * size, size)), axis=1)
    out[:, 1:][out[:, 1:] == out[:, :-1]] = 0
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def telling_terms(examples: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """By term, how far the log odds of the examples that hold it are from those of all; 0 for terms of too few examples, or of no clear difference."""
    held = [np.unique(w) for w in examples]
    n = np.bincount(np.concatenate(held), minlength=TERMS + 1).astype(np.float64)
    toxic = np.bincount(np.concatenate(held), weights=np.repeat(target, [len(h) for h in held]), minlength=TERMS + 1)
    share = min(max(float(target.mean()), 1e-6), 1 - 1e-6)
    rate = np.clip(toxic / np.maximum(n, 1), 1e-9, 1 - 1e-9)
    ratio = 2 * n * (rate * np.log(rate / share) + (1 - rate) * np.log((1 - rate) / (1 - share)))
    smooth = (toxic + share) / (n + 1)
    odds = np.log(smooth / (1 - smooth)) - np.log(share / (1 - share))
    odds[(n < SUPPORT) | (ratio < CLEAR)] = 0
    odds[0] = 0
    return odds


class FactorizationMachine:
    """``table``: by place its term's weight, then its factors; row 0, for no term, is zero. ``known``: the place of each term. ``factors`` 0 makes it a linear model."""

    def __init__(self, factors: int = FACTORS, seed: int = 11) -> None:
        self.factors, self.seed = factors, seed
        self.known: dict[int, int] = {}
        self.table = np.zeros((1, 1 + factors), dtype=np.float32)
        self.bias = 0.0

    def parts(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the table, their sums, and logits of windows."""
        rows = self.table.take(windows, axis=0)
        total = rows.sum(axis=1)
        pairs = (total[:, 1:] ** 2).sum(axis=1) - (rows[:, :, 1:] ** 2).sum(axis=(1, 2))
        return rows, total, self.bias + total[:, 0] + pairs / 2

    def logits(self, windows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.parts(windows[i : i + AT_ONCE])[2] for i in range(0, len(windows), AT_ONCE)])

    def fit(self, examples: list[np.ndarray], target: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, decay: float = 20.0, loose: float = 0.5) -> None:
        """Adam on the cross-entropy of each example's worst window. ``examples``: windows of terms; only telling ones get weights.

        ``decay`` draws weights to where they start from, ``loose`` factors to zero.
        """
        rng = np.random.default_rng(self.seed)
        odds = telling_terms(examples, target)
        told = np.flatnonzero(odds)
        self.known = {int(t): i for i, t in enumerate(told, 1)}
        place = np.zeros(TERMS + 1, dtype=np.int32)
        place[told] = np.arange(1, len(told) + 1)
        self.table = rng.normal(0, 0.05, (len(told) + 1, 1 + self.factors)).astype(np.float32)
        self.table[1:, 0] = odds[told] * PRIOR
        self.table[0] = 0
        prior = self.table.copy()
        prior[:, 1:] = 0
        drawn = np.array([decay] + [loose] * self.factors, dtype=np.float32) / len(examples)
        share = float(target.mean())
        self.bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        windows, sizes = place[np.concatenate(examples)], np.array([len(w) for w in examples])
        starts = np.cumsum(sizes) - sizes
        first, second, bias_m, bias_v, step = np.zeros_like(self.table), np.zeros_like(self.table), 0.0, 0.0, 0
        for _ in range(epochs):
            z = self.logits(windows)
            worst = np.array([s + int(z[s : s + n].argmax()) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)])
            order = rng.permutation(len(examples))
            for i in range(0, len(order), batch):
                chosen = order[i : i + batch]
                x = windows[worst[chosen]]
                rows, total, z = self.parts(x)
                d = (sigmoid(z) - target[chosen]) / len(chosen)
                grads = np.empty_like(rows)
                grads[:, :, 0] = d[:, None]
                grads[:, :, 1:] = d[:, None, None] * (total[:, None, 1:] - rows[:, :, 1:])
                g = drawn * (self.table - prior)
                np.add.at(g, x, grads)
                g[0] = 0
                step += 1
                first += 0.1 * (g - first)
                second += 0.01 * (g * g - second)
                self.table -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
                bias_m += 0.1 * (d.sum() - bias_m)
                bias_v += 0.01 * (d.sum() ** 2 - bias_v)
                self.bias -= rate * float(bias_m / (1 - 0.9**step)) / (float(bias_v / (1 - 0.99**step)) ** 0.5 + 1e-6)

    def scores(self, texts: list[str]) -> np.ndarray:
        """The score of each text's worst window, from 0 to 1. Texts without a known term need no windows."""
        out = np.full(len(texts), self.bias)
        terms = terms_of(texts, self.known)
        some = [i for i, t in enumerate(terms) if t.any()]
        if some:
            cut = [windows_of(terms[i]) for i in some]
            sizes = np.array([len(w) for w in cut])
            out[some] = np.maximum.reduceat(self.logits(np.concatenate(cut)), np.cumsum(sizes) - sizes)
        return sigmoid(out)


def fold(doc_id: Column) -> Column:
    """The fold of a document: CRC-32 of its id as text (none: of an empty text), modulo 4."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def training_examples(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[np.ndarray], np.ndarray]:
    """Windows of terms and targets of a bounded sample of labelled texts outside the held-out fold.

    Texts are told by two hashes and counted once. A bound on the first hash leaves about twice the sample to sort, and only
    the chosen texts are read again, cut into terms where they lie.
    """
    spark = docs.sparkSession
    ship_package(spark)
    marks = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.avg(F.least(F.greatest("toxic", F.lit(0)), F.lit(1))).alias("toxic"))
    key = [F.shiftrightunsigned(F.xxhash64("text"), 1).alias("rank"), F.xxhash64(F.lit(1), "text").alias("check")]
    known = docs.filter(F.col("text").isNotNull() & (fold(F.col("doc_id")) != 2)).select("doc_id", *key).join(marks, "doc_id")
    texts = written(known.groupBy("rank", "check").agg(F.avg("toxic").alias("target"), F.min("doc_id").alias("doc_id")))
    rows = []
    for kind in (F.col("target") >= 0.5, F.col("target") < 0.5):
        some = texts.filter(kind)
        share = min(1.0, (2 * sample + 100) / max(1, some.count()))
        rows += some.filter(F.col("rank") <= int(share * ((1 << 63) - 1024))).orderBy("rank", "check").limit(sample).collect()
    chosen = spark.createDataFrame([(r.doc_id, r.rank, r.check, r.target) for r in rows], f"doc_id {dict(docs.dtypes)['doc_id']}, rank long, check long, target double")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter((key[0] == F.col("rank")) & (key[1] == F.col("check")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in rebatched(iter([batch]), 0, BYTES):
                cut = [windows_of(t) for t in terms_of(part.column(0).to_pylist())]
                cut = [w if len(w) <= SAMPLE_WINDOWS else w[np.linspace(0, len(w) - 1, SAMPLE_WINDOWS).astype(int)] for w in cut]
                packed = pa.array([w.tobytes() for w in cut], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], packed], names=["rank", "check", "target", "packed"])

    read = found.select("text", "rank", "check", "target").mapInArrow(run, "rank long, check long, target double, packed binary")
    made = sorted(read.dropDuplicates(["rank", "check"]).collect(), key=lambda r: (r.rank, r.check))
    return [np.frombuffer(r.packed, dtype=np.int32).reshape(-1, WINDOW) for r in made], np.array([r.target for r in made])


def fit_toxicity_model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> FactorizationMachine:
    """``docs``: doc_id, text; ``labels``: doc_id, toxic."""
    examples, target = training_examples(docs.select("doc_id", F.col("text").cast("string").alias("text")), labels.select("doc_id", "toxic"), sample)
    model = FactorizationMachine()
    if examples:
        model.fit(examples, target)
    else:
        model.bias = -30.0
    return model


def score_toxicity(docs: DataFrame, model: FactorizationMachine, least: float = LEAST) -> DataFrame:
    """doc_id, held_out, score, predicted for every document. One pass, no shuffle."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in rebatched(iter([batch]), 1, BYTES):
                scores = model.scores([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    scored = narrow.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
