"""Language identification by a byte-level convolutional network in numpy.

The network reads windows of 256 bytes: filters two, three and four bytes wide, the maximum of
each over the window, and a softmax layer. It is trained on windows of a bounded sample of
labelled texts; a text's prediction is the mean over windows that cover all of it, weighted by
their bytes. For prediction, filters are tabulated by byte pairs, so a position costs three
table rows instead of nine.

Null texts and texts without a letter are ``und`` with score 0. Without any labelled text
nothing is learned and everything is ``und``. Texts of any length are read whole. Repeated rows
get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quillspark.llm.common import ship_package

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Bounds of the training sample: documents, and windows of each.
SAMPLE_DOCS = 3000
SAMPLE_WINDOWS = 3
#: Windows that are convolved at once.
AT_ONCE = 64
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


class ByteCNN:
    """Filters ``kernels[w]`` (w, 256, FILTERS), their biases, and the softmax layer."""

    def __init__(self, languages: list[str], seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.weights = {f"k{w}": rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.weights |= {f"b{w}": np.zeros(FILTERS, dtype=np.float32) for w in WIDTHS}
        self.weights["out"] = rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.weights["bias"] = np.zeros(len(languages), dtype=np.float32)

    def __getstate__(self) -> dict:
        return {"languages": self.languages, "weights": self.weights}

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 7) -> None:
        """Adam on the cross-entropy; classes count alike whatever their share of the sample."""
        rng = np.random.default_rng(seed)
        share = np.bincount(labels, minlength=len(self.languages))
        weight = (len(labels) / (len(self.languages) * np.maximum(share, 1)))[labels].astype(np.float32)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for i in range(0, len(order), batch):
                rows = order[i : i + batch]
                step += 1
                for k, g in self.gradients(windows[rows], labels[rows], weight[rows]).items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    self.weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        self.__dict__.pop("pairs", None)

    def gradients(self, x: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        n, pooled, at = len(x), [], {}
        for w in WIDTHS:
            span = WINDOW - w + 1
            s = sum(self.weights[f"k{w}"][j][x[:, j : j + span]] for j in range(w))
            at[w] = s.argmax(axis=1)
            pooled.append(np.take_along_axis(s, at[w][:, None, :], axis=1)[:, 0] + self.weights[f"b{w}"])
        raw = np.concatenate(pooled, axis=1)
        features = np.maximum(raw, 0)
        d = softmax(features @ self.weights["out"] + self.weights["bias"])
        d[np.arange(n), labels] -= 1
        d *= weight[:, None] / n
        grads = {"out": features.T @ d, "bias": d.sum(axis=0)}
        back = (d @ self.weights["out"].T) * (raw > 0)
        for i, w in enumerate(WIDTHS):
            own = back[:, i * FILTERS : (i + 1) * FILTERS]
            grads[f"b{w}"] = own.sum(axis=0)
            k = np.zeros_like(self.weights[f"k{w}"])
            columns = np.broadcast_to(np.arange(FILTERS), own.shape)
            for j in range(w):  # only the winning positions learn
                np.add.at(k[j], (np.take_along_axis(x, at[w] + j, axis=1), columns), own)
            grads[f"k{w}"] = k
        return grads

    @cached_property
    def pairs(self) -> tuple[np.ndarray, ...]:
        """By two bytes: the filters of width 2, the first two bytes' part of widths 3 and 4; by their last bytes: the rest."""
        two = lambda a, b: (a[:, None] + b[None]).reshape(65536, FILTERS)
        k2, k3, k4 = (self.weights[f"k{w}"] for w in WIDTHS)
        return two(*k2), two(k3[0], k3[1]), two(k4[0], k4[1]), k3[2].copy(), two(k4[2], k4[3])

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(n, languages) for windows (n, WINDOW) of bytes; positions come first inside, so maxima run over whole rows."""
        two, three, four, third, rest = self.pairs
        n = len(windows)
        pooled = np.empty((n, len(WIDTHS) * FILTERS), dtype=np.float32)
        for i in range(0, n, AT_ONCE):
            x = np.ascontiguousarray(windows[i : i + AT_ONCE].T).astype(np.intp)
            pair = x[:-1] << 8 | x[1:]
            pooled[i : i + AT_ONCE, :FILTERS] = two.take(pair, axis=0, mode="clip").max(axis=0)
            s = three.take(pair[:-1], axis=0, mode="clip")
            s += third.take(x[2:], axis=0, mode="clip")
            pooled[i : i + AT_ONCE, FILTERS : 2 * FILTERS] = s.max(axis=0)
            s = four.take(pair[:-2], axis=0, mode="clip")
            s += rest.take(pair[2:], axis=0, mode="clip")
            pooled[i : i + AT_ONCE, 2 * FILTERS :] = s.max(axis=0)
        bias = np.concatenate([self.weights[f"b{w}"] for w in WIDTHS])
        return softmax(np.maximum(pooled + bias, 0) @ self.weights["out"] + self.weights["bias"])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """A language and a score for each text."""
        languages, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if self.languages and t and LETTER.search(t)]
        start = 0
        while start < len(known):  # in groups of a few AT_ONCE windows, or one text
            stop, size = start, 0
            while stop < len(known) and (stop == start or size < 4 * AT_ONCE * WINDOW):
                size += len(texts[known[stop]])
                stop += 1
            group = known[start:stop]
            cut = [cut_windows(texts[i].encode()) for i in group]
            p = self.probabilities(np.concatenate([c[0] for c in cut]))
            weights = np.concatenate([c[1] for c in cut])
            starts = np.concatenate(([0], np.cumsum([len(c[1]) for c in cut])[:-1]))
            mean = np.add.reduceat(p * weights[:, None], starts, axis=0) / np.add.reduceat(weights, starts)[:, None]
            best = mean.argmax(axis=1)
            for i, b, score in zip(group, best.tolist(), mean[np.arange(len(group)), best].tolist(), strict=True):
                languages[i], scores[i] = self.languages[b], min(1.0, score)
            start = stop
        return languages, scores


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut_windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Windows that cover a text, overlapping by the widest filter less one, and the bytes that each one adds."""
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(text) - WINDOW) // step) + 1)
    padded = np.zeros((n - 1) * step + WINDOW, dtype=np.uint8)
    padded[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    windows = np.lib.stride_tricks.as_strided(padded, (n, WINDOW), (step, 1))
    added = np.full(n, step, dtype=np.float32)
    added[-1] = len(text) - (n - 1) * step
    return windows, added


def remainder(id_col: str = "doc_id") -> Column:
    """The fold of a document: crc32 of its id as text, modulo 3 (no id: as of an empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(3))


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int) -> list[Row]:
    """lang and windows of the at most ``sample`` different eligible documents with the least hashes of id and text.

    A bound on the hash, from the number of labelled documents, leaves about twice the sample to sort: else
    every task would send its own least ``sample`` rows to the driver.
    """
    text, rank = F.col(text_col), F.shiftrightunsigned(F.xxhash64(id_col, text_col), 1)
    labelled = docs.filter(F.col(lang_col).isNotNull() & (remainder(id_col) != 1))
    share = min(1.0, (2 * sample + 100) / max(1, labelled.count()))
    room = F.greatest(F.length(text) - WINDOW, F.lit(0)) + 1
    windows = [F.substring(text, F.pmod(F.xxhash64("rank", F.lit(k)), room).cast("int") + 1, F.lit(WINDOW)) for k in range(SAMPLE_WINDOWS)]
    few = labelled.filter(text.isNotNull()).withColumn("rank", rank).filter(F.col("rank") <= int(share * ((1 << 63) - 1024)))
    return few.select("rank", F.col(lang_col).alias("lang"), F.array_distinct(F.array(*windows)).alias("windows")).dropDuplicates(["rank", "lang"]).orderBy("rank", "lang").limit(sample).collect()


def fit_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_DOCS) -> ByteCNN:
    """Train on windows of at most ``sample`` labelled documents outside the held-out fold; windows start anywhere in the text."""
    rows = training_rows(docs.select(id_col, text_col, lang_col), id_col, text_col, lang_col, sample)
    pairs = [(w.encode()[:WINDOW].ljust(WINDOW, b"\0"), r.lang) for r in rows for w in r.windows if LETTER.search(w)]
    model = ByteCNN(sorted({lang for _, lang in pairs}))
    if pairs:
        number = {lang: i for i, lang in enumerate(model.languages)}
        model.fit(np.frombuffer(b"".join(w for w, _ in pairs), dtype=np.uint8).reshape(-1, WINDOW), np.array([number[lang] for _, lang in pairs]))
    return model


def language_of(model: ByteCNN, text: Column) -> Column:
    """A struct column (lang_pred, score) predicted from a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            languages, scores = model.predict([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame({"lang_pred": languages, "score": scores})

    return predict(text)


def identify_languages(docs: DataFrame, model: ByteCNN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document. One pass, no shuffle."""
    ship_package(docs.sparkSession)
    found = docs.select(F.col(id_col).alias("doc_id"), language_of(model, F.col(text_col).cast("string")).alias("found"))
    return found.select("doc_id", (remainder("doc_id") == 1).alias("held_out"), "found.lang_pred", "found.score")


def keep_identified(docs: DataFrame, model: ByteCNN, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """Documents whose language is found with a score of ``least`` or more; ``und`` ones and those below go."""
    ship_package(docs.sparkSession)
    found = "found"
    while found in docs.columns:
        found += "_"
    marked = docs.withColumn(found, language_of(model, F.col(text_col).cast("string")))
    return marked.filter((F.col(f"{found}.lang_pred") != UNKNOWN) & (F.col(f"{found}.score") >= least)).select(*docs.columns)
