"""Byte-level BPE: exact encoding by backtracking, decoding by an offset table.

A pre-token is encoded from left to right. An Aho-Corasick automaton over the vocabulary
gives the longest token at each position; a token is accepted if it may stand beside its
predecessor (the pair-compatibility table: the two would come out of the merges as they
are), else the next shorter one is tried, and when none is left the predecessor is taken
back. Positions once left behind are never tried again, so the time is linear. The result
equals applying the merges by rank.

Pre-tokens recur, so each worker keeps a bounded cache of their ids. Decoding copies
spans of one blob of token bytes, found through an offset table.

Null texts are encoded as empty ones; empty texts have no ids. Texts of any length are
handled whole. Repeated rows give repeated results and an empty table an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quillspark.llm.common import rebatched, ship_package

#: The white space of Unicode, which the pre-tokenizer's \s stands for.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The pre-tokenizer's pattern of the public byte-level vocabulary.
PRETOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Cached pre-tokens of a worker; the cache is emptied when it is full.
CACHED = 400_000


def printable_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Visible Latin-1 characters stand for themselves, the other bytes in ascending order
    for the characters from U+0100 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(visible))
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BacktrackingBPE:
    """An encoder and decoder for a ``tokenizers`` file of a byte-level BPE model whose ids follow the merge ranks."""

    def __init__(self, file: bytes) -> None:
        spec = json.loads(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("not a byte-level BPE file")
        to_byte = printable_bytes()
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items() if t not in self.special}
        names |= {i: t.encode() for t, i in self.special.items()}
        self.tokens = [names.get(i, b"") for i in range(max(names) + 1)]
        # pair -> merged id, and each token's two parts (bytes are their own parts)
        self.merged: dict[tuple[int, int], int] = {}
        self.parts = [(i, i) for i in range(len(self.tokens))]
        last = -1
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pair, whole = (vocab[a], vocab[b]), vocab[a + b]
            if whole <= last:
                raise ValueError("ids do not follow the merge ranks")
            last = self.merged[pair] = whole
            self.parts[whole] = pair
        by_bytes = {self.tokens[i]: i for t, i in vocab.items() if t not in self.special}
        self.automaton = ahocorasick.Automaton()
        for token, i in by_bytes.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        self.automaton.make_automaton()
        # the longest shorter token that a token begins with, -1 for none
        self.shorter = [-1] * len(self.tokens)
        for token, i in by_bytes.items():
            self.shorter[i] = next((by_bytes[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in by_bytes), -1)
        self.compatible: dict[tuple[int, int], bool] = {}
        self.pattern = regex.compile(PRETOKEN)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.lengths, self.starts = lengths, np.concatenate(([0], np.cumsum(lengths)[:-1]))
        self.blob = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.cache = _Cache(self)

    def may_stand(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` as two neighbours.

        Undo the merges at the border from the latest to the earliest; if the parts that meet
        there could have been merged before the border's tokens were made, they would have been.
        """
        known = self.compatible.get((left, right))
        if known is not None:
            return known
        a, b, limit, result = left, right, len(self.tokens) + 1, None
        while result is None:
            whole = self.merged.get((a, b))
            if whole is not None and whole < limit:
                result = False
            elif a > b:
                inner = self.parts[a][1]
                if inner != a:
                    limit, a = a, inner
                elif self.parts[b][0] != b:
                    limit, b = b + 1, self.parts[b][0]
                else:
                    result = True
            else:
                inner = self.parts[b][0]
                if inner != b:
                    limit, b = b + 1, inner
                elif self.parts[a][1] != a:
                    limit, a = a, self.parts[a][1]
                else:
                    result = True
        if len(self.compatible) >= 4 * CACHED:
            self.compatible.clear()
        self.compatible[left, right] = result
        return result

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one pre-token."""
        n = len(word)
        longest: list[int] = [-1] * n
        sizes = [0] * n
        for end, (size, token) in self.automaton.iter(word.decode("latin-1")):
            start = end - size + 1
            if size > sizes[start]:
                sizes[start], longest[start] = size, token
        ids: list[int] = []
        open_at = [True] * (n + 1)
        at, token = 0, longest[0] if n else -1
        while at < n:
            end = at + len(self.tokens[token])
            if open_at[end] and (not ids or self.may_stand(ids[-1], token)):
                ids.append(token)
                at = end
                token = longest[at] if at < n else -1
                continue
            token = self.shorter[token]
            while token < 0:
                open_at[at] = False
                if not ids:
                    raise ValueError("a byte is missing from the vocabulary")
                back = ids.pop()
                at -= len(self.tokens[back])
                token = self.shorter[back]
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        lookup = self.cache.__getitem__
        if self.split_special is None or not any(s in text for s in self.special):
            return b"".join(map(lookup, self.pattern.findall(text)))
        pieces = []
        for piece in self.split_special.split(text):
            if piece in self.special:
                pieces.append(self.special[piece].to_bytes(4, "little"))
            elif piece:
                pieces.extend(map(lookup, self.pattern.findall(piece)))
        return b"".join(pieces)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for: spans of the blob, by the offset table."""
        ids = ids.astype(np.int64, copy=False)
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        if not len(ids) or not ends[-1]:
            return b""
        shift = self.starts[ids] - (ends - sizes)
        return self.blob[np.repeat(shift, sizes) + np.arange(ends[-1])].tobytes()

    def decode(self, ids: np.ndarray, step: int = 1 << 20) -> str:
        """Ids back to text; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(self.decode_bytes(ids[i : i + step]) for i in range(0, len(ids), step)).decode("utf-8", "replace")


class _Cache(dict):
    """Ids of pre-tokens as bytes, made when first asked for."""

    def __init__(self, coder: BacktrackingBPE) -> None:
        super().__init__()
        self.coder = coder

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.coder.encode_word(word.encode()), dtype="<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def coder_of(file: bytes) -> BacktrackingBPE:
    return BacktrackingBPE(file)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Encode every whole text and decode it again.

    ``vocabulary`` is the path of a ``tokenizers`` file on the driver; its bytes (about 2 MB) are
    broadcast. Returns doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit; absent with
    ``keep_ids=False``), ids_sha256, decoded_sha256, round_trip (decoding gave the text back).
    No shuffle: one pass over the input's partitions.
    """
    with open(vocabulary, "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    ship_package(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(file.value)
        for batch in rebatched(batches, 1):
            out: list[list] = [[], [], [], [], []]
            for value in batch.column(1):
                text = value.as_py() or ""
                ids = coder.encode(text)
                decoded = coder.decode(np.frombuffer(ids, dtype="<u4"))
                out[0].append(len(ids) // 4)
                out[1].append(ids)
                out[2].append(hashlib.sha256(ids).hexdigest())
                out[3].append(hashlib.sha256(decoded.encode()).hexdigest())
                out[4].append(decoded == text)
            columns = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.string()), pa.array(out[3], pa.string()), pa.array(out[4], pa.bool_())]
            names = ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256", "round_trip"]
            if not keep_ids:
                del columns[2], names[2]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, n_tokens long, " + "ids binary, " * keep_ids + "ids_sha256 string, decoded_sha256 string, round_trip boolean"
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(encode, schema)
