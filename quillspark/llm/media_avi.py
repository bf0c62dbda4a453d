"""AVI motion-JPEG columns: write and parse RIFF files, decode intra frames, detect shots.

Frames are lossless JPEG (process 14: predictor 1, 8-bit grey samples, one Huffman table), so
stored samples come back exactly. Each frame is a JPEG file of its own in a ``00dc`` chunk; the
``idx1`` index gives every frame's place. Coding and decoding run over many frames in step with
numpy: one symbol of every frame at a time. Baseline DCT frames, as cameras write them, are read as
well, by their brightness; those files are decoded a bounded number of frames at a time.

Shots: the differences of neighbouring frames' histograms; a cut is where a difference stands out
from those around it (mean plus a multiple of the deviation) and passes a floor. Shots are timed
clips at the file's frame rate.

Null texts count as empty; an empty text gives one frame. Texts of any length are stored whole.
Equal texts give equal files. Repeated rows repeat in the result. An empty table gives an empty
result. Columns other than id and text, or id and media, are not looked at.

Index entries may count from the file's start or from its ``movi`` list. Media that cannot be
read (no AVI file, cut short, broken, or frames of another coding than lossless grey and baseline
DCT) give one row with a null result and the reason in ``error``; they harm no other row.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.llm import jpeg_dct
from quillspark.llm.common import rebatched, ship_package, utf8_texts

SIDE = 24
FRAME = SIDE * SIDE
PAD = 255
RATE = 25
BINS = 32
#: Bytes of text whose frames are coded together.
CHUNK = 2 << 20
#: Length of the Huffman code of each magnitude category 0 to 8 (short for the jumps between letters and between letter and space).
CODE_LENGTHS = (4, 5, 4, 3, 2, 3, 4, 3, 6)


def huffman_table(lengths: tuple[int, ...]) -> tuple[bytes, list[int], list[int]]:
    """The DHT counts, the symbols by length, and each symbol's canonical code."""
    symbols = sorted(range(len(lengths)), key=lambda s: (lengths[s], s))
    code, last, codes = 0, 0, [0] * len(lengths)
    for s in symbols:
        code <<= lengths[s] - last
        codes[s], last = code, lengths[s]
        code += 1
    if code > (1 << last) - 1:
        raise ValueError("the lengths leave no unused code of ones")
    return bytes(lengths.count(n) for n in range(1, 17)), symbols, codes


def frame_header() -> bytes:
    """SOI, DHT, SOF3 and SOS of every frame that is written."""
    counts, symbols, _ = huffman_table(CODE_LENGTHS)
    dht = b"\x00" + counts + bytes(symbols)
    return (
        b"\xff\xd8\xff\xc4" + struct.pack(">H", len(dht) + 2) + dht
        + b"\xff\xc3" + struct.pack(">HBHHB", 11, 8, SIDE, SIDE, 1) + b"\x01\x11\x00"
        + b"\xff\xda" + struct.pack(">HB", 8, 1) + b"\x01\x00\x01\x00\x00"
    )


@lru_cache(maxsize=1)
def encoder_tables() -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for each difference -255 to 255."""
    _, _, codes = huffman_table(CODE_LENGTHS)
    bits, sizes = np.zeros(511, dtype=np.uint32), np.zeros(511, dtype=np.int64)
    for d in range(-255, 256):
        n = abs(d).bit_length()
        bits[d + 255] = codes[n] << n | (d if d >= 0 else d + (1 << n) - 1)
        sizes[d + 255] = CODE_LENGTHS[n] + n
    return bits, sizes


@lru_cache(maxsize=64)
def parse_header(header: bytes) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Height, width, and for each 16 bits ahead the difference and the bits that it takes."""
    at, shape, code_lengths = 2, None, {}
    if header[:2] != b"\xff\xd8":
        raise ValueError("a frame does not start with SOI")
    while at < len(header):
        marker, size = struct.unpack_from(">HH", header, at)
        body = header[at + 4 : at + 2 + size]
        if marker == 0xFFC4:
            counts = body[1:17]
            symbols = iter(body[17:])
            code_lengths = [(next(symbols), n) for n in range(1, 17) for _ in range(counts[n - 1])]
        elif marker == 0xFFC3:
            precision, height, width, parts = struct.unpack_from(">BHHB", body)
            if (precision, parts) != (8, 1):
                raise ValueError("only one component of 8 bits is read")
            shape = height, width
        elif marker == 0xFFDA and body[3] != 1:
            raise ValueError("only predictor 1 is read")
        elif marker not in (0xFFDA, 0xFFE0, 0xFFFE):
            raise ValueError(f"marker {marker:04x} is not read")
        at += 2 + size
    if shape is None or not code_lengths:
        raise ValueError("a frame has no SOF3 or DHT")
    values, taken = np.zeros(1 << 16, dtype=np.int16), np.zeros(1 << 16, dtype=np.uint8)
    code, last = 0, 0
    for category, n in code_lengths:
        code <<= n - last
        last = n
        extra = np.arange(1 << category)
        if n + category > 16:
            raise ValueError("codes of over 16 bits are not read")
        difference = extra if category == 0 else np.where(extra >> (category - 1), extra, extra - (1 << category) + 1)
        low = 16 - n - category
        span = slice(code << (16 - n), (code + 1) << (16 - n))
        values[span], taken[span] = np.repeat(difference, 1 << low), n + category
        code += 1
    return *shape, values, taken


def encode_frames(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded, stuffed scans of frames (n, 24, 24) laid end to end, and each one's length."""
    n = len(samples)
    x = samples.astype(np.int16)
    differences = np.empty_like(x)
    differences[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
    differences[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
    differences[:, 0, 0] = x[:, 0, 0] - 128
    bits, sizes = encoder_tables()
    index = (differences.reshape(n, FRAME) + 255).astype(np.intp)
    size = sizes[index]
    ends = np.cumsum(size, axis=1)
    lengths = (ends[:, -1] + 7) >> 3
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    at = (ends - size + 8 * first[:, None]).ravel()
    word = bits[index].ravel() << (24 - (at & 7) - size.ravel()).astype(np.uint32)
    byte, total = at >> 3, int(lengths.sum())
    packed = np.zeros(total + 2, dtype=np.uint8)
    for k in range(3):  # codes do not overlap, so adding is setting bits
        part = np.bincount(byte + k, weights=(word >> np.uint32(16 - 8 * k)) & np.uint32(255), minlength=total + 2)
        packed += part.astype(np.uint8)
    packed = packed[:total]
    last = first + lengths - 1
    packed[last] |= ((1 << ((8 * lengths - ends[:, -1]))) - 1).astype(np.uint8)  # padding by ones
    marks = packed == 255
    stuffed = np.repeat(packed, marks.astype(np.int64) + 1)
    stuffed[np.flatnonzero(marks) + np.arange(1, int(marks.sum()) + 1)] = 0
    return stuffed, lengths + np.add.reduceat(marks, first, dtype=np.int64)


def decode_frames(scans: np.ndarray, starts: np.ndarray, lengths: np.ndarray, header: bytes) -> np.ndarray:
    """Samples (n, height, width) of frames whose stuffed scans lie at ``starts`` in ``scans``."""
    height, width, values, taken = parse_header(header)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    data = scans[shift + np.arange(int(lengths.sum()))]
    stuffing = np.zeros(len(data), dtype=bool)
    stuffing[1:] = (data[1:] == 0) & (data[:-1] == 255)
    fronts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    bare = lengths - np.add.reduceat(stuffing, fronts, dtype=np.int64)
    data = np.concatenate((data[~stuffing], np.full(4, 255, dtype=np.uint8))).astype(np.uint32)
    ahead = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    at = 8 * np.concatenate(([0], np.cumsum(bare)[:-1]))
    ends = at + 8 * bare
    out = np.empty((height * width, len(starts)), dtype=np.int16)
    top = len(ahead) - 1
    for k in range(height * width):
        peek = (ahead[np.minimum(at >> 3, top)] >> (8 - (at & 7)).astype(np.uint32)) & np.uint32(0xFFFF)
        out[k] = values[peek]
        at += taken[peek]
    if (at > ends).any() or (ends - at >= 8).any():
        raise ValueError("a scan does not end where its frame ends")
    x = out.T.reshape(-1, height, width)
    x[:, 0, 0] += 128
    x[:, :, 0] = np.cumsum(x[:, :, 0], axis=1)
    return np.cumsum(x, axis=2, dtype=np.int16).astype(np.uint8)


def chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def avi_header(frames: int, largest: int) -> bytes:
    avih = struct.pack("<10I16x", 1_000_000 // RATE, largest * RATE, 0, 0x10, frames, 0, 1, largest, SIDE, SIDE)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, RATE, 0, frames, largest, 0xFFFFFFFF, 0, 0, 0, SIDE, SIDE)
    strf = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", FRAME, 0, 0, 256, 0)
    return chunk(b"LIST", b"hdrl" + chunk(b"avih", avih) + chunk(b"LIST", b"strl" + chunk(b"strh", strh) + chunk(b"strf", strf)))


def write_files(payloads: list[np.ndarray]) -> list[bytes]:
    """An AVI file for each payload of whole frames of 8-bit samples."""
    counts = [len(p) // FRAME for p in payloads]
    scans, lengths = encode_frames(np.concatenate(payloads).reshape(-1, SIDE, SIDE))
    header = np.frombuffer(frame_header(), dtype=np.uint8)
    h = len(header)
    sizes = lengths + h + 2
    spans = 8 + sizes + (sizes & 1)
    at = np.concatenate(([0], np.cumsum(spans)[:-1]))
    movi = np.zeros(int(spans.sum()), dtype=np.uint8)
    movi[at[:, None] + np.arange(4)] = np.frombuffer(b"00dc", dtype=np.uint8)
    movi[at[:, None] + np.arange(4, 8)] = sizes.astype("<u4").view(np.uint8).reshape(-1, 4)
    movi[at[:, None] + np.arange(8, 8 + h)] = header
    body = at + 8 + h
    movi[np.repeat(body - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(len(scans))] = scans
    movi[body + lengths], movi[body + lengths + 1] = 0xFF, 0xD9
    files, f = [], 0
    for n in counts:
        start, stop = int(at[f]), int(at[f + n - 1] + spans[f + n - 1])
        index = np.zeros((n, 4), dtype="<u4")
        index[:, 0], index[:, 1] = int.from_bytes(b"00dc", "little"), 0x10
        index[:, 2], index[:, 3] = at[f : f + n] - start + 4, sizes[f : f + n]
        body = b"AVI " + avi_header(n, int(sizes[f : f + n].max())) + chunk(b"LIST", b"movi" + movi[start:stop].tobytes()) + chunk(b"idx1", index.tobytes())
        files.append(b"RIFF" + struct.pack("<I", len(body)) + body)
        f += n
    return files


def parse_index(file: bytes) -> tuple[np.ndarray, np.ndarray, float]:
    """Where each frame lies in an AVI file, its length, and the frame rate."""
    if file[:4] != b"RIFF" or file[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    at, movi, index, rate = 12, None, None, 0.0
    while at + 8 <= len(file):
        name, size = file[at : at + 4], int.from_bytes(file[at + 4 : at + 8], "little")
        if name == b"LIST" and file[at + 8 : at + 12] == b"hdrl":
            rate = 1_000_000 / int.from_bytes(file[at + 20 : at + 24], "little")
        elif name == b"LIST" and file[at + 8 : at + 12] == b"movi":
            movi = at + 8
        elif name == b"idx1":
            index = np.frombuffer(file, dtype="<u4", count=size // 4, offset=at + 8).reshape(-1, 4)
        at += 8 + size + (size & 1)
    if movi is None or index is None or not rate:
        raise ValueError("an AVI file without movi, idx1 or a frame rate")
    video = index[index[:, 0] == int.from_bytes(b"00dc", "little")]
    starts, lengths = video[:, 2].astype(np.int64), video[:, 3].astype(np.int64)
    if len(starts) and file[movi + starts[0] : movi + starts[0] + 4] == b"00dc":
        starts = starts + movi
    if len(starts) and ((starts + 8 + lengths).max() > len(file) or lengths.min() < 4 or any(file[a : a + 4] != b"00dc" for a in starts.tolist())):
        raise ValueError("the index points past the frames")
    return starts + 8, lengths, rate


def read_parts(files: list[bytes]) -> list[tuple[Iterable[np.ndarray], float]]:
    """Samples of each AVI file, read through its index, as arrays (frames, height, width), and its frame rate.

    Lossless frames of one header are decoded together whatever file they are of; files of DCT frames when their arrays are asked for.
    """
    places, groups, base = [], {}, 0
    joined = np.frombuffer(b"".join(files), dtype=np.uint8)
    out: list = []
    for number, file in enumerate(files):
        starts, lengths, rate = parse_index(file)
        parts: Iterable[np.ndarray] = []
        if len(starts):
            begin, first = int(starts[0]), file[int(starts[0]) : int(starts[0] + lengths[0])]
            *_, (_, _, h) = jpeg_dct.segments(first)
            if jpeg_dct.is_sequential(first):
                parts = jpeg_dct.decode([file[a : a + n] for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)])
            else:
                groups.setdefault(file[begin : begin + h], []).append(number)
        places.append((starts + base, lengths))
        out.append((parts, rate))
        base += len(file)
    for header, numbers in groups.items():
        starts = np.concatenate([places[i][0] for i in numbers])
        lengths = np.concatenate([places[i][1] for i in numbers])
        h = np.frombuffer(header, dtype=np.uint8)
        if (joined[starts[:, None] + np.arange(len(h))] != h).any() or (joined[starts + lengths - 1] != 0xD9).any():
            raise ValueError("frames of one file differ in their headers, or a frame has no EOI")
        samples = decode_frames(joined, starts + len(h), lengths - len(h) - 2, header)
        f = 0
        for i in numbers:
            n = len(places[i][0])
            out[i] = [samples[f : f + n]], out[i][1]
            f += n
    return out


def read_files(files: list[bytes]) -> list[tuple[np.ndarray, float]]:
    """All samples (frames, height, width) and the frame rate of each AVI file."""
    return [(np.concatenate([np.zeros((0, SIDE, SIDE), dtype=np.uint8)] if not (own := list(parts)) else own), rate) for parts, rate in read_parts(files)]


class Summary(NamedTuple):
    """What is kept of a file's frames: their histograms and sums, the samples of a frame, and digests of all samples."""

    counts: np.ndarray
    sums: np.ndarray
    samples: int
    size: int
    sha256: str
    tail: bytes


def summary(parts: Iterable[np.ndarray]) -> Summary:
    counts, sums, samples, size, digest, tail = [np.zeros((0, BINS), dtype=np.int64)], [np.zeros(0, dtype=np.int64)], 1, 0, hashlib.sha256(), b""
    for frames in parts:
        if len(frames):
            payload = frames.tobytes()
            counts.append(histograms(frames))
            sums.append(frames.reshape(len(frames), -1).sum(axis=1, dtype=np.int64))
            samples, size, tail = frames[0].size, size + len(payload), (tail + payload[-32:])[-32:]
            digest.update(payload)
    return Summary(np.concatenate(counts), np.concatenate(sums), samples, size, digest.hexdigest(), tail)


def read_each(files: list[bytes | None]) -> list[tuple[Summary | None, float, str | None]]:
    """Summary, frame rate and error of each file. Files are decoded together; only if that fails, one by one."""
    there = [f for f in files if f is not None]
    try:
        found = iter([(summary(parts), rate, None) for parts, rate in read_parts(there)])
        return [(None, 0.0, "no media") if f is None else next(found) for f in files]
    except Exception as error:  # whatever broken bytes lead to, it must stay with its row
        if len(files) == 1:
            return [(None, 0.0, f"{type(error).__name__}: {error}")]
    return [x for f in files for x in read_each([f])]


def histograms(frames: np.ndarray) -> np.ndarray:
    """Counts of samples by brightness, (frames, BINS)."""
    n = len(frames)
    bins = frames.reshape(n, -1) // np.uint8(256 // BINS)
    return np.bincount((bins + BINS * np.arange(n)[:, None]).ravel(), minlength=n * BINS).reshape(n, BINS)


def shots(counts: np.ndarray, samples: int, window: int = 8, sigmas: float = 2.0, floor: float = 0.2) -> np.ndarray:
    """First frames of the shots in a sequence of histograms.

    The difference of two frames is the share of samples in other bins. A cut is where it
    passes ``floor`` and the mean plus ``sigmas`` deviations of the differences in the
    ``window`` frames on either side.
    """
    n = len(counts)
    if n < 2:
        return np.zeros(min(n, 1), dtype=np.int64)
    d = np.abs(np.diff(counts, axis=0)).sum(axis=1) / (2 * samples)
    sums, squares = np.concatenate(([0.0], np.cumsum(d))), np.concatenate(([0.0], np.cumsum(d * d)))
    i = np.arange(n - 1)
    a, b = np.maximum(i - window, 0), np.minimum(i + window + 1, n - 1)
    near = np.maximum(b - a - 1, 1)
    mean = (sums[b] - sums[a] - d) / near
    spread = np.sqrt(np.maximum((squares[b] - squares[a] - d * d) / near - mean * mean, 0))
    return np.concatenate(([0], np.flatnonzero((d >= floor) & (d > mean + sigmas * spread)) + 1))


def payload_of(text: bytes) -> np.ndarray:
    """A text's bytes padded to whole frames, at least one."""
    size = max(FRAME, -(-len(text) // FRAME) * FRAME)
    out = np.full(size, PAD, dtype=np.uint8)
    out[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    return out


def encode_avi(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: every whole text as an AVI file. One pass, no shuffle."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, 1, CHUNK):
            texts = [t or b"" for t in utf8_texts(batch.column(1))]
            files = write_files([payload_of(t) for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(files, pa.binary())], names=["doc_id", "n_bytes", "media"])

    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {dict(docs.dtypes)[id_col]}, n_bytes long, media binary")


def media_clips(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Timed clips of AVI files: doc_id, clip (from 0), start_s, end_s, frames, mean (brightness), error.

    Null media and files without frames give no clip; media that cannot be read give one row with only an error.
    """
    ship_package(media.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, 1, 2 * CHUNK):
            batch = batch.filter(batch.column(1).is_valid())
            rows: list[tuple] = []
            for row, (seen, rate, error) in enumerate(read_each(batch.column(1).to_pylist())):
                if seen is None:
                    rows.append((row, None, None, None, None, None, error))
                    continue
                cuts = shots(seen.counts, seen.samples).tolist()
                for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(seen.counts)][: len(cuts)], strict=True)):
                    rows.append((row, k, a / rate, b / rate, b - a, float(seen.sums[a:b].sum() / (seen.samples * (b - a))), None))
            at, *rest = zip(*rows, strict=True) if rows else ([],) * 7
            kinds = (pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.float64(), pa.string())
            arrays = [batch.column(0).take(pa.array(at, pa.int64()))] + [pa.array(c, t) for c, t in zip(rest, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "clip", "start_s", "end_s", "frames", "mean", "error"])

    schema = f"doc_id {dict(media.dtypes)[id_col]}, clip int, start_s double, end_s double, frames int, mean double, error string"
    return media.select(media[id_col].alias("doc_id"), media[media_col].alias("media")).mapInArrow(run, schema)


def media_digests(media: DataFrame) -> DataFrame:
    """What the stored files hold, read back: digests of payload and file, and the clips as a feature string.

    Takes the rows of ``encode_avi``. ``feature``: frames, frames per second, clips as start-end frames. ``error``: null, or why the
    media could not be read; then only the columns about the file itself are filled.
    """
    ship_package(media.sparkSession)

    def digests(file: bytes | None, seen: Summary | None, rate: float, error: str | None) -> tuple:
        stored = (len(file), hashlib.sha256(file).hexdigest()) if file is not None else (None, None)
        if seen is None:
            return None, None, None, *stored, None, None, error
        n, cuts = len(seen.counts), shots(seen.counts, seen.samples).tolist()
        clips = ",".join(f"{a}-{b}" for a, b in zip(cuts, [*cuts[1:], n][: len(cuts)], strict=True))
        return seen.size, seen.sha256, zlib.crc32(seen.tail), *stored, f"{n}f@{rate:g}:{clips}", len(cuts), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, 2, 2 * CHUNK):
            files = batch.column(2).to_pylist()
            rows = [digests(file, *found) for file, found in zip(files, read_each(files), strict=True)]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_clips", "error"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "n_bytes", *names])

    schema = f"doc_id {dict(media.dtypes)['doc_id']}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_clips int, error string"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)
