"""Baseline JPEG frames (sequential DCT, Huffman, 8 bits): the brightness of many frames, decoded in step with numpy.

A lane is one run of entropy-coded data between restart markers. All lanes of frames of one layout
go forward together, one symbol of each at a time. Only the first component (brightness, or grey)
is rebuilt; the others are read over. Frames without Huffman tables use the customary ones, as
motion-JPEG files do. Frames of any other kind, or with broken data, raise ValueError.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np

#: Coefficients of the frames that are decoded together.
TOGETHER = 1 << 25
#: Symbols of each lane between two looks for lanes that have ended.
STRIDE = 256

# The Huffman tables of frames without their own, from the JPEG standard's annex K: codes of each
# length, then symbols. The symbols of the AC tables that are not listed follow in ascending order.
DC_LUMA = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0), bytes(range(12))
DC_CHROMA = (0, 3, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0), bytes(range(12))
AC_LUMA = (
    (0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125),
    bytes.fromhex("01 02 03 00 04 11 05 12 21 31 41 06 13 51 61 07 22 71 14 32 81 91 a1 08 23 42 b1 c1 15 52 d1 f0 24 33 62 72 82"),
)
AC_CHROMA = (
    (0, 2, 1, 2, 4, 4, 3, 4, 7, 5, 4, 4, 0, 1, 2, 119),
    bytes.fromhex("00 01 02 03 11 04 05 21 31 06 12 41 51 07 61 71 13 22 32 81 08 14 42 91 a1 b1 c1 09 23 33 52 f0 15 62 72 d1 0a 16 24 34 e1 25 f1"),
)


def with_rest(counts: Sequence[int], listed: bytes) -> bytes:
    """The body of a table: counts, listed symbols, and the other AC symbols (run 0-15, size 1-10; end; sixteen zeros)."""
    every = sorted([0x00, 0xF0, *(run << 4 | size for run in range(16) for size in range(1, 11))])
    return bytes(counts) + listed + bytes(s for s in every if s not in listed)


CUSTOMARY = {
    0x00: bytes(DC_LUMA[0]) + DC_LUMA[1],
    0x01: bytes(DC_CHROMA[0]) + DC_CHROMA[1],
    0x10: with_rest(*AC_LUMA),
    0x11: with_rest(*AC_CHROMA),
}


class Layout(NamedTuple):
    """What frames must share to be decoded together."""

    height: int
    width: int
    across: int  # blocks of brightness in a unit
    down: int
    pattern: tuple[tuple[int, bytes, bytes], ...]  # component, DC and AC table of each block of a unit
    restart: int  # units between restart markers, 0 for none


def zigzag() -> np.ndarray:
    """Place of each coefficient in its block, row by row, in the order in which they are sent."""
    cells = [(y, x) for y in range(8) for x in range(8)]
    cells.sort(key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    return np.array([8 * y + x for y, x in cells])


def segments(frame: bytes) -> Iterator[tuple[int, bytes, int]]:
    """Marker, body and end of each header segment, up to and with the start of the scan."""
    if frame[:2] != b"\xff\xd8":
        raise ValueError("a frame does not start with SOI")
    at = 2
    while at + 4 <= len(frame):
        if frame[at] != 0xFF:
            raise ValueError("a frame's header is broken")
        if frame[at + 1] == 0xFF:  # fill byte
            at += 1
            continue
        marker, size = struct.unpack_from(">HH", frame, at)
        end = at + 2 + size
        if size < 2 or end > len(frame):
            raise ValueError("a frame's header is cut short")
        yield marker, frame[at + 4 : end], end
        if marker == 0xFFDA:
            return
        at = end
    raise ValueError("a frame has no scan")


def is_sequential(frame: bytes) -> bool:
    """Whether a frame is of the kind that is read here."""
    return any(marker in (0xFFC0, 0xFFC1) for marker, _, _ in segments(frame))


@lru_cache(maxsize=64)
def parse_header(header: bytes) -> tuple[Layout, np.ndarray]:
    """Layout and the brightness's quantisation (row by row) of a frame that starts with this header."""
    huffman, quants, shape, parts, restart, order, scanned = dict(CUSTOMARY), {}, None, {}, 0, [], []
    for marker, body, _ in segments(header):
        if marker == 0xFFDB:
            while body:
                wide, key = body[0] >> 4, body[0] & 15
                size = 128 if wide else 64
                if len(body) < 1 + size:
                    raise ValueError("a quantisation table is cut short")
                quants[key] = np.frombuffer(body[1 : 1 + size], dtype=">u2" if wide else np.uint8).astype(np.float32)
                body = body[1 + size :]
        elif marker == 0xFFC4:
            while body:
                n = 17 + sum(body[1:17])
                if len(body) < n:
                    raise ValueError("a Huffman table is cut short")
                huffman[body[0]], body = body[1:n], body[n:]
        elif marker in (0xFFC0, 0xFFC1):
            precision, height, width, count = struct.unpack_from(">BHHB", body)
            if precision != 8 or not height or not width or len(body) < 6 + 3 * count:
                raise ValueError("only samples of 8 bits of a known size are read")
            shape, order = (height, width), [body[6 + 3 * i] for i in range(count)]
            parts = {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(count)}
        elif 0xFFC2 <= marker <= 0xFFCF and marker != 0xFFC8:
            raise ValueError(f"frames of marker {marker:04x} are not read")
        elif marker == 0xFFDD:
            restart = int.from_bytes(body[:2], "big")
        elif marker == 0xFFEE and body[:5] == b"Adobe" and body[11:12] == b"\0" and len(order) != 1:
            raise ValueError("frames without a brightness component are not read")
        elif marker == 0xFFDA:
            scanned = [(body[1 + 2 * i], body[2 + 2 * i]) for i in range(body[0])]
    if shape is None or [c for c, _ in scanned] != order or not order or any(not 1 <= s <= 4 for p in parts.values() for s in p[:2]):
        raise ValueError("only one scan of all components is read")
    across, down, key = parts[order[0]]
    if any(h > across or v > down for h, v, _ in parts.values()):
        raise ValueError("a component is finer than brightness")
    if key not in quants:
        raise ValueError("a quantisation table is missing")
    if len(order) == 1:
        across, down = 1, 1
    pattern = []
    for number, (name, tables) in enumerate(scanned):
        blocks = parts[name][0] * parts[name][1] if len(order) > 1 else 1
        dc, ac = huffman.get(tables >> 4), huffman.get(0x10 | tables & 15)
        if dc is None or ac is None:
            raise ValueError("a Huffman table is missing")
        pattern += [(number, dc, ac)] * blocks
    quant = np.empty(64, dtype=np.float32)
    quant[zigzag()] = quants[key]
    return Layout(*shape, across, down, tuple(pattern), restart), quant


@lru_cache(maxsize=64)
def symbols_ahead(table: bytes) -> np.ndarray:
    """For each 16 bits ahead: length of the code << 8 | symbol; 0 where no code fits."""
    out, code, place = np.zeros(1 << 16, dtype=np.uint16), 0, 16
    for n in range(1, 17):
        for _ in range(table[n - 1]):
            if code >= 1 << n:
                raise ValueError("a Huffman table has too many codes")
            out[code << (16 - n) : (code + 1) << (16 - n)] = n << 8 | table[place]
            code, place = code + 1, place + 1
        code <<= 1
    return out


def lanes_of(frame: bytes, start: int, layout: Layout, units: int) -> list[tuple[bytes, int]]:
    """The data between restart markers, without stuffing, and the units that each holds."""
    scan = frame[start:]
    end = re.search(rb"\xff+[^\x00\xff\xd0-\xd7]", scan)
    scan = scan[: end.start()] if end else scan
    pieces = re.split(rb"\xff+[\xd0-\xd7]", scan) if layout.restart else [scan]
    step = layout.restart or units
    if len(pieces) != -(-units // step):
        raise ValueError("a frame has other restart markers than its header says")
    return [(p.replace(b"\xff\x00", b"\xff"), min(step, units - i * step)) for i, p in enumerate(pieces)]


def coefficients(lanes: list[tuple[bytes, int]], layout: Layout) -> np.ndarray:
    """Brightness coefficients (blocks, 64), row by row in a block, of lanes laid end to end."""
    per_unit, bright = len(layout.pattern), layout.across * layout.down
    data = np.frombuffer(b"".join(d for d, _ in lanes) + b"\xff" * 4, dtype=np.uint8).astype(np.uint32)
    ahead = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    top = len(ahead) - 1
    distinct = sorted({t for _, dc, ac in layout.pattern for t in (dc, ac)})
    tables = np.concatenate([symbols_ahead(t) for t in distinct])
    place = [[distinct.index(t) << 16 for t in (dc, ac)] for _, dc, ac in layout.pattern]
    table_of = np.array(place).ravel()
    part_of = np.array([p for p, _, _ in layout.pattern])
    sizes = np.array([8 * len(d) for d, _ in lanes])
    units = np.array([u for _, u in lanes])
    at = np.cumsum(sizes) - sizes
    ends, first, left = at + sizes, (np.cumsum(units) - units) * bright, units * per_unit
    spare = int(units.sum()) * bright  # other components and lanes that have ended write to one spare block
    out = np.zeros((spare + 1) * 64, dtype=np.int16)
    order = np.concatenate((zigzag(), np.zeros(16, dtype=np.int64)))
    block, k = np.zeros(len(lanes), dtype=np.int64), np.zeros(len(lanes), dtype=np.int64)
    before = np.zeros((len(lanes), int(part_of.max()) + 1), dtype=np.int64)
    while len(at):
        rows = np.arange(len(at))
        for _ in range(STRIDE):
            live = block < left
            u = block % per_unit
            dc = k == 0
            peek = (ahead[np.minimum(at >> 3, top)] >> (8 - (at & 7)).astype(np.uint32)) & np.uint32(0xFFFF)
            found = tables[table_of[2 * u + ~dc] + peek].astype(np.int64)
            if (live & (found == 0)).any():
                raise ValueError("a scan holds no code of its tables")
            symbol = found & 255
            size = symbol & 15
            run = np.where(dc, 0, symbol >> 4)
            behind = at + (found >> 8)
            extra = (ahead[np.minimum(behind >> 3, top)] >> (24 - (behind & 7) - size).astype(np.uint32)).astype(np.int64) & ((1 << size) - 1)
            value = np.where((extra << 1) >> size, extra, extra - (1 << size) + 1)
            part = part_of[u]
            value = np.where(dc, before[rows, part] + value, value)
            before[rows, part] = np.where(dc, value, before[rows, part])
            k_at = k + run
            writes = live & (dc | (size > 0)) & (part == 0)
            if (live & (size > 0) & (k_at > 63)).any():
                raise ValueError("a block holds more than 64 coefficients")
            target = np.where(writes, first + block // per_unit * bright + u, spare)
            out[64 * target + order[np.minimum(k_at, 79)]] = value
            done = ~dc & (size == 0) & (run < 15)
            k = np.where(done, 64, k_at + 1)
            at = np.where(live, behind + size, at)
            ended = k > 63
            block = block + (ended & live)
            k[ended] = 0
        over = block >= left
        if (at > ends).any():
            raise ValueError("a scan ends before its frame")
        if over.any():
            keep = ~over
            at, ends, first, left, block, k, before = at[keep], ends[keep], first[keep], left[keep], block[keep], k[keep], before[keep]
    return out[: 64 * spare].reshape(-1, 64)


@lru_cache(maxsize=1)
def inverse_transform() -> np.ndarray:
    """The 64 x 64 matrix from a block's coefficients to its samples."""
    n = np.arange(8)
    wave = np.cos((2 * n[None, :] + 1) * n[:, None] * np.pi / 16) * np.where(n == 0, np.sqrt(1 / 8), 0.5)[:, None]
    return np.kron(wave, wave).astype(np.float32)


def decode_alike(frames: list[tuple[bytes, int, np.ndarray]], layout: Layout) -> np.ndarray:
    """Brightness (n, height, width) of frames of one layout, each with its scan's start and quantisation."""
    wide, high = -(-layout.width // (8 * layout.across)), -(-layout.height // (8 * layout.down))
    lanes = [lane for frame, start, _ in frames for lane in lanes_of(frame, start, layout, wide * high)]
    blocks = coefficients(lanes, layout).reshape(len(frames), -1, 64)
    samples = np.empty(blocks.shape, dtype=np.uint8)
    for out, sent, (_, _, quant) in zip(samples, blocks, frames, strict=True):
        out[:] = np.clip(np.rint((sent * quant) @ inverse_transform() + 128), 0, 255)
    grid = samples.reshape(len(frames), high, wide, layout.down, layout.across, 8, 8).transpose(0, 1, 3, 5, 2, 4, 6)
    return grid.reshape(len(frames), high * layout.down * 8, -1)[:, : layout.height, : layout.width]


def decode(frames: list[bytes]) -> Iterator[np.ndarray]:
    """Brightness (n, height, width) of frames in their order, a bounded number of samples at a time."""
    batch: list[tuple[bytes, int, np.ndarray]] = []
    last: Layout | None = None
    for frame in frames:
        *_, (_, _, start) = segments(frame)
        layout, quant = parse_header(frame[:start])
        if last is not None and layout[:2] != last[:2]:
            raise ValueError("frames of one file differ in size")
        units = -(-layout.width // (8 * layout.across)) * -(-layout.height // (8 * layout.down))
        if batch and (layout != last or (len(batch) + 1) * units * layout.across * layout.down * 64 > TOGETHER):
            yield decode_alike(batch, last)
            batch = []
        batch.append((frame, start, quant))
        last = layout
    if batch:
        yield decode_alike(batch, last)
