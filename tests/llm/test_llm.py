"""The operators of the llm subpackage against brute force, round trips and held-out accuracy, on small hard inputs."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quillspark.llm import bpe, common, jpeg_dct, lang_cnn, line_templates, media_avi, mixing, near_copies, packing, queries, sharding, simhash, topk, url_rules

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, slot int, found int, _slot int, _dropped int"
VOCABULARY, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
LONG = "the weight of a very long text " * 4000


def rows(*texts, start=0):
    """Documents with columns whose names the operators use themselves."""
    return [(start + i, t, "en", "s", len(t or ""), "x", 7, 8, 9, 10) for i, t in enumerate(texts)]


HARD = rows(None, "", " \n\t ", "One line here.", "One line here.", "ÄÖÜ 漢字 🌾 <|endoftext|> x", "!!! 123", LONG, "a\n\n\nb c d e f\r\n") + [(None, "no id", *[None] * 8)] * 2 + rows("One line here.", start=3)


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(HARD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- helpers


def test_even_join_equals_join(spark, monkeypatch):
    monkeypatch.setattr(common, "UNIT", 4)
    monkeypatch.setattr(common, "MOST_HOT", 8)
    left = spark.createDataFrame([(1 if i % 3 == 0 else None if i % 7 == 0 else i % 20, i % 2, i) for i in range(300)], "k long, j int, v long")
    right = left.filter("k <> 5").groupBy("k", "j").count()
    for how in ("inner", "left"):
        got = common.even_join(left, right, ["k", "j"], "count", 300, F.monotonically_increasing_id(), how)
        assert sorted(map(str, got.select("k", "j", "v", "count").collect())) == sorted(map(str, left.join(right, ["k", "j"], how).select("k", "j", "v", "count").collect()))
    assert common.even_join(left.limit(0), right, ["k", "j"], "count", 0, F.col("v"), "left").count() == 0


def test_expanded(spark, monkeypatch):
    monkeypatch.setattr(common, "RUN", 3)
    frame = spark.createDataFrame([("a", 1), ("b", 3), ("c", 10)], "x string, n long")
    assert sorted((r.x, r.i) for r in common.expanded(frame, "n", "i", ["x"]).collect()) == [("a", 0), *(("b", i) for i in range(3)), *(("c", i) for i in range(10))]


# --- 1 media


def test_media_round_trip():
    rng = random.Random(1)
    texts = [b"", b"a", bytes(range(256)) * 5, b"\xff" * 1200, bytes(rng.randrange(256) for _ in range(3000)), bytes(rng.choice([0, 255]) for _ in range(2000))]
    payloads = [media_avi.payload_of(t) for t in texts]
    files = media_avi.write_files(payloads)
    for text, payload, file, (frames, rate) in zip(texts, payloads, files, media_avi.read_files(files), strict=True):
        assert frames.tobytes() == payload.tobytes() == text.ljust(len(payload), b"\xff") and len(payload) % 576 == 0 and rate == 25
        assert media_avi.write_files([payload]) == [file]
    with pytest.raises(ValueError):
        media_avi.read_files([b"RIFF not an avi file"])


def test_media_query(hard, empty):
    out = media_avi.media_digests(media_avi.encode_avi(hard)).collect()
    texts = defaultdict(set)
    for r in HARD:
        texts[r[0]].add((r[1] or "").encode())
    assert len(out) == len(HARD)
    for r in out:
        payloads = {t.ljust(max(576, -(-len(t) // 576) * 576), b"\xff") for t in texts[r.doc_id]}
        assert (r.payload_sha256, r.tail_crc32, r.payload_bytes) in {(hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(p)) for p in payloads}
        (text,) = [t for t in texts[r.doc_id] if len(t) == r.n_bytes] if len({len(t) for t in texts[r.doc_id]}) == len(texts[r.doc_id]) else [None]
        if text is not None:
            (file,) = media_avi.write_files([media_avi.payload_of(text)])
            counts = np.stack([np.bincount(f // 8, minlength=32) for f in np.frombuffer(text.ljust(r.payload_bytes, b"\xff"), np.uint8).reshape(-1, 576)])
            cuts = plain_shots(counts)
            clips = ",".join(f"{a}-{b}" for a, b in zip(cuts, [*cuts[1:], len(counts)]))
            assert (r.media_bytes, r.media_sha256, r.feature, r.n_clips, r.error) == (len(file), hashlib.sha256(file).hexdigest(), f"{len(counts)}f@25:{clips}", len(cuts), None)
    assert media_avi.media_digests(media_avi.encode_avi(empty)).count() == 0


def plain_shots(counts):
    """Cuts by the rule as it is written, one difference after the other."""
    d = [sum(abs(int(a) - int(b)) for a, b in zip(x, y)) / 1152 for x, y in zip(counts, counts[1:])]
    cuts = [0]
    for i, x in enumerate(d):
        near = d[max(i - 8, 0) : i] + d[i + 1 : i + 9]
        mean = sum(near) / max(len(near), 1)
        spread = math.sqrt(max(sum(v * v for v in near) / max(len(near), 1) - mean * mean, 0))
        if x >= 0.2 and x > mean + 2 * spread:
            cuts.append(i + 1)
    return cuts


def plain_frames(file):
    """A second decoder, bit by bit: chunks in file order, tables from the frame itself, samples from the left (the first of a row from above)."""
    at, frames = 12, []

    def frame(data):
        i, codes, shape = 2, {}, None
        while True:
            marker, size = data[i + 1], int.from_bytes(data[i + 2 : i + 4], "big")
            body = data[i + 4 : i + 2 + size]
            if marker == 0xC4:
                code, place = 0, 17
                for n in range(16):
                    for _ in range(body[1 + n]):
                        codes[f"{code:0{n + 1}b}"] = body[place]
                        code, place = code + 1, place + 1
                    code <<= 1
            elif marker == 0xC3:
                shape = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            i += 2 + size
            if marker == 0xDA:
                break
        bits = "".join(f"{b:08b}" for b in data[i:].split(b"\xff\xd9")[0].replace(b"\xff\x00", b"\xff"))
        at, rows = 0, []
        for y in range(shape[0]):
            row = []
            for x in range(shape[1]):
                end = at + 1
                while bits[at:end] not in codes:
                    end += 1
                n = codes[bits[at:end]]
                extra, at = bits[end : end + n], end + n
                step = 0 if not n else int(extra, 2) if extra[0] == "1" else int(extra, 2) - (1 << n) + 1
                row.append(((row[-1] if x else rows[-1][0] if y else 128) + step) % 256)
            rows.append(row)
        return bytes(v for r in rows for v in r)

    while at < len(file):
        name, size = file[at : at + 4], int.from_bytes(file[at + 4 : at + 8], "little")
        if name == b"LIST" and file[at + 8 : at + 12] == b"movi":
            k = at + 12
            while k < at + 8 + size:
                n = int.from_bytes(file[k + 4 : k + 8], "little")
                frames.append(frame(file[k + 8 : k + 8 + n]))
                k += 8 + n + (n & 1)
        at += 8 + size + (size & 1)
    return b"".join(frames)


def test_media_against_a_second_decoder():
    rng = random.Random(8)
    for text in (b"", b"Plain text. " * 120, bytes(rng.randrange(256) for _ in range(1500)), "漢字 and ä".encode() * 40):
        payload = media_avi.payload_of(text)
        assert plain_frames(media_avi.write_files([payload])[0]) == payload.tobytes()


def java_jpeg(jvm, image):
    """A baseline JPEG by the JVM's encoder: (h, w) grey or (h, w, 3) colour, the latter with coarser colour than brightness."""
    h, w = image.shape[:2]
    java = jvm.java.awt.image.BufferedImage(w, h, 10 if image.ndim == 2 else 5)
    raster = java.getRaster()
    for (y, x, band), v in np.ndenumerate(image.reshape(h, w, -1)):
        raster.setSample(x, y, band, int(v))
    out = jvm.java.io.ByteArrayOutputStream()
    assert jvm.javax.imageio.ImageIO.write(java, "jpg", out)
    return bytes(out.toByteArray())


def java_brightness(jvm, data):
    java = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(bytearray(data)))
    samples = np.frombuffer(bytes(java.getRaster().getDataBuffer().getData()), np.uint8).reshape(java.getHeight(), java.getWidth(), -1)
    return samples[:, :, 0].astype(float) if samples.shape[2] == 1 else samples[:, :, ::-1] @ np.array([0.299, 0.587, 0.114])


def without_tables(data):
    at, out = 2, data[:2]
    for marker, _, end in jpeg_dct.segments(data):
        out, at = out + (b"" if marker == 0xFFC4 else data[at:end]), end
    return out + data[at:]


def avi_of(frames):
    """An AVI file of ready JPEG frames."""
    movi, index = b"movi", b""
    for f in frames:
        index += b"00dc" + np.array([16, len(movi), len(f)], "<u4").tobytes()
        movi += media_avi.chunk(b"00dc", f)
    body = b"AVI " + media_avi.avi_header(len(frames), max(map(len, frames))) + media_avi.chunk(b"LIST", movi) + media_avi.chunk(b"idx1", index)
    return b"RIFF" + np.uint32(len(body)).astype("<u4").tobytes() + body


def test_baseline_frames_equal_the_jvm_decoder(spark, monkeypatch):
    jvm, rng = spark._jvm, np.random.default_rng(1)
    y, x = np.mgrid[:21, :35]
    waves = (128 + 60 * np.sin(x / 4) + 40 * np.cos(y / 3)).astype(np.uint8)
    colour = np.stack([128 + 50 * np.sin(x / 7), 120 + 50 * np.cos(y / 5), 100 + x], -1).astype(np.uint8)
    frames = [java_jpeg(jvm, i) for i in (waves, rng.integers(0, 256, waves.shape), colour, waves[::-1])]
    for together in (1, 1 << 25):
        monkeypatch.setattr(jpeg_dct, "TOGETHER", together)
        found = np.concatenate(list(jpeg_dct.decode(frames)))
        assert found.shape == (4, 21, 35)
        for f, data, off in zip(found, frames, (1, 1, 2, 1), strict=True):
            assert np.abs(f - java_brightness(jvm, data)).max() <= off
    bare = without_tables(frames[2])
    assert len(bare) < len(frames[2]) and np.array_equal(*(next(jpeg_dct.decode([d])) for d in (bare, frames[2])))
    with pytest.raises(ValueError):
        list(jpeg_dct.decode([frames[0], java_jpeg(jvm, waves[:9])]))
    for cut in range(2, len(frames[0]) - 2, 7):  # no cut gives a frame or an error of another kind
        with pytest.raises((ValueError, IndexError)):
            list(jpeg_dct.decode([frames[0][:cut]]))


@pytest.mark.parametrize("interval", [0, 1, 2, 5])
def test_restart_markers(interval):
    """Flat blocks of known brightness, coded by hand with the customary tables."""
    levels, codes = [128, 0, 255, 127, 200, 200, 3], "00 010 011 100 101 110 1110 11110 111110".split()
    scan, pieces = "", []
    for i, v in enumerate(levels):
        if interval and i and i % interval == 0:
            pieces, scan = [*pieces, scan], ""
        d = v - (levels[i - 1] if scan else 128)
        n = abs(d).bit_length()
        scan += codes[n] + (f"{d if d > 0 else d + (1 << n) - 1:0{n}b}" if n else "") + "1010"
    bodies = [int(b.ljust(-(-len(b) // 8) * 8, "1"), 2).to_bytes(-(-len(b) // 8), "big").replace(b"\xff", b"\xff\0") for b in [*pieces, scan]]
    data = b"".join(b + bytes([0xFF, 0xD0 + i % 8]) for i, b in enumerate(bodies[:-1])) + bodies[-1]
    header = b"\xff\xd8\xff\xdb\0\x43\0" + b"\x08" * 64 + b"\xff\xc0\0\x0b\x08\0\x08\0\x38\x01\x01\x11\0\xff\xdd\0\x04" + bytes([0, interval]) + b"\xff\xda\0\x08\x01\x01\0\0\x3f\0"
    (found,) = jpeg_dct.decode([header + data + b"\xff\xd9"])
    assert found.shape == (1, 8, 56) and found[0].reshape(8, 7, 8).tolist() == [[[v] * 8 for v in levels]] * 8


def test_clips_of_baseline_files(spark):
    scenes = [java_jpeg(spark._jvm, np.full((16, 24), v, np.uint8)) for v in (20, 20, 220)]
    odd = java_jpeg(spark._jvm, np.full((24, 24), 9, np.uint8))
    media = [avi_of(scenes[:2] * 6 + scenes[2:] * 8), avi_of([scenes[0], odd]), media_avi.write_files([media_avi.payload_of(b"x" * 500)])[0], avi_of([scenes[0][:-30]])]
    frame = spark.createDataFrame([(i, len(m), m) for i, m in enumerate(media)], "doc_id long, n_bytes long, media binary")
    clips = sorted(((r.doc_id, r.clip, r.start_s, r.end_s, r.frames, r.error is None) for r in media_avi.media_clips(frame).collect()), key=str)
    assert clips[:2] == [(0, 0, 0.0, 0.48, 12, True), (0, 1, 0.48, 0.8, 8, True)]
    assert [(c[0], c[-1]) for c in clips[2:]] == [(1, False), (2, True), (3, False)]
    digests = {r.doc_id: r for r in media_avi.media_digests(frame).collect()}
    whole = media_avi.read_files(media[:1])[0][0]
    assert whole.shape == (20, 16, 24) and digests[0].payload_sha256 == hashlib.sha256(whole.tobytes()).hexdigest() and digests[0].feature == "20f@25:0-12,12-20"
    assert digests[0].tail_crc32 == zlib.crc32(whole.tobytes()[-32:]) and digests[0].payload_bytes == 20 * 384 and digests[1].error and digests[3].error


def test_broken_media_stay_with_their_row(spark):
    good = media_avi.write_files([media_avi.payload_of(b"some text " * 300)])[0]
    at = good.index(b"idx1") + 8
    index = np.frombuffer(good[at:], "<u4").reshape(-1, 4).copy()
    index[:, 2] += good.index(b"movi")  # offsets from the file's start
    absolute, past = good[:at] + index.tobytes(), good[:at] + (index + np.array([0, 0, 10**6, 0], np.uint32)).tobytes()
    frame = good.index(b"\xff\xd8\xff")
    baseline = good[: frame + 2] + good[frame + 2 :].replace(b"\xff\xc3", b"\xff\xc0")
    media = [good, None, b"", b"garbage", b"RIFF\x00\x00\x00\x00AVI ", good[:500], absolute, past, baseline, good[: frame + 40] + bytes(60) + good[frame + 100 :], good]
    frame = spark.createDataFrame([(i, len(m or b""), m) for i, m in enumerate(media)], "doc_id long, n_bytes long, media binary")
    out = {r.doc_id: r for r in media_avi.media_digests(frame).collect()}
    assert len(out) == len(media) and {i for i, r in out.items() if r.error is None} >= {0, 6, 10} and out[0].payload_sha256 == out[6].payload_sha256 == out[10].payload_sha256
    assert all(out[i].error is not None and out[i].payload_sha256 is None for i in (1, 2, 3, 4, 5, 7, 8))
    clips = media_avi.media_clips(frame).collect()
    assert {r.doc_id for r in clips if r.error} >= {2, 3, 4, 5, 7, 8} and all(r.clip is None for r in clips if r.error) and {r.doc_id for r in clips if r.clip == 0} >= {0, 6, 10}


def test_shots(hard):
    dark, light = np.full((20, 24, 24), 10, np.uint8), np.full((20, 24, 24), 200, np.uint8)
    assert media_avi.shots(media_avi.histograms(np.concatenate((dark, light, dark))), 576).tolist() == [0, 20, 40]
    assert media_avi.shots(media_avi.histograms(dark), 576).tolist() == [0]
    clips = media_avi.media_clips(media_avi.encode_avi(hard)).collect()
    for doc_id, n in Counter(r.doc_id for r in clips if r.clip == 0).items():
        own = sorted((r.clip, r.start_s, r.end_s) for r in clips if r.doc_id == doc_id) if n == 1 else []
        assert all(a[2] == b[1] for a, b in zip(own, own[1:], strict=False))


# --- 2 mixing


def brute_schedule(weights, blocks):
    """Slot by slot: of the blocks released by now, the one that is due first."""
    whole = sum(map(Fraction, weights.values()))
    share, sent, out, t = {s: Fraction(w) / whole for s, w in weights.items() if w > 0}, Counter(), {}, 0
    while any(sent[s] < blocks.get(s, 0) for s in share):
        ready = [(math.ceil((sent[s] + 1) / w), s) for s, w in share.items() if sent[s] < blocks.get(s, 0) and math.floor(sent[s] / w) <= t]
        if ready:
            s = min(ready)[1]
            out[s, sent[s]] = t
            sent[s] += 1
        t += 1
    return out


def test_mixed_places(real, hard, empty):
    weights = mixing.measured_weights(real)
    out = mixing.mixed_places(real, weights, block=4).collect()
    by_source = defaultdict(list)
    for r in out:
        by_source[r.source].append((r._slot, r._place))
    want = brute_schedule(weights, {s: -(-len(x) // 4) for s, x in by_source.items()})
    assert len(out) == real.count()
    for s, got in by_source.items():
        assert sorted(got) == [(want[s, i // 4], i) for i in range(len(got))]
    order = [(r.source, r.doc_id) for r in mixing.mix(real, weights, block=4).collect()]
    assert order == [(r.source, r.doc_id) for r in sorted(out, key=lambda r: (r._slot, r._place))]
    kept = mixing.mix(hard, {"s": 1.0}, block=2)
    assert kept.columns == hard.columns and sorted(map(str, kept.collect())) == sorted(map(str, hard.collect()))
    assert sorted(map(str, mixing.mix(hard, {}).collect())) == sorted(map(str, hard.collect()))
    assert mixing.mix(empty, mixing.measured_weights(empty)).count() == 0


def test_equal_rows_take_places_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(common, "RUN", 16)  # 200 copies are made in many runs
    rows_ = [(1, "x", "a", [1, None], {"k": "v"})] * 200 + [(i, "x", "b", [None, 1], {"k": None}) for i in range(50)] + [(1, "x", "a", [None, 1], {"k": "v"})] * 3 + [(None, None, None, None, None)] * 30
    docs = spark.createDataFrame(rows_, "doc_id long, text string, source string, xs array<int>, m map<string,string>").repartition(5)
    weights = {"a": 1.0, "b": 1e-5}
    out = mixing.mixed_places(docs, weights, block=4).collect()
    assert Counter(str(r[:5]) for r in out) == Counter(map(str, rows_))
    want = brute_schedule({"a": 1.0, "b": 0.02}, {"a": 51, "b": 13})
    for s, n in (("a", 203), ("b", 50), (None, 30)):
        assert sorted(r._place for r in out if r.source == s) == list(range(n))
    even = mixing.mixed_places(docs, {"a": 1.0, "b": 0.02}, block=4).collect()
    assert sorted((r.source, r._slot, r._place) for r in even if r.source) == sorted((s, want[s, i // 4], i) for s, n in (("a", 203), ("b", 50)) for i in range(n))
    assert {r._slot for r in out if r.source is None} == {None}
    firsts = sorted(r._slot for r in out if r.source == "b")[::4]
    assert firsts[1] >= 10**5  # a weight of 1/100001 gets no more than that


def test_blocks_grow_with_the_table(real, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 10)
    weights = mixing.measured_weights(real)
    out = mixing.mixed_places(real, weights, block=4).collect()
    assert len(out) == 200 and len(weights) == 20
    assert len(Counter(r._slot for r in out)) == 20  # blocks of 20 rows, so one for each source


def test_lag_to_exact_weights(spark, monkeypatch):
    weights = {f"s{i:02}": 1.0 for i in range(21)}  # shares that are no multiples of 1/1000
    sent, seen = Counter(), 0
    for s, n, slot in mixing.block_slots(weights, dict.fromkeys(weights, 500)):  # 10,500 slots
        assert n == sent[s] and slot == seen and n * 21 < (slot + 1) and slot < (n + 1) * 21
        sent[s], seen = n + 1, seen + 1
    assert seen == 21 * 500
    uneven = {s: float(i + 1) ** 0.7 for i, s in enumerate(weights)}
    whole = sum(map(Fraction, uneven.values()))
    for s, n, slot in mixing.block_slots(uneven, dict.fromkeys(weights, 300)):  # sources run out one after the other
        w = Fraction(uneven[s]) / whole
        assert math.floor(n / w) <= slot < math.ceil((n + 1) / w)
    monkeypatch.setattr(mixing, "PIECE", 1000)
    docs = spark.range(21 * 150).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.format_string("s%02d", F.col("id") % 21).alias("source"))
    out = mixing.mixed_places(docs, weights, block=1).collect()
    assert sorted(r._slot for r in out) == list(range(21 * 150))
    counts = Counter()
    for r in sorted(out, key=lambda r: r._slot):  # the drift shows where 1/21 is rounded to 48 of 1000 slots
        counts[r.source] += 1
        assert all(abs(counts[s] - (r._slot + 1) / 21) < 1 for s in weights)


def test_all_of_many_sources_are_mixed(spark):
    sizes = [2000] + [2] * 1500
    docs = spark.createDataFrame([(i, "x", f"s{s:04}") for s, n in enumerate(sizes) for i in range(n)], "doc_id long, text string, source string")
    weights = mixing.measured_weights(docs)
    out = mixing.mixed_places(docs, weights, block=1).collect()
    assert len(weights) == 1501 and len({r._slot for r in out}) == sum(sizes) and all(r._slot is not None for r in out)
    whole, nth = sum(map(Fraction, weights.values())), Counter()
    for r in sorted(out, key=lambda r: r._slot):
        w = Fraction(weights[r.source]) / whole
        assert math.floor(nth[r.source] / w) <= r._slot < math.ceil((nth[r.source] + 1) / w)
        nth[r.source] += 1
    assert mixing.mix(docs, dict.fromkeys(weights, 1.0)).count() == sum(sizes)


# --- 3 SimHash


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=4):
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= bits:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in fps}


def test_fingerprints_and_components(real, hard, empty):
    out = {r.doc_id: r for r in simhash.near_duplicates(real).collect()}
    fps = {r.doc_id: brute_fingerprint(r.text) for r in real.collect()}
    assert {i: r.fingerprint for i, r in out.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r.component_id for i, r in out.items()} == brute_components(fps)
    found = simhash.near_duplicates(hard).collect()
    assert len(found) == len(HARD) and {r.component_id for r in found if r.doc_id in (0, 1, 2)} == {0}
    assert simhash.near_duplicates(empty).count() == 0


def test_near_copies_equal_brute_force_jaccard(spark, hard, monkeypatch):
    rng = random.Random(11)
    texts = []
    for _ in range(30):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 200))]
        for _ in range(4):
            copy = list(words)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            texts.append(" ".join(copy))
    sets = [frozenset(zip(*(t.split()[k:] for k in range(5)), strict=False)) for t in texts]
    parent = list(range(len(texts)))
    far = 0
    fps = [brute_fingerprint(t) for t in texts]
    for a, b in combinations(range(len(texts)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            far += (fps[a] ^ fps[b]).bit_count() > 4
            low, high = sorted((parent[a], parent[b]))
            parent = [low if x == high else x for x in parent]
    frame = spark.createDataFrame(rows(*texts), SCHEMA)
    want = {i for i, root in enumerate(parent) if i == root}
    assert far > 20 and len(want) > 30  # pairs that four bits do not reach
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, frame, SF).collect()} == want
    monkeypatch.setattr(near_copies.set_links, "__defaults__", (2,))  # many blocks
    assert {r.doc_id for r in near_copies.without_near_copies(frame).collect()} == want
    ids = Counter(r.doc_id for r in near_copies.without_near_copies(hard).collect())
    assert ids[0] == 1 and ids[1] == ids[2] == ids[4] == 0 and ids[3] == 1 and ids[None] == 2


def test_near_copies_compare_by_key(spark):
    """A chain of texts that are alike by four tenths each: connected through keys, but few of them ever meet, and all stay."""
    rng = random.Random(3)
    words, texts = [f"w{rng.randrange(1 << 30)}" for _ in range(64)], []
    for _ in range(2000):
        texts.append(" ".join(words))
        words = words[26:] + [f"w{rng.randrange(1 << 30)}" for _ in range(26)]
    frame = spark.createDataFrame(rows(*texts), SCHEMA)
    sets = near_copies.with_sets(frame).select(F.col("doc_id").alias("set"), "bands")
    lists = near_copies.key_lists(sets)
    sizes = [r.n for r in lists.groupBy("k", "band").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(n * (n - 1) // 2 for n in sizes) < 4 * len(texts) and len(sizes) > 200
    assert near_copies.without_near_copies(frame).count() == len(texts)


def brute_bunches(places, prints):
    """Sets of places connected by few different bits."""
    left, found = set(places), []
    while left:
        bunch, todo = set(), [left.pop()]
        while todo:
            at = todo.pop()
            bunch.add(at)
            near = {i for i in left if int(np.bitwise_count(prints[at] ^ prints[i]).sum()) <= near_copies.MOST_BITS}
            left -= near
            todo += near
        found.append(frozenset(bunch))
    return {b for b in found if len(b) > 1}


def test_near_copies_simhash_index_and_tally(spark, monkeypatch):
    """Fingerprints are SimHashes, they meet by positional bytes, and shared bytes are tallied before sets are compared."""
    rng, texts = random.Random(8), []
    for family in range(25):
        words = [f"w{rng.randrange(1 << 30)}" for _ in range(104)]
        texts.append(" ".join(words))
        for _ in range(70 if not family else 2):  # a set of 100 with 2 words in its middle changed: 90 of 110, or less if those are far apart
            copy = list(words)
            at = rng.randrange(5, 90)
            copy[at] = copy[at + rng.randrange(1, 8)] = f"x{rng.randrange(1 << 30)}"
            texts.append(" ".join(copy))
    found = [near_copies.shingle_set(t.encode()) for t in texts]
    frame = spark.createDataFrame(rows(*texts), SCHEMA)
    prints = {r.doc_id: np.array(r.bands, dtype=np.int64) for r in near_copies.with_sets(frame).collect()}
    for i in (0, 3, 80):
        hashes = near_copies.mixed(found[i]).tolist()
        assert prints[i].view(np.uint64).tolist() == [sum((2 * sum(h >> b & 1 for h in row) > len(row)) << b for b in range(64)) for row in hashes]
    want = set()
    for k in range(near_copies.KEYS):
        lists = {}
        for i, p in prints.items():
            lists.setdefault(int(p.view(np.uint16)[k]), []).append(i)
        want |= {(k, b) for members in lists.values() for b in brute_bunches(members, {i: prints[i][:2].view(np.uint64) for i in members})}
    sets = near_copies.with_sets(frame).select(F.col("doc_id").alias("set"), "bands")
    got = {(r.k, frozenset(r.members)) for r in near_copies.key_lists(sets).groupBy("k", "band").agg(F.collect_list("set").alias("members")).collect()}
    assert got == want and max(len(b) for _, b in got) > near_copies.SHORT
    near = [(a, b) for a, b in combinations(range(len(texts)), 2) if len(both := set(found[a].tolist()) & set(found[b].tolist())) * 9 >= 4 * (len(found[a]) + len(found[b])) and both]
    met = {p for _, b in got for p in combinations(sorted(b), 2)}
    assert len(near) > 40 and set(near) <= met and all(near_copies.shared_bytes(prints[a], prints[b]) >= near_copies.LEAST_SHARED for a, b in near)
    a, b = near[0]
    k = int((prints[a].view(np.uint16) == prints[b].view(np.uint16)).argmax())
    links = lambda two: near_copies.cross_links(k, np.array([a, b]), np.array([a, b]), np.array([0, 0]), [found[a], found[b]], two, 0.8)
    other = ~prints[a]
    other[k // 4] = prints[a][k // 4]  # shares one word of bytes, fewer than the tally asks for
    assert links(np.array([prints[a], prints[b]])) == [(b, a)] and links(np.array([prints[a], other])) == []
    kept = {r.doc_id for r in near_copies.without_near_copies(frame).collect()}
    monkeypatch.setattr(common, "UNIT", 5)  # the lists of the large family are dealt into blocks
    monkeypatch.setattr(near_copies, "PROBE", 1)
    assert {r.doc_id for r in near_copies.without_near_copies(frame).collect()} == kept


def test_equal_id_and_text_keep_one_row_for_good(spark):
    made = [(1, "a b c d e f", "en"), (1, "a b c d e f", "fr"), (2, "other words here", None)]
    found = {tuple(near_copies.without_near_copies(spark.createDataFrame(order, "doc_id long, text string, lang string").repartition(2)).orderBy("doc_id").collect()) for order in (made, made[::-1])}
    assert len(found) == 1 and len(found.pop()) == 2


def test_repeated_ids_with_different_texts_stay(spark):
    first, second = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    frame = spark.createDataFrame(rows(first, start=7) + rows(second, start=7) + rows(second, start=7) + rows(first, start=8), SCHEMA)
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, SF).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(7, first), (7, second)]


@pytest.mark.parametrize("unit", [4096, 5])  # with and without crowded nodes
def test_index_finds_all_links(spark, monkeypatch, unit):
    monkeypatch.setattr(common, "UNIT", unit)
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for f in list(fps):
        for _ in range(3):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))))
    hub = rng.getrandbits(64)
    fps |= {hub ^ (1 << a) ^ (1 << b) for a, b in combinations(range(30), 2)}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    for block in (2048, 16):  # one block, and many
        root = {r.node: r.root for r in simhash.components(simhash.index_links(table, block=block)).collect()}
        want = brute_components({f: f & (1 << 64) - 1 for f in signed})
        groups = lambda m: sorted(sorted(g) for g in defaultdict(list, {}).values()) if not m else sorted(map(sorted, _grouped(m)))
        assert groups({f: root.get(f, f) for f in signed}) == groups(want)
    for size in (2, 3):
        sets = simhash.position_sets(size)
        assert all(any(set(s) <= set(c) for s in sets) for c in combinations(range(8), 4))


def _grouped(parent):
    out = defaultdict(list)
    for k, v in parent.items():
        out[v].append(k)
    return out.values()


# --- 4 line templates


def test_line_templates(spark, hard, empty):
    notice = "Page {} of the annual report of the committee"
    docs = rows(*[f"Own words number {chr(97 + i) * 5} stand here alone\n{notice.format(i)}\nend." for i in range(5)], "Short line\nShort line", start=1)
    frame = spark.createDataFrame(docs, SCHEMA)
    out = {r.doc_id: r for r in line_templates.dedup_lines(frame).collect()}
    assert notice.format(0) in out[1].text and out[1]._dropped == 0
    assert all(out[i].text.count("Page") == 0 and "end." in out[i].text and "Own words" in out[i].text and (out[i]._dropped, out[i]._lines) == (1, 3) for i in range(2, 6))
    assert out[6].text == "Short line\nShort line" and out[3].leaf == "x"
    left = {r.doc_id: r for r in line_templates.without_recurring_lines(frame.union(spark.createDataFrame(rows(notice.format(9), start=9), SCHEMA))).collect()}
    assert set(left) == set(range(1, 7)) and left[2].n_chars == len(left[2].text) and left[2]._dropped == 10
    kept = line_templates.without_recurring_lines(hard)
    assert kept.columns == hard.columns and sorted(map(str, kept.collect())) == sorted(map(str, hard.collect()))
    assert line_templates.dedup_lines(empty).count() == 0


def plain_line_dedup(docs):
    """The rule as it is written, over (id, text) of different documents: what is left of each, by nested loops over tuples instead of hashes."""
    parsed = []
    for d, (i, text) in enumerate(docs):
        for pos, line in enumerate(text.split("\n")):
            tokens = re.sub("[ \t\x0b\f\r]+", " ", line).strip(" ").split(" ")
            tokens = tuple("<*>" if re.search("[0-9@]|://", t) else t for t in tokens)
            if len(tokens) >= 5:
                rest, n = tokens[3:], len(tokens) - 3
                f = min(n, 12)
                parsed.append((d, i, pos, (len(tokens), tokens[:3]), tuple(rest[k * n // f : (k + 1) * n // f] for k in range(f))))
    holders = defaultdict(set)
    for d, _, _, leaf, fields in parsed:
        holders[leaf, fields].add(d)
    support = Counter()
    for (leaf, fields), ds in holders.items():
        for k, f in enumerate(fields):
            support[leaf, k, f] += len(ds)
    found = defaultdict(list)
    for d, i, pos, leaf, fields in parsed:
        constant = tuple(f if support[leaf, k, f] >= 3 else None for k, f in enumerate(fields))
        if sum(c is not None for c in constant) >= 0.8 * len(fields):
            found[leaf, constant].append((i, d, pos))
    gone = defaultdict(set)
    for rows_ in found.values():
        if len({d for _, d, _ in rows_}) >= 3:
            first = min(rows_)[1]
            for _, d, pos in rows_:
                if d != first:
                    gone[d].add(pos)
    return {docs[d][0]: "\n".join(x for pos, x in enumerate(docs[d][1].split("\n")) if pos not in gone[d]) for d in range(len(docs))}


def test_line_templates_equal_the_plain_rule(spark, monkeypatch):
    monkeypatch.setattr(common, "UNIT", 8)  # leaves, lines and templates of more rows are salted
    rng = random.Random(12)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    forms = [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 30))) for _ in range(12)]
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(rng.randrange(1, 8)):
            tokens = rng.choice(forms).split(" ")
            if rng.random() < 0.5:
                tokens[rng.randrange(len(tokens))] = rng.choice(["7", "a@b.c", "http://x", "odd", rng.choice(words)])
            lines.append(rng.choice([" ", "  ", "\t"]).join(tokens))
        texts.append("\n".join(lines))
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs + docs[:40] * 3, "doc_id long, text string")  # copies of a row count once and are treated alike
    want = plain_line_dedup(docs)
    got = line_templates.dedup_lines(frame).collect()
    assert len(got) == 270 and all(r.text == want[r.doc_id] for r in got) and sum(r._dropped > 0 for r in got) > 50


def test_very_long_texts_lose_lines_in_linear_time(spark):
    page = "\n".join(f"This same line stands in every one of them {'x' * (i % 50)}y" if i % 2 else f"q{i:x} w{i * 7:x} e{i * 11:x} r{i * 13:x} t{i * 17:x}".translate(str.maketrans("0123456789", "ghijklmnop")) for i in range(200_000))
    frame = spark.createDataFrame([(i, page + "\n" + chr(97 + i) * 9) for i in range(3)], "doc_id long, text string")
    start = time.time()
    out = {r.doc_id: r for r in line_templates.dedup_lines(frame).select("doc_id", "_lines", "_dropped", F.length("text").alias("left")).collect()}
    assert (out[0]._dropped, out[1]._dropped, out[2]._dropped) == (0, 200_000, 200_000) and out[1].left == 9 and time.time() - start < 120


# --- 5 BPE


def test_bpe_equals_library(hard, empty):
    library = Tokenizer.from_file(VOCABULARY)
    coder = bpe.coder_of(open(VOCABULARY, "rb").read())
    rng = random.Random(2)
    alphabet = [*"abetionTHE 's't  \n\t.,!?0123é漢字🌾ñ　\x85\x1c", " the", "ing", "<|endoftext|>", "<|endof"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(50))) for _ in range(3000)] + ["".join(rng.choice("aeinortshl") for _ in range(2000)), LONG]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = np.frombuffer(coder.encode(text), dtype="<u4")
        assert ids.tolist() == want.ids and coder.decode(ids) == library.decode(want.ids, skip_special_tokens=False)
    some = [rng.randrange(50257) for _ in range(500)]
    assert coder.decode(np.array(some)) == library.decode(some, skip_special_tokens=False)
    out = bpe.encode_documents(hard, VOCABULARY).collect()
    assert len(out) == len(HARD) and all(r.round_trip and r.n_tokens * 4 == len(r.ids) and hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 for r in out)
    assert bpe.encode_documents(empty, VOCABULARY).count() == 0


# --- 6 packing


def test_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(200):
        lengths = np.array([rng.randint(1, 20) for _ in range(rng.randint(0, 60))], dtype=np.int64)
        packed, rooms = packing.best_fit_decreasing(lengths, 20), []
        for n in sorted(lengths.tolist(), reverse=True):
            fits = [r for r in rooms if r >= n]
            rooms.remove(min(fits)) if fits else None
            rooms.append((min(fits) if fits else 20) - n)
        assert sorted(20 - int(lengths[r].sum()) for r in packed) == sorted(rooms) and sorted(i for r in packed for i in r) == list(range(len(lengths)))


def test_packing_is_lossless(hard, empty, tmp_path):
    coder = bpe.coder_of(open(VOCABULARY, "rb").read())
    pieces = defaultdict(list)
    packed = packing.packed_rows(hard.dropDuplicates(["doc_id"]), RANKS, size=128)
    for r in packed.collect():
        ids, positions, ends = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4"), r.cu_seqlens
        assert len(ids) == len(positions) == 128 and ends[-1] == r.n_tokens <= 128
        for a, b, i, k in zip(ends, ends[1:], r.doc_ids, r.pieces, strict=False):
            assert positions[a:b].tolist() == list(range(b - a))
            pieces[i].append((k, ids[a:b]))
    for i, text in {r[0]: r[1] for r in HARD}.items():
        ids = np.concatenate([p for _, p in sorted(pieces[i], key=lambda x: x[0])])
        # a special token's string is ordinary text here
        assert ids[-1] == 50256 and coder.decode(ids[:-1]) == (text or "")
    packing.write_matrix(packed, str(tmp_path / "m"))
    assert hard.sparkSession.read.parquet(str(tmp_path / "m")).count() == packed.count()
    assert packing.packed_rows(empty, RANKS).count() == 0
    named = packing.packed_rows(hard.withColumn("doc_id", F.concat(F.lit("id-"), F.col("doc_id"))), RANKS, size=128).collect()
    assert {i for r in named for i in r.doc_ids} == {None, *(f"id-{r[0]}" for r in HARD if r[0] is not None)}
    assert sum(r.n_tokens for r in packing.packed_rows(hard, RANKS).collect()) == sum(r.n_tokens for r in packing.packed_rows(hard.repartition(5), RANKS).collect())


def test_many_copies_are_packed_in_several_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 8)
    docs = spark.createDataFrame([(1, "a b c")] * 200 + [(i, f"text {i}") for i in range(2, 60)], "doc_id long, text string")
    monkeypatch.setattr(packing, "MOST_HOT", 100)
    out = packing.packed_rows(docs, RANKS, size=64).collect()
    assert Counter(i for r in out for i in r.doc_ids) == Counter([1] * 200 + list(range(2, 60))) and len({r.grp for r in out if 1 in r.doc_ids}) > 5


def test_packing_flushes_full_windows(spark, monkeypatch):
    """A group of more ids than a window is packed window by window, each as if it stood alone, and nothing is lost."""
    monkeypatch.setattr(packing, "WINDOW_TOKENS", 300)
    docs = spark.createDataFrame([(i, " ".join(f"word{j}" for j in range(i % 40))) for i in range(90)], "doc_id long, text string")
    out = packing.packed_rows(docs, RANKS, size=64).collect()
    windows, pieces = defaultdict(list), defaultdict(list)
    for r in sorted(out, key=lambda r: (r.grp, r.window, r.row)):
        windows[r.grp, r.window].append(r)
        ids, ends = np.frombuffer(r.ids, "<u4"), r.cu_seqlens
        for a, b, i, k in zip(ends, ends[1:], r.doc_ids, r.pieces, strict=False):
            pieces[i].append((k, (r.grp, r.window), ids[a:b]))
    assert len(windows) > 5 and {w for _, w in windows} == set(range(len(windows))) and all([r.row for r in rs] == list(range(len(rs))) for rs in windows.values())
    whole = {i: np.concatenate([p for *_, p in sorted(ps, key=lambda x: x[0])]) for i, ps in pieces.items()}
    coder = bpe.coder_of(open(VOCABULARY, "rb").read())
    assert all(coder.decode(whole[r.doc_id][:-1]) == r.text for r in docs.collect()) and all(len({w for _, w, _ in ps}) == 1 for ps in pieces.values())
    for key, rs in windows.items():
        own = [(i, whole[i]) for i, ps in pieces.items() if ps[0][1] == key]
        assert sum(len(x) for _, x in own) < 300 + max(len(x) for _, x in own)
        want = list(packing.pack_matrix(sorted(own, key=lambda x: min((r.row, r.doc_ids.index(x[0])) for r in rs if x[0] in r.doc_ids)), 64, 50256))
        assert len(want) == len(rs)


# --- 7 sharding


def signed_hash(values):
    """The engine's 64-bit xxHash of longs and ints, in turn: fixed-width little-endian inputs, seed 42, chained."""
    seed = 42
    for value, width in values:
        seed = xxhash.xxh64_intdigest(int(value).to_bytes(width, "little", signed=True), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def test_shards_equal_brute_force(real):
    """Shard and grown shard recomputed by hand: the least -ln(u) over all shards."""

    def shard(key, n):
        record = signed_hash([(key, 8)])
        costs = []
        for i in range(n):
            h = signed_hash([(record, 8), (i, 4)]) & (1 << 64) - 1
            costs.append((-math.log(((h >> 11) + 0.5) / (1 << 53)), i))
        return min(costs)[1]

    for r in sharding.shard_documents(real, 24).collect():
        assert (r.shard, r.grown_shard) == (shard(r.doc_id, 24), shard(r.doc_id, 25))


def test_sharding(real, hard, empty):
    out = sharding.shard_documents(real, 24).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in real.collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in out} == {i: (len(t) + 8, zlib.crc32(t)) for i, t in texts.items()}
    assert all(r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24 for r in out)
    for frame in (real, hard):
        by_shard = defaultdict(list)
        for r in sharding.shard_documents(frame, 24).collect():
            by_shard[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in by_shard.values()) and sum(map(len, by_shard.values())) == frame.count()
    assert sharding.shard_documents(empty, 24).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous_shard([F.lit(1)], [0.0])


def test_weighted_shards(spark):
    ids = spark.range(20000)
    counts = dict(ids.groupBy(sharding.rendezvous_shard([F.col("id")], [1, 2, 0, 1]).alias("s")).count().collect())
    assert 2 not in counts and abs(counts[1] - 10000) < 400 and abs(counts[0] - 5000) < 350
    both = ids.select(sharding.rendezvous_shard([F.col("id")], [1, 2, 0, 1]).alias("a"), sharding.rendezvous_shard([F.col("id")], [1, 2, 0, 3]).alias("b"))
    assert both.filter("a <> b AND b <> 3").count() == 0


def test_hot_key_slots(spark, monkeypatch):
    monkeypatch.setattr(common, "RUN", 7)
    hot = spark.range(100).select(F.lit(5).alias("k"), F.lit(0).alias("shard"))
    assert sorted(r.slot for r in sharding.number_slots(hot, "shard").collect()) == list(range(100))


# --- 8 top-k


def plain_weights(vector):
    return [math.floor(64 * Fraction(x)) for x in vector]


def check_top_k(vectors, frame, asked, k):
    clean = [(i, plain_weights(v)) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    got = defaultdict(list)
    for r in topk.top_k(frame, frame.filter(F.col("vec_id").isin(asked)), k=k).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    queries_ = {}
    for q, v in clean:
        if q in asked:
            queries_[q] = min(queries_.get(q, v), v)
    low, high = -(1 << 63), (1 << 63) - 1
    for q, v in queries_.items():
        scored = sorted(((sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in clean if i != q), key=lambda x: (-x[0], x[1]))
        assert got[q] == [(min(max(score, low), high), i) for score, i in scored[:k]]
    assert set(got) == set(queries_)


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.1, 16)]) for i in range(300)]
    vectors += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")] * 16), (304, []), (305, [0.5] * 3), (None, [0.25]), (7, vectors[7][1])]
    frame = spark.createDataFrame([(*v, 1, "x", 2) for v in vectors], "vec_id long, embedding array<float>, rank int, rows string, q int")  # names that the operator uses
    check_top_k(vectors, frame, [*range(0, 300, 20), 304, 305, 7], 5)
    assert topk.top_k(frame.limit(0), frame.limit(0)).count() == 0
    plain_frame = spark.createDataFrame([(v[0], v[1]) for v in vectors if v[0] is not None and v[0] < 300], "vec_id long, embedding array<float>")
    assert topk.top_k(plain_frame, plain_frame.filter("vec_id = 20"), k=500).count() == 300  # all, if fewer


def test_top_k_is_exact_for_large_components(spark):
    rng = np.random.default_rng(6)
    large = [(1, [3e6, 0.0]), (2, [5e6, 0.0]), (3, [1.0, 1.0]), (4, [-7e6, 3.5]), (20, [4e6, -2.0])]  # beyond 2**21
    wide = [(100 + i, [float(x) for x in rng.choice([1e9, -1e9, 3e8, 0.3], 600)]) for i in range(30)]  # sums beyond a long
    huge = [(200, [1e300, 1.0]), (201, [1e308, -1e308]), (202, [-1e300, 0.015625]), (203, [2.0**53 + 2, 2.0**-6]), (204, [1.7e308] * 600)]
    vectors = large + wide + huge
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    check_top_k(vectors, frame, [i for i, _ in vectors], 7)


def test_top_k_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 16)
    frame = spark.createDataFrame([(i, [i % 7 / 10, -(i % 5) / 10]) for i in range(100)], "vec_id long, embedding array<double>")
    got = topk.top_k(frame, frame.filter("vec_id % 10 = 0"), k=4).collect()
    monkeypatch.setattr(topk, "BROADCAST_BYTES", 0)
    shuffled = topk.top_k(frame, frame.filter("vec_id % 10 = 0"), k=4).collect()
    monkeypatch.undo()
    assert sorted(got) == sorted(shuffled)
    assert sorted(got) == sorted(topk.top_k(frame, frame.filter("vec_id % 10 = 0"), k=4).collect()) and len(got) == 40


# --- 9 URL rules


def test_top_k_of_long_vectors(spark, monkeypatch):
    """4096 dimensions: blocks are cut by bytes, and the result is the same."""
    monkeypatch.setattr(topk, "BLOCK_BYTES", 4 << 20)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 4096)).round(3)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    weights = np.floor(64 * vectors).astype(np.int64)
    scores = weights @ weights.T
    got = topk.top_k(frame, frame.filter("vec_id % 50 = 0"), k=5).orderBy("query_id", "rank").collect()
    want = []
    for q in range(0, 300, 50):
        best = sorted((i for i in range(300) if i != q), key=lambda i: (-scores[q, i], i))[:5]
        want += [(q, n, i, int(scores[q, i])) for n, i in enumerate(best, 1)]
    assert [tuple(r) for r in got] == want
    assert topk.block_count(300, 300 * 4096, 8192) == 5 and topk.block_count(9000, 9000, 8192) == 2 and topk.block_count(0, 0, 8192) == 1


def test_url_rules(spark):
    urls = [f"http://{'spam' if i % 4 == 0 else 'good'}.example.net/p{i}/{'x' if i % 2 else 'y'}?q={i % 3}" for i in range(200)]
    urls += [None, "", "no scheme", "HTTPS://A.Example.ORG/es/1#f", "http://example.org/en/12", "http://xexample.org/es/", "ftp://fr.com/fr/?a=1", "http://a.com?x=/de/", "x\nhttp://b.com/de/z", "http://spam.example.net/a/b"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)] + [(None, urls[0], 1)], "page_id long, url string, verdict int")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(200)] + [(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = {r.page_id: r for r in url_rules.judge_urls(pages, labels, queries.LISTED).collect()}
    assert len(out) == len(urls) + 1
    assert all((out[i].verdict == "block") == (i % 4 == 0) for i in range(200)) and out[209].verdict == "block" and out[None].verdict == "block"
    assert [(out[i].host, out[i].path, out[i].rule, out[i].verdict) for i in range(200, 209)] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.example.org", "/es/1", "example.org/es/", "block"),
        ("example.org", "/en/12", "example.org/en/1", "block"), ("xexample.org", "/es/", "org/", "allow"), ("fr.com", "/fr/", "com/fr/", "allow"),
        ("a.com", "", None, "allow"), ("b.com", "/de/z", "com/de/", "block"),
    ]
    rules = url_rules.mined_rules(pages, labels).collect()
    assert [r["items"] for r in rules if "h:spam" in r["items"]] == [["h:spam"]]  # longer rules are pruned
    assert url_rules.judge_urls(pages.limit(0), labels.limit(0), queries.LISTED).count() == 0
    plain = {r.page_id: r for r in url_rules.judge_urls(pages, labels, ()).collect()}
    assert {r.rule for r in plain.values()} == {None} and plain[204].verdict == "allow" and all((plain[i].verdict == "block") == (i % 4 == 0) for i in range(200))


def test_hot_and_null_urls(spark, monkeypatch):
    monkeypatch.setattr(common, "UNIT", 8)
    urls = ["http://spam.net/a"] * 300 + [None] * 300 + [f"http://good.net/{i}" for i in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i >= 300), 0) for i in range(900)], "doc_id long, quality int, toxic int")
    out = url_rules.judge_urls(pages, labels, queries.LISTED).collect()
    assert sorted((r.page_id, r.verdict) for r in out) == [(i, "block" if i < 300 else "allow") for i in range(900)]
    monkeypatch.setattr(url_rules, "MOST_BROADCAST", 0)
    assert sorted(map(str, url_rules.judge_urls(pages, labels, queries.LISTED).collect())) == sorted(map(str, out))


def test_url_rules_of_long_urls(spark):
    path = lambda i: f"2024/01/02/news/{'casino-x' if i % 4 == 0 else 'fine'}/" + "/".join(f"s{k}" for k in range(25))
    query = lambda i: f"a=1&b=2&c=3&d=4&{'spam=1' if i % 4 == 1 else 'e=5'}"
    host = lambda i: f"{'bad' if i % 4 == 2 else 'w'}.a.b.example.net"
    urls = [f"http://{host(i)}/{path(i)}?{query(i)}" for i in range(200)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 4 == 3), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    items = lambda u: {("h", x) for x in u.split("/")[2].split(".")} | {("p", x) for x in u.split("?")[0].split("/")[3:]} | {("q", x) for x in u.split("?")[1].split("&")}
    want, sets = set(), [items(u) for u in urls]
    for size in (1, 2):  # brute force over small sets; what contains a rule is none
        for xs in map(frozenset, combinations(sorted(set().union(*sets)), size)):
            met = [i for i, s in enumerate(sets) if xs <= s]
            if not any(w < xs for w in want) and sum(i % 4 != 3 for i in met) >= 5 and sum(i % 4 != 3 for i in met) >= 0.9 * len(met):
                want.add(xs)
    got = {frozenset((x[0], x[2:]) for x in r["items"]) for r in url_rules.mined_rules(pages, labels, confidence=0.9).collect()}
    assert {w for w in got if len(w) <= 2} == want and all(frozenset([x]) in got for x in (("p", "casino-x"), ("q", "spam=1"), ("h", "bad")))
    new = spark.createDataFrame([(i, u) for i, u in enumerate(["http://n.org/1/2/3/4/casino-x", "http://n.org/?v=1&w=2&x=3&y=4&spam=1", "http://bad.q.r.s.t", "http://n.org/1"])], "page_id long, url string")
    met = {r.url for r in url_rules.blocked_urls(new, url_rules.mined_rules(pages, labels, confidence=0.9)).collect()}
    assert len(met) == 3 and "http://n.org/1" not in met


def test_groups_of_items_are_not_multiplied_out(spark):
    """Three groups of 40 items that lie in the same pages give a few rules, and any member of a group matches."""
    groups = [[f"{g}{i}" for i in range(40)] for g in "abc"]
    path = lambda gs: "/".join(x for g in gs for x in groups[g])
    held = [(0, 1), (1, 2), (0, 2), (0, 1, 2), (0,), (1,), (2,)]
    urls = [f"http://x.org/{path(held[i % 7])}/u{i}" for i in range(350)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(len(held[i % 7]) < 2), 0) for i in range(350)], "doc_id long, quality int, toxic int")
    rules, members = url_rules.grouped_rules(pages, labels, confidence=0.9)
    assert sorted(sorted(x[2] for x in r["items"]) for r in rules.collect()) == [["a", "b"], ["a", "c"], ["b", "c"]]
    assert members.filter("item LIKE 'p:a%'").count() == 40
    new = ["http://n.org/a7/b39", "http://n.org/c0/a1/z", "http://n.org/a1/a2/a3", "http://n.org/b1"]
    found = url_rules.blocked_urls(spark.createDataFrame(list(enumerate(new)), "page_id long, url string"), rules, members)
    assert {r.url for r in found.collect()} == set(new[:2])
    out = {r.page_id: r.verdict for r in url_rules.judge_urls(pages, labels, (), confidence=0.9).collect()}
    assert all((out[i] == "block") == (len(held[i % 7]) > 1) for i in range(350))


# --- 10 language ID


def test_language_id(spark, hard, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lang_cnn.fit_language_model(docs)
    out = lang_cnn.identify_languages(docs, model).join(docs, "doc_id").toPandas()
    assert (out.held_out == out.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert (out.lang_pred == out.lang)[out.held_out].mean() > 0.97 and out.score.between(0, 1).all()
    small = {(r.doc_id, r.lang_pred == "und", r.score == 0) for r in lang_cnn.identify_languages(hard, model).collect()}
    assert {(0, True, True), (1, True, True), (2, True, True), (6, True, True), (3, False, False), (7, False, False)} <= small
    nothing = lang_cnn.fit_language_model(empty)
    assert nothing.languages == [] and {r.lang_pred for r in lang_cnn.identify_languages(hard, nothing).collect()} == {"und"}
    assert lang_cnn.identify_languages(empty, model).count() == 0
    kept = lang_cnn.keep_identified(hard, model)
    assert kept.columns == hard.columns and not {0, 1, 2, 6} & {r.doc_id for r in kept.collect()}


def test_windows_cover_texts():
    for n in (1, 255, 256, 257, 1000, 5000):
        text = bytes(random.Random(n).randrange(1, 256) for _ in range(n))
        windows, added = lang_cnn.cut_windows(text)
        step = lang_cnn.WINDOW - 3
        assert b"".join([w[:step].tobytes() for w in windows[:-1]] + [windows[-1].tobytes()])[:n] == text and added.sum() == n


def test_tabulated_filters_equal_plain_ones():
    model = lang_cnn.ByteCNN(["a", "b"])
    x = np.random.default_rng(0).integers(0, 256, (5, lang_cnn.WINDOW)).astype(np.uint8)
    pooled = [sum(model.weights[f"k{w}"][j][x[:, j : j + lang_cnn.WINDOW - w + 1]] for j in range(w)).max(axis=1) for w in lang_cnn.WIDTHS]
    want = lang_cnn.softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ model.weights["out"] + model.weights["bias"])
    assert np.allclose(model.probabilities(x), want, atol=1e-5)


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(3)
    model = lang_cnn.ByteCNN(["a", "b", "c"])
    for name, w in model.weights.items():
        model.weights[name] = w.astype(np.float64) + rng.normal(0, 0.05, w.shape)
    x, y = rng.integers(0, 256, (6, lang_cnn.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])

    def loss():
        pooled = [(sum(model.weights[f"k{w}"][j][x[:, j : j + lang_cnn.WINDOW - w + 1]] for j in range(w)) + model.weights[f"b{w}"]).max(axis=1) for w in lang_cnn.WIDTHS]
        p = lang_cnn.softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ model.weights["out"] + model.weights["bias"])
        return -np.log(p[np.arange(len(y)), y]).mean()

    grads = model.gradients(x, y, np.ones(6))
    for name, grad in grads.items():
        w = model.weights[name]
        largest = np.argsort(-np.abs(grad), axis=None)[:6]
        for at in [*largest, *rng.integers(0, w.size, 4)]:
            at, step = np.unravel_index(at, w.shape), 1e-5
            w[at] += step
            up = loss()
            w[at] -= 2 * step
            down = loss()
            w[at] += step
            assert abs((up - down) / (2 * step) - grad[at]) < 1e-4 * max(1.0, abs(grad[at]) * 10)


# --- pipeline


def test_pipeline(spark, real, hard, empty):
    out = corpus_pipeline.run(spark, SF).collect()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and {r.doc_id for r in out} <= {r.doc_id for r in real.collect()} and len({r.doc_id for r in out}) == len(out)
    assert len(out) > 0.8 * real.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, real, SF).columns == real.columns
        assert stage(spark, hard, SF).columns == hard.columns
        assert stage(spark, empty, SF).count() == 0


def test_pipeline_stage_by_stage(spark, real, tmp_path):
    """Which rows each stage keeps, and in which order, by brute force on its own input."""
    docs = real
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        if name == "language ID":
            found = {r.doc_id: r for r in lang_cnn.identify_languages(real, lang_cnn.fit_language_model(real)).collect()}
            want = [r for r in before if found[r.doc_id].lang_pred != "und" and found[r.doc_id].score >= 0.5]
            assert sorted(after) == sorted(want)
        elif name == "line dedup":
            left = plain_line_dedup([(r.doc_id, r.text) for r in before])
            want = {r.doc_id: left[r.doc_id] for r in before if left[r.doc_id] == r.text or left[r.doc_id].strip(" ")}
            assert {r.doc_id: r.text for r in after} == want
        elif name == "near-dedup":
            sets = [frozenset(near_copies.shingle_set(r.text.encode()).tolist()) for r in before]
            parent = {r.doc_id: r.doc_id for r in before}
            for a, b in combinations(range(len(before)), 2):
                shared = len(sets[a] & sets[b])
                if sets[a] == sets[b] or shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared):
                    low, high = sorted((parent[before[a].doc_id], parent[before[b].doc_id]))
                    parent = {i: low if x == high else x for i, x in parent.items()}
            assert {r.doc_id for r in after} == {i for i, root in parent.items() if i == root}
        elif name == "mixing sources":
            slots = {r.doc_id: (r._slot, r._place) for r in mixing.mixed_places(spark.createDataFrame(before), mixing.measured_weights(spark.createDataFrame(before))).collect()}
            want = brute_schedule(mixing.measured_weights(spark.createDataFrame(before)), {s: -(-n // 64) for s, n in Counter(r.source for r in before).items()})
            assert sorted(map(str, after)) == sorted(map(str, before)) and {slots[r.doc_id][0] for r in before} == set(want.values())
            assert [r.doc_id for r in stage(spark, spark.createDataFrame(before), SF).collect()] == sorted(slots, key=slots.get)
        else:
            library = Tokenizer.from_file(VOCABULARY)
            ids = {r.doc_id: np.array(library.encode(r.text, add_special_tokens=False).ids, dtype="<u4").tobytes() for r in before}
            assert {r.doc_id: bytes(r.ids) for r in after} == ids


def test_registered():
    names = set(queries.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
