"""The Merkle manifest, importance resampling and toxicity against brute force and held-out accuracy, on small hard inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import importance, merkle, queries, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, pos int, size int, path string, row long, rank int, score int, own int, toxic int"
LONG = "A very long text, said 9 times: ÄÖ 漢字 " * 3000
TEXTS = (None, "", " \n\t ", "One line here.", "One line here.", "ÄÖÜ 漢字 🌾 x", "!!! 123", LONG, "z" * 300 + " " + "y" * 70000 + " Word", " ".join(f"Word{i % 30}" for i in range(60)))


def rows(*texts, start=0, lang="en"):
    """Documents with columns whose names the operators use themselves."""
    return [(start + i, t, lang, "s", len(t or ""), "g", 1, 2, "p", 3, 4, 5, 6, 7) for i, t in enumerate(texts)]


HARD = (
    rows(*TEXTS) + rows(*TEXTS, start=100, lang=None) + rows("x", start=50, lang="") + rows(*[f"text {i}" for i in range(37)], start=1000, lang="de")
    + [(None, "no id", None, None, None, *["g", 1, 2, "p", 3, 4, 5, 6, 7])] * 3 + [(None, "no id", "de", "s", (1 << 63) - 1, *["g", 1, 2, "p", 3, 4, 5, 6, 7])] + rows("One line here.", start=3) * 2
)


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(HARD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def brute_manifest(documents):
    groups = defaultdict(list)
    for d in documents:
        doc_id, text, lang, source, n_chars = d[:5]
        turned = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 0 and n_chars is not None
        own = leaf(doc_id, source, lang, n_chars, text)
        groups[lang].append((doc_id, own, leaf(doc_id, source, lang, n_chars + 1, text) if turned else own))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = tree([x[1] for x in groups[lang]])
    top = tree([trees[lang][-1][0] for lang in langs]) if langs else [[None]]
    out = []
    for n, lang in enumerate(langs):
        for i, (doc_id, own, now) in enumerate(groups[lang]):
            siblings, folded = [], now
            for levels, at in ((trees[lang], i), (top, n)):
                for nodes in levels[:-1]:
                    other = at ^ 1
                    if other < len(nodes):
                        siblings.append(nodes[other])
                        folded = h(nodes[other], folded) if other < at else h(folded, nodes[other])
                    else:
                        folded = h(folded)
                    at >>= 1
            out.append((doc_id, own, trees[lang][-1][0], top[-1][0], h(*siblings), folded, folded == top[-1][0]))
    return out


def as_sorted(found):
    return sorted((tuple(r) for r in found), key=lambda r: tuple((x is not None, x) if not isinstance(x, bool) else (True, x) for x in r))


@pytest.mark.parametrize(("levels", "top"), [(10, 1 << 14), (2, 1 << 14), (2, 6), (1, 2), (1, 1)])
def test_manifest_equals_brute_force(hard, monkeypatch, levels, top):
    """Whatever the size of blocks and of the driver's part, even with more languages than that."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 1 << levels)
    monkeypatch.setattr(merkle, "TOP", top)
    found = merkle.manifest(hard).collect()
    assert as_sorted(found) == as_sorted(brute_manifest(HARD))
    assert any(r.verified for r in found) and not all(r.verified for r in found)


def test_manifest_small_tables(spark, empty):
    assert merkle.manifest(empty).collect() == []
    one = spark.createDataFrame(rows("alone", start=5), SCHEMA)
    found = merkle.manifest(one).first()
    assert found.root == found.leaf == found.subroot and found.proof_sha256 == h("") and found.verified


# --- importance resampling


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def buckets(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_resample(documents, target):
    source, wanted = (np.zeros(10000, dtype=int) for _ in range(2))
    for d in documents:
        np.add.at(source, buckets(d[1]), 1)
    for t in target:
        np.add.at(wanted, buckets(t), 1)
    s_all, t_all = int(source.sum()), int(wanted.sum())
    gain = [math.floor(1000 * math.log((int(t) + 1) * (s_all + 10000) / ((int(s) + 1) * (t_all + 10000)))) for s, t in zip(source, wanted, strict=True)]
    out = []
    for d in documents:
        own = buckets(d[1])
        noise = int(hashlib.sha256(f"42:{'' if d[0] is None else d[0]}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        out.append([d[0], len(own), weight, weight + math.floor(-1000 * math.log(-math.log((noise + 0.5) / 4294967296))), None, len(words(d[1]))])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for i, r in enumerate(able[: 5 * len(able) // 100], 1):
        r[4] = i
    return [tuple(r[:5]) for r in out]


def test_features_equal_brute_force():
    rng = random.Random(3)
    texts = [t or "" for t in TEXTS] + [" ".join(rng.choice(("ab", "Cd, ef", "é", "9" * rng.randint(1, 90))) for _ in range(rng.randint(0, 150))) for _ in range(40)]
    found = importance.Features([importance.as_words(t.encode()) for t in texts])
    assert found.counted().tolist() == np.bincount([b for t in texts for b in buckets(t)], minlength=10000).tolist()
    assert found.sizes().tolist() == [len(buckets(t)) for t in texts]
    for size in (1, 2, 7, 100):  # chunks own every feature once
        for t in texts:
            cut = list(importance.cut(importance.as_words(t.encode()), size))
            if cut:
                parts = importance.Features([c for c, _ in cut], [n for _, n in cut])
                assert sorted(b for _, bs in parts.runs for b in bs.tolist()) == sorted(buckets(t)) and parts.own.sum() == len(words(t))


@pytest.mark.parametrize("size", [None, 64])
def test_resampling_equals_brute_force(spark, hard, monkeypatch, size):
    if size:  # nearly all texts are cut
        monkeypatch.setattr(importance, "LONG", size)
        monkeypatch.setattr(importance, "CHUNK", size // 2)
    target = ["a very long text", None, "Word1 word2 word3", ""]
    found = importance.resample(hard, spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")).collect()
    assert as_sorted(found) == as_sorted(brute_resample(HARD, target))


def test_resampling_draws_the_best(spark):
    rng = random.Random(5)
    near = [" ".join(rng.choice(("spark", "query", "plan", "shuffle")) for _ in range(25)) for _ in range(20)]
    far = [" ".join(rng.choice("abcdefgh") for _ in range(25)) for _ in range(380)]
    documents = rows(*near, *far)
    found = importance.resample(spark.createDataFrame(documents, SCHEMA), spark.createDataFrame([(near[0],), (near[1],)], "text string")).collect()
    assert as_sorted(found) == as_sorted(brute_resample(documents, near[:2]))
    drawn = sorted((r.rank, r.doc_id) for r in found if r.rank)
    assert [n for n, _ in drawn] == list(range(1, 21)) and {d for _, d in drawn} == set(range(20))


def test_resampling_empty(spark, empty, hard):
    nothing = spark.createDataFrame([], "text string")
    assert importance.resample(empty, nothing).collect() == []
    assert as_sorted(importance.resample(hard, nothing).collect()) == as_sorted(brute_resample(HARD, []))


# --- toxicity


def test_factors_learn_what_weights_cannot():
    """A word is toxic beside the mention of one group and harmless beside the other's: no sum of weights tells that."""
    rng = random.Random(2)
    one, two, first, second, plain = ([f"{k}{i}" for i in range(n)] for k, n in (("one", 4), ("two", 4), ("first", 4), ("second", 4), ("word", 200)))

    def text(some, others):
        body = rng.choices(plain, k=rng.randint(20, 40)) + [rng.choice(some), rng.choice(others)]
        rng.shuffle(body)
        return " ".join(body)

    kinds = [(one, first, 1), (two, second, 1), (one, second, 0), (two, first, 0)] + [(plain, plain, 0)] * 4
    made = [(text(a, b), y) for _ in range(500) for a, b, y in kinds]
    rng.shuffle(made)
    train, test = made[:3000], made[3000:]

    def accuracy(factors):
        model = toxicity.FactorizationMachine(factors)
        model.fit([toxicity.windows_of(t) for t in toxicity.terms_of([x for x, _ in train])], np.array([y for _, y in train], dtype=float))
        return float(np.mean((model.scores([x for x, _ in test]) >= 0.5) == [y for _, y in test]))

    assert accuracy(toxicity.FACTORS) > 0.97
    assert accuracy(0) < 0.85


def test_windows_cover_all_terms():
    for n in (0, 1, 63, 64, 65, 96, 97, 1000):
        terms = np.arange(1, n + 1, dtype=np.int32)
        found = toxicity.windows_of(terms)
        assert set(found.ravel().tolist()) - {0} == set(terms.tolist()) and found.shape[1] == toxicity.WINDOW
        pairs = {(a, a + 1) for w in found for a in w.tolist() if a and a + 1 in w}
        assert len(pairs) == max(0, n - 1)  # neighbours share a window


@pytest.fixture(scope="module")
def judged(spark):
    """Documents of which the toxic ones hold an insult at any place, long ones too."""
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(1200):
        bad, n = i % 5 == 0, 3000 if i % 100 == 0 else rng.randint(10, 120)
        body = [rng.choice("abcdefghijklmnop") + rng.choice("aeiou") for _ in range(n)]
        if bad:
            body.insert(rng.randint(0, n), rng.choice(("Idiots!", "SCUM", "ugly,")))
        docs.append((i, " ".join(body), "en", "s", n, "x", 1, 2, "p", 3, 4, 5, 6, 0))
        labels.append((i, 0, int(bad)))
    return spark.createDataFrame(docs, SCHEMA).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {d for d, _, y in labels if y}


def test_toxicity_held_out(judged):
    docs, labels, bad = judged
    found = toxicity.score_toxicity(docs, toxicity.fit_toxicity_model(docs, labels)).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in found if r.held_out} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2} and len(held) > 200
    assert np.mean([(r.doc_id in bad) == bool(r.predicted) for r in held]) > 0.99
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)


def test_toxicity_never_reads_held_out_labels(judged):
    docs, labels, _ = judged
    turned = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.fit_toxicity_model(docs, x, sample=100) for x in (labels, turned))
    assert one.known == two.known and np.array_equal(one.table, two.table) and one.bias == two.bias


def test_toxicity_hard_cases(spark, hard, empty):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)] + [(None, 1, 1), (1, None, None), (2, 0, 5)], "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity_model(hard, labels)
    found = toxicity.score_toxicity(hard, model).collect()
    assert len(found) == len(HARD)
    by_text = defaultdict(set)
    text = {d[0]: d[1] for d in HARD}
    for r in found:
        by_text[text[r.doc_id]].add(r.score)
    assert all(len(v) == 1 for v in by_text.values())  # equal texts, equal scores
    assert toxicity.score_toxicity(empty, model).collect() == []
    nothing = toxicity.fit_toxicity_model(empty, labels)
    assert {r.score < 1e-9 and r.predicted == 0 for r in toxicity.score_toxicity(hard, nothing).collect()} == {True}
    assert {r.predicted for r in toxicity.score_toxicity(hard, toxicity.fit_toxicity_model(hard, labels.limit(0))).collect()} == {0}


def test_queries_registered():
    assert {"op11_merkle_manifest", "op12_importance_resampling", "op13_factorization_toxicity"} <= set(queries.queries())
    assert {"op11_merkle_manifest", "op12_importance_resampling"} <= set(queries.oracle_sql())
