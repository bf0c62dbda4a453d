"""The relation miner: golden cases, properties, hard inputs, and SQL counterparts."""

import json
import os
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from types import SimpleNamespace

import duckdb
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__
from quillspark import cli
from quillspark.functions.dictionaries import BLACKLIST, WHITELIST, Dictionaries
from quillspark.functions.text import find_all
from quillspark.operators import feedback, geneids, mentions, normalize, pairs, records, review, sentences, species
from quillspark.functions import durable
from quillspark.plans import catalogue, workflow
from quillspark.sources import abstracts, adapters
from quillspark.streaming import ingest

SF = "/root/testdata/sf0.001"


def values(spark, texts, make):
    """make(column) for each text."""
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in frame.select("i", make(F.col("t")).alias("v")).orderBy("i").collect()]


def one(spark, text, make):
    return values(spark, [text], make)[0]


def test_mirna_mentions(spark):
    texts = ["miR156 MIR156 miR156a-5p miR444b.2", "osa-miR156a-5p", "pre-miR156 anti-miR156", "TaMIR5062-5A", "miR-156 microRNA156", "", None]
    found = values(spark, texts, mentions.extract_mirnas)
    assert [[m.name for m in x] if x is not None else None for x in found] == [
        ["miR156", "MIR156", "miR156a-5p", "miR444b.2"], ["osa-miR156a-5p"], ["pre-miR156", "anti-miR156"], ["TaMIR5062"], [], [], None,
    ]
    assert [(m.start, m.end) for m in found[0]] == [(0, 6), (7, 13), (14, 24), (25, 34)]


def test_gene_mentions(spark):
    cases = {
        "LOC_Os08g42700.1 and Os06g0708700": [("LOC_Os08g42700.1", "Confirmed"), ("Os06g0708700", "Confirmed")],
        "OsSPL14": [("OsSPL14", "High confidence")],
        "Os SPL14": [("OsSPL14", "High confidence"), ("SPL14", "High confidence")],
        "SPL99": [("SPL99", "High confidence")],
        "WRKY45 WRKY": [],
        "DICER-LIKE1": [],
        "HsfA1 mutant": [("HsfA1", "Unverified")],
        "HsfA1 alone": [],
        "ABC transporter": [],
        "target ABC proteins": [("ABC", "Unverified")],
    }
    assert [[(g.name, g.confidence) for g in x] for x in values(spark, list(cases), mentions.extract_genes)] == list(cases.values())
    lists = Dictionaries(("SPL99",), ("ABC",))
    assert [[g.name for g in x] for x in values(spark, ["SPL99 gene", "ABC"], lambda t: mentions.extract_genes(t, lists))] == [[], ["ABC"]]


def test_sentences(spark):
    texts = ["Jones et al. Reported it.", "A cv. ZR02 grew. Next one.", "in rice.\nThen it", "the end.Next one", "One\n\nTwo", "miR444b.2 rose", "", " \n\n "]
    assert list(map(len, values(spark, texts, sentences.split_sentences))) == [1, 2, 1, 2, 2, 1, 0, 0]
    span = lambda t: sentences.sentence_span(t, sentences.split_sentences(t), F.lit(1), F.lit(0))
    assert one(spark, "First one. Second one. Third.", span) == "First one. Second one."
    assert one(spark, "before. Inside here now. After", lambda t: sentences.fallback_span(t, F.lit(9), F.lit(12))) == "Inside here now."


def plain_sentences(text):
    """The same rule character by character."""
    out, start, i, n = [], 0, 0, len(text)
    digit = lambda c: c.isdecimal() or c in "²³¹"
    abbreviations = set(sentences.ABBREVIATIONS)
    while i < n:
        if text[i] in ".!?" and not (i + 1 < n and (digit(text[i + 1]) or text[i + 1].islower())):
            j = i + 1
            while j < n and text[j] in " \t\r":
                j += 1
            word = i
            while word > 0 and text[word - 1].isalpha():
                word -= 1
            if j < n and (text[j].isupper() or digit(text[j])) and text[word:i].lower() not in abbreviations:
                out.append((start, j))
                start = i = j
                continue
        if text.startswith("\n\n", i):
            end = start + len(text[start:i].rstrip(" \t\r\n"))
            out += [(start, end)] if end > start else []
            start = i = i + 2
            continue
        i += 1
    end = start + len(text[start:].rstrip(" \t\r\n"))
    return out + ([(start, end)] if end > start else [])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aZé.!? \n\tlA1²et", max_size=40), min_size=20, max_size=60))
def test_sentences_equal_plain_rule(spark, texts):
    found = values(spark, texts, sentences.split_sentences)
    assert [[(s.start, s.end) for s in x] for x in found] == [plain_sentences(t) for t in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab1 é\u0001🌾", max_size=30), min_size=20, max_size=50))
def test_find_all_offsets(spark, texts):
    import re

    want = [[(m.group(), m.start(), m.end()) for m in re.finditer(r"[ab]+1?", t.replace("\u0001", " "))] for t in texts]
    assert [[tuple(m) for m in x] for x in values(spark, texts, lambda t: find_all(t, "[ab]+1?"))] == want


def test_normal_names(spark):
    cases = [
        ("OsmiR156a-5p", "any", "osa-miR156a-5p"), ("OsMIR156", "x", "osa-MIR156"), ("MIR156", "rice", "osa-miR156"), ("miR156", "unknown", "miR156"),
        ("pre-miR156", "wheat", "tae-miR156"), ("pri-miR408", "unknown", "miR408"), ("ath-miR843", "rice", "ath-miR843"), ("PtcmiR156", "poplar", "PtcmiR156"),
        ("anti-miR156", "rice", "anti-miR156"), (" miR1 ", None, "miR1"), ("", "rice", ""), (None, "rice", None),
    ]
    frame = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, name string, species string, want string")
    out = frame.select("want", normalize.normalize_mirna(F.col("name"), F.col("species")).alias("got"), "i").orderBy("i").collect()
    assert [r.got for r in out] == [r.want for r in out]


def test_species(spark):
    def detect(title, text):
        frame = spark.createDataFrame([(title, text)], "title string, block string")
        return frame.select(species.detect_species(mentions.extract_mirnas(F.col("block")), mentions.extract_genes(F.col("block")), F.col("block"), F.col("title"))).first()[0]

    assert detect("Small RNA profiling in peach fruit", "rice rice") == "peach"
    assert detect(None, "osa-miR156a and OsGRF4 in rice") == "rice"
    assert detect(None, "the MADS57 gene") == "banana"
    assert detect(None, "rice and wheat") == "rice"
    assert detect("rice and wheat", "nothing") == "unknown"


BLOCK = "OsmiR396b targets OsGRF4 in rice. Here osa-miR156a/SPL14 and NAC were studied."


def test_pairs(spark):
    frame = spark.createDataFrame([(1, BLOCK, None), (2, "nothing here", None), (3, None, None), (4, "", "")], "k int, block string, title string")
    found = {(r.mirna, r.gene): (r.confidence, r.relation_type, r.sentence[:5]) for r in pairs.mine_pairs(pairs.with_mentions(frame)).collect()}
    crowded = "Unverified (crowded)"
    assert found == {
        ("osa-miR156a", "OsGRF4"): (crowded, "associated", "Osmi"[:4] + "R"), ("osa-miR156a", "SPL14"): ("High confidence", "associated", "Here "),
        ("osa-miR156a", "NAC"): (crowded, "associated", "Here "), ("OsmiR396b", "OsGRF4"): ("Confirmed", "targeting", "OsmiR"),
        ("OsmiR396b", "SPL14"): (crowded, "associated", "Here "), ("OsmiR396b", "NAC"): (crowded, "associated", "Here "),
    }


RECORD = """1. Plant J. 2020 Mar 7;1(2):3-4. doi: 10.1111/xxx.00001.
Epub 2020 Mar 7.

A title of some
length here.

Smith A(1), Wang B(2).

Author information:
(1)Somewhere.

OsmiR396b targets OsGRF4 in rice.

DOI: 10.1111/xxx.00001
PMID: 12345678
"""


def test_records_and_workflow(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(RECORD + "\n2. Short.\n" + RECORD.replace("1. Plant", "\n3. Plant").replace("12345678", "9"))
    read = abstracts.read_abstracts(spark, str(tmp_path / "in"))
    rows = read.orderBy("abstract_index").collect()
    assert [(r.abstract_index, r.pmid, r.doi, r.title, r.body) for r in rows] == [
        (1, "12345678", "10.1111/xxx.00001", "A title of some length here", rows[0].body), (2, "9", "10.1111/xxx.00001", "A title of some length here", rows[1].body),
    ]
    assert rows[0].body.startswith("Epub 2020")  # the first paragraph that is no metadata
    found = workflow.extract_pairs(read)
    assert [(r.idx, r.mirna, r.gene, r.species) for r in found.orderBy("idx").collect()] == [(1, "OsmiR396b", "OsGRF4", "rice"), (2, "OsmiR396b", "OsGRF4", "rice")]
    for form in ("parquet", "csv"):
        abstracts.write_table(found.select("idx", "mirna", "gene", "confidence", "sentence"), str(tmp_path / form), form, exchanged=True)
        again = abstracts.read_pairs(spark, str(tmp_path / form), form)
        assert again.columns == ["idx", "mirna", "gene", "confidence", "sentence"] and sorted(again.collect()) == sorted(found.select(*again.columns).collect())
    verdicts = spark.createDataFrame([], "idx long, is_gene boolean, is_target boolean, relevance string, relation_type string, explanation string")
    reviewed, _ = workflow.review_pairs(found, verdicts)
    groups, detail, stats = workflow.normalize_pairs(reviewed, spark.createDataFrame([("rice", "OsGRF4", "R", "M", "")], "species string, gene string, rap string, msu string, ncbi string"))
    row = groups.first()
    assert (row.mirna, row.pmid_count, row.rap, row.ncbi, detail.count(), stats.first().merged) == ("osa-miR396b (OsmiR396b)", 2, "R", "", 2, 1)


def test_stream_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in (1, 2):
        (tmp_path / "in" / f"{n}.txt").write_text(RECORD)
    query = ingest.start_ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), maxFilesPerTrigger="1")
    query.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 2 and out.select("batch").distinct().count() == 2


def test_review(spark):
    schema = "idx long, mirna string, gene string, species string, title string, sentence string, confidence string, relation_type string"
    rows = [(i, "miR1", "G1", "rice", "t", "s", c, r) for i, (c, r) in enumerate([("Unverified", "targeting")] * 6 + [("Confirmed", "targeting"), ("Confirmed (gene unverified)", "targeting"), (None, None)], 1)]
    found = spark.createDataFrame(rows, schema)

    def answer(prompt):
        n = prompt.count("miRNA: ")
        good = json.dumps([{"is_gene": True, "relevance": "related"}] * n)
        return good if "--- [" not in prompt or n < 5 else "[]"  # a full batch gets a bad answer

    verdicts = spark.createDataFrame([(2, False, False, "related", "x", "a cultivar")], "idx long, is_gene boolean, is_target boolean, relevance string, relation_type string, explanation string")
    reviewed, known = workflow.review_pairs(found, verdicts, answer, size=5)
    got = {r.idx: (r.review_result, r.manual_keep) for r in reviewed.collect()}
    assert got[2] == ("Excluded (non-gene)", "") and got[7] == ("Confirmed (regex high confidence)", "Yes") and got[9] == ("Not reviewed", "")
    assert all(got[i] == ("Weak association", "") for i in (1, 3, 4, 5, 6, 8)) and known.count() == 7


def test_merge_and_feedback(spark):
    schema = "idx long, species string, mirna string, gene string, pmid string, relation_type string, sentence string, title string, doi string, confidence string, review_result string, rationale string, manual_keep string"
    rows = [
        (1, "rice", "miR156", "SPL14", "1", "targeting", "s", "t", None, "Unverified", "Confirmed (targeting)", "r", "Yes"),
        (2, "rice", "OsmiR156", "SPL14", "2", "targeting", "s", "t", "d", "Unverified", "Confirmed (targeting)", "r", "Yes"),
        (3, "rice", "osa-miR156", "SPL14", "2", "cleavage", "u", "", "d", "High confidence (gene unverified)", "Confirmed (x)", "r", "Yes"),
        (4, "wheat", "miR156", "SPL14", "2", "cleavage", "u", "", "d", "Confirmed", "Confirmed (x)", "r", "Yes"),
        (5, "rice", "miR1", "ZZZ1", "2", "cleavage", "u", "", "d", "Unverified", "Excluded (non-gene)", "not a gene", ""),
        (6, "rice", "miR1", "QRS7", "2", "cleavage", "u", "", "d", "Unverified", "Weak association", "", "Y"),
        (7, "rice", "", "QRS7", "2", "cleavage", "u", "", "d", "Unverified", "Confirmed (x)", "", "Yes"),
    ]
    reviewed = spark.createDataFrame(rows, schema)
    merged = {(r.species, r.mirna_norm): r for r in normalize.merge_pairs(normalize.normalized(normalize.kept_pairs(reviewed))).collect()}
    rice = merged["rice", "osa-miR156"]
    assert (rice.mirna, rice.pmid_count, rice.pmids, rice.relation_type, rice.sentences) == ("osa-miR156 (OsmiR156, miR156)", 2, "1, 2", "targeting", "s | u")
    assert set(merged) == {("rice", "osa-miR156"), ("wheat", "tae-miR156"), ("rice", "osa-miR1")}
    names = lambda xs: catalogue.names_table(spark, xs)
    assert [tuple(r) for r in feedback.non_gene_candidates(reviewed, names(BLACKLIST)).collect()] == [("ZZZ1", 1, 1, "not a gene")]
    assert feedback.whitelist_candidates(reviewed, names(WHITELIST)).collect() == []
    assert [r.gene for r in feedback.whitelist_candidates(reviewed.withColumn("gene", F.lit("QRS7")), names(WHITELIST)).collect()] == ["QRS7"]
    with pytest.raises(ValueError):
        feedback.reviewed_only(reviewed.drop("review_result"))
    nothing = geneids.id_stats(spark.createDataFrame([], "species string, gene string"), spark.createDataFrame([], "species string, gene string, rap string, ncbi string")).first()
    assert (nothing.total, nothing.percent) == (0, None)


def test_verdict_parsing(spark):
    bad = ["no json", "", None, "[]", '{"results": 3}']
    assert [len(v) if v is not None else None for v in values(spark, bad, review.parse_verdicts)][3] == 0
    assert values(spark, ['```json\n[{"is_target":true}]\n```'], review.parse_verdicts)[0][0].relevance == "targeting"


def test_a_million_rows_are_numbered_in_order(spark):
    """Rows of unequal width over 32 partitions, with adaptive execution: exactly 1 to n, in order."""
    n = 1_000_000
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        i = F.col("id")
        rows = spark.range(0, n, 1, 32).select(F.pmod(F.xxhash64("id"), F.lit(n // 3)).alias("a"), i.alias("b"), F.when(i % 50 == 0, F.repeat(F.lit("x"), 400)).otherwise("y").alias("w"))
        out = review.number_rows(rows, "a", "b")
        assert tuple(out.agg(F.count("idx"), F.countDistinct("idx"), F.min("idx"), F.max("idx")).first()) == (n, n, 1, n)
        some = out.filter("idx % 997 < 2").orderBy("idx").select("idx", "a", "b").collect()
        assert all((x.a, x.b) < (y.a, y.b) for x, y in zip(some, some[1:], strict=False))
        least = out.filter("idx <= 3").orderBy("idx").select("a", "b").collect()
        assert least == rows.select("a", "b").orderBy("a", "b").limit(3).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
    assert review.number_rows(rows.limit(0), "a", "b").count() == 0


class Service(BaseHTTPRequestHandler):
    """A chat endpoint and two lookups that keep count of their calls."""

    calls: list = []

    def log_message(self, *_):
        pass

    def reply(self, code, text):
        self.send_response(code)
        self.end_headers()
        self.wfile.write(text.encode("gb2312"))

    def do_GET(self):
        self.calls.append(self.path)
        if self.path.startswith("/rice"):
            gene = self.path.split("=")[1]
            row = f"<tr><td>1</td><td>{gene}</td><td>Os01 x</td><td>LOC_1</td><td>XM_5</td></tr>"
            self.reply(200, f"<TABLE id='TBResult'><tr><td>GeneID</td><td>基因</td><td>RAP</td><td>MSU</td><td>NCBI</td></tr>{row if gene != 'OsNONE' else ''}</TABLE>")
        else:
            self.reply(200, json.dumps({"esearchresult": {"idlist": ["42"] if "Rht1%5B" in self.path and "TaRht1" not in self.path else []}}))

    def do_POST(self):
        prompt = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["messages"][0]["content"]
        self.calls.append(prompt)
        if self.headers["Authorization"] != "Bearer good":
            return self.reply(401, "")
        if len(self.calls) == 1:
            return self.reply(429, "")
        if "count" in prompt:
            names = [x["name"] for x in json.loads(prompt[prompt.index("[") :])]
            answer = json.dumps({"results": [{"name": n, "decision": "always_non_gene", "brief": "b"} for n in names]})
        else:
            answer = json.dumps([{"is_gene": False, "relation_type": "none", "explanation": "a cultivar"}] * prompt.count("miRNA: "))
        return self.reply(200, json.dumps({"choices": [{"message": {"content": f"```json\n{answer}\n```"}}]}))


@pytest.fixture
def service(monkeypatch):
    Service.calls = []
    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.setenv("QUILL_TEST_KEY", "good")
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_chat_reviewer(service, monkeypatch):
    chat = adapters.ChatReviewer(f"{service}/chat", "m", "QUILL_TEST_KEY", wait=0, pause=0, between=0)
    assert json.loads(adapters.plain(chat("miRNA: x")))[0]["is_gene"] is False and len(Service.calls) == 2  # a 429 first
    monkeypatch.setenv("QUILL_TEST_KEY", "bad")
    with pytest.raises(PermissionError):
        chat("miRNA: x")
    assert len(Service.calls) == 3 and (chat.single().wait, chat.single().max_tokens, chat.single().timeout) == (3, 300, 30)
    assert adapters.ChatReviewer("http://127.0.0.1:9/none", "m", "QUILL_TEST_KEY", wait=0, pause=0)("x") is None


def test_refused_key_ends_the_job(spark):
    batches = spark.createDataFrame([(i, [i], "p") for i in range(4)], "batch long, ids array<long>, prompt string")

    def refuse(_):
        raise PermissionError("the key was refused")

    with pytest.raises(Exception, match="refused"):
        review.ask(batches, refuse).collect()

    def fail(_):
        raise OSError("away")

    assert [r.response for r in review.ask(batches, fail, retries=2).collect()] == [None] * 4


def test_gene_resolution_end_to_end(spark, service):
    rows = [("rice", "OsSPL14"), ("rice", "OsNONE"), ("wheat", "TaRht1"), ("wheat", "TaZ"), ("maize", "None1"), ("unknown", "X1")]
    groups = spark.createDataFrame(rows + rows, "species string, gene_norm string")
    rice, entity = adapters.HttpLookup(f"{service}/rice?para={{}}", "gb2312", pause=0), adapters.HttpLookup(f"{service}/search?term={{}}", pause=0)
    out = {(r.species, r.gene): (r.rap, r.msu, r.ncbi) for r in geneids.resolve_ids(groups, rice, entity).collect()}
    assert out == {
        ("rice", "OsSPL14"): ("Os01", "LOC_1", "XM_5"), ("rice", "OsNONE"): ("", "", ""), ("wheat", "TaRht1"): ("", "", "42"), ("wheat", "TaZ"): ("", "", ""), ("maize", "None1"): ("", "", ""),
    }
    assert len(Service.calls) == 6  # each gene once, the prefixed one with its second term
    assert adapters.HttpLookup("http://127.0.0.1:9/{}", pause=0)("x") is None


def test_review_resumes_from_saved_verdicts(spark, tmp_path):
    schema = "idx long, mirna string, gene string, species string, title string, sentence string, confidence string, relation_type string"
    found = spark.createDataFrame([(i, "miR1", "G1", "rice", "t", "s", "Unverified", "targeting") for i in range(1, 41)], schema)
    path, down = str(tmp_path / "verdicts"), tmp_path / "down"
    good = json.dumps([{"is_gene": True, "relevance": "related"}])

    def answer(prompt):
        if down.exists():
            raise PermissionError("the key was refused")
        return good if "--- [" not in prompt else json.dumps(json.loads(good) * prompt.count("miRNA: "))

    assert abstracts.read_verdicts(spark, path).count() == 0
    first = workflow.answered(found.filter("idx <= 10"), answer)
    abstracts.append_verdicts(first, path)
    down.touch()
    with pytest.raises(Exception, match="refused"):
        workflow.review_into(found, path, answer, save_every=3)
    assert abstracts.read_verdicts(spark, path).count() == 10  # what was answered before is safe
    down.unlink()
    out = workflow.review_into(found, path, answer, save_every=3)
    assert out.filter("review_result = 'Weak association'").count() == 40 == abstracts.read_verdicts(spark, path).count()
    down.touch()
    assert workflow.review_into(found, path, answer).filter("review_result = 'Weak association'").count() == 40  # nothing is asked again


def test_review_status_golden_cases(spark):
    schema = "idx long, confidence string, relation_type string"
    found = spark.createDataFrame([(1, "Unverified", "targeting"), (2, "Unverified", "x"), (3, "Unverified", "x"), (4, "Unverified", "x"), (5, "Confirmed", "targeting"), (6, "Confirmed (gene unverified)", "targeting")], schema)
    verdicts = spark.createDataFrame([(1, False, True, "targeting", "x", "n"), (2, True, False, "targeting", "cleavage", "n"), (3, True, False, "related", "x", "n"), (4, True, False, "unrelated", "x", "")], abstracts.VERDICTS)
    out = {r.idx: (r.review_result, r.rationale) for r in review.merge_verdicts(found, verdicts).collect()}
    assert [out[i][0] for i in range(1, 7)] == [
        "Excluded (non-gene)", "Confirmed (cleavage)", "Weak association", "Excluded (non-target)", "Confirmed (regex high confidence)", "Not reviewed",
    ]
    assert out[4][1] == "Pure co-occurrence / enumeration, no biological relevance"


def test_feedback_golden_cases(spark):
    schema = "idx long, gene string, pmid string, confidence string, review_result string, rationale string"
    names = lambda xs: catalogue.names_table(spark, xs)
    rows = [(1, "ZZZ1", "1", "Unverified", "Excluded (non-gene)", "r"), (2, "QRS7", "1", "Unverified", "Confirmed (x)", "r"), (3, "QRS7", "2", "Unverified", "Confirmed (y)", "r")]
    rows += [(4, "QRS8", "1", "High confidence (gene unverified)", "Confirmed (x)", "r"), (5, "QRS8", "2", "High confidence (gene unverified)", "Confirmed (x)", "r"), (6, "QRS9", "1", "Unverified", "Confirmed (x)", "r")]
    frame = spark.createDataFrame(rows, schema)
    assert [r.gene for r in feedback.non_gene_candidates(frame, names(BLACKLIST)).collect()] == ["ZZZ1"]
    assert [(r.gene, r.n, r.pmid_count, r.relations) for r in feedback.whitelist_candidates(frame, names(WHITELIST)).collect()] == [("QRS7", 2, 2, "x, y")]
    judged = feedback.judge(feedback.non_gene_candidates(frame, names(BLACKLIST)), lambda _: "no answer")
    assert judged.count() == 0  # proposed again next time


def test_command_lines(spark, service, tmp_path, capsys):
    spark.sparkContext.environment["QUILL_TEST_KEY"] = "good"  # what workers find in their environment
    out, texts = str(tmp_path / "out"), tmp_path / "a.txt"
    texts.write_text(RECORD.replace("OsmiR396b targets OsGRF4 in rice.", "OsmiR396b targets OsGRF4 in rice. Both miR1 and ABC1 were associated with the target gene XYZ1."))
    run = lambda *args: cli.main([*args, "--out", out], spark)
    run("extract", str(texts))
    assert spark.read.parquet(f"{out}/statistics").count() == 4
    run("review")
    assert spark.read.parquet(f"{out}/reviewed").filter("`LLM Review Result` = 'Not reviewed'").count() > 0
    Service.calls.append("past the first")
    run("review", "--url", f"{service}/chat", "--model", "m", "--key-variable", "QUILL_TEST_KEY")
    assert spark.read.parquet(f"{out}/verdicts").count() > 0
    run("normalize", "--rice-url", f"{service}/rice?para={{}}", "--statistics", f"{out}/statistics")
    final = spark.read.parquet(f"{out}/final_groups").collect()
    assert [(r.no, r.rap, r.style) for r in final] == [(1, "Os01", "none")]
    rows = spark.read.parquet(f"{out}/final_statistics").collect()
    assert sum(r.part == 0 for r in rows) == 4 and any(r.label == "Resolved" and (r.value, r.note) == ("1", "100.0%") for r in rows)
    run("learn")
    assert "blacklist: " in capsys.readouterr().out and not os.path.exists(f"{out}/lists")
    chat = ("--url", f"{service}/chat", "--model", "m", "--key-variable", "QUILL_TEST_KEY")
    run("learn", *chat)
    assert "preview only" in capsys.readouterr().out and not os.path.exists(f"{out}/lists")
    run("learn", *chat, "--apply")
    assert len(os.listdir(f"{out}/lists")) == 1
    with pytest.raises(FileNotFoundError):
        cli.main(["learn", "--out", str(tmp_path / "none")], spark)


def test_shared_folder_of_a_cluster_is_never_local():
    session = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn"), conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError):
        durable.shared_folder(session)


def test_empty_inputs(spark):
    frame = spark.createDataFrame([], "k long, block string, title string")
    assert pairs.mine_pairs(pairs.with_mentions(frame)).count() == 0
    assert records.split_records(spark.createDataFrame([], "file_id long, content string")).count() == 0
    assert pairs.mention_stats(pairs.with_mentions(frame), pairs.mine_pairs(pairs.with_mentions(frame)), ["k"]).first().total == 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def plain(frame):
    frame = frame[sorted(frame.columns)]
    clean = lambda v: None if v is None or v is pd.NA or (isinstance(v, float) and v != v) else round(v, 6) if isinstance(v, float) else v if isinstance(v, bool) else str(v)
    return sorted(repr([clean(v) for v in row]) for row in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", ["records_split", "meta_title", "sentences_split", "mirna_all", "gene_all", "species_votes", "pairs_full", "review_merge", "dedup_merge", "gene_id_join", "whitelist_candidates", "dictionary_apply", "row_style", "statistics_table", "html_table_cells", "gene_resolution", "judge_whitelist_batches", "judge_decisions"])
def test_sql_counterparts(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    assert plain(catalogue.queries()[name](spark, SF).toPandas()) == plain(con.execute(catalogue.oracle_sql()[name]).df())
