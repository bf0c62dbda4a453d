"""The relation miner on inputs of any size: split files, long records, long lists, hot groups, full batches, broken answers."""

import json
import random
import re
import threading
import time
import zipfile
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from quillspark.functions.dictionaries import BLACKLIST, RELATION_SIGNALS, WHITELIST, Dictionaries, ListTables
from quillspark.functions.evidence import first_seen
from quillspark.operators import feedback, geneids, mentions, normalize, pairs, records, review, sentences
from quillspark.plans import workflow
from quillspark.sources import abstracts, adapters, splits, workbooks
from quillspark.streaming import ingest

# --- record reader


def plain_records(text, least=50):
    blocks = [b.strip() for b in re.split(r"\n(?=\d+\.\s+\w)", text.replace("\r\n", "\n").replace("\r", "\n"))]
    return [b for b in blocks if len(b) > least]


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    saved = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


def test_records_over_many_splits(spark, tmp_path, small_splits):
    """Records that span splits, numbers that stand alone, blank lines at the edges, all line ends, files without a record."""
    rng = random.Random(4)
    line = lambda: rng.choice(["", "", "a line of text, see 3. Results", "12.", "13. ", "  ", "7. Word of a list", "é 漢字 🌾 " * 5, "x" * 120, "word", "5.", "9.\tTab"])
    texts = {f"{i}.txt": rng.choice(["\n", "\r\n"]).join(line() for _ in range(rng.randint(1, 120))) for i in range(12)}
    texts |= {"long.txt": "1. Long\n" + "y" * 3000 + "\n" + "z\n" * 700 + "2. Next\n" + "w " * 60, "old.txt": "\r".join(["1. Plant", "v" * 60, "", "2. Plant", "u" * 60]), "none.txt": "q\n" * 900}
    texts |= {"blank.txt": "1. A" + "\n" * 1500 + "rest of it " * 8 + "\n", "empty.txt": "", "end.txt": "1. A " + "b" * 60 + "\n2."}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    read = splits.read_records(spark, str(tmp_path))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan  # blocks stay where they were read
    found = {}
    for r in read.collect():
        found.setdefault(r.file_id.rsplit("/", 1)[1], {})[r.abstract_index] = r.block
    want = {name: dict(enumerate(plain_records(text), 1)) for name, text in texts.items()}
    assert found == {name: blocks for name, blocks in want.items() if blocks}
    assert spark.read.text(str(tmp_path)).select("_metadata.file_path", "_metadata.file_block_start").distinct().count() > 60
    whole = spark.read.text(str(tmp_path), wholetext=True).select(F.input_file_name().alias("file_id"), F.col("value").alias("content"))
    assert sorted(map(tuple, records.split_records(whole).collect())) == sorted(map(tuple, read.collect()))


def test_split_records_needs_no_shuffle(spark):
    files = spark.createDataFrame([(1, "1. A " + "b" * 60 + "\n2. Short\n3. C " + "d" * 60), (2, ""), (3, None)], "file_id long, content string")
    found = records.split_records(files)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert [(r.file_id, r.abstract_index, r.block[:4]) for r in found.orderBy("abstract_index").collect()] == [(1, 1, "1. A"), (1, 2, "3. C")]


# --- pairs of long records


def plain_pairs(text, ms, gs, spans):
    """Every occurrence pair of a record, as the rule is written: the closest by sentence, the most relation words in between, the first."""

    def sid(pos):
        return next(i for i, s in enumerate(spans) if s.start <= pos < s.end)

    def score(t):
        return sum(w in t.lower() for w in RELATION_SIGNALS)

    out, said = {}, lambda i: text[spans[i].start : spans[i].end].strip()
    where = [(m.name, sid(m.start), "m") for m in ms] + [(g.name, sid(g.start), "g") for g in gs]
    for m in dict.fromkeys(x.name for x in ms):
        for g in dict.fromkeys(x.name for x in gs):
            best = None
            for i, x in enumerate(ms):
                for j, y in enumerate(gs):
                    if x.name == m and y.name == g:
                        low, high = sorted((sid(x.start), sid(y.start)))
                        key = (high - low, -score(text[spans[low].start : spans[high].end]), i, j)
                        best = min(best or (key, x, y, low, high), (key, x, y, low, high), key=lambda b: b[0])
            (sd, *_), x, y, low, high = best
            if sd == 0 or sd == 1 and abs(x.start - y.start) <= 400:
                inside = lambda kind: {n for n, s, k in where if k == kind and low <= s <= high}
                usable = [i for i in range(low, high + 1) if m in said(i) or g in said(i)]
                chosen = max(usable, key=lambda i: (m in said(i) and g in said(i), g in said(i), score(said(i)), -i), default=sid(y.start))
                span = text[min(x.start, y.start) : max(x.end, y.end)]
                out[m, g] = (said(low) if sd == 0 else said(chosen), len(inside("m")) > 1 or len(inside("g")) > 1, f"{m}/{g}" in span or f"{g}/{m}" in span or f"{m}-{g}" in span)
    return out


PIECES = (
    "osa-miR156a miR172 miR156 OsmiR396b.2 pre-miR408 MIR98 SPL14 SPL9 NAC AP2 OsGRF4 Os SPL14 LOC_Os08g42700.1 TIR1 HsfA1 gene targets represses binding cleaved in rice the and "
    "osa-miR156a/SPL14 miR164-NAC1 regulate"
).split(" ")


def random_text(rng, n):
    return "".join(rng.choice(PIECES) + rng.choice([" "] * 8 + [". ", ". ", "\n", "\n\n", ", "]) for _ in range(n))


def test_pairs_equal_plain_rule(spark):
    """Short records, and long ones, whose mentions are searched by halving."""
    rng = random.Random(6)
    texts = [random_text(rng, rng.choice([3, 8, 15, 40])) for _ in range(60)] + [random_text(rng, 500) for _ in range(3)]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "k int, block string, title string")
    mentioned = pairs.with_mentions(df).cache()
    best, told = F.col("best"), F.col("told")
    rows = pairs.near_pairs(pairs.best_occurrences(mentioned)).select(
        "k", best["m"]["name"].alias("m"), best["g"]["name"].alias("g"), pairs.evidence(best, told).alias("s"), "told.crowded", pairs.is_explicit(best, told).alias("explicit")
    )
    found = {}
    for r in rows.collect():
        found.setdefault(r.k, {})[r.m, r.g] = (r.s, r.crowded, r.explicit)
    for r in mentioned.collect():
        assert found.get(r.k, {}) == plain_pairs(r.block, r.mirnas, r.genes, r.sentences), r.block
    assert max(len(r.mirnas) for r in mentioned.collect()) > 2 * pairs.FEW


def test_order_of_pairs_is_the_order_of_names(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(i, random_text(rng, n), None) for i, n in enumerate((30, 400))], "k int, block string, title string")
    mentioned = pairs.with_mentions(df)
    names = {r.k: (list(dict.fromkeys(m.name for m in r.mirnas)), list(dict.fromkeys(g.name for g in r.genes))) for r in mentioned.collect()}
    for k, (ms, gs) in names.items():
        found = [(r.mirna, r.gene) for r in pairs.mine_pairs(mentioned).filter(F.col("k") == k).orderBy("m_ord", "g_ord").collect()]
        assert found == sorted(found, key=lambda p: (ms.index(p[0]), gs.index(p[1]))) and len(found) > 5


def test_time_grows_with_a_records_length(spark):
    text = "OsmiR396b targets OsGRF4 in rice. Here osa-miR156a/SPL14 and NAC were studied. We found that miR172 represses the expression of AP2 genes. "

    def seconds(n):
        df = spark.createDataFrame([(0, text * n, None)], "k int, block string, title string")
        start = time.time()
        pairs.mine_pairs(pairs.with_mentions(df)).write.format("noop").mode("overwrite").save()
        return time.time() - start

    seconds(10)
    assert min(seconds(2000) for _ in range(2)) < 2.5 * min(seconds(1000) for _ in range(2)) + 1


def test_offsets_and_sentences_of_long_texts(spark):
    """More parts than one stretch of running sums."""
    rng = random.Random(2)
    text = random_text(rng, 2000)
    row = spark.createDataFrame([(text,)], "t string").select(mentions.extract_mirnas(F.col("t")).alias("m"), sentences.split_sentences(F.col("t")).alias("s")).first()
    assert len(row.m) > 300 and all(text[m.start : m.end] == m.name for m in row.m)
    assert len(row.s) > 200 and all(text[s.start : s.end] == s.text for s in row.s) and all(a.end <= b.start and text[a.end : b.start] == a.gap for a, b in zip(row.s, row.s[1:], strict=False))


# --- lists as tables


def test_long_lists_equal_short_ones(spark, monkeypatch):
    """A million more names than the corpus holds give the same mentions; broadcast or not."""
    rng = random.Random(1)
    blocks = spark.createDataFrame([(i, random_text(rng, 30) + " PCR WRKY45 ABC gene", None) for i in range(40)], "k int, block string, title string")
    short = Dictionaries((*BLACKLIST, "SPL9"), (*WHITELIST, "ABC"))
    own = spark.createDataFrame([("blacklist", n) for n in short.blacklist] + [("whitelist", n) for n in short.whitelist], "list string, name string")
    more = spark.range(1_000_000).select(F.when(F.col("id") % 2 == 0, "blacklist").otherwise("whitelist").alias("list"), F.concat(F.lit("Zzq"), F.col("id").cast("string")).alias("name"))
    rows = lambda df: sorted((r.k, r.mirnas, r.genes, r.species) for r in df.select("k", "mirnas", "genes", "species").collect())
    want = rows(pairs.with_mentions(blocks, short))
    assert any(g.confidence == "Unverified" for r in want for g in r[2]) and any(g.name == "ABC" for r in want for g in r[2])
    tables = ListTables(own.union(more))
    assert rows(pairs.with_mentions(blocks, tables)) == want
    monkeypatch.setattr(pairs, "MOST_BROADCAST", 0)
    assert rows(pairs.with_mentions(blocks, tables)) == want
    assert rows(pairs.with_mentions(blocks, ListTables(own.limit(0)))) == rows(pairs.with_mentions(blocks, Dictionaries((), ())))


def test_read_dictionaries_of_any_length(spark, tmp_path, monkeypatch):
    made = spark.createDataFrame([("blacklist", "A1"), ("whitelist", "B2"), ("whitelist", "B2")], "list string, name string")
    path = abstracts.write_dictionaries(made, str(tmp_path))
    assert abstracts.read_dictionaries(spark, path) == Dictionaries(("A1",), ("B2",))
    monkeypatch.setattr(abstracts, "MOST_LITERALS", 1)
    assert abstracts.read_dictionaries(spark, path).names.count() == 2


# --- hot groups


def test_hot_group_is_merged_by_distinct_values(spark):
    """One group holds a third of all rows; what is gathered are its distinct values."""
    n = 30_000
    i = F.col("id")
    rows = spark.range(n).select(
        (n - i).alias("idx"), F.lit("rice").alias("species"), F.lit("miR1").alias("mirna"), F.lit("osa-miR1").alias("mirna_norm"),
        F.when(i % 3 == 0, "HOT").otherwise(F.concat(F.lit("G"), (i % 1000).cast("string"))).alias("gene"), (i % 7).cast("string").alias("pmid"),
        F.concat(F.lit("s"), (i % 5).cast("string")).alias("sentence"), F.lit("").alias("title"), F.lit(None).cast("string").alias("doi"), F.when(i % 2 == 0, "b").otherwise("a").alias("relation_type"),
    ).withColumn("gene_norm", F.col("gene"))
    seen = first_seen(rows, ["gene"], F.col("idx"), pmid=F.col("pmid"), sentence=F.col("sentence"))
    hot = {(r.kind, r.value): (r.first, r.n) for r in seen.filter("gene = 'HOT'").collect()}
    mine = [r for r in rows.filter("gene = 'HOT'").collect()]
    assert len(hot) == 12 and hot["pmid", "3"] == (min(r.idx for r in mine if r.pmid == "3"), sum(r.pmid == "3" for r in mine))
    merged = normalize.merge_pairs(rows).filter("gene_norm = 'HOT'").first()
    order = lambda c: list(dict.fromkeys(r[c] for r in sorted(mine, key=lambda r: r.idx)))
    assert (merged.pmid_count, merged.pmids, merged.sentences) == (7, ", ".join(order("pmid")), " | ".join(order("sentence")))
    assert (merged.titles, merged.dois, merged.relation_type) == ("", "", "a" if sum(r.relation_type == "a" for r in mine) >= 5000 else "b")
    reviewed = rows.withColumn("review_result", F.lit("Excluded (non-gene)")).withColumn("rationale", F.concat(F.lit("why "), (F.col("idx") % 4000).cast("string")))
    listed = spark.createDataFrame([("G1",)], "name string")
    found = {r.gene: r for r in feedback.non_gene_candidates(reviewed, listed).collect()}
    assert (found["HOT"].n, found["HOT"].pmid_count, found["HOT"].reasons) == (10_000, 7, "; ".join(f"why {r.idx % 4000}" for r in sorted(mine, key=lambda r: r.idx)[:2])) and "G1" not in found


# --- batches of pending pairs


def test_batches_are_full_of_pending_pairs(spark):
    found = spark.range(1, 1001).select(F.col("id").alias("idx"), *[F.lit("x").alias(c) for c in ("mirna", "gene", "species", "title", "sentence", "relation_type")], F.lit("Unverified").alias("confidence"))
    known = found.filter("idx % 10 <> 0").select("idx", F.lit(True).alias("is_gene"), F.lit(False).alias("is_target"), *[F.lit("x").alias(c) for c in ("relevance", "relation_type", "explanation")])
    todo = workflow.unanswered(found, known)
    batches = review.review_batches(todo, 5).orderBy("batch").collect()
    assert [b.n for b in batches] == [5] * 20 and [i for b in batches for i in b.ids] == list(range(10, 1001, 10))
    parts = list(review.rounds(review.in_batches(todo, 5), 8))
    assert len(parts) > 1 and sorted(b.n for p in parts for b in review.review_batches(p, 5).collect()) == [5] * 20


# --- answers that are cut off


class Cut(BaseHTTPRequestHandler):
    """Says more than it sends, twice; then answers."""

    calls = 0

    def log_message(self, *_):
        pass

    def answer(self):
        type(self).calls += 1
        body = json.dumps({"choices": [{"message": {"content": "[]"}}]}).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body[: 9 if type(self).calls <= 2 else None])

    do_GET = answer

    def do_POST(self):
        self.rfile.read(int(self.headers["Content-Length"]))
        self.answer()


def test_cut_off_answers_are_tried_again(monkeypatch):
    Cut.calls = 0
    server = HTTPServer(("127.0.0.1", 0), Cut)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.setenv("QUILL_TEST_KEY", "k")
    url = f"http://127.0.0.1:{server.server_port}"
    assert adapters.ChatReviewer(url, "m", "QUILL_TEST_KEY", wait=0, pause=0, between=0)("p") == "[]" and Cut.calls == 3
    Cut.calls = 0
    assert adapters.HttpLookup(url + "/{}", pause=0)("x") is None
    server.shutdown()


def test_cut_off_answer_is_no_answer(spark):
    def broken(_):
        import http.client

        raise http.client.IncompleteRead(b"")

    batches = spark.createDataFrame([(1, [1], "p")], "batch long, ids array<long>, prompt string")
    assert [r.response for r in review.ask(batches, broken).collect()] == [None]


# --- lookups


class Counted(BaseHTTPRequestHandler):
    """Keeps the time of each call."""

    calls: list = []

    def log_message(self, *_):
        pass

    def do_GET(self):
        self.calls.append((time.time(), self.path))
        body = b"found" if "miss" not in self.path else b""
        self.send_response(200 if body else 500)
        self.end_headers()
        self.wfile.write(body)


@pytest.fixture
def counted():
    Counted.calls = []
    server = HTTPServer(("127.0.0.1", 0), Counted)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_one_limit_for_a_service(spark, counted):
    """Four tasks at once, and still no second with more calls than the limit."""
    terms = spark.range(60).select(F.lit("rice").alias("species"), F.col("id").cast("string").alias("gene"), F.concat(F.lit("t"), "id").alias("term"))
    found = geneids.answers(terms, adapters.HttpLookup(counted + "/{}", pause=0), workers=4, per_second=20).collect()
    at = sorted(t for t, _ in Counted.calls)
    assert len(found) == len(at) == 60 and {r.answer for r in found} == {"found"}
    assert max(sum(a <= b < a + 0.95 for b in at) for a in at) <= 20 and at[-1] - at[0] < 12


def test_slots_are_shared_out():
    pace = geneids.Pace(1000, 3, time.time())
    used = {task: [] for task in range(3)}
    for task in used:
        last = -1
        for _ in range(5):
            last = pace.slot(task, last)
            used[task].append(last)
    assert all(n % 3 == task for task, ns in used.items() for n in ns) and all(len(set(ns)) == 5 for ns in used.values())


def test_saved_answers_are_not_asked_again(spark, counted, tmp_path):
    lookup, saved = adapters.HttpLookup(counted + "/{}", pause=0), str(tmp_path / "answers")
    terms = spark.createDataFrame([("rice", f"g{i}", f"t{i}") for i in range(20)] + [("rice", "h", "t1"), ("rice", "m", "miss")], "species string, gene string, term string")
    part = terms.filter("term IN ('t1', 't2', 't3')")
    assert geneids.kept_answers(part, lookup, "s", saved, size=2, workers=2).filter("answer = 'found'").count() == 4 and len(Counted.calls) == 3
    found = {r.gene: r.answer for r in geneids.kept_answers(terms, lookup, "s", saved, size=5, workers=2).collect()}
    assert len(Counted.calls) == 21 and found["h"] == found["g1"] == "found" and found["m"] is None
    geneids.kept_answers(terms, lookup, "s", saved).count()
    assert len(Counted.calls) == 22  # only the one that failed
    geneids.kept_answers(part, lookup, "other", saved).count()
    assert len(Counted.calls) == 25


# --- workbooks


def test_workbook_round_trip(spark, tmp_path):
    """Three sheets with fills, read back as they were written; the header probe finds the review column."""
    made = [(i, f"osa-miR{i}", 'A<B> & "C"\n漢字 🌾 \x01' if i == 3 else None if i == 4 else f" s{i} ", i / 4, i % 2 == 0, ("green", "none", "blue")[i % 3]) for i in range(50, 0, -1)]
    detail = spark.createDataFrame(made, "`#` long, miRNA string, `Source Sentence` string, share double, kept boolean, style string").repartition(3)
    reviewed = detail.drop("style").withColumn("LLM Review Result", F.lit("Confirmed (x)"))
    stats = spark.createDataFrame([("Total", 3)], "label string, value long")
    path = str(tmp_path / "out" / "final.xlsx")
    workbooks.write_workbook({"Detail": detail, "Reviewed & more": reviewed, "Statistics": stats, "Empty": stats.limit(0)}, path, {"Detail": ("#",), "Reviewed & more": ("#",)})
    read = lambda sheet: spark.read.format("xlsx").option("sheet", sheet).load(path)
    found = read("Detail")
    assert found.columns == ["#", "miRNA", "Source Sentence", "share", "kept"]
    want = [(str(i), m, s.replace("\x01", " ") if s else None, str(x), "true" if k else "false") for i, m, s, x, k, _ in sorted(made)]
    assert [tuple(r) for r in found.collect()] == want
    assert "LLM Review Result" in read("Reviewed & more").columns and read("Statistics").collect() == [("Total", "3")]
    assert read("Empty").columns == ["label", "value"] and read("Empty").count() == 0 and spark.read.format("xlsx").load(path).count() == 50
    with zipfile.ZipFile(path) as book:
        sheet = book.read("xl/worksheets/sheet1.xml").decode()
    assert re.findall(r'<row r="\d+"><c r="A\d+" s="(\d)"', sheet)[:4] == ["1", "0", "6", "2"]  # header, none, blue, green
    pairs_read = abstracts.read_pairs(spark, path, "xlsx")
    assert pairs_read.columns[:3] == ["idx", "mirna", "sentence"] and pairs_read.count() == 50


def test_workbook_of_another_hand(spark, tmp_path):
    """Shared strings, gaps between cells, a formula's error, rows without cells, columns in another order in a second file."""
    main, rel = workbooks.MAIN, workbooks.RELATIONS
    for n, cells in enumerate((("a", "b"), ("b", "a"))):
        with zipfile.ZipFile(tmp_path / f"{n}.xlsx", "w") as book:
            book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="x"/></sheets></workbook>')
            book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="p"><Relationship Id="x" Target="/xl/worksheets/one.xml"/></Relationships>')
            book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>{cells[0]}</t></si><si><r><t>{cells[1]}</t></r></si><si><r><t>two </t></r><r><t>runs</t></r></si></sst>')
            book.writestr(
                "xl/worksheets/one.xml",
                f'<worksheet xmlns="{main}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row r="2"/>'
                f'<row r="3"><c r="C3" t="s"><v>2</v></c></row><row r="4"><c r="A4"><v>1.5</v></c><c r="B4" t="b"><v>1</v></c><c r="C4" t="e"><v>#N/A</v></c></row></sheetData></worksheet>',
            )
    workbooks.register(spark)
    found = spark.read.format("xlsx").load(str(tmp_path))
    assert found.columns == ["a", "_c1", "b"] and sorted(map(tuple, found.collect()), key=str) == sorted([(None, None, "two runs"), ("1.5", "true", None), ("two runs", None, None), (None, "true", "1.5")], key=str)
    with pytest.raises(Exception, match="nothing.xlsx"):
        spark.read.format("xlsx").load(str(tmp_path / "nothing.xlsx")).count()


def test_workbook_limits(spark, tmp_path, monkeypatch):
    assert [workbooks.column_name(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"] and all(workbooks.column_number(f"{workbooks.column_name(i)}9") == i for i in range(800))
    with pytest.raises(Exception, match="characters"):
        workbooks.write_workbook({"S": spark.range(1).select(F.repeat(F.lit("x"), 40_000).alias("a"))}, str(tmp_path / "long.xlsx"))
    assert not list(tmp_path.iterdir())


# --- figures that add up


def reviewed_rows(spark, n):
    i = F.col("id")
    return spark.range(1, n + 1).select(
        i.alias("idx"), F.when(i % 3 == 0, "rice").otherwise("wheat").alias("species"), F.concat(F.lit("miR"), i % 40).alias("mirna"), F.concat(F.lit("SPL"), i % 60).alias("gene"),
        F.concat(F.lit("p"), i % 1500).alias("pmid"), F.when(i % 4 == 0, "cleavage").otherwise("targeting").alias("relation_type"), F.concat(F.lit("s"), i % 9).alias("sentence"),
        F.lit("t").alias("title"), F.lit("").alias("doi"), F.lit("Confirmed").alias("confidence"), F.when(i % 5 == 0, "Weak association").otherwise("Confirmed (x)").alias("review_result"), F.lit("").alias("manual_keep"),
    )


def test_stream_of_pairs_equals_batch(spark, tmp_path):
    """Three batches and one of them again: the groups are those of all pairs at once; a batch that is run again replaces itself."""
    found, out = reviewed_rows(spark, 600), str(tmp_path / "kept")
    for n, part in enumerate((found.filter("idx <= 200"), found.filter("idx > 150 AND idx <= 400"), found.filter("idx <= 200"), found.filter("idx > 400"))):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ingest.start_merging(spark.readStream.schema(found.schema).parquet(str(tmp_path / "in")), out, str(tmp_path / "state")).awaitTermination(120)
        assert len(list((tmp_path / "kept" / "evidence").glob("batch=*"))) == n + 1
    rows = lambda df: sorted(map(tuple, df.collect()))
    want = rows(normalize.merge_pairs(normalize.normalized(normalize.kept_pairs(found))))
    assert rows(ingest.current_groups(spark, out)) == want and len(want) > 50
    ingest.merge_batch(found.filter("idx > 400"), 3, out)
    assert rows(ingest.current_groups(spark, out)) == want


def test_part_statistics_add_up(spark):
    found = reviewed_rows(spark, 6000)
    exact = pairs.pair_stats(found).first()
    parts = pairs.part_stats(found.withColumn("part", F.col("idx") % 7), "part")
    told = pairs.summed_stats(parts).first()
    assert parts.count() == 7 and told.pairs == exact.pairs == 6000
    for c in ("pmids", "mirnas", "genes"):
        assert abs(told[c] - exact[c]) <= 0.05 * exact[c]
    levels = {(r.level, r.value): (r.pairs, r.confirmed, r.pmids) for r in review.status_levels(found).collect()}
    assert levels["total", ""] == (6000, 4800, 1500) and levels["status", "Weak association"][:2] == (1200, 0) and levels["species", "rice"][0] == 2000 and len(levels) == 7
