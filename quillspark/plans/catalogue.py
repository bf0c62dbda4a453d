"""Registered queries of the relation miner and their SQL counterparts."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.dictionaries import BLACKLIST, ORGANISMS, STRIP_PREFIXES, WHITELIST
from quillspark.functions.durable import durable
from quillspark.functions.text import find_all, let, literals
from quillspark.operators import feedback, geneids, mentions, normalize, pairs, records, review, sentences, species
from quillspark.plans.corpus import corpus, files, verdicts
from quillspark.plans.oracle import HYPHEN, JOURNAL, NEAR, RELATION, STRONG, oracle, quoted, score

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def block() -> Column:
    return F.col("block")


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its name with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle(sql)
        return f

    return add


# --- stages that several queries share


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.with_metadata(corpus(spark, sf_dir))


def mentioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.with_mentions(meta(spark, sf_dir))


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.near_pairs(pairs.best_occurrences(mentioned(spark, sf_dir)))


def mined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs with a running number by abstract, miRNA and gene."""
    found = pairs.mine_pairs(mentioned(spark, sf_dir)).select(
        "k", "m_ord", "g_ord", "mirna", "gene", "gene_confidence", "relation_confidence", "confidence", "relation_type", "sentence", "species", "pmid", "doi", "title"
    )
    return review.number_rows(durable(found), "k", "m_ord", "g_ord").drop("m_ord", "g_ord")  # sorting by ranges reads its input more than once


def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mined(spark, sf_dir)
    return review.merge_verdicts(found, verdicts(found.select("idx")))


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalized(normalize.kept_pairs(reviewed(spark, sf_dir)))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.merge_pairs(normalized(spark, sf_dir))


def gene_ids(keys: DataFrame) -> DataFrame:
    """A lookup table derived from gene names."""
    n = F.length("gene")
    return keys.filter(n != 5).select(
        "species", "gene", F.when(n % 3 == 0, F.concat(F.lit("Os"), "gene")).otherwise("").alias("rap"), F.concat(F.lit("LOC_"), "gene").alias("msu"),
        F.when(n % 2 == 0, n.cast("string")).otherwise("").alias("ncbi"),
    )


def names_table(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.range(1).select(F.explode(literals(names)).alias("name"))


def exploded(df: DataFrame, mention_array: str, *fields: str) -> DataFrame:
    # an inner explode would filter by size first and compute the array again for that
    return df.select("k", F.explode_outer(mention_array).alias("x")).filter("x IS NOT NULL").select("k", *[F.col(f"x.{f}") for f in fields])


# --- records and metadata


@query(r"""SELECT k - k % 5 AS file_id, row_number() OVER (PARTITION BY k - k % 5 ORDER BY k)::INT AS abstract_index, regexp_replace(block, '^\s+|\s+$', '', 'g') AS block FROM corpus""")
def records_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.split_records(files(spark, sf_dir))


@query(r"""SELECT file_id, count(*) AS n, min(length(b))::INT AS shortest FROM (SELECT file_id, regexp_replace(p, '^\s+|\s+$', '', 'g') AS b FROM (
    SELECT doc_id - doc_id % 4 AS file_id, unnest(string_split(regexp_replace(string_agg((doc_id % 7)::VARCHAR || '. Rec' || repeat('x', (doc_id % 61)::INT), chr(10) ORDER BY doc_id), '\n(\d+\.\s+\w)', chr(1) || '\1', 'g'), chr(1))) AS p
    FROM documents WHERE doc_id IS NOT NULL GROUP BY 1)) WHERE length(b) > 50 GROUP BY file_id""")
def records_len_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id IS NOT NULL").select("doc_id")
    line = F.expr("CAST(doc_id % 7 AS STRING) || '. Rec' || repeat('x', CAST(doc_id % 61 AS INT))")
    made = docs.groupBy(F.expr("doc_id - doc_id % 4").alias("file_id")).agg(F.array_sort(F.collect_list(F.struct("doc_id", line.alias("l")))).alias("ls"))
    content = made.select("file_id", F.array_join(F.transform("ls", lambda x: x["l"]), "\n").alias("content"))
    return records.split_records(content).groupBy("file_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.length("block")).alias("shortest"))


@query("SELECT k, pmid FROM meta")
def meta_pmid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("k", records.pmid_of(block()).alias("pmid"))


@query("SELECT k, doi FROM meta")
def meta_doi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("k", records.doi_of(block()).alias("doi"))


@query("SELECT k, title FROM meta")
def meta_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("k", records.title_of(block()).alias("title"))


@query("SELECT k, body FROM meta")
def abstract_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("k", records.body_of(block()).alias("body"))


@query(f"SELECT k, i - 1 AS line_no, {JOURNAL} AS continues FROM lines WHERE line <> ''")
def journal_continuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = corpus(spark, sf_dir).select("k", F.posexplode(F.split("block", "\n", -1)).alias("line_no", "raw"))
    stripped = lines.select("k", F.col("line_no").cast("long").alias("line_no"), F.regexp_replace("raw", r"\A\s+|\s+\z", "").alias("line")).filter("line <> ''")
    return stripped.select("k", "line_no", records.is_journal_line(F.col("line")).alias("continues"))


# --- sentences


@query("SELECT k, sid, st AS s_start, en AS s_end FROM sentences")
def sentences_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = corpus(spark, sf_dir).select("k", F.posexplode(sentences.split_sentences(block())).alias("sid", "s"))
    return found.select("k", F.col("sid").cast("long").alias("sid"), F.col("s.start").alias("s_start"), F.col("s.end").alias("s_end"))


@query("SELECT k, s AS pos, sid FROM ms")
def sentence_of_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = corpus(spark, sf_dir).select("k", mentions.extract_mirnas(block()).alias("ms"), sentences.split_sentences(block()).alias("sentences"))
    return found.select("k", F.explode(let(F.col("sentences"), lambda all_: F.transform("ms", lambda m: F.struct(m["start"].alias("pos"), sentences.sentence_at(all_, m["start"]).alias("sid"))))).alias("x")).select("k", "x.pos", "x.sid")


@query("SELECT k, string_agg(sentence, ' ' ORDER BY sid) FILTER (WHERE sentence <> '') AS span FROM said WHERE sid BETWEEN 1 AND 3 GROUP BY k")
def sentence_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = corpus(spark, sf_dir).select("k", "block", sentences.split_sentences(block()).alias("sentences"))
    return found.select("k", sentences.sentence_span(block(), F.col("sentences"), F.lit(3), F.lit(1)).alias("span"))


@query(f"SELECT k, sid, {score('lower(sentence)')} > 0 AS has_relation FROM said")
def relation_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = corpus(spark, sf_dir).select("k", "block", F.posexplode(sentences.split_sentences(block())).alias("sid", "s"))
    text = F.substring("block", F.col("s.start") + 1, F.col("s.end") - F.col("s.start"))
    return found.select("k", F.col("sid").cast("long").alias("sid"), (pairs.relation_score(text) > 0).alias("has_relation"))


# --- mentions


def mirna_query(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return exploded(corpus(spark, sf_dir).select("k", mentions.mirnas_of(block(), kind).alias("m")), "m", "name", "start")

    return run


def gene_query(tier: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return exploded(corpus(spark, sf_dir).select("k", mentions.genes_of(block(), tier).alias("g")), "g", "name", "confidence", "start", "end")

    return run


GUARD = "NOT (lower(name[1:3]) = 'mir' AND s > 0 AND regexp_matches(substr(block, s, 1), '[A-Za-z-]'))"
for _kind, _table in (("standard", "m1"), ("legacy", "m2"), ("bare", "m3")):
    QUERIES[f"mirna_{_kind}"] = mirna_query(_kind)
    ORACLES[f"mirna_{_kind}"] = oracle(f"SELECT k, name, s AS start FROM {_table} x JOIN corpus USING (k) WHERE {GUARD}")
for _n, _tier in enumerate(mentions.GENE, 1):
    QUERIES[f"gene_tier{_tier}"] = gene_query(_tier)
    ORACLES[f"gene_tier{_tier}"] = oracle(f'SELECT k, name, confidence, s AS start, e AS "end" FROM genes WHERE tier = {_n}')


@query('SELECT k, name, s AS start, e AS "end" FROM mirnas')
def mirna_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploded(corpus(spark, sf_dir).select("k", mentions.extract_mirnas(block()).alias("m")), "m", "name", "start", "end")


@query('SELECT k, name, confidence, s AS start, e AS "end" FROM genes')
def gene_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploded(corpus(spark, sf_dir).select("k", mentions.extract_genes(block()).alias("g")), "g", "name", "confidence", "start", "end")


def judged(spark: SparkSession, sf_dir: str, pattern: str) -> DataFrame:
    return corpus(spark, sf_dir).select("k", "block", F.explode(find_all(block(), pattern)).alias("x")).select("k", "block", "x.*")


@query(f"SELECT k, name, s AS start, {NEAR} AS in_context, {HYPHEN} AS behind_hyphen FROM g3 x JOIN corpus USING (k)")
def gene_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(spark, sf_dir, mentions.GENE["3"])
    return found.select("k", "name", "start", mentions.gene_context(block(), F.col("start"), F.col("end")).alias("in_context"), mentions.crosses_hyphen(block(), F.col("start")).alias("behind_hyphen"))


@query(f"SELECT k, name, s AS start, {STRONG} AS strong FROM g4 x JOIN corpus USING (k)")
def gene_strong_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(spark, sf_dir, mentions.GENE["4"])
    return found.select("k", "name", "start", mentions.strong_gene_context(block(), F.col("end")).alias("strong"))


# --- species


@query("SELECT k, common AS species FROM by_title")
def species_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    titled = corpus(spark, sf_dir).select("k", records.title_of(block()).alias("title"))
    return titled.select("k", species.title_species(F.col("title")).alias("species")).filter("species IS NOT NULL")


@query("SELECT k, common AS species, w AS weight FROM sums")
def species_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = corpus(spark, sf_dir).select("k", "block", mentions.extract_mirnas(block()).alias("m"), mentions.extract_genes(block()).alias("g"))
    votes = found.select("k", F.explode(species.votes_of(F.col("m"), F.col("g"), block())).alias("v"))
    return votes.groupBy("k", F.col("v.species").alias("species")).agg(F.sum("v.weight").cast("int").alias("weight"))


@query("SELECT k, species FROM detected")
def species_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentioned(spark, sf_dir).select("k", "species")


# --- pairs


def names() -> tuple[Column, Column]:
    return F.col("best.m.name").alias("mirna"), F.col("best.g.name").alias("gene")


@query("SELECT DISTINCT k, m AS mirna, g AS gene FROM combos")
def pair_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.pair_candidates(mentioned(spark, sf_dir)).select("k", F.col("m").alias("mirna"), F.col("g").alias("gene"))


@query("SELECT k, m AS mirna, g AS gene, sd::INT AS sd, m_s::INT AS m_start, g_s::INT AS g_start FROM best WHERE sd <= 1")
def pair_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = pairs.best_occurrences(mentioned(spark, sf_dir))
    return best.select("k", *names(), "best.sd", F.col("best.m.start").alias("m_start"), F.col("best.g.start").alias("g_start"))


@query("SELECT k, m AS mirna, g AS gene, cd::INT AS cd FROM near")
def pair_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near(spark, sf_dir).select("k", *names(), F.abs(F.col("best.m.start") - F.col("best.g.start")).alias("cd"))


@query("SELECT k, m AS mirna, g AS gene, sentence FROM told")
def pair_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near(spark, sf_dir).select("k", *names(), pairs.evidence(F.col("best"), F.col("told")).alias("sentence"))


@query("SELECT k, m AS mirna, g AS gene, crowded, explicit FROM told")
def pair_crowded_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near(spark, sf_dir).select("k", *names(), "told.crowded", pairs.is_explicit(F.col("best"), F.col("told")).alias("explicit"))


@query(f"SELECT k, sid, {RELATION.format('sentence')} AS relation FROM said")
def relation_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = corpus(spark, sf_dir).select("k", "block", F.posexplode(sentences.split_sentences(block())).alias("sid", "s"))
    text = F.substring("block", F.col("s.start") + 1, F.col("s.end") - F.col("s.start"))
    return found.select("k", F.col("sid").cast("long").alias("sid"), pairs.classify_relation(text).alias("relation"))


PAIR_COLUMNS = ("k", "mirna", "gene", "gene_confidence", "relation_confidence", "confidence", "relation_type", "sentence", "species", "pmid", "doi", "title")


@query(f"SELECT {', '.join(PAIR_COLUMNS)} FROM pairs")
def pairs_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.mine_pairs(mentioned(spark, sf_dir)).select(*PAIR_COLUMNS)


@query("SELECT idx, k, mirna, gene FROM pairs")
def row_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(spark, sf_dir).select("idx", "k", "mirna", "gene")


@query("SELECT relation_type, confidence, count(*) AS pairs, count(DISTINCT k) AS abstracts FROM pairs GROUP BY relation_type, confidence")
def pair_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagship(spark, sf_dir)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pairs.mine_pairs(mentioned(spark, sf_dir))
    return found.groupBy("relation_type", "confidence").agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("k").alias("abstracts"))


@query("""SELECT (SELECT count(*) FROM corpus) AS total, (SELECT count(DISTINCT k) FROM mirnas) AS has_mirna, (SELECT count(DISTINCT k) FROM genes) AS has_gene,
    (SELECT count(DISTINCT k) FROM mirnas WHERE k IN (SELECT k FROM genes)) AS has_both, (SELECT count(*) FROM mirnas) AS total_mirna, (SELECT count(*) FROM genes) AS total_gene,
    (SELECT count(DISTINCT k) FROM near) AS has_pair""")
def extract_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mentioned(spark, sf_dir)
    return pairs.mention_stats(found, pairs.mine_pairs(found), ["k"])


@query("SELECT count(*) AS pairs, count(DISTINCT nullif(pmid, '')) AS pmids, count(DISTINCT mirna) AS mirnas, count(DISTINCT gene) AS genes FROM pairs")
def pair_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.pair_stats(pairs.mine_pairs(mentioned(spark, sf_dir)))


@query("SELECT k, mirna, gene, CASE WHEN confidence LIKE 'Confirmed%' OR confidence LIKE 'High confidence%' THEN 'green' WHEN contains(confidence, 'Unverified') THEN 'orange' ELSE 'none' END AS style FROM pairs")
def row_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.mine_pairs(mentioned(spark, sf_dir)).select("k", "mirna", "gene", review.pair_style(F.col("confidence")).alias("style"))


# --- review

UNSURE = "(contains(lower(confidence), 'unverified') OR relation_type = 'associated')"


@query(f"SELECT idx, mirna, gene, confidence, relation_type FROM pairs WHERE {UNSURE}")
def review_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(spark, sf_dir).filter(review.needs_review(F.col("confidence"), F.col("relation_type"))).select("idx", "mirna", "gene", "confidence", "relation_type")


@query("""SELECT idx, 'miRNA: ' || mirna || chr(10) || 'Gene: ' || gene || chr(10) || 'Species: ' || species || chr(10) || 'Title: ' || coalesce(title, 'null') || chr(10) || 'Sentence: "' || sentence || '"' AS prompt
    FROM pairs WHERE (contains(lower(confidence), 'unverified') OR relation_type = 'associated')""")
def review_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(spark, sf_dir).filter(review.needs_review(F.col("confidence"), F.col("relation_type"))).select("idx", review.single_prompt().alias("prompt"))


@query(f"""SELECT batch, count(*)::INT AS n, string_agg(idx::VARCHAR, ',' ORDER BY idx) AS ids FROM (SELECT idx, (row_number() OVER (ORDER BY idx) - 1) // 5 AS batch FROM pairs WHERE {UNSURE}) GROUP BY batch""")
def review_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    unsure = mined(spark, sf_dir).filter(review.needs_review(F.col("confidence"), F.col("relation_type")))
    return review.review_batches(unsure).select("batch", "n", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@query(f"SELECT idx, mirna, gene FROM pairs WHERE {UNSURE} AND idx NOT IN (SELECT idx FROM verdicts)")
def review_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mined(spark, sf_dir)
    unsure = found.filter(review.needs_review(F.col("confidence"), F.col("relation_type")))
    return review.pending(unsure, verdicts(found.select("idx"))).select("idx", "mirna", "gene")


RESPONSES = (
    '[{"id":1,"is_gene":true,"is_target":true,"relation_type":"cleavage","evidence_from_text":"cleaves"},{"id":2,"is_gene":false}]',
    '```json\n{"results":[{"is_target":false,"relevance":"related","explanation":"maybe"},{"is_gene":true}]}\n```',
    '{"is_gene":true,"is_target":false,"relevance":"","relation_type":"none"}',
    "no answer",
)
PARSED = ((0, 0, True, True, "targeting", "cleavage", "cleaves"), (0, 1, False, False, "unrelated", "none", ""), (1, 0, True, False, "related", "none", "maybe"), (1, 1, True, False, "unrelated", "none", ""))


@query("SELECT doc_id * 2 + c.n AS idx, is_gene, is_target, relevance, relation_type, explanation FROM documents JOIN (VALUES "
       + ", ".join(str(p) for p in PARSED) + ") c(r, n, is_gene, is_target, relevance, relation_type, explanation) ON r = doc_id % 4")
def verdict_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id IS NOT NULL")
    answer = F.element_at(F.array(*[F.lit(r) for r in RESPONSES]), (F.col("doc_id") % 4).cast("int") + 1)
    return review.batch_verdicts(docs.select(F.array(F.col("doc_id") * 2, F.col("doc_id") * 2 + 1).alias("ids"), answer.alias("response")))


@query("SELECT idx, mirna, gene, confidence, review_result, rationale, manual_keep FROM reviewed")
def review_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviewed(spark, sf_dir).select("idx", "mirna", "gene", "confidence", "review_result", "rationale", "manual_keep")


@query("""SELECT count(*) FILTER (WHERE review_result LIKE 'Confirmed%') AS confirmed, count(*) FILTER (WHERE review_result = 'Weak association') AS weak,
    count(*) FILTER (WHERE review_result = 'Excluded (non-target)') AS non_target, count(*) FILTER (WHERE review_result = 'Excluded (non-gene)') AS non_gene,
    count(*) FILTER (WHERE review_result = 'Not reviewed') AS not_reviewed, count(*) FILTER (WHERE review_result LIKE 'Confirmed%' OR review_result = 'Weak association') AS retained,
    count(*) FILTER (WHERE review_result LIKE 'Excluded%') AS excluded FROM reviewed""")
def review_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.review_stats(reviewed(spark, sf_dir))


@query("""SELECT CASE WHEN grouping(species) = 0 THEN 'species' WHEN grouping(relation_type) = 0 THEN 'relation' WHEN grouping(status) = 0 THEN 'status' ELSE 'total' END AS level,
    CASE WHEN grouping(species) = 0 THEN species WHEN grouping(relation_type) = 0 THEN relation_type WHEN grouping(status) = 0 THEN status ELSE '' END AS value,
    count(*) AS pairs, count(*) FILTER (WHERE status = 'Confirmed') AS confirmed, count(DISTINCT nullif(pmid, '')) AS pmids
    FROM (SELECT *, CASE WHEN review_result LIKE 'Confirmed%' THEN 'Confirmed' ELSE review_result END AS status FROM reviewed) GROUP BY GROUPING SETS ((species), (relation_type), (status), ())""")
def status_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.status_levels(reviewed(spark, sf_dir))


# --- normalisation


@query("SELECT idx, mirna, gene, species FROM kept")
def normalize_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.kept_pairs(reviewed(spark, sf_dir)).select("idx", "mirna", "gene", "species")


@query("""SELECT count(*) FILTER (WHERE review_result = 'Weak association') AS weak, count(*) FILTER (WHERE review_result = 'Excluded (non-target)') AS non_target,
    count(*) FILTER (WHERE review_result = 'Excluded (non-gene)') AS non_gene, count(*) FILTER (WHERE review_result = 'Not reviewed') AS not_reviewed FROM reviewed""")
def normalize_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.skip_counts(reviewed(spark, sf_dir))


@query("SELECT DISTINCT mirna, species, mirna_norm FROM normalized_all")
def normalize_mirna(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalized(pairs.mine_pairs(mentioned(spark, sf_dir))).select("mirna", "species", "mirna_norm").distinct()


@query("SELECT species, mirna_norm, gene_norm, pmid_count, sentences, titles, pmids, dois FROM groups")
def dedup_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(spark, sf_dir).select("species", "mirna_norm", "gene_norm", "pmid_count", "sentences", "titles", "pmids", "dois")


@query("SELECT species, mirna_norm, gene_norm, relation_type FROM groups")
def modal_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(spark, sf_dir).select("species", "mirna_norm", "gene_norm", "relation_type")


@query("SELECT species, mirna_norm, gene_norm, mirna, gene FROM groups")
def variant_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(spark, sf_dir).select("species", "mirna_norm", "gene_norm", "mirna", "gene")


@query("SELECT species, mirna_norm, gene_norm, pmid_count FROM groups WHERE pmid_count >= 2")
def multi_pmid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(spark, sf_dir).filter("pmid_count >= 2").select("species", "mirna_norm", "gene_norm", "pmid_count")


@query("""SELECT b.*, a.*, b.pairs - a.groups AS merged, round(b.changed * 100.0 / b.pairs, 1) AS changed_percent FROM
    (SELECT count(*) AS pairs, count(*) FILTER (WHERE mirna <> mirna_norm) AS changed, count(DISTINCT mirna) AS mirnas_before, count(DISTINCT mirna_norm) AS mirnas_after FROM normalized) b,
    (SELECT count(*) AS "groups", count(*) FILTER (WHERE pmid_count >= 2) AS multi_pmid FROM groups) a""")
def normalize_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = normalized(spark, sf_dir)
    return normalize.normalize_stats(found, normalize.merge_pairs(found))


@query("SELECT idx, mirna, mirna_norm, species FROM normalized WHERE mirna <> mirna_norm ORDER BY idx LIMIT 15")
def changed_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.changed_names(normalized(spark, sf_dir))


@query("SELECT species, mirna_norm, gene_norm, CASE WHEN pmid_count >= 2 THEN 'blue' ELSE 'none' END AS style FROM groups")
def group_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(spark, sf_dir).select("species", "mirna_norm", "gene_norm", review.group_style(F.col("pmid_count")).alias("style"))


@query("SELECT idx, mirna, mirna_norm, CASE WHEN mirna <> mirna_norm THEN 'green' ELSE 'none' END AS style FROM normalized")
def detail_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(spark, sf_dir).select("idx", "mirna", "mirna_norm", review.renamed_style(F.col("mirna"), F.col("mirna_norm")).alias("style"))


@query("""SELECT 0 AS part, seq, label, value, '' AS note FROM (SELECT 1::BIGINT AS seq, 'Unique PMIDs' AS label, count(DISTINCT nullif(pmid, ''))::VARCHAR AS value FROM pairs
    UNION ALL SELECT 2, 'Not reviewed', count(*)::VARCHAR FROM reviewed WHERE review_result = 'Not reviewed')
    UNION ALL SELECT 1, u.seq, u.label, u.value, u.note FROM (
      SELECT unnest([{'seq': 1, 'label': '--- Normalization & Dedup ---', 'value': '', 'note': ''}, {'seq': 2, 'label': 'Pairs (before normalization)', 'value': n::VARCHAR, 'note': ''},
        {'seq': 3, 'label': 'miRNA names changed', 'value': changed::VARCHAR, 'note': coalesce(round(changed * 100.0 / n, 1)::VARCHAR || '%', '')},
        {'seq': 4, 'label': 'Unique miRNAs (before)', 'value': m1::VARCHAR, 'note': ''}, {'seq': 5, 'label': 'Unique miRNAs (after)', 'value': m2::VARCHAR, 'note': ''},
        {'seq': 6, 'label': 'Pair groups (after dedup)', 'value': g::VARCHAR, 'note': ''}, {'seq': 7, 'label': 'Merged entries', 'value': (n - g)::VARCHAR, 'note': ''},
        {'seq': 8, 'label': 'Multi-PMID support (>=2)', 'value': multi::VARCHAR, 'note': ''}, {'seq': 9, 'label': '--- Gene ID Resolution ---', 'value': '', 'note': ''},
        {'seq': 10, 'label': 'Unique genes queried', 'value': total::VARCHAR, 'note': ''}, {'seq': 11, 'label': 'Resolved', 'value': hits::VARCHAR, 'note': coalesce(round(hits * 100.0 / total, 1)::VARCHAR || '%', '')},
        {'seq': 12, 'label': 'Unresolved', 'value': (total - hits)::VARCHAR, 'note': ''}]) AS u FROM
      (SELECT count(*) AS n, count(*) FILTER (WHERE mirna <> mirna_norm) AS changed, count(DISTINCT mirna) AS m1, count(DISTINCT mirna_norm) AS m2 FROM normalized),
      (SELECT count(*) AS g, count(*) FILTER (WHERE pmid_count >= 2) AS multi FROM groups),
      (SELECT count(*) AS total, count(*) FILTER (WHERE coalesce(rap, '') <> '' OR coalesce(ncbi, '') <> '') AS hits FROM keys LEFT JOIN gene_ids USING (species, gene)))""")
def statistics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reviewed(spark, sf_dir)
    detail = normalize.normalized(normalize.kept_pairs(rows))
    merged = normalize.merge_pairs(detail)
    row = lambda seq, label, value: F.struct(F.lit(seq).alias("seq"), F.lit(label).alias("label"), value.cast("string").alias("value"), F.lit(None).cast("string").alias("remark"))
    empty = F.struct(F.lit(3).alias("seq"), F.lit("").alias("label"), F.lit(None).cast("string").alias("value"), F.lit("").alias("remark"))
    counts = rows.agg(F.countDistinct(F.nullif("pmid", F.lit(""))).alias("pmids"), F.count_if(F.col("review_result") == "Not reviewed").alias("left"))
    prior = counts.select(F.inline(F.array(row(1, "Unique PMIDs", F.col("pmids")), row(2, "Not reviewed", F.col("left")), empty)))
    keys = geneids.lookup_keys(merged)
    return normalize.statistics_rows(normalize.normalize_stats(detail, merged), geneids.id_stats(keys, gene_ids(keys)), prior)


# --- gene identifiers


@query("SELECT species, gene, CASE WHEN species = 'rice' THEN 'rice table' ELSE 'entity search' END AS route FROM keys")
def gene_lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geneids.lookup_keys(groups(spark, sf_dir))


@query(f"""SELECT species, gene, first || CASE WHEN prefix IS NOT NULL AND gene LIKE prefix || '%' AND length(gene) > length(prefix) + 1 THEN ' | ' || gene[length(prefix) + 1:] || '[Gene] AND ' || org || '[Organism]' ELSE '' END AS queries
    FROM (SELECT species, gene, prefix, coalesce(organism, species) AS org, gene || '[Gene] AND ' || coalesce(organism, species) || '[Organism]' AS first FROM keys
    LEFT JOIN (SELECT unnest([{quoted(ORGANISMS)}]) AS n, unnest([{quoted(ORGANISMS.values())}]) AS organism) o ON o.n = species
    LEFT JOIN (SELECT unnest([{quoted(STRIP_PREFIXES)}]) AS n, unnest([{quoted(STRIP_PREFIXES.values())}]) AS prefix) p ON p.n = species)""")
def gene_query_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = geneids.lookup_keys(groups(spark, sf_dir))
    return keys.select("species", "gene", F.array_join(geneids.query_variants(F.col("species"), F.col("gene")), " | ").alias("queries"))


def rice_page(id_col: str) -> str:
    """SQL (both dialects) for a lookup page of a key."""
    n = f"CAST({id_col} AS STRING)"
    return (
        "'<html><TABLE id=''TBResult'' border=1><tr><td>GeneID</td><td>Name</td><td>RAP <b>ID</b></td><td>MSU</td><td>NCBI</td></tr><TR class=x><td><a href=#>' || " + n
        + " || '</a></td><td>n&nbsp;x</td><td>Os0' || " + n + " || ' more</td><td> LOC' || " + n + f" || '&nbsp;</td><td>' || CASE WHEN {id_col} % 3 = 0 THEN 'LOC_' WHEN {id_col} % 3 = 1 THEN 'bad' ELSE '' END || " + n + " || '</td></TR></TABLE>'"
    )


@query("SELECT page_id, 'Os0' || page_id::VARCHAR AS rap, 'LOC' || page_id::VARCHAR AS msu, CASE WHEN page_id % 3 = 0 THEN 'LOC_' || page_id::VARCHAR WHEN page_id % 3 = 1 THEN '' ELSE page_id::VARCHAR END AS ncbi FROM pages")
def html_table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    page = rice_page("page_id").replace("id=''TBResult''", "id=\\'TBResult\\'")
    return pages.select("page_id", F.expr(page).alias("html")).select("page_id", geneids.rice_ids(F.col("html")).alias("ids")).select("page_id", "ids.*")


@query("SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN 'g' || doc_id::VARCHAR END AS gene_id FROM documents")
def entity_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit('"g'), F.col("doc_id").cast("string"), F.lit('","z"'))).otherwise("")
    return docs.select("doc_id", geneids.entity_id(F.concat(F.lit('{"esearchresult":{"idlist":['), ids, F.lit("]}}"))).alias("gene_id"))


@query("SELECT species, mirna_norm, gene_norm, coalesce(rap, '') AS rap, coalesce(msu, '') AS msu, coalesce(ncbi, '') AS ncbi FROM groups LEFT JOIN (SELECT species, gene AS gene_norm, rap, msu, ncbi FROM gene_ids) USING (species, gene_norm)")
def gene_id_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(spark, sf_dir)
    return geneids.attach_ids(found, gene_ids(geneids.lookup_keys(found))).select("species", "mirna_norm", "gene_norm", "rap", "msu", "ncbi")


@query("""SELECT total, resolved, total - resolved AS unresolved, round(resolved * 100.0 / total, 1) AS percent FROM (
    SELECT count(*) AS total, count(*) FILTER (WHERE coalesce(rap, '') <> '' OR coalesce(ncbi, '') <> '') AS resolved FROM keys LEFT JOIN gene_ids USING (species, gene))""")
def gene_id_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = geneids.lookup_keys(groups(spark, sf_dir))
    return geneids.id_stats(keys, gene_ids(keys))


def stub_rice(gene: str) -> str | None:
    """A rice table that knows genes with names of even length."""
    if len(gene) % 2:
        return None
    head = "<tr><td>GeneID</td><td>Name</td><td>RAP</td><td>MSU</td><td>NCBI</td></tr>"
    return f"<TABLE id='TBResult'>{head}<tr><td>7</td><td>{gene}</td><td>Os_{gene} x</td><td>LOC_{gene}</td><td>{len(gene)}</td></tr></TABLE>"


def stub_entity(term: str) -> str | None:
    """An entity search that knows names of up to four characters."""
    name = term.split("[")[0]
    return '{"esearchresult":{"idlist":[%s]}}' % (f'"{name}-id","x"' if len(name) <= 4 else "")


@query(f"""SELECT species, gene, CASE WHEN species = 'rice' AND length(gene) % 2 = 0 THEN 'Os_' || gene ELSE '' END AS rap, CASE WHEN species = 'rice' AND length(gene) % 2 = 0 THEN 'LOC_' || gene ELSE '' END AS msu,
      CASE WHEN species = 'rice' THEN CASE WHEN length(gene) % 2 = 0 THEN length(gene)::VARCHAR ELSE '' END WHEN length(gene) <= 4 THEN gene || '-id'
        WHEN prefix IS NOT NULL AND starts_with(gene, prefix) AND length(gene) > length(prefix) + 1 AND length(gene) - length(prefix) <= 4 THEN gene[length(prefix) + 1:] || '-id' ELSE '' END AS ncbi
    FROM keys LEFT JOIN (SELECT unnest([{quoted(STRIP_PREFIXES)}]) AS n, unnest([{quoted(STRIP_PREFIXES.values())}]) AS prefix) p ON p.n = species""")
def gene_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geneids.resolve_ids(groups(spark, sf_dir), stub_rice, stub_entity, workers=4)


# --- feedback


@query(f"""SELECT gene, n, pmid_count, coalesce(array_to_string(rs[1:2], '; '), '') AS reasons FROM (SELECT gene, count(*) AS n, count(DISTINCT coalesce(pmid, '')) AS pmid_count FROM reviewed WHERE contains(review_result, 'non-gene') GROUP BY gene)
    LEFT JOIN (SELECT gene, list(reason ORDER BY f) AS rs FROM (SELECT gene, rationale[1:150] AS reason, min(idx) AS f FROM reviewed WHERE contains(review_result, 'non-gene') AND rationale NOT IN ('', 'None') GROUP BY ALL) GROUP BY gene) USING (gene)
    WHERE gene NOT IN ({quoted(BLACKLIST)})""")
def nongene_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feedback.non_gene_candidates(reviewed(spark, sf_dir), names_table(spark, BLACKLIST))


@query(f"""SELECT gene, n, pmid_count, array_to_string(rs[1:3], ', ') AS relations FROM (SELECT gene, count(*) AS n, count(DISTINCT coalesce(pmid, '')) AS pmid_count FROM reviewed
      WHERE contains(review_result, 'Confirmed') AND contains(confidence, 'Unverified') GROUP BY gene HAVING count(*) >= 2)
    JOIN (SELECT gene, list(rel ORDER BY f) AS rs FROM (SELECT gene, replace(replace(review_result, 'Confirmed (', ''), ')', '') AS rel, min(idx) AS f FROM reviewed
      WHERE contains(review_result, 'Confirmed') AND contains(confidence, 'Unverified') GROUP BY ALL) GROUP BY gene) USING (gene)
    WHERE gene NOT IN ({quoted(WHITELIST)})""")
def whitelist_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feedback.whitelist_candidates(reviewed(spark, sf_dir), names_table(spark, WHITELIST))


def judge_sql(table: str, fields: str) -> str:
    """Batches of 60 candidates by falling count and name, with their JSON."""
    return f"""SELECT batch, count(*)::INT AS n, string_agg(gene, ',' ORDER BY r) AS names, '[' || string_agg(item, ',' ORDER BY r) || ']' AS data FROM (
        SELECT *, (r - 1) // 60 AS batch, to_json({fields})::VARCHAR AS item FROM (SELECT *, row_number() OVER (ORDER BY n DESC, gene) AS r FROM ({table}))) GROUP BY batch"""


def judge_rows(candidates: DataFrame) -> DataFrame:
    return feedback.judge_batches(durable(candidates)).select("batch", "n", F.array_join("names", ",").alias("names"), "data")


# p_name and p_brand stand for names here: the corpus has too few genes to fill a batch
PART_CANDIDATES = """SELECT p_name || '#' || (p_partkey % 150)::VARCHAR AS gene, count(*) AS n, count(DISTINCT p_brand) AS pmid_count, min(p_brand) || '; ' || max(p_brand) AS reasons,
    min(p_type) AS relations FROM part GROUP BY 1"""


def part_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.groupBy(F.expr("p_name || '#' || CAST(p_partkey % 150 AS STRING)").alias("gene")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("p_brand").alias("pmid_count"), F.concat(F.min("p_brand"), F.lit("; "), F.max("p_brand")).alias("reasons"), F.min("p_type").alias("relations")
    )


@query(judge_sql(PART_CANDIDATES, "{'name': gene, 'count': n, 'reasons': reasons}"))
def judge_blacklist_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_rows(part_candidates(spark, sf_dir).drop("relations"))


@query(judge_sql(PART_CANDIDATES, "{'name': gene, 'count': n, 'pmid_count': pmid_count, 'relations': relations}"))
def judge_whitelist_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_rows(part_candidates(spark, sf_dir).drop("reasons"))


def stub_judge(prompt: str) -> str:
    """A judge that is sure about names that end in an even digit, and fences its answer."""
    items = json.loads(prompt[prompt.index("[") :])
    made = [{"name": x["name"], "decision": "always_non_gene" if x["name"][-1] in "02468" else "context_dependent"} for x in items]
    return "```json\n" + json.dumps({"results": made}) + "\n```"


@query(f"SELECT gene AS name, CASE WHEN right(gene, 1) IN ('0', '2', '4', '6', '8') THEN 'always_non_gene' ELSE 'context_dependent' END AS decision, '' AS brief FROM ({PART_CANDIDATES})")
def judge_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feedback.judge(durable(part_candidates(spark, sf_dir)), stub_judge, instructions="Which of these are never genes?")


@query(f"""SELECT 'blacklist' AS list, name, false AS added, false AS conflict FROM (SELECT unnest([{quoted(BLACKLIST)}]) AS name)
    UNION ALL SELECT 'whitelist', name, false, false FROM (SELECT unnest([{quoted(WHITELIST)}]) AS name)
    UNION ALL SELECT 'blacklist', name, true, name IN (SELECT p_brand FROM part WHERE p_partkey % 3 = 0) FROM (SELECT DISTINCT p_brand AS name FROM part WHERE p_partkey % 2 = 0)
    UNION ALL SELECT 'whitelist', name, true, name IN (SELECT p_brand FROM part WHERE p_partkey % 2 = 0) FROM (SELECT DISTINCT p_brand AS name FROM part WHERE p_partkey % 3 = 0)""")
def dictionary_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    decisions = part.select(F.col("p_brand").alias("name"), F.explode(F.array(F.when(F.col("p_partkey") % 2 == 0, "always_non_gene"), F.when(F.col("p_partkey") % 3 == 0, "add"))).alias("decision"))
    return feedback.apply_updates(names_table(spark, BLACKLIST), names_table(spark, WHITELIST), feedback.accepted(decisions, "always_non_gene"), feedback.accepted(decisions, "add"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
