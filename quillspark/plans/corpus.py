"""A derived corpus: one ASCII abstract for every document key, built by one SQL expression from literal arrays.

The driver's tables hold no biomedical text, so queries of the miner run over abstracts made from
``documents.doc_id``. The same expression serves Spark and DuckDB; only array access differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOURNALS = ("Plant Cell", "J Exp Bot", "Rice (N Y)", "New Phytol", "Front Plant Sci")
TITLES = (
    "Small RNA profiling in peach fruit", "OsmiR396 and growth of rice panicles", "A regulatory module in crops", "Comparing rice and wheat under drought",
    "miR156 in shoot development", "Stress responses of Zea mays roots", "Evolution of conserved small RNAs",
)
SENTENCES = (
    "OsmiR396b targets OsGRF4 in rice.",
    "Here osa-miR156a/SPL14 and NAC were studied.",
    "We found that miR172 represses the expression of AP2 genes.",
    "Cleavage of OsSPL14 by osa-miR156a-5p was confirmed by RLM-5RACE.",
    "The gene LOC_Os08g42700.1 is bound by miR444b.2 in roots.",
    "TaMIR5062-5A interacts with Rht1 protein of wheat, see Fig. 2 for details.",
    "ABC transporter proteins were not changed. Os06g0708700 encodes a kinase.",
    "DICER-LIKE1 and DCL1 are required for pre-miR408 processing.",
    "Jones et al. Reported that ZmGRF8 is regulated by zma-miR396 in maize.",
    "The target ABC proteins and WRKY45 were induced by ABA.",
    "MADS57 controls tillering",
    "In contrast, miR393 silences TIR1 and OsAFB2 through mRNA cleavage!",
    "Overexpression of HsfA1 mediates heat tolerance of tomato.",
    "Expression was measured by PCR in IR64 and ZH11.",
    "Os SPL 14 mutants showed more branches than WT.",
    "miR164-NAC1 module contributes to ageing; ath-miR164 binds NAC1.",
    "The ARF family members were recognized by miR160a.",
    "No change was found for MYB3 or QTL9.",
    "Are pri-miR319 and TCP21 linked? They are not.",
    "A cv. ZR02 grew well in 2019. Yields rose.",
    "GmPT5 and SYG1 were involved in phosphate uptake of soybean.",
    "Both PtcmiR156 and anti-miR156 were used.",
    "SPL99 locus was mapped near MIR98.",
)
LINE_FEED = "chr(10)"


def pick(values: tuple[str, ...], index: str, duck: bool) -> str:
    """SQL for values[index % n]."""
    items = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    at = f"CAST(({index}) % {len(values)} AS INT) + 1"
    return f"([{items}])[{at}]" if duck else f"element_at(array({items}), {at})"


def block_sql(duck: bool, k: str = "doc_id") -> str:
    """SQL for the abstract of key k: header, title, authors, body of four sentences, identifiers."""
    text = lambda e: f"CAST({e} AS STRING)"
    parts = [
        text(k), "'. '", pick(JOURNALS, k, duck), "'. 2020 Mar '", text(f"{k} % 28 + 1"), "';'", text(f"{k} % 90 + 1"), "'(2):3-4. doi: 10.'",
        text(f"1000 + {k} % 9000"), "'/x'", text(k), "'.'", LINE_FEED,
        f"CASE WHEN {k} % 3 = 0 THEN 'Epub 2020 Mar 7.' || {LINE_FEED} WHEN {k} % 7 = 1 THEN 'print.' || {LINE_FEED} ELSE '' END", LINE_FEED,
        pick(TITLES, k, duck), "'.'", LINE_FEED, f"CASE WHEN {k} % 5 = 2 THEN 'And its second line.' || {LINE_FEED} ELSE '' END", LINE_FEED,
        "'Smith A(1), Wang B(2).'", LINE_FEED, LINE_FEED, "'Author information:'", LINE_FEED, "'(1)Institute of Botany. (2)someone@example.org'", LINE_FEED, LINE_FEED,
        pick(SENTENCES, k, duck), "' '", pick(SENTENCES, f"{k} * 7 + 3", duck), f"CASE WHEN {k} % 4 = 1 THEN {LINE_FEED} ELSE ' ' END",
        pick(SENTENCES, f"{k} * 5 + {k} % 17", duck), "' '", pick(SENTENCES, f"{k} * 3 + {k} % 29", duck), LINE_FEED, LINE_FEED,
        f"CASE WHEN {k} % 11 <> 0 THEN 'DOI: 10.' || {text(f'1000 + {k} % 9000')} || '/x' || {text(k)} || '.' || {LINE_FEED} ELSE '' END",
        f"CASE WHEN {k} % 13 <> 0 THEN 'PMID: ' || {text(f'10000000 + {k} % 977')} ELSE '' END",
    ]
    return " || ".join(parts)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, block: one abstract for each document id.

    Mining costs milliseconds for each abstract, so the bare keys are dealt out evenly first: a small file is one partition.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id IS NOT NULL").select("doc_id")
    spread = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return docs.repartition(spread, "doc_id").selectExpr("doc_id AS k", f"{block_sql(False)} AS block")


def files(spark: SparkSession, sf_dir: str, size: int = 5) -> DataFrame:
    """file_id, content: abstracts in files of ``size``, by key."""
    grouped = corpus(spark, sf_dir).groupBy(F.expr(f"k - k % {size}").alias("file_id"))
    return grouped.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "block"))), lambda x: x["block"]), "\n\n").alias("content"))


def verdicts(pairs: DataFrame) -> DataFrame:
    """idx and verdict fields for three of four pairs, derived from their numbers."""
    i = F.col("idx")
    return pairs.filter(i % 4 != 3).select(
        "idx", (i % 5 != 0).alias("is_gene"), (i % 3 == 0).alias("is_target"),
        F.when(i % 3 == 0, "targeting").when(i % 3 == 1, "related").otherwise("unrelated").alias("relevance"),
        F.when(i % 2 == 0, "cleavage").otherwise("repression").alias("relation_type"), F.when(i % 7 == 0, "").otherwise("seen in the text").alias("explanation"),
    )
