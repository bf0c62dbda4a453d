"""The four stages end to end: extract, review, normalise, learn."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.dictionaries import Dictionaries, Lists
from quillspark.functions.durable import durable
from quillspark.operators import feedback, geneids, normalize, pairs, review
from quillspark.sources.abstracts import append_verdicts, read_verdicts

Reviewer = Callable[[str], str | None]


def extract_pairs(abstracts: DataFrame, lists: Lists = Dictionaries(), order: tuple[str, ...] = ("file_id", "abstract_index")) -> DataFrame:
    """The pairs table, numbered by abstract, miRNA and gene. ``abstracts``: block and metadata."""
    found = pairs.mine_pairs(pairs.with_mentions(abstracts, lists)).drop("block", "body")
    return review.number_rows(durable(found), *order, "m_ord", "g_ord").drop("m_ord", "g_ord")


def unanswered(found: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Uncertain pairs without a verdict."""
    return review.pending(found.filter(review.needs_review(F.col("confidence"), F.col("relation_type"))), verdicts)


def answered(todo: DataFrame, reviewer: Reviewer, size: int = 5, instructions: str = "", single: Reviewer | None = None) -> DataFrame:
    """Verdicts for pending pairs. Batches whose answer does not fit their size are asked again pair by pair."""
    fresh = review.batch_verdicts(durable(review.ask(review.review_batches(todo, size, instructions), reviewer)))
    left = review.pending(todo, fresh).select(F.col("idx").alias("batch"), F.array("idx").alias("ids"), review.single_prompt(instructions=instructions).alias("prompt"))
    return fresh.unionByName(review.batch_verdicts(durable(review.ask(left, single or reviewer))))


def review_pairs(
    found: DataFrame, verdicts: DataFrame, reviewer: Reviewer | None = None, size: int = 5, instructions: str = "", single: Reviewer | None = None
) -> tuple[DataFrame, DataFrame]:
    """The reviewed table and all verdicts: known ones, and answers to what is pending if there is a reviewer."""
    if reviewer is not None:
        verdicts = verdicts.unionByName(answered(unanswered(found, verdicts), reviewer, size, instructions, single))
    return review.merge_verdicts(found, verdicts), verdicts


def review_into(
    found: DataFrame, path: str, reviewer: Reviewer | None = None, size: int = 5, instructions: str = "", single: Reviewer | None = None, save_every: int = 10_000
) -> DataFrame:
    """The reviewed table, with verdicts kept at ``path``: answers are appended there every ``save_every`` pairs or so.

    A run that breaks off loses at most the round it was in; the next run asks only for what is not on file.
    """
    spark = found.sparkSession
    if reviewer is not None:
        todo = durable(review.in_batches(unanswered(found, read_verdicts(spark, path)), size))
        for part in review.rounds(todo, save_every):
            append_verdicts(answered(part, reviewer, size, instructions, single), path)
    return review.merge_verdicts(found, read_verdicts(spark, path))


def normalize_pairs(reviewed: DataFrame, gene_ids: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The merged groups with identifiers, the detail table, and statistics."""
    detail = normalize.normalized(normalize.kept_pairs(reviewed))
    merged = normalize.merge_pairs(detail)
    return geneids.attach_ids(merged, gene_ids), detail, normalize.normalize_stats(detail, merged)


def export_tables(
    reviewed: DataFrame, gene_ids: DataFrame | None = None, prior: DataFrame | None = None, rice: Reviewer | None = None, entity: Reviewer | None = None, **lookups
) -> dict[str, DataFrame]:
    """The three final tables: "groups" and "detail", numbered and with their colours, and "statistics" with those of the stages before.

    Identifiers come from a table (species, gene, rap, msu, ncbi) or, if there is none, from the two lookups; ``lookups`` are options of
    ``geneids.resolve_ids``: workers, limits and where answers are kept.
    """
    detail = durable(normalize.normalized(normalize.kept_pairs(reviewed)))
    merged = durable(normalize.merge_pairs(detail))
    ids = gene_ids if gene_ids is not None else durable(geneids.resolve_ids(merged, rice or nothing, entity or nothing, **lookups))
    groups = review.number_rows(geneids.attach_ids(merged, ids).withColumn("_less", -F.col("pmid_count")), "_less", "species", "mirna_norm", "gene_norm", name="no").drop("_less")
    stats = normalize.statistics_rows(normalize.normalize_stats(detail, merged), geneids.id_stats(geneids.lookup_keys(merged), ids), prior)
    return {
        "groups": groups.withColumn("style", review.group_style(F.col("pmid_count"))),
        "detail": review.number_rows(detail, "idx", name="no").withColumn("style", review.renamed_style(F.col("mirna"), F.col("mirna_norm"))),
        "statistics": stats,
    }


def nothing(_: str) -> None:
    """A lookup that finds nothing."""


def learn(reviewed: DataFrame, blacklist: DataFrame, whitelist: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates for both lists."""
    return feedback.non_gene_candidates(reviewed, blacklist), feedback.whitelist_candidates(reviewed, whitelist)


def learned(reviewed: DataFrame, blacklist: DataFrame, whitelist: DataFrame, judge: Reviewer, instructions: tuple[str, str] = ("", "")) -> DataFrame:
    """The next version of both lists (list, name, added, conflict): candidates that the judge accepts are added. Nothing is written."""
    black, white = (durable(feedback.judge(c, judge, instructions=text)) for c, text in zip(learn(reviewed, blacklist, whitelist), instructions, strict=True))
    return feedback.apply_updates(blacklist, whitelist, feedback.accepted(black, "always_non_gene"), feedback.accepted(white, "add"))
