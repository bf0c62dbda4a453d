"""Review of uncertain pairs: selection, prompts, verdicts, merging."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from http.client import HTTPException

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.dictionaries import DEFAULT_NOTE, REGEX_NOTE, UNREVIEWED_NOTE
from quillspark.functions.durable import durable
from quillspark.functions.shipping import ship_package
from quillspark.functions.text import strip

VERDICT = "struct<is_gene:boolean,is_target:boolean,relevance:string,relation_type:string,evidence_from_text:string,explanation:string>"
NEUTRAL = "unknown"


def needs_review(confidence: Column, relation: Column) -> Column:
    return F.lower(F.coalesce(confidence, F.lit(""))).contains("unverified") | F.coalesce(relation == "associated", F.lit(False))


def single_prompt(row: DataFrame | None = None, instructions: str = "") -> Column:
    """A prompt for one pair (columns mirna, gene, species, title, sentence); the questions are a parameter."""
    asked = F.format_string("miRNA: %s\nGene: %s\nSpecies: %s\nTitle: %s\nSentence: \"%s\"", "mirna", "gene", F.coalesce("species", F.lit(NEUTRAL)), "title", "sentence")
    return F.concat(asked, F.lit(f"\n\n{instructions}" if instructions else ""))


def in_batches(pending: DataFrame, size: int = 5) -> DataFrame:
    """batch (from 0) beside pending pairs: ``size`` in each but the last, in the order of idx, numbered among the pending ones without one task for all."""
    numbered = number_rows(pending.drop("batch"), "idx", name="_no")
    return numbered.withColumn("batch", F.expr(f"(_no - 1) div {size}")).drop("_no")


def review_batches(pending: DataFrame, size: int = 5, instructions: str = "") -> DataFrame:
    """batch, n, ids, prompt: pending pairs in full batches; those that have their batch already (in_batches) keep it."""
    numbered = pending if "batch" in pending.columns else in_batches(pending, size)
    entry = F.format_string("miRNA: %s\nGene: %s\nSpecies: %s\nSentence: \"%s\"\n", "mirna", "gene", F.coalesce("species", F.lit(NEUTRAL)), "sentence")
    grouped = numbered.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("idx", entry.alias("entry")))).alias("es"))
    n = F.size("es")
    parts = F.transform("es", lambda e, i: F.concat(F.lit("--- ["), (i + 1).cast("string"), F.lit("/"), n.cast("string"), F.lit("] ---\n"), e["entry"]))
    return grouped.select("batch", n.alias("n"), F.transform("es", lambda e: e["idx"]).alias("ids"), F.concat(F.array_join(parts, "\n"), F.lit(instructions)).alias("prompt"))


def pending(entries: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Entries without a verdict yet."""
    return entries.join(verdicts.select("idx"), "idx", "left_anti")


def unfenced(response: Column) -> Column:
    """A response without a code fence and its language mark."""
    body = F.regexp_replace(F.get(F.split(response, "```", -1), F.lit(1)), r"\Ajson", "")
    return strip(F.when(F.contains(response, F.lit("```")), body).otherwise(response))


def parse_verdicts(response: Column) -> Column:
    """Verdicts of a response as an array: a JSON list, {"results": list} or one object; null if it is none of these.

    Defaults: a gene, no target, relation "none"; a missing relevance follows the target flag.
    """
    text = unfenced(response)
    many, wrapped, one = F.from_json(text, f"array<{VERDICT}>"), F.from_json(text, f"struct<results:array<{VERDICT}>>")["results"], F.from_json(text, VERDICT)
    list_like = text.startswith("[")
    found = F.when(list_like, many).otherwise(F.coalesce(wrapped, F.when(text.startswith("{"), F.array(one))))

    def completed(v: Column) -> Column:
        target = F.coalesce(v["is_target"], F.lit(False))
        return F.struct(
            F.coalesce(v["is_gene"], F.lit(True)).alias("is_gene"),
            target.alias("is_target"),
            F.coalesce(F.nullif(v["relevance"], F.lit("")), F.when(target, "targeting").otherwise("unrelated")).alias("relevance"),
            F.coalesce(v["relation_type"], F.lit("none")).alias("relation_type"),
            F.coalesce(v["evidence_from_text"], v["explanation"], F.lit("")).alias("explanation"),
        )

    return F.transform(found, completed)


def batch_verdicts(answers: DataFrame) -> DataFrame:
    """idx and verdict fields from answered batches (ids, response); a batch counts only if it has one verdict for each id. Matched by place."""
    parsed = answers.withColumn("vs", parse_verdicts(F.col("response"))).filter(F.size("vs") == F.size("ids"))
    return parsed.select(F.inline(F.arrays_zip("ids", "vs"))).select(F.col("ids").alias("idx"), "vs.*")


def merge_verdicts(pairs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """review_result, rationale, manual_keep for every pair (idx), from its verdict or from its confidence."""
    v = verdicts.select("idx", F.struct("is_gene", "is_target", "relevance", F.col("relation_type").alias("type"), "explanation").alias("v"))
    j = pairs.join(v, "idx", "left")
    has, sure = F.col("v").isNotNull(), F.col("confidence").isin("Confirmed", "High confidence") & (F.col("relation_type") != "associated")
    confirmed = F.coalesce(F.col("v.is_target"), F.lit(False)) | F.coalesce(F.col("v.relevance") == "targeting", F.lit(False))
    status = (
        F.when(has & ~F.col("v.is_gene"), "Excluded (non-gene)")
        .when(has & confirmed, F.concat(F.lit("Confirmed ("), F.col("v.type"), F.lit(")")))
        .when(has & (F.col("v.relevance") == "related"), "Weak association")
        .when(has, "Excluded (non-target)")
        .when(sure, "Confirmed (regex high confidence)")
        .otherwise("Not reviewed")
    )
    j = j.withColumn("review_result", status)
    own = F.coalesce(F.col("v.explanation"), F.lit(""))
    note = F.when(has & (F.col("review_result") == "Excluded (non-target)") & (own == ""), DEFAULT_NOTE).when(has, own).when(sure, REGEX_NOTE).otherwise(UNREVIEWED_NOTE)
    keep = F.when(F.col("review_result").startswith("Confirmed"), "Yes").otherwise("")
    return j.withColumn("rationale", note).withColumn("manual_keep", keep).drop("v")


def review_stats(reviewed: DataFrame) -> DataFrame:
    """Counts by kind of status, of retained and of excluded pairs."""
    kind = status_kind(F.col("review_result"))
    n = lambda *ks: F.count_if(kind.isin(*ks))
    return reviewed.agg(
        n("Confirmed").alias("confirmed"), n("Weak association").alias("weak"), n("Excluded (non-target)").alias("non_target"), n("Excluded (non-gene)").alias("non_gene"),
        n("Not reviewed").alias("not_reviewed"), n("Confirmed", "Weak association").alias("retained"), n("Excluded (non-target)", "Excluded (non-gene)").alias("excluded"),
    )


def status_kind(status: Column) -> Column:
    """A status without what is confirmed."""
    return F.regexp_replace(status, r"\AConfirmed.*\z", "Confirmed")


def status_levels(reviewed: DataFrame) -> DataFrame:
    """level (species, relation, status, total), value, pairs, confirmed, pmids: counts at every level by grouping sets, in one pass."""
    rows = reviewed.select("species", F.col("relation_type").alias("relation"), status_kind(F.col("review_result")).alias("status"), F.nullif("pmid", F.lit("")).alias("pmid"))
    levels = ("species", "relation", "status")
    level, value = F.lit("total"), F.lit("")
    for c in levels:
        level, value = F.when(F.grouping(c) == 0, c).otherwise(level), F.when(F.grouping(c) == 0, F.coalesce(c, F.lit(""))).otherwise(value)
    confirmed = F.col("status") == "Confirmed"
    marked = rows.withColumn("sure", confirmed.cast("int"))
    return marked.groupingSets([["species"], ["relation"], ["status"], []], *levels).agg(
        level.alias("level"), value.alias("value"), F.count(F.lit(1)).alias("pairs"), F.coalesce(F.sum("sure"), F.lit(0)).alias("confirmed"), F.countDistinct("pmid").alias("pmids")
    ).select("level", "value", "pairs", "confirmed", "pmids")


def row_style(status: Column) -> Column:
    """The colour of a reviewed row."""
    return F.when(status.startswith("Confirmed"), "green").when(status.startswith("Excluded"), "red").otherwise("yellow")


def pair_style(confidence: Column) -> Column:
    """The colour of a mined row: sure, unsure, or none."""
    sure = confidence.startswith("Confirmed") | confidence.startswith("High confidence")
    return F.when(sure, "green").when(F.contains(confidence, F.lit("Unverified")), "orange").otherwise("none")


def group_style(pmid_count: Column) -> Column:
    """The colour of a merged row: blue if two or more publications support it."""
    return F.when(pmid_count >= 2, "blue").otherwise("none")


def renamed_style(name: Column, norm: Column) -> Column:
    """The colour of a normal name in the detail table: green if it differs from the name as found."""
    return F.when(name != norm, "green").otherwise("none")


def ask(batches: DataFrame, reviewer: Callable[[str], str | None], retries: int = 1) -> DataFrame:
    """batch, ids, response from a remote reviewer: a picklable function of a prompt, tried up to ``retries`` times; null if all fail.

    Waits between tries are the reviewer's own business. A refused key (PermissionError) ends the job: no further call could succeed.
    Write the result before use: answers must not be asked for twice.
    """

    def answered(prompt: str) -> str | None:
        for _ in range(retries):
            try:
                answer = reviewer(prompt)
            except PermissionError:
                raise
            except (OSError, ValueError, HTTPException):  # an answer that was cut off is none
                continue
            if answer is not None:
                return answer
        return None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[["batch", "ids"]].assign(response=[answered(p) for p in frame["prompt"]])

    ship_package(batches.sparkSession)
    return batches.mapInPandas(run, "batch long, ids array<long>, response string")


def rounds(batches: DataFrame, size: int) -> Iterator[DataFrame]:
    """The batches in rounds of about ``size``, dealt by their numbers: what one round answered is safe before the next one asks."""
    n = max(1, -(-batches.count() // size))
    for i in range(n):
        yield batches.filter(F.pmod("batch", F.lit(n)) == i) if n > 1 else batches


def number_rows(df: DataFrame, *order: str, name: str = "idx") -> DataFrame:
    """Running numbers from 1 in an order, by ranges: no task sees more than its range.

    The sorted rows are made durable together with their partition's number, so that the partitions that are counted are those
    that are numbered; counts of the partitions before give each one's first number.
    """
    ordered = durable(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    parts = ordered.withColumn("_part", F.shiftright("_id", 33))
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    first = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    numbered = parts.join(F.broadcast(first), "_part")
    return numbered.withColumn(name, F.col("_first") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_id", "_part", "_first")
