"""Candidates for the dictionaries from reviewed pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.durable import durable
from quillspark.functions.evidence import first_seen, leading
from quillspark.functions.text import strip
from quillspark.operators.review import ask, number_rows, unfenced


def reviewed_only(reviewed: DataFrame) -> DataFrame:
    if "review_result" not in reviewed.columns:
        raise ValueError("the table has no review results")
    return reviewed.withColumn("gene", strip(F.coalesce("gene", F.lit("")))).filter(F.col("gene") != "")


def candidates(rows: DataFrame, order: str, kind: str, value: Column, most: int, between: str) -> DataFrame:
    """gene, n, pmid_count, and the first ``most`` values of a kind. Only distinct values are sent, and of these no more than the first ones are gathered."""
    seen = durable(first_seen(rows, ["gene"], F.col(order), pmid=F.coalesce(F.col("pmid").cast("string"), F.lit("")), **{kind: F.nullif(value, F.lit(""))}))
    counts = seen.filter("kind = 'pmid'").groupBy("gene").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pmid_count"))
    told = counts.join(leading(seen, ["gene"], kind, most), "gene", "left")
    return told.withColumn(kind, F.coalesce(F.array_join(kind, between), F.lit("")))


def non_gene_candidates(reviewed: DataFrame, blacklist: DataFrame, order: str = "idx") -> DataFrame:
    """gene, n, pmid_count, reasons (the first two kept apart by "; ") of names that review found to be no genes and that are not listed."""
    rows = reviewed_only(reviewed).filter(F.col("review_result").contains("non-gene"))
    reason = F.left(F.when(F.col("rationale") != "None", F.col("rationale")), F.lit(150))
    return candidates(rows, order, "reasons", reason, 2, "; ").join(blacklist.select(F.col("name").alias("gene")), "gene", "left_anti")


def whitelist_candidates(reviewed: DataFrame, whitelist: DataFrame, least: int = 2, order: str = "idx") -> DataFrame:
    """gene, n, pmid_count, relations (the first three) of unverified names that review confirmed ``least`` times or more and that are not listed."""
    rows = reviewed_only(reviewed).filter(
        F.col("review_result").contains("Confirmed") & ~F.col("review_result").contains("non-gene") & F.col("confidence").contains("Unverified")
    )
    relation = strip(F.replace(F.replace("review_result", F.lit("Confirmed ("), F.lit("")), F.lit(")"), F.lit("")))
    found = candidates(rows, order, "relations", relation, 3, ", ").filter(F.col("n") >= least)
    return found.join(whitelist.select(F.col("name").alias("gene")), "gene", "left_anti")


def judge_batches(candidates: DataFrame, size: int = 60, instructions: str = "") -> DataFrame:
    """batch (from 0), n, names, data, prompt: candidates by falling count, then name, in batches for the judge.

    ``data`` is a JSON list of the candidates' columns (gene as "name", n as "count"); the question is a parameter.
    """
    numbered = number_rows(candidates.withColumn("_rank", -F.col("n")), "_rank", "gene", name="_idx")
    batched = numbered.withColumn("batch", F.expr(f"(_idx - 1) div {size}"))
    names = {"gene": "name", "n": "count", "pmid_count": "pmid_count", "reasons": "reasons", "relations": "relations"}
    given = ("gene", "n", "reasons") if "reasons" in candidates.columns else ("gene", "n", "pmid_count", "relations")
    item = F.struct("_idx", F.struct(*[F.col(c).alias(names[c]) for c in given]).alias("item"))
    grouped = batched.groupBy("batch").agg(F.array_sort(F.collect_list(item)).alias("xs")).withColumn("items", F.transform("xs", lambda x: x["item"]))
    data = F.to_json("items")
    prompt = F.concat(F.lit(f"{instructions}\n" if instructions else ""), data)
    return grouped.select("batch", F.size("items").alias("n"), F.transform("items", lambda x: x["name"]).alias("names"), data.alias("data"), prompt.alias("prompt"))


def parse_decisions(answers: DataFrame) -> DataFrame:
    """name, decision, brief from the judge's answers (response): {"results": [...]}, fenced or not. Answers that hold none give no row."""
    found = F.from_json(unfenced(F.col("response")), "struct<results:array<struct<name:string,decision:string,brief:string>>>")["results"]
    return answers.select(F.explode(found).alias("x")).select("x.name", "x.decision", F.coalesce("x.brief", F.lit("")).alias("brief")).filter("name IS NOT NULL")


def judge(candidates: DataFrame, reviewer: Callable[[str], str | None], size: int = 60, instructions: str = "") -> DataFrame:
    """Decisions about all candidates; batches without a usable answer give none, so their names are proposed again."""
    batches = judge_batches(candidates, size, instructions).select("batch", F.array(F.col("batch")).alias("ids"), "prompt")
    return parse_decisions(durable(ask(batches, reviewer)))


def accepted(decisions: DataFrame, decision: str) -> DataFrame:
    """Names that the judge decided so about ("always_non_gene" or "add")."""
    return decisions.filter(F.col("decision") == decision).select("name").distinct()


def apply_updates(blacklist: DataFrame, whitelist: DataFrame, add_black: DataFrame, add_white: DataFrame) -> DataFrame:
    """list, name, added: the next version of both lists. Names on either list are not added; one proposed for both enters both, marked as a conflict."""
    known = blacklist.select("name").union(whitelist.select("name"))
    new_black, new_white = (x.select("name").distinct().join(known, "name", "left_anti") for x in (add_black, add_white))
    both = new_black.join(new_white, "name", "left_semi").withColumn("conflict", F.lit(True))
    mark = lambda df, name, added: df.select("name").distinct().select(F.lit(name).alias("list"), "name", F.lit(added).alias("added"))
    out = mark(blacklist, "blacklist", False).union(mark(new_black, "blacklist", True)).union(mark(whitelist, "whitelist", False)).union(mark(new_white, "whitelist", True))
    return out.join(both, "name", "left").select("list", "name", "added", (F.col("added") & F.coalesce("conflict", F.lit(False))).alias("conflict"))
