"""Gene identifiers from lookup tables, and the parsing of lookup answers."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.dictionaries import ORGANISMS, STRIP_PREFIXES
from quillspark.functions.durable import durable, exists, written
from quillspark.functions.shipping import ship_package
from quillspark.functions.text import let, lookup, strip

#: First cells of rows that hold no gene (fixed values).
HEADINGS = ("GeneID", "基因名称", "基因符号", "RAP", "共")
#: What an NCBI id looks like, and how a search term is written (fixed values).
NCBI_ID = r"(?U)\A(LOC_?\d+|XM_|NM_|NP_|XR_|\d+)"
TERM = "%s[Gene] AND %s[Organism]"


def lookup_keys(groups: DataFrame) -> DataFrame:
    """species, gene, route of every gene of a known species, each once."""
    route = F.when(F.col("species") == "rice", "rice table").otherwise("entity search")
    return groups.filter(F.col("species") != "unknown").select("species", F.col("gene_norm").alias("gene")).distinct().withColumn("route", route)


def query_variants(species: Column, gene: Column) -> Column:
    """Search terms of a gene: its name, then without its species' prefix where more than one character is left."""
    organism = F.coalesce(F.try_element_at(lookup(ORGANISMS.items()), species), species)
    prefix = F.coalesce(F.try_element_at(lookup(STRIP_PREFIXES.items()), species), F.lit(""))
    shorter = (prefix != "") & F.startswith(gene, prefix) & (F.length(gene) > F.length(prefix) + 1)
    names = F.when(shorter, F.array(gene, F.substring(gene, F.length(prefix) + 1, F.length(gene)))).otherwise(F.array(gene))
    return F.transform(names, lambda n: F.format_string(TERM, n, organism))


def entity_id(answer: Column) -> Column:
    """The first id of a JSON search answer."""
    return F.get(F.from_json(answer, "struct<esearchresult:struct<idlist:array<string>>>")["esearchresult"]["idlist"], F.lit(0))


def table_cells(html: Column, table: str = r"<TABLE[^>]*id='TBResult'[^>]*>(.*?)</TABLE>") -> Column:
    """Cell texts of a table by row: tags dropped, hard spaces as spaces."""
    rows = F.regexp_extract_all(F.regexp_extract(html, f"(?s){table}", 1), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)
    clean = lambda c: strip(F.regexp_replace(strip(F.regexp_replace(c, "<[^>]+>", "")), "&nbsp;", " "))
    return F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1), clean))


def rice_ids(html: Column) -> Column:
    """(rap, msu, ncbi) from the first data row of a lookup page; null without one. Columns are found by the header row.

    Cells, header and row are each bound once: they are used many times below.
    """
    heading = lambda c: F.exists(F.array(*[F.lit(w) for w in HEADINGS]), lambda w: F.startswith(c, w))
    kind = lambda c: F.when(F.contains(c, F.lit("RAP")), "RAP").when(F.contains(c, F.lit("MSU")), "MSU").when(F.contains(c, F.lit("NCBI")), "NCBI").otherwise("")

    def value(found: Column, name: str) -> Column:
        at = F.size(found["kinds"]) - F.array_position(F.reverse(found["kinds"]), F.lit(name)).cast("int")  # the last such column
        cell = F.when(F.array_contains(found["kinds"], F.lit(name)), F.get(found["data"], at))
        first = F.regexp_extract(cell, r"(?U)\A(\S+)", 1)
        return F.coalesce(F.when(first != "", first).otherwise(cell), F.lit(""))

    def parts(rows: Column) -> Column:
        header = F.get(F.filter(rows, lambda r: r[0] == "GeneID"), F.lit(0))
        data = F.get(F.filter(rows, lambda r: (r[0] != "") & ~heading(r[0])), F.lit(0))
        return F.struct(F.transform(header, kind).alias("kinds"), data.alias("data"))

    def ids(found: Column) -> Column:
        values = F.struct(*[value(found, name).alias(name.lower()) for name in ("RAP", "MSU", "NCBI")])
        checked = lambda v: F.struct(v["rap"], v["msu"], F.when(v["ncbi"].rlike(NCBI_ID), v["ncbi"]).otherwise("").alias("ncbi"))
        return F.when(found["data"].isNotNull(), let(values, checked))

    wide = F.filter(table_cells(html), lambda r: F.size(r) >= 4)
    return let(let(wide, parts), ids)


def attach_ids(groups: DataFrame, gene_ids: DataFrame) -> DataFrame:
    """rap, msu, ncbi beside each group; empty where unknown. ``gene_ids``: species, gene, rap, msu, ncbi, one row for each gene."""
    ids = gene_ids.select("species", F.col("gene").alias("gene_norm"), "rap", "msu", "ncbi")
    return groups.join(ids, ["species", "gene_norm"], "left").na.fill("", ["rap", "msu", "ncbi"])


def id_stats(keys: DataFrame, gene_ids: DataFrame) -> DataFrame:
    """Genes asked for, resolved (by RAP or NCBI id) and not, and the share; null without genes."""
    found = keys.join(gene_ids.select("species", "gene", "rap", "ncbi"), ["species", "gene"], "left")
    hit = (F.coalesce("rap", F.lit("")) != "") | (F.coalesce("ncbi", F.lit("")) != "")
    sums = found.agg(F.count(F.lit(1)).alias("total"), F.count_if(hit).alias("resolved"))
    return sums.select("*", (F.col("total") - F.col("resolved")).alias("unresolved"), F.round(F.try_divide(F.col("resolved") * 100, F.col("total")), 1).alias("percent"))


@dataclass(frozen=True)
class Pace:
    """A limit of calls per second for one service, shared by ``workers`` tasks.

    Time from ``start`` on is cut into slots, so many a second, and task n owns every slot of number n modulo workers. A task waits for a
    slot of its own before each call, so the service never gets more calls than slots, whatever tasks start late or wait for answers.
    Machines' clocks must agree.
    """

    per_second: float
    workers: int
    start: float

    def slot(self, task: int, after: int) -> int:
        """Wait for the task's next slot after one; returns its number."""
        now = time.time()
        number = max(math.floor((now - self.start) * self.per_second), after) + 1
        number += (task - number) % self.workers
        time.sleep(max(0.0, self.start + number / self.per_second - now))
        return number


def answers(terms: DataFrame, lookup: Callable[[str], str | None], workers: int = 1, per_second: float | None = None) -> DataFrame:
    """answer beside species, gene, term. ``workers`` calls run at a time; with ``per_second`` the service sees no more calls than that.

    Then all tasks run at once (barrier mode, which never runs a task twice side by side). Write the result before use: a service must not be asked twice.
    """
    pace = Pace(per_second, workers, time.time()) if per_second else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = -1
        for frame in frames:
            found = []
            for term in frame["term"]:
                if pace:
                    last = pace.slot(TaskContext.get().partitionId() % workers, last)
                found.append(lookup(term))
            yield frame.assign(answer=found)

    ship_package(terms.sparkSession)
    dealt = terms.select("species", "gene", "term").repartition(workers)
    return dealt.mapInPandas(run, "species string, gene string, term string, answer string", barrier=pace is not None)


SAVED = "service string, term string, answer string"


def kept_answers(terms: DataFrame, lookup: Callable[[str], str | None], service: str, saved: str | None, size: int = 1000, **pace) -> DataFrame:
    """answer beside species, gene, term; null where the lookup failed. ``terms`` must be durable.

    With a path, answers are saved there round by round, ``size`` terms or so in each: a run that breaks off loses the round that it was
    in, and the next one asks only for what is not on file. Failed lookups are not saved, so they are tried again by the next run.
    """
    spark = terms.sparkSession
    if saved is None:
        return durable(answers(terms, lookup, **pace))
    known = lambda: spark.read.schema(SAVED).parquet(saved).filter(F.col("service") == service) if exists(spark, saved) else spark.createDataFrame([], SAVED)
    todo = written(terms.select("term").distinct().join(known(), "term", "left_anti").select(F.lit("").alias("species"), F.lit("").alias("gene"), "term"))
    n = max(1, -(-todo.count() // size))
    for i in range(n):
        part = todo.filter(F.pmod(F.xxhash64("term"), F.lit(n)) == i)
        answers(part, lookup, **pace).filter("answer IS NOT NULL").select(F.lit(service).alias("service"), "term", "answer").write.mode("append").parquet(saved)
    return terms.select("species", "gene", "term").join(known().dropDuplicates(["term"]).select("term", "answer"), "term", "left")


def resolve_ids(
    groups: DataFrame, rice: Callable[[str], str | None], entity: Callable[[str], str | None], workers: int = 1, per_second: tuple[float | None, float | None] = (None, None), saved: str | None = None
) -> DataFrame:
    """species, gene, rap, msu, ncbi for every gene of a known species; empty where neither service knows it.

    Rice genes are looked up by name in the rice table. All others are searched by their terms in turn: a shorter term is only
    tried for genes that the one before did not find. ``per_second`` limits the calls of either service; ``saved`` is a path
    where answers are kept.
    """
    keys = durable(lookup_keys(groups))
    found = rice_ids(F.col("answer"))
    asked = durable(keys.filter("route = 'rice table'").withColumn("term", F.col("gene")))
    table = kept_answers(asked, rice, "rice table", saved, workers=workers, per_second=per_second[0])
    made = [table.select("species", "gene", found.alias("x")).filter("x IS NOT NULL").select("species", "gene", "x.*")]
    todo = keys.filter("route <> 'rice table'").withColumn("terms", query_variants(F.col("species"), F.col("gene")))
    for n in range(2):
        asked = durable(todo.withColumn("term", F.get("terms", F.lit(n))).filter("term IS NOT NULL"))
        told = kept_answers(asked, entity, "entity search", saved, workers=workers, per_second=per_second[1])
        hits = told.select("species", "gene", F.lit("").alias("rap"), F.lit("").alias("msu"), entity_id(F.col("answer")).alias("ncbi")).filter("ncbi IS NOT NULL")
        made.append(hits)
        todo = todo.join(hits, ["species", "gene"], "left_anti")
    return keys.select("species", "gene").join(reduce(DataFrame.unionByName, made), ["species", "gene"], "left").na.fill("", ["rap", "msu", "ncbi"])
