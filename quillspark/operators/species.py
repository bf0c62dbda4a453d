"""Species by title, else by weighted votes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.dictionaries import SPECIES, SPECIES_KEYWORDS
from quillspark.functions.text import let, lookup, sql_string

COMMON = {mir: name for mir, _, name in SPECIES}
BY_GENE = {gene.lower(): name for _, gene, name in SPECIES}
VOTES = "array<struct<species:string,weight:int>>"


def keyword_table() -> Column:
    rows = (f"named_struct('word', {sql_string(word)}, 'species', {sql_string(COMMON[mir])})" for word, mir in SPECIES_KEYWORDS)
    return F.expr(f"array({', '.join(rows)})")


def title_species(title: Column) -> Column:
    """The species whose keywords a title holds, if they name exactly one."""
    named = lambda low: F.array_distinct(F.transform(F.filter(keyword_table(), lambda k: F.contains(low, k["word"])), lambda k: k["species"]))
    return let(let(F.lower(title), named), lambda found: F.when(F.size(found) == 1, F.get(found, F.lit(0))))


def votes_of(mirnas: Column, genes: Column, text: Column) -> Column:
    """All votes in order, (species, weight): 10 for each database id, 8 for each prefixed miRNA, 5 for each prefixed gene with a digit, 1 for each keyword."""
    vote = lambda species, weight: F.struct(species.alias("species"), weight.cast("int").alias("weight"))
    names = F.concat(F.transform(mirnas, lambda m: m["name"]), F.transform(genes, lambda g: g["name"]))
    ids = F.filter(names, lambda n: n.startswith("LOC_Os") | n.rlike(r"(?U)\AOs\d{2}[gGtT]"))
    by_mir, by_gene = lookup(COMMON.items()), lookup(BY_GENE.items())
    prefixed = F.transform(mirnas, lambda m: vote(F.try_element_at(by_mir, F.regexp_extract(m["name"], r"\A([a-z]{3,5})-", 1)), F.lit(8)))
    head = lambda g, n: F.when(F.length(g["name"]) >= n, F.lower(F.substring(g["name"], 1, n)))
    numbered = F.filter(genes, lambda g: g["name"].rlike(r"(?U)\d"))
    of_genes = F.transform(numbered, lambda g: vote(F.coalesce(*[F.try_element_at(by_gene, F.coalesce(head(g, n), F.lit(""))) for n in (2, 3)]), F.lit(5)))
    times = lambda low, word: (F.length(low) - F.length(F.replace(low, word, F.lit("")))) / F.length(word)
    words = let(F.lower(text), lambda low: F.transform(F.filter(keyword_table(), lambda k: F.contains(low, k["word"])), lambda k: vote(k["species"], times(low, k["word"]))))
    cast = F.concat(F.transform(ids, lambda _: vote(F.lit("rice"), F.lit(10))).cast(VOTES), prefixed.cast(VOTES), of_genes.cast(VOTES), words.cast(VOTES))
    return F.filter(cast, lambda v: v["species"].isNotNull() & (v["weight"] > 0))


def winner(votes: Column) -> Column:
    """The species with the most weight; the one voted for first on a tie; "unknown" without votes."""

    def sums(cast: Column) -> Column:
        weight = lambda s: F.aggregate(F.filter(cast, lambda v: v["species"] == s), F.lit(0), lambda a, v: a + v["weight"])
        return F.transform(F.array_distinct(F.transform(cast, lambda v: v["species"])), lambda s, i: F.struct(weight(s).alias("weight"), (-i).alias("rank"), s.alias("species")))

    return F.coalesce(F.array_max(let(votes, sums))["species"], F.lit("unknown"))


def detect_species(mirnas: Column, genes: Column, text: Column, title: Column) -> Column:
    return F.coalesce(title_species(title), winner(votes_of(mirnas, genes, text)))
