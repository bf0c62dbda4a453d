"""Normal names, filtering of reviewed pairs, merging across publications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.dictionaries import LEGACY_PREFIXES, SPECIES
from quillspark.functions.evidence import first_seen, in_order
from quillspark.functions.text import lookup, strip

#: The arm of a mature miRNA, and marks that keep a row.
ARM = r"(?:[.-]\d[ap]?)?"
KEEP = ("yes", "y", "keep", "1", "true")


def normalize_mirna(name: Column, species: Column) -> Column:
    """A miRNA name in standard form: without a precursor mark, legacy prefixes as species prefixes, bare names with the prefix of their species.

    Standard names stay; so do bare names of unknown species, prefixes of over two letters, and anything else.
    """
    bare = F.regexp_replace(strip(name), r"\A(?i:pre-|pri-)", "")
    legacy = F.try_element_at(lookup(LEGACY_PREFIXES.items()), F.regexp_extract(bare, r"\A([A-Z][a-z]?)[Mm][Ii][Rr]", 1))
    own = F.try_element_at(lookup((common, mir) for mir, _, common in SPECIES), F.coalesce(species, F.lit("")))
    rest = F.regexp_replace(bare, r"\A[A-Z][a-z]?(?=[Mm][Ii][Rr])", "")
    return (
        F.when(bare.rlike(rf"(?U)\A[a-z]{{3,5}}-[Mm][Ii][Rr]\d+[a-z]*{ARM}$"), bare)
        .when(bare.rlike(rf"(?U)\A[A-Z][a-z]?[Mm][Ii][Rr]\d+[a-z]*{ARM}$"), F.coalesce(F.concat(legacy, F.lit("-"), rest), bare))
        .when(bare.rlike(rf"(?U)\A[Mm][Ii][Rr]\d+[a-z]*{ARM}$") & own.isNotNull(), F.concat(own, F.lit("-miR"), F.substring(bare, F.lit(4), F.length(bare))))
        .otherwise(bare)
    )


def normalize_gene(name: Column) -> Column:
    return strip(name)


def kept_pairs(reviewed: DataFrame) -> DataFrame:
    """Named pairs that are confirmed or marked to keep; all named pairs if there was no review."""
    named = reviewed.filter((F.coalesce("mirna", F.lit("")) != "") & (F.coalesce("gene", F.lit("")) != ""))
    if "review_result" not in reviewed.columns:
        return named
    marked = F.lower(strip(F.coalesce(F.col("manual_keep").cast("string"), F.lit("")))).isin(*KEEP)
    return named.filter(F.coalesce(F.col("review_result").startswith("Confirmed"), F.lit(False)) | marked)


def skip_counts(reviewed: DataFrame) -> DataFrame:
    """How many named pairs are left out, by status."""
    named = reviewed.filter((F.coalesce("mirna", F.lit("")) != "") & (F.coalesce("gene", F.lit("")) != ""))
    marked = F.lower(strip(F.coalesce(F.col("manual_keep").cast("string"), F.lit("")))).isin(*KEEP)
    status = F.coalesce("review_result", F.lit(""))
    out = ~(status.startswith("Confirmed") | marked)
    weak, target, gene = status.contains("Weak"), status.contains("non-target"), status.contains("non-gene")
    return named.agg(
        F.count_if(out & weak).alias("weak"), F.count_if(out & ~weak & target).alias("non_target"), F.count_if(out & ~weak & ~target & gene).alias("non_gene"),
        F.count_if(out & ~weak & ~target & ~gene).alias("not_reviewed"),
    )


def normalized(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("mirna_norm", normalize_mirna(F.col("mirna"), F.col("species"))).withColumn("gene_norm", normalize_gene(F.col("gene")))


def display_name(norm: Column, variants: Column) -> Column:
    others = F.array_sort(F.array_except(variants, F.array(norm)))
    return F.when(F.size(others) > 0, F.concat(norm, F.lit(" ("), F.array_join(others, ", "), F.lit(")"))).otherwise(norm)


GROUP = ("species", "mirna_norm", "gene_norm")


def group_evidence(pairs: DataFrame, order: str = "idx") -> DataFrame:
    """The distinct values of each group (first_seen): what parts of the input know of a group adds up (combined) to what all of it knows."""
    told = lambda c: F.nullif(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(""))
    evidence = {kind: told(c) for kind, c in (("sentences", "sentence"), ("titles", "title"), ("pmids", "pmid"), ("dois", "doi"), ("relation", "relation_type"))}
    return first_seen(pairs, GROUP, F.col(order), ms=F.col("mirna"), gs=F.col("gene"), **evidence)


def merge_pairs(pairs: DataFrame, order: str = "idx") -> DataFrame:
    """One row for each species, normal miRNA and gene: merged evidence in input order, number of PMIDs, modal relation, display names.

    The distinct values of a group are found first, each with its first order and its rows; only these meet in one row, which has to hold them anyway.
    """
    return merged_groups(group_evidence(pairs, order))


def merged_groups(seen: DataFrame) -> DataFrame:
    """The merged rows of groups from their evidence."""
    most = F.min(F.when(F.col("kind") == "relation", F.struct((-F.col("n")).alias("less"), "value")))["value"]
    merged = seen.groupBy(*GROUP).agg(most.alias("relation"), *[in_order(kind).alias(kind) for kind in ("ms", "gs", "sentences", "titles", "pmids", "dois")])
    return merged.select(
        *GROUP, display_name(F.col("mirna_norm"), F.col("ms")).alias("mirna"), display_name(F.col("gene_norm"), F.col("gs")).alias("gene"),
        F.size("pmids").alias("pmid_count"), F.coalesce("relation", F.lit("")).alias("relation_type"),
        F.array_join("sentences", " | ").alias("sentences"), F.array_join("titles", " | ").alias("titles"),
        F.array_join("pmids", ", ").alias("pmids"), F.array_join("dois", ", ").alias("dois"),
    )


def normalize_stats(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Counts before and after normalisation and merging."""
    before = pairs.agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("mirna") != F.col("mirna_norm")).alias("changed"),
        F.countDistinct("mirna").alias("mirnas_before"), F.countDistinct("mirna_norm").alias("mirnas_after"),
    )
    after = groups.agg(F.count(F.lit(1)).alias("groups"), F.count_if(F.col("pmid_count") >= 2).alias("multi_pmid"))
    share = F.round(F.try_divide(F.col("changed") * 100, F.col("pairs")), 1)
    return before.join(F.broadcast(after)).select("*", (F.col("pairs") - F.col("groups")).alias("merged"), share.alias("changed_percent"))


def changed_names(pairs: DataFrame, top: int = 15, order: str = "idx") -> DataFrame:
    """The first pairs whose miRNA name changed: a report of ``top`` rows."""
    return pairs.filter(F.col("mirna") != F.col("mirna_norm")).orderBy(order).limit(top).select(order, "mirna", "mirna_norm", "species")


def statistics_rows(stats: DataFrame, id_stats: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """part, seq, label, value, note: the statistics of the stages before (the first three columns of their non-empty rows), then of this one.

    ``prior``: a table with a column seq and up to three more that count; ``stats`` and ``id_stats``: one row each.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    share = lambda c: F.when(F.col(c).isNull(), "").otherwise(F.concat(F.col(c).cast("string"), F.lit("%")))
    row = lambda seq, label, value="", note=None: F.struct(
        F.lit(seq).cast("long").alias("seq"), F.lit(label).alias("label"), (text(value) if value else F.lit("")).alias("value"), (F.lit("") if note is None else note).alias("note")
    )
    normal = F.array(
        row(1, "--- Normalization & Dedup ---"), row(2, "Pairs (before normalization)", "pairs"), row(3, "miRNA names changed", "changed", share("changed_percent")),
        row(4, "Unique miRNAs (before)", "mirnas_before"), row(5, "Unique miRNAs (after)", "mirnas_after"), row(6, "Pair groups (after dedup)", "groups"),
        row(7, "Merged entries", "merged"), row(8, "Multi-PMID support (>=2)", "multi_pmid"),
    )
    ids = F.array(row(9, "--- Gene ID Resolution ---"), row(10, "Unique genes queried", "total"), row(11, "Resolved", "resolved", share("percent")), row(12, "Unresolved", "unresolved"))
    own = stats.select(F.inline(normal)).unionByName(id_stats.select(F.inline(ids))).withColumn("part", F.lit(1))
    if prior is None:
        return own.select("part", "seq", "label", "value", "note")
    first = [c for c in prior.columns if c != "seq"][:3]
    cells = [text(c).alias(n) for c, n in zip(first, ("label", "value", "note"), strict=False)] + [F.lit("").alias(n) for n in ("label", "value", "note")[len(first) :]]
    kept = prior.select(F.lit(0).alias("part"), F.col("seq").cast("long").alias("seq"), *cells).filter("label <> '' OR value <> '' OR note <> ''")
    return kept.unionByName(own)
