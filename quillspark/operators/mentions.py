"""miRNA and gene mentions with offsets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.dictionaries import CONTEXT_SIGNALS, LEGACY_PREFIXES, STRONG_STEMS, STRONG_TAIL, Dictionaries
from quillspark.functions.text import BEFORE, BEHIND, MARK, any_of, between, let, one_of, prefix_tree, running

ARM = r"(?:[-.]\d[ap]?)?"
PREFIX = prefix_tree(LEGACY_PREFIXES)
#: In order: with a species prefix, with a legacy prefix, bare.
MIRNA = {
    "standard": rf"{BEFORE}[a-z]{{3,5}}-[Mm][Ii][Rr]\d+[a-z]*{ARM}{BEHIND}",
    "legacy": rf"{BEFORE}{PREFIX}[Mm][Ii][Rr]\d+[a-z]*{ARM}{BEHIND}",
    "bare": rf"{BEFORE}[Mm][Ii][Rr]\d+[a-z]*{ARM}{BEHIND}",
}
#: In order: database ids, prefixed names, capitals with a number, mixed case with a number, capitals.
GENE = {
    "1": rf"{BEFORE}(?:LOC_Os\d{{2}}[gG]\d{{5}}(?:\.\d+)?|Os\d{{2}}[gGtT]\d{{7}}(?:-\d{{2}})?){BEHIND}",
    "2": rf"{BEFORE}{PREFIX}\s*[A-Z][A-Za-z]{{1,5}}\s*\d{{1,2}}{BEHIND}",
    "3": rf"{BEFORE}[A-Z]{{2,6}}\d{{1,2}}{BEHIND}",
    "3b": rf"{BEFORE}[A-Z][a-z]{{1,4}}[A-Z]?\d{{1,2}}{BEHIND}",
    "4": rf"{BEFORE}[A-Z]{{2,5}}{BEHIND}",
}
@dataclass(frozen=True)
class ListedNames:
    """The names of a record that are on either list, as array columns."""

    blacklist: Column
    whitelist: Column


Listed = Dictionaries | ListedNames
CONFIRMED, HIGH, UNVERIFIED = "Confirmed", "High confidence", "Unverified"
GENE_MENTION = "array<struct<name:string,confidence:string,start:int,end:int>>"


#: How every mention of a miRNA begins.
MIRNA_HEAD = r"\A[A-Za-z]{0,5}-?[Mm][Ii][Rr]"
#: Where a mention of any form may begin. Bare miRNAs are not marked behind a hyphen, as they would be parts of longer names, nor are
#: words of capitals, which a hyphen makes parts of longer ones.
BEGIN = (
    rf"(?U)(?=[A-Za-z]){BEFORE}(?=[a-z]{{3,5}}-[Mm][Ii][Rr]\d|(?<!-)[Mm][Ii][Rr]\d|(?<!-)[A-Z]{{2,6}}\d{{0,2}}{BEHIND}|[A-Z][a-z]{{1,4}}[A-Z]?\d|"
    rf"LOC_Os\d|Os\d\d[gGtT]\d|{PREFIX}(?:[Mm][Ii][Rr]\d|\s*[A-Z][A-Za-z]{{1,5}}\s*\d))"
)


def scan(text: Column) -> Column:
    """All places where a mention may begin, in one pass over the text: array of (start, before, head).

    ``before`` is the character in front; ``head`` is the text up to the place after the next one. A mention holds at most one more
    place, so it lies in the head as a whole: all forms are read from there. Offsets are sums of the lengths in between.
    """
    parts = F.split(F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(" ")), BEGIN, MARK), MARK, -1)

    def placed(all_: Column) -> Column:
        def place(at: Column, i: Column) -> Column:
            head = F.concat(F.get(all_, i), F.when(i + 1 < F.size(all_), F.get(all_, i + 1)).otherwise(""))
            return F.struct(at.alias("start"), F.substring(F.get(all_, i - 1), -1, 1).alias("before"), head.alias("head"))

        starts = running(F.transform(all_, lambda p: F.length(p)))
        return F.filter(F.transform(starts, lambda at, i: F.when(i > 0, place(at, i))), lambda x: x.isNotNull())

    return let(parts, placed)


def form_at(head: Column, pattern: str) -> Column:
    """What a head begins with of a form; empty if it does not."""
    return F.regexp_extract(head, rf"(?U)\A(?:{pattern.removeprefix(BEFORE)})", 0)


def mirnas_at(places: Column, kind: str) -> Column:
    """Mentions of one form; those that begin with "mir" behind a letter or hyphen are parts of longer names and dropped."""

    def mention(x: Column) -> Column:
        return F.struct(x["head"].alias("name"), x["start"].alias("start"), (x["start"] + F.length(x["head"])).alias("end"))

    def whole(x: Column) -> Column:
        return (x["head"] != "") & ~(F.lower(F.left(x["head"], F.lit(3))).eqNullSafe("mir") & x["before"].rlike(r"[\p{L}-]"))

    found = F.transform(places, lambda x: F.struct(x["start"], x["before"], form_at(x["head"], MIRNA[kind]).alias("head")))
    return F.transform(F.filter(found, whole), mention)


def mirnas_of(text: Column, kind: str) -> Column:
    return let(scan(text), lambda places: mirnas_at(places, kind))


def all_mirnas(places: Column) -> Column:
    """All mentions, (name, start, end), form by form; each (name, start) once."""
    some = let(F.filter(places, lambda x: x["head"].rlike(MIRNA_HEAD)), lambda xs: F.concat(*[mirnas_at(xs, kind) for kind in MIRNA]))
    return F.array_distinct(some)


def extract_mirnas(text: Column) -> Column:
    return let(scan(text), all_mirnas)


def crosses_hyphen(text: Column, start: Column) -> Column:
    return (start > 0) & (F.substring(text, start, F.lit(1)) == "-")


def gene_context(text: Column, start: Column, end: Column, reach: int = 120) -> Column:
    """Whether a signal word occurs within ``reach`` characters, the candidate included."""
    return F.lower(between(text, F.greatest(start - reach, F.lit(0)), end + reach)).rlike(any_of(CONTEXT_SIGNALS))


def strong_gene_context(text: Column, position: Column) -> Column:
    """Whether a family word follows within 30 characters, and a gene stem (or a closing "and") lies in the 80 up to the position."""
    before = F.lower(between(text, F.greatest(position - 80, F.lit(0)), position))
    tail = between(text, position, position + 30).rlike(rf"(?iU){BEFORE}(?:{STRONG_TAIL}){BEHIND}")
    return tail & (before.rlike(any_of(STRONG_STEMS)) | before.rlike(rf"(?U){BEFORE}and{BEHIND}\s*\z"))


def outermost(found: Column) -> Column:
    """Without names of the second tier that begin inside the one before, in which alone another may begin; one that is left out hides none."""
    ends = lambda x: x["start"] + F.length(x["name"])

    def inside(i: Column, x: Column) -> Column:
        last = F.get(found, i - 1)
        return F.coalesce((x["tier"] == 2) & (last["tier"] == 2) & (ends(last) > x["start"]), F.lit(False))

    return F.filter(found, lambda x, i: ~inside(i, x) | inside(i - 1, F.get(found, i - 1)))


#: Any form of a gene, without its beginning; they exclude each other at one place.
ANY_GENE = "|".join(p.removeprefix(BEFORE) for p in GENE.values())


def tier_of(name: Column) -> Column:
    """The number of the tier, in their order, of a name of any form."""
    return (
        F.when(name.rlike(r"\A[A-Z]+\z"), 5)
        .when(name.rlike(r"(?U)\A[A-Z]{2,6}\d+\z"), 3)
        .when(name.rlike(r"(?U)\A[A-Z][a-z]{1,4}[A-Z]?\d+\z"), 4)
        .when(name.rlike(r"(?U)\A(?:LOC_Os|Os\d)"), 1)
        .otherwise(2)
    )


def gene_names(places: Column) -> Column:
    """(tier, start, before, name) of every name of any form, by tier."""

    def named(x: Column) -> Column:
        return let(form_at(x["head"], ANY_GENE), lambda name: F.struct(tier_of(name).alias("tier"), x["start"], x["before"], name.alias("name")))

    found = F.filter(F.transform(places, lambda x: F.when(x["head"].rlike(r"\A[A-Z]"), named(x))), lambda x: x["name"] != "")
    return let(F.sort_array(found), outermost)


def all_genes(places: Column, text: Column, lists: Listed = Dictionaries()) -> Column:
    """All accepted mentions, (name, confidence, start, end), tier by tier. No two tiers can accept the same name at the same place: their forms exclude each other."""

    def judged(m: Column) -> Column:
        tier, raw, start, hyphen = m["tier"], m["name"], m["start"], m["before"] == "-"
        end = start + F.length(raw)
        name = F.when(tier == 2, F.replace(raw, F.lit(" "), F.lit(""))).otherwise(raw)
        letters = F.regexp_replace(raw, r"(?U)\d+\z", "")
        near = F.when(gene_context(text, start, end), UNVERIFIED)
        capitals = F.when(hyphen | one_of(letters, lists.blacklist), None).when(one_of(raw, lists.whitelist) | one_of(letters, lists.whitelist), HIGH).otherwise(near)
        family = F.when(hyphen, None).when(one_of(raw, lists.whitelist), HIGH).when(strong_gene_context(text, end), UNVERIFIED)
        confidence = F.when(tier == 1, CONFIRMED).when(tier == 2, HIGH).when(tier == 3, capitals).when(tier == 4, near).otherwise(family)
        return F.struct(name.alias("name"), F.when(~one_of(name, lists.blacklist), confidence).alias("confidence"), start.alias("start"), end.alias("end"))

    return F.filter(F.transform(gene_names(places), judged), lambda m: m["confidence"].isNotNull()).cast(GENE_MENTION)


def genes_of(text: Column, tier: str, lists: Listed = Dictionaries()) -> Column:
    """Accepted mentions of one tier."""
    return let(scan(text), lambda places: all_genes(of_tier(places, tier), text, lists))


def of_tier(places: Column, tier: str) -> Column:
    return F.filter(places, lambda x: form_at(x["head"], GENE[tier]) != "")


def names_at(places: Column) -> Column:
    """All names that the tiers look up in the lists, each once: names of any form, and the letters of capitals with a number."""
    forms = F.transform(gene_names(places), lambda m: F.when(m["tier"] == 2, F.replace(m["name"], F.lit(" "), F.lit(""))).otherwise(m["name"]))
    return F.array_distinct(let(forms, lambda ns: F.concat(ns, F.transform(ns, lambda n: F.regexp_replace(n, r"(?U)\d+\z", "")))))


def extract_genes(text: Column, lists: Listed = Dictionaries()) -> Column:
    return let(scan(text), lambda places: all_genes(places, text, lists))
