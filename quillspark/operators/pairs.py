"""Pairs of miRNAs and genes that occur near each other, with relation type and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.dictionaries import RELATION_CLASSES, RELATION_SIGNALS, Dictionaries, Lists, ListTables
from quillspark.functions.durable import written
from quillspark.functions.text import any_of, built_once, count_below, firsts, let, prefix_tree, sql_string, strip
from quillspark.operators.mentions import UNVERIFIED, Listed, ListedNames, all_genes, all_mirnas, names_at, scan
from quillspark.operators.sentences import sentence_at, split_sentences
from quillspark.operators.species import detect_species

CROWDED = "Unverified (crowded)"
#: Most characters between the names of a pair in neighbouring sentences.
REACH = 400


#: The first letters of relation words.
STEMS = sorted({w[:4] for w in RELATION_SIGNALS})
def classify_relation(sentence: Column) -> Column:
    """The first relation class of which a sentence holds a word, else "associated"."""
    low, out = F.lower(sentence), None
    for name, words in RELATION_CLASSES.items():
        hit = low.rlike(any_of(words))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("associated")


def relation_words(text: Column) -> Column:
    """The relation words of a text as bits of a long, in the order of the signals.

    Every word lies in the letters from a stem on, so only those are looked through, for the words of the stems that are there.
    """
    entry = lambda i, w: f"named_struct('w', {sql_string(w)}, 'b', {1 << i}L)"
    row = lambda stem: ", ".join(entry(i, w) for i, w in enumerate(RELATION_SIGNALS) if w.startswith(stem))
    table = F.expr(f"array({', '.join(f'named_struct({sql_string(chr(115))}, {sql_string(stem)}, {sql_string(chr(120))}, array({row(stem)}))' for stem in STEMS)})")
    told = F.array_join(F.regexp_extract_all(F.lower(text), F.lit(f"{prefix_tree(STEMS)}[a-z]*"), 0), " ")
    none = F.lit(0).cast("long")

    def found(t: Column) -> Column:
        each = F.flatten(F.transform(F.filter(table, lambda r: F.contains(t, r["s"])), lambda r: r["x"]))
        return F.aggregate(each, none, lambda a, x: F.when(F.contains(t, x["w"]), a.bitwiseOR(x["b"])).otherwise(a))

    return let(told, lambda t: F.when(t == "", none).otherwise(found(t)))


def relation_score(text: Column) -> Column:
    return F.bit_count(relation_words(text))


@built_once
def mention_columns(lists: Listed | None) -> tuple[Column, ...]:
    """_scan of block; then mirnas, genes and sentences; then species. Without literal lists, names are looked up in _listed."""
    block, places = F.col("block"), F.col("_scan.places")
    listed = lists or ListedNames(F.col("_listed.blacklist"), F.col("_listed.whitelist"))
    return (
        F.struct(scan(block).alias("places")).alias("_scan"),
        all_mirnas(places).alias("mirnas"), let(places, lambda xs: all_genes(xs, block, listed)).alias("genes"), split_sentences(block).alias("sentences"),
        detect_species(F.col("mirnas"), F.col("genes"), block, F.col("title")).alias("species"),
    )


def with_mentions(blocks: DataFrame, lists: Lists = Dictionaries()) -> DataFrame:
    """mirnas, genes, sentences, species beside the columns of ``blocks`` (block, title): one pass, no shuffle.

    With lists that are tables, the names of the records are joined with them first (listed_names).
    """
    own = [c for c in blocks.columns if c not in ("mirnas", "genes", "sentences", "species")]
    tables = isinstance(lists, ListTables)
    scanned, *found, species = mention_columns(None if tables else lists)
    marked = blocks.select(*own, scanned)
    if tables:
        marked = listed_names(marked, lists.names)
    return marked.select(*own, *found).select("*", species)


#: Most listed names of a corpus that are broadcast.
MOST_BROADCAST = 100_000


def listed_names(scanned: DataFrame, names: DataFrame) -> DataFrame:
    """_listed (blacklist, whitelist: the names of a record that are on either list) beside scanned records.

    The distinct names of all records are joined with the lists, whatever their length; what is found is joined with the records'
    names, as a broadcast if it is short. Only names are shuffled, and the records once.
    """
    placed = written(scanned.withColumn("_row", F.monotonically_increasing_id()))
    held = placed.select("_row", F.explode(names_at(F.col("_scan.places"))).alias("name"))
    known = written(held.select("name").distinct().join(names.select("list", "name").distinct(), "name"))
    few = known.count() <= MOST_BROADCAST
    found = held.join(F.broadcast(known) if few else known, "name")
    on = lambda kind: F.collect_list(F.when(F.col("list") == kind, F.col("name"))).alias(kind)
    by_row = found.groupBy("_row").agg(on("blacklist"), on("whitelist"))
    none = F.array().cast("array<string>")
    both = F.struct(*[F.coalesce(F.col(kind), none).alias(kind) for kind in ("blacklist", "whitelist")])
    return placed.join(by_row, "_row", "left").withColumn("_listed", both).drop("_row", "blacklist", "whitelist")


def pair_candidates(mentioned: DataFrame) -> DataFrame:
    """One row for each pair of names of an abstract: m, g, beside the abstract's columns. Abstracts without either kind give none."""
    names = lambda c: F.array_distinct(F.transform(F.col(c), lambda x: x["name"]))
    each_m = mentioned.select("*", F.explode_outer(names("mirnas")).alias("m")).filter(F.col("m").isNotNull())
    return each_m.select("*", F.explode_outer(names("genes")).alias("g")).filter(F.col("g").isNotNull())


def located(mentions: Column, sentences: Column, *fields: str) -> Column:
    """Mentions (``fields``) with their place in the list (ord) and their sentence (sid)."""
    place = lambda m, i: F.struct(*[m[c].alias(c) for c in fields], i.alias("ord"), sentence_at(sentences, m["start"]).alias("sid"))
    return F.transform(mentions, place)


def by_sentence(placed: Column) -> Column:
    """The first mention of each name in each sentence, by sentence: array of (sid, name, ord, m). Later ones of a sentence are never chosen."""
    keyed = F.transform(placed, lambda m: F.struct(m["sid"].alias("sid"), m["name"].alias("name"), m["ord"].alias("ord"), m.alias("m")))
    return let(F.sort_array(keyed), lambda all_: F.filter(all_, lambda x, i: (i == 0) | (F.get(all_, i - 1)["name"] != x["name"]) | (F.get(all_, i - 1)["sid"] != x["sid"])))


#: Elements of an array that are looked at one by one; in longer ones they are searched by halving.
FEW = 64


def within(items: Column, low: Column, high: Column) -> Column:
    """Elements (sid, ...) of the sentences from low to high of an array that is sorted by sentence."""
    start = count_below(items, low, lambda x: x["sid"])
    sliced = let(start, lambda at: F.slice(items, at + 1, count_below(items, high + 1, lambda x: x["sid"]) - at))
    return F.when(F.size(items) <= FEW, F.filter(items, lambda x: (x["sid"] >= low) & (x["sid"] <= high))).otherwise(sliced)


def closest_pairs(ms: Column, gs: Column, sentences: Column) -> Column:
    """(m, g, sd) of every pair of names that meet in a sentence or in neighbouring ones: the closest two occurrences by sentence, then those
    with the most relation words in between, then the first.

    A band join over sentences: each mention meets only those of its own sentence and the two around it, so the work grows with a
    record's length. Relation words are counted only where two choices are equally close.
    """
    same = lambda a, b: (a["mn"] == b["mn"]) & (a["gn"] == b["gn"])

    def combo(a: Column, b: Column, less: Column) -> Column:
        return F.struct(
            a["name"].alias("mn"), b["name"].alias("gn"), F.abs(a["sid"] - b["sid"]).alias("sd"), less.alias("less"),
            a["ord"].alias("mo"), b["ord"].alias("go"), a["m"].alias("m"), b["m"].alias("g"),
        )

    def told(x: Column, words: Column) -> Column:
        less = -F.bit_count(F.get(words, x["m"]["sid"]).bitwiseOR(F.get(words, x["g"]["sid"])))
        return F.struct(x["mn"], x["gn"], x["sd"], less.alias("less"), x["mo"], x["go"], x["m"], x["g"])

    def leading(all_: Column) -> Column:
        return F.filter(all_, lambda x, i: (i == 0) | ~same(F.get(all_, i - 1), x))

    def decided(all_: Column) -> Column:
        """``all_`` is sorted: a choice is open where the first two of a pair are equally close."""
        second = lambda x, i: (i > 0) & same(F.get(all_, i - 1), x) & (F.get(all_, i - 1)["sd"] == x["sd"])
        begins = lambda i: (i <= 1) | ~same(F.get(all_, F.greatest(i - 2, F.lit(0))), F.get(all_, i))
        open_ = F.size(F.filter(all_, lambda x, i: second(x, i) & begins(i))) > 0
        words = F.transform(sentences, lambda s: relation_words(s["text"]))
        counted = let(let(words, lambda ws: F.sort_array(F.transform(all_, lambda x: told(x, ws)))), leading)
        return F.when(open_, counted).otherwise(leading(all_))

    met = F.flatten(F.transform(ms, lambda a: F.transform(within(gs, a["sid"] - 1, a["sid"] + 1), lambda b: combo(a, b, F.lit(0)))))
    return let(F.sort_array(met), decided)


def is_near(best: Column) -> Column:
    """In one sentence, or in neighbouring ones within REACH characters."""
    return (best["sd"] == 0) | ((best["sd"] == 1) & (F.abs(best["m"]["start"] - best["g"]["start"]) <= REACH))


def is_crowded(best: Column, low: Column, high: Column, ms: Column, gs: Column) -> Column:
    """Whether other miRNAs or genes occur in the sentences of a pair."""

    def others(xs: Column, name: Column) -> Column:
        few = F.exists(xs, lambda x: (x["sid"] >= low) & (x["sid"] <= high) & (x["name"] != name))
        return F.when(F.size(xs) <= FEW, few).otherwise(F.exists(within(xs, low, high), lambda x: x["name"] != name))

    return others(ms, best["m"]["name"]) | others(gs, best["g"]["name"])


def best_occurrences(mentioned: DataFrame) -> DataFrame:
    """m_ord, g_ord (the places of the names), best (sd, m, g) and the texts around, one row for each pair that meets, beside the abstract's columns.

    ``told``: low and high (texts of the first and last sentence of the pair), base (where the first one begins), span (the text
    of both, with what follows where a name runs on), crowded.
    """
    made = ("mirnas", "genes", "sentences", "m_ord", "g_ord", "best", "told")
    kept = [c for c in mentioned.columns if c not in made]
    rows = mentioned.select(*kept, pairs_column()).select(*kept, F.explode_outer("_pairs").alias("_pair")).filter(F.col("_pair").isNotNull())
    return rows.select(*kept, "_pair.m_ord", "_pair.g_ord", "_pair.best", "_pair.told")


@built_once
def pairs_column() -> Column:
    both = F.when((F.size("mirnas") > 0) & (F.size("genes") > 0), F.col("sentences"))
    return let(both, lambda all_: F.when(all_.isNotNull(), pairs_of(F.col("mirnas"), F.col("genes"), all_))).alias("_pairs")


def name_places(mentions: Column) -> Column:
    """(name, ord) of the first mention of each name, by name."""
    named = F.transform(mentions, lambda m, i: F.struct(m["name"].alias("name"), i.alias("ord")))
    return firsts(F.sort_array(named), lambda x: x["name"])


def place_of(places: Column, name: Column) -> Column:
    return F.get(places, count_below(places, name, lambda x: x["name"]))["ord"]


def pairs_of(mirnas: Column, genes: Column, sentences: Column) -> Column:
    """The near pairs of one record: array of (m_ord, g_ord, best, told)."""

    def told(best: Column, x: Column) -> Column:
        low, high = F.least(best["m"]["sid"], best["g"]["sid"]), F.greatest(best["m"]["sid"], best["g"]["sid"])
        first, last = F.get(sentences, low), F.get(sentences, high)
        runs_on = F.greatest(best["m"]["end"], best["g"]["end"]) > last["end"]
        head = F.when(best["sd"] == 1, F.concat(first["text"], first["gap"])).otherwise("")
        behind = F.when(runs_on, F.concat(last["gap"], F.coalesce(F.get(sentences, high + 1)["text"], F.lit("")))).otherwise("")
        return F.struct(
            first["text"].alias("low"), F.when(best["sd"] == 1, last["text"]).alias("high"), first["start"].alias("base"),
            F.concat(head, last["text"], behind).alias("span"), is_crowded(best, low, high, x["ms"], x["gs"]).alias("crowded"),
        )

    def row(c: Column, x: Column) -> Column:
        best = F.struct(c["sd"].alias("sd"), c["m"].alias("m"), c["g"].alias("g"))
        return F.struct(place_of(x["mp"], c["mn"]).alias("m_ord"), place_of(x["gp"], c["gn"]).alias("g_ord"), best.alias("best"), told(c, x).alias("told"))

    def made(x: Column) -> Column:
        return F.transform(closest_pairs(x["ms"], x["gs"], sentences), lambda c: row(c, x))

    bound = F.struct(
        by_sentence(located(mirnas, sentences, "name", "start", "end")).alias("ms"), by_sentence(located(genes, sentences, "name", "confidence", "start", "end")).alias("gs"),
        name_places(mirnas).alias("mp"), name_places(genes).alias("gp"),
    )
    return let(bound, made)


def near_pairs(best: DataFrame) -> DataFrame:
    return best.filter(is_near(F.col("best")))


def evidence(best: Column, told: Column) -> Column:
    """The sentence of a pair, stripped: the shared one; else, of the two that hold a name, one with both, one with the gene, the one with more relation words, the earlier."""
    m, g, low, high = best["m"]["name"], best["g"]["name"], told["low"], told["high"]
    low_m, low_g, high_m, high_g = F.contains(low, m), F.contains(low, g), F.contains(high, m), F.contains(high, g)
    rank = lambda has_m, has_g: F.when(has_m & has_g, 2).when(has_g, 1).otherwise(0)
    later = F.when(rank(low_m, low_g) != rank(high_m, high_g), rank(high_m, high_g) > rank(low_m, low_g)).otherwise(relation_score(high) > relation_score(low))
    own = F.when(best["m"]["sid"] <= best["g"]["sid"], high).otherwise(low)  # where the gene is
    low_one, high_one = low_m | low_g, high_m | high_g
    chosen = F.when(low_one & high_one, F.when(later, high).otherwise(low)).when(low_one, low).when(high_one, high).otherwise(own)
    return strip(F.when(best["sd"] == 0, low).otherwise(chosen))


def is_explicit(best: Column, told: Column) -> Column:
    """Whether the names are written as m/g, g/m or m-g between the two occurrences."""
    m, g = best["m"]["name"], best["g"]["name"]
    start, end = F.least(best["m"]["start"], best["g"]["start"]), F.greatest(best["m"]["end"], best["g"]["end"])
    span = F.substring(told["span"], start - told["base"] + 1, end - start)
    return F.contains(span, F.concat(m, F.lit("/"), g)) | F.contains(span, F.concat(g, F.lit("/"), m)) | F.contains(span, F.concat(m, F.lit("-"), g))


def relation_confidence(crowded: Column, explicit: Column, relation: Column) -> Column:
    return (
        F.when(crowded & ~explicit, CROWDED)
        .when(explicit, "High confidence")
        .when(relation.isin("cleavage", "repression", "targeting"), "Confirmed")
        .when(relation.isin("regulation", "binding", "interaction"), "High confidence")
        .otherwise(UNVERIFIED)
    )


def combined_confidence(gene: Column, relation: Column) -> Column:
    unsure = relation.startswith(UNVERIFIED)
    return F.when((gene == UNVERIFIED) & unsure, UNVERIFIED).when(gene == UNVERIFIED, F.concat(relation, F.lit(" (gene unverified)"))).otherwise(relation)


@built_once
def rating_columns() -> tuple[tuple[Column, ...], tuple[Column, ...], tuple[Column, ...]]:
    """The columns of a pair by best and told, in three steps."""
    best, told, gene = F.col("best"), F.col("told"), F.col("best.g.confidence")
    crowded, explicit, relation = F.col("_crowded"), F.col("_explicit"), F.col("_relation")
    return (
        (evidence(best, told).alias("sentence"), told["crowded"].alias("_crowded"), is_explicit(best, told).alias("_explicit")),
        (F.col("sentence"), crowded, explicit, classify_relation(F.col("sentence")).alias("_relation")),
        (
            best["m"]["name"].alias("mirna"), best["g"]["name"].alias("gene"), gene.alias("gene_confidence"), relation_confidence(crowded, explicit, relation).alias("relation_confidence"),
            combined_confidence(gene, relation_confidence(crowded, explicit, relation)).alias("confidence"),
            F.when(crowded & ~explicit, "associated").otherwise(relation).alias("relation_type"), F.col("sentence"),
        ),
    )


def mine_pairs(mentioned: DataFrame) -> DataFrame:
    """mirna, gene, gene_confidence, relation_confidence, confidence, relation_type, sentence, and their order m_ord, g_ord, beside the abstract's columns."""
    near = near_pairs(best_occurrences(mentioned))
    made = ["m_ord", "g_ord", "best", "told", "mirna", "gene", "gene_confidence", "relation_confidence", "confidence", "relation_type", "sentence"]
    kept = [c for c in near.columns if c not in made] + ["m_ord", "g_ord"]
    said, classed, rated = rating_columns()
    return near.select(*kept, "best", *said).select(*kept, "best", *classed).select(*kept, *rated)


def mention_stats(mentioned: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of abstracts with miRNAs, genes, both and pairs, and of mentions."""
    has_m, has_g = F.size("mirnas") > 0, F.size("genes") > 0
    paired = pairs.select(*keys).distinct().agg(F.count(F.lit(1)).alias("has_pair"))
    return mentioned.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(has_m).alias("has_mirna"), F.count_if(has_g).alias("has_gene"), F.count_if(has_m & has_g).alias("has_both"),
        F.coalesce(F.sum(F.size("mirnas")), F.lit(0)).alias("total_mirna"), F.coalesce(F.sum(F.size("genes")), F.lit(0)).alias("total_gene"),
    ).join(F.broadcast(paired))


def pair_stats(pairs: DataFrame) -> DataFrame:
    """Rows, and distinct non-empty PMIDs, miRNAs and genes."""
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"), F.countDistinct(F.nullif("pmid", F.lit(""))).alias("pmids"), F.countDistinct("mirna").alias("mirnas"), F.countDistinct("gene").alias("genes")
    )


def part_stats(pairs: DataFrame, *parts: str) -> DataFrame:
    """parts, pairs, and sketches of the distinct PMIDs, miRNAs and genes: counts of parts of the input that add up."""
    sketched = {name: F.hll_sketch_agg(F.nullif(F.col(c), F.lit(""))).alias(name) for name, c in (("pmids", "pmid"), ("mirnas", "mirna"), ("genes", "gene"))}
    return pairs.groupBy(*parts).agg(F.count(F.lit(1)).alias("pairs"), *sketched.values())


def summed_stats(parts: DataFrame, *by: str) -> DataFrame:
    """pairs, pmids, mirnas, genes over parts: pairs are exact; the others are estimates, with a standard error of 1.6 % (2**12 registers)."""
    return parts.groupBy(*by).agg(F.sum("pairs").alias("pairs"), *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in ("pmids", "mirnas", "genes")])
