"""Line deduplication with a log-template tree (native).

A line is parsed at fixed depth: tokens that hold a digit, ``@`` or ``://`` become ``<*>``, and
the number of tokens with the first ``depth`` of them names the line's leaf. The rest of the line
is cut into at most ``FIELDS`` fields of consecutive tokens (single tokens, if they are that few).
Within a leaf a field value that fewer than ``min_docs`` documents support is a variable field;
the leaf, the constant fields and the places of the variable ones are the line's template. Lines
whose constant fields make up less than ``similarity`` of all have no template.

A template that recurs in ``min_docs`` documents or more is dropped everywhere but in the
document with the least id, so that every passage survives once. Lines of fewer than
``min_tokens`` tokens are never dropped.

Hashes that name lines and templates have 128 bits over hashes of 64 for each field: lines that differ in one
field alone are told apart by 64 bits.

Lines are separated by line feeds. Null and empty texts have no lines and stay as they are.
Repeated rows (equal id and text) count as one document and are treated alike; a null id orders
before others. Only hashes, ids and positions are shuffled until the texts meet their dropped
positions. An empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import durable, even_join, written

FIELDS = 12
SPACE = "[ \\t\\x0B\\f\\r]+"
ODD = "[\\t\\x0B\\f\\r]"
#: What every variable token has one of.
MARKS = "[0-9@:]"
#: A whole token with a digit, an at sign or a scheme; possessive, so long tokens cost linear time.
VARIABLE = "(?<![^ ])(?:[^ 0-9@:]|:(?!//))*+(?:[0-9@]|://)[^ ]*+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, though lambdas in it may refer to it often."""
    return F.transform(F.array(value), use)[0]


def masked_line(line: Column, spaced: Column, variable: Column) -> Column:
    """A line with single spaces and variable tokens as <*>. The flags tell whether its text has any odd space, or any character of a variable token."""
    single = F.trim(F.when(spaced, F.regexp_replace(line, SPACE, " ")).otherwise(line))
    return let(single, lambda x: F.when(variable & x.rlike(MARKS), F.regexp_replace(x, VARIABLE, "<*>")).otherwise(x))


def field_hashes(tokens: Column, depth: int) -> Column:
    """Hashes of the fields into which the tokens after the leading ones are cut."""

    def cut(n: Column, fields: Column) -> Column:
        bound = lambda k: F.floor(k * n / fields).cast("int") + depth
        # single tokens are taken by their places: a slice would copy the whole line for every field
        own = lambda k: F.transform(F.sequence(bound(k), bound(k + 1) - 1), lambda j: F.get(tokens, j))
        return F.transform(F.sequence(F.lit(0), fields - 1), lambda k: F.xxhash64(own(k)))

    rest = F.size(tokens) - depth
    none = F.array().cast("array<bigint>")
    return F.when(rest > 0, let(rest, lambda n: cut(n, F.least(n, F.lit(FIELDS))))).otherwise(none)


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def parsed_lines(docs: DataFrame, id_col: str, text_col: str, depth: int, min_tokens: int) -> DataFrame:
    """One narrow row for each line of min_tokens tokens or more: doc_id, row, pos, leaf, line, check, fields.

    Within a leaf two hashes of all fields' hashes name a line, 128 bits together.
    """

    def parsed(tokens: Column, pos: Column) -> Column:
        n = F.size(tokens)
        leaf = F.xxhash64(n, F.slice(tokens, 1, depth)).alias("leaf")
        made = lambda fields: F.struct(pos.alias("pos"), leaf, F.xxhash64(fields).alias("line"), F.xxhash64(F.lit(1), fields).alias("check"), fields.alias("fields"))
        return F.when(n >= min_tokens, let(field_hashes(tokens, depth), made))

    text = F.col(text_col)
    flags = F.struct((F.contains(text, F.lit("  ")) | text.rlike(ODD)).alias("spaced"), text.rlike(MARKS).alias("variable"))
    # one expression for a whole text: as separate columns, the tokens would be computed again for every use
    each = lambda f: F.transform(
        F.split(text, "\n", -1), lambda line, i: let(F.split(masked_line(line, f["spaced"], f["variable"]), " ", -1), lambda tokens: parsed(tokens, i))
    )
    # the key of a row belongs below the generator: above, it would be computed from the whole text again for every line
    held = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row"), F.filter(let(flags, each), lambda x: x.isNotNull()).alias("xs"))
    return held.select("doc_id", "row", F.explode_outer("xs").alias("x")).filter("x IS NOT NULL").select("doc_id", "row", "x.*")


def recurring_positions(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_tokens: int = 5, depth: int = 3, similarity: float = 0.8
) -> DataFrame:
    """row, doc_id, drop, copies: for each document with dropped lines their positions from 0, and how many rows of ``docs`` it stands for.

    A leaf, line or template that holds many rows is spread over several tasks wherever rows meet their group (``even_join``).
    """
    lines = written(parsed_lines(docs, id_col, text_col, depth, min_tokens))
    total, at = lines.count(), F.monotonically_increasing_id()  # of a scan: the same rows in the same order every time
    # leaves seen in enough documents; all others are out before fields are looked at
    leaves = lines.groupBy("leaf", "row").agg(F.count(F.lit(1)).alias("n")).groupBy("leaf").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n")).filter(F.col("docs") >= min_docs)
    variants = (
        even_join(lines, leaves.select("leaf", "n"), ["leaf"], "n", total, at, grows=True)
        .groupBy("leaf", "line", "check", "row")
        .agg(F.min("fields").alias("fields"), F.count(F.lit(1)).alias("n"))
        .groupBy("leaf", "line", "check")
        .agg(F.min("fields").alias("fields"), F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n"))
    )
    variants = durable(variants)
    # lines without fields have one place that stands for all of them
    cut = variants.select("leaf", "line", "check", "docs", "n", F.posexplode_outer("fields").alias("k", "field")).na.fill(-1, ["k", "field"])
    support = cut.groupBy("leaf", "k", "field").agg(F.sum("docs").alias("support"), F.count(F.lit(1)).alias("same")).filter(F.col("support") >= min_docs)
    marked = even_join(cut, support.select("leaf", "k", "field", "same"), ["leaf", "k", "field"], "same", variants.count() * FIELDS, F.col("line"), "left", grows=True)
    constant = F.when(F.col("same").isNotNull(), F.col("field"))
    templates = (
        marked.groupBy("leaf", "line", "check")
        .agg(F.array_sort(F.collect_list(F.struct("k", constant.alias("field")))).alias("fields"), F.count("same").alias("constant"), F.count(F.lit(1)).alias("all"), F.max("n").alias("n"))
        .filter(F.col("constant") >= F.lit(similarity) * F.col("all"))
        .select("leaf", "line", "check", "n", pattern_hash().alias("template"), pattern_hash(F.lit(1)).alias("proof"))
    )
    found = even_join(lines.select("doc_id", "row", "pos", "leaf", "line", "check"), templates, ["leaf", "line", "check"], "n", total, at, grows=True)
    found = written(found.select("template", "proof", "doc_id", "row", "pos"))
    recurring = (
        found.groupBy("template", "proof", "doc_id", "row").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("template", "proof").agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("doc_id", "row")).alias("first"), F.sum("n").alias("n"))
        .filter(F.col("docs") >= min_docs).drop("docs")
    )
    return (
        even_join(found, recurring, ["template", "proof"], "n", found.count(), at, grows=True)
        .filter(~F.struct("doc_id", "row").eqNullSafe(F.col("first")))
        .groupBy("row", "doc_id")
        .agg(F.array_sort(F.collect_set("pos")).alias("drop"), F.count(F.lit(1)).alias("n"))
        .select("row", "doc_id", "drop", F.ceil(F.col("n") / F.size("drop")).alias("copies"))
    )


def pattern_hash(*seed: Column) -> Column:
    """A hash of a leaf and its constant fields with their places; other places count as variable."""
    flat = F.transform("fields", lambda x: F.coalesce(x["field"], F.lit(0)))
    kinds = F.transform("fields", lambda x: x["field"].isNull())
    return F.xxhash64(*seed, F.col("leaf"), flat, kinds)


def _deduplicated(docs: DataFrame, id_col: str, text_col: str, **options: float) -> tuple[DataFrame, dict[str, str], Column]:
    """Rows under names of their own (no name can clash inside), those names by column, and the text that is left."""
    drops = recurring_positions(docs, id_col, text_col, **options).select(F.col("row").alias("d_key"), F.xxhash64("doc_id").alias("d_id"), F.col("drop").alias("d_drop"), F.col("copies").alias("d_copies"))
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(c).alias(a) for c, a in own.items()], row_key(id_col, text_col).alias("d_key"), F.xxhash64(id_col).alias("d_id"))
    joined = even_join(inner, drops, ["d_key", "d_id"], "d_copies", docs.count(), F.monotonically_increasing_id(), "left", grows=True)
    # set difference of positions, then lines by place: linear in the lines
    kept = let(
        F.split(F.col(own[text_col]), "\n", -1),
        lambda lines: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("d_drop")), lambda i: F.get(lines, i)), "\n"),
    )
    return joined, own, F.when(F.col("d_drop").isNull(), F.col(own[text_col])).otherwise(kept)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: float) -> DataFrame:
    """The rows of ``docs`` with recurring lines taken out of their texts, and two more columns.

    ``_lines``: lines before (0 for a null text); ``_dropped``: lines taken out. Columns of ``docs`` with these names give way.
    """
    joined, own, text = _deduplicated(docs, id_col, text_col, **options)
    return joined.select(
        *[(text if c == text_col else F.col(a)).alias(c) for c, a in own.items() if c not in ("_lines", "_dropped")],
        F.when(F.col(own[text_col]).isNull(), 0).otherwise(F.size(F.split(F.col(own[text_col]), "\n", -1))).alias("_lines"),
        F.when(F.col("d_drop").isNull(), 0).otherwise(F.size("d_drop")).alias("_dropped"),
    )


def without_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars", **options: float) -> DataFrame:
    """``docs`` without recurring lines and without the documents of which nothing else is left; a column ``size_col`` follows the text."""
    joined, own, text = _deduplicated(docs, id_col, text_col, **options)
    left = joined.withColumn("left", text).filter(F.col("d_drop").isNull() | (F.trim("left") != ""))
    size = lambda c: F.when(F.col("d_drop").isNull(), F.col(own[c])).otherwise(F.length("left").cast(docs.schema[c].dataType))
    return left.select(*[(F.col("left") if c == text_col else size(c) if c == size_col else F.col(a)).alias(c) for c, a in own.items()])
