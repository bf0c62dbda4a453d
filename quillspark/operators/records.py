"""Records of an abstracts file and their metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import built_once, let, strip

# The months, and the patterns of header, author and identifier lines below.
MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"


#: Characters that a block must have more of (fixed value).
LEAST = 50


def blocks_of(content: Column, least: int = LEAST) -> Column:
    """The stripped records of a text as an array: they start at lines like ``12. Word``; short ones are dropped."""
    parts = F.split(F.regexp_replace(content, "\r\n?", "\n"), r"(?U)\n(?=\d+\.\s+\w)", -1)
    return F.filter(F.transform(parts, strip), lambda b: F.length(b) > least)


def split_records(files: DataFrame, id_col: str = "file_id", content_col: str = "content", least: int = LEAST) -> DataFrame:
    """file_id, abstract_index (from 1), block. A file's records are numbered where they lie: nothing is shuffled."""
    found = files.select(F.col(id_col), F.posexplode(blocks_of(F.col(content_col), least)).alias("part", "block"))
    return found.select(id_col, (F.col("part") + 1).alias("abstract_index"), "block")


def pmid_of(block: Column) -> Column:
    return F.nullif(F.regexp_extract(block, r"(?iU)PMID[:：]\s*(\d+)", 1), F.lit(""))


def doi_of(block: Column) -> Column:
    found = F.regexp_extract(block, r"(?U)(?<![\p{L}\p{N}_])(10\.\d{4,}/[^\s]+)", 1)
    return F.when(found != "", F.regexp_replace(found, r"\.+\z", ""))


def is_journal_line(line: Column) -> Column:
    """Whether a stripped line goes on with the journal's header: e-publication notes, dates, identifiers, wrapped words."""
    long_enough = F.length(line)
    return (
        line.rlike(r"(?U)\AEpub\b")
        | line.rlike(rf"(?U)\A(?:\d{{4}}\s+)?(?:{MONTHS})\s+\d+\.?$")
        | line.rlike(r"(?i)\Adoi:")
        | (line.rlike(r"(?U)\A\d{4}\s") & (long_enough < 20))
        | line.rlike(r"(?iU)\AeCollection\b")
        | line.rlike(r"(?U)\A10\.\d{4,}/")
        | line.rlike(r"(?iU)\AOnline\s+ahead\s+of\s+print")
        | (line.rlike(r"\A\p{IsLowercase}") & (long_enough < 40))
    )


def title_of(block: Column) -> Column:
    """The first paragraph behind the header, up to an author or metadata line; null if there is none.

    One fold over the lines: the header ends before its first line that is neither blank nor a continuation.
    """
    start = F.struct(F.lit(0).alias("n"), F.lit(False).alias("past"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("title"))

    def seen(acc: Column, line: Column) -> Column:
        first, blank = acc["n"] == 0, line == ""
        header = ~acc["past"] & (first | (~blank & is_journal_line(line)))
        ends = line.rlike(r"(?U)\(\d+\)|@") | line.rlike(r"(?i)\A(Author info|DOI|PMID|PMCID|Conflict)")
        return F.struct(line.alias("line"), header.alias("header"), (line == "").alias("blank"), (~header & ~blank & ends).alias("ends"))

    def next_state(acc: Column, x: Column) -> Column:
        stop = ~x["header"] & F.when(x["blank"], F.size(acc["title"]) > 0).otherwise(x["ends"])
        take = ~x["header"] & ~x["blank"] & ~x["ends"] & ~acc["done"]
        return F.struct(
            (acc["n"] + 1).alias("n"),
            (acc["past"] | ~x["header"]).alias("past"),
            (acc["done"] | stop).alias("done"),
            F.when(take, F.concat(acc["title"], F.array(x["line"]))).otherwise(acc["title"]).alias("title"),
        )

    def step(acc: Column, raw: Column) -> Column:
        # each line is looked at once, and no more when the title is there
        return F.when(acc["done"], acc).otherwise(let(let(strip(raw), lambda line: seen(acc, line)), lambda x: next_state(acc, x)))

    lines = F.split(block, "\n", -1)
    return F.aggregate(lines, start, step, lambda acc: F.when(F.size(acc["title"]) > 0, F.regexp_replace(F.array_join(acc["title"], " "), r"\.+\z", "")))


def body_of(block: Column) -> Column:
    """The first paragraph of lines that are no metadata, numbering or authors, joined by spaces."""
    start = F.struct(F.lit(False).alias("done"), F.array().cast("array<string>").alias("body"))

    def seen(line: Column) -> Column:
        skip = line.rlike(r"(?i)\A(DOI|PMID|PMCID|Conflict|Author info)") | line.rlike(r"(?U)\(\d+\).*@|\A\d+\.\s")
        author = line.rlike(r"(?U)\(\d+\)|\A[A-Z][a-z]+ [A-Z]\.?$")
        return F.struct(line.alias("line"), (line == "").alias("blank"), skip.alias("skip"), author.alias("author"))

    def next_state(acc: Column, x: Column) -> Column:
        stop = ~x["skip"] & x["blank"] & (F.size(acc["body"]) > 0)
        take = ~x["skip"] & ~x["blank"] & ~x["author"]
        return F.struct((acc["done"] | stop).alias("done"), F.when(take, F.concat(acc["body"], F.array(x["line"]))).otherwise(acc["body"]).alias("body"))

    def step(acc: Column, raw: Column) -> Column:
        return F.when(acc["done"], acc).otherwise(let(let(strip(raw), seen), lambda x: next_state(acc, x)))

    return F.aggregate(F.split(block, "\n", -1), start, step, lambda acc: F.array_join(acc["body"], " "))


@built_once
def metadata_columns(block_col: str) -> tuple[Column, ...]:
    block = F.col(block_col)
    return pmid_of(block).alias("pmid"), doi_of(block).alias("doi"), title_of(block).alias("title"), body_of(block).alias("body")


def with_metadata(blocks: DataFrame, block_col: str = "block") -> DataFrame:
    """pmid, doi, title and body of each block, beside its columns."""
    return blocks.select("*", *metadata_columns(block_col))
