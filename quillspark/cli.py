"""Command lines of the four stages: ``python -m quillspark extract | review | normalize | learn``.

All paths may be on any file system that Spark reads. Tables are Parquet folders, or CSV files with ``--csv``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.dictionaries import BLACKLIST, WHITELIST, Dictionaries, ListTables
from quillspark.functions.text import literals
from quillspark.operators import pairs as pair_ops
from quillspark.operators import review
from quillspark.plans import workflow
from quillspark.sources.abstracts import first_existing, read_abstracts, read_dictionaries, read_pairs, write_dictionaries, write_table
from quillspark.sources.adapters import ChatReviewer, HttpLookup


def text_of(path: str | None) -> str:
    """A prompt's instructions from a local file."""
    if not path:
        return ""
    with open(path, encoding="utf-8") as f:
        return f.read()


def chat_of(args: argparse.Namespace) -> ChatReviewer | None:
    return ChatReviewer(args.url, args.model, args.key_variable) if args.url else None


def labelled(stats: DataFrame, labels: dict[str, str]) -> DataFrame:
    """seq, label, value of a one-row table."""
    rows = [F.struct(F.lit(i).alias("seq"), F.lit(label).alias("label"), F.col(c).cast("string").alias("value")) for i, (c, label) in enumerate(labels.items(), 1)]
    return stats.select(F.inline(F.array(*rows)))


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    """Mine abstracts: the pairs table and its statistics; with ``--auto-review`` the review follows."""
    lists = read_dictionaries(spark, args.lists) if args.lists else Dictionaries()
    write_table(workflow.extract_pairs(read_abstracts(spark, args.abstracts), lists), f"{args.out}/pairs", args.form, exchanged=True)
    found = read_pairs(spark, f"{args.out}/pairs", args.form)
    stats = labelled(pair_ops.pair_stats(found), {"pairs": "Total pairs", "pmids": "Unique PMIDs", "mirnas": "Unique miRNAs", "genes": "Unique genes"})
    write_table(stats, f"{args.out}/statistics", args.form)
    print(f"{found.count()} pairs in {args.out}/pairs")
    if args.auto_review:
        run_review(spark, args)


def run_review(spark: SparkSession, args: argparse.Namespace) -> None:
    """Review uncertain pairs; verdicts are kept in ``out/verdicts``, so a run that broke off goes on from there."""
    found = read_pairs(spark, f"{args.out}/pairs", args.form)
    chat = chat_of(args)
    reviewed = workflow.review_into(found, f"{args.out}/verdicts", chat, args.batch, text_of(args.instructions), chat.single() if chat else None)
    write_table(reviewed, f"{args.out}/reviewed", args.form, exchanged=True)
    for name, n in review.review_stats(read_pairs(spark, f"{args.out}/reviewed", args.form)).first().asDict().items():
        print(f"{name}: {n}")


def normalize(spark: SparkSession, args: argparse.Namespace) -> None:
    """Normalise, merge and resolve the reviewed table, or the pairs as mined where there is none."""
    source = first_existing(spark, args.input or "", f"{args.out}/reviewed", f"{args.out}/pairs")
    ids = spark.read.parquet(args.gene_ids) if args.gene_ids else None
    rice = HttpLookup(args.rice_url, "gb2312", pause=0) if args.rice_url else None
    entity = HttpLookup(args.entity_url, pause=0) if args.entity_url else None
    prior = read_pairs(spark, args.statistics, args.form) if args.statistics else None
    lookups = {"workers": args.workers, "per_second": (args.rice_per_second, args.entity_per_second), "saved": f"{args.out}/answers"}
    for name, table in workflow.export_tables(read_pairs(spark, source, args.form), ids, prior, rice, entity, **lookups).items():
        write_table(table, f"{args.out}/final_{name}", args.form)
    print(f"{source} -> {args.out}/final_groups, final_detail, final_statistics")


def learn(spark: SparkSession, args: argparse.Namespace) -> None:
    """Propose names for both lists; a new version is written only with ``--apply``."""
    source = first_existing(spark, args.input or "", f"{args.out}/reviewed")
    lists = read_dictionaries(spark, args.lists) if args.lists else Dictionaries(tuple(BLACKLIST), tuple(WHITELIST))
    if isinstance(lists, ListTables):
        black, white = (lists.names.filter(F.col("list") == kind).select("name") for kind in ("blacklist", "whitelist"))
    else:
        black, white = (spark.range(1).select(F.explode(literals(names)).alias("name")) for names in (lists.blacklist, lists.whitelist))
    reviewed, chat = read_pairs(spark, source, args.form), chat_of(args)
    if chat is None:
        for kind, found in zip(("blacklist", "whitelist"), workflow.learn(reviewed, black, white), strict=True):
            print(f"{kind}: {found.count()} candidates")
        return
    write_table(workflow.learned(reviewed, black, white, chat, (text_of(args.black_instructions), text_of(args.white_instructions))), f"{args.out}/proposed_lists")
    made = spark.read.parquet(f"{args.out}/proposed_lists")
    for row in made.filter("added").groupBy("list").count().collect():
        print(f"{row['list']}: {row['count']} additions")
    print(f"written to {write_dictionaries(made, f'{args.out}/lists')}" if args.apply else "preview only: --apply writes a new version")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="quillspark", description="Mine regulator-gene relations from abstracts.")
    stages = out.add_subparsers(dest="stage", required=True)

    def stage(name: str, run, remote: bool = True) -> argparse.ArgumentParser:
        p = stages.add_parser(name, help=run.__doc__)
        p.set_defaults(run=run)
        p.add_argument("--out", required=True, help="folder of the stages' tables")
        p.add_argument("--csv", dest="form", action="store_const", const="csv", default="parquet")
        if remote:
            p.add_argument("--url", help="chat-completion endpoint")
            p.add_argument("--model", default="")
            p.add_argument("--key-variable", default="LLM_API_KEY", help="environment variable that holds the key")
        return p

    for name, run in (("extract", extract), ("review", run_review)):
        p = stage(name, run)
        p.add_argument("--batch", type=int, default=5)
        p.add_argument("--instructions", help="file with the questions to the reviewer")
        if name == "extract":
            p.add_argument("abstracts")
            p.add_argument("--lists")
            p.add_argument("--auto-review", action="store_true")
    p = stage("normalize", normalize, remote=False)
    for option in ("--input", "--gene-ids", "--rice-url", "--entity-url", "--statistics"):
        p.add_argument(option)
    p.add_argument("--workers", type=int, default=1, help="lookups that run at a time")
    p.add_argument("--rice-per-second", type=float, default=1 / 0.3, help="calls that the rice table gets")
    p.add_argument("--entity-per-second", type=float, default=1 / 0.4, help="calls that the entity search gets")
    p = stage("learn", learn)
    for option in ("--input", "--lists", "--black-instructions", "--white-instructions"):
        p.add_argument(option)
    p.add_argument("--apply", action="store_true")
    return out


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or SparkSession.builder.appName("quillspark").getOrCreate(), args)
