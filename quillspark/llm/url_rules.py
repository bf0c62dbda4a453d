"""URL filters: a list of prefix rules, and association rules mined by FP-growth (native).

A URL is a set of items: all labels of its host, segments of its path and parameters of its
query, and its fragment. FP-growth over the items of labelled pages, with the label as one more
item, gives rules "these items: block"; those of enough support and confidence are kept, without
the ones that contain a kept rule. Items with too few bad pages for any rule are left out before,
and of items that lie in the same pages one stands for all, in the rules, too: neither
changes what is blocked, but both keep baskets of long URLs narrow. The itemsets of FP-growth are bounded
by the support alone: labelled URLs that share many items in many different ways have many itemsets.
Rules match through an inverted index: each is posted under its rarest item and compared in full only
with URLs that hold that item, or another one of its group.

A listed rule overrides what was mined. Null URLs and those without ``://`` have an empty host and
path and no items, so they are allowed. Pages without a label are not learned from; a page with
several labels is bad if any of them is. A URL that stands in many rows, and null ones, are spread over several tasks. Very long
URLs and keys are read whole. Columns other than page_id and url, doc_id, quality and toxic are not looked at. Without bad labels nothing is mined. Repeated rows repeat
in the result; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import durable, even_join

BLOCK = "=block"
#: A mined rule needs this share of the labelled pages, this many of them, and this share of bad ones among those that it matches.
SUPPORT, COUNT, CONFIDENCE = 0.005, 5, 0.6
#: Most rules that are broadcast to the pages; beyond, they are joined by a shuffle.
MOST_BROADCAST = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def items_of(url: Column) -> Column:
    """The distinct items of a URL: h: host label, p: path segment, q: parameter, f: fragment."""
    some = lambda text, by: F.filter(F.split(text, by, -1), lambda x: x != "")
    tagged = lambda tag, xs: F.transform(xs, lambda x: F.concat(F.lit(tag), x))
    part = lambda n: F.coalesce(F.regexp_extract(url, PARTS, n), F.lit(""))
    return F.array_distinct(
        F.concat(
            tagged("h:", F.reverse(some(host_of(url), r"\."))),
            tagged("p:", some(path_of(url), "[/.]")),
            tagged("q:", some(part(3), "&")),
            tagged("f:", F.filter(F.array(part(4)), lambda x: x != "")),
        )
    )


def listed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest of (verdict, host, path prefix) rules that fits: a struct (length, rule, verdict), or null.

    Without any listed rules it is null. A rule fits its host and all subdomains where the path starts with the rule's.
    """
    fits = [
        F.when(
            ((host == h) | host.endswith(f".{h}")) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, h, p in rules
    ]
    return F.array_max(F.array(*fits).cast("array<struct<length:int,rule:string,verdict:string>>"))


def grouped_rules(pages: DataFrame, labels: DataFrame, support: float = SUPPORT, count: int = COUNT, confidence: float = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """items, confidence, key (the rarest item) of the rules that block, over items that each stand for a group; and the groups (rep, item).

    ``pages``: page_id, url; ``labels``: doc_id, quality, toxic. Groups are never multiplied out, however many items they have.
    """
    bad = F.coalesce(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)), F.lit(0))
    marks = labels.groupBy(F.col("doc_id").alias("page_id")).agg(bad.alias("bad"))
    learned = durable(pages.join(marks, "page_id").select(F.monotonically_increasing_id().alias("row"), items_of(F.col("url")).alias("items"), "bad"))
    total = max(1, learned.count())
    # half a count less: the learner rounds share x total up
    least = min(1.0, max(support, (count - 0.5) / total))
    held = learned.select("row", "bad", F.explode("items").alias("item"))
    stats = held.groupBy("item").agg(
        F.sum("bad").alias("n_bad"), F.count(F.lit(1)).alias("freq"), F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y")
    )
    stats = durable(stats.filter(F.col("n_bad") >= math.floor(least * total)))
    same = stats.groupBy("freq", "x", "y").agg(F.min("item").alias("rep"), F.array_sort(F.collect_list("item")).alias("members"))
    same = durable(same.select("rep", "members"))
    narrow = held.join(F.broadcast(same.select(F.col("rep").alias("item"))), "item").groupBy("row").agg(F.collect_list("item").alias("reps"))
    reps = F.coalesce("reps", F.array().cast("array<string>"))
    baskets = learned.select("row", "bad").join(narrow, "row", "left")
    baskets = durable(baskets.select(F.when(F.col("bad") == 1, F.array_append(reps, F.lit(BLOCK))).otherwise(reps).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.filter(F.col("consequent")[0] == BLOCK).select(F.array_sort("antecedent").alias("items"), "confidence")
    rules = durable(rules)
    # a rule that contains another one adds nothing
    inner, outer = rules.select(F.col("items").alias("i"), F.col("i")[0].alias("first")), rules.select(F.col("items").alias("o"), F.explode("items").alias("first"))
    within = (F.size("i") < F.size("o")) & (F.size(F.array_except("i", "o")) == 0)
    extra = outer.join(inner, "first").filter(within).select(F.col("o").alias("items")).distinct()
    kept = rules.join(extra, "items", "left_anti")
    rarest = kept.select("items", "confidence", F.explode("items").alias("item")).join(stats.select("item", "freq"), "item")
    found = durable(rarest.groupBy("items").agg(F.max("confidence").alias("confidence"), F.min(F.struct("freq", "item"))["item"].alias("key")))
    return found, same.select("rep", F.explode("members").alias("item"))


def mined_rules(pages: DataFrame, labels: DataFrame, **options: float) -> DataFrame:
    """items, confidence, key of the rules that block, spelled out for reading: a rule for each choice among the items that lie in the same pages."""
    rules, members = grouped_rules(pages, labels, **options)
    same = members.groupBy("rep").agg(F.collect_list("item").alias("members"))
    choices = rules.select("items", "confidence", "key", F.explode("items").alias("rep")).join(same, "rep").groupBy("items", "confidence", "key").agg(F.collect_list("members").alias("choices"))
    extended = lambda made, members: F.flatten(F.transform(made, lambda x: F.transform(members, lambda m: F.array_append(x, m))))
    every = F.aggregate("choices", F.array(F.array().cast("array<string>")), extended)
    spelled = choices.select(F.explode(every).alias("items"), "confidence").select(F.array_sort("items").alias("items"), "confidence")
    return durable(spelled.withColumn("key", F.get("items", F.lit(0))))


def blocked_urls(urls: DataFrame, rules: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """url, rows (of ``urls``), confidence, matched (number of rules) of the distinct urls that a mined rule blocks.

    With ``members`` (rep, item) a URL holds what its items stand for, so a rule fits by any member of its groups.
    """
    held = urls.filter(F.col("url").isNotNull()).groupBy("url").agg(F.count(F.lit(1)).alias("rows")).withColumn("own", items_of(F.col("url")))
    if members is not None:
        few = members.count() <= MOST_BROADCAST
        told = held.select("url", "rows", F.explode("own").alias("item")).join(F.broadcast(members) if few else members, "item")
        held = told.groupBy("url", "rows").agg(F.collect_set("rep").alias("own"))
    index = F.broadcast(rules) if rules.count() <= MOST_BROADCAST else rules
    met = held.select("url", "rows", "own", F.explode("own").alias("key")).join(index, "key")
    fit = met.filter(F.size(F.array_except("items", "own")) == 0)
    return fit.groupBy("url", "rows").agg(F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("matched"))


def judge_urls(pages: DataFrame, labels: DataFrame, listed: Sequence[tuple[str, str, str]], **options: float) -> DataFrame:
    """page_id, host, path, rule (listed), verdict, confidence (of the best mined rule, if any) for every page."""
    own = pages.select("page_id", "url")
    blocked = blocked_urls(own, *grouped_rules(own, labels, **options)).select("url", "rows", "confidence")
    found = even_join(own, blocked, ["url"], "rows", own.count(), F.monotonically_increasing_id(), "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "confidence"
    )
    found = found.withColumn("listed", listed_rule(F.col("host"), F.col("path"), listed))
    verdict = F.coalesce("listed.verdict", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", F.col("listed.rule").alias("rule"), verdict.alias("verdict"), "confidence")
