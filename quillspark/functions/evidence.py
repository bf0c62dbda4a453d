"""Distinct values of groups in the order in which they were first seen, without gathering a group's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_seen(rows: DataFrame, keys: Sequence[str], order: Column, **values: Column) -> DataFrame:
    """keys, kind (a name of ``values``), value, first (its least order), n (its rows): one row for each distinct value of a group.

    Null values do not count. Values are counted before they are sent, so a group of many rows with few values costs no task more than its share.
    """
    each = F.array(*[F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value")) for kind, value in values.items()])
    told = rows.select(*keys, order.alias("_order"), F.explode(each).alias("_x")).select(*keys, "_order", "_x.kind", "_x.value").filter("value IS NOT NULL")
    return told.groupBy(*keys, "kind", "value").agg(F.min("_order").alias("first"), F.count(F.lit(1)).alias("n"))


def combined(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One first_seen table from those of several parts of the input."""
    return parts.groupBy(*keys, "kind", "value").agg(F.min("first").alias("first"), F.sum("n").alias("n"))


def in_order(kind: str) -> Column:
    """Aggregate over first_seen: the values of a kind by their first order."""
    return F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("first", "value")))), lambda x: x["value"])


def leading(seen: DataFrame, keys: Sequence[str], kind: str, most: int) -> DataFrame:
    """keys and the first ``most`` values of a kind, in a column of its name: tasks send no more than that of each group."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("first", "value"))
    few = seen.filter(F.col("kind") == kind).withColumn("_place", place).filter(F.col("_place") <= most)
    return few.groupBy(*keys).agg(in_order(kind).alias(kind))
