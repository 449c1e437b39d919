"""The hierarchy of sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P


def parent(level: str = "level", number: str = "sec_no", key: str = "doc_id", depth: int = P.MAX_DEPTH) -> Column:
    """The nearest section before that has a smaller level; null at the top.

    The nearest of all smaller levels is the largest of each smaller level's last one.
    """
    before = Window.partitionBy(key).orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    last = [F.when(F.col(level) > k, F.max(F.when(F.col(level) == k, F.col(number))).over(before)) for k in range(1, depth)]
    return F.greatest(*last, F.lit(None).cast("int"))


def with_parents(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    return sections.withColumn("parent_sec_no", parent(key=key).cast("int"))


def child_numbers(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, number, children): the numbers of each top section's children, in order."""
    s, c = sections.alias("s"), sections.alias("c")
    joined = s.where("s.parent_sec_no is null").join(c, (F.col(f"s.{key}") == F.col(f"c.{key}")) & (F.col("c.parent_sec_no") == F.col("s.sec_no")), "left")
    kids = F.array_sort(F.collect_list(F.when(F.col("c.sec_no").isNotNull(), F.struct("c.sec_no", "c.number"))))
    return joined.groupBy(F.col(f"s.{key}").alias(key), F.col("s.sec_no").alias("sec_no"), F.col("s.number").alias("number")).agg(F.transform(kids, lambda x: x["number"]).alias("children"))


def depth(level: str = "level", number: str = "sec_no", key: str = "doc_id", most: int = P.MAX_DEPTH) -> Column:
    """How deep a section lies in the tree, 1 at the top.

    A smaller level holds an ancestor if its last section comes after the last ones of all levels below it.
    """
    before = Window.partitionBy(key).orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    last = [F.coalesce(F.max(F.when(F.col(level) == k, F.col(number))).over(before), F.lit(-1)) for k in range(1, most)]
    out = F.lit(1)
    for k, here in enumerate(last, 1):
        above = F.greatest(F.lit(-1), F.lit(-1), *last[: k - 1])
        out = out + F.when((F.col(level) > k) & (here > above), 1).otherwise(0)
    return out
