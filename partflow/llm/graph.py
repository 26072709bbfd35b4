"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import materialise

#: Shifts of a one-to-one scrambling of 64-bit numbers (any would do).
_SHIFTS = ((13, True), (7, False), (17, True))


def _shift(c: Column, by: int, left: bool) -> Column:
    return F.shiftleft(c, by) if left else F.shiftrightunsigned(c, by)


def scramble(c: Column) -> Column:
    """Put numbers in an order unlike their own, one to one."""
    for by, left in _SHIFTS:
        c = c.bitwiseXOR(_shift(c, by, left))
    return c


def unscramble(c: Column) -> Column:
    for by, left in reversed(_SHIFTS):
        found = c
        for times in range(1, -(-64 // by)):
            found = found.bitwiseXOR(_shift(c, by * times, left))
        c = found
    return c


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (the smallest node it reaches) for every node of a link.

    Each round lets every node point to the smallest of itself and its neighbours, in a
    scrambled order that keeps chains short, and goes on with the links between what
    was pointed to, until none is left. A round is one aggregation with partial sums on
    the map side and two joins of written tables, whose hot keys adaptive execution
    splits; it removes a fixed share of the nodes, whatever the graph looks like. Links
    with a null end and links of a node with itself are ignored.
    """
    links = links.where(F.col(a) != F.col(b)).select(scramble(F.col(a).cast("long")).alias("a"), scramble(F.col(b).cast("long")).alias("b"))
    links = materialise(_ordered(links, "a", "b"), "links")
    steps = []
    while links.limit(1).count():
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("to"))
        steps.append(materialise(low, "pointers"))
        of_a = steps[-1].select(F.col("u").alias("a"), F.col("to").alias("to_a"))
        of_b = steps[-1].select(F.col("u").alias("b"), F.col("to").alias("to_b"))
        links = materialise(_ordered(links.join(of_a, "a").join(of_b, "b"), "to_a", "to_b"), "links")
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = steps[0]
    for step in steps[1:]:
        then = step.select(F.col("u").alias("to"), F.col("to").alias("next"))
        found = found.join(then, "to", "left").select("u", F.coalesce("next", "to").alias("to"))
    found = materialise(found.select(unscramble(F.col("u")).alias("node"), "to"), "roots")
    smallest = materialise(found.groupBy("to").agg(F.min("node").alias("component")), "smallest")
    return found.join(smallest, "to").select("node", "component")


def _ordered(links: DataFrame, a: str, b: str) -> DataFrame:
    return links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
