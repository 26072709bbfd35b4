"""How many points fall into each of many ranges, without a range join.

Joining points to ranges costs points times ranges, or worse when one stray row
stretches a range over everything. Counting needs no join on the ranges at all:

    count in [lo, hi] = C(hi) - C(lo - 1),   C(x) = points not above x

Values are read as numbers of a few large digits. A point is counted under its
shortest leading part that no range end shares, so far from all ends one counter
serves a whole stretch of values, and only next to an end single values are told
apart. Adding the counters up towards shorter parts, C(x) is the sum, digit by
digit, of what lies left of x among its siblings. Siblings are at most ``2 **
DIGIT_BITS``, however the points lie: a hot value, overlapping ranges or one
absurd end make no large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow.scratch import materialise

#: Size of a digit, hence the most counters that are ever summed up together.
DIGIT_BITS = 12


def count_in_ranges(points: DataFrame, value: Column, ranges: DataFrame, low: str, high: str) -> DataFrame:
    """``ranges`` with ``in_range``: the points whose integer ``value`` lies in [low, high].

    A range with a null end counts nothing. ``ranges`` (distinct rows, one per
    partition) is read several times, so pass a written table rather than an
    aggregate over a huge scan; the counters are written out for the same reason.
    The outer ends of the ranges come back as literals and reach the scan of the
    points as pushed filters.
    """
    ends = ranges.select(F.explode(F.array(F.col(low) - 1, F.col(high))).alias("at")).dropna()
    first, last = ends.agg(F.min("at"), F.max("at")).first()
    if first is None:
        return ranges.withColumn("in_range", F.lit(0).cast("bigint"))
    levels = max(1, -(-(last - first).bit_length() // DIGIT_BITS))

    def part(at: Column, level: int) -> Column:
        """The first ``level`` digits of a value."""
        return F.shiftright(at - first, DIGIT_BITS * (levels - level))

    at = F.col("at")
    counters = points.where(value.between(first + 1, last)).select(value.cast("bigint").alias("at"))
    for level in range(1, levels):
        # written out, its size is known: the optimizer broadcasts a small one, and next to
        # a large one splits the partitions of hot leading parts
        shared = materialise(ends.select(part(at, level).alias(f"shared{level}")).distinct(), "range-parts")
        counters = counters.join(shared, part(at, level) == F.col(f"shared{level}"), "left")
    level_of, part_of = F.lit(levels), part(at, levels)
    for level in range(levels - 1, 0, -1):
        alone = F.col(f"shared{level}").isNull()
        level_of = F.when(alone, level).otherwise(level_of)
        part_of = F.when(alone, part(at, level)).otherwise(part_of)
    counters = materialise(
        counters.groupBy(level_of.alias("level"), part_of.alias("part")).agg(F.count(F.lit(1)).alias("n")),
        "range-counters",
    )

    # a counter also counts for every shorter part of its value
    shorter = F.explode(
        F.expr(f"transform(sequence(1, level), l -> struct(l as level, shiftright(part, {DIGIT_BITS} * (level - l)) as part))")
    )
    nodes = (
        counters.select(shorter.alias("node"), "n")
        .groupBy("node.level", "node.part")
        .agg(F.sum("n").alias("n"))
        .select("level", F.shiftright("part", DIGIT_BITS).alias("parent"), F.col("part").alias("place"), "n")
    )
    # what an end needs on each level: all before its own part, and on the last
    # level, where the part is the value itself, that too
    places = [
        F.struct(
            F.lit(level).alias("level"),
            F.shiftright(part(at, level), DIGIT_BITS).alias("parent"),
            (part(at, level) - (0 if level == levels else 1)).alias("place"),
        )
        for level in range(1, levels + 1)
    ]
    marks = ends.select(F.explode(F.array(*places)).alias("mark")).select("mark.*").distinct()
    siblings = Window.partitionBy("level", "parent").orderBy("place")
    up_to_here = siblings.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    left = (
        nodes.withColumn("is_mark", F.lit(False))
        .unionByName(marks.withColumns({"n": F.lit(0).cast("bigint"), "is_mark": F.lit(True)}))
        .withColumn("c", F.sum("n").over(up_to_here))
        .where("is_mark")
        .select(F.struct("level", "parent", "place").alias("mark"), "c")
    )

    signed = F.explode(
        F.array(
            F.struct((F.col(low) - 1).alias("at"), F.lit(-1).alias("sign")),
            F.struct(F.col(high).alias("at"), F.lit(1).alias("sign")),
        )
    )
    names = ranges.columns
    wanted = ranges.withColumn("_end", signed).withColumn("at", F.col("_end.at"))
    wanted = wanted.withColumn("mark", F.explode(F.array(*places)))
    both_ends = F.col(low).isNotNull() & F.col(high).isNotNull()
    total = F.greatest(F.coalesce(F.sum(F.col("_end.sign") * F.col("c")), F.lit(0)), F.lit(0))
    return (
        wanted.join(left, "mark", "left")
        .groupBy(*names)
        .agg(total.alias("_n"))
        .withColumn("in_range", F.when(both_ends, F.col("_n")).otherwise(0))
        .select(*names, "in_range")
    )
