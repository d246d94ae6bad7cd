"""Distinct counts over moving windows by sweeping interval ends.

A window that ends at position x covers the positions (x - length, x].  So a value that
occurs at p is inside every window that ends in [p, p + length), and the windows that
hold it are the union of these intervals over its occurrences.  The number of distinct
values in a window is then a running sum of +1 where a union begins and -1 where
it ends; no window ever holds a set.

Positions are cut into blocks of at most one length.  Inside a block a value is held
from its first occurrence there to the block's end, and, carried in from before, from
the block's start until its last earlier occurrence plus the length.  Both ends are
plain aggregates (``min``, ``max``) per (device, value, block), combined map-side, so
neither a hot device nor a hot value gathers anywhere; a block is swept by itself.

Positions are milliseconds (trailing rule) or numbers of panes (sliding windows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = ["device", "block"]
POINT = [*BLOCK, "at"]


def device(mid: str = "mid") -> Column:
    """The device as a key without nulls, so that joins keep a null device too."""
    return F.coalesce(F.concat(F.lit("+"), F.col(mid)), F.lit("-")).alias("device")


def mid_of(key: str = "device") -> Column:
    return F.when(F.col(key) != "-", F.substr(F.col(key), F.lit(2))).alias("mid")


class Sweep:
    """Windows of ``length`` positions, swept in blocks of ``block`` positions."""

    def __init__(self, length: int, block: int):
        if not 0 < block <= length:
            raise ValueError("a block is at least one position and at most one window long")
        self.length, self.size = length, block
        self.reach = (block + length - 2) // block  # blocks after its own that an occurrence carries into
        self.start = F.col("block") * F.lit(block)
        self.end = self.start + F.lit(block)

    def block_of(self, at: Column) -> Column:
        return F.floor(at / F.lit(self.size)).cast("long")

    def activity(self, marks: DataFrame, values: list[str]) -> DataFrame:
        """(device, block, *values, first, until): the value is in the windows of the block that end
        from ``first`` on and in those that end before ``until``.  ``marks``: device, at, *values."""
        own = (marks.groupBy("device", self.block_of(F.col("at")).alias("block"), *values)
               .agg(F.min("at").alias("first"), F.max("at").alias("last")))
        spread = own.select("device", *values, "block", "first", "last", F.explode(F.sequence(F.lit(0), F.lit(self.reach))).alias("i"))
        spread = spread.select("device", *values, (F.col("block") + F.col("i")).alias("block"),
                               F.when(F.col("i") == 0, F.col("first")).alias("first"),
                               F.when(F.col("i") > 0, F.col("last") + F.lit(self.length)).alias("until"))
        held = spread.where(F.col("first").isNotNull() | (F.col("until") > self.start))
        return held.groupBy(*BLOCK, *values).agg(F.min("first").alias("first"), F.max("until").alias("until"))

    def changes(self, activity: DataFrame, counted: dict[str, Column]) -> DataFrame:
        """(device, block, at, *counted): where the number of held values changes, and by how much,
        for each name of ``counted`` among the values of its condition."""
        until = F.least("until", F.coalesce("first", self.end), self.end)
        carried = F.col("until") > self.start

        def step(at: Column, by: int) -> Column:
            return F.struct(at.alias("at"), *[F.when(c, F.lit(by)).otherwise(F.lit(0)).cast("long").alias(n) for n, c in counted.items()])

        steps = F.array(F.when(carried, step(self.start, 1)), F.when(carried & (until < self.end), step(until, -1)),
                        F.when(F.col("first").isNotNull(), step(F.col("first"), 1)))
        return activity.select(*BLOCK, F.inline(F.filter(steps, lambda s: s.isNotNull())))

    def levels(self, changes: DataFrame, points: DataFrame | None = None) -> DataFrame:
        """Running sums of ``changes`` at every position where one changes and, if given, at
        ``points`` (device, block, at; marked by ``is_point``), and the position of the next row."""
        names = [c for c in changes.columns if c not in POINT]
        every = changes.select(*POINT, *names, F.lit(False).alias("is_point"))
        if points is not None:
            every = every.unionAll(points.select(*POINT, *[F.lit(0).cast("long") for _ in names], F.lit(True)))
        swept = every.groupBy(*POINT).agg(*[F.sum(n).alias(n) for n in names], F.max("is_point").alias("is_point"))
        by = Window.partitionBy(*BLOCK).orderBy("at")
        so_far = by.rowsBetween(Window.unboundedPreceding, 0)
        return swept.select(*POINT, *[F.sum(n).over(so_far).alias(n) for n in names], "is_point",
                            F.lead("at").over(by).alias("next"))

    def counts_at(self, points: DataFrame, tallies: DataFrame, kind: str) -> DataFrame:
        """(device, block, at, kind, n, ts): how many marks of each kind the window that ends at each
        point holds, and the least ts among those in the point's block.  ``tallies``: device, kind,
        at, n, ts.  Only blocks with points are swept."""
        blocks = points.select(*BLOCK).distinct()
        marks = (tallies.select("device", kind, "at", "n", "ts", F.explode(F.sequence(F.lit(0), F.lit(self.reach))).alias("i"))
                 .withColumn("block", self.block_of(F.col("at")) + F.col("i"))
                 .join(blocks, BLOCK, "left_semi"))
        gone, none = F.col("at") + F.lit(self.length), F.lit(None).cast("long")

        def step(at: Column, d: Column, ts: Column) -> Column:
            return F.struct(at.alias("at"), d.alias("d"), ts.alias("ts"))

        n = F.col("n")
        steps = F.when(F.col("i") == 0, F.array(step(F.col("at"), n, F.col("ts")))).when(
            gone > self.start, F.array(step(self.start, n, none), step(gone, -n, none)))
        moved = marks.select(*BLOCK, kind, F.inline(steps)).where(F.col("at") < self.end)
        moved = moved.groupBy(*POINT, kind).agg(F.sum("d").alias("d"), F.min("ts").alias("ts"), F.lit(False).alias("is_point"))
        asked = (points.select(*POINT).join(marks.select(*BLOCK, kind).distinct(), BLOCK)
                 .select(*POINT, kind, F.lit(0).cast("long").alias("d"), none.alias("ts"), F.lit(True).alias("is_point")))
        by = Window.partitionBy(*BLOCK, kind).orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
        swept = moved.unionByName(asked).select(*POINT, kind, "is_point", F.sum("d").over(by).alias("n"), F.min("ts").over(by).alias("ts"))
        return swept.where(F.col("is_point") & (F.col("n") > 0)).drop("is_point")

    def held_at(self, points: DataFrame, activity: DataFrame, values: list[str]) -> DataFrame:
        """(device, block, at, *values): the values that the window ending at each point holds."""
        return (points.select(*POINT).join(activity, BLOCK)
                .where((F.col("first") <= F.col("at")) | (F.col("until") > F.col("at"))).select(*POINT, *values))
