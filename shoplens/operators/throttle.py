"""Exact 60 s alert throttle without gathering a device's history (A8 b).

Greedy rule, per device, alerts in (ts, window_start) order: keep an alert if
no alert was kept yet or its whole second is >= ``gap`` after the last kept
one.  Sequential, but a stretch of time acts on what follows only through its exit (the
last kept second), and what came before acts on it only through its entry.  So a
stretch is a map from entry to exit.  It is a step function with few steps: the entry
matters only through the alerts of the stretch's first ``gap`` seconds, so there
are at most ``gap`` + 1 pieces (lo, hi, exit) - entries in (lo, hi] leave by the same
exit, or, with a null exit, pass through unchanged.  Maps compose, and composition is
associative, so they are folded as a tree:

  1. per (device, chunk of time): the chunk's map, each piece folded once;
  2. up: FAN maps in a row are composed into the map of a node, LEVELS times;
  3. down: a node's entry gives the entries of its FAN children;
  4. per (device, chunk): replay from the entry and emit the kept alerts.

No array holds more than one chunk's alerts or FAN maps, however long a device's
history is.  All of it is built-in higher-order functions (``aggregate`` / ``filter`` /
``transform``).  ``seed`` (mid, last_ts) gives the state left by earlier micro-batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.operators.sweep import device

#: Maps composed at a node, and nodes above a chunk: 256 x 256 days are 179 years.
FAN = 256
LEVELS = 2
#: Entry of a device that has no kept alert yet: earlier than any alert by more than any gap.
NEVER = -(1 << 60)
LAST = 1 << 61


def _next_last(last: Column, sec: Column, gap: int) -> Column:
    return F.when(sec - last >= F.lit(gap), sec).otherwise(last)


def _piece(lo: Column, hi: Column, out: Column) -> Column:
    return F.struct(lo.cast("long").alias("lo"), hi.cast("long").alias("hi"), out.cast("long").alias("exit"))


def chunk_map(secs: str, edge: Column, gap: int) -> Column:
    """The map of a chunk with the alert seconds ``secs`` (distinct, sorted).  Piece j: alert j is the first
    one kept; the first ``gap`` seconds end at ``edge``."""
    n = F.size(secs)

    def piece(j: Column) -> Column:
        out = F.aggregate(F.slice(secs, j + 1, n - j), F.lit(None).cast("long"),
                          lambda last, s: F.when(last.isNull(), s).otherwise(_next_last(last, s, gap)))
        lo = F.when(j > 0, F.try_element_at(secs, j) - F.lit(gap)).otherwise(F.lit(2 * NEVER))
        hi = F.when(j < n, F.try_element_at(secs, j + 1) - F.lit(gap)).otherwise(F.lit(LAST))
        return _piece(lo, hi, out)

    early = F.size(F.filter(secs, lambda s: s < edge))
    return F.transform(F.sequence(F.lit(0), early), piece)


def passed(entry: Column, pieces: Column) -> Column:
    """Exit of a map for one entry.  Exactly one piece fits (they tile the line), so
    ``element_at``, which fails loudly on an empty list, is the right accessor."""
    fits = F.element_at(F.filter(pieces, lambda p: (p["lo"] < entry) & (entry <= p["hi"])), 1)
    return F.coalesce(fits["exit"], entry)


def composed(first: Column, then: Column) -> Column:
    """The map of two stretches in a row: a piece with an exit goes through ``then`` as one entry,
    a piece that passes entries through is cut by the pieces of ``then``."""
    def through(p: Column) -> Column:
        cut = F.filter(F.transform(then, lambda q: _piece(F.greatest(p["lo"], q["lo"]), F.least(p["hi"], q["hi"]), q["exit"])),
                       lambda q: q["lo"] < q["hi"])
        return F.when(p["exit"].isNull(), cut).otherwise(F.array(_piece(p["lo"], p["hi"], passed(p["exit"], then))))

    return F.flatten(F.transform(first, through))


IDENTITY = (2 * NEVER, LAST, None)


def _up(maps: DataFrame, level: int) -> DataFrame:
    """(device, node, children): the maps of each node's children in order of time."""
    node = F.floor(F.col("at") / F.lit(FAN)).cast("long").alias("node") if level < LEVELS else F.lit(0).cast("long").alias("node")
    return (maps.select("device", node, F.struct("at", "map").alias("child")).groupBy("device", "node")
            .agg(F.array_sort(F.collect_list("child")).alias("children")))


def _node_map(children: str) -> Column:
    start = F.array(_piece(*(F.lit(x) for x in IDENTITY)))
    return F.aggregate(children, start, lambda acc, c: composed(acc, c["map"]))


def _down(nodes: DataFrame) -> DataFrame:
    """(device, at, entry) of the children of nodes with an ``entry``."""
    start = F.struct(F.col("entry").alias("last"), F.expr("cast(array() as array<struct<at:bigint,entry:bigint>>)").alias("entries"))

    def step(acc: Column, c: Column) -> Column:
        return F.struct(passed(acc["last"], c["map"]).alias("last"),
                        F.array_append(acc["entries"], F.struct(c["at"].alias("at"), acc["last"].alias("entry"))).alias("entries"))

    return nodes.select("device", F.inline(F.aggregate("children", start, step)["entries"]))


def entries(maps: DataFrame) -> DataFrame:
    """(device, at, entry): the last kept second before each chunk, from the maps (device, at, map)
    of all chunks that hold alerts."""
    trees, below = [], maps
    for level in range(LEVELS + 1):
        trees.append(_up(below, level))
        if level < LEVELS:
            below = trees[-1].select("device", F.col("node").alias("at"), _node_map("children").alias("map"))
    found = _down(trees[-1].withColumn("entry", F.lit(NEVER).cast("long")))
    for nodes in reversed(trees[:-1]):
        found = _down(nodes.join(found.withColumnRenamed("at", "node"), ["device", "node"]))
    return found


def throttle(alerts: DataFrame, gap_seconds: int = 60, seed: DataFrame | None = None,
             chunk_seconds: int = 86_400) -> DataFrame:
    gap = gap_seconds
    cols = alerts.columns
    a = alerts.select("*", device(), F.floor(F.col("ts") / F.lit(1000)).cast("long").alias("_sec"),
                      F.floor(F.col("ts") / F.lit(1000 * chunk_seconds)).cast("long").alias("at"))
    if seed is not None:
        # after a kept alert at second L, every alert before L + gap is blocked and
        # the next one is kept: drop the blocked ones, then no state is needed
        last_s = seed.select(device(), F.floor(F.col("last_ts") / F.lit(1000)).cast("long").alias("_seed_s"))
        a = a.join(last_s, "device", "left").where(F.col("_seed_s").isNull() | (F.col("_sec") >= F.col("_seed_s") + F.lit(gap)))
    rest = [c for c in cols if c not in ("ts", "window_start")]
    elem = F.struct("ts", "window_start", "_sec", *rest)          # sorts by (ts, window_start)
    chunks = a.groupBy("device", "at").agg(F.array_sort(F.collect_list(elem)).alias("arr"))
    edge = F.col("at") * F.lit(chunk_seconds) + F.lit(gap)
    maps = (chunks.withColumn("secs", F.array_distinct(F.transform("arr", lambda x: x["_sec"])))
            .select("device", "at", chunk_map("secs", edge, gap).alias("map")))
    replay = chunks.join(entries(maps), ["device", "at"])
    elem_t = chunks.schema["arr"].dataType.simpleString()
    start = F.struct(F.col("entry").alias("last"), F.expr(f"cast(array() as {elem_t})").alias("kept"))

    def keep(acc: Column, x: Column) -> Column:
        return F.when(x["_sec"] - acc["last"] >= F.lit(gap), F.struct(
            x["_sec"].alias("last"), F.array_append(acc["kept"], x).alias("kept"))).otherwise(acc)

    return replay.select(F.inline(F.aggregate("arr", start, keep)["kept"])).select(*cols)
