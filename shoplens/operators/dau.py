"""Daily active devices: first start-up per (device, day) and the day / hour counts.

A6 / W4  first_seen      earliest row per (mid, logDate); ties broken by every column
J4       new_against     drop rows whose (mid, logDate) is already in a seen set
J5       new_against(by="mid")  the processing-day variant keyed by mid only
T2       openings, first_per_set   seen sets that expire a fixed time after they are opened
A1 / A2  dau_total / dau_hours
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["mid", "logDate"]


def first_seen(logs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Earliest start-up per key.

    ``min(struct(ts, ...))`` is an ordinary aggregate, so Spark combines it
    map-side before the shuffle: a device holding a third of all rows sends
    one partial row per input partition, never its whole history to one task.
    """
    keys = keys or KEY
    rest = [c for c in logs.columns if c not in keys and c != "ts"]
    best = F.min(F.struct("ts", *rest)).alias("_first")
    return logs.groupBy(*keys).agg(best).select(*keys, "_first.*").select(*logs.columns)


def new_against(batch: DataFrame, seen: DataFrame, by: str = "mid_date") -> DataFrame:
    """Rows of ``batch`` whose device was not seen.

    ``seen`` needs only the key columns; it is de-duplicated first (a
    partial aggregate) so a hot key cannot blow up the anti-join.  No
    broadcast hint: the seen set grows with the number of devices; AQE
    turns the join into a broadcast at run time when the measured side is small.
    """
    keys = KEY if by == "mid_date" else ["mid"]
    seen_keys = seen.select(*keys).distinct()
    return batch.join(seen_keys, keys, "left_anti")


def openings(logs: DataFrame, ttl_seconds: int, known: DataFrame | None = None) -> DataFrame:
    """(logDate, opened, until): the seen sets of each day.

    A day's set is opened by the first arrival (``arrived``, epoch ms) and dies ``ttl_seconds``
    later, whatever arrives meanwhile; the next arrival opens another.  ``known`` (logDate,
    opened) are sets opened by earlier micro-batches.  One round of the loop finds the next
    set of all days at once, so there are as many rounds as sets that one day goes through;
    what reaches the driver is one number for each day and set.
    """
    spark = logs.sparkSession
    times = logs.select("logDate", "arrived").where(F.col("logDate").isNotNull() & F.col("arrived").isNotNull())
    found = [] if known is None else [tuple(r) for r in known.select("logDate", "opened").collect()]
    while True:
        last = {}
        for day, opened in found:
            last[day] = max(opened, last.get(day, opened))
        now = spark.createDataFrame(list(last.items()), "logDate string, opened long")
        later = times.join(F.broadcast(now), "logDate", "left").where(
            F.col("opened").isNull() | (F.col("arrived") >= F.col("opened") + F.lit(1000 * ttl_seconds)))
        more = [tuple(r) for r in later.groupBy("logDate").agg(F.min("arrived")).collect()]
        if not more:
            break
        found += more
    sets = spark.createDataFrame(found, "logDate string, opened long").distinct()
    by = Window.partitionBy("logDate").orderBy("opened")
    return sets.select("logDate", "opened", F.lead("opened").over(by).alias("until"), F.row_number().over(by).alias("number"))


def first_per_set(logs: DataFrame, sets: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """The first arrival of each device in each set (``opened`` is added), without those ``seen``
    (mid, logDate, opened).  An arrival before a day's first set belongs to that one."""
    day = sets.select(F.col("logDate").alias("_day"), "opened", "until", "number")
    inside = ((F.col("arrived") >= F.col("opened")) | (F.col("number") == 1)) & (F.col("until").isNull() | (F.col("arrived") < F.col("until")))
    rows = logs.join(F.broadcast(day), (F.col("logDate") == F.col("_day")) & inside).drop("_day", "until", "number")
    keys = [*KEY, "opened"]
    if seen is not None:
        rows = rows.join(seen.select(*keys).distinct(), keys, "left_anti")
    rest = [c for c in rows.columns if c not in (*keys, "arrived", "ts")]
    best = F.min(F.struct("arrived", "ts", *rest)).alias("_first")
    return rows.groupBy(*keys).agg(best).select(*keys, "_first.*").select(*rows.columns)


def dau_total(first: DataFrame) -> DataFrame:
    return first.groupBy("logDate").agg(F.count(F.lit(1)).alias("dau"))


def dau_hours(first: DataFrame) -> DataFrame:
    return first.groupBy("logDate", "logHour").agg(F.count(F.lit(1)).alias("dau"))
