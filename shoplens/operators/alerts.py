"""Coupon-abuse alerts.

Rule: within one device's window, at least ``min_uids`` distinct accounts
claimed coupons and no item was clicked (A5, F7, F2).

A5 / W1  window_alerts     tumbling or sliding event-time windows
W2       trailing_alerts   the rule evaluated at every event over the trailing length
         (sliding windows and the trailing rule count by sweeping: see ``operators.sweep``)
A8 (a)   per_minute        one alert per (device, epoch minute): the latest window wins
A8 (b)   throttle          keep an alert only if >= 60 s after the device's last kept alert

Deliberate choices: ``ts`` is the earliest event time in the window; id sets
are sorted; a null uid / item id counts as the empty string; an event without
time is in no window.  A window's event list is its count per event type
(``coupon x3,view x1``): nothing is cut, and the row stays bounded however many
events a hot device sends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.decode import alert_doc_id
from shoplens.operators import sweep

COUPON = "coupon"
CLICK = "clickItem"


def _duration_ms(text: str) -> int:
    num, unit = text.strip().split(maxsplit=1)
    unit = unit.lower().rstrip("s")
    scale = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    return int(float(num) * scale[unit])


def _coupon(col: str) -> Column:
    return F.when(F.col("evid") == COUPON, F.coalesce(F.col(col), F.lit("")))


def _rule_aggregates() -> list[Column]:
    """Aggregates of the events of one type (grouped by device, window and type)."""
    return [
        F.array_sort(F.collect_set(_coupon("uid"))).alias("uid_set"),
        F.array_sort(F.collect_set(_coupon("itemid"))).alias("item_set"),
        F.count(F.lit(1)).alias("n"),
        F.min("ts").alias("ts"),
    ]


def _union(col: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(col)))).alias(col)


def _all_types() -> list[Column]:
    """A window's aggregates from those of its event types: one row per type."""
    return [
        _union("uid_set"), _union("item_set"),
        F.array_sort(F.collect_list(F.struct("evid", "n"))).alias("type_counts"),
        F.sum("n").alias("n_events"),
        F.max((F.col("evid") == CLICK).cast("int")).alias("clicked"),
        F.min("ts").alias("ts"),
    ]


def _types_text(counts: str) -> Column:
    return F.concat_ws(",", F.transform(counts, lambda t: F.concat(F.coalesce(t["evid"], F.lit("")), F.lit(" x"), t["n"].cast("string"))))


def _alert_columns(keys: list[str]) -> list[Column]:
    """The alert of a row with ts, uid_set, item_set, type_counts, n_events."""
    return [
        *[F.col(k) for k in keys],
        F.col("ts"),
        alert_doc_id("mid", "ts").alias("doc_id"),
        F.size("uid_set").cast("long").alias("n_uids"),
        F.concat_ws(",", "uid_set").alias("uids"),
        F.concat_ws(",", "item_set").alias("item_ids"),
        _types_text("type_counts").alias("events"),
        F.col("n_events").cast("long").alias("n_events"),
    ]


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("event_time", F.timestamp_millis("ts"))


TYPE_KEYS = ["mid", "window_start", "window_end"]


def type_state(events: DataFrame, length: str = "5 minutes", slide: str | None = None,
               watermark: str | None = None) -> DataFrame:
    """Rule aggregates per (device, window, event type), one row per type seen.

    One aggregation: the sets are built map-side and merged after the shuffle, so
    a hot device is pre-aggregated per input partition.  Window bounds are epoch
    ms (zone independent).  With ``watermark`` it is a streaming aggregation
    whose state is dropped once the watermark passes the window end.
    """
    return _bounds(_window_types(events, length, slide, watermark))


def _window_types(events: DataFrame, length: str, slide: str | None, watermark: str | None) -> DataFrame:
    ev = _timed(events)
    if watermark:
        ev = ev.withWatermark("event_time", watermark)
    win = F.window("event_time", length, slide) if slide else F.window("event_time", length)
    return ev.groupBy(win.alias("w"), "mid", "evid").agg(*_rule_aggregates())


def _timed(events: DataFrame) -> DataFrame:
    return with_event_time(events.select("mid", "uid", "evid", "itemid", "ts").where(F.col("ts").isNotNull()))


def _bounds(agg: DataFrame) -> DataFrame:
    return agg.select("mid", F.unix_millis(F.col("w.start")).alias("window_start"),
                      F.unix_millis(F.col("w.end")).alias("window_end"),
                      *[c for c in agg.columns if c not in ("w", "mid")])


def merge_types(types: DataFrame) -> DataFrame:
    """Rule aggregates per (device, window) from those per event type."""
    return types.groupBy(*TYPE_KEYS).agg(*_all_types())


def window_state(events: DataFrame, length: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """Rule aggregates per (device, window), before the alert filter."""
    return merge_types(type_state(events, length, slide))


def final_state(events: DataFrame, length: str, slide: str | None, watermark: str) -> DataFrame:
    """Streaming form for closed windows (append mode): the aggregation per event
    type, then a second one over the closed windows' types."""
    types = _window_types(events, length, slide, watermark)
    return _bounds(types.groupBy("w", "mid").agg(*_all_types()))


#: Windows that start in a row are kept together, as many as fit in this share of their length.
GROUP_SHARE = 4


def pane_stream_state(events: DataFrame, length: str, slide: str, watermark: str) -> DataFrame:
    """Streaming form of the pane technique (append mode only): tumbling panes
    of one slide, then groups of windows that start in a row over the pane rows, whose event
    time is ``window_time(pane)`` (the pane's last instant, so each pane falls in
    exactly the groups with a window that contains it), from which the windows are cut.  Chained
    stateful aggregations: the state holds one partial per (device, pane, type), in
    the lists of at most ``GROUP_SHARE`` + 2 groups, instead of a row for each of length/slide
    windows and type.  A group closes with its last window, so a window comes out less than
    length / ``GROUP_SHARE`` after its end."""
    span, step = _duration_ms(length), _duration_ms(slide)
    if span % step:
        raise ValueError("pane windows need a length that is a multiple of the slide")
    together = max(1, span // step // GROUP_SHARE)
    ev = _timed(events).withWatermark("event_time", watermark)
    panes = ev.groupBy(F.window("event_time", slide).alias("p"), "mid", "evid").agg(*_rule_aggregates())
    pt = panes.select("mid", "evid", F.window_time("p").alias("pane_time"), F.unix_millis(F.col("p.start")).alias("at"),
                      "uid_set", "item_set", "n", "ts")
    held = F.window("pane_time", f"{span + (together - 1) * step} milliseconds", f"{together * step} milliseconds")
    groups = pt.groupBy(held.alias("g"), "mid").agg(F.collect_list(F.struct("at", "evid", "uid_set", "item_set", "n", "ts")).alias("panes"))
    starts = F.transform(F.sequence(F.lit(0), F.lit(together - 1)), lambda k: F.unix_millis(F.col("g.start")) + k * F.lit(step))
    windows = groups.select("mid", "panes", F.explode(starts).alias("window_start"))
    own = F.filter("panes", lambda p: (p["at"] >= F.col("window_start")) & (p["at"] < F.col("window_start") + F.lit(span)))
    windows = windows.select("mid", "window_start", (F.col("window_start") + F.lit(span)).alias("window_end"), own.alias("panes"))
    return windows.where(F.size("panes") > 0).select(*TYPE_KEYS, *_of_panes("panes"))


def _of_panes(panes: str) -> list[Column]:
    """A window's aggregates (those of ``_all_types``) from the list of its panes' partials."""
    def names(field: str) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.col(panes)[field]))).alias(field)

    def count(of: Column) -> Column:
        return F.aggregate(of, F.lit(0).cast("long"), lambda acc, p: acc + p["n"])

    counts = F.transform(F.array_distinct(F.col(panes)["evid"]), lambda e: F.struct(
        e.alias("evid"), count(F.filter(panes, lambda p: p["evid"].eqNullSafe(e))).alias("n")))
    return [names("uid_set"), names("item_set"), F.array_sort(counts).alias("type_counts"), count(F.col(panes)).alias("n_events"),
            F.exists(panes, lambda p: p["evid"].eqNullSafe(F.lit(CLICK))).cast("int").alias("clicked"),
            F.array_min(F.col(panes)["ts"]).alias("ts")]


def alerts_from_state(state: DataFrame, min_uids: int = 3) -> DataFrame:
    rule = (F.size("uid_set") >= min_uids) & (F.coalesce("clicked", F.lit(0)) == 0)
    return state.where(rule).select(*_alert_columns(["mid", "window_start", "window_end"]))


def window_alerts(events: DataFrame, length: str = "5 minutes", slide: str | None = None,
                  min_uids: int = 3) -> DataFrame:
    """Alerts per (device, window); tumbling when ``slide`` is None (A5 + W1)."""
    span, step = _duration_ms(length), _duration_ms(slide or length)
    if span > step and span % step == 0:
        return _sliding_alerts(events, span, step, min_uids)
    return alerts_from_state(window_state(events, length, slide), min_uids)


def _marks(events: DataFrame, at: Column) -> DataFrame:
    """Events at their position on the sweep's axis; those without time have none."""
    return (events.where(F.col("ts").isNotNull())
            .select(sweep.device(), at.cast("long").alias("at"), "evid", "ts", *[_coupon(c).alias(c) for c in ("uid", "itemid")]))


NAMED = ["kind", "name"]


def _alerting(marks: DataFrame, over: sweep.Sweep, min_uids: int, points: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(levels that alert, activity of accounts, items and clicks): the rule by running sums."""
    def named(kind: str, name: Column) -> Column:
        return F.when(name.isNotNull(), F.struct(F.lit(kind).alias("kind"), name.alias("name")))

    click = F.when(F.col("evid") == CLICK, F.lit(""))
    names = F.filter(F.array(named("uid", F.col("uid")), named("item", F.col("itemid")), named("click", click)), lambda x: x.isNotNull())
    active = over.activity(marks.select("device", "at", F.inline(names)), NAMED)
    counted = {"n_uids": F.col("kind") == "uid", "clicks": F.col("kind") == "click"}
    levels = over.levels(over.changes(active.where(F.col("kind") != "item"), counted), points)
    return levels.where((F.col("n_uids") >= min_uids) & (F.col("clicks") == 0)), active


def _contents(points: DataFrame, marks: DataFrame, active: DataFrame, over: sweep.Sweep) -> DataFrame:
    """uid_set, item_set, type_counts, n_events and ts (the first of the last block) of the windows
    that end at the alerting ``points``."""
    tallies = marks.groupBy("device", "evid", "at").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("ts"))
    counts = over.counts_at(points, tallies.withColumn("evid", F.struct("evid")), "evid")
    parts = (over.held_at(points, active, NAMED).select(
                *sweep.POINT, *NAMED, F.lit(None).cast("struct<evid:string,n:bigint>").alias("type"), F.lit(None).cast("long").alias("ts"))
             .unionAll(counts.select(*sweep.POINT, F.lit("type"), F.lit(None).cast("string"),
                                     F.struct(F.col("evid.evid").alias("evid"), "n"), "ts")))

    def sorted_names(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("name"))))

    return parts.groupBy(*sweep.POINT).agg(
        sorted_names("uid").alias("uid_set"), sorted_names("item").alias("item_set"),
        F.array_sort(F.collect_list("type")).alias("type_counts"), F.sum("type.n").alias("n_events"), F.min("ts").alias("ts"))


def _sliding_alerts(events: DataFrame, span: int, step: int, min_uids: int) -> DataFrame:
    """Sliding windows on an axis of panes of one slide: a window ends with its last pane.
    Accounts, clicks and panes are aggregated once, whatever length / slide is; only
    runs of windows that alert are written out as windows."""
    k = span // step
    over = sweep.Sweep(k, k)
    marks = _marks(events, F.floor(F.col("ts") / F.lit(step)))
    runs, active = _alerting(marks, over, min_uids)
    points = runs.select(*sweep.BLOCK, F.explode(F.sequence("at", F.coalesce("next", over.end) - 1)).alias("at"))

    # a window's first event: the first of its first pane's block from that pane on, else the first of its last block
    panes = marks.groupBy("device", "at").agg(F.min("ts").alias("ts"))
    panes = panes.select("device", over.block_of(F.col("at")).alias("block"), "at", "ts", F.lit(None).cast("long").alias("ends"))
    begin = F.col("at") - F.lit(k - 1)
    asked = points.select("device", over.block_of(begin).alias("block"), begin.alias("at"), F.lit(None).cast("long"), F.col("at").alias("ends"))
    onward = Window.partitionBy(*sweep.BLOCK).orderBy("at").rangeBetween(0, Window.unboundedFollowing)
    first = (panes.unionAll(asked).select("device", "ends", F.min("ts").over(onward).alias("before"))
             .where(F.col("ends").isNotNull()).withColumnRenamed("ends", "at"))

    out = _contents(points, marks, active, over).join(first, ["device", "at"])
    start = (F.col("at") - F.lit(k - 1)) * F.lit(step)
    out = out.select("*", sweep.mid_of(), start.alias("window_start"), (start + F.lit(span)).alias("window_end"))
    return out.withColumn("ts", F.coalesce("before", "ts")).select(*_alert_columns(["mid", "window_start", "window_end"]))


def trailing_alerts(events: DataFrame, length: str = "5 minutes", min_uids: int = 3,
                    split: int = 1) -> DataFrame:
    """The rule at every event over (ts - length, ts] of the same device.

    Swept in blocks of ``length / split`` milliseconds per device: a hot device is
    spread over all its blocks; raising ``split`` spreads one that is dense inside a
    length over more tasks, at the price of more carried ends.  What an alert
    names (accounts, items, counts per type) is looked up for alerting events only.
    """
    span = _duration_ms(length)
    over = sweep.Sweep(span, -(-span // split))
    marks = _marks(events, F.col("ts"))
    levels, active = _alerting(marks, over, min_uids, marks.select("device", over.block_of(F.col("at")).alias("block"), "at"))
    found = _contents(levels.where("is_point").select(*sweep.POINT), marks, active, over).drop("block", "ts")
    out = marks.select("device", "at", "evid", "ts").join(found, ["device", "at"])
    return out.withColumn("mid", sweep.mid_of()).select(*_alert_columns(["mid", "evid"]))


def per_minute(alerts: DataFrame) -> DataFrame:
    """One alert per document id ``mid || epoch-minute(ts)``; the latest window wins (A8 a)."""
    cols = [c for c in alerts.columns if c != "doc_id"]
    latest = F.max_by(F.struct(*cols), F.struct("window_start", "window_end")).alias("a")
    return alerts.groupBy("doc_id").agg(latest).select("doc_id", "a.*")


def throttle(alerts: DataFrame, gap_seconds: int = 60, seed: DataFrame | None = None,
             chunk_seconds: int = 86_400) -> DataFrame:
    """Keep an alert when its second is >= ``gap_seconds`` after the last kept one (A8 b).

    Exact, and no group larger than one device-day: see ``operators.throttle``.
    ``seed`` (mid, last_ts) carries the last alert kept by earlier micro-batches.
    """
    from shoplens.operators.throttle import throttle as chunked

    return chunked(alerts, gap_seconds, seed, chunk_seconds)
