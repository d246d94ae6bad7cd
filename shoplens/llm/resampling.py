"""Importance resampling towards a target distribution.

Words of a text and runs of them are hashed into buckets.  Counted over the whole
corpus and over a target corpus, each bucket has a gain: the smoothed log ratio of its
two frequencies, in whole thousandths.  The gains are one array of fixed length, which
goes to every task and scores a document by summing what its features hit.  With Gumbel
noise added, the documents of highest score are a draw without replacement in
proportion to their importance.

The cutoff is found exactly, by weighted median of medians.  Every partition reports the
median key of what is still open in it, and how much that is; the median of these,
weighted by the sizes, is at least as good as a quarter of all open keys and no better
than another quarter, so counting against it discards one side whatever the data are
like.  Discarded keys are left behind for good: once an eighth is open, only that is
written for the next rounds.  A key is (score, doc_id, row): no two are equal.  Winners are
sorted by range and numbered in place; a partition's first rank is the sum of the counts
before it.

What reaches the driver: a count for each bucket, a median for each partition and round, a count for
each partition of the winners.

Defined results: a null or wordless text has no features and weight 0, and is never
drawn if ``least_words`` is over 0; a null doc_id draws its noise as the empty id and comes after all others in a
tie; rows with equal doc_id and score are taken in the order in which they are
read; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import by_batch, cut, slots, utf8
from shoplens.session import ship_by_value

#: Buckets, longest run of words, seed of the noise, least words and per cent of documents drawn.
BUCKETS = 10_000
WIDTH = 1
SEED = 2024
LEAST_WORDS = 20
PER_CENT = 10
#: Distinct features whose bucket a task remembers.
REMEMBERED = 1 << 20
#: Once so small a share of the keys written last is open, it is written anew.
REWRITE = 8

#: A-Z in lower case; every byte between words becomes a space.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or b >= 0x61 and not 0x7B <= b <= 0x7F else 0x20
              for b in range(256))


class Buckets(dict):
    """feature -> its bucket; what a task remembers is bounded."""

    def __init__(self, n: int):
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.n
        return found


def features(words: list[bytes], width: int) -> list[bytes]:
    """All runs of 1 to ``width`` consecutive words."""
    found = list(words)
    for n in range(2, width + 1):
        found += [b" ".join(words[k:k + n]) for k in range(len(words) - n + 1)]
    return found


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, width: int = WIDTH) -> np.ndarray:
    """How often features of all texts fall in each bucket.  A task adds up all it reads."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, bucket = np.zeros(buckets, np.int64), Buckets(buckets)
        for batch in batches:
            for text in utf8(batch.column(0)):
                hit = [bucket[f] for f in features((text or b"").translate(LOWER).split(), width)]
                total += np.bincount(np.array(hit, np.int64), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, np.int64)
    for bucket, n in rows.collect():
        total[bucket] = n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of the add-one smoothed frequencies, by bucket."""
    all_source, all_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_source / ((s + 1.0) * all_target)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""
    held = docs.sparkSession.sparkContext.broadcast(gain)  # one number for each bucket

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        gain, bucket = held.value, Buckets(len(held.value))
        ids, sizes, counts, weights, scores = batch.column(0).to_pylist(), [], [], [], []
        for doc_id, text in zip(ids, utf8(batch.column(1))):
            words = (text or b"").translate(LOWER).split()
            found = features(words, width)
            sizes.append(len(words))
            counts.append(len(found))
            weights.append(int(gain[np.array([bucket[f] for f in found], np.int64)].sum()))
            scores.append(weights[-1] + noise(doc_id, seed))
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (ids, sizes, counts, weights, scores)],
            ["doc_id", "n_words", "n_features", "weight", "score"])

    return by_batch(docs.select(F.col("doc_id").cast("long"), "text"), ["doc_id", "text"],
                    "doc_id long, n_words long, n_features long, weight long, score long", score)


class Key(NamedTuple):
    """Place of a document in the draw: the smaller the better."""

    cost: int
    doc: int
    row: int


NULL_ID = (1 << 63) - 1
KEY = "cost long, doc long, row long"


def keys(rows: DataFrame) -> DataFrame:
    return rows.select((-F.col("score")).alias("cost"), F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "row")


def before(key: Key) -> Column:
    """Rows of ``keys`` that come before ``key``."""
    cost, doc, row = F.col("cost"), F.col("doc"), F.col("row")
    return (cost < key.cost) | (cost == key.cost) & ((doc < key.doc) | (doc == key.doc) & (row < key.row))


def after(key: Key) -> Column:
    cost, doc, row = F.col("cost"), F.col("doc"), F.col("row")
    return (cost > key.cost) | (cost == key.cost) & ((doc > key.doc) | (doc == key.doc) & (row > key.row))


def _medians(open_keys: DataFrame, pivot: Key | None) -> list[tuple[int, Key, bool]]:
    """(size, median, whether before the pivot) of each partition's keys on either side of it."""
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [[c.to_numpy() for c in b.columns] for b in batches]
        cost, doc, row = (np.concatenate([np.empty(0, np.int64), *(c[k] for c in columns)]) for k in range(3))
        first = np.zeros(len(cost), bool) if pivot is None else (
            (cost < pivot.cost) | (cost == pivot.cost) & ((doc < pivot.doc) | (doc == pivot.doc) & (row < pivot.row)))
        same = np.zeros(len(cost), bool) if pivot is None else (cost == pivot.cost) & (doc == pivot.doc) & (row == pivot.row)
        for side, early in ((first, True), (~first & ~same, False)):
            at = np.flatnonzero(side)
            if len(at):
                at = at[np.lexsort((row[at], doc[at], cost[at]))]
                m = at[(len(at) - 1) // 2]
                yield pa.RecordBatch.from_pydict({"n": [len(at)], "early": [early], "cost": [int(cost[m])],
                                                  "doc": [int(doc[m])], "row": [int(row[m])]})

    found = open_keys.mapInArrow(report, f"n long, early boolean, {KEY}").collect()
    return [(r.n, Key(r.cost, r.doc, r.row), r.early) for r in found]


def weighted_median(medians: list[tuple[int, Key]]) -> Key:
    half, seen = sum(n for n, _ in medians) / 2, 0
    for n, key in sorted(medians, key=lambda x: x[1]):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no key is open")


def cutoff(found: DataFrame, k: int) -> Key:
    """The k-th smallest of the keys (k from 1 to their number), exactly."""
    written, held = found, None  # the keys at hand, and how many they are
    pivot, medians = None, _medians(found, None)
    while True:
        early = [(n, key) for n, key, first in medians if first]
        late = [(n, key) for n, key, first in medians if not first]
        n_early, n_late = sum(n for n, _ in early), sum(n for n, _ in late)
        if pivot is None:
            held = n_late
        elif k <= n_early:
            found, late, n_late = found.where(before(pivot)), early, n_early
        elif k == n_early + 1:
            return pivot
        else:
            found, k = found.where(after(pivot)), k - n_early - 1
        if n_late * REWRITE <= held:
            found, held = cut(found, "open-keys"), n_late
        pivot = weighted_median(late)
        medians = _medians(found, pivot)


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` (with the columns of ``keys``) with their rank, from 1 on."""
    spark = winners.sparkSession
    order = list(Key._fields)
    schema = winners.schema

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            places = pa.array(np.arange(at + 1, at + b.num_rows + 1))
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, places, pa.array(np.full(b.num_rows, part, np.int64))],
                                             [*b.schema.names, "place", "part"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    placed = cut(winners.repartitionByRange(slots(spark), *order).sortWithinPartitions(*order)
                 .mapInArrow(number, f"{fields}, place long, part long"), "winners")
    starts, total = [], 0
    for part, n in sorted(placed.groupBy("part").count().collect()):
        starts.append((part, total))
        total += n
    first = spark.createDataFrame(starts, "part long, first long")
    return placed.join(F.broadcast(first), "part").withColumn("rank", F.col("first") + F.col("place"))


def resample(docs: DataFrame, target: DataFrame, per_cent: int = PER_CENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """Every document's doc_id, n_features, weight, score, and its rank if it is drawn."""
    gain = gains(bucket_counts(docs, buckets, width), bucket_counts(target, buckets, width))
    rows = cut(scored(docs, gain, width, seed).withColumn("row", F.monotonically_increasing_id()), "scored")
    able = rows.where(F.col("n_words") >= least_words)
    k = able.count() * per_cent // 100
    kept = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if not k:
        return rows.select(*kept, unranked)
    last = cutoff(keys(able), k)
    with_keys = rows.select("*", *[c.alias(n) for n, c in zip(("cost", "doc"), (
        -F.col("score"), F.coalesce("doc_id", F.lit(NULL_ID))))])
    drawn = (F.col("n_words") >= least_words) & ~after(last)
    winners = ranked(with_keys.where(drawn).select(*kept, *Key._fields))
    return winners.select(*kept, "rank").unionAll(with_keys.where(~drawn).select(*kept, unranked))


ship_by_value(__name__)
