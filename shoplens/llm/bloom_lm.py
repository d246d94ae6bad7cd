"""Language-model scores from a log-frequency Bloom filter.

The n-grams of the training texts (orders 1 to ``order``) are counted in Spark and put
in a Bloom filter with their quantised counts: an n-gram of level q, the number of steps
1, 1.5, 1.5^2, ... that its count reaches, is a member q times, as (n-gram, 1) to (n-gram, q).
A count is read by asking for (n-gram, 1), (n-gram, 2), ... until one is missing; the mean
count of the last level found stands for it.  No n-gram is stored, and none is left out.

The probability of a token is smoothed by that of the next shorter history (a Dirichlet
prior of weight ``prior``), down to word frequency and an equal share for unseen words:

    p(w | h) = (c(h w) + prior * p(w | shorter h)) / (c(h) + prior)

Counting: a task reduces its tokens to distinct n-gram hashes and counts, packed by
bucket of the hash; a bucket is merged and becomes a Bloom filter of its own, sized by
what it holds, so the whole grows with the corpus and no key gathers anywhere.  The
filters of all buckets together are broadcast.  Their size is checked: beyond
``max_filter`` bytes, they go out in parts of at most that size, one pass over the texts
each; a pass writes the levels that it finds, and the levels of all passes are
added up before the probabilities are taken.  Scores are the same either way.

The base score needs exact counts.  Words of the highest counts (FREQUENT at most) are
broadcast with them; the other words of a document are joined with the table of counts.
A word is known by 64 bits of its hash: among V distinct words, the chance of any two
sharing one is V^2 / 2^65.

Defined results: a null or empty text is one token, its end; a null doc_id counts as the
empty id in the fold; rows with equal doc_id are documents of their own; where
nothing may be learned from, all counts are 0; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import cut, slots, utf8
from shoplens.session import ship_by_value

#: Fixed values of the split: documents of this remainder are only scored.
FOLDS, HELD_OUT = 7, 2
ORDER = 2
PRIOR = 64.0
#: Ratio of two steps of the quantised counts.
STEP = 1.5
#: Bits of the filter for each member, and bits set by one.
BITS, PROBES = 12, 5
MAX_FILTER = 256 << 20
FREQUENT = 1 << 17
#: Tokens that a task counts and scores in one step, hashes that it remembers, bytes that it splits at once.
COUNTED, SCORED = 1 << 20, 1 << 18
REMEMBERED = 1 << 20
BLOCK = 1 << 22

START, END = (np.uint64(xxhash.xxh64_intdigest(mark)) for mark in (b" start", b" end"))  # no word holds a space
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
HIGH, LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


def _steps() -> np.ndarray:
    """The least count of each level, from 1 on."""
    found, at = [1], 1.0
    while found[-1] < 1 << 62:
        at *= STEP
        if math.ceil(at) > found[-1]:
            found.append(math.ceil(at))
    return np.array(found[:-1], np.int64)


STEPS = _steps()
#: The count that a level stands for: the mean of those that it covers; level 0 is none.
MEANS = np.concatenate([[0.0], (STEPS[:-1] + STEPS[1:] - 1) / 2, STEPS[-1:]])


def level(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(STEPS, counts, side="right").astype(np.uint8)


def mix(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(30))) * MIX[1]
    keys = (keys ^ (keys >> np.uint64(27))) * MIX[2]
    return keys ^ (keys >> np.uint64(31))


# ---- tokens ------------------------------------------------------------------------


class Hashes(dict):
    """word -> 64 bits of its hash; what a task remembers is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def of(self, text: bytes | None) -> np.ndarray:
        """START, the words of the text, END.  A long text is split part by part."""
        found, at, text = [[START]], 0, text or b""
        while at < len(text):
            until = min(at + BLOCK, len(text))
            part = text[at:until]
            if until < len(text):  # up to the last white space; a longer word is taken whole
                space = max(part.rfind(c) for c in b" \t\n\v\f\r")
                if space < 0:
                    following = [k for k in (text.find(c, until) for c in b" \t\n\v\f\r") if k >= 0]
                    space = min(following, default=len(text)) - at
                until = at + space
                part = text[at:until]
            words = part.lower().split()
            found.append(np.fromiter(map(self.__getitem__, words), np.uint64, len(words)))
            at = max(until, at + 1)
        return np.concatenate([*found, [END]]).astype(np.uint64)


class Chunk(NamedTuple):
    """Tokens of some documents, one after the other."""

    rows: list          # what the caller knows the documents by
    starts: np.ndarray  # where each begins
    place: np.ndarray   # of each token in its document; START is at 0
    tokens: np.ndarray

    def grams(self, order: int) -> Iterator[np.ndarray]:
        """Of orders 1 to ``order``: the key of the n-gram that ends at each token, 0 where
        it would begin before the document."""
        keys = self.tokens
        yield keys
        for n in range(2, order + 1):
            keys = mix(np.concatenate([[np.uint64(0)], keys[:-1]]) * MIX[0] + self.tokens + np.uint64(n))
            keys[self.place < n - 1] = 0
            yield keys


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Chunk]:
    """Documents (last column: the text) in groups of about ``size`` tokens."""
    hashes = Hashes()

    def chunk() -> Chunk:
        sizes = np.array([len(t) for t in tokens])
        starts = np.cumsum(sizes) - sizes
        place = np.arange(sizes.sum()) - np.repeat(starts, sizes)
        return Chunk(rows, starts, place, np.concatenate(tokens))

    rows, tokens, held = [], [], 0
    for batch in batches:
        known = list(zip(*(c.to_pylist() for c in batch.columns[:-1]))) or [()] * batch.num_rows
        for row, text in zip(known, utf8(batch.columns[-1])):
            rows.append(row)
            tokens.append(hashes.of(text))
            held += len(tokens[-1])
            if held >= size:
                yield chunk()
                rows, tokens, held = [], [], 0
    if rows:
        yield chunk()


# ---- counts and filter ---------------------------------------------------------------


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the keys (hashes, so of even size): sorted keys ask one after the other."""
    return ((keys >> HIGH) * np.uint64(buckets) >> HIGH).astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def halves(keys: np.ndarray, member: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of (key, member), of which its bits are made."""
    h = mix(keys + np.array([member], np.uint64) * MIX[0])
    return h & LOW, (h >> HIGH) | np.uint64(1)


def position(a: np.ndarray, b: np.ndarray, probe: int, bits: np.ndarray | int) -> np.ndarray:
    """The bit of one probe in a filter of so many bits (below 2^32)."""
    return (((a + np.uint64(probe) * b) & LOW) * np.asarray(bits, np.uint64) >> HIGH).astype(np.int64)


def bloom(keys: np.ndarray, counts: np.ndarray, bits_each: int = BITS, probes: int = PROBES) -> bytes:
    """The filter of some n-grams, with ``bits_each`` bits for each membership."""
    levels = level(counts)
    bits = 8 * max(1, -(-int(levels.sum(dtype=np.int64)) * bits_each // 8))
    held = np.zeros(bits, bool)
    for member in range(1, int(levels.max(initial=0)) + 1):
        a, b = halves(keys[levels >= member], member)
        for probe in range(probes):
            held[position(a, b, probe, bits)] = True
    return np.packbits(held).tobytes()


FILTER = "bucket long, bits binary, words binary, counts binary, n_words long, n_tokens long"


def learn(docs: DataFrame, order: int = ORDER, bits_each: int = BITS, probes: int = PROBES) -> DataFrame:
    """One row for each bucket: its filter, and its words with their exact counts (packed)."""
    buckets = 4 * slots(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, COUNTED):
            word, *longer = chunk.grams(order)
            token = chunk.place > 0
            parts = [_summed(word[token]), _summed(np.concatenate([np.empty(0, np.uint64), *(
                g[chunk.place >= n] for n, g in enumerate(longer, 1))]))]
            blobs = []
            for keys, n in parts:
                at = bucket_of(keys, buckets)
                by = np.argsort(at, kind="stable")
                ends = np.searchsorted(at[by], np.arange(1, buckets))
                blobs += [[x.tobytes() for x in np.split(a[by], ends)] for a in (keys, n.astype(np.int64))]
            rows = [k for k in range(buckets) if blobs[0][k] or blobs[2][k]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), *(pa.array([b[k] for k in rows], pa.binary()) for b in blobs)],
                ["bucket", "words", "counts", "grams", "gram_counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged() -> pa.RecordBatch:
            words, counts, grams, gram_counts = (
                np.concatenate([np.frombuffer(x, kind) for x in column]) for column, kind in zip(
                    zip(*held), (np.uint64, np.int64, np.uint64, np.int64)))
            words, counts = _summed(words, counts)
            grams, gram_counts = _summed(grams, gram_counts)
            bits = bloom(np.concatenate([words, grams]), np.concatenate([counts, gram_counts]), bits_each, probes)
            return pa.RecordBatch.from_pydict({
                "bucket": [at], "bits": [bits], "words": [words.tobytes()], "counts": [counts.tobytes()],
                "n_words": [len(words)], "n_tokens": [int(counts.sum())]})

        at, held = None, []
        for batch in batches:
            for bucket, *blobs in zip(*(c.to_pylist() for c in batch.columns)):
                if held and bucket != at:
                    yield merged()
                    held = []
                at = bucket
                held.append(blobs)
        if held:
            yield merged()

    packed = docs.select("text").mapInArrow(count, "bucket long, words binary, counts binary, grams binary, gram_counts binary")
    return cut(packed.repartition(slots(docs.sparkSession), "bucket").sortWithinPartitions("bucket")
               .mapInArrow(merge, FILTER), "bloom")


class Filter(NamedTuple):
    """Filters of some consecutive buckets."""

    buckets: int
    probes: int
    starts: np.ndarray  # byte at which the filter of each bucket begins; as long as the one before: not held
    bits: np.ndarray

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key by repeated membership probes; 0 for key 0 and for buckets not held."""
        found = np.zeros(len(keys), np.uint8)
        at = bucket_of(keys, self.buckets)
        left = np.flatnonzero((self.starts[at + 1] > self.starts[at]) & (keys != 0))
        first = self.starts[at[left]]
        bits = (8 * (self.starts[at[left] + 1] - first)).astype(np.uint64)
        keys = keys[left]
        for member in range(1, len(STEPS) + 1):
            a, b = halves(keys, member)
            hit = np.flatnonzero(self.is_set(first, position(a, b, 0, bits)))  # most that are missing go here
            a, b, first, bits, keys, left = (x[hit] for x in (a, b, first, bits, keys, left))
            held = np.ones(len(left), np.uint8)
            for probe in range(1, self.probes):
                held &= self.is_set(first, position(a, b, probe, bits))
            hit = np.flatnonzero(held)
            if not len(hit):
                break
            if len(hit) < len(left):
                first, bits, keys, left = (x[hit] for x in (first, bits, keys, left))
            found[left] = member
        return found

    def is_set(self, first: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.bits[first + (place >> 3)] >> (7 - (place & 7)).astype(np.uint8) & np.uint8(1)


def parts(model: DataFrame, max_filter: int) -> list[list[int]]:
    """The buckets in runs of at most ``max_filter`` bytes (a single larger one is a run)."""
    runs, held = [[]], 0
    for bucket, size in model.select("bucket", F.length("bits")).orderBy("bucket").collect():
        if runs[-1] and held + size > max_filter:
            runs.append([])
            held = 0
        runs[-1].append(bucket)
        held += size
    return runs


def sent(model: DataFrame, run: list[int], buckets: int, probes: int) -> Broadcast:
    sizes, held = np.zeros(buckets, np.int64), {}
    if run:
        for r in model.where(F.col("bucket").between(run[0], run[-1])).select("bucket", "bits").toLocalIterator():
            sizes[r.bucket], held[r.bucket] = len(r.bits), r.bits
    bits = np.frombuffer(b"".join(held[b] for b in sorted(held)), np.uint8)
    return model.sparkSession.sparkContext.broadcast(Filter(buckets, probes, np.concatenate([[0], np.cumsum(sizes)]), bits))


# ---- words of exact count --------------------------------------------------------------


def word_counts(model: DataFrame) -> DataFrame:
    """word (64 bits of its hash), c: the exact count of every training word."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(x, np.int64)) for x in (words, counts)], ["word", "c"])

    return model.select("words", "counts").mapInArrow(unpack, "word long, c long")


def frequent_words(words: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of the highest counts with these, sorted by word: all of a power of two and
    above, the least for which they are at most ``most``."""
    sizes = {p: n for p, n in words.groupBy(F.floor(F.log2("c")).alias("p")).count().collect()}
    least, held = 63, 0
    for p in sorted(sizes, reverse=True):
        held += sizes[p]
        if held > most:
            break
        least = p
    found = sorted((r.word, r.c) for r in words.where(F.floor(F.log2("c")) >= least).collect())
    both = np.array(found, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


# ---- scores ----------------------------------------------------------------------------


def log_probabilities(levels: list[np.ndarray], place: np.ndarray, n_tokens: int, n_words: int,
                      prior: float) -> np.ndarray:
    """log10 of the smoothed probability of each token, 0 at START."""
    shorter = MEANS[levels[0]]
    p = (shorter + n_words / (n_words + 1)) / (n_tokens + n_words) if n_words else np.ones(len(place))
    for n, found in enumerate(levels[1:], 1):
        history = np.concatenate([[0.0], shorter[:-1]])
        longer = np.minimum(MEANS[found], np.minimum(history, shorter))  # no n-gram outnumbers its parts
        p = np.where(place >= n, (longer + prior * p) / (history + prior), p)
        shorter = MEANS[found]
    return np.where(place > 0, np.log10(p), 0.0)


def gram_levels(chunk: Chunk, order: int, held: Filter) -> list[np.ndarray]:
    """By order, the level of the n-gram that ends at each token; at START that of END, of
    which there are as many."""
    found = []
    for n, keys in enumerate(chunk.grams(order), 1):
        if n == 1:
            keys = np.where(chunk.place > 0, keys, END)
        unique, where = np.unique(keys, return_inverse=True)
        found.append(held.levels(unique)[where])
    return found


def _lists(values: np.ndarray, doc: np.ndarray, docs: int) -> pa.Array:
    """``values`` (sorted by their document) as one list for each document."""
    offsets = np.searchsorted(doc, np.arange(docs + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _exact(chunk: Chunk, words: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
    """Of each document: tokens, the known ones among the frequent words, the sum of log10(c + 1)
    over these, and its other words with their numbers."""
    docs = len(chunk.starts)
    unique, where = np.unique(chunk.tokens.view(np.int64), return_inverse=True)
    at = np.minimum(np.searchsorted(words, unique), max(len(words) - 1, 0))
    is_frequent = words[at] == unique if len(words) else np.zeros(len(unique), bool)
    c = np.where(is_frequent, counts[at], 0) if len(words) else np.zeros(len(unique), np.int64)
    token = chunk.place > 0
    known = np.add.reduceat((token & (c > 0)[where]).astype(np.int64), chunk.starts)
    logs = np.add.reduceat(np.where(token, np.log10(c + 1.0)[where], 0.0), chunk.starts)
    sizes = np.diff(np.append(chunk.starts, len(token))) - 1
    rest = np.flatnonzero(token & ~is_frequent[where])
    doc = np.searchsorted(chunk.starts, rest, side="right") - 1
    word = where[rest]
    by = np.lexsort((word, doc))
    doc, word = doc[by], word[by]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])])) if len(by) else by
    times = np.diff(np.append(first, len(by)))
    return [pa.array(sizes), pa.array(known), pa.array(logs),
            _lists(unique[word[first]], doc[first], docs), _lists(times, doc[first], docs)]


EXACT = "n_tokens long, known long, logs double, rest array<long>, times array<long>"


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def _passes(docs: DataFrame, model: DataFrame, order: int, prior: float, max_filter: int, probes: int,
            totals: tuple[int, int], frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """row, doc_id, the columns of EXACT and score of every document."""
    spark = docs.sparkSession
    buckets = 4 * slots(spark)
    exact = spark.sparkContext.broadcast(frequent)
    runs = parts(model, max_filter)

    def scores(levels: list[np.ndarray], chunk: Chunk) -> pa.Array:
        return pa.array(np.add.reduceat(log_probabilities(levels, chunk.place, *totals, prior), chunk.starts))

    if len(runs) == 1:
        whole = sent(model, runs[0], buckets, probes)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk in chunks(batches, SCORED):
                row, doc_id = (pa.array(x, pa.int64()) for x in zip(*chunk.rows))
                found = scores(gram_levels(chunk, order, whole.value), chunk)
                yield pa.RecordBatch.from_arrays([row, doc_id, *_exact(chunk, *exact.value), found],
                                                 ["row", "doc_id", *NAMES, "score"])

        return cut(docs.mapInArrow(score, f"row long, doc_id long, {EXACT}, score double"), "scores")

    docs = cut(docs, "numbered")  # every pass must know a document by the same number
    found = []
    for run in runs:
        part = sent(model, run, buckets, probes)

        def levels(batches: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
            for chunk in chunks(batches, SCORED):
                row = pa.array([r[0] for r in chunk.rows], pa.int64())
                ends = np.append(chunk.starts[1:], len(chunk.place))
                all_levels = np.stack(gram_levels(chunk, order, part.value))
                yield pa.RecordBatch.from_arrays(
                    [row, pa.array([all_levels[:, a:b].tobytes() for a, b in zip(chunk.starts, ends)], pa.binary())],
                    ["row", "levels"])

        found.append(cut(docs.mapInArrow(levels, "row long, levels binary"), "levels"))
        part.destroy()

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for of_passes in batch.column(1).to_pylist():
                all_levels = sum(np.frombuffer(x, np.uint8).reshape(order, -1) for x in of_passes)
                place = np.arange(all_levels.shape[1])
                sums.append(log_probabilities(list(all_levels), place, *totals, prior).sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.float64())], ["row", "score"])

    def exactly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, SCORED):
            row, doc_id = (pa.array(x, pa.int64()) for x in zip(*chunk.rows))
            yield pa.RecordBatch.from_arrays([row, doc_id, *_exact(chunk, *exact.value)], ["row", "doc_id", *NAMES])

    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    scored = every.groupBy("row").agg(F.collect_list("levels").alias("levels")).mapInArrow(combine, "row long, score double")
    return cut(docs.mapInArrow(exactly, f"row long, doc_id long, {EXACT}").join(scored, "row"), "scores")


NAMES = ["n_tokens", "known", "logs", "rest", "times"]


def scores(docs: DataFrame, order: int = ORDER, prior: float = PRIOR, max_filter: int = MAX_FILTER,
           frequent: int = FREQUENT, bits_each: int = BITS, probes: int = PROBES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = learn(docs.where(fold() != HELD_OUT), order, bits_each, probes)
    sums = model.agg(F.sum("n_tokens"), F.sum("n_words")).first()
    n_tokens, n_words = (int(x or 0) for x in sums)
    words = word_counts(model)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = _passes(numbered, model, order, prior, max_filter, probes, (n_tokens, n_words), frequent_words(words, frequent))

    rest = found.select("row", F.inline(F.arrays_zip("rest", "times"))).withColumnRenamed("rest", "word")
    of_rest = (rest.join(words, "word").groupBy("row")
               .agg(F.sum("times").alias("rest_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("rest_logs")))
    whole = found.drop("rest", "times").join(of_rest, "row", "left")
    logs = F.col("logs") + F.coalesce("rest_logs", F.lit(0.0))
    return whole.select(
        "doc_id", (fold() == HELD_OUT).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(math.log10(n_tokens + n_words + 1))).alias("base_score"), "score")


ship_by_value(__name__)
