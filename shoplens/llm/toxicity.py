"""Toxicity scores from a counterfactually regularised classifier.

A logistic model over the words of a text and over the beginnings that several of
its words share (inflected and compounded words).  For every labelled text that
names a group, each identity term is swapped for the other terms of its kind;
the squared change of the score's logit over these pairs is added to the loss, so
the model can't use the mention of a group itself as evidence.

Only fitting is bounded: it sees at most ``FIT_ROWS`` labelled rows (the first by a
hash of doc_id) of the folds that may be learned from; the number of toxic and other
labels is counted over all of them.  What is broadcast is the weights, at most
``MAX_FEATURES`` and the identity terms.  Every text is scored whole.

Defined results: a null or wordless text gets the score of the base rate; without
labels of both kinds every text scores next to 0, or to 1 if all labels are toxic; a doc_id with
several labels counts as toxic if one says so; rows without doc_id are scored but
never learned from; ``lang``, ``source`` and ``doc_id`` are no inputs.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import by_batch, cut, held_out
from shoplens.session import ship_by_value

FIT_ROWS = 8000
#: Features of the model: those of at least LEAST_TEXTS fitted texts whose share differs
#: between the kinds by LEAST_Z standard errors, the farthest first.
MAX_FEATURES = 20_000
LEAST_TEXTS, LEAST_Z = 4, 3.0
#: Letters of a shared beginning, and how many different words must share it for each mark.
BEGINNINGS, SHARED = (5, 6, 7), (1, 2, 4)
STEPS, RATE = 300, 0.3
L1, L2 = 2e-4, 1e-4
COUNTERFACTUAL = 1.0

# Identity terms by kind; a swap stays inside its kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual", "homosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "catholics", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("deaf", "blind", "disabled", "autistic", "elderly", "young"),
)

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features(found: set[str]) -> set[str]:
    """The words, and ``abcde*`` (``**``, ``***``) for a beginning of 1 (2, 4) or more longer words."""
    starts = Counter(w[:n] for w in found for n in BEGINNINGS if len(w) > n)
    return found | {p + "*" * k for p, c in starts.items() for k, least in enumerate(SHARED, 1) if c >= least}


def swaps(found: set[str], kinds=IDENTITY_TERMS) -> list[set[str]]:
    """The word sets of a text's counterfactuals: one identity term swapped for another of its kind."""
    return [found - {a} | {b} for kind in kinds for a in kind if a in found for b in kind if b not in found]


SAMPLE = ("toxic int, features array<string>, "
          "swaps array<struct<lost: array<string>, gained: array<string>>>")


def fit(rows: list[np.ndarray], pairs: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, size: int,
        rate: float, strength: float = COUNTERFACTUAL) -> tuple[float, np.ndarray]:
    """(intercept, weights) by adaptive gradient steps with soft thresholding.  ``rows``: each
    text's feature numbers; ``pairs``: the features that a swap loses and gains; ``rate``: the
    share of toxic labels, which the intercept is set to in the end."""
    y, n = np.asarray(toxic, float), len(rows)
    row = np.repeat(np.arange(n), [len(x) for x in rows])
    col = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    sides = [(k, side, sign) for k, pair in enumerate(pairs) for side, sign in zip(pair, (1.0, -1.0))]
    p_row = np.repeat([k for k, _, _ in sides], [len(x) for _, x, _ in sides]).astype(np.int64)
    p_col = np.concatenate([*(x for _, x, _ in sides), np.zeros(0, np.int64)]).astype(np.int64)
    p_sign = np.repeat([s for _, _, s in sides], [len(x) for _, x, _ in sides])
    own = y.mean()
    weight = np.where(y > 0, 0.5 / own, 0.5 / (1 - own)) / n  # both kinds count alike while the words are learned
    w, b = np.zeros(size), 0.0
    seen_w, seen_b = np.full(size, 1e-8), 1e-8
    for _ in range(STEPS):
        z = b + np.bincount(row, w[col], n)
        off = weight * (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y)
        g = np.bincount(col, off[row], size) + L2 * w
        if len(pairs):
            change = np.bincount(p_row, p_sign * w[p_col], len(pairs))
            g += strength * 2 / len(pairs) * np.bincount(p_col, p_sign * change[p_row], size)
        gb = off.sum()
        seen_w += g * g
        seen_b += gb * gb
        step = RATE / np.sqrt(seen_w)
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * L1, 0)
        b -= RATE / math.sqrt(seen_b) * gb
    return b + math.log(rate / (1 - rate)), w  # from equal kinds to the true share


def _sample(docs: DataFrame, known: DataFrame, kinds) -> DataFrame:
    """The fitted rows' features, and what each counterfactual of them loses and gains."""
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # FIT_ROWS rows at most

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, changed = [], []
        for text in batch.column(0).to_pylist():
            own = words(text)
            f = features(own)
            other = [features(x) for x in swaps(own, kinds)]
            found.append(sorted(f))
            changed.append([{"lost": sorted(f - o), "gained": sorted(o - f)} for o in other])
        side = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(found, side), pa.array(changed, pa.list_(pa.struct([("lost", side), ("gained", side)])))],
            names=["toxic", "features", "swaps"])

    return cut(by_batch(rows.select("text", F.col("toxic").cast("int").alias("toxic")), ["text", "toxic"], SAMPLE, run),
               "toxic-sample")


def _chosen(sample: DataFrame, kinds) -> list[str]:
    """The features that the kinds differ in, farthest first, and the identity terms that occur."""
    whole = sample.agg(F.count("*").alias("n"), F.avg("toxic").alias("share")).first()
    counts = sample.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("hits"))
    spread = F.col("n") * whole.share * (1 - whole.share) * (1 - F.col("n") / (whole.n + 1))
    z = F.abs(F.col("hits") - F.col("n") * whole.share) / F.sqrt(spread)
    far = counts.where((F.col("n") >= LEAST_TEXTS) & (z >= LEAST_Z)).orderBy(z.desc(), "feature").limit(MAX_FEATURES)
    terms = [w for kind in kinds for w in kind]
    named = counts.where(F.col("feature").isin(terms)).select("feature")
    found = [r.feature for r in far.select("feature").collect()]
    return found + sorted({r.feature for r in named.collect()} - set(found))


def learn(docs: DataFrame, labels: DataFrame, kinds=IDENTITY_TERMS,
          strength: float = COUNTERFACTUAL) -> tuple[float, dict[str, float]]:
    """(intercept, feature weights) from (doc_id, toxic) labels of the folds that may be
    learned from.  The driver gets the chosen features and, per fitted row, the numbers of
    those that it has."""
    known = labels.where(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = cut(known, "toxic-labels")
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    many, all_rows = counts.get(1, 0), sum(counts.values())
    if not many or many == all_rows:
        return (35.0 if many else -35.0), {}
    rate = many / all_rows
    sample = _sample(docs, known, kinds)
    if sample.select("toxic").distinct().count() < 2:
        return math.log(rate / (1 - rate)), {}
    chosen = _chosen(sample, kinds)
    sent = docs.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(chosen)})

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = sent.value
        of = lambda x: sorted(place[w] for w in x if w in place)
        rows = [of(x) for x in batch.column(1).to_pylist()]
        pairs = [[{"lost": of(p["lost"]), "gained": of(p["gained"])} for p in x] for x in batch.column(2).to_pylist()]
        side = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows, side), pa.array(pairs, pa.list_(pa.struct([("lost", side), ("gained", side)])))],
            names=["toxic", "features", "swaps"])

    coded = by_batch(sample, ["toxic", "features", "swaps"], SAMPLE.replace("string", "int"), run)
    got = sorted((r.toxic, r.features, [(p.lost, p.gained) for p in r.swaps]) for r in coded.collect())
    b, w = fit([np.array(f, np.int64) for _, f, _ in got],
               [(np.array(x, np.int64), np.array(y, np.int64)) for _, _, p in got for x, y in p],
               np.array([t for t, _, _ in got]), len(chosen), rate, strength)
    return b, {x: float(v) for x, v in zip(chosen, w) if v}


def scores(docs: DataFrame, labels: DataFrame, kinds=IDENTITY_TERMS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, kinds))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        b, w = sent.value

        def score(text: str | None) -> float:
            z = b + sum(w[x] for x in sorted(features(words(text)) & w.keys()))
            return 1 / (1 + math.exp(-max(-35.0, min(35.0, z))))

        found = [score(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    scored = by_batch(docs, ["doc_id", "text"], "doc_id long, score double", run)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


ship_by_value(__name__)
