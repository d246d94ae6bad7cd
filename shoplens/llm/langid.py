"""Language identification by rank-order n-gram profiles (out-of-place distance).

A text is read as lower-case words of letters, each with a blank on both sides; its
profile is its ``PROFILE`` most frequent 1- to 3-grams by count, ties by code
point.  A language's profile comes from the summed counts of all its training
documents.  A document's distance to a language adds up, over the document's
profile, by how many places a gram is off in the language's profile, and
``PROFILE`` for a gram that is not there.  The nearest language wins, ties go to
the smaller name.  The score is 1 - distance / (PROFILE * grams), so 1 means
equal profiles and 0 means nothing in common.

Training counts are summed inside each task and then by (language, gram); only
the cut profiles, PROFILE rows a language, reach the driver.

Defined results: a null text or one without a letter is ``und`` with score 0, and
so is every text if nothing could be learned; rows with null ``lang`` or null
``doc_id`` are never learned from; ``lang``, ``source`` and ``doc_id`` are no
inputs of a prediction; repeated rows count as often as they stand there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import BATCH_ROWS, by_batch, held_out
from shoplens.session import ship_by_value

#: Grams of a profile.
PROFILE = 400
UNKNOWN = "und"
#: Languages that a model may have: with PROFILE it bounds what is broadcast.
MAX_LANGUAGES = 2000
#: Grams that a training task sums up before it hands them on.
HELD_GRAMS = 500_000
BLANK = 32
BITS = 21
_LETTER = np.array([chr(c).isalpha() for c in range(1 << 13)], bool)


def grams(text: str) -> np.ndarray:
    """All 1- to 3-grams of the padded words, packed 21 bits a character."""
    line = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = _LETTER[np.minimum(line, len(_LETTER) - 1)]
    if len(rare := np.flatnonzero(line >= len(_LETTER))):
        letter[rare] = [chr(c).isalpha() for c in line[rare].tolist()]
    line[~letter] = BLANK
    line = np.concatenate(([BLANK], line, [BLANK]))
    blank = line == BLANK
    line = line[~(blank & np.concatenate(([False], blank[:-1])))]  # one blank between words
    if len(line) < 2:
        return np.zeros(0, np.int64)
    two = line[:-1] << BITS | line[1:]
    three = two[:-1] << BITS | line[2:]
    return np.concatenate((line[line != BLANK], two, three[line[1:-1] != BLANK]))


def profile(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent grams in rank order."""
    found, n = np.unique(codes, return_counts=True)
    if len(found) > size:
        least = np.partition(n, len(n) - size)[len(n) - size]
        found, n = found[n >= least], n[n >= least]
    return found[np.argsort(-n, kind="stable")][:size]


def learn(docs: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """lang -> its grams in rank order, from the rows that may be learned from."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (code, n) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(code), pa.string()), pa.array(code), pa.array(n)], names=["lang", "gram", "n"])
            held.clear()

        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                part = whole.slice(at, BATCH_ROWS)
                by_lang: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    by_lang.setdefault(lang, []).append(np.array(np.unique(grams(text), return_counts=True)))
                for lang, each in by_lang.items():
                    each = [*each, np.array(held[lang])] if lang in held else each
                    code, n = np.concatenate(each, axis=1)
                    found, where = np.unique(code, return_inverse=True)
                    total = np.zeros(len(found), np.int64)
                    np.add.at(total, where, n)
                    held[lang] = (found, total)
                if sum(len(c) for c, _ in held.values()) > HELD_GRAMS:
                    yield from out()
        yield from out()

    counted = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counted.withColumn("place", place).where(F.col("place") <= size)
    langs: dict[str, list[tuple[int, int]]] = {}
    for r in top.limit(MAX_LANGUAGES * size + 1).collect():
        langs.setdefault(r.lang, []).append((r.place, r.gram))
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    return {lang: [g for _, g in sorted(langs[lang])] for lang in sorted(langs)}


def predictor(model: dict[str, list[int]], size: int = PROFILE):
    """text -> (language, score), from the profiles as one table of ranks."""
    names = list(model)
    known = np.unique(np.concatenate([np.array(g, np.int64) for g in model.values()] or [np.zeros(0, np.int64)]))
    ranks = np.full((len(known) + 1, len(names)), -1, np.int64)  # the last row: in no profile
    for k, name in enumerate(names):
        ranks[np.searchsorted(known, model[name]), k] = np.arange(len(model[name]))

    def predict(text: str | None) -> tuple[str, float]:
        own = profile(grams(text), size) if text and names else ()
        if not len(own):
            return UNKNOWN, 0.0
        at = np.searchsorted(known, own)
        at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != own)] = len(known)
        theirs = ranks[at]
        off = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(off.argmin())
        return names[best], 1.0 - float(off[best]) / (size * len(own))

    return predict


def identify(docs: DataFrame, model: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """``docs`` with lang_pred and score added behind its own columns (which should
    not have these names); rows are neither moved nor dropped."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns
    text = columns.index("text")
    made: list = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(predictor(sent.value, size))
        found = [made[0](t) for t in batch.column(text).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())],
            names=[*columns, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return by_batch(docs, columns, f"{schema}, lang_pred string, score double", run)


def predictions(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score; learned from the other folds."""
    model = learn(docs, size)
    return identify(docs.select("doc_id", "text"), model, size).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


ship_by_value(__name__)
