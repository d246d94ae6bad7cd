import math
import re
import zlib
from collections import Counter

import numpy as np

from shoplens.llm import bloom_lm as lm
from shoplens.llm.common import table

DOCS = "doc_id long, text string"
LOWER = {c: c + 32 for c in range(65, 91)}


def quantised(c):
    """The mean count of the step that holds c."""
    if not c:
        return 0.0
    k = max(k for k, s in enumerate(lm.STEPS.tolist()) if s <= c)
    return (lm.STEPS[k] + lm.STEPS[k + 1] - 1) / 2


def by_hand(docs, order=2, prior=lm.PRIOR):
    """The same model over counts in dictionaries (no filter, so no false members)."""
    texts = [[" "] + re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + ["\n"] for _, t in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in docs]
    grams = Counter(tuple(t[k - n:k]) for t, out in zip(texts, held) if not out
                    for n in range(1, order + 1) for k in range(max(n, 2), len(t) + 1))
    words = {g[0]: c for g, c in grams.items() if len(g) == 1}
    n_tokens, n_words = sum(words.values()), len(words)
    grams[(" ",)] = words.get("\n", 0)
    rows = []
    for (doc_id, _), t, out in zip(docs, texts, held):
        base = sum(math.log10((words.get(w, 0) + 1) / (n_tokens + n_words + 1)) for w in t[1:])
        score = 0.0
        for k in range(1, len(t)):
            p = (quantised(words.get(t[k], 0)) + n_words / (n_words + 1)) / (n_tokens + n_words) if n_words else 1.0
            for n in range(2, min(order, k + 1) + 1):
                gram = tuple(t[k - n + 1:k + 1])
                history = quantised(grams[gram[:-1]])
                c = min(quantised(grams[gram]), history, quantised(grams[gram[1:]]))
                p = (c + prior * p) / (history + prior)
            score += math.log10(p)
        known = sum(w in words for w in t[1:])
        rows.append((doc_id, out, len(t) - 1, known, n_tokens, base, score))
    return rows


def same(got, want):
    def key(row):
        return tuple((x is None, str(x)) for x in row[:5]), round(row[5], 6), round(row[6], 6)

    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


#: A filter so wide that no false member shows.
WIDE = {"bits_each": 200, "probes": 12}


def whole(spark):
    return [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]


def test_whole_table_equals_the_dictionary_model(spark):
    rows = whole(spark)
    docs = spark.createDataFrame(rows, DOCS)
    same(lm.scores(docs, **WIDE).collect(), by_hand(rows))
    same(lm.scores(docs, order=3, prior=5.0, **WIDE).collect(), by_hand(rows, 3, 5.0))


def test_parts_of_the_filter_and_words_that_are_joined_change_nothing(spark):
    docs = spark.createDataFrame(whole(spark), DOCS)
    once = lm.scores(docs, order=3).collect()
    for options in ({"max_filter": 20_000}, {"frequent": 0}, {"frequent": 50}):
        same(lm.scores(docs, order=3, **options).collect(), [tuple(r) for r in once])
    assert len(lm.parts(lm.learn(docs, 3), 20_000)) > 1


def test_exact_columns_with_the_production_filter(spark):
    rows = whole(spark)
    got = lm.scores(spark.createDataFrame(rows, DOCS)).collect()
    want = {r[0]: r for r in by_hand(rows)}
    for r in got:
        assert tuple(r)[:5] == want[r.doc_id][:5] and math.isclose(r.base_score, want[r.doc_id][5], rel_tol=1e-9)
    # false members can only raise a count: few, and little
    assert np.mean([abs(r.score - want[r.doc_id][6]) / -r.score for r in got]) < 0.02


def test_held_out_texts_are_likelier_than_by_word_frequency(spark):
    rows = lm.scores(table(spark, "/root/testdata/sf0.01", "documents")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_false_members_are_few():
    rng = np.random.default_rng(1)
    keys = rng.integers(1, 1 << 63, 60_000).astype(np.uint64)
    counts = np.concatenate([np.ones(20_000), rng.integers(1, 5000, 10_000)]).astype(np.int64)
    bits = lm.bloom(keys[:30_000], counts)
    held = lm.Filter(1, lm.PROBES, np.array([0, len(bits)]), np.frombuffer(bits, np.uint8))
    found = held.levels(keys)
    assert (found[:30_000] >= lm.level(counts)).all()  # a count is never read too low
    assert (found[:30_000] > lm.level(counts)).mean() < 0.01 and (found[30_000:] > 0).mean() < 0.01


def test_nulls_empty_long_texts_repeated_rows_and_other_columns(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "A b"), (4, "a b\x1cc"), (5, "É ü é"), (6, "x" * 50_000)]
    rows += [(k, "the same words in the same order") for k in range(40)] + [(7, "a b")] * 30
    docs = spark.createDataFrame([(*r, 1.0, "z") for r in rows], f"{DOCS}, score double, word string")
    same(lm.scores(docs, **WIDE).collect(), by_hand(rows))


def test_long_texts_are_split_as_a_whole(monkeypatch):
    text = b"one two  three\tfour-and-five six" * 20 + b" " + b"y" * 100 + b" "
    whole = lm.Hashes().of(text)
    for block in (1, 7, 64):
        monkeypatch.setattr(lm, "BLOCK", block)
        assert (lm.Hashes().of(text) == whole).all()


def test_empty_table_and_nothing_to_learn_from(spark):
    assert lm.scores(spark.createDataFrame([], DOCS)).collect() == []
    held = [k for k in range(60) if zlib.crc32(str(k).encode()) % 7 == 2][:3]
    rows = [(k, "some words") for k in held]
    same(lm.scores(spark.createDataFrame(rows, DOCS)).collect(), by_hand(rows))
