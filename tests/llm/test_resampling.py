import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from shoplens.llm import resampling as rs
from shoplens.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string"


def by_hand(docs, target, per_cent=10, least=20, buckets=10_000, width=1):
    def features(text):
        w = WORD.findall((text or "").translate(LOWER))
        return len(w), [" ".join(w[k:k + n]) for n in range(1, width + 1) for k in range(len(w) - n + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    held = [(doc_id, *features(text)) for doc_id, text in docs]
    s = Counter(bucket(f) for _, _, found in held for f in found)
    t = Counter(bucket(f) for _, text in target for f in features(text)[1])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for row, (doc_id, words, found) in enumerate(held):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words, row))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5]))
    rank = {r[5]: k for k, r in enumerate(able[:len(able) * per_cent // 100], 1)}
    return [(*r[:4], rank.get(r[5])) for r in rows]


def key(row):
    return tuple((x is None, str(x)) for x in row)


def check(spark, docs, target, **options):
    frames = [spark.createDataFrame(x, DOCS).coalesce(1) for x in (docs, target)]
    got = sorted((tuple(r) for r in rs.resample(*frames, **{
        {"least": "least_words"}.get(k, k): v for k, v in options.items()}).collect()), key=key)
    assert got == sorted(by_hand(docs, target, **options), key=key)
    return got


def test_whole_tables_equal_the_brute_force_version(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    target = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    target = [(k, text) for k, (_, text) in enumerate(target)]
    assert sum(r[4] is not None for r in check(spark, docs, target)) > 10
    check(spark, docs, target, per_cent=37, least=3, buckets=64, width=3)


def test_nulls_empty_long_texts_and_other_columns(spark):
    long = "alpha beta Gamma " * 20_000
    docs = [(1, None), (None, "a b c"), (2, ""), (3, "--- \x1c ???"), (4, long), (None, "é ü ß 12"), (5, "a b c")]
    check(spark, docs, [(1, "alpha Beta"), (2, None)], per_cent=50, least=1)
    check(spark, docs, [], per_cent=50, least=0)
    wide = spark.createDataFrame([(1, "a b", 5, 6, 7)], f"{DOCS}, rank long, cost long, row long")
    assert len(rs.resample(wide, wide, per_cent=100, least_words=1).collect()) == 1


def test_ties_and_repeated_rows(spark):
    docs = [(7, "a b c d")] * 40 + [(8, "a b c d")] * 3 + [(k, "x y") for k in range(30)]
    for per_cent in (1, 33, 50, 99, 100):
        check(spark, docs, [(1, "a x")], per_cent=per_cent, least=1)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert rs.resample(none, none).collect() == []
    assert [r.rank for r in rs.resample(spark.createDataFrame([(1, "few words")], DOCS), none).collect()] == [None]


def test_cutoff_is_exact_for_every_rank_and_any_layout(spark):
    random.seed(5)
    rows = [(random.choice([0, 0, 0, 1, 5, random.randrange(50)]), random.randrange(4), k) for k in range(300)]
    for parts in (1, 7):
        found = spark.createDataFrame(rows, rs.KEY).repartition(parts, "cost")
        for k in (1, 2, 17, 150, 299, 300):
            assert rs.cutoff(found, k) == sorted(rows)[k - 1]


def test_a_round_discards_a_quarter_at_least():
    random.seed(6)
    parts = [sorted(random.random() ** 3 for _ in range(random.randrange(1, 200))) for _ in range(50)]
    pivot = rs.weighted_median([(len(p), p[(len(p) - 1) // 2]) for p in parts])
    every = np.concatenate([np.array(p) for p in parts])
    assert (every <= pivot).sum() >= len(every) / 4 and (every >= pivot).sum() >= len(every) / 4
