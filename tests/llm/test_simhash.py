"""SimHash near-duplicates against a brute-force version and Spark's own XXH64."""

from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from shoplens.llm import simhash

SCHEMA = "doc_id long, text string, component_id string"


def brute(rows, width=4, max_bits=4):
    fps = [simhash.fingerprint(None if t is None else t.encode(), width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
            root[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d is None, d or 0), f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows))


def got(df):
    return sorted(((r.doc_id is None, r.doc_id or 0), r.fingerprint, r.component_id) for r in df.collect())


def near_copies(n, seed):
    rng = np.random.default_rng(seed)
    vocab = [f"w{k}" for k in range(500)]
    rows, doc = [], 0
    while len(rows) < n:
        base = list(rng.choice(vocab, int(rng.integers(30, 300))))
        for _ in range(int(rng.integers(1, 9))):
            words = list(base)
            for at in rng.integers(0, len(words), int(rng.integers(0, 4))):
                words[at] = str(rng.choice(vocab))
            rows.append((doc, " ".join(words)))
            doc += 1
    return rows[:n]


def test_fingerprint_is_the_majority_of_spark_xxhash64(spark):
    text = "One two\tTHREE\x0bfour Éfive six seven \r\n one two THREE four"
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]).decode() for i in range(len(words) - 3)]
    rows = spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s").alias("h")).collect()
    fp = sum(1 << b for b in range(64) if sum(r.h >> b & 1 for r in rows) * 2 > len(rows))
    assert simhash.fingerprint(text.encode(), 4) == fp
    assert simhash.fingerprint(b" \t\n", 4) == 0 == simhash.fingerprint(None, 4)
    one = spark.createDataFrame([("a b",)], "s string").select(F.xxhash64("s").alias("h")).first().h
    assert simhash.fingerprint(b"A  B", 4) == one % 2**64


def test_long_text_votes_add_up_in_parts():
    words = b" ".join(b"w%d" % (k * k % 7919) for k in range(3 * simhash.VOTE_ROWS + 5))
    whole, simhash.VOTE_ROWS = simhash.VOTE_ROWS, 1000
    try:
        small = simhash.fingerprint(words, 4)
    finally:
        simhash.VOTE_ROWS = whole
    assert small == simhash.fingerprint(words, 4)


def test_matches_brute_force_with_edge_rows(spark):
    rows = near_copies(220, 1) + [(900, None), (901, ""), (902, " "), (903, "one"), (904, "one"), (None, "one"),
                                  (905, "a b c"), (905, "a b c"), (None, "alone text without any copy")]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA)
    assert got(simhash.near_duplicates(df)) == brute(rows)


def test_split_units_lose_no_link(spark):
    rows = near_copies(150, 2)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA)
    assert got(simhash.near_duplicates(df, max_bits=12, unit_rows=3)) == brute(rows, max_bits=12)


def test_trie_pairs_equal_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 20, dtype=np.uint64)
    flips = rng.integers(0, 64, (400, 3))
    fps = base[rng.integers(0, 20, 400)]
    for k in range(3):
        fps = fps ^ (np.uint64(1) << flips[:, k].astype(np.uint64))
    fps = np.unique(fps)
    units = np.zeros(len(fps), np.int64)
    want = {(i, j) for i, j in combinations(range(len(fps)), 2) if bin(int(fps[i] ^ fps[j])).count("1") <= 4}
    for frontier in (simhash.FRONTIER, 7):
        whole, simhash.FRONTIER = simhash.FRONTIER, frontier
        try:
            pairs = [(int(a), int(b)) for x, y in simhash.trie_links(units, fps, 4) for a, b in zip(x, y)]
        finally:
            simhash.FRONTIER = whole
        assert len(pairs) == len(set(pairs)) and {tuple(sorted(p)) for p in pairs} == want


def test_empty_table(spark):
    df = simhash.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert df.columns == ["doc_id", "fingerprint", "component_id"] and df.count() == 0
