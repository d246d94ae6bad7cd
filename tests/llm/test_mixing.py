"""Mixing against brute force: targets by repeated resharing, and the schedule's properties."""

import re
from collections import defaultdict

from shoplens.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size string, target string"
ROWS = ([(i, "w " * (i % 37 + 1), "big") for i in range(300)] + [(300 + i, "a\tb\nc", "Mid") for i in range(40)]
        + [(400 + i, "x y", None) for i in range(25)] + [(500, "one two", "tiny"), (501, None, "tiny"), (502, "", "none"),
           (503, " \x0b\r\x0c\x1c ", "tiny"), (None, "no id here", "big"), (None, "no id here", "big"),
           (7, "w " * 8, "big"), (600, "long " * 30_000, "É")])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "t") for r in rows], SCHEMA)


def brute_targets(rows):
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len(re.findall("[^\x20\x09-\x0D]+", text or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(size.values()), set(names), dict.fromkeys(names, 0.0)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * size[s]}
        if not over:
            target.update({s: weight[s] * level for s in open_})
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
        open_ -= over
    return size, target


def test_targets_and_taken(spark):
    for block in (3, 64, M.BLOCK_WORDS):
        out = M.taken(frame(spark, ROWS), block).collect()
        size, target = brute_targets(ROWS)
        assert sorted((str(r.doc_id), r.size) for r in out) == sorted(
            (str(d), len(re.findall("[^\x20\x09-\x0D]+", t or ""))) for d, t, _ in ROWS)
        took = defaultdict(int)
        for r in out:
            took[r.source] += r.taken
            assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6
            assert 0 <= r.taken <= 2 * r.size
        assert all(abs(took[s] - target[s]) <= 0.5 for s in size)


def test_reruns_agree_for_any_partitioning(spark):
    one = sorted(map(str, M.taken(frame(spark, ROWS).repartition(1)).collect()))
    assert one == sorted(map(str, M.taken(frame(spark, ROWS[::-1]).repartition(5)).collect()))


def test_schedule_is_whole_and_even(spark, monkeypatch):
    monkeypatch.setattr(M, "CHUNK", 16)
    block = 5
    rows = M.mix(frame(spark, ROWS[:365]), block).collect()
    words = defaultdict(int)
    for r in rows:
        words[r.slot] += r.n_words
    n = len(words)
    assert sorted(words) == list(range(n)) and max(words.values()) == block
    assert sum(w < block for w in words.values()) <= 3  # the last block of each source
    blocks = {(r.slot, r.source, r.block) for r in rows}
    assert len(blocks) == n
    by = defaultdict(list)
    for slot, source, at in sorted(blocks, key=lambda x: x[0]):
        assert at == len(by[source])  # slots rank blocks in order
        by[source].append(slot)
    for own in by.values():  # low discrepancy: every prefix has its share, within a few slots
        assert all(abs((k + 1) - len(own) * (slot + 1) / n) <= 4 for k, slot in enumerate(own))


def test_places_are_those_of_the_schedule(spark):
    docs = frame(spark, ROWS[:365])
    want = defaultdict(list)
    for r in M.mix(docs, 16).collect():
        want[r.doc_id].append(r.slot)
    rows = M.taken(docs, 16, placed=True).collect()
    assert all((r.first_slot, r.n_pieces) == (min(want[r.doc_id], default=None), len(want[r.doc_id])) for r in rows)
    # the mix of any length: words of the slots so far, by source, stay near the targets
    slots = sorted((r.slot, r.source, r.n_words) for r in M.mix(docs, 16).collect())
    target = {r.source: r.target for r in rows}
    whole, so_far = sum(target.values()), defaultdict(int)
    for slot, source, n in slots:
        so_far[source] += n
        if sum(so_far.values()) % 16 == 0:
            assert all(abs(so_far[s] - t / whole * sum(so_far.values())) <= 4 * 16 for s, t in target.items())


def test_empty_and_wordless_tables(spark):
    df = M.taken(frame(spark, []))
    assert df.columns == ["doc_id", "source", "size", "source_size", "target", "taken"] and df.count() == 0
    assert [(r.size, r.target, r.taken) for r in M.taken(frame(spark, [(1, None, "a"), (2, "", None)])).collect()] == [
        (0, 0.0, 0)] * 2
    assert M.mix(frame(spark, [(1, "", "a")])).count() == 0


def test_multiplication_modulo_n(spark):
    n = (1 << 41) + 11
    k = M._step(n)
    rows = spark.range(n - 50, n).select(M._times(M.F.col("id"), k, n).alias("x"), "id").collect()
    assert all(r.x == r.id * k % n for r in rows)
