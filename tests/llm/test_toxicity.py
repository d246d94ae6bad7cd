"""Toxicity: held-out accuracy, the counterfactual term, and edge rows."""

import math
import random

from shoplens.llm import toxicity as T

DOCS = "doc_id long, text string, lang string, toxic int, score string"
LABELS = "doc_id long, toxic int, text string"
NEUTRAL = "the weather was fine and people went to town for bread and news about their garden".split()


def sentences(n, seed, share_bad=0.8, share_group=0.7):
    """Toxic texts name a group more often than others do, and most use an insult."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        toxic = rng.random() < 0.4
        t = [rng.choice(NEUTRAL) for _ in range(12)]
        if rng.random() < (share_group if toxic else 0.2):
            t.append(rng.choice(["muslim", "jewish"]))
        if toxic and rng.random() < share_bad:
            t.append(rng.choice(["vermin", "filthy", "scumbags"]))
        rng.shuffle(t)
        out.append((" ".join(t), int(toxic)))
    return out


def model(spark, strength, rows):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    return T.learn(docs, labels, strength=strength)


def logit(m, text):
    return m[0] + sum(m[1].get(x, 0.0) for x in T.features(T.words(text)))


def test_swapping_identity_terms_changes_less_with_the_penalty(spark):
    rows = sentences(1500, 1)
    free, tied = model(spark, 0.0, rows), model(spark, 20.0, rows)
    gap = lambda m: abs(logit(m, "a muslim family went to town") - logit(m, "a hindu family went to town"))
    assert gap(free) > 0.5 and gap(tied) < 0.4 * gap(free)
    assert logit(tied, "filthy vermin in town") > 0 > logit(tied, "the jewish garden")


def test_swaps_stay_in_their_kind():
    got = T.swaps({"a", "women", "black"})
    assert {"a", "men", "black"} in got and {"a", "women", "asian"} in got
    assert len(got) == len(T.IDENTITY_TERMS[0]) - 1 + len(T.IDENTITY_TERMS[5]) - 1
    assert T.swaps({"a", "b"}) == []


def test_features_mark_shared_beginnings():
    assert T.features({"abcdefx", "abcdey"}) == {"abcdefx", "abcdey", "abcde*", "abcde**", "abcdef*"}


def test_scores_and_edge_rows(spark):
    rows = sentences(400, 2, share_bad=1.0)
    docs = [(i, t, None, 1 - y, "x") for i, (t, y) in enumerate(rows)]
    docs += [(1000, None, "en", 1, "x"), (1001, "", "en", 1, "x"), (1002, "!! 12", "en", 1, "x"), (None, "vermin " * 3, "en", 0, "x"),
             (3, rows[3][0], "en", 0, "x"), (1003, "bread " * 200_000 + "vermin", "en", 0, "x")]
    labels = [(i, y, "clash") for i, (_, y) in enumerate(rows)] + [(None, 1, "c"), (7, None, "c"), (9, 1 - rows[9][1], "c")]
    out = T.scores(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    truth = dict(enumerate(y for _, y in rows))
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) >= 0.95
    by = {r.doc_id: r for r in out}
    assert by[1000].score == by[1001].score == by[1002].score < 0.5 and by[None].held_out and by[None].predicted == 1
    assert by[1003].predicted == 1
    again = T.scores(spark.createDataFrame(docs[::-1], DOCS).repartition(3), spark.createDataFrame(labels, LABELS)).collect()
    assert all(math.isclose(r.score, by[r.doc_id].score, rel_tol=1e-9) for r in again)


def test_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "some text", "en", 0, "x")], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert [(r.score < 1e-9, r.predicted) for r in T.scores(docs, none).collect()] == [(True, 0)]
    assert T.scores(docs.where("false"), none).count() == 0


def test_held_out_accuracy_on_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = T.scores(spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi"), labels)
    rows = out.where("held_out").join(labels, "doc_id").collect()
    caught = [r.predicted for r in rows if r.toxic]
    flagged = [r.predicted for r in rows if not r.toxic]
    assert sum(caught) / len(caught) >= 0.8 and sum(flagged) / len(flagged) <= 0.01
