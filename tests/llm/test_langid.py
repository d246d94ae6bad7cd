"""Language identification against a brute-force version, and held-out accuracy."""

import zlib
from collections import Counter

from pyspark.sql import functions as F

from shoplens.llm import langid as L

SCHEMA = "doc_id long, text string, lang string, lang_pred string"
SIZE = 30


def all_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = Counter()
    for w in words:
        w = f" {w} "
        for n in (1, 2, 3):
            out.update(w[i:i + n] for i in range(len(w) - n + 1) if w[i:i + n] != " ")
    # the blank between two words belongs to both: bigrams and trigrams never span it
    return out


def order(counter, size):
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))
    return [g for g, _ in sorted(counter.items(), key=lambda x: (-x[1], code(x[0])))][:size]


def brute(rows, size):
    train = {}
    for d, t, lang in rows:
        if d is not None and zlib.crc32(str(d).encode()) % 5 and lang is not None and t is not None:
            train.setdefault(lang, Counter()).update(all_grams(t))
    ranks = {lang: {g: i for i, g in enumerate(order(c, size))} for lang, c in train.items()}
    out = []
    for d, t, _ in rows:
        own = order(all_grams(t or ""), size)
        held = d is None or zlib.crc32(str(d).encode()) % 5 == 0
        if not own or not ranks:
            out.append((str(d), held, "und", 0.0))
            continue
        off = {lang: sum(abs(r[g] - i) if g in r else size for i, g in enumerate(own)) for lang, r in ranks.items()}
        best = min(sorted(off), key=off.get)
        out.append((str(d), held, best, round(1 - off[best] / (size * len(own)), 9)))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.held_out, r.lang_pred, round(r.score, 9)) for r in df.collect())


ROWS = [
    (1, "The cat sat on the mat, and THE dog barked.", "en"), (2, "Le chat est sur la table; où est le chien ?", "fr"),
    (3, "Der Hund schläft auf dem Sofa und träumt.", "de"), (4, "the end of the story", "en"), (6, "la fin de l’été", "fr"),
    (7, None, "en"), (8, "", "fr"), (9, "12 34 -- !!", "de"), (10, "日本語 テキスト and the", None), (None, "der die das", "de"),
    (11, "x", "en"), (12, "und dann kam der Winter", "de"), (12, "und dann kam der Winter", "de"), (13, "𝒳𝒴 ŉ İstanbul", "tr"),
    (14, "the  the\tthe", "en"),
]


def test_matches_brute_force(spark):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA)
    assert got(L.predictions(df, SIZE)) == brute(ROWS, SIZE)


def test_flushing_held_grams_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(L, "HELD_GRAMS", 3)
    df = spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA)
    assert got(L.predictions(df, SIZE)) == brute(ROWS, SIZE)


def test_nothing_to_learn_and_empty_table(spark):
    df = spark.createDataFrame([(1, "some text", None, "x")], SCHEMA)
    assert got(L.predictions(df)) == [("1", False, "und", 0.0)]
    assert L.predictions(df.where("false")).count() == 0


def test_long_text_and_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "the and of " * 50_000, "en", None)], "doc_id long, text string, lang string, `a b` string")
    out = L.identify(df, L.learn(df))
    assert out.columns == ["doc_id", "text", "lang", "a b", "lang_pred", "score"]
    r = out.first()
    assert r.lang_pred == "en" and r.score == 1.0 and len(r.text) == 550_000


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = L.predictions(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.98
