"""The pipeline: every stage on a small table with planted cases, and the whole run."""

import random

import pytest

import __spark_entry__
import corpus_pipeline as P
from shoplens.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot string"
EN = "the of and to in that it was for with as his on be at by this had not are but from or have an they which".split()
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er".split()


def text(words, n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + rng.choice(["", "", "ing", "en", "er"]) for _ in range(n))


@pytest.fixture(scope="module")
def case(spark, tmp_path_factory):
    rows = [(i, text(EN, 120, i), "en", f"s{i % 3}") for i in range(40)]
    rows += [(40 + i, text(DE, 120, 1000 + i), "de", None) for i in range(40)]
    item = text(EN, 30, 77)
    rows += [(100, rows[3][1], "en", "s1"), (101, rows[3][1] + " again", "en", "s1")]  # copies of 3
    rows += [(110, text(EN, 60, 501) + " " + item + " " + text(EN, 60, 502), "en", "s0")]
    rows += [(120, text(EN, 90, 503) + " token = \"9f86d081884c7d659a2feaa0c55ad015a3bf4f1b\" end", "en", "s0")]
    rows += [(130, None, "en", "s0"), (131, "", "en", "s0"), (132, "12 34 !!", "en", "s0"), (133, "中文", None, "s0")]
    rows += [(None, text(EN, 100, 600), "en", "s2"), (5, rows[5][1], "en", "s2"), (5, text(EN, 130, 601), "en", "s2")]
    rows = [(d, t, lang, s, None if t is None else len(t), "x") for d, t, lang, s in rows]
    sf = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, rows


def ids(df):
    return sorted(str(r.doc_id) for r in df.select("doc_id").collect())


def test_stages_in_order_with_their_effects(spark, case):
    sf, rows = case
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = P.language_id(spark, docs, sf)
    assert kept.columns == docs.columns
    assert ids(kept) == sorted(str(r[0]) for r in rows if r[0] not in (130, 131, 132, 133))
    one = P.simhash_dedup(spark, kept, sf)
    groups = simhash.near_duplicates(kept)
    assert one.columns == docs.columns
    assert one.count() == simhash.grouped(kept).select("component").distinct().count()
    assert {r.component_id for r in groups.collect()} == {r.doc_id for r in one.collect()}
    assert {"100", "101"}.isdisjoint(ids(one)) and "3" in ids(one) and ids(one).count("5") == 2 and "None" in ids(one)
    clean = P.decontamination(spark, one, sf)
    assert clean.columns == docs.columns and set(ids(one)) - set(ids(clean)) == {"110"}
    safe = P.secret_scans(spark, clean, sf)
    assert safe.columns == docs.columns and ids(safe) == ids(clean)
    changed = {r.doc_id: r for r in safe.collect()}[120]
    assert "[REDACTED]" in changed.text and "9f86d0" not in changed.text and changed.n_chars == len(changed.text)
    mixed = P.mix_sources(spark, safe, sf)
    assert ids(mixed) == ids(safe)
    assert sorted(map(str, P.run(spark, sf).collect())) == sorted(map(str, mixed.collect()))


def test_empty_documents_pass_through_every_stage(spark, case):
    sf, _ = case
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in P.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs


def test_every_operator_is_registered(spark):
    names = __spark_entry__.queries()
    assert "pipeline" in names and len(P.STAGES) == 5
    assert set(__spark_entry__.oracle_sql()) <= set(names)


#: Names that the operators use inside, and two that only look odd.
PRIVATE = ["id", "no_id", "text_key", "secret_doc", "bad_id", "score", "lang_pred", "component", "component_id", "row", "words",
           "key", "part", "other_columns", "a.b", "with space"]


@pytest.mark.parametrize("k", range(4))
def test_other_columns_of_any_name_pass_through(spark, case, k):
    sf, _ = case
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stage = P.STAGES[k][1]
    want = sorted((str(r.doc_id), r.text or "") for r in stage(spark, docs.drop("slot"), sf).collect())
    wide = docs.drop("slot").selectExpr("*", *[f"concat('{n}/', doc_id) as `{n}`" for n in PRIVATE])
    out = stage(spark, wide.select("score", "doc_id", *[f"`{n}`" for n in PRIVATE if n != "score"], "text", "lang", "source", "n_chars"), sf)
    rows = out.collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in rows) == want
    assert all(r[n] == (None if r["doc_id"] is None else f"{n}/{r['doc_id']}") for r in rows for n in PRIVATE)
    assert out.columns[:2] == ["score", "doc_id"]
