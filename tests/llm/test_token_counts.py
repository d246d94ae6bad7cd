"""Token counts against greedy cutting by trial and against a public word-piece coder."""

import os
import random

import pytest

from shoplens.llm import token_counts as T

SCHEMA = "doc_id long, text string, n_words string"


def greedy(word, pieces):
    rest, n = T.START + word, 0
    while rest:
        k = next((k for k in range(len(rest), 0, -1) if rest[:k] in pieces), 0)
        if not k:
            return -1
        rest, n = rest[k:], n + 1
    return n


def test_automaton_equals_greedy_cutting():
    rng = random.Random(1)
    for _ in range(150):
        pieces = {rng.choice([T.START, ""]) + "".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 25))}
        if rng.random() < 0.5:
            pieces |= {T.START, "a", "b", "c"}
        tables = T.Automaton(sorted(pieces)).tables()
        for _ in range(60):
            word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(0, 14)))
            assert T.count(tables, T.START + word) == greedy(word, pieces), (word, pieces)


def brute(rows, pieces):
    out = []
    for d, text in rows:
        counts = [greedy(w.decode(), pieces) for w in (text or "").encode().split()]
        out.append((str(d), len(counts), sum(max(c, 1) if c != 0 else 0 for c in counts), counts.count(-1)))
    return sorted(out)


ROWS = [(1, "low lower lowest\tnewer\x0bwidest"), (2, None), (3, ""), (4, " \r\n "), (5, "zebra low É"), (None, "low low"), (5, "zebra low É"),
        (6, "no break ▁low")]
PIECES = [T.START + x for x in ("l", "lo", "low", "n", "ne", "w", "wid")] + ["l", "o", "w", "e", "r", "er", "est", "s", "t", "i", "d", T.START]


def test_edge_rows(spark):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA)
    got = sorted((str(r.doc_id), r.n_words, r.n_tokens, r.n_unknown) for r in T.token_counts(df, PIECES).collect())
    assert got == brute(ROWS, set(PIECES))
    assert T.token_counts(df.where("false"), PIECES).count() == 0


def test_forgetting_words_and_long_text(spark, monkeypatch):
    monkeypatch.setattr(T, "HELD_WORDS", 2)
    df = spark.createDataFrame([(1, "low lower newer wide low " * 20_000, "x")], SCHEMA)
    r = T.token_counts(df, PIECES).first()
    per = sum(greedy(w, set(PIECES)) for w in "low lower newer wide low".split())
    assert (r.n_words, r.n_tokens, r.n_unknown) == (100_000, 20_000 * per, 0)


@pytest.mark.skipif(not os.path.exists(T.VOCABULARY), reason="no vocabulary file here")
def test_documents_equal_a_public_word_piece_coder(spark):
    from tokenizers import models

    pieces = T.read_vocabulary(T.VOCABULARY)
    coder = models.WordPiece({p: i for i, p in enumerate([*pieces, "<unk>"])}, unk_token="<unk>",
                             continuing_subword_prefix="", max_input_chars_per_word=10**9)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in T.token_counts(docs).collect():
        words = [w.decode() for w in text[r.doc_id].encode().split()]
        assert (r.n_words, r.n_tokens) == (len(words), sum(len(coder.tokenize(T.START + w)) for w in words))
