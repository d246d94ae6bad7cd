"""Word-piece token counts by a linear longest-match automaton.

A word is cut greedily into the longest vocabulary pieces from its start.  Rather
than trying lengths and building the pieces, one automaton reads each character
once: a trie of the vocabulary, in which a node without a next character falls
back along its failure link to the node of what is left after popping the longest
pieces; how many pieces that pops is computed beforehand, and only those numbers
are added up.

A vocabulary marks pieces that start a word (``START`` in front) and those that go
on; a word that can't be cut whole is one unknown token, as in word-piece coding.
The vocabulary file is a parameter; the driver reads it once and broadcasts the
automaton, whose size MAX_PIECES bounds.  A task remembers the counts of up to
``HELD_WORDS`` different words.

Defined results: words are runs without ASCII white space, taken as they are (no
case folding); a null or empty text has 0 words and 0 tokens; rows are neither
moved nor joined, so repeated rows and null ids stay; other columns are not read.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from shoplens.llm.common import by_batch, utf8
from shoplens.session import ship_by_value

#: The vocabulary of the registered query: a public 32,000-piece file.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
START = "▁"
MAX_PIECES = 2_000_000
HELD_WORDS = 1 << 19


def read_vocabulary(path: str) -> list[str]:
    """The pieces of a sentencepiece model, or of a text file with one piece a line."""
    if not path.endswith(".model"):
        with open(path, encoding="utf-8") as lines:
            return [x for x in lines.read().split("\n") if x]
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


class Automaton:
    """next: a dict per node; fall: failure link (-1: none); pops: pieces popped on the way."""

    def __init__(self, pieces: list[str]):
        self.next: list[dict[str, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    whole.append(False)
                node = self.next[node][c]
            whole[node] = True
        whole[0] = False
        self.fall = [-1] * len(self.next)
        self.pops = [0] * len(self.next)
        queue = deque([0])
        while queue:  # by depth: a link leads to a shorter rest, which is known already
            parent = queue.popleft()
            for c, node in self.next[parent].items():
                queue.append(node)
                if whole[node]:
                    self.fall[node], self.pops[node] = 0, 1
                    continue
                at, popped = self.fall[parent], self.pops[parent]
                while at >= 0 and c not in self.next[at]:
                    at, popped = self.fall[at], popped + self.pops[at]
                if at >= 0:
                    self.fall[node], self.pops[node] = self.next[at][c], popped

    def tables(self) -> tuple[list[dict[str, int]], list[int], list[int]]:
        return self.next, self.fall, self.pops


def count(tables: tuple[list[dict[str, int]], list[int], list[int]], text: str) -> int:
    """Pieces of ``text`` by an automaton's tables; -1 if it can't be cut whole."""
    nxt, fall, pops = tables
    node = total = 0
    for c in text:
        while c not in nxt[node]:
            total += pops[node]
            node = fall[node]
            if node < 0:
                return -1
        node = nxt[node][c]
    while node:
        total += pops[node]
        node = fall[node]
        if node < 0:
            return -1
    return total


class Counts(dict):
    """word (UTF-8) -> its number of pieces, -1 if unknown, filled as words come."""

    def __init__(self, tables):
        super().__init__()
        self.tables = tables

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
        n = count(self.tables, START + word.decode("utf-8", "replace"))
        self[word] = n
        return n


def token_counts(docs: DataFrame, vocabulary: str | list[str] = VOCABULARY) -> DataFrame:
    """Per document: doc_id, n_words, n_tokens (an unknown word is one), n_unknown."""
    pieces = read_vocabulary(vocabulary) if isinstance(vocabulary, str) else list(vocabulary)
    if len(pieces) > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    sent = docs.sparkSession.sparkContext.broadcast(Automaton(pieces).tables())
    made: list[Counts] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(Counts(sent.value))
        known, rows = made[0], []
        for text in utf8(batch.column(1)):
            counts = [known[w] for w in text.split()] if text else []
            unknown = counts.count(-1)
            rows.append((len(counts), sum(counts) + 2 * unknown, unknown))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3))],
            names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return by_batch(docs, ["doc_id", "text"], "doc_id long, n_words long, n_tokens long, n_unknown long", run)


ship_by_value(__name__)
