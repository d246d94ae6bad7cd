"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are 64-bit majority votes over the XXH64 hashes of word shingles.
Distinct fingerprints are joined with themselves within ``max_bits`` differing
bits: node pairs of a binary trie are walked together from the root, a pair
carries the bits in which its paths differ, and it is dropped as soon as they
exceed the budget.

The walk is spread over the cluster by the pigeonhole rule: cut into
``max_bits + 2`` blocks, two linked fingerprints agree in at least two blocks.
Each pair of blocks gives one trie whose paths start with these two blocks and
descend them with an error budget of zero, so all fingerprints below one such
start node form a unit of work of their own.  A unit with more than
``unit_rows`` fingerprints is cut into parts; each pair of parts is a unit.
A task keeps one spanning forest of the links it finds, never all pairs.

Defined results: a null text counts as empty, an empty text has fingerprint
zero and is linked like any other; rows with equal fingerprints are linked
through that fingerprint alone (copies are never paired up); a null doc_id keeps
its row and is ignored when the smallest id is taken; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import by_batch, cut, slots, utf8
from shoplens.llm.components import components
from shoplens.session import ship_by_value

SEED = 42
UNIT_ROWS = 2048
#: Node pairs that one step of the walk holds; larger frontiers are walked in parts.
FRONTIER = 1 << 18
#: Shingle hashes that one vote adds up at a time.
VOTE_ROWS = 1 << 15


def fingerprint(text: bytes | None, width: int) -> int:
    """64-bit fingerprint (unsigned) of one UTF-8 text."""
    import xxhash

    words = text.lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_digest, b" ".join
    shingles = zip(*(words[k:] for k in range(width)))
    hashes = np.frombuffer(b"".join([digest(join(s), SEED) for s in shingles]), ">u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), VOTE_ROWS):
        part = hashes[at:at + VOTE_ROWS].astype("<u8").view(np.uint8).reshape(-1, 8)
        lanes = np.unpackbits(part, axis=1, bitorder="little").view(np.uint64)  # eight one-byte counters each
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)  # no byte overflows
        votes += sums.view(np.uint8).sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_key, fp) of every row: a hash of its text, and the fingerprint as a signed long."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(t, width) for t in utf8(batch.column(2))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))],
            names=["doc_id", "text_key", "fp"])

    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return by_batch(keyed, keyed.columns, "doc_id long, text_key long, fp long", run)


def hex16(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the max_bits + 2 blocks that 64 bits are cut into."""
    n = max_bits + 2
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _starts(max_bits: int) -> Column:
    """One start node per pair of blocks: its number above, the two blocks' bits below."""
    blocks, out = _blocks(max_bits), []
    fp = F.col("fp")

    def bits(at: int) -> Column:
        shift, width = blocks[at]
        return F.shiftrightunsigned(fp, shift).bitwiseAND((1 << width) - 1)

    for k, (i, j) in enumerate(combinations(range(len(blocks)), 2)):
        node = F.shiftleft(bits(i), blocks[j][1]).bitwiseOR(bits(j))
        out.append(node.bitwiseOR(F.lit(k << 48)))
    return F.array(*out)


def trie_links(units: np.ndarray, fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of fingerprints of one unit within ``max_bits`` bits.

    ``fps`` (unsigned) must be sorted by (unit, fp) and distinct in a unit.  A
    trie node at depth d is a run [lo, hi) of equal unit and equal first d bits;
    the frontier holds node pairs with their differing bits.
    """
    cuts = np.flatnonzero(np.concatenate(([True], units[1:] != units[:-1], [True])))
    lo, hi = cuts[:-1], cuts[1:]
    many = hi - lo > 1
    lo, hi = lo[many], hi[many]
    ones = [None] * 64

    def below(depth: int) -> np.ndarray:  # ones before each position, at this depth
        if ones[depth] is None:
            bit = (fps >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
        return ones[depth]

    stack = [(0, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        depth, alo, ahi, blo, bhi, bits = stack.pop()
        if not len(alo):
            continue
        if depth == 64:
            yield alo, blo
            continue
        if len(alo) > FRONTIER:
            half = len(alo) // 2
            for part in (slice(half), slice(half, None)):
                stack.append((depth, alo[part], ahi[part], blo[part], bhi[part], bits[part]))
            continue
        seen = below(depth)
        amid, bmid = ahi - (seen[ahi] - seen[alo]), bhi - (seen[bhi] - seen[blo])
        same = alo == blo  # one node with itself: its mixed children are one pair
        nxt = []
        for a0, a1, b0, b1, cost in ((alo, amid, blo, bmid, 0), (amid, ahi, bmid, bhi, 0),
                                     (alo, amid, bmid, bhi, 1), (amid, ahi, blo, bmid, 1)):
            ok = (a0 < a1) & (b0 < b1) & (bits + cost <= max_bits)
            ok &= ~((a0 == b0) & (a1 - a0 < 2))  # a single leaf with itself
            if cost and a0 is amid:
                ok &= ~same
            nxt.append((a0[ok], a1[ok], b0[ok], b1[ok], (bits[ok] + cost).astype(np.int8)))
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*nxt))))


def _forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index that each of n indexes reaches."""
    root = np.arange(n)
    for a, b in links:
        while True:
            ra, rb = root[a], root[b]
            open_ = ra != rb
            if not open_.any():
                break
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(up := root[root], root):
                root = up
    return root


def _unit_runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole units, many per run: the rows arrive sorted by unit."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        rows += batch.num_rows
        if rows >= size:
            u, f = (np.concatenate(x) for x in zip(*held))
            last = int(np.searchsorted(u, u[-1]))
            if last:
                yield u[:last], f[:last]
            held, rows = [(u[last:], f[last:])], len(u) - last
    if rows:
        yield tuple(np.concatenate(x) for x in zip(*held))


def links(distinct: DataFrame, max_bits: int, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """(u, v) links that connect all of ``distinct.fp`` within ``max_bits`` bits: the
    spanning forest of each unit, so a fingerprint has one row per unit at most."""
    rows = distinct.select("fp", F.explode(_starts(max_bits)).alias("start"))
    sizes = rows.groupBy("start").agg(F.count("*").alias("n")).where(F.col("n") > unit_rows)
    parts = F.ceil(F.col("n") / unit_rows).cast("int")
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    other = F.explode(F.sequence(F.lit(0), parts - 1))
    big = (rows.join(sizes, "start").select("start", "fp", mine.alias("mine"), other.alias("other"))
           .where("mine <> other")
           .select(F.xxhash64("start", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"), "fp"))
    small = rows.join(sizes, "start", "left_anti").select(F.col("start").alias("unit"), "fp")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u, f in _unit_runs(batches, 8 * UNIT_ROWS):
            f = f.view(np.uint64)
            order = np.lexsort((f, u))
            u, f = u[order], f[order]
            root = _forest(len(f), trie_links(u, f, max_bits))
            child = np.flatnonzero(root != np.arange(len(f)))
            if len(child):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f[child].view(np.int64)), pa.array(f[root[child]].view(np.int64))], names=["u", "v"])

    spark = distinct.sparkSession
    return (small.unionAll(big).repartition(slots(spark), "unit").sortWithinPartitions("unit")
            .mapInArrow(walk, "u long, v long"))


def grouped(docs: DataFrame, width: int = 4, max_bits: int = 4, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """(doc_id, text_key, fp, component): the component is named by one of its fingerprints."""
    known = cut(fingerprints(docs, width), "simhash-fp")
    nodes = cut(known.select("fp").distinct(), "simhash-distinct")
    groups = components(links(nodes, max_bits, unit_rows), "simhash-links").withColumnRenamed("node", "fp")
    return known.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4,
                    unit_rows: int = UNIT_ROWS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the
    smallest doc_id reachable over links of at most ``max_bits`` differing bits)."""
    rows = grouped(docs, width, max_bits, unit_rows)
    # written first: a join of two plain exchanges is split where a component is hot
    least = cut(rows.groupBy("component").agg(F.min("doc_id").alias("component_id")), "simhash-least")
    return cut(rows, "simhash-rows").join(least, "component").select("doc_id", hex16().alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` without the near copies: of each component the smallest doc_id stays (null
    last, then by the text's hash), and of rows with equal doc_id and text, one."""
    rows = grouped(docs, width, max_bits)
    keep = rows.groupBy("component").agg(F.min(F.struct(
        F.isnull("doc_id").alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_key")).alias("k"))
    keys = ["no_id", "id", "text_key"]
    keyed = docs.withColumns({"no_id": F.isnull("doc_id"), "id": F.coalesce("doc_id", F.lit(0)),
                              "text_key": F.xxhash64("text")})
    return keyed.join(keep.select("k.*"), keys, "left_semi").dropDuplicates(keys).select(*docs.columns)


ship_by_value(__name__)
