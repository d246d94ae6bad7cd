"""Fill-in-the-middle transformation by secondary-sort assembly.

A text is cut into units (a word with the white space before it, or the white space
at the end), two cut points drawn from a hash of the doc_id split it into prefix,
middle and suffix, and the parts are put in another order behind sentinels:

    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle
    plain  the text as it is

No output is built in memory for that.  Every document is emitted as pieces (a run of
whole units up to PIECE bytes, or a part of a longer unit; each sentinel is a piece of
its own) keyed by document and output position.  Repartitioning by document and sorting
within partitions by document and position (the DataFrame form of
``repartitionAndSortWithinPartitions``) brings the pieces of a document together in
output order, where they stream through an incremental digest.  Each piece is keyed anew
by its part of the original text, which is read off the sentinels that went by, and a
second sort within the partitions streams the restored text through another digest;
nothing moves between executors for it.  A task holds a batch of pieces at a time; the
sorts spill.

Defined results: a null text is an empty one; an empty text is plain, with 0 units; a
null doc_id is drawn like the empty id; rows with equal doc_id are documents of their
own (equal rows give equal results); an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import slots
from shoplens.session import ship_by_value

#: Sentinels, seed of the draws, per cent of texts transformed and of those in spm order.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
RATE, SPM_RATE = 50, 80
#: Bytes of a piece, and of the part of a text that is looked at in one step.
PIECE = 8192
BLOCK = 1 << 20
#: Rows of an Arrow batch.
ROWS = 1000
TYPES = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Place of each part in the original text, by the sentinel before it.
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
HEADER = -1


def unit_ends(data: bytes, start: int, stop: int) -> np.ndarray:
    """Ends of the units that end in data[start:stop] (byte offsets in ``data``)."""
    word = ~SPACE[np.frombuffer(data, np.uint8)[start:stop + 1]]
    after = word[1:] if stop < len(data) else np.append(word[1:], False)
    ends = np.flatnonzero(word[:stop - start] & ~after) + start + 1
    if stop == len(data) and start < stop and not word[-1]:
        ends = np.append(ends, stop)  # the white space at the end is a unit
    return ends


def _blocks(data: bytes) -> Iterator[tuple[int, int]]:
    return ((at, min(at + BLOCK, len(data))) for at in range(0, len(data), BLOCK))


def cut_points(data: bytes, draws: tuple[int, int]) -> tuple[int, int, int]:
    """Units of the text, and the byte offsets at which prefix and middle end."""
    counts = [len(unit_ends(data, *block)) for block in _blocks(data)]
    n = sum(counts)
    found = []
    for left in sorted(d % (n + 1) for d in draws):
        offset = 0
        for count, block in zip(counts, _blocks(data)):
            if left <= count:
                offset = int(unit_ends(data, *block)[left - 1]) if left else offset
                break
            left -= count
            offset = block[1]
        found.append(offset)
    return n, *found


def code_points(data: bytes, start: int, stop: int) -> int:
    raw = np.frombuffer(data, np.uint8)[start:stop]
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def pieces_of(data: bytes, start: int, stop: int) -> Iterator[bytes]:
    """data[start:stop] in runs of whole units of at most PIECE bytes; longer units are cut."""
    while start < stop:
        until = min(start + PIECE, stop)
        if until < stop:
            ends = unit_ends(data, start, until)
            until = int(ends[-1]) if len(ends) else until
        yield data[start:until]
        start = until


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[k:k + 8], 16) for k in (0, 8, 16, 24)]


def plan(doc_id: int | None, data: bytes, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED):
    """(n, form, prefix_chars, middle_chars) and the parts of the output in order."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    n, a, b = cut_points(data, (h1, h2))
    if not data or any(mark in data for mark in PLACE) or h3 % 100 >= rate:
        return (n, "plain", None, None), [(0, len(data))]
    form = "spm" if h4 % 100 < spm_rate else "psm"
    prefix, middle, suffix = (0, a), (a, b), (b, len(data))
    parts = ([SUFFIX, suffix, PREFIX, prefix] if form == "spm" else [PREFIX, prefix, SUFFIX, suffix]) + [MIDDLE, middle]
    return (n, form, code_points(data, *prefix), code_points(data, *middle)), parts


#: A row of a sorted stream: a piece, or (part HEADER) what is known of its document.
KNOWN = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
STREAM = f"key binary, part long, at long, piece binary, {KNOWN}, output_sha256 string, copies long"
NOTHING = (None,) * 7


def _packed(rows: Iterable[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ROWS rows, each of a piece at most (or a text, which is sent at once)."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if len(held) >= ROWS or size >= ROWS * PIECE // 2:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def _mapped(df: DataFrame, rows: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """``rows`` over the tuples of each partition, as one stream."""
    fields = [f.split() for f in schema.split(", ")]
    names, types = [f[0] for f in fields], [TYPES[f[1]] for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (row for b in batches for at in range(0, b.num_rows, ROWS)
                 for row in zip(*(c.to_pylist() for c in b.slice(at, ROWS).columns)))
        return _packed(rows(every), names, types)

    return df.mapInArrow(run, schema)


def pieces(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED) -> DataFrame:
    """The pieces of every output (part 0) by their position, and a header for each document.  A
    document is known by a hash of its id, its text and the partition it is read in: equal rows of a
    partition share their pieces, which the assembly takes once for all of them."""
    def emit(rows: Iterator[tuple]) -> Iterator[tuple]:
        here = TaskContext.get().partitionId()
        for doc_id, data in rows:
            data = data or b""
            known = hashlib.blake2b(f"{doc_id}/{here}/".encode(), digest_size=16)
            known.update(data)
            key = known.digest()
            header, parts = plan(doc_id, data, rate, spm_rate, seed)
            yield key, HEADER, 0, None, doc_id, *header, None, 1
            runs = (pieces_of(data, *p) if isinstance(p, tuple) else (p,) for p in parts)
            for at, piece in enumerate(chain.from_iterable(runs)):
                yield key, 0, at, piece, *NOTHING

    return _mapped(docs.select("doc_id", F.col("text").cast("binary")), emit, STREAM)


def _documents(stream: Iterator[tuple]) -> Iterator[tuple[bytes, tuple, int, Iterator[bytes]]]:
    """(key, header, copies, pieces in order) of each document of a sorted partition; what
    equal rows repeat comes once.  The pieces must be read before the next document."""
    for key, group in groupby(stream, itemgetter(0)):
        first = next(group)
        header, copies, ahead = first[4:10], first[10], None
        for ahead in group:
            if ahead[1] != HEADER:
                break
            copies, ahead = copies + ahead[10], None

        def once(first=ahead, rest=group):
            last = None
            for row in chain([first] if first else [], rest):
                if row[1:3] != last:
                    last = row[1:3]
                    yield row[3]

        yield key, header, copies, once()


def _digested(stream: Iterator[tuple]) -> Iterator[tuple]:
    """Output digest of each document, and its pieces keyed by their part of the original text."""
    for key, header, copies, output in _documents(stream):
        digest, part = hashlib.sha256(), 0
        for at, piece in enumerate(output):
            digest.update(piece)
            if header[2] != "plain" and piece in PLACE:  # a transformed text holds no sentinel itself
                part = PLACE[piece]
            else:
                yield key, part, at, piece, *NOTHING
        yield key, HEADER, 0, None, *header[:5], digest.hexdigest(), copies


def _restored(stream: Iterator[tuple]) -> Iterator[tuple]:
    for _, header, copies, text in _documents(stream):
        digest = hashlib.sha256()
        for piece in text:
            digest.update(piece)
        for _ in range(copies):
            yield *header, digest.hexdigest()


def _assembled(stream: Iterator[tuple]) -> Iterator[tuple]:
    for _, header, copies, output in _documents(stream):
        text = b"".join(output).decode(errors="replace")
        for _ in range(copies):
            yield *header[:5], text


def _in_output_order(docs: DataFrame, **options: int) -> DataFrame:
    return pieces(docs, **options).repartition(slots(docs.sparkSession), "key").sortWithinPartitions("key", "part", "at")


def transform(docs: DataFrame, **options: int) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output text of every document
    (options: rate, spm_rate, seed)."""
    return _mapped(_in_output_order(docs, **options), _assembled, f"{KNOWN}, output string")


def digests(docs: DataFrame, **options: int) -> DataFrame:
    """The same rows with SHA-256 digests of the output and of the text restored from it;
    neither text is ever held whole."""
    output = _mapped(_in_output_order(docs, **options), _digested, STREAM)
    return _mapped(output.sortWithinPartitions("key", "part", "at"), _restored,
                   f"{KNOWN}, output_sha256 string, restored_sha256 string")


ship_by_value(__name__)
