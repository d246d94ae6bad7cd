"""Mixing sources to target weights by a low-discrepancy schedule.

Sizes are words.  Targets come from weighted shares, held at ``cap`` times a
source's size with the excess reshared (water filling).  A source's documents
are laid out in a shuffled order (by a hash), the layout is repeated until it
covers the target, and it is cut into blocks of ``block_words`` words, the last
one shorter.  With n blocks in all, slot i of the schedule is the golden-ratio
lattice point (i * k mod n) / n, k next to n / golden ratio and prime to n: the n
points visit each of the n equal steps once, so a source whose blocks take up a
stretch of the cumulative weights gets exactly as many slots as blocks, spread
evenly.  Slots are ranked per source and slot rank r takes the source's block r.

No source is gathered in one task: running sums and ranks are taken inside
chunks of bounded size and shifted by the chunks' totals.

Defined results: a null or empty text has size 0, target share 0 and is never
taken; a null source is a source of its own, the last one; rows with equal or null
doc_id are documents of their own (equal rows share what they get in any
order); an empty table gives an empty schedule; other columns are not read.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 2048
#: Rows of a chunk in which running sums and ranks are taken.
CHUNK = 8192
CELLS = 1024


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, and the shuffle key: 60 bits of a hash, so that reruns agree."""
    counted = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
                          .cast("long").alias("size"))
    seed = F.concat_ws("/", F.col("doc_id").cast("string"), F.col("size").cast("string"))
    return counted.withColumn("order", F.conv(F.substring(F.md5(seed.cast("binary")), 1, 15), 16, 10).cast("long"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """One row per source: number, source, source_size, target.

    In order of cap / weight a source is held at its cap as long as the level that
    the rest would get reaches it; the first that is not settles the level."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("number", (F.row_number().over(by_name) - 1).cast("int")))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("number") % len(weights) + 1)
    per = per.withColumns({"weight": weight, "most": F.col("source_size") * cap})
    ratio = Window.orderBy(F.col("most") / F.col("weight"), "number")
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = ratio.rowsBetween(0, Window.unboundedFollowing)
    all_words = F.sum("source_size").over(Window.partitionBy())
    level = ((all_words * share - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after))
    per = per.withColumn("own_level", level)
    held = F.col("most") <= F.col("weight") * F.col("own_level")
    first = F.min(F.when(~held, F.struct(F.col("most") / F.col("weight"), "number", "own_level"))).over(Window.partitionBy())
    return per.select("number", "source", "source_size", F.coalesce(
        F.least(F.col("most").cast("double"), F.col("weight") * first["own_level"]), F.col("most").cast("double"),
    ).alias("target"))


def _layout(sized: DataFrame, plan: DataFrame, n_docs: int) -> DataFrame:
    """Each document's first word in its source's shuffled order."""
    buckets = 1 + n_docs // CHUNK
    bucket = F.shiftright(F.shiftright("order", 28) * buckets, 32).alias("bucket")  # in step with the order
    rows = sized.join(plan, sized["source"].eqNullSafe(plan["source"])).select(
        "number", "doc_id", "size", "order", bucket)
    sums = rows.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select("number", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("shift"))
    inside = (Window.partitionBy("number", "bucket").orderBy("order", "size", "doc_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    local = rows.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return local.join(shift, ["number", "bucket"]).select(
        "number", "doc_id", "size", (F.col("local") + F.col("shift")).alias("first"))


def _step(n: int) -> int:
    """The number next to n / golden ratio that is prime to n."""
    near = round(n * (5 ** 0.5 - 1) / 2)
    return next((k for d in range(n) for k in (near + d, near - d) if 0 < k < n and gcd(k, n) == 1), 1)


def _times(i: Column, k: int, n: int) -> Column:
    """i * k mod n for i, k < n < 2^42 without overflow."""
    high, low = F.shiftright(i, 21), i.bitwiseAND((1 << 21) - 1)
    return (((high * k) % n) * (1 << 21) % n + (low * k) % n) % n


def slots(plan: DataFrame, n: int) -> DataFrame:
    """(slot, number, block): every slot's source and the source's block that it takes.
    ``plan`` has each source's stretch [lo, hi) of the n steps."""
    spark = plan.sparkSession
    cell = lambda x: F.floor(x * CELLS / n).cast("int")
    stretch = plan.where("hi > lo").select("number", "lo", "hi", F.explode(
        F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))).alias("cell"))
    points = (spark.range(n).select(F.col("id").alias("slot"), _times(F.col("id"), _step(n), n).alias("point"))
              .withColumn("cell", cell(F.col("point"))))
    owned = (points.join(stretch, "cell").where("lo <= point and point < hi")
             .select("slot", "number", F.floor(F.col("slot") / CHUNK).alias("chunk")))
    counts = owned.groupBy("number", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("number", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    local = F.row_number().over(Window.partitionBy("number", "chunk").orderBy("slot")) - 1
    return (owned.withColumn("local", local).join(shift, ["number", "chunk"])
            .select("slot", "number", (F.col("local") + F.col("shift")).alias("block")))


def _prepared(docs: DataFrame, block_words: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    sized = cut(sizes(docs), "mix-sizes")
    plan = targets(sized).withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
    plan = plan.withColumn("blocks", F.ceil(F.col("words") / block_words))
    upto = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    plan = plan.withColumn("hi", F.sum("blocks").over(upto)).withColumn("lo", F.col("hi") - F.col("blocks"))
    plan = cut(plan, "mix-plan")
    n = plan.agg(F.max("hi")).first()[0] or 0
    laid = cut(_layout(sized, plan.select("number", "source"), sized.count()), "mix-layout")
    return sized, plan, laid, int(n)


def _pieces(laid: DataFrame, plan: DataFrame, block_words: int) -> DataFrame:
    """The words that each block has of each document, in each run over the source."""
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("words") / F.col("source_size")) - 1))
    rows = (laid.join(plan.where("words > 0").select("number", "source_size", "words"), "number").where("size > 0")
            .select("number", "doc_id", "first", "size", "words", "source_size", run.alias("run")))
    at = F.col("first") + F.col("run") * F.col("source_size")
    rows = rows.withColumns({"at": at, "end": F.least(at + F.col("size"), "words")}).where("at < end")
    block = F.explode(F.sequence(F.floor(F.col("at") / block_words), F.floor((F.col("end") - 1) / block_words)))
    rows = rows.withColumn("block", block)
    begin = F.greatest("at", F.col("block") * block_words)
    stop = F.least("end", (F.col("block") + 1) * block_words)
    return rows.select("number", "block", "doc_id", "first", "run", (begin - F.col("at")).alias("from_word"),
                       (stop - begin).alias("n_words"))


def _scheduled(laid: DataFrame, plan: DataFrame, n: int, block_words: int) -> DataFrame:
    return slots(plan, n).join(_pieces(laid, plan, block_words), ["number", "block"])


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The schedule: slot, source, block, and the pieces of documents that the slot
    trains on (doc_id, run, from_word, n_words)."""
    _, plan, laid, n = _prepared(docs, block_words)
    return _scheduled(laid, plan, n, block_words).join(plan.select("number", "source"), "number").select(
        "slot", "source", "block", "doc_id", "run", "from_word", "n_words")


def taken(docs: DataFrame, block_words: int = BLOCK_WORDS, placed: bool = False) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target (its source's), and
    taken, the words that the schedule takes of it, repeats counted.  ``placed`` adds
    where: first_slot, the first slot that trains on it (null: none), and n_pieces, its
    pieces in all slots."""
    _, plan, laid, n = _prepared(docs, block_words)
    took = _scheduled(laid, plan, n, block_words).groupBy("number", "first").agg(
        F.sum("n_words").alias("n_words"), F.min("slot").alias("first_slot"), F.count("*").alias("n_pieces"))
    got = laid.where("size > 0").join(took, ["number", "first"], "left")
    none = laid.where("size = 0").withColumns({c: F.lit(None).cast("long") for c in ("n_words", "first_slot", "n_pieces")})
    at = ["first_slot", F.coalesce("n_pieces", F.lit(0)).cast("long").alias("n_pieces")] if placed else []
    return got.unionByName(none).join(plan.select("number", "source", "source_size", "target"), "number").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("n_words", F.lit(0)).cast("long").alias("taken"), *at)
