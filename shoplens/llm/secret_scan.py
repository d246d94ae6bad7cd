"""Secret scans: candidates by pattern, false positives removed by a random forest.

Only DataFrame and SQL functions and the JVM-side forest of ``pyspark.ml`` run on
the executors.  A candidate is a run of at least ``LEAST`` key characters with a
digit or three changes from small to capital letters, or a value of ``LEAST_NAMED``
characters assigned to a secret-like name, quoted or not.  A name before an assignment
sign is never part of a candidate.  The forest sees its
length, its character transitions and mix, how much of it consists of dictionary
words (words outside candidates in a share of the corpus's distinct texts), the path-like marks in it and around
it, its source, and the words next to it.

It is trained from labelled findings.  Callers give their own (``labels``); the
default labels findings of the same corpus by rules: a
random-looking value assigned to a secret-like name or a well-known key format is
a secret; identifiers, numbers, addresses, paths, checksums, placeholders and plain
words are not; everything else is left for the forest to decide.

Defined results: null and empty texts have no candidate; positions count from 0
in characters; repeated rows give repeated findings; without findings of both
labels nothing can be learned, and the labelled secrets alone are returned with
score 1; a null doc_id or source stays null; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import cut

#: Shortest run of key characters that is a candidate wherever it stands.
LEAST = 16
#: Shortest value assigned to a secret-like name that is a candidate.
LEAST_NAMED = 8
#: Labelled findings that the forest is fitted on: a hash sample where there are more.
FIT_ROWS = 20_000
TREES, DEPTH, HASHED, SEED = 30, 6, 128, 42
#: Share of the distinct texts, and how many at least, that make a word a dictionary word.
FREQUENT, FREQUENT_TEXTS = 0.0005, 2
CONTEXT = 80
MARK = "\u0001"
KEEP_SCORE = 0.5
REDACTED = "[REDACTED]"

# Names that introduce a secret, well-known key formats, words that mark other values.
NAMES = "api[_-]?key|access[_-]?key|secret[_-]?key|client[_-]?secret|private[_-]?key|auth[_-]?token|token|secret|passwd|password|pwd|credential|bearer"
FORMATS = ("AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9_-]{20,}|sk_live_[A-Za-z0-9]{16,}|"
           "xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}|glpat-[A-Za-z0-9_-]{20,}|"
           "eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]+")
OTHER_VALUES = "sha1|sha256|sha512|md5|checksum|digest|commit|revision|etag|uuid|guid|isbn|doi|version|build|order|invoice|tracking"
PLACEHOLDERS = "example|sample|dummy|changeme|placeholder|your[_-]|xxxx|0000000|1234567|abcdef0|test[_-]?key|redacted"

_RUN = r"[A-Za-z0-9+/_.\-]"
_SIGN = r"(?:=>|:=|={1,3}|:)"
_ASSIGNED = r"(?i)(?:(?:" + NAMES + r")[\"']?(?:\s*" + _SIGN + r"|\s+is\s)|bearer\s)\s*[\"']?$"
# a named value (the name, group 1, stays outside), or a run of key characters that is not itself such a name
_CANDIDATE = (r"((?=[aAsScCpPtTbB])(?i:(?:" + NAMES + r")[\"']?(?:\s*+" + _SIGN + r"|\s++is\s)|bearer\s)\s*+[\"']?)"
              r"((?<=[\"'])[^\s\"']{" + str(LEAST_NAMED) + r",}(?=[\"'])"
              r"|[^\s\"'<>,;&|(){}\[\]]{" + str(LEAST_NAMED) + r",}(?<![.,:!?]))"
              r"|((?<!" + _RUN + r")(?=" + _RUN + "{" + str(LEAST) + r"})"
              r"(?=[A-Za-z+/_.\-]*[0-9]|(?:[A-Za-z+/_.\-]*?[a-z][A-Z]){3})"
              r"(?!(?i:" + _RUN + "*?(?:" + NAMES + r"))[\"']?\s*[=:])"
              + _RUN + "{" + str(LEAST) + r",}(?<![.\-])(?:={1,2}(?!=|" + _RUN + r"))?)")

FEATURES = ("n_chars", "transitions", "digits", "uppers", "lowers", "marks", "hex", "distinct", "longest_letters",
            "coverage", "slashes", "dots", "in_path", "quoted", "after_sign")
WORDS = ("source", "word_before", "name_before", "word_after")


def _marked(text: Column) -> Column:
    """The text cut at its candidates: what is between them, and every other piece a candidate."""
    return F.split(F.regexp_replace(F.translate(text, MARK, " "), _CANDIDATE, "$1" + MARK + "$2$3" + MARK), MARK)


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: doc_id, source, text_key, row_key (one per document
    row), place (its number there), start, value, before, after."""
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"), _marked(F.col("text")).alias("p"))
    rows = rows.where(F.size("p") > 2).withColumn("row_key", F.monotonically_increasing_id())
    piece = lambda i: F.element_at("p", i)
    each = F.transform(F.sequence(F.lit(2), F.size("p") - 1, F.lit(2)), lambda i: F.struct(
        piece(i).alias("value"), F.length(piece(i - 1)).alias("gap"), F.right(piece(i - 1), F.lit(CONTEXT)).alias("before"),
        F.left(piece(i + 1), F.lit(CONTEXT)).alias("after")))
    rows = rows.select("doc_id", "source", "text_key", "row_key", F.posexplode(each).alias("place", "c"))
    so_far = Window.partitionBy("row_key").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("c.gap") + F.length("c.value")).over(so_far)
    return rows.select("doc_id", "source", "text_key", "row_key", "place",
                       (end - F.length("c.value")).cast("long").alias("start"), "c.value", "c.before", "c.after")


def dictionary(docs: DataFrame) -> DataFrame:
    """Words of three or more letters that stand outside candidates in a share of the
    distinct texts (distinct ``word``): copies of a text or a secret add nothing."""
    outside = F.array_join(F.filter(_marked(F.col("text")), lambda x, i: i % 2 == 0), " ")
    words = F.array_distinct(F.regexp_extract_all(F.lower(outside), F.lit(r"\p{L}{3,}"), 0))
    texts = (docs.where("text is not null").select(F.xxhash64("text").alias("text_key"), words.alias("words"))
             .groupBy("text_key").agg(F.first("words").alias("words")))
    total = docs.where("text is not null").agg(F.countDistinct(F.xxhash64("text")).alias("texts"))
    found = texts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return (found.crossJoin(total).where((F.col("n") >= FREQUENT_TEXTS) & (F.col("n") >= FREQUENT * F.col("texts")))
            .select("word"))


def _coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the share of each distinct value's characters in dictionary words."""
    parts = F.lower(F.regexp_replace("value", "(?<=[a-z])(?=[A-Z])", " "))  # camel case is several words
    runs = found.select("value").distinct().select("value", F.explode(
        F.regexp_extract_all(parts, F.lit(r"\p{L}{3,}"), 0)).alias("word"))
    known = runs.join(words, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    return (found.join(known, "value", "left")
            .withColumn("coverage", F.coalesce(F.col("covered") / F.length("value"), F.lit(0.0))).drop("covered"))


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.length("value")


def featured(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with the forest's inputs: numbers (FEATURES) and words (WORDS)."""
    kind = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    lone = lambda c, side: F.coalesce(F.lower(F.regexp_extract(c, side, 1)), F.lit(""))
    return _coverage(found, words).withColumns({
        "n_chars": F.length("value").cast("double"),
        "transitions": F.length(kind) / F.length("value"),
        "digits": _share("[0-9]"), "uppers": _share("[A-Z]"), "lowers": _share("[a-z]"), "marks": _share("[^A-Za-z0-9]"),
        "hex": _share("[0-9a-fA-F]"),
        "distinct": F.size(F.array_distinct(F.split("value", ""))) / F.length("value"),
        "longest_letters": F.coalesce(F.array_max(F.transform(
            F.regexp_extract_all("value", F.lit("[A-Za-z]+"), 0), F.length)), F.lit(0)) / F.length("value"),
        "slashes": F.regexp_count("value", F.lit("/")).cast("double"),
        "dots": F.regexp_count("value", F.lit("[.]")).cast("double"),
        "in_path": (F.col("before").rlike(r"(?:[/@\\]|://)[^\s=]*$") | F.col("value").rlike(r"^[./]|[.][a-z]{2,5}$")).cast("double"),
        "quoted": (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("double"),
        "after_sign": F.col("before").rlike("[=:]>?\\s*[\"']?$").cast("double"),
        "source": F.coalesce("source", F.lit("")),
        "word_before": lone("before", r"(\p{L}+)[^\p{L}]*$"),
        "name_before": F.when(F.col("before").rlike(_ASSIGNED), "yes").otherwise("no"),
        "word_after": lone("after", r"^[^\p{L}]*(\p{L}+)"),
    })


def weak_label() -> Column:
    """1, 0 or null by rules over a featured candidate."""
    value, before = F.col("value"), F.lower("before")
    plain = (value.rlike(f"(?i){PLACEHOLDERS}") | (F.col("coverage") >= 0.5)
             | before.rlike(f"(?:{OTHER_VALUES})[\"']?\\s*(?:=|:|is|#)?\\s*[\"']?$")
             | value.rlike("^[0-9.\\-+]+$") | value.rlike("(?i)^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
             | (F.col("in_path") > 0))
    # letters alone look random if small and capital ones change often
    mixed = (F.length("value") >= LEAST) & (F.col("uppers") >= 0.2) & (F.col("lowers") >= 0.2)
    random = ((F.col("digits") >= 0.1) | mixed) & (F.col("transitions") >= 0.3) & (F.col("distinct") * F.length("value") >= 8)
    return (F.when(value.rlike(f"^(?:{FORMATS})$") & ~value.rlike(f"(?i){PLACEHOLDERS}"), 1.0)
            .when(plain, 0.0).when((F.col("name_before") == "yes") & random, 1.0))


def _vectors(df: DataFrame) -> DataFrame:
    return FeatureHasher(inputCols=[*FEATURES, *WORDS], outputCol="features", numFeatures=HASHED).transform(df)


def fit(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """The forest from featured candidates with ``label``; at most FIT_ROWS of each
    label are used, the first by a hash.  None if a label is missing."""
    by_hash = F.xxhash64("value", "before", "after", "start")
    first = [labelled.where(F.col("label") == k).orderBy(by_hash, "value", "before").limit(FIT_ROWS) for k in (0.0, 1.0)]
    rows = cut(first[0].unionByName(first[1]), "secret-labels")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8, maxBins=32)
    return forest.fit(_vectors(rows).select("features", "label"))


def scan(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Every candidate with ``score`` (the forest's probability of a secret) and
    ``is_secret``.  ``labels``: (value, label) of labelled findings; where given,
    they replace the rules."""
    found = cut(candidates(docs.select("doc_id", "source", "text")), "secret-candidates")
    ready = cut(featured(found, dictionary(docs)), "secret-features")
    if labels is None:
        labelled = ready.withColumn("label", weak_label())
    else:
        given = labels.groupBy("value").agg(F.max("label").cast("double").alias("label"))
        labelled = ready.join(given, "value", "left")
    model = fit(labelled.where("label is not null"))
    if model is None:
        scored = labelled.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        scored = model.transform(_vectors(labelled)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "source", "text_key", "row_key", "place", "start", F.length("value").alias("length"),
                         "value", "score", (F.col("score") >= KEEP_SCORE).alias("is_secret"))


def findings(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The secrets: doc_id, start, length, value_sha256 (the value itself is not repeated), score."""
    return scan(docs, labels).where("is_secret").select(
        "doc_id", "start", "length", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "score")


def redacted(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``docs`` (its own columns) with every secret replaced by REDACTED in ``text`` and
    ``n_chars``, if there is such a column, counted anew where the text changed."""
    places = (scan(docs, labels).where("is_secret").select("doc_id", "text_key", "place").distinct()
              .groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list("place")).alias("secret_places")))
    key = F.xxhash64("text")
    rows = docs.join(places.withColumnRenamed("doc_id", "secret_doc"),
                     F.col("doc_id").eqNullSafe(F.col("secret_doc")) & (key == F.col("text_key")), "left")
    pieces = F.transform(_marked(F.col("text")), lambda x, i: F.when(
        (i % 2 == 1) & F.array_contains("secret_places", ((i - 1) / 2).cast("int")), F.lit(REDACTED)).otherwise(x))
    text = F.when(F.col("secret_places").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    out = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("secret_places").isNull(), F.col("n_chars")).otherwise(F.length(text).cast(kind))
    return rows.select(*[out[c].alias(c) if c in out else docs[c] for c in docs.columns])
