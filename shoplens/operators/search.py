"""Sale-detail search: keyword filter, facets, shares and a page.

Every function takes a ``by`` list (default: the day ``dt``) so one plan answers
the question for all days at once; the single-day API filters ``dt`` first and
the filter reaches the Parquet scan / partition directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.text import match_all, round_half_up_1

# fixed values: option titles of the two share charts and of their options
AGE_TITLE = "用户年龄占比"
GENDER_TITLE = "用户性别占比"
AGE_UNDER_20 = "20岁以下"
AGE_20_TO_30 = "20岁到30岁"
AGE_OVER_30 = "30岁以上"
GENDER_MALE = "男"
GENDER_FEMALE = "女"


def keyword_rows(sale_detail: DataFrame, keyword: str, date: str | None = None) -> DataFrame:
    rows = sale_detail
    if date is not None:
        rows = rows.where(F.col("dt") == date)
    return rows.where(match_all("sku_name", keyword))


def totals(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    by = by or ["dt"]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("total"))


def facet(rows: DataFrame, field: str, top_n: int, by: list[str] | None = None) -> DataFrame:
    """Terms facet: count per value, top ``top_n`` by count then value; nulls excluded.

    Counting is a partial aggregate; the top-n runs on the small counted
    table (one row per group and value).
    """
    by = by or ["dt"]
    counts = (rows.where(F.col(field).isNotNull()).groupBy(*by, field)
              .agg(F.count(F.lit(1)).alias("doc_count")))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("doc_count"), F.asc(field)))
    return counts.withColumn("rank", rank).where(F.col("rank") <= top_n)


def age_shares(rows: DataFrame, by: list[str] | None = None, exact: bool = True,
               top_n: int | None = None) -> DataFrame:
    """Shares under 20 / 20 to 30 / over 30 in percent, one decimal.

    Exact mode is one aggregation (conditional counts).  ``exact=False``
    counts only the top ``top_n`` age facets, as the original did with the
    page size (0 gives no facet).
    """
    by = by or ["dt"]
    if exact:
        j = rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("total"),
            F.count(F.when(F.col("user_age") < 20, True)).alias("low"),
            F.count(F.when(F.col("user_age") > 30, True)).alias("high"),
        )
    else:
        if top_n is None:
            raise ValueError("exact=False needs top_n, the number of age facets that count")
        src = facet(rows, "user_age", top_n, by).drop("rank")
        buckets = src.groupBy(*by).agg(
            F.sum(F.when(F.col("user_age") < 20, F.col("doc_count")).otherwise(0)).alias("low"),
            F.sum(F.when(F.col("user_age") > 30, F.col("doc_count")).otherwise(0)).alias("high"),
        )
        j = totals(rows, by).join(buckets, by, "left")
    low = round_half_up_1(F.coalesce("low", F.lit(0)), F.col("total"))
    high = round_half_up_1(F.coalesce("high", F.lit(0)), F.col("total"))
    return j.select(
        *by, "total",
        low.alias("under_20"),
        F.floor(F.lit(100.0) - low - high + F.lit(0.5)).cast("double").alias("from_20_to_30"),
        high.alias("over_30"),
    )


def gender_shares(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Male / female shares of all matching rows; a null gender is in neither."""
    by = by or ["dt"]
    g = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum((F.col("user_gender") == "M").cast("int")).alias("male"),
        F.sum((F.col("user_gender") == "F").cast("int")).alias("female"),
    )
    return g.select(
        *by, "total",
        round_half_up_1(F.coalesce("male", F.lit(0)), F.col("total")).alias("male"),
        round_half_up_1(F.coalesce("female", F.lit(0)), F.col("total")).alias("female"),
    )


def page(rows: DataFrame, offset: int, size: int, by: list[str] | None = None,
         order: str = "order_detail_id") -> DataFrame:
    """Rows ``offset + 1 .. offset + size`` per group in ``order`` (L1).

    ``row_number() <= k`` lets Spark insert a partial window group limit
    before the shuffle, so each group ships at most k rows per partition.
    """
    by = by or ["dt"]
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(F.asc(order)))
    return (rows.withColumn("row_no", rn)
            .where(F.col("row_no") <= offset + size)
            .where(F.col("row_no") > offset))


def shares(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Total, exact age shares and gender shares of a search answer in one aggregation."""
    by = by or ["dt"]
    g = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col("user_age") < 20, True)).alias("low"),
        F.count(F.when(F.col("user_age") > 30, True)).alias("high"),
        F.count(F.when(F.col("user_gender") == "M", True)).alias("m"),
        F.count(F.when(F.col("user_gender") == "F", True)).alias("f"),
    )
    low, high, male, female = (round_half_up_1(F.col(c), F.col("total")) for c in ("low", "high", "m", "f"))
    return g.select(*by, "total", low.alias("under_20"),
                    F.floor(F.lit(100.0) - low - high + F.lit(0.5)).cast("double").alias("from_20_to_30"),
                    high.alias("over_30"), male.alias("male"), female.alias("female"))


def stats(answer: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The two share charts as (title, options: array<struct<name, value>>) per group, from
    rows with the columns of ``shares``: two rows made of each, no second read."""
    by = by or ["dt"]

    def chart(title: str, options: list[tuple[str, str]]):
        return F.struct(F.lit(title).alias("title"), F.array(*[
            F.struct(F.lit(name).alias("name"), F.col(c).alias("value")) for name, c in options]).alias("options"))

    return answer.select(*by, F.inline(F.array(
        chart(AGE_TITLE, [(AGE_UNDER_20, "under_20"), (AGE_20_TO_30, "from_20_to_30"), (AGE_OVER_30, "over_30")]),
        chart(GENDER_TITLE, [(GENDER_MALE, "male"), (GENDER_FEMALE, "female")]))))


#: Parts of a group that look for their own first rows before the page is cut, so that no
#: task sorts a whole group.
SPREAD = 32


def answer(rows: DataFrame, offset: int, size: int, by: list[str] | None = None, order: str = "order_detail_id",
           top_genders: int = 2, top_ages: int | None = None, exact: bool = True) -> DataFrame:
    """The whole search answer, one row per group, from one read of the matches (Q3):
    total, shares, the top genders and ages (arrays of value, doc_count) and the page
    (array of rows).  Grouping sets count the matches by group, by gender and by age in one
    aggregation, which also takes along the few rows that can be on the page: the first
    ``offset + size`` of each of SPREAD parts of a group.  ``top_ages`` defaults to the page
    size; with ``exact=False`` only these ages count for the shares.
    """
    by = by or ["dt"]
    top_ages = size if top_ages is None else top_ages
    part = Window.partitionBy(*by, F.pmod(F.xxhash64(order), F.lit(SPREAD))).orderBy(order)
    near = F.row_number().over(part) <= offset + size
    row = F.struct(order, *[c for c in rows.columns if c != order])
    marked = rows.select(*by, "user_gender", "user_age", F.when(near, row).alias("row"))
    low, high = F.col("user_age") < 20, F.col("user_age") > 30
    sets = marked.groupingSets([by, [*by, "user_gender"], [*by, "user_age"]], *by, "user_gender", "user_age").agg(
        F.grouping("user_gender").alias("no_gender"), F.grouping("user_age").alias("no_age"), F.count(F.lit(1)).alias("n"),
        F.collect_list("row").alias("rows"))
    whole = F.col("no_gender") + F.col("no_age") == 2
    genders, ages = F.col("no_gender") == 0, F.col("no_age") == 0
    kind = F.when(whole, "whole").when(genders & F.col("user_gender").isNotNull(), "gender").when(
        ages & F.col("user_age").isNotNull(), "age")
    ranked = sets.withColumn("kind", kind).withColumn("rank", F.row_number().over(
        Window.partitionBy(*by, "kind").orderBy(F.desc("n"), "user_gender", "user_age")))

    def top(name: str, value: str, most: int):
        found = F.when((F.col("kind") == name) & (F.col("rank") <= most), F.struct("rank", F.col(value).alias("value"), F.col("n").alias("doc_count")))
        return F.transform(F.array_sort(F.collect_list(found)), lambda x: x.dropFields("rank")).alias(f"{name}s")

    def counted(name: str, condition, most: int | None = None):
        inside = (F.col("kind") == name) & condition
        return F.coalesce(F.sum(F.when(inside if most is None else inside & (F.col("rank") <= most), F.col("n"))), F.lit(0))

    among = None if exact else top_ages
    found = ranked.groupBy(*by).agg(
        counted("whole", F.lit(True)).alias("total"), counted("age", low, among).alias("low"), counted("age", high, among).alias("high"),
        counted("gender", F.col("user_gender") == "M").alias("m"), counted("gender", F.col("user_gender") == "F").alias("f"),
        top("gender", "user_gender", top_genders), top("age", "user_age", top_ages),
        F.flatten(F.collect_list(F.when(F.col("kind") == "whole", F.col("rows")))).alias("rows"))
    low, high, male, female = (round_half_up_1(F.col(c), F.col("total")) for c in ("low", "high", "m", "f"))
    return found.select(
        *by, "total", low.alias("under_20"), F.floor(F.lit(100.0) - low - high + F.lit(0.5)).cast("double").alias("from_20_to_30"),
        high.alias("over_30"), male.alias("male"), female.alias("female"), "genders", "ages",
        F.slice(F.array_sort("rows"), offset + 1, size).alias("detail"))
