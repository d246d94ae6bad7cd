from pyspark.sql import functions as F

from shoplens.functions.text import match_all, tokens
from shoplens.operators import search
from shoplens.plans import api
from shoplens.sources.schemas import SALE_DETAIL

D = "2021-12-03"


def rows(spark):
    data = [
        ("1", "1", "1001", f"{D} 10:00:00", "u1", "5", "M", 19, "1", 10.0, "red phone case", D),
        ("2", "1", "1001", f"{D} 10:00:00", "u2", "5", "F", 20, "1", 10.0, "red phone", D),
        ("3", "2", "1001", f"{D} 10:00:00", "u3", "6", "M", 30, "2", 10.0, "Red Phone stand", D),
        ("4", "2", "1001", f"{D} 10:00:00", "u4", "6", "F", 31, "2", 10.0, "phone red", D),
        ("5", "3", "1001", f"{D} 10:00:00", "u5", "7", None, 0, None, 10.0, "red phone", D),
        ("6", "3", "1001", f"{D} 10:00:00", "u6", "7", "M", 40, None, 10.0, "blue phone", D),
        ("7", "4", "1001", f"2021-12-04 10:00:00", "u7", "7", "M", 40, None, 10.0, "red phone", "2021-12-04"),
        ("8", "4", "1001", f"{D} 10:00:00", "u8", "8", "F", 25, None, 10.0, "小米手机 红色", D),
    ]
    return spark.createDataFrame(data, SALE_DETAIL)


def test_tokens(spark):
    def of(text):
        return spark.range(1).select(tokens(F.lit(text)).alias("t")).first().t

    assert of("Red  phone-case") == ["red", "phone", "case"]
    assert of("小米手机") == ["小", "米", "手", "机"]


def test_keyword_and_text_share_one_token_rule(spark):
    texts = ["green m² tile", "cafe\u0301 au lait", "café", "½ inch bolt", "plain", "小米 手机"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def hits(keyword):
        return [r.t for r in df.where(match_all("t", keyword)).collect()]

    assert hits("m²") == ["green m² tile"] and hits("½") == ["½ inch bolt"]
    assert hits("cafe\u0301") == ["cafe\u0301 au lait"] and hits("café") == ["café"]
    assert hits("手米") == ["小米 手机"]
    assert hits("--") == [] and hits("!") == []  # characters, but no token
    assert hits("") == hits(None) == hits("  ") == texts


def test_match_all_tokens(spark):
    df = rows(spark)
    got = sorted(r.order_detail_id for r in df.where(match_all("sku_name", "red phone")).collect())
    assert got == ["1", "2", "3", "4", "5", "7"]
    assert [r.order_detail_id for r in df.where(match_all("sku_name", "米 红")).collect()] == ["8"]
    assert df.where(match_all("sku_name", "phon")).count() == 0


def test_shares_ages_and_genders(spark):
    res = api.sale_detail(rows(spark), D, 0, 10, "red phone")
    assert res["total"].first().total == 5
    stat = {r.title: [(o.name, o.value) for o in r.options] for r in res["stat"].collect()}
    assert stat[search.AGE_TITLE] == [(search.AGE_UNDER_20, 40.0), (search.AGE_20_TO_30, 40.0),
                                      (search.AGE_OVER_30, 20.0)]
    assert stat[search.GENDER_TITLE] == [(search.GENDER_MALE, 40.0), (search.GENDER_FEMALE, 40.0)]
    assert [r.order_detail_id for r in res["detail"].collect()] == ["1", "2", "3", "4", "5"]


def test_no_match(spark):
    res = api.sale_detail(rows(spark), D, 0, 10, "green")
    assert res["total"].first().total == 0
    stat = {r.title: [o.value for o in r.options] for r in res["stat"].collect()}
    assert stat[search.AGE_TITLE] == [0.0, 100.0, 0.0]
    assert stat[search.GENDER_TITLE] == [0.0, 0.0]
    assert res["detail"].count() == 0


def test_page_offset(spark):
    res = api.sale_detail(rows(spark), D, 3, 2, "red phone")
    assert [r.order_detail_id for r in res["detail"].collect()] == ["4", "5"]
    assert api.sale_detail(rows(spark), D, 10, 2, "red phone")["detail"].count() == 0


def test_small_page_skews_reference_mode(spark):
    # top-2 age facets only (ties by age): ages 0 and 19 -> 2 of 5 under 20, none over 30
    res = api.sale_detail(rows(spark), D, 0, 2, "red phone", exact=False)
    stat = {r.title: [o.value for o in r.options] for r in res["stat"].collect()}
    assert stat[search.AGE_TITLE] == [40.0, 60.0, 0.0]
    exact = api.sale_detail(rows(spark), D, 0, 2, "red phone")
    stat = {r.title: [o.value for o in r.options] for r in exact["stat"].collect()}
    assert stat[search.AGE_TITLE] == [40.0, 40.0, 20.0]


def test_top_facets_need_their_number(spark):
    import pytest

    with pytest.raises(ValueError):
        search.age_shares(rows(spark), exact=False)
    none = search.age_shares(rows(spark), exact=False, top_n=0).where(F.col("dt") == D).first()
    assert (none.under_20, none.over_30) == (0.0, 0.0)


def test_facets(spark):
    m = search.keyword_rows(rows(spark), "red phone", D)
    g = [(r.user_gender, r.doc_count) for r in search.facet(m, "user_gender", 2).orderBy("rank").collect()]
    assert g == [("F", 2), ("M", 2)]
    a = search.facet(m, "user_age", 3).orderBy("rank").collect()
    assert [r.user_age for r in a] == [0, 19, 20]


def test_all_days_forms(spark):
    m = search.keyword_rows(rows(spark), "red phone")
    shares = {r.dt: r for r in search.age_shares(m).collect()}
    assert shares["2021-12-04"].over_30 == 100.0 and shares[D].total == 5
    assert search.page(m, 0, 1).where(F.col("dt") == "2021-12-04").count() == 1


def test_answer_equals_its_parts(spark):
    m = search.keyword_rows(rows(spark), "red phone")
    got = {r.dt: r for r in search.answer(m, 1, 3).collect()}
    for r in search.shares(m).collect():
        mine = got[r.dt]
        assert (r.total, r.under_20, r.from_20_to_30, r.over_30, r.male, r.female) == (
            mine.total, mine.under_20, mine.from_20_to_30, mine.over_30, mine.male, mine.female)
    for name, field, most in (("genders", "user_gender", 2), ("ages", "user_age", 3)):
        for dt in got:
            want = [(r[field], r.doc_count) for r in search.facet(m, field, most).where(F.col("dt") == dt).orderBy("rank").collect()]
            assert [(x.value, x.doc_count) for x in got[dt][name]] == want
    for dt in got:
        want = [r.order_detail_id for r in search.page(m, 1, 3).where(F.col("dt") == dt).orderBy("row_no").collect()]
        assert [x.order_detail_id for x in got[dt].detail] == want


def test_answer_reads_each_table_once(spark):
    from shoplens.plans import catalog

    plan = catalog.q_search_answer(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for table in ("lineitem", "orders", "part", "customer"):
        assert plan.count(f"/{table}.parquet") == 1, table


def test_one_row_answer(spark):
    one = api.search_answer(rows(spark), D, 3, 2, "red phone").collect()
    parts = api.sale_detail(rows(spark), D, 3, 2, "red phone")
    assert len(one) == 1 and one[0].total == parts["total"].first().total
    assert {(s.title, tuple(s.options)) for s in one[0].stat} == {(s.title, tuple(s.options)) for s in parts["stat"].collect()}
    assert [r.order_detail_id for r in one[0].detail] == [r.order_detail_id for r in parts["detail"].collect()]
    none = api.search_answer(rows(spark), D, 0, 10, "green").first()
    assert (none.total, none.detail) == (0, []) and [o.value for s in none.stat for o in s.options if s.title == search.AGE_TITLE] == [0.0, 100.0, 0.0]
    few = api.search_answer(rows(spark), D, 0, 2, "red phone", exact=False).first()
    same = api.sale_detail(rows(spark), D, 0, 2, "red phone", exact=False)["stat"].collect()
    assert {(s.title, tuple(s.options)) for s in few.stat} == {(s.title, tuple(s.options)) for s in same}
