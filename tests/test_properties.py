"""Property tests: operators against plain-Python brute force on random small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shoplens.operators import alerts, dau

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
EV = "mid string, uid string, evid string, itemid string, ts long"
BASE = 1_700_000_000_000

events = st.lists(
    st.tuples(st.sampled_from(["m1", "m2"]), st.sampled_from(["u1", "u2", "u3", "u4", None]),
              st.sampled_from(["coupon", "coupon", "coupon", "clickItem", "view"]),
              st.sampled_from(["1", "2", None]), st.integers(0, 900_000)),
    min_size=1, max_size=40,
).map(lambda rows: [(m, u, e, i, BASE + t) for m, u, e, i, t in rows])


def _nk(v):
    return (0, "") if v is None else (1, v)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["2024-01-01", "2024-01-02"]),
                               st.integers(0, 50), st.sampled_from(["x", "y", None]),
                               st.sampled_from(["01", "02"])), min_size=1, max_size=30))
def test_first_seen_is_the_smallest_row(spark, rows):
    cols = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs", "logDate", "logHour", "ts"]
    data = [(m, "u", None, None, None, None, t, None, d, h, ts) for m, d, ts, t, h in rows]
    df = spark.createDataFrame(data, ", ".join(f"{c} {'long' if c == 'ts' else 'string'}" for c in cols))
    row_key = lambda r: tuple(_nk(v) for v in r)
    got = sorted((tuple(r) for r in dau.first_seen(df).collect()), key=row_key)
    best = {}
    order = ["ts", "uid", "appid", "area", "os", "ch", "type", "vs", "logHour"]
    for r in data:
        row = dict(zip(cols, r))
        k = (row["mid"], row["logDate"])
        key = tuple(_nk(row[c]) for c in order)
        if k not in best or key < best[k][0]:
            best[k] = (key, r)
    assert got == sorted((v[1] for v in best.values()), key=row_key)


def _brute_rule(rows, lo, hi, min_uids=3):
    """Alert content of the rows with lo <= ts < hi (None if no alert)."""
    sel = [r for r in rows if lo <= r[4] < hi]
    if not sel or any(r[2] == "clickItem" for r in sel):
        return None
    uids = sorted({r[1] or "" for r in sel if r[2] == "coupon"})
    if len(uids) < min_uids:
        return None
    items = sorted({r[3] or "" for r in sel if r[2] == "coupon"})
    return (min(r[4] for r in sel), len(uids), ",".join(uids), ",".join(items), len(sel))


@SETTINGS
@given(rows=events, split=st.sampled_from([1, 3]))
def test_trailing_alerts_match_brute_force(spark, rows, split):
    span = 300_000
    df = spark.createDataFrame(rows, EV)
    got = sorted((r.mid, r.ts, r.n_uids, r.uids, r.item_ids, r.n_events)
                 for r in alerts.trailing_alerts(df, "5 minutes", 3, split=split).collect())
    want = []
    for r in rows:
        same = [x for x in rows if x[0] == r[0]]
        res = _brute_rule(same, r[4] - span + 1, r[4] + 1)
        if res is not None:
            want.append((r[0], r[4], res[1], res[2], res[3], res[4]))
    assert got == sorted(want)


@SETTINGS
@given(rows=events)
def test_sliding_alerts_match_brute_force(spark, rows):
    span, step = 120_000, 30_000
    df = spark.createDataFrame(rows, EV)
    got = sorted((r.mid, r.window_start, r.ts, r.n_uids, r.uids, r.item_ids, r.n_events)
                 for r in alerts.window_alerts(df, "2 minutes", "30 seconds").collect())
    want = set()
    for r in rows:
        first = (r[4] // step) * step
        for i in range(span // step):
            start = first - i * step
            same = [x for x in rows if x[0] == r[0]]
            res = _brute_rule(same, start, start + span)
            if res is not None:
                want.add((r[0], start, res[0], res[1], res[2], res[3], res[4]))
    assert got == sorted(want)


@SETTINGS
@given(times=st.lists(st.integers(0, 400), min_size=1, max_size=40), chunk=st.sampled_from([60, 3600, 86_400]))
def test_throttle_matches_greedy(spark, times, chunk):
    rows = [("a" if i % 3 else "b", i, i + 1, BASE + t * 1000 + (i % 7), "d") for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "mid string, window_start long, window_end long, ts long, doc_id string")
    got = sorted(tuple(r) for r in alerts.throttle(df, 60, chunk_seconds=chunk).collect())
    last, want = {}, []
    for r in sorted(rows, key=lambda r: (r[0], r[3], r[1])):
        s = r[3] // 1000
        if r[0] not in last or s - last[r[0]] >= 60:
            want.append(r)
            last[r[0]] = s
    assert got == sorted(want)


def _round1(count, total):
    import math

    return 0.0 if total == 0 else math.floor(count * 1000.0 / total + 0.5) / 10.0


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["d1", "d2"]), st.integers(0, 45),
                               st.sampled_from(["M", "F", None])), min_size=1, max_size=40),
       top=st.integers(1, 4))
def test_shares_and_facets_match_brute_force(spark, rows, top):
    from shoplens.operators import search

    df = spark.createDataFrame(rows, "dt string, user_age int, user_gender string")
    ages = {r.dt: (r.total, r.under_20, r.from_20_to_30, r.over_30) for r in search.age_shares(df).collect()}
    genders = {r.dt: (r.total, r.male, r.female) for r in search.gender_shares(df).collect()}
    topped = {r.dt: (r.under_20, r.over_30) for r in search.age_shares(df, exact=False, top_n=top).collect()}
    facets = sorted((r.dt, r.user_age, r.doc_count, r.rank) for r in search.facet(df, "user_age", top).collect())
    want_facets = []
    for d in sorted({r[0] for r in rows}):
        sel = [r for r in rows if r[0] == d]
        n = len(sel)
        low = _round1(sum(1 for r in sel if r[1] < 20), n)
        high = _round1(sum(1 for r in sel if r[1] > 30), n)
        assert ages[d] == (n, low, float(int(100.0 - low - high + 0.5)), high)
        assert genders[d] == (n, _round1(sum(1 for r in sel if r[2] == "M"), n),
                              _round1(sum(1 for r in sel if r[2] == "F"), n))
        counts = {}
        for r in sel:
            counts[r[1]] = counts.get(r[1], 0) + 1
        ranked = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:top]
        want_facets += [(d, a, c, i + 1) for i, (a, c) in enumerate(ranked)]
        assert topped[d] == (_round1(sum(c for a, c in ranked if a < 20), n),
                             _round1(sum(c for a, c in ranked if a > 30), n))
    assert facets == sorted(want_facets)
