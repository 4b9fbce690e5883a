"""As-of joins, frames by time and span joins against brute force, over cells of any length."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from hourcast.operators import cells as C
from hourcast.operators.asof import asof_join
from hourcast.operators.ranges import range_stats
from hourcast.operators.spans import overlap_join, span_join

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- as-of join ---------------------------------------------------------------------

def asof_data(seed):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", None])
    time = lambda: rng.choice([None, *range(0, 40), 5000, 5001, 90000])
    left = [(i, key(), time()) for i in range(120)] + [(7, "hot", 3), (7, "hot", 3)]
    right = [(key(), time(), rng.choice([1.0, 2.0, None])) for _ in range(80)] + [("c", 1, 1.0)]
    return left, right


def asof_brute(left, right, allow_exact=True, tolerance=None, how="left"):
    out = []
    for i, k, t in left:
        fits = [(rt, v is not None, v or 0, v) for rk, rt, v in right
                if None not in (k, t, rk, rt) and rk == k and (rt <= t if allow_exact else rt < t)]
        best = max(fits, key=lambda x: x[:3], default=None)
        if best and tolerance is not None and t - best[0] > tolerance:
            best = None
        if best or how == "left":
            out.append((i, k, at(t), at(best[0]) if best else None, best[3] if best else None))
    return sorted(out, key=str)


def asof_frames(spark, left, right, kind="timestamp"):
    lf = spark.createDataFrame([(i, k, at(t)) for i, k, t in left], f"id int, k string, t {kind}")
    rf = spark.createDataFrame([(k, at(t), v) for k, t, v in right], f"k string, rt {kind}, v double")
    return lf, rf


@pytest.mark.parametrize("cell", [dt.timedelta(minutes=1), dt.timedelta(minutes=7), dt.timedelta(days=400), None])
@pytest.mark.parametrize("kw", [{}, {"allow_exact": False}, {"tolerance": 9}, {"how": "inner"}])
def test_asof_equals_brute_force(spark, cell, kw):
    left, right = asof_data(len(kw) + 1)
    want = asof_brute(left, right, **kw)
    if "tolerance" in kw:
        kw = {"tolerance": dt.timedelta(minutes=kw["tolerance"])}
    assert rows_of(asof_join(*asof_frames(spark, left, right), "k", "t", "rt", cell=cell, **kw)) == want


def test_asof_over_many_cells_and_levels(spark, monkeypatch):
    """More cells than are settled together."""
    monkeypatch.setattr(C, "FAN", 3)
    left, right = asof_data(8)
    got = asof_join(*asof_frames(spark, left, right, "timestamp_ntz"), "k", "t", "rt", cell=dt.timedelta(minutes=2))
    assert rows_of(got) == asof_brute(left, right)


def test_asof_by_number_with_chosen_columns(spark):
    left = spark.createDataFrame([(1, 5), (1, 9), (2, 5)], "k int, n long")
    right = spark.createDataFrame([(1, 5, "x", 0), (1, 7, "y", 0), (2, 6, "z", 0)], "k int, m long, v string, n int")
    got = asof_join(left, right, "k", "n", "m", columns=["v"], cell=2)
    assert rows_of(got) == [(1, 5, "x"), (1, 9, "y"), (2, 5, None)]
    with pytest.raises(ValueError):
        asof_join(left, right, "k", "n", "m")


def test_asof_of_empty_tables(spark):
    lf, rf = asof_frames(spark, [(1, "a", 1)], [("a", 1, 2.0)])
    assert rows_of(asof_join(lf, rf.filter("false"), "k", "t", "rt")) == [(1, "a", at(1), None, None)]
    assert rows_of(asof_join(lf.filter("false"), rf, "k", "t", "rt")) == []


# --- frames by time ---------------------------------------------------------------------

def range_data(seed):
    rng = random.Random(seed)
    value = lambda: rng.choice([1.5, -2.25, 1000.0, 0.0, None])
    rows = [(i, rng.choice(["hot", "hot", "a", None]), rng.choice([None, *range(50), 3000, 3010]), value())
            for i in range(150)]
    return rows + [(900, "hot", 60, math.nan), (901, "hot", 61, math.inf), (902, "hot", 62, -math.inf),
                   (903, "a", 3005, math.inf), (904, "b", 1, None)]


def range_brute(rows, span):
    out = []
    for i, k, t, v in rows:
        frame = [x for _, rk, rt, x in rows if rk == k and x is not None
                 and (rt is None if t is None else rt is not None and t - span <= rt <= t)]
        total = sum(frame) if frame else None
        out.append((i, k, at(t), v, total, len(frame), total / len(frame) if frame else None))
    return sorted(out, key=str)


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("span,cell", [(10, 3), (10, 1), (3, 20), (0, 5), (10, None), (100000, 7)])
def test_range_equals_brute_force(spark, span, cell):
    rows = range_data(span)
    df = spark.createDataFrame([(i, k, at(t), v) for i, k, t, v in rows], "id int, region string, ts timestamp, v double")
    got = rows_of(range_stats(df, "v", dt.timedelta(minutes=span), cell=cell and dt.timedelta(minutes=cell)))
    want = range_brute(rows, span)
    assert len(got) == len(want)
    by_id = {r[0]: r for r in want}
    for g in got:
        assert all(close(x, y) for x, y in zip(g, by_id[g[0]])), (g, by_id[g[0]])


def test_range_of_whole_numbers_is_exact(spark, monkeypatch):
    monkeypatch.setattr(C, "FAN", 3)
    big = 2 ** 62
    df = spark.createDataFrame([(n, big if n % 2 else 3) for n in range(40)], "n long, v long")
    df = df.withColumn("k", F.lit(1))
    got = {r.n: (int(r.s), r.c) for r in range_stats(df, "v", 4, keys="k", order="n", sum_name="s", count_name="c",
                                                   cell=3).collect()}
    vals = [big if n % 2 else 3 for n in range(40)]
    assert got == {n: (sum(vals[max(0, n - 4):n + 1]), min(n + 1, 5)) for n in range(40)}
    with pytest.raises(TypeError):
        range_stats(df.withColumn("v", F.lit("x")), "v", 4, keys="k", order="n", cell=3)


def test_range_agrees_with_sparks_own_frame(spark):
    from pyspark.sql import Window
    df = spark.range(3000).select((F.col("id") % 7).alias("k"), (F.col("id") * F.col("id") % 1009).alias("n"),
                                  (F.col("id") % 13).alias("v"))
    w = Window.partitionBy("k").orderBy("n").rangeBetween(-50, 0)
    want = df.select("k", "n", "v", F.sum("v").over(w).cast("decimal(38,0)").alias("s"), F.count("v").over(w).alias("c"))
    got = range_stats(df, "v", 50, keys="k", order="n", sum_name="s", count_name="c", cell=16).drop("v_mean")
    assert rows_of(got) == rows_of(want)


def test_range_of_empty_table(spark):
    df = spark.createDataFrame([], "region string, ts timestamp, v double")
    assert range_stats(df, "v", dt.timedelta(hours=1)).collect() == []


# --- spans --------------------------------------------------------------------------------

def span_data(seed, n=60):
    rng = random.Random(seed)

    def one(i):
        start = rng.choice([None, *range(-50, 400)])
        length = rng.choice([0, 0, 1, 3, 30, 300, 40000, -5, None])
        end = None if start is None or length is None else start + length
        return i, rng.choice(["hot", "hot", "a", None]), start, end
    return [one(i) for i in range(n)], [one(i) for i in range(n)]


def span_frames(spark, a, b):
    make = lambda rows, p: spark.createDataFrame(
        [(i, k, at(s), at(e)) for i, k, s, e in rows], f"{p} int, k string, s timestamp, e timestamp")
    return make(a, "ia"), make(b, "ib")


def usable(r):
    return None not in r[1:] and r[2] <= r[3]


def pairs_brute(a, b, touching):
    def meets(x, y):
        lo, hi = max(x[2], y[2]), min(x[3], y[3])
        if touching:
            return lo <= hi
        # closed at the start, open at the end; a span of no length is a point
        inside = lambda p, q: q[2] <= p[2] < q[3] or p[2] == q[2] == q[3]
        if x[2] == x[3]:
            return inside(x, y)
        if y[2] == y[3]:
            return inside(y, x)
        return lo < hi
    return sorted((x[0], y[0]) for x in a for y in b if usable(x) and usable(y) and x[1] == y[1] and meets(x, y))


@pytest.mark.parametrize("touching", [True, False])
@pytest.mark.parametrize("cell", [1, 10, 100000])
def test_overlaps_equal_brute_force(spark, touching, cell):
    a, b = span_data(cell)
    got = overlap_join(*span_frames(spark, a, b), "k", ("s", "e"), ("s", "e"), touching=touching,
                       cell=dt.timedelta(minutes=cell))
    assert got.columns == ["ia", "k", "s", "e", "ib", "s_right", "e_right"]
    assert sorted((r.ia, r.ib) for r in got.collect()) == pairs_brute(a, b, touching)


@pytest.mark.parametrize("end_included", [True, False])
def test_points_in_spans(spark, end_included):
    a, b = span_data(77)
    points = [(i, k, s, s) for i, k, s, _ in a]
    pf, sf = span_frames(spark, points, b)
    got = span_join(pf.drop("e"), sf, "k", "s", ("s", "e"), end_included=end_included, cell=dt.timedelta(minutes=2))
    want = sorted((p[0], q[0]) for p in points for q in b if usable(p) and usable(q) and p[1] == q[1]
                  and q[2] <= p[2] and (p[2] <= q[3] if end_included else p[2] < q[3]))
    assert sorted((r.ia, r.ib) for r in got.collect()) == want


def test_repeated_spans_and_empty_tables(spark):
    a = spark.createDataFrame([(1, 5), (1, 5)], "k int, n long")
    b = spark.createDataFrame([(1, 0, 9)] * 3, "k int, lo long, hi long")
    assert span_join(a, b, "k", "n", ("lo", "hi"), cell=2).count() == 6
    assert span_join(a, b.filter("false"), "k", "n", ("lo", "hi"), cell=2).count() == 0
    assert span_join(a.filter("false"), b, "k", "n", ("lo", "hi"), cell=2).count() == 0


def test_no_nested_loop_and_few_copies(spark):
    a, b = span_data(5)
    got = overlap_join(*span_frames(spark, a, b), "k", ("s", "e"), ("s", "e"), cell=dt.timedelta(minutes=1))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # a span of 40000 cells is dealt to a handful
    from hourcast.operators import spans as S
    lf = spark.createDataFrame([("x", 0, 40000)], "k string, s long, e long")
    side = S._side(lf, ["k"], "s", "e", 1, "a")
    assert S._dealt(side, "a", [0, 1, 2], 1).count() <= S.TOUCH
