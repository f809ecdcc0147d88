"""Operators that don't look at everything, against ones that do."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from waymark.functions import text as K

from waymark.operators import containment as C
from waymark.operators import nearest as N
from waymark.operators import quantiles as Q
from waymark.operators import resolve as R
from waymark.operators import similar as S
from waymark.plans import registry


def km(a, b):
    la, oa, lb, ob = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - oa) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, h)))


@pytest.mark.parametrize("crowd", [1, 32])
def test_nearest(spark, monkeypatch, crowd):
    """Poles, the antimeridian, a crowd of anchors far from most points, one place many times, points without a place."""
    monkeypatch.setattr(N, "CROWD", crowd)
    rng = random.Random(1)
    anchors = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(25)] + [(48.8 + rng.uniform(0, 0.05), 2.3 + rng.uniform(0, 0.05)) for _ in range(120)] + [(90.0, 10.0), (-90.0, 0.0), (0.0, 179.99)] + [(10.0, 10.0)] * 50
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)] + [(89.9, -170.0), (-89.99, 100.0), (0.1, -179.99), (48.82, 2.31), (10.0, 10.0)]
    rows = [(k, *p) for k, p in enumerate(points)] + [(900, None, 1.0)]
    got = {r.k: r.nearest_km for r in N.nearest(spark.createDataFrame(rows, "k int, lat double, lon double"), spark.createDataFrame([*anchors, (None, 3.0)], "lat double, lon double")).collect()}
    assert got.pop(900) is None
    for k, p in enumerate(points):
        assert got[k] == pytest.approx(min(km(p, a) for a in anchors), abs=1e-6), p
    assert [r.nearest_km for r in N.nearest(spark.createDataFrame(rows[:2], "k int, lat double, lon double"), spark.createDataFrame([], "lat double, lon double")).collect()] == [None, None]


def test_containment(spark):
    rng = random.Random(2)
    up = {0: None, **{k: k - 1 for k in range(1, 200)}, **{k: rng.randrange(k) for k in range(200, 320)}, 400: 401, 401: 402, 402: 400, 403: 401, 404: 404, 405: 999, 406: 405}
    rows = [(k, p) for k, p in up.items()] + [(None, 3), (7, 6), (7, 100)]
    got = {r.key: (r.root, r.depth, r.problem) for r in C.containment(spark.createDataFrame(rows, "key long, parent long")).collect()}
    want = {}
    for k in up:
        at, n = k, 0
        while at in up and up[at] is not None and n <= len(up):
            at, n = up[at], n + 1
        want[k] = (None, None, "cycle") if n > len(up) else (at, n, None if at in up else "orphan")
    assert got == want
    assert C.containment(spark.createDataFrame([], "key long, parent long")).count() == 0


@pytest.mark.parametrize("most", [4, 1 << 16])
def test_exact_quantiles(spark, monkeypatch, most):
    monkeypatch.setattr(Q, "MOST", most)
    rng = random.Random(3)
    groups = {"many": [rng.gauss(0, 1e6) for _ in range(3000)], "ties": [float(rng.randrange(3)) for _ in range(500)], "wide": [10.0 ** rng.randrange(-300, 300) for _ in range(300)], "one": [5.0], "two": [1.0, 2.0], None: [7.0, 7.0, 9.0]}
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("many", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {(r.g, r.p): r.value for r in Q.exact_quantiles(df, "x", [0.0, 0.5, 0.9, 1.0], by="g").collect()}
    for g, xs in groups.items():
        assert got[g, 0.5] == statistics.median(xs) and got[g, 0.0] == min(xs) and got[g, 1.0] == max(xs)
        at = 0.9 * (len(xs) - 1)
        low, high = sorted(xs)[math.floor(at)], sorted(xs)[math.ceil(at)]
        assert got[g, 0.9] == pytest.approx(low + (high - low) * (at - math.floor(at)), rel=1e-12)
    assert ("none", 0.5) not in got and len(got) == 4 * len(groups)
    whole = [x for xs in groups.values() for x in xs]
    assert [r.value for r in Q.exact_quantiles(df, "x", [0.5]).collect()] == [statistics.median(whole)]
    assert Q.exact_quantiles(df.filter(F.lit(False)), "x", [0.5], by="g").count() == 0


@pytest.mark.parametrize("least", [60.0, 75.0, 90.0])
def test_similar_names(spark, least):
    rng = random.Random(5)
    stems = ["bombay", "new york", "san francisco", "aa", "ab", "a", "mississippi river landing", "port of hong kong", "suez", "yokohama", "kholby", "allahabad station house"]
    letters = "abcdeins "

    def spoiled(name):
        out = list(name)
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(out) + 1)
            if rng.random() < 0.5 and out:
                del out[min(at, len(out) - 1)]
            else:
                out.insert(at, rng.choice(letters))
        return "".join(out)

    left = [spoiled(rng.choice(stems)) for _ in range(120)] + ["SUEZ", None, ""]
    right = [spoiled(rng.choice(stems)) for _ in range(120)] + ["suez", "Suez", None, "  "]
    df = lambda xs: spark.createDataFrame([(x,) for x in xs], "name string")
    keys = lambda xs: {" ".join(x.split()).casefold() for x in xs if x and x.strip()}
    got = {(r.left_key, r.right_key): r.ratio for r in S.similar_names(df(left), df(right), least=least).collect()}
    want = {(a, b): K._indel(a, b) for a in keys(left) for b in keys(right)}
    assert got == {k: v for k, v in want.items() if v >= least} and len(got) > 40


@pytest.mark.parametrize("hot_keys", [1, 3, 1000])
def test_quantiles_of_hot_keys(spark, monkeypatch, hot_keys):
    """A key with most rows meets its brackets by broadcast, the others by a shuffle; the result is the same."""
    monkeypatch.setattr(Q, "MOST", 16)
    monkeypatch.setattr(Q, "HOT_KEYS", hot_keys)
    rng = random.Random(8)
    groups = {"hot": [rng.random() for _ in range(2000)], None: [rng.random() for _ in range(900)], "cold": [rng.random() for _ in range(60)], "one": [3.0]}
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "g string, x double").repartition(4)
    got = {(r.g, r.p): r.value for r in Q.exact_quantiles(df, "x", [0.0, 0.5, 1.0], by="g").collect()}
    assert got == {(g, p): v for g, xs in groups.items() for p, v in ((0.0, min(xs)), (0.5, statistics.median(xs)), (1.0, max(xs)))}


def test_no_task_gets_a_hot_key(spark):
    """The rows of a hot key aren't shuffled by it."""
    rows = spark.range(100).selectExpr("id % 2 as key", "id % 2 = 0 as hot", "cast(id as double) v")
    values = spark.range(2).selectExpr("id as key", "id = 0 as hot", "id as lo")
    given = Q._attach(rows, values, ["key", "hot"])
    assert given.count() == 100 and "BroadcastHashJoin" in given._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("cell", [3, 1 << 16])
def test_two_nearest_on_a_ring(spark, monkeypatch, cell):
    """Against all pairs: both directions, ties, repeated places, levels with one candidate, groups of one side, many cells."""
    monkeypatch.setattr(R, "RING_PLACES", cell)
    monkeypatch.setattr(R, "RING_CANDIDATES", cell)
    rng = random.Random(11)
    places = [(rng.randrange(4), k, rng.randrange(-500, 500)) for k in range(60)] + [(0, 60, None), (9, 61, 5)]
    candidates = [(rng.randrange(4), rng.choice([1, 1, 1, 2]), k, rng.randrange(-500, 500)) for k in range(80)] + [(0, 3, 80, 7), (8, 1, 81, 0), (1, 1, 82, None)]
    of = [spark.createDataFrame(places, "by int, key long, at long"), spark.createDataFrame(candidates, "by int, level int, qid long, at long")]
    got = {tuple(r) for r in R.two_nearest_on_ring(*of, ["by"], "key", "qid", 37).collect()}
    for by, key, at in places:
        for level in (1, 2, 3):
            own = [(abs(at - v) % 37, -q) for b, n, q, v in candidates if (b, n) == (by, level) and v is not None] if at is not None else []
            assert {(key, -q) for _, q in sorted(own)[:2]} <= got
    assert cell < 100 or len(got) <= 2 * 3 * len(places)


def test_leading_levels(spark):
    rows = [("a", 1.0, 1), ("a", 0.5, 2), ("a", 0.5, 3), ("a", 0.2, 4), ("b", 0.5, 5), ("b", 0.5, 6), ("b", 0.2, 7), ("c", 0.1, 8)]
    got = {(r.by, r.id): r.level for r in R.leading(spark.createDataFrame(rows, "by string, x double, id int"), ["by"], ["x"]).collect()}
    assert got == {("a", 1): 1, ("a", 2): 2, ("a", 3): 2, ("b", 5): 1, ("b", 6): 1, ("c", 8): 1}


def test_ranking_makes_no_pairs(spark, tmp_path):
    """Customers and suppliers of one nation that would be 4,000,000 pairs: they are searched in cells, not joined."""
    spark.range(4000).selectExpr("id as c_custkey", "3L as c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1000).selectExpr("id as s_suppkey", "3L as s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    found = registry.queries()["candidate_ranking"](spark, str(tmp_path))
    assert len(found.collect()) == 4000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "ShuffledHashJoin" not in plan
