"""The segmented scan of positions against one fold over the whole track."""

import random

import pytest
from pyspark.sql import functions as F

from waymark.operators import position as P
from waymark.operators import scan

PLACES = {
    "port": P.Place("node", (0, 5), confirmed=True), "bay": P.Place("node", (2,)), "city": P.Place("node", (1, 3, 4)), "inn": P.Place("micro", parent="city"), "hut": P.Place("micro", parent="gone"),
    "deck": P.Place("local"), "reef": P.Place("waypoint", leg=2, along=0.4), "edge": P.Place("waypoint", leg=4, along=0.95), "far": P.Place("off_route"),
}
ROUTE = P.Route(5, PLACES)
KEYS = [*PLACES, "nowhere", None]
COLUMNS = "chapter int, seq int, track string, at string, start string, end string, at_name string, start_name string, end_name string, evidence string"


def stage(rng, track, chapters, keys, often):
    rows = []
    for c in range(1, chapters + 1):
        for n in range(rng.choice(often)):
            at, start, end = (rng.choice(keys) for _ in range(3))
            at = at if rng.random() < 0.6 else None
            rows.append((c, n, track, at, start, end, at, start, end, f"{track}{c}.{n}"))
    return rows


def plain(rows, there, chapters, track):
    """One fold over all chapters."""
    held, since, out = None, None, []
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    for c in range(1, chapters + 1):
        own = [dict(zip(names, r, strict=True)) for r in rows if r[0] == c and r[2] == track]
        found = P._chapter(ROUTE, own, [v for v in there if v["chapter"] == c], held)
        if found is None:
            found = {"point": held, "source": "carried" if held else "unknown", "place": None, "flags": ["on_stage_unplaced"] if own and held else [], "evidence": None}
        since = c if found["source"] in ("stated", "inferred") else since
        held = found["point"]
        out.append((track, c, held and held[0], held and held[1], found["source"], found["place"], since if held else None, found["flags"], found["evidence"]))
    return out


@pytest.mark.parametrize("block", [1, 2, 7, 4096])
def test_blocks_are_one_fold(spark, block):
    rng = random.Random(7)
    kinds = {"all": (KEYS, [0, 1, 2]), "carry": (["deck", None], [0, 1]), "cities": (["city", "port", "inn", "deck"], [1]), "transit": ([None, "bay", "city", "edge", "deck"], [1]), "rare": (KEYS, [0, 0, 0, 0, 0, 1]), "off": (KEYS, [0])}
    chapters = 60
    rows = [r for t, (keys, often) in kinds.items() for r in stage(rng, t, chapters, keys, often)]
    there = [{"chapter": c, "seq": 0, "key": rng.choice(KEYS), "name": f"v{c}", "role": rng.choice(["arrival", "setting"]), "evidence": f"e{c}"} for c in range(1, chapters + 1, 3)]
    visited = spark.createDataFrame([tuple(v.values()) for v in there], "chapter int, seq int, key string, name string, role string, evidence string")
    series = P.resolve_positions(spark.createDataFrame(rows, COLUMNS), visited, spark.range(1, chapters + 1).select(F.col("id").cast("int").alias("chapter")), spark.createDataFrame([(t,) for t in kinds], "track string"), ROUTE, block)
    got = sorted(tuple(r) for r in series.select("track", "chapter", "leg", "along", "source", "place", "stated_at", "flags", "evidence").collect())
    want = sorted(x for t in kinds for x in plain(rows, there, chapters, t))
    assert got == want


def test_a_long_track(spark):
    """A track of 20,000 chapters in many blocks, most of which only carry or compare."""
    rows = [(c, 0, "one", ("city", "deck", "port")[c % 3] if c % 5 else None, None, None, None, None, None, None) for c in range(1, 20_001) if c % 2]
    visited = spark.createDataFrame([], "chapter int, seq int, key string, name string, role string, evidence string")
    chapters = spark.range(1, 20_001).select(F.col("id").cast("int").alias("chapter"))
    run = lambda block: P.resolve_positions(spark.createDataFrame(rows, COLUMNS), visited, chapters, spark.createDataFrame([("one",)], "track string"), ROUTE, block)
    few, one = run(500), run(1 << 20)
    assert few.count() == 20_000 and few.exceptAll(one).count() == 0


def test_summaries_are_small():
    """Chapters that only compare become one map, however many there are."""
    cells = P.Cells(ROUTE)
    on = lambda key: ([{"at": key, "start": None, "end": None, "at_name": key, "start_name": None, "end_name": None, "evidence": None}], [])
    steps = P._summary(ROUTE, cells, [on(k) for k in ["city", "deck", "port", "inn"] * 200])
    assert len(steps) == 1 and len(steps[0]["moves"]) == len(cells.members)


def test_groups_across_batches(spark):
    """Groups that go on in the next batch are one group, and many of them are one batch: none is a data frame of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        rows = spark.range(50).selectExpr("cast(id % 4 as string) track", "id div 20 block", "id chapter")
        given = P._in_runs(rows, ["track", "block"], "chapter", lambda own: [(own[0]["track"], own[0]["block"], [r["chapter"] for r in own])], "track string, block long, chapters array<long>")
        got = {(r.track, r.block): r.chapters for r in given.collect()}
    finally:
        spark.conf.set(key, old)
    assert got == {(str(t), b): [i for i in range(50) if i % 4 == t and i // 20 == b] for t in range(4) for b in range(3)}
    assert "FlatMapGroupsInPandas" not in given._jdf.queryExecution().executedPlan().toString()


def test_groups_after_a_join_by_their_keys(spark):
    """A join by the same keys that turns out to be a broadcast is read by mappers; a group is whole and in order still."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "64KB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(4000, numPartitions=4).selectExpr("cast(id % 40 as string) track", "id div 2000 block", "4000 - id chapter")
        few = spark.range(100_000).filter("id < 80").selectExpr("cast(id % 40 as string) track", "id div 40 block", "id as entered")
        given = P._in_runs(rows.join(few, ["track", "block"]), ["track", "block"], "chapter", lambda own: [(own[0]["track"], own[0]["block"], [r["chapter"] for r in own])], "track string, block long, chapters array<long>")
        got = sorted((r.track, r.block, r.chapters) for r in given.collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted((str(t), b, sorted(4000 - i for i in range(4000) if i % 40 == t and i // 2000 == b)) for t in range(40) for b in range(2))


def test_the_same_chapters_are_reckoned_once(monkeypatch):
    cells, calls, real = P.Cells(ROUTE), [], P._chapter
    monkeypatch.setattr(P, "_chapter", lambda *a: calls.append(1) or real(*a))
    on = lambda key: ([{"at": key, "start": None, "end": None, "at_name": key, "start_name": None, "end_name": None, "evidence": None}], [])
    chapters = [on(k) for k in ["deck", "port"] * 400]
    plain = P._summary(ROUTE, cells, chapters)
    calls.clear()
    assert P._summary(ROUTE, cells, chapters, {}) == plain
    assert len(calls) <= 2 * sum(len(m) for m in cells.members)


def test_states_of_many_rows(spark):
    """One key has nearly all rows, spread over many ranges; a null key and ids over 2 ** 53 are as good as others."""
    rng = random.Random(9)
    rows = [(k, big + n, rng.randrange(4)) for k, count, big in ((None, 40, 0), (1, 3000, (1 << 53) + 1), (2, 1, 0)) for n in range(count)]
    df = spark.createDataFrame(rows, "k long, n long, x int").repartition(5)
    moves = F.array(*[F.when(F.col("x") == 0, s).when(F.col("x") == 1, (s + 1) % 5).when(F.col("x") == 2, 3).otherwise(F.lit(4 - s)) for s in range(5)])
    got = sorted((tuple(r) for r in scan.state_scan(df, "k", ["n"], moves, 5, first=2).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = []
    for key in (1, 2, None):
        state = 2
        for k, n, x in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            state = (state, (state + 1) % 5, 3, 4 - state)[x]
            want.append((k, n, x, state))
    assert got == want
    assert scan.state_scan(df.limit(0), "k", ["n"], moves, 5).count() == 0
