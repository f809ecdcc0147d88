"""A stream of chapters in any split and order against one pass over all of them."""

import random

import pytest

from waymark.streaming import positions as S

ROWS = "track string, chapter int, leg int, along double"


def run_stream(spark, tmp_path, batches, horizon):
    source, seen = tmp_path / "in", []
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", S.STORE)
    source.mkdir()
    query = S.carry_stream(spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).json(str(source)), horizon)
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, ROWS).coalesce(1).write.mode("append").json(str(source))
        stream = query.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "checkpoint")).foreachBatch(lambda b, _: seen.extend(b.collect())).trigger(availableNow=True).start()
        stream.awaitTermination(120)
    return spark.createDataFrame([tuple(r) for r in seen], S.SERIES)


def rows_of(rng, tracks=3, chapters=12):
    return [(f"t{t}", c, rng.randrange(6) if rng.random() < 0.6 else None, rng.choice([0.0, 0.5, None])) for t in range(tracks) for c in range(1, chapters + 1)]


@pytest.mark.parametrize(("split", "horizon", "shuffled"), [([1.0], 0, False), ([0.3, 0.6, 1.0], 0, False), ([0.2, 0.5, 0.8, 1.0], 99, True)])
def test_any_split_gives_the_batch_result(spark, tmp_path, split, horizon, shuffled):
    rng = random.Random(4)
    rows = sorted(rows_of(rng), key=lambda r: r[1])
    want = sorted(map(tuple, S.carried_series(spark.createDataFrame(rows, ROWS)).collect()))
    if shuffled:
        rng.shuffle(rows)
    cuts = [0, *[int(x * len(rows)) for x in split]]
    emitted = run_stream(spark, tmp_path, [rows[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], horizon)
    assert emitted.filter("rule = 'late'").count() == 0
    assert sorted(map(tuple, S.latest(emitted).collect())) == want


def test_late_rows(spark, tmp_path):
    emitted = run_stream(spark, tmp_path, [[("a", 1, 0, 0.0), ("a", 9, 3, 0.0)], [("a", 8, 2, 0.0), ("a", 2, 1, 0.0), ("a", 10, None, None)]], 4)
    assert [(r.chapter, r.leg) for r in emitted.filter("rule = 'late'").collect()] == [(2, None)]
    got = sorted(map(tuple, S.latest(emitted).collect()))
    assert got == [("a", 1, 0, 0.0, 1, None), ("a", 8, 2, 0.0, 8, "jumps_legs"), ("a", 9, 3, 0.0, 9, None), ("a", 10, 3, 0.0, 9, None)]
