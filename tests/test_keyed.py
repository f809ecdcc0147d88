"""Tables by ranges of a key: what a build rewrites, and what readers see."""

import pytest
from pyspark.sql import functions as F

from waymark.sources import keyed


def table(spark, n=1000):
    return spark.range(n).select("id", F.concat(F.lit("näme "), "id").alias("name"), F.when(F.col("id") % 7 > 0, F.col("id") / 4).alias("x"), F.array(F.col("id"), F.lit(None).cast("long")).alias("list"))


def test_only_what_changed_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    df = table(spark)
    assert keyed.write_keyed(df, path, "id", rows_each=100) == 10
    read = lambda: sorted(map(tuple, keyed.read_keyed(spark, path).collect()), key=str)
    assert read() == sorted(map(tuple, df.collect()), key=str)
    assert keyed.write_keyed(df.repartition(7), path, "id") == 0 and keyed.manifest(spark, path)["number"] == 1
    changed = df.withColumn("name", F.when(F.col("id") == 555, "new").otherwise(F.col("name")))
    assert keyed.write_keyed(changed, path, "id") == 1 and read() == sorted(map(tuple, changed.collect()), key=str)
    fewer = changed.filter("id >= 150").unionByName(changed.filter("id = 999"))
    assert keyed.write_keyed(fewer, path, "id") == 3 and read() == sorted(map(tuple, fewer.collect()), key=str)
    assert keyed.write_keyed(fewer.limit(0), path, "id") > 0 and read() == []
    assert keyed.write_keyed(fewer.drop("x"), path, "id", rows_each=300) >= 3 and keyed.read_keyed(spark, path).columns == ["id", "name", "list"]


def test_text_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    df = table(spark, 200).withColumn("name", F.when(F.col("id") > 2, F.col("name")))
    assert keyed.write_keyed(df, path, "name", rows_each=50) == 4 and keyed.write_keyed(df, path, "name") == 0
    assert keyed.read_keyed(spark, path).exceptAll(df).count() == 0 and keyed.read_keyed(spark, path).count() == 200


def test_builds_that_stop_or_meet(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    keyed.write_keyed(table(spark, 50), path, "id")
    with monkeypatch.context() as m:
        m.setattr(keyed, "_put", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            keyed.write_keyed(table(spark, 60), path, "id")
    assert keyed.read_keyed(spark, path).count() == 50
    with pytest.raises(RuntimeError):
        keyed._put(spark, path, {"number": 1})
    assert keyed.write_keyed(table(spark, 60), path, "id") == 1 and keyed.read_keyed(spark, path).count() == 60
