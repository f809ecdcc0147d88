"""A table in files by ranges of its key, of which a build rewrites only those whose rows have changed.

A manifest names the files of each range with a hash of their rows. A build hashes its own rows by range (commutative sums,
by partial aggregates), writes the ranges that differ to a new folder, and then puts a new manifest in place, by one rename to
the next number. So a build that changes nothing writes nothing, readers see the table before or after a build and
nothing between, and a lost task or a build that stops half-way leaves files that no manifest names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a range, on average, when a table is first written; later builds keep its bounds.
ROWS = 1 << 20
MANIFEST = "manifest-"


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path: whatever store Spark itself reads and writes."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, place.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of the highest number, or null where there is no table."""
    jvm, fs = _files(spark, path)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}*.json"))
    names = sorted(f.getPath().toString() for f in (found or []))
    if not names:
        return None
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(names[-1]))
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _put(spark: SparkSession, path: str, content: dict) -> None:
    """The next manifest, under a name of its own until it is whole. Of two builds at once the second fails."""
    jvm, fs = _files(spark, path)
    own, to = (jvm.org.apache.hadoop.fs.Path(f"{path}/{name}") for name in (f"_{uuid.uuid4().hex}", f"{MANIFEST}{content['number']:09d}.json"))
    stream = fs.create(own, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    if fs.exists(to) or not fs.rename(own, to):
        fs.delete(own, False)
        raise RuntimeError(f"another build has written {to.toString()}")


def _range(key: Column, bounds: list) -> Column:
    """The number of bounds that a key is at or above; nulls are in the first range."""
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= key)), F.lit(0)) if bounds else F.lit(0)


def write_keyed(rows: DataFrame, path: str, key: str, rows_each: int = ROWS) -> int:
    """Write a table; gives the number of ranges that were rewritten.

    Values are hashed as JSON, so all types that JSON holds are told apart; order and repeats of rows don't matter and
    matter, in this order. Rows in a file are in order of the key.
    """
    spark = rows.sparkSession
    old = manifest(spark, path)
    if old and old["schema"] == rows.schema.json() and old["key"] == key:
        bounds = old["bounds"]
    else:
        old_number = old["number"] if old else 0
        ranges = max(1, -(-rows.count() // rows_each))
        cuts = rows.select(F.percentile_approx(F.xxhash64(key), [k / ranges for k in range(1, ranges)], 10_000).alias("c")).first().c if ranges > 1 else []
        kind = rows.schema[key].dataType
        if ranges > 1 and isinstance(kind, T.NumericType):
            cuts = rows.select(F.percentile_approx(key, [k / ranges for k in range(1, ranges)], 10_000).alias("c")).first().c
        bounds, old = sorted(set(cuts)), {"number": old_number, "ranges": {}}
        bounds = [b if isinstance(b, int | float) else float(b) for b in bounds]
    numeric = isinstance(rows.schema[key].dataType, T.NumericType)
    dealt = rows.withColumn("_range", _range(F.col(key) if numeric else F.xxhash64(key), bounds))
    line = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), line).cast("decimal(38,0)")).cast("string")
    hashes = {str(r._range): f"{r.n}:{r.a}:{r.b}" for r in dealt.groupBy("_range").agg(F.count("*").alias("n"), total(1).alias("a"), total(2).alias("b")).collect()}
    changed = [int(k) for k, h in hashes.items() if old["ranges"].get(k, {}).get("hash") != h]
    gone = set(old["ranges"]) - set(hashes)
    if old["number"] and not changed and not gone:
        return 0
    folder = f"build-{uuid.uuid4().hex}"
    if changed:
        some = dealt.filter(F.col("_range").isin(changed))
        some.repartition(len(changed), "_range").sortWithinPartitions("_range", key).write.partitionBy("_range").json(f"{path}/{folder}", ignoreNullFields=False)
    kept = {k: v for k, v in old["ranges"].items() if k in hashes and int(k) not in changed}
    new = {str(k): {"hash": hashes[str(k)], "files": f"{folder}/_range={k}"} for k in changed}
    _put(spark, path, {"number": old["number"] + 1, "schema": rows.schema.json(), "key": key, "bounds": bounds, "ranges": {**kept, **new}})
    return len(changed) + len(gone)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The table as its newest manifest says."""
    now = manifest(spark, path)
    if now is None:
        raise FileNotFoundError(path)
    schema = T.StructType.fromJson(json.loads(now["schema"]))
    places = [f"{path}/{r['files']}" for r in now["ranges"].values()]
    return spark.read.schema(schema).json(places) if places else spark.createDataFrame([], schema)
