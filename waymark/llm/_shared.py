"""What the operators of this subpackage share: the shared folder, tables that cut lineage, files, hot keys.

Executors may be lost at any time, and they share no local disk. Whatever one job leaves for another therefore goes
to the folder that the cluster names in ``spark.checkpoint.dir``: DataFrames as Parquet (``materialise``), other files
through ``pyarrow.fs`` (``open_output``/``open_input``), so that ``file:``, ``hdfs:``, ``s3:`` and ``gs:`` all work.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch. Texts may be long: a batch should hold some tens of megabytes.
BATCH_ROWS = 512
#: A key is hot if it holds more than one in so many rows; so there are fewer than this many hot keys.
HOT_KEYS = 1000


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers receive (the default of 10,000 long texts is too much)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where that is unset, and only on one machine (tests), a temporary one."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a folder that all of its machines share")
        root = f"file://{(own := tempfile.mkdtemp(prefix='waymark-'))}"
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name in this session's part of the shared folder, which goes when the driver ends."""
    run = f"{shared_root(spark)}/waymark/{spark.sparkContext.applicationId}"
    if run not in _RUNS:
        _RUNS.add(run)
        atexit.register(_remove, run)
    return f"{run}/{label}-{uuid.uuid4().hex}"


_RUNS: set[str] = set()


def _remove(uri: str) -> None:
    system, path = _filesystem(uri)
    with contextlib.suppress(OSError):  # there may be nothing, or the store may be gone
        system.delete_dir(path)


#: Whether the shuffle files of a job go when it ends, and not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialise(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write a DataFrame to the shared folder and read it back: computed once, and safe when executors are lost.

    What was shuffled for it is removed at once, so the disk has one job's shuffles at a time.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove tables that ``materialise`` gave and that nothing reads any more: all that was made of them is written."""
    for df in tables:
        _remove(_PATHS.pop(df))


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def open_output(uri: str):
    """A binary stream that writes a new file, folders included."""
    system, path = _filesystem(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A seekable binary stream that reads a file."""
    system, path = _filesystem(uri)
    return system.open_input_file(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attach(rows: DataFrame, values: DataFrame, key: str, counts: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``values`` (one row a key, every key of ``rows`` in it), whatever the key's skew.

    Keys with more than ``total / HOT_KEYS`` rows - at most ``HOT_KEYS`` of them, by count - are broadcast; the others
    are joined by a shuffle in which no key can be large. Column ``counts`` of ``values`` is the number of rows of a key.
    """
    hot_over = total // HOT_KEYS
    hot = values.filter(F.col(counts) > hot_over).drop(counts).withColumn("_hot", F.lit(True))
    tagged = rows.join(F.broadcast(hot), key, "left")
    warm = tagged.filter("_hot").drop("_hot")
    cold = tagged.filter("_hot is null").select(*rows.columns).join(values.filter(F.col(counts) <= hot_over).drop(counts), key)
    return warm.unionByName(cold)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


#: Bits of a map of keys, and of one of its rows.
MAP_BITS, ROW_BITS = 1 << 26, 1 << 15


def flagged(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_may``: whether the key has its bit in a map of the keys ``wanted``, as all of those have, and few others.

    The map has ``MAP_BITS`` bits whatever the input, in rows of ``ROW_BITS``, and is broadcast. When very many keys are
    wanted it lets more pass, and nothing else changes: what follows is a join on the key itself.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(MAP_BITS))
    bits = wanted.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / ROW_BITS).alias("_map_row")).agg(F.bitmap_construct_agg(F.col("bit") % ROW_BITS).alias("_map"))
    at = rows.withColumn("_bit", bit).withColumn("_map_row", F.floor(F.col("_bit") / ROW_BITS)).join(F.broadcast(bits), "_map_row", "left")
    place = (F.col("_bit") % ROW_BITS).cast("int")
    byte = F.conv(F.hex(F.substring("_map", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return at.select(*rows.columns, F.coalesce(F.getbit(byte, place % 8) == 1, F.lit(False)).alias("_may"))


def marked(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` that are ``flagged``."""
    return flagged(rows, wanted, key).filter("_may").drop("_may")
