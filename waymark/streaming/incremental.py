"""Records that arrive over time: files of a folder are validated as they come, and review rows merged.

Nothing here is needed for a batch; it is the same operators over a stream of files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waymark.operators import evidence, extraction


def incoming_records(spark: SparkSession, path: str) -> DataFrame:
    """A stream of ``number, record, error`` from files such as ``chapter_07.json`` in a folder."""
    files = spark.readStream.format("text").option("wholetext", True).load(path)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)\.\w+$", 1).try_cast("int")
    return extraction.load(files.select(number.alias("number"), F.col("value").alias("text")))


def check_stream(records: DataFrame, texts: DataFrame) -> DataFrame:
    """A stream of verdicts: every quotation of the incoming records held against its chapter (``number, text``)."""
    rows = extraction.evidence_rows(records.filter("error is null"))
    return evidence.check_quotes(rows.join(texts, "number")).drop("text")


def merge_stream(rows: DataFrame, merge: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Hand each micro-batch of proposals to a merge (such as ``review.merge_rows`` and a write), once it has all come."""
    return rows.writeStream.foreachBatch(lambda batch, _: merge(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
