"""Secret scans over an incremental blob ledger.

Every version of a text is a blob, named by its SHA-256. The ledger is a table of (blob, rule version) pairs that were
scanned, with their findings. A run scans only the pairs that the ledger doesn't have, each once however many paths
show it, appends them, and joins findings back to all paths.

Edge cases: a null text is the empty blob; paths may repeat and be null; repeated rows give repeated results; a blob of
very many paths is scanned once, and the join that brings its findings back deals its paths evenly; an empty table
gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import attach, flagged, materialise, prepare, shared_dir, text_or_empty

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FOUND = T.ArrayType(SPAN)
LEDGER = T.StructType([T.StructField("blob", T.StringType()), T.StructField("rules", T.StringType()), T.StructField("found", FOUND)])


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose group ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


@dataclass(frozen=True)
class RuleSet:
    version: str
    rules: tuple[Rule, ...] = field(default_factory=tuple)


# The base rules, in the order in which kinds are listed.
BASE = RuleSet(
    "base-1",
    (
        Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
        Rule("access", r"AKIA[A-Z0-9]+", 18),
        Rule("hex", r"[0-9a-f]+", 16),
    ),
)


def _scanner(rules: RuleSet):
    # a run of too few characters fails whichever way it is cut, so a bare class can ask for the length at once
    ready = [(n, r.kind, re.compile(r.pattern[:-1] + f"{{{r.least},}}" if re.fullmatch(r"\[[^\]]*\]\+", r.pattern) else r.pattern, re.ASCII), r.least, r.group) for n, r in enumerate(rules.rules)]

    def scan(text: str) -> list[tuple[str, int, int]]:
        out = [(m.start(), n, kind, m.end()) for n, kind, pattern, least, group in ready for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
        return [(kind, start, end) for start, _, kind, end in sorted(out)]

    return scan


def blobs(docs: DataFrame, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(path, text, blob)``: each version's content address."""
    rows = docs.select(F.col(path_col).alias("path"), text_or_empty(text_col).alias("text"))
    return rows.withColumn("blob", F.sha2("text", 256))


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame:
    """The ledger at a path (any number of earlier runs), or an empty one."""
    return spark.read.schema(LEDGER).parquet(path) if path else spark.createDataFrame([], LEDGER)


def scan_blobs(docs: DataFrame, rules: RuleSet = BASE, ledger: str | None = None, path_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(findings by path, new ledger rows)``.

    ``ledger`` names the Parquet folder of earlier runs; append the second result to it. The first has a row for each
    row of ``docs``: ``path, blob, found`` (spans by start, then by the order of the rules; code points, end exclusive).

    Of the paths of an unseen blob the one of the smallest hash is picked, and only its text reaches a scanner; where
    several rows have that path and text, or the path is null, each task first makes them one, then all do. Hashes are
    shuffled three times, texts once.
    """
    spark = docs.sparkSession
    prepare(spark)
    named = blobs(docs, path_col, text_col)
    keys = materialise(named.select("path", "blob"), "paths")
    by_path = keys.groupBy("blob", F.xxhash64("path").alias("pick")).agg(F.count("*").alias("m"))
    groups = by_path.groupBy("blob").agg(F.min(F.struct("pick", "m")).alias("p"), F.sum("m").alias("n")).select("blob", "p.*", "n")
    known = read_ledger(spark, ledger).filter(F.col("rules") == rules.version).select("blob", "found").dropDuplicates(["blob"])
    groups = materialise(groups.join(known.select("blob", F.lit(True).alias("known")), "blob", "left"), "blobs")
    fresh = groups.filter("known is null").select("blob", "pick", "m")
    rows = named.withColumn("pick", F.xxhash64("path"))
    picked = rows.join(fresh.filter("m = 1"), ["blob", "pick"], "left_semi").select("blob", "text")
    if not fresh.filter("m > 1").isEmpty():
        repeated = flagged(rows, fresh.filter("m > 1"), "blob").filter("_may").groupBy("blob", "pick").agg(F.first("text").alias("text"))
        picked = picked.unionByName(repeated.join(fresh.filter("m > 1"), ["blob", "pick"], "left_semi").select("blob", "text"))
    scan = _scanner(rules)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"blob": batch["blob"], "found": [[{"kind": k, "start": s, "end": e} for k, s, e in scan(x)] for x in batch["text"]]})

    found = picked.mapInPandas(run, T.StructType([LEDGER["blob"], LEDGER["found"]]))
    found = materialise(found, "scanned").dropDuplicates(["blob"])
    values = found.unionByName(known).join(groups.select("blob", "n"), "blob")
    paths = attach(keys, values, "blob", "n", keys.count())
    return paths.select("path", "blob", "found"), found.select("blob", F.lit(rules.version).alias("rules"), "found")


def append_ledger(new: DataFrame, path: str | None = None) -> str:
    """Add new ledger rows to the folder (a new one in the shared folder by default); gives its path."""
    path = path or shared_dir(new.sparkSession, "ledger")
    new.write.mode("append").parquet(path)
    return path
