"""Quotations held against texts: a ladder of matches, from exact to near miss.

Rungs that a Column can decide run on all pairs; only what is left goes to difflib. Where quotations have no text named,
all of them are looked for in every text at once, by one automaton per rung, in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waymark.functions import offsets as O
from waymark.functions import text as K
from waymark.functions.lineage import kept

# Fixed values.
NEAR_MISS = 0.82
SHOW_CLOSEST = 0.5
LEAST_FRAGMENT = 8
KINDS = ("exact", "normalised", "case_insensitive", "ellipsis", "near_miss", "missing")
#: Bytes of quotations that one automaton holds; more are looked for in further passes.
AUTOMATON_BYTES = 16 << 20


#: Rows and bytes of what a Python worker gets at once: texts may be long, and a row has several keys of its text.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of a session: a worker's memory then doesn't grow with the rows that a task has."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key).removesuffix("b")
        size = int(now) if now.lstrip("-").isdigit() else 0
        if not 0 < size <= most:
            spark.conf.set(key, str(most))


def ellipsis_span(norm: Column, needle: Column) -> Column:
    """Where an elided quotation is, ``(start, end)`` from 0, if all its fragments follow one another; else null."""
    fragments = F.filter(F.split(needle, r"\s*\.\.\.\s*"), lambda f: F.length(f) >= LEAST_FRAGMENT)
    start = F.struct(F.lit(0).alias("first"), F.lit(1).alias("at"))

    def step(state: Column, fragment: Column) -> Column:
        # a cursor of 0 means that a fragment was not found
        found = F.when(state["at"] > 0, F.call_function("locate", fragment, norm, state["at"])).otherwise(0)
        return F.struct(
            F.when(state["first"] == 0, found).otherwise(state["first"]).alias("first"),
            F.when(found > 0, found + F.length(fragment)).otherwise(0).alias("at"),
        )

    done = F.aggregate(fragments, start, step)
    span = F.struct((done["first"] - 1).alias("start"), (done["at"] - 1).alias("end"))
    return F.when(needle.contains("...") & (F.size(fragments) >= 2) & (done["at"] > 0), span)


def _with_near(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_near``: the span of ``_norm`` most like ``_wanted``, where that isn't null.

    A step of its own: a pandas UDF would be merged with the columns that it needs, and they would be made again for each use.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("_norm").to_pylist(), batch.column("_wanted").to_pylist(), strict=True)
            near = [None if wanted is None else dict(zip(("ratio", "start", "end"), K.closest_span(norm or "", wanted), strict=True)) for norm, wanted in both]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, NEAR)], names=[*batch.schema.names, "_near"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("_near", K.SPAN)]))


NEAR = pa.struct([("ratio", pa.float64()), ("start", pa.int32()), ("end", pa.int32())])


def check_quotes(pairs: DataFrame, quote: str = "quote", text: str = "text") -> DataFrame:
    """``pairs`` with ``kind, ratio, start, end, line_no, closest``: how each quotation is found in its text.

    ``start`` and ``end`` are the place of what was found in the raw text (characters from 0, end exclusive), whatever the
    rung, ``line_no`` the line where it begins; null where nothing was. What is there normalises to the quotation, but
    for characters that became several or of several, which are in it whole. ``closest`` is the text's own wording where
    it differs: of a match without case, the most similar text of a near miss or a missing quotation. An empty quotation
    is missing.

    Each rung's keys are made once, and only for the pairs that no rung before has decided.
    """
    small_batches(pairs.sparkSession)
    raw, q = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(quote), F.lit(""))
    place = lambda part, whole: F.when(part != "", F.call_function("locate", part, whole) - 1)
    span = lambda at, part: F.when(at >= 0, F.struct(at.alias("start"), (at + F.length(part)).alias("end")))
    at = place(q, raw)
    rows = pairs.withColumn("_exact", span(at, q))
    open_ = F.col("_exact").isNull()
    rows = rows.withColumn("_norm", F.when(open_, K.normalize(raw))).withColumn("_needle", F.when(open_, K.normalize(q)))
    norm, needle = F.col("_norm"), F.col("_needle")
    rows = rows.withColumn("_bare", K.strip_edge_quotes(needle)).withColumn("_at", place(needle, norm)).withColumn("_bare_at", F.when(F.col("_at") < 0, place(F.col("_bare"), norm)))
    plain = F.coalesce(span(F.col("_at"), needle), span(F.col("_bare_at"), F.col("_bare")))
    rows = rows.withColumn("_plain", plain).withColumn("_left", (needle != "") & F.col("_plain").isNull())
    rows = rows.withColumn("_key", F.when(F.col("_left"), K.casefold(norm))).withColumn("_folded", F.when(F.col("_left"), K.casefold(needle)))
    rows = rows.withColumn("_cased", span(place(F.col("_folded"), F.col("_key")), F.col("_folded"))).withColumn("_elided", F.when(F.col("_left") & F.col("_cased").isNull(), ellipsis_span(norm, needle)))
    rows = rows.withColumn("_unlike", F.col("_left") & F.col("_cased").isNull() & F.col("_elided").isNull())
    rows = rows.withColumn("_cased_norm", F.when(F.col("_cased").isNotNull(), O.span_in(O.casefold_runs(norm), F.col("_cased.start"), F.col("_cased.end"))))
    rows = rows.withColumn("_parts", F.when(open_ & (needle != ""), O.normalized_parts(raw)))
    rows = _with_near(rows.withColumn("_wanted", F.when(F.col("_unlike"), needle)))
    ratio = F.when(F.col("_unlike"), F.col("_near.ratio"))
    near = F.when(ratio > 0, F.struct(F.col("_near.start").alias("start"), F.col("_near.end").alias("end")))
    in_norm = F.coalesce("_plain", "_cased_norm", "_elided", near)
    rows = rows.withColumn("_in_norm", in_norm)
    in_raw = F.coalesce("_exact", F.when(F.col("_in_norm").isNotNull(), O.span_in(O.runs_of(F.col("_parts")), F.col("_in_norm.start"), F.col("_in_norm.end"))))
    kind = F.when(~open_, "exact").when(F.col("_plain").isNotNull(), "normalised").when(F.col("_cased").isNotNull(), "case_insensitive").when(F.col("_elided").isNotNull(), "ellipsis")
    kind = kind.when(ratio >= NEAR_MISS, "near_miss").otherwise("missing")
    differs = F.col("_cased").isNotNull() | near.isNotNull()
    own = F.when(differs, F.trim(F.substring(norm, F.col("_in_norm.start") + 1, F.col("_in_norm.end") - F.col("_in_norm.start"))))
    rows = rows.withColumn("_in_raw", in_raw).withColumn("kind", kind)
    rows = rows.withColumn("ratio", F.coalesce(ratio, F.when(F.col("kind") == "missing", 0.0).otherwise(1.0)))
    rows = rows.withColumn("start", F.col("_in_raw.start")).withColumn("end", F.col("_in_raw.end"))
    rows = rows.withColumn("line_no", F.when(F.col("start").isNotNull(), O.line_of(raw, F.col("start")))).withColumn("closest", own)
    return rows.select(*pairs.columns, "kind", "ratio", "start", "end", "line_no", "closest")


def failing(checks: DataFrame) -> DataFrame:
    """What didn't pass, worst first."""
    rank = F.array_position(F.array(*[F.lit(k) for k in ("missing", "near_miss", "ellipsis", "case_insensitive")]), F.col("kind"))
    return checks.filter(~F.col("kind").isin("exact", "normalised")).orderBy(rank, "ratio")


def find_quotes(texts: DataFrame, quotes: DataFrame, text_id: str = "doc_id", quote_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(text_id, quote_id, kind)`` of every quotation found in every text: exact, normalised (also without quotation
    marks at its ends), case_insensitive or ellipsis (its fragments of ``LEAST_FRAGMENT`` characters, in order).

    Quotations come to the executors in lists of at most ``AUTOMATON_BYTES``, and the driver holds one list at a time, that
    is, as many as fit one automaton; texts are read once per list, and each list's findings but the last's are kept in
    the folder of ``spark.checkpoint.dir``.
    """
    small_batches(texts.sparkSession)
    keys = quotes.select(F.col(quote_id).alias("id"), F.col("text").alias("raw"), K.normalize(F.col("text")).alias("norm"))
    keys = keys.withColumn("key", K.casefold(F.col("norm"))).withColumn("bare", K.strip_edge_quotes(F.col("norm")))
    rows = texts.select(F.col(text_id).alias("id"), F.col(text).alias("raw"), K.normalize(F.col(text)).alias("norm")).withColumn("key", K.casefold(F.col("norm")))
    kind = dict(quotes.dtypes)[quote_id]

    def finder(own: list[tuple]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            # what is looked for, by the column that it is looked for in, with its rung
            rungs = (("exact", 1, 1), ("normalised", 2, 2), ("normalised", 4, 2), ("case_insensitive", 3, 3))
            needles: list[dict[str, list]] = [{}, {}, {}, {}]
            elided = {}
            for row in own:
                for rank, (_, column, place) in enumerate(rungs):
                    if row[column]:
                        needles[place].setdefault(row[column], []).append((row[0], rank, None))
                parts = [x for x in re.split(r"\s*\.\.\.\s*", row[2] or "") if len(x) >= LEAST_FRAGMENT]
                if "..." in (row[2] or "") and len(parts) > 1:
                    elided[row[0]] = parts
                    for part in dict.fromkeys(parts):
                        needles[2].setdefault(part, []).append((row[0], len(rungs), part))
            machines = []
            for by in needles[1:]:
                machine = ahocorasick.Automaton()
                for needle, ids in by.items():
                    machine.add_word(needle, ids)
                if by:
                    machine.make_automaton()
                machines.append(machine if by else None)

            def in_order(parts: list[str], ends: dict[str, list[int]]) -> bool:
                cursor = 0
                for part in parts:
                    cursor = next((e for e in ends.get(part, ()) if e - len(part) >= cursor), -1)
                    if cursor < 0:
                        return False
                return True

            for batch in batches:
                out: list[tuple] = []
                for at in range(batch.num_rows):
                    # one text at a time, not a batch of them as Python's strings
                    row = [column[at].as_py() for column in batch.columns]
                    found: dict = {}
                    ends: dict = {}
                    for machine, value in zip(machines, row[1:], strict=False):
                        if machine is not None and value:
                            for end, hits in machine.iter(value):
                                for i, rank, part in hits:
                                    if part is None:
                                        found[i] = min(rank, found.get(i, rank))
                                    else:
                                        ends.setdefault(i, {}).setdefault(part, []).append(end + 1)
                    for i, places in ends.items():
                        if i not in found and in_order(elided[i], places):
                            found[i] = len(rungs)
                    out += [(row[0], i, rungs[k][0] if k < len(rungs) else "ellipsis") for i, k in found.items()]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds.types)], schema=kinds)

        return run

    schema = T.StructType.fromDDL(f"id {dict(texts.dtypes)[text_id]}, quote {kind}, kind string")
    kinds = to_arrow_schema(schema)
    out = None
    for own, last in _lists(keys):
        found = rows.mapInArrow(finder(own), schema)
        found = found if last else kept(found)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = rows.limit(0).mapInArrow(finder([]), schema)
    return out.select(F.col("id").alias(text_id), F.col("quote").alias(quote_id), "kind")


def _lists(keys: DataFrame) -> Iterator[tuple[list[tuple], bool]]:
    """The quotations in lists of ``AUTOMATON_BYTES`` at most, one quotation at least, and whether a list is the last."""
    own: list[tuple] = []
    size = 0
    for row in keys.toLocalIterator():
        more = 3 * len(row.raw or "")
        if own and size + more > AUTOMATON_BYTES:
            yield own, False
            own, size = [], 0
        own.append(tuple(row))
        size += more
    if own:
        yield own, True


#: A near miss shares a run of so many characters with its quotation, or half the quotation if that is less.
RUN = 24
#: Grams that runs are found by; the least quotation that near misses are looked for is twice the least run that holds one.
GRAMS = (16, 12, 8, 6, 4)


def grams_of_run(run: int) -> tuple[int, int] | None:
    """``(gram, stride)``: a run of so many characters holds a gram that begins at a multiple of the stride, wherever it lies."""
    return next(((g, g // 2) for g in GRAMS if g + g // 2 - 1 <= run), None)


def near_pairs(texts: DataFrame, quotes: DataFrame, text_id: str = "doc_id", quote_id: str = "item_id", text: str = "text", run: int = RUN) -> DataFrame:
    """``(text_id, quote_id)`` of every text and quotation that have a run of ``run`` characters in common, once
    normalised, or of half the quotation if that is less. Others may be among them.

    By the pigeonhole rule, a quotation of n characters that differs in fewer than n / run places has such a run. It's found
    by grams: those at every place of the quotations, and those at every stride of the texts, are joined by their hashes.
    Quotations are in classes by the longest gram that their run must hold; texts are cut for the classes that there are.
    A quotation of fewer than 10 characters is in no class.
    """
    needles = quotes.select(F.col(quote_id).alias("quote"), K.normalize(F.coalesce("text", F.lit(""))).alias("needle"))
    shortest = F.least(F.lit(run), F.floor(F.length("needle") / 2))
    size = F.coalesce(*[F.when(shortest >= g + g // 2 - 1, g) for g in GRAMS])
    needles = needles.withColumn("gram", size).filter("gram is not null")
    norm = texts.select(F.col(text_id).alias("text"), K.normalize(F.coalesce(F.col(text), F.lit(""))).alias("norm"))
    found = None
    for row in needles.select("gram").distinct().collect():  # at most the classes
        g = row.gram
        # grams by a look-ahead: linear in the text, whatever its characters
        cut = lambda whole, step: F.array_distinct(F.transform(F.regexp_extract_all(whole, F.lit(f"(?s)(?=(.{{{g}}})).{{1,{step}}}"), F.lit(1)), lambda x: F.xxhash64(x)))  # noqa: B023, E731
        own = needles.filter(F.col("gram") == g).select("quote", F.explode(cut(F.col("needle"), 1)).alias("hash"))
        seen = norm.select("text", F.explode(cut(F.col("norm"), g // 2)).alias("hash"))
        pairs = seen.join(own, "hash").select("text", "quote")
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        found = norm.select("text", F.lit(None).cast(dict(needles.dtypes)["quote"]).alias("quote")).limit(0)
    return found.distinct().select(F.col("text").alias(text_id), F.col("quote").alias(quote_id))


def find_near(texts: DataFrame, quotes: DataFrame, text_id: str = "doc_id", quote_id: str = "item_id", text: str = "text", run: int = RUN) -> DataFrame:
    """``(text_id, quote_id, kind, ratio, start, end, line_no, closest)`` of every quotation that a text has, in whatever way
    ``check_quotes`` knows, among the pairs of ``near_pairs``: all near misses with such a run, and cleaner matches.
    """
    pairs = near_pairs(texts, quotes, text_id, quote_id, text, run)
    whole = pairs.join(texts.select(text_id, F.col(text).alias("_text")), text_id).join(quotes.select(quote_id, F.col("text").alias("_quote")), quote_id)
    checks = check_quotes(whole, "_quote", "_text").filter("kind != 'missing'")
    return checks.select(text_id, quote_id, "kind", "ratio", "start", "end", "line_no", "closest")


def verdict_counts(found: DataFrame, pairs: int) -> DataFrame:
    """``(kind, n)`` for the kinds of ``find_quotes`` and ``missing``, zeros included, of ``pairs`` pairs in all.

    The texts are gone through once: one row of counts gives all kinds."""
    n = found.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in KINDS[:4]])
    missing = F.lit(pairs).cast("long") - sum(F.col(k) for k in KINDS[:4])
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in KINDS[:4]], F.struct(F.lit("missing").alias("kind"), missing.alias("n")))
    return n.select(F.explode(each).alias("e")).select("e.kind", "e.n")
