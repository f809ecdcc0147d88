"""Product codes of vectors: codebooks by Lloyd rounds, with Exponion search, in exact integers.

A vector's components become integers floor(scale * x); it is cut into ``parts`` equal parts, and each part is coded as
the number of the nearest entry of its position's codebook (squared distance, ties to the lower number). Codebooks
begin as the parts of the vectors of the smallest ids, and a round moves each entry to the floor of its parts' mean.

Exponion search: a part starts at the entry a that it had before, at distance u. An entry nearer than a, or as near, is at
most 2u from a (triangle inequality), so only the run of a's neighbours, sorted by distance from a, with squared distance
up to 4 u^2 is looked at. All of that is in integers, so ties are exact too.

Rows are assigned where they lie, in Arrow batches; a round's sums by entry are a partial aggregate of at most
``parts * entries`` keys, and only these and the codebooks are known to the driver. Each round's codes are one table in the
shared folder, from which the next round starts.

Edge cases: vectors that are null, or hold a null or non-finite component, are dropped; shorter vectors count as padded with
zeros, and all are padded to a multiple of ``parts``; rows with a null id are coded and come last among the ids; repeated
rows each count; fewer rows than entries make smaller codebooks; a null label is a label; an empty table gives an empty
result; components beyond 2 ** 62 count as that; an error that is no long is null; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import attach, materialise

SCALE, PARTS, ENTRIES, ROUNDS = 256.0, 16, 64, 2
#: Rows in one Arrow batch of vectors: some megabytes, whatever else the session sets.
SLICE = 4096


@dataclass(frozen=True)
class Neighbours:
    """A codebook (entries by width) with each entry's neighbours by distance, nearest (itself) first."""

    entries: np.ndarray
    order: np.ndarray
    reach: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Neighbours:
        gap = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        np.fill_diagonal(gap, -1)  # itself before entries that are equal
        order = np.argsort(gap, axis=1, kind="stable")
        np.fill_diagonal(gap, 0)
        return cls(entries, order, np.take_along_axis(gap, order, axis=1))

    def nearest(self, points: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(entry, squared distance)`` of each point; ``start`` is the entry where its search begins."""
        best, far = start.copy(), ((points - self.entries[start]) ** 2).sum(axis=1)
        within = np.empty(len(points), np.int64)
        for a in np.unique(start).tolist():
            own = start == a
            within[own] = np.searchsorted(self.reach[a], 4 * far[own], "right")
        live = np.flatnonzero(within > 1)
        rank = 1
        while len(live):
            other = self.order[start[live], rank]
            gap = ((points[live] - self.entries[other]) ** 2).sum(axis=1)
            better = (gap < far[live]) | ((gap == far[live]) & (other < best[live]))
            won = live[better]
            best[won], far[won] = other[better], gap[better]
            rank += 1
            live = live[within[live] > rank]
        return best, far


def integers(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: float) -> DataFrame:
    """``(id, label, v)`` of the vectors that take part, components as longs."""
    x = F.col(vector_col)
    good = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    whole = lambda c: F.floor(F.greatest(F.lit(-(2.0**62)), F.least(F.lit(2.0**62), F.lit(scale) * c.cast("double"))))
    return vectors.filter(good).select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.transform(x, whole).alias("v"))


def assign(state: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``state`` (id, label, v, codes) with new ``codes``, and ``error``, by codebooks (parts, entries, width)."""
    parts, _, width = codebooks.shape
    kind = codebooks.dtype
    label = state.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Neighbours.of(b) for b in codebooks]
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                batch = whole.slice(at, SLICE)
                flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
                points = flat.astype(kind).reshape(len(batch), parts, width)
                before = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(len(batch), parts)
                codes, error = np.empty_like(before), np.zeros(len(batch), kind)
                for p, book in enumerate(books):
                    codes[:, p], far = book.nearest(points[:, p], before[:, p].astype(np.int64))
                    error = error + far
                fits = [e if e < 1 << 63 else None for e in error.tolist()]
                columns = [batch.column("id"), batch.column("label"), batch.column("v"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(fits, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "v", "codes", "error"])

    return state.mapInArrow(run, f"id long, label {label}, v array<long>, codes binary, error long")


def moved(state: DataFrame, codebooks: np.ndarray, exact: str) -> np.ndarray:
    """The codebooks with each entry at the floor of the mean of its parts; entries without parts stay."""
    parts, _, width = codebooks.shape
    code = lambda p: F.conv(F.hex(F.substring("codes", p + 1, 1)), 16, 10).cast("int")
    each = state.select("v", F.explode(F.array(*[F.struct(F.lit(p).alias("part"), code(p).alias("entry")) for p in range(parts)])).alias("k"))
    at = F.col("k.part") * width
    sums = [F.sum(F.get("v", at + i).cast(exact)).alias(f"s{i}") for i in range(width)]
    out = codebooks.copy()
    for row in each.groupBy("k.part", "k.entry").agg(F.count("*").alias("n"), *sums).collect():
        out[row.part, row.entry] = [int(row[f"s{i}"]) // row.n for i in range(width)]
    return out


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: float = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """``(id_col, code, error, label_error)`` of every vector that takes part, and the codebooks (parts, entries, width).

    ``code`` is two hex digits for each part; ``error`` the squared distances to the entries, summed; ``label_error`` the
    sum of the errors of all rows of the label.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number has to fit two hex digits")
    kept = materialise(integers(vectors, id_col, vector_col, F.col(label_col), scale), "vectors")
    facts = kept.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("size"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    width, most = max(1, -(-(facts.size or 0) // parts)), facts.most or 0
    kind = np.int64 if parts * width * (2 * most + 2) ** 2 < 1 << 61 else object  # Python's integers where longs are too short
    full = parts * width
    padded = F.when(F.size("v") < full, F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(full) - F.size("v")))).otherwise(F.col("v"))
    state = kept.withColumn("v", padded).withColumn("codes", F.unhex(F.repeat(F.lit("00"), F.lit(parts))))
    first = state.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r.v for r in first], kind).reshape(len(first), parts, width).transpose(1, 0, 2)
    exact = "long" if facts.n * most < 1 << 62 else "decimal(38,0)"
    for _ in range(rounds if first else 0):
        state = materialise(assign(state, books).drop("error"), "codes")
        books = moved(state, books, exact)
    done = materialise(assign(state, books).drop("v"), "coded")
    own = done.withColumn("_label", F.struct("label"))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = materialise(own.groupBy("_label").agg(F.count("*").alias("_n"), F.when(F.count("*") == F.count("error"), total).try_cast("long").alias("label_error")), "labels")
    out = attach(own, sums, "_label", "_n", facts.n)
    return out.select(F.col("id").alias(id_col), F.lower(F.hex("codes")).alias("code"), "error", "label_error"), books


def codebooks_text(books: np.ndarray) -> str:
    """All components in decimal, by part, entry and place, comma-joined."""
    return ",".join(map(str, books.reshape(-1).tolist()))


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(codebooks_text(books).encode()).hexdigest()
