"""SimHash near-duplicates: fingerprints of word shingles, and a binary-trie self-join of the fingerprints.

Two node pairs of the trie are walked together from the root; a pair whose paths already differ in more bits than the
error budget allows is dropped with everything below it. The walk is cut at a depth that gives nodes of some thousand
fingerprints: there each node pair within the budget becomes one group of a Spark job, which walks on by itself.

Edge cases: null and empty texts have no words and fingerprint 0, linked like any other; texts of fewer words than a
shingle have one shingle, the whole sequence; repeated rows and equal texts meet in one fingerprint before any pairing;
rows with a null id take part, and the smallest id of a component ignores them (null if it has no other); an empty
table gives an empty result; extra columns of the input are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import attach, flagged, materialise, prepare, text_or_empty
from .components import connected_components
from .families import Forest, verified_links

SEED = 42
BITS = 64
#: Fingerprints of one trie node at the depth where the join is dealt to tasks, on average, as long as that is at most ``MOST_DEPTH``.
NODE_ROWS = 1 << 14
#: The same for near copies, of which a row goes to many nodes, by prints and blocks: fewer nodes, fewer rows.
WIDE_ROWS = 1 << 18
MOST_DEPTH = 14
#: Node pairs that are walked at once.
MOST_WALKED = 1 << 18
#: Two nodes are compared outright when they make no more pairs than this.
LEAF_PAIRS = 64
CHUNK = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of bounded size."""
    at = 0
    while at < len(data):
        end = at + CHUNK
        if end < len(data):
            found = SPACE.search(data, end)
            end = found.start() if found else len(data)
        yield data[at:end].split()
        at = end


def _ones(digests: bytes) -> np.ndarray:
    """How many of the 8-byte digests have each bit, highest bit first."""
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(rows), 255 * 64):
        bits = np.unpackbits(rows[at : at + 255 * 64], axis=1)
        full = len(bits) // 255 * 255
        total += bits[:full].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        total += bits[full:].sum(axis=0, dtype=np.int64)
    return total


def _mixed(digests: bytes, k: int) -> bytes:
    """Other hashes out of XXH64 digests: themselves for 0, else spread anew by the finaliser of SplitMix64."""
    if not k:
        return digests
    x = np.frombuffer(digests, ">u8").astype(np.uint64) + np.uint64((k * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).astype(">u8").tobytes()


def fingerprints_of(text: str | None, words: int = 3, count: int = 1) -> list[int]:
    """``count`` independent unsigned SimHashes of a text, the first by XXH64 itself."""
    digest, total, n, tail = xxhash.xxh64_digest, np.zeros((count, BITS), np.int64), 0, []
    seen = 0

    def add(digests: bytes) -> None:
        for k in range(count):
            total[k] += _ones(_mixed(digests, k))

    for more in _words((text or "").encode("utf-8", "surrogatepass").lower()):
        seen += len(more)
        part = tail + more
        if len(part) >= words:
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            line, m = b" ".join(part), len(part) - words + 1
            add(b"".join([digest(line[s:e], SEED) for s, e in zip(starts[:m].tolist(), ends[words - 1 :].tolist(), strict=True)]))
            n += m
        tail = part[1 - words :] if words > 1 else []
    if not n and seen:
        add(digest(b" ".join(tail), SEED))
        n = 1
    return [int.from_bytes(np.packbits(2 * t > n).tobytes(), "big") for t in total]


def fingerprint(text: str | None, words: int = 3) -> int:
    """The unsigned SimHash of a text: a bit is 1 if over half of the shingles' XXH64 have it."""
    return fingerprints_of(text, words)[0]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``(id, fp)`` of every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # ids stay in Arrow: as a pandas column with nulls they would be doubles
            found = np.array([fingerprint(x, words) for x in batch.column("t").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.astype(np.int64))], names=["id", "fp"])

    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t"))
    return rows.mapInArrow(run, "id long, fp long")


def _cut(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Of sorted values, where in [lo, hi) those with the given bit set begin; all of a range agree in the bits above."""
    first = values[np.minimum(lo, len(values) - 1)]
    bound = (first >> np.uint64(bit) | np.uint64(1)) << np.uint64(bit)
    return np.clip(np.searchsorted(values, bound), lo, hi)


def trie_pairs(a: np.ndarray, b: np.ndarray, budget: int, depth: int = 0, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ``walk_pairs`` at once."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)), *walk_pairs(a, b, budget, depth, same)]
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def walk_pairs(
    a: np.ndarray, b: np.ndarray, budget: int, depth: int = 0, same: bool = False, top: int = 0, near: int = 0, labels: Callable[[], tuple[np.ndarray, np.ndarray]] | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices (into sorted uint64 arrays ``a`` and ``b``) of all pairs that differ in at most ``budget`` bits, in parts.

    ``depth`` leading bits are equal within ``a`` and within ``b``, and not compared here. ``same``: ``a`` is ``b``, and
    each unordered pair of two places is given once. Only pairs that differ in at most ``near`` of the leading ``top``
    bits need be found. ``labels`` gives the present labels of ``a`` and ``b``: pairs of one label need not be found, and
    a node pair of only one label is dropped. All node pairs of a level are walked at once, in arrays.
    """
    if not len(a) or not len(b):
        return

    def mixed(al: np.ndarray, ah: np.ndarray, bl: np.ndarray, bh: np.ndarray) -> np.ndarray:
        of_a, of_b = labels()
        turn_a, turn_b = (np.concatenate(([0], np.cumsum(x[1:] != x[:-1]))) for x in (of_a, of_b))
        return (turn_a[al] != turn_a[ah - 1]) | (turn_b[bl] != turn_b[bh - 1]) | (of_a[al] != of_b[bl])

    low_mask = np.uint64((1 << (BITS - depth)) - 1 if depth else (1 << BITS) - 1)

    def down(bit: int, al: np.ndarray, ah: np.ndarray, bl: np.ndarray, bh: np.ndarray, err: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        # a node pair: [al, ah) of a, [bl, bh) of b, and the bits that their paths differ in
        for bit in range(bit, -2, -1):
            leaf = (ah - al) * (bh - bl) <= LEAF_PAIRS if bit >= 0 else np.ones(len(al), bool)
            if leaf.any():
                la, lb, n, width = al[leaf], bl[leaf], (ah - al)[leaf] * (bh - bl)[leaf], (bh - bl)[leaf]
                for at in _slices(n):
                    if labels:
                        of = (x[at] for x in (al[leaf], ah[leaf], bl[leaf], bh[leaf]))
                        at = np.flatnonzero(mixed(*of)) + at.start
                    k = np.repeat(np.arange(len(n))[at], n[at])
                    off = np.arange(len(k)) - np.repeat(np.cumsum(n[at]) - n[at], n[at])
                    i, j = la[k] + off // width[k], lb[k] + off % width[k]
                    keep = np.bitwise_count((a[i] ^ b[j]) & low_mask) <= budget
                    if same:
                        keep &= i < j
                    yield i[keep], j[keep]
                al, ah, bl, bh, err = (x[~leaf] for x in (al, ah, bl, bh, err))
            if not len(al):
                return
            am, bm = _cut(a, al, ah, bit), _cut(b, bl, bh, bit)
            child = [(al, am, bl, bm, err), (am, ah, bm, bh, err), (al, am, bm, bh, err + 1), (am, ah, bl, bm, err + 1)]
            al, ah, bl, bh, err = (np.concatenate(x) for x in zip(*child, strict=True))
            live = (al < ah) & (bl < bh) & (err <= (near if bit >= BITS - top else budget))
            if same:
                live &= al <= bl
            if labels and live.any():
                at = np.flatnonzero(live)
                live[at] = mixed(al[at], ah[at], bl[at], bh[at])
            al, ah, bl, bh, err = (x[live] for x in (al, ah, bl, bh, err))
            if len(al) > MOST_WALKED:
                for at in range(0, len(al), MOST_WALKED // 4):
                    yield from down(bit - 1, *(x[at : at + MOST_WALKED // 4] for x in (al, ah, bl, bh, err)))
                return

    yield from down(BITS - 1 - depth, *(np.array([x], np.int64) for x in (0, len(a), 0, len(b), 0)))


def _slices(sizes: np.ndarray, most: int = 1 << 20) -> Iterator[slice]:
    """Runs of nodes that make about ``most`` pairs at a time."""
    block = np.cumsum(sizes) // most
    edges = np.flatnonzero(np.diff(block)) + 1
    for lo, hi in zip([0, *edges], [*edges, len(sizes)], strict=True):
        yield slice(lo, hi)


def hamming_pairs(distinct: DataFrame, radius: int, spanning: bool = True, blocks: int = 1, most: int = BITS, node_rows: int | None = None) -> DataFrame:
    """``(a, b)``: pairs of different fingerprints (column ``fp``, each once) that differ in at most ``radius`` bits.

    All pairs are found; of those that one group of the job finds, a ``spanning`` forest is given, nearest pairs first,
    which reaches whatever all of them reach. So a large family of near fingerprints gives a link for each, not the
    square of its size. Where ``distinct`` has ``print, fp, check, other, node``, its rows are nodes by several prints,
    each apart, all in one job: pairs must also differ in at most ``most`` bits of ``check`` and of ``other``, and ``(a,
    b)`` are pairs of ``node``.

    The trie's bits are taken in order of balance, so that its upper nodes split evenly. It is cut at depth d, where a
    node has ``node_rows`` (``NODE_ROWS``) fingerprints on average. A fingerprint goes to its own node and to each node within the
    radius: 1 + d + d(d-1)/2 for radius 2, at most 106 at the greatest depth, beyond which nodes grow instead. For a wide
    radius the bits are dealt to ``blocks``, each of which makes a trie with its own bits on top: pairs within the radius
    differ in at most ``radius // blocks`` bits of one block, so that each trie stays narrow where it is large.
    """
    named = "print" in distinct.columns
    more = ["check", "other", "node"] if named else []
    rows = distinct.select(F.col("print") if named else F.lit(0).alias("print"), "fp", *more)
    ones = rows.groupBy("print").agg(F.count("*").alias("n"), *[F.sum(F.shiftrightunsigned("fp", i).bitwiseAND(1)).alias(f"b{i}") for i in range(BITS)]).collect()
    orders, own, largest = {}, {}, 1
    for one in ones:
        even = sorted(range(BITS), key=lambda i: (abs(2 * one[f"b{i}"] - one.n), -i))
        own[one["print"]] = tops = [even[k::blocks] for k in range(blocks)]
        orders[one["print"]] = [top + [i for i in even if i not in top] for top in tops]
        largest = max(largest, one.n)
    depth = min(MOST_DEPTH, BITS // blocks, max(0, int(np.ceil(np.log2(largest / (node_rows or NODE_ROWS))))))
    masks = [m for m in range(1 << depth) if m.bit_count() <= radius // blocks]
    places = []
    for block in range(blocks):
        at = F.lit(0).cast("long")
        for of, order in orders.items():
            value = F.lit(0).cast("long")
            for k, i in enumerate(order[block][:depth]):
                value = value.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", i).bitwiseAND(1), depth - 1 - k))
            at = F.when(F.col("print") == of, value).otherwise(at)
        places.append(F.struct(F.lit(block).alias("block"), at.alias("at")))
    dealt = rows.select("print", "fp", *more, F.explode(F.array(*places)).alias("p")).select("print", "fp", *more, "p.*")
    dealt = dealt.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
    across = F.col("at").bitwiseXOR(F.col("mask"))
    # print, block and the two nodes in one number: rows are many and short
    cell = F.col("print") * blocks + F.col("block")
    cell = F.shiftleft(F.shiftleft(cell.cast("long"), depth).bitwiseOR(F.least("at", across)), depth).bitwiseOR(F.greatest("at", across))
    dealt = dealt.select(cell.alias("cell"), "fp", *more, (F.col("at") > across).alias("high"))

    def walk(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        cell, low = int(key[0]), (1 << depth) - 1
        lo, hi, (of, block) = cell >> depth & low, cell & low, divmod(cell >> 2 * depth, blocks)
        raw = group["fp"].to_numpy(np.int64).view(np.uint64)
        turned = np.zeros(len(raw), np.uint64)
        for k, i in enumerate(orders[of][block]):
            turned |= (raw >> np.uint64(i) & np.uint64(1)) << np.uint64(BITS - 1 - k)
        side = group["high"].to_numpy(bool)
        sides = []
        for half in (~side, side):
            at = np.flatnonzero(half)
            sides.append(at[np.argsort(turned[at], kind="stable")])
        left, right = sides[0], sides[0] if lo == hi else sides[1]
        a, b = turned[left], turned[right]
        forest, out = Forest(len(a) + (len(b) if lo != hi else 0)), []
        apart = int(lo ^ hi).bit_count()
        top = len(own[of][block]) if blocks > 1 else 0
        checks = [group[c].to_numpy(np.int64).view(np.uint64) for c in more[:2]]
        name = group["node"].to_numpy() if named else raw.view(np.int64)
        joined = (lambda: (forest.label[: len(a)], forest.label[-len(b) :])) if spanning else None
        for i, j in walk_pairs(a, b, radius - apart, depth, lo == hi, top, radius // blocks - apart, joined):
            for check in checks:
                keep = np.bitwise_count(check[left[i]] ^ check[right[j]]) <= most
                i, j = i[keep], j[keep]
            if spanning and len(i):
                kept = forest.add(i, j + (len(a) if lo != hi else 0), np.bitwise_count(a[i] ^ b[j]))
                i, j = i[kept], j[kept]
            out.append(pd.DataFrame({"a": name[left[i]], "b": name[right[j]]}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []})

    kind = "binary" if named else "long"
    return dealt.groupBy("cell").applyInPandas(walk, f"a {kind}, b {kind}")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` of every row: 16 hex digits, and the smallest id that links reach.

    Fingerprints link at ``radius`` or fewer differing bits, and components follow links.
    """
    own = materialise(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = materialise(own.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "distinct")
    roots = connected_components(hamming_pairs(distinct.select("fp"), radius))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    values = materialise(placed.join(least, "root").select("fp", "n", "component_id"), "placed")
    joined = attach(own, values, "fp", "n", own.count())
    return joined.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_set(text: str | None, words: int) -> set[bytes]:
    """The different runs of ``words`` words of a text; of fewer words, the whole."""
    out, tail, seen = set(), [], 0
    for more in _words((text or "").encode("utf-8", "surrogatepass").lower()):
        seen += len(more)
        part = tail + more
        out.update(b" ".join(part[i : i + words]) for i in range(len(part) - words + 1))
        tail = part[1 - words :] if words > 1 else []
    return out or ({b" ".join(tail)} if seen else out)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """The different XXH64 hashes of the shingles of ``shingle_set``, ascending; 64 bits stand for a shingle."""
    digest, out, tail, seen = xxhash.xxh64_digest, [], [], 0
    for more in _words((text or "").encode("utf-8", "surrogatepass").lower()):
        seen += len(more)
        part = tail + more
        out += [digest(b" ".join(part[i : i + words]), SEED) for i in range(len(part) - words + 1)]
        tail = part[1 - words :] if words > 1 else []
    if not out and seen:
        out = [digest(b" ".join(tail), SEED)]
    return np.unique(np.frombuffer(b"".join(out), ">u8").astype(np.uint64))


def widest(similarity: float) -> int:
    """The bits that two prints differ in at a similarity, at most: the mean for a block of edits and 4.6 deviations."""
    share = np.arccos(min(1.0, 2 * similarity / (1 + similarity))) / np.pi
    return min(BITS, int(np.ceil(BITS * share + 4.6 * np.sqrt(BITS * share * (1 - share)))))


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, radius: int = 9, prints: int = 5, print_words: int = 2, blocks: int = 5
) -> DataFrame:
    """The rows of ``docs``, all columns, that have the smallest id of their group of near copies, and its text.

    Near copies have a Jaccard similarity of ``similarity`` or more in their sets of runs of ``words`` words. Equal texts
    are one node. Candidates are nodes of which one of ``prints`` independent SimHashes (of runs of ``print_words`` words)
    differs in at most ``radius`` bits, and the next two in no more than can be at that similarity; the trie join gives a
    forest that spans all of them. Its components are families, of which every pair is verified on the whole texts,
    and groups follow verified links. At similarity 0.8, about 6 bits of a print of two-word runs differ where the
    edits are scattered, 9 or 10 where they are one block.

    Rows that repeat both the id and the text of the one that stays are the same document, and stay with it; a row with
    the id but another text belongs to that text's group. A row with a null id stays only if its whole group has none.
    Null and empty texts are one node. Columns of any name pass through.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t")).withColumn("node", F.unhex(F.md5("t")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprints_of(x, print_words, prints) for x in batch.column("t").to_pylist()], np.uint64).reshape(-1, prints)
            lists = pa.ListArray.from_arrays(np.arange(0, found.size + 1, prints, dtype=np.int32), pa.array(found.astype(np.int64).reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("node"), lists], names=["id", "node", "fps"])

    own = materialise(rows.mapInArrow(run, "id long, node binary, fps array<long>"), "fingerprints")
    nodes = materialise(own.groupBy("node").agg(F.min("id").alias("least"), F.first("fps").alias("fps")), "nodes")
    turn = lambda k: F.transform("fps", lambda x, i: F.get("fps", (i + k) % prints))
    held = nodes.select("node", F.posexplode(F.arrays_zip(F.col("fps").alias("fp"), turn(1).alias("check"), turn(2).alias("other"))).alias("print", "p")).select("node", "print", "p.*")
    same = ["print", "fp", "check", "other"]
    reps = materialise(held.groupBy(*same).agg(F.min("node").alias("rep"), F.count("*").alias("n")), "prints")
    star = held.join(reps.filter("n > 1").drop("n"), same).filter("node != rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    near = hamming_pairs(reps.select(*same, F.col("rep").alias("node")), radius, blocks=blocks, most=widest(similarity), node_rows=WIDE_ROWS)
    families = connected_components(star.unionByName(near))
    families = materialise(families.withColumnRenamed("root", "family"), "families")
    roots = connected_components(verified_links(families, rows.select("node", "t"), lambda t: shingle_hashes(t, words), similarity))
    placed = materialise(nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "groups")
    least = placed.groupBy("root").agg(F.min(F.struct(F.col("least").isNull(), "least", "node")).alias("first")).select("root", F.col("first.least").alias("keep"), F.col("first.node").alias("kept"))
    # rows that go: of a node that isn't its group's, or with another id than the node's
    whole = own.select("id", "node").distinct().join(placed.select("node", "root"), "node").join(least, "root")
    gone = materialise(whole.filter((F.col("node") != F.col("kept")) | ~F.col("id").eqNullSafe(F.col("keep"))).select(F.xxhash64("id", "node").alias("row_key"), "id", "node"), "gone")
    key = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(text_or_empty(text_col))).alias("node"))
    key = flagged(key.withColumn("row_key", F.xxhash64("id", "node")), gone, "row_key")
    doubtful = key.filter("_may")
    same = doubtful["row_key"].eqNullSafe(gone["row_key"]) & doubtful["id"].eqNullSafe(gone["id"]) & (doubtful["node"] == gone["node"])
    return key.filter("not _may").select("row.*").unionByName(doubtful.join(gone, same, "left_anti").select("row.*"))
