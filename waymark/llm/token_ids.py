"""Token ids in Simple-8b: selectors pack varying counts of ids into 64-bit words.

A word's top 4 bits are its selector, the other 60 hold ids from the lowest bits up: n ids of 60 // n bits each. The
two selectors for runs store 120 or 240 zeros in no bits. An id of 60 bits or more doesn't fit any selector: selector
15 is the escape, and the id follows in a word of its own. Ids are coded in blocks of ``BLOCK``; a block index keeps
every block's first word and its number of ids, so that blocks can be decoded apart, all words of a selector at once.

File (little endian): magic ``WMS8``, version u32, documents u64, ids u64, blocks u64, words u64; then document ids
i64, null flags u8 and document lengths i64; then each block's first word u64 and ids u32; then the words u64.

Documents are range-partitioned by id, so each file is one run of the ascending order; where a file begins among all ids
is the sum of the files before it, kept in the manifest.

Edge cases: a null or empty text has only the end id; rows with a null document id come first; repeated document ids
and rows stay, in the order of their texts' hashes; a text of any length is one document; an empty table gives no
files; extra columns are not looked at.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialise, open_input, open_output, prepare, shared_dir, text_or_empty

# Ids in a word and their bits, by selector; 0 bits are runs of zeros.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
#: Selector 15 is one id of 60 bits; ids that need more are escaped: a word of this value, then the id.
ESCAPE = np.uint64((15 << 60) | ((1 << 60) - 1))
BLOCK = 8192
MAGIC = b"WMS8"
END_ID = 2
#: Bytes of text in one range partition, and so in one file.
FILE_TEXT = 64 << 20
#: Pieces, and ids of pieces, that a tokenizer remembers; when there are more it forgets all. About 150 and 4 bytes each.
MOST_PIECES, MOST_IDS = 1 << 20, 1 << 23
#: Bytes of text that are encoded at once, and pieces whose ids are gathered at once.
SLICE_BYTES, GATHERED = 1 << 22, 1 << 18


#: Bits of the ids below 2 ** 16.
_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def encode_block(ids: np.ndarray) -> np.ndarray:
    """The words of at most ``BLOCK`` unsigned ids; each word takes as many ids as any selector can."""
    ids = np.asarray(ids).astype(np.uint64)
    n, out = len(ids), []
    if not n:
        return np.zeros(0, np.uint64)
    high = None
    if int(ids.max()) < len(_BITS):
        need = _BITS[ids]
    else:
        high = ids >= np.uint64((1 << 60) - 1)
        need = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)  # bits of an id; one more, at most, above 2 ** 53
        need[high] = 99
    # for each place, the selector that packs most: the widest of its next ids fits. Of counts in ascending order the last one wins
    best, top, power = np.full(n, 15, np.uint8), need, 1
    for s in range(14, -1, -1):
        k, w = int(COUNTS[s]), int(WIDTHS[s])
        if k > n:
            break
        while 2 * power <= k:  # top: the most of each run of ``power`` needs
            top, power = np.maximum(top[:-power], top[power:]), 2 * power
        fit = np.maximum(top[: n - k + 1], top[k - power : n - power + 1]) <= w
        if not fit.any():
            break
        best[: n - k + 1][fit] = s
    step, at, places = COUNTS[best].tolist(), 0, []
    while at < n:
        places.append(at)
        at += step[at]
    places = np.array(places)
    chosen = best[places]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen).tolist():
        if s >= 2:
            own = np.flatnonzero(chosen == s)
            first, packed = places[own], words[own]
            for j in range(int(COUNTS[s])):
                packed |= (ids[first + j] & np.uint64((1 << 60) - 1)) << np.uint64(j * int(WIDTHS[s]))
            words[own] = packed
    if high is not None and high.any():
        for w, p in zip(words.tolist(), places.tolist(), strict=True):
            out += [int(ESCAPE), int(ids[p])] if high[p] else [w]
        return np.array(out, np.uint64)
    return words


def decode_block(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    words = np.asarray(words, np.uint64)
    escaped = np.flatnonzero(words == ESCAPE)
    if len(escaped):  # a value may look like an escape: take them in order
        marks, last = [], -2
        for e in escaped.tolist():
            if e != last + 1:
                marks.append(e)
                last = e
        values = words[np.array(marks) + 1]
        keep = np.ones(len(words), bool)
        keep[np.array(marks) + 1] = False
        spots = np.array(marks) - np.arange(len(marks))
        words = words[keep]
    selector = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[selector])
    starts = ends - COUNTS[selector]
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for s in range(2, 16):
        own = np.flatnonzero(selector == s)
        if len(own):
            k, w = COUNTS[s], int(WIDTHS[s])
            out[starts[own][:, None] + np.arange(k)] = words[own][:, None] >> (np.arange(k) * w).astype(np.uint64) & np.uint64((1 << w) - 1)
    if len(escaped):
        out[starts[spots]] = values
    return out[:n]


@cache
def _tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return PieceTable(Tokenizer.from_file(path))


#: A space after white space of any kind; texts that have one are cut by ``AFTER_SPACE``, the others at every space.
SPACED = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
AFTER_SPACE = re.compile(r"(?<!\s) ")
#: Fixed value: what stands for a space at the start of a token of a byte-level vocabulary.
SPACE_MARK = "\u0120"


class PieceTable:
    """A byte-level BPE tokenizer of the tokenizers library that remembers the ids of pieces of text.

    A text is cut before every space that follows no white space: there the pre-tokenizer always cuts, so the pieces'
    ids in a row are the text's. The different pieces of a batch are looked up, new ones are encoded by the library, all
    in one string: a piece without further spaces has one token that begins with a space, its first, so the ids can be
    dealt to the pieces. Where that can't be relied on - pieces with more spaces or white space at the end, or texts of
    added tokens - pieces are encoded one by one; and where the tokenizer has another normalizer or pre-tokenizer,
    whole texts are. The tests hold this against whole-text encoding.
    """

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        parts = json.loads(tokenizer.to_str())
        pre, model = parts["pre_tokenizer"] or {}, parts["model"]
        self.cuts = (
            not parts["normalizer"] and not parts["truncation"] and not parts["padding"] and model["type"] == "BPE" and not model["dropout"]
            and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre["use_regex"]
        )
        vocabulary = tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.spaced[[i for x, i in vocabulary.items() if x.startswith(SPACE_MARK)]] = True
        self.added = re.compile("|".join(map(re.escape, (t.content for t in tokenizer.get_added_tokens_decoder().values()))) or r"(?!)")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.at, self.n = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int32)
        self.pool, self.used = np.zeros(1 << 12, np.uint32), 0

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _put(self, ids: np.ndarray) -> int:
        """Ids behind the used part of the pool; gives their place."""
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(self.used + 2 * len(ids), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        return self.used

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Numbers for new pieces, each of which follows a space."""
        plain = [i for i, x in enumerate(pieces) if x and " " not in x and not x[-1].isspace()]
        rest = sorted(set(range(len(pieces))) - set(plain))
        line = " " + " ".join([pieces[i] for i in plain]) if plain else ""
        ids = self._encode([line])[0]
        first = np.flatnonzero(self.spaced[ids])
        if len(first) != len(plain) or self.added.search(line):
            rest, plain, ids, first = range(len(pieces)), [], ids[:0], first[:0]
        own = self._encode([" " + pieces[i] for i in rest])
        sizes = np.zeros(len(pieces), np.int64)
        sizes[plain] = np.diff(np.append(first, len(ids)))
        sizes[rest] = [len(x) for x in own]
        starts = np.zeros(len(pieces), np.int64)
        starts[plain] = first
        starts[rest] = len(ids) + np.cumsum(sizes[rest]) - sizes[rest]
        at = self._put(np.concatenate([ids, *own]))
        self.used += int(sizes.sum())
        have = len(self.known)
        if have + len(pieces) > len(self.at):
            more = np.zeros(have + 2 * len(pieces), np.int64)
            self.at, self.n = np.concatenate([self.at[:have], more]), np.concatenate([self.n[:have], more.astype(np.int32)])
        self.at[have : have + len(pieces)], self.n[have : have + len(pieces)] = at + starts, sizes
        numbers = np.arange(have, have + len(pieces))
        self.known.update(zip(pieces, numbers.tolist(), strict=True))
        return numbers

    @staticmethod
    def _cut(texts: pa.Array) -> pa.Array:
        """Lists of pieces, without the spaces that they follow."""
        odd = pc.match_substring_regex(texts, SPACED).to_numpy(zero_copy_only=False)
        if not odd.any():
            return pc.split_pattern(texts, " ")
        even = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        both = pa.concat_arrays([even, pa.array([AFTER_SPACE.split(x) for x in texts.filter(pa.array(odd)).to_pylist()], even.type)])
        place = np.where(odd, len(even) + np.cumsum(odd) - 1, np.cumsum(~odd) - 1)
        return both.take(pa.array(place))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, each with ``end_id`` behind, in a row, and how many each has."""
        if not self.cuts:
            own = [np.append(x, np.uint32(end_id)) for x in self._encode(texts.to_pylist())]
            return np.concatenate(own), np.array([len(x) for x in own], np.int64)
        if len(self.known) > MOST_PIECES or self.used > MOST_IDS:
            self.forget()
        pieces = self._cut(texts)
        edges = np.concatenate(([0], np.cumsum(pc.list_value_length(pieces).to_numpy(zero_copy_only=False))))
        flat = pieces.flatten()
        is_head = np.zeros(len(flat), bool)
        is_head[edges[:-1]] = True
        body = flat.filter(pa.array(~is_head)).dictionary_encode()
        different = body.dictionary.to_pylist()
        number = np.fromiter(map(self.known.get, different, repeat(-1)), np.int64, len(different))
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = self._learn([different[i] for i in new.tolist()])
        # what the texts begin with, and the end id, stand behind the pool for this batch
        heads = self._encode(flat.filter(pa.array(is_head)).to_pylist())
        sizes = np.array([*map(len, heads), 1], np.int64)
        behind = self._put(np.concatenate([*heads, np.array([end_id], np.uint32)])) + np.cumsum(sizes) - sizes
        at, n = np.concatenate([self.at[number], behind]), np.concatenate([self.n[number], sizes])
        entry = np.empty(len(flat), np.int64)
        entry[~is_head] = body.indices.to_numpy()
        entry[is_head] = len(different) + np.arange(len(heads))
        entry = np.insert(entry, edges[1:], len(different) + len(heads))
        ids, stops = self._gathered(entry, at, n)
        return ids, np.diff(stops[edges + np.arange(len(edges))])

    def _gathered(self, entry: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of entries in a row, ``n`` of each from place ``at`` of the pool on, and where each entry's begin."""
        stops = np.concatenate(([0], np.cumsum(n[entry])))
        ids = np.empty(int(stops[-1]), np.uint32)
        for lo in range(0, len(entry), GATHERED):
            some = entry[lo : lo + GATHERED]
            first, last = int(stops[lo]), int(stops[lo + len(some)])
            ids[first:last] = self.pool[np.repeat(at[some] - stops[lo : lo + len(some)], n[some]) + np.arange(first, last)]
        return ids, stops


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``SLICE_BYTES``, one at least: first and number."""
    block = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)]
    for lo, hi in zip(edges, edges[1:], strict=False):
        if hi > lo:
            yield lo, hi - lo


class FileBuilder:
    """Documents in order, coded block by block as they come, so that ids are held for one block and one document."""

    def __init__(self) -> None:
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.blocks: list[np.ndarray] = []
        self.counts: list[int] = []
        self.open = np.zeros(0, np.uint32)

    def add(self, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents and all their ids in a row."""
        self.doc_ids += doc_ids
        self.lengths += lengths.tolist()
        self.open = np.concatenate([self.open, ids]) if len(self.open) else ids
        whole = len(self.open) // BLOCK * BLOCK
        self._close(self.open[:whole])
        self.open = self.open[whole:].copy()

    def _close(self, ids: np.ndarray) -> None:
        for at in range(0, len(ids), BLOCK):
            part = ids[at : at + BLOCK]
            self.blocks.append(encode_block(part))
            self.counts.append(len(part))

    def write(self, stream) -> tuple[int, int]:
        """Write the file; gives the number of ids and of words."""
        self._close(self.open)
        self.open = self.open[:0]
        sizes, total = np.array([len(b) for b in self.blocks], "<u8"), sum(self.counts)
        stream.write(MAGIC + struct.pack("<IQQQQ", 1, len(self.doc_ids), total, len(self.blocks), int(sizes.sum())))
        stream.write(np.array([x or 0 for x in self.doc_ids], "<i8").tobytes())
        stream.write(np.array([x is None for x in self.doc_ids], "u1").tobytes())
        stream.write(np.array(self.lengths, "<i8").tobytes())
        stream.write((np.cumsum(sizes) - sizes).astype("<u8").tobytes())
        stream.write(np.array(self.counts, "<u4").tobytes())
        for block in self.blocks:
            stream.write(block.astype("<u8").tobytes())
        return total, int(sizes.sum())


def read_file(stream) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``(document id, first id's place in the file, ids)`` of every document; memory holds the index and one document."""
    if stream.read(4) != MAGIC:
        raise ValueError("not a token file")
    version, docs, _, blocks, _ = struct.unpack("<IQQQQ", stream.read(36))
    if version != 1:
        raise ValueError(f"token file of version {version}")
    doc_ids, nulls = np.frombuffer(stream.read(8 * docs), "<i8"), np.frombuffer(stream.read(docs), "u1")
    lengths = np.frombuffer(stream.read(8 * docs), "<i8")
    firsts, counts = np.frombuffer(stream.read(8 * blocks), "<u8").astype(np.int64), np.frombuffer(stream.read(4 * blocks), "<u4")
    base, block, have = stream.tell(), 0, np.zeros(0, np.uint64)
    at = 0
    for doc, null, n in zip(doc_ids.tolist(), nulls.tolist(), lengths.tolist(), strict=True):
        parts, short = [have], n - len(have)
        while short > 0:
            last = firsts[block + 1] if block + 1 < blocks else None
            stream.seek(base + 8 * int(firsts[block]))
            raw = stream.read(8 * int(last - firsts[block])) if last is not None else stream.read()
            parts.append(decode_block(np.frombuffer(raw, "<u8"), int(counts[block])))
            short -= len(parts[-1])
            block += 1
        have = np.concatenate(parts) if len(parts) > 1 else have
        yield (None if null else doc), at, have[:n]
        have = have[n:]
        at += n


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Encode all documents and write them as files in ascending order; gives the manifest.

    Manifest: ``part, file, docs, ids, words, start`` - ``start`` is the number of ids in all earlier files. Texts are
    shuffled once, by ranges of the id; a task writes its whole run to one new file, so a lost or repeated task leaves
    at most a file that no manifest names.
    """
    spark = docs.sparkSession
    prepare(spark)
    path = path or shared_dir(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t"))
    parts = max(1, int((rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // FILE_TEXT), spark.sparkContext.defaultParallelism)
    keys = [F.col("id").asc_nulls_first(), F.xxhash64("t")]
    # the row's number lets even equal rows lie in different files
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts, *keys, "row").sortWithinPartitions(*keys, "row").drop("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table, out = _tokenizer(tokenizer), FileBuilder()
        for batch in batches:
            for lo, n in _slices(batch.column("t")):
                ids, lengths = table.encode(batch.column("t").slice(lo, n), end_id)
                out.add(batch.column("id").slice(lo, n).to_pylist(), lengths, ids)
        if out.doc_ids:
            part = TaskContext.get().partitionId()
            file = f"{path}/part-{part:06d}-{uuid.uuid4().hex}.wms8"
            with open_output(file) as stream:
                n, words = out.write(stream)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [file], "docs": [len(out.doc_ids)], "ids": [n], "words": [words]})

    manifest = materialise(dealt.mapInArrow(run, "part int, file string, docs long, ids long, words long"), "manifest")
    start = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return manifest.withColumn("start", start)


def read_tokens(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, start, n_tokens, ids_crc32)`` of every document in a manifest's files."""
    spark = manifest.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with open_input(file) as stream:
                    rows = [(doc, start + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for doc, at, ids in read_file(stream)]
                # a null id is a null of a column of longs: ids never become doubles
                columns = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 4
                yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "n", "crc"])

    files = manifest.select("file", "start").coalesce(1).repartition(max(1, spark.sparkContext.defaultParallelism))
    out = files.mapInArrow(run, "id long, start long, n long, crc long")
    return out.select(F.col("id").alias(id_col), "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
