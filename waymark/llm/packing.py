"""Best-fit packing of tokenised documents into sequences of one length, by partitions and then by a tree.

A document's ids, with the end id, are cut into pieces of ``capacity`` ids only if there are more. Pieces, without their
ids, are dealt by hash to partitions of some ``NODE`` of them, so that long and short ones meet whatever the table's order.
Each partition packs its own best-fit, longest first, and emits the bins that are nearly full. The bins that aren't are
items, as long as what they hold, of the next level: again dealt to nodes of some ``NODE`` items, best-fit again, and so on
until one node has all that is left, or a level joins hardly any. Places of pieces in their sequences are the sums of the
places on the way up; only pieces of bins that weren't full at once are joined with them.

A node's memory is bounded by ``NODE`` items, a tokenising task's by one run of texts; the driver only counts.

Edge cases: a null or empty text is the end id alone; rows with a null id are documents; repeated ids and rows are packed
each; a text of any length is cut as often as needed; an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialise, prepare, text_or_empty
from .token_ids import MOST_IDS, MOST_PIECES, PieceTable, _slices

CAPACITY, END_ID = 2048, 0
#: A bin with at most this share of its room left is nearly full.
SLACK = 1 / 512
#: Items of a node, on average.
NODE = 1 << 15
#: Levels end when one joins less than this share of its items.
LEAST_JOINED = 0.01

#: Texts that are only cut at spaces: marks that letters may join with, the letter whose lower case has one, and added tokens.
ODD = r"\p{M}|\x{130}|<\|"
#: A letter before anything of ASCII but letters and spaces: there a word always ends.
WORD_END = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}])([!-@\[-`{-~])"


class WordTable(PieceTable):
    """A tokenizer that drops white space and tokenises words alone: it remembers the ids of the pieces between spaces.

    That needs a normalizer of NFC, white space and lower case only, and a pattern whose matches hold no white space: then
    a text's ids are those of its pieces in a row. More cuts, where a word ends before a mark, and lower case of ASCII
    make fewer different pieces. The tests hold this against whole-text encoding; tokenizers of other kinds encode whole texts.
    """

    def __init__(self, tokenizer) -> None:
        super().__init__(tokenizer)
        parts = json.loads(tokenizer.to_str())
        kinds = lambda part, key: [x["type"] for x in (parts[part] or {}).get(key, ())]
        split = ((parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        pattern = split.get("pattern", {}).get("Regex", "")
        self.words = (
            kinds("normalizer", "normalizers") == ["NFC", "Replace", "Lowercase"] and kinds("pre_tokenizer", "pretokenizers") == ["Split", "ByteLevel"]
            and split["behavior"] == "Removed" and split["invert"] and pattern == WORDS and not parts["truncation"] and not parts["padding"] and not parts["model"]["dropout"]
        )

    @staticmethod
    def _cut_words(texts: pa.Array) -> pa.Array:
        odd = pc.match_substring_regex(texts, ODD)
        plain = pc.replace_substring_regex(pc.ascii_lower(texts), r"[\t-\r]", " ")
        return pc.split_pattern(pc.if_else(odd, texts, pc.replace_substring_regex(plain, WORD_END, r"\1 \2")), " ")

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        if not self.words:
            return super().encode(texts, end_id)
        if len(self.known) > MOST_PIECES or self.used > MOST_IDS:
            self.forget()
        pieces = self._cut_words(texts)
        edges = np.concatenate(([0], np.cumsum(pc.list_value_length(pieces).to_numpy(zero_copy_only=False))))
        body = pieces.flatten().dictionary_encode()
        different = body.dictionary.to_pylist()
        number = np.array([self.known.get(x, -1) for x in different], np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = self._learn_words([different[i] for i in new.tolist()])
        at = np.append(self.at[number], self._put(np.array([end_id], np.uint32)))
        n = np.append(self.n[number], np.int32(1))
        entry = np.insert(body.indices.to_numpy().astype(np.int64), edges[1:], len(different))
        ids, stops = self._gathered(entry, at, n)
        return ids, np.diff(stops[edges + np.arange(len(edges))])

    def _learn_words(self, pieces: list[str]) -> np.ndarray:
        own = self._encode(pieces)
        sizes = np.array([len(x) for x in own], np.int64)
        at = self._put(np.concatenate(own))
        self.used += int(sizes.sum())
        have, more = len(self.known), len(pieces)
        if have + more > len(self.at):
            room = np.zeros(have + 2 * more, np.int64)
            self.at, self.n = np.concatenate([self.at[:have], room]), np.concatenate([self.n[:have], room.astype(np.int32)])
        self.at[have : have + more], self.n[have : have + more] = at + np.cumsum(sizes) - sizes, sizes
        self.known.update(zip(pieces, range(have, have + more), strict=True))
        return np.arange(have, have + more)


#: Fixed value: the pattern of words and marks for which cuts at spaces and at words' ends are proven.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@cache
def _tokenizer(path: str) -> WordTable:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return WordTable(Tokenizer.from_file(path))


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each item's bin and place, and each bin's content: items longest first, each into the fullest bin that has room."""
    order = np.argsort(-sizes, kind="stable")
    bins, places = np.empty(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    full = int((sizes >= capacity).sum())
    bins[order[:full]] = np.arange(full)
    rest = order[full:]
    content = [capacity] * full
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r: there are bins with room r
    own_bin, own_place = [], []
    for size in sizes[rest].tolist():
        fit = some >> size
        if fit:
            r = size + (fit & -fit).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                some ^= 1 << r
        else:
            r, b = capacity, len(content)
            content.append(0)
        own_bin.append(b)
        own_place.append(content[b])
        content[b] += size
        r -= size
        if r:
            room[r].append(b)
            some |= 1 << r
    bins[rest], places[rest] = own_bin, own_place
    return bins, places, np.array(content, np.int64)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``(item, size, id, piece, start, crc)`` of every piece, tokenised where the documents lie; ``item`` numbers them."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table, done = _tokenizer(tokenizer), TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, n in _slices(batch.column("t")):
                ids, lengths = table.encode(batch.column("t").slice(lo, n), end_id)
                count = -(-lengths // capacity)
                doc = np.repeat(np.arange(n), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                size = np.minimum(capacity, lengths[doc] - start)
                at, raw = (np.repeat(np.cumsum(lengths) - lengths, count) + start) * 4, memoryview(ids.astype("<u4").tobytes())
                crc = np.array([zlib.crc32(raw[a : a + 4 * k]) for a, k in zip(at.tolist(), size.tolist(), strict=True)], np.int64)
                item, done = np.arange(done, done + len(doc)), done + len(doc)
                yield pa.RecordBatch.from_pydict({"item": item, "size": size, "id": batch.column("id").slice(lo, n).take(pa.array(doc)), "piece": piece.astype(np.int32), "start": start, "crc": crc})

    return rows.mapInArrow(run, "item long, size long, id long, piece int, start long, crc long")


def packed(items: DataFrame, n: int, level: int, capacity: int, least: int) -> DataFrame:
    """``items`` (item, size and others; ``n`` of them) with ``bin, at, content, open``: dealt to nodes of some ``NODE``
    of them, each packed best-fit. A bin is ``open`` if more than ``least`` of its room is left."""
    node = F.pmod(F.xxhash64("item", F.lit(level)), F.lit(max(1, -(-n // NODE)))).alias("node")
    own = items.columns

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("item", "ascending")]).combine_chunks()
        first = (level << 56) + (table.column("node")[0].as_py() << 32)
        bins, places, content = best_fit(table.column("size").to_numpy(), capacity)
        return pa.table({c: table.column(c) for c in own} | {"bin": bins + first, "at": places, "content": content[bins], "open": content[bins] < capacity - least})

    fields = ", ".join(f"{c} {t}" for c, t in items.dtypes)
    return items.select(node, *own).groupBy("node").applyInArrow(run, f"{fields}, bin long, at long, content long, open boolean")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", slack: float = SLACK) -> DataFrame:
    """``(id_col, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece of every document."""
    least = int(capacity * slack)
    items = materialise(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    levels: list[DataFrame] = []
    while (n := items.count()) > 1 or not levels:
        levels.append(materialise(packed(items, n, len(levels), capacity, least), "packed"))
        if n <= NODE or levels[-1].filter("at = 0").count() > (1 - LEAST_JOINED) * n and len(levels) > 1:
            break
        items = levels[-1].filter("open and at = 0").select(F.col("bin").alias("item"), F.col("content").alias("size"))
    places = None
    for level in reversed(levels[1:]):
        own = level.select("item", F.col("bin").alias("sequence"), F.col("at").alias("shift"))
        if places is not None:
            above = places.select(F.col("item").alias("sequence"), F.col("sequence").alias("top"), F.col("shift").alias("more"))
            own = own.join(above, "sequence", "left").select("item", F.coalesce("top", "sequence").alias("sequence"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
        places = materialise(own, "places")
    columns = [F.col("id").alias(id_col), "piece", "start", F.col("size").alias("length"), F.col("crc").alias("ids_crc32")]
    if places is None:
        return levels[0].select(*columns, F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    settled = levels[0].filter("not open").select(*columns, F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    moved = levels[0].filter("open").join(places.withColumnRenamed("item", "bin"), "bin")
    return settled.unionByName(moved.select(*columns, F.col("sequence").alias("sequence_id"), (F.col("at") + F.col("shift")).alias("offset")))
