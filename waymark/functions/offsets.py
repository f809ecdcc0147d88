"""From a place in a key back to the raw text: offset maps as runs of equal shift.

A key (``text.normalize``, ``text.casefold``) keeps most characters one for one. Where it doesn't - white space, hyphens,
deleted marks, an ellipsis character, sequences that NFC composes, letters that case folding spells out - a chunk of
``old`` raw characters became ``new`` ones. A map is an array of ``(skip, old, new, reach)``: so many characters that are alike,
then a chunk, of which ``reach`` raw characters belong to a match that ends within it (runs of white space and hyphens are
one character by their first). It has one entry for each chunk, is linear in the text, and is kept with the text's key.

Maps are composed by looking a place up in one after the other: case-folded, normalised, raw.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as K

_GAP = f"\\s{K.DELETED}"
_HYPHEN = f"\\-{K.DASHES}"
#: Characters that NFC makes several of.
_SPELLED = "".join(c for c in map(chr, range(0x20000)) if len(unicodedata.normalize("NFC", c)) > 1)
#: Characters that case folding makes several of.
_FOLDS_LONG = "".join(c for c in map(chr, range(0x20000)) if len(c.casefold()) > 1)
#: What normalising doesn't keep one for one, the start of a text aside.
PLAIN_CHUNK = f"(?U)[{_HYPHEN}][{_HYPHEN}{K.DELETED}]++|[{_GAP}]{{2,}}+|[{K.DELETED}]|…[…{K.DELETED}]*+"
CHUNK = (
    f"{PLAIN_CHUNK}|[^\\p{{M}}{_GAP}{_HYPHEN}…]?+\\p{{M}}++|[\\x{{AC00}}-\\x{{D7A3}}]?+[\\x{{1100}}-\\x{{11FF}}]++|[{_SPELLED}]"
)
LEAD = f"(?U)\\A[{_GAP}]++"


def _runs(skips: Column, chunks: Column, changed: Column, new, reach) -> Column:
    """A map from the texts between chunks, the chunks, and what a part of the key's work makes of them."""
    pairs = F.zip_with(chunks, changed, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    entry = lambda s, p: F.struct(
        F.coalesce(F.length(s), F.lit(0)).alias("skip"), F.coalesce(F.length(p["x"]), F.lit(0)).alias("old"),
        F.coalesce(new(p["x"], p["y"]), F.lit(0)).cast("int").alias("new"), F.coalesce(reach(p["x"]), F.lit(0)).cast("int").alias("reach"),
    )
    return F.zip_with(skips, pairs, entry)


def normalized_parts(raw: Column) -> Column:
    """What the map of ``normalized_runs`` is made of, by regular expressions: kept as a column, that is done once."""
    body = F.regexp_replace(raw, LEAD, "")
    # texts in which nothing can be composed, the most by far, need only the first alternatives
    odd = raw.rlike(K.NOT_NFC)
    skips = F.when(odd, F.split(body, CHUNK, -1)).otherwise(F.split(body, PLAIN_CHUNK, -1))
    chunks = F.when(odd, F.regexp_extract_all(body, F.lit(CHUNK), F.lit(0))).otherwise(F.regexp_extract_all(body, F.lit(PLAIN_CHUNK), F.lit(0)))
    return F.struct((F.length(raw) - F.length(body)).alias("lead"), skips.alias("skips"), chunks.alias("chunks"))


def normalized_runs(raw: Column) -> Column:
    """The map from ``text.normalize`` to the raw text."""
    return runs_of(normalized_parts(raw))


def runs_of(parts: Column) -> Column:
    """``normalized_runs`` of ``normalized_parts``."""
    chunks = parts["chunks"]

    def new(x: Column, composed: Column) -> Column:
        gap = F.when(x.rlike(r"(?U)\s"), 1).otherwise(0)
        dots = 3 * F.regexp_count(x, F.lit("…"))
        return F.when(x.rlike(f"(?U)^[{_GAP}]"), gap).when(x.rlike(f"^[{_HYPHEN}]"), 1).when(x.startswith("…"), dots).otherwise(F.length(composed))

    single = lambda x: F.when(x.rlike(f"(?U)^[{_GAP}{_HYPHEN}]"), 1).otherwise(F.length(x))
    head = F.array(F.struct(F.lit(0).alias("skip"), parts["lead"].alias("old"), F.lit(0).alias("new"), F.lit(0).alias("reach")))
    return F.concat(head, _runs(parts["skips"], chunks, K.nfc_each(chunks), new, single))


def casefold_runs(norm: Column) -> Column:
    """The map from ``text.casefold`` to the text that it was made of."""
    pattern = f"[{_FOLDS_LONG}]"
    chunks = F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))
    return _runs(F.split(norm, pattern, -1), chunks, chunks, lambda x, _: F.length(K.casefold(x)), F.length)


def span_in(runs: Column, start: Column, end: Column) -> Column:
    """``(start, end)`` in the text that a map leads to, for a span of the key; places from 0, ends exclusive.

    A span that begins within a chunk begins with it; one that ends within a chunk ends at the chunk's ``reach``. Null for
    a null or empty span.
    """
    none = F.lit(None).cast("int")
    zero = F.struct(F.lit(0).alias("new"), F.lit(0).alias("old"), none.alias("first"), none.alias("last"), start.cast("int").alias("start"), (end - 1).cast("int").alias("stop"))

    def step(s: Column, r: Column) -> Column:
        alike, after = s["new"] + r["skip"], s["new"] + r["skip"] + r["new"]
        chunk = s["old"] + r["skip"]
        first = F.when(s["first"].isNotNull(), s["first"]).when(s["start"] < alike, s["old"] + s["start"] - s["new"]).when(s["start"] < after, chunk)
        last = F.when(s["last"].isNotNull(), s["last"]).when(s["stop"] < alike, s["old"] + s["stop"] - s["new"] + 1).when(s["stop"] < after, chunk + r["reach"])
        return F.struct(after.alias("new"), (chunk + r["old"]).alias("old"), first.alias("first"), last.alias("last"), s["start"].alias("start"), s["stop"].alias("stop"))

    done = F.aggregate(runs, zero, step)
    return F.when(end > start, F.struct(done["first"].alias("start"), done["last"].alias("end")))


def line_of(raw: Column, place: Column) -> Column:
    """The line, from 1, of a place of the raw text."""
    before = F.substring(raw, F.lit(1), place)
    return 1 + F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit("")))
