"""Text keys and small text functions as Columns: everything that is compared is compared by one of these keys.

White space is what Unicode calls so (``(?U)\\s``). NFC has no built-in function: its pandas UDF gets only the texts that
hold a character that NFC could change, and nulls for all others. Inside lambda functions, where no UDF can run, keys take
``nfc=False``, over arrays that ``nfc_each`` has been through. Case folding is built from the built-in lower case.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings that fold onto one, and characters that are deleted.
APOSTROPHES = "‘’‚‛ʼ´`"
QUOTES = "“”„‟«»″"
DASHES = "‐‑‒–—―−"
SPACES = "\u00a0\u2002\u2003\u2007\u2009\u200a\u202f"
DELETED = "\u00ad\u200b\ufeff_"
EDGE_MARKS = "\"'‘’“”‚‛„‟"
# Modes of transport and their synonyms.
MODES = ("steamer", "railway", "elephant", "sledge", "carriage", "on_foot", "other")
MODE_SYNONYMS = {
    "train": "railway", "rail": "railway", "train_railway": "railway",
    "ship": "steamer", "boat": "steamer", "steamship": "steamer", "steamboat": "steamer", "schooner": "steamer",
    "walking": "on_foot", "walked": "on_foot", "foot": "on_foot",
    "horse": "carriage", "cart": "carriage", "wagon": "carriage", "palanquin": "carriage",
    "sled": "sledge", "sleigh": "sledge", "wind_sled": "sledge", "wind_sledge": "sledge",
}


#: Characters that NFC may change, or that may change with one before them.
NOT_NFC = "[\\x{300}-\\x{1FFF}\\x{2000}\\x{2001}\\x{20D0}-\\x{20FF}\\x{2100}-\\x{10FFFF}]"


@F.pandas_udf(T.StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfc_each(arrays: pd.Series) -> pd.Series:
    return arrays.map(lambda a: None if a is None else [None if x is None else unicodedata.normalize("NFC", x) for x in a])


def nfc(text: Column) -> Column:
    odd = text.rlike(NOT_NFC)
    return F.when(odd, _nfc(F.when(odd, text))).otherwise(text)


def nfc_each(texts: Column) -> Column:
    """NFC of an array's texts."""
    odd = F.exists(texts, lambda x: F.coalesce(x.rlike(NOT_NFC), F.lit(False)))
    return F.when(odd, _nfc_each(F.when(odd, texts))).otherwise(texts)


# What case folding makes of lower-case characters, by Unicode's rule; those of one character, and those of more.
_FOLDED = {c: c.casefold() for c in map(chr, range(0x20000)) if c.lower() == c != c.casefold()}
_ONE = {c: f for c, f in _FOLDED.items() if len(f) == 1}
_MANY = {c: f for c, f in _FOLDED.items() if len(f) > 1}


def casefold(text: Column) -> Column:
    """Full case folding: lower case, and what folding makes of the characters that have several lower-case forms.

    Texts of ASCII only, the most by far, are just lower-cased.
    """
    lower = F.lower(text)
    one = F.translate(lower, "".join(_ONE), "".join(_ONE.values()))
    table = F.create_map(*[F.lit(x) for pair in _MANY.items() for x in pair])
    spelled = F.array_join(F.transform(F.split(one, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    return F.when(~text.rlike(NOT_ASCII), lower).when(text.rlike(_MAY_SPELL), spelled).otherwise(one)


NOT_ASCII = "[^\\x00-\\x7f]"
#: Blocks that hold all characters that folding makes several of: a short class, so that other texts are passed quickly.
_MAY_SPELL = "[\\xDF\\x{130}\\x{149}\\x{1F0}\\x{390}\\x{3B0}\\x{587}\\x{1E96}-\\x{1FFC}\\x{FB00}-\\x{FB17}]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


_FROM = APOSTROPHES + QUOTES + DASHES + SPACES + DELETED
_TO = "'" * len(APOSTROPHES) + '"' * len(QUOTES) + "-" * len(DASHES) + " " * len(SPACES)


def fold(text: Column, nfc: bool = True) -> Column:
    """Typography folded to ASCII spellings, in NFC; line ends stay."""
    return F.translate(F.replace(_composed(text) if nfc else text, F.lit("…"), F.lit("...")), _FROM, _TO)


_composed = nfc


def normalize(text: Column, nfc: bool = True) -> Column:
    """Folded, with runs of white space and of hyphens made one, and stripped."""
    return F.trim(F.regexp_replace(F.regexp_replace(fold(text, nfc), r"(?U)\s+", " "), "-{2,}", "-"))


def match_key(text: Column, nfc: bool = True) -> Column:
    """Normalised and case-folded."""
    return casefold(normalize(text, nfc))


def strip_edge_quotes(text: Column) -> Column:
    """White space, then quotation marks, then white space off both ends, in this order."""
    marks = f"[{EDGE_MARKS}]"
    return strip(F.regexp_replace(strip(text), f"^{marks}+|{marks}+$", ""))


def strip_article(key: Column) -> Column:
    return F.regexp_replace(key, r"^(?:the|an|a) (?=.*\S)", "")


def place_key(name: Column, nfc: bool = True) -> Column:
    return strip_article(strip_edge_quotes(match_key(name, nfc)))


def node_key(name: Column) -> Column:
    return match_key(F.regexp_replace(name, r"\s*\([^)]*\)\s*$", ""))


def split_via(destination: Column) -> Column:
    """``struct(place, via)``: "X via A and B" as X and [A, B]; a parenthesis at the end of X goes."""
    parts = F.split(destination, r"(?i)\s+_?vi[aâ]_?\s+", 2)
    via = F.filter(F.transform(F.split(F.get(parts, F.lit(1)), r"(?i)\s+and\s+"), strip), lambda x: x != "")
    place = strip(F.regexp_replace(F.get(parts, F.lit(0)), r"\s*\([^)]*\)\s*$", ""))
    return F.struct(place.alias("place"), F.coalesce(via, F.array().cast("array<string>")).alias("via"))


def normalise_mode(mode: Column) -> Column:
    """A mode of transport by its name or a synonym, else ``other``; null stays."""
    key = F.regexp_replace(F.lower(strip(mode)), r"[\s\-/]+", "_")
    known = F.create_map(*[F.lit(x) for k, v in {**MODE_SYNONYMS, **{m: m for m in MODES}}.items() for x in (k, v)])
    return F.when(mode.isNotNull(), F.coalesce(F.try_element_at(known, key), F.lit("other")))


def parse_modes(phrase: Column) -> Column:
    """The modes of a phrase such as "steamers and rail", each once, in order."""
    words = F.filter(F.transform(F.split(phrase, r"(?i)\s+and\s+"), lambda m: F.regexp_replace(strip(m), "s$", "")), lambda m: m != "")
    return F.array_distinct(F.transform(words, normalise_mode))


def name_changed(name: Column, modern: Column) -> Column:
    """Whether the modern label (before " (") is another name; false where there is none."""
    label = F.substring_index(modern, " (", 1)
    return F.coalesce((F.trim(modern) != "") & (match_key(label) != match_key(name)), F.lit(False))


def sparql_string(text: Column) -> Column:
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return F.concat(F.lit('"'), text, F.lit('"'))


def qid_from_uri(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


_ROMAN = ((1000, "M"), (900, "CM"), (500, "D"), (400, "CD"), (100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I"))


def int_to_roman(value: Column) -> Column:
    """A canonical numeral for 1 to 3999, else null."""
    parts, rest = [], value
    for n, mark in _ROMAN:
        parts.append(F.repeat(F.lit(mark), F.floor(rest / n).cast("int")))
        rest = rest % n
    return F.when(value.between(1, 3999), F.concat(*parts))


def roman_to_int(numeral: Column) -> Column:
    """The value of a canonical numeral (any case), else null: what it encodes to must be itself."""
    digit = lambda c: reduce(lambda a, x: a.when(c == x[1], x[0]), [x for x in _ROMAN if len(x[1]) == 1], F.when(F.lit(False), 0)).otherwise(0)
    upper = F.upper(strip(numeral))
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last"))
    total = F.aggregate(
        F.reverse(F.split(upper, "")),
        start,
        lambda s, c: F.struct(F.when(digit(c) < s["last"], s["sum"] - digit(c)).otherwise(s["sum"] + digit(c)).alias("sum"), F.greatest(s["last"], digit(c)).alias("last")),
        lambda s: s["sum"],
    )
    return F.when(int_to_roman(total) == upper, total)


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def first_line(text: Column) -> Column:
    """The first line that isn't blank, stripped; empty if there is none."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")
    return F.coalesce(F.get(lines, F.lit(0)), F.lit(""))


def chapter_text(number: Column, title: Column, body: Column) -> Column:
    return F.concat(F.lit("CHAPTER "), F.lpad(number.cast("string"), 2, "0"), F.lit("\n"), title, F.lit("\n\n"), body, F.lit("\n"))


def looks_like_a_role(name: Column) -> Column:
    """Whether a name, without its article, begins with anything but a capital."""
    return ~F.substring(F.regexp_replace(strip(name), r"(?i)^(?:the|an|a)\s+", ""), 1, 1).rlike(r"\p{Lu}")


# Character entities that visible text resolves without Python.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&ndash;": "–", "&mdash;": "—", "&hellip;": "…"}


def visible_text(page: Column) -> Column:
    """The words of a page that a reader sees: no scripts, styles, head, comments or tags; words have a letter or digit."""
    for pattern in (r"(?is)<(script|style)\b.*?</\1\s*>", r"(?is)<head\b.*?</head\s*>", r"(?s)<!--.*?-->", r"(?s)<[^>]*>"):
        page = F.regexp_replace(page, pattern, " ")
    for entity, char in ENTITIES.items():
        page = F.replace(page, F.lit(entity), F.lit(char))
    page = F.replace(page, F.lit("&amp;"), F.lit("&"))
    return F.array_join(F.filter(words(page), lambda w: w.rlike(r"[\p{L}\p{N}]")), " ")


def fill(template: Column, values: Mapping[str, Column]) -> Column:
    """``{slot}`` replaced by values, in order; unknown slots stay."""
    for slot, value in values.items():
        template = F.replace(template, F.lit("{" + slot + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return template


def escape(value: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(raw), F.lit(entity))
    return value


def placeholder_names(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\{(\w+)\}"), F.lit(1))))


def render_prompt(template: Column, number: Column, text: Column) -> Column:
    """The template with its two markers filled; an error for an empty text or one that holds a marker."""
    bad = F.coalesce(strip(text) == "", F.lit(True)) | text.contains("{{N}}") | text.contains("{{CHAPTER_TEXT}}")
    done = F.replace(F.replace(template, F.lit("{{N}}"), number.cast("string")), F.lit("{{CHAPTER_TEXT}}"), text)
    return F.when(bad, F.raise_error(F.lit("a prompt needs a text without markers")).cast("string")).otherwise(done)


def fingerprint(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, in hex; null for null."""
    return F.sha2(text, 256)


def render_path(steps: Column) -> Column:
    """Steps such as ["a", "0", "b"] as ``a[0].b``."""
    return F.regexp_replace(F.array_join(F.transform(steps, lambda s: F.when(s.rlike("^[0-9]+$"), F.concat(F.lit("["), s, F.lit("]"))).otherwise(F.concat(F.lit("."), s))), ""), r"^\.", "")


def number_or_null(cell: Column, kind: str = "double") -> Column:
    """A cell's number, else null; whole numbers must be written as such."""
    text = strip(cell)
    return text.try_cast(kind) if kind == "double" else F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast(kind))


def is_confirmed(cell: Column) -> Column:
    return F.coalesce(F.lower(strip(cell)).isin("y", "yes", "true", "1"), F.lit(False))


def is_rejected(cell: Column) -> Column:
    return F.coalesce(F.lower(strip(cell)).isin("n", "no", "false", "0"), F.lit(False))


def review_status(cell: Column) -> Column:
    return F.when(is_confirmed(cell), "confirmed").when(is_rejected(cell), "rejected").otherwise("unconfirmed")


def fixed(value: Column, places: int) -> Column:
    """A number with so many decimals, as C and Python write it: the double's exact value is rounded, ties to even.

    ``format_string`` rounds the shortest decimal that reads back as the double, ties upward: 0.845, which is a little less,
    becomes 0.85 there and 0.84 here. What is behind the point is split in two halves, whose products are exact.
    """
    scale, y = 10**places, F.abs(value)
    whole = F.floor(y)
    part = y - whole
    far = part * 134217729.0
    high = far - (far - part)
    n = F.floor(part * scale)
    over = (high * scale - n - 0.5) + (part - high) * scale
    up = n + F.when((over > 0) | (over == 0) & (n % 2 == 1), 1).otherwise(0)
    written = F.format_string(f"%d.%0{places}d", whole + F.when(up == scale, 1).otherwise(0), up % scale)
    return F.when((y > 0) & (y < 2.0**62), F.concat(F.when(value < 0, "-").otherwise(""), written)).when(value.isNotNull(), F.format_string(f"%.{places}f", value))


@F.pandas_udf(T.DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity 0 to 100 by insertions and deletions: 200 * longest common subsequence / total length.

    The subsequence is found by the bit-parallel recurrence of Hyyro on Python's integers.
    """
    return pd.Series([None if x is None or y is None else _indel(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def best_ratio(name: pd.Series, spellings: pd.Series) -> pd.Series:
    """The best ``indel_ratio`` of a name and any of some spellings, which are one string with NULs between."""
    places, split = {}, {}
    out = []
    for a, b in zip(name, spellings, strict=True):
        if a is None or b is None:
            out.append(None)
            continue
        if a not in places:
            places[a] = _places(a)
        if b not in split:
            split[b] = b.split("\0")
        out.append(max([_indel(a, x, places[a]) for x in split[b]]))
    return pd.Series(out, dtype="float64")


def _places(a: str) -> dict[str, int]:
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    return places


def _indel(a: str, b: str, places: dict[str, int] | None = None) -> float:
    if not a and not b:
        return 100.0
    places = _places(a) if places is None else places
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & places.get(c, 0)
        v = (v + u | v - u) & full
    return 200.0 * (len(a) - v.bit_count()) / (len(a) + len(b))


SPAN = T.StructType([T.StructField("ratio", T.DoubleType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
# Windows on each side of the common block, and characters between them.
WINDOWS, WINDOW_STEP = 4, 6


@F.pandas_udf(SPAN)
def best_span(haystack: pd.Series, needle: pd.Series) -> pd.DataFrame:
    """Where a text is most like another, by difflib: nine windows around their longest common block, widened to words."""
    return pd.DataFrame([closest_span(h or "", n or "") for h, n in zip(haystack, needle, strict=True)], columns=["ratio", "start", "end"])


def closest_span(text: str, wanted: str) -> tuple[float, int, int]:
    """``best_span`` of one pair."""
    from difflib import SequenceMatcher

    if not text or not wanted:
        return 0.0, 0, 0
    block = SequenceMatcher(None, text, wanted, autojunk=False).find_longest_match()
    if not block.size:
        return 0.0, 0, 0
    windows = []
    for step in range(-WINDOWS, WINDOWS + 1):
        lo = max(0, min(block.a - block.b + WINDOW_STEP * step, len(text) - 1))
        hi = min(len(text), lo + len(wanted))
        windows.append((SequenceMatcher(None, text[lo:hi], wanted).ratio(), -step, lo, hi))
    ratio, _, lo, hi = max(windows, key=lambda w: (w[0], w[1]))
    if ratio == 0:
        return 0.0, 0, 0
    inside = lambda i: 0 < i < len(text) and _wordy(text[i - 1]) and _wordy(text[i])
    while inside(lo):
        lo -= 1
    while inside(hi):
        hi += 1
    return ratio, lo, hi


def _wordy(c: str) -> bool:
    return c.isalnum() or c == "_"


@F.pandas_udf(T.StringType())
def inline_diff(expected: pd.Series, actual: pd.Series) -> pd.Series:
    """What to change in ``expected`` to get ``actual``: ``[-gone-]`` and ``{+new+}``."""
    return pd.Series([None if a is None or b is None else _diff(a, b) for a, b in zip(expected, actual, strict=True)])


def _diff(a: str, b: str) -> str:
    from difflib import SequenceMatcher

    out = ""
    for tag, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if tag == "equal":
            out += a[i:j]
            continue
        out += (f"[-{a[i:j]}-]" if j > i else "") + (f"{{+{b[k:m]}+}}" if m > k else "")
    return out
