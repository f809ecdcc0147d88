"""Texts cut into chapters, contents, itineraries and chapter selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import text as K

from .quantiles import exact_quantiles

# Fixed values.
START = r"(?im)^\*\*\*\s*START OF (?:THE |THIS )?PROJECT GUTENBERG[^\n]*$"
END = r"(?im)^\*\*\*\s*END OF (?:THE |THIS )?PROJECT GUTENBERG[^\n]*$"
HEADING = r"(?m)^CHAPTER[ \t]+([IVXLC]+)\.[ \t]*$"
CONTENTS = r"(?m)^[ \t]+CHAPTER[ \t]+([IVXLC]+)\.[ \t]+(\S.*)$"
TITLE_LINES = 4
BLOCK_START, BLOCK_END = r"(?m)^From\s+.+?\s+to\s+.+?,\s+by\s+", r"(?m)^Total\s*\.{3,}\s*(\d+)\s+days\."
BLOCK_CHARS = 2000
LEG = r"(?m)^From\s+(.+?)\s+to\s+(.+?),\s+by\s+([^.]+?)\s*\.{3,}\s*(\d+)\s*(?:days|”|\")\s*$"


def _must(ok: Column, value: Column, message: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.lit(message)).cast("string"))


def strip_boilerplate(text: Column) -> Column:
    """What is between the licence's start and end lines; an error if either is missing."""
    after = F.get(F.split(text, START, 2), F.lit(1))
    return _must(text.rlike(START) & after.rlike(END), F.get(F.split(after, END, 2), F.lit(0)), "no start or end marker")


def strip_front_matter(text: Column) -> Column:
    """From the first chapter heading on; an error if there is none."""
    at = F.regexp_instr(text, F.lit(HEADING))
    return _must(at > 0, F.substring(text, at, F.length(text)), "no chapter heading")


def split_chapters(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per heading: ``number, title, body`` besides the input's columns but the text."""
    parts = F.split(F.col(text), HEADING)
    numerals = F.regexp_extract_all(F.col(text), F.lit(HEADING), F.lit(1))
    zipped = F.arrays_zip(numerals.alias("numeral"), F.slice(parts, F.lit(2), F.size(numerals)).alias("span"))
    rows = docs.select(*[c for c in docs.columns if c != text], F.explode(zipped).alias("_c"))
    lines = F.transform(F.split(F.regexp_replace(F.col("_c.span"), r"^\s*\n", ""), "\n"), K.strip)
    blank = F.array_position(lines, "")
    count = F.least(F.lit(TITLE_LINES), F.when(blank > 0, blank - 1).otherwise(F.size(lines))).cast("int")
    rows = rows.withColumn("_lines", lines).withColumn("_n", count)
    title = K.normalize(F.array_join(F.slice("_lines", F.lit(1), F.col("_n")), " "))
    body = K.strip(F.array_join(F.slice("_lines", F.col("_n") + 1, F.size("_lines")), "\n"))
    return rows.select(*[c for c in docs.columns if c != text], K.roman_to_int(F.col("_c.numeral")).alias("number"), title.alias("title"), body.alias("body"))


def contents_titles(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(K.nfc(text), F.lit(CONTENTS), F.lit(2)), lambda t: K.normalize(t, nfc=False))


def itinerary_block(text: Column, most: int = BLOCK_CHARS) -> Column:
    """The printed table, folded, with its wrapped lines joined; null if there is none or it is too long."""
    begin = F.regexp_instr(text, F.lit(BLOCK_START))
    rest = F.substring(text, begin, F.length(text))
    last = F.regexp_extract(rest, BLOCK_END, 0)
    end = F.call_function("locate", last, rest)
    block = F.substring(rest, F.lit(1), end + F.length(last) - 1)
    folded = F.regexp_replace(K.fold(block), r"\n(?=[a-z])", " ")
    return F.when((begin > 0) & (last != "") & (F.length(block) <= most), folded)


def parse_itinerary(docs: DataFrame, text: str = "text", most: int = BLOCK_CHARS) -> DataFrame:
    """One row per leg: ``index, origin, destination, via, modes, mode_as_written, days`` besides the input's columns."""
    block = itinerary_block(F.col(text), most)
    groups = [F.regexp_extract_all(block, F.lit(LEG), F.lit(i)).alias(n) for i, n in enumerate(("origin", "destination", "mode", "days"), 1)]
    rows = docs.select(*[c for c in docs.columns if c != text], F.posexplode(F.arrays_zip(*groups)).alias("index", "_leg"))
    via = K.split_via(F.col("_leg.destination"))
    bare = lambda c: K.strip(F.regexp_replace(c, r"\s*\([^)]*\)\s*$", ""))
    return rows.select(
        *[c for c in docs.columns if c != text], "index", bare(F.col("_leg.origin")).alias("origin"), via["place"].alias("destination"), via["via"].alias("via"),
        K.parse_modes(F.col("_leg.mode")).alias("modes"), F.col("_leg.mode").alias("mode_as_written"), F.col("_leg.days").cast("int").alias("days"),
    )


def route_nodes(legs: DataFrame) -> DataFrame:
    """``index, name, key, printed_forms, day`` of the stops: each leg's origin, and the last one's destination."""
    last = legs.agg(F.max_by("destination", "index").alias("name"), (F.max("index") + 1).alias("index"))
    names = legs.select("index", F.col("origin").alias("name")).unionByName(last.select("index", "name"))
    forms = names.unionByName(legs.select(F.col("index") + 1, F.col("destination")).toDF("index", "name"))
    printed = forms.groupBy("index").agg(F.array_sort(F.collect_set("name")).alias("printed_forms"))
    days = legs.select((F.col("index") + 1).alias("index"), "days")
    day = F.sum(F.coalesce("days", F.lit(0))).over(Window.orderBy("index"))
    return names.join(printed, "index").join(days, "index", "left").select("index", "name", K.node_key(F.col("name")).alias("key"), "printed_forms", day.alias("day"))


def chapter_selection(spec: Column) -> Column:
    """"1-5,12" as a sorted array of numbers, each once."""
    one = lambda part: F.sequence(F.split_part(part, F.lit("-"), F.lit(1)).cast("int"), F.split_part(part, F.lit("-"), F.lit(-1)).cast("int"))
    parts = F.filter(F.transform(F.split(spec, ","), K.strip), lambda p: p != "")
    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, one))))


def segment_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(id_col, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def check_contents(chapters: DataFrame, contents: DataFrame, by: str = "book") -> DataFrame:
    """``by, number, problem``: chapters (``by, number, title``) whose title isn't the one in the book's own contents
    (``by, titles``), by their order. Where the two differ in number, one row with a null number says so."""
    ranked = chapters.withColumn("pos", F.row_number().over(Window.partitionBy(by).orderBy("number")) - 1)
    split = ranked.groupBy(by).agg(F.count("*").alias("split"))
    both = contents.select(by, F.size("titles").alias("listed"), "titles").join(split, by, "left").withColumn("split", F.coalesce("split", F.lit(0)))
    counted = both.filter("listed != split").select(by, F.lit(None).cast("int").alias("number"), F.format_string("the contents list %d titles, %d chapters were split", "listed", "split").alias("problem"))
    printed = both.filter("listed = split").select(by, F.posexplode("titles").alias("pos", "printed"))
    odd = ranked.join(printed, [by, "pos"]).filter(K.match_key(F.col("title")) != K.match_key(F.col("printed")))
    cut = lambda c: F.substring(c, 1, 50)
    return counted.unionByName(odd.select(by, F.col("number").cast("int").alias("number"), F.format_string("title is '%s', the contents have '%s'", cut("title"), cut("printed")).alias("problem")))


def cumulative_days(legs: DataFrame, by: Sequence[str] = (), order: Sequence[str] = ("index",), days: str = "days") -> DataFrame:
    """``legs`` with ``day``: the running total of days at each leg's end."""
    return legs.withColumn("day", F.sum(days).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def median_guard(rows: DataFrame, words: str = "words", bounds: tuple[float, float] = (0.25, 4.0), limits: tuple[int, int] = (50, 6000)) -> DataFrame:
    """``rows`` with ``ratio`` to the exact median, and whether ``words`` is ``within`` limits and ``near`` the median."""
    ratio = F.col(words) / F.col("_median")
    # one row: the median by selection, so that no task holds all counts
    both = rows.join(F.broadcast(exact_quantiles(rows, words, [0.5]).select(F.col("value").alias("_median"))), how="left")
    return both.withColumn("ratio", F.round(ratio, 6)).withColumn("within", F.col(words).between(*limits)).withColumn("near", ratio.between(*bounds)).drop("_median")
