"""Rules that return problems: one row per entity with an array of what is wrong, in the order of the rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import text as K

# Fixed values.
CHAPTERS, LEAST_WORDS, MOST_WORDS, RATIO = 37, 400, 6000, (0.25, 4.0)
LEGS, DAYS = 8, 80
HOVER_WORDS, SENTENCES = 25, (2, 6)
NONE = "array<string>"


def problems(*rules: tuple[Column, str | Column]) -> Column:
    """The messages of the rules that are broken (conditions that hold)."""
    return F.array_compact(F.array(*[F.when(c, m if isinstance(m, Column) else F.lit(m)) for c, m in rules]))


def duplicates(rows: DataFrame, *keys: str, first: str | None = None) -> DataFrame:
    """``(*keys, n)`` of keys that occur more than once, and the smallest of column ``first`` among them."""
    more = [F.min(first).alias("first")] if first else []
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *more).filter("n > 1")


def sentences(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[.!?](?:\s|$)"))


def check_chapters(chapters: DataFrame, expected: int = CHAPTERS, words: tuple[int, int] = (LEAST_WORDS, MOST_WORDS)) -> DataFrame:
    """``number, words, problems`` of chapters ``number, title, body``, and a row with a null number for the whole."""
    rows = chapters.withColumn("words", K.word_count(F.col("body")))
    facts = rows.agg(F.median("words").alias("_median"), F.count("*").alias("_n"), F.count_distinct("number").alias("_distinct"), F.min("number").alias("_lo"), F.max("number").alias("_hi"))
    letters, capitals = F.regexp_count("title", F.lit(r"\p{L}")), F.regexp_count("title", F.lit(r"\p{Lu}"))
    ratio = F.col("words") / F.col("_median")
    each = rows.join(F.broadcast(facts)).withColumn("_same", F.count("*").over(Window.partitionBy("number")))
    own = problems(
        (F.col("_same") > 1, "duplicate number"), (F.trim("title") == "", "no title"), (capitals < 0.8 * letters, "title is not in capitals"), (F.trim("body") == "", "empty body"),
        (F.col("words") < words[0], "too short"), (F.col("words") > words[1], "too long"), ((ratio < RATIO[0]) | (ratio > RATIO[1]), "far from the median"),
        (F.regexp_count("body", F.lit(r"(?m)^[ \t]+CHAPTER[ \t]+[IVXLC]+\.")) > 2, "contents lines"), (F.lower("body").contains("project gutenberg"), "boilerplate"),
    )
    whole = problems((F.col("_n") != expected, F.format_string("%d chapters", "_n")), ((F.col("_lo") != 1) | (F.col("_hi") != F.col("_distinct")), "numbers have gaps"))
    return each.select("number", "words", own.alias("problems")).unionByName(facts.select(F.lit(None).cast("int").alias("number"), F.lit(None).cast("int").alias("words"), whole.alias("problems")))


def check_spine(legs: DataFrame, printed_total: int = DAYS, expected: int = LEGS) -> DataFrame:
    """``index, problems`` of legs ``index, origin, destination, days, modes``; the whole has a null index."""
    key = lambda c: K.node_key(F.col(c))
    rows = legs.withColumn("_from", key("origin")).withColumn("_to", key("destination")).withColumn("_before", F.lag("_to").over(Window.orderBy("index")))
    own = problems((F.col("days") <= 0, "days are not positive"), (F.size("modes") <= 0, "no mode"), (F.col("_from") == F.col("_to"), "leads to itself"), (F.col("_before") != F.col("_from"), "the chain is broken"))
    facts = rows.agg(F.count("*").alias("n"), F.sum("days").alias("days"), F.min_by("_from", "index").alias("first"), F.max_by("_to", "index").alias("last"), F.count_distinct("_from").alias("stops"))
    whole = problems((F.col("n") != expected, F.format_string("%d legs", "n")), (F.col("days") != printed_total, F.format_string("legs take %d days", "days")), (F.col("first") != F.col("last"), "does not return"), (F.col("stops") != F.col("n"), "a stop is repeated"))
    return rows.select("index", own.alias("problems")).unionByName(facts.select(F.lit(None).cast("int").alias("index"), whole.alias("problems")))


def check_records(records: DataFrame, titles: DataFrame | None = None, vessels: Sequence[str] = ()) -> DataFrame:
    """``number, problems`` of extraction records (``number, record``); ``titles``: ``number, title``."""
    keys = lambda path, name="name_in_text": F.transform(K.nfc_each(F.transform(f"record.{path}", lambda x: x[name])), lambda x: K.place_key(x, nfc=False))
    stage, absent, people, visited, mentioned = keys("narrative.on_stage"), keys("narrative.named_but_not_present"), keys("people"), keys("places_visited"), keys("places_mentioned")
    at = F.filter(keys("narrative.on_stage", "at_name_in_text"), lambda x: x.isNotNull())
    known = F.array_union(F.array_union(visited, mentioned), F.array(*[K.place_key(F.lit(v)) for v in vessels]) if vessels else F.array().cast(NONE))
    twice = lambda a: F.size(a) != F.size(F.array_distinct(a))
    hover, detail = F.coalesce("record.summary_hover", F.lit("")), F.coalesce("record.summary_detail", F.lit(""))
    rows = records.join(titles.select("number", F.col("title").alias("_title")), "number", "left") if titles is not None else records.withColumn("_title", F.lit(None).cast("string"))
    rules = problems(
        (F.col("record.chapter") != F.col("number"), "states another chapter"),
        (K.word_count(hover) > HOVER_WORDS, "hover summary is too long"),
        (~sentences(detail).between(*SENTENCES), "detail has too few or many sentences"),
        (twice(visited), "a place is visited twice"),
        (F.size(F.array_intersect(visited, mentioned)) > 0, "a place is both visited and mentioned"),
        ((F.coalesce("record.money.fogg_remaining_stated", F.lit("")) != "") & (F.size("record.money.amounts") == 0), "a remaining sum without amounts"),
        (K.match_key(F.col("_title")) != K.match_key(F.coalesce("record.title", F.lit(""))), "title is another"),
        (F.size(F.array_intersect(stage, absent)) > 0, "on stage and not present"),
        (F.exists(F.zip_with(keys("narrative.on_stage", "between_from"), keys("narrative.on_stage", "between_to"), lambda a, b: a == b), lambda same: same), "travels from a place to itself"),
        (F.size(F.array_except(stage, people)) > 0, "on stage but not among the people"),
        (F.size(F.array_except(at, known)) > 0, "at a place that is not listed"),
        ((F.size(people) > 0) & (F.size(stage) == 0) & (F.size(absent) == 0), "no narrative"),
    )
    return rows.select("number", rules.alias("problems"))


def check_files(loaded: DataFrame, expected: int = CHAPTERS) -> DataFrame:
    """``number, problem`` for every expected number: missing, the load's error, or a chapter claimed twice."""
    numbers = loaded.sparkSession.range(1, expected + 1).select(F.col("id").cast("int").alias("number"))
    claims = loaded.filter("record is not null").groupBy(F.col("record.chapter").alias("number")).agg(F.count("*").alias("_claims"))
    rows = numbers.join(loaded.select("number", "error", F.lit(True).alias("_there")), "number", "left").join(claims, "number", "left")
    return rows.select("number", F.when(F.col("_there").isNull(), "missing").when(F.col("error").isNotNull(), F.col("error")).when(F.col("_claims") > 1, "duplicate").alias("problem")).filter("problem is not null")


def check_cast(people: DataFrame, roles: DataFrame) -> DataFrame:
    """``name, problem`` of ``people`` (``person, display, aliases``) and ``roles`` (``name``)."""
    each = people.select("person", "display", F.explode("aliases").alias("alias")).withColumn("key", K.match_key(F.col("alias")))
    shown = people.filter(~F.array_contains(F.transform(K.nfc_each(F.col("aliases")), lambda a: K.match_key(a, nfc=False)), K.match_key(F.col("display")))).select(F.col("person").alias("name"), F.lit("display is no alias").alias("problem"))
    shared = each.groupBy("key").agg(F.count_distinct("person").alias("n")).filter("n > 1").select(F.col("key").alias("name"), F.lit("alias of several").alias("problem"))
    both = each.join(roles.select(K.match_key(F.col("name")).alias("key")), "key", "left_semi").select(F.col("alias").alias("name"), F.lit("alias is a role").alias("problem"))
    return shown.unionByName(shared).unionByName(both)


def fold_names(names: DataFrame, people: DataFrame, name: str = "name") -> DataFrame:
    """``names`` with ``person`` (by alias, else the name's own key), ``display`` and ``is_role``."""
    alias = people.select("person", "display", F.explode("aliases").alias("_a")).select("person", "display", K.match_key(F.col("_a")).alias("_key"))
    rows = names.withColumn("_key", K.match_key(F.col(name))).join(F.broadcast(alias), "_key", "left")
    return rows.withColumn("is_role", F.col("person").isNull() & K.looks_like_a_role(F.col(name))).withColumn("person", F.coalesce("person", "_key")).withColumn("display", F.coalesce("display", F.col(name))).drop("_key")


def check_strings(strings: DataFrame) -> DataFrame:
    """``key, problems`` of texts ``key, value``: markup, blank, braces that don't match."""
    bare = F.regexp_replace("value", r"\{\w+\}", "")
    return strings.select("key", problems((F.col("value").rlike("<[a-zA-Z/]"), "markup"), (F.trim("value") == "", "blank"), (bare.rlike(r"[{}]"), "unbalanced braces")).alias("problems"))


def check_template(templates: DataFrame, strings: DataFrame, template: str = "template") -> DataFrame:
    """``key, problem``: keys that a template uses and the strings don't have, or the reverse."""
    used = templates.select(F.explode(F.regexp_extract_all(template, F.lit(r'data-i18n(?:-\w+)?="([^"]+)"'), F.lit(1))).alias("key")).distinct()
    return used.join(strings, "key", "left_anti").select("key", F.lit("not defined").alias("problem")).unionByName(strings.select("key").join(used, "key", "left_anti").select("key", F.lit("not used").alias("problem")))


def missing_numbers(found: DataFrame, expected: int, column: str = "number") -> DataFrame:
    return found.sparkSession.range(1, expected + 1).select(F.col("id").cast("int").alias(column)).join(found.select(column), column, "left_anti")


def is_stale(record: str = "record") -> Column:
    return (F.size(f"{record}.people") > 0) & (F.size(f"{record}.narrative.on_stage") == 0) & (F.size(f"{record}.narrative.named_but_not_present") == 0)
