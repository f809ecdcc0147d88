"""Personal data: base patterns as seeds, and bootstrapped contextual extraction of what they don't match.

Everything here is DataFrame functions. The whole texts are searched once, for *regions*: words with a digit or an at
sign, with the words behind them that could continue a number. No match of a base pattern leaves its region, so the
patterns run over regions only, as does the search for all other *mentions* (a word with a digit or an at sign, numbers
that follow in a row joined), each with the word before it. What follows works on mentions only, but for one count of
words:

- a *pattern* is the word before a mention, in lower case, with its punctuation, or the label that the mention itself
  begins with (``tel:5550100``); an *instance* is a mention's text;
- base matches that pass their checks are the seed instances of their kind, with confidence 1;
- each round scores the graph of patterns and instances: a pattern's confidence for a kind is the confidence of its
  instances, summed over occurrences, against all occurrences of its word in the corpus, whatever follows it; patterns
  of ``LEAST_SEEDS`` instances or more and confidence ``LEAST_PATTERN`` or more are accepted; an instance whose shape
  can be of the kind gets 1 - product(1 - confidence) over its accepted patterns, and joins the known ones at
  ``LEAST_INSTANCE``;
- after ``ROUNDS`` rounds, mentions that an accepted pattern precedes, whose instance is known and which overlap no base
  span, are added as spans of that kind.

A common word never becomes a pattern: nearly all of its occurrences precede something else.

All expressions run in linear time and without recursion, so one word may be of any length: repeats are possessive, and
the base patterns begin with a look-behind: a run that fails at its first character fails at all others, and after a
match the search goes on at its end (``\\G``).

Edge cases: null and empty texts have no spans; rows repeat as often as they do in the input; a text of any length is
searched whole; a pattern or instance with any share of all mentions is one row after the first, partial, aggregate;
an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialise, text_or_empty

KINDS = ("email", "ip", "card", "phone")
# The base patterns, in an equivalent form that runs in linear time.
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SPACE = r"\x20\x09-\x0D"
_WORD = rf"(?<![^{SPACE}])[^{SPACE}0-9@]*+[0-9@][^{SPACE}]*+"
MENTION = _WORD + r"(?:\x20[0-9(][0-9().-]*+)*+"
REGION = _WORD + rf"(?:\x20++[().0-9-][^{SPACE}]*+)*+"
#: What surrounds the identifier in a mention: a label or opening marks, and closing marks.
BEFORE, AFTER = r"^(?:[^0-9@:=#]*+[:=#])*+[\"'<\[{]*+", ".,;:!?\"'>]}|"
#: Cues are broadcast up to so many; more of them are joined by a shuffle.
MOST_BROADCAST = 200_000
ROUNDS = 3
LEAST_SEEDS = 3
LEAST_PATTERN = 0.5
LEAST_INSTANCE = 0.5


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)
    value = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")
    step = lambda i: F.when(i % 2 == 0, value(i)).otherwise((value(i) * 2) % 10 + F.floor(value(i) / 5).cast("int"))
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + step(i)) % 10 == 0


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes(kind: Column, text: Column) -> Column:
    """Whether a match of a base pattern is of its kind."""
    digits = _digits(text)
    n = F.length(digits)
    value = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    parts = F.forall(F.split(text, r"\."), lambda p: (F.length(value(p)) <= 3) & (F.left(value(p), F.lit(3)).cast("int") <= 255))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", parts)
        .when(kind == "card", F.when(n.between(14, 19), luhn(digits)).otherwise(False))
        .otherwise(n.between(10, 15))
    )


def shaped(kind: Column, text: Column) -> Column:
    """Whether a mention can be of a kind, whatever its exact form."""
    n = F.length(_digits(text))
    return (
        F.when(kind == "email", text.rlike(r"^[^@]+@[^@]+$"))
        .when(kind == "ip", text.rlike(r"^[0-9A-Fa-f]*+(?:[.:][0-9A-Fa-f]*+){2,}+(?:/[0-9]++)?+$"))
        .when(kind == "card", n.between(12, 19) & text.rlike(r"^[0-9 -]+$"))
        .otherwise(n.between(7, 15) & text.rlike(r"^[+0-9(][0-9 ().-]+$"))
    )


def _found(text: Column, kind: str, pattern: str) -> Column:
    """All matches of a pattern, in order: kind, place among them, characters since the last one, text, the last word
    between, and whether it touches the match."""
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(matches)).alias("gap"), matches.alias("m")),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("k"), F.length(x["gap"]).alias("gap"), x["m"].alias("m"), _last_word(x["gap"]).alias("left"), (F.right(_plain_spaces(x["gap"]), F.lit(1)) != " ").alias("tight")),
    )


def _plain_spaces(text: Column) -> Column:
    return F.translate(text, "\t\n\x0b\x0c\r", "     ")


def _last_word(text: Column) -> Column:
    return F.substring_index(F.rtrim(_plain_spaces(text)), " ", -1)


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, mentions)``: a number for every row, and ``row, kind, start, end, m, cue, label, clear`` of all matches and mentions.

    ``kind`` is null for a mention that isn't a base match; ``label`` marks cues that are part of the mention's word;
    ``clear`` those that overlap no base match; spans are code points, end exclusive.
    """
    text = text_or_empty(text_col)
    none = "array<struct<kind:string,k:int,gap:int,m:string,left:string,tight:boolean>>"
    regions = F.when(text.rlike("[0-9@]"), _found(text, "", REGION)).otherwise(F.array().cast(none))
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), regions.alias("regions"))
    rows = materialise(rows, "regions")
    each = rows.filter(F.size("regions") > 0).select("row", F.explode("regions").alias("f")).select("row", F.col("f.k").alias("at"), "f.gap", "f.m", F.col("f.left").alias("outer"))
    in_row = Window.partitionBy("row")
    each = each.withColumn("begin", F.sum(F.col("gap") + F.length("m")).over(in_row.orderBy("at")) - F.length("m"))
    parts = F.concat(*[F.when(F.col("m").rlike(p), _found(F.col("m"), k, p)).otherwise(F.array().cast(none)) for k, p in BASE.items()], _found(F.col("m"), "", MENTION))
    inner = each.select("row", "at", "begin", "outer", F.explode(parts).alias("f")).select("row", "at", "begin", "outer", "f.*")
    end = F.col("begin") + F.sum(F.col("gap") + F.length("m")).over(Window.partitionBy("row", "at", "kind").orderBy("k"))
    inner = inner.withColumn("end", end.cast("int")).withColumn("start", F.col("end") - F.length("m")).withColumn("left", F.when(F.col("left") == "", F.col("outer")).otherwise(F.col("left")))
    label = (F.col("gap") > 0) & F.col("tight")
    inner = inner.select("row", "kind", "start", "end", "m", "left", label.alias("label"))
    base = inner.filter("kind != ''").filter(passes(F.col("kind"), F.col("m"))).withColumn("pre", F.lit(""))
    other = inner.filter("kind = ''").withColumn("pre", F.regexp_extract("m", BEFORE, 0)).withColumn("label", F.col("pre") != "")
    other = other.withColumn("m", F.rtrim(F.substring(F.col("m"), F.length("pre") + 1, F.length("m")), F.lit(AFTER))).filter("m != ''")
    other = other.withColumn("start", F.col("start") + F.length("pre")).withColumn("end", F.col("start") + F.length("m"))
    both = base.unionByName(other)
    # base matches that begin before a mention's end and end behind its start overlap it
    mark = F.when(F.col("kind") == "", F.col("end")).otherwise(F.col("start"))
    reach = F.max(F.when(F.col("kind") != "", F.col("end"))).over(in_row.orderBy(mark, F.col("kind") != "").rowsBetween(Window.unboundedPreceding, 0))
    cue = F.lower(F.when(F.col("pre") == "", F.col("left")).otherwise(F.col("pre")))
    both = both.select("row", F.nullif(F.col("kind"), F.lit("")).alias("kind"), "start", "end", "m", cue.alias("cue"), "label", (F.coalesce(reach, F.lit(0)) <= F.col("start")).alias("clear"))
    return rows.select("id", "row"), materialise(both, "mentions")


def cue_counts(docs: DataFrame, cues: DataFrame, text_col: str = "text") -> DataFrame:
    """``(cue, total)``: how often each word of ``cues`` occurs in the corpus, in lower case.

    Other words are left out before the shuffle, where the cues are few enough to be broadcast.
    """
    words = docs.select(F.explode(F.split(_plain_spaces(F.lower(text_or_empty(text_col))), " ")).alias("cue"))
    if cues.count() <= MOST_BROADCAST:
        return words.join(F.broadcast(cues), "cue", "left_semi").groupBy("cue").agg(F.count("*").alias("total"))
    return words.groupBy("cue").agg(F.count("*").alias("total")).join(cues, "cue", "left_semi")


def bootstrap(docs: DataFrame, found: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``(row, kind, start, end)`` of the mentions that accepted patterns discover."""
    # what overlaps a base match is the same occurrence in another form
    own = found.filter("cue != '' and (kind is not null or clear)")
    pairs = materialise(own.groupBy("cue", F.lower("m").alias("instance")).agg(F.count("*").alias("n"), F.count_if("label").alias("labels")), "pairs")
    seeds = found.filter("kind is not null").select(F.lower("m").alias("instance"), "kind").distinct().withColumn("conf", F.lit(1.0))
    known = materialise(seeds, "seeds")
    # words of fewer instances, known or not, can't become patterns in any round
    cues = pairs.groupBy("cue").agg(F.count("*").alias("instances"), F.sum("labels").alias("labels")).filter(F.col("instances") >= LEAST_SEEDS)
    cues = materialise(cues.select("cue", "labels"), "cues")
    # a label is a part of a word: its occurrences are those before mentions
    totals = cues.join(cue_counts(docs, cues.select("cue"), text_col), "cue", "left")
    totals = materialise(totals.select("cue", (F.coalesce("total", F.lit(0)) + F.col("labels")).alias("total")), "totals")
    open_pairs = pairs.join(totals, "cue", "left_semi")
    patterns = None
    for _ in range(rounds):
        scored = open_pairs.join(known, "instance").groupBy("cue", "kind").agg(F.sum(F.col("n") * F.col("conf")).alias("hits"), F.count("*").alias("instances"))
        scored = scored.join(totals, "cue").withColumn("conf", F.least(F.lit(1.0), F.col("hits") / F.greatest(F.col("total"), F.lit(1))))
        patterns = materialise(scored.filter((F.col("instances") >= LEAST_SEEDS) & (F.col("conf") >= LEAST_PATTERN)).select("cue", "kind", "conf"), "patterns")
        reached = open_pairs.join(patterns, "cue").filter(shaped(F.col("kind"), F.col("instance")))
        doubt = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("conf")))))
        reached = reached.groupBy("instance", "kind").agg((1 - doubt).alias("conf")).filter(F.col("conf") >= LEAST_INSTANCE)
        known = materialise(seeds.unionByName(reached).groupBy("instance", "kind").agg(F.max("conf").alias("conf")), "known")
    others = found.filter("kind is null and clear").drop("kind").withColumn("instance", F.lower("m"))
    hits = others.join(patterns.select("cue", "kind"), "cue").join(known.select("instance", "kind"), ["instance", "kind"])
    return hits.filter(shaped(F.col("kind"), F.col("m"))).select("row", "kind", "start", "end").distinct()


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, base, found)`` of every row: base spans, and base and discovered spans (``kind, start, end``), in order."""
    rows, found = mentions(docs, id_col, text_col)
    more = bootstrap(docs, found, text_col)
    spans = found.filter("kind is not null").select("row", "kind", "start", "end", F.lit(True).alias("base")).unionByName(more.withColumn("base", F.lit(False)))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.struct(F.col("start"), rank.alias("rank"), F.col("kind"), F.col("end"))
    lists = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"), F.sort_array(F.collect_list(span)).alias("found"))
    tidy = lambda c: F.transform(F.coalesce(F.col(c), F.array().cast("array<struct<start:int,rank:bigint,kind:string,end:int>>")), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.join(lists, "row", "left").select(F.col("id").alias(id_col), tidy("base").alias("base"), tidy("found").alias("found"))
