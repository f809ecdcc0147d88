"""Nested extraction records: tolerant parsing, coercion, a closed schema, evidence as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions import text as K

from .repair import repair


def _struct(**fields: str) -> str:
    return "struct<" + ",".join(f"`{k.rstrip('_')}`:{v}" for k, v in fields.items()) + ">"


S = "string"
# The schema of one chapter's record.
NAMED = _struct(name_in_text=S, evidence=S)
SCHEMA = _struct(
    chapter="int", title=S, summary_hover=S, summary_detail=S,
    places_visited=f"array<{_struct(name_in_text=S, role=S, evidence=S)}>", places_mentioned=f"array<{NAMED}>", people=f"array<{_struct(name_in_text=S, role=S, evidence=S)}>",
    narrative=_struct(on_stage=f"array<{_struct(name_in_text=S, at_name_in_text=S, between_from=S, between_to=S, evidence=S)}>", named_but_not_present=f"array<{NAMED}>", notes=S),
    transport=f"array<{_struct(mode=S, vessel_or_line_name=S, from_=S, to=S, evidence=S)}>",
    time=_struct(dates_mentioned=f"array<{_struct(as_written=S, evidence=S)}>", days_elapsed_or_remaining=S, schedule_status=S, schedule_detail=S, evidence=S),
    money=_struct(amounts=f"array<{_struct(amount_as_written=S, purpose=S, evidence=S)}>", fogg_remaining_stated=S), notes=S,
)
ROLES = ("arrival", "departure", "passing_through", "setting")
STATUSES = ("ahead", "behind", "on_time", "unknown")
#: Where evidence is, in the order of the schema.
EVIDENCE = ("places_visited", "places_mentioned", "people", "narrative.on_stage", "narrative.named_but_not_present", "transport", "time.dates_mentioned", "money.amounts")


def strip_fences(text: Column) -> Column:
    """The inside of one code fence around the whole text, if there is one."""
    inside = r"(?s)\A\s*```(?:json|JSON)?\s*\n(.*?)\n?\s*```\s*\z"
    return F.when(text.rlike(inside), F.regexp_extract(text, inside, 1)).otherwise(text)


def balanced_object(text: Column) -> Column:
    """The first balanced ``{...}``, braces in strings left out; null if there is none.

    Escapes and strings are blanked by equal lengths first, so only braces are counted, by one fold.
    """
    hush = lambda c, p: F.regexp_replace(c, p, "__")
    plain = hush(text, r"\\.")
    begin = F.call_function("locate", F.lit("{"), plain)
    rest = F.substring(text, begin, F.length(text))
    marks = F.regexp_extract_all(hush(rest, r"\\."), F.lit(r'(?s)"[^"]*+"|[{}]|[^{}"]++|"'), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(s: Column, m: Column) -> Column:
        depth = s["depth"] + F.when(m == "{", 1).when(m == "}", -1).otherwise(0)
        at = s["at"] + F.length(m)
        return F.struct(depth.alias("depth"), at.alias("at"), F.when((s["end"] == 0) & (m == "}") & (depth == 0), at).otherwise(s["end"]).alias("end"))

    end = F.aggregate(marks, start, step, lambda s: s["end"])
    return F.when((begin > 0) & (end > 0), F.substring(rest, F.lit(1), end))


def _is_object(text: Column) -> Column:
    return F.coalesce(F.call_function("schema_of_variant", F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))


def parse_object(text: Column) -> Column:
    """The text of the first of raw text, fenced inside and balanced object that is a JSON object; else null."""
    fenced, inner = strip_fences(text), balanced_object(text)
    return F.when(_is_object(text), text).when(_is_object(fenced), fenced).when(_is_object(inner), inner)


def stated_chapter(text: Column) -> Column:
    """The chapter that a record says it is, from its JSON or else from the text."""
    v = F.try_parse_json(parse_object(text))
    return F.coalesce(F.try_variant_get(v, "$.chapter", "int"), F.regexp_extract(text, r'"chapter"\s*:\s*(\d+)', 1).try_cast("int"))


def unknown_keys(text: Column, allowed: list[str]) -> Column:
    """The keys of a JSON object that the closed schema doesn't have."""
    return F.array_sort(F.array_except(F.json_object_keys(text), F.array(*[F.lit(k) for k in allowed])))


def _blank(c: Column) -> Column:
    return F.nullif(K.strip(c), F.lit(""))


def _list(c: Column, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(kind))


def coerce(record: Column) -> Column:
    """Null lists as empty ones, null containers as empty, blank places as null, a null status as unknown, modes by synonym."""
    kinds = {f.name: f.dataType for f in T._parse_datatype_string(SCHEMA).fields}
    text = lambda c: K.strip(c)

    def rows(c: Column, kind: T.ArrayType, special: dict) -> Column:
        one = lambda r: F.struct(*[special.get(f.name, text)(r[f.name]).alias(f.name) for f in kind.elementType.fields])
        return _list(F.transform(c, one), kind.simpleString())

    def group(name: str, special: dict) -> Column:
        return F.struct(*[(rows(record[name][f.name], f.dataType, special) if isinstance(f.dataType, T.ArrayType) else special.get(f.name, text)(record[name][f.name])).alias(f.name) for f in kinds[name].fields])

    special = {"at_name_in_text": _blank, "between_from": _blank, "between_to": _blank, "from": _blank, "to": _blank, "mode": K.normalise_mode, "schedule_status": lambda c: F.coalesce(text(c), F.lit("unknown"))}
    out = []
    for name, kind in kinds.items():
        if isinstance(kind, T.ArrayType):
            out.append(rows(record[name], kind, special).alias(name))
        elif isinstance(kind, T.StructType):
            out.append(group(name, special).alias(name))
        else:
            out.append((record[name] if name == "chapter" else text(record[name])).alias(name))
    return F.struct(*out)


def load(files: DataFrame, text: str = "text", number: str = "number", repair_broken: bool = False) -> DataFrame:
    """Records of files ``number, text``: ``number, record, error``; one of the two is null.

    Errors: missing, empty, malformed, no_chapter, mismatch, unknown_keys, bad_role, bad_status.
    """
    found = parse_object(F.col(text))
    rows = files.withColumn("_json", F.coalesce(found, repair(F.when(found.isNull(), F.col(text)))) if repair_broken else found)
    names = [f.name for f in T._parse_datatype_string(SCHEMA).fields]
    rows = rows.withColumn("_raw", F.from_json("_json", SCHEMA)).withColumn("record", coerce(F.col("_raw")))
    bad_role = F.exists("record.places_visited", lambda p: ~F.coalesce(p["role"], F.lit("")).isin(*ROLES))
    error = (
        F.when(F.col(text).isNull(), "missing").when(K.strip(F.col(text)) == "", "empty").when(F.col("_json").isNull(), "malformed").when(F.col("_raw.chapter").isNull(), "no_chapter")
        .when(F.col("_raw.chapter") != F.col(number), "mismatch").when(F.size(unknown_keys(F.col("_json"), names)) > 0, "unknown_keys").when(bad_role, "bad_role")
        .when(~F.col("record.time.schedule_status").isin(*STATUSES), "bad_status")
    )
    return rows.withColumn("error", error).select(number, F.when(F.col("error").isNull(), F.col("record")).alias("record"), "error")


def evidence_rows(records: DataFrame, record: str = "record", keep: tuple[str, ...] = ("number",)) -> DataFrame:
    """``(*keep, ord, pos, path, quote)``: every quotation with the path that leads to it, in the order of the schema."""
    one = lambda n, p: lambda x, i: F.struct(F.lit(n).alias("ord"), i.alias("pos"), F.format_string(f"{p}[%d].evidence", i).alias("path"), x["evidence"].alias("quote"))
    lists = [F.transform(f"{record}.{p}", one(n, p)) for n, p in enumerate(EVIDENCE)]
    own = F.array(F.struct(F.lit(6).alias("ord"), F.lit(-1).alias("pos"), F.lit("time.evidence").alias("path"), F.col(f"{record}.time.evidence").alias("quote")))
    each = records.select(*keep, F.explode(F.concat(*lists, own)).alias("_e")).select(*keep, "_e.*")
    return each.filter(F.coalesce(K.strip(F.col("quote")), F.lit("")) != "")


def place_uses(records: DataFrame, record: str = "record", keep: tuple[str, ...] = ("number",)) -> DataFrame:
    """``(*keep, ord, pos, how, name, evidence)`` of every use of a place: visited, mentioned, on_stage (at, from, to)."""
    one = lambda how, name: lambda x, i: F.struct(F.lit(how).alias("how"), i.alias("pos"), x[name].alias("name"), x["evidence"].alias("evidence"))
    stage = f"{record}.narrative.on_stage"
    lists = [F.transform(f"{record}.places_visited", one("visited", "name_in_text")), F.transform(f"{record}.places_mentioned", one("mentioned", "name_in_text"))]
    lists += [F.transform(stage, one("on_stage", c)) for c in ("at_name_in_text", "between_from", "between_to")]
    ranked = lambda n: lambda u: F.struct(F.lit(n).alias("ord"), u["pos"].alias("pos"), u["how"].alias("how"), u["name"].alias("name"), u["evidence"].alias("evidence"))
    ords = F.concat(*[F.transform(x, ranked(n)) for n, x in enumerate(lists)])
    return records.select(*keep, F.explode(ords).alias("_u")).select(*keep, "_u.*").filter(F.coalesce(K.strip(F.col("name")), F.lit("")) != "")


def place_summary(uses: DataFrame, chapter: str = "number") -> DataFrame:
    """Per place key: the first printed name, the first chapter, chapters, uses by kind, and the earliest evidence."""
    keyed = uses.withColumn("key", K.place_key(F.col("name"))).withColumn("_at", F.struct(chapter, "ord", "pos"))
    count = lambda how: F.count_if(F.col("how") == how).alias(how)
    quoted = F.struct(F.coalesce(F.col("evidence"), F.lit("")) == "", "_at")
    rows = keyed.groupBy("key").agg(
        F.min_by("name", "_at").alias("name"), F.min(chapter).alias("first_chapter"), F.array_sort(F.collect_set(chapter)).alias("chapters"), count("visited"), count("mentioned"), count("on_stage"),
        F.count("*").alias("uses"), F.min_by("evidence", quoted).alias("evidence"),
    )
    used = F.array_join(F.array_compact(F.array(*[F.when(F.col(h) > 0, F.concat_ws(":", F.lit(h), h)) for h in ("visited", "mentioned", "on_stage")])), " ")
    return rows.withColumn("used_as", used)


def drop_unknown(text: Column, schema: str = SCHEMA) -> Column:
    """``struct(json, dropped)``: a record's JSON text without the keys that the closed schema doesn't have, at any depth,
    and their paths. Values of known keys stay as they are, of whatever type; keys that are null or absent are left out.
    Nested paths come first, in the order of the schema, then the object's own, in the order of the text.
    """
    loose = _loose(T._parse_datatype_string(schema))
    return F.struct(F.to_json(F.from_json(text, loose.simpleString())).alias("json"), _extra_paths(text, loose, F.lit("")).alias("dropped"))


def _loose(kind: T.DataType) -> T.DataType:
    """A schema whose leaves take any JSON value."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in kind.fields])
    return T.ArrayType(_loose(kind.elementType)) if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) else T.VariantType()


def _extra_paths(text: Column, kind: T.StructType, path: Column) -> Column:
    """The paths of an object's keys, at any depth, that ``kind`` doesn't have."""
    inside = lambda name: F.when(path == "", F.lit(name)).otherwise(F.concat(path, F.lit(f".{name}")))

    def of_each(value: Column, item: T.StructType, name: str) -> Column:
        at = lambda i: F.concat(inside(name), F.lit("["), i.cast("string"), F.lit("]"))
        return F.flatten(F.transform(F.from_json(value, "array<string>"), lambda x, i: _extra_paths(x, item, at(i))))

    found = []
    for f in kind.fields:
        value = F.get_json_object(text, f"$.{f.name}")
        if isinstance(f.dataType, T.StructType):
            found.append(_extra_paths(value, f.dataType, inside(f.name)))
        elif isinstance(f.dataType, T.ArrayType):
            found.append(of_each(value, f.dataType.elementType, f.name))
    known = F.array(*[F.lit(f.name) for f in kind.fields])
    extra = F.filter(F.json_object_keys(text), lambda k: ~F.array_contains(known, k))
    own = F.transform(extra, lambda k: F.when(path == "", k).otherwise(F.concat(path, F.lit("."), k)))
    none = F.array().cast("array<string>")
    return F.concat(*[F.coalesce(x, none) for x in (*found, own)])
