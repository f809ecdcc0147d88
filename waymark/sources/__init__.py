"""Readers and writers of the files that stages leave for each other."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.text import place_key, sparql_string


def decode(content: Column) -> Column:
    """Bytes as text: UTF-8 with or without a mark, else Latin-1; line ends as line feeds."""
    text = F.when(F.is_valid_utf8(content.cast("string")), F.regexp_replace(content.cast("string"), "^﻿", "")).otherwise(F.decode(content, "ISO-8859-1"))
    return F.regexp_replace(text, "\r\n?", "\n")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``path, text`` of whole files."""
    return spark.read.format("binaryFile").load(path).select("path", decode(F.col("content")).alias("text"))


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """``number, text`` of files such as ``chapter_07.txt``."""
    name = F.regexp_extract(F.col("path"), r"_(\d+)\.\w+$", 1).try_cast("int")
    return read_documents(spark, path).select(name.alias("number"), "text")


def numbered_name(number: Column, kind: str = "txt") -> Column:
    return F.format_string(f"chapter_%02d.{kind}", number)


def read_geojson(spark: SparkSession, path: str, name: str = "NAME") -> DataFrame:
    """``name, polygons`` of a FeatureCollection; a Polygon is a multipolygon of one."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.expr("variant_get(parse_json(value), '$.features', 'array<variant>')")).alias("f"))
    kind = F.expr("try_variant_get(f, '$.geometry.type', 'string')")
    one, many = "array<array<array<double>>>", "array<array<array<array<double>>>>"
    polygons = F.when(kind == "Polygon", F.array(F.expr(f"try_variant_get(f, '$.geometry.coordinates', '{one}')"))).when(kind == "MultiPolygon", F.expr(f"try_variant_get(f, '$.geometry.coordinates', '{many}')"))
    return rows.select(F.expr(f"try_variant_get(f, '$.properties.{name}', 'string')").alias("name"), polygons.alias("polygons")).filter("polygons is not null")


def read_table(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A CSV review table, all strings; rows without a key go, and of a repeated key the last one stays.

    The reader keeps the order of lines within a file in ``monotonically_increasing_id`` over its splits.
    """
    rows = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    rows = rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in rows.columns]).withColumn("_at", F.monotonically_increasing_id())
    last = rows.filter(F.trim(key) != "").groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in (key, "_at")]), "_at").alias("_r"))
    return last.select(*[F.col(key) if c == key else F.col(f"_r.{c}").alias(c) for c in rows.columns if c != "_at"])


def write_table(table: DataFrame, path: str, key: str) -> None:
    """A CSV folder of one file, in key order: a review table is what a person reads through."""
    table.orderBy(key).coalesce(1).write.mode("overwrite").csv(path, header=True, escape='"')


def cache_key(source: str, name: Column, operation: str = "search", version: int = 1) -> Column:
    return F.concat(F.lit(f"{source}:{operation}:v{version}:"), place_key(name))


def with_cache(names: DataFrame, cache: DataFrame, source: str, name: str = "name", offline: bool = True) -> DataFrame:
    """``names`` with cached ``candidates``: an empty list is an answer, null is a miss (an error when ``offline``)."""
    keyed = names.withColumn("_key", cache_key(source, F.col(name)))
    joined = keyed.join(cache.select(F.col("key").alias("_key"), "candidates", F.lit(True).alias("_hit")), "_key", "left")
    if offline:
        miss = F.raise_error(F.concat(F.lit("not cached: "), F.col("_key")))
        joined = joined.withColumn("candidates", F.when(F.col("_hit"), F.col("candidates")).otherwise(miss.cast(dict(cache.dtypes)["candidates"])))
    return joined.drop("_key", "_hit")


def parse_binding(row: Column) -> Column:
    """A SPARQL result row (JSON text) as a candidate; whole numbers may be written as decimals, and bad ones are null."""
    value = lambda k: F.get_json_object(row, f"$.{k}.value")
    whole = lambda k: value(k).try_cast("double").cast("int")
    return F.struct(
        F.substring_index(value("item"), "/", -1).alias("qid"), value("enLabel").alias("label"), value("alias").alias("alias"), value("description").alias("description"),
        F.coalesce(value("lat").try_cast("double"), F.lit(0.0)).alias("lat"), F.coalesce(value("lon").try_cast("double"), F.lit(0.0)).alias("lon"), value("typeLabel").alias("type"),
        F.substring_index(value("type"), "/", -1).alias("type_id"), value("countryLabel").alias("country"), whole("population").alias("population"), whole("sitelinks").alias("sitelinks"),
    )


def read_curated(spark: SparkSession, path: str, entries: str, schema: str) -> DataFrame:
    """The rows of one list of a curated JSON file."""
    return spark.read.schema(f"{entries} array<struct<{schema}>>").json(path, multiLine=True).select(F.explode(entries).alias("e")).select("e.*")


def write_json(payload: DataFrame, path: str, key: str) -> None:
    from waymark.operators.payload import to_json_lines

    to_json_lines(payload, key).coalesce(1).select("json").write.mode("overwrite").text(path)


@dataclass(frozen=True)
class TextSource:
    """One text and where it may be had: addresses in the order to try them, and what a good copy has at least."""

    name: str
    number: int
    addresses: tuple[str, ...]
    least_bytes: int = 100_000
    chapters: int | None = None

    def urls(self) -> tuple[str, ...]:
        return tuple(a.format(number=self.number) for a in self.addresses)

    def path(self, folder: str) -> str:
        return f"{folder.rstrip('/')}/{self.number}.txt"

    def is_whole(self, size: int) -> bool:
        """Whether a copy of that many bytes can be the text: error pages are small."""
        return size >= self.least_bytes


@dataclass(frozen=True)
class LayerSource:
    """One layer of a map: its address and file."""

    name: str
    address: str

    def urls(self) -> tuple[str, ...]:
        return (self.address,)

    def path(self, folder: str) -> str:
        return f"{folder.rstrip('/')}/{self.name}.geojson"


def prompt_name(number: Column) -> Column:
    return F.format_string("prompt_%02d.md", number)


def put_answers(cache: DataFrame, answers: DataFrame, source: str, name: str = "name") -> DataFrame:
    """The cache (``key, candidates``) with the answers to names (``name, candidates``) in place of older ones."""
    new = answers.select(cache_key(source, F.col(name)).alias("key"), "candidates").dropDuplicates(["key"])
    return cache.select("key", "candidates").join(new.select("key"), "key", "left_anti").unionByName(new)


def write_cache(cache: DataFrame, path: str) -> None:
    """The cache as JSON lines in order of key."""
    cache.orderBy("key").coalesce(1).write.mode("overwrite").json(path)


# Fixed value: the search for a place by its name or alias, and what is fetched of it in the same request.
PLACE_QUERY = """SELECT ?item ?enLabel ?alias ?description ?lat ?lon
       ?type ?typeLabel ?country ?countryLabel ?population ?sitelinks
WHERE {
  SERVICE wikibase:mwapi {
    bd:serviceParam wikibase:api "EntitySearch" .
    bd:serviceParam wikibase:endpoint "www.wikidata.org" .
    bd:serviceParam mwapi:search <name> .
    bd:serviceParam mwapi:language "<language>" .
    bd:serviceParam mwapi:limit "<limit>" .
    ?item wikibase:apiOutputItem mwapi:item .
  }
  ?item wdt:P625 ?coord .
  BIND(geof:latitude(?coord) AS ?lat)
  BIND(geof:longitude(?coord) AS ?lon)
  ?item rdfs:label ?enLabel . FILTER(LANG(?enLabel) = "<language>")
  OPTIONAL { ?item skos:altLabel ?alias . FILTER(LANG(?alias) = "<language>") }
  OPTIONAL { ?item schema:description ?description .
             FILTER(LANG(?description) = "<language>") }
  OPTIONAL { ?item wdt:P31 ?type . }
  OPTIONAL { ?item wdt:P17 ?country . }
  OPTIONAL { ?item wdt:P1082 ?population . }
  OPTIONAL { ?item wikibase:sitelinks ?sitelinks . }
  SERVICE wikibase:label { bd:serviceParam wikibase:language "<language>" . }
}
LIMIT 200
"""


def place_query(name: Column, limit: int = 10, language: str = "en") -> Column:
    """The query for a name, which is escaped: entities with a coordinate only, and labels of one language."""
    before, after = PLACE_QUERY.replace("<language>", language).replace("<limit>", str(limit)).split("<name>")
    return F.concat(F.lit(before), sparql_string(name), F.lit(after))
