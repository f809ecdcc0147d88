"""Queries over books, routes and review tables: each calls the library's operators from end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark import sources
from waymark.functions import text as K
from waymark.operators import extraction, payload, position, report, resolve, segment, validate

from ._declare import Declared, declare
from .text_queries import key_sql, norm_sql

QUERIES: dict[str, Declared] = {}

# Books made of conversations: a contents list, then the turns as chapters. Every third book's list has another title, every
# fifth lacks one.
BOOK_SQL = "with t as (select conv_id, turn, upper(role) || ' ' || turn title, row_number() over (partition by conv_id order by turn) n, count(*) over (partition by conv_id) k from conversations)"


@declare(
    QUERIES,
    f"{BOOK_SQL} select conv_id book, null::int number, format('the contents list {{}} titles, {{}} chapters were split', max(k) - 1, max(k)) problem from t where conv_id % 5 = 0 group by 1"
    " union all select conv_id, n::int, format('title is ''{}'', the contents have ''{}''', title, 'ANOTHER ' || title) from t where conv_id % 5 <> 0 and conv_id % 3 = 0 and n = 1",
)
def contents_problems(conversations: DataFrame) -> DataFrame:
    """Each conversation printed as a book with a table of contents, cut, and held against that table."""
    in_book = Window.partitionBy("conv_id")
    turns = conversations.select("conv_id", F.concat(F.upper("role"), F.lit(" "), "turn").alias("title"), F.row_number().over(in_book.orderBy("turn")).alias("n"), F.count("*").over(in_book).alias("k"))
    roman = K.int_to_roman(F.col("n"))
    wrong = (F.col("conv_id") % 5 != 0) & (F.col("conv_id") % 3 == 0) & (F.col("n") == 1)
    listed = F.concat(F.lit("  CHAPTER "), roman, F.lit(". "), F.when(wrong, F.concat(F.lit("ANOTHER "), "title")).otherwise(F.initcap("title")), F.lit("\n"))
    listed = F.when((F.col("conv_id") % 5 == 0) & (F.col("n") == F.col("k")), "").otherwise(listed)
    printed = F.concat(F.lit("CHAPTER "), roman, F.lit(".\n"), "title", F.lit("\n\ntext\n\n"))
    in_order = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", c.alias("x")))), lambda r: r["x"]), "")
    books = turns.groupBy(F.col("conv_id").alias("book")).agg(F.concat(in_order(listed), F.lit("\n\n"), in_order(printed)).alias("text"))
    contents = books.select("book", segment.contents_titles(F.col("text")).alias("titles"))
    return segment.check_contents(segment.split_chapters(books), contents)


# The underscore is a mark of italics, and goes.
ROUTE_SQL = "with b as (select n_nationkey, replace(n_name, '_', '') n_name from nation), l as (select row_number() over (order by n_nationkey)::int - 1 i, n_name o, coalesce(lead(n_name) over (order by n_nationkey), first(n_name) over (order by n_nationkey)) d, (1 + n_nationkey * 7 % 13)::int as days, n_nationkey k from b)"
VIA_SQL = "case when k % 4 = 0 then 'Port ' || o || '|Cape ' || d else '' end"


def _table(nation: DataFrame) -> DataFrame:
    """The nations as stops of a printed table of legs."""
    order = Window.orderBy("n_nationkey")
    first = F.first("n_name").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    legs = nation.select("n_nationkey", F.col("n_name").alias("o"), F.coalesce(F.lead("n_name").over(order), first).alias("d"), (1 + F.col("n_nationkey") * 7 % 13).alias("days"))
    via = F.when(F.col("n_nationkey") % 4 == 0, F.concat(F.lit(" via Port "), "o", F.lit(" and Cape "), "d")).otherwise("")
    mode = F.when(F.col("n_nationkey") % 2 == 0, "rail and steamboats").otherwise("steamer")
    line = F.concat(F.lit("From "), "o", F.lit(" to "), "d", via, F.lit(", by "), mode, F.lit(" ........ "), F.col("days").cast("string"), F.lit(" days\n"))
    lines = legs.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", line.alias("x")))), lambda r: r["x"]), "").alias("text"), F.sum("days").alias("total"))
    return lines.select(F.concat(F.lit("He read:\n\n"), "text", F.lit("\n"), F.format_string("Total ........ %d days.\n", "total")).alias("text"))


def _legs(nation: DataFrame) -> DataFrame:
    return segment.parse_itinerary(_table(nation), most=1 << 20)


@declare(QUERIES, f"{ROUTE_SQL} select i as index, o origin, d destination, {VIA_SQL} via, case when k % 2 = 0 then 'railway+steamer' else 'steamer' end modes, days from l")
def itinerary_legs(nation: DataFrame) -> DataFrame:
    return _legs(nation).select("index", "origin", "destination", F.array_join("via", "|").alias("via"), F.array_join("modes", "+").alias("modes"), "days")


@declare(QUERIES, f"{ROUTE_SQL}, n as (select i, o from l union all select max(i) + 1, arg_max(d, i) from l), y as (select i + 1 i, l.days from l) select n.i as index, o as name, lower(o) as key, sum(coalesce(days, 0)) over (order by n.i)::bigint as day from n left join y on y.i = n.i")
def route_stops(nation: DataFrame) -> DataFrame:
    return segment.route_nodes(_legs(nation)).select("index", "name", "key", "day")


@declare(QUERIES, f"{ROUTE_SQL}, w as (select max(greatest(length(o), length(d))) w from l) select i ord, format('leg {{}}  ', i) || rpad(o, w::int, ' ') || ' -> ' || rpad(d, w::int, ' ') || '  ' || lpad(days::varchar, 2, ' ') || ' days  ' || case when k % 2 = 0 then 'railway+steamer' else 'steamer' end || case when k % 4 = 0 then '  via Port ' || o || ', Cape ' || d else '' end as line from l, w"
    " union all select 1073741824, format('{} legs, {} nodes, {} days (printed 80), begins and ends at {}', count(*), count(*) + 1, sum(days)::bigint, arg_min(o, i)) from l")  # fmt: skip
def route_log(nation: DataFrame) -> DataFrame:
    return report.route_log(_legs(nation), validate.DAYS)


@declare(QUERIES, f"{ROUTE_SQL}, z as (select *, case when i % 6 = 5 then 'Elsewhere' else o end o2, case when i % 5 = 4 then 0 else days end d2 from l), c as (select *, lag(lower(d)) over (order by i) p, lower(o2) f, lower(d) t from z)"
    " select i as index, array_to_string(list_filter([case when d2 <= 0 then 'days are not positive' end, case when f = t then 'leads to itself' end, case when p <> f then 'the chain is broken' end], lambda x: x is not null), ';') problems from c"
    " union all select null, array_to_string(list_filter([case when count(*) <> 8 then format('{} legs', count(*)) end, case when sum(d2) <> 80 then format('legs take {} days', sum(d2)::bigint) end, case when arg_min(f, i) <> arg_max(t, i) then 'does not return' end, case when count(distinct f) <> count(*) then 'a stop is repeated' end], lambda x: x is not null), ';') from c")  # fmt: skip
def spine_checks(nation: DataFrame) -> DataFrame:
    legs = _legs(nation).withColumn("origin", F.when(F.col("index") % 6 == 5, "Elsewhere").otherwise(F.col("origin"))).withColumn("days", F.when(F.col("index") % 5 == 4, 0).otherwise(F.col("days")))
    return validate.check_spine(legs).select("index", F.array_join("problems", ";").alias("problems"))


CHAPTER_SQL = f"""
with c as (select (doc_id // 2)::bigint number, case when doc_id % 11 = 0 then ' ' when doc_id % 7 = 0 then lower('Title of ' || source) else upper('Title of ' || source) end title, coalesce(text, '') body from documents),
w as (select *, len(list_filter(regexp_split_to_array(body, '\\s+'), lambda x: x <> '')) n, count(*) over (partition by number) k from c),
f as (select median(n) m, count(*) c, count(distinct number) d, min(number) lo, max(number) hi from w)
select number, n::int words, array_to_string(list_filter([case when k > 1 then 'duplicate number' end, case when trim(title) = '' then 'no title' end, case when title <> upper(title) then 'title is not in capitals' end, case when trim(body) = '' then 'empty body' end,
 case when n < 400 then 'too short' end, case when n > 6000 then 'too long' end, case when n / m < 0.25 or n / m > 4 then 'far from the median' end, case when contains(lower(body), 'project gutenberg') then 'boilerplate' end], lambda x: x is not null), ';') problems from w, f
union all select null, null, array_to_string(list_filter([case when c <> 37 then format('{{}} chapters', c) end, case when lo <> 1 or hi <> d then 'numbers have gaps' end], lambda x: x is not null), ';') from f
"""


@declare(QUERIES, CHAPTER_SQL)
def chapter_checks(documents: DataFrame) -> DataFrame:
    title = F.expr("case when doc_id % 11 = 0 then ' ' when doc_id % 7 = 0 then lower('Title of ' || source) else upper('Title of ' || source) end")
    chapters = documents.select(F.floor(F.col("doc_id") / 2).alias("number"), title.alias("title"), F.coalesce("text", F.lit("")).alias("body"))
    return validate.check_chapters(chapters).select("number", "words", F.array_join("problems", ";").alias("problems"))


# Place names of parts: stops, curated lists and the rest, over the colours that part names are made of.
CURATED = [
    ("local", 0, "the {0}", None, None, None, None, "an interior"), ("micro", 0, "{1}", "{0}", None, None, None, "inside another"), ("waypoints", 0, "“{2}”", None, 3, None, None, "on the way"),
    ("waypoints", 1, "{3}", None, 4, 0.25, None, "on the way"), ("blocked", 0, "{4}", None, None, None, None, "off the route"), ("invented", 0, "{5}", None, None, None, None, "made up"),
    ("aliases", 0, "{6}", None, None, None, "Newtown", "an old name"), ("aliases", 1, "{3}", None, None, None, "never", "comes after a waypoint"),
]
PROPOSED_SQL = """
with u as (select p_partkey, p_brand as name, lower(p_brand) as key, substr(p_brand, 7, 2)::int b from part)
select p_partkey, key, case b when 11 then 'node' when 12 then 'node' when 13 then 'local' when 14 then 'micro' when 15 then 'waypoint' when 21 then 'waypoint' when 22 then 'off_route' when 25 then 'waypoint' else 'unknown' end kind,
 case b when 11 then '0;2' when 12 then '1' else '' end node_indices, case b when 14 then 'brand#13' else '' end parent_key, case b when 15 then '3' when 21 then '4' when 25 then '1' else '' end leg, case b when 15 then '0.5' when 21 then '0.25' when 25 then '0.667' else '' end along,
 case b when 11 then 2 when 12 then 1 else 0 end candidates, case b when 24 then 'Newtown' else '' end modern_hint,
 case b when 11 then 'names route nodes 0 and 2, the route is a cycle' when 12 then 'names route node 1' when 13 then 'an interior' when 14 then 'inside another' when 15 then 'on the way' when 21 then 'on the way' when 22 then 'off the route' when 23 then 'no modern referent: made up'
 when 24 then '1872 spelling of Newtown: an old name' when 25 then 'named by the via clause of leg 1' else 'not on the route and on no list, for the gazetteer' end why from u
"""


@declare(QUERIES, PROPOSED_SQL)
def proposed_places(part: DataFrame) -> DataFrame:
    spark = part.sparkSession
    brand = lambda x: x and x.format(*[f"Brand#{n}" for n in (13, 14, 15, 21, 22, 23, 24)])
    curated = spark.createDataFrame([(k, s, brand(n), brand(p), leg, along, m, w) for k, s, n, p, leg, along, m, w in CURATED], "list string, seq int, name string, parent string, leg int, along double, modern string, why string")
    nodes = spark.createDataFrame([(0, "brand#11"), (1, "brand#12"), (2, "brand#11")], "index int, key string")
    legs = spark.createDataFrame([(0, []), (1, ["Elsewhere", "Brand#25"])], "index int, via array<string>")
    uses = part.select("p_partkey", K.place_key(F.concat(F.lit("The "), "p_brand")).alias("key"))
    return resolve.propose(uses, nodes, curated, legs)


# Customers as review rows of places; nations as stops.
STOP_SQL = """
with p as (select c_custkey, lower(c_name) as key, c_name as name, case when c_custkey % 9 = 0 then null else (c_custkey % 170 - 85)::double end lat, (c_custkey * 7 % 360 - 180)::double lon, case c_custkey % 4 when 0 then 'n' when 1 then 'y' else '' end confirmed,
 case when c_custkey % 3 = 0 then 'New ' || c_name else ' ' end modern, c_acctbal / 10000 confidence from customer)
"""


def _places(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k, F.lower("c_name").alias("key"), F.col("c_name").alias("name"), F.when(k % 9 != 0, (k % 170 - 85).cast("double")).alias("lat"), (k * 7 % 360 - 180).cast("double").alias("lon"), F.expr("case c_custkey % 4 when 0 then 'n' when 1 then 'y' else '' end").alias("confirmed"),
        F.when(k % 3 == 0, F.concat(F.lit("New "), "c_name")).otherwise(" ").alias("modern_name"), F.when(k % 3 == 0, "y").otherwise("").alias("name_changed"), F.concat(F.lit("Q"), k.cast("string")).alias("qid"), (F.col("c_acctbal") / 10000).alias("confidence"), (k % 37).cast("int").alias("first_chapter"),
    )


def _stops(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders as stops of a route, some of which no review row has."""
    name = F.when(F.col("o_orderkey") % 5 == 0, F.lit("Nowhere")).otherwise(F.format_string("Customer#%09d", "o_custkey"))
    nodes = orders.select(F.col("o_orderkey").alias("index"), K.node_key(name).alias("key"), name.alias("name"), (F.col("o_orderkey") % 80).alias("day"))
    return payload.journey_nodes(nodes, _places(customer))


NODE_SQL = STOP_SQL + """, n as (select o_orderkey i, case when o_orderkey % 5 = 0 then 'Nowhere' else format('Customer#{:09d}', o_custkey) end nm, o_orderkey % 80 as day from orders),
j as (select n.*, p.*, coalesce(case confirmed when 'y' then 'confirmed' when 'n' then 'rejected' end, 'unconfirmed') status from n left join p on p.key = lower(n.nm)),
s as (select i as index, lower(nm) as key, nm as name, case when trim(coalesce(modern, '')) = '' then nm else modern end modern_name, coalesce(trim(modern) <> '', false) name_changed, case when status <> 'rejected' and lat is not null then lon end lon, case when status <> 'rejected' and lat is not null then lat end lat,
 case when c_custkey is null then '' else 'Q' || c_custkey end qid, confidence, status, day, (c_custkey % 37)::int first_chapter from j)
"""


@declare(QUERIES, NODE_SQL + "select * from s")
def journey_nodes(orders: DataFrame, customer: DataFrame) -> DataFrame:
    return _stops(orders, customer)


@declare(QUERIES, NODE_SQL + """select 1 ord, index::varchar subject, 'stop is marked rejected: ' || name problem from s where status = 'rejected'
union all select 2, format('{:02d}:{}', event_id, event_type), format('leg {} is outside 0..7', event_id % 10) from events where event_id % 10 > 7
union all select 3, format('{:02d}:{}', event_id, event_type), 'along is outside 0..1: ' || (event_id % 11 / 8.0::double)::varchar from events where event_id % 11 > 8
union all select 4, lower(c_name), 'leg is not a number: ' || case when c_custkey % 8 = 0 then 'leg two' else 'five' end from customer where c_custkey % 8 = 0 or c_custkey % 6 = 0""")
def blocking_problems(orders: DataFrame, customer: DataFrame, events: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    places = customer.select(F.lower("c_name").alias("key"), F.when(k % 6 == 0, "five").otherwise("-5").alias("leg"), F.when(k % 8 == 0, " leg two ").otherwise("").alias("corrected_leg"))
    e = F.col("event_id")
    series = events.select(e.cast("int").alias("chapter"), F.col("event_type").alias("track"), (e % 10).cast("int").alias("leg"), (e % 11 / F.lit(8.0)).alias("along"))
    return report.blocking(_stops(orders, customer), 7, series, places)


HELD = "case when c_acctbal < -500 then 'rejected' when c_nationkey % 5 = 0 then 'floating_interior' when c_nationkey % 5 = 1 then 'off_route' when c_custkey % 9 = 0 and c_custkey % 2 = 0 then 'none_found' when c_custkey % 9 = 0 then 'not_queried' end"
CARD_SQL = f"(select lower(c_name) as key, c_name as name, c_nationkey, case when c_acctbal < -500 then 'rejected' when c_custkey % 4 = 1 then 'confirmed' else 'unconfirmed' end status, {HELD} reason, c_custkey, c_acctbal from customer)"


def _cards(customer: DataFrame) -> DataFrame:
    """Customers through the places payload; none is a waypoint, so no arc is needed."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    rows = customer.select(
        F.lower("c_name").alias("key"), F.col("c_name").alias("name"), F.when(n % 5 == 0, "local").when(n % 5 == 1, "off_route").otherwise("unknown").alias("kind"), F.when(k % 9 != 0, (k % 85).cast("double")).alias("lat"), (k % 180).cast("double").alias("lon"),
        F.when(F.col("c_acctbal") < -500, "n").when(k % 4 == 1, "y").otherwise("").alias("confirmed"), F.when(k % 2 == 0, "gazetteer").otherwise("").alias("gazetteer_source"), (F.col("c_acctbal") / 10000).alias("confidence"), F.lit(None).cast("int").alias("leg"), F.lit(None).cast("double").alias("along"),
    )
    none = customer.sparkSession.createDataFrame([], "index int, start array<double>, end array<double>, arc array<array<double>>")
    return payload.places_payload(rows, none)


@declare(QUERIES, f"select key, status, reason, case when reason is null then (c_custkey % 85)::double end lat, case when reason is null then (c_custkey % 180)::double end lon, reason is null and status <> 'confirmed' and c_acctbal / 10000 < 0.7 doubtful from {CARD_SQL}")
def place_cards(customer: DataFrame) -> DataFrame:
    return _cards(customer).select("key", "status", "reason", F.get("point", F.lit(1)).alias("lat"), F.get("point", F.lit(0)).alias("lon"), "doubtful")


@declare(QUERIES, f"select count(*)::bigint total, count_if(reason is null)::bigint drawn, count_if(reason is not null)::bigint listed, count_if(status = 'confirmed')::bigint confirmed, count_if(reason is null and status <> 'confirmed' and c_acctbal / 10000 < 0.7)::bigint doubtful from {CARD_SQL}")
def payload_totals(customer: DataFrame) -> DataFrame:
    return payload.payload_counts(_cards(customer))


@declare(QUERIES, f"""with c as {CARD_SQL}, n as (select count_if(reason is null) plotted, count_if(status = 'confirmed') confirmed, count_if(reason is null and status <> 'confirmed' and c_acctbal / 10000 < 0.7) doubtful, count_if(reason in ('none_found', 'not_queried')) unlocated, count(*) total from c)
select 0 ord, case when confirmed = 0 then format('none of the {{}} place rows has been confirmed by a person', total) else format('{{}} of the {{}} drawn places are unchecked', plotted - confirmed, plotted) end warning from n where confirmed < plotted
union all select 1, format('{{}} of the {{}} drawn places are below the confidence that is trusted', doubtful, plotted) from n where doubtful > 0 union all select 2, format('{{}} names have no coordinate', unlocated) from n where unlocated > 0""")
def reader_warnings(customer: DataFrame) -> DataFrame:
    none = customer.sparkSession.createDataFrame([], "index int, arc array<array<double>>")
    return report.warnings(_cards(customer), none)


MENTION_SQL = f"with m as (select distinct o_orderkey % 37 chapter, o_custkey k, case o_custkey % 3 when 0 then 'past' when 1 then 'here' else 'future' end as class from orders), c as {CARD_SQL}, j as (select m.*, format('Customer#{{:09d}}', k) as name, c.key is not null and c.reason is null plotted, c.reason, k % 10 = 0 on_route from m left join c on c.c_custkey = m.k)"


def _mentions(orders: DataFrame, customer: DataFrame) -> DataFrame:
    kind = F.expr("case o_custkey % 3 when 0 then 'past' when 1 then 'here' else 'future' end")
    named = orders.select((F.col("o_orderkey") % 37).alias("chapter"), F.col("o_custkey").alias("seq"), F.format_string("“Customer#%09d”", "o_custkey").alias("name"), kind.alias("class")).distinct()
    stops = customer.filter("c_custkey % 10 = 0").select(F.lower("c_name").alias("key"))
    return payload.chapter_places(named, _cards(customer), stops)


@declare(QUERIES, MENTION_SQL + " select chapter, lower(name) as key, class, plotted, on_route, reason from j")
def chapter_places(orders: DataFrame, customer: DataFrame) -> DataFrame:
    return _mentions(orders, customer).select("chapter", "key", "class", "plotted", "on_route", "reason")


@declare(QUERIES, MENTION_SQL + " select chapter, count(*)::bigint named, count_if(plotted)::bigint plotted, format('here:{} past:{} future:{}', count_if(class = 'here'), count_if(class = 'past'), count_if(class = 'future')) by_class from j group by 1")
def chapter_place_counts(orders: DataFrame, customer: DataFrame) -> DataFrame:
    n = lambda k: F.coalesce(F.try_element_at("by_class", F.lit(k)), F.lit(0))
    counts = payload.place_counts(_mentions(orders, customer))
    return counts.select("chapter", "named", "plotted", F.format_string("here:%d past:%d future:%d", n("here"), n("past"), n("future")).alias("by_class"))


@declare(QUERIES, MENTION_SQL + " select chapter, case class when 'past' then 1 when 'here' then 2 else 3 end ord, class, md5(string_agg('“' || name || '”', '|' order by name)) names from j group by 1, 2, 3")
def names_by_class(orders: DataFrame, customer: DataFrame) -> DataFrame:
    return payload.places_by_class(_mentions(orders, customer), position.CLASSES).select("chapter", "ord", "class", F.md5(F.array_join("names", "|")).alias("names"))


RECORD_SQL = "(select conv_id, list(role order by turn) roles, list(turn order by turn) turns from conversations group by 1)"


@declare(QUERIES, f"select conv_id, array_to_string(list_concat(list_transform(list_filter(range(len(roles)), lambda i: turns[i + 1] % 3 = 0), lambda i: format('places_visited[{{}}].colour', i)), case when conv_id % 2 = 0 then ['time.zone'] else [] end, ['extra'], case when conv_id % 3 = 0 then ['more'] else [] end), ' ') dropped, array_to_string(roles, ' ') roles from {RECORD_SQL}")
def dropped_fields(conversations: DataFrame) -> DataFrame:
    """Records with keys that the schema doesn't have, at three depths; without them, the rest is as it was."""
    one = F.when(F.col("turn") % 3 == 0, F.to_json(F.struct(F.col("role").alias("name_in_text"), F.lit("red").alias("colour"), F.lit("arrival").alias("role")))).otherwise(F.to_json(F.struct(F.col("role").alias("name_in_text"))))
    lists = conversations.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", one.alias("x")))), lambda r: r["x"]), ",").alias("v"))
    zone = F.when(F.col("conv_id") % 2 == 0, '"time": {"zone": 3, "schedule_detail": "late"}, ').otherwise("")
    more = F.when(F.col("conv_id") % 3 == 0, ', "more": null').otherwise("")
    text = F.concat(F.lit('{"extra": [1], '), zone, F.lit('"places_visited": ['), "v", F.lit("]"), more, F.lit("}"))
    found = lists.select("conv_id", extraction.drop_unknown(text).alias("d"))
    roles = F.from_json("d.json", "places_visited array<struct<name_in_text:string,colour:string>>")["places_visited"]
    return found.select("conv_id", F.array_join("d.dropped", " ").alias("dropped"), F.array_join(F.transform(roles, lambda r: F.concat(r["name_in_text"], F.coalesce(r["colour"], F.lit("")))), " ").alias("roles"))


@declare(QUERIES, f"select c_custkey, md5(replace('{sources.PLACE_QUERY.replace('<language>', 'en').replace('<limit>', '10')}', '<name>', '\"the \\\\\"' || c_name || '\\\\\"\"')) query from customer".replace("\\\\", "\\"))
def search_queries(customer: DataFrame) -> DataFrame:
    """The whole query for a quoted name."""
    return customer.select("c_custkey", F.md5(sources.place_query(F.concat(F.lit('the "'), "c_name", F.lit('"')))).alias("query"))


@declare(QUERIES, "select c_custkey, case when c_custkey % 3 = 0 then 0 when c_custkey % 3 = 1 then 2 end::int answers from customer")
def cached_answers(customer: DataFrame) -> DataFrame:
    """Names looked up in a cache in which a third has empty answers, a third two candidates, and a third is missing."""
    answers = customer.filter("c_custkey % 3 < 2").select(F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 == 1, F.array(F.lit("Q1"), F.lit("Q2"))).otherwise(F.array().cast("array<string>")).alias("candidates"))
    old = answers.select(sources.cache_key("w", F.col("name")).alias("key"), F.array(F.lit("old")).alias("candidates"))
    cache = sources.put_answers(old, answers, "w")
    names = customer.select("c_custkey", F.concat(F.lit("“the "), "c_name", F.lit("”")).alias("name"))
    return sources.with_cache(names, cache, "w", offline=False).select("c_custkey", F.size("candidates").alias("answers"))


BINDING = "'{\"item\": {\"value\": \"http://x/entity/Q' || c_custkey || '\"}, \"enLabel\": {\"value\": \"' || c_name || '\"}, \"lat\": {\"value\": \"' || (c_custkey % 90) || '.5\"}, \"lon\": {\"value\": \"bad\"}, \"population\": {\"value\": \"' || c_nationkey || '.0\"}}'"


@declare(QUERIES, "select c_custkey, 'Q' || c_custkey qid, c_name label, c_custkey % 90 + 0.5::double lat, 0::double lon, c_nationkey population from customer")
def parsed_bindings(customer: DataFrame) -> DataFrame:
    found = customer.select("c_custkey", sources.parse_binding(F.expr(BINDING)).alias("b"))
    return found.select("c_custkey", "b.qid", "b.label", "b.lat", "b.lon", "b.population")


@declare(QUERIES, "with s as (select user_id, event_type, 1 + row_number() over (partition by user_id order by event_id) % 5 kind from events), k as (select unnest(range(6)) ord, unnest(['exact', 'normalised', 'case_insensitive', 'ellipsis', 'near_miss', 'missing']) kind) select k.ord::int ord, k.kind, count(user_id)::bigint n, count_if(k.ord = 5 and s.kind is not null)::bigint stops, count_if(k.ord > 1 and s.kind is not null)::bigint strict_stops from k left join s on s.kind = k.ord + 1 group by 1, 2")
def verdict_summary(events: DataFrame) -> DataFrame:
    """Counts of verdicts by kind, zeros included, and how many of each stop a build."""
    at = 1 + F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) % 5
    checks = events.select(F.element_at(F.array(*[F.lit(k) for k in report.KINDS]), at.cast("int")).alias("kind"))
    counts = report.summary(checks)
    stops = checks.groupBy("kind").agg(F.count_if(report.blocks(False)).alias("stops"), F.count_if(report.blocks(True)).alias("strict_stops"))
    return counts.join(stops, "kind", "left").select("ord", "kind", "n", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("stops", "strict_stops")])


@declare(QUERIES, f"with q as (select conv_id, turn, coalesce(text, '') t from conversations) select conv_id, turn, {key_sql('t')} = {key_sql("upper(t)")} same, md5({norm_sql('t')}) as key from q")
def case_keys(conversations: DataFrame) -> DataFrame:
    """Whole texts and their upper case under one key; sharp s and other foldings make some of them differ."""
    t = F.coalesce("text", F.lit(""))
    return conversations.select("conv_id", "turn", (K.match_key(t) == K.match_key(F.upper(t))).alias("same"), F.md5(K.normalize(t)).alias("key"))


@declare(QUERIES, "select s_suppkey, case when s_suppkey % 3 = 0 then 'person ' || s_suppkey % 7 else lower(s_name) end person, false is_role from supplier")
def folded_cast(supplier: DataFrame) -> DataFrame:
    """Printed names folded onto persons by alias; others are their own."""
    people = supplier.sparkSession.createDataFrame([(f"person {k}", f"Person {k}", [f"Alias {k}", f"Mr. Alias {k}"]) for k in range(7)], "person string, display string, aliases array<string>")
    k = F.col("s_suppkey")
    names = supplier.select(k, F.when(k % 3 == 0, F.concat(F.lit("MR. ALIAS "), (k % 7).cast("string"))).otherwise(F.col("s_name")).alias("name"))
    return validate.fold_names(names, people).select("s_suppkey", "person", "is_role")


FILE = "case when conv_id % 7 = 0 then null when conv_id % 7 = 1 then ' ' when conv_id % 7 = 2 then '{\"chapter\": ' when conv_id % 7 = 3 then '{\"chapter\": ' || (conv_id + 1) || ', \"role\": 1}' when conv_id % 7 = 4 then '{\"chapter\": ' || (conv_id + 5) || '}' else '{\"chapter\": ' || conv_id || ', \"title\": \"' || n || '\"}' end"


@declare(
    QUERIES,
    "with c as (select conv_id from conversations group by 1 having conv_id > 0), e as (select unnest(range(1, (select max(conv_id) + 1 from c))) n) "
    "select n::int number, case when conv_id is null or n % 7 = 0 then 'missing' when n % 7 = 1 then 'empty' when n % 7 = 2 then 'malformed' when n % 7 in (3, 4) then 'mismatch' end problem from e left join c on conv_id = n where conv_id is null or n % 7 <= 4",
)
def file_checks(conversations: DataFrame) -> DataFrame:
    """A record file for most conversations, loaded and held against the numbers that there should be."""
    turns = conversations.filter("conv_id > 0").groupBy("conv_id").agg(F.count("*").alias("n"))
    files = turns.select(F.col("conv_id").cast("int").alias("number"), F.expr(FILE).alias("text")).filter("text is not null")
    loaded = extraction.load(files)
    return validate.check_files(loaded, turns.agg(F.max("conv_id")).first()[0] or 0)


@declare(
    QUERIES,
    "with p as (select distinct user_id as track, extract(day from ts)::int chapter from events), g as (select c.chapter, t.track, p.track is not null there from (select distinct chapter from p) c cross join (select unnest([1, 2]) track) t left join p on p.chapter = c.chapter and p.track = t.track)"
    " select chapter, 'ch ' || lpad(chapter::varchar, 2, '0') || '   ' || string_agg(case when not there then track || ' —' when track % 2 = 0 then track || ' leg ' || track % 8 || '@0.50 at ' || track else track || ' leg ' || track % 8 || '@0.50 carried from 03' end, '   ' order by track) as line from g group by 1",
)
def positions_log(events: DataFrame) -> DataFrame:
    days = events.select(F.col("user_id").cast("string").alias("track"), F.dayofmonth("ts").alias("chapter")).distinct()
    odd = F.col("track").cast("int") % 2 == 1
    series = days.select("track", "chapter", (F.col("track").cast("int") % 8).alias("leg"), F.lit(0.5).alias("along"), F.when(odd, "carried").otherwise("stated").alias("source"), F.when(odd, "").otherwise(F.concat(F.lit("at "), "track")).alias("place"), F.lit(3).alias("stated_at"))
    return report.positions_log(series, ["1", "2"])


@declare(QUERIES, "select event_id, case when event_id % 9 < 8 and event_id % 2 = 0 then 'stop ' || event_id % 9 when event_id % 9 = 7 and event_id % 2 = 1 then 'stop 8' end label from events")
def node_labels(events: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(f"stop {i}") for i in range(9)])
    e = F.col("event_id")
    return events.select("event_id", position.node_label(F.when(e % 9 < 8, (e % 9).cast("int")), (e % 2).cast("double"), names).alias("label"))


@declare(QUERIES, "with k as (select c_custkey, c_custkey % 11 p, c_nationkey % 9 leg, c_nationkey % 4 = 0 nowhere from customer) select c_custkey, case when p = 10 then 'unknown' when p = 8 then case when nowhere then 'unknown' else 'here' end when nowhere then 'unknown' when p = 0 then case when leg = 0 then 'here' when leg = 8 then 'past' else 'cyclic' end when p = 9 then case when leg <= 3 then 'future' else 'past' end when p = leg then 'here' when p < leg then 'past' else 'future' end as class from k")
def mention_classes(customer: DataFrame) -> DataFrame:
    """Places mentioned in a chapter, against where the lead is in it: chapters are customers, places a route of eight legs."""
    places = {str(k): position.Place("node", (k,) if k else (0, 8)) for k in range(8)} | {"8": position.Place("local"), "9": position.Place("waypoint", leg=3, along=0.5)}
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    mentions = customer.select(k.alias("chapter"), (k % 11).cast("string").alias("key"))
    series = customer.select(F.lit("lead").alias("track"), k.alias("chapter"), F.when(n % 4 != 0, n % 9).cast("int").alias("leg"), F.lit(0.0).alias("along"))
    return position.classify_mentions(mentions, series, "lead", position.Route(7, places)).select(F.col("chapter").alias("c_custkey"), "class")


# A record for every conversation, with a fault of every kind for some of them.
RECORD = """named_struct(
 'chapter', conv_id + if(conv_id % 5 = 1, 1, 0), 'title', if(conv_id % 9 = 4, 'other', 'the  title ' || conv_id), 'summary_hover', said[0].text, 'summary_detail', said[size(said) - 1].text,
 'places_visited', transform(said, x -> named_struct('name_in_text', 'The ' || initcap(x.role), 'role', 'arrival', 'evidence', 'e')),
 'places_mentioned', array(named_struct('name_in_text', if(conv_id % 2 = 0, upper(said[0].role), 'elsewhere'), 'evidence', 'e')),
 'people', if(conv_id % 3 = 0, array(), array(named_struct('name_in_text', 'PERSON A', 'role', 'r', 'evidence', 'e'))),
 'narrative', named_struct('on_stage', if(conv_id % 10 = 9, array(), array(named_struct('name_in_text', 'Person  a', 'at_name_in_text', case conv_id % 4 when 0 then said[0].role when 1 then 'nowhere' end, 'between_from', if(conv_id % 6 = 2, 'Suez', null), 'between_to', if(conv_id % 6 = 2, '“suez”', 'x'), 'evidence', 'e'))),
  'named_but_not_present', if(conv_id % 7 = 0, array(named_struct('name_in_text', 'person A', 'evidence', 'e')), array())),
 'money', named_struct('amounts', array(), 'fogg_remaining_stated', if(conv_id % 8 = 3, 'ten', null)))"""
RECORD_SQL = """
with t as (select conv_id, list(role order by turn) roles, list(coalesce(text, '') order by turn) texts from conversations group by 1),
r as (select *, conv_id % 10 <> 9 stage, [x for x in [
  case when conv_id % 5 = 1 then 'states another chapter' end,
  case when len(list_filter(regexp_split_to_array(texts[1], '\\s+'), lambda w: w <> '')) > 25 then 'hover summary is too long' end,
  case when len(regexp_extract_all(texts[-1], '[.!?](\\s|$)')) not between 2 and 6 then 'detail has too few or many sentences' end,
  case when len(roles) <> len(list_distinct(roles)) then 'a place is visited twice' end,
  case when conv_id % 2 = 0 then 'a place is both visited and mentioned' end,
  case when conv_id % 8 = 3 then 'a remaining sum without amounts' end,
  case when conv_id % 9 = 4 then 'title is another' end,
  case when stage and conv_id % 7 = 0 then 'on stage and not present' end,
  case when stage and conv_id % 6 = 2 then 'travels from a place to itself' end,
  case when stage and conv_id % 3 = 0 then 'on stage but not among the people' end,
  case when stage and conv_id % 4 = 1 then 'at a place that is not listed' end,
  case when not stage and conv_id % 3 <> 0 and conv_id % 7 <> 0 then 'no narrative' end] if x is not null] ps from t)
select conv_id::int as number, array_to_string(ps, '; ') problems from r
"""


@declare(QUERIES, RECORD_SQL)
def record_problems(conversations: DataFrame) -> DataFrame:
    """Every record against the rules of records, and its title against the contents."""
    said = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"), "role"))).alias("said"))
    number = F.col("conv_id").cast("int").alias("number")
    loaded = extraction.coerce(F.from_json(F.to_json(F.expr(RECORD)), extraction.SCHEMA))
    titles = conversations.select(number).distinct().withColumn("title", F.concat(F.lit("The Title "), "number"))
    return validate.check_records(said.select(number, loaded.alias("record")), titles).select("number", F.array_join("problems", "; ").alias("problems"))


CAST_SQL = """
with p as (select c_custkey, lower(c_name) person, c_name display, case when c_custkey % 4 = 0 then 'Mr. ' || c_name else c_name end a1, case when c_custkey % 6 = 1 then 'The Double ' || c_custkey // 12 else 'Alias ' || c_custkey end a2 from customer),
e as (select person, lower(unnest([a1, a2])) k, unnest([a1, a2]) alias from p)
select display as name, 'display is no alias' problem from p where lower(a1) <> lower(display) union all
select k, 'alias of several' from e group by 1 having count(distinct person) > 1 union all
select alias, 'alias is a role' from e where k in (select 'alias ' || s_suppkey * 5 from supplier)
"""


@declare(QUERIES, CAST_SQL.replace("select display as name, 'display is no alias' problem from p", "select person as name, 'display is no alias' problem from p"))
def cast_problems(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """A cast with aliases that several have, that are roles, or that leave out what is shown."""
    first = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("Mr. "), "c_name")).otherwise(F.col("c_name"))
    second = F.expr("case when c_custkey % 6 = 1 then 'The  Double ' || (c_custkey div 12) else 'Alias ' || c_custkey end")
    people = customer.select(F.lower("c_name").alias("person"), F.col("c_name").alias("display"), F.array(first, second).alias("aliases"))
    return validate.check_cast(people, supplier.select(F.concat(F.lit("ALIAS "), (F.col("s_suppkey") * 5).cast("string")).alias("name")))


# Every turn names a place and a person; a third of the places is drawn, a third listed with a reason, a third unknown.
TURN = "conv_id::int chapter, turn, role, initcap(role) || ' ' || turn % 3 place, ['past', 'here', 'future'][1 + turn % 3] class, turn % 4 > 0 present, role || turn % 2 person, turn % 2 = 1 is_role, case turn % 5 when 0 then upper(role) when 1 then 'Mr. ' || role else role end printed"
CARD_SQL = f"""
with t as (select {TURN.replace("initcap(role)", "upper(role[1]) || role[2:]")} from conversations),
m as (select chapter, string_agg(lower(place) || ':' || class || ':' || case when turn % 3 = 0 then 'drawn' when turn % 3 = 1 then 'none_found' else 'off' end || ':' || (turn % 3 = 0), ',' order by turn) places, count(*)::bigint named, count_if(turn % 3 = 0)::bigint plotted, count_if(class = 'here')::bigint here from t group by 1),
n as (select chapter, present, person, printed, min(turn) first from t group by all),
o as (select chapter, present, person, min(first) seq, arg_min(printed, first) as name, string_agg(printed, '/' order by first) spelled from n group by all),
d as (select chapter, present, person, bool_or(is_role) is_role from t group by all),
c as (select chapter, string_agg(case when present then person || '=' || spelled || case when is_role then '*' else '' end end, ',' order by seq) present, string_agg(case when not present then person || '=' || spelled || case when is_role then '*' else '' end end, ',' order by seq) elsewhere, count_if(present and is_role)::int roles from o join d using (chapter, present, person) group by 1),
k as (select distinct chapter from t)
select chapter, 'Chapter ' || chapter title, case when chapter % 4 > 0 then round({{lon}}, 4) end focus_lon, case when chapter % 2 = 0 then 'railway' else 'on_foot' end as mode, places, named, plotted, here, coalesce(present, '') present, coalesce(elsewhere, '') elsewhere, roles, case when chapter % 4 > 0 then 'fix:-,fogg:' || chapter % 24 else 'fix:-,fogg:-' end tracks
from k join m using (chapter) join c using (chapter) join (select n_nationkey i, (n_nationkey * 73 % 360 - 179.5)::double a from nation) on i = chapter % 24
"""


@declare(QUERIES, CARD_SQL.replace("{lon}", "a"))
def chapter_cards(conversations: DataFrame, nation: DataFrame) -> DataFrame:
    """A document for every conversation, as a chapter: its places, people and tracks, read back from the document."""
    t = conversations.select(*[F.expr(e).alias(n) for n, e in (
        ("chapter", "cast(conv_id as int)"), ("turn", "turn"), ("role", "role"), ("place", "initcap(role) || ' ' || turn % 3"), ("class", "array('past', 'here', 'future')[turn % 3]"), ("present", "turn % 4 > 0"),
        ("person", "role || turn % 2"), ("is_role", "turn % 2 = 1"), ("printed", "case turn % 5 when 0 then upper(role) when 1 then 'Mr. ' || role else role end"),
    )])
    number = F.col("chapter")
    record = F.to_json(F.struct(number.alias("chapter"), F.concat(F.lit("Chapter "), number).alias("title"), F.array(F.struct(F.when(number % 2 == 0, "train").otherwise("walking").alias("mode"))).alias("transport")))
    records = t.select(number).distinct().select(number.alias("number"), extraction.coerce(F.from_json(record, extraction.SCHEMA)).alias("record"))
    own = t.select(K.place_key(F.col("place")).alias("key"), "place", F.col("turn") % 3).distinct().toDF("key", "name", "k")
    mentions = t.select("chapter", F.col("turn").alias("seq"), F.concat(F.lit("“"), "place", F.lit("”")).alias("name"), "class")
    drawn = own.filter("k < 2").select("key", "name", F.when(F.col("k") == 1, "none_found").alias("reason"))
    places = payload.chapter_places(mentions, drawn, own.filter("k = 0").select("key"))
    people = t.select("chapter", "present", F.col("turn").alias("seq"), "person", F.initcap("person").alias("display"), F.col("printed").alias("name"), "is_role")
    point = F.array((F.col("n_nationkey") * 73 % 360 - 179.5).cast("double"), F.lit(10.0))
    legs = nation.select(F.col("n_nationkey").cast("int").alias("index"), point.alias("start"), F.array(F.lit(0.0), F.lit(0.0)).alias("end"))
    tracks = F.explode(F.array(F.lit("fogg"), F.lit("fix"))).alias("track")
    there = (F.col("track") == "fogg") & (number % 4 > 0)
    series = t.select("chapter").distinct().select("chapter", tracks).select("track", "chapter", F.when(there, number % 24).cast("int").alias("leg"), F.when(there, 0.0).alias("along"))
    cards = payload.chapters_payload(records, places, people, payload.track_pins(series, legs), "fogg")
    place = lambda p: F.concat_ws(":", p["key"], p["class"], F.when(p["plotted"], "drawn").otherwise(F.coalesce(p["reason"], F.lit("off"))), p["on_route"].cast("string"))
    person = lambda p: F.concat(p["key"], F.lit("="), F.concat_ws("/", p["name"], p["also_printed"]), F.when(p["kind"] == "role", "*").otherwise(""))
    listed = lambda c, f: F.array_join(F.transform(c, f), ",")
    return cards.select(
        "chapter", "title", F.round("focus.lon", 4).alias("focus_lon"), F.get("transport", F.lit(0))["mode"].alias("mode"), listed("places", place).alias("places"), "place_counts.named", "place_counts.plotted",
        F.coalesce(F.try_element_at("place_counts.by_class", F.lit("here")), F.lit(0)).cast("long").alias("here"), listed("present", person).alias("present"), listed("named_elsewhere", person).alias("elsewhere"),
        F.col("people_counts.present_roles").cast("int").alias("roles"), listed("tracks", lambda x: F.concat_ws(":", x["track"], F.coalesce(x["leg"].cast("string"), F.lit("-")))).alias("tracks"),
    )
