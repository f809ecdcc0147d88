"""Queries over texts: keys, quotations, segments, JSON, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import text as K
from waymark.operators import evidence, extraction, segment, validate
from waymark.operators import repair as mending

from ._declare import Declared, declare

QUERIES: dict[str, Declared] = {}

# Typography that the test texts don't have is put into them, alike on both sides.
VARIANT = "replace(replace(replace({0}, ' the ', ' “the” '), ' of ', '—of'), ' and ', ' _and_ ’t cafe\u0301 ΟΔΥΣΣΕΥΣ Straße ſo µ ﬁn \u212b ')"
SQL_NORM = (
    "trim(regexp_replace(regexp_replace(translate(replace(nfc_normalize({0}), '…', '...'), '‘’‚‛ʼ´`“”„‟«»″‐‑‒–—―−' || chr(160) || chr(8194) || chr(8195) || chr(8199) || chr(8201) || chr(8202) || chr(8239) || chr(173) || chr(8203) || chr(65279) || '_', "
    "'''''''''''''''\"\"\"\"\"\"\"------- ' || '      '), '\\s+', ' ', 'g'), '-{{2,}}', '-', 'g'))"
)


def norm_sql(x: str) -> str:
    return SQL_NORM.format(x)


def key_sql(x: str) -> str:
    # full case folding, of the characters that the texts and their variants have
    return f"replace(replace(translate(lower({norm_sql(x)}), 'ςſµ', 'σsμ'), 'ß', 'ss'), 'ﬁ', 'fi')"


EDGE_SQL = "trim(regexp_replace(trim({0}), '^[\"''‘’“”‚‛„‟]+|[\"''‘’“”‚‛„‟]+$', '', 'g'))"

ELIDED_SQL = "contains(nq, '...') and len(fq) >= 2 and list_reduce(list_prepend(nt, fq), lambda rest, f: case when contains(rest, f) then substr(rest, instr(rest, f) + length(f)) end) is not null"
PAIRS_SQL = f"""
with b as (select *, {EDGE_SQL.format('nq')} bq, list_filter(regexp_split_to_array(nq, '\\s*\\.\\.\\.\\s*'), lambda f: length(f) >= 8) fq from (select item_id, text q, {norm_sql('text')} nq, {key_sql('text')} kq from benchmark)), d as (select doc_id, source, text, {norm_sql('text')} nt, {key_sql('text')} kt from documents),
v as (select doc_id, source, item_id, case when contains(text, q) then 'exact' when contains(nt, nq) or (bq <> '' and contains(nt, bq)) then 'normalised' when contains(kt, kq) then 'case_insensitive' when {ELIDED_SQL} then 'ellipsis' else 'missing' end kind from d, b)
"""


@declare(QUERIES, f"{PAIRS_SQL} select doc_id, item_id, kind from v where kind <> 'missing'")
def quote_verdicts(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return evidence.find_quotes(documents, benchmark)


@declare(QUERIES, f"{PAIRS_SQL}, k as (select unnest(['exact', 'normalised', 'case_insensitive', 'ellipsis', 'missing']) kind) select k.kind, count(v.kind)::bigint n from k left join v on v.kind = k.kind group by 1")
def quote_verdict_counts(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return evidence.verdict_counts(evidence.find_quotes(documents, benchmark), documents.count() * benchmark.count())


@declare(QUERIES, f"{PAIRS_SQL} select source, count_if(kind = 'exact')::bigint exact, count_if(kind = 'normalised')::bigint normalised, count_if(kind = 'case_insensitive')::bigint case_insensitive from v group by 1")
def quote_verdicts_by_source(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = evidence.find_quotes(documents, benchmark).join(documents.select("doc_id", "source"), "doc_id")
    kinds = ["exact", "normalised", "case_insensitive"]
    pivot = found.groupBy("source").pivot("kind", kinds).agg(F.count(F.lit(1)))
    return documents.select("source").distinct().join(pivot, "source", "left").select("source", *[F.coalesce(k, F.lit(0)).alias(k) for k in kinds])


@declare(QUERIES, f"select doc_id, md5({norm_sql(VARIANT.format('text'))}) key from documents")
def normalized_text_key(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.md5(K.normalize(F.expr(VARIANT.format("text")))).alias("key"))


@declare(QUERIES, f"select p_partkey, {key_sql(VARIANT.format("upper(' ' || p_name || ' of the ' || p_type)"))} key from part")
def match_keys(part: DataFrame) -> DataFrame:
    return part.select("p_partkey", K.match_key(F.expr(VARIANT.format("upper(' ' || p_name || ' of the ' || p_type)"))).alias("key"))


@declare(QUERIES, f"select p_partkey, regexp_replace({EDGE_SQL.format(key_sql("'“The ' || p_name || '” '"))}, '^(the|an|a) ', '') key from part")
def place_keys(part: DataFrame) -> DataFrame:
    return part.select("p_partkey", K.place_key(F.expr("'“The ' || p_name || '” '")).alias("key"))


@declare(QUERIES, f"select c_custkey, {EDGE_SQL.format("' “''' || c_name || '” '")} bare from customer")
def edge_quotes(customer: DataFrame) -> DataFrame:
    return customer.select("c_custkey", K.strip_edge_quotes(F.expr("' “\\'' || c_name || '” '")).alias("bare"))


@declare(QUERIES, "select doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))::int words, trim(coalesce(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')[1], '')) first_line from documents")
def word_counts(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", K.word_count(F.col("text")).alias("words"), K.first_line(F.col("text")).alias("first_line"))


ROMAN_SQL = " || ".join(
    f"['', '{a}', '{a}{a}', '{a}{a}{a}', '{a}{b}', '{b}', '{b}{a}', '{b}{a}{a}', '{b}{a}{a}{a}', '{a}{c}'][n // {ten} % 10 + 1]" for a, b, c, ten in (("C", "D", "M", 100), ("X", "L", "C", 10), ("I", "V", "X", 1))
)


@declare(QUERIES, f"select p_partkey, n, repeat('M', (n // 1000)::int) || {ROMAN_SQL} numeral, n back, case when n % 10 < 4 then null else n end odd from (select p_partkey, 1 + p_partkey % 3999 n from part)")
def roman_numerals(part: DataFrame) -> DataFrame:
    """Numbers as numerals and back; four marks in a row are no numeral."""
    n = 1 + F.col("p_partkey") % 3999
    numeral = K.int_to_roman(n)
    odd = F.when(n % 10 < 4, F.concat(numeral, F.lit("IIII"))).otherwise(F.lower(numeral))
    return part.select("p_partkey", n.alias("n"), numeral.alias("numeral"), K.roman_to_int(numeral).cast("long").alias("back"), K.roman_to_int(odd).cast("long").alias("odd"))


@declare(
    QUERIES,
    "select l_returnflag, [null, 'railway', 'steamer', 'carriage', 'sledge', 'on_foot', 'steamer', 'other'][l_linenumber + 1] known, count(*)::bigint n from lineitem group by all",
)
def transport_modes(lineitem: DataFrame) -> DataFrame:
    """How often each mode of transport is met, by the words that numbers of lines stand for here."""
    words = [None, " Rail", "ship", "CART", "wind-sled ", "Walking", "boat", "hover craft"]
    word = F.get(F.array(*[F.lit(w) for w in words]), F.col("l_linenumber"))
    return lineitem.groupBy("l_returnflag", K.normalise_mode(word).alias("known")).agg(F.count("*").alias("n"))


@declare(QUERIES, "select s_suppkey, not regexp_matches(substr(regexp_replace(trim(n), '^(the|an|a)\\s+', '', 'i'), 1, 1), '\\p{Lu}') is_role from (select s_suppkey, case when s_suppkey % 3 = 0 then 'the ' || lower(s_name) when s_suppkey % 3 = 1 then 'The ' || s_name else s_name end n from supplier)")
def role_names(supplier: DataFrame) -> DataFrame:
    name = F.expr("case when s_suppkey % 3 = 0 then 'the ' || lower(s_name) when s_suppkey % 3 = 1 then 'The ' || s_name else s_name end")
    return supplier.select("s_suppkey", K.looks_like_a_role(name).alias("is_role"))


@declare(QUERIES, "select n_nationkey, replace(replace(replace(replace('<a title=\"' || n_name || '\">&', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') escaped, 'Hello ' || n_name || ' of {region}' filled, 'region' slot from nation")
def templates(nation: DataFrame) -> DataFrame:
    filled = K.fill(F.lit("Hello {name} of {region}"), {"name": F.col("n_name")})
    raw = F.concat(F.lit('<a title="'), "n_name", F.lit('">&'))
    return nation.select("n_nationkey", K.escape(raw).alias("escaped"), filled.alias("filled"), F.array_join(K.placeholder_names(filled), ",").alias("slot"))


VISIBLE_SQL = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g'), '(?is)<head\\b.*?</head\\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
)
for _entity, _char in K.ENTITIES.items():
    VISIBLE_SQL = f"replace({VISIBLE_SQL}, '{_entity}', '{_char.replace("'", "''")}')"
VISIBLE_SQL = f"replace({VISIBLE_SQL}, '&amp;', '&')"


@declare(QUERIES, f"with v as (select page_id, list_filter(regexp_split_to_array({VISIBLE_SQL}, '[\\s' || chr(160) || ']+'), lambda w: regexp_matches(w, '[\\p{{L}}\\p{{N}}]')) w from pages) select page_id, len(w)::int words, md5(array_to_string(w, ' ')) visible from v")
def visible_words(pages: DataFrame) -> DataFrame:
    seen = K.visible_text(F.col("html"))
    return pages.select("page_id", seen.alias("t")).select("page_id", K.word_count(F.col("t")).alias("words"), F.md5("t").alias("visible"))


@declare(QUERIES, "select doc_id, (unnest(range(len(string_split(text, chr(10))))))::int line_no, unnest(string_split(text, chr(10))) line from documents")
def segment_lines(documents: DataFrame) -> DataFrame:
    return segment.segment_lines(documents)


@declare(QUERIES, "select doc_id, len(regexp_extract_all(text, '[.!?](\\s|$)'))::int sentences, len(regexp_extract_all(text, '[.!?](\\s|$)')) between 2 and 6 as \"within\" from documents")
def sentence_count_policy(documents: DataFrame) -> DataFrame:
    n = F.regexp_count("text", F.lit(r"[.!?](?:\s|$)"))
    return documents.select("doc_id", n.alias("sentences"), n.between(2, 6).alias("within"))


@declare(QUERIES, "with w as (select doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) n from documents), m as (select median(n) m from w) select doc_id, n::int words, round(n / m, 6) ratio, n between 50 and 6000 as \"within\", n / m between 0.25 and 4 near from w, m")
def median_ratio_guard(documents: DataFrame) -> DataFrame:
    counted = documents.select("doc_id", K.word_count(F.col("text")).alias("words"))
    return segment.median_guard(counted).select("doc_id", "words", "ratio", "within", "near")


@declare(QUERIES, "select md5(text) text_key, count(*)::bigint n, min(doc_id) first_doc from documents group by text having count(*) > 1")
def duplicate_texts(documents: DataFrame) -> DataFrame:
    keyed = documents.select(F.md5("text").alias("text_key"), "doc_id")
    return validate.duplicates(keyed, "text_key", first="doc_id").withColumnRenamed("first", "first_doc")


@declare(QUERIES, "select doc_id, sha256(text) sha, length(text)::int chars from documents")
def provenance_hashes(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", K.fingerprint(F.col("text")).alias("sha"), F.length("text").alias("chars"))


@declare(QUERIES, "select event_id, (props->>'$.k')::int k, false is_unknown from events")
def json_props(events: DataFrame) -> DataFrame:
    unknown = F.size(extraction.unknown_keys(F.col("props"), ["k"])) > 0
    return events.select("event_id", F.from_json("props", "k int")["k"].alias("k"), unknown.alias("is_unknown"))


@declare(QUERIES, "select event_id, 'extra' unknown from events where event_id % 5 = 0")
def json_closed_schema(events: DataFrame) -> DataFrame:
    text = F.expr("case when event_id % 5 = 0 then replace(props, '{', '{\"extra\": 1, ') else props end")
    return events.select("event_id", F.array_join(extraction.unknown_keys(text, ["k"]), ",").alias("unknown")).filter("unknown != ''")


# Turns printed as JSON by hand: marks and line ends aren't escaped, a comma is too many or too few, or the end is missing.
SAID = "replace(replace(replace(text, ' the ', ' \"the\" '), ' of ', ' \"of\" '), chr(92), '')"
BROKEN = (
    "'Here it is: {\"turn\": ' || turn || case when turn % 4 = 1 then ' ' else ', ' end || '\"text\": \"' || said || '\", \"role\": [\"' || role || '\"' || "
    "case turn % 4 when 0 then ',]}' when 1 then ']} as you asked' when 2 then '' else '}' end"
)


@declare(
    QUERIES,
    f"""with s as (select *, {SAID} said from conversations where text is not null)
select conv_id, turn, md5(said) said, role, (length(said) - length(replace(said, '"', '')))::int escaped, (length(said) - length(replace(said, chr(10), '')))::int controls,
 case turn % 4 when 0 then 'comma' when 1 then 'comma' when 2 then 'end' else 'bracket' end other from s""",
)
def repaired_records(conversations: DataFrame) -> DataFrame:
    """Broken JSON mended: every string comes back whole, and each edit is listed."""
    said = conversations.filter("text is not null").withColumn("said", F.expr(SAID))
    fixed = said.select("conv_id", "turn", mending.repaired(F.expr(BROKEN)).alias("r"))
    v, edits = F.try_parse_json("json"), F.col("edits.edit")
    count = lambda kind: F.size(F.filter(edits, lambda e: e == kind))
    other = F.array_join(F.filter(edits, lambda e: ~e.isin("escape", "control")), ",")
    fixed = fixed.select("conv_id", "turn", "r.*")
    return fixed.select("conv_id", F.try_variant_get(v, "$.turn", "int").alias("turn"), F.md5(F.try_variant_get(v, "$.text", "string")).alias("said"), F.try_variant_get(v, "$.role[0]", "string").alias("role"), count("escape").alias("escaped"), count("control").alias("controls"), other.alias("other"))


FENCED = "case when event_id % 3 = 0 then 'Here: ```' || chr(10) || props || chr(10) || '```' when event_id % 3 = 1 then '```json' || chr(10) || props || chr(10) || '```' else props end"


@declare(QUERIES, "select event_id, (props->>'$.k')::int k from events")
def json_tolerant(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.get_json_object(extraction.parse_object(F.expr(FENCED)), "$.k").cast("int").alias("k"))


@declare(QUERIES, "select conv_id, format('turns[{}].evidence', rn - 1) path, text quote from (select *, row_number() over (partition by conv_id order by turn) rn from conversations) where trim(text) <> ''")
def evidence_explode(conversations: DataFrame) -> DataFrame:
    arrays = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("turns"))
    each = arrays.select("conv_id", F.posexplode("turns").alias("i", "t"))
    return each.select("conv_id", F.format_string("turns[%d].evidence", "i").alias("path"), F.col("t.text").alias("quote")).filter(F.trim("quote") != "")


# Capitals of ASCII only: engines differ in the others.
UPPER = "translate({0}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"
# Spelled so that a place in the key is another one in the text: runs of spaces and dashes, deleted marks, an ellipsis.
VARIED = "replace(replace(replace(coalesce(text, ''), ' the ', ' “the”   '), ' of ', ' —–of '), ' and ', ' _and_ wait… ')"
LADDER_QUOTE = (
    "case turn % 5 when 0 then left(t, 40) when 1 then {upper} when 2 then left(t, 20) || ' ... ' || right(t, 20) when 3 then '“' || right(t, 30) || '”' else replace(replace(left(t, 60), '_', ''), '…', '...') end"
).format(upper=UPPER.format("left(t, 40)"))
# How many characters of the key are made of the text before each place: a span begins at the last place that has no more
# than come before it, and ends at the first that has more than its last.
LADDER_SQL = f"""
with q as (select *, {LADDER_QUOTE} q from (select conv_id, turn, {VARIED} t from conversations)),
n as (select *, {norm_sql('t')} nt, {norm_sql('q')} nq, {key_sql('t')} kt, {key_sql('q')} kq from q),
m as (select *, {EDGE_SQL.format('nq')} bq, list_filter(regexp_split_to_array(nq, '\\s*\\.\\.\\.\\s*'), lambda f: length(f) >= 8) fq from n),
k as (select *, case when q <> '' and contains(t, q) then 'exact' when nq = '' then 'missing' when contains(nt, nq) or (bq <> '' and contains(nt, bq)) then 'normalised' when contains(kt, kq) then 'case_insensitive' when {ELIDED_SQL} then 'ellipsis' else 'unlike' end kind,
 case when contains(nt, nq) then instr(nt, nq) when bq <> '' and contains(nt, bq) then instr(nt, bq) when contains(kt, kq) then instr(kt, kq) else instr(nt, fq[1]) end spot from m),
e as (select *, case when kind = 'ellipsis' then length(nt) - length(list_reduce(list_prepend(nt, fq), lambda rest, f: substr(rest, instr(rest, f) + length(f)))) when contains(nt, nq) or kind = 'case_insensitive' then spot + length(nq) - 1 else spot + length(bq) - 1 end stop,
 case when kind in ('normalised', 'case_insensitive', 'ellipsis') then list_transform(range(0, length(t) + 1), lambda i: length({norm_sql("left(t, i::int) || 'x'")}) - 1) end before from k),
s as (select *, case when kind = 'exact' then instr(t, q) - 1 else len(list_filter(before, lambda f: f < spot)) - 1 end st, case when kind = 'exact' then instr(t, q) - 1 + length(q) else len(list_filter(before, lambda f: f < stop)) end en from e)
select conv_id, turn, kind, st::int as start, en::int as "end", len(string_split(left(t, st::int), chr(10)))::int line_no, case when kind = 'case_insensitive' then trim(substr(nt, spot, length(nq))) end closest from s
"""


@declare(QUERIES, LADDER_SQL)
def quote_ladder(conversations: DataFrame) -> DataFrame:
    """Quotations from every turn, changed so that each needs another rung, with the place, line and wording that was found.

    ``unlike`` are those that only difflib can rank (near misses or missing).
    """
    text = conversations.select("conv_id", "turn", F.expr(VARIED).alias("t"))
    checks = evidence.check_quotes(text.withColumn("quote", F.expr(LADDER_QUOTE)), text="t")
    ranked = F.col("kind").isin("exact", "normalised", "case_insensitive", "ellipsis") | (K.normalize(F.col("quote")) == "")
    shown = [F.when(ranked, F.col(c)).alias(c) for c in ("start", "end", "line_no", "closest")]
    return checks.select("conv_id", "turn", F.when(ranked, F.col("kind")).otherwise("unlike").alias("kind"), *shown)


@declare(QUERIES)
def fuzzy_best_span(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Items with changed letters, looked for in all documents: near misses and what is better."""
    changed = benchmark.select("item_id", F.regexp_replace("text", " th", " sh").alias("text"))
    return evidence.find_near(documents, changed).withColumn("ratio", F.round("ratio", 6))


# The longest common subsequence by the bit-parallel recurrence, on 128-bit integers: part names have fewer characters.
INDEL_SQL = """
with x as (select p_partkey, p_name a, lag(p_name) over (partition by p_brand order by p_partkey) b from part),
m as (select *, (2::hugeint ** length(a))::hugeint - 1 f, list_transform(string_split(b, ''), lambda c: coalesce(list_sum(list_transform(range(length(a)), lambda i: case when substr(a, i::int + 1, 1) = c then (2::hugeint ** i)::hugeint else 0::hugeint end)), 0)::hugeint) ms from x where b is not null),
v as (select *, list_reduce(list_prepend(f, ms), lambda v, u: ((v + (v & u)) | (v - (v & u))) & f) v from m)
select p_partkey, round(200.0::double * (length(a) - bit_count(v)) / (length(a) + length(b)), 6) ratio from v
"""


def _neighbours(part: DataFrame) -> DataFrame:
    order = Window.partitionBy("p_brand").orderBy("p_partkey")
    return part.withColumn("other", F.lag("p_name").over(order)).filter("other is not null")


@declare(QUERIES, INDEL_SQL)
def indel_ratios(part: DataFrame) -> DataFrame:
    return _neighbours(part).select("p_partkey", F.round(K.indel_ratio("p_name", "other"), 6).alias("ratio"))


@declare(QUERIES, "select p_partkey, b before, p_name as after from (select *, lag(p_name) over (partition by p_brand order by p_partkey) b from part) where b is not null")
def inline_diffs(part: DataFrame) -> DataFrame:
    """The diff of neighbours' names, and what both sides are when it is read without its insertions or deletions."""
    diff = K.inline_diff("other", "p_name")
    before = F.regexp_replace(F.regexp_replace(diff, r"\{\+.*?\+\}", ""), r"\[-(.*?)-\]", "$1")
    after = F.regexp_replace(F.regexp_replace(diff, r"\[-.*?-\]", ""), r"\{\+(.*?)\+\}", "$1")
    return _neighbours(part).select("p_partkey", before.alias("before"), after.alias("after"))


@declare(QUERIES, "select event_id, 1 + event_id % 5 lo, 5 + event_id % 7 hi, list_sort(list_distinct(list_concat(range(1 + event_id % 5, 6 + event_id % 7), [12])))::varchar picked from events")
def chapter_selections(events: DataFrame) -> DataFrame:
    spec = F.expr("(1 + event_id % 5) || '-' || (5 + event_id % 7) || ' ,12'")
    return events.select("event_id", F.expr("1 + event_id % 5").alias("lo"), F.expr("5 + event_id % 7").alias("hi"), F.concat(F.lit("["), F.array_join(segment.chapter_selection(spec), ", "), F.lit("]")).alias("picked"))


STRIPPED_SQL = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


@declare(QUERIES, f"select conv_id, row_number() over (partition by conv_id order by turn)::int number, upper(role) title, {STRIPPED_SQL.format(f"array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {STRIPPED_SQL.format('x')}), chr(10))")} body from conversations")
def book_chapters(conversations: DataFrame) -> DataFrame:
    """Each conversation printed as a book, and cut into its chapters again; lines are stripped, blank ones inside stay."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    rows = conversations.withColumn("n", F.row_number().over(order))
    page = F.concat(F.lit("CHAPTER "), K.int_to_roman(F.col("n")), F.lit(".\n"), F.upper("role"), F.lit("\n\n"), F.coalesce("text", F.lit("")), F.lit("\n\n"))
    books = rows.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", page.alias("p")))), lambda x: x["p"]), "").alias("text"))
    return segment.split_chapters(books).select("conv_id", "number", "title", "body")


@declare(QUERIES, "select conv_id::int conv_id, format('places_visited[{}].evidence', rn - 1) path, trim(text, ' ' || chr(10)) quote from (select *, row_number() over (partition by conv_id order by turn) rn from conversations) where trim(text, ' ' || chr(10)) <> ''")
def extraction_evidence(conversations: DataFrame) -> DataFrame:
    """Each conversation as an extraction record in JSON, some within code fences; parsed, coerced, and its evidence exploded."""
    visit = F.struct(F.col("role").alias("name_in_text"), F.lit("arrival").alias("role"), F.col("text").alias("evidence"))
    lists = conversations.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", visit.alias("v")))), lambda x: x["v"]).alias("places_visited"))
    number = F.col("conv_id").cast("int")
    plain = F.to_json(F.struct(number.alias("chapter"), "places_visited"))
    text = F.when(number % 2 == 0, F.concat(F.lit("```json\n"), plain, F.lit("\n```"))).otherwise(plain)
    loaded = extraction.load(lists.select(number.alias("number"), text.alias("text")))
    return extraction.evidence_rows(loaded.filter("error is null")).select(F.col("number").alias("conv_id"), "path", "quote")


@declare(QUERIES, "select conv_id::int conv_id, case conv_id % 5 when 0 then 'empty' when 1 then 'malformed' when 2 then 'mismatch' when 3 then 'unknown_keys' else 'bad_role' end error from (select distinct conv_id from conversations)")
def extraction_errors(conversations: DataFrame) -> DataFrame:
    number = F.col("conv_id").cast("int")
    text = F.expr(
        "case conv_id % 5 when 0 then ' ' when 1 then '{\"chapter\": ' when 2 then '{\"chapter\": ' || (conv_id + 1) || '}' "
        "when 3 then '{\"chapter\": ' || conv_id || ', \"colour\": 1}' else '{\"chapter\": ' || conv_id || ', \"places_visited\": [{\"name_in_text\": \"x\", \"role\": \"sleeping\", \"evidence\": \"y\"}]}' end"
    )
    loaded = extraction.load(conversations.select("conv_id").distinct().select(number.alias("number"), text.alias("text")))
    return loaded.select(F.col("number").alias("conv_id"), "error")


@declare(QUERIES, "select conv_id::int conv_id, role as key, count(*)::bigint uses, min(rn)::bigint first_turn from (select *, row_number() over (partition by conv_id order by turn) rn from conversations) group by all")
def place_uses(conversations: DataFrame) -> DataFrame:
    """Places used per record, by key: here the roles that speak in a conversation."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    named = conversations.withColumn("n", F.row_number().over(order)).select("conv_id", "n", F.lit(0).alias("ord"), F.col("turn").alias("pos"), F.lit("visited").alias("how"), F.concat(F.lit("The "), F.initcap("role")).alias("name"), F.col("text").alias("evidence"))
    summary = extraction.place_summary(named.withColumn("name", F.concat("conv_id", F.lit("|"), "name")), "n")
    parts = F.split("key", r"\|the ")
    return summary.select(parts[0].cast("int").alias("conv_id"), parts[1].alias("key"), "uses", F.col("first_chapter").cast("long").alias("first_turn"))
