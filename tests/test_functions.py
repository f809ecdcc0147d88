"""Small vectors for the functions, and properties against plain Python."""

import random
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.functions import offsets as O
from waymark.functions import text as K
from waymark.operators import resolve

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lit(x):
    return F.lit(x)


@pytest.mark.parametrize(
    ("column", "want"),
    [
        (lambda: K.fold(lit("“I’ll wager it,” said Fogg.")), "\"I'll wager it,\" said Fogg."),
        (lambda: K.fold(lit("Suez—Bombay…")), "Suez-Bombay..."),
        (lambda: K.normalize(lit("They mounted upon\nthe elephant")), "They mounted upon the elephant"),
        (lambda: K.normalize(lit("a _b_ --c")), "a b -c"),
        (lambda: K.fold(lit("é"), nfc=True), "é"),
        (lambda: K.match_key(lit("Straße")), "strasse"),
        (lambda: K.strip_edge_quotes(lit("\" ' x")), "' x"),
        (lambda: K.place_key(lit("“Mongolia”")), "mongolia"),
        (lambda: K.place_key(lit("the Reform Club")), "reform club"),
        (lambda: K.place_key(lit("  Saville Row\n")), "saville row"),
        (lambda: K.place_key(lit("the the x")), "the x"),
        (lambda: K.node_key(lit("Bombay (India)")), "bombay"),
        (lambda: K.roman_to_int(lit("XXXVII")), 37),
        (lambda: K.roman_to_int(lit("IIII")), None),
        (lambda: K.name_changed(lit("Bombay"), lit("Mumbai")), True),
        (lambda: K.name_changed(lit("Suez"), lit("Suez (city)")), False),
        (lambda: K.name_changed(lit("Suez"), lit(None).cast("string")), False),
        (lambda: K.visible_text(lit("<p>a</p><p>b</p>")), "a b"),
        (lambda: K.inline_diff(lit("They mounted the elephant"), lit("They mounted upon the elephant")), "They mounted {+upon +}the elephant"),
        (lambda: K.best_span(lit("they mounted the elephant"), lit("the elephant"))["ratio"], 1.0),
        (lambda: K.normalise_mode(lit("Wind-Sled")), "sledge"),
        (lambda: F.array_join(K.parse_modes(lit("steamers and rail")), ","), "steamer,railway"),
        (lambda: K.split_via(lit("Suez viâ Mont Cenis and Brindisi"))["place"], "Suez"),
        (lambda: F.array_join(K.split_via(lit("Suez viâ Mont Cenis and Brindisi"))["via"], "|"), "Mont Cenis|Brindisi"),
        (lambda: K.qid_from_uri(lit("http://x.org/entity/Q84")), "Q84"),
        (lambda: K.sparql_string(lit('a"b\\')), '"a\\"b\\\\"'),
        (lambda: K.render_path(F.array(lit("a"), lit("0"), lit("b"))), "a[0].b"),
        (lambda: K.number_or_null(lit("7.0"), "int"), None),
        (lambda: K.number_or_null(lit(" 7 "), "int"), 7),
        (lambda: K.review_status(lit(" Yes ")), "confirmed"),
        (lambda: K.review_status(lit("")), "unconfirmed"),
        (lambda: F.round(geo.haversine_km(51.5072, -0.1276, 19.0761, 72.8775)), 7192.0),
        (lambda: geo.interpolate(F.array(lit(-0.1275), lit(51.50722)), F.array(lit(32.53333), lit(29.96667)), lit(0.5)), [18.951111, 41.874104]),
        (lambda: geo.interpolate(F.array(lit(0.0), lit(0.0)), F.array(lit(180.0), lit(0.0)), lit(0.5)), [-90.0, 0.0]),
        (lambda: geo.shortest_rotation(lit(170.0), lit(-170.0)), 20.0),
        (lambda: geo.shortest_rotation(lit(-170.0), lit(170.0)), -20.0),
        (lambda: geo.unwrap_eastward(F.array(lit(139.6), lit(-122.4))), [139.6, 237.6]),
        (lambda: geo.unwrap_eastward(F.array(lit(170.0), lit(-170.0), lit(179.0))), [170.0, 190.0, 179.0]),
        (lambda: geo.midpoint(geo.route_point(lit(0), lit(0.0)), geo.route_point(lit(2), lit(0.0)))["leg"], 1),
    ],
)
def test_vectors(spark, column, want):
    got = one(spark, column())
    assert got == want


def ring(points):
    return F.array(*[F.array(lit(float(x)), lit(float(y))) for x, y in points])


def test_rings(spark):
    square = [(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)]
    assert round(one(spark, geo.ring_area(ring(square))), 9) == 0.000304602
    assert round(one(spark, geo.ring_area(ring(square[::-1]))), 9) == -0.000304602
    wound = one(spark, geo.normalise_winding(F.array(ring(square[::-1]))))
    assert [tuple(p) for p in wound[0]] == square
    assert one(spark, geo.round_ring(ring([(0, 0), (0.004, 0), (1, 1), (0, 0)]))) == [[0, 0], [1, 1], [0, 0]]
    assert one(spark, geo.round_ring(ring([(0, 0), (0.001, 0), (0, 0)]))) == [[0, 0]]
    assert one(spark, geo.is_drawable(ring(square))) and not one(spark, geo.is_drawable(ring(square[:3])))


@quick
@given(st.text(alphabet="aB ’“”—…_ \n-'\"ß", max_size=30))
def test_normalize_is_the_plain_version(spark, text):
    table = {c: "'" for c in K.APOSTROPHES} | {c: '"' for c in K.QUOTES} | {c: "-" for c in K.DASHES} | {c: " " for c in K.SPACES} | {c: "" for c in K.DELETED} | {"…": "..."}
    plain = " ".join("".join(table.get(c, c) for c in unicodedata.normalize("NFC", text)).split())
    while "--" in plain:
        plain = plain.replace("--", "-")
    assert one(spark, K.normalize(lit(text))) == plain


@quick
@given(st.text(alphabet="abc", max_size=12), st.text(alphabet="abc", max_size=12))
def test_indel(spark, a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    want = 200 * table[-1][-1] / (len(a) + len(b)) if a or b else 100.0
    assert one(spark, K.indel_ratio(lit(a), lit(b))) == pytest.approx(want)


def test_casefold_is_pythons(spark):
    # the dotted capital I and final sigmas apart, every character alone and in the middle of a word
    chars = [c for c in map(chr, range(0x20000)) if c.casefold() != c and not 0xD800 <= ord(c) < 0xE000]
    rows = spark.createDataFrame([(c, f"a{c}b") for c in chars], "c string, w string")
    got = rows.select("c", K.casefold(F.col("c")).alias("x"), K.casefold(F.col("w")).alias("y")).collect()
    assert [r.c for r in got if (r.x, r.y) != (r.c.casefold(), f"a{r.c}b".casefold())] == []


@quick
@given(st.lists(st.sampled_from(["é", "é", "Å", "Å", "ΟΔΥΣΣΕΥΣ", "ſ", "µ", "ß", "ẞ", "ﬁ", "a", " ", "“", "—", "가", "̣̇s"]), max_size=12).map("".join))
def test_keys_are_nfc_and_folded(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(K.fold(F.col("t")).alias("f"), K.match_key(F.col("t")).alias("k"), F.get(K.nfc_each(F.array("t")), F.lit(0)).alias("n")).first()
    want = unicodedata.normalize("NFC", text)
    assert got.n == want and unicodedata.normalize("NFC", got.f) == got.f
    plain = " ".join(want.replace("“", '"').replace("—", "-").split())
    assert got.k == __import__("re").sub("-{2,}", "-", plain).strip().casefold()


def test_lines_of_the_normalised_text(spark):
    text = "\n\n one  --  two\n\n\nthree… \n\tfour—\nfive\n"
    rows = spark.createDataFrame([(text,)], "t string")
    for word, line in (("one", 3), ("two", 3), ("three", 6), ("four", 7), ("five", 8)):
        place = F.call_function("locate", F.lit(word), K.normalize(F.col("t"))) - 1
        span = O.span_in(O.normalized_runs(F.col("t")), place, place + 1)
        assert rows.select(O.line_of(F.col("t"), span["start"]).alias("x")).first().x == line


ODD_TEXT = st.lists(st.sampled_from(["a", "b", " ", "  ", "\n", "\u00a0", "_", "\u00ad", "\u200b", "-", "—", "–", "…", "“", "e\u0301", "é", "x\u0301", "\u0301", "ß", "ﬁ", "İ", "\u1112\u1161\u11ab", "\u0958", "😀"]), max_size=14).map("".join)


@quick
@given(ODD_TEXT)
def test_offset_maps(spark, text):
    """Places of a key lead to places of the raw text that never go back, and whose text has that key."""
    rows = spark.createDataFrame([(text,)], "t string")
    norm = rows.select(K.normalize(F.col("t")).alias("n"), K.match_key(F.col("t")).alias("k"), O.normalized_runs(F.col("t")).alias("runs"), O.casefold_runs(K.normalize(F.col("t"))).alias("folds")).first()
    assert sum(r.old + r.skip for r in norm.runs) == len(text) and sum(r.old + r.skip for r in norm.folds) == len(norm.n)
    assert len(norm.k) == sum(r.new + r.skip for r in norm.folds)
    n = len(norm.n)
    if not n:
        return
    mapped = rows.select("t", O.normalized_runs(F.col("t")).alias("runs"))
    each = mapped.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: O.span_in(F.col("runs"), i, i + 1))).alias("s"), "t").select("s.*", K.normalize(F.substring("t", F.col("s.start") + 1, F.col("s.end") - F.col("s.start"))).alias("own")).collect()
    assert [r.start for r in each] == sorted(r.start for r in each) and all(0 <= r.start < r.end <= len(text) for r in each)
    for c, r in zip(norm.n, each, strict=True):
        assert c in r.own or (c == " " and not r.own.strip()), (c, r)
    whole = rows.select(O.span_in(O.normalized_runs(F.col("t")), F.lit(0), F.lit(n)).alias("s")).first().s
    assert rows.select(K.normalize(F.substring("t", whole.start + 1, whole.end - whole.start)).alias("x")).first().x == norm.n


def test_fixed(spark):
    """The double's exact value is rounded, ties to even, as Python does; Java's formatter rounds what it prints, upward."""
    rng = random.Random(4)
    values = [0.845, 8450.0 / 10000, 0.125, 0.375, 1.005, 2.675, -0.845, -0.001, 0.0, -0.0, 0.995, 0.9999, 1e-300, 4503599627370497.5, 1e17, 123456.785]
    values += [k / 1000 for k in range(0, 3000, 5)] + [rng.uniform(-1, 1) * 10 ** rng.randrange(-4, 12) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "v double").select("v", *[K.fixed(F.col("v"), p).alias(f"p{p}") for p in (2, 3)]).collect()
    assert [(r.p2, r.p3) for r in rows] == [(f"{v:.2f}", f"{v:.3f}") if v is not None else (None, None) for v in (r.v for r in rows)]


def test_reasons_round_as_the_sql(spark):
    row = spark.createDataFrame([(0.845, 1000.5)], "b double, km double")
    none, yes = F.lit(False), F.lit(True)
    reasons = lambda c: resolve.reasons_to_check(none, yes, yes, yes, F.col(c), F.lit(2), F.col("km"), F.lit(""))
    assert list(row.select(reasons("b")).first()[0]) == ["2 candidates, 0.84 confidence", "1,000 km from the route, but the party goes there"]
