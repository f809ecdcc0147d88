"""Operators on small frames."""

import json

import pytest
from pyspark.sql import functions as F

from waymark import sources
from waymark.functions import text as K
from waymark.operators import evidence, extraction, payload, position, report, resolve, review, segment, validate
from waymark.streaming import incremental

BOOK = (
    "Title page\r\n*** START OF THE PROJECT GUTENBERG EBOOK X ***\r\n\r\n  CHAPTER I. IN WHICH\r\n  CHAPTER II. IN WHAT\r\n\r\nCHAPTER I.\r\nIN\r\nWHICH\r\n\r\nThey mounted upon\r\nthe “elephant”.\r\n\r\n"
    "CHAPTER II.\r\nIN WHAT\r\n\r\nAnd left.\r\n*** END OF THE PROJECT GUTENBERG EBOOK X ***\r\n"
)
TABLE = "x\nFrom London to Suez viâ Mont Cenis and Brindisi, by rail\nand steamboats ..... 7 days\nFrom Suez to Bombay, by steamer ........ 13 ”\nFrom Bombay to London (home), by rail ... 3 ”\nTotal .......... 23 days.\ny"


def test_book(spark, tmp_path):
    (tmp_path / "book_01.txt").write_bytes(BOOK.encode())
    docs = sources.read_numbered(spark, str(tmp_path))
    text = segment.strip_boilerplate(F.col("text"))
    rows = docs.select(text.alias("text"))
    assert rows.select(segment.contents_titles(F.col("text")).alias("t")).first().t == ["IN WHICH", "IN WHAT"]
    got = segment.split_chapters(rows.select(segment.strip_front_matter(F.col("text")).alias("text"))).orderBy("number").collect()
    assert [(r.number, r.title, r.body) for r in got] == [(1, "IN WHICH", "They mounted upon\nthe “elephant”."), (2, "IN WHAT", "And left.")]
    bad = spark.createDataFrame([("no markers",)], "text string")
    with pytest.raises(Exception, match="marker"):
        bad.select(segment.strip_boilerplate(F.col("text"))).collect()


def test_itinerary(spark):
    legs = segment.parse_itinerary(spark.createDataFrame([(TABLE,)], "text string"))
    rows = legs.orderBy("index").collect()
    assert [(r.origin, r.destination, r.days, r.modes, r.via) for r in rows] == [
        ("London", "Suez", 7, ["railway", "steamer"], ["Mont Cenis", "Brindisi"]), ("Suez", "Bombay", 13, ["steamer"], []), ("Bombay", "London", 3, ["railway"], []),
    ]
    nodes = segment.route_nodes(legs).orderBy("index").collect()
    assert [(r["index"], r["name"], r.day) for r in nodes] == [(0, "London", 0), (1, "Suez", 7), (2, "Bombay", 20), (3, "London", 23)]
    assert {r["index"]: r.problems for r in validate.check_spine(legs, 23, 3).collect()} == {0: [], 1: [], 2: [], None: []}
    assert validate.check_spine(legs, 80, 8).filter("index is null").first().problems == ["3 legs", "legs take 23 days"]


def test_quotes(spark):
    text = "They mounted upon\nthe elephant, and set out for Allahabad in the cool of the morning."
    quotes = ["mounted upon\nthe", "mounted upon the elephant", "“the elephant”", "THE ELEPHANT", "They mounted upon ... cool of the morning", "and set off for Allahabad in the cool", "purchased for a great sum", ""]
    got = evidence.check_quotes(spark.createDataFrame([(i, text, q) for i, q in enumerate(quotes)], "i int, text string, quote string"))
    rows = {r.i: r for r in got.collect()}
    assert [rows[i].kind for i in range(8)] == ["exact", "normalised", "normalised", "case_insensitive", "ellipsis", "near_miss", "missing", "missing"]
    assert rows[0].line_no == 1 and rows[5].ratio > 0.9
    assert [r.kind for r in evidence.failing(got).collect()][:2] == ["missing", "missing"]


def test_records(spark, tmp_path):
    record = {"chapter": 1, "people": [{"name_in_text": " Fogg ", "evidence": "e"}], "places_visited": None, "transport": [{"mode": "boat", "from": " ", "to": "Suez", "evidence": "t"}], "time": None}
    broken = '{"chapter": 2, "notes": "a",}'
    files = {1: "Sure:\n```json\n" + json.dumps(record) + "\n```", 2: broken, 3: "nothing", 5: json.dumps({"chapter": 4})}
    frame = spark.createDataFrame(list(files.items()), "number int, text string")
    got = {r.number: r for r in extraction.load(frame).collect()}
    assert {k: r.error for k, r in got.items()} == {1: None, 2: "malformed", 3: "malformed", 5: "mismatch"}
    own = got[1].record
    assert own.people[0].name_in_text == "Fogg" and own.places_visited == [] and own.transport[0].mode == "steamer" and own.transport[0]["from"] is None and own.time.schedule_status == "unknown"
    mended = {r.number: r.error for r in extraction.load(frame, repair_broken=True).collect()}
    assert mended[2] is None and mended[3] == "malformed"
    assert {r.number: r.problem for r in validate.check_files(extraction.load(frame), 5).collect()} == {2: "malformed", 3: "malformed", 4: "missing", 5: "mismatch"}
    assert [(r.path, r.quote) for r in extraction.evidence_rows(extraction.load(frame).filter("error is null")).orderBy("ord", "pos").collect()] == [("people[0].evidence", "e"), ("transport[0].evidence", "t")]
    assert "no narrative" in validate.check_records(extraction.load(frame).filter("error is null")).first().problems
    for n, text in files.items():
        (tmp_path / f"chapter_{n:02d}.json").write_text(text)
    texts = spark.createDataFrame([(1, "an e and a t")], "number int, text string")
    seen = []
    stream = incremental.merge_stream(incremental.check_stream(incremental.incoming_records(spark, str(tmp_path)), texts), lambda b: seen.extend(r.kind for r in b.collect()), str(tmp_path / "checkpoint"))
    stream.awaitTermination(60)
    assert seen == ["exact", "exact"]


def test_balanced_object(spark):
    texts = ['x {"a": "}{", "b": {"c": 1}} y {}', '{"a": "\\"}"} z', "{", ""]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", extraction.balanced_object(F.col("t")).alias("o"), extraction.stated_chapter(F.concat(F.lit('{"chapter": 7'), "t")).alias("n")).orderBy("i").collect()
    assert [r.o for r in got] == ['{"a": "}{", "b": {"c": 1}}', '{"a": "\\"}"}', None, None]
    assert all(r.n == 7 for r in got)


PLACES = {
    "london": position.Place("node", (0, 2)), "suez": position.Place("node", (1,)), "club": position.Place("micro", parent="london"), "station": position.Place("local"),
    "paris": position.Place("waypoint", leg=0, along=0.25), "india": position.Place("off_route"),
}


def test_positions(spark):
    none = None
    stage = [
        (1, 0, "fogg", "club", none, none, "the Club", none, none, "a"), (2, 0, "fogg", none, "london", "suez", none, "London", "Suez", "b"), (3, 0, "fogg", "suez", none, none, "Suez", none, none, "c"),
        (3, 1, "fogg", "station", none, none, "station", none, none, "d"), (4, 0, "fogg", none, none, none, none, none, none, "e"), (5, 0, "fogg", "london", none, none, "London", none, none, "f"),
        (2, 0, "fix", "nowhere", none, none, "Nowhere", none, none, "g"), (4, 0, "fix", none, "paris", none, none, "Paris", none, "h"),
    ]
    columns = "chapter int, seq int, track string, at string, start string, end string, at_name string, start_name string, end_name string, evidence string"
    visited = spark.createDataFrame([(4, 0, "paris", "Paris", "setting", "v"), (4, 1, "suez", "Suez", "arrival", "w")], "chapter int, seq int, key string, name string, role string, evidence string")
    chapters, tracks = spark.range(1, 7).select(F.col("id").cast("int").alias("chapter")), spark.createDataFrame([("fogg",), ("fix",)], "track string")
    series = position.resolve_positions(spark.createDataFrame(stage, columns), visited, chapters, tracks, position.Route(1, PLACES))
    got = {(r.track, r.chapter): r for r in series.collect()}
    point = lambda t, c: (got[t, c].leg, got[t, c].along, got[t, c].source)
    assert [point("fogg", c) for c in range(1, 7)] == [(0, 0.0, "stated"), (0, 0.5, "stated"), (1, 0.0, "stated"), (1, 0.0, "inferred"), (1, 1.0, "stated"), (1, 1.0, "carried")]
    assert got["fogg", 3].evidence == "c" and got["fogg", 6].stated_at == 5
    assert [point("fix", c)[2] for c in range(1, 7)] == ["unknown", "unknown", "unknown", "stated", "carried", "carried"]
    assert point("fix", 4)[:2] == (0, 0.35)
    rules = {(r.severity, r.track, r.rule) for r in position.step_checks(series, "fogg", 1, 6).collect()}
    assert ("warning", "fix", "apart_from_lead") in rules and not any(x[0] == "problem" for x in rules)
    assert {r.track: (r.stated, r.total) for r in position.coverage(series).collect()} == {"fogg": (4, 6), "fix": (1, 6)}
    assert position.series_rows(series).filter("key = '03:fogg'").first().along == "0.000"


def test_resolve(spark):
    places = spark.createDataFrame([("bombay", "Bombay", ""), ("atlantis", "Atlantis", "")], "key string, name string, hint string")
    rows = [("bombay", "Q1156", "Mumbai", "Bombay | Bombai", 19.07, 72.87, None, 200), ("bombay", "Q1361", "Bombay Beach", "", 33.35, -115.73, None, 10), ("bombay", "Q9", "Bombay", "", 19.0, 72.0, "Q11424", 500)]
    candidates = spark.createDataFrame(rows, "key string, qid string, label string, aliases string, lat double, lon double, type_id string, sitelinks int")
    anchors = spark.createDataFrame([(19.0, 72.8), (51.5, -0.1)], "lat double, lon double")
    got = {r.key: r for r in resolve.resolve(places, candidates, anchors).collect()}
    assert got["bombay"].qid == "Q1156" and got["bombay"].confidence > 0.5 and got["atlantis"].why == "no candidate"


def test_resolve_by_group(spark):
    """Places that share their candidates get what each gets with candidates of its own; hints, and repeated names."""
    places = spark.createDataFrame([(str(k), k % 2, ["Bombay", "Suez", "bombay "][k % 3], "Aden" if k == 5 else None) for k in range(12)] + [("x", 7, "Suez", None), ("y", None, "Suez", None)], "key string, g int, name string, hint string")
    rows = [(k % 2, f"Q{k}", ["Bombay", "Suez", "Sues", "Aden", None][k % 5], ["", "Bombai | Suez", None][k % 3], float(k), float(k), "Q5" if k == 4 else None, k) for k in range(9)]
    shared = spark.createDataFrame(rows, "g int, qid string, label string, aliases string, lat double, lon double, type_id string, sitelinks int")
    anchors = spark.createDataFrame([(1.0, 2.0)], "lat double, lon double")
    got = resolve.resolve(places, shared, anchors, by="g").select("key", "qid", "confidence", "why").collect()
    own = resolve.resolve(places, places.select("key", "g").join(shared, "g").drop("g"), anchors).select("key", "qid", "confidence", "why").collect()
    assert sorted(got, key=str) == sorted(own, key=str) and len(got) == 14


@pytest.mark.parametrize(("places", "candidates", "pairs"), [(1024, 4096, 1 << 21), (2, 3, 4)])
def test_pairs_in_cells(spark, monkeypatch, places, candidates, pairs):
    for name, value in (("PLACES", places), ("CANDIDATES", candidates), ("PAIRS", pairs)):
        monkeypatch.setattr(resolve, name, value)
    a = spark.createDataFrame([(k, k % 3) for k in range(20)] + [(90, None), (91, 8)], "k int, g int")
    b = spark.createDataFrame([(k, k % 4) for k in range(15)] + [(90, None), (91, 9), (3, 3)], "c int, g int")
    got = sorted(tuple(r) for r in resolve.pairs_in_cells(a, b, "g", "k").select("k", "g", "c").collect())
    assert got == sorted(tuple(r) for r in a.join(b, "g").select("k", "g", "c").collect())


def test_only_the_first_two_are_shuffled(spark):
    """A task keeps the first two of a group before anything is shuffled; no window has all pairs."""
    rows = spark.range(100).selectExpr("id % 4 g", "1D gate", "1D name", "cast(id % 9 as double) route", "1D prominence", "id qid").repartition(3)
    plan = resolve.best_candidate(rows, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.rindex("WindowGroupLimit") > plan.rindex("hashpartitioning(g")


def test_review(spark):
    old = spark.createDataFrame([("a", "x", "y", "mine"), ("z", "", "", "")], "key string, name string, confirmed string, note string")
    new = spark.createDataFrame([("a", "n", "", ""), ("b", "m", "", "")], "key string, name string, confirmed string, note string")
    got = {r.key: tuple(r)[1:] for r in review.merge_rows(old, new, "key", ["key", "name", "confirmed", "note"]).collect()}
    assert got == {"a": ("n", "y", "mine"), "b": ("m", "", ""), "z": ("", "", "")}
    with pytest.raises(ValueError, match="note"):
        review.merge_rows(old.drop("note"), new, "key", ["key", "name", "confirmed", "note"])
    assert [r.key for r in review.prune(old, new, "key").collect()] == ["a"]


def test_table_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("b", 'say "x"\nnow'), ("a", "")], "key string, note string")
    sources.write_table(rows, str(tmp_path / "t"), "key")
    assert sorted(map(tuple, sources.read_table(spark, str(tmp_path / "t"), "key").collect())) == [("a", ""), ("b", 'say "x"\nnow')]


def test_journey(spark):
    nodes = spark.createDataFrame([(0, "London", 51.5, -0.13, 0), (1, "Suez", 29.97, 32.53, 7), (2, "Yokohama", 35.4, 139.6, 40), (3, "San Francisco", 37.8, -122.4, 62)], "index int, name string, lat double, lon double, day int")
    legs = payload.journey_legs(spark.createDataFrame([(0, 7, ["railway"]), (1, 33, ["steamer"]), (2, 22, ["steamer"])], "index int, days int, modes array<string>"), nodes)
    assert all(len(r.arc) == 64 for r in legs.collect())
    places = spark.createDataFrame([("aden", "Aden", "waypoint", 0, 0.5, 41.87, 18.95, "", "sparql", 0.9), ("far", "Far", "waypoint", 0, 0.5, -40.0, 170.0, "", "sparql", 0.9), ("hall", "hall", "local", None, None, None, None, "", "", None)], "key string, name string, kind string, leg int, along double, lat double, lon double, confirmed string, gazetteer_source string, confidence double")
    got = {r.key: r for r in payload.places_payload(places, legs).collect()}
    assert (got["aden"].reason, got["far"].reason, got["hall"].reason) == (None, "contradicts_its_leg", "floating_interior")
    assert payload.payload_counts(payload.places_payload(places, legs)).first().drawn == 1
    pieces = payload.map_segments(nodes).collect()
    assert {r.world for r in pieces} == {0, 1} and all(-180 <= p[0] <= 180 for r in pieces for p in (r.a, r.b))


def test_names(spark):
    people = spark.createDataFrame([("fogg", "Phileas Fogg", ["Phileas Fogg", "Mr. Fogg"]), ("x", "X", ["Y"])], "person string, display string, aliases array<string>")
    names = spark.createDataFrame([("Mr. Fogg",), ("the guide",), ("Aouda",)], "name string")
    assert {r["name"]: (r.person, r.is_role) for r in validate.fold_names(names, people).collect()} == {"Mr. Fogg": ("fogg", False), "the guide": ("the guide", True), "Aouda": ("aouda", False)}
    assert [r.problem for r in validate.check_cast(people, spark.createDataFrame([("guide",)], "name string")).collect()] == ["display is no alias"]
    assert [r.problems for r in validate.check_strings(spark.createDataFrame([("a", "<b>{x}"), ("b", "{y"), ("c", "ok {n}")], "key string, value string")).orderBy("key").collect()] == [["markup"], ["unbalanced braces"], []]


def test_geojson_and_bindings(spark, tmp_path):
    square = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    features = [{"type": "Feature", "properties": {"NAME": "A"}, "geometry": {"type": "Polygon", "coordinates": [square]}}, {"type": "Feature", "properties": {"NAME": " "}, "geometry": {"type": "MultiPolygon", "coordinates": [[square]]}}]
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    shapes = sources.read_geojson(spark, str(tmp_path / "g.json"))
    assert shapes.count() == 2 and payload.outline(shapes, drop_unnamed=True).count() == 1
    row = json.dumps({"item": {"value": "http://x/Q1"}, "sitelinks": {"value": "3.0"}, "population": {"value": "many"}})
    got = spark.createDataFrame([(row,)], "r string").select(sources.parse_binding(F.col("r")).alias("c")).first().c
    assert (got.qid, got.sitelinks, got.population, got.lat) == ("Q1", 3, None, 0.0)


def test_cache(spark):
    cache = spark.createDataFrame([("wd:search:v1:suez", [])], "key string, candidates array<string>")
    names = spark.createDataFrame([("Suez",), ("Aden",)], "name string")
    assert {r["name"]: r.candidates for r in sources.with_cache(names, cache, "wd", offline=False).collect()} == {"Suez": [], "Aden": None}
    with pytest.raises(Exception, match="not cached"):
        sources.with_cache(names, cache, "wd").collect()


def test_chapter_rules(spark):
    body = "word " * 500
    rows = spark.createDataFrame([(1, "ONE", body), (2, "two", body), (3, "THREE", "short")], "number int, title string, body string")
    got = {r.number: r.problems for r in validate.check_chapters(rows, 3).collect()}
    assert got == {1: [], 2: ["title is not in capitals"], 3: ["too short", "far from the median"], None: []}
    index = payload.index_document(rows).orderBy("number").first()
    assert (index.file, index.word_count, len(index.sha256)) == ("chapter_01.txt", 500, 64)
    assert one_prompt(spark, "text") == "1: text"
    with pytest.raises(Exception, match="prompt"):
        one_prompt(spark, " ")


def one_prompt(spark, text):
    return spark.range(1).select(K.render_prompt(F.lit("{{N}}: {{CHAPTER_TEXT}}"), F.lit(1), F.lit(text)).alias("p")).first().p


def test_report(spark):
    rows = [(1, "a[0].evidence", "exact", "q", 1.0, None), (1, "b", "near_miss", "they  went", 0.9, "they\nwent on"), (2, "c", "missing", "gone", 0.2, "x")]
    checks = spark.createDataFrame(rows, "number int, path string, kind string, quote string, ratio double, closest string")
    assert [(r.kind, r.n) for r in report.summary(checks).orderBy("ord").collect()] == [("exact", 1), ("normalised", 0), ("case_insensitive", 0), ("ellipsis", 0), ("near_miss", 1), ("missing", 1)]
    assert {r.number: (r.exact, r.missing) for r in report.per_chapter(checks).collect()} == {1: (1, 0), 2: (0, 1)}
    assert report.failing_ratios(checks).first().ratios == [0.2, 0.9]
    assert [report.count_blocking(checks, s).first().blocking for s in (False, True)] == [1, 2]
    assert {r.item for r in report.markdown_items(checks).collect()} == {"- **chapter 01** `b` near_miss: they went\n  closest (0.90): they went on", "- **chapter 02** `c` missing: gone"}
    doubts = spark.createDataFrame([("k", "Kholby", ["low confidence (0.30)"], "the\nend", 11)], "key string, name string, reasons array<string>, evidence string, chapter int")
    candidates = spark.createDataFrame([("k", 1, "A", "Q1"), ("k", 2, "B", "Q2")], "key string, rank int, label string, qid string")
    assert report.checklist_items(doubts, candidates).first().item == "- [ ] **Kholby**: low confidence (0.30)\n  > the end (chapter 11)\n  - or B (Q2)"
    legs = segment.parse_itinerary(spark.createDataFrame([(TABLE,)], "text string"))
    route = json.loads(report.route_document(segment.route_nodes(legs), legs).first().json)
    assert route["cumulative_days"] == [0, 7, 20, 23] and route["total_days"] == 23 and len(route["legs"]) == 3
    assert report.sniff_indent(report.render_json({"a": 1}, 4)) == 4


def test_every_rung_has_its_line(spark):
    text = "\n\nThe “first” line\nof the text, and\nthen a long third line that ends\nwith something else entirely"
    quotes = {"of the text": ("exact", 4, None), 'The "first" line of': ("normalised", 3, None), "“line of the text,”": ("normalised", 3, None), "AND THEN A LONG": ("case_insensitive", 4, "and then a long"),
              "first\" line of ... that ends with": ("ellipsis", 3, None), "then a lung third line that ends": ("near_miss", 5, "then a long third line that ends"), "": ("missing", None, None)}
    rows = spark.createDataFrame([(q, text) for q in quotes], "quote string, text string")
    got = {r.quote: (r.kind, r.line_no, r.closest) for r in evidence.check_quotes(rows).collect()}
    assert got == quotes


def test_quotes_without_a_text_take_all_rungs(spark):
    texts = spark.createDataFrame([(1, "He said “no” and went away.\nThe other one stayed"), (2, "nothing of it; The other one stayed. He said \"no\" and went away")], "doc_id long, text string")
    quotes = spark.createDataFrame([(1, "“said \"no\" and went”"), (2, "HE SAID \"NO\""), (3, "and went away ... other one stayed"), (4, "nothing of it"), (5, ""), (6, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in evidence.find_quotes(texts, quotes).collect()}
    assert got == {(1, 1): "normalised", (2, 1): "normalised", (1, 2): "case_insensitive", (2, 2): "case_insensitive", (1, 3): "ellipsis", (2, 4): "exact"}


def test_chapter_cards(spark):
    record = '{"chapter": 1, "title": "T", "summary_hover": "h", "summary_detail": "d", "transport": [{"mode": "train", "from": "a", "to": "b", "evidence": "e"}]}'
    records = extraction.load(spark.createDataFrame([(1, record)], "number int, text string")).filter("error is null")
    payload_rows = spark.createDataFrame([("suez", "Suez", None), ("aden", "Aden", "none_found")], "key string, name string, reason string")
    nodes = spark.createDataFrame([("suez",)], "key string")
    mentions = spark.createDataFrame([(1, 0, "“Suez”", "here"), (1, 1, "the Aden", "past"), (1, 2, "Nowhere", "unknown")], "chapter int, seq int, name string, class string")
    places = payload.chapter_places(mentions, payload_rows, nodes)
    series = spark.createDataFrame([("fogg", 1, 0, 0.0), ("fix", 1, None, None)], "track string, chapter int, leg int, along double")
    legs = spark.createDataFrame([(0, [10.0, 50.0], [30.0, 30.0])], "index int, start array<double>, end array<double>")
    pins = payload.track_pins(series, legs)
    people = spark.createDataFrame([(1, True, 0, "fogg", "Fogg", "Mr. Fogg", False), (1, True, 1, "fogg", "Fogg", "Fogg", False), (1, True, 2, "guide", "the guide", "the guide", True), (1, False, 3, "fix", "Fix", "Fix", False)], "chapter int, present boolean, seq int, person string, display string, name string, is_role boolean")
    (card,) = payload.chapters_payload(records, places, people, pins, "fogg").collect()
    assert (card.focus.lon, card.focus.lat, card.transport[0].mode) == (10.0, 50.0, "railway")
    assert [(p.key, p.plotted, p.on_route, p.reason) for p in card.places] == [("suez", True, True, None), ("aden", False, False, "none_found"), ("nowhere", False, False, None)]
    assert card.place_counts.by_class == {"here": 1, "past": 1, "unknown": 1} and card.place_counts.plotted == 1
    assert [(p.key, p.name, p.kind, p.also_printed) for p in card.present] == [("fogg", "Mr. Fogg", "person", ["Fogg"]), ("guide", "the guide", "role", [])]
    assert card.people_counts.asDict() == {"present": 2, "present_named": 1, "present_roles": 1, "named_elsewhere": 1}
    assert [(t.track, t.lon) for t in card.tracks] == [("fix", None), ("fogg", 10.0)]


def test_dropped_keys_leave_the_rest(spark):
    text = '{"chapter": 18, "colour": 1, "places_mentioned": [{"name_in_text": "Yokohama", "role": "mention", "evidence": "the boat"}, {"name_in_text": 5}], "time": {"x": null}, "money": "no struct"}'
    (r,) = spark.createDataFrame([(text,)], "t string").select(extraction.drop_unknown(F.col("t")).alias("d")).select("d.*").collect()
    assert r.dropped == ["places_mentioned[0].role", "time.x", "colour"]
    assert json.loads(r.json)["places_mentioned"] == [{"name_in_text": "Yokohama", "evidence": "the boat"}, {"name_in_text": 5}]


def test_sources_and_anchors(spark, tmp_path):
    book = sources.TextSource("book", 103, ("https://x/{number}.txt", "https://y/{number}-0.txt"), 1000, 37)
    assert book.urls() == ("https://x/103.txt", "https://y/103-0.txt") and book.path("/d/") == "/d/103.txt" and not book.is_whole(999)
    assert sources.LayerSource("land", "https://z/land").path("/d") == "/d/land.geojson"
    table = spark.createDataFrame([("suez", "node", 30.0, 32.5), ("club", "local", 1.0, 1.0), ("aden", "waypoint", None, 45.0), ("x", "unknown", 2.0, 2.0)], "key string, kind string, lat double, lon double")
    assert [tuple(r) for r in resolve.anchors(table).collect()] == [(30.0, 32.5)]
    keys = lambda df: sorted(r.key for r in df.collect())
    assert keys(resolve.wanted(table)) == ["aden", "suez", "x"] and keys(resolve.wanted(table, nodes_only=True)) == ["suez"] and keys(resolve.wanted(table, ["the Club"])) == ["club"]
    cache = sources.put_answers(spark.createDataFrame([], "key string, candidates array<string>"), spark.createDataFrame([("Suez", ["Q1"])], "name string, candidates array<string>"), "w")
    sources.write_cache(cache, str(tmp_path / "cache"))
    again = spark.read.schema("key string, candidates array<string>").json(str(tmp_path / "cache"))
    assert sources.with_cache(spark.createDataFrame([("“Suez”",)], "name string"), again, "w").first().candidates == ["Q1"]


def test_near_misses_over_a_corpus(spark):
    """All pairs of the smallest tables by brute force, and a quotation of each class with one place changed."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", F.regexp_replace("text", " th", " sh").alias("text"))
    columns = ["doc_id", "item_id", "kind", "ratio", "start", "end", "line_no", "closest"]
    got = evidence.find_near(docs, items).select(columns)
    pairs = docs.crossJoin(items.withColumnRenamed("text", "quote"))
    want = evidence.check_quotes(pairs.repartition(16)).filter("kind != 'missing'").select(columns)
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(map(tuple, want.collect())) and sum(r[2] == "near_miss" for r in rows) >= 1
    text = "Nobody on board the packet that day had ever seen the island from the north side before.\nIt lay low and grey under cloud."
    for n in (10, 14, 20, 30, 44, 60, 100):
        quote = text[3 : 3 + n].replace("\n", " ")
        quote = quote[: n - 2] + "#" + quote[n - 1 :]
        one = spark.createDataFrame([(1, "x" * 5 + text), (2, "nothing of that kind"), (3, None)], "doc_id int, text string")
        found = evidence.find_near(one, spark.createDataFrame([(7, quote), (8, None), (9, "short")], "item_id int, text string")).collect()
        assert [(r.doc_id, r.item_id, r.kind) for r in found] == [(1, 7, "near_miss")], (n, found)
        assert found[0].start <= 8 and 8 + n - 2 <= found[0].end


def test_lists_of_quotations(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three"), (2, "Three  four"), (3, None)], "doc_id int, text string")
    quotes = spark.createDataFrame([(1, "one two"), (2, "three"), (3, "four"), (4, None)], "item_id int, text string")
    want = sorted(map(tuple, evidence.find_quotes(docs, quotes).collect()))
    monkeypatch.setattr(evidence, "AUTOMATON_BYTES", 20)
    assert sorted(map(tuple, evidence.find_quotes(docs, quotes).collect())) == want == [(1, 1, "exact"), (1, 2, "exact"), (2, 2, "case_insensitive"), (2, 3, "exact")]
    assert evidence.find_quotes(docs, quotes.limit(0)).count() == 0 and evidence.find_near(docs, quotes.limit(0)).count() == 0


def test_quotations_come_in_small_batches(spark, monkeypatch):
    """However many rows a task has, Python gets few at once; ids over 2 ** 53 and null ids stay what they are."""
    monkeypatch.setattr(evidence, "BATCH_ROWS", 7)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        big = (1 << 53) + 1
        texts = spark.createDataFrame([(None, "all aboard the steamer")] + [(big + k, f"text {k}: all aboard the steamer") for k in range(40)], "doc_id long, text string")
        quotes = spark.createDataFrame([(1, "aboard the steamer"), (2, "nowhere at all")], "item_id int, text string")
        got = evidence.find_quotes(texts, quotes).collect()
        assert spark.conf.get(key) == "7"
        spark.conf.set(key, "10000")
        checks = evidence.check_quotes(texts.withColumn("quote", F.lit("Aboard the steamer")))
        assert spark.conf.get(key) == "7" and checks.filter("kind = 'case_insensitive'").count() == 41
    finally:
        spark.conf.set(key, old)
    assert sorted(r.doc_id or 0 for r in got) == [0] + [big + k for k in range(40)] and {(r.item_id, r.kind) for r in got} == {(1, "exact")}


def test_verdicts_are_counted_in_one_pass(spark):
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    found = spark.createDataFrame([("exact",), ("exact",), ("ellipsis",)], "kind string").mapInArrow(passed, "kind string")
    got = {r.kind: r.n for r in evidence.verdict_counts(found, 10).collect()}
    assert got == {"exact": 2, "normalised": 0, "case_insensitive": 0, "ellipsis": 1, "missing": 7} and seen.value == 3
