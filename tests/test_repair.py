"""The automaton that mends nearly JSON text."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymark.operators import extraction
from waymark.operators import repair as R

SHIP = 'IN WHICH THE "MERMAID" SAILS, AND "THE GULL" DOES NOT'
CASES = [
    ('{\n"a": 21,\n"title": "' + SHIP + '",\n"next": "ok"\n}', {"a": 21, "title": SHIP, "next": "ok"}, ["escape"] * 4),
    ('{"e": "they came out... "Where?" asked the \u201cother\u201d one"\n}', {"e": 'they came out... "Where?" asked the \u201cother\u201d one'}, ["escape"] * 2),
    ('{"title": "He said "no" to all"}', {"title": 'He said "no" to all'}, ["escape"] * 2),
    ('{"a": "He said "no", then left", "b": "c"}', {"a": 'He said "no", then left', "b": "c"}, ["escape"] * 2),
    ('{"a": ["one "two" three", "x"]}', {"a": ['one "two" three', "x"]}, ["escape"] * 2),
    ('{"a": [1, 2,], "b": {"c": True,}}', {"a": [1, 2], "b": {"c": True}}, ["comma", "value", "comma"]),
    ('{"a": "x" "b": 2 "c": 3}', {"a": "x", "b": 2, "c": 3}, ["comma", "comma"]),
    ('{"a": ["p"\n"q"', {"a": ["p", "q"]}, ["comma", "end"]),
    ("{a: 'it', \u201cb\u201d: \u201cc\u201d}", {"a": "it", "b": "c"}, ["quote"] * 4),
    ('sure:\n```json\n{"a": "b", // so\n "d": }\n```', {"a": "b", "d": None}, ["comment", "value"]),
    ('{"a": {"b": [1, {"c": 2}', {"a": {"b": [1, {"c": 2}]}}, ["end"]),
    ('{"a": [1, 2}', {"a": [1, 2]}, ["bracket"]),
    ('{"a": 1]}', {"a": 1}, ["drop"]),
    ('{"a": "line\none"}', {"a": "line\none"}, ["control"]),
    ('{"a": "\\q \\" \\u00e9"}', {"a": '\\q " \u00e9'}, ["escape"]),
    ('{"a": "cut off he', {"a": "cut off he"}, ["end", "end"]),
    ('{"a": 1,, "b": NaNo}', {"a": 1, "b": "NaNo"}, ["drop", "quote"]),
    ('{"a": 1} and {"b": 2}', {"a": 1}, []),
    ("no object", None, []), ("{}", None, []), ("", None, []), (None, None, []), ("{", None, []),
]


@pytest.mark.parametrize(("text", "want", "edits"), CASES)
def test_cases(text, want, edits):
    got, made = R.repair_text(text)
    assert (got and json.loads(got)) == want
    assert [e for _, e in made] == edits and all(0 <= at <= len(text) for at, _ in made)
    if got:  # once mended, nothing is left to mend
        assert R.repair_text(got) == (got, [])


VALUES = st.recursive(st.none() | st.booleans() | st.integers(-999, 999) | st.text(max_size=9), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=5), x, max_size=3), max_leaves=8)
OBJECTS = st.dictionaries(st.text(max_size=5), VALUES, min_size=1, max_size=4)


@settings(max_examples=200, deadline=None)
@given(OBJECTS, st.sampled_from([None, 1]), st.booleans())
def test_good_objects_stay(value, indent, plain):
    text = json.dumps(value, indent=indent, ensure_ascii=plain)
    assert R.repair_text(f"Well: {text}") == (text, [])


@settings(max_examples=300, deadline=None)
@given(OBJECTS, st.data())
def test_cut_objects_are_closed(value, data):
    """A cut end loses no whole value before it, and anything at all is either an object or null."""
    text = json.dumps({"first": "kept whole", **{k + "x": v for k, v in value.items()}})
    cut = text[: data.draw(st.integers(len('{"first": "kept whole",'), len(text)))]
    got, _ = R.repair_text(cut)
    assert json.loads(got)["first"] == "kept whole"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(['"', "'", "{", "}", "[", "]", ",", ":", "a", " ", "\n", "\\", "1", "//", "/*", "\u201c", "\u201d", "true", "```"]), max_size=30).map("".join))
def test_never_fails(text):
    got, edits = R.repair_text("{" + text)
    assert got is None or isinstance(json.loads(got), dict)
    assert got or not edits


def test_column(spark):
    rows = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(CASES)], "k int, t string")
    got = {r.k: r.r for r in rows.select("k", R.repaired(F.col("t")).alias("r")).collect()}
    for k, (_, want, edits) in enumerate(CASES):
        assert (got[k].json and json.loads(got[k].json)) == want and [e.edit for e in got[k].edits] == edits
    loaded = extraction.load(spark.createDataFrame([(1, '{"chapter": 1, "title": "A "B" C"}')], "number int, text string"), repair_broken=True).first()
    assert loaded.error is None
