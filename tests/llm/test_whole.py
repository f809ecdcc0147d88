"""Cases in which a part of the job would be enough for the usual tables: the whole of it is held against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from waymark.llm import decontaminate, families, line_dedup, mixture, pii, simhash

DOCS = "doc_id long, text string, source string"


def varied(rng, words, changes):
    out = list(words)
    for k in rng.sample(range(len(out)), changes):
        out[k] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def characters(line, size=8):
    return {line[i : i + size] for i in range(len(line) - size + 1)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_lines_of_one_template(spark, monkeypatch):
    rng = random.Random(7)
    words = [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.choice('klmnprst')}{k}" for k in range(60)]
    lines = [varied(rng, words, rng.randint(2, 4)) for _ in range(150)]
    sets = [characters(x) for x in lines]
    want = brute.components(list(range(len(lines))), lambda i, j: jaccard(sets[i], sets[j]) >= 0.8)
    docs = spark.createDataFrame([(i, x, "a") for i, x in enumerate(lines)], DOCS)
    monkeypatch.setattr(families, "CELL", 16)
    group = {r.doc_id: r.component for r in line_dedup.line_groups(docs).collect()}
    first = {}
    got = [first.setdefault(group.get(i, i), i) for i in range(len(lines))]
    assert got == want and 1 < len(set(want)) < len(lines)


def test_similar_lines_meet_in_a_band(spark):
    rng, pairs = random.Random(3), []
    while len(pairs) < 1500:
        words = [f"{rng.randrange(36**5):x}{'q' * rng.randint(1, 5)}" for _ in range(rng.choice([12, 14, 16, 20, 23, 32, 45, 60]))]
        x, y = " ".join(words), varied(rng, words, max(1, len(words) // 16))
        if len(pairs) % 3 == 0:  # the same line with other marks for some of its spaces: fewer words by white space
            y = "".join(("-" if rng.random() < 0.3 else " ") + w for w in words)[1:]
        if 0.8 <= jaccard(characters(x), characters(y)) < 0.87:
            pairs.append((x, y))
    keys = lambda c: line_dedup.bands(F.col(c))
    meet = spark.createDataFrame(pairs, "x string, y string").select(F.size(F.split("x", " ")).alias("n"), F.arrays_overlap(keys("x"), keys("y")).alias("ok"))
    lost = meet.filter("not ok").groupBy("n").count().collect()
    assert sum(r["count"] for r in lost) <= 15, lost


def kept_of_copies(texts, radius, print_words, prints):
    """The smallest place of every group of texts with a similarity of 0.8 or more, within families that a print has near."""
    sets, fps = [simhash.shingle_set(x, 5) for x in texts], [simhash.fingerprints_of(x, print_words, prints) for x in texts]
    far = lambda i, j, k: (fps[i][k % prints] ^ fps[j][k % prints]).bit_count()
    near = lambda i, j: any(far(i, j, k) <= radius and far(i, j, k + 1) <= 23 and far(i, j, k + 2) <= 23 for k in range(prints))
    family = brute.components(list(range(len(texts))), near)
    return sorted(set(brute.components(list(range(len(texts))), lambda i, j: family[i] == family[j] and jaccard(sets[i], sets[j]) >= 0.8)))


def test_near_copies_verify_all_candidates(spark, monkeypatch):
    monkeypatch.setattr(families, "CELL", 64)
    rng = random.Random(5)
    words = [f"w{rng.randrange(3000)}" for _ in range(400)]
    texts = [varied(rng, words, rng.randint(4, 7)) for _ in range(200)]
    docs = spark.createDataFrame([(i, x, "a") for i, x in enumerate(texts)], DOCS)
    want = kept_of_copies(texts, 4, 3, 5)
    assert sorted(r.doc_id for r in simhash.near_dedup(docs, radius=4, prints=5, print_words=3).collect()) == want and 1 <= len(want) < 150


def test_near_copies_just_similar_enough(spark):
    rng, texts, pairs = random.Random(11), [], 40
    for k in range(pairs):
        words = [f"w{rng.randrange(4000)}" for _ in range((60, 150, 400, 1000)[k % 4])]
        other, changed = words, list(words)
        while jaccard(simhash.shingle_set(" ".join(words), 5), simhash.shingle_set(" ".join(changed), 5)) >= 0.8:
            other, changed = changed, list(changed)
            changed[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts += [" ".join(words), " ".join(other)]
    docs = spark.createDataFrame([(i, x, "a") for i, x in enumerate(texts)], DOCS)
    assert sorted(r.doc_id for r in simhash.near_dedup(docs).collect()) == list(range(0, 2 * pairs, 2))


def test_cues_of_later_rounds(spark):
    local = [f"(212) 555-01{40 + i}" for i in range(5)]
    texts = [f"bla phone: +1 ({300 + i}) 555-0{100 + i} bla" for i in range(8)] + [f"bla phone: {x} bla" for x in local[:4]] + [f"bla cell: {x} bla" for x in local]
    docs = spark.createDataFrame([(i, x, "a") for i, x in enumerate(texts)], DOCS)
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found] for r in pii.find_pii(docs).collect()}
    assert found[16] == [("phone", 10, 24)] and all(len(x) == 1 for x in found.values())


def test_reordered_items():
    rng, filler = random.Random(2), [f"z{i}" for i in range(300)]
    for size in (30, 100):
        words = [f"w{i}" for i in range(size)]
        item = " ".join(words)
        own = decontaminate.Benchmark(((1, item),))
        for _ in range(12):
            a, b = sorted(rng.sample(range(size + 1), 2))
            for mixed in (words[a:] + words[:a], words[:a] + words[b:] + words[a:b], words[b:] + words[a:b] + words[:a]):
                doc = " ".join(filler[:150] + mixed + filler[150:])
                assert [h["similarity"] for h in own.hits(doc)] == pytest.approx([x for x in [brute.contaminated(doc, item)] if x])


def test_one_more_of_very_long_texts():
    for scale in (1_000_000, 1_000):
        assert mixture.fit_counts(np.array([scale]), np.array([3]), 1900 * scale // 1000).tolist() == [2]
        assert mixture.fit_counts(np.array([scale]), np.array([3]), 1400 * scale // 1000).tolist() == [1]
