"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import io
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from waymark.llm import decontaminate, families, line_dedup, mixture, pii, quality, secrets, simhash, token_ids, topk, warc
from waymark.llm import queries as Q
from waymark.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id int, fp string, row string, size int, node int, score int"
LONG = "word " * 60_000


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, 1, "x", "y", 2, 3, 4) for i, t, s in rows], DOCS)


ODD = [(1, None, "a"), (2, "", None), (3, " \n\t ", "a"), (None, "lost a@b.cd", "b"), (4, "one", "b"), (4, "one", "b"), (5, LONG, "c"), (6, "é ß 漢字   x", None)]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, []).cache()


def test_simhash(odd, none):
    assert simhash.simhash_components(none).count() == 0 and simhash.near_dedup(none).count() == 0
    got = sorted(map(tuple, simhash.simhash_components(odd).collect()), key=str)
    prints = [brute.simhash(t) for _, t, _ in ODD]
    least = brute.components([i for i, _, _ in ODD], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    assert got == sorted([(d[0], f"{p:016x}", c) for d, p, c in zip(ODD, prints, least, strict=True)], key=str)
    kept = simhash.near_dedup(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 4, 4, 5, 6]


def test_near_copies(spark):
    base = [" ".join(f"w{d}x{i * (d + 3) % 97}" for i in range(300)) for d in range(3)]
    one_word, third = base[0].replace("w0x6 ", "new ", 1), " ".join(x if i % 3 else "y" for i, x in enumerate(base[1].split()))
    docs = frame(spark, [(7, base[0], "a"), (3, base[0].upper(), "a"), (9, one_word, "a"), (4, base[1], "a"), (5, third, "a"), (6, base[2], "a"), (8, base[2], "a")])
    assert sorted(r.doc_id for r in simhash.near_dedup(docs).collect()) == [3, 4, 5, 6]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=40, unique=True), st.lists(st.tuples(st.integers(0, 39), st.integers(0, 63), st.integers(0, 63)), max_size=20), st.integers(0, 3))
def test_trie_finds_all_pairs(base, flips, budget):
    values = set(base)
    for k, i, j in flips:
        if base:
            values.add(base[k % len(base)] ^ (1 << i) ^ (1 << j))
    a = np.array(sorted(values), np.uint64)
    i, j = simhash.trie_pairs(a, a, budget, same=True)
    want = {(x, y) for y in range(len(a)) for x in range(y) if (int(a[x]) ^ int(a[y])).bit_count() <= budget}
    assert Counter(zip(i.tolist(), j.tolist(), strict=True)) == Counter(want)


def test_trie_pairs_over_many_nodes(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 3000, dtype=np.int64)
    values = np.unique(np.concatenate([values, values[:300] ^ 5, values[:200] ^ (1 << 40)]))
    old, simhash.NODE_ROWS = simhash.NODE_ROWS, 64
    want_all = simhash.trie_pairs(np.sort(values.view(np.uint64)), np.sort(values.view(np.uint64)), 4, same=True)
    few, simhash.MOST_WALKED = simhash.MOST_WALKED, 16
    again = simhash.trie_pairs(np.sort(values.view(np.uint64)), np.sort(values.view(np.uint64)), 4, same=True)
    simhash.MOST_WALKED = few
    assert sorted(zip(*(x.tolist() for x in want_all), strict=True)) == sorted(zip(*(x.tolist() for x in again), strict=True))
    try:
        got = {tuple(sorted(r)) for r in simhash.hamming_pairs(spark.createDataFrame([(int(v),) for v in values], "fp long"), 2, spanning=False).collect()}
        links = simhash.hamming_pairs(spark.createDataFrame([(int(v),) for v in values], "fp long"), 2)
        reached = dict(map(tuple, connected_components(links).collect()))
    finally:
        simhash.NODE_ROWS = old
    bits = values.view(np.uint64)
    want = {tuple(sorted((int(values[i]), int(values[j])))) for i in range(len(bits)) for j in np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= 2) + i + 1}
    assert got == want
    ids = sorted({x for p in want for x in p})
    place = {x: k for k, x in enumerate(ids)}
    near = {(place[x], place[y]) for x, y in want}
    assert [reached[x] for x in ids] == brute.components(ids, lambda i, j: (j, i) in near)


def test_forest_reaches_what_links_reach():
    rng = np.random.default_rng(4)
    for n, m in ((30, 20), (200, 2000)):
        links, forest, kept = rng.integers(0, n, (m, 2)), families.Forest(n), []
        for part in np.array_split(links, 7):
            kept += part[forest.add(part[:, 0], part[:, 1], rng.integers(0, 3, len(part)))].tolist()
        both = {(i, j) for i, j in links.tolist()} | {(j, i) for i, j in links.tolist()}
        own = {(i, j) for i, j in kept} | {(j, i) for i, j in kept}
        assert len(kept) < n and brute.components(list(range(n)), lambda i, j: (i, j) in both) == brute.components(list(range(n)), lambda i, j: (i, j) in own) == forest.label.tolist()


def test_components(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    edges = [(i, i + 1) for i in range(1, 40)] + [(50, k) for k in range(51, 90)] + [(3, 3), (None, 4), (99, 98), (98, 99)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 1 for i in range(1, 41)} | {i: 50 for i in range(50, 90)} | {98: 98, 99: 98}


def test_pii(odd, none, spark):
    assert pii.find_pii(none).count() == 0
    got = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.found]) for r in pii.find_pii(odd).collect()), key=str)
    assert got == sorted([(i, [("email", 5, 11)] if i is None else []) for i, _, _ in ODD], key=str)
    tricky = [
        "a@b.c_d@e.f x@y z@w.v.", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (555) 010-9999 and +12", "é 漢 +44 20 7946 0958", "a" * 50_000, "0001.002.003.255",
        "1" * 3000 + " " + "1.1" * 500, "._%+-@a-b.c-d.-", "+1" + "(" * 2000,
    ]
    rows = frame(spark, [(i, t, "a") for i, t in enumerate(tricky)])
    for r in pii.find_pii(rows).collect():
        assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.base) == brute.pii(tricky[r.doc_id])


def test_pii_discovers_by_context(spark):
    seeds = [(i, f"bla bla call-me: +1 ({100 + i}) 555-0{100 + i} bla", "a") for i in range(8)]
    texts = [*seeds, (100, "bla call-me: (212) 555-0147 bla the 212 555 0147 9", "a"), (101, "the 5550147777 is a number of the order", "a")]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found] for r in pii.find_pii(frame(spark, texts)).collect()}
    assert got[100] == [("phone", 13, 27)] and got[101] == [] and all(len(got[i]) == 1 for i in range(8))


def test_secrets(odd, none, spark):
    assert secrets.scan_blobs(none)[0].count() == 0
    paths, new = secrets.scan_blobs(odd)
    assert sorted((r.path for r in paths.collect()), key=str) == sorted((i for i, _, _ in ODD), key=str)
    assert new.count() == len({t or "" for _, t, _ in ODD})
    tricky = ["API-KEY: abcdefghijkl", "api_key='abcdefghijkl' Secret:=x Token  =  \"short\"", "AKIA" + "B" * 13, "AKIAB" * 5, "f" * 15 + " " + "0" * 16 + "g", "paſſword=abcdefghijklm", "x" * 20_000 + "token:" + "a" * 5000]
    rows = frame(spark, [(i, t, "a") for i, t in enumerate(tricky)])
    for r in secrets.scan_blobs(rows)[0].collect():
        assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.found) == brute.secrets(tricky[r.path])


def test_mixture(odd, none, spark):
    assert mixture.mix(none).count() == 0 and mixture.mixed(none).count() == 0
    got = mixture.mix(odd).collect()
    assert len(got) == len(ODD) and all(0 <= r.taken <= 3 * r.size for r in got)
    assert {r.source_size for r in got} == {0, 4, 60_000, 5}
    even = frame(spark, [(i, "w " * 10, "a" if i % 2 else "b") for i in range(400)])
    taken = Counter()
    for r in mixture.mix(even).collect():
        taken[r.doc_id % 2] += r.taken
    want = brute.targets({"a": 2000, "b": 2000})
    assert abs(taken[1] - want["a"]) <= 5 and abs(taken[0] - want["b"]) <= 5
    mixed = mixture.mixed(even)
    assert mixed.columns == even.columns and 10 * mixed.count() == sum(taken.values())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), min_size=1, max_size=6), st.integers(0, 200))
def test_counts_come_nearest(kinds, budget):
    lengths, counts = np.array(sorted(kinds)), np.array([kinds[k] for k in sorted(kinds)])
    taken = mixture.fit_counts(lengths, counts, budget)
    assert ((taken >= 0) & (taken <= counts)).all()
    sums = {0}
    for n, c in kinds.items():
        sums = {s + k * n for s in sums for k in range(c + 1)}
    if budget <= 4 * lengths[-1] and budget < max(sums):
        assert abs(int((taken * lengths).sum()) - budget) == min(abs(s - budget) for s in sums)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(2**59, 2**64 - 1)), max_size=400))
def test_blocks(ids):
    words = token_ids.encode_block(np.array(ids, np.uint64))
    assert token_ids.decode_block(words, len(ids)).tolist() == ids


def test_runs_of_zeros():
    for ids in ([0] * 1000, [0] * 240 + [7], [1] * 61, [5] * 7 + [2**60 - 1] * 3 + [0] * 130):
        words = token_ids.encode_block(np.array(ids, np.uint64))
        assert token_ids.decode_block(words, len(ids)).tolist() == ids
    assert len(token_ids.encode_block(np.zeros(960, np.uint64))) == 4


PIECES = st.lists(st.sampled_from([*"abcZ019 .,'!\n\t\r\x1c\x85éß漢😀sdtrelvm", "\u00a0", "\u2009", "\u3000", "<|endoftext|>", "  ", "'ll", " \n "]), max_size=30).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=6))
def test_piece_table_is_the_tokenizer(texts):
    from tokenizers import Tokenizer

    own, plain = token_ids._tokenizer(Q.tokenizer_path()), Tokenizer.from_file(Q.tokenizer_path())
    want = [[*plain.encode(x, add_special_tokens=False).ids, 2] for x in texts]
    ids, lengths = own.encode(pa.array(texts), 2)
    assert lengths.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_piece_table_forgets_and_falls_back(monkeypatch):
    from tokenizers import Tokenizer, normalizers

    rng, plain = np.random.default_rng(6), Tokenizer.from_file(Q.tokenizer_path())
    texts = [" ".join(f"{x}{chr(10) * (x % 3 == 0)}x" for x in rng.integers(0, 10**6, 50).tolist()) for _ in range(40)] + ["", "a" * 10_000]
    want = [[*plain.encode(x, add_special_tokens=False).ids, 2] for x in texts]
    own = token_ids.PieceTable(Tokenizer.from_file(Q.tokenizer_path()))
    monkeypatch.setattr(token_ids, "MOST_PIECES", 100)
    monkeypatch.setattr(token_ids, "GATHERED", 7)
    for at in range(0, len(texts), 6):
        assert own.encode(pa.array(texts[at : at + 6]), 2)[0].tolist() == [i for x in want[at : at + 6] for i in x]
    assert len(own.known) < 1000
    plain.normalizer = normalizers.Lowercase()
    other = token_ids.PieceTable(plain)
    assert not other.cuts and other.encode(pa.array(["A B c", ""]), 2)[0].tolist() == [*plain.encode("a b c").ids, 2, 2]


def test_token_files(odd, none):
    assert token_ids.read_tokens(token_ids.write_tokens(none, Q.tokenizer_path())).count() == 0
    got = sorted(token_ids.read_tokens(token_ids.write_tokens(odd, Q.tokenizer_path())).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 4, 5, 6]
    assert [r.n_tokens for r in got[1:3]] == [1, 1] and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))
    out = io.BytesIO()
    file = token_ids.FileBuilder()
    file.add([7, None], np.array([20_000, 0]), np.arange(20_000, dtype=np.uint32))
    assert file.write(out)[0] == 20_000
    out.seek(0)
    assert [(d, s, len(x)) for d, s, x in token_ids.read_file(out)] == [(7, 0, 20_000), (None, 20_000, 0)]


def test_topk(spark):
    schema = "vec_id long, embedding array<float>, label int, id int, v int"
    assert topk.top_k(spark.createDataFrame([], schema), F.col("id") % 20 == 0).count() == 0
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 0, 0, 0) for i in range(200)]
    rows += [(300, None, 0, 0, 0), (301, [1.0, None], 0, 0, 0), (302, [float("nan")] * 8, 0, 0, 0), (303, [float("inf")] * 8, 0, 0, 0), (304, [2.0], 0, 0, 0), (305, [0.0] * 8, 0, 0, 0), (306, rows[5][1], 0, 0, 0), (307, [], 0, 0, 0), (None, rows[0][1], 0, 0, 0)]
    vectors = {i: [int(np.floor(64.0 * np.float64(np.float32(x)))) for x in v] + [0] * (8 - len(v)) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    got = {}
    for r in topk.top_k(spark.createDataFrame(rows, schema), F.col("id") % 20 == 0, k=7).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    for q, v in vectors.items():
        if q % 20 == 0:
            best = sorted((-int(np.dot(v, w)), i) for i, w in vectors.items() if i != q)[:7]
            assert got[q] == {k + 1: (i, -s) for k, (s, i) in enumerate(best)}
    big = [(0, [3e5, 1.0], 0, 0, 0), (1, [2e5, 5.0], 0, 0, 0), (2, [-7e5, 1.0], 0, 0, 0)]
    scores = {r.vec_id: r.score for r in topk.top_k(spark.createDataFrame(big, schema), F.col("id") == 0).collect()}
    assert scores == {1: 64 * 64 * (60_000_000_000 + 5), 2: 64 * 64 * (-210_000_000_000 + 1)}


def test_index_stops_only_on_proof():
    rng = np.random.default_rng(5)
    vectors = np.floor(rng.normal(size=(3000, 64)) * 8).astype(np.int64)
    vectors[:50] = vectors[50:100] + rng.integers(-1, 2, (50, 64))
    index = topk.ImpactIndex(np.arange(3000), vectors)
    got = index.search(np.arange(40), vectors[:40], 20)
    for q in range(40):
        best = sorted((-int(vectors[q] @ vectors[v]), v) for v in range(3000) if v != q)[:20]
        assert [(v, s) for own, v, s in got if own == q] == [(v, -s) for s, v in best]


def test_decontaminate(odd, none, spark):
    schema = "item_id long, text string, doc_id int"
    empty = spark.createDataFrame([], schema)
    assert decontaminate.contaminated(odd, empty).count() == 0 and decontaminate.decontaminate(odd, empty).count() == len(ODD)
    item = " ".join(f"w{i}" for i in range(40))
    items = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, "", 0), (4, "only two", 0), (5, item, 0)], schema)
    assert decontaminate.contaminated(none, items).count() == 0
    changed, far = item.replace("w20 ", "x "), " ".join(f"w{i}" if i % 8 else "x" for i in range(40))
    moved = item.replace("w20 ", "")
    docs = [(1, "a b c " + item.upper() + " d", "s"), (2, "z " * 500 + changed, "s"), (3, far, "s"), (4, "say ONLY\ntwo", "s"), (5, moved + " tail", "s"), (6, None, "s"), (7, " ".join(item.split()[:38]), "s")]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(frame(spark, docs), items).collect()}
    want = {}
    for i, t, _ in docs:
        for k, x in ((1, item), (4, "only two"), (5, item)):
            if s := brute.contaminated(t, x):
                want[i, k] = s
    assert got == pytest.approx(want) and (1, 1) in got and (3, 1) not in got
    left = decontaminate.decontaminate(frame(spark, docs), items)
    assert left.columns == frame(spark, docs).columns and {r.doc_id for r in left.collect()} == {i for i, _, _ in docs} - {i for i, _ in want}


def test_radius_finds_all_within():
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 2**63, 300, dtype=np.int64).view(np.uint64)
    index = decontaminate.HammingIndex(prints, 11)
    for p in prints[:20]:
        q = p ^ np.uint64(int("".join(rng.permutation(list("1" * 11 + "0" * 53))), 2))
        assert index.within(q).tolist() == np.flatnonzero(np.bitwise_count(prints ^ q) <= 11).tolist()


def test_lines(odd, none, spark):
    assert line_dedup.line_groups(none).count() == 0 and line_dedup.dedup_lines(none).count() == 0
    line = "the quick brown fox jumps over the lazy dog while seven wizards quietly juggle boxes of magic liquor jugs"
    near, other = line.replace("seven", "sevem"), "entirely different words that no other line of this small table has in it at all"
    docs = [(1, f"{line}\n{other}", "a"), (2, f"x\n\n {near}\t\n{line}", "a"), (3, None, "a"), (4, "x", "a"), (5, other[:40] + line[:40], "a")]
    got = {(r.doc_id, r.line_no): (r.component, r.keep) for r in line_dedup.line_groups(frame(spark, docs)).collect()}
    assert set(got) == {(1, 0), (2, 2), (2, 3), (2, 0), (4, 0)}
    assert [k for k, v in got.items() if v[1]] and {k for k, v in got.items() if v[1]} == {(1, 0), (2, 0)}
    assert got[1, 0][0] == got[2, 2][0] == got[2, 3][0] != got[2, 0][0]
    clean = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, docs)).collect()}
    assert clean == {1: f"{line}\n{other}", 2: "x\n", 3: None, 4: "", 5: other[:40] + line[:40]}
    assert line_dedup.line_groups(odd).count() == 2


def test_quality(odd, none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    blank = quality.train(odd, labels)
    assert [r.score for r in quality.score(odd, blank).collect()] == [0.5] * len(ODD)
    assert quality.score(none, blank).count() == 0
    rows = [(i, ("good sound words of prose. " if i % 2 else "### $$$ !!! ") * (1 + i % 7), "a") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None), (999, 0)], "doc_id long, quality int")
    forest = quality.train(frame(spark, rows), labels)
    assert all((r.score >= 0.5) == bool(r.doc_id % 2) for r in quality.score(frame(spark, rows), forest, score_col="score").collect())
    assert all(0 <= r.score <= 1 for r in quality.score(odd, forest).collect())


def test_warc(spark):
    schema = "page_id long, url string, html string, id int, date int"
    assert warc.read_archives(warc.convert(spark.createDataFrame([], schema))).count() == 0
    pages = [(1, "http://a/ b", "same"), (2, None, "same"), (9, "", "same"), (3, "u", None), (4, "u", ""), (5, "u", "é\r\n\r\nWARC/1.1\r\n"), (6, "u", "x" * 300_000), (9, "", "same")]
    frame = spark.createDataFrame([(*p, 0, 0) for p in pages], schema)
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(warc.convert(frame)).collect())
    assert got == sorted(brute.warc([(p, h) for p, _, h in pages]))
    assert {r.record_type for r in warc.read_archives(warc.convert(frame, least=5)).collect()} == {"response"}


def test_arc():
    header = {"URL": "http://x/a b", "IP-address": "1.2.3.4", "Archive-date": "19970203040506", "Content-type": "text/html", "Result-code": "404"}
    for version in (1, 2):
        raw = b"".join(warc.arc_bytes([(header, b"one\n\ntwo"), (header, b"")], version))
        records = list(warc.parse_arc(io.BytesIO(raw)))
        assert [r.body for r in records] == [b"one\n\ntwo", b""] and records[0].header["URL"] == "http://x/a b"
        (h, http, payload), = warc.read_warc(io.BytesIO(warc.warc_record(records[0])))
        assert payload == b"one\n\ntwo" and h["WARC-Date"] == "1997-02-03T04:05:06Z" and h["WARC-Payload-Digest"] == "sha1:" + brute.digest(payload)
        assert (b"404" in http) == (version == 2)
        with pytest.raises(ValueError, match="declared"):
            list(warc.parse_arc(io.BytesIO(raw[: raw.index(b"two")])))
    with pytest.raises(ValueError, match="filedesc"):
        list(warc.parse_arc(io.BytesIO(b"x")))
    assert warc.iso_date("1997") == "1997-01-01T00:00:00Z"


def test_pipeline(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs, columns = spark.read.parquet(f"{sf}/documents.parquet"), None
    total = docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        columns = columns or docs.columns
        if k < 4:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k == 0:
            assert 0.5 * total < docs.count() < total
        if k == 1:
            kept = [r.text for r in docs.collect()]
            assert len(set(kept)) == len(kept)
    whole = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.collect()))
