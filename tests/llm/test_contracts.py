"""The queries over the smallest test tables against the plain versions."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.llm import brute
from waymark.llm import queries as Q
from waymark.llm import secrets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_warc(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in Q.op1_warc(spark, SF).collect()]
    assert sorted(got) == sorted(brute.warc(pages))


def test_pii(spark, docs):
    got = rows(Q.op2_pii(spark, SF))
    assert len(got) == len(docs)
    for d in docs:
        want, r = brute.pii(d["text"]), got[d["doc_id"]]
        assert r.base_sha256 == brute.sha(want)
        assert set(want.split(",")) - {""} <= set(r.spans.split(","))
        assert [r[f"n_{k}"] for k in brute.PII] == [sum(s.startswith(k + ":") for s in want.split(",")) for k in brute.PII]


def test_secrets(spark, docs):
    got = rows(Q.op5_secrets(spark, SF))
    assert len(got) == len(docs)
    for d in docs:
        want, r = brute.secrets(d["text"]), got[d["doc_id"]]
        assert (r.spans, r.base_sha256) == (want, brute.sha(want))


def test_topk(spark):
    e = {r.vec_id: [int(np.floor(64.0 * float(x))) for x in r.embedding] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    got = defaultdict(list)
    for r in sorted(Q.op3_topk(spark, SF).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    want = {}
    for q in e:
        if q % 20 == 0:
            best = sorted((-int(np.dot(e[q], e[v])), v) for v in e if v != q)[:20]
            want[q] = [(k + 1, v, -s) for k, (s, v) in enumerate(best)]
    assert dict(got) == want


def test_token_ids(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(Q.tokenizer_path())
    got, at = rows(Q.op4_token_ids(spark, SF)), 0
    assert len(got) == len(docs)
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        ids = [*t.encode(d["text"] or "", add_special_tokens=False).ids, 2]
        r = got[d["doc_id"]]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), brute.crc(ids))
        at += len(ids)


def test_decontaminate(spark, docs):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.similarity for r in Q.op6_decontaminate(spark, SF).collect()}
    want = {}
    for d in docs:
        have = set(brute.words(d["text"]))
        for i, t in items.items():
            if len(have & set(brute.words(t))) > 2 and (s := brute.contaminated(d["text"], t)):
                want[d["doc_id"], i] = s
    assert got == pytest.approx(want)


def test_mixture(spark, docs):
    size = {d["doc_id"]: len(brute.WORD.findall(d["text"] or "")) for d in docs}
    by = defaultdict(int)
    for d in docs:
        by[d["source"]] += size[d["doc_id"]]
    want, taken = brute.targets(by), defaultdict(int)
    got = rows(Q.op7_mixture(spark, SF))
    assert len(got) == len(docs)
    for d in docs:
        r = got[d["doc_id"]]
        assert (r["size"], r.source_size) == (size[d["doc_id"]], by[d["source"]])
        assert r.target == pytest.approx(want[d["source"]])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[d["source"]] += r.taken
    for s, t in want.items():
        passes, sums = int(t // by[s]), {0}
        for d in docs:
            if d["source"] == s:
                sums |= {x + size[d["doc_id"]] for x in sums}
        best = min(abs(passes * by[s] + x - round(t)) for x in sums)
        assert abs(taken[s] - round(t)) <= max(best, 0.001 * t)
    assert rows(Q.op7_mixture(spark, SF)) == got


def test_simhash(spark, docs):
    prints = [brute.simhash(d["text"]) for d in docs]
    least = brute.components([d["doc_id"] for d in docs], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    got = rows(Q.op9_simhash(spark, SF))
    assert {k: (r.fingerprint, r.component_id) for k, r in got.items()} == {d["doc_id"]: (f"{p:016x}", c) for d, p, c in zip(docs, prints, least, strict=True)}


def test_quality(spark, docs):
    got = rows(Q.op10_quality(spark, "/root/testdata/sf0.01"))
    label = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(got) == 1000
    held = [r for k, r in got.items() if k in label and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.95 * len(held)


def test_ledger_scans_only_unseen_pairs(spark):
    first = spark.createDataFrame([(1, "token = abcdefabcdef0123"), (2, None), (3, "token = abcdefabcdef0123")], "doc_id long, text string")
    _, new = secrets.scan_blobs(first)
    ledger = secrets.append_ledger(new)
    assert new.count() == 2
    more = first.union(spark.createDataFrame([(4, "AKIA" + "A" * 16)], first.schema))
    paths, new = secrets.scan_blobs(more, ledger=ledger)
    assert [len(r.found) for r in new.collect()] == [1]
    assert {r.path: [s.kind for s in r.found] for r in paths.collect()} == {1: ["assign", "hex"], 2: [], 3: ["assign", "hex"], 4: ["access"]}
    other = secrets.RuleSet("base-2", secrets.BASE.rules[1:])
    assert secrets.scan_blobs(more, other, ledger)[1].count() == 3
