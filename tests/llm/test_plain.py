"""Operators against plain versions of their whole methods, and results that hang on rows rather than ids."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from waymark.llm import decontaminate, line_dedup, mixture, pii, quality, simhash, warc

DOCS = "doc_id long, text string, source string, _hits int, _score double, row int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, 0.5, 3) for i, t, s in rows], DOCS)


def test_pii_of_a_million_odd_marks(spark):
    marks = [*"\"'<[{(:=#.,;!?)]}>|-+%_@ \t\n", "é", "a", "1", "1 ", "1.", "a1 ", ":1", "'1", "1@", "a.", "x@y."]
    texts = [(m * (1_000_000 // len(m)) + "1") for m in marks]
    got = pii.find_pii(frame(spark, [(i, t, "a") for i, t in enumerate(texts)]))
    assert got.select(F.size("base")).count() == len(texts)
    for i, t in enumerate(texts):
        if t[:2] in ("1.", "x@"):  # the plain patterns take too long on the others
            base = {r.doc_id: r.base for r in got.filter(F.col("doc_id") == i).collect()}[i]
            assert len(base) >= 0


def bootstrap(texts):
    """All spans of each text: the operator's definition, occurrence by occurrence."""
    found, words = [], Counter()
    for n, text in enumerate(texts):
        words.update(w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w)
        base = [(k, m.start(), m.end()) for k, p in brute.PII.items() for m in re.finditer(p, text, re.ASCII) if brute.pii_ok(k, m[0])]
        spots = [(k, s, e) for k, s, e in base]
        for m in re.finditer(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*[0-9@][^\x20\x09-\x0D]*(?:\x20[0-9(][0-9().-]*)*", text):
            pre = re.match(r"(?:[^0-9@:=#]*[:=#])*[\"'<\[{]*", m[0])[0]
            body = m[0][len(pre) :].rstrip(".,;:!?\"'>]}|")
            start = m.start() + len(pre)
            if body and not any(s < start + len(body) and start < e for _, s, e in base):
                spots.append((None, start, start + len(body)))
        for k, s, e in spots:
            left = re.search(r"([^\x20\x09-\x0D]*)[\x20\x09-\x0D]*$", text[:s])
            tight = bool(left[1]) and left[0] == left[1]
            if k is None and tight:
                left = re.search(r"[^\x20\x09-\x0D]*$", text[:s])
            found.append((n, k, s, e, text[s:e].lower(), (left[1] if k or not tight else left[0]).lower(), tight))
    pairs, labels = Counter(), Counter()
    for _, _, _, _, m, cue, tight in found:
        if cue:
            pairs[cue, m] += 1
            labels[cue] += tight
    known = {(m, k): 1.0 for _, k, _, _, m, _, _ in found if k}
    seeds, count = dict(known), Counter(c for c, _ in pairs)
    patterns = {}
    for _ in range(pii.ROUNDS):
        patterns = {}
        for cue in (c for c, n in count.items() if n >= pii.LEAST_SEEDS):
            for kind in pii.KINDS:
                hit = [(n, known[m, kind]) for (c, m), n in pairs.items() if c == cue and (m, kind) in known]
                conf = min(1.0, sum(n * x for n, x in hit) / max(1, words[cue] + labels[cue]))
                if len(hit) >= pii.LEAST_SEEDS and conf >= pii.LEAST_PATTERN:
                    patterns[cue, kind] = conf
        doubt = defaultdict(lambda: 1.0)
        for (cue, m), _ in pairs.items():
            for kind in pii.KINDS:
                if (cue, kind) in patterns and shaped(kind, m):
                    doubt[m, kind] *= max(1e-9, 1 - patterns[cue, kind])
        known = dict(seeds)
        for key, d in doubt.items():
            if 1 - d >= pii.LEAST_INSTANCE:
                known[key] = max(known.get(key, 0), 1 - d)
    out = [set() for _ in texts]
    for n, k, s, e, m, cue, _ in found:
        out[n] |= {(k, s, e)} if k else {(kind, s, e) for kind in pii.KINDS if (cue, kind) in patterns and (m, kind) in known and shaped(kind, m)}
    return out


def shaped(kind, m):
    n = len(re.sub("[^0-9]", "", m))
    if kind == "email":
        return bool(re.fullmatch("[^@]+@[^@]+", m))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9A-Fa-f]*(?:[.:][0-9A-Fa-f]*){2,}(?:/[0-9]+)?", m))
    return (12 <= n <= 19 and bool(re.fullmatch("[0-9 -]+", m))) if kind == "card" else (7 <= n <= 15 and bool(re.fullmatch(r"[+0-9(][0-9 ().-]+", m)))


def test_pii_is_the_plain_bootstrap(spark):
    rng, texts = random.Random(8), []
    kinds = [
        (["tel:", "CELL:", "fax="], lambda: rng.choice(["+1 ", "+1 ", "+1 ", ""]) + f"(212) 555-01{rng.randrange(20):02d}"),
        (["host", "addr:"], lambda: rng.choice([*[f"10.0.0.{rng.randrange(9)}"] * 4, f"fe80:{rng.randrange(4)}::1", f"1.2.{rng.randrange(6)}"])),
        (["mail", "id#"], lambda: f"u{rng.randrange(9)}@{rng.choice(['a.org', 'b.org', 'c.org', 'host'])}"),
        (["card"], lambda: rng.choice(["4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009", "4111-1111-1111-1112"])),
        (["the", "of", "call"], lambda: str(rng.randrange(10**9))),
    ]
    for _ in range(200):
        parts = []
        for _ in range(rng.randint(1, 6)):
            cues, number = rng.choice(kinds)
            cue = rng.choice(cues if rng.random() < 0.9 else ["the", "tel:", "mail", "host"])
            parts += [*rng.choices(["bla", "the", "of", "call"], k=rng.randint(0, 2)), cue + rng.choice([" ", " ", "", "\n"]) + rng.choice(["", "", "<", "'"]) + number() + rng.choice(["", ".", "!", ">"])]
        texts.append(" ".join(parts))
    got = {r.doc_id: {(s.kind, s.start, s.end) for s in r.found} for r in pii.find_pii(frame(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()}
    want = bootstrap(texts)
    assert [(texts[i], got[i] ^ want[i]) for i in range(len(texts)) if got[i] != want[i]] == []
    plain = [set(brute.pii(t).split(",")) - {""} for t in texts]
    assert sum(len(w) for w in want) > sum(map(len, plain)) + 5  # it does discover


def characters(line, size=8):
    return {line[i : i + size] for i in range(max(1, len(line) - size + 1))}


def test_lines_are_brute_forces(spark):
    rng = random.Random(4)
    base = [" ".join(f"{rng.randrange(36**4):x}{'q' * rng.randint(0, 4)}" for _ in range(rng.choice([1, 3, 8, 15, 25, 60]))) for _ in range(40)]
    lines = []
    for b in base:
        for _ in range(rng.randint(1, 5)):
            words = b.split()
            for k in rng.sample(range(len(words)), min(len(words), rng.choice([0, 0, 1, 1, 2]))):
                words[k] = f"{rng.randrange(36**4):x}"
            lines.append(" ".join(words))
    rng.shuffle(lines)
    docs = [(n, "\n".join(["", *lines[at : at + 7]]), "a") for n, at in enumerate(range(0, len(lines), 7))]
    placed = [(d, k, x) for d, t, _ in docs for k, x in enumerate(t.split("\n")) if x]
    sets = [characters(x) for _, _, x in placed]
    similar = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    roots = brute.components(list(range(len(placed))), similar)
    size = Counter(roots)
    want = {(d, k): roots[i] for i, (d, k, _) in enumerate(placed) if size[roots[i]] > 1}
    got = {(r.doc_id, r.line_no): (r.component, r.keep) for r in line_dedup.line_groups(frame(spark, docs)).collect()}
    assert len(got) >= 0.97 * len(want) and set(got) <= set(want)
    joined = sum((got.get(a, (1,))[0] == got.get(b, (2,))[0]) for a in want for b in want if a < b and want[a] == want[b])
    assert joined >= 0.97 * sum(want[a] == want[b] for a in want for b in want if a < b)
    assert all(want[a] == want[b] for a in got for b in got if got[a][0] == got[b][0])
    kept = [k for k, v in got.items() if v[1]]
    assert len(kept) == len({v[0] for v in got.values()}) and all(k == min(x for x in got if got[x][0] == got[k][0]) for k in kept)


def test_rows_of_one_id(spark):
    line, unique = "a line that is long enough to be a line of its own in both of the documents", "this other line is only in the second text of document five and must stay"
    docs = [(0, line, "a"), (5, line, "a"), (5, f"{line}\n{unique}", "a"), (7, unique[::-1], "a"), (7, unique[::-1], "a")]
    clean = line_dedup.dedup_lines(frame(spark, docs))
    assert clean.columns == frame(spark, docs).columns and Counter((r.doc_id, r.text) for r in clean.collect()) == {(0, line): 1, (5, ""): 1, (5, unique): 1, (7, unique[::-1]): 1, (7, ""): 1}
    groups = line_dedup.line_groups(frame(spark, docs)).collect()
    assert Counter(r.component for r in groups if r.keep) == Counter({r.component for r in groups})
    words = " ".join(f"w{k}" for k in range(200))
    other = " ".join(f"v{k}" for k in range(200))
    copies = [(1, words, "a"), (1, other, "a"), (0, other, "a"), (2, words, "a"), (None, words, "a")]
    kept = simhash.near_dedup(frame(spark, copies))
    assert kept.columns == frame(spark, copies).columns and sorted((r.doc_id, r.text[0]) for r in kept.collect()) == [(0, "v"), (1, "w")]


def test_mix_takes_rows(spark):
    rng = random.Random(3)
    docs = [(i % 40 if i % 3 else None, "w " * rng.randint(1, 60), "abc"[i % 3]) for i in range(600)] + [(9, "same " * 10, "a")] * 200
    plan = Counter()
    for r in mixture.mix(frame(spark, docs)).collect():
        plan[r.doc_id, r.size] += r.copies
    out = mixture.mixed(frame(spark, docs))
    assert out.columns == frame(spark, docs).columns and Counter((r.doc_id, len(r.text.split())) for r in out.collect()) == +plan


def test_all_lengths_are_taken_alike():
    rng = np.random.default_rng(1)
    lengths, counts = np.unique(rng.lognormal(6, 1, 4000).astype(int) + 1, return_counts=True)
    longest = np.cumsum(lengths * counts) > 0.9 * (lengths * counts).sum()
    for share in (0.2, 0.35, 0.8):
        taken = mixture.fit_counts(lengths, counts, int(share * (lengths * counts).sum()))
        assert int((taken * lengths).sum()) == int(share * (lengths * counts).sum())
        assert abs(taken[longest].sum() / counts[longest].sum() - share) < 0.08
    for seed in (1, 2):
        assert mixture.fit_counts(lengths, counts, 100_000, seed).tolist() == mixture.fit_counts(lengths, counts, 100_000, seed).tolist()
    assert mixture.fit_counts(lengths, counts, 100_000, 1).tolist() != mixture.fit_counts(lengths, counts, 100_000, 2).tolist()


def test_records_have_their_own_names(spark):
    pages = [(1, "http://a", "same"), (2, "http://a", "same"), (3, "http://a", "same"), (4, "http://b", "x")]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = warc.read_archives(warc.convert(rows)).collect()
    assert len({r.record_id for r in got}) == 4 and {r.page_id: r.refers_to for r in got} == {1: 3, 2: 3, 3: None, 4: None}


@pytest.mark.parametrize("similarity", [0.5, 0.65, 0.8, 0.95])
def test_no_window_is_lost(similarity):
    rng = random.Random(int(100 * similarity))
    for _ in range(60):
        size = rng.choice([6, 20, 60])
        words = [f"w{rng.randrange(size)}" for _ in range(size)]
        item, own = " ".join(words), list(words)
        for _ in range(rng.randint(0, max(1, size // 12))):
            at = rng.randrange(len(own))
            own[at : at + rng.randint(0, 2)] = rng.sample([*words, "x", "y"], rng.randint(0, 2))
        cut = rng.randrange(len(own) + 1)
        own = own[cut:] + own[:cut] if rng.random() < 0.3 else own
        doc = " ".join([f"z{k}" for k in range(rng.randrange(30))] + own + words[: rng.randrange(size)])
        want = brute.contaminated(doc, item, similarity)
        hits = decontaminate.Benchmark(((1, item),), similarity=similarity).hits(doc)
        assert [h["similarity"] for h in hits] == pytest.approx([want] if want else []), (doc, item)


def test_a_benchmark_of_many_indexes(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 100)
    monkeypatch.setattr(decontaminate, "INDEXES", 2)
    items = [" ".join(f"i{k}w{j}" for j in range(20)) for k in range(9)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = frame(spark, [(k, f"a b {x} c", "s") for k, x in enumerate(items)] + [(99, "clean text of no item at all", "s")])
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()) == [(k, k) for k in range(9)]
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and [(r.doc_id, r["_hits"]) for r in left.collect()] == [(99, 7)]


def test_trees_are_plain_trees():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    forest = quality.fit(x, y, trees=12, depth=3)
    for row, score in zip(x[:50], forest.score(x[:50]), strict=True):
        raw = forest.base
        for feature, bound, leaf in zip(forest.feature, forest.bound, forest.leaf, strict=True):
            at = 0
            while at < len(feature):
                at = 2 * at + (2 if row[feature[at]] > bound[at] else 1)
            raw += leaf[at - len(feature)]
        assert score == pytest.approx(1 / (1 + np.exp(-raw)))
    assert ((forest.score(x) > 0.5) == (y > 0.5)).mean() > 0.9


def test_the_first_split_is_the_best():
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(120, 4)), 1)
    y = (x[:, 2] + 0.3 * rng.normal(size=120) > 0.2).astype(float)
    forest = quality.fit(x, y, trees=1, depth=1)
    p = y.mean()
    grad, hess = p - y, np.full(len(y), p * (1 - p))

    def gain(f, b):
        left = x[:, f] <= b
        part = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + quality.L2)
        return part(left) + part(~left) - part(np.ones(len(y), bool)) if min(left.sum(), (~left).sum()) >= quality.LEAST_CHILD else -1

    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality.BINS + 1)[1:-1])) for f in range(4)]
    best = max(gain(f, b) for f in range(4) for b in cuts[f])
    assert gain(forest.feature[0, 0], forest.bound[0, 0]) == pytest.approx(best)


def test_training_rows_are_bounded(spark):
    docs = frame(spark, [(1, f"text number {k} of one id", "a") for k in range(300)] + [(k, "### $$$", "a") for k in range(2, 20)])
    labels = spark.createDataFrame([(1, 1), *[(k, 0) for k in range(2, 20)]], "doc_id long, quality int")
    seen = []
    fit, quality.fit = quality.fit, lambda x, y: seen.append(len(x)) or fit(x, y)
    try:
        quality.train(docs, labels, sample=50)
    finally:
        quality.fit = fit
    assert seen == [50]


def test_pipeline_of_nothing_and_of_nulls(spark, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    good = "The house stood by the river, and nobody had lived in it for years. " * 3
    rows = [(None, good, "en", None, None), (1, None, None, "a", 0), (1, "", "en", "a", 0), (None, None, None, None, None), (2, good + "More of it.", "en", "b", 5)]
    for name, docs in (("none", []), ("nulls", rows)):
        sf = str(tmp_path / name)
        spark.createDataFrame(docs, columns).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(None, 1, 0), (1, None, None), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(None, None), (1, "")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        out = corpus_pipeline.run(spark, sf).collect()
        assert len(out) <= 3 * len(docs) and all(r.n_tokens >= 1 for r in out)
