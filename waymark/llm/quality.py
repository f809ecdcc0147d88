"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are counted over the whole text. Trees are grown on the driver from a bounded sample of labelled rows
(``SAMPLE`` rows, those with the smallest hashes of their id), level by level, on features cut into at most ``BINS``
bins by quantiles. The finished model is a few flat arrays; a batch of rows walks all trees at once with numpy.

Edge cases: a null text counts as empty, and an empty text gets a score like any other; labels that are null or without
a document are not used; repeated labels count as often as they occur; with no usable labels every score is 0.5; an
empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import prepare, text_or_empty

#: The largest number of labelled rows that the model is fitted on.
SAMPLE = 20_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
L2 = 1.0
LEAST_CHILD = 5.0
THRESHOLD = 0.3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".?!",
    "pause": b",;:",
    "bang": b"!",
    "symbol": b"#$%&*+<=>@^_`|~\\/{}[]",
    "quote": b"\"'()",
    "line": b"\n\r",
    "blank": b" \t",
    "bar": b"|",
    "high": bytes(range(128, 256)),
}
_TABLE = np.zeros((256, len(_CLASSES)), np.float64)
for _k, _chars in enumerate(_CLASSES.values()):
    _TABLE[list(_chars), _k] = 1
FEATURES = [
    "log_bytes", "log_words", "mean_word", "spread_word", "longest_word", "distinct_words", "top_word", "entropy",
    "lines", "mean_line", "spread_line", "distinct_lines", "short_lines", "words_ending_sentence", "words_capital", "words_shouting", "words_marked",
    *_CLASSES,
]


def statistics(text: str | None) -> list[float]:
    """The numbers named in ``FEATURES``, from a whole text."""
    data = (text or "").encode("utf-8", "replace")
    n = max(1, len(data))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = counts / n
    used = shares[shares > 0]
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    w, k = max(1, len(words)), max(1, len(lines))
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    spans = np.fromiter(map(len, lines), np.float64, len(lines)) if lines else np.zeros(1)
    kinds: dict[bytes, int] = {}
    for x in words:
        kinds[x] = kinds.get(x, 0) + 1
    title = shout = marked = ends = 0
    for x, c in kinds.items():
        shout += c * x.isupper()
        title += c * (65 <= x[0] <= 90)
        last = x[-1]
        ends += c * (last in b".?!")
        marked += c * (last in b"#$%&*+<=>@^_`|~\\/{}[]" or (last == 33 and x[-2:-1] == b"!"))
    return [
        np.log1p(len(data)), np.log1p(len(words)), sizes.mean(), sizes.std(), sizes.max(), len(kinds) / w, max(kinds.values(), default=0) / w, float(-(used * np.log2(used)).sum()),
        np.log1p(len(lines)), np.log1p(spans.mean()), spans.std() / max(1.0, spans.mean()), len(set(lines)) / k, float((spans < 40).mean()), ends / w, title / w, shout / w, marked / w,
        *(shares @ _TABLE),
    ]


@dataclass
class Forest:
    """Trees of equal depth as flat arrays: inner nodes by tree and heap position, leaves by tree and path."""

    base: float
    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for the rows of ``x``."""
        raw, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for f, b, leaf in zip(self.feature, self.bound, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                at = 2 * at + 1 + (x[rows, f[at]] > b[at])
            raw += leaf[at - inner]
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boost trees on the logistic loss; each node takes the best split of the feature histograms."""
    inner = (1 << depth) - 1
    if not len(x):
        return Forest(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    columns = x.shape[1]
    feature, bound, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    raw = np.full(len(x), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        at = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            slot = at - first
            best_gain, best_f, best_b = np.full(width, 1e-6), np.zeros(width, np.int64), np.full(width, -1, np.int64)
            for j in range(columns):
                cell = slot * BINS + binned[:, j]
                g = np.bincount(cell, grad, width * BINS).reshape(width, BINS)
                h = np.bincount(cell, hess, width * BINS).reshape(width, BINS)
                n = np.bincount(cell, minlength=width * BINS).reshape(width, BINS)
                gl, hl, nl = g.cumsum(1), h.cumsum(1), n.cumsum(1)
                gt, ht, nt = gl[:, -1:], hl[:, -1:], nl[:, -1:]
                gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
                gain[(nl < LEAST_CHILD) | (nt - nl < LEAST_CHILD)] = -1
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best_gain
                best_gain[better], best_f[better], best_b[better] = top[better], j, k[better]
            for s in range(width):
                if best_b[s] >= 0:
                    feature[t, first + s], bound[t, first + s] = best_f[s], cuts[best_f[s]][best_b[s]]
            right = (best_b[slot] >= 0) & (binned[np.arange(len(x)), best_f[slot]] > best_b[slot])
            at = 2 * at + 1 + right
        place = at - inner
        g, h = np.bincount(place, grad, inner + 1), np.bincount(place, hess, inner + 1)
        leaf[t] = -RATE * g / (h + L2)
        raw += leaf[t][place]
    return Forest(base, feature, bound, leaf)


def _matrix(texts) -> np.ndarray:
    return np.array([statistics(x) for x in texts], np.float64).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, usable=None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Forest:
    """Fit on at most ``sample`` labelled documents for which ``usable`` (a Column over the labels) holds.

    The ids of the sample are broadcast (a bound of ``sample`` rows); statistics are counted by the executors, and the
    driver gets at most ``sample`` rows of ``len(FEATURES)`` numbers, those with the smallest hashes of id and statistics,
    however many documents repeat a labelled id.
    """
    prepare(docs.sparkSession)
    some = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    some = some.filter(usable) if usable is not None else some
    some = some.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_y")).orderBy(F.xxhash64("_id"), "_id", "_y").limit(sample)
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_t")).join(F.broadcast(some), "_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["_id"], "y": batch["_y"], "x": list(_matrix(batch["_t"]))})

    found = rows.select("_id", "_t", "_y").mapInPandas(run, "id long, y double, x array<double>")
    got = found.orderBy(F.xxhash64("id"), F.xxhash64("x"), "y").limit(sample).toPandas()
    order = np.lexsort((got["y"].to_numpy(), got["id"].to_numpy())) if len(got) else []
    x = np.array([list(v) for v in got["x"]], np.float64).reshape(-1, len(FEATURES))
    return fit(x[order], got["y"].to_numpy(np.float64)[order])


def probability(docs: DataFrame, forest: Forest, text_col: str = "text") -> Column:
    """The probability of label 1, of which only the text is known."""
    prepare(docs.sparkSession)

    @F.pandas_udf("double")
    def of_texts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(forest.score(_matrix(batch)))

    return of_texts(text_or_empty(text_col))


def score(docs: DataFrame, forest: Forest, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs``, all columns, with the ``probability`` of label 1."""
    return docs.withColumn(score_col, probability(docs, forest, text_col))
