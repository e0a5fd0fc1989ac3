"""Quality classifier: gradient-boosted trees over document statistics.

Trees are grown on histograms of a bounded sample of labelled documents, then
flattened into arrays, so that a batch of documents walks a tree in as many numpy
steps as it has levels.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logstow.llm.tables import id_remainder, slices, text_of

SYMBOLS = b"#*$%&|<>"
FEATURES = (
    "log_words",
    "mean_word_bytes",
    "symbols_per_word",
    "exclamations_per_word",
    "upper_share",
    "lower_share",
    "digit_share",
    "punctuation_share",
    "distinct_words",
    "commonest_word",
    "repeated_neighbours",
    "distinct_pairs",
    "lines_per_word",
    "duplicate_lines",
    "short_words",
)
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))


def statistics(text: str) -> list[float]:
    """The features of one whole text; all zero without a word."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(data)

    def share(chars: bytes) -> float:
        return (size - len(data.translate(None, chars))) / size

    counts = Counter(words)
    pairs = set(zip(words, words[1:], strict=False))
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = data.split(b"\n")
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        share(SYMBOLS) * size / n,
        data.count(b"!") / n,
        share(UPPER),
        share(LOWER),
        share(DIGITS),
        (data.count(b".") + data.count(b",")) / n,
        len(counts) / n,
        max(counts.values()) / n,
        same / n,
        (len(pairs) + 1) / n,
        len(lines) / n,
        1 - len(set(lines)) / len(lines),
        sum(c for w, c in counts.items() if len(w) < 3) / n,
    ]


@dataclass(frozen=True)
class Boosting:
    """Size of the sample and of the model.

    sample: labelled documents that are learned from, in expectation; they are
        chosen by a hash of the id, and their features come to the driver.
    """

    sample: int = 20_000
    trees: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    least_weight: float = 1.0
    penalty: float = 1.0


@dataclass(frozen=True)
class Forest:
    """Complete trees of equal depth, one row each, nodes in level order."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of features."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        levels = int(np.log2(self.leaf.shape[1]))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(levels):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (leaf.size - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def grow(x: np.ndarray, y: np.ndarray, how: Boosting = Boosting()) -> Forest:
    """Boost trees for the logistic loss on histograms of binned features.

    Without both labels the forest has no tree and answers the smoothed share.
    """
    n, width = x.shape
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**how.depth - 1, 2**how.depth
    if n == 0 or y.min() == y.max():
        shape = (0, inner)
        return Forest(base, np.zeros(shape, int), np.zeros(shape), np.zeros((0, leaves)))
    cuts = [
        np.unique(np.quantile(x[:, f], np.linspace(0, 1, how.bins + 1)[1:-1]))
        for f in range(width)
    ]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f]) for f in range(width)], axis=1)
    slots = binned + np.arange(width) * how.bins
    logit = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(how.trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = y - p, p * (1 - p)
        feature = np.zeros(inner, dtype=np.int64)
        threshold = np.full(inner, np.inf)
        node = np.zeros(n, dtype=np.int64)
        for level in range(how.depth):
            first = 2**level - 1
            here = node - first
            keys = (here[:, None] * (width * how.bins) + slots).ravel()
            size = 2**level * width * how.bins
            shape = (2**level, width, how.bins)
            sums = [
                np.bincount(keys, np.repeat(v, width), size).reshape(shape).cumsum(axis=2)
                for v in (g, h)
            ]
            gl, hl = sums
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            gr, hr = gt - gl, ht - hl
            gain = (
                gl**2 / (hl + how.penalty)
                + gr**2 / (hr + how.penalty)
                - gt**2 / (ht + how.penalty)
            )
            gain[(hl < how.least_weight) | (hr < how.least_weight)] = 0
            for k in range(2**level):
                best = int(gain[k].argmax())
                f, b = divmod(best, how.bins)
                if gain[k, f, b] > 1e-6 and b < len(cuts[f]):
                    feature[first + k] = f
                    threshold[first + k] = cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        at = node - inner
        leaf = how.rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + how.penalty)
        logit += leaf[at]
        features.append(feature)
        thresholds.append(threshold)
        values.append(leaf)
    return Forest(base, np.array(features), np.array(thresholds), np.array(values))


def features_of(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(t.as_py() or "") for t in texts]).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, how: Boosting = Boosting()) -> Forest:
    """Learn from documents (doc_id, text) with a label (doc_id, quality 0 or 1).

    An id with several labels counts with the lowest. The expected sample is
    bounded, so it is broadcast, and its features are collected.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    there = known.count()
    kept = min(1.0, how.sample / max(there, 1))
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(kept * (1 << 20)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c) for c in features_of(batch.column(1)).T],
                names=["quality", *FEATURES],
            )

    schema = "quality int, " + ", ".join(f"{f} double" for f in FEATURES)
    rows = (
        docs.select("doc_id", text_of().alias("text"))
        .join(F.broadcast(sample), "doc_id")
        .select(F.col("quality").cast("int"), "text")
        .mapInArrow(run, schema)
        .toPandas()
    )
    # Rows come in any order; the model must not depend on it.
    rows = rows.sort_values(list(rows.columns))
    return grow(rows[list(FEATURES)].to_numpy(float), rows["quality"].to_numpy(float), how)


def quality_classifier(
    docs: DataFrame, labels: DataFrame, how: Boosting = Boosting(), threshold: float = 0.7
) -> DataFrame:
    """Score of every document: doc_id, held_out, score and predicted.

    Takes doc_id and text of the documents and doc_id and quality of the labels.
    Labels of documents whose crc32(doc_id) mod 4 is 2 are not learned from. Null
    and empty texts are scored like any other, as texts whose features are all
    zero. Without labels every score is one half. Repeated rows give repeated
    results, an empty table an empty one.
    """
    held_out = id_remainder(4) == 2
    forest = train(docs, labels.filter(~held_out), how)
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = shared.value.score(features_of(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(score),
                    pa.array((score >= threshold).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(
        F.col("doc_id").cast("long"), held_out.alias("held_out"), text_of()
    ).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
