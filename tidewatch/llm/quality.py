"""Document quality by histogram gradient-boosted trees over document statistics.

Statistics of a text are computed where the text is; only a bounded sample of labelled
rows is brought together to fit the trees. A fitted model is three arrays (feature,
threshold, value) with the children of node ``i`` at ``2i+1`` and ``2i+2``, so all rows
and all trees of a batch descend together in numpy.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import table, training_row

SAMPLE = 12_000  # labelled rows at most that the trees are fitted on, by least hash of the id

# ---- Statistics

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c",
    "line": b"\n",
    "stop": b".",
    "comma": b",;:",
    "shout": b"!?",
    "bar": b"|",
    "money": b"$%&#*@",
    "quote": b"\"'()[]{}<>",
    "slash": b"/\\_=+~^`-",
    "high": bytes(range(128, 256)),
}
FEATURES = (
    *(f"share_{c}" for c in _CLASSES),
    "bytes", "words", "word_bytes", "longest_word", "unique_words", "top_word",
    "capital_words", "shouted_words", "marked_words", "barred_words", "short_words",
    "line_bytes", "repeated_lines", "stopped_lines", "entropy", "repeated_pairs",
)
_OF_BYTE = np.full(256, len(_CLASSES))
for _i, _members in enumerate(_CLASSES.values()):
    _OF_BYTE[list(_members)] = _i


def statistics(text: str | None) -> list[float]:
    """The ``FEATURES`` of a whole text; NULL is empty, and shares of nothing are 0."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(len(raw), 1)
    shares = np.bincount(_OF_BYTE, weights=counts, minlength=len(_CLASSES) + 1)[:-1] / n
    used = counts[counts > 0] / n
    words = raw.split()
    w = max(len(words), 1)
    often = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    rows = max(len(lines), 1)
    marks = b"$%&#*!"
    longest = max(map(len, words), default=0)
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        *shares,
        np.log1p(len(raw)),
        np.log1p(len(words)),
        sum(map(len, words)) / w,
        np.log1p(longest),
        len(often) / w,
        max(often.values(), default=0) / w,
        sum(n for x, n in often.items() if x[:1].isupper()) / w,
        sum(n for x, n in often.items() if len(x) > 1 and x.isupper()) / w,
        sum(n for x, n in often.items() if x[-1:] in marks) / w,
        often.get(b"|", 0) / w,
        sum(n for x, n in often.items() if len(x) <= 2) / w,
        np.log1p(sum(map(len, lines)) / rows),
        1 - len(set(lines)) / rows,
        sum(x.rstrip().endswith((b".", b"!", b"?", b":")) for x in lines) / rows,
        float(-(used * np.log2(used)).sum()) if len(used) else 0.0,
        1 - pairs / max(len(words) - 1, 1),
    ]


def matrix(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))


# ---- Trees


@dataclass(frozen=True)
class Trees:
    """Complete binary trees as arrays; a node that does not split sends all rows left."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.prior)
        if len(self.feature):
            trees = np.arange(len(self.feature))
            node = np.zeros((len(x), len(trees)), np.int64)
            rows = np.arange(len(x))[:, None]
            while node.size and node[0, 0] < self.feature.shape[1]:
                right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + right
            total = total + self.value[trees, node - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 128,
    least: int = 10,
    penalty: float = 1.0,
) -> Trees:
    """Logistic boosting; each level of a tree is split from one histogram per feature.

    Without rows the score is 0.5 everywhere, with one label its smoothed frequency.
    """
    inner = (1 << depth) - 1
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if not len(y) or y.min() == y.max():
        return Trees(np.empty((0, inner), np.int64), np.empty((0, inner)), np.empty((0, inner + 1)), prior)
    edges = [np.unique(np.quantile(column, np.arange(1, bins) / bins)) for column in x.T]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    cuts = np.array([np.pad(e, (0, bins - len(e)), constant_values=np.inf) for e in edges])
    features = x.shape[1]
    offset = np.arange(features) * bins
    margin = np.full(len(y), prior)
    out_feature, out_threshold, out_value = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            cell = ((node - first) * features * bins)[:, None] + offset + binned
            shape = (width, features, bins)
            g, h, n = (
                np.bincount(cell.ravel(), np.repeat(v, features), width * features * bins).reshape(shape).cumsum(axis=2)
                for v in (slope, curve, np.ones(len(y)))
            )
            all_g, all_h, all_n = g[:, :, -1:], h[:, :, -1:], n[:, :, -1:]
            gain = g**2 / (h + penalty) + (all_g - g) ** 2 / (all_h - h + penalty) - all_g**2 / (all_h + penalty)
            gain = np.where((n >= least) & (all_n - n >= least), gain, -1.0).reshape(width, -1)
            best = gain.argmax(axis=1)
            good = gain[np.arange(width), best] > 1e-6
            feature[first : first + width] = np.where(good, best // bins, 0)
            threshold[first : first + width] = np.where(good, cuts[best // bins, best % bins], np.inf)
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, curve, inner + 1)
        value = rate * g / (h + penalty)
        margin += value[leaf]
        out_feature.append(feature)
        out_threshold.append(threshold)
        out_value.append(value)
    return Trees(np.array(out_feature), np.array(out_threshold), np.array(out_value), prior)


# ---- Operators


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE) -> DataFrame:
    """``doc_id, label, text`` of at most ``rows`` labelled rows that may be learned from.

    The rows with the least hash of ``doc_id`` among those labelled 0 or 1; of conflicting labels the
    larger holds. The ids are few enough to broadcast, so documents are only filtered.
    """
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = (
        labels.filter(F.col(label).isin(0, 1) & training_row(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
        .orderBy(*order)
        .limit(rows)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.select("doc_id", "label", "text")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE, **options) -> Trees:
    """Trees fitted on the statistics of ``sample``; repeated documents count within the bound."""

    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series(list(matrix(texts)))

    chosen = sample(docs, labels, label, rows).select("doc_id", "label", measure("text").alias("x"))
    got = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(rows).collect()
    x = np.array([r["x"] for r in got], dtype=float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["label"] for r in got], dtype=float), **options)


def score(text: Column, model: Trees) -> Column:
    """Probability of label 1 for each whole text; NULL scores as the empty text."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(matrix(texts)))

    return run(text)


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, all columns kept."""
    return docs.filter(score(F.col("text"), train(docs, labels, **options)) >= least)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return docs.select(
        "doc_id", held_out.alias("held_out"), score(F.col("text"), model).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
