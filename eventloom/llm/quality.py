"""Quality scores by histogram gradient-boosted trees over document statistics.

The trees are grown on a bounded labelled sample, on binned features, and flattened into arrays of
feature, threshold and children, which a batch of texts walks down level by level in numpy.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import settle
from eventloom.llm.tokens import slices
from eventloom.llm.toxicity import labelled_sample

NAMES = (
    "words", "chars", "mean_word", "long_word", "upper", "digit", "punct", "symbol", "non_ascii", "exclaim",
    "distinct", "top_word", "caps_words", "symbol_words", "lines", "dup_lines", "line_words", "short_lines",
    "end_punct", "repeat_grams", "packed", "pipes", "plain_words", "stop_like",
)
SYMBOL = re.compile(r"[#*$%&|<>^~=+\\@{}\[\]]")
PUNCT = re.compile(r"[.,;:!?'\"()\-]")


def statistics(text: str | None) -> list[float]:
    """The document statistics of a whole text; an empty one has zeros."""
    text = text or ""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(NAMES)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    grams = Counter(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    raw = text.encode()
    upper, digit = sum(map(str.isupper, text)), sum(map(str.isdigit, text))
    return [
        float(n),
        float(chars),
        sum(map(len, words)) / n,
        float(max(map(len, words))),
        upper / chars,
        digit / chars,
        len(PUNCT.findall(text)) / chars,
        len(SYMBOL.findall(text)) / chars,
        (len(raw) - chars) / chars,
        text.count("!") / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(w.isupper() and len(w) > 1 for w in words) / n,
        sum(SYMBOL.search(w) is not None for w in counts) / len(counts),
        float(len(lines)),
        1 - len(set(lines)) / len(lines),
        n / len(lines),
        sum(len(x) < 30 for x in lines) / len(lines),
        sum(x.rstrip()[-1:] in (".", "!", "?", '"') for x in lines) / len(lines),
        sum(c for c in grams.values() if c > 1) / max(1, n - 4),
        len(zlib.compress(raw, 1)) / len(raw),
        text.count("|") / n,
        sum(w.isalpha() for w in words) / n,
        sum(len(w) <= 3 for w in words) / n,
    ]


@dataclass(frozen=True)
class Forest:
    """Trees in flat arrays: a node sends a row to `child` or, above its threshold, to `child + 1`;
    a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            above = x[rows, self.feature[at]] > self.threshold[at]
            leaf = self.child[at] == at
            at = np.where(leaf, at, self.child[at] + above)
        return self.bias + self.value[at].sum(axis=1)

    def scores(self, texts: list[str | None]) -> list[float]:
        x = np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(NAMES))
        return (1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))).tolist()


def grow(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 48, least: float = 5.0) -> Forest:
    """Boost trees on the log loss; splits are searched over histograms of binned features."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    mean = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
    bias = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), bias)
    feature, threshold, child, value, roots = [], [], [], [], []

    def leaf() -> int:
        feature.append(0)
        threshold.append(0.0)
        child.append(len(child))
        value.append(0.0)
        return len(child) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        roots.append(leaf())
        work = [(roots[-1], np.arange(len(y)), 0)]
        while work:
            node, rows, level = work.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            best = (1e-6, None, None)
            if level < depth and hs > 2 * least / 5:
                for f in range(x.shape[1]):
                    if not len(edges[f]):
                        continue
                    b = binned[rows, f]
                    cg = np.cumsum(np.bincount(b, g[rows], len(edges[f]) + 1))[:-1]
                    ch = np.cumsum(np.bincount(b, h[rows], len(edges[f]) + 1))[:-1]
                    gain = cg**2 / (ch + 1) + (gs - cg) ** 2 / (hs - ch + 1) - gs**2 / (hs + 1)
                    gain[(ch < least / 20) | (hs - ch < least / 20)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], f, k)
            if best[1] is None:
                value[node] = rate * gs / (hs + 1)
                margin[rows] += value[node]
                continue
            _, f, k = best
            left, right = leaf(), leaf()
            feature[node], threshold[node], child[node] = f, float(edges[f][k]), left
            high = binned[rows, f] > k
            work += [(left, rows[~high], level + 1), (right, rows[high], level + 1)]
    return Forest(
        np.array(feature, np.int64), np.array(threshold), np.array(child, np.int64), np.array(value), np.array(roots, np.int64), depth, bias
    )


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Forest:
    """Fit on at most `sample` labelled rows outside the held-out fifth."""
    ids = settle(labelled_sample(labels, "quality", sample), "quality-sample")

    def run(batches):
        for batch in batches:
            y = batch.column("y")
            for start, part in slices(batch, "text"):
                stats = [statistics(t) for t in part]
                yield pa.RecordBatch.from_arrays([y.slice(start, len(part)), pa.array(stats, pa.list_(pa.float64()))], names=["y", "x"])

    # The sample is bounded, so it is broadcast and the corpus is not shuffled.
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select("y", "text")
    rows = texts.mapInArrow(run, "y int, x array<double>").collect()
    rows.sort(key=lambda r: (r["y"], r["x"]))
    y = np.array([r["y"] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        x = np.zeros((2, len(NAMES)))
        return grow(x, np.full(2, float(y[0]) if len(y) else 1.0), trees=1, depth=1)
    return grow(np.array([r["x"] for r in rows], np.float64), y)
