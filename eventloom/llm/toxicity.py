"""Toxicity scores by a counterfactually regularised linear classifier.

Inputs are the presence of words and of word beginnings. Candidates are ranked on the labelled
sample by distributed counts; a bounded number of them, and every identity term, enter a logistic
regression. Each labelled text that names a group is paired with a copy in which its identity terms
are swapped for others; the squared change of the score between the two is penalised, so that a
neutral mention of a group does not raise a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import settle
from eventloom.llm.tokens import slices

WORD = re.compile(r"[^\W\d_]+")
#: Lengths of word beginnings that serve as features.
STEMS = (4, 5, 6)
#: Identity terms by kind, fixed; a term is swapped for the next of its kind.
IDENTITIES = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "latino", "hispanic", "arab", "african", "european"),
    ("gay", "lesbian", "bisexual", "transgender", "straight", "queer", "heterosexual", "homosexual"),
    ("woman", "man", "girl", "boy", "female", "male"),
    ("women", "men", "girls", "boys", "females", "males"),
    ("immigrant", "refugee", "foreigner", "citizen", "native"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("old", "young", "elderly", "teenager", "disabled", "blind", "deaf"),
    ("muslime", "christen", "juden", "frauen", "männer", "ausländer", "schwule", "lesben"),
    ("musulmans", "chrétiens", "juifs", "femmes", "hommes", "étrangers", "homosexuels", "lesbiennes"),
    ("musulmanes", "cristianos", "judíos", "mujeres", "hombres", "extranjeros", "homosexuales", "lesbianas"),
)


#: Each identity term with the term it is swapped for.
SWAPPED = {t: kind[(k + 1) % len(kind)] for kind in IDENTITIES for k, t in enumerate(kind)}


def features_of(text: str | None, swap: bool = False) -> set[str]:
    """Words and marked word beginnings that occur in a text, or in its counterfactual copy, in which
    each identity term is swapped."""
    words = set(WORD.findall((text or "").lower()))
    if swap:
        words = {SWAPPED.get(w, w) for w in words}
    out = set(words)
    for n in STEMS:
        out.update([f"{w[:n]}*" for w in words if len(w) >= n])
    return out


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    bias: float

    def scores(self, texts: list[str | None]) -> list[float]:
        get, words_of = self.weights, WORD.findall
        stems = {n: {k[:-1]: v for k, v in get.items() if k.endswith("*") and len(k) == n + 1} for n in STEMS}
        known = {k for k in get if not k.endswith("*")}
        out = []
        for t in texts:
            words = set(words_of((t or "").lower()))
            z = self.bias + sum([get[w] for w in sorted(words & known)])
            for n, of in stems.items():
                z += sum([of[s] for s in sorted({w[:n] for w in words} & of.keys())])
            out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return out


def labelled_sample(labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most `most` labelled ids outside the held-out fifth, in a fixed pseudo-random order:
    (id, y). Ids with several labels take the largest; null ids and labels are left out."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).dropna()
    known = known.filter(F.crc32(F.col("id").cast("string")) % 5 != 0)
    return known.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(most)


def train(
    docs: DataFrame, labels: DataFrame, sample: int = 20_000, most_features: int = 400, penalty: float = 1.0, l2: float = 1e-4
) -> ToxicityModel:
    """Fit on at most `sample` labelled rows. Without rows of both kinds the model is constant."""
    ids = settle(labelled_sample(labels, "toxic", sample), "toxic-sample")
    # The sample is bounded, so it is broadcast and the corpus is not shuffled.
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select("y", "text")

    def explode(batches):
        for batch in batches:
            y = batch.column("y").to_pylist()
            for start, part in slices(batch, "text"):
                for k, t in enumerate(part):
                    names = sorted(features_of(t))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.string()), pa.array([y[start + k]] * len(names), pa.int32())], names=["f", "y"]
                    )

    texts = settle(texts, "toxic-texts")
    sizes = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return ToxicityModel({}, 10.0 if pos else -10.0)
    counted = texts.mapInArrow(explode, "f string, y int").groupBy("f").agg(
        F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")
    )
    lift = F.log((F.col("p") + 0.5) / (pos + 1)) - F.log((F.col("n") + 0.5) / (neg + 1))
    strong = counted.filter("p + n >= 5").select("f", (F.abs(lift) * F.sqrt(F.greatest("p", "n"))).alias("z"), lift.alias("lift"))
    names = [r["f"] for r in strong.filter(F.abs("lift") > 1).orderBy(F.desc("z"), "f").limit(most_features).collect()]
    terms = [t for kind in IDENTITIES for t in kind]
    names += [t for t in terms if t not in set(names)]
    index = {n: i for i, n in enumerate(names)}

    def present(batches):
        def found(texts, swap):
            return pa.array([sorted(index[f] for f in features_of(t, swap) & index.keys()) for t in texts], pa.list_(pa.int32()))

        for batch in batches:
            y = batch.column("y")
            for start, part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([y.slice(start, len(part)), found(part, False), found(part, True)], names=["y", "x", "c"])

    rows = texts.mapInArrow(present, "y int, x array<int>, c array<int>").collect()
    rows.sort(key=lambda r: (r["y"], r["x"], r["c"]))
    y = np.array([r["y"] for r in rows], np.float32)
    x, swapped = (presence([r[k] for r in rows], len(names)) for k in ("x", "c"))
    weights, bias = fit(x, y, swaps(x, swapped), penalty, l2)
    kept = {n: float(w) for n, w in zip(names, weights, strict=True) if abs(w) > 1e-3}
    return ToxicityModel(kept, float(bias))


def presence(rows: list[list[int]], width: int) -> np.ndarray:
    """A 0/1 matrix with the named columns of each row set."""
    out = np.zeros((len(rows), width), np.float32)
    for i, at in enumerate(rows):
        out[i, at] = 1
    return out


def swaps(x: np.ndarray, swapped: np.ndarray) -> np.ndarray:
    """Difference of each row that names a group to its counterfactual, rows without one left out."""
    diff = swapped - x
    return diff[diff.any(axis=1)]


def fit(x: np.ndarray, y: np.ndarray, diff: np.ndarray, penalty: float, l2: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on the log loss, an L2 term and the counterfactual term."""
    w, b = np.zeros(x.shape[1]), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32) + b, -30, 30)))
        err = (p - y).astype(np.float32)
        g = x.T @ err / len(y) + l2 * w
        if len(diff):
            g = g + 2 * penalty * diff.T @ (diff @ w) / len(diff)
        gb = float(err.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        step = 0.1 / (1 - 0.9**t)
        w = w - step * m / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        b -= step * mb / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return w, b


def score(docs: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, by a model with scores(texts).

    Null texts are scored as empty; repeated rows each get a row; a null id is never held out."""

    def run(batches):
        for batch in batches:
            for start, part in slices(batch, "text"):
                s = [round(v, 9) for v in model.scores(part)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(part)).cast(pa.int64()), pa.array(s, pa.float64())], names=["doc_id", "score"]
                )

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores below the threshold. Null texts stay."""
    schema = docs.schema

    def run(batches):
        for batch in batches:
            keep = []
            for _, part in slices(batch, "text"):
                keep += [v < threshold for v in model.scores(part)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
