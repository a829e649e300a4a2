"""Operator 6: toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; a sample of all training-fold text is the unlabelled set.
Features are the presence of words, word beginnings and word ends that are over-represented in the
positives; a linear model is trained in numpy with the class-prior-corrected risk
``pi R_p(+) + max(0, R_u(-) - pi R_p(-))`` (when the estimate of the negative part goes below zero the
step is taken backwards on it).  The class prior is a parameter, the toxic share of the labelled training fold
where that holds both labels, or else an estimate from the scores of the unlabelled documents; labelled 0 rows are
never trained on.  How common a feature is, is counted over all documents of the training fold.

Bounds, all parameters: ``max_positive`` and ``max_unlabelled`` sampled documents (the first by a hash
of doc_id, so the sample is the same on every run), ``max_candidates`` and ``max_features`` features.
The model is at most ``max_features`` strings and numbers; every document is scored whole.

Edge cases: NULL or empty text gets the bias alone, very long texts are read whole; without confirmed positives
every score is 0, without a telling feature it is the prior; repeated label rows count as toxic if one says so, NULL labels say nothing;
a NULL doc_id is scored in the training fold; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read, staged, text_or_empty

_WORD = re.compile(r"[^\W\d_]+")
THRESHOLD = 0.7
CACHED_WORDS = 100_000         # words whose feature numbers a task keeps at once


def held_out(doc_id: Column | str = "doc_id") -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % 3 == 1


def word_features(w: str) -> list[str]:
    """The word, its beginnings and its ends."""
    out = ["=" + w]
    for k in (3, 4, 5):
        if len(w) > k:
            out += ["^" + w[:k], "$" + w[-k:]]
    return out


def text_features(text: str) -> set[str]:
    return {f for w in set(_WORD.findall(text.lower())) for f in word_features(w)}


def _positive_counts(batches):
    c: Counter = Counter()
    for b in batches:
        for t in b.column(0).to_pylist():
            c.update(text_features(t))
    if c:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())],
                                         names=["feature", "n"])


def _indexer(index: dict[str, int]):
    """text -> sorted feature numbers; a word's numbers are looked up once (bounded cache)."""
    cache: dict[str, tuple] = {}

    def features(text: str) -> list[int]:
        if len(cache) > CACHED_WORDS:
            cache.clear()
        found: set[int] = set()
        for w in set(_WORD.findall(text.lower())):
            k = cache.get(w)
            if k is None:
                k = cache[w] = tuple(index[f] for f in word_features(w) if f in index)
            if k:
                found.update(k)
        return sorted(found)

    return features


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Row numbers, feature numbers and the number of rows."""
    return (np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([i for r in rows for i in r], dtype=np.int64), len(rows))


def _logits(w: np.ndarray, b: float, x: tuple) -> np.ndarray:
    return np.bincount(x[0], w[x[1]], x[2]) + b


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def risk_parts(w: np.ndarray, b: float, pos: tuple, unl: tuple, prior: float) -> tuple[float, float]:
    """``pi R_p(+)`` and ``R_u(-) - pi R_p(-)`` with the logistic loss."""
    zp, zu = _logits(w, b, pos), _logits(w, b, unl)
    soft = lambda z: np.logaddexp(0, z).mean()
    return prior * soft(-zp), soft(zu) - prior * soft(zp)


def risk_gradient(w: np.ndarray, b: float, pos: tuple, unl: tuple, prior: float) -> np.ndarray:
    """Gradient by weights and bias; where the negative part is below zero, the step back on that part alone."""
    zp, zu = _logits(w, b, pos), _logits(w, b, unl)
    gp, gu = -prior * _sigmoid(zp) / pos[2], _sigmoid(zu) / unl[2]
    if risk_parts(w, b, pos, unl, prior)[1] < 0:
        gp, gu = -gp, -gu
    else:
        gp = gp - prior * _sigmoid(-zp) / pos[2]
    return np.append(np.bincount(pos[1], gp[pos[0]], len(w)) + np.bincount(unl[1], gu[unl[0]], len(w)), gp.sum() + gu.sum())


def plain_gradient(w: np.ndarray, b: float, pos: tuple, unl: tuple, prior: float) -> np.ndarray:
    """Gradient of the logistic loss that takes unlabelled rows for negative ones, both kinds weighing the same."""
    gp, gu = -_sigmoid(-_logits(w, b, pos)) / pos[2], _sigmoid(_logits(w, b, unl)) / unl[2]
    return np.append(np.bincount(pos[1], gp[pos[0]], len(w)) + np.bincount(unl[1], gu[unl[0]], len(w)), gp.sum() + gu.sum()) / 2


def fit_nnpu(pos: list[list[int]], unl: list[list[int]], n_features: int, prior: float, epochs: int = 400,
             rate: float = 0.1, l2: float = 1e-4, gradient=risk_gradient) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear model under the non-negative PU risk (logistic loss, Adam)."""
    x, y = _flat(pos), _flat(unl)
    w, b = np.zeros(n_features), math.log(prior / (1 - prior))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, epochs + 1):
        g = gradient(w, b, x, y, prior) + np.append(l2 * w, 0.0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def estimate_prior(pos: list[list[int]], unl: list[list[int]], n_features: int) -> float:
    """Share of positives among the unlabelled rows, from scores alone.

    Above any score stand at least prior * (share of positives above it) of the unlabelled rows, so the least
    quotient of the two shares bounds the prior from above, and meets it where high scores are all positive.  Each
    half of the rows is scored by a model of the other half.
    """
    found = []
    for k in (0, 1):
        p, q, u, v = pos[k::2], pos[1 - k::2], unl[k::2], unl[1 - k::2]
        if not (p and q and u and v):
            return min(max(len(pos) / max(len(unl), 1), 1e-3), 0.5)
        w, b = fit_nnpu(p, u, n_features, 0.5, epochs=150, gradient=plain_gradient)
        zp, zu = np.sort(_logits(w, b, _flat(q)))[::-1], np.sort(_logits(w, b, _flat(v)))
        at = np.arange(max(len(zp) * 3 // 10, 1) - 1, len(zp))               # the top three tenths at least
        above = len(zu) - np.searchsorted(zu, zp[at], side="left")
        found.append(float(((above + 1) / (len(zu) + 1) / ((at + 1) / len(zp))).min()))
    return min(max(sum(found) / 2, 1e-4), 0.9)


def _document_counts(texts: DataFrame, names: list[str]) -> dict[int, int]:
    """In how many of the rows of ``texts`` each feature stands: all of them are read, each task sends one row a feature."""
    held = texts.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(names)})

    def run(batches):
        features, n = _indexer(held.value), np.zeros(len(held.value), dtype=np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                n[features(t)] += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["i", "n"])

    return {r["i"]: r["n"] for r in texts.mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()}


def train(docs: DataFrame, labels: DataFrame, max_positive: int = 3000, max_unlabelled: int = 10000, max_candidates: int = 40000,
          max_features: int = 2048, prior: float | None = None) -> tuple[dict[str, int], np.ndarray, float]:
    """(feature numbers, weights, bias), learnt from training-fold rows only.

    Labelled 0 rows are not needed: where there are some, the labelled share of toxic rows is the class prior, without
    any it is estimated from the scores of unlabelled rows; ``prior`` overrules both.
    """
    known = (labels.where(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic")))
    share = known.agg(F.avg("toxic").alias("p")).first()["p"]
    if not share:
        return {}, np.zeros(0), -40.0
    if prior is None and share < 1:
        prior = share
    none = ({}, np.zeros(0), math.log(prior / (1 - prior)) if prior else -3.0)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    pos = known.where("toxic = 1").orderBy(*order).limit(max_positive).select("doc_id", F.lit(1).alias("kind"))
    fold = docs.where(~held_out()).select("doc_id", text_or_empty().alias("text"))
    unl = fold.select("doc_id").orderBy(*order).limit(max_unlabelled).dropDuplicates().select("doc_id", F.lit(0).alias("kind"))
    picked = staged(pos.unionByName(unl), "tox-ids")                     # at most the two bounds
    sample = staged(docs.select("doc_id", text_or_empty().alias("text"))
                    .join(F.broadcast(picked), "doc_id").select("text", "kind"), "tox-sample")
    counts = (sample.where("kind = 1").select("text").mapInArrow(_positive_counts, "feature string, n long")
              .groupBy("feature").agg(F.sum("n").alias("n")))
    n_pos = sample.where("kind = 1").count()
    cand = {r["feature"]: r["n"] for r in counts.where(F.col("n") >= max(3, n_pos // 500))
            .orderBy(F.col("n").desc(), "feature").limit(max_candidates).collect()}
    if not cand:
        return none
    names = sorted(cand)
    common, n_all = _document_counts(fold.select("text"), names), fold.count()
    lift = {}
    for i, f in enumerate(names):
        p, u = (cand[f] + 0.5) / (n_pos + 1), (common.get(i, 0) + 0.5) / (n_all + 1)
        if p > 2 * u:
            lift[f] = math.log(p / u) * math.sqrt(cand[f])
    best = sorted(lift, key=lambda f: (-lift[f], f))[:max_features]
    if not best:
        return none
    index = {f: k for k, f in enumerate(best)}
    held = docs.sparkSession.sparkContext.broadcast(index)

    def numbered(batches):
        features = _indexer(held.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([features(t) for t in b.column(0).to_pylist()], pa.list_(pa.int32()))],
                names=["kind", "f"])

    slim = sample.mapInArrow(numbered, "kind int, f array<int>").collect()                    # bounded sample
    rows = {k: [list(f) for f in sorted(tuple(r["f"]) for r in slim if r["kind"] == k)] for k in (0, 1)}
    w, b = fit_nnpu(rows[1], rows[0], len(best), prior or estimate_prior(rows[1], rows[0], len(best)))
    return index, w, b


def score(docs: DataFrame, model: tuple[dict[str, int], np.ndarray, float]) -> DataFrame:
    """doc_id, score of every document's whole text."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        index, w, bias = held.value
        features = _indexer(index)
        for b in batches:
            z = np.array([bias + sum(w[i] for i in features(t)) for t in b.column(1).to_pylist()])
            s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows scored at or above ``threshold``; all columns, no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, w, bias = held.value
        features = _indexer(index)
        for texts in batches:
            z = texts.map(lambda t: bias + sum(w[i] for i in features(t))).astype(float)
            yield 1 / (1 + np.exp(-z.clip(-40, 40)))

    return docs.where(toxic(text_or_empty()) < threshold)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    s = score(docs, train(docs, read(spark, sf_dir, "labels")))
    return s.select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
