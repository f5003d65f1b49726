"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Features are the n-grams (3 to 6 bytes of the lower-cased text) that a text holds, hashed to a table of 2**`SLOTS`. Of each, r is the log ratio of its
smoothed frequency in toxic and in other labelled texts. Features whose rates differ by `LEAST_Z` standard errors, at most `FEATURES`, are scaled by r, and logistic regression on them is
fitted with a penalty. A score is the probability of label 1.

Fitting takes a bounded sample: `SAMPLE` labelled texts of each class, the first in the order of a hash of their ids, in one task. Scoring covers every text as a whole.

Defined cases: null texts are empty; an empty text has the score of a text without features; labels without a document, and null labels, teach nothing; without labels of both
classes every score is the share of label 1 among those there are, or 0; repeated labels of a document count once, as the largest; repeated rows and texts have the same score, and ties between ids' hashes go to the lesser id; an empty table gives an empty table; other columns pass
through, whatever their names, unless they are named as a result. The n-grams are of UTF-8 bytes: of letters outside ASCII they see two bytes or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import name, packed, portions, unpacked, with_fields

SIZES, SLOTS, FEATURES, SAMPLE = (3, 4, 5, 6), 20, 40_000, 1500
#: Standard errors by which the rates of a feature differ at least.
LEAST_Z = 3.5
#: Bytes of a text that are looked at together; portions overlap, so every n-gram counts.
PORTION = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def slots(text: str | None) -> Iterator[np.ndarray]:
    """Slots of the n-grams of a text, with repetitions; a space stands in front of and behind it."""
    raw = np.frombuffer(f" {(text or '').lower()} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64)
    for lo in range(0, len(raw), PORTION):
        b = raw[lo : lo + PORTION + SIZES[-1] - 1]
        v = np.zeros(len(b), np.uint64)
        for n in range(1, SIZES[-1] + 1):
            if len(b) < n:
                break
            v = v[: len(b) - n + 1] | (b[n - 1 :] << np.uint64(8 * (n - 1)))
            if n in SIZES:
                own = v if lo + PORTION >= len(raw) else v[: PORTION]
                yield ((own + np.uint64(n)) * _ODD >> np.uint64(64 - SLOTS)).astype(np.int32)


def fit(texts: list[str | None], labels: np.ndarray, l2: float = 10.0, rounds: int = 300) -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, weights, intercept)."""
    y = labels.astype(float)
    if not len(y) or y.min() == y.max():
        p = min(max(float(y.mean()) if len(y) else 0.0, 1e-9), 1 - 1e-9)
        return np.empty(0, np.int32), np.empty(0), float(np.log(p / (1 - p)))
    held = []
    count = np.ones((2, 1 << SLOTS))
    for t, k in zip(texts, labels.tolist(), strict=True):
        own = np.unique(np.concatenate([np.empty(0, np.int32), *slots(t)]))
        held.append(own)
        count[int(k)][own] += 1
    docs = np.array([(y == 0).sum(), (y == 1).sum()]) + 2.0
    rate = count / docs[:, None]
    r = np.log(rate[1] / rate[0])
    # evidence: how far the two rates are apart, in standard errors
    both = count.sum(0) / docs.sum()
    z = np.abs(rate[1] - rate[0]) / np.sqrt(both * np.maximum(1 - both, 1e-6) * (1 / docs[0] + 1 / docs[1]))
    z[count.sum(0) < 5] = 0
    z[z < LEAST_Z] = 0
    pick = np.sort(np.argsort(-z, kind="stable")[: min(FEATURES, int((z > 0).sum()))]).astype(np.int32)
    place = np.full(1 << SLOTS, -1, np.int32)
    place[pick] = np.arange(len(pick))
    cols = [p[p >= 0] for p in (place[h] for h in held)]
    size = np.array([len(c) for c in cols])
    col, row = np.concatenate(cols), np.repeat(np.arange(len(cols)), size)
    x = r[pick][col]
    # both classes weigh the same, so a score does not follow the share of toxic labels
    load = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    w, b = np.zeros(len(pick)), 0.0
    # a step for each feature by its curvature, with momentum
    curve = np.bincount(col, x * x * load[row], len(pick)) / 4 + l2
    step, vel, vb = 1.0 / curve, np.zeros(len(pick)), 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, x * w[col], len(y)) + b, -30, 30)))
        err = (p - y) * load
        g = np.bincount(col, x * err[row], len(pick)) + l2 * w
        vel, vb = 0.9 * vel - 0.02 * step * g, 0.9 * vb - 0.02 * 4 * err.mean()
        w, b = w + vel, b + vb
    return pick, w * r[pick], b


def margins(texts: list[str | None], pick: np.ndarray, weights: np.ndarray, intercept: float, place: np.ndarray) -> np.ndarray:
    out = np.empty(len(texts))
    for k, t in enumerate(texts):
        found = [p[p >= 0] for p in (place[s] for s in slots(t))]
        own = np.unique(np.concatenate(found)) if found else np.empty(0, np.int32)
        out[k] = intercept + weights[own].sum()
    return out


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], []
    for b in batches:
        texts += b.column(0).to_pylist()
        labels += b.column(1).to_pylist()
    pick, w, b = fit(texts, np.array(labels, np.int64), l2=10.0)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(pick, -1).astype(np.int32)), pa.array(np.append(w, b))], ["slot", "weight"])


def _score(pick: np.ndarray, weights: np.ndarray, intercept: float, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << SLOTS, -1, np.int32)
        place[pick] = np.arange(len(pick))
        for b in batches:
            for part in portions(b, 1, 500):
                p = 1 / (1 + np.exp(-np.clip(margins(part.column(1).to_pylist(), pick, weights, intercept, place), -700, 700)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["_row", "score", "predicted"])

    return run


def sample(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", size: int = SAMPLE) -> DataFrame:
    """(text, label) of at most `size` labelled documents of each class."""
    rows = docs.select(F.col(name(doc_id)).alias("d"), F.col(name(text)).alias("t"))
    known = labels.select(F.col(name(doc_id)).alias("d"), F.col(name(label)).alias("y")).where("y IS NOT NULL AND d IS NOT NULL").groupBy("d").agg(F.max("y").cast("long").alias("y"))
    known = known.join(rows.select("d"), "d", "left_semi")
    few = [known.where(F.col("y") == k).orderBy(F.xxhash64("d"), "d").limit(size) for k in (0, 1)]
    few = few[0].union(few[1])  # at most 2 * size rows
    return rows.join(F.broadcast(few), "d").select("t", "y")


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", size: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    got = sample(docs, labels, text, doc_id, label, size).repartition(1).mapInArrow(_fit, "slot int, weight double").toPandas()  # at most FEATURES + 1 rows
    if not len(got):
        return np.empty(0, np.int32), np.empty(0), -700.0
    b = got["slot"].to_numpy() == -1
    return got["slot"].to_numpy()[~b], got["weight"].to_numpy()[~b], float(got["weight"].to_numpy()[b][0])


def score(df: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text", threshold: float = 0.7, drop_text: bool = False) -> DataFrame:
    """df with score and predicted."""
    rows, kept = packed(df, ["score", "predicted"], (text,) if drop_text else (), _text=F.col(name(text)).cast("string"))
    return unpacked(rows.mapInArrow(_score(*model, threshold), with_fields(rows, "_row", "score double, predicted int")), kept, "score", "predicted")
