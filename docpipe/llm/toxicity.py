"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes ratios.

Features are the distinct character n-grams of a text's words, lower-cased and padded
with a blank on both sides, hashed into a fixed number of slots. A slot's value is its
naive Bayes log-count ratio between the classes; a logistic regression learns one
weight a slot on these scaled features. A score is the logistic of their sum.

The classifier is fitted on a bounded sample of labelled rows (``sample_mb`` of text,
taken in the order of a digest of the id, whole texts only, both classes alike).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import _LOWER, _SPACE, _powers, choose, crc_mod, cut, digest_at, digest_limits, mix, size_caps, trim, utf8

_U = np.uint64
ORDERS = (3, 4, 5, 6, 8)
BITS = 20
_PART = 1 << 20


def slots(text: np.ndarray, bits: int = BITS, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """Slots of all n-grams of one text's bytes, repeats included.

    An n-gram may hold a blank at its ends only; a whole word between its two blanks is
    an n-gram as well, whatever its length. Spans are hashed by running totals.
    """
    found = []
    for part in _parts(text):
        b = _LOWER[part]
        blank = np.concatenate([[True], _SPACE[b], [True]])
        b = np.concatenate([[32], b, [32]]).astype(_U)
        b[blank] = 32
        up, down = _powers(len(b))
        total = np.zeros(len(b) + 1, _U)
        np.cumsum((b + _U(1)) * up[: len(b)], out=total[1:])
        blanks = np.zeros(len(b) + 1, np.int64)
        np.cumsum(blank, out=blanks[1:])
        for n in orders:
            m = len(b) - n + 1
            if m <= 0:
                continue
            at = np.flatnonzero(blanks[n - 1 : n - 1 + m] == blanks[1 : 1 + m])
            found.append((total[at + n] - total[at]) * down[at] + _U(n))
        edge = np.flatnonzero(blank)
        long = np.flatnonzero(np.diff(edge) >= max(orders))
        at, stop = edge[long], edge[long + 1] + 1
        found.append((total[stop] - total[at]) * down[at])
    every = np.concatenate(found) if found else np.zeros(0, _U)
    return (mix(every) >> _U(64 - bits)).astype(np.int32)


def _parts(text: np.ndarray):
    """A long text in pieces cut at white space, so that memory stays bounded."""
    at = 0
    while len(text) - at > _PART:
        gaps = np.flatnonzero(_SPACE[text[at + _PART :]])
        if not len(gaps):
            break
        stop = at + _PART + int(gaps[0])
        yield text[at:stop]
        at = stop
    yield text[at:]


class Model:
    """Weights of all slots and the intercept."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def score(self, text: np.ndarray) -> float:
        found = slots(text, int(np.log2(len(self.weights))))
        found = np.unique(found[self.weights[found] != 0])
        z = self.bias + float(self.weights[found].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def fit(texts: list[bytes], labels: np.ndarray, rate: float | None = None, alpha: float = 1.0, least: float = 2.5, penalty: float = 10.0, rounds: int = 600, bits: int = BITS) -> Model:
    """Fit on (text, 0/1) rows; ``rate`` is the share of ones that the scores assume.

    Slots whose ratio is below ``least``, or which fewer than three texts have, weigh
    nothing. Without rows of both classes every score is the rate.
    """
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 1e-6
        return Model(np.zeros(1 << bits), np.log(rate / (1 - rate)))
    n = 1 << bits
    rows = [np.unique(slots(np.frombuffer(t, np.uint8), bits)) for t in texts]
    p, q = np.full(n, alpha), np.full(n, alpha)
    for r, one in zip(rows, y):
        (p if one else q)[r] += 1
    # a rate for each class, as classes may differ in size
    ratio = np.log((p / (y.sum() + 2 * alpha)) / (q / ((1 - y).sum() + 2 * alpha)))
    ratio[(np.abs(ratio) < least) | (p + q - 2 * alpha < 3)] = 0
    rows = [r[ratio[r] != 0] for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    slot = np.concatenate(rows)
    used, at = np.unique(slot, return_inverse=True)
    x = ratio[used][at]
    balance = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
    w, b = np.zeros(len(used)), 0.0
    # accelerated gradient steps, each feature's step scaled by its own energy
    energy = np.bincount(at, x * x * balance[row], len(used)) * 0.25
    width = max(1.0, np.median(np.bincount(row, minlength=len(y))))
    step = 1.0 / (energy * np.sqrt(width) + penalty)
    v, vb = w.copy(), b
    for k in range(rounds):
        z = vb + np.bincount(row, x * v[at], len(y))
        g = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y) * balance
        grad = np.bincount(at, x * g[row], len(used)) + penalty * v
        w1, b1 = v - step * grad, vb - g.sum() / (0.25 * balance.sum() + 1)
        mom = k / (k + 3)
        v, vb = w1 + mom * (w1 - w), b1 + mom * (b1 - b)
        w, b = w1, b1
    full = np.zeros(n)
    full[used] = w * ratio[used]
    rate = y.mean() if rate is None else min(max(rate, 1e-6), 1 - 1e-6)
    return Model(full, b + np.log(rate / (1 - rate)))


def sample_rows(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str, text: str, label: str, sample_mb: int) -> tuple[list[bytes], np.ndarray, float]:
    """Whole labelled texts, ``sample_mb`` MB, half from each class where it has as many, and
    the share of ones among all labelled rows.

    Very long texts are left out where a class has enough others (``shared.size_caps``); a
    class of long texts only teaches by one at least, whatever its size.
    """
    marked = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y")).where("_y in (0, 1)").groupBy("_id").agg(F.max("_y").alias("_y"))
    budget = sample_mb * 500_000
    rows = docs.where(train).select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    rows = rows.withColumns({"_size": F.octet_length("_t").cast("long"), "_at": digest_at(F.col("_id"), F.col("_t"))})
    # ids, sizes and digests alone meet the labels; texts are read again for the sample
    slim = cut(rows.select("_id", "_size", "_at").join(marked, "_id").select("_id", "_size", "_at", F.col("_y").alias("_kind")))
    caps = size_caps(slim, budget)
    limit, n = digest_limits(slim, budget, caps)
    within = (F.col("_size") <= choose(F.col("_kind"), caps, 0.0)) & (F.col("_at") < choose(F.col("_kind"), limit, 0.0)) if limit else F.lit(False)
    chosen = cut(slim.where(within).select("_id", "_at", F.col("_kind").alias("_y")).distinct())
    sample = rows.where(F.col("_size") <= max(caps.values(), default=0)).join(F.broadcast(chosen) if chosen.count() <= 100_000 else chosen, ["_id", "_at"]).dropDuplicates(["_id", "_at"])
    got = sample.select("_id", "_y", "_t").toArrow().sort_by([("_id", "ascending"), ("_t", "ascending")])
    return [t.encode() for t in got["_t"].to_pylist()], np.array(got["_y"].to_pylist(), int), n.get(1, 0) / max(sum(n.values()), 1)


def train_model(docs: DataFrame, labels: DataFrame, train: Column | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample_mb: int = 12) -> Model:
    train = F.coalesce(train if train is not None else crc_mod(doc_id, 5) != 0, F.lit(False))
    model = fit(*sample_rows(docs, labels, train, doc_id, text, label, sample_mb))
    trim()
    return model


def scorer(model: Model):
    """Column function from texts to scores in 0 to 1; null counts as empty."""
    shared = {"model": model}

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        buf, off = utf8(pa.Array.from_pandas(text, type=pa.large_string()))
        return pd.Series([shared["model"].score(buf[a:b]) for a, b in zip(off[:-1], off[1:])], dtype="float64")

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample_mb: int = 12) -> DataFrame:
    """Columns doc_id, held_out, score, predicted for every row of ``docs``.

    ``held_out`` marks rows whose labels are not learned from (default: crc32 of the id
    modulo 5 is 0). A null text is scored as an empty one, by the intercept. Labels
    other than 0 and 1 are left out; a document with several labels is toxic if one
    says so. Repeated rows are scored one by one. Empty tables are allowed: without
    labelled rows of both classes the score is the same for all. Other columns and
    clashing names are ignored.
    """
    held = F.coalesce(held_out if held_out is not None else crc_mod(doc_id, 5) == 0, F.lit(False))
    model = train_model(docs, labels, ~held, doc_id, text, label, sample_mb)
    scored = docs.select(F.col(doc_id).alias("doc_id"), held.alias("held_out"), scorer(model)(F.col(text).cast("string")).alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
