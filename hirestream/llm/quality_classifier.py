"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled texts are known, no negatives.  The class prior
of the unlabelled texts is estimated from a first classifier (positives against
unlabelled): above the best threshold nearly all unlabelled texts are positive, so
the ratio of both shares there bounds the prior.  A small network then minimises
the non-negative unbiased risk: the risk on positives weighted by the prior, plus
the risk of the unlabelled as negatives less the part that is due to positives,
which is kept from going below zero.

Texts become a few dozen numbers inside Spark; only a bounded sample of those
numbers is gathered for fitting.  Scoring covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirestream.llm.common import stage

CHUNK = 50
_CLASS_CHARS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c\r", b"\n",
                b".,;:?'\"()-", b"!", b"#*$%&|<>~^=+_/\\@{}[]`")
N_CLASSES = len(_CLASS_CHARS) + 2  # and: bytes above 127, control bytes
_CLASS = np.full(256, N_CLASSES - 1, np.uint8)
_CLASS[128:] = N_CLASSES - 2
for _i, _chars in enumerate(_CLASS_CHARS):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _i
N_FEATURES = 2 * N_CLASSES + 12


def features(text: str) -> np.ndarray:
    """Shares of byte classes in the text and their largest share in a line, and numbers about its words."""
    out = np.zeros(N_FEATURES, np.float32)
    raw = text.encode("utf-8")
    if not raw:
        return out
    x = np.frombuffer(raw, np.uint8)
    cls = _CLASS[x]
    out[:N_CLASSES] = np.bincount(cls, minlength=N_CLASSES) / len(x)
    line = np.cumsum(cls == 4)
    per = np.bincount(line * N_CLASSES + cls, minlength=(int(line[-1]) + 1) * N_CLASSES).reshape(-1, N_CLASSES)
    sizes = per.sum(1)
    long = per[sizes >= min(20, sizes.max())]
    out[N_CLASSES : 2 * N_CLASSES] = (long / long.sum(1, keepdims=True)).max(0)
    words = raw.split()
    n = len(words)
    w = out[2 * N_CLASSES :]
    w[0] = np.log1p(len(x)) / 10
    if n:
        lengths = np.fromiter(map(len, words), np.int64, n)
        chunks = [words[i : i + CHUNK] for i in range(0, n, CHUNK)]
        if len(chunks) > 1 and len(chunks[-1]) < CHUNK // 2:
            chunks.pop()
        fresh = [len(set(c)) / len(c) for c in chunks]
        w[1], w[2], w[3] = np.log1p(n) / 10, lengths.mean() / 10, lengths.std() / 10
        w[4], w[5] = min(fresh), sum(fresh) / len(fresh)
        w[6] = lengths.max() / 100
        w[7] = sum(map(bytes.__eq__, words[1:], words)) / n
        w[8] = sum(map(bytes.__eq__, words[2:], words)) / n
        w[9] = sum(not y.isalpha() for y in words if y.isascii()) / n
        w[10] = (len(long) - len(set(raw.split(b"\n")))) / max(1, len(per)) if len(per) > 1 else 0.0
        w[11] = np.log1p(len(per)) / 10
    return np.nan_to_num(out)


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, x array<float>)`` for every row; NULL counts as the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.concatenate([features(t) for t in batch.column(1).to_pylist()] or [np.empty(0, np.float32)])
            offsets = pa.array(np.arange(0, len(x) + 1, N_FEATURES, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(x))], ["doc_id", "x"])

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text).mapInArrow(run, "doc_id long, x array<float>")


@dataclass
class Model:
    """A network with one hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.tanh(self.standard(x) @ self.w1 + self.b1) @ self.w2 + self.b2
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _train(p: np.ndarray, u: np.ndarray, prior: float | None, seed: int, steps: int, hidden: int, batch: int = 2048,
           rate: float = 0.01, decay: float = 1e-4) -> Model:
    """Adam on the non-negative risk, or on plain positives against unlabelled if there is no prior."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([p, u])
    scale = both.std(0)
    m = Model(both.mean(0), np.where(scale > 1e-6, scale, 1.0), rng.normal(0, 0.3, (p.shape[1], hidden)), np.zeros(hidden),
              rng.normal(0, 0.3, hidden), 0.0, prior or 0.0)
    p, u = m.standard(p), m.standard(u)
    theta = [m.w1, m.b1, m.w2, np.zeros(1)]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, steps + 1):
        xp, xu = p[rng.integers(0, len(p), min(batch, len(p)))], u[rng.integers(0, len(u), min(batch, len(u)))]
        x = np.concatenate([xp, xu])
        h = np.tanh(x @ theta[0] + theta[1])
        z = np.clip(h @ theta[2] + theta[3], -30, 30)
        s = 1 / (1 + np.exp(-z))
        k = len(xp)
        g = np.empty_like(s)  # derivative of the risk by z
        if prior is None:
            g[:k], g[k:] = (s[:k] - 1) / k, s[k:] / len(xu)
        else:
            as_negative = np.logaddexp(0, z)
            negative = as_negative[k:].mean() - prior * as_negative[:k].mean()
            if negative >= 0:
                g[:k], g[k:] = prior * (s[:k] - 1) / k - prior * s[:k] / k, s[k:] / len(xu)
            else:  # the negative part is overfitted: step back on it alone
                g[:k], g[k:] = prior * s[:k] / k, -s[k:] / len(xu)
        gh = np.outer(g, theta[2]) * (1 - h * h)
        grads = [x.T @ gh + decay * theta[0], gh.sum(0), h.T @ g + decay * theta[2], np.array([g.sum()])]
        lr = rate * (1 - 0.9 * step / steps)
        for i, d in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * d
            second[i] = 0.999 * second[i] + 0.001 * d * d
            theta[i] = theta[i] - lr * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    m.w1, m.b1, m.w2, m.b2 = theta[0], theta[1], theta[2], float(theta[3][0])
    return m


def estimate_prior(p: np.ndarray, u: np.ndarray, seed: int = 1, steps: int = 300) -> float:
    """Share of positives among the unlabelled: the smallest ratio, with its margin of error, of shares above a threshold."""
    half_p, half_u = len(p) // 2, len(u) // 2
    if not half_p or not half_u:
        return 0.5
    first = _train(p[:half_p], u[:half_u], None, seed, steps, 16)
    sp, su = np.sort(first.score(p[half_p:])), np.sort(first.score(u[half_u:]))
    cuts = np.quantile(sp, np.linspace(0, 0.95, 96))
    share_p = 1 - np.searchsorted(sp, cuts, "left") / len(sp)
    share_u = 1 - np.searchsorted(su, cuts, "left") / len(su)
    margin = np.sqrt(np.log(40) / (2 * len(su))) + np.sqrt(np.log(40) / (2 * len(sp)))
    best = int(np.argmin((share_u + margin) / np.maximum(share_p, 1e-9)))
    return float(np.clip(share_u[best] / share_p[best], 0.02, 0.98))


def fit(rows: DataFrame, sample: int = 20_000, prior: float | None = None, seed: int = 1, steps: int = 1500,
        hidden: int = 24) -> Model:
    """Fit on ``rows (doc_id, x, positive)``; at most ``sample`` rows of either kind are gathered.

    The sample are the rows that come first by a hash of their id, so it is the
    same in every run.  Without positives, or without other rows, every score of
    the model is the prior (a half if unknown).
    """
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    n = rows.agg(F.count_if("positive"), F.count(F.lit(1))).first()

    def pick(df: DataFrame, n: int) -> np.ndarray:
        """The first rows by hash; a limit on the hash, from the count, keeps what a task sends near its share."""
        share = 1.2 * sample / max(n, 1)
        while True:
            chosen = df if share >= 1 else df.where(order <= F.lit(int((share - 0.5) * 2.0**64)))
            got = chosen.select(order.alias("o"), "doc_id", "x").orderBy("o", "doc_id").limit(sample).collect()
            if share >= 1 or len(got) >= sample:
                return np.array([r["x"] for r in got], np.float64).reshape(-1, N_FEATURES)
            share *= 2

    p, u = pick(rows.where("positive"), n[0]), pick(rows, n[1])
    if not len(p) or not len(u):
        at = 0.5 if prior is None else prior
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros((N_FEATURES, 1)), np.zeros(1), np.zeros(1),
                     float(np.log(at / (1 - at))), at)
    at = estimate_prior(p, u, seed) if prior is None else prior
    return _train(p, u, at, seed, steps, hidden)


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``rows (doc_id, x, ...)`` with the column ``score``, between 0 and 1."""
    @F.pandas_udf("double")
    def of(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x.to_numpy()).astype(np.float64)))

    return rows.withColumn("score", of("x"))


def classify_quality(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = 20_000, threshold: float = 0.7,
                     prior: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` for every row of ``docs``.

    ``labels (doc_id, quality)``: 1 is a trusted positive; other labels are not
    used.  ``learn``, a condition on ``doc_id``, says which rows may be learnt
    from.  NULL and empty texts are scored as empty; a NULL id is scored and never
    learnt from; repeated rows get equal scores; extra columns are ignored.
    """
    rows = stage(text_features(docs, id_col, text_col), "features")
    trusted = labels.where("quality = 1").select("doc_id").distinct().withColumn("__trusted", F.lit(True))
    known = rows.where(learn & F.col("doc_id").isNotNull()).join(trusted, "doc_id", "left").select(
        "doc_id", "x", F.coalesce("__trusted", F.lit(False)).alias("positive"))
    model = fit(known, sample, prior)
    return score(rows, model).select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
