"""Quality scores learnt by Bradley-Terry ranking of preference pairs.

A pair (better, worse) of labelled texts is won with probability
sigmoid(w . (x_better - x_worse)); w is fitted by Newton steps on the logistic
loss of the feature differences.  A text's rank value is w . x, and the value
at the quantile of the training ranks that splits them best becomes the
threshold: score = sigmoid(rank value - threshold).  Features see the text
alone.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LABELLED = 20_000     # labelled texts the fit reads at most, those of the least id hashes
MAX_PAIRS = 60_000        # preference pairs drawn from them
RIDGE = 1e-2

_SIGNS = np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8)


def features(text: bytes | None) -> np.ndarray:
    """Shares and lengths of one UTF-8 text; an empty text gives zeros but for
    the flag that says so."""
    text = text or b""
    words = text.split()
    if not words:
        out = np.zeros(13 + 2 * len(_SIGNS) + 4, np.float32)
        out[0] = 1
        return out
    n, size = len(words), len(text)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    seen = Counter(words)
    lens = np.fromiter(map(len, words), np.int64, n)
    top = max(seen.values())
    upper = sum(map(str.isupper, text.decode("utf-8", "replace").split()))
    lines = int(count[10]) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    base = [0.0,
            np.log1p(n) / 10,
            len(seen) / n,
            top / n if n > 20 else 0.0,
            pairs / max(1, n - 1),
            sum(map(eq, words, words[1:])) / n,
            upper / n,
            count[48:58].sum() / size,
            (count[65:91].sum() + count[97:123].sum() + count[128:].sum()) / size,
            lens.mean() / 10,
            lens.std() / 10,
            min(1.0, lens.max() / 100),
            lines / n]
    signs = count[_SIGNS] / n
    more = [np.sqrt(signs.sum()), np.log1p(size / lines) / 10, (lens == 1).mean(), (lens > 15).mean()]
    return np.concatenate([base, np.minimum(np.sqrt(signs), 2), np.minimum(signs, 1) > 0.2, more]).astype(np.float32)


@dataclass(frozen=True)
class Ranker:
    """rank value = weights . (x - mean) / spread; score = sigmoid of what it
    exceeds the threshold by.  Without usable labels every score is 0.5."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    quantile: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, max_pairs: int = MAX_PAIRS, seed: int = 7) -> Ranker:
    """A Ranker from features x and labels y (1 is better than 0)."""
    width = x.shape[1] if x.ndim == 2 and len(x) else len(features(b""))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.0)
    mean, spread = x.mean(axis=0, dtype=np.float64), x.std(axis=0, dtype=np.float64)
    spread = np.where(spread > 1e-6, spread, 1.0)
    z = np.clip((x - mean) / spread, -8, 8)
    rng = np.random.default_rng(seed)
    m = min(max_pairs, 20 * max(len(good), len(bad)))
    diff = z[good[rng.permutation(m) % len(good)]] - z[bad[rng.permutation(m) % len(bad)]]
    w = np.zeros(width)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        grad = diff.T @ (p - 1) / m + RIDGE * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / m + RIDGE * np.eye(width)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    rank = z @ w
    order = np.argsort(rank, kind="stable")
    hits = np.concatenate([[0], np.cumsum(np.where(y[order] == 0, 1, -1))])    # all below the cut are 0
    best = np.flatnonzero(hits == hits.max())
    cut = int(best[len(best) // 2])
    ranks = np.concatenate([[rank[order[0]] - 1], rank[order], [rank[order[-1]] + 1]])
    return Ranker(mean, spread, w, float((ranks[cut] + ranks[cut + 1]) / 2), cut / len(y))


def _feature_rows(docs: DataFrame) -> DataFrame:
    """(label, text) -> (label, x binary)."""
    def run(batches):
        for b in batches:
            own = [features(t).tobytes() for t in b.column(1).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.binary())], names=["label", "x"])
    return docs.mapInArrow(run, "label int, x binary")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_labelled: int = MAX_LABELLED, max_pairs: int = MAX_PAIRS) -> Ranker:
    """Fit on the texts of at most max_labelled rows of labels, those whose ids
    have the least hashes.  Labels other than 0 and 1 and null ids are left
    out; ids and labels are bounded by the parameter and so are broadcast, and
    the driver receives their feature rows only."""
    some = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
            .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).distinct()
            .orderBy(F.xxhash64("_id"), "_id", "label").limit(max_labelled))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    got = _feature_rows(texts.join(F.broadcast(some), "_id").select("label", "text")).collect()
    got.sort(key=lambda r: (r["label"], r["x"]))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in got], np.float32)
    return fit(x, np.array([r["label"] for r in got]), max_pairs)


def score(docs: DataFrame, model: Ranker, text_col: str = "text") -> DataFrame:
    """docs with `score` (0 to 1) and `predicted` (1 if score >= 0.5) behind its
    columns; columns of these names are replaced.  Null counts as empty."""
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    at = names.index(text_col)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = np.array([features(t) for t in b.column(at).cast(pa.large_binary()).to_pylist()])
            s = model.scores(x)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))],
                names=[*names, "score", "predicted"])

    own = docs.select(*names)
    return own.mapInArrow(run, own.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema)


def keep_good(docs: DataFrame, model: Ranker, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text is predicted 1, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = np.array([features(t) for t in b.column(at).cast(pa.large_binary()).to_pylist()])
                yield b.filter(pa.array(model.scores(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
