"""Toxicity by a chain of linear classifiers (op9).

Categories are predicted one after another. Each model is a logistic regression on the
presence of words and word beginnings, and on the probabilities that the models before it
give. While the chain is trained, those are out-of-fold: a row's come from models that
have not seen the row's fold, so a later model learns how far earlier ones can be trusted.

The chain is fitted in one task on a bounded sample of the labelled rows, ``SAMPLE`` rows
chosen by a hash; its size does not grow with the data. Every row of the table is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tunesmith.llm.common import quoted
from tunesmith.llm.tokens import Memo, worker_kept

# Labelled rows that the chain is fitted on, folds, hashed features, and those a model uses.
SAMPLE, FOLDS, HASHED, USED = 10_000, 5, 1 << 20, 300
# Rows of a class that a used feature is in at least; weight decay; rounds of fitting.
LEAST_ROWS, DECAY, ROUNDS = 2, 0.2, 150
# Word beginnings that are features besides the word.
BEGINNINGS = (4, 5)
# A row is rejected from this probability of the last category on.
REJECT = 0.5
# Words a worker keeps in each of two generations.
WORDS = 150_000
#: Signs that are cut off both ends of a word.
EDGES = ".,;:!?\"'()[]"

#: Categories in the order of the chain: name and what a row of labels says of it.
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))


def features_of(word: str) -> list[int]:
    """Hashed features of a word: itself and its beginnings."""
    bare = word.lower().strip(EDGES) or word
    strings = {"w" + bare} | {f"{n}{bare[:n]}" for n in BEGINNINGS if len(bare) > n}
    return [xxhash.xxh32_intdigest(s.encode()) % HASHED for s in sorted(strings)]


def rows_of(texts: list[str]) -> list[np.ndarray]:
    """The distinct hashed features of each text."""
    known = Memo(lambda w: np.array(features_of(w), "<i4").tobytes(), WORDS)
    return [np.unique(np.frombuffer(b"".join(map(known.__getitem__, (t or "").split())), "<i4")) for t in texts]


@dataclass
class Model:
    """Log odds = bias + weights of the features present + ``earlier`` times the earlier models' probabilities."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    earlier: np.ndarray

    def log_odds(self, rows: list[np.ndarray], before: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.bias) + before @ self.earlier
        for i, row in enumerate(rows):
            at = np.searchsorted(self.features, row)
            at[at == len(self.features)] = 0
            out[i] += self.weights[at[self.features[at] == row]].sum() if len(self.features) else 0.0
        return np.clip(out, -30, 30)


def probability(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-log_odds))


def _chosen(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The features that tell the classes apart best by chi-square, sorted."""
    inside = np.concatenate([r for r, is_one in zip(rows, y) if is_one] or [np.zeros(0, np.int32)])
    outside = np.concatenate([r for r, is_one in zip(rows, y) if not is_one] or [np.zeros(0, np.int32)])
    a, b = (np.bincount(x, minlength=HASHED).astype(np.float64) for x in (inside, outside))
    ones, zeros = y.sum(), len(y) - y.sum()
    chi = (a * (zeros - b) - b * (ones - a)) ** 2 * len(y) / (np.maximum(ones * zeros, 1) * np.maximum((a + b) * (len(y) - a - b), 1))
    found = np.flatnonzero((np.maximum(a, b) >= LEAST_ROWS) & (chi > 0))
    return np.sort(found[np.argsort(-chi[found], kind="stable")[:USED]]).astype(np.int32)


def fit(rows: list[np.ndarray], before: np.ndarray, y: np.ndarray) -> Model:
    """A logistic regression by accelerated gradient steps. With one class only, that class's odds."""
    if not len(y) or y.min() == y.max():
        side = float(y[0]) if len(y) else 0.0
        return Model(np.zeros(0, np.int32), np.zeros(0), 20.0 * (2 * side - 1), np.zeros(before.shape[1]))
    features = _chosen(rows, y)
    owner, column = [], []
    for i, row in enumerate(rows):
        at = np.searchsorted(features, row)
        at[at == len(features)] = 0
        hit = at[features[at] == row] if len(features) else at[:0]
        owner.append(np.full(len(hit), i))
        column.append(hit)
    owner, column = np.concatenate(owner), np.concatenate(column)
    scale = np.maximum(np.abs(before).max(0, initial=1.0), 1.0)
    extra = before / scale
    n, width = len(y), len(features)
    theta = np.zeros(width + extra.shape[1] + 1)
    theta[-1] = np.log(y.mean() / (1 - y.mean()))
    # A step's length from the longest row: the curvature is at most a quarter of its square.
    longest = np.bincount(owner, minlength=n).max() + extra.shape[1] + 1
    step, ahead, last = 4.0 / (longest * n) * 8, theta.copy(), theta
    decay = np.full(len(theta), DECAY)
    decay[-1] = 0

    def loss_and_slope(t):
        z = np.bincount(owner, t[column], n) + extra @ t[width:-1] + t[-1]
        miss = 1 / (1 + np.exp(-z)) - y
        slope = np.concatenate([np.bincount(column, miss[owner], width), miss @ extra, [miss.sum()]]) + decay * t
        return np.logaddexp(0, z).sum() - (y * z).sum() + 0.5 * (decay * t * t).sum(), slope

    for k in range(ROUNDS):
        loss, slope = loss_and_slope(ahead)
        while True:
            theta = ahead - step * slope
            if loss_and_slope(theta)[0] <= loss - 0.5 * step * slope @ slope or step < 1e-9:
                break
            step /= 2
        ahead = theta + k / (k + 3) * (theta - last)
        last, step = theta, step * 1.1
    return Model(features, theta[:width], float(theta[-1]), theta[width:-1] / scale)


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray) -> list[Model]:
    """One model per column of ``labels`` (0, 1, or below 0 where unknown), each fed out-of-fold probabilities."""
    chain, before = [], np.zeros((len(rows), 0))
    for y in labels.T:
        own = np.zeros(len(rows))
        known = y >= 0

        def subset(mask):
            return [r for r, m in zip(rows, mask) if m], before[mask], y[mask].astype(np.float64)

        for fold in range(FOLDS):
            out = folds == fold
            model = fit(*subset(known & ~out))
            own[out] = probability(model.log_odds([r for r, m in zip(rows, out) if m], before[out]))
        chain.append(fit(*subset(known)))
        before = np.column_stack([before, own])
    return chain


class Scorer:
    """Probabilities of every category for whole texts; a worker keeps the words it has met."""

    def __init__(self, chain: list[Model]):
        self.chain = chain
        self.features = np.unique(np.concatenate([m.features for m in chain])) if chain else np.zeros(0, np.int32)
        self.weights = np.zeros((len(self.features) + 1, len(chain)))
        for k, m in enumerate(chain):
            self.weights[np.searchsorted(self.features, m.features), k] = m.weights
        place = {int(f): i for i, f in enumerate(self.features)}
        self.words = Memo(lambda w: np.array([place[f] for f in features_of(w) if f in place], "<i4").tobytes(), WORDS)

    def __call__(self, text: str | None) -> list[float]:
        present = np.unique(np.frombuffer(b"".join(map(self.words.__getitem__, (text or "").split())), "<i4"))
        sums, found = self.weights[present].sum(0), []
        for k, m in enumerate(self.chain):
            z = m.bias + sums[k] + float(np.dot(m.earlier, found)) if found else m.bias + sums[k]
            found.append(float(probability(min(max(z, -30), 30))))
        return found


def trained(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", categories=CATEGORIES) -> list[Model]:
    """The chain fitted on a sample of the documents that have labels.

    The ``SAMPLE`` labelled ids of smallest hash are joined with their texts, and of those the
    ``SAMPLE`` rows of smallest hash are used, whole. Of labels that repeat for an id, a
    category holds if any says so; a null label is unknown. Without labels every row is
    taken to be free of all categories.
    """
    said = labels.where(quoted(key).isNotNull()).groupBy(quoted(key).cast("long").alias("__id"))
    said = said.agg(*[F.coalesce(F.max(F.expr(rule).cast("int")), F.lit(-1)).alias(f"y{k}") for k, (_, rule) in enumerate(categories)])
    said = said.withColumn("__h", F.xxhash64("__id")).orderBy("__h", "__id").limit(SAMPLE)
    texts = docs.select(quoted(key).cast("long").alias("__id"), quoted(text).alias("__t"))
    sample = texts.join(F.broadcast(said), "__id").withColumn("__r", F.xxhash64("__id", "__t")).orderBy("__r", "__id").limit(SAMPLE)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, hashes = [], [], []
        for batch in batches:
            rows += rows_of(batch.column("__t").to_pylist())
            labels.append(np.column_stack([batch.column(f"y{k}").to_numpy(zero_copy_only=False) for k in range(len(categories))]))
            hashes.append(batch.column("__h").to_numpy(zero_copy_only=False))
        if rows:
            for m in fit_chain(rows, np.concatenate(labels), np.concatenate(hashes) % FOLDS):
                blobs = [m.features.astype("<i4"), m.weights, np.array([m.bias]), m.earlier]
                yield pa.RecordBatch.from_arrays([pa.array([b.tobytes()], pa.binary()) for b in blobs], ["features", "weights", "bias", "earlier"])

    found = sample.coalesce(1).mapInArrow(train, "features binary, weights binary, bias binary, earlier binary").collect()
    models = [Model(np.frombuffer(r[0], "<i4"), np.frombuffer(r[1]), float(np.frombuffer(r[2])[0]), np.frombuffer(r[3])) for r in found]
    return models or [fit([], np.zeros((0, k)), np.zeros(0)) for k in range(len(categories))]


def probabilities(text: Column, chain: list[Model]) -> Column:
    """Array of the categories' probabilities of a whole text; a null text is an empty one."""

    # Another chain is another key.
    name = xxhash.xxh3_64_intdigest(b"".join(x.tobytes() for m in chain for x in (m.features, m.weights, np.array([m.bias]), m.earlier)))

    @F.arrow_udf("array<double>")
    def score(texts: pa.Array) -> pa.Array:
        of = worker_kept(("chain", name), lambda: Scorer(chain))
        return pa.array([of(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return score(text)


def toxicity(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", categories=CATEGORIES) -> DataFrame:
    """Per row: key, ``p_<category>`` of each category, and ``rejected`` (the last one's is ``REJECT`` or more).

    Null keys and repeated rows are scored like others; an empty table gives no row.
    """
    chain = trained(df, labels, text, key, categories)
    found = df.select(quoted(key).alias(key), probabilities(quoted(text), chain).alias("__p"))
    return found.select(key, *[F.col("__p")[k].alias(f"p_{name}") for k, (name, _) in enumerate(categories)], (F.col("__p")[len(categories) - 1] >= REJECT).alias("rejected"))


def kept_rows(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", categories=CATEGORIES) -> DataFrame:
    """The rows of ``df`` that ``toxicity`` does not reject, with their columns."""
    chain = trained(df, labels, text, key, categories)
    return df.where(probabilities(quoted(text), chain)[len(categories) - 1] < REJECT)
