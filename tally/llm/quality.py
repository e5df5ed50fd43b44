"""Quality classifier: weak labels by expectation-maximisation, then a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm import words as w
from tally.llm.storage import cut, mapped

# Documents whose features train the scorer. The estimates that label them use all documents.
SAMPLE = 8192
DIMENSION = 512
ROUNDS = 200

# Frequent short words of four languages.
FUNCTION_WORDS = (
    "the of and to in is that for it was on with as be by at this are from or an a he she they we "
    "de la le et les des en un une du pour dans que qui sur pas au el los las y por con para se su del lo "
    "der die das und ist von zu mit den dem des ein eine auf im nicht sich"
).split()


def _classes() -> np.ndarray:
    """A class for each byte: space, lower, upper, digit, sentence mark, other mark, beyond ASCII."""
    table = np.full(256, 5, np.int64)
    table[w.SPACES] = 0
    table[ord("a") : ord("z") + 1] = 1
    table[ord("A") : ord("Z") + 1] = 2
    table[ord("0") : ord("9") + 1] = 3
    table[[ord(c) for c in ".,;:?'\"()-"]] = 4
    table[128:] = 6
    return table


CLASSES = _classes()


def _hash_words(values: list[str]) -> np.ndarray:
    data, offsets = w.buffers(pa.array([" ".join(values)], pa.large_string()))
    return np.unique(w.words_of(data, offsets, w.SPACES).hashes(fold=True))


_FUNCTION = _hash_words(FUNCTION_WORDS)


def measures(run: w.Words) -> tuple[np.ndarray, np.ndarray]:
    """Shares that the labellers judge, and hashed counts that the scorer weighs, per text."""
    n = len(run.first) - 1
    text_of = run.text_of()
    count = np.diff(run.first).astype(float)
    kinds = CLASSES[run.data]
    hashes = run.hashes(fold=True)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(text_of[mask], minlength=n) / np.maximum(count, 1)

    if len(run.starts):
        first, last = kinds[run.starts], kinds[run.ends - 1]
        totals = np.zeros((7, len(kinds) + 1), np.int32)
        np.cumsum(kinds == np.arange(7)[:, None], axis=1, out=totals[:, 1:])
        within = totals[:, run.ends] - totals[:, run.starts]
    else:
        first = last = np.zeros(0, np.int64)
        within = np.zeros((7, 0), np.int32)
    letters = within[1] + within[2] + within[6]
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (text_of[1:] == text_of[:-1])
    thrice = again.copy()
    thrice[1:] &= again[:-1]
    size = run.ends - run.starts
    upper = np.bincount(text_of, within[2], n) / np.maximum(np.bincount(text_of, letters, n), 1)
    stats = np.stack(
        [
            count,
            share(within[5] > 0),
            upper,
            share(letters + within[3] == 0),
            share(again),
            share(thrice),
            share(np.isin(hashes, _FUNCTION)),
            share(last == 4),
            np.bincount(text_of, size, n) / np.maximum(count, 1),
        ]
    )
    bits = np.minimum(size, 15) + 16 * (first + 7 * last) + 1000 * (within[5] > 0) + 2000 * again
    features = np.zeros((n, DIMENSION), np.float32)
    shapes = (w.mix(bits.astype(np.uint64)) % np.uint64(DIMENSION)).astype(np.int64)
    np.add.at(features, (text_of, shapes), 1)
    return stats, features


def votes(stats: np.ndarray) -> np.ndarray:
    """What each labeller says of each text: 1 good, -1 poor, 0 nothing."""
    count, marked, upper, bare, again, thrice, function, ended, size = stats

    def say(poor: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.where(poor, -1, np.where(good, 1, 0))

    return np.stack(
        [
            say(count < 1, count >= 20),
            say(marked > 0.15, marked < 0.05),
            say(upper > 0.4, upper < 0.2),
            say(bare > 0.15, bare < 0.03),
            say(again > 0.1, again < 0.03),
            say(thrice > 0.05, thrice < 0.01),
            say((function < 0.05) & (count >= 20), function > 0.12),
            say((ended < 0.02) & (count >= 20), (ended > 0.04) & (ended < 0.5)),
            say((size < 2) | (size > 15), (size > 3) & (size < 9)),
        ],
        axis=1,
    )


def scaled(features: np.ndarray) -> np.ndarray:
    """Logs of the counts' shares at unit length, with a constant."""
    x = np.log1p(100 * features / np.maximum(features.sum(axis=1, keepdims=True), 1))
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return np.hstack([x, np.ones((len(x), 1), np.float32)])


@dataclass
class LabelModel:
    """Share of good texts, and how often each labeller says -1, 0, 1 of poor and good ones."""

    prior: float
    said: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        at = np.arange(votes.shape[1])
        logs = np.log(self.said[:, at, votes + 1]).sum(axis=2)
        odds = logs[1] - logs[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns and how many texts have each.

    It starts from the belief that a text with any complaint is poor.
    """
    if not len(patterns):
        return LabelModel(0.5, np.full((2, patterns.shape[1], 3), 1 / 3))
    good = np.where((patterns < 0).any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        weights = np.stack([(1 - good) * counts, good * counts])
        said = np.stack(
            [
                [[(weight * (patterns[:, j] == v)).sum() + 1 for v in (-1, 0, 1)] for j in range(patterns.shape[1])]
                for weight in weights
            ]
        )
        said /= said.sum(axis=2, keepdims=True)
        total = weights.sum(axis=1) + 1
        model = LabelModel(float(total[1] / total.sum()), said)
        after = model.posterior(patterns)
        done = np.abs(after - good).max() < 1e-9
        good = after
        if done:
            break
    return model


def fit_scorer(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Logistic regression on soft labels by accelerated gradient steps."""
    weights = ahead = np.zeros(x.shape[1])
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -50, 50)))
        after = ahead - 4.0 * (x.T @ (p - y) / max(len(x), 1) + 1e-5 * ahead)
        ahead = after + (k - 1) / (k + 2) * (after - weights)
        weights = after
    return weights


def _read(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, _, run in w.each_run(column, w.SPACES):
        stats, features = measures(run)
        yield votes(stats), features


@dataclass
class Classifier:
    labels: LabelModel
    weights: np.ndarray

    def judge(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(posterior of the labellers, score of the linear scorer) of each text."""
        weak, scores = [np.zeros(0)], [np.zeros(0)]
        for said, features in _read(column):
            weak.append(self.labels.posterior(said))
            scores.append(1 / (1 + np.exp(-np.clip(scaled(features) @ self.weights, -50, 50))))
        return np.concatenate(weak), np.concatenate(scores)


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Estimate the labellers over all of ``docs`` and fit the scorer to their posteriors.

    Votes of all texts are counted by pattern; there are at most 3**9 patterns, and only
    their counts reach the driver. The scorer is fitted to at most ``sample`` texts, those
    whose ids come first in hash order. Without any text every score is 0.5.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for said, _ in _read(batch.column(0)):
                codes, n = np.unique((said + 1) @ 3 ** np.arange(said.shape[1]), return_counts=True)
                yield pa.record_batch([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], ["pattern", "n"])

    text = F.col(text_col).cast("string").alias("_text")
    seen = mapped(docs.select(text), count, "pattern bigint, n bigint").groupBy("pattern").agg(F.sum("n")).collect()
    labellers = votes(np.zeros((9, 1))).shape[1]
    codes = np.array([r[0] for r in seen], np.int64)
    patterns = codes[:, None] // 3 ** np.arange(labellers) % 3 - 1
    labels = estimate(patterns, np.array([r[1] for r in seen], float))

    ids = docs.select(F.xxhash64(id_col).alias("_order"), F.col(id_col).alias("_id")).dropna()
    chosen = cut(ids.distinct().orderBy("_order", "_id").limit(sample).select("_id"))
    texts = docs.select(F.col(id_col).alias("_id"), text).join(F.broadcast(chosen), "_id", "left_semi")

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for said, features in _read(batch.column(0)):
                rows = [row.tobytes() for row in scaled(features).astype(np.float16)]
                yield pa.record_batch([pa.array(rows, pa.binary()), pa.array(labels.posterior(said))], ["x", "y"])

    rows = mapped(texts.select("_text"), featurize, "x binary, y double").limit(2 * sample).collect()
    if not rows:
        return Classifier(labels, np.zeros(DIMENSION + 1))
    x = np.stack([np.frombuffer(r[0], np.float16) for r in rows]).astype(np.float32)
    return Classifier(labels, fit_scorer(x, np.array([r[1] for r in rows])))


def score_quality(
    docs: DataFrame,
    classifier: Classifier | None = None,
    least: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Quality of each document: doc_id, weak_label (posterior), score, kept (score >= least).

    One row per input row, in any case of repeated ids or texts. Null and empty text is
    judged as a text without words. ``classifier`` is trained on ``docs`` if none is given.
    Other columns are not read.
    """
    model = classifier or train(docs, id_col=id_col, text_col=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weak, scores = model.judge(batch.column(1))
            yield pa.record_batch(
                [batch.column(0), pa.array(weak), pa.array(scores), pa.array(scores >= least)],
                ["doc_id", "weak_label", "score", "kept"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    return mapped(source, run, "doc_id bigint, weak_label double, score double, kept boolean")


def keep_good(
    docs: DataFrame, classifier: Classifier | None = None, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without rows that score below ``least``; rows and columns stay as they are."""
    model = classifier or train(docs, id_col=id_col, text_col=text_col)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.judge(batch.column(place))[1] >= least))

    return mapped(docs, run, T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields]))
