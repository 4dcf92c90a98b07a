"""Toxicity by a chain of linear classifiers: each category sees the probabilities of those before it."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import few_rows, whole_text

#: The chain: label columns in the order in which they are predicted.
CATEGORIES = ("quality", "toxic")
#: Hashed word features, a bound on a broadcast model of 4 bytes each and category.
FEATURES = 1 << 18
#: At most so many labelled documents are fitted on; scoring covers all documents.
MAX_LABELLED = 5000
#: Parts of the labelled documents that are judged in turn by models of the others.
FOLDS = 5
#: Lengths in bytes of the beginnings that stand for a word's inflected forms.
STEMS = (4, 5, 6, 7, 8)

_WORD_BYTES = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in bytes(range(256)).lower())


def features(text: bytes) -> np.ndarray:
    """The hashed distinct words of a text and their beginnings.

    Words are runs of letters, digits and bytes beyond ASCII, A-Z lowered. The beginnings let a few labels speak for
    all the endings that a word may take.
    """
    words = set(text.translate(_WORD_BYTES).split())
    words.update([w[:n] + b"-" for n in STEMS for w in words if len(w) > n])
    return np.unique(np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) & np.uint32(FEATURES - 1))


@dataclass
class Linear:
    """A logistic model over words and the log odds of earlier categories."""

    words: np.ndarray
    earlier: np.ndarray
    bias: float

    def log_odds(self, rows: list[np.ndarray], before: np.ndarray) -> np.ndarray:
        sums = np.array([self.words[row].sum() for row in rows], float)
        return sums + before @ self.earlier + self.bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def evidence(hits: np.ndarray, counts: np.ndarray, positive: float, n: int) -> np.ndarray:
    """The G statistic of each word: how far its documents' labels are from those of all documents.

    ``hits`` of its ``counts`` documents are positive, as are ``positive`` of all n.
    """

    def term(seen, expected):
        return seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12))

    share = positive / n
    table = term(hits, counts * share) + term(counts - hits, counts * (1 - share))
    table += term(positive - hits, (n - counts) * share) + term(n - counts - positive + hits, (n - counts) * (1 - share))
    return 2 * table


def fit_linear(rows: list[np.ndarray], before: np.ndarray, y: np.ndarray, ridge: float = 3e-3, steps: int = 300) -> Linear:
    """Logistic regression with an L2 penalty on the words whose evidence stands out.

    A word that three documents have gets a weight if its G exceeds what the best of all words has by chance.
    """
    n = max(len(rows), 1)
    ids = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    counts = np.bincount(ids, minlength=FEATURES)
    hits = np.bincount(ids, weights=y[of], minlength=FEATURES)
    often = counts >= 3
    chosen = often & (evidence(hits, counts, y.sum(), n) >= 2 * np.log(max(often.sum(), 2)) + 4)
    used, stays = np.flatnonzero(chosen), chosen[ids]
    which = np.searchsorted(used, ids[stays])
    # rare words get larger steps, down to those that 1 in 100 has
    scale = 1 / np.sqrt(counts[used] / n + 0.01)
    w = _descend(which, of[stays], scale, before, y, ridge, steps)
    weights = np.zeros(FEATURES, np.float32)
    weights[used] = w[: len(used)] * scale
    return Linear(weights, w[len(used) : -1], float(w[-1]))


def _descend(which, of, scale, before, y, ridge: float, steps: int) -> np.ndarray:
    """Weights of the words, the earlier categories and the bias, by accelerated gradient steps.

    ``which`` and ``of`` are the words and the rows of all features that are set.
    """
    n, words = max(len(y), 1), len(scale)

    def score(w):
        return np.bincount(of, weights=(w[:words] * scale)[which], minlength=len(y)) + before @ w[words:-1] + w[-1]

    def gradient(error):
        own = np.bincount(which, weights=error[of], minlength=words) * scale
        return np.concatenate([own, before.T @ error, [error.sum()]]) / n

    # the largest curvature, by the power method, bounds the step
    x, top = np.ones(words + before.shape[1] + 1), 1.0
    for _ in range(12):
        x = gradient(score(x / np.linalg.norm(x)))
        top = max(np.linalg.norm(x), 1e-9)
    step = 1 / (top / 4 * 1.1 + ridge)
    w = np.zeros(len(x))
    v, momentum = w, 1.0
    for _ in range(steps):
        slope = gradient(sigmoid(score(v)) - y)
        slope[:words] += ridge * v[:words]
        after = v - step * slope
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v = after + (momentum - 1) / faster * (after - w)
        w, momentum = after, faster
    return w


def best_threshold(chance: np.ndarray, y: np.ndarray) -> float:
    """The probability between two of those seen that separates best by F1; 0.5 without both classes.

    At least twice the share of positives (or 0.5): with few labels, positives that no weighted word tells apart
    would otherwise draw the threshold below what a document without any evidence gets.
    """
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-chance, kind="stable")
    hits = np.cumsum(y[order])
    score = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    score[:-1][np.diff(chance[order]) == 0] = 0
    best = int(np.argmax(score))
    below = chance[order[best + 1]] if best + 1 < len(y) else 0.0
    return max(float((chance[order[best]] + below) / 2), min(0.5, 2 * float(y.mean())))


def fold_of(text: bytes) -> int:
    """The fold of a text: equal words in any case and spacing have one, so that no copy is judged by its copy."""
    return zlib.crc32(b" ".join(text.lower().split())) % FOLDS


def out_of_fold(rows: list[np.ndarray], before: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """The log odds of each row by a model fitted on the rows of the other folds."""
    unseen = np.zeros(len(rows))
    for k in np.unique(fold):
        train, test = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        model = fit_linear([rows[i] for i in train], before[train], y[train])
        unseen[test] = model.log_odds([rows[i] for i in test], before[test])
    return unseen


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, fold: np.ndarray | None = None) -> tuple[list[Linear], list[float]]:
    """A model and a threshold for each column of ``labels``.

    Later models are trained with what earlier ones say out of fold: about documents they were not fitted on.
    Without ``fold``, rows are dealt to folds in turn.
    """
    fold = np.arange(len(rows)) % FOLDS if fold is None else fold
    before = np.zeros((len(rows), 0))
    chain, thresholds = [], []
    for y in labels.T.astype(float):
        unseen = out_of_fold(rows, before, y, fold)
        chain.append(fit_linear(rows, before, y))
        thresholds.append(best_threshold(sigmoid(unseen), y))
        before = np.column_stack([before, np.clip(unseen, -8, 8)])
    return chain, thresholds


def chances(chain: list[Linear], rows: list[np.ndarray]) -> np.ndarray:
    """Probability of each category (columns) for each row of features."""
    before = np.zeros((len(rows), 0))
    for model in chain:
        before = np.column_stack([before, np.clip(model.log_odds(rows, before), -8, 8)])
    return sigmoid(before)


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, max_labelled: int = MAX_LABELLED):
    """(chain, thresholds) from labelled documents, fitted in one task.

    Uses the ``max_labelled`` labelled documents that a hash of the doc_id puts first. Labels without an id, with a
    null category or of no document are left out; of several labels or texts of one id, the largest count.
    """
    kinds = [F.max(F.col(c).cast("int")).alias(f"y{i}") for i, c in enumerate(categories)]
    known = labels.dropna(subset=["doc_id", *categories]).groupBy(F.col("doc_id").cast("long").alias("_id")).agg(*kinds)
    there = docs.select(F.col("doc_id").cast("long").alias("_id")).distinct()
    chosen = known.join(there, "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), whole_text().alias("text"))
    # at most max_labelled rows of one id and the categories: small enough for every task
    kept = [f"y{i}" for i in range(len(categories))]
    found = texts.join(F.broadcast(chosen), "_id").groupBy("_id", *kept).agg(F.max("text").alias("text")).select("_id", "text", *kept)

    def extract(batches):
        for batch in few_rows(batches):
            texts = batch.column("text").to_pylist()
            words, fold = [features(t).astype(np.int32) for t in texts], [fold_of(t) for t in texts]
            columns = [batch.column("_id"), pa.array(words, pa.list_(pa.int32())), pa.array(fold, pa.int32()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "words", "fold", *batch.schema.names[2:]])

    def train(key, table):
        table = table.sort_by([("_id", "ascending")])
        words = table["words"].combine_chunks()
        values, ends = words.flatten().to_numpy(), words.offsets.to_numpy()
        rows = np.split(values, ends[1:-1] - ends[0])
        y = np.column_stack([table[f"y{i}"].to_numpy() for i in range(len(categories))])
        chain, thresholds = fit_chain(rows, y, table["fold"].to_numpy())
        out = []
        for i, (model, threshold) in enumerate(zip(chain, thresholds)):
            at = np.flatnonzero(model.words)
            out.append({"i": i, "at": at, "weight": model.words[at].astype(float), "earlier": model.earlier, "bias": model.bias, "threshold": threshold})
        kind = pa.schema([("i", pa.int32()), ("at", pa.list_(pa.int64())), ("weight", pa.list_(pa.float64())), ("earlier", pa.list_(pa.float64())), ("bias", pa.float64()), ("threshold", pa.float64())])
        return pa.Table.from_pylist(out, kind)

    labels_sql = ", ".join(f"y{i} int" for i in range(len(categories)))
    rows = found.mapInArrow(extract, f"_id long, words array<int>, fold int, {labels_sql}")
    model = "i int, at array<long>, weight array<double>, earlier array<double>, bias double, threshold double"
    fitted = sorted(rows.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(train, model).collect())
    chain, thresholds = [], []
    for row in fitted:
        words = np.zeros(FEATURES, np.float32)
        words[row["at"]] = row["weight"]
        chain.append(Linear(words, np.array(row["earlier"], float), row["bias"]))
        thresholds.append(row["threshold"])
    return chain, thresholds


def scored(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """One row per row of ``docs``: doc_id, chances (array, in the chain's order), toxic.

    ``toxic`` tells whether the last category's probability reaches the threshold that separates the labelled
    documents best out of fold. Null texts are empty. Without labelled documents all chances are null and no
    document is toxic. Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    chain, thresholds = fit(docs, labels, categories)
    if not chain:
        return rows.select("doc_id", F.lit(None).cast("array<double>").alias("chances"), F.lit(False).alias("toxic"))
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        for batch in few_rows(batches):
            found = chances(shared.value, [features(t) for t in batch.column("text").to_pylist()])
            parts = [batch.column("doc_id"), pa.array(list(found), pa.list_(pa.float64())), pa.array(found[:, -1] >= thresholds[-1])]
            yield pa.RecordBatch.from_arrays(parts, ["doc_id", "chances", "toxic"])

    return rows.mapInArrow(run, "doc_id long, chances array<double>, toxic boolean")


def without_toxic(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """The rows of ``docs`` that are not toxic, in place: no row moves to another task."""
    chain, thresholds = fit(docs, labels, categories)
    if not chain:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        for batch in few_rows(batches):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            found = chances(shared.value, [features(t) for t in texts])
            yield batch.filter(pa.array(found[:, -1] < thresholds[-1]))

    return docs.mapInArrow(run, docs.schema)
