"""Text quality from trusted positives and unlabelled text: a linear model of least non-negative unbiased risk.

With the squared loss, the risks on the positives and on the unlabelled text are quadratic in the weights. Their
coefficients are counts of features and of pairs of features, which tasks count over all documents and add up; so
the fit itself takes no sample, and its matrices do not grow with the corpus.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import few_rows, whole_text, written

#: What is measured of a text; the features are ranges of these.
MEASURES = (
    "length word_length distinct_words repeated_words distinct_triples distinct_lines line_words upper symbols calls "
    "marks digits controls spaces beyond_ascii closed_words capitals upper_words short_words long_words entropy "
    "closed_lines compressed"
).split()
#: Shares of the documents at which the ranges of a measure end, finer at both ends.
SHARES = (0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98, 0.99)
#: The L2 penalty on the weights.
RIDGE = 1e-3

_BYTES = np.arange(256)
_LETTERS = (_BYTES >= 65) & (_BYTES <= 90) | (_BYTES >= 97) & (_BYTES <= 122)
_DIGITS = (_BYTES >= 48) & (_BYTES <= 57)
_SPACES = np.isin(_BYTES, list(b" \t\n\v\f\r"))
_MARKS = np.isin(_BYTES, list(b".,;:'\"()-"))
_CALLS = np.isin(_BYTES, list(b"!?"))
_CONTROLS = (_BYTES < 32) & ~_SPACES | (_BYTES == 127)
_SYMBOLS = (_BYTES < 128) & ~(_LETTERS | _DIGITS | _SPACES | _MARKS | _CALLS | _CONTROLS)


def measured(text: bytes) -> list[float]:
    """The measures of a whole text; all are finite, also for an empty one."""
    size, words = max(len(text), 1), text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    n, n_lines = max(len(words), 1), max(len(lines), 1)
    share = np.bincount(np.frombuffer(text, np.uint8), minlength=256) / size
    seen = share[share > 0]
    return [
        np.log2(len(text) + 1),
        size / n,
        len(set(words)) / n**0.8,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(set(zip(words, words[1:], words[2:]))) / max(len(words) - 2, 1),
        len(set(lines)) / n_lines,
        n / n_lines,
        share[65:91].sum(),
        share[_SYMBOLS].sum(),
        share[_CALLS].sum(),
        share[_MARKS].sum(),
        share[_DIGITS].sum(),
        share[_CONTROLS].sum(),
        share[_SPACES].sum(),
        share[128:].sum(),
        sum(w[-1] < 128 and not w[-1:].isalnum() for w in words) / n,
        sum(65 <= w[0] <= 90 for w in words) / n,
        sum(map(bytes.isupper, words)) / n,
        sum(len(w) <= 3 for w in words) / n,
        sum(len(w) >= 16 for w in words) / n,
        -(seen * np.log2(seen)).sum(),
        sum(line[-1:] in (b".", b"!", b"?") for line in lines) / n_lines,
        len(zlib.compress(text, 1)) / size,
    ]


def with_measures(docs: DataFrame) -> DataFrame:
    """(doc_id, measures) of each row, null texts as empty ones; no row moves to another task."""

    def run(batches):
        for batch in few_rows(batches):
            found = [measured(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "measures"])

    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, measures array<double>")


def cuts_of(rows: DataFrame) -> list[np.ndarray]:
    """Where the ranges of each measure end, from all rows; none where all are the same or there are no rows."""
    cuts = [F.percentile_approx(F.col("measures")[i], list(SHARES), 2000).alias(f"m{i}") for i in range(len(MEASURES))]
    return [np.unique(found) if found else np.zeros(0) for found in rows.agg(*cuts).first()]


def ranges(measures: pa.Array, cuts: list[np.ndarray]) -> np.ndarray:
    """The feature that each measure (columns) of each row sets; all rows also have the feature 0."""
    table = np.asarray(measures.flatten()).reshape(-1, len(MEASURES))
    first = 1 + np.cumsum([0, *(len(c) + 1 for c in cuts[:-1])])
    at = [start + np.searchsorted(c, table[:, i], side="right") for i, (start, c) in enumerate(zip(first, cuts))]
    return np.column_stack([np.zeros(len(table), int), *at])


def n_features(cuts: list[np.ndarray]) -> int:
    return 1 + sum(len(c) + 1 for c in cuts)


def pair_counts(rows: DataFrame, cuts: list[np.ndarray]) -> np.ndarray:
    """How many rows have both of two features, for all pairs; the entry (0, 0) is the number of rows."""
    d = n_features(cuts)

    def count(batches):
        total = np.zeros((d, d))
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                at = ranges(batch.column(0).slice(start, 1024), cuts)
                rows = np.zeros((len(at), d), np.float32)
                np.put_along_axis(rows, at, 1, 1)
                total += rows.T @ rows  # at most 1024: exact in single precision
        pair = np.flatnonzero(np.triu(total))
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total.ravel()[pair].astype(np.int64))], ["pair", "n"])

    found = rows.select("measures").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(d * d)
    total[found["pair"]] = found["n"]
    total = total.reshape(d, d)
    return total + np.triu(total, 1).T


@dataclass
class Risks:
    """The means of the features and of their products over positives and over unlabelled rows."""

    positive: np.ndarray
    unlabelled: np.ndarray
    ridge: float = RIDGE

    def weights(self, prior: float, t: float) -> np.ndarray:
        """What minimises prior * R+(positive) + t * (R-(unlabelled) - prior * R-(positive)) and the penalty."""
        p, u = self.positive, self.unlabelled
        return np.linalg.solve(
            prior * (1 - t) * p + t * u + self.ridge * np.eye(len(p)), prior * (1 + t) * p[0] - t * u[0]
        )

    def negative(self, w: np.ndarray, prior: float) -> float:
        """R-(unlabelled) - prior * R-(positive): the risk on the negatives, as estimated without any."""

        def risk(means):
            return (1 + 2 * means[0] @ w + w @ means @ w) / 4

        return risk(self.unlabelled) - prior * risk(self.positive)

    def fitted(self, prior: float) -> np.ndarray:
        """The weights of least non-negative risk: prior * R+(positive) + max(0, risk on the negatives).

        Where the plain unbiased risk has its minimum, the risk on the negatives may be below 0, which no real
        risk is: the weights then fit the sample. The minimum is where that risk is 0, at a part t of its
        gradient between 0 and 1.
        """
        w = self.weights(prior, 1.0)
        if self.negative(w, prior) >= 0:
            return w
        low, high = 0.0, 1.0
        for _ in range(50):
            t = (low + high) / 2
            if self.negative(self.weights(prior, t), prior) < 0:
                high = t
            else:
                low = t
        return self.weights(prior, low)

    def likely_prior(self) -> float:
        """The largest share of positives for which the unbiased risk leaves the negatives a risk of 0 or more."""
        low, high = 0.0, 1.0
        for _ in range(30):
            prior = (low + high) / 2
            if self.negative(self.weights(prior, 1.0), prior) < 0:
                high = prior
            else:
                low = prior
        return low


def is_held_out(doc_id) -> F.Column:
    """Whether the labels of a document are kept for evaluation; never without a doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(rows: DataFrame, labels: DataFrame, cuts: list[np.ndarray], prior: float | None = None) -> np.ndarray | None:
    """Weights from all measured rows as unlabelled text and those labelled 1 as positives; None without any.

    A row is a positive if all labels of its doc_id are 1. The share of positives is estimated from the labelled
    rows, or from the risks if all of them are positive.
    """
    known = labels.dropna(subset=["doc_id", "quality"]).where(~is_held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") == 1).alias("_good"))
    known = written(rows.join(known, "doc_id").select("measures", "_good"))
    seen = known.agg(F.count("*"), F.count_if("_good")).first()
    if not seen[1]:
        return None
    positive, unlabelled = pair_counts(known.where("_good"), cuts), pair_counts(rows, cuts)
    risks = Risks(positive / positive[0, 0], unlabelled / unlabelled[0, 0])
    if prior is None:
        prior = seen[1] / seen[0] if seen[1] < seen[0] else risks.likely_prior()
    return risks.fitted(prior)


def scored(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 if the score is 0.5 or more).

    The score depends on nothing but the text; null is empty, and equal texts have equal scores. Labels are
    learned from rows that are not held out; labels without an id or a value, and labels of no document, are left
    out, and of several labels of one id the least counts. ``prior`` is the share of good documents if it is
    known. Without a positive all scores are 0.5. Other columns are not read.
    """
    rows = written(with_measures(docs))
    cuts = cuts_of(rows)
    weights = fit(rows, labels, cuts, prior)

    def run(batches):
        for batch in batches:
            margin = weights[ranges(batch.column("measures"), cuts)].sum(1) if weights is not None else np.zeros(batch.num_rows)
            score = np.clip((margin + 1) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    found = rows.mapInArrow(run, "doc_id long, score double")
    return found.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
