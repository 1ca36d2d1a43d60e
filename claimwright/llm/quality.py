"""Quality scores from positive-unlabelled learning over dense measurements of the text."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.labelled import (
    fold,
    positive_unlabelled_sample,
    sampled_texts,
    with_computed,
)
from claimwright.llm.pu import Network, fit

HIDDEN = 16
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5

_DIGITS = slice(ord("0"), ord("9") + 1)
_UPPER = slice(ord("A"), ord("Z") + 1)
_MARKS = b"!?.,;:|#*$%&<>{}()/\\=_-+@~^\"'"
MEASUREMENTS = 15 + len(_MARKS)


def measure(text: bytes) -> list[float]:
    """Lengths, repetition, case, digits and the density of each mark; all zero if empty."""
    words = text.split()
    if not words:
        return [0.0] * MEASUREMENTS
    n = len(words)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = len(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    seen = Counter(words)
    share = counts[counts > 0] / size
    return [
        np.log1p(n),
        np.log1p(size / n),
        len(seen) / n,
        max(seen.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        np.log1p(sum(c for c in seen.values() if c > 1)) / np.log1p(n),
        np.log1p(len(lines)),
        len(set(lines)) / len(lines),
        np.log1p(max(map(len, words))),
        -(share * np.log(share)).sum(),
        counts[_UPPER].sum() / size,
        counts[_DIGITS].sum() / size,
        counts[0x80:].sum() / size,
        (counts[9:14].sum() + counts[32]) / size,
        sum(line[-1:] in b".!?" for line in lines) / len(lines),
        *(counts[list(_MARKS)] / n),
    ]


def measured(texts: list) -> np.ndarray:
    """One row of measurements a text; null counts as empty."""
    rows = [measure(text.encode() if isinstance(text, str) else text or b"") for text in texts]
    return np.array(rows, dtype=np.float64).reshape(-1, MEASUREMENTS)


@dataclass
class QualityModel:
    network: Network
    mean: np.ndarray
    spread: np.ndarray
    prior: float

    def scores(self, texts: list) -> np.ndarray:
        return self.network.scores(_scaled(measured(texts), self.mean, self.spread))


def _scaled(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / spread, -6.0, 6.0)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    training: Column | None = None,
    *,
    label: str = "quality",
    max_positive: int = 6_000,
    max_unlabelled: int = 12_000,
) -> QualityModel | None:
    """A classifier from a bounded sample of trusted positives and unlabelled texts.

    ``training`` is a test on the rows of ``labels``. At most ``max_positive`` positives
    and ``max_unlabelled`` other rows are drawn; their measurements, a fixed number a text,
    go to the driver. The class prior is estimated over all labelled rows. None if there
    is nothing to learn from.
    """
    sample, prior = positive_unlabelled_sample(
        labels,
        label,
        F.lit(True) if training is None else training,
        max_positive,
        max_unlabelled,
    )
    # At most max_positive + max_unlabelled rows of an id and a flag.
    texts = sampled_texts(docs, sample)
    field = T.StructField("x", T.ArrayType(T.DoubleType()))
    rows = with_computed(
        texts, ["doc_id", "positive"], "text", [field], lambda t: [pa.array(list(measured(t)))]
    ).collect()
    rows.sort(key=lambda r: (r.positive, r.doc_id, r.x))
    x = np.array([r.x for r in rows], dtype=np.float64).reshape(-1, MEASUREMENTS)
    positive = np.array([r.positive for r in rows], dtype=bool)
    if not positive.any():
        return None
    mean = x[~positive].mean(axis=0)
    spread = x[~positive].std(axis=0) + 1e-3
    x = _scaled(x, mean, spread)
    network = fit(x[positive], x[~positive], prior, hidden=HIDDEN)
    return QualityModel(network, mean, spread, prior)


def score_quality(
    docs: DataFrame, model: QualityModel | None, keep: list[str], into: str = "score"
) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the score, from 0 to 1, of every whole text.

    Null and empty texts are scored as texts without words. Without a model every score
    is 0.5: nothing is known against any text.
    """

    def compute(texts: list) -> list[pa.Array]:
        if model is None:
            return [pa.array(np.full(len(texts), 0.5))]
        return [pa.array(model.scores(texts))]

    return with_computed(docs, keep, "text", [T.StructField(into, T.DoubleType())], compute)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Labels are learned only outside the held-out fold. Rows without an id are not held out;
    a repeated row is scored again; no rows give no rows. Other columns are ignored.
    """
    model = fit_quality(docs, labels, fold("doc_id", FOLDS) != HELD_OUT)
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return score_quality(docs, model, ["doc_id"]).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
