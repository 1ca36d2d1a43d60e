"""Toxicity scores from positive-unlabelled learning over telling words."""

from __future__ import annotations

from dataclasses import dataclass

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
from claimwright.llm.storage import written

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3

# ASCII bytes other than letters and digits separate words.
_SEPARATORS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


# Beginnings of words, in bytes: they carry over to inflected forms never seen.
_BEGINNINGS = (4, 5, 6)


def marks_of(text: str | None) -> set[bytes]:
    """The distinct lower-case words of a text and their beginnings; none of a null.

    Punctuation is dropped. A beginning ends in ``*`` to tell it from a word.
    """
    if not text:
        return set()
    words = set(text.lower().encode("utf-8", "replace").translate(_SEPARATORS).split())
    long = [w for w in words if len(w) > _BEGINNINGS[0]]
    for size in _BEGINNINGS:
        words.update({w[:size] + b"*" for w in long if len(w) > size})
    return words


@dataclass
class ToxicityModel:
    """Several linear classifiers over the presence of words and beginnings; their mean counts."""

    words: dict[bytes, int]
    networks: list[Network]
    prior: float

    def scores(self, texts: list) -> np.ndarray:
        weights = np.mean([n.weights[0] for n in self.networks], axis=0)
        bias = np.mean([n.weights[1][0] for n in self.networks])
        at, known = self.words, self.words.keys()
        logits = [bias + sum(weights[at[w]] for w in marks_of(t) & known) for t in texts]
        return 1 / (1 + np.exp(-np.clip(np.array(logits, dtype=np.float64), -40, 40)))


def telling_words(sample: DataFrame, prior: float, max_words: int, least: int) -> list[bytes]:
    """The strongest marks of positives.

    ``sample`` has ``positive`` and ``words``. A mark has to be in ``least`` positives, and
    by the prior at least half of the unlabelled texts that hold it have to be positive.
    Marks are ranked by the log-likelihood ratio of the two shares, which also serves where
    counts are small.
    """
    p, u = sample.agg(
        F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")
    ).first()
    if not p or not u:
        return []
    by_word = (
        sample.select("positive", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count_if("positive").alias("in_p"), F.count_if(~F.col("positive")).alias("in_u"))
        .where((F.col("in_p") >= least) & (F.col("in_p") * (prior / p) >= F.col("in_u") * (0.5 / u)))
    )
    in_p, in_u = F.col("in_p"), F.col("in_u")
    pooled = (in_p + in_u) / (p + u)
    from_u = F.when(in_u > 0, in_u * F.log(in_u / (pooled * u))).otherwise(0.0)
    ranked = by_word.withColumn("rank", in_p * F.log(in_p / (pooled * p)) + from_u)
    top = ranked.where("rank > 4").orderBy(F.desc("rank"), "word").limit(max_words)
    return [bytes(row.word) for row in top.select("word").collect()]


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    training: Column | None = None,
    *,
    label: str = "toxic",
    max_positive: int = 4_000,
    max_unlabelled: int = 12_000,
    max_words: int = 512,
    least: int = 3,
    members: int = 3,
) -> ToxicityModel | None:
    """Classifiers from a bounded sample of confirmed toxic and of unlabelled texts.

    ``training`` is a test on the rows of ``labels``. At most ``max_positive`` toxic rows
    and ``max_unlabelled`` others are drawn. Up to ``max_words`` telling words, each in at
    least ``least`` toxic texts, are the inputs; only the places of these words in each
    drawn text go to the driver. None if there is nothing to learn from.
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
    field = T.StructField("words", T.ArrayType(T.BinaryType()))

    def split(batch: list) -> list[pa.Array]:
        return [pa.array([sorted(marks_of(t)) for t in batch], pa.list_(pa.binary()))]

    drawn = written(
        with_computed(texts, ["doc_id", "positive"], "text", [field], split), "toxicity-sample"
    )
    words = {word: k for k, word in enumerate(telling_words(drawn, prior, max_words, least))}
    if not words:
        return None

    def places(batch: list) -> list[pa.Array]:
        found = [sorted(words[w] for w in row if w in words) for row in batch]
        return [pa.array(found, pa.list_(pa.int32()))]

    at = T.StructField("at", T.ArrayType(T.IntegerType()))
    rows = with_computed(drawn, ["doc_id", "positive"], "words", [at], places).collect()
    rows.sort(key=lambda r: (r.positive, r.doc_id, r.at))
    x = np.zeros((len(rows), len(words)), dtype=np.float32)
    for k, row in enumerate(rows):
        x[k, row.at] = 1
    positive = np.array([row.positive for row in rows], dtype=bool)
    networks = [
        fit(x[positive], x[~positive], prior, only_adds=True, rate=0.1, seed=k)
        for k in range(members)
    ]
    return ToxicityModel(words, networks, prior)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Labels are learned only outside the held-out fold. Null and empty texts are scored as
    texts without words; without anything to learn from, every score is 0. Rows without an
    id are not held out; a repeated row is scored again; no rows give no rows. Other
    columns are ignored.
    """
    model = fit_toxicity(docs, labels, fold("doc_id", FOLDS) != HELD_OUT)

    def compute(texts: list) -> list[pa.Array]:
        return [pa.array(np.zeros(len(texts)) if model is None else model.scores(texts))]

    scored = with_computed(
        docs, ["doc_id"], "text", [T.StructField("score", T.DoubleType())], compute
    )
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
