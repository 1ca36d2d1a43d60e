"""Non-negative positive-unlabelled learning on a bounded sample.

The unlabelled risk of "negative" is corrected by the share of positives hidden in it:
``risk = prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])``. Where the
second part of a mini-batch falls below zero, the model has begun to memorise the
positives, and the step goes the other way along it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


@dataclass
class Network:
    """A linear classifier, or one with a hidden layer of ``tanh`` units beside it."""

    weights: list[np.ndarray]

    @classmethod
    def new(cls, inputs: int, hidden: int, rng: np.random.Generator) -> Network:
        weights = [np.zeros(inputs), np.zeros(1)]
        if hidden:
            weights += [
                rng.normal(0, 1 / np.sqrt(inputs), (inputs, hidden)),
                np.zeros(hidden),
                rng.normal(0, 1 / np.sqrt(hidden), hidden),
            ]
        return cls([w.astype(np.float32) for w in weights])

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = x @ self.weights[0] + self.weights[1]
        if len(self.weights) > 2:
            out = out + np.tanh(x @ self.weights[2] + self.weights[3]) @ self.weights[4]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x))

    def gradient(self, x: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        """Derivatives of the weights, given that of every row's logit."""
        slope = slope.astype(np.float32)
        found = [slope @ x, np.array([slope.sum()])]
        if len(self.weights) > 2:
            unit = np.tanh(x @ self.weights[2] + self.weights[3])
            inner = np.outer(slope, self.weights[4]) * (1 - unit * unit)
            found += [x.T @ inner, inner.sum(axis=0), unit.T @ slope]
        return found


def fit(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    prior: float,
    *,
    hidden: int = 0,
    only_adds: bool = False,
    decay: float = 1e-4,
    steps: int = 400,
    batch: int = 4096,
    rate: float = 0.01,
    seed: int = 0,
) -> Network:
    """A classifier of logistic loss with the least non-negative unbiased risk.

    Batches are large, because a batch that happens to hold few positives makes the
    corrected risk look negative.

    With ``only_adds`` the linear weights stay at or above zero: each input can only speak
    for the positive class.
    """
    rng = np.random.default_rng(seed)
    positive, unlabelled = positive.astype(np.float32), unlabelled.astype(np.float32)
    model = Network.new(positive.shape[1], hidden, rng)
    first = [np.zeros_like(w) for w in model.weights]
    second = [np.zeros_like(w) for w in model.weights]
    for step in range(1, steps + 1):
        p = positive[rng.integers(0, len(positive), min(batch, len(positive)))]
        u = unlabelled[rng.integers(0, len(unlabelled), min(batch, len(unlabelled)))]
        on_p, on_u = model.logits(p), model.logits(u)
        corrected = np.logaddexp(0, on_u).mean() - prior * np.logaddexp(0, on_p).mean()
        as_positive = -prior * sigmoid(-on_p) / len(p)
        # Slopes of E_U[loss(-)] - prior * E_P[loss(-)].
        of_u, of_p = sigmoid(on_u) / len(u), -prior * sigmoid(on_p) / len(p)
        if corrected >= 0:
            of_p = of_p + as_positive
        else:
            of_u, of_p = -of_u, -of_p
        grown = [a + b for a, b in zip(model.gradient(u, of_u), model.gradient(p, of_p))]
        speed = rate * (1 - step / (steps + 1))
        for k, (w, g) in enumerate(zip(model.weights, grown)):
            if w.size > 1:
                g = g + decay * w
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            mean, spread = first[k] / (1 - 0.9**step), second[k] / (1 - 0.999**step)
            w -= (speed * mean / (np.sqrt(spread) + 1e-8)).astype(np.float32)
        if only_adds:
            np.maximum(model.weights[0], 0, out=model.weights[0])
    return model
