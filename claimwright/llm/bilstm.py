"""A bidirectional LSTM over sequences of blocks, in numpy.

A block comes in as weighted tokens of its tag path, hashed words and a few measurements.
Both kinds of tokens have learnt vectors, which are averaged; the LSTM reads the sequence
in both directions, and a logistic unit sees both states and the block itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PATH_BUCKETS, WORD_BUCKETS = 1 << 13, 1 << 12
PATH_SIZE, WORD_SIZE, MEASURES = 16, 12, 8
INPUT = PATH_SIZE + WORD_SIZE + MEASURES
HIDDEN = 16

# Cells of a batch of padded sequences; longer sequences come alone.
CELLS = 1 << 14


@dataclass
class Sequence:
    """The blocks of a page: tokens with the place their block starts at, and measurements."""

    path_ids: np.ndarray
    path_weights: np.ndarray
    path_starts: np.ndarray
    word_ids: np.ndarray
    word_starts: np.ndarray
    measures: np.ndarray

    def __len__(self) -> int:
        return len(self.measures)


def initial(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def drawn(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    model = {
        "path": drawn(PATH_BUCKETS, PATH_SIZE, scale=0.3),
        "word": drawn(WORD_BUCKETS, WORD_SIZE, scale=0.3),
        "out": drawn(2 * HIDDEN + INPUT, scale=0.1),
        "out_bias": np.zeros(1, np.float32),
    }
    for side in ("forth", "back"):
        model[f"{side}_in"] = drawn(INPUT, 4 * HIDDEN, scale=INPUT**-0.5)
        model[f"{side}_state"] = drawn(HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5)
        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN : 2 * HIDDEN] = 1.0  # Remember at first.
        model[f"{side}_bias"] = bias
    return model


def inputs(model: dict[str, np.ndarray], sequence: Sequence) -> np.ndarray:
    """Block x input."""
    paths = model["path"][sequence.path_ids] * sequence.path_weights[:, None]
    words = model["word"][sequence.word_ids]
    counts = np.diff(np.append(sequence.word_starts, len(words)))[:, None]
    return np.concatenate(
        [
            np.add.reduceat(paths, sequence.path_starts),
            np.add.reduceat(words, sequence.word_starts) / counts,
            sequence.measures,
        ],
        axis=1,
    )


def probabilities(model: dict[str, np.ndarray], sequences: list[Sequence]) -> list[np.ndarray]:
    """For each sequence, the probability of every block."""
    order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
    found: list[np.ndarray] = [np.zeros(0)] * len(sequences)
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(sequences[order[end]]) <= CELLS:
            end += 1
        some = [sequences[i] for i in order[at:end]]
        if len(some[-1]):
            batch, places = _padded([inputs(model, s) if len(s) else None for s in some])
            logits, _ = _forward(model, batch, places)
            for i, s, row in zip(order[at:end], some, logits):
                found[i] = 1 / (1 + np.exp(-row[: len(s)]))
        at = end
    return found


def _padded(rows: list[np.ndarray | None]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences padded at the end, and the places that turn each of them around."""
    lengths = [0 if row is None else len(row) for row in rows]
    batch = np.zeros((len(rows), max(lengths), INPUT), np.float32)
    places = np.tile(np.arange(max(lengths)), (len(rows), 1))
    for i, row in enumerate(rows):
        if lengths[i]:
            batch[i, : lengths[i]] = row
            places[i, : lengths[i]] = np.arange(lengths[i] - 1, -1, -1)
    return batch, places


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(batch: np.ndarray, into: np.ndarray, state: np.ndarray, bias: np.ndarray):
    """States after every step, and what the way back needs."""
    rows, steps, _ = batch.shape
    drive = batch @ into + bias
    hidden = np.zeros((rows, HIDDEN), np.float32)
    cell = np.zeros((rows, HIDDEN), np.float32)
    states = np.empty((rows, steps, HIDDEN), np.float32)
    kept = []
    for step in range(steps):
        gates = drive[:, step] + hidden @ state
        opened = _sigmoid(gates[:, : 3 * HIDDEN])
        add, keep, show = (opened[:, i * HIDDEN : (i + 1) * HIDDEN] for i in range(3))
        new = np.tanh(gates[:, 3 * HIDDEN :])
        before, cell = cell, keep * cell + add * new
        bent = np.tanh(cell)
        kept.append((add, keep, show, new, before, bent, hidden))
        hidden = show * bent
        states[:, step] = hidden
    return states, kept


def _run_back(batch, into, state, kept, upstream):
    """Gradients of the batch, ``into``, ``state`` and the bias."""
    rows, steps, _ = batch.shape
    d_gates = np.empty((rows, steps, 4 * HIDDEN), np.float32)
    d_state = np.zeros_like(state)
    d_hidden = np.zeros((rows, HIDDEN), np.float32)
    d_cell = np.zeros((rows, HIDDEN), np.float32)
    for step in range(steps - 1, -1, -1):
        add, keep, show, new, before, bent, hidden = kept[step]
        d_hidden = d_hidden + upstream[:, step]
        d_cell = d_cell + d_hidden * show * (1 - bent * bent)
        gates = d_gates[:, step]
        gates[:, :HIDDEN] = d_cell * new * add * (1 - add)
        gates[:, HIDDEN : 2 * HIDDEN] = d_cell * before * keep * (1 - keep)
        gates[:, 2 * HIDDEN : 3 * HIDDEN] = d_hidden * bent * show * (1 - show)
        gates[:, 3 * HIDDEN :] = d_cell * add * (1 - new * new)
        d_state += hidden.T @ gates
        d_hidden, d_cell = gates @ state.T, d_cell * keep
    flat = d_gates.reshape(-1, 4 * HIDDEN)
    return d_gates @ into.T, batch.reshape(-1, INPUT).T @ flat, d_state, flat.sum(0)


def _turned(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.take_along_axis(values, places[:, :, None], axis=1)


def _forward(model: dict[str, np.ndarray], batch: np.ndarray, places: np.ndarray):
    turned = _turned(batch, places)
    forth, forth_kept = _run(batch, *(model[f"forth_{n}"] for n in ("in", "state", "bias")))
    back, back_kept = _run(turned, *(model[f"back_{n}"] for n in ("in", "state", "bias")))
    seen = np.concatenate([forth, _turned(back, places), batch], axis=2)
    return seen @ model["out"] + model["out_bias"], (turned, forth_kept, back_kept, seen)


def _gradients(model, some: list[Sequence], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Gradients of the mean log loss over the blocks of ``some`` sequences."""
    batch, places = _padded([inputs(model, s) for s in some])
    logits, (turned, forth_kept, back_kept, seen) = _forward(model, batch, places)
    errors = np.zeros_like(logits)
    total = sum(len(s) for s in some)
    for i, (s, wanted) in enumerate(zip(some, labels)):
        errors[i, : len(s)] = (_sigmoid(logits[i, : len(s)]) - wanted) / total
    found = {"out": np.tensordot(errors, seen, 2), "out_bias": errors.sum().reshape(1)}
    d_seen = errors[:, :, None] * model["out"]
    d_batch = d_seen[:, :, 2 * HIDDEN :]
    for side, source, kept, upstream in (
        ("forth", batch, forth_kept, d_seen[:, :, :HIDDEN]),
        ("back", turned, back_kept, _turned(d_seen[:, :, HIDDEN : 2 * HIDDEN], places)),
    ):
        d_input, d_in, d_state, d_bias = _run_back(
            source, model[f"{side}_in"], model[f"{side}_state"], kept, upstream
        )
        found |= {f"{side}_in": d_in, f"{side}_state": d_state, f"{side}_bias": d_bias}
        d_batch = d_batch + (d_input if side == "forth" else _turned(d_input, places))
    found["path"], found["word"] = np.zeros_like(model["path"]), np.zeros_like(model["word"])
    for i, s in enumerate(some):
        of_block = np.repeat(np.arange(len(s)), np.diff(np.append(s.path_starts, len(s.path_ids))))
        d_path = d_batch[i, of_block, :PATH_SIZE] * s.path_weights[:, None]
        np.add.at(found["path"], s.path_ids, d_path)
        counts = np.diff(np.append(s.word_starts, len(s.word_ids)))
        of_block = np.repeat(np.arange(len(s)), counts)
        d_word = d_batch[i, of_block, PATH_SIZE : PATH_SIZE + WORD_SIZE]
        np.add.at(found["word"], s.word_ids, d_word / counts[of_block][:, None])
    return found


def fitted(
    sequences: list[Sequence],
    labels: list[np.ndarray],
    rounds: int,
    at_once: int = 32,
    rate: float = 0.01,
    seed: int = 7,
) -> dict[str, np.ndarray]:
    """A model fitted by Adam, its step shrinking to nothing over the rounds."""
    model, rng = initial(seed), np.random.default_rng(seed)
    means = {name: np.zeros_like(value) for name, value in model.items()}
    squares = {name: np.zeros_like(value) for name, value in model.items()}
    steps = rounds * -(-len(sequences) // at_once)
    step = 0
    for _ in range(rounds):
        # Sequences of like length share a batch, in random order.
        order = rng.permutation(len(sequences))
        order = order[np.argsort([len(sequences[i]) for i in order], kind="stable")]
        batches = [order[at : at + at_once] for at in range(0, len(order), at_once)]
        for i in rng.permutation(len(batches)):
            step += 1
            found = _gradients(
                model, [sequences[j] for j in batches[i]], [labels[j] for j in batches[i]]
            )
            size = rate * (1 - (step - 1) / steps) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            for name, slope in found.items():
                means[name] += 0.1 * (slope - means[name])
                squares[name] += 0.001 * (slope * slope - squares[name])
                model[name] -= size * means[name] / (np.sqrt(squares[name]) + 1e-8)
    return model
