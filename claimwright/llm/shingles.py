"""Sets of word shingles, and blocks of which two similar sets share at least one.

A set's tokens are dealt by their value into slightly more blocks than two similar sets can
differ in tokens. So some block is the same in both, and its hash is a key under which they
meet. Few sets that are not similar agree in a whole block.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import xxhash

from claimwright.llm.perfect_hash import mixed

# More blocks than differences by this many; see ``block_keys``.
SPARE = 3


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """64-bit hashes of the distinct ``size``-word shingles, in ascending order.

    A-Z are lower-cased and ASCII white space separates words. A text of fewer words is one
    shingle; a text without words, or null, has none.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    found = mixed(hashes[: len(hashes) - size + 1], size)
    for k in range(1, size):
        found = mixed(found + hashes[k : len(hashes) - size + 1 + k], k)
    return np.unique(found)


def set_id(tokens: np.ndarray) -> int:
    """One hash of a whole set, as a signed 64-bit number."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def odd_sketch(tokens: np.ndarray) -> np.ndarray:
    """256 bits: which of 256 classes of tokens hold an odd number of the set.

    Two sketches differ in at most as many bits as the sets differ in tokens.
    """
    counts = np.bincount((mixed(tokens, 17) >> np.uint64(56)).astype(np.int64), minlength=256)
    return np.packbits(counts & 1).view(np.int64)


def grown_sketch(tokens: np.ndarray) -> bytes:
    """Which classes of tokens hold an odd number of the set; a class a token or more.

    The classes are a power of two, at least 64, so a longer sketch folds to a shorter one.
    Folded to the same length, two sketches differ in at most as many bits as the sets
    differ in tokens, and in few less while the classes are as many as the tokens.
    """
    classes = max(64, 1 << (len(tokens) - 1).bit_length())
    held = (mixed(tokens, 17) & np.uint64(classes - 1)).astype(np.int64)
    return np.packbits(np.bincount(held, minlength=classes) & 1).tobytes()


def near_sketches(
    left: tuple[np.ndarray, list[bytes]], right: tuple[np.ndarray, list[bytes]], percent: int
) -> np.ndarray:
    """Which sets of ``left`` may be similar to one of ``right``, by sizes and grown sketches.

    What is left out cannot reach a similarity of ``percent``. Only sketches of one length,
    or of one and twice that length, belong to sets of sizes near enough.
    """
    found = np.zeros(len(left[0]), dtype=bool)
    others = _by_length(*right)
    for length, (at, sizes, bits) in _by_length(*left).items():
        for other in (length // 2, length, 2 * length):
            if other not in others:
                continue
            _, other_sizes, other_bits = others[other]
            a, b = sizes[:, None], other_sizes[None, :]
            able = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
            x, y = able.any(axis=1), able.any(axis=0)
            if not x.any():
                continue
            width = min(bits.shape[1], other_bits.shape[1])
            one, two = _folded(bits[x], width), _folded(other_bits[y], width)
            apart = np.bitwise_count(one[:, None] ^ two[None, :]).sum(axis=2, dtype=np.int64)
            near = (100 + percent) * apart <= (100 - percent) * (a[x] + b[:, y])
            found[at[x]] |= (near & able[np.ix_(x, y)]).any(axis=1)
    return found


def _by_length(sizes: np.ndarray, sketches: list[bytes]) -> dict[int, tuple[np.ndarray, ...]]:
    """Places, sizes and bits of the sketches of every length."""
    lengths = np.array([len(sketch) for sketch in sketches])
    found = {}
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        bits = np.frombuffer(b"".join(sketches[k] for k in at), "<u8").reshape(len(at), -1)
        found[length] = at, sizes[at], bits
    return found


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    return bits if bits.shape[1] == width else bits[:, :width] ^ bits[:, width:]


class Blocks:
    """Block keys for a similarity of ``percent``: shared tokens over all tokens, in percent.

    Sets are classed by size so that similar ones fall into one class or the next. Each set
    publishes its blocks on the scale of its own class and on that of the class below.
    """

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.lows = [1]

    def _extend(self, size: int) -> None:
        while self.lows[-1] <= size:
            self.lows.append(100 * self.lows[-1] // self.percent + 1)

    def differences(self, scale: int) -> int:
        """Most tokens in which two similar sets can differ, the smaller one of this class."""
        p, most = self.percent, self.lows[scale + 1] - 1
        return (most + 100 * most // p) * (100 - p) // (100 + p)

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """The keys of a set of hashed tokens in ascending order.

        With ``SPARE`` more blocks than differences, that many agree. Two sets that have
        fewer than ``SPARE`` empty blocks must therefore share one that is not empty, so
        only a set with more empty blocks publishes those too.
        """
        if not len(tokens):
            return np.empty(0, np.uint64)
        self._extend(len(tokens))
        own = bisect_right(self.lows, len(tokens)) - 1
        sums = np.r_[np.uint64(0), np.cumsum(mixed(tokens, 3), dtype=np.uint64)]
        found = []
        for scale in (own, own - 1):
            if scale < 0:
                continue
            n = self.differences(scale) + SPARE
            edges = (np.arange(n + 1, dtype=np.float64) / n * 2.0**64)[1:-1].astype(np.uint64)
            cuts = np.r_[0, np.searchsorted(tokens, edges), len(tokens)]
            keys = mixed(sums[cuts[1:]] - sums[cuts[:-1]], 5)
            keys = mixed(keys + np.arange(n, dtype=np.uint64), 11 + scale)
            full = cuts[1:] > cuts[:-1]
            found.append(keys if n - full.sum() >= SPARE else keys[full])
        return np.concatenate(found)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of two lists, in bounded memory."""
    sizes = np.zeros((len(left), len(right)), dtype=np.float32)
    sides = []
    for sets in (left, right):
        tokens = np.concatenate(sets)
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        sides.append((tokens[order], rows[order]))
    common = np.intersect1d(np.unique(sides[0][0]), np.unique(sides[1][0]))
    for start in range(0, len(common), 2_048):
        part = common[start : start + 2_048]
        marked = []
        for (tokens, rows), sets in zip(sides, (left, right)):
            a, b = np.searchsorted(tokens, part[0]), np.searchsorted(tokens, part[-1], "right")
            at = np.searchsorted(part, tokens[a:b])
            hit = part[np.minimum(at, len(part) - 1)] == tokens[a:b]
            matrix = np.zeros((len(sets), len(part)), dtype=np.float32)
            matrix[rows[a:b][hit], at[hit]] = 1
            marked.append(matrix)
        sizes += marked[0] @ marked[1].T
    return sizes.astype(np.int64)
