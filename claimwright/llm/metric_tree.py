"""Metric trees of integer vectors, built middle-out by the anchors hierarchy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Balls of at most this many points are not split.
LEAF_POINTS = 48


class MetricTree:
    """A binary tree of balls around the points of a chunk.

    The points are kept in the order of the leaves, so every ball is a range of them.
    ``rows`` has the place each point had at first. A ball caches its number of points
    (the length of its range) and their sum; its centre is their mean and its radius
    reaches the farthest of them. ``left`` and ``right`` are -1 for a leaf.
    """

    FIELDS = ("points", "rows", "starts", "ends", "left", "right", "sums", "radii")

    def __init__(self, **fields: np.ndarray) -> None:
        for name in self.FIELDS:
            setattr(self, name, fields[name])
        self.points = self.points.astype(np.int64)
        counts = np.maximum(self.ends - self.starts, 1)
        self.centres = self.sums / counts[:, None]

    def fields(self) -> dict[str, np.ndarray]:
        """What makes up the tree; scaled components fit in four bytes."""
        kept = {name: getattr(self, name) for name in self.FIELDS}
        return kept | {"points": self.points.astype(np.int32)}

    @classmethod
    def build(cls, points: np.ndarray) -> MetricTree:
        """A tree of the rows of ``points``, integers; there has to be one at least."""
        return _Builder(points).tree()

    def owned(self, entries: np.ndarray) -> Iterator[tuple[int, int, int | np.ndarray, int]]:
        """``start, end, entry, ball`` ranges that together cover all points.

        ``entry`` is the nearest row of ``entries`` by squared distance, ties going to the
        smaller index. A ball that one entry owns wholly comes as one range with its
        number; the points of an undecided leaf come with an entry each and -1.

        A ball inherits the entries that may be nearest somewhere in its parent. Of two
        entries the difference of their squared distances is linear, so one is ruled out
        if it is farther than the entry nearest to the centre all over the ball. Rounding
        can only keep an entry too many: what is left is compared in integers.
        """
        exact = entries.astype(np.int64)
        # Of equal entries the first one takes all.
        distinct = np.unique(exact, axis=0, return_index=True)[1] if exact.shape[1] else [0]
        places = exact.astype(np.float64)
        stack = [(len(self.starts) - 1, np.sort(distinct))]
        while stack:
            ball, candidates = stack.pop()
            start, end, radius = int(self.starts[ball]), int(self.ends[ball]), self.radii[ball]
            near = places[candidates]
            squares = np.square(near - self.centres[ball]).sum(1)
            best = int(squares.argmin())
            apart = np.sqrt(np.square(near - near[best]).sum(1))
            slack = 1e-6 + 1e-9 * (squares + squares[best] + radius * radius)
            candidates = candidates[squares - squares[best] - 2 * radius * apart <= slack]
            if len(candidates) == 1:
                yield start, end, int(candidates[0]), ball
            elif radius == 0:
                found = _nearest(self.points[start : start + 1], exact[candidates])
                yield start, end, int(candidates[found[0]]), ball
            elif self.left[ball] < 0:
                found = _nearest(self.points[start:end], exact[candidates])
                yield start, end, candidates[found], -1
            else:
                stack.append((int(self.right[ball]), candidates))
                stack.append((int(self.left[ball]), candidates))

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry of every point and the squared distance to it, in first order."""
        codes = np.empty(len(self.points), np.int64)
        for start, end, entry, _ in self.owned(entries):
            codes[start:end] = entry
        errors = np.square(self.points - entries[codes]).sum(1)
        placed_codes, placed_errors = np.empty_like(codes), np.empty_like(errors)
        placed_codes[self.rows], placed_errors[self.rows] = codes, errors
        return placed_codes, placed_errors

    def totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and number of the points of every entry, wholly owned balls by their caches."""
        sums = np.zeros(entries.shape, np.int64)
        counts = np.zeros(len(entries), np.int64)
        for start, end, entry, ball in self.owned(entries):
            if ball >= 0:
                sums[entry] += self.sums[ball]
                counts[entry] += end - start
            else:
                np.add.at(sums, entry, self.points[start:end])
                np.add.at(counts, entry, 1)
        return sums, counts


def _nearest(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact places of the nearest entries; of ties the first."""
    return np.square(points[:, None, :] - entries[None, :, :]).sum(2).argmin(1)


class _Builder:
    """Collects the balls of one tree, children before parents."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points.astype(np.int64)
        self.places = self.points.astype(np.float64)
        self.balls: list[tuple[int, int, np.ndarray, float]] = []  # left, right, sum, radius
        self.members: dict[int, np.ndarray] = {}  # ball -> places of its points

    def tree(self) -> MetricTree:
        root = self._ball(np.arange(len(self.points)))
        order, starts, ends = self._laid_out(root)
        left, right, sums, radii = zip(*self.balls)
        return MetricTree(
            points=self.points[order],
            rows=order,
            starts=starts,
            ends=ends,
            left=np.array(left),
            right=np.array(right),
            sums=np.array(sums).reshape(len(self.balls), -1),
            radii=np.array(radii),
        )

    def _ball(self, members: np.ndarray) -> int:
        """The number of a new ball of ``members``, with all balls below it."""
        if len(members) > LEAF_POINTS:
            anchors = self._anchors(members, int(np.ceil(np.sqrt(len(members)))))
            if len(anchors) > 1:
                return self._merged([self._ball(anchor) for anchor in anchors])
        return self._add(-1, -1, members)

    def _add(self, left: int, right: int, members: np.ndarray) -> int:
        total = self.points[members].sum(0)
        gaps = self.places[members] - total / len(members)
        radius = float(np.sqrt(np.square(gaps).sum(1).max()))
        self.balls.append((left, right, total, radius))
        self.members[len(self.balls) - 1] = members
        return len(self.balls) - 1

    def _anchors(self, members: np.ndarray, wanted: int) -> list[np.ndarray]:
        """``members`` dealt to anchors, each the nearest one to its points.

        A new anchor is the point farthest from the anchor with the widest reach. It takes
        points only from beyond half its distance to an anchor, and those lists are sorted.
        """

        def distances(some: np.ndarray, pivot: int) -> np.ndarray:
            return np.sqrt(np.square(self.places[some] - self.places[pivot]).sum(1))

        def farthest_first(some: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order = np.argsort(-gaps, kind="stable")
            return some[order], gaps[order]

        pivots = [int(members[0])]
        lists = [farthest_first(members, distances(members, pivots[0]))]
        while len(pivots) < wanted:
            widest = max(range(len(lists)), key=lambda i: lists[i][1][0])
            if lists[widest][1][0] == 0:
                break
            pivot = int(lists[widest][0][0])
            halves = distances(np.array(pivots), pivot) / 2
            taken, taken_gaps = [], []
            for i, (some, gaps) in enumerate(lists):
                reach = int(np.searchsorted(-gaps, -halves[i], side="left"))
                if reach == 0:
                    continue
                new = distances(some[:reach], pivot)
                moves = new < gaps[:reach]
                if moves.any():
                    taken.append(some[:reach][moves])
                    taken_gaps.append(new[moves])
                    stay = np.concatenate([~moves, np.ones(len(some) - reach, bool)])
                    lists[i] = some[stay], gaps[stay]
            pivots.append(pivot)
            lists.append(farthest_first(np.concatenate(taken), np.concatenate(taken_gaps)))
        return [some for some, _ in lists]

    def _merged(self, balls: list[int]) -> int:
        """One ball over all, joining the two whose common ball is smallest each time."""
        while len(balls) > 1:
            sums = np.array([self.balls[ball][2] for ball in balls], np.float64)
            counts = np.array([len(self.members[ball]) for ball in balls], np.float64)
            reaches = np.array([self.balls[ball][3] for ball in balls])
            if len(balls) > 2:
                centres = sums / counts[:, None]
                apart = np.sqrt(np.square(centres[:, None] - centres[None]).sum(2))
                share = counts[:, None] / (counts[:, None] + counts[None])
                # The common centre lies between the two, nearer to the heavier one.
                bound = np.maximum(apart * (1 - share) + reaches[:, None], apart * share + reaches[None])
                np.fill_diagonal(bound, np.inf)
                one, two = sorted(int(i) for i in np.unravel_index(bound.argmin(), bound.shape))
            else:
                one, two = 0, 1
            joined = np.concatenate([self.members[balls[one]], self.members[balls[two]]])
            ball = self._add(balls[one], balls[two], joined)
            balls = [b for i, b in enumerate(balls) if i not in (one, two)] + [ball]
        return balls[0]

    def _laid_out(self, root: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = np.zeros(len(self.balls), np.int64)
        ends = np.zeros(len(self.balls), np.int64)
        order, at, stack = [], 0, [(root, False)]
        while stack:
            ball, done = stack.pop()
            left, right = self.balls[ball][:2]
            if left < 0:
                starts[ball], at = at, at + len(self.members[ball])
                order.append(self.members[ball])
                ends[ball] = at
            elif done:
                starts[ball], ends[ball] = starts[left], ends[right]
            else:
                stack += [(ball, True), (right, False), (left, False)]
        return np.concatenate(order), starts, ends
