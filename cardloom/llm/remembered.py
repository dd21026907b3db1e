"""Numbers remembered by word, in bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np

CHARS_PER_SLICE = 1 << 15


def mix(x: np.ndarray) -> np.ndarray:
    """Well-mixed bits of 64-bit counters."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of ranges, one range after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def hashes(code: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of parts of a text, given by characters.  Each is mixed with its place, so the sums have no structure.

    About ``CHARS_PER_SLICE`` characters are worked on at once, each of which takes some fifty bytes.
    """
    out = np.empty(len(size), np.uint64)
    for a, b in slices(size):
        places = spans(np.zeros(b - a, np.int64), size[a:b]).astype(np.uint64)
        chars = code[spans(start[a:b], size[a:b])]
        ends = np.cumsum(size[a:b])
        out[a:b] = np.add.reduceat(mix((places << np.uint64(21)) + chars + np.uint64(1)), ends - size[a:b])
    return out


def slices(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of parts of about ``CHARS_PER_SLICE`` characters, each of one part at least."""
    slot = np.cumsum(size) // CHARS_PER_SLICE
    bounds = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), len(size)]
    yield from ((a, b) for a, b in zip(bounds, bounds[1:]) if b > a)


class Table:
    """Rows of numbers by word, or by the hash of a word, in one flat array."""

    def __init__(self, dtype):
        self.index: dict[Hashable, int] = {}
        self.start = np.zeros(1 << 10, np.int64)
        self.size = np.zeros(1 << 10, np.int64)
        self.flat = np.zeros(1 << 12, dtype)
        self.used = 0

    def add(self, words: list[Hashable], flat: np.ndarray, size: np.ndarray) -> None:
        first, last, need = len(self.index), len(self.index) + len(words), self.used + len(flat)
        if need > len(self.flat):
            self.flat = np.resize(self.flat, max(need, 2 * len(self.flat)))
        if last > len(self.start):
            self.start = np.resize(self.start, max(last, 2 * len(self.start)))
            self.size = np.resize(self.size, len(self.start))
        self.start[first:last] = self.used + np.cumsum(size) - size
        self.size[first:last] = size
        self.flat[self.used : need] = flat
        self.index.update(zip(words, range(first, last)))
        self.used = need

    def rows(self, words: Iterable[Hashable], count: int) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, words), np.int64, count)

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of ``rows`` one after the other, and how many each has."""
        size = self.size[rows]
        return self.flat[spans(self.start[rows], size)], size


class Remembered:
    """What ``learn`` gives for words, remembered in two generations.

    When more than ``most`` words, or eight times as many numbers, are held, only those needed since the
    generation began stay; a word that comes again in the next generation is copied, not learned.
    """

    def __init__(self, learn: Callable[[list], tuple[np.ndarray, np.ndarray]], dtype, most: int):
        self.learn, self.dtype, self.most = learn, dtype, most
        self.now, self.before = Table(dtype), Table(dtype)

    def ensure(self, words: set) -> Table:
        """The table with all of ``words``."""
        unseen = words.difference(self.now.index)
        if not unseen:
            return self.now
        if self.now.index and (len(self.now.index) + len(unseen) > self.most or self.now.used > 8 * self.most):
            self.before, self.now = self.now, Table(self.dtype)
            unseen = words
        old = [w for w in unseen if w in self.before.index]
        if old:
            self.now.add(old, *self.before.gather(self.before.rows(old, len(old))))
        new = [w for w in unseen if w not in self.before.index]
        if new:
            self.now.add(new, *self.learn(new))
        return self.now


class Shelf:
    """Rows of numbers by 64-bit hash: the hashes rise, and their rows stand in one flat array.  24 bytes a hash."""

    def __init__(self, dtype):
        self.hashes, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(1 << 12, dtype)
        self.used = 0

    def find(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where hashes stand or would stand, and which are known."""
        spot = np.searchsorted(self.hashes, hashed)
        known = spot < len(self.hashes)
        known[known] = self.hashes[spot[known]] == hashed[known]
        return spot, known

    def add(self, hashed: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        """Add rising hashes that are not known yet."""
        need = self.used + len(flat)
        if need > len(self.flat):
            wider = np.zeros(max(need, len(self.flat) * 3 // 2), self.flat.dtype)
            wider[: self.used] = self.flat[: self.used]
            self.flat = wider
        self.flat[self.used : need] = flat
        spot = np.searchsorted(self.hashes, hashed)
        for name, new in {"hashes": hashed, "start": self.used + np.cumsum(size) - size, "size": size}.items():
            setattr(self, name, np.insert(getattr(self, name), spot, new))
        self.used = need

    def gather(self, spot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows at ``spot`` one after the other, and how many numbers each has."""
        size = self.size[spot]
        return self.flat[spans(self.start[spot], size)], size


class RememberedHashes:
    """What ``learn`` gives for some of the hashes asked for, by their places, remembered like :class:`Remembered` does, without an object a word."""

    def __init__(self, dtype, most: int):
        self.dtype, self.most = dtype, most
        self.now, self.before = Shelf(dtype), Shelf(dtype)

    def ensure(self, hashed: np.ndarray, learn: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[Shelf, np.ndarray]:
        """The shelf with all of ``hashed``, which rise and differ, and where they stand."""
        spot, known = self.now.find(hashed)
        if known.all():
            return self.now, spot
        unseen = np.flatnonzero(~known)
        if len(self.now.hashes) and (len(self.now.hashes) + len(unseen) > self.most or self.now.used > 8 * self.most):
            self.before, self.now = self.now, Shelf(self.dtype)
            unseen = np.arange(len(hashed))
        spot, old = self.before.find(hashed[unseen])
        if old.any():
            self.now.add(hashed[unseen[old]], *self.before.gather(spot[old]))
        if not old.all():
            self.now.add(hashed[unseen[~old]], *learn(unseen[~old]))
        return self.now, np.searchsorted(self.now.hashes, hashed)
