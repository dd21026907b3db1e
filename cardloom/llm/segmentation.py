"""SentencePiece encoding by Gumbel top-k without replacement, and decoding.

The segmentations of a text are the paths of its lattice of vocabulary pieces.  Sums over all ways to
finish give every edge its exact probability, so a search from the left can perturb the log
probability of whole sets of paths: each set carries the largest Gumbel value of its members,
and the set with the largest value is split next (A-star with an exact bound).  The first ``k`` single paths
are a sample of ``k`` distinct segmentations without replacement.  The next value gives
each its inclusion score.  The random numbers depend on the key of the row alone.
"""

from __future__ import annotations

import base64
import heapq
import json
import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.remembered import codes, hashes, mix, spans
from cardloom.llm.shared import blocks

SAMPLES = 2
#: Runs kept, and their edges: each takes 24 bytes.
MOST_RUNS, MOST_EDGES = 120_000, 2_500_000
#: Characters searched side by side; some hundred bytes each.
CHARS_AT_ONCE = 1 << 19
#: Sums of ways whose log may lie below minus this are not added up as they are.
LONGEST_WAY = 600.0
#: Where a text's path has this much less log probability than at its beginning, the sets that leave it are looked at only if those before give too small values.
FAR = 64.0
MOST_CHARS = 2**31 - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK = ord("▁")


def uniforms(seed: np.ndarray, *counters: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) that depend on a seed and counters alone."""
    for c in counters:
        seed = mix(seed * _BASE + np.asarray(c).astype(np.uint64) + np.uint64(1))
    return ((seed >> np.uint64(11)) + 0.5) * 2.0**-53


class Trie:
    """The beginnings of words as nodes, found by (node, next character) in a table of slots.  Node 0 is empty."""

    def __init__(self, words: list[str], ids: list[int], weights: list[float]):
        nodes = {"": 0}
        for word in words:
            for n in range(1, len(word) + 1):
                nodes.setdefault(word[:n], len(nodes))
        self.id, self.weight = np.full(len(nodes), -1, np.int32), np.zeros(len(nodes))
        self.length = np.array([len(x) for x in nodes])
        at = [nodes[w] for w in words]
        self.id[at], self.weight[at] = ids, weights
        self.depth = max(map(len, words))
        bits = (4 * len(nodes)).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.key, self.child = np.full(1 << bits, ~np.uint64(0)), np.zeros(1 << bits, np.int32)
        # The nodes of single characters stand by code, the others in the table.
        self.single = np.zeros(max(map(ord, "".join(words))) + 2, np.int32)
        for x in nodes:
            if len(x) == 1:
                self.single[ord(x)] = nodes[x]
        key = np.array([nodes[x[:-1]] << 21 | ord(x[-1]) for x in nodes if x], np.uint64)
        child, slot = np.arange(1, len(nodes), dtype=np.int32), self.slots(key)
        while len(key):
            # Of those that want a free slot one gets it, the others go on to the next.
            free = np.flatnonzero(self.key[slot] == ~np.uint64(0))
            self.key[slot[free]] = key[free]
            placed = self.key[slot] == key
            self.child[slot[placed]] = child[placed]
            key, child, slot = key[~placed], child[~placed], (slot[~placed] + 1) & self.mask

    def slots(self, key: np.ndarray) -> np.ndarray:
        return ((key * _BASE) >> self.shift).astype(np.int64)

    def begin(self, code: np.ndarray) -> np.ndarray:
        """The nodes of single characters, 0 where there is none."""
        return self.single[np.minimum(code, np.uint64(len(self.single) - 1)).astype(np.int64)]

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The nodes one character on, 0 where there is none."""
        key = node.astype(np.uint64) << np.uint64(21) | code
        slot = self.slots(key)
        held = self.key[slot]
        out = np.where(held == key, self.child[slot], np.int32(0))
        at = np.flatnonzero((held != key) & (held != ~np.uint64(0)))
        while len(at):
            spot = slot[at] = (slot[at] + 1) & self.mask
            held = self.key[spot]
            hit = held == key[at]
            out[at[hit]] = self.child[spot[hit]]
            at = at[~hit & (held != ~np.uint64(0))]
        return out


@lru_cache(2)
def vocabulary(path: str) -> tuple[list[tuple[str, int, float]], dict[int, int], list[bytes], bool, int]:
    """Pieces with ids and scores, the ids of bytes, the bytes of every id, whether scores are ranks, and the number of ids."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.get_piece_size()
    named, byte, raw = [], {}, []
    for i in range(size):
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte[int(name[3:5], 16)] = i
            raw.append(bytes([int(name[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            raw.append(b"")
        else:
            named.append((name, i, sp.get_score(i)))
            raw.append(name.replace("▁", " ").encode())
    return named, byte, raw, all(float(sp.get_score(i)).is_integer() for i in range(size)), size


class Lattice:
    """Edges of the lattices of runs between blanks.

    No piece spans a blank in its middle, so the lattice of a text falls apart into runs, and the
    lattice of a run is built once, with many others together.  Runs are known by a 64-bit hash.  When more than
    ``MOST_RUNS`` or ``MOST_EDGES`` would be held, those needed in most calls stay.  A
    state is a place in a run; its edges stand together, shortest piece first.  A vocabulary
    whose scores are merge ranks gets weights by Zipf's law, ``-log(rank + 10)``; other scores are log
    probabilities.  Characters without a piece are their bytes.
    """

    def __init__(self, path: str, temperature: float = 1.0):
        named, self.byte, self.raw, ranked, size = vocabulary(path)
        names = [name for name, _, _ in named]
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError("a piece spans a blank")
        # Runs of blanks have no rank: they stand behind all others.
        weights = [(-math.log(min(-score, size) + 10) if ranked else score) / temperature for _, _, score in named]
        self.per_byte = -math.log(size) / temperature
        self.trie = Trie(names, [i for _, i, _ in named], weights)
        self.first = np.empty(1 << 12, np.int64)
        self.cut, self.logp = np.empty(1 << 14), np.empty(1 << 14)
        self.next, self.piece = np.empty(1 << 14, np.int32), np.empty(1 << 14, np.int32)
        self.reset()

    def reset(self) -> None:
        # The runs by rising hash: where each begins, how long it is, and in how many calls it was needed lately.
        self.hashes, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.uses = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.filled = self.used = 0

    def learn(self, code: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Lattices of runs that stand one after the other, with the exact probability of each edge given its state."""
        places = len(code)
        ends = np.cumsum(size)
        end = np.repeat(ends, size)
        here, node = np.arange(places), self.trie.begin(code)
        left = end - here
        where, found = [], []
        for n in range(1, self.trie.depth + 1):
            if n > 1:
                fits = np.flatnonzero(left[here] >= n)
                here = here[fits]
                node = self.trie.step(node[fits], code[here + (n - 1)])
            begun = np.flatnonzero(node)
            here, node = here[begun], node[begun]
            hit = np.flatnonzero(self.trie.id[node] >= 0)
            where.append(here[hit])
            found.append(node[hit])
            if n == 1:
                alone = np.ones(places, bool)
                alone[where[0]] = False
                lost = np.flatnonzero(alone)
        where.insert(0, lost)
        found.insert(0, np.zeros(len(lost), np.int32))
        # Lengths rise from list to list, so the edges of a place are put one after the other, the shortest first.
        number = np.bincount(np.concatenate(where), minlength=places)
        spot = np.cumsum(number)
        edges = int(spot[-1])
        spot -= number
        first = spot.copy()
        node = np.empty(edges, np.int32)
        for at, nodes in zip(where, found):
            order = spot[at]
            node[order] = nodes
            spot[at] = order + 1
        widths, pieces, weights = self.trie.length[node], self.trie.id[node], self.trie.weight[node]
        if len(lost):
            # A character as its bytes: the id of a single one, and minus the code, less one, for more.
            c, at = code[lost].astype(np.int64), first[lost]
            single = np.array([self.byte[b] for b in range(128)])
            widths[at] = 1
            pieces[at] = np.where(c < 128, single[np.minimum(c, 127)], -c - 1)
            weights[at] = self.per_byte * (1 + (c > 0x7F) + (c > 0x7FF).astype(int) + (c > 0xFFFF))
        target = np.repeat(np.arange(places), number) + widths
        last = target == np.repeat(end, number)
        goes_on = np.where(last, places, target)
        total = self.finishes(ends, size, first, number, weights, goes_on)
        logp = np.minimum(weights + total[goes_on] - np.repeat(total[:-1], number), 0.0)
        p = np.exp(logp)
        whole = np.cumsum(p)
        cut = whole - np.repeat((whole - p)[first], number)
        cut[first + number - 1] = 1.0
        self.append("first", self.used + first, self.filled)
        self.append("cut", np.minimum(cut, 1.0), self.used)
        self.append("logp", logp, self.used)
        self.append("next", np.where(last, -1, self.filled + target), self.used)
        self.append("piece", pieces, self.used)
        at = self.filled + ends - size
        self.filled += places
        self.used += edges
        return at

    def finishes(self, ends: np.ndarray, size: np.ndarray, first: np.ndarray, number: np.ndarray, weights: np.ndarray, goes_on: np.ndarray) -> np.ndarray:
        """The log of the sum over all ways to finish from every place, and 0 for the end, from the ends of all runs backwards together.

        The sums themselves are added up, but in runs so long that they could leave the range of numbers: there their logs.
        """
        total = np.ones(len(number) + 1)
        # The way of shortest pieces bounds a sum from below.
        tiny = np.add.reduceat(weights[first], ends - size) < -LONGEST_WAY
        for runs, logs in ((np.flatnonzero(~tiny), False), (np.flatnonzero(tiny), True)):
            if not len(runs):
                continue
            # Places by their distance from the end of their run.
            runs = runs[np.argsort(-size[runs], kind="stable")]
            count = np.searchsorted(-size[runs], -np.arange(1, size[runs[0]] + 1), "right")
            back = ends[runs][spans(np.zeros(len(count), np.int64), count)] - np.repeat(np.arange(1, len(count) + 1), count)
            by_place = number[back]
            by_edge = np.concatenate([[0], np.cumsum(by_place)])
            order = spans(first[back], by_place)
            ahead, upto = weights[order], goes_on[order]
            if logs:
                total[back], total[-1] = 0.0, 0.0
            else:
                ahead = np.exp(ahead)
            j = 0
            for n in count.tolist():
                i, j = j, j + n
                low, high = by_edge[i], by_edge[j]
                starts, ways = by_edge[i:j] - low, total[upto[low:high]]
                if logs:
                    sums = ahead[low:high] + ways
                    top = np.maximum.reduceat(sums, starts)
                    total[back[i:j]] = top + np.log(np.add.reduceat(np.exp(sums - np.repeat(top, by_place[i:j])), starts))
                else:
                    total[back[i:j]] = np.add.reduceat(ahead[low:high] * ways, starts)
            if not logs:
                total[back] = np.log(total[back])
        total[-1] = 0.0
        return total

    def append(self, name: str, new: np.ndarray, at: int) -> None:
        array = getattr(self, name)
        if at + len(new) > len(array):
            array = np.empty(max(at + len(new), len(array) * 3 // 2), array.dtype)
            array[:at] = getattr(self, name)[:at]
            setattr(self, name, array)
        array[at : at + len(new)] = new

    def entries(self, texts: list[str]) -> Iterator[np.ndarray]:
        """For each text the states in which its runs begin."""
        marked = ["▁" + t.replace(" ", "▁") if t else "" for t in texts]
        code = codes("".join(marked)).astype(np.uint64)
        if not len(code):
            yield from [np.zeros(0, np.int64)] * len(texts)
            return
        # A run begins with blanks, or with its text.
        begins = code == _BLANK
        begins[1:] &= ~begins[:-1]
        upto = np.cumsum([len(t) for t in marked])
        begins[upto[upto < len(code)]] = True
        start = np.flatnonzero(begins)
        size = np.diff(np.append(start, len(code)))
        every = hashes(code, start, size)
        order = np.argsort(every)
        hashed = every[order]
        new = np.append(True, hashed[1:] != hashed[:-1])
        hashed, index, which = hashed[new], order[new], np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        spot, known = self.find(hashed)
        # At most as many edges as a place has beginnings; most have a third.
        if len(self.hashes) + np.count_nonzero(~known) > MOST_RUNS or self.used > MOST_EDGES:
            self.keep(spot[known])
            spot, known = self.find(hashed)
        self.uses[spot[known]] += 1
        if not known.all():
            new = index[~known]
            at = self.learn(code[spans(start[new], size[new])], size[new])
            for name, value in {"hashes": hashed[~known], "at": at, "size": size[new], "uses": 1}.items():
                setattr(self, name, np.insert(getattr(self, name), spot[~known], value))
            spot = np.searchsorted(self.hashes, hashed)
        yield from np.split(self.at[spot][which], np.searchsorted(start, upto)[:-1])

    def find(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where runs stand or would stand, and which are known."""
        spot = np.searchsorted(self.hashes, hashed)
        known = spot < len(self.hashes)
        known[known] = self.hashes[spot[known]] == hashed[known]
        return spot, known

    def keep(self, needed: np.ndarray) -> None:
        """Forget all runs but ``needed`` and those used most, and these too if they are more than half of what may be held."""
        ends = np.append(self.first[: self.filled], self.used)
        edges = ends[self.at + self.size] - ends[self.at]
        for least in (2, 3, 5, 9, np.iinfo(np.int32).max):
            chosen = self.uses >= least
            chosen[needed] = True
            if fits := 2 * np.count_nonzero(chosen) <= MOST_RUNS and 2 * edges[chosen].sum() <= MOST_EDGES:
                break
        if not fits:
            self.reset()
            return
        at, size, edges = self.at[chosen], self.size[chosen], edges[chosen]
        degree = np.diff(ends)[spans(at, size)]
        kept = spans(ends[at], edges)
        moved = np.cumsum(size) - size
        following = self.next[kept]
        following = np.where(following < 0, -1, following - np.repeat(at - moved, edges)).astype(np.int32)
        old = {"cut": self.cut[kept], "logp": self.logp[kept], "next": following, "piece": self.piece[kept]}
        runs = self.hashes[chosen], moved, size, self.uses[chosen] // 2
        self.reset()
        self.append("first", np.cumsum(degree) - degree, 0)
        for name, new in old.items():
            self.append(name, new, 0)
        self.filled, self.used = len(degree), len(kept)
        self.hashes, self.at, self.size, self.uses = runs

    def walk(self, entries: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges drawn by their probabilities from each entry to the end of its run, in order, and their run."""
        at, state, step = np.arange(len(entries)), entries, 0
        where, edges, steps = [], [], []
        count = np.zeros(len(entries), np.int64)
        while len(at):
            u = uniforms(seeds[at], step)
            edge = self.first[state]
            beyond = np.flatnonzero(u > self.cut[edge])
            while len(beyond):
                edge[beyond] += 1
                beyond = beyond[u[beyond] > self.cut[edge[beyond]]]
            where.append(at)
            edges.append(edge)
            steps.append(np.full(len(at), step))
            count[at] += 1
            following = self.next[edge]
            on = following >= 0
            at, state, step = at[on], following[on], step + 1
        if not where:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        run = np.concatenate(where)
        out = np.empty(len(run), np.int64)
        out[(np.cumsum(count) - count)[run] + np.concatenate(steps)] = np.concatenate(edges)
        return out, np.repeat(np.arange(len(entries)), count)

    def pieces(self, edges: np.ndarray) -> np.ndarray:
        ids = self.piece[edges]
        if not len(ids) or ids.min() >= 0:
            return ids
        named = [[i] if i >= 0 else [self.byte[b] for b in chr(-i - 1).encode("utf-8", "replace")] for i in ids.tolist()]
        return np.array([i for part in named for i in part], np.int32)

    def options(self, edge: int) -> range:
        """All edges of the state of an edge."""
        state = int(np.searchsorted(self.first[: self.filled], edge, "right")) - 1
        last = self.first[state + 1] if state + 1 < self.filled else self.used
        return range(int(self.first[state]), int(last))


def truncated(place: np.ndarray | float, most: float, u: np.ndarray | float) -> np.ndarray:
    """Gumbel values at ``place`` given that they do not exceed ``most``, from uniform ``u``."""
    with np.errstate(divide="ignore", over="ignore"):
        return place - np.log(np.exp(place - most) - np.log(u))


class _Text:
    """The search over one text: its paths so far, and the sets that are still open, best first."""

    def __init__(self, entries: np.ndarray, key: int):
        self.entries, self.key = entries, key
        self.paths: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.found: list[tuple[float, float]] = []
        self.queue: list[tuple] = []

    def add(self, edges: np.ndarray, run: np.ndarray, before: np.ndarray, logp: float, value: float, open_: list[tuple[float, int]]) -> None:
        self.paths.append((edges, run, before))
        self.found.append((logp, value))
        for v, i in open_:
            heapq.heappush(self.queue, (-v, len(self.paths), i, (int(edges[i]),)))

    def split(self, lattice: Lattice, u: float, v: float) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
        """Take the best open set apart by two uniform numbers: the path so far with its runs, its value, and where it goes on."""
        negative, path, i, taken = heapq.heappop(self.queue)
        edges, run, before = self.paths[path - 1]
        left = [e for e in lattice.options(taken[0]) if e not in taken]
        p = [math.exp(x) for x in lattice.logp[left].tolist()]
        sums = list(accumulate(p))
        spot = min(bisect_right(sums, u * sums[-1]), len(left) - 1)
        chosen = left[spot]
        others = sum(p[:spot]) + sum(p[spot + 1 :])
        if others > 0:
            place = float(before[i]) + math.log(others)
            far = place + negative
            value = place - math.log(math.exp(far) - math.log(v)) if far < 700 else -math.inf
            heapq.heappush(self.queue, (-value, path, i, (*taken, chosen)))
        target = int(lattice.next[chosen])
        rest = self.entries[run[i] + 1 :]
        ahead = rest if target < 0 else np.concatenate([[target], rest])
        return np.append(edges[:i], chosen), run[: i + 1], -negative, ahead


def best_open(
    logp: np.ndarray, before: np.ndarray, first: np.ndarray, count: np.ndarray, fresh: np.ndarray, most: np.ndarray, own: np.ndarray, k: int
) -> list[list[tuple[float, int]]]:
    """For each text the ``k`` largest values, with their places, of the sets that leave its path at ``fresh`` or later.

    No value exceeds the log probability of the path before it by more than 37, minus the log of the smallest ``-log(u)``.  So
    places further than ``FAR`` down a text are valued only where those before them do not settle it.
    """
    # An edge that is certain leaves no others.
    splits = logp <= -1e-12
    far = before <= -FAR
    at = np.flatnonzero(splits & ~far)
    hidden = np.append(0, np.cumsum(splits & far))
    best: list[list[tuple[float, int]]] = [[] for _ in range(len(count))]
    for near in (True, False):
        owner = np.searchsorted(first + count, at, "right")
        place = at - first[owner]
        new = place >= fresh[owner]
        at, owner, place = at[new], owner[new], place[new]
        outside = before[at] + np.log(-np.expm1(logp[at]))
        values = truncated(outside, most[owner], uniforms(own[owner], 3, place))
        begins = np.flatnonzero(np.diff(owner, prepend=-1))
        for _ in range(k if len(at) else 0):
            top = np.full(len(count), -np.inf)
            top[owner[begins]] = np.maximum.reduceat(values, begins)
            hit = np.flatnonzero((values == top[owner]) & (values > -np.inf))
            docs, one = np.unique(owner[hit], return_index=True)
            for d, i in zip(docs.tolist(), hit[one].tolist()):
                best[d].append((float(values[i]), int(place[i])))
            values[hit] = -np.inf
        open_ = [d for d in np.flatnonzero(hidden[first + count] > hidden[first]).tolist() if len(best[d]) < k or best[d][-1][0] < 37 - FAR] if near else []
        if not open_:
            break
        for d in open_:
            best[d] = []
        at = spans(first[open_], count[open_])
        at = at[splits[at]]
    return best


def sample_many(lattice: Lattice, entries: list[np.ndarray], keys: list[int], k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to ``k`` distinct segmentations of the runs that begin at its entries, best value first.

    A segmentation is (ids, log probability, perturbed value, inclusion score).  The score is the chance that the value
    exceeds that of the best one left out: 1 where none is left.  A text without runs has the
    empty segmentation alone.  The texts are searched side by side, a segmentation of each at a time.
    """
    texts = [_Text(e, key) for e, key in zip(entries, keys)]
    seeds = np.array(keys, np.uint64)
    todo = list(range(len(texts)))
    none = np.zeros(0, np.int64)
    heads = [(none, none, float(v), e) for v, e in zip(-np.log(-np.log(uniforms(seeds, 0, 0))), entries)]
    for number in range(k):
        size = np.array([len(h[3]) for h in heads], np.int64)
        doc = np.repeat(np.arange(len(heads)), size)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
        own = mix(seeds[todo] + np.uint64(number))
        edges, run = lattice.walk(np.concatenate([none, *[h[3] for h in heads]]), mix(own[doc] + place.astype(np.uint64)))
        drawn = np.bincount(doc[run], minlength=len(heads)) if len(run) else np.zeros(len(heads), np.int64)
        ends = np.cumsum(drawn)
        whole, runs = [], []
        for h, first, end, t in zip(heads, (ends - drawn).tolist(), ends.tolist(), todo):
            whole.append(np.concatenate([h[0], edges[first:end]]))
            base = len(texts[t].entries) - len(h[3])
            shift = run[first:end] - (run[first] if end > first else 0) + base
            runs.append(np.concatenate([h[1], shift]))
        every = np.concatenate([none, *whole])
        count = np.array([len(w) for w in whole], np.int64)
        bounds = np.cumsum(count)
        logp = lattice.logp[every]
        before = np.empty(len(logp))
        for first, end in zip((bounds - count).tolist(), bounds.tolist()):
            # By text, so that equal texts have equal sums wherever they stand.
            np.cumsum(logp[first:end], out=before[first:end])
        before -= logp
        fresh = np.array([len(h[0]) for h in heads], np.int64)
        best = best_open(logp, before, bounds - count, count, fresh, np.array([h[2] for h in heads]), own, k - number)
        for d, (h, t, end, n) in enumerate(zip(heads, todo, bounds.tolist(), count.tolist())):
            part = slice(end - n, end)
            texts[t].add(whole[d], runs[d], before[part], float(logp[part].sum()), h[2], best[d])
        todo = [t for t in todo if texts[t].queue]
        if number + 1 < k:
            if not todo:
                break
            drawn = uniforms(seeds[todo], 1, number).tolist(), uniforms(seeds[todo], 2, number).tolist()
            heads = [texts[t].split(lattice, u, v) for t, u, v in zip(todo, *drawn)]
    out = []
    for text in texts:
        bound = -text.queue[0][0] if text.queue else -math.inf
        rows = []
        for (edges, _, _), (logp, value) in zip(text.paths, text.found):
            score = 1.0 if bound == -math.inf else -math.expm1(-math.exp(min(700.0, logp - bound)))
            rows.append((lattice.pieces(edges), logp, value, score))
        out.append(rows)
    return out


_LATTICES: dict[tuple, Lattice] = {}


def lattice(path: str, temperature: float) -> Lattice:
    """One lattice per worker process, kept over its tasks."""
    if (path, temperature) not in _LATTICES:
        _LATTICES[path, temperature] = Lattice(path, temperature)
    return _LATTICES[path, temperature]


def encode(docs: DataFrame, model: str, k: int = SAMPLES, temperature: float = 1.0, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sample, ids, log_prob, value, inclusion): up to ``k`` distinct segmentations of every whole text.

    Samples count from 0 in falling perturbed value.  NULL and empty texts have one empty segmentation of
    probability 1.  Rows with equal key and text get equal samples; a NULL key is a key like others.
    A text with fewer than ``k`` segmentations gives them all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        held = lattice(model, temperature)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in blocks(texts, CHARS_AT_ONCE):
                entries = list(held.entries(texts[a:b]))
                found = sample_many(held, entries, [xxh64_intdigest(str(d), seed) for d in keys[a:b]], k)
                owner = [doc for doc, samples in zip(keys[a:b], found) for _ in samples]
                number = [n for samples in found for n in range(len(samples))]
                ids, logp, value, score = zip(*(sample for samples in found for sample in samples))
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                columns = [pa.array(owner, pa.string()), pa.array(number, pa.int32()), lists, *(pa.array(c, pa.float64()) for c in (logp, value, score))]
                yield pa.RecordBatch.from_arrays(columns, ["key", *names[1:]])

    names = ["key", "sample", "ids", "log_prob", "value", "inclusion"]
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    out = rows.mapInArrow(run, "key string, sample int, ids array<int>, log_prob double, value double, inclusion double")
    return out.select(F.col("key").cast(docs.schema[key].dataType).alias(key), *names[1:])


def decode(ids: Column, model: str) -> Column:
    """The text of an array of ids; the blank put before a text is taken off, control ids say nothing.

    NULL stays NULL; bytes that are no UTF-8 become replacement characters.  Spark joins the bytes itself, so no Python
    worker stands beside the one that encodes.
    """
    raw = json.dumps([base64.b64encode(b).decode() for b in vocabulary(model)[2]])
    pieces = F.from_json(F.lit(raw), "array<binary>")
    # Bytes, since a lambda copies every string that it gives.
    whole = F.array_join(F.transform(ids, lambda i: pieces[i]).cast("array<string>"), "").cast("binary")
    # In an array of its own the text is worked out once.
    blank = F.lit(bytearray(b" "))
    text = F.transform(F.array(whole), lambda b: F.when(F.substring(b, 1, 1) == blank, F.substring(b, 2, MOST_CHARS)).otherwise(b))[0]
    return F.make_valid_utf8(text.cast("string"))
