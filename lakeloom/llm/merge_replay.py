"""Byte-pair merges replayed over the distinct words of a block of text.

An inverted index maps each merge (by rank) to the word positions where its
pair stands. Merges are applied in rank order to all their positions at once,
and only the touched neighbours are looked up again and re-indexed. A word in
which a merge makes a pair of lower rank than its own cannot be replayed in
one ascending sweep; such words are merged again one by one, lowest rank and
leftmost first, which is the definition both libraries share.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np

_NONE = np.iinfo(np.int32).max


class Merges:
    """``new_id[rank]`` replaces a pair that ``pairs`` (a, b, rank) lists."""

    def __init__(self, a: np.ndarray, b: np.ndarray, rank: np.ndarray, new_id: np.ndarray, size: int):
        self.size = size + 1  # ids, and one that is no token
        key = a.astype(np.int64) * self.size + b
        order = np.argsort(key)
        self.key, self.rank, self.new_id = key[order], rank[order].astype(np.int32), new_id
        self.low = np.full((1024, 1024), _NONE, np.int32)  # pairs of small ids, direct
        small = (a < 1024) & (b < 1024)
        self.low[a[small], b[small]] = rank[small]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.key, key)
        at[at == len(self.key)] = 0
        return np.where(self.key[at] == key, self.rank[at], _NONE)

    def one(self, ids: list[int]) -> list[int]:
        """A single word: always the lowest-ranked pair, leftmost first."""
        n = len(ids)
        nxt, prv, ids = list(range(1, n + 1)), list(range(-1, n - 1)), list(ids)
        alive = [True] * n
        arr = np.array(ids)
        heap = [(int(r), i) for i, r in enumerate(self.ranks(arr[:-1], arr[1:])) if r != _NONE] if n > 1 else []
        heapq.heapify(heap)
        rank = dict((i, r) for r, i in heap)
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or rank.get(i) != r:
                continue
            j = nxt[i]
            ids[i], alive[j], nxt[i] = int(self.new_id[r]), False, nxt[j]
            rank.pop(j, None)
            rank.pop(i, None)
            if nxt[i] < n:
                prv[nxt[i]] = i
            for k in (prv[i], i):
                if k >= 0 and nxt[k] < n:
                    new = self._rank(ids[k], ids[nxt[k]])
                    if new is None:
                        rank.pop(k, None)
                    else:
                        rank[k] = new
                        heapq.heappush(heap, (new, k))
        return [x for x, ok in zip(ids, alive) if ok]

    def _rank(self, a: int, b: int) -> int | None:
        key = a * self.size + b
        at = int(np.searchsorted(self.key, key))
        return int(self.rank[at]) if at < len(self.key) and self.key[at] == key else None

    def replay(self, symbols: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words' symbols, laid end to end -> their token ids and counts."""
        words, gap = len(lens), self.size - 1
        at = np.arange(len(symbols)) + np.repeat(np.arange(1, words + 1), lens)
        tok = np.full(len(symbols) + words + 1, gap, np.int32)  # a gap before, between and after words
        tok[at] = symbols
        nxt = np.arange(1, len(tok) + 1, dtype=np.int32)
        prv = np.arange(-1, len(tok) - 1, dtype=np.int32)
        rank = np.full(len(tok), _NONE, np.int32)
        inner = at[nxt[at] < len(tok)]
        rank[inner] = self._first(tok[inner], tok[nxt[inner]])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(positions: np.ndarray) -> None:
            order = positions[np.argsort(rank[positions], kind="stable")]
            r = rank[order]
            cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
            for k, part in zip(r[np.append(0, cuts)].tolist(), np.split(order, cuts)):
                if k in index:
                    index[k].append(part)
                else:
                    index[k] = [part]
                    heapq.heappush(heap, k)

        first = at[rank[at] != _NONE]
        if len(first):
            add(first)
        odd = []
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            pos = parts[0] if len(parts) == 1 else np.concatenate(parts)
            pos = np.sort(pos[rank[pos] == r])
            if not len(pos):
                continue
            chained = nxt[pos[:-1]] == pos[1:]
            if chained.any():  # as in aaa: the leftmost pair goes first
                keep = np.ones(len(pos), bool)
                for i in np.flatnonzero(chained).tolist():
                    keep[i + 1] = not keep[i]
                pos = pos[keep]
            gone = nxt[pos]
            after = nxt[gone]
            tok[pos], nxt[pos], prv[after] = self.new_id[r], after, pos
            tok[gone], rank[gone] = -1, _NONE
            before = prv[pos]
            own = tok[before] != gap
            own[1:] &= before[1:] != pos[:-1]  # a neighbour that was merged itself is in pos
            near = np.concatenate([pos, before[own]])
            new = self.ranks(tok[near], tok[nxt[near]])
            rank[near] = new
            if new.size and new.min() < r:
                odd.append(near[new < r])
            hit = near[new != _NONE]
            if len(hit):
                add(hit)
        left = tok[at]
        word = np.repeat(np.arange(words), lens)
        keep = left >= 0
        out, counts = left[keep], np.bincount(word[keep], minlength=words)
        if odd:
            where = np.unique(word[np.searchsorted(at, np.unique(np.concatenate(odd)))])
            starts, ends = np.cumsum(lens) - lens, np.cumsum(lens)
            ids = np.split(out, np.cumsum(counts)[:-1])
            for w in where.tolist():
                ids[w] = np.array(self.one(symbols[starts[w] : ends[w]].tolist()), np.int32)
                counts[w] = len(ids[w])
            out = np.concatenate(ids)
        return out, counts

    def _first(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        small = (a < 1024) & (b < 1024)
        out = np.full(len(a), _NONE, np.int32)
        out[small] = self.low[a[small], b[small]]
        rest = ~small & (b != self.size - 1)
        if rest.any():
            out[rest] = self.ranks(a[rest], b[rest])
        return out


def spans(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indexes of all elements of the spans, one span after another."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    small = np.int32 if total < 1 << 31 and starts.max(initial=0) < 1 << 31 else np.int64
    out = np.repeat((starts - (ends - lens)).astype(small), lens)
    out += np.arange(total, dtype=small)
    return out


class Lexicon(dict):
    """Codes of words, and the token ids of each code once ``settle`` ran.

    ``settle`` encodes the words met since its last call as one block. The
    lexicon is dropped by its owner when it outgrows its bounds of words or of
    ``size``, the bytes of the words (by characters) and their ids.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode, self.fresh, self.size = encode, [], 0
        self.ids, self.starts, self.lens = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, word):
        self[word] = code = len(self)
        self.fresh.append(word)
        return code

    def seed(self, words: list, ids: np.ndarray, lens: np.ndarray) -> None:
        """Start from words whose ids are known."""
        self.update(zip(words, range(len(words))))
        self.ids, self.starts, self.lens = ids, np.cumsum(lens) - lens, lens

    def settle(self) -> None:
        if self.fresh:
            ids, lens = self.encode(self.fresh)
            self.size += sum(map(len, self.fresh)) + 4 * len(ids)
            starts = len(self.ids) + np.cumsum(lens) - lens
            self.ids, self.starts, self.lens = (
                np.concatenate(x) for x in ((self.ids, ids), (self.starts, starts), (self.lens, lens))
            )
            self.fresh = []

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes' ids, end to end, and how many each has."""
        lens = self.lens[codes]
        return self.ids[spans(self.starts[codes], lens)], lens


def join_lens(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words))
