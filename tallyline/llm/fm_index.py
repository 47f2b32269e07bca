"""A bidirectional FM-index over a delimited vocabulary, searched for many words at once.

The text is the cyclic string of all words, each behind a delimiter (code 0); a second index holds its reversal. A
pattern is a pair of suffix-rank intervals of one size, one in each index, and may grow at either end. Ranks are counted
from a table at every 64th place and the codes behind it, so the index needs some ten bytes for each code of the text.
"""

from __future__ import annotations

import numpy as np

STEP = 64
# Intervals up to this size list their next codes from the text itself, longer ones try the whole alphabet.
NARROW = 32


def rotations(text: np.ndarray) -> np.ndarray:
    """Starts of the cyclic rotations of ``text`` in order, by prefix doubling; the text must not be periodic."""
    n = len(text)
    rank = text.astype(np.int64)
    order, width = np.argsort(rank, kind="stable"), 1
    while True:
        both = rank * (n + 256) + np.roll(rank, -width)
        order = np.argsort(both, kind="stable")
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate([[0], np.diff(both[order]) != 0]))
        if new[order[-1]] == n - 1 or width >= n:
            return order
        rank, width = new, 2 * width


class _Ranks:
    """Codes in front of the sorted rotations of a text, and the number of smaller codes before any place of them."""

    def __init__(self, text: np.ndarray, alphabet: int):
        self.order = rotations(text)
        self.codes = text[self.order - 1]
        n = len(text)
        blocks = n // STEP + 1
        self.rows = np.full(blocks * STEP, 255, dtype=np.uint8)
        self.rows[:n] = self.codes
        self.rows = self.rows.reshape(blocks, STEP)
        counts = np.zeros((blocks + 1, alphabet), dtype=np.int32)
        np.add.at(counts, (np.repeat(np.arange(1, blocks + 1), STEP)[:n], self.codes), 1)
        self.smaller = np.zeros((blocks + 1, alphabet + 1), dtype=np.int32)
        self.smaller[:, 1:] = np.cumsum(np.cumsum(counts, axis=0), axis=1)
        self.first = self.smaller[blocks].copy()

    def both(self, code: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes smaller than ``code``, codes equal to it) before ``place``."""
        block, rest = place // STEP, (place % STEP)[:, None]
        rows, code_ = self.rows[block], code[:, None]
        before = np.arange(STEP)[None, :] < rest
        smaller = self.smaller[block, code]
        return (smaller + ((rows < code_) & before).sum(axis=1),
                self.smaller[block, code + 1] - smaller + ((rows == code_) & before).sum(axis=1))


class BidirectionalIndex:
    """``words`` are distinct arrays of codes from 1 to ``alphabet`` - 1."""

    def __init__(self, words: list[np.ndarray], alphabet: int):
        zero = np.zeros(1, dtype=np.uint8)
        text = np.concatenate([p for w in words for p in (zero, w)])
        back = np.concatenate([p for w in reversed(words) for p in (zero, w[::-1])])
        self.alphabet, self.size = alphabet, len(text)
        self.left, self.right = _Ranks(text, alphabet), _Ranks(back, alphabet)
        sizes = np.array([len(w) + 1 for w in reversed(words)])
        self.word_at = dict(zip((np.cumsum(sizes) - sizes).tolist(), range(len(words) - 1, -1, -1), strict=True))

    def grow_left(self, code: np.ndarray, lo: np.ndarray, other: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Put ``code`` in front: intervals (start in this text, start in the reversed one, size) of the longer patterns."""
        return self._grow(self.left, code, lo, other, size)

    @staticmethod
    def _grow(ranks: _Ranks, code, lo, other, size):
        small_lo, same_lo = ranks.both(code, lo)
        small_hi, same_hi = ranks.both(code, lo + size)
        return ranks.first[code] + same_lo, other + small_hi - small_lo, same_hi - same_lo

    def grow_right(self, code: np.ndarray, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put ``code`` behind patterns whose interval in the reversed text starts at ``lo``; they grow no more to the left."""
        start, _, n = self._grow(self.right, code, lo, lo, size)
        return start, n

    def next_codes(self, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern number, code) of all codes but the delimiter that follow each pattern, each once."""
        narrow = np.flatnonzero(size <= NARROW)
        n = size[narrow]
        place = np.repeat(lo[narrow] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        found = np.unique(np.repeat(narrow, n) * 256 + self.right.codes[place])
        wide = np.flatnonzero(size > NARROW)
        pattern, code = np.repeat(wide, self.alphabet - 1), np.tile(np.arange(1, self.alphabet), len(wide))
        count = self.right.both(code, lo[pattern] + size[pattern])[1] - self.right.both(code, lo[pattern])[1]
        found = np.concatenate([found, (pattern * 256 + code)[count > 0]])
        found = found[found % 256 > 0]
        return found // 256, found % 256

    def within_one_error(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all words that begin with the first ``exact`` codes of a query and differ from it by one
        inserted, deleted or replaced code behind them; each once. Query q is ``codes[starts[q]:][:lengths[q]]``.

        The exact part is matched from its end to the delimiter in front of it; then the pattern grows to the right.
        Of a run of equal codes only the last is deleted, and only behind it is the same code inserted.
        """
        q = np.arange(len(starts))
        lo, other, size = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), self.size)
        for k in range(int(exact.max(initial=0)) + 1):
            now = np.flatnonzero((exact[q] >= k) & (size > 0))
            at = exact[q[now]] - 1 - k
            code = np.where(at >= 0, codes[(starts[q[now]] + at).clip(0)], 0).astype(np.int64)
            lo[now], other[now], size[now] = self.grow_left(code, lo[now], other[now], size[now])
        live = np.flatnonzero(size > 0)
        zero = q[live], exact[live].astype(np.int64), other[live], size[live]
        one = tuple(x[:0] for x in zero)
        hits = []
        while len(zero[0]) or len(one[0]):
            made = []
            # Patterns with an error read on exactly, and end at a delimiter.
            q, j, lo, size = one
            if len(q):
                end = j == lengths[q]
                code = np.where(end, 0, codes[(starts[q] + j).clip(0, len(codes) - 1)]).astype(np.int64)
                lo, size = self.grow_right(code, lo, size)
                hits.append((q[end & (size > 0)], lo[end & (size > 0)]))
                on = ~end & (size > 0)
                made.append((q[on], j[on] + 1, lo[on], size[on]))
            q, j, lo, size = zero
            if len(q):
                end = j == lengths[q]
                code = np.where(end, 0, codes[(starts[q] + j).clip(0, len(codes) - 1)]).astype(np.int64)
                last = ~end & ~((j + 1 < lengths[q]) & (codes[(starts[q] + j + 1).clip(0, len(codes) - 1)] == code))
                made.append((q[last], j[last] + 1, lo[last], size[last]))  # the code deleted
                p, x = self.next_codes(lo, size)
                new_lo, new_size = self.grow_right(x, lo[p], size[p])
                same = (x == code[p]) & ~end[p]
                zero = q[p[same]], j[p[same]] + 1, new_lo[same], new_size[same]
                other_ = ~same
                made.append((q[p[other_]], j[p[other_]], new_lo[other_], new_size[other_]))  # a code inserted
                swap = other_ & ~end[p]
                made.append((q[p[swap]], j[p[swap]] + 1, new_lo[swap], new_size[swap]))  # the code replaced
            one = tuple(np.concatenate(c) for c in zip(*made, strict=True)) if made else tuple(x[:0] for x in one)
        found = np.concatenate([h[0] for h in hits]) if hits else np.zeros(0, np.int64)
        ranks = np.concatenate([h[1] for h in hits]) if hits else np.zeros(0, np.int64)
        words = np.array([self.word_at[p] for p in self.right.order[ranks].tolist()], dtype=np.int64)
        return found, words
