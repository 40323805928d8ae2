"""A bidirectional FM-index over a delimited vocabulary, searched for many words at once (numpy).

The indexed text is ``$word1$word2$...$wordn$`` and, for the other direction,
its reverse.  A pattern is a pair of suffix-rank intervals, one in each
suffix array, of one size.  Putting a symbol before the pattern is a rank step
in the one array and a shift by the number of smaller symbols in the other;
putting it behind is the same with the arrays' roles swapped.  Both numbers
come from one descent of a wavelet matrix of the Burrows-Wheeler transform.

Search schemes for one error: a word is cut into two halves.  Either the first
is matched exactly (leftwards, up to the delimiter) and the second extended to
the right with one error, or the second is matched exactly (rightwards) and
the first extended to the left with one error.
"""

from __future__ import annotations

import numpy as np

END, DELIMITER = 0, 1


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order, by prefix doubling; the last symbol must be the only ``END``."""
    n = len(text)
    rank, k = text.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while True:
        behind = np.zeros(n, np.int64)
        behind[:-k or None] = rank[k:] + 1 if k < n else 0
        key = rank * (n + 2) + behind
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.zeros(n, np.int64)
        np.cumsum(ordered[1:] != ordered[:-1], out=fresh[1:])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        k *= 2
        if fresh[-1] == n - 1 or k >= n:
            return order


class Wavelet:
    """Wavelet matrix of a sequence of symbols below ``n_symbols``."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.n_symbols, self.levels = n_symbols, max(1, int(n_symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int64))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))
        # where each symbol's run starts in the last level's order
        every, at = np.arange(n_symbols), np.zeros(n_symbols, np.int64)
        for j, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            at = np.where((every >> (self.levels - 1 - j)) & 1, zeros + ones[at], at - ones[at])
        self.start = at

    def ranks(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray):
        """Occurrences of ``symbol`` before lo and before hi, and how many symbols in [lo, hi) are smaller."""
        smaller = np.zeros(len(lo), np.int64)
        for j, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = ((symbol >> (self.levels - 1 - j)) & 1).astype(bool)
            a, b = ones[lo], ones[hi]
            smaller += np.where(bit, (hi - b) - (lo - a), 0)
            lo, hi = np.where(bit, zeros + a, lo - a), np.where(bit, zeros + b, hi - b)
        return lo - self.start[symbol], hi - self.start[symbol], smaller

    def symbols_in(self, lo: np.ndarray, hi: np.ndarray):
        """For each interval each symbol in it: interval number, symbol, and its ``ranks``."""
        who, symbol = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        smaller = np.zeros(len(lo), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            a, b = ones[lo], ones[hi]
            none = (hi - b) - (lo - a)
            left, right = none > 0, b > a
            who = np.concatenate((who[left], who[right]))
            symbol = np.concatenate((symbol[left] << 1, (symbol[right] << 1) | 1))
            smaller = np.concatenate((smaller[left], (smaller + none)[right]))
            lo, hi = (np.concatenate(((lo - a)[left], (zeros + a)[right])),
                      np.concatenate(((hi - b)[left], (zeros + b)[right])))
        return who, symbol, lo - self.start[symbol], hi - self.start[symbol], smaller


class BidirectionalIndex:
    """Index of ``words``, which must be distinct; a word's number is its place in code-point order."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        letters = sorted(set().union(*self.words)) if self.words else []
        self.code = {c: i + 2 for i, c in enumerate(letters)}
        self.unknown = len(letters) + 2  # a symbol that occurs nowhere
        n_symbols = self.unknown + 1
        body = [DELIMITER]
        for w in self.words:
            body.extend(self.code[c] for c in w)
            body.append(DELIMITER)
        text = np.array([*body, END], np.int64)
        back = np.concatenate((text[-2::-1], text[-1:]))
        self.delimiters = np.flatnonzero(text == DELIMITER)
        self.positions = suffix_array(text)
        self.size = len(text)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols))))
        #: the symbols before each suffix of the text, and of its reverse: those behind the pattern
        self.left = Wavelet(text[self.positions - 1], n_symbols)
        self.right = Wavelet(back[suffix_array(back) - 1], n_symbols)

    def encode(self, word: str) -> list[int]:
        return [self.code.get(c, self.unknown) for c in word]

    # a pattern is (start in the suffixes, start in the reverse's suffixes, size); ``main`` is the
    # start in the array that an extension steps in, ``other`` the one that it shifts

    def extend(self, leftwards: bool, main: np.ndarray, other: np.ndarray, size: np.ndarray, symbol: np.ndarray):
        lo, hi, smaller = (self.left if leftwards else self.right).ranks(main, main + size, symbol)
        return self.before[symbol] + lo, other + smaller, hi - lo

    def extensions(self, leftwards: bool, main: np.ndarray, other: np.ndarray, size: np.ndarray):
        """Every pattern longer by one symbol: pattern number, symbol, main, other, size."""
        who, symbol, lo, hi, smaller = (self.left if leftwards else self.right).symbols_in(main, main + size)
        return who, symbol, self.before[symbol] + lo, other[who] + smaller, hi - lo

    def near_words(self, queries: list[str], first_half: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query number, word number) of words exactly one edit away, the edit outside the exact half.

        ``first_half``: the first half is matched, the edit lies in the second.
        """
        exact, rest = [], []
        for q in queries:
            codes, half = self.encode(q), len(q) // 2
            if first_half:
                exact.append([*codes[:half][::-1], DELIMITER])
                rest.append([*codes[half:], DELIMITER])
            else:
                exact.append([*codes[half:], DELIMITER])
                rest.append([*codes[:half][::-1], DELIMITER])
        n = len(queries)
        who, (main, other, size) = np.arange(n), (np.zeros(n, np.int64), np.zeros(n, np.int64),
                                                  np.full(n, self.size, np.int64))
        # the exact half runs towards its own end of the word, the other half away from it
        table, lengths = _table(exact)
        for j in range(int(lengths.max(initial=0))):
            go = lengths[who] > j
            a, b, c = self.extend(first_half, main[go], other[go], size[go], table[who[go], j])
            main[go], other[go], size[go] = a, b, c
            live = size > 0
            who, main, other, size = who[live], main[live], other[live], size[live]
        return self._one_error(not first_half, rest, who, other, main, size)

    def _one_error(self, leftwards: bool, rest: list[list[int]], who, main, other, size):
        table, lengths = _table(rest)
        state = (who, np.zeros(len(who), np.int64), main, other, size)  # without an error, in step
        erred = tuple(np.zeros(0, np.int64) for _ in range(5))
        found = []
        while len(state[0]) or len(erred[0]):
            new = []
            if len(state[0]):
                q, at, main, other, size = state
                here, last = table[q, at], lengths[q] - 1
                by, symbol, m, o, s = self.extensions(leftwards, main, other, size)
                letter = (symbol > DELIMITER) & (symbol != here[by])
                by, m, o, s = by[letter], m[letter], o[letter], s[letter]
                new.append((q[by], at[by], m, o, s))  # a symbol too many
                inside = at[by] < last[by]
                new.append((q[by][inside], at[by][inside] + 1, m[inside], o[inside], s[inside]))  # another symbol
                # one too few: of a run of one symbol, the last
                gone = (at < last) & (table[q, np.minimum(at + 1, last)] != here)
                new.append((q[gone], at[gone] + 1, main[gone], other[gone], size[gone]))
                on = at < last  # at the delimiter, the query itself would be found
                main, other, size = self.extend(leftwards, main[on], other[on], size[on], here[on])
                live = size > 0
                state = (q[on][live], at[on][live] + 1, main[live], other[live], size[live])
            q, at, main, other, size = (np.concatenate(x) for x in zip(erred, *new, strict=True))
            main, other, size = self.extend(leftwards, main, other, size, table[q, at])
            ended = (size > 0) & (at + 1 == lengths[q])
            starts = main if leftwards else other
            found.append((q[ended], np.searchsorted(self.delimiters, self.positions[starts[ended]])))
            live = (size > 0) & ~ended
            erred = (q[live], at[live] + 1, main[live], other[live], size[live])
        pairs = np.unique(np.stack([np.concatenate(x) for x in zip(*found, strict=True)])
                          if found else np.zeros((2, 0), np.int64), axis=1)
        return pairs[0], pairs[1]


def _table(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows], np.int64)
    table = np.zeros((len(rows), int(lengths.max(initial=1))), np.int64)
    for i, r in enumerate(rows):
        table[i, :len(r)] = r
    return table, lengths
