"""Class-conditional Kneser-Ney models of the letters inside words.

Each class counts the letters that follow a context of ``ORDER - 1`` letters, or
of all letters since the word's start. Both back off to the same shorter
contexts, whose Kneser-Ney counts are pooled over the classes: a rare
expression that one class has not seen is measured by what both have, and one
that neither has seen speaks for neither.

A letter is one symbol, or two or three where its code point is ``SINGLE`` or more, so that every letter
of any script is told apart in keys of a fixed width.
"""

from __future__ import annotations

import math
import re

import numpy as np

#: Longest n-gram.
ORDER = 6
#: Bits of a symbol in an n-gram key.
BITS = 10
#: Symbols below SINGLE are letters of that code point; then come those that lead and those that end another letter.
SINGLE, LEAD, TRAIL = 512, 512, 768
#: Taken off the counts of either class: what one or two documents of all hold says nothing of a class.
#: Discounts estimated from the counts meet fewer held-out labels (README).
DISCOUNT = 2.0
#: Bits of a symbol in the counts of ``ngrams``, three symbols to a number.
POINT = 21
START, END = 1, 2

_OTHER = re.compile(f"[^\0-{chr(SINGLE - 1)}]")


def _symbols(letter: re.Match) -> str:
    """A letter beyond the single symbols: its plane, if that is not the first, then the high and the low byte of the rest."""
    point = ord(letter[0])
    plane = chr(LEAD + (point >> 16)) if point >> 16 else ""
    return plane + chr(LEAD + (point >> 8 & 255)) + chr(TRAIL + (point & 255))


def _spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words, each between a start and an end, one after another; and their lengths."""
    text = "".join(f"\x01{w}\x02" for w in words)
    spelled = _OTHER.sub(_symbols, text)
    points = np.frombuffer(spelled.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if len(spelled) == len(text):
        return points, np.fromiter(map(len, words), np.int64, len(words)) + 2
    return points, np.diff(np.append(np.flatnonzero(points == START), len(points)))


def ngrams(words: list[str], counts: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different n-grams of symbols inside words up to ``order`` (at most 6), and the sums of their words' counts.

    An n-gram is two numbers, its first three symbols and the others, nought behind its end.
    A lone start is none, as nothing predicts it.
    """
    points, length = _spelled(words)
    letters, letter = np.unique(points, return_inverse=True)
    at_word = np.repeat(np.arange(len(words)), length)
    rank, here, out = np.zeros(len(points), np.int64), np.arange(len(points)), []
    for k in range(1, order + 1):
        here = here[here + k <= len(points)]
        here = here[at_word[here] == at_word[here + k - 1]]
        # the rank of what is one letter shorter, and that letter
        _, first, place = np.unique(rank[here] * len(letters) + letter[here + k - 1], return_index=True, return_inverse=True)
        rank[here] = place
        start, word = here[first], at_word[here]
        sums = np.stack([np.bincount(place, counts[word, c], len(first)) for c in range(counts.shape[1])], 1).astype(np.int64)
        halves = [np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)]
        for i in range(k):
            halves[i // 3] |= points[start + i] << (POINT * (2 - i % 3))
        some = points[start] != START if k == 1 else np.ones(len(first), bool)
        out.append((halves[0][some], halves[1][some], sums[some]))
    return tuple(np.concatenate(x) for x in zip(*out))


class Ratios:
    """Log-likelihood ratios of words: natural log of the first class's likelihood over the second's."""

    def __init__(self, words: list[str], counts: np.ndarray, order: int = ORDER):
        """``counts``: for each word how often it stands in the texts of either class, two columns."""
        self._fit(*ngrams(words, np.asarray(counts, np.int64).reshape(-1, 2), order), order)

    @classmethod
    def of_counts(cls, high: np.ndarray, low: np.ndarray, counts: np.ndarray, order: int = ORDER) -> Ratios:
        """From the counts of ``ngrams``, each n-gram once."""
        made = cls.__new__(cls)
        made._fit(high, low, counts, order)
        return made

    def _fit(self, high: np.ndarray, low: np.ndarray, counts: np.ndarray, order: int) -> None:
        # what any one symbol can be: those that occur, a start and one more
        self.symbols = int(((high & ((1 << 2 * POINT) - 1)) == 0).sum()) + 2
        self.order = order
        self.keys: dict[int, np.ndarray] = {}
        self.ratio: dict[int, np.ndarray] = {}
        self.context: dict[int, np.ndarray] = {}
        self.gamma: dict[int, np.ndarray] = {}
        length = sum(((x >> (i * POINT)) & ((1 << POINT) - 1) > 0).astype(np.int8) for x in (high, low) for i in range(3))
        tables = {}
        for k in range(order, 0, -1):
            here = np.flatnonzero(length == k)
            key = np.zeros(len(here), np.int64)
            for i in range(k):
                key = (key << BITS) | (((high, low)[i // 3][here] >> (POINT * (2 - i % 3))) & ((1 << POINT) - 1))
            seen, place = np.unique(key, return_inverse=True)
            use = np.stack([np.bincount(place, counts[here, c], len(seen)) for c in (0, 1)], 1)
            pooled = use.sum(1)
            if k < order:  # how many letters stand before it, but for the start of a word
                tail = np.searchsorted(seen, tables[k + 1][0] & ((1 << BITS * k) - 1))
                pooled = np.where(seen >> (BITS * (k - 1)) == START, pooled, np.bincount(tail, minlength=len(seen)))
            tables[k] = seen, pooled, use
        below_key, below_p = None, None
        for k in range(1, order + 1):
            seen, pooled, use = tables[k]
            below = (np.full(len(seen), 1 / self.symbols) if below_key is None else
                     below_p[np.searchsorted(below_key, seen & ((1 << BITS * (k - 1)) - 1))])
            # the longest context of a letter: order - 1 letters, or all from the word's start
            whole = seen >> (BITS * (k - 1)) == START if k < order else np.ones(len(seen), bool)
            if k > 1 and whole.any():
                top = [_kneser_ney(seen[whole], use[whole, c], below[whole], DISCOUNT) for c in (0, 1)]
                self.keys[k], self.context[k] = seen[whole], top[0][1]
                self.ratio[k] = np.log(top[0][0] / top[1][0])
                self.gamma[k] = np.log(top[0][2] / top[1][2])
            below_key, below_p = seen, _kneser_ney(seen, pooled, below)[0]

    def score(self, words: list[str]) -> np.ndarray:
        """The ratio of each word."""
        if not words:
            return np.zeros(0, np.float32)
        flat, length = _spelled(words)
        at_word = np.repeat(np.arange(len(words)), length)
        start = np.repeat(np.cumsum(length) - length, length)
        place = np.flatnonzero(flat != START)  # each letter and end is predicted from what stands before it
        depth = np.minimum(place - start[place] + 1, self.order)
        out = np.zeros(len(place))
        for k in self.keys:
            here = np.flatnonzero(depth == k)
            gram = np.zeros(len(here), np.int64)
            for i in range(k):
                gram |= flat[place[here] - i] << (BITS * i)
            found, at = _find(self.keys[k], gram)
            out[here[found]] = self.ratio[k][at[found]]
            here, gram = here[~found], gram[~found]
            known, at = _find(self.context[k], gram >> BITS)
            out[here[known]] = self.gamma[k][at[known]]
        return np.bincount(at_word[place], out, len(words))


def _kneser_ney(keys: np.ndarray, counts: np.ndarray, below: np.ndarray, discount: float | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities of n-grams interpolated with those ``below``; their contexts, and the contexts' backoff weights."""
    context, place = np.unique(keys >> BITS, return_inverse=True)
    if discount is None:
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.75
    total = np.bincount(place, counts, len(context))
    taken = np.bincount(place, np.minimum(counts, discount), len(context))
    some = np.maximum(total, 1e-9)
    back = np.where(total > 0, taken / some, 1.0)
    return np.maximum(counts - discount, 0) / some[place] + back[place] * below, context, back


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def logistic(features: np.ndarray, labels: np.ndarray, rounds: int = 60, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression (the last is the intercept), by Newton's method."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    if len(x) == 0:
        return w
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - labels) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))
