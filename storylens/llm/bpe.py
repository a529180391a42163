"""Byte-level BPE: exact merges, and decoding.

The texts of some Arrow rows are encoded together: their words, the matches of
the pattern in these and the ids of the matches are columns, and each distinct
word is matched and each distinct match encoded once. Short matches go through the
merges side by side: each round joins, in every match that still has one, its
pair of the lowest rank, the leftmost first.

A long match is encoded alone in linear time. A token sequence is the one that
the merges produce exactly if every two
neighbours are what the merges leave of their joint bytes. So the encoder
walks from the left, takes the longest token of the vocabulary at each place,
asks only whether it is compatible with the token before it, and steps back
to shorter tokens where it is not. The longest tokens at all places come from
one pass of an Aho-Corasick automaton over the bytes as Latin-1 characters.
Compatibility of two tokens is memoised.

Null texts count as empty and have no ids. Repeated rows, null document ids
and any other columns pass through unchanged; a column with the name of an
output is replaced.
"""

from __future__ import annotations

import base64
import re

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from storylens.llm.common import map_columns, worker_state

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Token pairs kept in a worker; beyond it the memory starts anew.
KEPT = 200_000
#: Bytes of the longest pieces that are merged side by side, in steps: a piece has as many places as its step.
STEPS = (4, 8, 16, 32, 64)
#: Characters of the texts that are encoded together, or one text. More take less time and more memory.
TOGETHER = 1 << 21


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a ``.tiktoken`` file in the order of their ranks, which must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return [t for _, t in pairs]


def plain_merges(piece: bytes, ranks: dict[bytes, int]) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
    """Merge the pair of the lowest rank, leftmost first, until none is left; also the last pair merged."""
    parts, last = [piece[i:i + 1] for i in range(len(piece))], None
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], len(ranks)), i) for i in range(len(parts) - 1))
        if rank == len(ranks):
            break
        last = parts[i], parts[i + 1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts, last


def merge_table(tokens: list[bytes]) -> list[tuple[int, int] | None]:
    """For each token the two tokens that the last merge joins; None for bytes and tokens that no merge reaches."""
    ranks = {t: i for i, t in enumerate(tokens)}
    table: list[tuple[int, int] | None] = []
    for i, t in enumerate(tokens):
        parts, last = plain_merges(t, ranks)
        if len(t) < 2 or len(parts) > 1 or last is None:
            table.append(None)
            continue
        pair = ranks[last[0]], ranks[last[1]]
        if any(len(tokens[p]) > 1 and p >= i for p in pair):
            raise ValueError(f"token {i} is merged from a token of a higher rank")
        table.append(pair)
    return table


class Encoder:
    def __init__(self, tokens: list[bytes], merges: list[tuple[int, int] | None], pattern: str):
        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.size = [len(t) for t in tokens]
        self.merges = merges
        self.merged = {pair: i for i, pair in enumerate(merges) if pair}
        #: When a token comes about: bytes are there from the start.
        self.made = [i if pair else -1 for i, pair in enumerate(merges)]
        usable = {t: i for i, (t, pair) in enumerate(zip(tokens, merges, strict=True)) if pair or len(t) == 1}
        self.shorter = [next((usable[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in usable), -1) for t in tokens]
        self.automaton = ahocorasick.Automaton()
        for t, i in usable.items():
            self.automaton.add_word(t.decode("latin-1"), (len(t) - 1, i))
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.pieces = regex.compile(pattern).findall
        self.plain = pattern == public_tokenizers.PATTERN
        self.pairs = _Pairs(self.merged, len(tokens))
        self.bytes = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        #: Tokens that no merge reaches: they stand for a whole piece only.
        self.unreached = {t for t in tokens if t not in usable}

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens side by side, rather than join bytes across their border."""
        key = left * len(self.size) + right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= KEPT:
                self.fits.clear()
            known = self.fits[key] = not self._crossed(left, right)
        return known

    def _crossed(self, left: int, right: int) -> bool:
        # Undo the merges beside the border from the latest on. A pair that stood there and
        # joins to a token of a lower rank than the merge just undone was joined before it.
        made, merged, merges = self.made, self.merged, self.merges
        before = len(made)
        while True:
            joined = merged.get((left, right))
            if joined is not None and joined < before:
                return True
            if made[left] > made[right]:
                before, left = left, merges[left][1]
            elif made[right] >= 0:  # of equal merges the left one came first
                before, right = right + 1, merges[right][0]
            else:
                return False

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [-1] * n
        for end, (before, token) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - before] = token  # of one start the longer matches end later
        if -1 in longest:
            raise ValueError("the vocabulary lacks a byte of the text")
        size, shorter, fits, vocabulary = self.size, self.shorter, self.fits, len(self.size)
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0]
        while True:
            while token >= 0:
                end = at + size[token]
                if not dead[end]:
                    if not out:
                        break
                    fit = fits.get(out[-1] * vocabulary + token)
                    if fit if fit is not None else self.compatible(out[-1], token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                if end == n:
                    return out
                at = end
                token = longest[at]
            else:
                dead[at] = 1
                token = out.pop()
                at -= size[token]

    def merge(self, pieces: list[bytes], places: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of at most that many bytes, one after another, and how many each has."""
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        tokens = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        if (tokens < 0).any():
            raise ValueError("the vocabulary lacks a byte of the text")
        # Place k of piece p is cell k * n + p. One more cell, of no token, stands for what is beyond either end.
        beyond, nothing = places * n, len(self.size)
        cells = _within(sizes) * n + np.repeat(np.arange(n), sizes)
        token = np.full(beyond + 1, -1, np.int32)
        token[cells], token[beyond] = tokens, nothing
        after, before = (np.arange(beyond + 1) + n), (np.arange(beyond + 1) - n)
        after[cells[np.cumsum(sizes) - 1]], before[:n] = beyond, beyond
        # A pair has the rank of what it joins to and its place, so the least is the leftmost of the lowest rank.
        none = np.iinfo(np.int64).max
        order = np.full(beyond + 1, none)

        def look(at: np.ndarray) -> None:
            joined = self.pairs.find(token[at], token[after[at]])
            order[at] = np.where(joined < 0, none, joined * places + at // n)

        look(cells)
        while True:
            least = order[:beyond].reshape(places, n).min(axis=0)
            left = np.flatnonzero(least < none)
            if not len(left):
                break
            joined, place = np.divmod(least[left], places)
            left += place * n
            right = after[left]
            token[left], token[right], order[right] = joined, -1, none
            after[left] = after[right]
            before[after[left]] = left
            first = before[left]
            first = first[first < beyond]
            look(left)
            look(first)
        out = token[:beyond].reshape(places, n).T
        return out[out >= 0], (out >= 0).sum(axis=1)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some matches of the pattern, one after another, and how many each has."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        step = np.searchsorted(STEPS, sizes)
        if self.unreached:
            step[[p in self.unreached for p in pieces]] = len(STEPS)
        counts, found = np.zeros(len(pieces), np.int64), []
        for k in range(len(STEPS) + 1):
            own = np.flatnonzero((step == k) & (sizes > 0))
            if not len(own):
                continue
            if k < len(STEPS):
                ids, counts[own] = self.merge([pieces[i] for i in own], STEPS[k])
            else:
                lists = [self.encode_piece(pieces[i]) for i in own]
                ids, counts[own] = np.array([t for x in lists for t in x], np.int32), [len(x) for x in lists]
            found.append((own, ids))
        starts = np.cumsum(counts) - counts
        out = np.empty(counts.sum(), np.int32)
        for own, ids in found:
            out[np.repeat(starts[own], counts[own]) + _within(counts[own])] = ids
        return out, counts

    def _together(self, texts: list[str]) -> list[bytes]:
        # In a text without odd white space each space has visible characters on both sides, and a match of this
        # pattern that holds it begins with it: so what stands between two spaces can be split on its own.
        # A unit is such a part with its space, or what a text begins with, up to the first space or its end.
        heads, tails = [], []
        for t in texts:
            cut = t.find(" ") if self.plain and t and not _odd(t) else -1
            heads.append(t if cut < 0 else t[:cut])
            tails.append(None if cut < 0 else t[cut + 1:])
        parts = pc.split_pattern(pa.array(tails, pa.large_string()), " ")
        words = parts.flatten().dictionary_encode()
        lone = pc.ascii_is_alpha(words.dictionary)  # one match of the pattern
        rest = words.dictionary.filter(pc.invert(lone)).to_pylist()
        pieces = self.pieces(" " + " ".join(rest)) if rest else []
        begun = np.flatnonzero(np.fromiter((p[0] == " " for p in pieces), bool, len(pieces)))
        matches = [self.pieces(h) for h in heads]
        of_unit = np.concatenate([np.ones(len(lone) - len(rest), np.int64), np.diff(begun, append=len(pieces)),
                                  np.fromiter(map(len, matches), np.int64, len(matches))])
        pieces += [p for m in matches for p in m]
        text = pa.large_string()
        spaced = pc.binary_join_element_wise(pa.scalar("", text), words.dictionary.filter(lone), pa.scalar(" ", text))
        pieces = pa.chunked_array([spaced, pa.array(pieces, text)]).combine_chunks()
        # from pieces to units, from units to texts
        every = pieces.dictionary_encode()
        ids, counts = self.encode_pieces(every.dictionary.cast(pa.large_binary()).to_pylist())
        codes = every.indices.to_numpy(zero_copy_only=False)
        ids, n = _gathered(ids, counts, codes), counts[codes]
        ends = np.cumsum(np.append(0, n))[np.cumsum(np.append(0, of_unit))]
        counts = np.diff(ends)
        n_units = 1 + pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False)
        starts = np.cumsum(n_units) - n_units
        units = np.empty(n_units.sum(), np.int64)
        later = np.ones(len(units), bool)
        later[starts] = False
        units[starts] = len(words.dictionary) + np.arange(len(texts))
        units[later] = np.argsort(np.argsort(~lone.to_numpy(zero_copy_only=False), kind="stable"))[
            words.indices.to_numpy(zero_copy_only=False)]
        packed = _gathered(ids, counts, units).astype("<u4", copy=False).tobytes()
        ends = 4 * np.cumsum(np.add.reduceat(counts[units], starts))
        return [packed[a:b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]

    def encode_all(self, texts: list[str], together: int | None = None) -> list[bytes]:
        """The ids of whole texts as little-endian unsigned 32-bit integers."""
        out, own, size = [], [], 0
        for t in texts:
            if own and size + len(t) > (together or TOGETHER):
                out += self._together(own)
                own, size = [], 0
            own.append(t)
            size += len(t)
        return out + self._together(own) if own else out

    def encode(self, text: str) -> bytes:
        """The ids of a whole text."""
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


#: White space other than spaces and line ends.
_OTHER_SPACE = re.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _odd(text: str) -> bool:
    """Whether a text has white space other than single spaces and line ends inside."""
    return "  " in text or " \n" in text or "\n " in text or " " in (text[0], text[-1]) or bool(_OTHER_SPACE.search(text))


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for each size, one after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _gathered(flat: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen segments of ``flat``, which has segments of these sizes, one after another."""
    n = sizes[chosen]
    return flat[np.repeat((np.cumsum(sizes) - sizes)[chosen], n) + _within(n)]


class _Pairs:
    """What pairs of tokens join to, found for many pairs at once in a hash table of 64-bit keys."""

    def __init__(self, merged: dict[tuple[int, int], int], n: int):
        self.base = n + 1  # one more token, that joins with none
        bits = max(8, (8 * len(merged)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.joined = np.full(1 << bits, -1, np.int64)
        keys = np.array([a * self.base + b for a, b in merged], np.int64)
        for at, key, joined in zip(self._place(keys).tolist(), keys.tolist(), merged.values()):
            while self.keys[at] >= 0:
                at = (at + 1) & self.last
            self.keys[at], self.joined[at] = key, joined

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The tokens that pairs join to; -1 for pairs that do not."""
        keys = left.astype(np.int64) * self.base + right
        at = self._place(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.joined[at], -1)
        more = np.flatnonzero((held != keys) & (held >= 0))
        at = at[more]
        while len(more):  # the place is another pair's: the next one
            at = (at + 1) & self.last
            held = self.keys[at]
            out[more] = np.where(held == keys[more], self.joined[at], -1)
            on = (held != keys[more]) & (held >= 0)
            more, at = more[on], at[on]
        return out


_tables: dict[str, tuple] = {}


def _shared(spark, path: str):
    """The vocabulary and its merges, broadcast: their size is that of the vocabulary file."""
    key = spark.sparkContext.applicationId, path
    if key not in _tables:
        tokens = read_ranks(path)
        _tables[key] = spark.sparkContext.broadcast((tokens, merge_table(tokens)))
    return _tables[key]


def _encoder(shared, vocabulary: str, pattern: str) -> Encoder:
    return worker_state(("bpe", vocabulary, pattern), lambda: Encoder(*shared.value, pattern))


def encode(df: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN,
           text_col: str = "text", ids_col: str = "ids", together: int = TOGETHER) -> DataFrame:
    """Append ``ids``: the ids of the whole text, packed as little-endian unsigned 32-bit integers."""
    shared = _shared(df.sparkSession, vocabulary)

    def make():
        e = _encoder(shared, vocabulary, pattern)
        return lambda texts: [e.encode_all([t or "" for t in texts], together)]

    return map_columns(df, [text_col], f"`{ids_col}` binary", make, together)


def decode(df: DataFrame, vocabulary: str = VOCABULARY, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Append ``decoded``: the bytes that packed ids stand for (null ids: none)."""
    shared = _shared(df.sparkSession, vocabulary)

    def make():
        e = _encoder(shared, vocabulary, public_tokenizers.PATTERN)
        return lambda ids: [[e.decode(x or b"") for x in ids]]

    return map_columns(df, [ids_col], f"`{bytes_col}` binary", make)
