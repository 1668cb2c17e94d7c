"""Re-Pair grammar compression of token ids, and the block format that holds it.

A block keeps the ids of consecutive documents.  Frequent pairs of neighbours are replaced by new
symbols, round after round, until a round saves next to nothing.  One round replaces many pairs at
once: pairs are taken by falling count as long as no symbol is the left one of a pair and the right
one of another, so no two occurrences overlap.  (A pair of equal symbols is replaced from the left
of each run.)

Block bytes, all numbers little-endian: the header ``<4sIIIIQ`` (magic ``RPB1``, documents, smallest
rule symbol, rules, bits per symbol, symbols), then
  - per document: id (i8), 1 if the id is not null (u1), tokens (u4),
  - per rule: left symbol (u4), right symbol (u4), expansion length (u4),
  - the symbols: their lower 16 bits (u2 each), then one bit plane for every further bit.
Expansion lengths make any range of a block readable without the rest: see ``Block.tokens``.
"""

from __future__ import annotations

import struct
from functools import cached_property

import numpy as np

_HEADER = "<4sIIIIQ"
_MAGIC = b"RPB1"
_HASH_BITS = 20
#: Rounds end when one shortens the block by less than this share, or by the last allowed round.
LEAST_GAIN = 0.03
MOST_ROUNDS = 40
#: Pairs replaced in one round at most, and the occurrences that make a rule worth its 12 bytes.
PAIRS_PER_ROUND = 4096
LEAST_COUNT = 16


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _HASH_BITS)).astype(np.int64)


def _pair_keys(symbols: np.ndarray) -> np.ndarray:
    keys = symbols[:-1].astype(np.uint64)
    keys <<= np.uint64(32)
    keys |= symbols[1:]
    return keys


def _choose(keys: np.ndarray, slots: np.ndarray, least: int) -> list[int]:
    """The pairs to replace in this round, by falling count (ties: smaller pair first)."""
    counts = np.bincount(slots, minlength=1 << _HASH_BITS)
    if len(frequent := counts[counts >= least]) > 2 * PAIRS_PER_ROUND:
        # Only pairs in the fullest slots can be among the most frequent ones.
        least = max(least, int(np.partition(frequent, -2 * PAIRS_PER_ROUND)[-2 * PAIRS_PER_ROUND]))
    pairs, times = np.unique(keys[(counts >= least)[slots]], return_counts=True)
    enough = times >= least
    pairs, times = pairs[enough], times[enough]
    order = np.argsort(-times, kind="stable")[: 2 * PAIRS_PER_ROUND]
    lefts, rights, used, chosen = set(), set(), set(), []
    for pair, slot in zip(pairs[order].tolist(), _slot(pairs[order]).tolist()):
        a, b = pair >> 32, pair & 0xFFFFFFFF
        if slot in used or a in rights or b in lefts:
            continue
        if a == b and (a in lefts or b in rights):
            continue
        used.add(slot)
        lefts.add(a)
        rights.add(b)
        chosen.append(pair)
        if len(chosen) == PAIRS_PER_ROUND:
            break
    return chosen


def build(ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Grammar of ``ids``: smallest rule symbol, left and right symbols of the rules, symbols left."""
    symbols = np.ascontiguousarray(ids, "<u4")
    base = int(symbols.max()) + 1 if len(symbols) else 0
    rules: list[int] = []
    for _ in range(MOST_ROUNDS):
        if len(symbols) < 2:
            break
        keys = _pair_keys(symbols)
        slots = _slot(keys)
        chosen = _choose(keys, slots, LEAST_COUNT)
        if not chosen:
            break
        pairs = np.array(chosen, np.uint64)
        table = np.full(1 << _HASH_BITS, -1, np.int32)
        table[_slot(pairs)] = np.arange(len(pairs))
        rule = table[slots]
        at = np.flatnonzero(rule >= 0)
        rule = rule[at]
        right = pairs[rule] == keys[at]
        at, rule = at[right], rule[right]
        # Only a pair of equal symbols can follow itself at once: keep every other one of a run.
        if len(at) > 1 and (close := np.diff(at) == 1).any():
            fresh = np.concatenate([[True], ~close])
            run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            keep = (np.arange(len(at)) - run_start) % 2 == 0
            at, rule = at[keep], rule[keep]
        replaced = symbols.copy()
        replaced[at] = rule.astype("<u4") + np.uint32(base + len(rules))
        left = np.ones(len(symbols), bool)
        left[at + 1] = False
        replaced = replaced[left]
        rules += chosen
        gain = 1 - len(replaced) / len(symbols)
        symbols = replaced
        if gain < LEAST_GAIN:
            break
    pairs = np.array(rules, np.uint64)
    return base, (pairs >> np.uint64(32)).astype("<u4"), pairs.astype("<u4"), symbols


def _lengths(base: int, left: np.ndarray, right: np.ndarray) -> list[int]:
    lengths: list[int] = []
    for a, b in zip(left.tolist(), right.tolist()):
        lengths.append((1 if a < base else lengths[a - base]) + (1 if b < base else lengths[b - base]))
    return lengths


def pack(doc_ids: list[int | None], n_tokens: np.ndarray, ids: np.ndarray) -> bytes:
    """A block of documents whose ids follow each other in ``ids``."""
    base, left, right, symbols = build(ids)
    bits = max(16, int(base + len(left)).bit_length())
    return b"".join(
        [
            struct.pack(_HEADER, _MAGIC, len(doc_ids), base, len(left), bits, len(symbols)),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is not None for d in doc_ids], "u1").tobytes(),
            np.asarray(n_tokens, "<u4").tobytes(),
            left.tobytes(),
            right.tobytes(),
            np.array(_lengths(base, left, right), "<u4").tobytes(),
            symbols.astype("<u2").tobytes(),
            *(np.packbits((symbols >> bit) & 1 != 0).tobytes() for bit in range(16, bits)),
        ]
    )


class Block:
    """A block read back from its bytes."""

    def __init__(self, data: bytes):
        magic, docs, self.base, rules, bits, count = struct.unpack_from(_HEADER, data)
        if magic != _MAGIC:
            raise ValueError("not a block of grammar-compressed ids")
        at = struct.calcsize(_HEADER)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        ids, known = take("<i8", docs), take("u1", docs)
        self.doc_ids = [d if k else None for d, k in zip(ids.tolist(), known.tolist())]
        self.n_tokens = take("<u4", docs).astype(np.int64)
        self.left, self.right, self.lengths = take("<u4", rules), take("<u4", rules), take("<u4", rules)
        symbols = take("<u2", count).astype("<u4")
        for bit in range(16, bits):
            plane = np.unpackbits(take("u1", -(-count // 8)), count=count)
            symbols |= plane.astype("<u4") << np.uint32(bit)
        self.symbols = symbols

    @cached_property
    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rules one after the other, and where each rule starts."""
        starts = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        flat = np.empty(starts[-1], "<u4")
        begin = starts.tolist()
        for i, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist())):
            at = begin[i]
            for symbol in (a, b):
                if symbol < self.base:
                    flat[at] = symbol
                    at += 1
                else:
                    j = symbol - self.base
                    n = begin[j + 1] - begin[j]
                    flat[at : at + n] = flat[begin[j] : begin[j + 1]]
                    at += n
        return flat, starts

    @cached_property
    def _ends(self) -> np.ndarray:
        """Where the expansion of each symbol ends, in tokens."""
        lengths = np.ones(len(self.symbols), np.int64)
        rule = self.symbols >= self.base
        lengths[rule] = self.lengths[self.symbols[rule] - self.base]
        return np.cumsum(lengths)

    def tokens(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``start:end`` of the block; only the symbols that cover them are expanded."""
        total = int(self._ends[-1]) if len(self.symbols) else 0
        end = total if end is None else min(end, total)
        if start >= end:
            return np.empty(0, "<u4")
        first = int(np.searchsorted(self._ends, start, side="right"))
        last = int(np.searchsorted(self._ends, end, side="left")) + 1
        symbols, ends = self.symbols[first:last], self._ends[first:last]
        before = int(self._ends[first - 1]) if first else 0
        sizes = np.diff(ends, prepend=before)
        flat, starts = self._expansions
        # Single ids stand behind the expansions in one table of all sources.
        rule = symbols >= self.base
        table = np.concatenate([flat, symbols[~rule]])
        source = np.empty(len(symbols), np.int64)
        source[rule] = starts[symbols[rule] - self.base]
        source[~rule] = len(flat) + np.arange(np.count_nonzero(~rule))
        shift = source - (ends - sizes - before)
        found = table[np.repeat(shift, sizes) + np.arange(ends[-1] - before)]
        return found[start - before : end - before]
