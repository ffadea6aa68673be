"""Prediction by partial matching over bytes.

Contexts of up to ``order`` bytes form a trie of counts.  A symbol that the longest
seen context has not seen costs an escape to the next shorter one, in which the
symbols of the longer context are excluded.  Escapes are estimated by method D: each
new symbol gave half a count to itself and half to the escape.  Counts follow update
exclusion: a shorter context counts a symbol only when the longer one meets it anew.  Below the empty context every byte that it lacks is equally likely.
Each text is preceded and ended by byte 255, which no UTF-8 text holds.

``Trie`` is the adaptive form, one symbol at a time; ``Model`` holds a trained
trie as tables in which escapes and exclusions are already worked out, and
scores whole buffers of texts with numpy.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np

from .tokens import Index

END = 255
U64 = np.uint64
CHUNK = 1 << 15  # positions looked up at once, so that what is between stays in cache


class Trie:
    """Counts of symbols after contexts; ``cost`` with ``learn`` scores adaptively."""

    def __init__(self, order: int = 4):
        self.order = order
        self.counts: dict[bytes, dict[int, int]] = defaultdict(dict)

    def symbol(self, past: bytes, sym: int) -> float:
        """log10 of the probability of ``sym`` after ``past``."""
        out, gone = 0.0, set()
        for k in range(min(self.order, len(past)), -1, -1):
            seen = self.counts.get(past[len(past) - k :], {})
            if not seen:
                continue
            left = {s: c for s, c in seen.items() if s not in gone}
            if left:
                total = 2 * sum(left.values())
                if sym in left:
                    return out + math.log10((2 * left[sym] - 1) / total)
                out += math.log10(len(left) / total)
            gone |= seen.keys()
        return out - math.log10(max(1, 256 - len(gone)))

    def add(self, past: bytes, sym: int) -> None:
        for k in range(min(self.order, len(past)), -1, -1):
            seen = self.counts[past[len(past) - k :]]
            seen[sym] = seen.get(sym, 0) + 1
            if seen[sym] > 1:
                break

    def cost(self, text: bytes, learn: bool) -> float:
        """log10 of the probability of the text; with ``learn``, each symbol is counted once scored."""
        data, out = bytes([END] * self.order) + text + bytes([END]), 0.0
        for i in range(self.order, len(data)):
            past = data[i - self.order : i]
            out += self.symbol(past, data[i])
            if learn:
                self.add(past, data[i])
        return out

    def train(self, text: bytes) -> None:
        data = bytes([END] * self.order) + text + bytes([END])
        for i in range(self.order, len(data)):
            self.add(data[i - self.order : i], data[i])


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of (context, symbol) at every position of every row, and their n_rows + 1 bounds.

    ``data`` holds the rows' bytes, row i at offsets[i]:offsets[i + 1].  A key packs
    the context's bytes, oldest first, above the symbol.
    """
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    padded = np.full(len(data) + n * (order + 1), END, dtype=np.uint8)
    row = np.repeat(np.arange(n), lengths)
    padded[np.arange(len(data)) + row * (order + 1) + order] = data
    keys = np.zeros(max(0, len(padded) - order), dtype=np.uint64)
    for j in range(order + 1):
        keys = (keys << U64(8)) | padded[j : j + len(keys)]
    bounds = np.append(0, np.cumsum(lengths + 1))
    at = np.arange(bounds[-1]) + np.repeat(np.arange(n) * order, lengths + 1)
    return keys[at], bounds


class Model:
    """A trained trie from the counts of its longest (context, symbol) keys."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int):
        self.order, self.floor, self.seen = order, math.log10(256), len(keys) > 0
        self.levels: list[dict] = []
        if not self.seen:
            return
        log = lambda x: np.log10(np.maximum(x, 1e-300)).astype(np.float32)
        sort = np.argsort(keys)
        counted = [(keys[sort], counts[sort].astype(float))]
        for k in range(order - 1, -1, -1):
            own, n = np.unique(counted[-1][0] & U64((1 << (8 * (k + 1))) - 1), return_counts=True)
            counted.append((own, n.astype(float)))
        low: tuple = ()
        for k in range(order + 1):
            own, n = counted.pop()
            first = np.flatnonzero(np.append(True, own[1:] >> U64(8) != own[:-1] >> U64(8)))
            ctx, kinds, total = own[first] >> U64(8), np.diff(np.append(first, len(own))), np.add.reduceat(n, first)
            of = np.repeat(np.arange(len(ctx), dtype=np.int32), kinds)
            # for one level below: what is left there once this context's symbols are excluded
            if k:
                low_own, low_n, low_ctx, low_total, low_kinds = low
                mask = U64((1 << (8 * (k - 1))) - 1)
                at = np.searchsorted(low_ctx, ctx & mask)
                gone = np.add.reduceat(low_n[np.searchsorted(low_own, own & U64((1 << (8 * k)) - 1))], first)
                d = low_kinds[at] - kinds
                rest = 2 * (low_total[at] - gone)
            else:
                d = rest = 256 - kinds
            direct = log(2 * n - 1) - log(2 * total)[of]
            entry = Index(own)
            level = {"entry": entry, "direct": direct, "context": Index(ctx), "escape": log(kinds) - log(2 * total)}
            level["below"] = np.where(d > 0, log(rest), np.float32(0))
            level["below_escape"] = np.where(d > 0, log(d) - log(rest), np.float32(0))
            if k < order:
                level["count"] = log(2 * n - 1)
            else:
                level["count"] = direct  # nothing is above it, so it is never entered with exclusions
                self.fast = direct[entry.rows]  # by slot, for the slots that hold a key
            self.levels.append(level)
            low = own, n, ctx, total, kinds

    def logs(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of the symbol of each key after its context."""
        if not self.seen:
            return np.full(len(keys), -self.floor)
        out = np.empty(len(keys))
        top = self.levels[self.order]
        for at in range(0, len(keys), CHUNK):
            part = keys[at : at + CHUNK]
            slot = top["entry"].slot(part)
            out[at : at + CHUNK] = self.fast[slot]
            miss = np.flatnonzero(top["entry"].keys[slot] != part)
            if len(miss):
                out[at + miss] = self._walk(part[miss])
        return out

    def _walk(self, keys: np.ndarray) -> np.ndarray:
        """As ``logs``, from the longest context down."""
        out = np.zeros(len(keys))
        todo = np.arange(len(keys))
        direct = np.ones(len(keys), dtype=bool)  # no longer context was seen, so nothing is excluded
        below, escape = np.zeros(len(keys)), np.zeros(len(keys))
        for k in range(self.order, -1, -1):
            level = self.levels[k]
            own = keys[todo] & U64((1 << (8 * (k + 1))) - 1)
            row = level["entry"].find(own)
            hit = row >= 0
            d = direct[hit]
            out[todo[hit]] += np.where(d, level["direct"][row[hit]], level["count"][row[hit]] - below[hit])
            miss = ~hit
            todo, own, direct, below, escape = todo[miss], own[miss], direct[miss], below[miss], escape[miss]
            if not len(todo):
                return out
            ctx = level["context"].find(own >> U64(8))
            known = ctx >= 0
            out[todo] += np.where(known, np.where(direct, level["escape"][ctx], escape), 0.0)
            below = np.where(known, level["below"][ctx], 0.0)
            escape = np.where(known, level["below_escape"][ctx], 0.0)
            direct &= ~known
        out[todo] -= below  # log10 of how many bytes the empty context lacks
        return out
