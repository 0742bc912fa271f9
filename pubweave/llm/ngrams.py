"""Interpolated n-gram models of several classes, in shared sorted arrays of n-gram hashes."""

from __future__ import annotations

import numpy as np

#: An odd multiplier: hashing packed n-grams with it is one to one.
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Cells (n-grams times classes) of looked-up rows that a worker remembers.
REMEMBER = 16 << 20


def packed(symbols: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The n-gram that ends at each symbol from the order-th on, in ``bits`` bits a symbol."""
    n = len(symbols) - order + 1
    code = np.zeros(max(n, 0), np.uint64)
    for k in range(order if n > 0 else 0):
        code = code << np.uint64(bits) | symbols[k : k + n].astype(np.uint64)
    return code


def laid_out(texts: list[np.ndarray], order: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, each behind pads that no n-gram of the text before reaches
    over, and the number of symbols of each."""
    gap = np.full(order - 1, pad, np.uint16)
    flat = np.concatenate([x for s in texts for x in (gap, s)]) if texts else np.empty(0, np.uint16)
    return flat, np.fromiter(map(len, texts), np.int64, len(texts))


def counted(texts: list[np.ndarray], order: int, bits: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that end at the texts' own symbols, and how often they do."""
    flat, sizes = laid_out(texts, order, pad)
    grams = packed(flat, order, bits)
    starts = np.cumsum(sizes + order - 1) - (sizes + order - 1)
    change = np.zeros(len(grams) + 1, np.int64)
    np.add.at(change, np.minimum(starts, len(grams)), 1)
    np.add.at(change, np.minimum(starts + sizes, len(grams)), -1)
    return np.unique(grams[np.cumsum(change[:-1]) > 0], return_counts=True)


class _Sparse:
    """Values by (n-gram, class), in order of the n-gram's hash; an n-gram has entries only for
    the classes that have seen it."""

    def __init__(self, grams: list[np.ndarray], values: list[np.ndarray]):
        hashes = np.concatenate([g * MIX for g in grams])
        owner = np.repeat(np.arange(len(grams), dtype=np.uint16), list(map(len, grams)))
        by = np.lexsort((owner, hashes))
        self.hashes, first = np.unique(hashes[by], return_index=True)
        self.first = np.append(first, len(by)).astype(np.int64)
        self.owner, self.value = owner[by], np.concatenate(values)[by].astype(np.float32)

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``grams``, class, value) of all entries of these n-grams."""
        h = grams * MIX
        at = np.minimum(np.searchsorted(self.hashes, h), max(len(self.hashes) - 1, 0))
        seen = np.flatnonzero(self.hashes[at] == h) if len(self.hashes) else np.empty(0, np.int64)
        lo = self.first[at[seen]]
        n = self.first[at[seen] + 1] - lo if len(seen) else lo
        entry = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(seen, n), self.owner[entry], self.value[entry]


class Tables:
    """Probabilities of n-grams by class. For each order: the log of the interpolated
    probability of the n-grams that a class has seen, and the log of the weight that a context
    it has seen leaves to the lower order. ``kneser_ney`` discounts counts, and counts in the
    lower orders the kinds of longer n-grams that end in an n-gram; otherwise shares are mixed
    by Witten and Bell's rule, by the number of kinds seen after a context.
    """

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]], order: int, bits: int, symbols: int, kneser_ney: bool):
        self.n_classes, self.order, self.bits, self.base = len(counts), order, bits, -np.log(symbols)
        levels = [self._levels(grams, n, kneser_ney) for grams, n in counts]
        lower = [np.full(1, 1 / symbols) for _ in counts]
        below = [np.zeros(1, np.uint64) for _ in counts]
        self.logp, self.logw = [], []
        for k in range(1, order + 1 if counts else 1):
            p, contexts, weights = [], [], []
            for c, level in enumerate(levels):
                grams, n = level[k - 1]
                context, own, weight = self._shares(grams, n, kneser_ney)
                rest = lower[c][np.searchsorted(below[c], grams & self._mask(k - 1))] if len(grams) else own
                p.append(own + weight[np.searchsorted(context, grams >> np.uint64(bits))] * rest if len(grams) else own)
                contexts.append(context)
                weights.append(weight)
            below, lower = [level[k - 1][0] for level in levels], p
            self.logp.append(_Sparse(below, [np.log(x) for x in p]))
            self.logw.append(_Sparse(contexts, [np.log(x) for x in weights]))
        self._forget()

    def _mask(self, k: int) -> np.uint64:
        return np.uint64((1 << (self.bits * k)) - 1)

    def _levels(self, grams: np.ndarray, n: np.ndarray, kneser_ney: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        out = [(grams, n.astype(np.float64))]
        for k in range(self.order - 1, 0, -1):
            own, at = np.unique(out[-1][0] & self._mask(k), return_inverse=True)
            out.append((own, np.bincount(at, None if kneser_ney else out[-1][1], len(own)).astype(np.float64)))
        return out[::-1]

    def _shares(self, grams: np.ndarray, n: np.ndarray, kneser_ney: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(contexts, each n-gram's own share, each context's weight of the lower order)"""
        context, at = np.unique(grams >> np.uint64(self.bits), return_inverse=True)
        total, kinds = np.bincount(at, n, len(context)), np.bincount(at, None, len(context))
        if not kneser_ney:
            return context, n / (total + kinds)[at], kinds / (total + kinds)
        once, twice = (n == 1).sum(), (n == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        return context, np.maximum(n - discount, 0) / total[at], discount * kinds / total

    def _forget(self) -> None:
        self.known, self.rows = np.empty(0, np.uint64), np.empty((0, self.n_classes), np.float32)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": np.empty(0, np.uint64), "rows": np.empty((0, self.n_classes), np.float32)}

    def computed(self, grams: np.ndarray) -> np.ndarray:
        """By n-gram and class, from the lowest order up: an unseen n-gram has the probability
        of its lower order, by the weight of its context where that has been seen."""
        out = np.full((len(grams), self.n_classes), self.base, np.float32)
        for k in range(1, len(self.logp) + 1):
            gram = grams & self._mask(k)
            place, owner, value = self.logw[k - 1].find(gram >> np.uint64(self.bits))
            out[place, owner] += value
            place, owner, value = self.logp[k - 1].find(gram)
            out[place, owner] = value
        return out

    def log(self, grams: np.ndarray) -> np.ndarray:
        """As ``computed``, with rows of common n-grams remembered, up to a bounded number."""
        at = np.minimum(np.searchsorted(self.known, grams), max(len(self.known) - 1, 0))
        hit = self.known[at] == grams if len(self.known) else np.zeros(len(grams), bool)
        if hit.all():
            return self.rows[at]
        out = np.empty((len(grams), self.n_classes), np.float32)
        out[hit] = self.rows[at[hit]]
        missed, place = np.unique(grams[~hit], return_inverse=True)
        rows = self.computed(missed)
        out[~hit] = rows[place]
        if len(missed) * 50 > len(self.known):
            if (len(self.known) + len(missed)) * self.n_classes > REMEMBER:
                self._forget()
            known = np.concatenate([self.known, missed])
            by = np.argsort(known, kind="stable")
            self.known, self.rows = known[by], np.concatenate([self.rows, rows])[by]
        return out

    def entropies(self, texts: list[np.ndarray], pad: int, cells: int = 1 << 20) -> np.ndarray:
        """Nats per symbol, by text and class; long texts go through several blocks."""
        out = np.zeros((len(texts), self.n_classes))
        flat, sizes = laid_out(texts, self.order, pad)
        grams = packed(flat, self.order, self.bits)
        starts = np.cumsum(sizes + self.order - 1) - (sizes + self.order - 1)
        block = max(1024, cells // max(1, self.n_classes))
        for lo in range(0, len(grams), block):
            hi = min(lo + block, len(grams))
            first, last = np.searchsorted(starts + sizes, lo, "right"), np.searchsorted(starts, hi, "left")
            sums = np.vstack([np.zeros((1, self.n_classes)), np.cumsum(self.log(grams[lo:hi]), axis=0, dtype=np.float64)])
            a, b = np.clip(starts[first:last], lo, hi) - lo, np.clip(starts[first:last] + sizes[first:last], lo, hi) - lo
            out[first:last] -= sums[b] - sums[a]
        return out / np.maximum(sizes, 1)[:, None]
