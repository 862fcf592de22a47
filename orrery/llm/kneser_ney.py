"""Modified Kneser-Ney model of characters in sorted arrays.

Symbols are the 16-bit units of UTF-16, so every character is told from every other (one
outside the basic plane is two symbols), and an n-gram of ``ORDER`` = 4 symbols is a
number of 64 bits (its own perfect hash). The counts are gathered and the model is
broadcast: both have an entry for each different n-gram, whatever the number of documents.
For each order the n-grams seen are a sorted array of these numbers, with the interpolated
probability beside them, and the contexts a sorted array with their back-off weights;
look-ups are binary searches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import flat, release, slices

ORDER, BITS = 4, 16
SLICE = 1 << 20  # bytes at a time: the arrays over a slice take some fifty times as much


def _fold() -> np.ndarray:
    """The bits of a code point that each byte of UTF-8 holds; an ASCII byte is a code point."""
    byte = np.arange(256)
    return np.select([byte < 0x80, byte < 0xC0, byte < 0xE0, byte < 0xF0], [byte, byte & 0x3F, byte & 0x1F, byte & 0x0F], byte & 0x07).astype(np.uint32)


FOLD = _fold()


def symbols(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-16 units of all texts, and the offsets of the texts in them."""
    more = (raw & 0xC0) == 0x80
    start = np.flatnonzero(~more)
    point, at = FOLD[raw[start]], np.searchsorted(start, off)
    wide = np.flatnonzero(raw[start] >= 0xC0)
    for k, lead in enumerate((0xC0, 0xE0, 0xF0), 1):
        wide = wide[raw[start[wide]] >= lead]
        wide = wide[start[wide] + k < len(raw)]
        wide = wide[more[start[wide] + k]]
        point[wide] = (point[wide] << 6) | FOLD[raw[start[wide] + k]]
    two = point > 0xFFFF
    if two.any():
        at = at + np.concatenate([[0], np.cumsum(two)])[at]
        place = np.flatnonzero(two) + np.arange(two.sum())
        rest = point[two] - 0x10000
        point = np.repeat(point, 1 + two)
        point[place], point[place + 1] = 0xD800 + (rest >> 10 & 0x3FF), 0xDC00 + (rest & 0x3FF)
    return point, at


def ngrams_of(units: np.ndarray, off: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each symbol; before a text stands the symbol 0."""
    pad = order - 1
    own = np.arange(len(units)) + pad * np.repeat(np.arange(len(off) - 1), np.diff(off))
    padded = np.zeros(len(units) + pad * (len(off) - 1), np.uint64)
    padded[own + pad] = units
    keys = np.zeros(max(len(padded) - pad, 0), np.uint64)
    for k in range(order):
        keys = (keys << np.uint64(BITS)) | padded[k:len(padded) - pad + k]
    return keys[own]


def ngrams(raw: np.ndarray, off: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each symbol of texts in UTF-8."""
    return ngrams_of(*symbols(raw, off), order)


def count_ngrams(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Sorted n-grams of all texts and their counts: summed in each task, then by key."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for texts in slices(batch.column(0), SLICE):
                more, times = np.unique(ngrams(*flat(texts)), return_counts=True)
                keys, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n, times]), len(keys)).astype(np.int64)
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])
        release()

    table = (docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(counts, "key long, n long")
             .groupBy("key").agg(F.sum("n").alias("n"))).toArrow()
    keys, n = table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order].astype(np.int64)


@dataclass
class KneserNey:
    grams: list[np.ndarray]     # by order - 1: sorted n-grams
    logp: list[np.ndarray]      # log2 of their interpolated probabilities
    contexts: list[np.ndarray]  # sorted contexts of the n-grams
    backoff: list[np.ndarray]   # log2 of the weight that a context leaves to the lower order

    @classmethod
    def of_counts(cls, keys: np.ndarray, counts: np.ndarray, order: int = ORDER) -> KneserNey:
        levels = [(keys, counts)]
        for n in range(order - 1, 0, -1):  # lower orders count the distinct symbols that come before
            shorter = levels[0][0] & ((1 << BITS * n) - 1)
            levels.insert(0, np.unique(shorter, return_counts=True))
        model, lower = cls([], [], [], []), np.full(1, 2.0 ** -BITS)
        for n, (gram, c) in enumerate(levels, 1):
            context, at = np.unique(gram >> BITS, return_inverse=True)
            seen = [max(int((c == k).sum()), 1) for k in (1, 2, 3, 4)]
            y = seen[0] / (seen[0] + 2 * seen[1])
            cut = np.array([0, *(k - (k + 1) * y * seen[k] / seen[k - 1] for k in (1, 2, 3))])
            # few n-grams give estimates out of range; a positive discount keeps unseen ones possible
            d = np.clip(cut, [0, 0.1, 0.1, 0.1], [0, 0.9, 1.8, 2.7])[np.minimum(c, 3)]
            total = np.bincount(at, c, len(context))
            left = np.bincount(at, d, len(context)) / np.maximum(total, 1)
            below = np.zeros(len(gram), np.int64) if n == 1 else np.searchsorted(model.grams[-1], gram & ((1 << BITS * (n - 1)) - 1))
            p = (c - d) / total[at] + left[at] * lower[below] if len(gram) else np.zeros(0)
            model.grams.append(gram)
            model.logp.append(np.log2(p))
            model.contexts.append(context)
            model.backoff.append(np.log2(left))
            lower = p
        return model

    def log2_probability(self, grams: np.ndarray) -> np.ndarray:
        """log2 probability of the last symbol of each n-gram after the others."""
        grams = grams.astype(np.uint64)
        out, todo, weight = np.empty(len(grams)), np.arange(len(grams)), 0.0
        for n in range(len(self.grams), 0, -1):
            key = grams[todo] & ((1 << BITS * n) - 1)
            known, logp = self.grams[n - 1], self.logp[n - 1]
            at = np.minimum(np.searchsorted(known, key), len(known) - 1) if len(known) else np.zeros(len(key), np.int64)
            hit = known[at] == key if len(known) else np.zeros(len(key), bool)
            out[todo] = np.where(hit, logp[at] if len(known) else 0.0, 0.0) + weight
            if hit.all():
                return out
            todo, key = todo[~hit], key[~hit] >> BITS
            weight = np.broadcast_to(weight, hit.shape)[~hit]
            context = self.contexts[n - 1]
            if len(context):
                at = np.minimum(np.searchsorted(context, key), len(context) - 1)
                weight = weight + np.where(context[at] == key, self.backoff[n - 1][at], 0.0)
        out[todo] = weight - BITS
        return out


def train(docs: DataFrame, text: str = "text") -> KneserNey:
    return KneserNey.of_counts(*count_ngrams(docs, text))
