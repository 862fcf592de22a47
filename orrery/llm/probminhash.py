"""Shingles of texts, and ProbMinHash signatures of them as weighted sets.

A shingle's weight is how often the text has it. Every shingle is a Poisson process
whose rate is its weight; each arrival goes to a random one of m components, which keeps
its earliest arrival. Two texts agree in a component with the probability Jaccard
similarity of their weighted shingles. A shingle stops when its next arrival is later
than all components of its text.
"""

from __future__ import annotations

import numpy as np

from .textbytes import LOWER, hashes, mix, windows, words

ID_BITS = 44
_C1, _C2 = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def shingles(raw: np.ndarray, off: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, id, weight) of the distinct shingles, by text and id, and two 64-bit hashes of each text's words.

    Words are lower-cased (A-Z). A text of fewer words than ``width`` is one shingle, a text without words has none.
    """
    raw = LOWER[raw]
    w = words(raw, off)
    h, n = hashes(raw, w.start, w.end), len(off) - 1
    sh, item = windows(h, w.first, width)
    text, count = w.text, np.diff(w.first)
    owner = text[item]
    for k in range(1, width):
        few = np.flatnonzero(count == k)
        acc = h[w.first[few]].copy()
        for j in range(1, k):
            acc = mix(acc * _C1 + h[w.first[few] + j])
        sh, owner = np.concatenate([sh, acc + np.uint64(k)]), np.concatenate([owner, few])
    place = (np.arange(len(h)) - w.first[text]).astype(np.uint64)
    keys = []
    for c in (_C1, _C2):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(mix(h ^ c) + place * c))])
        keys.append(mix(total[w.first[1:]] - total[w.first[:-1]] + count.astype(np.uint64)))
    packed = np.sort((owner.astype(np.uint64) << np.uint64(ID_BITS)) | (sh >> np.uint64(64 - ID_BITS)))
    start = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]])) if len(packed) else np.zeros(0, np.int64)
    weight = np.diff(np.concatenate([start, [len(packed)]]))
    packed = packed[start]
    assert n < 1 << (64 - ID_BITS)
    return ((packed >> np.uint64(ID_BITS)).astype(np.int64), packed & np.uint64((1 << ID_BITS) - 1), weight, np.stack(keys))


def signatures(n: int, text: np.ndarray, ids: np.ndarray, weight: np.ndarray, m: int) -> np.ndarray:
    """n x m shingle ids: of each text and component, the shingle that arrives first (all zero for a text without shingles)."""
    best, sig = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    at, element, rate = text, ids, weight.astype(float)
    time, latest, step = np.zeros(len(text)), np.full(n, np.inf), 0
    while len(at):
        step += 1
        r = mix(element * _C2 + np.uint64(step * int(_C1) % (1 << 64)))
        time = time - np.log(((r >> np.uint64(12)).astype(float) + 0.5) * 2.0 ** -52) / rate
        live = time < latest[at]
        at, element, rate, time, r = at[live], element[live], rate[live], time[live], r[live]
        slot = at * m + (mix(r ^ _C1) % np.uint64(m)).astype(np.int64)
        np.minimum.at(best, slot, time)
        first = best[slot] == time
        sig[slot[first]] = element[first]
        own = np.unique(at) if step > 1 else np.arange(n)
        latest[own] = best.reshape(n, m)[own].max(axis=1)
        live = time < latest[at]
        at, element, rate, time = at[live], element[live], rate[live], time[live]
    return sig.reshape(n, m)


def band_hashes(sig: np.ndarray, bands: int) -> np.ndarray:
    """n x bands 64-bit hashes of consecutive components."""
    rows = sig.shape[1] // bands
    acc = np.broadcast_to(np.arange(bands, dtype=np.uint64) * _C1, (len(sig), bands)).copy()
    for k in range(rows):
        acc = mix(acc * _C2 + sig[:, k:bands * rows:rows])
    return acc


def similarity(x: dict[int, int], y: dict[int, int]) -> tuple[float, float]:
    """Jaccard and probability Jaccard similarity of two weighted sets, by their definitions (for tests)."""
    every = x.keys() | y.keys()
    common = x.keys() & y.keys()
    jp = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in every) for d in common)
    return (len(common) / len(every) if every else 0.0), jp


def similarities(n: int, a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """n x 2: Jaccard and probability Jaccard similarity of text i of ``a`` and text i of ``b`` (from ``shingles``)."""
    key = [(t.astype(np.uint64) << np.uint64(ID_BITS)) | i for t, i, _ in (a, b)]
    size = [np.bincount(t, minlength=n) for t, _, _ in (a, b)]
    at = np.searchsorted(key[1], key[0])
    hit = np.zeros(len(key[0]), bool)
    inside = at < len(key[1])
    hit[inside] = key[1][at[inside]] == key[0][inside]
    common = np.bincount(a[0][hit], minlength=n)
    jaccard = common / np.maximum(size[0] + size[1] - common, 1)
    out = np.stack([jaccard, jaccard], axis=1)
    heavy = np.zeros(n, bool)
    for t, _, w in (a, b):
        heavy[t[w > 1]] = True
    bounds = [np.searchsorted(t, np.arange(n + 1)) for t, _, _ in (a, b)]
    for i in np.flatnonzero(heavy & (common > 0)):
        own = [slice(bounds[k][i], bounds[k][i + 1]) for k in (0, 1)]
        ids = np.union1d(a[1][own[0]], b[1][own[1]])
        x, y = np.zeros(len(ids)), np.zeros(len(ids))
        x[np.searchsorted(ids, a[1][own[0]])] = a[2][own[0]]
        y[np.searchsorted(ids, b[1][own[1]])] = b[2][own[1]]
        # sum over e of max(x_e / x_d, y_e / y_d) depends on d by x_d and by the ratio y_d / x_d alone
        both = (x > 0) & (y > 0)
        ratio, inverse = np.unique(y[both] / x[both], return_inverse=True)
        total = np.array([np.maximum(x, y / r).sum() for r in ratio])
        out[i, 1] = (x[both] / total[inverse]).sum()
    return out
