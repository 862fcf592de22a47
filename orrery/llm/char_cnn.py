"""A small character convolutional network in numpy: embedding, one convolution,
maximum over each segment of the window, one output; trained with Adam, calibrated by
Platt scaling, with a threshold that keeps a wanted recall."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BEFORE, HEAD, TAIL, AFTER = 24, 32, 16, 8
LENGTH = BEFORE + HEAD + TAIL + AFTER
SEGMENTS = (slice(0, BEFORE), slice(BEFORE, BEFORE + HEAD + TAIL), slice(BEFORE + HEAD + TAIL, LENGTH))
WIDTH, DIMS, FILTERS = 5, 8, 24


def window(text: str, start: int, end: int) -> str:
    """Fixed-length window: context before, head and tail of the candidate, context after; padded with NUL."""
    own = text[start:end]
    own = own if len(own) <= HEAD + TAIL else own[:HEAD] + own[-TAIL:]
    return (text[max(0, start - BEFORE):start].rjust(BEFORE, "\0") + own.ljust(HEAD + TAIL, "\0")
            + text[end:end + AFTER].ljust(AFTER, "\0"))


def codes(windows: list[str]) -> np.ndarray:
    """Characters as numbers below 128; all non-ASCII ones share a number."""
    points = np.frombuffer("".join(windows).encode("utf-32-le"), np.uint32).reshape(len(windows), LENGTH)
    return np.where(points < 127, points, 127).astype(np.int64)


@dataclass
class CharCNN:
    embed: np.ndarray
    conv: np.ndarray
    conv_bias: np.ndarray
    dense: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    @classmethod
    def new(cls, rng: np.random.Generator) -> CharCNN:
        return cls(rng.normal(0, 0.5, (128, DIMS)), rng.normal(0, (WIDTH * DIMS) ** -0.5, (WIDTH * DIMS, FILTERS)),
                   np.zeros(FILTERS), rng.normal(0, 0.1, FILTERS * len(SEGMENTS)), 0.0)

    def _forward(self, x: np.ndarray):
        e = self.embed[x]
        e = np.concatenate([e, np.zeros((len(x), WIDTH - 1, DIMS))], axis=1)
        patch = np.concatenate([e[:, k:k + LENGTH] for k in range(WIDTH)], axis=2)
        act = patch @ self.conv + self.conv_bias
        top = [s.start + act[:, s].argmax(axis=1) for s in SEGMENTS]
        pooled = np.concatenate([np.take_along_axis(act, t[:, None], axis=1)[:, 0] for t in top], axis=1)
        hidden = np.maximum(pooled, 0)
        return patch, top, pooled, hidden, hidden @ self.dense + self.bias

    def logits(self, x: np.ndarray, block: int = 512) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(self._forward(x[i:i + block])[-1] for i in range(0, len(x), block))])

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of a secret."""
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(x) + self.shift, -60, 60)))

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        patch, top, pooled, hidden, z = self._forward(x)
        dz = weight * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / len(x)
        d_hidden = dz[:, None] * self.dense * (pooled > 0)
        d_conv, d_bias, d_embed = np.zeros_like(self.conv), np.zeros(FILTERS), np.zeros_like(self.embed)
        rows = np.arange(len(x))[:, None]
        for k, t in enumerate(top):
            g = d_hidden[:, k * FILTERS:(k + 1) * FILTERS]
            own = patch[rows, t]  # rows x filters x patch
            d_conv += np.einsum("nfp,nf->pf", own, g)
            d_bias += g.sum(axis=0)
            d_patch = (g[:, :, None] * self.conv.T[None]).reshape(len(x), FILTERS, WIDTH, DIMS)
            for w in range(WIDTH):
                at = t + w
                ok = at < LENGTH
                np.add.at(d_embed, x[np.broadcast_to(rows, at.shape)[ok], at[ok]], d_patch[:, :, w][ok])
        return [d_embed, d_conv, d_bias, hidden.T @ dz, np.array(dz.sum())]


def fit_rows(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows to fit, their labels and weights: both classes weigh the same. Secrets of 16 characters or more also come
    with the context before them replaced by that of a negative, so that they are known by their own characters too."""
    own = np.flatnonzero((y == 1) & ((x[:, SEGMENTS[1]] != 0).sum(axis=1) >= 16))
    other = np.flatnonzero(y == 0)
    if len(other):
        bare = x[own].copy()
        bare[:, SEGMENTS[0]] = x[rng.choice(other, len(own))][:, SEGMENTS[0]]
        x, y = np.concatenate([x, bare]), np.concatenate([y, np.ones(len(bare))])
    return x, y, np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))


@dataclass
class Training:
    """A network in training with Adam's moments: ``flat`` holds all three one after the other, so that states can be averaged."""

    flat: np.ndarray
    step: int = 0

    @classmethod
    def new(cls, model: CharCNN) -> Training:
        own = np.concatenate([np.ravel(v) for v in (model.embed, model.conv, model.conv_bias, model.dense, model.bias)])
        return cls(np.concatenate([own, np.zeros(2 * len(own))]))

    def _values(self, k: int) -> list[np.ndarray]:
        shapes = [(128, DIMS), (WIDTH * DIMS, FILTERS), (FILTERS,), (FILTERS * len(SEGMENTS),), ()]
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        own = self.flat.reshape(3, -1)[k]
        return [own[e - int(np.prod(s)):e].reshape(s) for s, e in zip(shapes, ends)]

    @property
    def model(self) -> CharCNN:
        *most, bias = self._values(0)
        return CharCNN(*most, float(bias))

    def epoch(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rng: np.random.Generator, batch: int = 64) -> None:
        model, sets = self.model, [self._values(k) for k in range(3)]
        order = rng.permutation(len(x))
        for i in range(0, len(order), batch):
            own = order[i:i + batch]
            self.step += 1
            for v, m, s, g in zip(*sets, model.gradients(x[own], y[own], weight[own])):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= 0.01 * (m / (1 - 0.9 ** self.step)) / (np.sqrt(s / (1 - 0.999 ** self.step)) + 1e-8)
            model.bias = float(sets[0][4])


def calibrate(model: CharCNN, z: np.ndarray, y: np.ndarray, quiet: np.ndarray, times: np.ndarray, recall: float, noise: float) -> None:
    """Platt scaling and the threshold, from logits that come ``times`` often each. The threshold is the largest
    one that keeps ``recall`` of the secrets, or that which at most ``noise`` of the findings among ``quiet`` ones
    reach, if it is larger."""
    n1, n0 = float(times[y == 1].sum()), float(times[y == 0].sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))  # Platt's smoothed targets
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of the two-parameter logistic fit
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
        g = np.array([(times * (p - target) * z).sum(), (times * (p - target)).sum()])
        v = times * np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(v * z * z).sum(), (v * z).sum()], [(v * z).sum(), v.sum()]]) + 1e-6 * np.eye(2)
        move = np.linalg.solve(h, g)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    model.scale, model.shift = float(a), float(b)
    p = 1 / (1 + np.exp(-np.clip(model.scale * z + model.shift, -60, 60)))

    def ranked(use: np.ndarray, place: float) -> float:
        """The value at a place among the sorted values of the rows in use."""
        order = np.argsort(p[use], kind="stable")
        upto = np.cumsum(times[use][order])
        return float(p[use][order][min(np.searchsorted(upto, place, "right"), len(upto) - 1)])

    model.threshold = ranked(y == 1, int((1 - recall) * n1)) if n1 else 1.0
    loud = float(times[quiet].sum())
    if loud:
        model.threshold = max(model.threshold, float(np.nextafter(ranked(quiet, loud - 1 - int(noise * loud)), 1)))


def train(windows: list[str], labels: np.ndarray, recall: float = 0.98, seed: int = 7, epochs: int = 12) -> CharCNN:
    """Fit on seven tenths of the findings, calibrate and choose the threshold on the rest."""
    rng = np.random.default_rng(seed)
    x, y = codes(windows), np.asarray(labels, float)
    held = rng.random(len(x)) < 0.3
    if not y[held].any() or y[held].all() or not y[~held].any() or y[~held].all():
        held[:] = False
    rows = fit_rows(x[~held], y[~held], rng)
    state = Training.new(CharCNN.new(rng))
    for _ in range(epochs):
        state.epoch(*rows, rng)
    model = state.model
    cal_x, cal_y = (x[held], y[held]) if held.any() else (x, y)
    calibrate(model, model.logits(cal_x), cal_y, np.zeros(len(cal_y), bool), np.ones(len(cal_y)), recall, 1.0)
    return model
