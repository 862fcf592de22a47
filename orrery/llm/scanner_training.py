"""Training of the secret scanner's network on all findings of a corpus.

Findings are dealt by their hash into groups of about ``GROUP``; a group is one row of a table, with as many planted
findings besides (findings.py). In every epoch each group trains the network by itself from the common
state, and the next common state is the mean of theirs: no task holds more than a group at a time, and the driver
only sums of states. Sums are taken of whole numbers, so they do not depend on the
order of the groups. Calibration and threshold come from the logits of all held-out findings, counted
by steps of ``1 / STEPS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .char_cnn import AFTER, BEFORE, LENGTH, CharCNN, Training, calibrate, codes, fit_rows, window
from .findings import planted
from .tables import written
from .textbytes import release

GROUP, PARTS, STEPS = 4096, 64, 256
LIKELY = 0.9
_WHOLE = 2.0 ** 32
#: Of each finding: its codes, whether it is a secret, whether it is an unlabelled one of the corpus, whether it is held out.
_COLUMNS = ("x", "secret", "corpus", "held")


def _prepared(table: pa.Table) -> pa.Table:
    """One group's findings and planted ones in its contexts."""
    group = table["group"][0].as_py()
    rows = sorted(zip(table["window"].to_pylist(), table["secret"].to_pylist()))
    other = [w for w, s in rows if not s]
    made, secret = planted(GROUP, [(w[:BEFORE].replace("\0", ""), w[LENGTH - AFTER:].replace("\0", "")) for w in other], 11 + group)
    x = codes([w for w, _ in rows] + [window(b + v + a, len(b), len(b) + len(v)) for b, v, a in made])
    label = np.array([s for _, s in rows] + secret, bool)
    corpus = ~label & (np.arange(len(x)) < len(rows))
    held = np.random.default_rng([7, group]).random(len(x)) < 0.3
    return pa.table([pa.array([group], pa.int64()), *(pa.array([v.tobytes()], pa.binary()) for v in (x.astype(np.uint8), label, corpus, held))],
                    names=["group", *_COLUMNS])


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Number, codes and flags of every group in a batch."""
    for i in range(batch.num_rows):
        x, *flags = (np.frombuffer(batch[c][i].as_py(), np.uint8) for c in _COLUMNS)
        yield batch["group"][i].as_py(), [x.reshape(-1, LENGTH).astype(np.int64), *(f.astype(bool) for f in flags)]


def _without_likely(first: CharCNN | None):
    """Groups without the unlabelled findings that the first network takes for secrets, or without any unlabelled ones."""
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, (x, secret, corpus, held) in _groups(batch):
                keep = ~corpus
                if first is not None:
                    keep[corpus] = first.probability(x[corpus]) < LIKELY
                part = (x[keep].astype(np.uint8), secret[keep], corpus[keep], held[keep])
                yield pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), *(pa.array([v.tobytes()], pa.binary()) for v in part)], ["group", *_COLUMNS])
        release()

    return drop


def _epoch(state: Training, number: int):
    """The state after each group's epoch, as whole numbers times its rows, summed over the groups of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, (x, secret, _, held) in _groups(batch):
                rows = fit_rows(x[~held], secret[~held].astype(float), np.random.default_rng([5, group]))
                own = Training(state.flat.copy(), state.step)
                own.epoch(*rows, np.random.default_rng([3, group, number]))
                yield pa.RecordBatch.from_arrays([pa.array([group % PARTS]), pa.array([1], pa.int64()), pa.array([own.step], pa.int64()), pa.array(
                    [np.round(own.flat * _WHOLE).astype(np.int64).tobytes()], pa.binary())], ["part", "n", "step", "state"])
        release()

    return run


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_py(), np.int64) for v in table["state"])
    return pa.table([pa.array([sum(table["n"].to_pylist())], pa.int64()), pa.array([max(table["step"].to_pylist())], pa.int64()),
                     pa.array([total.tobytes()], pa.binary())], names=["n", "step", "state"])


def _logits(model: CharCNN):
    """Held-out findings by class, kind and step of their logit; ``held`` false: the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, (x, secret, _, held) in _groups(batch):
                z = np.round(np.clip(model.logits(x), -60, 60) * STEPS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(z), pa.array(secret), pa.array(held)], ["z", "secret", "held"])
        release()

    return run


def _learned(groups: DataFrame, recall: float, noise: float, epochs: int) -> CharCNN:
    state = Training.new(CharCNN.new(np.random.default_rng(7)))
    for number in range(epochs):
        sums = (groups.mapInArrow(_epoch(state, number), "part long, n long, step long, state binary")
                .groupBy("part").applyInArrow(lambda t: _summed(t), "n long, step long, state binary").collect())
        total = sum(np.frombuffer(r.state, np.int64) for r in sums)
        state = Training(total / _WHOLE / sum(r.n for r in sums), max(r.step for r in sums))
    model = state.model
    found = (groups.mapInArrow(_logits(model), "z long, secret boolean, held boolean").groupBy("z", "secret", "held")
             .agg(F.count("*").alias("n")).orderBy("z", "secret", "held").toArrow())
    z, y, held, n = (found[c].to_numpy() for c in ("z", "secret", "held", "n"))
    use = held.astype(bool)
    if not y[use].any() or y[use].all():
        use[:] = True
    y = y[use].astype(float)
    calibrate(model, z[use] / STEPS, y, y == 0, n[use].astype(float), recall, noise)
    return model


def train_on(found: DataFrame, recall: float, noise: float, epochs: int = 12) -> CharCNN | None:
    """Network trained on all rows (window, secret) of ``found``, which are distinct; None if there are none.

    Rows that are no secret are unlabelled findings of the corpus; a first network, which learns from the
    others alone, tells which of them to leave out."""
    found = written(found, "findings")
    n = -(-found.count() // GROUP)
    if not n:
        return None
    dealt = found.withColumn("group", F.pmod(F.xxhash64("window"), F.lit(n)))
    schema = "group long, " + ", ".join(f"{c} binary" for c in _COLUMNS)
    groups = written(dealt.groupBy("group").applyInArrow(_prepared, schema).repartition(n, "group"), "groups")
    labelled = written(groups.mapInArrow(_without_likely(None), schema), "labelled")
    first = _learned(labelled, recall, 1.0, epochs)
    return _learned(written(groups.mapInArrow(_without_likely(first), schema), "likely-out"), recall, noise, epochs)
