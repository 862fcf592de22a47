"""A Bloom filter of fixed size over 128-bit keys, built by Spark and broadcast.

It keeps rows that no other side needs out of a shuffle; an exact join always follows.
Its size is a parameter and does not follow the data: past a few million keys it lets
more rows through, which costs time and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import tidy
from .textbytes import mix

LOG_BITS, PROBES = 26, 3


def _bits(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """PROBES bit numbers of each key."""
    a, b = mix(k1.view(np.uint64)), mix(k2.view(np.uint64)) | np.uint64(1)
    return np.stack([(a + np.uint64(i) * b) >> np.uint64(64 - LOG_BITS) for i in range(PROBES)])


class Bloom:
    def __init__(self, keys: DataFrame, k1: str = "k1", k2: str = "k2"):
        """Bit words are combined in each task and then by place; at most 2**(LOG_BITS - 6) of them come to the driver."""

        def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            have = np.zeros(1 << LOG_BITS - 6, np.uint64)
            for b in batches:
                bit = _bits(*(b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))).ravel()
                np.bitwise_or.at(have, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
            at = np.flatnonzero(have)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(have[at].view(np.int64))], ["at", "bits"])

        with tidy(keys.sparkSession):
            table = keys.select(k1, k2).mapInArrow(words, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
        have = np.zeros(1 << LOG_BITS - 6, np.uint64)
        have[table["at"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
        self._shared = keys.sparkSession.sparkContext.broadcast(have)

    def __getstate__(self):
        return self._shared

    def __setstate__(self, shared):
        self._shared = shared

    def might_hold(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        have, out = self._shared.value, np.ones(len(k1), bool)
        for bit in _bits(k1, k2):
            out &= (have[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return out
