"""Bigram language model by deleted interpolation, over a corpus of any size.

    P(w | u) = l2(b) c(u w) / c(u)  +  l1(b) c(w) / N  +  l0(b) / (V + 1)

Maximum-likelihood estimates of training counts are mixed with weights that depend on
the bucket b of the context's frequency (its number of binary digits). The weights are
learned by expectation-maximisation on a deleted block of the training documents, whose
own counts are left out there; the scores use the counts of all training documents.

Tokens are the words of the text (A-Z lower-cased), then one end token; the context of
the first is a start mark. A word is its 64-bit hash, a context of a word 40 bits.

Counts are too many to be broadcast, and a row for every token too much to shuffle.
Texts are dealt into chunks by their hash. Every task sends, for each range of word
hashes (a bucket), one row with its tokens by chunk; each bucket counts its words and
bigrams over the whole corpus and answers every chunk with the counts of the chunk's
words and bigrams in sorted order. The texts of a chunk then meet the answers, sort
their own tokens the same way and so find the count of each. Copies of a text are sent
once by each task and scored once.

A null text is taken as empty: it is the end token alone. Repeated rows all get a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written
from .textbytes import LOWER, flat, hashes, release, slices, words

TRAIN, DELETED, HELD_OUT = 0, 1, 2
CHUNK_BYTES, FLUSH_BYTES = 8 << 20, 8 << 20
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
CONTEXT_BITS, BUCKETS, OCTAVE = 40, 64, 8
_CONTEXT = np.uint64((1 << CONTEXT_BITS) - 1)
_NONE = -32768


def tokens(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token and context of every place, and each text's first place (n + 1 entries)."""
    raw = LOWER[raw]
    w = words(raw, off)
    n = len(off) - 1
    first = w.first + np.arange(n + 1)
    token = np.empty(len(w.start) + n, np.uint64)
    token[np.arange(len(w.start)) + w.text] = hashes(raw, w.start, w.end)
    token[first[1:] - 1] = END
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[first[:-1]] = START
    return token, context, first


def _range_of(token: np.ndarray, ranges: int) -> np.ndarray:
    return ((token >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)


def _requests(ranges: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch["text"], FLUSH_BYTES):
                chunk = batch["chunk"].slice(at, len(texts)).to_numpy(zero_copy_only=False)
                at += len(texts)
                token, context, first = tokens(*flat(texts))
                own = np.repeat(chunk, np.diff(first))
                order = np.argsort(token)
                order = order[np.argsort(own[order], kind="stable")]
                range_ = _range_of(token[order], ranges)
                by = np.argsort(range_, kind="stable")
                order, range_ = order[by], range_[by]
                token, own, context = token[order], own[order], (context[order] & _CONTEXT)
                new = np.ones(len(token), bool)
                new[1:] = (token[1:] != token[:-1]) | (own[1:] != own[:-1])
                start = np.flatnonzero(new)
                times = np.diff(np.append(start, len(token))).astype(np.uint32)
                five = np.ascontiguousarray(context.view(np.uint8).reshape(-1, 8)[:, :CONTEXT_BITS // 8])
                cuts = np.flatnonzero(np.diff(range_)) + 1
                low, high = np.concatenate([[0], cuts]), np.append(cuts, len(token))
                rows = []
                for a, b in zip(low, high):
                    s = slice(*np.searchsorted(start, [a, b]))
                    rows.append((int(range_[a]), own[start[s]].astype(np.int32).tobytes(), token[start[s]].tobytes(), times[s].tobytes(), five[a:b].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                                  *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 5))],
                                                 ["bucket", "chunks", "words", "times", "contexts"])
                del token, context, own, order, by, range_, five, rows
        release()

    return send


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), kind)


_COUNTS = ("words", "pairs", "deleted_words", "deleted_pairs")
_ANSWER = "chunk int, bucket int, " + ", ".join(f"{c} binary, {c}_more binary" for c in _COUNTS)


def _small(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Counts as a byte each; those of 255 and more are 255 there and follow in full."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype(np.uint32).tobytes()


def _full(table: pa.Table, name: str) -> np.ndarray:
    counts = _joined(table[name], np.uint8).astype(np.int32)
    counts[counts == 255] = _joined(table[f"{name}_more"], np.uint32)
    return counts


def _answers(n_train: int, n_deleted: int):
    """Counts of one bucket's words and bigrams, and an answer for each chunk; chunk -1: what the bucket has in all."""

    def count(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        chunk, word = _joined(table["chunks"], np.int32).astype(np.int64), _joined(table["words"], np.uint64)
        times = _joined(table["times"], np.uint32)
        every, word = np.unique(word, return_inverse=True)
        of = np.repeat(np.arange(len(word), dtype=np.int32), times)
        key = np.zeros(len(of), "<u8")
        key.view(np.uint8).reshape(-1, 8)[:, :CONTEXT_BITS // 8] = _joined(table["contexts"], np.uint8).reshape(-1, CONTEXT_BITS // 8)
        del table
        key |= (word.astype(np.uint64) << np.uint64(CONTEXT_BITS))[of]
        pairs, pair = np.unique(key, return_inverse=True)
        del key
        pair = pair.astype(np.int32)
        weight = times.astype(float)
        total = lambda index, n, use, w=None: np.bincount(index[use], None if w is None else w[use], n).astype(np.uint32)
        train, deleted = chunk < n_train + n_deleted, (chunk >= n_train) & (chunk < n_train + n_deleted)
        words_all, words_del = total(word, len(every), train, weight), total(word, len(every), deleted, weight)
        pairs_all, pairs_del = total(pair, len(pairs), train[of]), total(pair, len(pairs), deleted[of])
        # the distinct words and bigrams of each chunk, in order
        cp = chunk[of] << 32
        cp |= pair
        del of, pair
        cw, cp = np.unique(chunk << 32 | word), np.unique(cp)
        own = np.unique(chunk)
        wb, pb = np.searchsorted(cw >> 32, np.append(own, own[-1] + 1)), np.searchsorted(cp >> 32, np.append(own, own[-1] + 1))
        cw, cp = cw & 0xFFFFFFFF, cp & 0xFFFFFFFF
        rows = []
        for c, a, b, p, q in zip(own, wb[:-1], wb[1:], pb[:-1], pb[1:]):
            row = [int(c), *_small(words_all[cw[a:b]]), *_small(pairs_all[cp[p:q]])]
            if n_train <= c < n_train + n_deleted:  # the counts to leave out matter to the deleted block only
                row += [*_small(words_del[cw[a:b]]), *_small(pairs_del[cp[p:q]])]
            rows.append(row + [b""] * (9 - len(row)))
        sums = np.array([words_all.sum(dtype=np.int64), (words_all > 0).sum(), words_del.sum(dtype=np.int64), (words_all > words_del).sum()], np.int64)
        rows.append([-1, sums.tobytes(), *[b""] * 7])
        del cw, cp, word, chunk, times
        release()
        names = ["chunk", "bucket", *(f"{c}{more}" for c in _COUNTS for more in ("", "_more"))]
        return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([bucket] * len(rows), pa.int32()),
                         *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 9))], names=names)

    return count


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct texts of a task, compressed in one row for each chunk and slice."""
    seen: set[tuple[int, int, int]] = set()
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        at = 0
        for texts in slices(batch["text"], FLUSH_BYTES):
            part = batch.slice(at, len(texts))
            at += len(texts)
            raw, off = flat(texts)
            key = np.stack([part[c].to_numpy(zero_copy_only=False) for c in ("chunk", "t1", "t2")], axis=1).astype(np.int64)
            rows: dict[int, list[int]] = {}
            for i, k in enumerate(map(tuple, key.tolist())):
                if k not in seen:
                    seen.add(k)
                    rows.setdefault(k[0], []).append(i)
            whole = raw.tobytes()
            out = [(c, key[own, 1:].tobytes(), np.diff(off)[own].tobytes(), press.compress(b"".join(whole[off[i]:off[i + 1]] for i in own)))
                   for c, own in rows.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), *(pa.array([r[i] for r in out], pa.binary()) for i in (1, 2, 3))],
                                             ["chunk", "keys", "sizes", "texts"])
            del raw, whole, out
    release()


def _counted(left: pa.Table, right: pa.Table, prefixes: tuple[str, ...]):
    """Keys of a chunk's distinct texts, their first places, and for each prefix the counts (word, bigram, context)
    of each token: "" in all training documents, "deleted_" in the deleted block."""
    keys, sizes, blobs, seen = [], [], [], set()
    opened = zstandard.ZstdDecompressor()
    for row in left.select(["keys", "sizes", "texts"]).to_pylist():
        blob, at = opened.decompress(row["texts"]) if row["texts"] else b"", 0
        for k, n in zip(np.frombuffer(row["keys"], np.int64).reshape(-1, 2).tolist(), np.frombuffer(row["sizes"], np.int64).tolist()):
            if tuple(k) not in seen:
                seen.add(tuple(k))
                keys.append(k)
                sizes.append(n)
                blobs.append(blob[at:at + n])
            at += n
    off = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
    token, context, first = tokens(np.frombuffer(b"".join(blobs), np.uint8), off)
    right = right.sort_by("bucket")
    every, word = np.unique(token, return_inverse=True)
    end = np.searchsorted(every, END)
    if len(every) >= 1 << (64 - CONTEXT_BITS):
        raise OverflowError("a text has more distinct words than bigrams can be numbered with")
    pairs, pair = np.unique((word.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | (context & _CONTEXT), return_inverse=True)
    del token, context
    out = []
    for prefix in prefixes:
        words_, pairs_ = _full(right, f"{prefix}words"), _full(right, f"{prefix}pairs")
        if len(every) != len(words_) or len(pairs) != len(pairs_):
            raise RuntimeError("a chunk's texts and its answers don't match")
        c = words_[word]
        before = np.empty_like(c)
        before[1:] = c[:-1]
        before[first[:-1]] = words_[end]  # as many starts as ends
        out.append((c, pairs_[pair], before))
    return np.array(keys, np.int64).reshape(-1, 2), first, *out


def _bucket(context_count: np.ndarray) -> np.ndarray:
    """Number of binary digits."""
    return np.frexp(context_count.astype(float))[1].clip(0, BUCKETS - 1)


def _ratios(c: tuple[np.ndarray, np.ndarray, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    word, pair, context = c
    return np.where(context > 0, pair / np.maximum(context, 1), 0.0), word / max(n, 1)


def _events(n: int):
    """How often each (bucket, p2, p1) comes on the deleted block, its own counts left out; p2 and p1 in eighths of octaves."""

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = ["b", "p2", "p1", "n"]
        if not left.num_rows:
            return pa.table([pa.array([], pa.int32()), pa.array([], pa.int32()), pa.array([], pa.int32()), pa.array([], pa.int64())], names=kinds)
        _, _, full, deleted = _counted(left, right, ("", "deleted_"))
        rest = tuple(a - b for a, b in zip(full, deleted))
        with np.errstate(divide="ignore"):
            cell = [np.where(p > 0, np.round(OCTAVE * np.log2(np.maximum(p, 1e-300))), _NONE).astype(np.int64) for p in _ratios(rest, n)]
        key = (_bucket(rest[2]).astype(np.int64) << 32) | ((cell[0] - _NONE) << 16) | (cell[1] - _NONE)
        key, times = np.unique(key, return_counts=True)
        del full, deleted, rest, cell
        release()
        return pa.table([pa.array((key >> 32).astype(np.int32)), pa.array(((key >> 16 & 0xFFFF) + _NONE).astype(np.int32)),
                         pa.array(((key & 0xFFFF) + _NONE).astype(np.int32)), pa.array(times)], names=kinds)

    return count


def expectation_maximisation(b: np.ndarray, p: np.ndarray, n: np.ndarray, rounds: int = 60) -> np.ndarray:
    """BUCKETS x 3 mixture weights from events: bucket, the three estimates, how often. A
    bucket counts one event of the weights over all buckets besides its own, so that
    buckets with few events or none follow these."""
    def fit(p, n, prior, strength):
        l = np.full(3, 1 / 3)  # noqa: E741
        for _ in range(rounds):
            mixed = p * l
            share = n @ (mixed / np.maximum(mixed.sum(axis=1, keepdims=True), 1e-300)) + strength * prior
            l = share / share.sum()  # noqa: E741
        return l

    overall = fit(p, n, np.full(3, 1 / 3), 1.0)
    return np.stack([fit(p[b == k], n[b == k], overall, 1.0) for k in range(BUCKETS)])


def _scores(weights: np.ndarray, n: int, v: int):
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["chunk", "t1", "t2", "n_tokens", "n_known", "base_score", "score"]
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int32(), *[pa.int64()] * 4, pa.float64(), pa.float64())], names=names)
        keys, first, full = _counted(left, right, ("",))
        p2, p1 = _ratios(full, n)
        l = weights[_bucket(full[2])]  # noqa: E741
        p = np.log10(l[:, 0] * p2 + l[:, 1] * p1 + l[:, 2] / (v + 1))
        base = np.log10((full[0] + 1) / (n + 1 * (v + 1)))
        total = lambda x: np.add.reduceat(x, first[:-1])
        del p2, p1, l
        release()
        return pa.table([pa.array([left["chunk"][0].as_py()] * len(keys), pa.int32()), pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                         pa.array(np.diff(first)), pa.array(total((full[0] > 0).astype(np.int64))), pa.array(total(base)), pa.array(total(p))], names=names)

    return score


class DeletedInterpolation:
    """``documents``: the input rows' id, role and scores. ``role`` is TRAIN, DELETED (training too) or HELD_OUT."""

    def __init__(self, docs: DataFrame, role: Column, id_column: str = "doc_id", text: str = "text"):
        spark = docs.sparkSession
        own = docs.select(F.col(f"`{id_column}`").alias("doc_id"), role.cast("int").alias("role"),
                          F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
        size = dict(own.groupBy("role").agg(F.sum(F.octet_length("text"))).collect())
        every, least = sum(size.values()) or 1, int(spark.conf.get("spark.sql.shuffle.partitions"))
        n = [max(1, -(-size.get(r, 0) // CHUNK_BYTES), round(least * size.get(r, 0) / every)) for r in (TRAIN, DELETED, HELD_OUT)]
        first = [0, n[0], n[0] + n[1]]
        places = [F.lit(first[r]) + F.pmod("t1", F.lit(n[r])) for r in range(3)]
        chunk = F.when(F.col("role") == TRAIN, places[0]).when(F.col("role") == DELETED, places[1]).otherwise(places[2])
        own = own.withColumn("t1", F.xxhash64("text")).withColumn("t2", F.xxhash64(F.lit(1), "text")).withColumn("chunk", chunk.cast("int"))

        asked = own.select("chunk", "text").mapInArrow(_requests(sum(n)), "bucket int, chunks binary, words binary, times binary, contexts binary")
        answers = written(asked.groupBy("bucket").applyInArrow(_answers(n[0], n[1]), _ANSWER), "counts")
        sums = answers.filter("chunk = -1").select("words").mapInArrow(
            lambda batches: (pa.RecordBatch.from_arrays([pa.array(x) for x in np.stack(
                [np.frombuffer(v.as_py(), np.int64) for v in b["words"]], axis=1)], ["n", "v", "d", "r"]) for b in batches if b.num_rows),
            "n long, v long, d long, r long").agg(F.sum("n"), F.sum("v"), F.sum("d"), F.sum("r")).first()
        self.tokens, self.types, deleted, rest_types = (int(x or 0) for x in sums)
        answers = answers.filter("chunk >= 0")
        chunks = lambda rows: rows.select("chunk", "t1", "t2", "text").mapInArrow(_packed, "chunk int, keys binary, sizes binary, texts binary")
        block = (F.col("chunk") >= first[1]) & (F.col("chunk") < first[2])
        events = (chunks(own.filter(block)).groupBy("chunk").cogroup(answers.filter(block).groupBy("chunk"))
                  .applyInArrow(_events(self.tokens - deleted), "b int, p2 int, p1 int, n long")
                  .groupBy("b", "p2", "p1").agg(F.sum("n").alias("n")).toArrow())
        b, p2, p1, times = (events[c].to_numpy() for c in ("b", "p2", "p1", "n"))
        p = np.stack([np.where(x == _NONE, 0.0, 2.0 ** (x / OCTAVE)) for x in (p2, p1)] + [np.full(len(b), 1 / (rest_types + 1))], axis=1)
        self.weights = expectation_maximisation(b, p, times)
        scores = (chunks(own).groupBy("chunk").cogroup(answers.groupBy("chunk"))
                  .applyInArrow(_scores(self.weights, self.tokens, self.types),
                                "chunk int, t1 long, t2 long, n_tokens long, n_known long, base_score double, score double"))
        self.documents = own.select("doc_id", "role", "chunk", "t1", "t2").join(scores, ["chunk", "t1", "t2"]).drop("chunk", "t1", "t2")
