"""Alignment of two tokenizers' tokens over the same texts.

Every text is encoded by a byte-level BPE (with a space before it) and by a SentencePiece
model (which adds that space). The ends of the tokens in bytes, summed up, are keys of a
dictionary from end to index for each side; the keys that both have cut the two id
lists into groups, slice by slice, and the links of a slice are its tokens whose byte
ranges end together: its last ones, as no token is empty.

Neither tokenizer has a token across a single space between two visible characters, so the
text is cut there and every distinct segment is encoded and aligned once per task;
its groups and links are reused wherever it occurs (the tests hold this against whole texts).

Counts over the whole corpus: texts are taken in chunks of a few MB. A chunk hands out its
distinct id pairs with their counts once, Spark sums them by pair, finds the highest count of each id of
the second tokenizer, and joins the answers back to the chunks. A frequent pair is one row a chunk, so
no key is hotter than the number of chunks; a chunk's documents and answers meet in
one task, a few MB whatever the corpus.

A text that is null or empty, or whose tokens of either side do not give back its bytes (one that
holds U+2581, for instance), has no tokens: zeros and ''. Strings of special tokens in a text
are text. Very long texts are one chunk each; only a single segment (no such space) is encoded as one.
Repeated rows are separate occurrences, each counted and returned; null ids stay null. Ties for the highest
count all count as best. An empty table gives no rows. Only the id and the text
column are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import written
from .textbytes import release, slices

CHUNK_BYTES = 8 << 20
_VISIBLE = "\x21-\x7eÀ-ɏ"
_CUT = re.compile(f"(?<=[{_VISIBLE}]) (?=[{_VISIBLE}])")
_ODD = re.compile(f"^ | $|[^{_VISIBLE}] | [^{_VISIBLE}]")
_SEEN = frozenset(chr(x) for x in [*range(0x21, 0x7F), *range(0xC0, 0x250)])
_SEGMENTS = 500_000
_RUN, _RUNS = 256, 16
_B = (1 << 32) - 1


def common_ends(a_ends: Sequence[int], b_ends: Sequence[int]) -> tuple[list[int], list[int]]:
    """For each end that both sides have, in order, the number of tokens up to it on each."""
    a_at, b_at = dict(zip(a_ends, range(1, len(a_ends) + 1))), dict(zip(b_ends, range(1, len(b_ends) + 1)))
    ends = sorted(a_at.keys() & b_at.keys())
    return list(map(a_at.__getitem__, ends)), list(map(b_at.__getitem__, ends))


def slices_between(ids: Sequence[int], cuts: list[int]) -> list[Sequence[int]]:
    return [ids[i:j] for i, j in zip([0, *cuts], cuts)]


def align(a_ids: Sequence[int], a_ends: Sequence[int], b_ids: Sequence[int], b_ends: Sequence[int]) -> list[tuple[Sequence[int], Sequence[int]]]:
    """Groups of ids of both sides between ends that both sides have."""
    a_cuts, b_cuts = common_ends(a_ends, b_ends)
    return list(zip(slices_between(a_ids, a_cuts), slices_between(b_ids, b_cuts)))


def shown(a: Sequence[int], b: Sequence[int]) -> str:
    return f"{a[0]}|{b[0]}" if len(a) == len(b) == 1 else f"{','.join(map(str, a))}|{','.join(map(str, b))}"


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of ranges laid end to end."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def segments_of(text: str) -> list[str]:
    """What single spaces between visible characters separate."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


class Aligner:
    """Alignments of distinct segments. Fresh segments are laid end to end, as a text that
    is cut only where neither tokenizer joins, so one pass of each tokenizer and one
    alignment serve thousands of them."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        self.a_bytes, self.b_bytes = self._a_bytes(), self._b_bytes()
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self._keep({}, [], np.zeros((0, 5), np.int64), np.zeros(0, np.int64))

    def _a_bytes(self) -> list[bytes]:
        """Bytes of every id: the byte-level alphabet shows printable Latin-1 bytes as themselves, the others from U+0100 on."""
        itself = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [x for x in range(256) if x not in set(itself)]
        code = {chr(x): x for x in itself} | {chr(256 + n): x for n, x in enumerate(others)}
        tokens = (self.a.id_to_token(i) for i in range(self.a.get_vocab_size()))
        return [bytes(code[c] for c in t) if all(c in code for c in t) else t.encode() for t in tokens]

    def _b_bytes(self) -> list[bytes]:
        n = self.b.get_piece_size()
        return [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
                for i in range(n)]

    def _keep(self, known: dict[str, int], groups: list[str], sizes: np.ndarray, links: np.ndarray) -> None:
        """``sizes``: number of tokens of both sides (-1: bytes not given back), groups, first link and number of links."""
        self.known, self.groups, self.sizes, self.links = known, groups, sizes, links
        self.seen = np.zeros(len(sizes), np.int64)

    def _forget(self) -> None:
        """Only segments met more than once since the last time stay."""
        stay = np.flatnonzero(self.seen > 1)[-_SEGMENTS // 2:]
        names = list(self.known)
        sizes = self.sizes[stay]
        links = self.links[_ragged(sizes[:, 3], sizes[:, 4])]
        sizes[:, 3] = np.cumsum(sizes[:, 4]) - sizes[:, 4]
        self._keep({names[k]: n for n, k in enumerate(stay)}, [self.groups[k] for k in stay], sizes, links)

    def _aligned(self, runs: list[list[str]]) -> list[str]:
        """Learn the segments of each run, encoded as one text; those of runs whose bytes do not come back are returned."""
        texts = [" ".join(r) for r in runs]
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        ids_b = self.b.encode(texts, num_threads=1)
        refused: list[str] = []
        good = []
        for n, text in enumerate(texts):
            whole = (" " + text).encode()
            if b"".join(map(self.a_bytes.__getitem__, ids_a[n])) == whole == b"".join(map(self.b_bytes.__getitem__, ids_b[n])):
                good.append(n)
            else:
                refused += runs[n]
        a_ids, b_ids = [i for n in good for i in ids_a[n]], [i for n in good for i in ids_b[n]]
        a, b = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_cuts, b_cuts = common_ends(a_ends.tolist(), b_ends.tolist())
        texts = list(map(shown, slices_between(a_ids, a_cuts), slices_between(b_ids, b_cuts)))
        a_last, b_last = np.array(a_cuts, np.int64) - 1, np.array(b_cuts, np.int64) - 1
        segments = [s for n in good for s in runs[n]]
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, segments)), np.int64, len(segments)) + 1)  # each has a space before it
        cuts = [np.concatenate([[0], np.searchsorted(at, ends, "right")]) for at in (a_ends, b_ends, a_ends[a_last])]
        base, first = len(self.sizes), len(self.links)
        n_groups = np.diff(cuts[2])
        self.sizes = np.concatenate([self.sizes, np.stack([np.diff(cuts[0]), np.diff(cuts[1]), n_groups, first + cuts[2][:-1], n_groups], axis=1)])
        self.links = np.concatenate([self.links, a[a_last] << 32 | b[b_last]])
        self.seen = np.concatenate([self.seen, np.zeros(len(segments), np.int64)])
        bounds = cuts[2].tolist()
        self.groups += [";".join(texts[i:j]) for i, j in zip(bounds[:-1], bounds[1:])]
        for n, s in enumerate(segments, base):
            self.known[s] = n
        return refused

    def _learn(self, fresh: list[str]) -> None:
        plain = [s for s in fresh if s[:1] in _SEEN and s[-1:] in _SEEN]
        runs = [plain[at:at + _RUN] for at in range(0, len(plain), _RUN)]
        done = set(plain)
        alone = [s for s in fresh if s not in done]
        again = [s for at in range(0, len(runs), _RUNS) for s in self._aligned(runs[at:at + _RUNS])]
        alone += again
        for s in [s for at in range(0, len(alone), _RUN) for s in self._aligned([[s] for s in alone[at:at + _RUN]])]:
            self.known[s] = len(self.groups)
            self.groups.append("")
            self.sizes = np.concatenate([self.sizes, [[-1, 0, 0, 0, 0]]])
            self.seen = np.concatenate([self.seen, [0]])

    def take(self, segments: list[str]) -> np.ndarray:
        """Number of each segment's alignment."""
        if len(self.known) > _SEGMENTS:
            self._forget()
        fresh = list(set(segments) - self.known.keys())
        if fresh:
            self._learn(fresh)
        out = np.fromiter(map(self.known.__getitem__, segments), np.int64, len(segments))
        self.seen += np.bincount(out, minlength=len(self.seen))
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _chunk(aligner: Aligner, texts: list[str | None]):
    """Counts and digests of the texts, the chunk's distinct pairs with counts, and each text's links as places among them."""
    segments = [segments_of(t) if t else [] for t in texts]
    first = np.concatenate([[0], np.cumsum([len(s) for s in segments])])
    number = aligner.take([s for part in segments for s in part])
    del segments
    used, at = np.unique(number, return_inverse=True)
    sizes = aligner.sizes[used]
    groups = [aligner.groups[k] for k in used]
    of = np.repeat(np.arange(len(texts)), np.diff(first))
    bad = np.zeros(len(texts), bool)
    bad[of[sizes[at, 0] < 0]] = True
    keep = ~bad[of]
    at, of = at[keep], of[keep]
    n = np.stack([np.bincount(of, sizes[at, c], len(texts)) for c in range(3)]).astype(np.int64)
    ends = np.searchsorted(of, np.arange(len(texts) + 1))
    order = at.tolist()
    digests = [hashlib.sha256(";".join([groups[k] for k in order[a:b]]).encode()).hexdigest() if b > a else "" for a, b in zip(ends[:-1], ends[1:])]
    del order, groups
    lengths = sizes[:, 4]
    pairs, place = np.unique(aligner.links[_ragged(sizes[:, 3], lengths)], return_inverse=True)
    starts = np.cumsum(lengths) - lengths
    places = place[_ragged(starts[at], lengths[at])].astype(np.uint16 if len(pairs) <= 1 << 16 else np.uint32)
    per_text = np.bincount(of, lengths[at], len(texts)).astype(np.int64)
    cut = np.concatenate([[0], np.cumsum(per_text)])
    raw = memoryview(places.tobytes())
    width = places.itemsize
    blobs = [bytes(raw[width * a:width * b]) for a, b in zip(cut[:-1], cut[1:])]
    return n, per_text, digests, blobs, pairs, np.bincount(places, minlength=len(pairs))


class TokenAlignment:
    """``pairs()``: id pairs of the whole corpus; ``documents()``: one row per input row."""

    def __init__(self, docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text", chunk_bytes: int = CHUNK_BYTES):
        rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
        self.id = rows.schema[0]
        schema = T.StructType([self.id] + [T.StructField(c, T.LongType()) for c in ("chunk", "n_a", "n_b", "n_groups", "n_links")]
                              + [T.StructField("groups_sha256", T.StringType())] + [T.StructField(c, T.BinaryType()) for c in ("places", "pairs", "counts")])

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = _aligner(path_a, path_b)
            chunk = TaskContext.get().partitionId() << 40
            for b in batches:
                at = 0
                for texts in slices(b["text"], chunk_bytes):
                    n, n_links, digests, blobs, pairs, counts = _chunk(aligner, texts.to_pylist())
                    m = len(texts)
                    none = pa.nulls(m, pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(at, m), pa.array(np.full(m, chunk)), *(pa.array(c) for c in n), pa.array(n_links), pa.array(digests, pa.string()),
                         pa.array(blobs, pa.binary()), none, none], schema.names)
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(1, b.schema.field(0).type), pa.array([chunk]), *(pa.nulls(1, pa.int64()) for _ in range(4)), pa.nulls(1, pa.string()),
                         pa.nulls(1, pa.binary()), pa.array([pairs.tobytes()], pa.binary()), pa.array([counts.astype(np.int64).tobytes()], pa.binary())], schema.names)
                    at += m
                    chunk += 1
                    del n, n_links, digests, blobs, pairs, counts, texts
                del b
            release()

        self.encoded = written(rows.mapInArrow(encode, schema), "token-links")
        self._pairs: DataFrame | None = None

    def _chunk_pairs(self) -> DataFrame:
        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for chunk, pairs, counts in zip(b["chunk"].to_pylist(), b["pairs"], b["counts"]):
                    p, k = np.frombuffer(pairs.as_buffer(), np.int64), np.frombuffer(counts.as_buffer(), np.int64)
                    own = np.flatnonzero(k)
                    for at in range(0, len(own), 1 << 16):
                        part = own[at:at + (1 << 16)]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), chunk)), pa.array(part.astype(np.int32)), pa.array(p[part]), pa.array(k[part])],
                                                         ["chunk", "place", "pair", "k"])
            release()

        return self.encoded.filter(F.col("pairs").isNotNull()).select("chunk", "pairs", "counts").mapInArrow(unpack, "chunk long, place int, pair long, k long")

    def pairs(self) -> DataFrame:
        """pair (id of the first tokenizer * 2**32 + id of the second), a_id, b_id, count and whether it is the highest of its b_id."""
        if self._pairs is None:
            total = written(self._chunk_pairs().groupBy("pair").agg(F.sum("k").alias("count")), "token-pairs")
            total = total.withColumn("b_id", F.col("pair").bitwiseAND(_B).cast("int"))
            highest = total.groupBy("b_id").agg(F.max("count").alias("highest"))  # a row an id: bounded by the vocabulary
            self._pairs = total.join(F.broadcast(highest), "b_id").select(
                "pair", F.shiftright("pair", 32).cast("int").alias("a_id"), "b_id", "count", (F.col("count") == F.col("highest")).alias("best"))
        return self._pairs

    def documents(self) -> DataFrame:
        """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
        answers = self._chunk_pairs().select("chunk", "place", "pair").join(self.pairs().select("pair", "count", "best"), "pair").select("chunk", "place", "count", "best")
        docs = self.encoded.filter(F.col("pairs").isNull()).drop("pairs", "counts")
        schema = T.StructType([self.id] + [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
                              + [T.StructField("groups_sha256", T.StringType())])

        def settle(own: pa.Table, answered: pa.Table) -> pa.Table:
            place = answered["place"].to_numpy()
            top = int(place.max(initial=-1)) + 1
            count, best = np.zeros(top, np.int64), np.zeros(top, bool)
            count[place], best[place] = answered["count"].to_numpy(), answered["best"].to_numpy()
            n_best, total = [], []
            for n, raw in zip(own["n_links"].to_pylist(), own["places"]):
                if n:
                    raw = raw.as_buffer()
                    at = np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32)
                    n_best.append(int(best[at].sum()))
                    total.append(int(count[at].sum()))
                else:
                    n_best.append(0)
                    total.append(0)
            return own.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"]).append_column("n_best", pa.array(n_best, pa.int64())).append_column(
                "count_sum", pa.array(total, pa.int64())).append_column("groups_sha256", own["groups_sha256"])

        return docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(settle, schema)
