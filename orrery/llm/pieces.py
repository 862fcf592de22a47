"""Sampled segmentations into the pieces of a SentencePiece model, and their decoding.

A text gets a leading space, spaces become the mark of word starts, and every way to cut
it into pieces is a path through a lattice. Paths are sampled with probability
proportional to the product of their pieces' weights: forward sums over the lattice
(filtering), then pieces drawn from the end backwards (sampling). A piece of rank r (by
score) weighs (2 + r) ** -alpha, as the scores of a BPE model are ranks and no logarithms.

No piece crosses from a character into the space after it, so lattices are those of
single words with the spaces before them; the forward sums of a word are found once for
all its places in a slice of texts. Characters that are no piece stand as their UTF-8
bytes, which are pieces; so does the mark itself where a text has it, which keeps
decoding lossless.

Draws depend on the row key, the word's number in the text, and the step alone, so the
same row always gives the same pieces, whatever its partition. A null or empty text has
no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .textbytes import flat, hashes, mix, release, slices

MARK, SLICE, LONG = 0x2581, 2 << 20, 64
_B, _C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ENCODED = pa.struct([("n_pieces", pa.int64()), ("ids", pa.binary())])


class Pieces:
    """Pieces of a model by hash: for each length the sorted hashes of pieces' prefixes, with the piece that each
    is (-1: none) and whether longer pieces begin with it."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        text = [model.id_to_piece(i) for i in range(n)]
        self.byte_id = np.zeros(256, np.int64)
        plain, decoded = [], []
        for i, p in enumerate(text):
            if model.is_byte(i):
                self.byte_id[int(p[1:-1], 16)] = i
                decoded.append(bytes([int(p[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                decoded.append(b"")
            else:
                plain.append(i)
                decoded.append(p.replace(chr(MARK), " ").encode())
        rank = sorted(plain, key=lambda i: (-model.get_score(i), i))
        self.weight = np.zeros(n)
        self.weight[rank] = (2.0 + np.arange(len(rank))) ** -alpha
        self.known = np.zeros(0x110000, bool)
        prefixes: dict[int, dict[int, list[int]]] = {}
        for i in plain:
            h = 0
            points = [32 if ord(c) == MARK else ord(c) for c in text[i]]
            if len(points) == 1:
                self.known[points[0]] = True
            for k, c in enumerate(points, 1):
                h = (h * int(_B) + c + 1) % (1 << 64)
                own = prefixes.setdefault(k, {}).setdefault(h, [-1, 0])
                if k == len(points):
                    own[0] = i
                else:
                    own[1] = 1
        self.hash, self.id, self.longer = [], [], []
        for k in sorted(prefixes):
            own = sorted(prefixes[k].items())
            self.hash.append(np.array([h for h, _ in own], np.uint64))
            self.id.append(np.array([x[0] for _, x in own], np.int32))
            self.longer.append(np.array([x[1] for _, x in own], bool))
        self.start = np.concatenate([[0], np.cumsum([len(d) for d in decoded])])
        self.bytes = np.frombuffer(b"".join(decoded), np.uint8)

    def matches(self, points: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, id) of every piece that starts at a place and has at most ``left`` characters."""
        out, at, h = [], np.arange(len(points), dtype=np.int32), np.zeros(len(points), np.uint64)
        for k, (table, ids, longer) in enumerate(zip(self.hash, self.id, self.longer), 1):
            h = h * _B + points[at + (k - 1)].astype(np.uint64) + np.uint64(1)
            i = np.minimum(np.searchsorted(table, h), len(table) - 1)
            hit = np.flatnonzero(table[i] == h)
            i = i[hit]
            own = ids[i] >= 0
            out.append((at[hit[own]], np.full(int(own.sum()), k, np.int32), ids[i[own]]))
            hit = hit[longer[i]]
            hit = hit[left[at[hit]] > k]
            at, h = at[hit], h[hit]
            if not len(at):
                break
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int32),) * 3


_MODELS: dict[tuple[str, float], Pieces] = {}


def _model(path: str, alpha: float) -> Pieces:
    if (path, alpha) not in _MODELS:
        _MODELS[path, alpha] = Pieces(path, alpha)
    return _MODELS[path, alpha]


class Lattices:
    """Lattices of distinct words, one after the other: node numbers are places in them, each word has one more
    node than characters. Edges are in the order of the nodes that they end in; ``total`` is the cumulative
    probability of each among those of its node."""

    def __init__(self, model: Pieces, points: np.ndarray, size: np.ndarray):
        size = size.astype(np.int32)
        first = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        word = np.repeat(np.arange(len(size), dtype=np.int32), size)
        left = first[1:][word] - np.arange(len(points), dtype=np.int32)
        place, length, piece = model.matches(points, left)
        tail = place + word[place]
        del place, word, left
        self.start = first[:-1] + np.arange(len(size), dtype=np.int32)  # a word's first node
        self.end = self.start + size
        order = np.argsort(tail + length, kind="stable").astype(np.int32)
        tail, piece = tail[order], piece[order]
        head = tail + length[order]
        del order, length
        n = int(self.end[-1]) + 1 if len(size) else 0
        edges = np.searchsorted(head, np.arange(n + 1, dtype=np.int32)).astype(np.int32)
        chance = model.weight[piece]
        sums = np.zeros(n)
        sums[self.start] = 1.0
        # all words at once, character by character: the edges into their nodes of one level
        level = np.arange(n, dtype=np.int32) - np.repeat(self.start, size + 1)
        level[np.repeat(size > LONG, size + 1)] = 0
        nodes = np.argsort(level, kind="stable").astype(np.int32)
        cuts = np.searchsorted(level[nodes], np.arange(1, LONG + 2))
        count = np.diff(edges)
        del level
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = nodes[a:b]
            if not len(own):
                break
            many = count[own]
            into = np.cumsum(many)
            e = np.repeat(edges[own] - (into - many), many) + np.arange(into[-1], dtype=np.int32)
            chance[e] *= sums[tail[e]]
            sums[own] = np.add.reduceat(chance[e], into - many)
        for w in np.flatnonzero(size > LONG):
            self._forward(w, sums, chance, edges, tail, piece, model.weight)
        chance /= np.maximum(sums[head], 1e-300)
        np.cumsum(chance, out=chance)
        chance -= np.repeat(np.concatenate([[0.0], chance])[edges[:-1]], count)
        self.total = np.minimum(chance, 1.0, out=chance)
        self.first, self.last = edges[:-1], edges[1:] - 1
        self.piece, self.tail = piece, tail

    def _forward(self, w: int, sums: np.ndarray, chance: np.ndarray, edges: np.ndarray, tail: np.ndarray,
                 piece: np.ndarray, weight: np.ndarray) -> None:
        """One long word: the sums that later nodes need are scaled at every node, so they neither vanish nor overflow."""
        start, end = int(self.start[w]), int(self.end[w])
        e0 = int(edges[start])
        t, x = tail[e0:int(edges[end + 1])].tolist(), weight[piece[e0:int(edges[end + 1])]].tolist()
        bound = (edges[start:end + 2] - e0).tolist()
        scaled, exponent = [1.0], [0.0]
        for node in range(1, end - start + 1):
            a, b = bound[node], bound[node + 1]
            top = max(exponent[t[i] - start] for i in range(a, b))
            parts = [scaled[t[i] - start] * exp(exponent[t[i] - start] - top) * x[i] for i in range(a, b)]
            s = sum(parts)
            chance[e0 + a:e0 + b] = [p / s for p in parts]
            sums[start + node] = 1.0
            scaled.append(1.0)
            exponent.append(top + log(s))

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge into each node: the first one whose cumulative probability is over u."""
        edge, last = self.first[node], self.last[node]
        todo = np.flatnonzero((self.total[edge] <= u) & (edge < last))
        while len(todo):
            edge[todo] += 1
            todo = todo[(self.total[edge[todo]] <= u[todo]) & (edge[todo] < last[todo])]
        return edge


def _words(model: Pieces, raw: np.ndarray, off: np.ndarray):
    """The texts' bytes with a space before each that is not empty; start, end and text of each word in them; code
    points with their first bytes, and which words are single characters without a piece."""
    some = np.diff(off) > 0
    spaced = np.full(len(raw) + int(some.sum()), 32, np.uint8)
    shift = np.cumsum(some)
    spaced[np.arange(len(raw)) + np.repeat(shift, np.diff(off))] = raw
    off = off + np.concatenate([[0], shift])
    points = np.frombuffer(spaced.tobytes().decode().encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((spaced & 0xC0) != 0x80)
    strange = ~model.known[points]
    space = points == 32
    start = np.zeros(len(points), bool)
    start[1:] = (space[1:] & ~space[:-1]) | strange[1:] | strange[:-1]
    start[np.searchsorted(at, off[:-1][some])] = True
    first = np.flatnonzero(start)
    begin = at[first]
    end = np.append(begin[1:], len(spaced))
    text = np.searchsorted(off, begin, "right") - 1
    return spaced, points, first, begin, end, text, strange[first]


def sampled(model: Pieces, raw: np.ndarray, off: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts, and for each text where its own begin (n + 1 entries)."""
    n = len(off) - 1
    spaced, points, first, begin, end, text, strange = _words(model, raw, off)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    count = np.diff(np.append(first, len(points)))
    number = np.arange(len(first)) - np.searchsorted(text, np.arange(n))[text]
    usual = np.flatnonzero(~strange)
    code, _ = pd.factorize(hashes(spaced, begin[usual], end[usual]))
    sample = np.zeros(code.max(initial=-1) + 1, np.int64)
    sample[code[::-1]] = usual[::-1]
    size = count[sample]
    places = np.repeat(first[sample] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(sample) else np.zeros(0, np.int64)
    lattices = Lattices(model, points[places], size)
    seed = mix(mix(key.view(np.uint64) ^ _C1)[text] + number.astype(np.uint64) * _C2)
    at, node, stop, step = usual, lattices.end[code], lattices.start[code], 0
    steps = []
    while len(at):
        u = (mix(seed[at] + np.uint64((step + 1) * int(_C1) % (1 << 64))) >> np.uint64(11)).astype(float) * 2.0 ** -53
        edge = lattices.draw(node, u)
        steps.append((at, lattices.piece[edge]))
        node = lattices.tail[edge]
        more = node > stop
        at, node, stop, step = at[more], node[more], stop[more], step + 1
    pieces = np.zeros(len(first), np.int64)
    for at, _ in steps:
        pieces[at] += 1
    odd = np.flatnonzero(strange)
    pieces[odd] = end[odd] - begin[odd]
    place = np.concatenate([[0], np.cumsum(pieces)])
    ids = np.zeros(place[-1], np.int64)
    for k, (at, piece) in enumerate(steps):
        ids[place[at + 1] - 1 - k] = piece
    if len(odd):
        long = pieces[odd]
        of = np.repeat(np.arange(len(odd)), long)
        k = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
        ids[place[odd][of] + k] = model.byte_id[spaced[begin[odd][of] + k]]
    return ids, place[np.searchsorted(text, np.arange(n + 1))]


def encode_sampled(text: Column, key: Column, model_path: str, alpha: float = 0.5) -> Column:
    """Struct of each text: number of pieces, and their ids as little-endian unsigned 32-bit numbers. ``key`` is a
    long that seeds the draws; ``model_path`` a model file that every executor can open."""

    @F.arrow_udf("struct<n_pieces:long,ids:binary>")
    def udf(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = _model(model_path, alpha)
        for batch, keys in batches:
            parts, at = [pa.array([], _ENCODED)], 0
            seeds = keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for texts in slices(batch, SLICE):
                ids, place = sampled(model, *flat(texts), seeds[at:at + len(texts)])
                at += len(texts)
                data = ids.astype("<u4").tobytes()
                blob = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer((4 * place).tobytes()), pa.py_buffer(data)])
                parts.append(pa.StructArray.from_arrays([pa.array(np.diff(place)), blob.cast(pa.binary())], ["n_pieces", "ids"]))
                del ids, place, data, blob
            out = pa.concat_arrays(parts)
            del batch, keys, parts
            release()
            yield out
            del out
        release()

    return udf(text.cast("string"), key.cast("long"))


def decode(ids: Column, model_path: str) -> Column:
    """Text of ids as ``encode_sampled`` gives them."""

    @F.arrow_udf("string")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _model(model_path, 1.0)
        size = np.diff(model.start)
        for batch in batches:
            parts = [pa.array([], pa.string())]
            for some in slices(batch, SLICE):
                data, off = flat(some)
                id_ = np.frombuffer(data.tobytes(), "<u4").astype(np.int64)
                own = size[id_]
                ends = np.concatenate([[0], np.cumsum(own)])
                raw = model.bytes[np.arange(ends[-1]) + np.repeat(model.start[id_] - ends[:-1], own)]
                bound = ends[off // 4]
                blank = np.diff(bound) > 0  # the leading space goes
                keep = np.ones(len(raw), bool)
                keep[bound[:-1][blank]] = False
                bound = (bound - np.concatenate([[0], np.cumsum(blank)])).astype(np.int64)
                text = pa.Array.from_buffers(pa.large_string(), len(some), [None, pa.py_buffer(bound.tobytes()), pa.py_buffer(raw[keep].tobytes())])
                parts.append(text.cast(pa.string()))
                del data, id_, raw, keep, text
            out = pa.concat_arrays(parts)
            del batch, parts
            release()
            yield out
            del out
        release()

    return udf(ids)
