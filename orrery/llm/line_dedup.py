"""Fuzzy line duplicates: SimHash, pigeonhole blocks, edit similarity, one occurrence kept.

Lines (what ``\\n`` separates) are normalised: A-Z lower-cased, ASCII digits to 0, other
ASCII punctuation and white space to single spaces. Every line with a word takes part: equal
lines are found whatever their length (a whole sentence of a script without spaces is one word).
Only lines of ``min_words`` words and more are compared beyond that; lines without a word always stay.

Equal normalised lines are one node. Each node has a 64-bit SimHash of its words. Two
hashes that differ in at most ``DISTANCE`` bits agree in ``BLOCKS - DISTANCE`` of
``BLOCKS`` blocks, so nodes meet on the bits of every such choice of blocks. Nodes that
meet, differ in at most ``DISTANCE`` bits and whose normalised lines have an edit
similarity (1 - Levenshtein distance / longer length) of ``threshold`` or more are
linked. Of each connected group the occurrence first by (doc_id, document hash, line
number) stays; all others go from their texts.

Nodes are close if their hashes are and their lengths allow the edit similarity: the
distance is never less than the difference of the lengths. Rows of a block choice are
sorted, and cut into ranges, by its bits and then the length. In each range, pairs are
emitted that span what close nodes connect, not all pairs of a large group; buckets that
a range cuts are few, and their parts meet by a join. Where pairs fail the edit check and
so divide such a span, the other close pairs of these buckets across the division are
checked as well; buckets whose spans hold need no more.

Rows with the same id and the same text are one document and get the same text. A null
text stays null. A text whose lines all go is empty. An empty table gives no rows. Other columns
may have any names and stay; null ids are ids like any other.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import Bloom
from .components import connected
from .tables import aside, keyed, written
from .textbytes import Runs, flat, hashes, lines, mix, release, slices, words

DISTANCE, BLOCKS = 3, 5
SLICE = 1 << 20  # bytes at a time
_SIZE_BITS = 32
_FEW = 24
_EDGES = np.linspace(0, 64, BLOCKS + 1).round().astype(int)
_NORMAL = np.full(256, 32, np.uint8)
_NORMAL[48:58] = 48
_NORMAL[65:91] = np.arange(97, 123)
_NORMAL[97:123] = np.arange(97, 123)
_NORMAL[128:] = np.arange(128, 256)
_C1, _C2 = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def simhashes(h: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """SimHash of each range of word hashes: a bit is set if it is in over half of them. Four bits at
    a time are counted in the four 16-bit parts of running sums; ranges too long for these by themselves."""
    sim = np.zeros(len(count), np.uint64)
    usual = count < 1 << 15
    a, b = first[usual], first[usual] + count[usual]
    total, own = np.zeros(len(h) + 1, np.uint64), np.zeros(len(a), np.uint64)
    for k in range(16):
        np.cumsum((h >> np.uint64(k)) & np.uint64(0x0001000100010001), out=total[1:])
        ones = total[b] - total[a]
        for j in range(0, 64, 16):
            more = 2 * ((ones >> np.uint64(j)) & np.uint64(0xFFFF)).astype(np.int64) > count[usual]
            own |= more.astype(np.uint64) << np.uint64(k + j)
    sim[usual] = own
    for i in np.flatnonzero(~usual):
        words_ = h[first[i]:first[i] + count[i]]
        for k in range(64):
            if 2 * int(((words_ >> np.uint64(k)) & np.uint64(1)).sum()) > count[i]:
                sim[i] |= np.uint64(1 << k)
    return sim


def line_sketches(raw: np.ndarray, off: np.ndarray, with_simhash: bool = True):
    """Of every line: text, number in it, word count, two 64-bit hashes of the normalised words, SimHash."""
    ln = lines(raw, off)
    plain = _NORMAL[raw]
    plain[raw == 10] = 10
    edges = np.unique(np.concatenate([off, ln.start, ln.end]))
    w = words(plain, edges)
    h = hashes(plain, w.start, w.end)
    first = np.searchsorted(w.start, np.append(ln.start, len(raw) + 1))
    count = np.searchsorted(w.start, ln.end) - first[:-1]
    count = np.maximum(count, 0)
    line = np.repeat(np.arange(len(count)), count)
    place = (np.arange(len(h)) - first[:-1][line]).astype(np.uint64)
    total = lambda x: np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])
    keys = []
    for c in (_C1, _C2):
        t = total(mix(mix(h ^ c) + place * c))
        keys.append(mix(t[first[:-1] + count] - t[first[:-1]] + count.astype(np.uint64)))
    sim = simhashes(h, first[:-1], count) if with_simhash else np.zeros(len(count), np.uint64)
    number = np.arange(len(count)) - ln.first[:-1][ln.text]
    return ln, number, count, keys, sim


def line_sizes(raw: np.ndarray, ln: Runs, count: np.ndarray) -> np.ndarray:
    """Length of every normalised line in code points; ``count``: its words."""
    starts = np.flatnonzero((_NORMAL[raw] != 32) & ((raw & 0xC0) != 0x80))
    return np.searchsorted(starts, ln.end) - np.searchsorted(starts, ln.start) + np.maximum(count - 1, 0)


def normalised(line: str) -> str:
    """Normalised text of one line, as bytes read as Latin-1 for a length in bytes."""
    return b" ".join(bytes(_NORMAL[np.frombuffer(line.encode(), np.uint8)]).split()).decode("utf-8", "replace")


def levenshtein(a: str, b: str) -> int:
    """Edit distance by bit vectors (one integer operation works on a whole column)."""
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    a, b, n = a[n:], b[n:], 0
    while n < min(len(a), len(b)) and a[-1 - n] == b[-1 - n]:
        n += 1
    a, b = a[:len(a) - n], b[:len(b) - n]
    if not a or not b:
        return len(a) or len(b)
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    mask, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = mask, 0, len(a)
    for ch in b:
        eq = at.get(ch, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right, left = down | ~(diagonal | up) & mask, up & diagonal
        score += bool(right & last) - bool(left & last)
        right = (right << 1 | 1) & mask
        left = left << 1 & mask
        up, down = left | ~(diagonal | right) & mask, right & diagonal
    return score


def edit_similarity(a: str, b: str) -> float:
    longer = max(len(a), len(b))
    return 1 - levenshtein(a, b) / longer if longer else 1.0


def _script_cost(a: list[str], b: list[str], allowed: int) -> int:
    """Characters that one edit script of words needs, found by looking a few words ahead at each
    difference; more than ``allowed`` if it finds none so short. A bound for the edit distance."""
    i = j = cost = 0
    while True:
        while i < len(a) and j < len(b) and a[i] == b[j]:
            i, j = i + 1, j + 1
        if i == len(a) or j == len(b):
            return cost + max(sum(map(len, a[i:])) + len(a) - i, sum(map(len, b[j:])) + len(b) - j)
        for n in range(1, 9):
            step = next(((x, n - x) for x in sorted(range(n + 1), key=lambda x: abs(2 * x - n))
                         if a[i + x:i + x + 2] == b[j + n - x:j + n - x + 2]), None)
            if step:
                break
        else:
            return allowed + 1
        out, new = a[i:i + step[0]], b[j:j + step[1]]
        cost += max(sum(map(len, out)) + len(out), sum(map(len, new)) + len(new))
        if cost > allowed:
            return cost
        i, j = i + step[0], j + step[1]


def alike(a: str, b: str, threshold: float) -> bool:
    """Whether the edit similarity reaches the threshold: bounds decide most pairs, the distance the others."""
    longer = max(len(a), len(b))
    allowed = next(n for n in range(int((1 - threshold) * longer) + 1, -2, -1) if n < 0 or 1 - n / max(longer, 1) >= threshold)
    if allowed < 0 or abs(len(a) - len(b)) > allowed:
        return False
    if _script_cost(a.split(" "), b.split(" "), allowed) <= allowed:
        return True
    more, less = Counter(a), Counter(b)
    if max((more - less).total(), (less - more).total()) > allowed:
        return False
    return levenshtein(a, b) <= allowed


def _sketched(text: Column, min_words: int) -> Column:
    """Array of (line, k1, k2, sim, size) of each text's lines that have a word; size: length of the normalised line, 0 with too few words to be compared."""
    kind = pa.struct([("line", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("sim", pa.int64()), ("size", pa.int32())])

    @F.arrow_udf("array<struct<line:int,k1:long,k2:long,sim:long,size:int>>")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], pa.list_(kind))]
            for texts in slices(batch, SLICE):
                raw, off = flat(texts)
                ln, number, count, (k1, k2), sim = line_sketches(raw, off)
                size = np.where(count >= min_words, line_sizes(raw, ln, count), 0)
                own = count >= 1
                rows = pa.StructArray.from_arrays([pa.array(number[own], pa.int32()), *(pa.array(x[own].view(np.int64)) for x in (k1, k2, sim)),
                                                   pa.array(size[own], pa.int32())], ["line", "k1", "k2", "sim", "size"])
                ends = np.concatenate([[0], np.cumsum(own)])[ln.first]
                parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows))
            yield pa.concat_arrays(parts)
            del batch, parts
        release()

    return udf(text)


def _line_texts(text: Column, wanted: Bloom) -> Column:
    """Array of (k1, k2, normalised line) of the lines that ``wanted`` may hold."""
    kind = pa.list_(pa.struct([("k1", pa.int64()), ("k2", pa.int64()), ("words", pa.string())]))

    @F.arrow_udf("array<struct<k1:long,k2:long,words:string>>")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], kind)]
            for texts in slices(batch, SLICE):
                raw, off = flat(texts)
                ln, _, _, (k1, k2), _ = line_sketches(raw, off, False)
                out: list[list] = [[] for _ in range(len(texts))]
                owner, whole = ln.text, raw.tobytes()
                for i in np.flatnonzero(wanted.might_hold(k1, k2)):
                    out[owner[i]].append({"k1": int(k1[i].view(np.int64)), "k2": int(k2[i].view(np.int64)),
                                          "words": normalised(whole[ln.start[i]:ln.end[i]].decode())})
                parts.append(pa.array(out, kind))
            yield pa.concat_arrays(parts)
            del batch, parts
        release()

    return udf(text)


def _may_hold(keys: Bloom) -> Column:
    """Whether ``keys`` may hold _d1 and _d2."""

    @F.arrow_udf("boolean")
    def udf(d1: pa.Array, d2: pa.Array) -> pa.Array:
        return pa.array(keys.might_hold(d1.to_numpy(zero_copy_only=False), d2.to_numpy(zero_copy_only=False)))

    return udf("_d1", "_d2")


def _edit_alike(a: Column, b: Column, threshold: float) -> Column:
    @F.arrow_udf("boolean")
    def udf(x: pa.Array, y: pa.Array) -> pa.Array:
        out = pa.array([alike(p, q, threshold) for p, q in zip(x.to_pylist(), y.to_pylist())], pa.bool_())
        release()
        return out

    return udf(a, b)


def left_lines(texts: pa.Array, numbers: pa.Array) -> pa.Array:
    """Texts without the lines of the given numbers; a slice of them at a time is held as Python strings."""
    parts, at = [pa.array([], pa.string())], 0
    for some in slices(texts, SLICE):
        out = []
        for t, n in zip(some.to_pylist(), numbers.slice(at, len(some)).to_pylist()):
            if t is not None and n:
                drop = set(n)
                t = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop)
            out.append(t)
        parts.append(pa.array(out, pa.string()))
        at += len(some)
    return pa.concat_arrays(parts)


def _without(text: Column, gone: Column) -> Column:
    """Text without the lines of the given numbers."""

    @F.arrow_udf("string")
    def udf(texts: pa.Array, numbers: pa.Array) -> pa.Array:
        out = left_lines(texts, numbers)
        release()
        return out

    return udf(text, gone)


def _keys(sim: Column, size: Column) -> Column:
    """Array of one number for every choice of blocks: the bucket (choice and bits of its blocks), then the size."""
    part = lambda i: F.shiftrightunsigned(F.shiftleft(sim, 64 - int(_EDGES[i + 1])), 64 - int(_EDGES[i + 1] - _EDGES[i]))

    def key(n: int, own: tuple[int, ...]) -> Column:
        out = F.lit(n).cast("long")
        for i in own:
            out = F.shiftleft(out, int(_EDGES[i + 1] - _EDGES[i])).bitwiseOR(part(i))
        return F.shiftleft(out, _SIZE_BITS).bitwiseOR(size.cast("long"))
    return F.array(*(key(n, own) for n, own in enumerate(combinations(range(BLOCKS), BLOCKS - DISTANCE))))


def _rows(nodes: DataFrame) -> DataFrame:
    """(node, sim, key) of the nodes in all their buckets."""
    return nodes.filter("size > 0").select("node", "sim", F.explode(_keys(F.col("sim"), F.col("size"))).alias("key"))


def _bucket(key: str | Column) -> Column:
    return F.shiftright(key, _SIZE_BITS)


def _close(x: str, y: str, x_size: str, y_size: str, threshold: float) -> Column:
    """Whether two nodes are close: _near() as a column."""
    apart = F.abs(F.col(x_size) - F.col(y_size)) <= (1 - threshold) * F.greatest(x_size, y_size) + 1e-6
    return apart & (F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= DISTANCE)


def _near(sim: np.ndarray, size: np.ndarray, s: np.ndarray, n: np.ndarray, threshold: float) -> np.ndarray:
    """Whether hashes and lengths allow a link. The small number is for rounding: the edit check decides."""
    return (np.bitwise_count(sim ^ s) <= DISTANCE) & (np.abs(size - n) <= (1 - threshold) * np.maximum(size, n) + 1e-6)


def _spanning(node: np.ndarray, sim: np.ndarray, size: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Pairs of close nodes that connect what close nodes connect: each node reached is compared with those not reached yet."""
    out, left = [], np.arange(len(node))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            near = _near(sim[left], size[left], sim[i], size[i], threshold)
            out += [(int(node[i]), int(node[j])) for j in left[near]]
            queue += left[near].tolist()
            left = left[~near]
    return out


def _close_pairs(threshold: float):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spanning pairs (a, b) of the close nodes of each bucket in rows sorted by key. Also, with ``key``, the rows
        (node, sim) of the first and last bucket of the task, whose other rows may be elsewhere."""
        held, first = (np.zeros(0, np.int64),) * 3, None

        def solved(node: np.ndarray, sim: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
            bucket, size, sim = key >> _SIZE_BITS, key & (1 << _SIZE_BITS) - 1, sim.view(np.uint64)
            edge = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
            start, end = np.concatenate([[0], edge]), np.append(edge, len(bucket))
            i = start[end - start == 2]
            i = i[_near(sim[i], size[i], sim[i + 1], size[i + 1], threshold)]
            found = list(zip(node[i].tolist(), node[i + 1].tolist()))
            many = end - start > 2
            few = many & (end - start <= _FEW)  # most of these hold no close nodes: all are compared at once
            row = np.flatnonzero(np.repeat(few, end - start))
            left, some = np.repeat(end, end - start)[row] - row, np.zeros(len(bucket), bool)
            for k in range(1, _FEW):
                row, left = row[left > k], left[left > k]
                some[row] |= _near(sim[row], size[row], sim[row + k], size[row + k], threshold)
            if len(start):
                many &= ~few | np.logical_or.reduceat(some, start)
            for r in np.flatnonzero(many):
                own = slice(start[r], end[r])
                found += _spanning(node[own], sim[own], size[own], threshold)
            ab = np.sort(np.array(found, np.int64).reshape(-1, 2), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1]), pa.nulls(len(ab), pa.int64())], ["a", "b", "key"])

        def cut(rows: tuple[np.ndarray, ...], bucket: int) -> pa.RecordBatch:
            own = rows[2] >> _SIZE_BITS == bucket
            return pa.RecordBatch.from_arrays([pa.array(x[own]) for x in rows], ["a", "b", "key"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(np.concatenate([h, batch[c].to_numpy(zero_copy_only=False)]) for h, c in zip(held, ("node", "sim", "key")))
            last = int(rows[2][-1]) >> _SIZE_BITS
            whole = int(np.searchsorted(rows[2] >> _SIZE_BITS, last))
            if whole:
                if first is None:
                    first = int(rows[2][0]) >> _SIZE_BITS
                    yield cut(rows, first)
                yield solved(*(x[:whole] for x in rows))
            held = tuple(x[whole:] for x in rows)
        if len(held[0]):
            yield solved(*held)
            yield cut(held, int(held[2][0]) >> _SIZE_BITS)
        del held
        release()

    return pairs


def _with_least(rows: DataFrame) -> DataFrame:
    """Rows (node, sim, key) with bucket and size, of buckets that have two or more, with the least node of each."""
    rows = rows.select("node", "sim", _bucket("key").alias("bucket"), F.col("key").bitwiseAND((1 << _SIZE_BITS) - 1).alias("size"))
    least = rows.groupBy("bucket").agg(F.min("node").alias("least"), F.count("*").alias("m")).filter("m > 1").drop("m")
    return rows.join(least, "bucket")


class LineDuplicates:
    """``gone``: (id, d1, d2, lines) for each document that loses lines; d1 and d2 are hashes of its id and text."""

    def __init__(self, docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = 0.9, min_words: int = 5):
        self.id, self.text = id_column, text
        own = self.keyed(docs).select(F.col(f"`{id_column}`").alias("id"), "_d1", "_d2", F.col(f"`{text}`").cast("string").alias("text"))
        found = own.select("id", "_d1", "_d2", F.explode(_sketched(F.col("text"), min_words)).alias("s")).select("id", "_d1", "_d2", "s.*")
        found = written(found.withColumn("row", F.monotonically_increasing_id()), "lines")
        # numbers only, for which Spark aggregates without sorting; d1 and d2 are those of some document with the line
        nodes = written(found.groupBy("k1", "k2").agg(F.min("row").alias("node"), F.count("*").alias("n"), F.min("sim").alias("sim"),
                                                      F.max("size").alias("size"), F.first("_d1").alias("d1"), F.first("_d2").alias("d2")), "line-nodes")

        found_pairs = _rows(nodes).repartitionByRange("key", "node").sortWithinPartitions("key").mapInArrow(_close_pairs(threshold), "a long, b long, key long")
        found_pairs = written(found_pairs.withColumn("task", F.spark_partition_id()), "line-pairs")
        pairs = found_pairs.filter("key IS NULL").select("a", "b").distinct()
        # buckets that the ranges cut: their parts are compared with each other by joins
        edge = found_pairs.filter("key IS NOT NULL").select(F.col("a").alias("node"), F.col("b").alias("sim"), "key", "task")
        cut = written(edge.groupBy(_bucket("key").alias("bucket")).agg(F.min("task").alias("one"), F.max("task").alias("other"))
                      .filter("one <> other").select("bucket"), "line-cuts")
        meeting = _with_least(edge.join(cut, _bucket("key") == F.col("bucket"), "left_semi"))
        pairs = written(pairs, "line-pairs")
        across = self._across(meeting, written(connected(pairs, "a", "b"), "line-roots"), threshold)
        pairs = written(pairs.unionAll(across).distinct(), "line-pairs")
        # every node that is close to another has a place in these pairs
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        ends = written(nodes.join(ends, "node", "left_semi"), "line-ends")
        some = self.keyed(docs).filter(_may_hold(Bloom(ends, "d1", "d2")))
        text = some.select(F.explode(_line_texts(F.col(f"`{text}`").cast("string"), Bloom(ends))).alias("s")).select("s.*")
        texts = written(text.dropDuplicates(["k1", "k2"]).join(ends.select("k1", "k2", "node"), ["k1", "k2"]).select("node", "words"), "line-texts")
        first = written(self._verified(texts, pairs, threshold), "line-links")
        root = written(connected(first, "a", "b"), "line-roots")
        near = _with_least(written(self._divided(pairs, ends, root, cut), "line-near"))
        again = written(self._across(near, root, threshold).join(pairs, ["a", "b"], "left_anti"), "line-pairs")
        self.links = written(first.unionAll(self._verified(texts, again, threshold)), "line-links")

        root = connected(self.links, "a", "b")
        linked = written(ends.join(root, "node"), "line-linked")
        alone = nodes.filter("n > 1").join(linked.select("node"), "node", "left_anti")
        groups = linked.select("k1", "k2", "root").unionAll(alone.select("k1", "k2", F.col("node").alias("root")))
        place = F.struct("id", "_d1", "_d2", "line")
        members = written(found.join(groups, ["k1", "k2"]).select("root", "id", "_d1", "_d2", "line"), "line-members")
        first_ones = members.groupBy("root").agg(F.min(place).alias("keep"))
        self.gone = written(members.join(first_ones, "root").filter(~place.eqNullSafe(F.col("keep")))
                            .groupBy("id", "_d1", "_d2").agg(F.collect_set("line").alias("lines")), "lines-gone")

    def keyed(self, docs: DataFrame) -> DataFrame:
        """``docs`` with the hashes _d1 and _d2 of id and text, which name a document."""
        return keyed(docs, self.id, self.text)

    @staticmethod
    def _divided(pairs: DataFrame, ends: DataFrame, roots: DataFrame, cut: DataFrame) -> DataFrame:
        """Rows (node, sim, key) of the buckets in which nodes of a pair that are still apart meet, and of those in ``cut``.
        In all other buckets the pairs join whatever is close."""
        buckets = lambda c: F.transform(_keys(F.col(f"{c}.sim"), F.lit(0)), lambda k: _bucket(k))
        side = lambda c: ends.join(roots, "node", "left").select(
            F.col("node").alias(c), F.struct(F.coalesce("root", "node").alias("root"), "sim").alias(f"of_{c}"))
        apart = pairs.join(side("a"), "a").join(side("b"), "b").filter("of_a.root <> of_b.root")
        divided = apart.select(F.explode(F.array_intersect(buckets("of_a"), buckets("of_b"))).alias("bucket")).unionAll(cut).distinct()
        return _rows(ends).join(divided, _bucket("key") == F.col("bucket"), "left_semi")

    @staticmethod
    def _across(shared: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
        """Close pairs (a, b) in which a node that is in another component than the least node of its
        bucket meets a node of the bucket outside its component."""
        placed = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        of_least = roots.select(F.col("node").alias("least"), F.col("root").alias("least_root"))
        placed = written(placed.join(of_least, "least", "left").withColumn("least_root", F.coalesce("least_root", "least")), "line-placed")
        left = placed.filter("root <> least_root").select(F.col("bucket").alias("x_bucket"), F.col("node").alias("x"), F.col("root").alias("x_root"),
                                                          F.col("sim").alias("x_sim"), F.col("size").alias("x_size"))
        met = left.join(placed, (F.col("x_bucket") == F.col("bucket")) & (F.col("root") != F.col("x_root"))
                        & _close("sim", "x_sim", "size", "x_size", threshold))
        return met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()

    @staticmethod
    def _verified(texts: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
        """Pairs (a, b) of nodes whose lines are alike enough."""
        side = lambda c: texts.select(F.col("node").alias(c), F.col("words").alias(f"words_{c}"))
        return (pairs.join(side("b"), "b").join(side("a"), "a")
                .filter(_edit_alike(F.col("words_a"), F.col("words_b"), threshold)).select("a", "b"))

    def apply(self, docs: DataFrame, into: str | None = None, removed: str | None = None) -> DataFrame:
        """``docs`` with the texts that are left in column ``into`` (the text column if not given), and the
        number of lines that went in column ``removed`` if given; documents that lose nothing do not move."""
        into = into or self.text
        docs, back = aside(docs, (self.id, self.text), tuple(c for c in (into, removed) if c))
        all_ = self.keyed(docs)
        all_ = all_.withColumn("_may", _may_hold(Bloom(self.gone, "_d1", "_d2")))
        text = F.col(f"`{self.text}`").cast("string")
        names = [F.col(f"`{n}`") for n in dict.fromkeys([*docs.columns, into, *([removed] if removed else [])])]
        still, cut = all_.filter("not _may"), all_.filter("_may").join(self.gone.select("_d1", "_d2", "lines"), ["_d1", "_d2"], "left")
        left = _without(text, F.col("lines"))
        if removed:
            still = still.withColumn(removed, F.lit(0).cast("long"))
            cut = cut.withColumn(removed, F.coalesce(F.size("lines"), F.lit(0)).cast("long"))
        return back(still.withColumn(into, text).select(names).unionByName(cut.withColumn(into, left).select(names)))
