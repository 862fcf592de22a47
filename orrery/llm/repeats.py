"""Repeated byte strings across and within documents, by sorting sampled suffixes.

A byte goes if a string of ``LENGTH`` = 400 bytes that covers it also starts at another
place, in another document or the same.

Of the grams (32 bytes) in a window of 400 bytes, the one with the least hash, the first
of equals, is the window's anchor. The choice depends on the window's bytes alone, so
equal windows have equal anchors at equal distance, and only places whose anchor gram
comes twice or more can be repeated. Steps:

1. Each document's anchors (about two in 370 bytes) are found, and grams that are
   anchors of two or more places. Where a text repeats itself with a period shorter than
   a window, the windows inside that stretch are seen to be repeated at once; of their
   anchors one stays that has a whole period of windows, as there would be one in every period.
2. The surroundings of anchors with such grams are grouped by gram. A group's suffixes
   (from the anchor on) are sorted by multikey quicksort and blind tries
   (suffix_sort.py). From each suffix outward in that order, common prefixes shrink; with
   the common length before the anchor they give the repeated stretches around it.
3. A gram of more than ``PART`` places is cut into parts, each sorted by itself; windows
   that a part holds once are then looked up among the windows of the gram's other parts
   by their hash.

Documents are named by two 64-bit hashes of their text; copies are one text, and a text
of 400 bytes or more that two documents have goes from both whole. A null text is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import Bloom
from .suffix_sort import deep_shallow
from .tables import aside, written
from .textbytes import flat, mix, slices

LENGTH, GRAM = 400, 32
GRAMS = LENGTH - GRAM + 1  # in a window
PART, BATCH_ROWS = 2048, 8192
_LOW = np.uint64(0xFFFFFFFF)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_BASE = 0x5851F42D4C957F2D


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hash of the 32 bytes from each place (those past the end as zeros)."""
    padded = np.zeros(len(raw) + GRAM + 8, np.uint8)
    padded[:len(raw)] = raw
    eight = np.ndarray(len(raw) + GRAM, "<u8", padded, strides=(1,))
    h = eight[:len(raw)] * _FACTORS[0]
    for k in range(1, GRAM // 8):
        h ^= h >> np.uint64(32)
        h += eight[8 * k:8 * k + len(raw)]
        h *= _FACTORS[k]
    return mix(h)


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (running minima of blocks, from both ends)."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchors(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Place, first and last window start, hash and text of each anchor, in order."""
    n = len(raw)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none.astype(np.uint64), none
    h = gram_hashes(raw)
    least = sliding_minimum((h & ~_LOW) | np.arange(n, dtype=np.uint64), GRAMS)[:n - LENGTH + 1]
    cross = np.zeros(n + 1, np.int8)  # windows that would cross the end of their text
    np.add.at(cross, np.maximum(off[1:] - LENGTH + 1, off[:-1]), 1)
    np.add.at(cross, off[1:], -1)
    start = np.flatnonzero(np.cumsum(cross[:len(least)], dtype=np.int8) == 0)
    place = (least[start] & _LOW).astype(np.int64)
    text = np.searchsorted(off, start, "right") - 1
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    place = place[first]
    return place, start[first], start[last], h[place], text[first]


def _stretch(raw: np.ndarray, at: int, period: int, low: int, high: int) -> tuple[int, int]:
    """Largest [a, b) around ``at`` within [low, high) where every byte of [a, b - period) equals the one a period later."""
    step, a, b = 1 << 12, at, at
    while b + period < high:
        m = min(step, high - period - b)
        differ = np.flatnonzero(raw[b:b + m] != raw[b + period:b + period + m])
        if len(differ):
            b += int(differ[0])
            break
        b += m
    while a > low:
        m = min(step, a - low)
        differ = np.flatnonzero(raw[a - m:a] != raw[a - m + period:a + period])
        if len(differ):
            a += int(differ[-1]) + 1 - m
            break
        a -= m
    return a, b + period


def periodic(raw: np.ndarray, off: np.ndarray, found: tuple[np.ndarray, ...]) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Which anchors stay, and (text, start, end) of periodic stretches all of whose windows are repeated."""
    place, first, last, h, text = found
    stay, spans = np.ones(len(place), bool), []
    tied = np.zeros(len(place), bool)
    tied[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    i = 0
    ties = np.flatnonzero(tied)
    while i < len(ties):
        k = int(ties[i])  # anchors k - 1 and k have the same gram
        a, b = _stretch(raw, int(place[k - 1]), int(place[k] - place[k - 1]), int(off[text[k]]), int(off[text[k] + 1]))
        period = int(place[k] - place[k - 1])
        if b - period - a >= LENGTH:
            spans.append((int(text[k]), a, b))
            low, high = np.searchsorted(first, a), np.searchsorted(last, b - LENGTH, "right")
            inside = np.arange(max(low, k - 1), max(high, 0))
            inside = inside[(h[inside] == h[k]) & (first[inside] >= a) & (last[inside] + LENGTH <= b)]
            # one whose windows span a whole period has them all; where the text or stretch begins, the first may have fewer
            whole = inside[last[inside] - first[inside] + 1 >= period]
            if len(inside) > 1 and len(whole):
                stay[inside] = False
                stay[whole[0]] = True
            # the stretch's later pairs of anchors say the same
            i = max(i + 1, int(np.searchsorted(ties, inside[-1] if len(inside) else k, "right")))
        else:
            i += 1
    return stay, spans


_ANCHORS = pa.struct([("n", pa.int64()), ("grams", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])


def _anchored(text: Column) -> Column:
    """Struct of each text: its bytes, the hashes of its anchors' grams, and its periodic stretches."""

    @F.arrow_udf("struct<n:long,grams:array<long>,starts:array<long>,ends:array<long>>")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], _ANCHORS)]
            for texts in slices(batch):
                raw, off = flat(texts)
                found = anchors(raw, off)
                stay, spans = periodic(raw, off, found)
                grams, own = found[3][stay].view(np.int64), found[4][stay]
                owner = np.array([s[0] for s in spans], np.int64)
                base = off[owner] if len(owner) else owner
                of = lambda who: pa.array(np.searchsorted(who, np.arange(len(texts) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(of(own), pa.array(grams)),
                         *(pa.ListArray.from_arrays(of(owner), pa.array(np.array([s[k] for s in spans], np.int64) - base)) for k in (1, 2))]
                parts.append(pa.StructArray.from_arrays([pa.array(np.diff(off)), *lists], ["n", "grams", "starts", "ends"]))
            yield pa.concat_arrays(parts)

    return udf(text)


_CONTEXT = "gram long, t1 long, t2 long, place long, before int, inner int, bytes binary"


def _contexts(repeated: Bloom):
    """Surroundings of the anchors whose gram may be repeated: bytes from the first window's start to the last
    window's end; ``before``: bytes before the anchor, ``inner``: last window's start."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            at = 0
            for texts in slices(batch["text"]):
                t1, t2 = (batch[c].slice(at, len(texts)).to_numpy(zero_copy_only=False) for c in ("t1", "t2"))
                at += len(texts)
                fresh = np.zeros(len(texts), bool)
                for i, k in enumerate(zip(t1.tolist(), t2.tolist())):
                    if k not in seen:
                        seen.add(k)
                        fresh[i] = True
                raw, off = flat(texts)
                found = anchors(raw, off)
                stay, _ = periodic(raw, off, found)
                gram = found[3].view(np.int64)
                own = np.flatnonzero(stay & fresh[found[4]] & repeated.might_hold(gram, gram))
                place, first, last, _, text = (x[own] for x in found)
                size = last - first + LENGTH
                ends = np.concatenate([[0], np.cumsum(size)])
                data = raw[np.arange(ends[-1]) - np.repeat(ends[:-1] - first, size)] if len(own) else np.zeros(0, np.uint8)
                blob = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram[own]), pa.array(t1[text]), pa.array(t2[text]), pa.array(place - off[text]),
                     pa.array((place - first).astype(np.int32)), pa.array((last - first).astype(np.int32)), blob],
                    ["gram", "t1", "t2", "place", "before", "inner", "bytes"])

    return send


def _first_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differ = a != b
    at = differ.argmax(axis=1)
    return np.where(differ[np.arange(len(at)), at], at, a.shape[1])


def repeated_stretches(group: np.ndarray, place: np.ndarray, before: np.ndarray, inner: np.ndarray, blobs: list[bytes]):
    """(row, start, end) of stretches of 400 bytes or more that another row of the group shares, and which rows
    have all of their windows in such stretches. Rows are distinct places with one gram per group."""
    n = len(group)
    left, right = np.zeros((n, GRAMS), np.uint8), np.zeros((n, LENGTH), np.uint8)
    after = inner + LENGTH - before
    for i, blob in enumerate(blobs):
        b = np.frombuffer(blob, np.uint8)
        left[i, :before[i]] = b[:before[i]][::-1]  # nearest byte first
        right[i, :after[i]] = b[before[i]:]
    order = deep_shallow(right, after, group, GRAM)
    group, place, before, inner, after, left, right = (x[order] for x in (group, place, before, inner, after, left, right))
    same = group[1:] == group[:-1]
    common = np.zeros(n, np.int64)  # with the next row
    if n > 1:
        common[:-1] = np.where(same, np.minimum(_first_difference(right[:-1], right[1:]), np.minimum(after[:-1], after[1:])), 0)
    low, high = before - inner, before  # offsets of windows: anchor minus start
    reached = low - 1                   # all windows of an offset up to this one are found
    gap = np.zeros((n, 2), np.int64)    # the last stretch that left a gap
    out_row, out_start, out_end = [], [], []
    run, at, k = common[:-1].copy(), np.arange(max(n - 1, 0)), 1
    while True:
        own = (run > 0) & ((reached[at] < high[at]) | (reached[at + k] < high[at + k]))
        own &= run + np.minimum(before[at], before[at + k]) >= LENGTH
        i = at[own]
        if len(i):
            j, r = i + k, run[own]
            l = np.minimum(_first_difference(left[i], left[j]), np.minimum(before[i], before[j]))  # noqa: E741
            enough = l + r >= LENGTH
            for x in (i[enough], j[enough]):
                lx, rx = l[enough], r[enough]
                new = (lx > reached[x]) & ~((lx <= gap[x, 0]) & (rx <= gap[x, 1]))
                x, lx, rx = x[new], lx[new], rx[new]
                out_row.append(x)
                out_start.append(place[x] - lx)
                out_end.append(place[x] + rx)
                joins = LENGTH - rx <= reached[x] + 1
                reached[x[joins]] = lx[joins]
                gap[x[~joins], 0], gap[x[~joins], 1] = lx[~joins], rx[~joins]
        # one row further: common prefixes shrink, and none that is too short with all that is before helps
        k += 1
        inside = at + k < n
        at, run = at[inside], run[inside]
        run = np.minimum(run, common[at + k - 1])
        live = run + before[at] >= LENGTH
        live &= run > 0
        at, run = at[live], run[live]
        if not len(at):
            break
    joined = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
    return order[joined(out_row).astype(np.int64)], joined(out_start), joined(out_end), order[reached >= high]


def _window_keys(gram: int, blob: bytes) -> np.ndarray:
    """Hash of each window of 400 bytes, by a polynomial over the bytes."""
    b = np.frombuffer(blob, np.uint8).astype(np.uint64)
    power = np.cumprod(np.full(len(b), _BASE, np.uint64)) if len(b) else b
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(b + np.uint64(1)) * power)])
        inverse = np.cumprod(np.full(len(b), pow(_BASE, -1, 1 << 64), np.uint64))
        at = np.arange(len(b) - LENGTH + 1)
        return mix((total[at + LENGTH] - total[at]) * inverse[at] ^ mix(np.array([gram], np.int64).view(np.uint64)))


_FOUND = "t1 long, t2 long, start long, end long, range int, keys binary, texts binary, starts binary"


def _solve(ranges: int):
    """Repeated stretches of whole groups, and for groups that are parts of one their windows by ranges of hashes."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows < BATCH_ROWS:
                continue
            table = pa.concat_tables(held)
            gram, part = (table[c].to_numpy() for c in ("gram", "part"))
            edges = np.flatnonzero((gram[1:] != gram[:-1]) | (part[1:] != part[:-1])) + 1
            if len(edges):
                yield table.slice(0, int(edges[-1]))
                held = [table.slice(int(edges[-1]))]
                rows = held[0].num_rows
            else:
                held = [table]
        if rows:
            yield pa.concat_tables(held)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["t1", "t2", "start", "end", "range", "keys", "texts", "starts"]
        for table in groups(batches):
            gram, part, parts, t1, t2, place = (table[c].to_numpy() for c in ("gram", "part", "parts", "t1", "t2", "place"))
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])
            group = np.cumsum(new) - 1
            # copies of a text come from several tasks: one row for each place of a text
            order = np.lexsort((place, t2, t1, group))
            same = np.zeros(len(order), bool)
            for x in (place, t2, t1, group):
                same[1:] |= x[order[1:]] != x[order[:-1]]
            same[:1] = True
            own = order[same]
            size = np.bincount(group[own], minlength=group[-1] + 1)
            many = own[size[group[own]] > 1]
            blobs = pc.take(table["bytes"], pa.array(many)).to_pylist()
            before, inner = (table[c].to_numpy()[many].astype(np.int64) for c in ("before", "inner"))
            row, start, end, _ = repeated_stretches(group[many], place[many], before, inner, blobs)
            row = many[row]
            none = pa.nulls(len(row))
            yield pa.RecordBatch.from_arrays([pa.array(t1[row]), pa.array(t2[row]), pa.array(start), pa.array(end), none.cast(pa.int32()),
                                              *[none.cast(pa.binary())] * 3], names)
            split = own[parts[own] > 1]
            for g in np.unique(group[split]):
                yield _windows_of(table, split[group[split] == g], ranges, names)

    return solve


def _windows_of(table: pa.Table, rows: np.ndarray, ranges: int, names: list[str]) -> pa.RecordBatch:
    """The distinct windows of one part by ranges of their hashes; start -1: it has the window twice, so it is found already."""
    gram = int(table["gram"][int(rows[0])].as_py())
    keys, owner, start = [], [], []
    for i in rows.tolist():
        k = _window_keys(gram, table["bytes"][i].as_py())
        keys.append(k)
        owner.append(np.full(len(k), i))
        start.append(table["place"][i].as_py() - table["before"][i].as_py() + np.arange(len(k)))
    keys, first, times = np.unique(np.concatenate(keys), return_index=True, return_counts=True)
    owner, start = np.concatenate(owner)[first], np.where(times > 1, -1, np.concatenate(start)[first])
    texts = np.stack([table[c].to_numpy()[owner] for c in ("t1", "t2")], axis=1)
    range_ = ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(range_)) + 1, [len(keys)]])
    cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())
    none = pa.nulls(len(bounds) - 1, pa.int64())
    return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(range_[bounds[:-1]]), cut(keys), cut(texts), cut(start.astype(np.int64))], names)


def _across(table: pa.Table) -> pa.Table:
    """Windows that two or more parts have, where their own part has them once."""
    joined = lambda c, kind: np.frombuffer(b"".join(x.as_py() for x in table[c]), kind)
    keys, texts, start = joined("keys", np.uint64), joined("texts", np.int64).reshape(-1, 2), joined("starts", np.int64)
    _, at, times = np.unique(keys, return_inverse=True, return_counts=True)
    own = (times[at] > 1) & (start >= 0)
    return pa.table([pa.array(texts[own, 0]), pa.array(texts[own, 1]), pa.array(start[own]), pa.array(start[own] + LENGTH)],
                    names=["t1", "t2", "start", "end"])


def _cut(text: Column, spans: Column) -> Column:
    """Struct of the bytes that stay, the number of removed ones, and the number of maximal removed runs."""
    kind = pa.struct([("kept", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])

    @F.arrow_udf("struct<kept:binary,n_removed:long,n_spans:long>")
    def udf(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for i in range(len(texts)):
            raw = (texts[i].as_py() or "").encode()
            kept, at, runs, removed = [], 0, 0, 0
            for s, e in sorted((x["start"], x["end"]) for x in spans[i].as_py() or ()):
                if s > at or not runs:
                    kept.append(raw[at:s])
                    runs += 1
                    removed += e - s
                elif e > at:
                    removed += e - at
                at = max(at, e)
            out.append({"kept": b"".join(kept) + raw[at:], "n_removed": removed, "n_spans": runs})
        return pa.array(out, kind)

    return udf(text, spans)


class RepeatedStrings:
    """``spans``: (t1, t2, spans) of each text that loses bytes; t1 and t2 are hashes of the text."""

    def __init__(self, docs: DataFrame, text: str = "text"):
        spark = docs.sparkSession
        self.text = text
        own = self.keyed(docs).select("_t1", "_t2", self._text().alias("text"))
        found = own.select("_t1", "_t2", _anchored(F.col("text")).alias("a")).select(F.col("_t1").alias("t1"), F.col("_t2").alias("t2"), "a.*")
        found = written(found, "anchors")
        place = F.xxhash64("t1", "t2", "at")
        grams = (found.select("t1", "t2", F.posexplode("grams").alias("at", "gram")).groupBy("gram")
                 .agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("n")).filter("low < high").select("gram", "n"))
        grams = written(grams, "grams")
        hot = written(grams.filter(F.col("n") > PART).select("gram", F.ceil(F.col("n") / PART).cast("int").alias("parts"), "n"), "hot-grams")
        places = hot.agg(F.sum("n")).first()[0] or 0
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), places // 20_000)

        contexts = own.select(F.col("_t1").alias("t1"), F.col("_t2").alias("t2"), "text").mapInArrow(_contexts(Bloom(grams, "gram", "gram")), _CONTEXT)
        contexts = contexts.join(hot.select("gram", "parts"), "gram", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        contexts = contexts.withColumn("part", F.pmod(F.xxhash64("t1", "t2", "place"), F.col("parts")).cast("int"))
        solved = written(contexts.repartition("gram", "part").sortWithinPartitions("gram", "part")
                         .mapInArrow(_solve(ranges), _FOUND), "stretches")
        inside = solved.filter("range IS NULL").select("t1", "t2", "start", "end")
        across = (solved.filter("range IS NOT NULL").select("range", "keys", "texts", "starts")
                  .groupBy("range").applyInArrow(_across, "t1 long, t2 long, start long, end long"))
        texts = found.groupBy("t1", "t2").agg(F.count("*").alias("times"), F.first("n").alias("n"), F.first(F.arrays_zip("starts", "ends")).alias("s"))
        periods = texts.select("t1", "t2", F.explode("s").alias("s")).select("t1", "t2", "s.*").toDF("t1", "t2", "start", "end")
        copies = texts.filter((F.col("times") > 1) & (F.col("n") >= LENGTH)).select("t1", "t2", F.lit(0).cast("long").alias("start"), F.col("n").alias("end"))
        every = inside.unionByName(across).unionByName(periods).unionByName(copies)
        self.spans = written(every.groupBy("t1", "t2").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")

    def _text(self) -> Column:
        return F.coalesce(F.col(f"`{self.text}`").cast("string"), F.lit(""))

    def keyed(self, docs: DataFrame) -> DataFrame:
        return docs.withColumn("_t1", F.xxhash64(self._text())).withColumn("_t2", F.xxhash64(F.lit(1), self._text()))

    def apply(self, docs: DataFrame, into: str = "kept") -> DataFrame:
        """``docs`` with column ``into`` (the bytes that stay), ``n_removed`` and ``n_spans`` (replaced if there);
        texts that lose nothing do not move."""
        docs, back = aside(docs, (self.text,), (into, "n_removed", "n_spans"))
        some = Bloom(self.spans, "t1", "t2")

        @F.arrow_udf("boolean")
        def may_lose(t1: pa.Array, t2: pa.Array) -> pa.Array:
            return pa.array(some.might_hold(t1.to_numpy(zero_copy_only=False), t2.to_numpy(zero_copy_only=False)))

        keyed = self.keyed(docs).withColumn("_may", may_lose("_t1", "_t2"))
        names = [F.col(f"`{n}`") for n in dict.fromkeys([*docs.columns, into, "n_removed", "n_spans"])]
        zero = F.lit(0).cast("long")
        still = keyed.filter("not _may").withColumns({into: self._text().cast("binary"), "n_removed": zero, "n_spans": zero}).select(names)
        spans = self.spans.select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), F.col("spans").alias("_spans"))
        cut = (keyed.filter("_may").join(spans, ["_t1", "_t2"], "left").withColumn("_cut", _cut(self._text(), F.col("_spans")))
               .withColumns({into: F.col("_cut.kept"), "n_removed": F.col("_cut.n_removed"), "n_spans": F.col("_cut.n_spans")}).select(names))
        return back(still.unionByName(cut))
