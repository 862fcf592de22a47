"""Best-fit-decreasing packing of tokenised documents into sequences of bounded length.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt evenly over
groups of about ``group_rows`` rows, whatever their document, and each group is packed by
best fit: longest piece first, into the open sequence with the least room that is still
enough, found in a segment tree over remaining capacities. Sequences that a group leaves
with more than ``slack`` of their room empty are opened again, and their pieces packed
once more in new groups, so that what is lost does not follow the number of groups.

Nothing is collected: only piece lengths are packed, in bounded groups, and token ids are
not shuffled. Repeated rows are pieces of their own. A null or empty text is the end
token alone. An empty table gives no rows. Other columns may have any names and stay.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import aside, written
from .textbytes import release

_PIECES = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("ids", pa.binary())]))
#: Pre-tokens of an ASCII word in small letters.
_PARTS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z]+|[0-9]|[^a-z0-9]+")
_ASCII = re.compile("[!-~]+")
_TAIL = re.compile(r"([^\W\d_]+)([.,!?%*#$&|:;]+)")
_CONTROL = re.compile("[\x1c-\x1f]")
_CACHE_WORDS = 400_000


class _Words(dict):
    """Token ids of words as bytes. The tokenizer drops white space, and no token
    crosses it, so a text's ids are those of its words; punctuation after letters is
    a pre-token of its own. The cache is emptied when it holds ``_CACHE_WORDS``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)", re.I)
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte-level alphabet: other bytes follow from 256 on
        other = iter(range(256, 512))
        self.letters = {b: b if b in printed else next(other) for b in range(256)}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def part(self, part: str) -> bytes:
        """Ids of one pre-token, given in the byte-level alphabet."""
        ids = [t.id for t in self.model.tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        m = _TAIL.fullmatch(word)
        if m and m[1].isascii():
            ids = self[m[1].lower()] + self[m[2]]
        elif m and m[1].isalpha() and m[1].lower().isalpha() and unicodedata.is_normalized("NFC", m[1]):
            ids = self[m[1]] + self[m[2]]
        elif self.special.search(word):
            ids = self.encode(word)
        elif word.isascii() and word.isalpha():
            small = word.lower()
            ids = self.part(word) if small == word else self[small]
        elif _ASCII.fullmatch(word):
            ids = b"".join(map(self.part, _PARTS.findall(word.lower())))
        # letters up to Latin Extended-B: here small letters and normal forms are the same to all
        elif word.isalpha() and max(word) <= "\u024f" and "\u0130" not in word and unicodedata.is_normalized("NFC", word):
            ids = self.part(word.lower().encode().decode("latin-1").translate(self.letters))
        else:
            ids = self.encode(word)
        self[word] = ids
        return ids

    def text_ids(self, text: str) -> bytes:
        if _CONTROL.search(text):  # white space to str.split() only
            return self.encode(text)
        if len(self) > _CACHE_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, text.split()))


_ENCODERS: dict[str, _Words] = {}


def _encoder(path: str) -> _Words:
    if path not in _ENCODERS:
        _ENCODERS[path] = _Words(path)
    return _ENCODERS[path]


def token_pieces(text: Column, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> Column:
    """Array of (piece, start, ids) of each text; ids are little-endian unsigned 32-bit numbers.
    ``tokenizer`` is the path of a tokenizer file that every executor can open."""

    @F.arrow_udf("array<struct<piece:int,start:long,ids:binary>>")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, end, step = _encoder(tokenizer), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for texts in batches:
            counts, pieces, starts, blobs = [0], [], [], []
            for i in range(len(texts)):
                t = texts[i].as_py()
                ids = (words.text_ids(t) if t else b"") + end
                for k, at in enumerate(range(0, len(ids), step)):
                    pieces.append(k)
                    starts.append(at // 4)
                    blobs.append(ids[at:at + step])
                counts.append(len(pieces))
            rows = pa.StructArray.from_arrays(
                [pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(blobs, pa.binary())], ["piece", "start", "ids"])
            yield pa.ListArray.from_arrays(pa.array(counts, pa.int32()), rows).cast(_PIECES)
            del texts, rows, pieces, starts, blobs
        words.clear()  # the next task's words are mostly others; the worker lives on for other stages
        release()

    return udf(text.cast("string"))


class CapacityTree:
    """Segment tree over remaining capacities 0 .. capacity: how many open sequences have each."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        i = room + self.leaves
        count = self.count
        while i:
            count[i] += by
            i >>= 1

    def tightest(self, length: int) -> int:
        """The least room of an open sequence that is at least ``length``; -1 if there is none."""
        i, count = length + self.leaves, self.count
        if count[i]:
            return length
        while i > 1:  # up to the first right neighbour that holds a sequence, then down its left side
            if not i & 1 and count[i + 1]:
                i += 1
                while i < self.leaves:
                    i *= 2
                    i += not count[i]
                return i - self.leaves
            i >>= 1
        return -1


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, and the room left in each sequence; pieces come longest first."""
    tree, open_at, room = CapacityTree(capacity), {}, []
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        free = tree.tightest(n)
        if free < 0:
            free, own = capacity, len(room)
            room.append(capacity)
        else:
            own = open_at[free].pop()
            tree.add(free, -1)
        sequence[i], offset[i] = own, capacity - free
        room[own] = free = free - n
        if free:
            open_at.setdefault(free, []).append(own)
            tree.add(free, 1)
    return sequence, offset, np.array(room, np.int64)


def _packed(pieces: DataFrame, capacity: int, groups: int, spread: Column, base: int, schema: T.StructType) -> DataFrame:
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "_deal"], ascending=[False, True], kind="stable")
        sequence, offset, room = best_fit(group["length"].to_numpy(), capacity)
        own = int(group["_group"].iloc[0])
        return group.assign(sequence_id=base + own * (1 << 24) + sequence, offset=offset, _room=room[sequence])[schema.names]

    return pieces.withColumn("_group", F.pmod(spread, F.lit(groups))).groupBy("_group").applyInPandas(pack, schema)


def pack_best_fit(pieces: DataFrame, capacity: int = 4096, group_rows: int = 2048, slack: float = 0.02) -> DataFrame:
    """``pieces`` (with an integer ``length`` of 1 .. capacity) with ``sequence_id`` and ``offset``
    (replaced if there); all rows and other columns stay."""
    pieces, back = aside(pieces, ("length",), ("sequence_id", "offset"))
    rows = pieces.withColumn("length", F.col("length").cast("long"))
    kept = rows.columns
    # dealt by a row number that follows the rows' places, as keys and rows may repeat
    rows = written(rows.withColumn("_deal", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    schema = T.StructType([f for f in rows.schema if f.name != "_group"]
                          + [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset", "_room")])
    groups = lambda df: max(1, -(-df.count() // group_rows))
    first = written(_packed(rows, capacity, groups(rows), F.col("_deal"), 0, schema), "packed")
    loose = F.col("_room") > int(slack * capacity)
    again = first.filter(loose).drop("sequence_id", "offset", "_room")
    second = _packed(again, capacity, groups(again), F.xxhash64("_deal"), 1 << 62, schema)
    return back(first.filter(~loose).unionByName(second).select(*kept, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, CRC-32 of the ids, sequence_id and offset of every piece of the documents."""
    piece = F.explode(token_pieces(F.col(f"`{text}`"), tokenizer, capacity, end_id)).alias("p")
    pieces = docs.select(F.col(f"`{id_column}`").alias("doc_id"), piece).select(
        "doc_id", "p.piece", "p.start", (F.octet_length("p.ids") / 4).cast("long").alias("length"), F.crc32("p.ids").alias("ids_crc32"))
    return pack_best_fit(pieces, capacity)
