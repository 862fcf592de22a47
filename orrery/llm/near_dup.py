"""Near duplicates of documents by ProbMinHash signatures, banding and verification.

Two texts are linked if the Jaccard or the probability Jaccard similarity of their
five-word shingles (weighted by how often a text has them) is at least ``threshold``;
classes are the connected components of links. Steps:

1. Texts with the same lower-cased words are one node; copies are not compared.
2. Each node has two signatures, of its weighted shingles for the probability Jaccard
   similarity and of the same shingles with weight 1 for the Jaccard similarity. Nodes that
   share a band of either are candidates. Each is first paired with the least node that it
   meets in any bucket, and then with the least nodes of those buckets where it is still in
   another component, so a group of thousands of near copies costs about a pair for each.
3. Nodes that are then in another component than the next ones of their bucket, in the
   order of further bands, are paired with these: nodes alike stand close there.
4. Nodes that are still not in one component with the least node of their bucket are
   compared with every node of the bucket outside their component, so that no link between
   candidates is lost. Only signatures are compared there.

Of all these pairs, those go whose signatures of either kind both agree in far too few
components (four standard deviations below the threshold); the others are verified on their
whole shingle sets. Signatures hold two bits of each of ``components`` components.

Beside them each node has ``PARITIES`` bits, each the parity of the number of its distinct
shingles that fall on it. Two nodes differ in no more bits than shingles, so bits that differ
too often rule a Jaccard similarity of ``threshold`` out for certain. Where neither text
repeats a shingle, that is the probability Jaccard similarity as well. This parts the members
of a large group whose copies are a little too far from each other, without their texts.

A document without words is a class by itself. Nothing is gathered on the driver or by
key: links, components and texts stay tables, and hot keys are join keys that can be split.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import Bloom
from .components import connected
from .probminhash import band_hashes, shingles, signatures, similarities
from .tables import aside, keyed, written
from .textbytes import flat, mix, release, slices

_LONGS = pa.list_(pa.int64())
_SKETCH = pa.struct([("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int64()), ("bands", _LONGS), ("sig", _LONGS),
                    ("odd", _LONGS), ("heavy", pa.bool_())])
PER_LONG = 32  # components in a long, two bits each
LOG_PARITIES = 10
PARITIES = 1 << LOG_PARITIES
SLICE = 1 << 20


def both_signatures(n: int, owner: np.ndarray, ids: np.ndarray, weight: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the weighted shingles, and of the shingles with weight 1: other ones where a shingle repeats."""
    sig = signatures(n, owner, ids, weight, m)
    heavy = np.unique(owner[weight > 1])
    own = np.isin(owner, heavy)
    unit = sig.copy()
    unit[heavy] = signatures(len(heavy), np.searchsorted(heavy, owner[own]), ids[own], np.ones(int(own.sum()), np.int64), m)
    return sig, unit


def parities(n: int, owner: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """n x (PARITIES / 64) longs of parity bits of each text's distinct shingles."""
    out, bit = np.zeros(n * (PARITIES >> 6), np.uint64), mix(ids) >> np.uint64(64 - LOG_PARITIES)
    np.bitwise_xor.at(out, owner * (PARITIES >> 6) + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out.reshape(n, PARITIES >> 6)


def sketches(text: Column, width: int, bands: int, rows: int, components: int) -> Column:
    """Struct of each text: word hashes k1 and k2, number n of distinct shingles, hashes of the bands of the first
    components, and two bits of every component; bands and bits of the weighted shingles, then of those with weight 1;
    parity bits, and whether a shingle repeats."""
    longs = components // PER_LONG

    @F.arrow_udf("struct<k1:long,k2:long,n:long,bands:array<long>,sig:array<long>,odd:array<long>,heavy:boolean>")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], _SKETCH)]
            for texts in slices(batch, SLICE):
                owner, ids, weight, keys = shingles(*flat(texts), width)
                sigs = both_signatures(len(texts), owner, ids, weight, components)
                low = [(sig & np.uint64(3)).reshape(len(texts), longs, PER_LONG) << np.arange(0, 64, 2, dtype=np.uint64) for sig in sigs]
                lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()),
                                                           pa.array(np.ascontiguousarray(x).view(np.int64).ravel()))
                parts.append(pa.StructArray.from_arrays(
                    [pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), pa.array(np.bincount(owner, minlength=len(texts))),
                     lists(np.concatenate([band_hashes(sig[:, :bands * rows], bands) for sig in sigs], axis=1)),
                     lists(np.concatenate([np.bitwise_or.reduce(x, axis=2) for x in low], axis=1)),
                     lists(parities(len(texts), owner, ids)), pa.array(np.bincount(owner[weight > 1], minlength=len(texts)) > 0)],
                    ["k1", "k2", "n", "bands", "sig", "odd", "heavy"]).cast(_SKETCH))
            yield pa.concat_arrays(parts)
            del batch, parts
        release()

    return udf(text.cast("string"))


def word_keys(text: Column, width: int, wanted: Bloom | None = None) -> Column:
    """Struct of the word hashes k1 and k2 of each text; null where ``wanted`` is given and does not hold them."""

    @F.arrow_udf("struct<k1:long,k2:long>")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("k1", pa.int64()), ("k2", pa.int64())])
        for batch in batches:
            parts = [pa.array([], kind)]
            for texts in slices(batch):
                keys = [k.view(np.int64) for k in shingles(*flat(texts), width)[3]]
                gone = ~wanted.might_hold(*keys) if wanted else None
                parts.append(pa.StructArray.from_arrays([pa.array(k, mask=gone) for k in keys], ["k1", "k2"]))
            yield pa.concat_arrays(parts)
            del batch, parts
        release()

    return udf(text.cast("string"))


def _agreement(a: str, b: str, longs: int, first: int = 0) -> Column:
    """How many components agree, of signatures in ``longs`` columns a0, a1, ... and b0, b1, ... from number ``first`` on."""
    def one(i: int) -> Column:
        d = F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))
        return F.bit_count(F.bitwise_not(d.bitwiseOR(F.shiftrightunsigned(d, 1))).bitwiseAND(F.lit(0x5555555555555555)))
    return sum((one(i) for i in range(first + 1, first + longs)), one(first))


def _apart(a: str, b: str) -> Column:
    """In how many parity bits two nodes differ: at most the number of shingles that only one of them has."""
    one = lambda i: F.bit_count(F.col(f"{a}_odd{i}").bitwiseXOR(F.col(f"{b}_odd{i}")))
    return sum((one(i) for i in range(1, PARITIES >> 6)), one(0))


def _may_link(a: str, b: str, longs: int, least: int, threshold: float) -> Column:
    """Whether the signatures of weight 1 agree in ``least`` components and the parity bits allow the Jaccard similarity,
    or the weighted signatures agree so. If no shingle repeats, both similarities are one, and the former decides.
    The small number is for rounding: the verification decides."""
    near = _apart(a, b) <= (F.col(f"{a}_n") + F.col(f"{b}_n")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    heavy = F.col(f"{a}_heavy") | F.col(f"{b}_heavy")
    return (near & (_agreement(a, b, longs, longs) >= least)) | (heavy & (_agreement(a, b, longs) >= least))


def _alike(a: Column, b: Column, width: int) -> Column:
    """The larger of the two similarities of each pair of texts."""

    @F.arrow_udf("double")
    def udf(x: pa.Array, y: pa.Array) -> pa.Array:
        parts, at = [np.zeros(0)], 0
        for some in slices(x, SLICE):
            other, at = y.slice(at, len(some)), at + len(some)
            both = similarities(len(some), shingles(*flat(some), width)[:3], shingles(*flat(other), width)[:3])
            parts.append(both.max(axis=1))
        release()
        return pa.array(np.concatenate(parts))

    return udf(a, b)


def _next_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of each row and the two after it in its bucket that are in other components; rows come sorted."""
    held = None
    for batch in batches:
        rows = [np.concatenate([h, batch[c].to_numpy(zero_copy_only=False)]) if held else batch[c].to_numpy(zero_copy_only=False)
                for h, c in zip(held or (None,) * 3, ("bucket", "node", "root"))]
        found = []
        for k in (1, 2):
            bucket, node, root = rows
            i = np.flatnonzero((bucket[k:] == bucket[:-k]) & (root[k:] != root[:-k]))
            found.append(np.stack([node[i], node[i + k]]))
        held = [r[-2:] for r in rows]
        pairs = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


class NearDuplicates:
    """Classes of the documents: ``documents()`` by document, ``classes()`` by distinct text."""

    def __init__(self, docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = 0.8,
                 width: int = 5, bands: int = 30, rows: int = 5, components: int = 512):
        self.width, self.threshold, self.longs = width, threshold, components // PER_LONG
        same = threshold + (1 - threshold) / 4  # two bits of other shingles agree in a quarter of the cases
        self.least = math.floor(components * same - 4 * math.sqrt(components * same * (1 - same)))
        t = F.col(f"`{text}`")
        sketch = keyed(docs, id_column, text).select(F.col(f"`{id_column}`").alias("id"), F.col("_d1").alias("d1"), F.col("_d2").alias("d2"),
                                                     sketches(t, width, bands, rows, components).alias("s"))
        self.sketch = written(sketch.select("id", "d1", "d2", "s.*", F.monotonically_increasing_id().alias("row")), "sketches")
        self.nodes = written(self.sketch.filter("n > 0").groupBy("k1", "k2").agg(
            F.min("row").alias("node"), F.min("id").alias("first"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("sig").alias("sig"),
            F.first("odd").alias("odd"), F.first("n").alias("n"), F.first("heavy").alias("heavy")), "nodes")
        further = lambda k: F.transform("bands", lambda x, i: F.get("bands", i - i % F.lit(bands) + (i + k) % F.lit(bands)))
        # a band of the shingles with weight 1 counts where it differs from the weighted one
        fresh = (F.col("band") < bands) | (F.col("x.bucket") != F.get("bands", F.col("band") - bands))
        zipped = F.arrays_zip(F.col("bands").alias("bucket"), further(1).alias("next"), further(2).alias("after"))
        rows_ = self.nodes.select("node", "bands", F.posexplode(zipped).alias("band", "x")).filter(fresh).select("node", "band", "x.*")
        least = rows_.groupBy("bucket").agg(F.min("node").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
        shared = written(rows_.join(least, "bucket"), "buckets")
        keys = self.nodes.select("k1", "k2", "node").join(shared.select("node").distinct(), "node", "left_semi")
        wanted = written(keys, "wanted")
        found = docs.select(t.cast("string").alias("text")).select("text", word_keys(F.col("text"), width, Bloom(wanted)).alias("k")).select("text", "k.*")
        self.texts = written(found.filter("k1 IS NOT NULL").join(wanted, ["k1", "k2"]).select("node", "text").dropDuplicates(["node"]), "texts")

        # one star pair of each node, with the least node that it meets; then those of other buckets that are still apart
        star = shared.filter("node <> least")
        once = star.groupBy("node").agg(F.min("least").alias("a")).select("a", F.col("node").alias("b"))
        self.roots = written(connected(self._verified(once), "a", "b"), "roots")
        root_of = lambda c, out: self.roots.select(F.col("node").alias(c), F.col("root").alias(out))
        apart = (star.select("node", "least").distinct().join(root_of("node", "x"), "node", "left").join(root_of("least", "y"), "least", "left")
                 .filter(F.coalesce("x", "node") != F.coalesce("y", "least")))
        tried = once.select(F.col("a").alias("least"), F.col("b").alias("node"))
        apart = apart.select("node", "least").join(tried, ["node", "least"], "left_anti")
        self._join(self._verified(apart.select(F.col("least").alias("a"), F.col("node").alias("b"))))
        for order in (["next", "after"], ["after", "next"]):
            placed = shared.join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
            near = (placed.repartitionByRange("bucket", *order, "node").sortWithinPartitions("bucket", *order, "node")
                    .select("bucket", "node", "root").mapInArrow(_next_ones, "a long, b long").distinct())
            self._join(self._verified(near))
        # rows are narrow until it is known which of them still meet
        own = (shared.select("bucket", "band", "node", "least").join(root_of("node", "root"), "node", "left")
               .join(root_of("least", "least_root"), "least", "left")
               .withColumn("root", F.coalesce("root", "node")).withColumn("least_root", F.coalesce("least_root", "least"))
               .filter("root <> least_root").drop("least", "least_root"))
        own = written(own, "unplaced")
        met = own.select("bucket").distinct()
        own = self._signed(own, "node", "x", True).withColumnRenamed("node", "x").withColumnRenamed("root", "x_root")
        other = (shared.select("bucket", "node").join(met, "bucket", "left_semi").join(root_of("node", "root"), "node", "left")
                 .withColumn("root", F.coalesce("root", "node")))
        other = self._signed(other, "node", "y", True).withColumnRenamed("bucket", "y_bucket")
        # a pair counts in the first band that it shares
        again = F.arrays_overlap(F.slice("x_bands", F.lit(1), F.col("band")), F.slice("y_bands", F.lit(1), F.col("band")))
        cross = own.join(other, (F.col("bucket") == F.col("y_bucket")) & (F.col("x_root") != F.col("root"))
                         & _may_link("x", "y", self.longs, self.least, self.threshold) & ~again)
        cross = cross.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
        self._join(self._exactly(written(cross, "crossing")))

    def _signed(self, rows: DataFrame, node: str, prefix: str, bands: bool = False) -> DataFrame:
        """``rows`` with the signature of ``node`` in columns prefix0, prefix1, ..., what else _may_link() needs, and its bands if wanted."""
        sig = [F.col("sig")[i].alias(f"{prefix}{i}") for i in range(2 * self.longs)]
        sig += [F.col("odd")[i].alias(f"{prefix}_odd{i}") for i in range(PARITIES >> 6)] + [F.col(c).alias(f"{prefix}_{c}") for c in ("n", "heavy")]
        more = [F.col("bands").alias(f"{prefix}_bands")] if bands else []
        return rows.join(self.nodes.select(F.col("node").alias(node), *sig, *more), node)

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose signatures, and then texts, are alike enough."""
        signed = self._signed(self._signed(pairs, "a", "x"), "b", "y")
        return self._exactly(written(signed.filter(_may_link("x", "y", self.longs, self.least, self.threshold)).select("a", "b"), "candidates"))

    def _exactly(self, pairs: DataFrame) -> DataFrame:
        side = lambda c: self.texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
        return written(pairs.join(side("b"), "b").join(side("a"), "a")
                       .filter(_alike(F.col("text_a"), F.col("text_b"), self.width) >= self.threshold).select("a", "b"), "links")

    def _join(self, links: DataFrame) -> None:
        """Components after further links: those of the components that they join."""
        root_of = lambda c: self.roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        ends = links.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left").select(
            F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
        more = written(connected(ends, "a", "b"), "joined").withColumnRenamed("root", "top")
        old = self.roots.join(more.select(F.col("node").alias("root"), "top"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        new = more.join(self.roots.select("node"), "node", "left_anti").select("node", F.col("top").alias("root"))
        self.roots = written(old.unionByName(new), "roots")

    def classes(self) -> DataFrame:
        """(k1, k2, node, first, copies, class_id, is_keeper): of each distinct text its least document and number of
        documents, the least document of its class, and whether this text is that one's."""
        nodes = self.nodes.select("k1", "k2", "node", "first", "copies").join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        best = nodes.groupBy("root").agg(F.min("first").alias("class_id"), F.min(F.struct("first", "node")).alias("keeper"))
        return nodes.join(best, "root").withColumn("is_keeper", F.col("keeper.node") == F.col("node")).drop("keeper", "root")

    def documents(self) -> DataFrame:
        """(doc_id, class_id): class_id is the least doc_id of the document's class."""
        return (self.sketch.select("id", "k1", "k2", "n").join(self.classes(), ["k1", "k2"], "left")
                .select(F.col("id").alias("doc_id"), F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id")))

    def going(self) -> DataFrame:
        """(d1, d2, stays) of the documents of all texts that lose any: d1 and d2 are hashes of its id and text, and
        of the documents with those that stay one does."""
        some = self.sketch.select("id", "d1", "d2", "k1", "k2").join(self.classes().filter("not is_keeper or copies > 1"), ["k1", "k2"])
        best = some.filter(F.col("is_keeper") & F.col("id").eqNullSafe(F.col("first"))).groupBy("k1", "k2").agg(
            F.min(F.struct("d1", "d2")).alias("best"))
        return some.join(best, ["k1", "k2"], "left").select("d1", "d2", F.struct("d1", "d2").eqNullSafe(F.col("best")).alias("stays")).distinct()


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without all but one document (that of the least id) of each class; rows without words all stay.
    Documents whose texts lose none do not move."""
    going = written(NearDuplicates(docs, id_column, text, **options).going(), "going")
    docs, back = aside(docs, (id_column, text))
    some = Bloom(going, "d1", "d2")

    @F.arrow_udf("boolean")
    def may_go(d1: pa.Array, d2: pa.Array) -> pa.Array:
        return pa.array(some.might_hold(d1.to_numpy(zero_copy_only=False), d2.to_numpy(zero_copy_only=False)))

    # a null id and a null text have the same hashes as the other way round; texts without words all stay
    words = F.coalesce(F.rlike(F.col(f"`{text}`").cast("string"), F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    all_ = keyed(docs, id_column, text).withColumn("_may", may_go("_d1", "_d2") & words)
    met = all_.filter("_may").join(going.select(F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), "stays"), ["_d1", "_d2"], "left")
    # what only the Bloom filter took for one of them stays whatever the others do
    met = met.filter("stays IS NULL OR stays").withColumn("_own", F.when(F.col("stays").isNull(), F.monotonically_increasing_id()))
    kept = met.dropDuplicates(["_d1", "_d2", "_own"])
    return back(kept.select(docs.columns).unionByName(all_.filter("not _may").select(docs.columns)))
