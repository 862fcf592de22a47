"""Exact top-k inner products by a Voronoi kNN join.

Components become integers floor(64 x). A further component sqrt(M^2 - |x|^2) for the
candidates (M: their largest norm) and 0 for the queries makes the highest inner products
the least Euclidean distances, where the triangle inequality holds.

Pivots are a bounded sample of the candidates. Every candidate and every query goes to
the cell of its nearest pivot. Summaries (each cell's least candidate distances, the
largest query distance) bound the distance of the k-th neighbour for all queries of a
cell; a block of a cell's candidates is replicated only to those query cells whose bound
it can reach, and solved there locally. Cells are cut into blocks of about ``block_rows``
rows, so a cell that holds a third of all rows is many blocks. Block results are merged
to the k best per query, ties to the smaller id.

Rows with a null id, and vectors that are null or hold null or non-finite components,
take no part. Repeated rows (same id and vector) count once; a query is not its own
candidate, nor is any row with its id. Shorter vectors are padded with zeros.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

EXACT = float(1 << 53)


def _dots(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integer-valued vectors; exact, as int64 (clipped to its range)."""
    bound = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1]
    if bound < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = np.array([[int(v) for v in r] for r in q.tolist()], object).reshape(q.shape)
    other = np.array([[int(v) for v in r] for r in x.tolist()], object).reshape(x.shape)
    return np.clip(whole.dot(other.T), -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray, p_extra: np.ndarray) -> np.ndarray:
    """Distances between vectors with their further component and the pivots."""
    out = np.empty((len(x), len(pivots)))
    for j in range(len(pivots)):
        out[:, j] = np.sqrt(((x - pivots[j]) ** 2).sum(axis=1) + (extra - p_extra[j]) ** 2)
    return out


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k highest scores, ties to the smaller id."""
    if len(score) > k:
        own = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        own = np.arange(len(score))
    return own[np.lexsort((ids[own], -score[own]))][:k]


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding",
                       pivots: int = 16, block_rows: int = 1024, query_rows: int = 512) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best candidates of every query."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()
                       & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.withColumn("v", F.transform("v", lambda x: F.when(F.abs(x) < 2.0 ** 50, F.floor(x * 64).cast("double")).otherwise(x * 64)))
    rows = written(rows.dropDuplicates(["id", "v"]).withColumn("norm", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)), "vectors")
    schema = "query_id long, rank int, vec_id long, score long"
    dims, norm = rows.agg(F.max(F.size("v")), F.max("norm")).first()
    if dims is None or k < 1:
        return spark.createDataFrame([], schema)
    sample = rows.orderBy(F.xxhash64("id", "v")).limit(pivots).collect()

    def matrix(vs) -> np.ndarray:
        out = np.zeros((len(vs), dims))
        for i, v in enumerate(vs):
            out[i, :len(v)] = v
        return out

    p = matrix([r.v for r in sample])
    p_extra = np.sqrt(np.maximum(norm - (p ** 2).sum(axis=1), 0))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b["v"].to_pylist())
            d = _distances(x, np.sqrt(np.maximum(norm - (x ** 2).sum(axis=1), 0)), p, p_extra)
            dq = _distances(x, np.zeros(len(x)), p, p_extra)
            cell, qcell = d.argmin(axis=1), dq.argmin(axis=1)
            at = np.arange(len(x))
            yield pa.RecordBatch.from_arrays(
                [b["id"], pa.array([r.tobytes() for r in x], pa.binary()), b["q"], pa.array(cell, pa.int32()), pa.array(d[at, cell]),
                 pa.array(qcell, pa.int32()), pa.array(dq[at, qcell])], ["id", "v", "q", "cell", "dist", "qcell", "qdist"])

    placed = written(rows.select("id", "v", "q").mapInArrow(
        cells, "id long, v binary, q boolean, cell int, dist double, qcell int, qdist double"), "cells")

    # summaries: at most (k + 1) distances of each cell, and one row for each cell of candidates and of queries
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("dist"))
    near = placed.select("cell", "dist").withColumn("r", rank).filter(F.col("r") <= k + 1).collect()
    size = {r.cell: r.n for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    asked = {r.qcell: r for r in placed.filter("q").groupBy("qcell").agg(F.count("*").alias("n"), F.max("qdist").alias("far")).collect()}
    if not asked:
        return spark.createDataFrame([], schema)
    between = _distances(p, p_extra, p, p_extra)
    ease = 1e-6 * (1 + math.sqrt(norm) + max(r.far for r in asked.values()))  # distances are rounded
    reach = {}
    for i, r in asked.items():
        upper = sorted(r.far + between[i, c.cell] + c.dist for c in near)
        reach[i] = (upper[k] if len(upper) > k else math.inf) + ease

    def blocks(cell: str, sizes: dict[int, int], rows_each: int) -> Column:
        """Number of a row's block: hashed over as many blocks as its cell needs."""
        n = F.create_map(*(F.lit(x) for c, n in sizes.items() for x in (c, -(-n // rows_each))))
        return F.pmod(F.xxhash64("id", "v"), n[F.col(cell)]).cast("int")

    def gather(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("id", kind="stable")
        return pd.DataFrame({"cell": [g["cell"].iloc[0]], "block": [g["block"].iloc[0]], "far": [g["dist"].max()],
                             "ids": [g["id"].to_numpy(np.int64).tobytes()], "vs": [b"".join(g["v"])]})

    block_schema = "cell int, block int, far double, ids binary, vs binary"
    data = (placed.select("cell", blocks("cell", size, block_rows).alias("block"), "dist", "id", "v")
            .groupBy("cell", "block").applyInPandas(gather, block_schema))
    queries = (placed.filter("q").select(F.col("qcell").alias("cell"), blocks("qcell", {c: r.n for c, r in asked.items()}, query_rows).alias("block"),
                                         F.col("qdist").alias("dist"), "id", "v")
               .groupBy("cell", "block").applyInPandas(gather, block_schema)
               .select(F.col("cell").alias("qcell"), F.col("block").alias("qblock"), F.col("ids").alias("qids"), F.col("vs").alias("qs")))

    # query blocks that a block of candidates can matter to
    wanted = F.lit(None)
    for c in size:
        options = F.array(*(F.struct(F.lit(i).alias("qcell"), F.lit(-(-asked[i].n // query_rows)).alias("n"),
                                     F.lit(float(between[i, c] - asked[i].far - reach[i])).alias("least")) for i in sorted(asked)))
        wanted = F.when(F.col("cell") == c, options).otherwise(wanted)
    wanted = F.filter(wanted, lambda o: o["least"] <= F.col("far"))
    sent = (data.select("cell", "block", "far", "ids", "vs", F.explode(wanted).alias("o"))
            .select("ids", "vs", F.col("o.qcell").alias("qcell"), F.explode(F.sequence(F.lit(0), F.col("o.n") - 1)).alias("qblock")))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list] = {}

        def results() -> pa.RecordBatch:
            out = [np.concatenate([np.repeat(qids, [len(s) for _, s in top])
                                   for qids, top in best.values()] or [np.zeros(0, np.int64)]),
                   *(np.concatenate([t[n] for _, top in best.values() for t in top] or [np.zeros(0, np.int64)]) for n in (0, 1))]
            best.clear()
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out], ["query_id", "vec_id", "score"])

        for b in batches:
            for i in range(b.num_rows):
                key = (b["qcell"][i].as_py(), b["qblock"][i].as_py())
                ids = np.frombuffer(b["ids"][i].as_py(), np.int64)
                x = np.frombuffer(b["vs"][i].as_py()).reshape(len(ids), dims)
                qids = np.frombuffer(b["qids"][i].as_py(), np.int64)
                q = np.frombuffer(b["qs"][i].as_py()).reshape(len(qids), dims)
                scores = _dots(q, x)
                if key not in best:
                    if len(best) >= 64:
                        yield results()
                    best[key] = [qids, [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(qids)]
                top = best[key][1]
                for n, own in enumerate(qids):
                    other = ids != own
                    more = (np.concatenate([top[n][0], ids[other]]), np.concatenate([top[n][1], scores[n][other]]))
                    keep = _best(more[1], more[0], k)
                    top[n] = (more[0][keep], more[1][keep])
        yield results()

    found = sent.join(queries, ["qcell", "qblock"]).mapInArrow(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
