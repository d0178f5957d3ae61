"""Vectors: inner products, truncated dimensions, exact and approximate nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize, ship


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision; null if a side is null, lengths must agree."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def truncate(v: Column, dim: int) -> Column:
    """The first ``dim`` components, scaled to unit length (length floored at 1e-12)."""
    head = F.transform(F.slice(v, 1, dim), lambda x: x.cast("double"))
    norm = F.greatest(F.sqrt(F.aggregate(head, F.lit(0.0), lambda s, x: s + x * x)), F.lit(1e-12))
    return F.transform(head, lambda x: x / norm)


def _matrix(col: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = col.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    return np.asarray(flat.flatten(), np.float64).reshape(n, -1)


def _block_top(k: int, exclude_self: bool) -> Callable:
    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if q.num_rows and c.num_rows:
            qi, ci = np.asarray(q.column("qid")), np.asarray(c.column("did"))
            s = _matrix(q.column("v"), q.num_rows) @ _matrix(c.column("v"), c.num_rows).T
            if exclude_self:
                s[qi[:, None] == ci[None, :]] = -np.inf
            n = min(k + 1, len(ci))
            for row in range(len(qi)):
                near = np.argpartition(-s[row], n - 1)[:n] if n < len(ci) else np.arange(len(ci))
                if n < len(ci):  # ties at the edge, whole
                    near = np.flatnonzero(s[row] >= s[row][near].min())
                near = near[np.isfinite(s[row][near])]
                near = near[np.lexsort((ci[near], -s[row][near]))][:k]
                out[0] += [qi[row]] * len(near)
                out[1] += ci[near].tolist()
                out[2] += s[row][near].tolist()
        return pa.table({"qid": pa.array(out[0], pa.int64()), "did": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    return run


def knn(queries: DataFrame, corpus: DataFrame, k: int, exclude_self: bool = True, query_block: int = 4096, corpus_block: int = 65536) -> DataFrame:
    """(qid, rank, did, score): exact top ``k`` of ``corpus`` (did, v) for each of ``queries`` (qid, v); score desc, did asc.

    A stated query set against all rows, in blocks: each pair of a query block and a corpus block is one matrix product
    that keeps k rows per query, and the survivors are merged by rank. Vectors are of one length; null vectors take no part.
    """
    ship(corpus.sparkSession)
    q = materialize(queries.select(F.col("qid").cast("bigint"), "v").filter("v IS NOT NULL"), "queries")
    c = materialize(corpus.select(F.col("did").cast("bigint"), "v").filter("v IS NOT NULL"), "corpus")
    nq, nc = max(1, -(-q.count() // query_block)), max(1, -(-c.count() // corpus_block))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    q = q.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(nq))).withColumn("cb", spread(nc))
    c = c.withColumn("cb", F.pmod(F.xxhash64("did"), F.lit(nc))).withColumn("qb", spread(nq))
    part = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInArrow(_block_top(k, exclude_self), "qid long, did long, score double")
    return ranked(part, k)


def ranked(scored: DataFrame, k: int) -> DataFrame:
    """(qid, rank, did, score): the best ``k`` of each query, ties by did."""
    from pyspark.sql import Window as W

    w = W.partitionBy("qid").orderBy(F.desc("score"), "did")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("qid", "rank", "did", "score")


def _block_tops(dims: tuple[int, ...], k: int, exclude_self: bool) -> Callable:
    """Like ``_block_top`` at each of ``dims`` leading components, scaled to unit length; one pass over the block serves all."""

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        out = []
        if q.num_rows and c.num_rows:
            x, y = _matrix(q.column("v"), q.num_rows), _matrix(c.column("v"), c.num_rows)
            for d in dims:
                unit = lambda m, d=d: m[:, :d] / np.maximum(np.linalg.norm(m[:, :d], axis=1, keepdims=True), 1e-12)
                listed = lambda m: pa.array(list(m))
                got = _block_top(k, exclude_self)(pa.table({"qid": q.column("qid"), "v": listed(unit(x))}), pa.table({"did": c.column("did"), "v": listed(unit(y))}))
                out.append(got.append_column("dim", pa.array([d] * got.num_rows, pa.int32())))
        return pa.concat_tables(out) if out else pa.table({"qid": pa.array([], pa.int64()), "did": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "dim": pa.array([], pa.int32())})

    return run


def knn_dims(queries: DataFrame, corpus: DataFrame, dims: tuple[int, ...], k: int, exclude_self: bool = True, query_block: int = 4096, corpus_block: int = 65536) -> DataFrame:
    """``knn`` at each truncated dimension that the vectors have: (dim, qid, rank, did, score). The corpus is moved once for all of them."""
    from pyspark.sql import Window as W

    ship(corpus.sparkSession)
    longest = corpus.agg(F.max(F.size("v"))).first()[0] or 0
    dims = tuple(d for d in dims if d <= longest)
    if not dims:
        kinds = "dim int, qid long, rank int, did long, score double"
        return corpus.sparkSession.createDataFrame([], kinds)
    whole = F.col("v").isNotNull() & (F.size("v") == longest)
    q = materialize(queries.select(F.col("qid").cast("bigint"), "v").filter(whole), "queries")
    c = materialize(corpus.select(F.col("did").cast("bigint"), "v").filter(whole), "corpus")
    nq, nc = max(1, -(-q.count() // query_block)), max(1, -(-c.count() // corpus_block))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    q = q.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(nq))).withColumn("cb", spread(nc))
    c = c.withColumn("cb", F.pmod(F.xxhash64("did"), F.lit(nc))).withColumn("qb", spread(nq))
    part = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInArrow(_block_tops(dims, k, exclude_self), "qid long, did long, score double, dim int")
    w = W.partitionBy("dim", "qid").orderBy(F.desc("score"), "did")
    return part.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("dim", "qid", "rank", "did", "score")


SAMPLE, LISTS = 20_000, 4_096  # bounds on the vectors that the index is fitted on, and on its lists


class InvertedLists:
    """Approximate search: spherical k-means on a bounded sample, every row listed under its nearest centre.

    There are about as many lists as a list has rows, up to LISTS; beyond, lists are worked in blocks of ``block`` rows. A
    query looks into the ``probes`` lists of the nearest centres; ``probes_for`` says how many a share of the exact
    neighbours takes, and ``recall`` measures what a search found.
    """

    def __init__(self, corpus: DataFrame, lists: int | None = None, sample: int = SAMPLE, rounds: int = 8, block: int = 65_536):
        ship(corpus.sparkSession)
        self.corpus = corpus.select(F.col("did").cast("bigint"), "v").filter("v IS NOT NULL")
        n = self.corpus.count()
        lists = lists or max(1, min(LISTS, round(n**0.5)))
        rows = self.corpus.select("v", F.xxhash64("did").alias("h")).orderBy("h").limit(sample).collect()
        self.sample = x = np.array([r.v for r in rows], np.float64).reshape(len(rows), -1)
        centres = x[: min(lists, len(x))].copy()
        for _ in range(rounds):
            near = (x @ centres.T).argmax(axis=1)
            for j in range(len(centres)):
                if (near == j).any():
                    m = x[near == j].mean(axis=0)
                    centres[j] = m / max(np.linalg.norm(m), 1e-12)
        self.centres = centres
        self.blocks = max(1, -(-n // (block * max(1, len(centres)))))

    def probes_for(self, share: float, k: int = 10, queries: int = 200) -> int:
        """Lists that a query has to look into for ``share`` of its ``k`` nearest, measured within the sample."""
        x, c = self.sample, self.centres
        if len(x) <= k:
            return len(c)
        q = x[: min(queries, len(x))]
        s = q @ x.T
        s[np.arange(len(q)), np.arange(len(q))] = -np.inf
        near = np.argpartition(-s, k, axis=1)[:, :k]
        listed = (x @ c.T).argmax(axis=1)
        place = np.argsort(np.argsort(-(q @ c.T), axis=1), axis=1)  # of every list in a query's order
        found = np.sort(np.take_along_axis(place, listed[near], axis=1).ravel())
        return min(len(c), int(found[min(len(found) - 1, int(np.ceil(share * len(found))) - 1)]) + 1)

    def _nearest(self, n: int) -> Callable:
        centres = self.centres

        def run(batches):
            for b in batches:
                if b.num_rows:
                    s = _matrix(pa.chunked_array([b.column(1)]), b.num_rows) @ centres.T
                    top = np.argsort(-s, axis=1)[:, :n]
                    take = np.repeat(np.arange(b.num_rows), top.shape[1])
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(take)), b.column(1).take(pa.array(take)), pa.array(top.ravel(), pa.int64())], ["id", "v", "list"])

        return run

    def search(self, queries: DataFrame, k: int, probes: int, exclude_self: bool = True) -> DataFrame:
        """(qid, rank, did, score): the best ``k`` of the rows in the ``probes`` nearest lists of each query."""
        kind = dict(queries.dtypes)["v"]
        blocks = F.lit(self.blocks)
        q = queries.select(F.col("qid").cast("bigint"), "v").filter("v IS NOT NULL").mapInArrow(self._nearest(min(probes, len(self.centres))), f"id long, v {kind}, list long").withColumnRenamed("id", "qid")
        q = q.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), (blocks - 1).cast("bigint"))))
        c = self.corpus.mapInArrow(self._nearest(1), f"id long, v {dict(self.corpus.dtypes)['v']}, list long").withColumnRenamed("id", "did").withColumn("block", F.pmod(F.xxhash64("did"), blocks).cast("bigint"))
        part = q.groupBy("list", "block").cogroup(c.groupBy("list", "block")).applyInArrow(_block_top(k, exclude_self), "qid long, did long, score double")
        return ranked(part, k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: share of the exact neighbours that ``found`` has."""
    hit = exact.select("qid", "did").join(found.select("qid", "did", F.lit(1).alias("hit")), ["qid", "did"], "left")
    return hit.agg(F.count("*").alias("exact"), F.count("hit").alias("found"), (F.count("hit") / F.count("*")).alias("recall"))
