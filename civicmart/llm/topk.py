"""Exact top-k search by columnar branch-and-bound.

Vectors are turned into whole numbers and kept in vertical layout: a block holds one row per
dimension, one column per vector. For a batch of queries the inner products grow dimension block
by dimension block. After each block a candidate's score is at most its sum so far plus the
product of the masses (norms) that remain on both sides; candidates whose bound is under the k-th
best score known are dropped, and the survivors are compacted before the next block.

Spark packs candidates into blocks by falling norm. Every query is first run against the block of
greatest norms, and its k-th score there is the floor that it carries from then on. A score is at
most the product of two norms, so a query reaches a block only if its norm times the block's
greatest one is not under its floor. Queries are packed by the least norm that they still need, so that whole blocks of
them skip the same candidates. Each remaining pair of blocks is one row of work, and the k best
of all are merged by a grouped window.

Defined results: vectors that are null, or hold null or non-finite components, take no part;
nor do null ids. Rows with one id count once, with the smallest vector in array order. Shorter
vectors count as padded with zeros. Ties go to the smaller id. Components and scores beyond the
range of a long count as its ends; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_order, pick, saved

K = 20
SCALE = 64
#: Vectors in a packed block, of candidates and of queries.
CANDIDATES = 8_192
QUERIES = 512
#: Dimensions accumulated between two rounds of pruning.
STEP = 16
#: Whole numbers below this are exact in float64, so their sums of products may use it.
EXACT = 2.0**53
#: Scores that are certain to stay below this are summed in 64-bit whole numbers, others in unbounded ones.
WIDE = 2.0**62
LONG = (-(1 << 63), (1 << 63) - 1)


def whole_numbers(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, x as double; vectors that take part."""
    rows = pick(vectors, id_column, column).toDF("vec_id", "e").filter("vec_id IS NOT NULL AND e IS NOT NULL")
    numbers = F.transform("e", lambda x: x.cast("double"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    one = rows.filter(finite).select("vec_id", numbers.alias("e")).groupBy("vec_id").agg(F.min("e").alias("e"))
    return one.select("vec_id", F.transform("e", lambda x: F.floor(x * scale)).alias("v"))


def _blocks(rows: DataFrame, size: int, name: str, keys: list[Column]) -> DataFrame:
    """``rows`` packed in the order of ``keys`` into blocks of ``size``: (name, rows)."""
    block = F.floor((F.col("place") - 1) / size).cast("long")
    return in_order(rows, keys, "place").groupBy(block.alias(name)).agg(F.collect_list(F.struct(*rows.columns)).alias("rows"))


def _vertical(vectors, dims: int) -> np.ndarray:
    """(dims, vectors) whole numbers, short vectors padded with zeros."""
    packed = np.zeros((dims, len(vectors)), np.int64)
    for i, v in enumerate(vectors):
        packed[: len(v), i] = v
    return packed


def best_of(q_ids, queries: np.ndarray, c_ids: np.ndarray, candidates: np.ndarray, k: int = K, floors=None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, candidate ids, scores) of each query's k best in one candidate block.

    ``queries`` and ``candidates`` are vertical. ``floors`` are scores under which a query needs no
    candidate (the least long: none). Sums run in float64 where every partial sum is certain to be exact there, else in whole numbers.
    """
    dims = len(queries)
    # the dimensions with the most mass first: bounds fall early
    order = np.argsort(-(candidates.astype(np.float64) ** 2).sum(1), kind="stable")
    q, c = queries[order], np.ascontiguousarray(candidates[order])
    starts = list(range(0, dims, STEP)) or [0]
    mass = lambda x: [np.sqrt((x[s:].astype(np.float64) ** 2).sum(0)) for s in [*starts, dims]]
    q_rest, c_rest = mass(q), mass(c)
    largest = np.outer(q_rest[0], c_rest[0]) * (1 + 1e-9)  # no partial sum is above it
    wide = largest >= WIDE
    small = np.where(wide, 0.0, largest).max(1, initial=0) < EXACT
    for own_kind, kind in ((small, np.float64), (~small, np.int64)):
        chosen = np.flatnonzero(own_kind)
        if not len(chosen):
            continue
        qk, ck = q[:, chosen].astype(kind), c.astype(kind)
        first = qk[:STEP].T @ ck[:STEP]
        for j, i in enumerate(chosen):
            query, known = q_ids[i], None if floors is None or floors[i] == LONG[0] else int(floors[i])
            own = (c_ids != query) & ~wide[i]
            alive, sums = np.flatnonzero(own), first[j][own]
            for b, s in enumerate(starts):
                if b:
                    sums = sums + qk[s : s + STEP, j] @ ck[s : s + STEP, alive]
                if b + 1 < len(starts) and (known is not None or len(alive) > 4 * k):
                    floor = known
                    if len(alive) > 4 * k:
                        # the candidates ahead so far, scored in full, give the k-th best a floor
                        ahead = alive[np.argpartition(-sums, 2 * k)[: 2 * k]]
                        own_floor = np.partition(qk[:, j] @ ck[:, ahead], -k)[-k]
                        floor = own_floor if known is None else max(own_floor, known)
                    rest = q_rest[b + 1][i] * c_rest[b + 1][alive]
                    stay = sums + rest + 1e-9 * (np.abs(sums) + rest) + 0.5 >= floor
                    alive, sums = alive[stay], sums[stay]
            sums = sums.astype(np.int64)
            if wide[i].any():
                far = np.flatnonzero(wide[i] & (c_ids != query))
                exact = [sum(x * y for x, y in zip(q[:, i].tolist(), c[:, f].tolist())) for f in far]
                alive = np.concatenate([alive, far])
                sums = np.concatenate([sums, np.array([min(max(x, LONG[0]), LONG[1]) for x in exact], np.int64)])
            if known is not None:
                alive, sums = alive[sums >= known], sums[sums >= known]
            if len(alive) > k:
                # all that tie with the k-th score stay until ids decide
                stay = sums >= np.partition(sums, len(sums) - k)[len(sums) - k]
                alive, sums = alive[stay], sums[stay]
            rank = np.lexsort((c_ids[alive], ~sums))[:k]  # ~x falls as x grows, for every long
            yield query, c_ids[alive[rank]], sums[rank]


def _run(k: int):
    """Function over batches of work: rows of a query block and a candidate block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                dims = max([len(v) for v in r.c_vectors] + [len(v) for v in r.q_vectors])
                c_ids = np.asarray(r.c_ids, np.int64)
                found = best_of(list(r.q_ids), _vertical(r.q_vectors, dims), c_ids, _vertical(r.c_vectors, dims), k, list(r.q_floors))
                yield _frame(list(found))

    return run


def _frame(found) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "query_id": np.repeat(np.array([q for q, _, _ in found], np.int64), [len(x) for _, x, _ in found]),
            "vec_id": np.concatenate([x for _, x, _ in found]).astype(np.int64),
            "score": np.concatenate([x for _, _, x in found]).astype(np.int64),
        }
    )


def search(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of all other rows for each query row.

    ``is_query`` is a condition on vec_id.
    """
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = saved(whole_numbers(vectors).withColumn("norm", F.sqrt(square)))
    chosen = rows.filter(is_query)
    n_blocks = max(1, -(-rows.count() // CANDIDATES))
    parts = max(2 * n_blocks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    candidates = saved(
        _blocks(rows, CANDIDATES, "c", [F.col("norm").desc(), F.col("vec_id")])
        .select("c", F.col("rows.vec_id").alias("c_ids"), F.col("rows.v").alias("c_vectors"), F.array_max("rows.norm").alias("c_norm"))
    )

    def work(queries: DataFrame, pairs: DataFrame) -> DataFrame:
        # a stated number of partitions: adaptive execution joins small ones by bytes, and this work is arithmetic
        placed = pairs.join(queries, "q").repartition(parts, "c")
        both = placed.join(candidates.select("c", "c_ids", "c_vectors").repartition(parts, "c"), "c")
        return both.select("q_ids", "q_vectors", "q_floors", "c_ids", "c_vectors").mapInPandas(_run(k), "query_id long, vec_id long, score long")

    def packed(name: str, blocks: DataFrame) -> DataFrame:
        return blocks.select(
            name, F.col("rows.vec_id").alias("q_ids"), F.col("rows.v").alias("q_vectors"),
            F.col("rows.floor").alias("q_floors"), F.array_min("rows.need").alias("need"),
        )

    unknown = chosen.select("vec_id", "v", F.lit(LONG[0]).cast("long").alias("floor"), F.lit(0.0).alias("need"))
    first = saved(packed("q", _blocks(unknown, QUERIES, "q", [F.col("vec_id")])))
    # one block, CANDIDATES vectors whatever the data, goes to every query block
    greatest = F.broadcast(candidates.filter("c = 0").select("c", "c_ids", "c_vectors"))
    head = first.repartition(parts, "q").withColumn("c", F.lit(0).cast("long")).join(greatest, "c")
    heads = head.select("q_ids", "q_vectors", "q_floors", "c_ids", "c_vectors").mapInPandas(_run(k), "query_id long, vec_id long, score long")
    found = heads
    if n_blocks > 1:
        heads = saved(heads)
        floors = heads.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
        # a candidate of a smaller norm than this is under the floor
        need = F.when((F.col("floor") > 0) & (F.col("norm") > 0), (F.col("floor") - 0.5) / (F.col("norm") * (1 + 1e-9)))
        known = chosen.join(floors, chosen["vec_id"] == floors["query_id"], "left").select("vec_id", "v", F.coalesce("floor", F.lit(LONG[0])).alias("floor"), F.coalesce(need, F.lit(0.0)).alias("need"))
        queries = saved(packed("q", _blocks(known, QUERIES, "q", [F.col("need"), F.col("vec_id")])))
        pairs = (
            queries.select("q", "need", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("c"))
            .join(candidates.select("c", "c_norm"), "c")
            .filter("c_norm * (1 + 1e-9) >= need")
            .select("q", "c")
        )
        found = heads.unionByName(work(queries.drop("need"), pairs))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
