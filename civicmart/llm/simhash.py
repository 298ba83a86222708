"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance d or less both lie within d/2 of some point between them. So each
distinct fingerprint emits every variant within d/2; the shuffle on variants brings all linked
fingerprints together without comparing all pairs. A variant's group holds at most the ball's
volume of distinct fingerprints (65 at distance 2), however many copies the documents have,
and its members are linked to the smallest one: all of them lie within d of each other, so
the star has the same components as all pairs.

Defined results: a null text and a text without words have fingerprint zero, which is linked
like any other; repeated rows each get their own row; component_id ignores null doc_ids (null
only if no reachable row has one); an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import discard, numbered, pick, saved, text_key

BITS = 64
SEED = 42
SHINGLE = 3
MAX_DISTANCE = 2
#: Shingles hashed at a time; bounds the memory that a very long text takes.
BLOCK = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text as a signed 64-bit number: bit set if set in over half the hashes.

    Words are runs of non-space characters, A-Z lower-cased; bytes.lower and bytes.split do
    just that in UTF-8, as both touch ASCII characters only.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    if len(found) < shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(found), SEED)).astype(np.int64))
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(found) - shingle + 1
    starts, ends = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at : at + BLOCK], ends[at : at + BLOCK])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > n, bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp), one row per input row."""

    @pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return pick(docs, "doc_id", "text").select("doc_id", text_key(F.col("text")).alias("text_key"), simhash("text").alias("fp"))


def _masks(radius: int) -> list[int]:
    """Every XOR mask of at most ``radius`` bits, as signed 64-bit numbers."""
    found = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(BITS), k)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def links(points: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Star links (a < b) between distinct fingerprints ``fp`` with the components of all pairs."""
    if max_distance % 2 or max_distance < 0:
        raise ValueError("max_distance must be even: each side covers half of it")
    masks = F.array(*(F.lit(m).cast("long") for m in _masks(max_distance // 2)))
    variants = points.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    hub = F.min("fp").over(Window.partitionBy("variant"))
    return (
        variants.withColumn("a", hub)
        .filter("a <> fp")
        .select("a", F.col("fp").alias("b"))
        .distinct()
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of undirected ``edges`` (a, b); root is the same in a component.

    Contraction: each node moves to its smallest neighbour, chains are shortened by one jump, and
    the edges are renamed and de-duplicated. Every node that has an edge moves or is moved to, so
    the graph shrinks geometrically; the rounds end when no edge is left. All steps are joins and
    grouped minima; only the number of edges left comes to the driver.
    """
    left = saved(edges.select("a", "b"))
    roots: DataFrame | None = None
    while left.limit(1).count():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to"))
        nxt = step.select(F.col("a").alias("to"), F.col("to").alias("far"))
        moved = saved(step.join(nxt, "to").select(F.col("a").alias("node"), F.col("far").alias("root")))
        ends = [moved.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab"]
        shrunk = saved(
            left.join(ends[0], "a").join(ends[1], "b")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        if roots is None:
            roots = moved
        else:
            hop = moved.select(F.col("node").alias("root"), F.col("root").alias("next"))
            longer = saved(roots.join(hop, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
            discard(roots, moved)
            roots = longer
        discard(left)
        left = shrunk
    discard(left)
    return roots if roots is not None else edges.sparkSession.createDataFrame([], "node long, root long")


def classes(points: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``points``; linked ones share the root."""
    distinct = points.select("fp").distinct()
    found = components(links(distinct, max_distance)).withColumnRenamed("node", "fp")
    return distinct.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per document."""
    prints = saved(fingerprints(docs, shingle))
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = first.join(classes(prints, max_distance), "fp")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = saved(named.select("fp", "root").join(least, "root").select("fp", "component_id"))
    return prints.join(by_print, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The documents without their near-duplicates; of each component one row stays.

    It is the one with the smallest doc_id (null last), then text digest; of fully repeated
    rows one is kept. Texts are shuffled once, by their own key.
    """
    prints = saved(fingerprints(docs, shingle))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = prints.groupBy("fp").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    named = first.join(classes(prints, max_distance), "fp")
    chosen = named.groupBy("root").agg(F.min("first").alias("first"))
    keys = saved(chosen.select(F.col("first.doc_id").alias("doc_id"), F.col("first.text_key").alias("text_key")))
    rows = prints.join(keys, prints["doc_id"].eqNullSafe(keys["doc_id"]) & (prints["text_key"] == keys["text_key"]), "left_semi")
    repeated = saved(rows.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")))
    table, name = numbered(docs)
    stamped = table.withColumn("k_text", text_key(F.col(name["text"])))
    joined = stamped.join(
        repeated.select(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_key"), "n"),
        F.col(name["doc_id"]).eqNullSafe(F.col("k_id")) & (F.col("k_text") == F.col("k_key")),
    )
    columns = list(table.columns)
    single = joined.filter("n = 1").select(*columns)
    # rows repeated in full or in (doc_id, text): the smallest by the other columns' text form
    others = F.to_json(F.struct(*(F.col(c) for c in columns if c != name["text"])))
    several = (
        joined.filter("n > 1")
        .groupBy("k_id", "k_key")
        .agg(F.min_by(F.struct(*columns), others).alias("row"))
        .select("row.*")
    )
    return single.unionByName(several).toDF(*docs.columns)
