"""Resampling documents towards a target text distribution by importance weights.

Features are the runs of one and two consecutive words of a text, hashed into ``BUCKETS`` buckets.
Over all documents and over all target texts the features of each bucket are counted; a bucket's
gain is the logarithm of the two smoothed rates' ratio in whole thousandths. A document's weight is
the floored mean of its features' gains, looked up in one array, and a Gumbel draw by document id
turns the highest scores into a sample without replacement.

The cutoff is found without sorting all scores: a quantile sketch proposes a bracket around it,
exact counts of what lies above and inside validate the bracket or widen it, and only the bracket
is sorted for the row where the draw ends. Where ranks are asked for, the drawn rows are range-
partitioned in order, and a count per range gives each its first rank.

A bigram's checksum comes from its words' checksums: appending bytes is linear over the bits, so
a checksum moved on by a word's length, combined with that word's own, is that of both. Words'
checksums are remembered (bounded; it only saves time).

Defined results: null and empty texts have no features and weight 0; a null doc_id draws as an
empty one and comes last among equal scores; rows tied in all columns take ranks in any order (they
are equal), rows of one doc_id and score go by weight, then n_features; repeated rows count and
rank each by itself; an empty table or target is scored as such (its counts are zero); other
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import in_order, pick, saved

BUCKETS = 10_000
#: Documents of fewer words are not drawn.
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: Share of the rows on either side of the sketch's quantile that the first bracket takes in.
MARGIN = 0.001
ACCURACY = 10_000

#: Byte to byte: ASCII letters in lower case, digits and all bytes of other characters as they are, the rest a space.
_CLEAN = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 0x20 for b in range(256))
#: Longest word whose moves are in the table; longer ones are checksummed directly.
LONGEST = 64
#: Bytes of a text handled at a time, and words remembered.
PIECE, REMEMBERED = 1 << 20, 1 << 19


def _moves() -> np.ndarray:
    """Checksum moved on by n bytes, by n, byte of the checksum and that byte's value."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, one >> 1 ^ np.uint32(0xEDB88320), one >> 1)
    state = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = [state]
    for _ in range(LONGEST):
        state = state >> 8 ^ one[state & 255]
        out.append(state)
    return np.array(out)


MOVES = _moves()


def moved(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Checksums moved on by so many bytes (up to LONGEST)."""
    out = MOVES[by, 0, crc & 255]
    for j in (1, 2, 3):
        out = out ^ MOVES[by, j, crc >> (8 * j) & 255]
    return out


class _Words(dict):
    """Word to its checksum and length in one number, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = packed = len(word) << 32 | zlib.crc32(word)
        return packed


def word_pieces(data: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, lower-cased, a piece of it at a time."""
    clean, at = data.translate(_CLEAN), 0
    while at < len(clean):
        end = clean.find(b" ", at + size) if at + size < len(clean) else -1
        end = len(clean) if end < 0 else end
        words = clean[at:end].split()
        if words:
            yield words
        at = end


def buckets_of(data: bytes, words: _Words, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of the features) for pieces of a text; a pair of words across two
    pieces belongs to the later one."""
    before = None
    for found in word_pieces(data):
        packed = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
        crc, size = (packed & 0xFFFFFFFF).astype(np.uint32), packed >> 32
        first = (crc if before is None else np.concatenate([[before], crc]))[:-1]
        skip = len(crc) - len(first)  # the first word of a text ends no pair
        second, length = crc[skip:], size[skip:]
        spaced = moved(first, np.ones(len(first), np.int64)) ^ np.uint32(zlib.crc32(b" "))
        pair = moved(spaced, np.minimum(length, LONGEST)) ^ second
        for i in np.flatnonzero(length > LONGEST):
            pair[i] = zlib.crc32(found[skip + i], int(spaced[i]))
        before = crc[-1]
        yield len(found), np.concatenate([crc, pair]) % np.uint32(buckets)


def feature_counts(texts: DataFrame, column: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket. A task sends one row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, words = np.zeros(buckets, np.int64), _Words()
        for batch in batches:
            for text in batch.column(0):
                for _, found in buckets_of((text.as_py() or "").encode(), words, buckets):
                    counts += np.bincount(found, minlength=buckets)
        own = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(own, pa.int32()), pa.array(counts[own], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in pick(texts, column).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of every bucket in whole thousandths, from its features in the source and the target."""
    buckets, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    top, below = float(all_s + buckets), float(all_t + buckets)
    return np.array([math.floor(1000 * math.log((float(t + 1) * top) / (float(s + 1) * below))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigher(gain: np.ndarray):
    """Column function: text to a struct of n_words, n_features and weight."""

    @pandas_udf("struct<n_words: long, n_features: long, weight: long>")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = _Words()
        for texts in batches:
            rows = []
            for text in texts:
                n_words = n = total = 0
                for more, found in buckets_of((text or "").encode(), words, len(gain)):
                    n_words, n, total = n_words + more, n + len(found), total + int(gain[found].sum())
                rows.append((n_words, n, total // n if n else 0))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "weight"], dtype="int64")

    return weigh


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return pick(docs, "doc_id", "text").select("doc_id", weigher(gain)("text").alias("w"), gumbel.alias("gumbel")).select(
        "doc_id", "w.n_words", "w.n_features", "w.weight", (F.col("w.weight") + F.col("gumbel")).alias("score")
    )


#: Order of the draw: the highest scores first; ``row`` tells rows apart that are equal otherwise.
ORDER = ("score", "doc_id", "weight", "n_features", "row")


def _order():
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), *(F.col(c) for c in ORDER[2:])]


def bracket(scores: DataFrame, take: int, n: int) -> tuple[int, int, int]:
    """(low, high, above): the draw of ``take`` of ``n`` rows ends at a score from low to high, and
    ``above`` rows score over high. The sketch's quantiles propose, exact counts decide."""
    margin = MARGIN
    while True:
        places = [max(0.0, 1 - take / n - margin), min(1.0, 1 - take / n + margin)]
        low, high = scores.agg(F.percentile_approx("score", places, ACCURACY)).first()[0]
        if places[0] == 0 and places[1] == 1:  # the whole range
            low, high = scores.agg(F.min("score"), F.max("score")).first()
        is_above, inside = F.col("score") > high, F.col("score").between(low, high)
        above, within = scores.agg(F.count_if(is_above), F.count_if(inside)).first()
        if above < take <= above + within:
            return low, high, above
        margin = min(1.0, margin * 8)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, row, drawn) of every document: ``percent`` of those
    with ``min_words`` words are drawn towards the texts of ``target``."""
    gain = gains(feature_counts(docs, buckets=buckets), feature_counts(target, buckets=buckets))
    rows = saved(scored(docs, gain, seed).withColumn("row", F.monotonically_increasing_id()))
    able = rows.filter(F.col("n_words") >= min_words)
    n = able.count()
    take = percent * n // 100
    if not take:
        return rows.withColumn("drawn", F.lit(False))
    low, high, above = bracket(able, take, n)
    last = in_order(able.filter(F.col("score").between(low, high)).select(*ORDER), _order()).filter(F.col("rank") == take - above).first()
    # in the draw's order up to the last row
    upto = F.lit(True)
    for c in reversed(ORDER[1:]):
        here = F.lit(last[c])
        if c == "doc_id":
            less = F.col(c).isNotNull() if last[c] is None else F.coalesce(F.col(c) < here, F.lit(False))
            upto = less | (F.col(c).eqNullSafe(here) & upto)
        else:
            upto = (F.col(c) < here) | ((F.col(c) == here) & upto)
    ahead = (F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & upto)
    return rows.withColumn("drawn", (F.col("n_words") >= min_words) & ahead)


def with_ranks(rows: DataFrame) -> DataFrame:
    """``resample``'s rows with ``rank`` (1, 2, 3... among the drawn, null for the rest)."""
    drawn = in_order(rows.filter("drawn"), _order())
    return drawn.unionByName(rows.filter(~F.col("drawn")).withColumn("rank", F.lit(None).cast("long")))
