"""Substring dedup by hashing lines, and passages inside lines that differ otherwise.

Units are compared in normal form: words joined by single spaces, A-Z lower-cased. Every line with a
word is a unit (of ``min_words`` or more, if asked for). Lines alone miss a passage that was pasted into the middle of a line, so every run of ``window`` words is a
unit too, wherever line breaks fall: a later copy of ``window`` words or more goes from its first
word to its last. Digests are grouped over all documents; the earliest ranked occurrence of a unit
stays where it is and all others are cut out, with their original offsets retained. The rank is
doc_id (null last), then text digest, then place in the text.

Runs are compared in two steps, to shuffle fewer rows. Of the shorter runs of ``window // 3``
words inside each run the one with the least hash is its anchor; neighbouring runs of one anchor
are a cell. Equal runs have equal anchors, so cells whose anchor is found once hold nothing that recurs.
A cell that an earlier document has word for word goes as a whole, and its runs need no comparison: the
cell's first occurrence stands for them. The runs of all other cells are compared one by one. An
anchor shared by chance costs time and changes no result. The first_doc_id of a cut is the first
document with its first run, or with that run's cell.

A text is known by its doc_id and, only where a doc_id has several texts, by their place in the
order of text digests, so that the many rows of units carry no digest of the text they are from.

Defined results: null and empty texts have no units and come back as they are; rows that repeat
both doc_id and text are one document and come back alike; an empty table gives an empty result;
columns other than doc_id and text pass through unchanged, whatever their names. A word goes if a run
that covers it stands in an earlier document. In a text that repeats itself, words of a run that
stays are not cut by a run whose first occurrence is in the same text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import SPACES, discard, in_order, numbered, pick, saved

MIN_WORDS = 1
#: Words in a run.
WINDOW = 25
#: Powers remembered by a task; it only saves time.
REMEMBERED = 1 << 20


def line_units(text: str | None, min_words: int = MIN_WORDS) -> list[tuple[int, bytes]]:
    """(line number from 0, 16-byte digest) of the units of one text."""
    found = []
    for i, line in enumerate((text or "").split("\n")):
        words = line.encode().lower().split()
        if len(words) >= min_words:
            found.append((i, hashlib.blake2b(b" ".join(words), digest_size=16).digest()))
    return found


def _joined(texts: list[str | None]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The normal forms of some texts, joined by spaces; where in it all words start and end; and which
    word is the first of each text (and one past the last)."""
    split = [(t or "").encode().lower().split() for t in texts]
    firsts = np.concatenate([[0], np.cumsum([len(w) for w in split], dtype=np.int64)])
    joined = b" ".join([b" ".join(w) for w in split if w])
    if not joined:
        return b"", np.zeros(0, np.int64), np.zeros(0, np.int64), firsts
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    return joined, np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(joined)]]), firsts


def _digests(joined: bytes, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    digest = xxhash.xxh3_128_digest
    return [digest(joined[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]


def passage_units(text: str | None, window: int = WINDOW, places: list[int] | None = None) -> list[tuple[int, bytes]]:
    """(word number from 0, 16-byte digest) of all runs of one text, or of those that begin at ``places``."""
    joined, starts, ends, _ = _joined([text])
    at = np.arange(max(len(starts) - window + 1, 0)) if places is None else np.asarray(places, np.int64)
    return list(zip(at.tolist(), _digests(joined, starts[at], ends[at + window - 1])))


#: A number for every byte value, and the base of the hashes of byte ranges (odd, so it has an inverse).
_BYTE = np.frombuffer(b"".join(xxhash.xxh3_64_digest(bytes([b])) for b in range(256)), np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of a base, remembered up to REMEMBERED of them."""
    if n > len(_POWERS[base]):
        found = np.full(max(n, min(2 * n, REMEMBERED)), base, np.uint64)
        found[0] = 1
        np.multiply.accumulate(found, out=found)
        if n > REMEMBERED:
            return found[:n]
        _POWERS[base] = found
    return _POWERS[base][:n]


def _range_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte range, from one running sum over the bytes; used to choose anchors, where a
    collision costs time only."""
    terms = _BYTE[np.frombuffer(data, np.uint8)] * _powers(_BASE, len(data))
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    out = (before[ends] - before[starts]) * _powers(_INVERSE, len(data))[starts]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ out >> np.uint64(32)


def cells_of(texts: list[str | None], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """The cells of some texts: number of the text, first run, number of runs, digest of all words, and
    the anchor's hash as a signed number."""
    short = max(1, window // 3)
    joined, starts, ends, firsts = _joined(texts)
    if len(starts) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, [], none
    order = _range_hashes(joined, starts[: len(starts) - short + 1], ends[short - 1 :])
    text = np.repeat(np.arange(len(texts)), np.diff(firsts))
    runs = np.flatnonzero(text[: len(text) - window + 1] == text[window - 1 :])  # those within one text
    anchor = np.lib.stride_tricks.sliding_window_view(order, window - short + 1).argmin(axis=1)[runs] + runs
    new = np.ones(len(runs), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    at = np.flatnonzero(new)
    first, n = runs[at], np.diff(np.append(at, len(runs)))
    owner = text[first]
    return owner, first - firsts[owner], n, _digests(joined, starts[first], ends[first + n + window - 2]), order[anchor[at]].view(np.int64)


def cells(text: str | None, window: int = WINDOW) -> tuple[list[int], list[int], list[bytes], list[int]]:
    """First run, number of runs, digest of all words, and the anchor's hash, of the cells of one text."""
    _, first, n, whole, anchor = cells_of([text], window)
    return first.tolist(), n.tolist(), whole, anchor.tolist()


_SPACE = np.zeros(128, bool)
_SPACE[[ord(c) for c in SPACES]] = True


def _places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end, in characters."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    outside = np.ones(len(codes) + 2, bool)
    outside[1:-1] = _SPACE[np.minimum(codes, 127)]
    edges = np.flatnonzero(outside[1:] != outside[:-1])
    return edges[::2], edges[1::2]


def cut_units(
    text: str, lines: dict[int, int | None], runs: list[tuple[int, int | None]], kept: list[int], window: int = WINDOW,
    sure: list[tuple[int, int | None]] = [],
) -> tuple[str, list[tuple[int, int, int, int | None]]]:
    """The text without some units, and (line, start, end, first_doc_id) of each cut: offsets in the original.

    ``lines`` are line numbers, ``runs`` the first word numbers of runs, both with the document
    that has them first; ``kept`` are first words of runs that stay, against ``runs``; those in
    ``sure``, which earlier documents have, go whatever stays. A run is cut line by line; a line
    that has lost all its words goes.
    """
    starts, ends = _places(text) if runs or sure else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    source = np.full(len(starts), -1, np.int64)
    for k in range(len(runs) - 1, -1, -1):
        source[runs[k][0] : runs[k][0] + window] = k
    for at in kept:
        source[at : at + window] = -1
    for k in range(len(sure) - 1, -1, -1):
        source[sure[k][0] : sure[k][0] + window] = len(runs) + k
    runs = [*runs, *sure]
    left, spans, at, w = [], [], 0, 0
    parts = text.split("\n")
    after_line = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in parts]) - 1).tolist()
    for i, line in enumerate(parts):
        end, first, w = at + len(line), w, after_line[i]
        if i in lines:
            spans.append((i, at, end, lines[i]))
        elif w == first or (source[first:w] < 0).all():
            left.append(line)
        else:
            gone = source[first:w] >= 0
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).tolist()
            rest, after = "", at
            for a, b in zip(edges[::2], edges[1::2]):
                start, stop = int(starts[first + a]), int(ends[first + b - 1])
                spans.append((i, start, stop, runs[source[first + a]][1]))
                # white space on both sides of a cut: that in front goes
                rest += text[after:start].rstrip(SPACES)
                after = stop
            if not gone.all():
                left.append((rest + text[after:end]) if rest else text[after:end].lstrip(SPACES))
        at = end + 1
    return "\n".join(left), spans


def _key(text: Column) -> Column:
    """A text's digest as 16 bytes, half of its hex form; null for a null text, which has no units."""
    return F.unhex(F.md5(text))


def several_texts(docs: DataFrame) -> DataFrame | None:
    """(m_id, m_key, m_nth) of the texts of doc_ids that have several; None if no doc_id does."""
    keys = pick(docs, "doc_id", "text").filter("text IS NOT NULL").select("doc_id", _key(F.col("text")).alias("key"))
    ids = saved(keys.groupBy("doc_id").agg(F.min("key").alias("least"), F.max("key").alias("most")).filter("least <> most").select(F.col("doc_id").alias("m_id")))
    if ids.isEmpty():
        return None
    own = keys.join(ids, F.col("doc_id").eqNullSafe(F.col("m_id")), "left_semi").distinct()
    order = [F.col("doc_id").asc_nulls_last(), F.col("key")]
    return saved(in_order(own, order, "m_nth").toDF("m_id", "m_key", "m_nth"))


def _numbered(rows: DataFrame, several: DataFrame | None, doc_id: str, text: str) -> DataFrame:
    """``rows`` with ``nth``, which tells the texts of one doc_id apart, in the order of their digests; null for a null text."""
    only = F.when(F.col(text).isNotNull(), F.lit(0).cast("long"))
    if several is None:
        return rows.withColumn("nth", only)
    same = F.col(doc_id).eqNullSafe(F.col("m_id")) & (_key(F.col(text)) == F.col("m_key"))
    return rows.join(several, same, "left").withColumn("nth", F.coalesce("m_nth", only)).drop("m_id", "m_key", "m_nth")


def _rank() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "nth", "at")


def _in_first() -> Column:
    """Whether the earliest occurrence is in the same text."""
    return F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("nth") == F.col("first.nth"))


def _halves(digests: list[bytes]) -> np.ndarray:
    """16-byte digests as two signed numbers each: (n, 2)."""
    return np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)


def _table(batch: pa.RecordBatch, owner: np.ndarray, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """Rows of a result: the text each belongs to, and their columns."""
    rows = pa.array(owner, pa.int32())
    return pa.record_batch([batch.column("doc_id").take(rows), batch.column("nth").take(rows), *columns.values()], ["doc_id", "nth", *columns])


def units(texts: DataFrame, min_words: int = MIN_WORDS, window: int | None = WINDOW) -> DataFrame:
    """(doc_id, nth, at, n, d1, d2, anchor): one row per line unit and per cell of runs; d1 and d2 are the digest.

    Lines have a line number at ``at``, and no ``n`` and anchor; cells their first word and number of runs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("text").to_pylist()
            by_line = [line_units(t, min_words) for t in held]
            lines = [u for found in by_line for u in found]
            owner = np.repeat(np.arange(len(held)), [len(found) for found in by_line])
            columns = [np.array([i for i, _ in lines], np.int64), np.zeros(len(lines), np.int64), _halves([d for _, d in lines]), np.zeros(len(lines), np.int64)]
            yield _table(batch, owner, unit_columns(*columns, np.ones(len(lines), bool)))
            if window:
                owner, first, n, whole, anchor = cells_of(held, window)
                yield _table(batch, owner, unit_columns(first, n, _halves(whole), anchor, np.zeros(len(whole), bool)))

    def unit_columns(at, n, digest, anchor, null) -> dict[str, pa.Array]:
        return {
            "at": pa.array(at, pa.int32()), "n": pa.array(n, pa.int32(), mask=null),
            "d1": pa.array(digest[:, 0]), "d2": pa.array(digest[:, 1]), "anchor": pa.array(anchor, pa.int64(), mask=null),
        }

    kind = dict(texts.dtypes)["doc_id"]
    return texts.mapInArrow(run, f"doc_id {kind}, nth long, at int, n int, d1 long, d2 long, anchor long")


def repeats(found: DataFrame, again: Column | None = None, how: str = "inner") -> DataFrame:
    """``found`` with ``first``, the rank of the earliest occurrence, where a digest is found twice or more or ``again`` is true; left: all rows.

    The group keeps ranks only, combined before the shuffle, so a line that a third
    of the documents share costs no more than any other; the join back splits such a digest
    over many tasks (it joins two tables read from files, both shuffled for it).
    """
    groups = found.groupBy("d1", "d2").agg(F.min(_rank()).alias("first"), F.max(_rank()).alias("last"), F.max(F.lit(False) if again is None else again).alias("again"))
    return found.join(saved(groups.filter("again OR first <> last").select("d1", "d2", "first")), ["d1", "d2"], how).drop("d1", "d2")


def repeated_runs(texts: DataFrame, marks: DataFrame, window: int) -> DataFrame:
    """(doc_id, nth, at, n, first_doc_id, stays, own): the runs found twice or more, ``n`` in a row from ``at``.

    ``stays``: it is the earliest; ``own``: the earliest is in the same text. ``marks`` is deleted
    when its cells have been read, to make room on disk.
    """
    several = saved(marks.groupBy("anchor").agg(F.count(F.lit(1)).alias("rows")).filter("anchor IS NOT NULL AND rows > 1").select("anchor"))
    open_ = saved(marks.filter("anchor IS NOT NULL").join(several.hint("shuffle_hash"), "anchor").drop("anchor"))
    discard(marks, several)
    known = saved(repeats(open_, how="left").withColumn("own", F.col("first").isNull() | _in_first()))
    discard(open_)
    # a cell of an earlier document goes as it is; of all others the runs are compared
    gone = known.filter("NOT own").select("doc_id", "nth", "at", "n", F.col("first.doc_id").alias("first_doc_id"), F.lit(False).alias("stays"), "own")
    held = (
        known.filter("own").groupBy("doc_id", "nth")
        .agg(F.collect_set(F.struct("at", "n", F.col("first").isNotNull().alias("again"))).alias("cells"))
        .withColumnsRenamed({"doc_id": "k_id", "nth": "k_nth"})
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("cells")
            found, per_text = column.flatten(), column.value_lengths().to_numpy()
            at, n, again = (found.field(c).to_numpy(zero_copy_only=False) for c in ("at", "n", "again"))
            cell = np.repeat(np.arange(len(at)), n)
            place = np.arange(len(cell)) - (np.cumsum(n) - n)[cell] + at[cell]
            owner = np.repeat(np.arange(len(per_text)), per_text)[cell]
            joined, starts, ends, firsts = _joined(batch.column("text").to_pylist())
            word = firsts[owner] + place
            half = _halves(_digests(joined, starts[word], ends[word + window - 1]))
            yield _table(batch, owner, {"at": pa.array(place, pa.int32()), "d1": pa.array(half[:, 0]), "d2": pa.array(half[:, 1]), "again": pa.array(again[cell], pa.bool_())})

    kind = dict(texts.dtypes)["doc_id"]
    single = saved(
        texts.join(saved(held).hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("nth") == F.col("k_nth")))
        .select("doc_id", "nth", "text", "cells")
        .mapInArrow(run, f"doc_id {kind}, nth long, at int, d1 long, d2 long, again boolean")
    )
    # a run in a cell that is repeated is found again, also where the copies are gone as cells
    compared = repeats(single, F.col("again")).select(
        "doc_id", "nth", "at", F.lit(1).alias("n"), F.col("first.doc_id").alias("first_doc_id"), (_rank() == F.col("first")).alias("stays"), _in_first().alias("own")
    )
    return compared.unionByName(gone)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, window: int | None = WINDOW) -> DataFrame:
    """The documents with repeated units cut out of ``text``, and two further columns.

    n_removed (long) and removed (array of line, start, end, first_doc_id; in text order, null if
    none): start and end are character offsets in the original text; neighbouring runs are one
    cut, with the document that has the first of them. If the input has columns of these names
    already, refer to the new ones by position: they are the last two. ``window`` None: lines only.
    """
    several = several_texts(docs)
    texts = _numbered(pick(docs, "doc_id", "text"), several, "doc_id", "text")
    marks = saved(units(texts, min_words, window))
    found = (
        repeats(saved(marks.filter("anchor IS NULL").drop("n", "anchor"))).filter(_rank() != F.col("first"))
        .select(F.lit(False).alias("run"), "doc_id", "nth", "at", F.lit(1).alias("n"), F.col("first.doc_id").alias("first_doc_id"), F.lit(False).alias("stays"), F.lit(False).alias("own"))
    )
    if window:
        found = found.unionByName(repeated_runs(texts, marks, window).withColumn("run", F.lit(True)))
    per_text = (
        found.groupBy("doc_id", "nth")
        .agg(F.sort_array(F.collect_set(F.struct("run", "at", "n", "first_doc_id", "stays", "own"))).alias("cut"))
        .filter(F.exists("cut", lambda c: ~c["stays"]))
        .withColumnsRenamed({"doc_id": "k_id", "nth": "k_nth"})
    )
    cuts = saved(per_text)
    discard(per_text)  # the tables that it was made of
    table, name = numbered(docs)
    text = F.col(name["text"])
    keyed = _numbered(table, several, name["doc_id"], name["text"])
    joined = keyed.join(cuts.hint("shuffle_hash"), F.col(name["doc_id"]).eqNullSafe(F.col("k_id")) & (F.col("nth") == F.col("k_nth")), "left")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    some = lambda keep, field: F.transform(F.filter("cut", keep), lambda c: c[field])
    line, run, sure = lambda c: ~c["run"], lambda c: c["run"] & c["own"] & ~c["stays"], lambda c: c["run"] & ~c["own"]

    @pandas_udf("struct<text: string, spans: array<struct<line: int, start: long, end: long, by: int>>>")
    def cut(texts: pd.Series, lines: pd.Series, runs: pd.Series, kept: pd.Series, sure: pd.Series, times: pd.Series) -> pd.DataFrame:
        done, spans = [], []
        for t, at_lines, at_runs, stay, at_sure, n_sure in zip(texts, lines, runs, kept, sure, times):
            if at_lines is None:
                done.append(None)
                spans.append(None)
                continue
            # a cut is known by its place in lines, then runs, then sure ones; the ids stay in Spark
            by_line = {int(x): k for k, x in enumerate(at_lines)}
            n, m = len(by_line), len(by_line) + len(at_runs)
            own = [(int(x), k) for k, x in enumerate(at_runs, n)]
            others = [(p, k) for k, (x, runs_here) in enumerate(zip(at_sure, n_sure), m) for p in range(int(x), int(x + runs_here))]
            t, found = cut_units(t, by_line, own, list(stay), window or 0, others)
            done.append(t)
            spans.append([{"line": i, "start": a, "end": b, "by": k} for i, a, b, k in found])
        return pd.DataFrame({"text": pd.Series(done, dtype=object), "spans": pd.Series(spans, dtype=object)})

    # texts that lose nothing are not sent to Python
    affected = F.when(F.col("cut").isNotNull(), text)
    after = joined.withColumn("after", cut(affected, some(line, "at"), some(run, "at"), some(lambda c: c["stays"], "at"), some(sure, "at"), some(sure, "n"))).withColumn(
        "firsts", F.concat(some(line, "first_doc_id"), some(run, "first_doc_id"), some(sure, "first_doc_id"))
    )
    removed = F.transform(
        "after.spans",
        lambda s: F.struct(s["line"].alias("line"), s["start"].alias("start"), s["end"].alias("end"), F.get("firsts", s["by"]).cast(id_type).alias("first_doc_id")),
    )
    none = F.col("cut").isNull() | (F.size("after.spans") == 0)
    columns = [F.coalesce("after.text", text) if c == name["text"] else F.col(c) for c in table.columns]
    n_removed = F.when(none, F.lit(0).cast("long")).otherwise(F.size("after.spans").cast("long"))
    return after.select(*columns, n_removed, F.when(~none, removed)).toDF(*docs.columns, "n_removed", "removed")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, window: int | None = WINDOW) -> DataFrame:
    """The documents with repeated units cut out, columns as they were.

    A column ``n_chars`` follows the text it counts. A document that loses all its words stays,
    with an empty text.
    """
    done, name = numbered(dedup_lines(docs, min_words, window))
    columns = list(docs.columns)
    own = done.columns[: len(columns)]
    if "n_chars" in columns:
        at = columns.index("n_chars")
        own[at] = F.when(F.col(done.columns[-2]) > 0, F.length(own[columns.index("text")]).cast(done.schema[own[at]].dataType)).otherwise(F.col(own[at])).alias("n")
    return done.select(*own).toDF(*columns)
