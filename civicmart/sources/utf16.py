"""Tab-separated UTF-16 reports of any size, read in byte ranges by many tasks.

Spark's own reader takes such a file in one task, since rows cannot be told by bytes alone: the two
bytes of a line feed may stand across two other characters, and a quoted field may hold line feeds.
Here the text source cuts the file's ranges at those two bytes, in parallel, and two passes decide
which cuts are row ends:

1. every range reports, for either alignment that it may start at, how many bytes and quotes it
   holds; carried forward over the ranges in order, that gives each range's true start: on a
   character or inside one, outside quotes or inside;
2. every range joins its lines into rows from that start. A row that crosses ranges leaves a
   fragment in each; the fragments, at most two a range, are put together by a grouped join.

Rows then go through Spark's CSV expression with the options of the one-task reader.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions._util import quote
from ..storage import Store

#: Bytes of a file's start that are looked at for its byte order and header; doubled while the header is longer.
PROBE_BYTES = 1 << 16
CODECS = {"UTF-16LE": (b"\xff\xfe", b"\n\x00"), "UTF-16BE": (b"\xfe\xff", b"\x00\n")}
State = tuple[int, int]  # a range's start: 1 if inside a character, 1 if inside quotes


def _probe(store: Store, path: str) -> tuple[str, list[str]] | None:
    """Byte order and header names of a file; None if it is empty. Without a mark it is big-endian."""
    size = PROBE_BYTES
    while True:
        data = store.first_bytes(path, size)
        codec = "UTF-16LE" if data.startswith(CODECS["UTF-16LE"][0]) else "UTF-16BE"
        text = data[: len(data) // 2 * 2].decode(codec, "replace").removeprefix("﻿")
        head = text
        while head.count('"', 0, (end := head.find("\n"))) % 2 and end >= 0:  # a line feed inside quotes
            head = head[:end] + "\r" + head[end + 1 :]
        if end >= 0 or len(data) < size:
            if not text.strip("\r\n"):
                return None
            return codec, next(csv.reader(io.StringIO(text if end < 0 else text[:end].rstrip("\r")), delimiter="\t"))
        size *= 2


def _lines(spark: SparkSession, files: list[str], codec: str) -> DataFrame:
    """(file, at, line): the ranges' lines in order, as bytes, cut at the bytes of a line feed; a file
    is known by its path's hash."""
    return spark.read.option("encoding", codec).option("lineSep", "\n").text(files).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.col("value").cast("binary").alias("line")
    )


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """The batches' lines, a range at a time."""
    for batch in batches:
        file, at = (batch.column(i).to_numpy() for i in (0, 1))
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (at[1:] != at[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(batch)]):
            if b > a:
                yield (int(file[a]), int(at[a])), batch.column(2).slice(a, b - a)


def _bounds(lines: pa.Array) -> np.ndarray:
    """Where each line starts in the bytes of all, and where the last one ends."""
    return np.frombuffer(lines.buffers()[1], np.int32, len(lines) + 1, lines.offset * 4).astype(np.int64)


def _quotes(line: bytes, inside: int, codec: str) -> int:
    """Quotes of a line that starts inside a character or on one. A character across a cut is none."""
    body = line[inside:]
    return body[: len(body) // 2 * 2].decode(codec, "replace").count('"')


def _quotes_each(lines: pa.Array, codec: str) -> np.ndarray | None:
    """Quotes of each of some lines that start on a character; None if one ends inside a character."""
    bounds = _bounds(lines)
    if (np.diff(bounds) % 2).any():
        return None
    units = np.frombuffer(lines.buffers()[2] or b"", "<u2" if codec == "UTF-16LE" else ">u2", (bounds[-1] - bounds[0]) // 2, bounds[0])
    before = np.concatenate([[0], np.cumsum(units == ord('"'))])
    return np.diff(before[(bounds - bounds[0]) // 2])


def range_starts(lines: DataFrame, codec: str) -> tuple[dict[tuple[int, int], State], bool]:
    """Start of every range, and whether any row crosses ranges or is open at a file's end. A row a
    range comes to the driver, which holds as many ranges to plan the scan."""

    def counted(exact: bool) -> list:
        """(file, at, odd, quotes, quotes_inside) of the ranges. Not exact: ``odd`` tells whether any line
        ends inside a character, and the quotes hold where none of any range does."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[tuple[int, int], list[int]] = {}
            for key, part in _by_range(batches):
                t = totals.setdefault(key, [0, 0, 0])
                if not exact:
                    each = _quotes_each(part, codec)
                    t[0], t[1] = (t[0], t[1] + int(each.sum())) if each is not None else (1, 0)
                    continue
                for line in part.to_pylist():
                    t[1] += _quotes(line, t[0], codec)
                    t[2] += _quotes(line, 1 - t[0], codec)
                    t[0] = (t[0] + len(line)) % 2
            rows = [(*key, *t) for key, t in totals.items()]
            yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], ["file", "at", "odd", "quotes", "quotes_inside"])

        return sorted(lines.mapInArrow(run, "file long, at long, odd long, quotes long, quotes_inside long").collect())

    ranges = counted(exact=False)
    if any(r["odd"] for r in ranges):
        ranges = counted(exact=True)
    starts: dict[tuple[int, int], State] = {}
    before, state, crossing = None, (0, 0), False
    for r in ranges:
        inside, quoted = state = state if r["file"] == before else (0, 0)
        starts[r["file"], r["at"]] = state
        state = (inside + r["odd"]) % 2, (quoted + r["quotes_inside" if inside else "quotes"]) % 2
        before, crossing = r["file"], crossing or state != (0, 0)
    return starts, crossing


def _rows(lines: DataFrame, codec: str, starts: dict[tuple[int, int], State], fragments: bool) -> DataFrame:
    """Whole rows (``row``, bytes) of the ranges, or the fragments (file, at, part, closed, row) they leave."""
    feed = CODECS[codec][1]
    names = ["file", "at", "part", "closed", "row"] if fragments else ["row"]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()) if fragments else (pa.binary(),)

    def out(rows: list) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * len(kinds)
        return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, inside, quoted, entered, header = None, [], 0, 0, False, False
        for key, part in _by_range(batches):
            found: list = []
            if key != here:
                if held and fragments:
                    found.append((*here, 1, False, feed.join(held)))
                if key not in starts:
                    raise RuntimeError("the file's ranges changed after its row ends were found: read it again")
                here, held, (inside, quoted) = key, [], starts[key]
                entered, header = bool(inside or quoted), key[1] == 0  # the first row began in an earlier range; is the header
            each = _quotes_each(part, codec)
            if each is not None and not (held or inside or quoted or header) and not (each % 2).any():
                if not fragments:  # every line is a row
                    yield pa.record_batch([part], names)
                continue
            for line in part.to_pylist():
                held.append(line)
                quoted = (quoted + _quotes(line, inside, codec)) % 2
                inside = (inside + len(line)) % 2
                if not (inside or quoted):
                    if entered is fragments and not header:
                        found.append((*key, 0, True, feed.join(held)) if fragments else (feed.join(held),))
                    held, entered, header = [], False, False
            yield out(found)
        yield out([(*here, 1, False, feed.join(held))] if held and fragments else [])

    return lines.mapInArrow(run, "file long, at long, part int, closed boolean, row binary" if fragments else "row binary")


def _crossing(lines: DataFrame, codec: str, starts: dict[tuple[str, int], State]) -> DataFrame:
    """Rows that cross ranges, from their fragments: a row goes from an open fragment to the next closed one."""
    feed = CODECS[codec][1]
    order = Window.partitionBy("file").orderBy("at", "part")  # two fragments a range at most
    ended = F.coalesce(F.sum(F.col("closed").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = _rows(lines, codec, starts, fragments=True).withColumn("nth", ended)
    joined = F.array_sort(F.collect_list(F.struct("at", "part", "row")))
    rest = F.slice(joined, F.lit(2), F.size(joined) - 1)
    return pieces.groupBy("file", "nth").agg(F.aggregate(rest, joined[0]["row"], lambda a, x: F.concat(a, F.lit(feed), x["row"])).alias("row"))


def read_utf16_tsv_ranges(spark: SparkSession, path, schema: StructType | str | None = None) -> DataFrame:
    """A tab-separated UTF-16 report (a file, folder or list) with a header row, read by many tasks.

    The rows of :func:`civicmart.sources.files.read_utf16_tsv`: quoted fields may hold tabs, line
    feeds and doubled quotes, blank lines are skipped, a malformed row fails. All files must have the
    schema's names as header (or without a schema one and the same: all columns are strings then).
    """
    files = [unquote(f) for f in spark.read.format("binaryFile").load(path).inputFiles()]
    store = Store(spark)
    probed = {f: _probe(store, f) for f in files}
    headers = [p[1] for p in probed.values() if p]
    if not headers and schema is None:
        raise ValueError(f"no header in {path}")
    names = [f.name for f in (StructType.fromDDL(schema) if isinstance(schema, str) else schema)] if schema is not None else headers[0]
    for header in headers:
        if [n.lower() for n in header] != [n.lower() for n in names]:
            raise ValueError(f"header {header} is not {names}")
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema or StructType([StructField(n, StringType()) for n in names])
    parts = []
    for codec in CODECS:
        own = [f for f, p in probed.items() if p and p[0] == codec]
        if not own:
            continue
        lines = _lines(spark, own, codec)
        starts, crossing = range_starts(lines, codec)
        text = F.decode("row", codec)
        line = F.when(F.endswith(text, F.lit("\r")), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
        blank = F.col("row").isin(F.lit(b""), F.lit("\r".encode(codec)))
        found = [_rows(lines, codec, starts, fragments=False), *([_crossing(lines, codec, starts)] if crossing else [])]
        parts += [f.where(~blank).select(line.alias("row")) for f in found]
    if not parts:
        return spark.createDataFrame([], fields)
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    options = {"sep": "\t", "quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}
    ddl = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in fields)
    return rows.select(F.from_csv("row", ddl, options).alias("r")).select("r.*")
