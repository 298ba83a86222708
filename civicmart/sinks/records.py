"""Row payloads: each row as one JSON record, nulls written out, and records packed into lists."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import quote


def record_column(df: DataFrame, columns: Sequence[str] | None = None):
    """``to_json(struct(...))`` with explicit nulls (``"x":null``) in column order."""
    cols = list(columns) if columns is not None else df.columns
    return F.to_json(F.struct(*[F.col(quote(c)) for c in cols]), {"ignoreNullFields": "false"})


def to_records(df: DataFrame, keep: Sequence[str] = (), out: str = "record") -> DataFrame:
    """One JSON record per row (plus any ``keep`` columns for keying/partitioning)."""
    return df.select(*[F.col(quote(k)) for k in keep], record_column(df).alias(out))


def to_payloads(records: DataFrame, max_records: int = 1_000, max_bytes: int = 1 << 20, column: str = "record") -> DataFrame:
    """JSON records packed into JSON lists for a client that takes lists: (payload, n_records, n_bytes).

    Every record is in one list, none of which has more than ``max_records`` records or
    ``max_bytes`` bytes of UTF-8; a single record that is too long fails the job. Each partition
    packs its rows as they come, in their order, with one open list in memory: no shuffle, no sort.
    Null records are left out. How rows are split between lists depends on the partitions.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        size = 2  # the brackets

        def batch_of(lists: list[tuple[str, int, int]]) -> pa.RecordBatch:
            columns = zip(*lists) if lists else ([], [], [])
            return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64()))], ["payload", "n_records", "n_bytes"])

        for batch in batches:
            for record in batch.column(0).to_pylist():
                if record is None:
                    continue
                more = len(record.encode())
                if more + 2 > max_bytes:
                    raise ValueError(f"a record of {more} bytes does not fit into a payload of {max_bytes}")
                if held and (len(held) == max_records or size + 1 + more > max_bytes):
                    yield batch_of([(f"[{','.join(held)}]", len(held), size)])
                    held, size = [], 2
                size += more + (1 if held else 0)  # a comma before all but the first
                held.append(record)
        if held:
            yield batch_of([(f"[{','.join(held)}]", len(held), size)])

    return records.select(quote(column)).mapInArrow(pack, "payload string, n_records int, n_bytes long")
