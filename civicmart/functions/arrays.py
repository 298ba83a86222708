"""Array and key/value column functions for nested catalog records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def join_tags(tags, sep: str = ", ") -> Column:
    """Tags joined with ``", "``; a null element prints ``None``; absent or empty -> ``""``."""
    return F.coalesce(F.array_join(as_col(tags), sep, "None"), F.lit(""))


def merged_pairs(*pair_arrays) -> Column:
    """Concatenate arrays of ``struct(key, value)``; a missing array counts as empty.

    Later arrays (and later elements) take precedence in :func:`last_value_of`.
    """
    parts = [F.coalesce(as_col(a), F.array()) for a in pair_arrays]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _key_is(key: str):
    # A named helper binds ``key`` per call; a default-argument lambda would be taken as
    # the two-argument (element, index) form.
    return lambda x: x["key"] == F.lit(key)


def last_value_of(pairs, key: str, default: str | None = "") -> Column:
    """Value of the last pair whose key equals ``key`` (later pairs win); ``default``
    if no pair has the key, null if the last one has a null value."""
    found = F.filter(as_col(pairs), _key_is(key))
    hit = F.try_element_at(found, F.lit(-1))["value"]
    return F.when(F.size(found) > 0, hit).otherwise(F.lit(default)) if default is not None else hit


def pick_metadata(pairs, fields: Mapping[str, str], default: str = "") -> list[Column]:
    """One column per wanted key (``{key: output_name}``), later pairs winning."""
    return [last_value_of(pairs, k, default).alias(v) for k, v in fields.items()]


def pairs_to_map(pairs) -> Column:
    """``map<key, value>`` of key/value pairs where the last pair of a key wins.

    Only the last occurrence of each key is kept before ``map_from_entries`` (which
    rejects duplicate keys under the default dedup policy), so no session setting is
    needed. Per-row work is quadratic in the (small, per-record) number of pairs.
    """
    arr = as_col(pairs)

    def is_last(x, i):
        later = F.slice(arr, i + 2, F.greatest(F.size(arr) - i - 1, F.lit(1)))
        return (i == F.size(arr) - 1) | ~F.exists(later, lambda y: y["key"] == x["key"])

    return F.map_from_entries(F.filter(arr, is_last))
