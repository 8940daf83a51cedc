"""Delimited text forms of records, and small scalar helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the wire format.
PAIR_SEP = "[[:]]"
ENTRY_SEP = "[[--]]"
FRAME_SEP = "|| "

ENTRY_RE = r"\[\[--\]\]"


def is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def last_win_map(entries: Column) -> Column:
    """Array of ``struct(key, value)`` to a map; of equal keys the last entry wins, keys sorted.

    Needs no session setting: duplicates are removed by one sort before the map is built.
    """
    keyed = F.sort_array(
        F.transform(
            entries,
            lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), e["value"].alias("value")),
        )
    )

    def build(s: Column) -> Column:
        last_of_key = F.filter(
            s, lambda e, i: F.coalesce(F.get(s, i + 1)["key"] != e["key"], F.lit(True))
        )
        return F.map_from_entries(
            F.transform(last_of_key, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
        )

    return let(keyed, build)


def encode_map(m: Column) -> Column:
    """Map to ``k[[:]]v[[--]]k[[:]]v``, keys sorted, null values as empty text.

    The separators of this wire format are not escaped: a key or value that holds one reads as several entries.
    """
    pairs = F.transform(
        F.sort_array(F.map_entries(m)),
        lambda e: F.concat(e["key"], F.lit(PAIR_SEP), F.coalesce(e["value"], F.lit(""))),
    )
    return F.array_join(pairs, ENTRY_SEP)


def after_first(s: Column, separator: str) -> Column:
    """The text after the first ``separator``; null if there is none. No pattern is compiled."""
    at = F.instr(s, separator)
    return F.when(at > 0, F.substr(s, at + len(separator)))


def decode_map(s: Column) -> Column:
    """The inverse of :func:`encode_map` for non-null keys and values without separators; empty text gives an empty map.

    A value that holds separators comes back as several entries, so captured values can add fields; don't trust names.
    """
    parts = F.filter(F.split(s, ENTRY_RE), lambda p: p != "")
    entries = F.transform(
        parts,
        lambda p: F.struct(
            F.substring_index(p, PAIR_SEP, 1).alias("key"), after_first(p, PAIR_SEP).alias("value")
        ),
    )
    return last_win_map(entries)


def frame(key: Column, line: Column) -> Column:
    """``key`` and ``line`` as one message; the key can be read back with :func:`frame_key`."""
    return F.concat(key, F.lit(FRAME_SEP), line)


def frame_key(message: Column) -> Column:
    """The text before the two pipes."""
    return F.substring_index(message, FRAME_SEP.rstrip(), 1)


def frame_line(message: Column) -> Column:
    return after_first(message, FRAME_SEP)
