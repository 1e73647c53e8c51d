"""Level strings, list fields, dataset keys and likert parsing.

Parsing happens with array higher-order functions (``split``/``transform``/
``filter``/``exists``) inside one expression per row: no explode + regroup, no
Python.  ``map_from_entries`` throws on duplicate keys, so "last duplicate
wins" is applied on the entry array before the map is built.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import _col, py_strip

# Dataset-description key aliases and required defaults.
AUTHORS_KEY = "authors"
REFERENCES_KEYS = ("referencesandlinks", "referencesandlink")
FUNDING_KEYS = ("fundingsources", "funding")
LICENSE_KEYS = ("license", "licence")
DEFAULT_NAME = "Unnamed Dataset"
DEFAULT_BIDS_VERSION = "1.8.0"
DEFAULT_DATASET_TYPE = "raw"
DATASET_TYPES = ("raw", "derivative")
BIDS_VERSION_PATTERN = r"^\d+\.\d+\.\d+$"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it:
    an expression named inside a lambda is evaluated for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def dedupe_entries_last_wins(entries: Column, key_field: str = "key") -> Column:
    """Dict assignment over an array of ``struct<pos, key, value>``: one entry
    per key, at the position of its **first** occurrence, holding the value of
    its **last** occurrence (key order matters for the JSON documents).

    ``entries`` is evaluated once and sorted by key, so a long list takes no
    time that grows with its square."""

    def dedupe(es: Column) -> Column:
        keys = F.transform(es, lambda e, i: F.struct(e[key_field].alias("key"), i.alias("i")))
        found = _bound(F.array_sort(F.filter(keys, lambda k: k["key"].isNotNull())), runs)
        return F.transform(found, lambda r: F.struct(
            F.get(es, r["first"])["pos"].alias("pos"),
            F.get(es, r["first"])[key_field].alias(key_field),
            F.get(es, r["last"])["value"].alias("value"),
        ))

    def runs(keys: Column) -> Column:
        # equal keys lie together, in the order of their places
        starts = F.filter(keys, lambda k, i: F.coalesce(k["key"] != F.get(keys, i - 1)["key"], F.lit(True)))
        stops = F.filter(keys, lambda k, i: F.coalesce(k["key"] != F.get(keys, i + 1)["key"], F.lit(True)))
        return F.array_sort(F.zip_with(starts, stops, lambda a, b: F.struct(a["i"].alias("first"), b["i"].alias("last"))))

    return _bound(entries, dedupe)


def level_entries(c) -> Column:
    """C11 ``_parse_levels_string`` as ``array<struct<pos, key, value>>``.

    Split on ``;``; each piece is stripped and split on ``:``; pieces with
    exactly two parts survive, key and value stripped; a duplicate key keeps
    its first position and takes the last value.  ``pos`` is the 0-based
    position of the piece in the input.
    """
    pieces = F.split(_col(c).cast("string"), ";", -1)
    parsed = F.transform(
        pieces,
        lambda p, i: F.struct(
            i.alias("pos"),
            F.split(py_strip(p), ":", -1).alias("kv"),
        ),
    )
    pairs = F.transform(
        F.filter(parsed, lambda e: F.size(e["kv"]) == 2),
        lambda e: F.struct(
            e["pos"].alias("pos"),
            py_strip(e["kv"][0]).alias("key"),
            py_strip(e["kv"][1]).alias("value"),
        ),
    )
    return dedupe_entries_last_wins(pairs)


def levels_map(c) -> Column:
    """C11 as ``map<string,string>`` (empty map for an empty string)."""
    entries = level_entries(c)
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["value"])))


def split_list(c) -> Column:
    """C12 list fields (Authors, Funding, ReferencesAndLinks).

    Split on ``;`` when present, else on ``,``, else a single element; strip
    elements; drop empty ones.  ``''`` and null give ``[]`` (null is read as ``""``).
    """
    s = _col(c).cast("string")
    parts = (
        F.when(s.contains(";"), F.split(s, ";", -1))
        .when(s.contains(","), F.split(s, ",", -1))
        .otherwise(F.array(s))
    )
    return F.filter(F.transform(parts, lambda x: py_strip(x)), lambda x: x != "")


def dataset_key(c) -> Column:
    """Output key of a dataset-description row (aliases resolved)."""
    k = py_strip(_col(c).cast("string"))
    lk = F.lower(k)
    return (
        F.when(lk.isin(*REFERENCES_KEYS), F.lit("ReferencesAndLinks"))
        .when(lk.isin(*FUNDING_KEYS), F.lit("Funding"))
        .when(lk.isin(*LICENSE_KEYS), F.lit("License"))
        .otherwise(k)
    )


def dataset_key_is_list(c) -> Column:
    """Whether the raw key holds a list value."""
    lk = F.lower(py_strip(_col(c).cast("string")))
    return (lk == AUTHORS_KEY) | lk.isin(*REFERENCES_KEYS) | lk.isin(*FUNDING_KEYS)


def likert_levels(c) -> Column:
    """Number of likert levels; text that is not an integer gives 0.

    ``try_cast('4.0' as int)`` is null in Spark, matching the source's
    ``int('4.0')`` failure; a numeric 4.0 becomes 4.
    """
    col = _col(c)
    return F.coalesce(col.try_cast("int"), F.lit(0))


def likert_level_entries(pairs: Column, n_levels: Column) -> Column:
    """A9 + F6: level map entries of an item row.

    Positions ``0..n_levels-1`` only; both cells present; value castable to an
    integer (the key is that integer as text); the last duplicate key wins.
    """
    kept = F.filter(
        pairs,
        lambda p: (p["i"] < n_levels)
        & p["value"].isNotNull()
        & p["description"].isNotNull()
        & py_strip(p["value"]).try_cast("bigint").isNotNull(),
    )
    entries = F.transform(
        kept,
        lambda p: F.struct(
            p["i"].alias("pos"),
            py_strip(p["value"]).try_cast("bigint").cast("string").alias("key"),
            p["description"].alias("value"),
        ),
    )
    return dedupe_entries_last_wins(entries)
