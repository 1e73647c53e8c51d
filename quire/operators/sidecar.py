"""Task sidecars: item entries and task metadata (F1, F2, F3, P14, P15, A8,
A9, W5, U2, C19, C21, K1 content).

Input ``task_items`` (one row per item row of a definition's main sheet)::

    study, task, row_seq, itemname, itemdescription, likert_scale,
    levels ARRAY<STRUCT<i INT, value STRING, description STRING>>

``levels`` holds the repeated column pairs ``levels[.i] / leveldescription[.i]``
in column order; ``i = 0`` is the un-suffixed pair.  Input ``task_meta``::

    study, task, sheet_seq, row_seq, key, value

Everything is keyed by ``(study, task)``; dedupes are aggregations with
map-side combine (``max_by``/``min``), not windows over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.ids import item_name, sidecar_key
from quire.functions.levels import likert_level_entries, likert_levels
from quire.functions.text import py_strip, text_or_default

# Header-row marker and the default of a missing item name.
ITEMNAME_HEADER_PREFIX = "itemname"
UNKNOWN_ITEM = "Unknown Item"
EXAMPLE_MARKER = "example"
ANONYMOUS_PREFIX = "Question "


def valid_sidecar_item(itemname) -> F.Column:
    """non-null, not a repeated header row, not the missing-name marker."""
    s = py_strip(F.col(itemname) if isinstance(itemname, str) else itemname)
    return s.isNotNull() & ~F.lower(s).startswith(ITEMNAME_HEADER_PREFIX) & (s != UNKNOWN_ITEM)


def valid_task_item(itemname) -> F.Column:
    """non-null and not containing ``example`` (any case).  Differs from F1
    on purpose: this one decides which session columns are matched."""
    c = F.col(itemname) if isinstance(itemname, str) else itemname
    return c.isNotNull() & ~F.lower(c.cast("string")).contains(EXAMPLE_MARKER)


def task_item_names(task_items: DataFrame) -> DataFrame:
    """Item list of each task for J1/J2: F2 then C4 -> ``item_norm``."""
    return (
        task_items.filter(valid_task_item("itemname"))
        .select("study", "task", "row_seq", F.col("itemname").alias("item_raw"),
                item_name(F.col("itemname")).alias("item_norm"))
    )


def item_entries(task_items: DataFrame, anonymize: bool = False, key_mode: str = "raw") -> DataFrame:
    """Sidecar entries per item row, before the duplicate-key rule.

    ``key_mode="raw"`` keys by the stripped item name without ``-``/``_``
    (the source's rule); ``"norm"`` keys by the C4 name used in TSV headers
    (deviation D2, keeps sidecar and TSV consistent).
    Description: ``Question <row_seq+1>`` when anonymised (P14), else the text
    (C21).  Levels (A9/F6/C19) only for a positive likert count; Units (the
    stripped first level description) only when there are no levels.
    """
    name = py_strip(F.col("itemname"))
    key = sidecar_key(name) if key_mode == "raw" else item_name(name)
    desc = (
        F.concat(F.lit(ANONYMOUS_PREFIX), (F.col("row_seq") + 1).cast("string"))
        if anonymize
        else text_or_default(F.col("itemdescription"))
    )
    n = likert_levels(F.col("likert_scale"))
    entries = likert_level_entries(F.col("levels"), n)
    first_desc = F.get(F.col("levels"), 0)["description"]
    return (
        task_items.filter(valid_sidecar_item("itemname"))
        .select(
            "study",
            "task",
            "row_seq",
            key.alias("key"),
            desc.alias("description"),
            F.when(n > 0, entries).otherwise(F.array().cast("array<struct<pos:int,key:string,value:string>>")).alias("level_entries"),
            first_desc.alias("_first_desc"),
        )
        .withColumn(
            "units",
            F.when((F.size("level_entries") == 0) & F.col("_first_desc").isNotNull(), py_strip(F.col("_first_desc"))),
        )
        .drop("_first_desc")
    )


def dedupe_items(entries: DataFrame) -> DataFrame:
    """A duplicate key keeps the **last** row's entry at the **first** row's
    position (dict assignment).  One aggregation with partial combine."""
    payload = F.struct("description", "level_entries", "units")
    return (
        entries.groupBy("study", "task", "key")
        .agg(F.min("row_seq").alias("position"), F.max_by(payload, F.col("row_seq")).alias("e"))
        .select("study", "task", "key", "position", "e.description", "e.level_entries", "e.units")
    )


def metadata_entries(task_meta: DataFrame) -> DataFrame:
    """F3 + U2 + A8: task metadata ``key -> value``; both non-null; last wins
    in (sheet, row) order; position of first occurrence kept."""
    m = task_meta.filter(F.col("key").isNotNull() & F.col("value").isNotNull())
    order = F.struct("sheet_seq", "row_seq")
    return (
        m.groupBy("study", "task", F.col("key").cast("string").alias("key"))
        .agg(F.min(order).alias("first"), F.max_by(F.col("value").cast("string"), order).alias("value"))
    )


def sidecar_entries(task_items: DataFrame, task_meta: DataFrame | None = None, anonymize: bool = False,
                    key_mode: str = "raw") -> DataFrame:
    """K1 content as rows: items first, then metadata via ``dict.update``
    (metadata replaces an item with the same key, keeping the item's position;
    new keys follow in metadata order).

    Columns: ``study, task, key, position(struct), kind, description,
    level_entries, units, value``.
    """
    items = dedupe_items(item_entries(task_items, anonymize, key_mode)).select(
        "study", "task", "key",
        F.struct(F.lit(0).alias("part"), F.col("position").cast("long").alias("a"), F.lit(0).cast("long").alias("b")).alias("item_pos"),
        "description", "level_entries", "units",
    )
    if task_meta is None:
        return items.select("study", "task", "key", F.col("item_pos").alias("position"), F.lit("item").alias("kind"),
                            "description", "level_entries", "units", F.lit(None).cast("string").alias("value"))
    meta = metadata_entries(task_meta).select(
        "study", "task", "key",
        F.struct(F.lit(1).alias("part"), F.col("first.sheet_seq").cast("long").alias("a"), F.col("first.row_seq").cast("long").alias("b")).alias("meta_pos"),
        "value",
    )
    j = items.join(meta, on=["study", "task", "key"], how="full_outer")
    return j.select(
        "study", "task", "key",
        F.coalesce("item_pos", "meta_pos").alias("position"),
        F.when(F.col("meta_pos").isNotNull(), F.lit("meta")).otherwise(F.lit("item")).alias("kind"),
        F.when(F.col("meta_pos").isNull(), F.col("description")).alias("description"),
        F.when(F.col("meta_pos").isNull(), F.col("level_entries")).alias("level_entries"),
        F.when(F.col("meta_pos").isNull(), F.col("units")).alias("units"),
        "value",
    )


def entry_json(entries: DataFrame) -> DataFrame:
    """JSON text of every sidecar entry value (``Description``, ``Levels``,
    ``Units`` for items; a JSON string for metadata)."""
    levels = F.map_from_entries(F.transform("level_entries", lambda e: F.struct(e["key"], e["value"])))
    item_obj = F.to_json(
        F.struct(
            F.col("description").alias("Description"),
            F.when(F.size("level_entries") > 0, levels).alias("Levels"),
            F.col("units").alias("Units"),
        )
    )
    meta_str = F.regexp_extract(F.to_json(F.array(F.col("value"))), r"^\[(.*)\]$", 1)
    return entries.withColumn("json", F.when(F.col("kind") == "item", item_obj).otherwise(meta_str))


def sidecar_documents(entries: DataFrame) -> DataFrame:
    """One JSON document per (study, task), keys in position order.  The group
    is one task definition (bounded by its item count), never response data."""
    e = entry_json(entries).select(
        "study", "task",
        F.struct("position", F.to_json(F.array("key")).alias("k"), "json").alias("kv"),
    )
    docs = e.groupBy("study", "task").agg(F.array_sort(F.collect_list("kv")).alias("kvs"))
    body = F.concat_ws(
        ", ",
        F.transform("kvs", lambda x: F.concat(F.regexp_extract(x["k"], r"^\[(.*)\]$", 1), F.lit(": "), x["json"])),
    )
    return docs.select("study", "task", F.concat(F.lit("{"), body, F.lit("}")).alias("json"))
