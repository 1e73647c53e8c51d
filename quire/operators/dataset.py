"""Dataset description (S5 second sheet, A8, C12-C15, K5) for many studies.

Input ``dataset_meta(study, seq, key, value)``: the first two columns of the
variables workbook's second sheet, ``seq`` in sheet order.  Output rows::

    study, key, position STRUCT<part INT, seq LONG>, is_list BOOLEAN,
    value STRING, items ARRAY<STRING>

Semantics kept: raw duplicate keys, last wins (``dict(zip())``); keys and
values stripped; aliases resolved, a later alias of the same output key
replaces the earlier value but keeps its position; list fields split (C12);
required fields filled when missing or empty (C14); ``BIDSVersion`` pattern
and ``DatasetType`` domain enforced (C15).  An empty sheet yields the same
three required fields (deviation D14: the default name is ``Unnamed
Dataset``, not a product name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.levels import (
    BIDS_VERSION_PATTERN, DATASET_TYPES, DEFAULT_BIDS_VERSION, DEFAULT_DATASET_TYPE, DEFAULT_NAME, dataset_key,
    dataset_key_is_list, split_list,
)
from quire.functions.text import py_strip

REQUIRED = (("Name", DEFAULT_NAME), ("BIDSVersion", DEFAULT_BIDS_VERSION), ("DatasetType", DEFAULT_DATASET_TYPE))


def dataset_rows(dataset_meta: DataFrame, studies: DataFrame | None = None) -> DataFrame:
    meta = dataset_meta.filter(F.col("key").isNotNull()).select(
        "study", F.col("seq").cast("long").alias("seq"), F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )
    # Raw dict, last value per exact key, first position kept.
    raw = meta.groupBy("study", "key").agg(F.min("seq").alias("first"), F.max_by("value", "seq").alias("value"))
    processed = raw.select(
        "study",
        "first",
        dataset_key(F.col("key")).alias("out_key"),
        dataset_key_is_list(F.col("key")).alias("is_list"),
        F.coalesce(py_strip(F.col("value")), F.lit("")).alias("value"),
    )
    # Iteration is in first-position order; a later raw key mapping to the
    # same output key overwrites the value, the first position stays.
    payload = F.struct("is_list", "value")
    merged = processed.groupBy("study", "out_key").agg(
        F.min("first").alias("first"), F.max_by(payload, F.col("first")).alias("p")
    ).select(
        "study", F.col("out_key").alias("key"),
        F.struct(F.lit(0).alias("part"), F.col("first").alias("seq")).alias("position"),
        F.col("p.is_list").alias("is_list"), F.col("p.value").alias("value"),
    )
    merged = merged.withColumn("items", F.when(F.col("is_list"), split_list(F.col("value"))))
    merged = merged.withColumn("value", F.when(~F.col("is_list"), F.col("value")))

    spine = studies if studies is not None else dataset_meta.select("study").distinct()
    defaults = spine.select(
        "study",
        F.inline(
            F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("default"), F.lit(i).alias("i"))
                      for i, (k, v) in enumerate(REQUIRED)])
        ),
    )
    j = merged.join(defaults, on=["study", "key"], how="full_outer")
    empty = F.col("position").isNull() | (F.col("is_list") & (F.size("items") == 0)) | (
        ~F.col("is_list") & (F.coalesce(F.col("value"), F.lit("")) == "")
    )
    filled = j.select(
        "study", "key",
        F.coalesce("position", F.struct(F.lit(1).alias("part"), F.col("i").cast("long").alias("seq"))).alias("position"),
        F.when(F.col("default").isNotNull() & empty, F.lit(False)).otherwise(F.col("is_list")).alias("is_list"),
        F.when(F.col("default").isNotNull() & empty, F.col("default")).otherwise(F.col("value")).alias("value"),
        F.when(F.col("default").isNotNull() & empty, F.lit(None)).otherwise(F.col("items")).alias("items"),
    )
    # Version pattern and dataset type domain.
    fixed_value = (
        F.when((F.col("key") == "BIDSVersion") & ~F.coalesce(F.col("value").rlike(BIDS_VERSION_PATTERN), F.lit(False)),
               F.lit(DEFAULT_BIDS_VERSION))
        .when((F.col("key") == "DatasetType") & ~F.coalesce(F.col("value").isin(*DATASET_TYPES), F.lit(False)),
              F.lit(DEFAULT_DATASET_TYPE))
        .otherwise(F.col("value"))
    )
    fixed_list = F.when(F.col("key").isin("BIDSVersion", "DatasetType"), F.lit(False)).otherwise(F.col("is_list"))
    fixed_items = F.when(F.col("key").isin("BIDSVersion", "DatasetType"), F.lit(None)).otherwise(F.col("items"))
    return filled.select("study", "key", "position", fixed_list.alias("is_list"), fixed_value.alias("value"),
                         fixed_items.cast("array<string>").alias("items"))


def dataset_json(rows: DataFrame) -> DataFrame:
    """K5 document per study, keys in position order.  One group per study:
    bounded by the description sheet's size."""
    val = F.when(F.col("is_list"), F.to_json(F.coalesce("items", F.array().cast("array<string>")))).otherwise(
        F.regexp_extract(F.to_json(F.array("value")), r"^\[(.*)\]$", 1)
    )
    kv = F.struct("position", F.concat(F.regexp_extract(F.to_json(F.array("key")), r"^\[(.*)\]$", 1), F.lit(": "), val).alias("t"))
    docs = rows.groupBy("study").agg(F.array_sort(F.collect_list(kv)).alias("kvs"))
    return docs.select("study", F.concat(F.lit("{"), F.concat_ws(", ", F.transform("kvs", lambda x: x["t"])), F.lit("}")).alias("json"))
