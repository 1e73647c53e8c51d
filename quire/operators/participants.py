"""Participants: demographics + variable declarations (P1, P7, P8, P9, K3,
K4, J9, J10, V4).

``variables`` is schema-as-data (one row per declared column, bounded by the
declaration sheet), so it is collected once to build the projection; the
demographics rows never leave the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.ids import subject_id
from quire.functions.levels import level_entries
from quire.functions.text import MISSING_TEXT, py_strip, sanitize_tsv
from quire.operators.casting import apply_types, cell_text, resolve_types

# The constant participant_id sidecar entry and the categorical
# types that carry Levels.
PARTICIPANT_ID_ENTRY = {"Description": "Unique participant identifier", "LongName": "Participant ID"}
LEVEL_TYPES = ("cat_num", "cat_string")


def normalize_column_names(df: DataFrame, lowercase: bool = True) -> DataFrame:
    """Strip (and lower) column names."""
    names = [c.strip().lower() if lowercase else c.strip() for c in df.columns]
    return df.toDF(*names)


def normalize_variables(variables: DataFrame) -> DataFrame:
    """Variable names stripped and lower-cased; ``seq`` keeps sheet order."""
    return variables.withColumn("VariableName", F.lower(py_strip(F.col("VariableName"))))


def declared(variables: DataFrame) -> list[tuple[str, str]]:
    """(name, data_type) in declaration order; the declaration is small."""
    rows = variables.orderBy("seq").select("VariableName", "DataType").collect()
    return [(r[0], r[1]) for r in rows]


def participants_table(demographics: DataFrame, variables: DataFrame, order: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """P7 -> P8 -> P9 -> C9 -> C10.

    Declared columns missing from the demographics are added as ``n/a`` (P7,
    before casting), undeclared ones dropped (P8), ``id`` becomes
    ``participant_id`` = C1(id), first column (P9; deviation D7: always, and a
    declared ``id`` absent from the sheet raises).  Returns the typed table and
    the resolved type per column.  ``order`` names a column of the demographics
    that holds the sheet's row order; it comes along as the last column.
    """
    demo = normalize_column_names(demographics)
    decl = declared(variables)
    names = [n for n, _ in decl]
    if "id" not in demo.columns:
        raise ValueError("demographics has no 'id' column")
    for n in names:
        if n not in demo.columns:
            demo = demo.withColumn(n, F.lit(MISSING_TEXT))
    cols = ["id"] + [n for n in names if n != "id"]
    kept = [F.col(order)] if order else []
    demo = demo.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols], *kept)
    types = {n: t for n, t in decl if n != "id"}
    resolved = resolve_types(demo, types)
    typed = apply_types(demo, resolved)
    typed = typed.select(subject_id(F.col("id")).alias("participant_id"), *[F.col(f"`{c}`") for c in cols if c != "id"], *kept)
    return typed, resolved


def participants_tsv_rows(typed: DataFrame, resolved: dict[str, str], order: str | None = None) -> DataFrame:
    """K3 cells: every value to text, through C7 (null and ``nan`` -> ``n/a``);
    the ``order`` column stays as it is."""
    return typed.select(
        *[
            F.col(c) if c == order else sanitize_tsv(cell_text(F.col(f"`{c}`"), resolved.get(c, "string"))).alias(c)
            for c in typed.columns
        ]
    )


def participants_metadata(variables: DataFrame) -> DataFrame:
    """K4 as rows: one entry per declared variable except ``id`` (F8), with
    ``Levels`` (C11) only for categorical types, plus the constant
    ``participant_id`` entry.  Columns: ``variable, seq, description, levels``
    (array of key/value entries, empty when absent)."""
    v = variables.filter(F.lower(F.col("VariableName")) != "id")
    is_cat = F.lower(F.col("DataType")).isin(*LEVEL_TYPES) & F.col("Levels").isNotNull()
    entries = F.when(is_cat, F.transform(level_entries(F.col("Levels")), lambda e: F.struct(e["key"], e["value"])))
    entries = F.coalesce(entries, F.array().cast("array<struct<key:string,value:string>>"))
    rows = v.select(
        F.lower(F.col("VariableName")).alias("variable"),
        F.col("seq").cast("long").alias("seq"),
        F.coalesce(F.col("Description").cast("string"), F.lit("")).alias("description"),
        entries.alias("levels"),
    )
    const = variables.sparkSession.createDataFrame(
        [("participant_id", None, PARTICIPANT_ID_ENTRY["Description"], [])],
        "variable string, seq long, description string, levels array<struct<key:string,value:string>>",
    )
    return rows.unionByName(const)


def participants_json(meta_rows: DataFrame) -> DataFrame:
    """K4 document (one row): ``{variable: {Description, Levels?}, ...,
    participant_id: {Description, LongName}}``."""
    obj = F.when(
        F.col("variable") == "participant_id",
        F.to_json(F.struct(F.col("description").alias("Description"), F.lit(PARTICIPANT_ID_ENTRY["LongName"]).alias("LongName"))),
    ).otherwise(
        F.to_json(
            F.struct(
                F.col("description").alias("Description"),
                F.when(F.size("levels") > 0, F.map_from_entries("levels")).alias("Levels"),
            )
        )
    )
    kv = F.struct(
        F.coalesce(F.col("seq"), F.lit(2**62)).alias("o"),
        F.concat(F.regexp_extract(F.to_json(F.array("variable")), r"^\[(.*)\]$", 1), F.lit(": "), obj).alias("t"),
    )
    doc = meta_rows.agg(F.array_sort(F.collect_list(kv)).alias("kvs"))
    return doc.select(F.concat(F.lit("{"), F.concat_ws(", ", F.transform("kvs", lambda x: x["t"])), F.lit("}")).alias("json"))


def missing_variable_rows(columns: DataFrame, variables: DataFrame) -> DataFrame:
    """J9 as rows, for many studies: ``(study, variable)`` declared and not among the
    study's demographics columns (both stripped and lower-cased)."""
    have = columns.select("study", F.lower(F.btrim("column")).alias("variable")).distinct()
    declared = variables.select("study", F.lower(F.btrim("VariableName")).alias("variable")).distinct()
    return declared.join(have, ["study", "variable"], "left_anti")


def missing_variables(demographics: DataFrame, variables: DataFrame) -> list[str]:
    """Declared variables absent from the demographics columns (a schema
    set difference: both sides are column lists)."""
    cols = set(normalize_column_names(demographics).columns)
    return [n for n, _ in declared(variables) if n not in cols]


__all__: Sequence[str] = [
    "participants_table", "participants_tsv_rows", "participants_metadata", "participants_json",
    "missing_variables", "normalize_column_names", "normalize_variables",
]
