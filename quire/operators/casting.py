"""Declared-type casting.

The source decides some casts per **whole column** (an ``integer`` column with
one non-integral number stays as it was; a ``cat_num`` column is numeric only
when every value is a non-null integral number).  That is a genuine second
pass: ``resolve_types`` runs one aggregate over all declared columns at once
(one job, a single row back to the driver), ``apply_types`` is the projection.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Declared type names and the numeric missing-value code.
INTEGER, FLOAT, CAT_NUM, CAT_STRING, STRING = "integer", "float", "cat_num", "cat_string", "string"
MISSING_CODE = -999


# What counts as a number in a sheet's text.
NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity)\s*$"


def numeric(c: Column) -> Column:
    """Number of a text cell; anything else, ``NaN`` and Java's ``1d``/``2f``
    included, is null."""
    s = c.cast("string")
    return F.when(s.rlike(NUMBER), F.trim(s).try_cast("double"))


def resolve_types(df: DataFrame, declared: Mapping[str, str]) -> dict[str, str]:
    """A2: resolved Spark type per declared column: ``long``, ``double``,
    ``string`` or ``keep`` (left as it was).  One aggregate for all columns."""
    aggs = []
    for col, dtype in declared.items():
        if col not in df.columns:
            continue
        t = (dtype or "").lower()
        v = numeric(F.col(f"`{col}`"))
        if t == INTEGER:
            aggs.append(F.count_if(v.isNotNull() & (v != F.floor(v))).alias(f"{col}__frac"))
        elif t == CAT_NUM:
            aggs.append(F.count_if(v.isNull() | (v != F.floor(v))).alias(f"{col}__bad"))
    flags = df.agg(*aggs).first().asDict() if aggs else {}
    out = {}
    for col, dtype in declared.items():
        if col not in df.columns:
            continue
        t = (dtype or "").lower()
        if t == INTEGER:
            out[col] = "long" if flags[f"{col}__frac"] == 0 else "keep"
        elif t == FLOAT:
            out[col] = "double"
        elif t == CAT_NUM:
            out[col] = "long" if flags[f"{col}__bad"] == 0 else "string"
        elif t in (CAT_STRING, STRING):
            out[col] = "string"
        else:
            out[col] = "keep"
    return out


def cast_column(c: Column, resolved: str) -> Column:
    """C9 + C10 for one column: cast by the resolved type; the missing code
    -999 becomes null on numeric columns only (text ``-999`` stays)."""
    if resolved == "long":
        v = numeric(c).try_cast("long")
        return F.when(v != MISSING_CODE, v)
    if resolved == "double":
        v = numeric(c)
        return F.when(v != MISSING_CODE, v)
    if resolved == "string":
        return c.cast("string")
    return c


def apply_types(df: DataFrame, resolved: Mapping[str, str]) -> DataFrame:
    """C9/C10 projection for all resolved columns at once."""
    return df.select(
        *[cast_column(F.col(f"`{c}`"), resolved[c]).alias(c) if c in resolved else F.col(f"`{c}`") for c in df.columns]
    )


def cell_text(c: Column, resolved: str) -> Column:
    """Text of a cast cell as written to a TSV: integers plain, floats in their
    shortest form, null stays null (``sanitize_tsv`` turns it into ``n/a``)."""
    if resolved == "long":
        return c.cast("string")
    if resolved == "double":
        return F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def long_form_casts(cells: DataFrame, variables: DataFrame) -> DataFrame:
    """A2 + C9 + C10 for long cells ``(row key..., variable, value)`` joined to
    ``variables(variable, data_type)``: the whole-column decision is a
    ``groupBy(variable)`` aggregate (partial combine, one row per variable),
    so no collect is needed and the output schema is static::

        ..., variable, data_type, resolved, value_long, value_double, value_string
    """
    v = numeric(F.col("value"))
    declared = variables.select("variable", F.lower("data_type").alias("data_type"))
    decl = cells.join(declared, "variable", "inner")
    stats = decl.groupBy("variable").agg(
        F.count_if(v.isNotNull() & (v != F.floor(v))).alias("n_frac"),
        F.count_if(v.isNull() | (v != F.floor(v))).alias("n_bad"),
    )
    # Both right sides have one row per declared variable; Spark broadcasts them
    # by their size and otherwise splits the few large keys of the shuffle join.
    j = decl.join(stats, "variable", "inner")
    resolved = (
        F.when(F.col("data_type") == INTEGER, F.when(F.col("n_frac") == 0, F.lit("long")).otherwise(F.lit("keep")))
        .when(F.col("data_type") == FLOAT, F.lit("double"))
        .when(F.col("data_type") == CAT_NUM, F.when(F.col("n_bad") == 0, F.lit("long")).otherwise(F.lit("string")))
        .when(F.col("data_type").isin(CAT_STRING, STRING), F.lit("string"))
        .otherwise(F.lit("keep"))
    )
    j = j.withColumn("resolved", resolved)
    as_long = numeric(F.col("value")).try_cast("long")
    as_double = numeric(F.col("value"))
    return j.select(
        *[c for c in cells.columns if c != "value"],
        "data_type",
        "resolved",
        F.when((F.col("resolved") == "long") & (as_long != MISSING_CODE), as_long).alias("value_long"),
        F.when((F.col("resolved") == "double") & (as_double != MISSING_CODE), as_double).alias("value_double"),
        F.when(F.col("resolved").isin("string", "keep"), F.col("value")).alias("value_string"),
    )


__all__ = ["resolve_types", "apply_types", "cast_column", "cell_text", "long_form_casts"]


def inferred_dtypes(cells: DataFrame, variables: DataFrame) -> DataFrame:
    """V4 on long cells: the dtype a sheet reader infers for each declared
    variable (``int64`` when every value is a non-null integral number,
    ``float64`` when every value is a number or empty, ``object`` otherwise),
    against the declared type: ``integer`` wants an int dtype, ``float`` a
    float dtype.  One aggregate per variable (map-side combine); the
    declaration side is bounded by the declaration sheet."""
    v = numeric(F.col("value"))
    declared = variables.select("variable", F.lower("data_type").alias("data_type"))
    stats = cells.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("value").isNull()).alias("n_null"),
        F.count_if(v.isNotNull()).alias("n_num"),
        F.count_if(v.isNotNull() & (v == F.floor(v))).alias("n_int"),
    )
    inferred = (
        F.when(F.col("n_num") + F.col("n_null") < F.col("n"), F.lit("object"))
        .when((F.col("n_null") == 0) & (F.col("n_int") == F.col("n")), F.lit("int64"))
        .otherwise(F.lit("float64"))
    )
    j = stats.join(declared, "variable").withColumn("inferred", inferred)
    mismatch = ((F.col("data_type") == INTEGER) & ~F.col("inferred").contains("int")) | (
        (F.col("data_type") == FLOAT) & ~F.col("inferred").contains("float"))
    return j.select("variable", "data_type", "inferred", mismatch.alias("mismatch"))
