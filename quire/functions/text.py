"""Text cleaning as Column expressions.

All functions take and return ``pyspark.sql.Column`` and stay inside
whole-stage codegen (``regexp_replace``, ``when``, ``trim``); none is a UDF.

Whitespace: the source semantics use Python's ``str.strip()`` and ``\\s``, which
cover 29 code points, not only ASCII.  Spark's ``trim`` removes spaces only and
Java's ``\\s`` is ASCII, so the class is spelled out.  The ``\\x{..}`` syntax is
understood by both Java regex and RE2, so the same pattern text serves the
DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

# The code points for which Python's str.isspace() is true.
WS_CLASS_BODY = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WS = "[" + WS_CLASS_BODY + "]"
STRIP_PATTERN = r"\A" + WS + "+|" + WS + r"+\z"
# The same 29 characters as a literal set, for btrim (no regex on the hot path).
WS_CHARS = "".join(
    chr(c) for c in [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B)) + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)

# Tokens sanitize_for_tsv turns into the missing marker.
SANITIZE_NULL_TOKENS = ("", "nan", "none", "null")
MISSING_TEXT = "n/a"

# The default NA tokens of the TSV reader used by the gather step
# (pandas read_csv default list).
READ_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace.

    ``btrim`` with the explicit character set: a scan of both ends, no regex.
    """
    return F.btrim(_col(c), F.lit(WS_CHARS))


def clean_text(c) -> Column:
    """C6 ``clean_text_data``: newline, CR, comma, tab -> space; collapse; strip.

    One pass: a run of commas and whitespace becomes one space (commas are
    first turned into spaces, then whitespace runs collapse), then the single
    spaces left at the ends are trimmed.  Null stays null.
    """
    collapsed = F.regexp_replace(_col(c), "[," + WS_CLASS_BODY + "]+", " ")
    return F.trim(collapsed)


def sanitize_tsv(c) -> Column:
    """C7 ``sanitize_for_tsv``: tabs/newlines -> space, collapse, strip,
    ``''/nan/none/null`` (any case) and null -> ``n/a``; commas kept."""
    s = F.trim(F.regexp_replace(_col(c), WS + "+", " "))
    return (
        F.when(s.isNull(), F.lit(MISSING_TEXT))
        .when(F.lower(s).isin(*SANITIZE_NULL_TOKENS), F.lit(MISSING_TEXT))
        .otherwise(s)
    )


def integral_text(c) -> Column:
    """Numbers to text, integral floats without the ``.0`` (3.0 -> '3').

    ``cast(1e7 as string)`` gives ``1.0E7``; integral values therefore go
    through ``bigint`` first.  Non-finite values and values outside the bigint
    range keep Spark's own rendering.
    """
    x = _col(c).cast("double")
    finite = ~F.isnan(x) & (F.abs(x) < F.lit(9.2e18))
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(finite & (x == F.floor(x)), x.cast("bigint").cast("string"))
        .otherwise(x.cast("string"))
    )


def as_text(c, dtype=None) -> Column:
    """Text form of a value as the sheets would show it: numbers via C8."""
    col = _col(c)
    if dtype is None or isinstance(dtype, StringType):
        return col.cast("string")
    if isinstance(dtype, (DoubleType, FloatType)):
        return integral_text(col)
    if isinstance(dtype, NumericType):
        return col.cast("string")
    return col.cast("string")


def na_token_to_null(c, tokens=READ_NA_TOKENS) -> Column:
    """C17: NA tokens of a TSV read become null; other text is kept as text
    (deviation D5: ``01`` stays ``01``, no numeric re-typing)."""
    col = _col(c)
    return F.when(col.isin(*tokens), F.lit(None).cast("string")).otherwise(col)


def text_or_default(c, default: str = "No description available") -> Column:
    """Description text for a sidecar; null takes the default text
    (deviation D6: the source would write the text ``nan``)."""
    return F.coalesce(_col(c).cast("string"), F.lit(default))
