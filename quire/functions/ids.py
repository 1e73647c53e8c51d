"""Identifier normalisers as Column expressions.

Each is a ``when`` chain over ``regexp_replace``/``rlike``/``lpad``: JVM-side,
codegen'd, no Python per row.  ``lpad`` truncates text longer than the width,
so it is guarded by ``length`` (zero-filling never shortens).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import WS_CLASS_BODY, _col, py_strip

# BIDS subject compliance pattern, extension pattern of task
# files, and the item-name pattern (letters, optional separator, digits).
SUBJECT_COMPLIANT = r"^sub-[a-zA-Z0-9]+$"
TASK_EXTENSION = r"(?i)\.(xlsx?|csv)$"
# ``\n?\z`` is Python's ``$`` (end, or before one final newline); Java's ``$``
# would also accept ``\r\n`` and Unicode line separators.
ITEM_PATTERN = r"^([A-Za-z]+)[" + WS_CLASS_BODY + r"\-_]?([0-9]+)\n?\z"


def subject_id(c) -> Column:
    """C1 ``validate_subject_id``.

    null -> ``sub-unknown``; strip; ``^sub-+`` -> ``sub-``; without the
    ``sub-`` prefix: all digits -> ``sub-`` + zero-fill to 3, else prefix only.

    Written as a chain of replacements, each consuming the previous one once:
    the generated code stays linear in size (a CASE over a shared
    subexpression would repeat it in every branch).
    """
    s = F.regexp_replace(py_strip(_col(c).cast("string")), r"^sub-+", "sub-")
    s = F.regexp_replace(s, r"^([0-9])$", "00$1")
    s = F.regexp_replace(s, r"^([0-9]{2})$", "0$1")
    s = F.regexp_replace(s, r"^(?!sub-)", "sub-")
    return F.coalesce(s, F.lit("sub-unknown"))


def subject_compliant(c) -> Column:
    """BIDS compliance flag of a normalised subject id (warning only)."""
    return _col(c).rlike(SUBJECT_COMPLIANT)


def session_id(c) -> Column:
    """C2 ``validate_session_id``: null -> ``01``; strip; digits -> zero-fill
    to 2; anything else unchanged."""
    s = F.regexp_replace(py_strip(_col(c).cast("string")), r"^([0-9])$", "0$1")
    return F.coalesce(s, F.lit("01"))


def task_name(c) -> Column:
    """C3 ``validate_task_name``: strip, drop ``.xls/.xlsx/.csv`` (any case),
    drop non-alphanumerics, lower.  Empty results (an error in the source) and
    null input give null; ``task_name_issue`` reports them."""
    s = py_strip(_col(c).cast("string"))
    s = F.regexp_replace(s, TASK_EXTENSION, "")
    s = F.lower(F.regexp_replace(s, r"[^a-zA-Z0-9]", ""))
    return F.when(F.length(s) > 0, s)


def task_name_issue(c) -> Column:
    """Issue text for C3 failures, null when the name is valid."""
    raw = _col(c)
    return (
        F.when(raw.isNull(), F.lit("no task name"))
        .when(task_name(raw).isNull(), F.lit("no letter or digit in the task name"))
    )


def task_from_file(file_name) -> Column:
    """Task of a definition workbook = upper-cased file stem (D8: raw stem,
    not sanitised, is what the matching join uses)."""
    return F.upper(F.regexp_extract(_col(file_name), r"^(.*)\.[^.]*$", 1))


def item_name(c) -> Column:
    """C4 ``normalize_item_name``: ``<letters>[sep]<digits>`` from the start to
    the end -> upper(letters) + digits; anything else unchanged."""
    s = _col(c).cast("string")
    # One regex pass: a match is rewritten to a marker + letters + digits (the
    # separator dropped); upper() of letters+digits only changes the letters.
    marked = F.regexp_replace(s, ITEM_PATTERN, "\u0001$1$2")
    hit = (marked != s) & marked.startswith("\u0001")
    return F.when(hit, F.upper(F.substring(marked, 2, 1 << 30))).otherwise(s)


def sidecar_key(c) -> Column:
    """Sidecar key = stripped item name without ``-`` and ``_``
    (no upper-casing; see deviation D2)."""
    return F.regexp_replace(py_strip(_col(c).cast("string")), r"[-_]", "")


__all__ = [
    "subject_id",
    "subject_compliant",
    "session_id",
    "task_name",
    "task_name_issue",
    "task_from_file",
    "item_name",
    "sidecar_key",
]
