"""ANSI/DuckDB SQL fragments for the oracle queries.

Each mirrors one Column function of ``quire.functions`` so the oracle SQL
stays readable.  Regex text is shared (Java regex and RE2 both read it); DuckDB
needs the ``'g'`` flag to replace every match, Spark always does.
"""

from __future__ import annotations

# Fixed values, stated here on their own so that a wrong pattern of the library
# cannot agree with itself: white space as Python sees it, the texts that a
# table reader takes for missing, and the name patterns.
WS_CLASS_BODY = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WS = f"[{WS_CLASS_BODY}]"
WS_CHARS = [*map(chr, (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                       0x202F, 0x205F, 0x3000))]
READ_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
                  "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
SANITIZE_NULL_TOKENS = ("", "nan", "none", "null")
SUBJECT_COMPLIANT = "^sub-[a-zA-Z0-9]+$"
TASK_EXTENSION = r"(?i)\.(xlsx?|csv)$"
ITEM_PATTERN = rf"^([A-Za-z]+)[{WS_CLASS_BODY}\-_]?([0-9]+)\n?\z"
SUBJECT_DIR = "(?:^|/)(sub-[^/]+)/"
SESSION_DIR = "(?:^|/)sub-[^/]+/ses-([^/]+)/"
TASK_IN_NAME = r"_task-([^/]+)_[^_/]*beh\.tsv$"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WS_CHARS_SQL = "(" + " || ".join(f"chr({ord(ch)})" for ch in WS_CHARS) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS_CHARS_SQL})"


def zfill(x: str, n: int) -> str:
    return f"(CASE WHEN length({x}) < {n} THEN lpad({x}, {n}, '0') ELSE {x} END)"


def subject_id(x: str) -> str:
    s = f"regexp_replace({strip(f'CAST({x} AS VARCHAR)')}, '^sub-+', 'sub-')"
    return (
        f"(CASE WHEN {x} IS NULL THEN 'sub-unknown' WHEN starts_with({s}, 'sub-') THEN {s} "
        f"WHEN regexp_matches({s}, '^[0-9]+$') THEN 'sub-' || {zfill(s, 3)} ELSE 'sub-' || {s} END)"
    )


def subject_compliant(x: str) -> str:
    return f"regexp_matches({x}, {q(SUBJECT_COMPLIANT)})"


def session_id(x: str) -> str:
    s = strip(f"CAST({x} AS VARCHAR)")
    return f"(CASE WHEN {x} IS NULL THEN '01' WHEN regexp_matches({s}, '^[0-9]+$') THEN {zfill(s, 2)} ELSE {s} END)"


def task_name(x: str) -> str:
    s = f"lower(regexp_replace(regexp_replace({strip(x)}, {q(TASK_EXTENSION)}, ''), '[^a-zA-Z0-9]', '', 'g'))"
    return f"(CASE WHEN length({s}) > 0 THEN {s} END)"


def item_name(x: str) -> str:
    return (
        f"(CASE WHEN regexp_matches({x}, {q(ITEM_PATTERN)}) THEN upper(regexp_extract({x}, {q(ITEM_PATTERN)}, 1)) "
        f"|| regexp_extract({x}, {q(ITEM_PATTERN)}, 2) ELSE {x} END)"
    )


def sidecar_key(x: str) -> str:
    return f"regexp_replace({strip(x)}, '[-_]', '', 'g')"


def clean_text(x: str) -> str:
    return f"trim(regexp_replace({x}, {q('[,' + WS_CLASS_BODY + ']+')}, ' ', 'g'))"


def sanitize_tsv(x: str) -> str:
    s = f"trim(regexp_replace({x}, {q(WS + '+')}, ' ', 'g'))"
    toks = ", ".join(q(t) for t in SANITIZE_NULL_TOKENS)
    return f"(CASE WHEN {x} IS NULL THEN 'n/a' WHEN lower({s}) IN ({toks}) THEN 'n/a' ELSE {s} END)"


def integral_text(x: str) -> str:
    return (
        f"(CASE WHEN {x} IS NULL THEN NULL WHEN NOT isnan({x}) AND abs({x}) < 9.2e18 AND {x} = floor({x}) "
        f"THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END)"
    )


def na_token(x: str) -> str:
    toks = ", ".join(q(t) for t in READ_NA_TOKENS)
    return f"(CASE WHEN {x} IN ({toks}) THEN NULL ELSE {x} END)"


def split_list(x: str) -> str:
    parts = (
        f"(CASE WHEN contains({x}, ';') THEN string_split({x}, ';') WHEN contains({x}, ',') THEN string_split({x}, ',') "
        f"ELSE [{x}] END)"
    )
    return f"list_filter(list_transform({parts}, lambda e: {strip('e')}), lambda e: e <> '')"
