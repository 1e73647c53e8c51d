"""Path templates and path-key extraction.

File names are built with ``concat``/``format_string`` and parsed back with
``regexp_extract`` on ``_metadata.file_path``: keys come from the path, not
from a driver-side directory walk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import _col

# BIDS name patterns.
SUBJECT_DIR = r"(?:^|/)(sub-[^/]+)/"
SESSION_DIR = r"(?:^|/)sub-[^/]+/(ses-[^/]+)/"
TASK_IN_NAME = r"_task-([^/]+)_[^_/]*beh\.tsv$"
SIDECAR_TASK = r"^task-(.+?)_beh\.json$"


def record_dir(subject: Column, session: Column) -> Column:
    """C18 ``<sub>/ses-<ses>/beh``."""
    return F.concat(_col(subject), F.lit("/ses-"), _col(session), F.lit("/beh"))


def record_file_name(subject: Column, session: Column, task: Column) -> Column:
    """C18 ``<sub>_ses-<ses>_task-<lower task>_beh.tsv``."""
    return F.concat(_col(subject), F.lit("_ses-"), _col(session), F.lit("_task-"), F.lower(_col(task)), F.lit("_beh.tsv"))


def record_path(subject: Column, session: Column, task: Column) -> Column:
    """C18 relative path of a per-record TSV."""
    return F.concat(record_dir(subject, session), F.lit("/"), record_file_name(subject, session, task))


def sidecar_file_name(task: Column) -> Column:
    """C18 ``task-<lower task>_beh.json``."""
    return F.concat(F.lit("task-"), F.lower(_col(task)), F.lit("_beh.json"))


def trial_file_name(pid: Column, ses: Column, task: Column) -> Column:
    """C18 trial TSV name of the single-file converter (no id padding)."""
    return F.concat(F.lit("sub-"), _col(pid).cast("string"), F.lit("_ses-"), _col(ses).cast("string"),
                    F.lit("_task-"), _col(task), F.lit("_beh.tsv"))


def decoded_path(path) -> Column:
    """A ``_metadata.file_path`` as the file system has it: Spark gives it as a
    URI, with spaces and other characters percent-encoded."""
    return F.url_decode(F.replace(_col(path), F.lit("+"), F.lit("%2B")))


def file_tasks(path, tasks: Sequence[str]) -> Column:
    """The requested tasks whose name a file bears: ``..._task-<t>_...beh.tsv``.
    Task names may hold ``_``, so they are looked up, not cut out."""
    name = F.regexp_extract(_col(path), r"([^/]+)$", 1)
    wanted = F.array(*[F.lit(t) for t in tasks]).cast("array<string>")
    bears = lambda t: name.contains(F.concat(F.lit("_task-"), t, F.lit("_")))
    return F.when(name.endswith("beh.tsv"), F.filter(wanted, bears)).otherwise(F.array().cast("array<string>"))


def path_subject(path) -> Column:
    """C20: ``sub-*`` directory of a path (null when absent)."""
    v = F.regexp_extract(_col(path), SUBJECT_DIR, 1)
    return F.when(v != "", v)


def path_session(path) -> Column:
    """C20: session id from a ``ses-*`` directory; ``1`` without one."""
    v = F.regexp_extract(_col(path), SESSION_DIR, 1)
    return F.when(v != "", F.regexp_replace(v, "^ses-", "")).otherwise(F.lit("1"))


def path_task(path) -> Column:
    """C20: task label inside a ``*_task-<t>_*beh.tsv`` file name; a label may hold ``_``."""
    v = F.regexp_extract(_col(path), TASK_IN_NAME, 1)
    return F.when(v != "", v)


def sidecar_task(file_name) -> Column:
    """Task of a ``task-<t>_beh.json`` sidecar name."""
    v = F.regexp_extract(_col(file_name), SIDECAR_TASK, 1)
    return F.when(v != "", v)
