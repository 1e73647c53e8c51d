"""Column-expression functions (scalar operators C1-C21)."""

from quire.functions.ids import (  # noqa: F401
    item_name, session_id, sidecar_key, subject_compliant, subject_id, task_from_file, task_name,
    task_name_issue,
)
from quire.functions.levels import (  # noqa: F401
    dataset_key, dataset_key_is_list, level_entries, levels_map, likert_level_entries, likert_levels,
    split_list,
)
from quire.functions.text import (  # noqa: F401
    as_text, clean_text, integral_text, na_token_to_null, py_strip, sanitize_tsv, text_or_default,
)
