"""Column functions on hand-written values and, on generated values, the properties
that SURVEY section 2.9 asks of their results."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import col_values
from quire.functions import ids, levels, text

ALPHABET = "ab7Z09-_ ,.;:\t\n\r\u3000\xa0xsubSUB"
strings = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=12)), min_size=1, max_size=120)
SETTINGS = settings(max_examples=6, deadline=None)

VECTORS = [
    (ids.subject_id, {None: "sub-unknown", "4": "sub-004", " 12\t": "sub-012", "0815": "sub-0815", "sub-x9": "sub-x9",
                      "sub---7": "sub-7", "M3": "sub-M3", "": "sub-", "sub-": "sub-", "Sub-1": "sub-Sub-1"}),
    (ids.session_id, {None: "01", "3": "03", " 7 ": "07", "11": "11", "123": "123", "pre": "pre", "": ""}),
    (ids.item_name, {"mood1": "MOOD1", "Mood-02": "MOOD02", "mood_3": "MOOD3", "mood 4": "MOOD4", "mood--5": "mood--5",
                     "6mood": "6mood", "mood": "mood", "mood7x": "mood7x", "": ""}),
    (text.clean_text, {None: None, " a,b ": "a b", "a\r\n\tb": "a b", "": "", "\u3000x\xa0y": "x y"}),
    (text.sanitize_tsv, {None: "n/a", "": "n/a", " NaN ": "n/a", "None": "n/a", "nULL": "n/a", "a\tb\nc": "a b c",
                         "a, b": "a, b", "0": "0"}),
    (levels.levels_map, {"1: low; 2 :high": {"1": "low", "2": "high"}, "1:a:b;2:c": {"2": "c"}, "x": {}, "": {},
                         "1:a;1:b": {"1": "b"}}),
    (levels.split_list, {None: [], "": [], "a; b;;c": ["a", "b", "c"], "a, b": ["a", "b"], "a, b; c": ["a, b", "c"],
                         " one ": ["one"], ";": []}),
]


@pytest.mark.parametrize("fn, cases", VECTORS, ids=[f.__name__ for f, _ in VECTORS])
def test_hand_written_values(spark, fn, cases):
    assert col_values(spark, fn, list(cases)) == list(cases.values())


@SETTINGS
@given(strings)
def test_subjects_have_the_prefix_once_applied(spark, vals):
    once = col_values(spark, ids.subject_id, vals)
    assert all(v.startswith("sub-") for v in once)
    kept = [v for v in once if not v.startswith("sub--")]
    assert not kept or col_values(spark, ids.subject_id, kept) == [v.rstrip(" \t\n\r\u3000\xa0") for v in kept]


@SETTINGS
@given(strings)
def test_sessions_stay_once_normalised(spark, vals):
    once = col_values(spark, ids.session_id, vals)
    assert col_values(spark, ids.session_id, once) == once
    assert not any(re.fullmatch("[0-9]", v) for v in once)


@SETTINGS
@given(st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=1, max_size=120))
def test_items_change_only_to_letters_and_digits(spark, vals):
    once = col_values(spark, ids.item_name, vals)
    for before, after in zip(vals, once):
        assert after == before or re.fullmatch("[A-Z]+[0-9]+", after)
    assert col_values(spark, ids.item_name, once) == once


@SETTINGS
@given(strings)
def test_cleaned_text_is_one_clean_line(spark, vals):
    for fn, banned in ((text.clean_text, "\t\n\r,"), (text.sanitize_tsv, "\t\n\r")):
        once = col_values(spark, fn, vals)
        for v in once:
            assert v is None or (v == v.strip() and "  " not in v and not any(b in v for b in banned))
        assert col_values(spark, fn, once) == once
    assert all(col_values(spark, text.sanitize_tsv, vals))


@SETTINGS
@given(st.lists(st.text(alphabet=ALPHABET, max_size=20), min_size=1, max_size=80))
def test_levels_and_lists_hold_trimmed_parts_of_the_text(spark, vals):
    for v, got in zip(vals, col_values(spark, levels.levels_map, vals)):
        for k, x in got.items():
            assert k in v and x in v and not set(k + x) & set(";:") and k == k.strip() and x == x.strip()
    for v, got in zip(vals, col_values(spark, levels.split_list, vals)):
        assert all(p and p in v and p == p.strip() for p in got)
