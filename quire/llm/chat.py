"""Chat formatting from a declarative template.  DataFrame functions only.

A template names the markers of a turn, the roles under the loss and a
finite-state machine over roles.  A conversation's turns, in order of
(turn, role, text), run through the machine with ``aggregate``; they come out as
segments ``(text, loss)`` whose concatenation is the formatted conversation.
Control strings inside roles and texts are escaped: ``~`` becomes ``~0``, ``<|``
becomes ``~1`` and ``|>`` becomes ``~2``, so no text can forge a marker and
``read_turns`` gives back every turn as it was.

A conversation is one training example and one output row, so its turns meet in
one row; different conversations are spread by their id.

Cases: a null text or role counts as empty; a null turn sorts first; a null id is
one more conversation; repeated rows are repeated turns; an order of roles that the
machine refuses gives ``valid`` false and is formatted all the same; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPES = (("~", "~0"), ("<|", "~1"), ("|>", "~2"))


@dataclass(frozen=True)
class ChatTemplate:
    head_open: str = "<|"
    head_close: str = "|>\n"
    turn_close: str = "<|end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accept: tuple[str, ...] = ("answered",)
    steps: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "instructed",
            ("start", "user"): "asked",
            ("instructed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )


def escape(c: Column) -> Column:
    for plain, code in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def final_state(roles: Column, template: ChatTemplate) -> Column:
    """State of the machine after all roles; ``refused`` from the first role that has no step."""
    steps = F.create_map(*(x for (s, r), to in template.steps.items() for x in (F.lit(f"{s}\n{r}"), F.lit(to))))
    return F.aggregate(
        roles,
        F.lit(template.start),
        lambda state, role: F.coalesce(F.element_at(steps, F.concat(state, F.lit("\n"), role)), F.lit("refused")),
    )


def format_chats(
    turns: DataFrame,
    template: ChatTemplate,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, valid, segments array<struct<text,loss>>, formatted."""
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    off = F.lit(False)
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                segment(F.concat(F.lit(template.head_open), escape(t["role"]), F.lit(template.head_close)), off),
                segment(escape(t["text"]), t["role"].isin(*template.loss_roles)),
                segment(F.lit(template.turn_close), off),
            ),
        )
    )
    state = final_state(F.transform("turns", lambda t: t["role"]), template)
    return chats.select("conv_id", state.isin(*template.accept).alias("valid"), segments.alias("segments")).withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    )


def read_turns(formatted: Column, template: ChatTemplate) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    pattern = "".join(c if c.isalnum() else "\\x{%x}" % ord(c) for c in template.turn_close)
    pieces = F.split(formatted, pattern, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(p: Column) -> Column:
        head = F.substring_index(p, template.head_close, 1)
        return F.struct(
            unescape(F.substr(head, F.lit(len(template.head_open) + 1))).alias("role"),
            unescape(F.substr(p, F.length(head) + len(template.head_close) + 1)).alias("text"),
        )

    return F.transform(pieces, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
