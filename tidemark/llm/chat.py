"""Chat formatting: a state machine over roles, and text segments with loss flags from a template.
DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Fixed values: (state, role) to the next state; a state is named after the last role.
MOVES = {
    ("begin", "system"): "system", ("begin", "user"): "user", ("system", "user"): "user",
    ("user", "assistant"): "assistant", ("assistant", "user"): "user",
    ("assistant", "tool"): "tool", ("tool", "assistant"): "assistant",
}
BROKEN = "invalid"


@dataclass(frozen=True)
class Template:
    """How a turn is written, which roles bear loss, and which turn may follow which.

    ``start`` and ``end`` must begin with ``<|``, which no escaped text contains.
    """

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>"
    after_turn: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    begin: str = "begin"
    moves: Mapping[tuple[str, str], str] = field(default_factory=lambda: dict(MOVES))
    final: tuple[str, ...] = ("assistant",)


def escape(text: Column) -> Column:
    """Text in which ``<|`` does not occur: a backslash goes between ``<``, any backslashes, and ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """Role names keep to one line and hold no control string: %, < and line ends as %XX."""
    for plain, code in (("%", "%25"), ("<", "%3C"), ("\n", "%0A")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for plain, code in (("\n", "%0A"), ("<", "%3C"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def check_order(roles: Column, template: Template) -> Column:
    """State after the last turn: the machine starts at ``begin`` and stays at ``invalid``."""
    moves = F.create_map(*[x for (s, r), to in template.moves.items() for x in (F.lit(f"{s}>{r}"), F.lit(to))])
    return F.aggregate(roles, F.lit(template.begin), lambda s, r: F.coalesce(F.element_at(moves, F.concat(s, F.lit(">"), r)), F.lit(BROKEN)))


def format_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", template: Template | None = None) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (text, loss), ``formatted`` and ``valid``.

    Turns are written in order of ``turn`` (null first; equal turns by role, then text) as one segment
    that opens the turn, one with the escaped text, which bears loss for the template's loss roles, and
    one that closes it. Null roles and texts are empty. Every conversation is formatted; ``valid`` says
    whether its order of roles is one the state machine accepts and ends in a final state. Rows without
    a conversation id form one conversation of id null; repeated rows are turns of their own. A
    conversation is one record and so one row; only its own turns ever meet. No rows give none.
    """
    t = template or Template()
    pack = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    convs = rows.select(F.col(conv_id).alias("conv_id"), pack.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def written(x: Column) -> Column:
        loss = x["role"].isin(*t.loss_roles) if t.loss_roles else F.lit(False)
        opened = F.concat(F.lit(t.start), escape_role(x["role"]), F.lit(t.after_role))
        parts = ((opened, F.lit(False)), (escape(x["text"]), loss), (F.lit(t.end + t.after_turn), F.lit(False)))
        return F.array(*[F.struct(a.alias("text"), b.alias("loss")) for a, b in parts])

    state = check_order(F.col("turns.role"), t)
    out = convs.select("conv_id", F.flatten(F.transform("turns", written)).alias("segments"), state.isin(*t.final).alias("valid"))
    return out.select("conv_id", "segments", F.concat_ws("", "segments.text").alias("formatted"), "valid")


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    t = template or Template()
    pieces = F.split(formatted, "\\Q" + t.end + t.after_turn + "\\E")
    turns = F.filter(pieces, lambda p: p.startswith(t.start))

    def turn(p: Column) -> Column:
        at = F.instr(p, F.lit(t.after_role))
        role = F.substring(p, F.lit(len(t.start) + 1), at - 1 - len(t.start))
        return F.struct(unescape_role(role).alias("role"), unescape(F.substring(p, at + len(t.after_role), F.length(p))).alias("text"))

    return F.transform(turns, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing in between."""
    return F.concat_ws("", F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])))
