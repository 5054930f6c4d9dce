"""Chat formatting by a declarative template and a finite-state machine over roles, on built-in column functions only.

A template names for each role its label, whether its text counts for the loss, and which roles may follow which. Every turn
becomes three segments: the mark with the label, the text, and the end of the turn; the loss flag of the text is its role's,
that of the marks is false. Roles that the template doesn't know are written under ``@`` and their own name, without loss.

The machine starts at "", moves with each role if the template allows it, and stays in an error state otherwise; a
conversation is valid if its last state is a final one. Conversations that are not valid are formatted all the same.

Control strings are made of ``#``, ``<`` and, in labels, ``:``. In texts and labels these characters and the backslash are
written as a backslash and a letter, so no text can hold a control string, and reading back is exact.

Turns are ordered by turn, role and text, nulls first; repeated rows are turns of their own. Null texts and roles are empty.
A null ``conv_id`` is a conversation like any other. An empty table gives no rows, other columns are not read. One
conversation is one output row, so its turns meet in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    final: frozenset[str] = frozenset({"assistant"})
    mark: str = "### "
    colon: str = ": "
    end: str = "</turn>\n"


ESCAPES = (("\\", "\\s"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
_ERROR = "!"


def escape(text: Column, label: bool = False) -> Column:
    for raw, written in ESCAPES if label else ESCAPES[:-1]:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for raw, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


def _choose(value: Column, cases: dict[str, str], otherwise: Column) -> Column:
    return reduce(lambda chosen, case: F.when(value == case[0], F.lit(case[1])).otherwise(chosen), cases.items(), otherwise)


def final_state(turns: Column, template: Template) -> Column:
    """The state of the machine after the roles of all turns."""
    allowed = [f"{a}>{b}" for a, after in template.follows.items() for b in after]
    return F.aggregate(
        turns, F.lit(""), lambda state, t: F.when(F.concat(state, F.lit(">"), t["role"]).isin(allowed), t["role"]).otherwise(F.lit(_ERROR))
    )


def format_chat(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation: conv_id, segments (text, loss), formatted (the segments joined) and valid."""
    template = template or Template()
    empty = F.lit("")
    own = rows.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text")
    )
    turns = own.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def segments(t: Column) -> Column:
        label = _choose(t["role"], template.labels, F.concat(F.lit("@"), escape(t["role"], label=True)))
        parts = (
            (F.concat(F.lit(template.mark), label, F.lit(template.colon)), F.lit(False)),
            (escape(t["text"]), t["role"].isin(list(template.loss))),
            (F.lit(template.end), F.lit(False)),
        )
        return F.array(*[F.struct(text.alias("text"), loss.alias("loss")) for text, loss in parts])

    made = turns.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"), final_state(F.col("turns"), template).isin(list(template.final)).alias("valid"))
    return made.select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "valid")


def read_chat(formatted: Column, template: Template | None = None) -> Column:
    """The turns (role, text, loss) of a formatted conversation."""
    template = template or Template()
    roles = {label: role for role, label in template.labels.items()}

    def turn(piece: Column) -> Column:
        label = F.substring_index(piece, template.colon, 1)
        name = F.substr(label, F.lit(len(template.mark) + 1))
        role = _choose(name, roles, unescape(F.substr(name, F.lit(2))))
        text = unescape(F.substr(piece, F.length(label) + len(template.colon) + 1))
        return F.struct(role.alias("role"), text.alias("text"), role.isin(list(template.loss)).alias("loss"))

    return F.transform(F.filter(F.split(formatted, template.end), lambda p: p != ""), turn)


def digests(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """What a reader of ``formatted`` finds in each conversation, as counts and digests."""
    read = chats.select("conv_id", "formatted", "valid", read_chat(F.col("formatted"), template).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
    )
