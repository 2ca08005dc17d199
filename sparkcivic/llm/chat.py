"""Chat formatting: a role state machine and loss-flagged text segments.

A conversation becomes one string of turns, cut into segments that each carry
a loss flag. Everything is built from DataFrame functions: one shuffle groups
the turns of a conversation, all the rest is array expressions.

A template is data: the marks around a turn, the roles whose text is trained
on, and the allowed role transitions. Control strings that occur inside a
text are replaced by a backslash code (and the backslash by its own code), so
no text can forge a mark and ``read_back`` restores every turn exactly.

Defined results
  * Turns are ordered by ``turn``; NULL turns first; ties by role, then text,
    so repeated rows are all kept, next to one another.
  * NULL text or role counts as empty. A role outside the template is written
    like the others and never trained on; it makes the conversation invalid.
  * Rows with a NULL conversation id form one conversation with a NULL id.
  * An empty table gives an empty result. Only the four named columns are
    read, so further columns cannot clash.
  * A conversation is one output row and must fit a task, as its formatted
    text is one value; its rows are combined before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "start", "end"


@dataclass(frozen=True)
class ChatTemplate:
    """``opening + role + after_role + text + closing`` for each turn."""

    opening: str = "### "
    after_role: str = ": "
    closing: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: written role names, by role; other roles are written as they are
    names: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    #: allowed steps of the state machine; a state is the last role
    steps: dict = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", END), })
    #: (control string, its code); the backslash must come first
    escapes: tuple = (("\\", "\\-"), ("### ", "\\h"), ("</turn>", "\\t"))


DEFAULT = ChatTemplate()


def escape(text: Column, t: ChatTemplate = DEFAULT) -> Column:
    for raw, code in t.escapes:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column, t: ChatTemplate = DEFAULT) -> Column:
    # every backslash of an escaped text starts exactly one code, so the codes cannot overlap
    for raw, code in reversed(t.escapes):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def _named(role: Column, t: ChatTemplate) -> Column:
    """The written form of a role; one that is not in the template gets a
    ``?`` in front and its colons coded, so that it can be read back."""
    out = F.concat(F.lit("?"), F.replace(escape(role, t), F.lit(":"), F.lit("\\c")))
    for k, v in t.names.items():
        out = F.when(role == k, F.lit(v)).otherwise(out)
    return out


def _role_of(name: Column, t: ChatTemplate) -> Column:
    out = unescape(F.replace(F.substr(name, F.lit(2)), F.lit("\\c"), F.lit(":")), t)
    for k, v in t.names.items():
        out = F.when(name == v, F.lit(k)).otherwise(out)
    return out


def format_chats(df: DataFrame, t: ChatTemplate = DEFAULT, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (array of
    ``text, loss``; their concatenation is the formatted text), ``valid``
    (the state machine accepts the roles), ``bad_turn`` (place of the first
    turn that it does not accept, from 0; NULL if none)."""
    empty = F.lit("")
    turns = df.select(F.col(conv).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), empty).alias("role"),
        F.coalesce(F.col(text), empty).alias("text")).alias("t"))
    turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    allowed = F.array(*[F.lit(f"{a}>{b}") for a, bs in t.steps.items() for b in bs])
    walk = F.aggregate(  # state: last role, turns read, place of the first bad one
        "turns", F.struct(F.lit(START).alias("at"), F.lit(0).alias("n"), F.lit(-1).alias("bad")),
        lambda s, x: F.struct(
            x["role"].alias("at"), (s["n"] + 1).alias("n"),
            F.when((s["bad"] < 0) & ~F.array_contains(allowed, F.concat(s["at"], F.lit(">"), x["role"])), s["n"])
            .otherwise(s["bad"]).alias("bad")))
    seg = lambda x, loss: F.struct(x.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("turns", lambda x: F.array(
        seg(F.concat(F.lit(t.opening), _named(x["role"], t), F.lit(t.after_role)), F.lit(False)),
        seg(escape(x["text"], t), x["role"].isin(*t.loss_roles)),
        seg(F.lit(t.closing), F.lit(False)))))
    return (turns.withColumn("w", walk)
            .select("conv_id", segments.alias("segments"),
                    ((F.col("w.bad") < 0) & F.array_contains(allowed, F.concat(F.col("w.at"), F.lit(f">{END}"))))
                    .alias("valid"),
                    F.when(F.col("w.bad") >= 0, F.col("w.bad")).alias("bad_turn")))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column, t: ChatTemplate = DEFAULT) -> Column:
    """All text under the loss mask, unescaped."""
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""), t)


def read_back(text: Column, t: ChatTemplate = DEFAULT) -> Column:
    """Array of ``role, text`` from a formatted text alone."""
    parts = F.split(text, f"\\Q{t.closing}\\E")  # the last part is what follows the last turn: nothing
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def one(p: Column) -> Column:
        body = F.substr(p, F.lit(len(t.opening) + 1))
        cut = F.instr(body, t.after_role)
        return F.struct(_role_of(F.substr(body, F.lit(1), cut - 1), t).alias("role"),
                        unescape(F.substr(body, cut + len(t.after_role)), t).alias("text"))
    return F.transform(parts, one)
