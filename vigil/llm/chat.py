"""Chat formatting with a finite-state machine over roles, in SQL functions.

A template declares how a turn is marked, which roles carry loss, and which
role may follow which. Control characters inside texts are replaced by
two-character escapes, so a marker can only be a marker and the formatted
string can be read back exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

START, REJECT = "start", "reject"


@dataclass(frozen=True)
class ChatTemplate:
    """``### role: text</turn>`` by default. ``escapes`` lists (character, code
    letter): the character is written as a backslash and its letter. The
    backslash comes first, and every marker must hold an escaped character."""

    begin: str = "### "
    colon: str = ": "
    end: str = "</turn>\n"
    roles: tuple[str, ...] = ("system", "user", "assistant")
    loss_roles: tuple[str, ...] = ("assistant",)
    escapes: tuple[tuple[str, str], ...] = (("\\", "b"), ("#", "h"), ("<", "l"))
    role_escapes: tuple[tuple[str, str], ...] = ((":", "c"),)
    #: state, role -> next state; whatever isn't listed is rejected
    transitions: dict[tuple[str, str], str] = field(default_factory=lambda: {
        (START, "system"): "system", (START, "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user"})
    accepting: tuple[str, ...] = ("assistant",)


def escape(text: Column, escapes) -> Column:
    for char, code in escapes:
        text = F.replace(text, F.lit(char), F.lit("\\" + code))
    return text


def unescape(text: Column, escapes) -> Column:
    """Inverse of ``escape``: in an escaped text each backslash starts an
    escape, so the backslash's own escape can be undone last."""
    for char, code in reversed(escapes):
        text = F.replace(text, F.lit("\\" + code), F.lit(char))
    return text


def _label(role: Column, t: ChatTemplate) -> Column:
    """A declared role is its own label; any other gets an escape before it,
    which no declared role can begin with."""
    return F.when(role.isin(*t.roles), role).otherwise(
        F.concat(F.lit("\\u"), escape(role, t.escapes + t.role_escapes)))


def format_chat(turns: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per conv_id (null is a conversation too): ``segments``
    (array of text and loss flag), ``formatted`` (the segments joined),
    ``final_state`` and ``valid`` (the machine accepted the turn order).

    Turns are ordered by turn, ties by role and text; repeated rows are turns
    of their own. Null text or role counts as empty. Conversations that the
    machine rejects are formatted all the same and marked. Other columns are
    ignored; no rows give no rows. A conversation becomes one string, so one
    conversation (not a group of them) must fit a task.
    """
    t = template or ChatTemplate()
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    grouped = (turns.select("conv_id", F.struct("turn", blank("role").alias("role"), blank("text").alias("text")).alias("x"))
               .groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("turns")))
    steps = F.create_map(*[F.lit(x) for (s, r), to in t.transitions.items() for x in (f"{s}>{r}", to)])
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("turns", lambda x: F.array(
        segment(F.concat(F.lit(t.begin), _label(x["role"], t), F.lit(t.colon)), F.lit(False)),
        segment(escape(x["text"], t.escapes), x["role"].isin(*t.loss_roles)),
        segment(F.lit(t.end), F.lit(False)))))
    state = F.aggregate("turns", F.lit(START), lambda s, x: F.coalesce(
        F.element_at(steps, F.concat(s, F.lit(">"), x["role"])), F.lit(REJECT)))
    return (grouped.select("conv_id", segments.alias("segments"), state.alias("final_state"))
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
            .withColumn("valid", F.col("final_state").isin(*t.accepting)))


def read_turns(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """Array of (role, text) read back from a formatted string."""
    t = template or ChatTemplate()
    literal = "".join("\\" + c if c in "\\.[]{}()<>*+-=!?^$|&#" else c for c in t.end)     # no pattern, whatever the template
    parts = F.split(formatted, literal)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        body = F.substr(part, F.lit(len(t.begin) + 1))
        label = F.substring_index(body, t.colon, 1)
        return F.struct(
            F.when(F.startswith(label, F.lit("\\u")),
                   unescape(F.substr(label, F.lit(3)), t.escapes + t.role_escapes)).otherwise(label).alias("role"),
            unescape(F.substr(body, F.length(label) + F.lit(len(t.colon) + 1)), t.escapes).alias("text"))

    return F.transform(parts, turn)


def read_loss_text(segments: Column, template: ChatTemplate | None = None) -> Column:
    """All text under the loss mask, unescaped, in order."""
    t = template or ChatTemplate()
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""),
                    t.escapes)


def digests(formatted: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Counts and SHA-256 digests, all read back from the formatted output."""
    read = read_turns(F.col("formatted"), template)
    return (formatted.withColumn("t", read).withColumn("loss", read_loss_text(F.col("segments"), template))
            .select("conv_id", F.size("t").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(F.transform("t", lambda x: F.concat(
                        x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2(F.col("loss"), 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"),
                    "valid"))
