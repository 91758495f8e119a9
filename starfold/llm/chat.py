"""Chat formatting by a finite-state machine over roles and a declarative template.

The template is a table: each role has a mark before and after its text, and whether the text counts for
the loss. The machine is a table too: which role may follow which. A turn becomes segments of text, each
with a loss flag. A text cannot pass for a control string: every control string inside a text gets one
backslash more behind its first character, and loses it again when it is read back.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = ""


@dataclass(frozen=True)
class Template:
    """Marks and loss flag per role, and the roles that may follow a role.

    ``other`` marks turns of roles that the template does not name; their role is written before ``named``.
    No mark may begin with a backslash, or hold its own first character a second time.
    """

    roles: dict[str, tuple[str, str, bool]] = field(
        default_factory=lambda: {
            "system": ("[SYS]", "[/SYS]", False),
            "user": ("[INST]", "[/INST]", False),
            "assistant": ("<s>", "</s>", True),
        }
    )
    other: tuple[str, str] = ("[TURN]", "[/TURN]")
    named: str = "[ROLE]"
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )

    def control(self, backslashes: str) -> str:
        """Pattern of a control string with ``backslashes`` behind its first character, in three groups."""
        marks = {mark for before, after, _ in self.roles.values() for mark in (before, after)}
        marks |= {*self.other, self.named}
        firsts = "|".join(sorted({rf"\Q{mark[0]}\E" for mark in marks}))
        rests = "|".join(sorted(rf"\Q{mark[1:]}\E" for mark in marks))
        return f"({firsts}){backslashes}({rests})"

    def turn(self) -> str:
        """Pattern of one whole turn of a formatted conversation."""
        pairs = [(before, after) for before, after, _ in self.roles.values()] + [self.other]
        return "(?s)" + "|".join(rf"\Q{before}\E.*?\Q{after}\E" for before, after in pairs)


DEFAULT = Template()


def escaped(text: Column, template: Template = DEFAULT) -> Column:
    """``text`` without control strings: each, with or without backslashes inside, gets one backslash more."""
    return F.regexp_replace(text, template.control(r"(\\*)"), r"$1\\$2$3")


def unescaped(text: Column, template: Template = DEFAULT) -> Column:
    """The text that ``escaped`` was given."""
    return F.regexp_replace(text, template.control(r"\\(\\*)"), "$1$2$3")


def segments(role: Column, text: Column, template: Template = DEFAULT) -> Column:
    """The segments (text, loss) of a turn: mark, text, mark. Only a text can count for the loss."""

    def segment(part: Column, loss: bool) -> Column:
        return F.struct(part.alias("text"), F.lit(loss).alias("loss"))

    def turn(before: Column, after: str, loss: bool) -> Column:
        return F.array(segment(before, False), segment(escaped(text, template), loss), segment(F.lit(after), False))

    before, after = template.other
    found = turn(F.concat(F.lit(before), escaped(role, template), F.lit(template.named)), after, False)
    for name, (before, after, loss) in template.roles.items():
        found = F.when(role == name, turn(F.lit(before), after, loss)).otherwise(found)
    return found


def is_allowed(previous: Column, role: Column, template: Template = DEFAULT) -> Column:
    """Whether the machine, having read ``previous`` (empty at the start), accepts ``role``."""
    accepted = F.lit(False)
    for state, following in template.follows.items():
        accepted = accepted | ((previous == state) & role.isin(*following))
    return accepted


def format_conversations(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation: conv_id, valid, segments (text, loss), formatted.

    Turns are ordered by turn, then role and text; a null turn comes first, null roles and texts count as empty.
    ``valid`` tells whether the machine accepts the order of the roles; invalid conversations are formatted
    all the same. Repeated rows are turns of their own. A row with a null conv_id belongs to the conversation
    null. Other columns are not read; an empty table gives an empty result. Turns are formatted where they
    lie; only finished segments of a conversation meet, as its one output row needs them. A very long turn is
    formatted whole; a conversation must fit in one row.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    turns = turns.withColumn("segments", segments(F.col("role"), F.col("text"), template))
    turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "segments"))).alias("turns"))
    roles = F.col("turns.role")
    previous = F.concat(F.array(F.lit(START)), F.slice(roles, 1, F.size(roles) - 1))
    steps = F.zip_with(previous, roles, lambda a, b: is_allowed(a, b, template))
    every = F.flatten("turns.segments")
    return turns.select(
        "conv_id",
        F.forall(steps, lambda ok: ok).alias("valid"),
        every.alias("segments"),
        F.concat_ws("", every["text"]).alias("formatted"),
    )


def read_turns(formatted: Column, template: Template = DEFAULT) -> Column:
    """The turns (role, text) of a formatted conversation."""
    found = F.regexp_extract_all(formatted, F.lit(template.turn()), F.lit(0))

    def between(turn: Column, before: str, after: str) -> Column:
        return turn.substr(F.lit(len(before) + 1), F.length(turn) - len(before) - len(after))

    def read(turn: Column) -> Column:
        inner = between(turn, *template.other)
        cut = F.instr(inner, template.named)
        role = unescaped(inner.substr(F.lit(1), cut - 1), template)
        text = inner.substr(cut + len(template.named), F.length(inner))
        for name, (before, after, _) in template.roles.items():
            known = turn.startswith(before)
            role = F.when(known, F.lit(name)).otherwise(role)
            text = F.when(known, between(turn, before, after)).otherwise(text)
        return F.struct(role.alias("role"), unescaped(text, template).alias("text"))

    return F.transform(found, read)


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Digests of the output: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid."""
    turns = read_turns(F.col("formatted"), template)
    lost = F.filter("segments", lambda s: s["loss"])
    out = formatted.withColumns({
        "turns": turns,
        "lost": F.concat_ws("", F.transform(lost, lambda s: unescaped(s["text"], template))),
    })
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("lost").cast("long").alias("loss_chars"),
        F.sha2("lost", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
