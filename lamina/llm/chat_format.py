r"""Conversations as training text: a state machine over roles and a declarative template.

A template names the control strings around each role's text, which texts are under the
loss, and the rules of its state machine: in which state a turn of which role is in order,
the state it leads to and what stands before it. A turn out of order is formatted as well
and marked; the machine goes on in the state that its role resumes in. Everything is in
built-in functions. The machine runs over pieces of a conversation at once: each piece is a
map from states to states, and the maps are composed over the pieces.

Control strings inside texts and roles are escaped by a backslash after their first
character: `<s>` becomes `<\s>`, and `<\s>`, of which a text may also be full, `<\\s>`.
Taking one away again gives the text back, so formatted text can be read into turns.

Null texts and roles are empty ones. Turns are in the order of their number, nulls first;
equal numbers by role and text, and repeated rows stay. Rows without a conversation are one
conversation. An empty table gives an empty one. Other columns are left out, whatever their
names.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.turns import PIECE, pieces, states_before
from lamina.sources import stored

ESCAPE = "\\"


@dataclass(frozen=True)
class Marks:
    """The control strings around the text of a role, and what is under the loss."""

    opens: str
    closes: str
    loss: bool = False
    loss_on_close: bool = False


@dataclass(frozen=True)
class Rule:
    """In `state` a turn of `role` is in order: it leads to `to`, and `lead` stands before it."""

    state: str
    role: str
    to: str
    lead: str = ""


@dataclass(frozen=True)
class Template:
    """What a conversation looks like.

    Turns of a role that is not in `roles` are in `other`, whose name stands between the
    opening string and `named`. `resume` gives the state after a turn out of order; roles
    that are not in it resume in `lost`. A conversation may end in the states `ends`.
    """

    roles: Mapping[str, Marks]
    other: Marks
    named: str
    rules: tuple[Rule, ...]
    start: str
    ends: frozenset[str]
    resume: Mapping[str, str] = field(default_factory=dict)
    lost: str = "lost"

    def __post_init__(self) -> None:
        controls = self.controls
        firsts = {control[0] for control in controls}
        opens = [marks.opens for marks in self.marks]
        closes = {marks.closes for marks in self.marks}
        leads = {rule.lead for rule in self.rules}
        if len(set(opens)) < len(opens) or set(opens) & (closes | leads | {self.named}):
            raise ValueError("each role needs an opening string of its own")
        if self.named in closes | leads or closes & leads:
            raise ValueError("a control string has one meaning")
        for control in controls:
            if firsts & set(control[1:]) or ESCAPE in control:
                raise ValueError(f"{control!r} holds another control string's start or a backslash")
            if any(control != other and control.startswith(other) for other in controls):
                raise ValueError(f"{control!r} starts with another control string")
        if len({(rule.state, rule.role) for rule in self.rules}) < len(self.rules):
            raise ValueError("two rules for one state and role")

    @property
    def marks(self) -> list[Marks]:
        """Of other roles first, then of each role by its number from 1 on."""
        return [self.other, *self.roles.values()]

    @property
    def controls(self) -> list[str]:
        found = [self.named, *(rule.lead for rule in self.rules if rule.lead)]
        for marks in self.marks:
            found += [marks.opens, marks.closes]
        if "" in found:
            raise ValueError("opening and closing strings must not be empty")
        return sorted(set(found))

    @property
    def states(self) -> list[str]:
        named = [self.start, self.lost, *self.resume.values()]
        named += [name for rule in self.rules for name in (rule.state, rule.to)]
        return list(dict.fromkeys(named))


#: Instructions between tags, each exchange begun by `<s>`; only answers are under the loss.
INSTRUCT = Template(
    roles={
        "system": Marks("[SYS]", "[/SYS]"),
        "user": Marks("[INST]", "[/INST]"),
        "assistant": Marks("[ANS]", "</s>", loss=True),
    },
    other=Marks("[ROLE]", "[END]"),
    named="[/ROLE]",
    rules=(
        Rule("begun", "system", "told", lead="<s>"),
        Rule("begun", "user", "asked", lead="<s>"),
        Rule("told", "user", "asked"),
        Rule("asked", "assistant", "answered"),
        Rule("answered", "user", "asked", lead="<s>"),
    ),
    start="begun",
    ends=frozenset({"begun", "answered"}),
    resume={"system": "told", "user": "asked", "assistant": "answered"},
)


def _by_first(controls: list[str], pattern: str) -> str:
    """The pattern for each first character, joined; `{first}` and `{rests}` are filled in."""
    grouped: dict[str, list[str]] = {}
    for control in controls:
        grouped.setdefault(control[0], []).append(re.escape(control[1:]))
    return "|".join(
        pattern.format(first=re.escape(first), rests="|".join(rests))
        for first, rests in grouped.items()
    )


def escaped(text: Column, template: Template) -> Column:
    """The text with a backslash more in each control string and each escaped one."""
    found = _by_first(template.controls, r"{first}(?=\\*(?:{rests}))")
    return F.regexp_replace(text, found, r"$0\\")


def unescaped(text: Column, template: Template) -> Column:
    """The text that `escaped` was given."""
    found = _by_first(template.controls, r"(?<={first})\\(?=\\*(?:{rests}))")
    return F.regexp_replace(text, found, "")


def _listed(values: list) -> Column:
    return F.array(*[F.lit(value) for value in values])


class _Machine:
    """The template's tables, addressed by the numbers of states and roles.

    Roles are numbered from 1 on, 0 is any other; a table has a line of roles a state.
    """

    def __init__(self, template: Template) -> None:
        self.states = template.states
        self.roles = list(template.roles)
        rules = {(rule.state, rule.role): rule for rule in template.rules}
        cells = [(state, role) for state in self.states for role in (None, *self.roles)]
        place = self.states.index
        self.to = _listed(
            [
                place(rules[cell].to)
                if cell in rules
                else place(template.resume.get(cell[1], template.lost))
                for cell in cells
            ]
        )
        self.lead = _listed([rules[cell].lead if cell in rules else "" for cell in cells])
        self.in_order = _listed([cell in rules for cell in cells])
        self.ends = _listed([place(state) for state in self.states if state in template.ends])

    def role(self, name: Column) -> Column:
        return F.array_position(_listed(self.roles), name).cast("int")

    def at(self, table: Column, state: Column, role: Column) -> Column:
        return F.element_at(table, state * (len(self.roles) + 1) + role + 1)


def format_conversations(
    convs: DataFrame,
    template: Template = INSTRUCT,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    piece: int = PIECE,
) -> DataFrame:
    """The formatted pieces of each conversation, in a stored table.

    `conv_id`, `number` of the piece from 0 on, `segments` (their `turn`, `text` and whether
    it is under the `loss`), `out_of_order` (how many turns are), and for the last piece
    `complete`, whether the conversation may end so. The texts of all segments one after
    another are the training text.
    """
    rows = convs.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    machine = _Machine(template)
    coded = pieces(rows, piece).withColumn(
        "roles", F.transform("turns", lambda t: machine.role(t["role"]))
    )

    def run_through(state: Column) -> Column:
        return F.aggregate("roles", state, lambda at, code: machine.at(machine.to, at, code))

    every = _listed(list(range(len(machine.states))))
    maps = coded.select("conv", "number", F.transform(every, run_through).alias("after"))
    entered = states_before(maps, 0).withColumnsRenamed({"conv": "of", "number": "place"})
    same = F.col("conv").eqNullSafe(F.col("of")) & (F.col("number") == F.col("place"))
    states = F.aggregate(
        "roles",
        F.array("state"),
        lambda passed, code: F.concat(
            passed, F.array(machine.at(machine.to, F.element_at(passed, -1), code))
        ),
    )
    passed = coded.join(entered, same).withColumn("states", states)
    before = F.slice("states", 1, F.size("roles"))
    led = F.zip_with(before, "roles", lambda s, code: machine.at(machine.lead, s, code))
    fine = F.zip_with(before, "roles", lambda s, code: machine.at(machine.in_order, s, code))
    segments = F.flatten(
        F.zip_with("turns", "led", lambda t, lead: _segments(t, lead, template, machine))
    )
    last = F.col("number") == F.col("total") - 1
    formatted = (
        passed.withColumns({"led": led, "fine": fine})
        .select(
            F.col("conv").alias("conv_id"),
            "number",
            F.size(F.filter("fine", lambda x: ~x)).alias("out_of_order"),
            F.when(last, F.array_contains(machine.ends, F.element_at("states", -1))).alias(
                "complete"
            ),
            segments.alias("segments"),
        )
    )
    return stored(formatted, "formatted")


def _segments(turn: Column, lead: Column, template: Template, machine: _Machine) -> Column:
    """The opening string, the text and the closing string of a turn."""
    marks = template.marks
    code = machine.role(turn["role"])

    def of(values: list) -> Column:
        return F.element_at(_listed(values), code + 1)

    name = F.when(
        code == 0, F.concat(escaped(turn["role"], template), F.lit(template.named))
    ).otherwise("")

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(turn["turn"].alias("turn"), text.alias("text"), loss.alias("loss"))

    return F.array(
        segment(F.concat(lead, of([m.opens for m in marks]), name), F.lit(False)),
        segment(escaped(turn["text"], template), of([m.loss for m in marks])),
        segment(of([m.closes for m in marks]), of([m.loss_on_close for m in marks])),
    )


def formatted_text(segments: str = "segments") -> Column:
    """The training text of the segments of a piece."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def text_under_loss(template: Template = INSTRUCT, segments: str = "segments") -> Column:
    """The text of all segments under the loss, as it was before it was escaped."""
    chosen = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(chosen, lambda s: unescaped(s["text"], template)), "")


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (`role`, `text`) that a piece's training text holds."""
    marks = template.marks
    opens = "|".join(re.escape(m.opens) for m in marks)
    closes = "|".join(re.escape(close) for close in sorted({m.closes for m in marks}))
    found = F.lit(f"(?s)({opens})(.*?)(?:{closes})")
    named = F.lit(template.named)

    def turn(opened: Column, inner: Column) -> Column:
        other = opened == template.other.opens
        known = F.element_at(
            _listed(["", *template.roles]),
            F.array_position(_listed([m.opens for m in marks]), opened).cast("int"),
        )
        name = F.substring_index(inner, template.named, 1)
        rest = F.substr(inner, F.length(name) + F.length(named) + 1)
        return F.struct(
            F.when(other, unescaped(name, template)).otherwise(known).alias("role"),
            unescaped(F.when(other, rest).otherwise(inner), template).alias("text"),
        )

    return F.zip_with(
        F.regexp_extract_all(formatted, found, 1), F.regexp_extract_all(formatted, found, 2), turn
    )


def digest(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """A row a conversation, read back from its formatted pieces.

    Turns come from the training text, the text under the loss from the segments. A digest
    is of the whole conversation, so here, and only here, its pieces come together.
    """
    said = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    read = formatted.withColumn("training", formatted_text()).select(
        "conv_id",
        "number",
        "out_of_order",
        F.length("training").alias("chars"),
        read_turns(F.col("training"), template).alias("turns"),
        text_under_loss(template).alias("loss"),
    )
    parts = read.select(
        "conv_id",
        "out_of_order",
        "chars",
        F.size("turns").alias("n"),
        F.struct("number", F.array_join(said, "").alias("said"), "loss").alias("part"),
    )
    ordered = F.sort_array(F.collect_list("part"))
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.sum("out_of_order").alias("out_of_order"),
        F.array_join(F.transform(ordered, lambda p: p["said"]), "").alias("said"),
        F.array_join(F.transform(ordered, lambda p: p["loss"]), "").alias("loss"),
    )
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "out_of_order",
    )
