"""Chat formatting: a finite-state machine over roles and a declarative template.

A template says, for each role, what opens and closes a turn, and whether the text of the turn is learned. The
output is a list of segments (text, loss). Control strings inside texts are escaped reversibly: every character
that can begin a control string is followed by a mark, and the mark's own character is doubled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Turn:
    opens: str
    closes: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``turns`` by role; ``other`` for any other role, whose name stands, escaped, behind ``opens`` and before ``named``.

    ``moves`` are the allowed steps from role to role; the start is ''. All of ``opens``, ``closes`` and
    ``named`` are control strings and begin with one of ``guarded``.
    """

    turns: dict[str, Turn]
    moves: dict[str, tuple[str, ...]]
    other: Turn = field(default_factory=lambda: Turn("<<ROLE>>", "</TURN>"))
    named: str = "<</ROLE>>"
    guarded: str = "<["

    def __post_init__(self):
        if not all(s[:1] and s[0] in self.guarded for s in self.controls()):
            raise ValueError("each control string must begin with a guarded character")
        if len({t.opens for t in self.all_turns()}) <= len(self.turns):
            raise ValueError("each role needs an opening of its own")

    def all_turns(self) -> list[Turn]:
        return [*self.turns.values(), self.other]

    def controls(self) -> list[str]:
        return [*(s for t in self.all_turns() for s in (t.opens, t.closes)), self.named]


INSTRUCT = Template(
    turns={
        "system": Turn("<<SYS>>\n", "<</SYS>>\n"),
        "user": Turn("[INST] ", "[/INST]\n"),
        "assistant": Turn("<s>", "</s>\n", loss=True),
    },
    moves={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
)


def escaped(text: Column, template: Template) -> Column:
    """``text`` in which no control string can be found, neither alone nor with what stands around it."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in template.guarded:
        text = F.replace(text, F.lit(c), F.lit(f"{c}\\."))
    return text


def unescaped(text: Column, template: Template) -> Column:
    guarded = "".join(re.escape(c) for c in template.guarded)
    return F.regexp_replace(text, rf"([{guarded}])\\\.|\\(\\)", "$1$2")


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def formatted(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, segments, formatted.

    Rows are ordered by turn, then role and text; a null turn comes first. A null text or role counts as
    empty, a role that the template does not name is written by its name. All rows are formatted; ``valid``
    tells whether the roles follow the template's moves and end in a role other than the system's. Rows that repeat
    are turns of their own. A null conv_id is a conversation too. Other columns are not looked at.

    A conversation is one value of the output, so its rows meet in one task; what bounds it is that the value
    must fit into a row.
    """
    turns = conversations.select(
        "conv_id",
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"),
    )
    turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    steps = [f"{a}>{b}" for a, ends in template.moves.items() for b in ends]
    walk = F.aggregate(
        "turns",
        F.struct(F.lit("").alias("at"), F.lit(True).alias("ok")),
        lambda s, t: F.struct(t["role"].alias("at"), (s["ok"] & F.concat(s["at"], F.lit(">"), t["role"]).isin(steps)).alias("ok")),
        lambda s: s["ok"] & (s["at"] != "system"),
    )

    def segments(t: Column) -> Column:
        opens, closes, loss = F.concat(F.lit(template.other.opens), escaped(t["role"], template), F.lit(template.named)), F.lit(template.other.closes), F.lit(template.other.loss)
        for role, turn in template.turns.items():
            here = t["role"] == role
            opens, closes, loss = F.when(here, turn.opens).otherwise(opens), F.when(here, turn.closes).otherwise(closes), F.when(here, turn.loss).otherwise(loss)
        part = lambda text, learned: F.struct(text.alias("text"), learned.alias("loss"))
        return F.array(part(opens, F.lit(False)), part(escaped(t["text"], template), loss), part(closes, F.lit(False)))

    out = turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), walk.alias("valid"), F.flatten(F.transform("turns", segments)).alias("segments")
    )
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(texts: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Adds ``turns`` (role, text, loss), read from the column ``formatted`` alone."""
    body = "((?:[^" + "".join(re.escape(c) for c in template.guarded) + "]|[" + "".join(re.escape(c) for c in template.guarded) + r"]\\\\\.)*+)"
    body = body.replace("\\\\\\\\", "\\\\")
    spans = [re.escape(t.opens) + body + re.escape(t.closes) for t in template.turns.values()]
    spans.append(re.escape(template.other.opens) + body + re.escape(template.named) + body + re.escape(template.other.closes))
    pattern = "|".join(spans)
    whole = F.expr(f"regexp_extract_all(formatted, {_sql(pattern)}, 0)")

    def turn(span: Column) -> Column:
        o = template.other
        inner = lambda opens, closes: F.substring(span, F.lit(len(opens) + 1), F.char_length(span) - (len(opens) + len(closes)))
        named = inner(o.opens, o.closes)
        role, text, loss = F.substring_index(named, template.named, 1), F.substring_index(named, template.named, -1), F.lit(o.loss)
        for name, t in template.turns.items():
            here = F.startswith(span, F.lit(t.opens))
            role, text, loss = F.when(here, name).otherwise(role), F.when(here, inner(t.opens, t.closes)).otherwise(text), F.when(here, t.loss).otherwise(loss)
        return F.struct(unescaped(role, template).alias("role"), unescaped(text, template).alias("text"), loss.alias("loss"))

    return texts.withColumn("turns", F.transform(whole, turn))


def digests(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Per conversation what the formatted text holds, read back from it."""
    back = read_back(formatted(conversations, template).select("conv_id", "valid", "formatted"), template)
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


ORACLE_SQL = r"""
with given as (
    select conv_id, turn, role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), rows as (
    select conv_id, turn, role, text,
        length(text) + length(text) - length(replace(text, '\', ''))
            + 2 * (length(text) - length(replace(replace(text, '<', ''), '[', ''))) as n_escaped,
        case role when 'system' then 8 + 9 when 'user' then 7 + 8 else 3 + 5 end as n_marks,
        lag(role) over (partition by conv_id order by turn) as before
    from given
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
    cast(sum(n_escaped + n_marks) as bigint) as formatted_chars,
    bool_and(case when before is null then role in ('system', 'user') when role = 'user' then before in ('system', 'assistant')
        when role = 'assistant' then before = 'user' else false end) and arg_max(role, turn) <> 'system' as valid
from rows group by conv_id
"""
