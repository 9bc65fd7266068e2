"""Chat formatting, in DataFrame functions only.

A declarative template names for each role the mark before a turn, the mark after it and
whether its text bears loss. A finite-state machine over roles validates the order of
turns. A formatted conversation is a list of segments, each a text with a loss flag.

Escaping: backslash, ``#`` and ``<`` inside a text or an unlisted role become ``\\\\``,
``\\h`` and ``\\l``. Marks begin with ``#`` or ``<``, so no mark can arise inside a text,
and the reverse is exact.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: state -> {role: next state}; a role without an entry is an error at that turn.
ORDER = {
    "start": {"system": "told", "user": "asked"},
    "told": {"user": "asked"},
    "asked": {"assistant": "answered"},
    "answered": {"user": "asked"},
}


@dataclass(frozen=True)
class Template:
    """``marks``: role -> name printed; other roles print as they are. ``loss``: roles learnt from."""

    marks: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss: frozenset = frozenset({"assistant"})
    before: str = "### "
    between: str = ": "
    after: str = "</turn>\n"
    order: dict = field(default_factory=lambda: ORDER)


def escape(text: Column) -> Column:
    for a, b in (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def unescape(text: Column) -> Column:
    """Split at escaped backslashes, from the left; what is between has the other two escapes only."""
    parts = F.split(text, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda x: F.replace(F.replace(x, F.lit("\\h"), F.lit("#")), F.lit("\\l"), F.lit("<"))), "\\")


def _role_mark(role: Column, template: Template) -> Column:
    """Printed name. A colon of an unlisted role would end the name, and a listed name would be taken for the role: both are marked by ``\\c``."""
    known = F.create_map(*[F.lit(x) for pair in template.marks.items() for x in pair])
    other = F.replace(escape(role), F.lit(":"), F.lit("\\c"))
    other = F.when(other.isin(*template.marks.values()), F.concat(F.lit("\\c"), other)).otherwise(other)
    return F.coalesce(F.try_element_at(known, role), other)


def _role_of(mark: Column, template: Template) -> Column:
    known = F.create_map(*[F.lit(x) for a, b in template.marks.items() for x in (b, a)])
    names = F.array(*[F.lit("\\c" + x) for x in template.marks.values()])
    plain = F.when(F.array_contains(names, mark), F.substr(mark, F.lit(3))).otherwise(mark)
    parts = F.transform(F.split(plain, r"\\\\", -1), lambda x: F.replace(x, F.lit("\\c"), F.lit(":")))
    return F.coalesce(F.try_element_at(known, mark), unescape(F.array_join(parts, "\\\\")))


def format_conversations(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, n_turns, error_turn, valid, segments and formatted text of every conversation.

    Turns are ordered by turn (null first), then role and text. A null role or text is
    an empty one. error_turn is the index of the first turn that the state machine does
    not allow (null: none); such conversations are formatted all the same. segments:
    array of (text, loss, role); joined, their texts are ``formatted``. A conversation
    is one value of the result, so its turns meet in one row. Rows with a null conv_id
    are one conversation. Only conv_id, turn, role and text are read. No rows: no rows.
    """
    t = template or Template()
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    convs = rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("x")).groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("turns"))
    step = F.create_map(*[x for state, to in t.order.items() for role, then in to.items() for x in (F.lit(f"{state}>{role}"), F.lit(then))])
    walk = F.aggregate(
        "turns",
        F.struct(F.lit("start").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("error")),
        lambda s, x: F.struct(
            F.coalesce(F.try_element_at(step, F.concat(s["state"], F.lit(">"), x["role"])), s["state"]).alias("state"),
            (s["at"] + 1).alias("at"),
            F.when(s["error"].isNull() & F.try_element_at(step, F.concat(s["state"], F.lit(">"), x["role"])).isNull(), s["at"]).otherwise(s["error"]).alias("error"),
        ),
        lambda s: s["error"],
    )

    def part(text: Column, loss: Column, role: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"), role.alias("role"))

    segments = F.flatten(F.transform("turns", lambda x: F.array(
        part(F.concat(F.lit(t.before), _role_mark(x["role"], t), F.lit(t.between)), F.lit(False), x["role"]),
        part(escape(x["text"]), x["role"].isin(*t.loss), x["role"]),
        part(F.lit(t.after), F.lit(False), x["role"]),
    )))
    return (
        convs.select("conv_id", F.size("turns").cast("long").alias("n_turns"), walk.alias("error_turn"), segments.alias("segments"))
        .withColumn("valid", F.col("error_turn").isNull())
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    )


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Adds turns: array of (role, text, loss) parsed from the formatted text alone."""
    t = template or Template()
    pieces = F.filter(F.split("formatted", _literal(t.after), -1), lambda x: x != "")

    def turn(x: Column) -> Column:
        body = F.substr(x, F.lit(len(t.before) + 1))
        mark = F.substring_index(body, t.between, 1)
        role = _role_of(mark, t)
        return F.struct(role.alias("role"), unescape(F.substr(body, F.length(mark) + len(t.between) + 1)).alias("text"), role.isin(*t.loss).alias("loss"))

    return formatted.withColumn("turns", F.transform(pieces, turn))


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"
