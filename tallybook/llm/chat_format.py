"""Training texts of conversations, rebuilt from logs of events.

A log has events (conv_id, seq, kind, turn, role, text). Each is about the message at a turn of
its conversation:

    message     a whole message; several at one turn stand one after the other
    delta       a piece that is added to the turn's message
    edit        the text that the turn's message has from now on
    regenerate  the turn's message, and all that was said after it, is taken back; what follows
                is its new text, of which the event may hold the first piece

The fold of a conversation, by its sequence, is stated per turn: an event is dead if a later
regeneration is of its turn or an earlier one, so what a turn needs from the others is one number,
the largest such sequence number. Conversations are cut into parts of a fixed number of turns, so
that a conversation of any length is folded and rendered by many tasks, and the texts are shuffled
once. The numbers that parts need from earlier ones come from the log without its texts.

A template marks turns. Strings that control it, or other common templates, are escaped inside
texts by a mark after their first character, one more than they had, so that it can be undone.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.shared import require_columns

EVENT_COLUMNS = ("conv_id", "seq", "kind", "turn", "role", "text")
KINDS = ("message", "delta", "edit", "regenerate")
#: Before all sequence numbers, and the part of the messages without a turn, behind all others.
_FIRST, _LAST_PART = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class Template:
    """turn, end: around a message, whose first line is its role. controls: escaped in texts.

    trained: roles whose texts are under the loss mask. turns: of a part of a conversation.

    No control may hold the first character of one, or the escape, behind its own first
    character: then escaping one neither makes nor breaks another.
    """

    turn: str = "<|turn|>"
    end: str = "<|end|>\n"
    controls: tuple[str, ...] = (
        "<|", "<s>", "</s>", "<SYS>>", "</SYS>>", "[INST]", "[/INST]",
    )
    escape: str = "\\"
    trained: tuple[str, ...] = ("assistant",)
    turns: int = 128

    def __post_init__(self) -> None:
        first = {control[:1] for control in self.controls} | {self.escape}
        if len(self.escape) != 1 or self.turns < 1 or "" in first:
            raise ValueError(f"not a template: {self}")
        if any(first & set(control[1:]) or len(control) < 2 for control in self.controls):
            raise ValueError(f"controls that cannot be told apart: {self.controls}")
        for mark in (self.turn, self.end):
            if not mark.startswith(self.controls):
                raise ValueError(f"a mark that texts may hold: {mark!r}")

    def _controls(self, behind: str) -> str:
        """The first characters of controls, each a group, and what stands behind them."""
        rests = defaultdict(list)
        for control in self.controls:
            rests[control[0]].append(re.escape(control[1:]))
        marks = f"{re.escape(self.escape)}*"
        return "|".join(
            f"({re.escape(c)}){behind}(?={marks}(?:{'|'.join(rest)}))" for c, rest in rests.items()
        )

    def escaped(self, text: Column) -> Column:
        # A backslash before the mark, whatever it is, so that it stands for itself.
        return F.regexp_replace(text, self._controls(""), f"$0\\{self.escape}")

    def unescaped(self, text: Column) -> Column:
        # Of the groups only one has matched; the others are empty.
        groups = len({control[0] for control in self.controls})
        kept = "".join(f"${i + 1}" for i in range(groups))
        return F.regexp_replace(text, self._controls(re.escape(self.escape)), kept)

    def header(self, role: Column) -> Column:
        """A role as one line."""
        line = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
        return self.escaped(line)

    def role(self, header: Column) -> Column:
        line = self.unescaped(header)
        return F.replace(F.replace(line, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def events_of_turns(turns: DataFrame) -> DataFrame:
    """The log of finished conversations (conv_id, turn, role, text): a message for each row."""
    require_columns(turns, "conv_id", "turn", "role", "text")
    return turns.select(
        "conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), "turn", "role", "text"
    )


def final_messages(events: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, conv, part, n, parts, turn, seq, role, text): the messages that a log ends with.

    ``part`` numbers the parts of a conversation with gaps, ``n`` without, from 1; ``parts`` is
    their number. Rows are dealt by (conv, part), where ``conv`` stands for conv_id.

    Events without a conversation are one conversation, those without a turn are about one
    message after all others, those without a sequence number come first and those without a
    kind are messages; a kind that is not known raises. Null texts are empty, null roles are too.
    A stream's role is the last one that its living events name. Messages at one turn are ordered
    by sequence, role and text. A whole message that repeats is one of its own; of other events a
    row that repeats is the same one, delivered again. Of equal sequence numbers a delta comes
    before an edit and that before a regeneration. Other columns are ignored, and an empty
    log gives no rows.
    """
    require_columns(events, *EVENT_COLUMNS)
    kind = F.coalesce("kind", F.lit("message"))
    known = F.when(kind.isin(*KINDS), kind).otherwise(
        F.raise_error(F.concat(F.lit("not a kind of event: "), kind))
    )
    log = events.select(
        "conv_id",
        # Never null, so that plain equality finds it and the deal by it holds.
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
        F.coalesce(F.expr(f"CAST(turn AS bigint) DIV {template.turns}"), F.lit(_LAST_PART)).alias("part"),
        F.coalesce("seq", F.lit(_FIRST)).alias("seq"),
        known.alias("kind"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("role").isNotNull().alias("named"),
    )
    restart = F.when(F.col("kind") == "regenerate", F.col("seq"))
    before = Window.partitionBy("conv").orderBy("part")
    parts = (
        log.groupBy("conv", "part")
        .agg(F.max(restart).alias("restart"))
        .select(
            "conv",
            "part",
            F.max("restart").over(before.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"),
            F.row_number().over(before).alias("n"),
            F.count(F.lit(1)).over(Window.partitionBy("conv")).alias("parts"),
        )
    )
    whole = F.col("kind") == "message"
    streamed = F.struct(
        "seq", "kind", "text", F.when(F.col("named"), F.col("role")).alias("role")
    )
    slots = (
        log.repartition("conv", "part")
        .join(parts, ["conv", "part"])
        .groupBy("conv", "part", "conv_id", "n", "parts", "earlier", "turn",
                 F.when(whole, F.struct("role", "text", "seq")).alias("whole"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.max(restart).alias("restart"),
            F.array_sort(F.collect_set(F.when(~whole, streamed))).alias("log"),
        )
    )
    # Slots of one turn are peers, so a regeneration reaches whole messages at its turn, too.
    by_turn = (
        Window.partitionBy("conv", "part")
        .orderBy(F.asc_nulls_last("turn"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    dead_up_to = F.greatest(F.max("restart").over(by_turn), F.col("earlier"))
    living = F.filter(
        "log",
        lambda e: F.col("dead").isNull()
        | (e["seq"] > F.col("dead"))
        | ((e["seq"] == F.col("dead")) & (e["seq"] == F.col("restart")) & (e["kind"] == "regenerate")),
    )
    last_edit = F.array_max(
        F.transform("log", lambda e, i: F.when(e["kind"] == "edit", i).otherwise(F.lit(0)))
    )
    text = F.array_join(F.transform(F.expr("slice(log, base + 1, size(log))"), lambda e: e["text"]), "")
    named = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    folded = (
        slots.withColumn("dead", dead_up_to)
        .withColumn("log", living)
        .where(
            F.when(F.col("whole").isNull(), F.size("log") > 0).otherwise(
                F.col("dead").isNull() | (F.col("whole.seq") > F.col("dead"))
            )
        )
        .withColumn("base", last_edit)
    )
    one = F.lit(1).cast("long")
    return folded.select(
        "conv_id", "conv", "part", "n", "parts", "turn",
        F.coalesce("whole.seq", F.get("log", F.lit(0))["seq"]).alias("seq"),
        F.coalesce("whole.role", F.try_element_at(named, F.lit(-1)), F.lit("")).alias("role"),
        F.when(F.col("whole").isNull(), text).otherwise(F.col("whole.text")).alias("text"),
        F.explode(
            F.sequence(one, F.when(F.col("whole").isNull(), one).otherwise(F.col("rows")))
        ).alias("copy"),
    ).drop("copy")


def format_conversations(events: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, conv, n, parts, n_turns, formatted, loss): the text of every part.

    The text of a conversation is that of its parts in the order of ``n``. ``loss`` has the
    places under the loss mask, (start, length) in code points of the part: the texts, as they
    are escaped, of the trained roles. Odd rows are as in ``final_messages``. A conversation of
    which every message was taken back has no row.
    """
    messages = final_messages(events, template)
    escaped = template.escaped(F.col("text"))
    head = F.concat(F.lit(template.turn), template.header(F.col("role")), F.lit("\n"))
    pieces = messages.select(
        "conv_id", "conv", "part", "n", "parts", "turn", "seq", "role", "text",
        head.alias("head"), escaped.alias("body"),
    )
    order = (F.asc_nulls_last("turn"), "seq", "role", "text")
    inside = Window.partitionBy("conv", "part").orderBy(*order)
    length = F.length("head") + F.length("body") + len(template.end)
    placed = pieces.select(
        "conv_id", "conv", "part", "n", "parts", "role", "head", "body",
        F.row_number().over(inside).alias("place"),
        F.coalesce(
            F.sum(length).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).cast("int").alias("start"),
    )
    span = F.struct(
        (F.col("start") + F.length("head")).alias("start"), F.length("body").alias("length")
    )
    piece = F.struct("place", F.concat("head", "body", F.lit(template.end)).alias("piece"))
    return (
        placed.groupBy("conv", "part", "conv_id", "n", "parts")
        .agg(
            F.count(F.lit(1)).alias("n_turns"),
            F.array_sort(F.collect_list(piece)).alias("pieces"),
            F.array_sort(
                F.collect_list(F.when(F.col("role").isin(*template.trained), span))
            ).alias("loss"),
        )
        .select(
            "conv_id", "conv", "n", "parts", "n_turns",
            F.array_join("pieces.piece", "").alias("formatted"),
            "loss",
        )
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The messages that a rendered text holds, as an array of (role, text)."""
    # What stands before the first mark is nothing.
    parts = F.slice(F.split(formatted, re.escape(template.turn)), F.lit(2), F.length(formatted) + 1)

    def message(part: Column) -> Column:
        header = F.substring_index(part, "\n", 1)
        # From behind the line of the role to the mark at the end.
        at = F.length(header) + 2
        body = F.substring(part, at, F.length(part) - at - (len(template.end) - 1))
        return F.struct(
            template.role(header).alias("role"), template.unescaped(body).alias("text")
        )

    return F.transform(parts, message)


def read_loss(formatted: Column, loss: Column, template: Template = Template()) -> Column:
    """The texts under the loss mask of a rendered text, as an array."""

    def text(place: Column) -> Column:
        return template.unescaped(F.substring(formatted, place["start"] + 1, place["length"]))

    return F.transform(loss, text)


def conversation_digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """What the rendered texts hold, read back from them and their masks; a row a conversation.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars): the digests are
    of role, \\n, text, \\n of every message, and of the texts under the mask, one after the other.
    Parts are read where they are. Only conversations of several parts are put together, where a
    digest of the whole needs all of a conversation's text in one value: up to 2 GB.
    """
    whole = F.col("formatted")
    lines = F.transform("read", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n")))
    read = formatted.select(
        "conv_id", "conv", "n", "parts",
        read_turns(whole, template).alias("read"),
        F.array_join(read_loss(whole, F.col("loss"), template), "").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id", "conv", "n", "parts",
        F.size("read").cast("long").alias("n_turns"),
        F.array_join(lines, "").alias("turns"), "loss", "formatted_chars",
    )
    several = (
        read.where("parts > 1")
        .groupBy("conv", "conv_id")
        .agg(
            F.sum("n_turns").alias("n_turns"),
            F.array_sort(F.collect_list(F.struct("n", "turns", "loss"))).alias("all"),
            F.sum("formatted_chars").alias("formatted_chars"),
        )
        .select(
            "conv_id", "n_turns",
            F.array_join("all.turns", "").alias("turns"),
            F.array_join("all.loss", "").alias("loss"),
            "formatted_chars",
        )
    )
    single = read.where("parts = 1").select("conv_id", "n_turns", "turns", "loss", "formatted_chars")
    return single.unionByName(several).select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
