"""Chat formatting with column functions only.

A declarative :class:`Template` gives the text around each turn, the roles whose
texts carry loss, the control strings with their escapes, and a finite-state
machine over roles.  Each turn becomes three segments (opening, text, closing)
with a loss flag each; the concatenation of all segments is the formatted
conversation and can be read back without loss.

Turns are ordered by ``turn`` (null first), then role, then text.  The rows of
one conversation are put together in two steps: blocks of ``BLOCK`` turn numbers
are formatted in parallel, and a block also yields where the machine ends from
each possible state; then blocks are joined.  A null text is empty, a null role
is the empty role, which no machine accepts; both are still formatted.  Rows
with a null conv_id form one conversation.  An empty table gives no rows, and
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64
BROKEN = "broken"
TURN = "struct<turn:bigint,role:string,text:string>"


@dataclass(frozen=True)
class Template:
    opening: tuple[str, str] = ("<turn ", ">\n")
    closing: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Escapes of the characters that control strings consist of.  The first is the escape character itself.
    escapes: tuple[tuple[str, str], ...] = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
    start: str = "start"
    accepting: tuple[str, ...] = ("answered",)
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "instructed",
            ("start", "user"): "asked",
            ("instructed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )

    @property
    def states(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([self.start, *(s for s, _ in self.moves), *self.moves.values()]))


def escape(text: Column, template: Template) -> Column:
    for plain, coded in template.escapes:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, template: Template) -> Column:
    """Each escape character in escaped text begins one escape, so the last can be undone first."""
    for plain, coded in reversed(template.escapes):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def segments(turn: Column, template: Template) -> Column:
    """The three segments of a turn: struct(text, loss)."""
    loss = turn["role"].isin(*template.loss_roles)
    part = lambda text, flag: F.struct(text.alias("text"), flag.alias("loss"))
    head = F.concat(F.lit(template.opening[0]), escape(turn["role"], template), F.lit(template.opening[1]))
    return F.array(part(head, F.lit(False)), part(escape(turn["text"], template), loss), part(F.lit(template.closing), F.lit(False)))


def _walk(roles: Column, state: Column, template: Template) -> Column:
    moves = F.create_map(*[F.lit(x) for (s, r), to in template.moves.items() for x in (f"{s}\n{r}", to)])
    step = lambda at, role: F.coalesce(F.try_element_at(moves, F.concat(at, F.lit("\n"), role)), F.lit(BROKEN))
    return F.aggregate(roles, state, step)


def format_blocks(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, block, segments (text, loss), and ends (state reached from each state): one row per block of turns."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    block = F.floor(F.col("turn").cast("long") / BLOCK)
    blocks = conversations.select("conv_id", block.alias("block"), turn.alias("one")).groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    roles = F.transform("turns", lambda t: t["role"])
    ends = F.create_map(*[x for s in template.states for x in (F.lit(s), _walk(roles, F.lit(s), template))])
    return blocks.select("conv_id", "block", F.flatten(F.transform("turns", lambda t: segments(t, template))).alias("segments"), ends.alias("ends"))


def render(blocks: DataFrame) -> DataFrame:
    """conv_id, block, formatted, loss_spans and ends of the rows of ``format_blocks``.

    ``loss_spans`` are (start, length) in characters of the block's ``formatted``,
    one for each text that carries loss.
    """
    span = "array<struct<start:bigint,length:bigint>>"
    walked = F.aggregate(
        "segments",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(span).alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + F.length(s["text"])).alias("at"),
            F.when(s["loss"], F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), F.length(s["text"]).cast("long").alias("length"))))).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    return blocks.select("conv_id", "block", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), walked["spans"].alias("loss_spans"), "ends")


def accepted(blocks: Column, template: Template) -> Column:
    """Whether the machine accepts, from the entries of ``ends`` of all blocks in order."""
    state = F.aggregate(blocks, F.lit(template.start), lambda at, b: F.coalesce(F.try_element_at(F.map_from_entries(b["ends"]), at), F.lit(BROKEN)))
    return state.isin(*template.accepting)


def validity(blocks: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id and valid: whether the machine accepts the roles in order.  Only block ends are gathered."""
    gathered = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", F.map_entries("ends").alias("ends")))).alias("blocks"))
    return gathered.select("conv_id", accepted(F.col("blocks"), template).alias("valid"))


def read_back(rendered: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, block, turns (role and text, in order) and loss_texts, from ``formatted`` and ``loss_spans`` alone; ``ends`` as it is."""
    pieces = F.filter(F.split("formatted", "\\Q" + template.closing + "\\E"), lambda p: p != "")
    head, tail = len(template.opening[0]), len(template.opening[1])
    opened = lambda p: F.substring_index(p, template.opening[1], 1)
    turn = lambda p: F.struct(
        unescape(F.substr(opened(p), F.lit(head + 1)), template).alias("role"),
        unescape(F.substr(p, F.length(opened(p)) + F.lit(tail + 1)), template).alias("text"),
    )
    lost = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")), template))
    return rendered.select("conv_id", "block", F.length("formatted").cast("long").alias("chars"), F.transform(pieces, turn).alias("turns"), lost.alias("loss_texts"), "ends")


def digests(read: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation with counts and digests of what ``read_back`` found, and whether its turn order is valid.

    A digest needs its whole text; blocks are made strings before they meet.
    """
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    blocks = read.select("conv_id", "chars", F.size("turns").cast("long").alias("n"), F.struct("block", lines.alias("turns"), F.array_join("loss_texts", "").alias("loss"), F.map_entries("ends").alias("ends")).alias("one"))
    whole = blocks.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("one")).alias("blocks"))
    text = lambda name: F.array_join(F.transform("blocks", lambda b: b[name]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(text("turns"), 256).alias("turns_sha256"),
        F.length(text("loss")).cast("long").alias("loss_chars"),
        F.sha2(text("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
        accepted(F.col("blocks"), template).alias("valid"),
    )
