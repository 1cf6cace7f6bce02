"""Chat formatting: layouts found by the hash of their field paths, one template, a loss mask.

Built-in functions only. The fingerprint of a record is the hash of its field paths, of those
that some mapping names; further fields are ignored. A declarative mapping to canonical turns
(role, text) is chosen if the record's paths that this mapping names hash as the mapping's own
do; of several, a list of turns goes first, then the one that names more paths. JSON records
carry their paths each for itself; of a table by turn, those of the schema are taken once.

The template writes START role SEPARATOR text END per turn. Inside roles and texts every
``<`` and ``[`` is followed by an added backslash, so no control string (all begin with one
of the two) survives inside a text, whatever a tokenizer reserves, and taking away one
backslash after each gives the text back. The mask lists the stretches of the formatted
text, in code points, that the assistant's texts fill.

Null texts and roles are empty. A text that is a list is its strings and the ``text`` of its
objects, joined; parts without one, such as images, have no text. A record of unknown layout, or text that is no JSON, has a
null layout and no turns. Turns of a table are ordered by turn, then role and text; repeated
rows are turns of their own; null turns come first; rows without a conversation id are one
conversation. An empty table gives no rows. Of a table by turn only the four columns that its
mapping names are read; of records, further columns are kept and those named as an output are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
ASSISTANT = "assistant"
#: other names of the canonical roles
ROLES = {"human": "user", "prompter": "user", "gpt": ASSISTANT, "model": ASSISTANT, "bot": ASSISTANT}
_TURNS = "array<struct<role:string,text:string>>"


def fingerprint_of(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprint(paths: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(paths), "\n"), 256)


@dataclass(frozen=True)
class Layout:
    """Where turns are in a record: fixed (role, paths), or a list with its two fields."""

    name: str
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    listed: tuple[str, str, str] | None = None

    @property
    def paths(self) -> tuple[str, ...]:
        if self.listed:
            path, role, text = self.listed
            return f"{path}[].{role}", f"{path}[].{text}"
        return tuple(path for _, paths in self.fixed for path in paths)


@dataclass(frozen=True)
class RowLayout:
    """The columns of a table with one row per turn."""

    name: str
    conversation: str
    turn: str
    role: str
    text: str

    @property
    def paths(self) -> tuple[str, ...]:
        return self.conversation, self.turn, self.role, self.text


# The layouts known.
LAYOUTS = (
    Layout("messages", listed=("messages", "role", "content")),
    Layout("conversations", listed=("conversations", "from", "value")),
    Layout("prompt", (("user", ("prompt",)), (ASSISTANT, ("completion",)))),
    Layout("response", (("user", ("prompt",)), (ASSISTANT, ("response",)))),
    Layout("question", (("user", ("question",)), (ASSISTANT, ("answer",)))),
    Layout("instruction", (("user", ("instruction",)), (ASSISTANT, ("output",)))),
    Layout("instruction_input", (("user", ("instruction", "input")), (ASSISTANT, ("output",)))),
    Layout("system_prompt", (("system", ("system_prompt",)), ("user", ("question",)), (ASSISTANT, ("response",)))),
)
ROW_LAYOUTS = (RowLayout("by_turn", "conv_id", "turn", "role", "text"),)


def record_paths(record: Column, layouts: tuple[Layout, ...]) -> Column:
    """The field paths of a variant that some layout names."""
    found = [F.map_keys(F.try_variant_get(record, "$", "map<string,variant>"))]
    for path in sorted({x.listed[0] for x in layouts if x.listed}):
        objects = F.filter(F.try_variant_get(record, f"$.{path}", "array<map<string,variant>>"), lambda x: x.isNotNull())
        start = F.lit(f"{path}[].")
        found.append(F.transform(F.flatten(F.transform(objects, F.map_keys)), lambda x: F.concat(start, x)))
    named = F.array(*(F.lit(x) for x in sorted({y for layout in layouts for y in layout.paths})))
    return F.array_intersect(named, F.concat(*(F.coalesce(x, F.array().cast("array<string>")) for x in found)))


def canonical_role(role: Column) -> Column:
    found = F.coalesce(role, F.lit(""))
    named = None
    for other, name in ROLES.items():
        named = F.when(found == other, name) if named is None else named.when(found == other, name)
    return named.otherwise(found)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _said(value: Column) -> Column:
    """The text of a variant: a scalar, or a list of strings and of objects with a text."""
    parts = F.try_variant_get(value, "$", "array<variant>")

    def part(x: Column) -> Column:
        plain = F.when(F.try_variant_get(x, "$", "map<string,variant>").isNull(), F.try_variant_get(x, "$", "string"))
        return F.coalesce(F.try_variant_get(x, "$.text", "string"), plain, F.lit(""))

    return F.when(parts.isNotNull(), F.array_join(F.transform(parts, part), "")).otherwise(F.try_variant_get(value, "$", "string"))


def _mapped(layout: Layout, record: Column) -> Column:
    if layout.listed:
        path, role, text = layout.listed
        found = F.try_variant_get(record, f"$.{path}", "array<variant>")
        return F.transform(
            found,
            lambda x: _turn(canonical_role(F.try_variant_get(x, f"$.{role}", "string")), _said(F.try_variant_get(x, f"$.{text}", "variant"))),
        ).cast(_TURNS)
    turns = []
    for role, paths in layout.fixed:
        parts = [F.nullif(_said(F.try_variant_get(record, f"$.{path}", "variant")), F.lit("")) for path in paths]
        turns.append(_turn(F.lit(role), F.concat_ws("\n\n", *parts)))
    return F.array(*turns).cast(_TURNS)


def canonical(records: DataFrame, column: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with fingerprint, layout and turns of the JSON text in ``column``."""
    record = F.try_parse_json(column)
    paths = record_paths(record, layouts)
    name, turns = F.lit(None).cast("string"), F.array().cast(_TURNS)
    # the last one chosen counts
    for layout in sorted(layouts, key=lambda x: (x.listed is not None, len(x.paths))):
        own = F.array(*map(F.lit, layout.paths))
        chosen = fingerprint(F.array_intersect("_paths", own)) == fingerprint_of(layout.paths)
        name = F.when(chosen, layout.name).otherwise(name)
        turns = F.when(chosen, _mapped(layout, record)).otherwise(turns)
    marked = records.withColumn("_paths", F.when(record.isNotNull(), paths))
    found = {"fingerprint": fingerprint(F.col("_paths")), "layout": name, "turns": F.coalesce(turns, F.array().cast(_TURNS))}
    return marked.withColumns(found).drop("_paths")


def row_layout(kind: T.StructType, layouts: tuple[RowLayout, ...] = ROW_LAYOUTS) -> RowLayout:
    """The mapping whose columns a table has, by fingerprint; further columns are ignored."""
    for layout in layouts:
        if fingerprint_of(x for x in kind.names if x in layout.paths) == fingerprint_of(layout.paths):
            return layout
    raise ValueError(f"not a table by turn: {', '.join(kind.names)}")


def turns_of_rows(rows: DataFrame) -> DataFrame:
    """conv_id and turns of a table by turn, read by the mapping that its fingerprint selects; roles as the table has them."""
    layout = row_layout(rows.schema)
    turn = F.struct(F.col(layout.turn).alias("turn"), F.coalesce(layout.role, F.lit("")).alias("role"), F.coalesce(layout.text, F.lit("")).alias("text"))
    whole = rows.groupBy(F.col(layout.conversation).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.withColumn("turns", F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))))


def escaped(text: Column) -> Column:
    for sign in "<[":
        text = F.replace(text, F.lit(sign), F.lit(sign + "\\"))
    return text


def unescaped(text: Column) -> Column:
    for sign in "<[":
        text = F.replace(text, F.lit(sign + "\\"), F.lit(sign))
    return text


def formatted(conversations: DataFrame, turns: str = "turns") -> DataFrame:
    """``conversations`` with the formatted text and the mask, an array of (start, end) to learn."""
    safe = F.transform(turns, lambda x: F.struct((x["role"] == ASSISTANT).alias("learned"), escaped(x["role"]).alias("role"), escaped(x["text"]).alias("text")))
    whole = F.array_join(F.transform("safe", lambda x: F.concat(F.lit(START), x["role"], F.lit(SEPARATOR), x["text"], F.lit(END))), "")
    head, tail = len(START) + len(SEPARATOR), len(END)

    def further(state: Column, x: Column) -> Column:
        start = state["at"] + head + F.length(x["role"])
        end = start + F.length(x["text"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + tail).alias("at"), F.when(x["learned"], F.concat(state["mask"], span)).otherwise(state["mask"]).alias("mask"))

    empty = F.array().cast("array<struct<start:int,end:int>>")
    state = F.aggregate("safe", F.struct(F.lit(0).alias("at"), empty.alias("mask")), further)
    return conversations.withColumn("safe", safe).withColumn("formatted", whole).withColumn("mask", state["mask"]).drop("safe")


def turns_back(text: Column) -> Column:
    """The turns a formatted text holds."""
    parts = F.filter(F.split(text, r"<\|im_start\|>"), lambda x: x != "")

    def turn(piece: Column) -> Column:
        body = F.substring_index(F.substring_index(piece, SEPARATOR, -1), END, 1)
        return F.struct(unescaped(F.substring_index(piece, SEPARATOR, 1)).alias("role"), unescaped(body).alias("text"))

    return F.transform(parts, turn)


def learned_text(text: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, joined."""
    return F.array_join(F.transform(mask, lambda x: unescaped(F.substring(text, x["start"] + 1, x["end"] - x["start"]))), "")


def chat_digests(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, digests and lengths of every conversation, read back from the formatted text."""
    whole = formatted(turns_of_rows(rows))
    back = whole.select("conv_id", "formatted", turns_back(F.col("formatted")).alias("back"), learned_text(F.col("formatted"), F.col("mask")).alias("learned"))
    written = F.array_join(F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(written, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
