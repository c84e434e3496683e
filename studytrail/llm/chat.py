"""Chat formatting: layouts recognised by a fingerprint of their field paths.

A record is JSON of any layout. Those of its nested field paths that a layout needs are hashed,
without types and order; the fingerprint selects a declarative mapping to canonical turns. Turns of a conversation are
then written with one template whose control strings cannot occur inside a text, and with a
loss mask: the spans of assistant text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's marks.
ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>\n"
# Strings that may not stand unbroken inside a text, whatever template a reader uses.
CONTROL = r"<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])"
# A break after the first character of a control string; the mark itself is written double.
BREAK, MARK = "\ue000", "\ue001"

TURN = "struct<turn:bigint,role:string,text:string>"


@dataclass(frozen=True)
class Layout:
    """How a layout's fields become turns. ``paths`` are the leaves it needs, sorted; ``turns`` is
    SQL over the variant ``v`` that gives an array of (turn, role, text)."""

    name: str
    paths: tuple[str, ...]
    turns: str

    def fingerprint(self) -> Column:
        return F.xxhash64(F.lit("\n".join(self.paths)))

    def matches(self, paths: Column) -> Column:
        """The record's leaves that the layout knows have the layout's fingerprint."""
        own = F.array_intersect(F.array(*[F.lit(p) for p in self.paths]), paths)
        return F.xxhash64(F.array_join(own, "\n")) == self.fingerprint()


def _text(path: str) -> str:
    return f"coalesce(try_variant_get(v, '{path}', 'string'), '')"


def _numbered(turns: str) -> str:
    """Turns (role, text) behind the record's own system text, numbered by place."""
    system = "try_variant_get(v, '$.system', 'string')"
    led = f"concat(if({system} is null, array(), array(named_struct('role', 'system', 'text', {system}))), {turns})"
    return f"transform({led}, (m, i) -> named_struct('turn', cast(i as bigint), 'role', coalesce(m.role, ''), 'text', coalesce(m.text, '')))"


def _listed(path: str, role: str, text: str) -> str:
    items = f"try_variant_get(v, '{path}', 'array<struct<{role}:string,{text}:string>>')"
    return _numbered(f"cast({items} as array<struct<role:string,text:string>>)")


def _parts(path: str, role: str, text: str, part: str) -> str:
    """Messages whose text comes in parts; parts without text, such as images, add nothing."""
    items = f"try_variant_get(v, '{path}', 'array<struct<{role}:string,{text}:array<struct<{part}:string>>>>')"
    whole = f"array_join(m.{text}.{part}, '')"
    return _numbered(f"transform({items}, m -> named_struct('role', m.{role}, 'text', {whole}))")


def _pair(user: str, assistant: str) -> str:
    turn = "named_struct('role', '{}', 'text', {})"
    return _numbered(f"array({turn.format('user', user)}, {turn.format('assistant', assistant)})")


# The first layout that matches counts, so one that needs more fields stands before one that needs fewer of them.
LAYOUTS = [
    Layout("turn_row", ("role", "text", "turn"),
           f"array(named_struct('turn', try_variant_get(v, '$.turn', 'bigint'), 'role', {_text('$.role')}, 'text', {_text('$.text')}))"),
    Layout("message_parts", ("messages[].content[].text", "messages[].role"), _parts("$.messages", "role", "content", "text")),
    Layout("messages", ("messages[].content", "messages[].role"), _listed("$.messages", "role", "content")),
    Layout("from_value", ("conversations[].from", "conversations[].value"), _listed("$.conversations", "from", "value")),
    Layout("nested_messages", ("conversation.messages[].content", "conversation.messages[].role"),
           _listed("$.conversation.messages", "role", "content")),
    Layout("prompt", ("prompt", "response"), _pair(_text("$.prompt"), _text("$.response"))),
    Layout("completion", ("completion", "prompt"), _pair(_text("$.prompt"), _text("$.completion"))),
    Layout("instruction_input", ("input", "instruction", "output"),
           _pair(f"concat({_text('$.instruction')}, '\\n\\n', {_text('$.input')})", _text("$.output"))),
    Layout("instruction", ("instruction", "output"), _pair(_text("$.instruction"), _text("$.output"))),
]
# Names of roles in the layouts, and what they are called here.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(schema: Column) -> Column:
    """Paths of the leaves in a variant's schema text, without types; a list adds ``[]``.

    The text nests as OBJECT<a: T, b: ARRAY<OBJECT<c: T>>>, to any depth. ``at`` is the path of
    the value whose type comes next, ``open`` the paths of the values it stands in."""
    tokens = F.regexp_extract_all(schema, F.lit(r"((?:`(?:[^`]|``)*`|\w+): |ARRAY<|OBJECT<|>)"), 1)
    start = F.expr("named_struct('open', cast(array() as array<string>), 'at', '', 'leaves', cast(array() as array<string>))")

    def read(state: Column, token: Column) -> Column:
        opened, at, leaves = state["open"], state["at"], state["leaves"]
        above = F.coalesce(F.get(opened, F.size(opened) - 1), F.lit(""))
        name = F.concat(above, F.when(above != "", ".").otherwise(""), F.substring_index(token, ": ", 1))
        into = F.array_append(opened, at)
        listed = F.concat(at, F.lit("[]"))
        # A value that is opened is no leaf; it was noted as one when its name was read.
        without = F.array_remove(leaves, at)
        return (
            F.when(token == ">", F.struct(F.slice(opened, 1, F.greatest(F.size(opened) - 1, F.lit(0))).alias("open"), at.alias("at"), leaves.alias("leaves")))
            .when(token == "OBJECT<", F.struct(into.alias("open"), at.alias("at"), without.alias("leaves")))
            .when(token == "ARRAY<", F.struct(into.alias("open"), listed.alias("at"), F.array_append(without, listed).alias("leaves")))
            .otherwise(F.struct(opened.alias("open"), name.alias("at"), F.array_append(leaves, name).alias("leaves")))
        )

    return F.aggregate(tokens, start, read, lambda state: state["leaves"])


def canonical_turns(records: DataFrame) -> DataFrame:
    """(id, turn, role, text, layout) from (id, record), a record being JSON text.

    A layout matches by the leaves it needs, at the types of text or numbers; other fields of
    the record, nested ones too, do not matter. Of several that match the first counts. A null
    record, broken JSON or a layout without a mapping gives one row with null turn and layout,
    so nothing is lost unseen; callers route those rows. Null roles and texts are empty, and a
    list without messages gives one row with null turn. Turn numbers come from the record (null
    if they are no number), or from the place in its list, behind a ``system`` text of the
    record. Repeated records give their turns each."""
    parsed = records.select("id", F.expr("try_parse_json(record)").alias("v"))
    known = parsed.withColumn("paths", field_paths(F.expr("schema_of_variant(v)")))
    turns, layout = None, None
    for item in LAYOUTS:
        hit = item.matches(F.col("paths"))
        own = F.expr(item.turns).cast(f"array<{TURN}>")
        turns = F.when(hit, own) if turns is None else turns.when(hit, own)
        layout = F.when(hit, F.lit(item.name)) if layout is None else layout.when(hit, F.lit(item.name))
    rows = known.select("id", layout.alias("layout"), F.explode_outer(turns).alias("t"))
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    role = F.coalesce(F.try_element_at(names, F.col("t.role")), F.col("t.role"))
    return rows.select("id", "t.turn", role.alias("role"), "t.text", "layout")


def escaped(text: Column) -> Column:
    """Control strings broken, so that none stands in the result; see ``unescaped``."""
    return F.regexp_replace(F.replace(text, F.lit(BREAK), F.lit(BREAK + MARK)), f"({CONTROL})", f"$1{BREAK}")


def unescaped(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, f"{BREAK}(?!{MARK})", ""), F.lit(BREAK + MARK), F.lit(BREAK))


def formatted(turns: DataFrame) -> DataFrame:
    """(id, formatted, loss): one text per conversation and the spans (start, length in code
    points) of its assistant texts, in turn order; equal turn numbers go by role, then text."""
    head = F.concat(F.lit(ROLE), escaped(F.coalesce("role", F.lit(""))), F.lit(TEXT))
    parts = turns.select(
        "id", "turn", "role", "text", head.alias("head"), escaped(F.coalesce("text", F.lit(""))).alias("body")
    )
    length = (F.length("head") + F.length("body") + len(END)).cast("bigint")
    before = Window.partitionBy("id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.select("id", "role", "head", "body", F.coalesce(F.sum(length).over(before), F.lit(0)).alias("at"))
    span = F.struct((F.col("at") + F.length("head")).alias("start"), F.length("body").cast("bigint").alias("length"))
    piece = F.struct(
        "at",
        F.concat("head", "body", F.lit(END)).alias("piece"),
        F.when(F.col("role") == "assistant", span).alias("span"),
    )
    listed = placed.groupBy("id").agg(F.array_sort(F.collect_list(piece)).alias("parts"))
    return listed.select(
        "id",
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"),
        F.filter(F.transform("parts", lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss"),
    )


def read_back(texts: DataFrame) -> DataFrame:
    """(id, turns, loss_text, formatted) read from formatted texts: turns (role, text) cut at the
    marks and unescaped, and the unescaped text under the loss mask."""
    ended = F.split("formatted", r"<\|end\|>\n", -1)
    pieces = F.slice(ended, F.lit(1), F.size(ended) - 1)
    cut = F.transform(pieces, lambda p: F.split(F.substr(p, F.lit(len(ROLE) + 1)), r"<\|text\|>", -1))
    turns = F.transform(
        cut, lambda p: F.struct(unescaped(F.get(p, F.lit(0))).alias("role"), unescaped(F.get(p, F.lit(1))).alias("text"))
    )
    spans = F.transform("loss", lambda s: unescaped(F.substr("formatted", s["start"].cast("int") + 1, s["length"].cast("int"))))
    return texts.select("id", "formatted", turns.alias("turns"), F.array_join(spans, "").alias("loss_text"))


def records_of(conversations: DataFrame) -> DataFrame:
    """(id, record): each row of a conversation table as a record of its own layout."""
    record = F.to_json(F.struct(F.col("conv_id").alias("id"), "turn", "role", "text"), {"ignoreNullFields": "false"})
    return conversations.select(F.col("conv_id").alias("id"), record.alias("record"))
