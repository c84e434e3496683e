"""Message schemas and composite text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed message formats of the three input topics.
ANSWER_SCHEMA = (
    "id long, TestPaper_User_ID long, QuestionID long, BatchCourses_ID long, "
    "TestPaper_ID long, CreateUser long, IsRight int"
)
QUESTION_POINT_SCHEMA = "id long, QuestionId long, PointId long"
PAPER_TASK_SCHEMA = "id long, testPaper_user_id long, CustomsID long, TaskID long, UserID long"


def parse_json(text: Column, schema: str) -> Column:
    """JSON object to typed fields. Numbers may come quoted; a field that holds no number, and
    all fields of an unreadable message, are null."""
    fields = [part.split() for part in schema.split(",")]
    read = F.from_json(text, ", ".join(f"{name} string" for name, _ in fields), {"mode": "PERMISSIVE"})
    return F.struct(*[read[name].try_cast(kind).alias(name) for name, kind in fields])


def to_json(value: Column) -> Column:
    return F.to_json(value)


def join_key(*parts: Column) -> Column:
    """Parts joined by ``_``; a null part is written as the word null, so keys keep their arity."""
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])


def key_part(key: Column, index: int, sep: str = "_") -> Column:
    """Part ``index`` (from 0) of a composite key; null when absent."""
    return F.get(F.split(key, sep), F.lit(index))


def key_long(key: Column, index: int, sep: str = "_") -> Column:
    """As ``key_part``, as a number; text that is no number gives null."""
    return key_part(key, index, sep).try_cast("bigint")


def board_name(prefix: str, identifier: Column) -> Column:
    return F.concat(F.lit(prefix), identifier.cast("string"))


def outcome(qualifier: Column) -> Column:
    """``wrong``, ``right`` or ``total`` by the qualifier's suffix."""
    return F.when(qualifier.endswith("_0"), "wrong").when(qualifier.endswith("_1"), "right").otherwise("total")


def count_text(count: Column) -> Column:
    return count.cast("string")


def text_count(text: Column) -> Column:
    return text.try_cast("bigint")


def ratio(part: Column, whole: Column) -> Column:
    """Double division; a whole of zero gives null (not NaN)."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def positive(identifier: Column) -> Column:
    """The identifier if it is greater than zero, else null."""
    return F.when(identifier > 0, identifier)


def record_text(key: Column, value: Column) -> Column:
    """Relay text with key and value; a null key or value is written as null."""
    shown = [F.coalesce(c.cast("string"), F.lit("null")) for c in (key, value)]
    return F.concat(F.lit("key:"), shown[0], F.lit(" value:"), shown[1])


def marked_text(value: Column) -> Column:
    """Relay text of the second relay."""
    return F.concat(F.lit(">>>>:"), F.coalesce(value.cast("string"), F.lit("null")))


def successor(prefix: str) -> str | None:
    """The least text that is greater than all texts with the prefix, in byte order; None if there is
    none."""
    while prefix:
        point = ord(prefix[-1]) + 1
        # Surrogates are no characters of their own.
        point = 0xE000 if point == 0xD800 else point
        if point <= 0x10FFFF:
            return prefix[:-1] + chr(point)
        prefix = prefix[:-1]
    return None


def between_keys(key: Column, low: str, high: str | None = None) -> Column:
    """Keys that begin with ``low`` or, with ``high``, with anything from ``low`` to ``high``: bounds that
    reach the scan, so that row groups outside them are not read."""
    end = successor(low if high is None else high)
    keep = key >= F.lit(low) if low else F.lit(True)
    return keep if end is None else keep & (key < F.lit(end))
