"""Comparators for cell filters: ``test(column, op, comparator)`` gives a boolean column."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER_OPS = ("<", "<=", "=", "!=", ">=", ">")


@dataclass(frozen=True)
class Comparator:
    """``ordered`` gives the column compared with ``value``; ``matches`` a yes/no test."""

    value: str | None = None
    ordered: Callable[[Column], Column] | None = None
    matches: Callable[[Column], Column] | None = None


def binary(value: str) -> Comparator:
    """Byte order of the whole text."""
    return Comparator(value, ordered=lambda c: c)


def binary_prefix(value: str) -> Comparator:
    """Byte order of the text cut to the length of ``value``."""
    return Comparator(value, ordered=lambda c: F.substring(c, 1, len(value)))


def regex(pattern: str) -> Comparator:
    """True if the pattern is found anywhere."""
    return Comparator(matches=lambda c: c.rlike(pattern))


def substring(text: str) -> Comparator:
    """Contains, ignoring case."""
    return Comparator(matches=lambda c: F.contains(F.lower(c), F.lit(text.lower())))


def null() -> Comparator:
    return Comparator(matches=lambda c: c.isNull())


def bits(value: str, op: str = "and") -> Comparator:
    """True if the bytes have the length of ``value`` and ``and``/``or``/``xor`` leaves any bit set."""
    raw = value.encode()

    def matches(column: Column) -> Column:
        digits = F.hex(F.encode(column, "UTF-8"))
        hit = F.lit(False)
        for start in range(0, len(raw), 4):
            block = raw[start : start + 4]
            word = F.conv(F.substring(digits, 2 * start + 1, 2 * len(block)), 16, 10).cast("bigint")
            mask = F.lit(int.from_bytes(block, "big")).cast("bigint")
            combined = {"and": word.bitwiseAND, "or": word.bitwiseOR, "xor": word.bitwiseXOR}[op](mask)
            hit = hit | (combined != 0)
        return (F.octet_length(column) == len(raw)) & hit

    return Comparator(matches=matches)


def test(column: Column, op: str, comparator: Comparator) -> Column:
    if op not in ORDER_OPS:
        raise ValueError(f"unknown operator {op!r}")
    if comparator.matches is not None:
        if op == "=":
            return comparator.matches(column)
        if op == "!=":
            return ~comparator.matches(column)
        raise ValueError(f"{op!r} needs a binary comparator")
    left, right = comparator.ordered(column), F.lit(comparator.value)
    return {
        "<": left < right,
        "<=": left <= right,
        "=": left == right,
        "!=": left != right,
        ">=": left >= right,
        ">": left > right,
    }[op]
