"""Key/value rows (key, value) and hashes (key, field, value) as table jobs.

A table holds each key, a hash each field, once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrail.functions.keys import between_keys

# Characters with a meaning in a regular expression.
_SPECIAL = set(".^$+{}()|\\*?[]")


def glob_pattern(glob: str) -> str:
    """Key glob (``*``, ``?``, ``[abc]``, ``[^a]``, backslash) as an anchored regex."""
    out, i = [], 0
    while i < len(glob):
        ch = glob[i]
        close = glob.find("]", i + 1) if ch == "[" else -1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif close > i + 1:
            out.append("[" + glob[i + 1 : close].replace("\\", "\\\\") + "]")
            i = close
        elif ch == "\\" and i + 1 < len(glob):
            i += 1
            out.append("\\" + glob[i] if glob[i] in _SPECIAL else glob[i])
        else:
            out.append("\\" + ch if ch in _SPECIAL else ch)
        i += 1
    return "(?s)^" + "".join(out) + "$"


def multi_get(table: DataFrame, keys: DataFrame) -> DataFrame:
    """Value of every listed key, null when absent."""
    return keys.select("key").join(table.select("key", "value"), "key", "left")


def multi_set(table: DataFrame, new: DataFrame) -> DataFrame:
    """Set or replace. ``new`` has one row per key."""
    keys = new.select("key")
    return table.join(keys, "key", "left_anti").unionByName(new.select(*table.columns))


def set_if_absent(table: DataFrame, new: DataFrame) -> DataFrame:
    """Add only keys the table lacks."""
    fresh = new.select(*table.columns).join(table.select("key"), "key", "left_anti")
    return table.unionByName(fresh.select(*table.columns))


def set_all_or_none(table: DataFrame, new: DataFrame) -> DataFrame:
    """Add the new pairs only if none of their keys exists."""
    taken = table.join(new.select("key"), "key", "left_semi").agg(F.count(F.lit(1)).alias("n")).scalar()
    return table.unionByName(new.select(*table.columns).filter(taken == 0))


def increment(table: DataFrame, deltas: DataFrame, kind: str = "bigint") -> DataFrame:
    """Add (key, delta) rows to number values; absent keys start at 0, ``kind`` may be ``double``."""
    return _add_up(table, deltas, ["key"], kind)


def glob_bounds(glob: str) -> tuple[str, str]:
    """The least and the greatest beginning of a key that matches: what stands before the first free
    place, and the ends of a plain list of characters there."""
    fixed, i = "", 0
    while i < len(glob) and glob[i] not in "*?[":
        if glob[i] == "\\" and i + 1 < len(glob):
            i += 1
        fixed += glob[i]
        i += 1
    close = glob.find("]", i + 1) if glob[i : i + 1] == "[" else -1
    listed = glob[i + 1 : close] if close > i + 1 else ""
    if glob[i : i + 1] == "[" and close <= i + 1:
        # No list: the bracket stands for itself, and what follows it is not looked at.
        return fixed + "[", fixed + "["
    if listed and not set(listed) & set("^-\\&["):
        return fixed + min(listed), fixed + max(listed)
    return fixed, fixed


def matching_keys(table: DataFrame, glob: str) -> DataFrame:
    """Keys that match the glob; the part before its first free place bounds the keys that are read."""
    low, high = glob_bounds(glob)
    return table.filter(between_keys(F.col("key"), low, high) & F.col("key").rlike(glob_pattern(glob))).select("key")


def exists(table: DataFrame, keys: DataFrame) -> DataFrame:
    found = table.select("key").withColumn("__hit", F.lit(True))
    joined = keys.select("key").join(found, "key", "left")
    return joined.select("key", F.coalesce("__hit", F.lit(False)).alias("found"))


def delete_keys(table: DataFrame, keys: DataFrame) -> DataFrame:
    return table.join(keys.select("key"), "key", "left_anti")


def _add_up(table: DataFrame, deltas: DataFrame, keys: Sequence[str], kind: str) -> DataFrame:
    old = table.select(*keys, F.col("value").cast(kind).alias("n"))
    new = deltas.select(*keys, F.col("delta").cast(kind).alias("n"))
    return old.unionByName(new).groupBy(*keys).agg(F.sum("n").cast("string").alias("value"))


# Hashes


def hash_get(hashes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The listed fields of every hash as columns, null when absent."""
    picked = [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    return hashes.groupBy("key").agg(*picked)


def hash_rows(hashes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All fields of the listed hashes, one row each (a hash may be of any size)."""
    return hashes.filter(F.col("key").isin(list(keys)))


def hash_keys(hashes: DataFrame, key: str) -> DataFrame:
    return hash_rows(hashes, [key]).select("field")


def hash_values(hashes: DataFrame, key: str) -> DataFrame:
    return hash_rows(hashes, [key]).select("value")


def hash_size(hashes: DataFrame) -> DataFrame:
    return hashes.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def hash_has(hashes: DataFrame, probes: DataFrame) -> DataFrame:
    found = hashes.select("key", "field").withColumn("__hit", F.lit(True))
    joined = probes.select("key", "field").join(found, ["key", "field"], "left")
    return joined.select("key", "field", F.coalesce("__hit", F.lit(False)).alias("found"))


def hash_put(hashes: DataFrame, fields: DataFrame, if_absent: bool = False) -> DataFrame:
    """Set fields (one row per key and field); ``if_absent`` leaves present fields alone."""
    at = ["key", "field"]
    new = fields.select("key", "field", "value")
    if if_absent:
        fresh = new.join(hashes.select(*at), at, "left_anti")
        return hashes.unionByName(fresh.select(*hashes.columns))
    return hashes.join(new.select(*at), at, "left_anti").select(*hashes.columns).unionByName(
        new.select(*hashes.columns)
    )


def hash_delete(hashes: DataFrame, fields: DataFrame) -> DataFrame:
    return hashes.join(fields.select("key", "field"), ["key", "field"], "left_anti")


def hash_increment(hashes: DataFrame, deltas: DataFrame, kind: str = "bigint") -> DataFrame:
    return _add_up(hashes, deltas, ["key", "field"], kind)
