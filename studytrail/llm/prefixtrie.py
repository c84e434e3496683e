"""Prefix trie of conversations from a sorted order, its LCPs and sparse tables.

Conversations, as sequences of turn symbols, are sorted over the whole cluster. A prefix of
depth d around row i is the longest run of rows whose neighbouring LCPs (longest common
prefixes) are at least d. Each candidate prefix finds the ends of its run by itself: a binary
search to the left and one to the right over a sparse table of LCP minima. No stack is kept
and no candidate waits for another.

The sorted rows are cut into blocks of bounded weight, so that a prefix that a third of all
conversations share is spread over tasks. The LCPs between blocks are known before the blocks
are searched; every sum over a subtree is a sum over rows:

  code points of all members from a node on    =  sum of C(i) - n P(d-1)
  code points of the nodes of its subtree      =  C(first) - P(d-1) + sum of (C(i) - P(i, lcp(i)))
  leaves                                       =  rows whose next LCP is less than their length

with C the code points of a conversation and P those of a prefix. So a run over several blocks
gives one partial row per block, which add up; all other nodes are whole where they are found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studytrail.llm.common import kept, whole

# Turns of a block; a block holds one conversation more than that at most.
BLOCK_TURNS = 1 << 15
# Rows of the table of shared nodes that may be sent to every task.
SMALL_NODES = 200_000
# Bytes of the blocks' edges that may be sent to every task.
SMALL_EDGES = 32 << 20
SYMBOL = 16
MOST_SHARED = 6
GROUP = 100

NODES = (
    "key binary, conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends string, part int, block int"
)
_ARROW = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "int": pa.int32()}
NODE_SCHEMA = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in NODES.split(", "))])

TURNS = "array<struct<symbol:binary,chars:bigint>>"


def symbol(role: Column, text: Column) -> Column:
    """128 bits of the SHA-256 of a turn; the length keeps role and text apart."""
    joined = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(joined, 256), 1, 2 * SYMBOL))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order of turn, null first, then role and
    text. A null role or text counts as empty; rows without conv_id take no part."""
    role, text = whole("role"), whole("text")
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"),
            F.struct(symbol(role, text).alias("symbol"), F.length(text).cast("bigint").alias("chars")).alias("t"),
        ).alias("item"),
    )
    # Null turns sort first in an ascending array.
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("item"))["t"].alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the first h turns of conversation c - c % 100, then the own turns behind
    the first h; h is the CRC-32 of the decimal conv_id modulo 6."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    base = turns.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, MOST_SHARED - 1).alias("shared")
    )
    named = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).withColumn("h", h)
    start = F.coalesce(F.slice("shared", F.lit(1), F.col("h")), F.expr(f"cast(array() as {TURNS})"))
    own = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    return named.join(base, "base", "left").select("conv_id", F.concat(start, own).alias("turns"))


def common_prefix(a: np.ndarray, b: np.ndarray) -> int:
    """Leading symbols that two sequences (n, 2) of 64-bit halves share."""
    n = min(len(a), len(b))
    differ = (a[:n] != b[:n]).any(axis=1)
    return int(differ.argmax()) if differ.any() else n


def packed_blocks(rows: DataFrame, block_turns: int) -> DataFrame:
    """The sorted rows in blocks of about ``block_turns`` turns: (part, block, conv_ids, sizes, symbols,
    chars) as bytes, with the symbols of the first and last row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        block, weight, ids, keys, chars = 0, 0, [], [], []

        def row() -> pa.RecordBatch:
            sizes = np.array([len(k) // SYMBOL for k in keys], np.int64)
            values = [
                [part], [block], [np.array(ids, np.int64).tobytes()], [sizes.tobytes()], [b"".join(keys)],
                [b"".join(chars)], [keys[0]], [keys[-1]],
            ]
            types = [pa.int32(), pa.int32()] + [pa.binary()] * 6
            names = ["part", "block", "conv_ids", "sizes", "symbols", "chars", "first", "last"]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

        for batch in batches:
            for conv_id, key, counted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if ids and weight >= block_turns:
                    yield row()
                    block, weight, ids, keys, chars = block + 1, 0, [], [], []
                ids.append(conv_id)
                keys.append(key)
                chars.append(counted.values.to_numpy().astype(np.int64).tobytes() if key else b"")
                weight += 1 + len(key) // SYMBOL
        if ids:
            yield row()

    return rows.select("conv_id", "key", "chars").mapInArrow(
        pack, "part int, block int, conv_ids binary, sizes binary, symbols binary, chars binary, first binary, last binary"
    )


def sorted_blocks(sequences: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Blocks of all conversations in order of their symbols, then conv_id."""
    symbols = F.array_join(F.transform("turns", lambda t: F.hex(t["symbol"])), "")
    rows = sequences.select("conv_id", F.unhex(symbols).alias("key"), F.col("turns")["chars"].alias("chars"))
    return packed_blocks(rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id"), block_turns)


def bordered(blocks: DataFrame) -> DataFrame:
    """The blocks with the last sequence before and the first one behind them, null at both ends.
    The window sees a row per block."""
    order = Window.orderBy("part", "block")
    edges = blocks.select("part", "block", "first", "last").select(
        "part", "block", F.lag("last").over(order).alias("behind"), F.lead("first").over(order).alias("ahead")
    )
    weight = blocks.agg(F.sum(F.length("first") + F.length("last") + 16)).first()[0] or 0
    edges = F.broadcast(edges) if weight <= SMALL_EDGES else edges
    return blocks.select("part", "block", "conv_ids", "sizes", "symbols", "chars").join(edges, ["part", "block"])


def minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: level k holds the minimum of each 2^k values in a row."""
    table = [values]
    while len(table[-1]) > 1 << (len(table) - 1):
        last, step = table[-1], 1 << (len(table) - 1)
        table.append(np.minimum(last[:-step], last[step:]))
    return table


def right_ends(table: list[np.ndarray], rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """For each row the last one that all LCPs up to it join at the depth, by binary search."""
    at = rows.copy()
    for k in range(len(table) - 1, -1, -1):
        level = table[k]
        inside = at + 1 < len(level)
        at += (inside & (level[np.minimum(at + 1, len(level) - 1)] >= depths)).astype(at.dtype) << k
    return at


def left_ends(table: list[np.ndarray], rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """For each row the first one that all LCPs back to it join at the depth."""
    at = rows.copy()
    for k in range(len(table) - 1, -1, -1):
        start = at - (1 << k) + 1
        inside = start >= 1
        at -= (inside & (table[k][np.clip(start, 0, len(table[k]) - 1)] >= depths)).astype(at.dtype) << k
    return at


def least(table: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum between two places, both included, from two overlapping entries."""
    k = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), np.int64)
    for level in np.unique(k):
        mine = k == level
        out[mine] = np.minimum(table[level][first[mine]], table[level][last[mine] - (1 << int(level)) + 1])
    return out


def path_keys(symbols: bytes, upto: int) -> list[bytes]:
    """128 bits for each prefix of 0 .. upto symbols."""
    sha, keys = hashlib.sha256(), []
    for d in range(upto + 1):
        keys.append(sha.digest()[:SYMBOL])
        sha.update(symbols[d * SYMBOL : (d + 1) * SYMBOL])
    return keys


def halves(symbols: bytes) -> np.ndarray:
    return np.frombuffer(symbols, np.uint64).reshape(-1, 2)


def block_nodes(
    ids: np.ndarray, sizes: np.ndarray, symbols: bytes, chars: np.ndarray, behind: bytes | None, ahead: bytes | None
) -> dict[str, list]:
    """The nodes of one block as columns of NODES: whole ones, and partial rows of those that the
    neighbouring blocks share."""
    n = len(ids)
    turns = halves(symbols)
    at = np.concatenate([[0], np.cumsum(sizes)])
    rows = [turns[a:b] for a, b in zip(at, at[1:])]
    before = -1 if behind is None else common_prefix(halves(behind), rows[0])
    after = -1 if ahead is None else common_prefix(rows[-1], halves(ahead))
    lcp = np.array([before] + [common_prefix(a, b) for a, b in zip(rows, rows[1:])], np.int64)

    # Candidate prefixes: those that go on from the block before, then those each row begins.
    fresh = sizes - lcp
    starts = before + 1 + np.concatenate([[0], np.cumsum(fresh)])[:-1]
    row = np.concatenate([np.zeros(before + 1, np.int64), np.repeat(np.arange(n), fresh)])
    depth = np.concatenate([np.arange(before + 1), np.arange(len(row) - before - 1) - np.repeat(starts - before - 2 - lcp, fresh)])
    table = minima(lcp)
    end = right_ends(table, row, depth)
    above = left_ends(table, row, np.maximum(depth - 1, 0))
    parent = np.where((above == 0) & (depth - 1 <= before), depth - 1, starts[above] + depth - 2 - lcp[above])

    # Sums over the rows of each run.
    total = lambda values: np.concatenate([[0], np.cumsum(values)])
    points = total(chars)
    upto = lambda i, d: points[at[i] + np.maximum(d, 0)] - points[at[i]]
    every = np.arange(n)
    whole_row = upto(every, sizes)
    all_points, new_points = total(whole_row), total(whole_row - upto(every, lcp))
    leaves = total(np.append(lcp[1:], after) < sizes)
    count = end - row + 1
    led = upto(row, depth - 1)
    goes_on = np.arange(len(row)) <= before
    distinct = np.where(
        goes_on, new_points[end + 1] - new_points[row], whole_row[row] - led + new_points[end + 1] - new_points[np.minimum(row + 1, n)]
    )
    saved = all_points[end + 1] - all_points[row] - count * led - distinct
    smallest = least(minima(ids), row, end)
    begun = (depth > 0) & ~goes_on
    children = np.bincount(parent[begun], minlength=len(row))

    # Members that end at a node are the equal rows at the start of its run.
    runs = np.flatnonzero(np.concatenate([[True], (lcp[1:] != sizes[1:]) | (sizes[1:] != sizes[:-1])]))
    run_end = dict(zip(runs.tolist(), [*runs[1:].tolist(), n]))
    ends = [""] * len(row)
    for k in np.flatnonzero(sizes[row] == depth).tolist():
        a = int(row[k])
        ends[k] = ",".join(map(str, ids[a : run_end[a]].tolist()))

    on = (end == n - 1) & (depth <= after)
    shared = goes_on | on
    first_keys = path_keys(symbols[: SYMBOL * int(at[1])], before) if before >= 0 else []
    last_keys = path_keys(symbols[SYMBOL * int(at[-2]) :], after) if after >= 0 else []
    key_of = lambda k: first_keys[depth[k]] if goes_on[k] else last_keys[depth[k]]
    keys: list[bytes | None] = [None] * len(row)
    for k in np.flatnonzero(shared).tolist():
        keys[k] = key_of(k)
    above_shared = (depth > 0) & shared[np.maximum(parent, 0)]
    above_key = [keys[p] if s else None for p, s in zip(parent.tolist(), above_shared.tolist())]
    known = (depth > 0) & ~above_shared
    return {
        "key": keys,
        "conv_id": smallest.tolist(),
        "depth": depth.tolist(),
        "parent_conv_id": [int(smallest[p]) if k else None for p, k in zip(parent.tolist(), known.tolist())],
        "parent_key": above_key,
        "n_convs": count.tolist(),
        "n_children": children.tolist(),
        "n_leaves": (leaves[end + 1] - leaves[row]).tolist(),
        "saved_tokens": saved.tolist(),
        "ends": [text if s else hashlib.sha256(text.encode()).hexdigest() for text, s in zip(ends, shared.tolist())],
    }


def nodes_of_blocks(blocks: DataFrame) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block, ids, sizes, symbols, chars, behind, ahead in zip(*[c.to_pylist() for c in batch.columns]):
                found = block_nodes(
                    np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64), symbols, np.frombuffer(chars, np.int64), behind, ahead
                )
                found |= {"part": [part] * len(found["key"]), "block": [block] * len(found["key"])}
                yield pa.RecordBatch.from_pydict(found, schema=NODE_SCHEMA)

    return blocks.mapInArrow(search, NODES)


def merged(shared: DataFrame) -> DataFrame:
    """One row per node that several blocks share: sums of its partial rows, and the digest over
    its pieces, which pass through in order without being gathered."""
    ordered = shared.repartition("key").sortWithinPartitions("key", "part", "block")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, written = None, None, False

        def done() -> list[dict]:
            return [] if node is None else [node | {"ends": sha.hexdigest()}]

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if node is None or r["key"] != node["key"]:
                    out += done()
                    node, sha, written = r, hashlib.sha256(), False
                else:
                    node["conv_id"] = min(node["conv_id"], r["conv_id"])
                    for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                        node[c] += r[c]
                if r["ends"]:
                    sha.update((("," if written else "") + r["ends"]).encode())
                    written = True
            yield pa.RecordBatch.from_pylist(out, schema=NODE_SCHEMA)
        yield pa.RecordBatch.from_pylist(done(), schema=NODE_SCHEMA)

    return ordered.mapInArrow(merge, NODES)


def trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: conv_id (its smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without conv_id take no part. A null role or text counts as empty, rows of one turn
    number stand in order of role and text, repeated rows are repeated turns, and other columns
    are not read. An empty table has no nodes. A conversation is one row of 24 bytes a turn; the
    digest of one node's members runs through one task, as SHA-256 has no other way."""
    rows = kept(rebuilt(kept(sequences(conversations), "trie-turns")), "trie-rebuilt")
    blocks = kept(sorted_blocks(rows, block_turns), "trie-blocks")
    nodes = kept(nodes_of_blocks(bordered(blocks)), "trie-nodes")
    shared = kept(merged(nodes.filter("key is not null")), "trie-shared")
    every = nodes.filter("key is null").unionByName(shared)
    parents = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    parents = F.broadcast(parents) if shared.count() <= SMALL_NODES else parents
    return every.join(parents, "parent_key", "left").select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), F.coalesce("parent_conv_id", "above").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"),
    )
