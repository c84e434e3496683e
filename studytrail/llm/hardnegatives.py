"""Hard negatives by Fagin's threshold algorithm.

Candidates stand in one list per dimension, sorted by component. An anchor reads every list
from the end its own component points to: from the largest value where the component is
positive, from the smallest where it is negative. Whatever the lists show is scored at once by
random access, as an integer inner product. The threshold is the score of a row that would
have, in each dimension, the value read last; no unseen row can score more. A search stops once
the threshold falls strictly below the k-th score of each of its windows (strictly, since an
unseen row may tie and have the smaller id), or below their lower ends.

Rows are dealt by id into blocks of bounded size, anchors into chunks, and every chunk meets
every block in a task of its own: first the blocks of the anchor's label, for its positives,
then all blocks, for the negatives within each positive's window of scores. A task returns k
rows a window, and the k best of all blocks are the result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studytrail.llm.common import kept

BLOCK_ROWS = 8192
CHUNK_ANCHORS = 4096
K = 5
SCALE = 256
# Entries read from each list in the first round; each round reads four times as many.
FIRST_READ = 32
LONG = 1 << 62


def quantised(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, q) of the rows that take part: vec_id and label given, a vector without null
    or non-finite components. Each component x becomes floor(256 x); a label of a vec_id divisible
    by 7 becomes the next one modulo 10."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.filter("vec_id is not null and label is not null and embedding is not null").filter(finite)
    return rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        moved.cast("bigint").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("q"),
    )


def matrix(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of integers, short ones filled with zeros, in the narrowest type that gives exact inner
    products."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def exact(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in a type whose products and sums are exact: floats below 2^53, then integers of
    64 bits, then Python's."""
    most = lambda m: int(max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))))
    bound = most(rows) * most(anchors) * max(rows.shape[1], 1)
    kind = np.float64 if bound < 1 << 53 else np.int64 if bound < LONG else object
    return rows.astype(kind), anchors.astype(kind)


@dataclass
class Lists:
    """A block's rows and their lists: per dimension the row numbers by ascending value."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    order: np.ndarray
    reads: int = 0

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> Lists:
        return cls(ids, labels, rows, np.argsort(rows, axis=0, kind="stable").astype(np.int32))


def best(ids: np.ndarray, scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The k places of highest score, ties by smaller id."""
    if len(places) > k:
        kth = np.partition(scores[places], len(places) - k)[len(places) - k]
        places = places[scores[places] >= kth]
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def threshold_search(
    block: Lists, anchor: np.ndarray, fits: np.ndarray, windows: list[tuple[int | None, int | None]], k: int = K
) -> list[list[tuple[int, int]]]:
    """For each window (lowest, highest score; None for open) the first k rows (vec_id, score) of
    those that ``fits`` marks, by descending score, then vec_id."""
    n = len(block.ids)
    rising = np.flatnonzero(anchor > 0)
    falling = np.flatnonzero(anchor < 0)
    seen = np.zeros(n, bool)
    scores = np.zeros(n, block.rows.dtype)
    if not len(rising) and not len(falling):
        # No list says anything: every row scores zero.
        seen[:] = True
    depth, step = 0, FIRST_READ
    open_windows = list(range(len(windows)))
    found: list[list[tuple[int, int]]] = [[] for _ in windows]
    while True:
        if not seen.all():
            upto = min(n, depth + step)
            shown = np.zeros(n, bool)
            shown[block.order[n - upto : n - depth, rising].ravel()] = True
            shown[block.order[depth:upto, falling].ravel()] = True
            block.reads += (upto - depth) * (len(rising) + len(falling))
            new = np.flatnonzero(shown & ~seen)
            seen[new] = True
            scores[new] = block.rows[new] @ anchor
            depth, step = upto, step * 4
            top = sum(int(block.rows[i, j]) * int(anchor[j]) for i, j in zip(block.order[n - depth, rising].tolist(), rising.tolist()))
            top += sum(int(block.rows[i, j]) * int(anchor[j]) for i, j in zip(block.order[depth - 1, falling].tolist(), falling.tolist()))
        done = seen.all()
        ready = np.flatnonzero(seen & fits)
        still = []
        for w in open_windows:
            low, high = windows[w]
            inside = np.ones(len(ready), bool)
            if low is not None:
                inside &= scores[ready] >= low
            if high is not None:
                inside &= scores[ready] <= high
            first = best(block.ids, scores, ready[inside], k)
            if done or (len(first) == k and top < scores[first[-1]]) or (low is not None and top < low):
                found[w] = [(int(block.ids[i]), int(scores[i])) for i in first]
            else:
                still.append(w)
        open_windows = still
        if not open_windows:
            return found


def _lists(rows: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), matrix(rows.column("q"), width)


def saturated(score: int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, score))


def met(
    rows: DataFrame, anchors: DataFrame, keys: list[str], windows: Callable[[dict, Lists], tuple[np.ndarray, list]], k: int
) -> DataFrame:
    """(anchor_id, anchor_row, place, vec_id, score): what each chunk of anchors finds in each block
    with its keys. ``windows`` gives an anchor's fitting rows and its windows in a block."""

    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("anchor_id", "anchor_row", "place", "vec_id", "score")}
        if len(rows) and len(anchors):
            sides = [rows.column("q"), anchors.column("q")]
            width = max(int(np.diff(s.combine_chunks().offsets.to_numpy()).max(initial=0)) for s in sides)
            ids, labels, values = _lists(rows, width)
            values, wanted = exact(values, matrix(anchors.column("q"), width))
            block = Lists.of(ids, labels, values)
            for row, vector in zip(anchors.drop_columns("q").to_pylist(), wanted):
                fits, spans = windows(row, block)
                for place, some in enumerate(threshold_search(block, vector, fits, spans, k)):
                    for vec_id, score in some:
                        for c, v in zip(out, (row["vec_id"], row["anchor_row"], place, vec_id, saturated(score))):
                            out[c].append(v)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds)})

    return rows.groupBy(*keys).cogroup(anchors.groupBy(*keys)).applyInArrow(
        search, "anchor_id long, anchor_row long, place int, vec_id long, score long"
    )


def dealt(parts: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64("vec_id", F.lit(seed)), parts)


def copies(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))


def parts(count: Column, size: int) -> Column:
    return F.greatest(F.ceil(count / size), F.lit(1)).cast("bigint")


def first_ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows of each window, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def positives(
    rows: DataFrame, anchors: DataFrame, k: int = K, block_rows: int = BLOCK_ROWS, chunk_anchors: int = CHUNK_ANCHORS
) -> DataFrame:
    """(anchor_id, anchor_row, vec_id, score): the first k other rows of the anchor's label. Rows
    with the anchor's own vec_id are not other rows. Labels are cut into blocks by their size, so
    that one label may hold any share of the rows."""
    sizes = anchors.groupBy("label").agg(parts(F.count(F.lit(1)), chunk_anchors).alias("chunks"))
    sizes = sizes.join(rows.groupBy("label").agg(parts(F.count(F.lit(1)), block_rows).alias("blocks")), "label")
    cut = kept(sizes, "negatives-sizes")
    blocks = rows.join(cut, "label").select("vec_id", "label", "q", dealt(F.col("blocks"), 1).alias("block"), copies(F.col("chunks")).alias("chunk"))
    chunks = anchors.join(cut, "label").select(
        "vec_id", "anchor_row", "label", "q", dealt(F.col("chunks"), 2).alias("chunk"), copies(F.col("blocks")).alias("block")
    )

    def windows(anchor: dict, block: Lists) -> tuple[np.ndarray, list]:
        return block.ids != anchor["vec_id"], [(None, None)]

    found = met(blocks, chunks, ["label", "block", "chunk"], windows, k)
    return first_ranked(found, ["anchor_id", "anchor_row"], k).select("anchor_id", "anchor_row", "vec_id", "score")


def hard_negatives(
    embeddings: DataFrame,
    every: int = 100,
    k: int = K,
    low: int = 80,
    high: int = 100,
    block_rows: int = BLOCK_ROWS,
    chunk_anchors: int = CHUNK_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor
    (vec_id divisible by ``every``) and each of its first k positives, the first k rows of another
    label whose score lies between ``low`` and ``high`` percent of the positive's.

    Rows with a null vec_id, a null label, a null vector or a null or non-finite component take no
    part. Shorter vectors count as filled with zeros, an empty one scores zero with all. Repeated
    rows are rows of their own; rows with the anchor's vec_id are none of its positives. Scores
    are exact; those beyond 64 bits are reported as the nearest 64-bit number. Other columns are
    not read; an empty table gives an empty result."""
    rows = kept(quantised(embeddings), "negatives-rows")
    # A number of their own tells anchors of one vec_id apart; the written table fixes it.
    own_number = F.monotonically_increasing_id().alias("anchor_row")
    anchors = kept(rows.filter(F.col("vec_id") % every == 0).select("*", own_number), "negatives-anchors")
    n_rows, n_anchors = rows.count(), anchors.count()
    near = kept(positives(rows, anchors, k, block_rows, chunk_anchors), "negatives-positives")
    own = near.groupBy("anchor_id", "anchor_row").agg(F.sort_array(F.collect_set("score")).alias("targets"))
    asked = anchors.join(own, (F.col("vec_id") == F.col("anchor_id")) & (anchors["anchor_row"] == own["anchor_row"])).select(
        "vec_id", anchors["anchor_row"], "label", "q", "targets"
    )
    n_blocks, n_chunks = F.lit(max(-(-n_rows // block_rows), 1)).cast("bigint"), F.lit(max(-(-n_anchors // chunk_anchors), 1)).cast("bigint")
    blocks = rows.select("vec_id", "label", "q", dealt(n_blocks, 1).alias("block"), copies(n_chunks).alias("chunk"))
    chunks = asked.select("vec_id", "anchor_row", "label", "q", "targets", dealt(n_chunks, 2).alias("chunk"), copies(n_blocks).alias("block"))

    def windows(anchor: dict, block: Lists) -> tuple[np.ndarray, list]:
        return block.labels != anchor["label"], [(-(-low * p // 100), high * p // 100) for p in anchor["targets"]]

    found = met(blocks, chunks, ["block", "chunk"], windows, k)
    ranked = kept(first_ranked(found, ["anchor_id", "anchor_row", "place"], k), "negatives-found")
    targets = own.select("anchor_id", "anchor_row", F.posexplode("targets").alias("place", "positive_score"))
    pairs = near.select("anchor_id", "anchor_row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    windows_of = pairs.join(targets, ["anchor_id", "anchor_row", "positive_score"])
    return ranked.join(windows_of, ["anchor_id", "anchor_row", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
