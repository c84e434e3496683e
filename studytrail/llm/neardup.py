"""Near duplicates by an inverted join over MinHash coordinates.

A document's signature has ``COORDINATES`` minima; each (coordinate, value) pair is a
posting key. Two documents at similarity 0.75 collide in three quarters of the
coordinates on average, and in fewer than ``MATCHES`` with a probability of 3e-6.

Candidates come from prefix merging: with keys in ascending order of frequency, a pair
with at least MATCHES collisions shares a key among the first
``COORDINATES - MATCHES + 1`` of either side, so only those are posted. The longer lists
are skipped when candidates are formed; their collisions are counted by comparing the
two signatures. Pairs at or above the threshold are confirmed on the full shingle sets.

No list is expanded into all its pairs beyond ``SHORT`` members. Longer lists are linked
first through hubs of small buckets. Where a long list still holds several classes after that,
its members are posted once more, under the shingles of their prefixes, rarest first: a link
needs a shingle that stands in the prefixes of both, and what very many texts share, a licence
say, comes last and is posted by none. Lists of several classes up to SHORT members give their
pairs again. Longer ones are merged into groups that share members, so that a document stands in
one group however many lists it is in; per group, only documents outside the largest class are
compared with the others, in chunks of bounded weight, one pair of chunks at a time in a task.

Equal sets are one class from the start, so thousands of copies cost one signature.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studytrail.llm.common import kept, packed, whole

SHINGLE = 5
PERCENT = 75
COORDINATES = 48
MATCHES = 22
SHORT = 64
BLOCK_SHINGLES = 1 << 21
# Ids that are sent to every task to pick their texts; more of them meet the texts in a shuffle.
SMALL_IDS = 1_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``size``-word shingles; A-Z count as a-z. A text
    with fewer words gives its whole word sequence as one shingle, one without words none."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(size, len(tokens))
    count = len(tokens) - width + 1
    out = np.full(count, width, np.uint64)
    for i in range(width):
        out = (out ^ hashed[i : i + count]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


@lru_cache(maxsize=8)
def _coefficients(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(75)
    scale = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return scale[:, None], rng.integers(0, 1 << 63, coordinates, dtype=np.uint64)[:, None]


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Minimum of each coordinate's hash over the set, as int32."""
    scale, shift = _coefficients(coordinates)
    low = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 8192):
        low = np.minimum(low, (shingles[None, start : start + 8192] * scale + shift).min(axis=1))
    return (low >> _SHIFT).astype(np.uint32).view(np.int32)


def similar(shared: int, left: int, right: int, percent: int = PERCENT) -> bool:
    return 100 * shared >= percent * (left + right - shared)


def sketches(docs: DataFrame, coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit key (null for an empty set) and signature."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key_a", pa.int64()), ("key_b", pa.int64()),
         ("signature", pa.list_(pa.int32()))]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                shingles = shingle_set(text.as_py())
                if not len(shingles):
                    rows.append((doc_id, 0, None, None, None))
                    continue
                key = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
                rows.append((doc_id, len(shingles), int(key[0]), int(key[1]), signature(shingles, coordinates)))
            columns = zip(*rows) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        sketch, "doc_id long, n_shingles long, key_a long, key_b long, signature array<int>"
    )


def postings(classes: DataFrame, coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """(token, freq, rep): each class under the keys of its prefix that any other class has.

    Keys that no other class has come first in the order of frequency and use up places of
    the prefix without being posted."""
    tokens = classes.select("rep", F.posexplode("signature")).select(
        "rep", F.shiftleft(F.col("pos").cast("bigint"), 32).bitwiseOR(F.col("col").cast("bigint").bitwiseAND(0xFFFFFFFF)).alias("token")
    )
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("freq")).filter("freq > 1")
    prefix = coordinates - matches + 1
    listed = tokens.join(shared, "token").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("freq", "token"))).alias("keys")
    )
    places = F.lit(prefix - coordinates) + F.size("keys")
    posted = listed.filter(places > 0).select("rep", F.explode(F.slice("keys", F.lit(1), places)).alias("k"))
    return posted.select("k.token", "k.freq", "rep")


def hub_pairs(long: DataFrame, most: int) -> DataFrame:
    """Pairs that join the members of long lists through the least of each bucket of about
    SHORT members, then those hubs through the least of their buckets, and so on."""
    level, pairs, size = long, None, SHORT
    while True:
        buckets = F.greatest(F.ceil(F.col("freq") / size), F.lit(1)).cast("bigint")
        put = F.pmod(F.xxhash64("rep", "token", F.lit(size)), buckets)
        groups = level.groupBy("token", "freq", put.alias("bucket")).agg(
            F.min("rep").alias("hub"), F.collect_list("rep").alias("members")
        )
        stars = groups.select("hub", F.explode("members").alias("rep")).filter("rep != hub")
        pairs = stars if pairs is None else pairs.union(stars)
        if size >= most:
            return pairs
        level = groups.select("token", "freq", F.col("hub").alias("rep"))
        size *= SHORT


def list_pairs(short: DataFrame) -> DataFrame:
    """All pairs of lists with at most SHORT members."""
    a = short.select("token", F.col("rep").alias("hub"))
    b = short.select("token", "rep")
    return a.join(b, "token").filter("hub < rep").select("hub", "rep")


def matching(pairs: DataFrame, classes: DataFrame, matches: int = MATCHES, percent: int = PERCENT) -> DataFrame:
    """Distinct pairs (a < b) with at least ``matches`` collisions and sizes that allow a link."""
    ordered = pairs.select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct()
    sig = classes.select("rep", "n_shingles", "signature")
    left = sig.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("s_a"))
    right = sig.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("s_b"))
    both = ordered.join(left, "a").join(right, "b")
    collisions = F.size(F.filter(F.zip_with("s_a", "s_b", lambda x, y: x == y), lambda same: same))
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return both.filter(fits & (collisions >= matches)).select("a", "b").distinct()


def sized(table: DataFrame) -> DataFrame:
    """A stored table for the small side of a join: sent to every task up to SMALL_IDS rows,
    shuffled beyond."""
    return F.broadcast(table) if table.count() <= SMALL_IDS else table


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the documents with the given ids."""
    chosen = kept(ids.toDF("id").distinct(), "neardup-ids")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), whole("text").alias("text"))
    return texts.join(sized(chosen), "id", "left_semi")


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity."""
    needed = texts_of(docs, pairs.select("a").union(pairs.select("b")))
    both = (
        pairs.join(needed.select(F.col("id").alias("a"), F.col("text").alias("t_a")), "a")
        .join(needed.select(F.col("id").alias("b"), F.col("text").alias("t_b")), "b")
        .select("a", "b", "t_a", "t_b")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            last: tuple[str | None, np.ndarray] = (None, np.empty(0, np.uint64))
            for t_a, t_b in zip(batch.column(2), batch.column(3)):
                t_b = t_b.as_py()
                if last[0] != t_b:
                    last = (t_b, shingle_set(t_b))
                left, right = shingle_set(t_a.as_py()), last[1]
                shared = len(np.intersect1d(left, right, assume_unique=True))
                ok.append(len(left) > 0 and similar(shared, len(left), len(right), percent))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def component_labels(links: DataFrame) -> DataFrame:
    """(id, label): the least id reachable, for every id in a link (a, b).

    Each round takes the least label among the neighbours and then that label's own label,
    so long chains close in few rounds. Rounds are written to the shared folder; small ones in
    few files, with joins that need no shuffle."""
    both = kept(
        links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
        .union(links.select(F.col("b").alias("src"), F.col("a").alias("dst")))
        .distinct(),
        "neardup-edges",
    )
    few = (lambda df: df.coalesce(8)) if both.count() <= 2 * SMALL_IDS else (lambda df: df)
    labels = both.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("near"))
    labels = kept(few(labels.select("id", F.least("id", "near").alias("label"), F.lit(True).alias("moved"))), "neardup-labels")
    while not labels.filter("moved").isEmpty():
        old = sized(labels.select("id", "label"))
        near = both.join(old, both.dst == old.id).groupBy("src").agg(F.min("label").alias("near"))
        near = kept(few(near), "neardup-near")
        nearer = labels.select("id", "label").join(sized(near), F.col("id") == F.col("src")).select(
            "id", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        above = sized(labels.select(F.col("id").alias("label"), F.col("label").alias("top")))
        stepped = nearer.join(above, "label", "left").select(
            "id", F.least("label", "top").alias("label"), (F.least("label", "top") < F.col("old")).alias("moved")
        )
        labels = kept(few(stepped), "neardup-labels")
    return labels.select("id", "label")


def relabel(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the label of each rep, its own id where it has no link."""
    known = sized(labels.select(F.col("id").alias("rep"), "label"))
    return rows.join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep"))


def _size_class(n: Column) -> Column:
    """Sizes of one class differ by less than the factor 4/3 that a link allows, so links
    lie within one class or between neighbouring ones."""
    return F.floor(F.log(n) / F.log(F.lit(100 / PERCENT))).cast("int")


def mixed_lists(posted: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows (token, rep, label) of lists whose members have more than one label."""
    rows = relabel(posted.select("token", "rep"), labels)
    several = rows.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi")
    return rows.join(several.select("token"), "token", "left_semi")


def shingle_rows(texts: DataFrame) -> DataFrame:
    """(rep, token): a row for each shingle of (id, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = shingle_set(text.as_py()).view(np.int64)
                columns = [pa.array(np.full(len(found), rep, np.int64)), pa.array(found)]
                yield pa.RecordBatch.from_arrays(columns, names=["rep", "token"])

    return texts.mapInArrow(cut, "rep long, token long")


def prefix_postings(members: DataFrame, docs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(token, rep): the members (rep) under the shingles of their prefixes. A partner shares at least
    ``percent`` of a member's shingles, so of any order all but so many of its shingles, and one
    more, hold a shared one. Rare shingles come first; those of one member use up places and are
    not posted."""
    rows = kept(shingle_rows(texts_of(docs, members.select("rep"))), "neardup-shingles")
    shared = rows.groupBy("token").agg(F.count(F.lit(1)).alias("freq")).filter("freq > 1")
    listed = rows.join(shared, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("freq", "token"))).alias("keys"))
    n = F.col("n_shingles")
    prefix = n - F.ceil(n * percent / 100) + 1
    places = (prefix - (n - F.size("keys"))).cast("int")
    sized_lists = listed.join(classes.select("rep", "n_shingles"), "rep").filter(places > 0)
    return sized_lists.select("rep", F.explode(F.slice("keys", F.lit(1), places)).alias("k")).select("k.token", "rep")


def cross_pairs(lists: DataFrame) -> DataFrame:
    """Pairs of different labels in lists of at most SHORT members."""
    sizes = lists.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= SHORT)
    short = lists.join(sizes.select("token"), "token", "left_semi")
    a = short.select("token", F.col("rep").alias("hub"), F.col("label").alias("own"))
    return a.join(short, "token").filter("hub < rep and own != label").select("hub", "rep")


def grouped(lists: DataFrame) -> DataFrame:
    """(token, rep): lists that share members as one, named by its least member."""
    hubs = lists.groupBy("token").agg(F.min("rep").alias("a"))
    chained = lists.join(hubs, "token").filter("a != rep").select("a", F.col("rep").alias("b")).distinct()
    return component_labels(chained).select(F.col("label").alias("token"), F.col("id").alias("rep"))


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after further links: classes that a link joins are nodes of a second, smaller graph."""
    if links.isEmpty():
        return labels
    ends = links.select(F.col("a").alias("rep"), F.col("b").alias("other"))
    left = relabel(ends, labels).select(F.col("label").alias("a"), F.col("other").alias("rep"))
    late = component_labels(relabel(left, labels).select("a", F.col("label").alias("b")).filter("a != b"))
    moved = late.select(F.col("id").alias("label"), F.col("label").alias("top"))
    ends = relabel(ends.select("rep").union(ends.select("other")).distinct(), labels).select(F.col("rep").alias("id"), "label")
    # An id of either table has one label.
    return kept(
        labels.union(ends).distinct().join(moved, "label", "left").select("id", F.coalesce("top", "label").alias("label")),
        "neardup-labels",
    )


def settled(long: DataFrame, classes: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labels with all links inside long lists."""
    members = kept(mixed_lists(long, labels).select("rep").distinct(), "neardup-mixed")
    if members.isEmpty():
        return labels
    posted = kept(prefix_postings(members, docs, classes), "neardup-prefixes")
    pairs = matching(cross_pairs(mixed_lists(posted, labels)), classes)
    labels = joined(labels, kept(confirmed(pairs, docs), "neardup-links"))
    lists = mixed_lists(posted, labels)
    sizes = lists.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHORT)
    rest = kept(lists.join(sizes.select("token"), "token", "left_semi").select("token", "rep"), "neardup-rest")
    if rest.isEmpty():
        return labels
    return joined(labels, kept(searched(unsettled(grouped(rest), classes, docs, labels)), "neardup-searched"))


def unsettled(long: DataFrame, classes: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows to compare in blocks: per list, each chunk of the members outside the largest class so
    far ("probes") with itself, with every other such chunk and with every chunk of the largest
    class, whose members need no comparison among themselves. A chunk weighs about half of
    BLOCK_SHINGLES, so no block holds more than two of them however many labels a list has; a
    list below that weight is one block. ``side`` is 0 for rows that search in their block, 1
    for rows that are searched, 2 for both. Lists all of one label are left out. Lists of
    several blocks are cut by size first, each size class with the next larger one."""
    sizes = classes.select("rep", "n_shingles")
    members = relabel(long.select("token", "rep").join(sizes, "rep"), labels)
    weights = members.groupBy("token").agg(F.sum("n_shingles") <= BLOCK_SHINGLES).toDF("token", "one_block")
    base = _size_class(F.col("n_shingles"))
    part = lambda number, own: F.struct(number.cast("int").alias("size_class"), F.lit(own).alias("own"))
    parts = F.when(F.col("one_block"), F.array(part(F.lit(-1), True))).otherwise(F.array(part(base, True), part(base - 1, False)))
    spread = members.join(weights, "token").select("token", "rep", "label", "n_shingles", F.explode(parts).alias("s"))
    spread = spread.select("token", "rep", "label", "n_shingles", "s.size_class", "s.own")
    counts = spread.groupBy("token", "size_class", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
    lists = counts.groupBy("token", "size_class").agg(
        F.max_by(F.struct("label", "w"), "n").alias("most"), F.count(F.lit(1)).alias("n_labels"), F.sum("w").alias("w")
    ).filter("n_labels > 1")
    chunks = lambda w: F.greatest(F.ceil(2 * w / BLOCK_SHINGLES), F.lit(1)).cast("bigint")
    lists = lists.select(
        "token", "size_class", F.col("most.label").alias("major"), (F.col("w") <= BLOCK_SHINGLES).alias("one_block"),
        chunks(F.col("w") - F.col("most.w")).alias("probes"), chunks(F.col("most.w")).alias("dealt"),
    )
    # Chunks of probes are numbered first, those of the largest class behind them.
    is_major = F.col("label") == F.col("major")
    dealt = F.pmod(F.xxhash64("rep"), F.when(is_major, F.col("dealt")).otherwise(F.col("probes")))
    chunk, all_chunks, zero = F.col("chunk"), F.col("probes") + F.col("dealt"), F.lit(0).cast("bigint")
    rows = spread.join(lists, ["token", "size_class"]).withColumn("chunk", F.when(is_major, F.col("probes")).otherwise(zero) + dealt)
    met = F.sequence(zero, F.when(is_major, F.col("probes")).otherwise(all_chunks) - 1)
    place = lambda block, side: F.struct(block.alias("block"), side.alias("side"))
    places = F.when(F.col("one_block"), F.array(place(zero, F.lit(2)))).otherwise(
        F.transform(met, lambda other: place(
            F.least(chunk, other) * all_chunks + F.greatest(chunk, other),
            F.when(other > chunk, F.lit(0)).when(other < chunk, F.lit(1)).otherwise(F.lit(2)),
        ))
    )
    rows = rows.select("token", "size_class", "rep", "label", "own", F.explode(places).alias("p"))
    rows = kept(rows.select("token", "size_class", "rep", "label", "own", "p.block", "p.side"), "neardup-blocks")
    return rows.join(shingle_sets(texts_of(docs, rows.select("rep")).withColumnRenamed("id", "rep")), "rep")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(rep, shingles): sets as bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([shingle_set(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), sets], names=["rep", "shingles"])

    return texts.mapInArrow(cut, "rep long, shingles binary")


def block_links(
    members: list[tuple[int, int, bool, bytes]], percent: int = PERCENT, sides: list[int] | None = None
) -> list[tuple[int, int]]:
    """Links that join the members (rep, label, own, set) of one block as all links would; with
    ``sides``, as all links from a member of side 0 or 2 to one of side 1 or 2 would.

    Members of one label are joined already. A search starts at members outside the largest
    label and meets every member not yet joined to it; intersections are counted over the
    block's own posting lists."""
    side = np.array(sides if sides is not None else [2] * len(members))
    one_chunk = bool((side == 2).all())
    sets = [np.frombuffer(m[3], np.uint64) for m in members]
    sizes = np.array([len(s) for s in sets], np.int64)
    own = np.array([m[2] for m in members])
    names, label = np.unique(np.array([m[1] for m in members]), return_inverse=True)
    met = np.nonzero(side != 0)[0]
    if not len(met):
        return []
    owner = np.repeat(met, sizes[met])
    flat = np.concatenate([sets[j] for j in met])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    group = label.copy()
    counts = np.bincount(label, minlength=len(names))
    links = []
    for i in np.argsort(counts[label], kind="stable"):
        if side[i] == 1:
            continue
        if one_chunk and counts[label[i]] == counts.max() and counts[label[i]] * 2 > len(members):
            break
        others = group != group[i]
        if not others.any():
            break
        lo, hi = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
        hits = np.concatenate([owner[a:b] for a, b in zip(lo, hi)])
        shared = np.bincount(hits, minlength=len(sets))
        good = others & (side != 0) & (own | own[i]) & (100 * shared >= percent * (sizes + sizes[i] - shared))
        for g in np.unique(group[good]):
            j = int(np.nonzero(good & (group == g))[0][0])
            links.append((members[i][0], members[j][0]))
            group[group == g] = group[i]
    return [(min(a, b), max(a, b)) for a, b in links if a != b]


def searched(rows: DataFrame) -> DataFrame:
    """Links found inside the blocks of ``unsettled``; each block is one run of sorted rows."""
    keys = ["token", "size_class", "block"]
    sorted_rows = (
        rows.select(*keys, "rep", "label", "own", "side", "shingles").repartition(*keys).sortWithinPartitions(*keys, "rep")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, members, sides = None, [], []

        def links() -> pa.RecordBatch:
            found = block_links(members, sides=sides) if len(members) > 1 else []
            ends = list(zip(*found)) or [[], []]
            return pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], names=["a", "b"])

        for batch in batches:
            for token, size_class, block, rep, label, own, side, shingles in zip(*[c.to_pylist() for c in batch.columns]):
                if (token, size_class, block) != current:
                    yield links()
                    current, members, sides = (token, size_class, block), [], []
                members.append((rep, label, own, shingles))
                sides.append(side)
        yield links()

    return sorted_rows.mapInArrow(search, "a long, b long")


def shared_ids(sketched: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes that rows of one doc_id lie in."""
    key = F.struct("key_a", "key_b")
    several = sketched.groupBy("doc_id").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).filter("lo != hi")
    rows = sketched.join(several.select("doc_id"), "doc_id", "left_semi").join(classes, ["key_a", "key_b"])
    reps = rows.groupBy("doc_id").agg(F.min("rep").alias("a"), F.collect_set("rep").alias("reps"))
    return reps.select("a", F.explode("reps").alias("b")).filter("a != b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable over links), kept.

    One row per input row. A document without words (null or empty text) has no shingle, is
    linked with nothing and kept. Rows with one doc_id are one node: their links add up, each
    keeps its own n_shingles, and an exact repeat has the same values as its original. A row
    whose doc_id is null takes no part: component_id is null and it is kept. Columns other
    than doc_id and text are not read; an empty table gives an empty result."""
    named = docs.select("doc_id", "text").filter("doc_id is not null")
    sketched = kept(sketches(docs), "neardup-sketches")
    classes = kept(
        sketched.filter("doc_id is not null and key_a is not null")
        .groupBy("key_a", "key_b")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")),
        "neardup-classes",
    )
    lists = kept(postings(classes), "neardup-postings")
    most = lists.agg(F.max("freq")).first()[0] or 0
    long = lists.filter(F.col("freq") > SHORT)
    pairs = list_pairs(lists.filter(F.col("freq") <= SHORT))
    if most > SHORT:
        pairs = pairs.union(hub_pairs(long, most))
    candidates = kept(matching(pairs, classes), "neardup-candidates")
    nodes = sketched.filter("doc_id is not null and key_a is not null").select("doc_id", "key_a", "key_b")
    links = kept(
        confirmed(candidates, named).union(shared_ids(nodes, classes.select("key_a", "key_b", "rep"))), "neardup-links"
    )
    labels = component_labels(links)
    if most > SHORT:
        labels = settled(long, classes, named, labels)
    # Several classes may share a representative's id only if rows share a doc_id.
    named_classes = relabel(classes.select("key_a", "key_b", "rep"), labels)
    out = sketched.select("doc_id", "n_shingles", "key_a", "key_b").join(
        named_classes.select("key_a", "key_b", "label"), ["key_a", "key_b"], "left"
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one left of every group: the one with the least doc_id, and of rows
    with that doc_id the one whose text hashes lowest. Rows without doc_id stay."""
    chosen = near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    rows = packed(docs).withColumn("doc_id", F.col("row.doc_id").cast("bigint"))
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("row.text"))
    named = rows.join(chosen, "doc_id", "left_semi").withColumn("rank", F.row_number().over(first)).filter("rank = 1")
    return named.select("row.*").union(rows.filter("doc_id is null").select("row.*"))
