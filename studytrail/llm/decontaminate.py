"""Benchmark decontamination by template windows with typed slots.

Texts become sequences of template words: numbers, names and units turn into placeholders,
all other words are lowered and stripped of punctuation. Windows of template words of items
and documents are joined by hash; the values behind the placeholders are then compared: one
value of the item must stand for one value of the document, and windows that say otherwise do
not count. A name without a meaning that prevails makes all windows with slots chance. So a question with other numbers and names is found as well as a verbatim one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrail.llm.common import kept, packed

WINDOW = 5
# Words of a window that have to be words and not placeholders.
LITERALS = 3
# Share of the windows with a name that its most frequent meaning needs, else it has none.
PREVAILS = 75
# Share of an item's windows that make a document a leak.
PERCENT = 40
# Windows of items that are sent to every task as a filter (8 bytes each); with more of them
# all windows of the documents go into the join.
FILTER_WINDOWS = 1_000_000

# Names of units that a number may stand before.
UNITS = frozenset(
    "km m cm mm mi ft in yd kg g mg lb oz l ml h hr hrs min mins s sec secs ms day days week weeks month months year years "
    "hour hours minute minutes second seconds meter meters metre metres kilometer kilometers kilometre kilometres mile miles "
    "foot feet inch inches yard yards gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres "
    "dollar dollars euro euros cent cents usd eur gbp percent degrees degree celsius fahrenheit watt watts volt volts "
    "byte bytes kb mb gb tb".split()
)
NUMBER_WORDS = frozenset(
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
NUMBER = re.compile(r"[-+]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%)?$")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD, _NUM, _NAME, _UNIT, _NONE = range(5)


class Vocabulary(dict):
    """word -> number of its row: hash as a plain word, kind by itself, ends a sentence."""

    MOST = 500_000

    def __init__(self):
        self.start()

    def start(self) -> None:
        self.clear()
        self.hashes = np.empty(1 << 12, np.uint64)
        self.kinds = np.empty(1 << 12, np.uint8)
        self.units = np.empty(1 << 12, bool)
        self.ends = np.empty(1 << 12, bool)

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.hashes):
            for name in ("hashes", "kinds", "units", "ends"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.empty_like(old)]))
        core = EDGE.sub("", word)
        low = core.lower()
        if not core:
            kind = _NONE
        elif NUMBER.match(core) or low in NUMBER_WORDS:
            kind = _NUM
        elif core[0].isupper():
            kind = _NAME
        else:
            kind = _WORD
        self.hashes[at] = xxhash.xxh3_64_intdigest(low.encode("utf-8", "surrogatepass"))
        self.kinds[at] = kind
        self.units[at] = low in UNITS
        self.ends[at] = word[-1:] in ".!?:" or word.endswith(('."', '!"', '?"'))
        self[word] = at
        return at


_PLACEHOLDERS = np.array([xxhash.xxh3_64_intdigest(f"\0{name}") for name in ("", "num", "name", "unit", "")], np.uint64)


def template(text: str | None, vocabulary: Vocabulary) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(words, hash and kind of each template word, its place among the text's words).

    A capital letter makes a name only inside a sentence; a unit is one only behind a number;
    words of punctuation alone are left out."""
    if len(vocabulary) > vocabulary.MOST:
        vocabulary.start()
    words = (text or "").split()
    rows = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
    kinds, ends = vocabulary.kinds[rows], vocabulary.ends[rows]
    place = np.nonzero(kinds != _NONE)[0]
    kinds, rows = kinds[place], rows[place]
    opens = np.ones(len(place), bool)
    opens[1:] = ends[place[:-1]]
    kinds = np.where(opens & (kinds == _NAME), _WORD, kinds)
    after_number = np.zeros(len(place), bool)
    after_number[1:] = kinds[:-1] == _NUM
    kinds = np.where(after_number & vocabulary.units[rows], _UNIT, kinds)
    hashes = np.where(kinds == _WORD, vocabulary.hashes[rows], _PLACEHOLDERS[kinds])
    return words, hashes, kinds, place


def windows(hashes: np.ndarray, kinds: np.ndarray, width: int, literals: int = LITERALS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``width`` words, and which of them have enough plain words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool)
    out = np.full(count, width, np.uint64)
    plain = np.zeros(count, np.int64)
    for i in range(width):
        out = (out ^ hashes[i : i + count]) * _MIX
        out ^= out >> np.uint64(31)
        plain += kinds[i : i + count] == _WORD
    return out, plain >= min(literals, width)


def slots(words: list[str], kinds: np.ndarray, place: np.ndarray, at: int, width: int) -> list[str]:
    """Kinds and values behind the placeholders of one window."""
    return [str(kinds[i]) + EDGE.sub("", words[place[i]]).lower() for i in range(at, at + width) if kinds[i] != _WORD]


HIT_SCHEMA = "id long, width int, window long, at long, slots array<string>"


def _hits(widths: list[int], wanted: np.ndarray | None):
    """A function for mapInArrow over (id, text): the windows of every text, or those in
    ``wanted`` (sorted hashes)."""
    rough = None
    if wanted is not None:
        rough = np.zeros(1 << 20, bool)
        rough[(wanted >> np.uint64(44)).astype(np.int64)] = True

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string())]
        names = ["id", "width", "window", "at", "slots"]
        for batch in batches:
            rows: list[tuple] = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words, hashes, kinds, place = template(text.as_py(), vocabulary)
                for width in widths:
                    hashed, good = windows(hashes, kinds, width)
                    if rough is not None:
                        good &= rough[(hashed >> np.uint64(44)).astype(np.int64)]
                    at = np.nonzero(good)[0]
                    if wanted is not None and len(at):
                        spot = np.searchsorted(wanted, hashed[at]).clip(max=len(wanted) - 1)
                        at = at[wanted[spot] == hashed[at]]
                    signed = hashed.view(np.int64)
                    rows += [(name, width, int(signed[i]), int(i), slots(words, kinds, place, i, width)) for i in at.tolist()]
                if len(rows) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows = []
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return found


def item_windows(items: DataFrame) -> DataFrame:
    """Windows (id, width, window, at, slots) of benchmark items (id, text). An item with fewer
    template words than a window is one window as a whole."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                size = len(template(text.as_py(), vocabulary)[1])
                if size:
                    own = pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([text.as_py()])], names=["id", "text"])
                    yield from _hits([min(size, WINDOW)], None)([own])

    return items.mapInArrow(cut, HIT_SCHEMA)


def prevailing(found: DataFrame, run: list[str]) -> DataFrame:
    """The windows (run, at, pairs) that agree with the most frequent meaning of each of their
    values in the run, of equally frequent ones the item's own. Windows without slots always
    stay. Equal numbers may mean different things, a name means one person: in a run where a name
    has no meaning in PREVAILS percent of its windows only those without slots stay."""
    values = found.select(*run, F.explode(F.array_distinct("pairs")).alias("p")).select(*run, "p.theirs", "p.ours")
    counts = values.groupBy(*run, "theirs", "ours").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*run, "theirs").agg(
        F.max_by("ours", F.struct("n", F.col("ours") == F.col("theirs"), "ours")).alias("meaning"),
        (F.max("n") * 100 < F.sum("n") * PREVAILS).alias("open"),
    )
    unnamed = F.col("theirs").startswith(str(_NAME)) & F.col("open")
    meanings = best.groupBy(*run).agg(
        F.map_from_entries(F.collect_list(F.struct("theirs", "meaning"))).alias("meanings"), F.bool_or(unnamed).alias("chance")
    )
    agrees = F.forall("pairs", lambda p: F.col("meanings")[p["theirs"]] == p["ours"])
    return found.join(meanings, run).filter((F.size("pairs") == 0) | (~F.col("chance") & agrees)).select(*run, "at", "pairs")


def leaks(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, item_windows, n_windows, kind) for every document that holds an item.

    n_windows counts the item's windows found with consistent slots, at least ``percent`` of
    them; kind is "verbatim" if all slot values are the item's own in those, else
    "reparameterised". Windows with fewer than three plain words say nothing, and an item
    without other windows cannot be found. Null or empty texts and rows without an id hold
    nothing and are no items. Repeated rows give the same pair once; rows that share an id
    count as one document (item). Ties do not arise. Other columns are not read."""
    named_items = items.select(F.col("item_id").cast("bigint").alias("id"), "text").filter("id is not null").distinct()
    cut = kept(item_windows(named_items), "item-windows")
    sizes = cut.groupBy(F.col("id").alias("item_id")).agg(F.count_distinct("at").alias("item_windows"))
    facts = cut.agg(F.count_distinct("window").alias("n"), F.sort_array(F.collect_set("width")).alias("widths")).first()
    wanted = None
    if facts["n"] <= FILTER_WINDOWS:
        hashes = [r["window"] for r in cut.select("window").distinct().collect()]
        wanted = np.sort(np.array(hashes, np.int64).view(np.uint64))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").filter("id is not null")
    if not facts["n"]:
        texts = texts.limit(0)
    hits = texts.mapInArrow(_hits(facts["widths"], wanted), HIT_SCHEMA)
    theirs = cut.select("window", F.col("id").alias("item_id"), F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    met = hits.join(theirs, "window").select(
        F.col("id").alias("doc_id"), "item_id", "item_at", (F.col("at") - F.col("item_at")).alias("shift"),
        F.arrays_zip(F.col("item_slots").alias("theirs"), F.col("slots").alias("ours")).alias("pairs"),
    )
    # Along one diagonal the words stand in the item's order; there a value has one meaning.
    run = ["doc_id", "item_id", "shift"]
    runs = kept(met.groupBy(*run).agg(F.collect_set(F.struct("item_at", "pairs")).alias("found")), "window-runs")
    pairs = F.array_distinct(F.flatten("found.pairs"))
    one_meaning = F.size(pairs) == F.size(F.array_distinct(F.transform(pairs, lambda p: p["theirs"])))
    each = lambda rows: rows.select(*run, F.explode("found").alias("w")).select(*run, F.col("w.item_at").alias("at"), "w.pairs")
    sound = each(runs.filter(one_meaning)).unionByName(prevailing(each(runs.filter(~one_meaning)), run))
    same = ~F.exists("pairs", lambda p: p["theirs"] != p["ours"])
    sound = sound.select("doc_id", "item_id", "at", same.alias("same"))
    counted = sound.groupBy("doc_id", "item_id").agg(
        F.count_distinct("at").alias("n_windows"), F.count_distinct(F.when(F.col("same"), F.col("at"))).alias("n_same")
    )
    return (
        counted.join(sizes, "item_id")
        .filter(F.col("n_windows") * 100 >= F.col("item_windows") * percent)
        .select(
            "doc_id", "item_id", "item_windows", "n_windows",
            F.when(F.col("n_same") == F.col("n_windows"), "verbatim").otherwise("reparameterised").alias("kind"),
        )
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item; rows without an id stay."""
    bad = kept(leaks(docs, items).select("doc_id").distinct(), "leaking-documents")
    rows = packed(docs).withColumn("doc_id", F.col("row.doc_id").cast("bigint"))
    return rows.join(bad, "doc_id", "left_anti").select("row.*")
