"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The pairs of adjacent symbols form an agenda ordered by the score of the piece they would
become, the leftmost first among equals; the best one is merged, and the pairs at its two
edges are entered anew, until no pair is a piece. A merge needs a piece that holds the
characters on both sides of the seam, so a text falls apart wherever no piece has the two
characters next to each other. Those parts are independent and each different one is encoded
once while it is remembered. Short parts keep their agendas as rows of one matrix and merge in
step, long ones have a heap.

Every whole text is also encoded by the sentencepiece library, an Arrow batch at a time;
``agreed`` tells whether both gave the same ids. The ids are the library's where they differ.
"""

from __future__ import annotations

import codecs
import heapq
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parts remembered per task process in each of two generations, about 120 MB in all.
REMEMBERED = 300_000
# Longest part whose agenda is a matrix row; longer ones have a heap.
IN_STEP = 48
# Bytes of the texts that are handled at a time; one text more at most.
AT_ONCE = 2 << 20

# Fixed values of the file format: the mark that stands for a space, the text of an unknown piece.
SPACE_MARK = "▁"
UNKNOWN_TEXT = " ⁇ "

_NONE = np.iinfo(np.int32).max

# Every byte that is no UTF-8 becomes one replacement character.
codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceCoder:
    """Ids of texts and texts of ids under one model file."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.remembered = remembered
        model, size = self.library, self.library.vocab_size()
        self.end_id, self.unknown_id = model.eos_id(), model.unk_id()
        self.byte_ids = np.full(256, -1, np.int32)
        self.surfaces: list[bytes] = [b""] * size
        names, scores = {}, np.zeros(size)
        for i in range(size):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
                self.surfaces[i] = bytes([int(name[3:5], 16)])
            elif model.is_unknown(i):
                self.surfaces[i] = UNKNOWN_TEXT.encode()
            elif not model.is_control(i):
                self.surfaces[i] = name.replace(SPACE_MARK, " ").encode()
                names[name], scores[i] = i, model.get_score(i)
        self.stored = pa.array(self.surfaces, pa.large_binary())
        self.control = np.array([model.is_control(i) for i in range(size)])
        self.marked = np.zeros(size, bool)
        self.marked[[i for name, i in names.items() if name.startswith(SPACE_MARK)]] = True
        self.unused = {i for i in names.values() if model.is_unused(i)}
        self.has_bytes = bool((self.byte_ids >= 0).all())
        # Characters that stand in some piece, as symbols; those that are no piece come behind them.
        letters = sorted({c for name in names for c in name})
        self.symbols = dict(names)
        for c in letters:
            self.symbols.setdefault(c, len(self.surfaces) + len(self.symbols))
        self.symbol_of = np.full(0x110000, -1, np.int32)
        self.symbol_of[[ord(c) for c in letters]] = [self.symbols[c] for c in letters]
        self._learn_seams(names, letters)
        self._learn_pairs(names, scores)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn_seams(self, names: dict[str, int], letters: list[str]) -> None:
        """Which characters stand next to each other in some piece."""
        place = {c: i + 1 for i, c in enumerate(letters)}
        self.class_of = np.zeros(0x110000, np.uint16 if len(letters) < 65_535 else np.int32)
        self.class_of[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        pairs = {(place[a], place[b]) for name in names for a, b in zip(name, name[1:])}
        self.width = len(letters) + 1
        self.joined = np.zeros(self.width * self.width, bool)
        self.joined[[a * self.width + b for a, b in pairs]] = True

    def _learn_pairs(self, names: dict[str, int], scores: np.ndarray) -> None:
        """The merges: a key for each pair of symbols that make a piece, its rank and the piece."""
        self.base = max(self.symbols.values(), default=0) + 1
        merges = {}
        for name, number in names.items():
            for k in range(1, len(name)):
                left, right = self.symbols.get(name[:k]), self.symbols.get(name[k:])
                if left is not None and right is not None:
                    merges[left * self.base + right] = number
        self.keys = np.array(sorted(merges) + [np.iinfo(np.int64).max], np.int64)
        self.made = np.array([merges[k] for k in self.keys[:-1].tolist()] + [0], np.int32)
        # Equal scores have equal ranks; the best has rank 0.
        _, rank = np.unique(-scores, return_inverse=True)
        self.rank = rank.astype(np.int32)
        self.merges = merges

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair of symbols; the rank is _NONE where they make no piece."""
        key = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.keys, key)
        good = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(good, self.rank[self.made[at]], _NONE), self.made[at]

    def in_step(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts of at most IN_STEP characters: each round merges the best pair of every part
        that has one."""
        out: dict[str, bytes] = {}
        lengths = np.array([len(p) for p in parts])
        for low, width in ((0, 8), (8, 16), (16, IN_STEP)):
            mine = [parts[i] for i in np.flatnonzero((lengths > low) & (lengths <= width)).tolist()]
            if mine:
                points = np.frombuffer("".join([p.ljust(width, "\0") for p in mine]).encode("utf-32-le"), np.uint32)
                size = np.array([len(p) for p in mine])
                symbols = self.symbol_of[points].reshape(len(mine), width)
                # Behind a part's end stands no symbol.
                symbols[np.arange(width) >= size[:, None]] = -2
                self._merge(mine, symbols, size, out)
        return out

    def _merge(self, parts: list[str], symbols: np.ndarray, size: np.ndarray, out: dict[str, bytes]) -> None:
        rows = np.arange(len(symbols))
        ranks, _ = self._pair(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            best = ranks.argmin(axis=1)
            live = ranks[np.arange(len(rows)), best] < _NONE
            self._finish(parts, rows[~live], symbols[~live], size[~live], out)
            rows, symbols, ranks, best, size = rows[live], symbols[live], ranks[live], best[live], size[live] - 1
            if not len(rows):
                break
            n, width = symbols.shape
            at = np.arange(n)
            _, made = self._pair(symbols[at, best], symbols[at, best + 1])
            symbols[at, best] = made
            stay = np.ones((n, width), bool)
            stay[at, best + 1] = False
            symbols = symbols[stay].reshape(n, width - 1)
            if width == 2:
                ranks = np.full((n, 1), _NONE, np.int32)
                continue
            # The pair that was merged leaves the agenda, those at its edges enter anew.
            stay = np.ones((n, width - 1), bool)
            stay[at, best] = False
            ranks = ranks[stay].reshape(n, width - 2)
            left = best > 0
            ranks[at[left], best[left] - 1] = self._pair(symbols[at[left], best[left] - 1], symbols[at[left], best[left]])[0]
            right = best < width - 2
            ranks[at[right], best[right]] = self._pair(symbols[at[right], best[right]], symbols[at[right], best[right] + 1])[0]

    def _finish(self, parts: list[str], rows: np.ndarray, symbols: np.ndarray, size: np.ndarray, out: dict[str, bytes]) -> None:
        """Ids of the rows without a pair left; those that are all pieces are ids already."""
        symbols = np.ascontiguousarray(symbols, np.int32)
        plain = ((symbols == -2) | ((symbols >= 0) & (symbols < len(self.surfaces)))).all(axis=1)
        flat, step = symbols.tobytes(), 4 * symbols.shape[1]
        for k, (r, n, good) in enumerate(zip(rows.tolist(), size.tolist(), (plain & (not self.unused)).tolist())):
            out[parts[r]] = flat[k * step : k * step + 4 * n] if good else self._ids(parts[r], symbols[k, :n].tolist())

    def by_heap(self, part: str) -> list[int]:
        """Symbols of one part of any length, by a heap of (rank, place, symbols on both sides)."""
        symbols = self.symbol_of[np.frombuffer(part.encode("utf-32-le"), np.uint32)].tolist()
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def enter(i: int, j: int) -> None:
            if i >= 0 and j < n and symbols[i] >= 0 and symbols[j] >= 0:
                piece = self.merges.get(symbols[i] * self.base + symbols[j])
                if piece is not None:
                    heapq.heappush(agenda, (int(self.rank[piece]), i, j, symbols[i], symbols[j]))

        for i in range(n - 1):
            enter(i, i + 1)
        gone = [False] * n
        while agenda:
            _, i, j, a, b = heapq.heappop(agenda)
            if gone[i] or gone[j] or after[i] != j or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i] = self.merges[a * self.base + b]
            gone[j] = True
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            enter(before[i], i)
            enter(i, after[i])
        return [s for s, dead in zip(symbols, gone) if not dead]

    def _apart(self, symbol: int) -> list[int]:
        """The symbols an unused piece came from, by the merges its text makes without it."""
        if symbol not in self.unused:
            return [symbol]
        name = self.library.id_to_piece(symbol)
        for k in range(1, len(name)):
            left, right = self.symbols.get(name[:k]), self.symbols.get(name[k:])
            if left is not None and right is not None:
                return self._apart(left) + self._apart(right)
        return [symbol]

    def _ids(self, part: str, symbols: list[int]) -> bytes:
        """Ids of a part; what is no piece becomes its bytes, or unknown."""
        if self.unused:
            symbols = [s for symbol in symbols for s in self._apart(symbol)]
        if min(symbols) >= 0 and max(symbols) < len(self.surfaces):
            return array("i", symbols).tobytes()
        out, at = [], 0
        for s in symbols:
            if 0 <= s < len(self.surfaces):
                out.append(s)
                at += len(self.library.id_to_piece(s))
                continue
            out.extend(self.byte_ids[list(part[at].encode())].tolist() if self.has_bytes else [self.unknown_id])
            at += 1
        return array("i", out).tobytes()

    def _learn(self, parts: list[str]) -> None:
        self.young.update(self.in_step([p for p in parts if len(p) <= IN_STEP]))
        for p in parts:
            if len(p) > IN_STEP:
                self.young[p] = self._ids(p, self.by_heap(p))

    def cut(self, texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
        """The normalised texts, cut where no piece has the two characters next to each other: the
        parts of all texts in order, and the number of the first part of each text, with that of all."""
        normal = [self.library.normalize(t) for t in texts]
        ends = np.cumsum([len(t) for t in normal])
        whole = "".join(normal)
        if not whole:
            return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
        kind = self.class_of[np.frombuffer(whole.encode("utf-32-le"), np.uint32)]
        beside = np.multiply(kind[:-1], self.width, dtype=np.int64)
        beside += kind[1:]
        apart = ~self.joined[beside]
        # Parts do not reach from text to text.
        apart[ends[(ends > 0) & (ends < len(whole))] - 1] = True
        cuts = np.flatnonzero(apart) + 1
        first = np.searchsorted(np.append(cuts, len(whole)), np.append(0, ends), "right")
        stored = np.frombuffer(whole.encode(), np.uint8)
        # Characters begin at the bytes that do not go on with one.
        begins = np.flatnonzero((stored & 0xC0) != 0x80)
        edges = np.concatenate([[0], begins[cuts], [len(stored)]]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(stored)), first

    def parts(self, text: str) -> list[str]:
        """The parts of one text."""
        return self.cut([text])[0].to_pylist()

    def _known(self, parts: list[str]) -> list[bytes]:
        """Ids of different parts, remembered or learnt."""
        known = list(map(self.young.get, parts))
        absent = [i for i, ids in enumerate(known) if ids is None]
        missing = []
        for i in absent:
            if (ids := self.old.get(parts[i])) is not None:
                self.young[parts[i]] = ids
            else:
                missing.append(parts[i])
        self._learn(missing)
        for i in absent:
            known[i] = self.young[parts[i]]
        return known

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text, without the end id."""
        parts, first = self.cut(texts)
        coded = parts.dictionary_encode()
        known = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        # The ids of the different parts, laid out as the parts follow each other.
        sizes = np.array([len(ids) for ids in known], np.int64) // 4
        of = coded.indices.to_numpy()
        counts = sizes[of]
        ends = np.concatenate([[0], np.cumsum(counts)])
        shift = (np.cumsum(sizes) - sizes)[of] - ends[:-1]
        ids = np.frombuffer(b"".join(known), np.int32)[np.repeat(shift, counts) + np.arange(ends[-1])]
        found = [ids[a:b] for a, b in pairwise(ends[first].tolist())]
        if len(self.young) > self.remembered:
            self.old, self.young = self.young, {}
        if not self.has_bytes:
            # Unknown characters in a row are one unknown piece.
            unknown = [ids == self.unknown_id for ids in found]
            found = [ids[~(u & np.concatenate([[False], u[:-1]]))] for ids, u in zip(found, unknown)]
        return found

    def decode(self, ids: np.ndarray) -> str:
        """Text of any ids: pieces joined, marks as spaces, the first mark dropped, bytes as UTF-8.
        Control ids have no text, but end a run of bytes."""
        control = self.control[ids]
        if control[:-1].any():
            at = [-1, *np.flatnonzero(control).tolist(), len(ids)]
            runs = [ids[a + 1 : b] for a, b in zip(at, at[1:])]
        else:
            runs = [ids]
        text = "".join([b"".join(map(self.surfaces.__getitem__, r.tolist())).decode("utf-8", "each_byte") for r in runs])
        seen = ids[~control]
        return text[1:] if len(seen) and self.marked[seen[0]] else text

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of many runs of ids that lie one behind the other, as ``decode`` gives each."""
        edges = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        first, last = edges[:-1][counts > 0], edges[1:][counts > 0] - 1
        marked = np.zeros(len(counts), bool)
        marked[counts > 0] = self.marked[ids[first]]
        inside = self.control[ids]
        inside[last] = False
        joined = pc.binary_join(pa.LargeListArray.from_arrays(edges, self.stored.take(pa.array(ids))), pa.scalar(b"", pa.large_binary()))
        texts = [b.decode("utf-8", "each_byte")[m:] for b, m in zip(joined.to_pylist(), marked.tolist())]
        for k in np.unique(np.searchsorted(edges, np.flatnonzero(inside), "right") - 1).tolist():
            texts[k] = self.decode(ids[edges[k] : edges[k + 1]])
        return texts


@lru_cache(maxsize=2)
def coder(path: str) -> PieceCoder:
    """One coder per process and model."""
    return PieceCoder(path)


def runs(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in order, about AT_ONCE bytes at a time."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = int(upto[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + AT_ONCE, "right")))
        yield texts.slice(at, end - at)
        at = end


def lists(arrays: list[np.ndarray]) -> pa.Array:
    """An Arrow list array of int32 runs."""
    edges = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(edges, np.concatenate([np.empty(0, np.int32), *arrays]).astype(np.int32))


def runs_of(ids: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows one behind the other, and how many each row has; null has none."""
    return ids.flatten().to_numpy(), pc.fill_null(pc.list_value_length(ids), 0).to_numpy()


ENCODED = "doc_id long, ids array<int>, agreed boolean"


def encoded(docs: DataFrame, model: str, checked: bool = True, decode: bool = False) -> DataFrame:
    """(doc_id, ids, agreed): one row per input row, the ids of the whole text and the end id; with
    ``decode`` also ``text``, decoded from these ids in the same task.

    A null or empty text has the end id alone. Null doc_ids stay null and repeated rows stay
    repeated; columns other than doc_id and text are not read; an empty table gives an empty
    result. ``agreed`` is false where the library gave other ids, which then stand in ``ids``;
    null without ``checked``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = coder(model)
        end = np.array([known.end_id], np.int32)
        for batch in batches:
            at = 0
            for some in runs(batch.column(1)):
                texts = pc.fill_null(some, "").to_pylist()
                found = known.encode(texts)
                agreed: list[bool | None] = [None] * len(texts)
                if checked:
                    for i, text in enumerate(texts):
                        ids = known.library.encode(text)
                        agreed[i] = array("i", ids).tobytes() == found[i].tobytes()
                        if not agreed[i]:
                            found[i] = np.array(ids, np.int32)
                ended = lists([np.concatenate([f, end]) for f in found])
                columns = {"doc_id": batch.column(0).slice(at, len(texts)), "ids": ended, "agreed": pa.array(agreed, pa.bool_())}
                if decode:
                    columns["text"] = pa.array(known.decode_all(*runs_of(ended)), pa.string())
                yield pa.RecordBatch.from_pydict(columns)
                at += len(texts)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, ENCODED + (", text string" if decode else "")
    )


def decoded(tokens: DataFrame, model: str) -> DataFrame:
    """The rows (doc_id, ids, agreed) with the text of their ids, which may be any ids of the
    vocabulary; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = coder(model)
        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch.slice(at, 256)
                texts = known.decode_all(*runs_of(some.column(1)))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "agreed", "text"])

    return tokens.select("doc_id", "ids", "agreed").mapInArrow(run, ENCODED + ", text string")


def token_digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the text decoded from them, agreed."""
    back = encoded(docs, model, decode=True)
    return back.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
        "agreed",
    )


def disagreements(docs: DataFrame, model: str) -> dict[bool, int]:
    """How many texts the agenda and the library gave the same ids for, and how many not."""
    return Counter({r["agreed"]: r["count"] for r in encoded(docs, model).groupBy("agreed").count().collect()})
