"""Token ids of whole texts, and their lengths.

``Encoder`` gives the ids that the tokenizers library gives for a text. Byte-level BPE never
merges across the pieces its pattern cuts, so texts may be cut where such pieces meet for sure:
in front of a single space, of a line end, and of punctuation behind a letter. Each different
part of a batch is encoded once. Texts with longer runs of white space are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 2
# Words remembered per task process, about 100 MB; beyond that the rarer half is dropped.
REMEMBERED = 500_000
# Words encoded together; the library needs about 100 bytes for each of their bytes meanwhile.
LEARNED_AT_ONCE = 32_768
# Bytes of the texts that are cut at a time.
AT_ONCE = 4 << 20

# White space as the pattern of the vocabulary sees it.
_SPACE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Marks a cut that takes no space with it; texts that hold it are encoded whole.
_CUT = "\x01"
_WHOLE = f"{_SPACE}{{3}}|{_SPACE}{{2}}\\z|{_CUT}"
# A letter and a sign of which every Unicode version says so.
_SIGN = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-/:-@\[-`{-~])"


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(sizes, dtype=np.int32)
    return np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) + np.repeat(starts - (ends - sizes), sizes)


class Encoder:
    """Ids of texts under one vocabulary file (byte-level BPE)."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remembered = remembered
        # No cut inside the name of a special token.
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "|".join([_WHOLE, *special])
        vocabulary = self.tokenizer.get_vocab()
        # In the byte-level alphabet a token has one character per byte.
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.empty(1 << 16, np.int32)
        self.sizes = np.empty(1 << 16, np.int32)
        # Batches that had the word, halved with every cleaning.
        self.met = np.empty(1 << 16, np.int32)

    def _drop_rare(self) -> None:
        """Keep the words that most batches had, half of the limit at most."""
        n = len(self.places)
        least = 2
        while (keep := self.met[:n] >= least).sum() > self.remembered // 2:
            least *= 2
        words = compress(list(self.places), keep.tolist())
        starts, sizes, met = self.starts[:n][keep], self.sizes[:n][keep], self.met[:n][keep]
        ids = self.flat[spread(starts, sizes)]
        self._forget()
        self._remember(list(words), ids, sizes)
        self.met[: len(met)] = met // 2

    def direct(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _remember(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Append the words' ids, which follow each other in ``ids``."""
        first = len(self.places)
        while first + len(keys) > len(self.starts):
            self.starts, self.sizes, self.met = (
                np.concatenate([a, np.empty_like(a)]) for a in (self.starts, self.sizes, self.met)
            )
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.sizes[first : first + len(keys)] = sizes
        self.starts[first : first + len(keys)] = self.used + np.cumsum(sizes) - sizes
        self.met[first : first + len(keys)] = 0
        self.used += len(ids)
        self.places.update(zip(keys, range(first, first + len(keys))))

    def _learn(self, words: pa.Array) -> None:
        """Words that follow a space, or a cut. The latter and those that begin with white space are
        encoded by themselves; the others form texts, cut again by the lengths of their tokens."""
        alone = pc.match_substring_regex(words, f"^(?:{_CUT}|{_SPACE}|$)")
        line = pc.match_substring_regex(words, f"^{_CUT}\n[A-Za-z]")
        if few := words.filter(pc.and_not(alone, line)).to_pylist():
            found = self.direct([w[1:] if w.startswith(_CUT) else " " + w for w in few])
            self._remember(few, np.concatenate(found), np.array([len(f) for f in found]))
        for some, lead, skip in ((words.filter(line), "", 1), (words.filter(pc.invert(alone)), " ", 0)):
            for at in range(0, len(some), LEARNED_AT_ONCE):
                names = some.slice(at, LEARNED_AT_ONCE).to_pylist()
                ids = self.direct(["".join([lead + w[skip:] for w in names])])[0]
                ends = np.cumsum(pc.binary_length(some.slice(at, LEARNED_AT_ONCE)).to_numpy() + (len(lead) - skip))
                cuts = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends, "right")
                self._remember(names, ids, np.diff(cuts, prepend=0))

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without runs of white space, and how many each text has."""
        texts = pc.replace_substring(texts, "\n", f" {_CUT}\n")
        texts = pc.replace_substring_regex(texts, _SIGN, rf"\1 {_CUT}\2")
        parts = pc.split_pattern(texts, " ")
        edges = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.values.slice(edges[0], edges[-1] - edges[0]).dictionary_encode()
        edges = edges - edges[0]
        words = coded.dictionary.to_pylist()
        if len(self.places) + len(words) > self.remembered:
            self._drop_rare()
        place = np.fromiter(map(self.places.get, words, repeat(-1)), np.int32, len(words))
        if (missing := np.nonzero(place < 0)[0]).size:
            self._learn(coded.dictionary.take(pa.array(missing)))
            place[missing] = np.fromiter(map(self.places.__getitem__, (words[i] for i in missing.tolist())), np.int32, len(missing))
        self.met[place] += 1
        place = place[coded.indices.to_numpy()]
        start, size = self.starts[place], self.sizes[place]
        # The first word of a text follows no space.
        heads = coded.dictionary.take(coded.indices.take(pa.array(edges[:-1]))).to_pylist()
        head_ids = self.direct(heads)
        flat = np.concatenate([self.flat[: self.used], *head_ids])
        size[edges[:-1]] = [len(h) for h in head_ids]
        start[edges[:-1]] = self.used + np.cumsum(size[edges[:-1]]) - size[edges[:-1]]
        upto = np.concatenate([[0], np.cumsum(size)])
        return flat[spread(start, size)], upto[edges[1:]] - upto[edges[:-1]]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each whole text, as uint32; none for a null or empty text."""
        texts = pc.fill_null(texts, "")
        at, lengths = 0, np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        while at < len(texts):
            before = int(lengths[at - 1]) if at else 0
            upto = max(at + 1, int(np.searchsorted(lengths, before + AT_ONCE, "right")))
            some = texts.slice(at, upto - at)
            at = upto
            plain = pc.invert(pc.match_substring_regex(some, self.whole))
            mask = plain.to_numpy(zero_copy_only=False)
            runs = iter(self.direct(some.filter(pc.invert(plain)).to_pylist()))
            ids, counts = self._cut(some.filter(plain)) if mask.any() else (np.empty(0, np.uint32), [])
            cut = iter(np.split(ids, np.cumsum(counts)[:-1]) if mask.any() else [])
            for is_plain in mask:
                yield next(cut) if is_plain else next(runs)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per process and vocabulary."""
    return Encoder(path)


def lengths(docs: DataFrame, vocabulary: str, end: bool = True) -> DataFrame:
    """(doc_id, n_tokens) of every row; null and empty texts have the end id alone."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary)
        for batch in batches:
            n = [len(ids) + end for ids in known.encode(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(count, "doc_id long, n_tokens long")
