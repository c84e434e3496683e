"""Results of micro-batches as folders that can be written again without harm.

A batch is named by (generation, number). Numbers come from a stream's checkpoint and start at
0 with a new one, so every checkpoint has a generation of its own (``generation``): batches of
a new stream neither replace nor hide those of an old one. Each batch owns one subfolder,
overwritten when the batch is replayed. Readers take batches that a commit log has recorded;
a table of its own, without a log, those whose write finished.
Merging is left to the reader's aggregate, so a batch costs its own rows, not the size of the
table. ``compact`` folds batches into bases and bases of like size into larger ones, which
keeps the folders few and rewrites a row only a logarithmic number of times.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from studytrail.streaming.commits import Batch, CommitLog


def _system(spark: SparkSession, root: str):
    """The root's file system and the path type, as the cluster is configured."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, root: str) -> list[str]:
    fs, path = _system(spark, root)
    return [s.getPath().getName() for s in fs.listStatus(path(root))] if fs.exists(path(root)) else []


def generation(spark: SparkSession, root: str, checkpoint: str) -> int:
    """The number of a checkpoint's stream among all streams that wrote under ``root``.

    The stream's id is fixed when its checkpoint is created; it is noted here with the next
    number the first time it is met, and again when it goes on after a stream of another
    checkpoint: later batches have higher numbers, whichever stream they come from."""
    row = spark.read.text(f"{checkpoint}/metadata").first()
    identity = json.loads(row[0])["id"]
    numbers = {int(number): name for number, name in (n.split("_", 1) for n in _names(spark, f"{root}/generations"))}
    last = max(numbers, default=-1)
    if numbers.get(last) == identity:
        return last
    fs, path = _system(spark, root)
    fs.create(path(f"{root}/generations/{last + 1}_{identity}"), False).close()
    return last + 1


class BatchFolder:
    """Folders ``batch-G-N`` and ``base-G-N-L``; a base of level L holds the batches up to
    (G, N) that the base before it does not hold."""

    def __init__(self, spark: SparkSession, root: str, commits: CommitLog | None = None, **options: str):
        """``options`` are those of the files written."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.commits = commits
        self.options = options

    def is_finished(self, name: str) -> bool:
        fs, path = _system(self.spark, self.root)
        return fs.exists(path(f"{self.root}/{name}/_SUCCESS"))

    def has(self, batch: Batch) -> bool:
        """Whether the batch, recorded before, still has a folder."""
        return self.is_finished(_batch(batch))

    def stored(self) -> set[Batch]:
        """Batches that have a folder, recorded or not."""
        names = [n.split("-") for n in _names(self.spark, self.root)]
        return {(int(n[1]), int(n[2])) for n in names if n[0] == "batch"}

    def batches(self) -> list[Batch]:
        """Finished batches that still have a folder."""
        return sorted(key for key, _ in self._finished("batch"))

    def bases(self) -> list[tuple[Batch, int]]:
        """Finished bases in use: (last batch, level), oldest first. A base folded into a larger
        one has the same or an earlier end and a lower level."""
        found = sorted(((key, level[0]) for key, level in self._finished("base")), key=lambda b: (b[0], b[1]))
        used: list[tuple[Batch, int]] = []
        for key, level in found:
            while used and used[-1][1] < level:
                used.pop()
            used.append((key, level))
        return used

    def _finished(self, kind: str) -> list[tuple[Batch, list[int]]]:
        out = []
        recorded = set(self.commits.batches()) if self.commits and kind == "batch" else None
        for name in _names(self.spark, self.root):
            first, *numbers = name.split("-")
            if first == kind and all(n.isdigit() for n in numbers):
                g, n, *rest = map(int, numbers)
                if (g, n) in recorded if recorded is not None else self.is_finished(name):
                    out.append(((g, n), rest))
        return out

    def name(self, batch: Batch) -> str:
        return _batch(batch)

    def write(self, df: DataFrame, batch: Batch) -> None:
        df.write.options(**self.options).mode("overwrite").parquet(f"{self.root}/{_batch(batch)}")

    def read(self, schema: str) -> DataFrame:
        """Rows of all finished batches."""
        bases = self.bases()
        start = bases[-1][0] if bases else (-1, -1)
        return self._load([_base(*b) for b in bases] + [_batch(b) for b in self.batches() if b > start], schema)

    def read_some(self, batches: Sequence[Batch], schema: str) -> DataFrame:
        return self._load([_batch(b) for b in batches], schema)

    def compact(
        self, merge: Callable[[DataFrame], DataFrame], schema: str, before: Batch | None = None, fanout: int = 4
    ) -> Batch | None:
        """Fold finished batches (below ``before``) into a base, and ``fanout`` bases of one level
        into one of the next; returns the last batch folded.

        Folders folded now stay until the next call, for readers still on them."""
        self._remove_folded()
        bases = self.bases()
        start = bases[-1][0] if bases else (-1, -1)
        batches = [b for b in self.batches() if b > start and (before is None or b < before)]
        if not batches:
            return None
        end = batches[-1]
        rows = merge(self._load([_batch(b) for b in batches], schema))
        rows.write.options(**self.options).mode("overwrite").parquet(f"{self.root}/{_base(end, 0)}")
        level = 0
        while len(same := [b for b in self.bases() if b[1] == level]) >= fanout:
            rows = merge(self._load([_base(*b) for b in same], schema))
            rows.write.options(**self.options).mode("overwrite").parquet(f"{self.root}/{_base(same[-1][0], level + 1)}")
            level += 1
        return end

    def _remove_folded(self) -> None:
        bases = self.bases()
        if not bases:
            return
        used = {_base(*b) for b in bases}
        self._remove([_batch(b) for b in self.batches() if b <= bases[-1][0]])
        self._remove([name for key, level in self._finished("base") if (name := _base(key, level[0])) not in used])

    def _load(self, names: list[str], schema: str) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{n}" for n in names])

    def _remove(self, names: list[str]) -> None:
        fs, path = _system(self.spark, self.root)
        for name in names:
            fs.delete(path(f"{self.root}/{name}"), True)


def _batch(batch: Batch) -> str:
    return f"batch-{batch[0]}-{batch[1]}"


def _base(end: Batch, level: int) -> str:
    return f"base-{end[0]}-{end[1]}-{level}"
