"""Commit records: which batches count.

A batch of a job may write several folders. It counts from the moment its record exists: one
small file per batch, created after all folders and only if it is not there yet, which names
them. Readers take the folders of recorded batches. Folders without a record belong to a batch
that died; whoever applies its records next writes them anew under a batch of its own.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession

Batch = tuple[int, int]


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root.rstrip('/')}/commits"

    def _system(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _file(self, batch: Batch) -> str:
        return f"{self.root}/commit-{batch[0]}-{batch[1]}"

    def has(self, batch: Batch) -> bool:
        fs, path = self._system()
        return fs.exists(path(self._file(batch)))

    def add(self, batch: Batch, content: Mapping) -> None:
        """Record the batch. A record that exists already is an error."""
        fs, path = self._system()
        out = fs.create(path(self._file(batch)), False)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()

    def content(self, batch: Batch) -> dict:
        """What the record names; empty where its writer died while it wrote."""
        text = self.spark.read.text(self._file(batch), wholetext=True).first()
        return json.loads(text[0]) if text and text[0] else {}

    def batches(self) -> list[Batch]:
        """All recorded batches in order, by one listing."""
        fs, path = self._system()
        if not fs.exists(path(self.root)):
            return []
        names = [s.getPath().getName().split("-") for s in fs.listStatus(path(self.root))]
        return sorted((int(n[1]), int(n[2])) for n in names if n[0] == "commit")

    def last_of_each(self) -> list[Batch]:
        """The last recorded batch of every generation."""
        return sorted({g: (g, n) for g, n in self.batches()}.values())

    def forget(self, batches: Iterable[Batch]) -> None:
        """Remove records of batches that bases hold; the last of a generation stays."""
        fs, path = self._system()
        keep = set(self.last_of_each())
        for batch in batches:
            if batch not in keep:
                fs.delete(path(self._file(batch)), False)
