"""Commit records: which batches of a table are complete.

Each batch writes its files under a folder of its own and is then named by
one small file ``_commits/<batch>``, which is written under another name and
renamed.  Readers list the records, never the data folders, so a batch that
was left half written, or is being written again, is not seen.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from leadflow.sources.files import _hadoop_fs


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, f"{path.rstrip('/')}/_commits"

    def batches(self) -> list[int]:
        """Ids of the committed batches, ascending (a listing of file names)."""
        fs, root = _hadoop_fs(self.spark, self.folder)
        if not fs.exists(root):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(root)]
        return sorted(int(n) for n in names if n.isdigit())

    def has(self, batch: int) -> bool:
        fs, path = _hadoop_fs(self.spark, f"{self.folder}/{batch}")
        return bool(fs.exists(path))

    def record(self, batch: int) -> dict:
        fs, path = _hadoop_fs(self.spark, f"{self.folder}/{batch}")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def add(self, batch: int, record: dict) -> None:
        """Commit a batch; one that is committed already stays as it is."""
        if self.has(batch):
            return
        fs, new = _hadoop_fs(self.spark, f"{self.folder}/_{batch}")
        stream = fs.create(new, True)
        try:
            stream.write(bytearray(json.dumps(record).encode()))
        finally:
            stream.close()
        _, path = _hadoop_fs(self.spark, f"{self.folder}/{batch}")
        if not fs.rename(new, path) and not self.has(batch):
            raise OSError(f"cannot commit batch {batch} in {self.folder}")
