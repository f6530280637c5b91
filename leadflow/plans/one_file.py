"""One file of ordered parts, without one task that writes it all.

The parts are written by as many tasks as the sort has partitions.  Their
sizes are known from the listing, so the place of each in the whole is too.
A filesystem that can concatenate moves their blocks; in a shared folder
(``file:``) tasks copy the parts, in pieces, each to its place.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.sources.files import _hadoop_fs

PIECE_BYTES = 128 << 20      # bytes that one task copies
_BUFFER = 1 << 20
_PART = re.compile(r"part-(\d+)-.*-c(\d+)")


def ordered_parts(fs, folder) -> list[tuple[str, int]]:
    """(path, size) of the part files of ``folder`` in the order of their
    rows, by task and file number; empty parts are left out."""
    found = []
    for st in fs.listStatus(folder):
        m = _PART.match(st.getPath().getName())
        if m and st.getLen():
            found.append((int(m[1]), int(m[2]), st.getPath().toString(), int(st.getLen())))
    return [(path, size) for _, _, path, size in sorted(found)]


def pieces(parts: Sequence[tuple[str, int]], piece_bytes: int = PIECE_BYTES) -> list[tuple[str, int, int, int]]:
    """(path, start in the part, place in the whole, length) of every piece."""
    out, place = [], 0
    for path, size in parts:
        for at in range(0, size, piece_bytes):
            out.append((path, at, place + at, min(piece_bytes, size - at)))
        place += size
    return out


def local_path(uri: str) -> str:
    return unquote(urlparse(uri).path) if uri.startswith("file:") else uri


def _copy_to(target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                left = row["length"]
                with open(local_path(row["path"]), "rb") as src, open(target, "r+b") as dst:
                    src.seek(row["start"])
                    dst.seek(row["place"])
                    while left:
                        data = src.read(min(_BUFFER, left))
                        if not data:
                            raise OSError(f"{row['path']} is shorter than it was listed")
                        dst.write(data)
                        left -= len(data)
                    dst.flush()
                    os.fsync(dst.fileno())
                yield pa.RecordBatch.from_pydict({"copied": pa.array([row["length"]], pa.int64())})
    return run


def _copied(spark: SparkSession, parts: Sequence[tuple[str, int]], target: str, piece_bytes: int) -> None:
    """Every piece copied to its place in ``target`` by a task of its own; a
    task that runs twice writes the same bytes to the same place."""
    total = sum(size for _, size in parts)
    with open(target, "wb") as f:
        f.truncate(total)
    todo = pieces(parts, piece_bytes)
    rows = spark.sparkContext.parallelize(todo, max(1, len(todo))).toDF(
        "path string, start long, place long, length long") if todo else None
    done = rows.mapInArrow(_copy_to(target), "copied long").agg(F.sum("copied")).first()[0] if todo else 0
    if done != total:
        raise OSError(f"{done} of {total} bytes were copied to {target}")


def _concatenated(spark: SparkSession, fs, parts: Sequence[tuple[str, int]]) -> str:
    """The first part with the others appended by the filesystem."""
    gateway, path = spark.sparkContext._gateway, spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    rest = gateway.new_array(path, len(parts) - 1)
    for i, (p, _) in enumerate(parts[1:]):
        rest[i] = path(p)
    if len(parts) > 1:
        fs.concat(path(parts[0][0]), rest)
    return parts[0][0]


def can_assemble(spark: SparkSession, folder: str) -> str | None:
    """'copy' for a shared folder, 'concat' where the filesystem does it,
    None elsewhere (object stores)."""
    fs, p = _hadoop_fs(spark, folder)
    if fs.getScheme() == "file":
        return "copy"
    return "concat" if fs.hasPathCapability(p, "fs.capability.paths.concat") else None


def write_one_csv(rows: DataFrame, staging: str, order: Sequence, piece_bytes: int = PIECE_BYTES):
    """``rows`` as one headed CSV file inside the folder ``staging``; returns
    its Hadoop path.  The file is complete when this returns.

    Nulls are empty fields; no rows give a file of the header alone.  Rows
    equal in ``order`` follow each other in any order.  Where the filesystem
    can neither concatenate nor be written at a place, one task writes it."""
    spark = rows.sparkSession
    fs, root = _hadoop_fs(spark, staging)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    write = lambda df, to, head: (df.write.mode("overwrite").option("header", head)
                                  .option("encoding", "UTF-8").option("nullValue", "").csv(to))
    how = can_assemble(spark, staging)
    if how is None:
        write(rows.repartition(1).sortWithinPartitions(*order), f"{staging}/parts", True)
        return path(ordered_parts(fs, path(f"{staging}/parts"))[0][0])
    write(rows.orderBy(*order), f"{staging}/parts", False)
    write(spark.range(1).select(*[F.lit(c).alias(c) for c in rows.columns]).coalesce(1), f"{staging}/head", False)
    parts = [p for sub in ("head", "parts") for p in ordered_parts(fs, path(f"{staging}/{sub}"))]
    if how == "concat":
        return path(_concatenated(spark, fs, parts))
    whole = path(root, "whole.csv")
    _copied(spark, parts, local_path(fs.makeQualified(whole).toUri().toString()), piece_bytes)
    return whole
