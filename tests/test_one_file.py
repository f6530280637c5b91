"""One CSV file put together from ordered parts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from leadflow import rules as R
from leadflow.plans import one_file
from leadflow.plans.one_file import ordered_parts, pieces, write_one_csv
from leadflow.sources.files import _hadoop_fs


@pytest.fixture
def many_parts(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def rows(spark, n):
    text = F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 5 == 1, F.lit("")).when(
        F.col("id") % 5 == 2, F.concat(F.lit('a "b",\nzwei'), F.col("id"))).otherwise(
        F.concat(F.lit("Zoë, Łódź "), F.col("id")))
    return spark.range(0, n, 1, 6).select(
        F.concat(F.lit("t"), F.lpad(((F.col("id") * 7919) % 100003).cast("string"), 6, "0")).alias("key"),
        (F.col("id") % 3).cast("string").alias("funded"), text.alias("a name, with a comma"))


def order():
    return [F.col("funded").desc(), F.col("key").asc()]


def by_one_task(df, folder):
    (df.repartition(1).sortWithinPartitions(*order()).write.option("header", True).option("encoding", "UTF-8")
     .option("nullValue", "").csv(folder))
    name = next(f for f in os.listdir(folder) if f.startswith("part-"))
    with open(os.path.join(folder, name), "rb") as f:
        return f.read()


@pytest.mark.parametrize("piece", [1 << 27, 1000])
def test_same_bytes_as_one_task_writes(spark, tmpdir_path, many_parts, piece):
    df = rows(spark, 3000)
    path = write_one_csv(df, f"{tmpdir_path}/new", order(), piece_bytes=piece)
    assert len([f for f in os.listdir(f"{tmpdir_path}/new/parts") if f.startswith("part-")]) > 3
    with open(one_file.local_path(path.toString()), "rb") as f:
        assert f.read() == by_one_task(df, f"{tmpdir_path}/old")


def test_no_rows_and_a_folder_with_odd_characters(spark, tmpdir_path):
    path = write_one_csv(rows(spark, 0), f"{tmpdir_path}/a folder", order())
    with open(os.path.join(tmpdir_path, "a folder", "whole.csv"), "rb") as f:
        assert f.read() == b'key,funded,"a name, with a comma"\n'
    assert path.getName() == "whole.csv"


def test_pieces_cover_every_byte_once():
    todo = pieces([("a", 10), ("b", 4), ("c", 3)], 4)
    assert todo == [("a", 0, 0, 4), ("a", 4, 4, 4), ("a", 8, 8, 2), ("b", 0, 10, 4), ("c", 0, 14, 3)]
    assert pieces([], 4) == []


def test_parts_by_number_not_by_name(spark, tmpdir_path):
    names = ["part-100000-x-c000.csv", "part-99999-x-c000.csv", "part-99999-x-c001.csv", "part-00003-x-c000.csv",
             "_SUCCESS", "part-00004-x-c000.csv"]
    for n in names:
        with open(os.path.join(tmpdir_path, n), "w") as f:
            f.write("" if "00004" in n else "x")
    fs, root = _hadoop_fs(spark, tmpdir_path)
    found = [os.path.basename(p) for p, _ in ordered_parts(fs, root)]
    assert found == ["part-00003-x-c000.csv", "part-99999-x-c000.csv", "part-99999-x-c001.csv",
                     "part-100000-x-c000.csv"]


def test_a_task_that_runs_again_changes_nothing(spark, tmpdir_path):
    import pyarrow as pa
    src, dst = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "dst")
    with open(src, "wb") as f:
        f.write(bytes(range(200)))
    with open(dst, "wb") as f:
        f.truncate(300)
    batch = pa.RecordBatch.from_pylist([{"path": src, "start": 50, "place": 120, "length": 100}])
    for _ in range(2):
        assert [b.to_pylist() for b in one_file._copy_to(dst)([batch])] == [[{"copied": 100}]]
    with open(dst, "rb") as f:
        assert f.read() == bytes(120) + bytes(range(50, 150)) + bytes(80)
    batch = pa.RecordBatch.from_pylist([{"path": src, "start": 150, "place": 0, "length": 100}])
    with pytest.raises(OSError):
        list(one_file._copy_to(dst)([batch]))


def test_concat_and_the_way_without_it(spark, tmpdir_path, many_parts, monkeypatch):
    """A filesystem that concatenates is asked for it with the parts in
    order; one that can do neither gets its file from one task."""
    asked = []

    class Fs:
        def concat(self, first, rest):
            asked.append((first.getName(), [p.getName() for p in rest]))

    assert one_file._concatenated(spark, Fs(), [("/f/a", 1), ("/f/b", 2), ("/f/c", 3)]) == "/f/a"
    assert one_file._concatenated(spark, Fs(), [("/f/a", 1)]) == "/f/a"
    assert asked == [("a", ["b", "c"])]
    monkeypatch.setattr(one_file, "can_assemble", lambda *a: None)
    df = rows(spark, 500)
    path = write_one_csv(df, f"{tmpdir_path}/new", order())
    with open(one_file.local_path(path.toString()), "rb") as f:
        assert f.read() == by_one_task(df, f"{tmpdir_path}/old")


def test_feed_as_one_file_replaces_the_old_one(spark, tmpdir_path, many_parts):
    from leadflow.plans.sinks import write_partner_feed
    feed = rows(spark, 400).select(
        *[(F.col("key") if c == "CK_TRACKING_ID" else F.col("funded") if c == "IS_FUNDED" else F.lit(None).cast("string"))
          .alias(c) for c in R.FEED_COLUMNS])
    for df in (feed.limit(5), feed):
        path = write_partner_feed(df, tmpdir_path, dt.date(2020, 1, 3), single_file=True)
    back = spark.read.option("header", True).csv(path)
    assert os.path.isfile(path) and back.count() == 400
    assert sorted(f for f in os.listdir(tmpdir_path) if not f.startswith(".")) == ["feed_01032020.csv"]
    got = [(r.IS_FUNDED, r.CK_TRACKING_ID) for r in back.collect()]
    assert got == sorted(got, key=lambda r: (-int(r[0]), r[1]))
