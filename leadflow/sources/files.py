"""Drop-folder and delimited-file sources (A1-A4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadflow.operators.ordering import input_order

EXTRA_COL = "_extra"


def normalise_name(name: str) -> str:
    """A4: strip, lower case, blank -> '_'."""
    return name.strip().lower().replace(" ", "_")


def normalise_headers(df: DataFrame) -> DataFrame:
    """A4 on a DataFrame: rename every column (dotted names are fine)."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column missing in one is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


RAW_COL = "_raw"


def lenient_schema(header: Sequence[str]) -> T.StructType:
    """All columns as text, one trailing column for a surplus field, and the
    raw record of any row whose number of fields is not header + 1."""
    return T.StructType([T.StructField(c, T.StringType()) for c in header]
                        + [T.StructField(EXTRA_COL, T.StringType()), T.StructField(RAW_COL, T.StringType())])


def _records(spark: SparkSession, paths, header: Sequence[str], encoding: str, multi_line: bool) -> DataFrame:
    return (spark.read.schema(lenient_schema(header))
            .option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_COL)
            .option("encoding", encoding).option("multiLine", multi_line)
            .option("escape", '"').option("enforceSchema", True)
            .option("columnPruning", False)      # or a record read in part would not show its number of fields
            .csv([paths] if isinstance(paths, str) else list(paths)))


def _over_long(n_columns: int):
    """Whether a record has more fields than columns.  The schema has one
    column more than the header, so a row with exactly one surplus field
    parses cleanly and has no raw record; any other row has one, and its
    separators outside quotes are counted."""
    unquoted = F.regexp_replace(F.col(RAW_COL), r'"(?:[^"]|"")*"', "")
    fields = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1
    return F.col(EXTRA_COL).isNotNull() | F.col(RAW_COL).isNull() | (fields > n_columns)


ORDER_COL = "_order"


def _plain_path(c):
    """A file's URI in one spelling: no doubled slashes, nothing escaped."""
    return F.url_decode(F.replace(F.regexp_replace(c, r"^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/"), F.lit("+"), F.lit("%2B")))


def file_positions(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """_path, _position: the files' places in ``paths``, inline in the plan."""
    named = []
    for i, path in enumerate(paths):
        fs, p = _hadoop_fs(spark, path)
        text = fs.makeQualified(p).toUri().toString().replace("\\", "\\\\").replace("'", "\\'")
        named.append(f"('{text}', {i})")
    return (spark.sql(f"SELECT * FROM VALUES {', '.join(named)} AS f(path, _position)")
            .select(_plain_path(F.col("path")).alias("_path"), "_position"))


def open_quote_files(spark: SparkSession, paths: Sequence[str], encoding: str = "ISO-8859-1") -> set[int]:
    """Places in ``paths`` of the files with a line that leaves a quote open
    (an odd number of quotes), so that a field may span lines.  One pass over
    the lines, in splits; what comes back is one number per such file."""
    lines = spark.read.option("encoding", encoding).text(list(paths)).select(
        _plain_path(F.col("_metadata.file_path")).alias("_path"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"))
    odd = lines.filter("quotes % 2 = 1").select("_path").distinct()
    return {r[0] for r in odd.join(F.broadcast(file_positions(spark, paths)), "_path").select("_position").collect()}


def read_lenient_csv(spark: SparkSession, paths, header: Sequence[str],
                     encoding: str = "ISO-8859-1", with_file: bool = False,
                     multi_line: bool = True, positions: DataFrame | None = None) -> DataFrame:
    """A2: Latin-1 CSV; over-long rows dropped, short rows padded with null.

    A row is over-long by its number of fields, also if the surplus ones are
    empty; ``surplus_rows`` gives those rows.  (DROPMALFORMED would drop
    short rows too and silently keeps bad rows under column pruning.)
    Quotes are doubled as in pandas output.  ``multi_line``: quoted fields
    may span lines, which makes each file one task; files without such
    fields are better read with it off, in splits.  ``positions`` (see
    ``file_positions``) adds ``_order``, the place of the row by file and line.
    """
    df = _records(spark, paths, header, encoding, multi_line)
    if positions is not None:
        # the row's place is taken on the scan, before the join
        df = df.withColumn(ORDER_COL, input_order(F.lit(0))).withColumn("_path", _plain_path(F.col("_metadata.file_path")))
        df = (df.join(F.broadcast(positions), "_path", "left")       # one row per file of this call
              .withColumn(ORDER_COL, F.col(ORDER_COL).withField("file", F.col("_position"))).drop("_path", "_position"))
    if with_file:
        df = df.withColumn("_file", F.col("_metadata.file_path")) \
               .withColumn("_mtime", F.col("_metadata.file_modification_time"))
    return df.filter(~_over_long(len(header))).drop(EXTRA_COL, RAW_COL)


def surplus_rows(spark: SparkSession, paths, encoding: str = "ISO-8859-1",
                 multi_line: bool | None = None) -> DataFrame:
    """file, reject_reason, record: the over-long rows of the files."""
    empty = spark.createDataFrame([], "file string, reject_reason string, record string")
    for header, group, lines in scans(spark, paths, encoding, multi_line):
        df = _records(spark, group, header, encoding, lines).withColumn("file", F.col("_metadata.file_path"))
        joined = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (*header, EXTRA_COL)])
        empty = empty.unionByName(df.filter(_over_long(len(header))).select(
            "file", F.lit("more fields than the header").alias("reject_reason"),
            F.coalesce(F.col(RAW_COL), joined).alias("record")))
    return empty


def list_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, modification time) of the data files in a folder.

    Metadata only, through the Hadoop FileSystem, exactly as Spark's own
    file index lists a folder; no file content passes the driver.
    """
    fs, root = _hadoop_fs(spark, folder)
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith(("_", ".")):
            out.append((st.getPath().toString(), int(st.getModificationTime())))
    return out


def newest_and_oldest(files: Sequence[tuple[str, int]]) -> list[str]:
    """A1: the newest and the oldest file; the files in between are ignored.

    One file -> that file once.  Ties on the time are broken by path so the
    pick is deterministic (the reference used creation time; Hadoop exposes
    modification time).
    """
    if not files:
        return []
    ordered = sorted(files, key=lambda f: (f[1], f[0]))
    return list(dict.fromkeys([ordered[-1][0], ordered[0][0]]))


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def read_header(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> list[str]:
    """The header fields of one delimited file (its first line only)."""
    import csv
    import io
    jvm = spark.sparkContext._jvm
    fs, p = _hadoop_fs(spark, path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), encoding))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return next(csv.reader(io.StringIO(line)), []) if line else []


def by_header(spark: SparkSession, paths: Sequence[str],
              encoding: str = "ISO-8859-1") -> dict[tuple[str, ...], list[str]]:
    """The files by their header: files with the same one are one scan."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in [paths] if isinstance(paths, str) else paths:
        header = tuple(read_header(spark, p, encoding))
        if header:
            groups.setdefault(header, []).append(p)
    return groups


def scans(spark: SparkSession, paths, encoding: str = "ISO-8859-1",
          multi_line: bool | None = None) -> list[tuple[tuple[str, ...], list[str], bool]]:
    """(header, files, multi_line) of each scan that the files take: those of
    one header that can be split, and those that cannot.  ``multi_line``
    None: told apart by their quotes (``open_quote_files``)."""
    files = [paths] if isinstance(paths, str) else list(paths)
    if multi_line is None:
        odd = open_quote_files(spark, files, encoding) if files else set()
        whole = {files[i] for i in odd}
    else:
        whole = set(files) if multi_line else set()
    out = []
    for header, group in by_header(spark, files, encoding).items():
        for lines in (False, True):
            some = [p for p in group if (p in whole) == lines]
            if some:
                out.append((header, some, lines))
    return out


def read_delimited(spark: SparkSession, paths: Sequence[str], encoding: str = "ISO-8859-1",
                   multi_line: bool | None = None) -> DataFrame:
    """Files read leniently, each by its own header, joined by column name;
    files without a field over several lines are read in splits."""
    found = scans(spark, paths, encoding, multi_line)
    if not found:
        raise ValueError(f"no file with a header among {paths}")
    return union_by_name([read_lenient_csv(spark, group, header, encoding, multi_line=lines)
                          for header, group, lines in found])


def read_lead_files(spark: SparkSession, paths: Sequence[str],
                    missing_text: Sequence[str] | None = None, with_file: bool = False,
                    with_order: bool = False, multi_line: bool | None = None) -> DataFrame:
    """A2-A4 as the reference does them: each file read leniently with its
    own header, headers normalised, files concatenated by column name.

    ``missing_text``: field values read as missing (B10); the daily program's
    pandas reader treats its default NA strings so, the SAS import does not.
    ``with_file`` adds ``_source_file``; ``with_order`` adds ``_order``, the
    place of a row by file (in the order of ``paths``) and line.
    ``multi_line``: whether fields may span lines; None finds out which files
    have such fields and reads the others in splits.
    """
    at = file_positions(spark, paths) if with_order else None
    frames = [normalise_headers(read_lenient_csv(spark, group, header, with_file=with_file, multi_line=lines, positions=at))
              for header, group, lines in scans(spark, paths, multi_line=multi_line)]
    df = union_by_name(frames)
    if missing_text:
        from leadflow.functions import sentinel_to_null
        df = df.select(*[sentinel_to_null(c, missing_text, trim=False).alias(c)
                         if c not in ("_file", "_mtime", ORDER_COL) else F.col(c) for c in df.columns])
    return df.withColumnRenamed("_file", "_source_file").drop("_mtime") if with_file else df
