"""A10 re-aimed: new files of a drop folder, each read exactly once.

The reference fetched the day's attachments and then moved every file to
an archive folder.  Here Structured Streaming's file source tracks what it
has read in its checkpoint (that, not the move, gives once-only reads);
``archive_dir`` optionally lets the source move finished files away
(``cleanSource=archive``), which it does after a batch has ended, that is
after its commit record.  Each micro-batch is written to a lead history
table under a folder named by its batch id and then committed
(``commits.CommitLog``): readers see committed batches only, a batch that
broke off is written again from the start, and one that is committed is not
touched when the stream hands it out once more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from leadflow.sources.files import by_header, read_lead_files
from leadflow.streaming.commits import CommitLog

# fixed value: what the binary file source gives for a file
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def ingest_lead_files(spark: SparkSession, folder: str, history_path: str, checkpoint: str,
                      archive_dir: str | None = None, max_files_per_trigger: int = 64,
                      missing_text: Sequence[str] | None = None, with_order: bool = False,
                      on_batch: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """Run the stream until every file present now is processed
    (``availableNow``), then return the lead history table.

    The stream says which files are new, by their names alone; each
    micro-batch reads its files (``max_files_per_trigger`` at most) with the
    batch reader, every file by its own header, so stream and batch give the
    same rows.  A column that some files lack is null in theirs; files without
    a header give nothing.  ``on_batch(rows, batch id)`` is called with the
    rows of each batch before its commit, and again if the batch is repeated,
    so it must leave a batch that it has done as it is (``BestLeads.update``
    does)."""
    reader = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA) \
        .option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    arrivals = reader.load(folder).filter("length > 0").select("path")      # the content is not read
    log = CommitLog(spark, history_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if log.has(batch_id):
            return
        files = sorted(r.path for r in batch.collect())     # names of one batch's files
        if not by_header(spark, files):
            return
        place = f"{history_path}/_batch_id={batch_id}"
        (read_lead_files(spark, files, missing_text, with_file=True, with_order=with_order)
         .write.mode("overwrite").parquet(place))
        if on_batch:
            on_batch(spark.read.parquet(place), batch_id)
        log.add(batch_id, {"files": files})

    q = (arrivals.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_history(spark, history_path)


def read_history(spark: SparkSession, history_path: str) -> DataFrame:
    """The rows of all committed batches."""
    done = CommitLog(spark, history_path).batches()
    if not done:
        raise ValueError(f"no batch of {history_path} is committed")
    return (spark.read.option("mergeSchema", True).option("basePath", history_path)
            .parquet(*[f"{history_path}/_batch_id={i}" for i in done]))


def best_leads_from_history(history: DataFrame, rules) -> DataFrame:
    """Best lead per person over everything ingested so far.

    Re-derived from the whole history: a lead in a later file can replace an
    earlier best lead of the same person.  ``best.BestLeads`` keeps the same
    rows without reading history again.
    """
    from leadflow.plans.leads import best_leads, typed_leads
    return best_leads(typed_leads(history, rules), rules)
