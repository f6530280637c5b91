"""The best lead per person (E1/E2), kept up to date batch by batch.

The table holds one row per person in buckets of the person key.  A batch
reduces its own leads to one per person first, reads the buckets that these
persons fall into, and writes only those anew under its own folder; its
commit record names the folder of every bucket, so a reader opens exactly the
files of one state, and a batch that failed half way is not seen and is
written again.  History is never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow import rules as R
from leadflow.operators import best_per_key, stage
from leadflow.operators.stage import drop_scope
from leadflow.plans.leads import Guesses, lead_order, typed_leads
from leadflow.sources.files import ORDER_COL, _hadoop_fs
from leadflow.streaming.commits import CommitLog

BATCH = "_batch"


class BestLeads:
    """``buckets``: fixed for the life of the table; a bucket is the least
    that a batch reads and writes, so choose it for buckets of a few hundred
    MB.  A missing person key is one person, as in the derivation over all
    leads.  Batch ids must ascend, and ties between batches go to the earlier
    one where the input's order settles them."""

    def __init__(self, spark: SparkSession, path: str, rules: R.FunnelRules, buckets: int = 64,
                 guesses: Guesses | None = None):
        self.spark, self.path, self.rules, self.buckets = spark, path.rstrip("/"), rules, buckets
        self.guesses = guesses
        self.log = CommitLog(spark, path)

    def _best(self, leads: DataFrame) -> DataFrame:
        return best_per_key(leads, ["ssn"], lead_order(self.rules, leads.columns, BATCH))

    def update(self, raw: DataFrame, batch: int) -> None:
        """Take in the lead rows of one batch.  A batch that is committed is
        left as it is; one that was not is written from the start."""
        done = self.log.batches()
        if batch in done:
            return
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after batch {done[-1]}")
        last = self.log.record(done[-1]) if done else {"places": {}, "schema": None, "buckets": self.buckets}
        if last["buckets"] != self.buckets:
            raise ValueError(f"the table has {last['buckets']} buckets")
        scope = uuid.uuid4().hex[:12]
        leads = typed_leads(raw, self.rules, self.guesses).withColumn(BATCH, F.lit(batch).cast("long"))
        new = stage(self._best(leads).withColumn("bucket", F.pmod(F.xxhash64("ssn"), F.lit(self.buckets)).cast("int")),
                    "batch_best", scope)
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())     # at most ``buckets``
        before = {str(b): last["places"][str(b)] for b in touched if str(b) in last["places"]}
        rows = new
        if before:
            rows = self._best(self._read(before, last["schema"]).unionByName(new, allowMissingColumns=True))
        if touched:
            (rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket")
             .parquet(f"{self.path}/batch={batch}"))
        places = {**last["places"], **{str(b): batch for b in touched}}
        self.log.add(batch, {"buckets": self.buckets, "places": places, "touched": touched, "before": before,
                             "schema": rows.drop("bucket").schema.json(), "old_schema": last["schema"]})
        drop_scope(self.spark, scope)

    def _read(self, places: dict[str, int], schema: str) -> DataFrame:
        import json

        from pyspark.sql import types as T
        known = T.StructType.fromJson(json.loads(schema)).add("batch", T.LongType()).add("bucket", T.IntegerType())
        if not places:
            return self.spark.createDataFrame([], known).drop("batch")
        paths = [f"{self.path}/batch={b}/bucket={k}" for k, b in places.items()]
        return self.spark.read.schema(known).option("basePath", self.path).parquet(*paths).drop("batch")

    def _state(self) -> DataFrame:
        done = self.log.batches()
        if not done:
            raise ValueError(f"no batch of {self.path} is committed")
        last = self.log.record(done[-1])
        return self._read(last["places"], last["schema"]).drop("bucket")

    def read(self) -> DataFrame:
        """The best lead per person over all committed batches."""
        return self._state().drop(ORDER_COL, BATCH)

    def changes(self, batch: int) -> tuple[DataFrame, DataFrame]:
        """(before, after): the best leads that a committed batch replaced,
        and those it brought (of new persons too)."""
        rec = self.log.record(batch)
        after = self._read({str(b): batch for b in rec["touched"]}, rec["schema"]).filter(F.col(BATCH) == batch)
        keys = after.select(F.col("ssn").alias("_ssn"))
        old = self._read(rec["before"], rec["old_schema"] or rec["schema"])
        before = old.join(keys, old["ssn"].eqNullSafe(keys["_ssn"]), "left_semi")
        return before.drop("bucket", ORDER_COL, BATCH), after.drop("bucket", ORDER_COL, BATCH)

    def drop_old(self) -> int:
        """Delete bucket files that the newest state does not use, once no
        reader holds an older one; ``changes`` of earlier batches end with
        them.  Gives the number of folders deleted."""
        done = self.log.batches()
        used = {(str(b), k) for k, b in self.log.record(done[-1])["places"].items()} if done else set()
        n = 0
        for batch in done:
            fs, root = _hadoop_fs(self.spark, f"{self.path}/batch={batch}")
            for st in fs.listStatus(root) if fs.exists(root) else []:
                name = st.getPath().getName()
                if name.startswith("bucket=") and (str(batch), name.split("=")[1]) not in used:
                    n += bool(fs.delete(st.getPath(), True))
        return n
