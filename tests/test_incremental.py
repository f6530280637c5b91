"""Best leads and summaries kept up to date by batch, and batches that break off."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from leadflow import rules as R
from leadflow.plans.reports import (corrected_summary, daily_summary,
                                    summary_changes)
from leadflow.sources.files import ORDER_COL
from leadflow.streaming import (BestLeads, CommitLog, ingest_lead_files,
                                read_history)

COLUMNS = ("irmpname", "applicant_ssn", "sub_id", "application_date", "decision_date/time", "decision_status",
           "loan_type", "applicant_address_state", "applicant_credit_score", "amt._fin.")
ORDER = f"{ORDER_COL} struct<file:int,split:bigint,row:bigint>"


def _batches(seed, n=5, rows=40):
    rng = random.Random(seed)
    out = []
    for b in range(n):
        part = []
        for i in range(rows if b != 3 else 0):                       # one batch is empty
            ssn = rng.choice([None, *map(str, range(1, 15))])
            day = f"1/{rng.randint(1, 4)}/2020 9:0{rng.randint(0, 1)}"
            part.append(("CreditPartner", ssn, f"{1000 * b + i:05d}", day, day, rng.choice(["Auto Approved", "Declined"]),
                         "P", "SC", rng.choice([None, "600", "650"]), "100.00", (i // 9, 0, i)))
        out.append(part)
    return out


def _frame(spark, rows, ordered):
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS) + ", " + ORDER)
    return df if ordered else df.drop(ORDER_COL)


def _expected(batches, daily):
    """Person -> tracking id, row by row."""
    best = {}
    for b, rows in enumerate(batches):
        for r in rows:
            score = int(r[8] or 0) if daily else -1 if r[8] is None else int(r[8])
            rank = (r[3], score, -int(r[2])) if daily else (score, -b, [-x for x in r[10]])
            if r[1] not in best or rank > best[r[1]][0]:
                best[r[1]] = (rank, r[2])
    return {k and k.zfill(9): v[1] for k, v in best.items()}


@pytest.mark.parametrize("profile", ["daily", "weekly"])
def test_equal_to_the_full_derivation_after_each_batch(spark, tmpdir_path, profile):
    daily = profile == "daily"
    rules = R.PROFILES[profile].with_partner("CreditPartner")
    batches = _batches(7)
    table = BestLeads(spark, f"{tmpdir_path}/best", rules, buckets=4)
    for b, rows in enumerate(batches):
        table.update(_frame(spark, rows, not daily), b)
        got = [(r.ssn, r.CK_TRACKING_ID) for r in table.read().collect()]
        keys = [None if k is None else str(k).zfill(9) for k, _ in got]
        assert dict(zip(keys, (v for _, v in got))) == _expected(batches[:b + 1], daily)
        assert len(set(keys)) == len(keys)
    before, after = table.changes(len(batches) - 1)
    old, new = _expected(batches[:-1], daily), _expected(batches, daily)
    changed = {k for k in new if old.get(k) != new[k]}
    assert {r.CK_TRACKING_ID for r in after.collect()} == {new[k] for k in changed}
    assert {r.CK_TRACKING_ID for r in before.collect()} == {old[k] for k in changed if k in old}
    assert table.drop_old() > 0
    assert {r.CK_TRACKING_ID for r in table.read().collect()} == set(new.values())


def test_a_batch_that_breaks_off_is_not_seen_and_is_done_again(spark, tmpdir_path, monkeypatch):
    rules = R.PROFILES["daily"].with_partner("CreditPartner")
    batches = _batches(11, n=2)
    table = BestLeads(spark, f"{tmpdir_path}/best", rules, buckets=4)
    table.update(_frame(spark, batches[0], False), 0)
    state = sorted(table.read().collect(), key=str)
    add = CommitLog.add

    def broken(self, batch, record):
        raise OSError("lost")

    monkeypatch.setattr(CommitLog, "add", broken)
    with pytest.raises(OSError):
        table.update(_frame(spark, batches[1], False), 1)
    assert os.path.isdir(f"{tmpdir_path}/best/batch=1")                 # written, not committed
    assert sorted(table.read().collect(), key=str) == state
    monkeypatch.setattr(CommitLog, "add", add)
    for _ in range(2):                                                  # the second time changes nothing
        table.update(_frame(spark, batches[1], False), 1)
        got = {r.ssn: r.CK_TRACKING_ID for r in table.read().collect()}
        assert got == _expected(batches, True)
    with pytest.raises(ValueError):
        BestLeads(spark, f"{tmpdir_path}/best", rules, buckets=5).update(_frame(spark, batches[1], False), 2)


def _drop(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("".join(",".join(r) + "\n" for r in rows))


def test_history_follows_commits(spark, tmpdir_path):
    folder, hist, ckpt = (os.path.join(tmpdir_path, x) for x in ("drop", "hist", "ckpt"))
    _drop(folder, "a.csv", [("A", "B"), ("1", "x")])
    _drop(folder, "empty.csv", [])
    ingest_lead_files(spark, folder, hist, ckpt)
    _drop(folder, "b c.csv", [("A", "B"), ("2", "y")])
    calls = []

    def fails_once(rows, batch):
        calls.append((batch, rows.count()))
        if len(calls) == 1:
            raise OSError("lost")

    with pytest.raises(Exception):
        ingest_lead_files(spark, folder, hist, ckpt, on_batch=fails_once)
    assert [r.a for r in read_history(spark, hist).collect()] == ["1"]      # readable, without the half-done batch
    got = ingest_lead_files(spark, folder, hist, ckpt, on_batch=fails_once)
    assert sorted((r.a, r.b) for r in got.collect()) == [("1", "x"), ("2", "y")]
    assert calls == [(1, 1), (1, 1)]
    assert CommitLog(spark, hist).record(1)["files"][0].endswith("b c.csv")
    with pytest.raises(ValueError):
        read_history(spark, os.path.join(tmpdir_path, "nothing"))


def test_corrected_summary_equals_the_recomputed_one(spark):
    """Rows of persons come, move to another date and go; amounts are missing or not."""
    rng = random.Random(3)
    schema = ("person int, LEADDATE timestamp_ntz, IS_PREQUAL int, IS_APPL int, IS_APPROVE int, IS_FUNDED int, "
              "AMOUNT_FUNDED decimal(18,2), COST int")
    state, parts = {}, []

    def frame(rows):
        return spark.createDataFrame(rows, schema)

    for step in range(5):
        before, after = [], []
        for p in rng.sample(range(30), 15):
            if p in state:
                before.append(state.pop(p))
            if rng.random() < 0.8:
                day = None if rng.random() < 0.1 else dt.datetime(2020, 1, rng.randint(1, 6), rng.randint(0, 23))
                state[p] = (p, day, *(rng.randint(0, 1) for _ in range(4)),
                            None if rng.random() < 0.6 else Decimal(rng.randint(1, 9999)).scaleb(-2),
                            rng.choice([0, 125, 200]))
                after.append(state[p])
        parts.append(summary_changes(frame(before), frame(after)))
        changes = parts[0]
        for p in parts[1:]:
            changes = changes.unionByName(p)
        if step in (0, 2, 4):
            got, want = corrected_summary(changes), daily_summary(frame(list(state.values())))
            assert got.columns == want.columns and got.dtypes == want.dtypes
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    gone = corrected_summary(changes.unionByName(summary_changes(frame(list(state.values())), frame([]))))
    assert gone.collect() == []


def test_corrected_summary_joins_all_deliveries_at_once(spark):
    """One join with the applications a side, however many deliveries, and
    each delivery's changes as found alone."""
    from leadflow.catalog import QUERIES
    plan = QUERIES["daily_summary_corrected"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Join LeftOuter") == 2

    cols = ("LEADDATE date, IS_PREQUAL int, IS_APPL int, IS_APPROVE int, IS_FUNDED int, AMOUNT_FUNDED decimal(18,2), "
            "COST int, delivery int")
    rows = [(dt.date(2020, 1, 1 + i % 3), 1, i % 2, None if i % 4 else 1, 0, Decimal(i), i, i % 2) for i in range(12)]
    before, after = (spark.createDataFrame(x, cols) for x in (rows[:4], rows[2:]))
    together = summary_changes(before, after, by=["delivery"])
    for n in (0, 1):
        alone = summary_changes(*(x.filter(F.col("delivery") == n) for x in (before, after)))
        got = together.filter(F.col("delivery") == n).drop("delivery")
        assert got.columns == alone.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, alone.collect()))
