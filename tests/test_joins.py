"""Join shapes: coalesced-key hot bucket, left-only ON term, match-merge."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from leadflow.operators import (best_per_key, coalesced_key_join,
                                left_join_left_pred, match_merge, number_rows,
                                sticky_flag)


def test_coalesced_key_join_null_matches_empty(spark):
    left = spark.createDataFrame([(1, None), (2, ""), (3, "K"), (4, "Z")], "id int, k string")
    right = spark.createDataFrame([(10, ""), (11, None), (12, "K")], "rid int, rk string")
    got = sorted(tuple(r) for r in coalesced_key_join(left, right, "k", "rk", "left", salts=4)
                 .select("id", "rid").collect())
    # null and '' match each other: 2 x 2 -> 4 pairs; Z unmatched stays
    assert got == [(1, 10), (1, 11), (2, 10), (2, 11), (3, 12), (4, None)]


def test_left_join_left_pred_keeps_rows(spark):
    ta = spark.createDataFrame([(1, 1), (2, 2)], "t int, tmpl int")
    td = spark.createDataFrame([(1, "a"), (2, "b")], "td int, v string")
    got = sorted(tuple(r) for r in left_join_left_pred(
        ta, td, F.col("t") == F.col("td"), F.col("tmpl") == 1).select("t", "v").collect())
    assert got == [(1, "a"), (2, None)]


def test_match_merge_null_keys(spark):
    leads = spark.createDataFrame([(1, "L1"), (None, "LN")], "ssn long, lead string")
    apps = spark.createDataFrame([(1, "A1"), (1, "A2"), (None, "AN"), (None, "AM"), (7, "A7")],
                                 "ssn long, app string")
    got = sorted((r.lead, r.app) for r in match_merge(leads, apps, "ssn").collect())
    assert got == [("L1", "A1"), ("L1", "A2"), ("LN", "AM"), ("LN", "AN")]
    lonely = match_merge(leads, apps.filter("ssn is not null"), "ssn")
    assert sorted((r.lead, r.app or "") for r in lonely.collect()) == [
        ("L1", "A1"), ("L1", "A2"), ("LN", "")]
    plan = match_merge(leads, apps, "ssn")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin BuildRight, Inner" in plan   # null-key lead broadcast, apps stay put


def test_best_per_key_and_sticky(spark):
    df = spark.createDataFrame([("p", 1, 0), ("p", 2, 1), ("p", 3, 0), ("q", 1, 0)],
                               "k string, seq int, f int")
    best = best_per_key(df, ["k"], [F.col("seq").desc()])
    assert sorted((r.k, r.seq) for r in best.collect()) == [("p", 3), ("q", 1)]
    st = sticky_flag(df, ["k"], ["seq"], F.col("f") == 1, "s")
    assert sorted((r.k, r.seq, r.s) for r in st.collect()) == [
        ("p", 1, 0), ("p", 2, 1), ("p", 3, 1), ("q", 1, 0)]


def test_sticky_null_key_is_one_group(spark):
    df = spark.createDataFrame([(None, 1, 0), (None, 2, 1), (None, 3, 0), ("a", 1, 0)],
                               "k string, seq int, f int")
    st = sticky_flag(df, ["k"], ["seq"], F.col("f") == 1, "s")
    assert sorted((r.k or "", r.seq, r.s) for r in st.collect()) == [
        ("", 1, 0), ("", 2, 1), ("", 3, 1), ("a", 1, 0)]


def test_match_merge_shared_column_app_wins(spark):
    leads = spark.createDataFrame([(1, "lead", "x"), (2, "lead", "y")], "ssn long, src string, only_l string")
    apps = spark.createDataFrame([(1, None)], "ssn long, src string")
    got = sorted((r.ssn, r.src) for r in match_merge(leads, apps, "ssn").collect())
    # an app row exists for 1: its (missing) value wins; none for 2: lead value
    assert got == [(1, None), (2, "lead")]


# ---- several rows per key on both sides ------------------------------------

def record_merge(leads, apps):
    """The DATA step record by record: (key, lead, app, src) rows."""
    out = []
    for key in {k for k, *_ in leads}:
        ls, rs = ([r for r in side if r[0] == key] for side in (leads, apps))
        lead = app = src = None
        for i in range(max(len(ls), len(rs))):
            if i < len(ls):
                lead, src = ls[i][1], ls[i][2]
            if i < len(rs):
                app, src = rs[i][1], rs[i][2]
            out.append((key, lead, app, src))
    return Counter(out)


def test_positional_merge_is_the_data_step(spark):
    leads, apps = [], []
    keys = {(m, n): 10 * m + n for m in range(4) for n in range(4)} | {("null", 2): None}
    for (m, n), key in keys.items():
        for i in range(2 if m == "null" else m):
            leads.append((key, f"L{key}.{i}", f"lead {i}"))
        for i in range(n if m != "null" else 3):
            apps.append((key, f"A{key}.{i}", f"app {i}" if i != 1 else None))
    leads += [(99, f"hot {i:05}", "l") for i in range(3000)]
    apps += [(99, f"app {i:05}", "a") for i in range(2000)]
    l = spark.createDataFrame(leads, "ssn long, lead string, src string").repartition(5)
    a = spark.createDataFrame(apps, "ssn long, app string, src string").repartition(7)
    out = match_merge(l, a, "ssn", [F.col("lead")], [F.col("app")])
    assert out.columns == ["ssn", "lead", "src", "app"]
    assert Counter((r.ssn, r.lead, r.app, r.src) for r in out.collect()) == record_merge(leads, apps)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "Join Cross" not in plan and "rightHint=(strategy=broadcast)" not in plan
    none = match_merge(l.limit(0), a, "ssn", [F.col("lead")], [F.col("app")])
    assert none.count() == 0
    assert match_merge(l, a.limit(0), "ssn", [F.col("lead")], [F.col("app")]).count() == len(leads)


def test_number_rows_over_partitions(spark):
    rows = [(k, i) for k in (None, 1, 2) for i in range(700 if k == 1 else 40)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(6)
    got = number_rows(df, ["k"], [F.col("i").desc()], "nth").collect()
    for k in (None, 1, 2):
        assert [r.i for r in sorted((r for r in got if r.k == k), key=lambda r: r.nth)] == \
            sorted((i for q, i in rows if q == k), reverse=True)
        assert sorted(r.nth for r in got if r.k == k) == list(range(1, sum(q == k for q, _ in rows) + 1))


def test_match_merge_refuses_several_null_leads(spark):
    leads = spark.createDataFrame([(None, "L1"), (None, "L2")], "ssn long, lead string")
    apps = spark.createDataFrame([(None, "A")], "ssn long, app string")
    with pytest.raises(Exception, match="several leads without a key"):
        match_merge(leads, apps, "ssn").collect()


# ---- blank keys -------------------------------------------------------------

LEFT = [(1, None), (2, ""), (3, "K"), (4, "Z"), (5, "  "), (6, "K  "), (7, " K"), (8, "k")]
RIGHT = [(10, "", "x"), (11, None, "x"), (12, "K", "y"), (13, "K ", "z"), (14, " ", "w"), (15, "K", "y")]


def pairs(how):
    key = lambda k: (k or "").rstrip(" ")
    out = []
    for i, k in LEFT:
        m = [(r, v) for r, q, v in RIGHT if key(q) == key(k)]
        out += [(i, k, r, v) for r, v in m] or ([(i, k, None, None)] if how == "left" else [])
    return out


@pytest.mark.parametrize("how", ["left", "inner"])
def test_trailing_blanks_and_factorised_join(spark, how, monkeypatch):
    left = spark.createDataFrame(LEFT, "id int, k string")
    right = spark.createDataFrame(RIGHT, "rid int, rk string, v string")
    out = coalesced_key_join(left, right, "k", "rk", how).select("id", "k", "rid", "v")
    assert Counter(map(tuple, out.collect())) == Counter(pairs(how))
    want = {(i, k, v) for i, k, _, v in pairs(how)}
    small = coalesced_key_join(left, right, "k", "rk", how, needed=["v"])
    assert small.columns == ["id", "k", "v"] and set(map(tuple, small.collect())) == want
    monkeypatch.setattr("leadflow.operators.joins.PAIRED_BYTES", 0)     # the other way, beyond the size
    large = coalesced_key_join(left, right, "k", "rk", how, needed=["v"])
    assert set(map(tuple, large.select("id", "k", "v").collect())) == want


def test_many_blank_rows_on_both_sides(spark):
    """100,000 x 100,000 blank rows with few distinct loan columns."""
    left = spark.range(100_000).select("id", F.when(F.col("id") % 2 == 0, F.lit(" ")).alias("k"))
    right = spark.range(100_000).select(F.lit("").alias("rk"), (F.col("id") % 3).alias("v"))
    out = coalesced_key_join(left, right, "k", "rk", needed=["v"])
    assert out.count() == 300_000
    assert "sequence" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_blank_left_rows_are_dealt_over_all_reducers(spark):
    """The keyed part of the factorised join: no reducer gets all blank rows."""
    left = spark.range(20_000).select("id", F.when(F.col("id") % 4 == 0, F.lit("K1 "))
                                      .when(F.col("id") % 4 == 1, F.lit("")).alias("k"))
    right = spark.createDataFrame([("K1", 1), ("", 2), (None, 3), ("5 ", 4)], "rk string, v int")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        out = coalesced_key_join(left, right, "k", "rk", needed=["v"])
        got = out.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count_distinct(F.when(F.trim("k").isNull() | (F.trim("k") == ""), F.col("id"))).alias("n")).collect()
        assert out.count() == 5_000 + 2 * 15_000
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sum(r.n for r in got) == 15_000 and max(r.n for r in got) < 4_000


def test_history_is_not_shuffled_by_a_code(spark, tmpdir_path):
    """Code tables of known and of unknown size."""
    from leadflow.operators import history_pivot, status_codes
    from leadflow.sources import standins as S
    from leadflow.sources.tables import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    inline = (S.workflow_action(spark), S.workflow_result(spark), S.loan_status_codes(spark))
    unknown = tuple(spark.createDataFrame(x.rdd, x.schema) for x in inline)
    for a, r, c in (inline, unknown):
        for df in (history_pivot(S.task_routing_history(t), a, r), status_codes(S.loanacct_statuses(t), c)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan
            assert not any(f"hashpartitioning({c}" in plan for c in ("workflow", "status_code_no"))
