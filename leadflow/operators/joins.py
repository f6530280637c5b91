"""Join shapes of the reference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.operators.keys import blank_key
from leadflow.operators.ordering import number_rows
from leadflow.operators.stage import stage


def semi_join(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys`` (no literal key list).

    A left-semi join: AQE broadcasts ``keys`` when its runtime size is
    small, otherwise it is a shuffled semi join; it never grows a SQL text
    with the key set and never collects it to the driver.
    """
    return df.join(keys, on, "left_semi")


def left_join_left_pred(left: DataFrame, right: DataFrame, cond: Column,
                        left_pred: Column) -> DataFrame:
    """LEFT JOIN ... ON key AND <left-only predicate>.

    Left rows failing the predicate stay, with the right side null; the
    predicate therefore belongs in the join condition, not in a WHERE.
    """
    return left.join(right, cond & left_pred, "left")


PAIRED_BYTES = 16 << 20     # distinct blank rows that every task may hold


def coalesced_key_join(left: DataFrame, right: DataFrame, left_key: str,
                       right_key: str, how: str = "left",
                       salts: int | None = None, needed: Sequence[str] | None = None,
                       scope: str | None = None) -> DataFrame:
    """Join on ``COALESCE(l,'') = COALESCE(r,'')``, trailing blanks ignored.

    Missing, empty and blank keys match each other on both sides and
    multiply; they are one hot key (most tasks carry no loan number).

    ``needed``: the columns of ``right`` that the caller uses, where only the
    distinct rows of the result matter (a DISTINCT or a pick by a total order
    follows).  The blank rows of ``right`` are then reduced to their distinct
    needed columns and, up to ``PAIRED_BYTES`` of them, kept as one row with
    an array, which each blank left row is paired with where it lies: no left
    row is shuffled for it or copied before its pairs are made.  The columns
    of ``right`` in the result are the needed ones.

    Otherwise, and beyond that size, the blank key is salted inside the join:
    a blank left row gets a salt in [0, salts) from a hash of its columns,
    other left rows salt 0; a blank right row is replicated once per salt,
    others once with salt 0 (default: as many salts as reducers).  Every pair
    the query defines is produced either way.
    """
    left_blank = blank_key(_q(left_key)) == ""
    if needed is not None:
        right = right.select(right_key, *[c for c in needed if c != right_key])
        blank = stage(right.filter(blank_key(_q(right_key)) == "").select(*[_q(c) for c in needed]).distinct(),
                      "blank_side", scope)
        one = F.struct(*[_q(c) for c in needed])
        size = blank.agg(F.sum(F.length(F.to_json(one)) + 16)).first()[0] or 0
        if size <= PAIRED_BYTES:
            return _factorised(left, right, left_key, right_key, how, needed, blank.agg(
                F.collect_list(one).alias("_pairs")), left_blank)
        right = right.filter(blank_key(_q(right_key)) != "").unionByName(
            blank.withColumn(right_key, F.lit("")) if right_key not in needed else blank)
    if salts is None:
        parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        salts = max(1, parts)
    l2 = left.withColumn("_ck", blank_key(_q(left_key))).withColumn(
        "_salt", F.when(F.col("_ck") == "", F.pmod(
            F.xxhash64(*[_q(c) for c in left.columns]), F.lit(salts))).otherwise(F.lit(0).cast("bigint")))
    r2 = right.withColumn("_ck", blank_key(_q(right_key))).withColumn(
        "_salt", F.explode(F.when(F.col("_ck") == "", F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
                           .otherwise(F.array(F.lit(0).cast("bigint")))))
    out = l2.join(r2, ["_ck", "_salt"], how).drop("_ck", "_salt")
    return out if needed is None or right_key in needed else out.drop(right_key)


def _factorised(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str,
                needed: Sequence[str], pairs: DataFrame, left_blank: Column) -> DataFrame:
    """The join by key for the other rows; blank left rows, which go to
    reducers at random, take the array of ``pairs`` (one row).

    A blank left row is dealt by a key of its own, a hash of its columns and a
    trailing blank, which no right row has (``text_key`` ends without one).  A
    second, constant key column on the right would not do: the optimizer puts
    the constant into the condition and deals by the first alone."""
    found = F.struct(*[_q(c) for c in needed]).alias("_found")
    r = right.filter(blank_key(_q(right_key)) != "").select(blank_key(_q(right_key)).alias("_ck"), found)
    own = F.concat(F.xxhash64(*[_q(c) for c in left.columns]).cast("string"), F.lit(" "))
    l = left.withColumn("_ck", F.when(left_blank, own).otherwise(blank_key(_q(left_key))))
    j = l.join(r, "_ck", "left").drop("_ck").withColumn("_blank", left_blank.cast("int"))
    # one row by construction (an aggregate without keys), its bytes checked
    j = j.join(F.broadcast(pairs.withColumn("_one", F.lit(1))), F.col("_blank") == F.col("_one"), "left")
    j = j.withColumn("_found", F.explode_outer(F.when(F.col("_blank") == 1, F.col("_pairs"))
                                               .otherwise(F.array("_found"))))
    if how == "inner":
        j = j.filter(F.col("_found").isNotNull())
    elif how != "left":
        raise ValueError(f"a factorised join is left or inner, not {how}")
    return j.select(*[_q(c) for c in left.columns], *[F.col(f"_found.`{c}`").alias(c) for c in needed])


def match_merge(leads: DataFrame, apps: DataFrame, key: str, lead_order: Sequence[Column] | None = None,
                app_order: Sequence[Column] | None = None, scope: str | None = None) -> DataFrame:
    """C17: SAS ``MERGE leads(IN=a) apps; BY key; IF a``.

    Missing keys match each other.  Same-named columns other than the key
    take the apps' value where an app row is read (SAS merge semantics).

    Without orders, ``leads`` holds one row per key (it is deduplicated
    first): a left join, the missing key - a possible hot key - split out and
    its one lead, an aggregate of one row, sent to the apps where they are.
    Several leads with a missing key are an error then.

    With ``lead_order`` and ``app_order``, which should be total, both sides
    may have several rows per key: see ``positional_merge``.
    """
    if lead_order is not None or app_order is not None:
        return positional_merge(leads, apps, key, lead_order or [], app_order or [], scope)
    shared = [c for c in apps.columns if c in leads.columns and c != key]
    a = apps.select(*[_q(c).alias(f"_app_{c}") if c in shared else _q(c)
                      for c in apps.columns], F.lit(True).alias("_app_row"))
    nn = leads.filter(F.col(key).isNotNull()).join(a.filter(F.col(key).isNotNull()), key, "left")
    an = a.filter(F.col(key).isNull()).drop(key)
    columns = F.struct(*[_q(c) for c in leads.columns])
    one = leads.filter(F.col(key).isNull()).agg(F.count(F.lit(1)).alias("_n"), F.first(columns).alias("_lead"))
    one = one.select(F.when(F.col("_n") > 1, F.raise_error(F.lit(
        "several leads without a key: give match_merge the orders of both sides"))).otherwise(F.col("_n")).alias("_n"), "_lead")
    none = an.agg(F.count(F.lit(1)).alias("_apps"))
    # exactly one row each: aggregates without keys
    paired = an.join(F.broadcast(one.filter("_n = 1"))).select(*[F.col(f"_lead.`{c}`").alias(c) for c in leads.columns],
                                                              *[_q(c) for c in an.columns])
    alone = (one.join(F.broadcast(none)).filter("_n = 1 and _apps = 0")
             .select(*[F.col(f"_lead.`{c}`").alias(c) for c in leads.columns]))
    nulls = paired.unionByName(alone, allowMissingColumns=True)
    out = nn.unionByName(nulls.select(*[_q(c) for c in nn.columns]))
    if shared:
        out = out.withColumns({c: F.when(F.col("_app_row"), _q(f"_app_{c}")).otherwise(_q(c))
                               for c in shared}).drop(*[f"_app_{c}" for c in shared])
    return out.drop("_app_row")


def positional_merge(leads: DataFrame, apps: DataFrame, key: str, lead_order: Sequence[Column],
                     app_order: Sequence[Column], scope: str | None = None) -> DataFrame:
    """The match-merge of BY groups with several rows on both sides.

    Rows of a group meet by position: the first lead with the first app, and
    so on; the shorter side repeats its last row.  A group of m leads and n
    apps so has max(m, n) rows, none if m is 0.  A same-named column has the
    app's value where an app row is read, and the lead's once the apps of
    the group are used up.

    Both sides are numbered without gathering a group (``number_rows``) and
    joined on (key, number), so a group of any size is dealt over all
    reducers; the last row of each group is a pre-aggregated maximum."""
    sides = []
    for df, order, row in ((leads, lead_order, "_l"), (apps, app_order, "_r")):
        d = number_rows(df, [key], order, "_nth", scope)
        packed = d.select(_q(key).alias(f"{row}k"), F.col("_nth").alias(f"{row}n"),
                          F.struct(*[_q(c) for c in df.columns]).alias(row))
        packed = stage(packed, "positions", scope)
        last = packed.groupBy(f"{row}k").agg(F.max_by(row, f"{row}n").alias(f"{row}last")) \
            .withColumnRenamed(f"{row}k", f"{row}lk")
        sides.append((packed, last))
    (l, l_last), (r, r_last) = sides
    j = l.join(r, F.col("_lk").eqNullSafe(F.col("_rk")) & (F.col("_ln") == F.col("_rn")), "full")
    j = j.select(F.when(F.col("_ln").isNotNull(), F.col("_lk")).otherwise(F.col("_rk")).alias("_k"), "_l", "_r")
    j = (j.join(l_last, F.col("_k").eqNullSafe(F.col("_llk")))          # groups without leads go
         .join(r_last, F.col("_k").eqNullSafe(F.col("_rlk")), "left"))
    lead, app = F.coalesce("_l", "_llast"), F.coalesce("_r", "_rlast")
    shared = [c for c in apps.columns if c in leads.columns and c != key]
    out = [F.col("_k").alias(key)]
    for c in leads.columns:
        if c in shared:
            out.append(F.when(F.col("_r").isNotNull(), F.col("_r")[c]).otherwise(lead[c]).alias(c))
        elif c != key:
            out.append(lead[c].alias(c))
    return j.select(*out, *[app[c].alias(c) for c in apps.columns if c not in (*shared, key)])


def _q(name: str) -> Column:
    return F.col(f"`{name}`")
