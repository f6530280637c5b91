"""Exact dedup against a minimal perfect hash over historical distinct digests.

History: one winner per distinct digest, kept in shards.  A shard is a
minimal perfect hash (levels of bit arrays, rank by popcount) plus, per slot,
the full 32-byte digest and the winner's locator.  Arrivals are first
reduced to one row per digest, each is sent to the shard its digest names,
and the slot's digest is compared byte for byte: equal means a repeat of
history, anything else means a new text, and new texts form groups of their
own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadflow.llm.common import WORD_SPACE, internal
from leadflow.operators.stage import stage

SHARD_KEYS = 32_768     # digests per shard, about: 40 bytes each in memory
_GAMMA = 1.7            # bits per key and level of the hash

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys + _MIX[0] * np.uint64(level + 1)
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys; level i holds a bit for
    every key that is alone at its position there, the rest go one level
    down.  A key's slot is the number of set bits before its own."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels                                  # bool arrays
        sizes = [int(x.sum()) for x in levels]
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = [np.concatenate([[0], np.cumsum(x)]).astype(np.int64) for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            m = max(64, int(_GAMMA * len(left)))
            at = _level_hash(left, len(levels)) % np.uint64(m)
            alone = np.bincount(at.astype(np.int64), minlength=m) == 1
            levels.append(alone)
            left = left[~alone[at.astype(np.int64)]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; a key that was not in the set gets any slot or -1."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for i, bits in enumerate(self.levels):
            at = (_level_hash(keys[todo], i) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[todo[hit]] = self.base[i] + self.rank[i][at[hit]]
            todo = todo[~hit]
        return out

    def to_bytes(self) -> list[tuple[int, bytes]]:
        return [(len(x), np.packbits(x).tobytes()) for x in self.levels]

    @classmethod
    def from_bytes(cls, rows) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for n, b in rows])


def _keys(digests: np.ndarray, seed: int) -> np.ndarray:
    """First and second word of each digest folded into one 64-bit key."""
    w = digests.reshape(-1, 32).view("<u8")
    return w[:, 0] ^ ((w[:, 1] + np.uint64(seed)) * _MIX[0])


def _digest_matrix(col: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(col), np.uint8).reshape(-1, 32) if len(col) else np.zeros((0, 32), np.uint8)


SHARD_SCHEMA = ("shard long, seed long, levels array<struct<size:int,bits:binary>>, "
                "digests binary, locators binary")
_LOCATOR = np.dtype([("n", "<i8"), ("id", "<i8"), ("null_id", "<i8"), ("uid", "<i8"), ("count", "<i8")])


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    digests = _digest_matrix(pdf["digest"])
    seed, keys = 0, _keys(digests, 0)
    while len(np.unique(keys)) < len(keys):      # two digests share a key: fold them anew
        seed += 1
        keys = _keys(digests, seed)
    h = PerfectHash.build(keys)
    order = np.empty(len(keys), np.int64)
    order[h.slots(keys)] = np.arange(len(keys))
    loc = np.zeros(len(keys), _LOCATOR)
    for name in _LOCATOR.names:
        loc[name] = pdf[name].to_numpy()[order]
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "seed": [seed],
                         "levels": [[{"size": n, "bits": b} for n, b in h.to_bytes()]],
                         "digests": [digests[order].tobytes()], "locators": [loc.tobytes()]})


def _probe(key, arrivals: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """One shard: the slot each arriving digest names, checked by its bytes."""
    n = len(arrivals)
    out = arrivals[["digest"]].copy()
    found, loc = np.zeros(n, bool), np.zeros(n, _LOCATOR)
    if n and len(index):
        row = index.iloc[0]
        h = PerfectHash.from_bytes([(x["size"], x["bits"]) for x in row["levels"]])
        stored = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        locators = np.frombuffer(row["locators"], _LOCATOR)
        digests = _digest_matrix(arrivals["digest"])
        slot = h.slots(_keys(digests, int(row["seed"])))
        ok = slot >= 0
        found[ok] = (stored[slot[ok]] == digests[ok]).all(axis=1)
        loc[found] = locators[slot[found]]
    out["member"] = found
    for name in _LOCATOR.names:
        out[f"h_{name}"] = loc[name]
    return out


def normalised(text):
    """Text without any ``[\\x20\\x09-\\x0D]`` character; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WORD_SPACE + "+", "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: uid (a number per row, fixed by being
    written), id, digest (sha256 of the normalised text), n (code points of
    the original text).  Written to the shared folder: the texts are read once."""
    t = F.col(text_col).cast("string")
    return stage(docs.select(F.col(id_col).cast("long").alias("id"),
                             F.unhex(F.sha2(normalised(t), 256)).alias("digest"),
                             F.coalesce(F.char_length(t), F.lit(0)).cast("long").alias("n"))
                 .withColumn("uid", F.monotonically_increasing_id()), "exact_fp")


def _groups(fp: DataFrame) -> DataFrame:
    """One row per digest: its winner (most code points, then smallest id,
    null ids last, then the earliest row) and its number of rows.  Partial
    aggregation sends one row per digest and map task, whatever its size."""
    best = F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("id").isNull().cast("long").alias("null_id"),
                          F.coalesce("id", F.lit(0)).alias("id"), F.col("uid").alias("uid")))
    return fp.groupBy("digest").agg(best.alias("w"), F.count(F.lit(1)).alias("count")).select(
        "digest", (-F.col("w.neg_n")).alias("n"), F.col("w.id").alias("id"),
        F.col("w.null_id").alias("null_id"), F.col("w.uid").alias("uid"), "count")


def _shard_of(shards: int):
    """Shard named by the digest's last eight bytes (the hash uses the first sixteen)."""
    return F.pmod(F.conv(F.hex(F.substring("digest", 26, 7)), 16, 10).cast("long"), F.lit(shards))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """Shard table of ``history`` (rows of ``fingerprints``), written to the
    shared folder.  Shards hold about ``SHARD_KEYS`` digests each when
    ``shards`` follows the number of rows; a digest is one entry however
    often it occurs, so no shard grows with a group of copies."""
    g = _groups(history).withColumn("shard", _shard_of(shards))
    return stage(g.groupBy("shard").applyInPandas(_build_shard, SHARD_SCHEMA), "exact_mph")


def lookup(index: DataFrame, arrivals: DataFrame, shards: int) -> DataFrame:
    """Per arriving digest: member (in history, checked by bytes) and the
    slot's locator.  ``arrivals``: one row per digest."""
    a = arrivals.select("digest").withColumn("shard", _shard_of(shards))
    schema = "digest binary, member boolean, " + ", ".join(f"h_{n} long" for n in _LOCATOR.names)
    return a.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_probe, schema)


def shard_count(rows: int) -> int:
    return max(1, -(-rows // SHARD_KEYS))


def exact_groups(fp: DataFrame, is_history) -> DataFrame:
    """Per row of ``fp``: uid, id, digest, n, keep_id, group_size, kept.

    Rows where ``is_history`` (a condition) holds build the index; the others
    arrive, are looked up, and either join a historical group or form groups
    among themselves.  A group's winner is the better of the historical
    winner and the best arrival.  Every row comes back."""
    flag = F.coalesce(is_history, F.lit(False))
    history, arrivals = fp.filter(flag), fp.filter(~flag)
    shards = shard_count(fp.count())
    index = build_index(history, shards)
    new = stage(_groups(arrivals), "exact_new")
    probed = stage(lookup(index, new, shards), "exact_probe")

    rank = lambda p: F.struct((-F.col(p + "n")).alias("a"), F.col(p + "null_id").alias("b"),
                              F.col(p + "id").alias("c"), F.col(p + "uid").alias("d"))
    merged = new.join(probed, "digest").select(
        "digest", F.when(F.col("member"), F.least(rank("h_"), rank(""))).otherwise(rank("")).alias("w"),
        (F.col("count") + F.when(F.col("member"), F.col("h_count")).otherwise(0)).alias("group_size"),
        "member")
    # historical digests without arrivals keep their historical winner
    quiet = (_groups(history).join(probed.filter("member").select("digest"), "digest", "left_anti")
             .select("digest", rank("").alias("w"), F.col("count").alias("group_size"), F.lit(True).alias("member")))
    groups = merged.unionByName(quiet)
    return fp.join(groups, "digest").select(
        "uid", "id", "digest", fp["n"], F.when(F.col("w.b") == 0, F.col("w.c")).alias("keep_id"), "group_size",
        (F.col("uid") == F.col("w.d")).alias("kept"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Texts are equal when identical without ``[\\x20\\x09-\\x0D]``; null counts
    as empty, so null and blank texts form one group.  Of equal texts the row
    with most code points stays, then the smallest id (null ids last), then,
    for wholly repeated rows, exactly one of them.  The documents up to the
    middle of the id range act as history, the later ones (and null ids)
    arrive.  Only the id and text columns are read, so other columns may have
    any name.  Empty input gives an empty result."""
    fp = fingerprints(docs, id_col, text_col)
    return exact_groups(fp, _history_is_first_half(fp)).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


def _history_is_first_half(fp: DataFrame):
    lo, hi = fp.agg(F.min("id"), F.max("id")).first()
    return F.lit(False) if lo is None else F.col("id") <= (lo + hi) // 2


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without its repeats, all columns as they are (a column of
    any name is carried through).  Same rules as ``exact_dedup``.  The texts
    are shuffled once: wholly repeated rows are cut to one per key before and
    after that exchange, and the winners join on the same key."""
    cols = docs.columns
    key = [internal(f"_{n}", cols) for n in ("id", "digest", "n")]
    nth = internal("_nth", cols)
    fp = fingerprints(docs, id_col, text_col)
    winners = exact_groups(fp, _history_is_first_half(fp)).filter("kept").select(
        *[F.col(c).alias(f"{k}_w") for c, k in zip(("id", "digest", "n"), key)])
    t = F.col(text_col).cast("string")
    marked = (docs.withColumn(key[0], F.col(id_col).cast("long"))
              .withColumn(key[1], F.unhex(F.sha2(normalised(t), 256)))
              .withColumn(key[2], F.coalesce(F.char_length(t), F.lit(0)).cast("long"))
              .withColumn(nth, F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0))))
              .filter(F.col(nth) == 1))
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_w"))
    return marked.join(winners, same, "left_semi").select(*[F.col(f"`{c}`") for c in cols])
