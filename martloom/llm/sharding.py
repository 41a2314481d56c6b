"""Shards by jump consistent hashing: a key's shard follows from the key and the shard count alone.

There is no ring table to build, send or keep. When a shard is appended, one key in (n + 1) moves,
and only into the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows that one task numbers.
SLOT_ROWS = 100_000
# Multiplier of the 64-bit generator in the published algorithm (Lamping and Veach 2014).
_STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, 0 to ``shards - 1``, of each 64-bit key."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    jump = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = jump[moving]
        state[moving] = state[moving] * _STEP + np.uint64(1)
        ratio = float(1 << 31) / ((state[moving] >> np.uint64(33)).astype(np.float64) + 1)
        jump[moving] = ((shard[moving] + 1) * ratio).astype(np.int64)
        moving = moving[jump[moving] < shards]
    return shard.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard of an integer key; a null key counts as -1, so all of them share a shard."""

    @F.pandas_udf("int")
    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64), shards))

    return of(F.coalesce(key.cast("long"), F.lit(-1).cast("long")))


def with_slots(df: DataFrame, shard: str = "shard", rows: int = SLOT_ROWS) -> DataFrame:
    """Adds ``slot``: numbers each shard's rows gapless from 0, in no special order.

    A shard is numbered in pieces of about ``rows`` rows, dealt by row number rather than by key,
    so neither a full shard nor repeated rows meet in one task; each piece then starts where the
    pieces before it end. ``df`` must give the same rows on each reading (a stored table or scan).
    """
    counts = df.groupBy(shard).count()
    most = counts.agg(F.max("count")).first()[0] or 0
    pieces = -(-most // rows) or 1
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_piece", F.pmod(F.xxhash64("_row"), F.lit(pieces))
    )
    sizes = dealt.groupBy(shard, "_piece").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(shard, "_piece").orderBy("_row")) - 1
    return (
        dealt.withColumn("_in", inside)
        .join(starts, [shard, "_piece"])
        .withColumn("slot", (F.col("_in") + F.col("_start")).cast("long"))
        .drop("_row", "_piece", "_in", "_start")
    )


def key_shards(docs: DataFrame, shards: int) -> DataFrame:
    """Per row: doc_id, size in bytes (text plus 16), crc of the text, its shard under ``shards``
    and under one shard more.

    A null text has no bytes and the crc of no bytes; repeated rows stay repeated and share a
    shard; other columns are ignored.
    """
    key, text = F.col("doc_id").cast("long"), F.coalesce(docs["text"], F.lit(""))
    return docs.select(
        key.alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(key, shards).alias("shard"),
        shard_of(key, shards + 1).alias("grown_shard"),
    )
