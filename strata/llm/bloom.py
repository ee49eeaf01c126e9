"""A Bloom filter of 64-bit hashes, made in tasks and small enough to broadcast.

It keeps rows that surely have no partner from being shuffled to a join; a row it
lets pass by chance is dropped by the join itself, so results never depend on it.
Its size follows the number of hashes up to ``BITS``; beyond that it lets more pass.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.session import measured, ship_code

BITS = 27  # 2**27 flags are 16 MB
PIECE = 16


class Bloom:
    def __init__(self, bits: int, flags: np.ndarray):
        self.bits, self.flags = bits, flags

    def passes(self, h: np.ndarray) -> np.ndarray:
        """Which hashes (uint64) may be in the filter."""
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        return ((self.flags[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1).astype(bool)


def _piece(group: pd.DataFrame) -> pd.DataFrame:
    flags = np.zeros(1 << PIECE, dtype=bool)
    flags[group["slot"].to_numpy() & ((1 << PIECE) - 1)] = True
    return pd.DataFrame({"piece": group["piece"].iloc[:1].to_numpy(), "raw": [np.packbits(flags).tobytes()]})


def bloom(hashes: DataFrame) -> Bloom:
    """The filter of a table with one column ``h`` (long), about sixteen flags for each of its rows."""
    bits = max(PIECE, min(BITS, int(hashes.count() * 16).bit_length()))
    slots = hashes.select(F.shiftrightunsigned("h", 64 - bits).alias("slot")).distinct().withColumn("piece", F.shiftright("slot", PIECE))
    flags = np.zeros((1 << bits) // 8, dtype=np.uint8)
    size = (1 << PIECE) // 8
    for r in slots.groupBy("piece").applyInPandas(_piece, "piece long, raw binary").collect():  # at most 2**(BITS - 3) bytes
        flags[r["piece"] * size : (r["piece"] + 1) * size] = np.frombuffer(r["raw"], dtype=np.uint8)
    return Bloom(bits, flags)


MAYBE = "_strata_maybe"
KEY_ROWS = 500_000  # about 12 MB as a hash table of longs


def split(left: DataFrame, h: Column, hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ``left`` that may have a partner, rows that surely have none), by their hash ``h`` and the partners' (column h)."""
    ship_code(left.sparkSession)
    shared = left.sparkSession.sparkContext.broadcast(bloom(hashes))

    def passes(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.passes(x.to_numpy(dtype=np.int64).view(np.uint64)))

    marked = left.withColumn(MAYBE, F.pandas_udf(passes, "boolean")(h))
    return marked.where(MAYBE).drop(MAYBE), marked.where(~F.col(MAYBE)).drop(MAYBE)


def joined(left: DataFrame, right: DataFrame, on, how: str, left_hash: Column, right_hash: Column, more: Column | None = None) -> DataFrame:
    """``left.join(right, on, how)`` (inner, left or left_anti) for a right side that few rows of a large left side meet.

    The right side is written down and measured (``more``: bytes beside a row's). While it is small it is
    broadcast. Beyond that its hashes alone are, as a table of at most ``KEY_ROWS`` or as a Bloom filter, and only the rows
    of ``left`` that pass are shuffled; the
    others go on as they are. Both sides of that join are dealt for it, so AQE can split a hot key.
    """
    kept, small = measured(right, more)
    if small:
        return left.join(F.broadcast(kept), on, how)
    hashes = kept.select(right_hash.alias("h"))
    if hashes.count() <= KEY_ROWS:
        keys = F.broadcast(hashes.select(F.col("h").alias(MAYBE)).distinct())
        maybe, rest = (left.join(keys, left_hash == F.col(MAYBE), kind) for kind in ("left_semi", "left_anti"))
    else:
        maybe, rest = split(left, left_hash, hashes)
    out = maybe.join(kept, on, how)
    if how == "inner":
        return out
    if how == "left":
        rest = rest.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in kept.schema])
    return out.unionByName(rest)
