"""Sharding by histogram sort: equal bytes in each shard, found by counting below candidate boundaries.

Rows are ordered by a 128-bit key: a hash of the text, so that equal texts lie side by side, and one of the id.
Candidate boundaries, the probes, are counted exactly: the bytes below each, summed over all partitions.
Between the two probes around a wanted position new ones are set, until every splitter is within tolerance or no
row is left between its probes. Then the rows are exchanged once, by shard and part of a shard.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratakit.llm.common import stored

PROBES, TOLERANCE = 15, 0.001
PART_ROWS = 20_000
LOWEST, HIGHEST = (-(1 << 63), -(1 << 63)), ((1 << 63) - 1, (1 << 63) - 1)


def _as_number(key: tuple[int, int]) -> int:
    return ((key[0] + (1 << 63)) << 64) + key[1] + (1 << 63)


def _as_key(number: int) -> tuple[int, int]:
    return (number >> 64) - (1 << 63), (number & ((1 << 64) - 1)) - (1 << 63)


def slots_of(high: np.ndarray, low: np.ndarray, probes: list[tuple[int, int]]) -> np.ndarray:
    """For each key how many of the sorted probes are at or below it."""
    tops = np.array([p[0] for p in probes], np.int64)
    begin, end = np.searchsorted(tops, high, "left"), np.searchsorted(tops, high, "right")
    slots = begin.copy()
    for i in np.flatnonzero(begin < end):
        slots[i] = bisect.bisect_right(probes, (high[i], low[i]), begin[i], end[i])
    return slots


def _counted(rows: DataFrame, probes: list[tuple[int, int]]) -> np.ndarray:
    """Exact bytes and rows of the intervals between probes; sums of partitions meet, one row per interval."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(probes) + 1, 2), np.int64)
        for batch in batches:
            at = slots_of(batch["high"].to_numpy(), batch["low"].to_numpy(), probes)
            np.add.at(sums[:, 0], at, batch["bytes"].to_numpy())
            np.add.at(sums[:, 1], at, 1)
        used = np.flatnonzero(sums[:, 1])
        yield pd.DataFrame({"slot": used, "bytes": sums[used, 0], "rows": sums[used, 1]})

    found = rows.select("high", "low", "bytes").mapInPandas(count, "slot long, bytes long, rows long")
    out = np.zeros((len(probes) + 1, 2), np.int64)
    for slot, size, n in found.groupBy("slot").agg(F.sum("bytes"), F.sum("rows")).collect():
        out[slot] = size, n
    return out


def splitters(rows: DataFrame, shards: int, probes_each: int = PROBES, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """Keys that begin shards 1 to shards - 1, for rows of (high, low, bytes).

    A splitter is refined until it misses its wanted position by at most the tolerance, as a share of a shard,
    or no key can lie nearer. The driver holds some probes for every splitter.
    """
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).head()[0]
    wanted = [total * i / shards for i in range(1, shards)]
    # Bytes below known keys; the ends are known at once.
    known = {_as_number(LOWEST): 0, _as_number(HIGHEST) + 1: total}
    close = total / shards * tolerance
    while True:
        order = sorted(known)
        below = [known[k] for k in order]
        probes: set[int] = set()
        for want in wanted:
            i = min(max(bisect.bisect_right(below, want), 1), len(order) - 1)
            low, high = order[i - 1], order[i]
            if min(want - known[low], known[high] - want) <= close or high - low <= 1 or known[low] == known[high]:
                continue
            # Evenly spread; the hash makes keys uniform unless one text is very frequent.
            step = max(1, (high - low) // (probes_each + 1))
            probes.update(range(low + step, high, step)[:probes_each + 1])
        probes -= known.keys()
        if not probes:
            break
        asked = sorted(probes)
        sums = _counted(rows, [_as_key(n) for n in asked])[:, 0].cumsum()
        known |= {n: int(s) for n, s in zip(asked, sums)}
        # Only the two nearest known keys around each wanted position matter from now on.
        order = sorted(known)
        below = [known[k] for k in order]
        keep = {order[0], order[-1]}
        for want in wanted:
            i = min(max(bisect.bisect_right(below, want), 1), len(order) - 1)
            keep |= {order[i - 1], order[i]}
        known = {k: known[k] for k in keep}
    order = sorted(known)
    below = [known[k] for k in order]
    found = []
    for want in wanted:
        i = min(max(bisect.bisect_right(below, want), 1), len(order) - 1)
        nearer = order[i - 1] if want - below[i - 1] <= below[i] - want else order[i]
        found.append(_as_key(min(nearer, _as_number(HIGHEST))))
    return found


def shard(df: DataFrame, size: Column, group: Column, key: Column, shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows with shard and slot (from 0, gapless in its shard) added; bytes per shard are near equal.

    size is a row's bytes, group what keeps rows side by side, key tells rows of a group apart. A shard misses its
    share by at most the two rows at its ends and twice the tolerance; a group is parted only where a boundary
    falls into it. Equal keys stay together. The result does not depend on the order of the rows.
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.xxhash64(group).alias("_high"), F.xxhash64(key, group).alias("_low"), size.cast("long").alias("_bytes"),
    )
    rows = stored(rows)
    plain = rows.select(F.col("_high").alias("high"), F.col("_low").alias("low"), F.col("_bytes").alias("bytes"))
    found = splitters(plain, shards, tolerance=tolerance)

    # Parts of shards, so that no task holds a shard: even cuts of the key range between splitters.
    total = rows.count()
    each = max(1, -(-total // (shards * PART_ROWS)))
    edges = [_as_number(LOWEST), *[_as_number(k) for k in found], _as_number(HIGHEST) + 1]
    cuts = [_as_key(low + (high - low) * i // each) for low, high in zip(edges, edges[1:]) for i in range(each)][1:]

    @F.pandas_udf("long")
    def place(high: pd.Series, low: pd.Series) -> pd.Series:
        return pd.Series(slots_of(high.to_numpy(), low.to_numpy(), cuts))

    parted = rows.withColumn("_part", place("_high", "_low"))
    counts = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).withColumn("shard", (F.col("_part") / each).cast("int"))
    counts = counts.withColumn("_before", F.expr("sum(n) over (partition by shard order by _part) - n")).drop("n")
    own = F.expr("row_number() over (partition by _part order by _high, _low, _bytes)")
    numbered = parted.withColumn("_own", own).join(counts, "_part")
    return numbered.select(
        *[F.col("_row").getField(c).alias(c) for c in kept], "shard", (F.col("_before") + F.col("_own") - 1).cast("long").alias("slot")
    )
