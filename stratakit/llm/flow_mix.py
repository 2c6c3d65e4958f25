"""Mixing sources to target weights by a minimum-cost flow.

A document may belong to several sources. Documents are added up by their membership pattern; the flow routes each
pattern's words to the quotas of its sources, where taking a document again costs more than taking it first, so
nothing repeats while unused words can serve. The flow knows patterns and sources only. Then documents
are chosen in the order of a seeded hash: buckets of the hash are given whole, and only the buckets in which a
quota ends look at single documents.
"""

from __future__ import annotations

import json
from collections import deque

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakit.llm.common import small_table, stored

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
BUCKET_ROWS = 2000
MOST_PATTERNS = 20_000
"""Patterns of membership on the driver, at most; more raise an error."""


def targets(sizes: dict[str | None, int], weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> dict:
    """Target words of each source: shares by weight, none above so many times its size.

    Sources stand in code point order, null last, and take the weights in turn. What exceeds a limit is
    shared again by weight among the others.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    found, left, free = {}, share * sum(sizes.values()), list(order)
    while free:
        whole = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / whole > most * sizes[s]]
        if not above:
            found |= {s: left * weight[s] / whole for s in free}
            break
        for s in above:
            found[s] = float(most * sizes[s])
            left -= found[s]
        free = [s for s in free if s not in found]
    return found


def min_cost_flow(capacity: dict[str, int], members: dict[str, list], quotas: dict, costs=(1, 3)) -> dict:
    """Words that each pattern gives to each of its sources: {(pattern, source): words}.

    Each pattern gives its capacity once for every entry of costs. Successive cheapest paths fill the quotas
    as far as possible; the result is the same in every run.
    """
    ends, room, price, arcs = [], [], [], {}

    def arc(a, b, most, cost):
        for x, y, m, c in ((a, b, most, cost), (b, a, 0, -cost)):
            arcs.setdefault(x, []).append(len(ends))
            ends.append(y)
            room.append(m)
            price.append(c)

    for p in sorted(capacity):
        for cost in costs:
            arc("begin", ("pattern", p), capacity[p], cost)
        for s in members[p]:
            arc(("pattern", p), ("source", s), len(costs) * capacity[p], 0)
    for s in sorted(quotas, key=lambda s: (s is None, s or "")):
        arc(("source", s), "end", quotas[s], 0)
    while True:
        cheapest, came, queue, waits = {"begin": 0}, {}, deque(["begin"]), {"begin"}
        while queue:
            node = queue.popleft()
            waits.discard(node)
            for i in arcs.get(node, ()):
                if room[i] > 0 and cheapest[node] + price[i] < cheapest.get(ends[i], float("inf")):
                    cheapest[ends[i]], came[ends[i]] = cheapest[node] + price[i], i
                    if ends[i] not in waits:
                        queue.append(ends[i])
                        waits.add(ends[i])
        if "end" not in came:
            break
        path, node = [], "end"
        while node != "begin":
            path.append(came[node])
            node = ends[came[node] ^ 1]
        most = min(room[i] for i in path)
        for i in path:
            room[i] -= most
            room[i ^ 1] += most
    return {
        (a[1], ends[i][1]): room[i ^ 1]
        for a, own in arcs.items() if a[0] == "pattern"
        for i in own if not i % 2 and room[i ^ 1] > 0
    }


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket in which quotas end: the documents in hash order, each to the first portion it fits in."""
    rows = rows.sort_values(["hash", "uid"])
    given: list[list] = [[] for _ in range(len(rows))]
    laps: dict[int, list] = {}
    for portion in rows["portions"].iloc[0]:
        laps.setdefault(portion["lap"], []).append([portion["source"], portion["words"]])
    for lap in sorted(laps):
        for i, size in enumerate(rows["size"]):
            for portion in laps[lap]:
                if 0 < size <= portion[1]:
                    portion[1] -= size
                    given[i].append(portion[0])
                    break
    return pd.DataFrame({"uid": rows["uid"], "given": given})


def mix(df: DataFrame, sources: Column, size: Column, quotas: dict | None = None, seed: int = 3,
        most: int = MOST, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, dict, dict]:
    """(rows with ``words`` and ``given`` added, words of each source, quotas).

    sources is an array of the sources a row belongs to (null stands for the source without a name), size its
    words. ``given`` lists the sources that take the row, once for each time; it is empty for a row that is not
    taken or has no words, and never longer than most. quotas are words by source; without them they follow
    from ``targets``. A quota is missed by less than the smallest document left in its last bucket. The
    choice depends on the hash of the rows and not on their order. Driver: one entry for each pattern and source.
    """
    pattern = F.to_json(F.struct(F.array_sort(F.array_distinct(sources)).alias("of")))
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    base = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("words"),
        pattern.alias("pattern"),
        F.xxhash64(F.lit(seed), *plain).alias("hash"),
        F.monotonically_increasing_id().alias("uid"),
    )
    base = stored(base)
    sums = base.groupBy("pattern").agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("rows"))
    known = sums.limit(MOST_PATTERNS + 1).collect()
    if len(known) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} patterns of membership")
    capacity = {r["pattern"]: r["words"] for r in known}
    members = {p: json.loads(p).get("of") or [] for p in capacity}
    sizes: dict = {}
    for p, words in capacity.items():
        for s in members[p]:
            sizes[s] = sizes.get(s, 0) + words
    quotas = targets(sizes, most=most) if quotas is None else quotas
    routed = min_cost_flow(capacity, members, {s: round(q) for s, q in quotas.items()}, tuple(range(1, 2 * most, 2)))

    # Each pattern's routed words lie on a line that runs through its documents lap after lap.
    ranges, at = [], {}
    for (p, s), words in sorted(routed.items(), key=lambda x: (x[0][0], x[0][1] is None, x[0][1] or "")):
        begin = at.get(p, 0)
        ranges += [(p, s, begin, begin + words, lap, lap * capacity[p]) for lap in range(most)]
        at[p] = begin + words
    schema = {"pattern": pa.string(), "source": pa.string(), "low": pa.int64(), "high": pa.int64(), "lap": pa.int32(), "ahead": pa.int64()}
    lines = small_table(df.sparkSession, ranges, schema)

    buckets = max(1, -(-sum(r["rows"] for r in known) // bucket_rows))
    base = base.withColumn("bucket", F.pmod(F.shiftright("hash", 8), F.lit(buckets)))
    held = base.groupBy("pattern", "bucket").agg(F.sum("words").alias("own"))
    below = "sum(own) over (partition by pattern order by bucket) - own"
    parts = held.withColumn("below", F.expr(below)).join(lines, "pattern").withColumn(
        "part",
        F.least(F.col("high"), F.col("ahead") + F.col("below") + F.col("own"))
        - F.greatest(F.col("low"), F.col("ahead") + F.col("below")),
    )
    portion = F.struct("lap", "source", F.col("part").alias("words"))
    plan = stored(
        parts.where("part > 0").groupBy("pattern", "bucket").agg(
            F.array_sort(F.collect_list(portion)).alias("portions"), F.bool_and(F.col("part") == F.col("own")).alias("whole")
        )
    )
    open_rows = base.join(plan.where("not whole"), ["pattern", "bucket"]).select(
        "pattern", "bucket", "uid", "hash", F.col("words").alias("size"), "portions"
    )
    chosen = stored(open_rows.groupBy("pattern", "bucket").applyInPandas(_fill, "uid long, given array<string>"))
    whole = plan.where("whole").select("pattern", "bucket", F.col("portions.source").alias("all"))
    rows = base.join(whole, ["pattern", "bucket"], "left").join(chosen, "uid", "left")
    nothing = F.array().cast("array<string>")
    given = F.when(F.col("words") > 0, F.coalesce("all", "given", nothing)).otherwise(nothing)
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c.lower() not in ("words", "given")]
    return rows.select(*kept, "words", given.alias("given")), sizes, quotas
