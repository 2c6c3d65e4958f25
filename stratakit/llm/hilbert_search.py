"""Nearest neighbours by inner product with shifted space-filling curves.

Vectors are projected at random to a few dimensions, once per curve, and put in the order of a Hilbert curve through
a shifted grid. Each curve's order is range-partitioned in Spark and cut into blocks of equal length. A
query meets the blocks within a window around its own place on every curve, which rerank their rows by the exact
inner product; the blocks' best are merged. The window is fitted on audit queries, for which all rows are compared.

For the inner product, vectors get one more dimension that brings all to the same length, and queries are scaled
to that length (their neighbours don't depend on it): nearest then means largest inner product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratakit.llm.common import clean_vectors, matrix, stored

CURVES, DIMENSIONS, BITS = 8, 8, 7
BLOCK_ROWS = 2048
AUDIT_QUERIES, AUDIT_RECALL = 64, 0.96
SAMPLE_ROWS = 8192
QUERIES_AT_ONCE = 512


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of integer points (rows x dimensions, each below 2 ** bits)."""
    x = cells.astype(np.uint64).T.copy()
    one, top = np.uint64(1), np.uint64(1 << (bits - 1))
    bit = top
    while bit > one:  # undo the turns and mirrors of every level
        low = bit - one
        for i in range(len(x)):
            high = (x[i] & bit) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, np.uint64(0)) ^ swap
            x[i] ^= swap
        bit >>= one
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn, bit = np.zeros(x.shape[1], np.uint64), top
    while bit > one:
        turn ^= np.where((x[-1] & bit) != 0, bit - one, np.uint64(0))
        bit >>= one
    x ^= turn
    keys = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for row in x:
            keys = (keys << one) | ((row >> np.uint64(level)) & one)
    return keys.view(np.int64)


class Curves:
    """Projections, the spread of their coordinates in a sample, and shifts; bounded by the parameters."""

    def __init__(self, sample: np.ndarray, curves: int, dimensions: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        dimensions = min(dimensions, sample.shape[1])
        self.bits = bits
        self.turns = [np.linalg.qr(rng.normal(size=(sample.shape[1], dimensions)))[0] for _ in range(curves)]
        self.marks = [np.sort(sample @ turn, axis=0) for turn in self.turns]
        self.shifts = rng.random((curves, dimensions)) / 2

    def keys(self, points: np.ndarray) -> np.ndarray:
        """points x curves."""
        out = []
        for turn, marks, shift in zip(self.turns, self.marks, self.shifts):
            flat = points @ turn
            share = np.stack([np.searchsorted(m, f) / (len(m) + 1) for m, f in zip(marks.T, flat.T)], 1)
            out.append(hilbert_keys(np.floor((share + shift) / 1.5 * (1 << self.bits)), self.bits))
        return np.stack(out, 1)


def _lifted(x: np.ndarray, longest: float, queries: bool) -> np.ndarray:
    norms = np.linalg.norm(x, axis=1)
    if queries:
        return np.column_stack([x * (longest / norms)[:, None], np.zeros(len(x))])
    return np.column_stack([x, np.sqrt(np.maximum(longest**2 - norms**2, 0))])


def _best(scores: np.ndarray, nodes: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per row of scores the k largest, ties to the smaller node; nodes ascend."""
    for row in scores:
        if len(row) > k:
            least = np.partition(row, len(row) - k)[len(row) - k]
            at = np.flatnonzero(row >= least)
        else:
            at = np.arange(len(row))
        at = at[np.argsort(-row[at], kind="stable")][:k]
        yield nodes[at], row[at]


def _first(rows: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group, over a hash share of the group and then over those."""
    from pyspark.sql import Window

    share = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(32))
    rows = rows.withColumn("_share", share)
    for keys in ([*by, "_share"], by):
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= k)
    return rows.drop("_share", "_n")


def nearest(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            recall: float = AUDIT_RECALL, curves: int = CURVES, block_rows: int = BLOCK_ROWS,
            seed: int = 13) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query the k other vectors of largest inner product.

    is_query is a condition on the column vec_id. Vectors that are null, zero or hold a null or non-finite part, or
    have no id, take no part; rows with the same id count once, with the least vector. All must have the same number
    of parts. Equal vectors are searched once and listed by id; a query has fewer rows if there are fewer
    candidates. The share of true neighbours found is fitted to ``recall`` on up to 64 audit queries, whose window
    then holds for all. An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = clean_vectors(df, id_col, vector_col).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    same = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), F.col("embedding")).alias("h2")]
    rows = stored(rows.select("*", *same, is_query.alias("asks")))
    nodes = stored(
        rows.groupBy("h1", "h2").agg(
            F.min("vec_id").alias("node"), F.min("embedding").alias("embedding"), F.bool_or("asks").alias("asks")
        )
    )
    total, longest = nodes.agg(
        F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)))
    ).head()
    answer = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], answer)
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col("node")), F.lit(1 << 30))
    sample = nodes.where(chance < int((1 << 30) * min(1.0, SAMPLE_ROWS / total))).select("embedding").toPandas()
    if sample.empty:
        sample = nodes.select("embedding").limit(1).toPandas()
    fitted = Curves(_lifted(matrix(sample["embedding"]), longest, False), curves, DIMENSIONS, BITS, seed)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = matrix(batch["embedding"])
            for asks in (False, True):
                at = np.flatnonzero(batch["asks"]) if asks else np.arange(len(batch))
                if len(at):
                    found = fitted.keys(_lifted(points[at], longest, asks))
                    for c in range(found.shape[1]):
                        yield pd.DataFrame({"curve": c, "key": found[:, c], "node": batch["node"].to_numpy()[at], "asks": asks})

    placed = nodes.select("node", "embedding", "asks").mapInPandas(place, "curve int, key long, node long, asks boolean")

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Within a range partition, which is sorted: the rows of the same curve before this one."""
        before: dict[int, int] = {}
        for batch in batches:
            batch = batch.sort_values(["curve", "key", "node", "asks"], ignore_index=True)
            held = (~batch["asks"]).astype(np.int64)
            batch["local"] = held.groupby(batch["curve"]).cumsum() - held + batch["curve"].map(before).fillna(0).astype(np.int64)
            for c, n in held.groupby(batch["curve"]).sum().items():
                before[c] = before.get(c, 0) + int(n)
            yield batch

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["curve", "key", "node", "asks"]
    ranged = placed.repartitionByRange(max(1, min(width, -(-total * curves // block_rows))), *order).sortWithinPartitions(*order)
    ranged = stored(
        ranged.mapInPandas(number, "curve int, key long, node long, asks boolean, local long")
        .withColumn("part", F.spark_partition_id())
    )
    counts = ranged.groupBy("curve", "part").agg(F.count_if(~F.col("asks")).alias("n")).withColumn(
        "ahead", F.expr("sum(n) over (partition by curve order by part) - n")
    )
    ranks = stored(
        ranged.join(counts, ["curve", "part"]).select("curve", "node", "asks", (F.col("local") + F.col("ahead")).alias("at"))
    )

    window = _fit_window(nodes, ranks, k, recall, total, seed)
    blocks = ranks.where("not asks").select(
        "curve", F.expr(f"at div {block_rows}").alias("block"), "node", F.lit(False).alias("asks"), F.lit(0.0).alias("floor")
    )
    low, high = F.greatest(F.col("at") - window, F.lit(0)), F.least(F.col("at") + window, F.lit(total - 1))
    visits = ranks.where("asks").select(
        "curve",
        F.explode(F.sequence(F.floor(low / block_rows), F.floor(high / block_rows))).alias("block"),
        "node", F.lit(True).alias("asks"),
        F.least(F.expr(f"at div {block_rows}"), F.lit((total - 1) // block_rows)).alias("home"),
    )

    def rerank(rows: pd.DataFrame) -> pd.DataFrame:
        data = rows[~rows["asks"]].sort_values("node")
        asks = rows[rows["asks"]]
        names, points = data["node"].to_numpy(), matrix(data["embedding"])
        out = [pd.DataFrame({"query": [], "node": [], "score": []})]
        for i in range(0, len(asks) if len(data) else 0, QUERIES_AT_ONCE):
            part = asks.iloc[i : i + QUERIES_AT_ONCE]
            best = _best(matrix(part["embedding"]) @ points.T, names, k + 1)
            for query, floor, (at, scores) in zip(part["node"], part["floor"], best):
                use = scores >= floor
                out.append(pd.DataFrame({"query": query, "node": at[use], "score": scores[use]}))
        return pd.concat(out)

    def reranked(asking: DataFrame) -> DataFrame:
        met = blocks.union(asking.select("curve", "block", "node", "asks", "floor")).join(nodes.select("node", "embedding"), "node")
        return met.groupBy("curve", "block").applyInPandas(rerank, "query long, node long, score double")

    def merged(found: DataFrame) -> DataFrame:
        found = found.groupBy("query", "node").agg(F.max("score").alias("score"))
        return _first(found, ["query"], [F.desc("score"), F.asc("node")], k + 1)

    # The blocks around a query's own places come first; the others add only what is no worse than their k + 1 best.
    near = stored(merged(reranked(visits.where("block = home").withColumn("floor", F.lit(float("-inf"))))))
    floors = near.groupBy(F.col("query").alias("node")).agg(
        F.when(F.count(F.lit(1)) > k, F.min("score") - 1e-9).otherwise(float("-inf")).alias("floor")
    )
    found = merged(near.union(reranked(visits.where("block <> home").join(floors, "node"))))

    named = rows.join(nodes.select("h1", "h2", "node"), ["h1", "h2"]).select("node", "vec_id", "asks")
    listed = _first(named.select("node", "vec_id"), ["node"], [F.asc("vec_id")], k + 1)
    asking = named.where("asks").select(F.col("node").alias("query"), F.col("vec_id").alias("query_id"))
    all_rows = found.join(listed, "node").join(asking, "query").where("query_id <> vec_id")
    best = _first(all_rows.select("query_id", "vec_id", "score"), ["query_id"], [F.desc("score"), F.asc("vec_id")], k)
    rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    return best.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score")


def _fit_window(nodes: DataFrame, ranks: DataFrame, k: int, recall: float, total: int, seed: int) -> int:
    """Half width, in rows of a curve, that holds so large a share of the audit queries' true neighbours."""
    chance = F.xxhash64(F.lit(seed), F.lit("audit"), F.col("node"))
    audit = nodes.where("asks").orderBy(chance, "node").limit(AUDIT_QUERIES).select("node", "embedding").toPandas()
    if audit.empty:
        return 0
    points, names = matrix(audit["embedding"]), audit["node"].to_numpy()

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.sort_values("node")
            scores = points @ matrix(batch["embedding"]).T
            for query, (at, found) in zip(names, _best(scores, batch["node"].to_numpy(), k + 1)):
                yield pd.DataFrame({"query": query, "node": at, "score": found})

    true = nodes.select("node", "embedding").mapInPandas(compare, "query long, node long, score double")
    true = _first(true.where("query <> node"), ["query"], [F.desc("score"), F.asc("node")], k).select("query", "node")
    there = ranks.where("not asks").select("curve", "node", F.col("at").alias("its"))
    here = ranks.where("asks").select("curve", F.col("node").alias("query"), F.col("at").alias("own"))
    far = F.min(F.abs(F.col("its") - F.col("own"))).alias("far")
    apart = there.join(true, "node").join(here, ["curve", "query"]).groupBy("query", "node").agg(far)
    distances = np.sort([r["far"] for r in apart.collect()])
    return int(distances[min(len(distances) - 1, int(np.ceil(recall * len(distances))))]) if len(distances) else 0
