"""Near-duplicate vectors by range search on a robust-pruned flat graph.

Vectors are assigned to their nearest centroids, several each, so that shards overlap. Every shard builds a
graph of pruned neighbour lists; a vector's lists from all its shards are united. Then every shard searches its
members' ranges: a greedy beam search from the shard's medoid, and from the vector's own place, goes on from everything
it finds in range. Found pairs are confirmed by the exact cosine. A pair that shares several shards counts in the
first one, so nothing but counts and one link per member leaves a shard, however many copies there are.

Centroids that are in range of each other become one, so that a group of near copies is not cut into many shards. A
shard that is too large is built in slices, and a task searches one pair of slices. Recall is audited against all rows
for a sample, half of it from vectors with links; the overlap is doubled while it is too low, and a recall that
stays too low is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratakit.llm.common import clean_vectors, components, matrix, stored

OVERLAP, SHARD_ROWS, MOST_ROWS = 3, 1000, 2048
MOST_CELLS, SAMPLE_PER_CELL = 4096, 24
AUDIT_ROWS, AUDIT_RECALL, MOST_OVERLAP = 512, 0.995, 48
NEAR, FAR, DEGREE, ALPHA = 64, 16, 24, 1.2
BEAM, AT_ONCE, MOST_AT_ONCE, QUERIES_AT_ONCE = 32, 4, 128, 128


class RecallError(RuntimeError):
    """Too many links are missing, as an audit against all rows shows."""


def centroids(points: np.ndarray, cells: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means of a sample of unit vectors."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(cells, len(points)), replace=False)]
    for _ in range(rounds):
        own = (points @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres


def thinned(centres: np.ndarray, least: float) -> np.ndarray:
    """The centroids without those that are in range of one before."""
    kept = np.zeros(len(centres), bool)
    for i, row in enumerate(centres @ centres.T >= least):
        kept[i] = not (row & kept).any()
    return centres[kept]


def pruned_graph(points: np.ndarray, seed: int = 1) -> list[np.ndarray]:
    """Neighbour lists of unit vectors: robust pruning of near and of random candidates, and the reverse edges.

    A candidate is left out if a neighbour already taken is closer to it than the vector is, by the factor ALPHA.
    """
    n = len(points)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    rng = np.random.default_rng(seed)
    apart = 1 - points @ points.T
    np.fill_diagonal(apart, np.inf)
    near, far = min(NEAR, n - 1), min(FAR, n - 1)
    out: list[np.ndarray] = []
    for begin in range(0, n, 128):
        rows = np.arange(begin, min(n, begin + 128))
        close = np.argpartition(apart[rows], near - 1, axis=1)[:, :near]
        found = []
        for candidates, most in ((close, DEGREE * 2 // 3), (rng.integers(0, n, (len(rows), far)), DEGREE // 3)):
            own = np.take_along_axis(apart[rows], candidates, 1)
            between = apart[candidates[:, :, None], candidates[:, None, :]]
            open_ = np.isfinite(own)
            taken = np.full((len(rows), most), -1)
            for step in range(most):
                left = np.where(open_, own, np.inf)
                best = left.argmin(1)
                live = np.isfinite(left[np.arange(len(rows)), best])
                taken[live, step] = candidates[live, best[live]]
                gap = between[np.arange(len(rows)), best]
                gap[np.arange(len(rows)), best] = 0
                open_ &= ~live[:, None] | (ALPHA * np.where(np.isfinite(gap), gap, 0) > own)
            found.append(taken)
        out += [row[row >= 0] for row in np.concatenate(found, 1)]
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(out):
        for j in row:
            back[j].append(i)
    return [
        np.unique(np.concatenate([row, sorted(b, key=lambda j: apart[i, j])[: DEGREE // 2]])).astype(np.int64)
        for i, (row, b) in enumerate(zip(out, back))
    ]


def range_search(points: np.ndarray, graph: np.ndarray, queries: np.ndarray, own: np.ndarray, entry: int,
                 least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) pairs of at least so large an inner product that are met on the graph.

    graph is points x degree, filled up with -1; own is the query's place among the points, or -1. A query goes
    on while one of its BEAM best points, or any point in range, is not expanded.
    """
    asks = np.arange(len(queries))
    seen = np.zeros((len(queries), len(points) + 1), bool)  # the last column takes the -1 of the graph
    scores = np.full((len(queries), len(points) + 1), -np.inf, np.float32)
    todo = np.full_like(scores, -np.inf)
    seen[:, -1] = True
    for place in (np.full(len(queries), entry), own):
        score = np.einsum("qd,qd->q", points[place], queries)
        at = place >= 0
        seen[asks[at], place[at]] = True
        scores[asks[at], place[at]] = todo[asks[at], place[at]] = score[at]
    width = min(BEAM, len(points))
    while len(asks):
        rows = scores[asks]
        bar = np.minimum(np.partition(rows, -width, axis=1)[:, -width], np.float32(least))
        # All that is in range is to be expanded, in rounds of a bounded number for each query.
        in_range = int((todo[asks] >= least).sum(1).max())
        some = min(max(AT_ONCE, min(in_range, MOST_AT_ONCE)), len(points))
        best = np.argpartition(todo[asks], -some, axis=1)[:, -some:]
        worth = np.take_along_axis(todo[asks], best, 1)
        go = (worth >= bar[:, None]) & np.isfinite(worth)
        alive = go.any(1)
        asks, best, go = asks[alive], best[alive], go[alive]
        if not len(asks):
            break
        todo[np.repeat(asks, some), best.ravel()] = np.where(go, -np.inf, todo[asks[:, None], best]).ravel()
        around = np.where(go[:, :, None], graph[best], -1).reshape(len(asks), -1)
        met = np.zeros((len(asks), len(points) + 1), bool)
        np.put_along_axis(met, np.where(around < 0, len(points), around), True, 1)
        which, place = np.nonzero(met & ~seen[asks])
        seen[asks[which], place] = True
        for i in range(0, len(which), 100_000):
            q, x = asks[which[i : i + 100_000]], place[i : i + 100_000]
            scores[q, x] = todo[q, x] = np.einsum("nd,nd->n", points[x], queries[q])
    return np.nonzero(scores[:, :-1] >= least)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of n reaches over the edges."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95,
                 overlap: int = OVERLAP, recall: float = AUDIT_RECALL, shard_rows: int = SHARD_ROWS,
                 most_rows: int = MOST_ROWS, seed: int = 17) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per vector; two are linked if their cosine is at least ``least``.

    Vectors that are null, zero or hold a null or non-finite part have no link and are kept. Rows with the same id
    count once, with the least usable vector; rows without id are left out. Equal vectors form one node, of which
    copies are counted. Vectors are compared with those of as many parts. The centroids come from a sample of at
    most 4096 x 24 vectors; a cell with more than most_rows members is built in slices, and each member searches all
    of them. RecallError if the audited recall stays below ``recall`` at the largest overlap.
    """
    spark = df.sparkSession
    every = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id")).where("vec_id is not null").distinct()
    rows = clean_vectors(df, id_col, vector_col).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    same = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), F.col("embedding")).alias("h2")]
    rows = stored(rows.select("*", *same))
    nodes = stored(
        rows.groupBy("h1", "h2").agg(
            F.min("vec_id").alias("node"), F.min("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies")
        )
    )
    lengths = [r[0] for r in nodes.groupBy(F.size("embedding").alias("n")).count().orderBy("n").collect()]
    named = rows.join(nodes.select("h1", "h2", "node", "copies"), ["h1", "h2"]).select("vec_id", "node", "copies")
    counts = spark.createDataFrame([], "node long, links long")
    edges = spark.createDataFrame([], "a long, b long")
    for length in lengths:
        own = nodes if len(lengths) == 1 else stored(nodes.where(F.size("embedding") == length))
        total, wide = own.count(), overlap
        while True:
            found = _search(own, total, least, wide, shard_rows, most_rows, seed)
            share = _audit(own, found, least, seed)
            if share >= recall:
                break
            if wide >= MOST_OVERLAP:
                raise RecallError(f"{share:.4f} of the audited links were found, fewer than {recall}")
            wide *= 2
        counts = counts.union(found.groupBy("node").agg(F.sum("links").alias("links")))
        edges = edges.union(found.where("root <> node").select(F.col("root").alias("a"), F.col("node").alias("b")))
    edges = edges.union(named.where("vec_id <> node").select(F.col("node").alias("a"), F.col("vec_id").alias("b")))
    linked = components(edges).select(F.col("id").alias("vec_id"), "component")
    out = every.join(named, "vec_id", "left").join(counts, "node", "left").join(linked, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).alias("n_links"),
        component.alias("component_id"),
        (component == F.col("vec_id")).alias("kept"),
    )


def _units(column: pd.Series) -> np.ndarray:
    """Vectors of length one; their largest part is made one first, so that no square over- or underflows."""
    points = matrix(column)
    if not len(points):
        return points
    points = points / np.abs(points).max(axis=1, keepdims=True)
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def _search(nodes, total, least, overlap, shard_rows, most_rows, seed) -> DataFrame:
    """(node, links, root) for every node and shard: copies linked to it there, and the least node of its links."""
    spark = nodes.sparkSession
    cells = max(1, min(MOST_CELLS, -(-total * overlap // shard_rows)))
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col("node")), F.lit(1 << 30))
    wanted = max(512, cells * SAMPLE_PER_CELL)
    sample = nodes.where(chance < int((1 << 30) * min(1.0, wanted / total))).select("node", "embedding").toPandas()
    if sample.empty:
        sample = nodes.select("node", "embedding").limit(1).toPandas()
    centres = thinned(centroids(_units(sample.sort_values("node")["embedding"]), cells, seed), least)
    near = min(overlap, len(centres))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            closest = np.argpartition(-(_units(batch["embedding"]) @ centres.T), near - 1, axis=1)[:, :near]
            yield pd.DataFrame({"node": batch["node"], "cells": list(np.sort(closest, 1))})

    assigned = stored(nodes.select("node", "embedding").mapInPandas(assign, "node long, cells array<long>"))
    spread = assigned.select("node", "cells", F.explode("cells").alias("cell"))
    sizes = spread.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / most_rows).alias("slices"))
    spread = spread.join(sizes, "cell").withColumn("slice", F.pmod(F.xxhash64("node", F.lit(seed)), F.col("slices")))
    spread = stored(spread)
    vectors = nodes.select("node", "embedding", "copies")

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        names = rows["node"].to_numpy()
        lists = [names[x] for x in pruned_graph(_units(rows["embedding"]).astype(np.float32))]
        return pd.DataFrame({"node": names, "around": lists})

    lists = spread.select("cell", "slice", "node").join(vectors, "node").groupBy("cell", "slice")
    lists = lists.applyInPandas(build, "node long, around array<long>")
    graph = stored(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("around"))).alias("around")))

    # A task has one slice, or two of a cell whose members search each other's.
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("other")
    met = spread.select("cell", "slice", "cells", "node", others).select(
        "cell", F.least("slice", "other").alias("one"), F.greatest("slice", "other").alias("two"), "slice", "cells", "node"
    ).join(vectors, "node").join(graph, "node")

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["slice", "node"], ignore_index=True)
        names, copies, side = rows["node"].to_numpy(), rows["copies"].to_numpy(), rows["slice"].to_numpy()
        exact, mine = _units(rows["embedding"]), np.stack(rows["cells"])
        points = exact.astype(np.float32)
        sides = [np.flatnonzero(side == s) for s in np.unique(side)]
        pairs = [(sides[0], sides[0])] if rows["one"].iloc[0] == rows["two"].iloc[0] else [(sides[0], sides[-1]), (sides[-1], sides[0])]
        close = np.zeros((len(rows), len(rows)), bool)  # at most two slices, so its size is bounded
        for data, asks in pairs if len(sides) > 1 or len(pairs) == 1 else []:
            place = {v: i for i, v in enumerate(names[data].tolist())}
            lists = [[place[v] for v in x.tolist() if v in place] for x in rows["around"].iloc[data]]
            table = np.full((len(data) + 1, max(1, max(map(len, lists)))), -1)
            for i, x in enumerate(lists):
                table[i, : len(x)] = x
            held = points[data]
            entry = int((held @ held.mean(0)).argmax())
            for begin in range(0, len(asks), QUERIES_AT_ONCE):
                part = asks[begin : begin + QUERIES_AT_ONCE]
                own = np.arange(begin, begin + len(part)) if data is asks else np.full(len(part), -1)
                left, right = range_search(held, table, points[part], own, entry, least - 1e-5)
                close[part[left], data[right]] = True
        close |= close.T
        np.fill_diagonal(close, False)
        cell, links, label = rows["cell"].iloc[0], np.zeros(len(rows), np.int64), np.arange(len(rows))
        for begin in range(0, len(rows), QUERIES_AT_ONCE):
            a, b = np.nonzero(close[begin : begin + QUERIES_AT_ONCE])
            a += begin
            for i in range(0, len(a), 50_000):
                x, y = a[i : i + 50_000], b[i : i + 50_000]
                sure = np.einsum("nd,nd->n", exact[x], exact[y]) >= least
                close[x[~sure], y[~sure]] = False
                x, y = x[sure], y[sure]
                both = np.where((mine[x][:, :, None] == mine[y][:, None, :]).any(2), mine[x], np.iinfo(np.int64).max)
                np.add.at(links, x[both.min(1) == cell], copies[y[both.min(1) == cell]])
        while True:  # every row takes the least label among its links, block by block, until none changes
            low = label.copy()
            for begin in range(0, len(rows), QUERIES_AT_ONCE):
                block = close[begin : begin + QUERIES_AT_ONCE]
                low[begin : begin + len(block)] = np.minimum(
                    label[begin : begin + len(block)], np.where(block, label[None, :], len(rows)).min(1, initial=len(rows))
                )
            low = low[low]
            if (low == label).all():
                break
            label = low
        # Rows are in order of their slices, so the least place need not have the least name.
        least_name = np.full(len(rows), np.iinfo(np.int64).max)
        np.minimum.at(least_name, label, names)
        return pd.DataFrame({"node": names, "links": links, "root": least_name[label]})

    return stored(met.groupBy("cell", "one", "two").applyInPandas(search, "node long, links long, root long"))


def _audit(nodes: DataFrame, found: DataFrame, least: float, seed: int) -> float:
    """Share of the true links found, of a sample of nodes that is compared with all rows."""
    chance = F.xxhash64(F.lit(seed), F.lit("audit"), F.col("node"))
    linked = found.groupBy("node").agg(F.sum("links").alias("links")).where("links > 0").select("node")
    halves = [nodes.join(linked, "node", "left_semi"), nodes]
    halves = [half.orderBy(chance, "node").limit(AUDIT_ROWS // 2).select("node", "embedding") for half in halves]
    sample = halves[0].union(halves[1]).toPandas().drop_duplicates("node")
    points, names = _units(sample["embedding"]), sample["node"].to_numpy()

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            close = _units(batch["embedding"]) @ points.T >= least
            links = (close & (batch["node"].to_numpy()[:, None] != names)).T @ batch["copies"].to_numpy()
            yield pd.DataFrame({"node": names, "links": links})

    true = nodes.select("node", "embedding", "copies").mapInPandas(compare, "node long, links long")
    true = true.groupBy("node").agg(F.sum("links").alias("real")).where("real > 0")
    got = found.groupBy("node").agg(F.sum("links").alias("got")).join(true, "node")
    whole, part = got.agg(F.sum("real"), F.sum("got")).head()
    return part / whole if whole else 1.0
