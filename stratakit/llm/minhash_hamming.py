"""Near-duplicate documents: b-bit MinHash signatures, a multi-index Hamming join, exact confirmation.

A document's set is its distinct word shingles. Equal sets form one class; classes are compared. A signature has
``parts`` values of 16 bits, split into ``chunks``. If two signatures differ in at most ``distance`` values, some
chunk differs in at most ``distance // chunks`` of its values (pigeonhole). Every chunk is therefore indexed
once per choice of so many values to leave out, and two such signatures meet under a common key: the join
finds every pair within the distance. Pairs are confirmed on the full sets.

Groups of near copies are linked without listing their pairs. Under each key all members are first compared with
the member that meets most others; what that joins is one component already. Of the keys under which several
components are left, members with too many shingles of their own can be similar to nobody and drop out; pairs of
the others are compared if their components differ and their shared shingles may suffice.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations, count

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType

from stratakit.llm.common import BROADCAST_ROWS, bound_batches, by_rows, components, sliced, stored

PARTS, CHUNKS, DISTANCE = 48, 8, 15
REJECT = 24
"""Pairs that differ in more values are not confirmed; at similarity 0.85 that has a chance of one in a million."""
SLICE = 2_000_000


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """Per text the sorted 64-bit hashes of its distinct shingles; empty without words."""
    texts = [t or "" for t in texts]
    for begin, end in sliced(texts, SLICE):
        number: dict[bytes, int] = defaultdict(count().__next__)
        ids = []
        for text in texts[begin:end]:
            parts = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and the six ASCII spaces only
            ids.append(np.fromiter(map(number.__getitem__, parts), np.int64, len(parts)))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
        for at in ids:
            if not len(at):
                yield np.zeros(0, np.uint64)
                continue
            taken, wide = hashes[at], min(words, len(at))
            rolled = np.full(len(at) - wide + 1, wide, np.uint64)
            for i in range(wide):
                rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + taken[i : i + len(rolled)]
            yield np.unique(_mixed(rolled))


def signature(shingles: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """For each of so many hash functions 16 bits of the least value over the set."""
    rng = np.random.default_rng(11)
    factor = rng.integers(1, 1 << 63, parts, np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, parts, np.uint64)
    least = np.full(parts, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        least = np.minimum(least, (shingles[i : i + 2048, None] * factor + shift).min(0))
    return (_mixed(least) >> np.uint64(48)).astype(np.uint16)


def chunk_keys(signatures: np.ndarray, chunks: int = CHUNKS, distance: int = DISTANCE) -> np.ndarray:
    """Per signature a key for each chunk and each choice of the values that may differ in it."""
    parts = signatures.shape[1]
    marked = _mixed(signatures.astype(np.uint64) + np.arange(1, parts + 1, dtype=np.uint64) * np.uint64(1 << 20))
    keys = []
    for chunk in np.array_split(np.arange(parts), chunks):
        whole = marked[:, chunk].sum(1, dtype=np.uint64)
        for left in combinations(chunk, min(distance // chunks, len(chunk) - 1)):
            rest = whole - marked[:, list(left)].sum(1, dtype=np.uint64)
            keys.append(_mixed(rest + np.uint64((len(keys) + 1) * 0xD6E8FEB86659FD93 % (1 << 64))))
    return np.stack(keys, 1).view(np.int64)


# ---- tables --------------------------------------------------------------------------------------


def sketches(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, n_shingles, set_key, signature) per row; the last two are null for an empty set."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for shingles in shingle_sets(batch["text"].tolist(), words):
                sizes.append(len(shingles))
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pd.DataFrame({"id": batch["id"], "n_shingles": sizes, "set_key": keys, "signature": signatures})

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInPandas(sketch, "id long, n_shingles long, set_key binary, signature binary")


@F.pandas_udf(ArrayType(LongType()))
def _keys(signatures: pd.Series) -> pd.Series:
    rows = np.frombuffer(b"".join(signatures), np.uint16).reshape(len(signatures), -1)
    return pd.Series(list(chunk_keys(rows)))


@F.pandas_udf(IntegerType())
def _differing(a: pd.Series, b: pd.Series) -> pd.Series:
    left, right = (np.frombuffer(b"".join(x), np.uint16).reshape(len(x), -1) for x in (a, b))
    return pd.Series((left != right).sum(1).astype(np.int32))


def _with_ends(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    for end in ("a", "b"):
        pairs = pairs.join(table.select(F.col("node").alias(end), F.col(column).alias(f"{column}_{end}")), end)
    return pairs


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; pairs with far apart signatures are not looked at."""

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for left, right in zip(a, b):
            x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
            common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pd.Series(out, dtype=bool)

    near = pairs.where(_differing("signature_a", "signature_b") <= REJECT).select("a", "b").distinct()
    return stored(_with_ends(near, sets, "shingles").where(similar("shingles_a", "shingles_b")).select("a", "b").distinct())


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 85) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row of df.

    Rows are linked if ``100 * intersection >= percent * union`` holds for their sets of shingles of so many
    words; a shorter text is one shingle. component_id is the smallest id reachable by links, kept marks
    the row with that id. A text that is null or without words has an empty set and is linked with nothing. Rows
    with the same id count as one document. A row without id has no component and is kept. Sets are held as
    64-bit hashes of their shingles. Other columns are ignored.
    """
    bound_batches(df.sparkSession)
    base = stored(sketches(df, id_col, text_col, words))
    filled = base.where("id is not null and set_key is not null")
    classes = stored(
        filled.groupBy("set_key").agg(F.min("id").alias("node"), F.min("signature").alias("signature"))
    )
    same = filled.join(classes.select("set_key", "node"), "set_key").where("id <> node").select(
        F.col("node").alias("a"), F.col("id").alias("b")
    )
    links = stored(same.distinct()).union(_near_links(df, id_col, text_col, words, percent, classes))
    found = by_rows(components(links)).select(F.col("id").alias("linked"), "component")
    rows = base.join(found, F.col("id") == F.col("linked"), "left")
    component = F.coalesce("component", "id")
    return rows.select(
        "id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )


def _near_links(df, id_col, text_col, words, percent, classes) -> DataFrame:
    """Links (a, b) between classes, enough to tell their components."""
    keyed = classes.select("node", F.explode(_keys("signature")).alias("key"))
    several = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # Spark takes the keys for one row of each class and, having them as numbers, for less than the classes themselves.
    met = stored(keyed.hint("merge").join(several, "key"))
    scores = stored(met.groupBy("node").agg(F.sum("members").alias("score")))
    nodes = scores.count()
    scores = by_rows(scores, nodes)
    signatures = stored(classes.join(scores, "node").select("node", "signature"))

    ids = scores.select(F.col("node").alias("id"))
    if nodes <= BROADCAST_ROWS:
        ids = F.broadcast(ids)

    def to_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [x.tobytes() for x in shingle_sets(batch["text"].tolist(), words)]
            yield pd.DataFrame({"node": batch["id"], "shingles": sets})

    texts = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    sets = stored(
        texts.where(F.col("text").isNotNull()).join(ids, "id", "left_semi")
        .mapInPandas(to_sets, "node long, shingles binary")
    )

    best = F.max_by("node", F.struct(F.col("score"), -F.col("node"))).alias("leader")
    leaders = met.join(scores, "node").groupBy("key").agg(best)
    star = met.hint("merge").join(leaders, "key").where("node <> leader").select(*_pair("node", "leader")).distinct()
    star = by_rows(stored(star))
    links = _confirmed(_with_ends(star, signatures, "signature"), sets, percent)
    named = by_rows(components(links)).select(F.col("id").alias("node"), "component")
    rows = met.join(named, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    several = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    left = stored(rows.join(several.where("low < high").select("key"), "key"))
    if left.isEmpty():
        return links

    able = left.select("node").distinct()
    for _ in range(2):
        able = _able(able, sets, percent)
    keys = left.groupBy("node").agg(F.collect_set("key").alias("keys"))
    left = stored(left.join(by_rows(able), "node").join(keys, "node").join(signatures, "node"))
    other = left.select(*[F.col(c).alias(f"its_{c}") for c in left.columns])
    most = F.least("shared", "its_shared")
    # All keys of a node stand in each of its rows, side by side, which files pack to a fraction.
    rest = left.hint("merge").join(
        other,
        F.expr("key = its_key and node < its_node and component <> its_component")
        & (100 * most >= percent * (F.col("size") + F.col("its_size") - most))
        & (F.array_min(F.array_intersect("keys", "its_keys")) == F.col("key")),
    )
    rest = rest.select(
        F.col("node").alias("a"), F.col("its_node").alias("b"),
        F.col("signature").alias("signature_a"), F.col("its_signature").alias("signature_b"),
    )
    return links.union(_confirmed(rest.join(star, ["a", "b"], "left_anti"), sets, percent))


def _able(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, size, shared) of the nodes that can be similar enough to another of them.

    shared counts the shingles that some other node has too: no intersection is larger.
    """

    @F.pandas_udf("array<long>")
    def numbers(shingles: pd.Series) -> pd.Series:
        return shingles.map(lambda x: np.frombuffer(x, np.int64))

    own = sets.join(nodes.select("node"), "node").select("node", F.explode(numbers("shingles")).alias("shingle"))
    alone = own.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
    alone = alone.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    size = (F.octet_length("shingles") / 8).cast("long")
    sizes = sets.join(nodes.select("node"), "node").groupBy("node").agg(
        F.min(size).alias("size"), F.max(size).alias("most"), F.count(F.lit(1)).alias("texts")
    )
    shared = F.when(F.col("texts") == 1, F.col("size") - F.coalesce("alone", F.lit(0))).otherwise(F.col("most"))
    found = sizes.join(alone, "node", "left").select("node", "size", shared.alias("shared"))
    return stored(found.where(100 * F.col("shared") >= percent * F.col("size")))
