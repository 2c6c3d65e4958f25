"""Hard negatives by rotated one-bit codes.

Every vector v, scaled to integers, is turned by several random rotations, and a code keeps one bit for each turned
component. Read as +1 and -1 and turned back, a code is a vector u; with v are stored its alignment <v, u> / <u, u>,
the length of u, and the length of the residual e = v - alignment * u, which is at a right angle to u. For an anchor q

    <v, q> = alignment * <u, q> + <e, q>   and   |<e, q>| <= |e| * sqrt(|q|^2 - <u, q>^2 / |u|^2)   (Cauchy-Schwarz)

<u, q> is the inner product of the bits with the turned anchor, whose components are rounded to a few bits: popcounts
of the code with the anchor's bit planes, plus the rounding's exact share. Both errors are bounds, not estimates, so
a pair whose interval misses the wanted range is never scored, and all others get their exact integer score.

Anchors are dealt in parts and rows in blocks of bounded size; a task holds one part and one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratakit.llm.common import stored

ROTATIONS, PLANES = 8, 6
ANCHORS_PER_PART, ROWS_PER_BLOCK, AT_ONCE = 4096, 4096, 32
SEEDS = 64
"""Candidates of the best estimates that are scored first; their scores raise the bound for the others."""
WIDE = 2.0**22
"""Vectors with larger integer parts are outside of what doubles hold exactly; they pass the filter unseen."""
LAST = 2**63 - 1


@lru_cache(8)
def rotations(dims: int, number: int, seed: int) -> np.ndarray:
    """(number * dims, dims): random orthogonal matrices, one below the other."""
    rng = np.random.default_rng([seed, dims])
    return np.concatenate([np.linalg.qr(rng.normal(size=(dims, dims)))[0] for _ in range(number)]) if dims else np.zeros((0, 0))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words, filled up with zeros."""
    packed = np.packbits(bits, axis=-1)
    fill = -packed.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed, [(0, 0)] * (bits.ndim - 1) + [(0, fill)])).view(np.uint64)


def encode(points: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (n, words) and (n, 3): alignment, length of the code's vector, length of the residual."""
    wide = np.abs(points).max(axis=1, initial=0) > WIDE
    points = np.where(wide[:, None], 0, points)
    bits = points @ turn.T >= 0
    back = (2.0 * bits - 1) @ turn
    square = np.maximum((back * back).sum(1), 1e-300)
    product = (points * back).sum(1)
    left = np.sqrt(np.maximum((points * points).sum(1) - product * product / square, 0))
    return _words(bits), np.column_stack([product / square, np.sqrt(square), np.where(wide, np.inf, left)])


def intervals(codes: np.ndarray, facts: np.ndarray, anchors: np.ndarray, turn: np.ndarray, planes: int = PLANES):
    """(estimates, errors), anchors x codes: every true product lies within its estimate plus or minus its error."""
    wide = np.abs(anchors).max(axis=1, initial=0) > WIDE
    anchors = np.where(wide[:, None], 0, anchors)
    turned = anchors @ turn.T
    low = turned.min(axis=1, initial=0)[:, None]
    step = np.maximum(turned.max(axis=1, initial=0)[:, None] - low, 1e-300) / ((1 << planes) - 1)
    steps = np.rint((turned - low) / step).astype(np.int64)
    rounding = np.abs(turned - (low + step * steps)).sum(1)[:, None]
    held = np.zeros((len(anchors), len(codes)))
    for plane in range(planes):
        words = _words((steps >> plane & 1).astype(bool))
        count = np.zeros(held.shape, np.int32)
        for w in range(codes.shape[1]):
            count += np.bitwise_count(codes[None, :, w] & words[:, None, w])
        held += count * float(1 << plane)
    ones = np.bitwise_count(codes).sum(1, dtype=np.int64)[None, :]
    product = low * (2 * ones - turn.shape[0]) + step * (2 * held - steps.sum(1)[:, None])
    alignment, length, left = facts.T
    norm = np.sqrt((anchors * anchors).sum(1))[:, None]
    least = np.maximum(np.abs(product) - rounding, 0) / length
    across = np.sqrt(np.maximum(norm * norm - least * least, 0))
    known = np.isfinite(left)
    own = np.where(known, left, 0)
    size = np.hypot(own, alignment * length) * norm
    errors = alignment * rounding + own * across + 1e-9 * size + 1e-6
    return alignment * product, np.where(known & ~wide[:, None], errors, np.inf)


def _integers(column: pd.Series, dims: int) -> np.ndarray:
    """Integer vectors as doubles, or as Python's integers where doubles could not hold them exactly."""
    values = np.stack(column.to_numpy()).astype(np.float64) if len(column) and dims else np.zeros((len(column), dims))
    if np.abs(values).max(initial=0) <= WIDE:
        return values
    return np.array([[int(x) for x in v] for v in values.tolist()], dtype=object).reshape(len(values), dims)


def _products(points: np.ndarray, q: np.ndarray, most: float) -> np.ndarray:
    """Exact integer products, held at the ends of a long; no product is larger than ``most``."""
    if most < 2.0**53:
        return (points @ q).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(v, q)) for v in points]
    return np.array([max(-LAST, min(LAST, x)) for x in exact], np.int64)


def _doubles(points: np.ndarray) -> np.ndarray:
    return np.array([[max(-1e300, min(1e300, x)) for x in v] for v in points], np.float64).reshape(points.shape) if points.dtype == object else points


def _top(scores: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((names, -scores))[:k]


class _Block:
    """The rows of one block, and the anchors of one part that meet them."""

    def __init__(self, rows: pd.DataFrame, anchors: pd.DataFrame, dims: int, number: int, seed: int):
        self.names, self.labels = rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
        self.points, self.turn, self.anchors = _integers(rows["embedding"], dims), rotations(dims, number, seed), anchors
        words = -(-number * dims // 64)
        self.codes = np.frombuffer(b"".join(rows["code"]), np.uint64).reshape(len(rows), words)
        self.facts = rows[["alignment", "length", "residual"]].to_numpy(np.float64)
        self.asked = _integers(anchors["embedding"], dims)
        self.most = float(np.abs(self.points).max(initial=0)) * float(np.abs(self.asked).max(initial=0)) * max(dims, 1)

    def each(self):
        """Of every anchor its place in the part, its vector, and estimates and errors for the block."""
        doubles = _doubles(self.asked)
        for at in range(0, len(doubles), AT_ONCE):
            guess, errors = intervals(self.codes, self.facts, doubles[at : at + AT_ONCE], self.turn)
            for i in range(len(guess)):
                yield at + i, self.asked[at + i], guess[i], errors[i]


def _positives(block: _Block, k: int) -> Iterator[tuple]:
    names, labels = block.anchors["vec_id"].to_numpy(), block.anchors["label"].to_numpy()
    for i, q, guess, errors in block.each():
        use = np.flatnonzero((block.labels == labels[i]) & (block.names != names[i]))
        if len(use) > k:
            least = (guess - errors)[use]
            use = use[(guess + errors)[use] >= np.partition(least, len(least) - k)[len(least) - k]]
        scores = _products(block.points[use], q, block.most)
        for j in _top(scores, block.names[use], k):
            yield int(names[i]), int(block.names[use[j]]), int(scores[j])


def _negatives(block: _Block, k: int, low: int, high: int) -> Iterator[tuple]:
    names, labels = block.anchors["vec_id"].to_numpy(), block.anchors["label"].to_numpy()
    wanted = block.anchors["wanted"].to_numpy()
    for i, q, guess, errors in block.each():
        others, known = np.flatnonzero(block.labels != labels[i]), {}
        up, down = (guess + errors)[others], (guess - errors)[others]
        for w in wanted[i]:
            p = int(w["score"])
            first, last = -(-low * p // 100), high * p // 100
            use = np.flatnonzero((up >= first) & (down <= last)) if first <= last else []

            def scored(at):
                new = [a for a in at.tolist() if a not in known]
                known.update(zip(new, _products(block.points[others[new]], q, block.most).tolist()))
                return np.array([known[a] for a in at.tolist()], np.int64)

            if len(use) > SEEDS:
                likely = np.minimum(guess[others[use]], last)
                seeds = use[np.argpartition(-likely, SEEDS)[:SEEDS]]
                met = scored(seeds)
                met = np.sort(met[(met >= first) & (met <= last)])
                if len(met) >= k:
                    use = use[up[use] >= met[-k]]
            if not len(use):
                continue
            scores = scored(use)
            inside = (scores >= first) & (scores <= last)
            use, scores = use[inside], scores[inside]
            found = block.names[others[use]]
            for j in _top(scores, found, k):
                yield int(names[i]), int(w["id"]), int(found[j]), p, int(scores[j])


def _first(df: DataFrame, by: list[str], score: str, name: str, k: int) -> DataFrame:
    """The best k of each key, with their rank; tasks cut their own rows to k before the exchange."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(name))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, number: int = ROTATIONS,
         block_rows: int = ROWS_PER_BLOCK, part_anchors: int = ANCHORS_PER_PART, seed: int = 29) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    is_anchor is a condition on the column vec_id. Components become floor(scale * x), and scores are their exact inner
    products; of one score the smaller id comes first. An anchor's positives are its best other rows of the
    same label, all if there are fewer. For each, the best rows of another label are listed whose score is from
    ``low`` to ``high`` per cent of the positive's.

    Rows whose id, label or vector is null, or whose vector holds a null or non-finite part, take no part. Of rows
    with one id the least by label and vector counts, so repeated rows count once. Vectors meet those of as many
    parts only. An empty vector has score 0. Scores beyond a long are held at its end, components
    at 1e300. An empty table gives no rows.
    """
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("embedding"),
    )
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & good)
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("own")).select("vec_id", "own.*")

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, own in batch.groupby(batch["embedding"].map(len)):
                points = np.stack(own["embedding"].to_numpy()).astype(np.float64).reshape(len(own), int(dims))
                with np.errstate(over="ignore"):
                    points = np.clip(np.floor(scale * points), -1e300, 1e300)
                codes, facts = encode(points, rotations(int(dims), number, seed))
                yield pd.DataFrame(
                    {
                        "vec_id": own["vec_id"].to_numpy(), "label": own["label"].to_numpy(), "embedding": list(points),
                        "dims": int(dims), "code": [c.tobytes() for c in codes], "alignment": facts[:, 0],
                        "length": facts[:, 1], "residual": facts[:, 2],
                    }
                )

    schema = "vec_id long, label long, embedding array<double>, dims int, code binary, alignment double, length double, residual double"
    rows = stored(rows.mapInPandas(code, schema).withColumn("is_anchor", F.coalesce(is_anchor, F.lit(False))))
    total, asking = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).head()
    blocks, parts = max(1, -(-total // block_rows)), max(1, -(-asking // part_anchors))
    keys = ["dims", "part", "block"]
    data = rows.drop("is_anchor").withColumns(
        {"block": F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"), "part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))}
    )

    def dealt(anchors: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64(F.lit(1), F.col("vec_id")), F.lit(parts)).cast("int")
        own = anchors.withColumns({"part": part, "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
        return own.toDF(*own.columns)  # columns of its own, as the rows come from the same table

    def met(anchors: DataFrame, find, columns: str) -> DataFrame:
        names = [c.split()[0] for c in columns.split(", ")]

        def search(key, rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            found = find(_Block(rows, asked, int(key[0]), number, seed)) if len(rows) and len(asked) else []
            return pd.DataFrame(list(found), columns=names)

        return data.groupBy(*keys).cogroup(dealt(anchors).groupBy(*keys)).applyInPandas(search, columns)

    anchors = rows.where("is_anchor").select("vec_id", "label", "embedding", "dims")
    near = met(anchors, lambda b: _positives(b, positives), "anchor_id long, id long, score long")
    near = _first(near, ["anchor_id"], "score", "id", positives)
    wanted = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("id", "score"))).alias("wanted"))
    found = met(
        anchors.join(stored(wanted), "vec_id"), lambda b: _negatives(b, negatives, low, high),
        "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long",
    )
    best = _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
