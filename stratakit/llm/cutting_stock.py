"""Packing token sequences by cutting-stock column generation.

A document is cut into full sequences and a remainder. Remainders are counted by length class; a linear program
over patterns, which say how many pieces of each class share a sequence, is solved by column generation, with a
knapsack by dynamic programming that prices new patterns. Whole numbers of each pattern are taken, what is left
is put into a few further patterns, and pieces find their sequence by their rank in their class.
The driver holds the histogram and the patterns; their size depends on the sequence length only. Ranks, sequences and
offsets are found on rows without ids; these are brought in at the end, by one exchange.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratakit.llm.common import bound_batches, by_rows, small_table, stored
from stratakit.llm.tokens import END, default_path, tokenizer

LENGTH, WIDTH = 2048, 8
RANKED_TOGETHER = 50_000
BYTES_AT_ONCE = 1 << 20
"""Of ids that a task hands over together; they stand in memory several times, on both sides."""


# ---- the linear program --------------------------------------------------------------------------


def best_pattern(values: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack with repetition: how many pieces of each class (of sizes 1, 2, ...) are worth most."""
    worth, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    # Read from its end, it begins with the worth of the room that a piece of the first class leaves.
    left = np.zeros(capacity + 1)
    priced = np.where(values > 1e-12, values, -np.inf)
    for room in range(1, capacity + 1):
        options = left[capacity + 1 - room :] + priced[:room]
        c = int(options.argmax())
        if options[c] > worth[room - 1] + 1e-12:
            worth[room], last[room] = options[c], c
        else:
            worth[room] = worth[room - 1]
        left[capacity - room] = worth[room]
    pattern, room = np.zeros(len(values), np.int64), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            pattern[last[room]] += 1
            room -= last[room] + 1
    return pattern


def _first_patterns(demand: np.ndarray, capacity: int) -> np.ndarray:
    """A column for each class, the largest class first: as many of it as fit, the room left filled by size.

    Classes in falling order give a triangular basis. Where its solution is not feasible, single classes are used.
    """
    asked = np.flatnonzero(demand)[::-1]
    basis, left = np.zeros((len(demand), len(asked))), demand.astype(np.float64).copy()
    for i, c in enumerate(asked):
        own = capacity // (c + 1)
        basis[c, i] = own
        room, times = capacity - own * (c + 1), max(left[c], 0) / own
        for d in asked[i + 1 :]:
            if room <= d or left[d] <= 0 or not times:
                continue
            fit = min(room // (d + 1), int(left[d] / times))
            basis[d, i] = fit
            room -= fit * (d + 1)
            left[d] -= fit * times
        left[c] = 0
    return basis


def solve(demand: np.ndarray, capacity: int, gap: float = 1e-9) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used, to cover the demand of each class with few sequences.

    Revised simplex: a pattern whose value at the present prices exceeds one by the gap enters until there is
    none: no solution is better by more than that share. It also ends where a lower bound, rounded up, equals the
    sequences now, rounded up, as no whole number of sequences below can do. Bounds are all pieces laid end to end, and in
    each round the sequences at the present prices by the best pattern's value. The demand is perturbed by less than a thousandth of a
    piece, differently for each class, so that no step is degenerate and the method can't cycle; the basis found is
    then used for the demand itself. The inverse is made anew at times, against rounding errors.
    """
    asked = np.flatnonzero(demand)
    if not len(asked):
        return []
    basis = _first_patterns(demand, capacity)[asked][:, ::-1].copy()
    shifted = demand[asked] + np.random.default_rng(5).uniform(1e-4, 1e-3, len(asked))
    inverse = np.linalg.inv(basis)
    used = inverse @ shifted
    if used.min() < 0:
        basis = np.diag(np.floor(capacity / (asked + 1.0)))
        inverse = np.linalg.inv(basis)
        used = inverse @ shifted
    entered, bound = 0, demand @ np.arange(1, len(demand) + 1) / capacity
    while True:
        prices = inverse.sum(0)
        values = np.zeros(len(demand))
        values[asked] = prices
        column = best_pattern(values, capacity)[asked]
        worth, sequences = column @ prices, demand[asked] @ prices
        bound = max(bound, sequences / worth)
        if worth <= 1 + gap or np.ceil(bound - 1e-6) >= np.ceil(sequences - 1e-6):
            break
        change = inverse @ column
        steps = np.where(change > 1e-9, used / np.where(change > 1e-9, change, 1), np.inf)
        out = int(steps.argmin())
        step = steps[out]
        used = np.maximum(used - step * change, 0)
        used[out] = step
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
        basis[:, out] = column
        entered += 1
        if entered % 200 == 0:
            inverse = np.linalg.inv(basis)
            used = np.maximum(inverse @ shifted, 0)
    used = np.maximum(np.linalg.solve(basis, demand[asked].astype(np.float64)), 0)
    patterns = []
    for i in range(len(asked)):
        pattern = np.zeros(len(demand), np.int64)
        pattern[asked] = np.round(basis[:, i]).astype(np.int64)
        patterns.append((pattern, float(used[i])))
    return patterns


def whole_patterns(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole counts that use up the demand exactly: the program's, rounded down, and the rest by size."""
    left, taken = demand.astype(np.int64).copy(), []
    for pattern, times in sorted(solve(demand, capacity), key=lambda x: -x[1]):
        times = int(min(np.floor(times + 1e-6), (left[pattern > 0] // pattern[pattern > 0]).min()))
        if times > 0:
            taken.append((pattern, times))
            left -= times * pattern
    while left.any():
        pattern, room = np.zeros(len(demand), np.int64), capacity
        for c in range(min(len(demand), capacity) - 1, -1, -1):
            n = min(left[c], room // (c + 1))
            pattern[c], room = n, room - n * (c + 1)
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        taken.append((pattern, times))
        left -= times * pattern
    return taken


# ---- pieces --------------------------------------------------------------------------------------


def token_pieces(df: DataFrame, id_col: str, text_col: str, path: str, length: int, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, ids): every document cut at multiples of length."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = tokenizer(path)
        for batch in batches:
            rows, held = [], 0
            found = words.encode_all([text or "" for text in batch["text"]])
            for doc, missing, own in zip(batch["doc_id"], batch["doc_id"].isna(), found):
                ids = own + END
                for at in range(0, len(ids), 4 * length):
                    piece = ids[at : at + 4 * length]
                    rows.append((None if missing else int(doc), at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece if with_ids else None))
                held += len(ids)
                if held > BYTES_AT_ONCE:
                    yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
        words.forget()

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
    bound_batches(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInPandas(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         length: int = LENGTH, width: int = WIDTH, with_ids: bool = True) -> DataFrame:
    """Every piece with its sequence_id and its offset there; ``ids`` are little-endian 32-bit.

    A document is its ids and id 1; a null or empty text is that id alone. Pieces of one sequence lie side by side
    from offset 0. Full pieces have a sequence of their own. Lengths are rounded up to classes of the given
    width for the program only. Rows with equal ids are packed like others.
    """
    pieces = token_pieces(df, id_col, text_col, path or default_path(), length, with_ids)
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    size = F.ceil(F.col("length") / width).cast("int")
    # Each piece has a number, which stays once the pieces are stored; the ids are not touched until the end.
    whole = stored(pieces.withColumn("piece", F.monotonically_increasing_id()).select(*kept, "piece", *["ids"] * with_ids))
    pieces = whole.select(*kept, "piece").withColumns({"class": F.when(F.col("length") < length, size).otherwise(0)}).withColumn(
        "share", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(1 << 20))
    )
    capacity = length // width
    demand = np.zeros(capacity, np.int64)
    total = {r[0]: r[1] for r in pieces.groupBy("class").count().collect()}
    for c, n in total.items():
        if c:
            demand[c - 1] = n

    # Ranges of ranks in each class: (class, low, high, pieces in a sequence, first sequence, first slot).
    table, sequence = [], total.get(0, 0)
    if sequence:
        table.append((0, 0, sequence, 1, 0, 0))
    at = np.zeros(capacity, np.int64)
    for pattern, times in whole_patterns(demand, capacity):
        slot = 0
        for c in np.flatnonzero(pattern):
            each, low = int(pattern[c]), int(at[c])
            table.append((int(c) + 1, low, low + each * times, each, sequence, slot))
            at[c] += each * times
            slot += each
        sequence += times
    schema = {"class": pa.int32(), "low": pa.int64(), "high": pa.int64(), "each": pa.int32(), "first": pa.int64(), "slot": pa.int32()}
    plan = F.broadcast(small_table(df.sparkSession, table, schema))

    # Ranks: within buckets of a hash, and the sizes of the buckets before.
    buckets = max(1, -(-sum(total.values()) // RANKED_TOGETHER))
    pieces = pieces.withColumn("bucket", F.col("share") % buckets)
    before = "sum(n) over (partition by class order by bucket) - n"
    counts = pieces.groupBy("class", "bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.expr(before))
    order = "row_number() over (partition by class, bucket order by share, doc_id, start, ids_crc32, piece)"
    ranked = pieces.withColumn("rank", F.expr(order)).join(counts.select("class", "bucket", "before"), ["class", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") - 1 + F.col("before"))
    placed = ranked.join(plan, "class").where("rank >= low and rank < high").withColumns(
        {
            "sequence_id": F.expr("first + (rank - low) div each"),
            "slot": F.expr("slot + (rank - low) % each"),
        }
    )
    offset = F.expr("sum(length) over (partition by sequence_id order by slot) - length")
    placed = placed.withColumn("offset", offset)
    if not with_ids:
        return placed.select(*kept, "sequence_id", "offset")
    found = by_rows(stored(placed.select("piece", "sequence_id", "offset")), sum(total.values()))
    return whole.join(found, "piece").select(*kept, "ids", "sequence_id", "offset")
