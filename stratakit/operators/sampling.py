"""Samples for data checks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from stratakit.functions.rules import quoted

SAMPLE_RATIO = 0.05
SAMPLE_LIMIT = 1000
SAMPLE_SEED = 42
HASH_SPACE = 1 << 60
MERGING_TASKS = 16
"""So many tasks merge what all others have drawn."""


def sample_bernoulli(df: DataFrame, ratio: float = SAMPLE_RATIO, seed: int = SAMPLE_SEED) -> DataFrame:
    """Each row with the same chance, without replacement. Which rows, depends on the partitioning."""
    return df.sample(withReplacement=False, fraction=ratio, seed=seed)


def sample_capped(
    df: DataFrame, ratio: float = SAMPLE_RATIO, limit: int = SAMPLE_LIMIT, seed: int = SAMPLE_SEED
) -> DataFrame:
    """The first rows of a Bernoulli sample. Cheap, but biased towards the first partitions."""
    return sample_bernoulli(df, ratio, seed).limit(limit)


def key_digest(df: DataFrame, keys: Sequence[str]) -> Column:
    """MD5 of a row's keys, each with its length or a mark for NULL, so that no two keys look alike.

    A row whose keys are all NULL is told apart by its other integers and texts.
    """

    def marked(name: str) -> Column:
        text = quoted(name).cast("string")
        return F.when(text.isNull(), F.lit("N")).otherwise(F.concat(F.lit("V"), F.char_length(text), F.lit(":"), text))

    others = [
        f.name for f in df.schema.fields if f.name not in keys and isinstance(f.dataType, (IntegralType, StringType))
    ]
    own = F.concat(*[marked(k) for k in keys])
    none = F.coalesce(*[quoted(k).cast("string") for k in keys]).isNull()
    return F.md5(F.when(none, F.concat(own, *[marked(k) for k in others])).otherwise(own))


def sample_keyed(
    df: DataFrame, keys: Sequence[str], ratio: float = SAMPLE_RATIO, limit: int | None = None
) -> DataFrame:
    """The rows whose key has a low hash: 60 bits of it are compared with the ratio.

    The sample is a plain filter: the same rows under any partitioning, and no shuffle. With a limit
    it keeps the rows with the lowest hashes, which is an unbiased choice of keys. Rows without any key
    are drawn one by one.
    """
    digest = key_digest(df, keys)
    place = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    sample = df.where(place < round(ratio * HASH_SPACE))
    if limit is None:
        return sample
    return sample.orderBy(digest, *[quoted(k) for k in keys]).limit(limit)


def sample_reservoir(df: DataFrame, keys: Sequence[str], limit: int = SAMPLE_LIMIT) -> DataFrame:
    """``limit`` rows drawn fairly from all rows in one pass: those whose keys have the lowest hashes.

    Every task keeps its lowest ``limit`` rows as it goes through its batches; these meet in a few tasks, which do the
    same, and what is left of those is ordered. No task sorts its rows or holds more than ``limit`` and a batch, and
    the same rows are drawn under any partitioning. Of equal hashes the lower keys come first.
    """
    names = [f"__key{i}" for i in range(len(keys))]
    own = [F.coalesce(quoted(k).cast("string"), F.lit("")).alias(name) for k, name in zip(keys, names)]
    keyed = df.select("*", key_digest(df, keys).alias("__digest"), *own)
    order = [(c, "ascending") for c in ("__digest", *names)]

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows > 2 * limit:
                held = held.take(pc.select_k_unstable(held, limit, order)).combine_chunks()
        if held is not None and held.num_rows > limit:
            held = held.take(pc.select_k_unstable(held, limit, order))
        yield from held.to_batches() if held is not None else ()

    drawn = keyed.mapInArrow(lowest, keyed.schema).repartition(MERGING_TASKS, "__digest").mapInArrow(lowest, keyed.schema)
    return drawn.orderBy("__digest", *names).limit(limit).drop("__digest", *names)
