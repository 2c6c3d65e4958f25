"""What several operators share: tables between stages, links to components, unit vectors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit.sources.storage import remove_scratch, scratch_folder

SPACES = "\\x20\\x09-\\x0D"
BROADCAST_ROWS = 500_000
"""Rows of a table that grows with the input which are sent to all executors, at most; joins with more of them sort."""


_noted: list[list[str]] = []


@contextmanager
def noting(folders: list[str]) -> Iterator[None]:
    """Lists the tables that are stored meanwhile, for ``discard`` once nothing reads them any more."""
    _noted.append(folders)
    try:
        yield
    finally:
        _noted.pop()


def discard(spark: SparkSession, folders: list[str]) -> None:
    while folders:
        remove_scratch(spark, folders.pop())


def stored(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the folder that all executors share; this also cuts the lineage."""
    folder = scratch_folder(df.sparkSession)
    for folders in _noted[-1:]:
        folders.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def by_rows(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A stored table as one side of a join that sorts if the table has more than BROADCAST_ROWS rows.

    Spark goes by the bytes of the files. Close ids and repeated values take a few bits there and some 50 bytes in the
    driver's heap, so less than the 10 MB that Spark broadcasts may be hundreds of MB. Fewer rows are left to Spark.
    """
    return df.hint("merge") if (df.count() if rows is None else rows) > BROADCAST_ROWS else df


def bound_batches(spark: SparkSession, rows: int = 1000, read: int = 256) -> None:
    """At most so many rows at once go to a Python worker or are read from Parquet in this session; smaller settings stay.

    A batch of whole texts stands in memory several times, on both sides, so Spark's 10000 rows are many. So are 4096
    rows read at once: their texts are one array of tens of MB for each task, which the heap grows for and seldom gives back.
    """
    for setting, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.parquet.columnarReaderBatchSize", read)):
        if not 0 < int(spark.conf.get(setting)) <= most:
            spark.conf.set(setting, str(most))


def small_table(spark: SparkSession, rows: list[tuple], schema: dict[str, pa.DataType]) -> DataFrame:
    """Rows of the driver as a table. They go as one Arrow table, so no Python worker is started to unpickle them."""
    columns = zip(*rows) if rows else [()] * len(schema)
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, schema.values())], list(schema)))


def sliced(texts: Iterable[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of at most so many characters together; a longer text stands alone."""
    begin, held, end = 0, 0, 0
    for end, text in enumerate(texts):
        if held and held + len(text) > most:
            yield begin, end
            begin, held = end, 0
        held += len(text)
        end += 1
    if end > begin:
        yield begin, end


def clean_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, embedding array<double>) of the vectors that are neither null nor zero and whose parts are finite."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("embedding"))

    def good(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return rows.where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", good)
        & F.exists("embedding", lambda x: x != 0)
    )


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 0))


def components(links: DataFrame) -> DataFrame:
    """(id, component): of every id in the links (a, b), the smallest id it reaches.

    Each round takes the smallest label among the neighbours and then the label of that label, so chains
    halve at least. Labels go through a stored table in every round; an id with very many links is
    pre-aggregated by the minimum, and its join is split by the engine's skew handling.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("component")))
    ids = labels.count()
    while True:
        labels = by_rows(labels, ids)
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        lowered = labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        jumped = stored(
            lowered.join(jump, "component").select("id", "old", F.least("component", "further").alias("component"))
        )
        labels = jumped.select("id", "component")
        if jumped.where("old <> component").isEmpty():
            return labels
