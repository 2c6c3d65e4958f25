"""File scans with a fixed schema, and the columns that say where each row came from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratakit.sources.tables import TableStore

CORRUPT, MALFORMED = "_corrupt_record", "is_malformed"
PROVENANCE_COLUMNS = ("ingestion_timestamp", "source_file", "batch_id")


def read_files(
    spark: SparkSession,
    source_format: str,
    source_path: str | list[str],
    schema: StructType | str,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Scan one path or a list of paths. The schema is given, so there is no inference pass."""
    reader = spark.read.format(source_format).schema(schema)
    if source_format.lower() == "csv":
        reader = reader.option("header", "true")
    return reader.options(**(options or {})).load(source_path)


def stamp_provenance(df: DataFrame, batch_id: str) -> DataFrame:
    """Add load time, source file and batch id to a file scan.

    The file name comes from the scan's metadata column. Unlike ``input_file_name()`` it is
    deterministic, so filters of later transforms still move below it and reach the scan.
    """
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_file": df.metadataColumn("_metadata").getField("file_path"),
            "batch_id": F.lit(batch_id),
        }
    )


def ingest(
    spark: SparkSession,
    source_format: str,
    source_path: str | list[str],
    schema: StructType | str,
    batch_id: str,
    options: dict[str, str] | None = None,
) -> DataFrame:
    return stamp_provenance(read_files(spark, source_format, source_path, schema, options), batch_id)


@dataclass(frozen=True)
class Ingested:
    """What an ingest that splits off malformed rows has stored, and how many rows of each kind."""

    version: int
    good_rows: int
    malformed_rows: int
    store: TableStore
    table: str

    def good(self) -> DataFrame:
        return self.store.read(self.table, self.version).where(F.col(CORRUPT).isNull()).drop(CORRUPT, MALFORMED)

    def malformed(self) -> DataFrame:
        """The malformed rows as they stand in their files, with their provenance; good rows are not scanned."""
        rows = self.store.read(self.table, self.version).where(F.col(MALFORMED))
        return rows.select(F.col(CORRUPT).alias("record"), *PROVENANCE_COLUMNS)

    def malformed_by_file(self) -> DataFrame:
        return self.malformed().groupBy("source_file").agg(F.count(F.lit(1)).alias("malformed_rows"))


def ingest_split(
    store: TableStore,
    table: str,
    source_format: str,
    source_path: str | list[str],
    schema: StructType | str,
    batch_id: str,
    options: dict[str, str] | None = None,
) -> Ingested:
    """Append a CSV or JSON scan to a table, with the rows that don't fit the schema in a partition of their own.

    One job reads, stamps, splits, counts and writes; the counts are observed in it. A malformed row keeps its text
    and its provenance, and whatever else of it could be read. All columns are parsed, since only that tells.
    """
    if source_format.lower() not in ("csv", "json"):
        raise ValueError(f"rows of {source_format} files can't be malformed one by one")
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if taken := {CORRUPT, MALFORMED} & {f.name.lower() for f in fields.fields}:
        raise ValueError(f"the schema has a column {sorted(taken)} already")
    wider = StructType([*fields.fields, StructField(CORRUPT, StringType())])
    own = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = ingest(store.spark, source_format, source_path, wider, batch_id, {**(options or {}), **own})
    bad, seen = F.col(CORRUPT).isNotNull(), Observation()
    rows = rows.withColumn(MALFORMED, bad).observe(
        seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("malformed")
    )
    version = store.append(rows, table, partition_by=[MALFORMED])
    return Ingested(version, seen.get["good"], seen.get["malformed"], store, table)
