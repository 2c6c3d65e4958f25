"""Progress records: one row per finished layer, in an append-only table of the store."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame

from stratakit.sources.storage import create_text, path_exists
from stratakit.sources.tables import TableStore

CHECKPOINT_SCHEMA = """
    pipeline_id string, layer string, table_name string, version long, source_version long,
    timestamp timestamp, metadata string
"""


def checkpoint(
    pipeline_id: str,
    layer: str,
    version: int | None = None,
    metadata: dict[str, Any] | None = None,
    table_name: str | None = None,
    source_version: int | None = None,
) -> dict[str, Any]:
    return {
        "pipeline_id": pipeline_id,
        "layer": layer,
        "table_name": table_name,
        "version": version,
        "source_version": source_version,
        "timestamp": datetime.now(timezone.utc).isoformat(timespec="milliseconds"),
        "metadata": metadata or {},
    }


def save_checkpoints(store: TableStore, records: Sequence[dict[str, Any]]) -> None:
    if records:
        lines = [{**record, "metadata": json.dumps(record["metadata"])} for record in records]
        text = "".join(json.dumps(line) + "\n" for line in lines)
        create_text(store.spark, f"{_folder(store)}/{uuid.uuid4().hex}.json", text)


def read_checkpoints(store: TableStore, pipeline_id: str | None = None) -> DataFrame:
    """All stored records, or those of one run; ``metadata`` is JSON text."""
    if not path_exists(store.spark, _folder(store)):
        return store.spark.createDataFrame([], CHECKPOINT_SCHEMA)
    records = store.spark.read.schema(CHECKPOINT_SCHEMA).json(_folder(store))
    return records if pipeline_id is None else records.where(records.pipeline_id == pipeline_id)


def lineage(store: TableStore, pipeline_id: str | None = None) -> DataFrame:
    """Which version of its source each layer's version was made from."""
    return read_checkpoints(store, pipeline_id).select("layer", "table_name", "version", "source_version")


def _folder(store: TableStore) -> str:
    return f"{store.root}/checkpoints"
