"""A full batch run: bronze, silver and gold, each stored and then optimised."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stratakit.operators.layout import TARGET_FILE_BYTES, clustered_writer, optimize_table
from stratakit.operators.quality import Rules
from stratakit.plans.layers import Writer, run_bronze, run_gold, run_silver
from stratakit.sources.tables import TableStore, Transform

logger = logging.getLogger("stratakit")


def new_pipeline_id(name: str) -> str:
    return f"{name}_{datetime.now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


@contextmanager
def _stage(metrics: dict[str, Any], name: str):
    """Times a stage and records how it ended."""
    entry: dict[str, Any] = {}
    metrics["stages"][name] = entry
    started = time.time()
    try:
        yield entry
    except Exception:
        entry["status"] = "failed"
        raise
    else:
        entry["status"] = "success"
    finally:
        entry["duration_seconds"] = time.time() - started


def run_pipeline(
    store: TableStore,
    source_format: str,
    source_path: str | list[str],
    bronze_schema: StructType | str,
    bronze_table: str,
    silver_table: str,
    gold_table: str | None = None,
    bronze_transform: Transform | None = None,
    silver_transform: Transform | None = None,
    gold_transform: Callable[[DataFrame], Mapping[str, DataFrame]] | None = None,
    bronze_writer: Writer | None = None,
    silver_writer: Writer | None = None,
    gold_writer: Writer | None = None,
    bronze_validation_rules: Rules = None,
    silver_validation_rules: Rules = None,
    gold_validation_rules: Rules | Mapping[str, Rules] = None,
    pipeline_name: str = "pipeline",
    silver_zorder_columns: Sequence[str] | None = None,
    sample_ratio: float | None = None,
    limit_sample_size: int | None = None,
    source_options: dict[str, str] | None = None,
    target_file_bytes: int = TARGET_FILE_BYTES,
    raise_on_error: bool = False,
    incremental: bool = False,
    silver_keys: Sequence[str] | None = None,
    cluster_in_write: bool = False,
) -> dict[str, Any]:
    """Run all layers in write mode and return a result dict with the metrics of each stage.

    Each layer reads the version its predecessor has after optimisation. An error ends the run with
    ``status: failed``, unless it is to be raised. The session stays open.

    With ``cluster_in_write`` silver is clustered by its columns while it is written, in place of being written
    twice, and its optimisation finds nothing left to do. An ``incremental`` run makes silver from the bronze rows that it does not hold yet, appended or, with
    ``silver_keys``, merged by these, and makes gold anew only if silver has changed.
    """
    pipeline_id = new_pipeline_id(pipeline_name)
    started = time.time()
    metrics: dict[str, Any] = {
        "pipeline_id": pipeline_id,
        "start_time": datetime.now().isoformat(),
        "stages": {},
        "status": "running",
    }
    sampling = {"sample_ratio": sample_ratio, "limit_sample_size": limit_sample_size}
    versions: dict[str, Any] = {}
    error: Exception | None = None
    try:
        if gold_table and gold_transform is None:
            raise ValueError("gold tables need a transform that returns a dict of DataFrames")
        with _stage(metrics, "bronze") as stage:
            bronze = run_bronze(
                store, source_format, source_path, bronze_schema, bronze_table, bronze_transform,
                bronze_validation_rules, pipeline_id, "write", bronze_writer,
                options=source_options, **sampling,
            )
            stage["version"] = bronze.version
        with _stage(metrics, "bronze_optimize") as stage:
            optimized = optimize_table(store, bronze_table, None, target_file_bytes)
            stage.update(optimized, layer="bronze")
        versions["bronze_version"] = optimized["version"]

        with _stage(metrics, "silver") as stage:
            if cluster_in_write and (silver_writer or incremental or silver_keys or not silver_zorder_columns):
                raise ValueError("clustering in the write needs columns to cluster by and makes the whole silver table")
            marks = {bronze_table: versions["bronze_version"]}
            silver = run_silver(
                store, bronze_table, versions["bronze_version"], silver_table, silver_transform,
                silver_validation_rules, pipeline_id, "write",
                clustered_writer(store, silver_zorder_columns, target_file_bytes, marks) if cluster_in_write else silver_writer,
                incremental=incremental, merge_keys=silver_keys, **sampling,
            )
            stage.update(version=silver.version, source_bronze_version=silver.source_version)
        with _stage(metrics, "silver_optimize") as stage:
            optimized = optimize_table(store, silver_table, silver_zorder_columns, target_file_bytes)
            stage.update(optimized, layer="silver")
        versions["silver_version"] = optimized["version"]

        if gold_table:
            with _stage(metrics, "gold") as stage:
                gold = run_gold(
                    store, silver_table, versions["silver_version"], gold_table, gold_transform,
                    gold_validation_rules, pipeline_id, "write", gold_writer, skip_unchanged=incremental, **sampling,
                )
                stage.update(source_silver_version=versions["silver_version"], tables=list(gold))
            with _stage(metrics, "gold_optimize") as stage:
                reports = [
                    optimize_table(store, result.table, None, target_file_bytes)
                    for result in gold.values()
                ]
                stage.update(layer="gold", tables=reports)
            versions["gold_versions"] = {r["table"]: r["version"] for r in reports}
    except Exception as failure:
        logger.error("pipeline %s failed: %s", pipeline_id, failure)
        error = failure
        metrics["error"] = str(failure)

    status = "failed" if error else "success"
    duration = time.time() - started
    metrics.update(
        status=status, end_time=datetime.now().isoformat(), total_duration_seconds=duration
    )
    if error and raise_on_error:
        raise error
    outcome = {"error": str(error)} if error else {}
    return {
        "status": status,
        "pipeline_id": pipeline_id,
        **versions,
        **outcome,
        "timestamp": metrics["end_time"],
        "duration_seconds": duration,
        "metrics": metrics,
    }


def stage_metrics(spark: SparkSession, result: Mapping[str, Any]) -> DataFrame:
    """The stages of a run as rows, in the order they ran."""
    rows = [
        (
            result["pipeline_id"],
            position,
            name,
            entry["status"],
            entry.get("version"),
            float(entry["duration_seconds"]),
        )
        for position, (name, entry) in enumerate(result["metrics"]["stages"].items())
    ]
    return spark.createDataFrame(
        rows,
        "pipeline_id string, position int, stage string, status string, version long,"
        " duration_seconds double",
    )
