"""Layered batch pipelines on plain Parquet: ingest, versioned tables, checks, layout, full runs."""

from stratakit.operators.layout import (
    clustered_writer, compact, optimize_report, optimize_table, write_clustered, zorder, zorder_incremental,
)
from stratakit.operators.membership import mark_members
from stratakit.operators.quality import (
    approx_shape,
    failing_rows,
    high_null_columns,
    inspect,
    null_profile,
    quality_metrics,
    rule_report,
    rules_all_passed,
    schema_profile,
    stored_null_profile,
    table_shape,
    validation_report,
)
from stratakit.operators.quarantine import broken_rows, clean_rows, quarantine, quarantine_writer, tag_rows
from stratakit.operators.sampling import sample_bernoulli, sample_capped, sample_keyed, sample_reservoir
from stratakit.plans.checkpoints import checkpoint, lineage, read_checkpoints, save_checkpoints
from stratakit.plans.layers import LayerResult, run_bronze, run_gold, run_silver
from stratakit.plans.pipeline import new_pipeline_id, run_pipeline, stage_metrics
from stratakit.sources.files import ingest, ingest_split, read_files, stamp_provenance
from stratakit.sources.storage import scratch_folder
from stratakit.sources.tables import TableStore, append_writer, overwrite_writer

__all__ = [
    "LayerResult",
    "TableStore",
    "append_writer",
    "approx_shape",
    "broken_rows",
    "checkpoint",
    "clean_rows",
    "clustered_writer",
    "compact",
    "failing_rows",
    "high_null_columns",
    "ingest",
    "ingest_split",
    "inspect",
    "lineage",
    "mark_members",
    "new_pipeline_id",
    "null_profile",
    "optimize_report",
    "optimize_table",
    "overwrite_writer",
    "quality_metrics",
    "quarantine",
    "quarantine_writer",
    "read_checkpoints",
    "read_files",
    "rule_report",
    "rules_all_passed",
    "run_bronze",
    "run_gold",
    "run_pipeline",
    "run_silver",
    "sample_bernoulli",
    "sample_capped",
    "sample_keyed",
    "sample_reservoir",
    "save_checkpoints",
    "schema_profile",
    "scratch_folder",
    "stage_metrics",
    "stamp_provenance",
    "stored_null_profile",
    "table_shape",
    "tag_rows",
    "validation_report",
    "write_clustered",
    "zorder",
    "zorder_incremental",
]
