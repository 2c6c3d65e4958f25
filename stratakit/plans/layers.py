"""Bronze, silver and gold: read a source, transform and write it, check what was stored.

Each layer runs in one of two modes. ``write`` calls the writer and checks the rows it stored, not
those of earlier runs, so an append is checked at the cost of its own size.
``test`` stores nothing: it checks the transformed frame, whose ``version`` is None. A dry run can
hand its frame to the next layer as ``source``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from stratakit.operators.quality import Rules, inspect
from stratakit.plans.checkpoints import checkpoint, save_checkpoints
from stratakit.sources.files import ingest
from stratakit.sources.tables import MISSING, TableStore, Transform, append_writer, overwrite_writer

MODES = ("test", "write")
Writer = Callable[..., Any]


@dataclass(frozen=True)
class LayerResult:
    """The stored frame of a layer (the transformed one in a dry run), and what is known about it."""

    layer: str
    table: str | None
    df: DataFrame
    version: int | None
    source_version: int | None = None
    write_metrics: list[dict[str, str]] = field(default_factory=list)
    quality: dict[str, Any] | None = None
    validation: dict[str, Any] | None = None
    checkpoint: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Checks:
    """How a layer is checked: all rows it stored, or a sample if a ratio is given. Without rules there are no checks."""

    rules: Rules = None
    sample_ratio: float | None = None
    limit_sample_size: int | None = None

    def run(self, df: DataFrame, layer: str, row_count: int | None):
        if not self.rules:
            return None, None
        return inspect(df, layer, self.rules, self.sample_ratio, self.limit_sample_size, row_count)


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def _publish(
    store: TableStore,
    layer: str,
    table: str | None,
    mode: str,
    write: Callable[[], Any],
    preview: Callable[[], DataFrame],
    checks: Checks,
    pipeline_id: str,
    source_version: int | None,
    metadata: dict[str, Any],
    check_name: str | None = None,
    recheck: bool = True,
) -> LayerResult:
    """The part all layers share: write or preview, check, and make the checkpoint record."""
    started = time.time()
    if mode == "write":
        before = store.current(table)
        write()
        metrics = store.metrics_since(table, before.version)
        after = store.snapshot(table)
        df, version = store.read_snapshot(after), after.version
        # A writer that stored nothing leaves nothing new to check; then the table is checked.
        fresh = [f for f in after.folders if f not in before.folders] or after.folders
        checked, row_count = store.read_snapshot(after, fresh), sum(f.rows for f in fresh)
        if after.version == before.version and not recheck:
            checks = Checks()
    else:
        df = checked = preview()
        version, row_count, metrics = None, None, []
    quality, validation = checks.run(checked, check_name or layer, row_count)
    record = checkpoint(
        pipeline_id,
        layer,
        version,
        {
            **metadata,
            "write_metrics": metrics,
            "quality_metrics": quality,
            "validation_results": validation,
            "duration_seconds": time.time() - started,
        },
        table,
        source_version,
    )
    return LayerResult(layer, table, df, version, source_version, metrics, quality, validation, record)


def _apply(df: DataFrame, transform: Transform | None) -> DataFrame:
    return df.transform(transform) if transform else df


def run_bronze(
    store: TableStore,
    source_format: str,
    source_path: str | list[str],
    schema: StructType | str,
    bronze_table: str | None = None,
    bronze_transform: Transform | None = None,
    validation_rules: Rules = None,
    pipeline_id: str = "test",
    mode: str = "test",
    bronze_writer: Writer | None = None,
    sample_ratio: float | None = None,
    limit_sample_size: int | None = None,
    options: dict[str, str] | None = None,
) -> LayerResult:
    """Ingest files with provenance columns. The default writer appends."""
    _check_mode(mode)
    raw = ingest(store.spark, source_format, source_path, schema, pipeline_id, options)
    writer = bronze_writer or append_writer(store)
    result = _publish(
        store,
        "bronze",
        bronze_table,
        mode,
        lambda: writer(raw, bronze_table, bronze_transform),
        lambda: _apply(raw, bronze_transform),
        Checks(validation_rules, sample_ratio, limit_sample_size),
        pipeline_id,
        None,
        {"source_path": source_path},
    )
    if mode == "write":
        save_checkpoints(store, [result.checkpoint])
    return result


def _source(
    store: TableStore, table: str | None, version: int | None, source: DataFrame | None
) -> tuple[DataFrame, int | None]:
    """The pinned input of a layer: its version is fixed before anything is read."""
    if source is not None:
        return source, version
    snapshot = store.snapshot(table, version)
    return store.read_snapshot(snapshot), snapshot.version


def _increment(
    store: TableStore, source: str, version: int | None, table: str, transform: Transform | None, keys: Sequence[str] | None
) -> tuple[DataFrame, int, Callable[[], Any], bool]:
    """What is new in the source for a table, the source's version, how to write it, and whether there is nothing to do."""
    until = store.snapshot(source, version).version
    since = store.consumed(table, source) if store.exists(table) else MISSING
    if since > until:
        raise ValueError(f"table {table} holds {source} up to version {since} already")
    changes = store.changes(source, since, until)
    rows, marks = store.read_changes(changes), {source: until}
    if since != MISSING and not changes.replaced and not changes.rows:
        return rows, until, lambda: None, True
    made = _apply(rows, transform)
    if changes.replaced or (since == MISSING and not keys):
        return rows, until, lambda: store.overwrite(made, table, consumed=marks), False
    if keys:
        return rows, until, lambda: store.merge(made, table, keys, consumed=marks), False
    return rows, until, lambda: store.append(made, table, consumed=marks), False


def run_silver(
    store: TableStore,
    bronze_table: str | None,
    bronze_version: int | None = None,
    silver_table: str | None = None,
    silver_transform: Transform | None = None,
    validation_rules: Rules = None,
    pipeline_id: str = "test",
    mode: str = "test",
    silver_writer: Writer | None = None,
    sample_ratio: float | None = None,
    limit_sample_size: int | None = None,
    source: DataFrame | None = None,
    incremental: bool = False,
    merge_keys: Sequence[str] | None = None,
) -> LayerResult:
    """Cleanse a version of the bronze table (the latest if none is named).

    It gets the whole bronze version, so the default writer replaces the silver table.

    An ``incremental`` run reads only the bronze rows that came since the version silver was last made from, which
    is kept with the silver table, and appends them; with ``merge_keys`` they take the place of the silver rows
    with the same keys. The transform must then give for some rows what it gives for them among all. If bronze rows
    were replaced meanwhile, silver is made anew. Without new rows nothing is written.
    """
    _check_mode(mode)
    idle = False
    if incremental or merge_keys:
        if silver_writer or source is not None:
            raise ValueError("an incremental run reads a bronze table and writes by itself")
        bronze, bronze_version, write, idle = _increment(
            store, bronze_table, bronze_version, silver_table, silver_transform, merge_keys
        )
    else:
        bronze, bronze_version = _source(store, bronze_table, bronze_version, source)
        if silver_writer is None and source is None and mode == "write":
            marks = {bronze_table: bronze_version}
            write = lambda: store.overwrite(_apply(bronze, silver_transform), silver_table, consumed=marks)
        else:
            writer = silver_writer or overwrite_writer(store)
            write = lambda: writer(bronze, silver_table, silver_transform)
    result = _publish(
        store,
        "silver",
        silver_table,
        mode,
        write,
        lambda: _apply(bronze, silver_transform),
        Checks(validation_rules, sample_ratio, limit_sample_size),
        pipeline_id,
        bronze_version,
        {"source_bronze_version": bronze_version},
        recheck=not idle,
    )
    if mode == "write":
        save_checkpoints(store, [result.checkpoint])
    return result


def run_gold(
    store: TableStore,
    silver_table: str | None,
    silver_version: int | None = None,
    gold_table: str | None = None,
    gold_transform: Callable[[DataFrame], Mapping[str, DataFrame]] | None = None,
    validation_rules: Rules | Mapping[str, Rules] = None,
    pipeline_id: str = "test",
    mode: str = "test",
    gold_writer: Writer | None = None,
    sample_ratio: float | None = None,
    limit_sample_size: int | None = None,
    source: DataFrame | None = None,
    parallel_tables: int = 4,
    skip_unchanged: bool = False,
) -> dict[str, LayerResult]:
    """Fan a version of the silver table out into several tables named ``<gold_table>_<name>``.

    The tables are independent jobs and a few of them run at a time. Silver is not cached: each
    table scans only the columns it needs. ``validation_rules`` is one list for all tables, or a
    dict of lists by table name. If a table fails, those already stored keep their checkpoints. With
    ``skip_unchanged`` a table stays as it is if silver has got no rows since the version it was made from.
    """
    _check_mode(mode)
    if gold_transform is None:
        raise ValueError("the gold layer needs a transform that returns a dict of DataFrames")
    if mode == "write" and not gold_table:
        raise ValueError("the gold layer needs a name for its tables to write them")
    silver, silver_version = _source(store, silver_table, silver_version, source)
    writer = gold_writer or overwrite_writer(store)
    frames = dict(gold_transform(silver))
    pinned = source is None and gold_writer is None

    def unchanged(table: str) -> bool:
        if not (skip_unchanged and pinned and mode == "write" and store.exists(table)):
            return False
        made_from = store.consumed(table, silver_table)
        if not MISSING < made_from <= silver_version:
            return False
        changes = store.changes(silver_table, made_from, silver_version)
        return not changes.replaced and not changes.rows

    def build(name: str) -> LayerResult:
        table = f"{gold_table}_{name}"
        idle = unchanged(table)

        def write():
            if pinned:
                return None if idle else store.overwrite(frames[name], table, consumed={silver_table: silver_version})
            return writer(frames[name], table)

        by_table = isinstance(validation_rules, Mapping)
        rules = validation_rules.get(name) if by_table else validation_rules
        return _publish(
            store,
            f"gold_{name}",
            table,
            mode,
            write,
            lambda: frames[name],
            Checks(rules, sample_ratio, limit_sample_size),
            pipeline_id,
            silver_version,
            {"source_silver_version": silver_version},
            check_name=table,
            recheck=not idle,
        )

    results: dict[str, LayerResult] = {}
    failures: list[Exception] = []
    with ThreadPoolExecutor(max_workers=max(1, parallel_tables)) as pool:
        jobs = {
            name: pool.submit(inheritable_thread_target(store.spark)(build), name) for name in frames
        }
        for name, job in jobs.items():
            try:
                results[name] = job.result()
            except Exception as error:
                failures.append(error)
    if mode == "write":
        save_checkpoints(store, [result.checkpoint for result in results.values()])
    if failures:
        raise failures[0]
    return results
