"""Table maintenance: merge small files, and cluster rows by several columns.

Compaction rewrites small files only and leaves large ones, and clustered folders, where they are. Clustering
rewrites the folders that are not clustered by the same columns yet, as one key range. Incremental clustering
makes what came a run of its own, and merges runs only where too many hold the same keys.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from stratakit.functions.rules import quoted
from stratakit.functions.schemas import holds_map
from stratakit.sources.tables import WRITE_COLUMN, Folder, Snapshot, TableStore, Transform

TARGET_FILE_BYTES = 256 * 1024**2
# Rows that one task sorts for a file, at most on average, however small they are stored.
FILE_ROWS = 2_000_000
# A file is small if it has less than this part of the target.
SMALL_FILE_SHARE = 0.25
# Rows that reach the driver to find the range edges of a clustering: so many for each file, and at least.
SAMPLE_ROWS_PER_FILE, SAMPLE_ROWS = 50, 50_000
# Rows of each partition that stand for all of it where the size of a frame is not known.
SKETCH_ROWS = 200
# Cells for each file, at least, as far as the columns have different values.
CELLS_PER_FILE = 4
SALT_STEPS = 1 << 20


def _file_count(size: int, target_file_bytes: int) -> int:
    return max(1, math.ceil(size / target_file_bytes))


def _sorted_file_count(size: int, rows: float, target_file_bytes: int) -> int:
    """Files to lay rows out in, each of which one task sorts: rows that are stored small are as large in memory."""
    return max(_file_count(size, target_file_bytes), math.ceil(rows / FILE_ROWS))


# ---- compaction ----------------------------------------------------------------------------------


def compact(store: TableStore, table: str, target_file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Merge the small files of the latest version; returns the version to read from now on.

    There is no shuffle: the scan packs small files into its partitions, and ``coalesce`` joins
    those up to the target size. Each file counts by its own size: large ones stay, also beside small ones.
    Clustered folders are left to clustering. No new version is made if there is nothing to gain.
    """
    return _compact(store, store.snapshot(table), target_file_bytes).version


def _compact(store: TableStore, snapshot: Snapshot, target_file_bytes: int) -> Snapshot:
    small_bytes = target_file_bytes * SMALL_FILE_SHARE
    # By its average alone a folder can't be judged, but one whose bytes are all in one file can.
    able = [f for f in snapshot.folders if not f.clustered_by and f.files and (f.files > 1 or f.bytes < small_bytes)]
    if sum(f.files for f in able) < 2:
        return snapshot
    sizes = {f: store.file_sizes(snapshot.table, f) for f in able}
    small = {f: [name for name, size in own.items() if size < small_bytes] for f, own in sizes.items()}
    number = sum(map(len, small.values()))
    wanted = _file_count(sum(sizes[f][name] for f, names in small.items() for name in names), target_file_bytes)
    if number <= wanted:
        return snapshot
    # Only where a folder keeps some of its files, the rows of each part have to be counted, from footers.
    mixed = [f for f in able if 0 < len(small[f]) < len(sizes[f])]
    rows = _rows_in_small_files(store, snapshot, mixed, small)
    merged: list[Folder] = []
    kept: list[Folder] = []
    for folder in able:
        if folder not in rows:
            (merged if small[folder] else kept).append(folder)
            continue
        own = set(small[folder])
        for into, names, n in (
            (merged, sorted(own), rows[folder]), (kept, sorted(set(sizes[folder]) - own), folder.rows - rows[folder]),
        ):
            into.append(replace(folder, rows=n, files=len(names), bytes=sum(sizes[folder][x] for x in names), only=tuple(names)))
    touched = {f.path for f in merged}
    packed = store.read_snapshot(snapshot, merged).coalesce(wanted)
    return store.rewrite([packed], snapshot, [f for f in able if f.path in touched], kept=[f for f in kept if f.path in touched])


def _rows_in_small_files(
    store: TableStore, snapshot: Snapshot, folders: list[Folder], small: dict[Folder, list[str]]
) -> dict[Folder, int]:
    """One row per folder comes to the driver; the scan reads footers only."""
    if not folders:
        return {}
    parts = [replace(f, only=tuple(small[f])) for f in folders]
    scan = store.read_snapshot(snapshot, parts)
    place = F.regexp_extract(scan.metadataColumn("_metadata").getField("file_path"), f"/({WRITE_COLUMN}=[0-9a-f]+)/", 1)
    counts = {r[0]: r[1] for r in scan.groupBy(place).count().collect()}
    return {f: counts.get(f.path, 0) for f in folders}


# ---- clustering ----------------------------------------------------------------------------------


def _sort_key(df: DataFrame, name: str) -> Column:
    """A double or a string that sorts like the column, never NULL (short code for comparisons)."""
    column = quoted(name)
    data_type = df.select(column).schema[0].dataType
    if isinstance(data_type, StringType):
        return F.coalesce(column, F.lit(""))
    if isinstance(data_type, (DateType, TimestampType, TimestampNTZType)):
        column = column.cast("timestamp")
    if isinstance(data_type, (DateType, TimestampType, TimestampNTZType, NumericType, BooleanType)):
        return F.coalesce(column.cast("double"), F.lit(float("-inf")))
    raise TypeError(f"cannot cluster by {name} of type {data_type.simpleString()}")


def _edges(values: np.ndarray, weights: np.ndarray, levels: int) -> list:
    """Distinct quantiles of the weighted values, without their minimum: at most ``levels`` - 1 of them.

    NaN is no edge: it sorts above all other values and so passes every edge by itself.
    """
    real = values == values
    values, weights = values[real], weights[real]
    if len(values) == 0:
        return []
    order = np.argsort(values, kind="stable")
    ordered, passed = values[order], np.cumsum(weights[order])
    picks = ordered[np.minimum(np.searchsorted(passed, np.arange(1, levels) * passed[-1] / levels, side="right"), len(ordered) - 1)]
    return sorted(set(picks.tolist()) - {ordered[0]})


def _bits(columns: list[np.ndarray], cells: int) -> list[int]:
    """Bits of each column's level, so that together they give so many cells.

    A column gets no more than its different values need; what it leaves goes to the others in turn.
    """
    most = [math.ceil(math.log2(max(1, len(np.unique(v[v == v]))) )) for v in columns]
    bits = [0] * len(columns)
    while sum(bits) < math.log2(cells) and bits != most:
        for i in range(len(columns)):
            if bits[i] < most[i] and sum(bits) < math.log2(cells):
                bits[i] += 1
    return bits


def _levels(keys: np.ndarray, cuts: list, bits: int) -> np.ndarray:
    """How many edges each key has reached, stretched to the full range of levels."""
    if not cuts:
        return np.zeros(len(keys), np.int64)
    passed = np.searchsorted(np.array(cuts, dtype=keys.dtype), keys, side="right")
    return passed * ((1 << bits) - 1) // len(cuts)


def _interleave(levels: list[np.ndarray], bits: list[int]) -> np.ndarray:
    """The bits of several level numbers, the highest of each first, as one cell number."""
    cell = np.zeros(len(levels[0]), np.int64)
    for rank in range(max(bits, default=0)):
        for level, own in zip(levels, bits):
            if rank < own:
                cell = cell * 2 + ((level >> (own - 1 - rank)) & 1)
    return cell


@dataclass(frozen=True)
class Placement:
    """Where rows go: edges of each key column, the cells that a weighted sample has met, and their shares."""

    bits: list[int]
    edges: list[list]
    met: np.ndarray
    shares: np.ndarray

    @classmethod
    def of(cls, values: list[np.ndarray], weights: np.ndarray, files: int) -> Placement:
        bits = _bits(values, CELLS_PER_FILE * files)
        edges = [_edges(column, weights, 1 << n) for column, n in zip(values, bits)]
        cells = _interleave([_levels(v, cuts, n) for v, cuts, n in zip(values, edges, bits)], bits)
        met, at = np.unique(cells, return_inverse=True)
        return cls(bits, edges, met, np.bincount(at, weights, len(met)) / max(weights.sum(), 1e-9))

    def lay(self, keyed: DataFrame, keys: list[str], columns: Sequence[str], files: int) -> DataFrame:
        """One shuffle to ``files`` partitions by the keys and ``__salt``, each sorted by cell and columns."""
        bits, edges, met, shares = self.bits, self.edges, self.met, self.shares
        # A cell the sample has not met begins where the next one that it has met does.
        starts = np.cumsum(shares) - shares

        @F.pandas_udf("cell long, spot double")
        def place(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            for *parts, salt in batches:
                found = [_levels(part.to_numpy(), cuts, n) for part, cuts, n in zip(parts, edges, bits)]
                cell = _interleave(found, bits)
                at = np.minimum(np.searchsorted(met, cell), max(len(met) - 1, 0))
                known = met[at] == cell if len(met) else np.zeros(len(cell), bool)
                # A cell that is small beside a file lies whole in the file that its middle is in.
                spread = np.where(shares[at] * files < 0.5, 0.5, salt.to_numpy() / SALT_STEPS) if len(met) else 0.0
                width = np.where(known, shares[at] * spread, 0.0) if len(met) else 0.0
                yield pd.DataFrame({"cell": cell, "spot": (starts[at] if len(met) else 0.0) + width})

        spot = F.least(F.floor(F.col("__place.spot") * files), F.lit(files - 1)).cast("int")
        return (
            keyed.withColumn("__place", place(*keys, "__salt"))
            .withColumns({"__partition": spot, "__cell": F.col("__place.cell")})
            .repartitionById(files, F.col("__partition"))
            .sortWithinPartitions("__cell", *[quoted(name) for name in columns])
            .drop("__cell", "__salt", "__partition", "__place", *keys)
        )


def _keyed(df: DataFrame, columns: Sequence[str], salt: Column) -> tuple[DataFrame, list[str]]:
    keys = [f"__key{i}" for i in range(len(columns))]
    own = [_sort_key(df, column).alias(key) for column, key in zip(columns, keys)]
    return df.select("*", *own, F.pmod(salt, F.lit(SALT_STEPS)).alias("__salt")), keys


def cluster(df: DataFrame, columns: Sequence[str], files: int, rows: int) -> DataFrame:
    """Lay rows out so that each of ``files`` partitions covers a small range of every column.

    ``df`` is a Parquet scan of about ``rows`` rows. A sample, whose size follows the number of files, gives
    range edges per column; rows get a level per column, the levels' bits are interleaved into a cell number, and
    cells go to partitions by their share of the sample. A cell that is worth several partitions, such as one
    value in a third of the rows, is spread over them by row position. There is one shuffle, without
    the extra pass over all columns that a range repartitioning makes. Only the key columns pass through Arrow,
    where the edges are searched by bisection: edges and cells have no fixed number.
    """
    if files == 1:
        return df.coalesce(1).sortWithinPartitions(*[quoted(name) for name in columns])
    keyed, keys = _keyed(df, columns, F.xxhash64(df.metadataColumn("_metadata").getField("row_index")))
    wanted = max(SAMPLE_ROWS, SAMPLE_ROWS_PER_FILE * files)
    sample = keyed.select(*keys).sample(False, min(1.0, wanted / max(rows, 1)), seed=42).toPandas()
    values = [sample[key].to_numpy() for key in keys]
    return Placement.of(values, np.ones(len(sample)), files).lay(keyed, keys, columns, files)


def _sketch(keyed: DataFrame, keys: list[str]) -> pd.DataFrame:
    """A bounded part of each partition's keys, each with the number of rows that it stands for in ``__weight``.

    One pass over the key columns only, also where the frame's size is not known beforehand.
    """

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng, held, seen = np.random.default_rng(42), None, 0
        for batch in batches:
            seen += len(batch)
            batch["__weight"] = rng.random(len(batch))
            held = batch if held is None else pd.concat([held, batch])
            if len(held) > SKETCH_ROWS:
                held = held.nsmallest(SKETCH_ROWS, "__weight")
        if seen:
            held["__weight"] = seen / len(held)
            yield held

    part = keyed.select(*keys)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in part.schema.fields)
    return part.mapInPandas(draw, f"{schema}, __weight double").toPandas()


def _row_bytes(df: DataFrame) -> float:
    """Bytes of a row as Parquet, from a bounded number of rows; it only sets the number of files."""
    rows = df.limit(SKETCH_ROWS).toArrow()
    if not rows.num_rows:
        return 1.0
    sink = pa.BufferOutputStream()
    pq.write_table(rows, sink)
    return sink.getvalue().size / rows.num_rows


def write_clustered(
    store: TableStore,
    df: DataFrame,
    table: str,
    columns: Sequence[str],
    target_file_bytes: int = TARGET_FILE_BYTES,
    consumed: Mapping[str, int] | None = None,
    append: bool = False,
) -> int:
    """Write any frame clustered: its rows are shuffled once and written once, as one folder.

    The placement comes from a bounded sample of the frame's own key columns. How large a row is, which sets
    the number of files, comes from the table's last version or else from a few rows. Rows that are worth several
    files are spread by a hash of their columns. By default the table's rows are replaced.
    """
    if not columns:
        raise ValueError("give columns to cluster by")
    able = [quoted(f.name) for f in df.schema.fields if not holds_map(f.dataType)]
    keyed, keys = _keyed(df, columns, F.xxhash64(*able) if able else F.lit(0))
    sample = _sketch(keyed, keys)
    last = store.current(table)
    each = last.bytes / last.rows if last.rows else _row_bytes(df)
    rows = float(sample["__weight"].sum())
    files = _sorted_file_count(int(rows * each), rows, target_file_bytes)
    if files == 1:
        laid = df.coalesce(1).sortWithinPartitions(*[quoted(name) for name in columns])
    else:
        values = [sample[key].to_numpy() for key in keys]
        laid = Placement.of(values, sample["__weight"].to_numpy(), files).lay(keyed, keys, columns, files)
    write = store.append if append else store.overwrite
    return write(laid, table, consumed=consumed, clustered_by=tuple(columns))


def clustered_writer(
    store: TableStore, columns: Sequence[str], target_file_bytes: int = TARGET_FILE_BYTES,
    consumed: Mapping[str, int] | None = None,
) -> Callable[..., int]:
    """A layer writer that applies the transform, if there is one, and replaces the table, clustered."""

    def write(df: DataFrame, table: str, transform: Transform | None = None) -> int:
        made = df.transform(transform) if transform else df
        return write_clustered(store, made, table, columns, target_file_bytes, consumed)

    return write


def zorder(
    store: TableStore,
    table: str,
    columns: Sequence[str],
    target_file_bytes: int = TARGET_FILE_BYTES,
    settled_bytes: int | None = None,
) -> int:
    """Cluster the latest version by several columns; returns the version to read from now on.

    With ``settled_bytes`` the folders that an earlier run clustered by the same columns stay once they have grown
    to that size; else all data is laid out as one key range. No new version is made if all data is in one
    folder that is clustered already.
    """
    return _zorder(store, store.snapshot(table), columns, target_file_bytes, settled_bytes).version


def _zorder(
    store: TableStore,
    snapshot: Snapshot,
    columns: Sequence[str],
    target_file_bytes: int,
    settled_bytes: int | None = None,
) -> Snapshot:
    if not columns:
        raise ValueError("give columns to cluster by")
    by = tuple(columns)
    stale = [
        f for f in snapshot.folders if f.clustered_by != by or settled_bytes is None or f.bytes < settled_bytes
    ]
    if not stale or (len(stale) == 1 and stale[0].clustered_by == by):
        return snapshot
    size, rows = sum(f.bytes for f in stale), sum(f.rows for f in stale)
    laid = cluster(store.read_snapshot(snapshot, stale), columns, _sorted_file_count(size, rows, target_file_bytes), rows)
    return store.rewrite([laid], snapshot, stale, clustered_by=by)


# ---- runs ----------------------------------------------------------------------------------------

Box = list[tuple[Any, Any]]
"""The least and the largest sort key of each clustering column."""


@dataclass
class Run:
    """Folders that are, or are to be, laid out as one key range."""

    folders: list[Folder]
    box: Box
    settled: bool

    @property
    def bytes(self) -> int:
        return sum(f.bytes for f in self.folders)

    def join(self, other: Run) -> Run:
        box = [(min(a[0], b[0]), max(a[1], b[1])) for a, b in zip(self.box, other.box)]
        return Run(self.folders + other.folders, box, False)


def _deepest(boxes: list[Box], among: list[int], column: int = 0) -> list[int]:
    """The most boxes that have a point in common; some box begins there, in every column."""
    if not among or column == len(boxes[among[0]]):
        return among
    best: list[int] = []
    for point in sorted({boxes[i][column][0] for i in among}):
        inside = [i for i in among if boxes[i][column][0] <= point <= boxes[i][column][1]]
        if len(inside) > len(best):
            found = _deepest(boxes, inside, column + 1)
            best = found if len(found) > len(best) else best
    return best


def _merged_runs(runs: list[Run], most_overlap: int) -> list[Run]:
    """Runs joined until no point of the key space is in more than ``most_overlap`` of them.

    Where too many meet, the smallest join, and with them each next larger run that they have grown to half of. So
    a row is written again only as its run doubles, about log(table / append) times.
    """
    runs = list(runs)
    while True:
        met = _deepest([r.box for r in runs], list(range(len(runs))))
        if len(met) <= most_overlap:
            return runs
        order = sorted((runs[i] for i in met), key=lambda r: r.bytes)
        number = len(order) - most_overlap + 1
        while number < len(order) and 2 * sum(r.bytes for r in order[:number]) >= order[number].bytes:
            number += 1
        joined = order[0]
        for run in order[1:number]:
            joined = joined.join(run)
        runs = [r for r in runs if not any(r is x for x in order[:number])] + [joined]


def _bound(value: Any) -> Any:
    """A bound that compares with all others: NaN sorts above all numbers."""
    return math.inf if isinstance(value, float) and math.isnan(value) else value


def _bounds_of(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    keys = [_sort_key(df, c) for c in columns]
    return [f(key).alias(f"__{name}{i}") for i, key in enumerate(keys) for f, name in ((F.min, "low"), (F.max, "high"))]


def _boxes(store: TableStore, snapshot: Snapshot, folders: Sequence[Folder], columns: Sequence[str]) -> dict[str, Box]:
    """Of each folder with rows; what was not kept with its write is measured by a scan of the key columns."""
    boxes = store.saved_bounds(snapshot.table, columns)
    left = [f for f in folders if f.path not in boxes]
    if left:
        rows = store.read_with_folders(snapshot, left)
        for r in rows.groupBy("__folder").agg(*_bounds_of(rows, columns)).collect():
            values = list(map(_bound, r[1:]))
            boxes[r[0]] = list(zip(values[::2], values[1::2]))
    return boxes


def zorder_incremental(
    store: TableStore,
    table: str,
    columns: Sequence[str],
    target_file_bytes: int = TARGET_FILE_BYTES,
    most_overlap: int = 2,
) -> int:
    """Cluster what came since and leave the rest, as long as few runs hold the same keys; gives the version to read.

    All folders that are not clustered by these columns yet, and runs smaller than a file, become one run. At no point
    of the key space more than ``most_overlap`` runs meet afterwards; to that end the smallest that do are merged.
    Appends in the order of the keys therefore never rewrite old rows, and others rewrite them only as runs double.
    A run's bounds are taken in the job that writes it and kept beside it, so old runs are not read to compare them.
    Each new run is a version of its own. No version is made if nothing came and no runs are to be merged.
    """
    return _zorder_incremental(store, store.snapshot(table), columns, target_file_bytes, most_overlap).version


def _zorder_incremental(
    store: TableStore, snapshot: Snapshot, columns: Sequence[str], target_file_bytes: int, most_overlap: int
) -> Snapshot:
    if not columns:
        raise ValueError("give columns to cluster by")
    if most_overlap < 1:
        raise ValueError("at least one run holds a point")
    by = tuple(columns)
    boxes = _boxes(store, snapshot, snapshot.folders, by)
    # A folder without rows has no box, and stays.
    each = [Run([f], boxes[f.path], f.clustered_by == by) for f in snapshot.folders if f.path in boxes]
    small = [r for r in each if r.settled and r.bytes < target_file_bytes]
    fresh = [r for r in each if not r.settled]
    if fresh or len(small) > 1:
        first, *others = fresh + small
        first.settled = False
        for run in others:
            first = first.join(run)
        each = [r for r in each if r.settled and r.bytes >= target_file_bytes] + [first]
    for run in _merged_runs(each, most_overlap):
        if not run.settled:
            snapshot = _write_run(store, snapshot, run, by, target_file_bytes)
    return snapshot


def _write_run(store: TableStore, snapshot: Snapshot, run: Run, by: tuple[str, ...], target_file_bytes: int) -> Snapshot:
    rows = sum(f.rows for f in run.folders)
    laid = cluster(store.read_snapshot(snapshot, run.folders), by, _sorted_file_count(run.bytes, rows, target_file_bytes), rows)
    seen = Observation()
    after = store.rewrite([laid.observe(seen, *_bounds_of(laid, by))], snapshot, run.folders, clustered_by=by)
    found = seen.get
    bounds = [(_bound(found[f"__low{i}"]), _bound(found[f"__high{i}"])) for i in range(len(by))]
    store.save_bounds(snapshot.table, after.folders[-1], by, bounds)
    return after


# ---- report --------------------------------------------------------------------------------------


def optimize_table(
    store: TableStore,
    table: str,
    zorder_columns: Sequence[str] | None = None,
    target_file_bytes: int = TARGET_FILE_BYTES,
    most_overlap: int | None = None,
) -> dict[str, Any]:
    """Compact a table, or cluster it if columns are given, and report the files before and after.

    With ``most_overlap`` the clustering is incremental, with at most so many runs at any point of the key space.
    """
    before = store.snapshot(table)
    if zorder_columns and most_overlap is not None:
        after = _zorder_incremental(store, before, zorder_columns, target_file_bytes, most_overlap)
    elif zorder_columns:
        after = _zorder(store, before, zorder_columns, target_file_bytes)
    else:
        after = _compact(store, before, target_file_bytes)
    return {
        "table": table,
        "version": after.version,
        "files_before": before.files,
        "files_after": after.files,
    }


def optimize_report(store: TableStore, table: str, before: int, after: int) -> DataFrame:
    """One row with the file counts of two versions, from the history."""
    return store.detail(table, after).select(
        "table_name",
        F.lit(store.snapshot(table, before).files).cast("long").alias("files_before"),
        F.col("num_files").alias("files_after"),
    )
