"""Versioned Parquet tables: each write is a new folder, and a small file per version lists its folders.

Layout below the store's root folder::

    tables/<name>/data/__write=<random id>/...parquet   rows of one write
    tables/<name>/profiles/__write=<random id>.json   rows and nulls of that write
    tables/<name>/versions/<n>.json                   one line: folders, schema and metrics of version n

Data is written first and the version's file last, so a write that dies half-way leaves a folder that
no version names. Old versions stay readable. A version's file is only ever created, never replaced: of two
writers of the same version the second fails, and the table stays as the first left it.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratakit.functions.rules import quoted
from stratakit.functions.schemas import conformed, merge_types, nullable
from stratakit.sources.storage import create_text, folder_size, list_names, list_sizes, move_aside, read_text

HISTORY_SCHEMA = """
    version long, timestamp timestamp, operation string, schema_json string, operationMetrics map<string, string>
"""
MISSING = -1
WRITE_COLUMN = "__write"
Transform = Callable[[DataFrame], DataFrame]


class TableNotFoundError(LookupError):
    pass


class ConcurrentWriteError(RuntimeError):
    """Another writer made, or began, the version that was to be written."""


@dataclass(frozen=True)
class Folder:
    path: str
    rows: int
    files: int
    bytes: int
    clustered_by: tuple[str, ...] = ()
    only: tuple[str, ...] = ()
    """Files of the folder that belong to the version, if others of it were rewritten."""


@dataclass(frozen=True)
class Snapshot:
    """What one version of a table consists of."""

    table: str
    version: int
    schema: StructType | None
    folders: tuple[Folder, ...] = ()
    partition_by: tuple[str, ...] = ()
    consumed: Mapping[str, int] = field(default_factory=dict)
    """The version of each source table up to which its rows are in this table."""

    @property
    def rows(self) -> int:
        return sum(f.rows for f in self.folders)

    @property
    def files(self) -> int:
        return sum(f.files for f in self.folders)

    @property
    def bytes(self) -> int:
        return sum(f.bytes for f in self.folders)


@dataclass(frozen=True)
class Changes:
    """What came to a table after one version, up to another."""

    table: str
    since: int
    until: int
    folders: tuple[Folder, ...]
    replaced: bool
    """Rows were removed or changed in between, so the folders are those of the whole later version."""

    @property
    def rows(self) -> int:
        return sum(f.rows for f in self.folders)


class TableStore:
    """Versioned tables below one root folder, which all executors must be able to reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---- reading -------------------------------------------------------------------------------

    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    def history(self, table: str) -> DataFrame:
        """One row per version."""
        self._require(table)
        return self.spark.read.schema(HISTORY_SCHEMA).json(self._folder(table, "versions")).where("version is not null")

    def last_history(self, table: str, n: int = 1) -> DataFrame:
        return self.history(table).orderBy(F.desc("version")).limit(n)

    def latest_version(self, table: str) -> int:
        """The newest version, or -1 if the table is missing."""
        return self.current(table).version

    def write_metrics(self, table: str, since: int = MISSING) -> DataFrame:
        """Metrics of the writes after a version, oldest first; no rows if nothing was written.

        These are a few short lines, so one task sorts them and there is no shuffle.
        """
        return (
            self.history(table).where(F.col("version") > since).coalesce(1).orderBy("version")
            .select("version", "operation", "operationMetrics")
        )

    def metrics_since(self, table: str, since: int) -> list[dict[str, str]]:
        """The same metrics as dicts, without a Spark job."""
        last = self.latest_version(table)
        return [self._record(table, v)["operationMetrics"] for v in self._versions(table) if since < v <= last]

    def snapshot(self, table: str, version: int | None = None) -> Snapshot:
        """Folders and schema of a version (the latest by default), from its own small file."""
        self._require(table)
        if version is None:
            found = self.current(table)
        else:
            record = self._record(table, version) if version in self._versions(table) else None
            found = self._as_snapshot(table, record)
        if found.version == MISSING:
            raise LookupError(f"table {table} has no version {'yet' if version is None else version}")
        return found

    def current(self, table: str) -> Snapshot:
        """The latest finished version, or version -1 without folders if there is none."""
        for version in reversed(self._versions(table)):
            record = self._record(table, version)
            if record:
                return self._as_snapshot(table, record)
        return Snapshot(table, MISSING, None)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A version of a table, the latest by default. Version 0 is a version like any other."""
        return self.read_snapshot(self.snapshot(table, version))

    def read_snapshot(self, snapshot: Snapshot, folders: Sequence[Folder] | None = None) -> DataFrame:
        """Scan the named folders only, with the schema the version had when it was written.

        Filters on the columns a table is partitioned by leave out whole folders.
        """
        return self._scan(snapshot, folders).select(*self._names(snapshot))

    def _names(self, snapshot: Snapshot) -> list:
        return [quoted(name) for name in snapshot.schema.names]

    def _scan(self, snapshot: Snapshot, folders: Sequence[Folder] | None = None) -> DataFrame:
        """The rows with the folder that each lies in."""
        base = self._folder(snapshot.table, "data")
        paths = [
            f"{base}/{f.path}/{file}".rstrip("/")
            for f in (snapshot.folders if folders is None else folders) for file in (f.only or ("",))
        ]
        schema = StructType([*snapshot.schema.fields, StructField(WRITE_COLUMN, StringType())])
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def changes(self, table: str, since: int, until: int | None = None) -> Changes:
        """The folders that appends added after version ``since`` (-1: from the start), up to ``until``.

        Rewrites for layout add no rows, and what they replaced can still be read, so they are passed over. After an
        overwrite or a merge the difference is no longer a set of new rows; the whole later version is given then.
        """
        last = self.snapshot(table, until)
        if not MISSING <= since <= last.version:
            raise ValueError(f"table {table} has no version {since} up to version {last.version}")
        if since == MISSING:
            return Changes(table, since, last.version, last.folders, False)
        known = {f.path for f in self.snapshot(table, since).folders}
        added: list[Folder] = []
        for version in (v for v in self._versions(table) if since < v <= last.version):
            record = self._record(table, version)
            if record["operation"] not in ("APPEND", "OPTIMIZE"):
                return Changes(table, since, last.version, last.folders, True)
            folders = self._as_snapshot(table, record).folders
            if record["operation"] == "APPEND":
                added += [f for f in folders if f.path not in known]
            known |= {f.path for f in folders}
        return Changes(table, since, last.version, tuple(added), False)

    def read_changes(self, changes: Changes) -> DataFrame:
        """Scan only the folders of a difference, with the schema of its later version."""
        last = self.snapshot(changes.table, changes.until)
        if changes.folders:
            return self.read_snapshot(last, changes.folders)
        return self.spark.createDataFrame([], last.schema)

    def consumed(self, table: str, source: str) -> int:
        """The version of a source table up to which its rows are in this table, or -1."""
        return self.current(table).consumed.get(source, MISSING)

    def detail(self, table: str, version: int | None = None) -> DataFrame:
        """One row: version, files, rows and bytes, taken from the version's file without a data scan."""
        snapshot = self.snapshot(table, version)
        return self.history(table).where(F.col("version") == snapshot.version).select(
            F.lit(table).alias("table_name"),
            "version",
            F.lit(snapshot.files).cast("long").alias("num_files"),
            F.lit(snapshot.rows).cast("long").alias("num_rows"),
            F.lit(snapshot.bytes).cast("long").alias("size_bytes"),
        )

    def null_counts(self, table: str, version: int | None = None) -> DataFrame:
        """(column_name, rows, nulls) of a version, added up from what each of its writes has counted.

        Those counts are small files beside the data. Data is only scanned where a write has none, or where only some
        of its files are left; then it is those files. A column that a write did not have yet is NULL in its rows.
        """
        snapshot = self.snapshot(table, version)
        names = snapshot.schema.names
        there = set(list_names(self.spark, self._folder(table, "profiles")))
        counted = [f for f in snapshot.folders if not f.only and f"{f.path}.json" in there]
        schema = "rows long, nulls map<string, long>"
        paths = [self._folder(table, "profiles", f"{f.path}.json") for f in counted]
        parts = self.spark.read.schema(schema).json(paths) if paths else self.spark.createDataFrame([], schema)
        left = [f for f in snapshot.folders if f not in counted]
        if left:
            values = [F.count(quoted(c)) for c in names]
            n = F.count(F.lit(1))
            entries = [x for c, v in zip(names, values) for x in (F.lit(c), n - v)]
            parts = parts.union(self.read_snapshot(snapshot, left).agg(n.alias("rows"), F.create_map(*entries).alias("nulls")))
        own = [F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col("nulls")[c], "rows").alias("nulls")) for c in names]
        each = parts.select("rows", F.inline(F.array(*own)))
        totals = each.groupBy("column_name").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"))
        order = self.spark.createDataFrame([(i, c) for i, c in enumerate(names)], "position int, column_name string")
        zero = F.lit(0).cast("long")
        return order.join(totals, "column_name", "left").select(
            "position", "column_name", F.coalesce("rows", zero).alias("rows"), F.coalesce("nulls", zero).alias("nulls")
        )

    # ---- writing -------------------------------------------------------------------------------

    def append(
        self, df: DataFrame, table: str, partition_by: Sequence[str] | None = None, consumed: Mapping[str, int] | None = None,
        clustered_by: Sequence[str] = (), widen: bool = False,
    ) -> int:
        """Add rows as a new version. New columns and new fields of structs, also in arrays and maps, join the
        table, and narrower numbers take its type; another changed type is an error. With ``widen`` a column of
        the table takes the type of wider numbers; older files are read in it without being written again, and
        older versions keep their types. A table keeps the columns it was first partitioned by.

        ``consumed`` names the versions of source tables that the rows come from. It becomes visible together with
        the rows, so a run that dies in between neither loses nor repeats any. ``clustered_by`` says how the rows
        are laid out already.
        """
        options = {"partition_by": partition_by, "consumed": consumed, "clustered_by": clustered_by, "widen": widen}
        return self._commit([df], self.current(table), "APPEND", **options).version

    def overwrite(
        self, df: DataFrame, table: str, replace_schema: bool = False, partition_by: Sequence[str] | None = None,
        consumed: Mapping[str, int] | None = None, clustered_by: Sequence[str] = (),
    ) -> int:
        """Replace all rows as a new version. Columns are merged unless the schema is replaced too."""
        options = {"partition_by": partition_by, "consumed": consumed, "clustered_by": clustered_by}
        return self._commit([df], self.current(table), "OVERWRITE", replace_schema, **options).version

    def merge(self, df: DataFrame, table: str, keys: Sequence[str], consumed: Mapping[str, int] | None = None) -> int:
        """Rows take the place of those with the same keys, and the others are added, as a new version.

        One scan of the key columns finds the folders that hold any of the keys; only these are written again. Keys
        that are NULL equal none. The rows must not hold a key twice, which one aggregation of their keys makes sure.
        """
        current = self.current(table)
        if current.version == MISSING:
            return self.append(df, table, consumed=consumed)
        names = [quoted(k) for k in keys]
        if not names:
            raise ValueError("give keys to merge by")
        own = df.select(*names).dropna()
        if not own.groupBy(*names).count().where("count > 1").isEmpty():
            raise ValueError(f"rows to merge into {table} hold a key of {list(keys)} more than once")
        touched = {
            r[0] for r in self._scan(current).select(*names, WRITE_COLUMN).join(own, list(keys), "left_semi")
            .select(WRITE_COLUMN).distinct().collect()
        }
        replaced = [f for f in current.folders if f.path.removeprefix(f"{WRITE_COLUMN}=") in touched]
        parts = [df]
        if replaced:
            parts.append(self.read_snapshot(current, replaced).join(own, list(keys), "left_anti").select(*self._names(current)))
        return self._commit(parts, current, "MERGE", replaced=replaced, consumed=consumed).version

    def rewrite(
        self,
        parts: Sequence[DataFrame],
        snapshot: Snapshot,
        replaced: Sequence[Folder],
        clustered_by: Sequence[str] = (),
        kept: Sequence[Folder] = (),
    ) -> Snapshot:
        """Put other files with the same rows in the place of some folders of the latest version.

        ``kept`` are those folders again, each with the files only that stay.

        The parts are written one after another and become visible together. The version is only
        published if they have as many rows as the folders they replace.
        """
        return self._commit(parts, snapshot, "OPTIMIZE", replaced=replaced, clustered_by=clustered_by, kept=kept)

    def file_sizes(self, table: str, folder: Folder) -> dict[str, int]:
        """The files of a write folder that belong to the version, with their bytes."""
        found = list_sizes(self.spark, self._folder(table, "data", folder.path))
        return {f: found[f] for f in folder.only} if folder.only else found

    def save_bounds(self, table: str, folder: Folder, columns: Sequence[str], bounds: Sequence[Sequence[Any]]) -> None:
        """Keep the least and the largest value of each column in a write folder, whose files never change."""
        record = {"columns": list(columns), "bounds": [list(pair) for pair in bounds]}
        create_text(self.spark, self._folder(table, "bounds", f"{folder.path}.json"), json.dumps(record) + "\n")

    def saved_bounds(self, table: str, columns: Sequence[str]) -> dict[str, list[tuple[Any, Any]]]:
        """Bounds of the folders that have any for just these columns, by the folder's path."""
        names = list_names(self.spark, self._folder(table, "bounds"))
        texts = {n.removesuffix(".json"): read_text(self.spark, self._folder(table, "bounds", n)) for n in names}
        records = {path: json.loads(text) for path, text in texts.items() if text.endswith("\n")}
        return {p: [tuple(pair) for pair in r["bounds"]] for p, r in records.items() if r["columns"] == list(columns)}

    def read_with_folders(self, snapshot: Snapshot, folders: Sequence[Folder]) -> DataFrame:
        """The rows of some folders with the path of the folder that each lies in, as ``__folder``."""
        rows = self._scan(snapshot, folders)
        return rows.select(*self._names(snapshot), F.concat(F.lit(f"{WRITE_COLUMN}="), WRITE_COLUMN).alias("__folder"))

    def place_in_folder(self, file_path: str) -> tuple[str, str]:
        """Name of the write folder that a file lies in, and its place there."""
        found = re.search(rf"/({WRITE_COLUMN}=[0-9a-f]+)/(.+)$", file_path)
        return found[1], unquote(found[2])

    def discard_unfinished(self, table: str) -> list[str]:
        """Names of version files that a writer left unfinished when it died; they are moved aside.

        Only for use when no writer is at work: until then such a file stops further writes.
        """
        bad = [v for v in self._versions(table) if not self._record(table, v)]
        for version in bad:
            path = self._folder(table, "versions", f"{version}.json")
            move_aside(self.spark, path, self._folder(table, f"unfinished-{uuid.uuid4().hex}"))
        return [f"{v}.json" for v in bad]

    def _commit(
        self,
        parts: Sequence[DataFrame],
        current: Snapshot,
        operation: str,
        replace_schema: bool = False,
        replaced: Sequence[Folder] = (),
        clustered_by: Sequence[str] = (),
        kept: Sequence[Folder] = (),
        partition_by: Sequence[str] | None = None,
        consumed: Mapping[str, int] | None = None,
        widen: bool = False,
    ) -> Snapshot:
        schema = nullable(parts[0].schema)
        if current.schema is not None and not replace_schema:
            schema = merge_types(current.schema, schema, widen=widen)
        by = current.partition_by if partition_by is None else tuple(partition_by)
        stays = current.folders if operation != "OVERWRITE" else ()
        if stays and by != current.partition_by:
            raise ValueError(f"table {current.table} is partitioned by {current.partition_by}, not {by}")
        if missing := set(by) - set(schema.names):
            raise ValueError(f"no column {sorted(missing)} to partition by")
        version = current.version + 1
        if version in self._versions(current.table):
            raise ConcurrentWriteError(f"version {version} of {current.table} is there already, or unfinished")
        name = f"{WRITE_COLUMN}={uuid.uuid4().hex}"
        folder = self._folder(current.table, "data", name)

        rows = 0
        nulls = dict.fromkeys(schema.names, 0)
        for part in parts:
            # Rows and nulls are counted in the write job itself, in its last stage.
            counted, cast = Observation(), _cast(part, schema)
            values = [F.count(quoted(c)).alias(f"v{i}") for i, c in enumerate(cast.columns)]
            writer = cast.observe(counted, F.count(F.lit(1)).alias("rows"), *values).write.mode("append")
            (writer.partitionBy(*by) if by else writer).parquet(folder)
            found = counted.get
            rows += found["rows"]
            own = {c.lower(): found[f"v{i}"] for i, c in enumerate(cast.columns)}
            for c in nulls:
                nulls[c] += found["rows"] - own.get(c.lower(), 0)
        files, size = folder_size(self.spark, folder)
        if operation == "OPTIMIZE" and rows != sum(f.rows for f in replaced) - sum(f.rows for f in kept):
            raise RuntimeError(f"rewriting {current.table} gave {rows} rows, so it was not published")

        if files:
            profile = {"folder": name, "rows": rows, "nulls": nulls}
            create_text(self.spark, self._folder(current.table, "profiles", f"{name}.json"), json.dumps(profile) + "\n")

        gone = list(current.folders) if operation == "OVERWRITE" else list(replaced)
        # Partitioning writes no file for no rows, and such a folder can't be listed beside others.
        added = (Folder(name, rows, files, size, tuple(clustered_by)),) if files else ()
        folders = tuple(f for f in current.folders if f not in gone) + tuple(kept) + added
        metrics = {"numFiles": files, "numOutputRows": rows, "numOutputBytes": size}
        if gone:
            metrics["numRemovedFiles"] = sum(f.files for f in gone) - sum(f.files for f in kept)
        record = {
            "version": version,
            "timestamp": datetime.now(timezone.utc).isoformat(timespec="milliseconds"),
            "operation": operation,
            "operationMetrics": {key: str(value) for key, value in metrics.items()},
            "schema_json": schema.json(),
            "partition_by": by,
            "consumed": {**current.consumed, **(consumed or {})},
            "folders": [asdict(f) for f in folders],
        }
        try:
            create_text(self.spark, self._folder(current.table, "versions", f"{version}.json"), json.dumps(record) + "\n")
        except FileExistsError as error:
            raise ConcurrentWriteError(f"another writer made version {version} of {current.table}") from error
        return Snapshot(current.table, version, schema, folders, by, record["consumed"])

    # ---- version files -------------------------------------------------------------------------

    def _require(self, table: str) -> None:
        if not self.exists(table):
            raise TableNotFoundError(f"table {table} does not exist in {self.root}")

    def _versions(self, table: str) -> list[int]:
        """Numbers that have a file, finished or not."""
        names = list_names(self.spark, self._folder(table, "versions"))
        return sorted(int(m[1]) for m in (re.fullmatch(r"(\d+)\.json", n) for n in names) if m)

    def _record(self, table: str, version: int) -> dict[str, Any] | None:
        """What a version's file says; None while its line is not finished."""
        text = read_text(self.spark, self._folder(table, "versions", f"{version}.json"))
        return json.loads(text) if text.endswith("\n") else None

    def _as_snapshot(self, table: str, record: dict[str, Any] | None) -> Snapshot:
        if record is None:
            return Snapshot(table, MISSING, None)
        folders = tuple(Folder(**{**f, "clustered_by": tuple(f["clustered_by"]), "only": tuple(f["only"])}) for f in record["folders"])
        schema = StructType.fromJson(json.loads(record["schema_json"]))
        return Snapshot(
            table, record["version"], schema, folders, tuple(record["partition_by"]), record.get("consumed", {})
        )

    def _folder(self, table: str, *parts: str) -> str:
        if not isinstance(table, str) or not re.fullmatch(r"\w[\w.-]*", table):
            raise ValueError(f"not a table name: {table!r}")
        return "/".join([self.root, "tables", table, *parts])


def _cast(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in the types of the table: narrower numbers, and structs that lack fields, at any depth."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    other = {
        f.name: conformed(quoted(f.name), f.dataType, types[f.name.lower()])
        for f in nullable(df.schema).fields if types[f.name.lower()] != f.dataType
    }
    return df.select(*[other[c].alias(c) if c in other else quoted(c) for c in df.columns]) if other else df


def append_writer(store: TableStore, partition_by: Sequence[str] | None = None) -> Callable[..., int]:
    """A layer writer that applies the transform, if there is one, and appends."""

    def write(df: DataFrame, table: str, transform: Transform | None = None) -> int:
        return store.append(df.transform(transform) if transform else df, table, partition_by)

    return write


def overwrite_writer(store: TableStore, partition_by: Sequence[str] | None = None) -> Callable[..., int]:
    """A layer writer that applies the transform, if there is one, and replaces the table."""

    def write(df: DataFrame, table: str, transform: Transform | None = None) -> int:
        return store.overwrite(df.transform(transform) if transform else df, table, partition_by=partition_by)

    return write
