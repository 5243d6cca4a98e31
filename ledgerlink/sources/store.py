"""Stored tables: every step of a run writes its result and reads it back.

A stored table ends the lineage: a lost executor costs the running step only.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

#: How long replaced versions stay for those who still read them: a day.
RETAIN_SECONDS = 86_400.0

# What ``stored`` has written, by the run that it belongs to.
_OUTSIDE: list[str] = []
_WRITTEN: ContextVar[list[str]] = ContextVar("written", default=_OUTSIDE)


def together(*jobs: Callable[[], T]) -> list[T]:
    """Run independent jobs side by side: one fills the gaps the others leave.

    The results come in the order of the jobs; the first failure is raised.
    """
    if len(jobs) == 1:
        return [jobs[0]()]
    # Threads take over the job group, tags and properties of the caller.
    session = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    inherit = inheritable_thread_target(session)
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        # What the jobs write belongs to the run of the caller.
        running = [pool.submit(copy_context().run, inherit(job)) for job in jobs]
        return [job.result() for job in running]


class MixedVersionsError(ValueError):
    """Tables that were not built from each other's present versions."""

    def __init__(self, stale: Mapping[str, Sequence[str]]) -> None:
        self.stale = {name: list(inputs) for name, inputs in stale.items()}
        parts = (f"{name} (from another {', '.join(inputs)})" for name, inputs in stale.items())
        super().__init__(f"Tables of different versions: {'; '.join(parts)}")


class TableStore:
    """Replaceable Parquet tables below one shared folder, also known to SQL.

    ``buckets`` lays a table out by its key, with the hash that joins and
    groupings use, so that later steps on that key need no shuffle.  With
    ``buckets`` equal to ``spark.sql.shuffle.partitions`` the bucketed write
    takes over the partitioning that the deduplication left behind.

    Each write goes to a folder of its own.  One small file names the versions of all
    tables that belong together, and for each the versions of the tables that it was
    built from; a completed write adds a new such file, so readers see the set before it
    or after it.  A failed write leaves the set as it was.  Earlier versions stay, for
    frames that still read them, until ``vacuum`` takes them away.
    """

    _commits = threading.Lock()

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        database: str = "default",
        buckets: int | None = None,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self.buckets = buckets
        # The versions that this store has given out as frames.
        self._loaded: dict[str, str] = {}
        if database != "default":
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

    def qualified(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def _files(self, folder: str) -> list[str]:
        """Names of what lies in a folder below the root, sorted."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        return sorted(item.getPath().getName() for item in files.listStatus(path))

    def current(self) -> dict[str, dict[str, object]]:
        """``path`` and ``inputs`` of the present version of every table."""
        last = self._last_set()
        return {} if last is None else json.loads(_read_text(self.spark, f"{self.root}/_sets/{last}"))

    def _last_set(self) -> str | None:
        """Of sets written at once as successors of the same one, the first counts."""
        sets = [name for name in self._files("_sets") if name.endswith(".json")]
        if not sets:
            return None
        number = sets[-1].split("-")[0]
        return next(name for name in sets if name.startswith(number))

    def _commit(self, name: str, path: str, inputs: Mapping[str, str]) -> None:
        """Make a version the present one; others' commits in between are kept."""
        with self._commits:
            while True:
                tables, last = self.current(), self._last_set()
                tables[name] = {"path": path, "inputs": dict(inputs)}
                number = 0 if last is None else int(last.split("-")[0]) + 1
                ours = f"{number:012d}-{uuid.uuid4().hex}.json"
                _write_text(self.spark, f"{self.root}/_sets/{ours}", json.dumps(tables))
                if self._last_set() in (None, ours) or self._last_set() > ours:
                    return
                _delete(self.spark, f"{self.root}/_sets/{ours}")

    def location(self, name: str) -> str | None:
        """Folder of the present version, or None."""
        entry = self.current().get(name)
        return None if entry is None else str(entry["path"])

    def save(
        self, name: str, df: DataFrame, key: str | None = None, inputs: Sequence[str] = ()
    ) -> DataFrame:
        """Create or replace a table and return it as read back.

        ``inputs`` are the tables of this store that the frame reads: their versions are
        written down with the table.
        """
        built_from = {i: self._loaded.get(i) or self.location(i) or "" for i in inputs}
        layout = ""
        if self.buckets and key:
            df = df.repartition(self.buckets, key)
            layout = f"-{self.buckets}-{key}"
        version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{name}/{version}{layout}"
        writer = df.write.format("parquet").option("path", path)
        if layout:
            writer = writer.bucketBy(self.buckets, key).sortBy(key)
        # Only a completed write takes over the name.
        staged = f"{name}__{uuid.uuid4().hex}"
        writer.saveAsTable(self.qualified(staged))
        self._forget(name)
        self.spark.sql(
            f"ALTER TABLE {self.qualified(staged)} RENAME TO {self.qualified(name)}"
        )
        self._commit(name, path, built_from)
        return self.load(name)

    def load(self, name: str) -> DataFrame:
        """The table of this store, whatever the catalogue knew under its name."""
        where = self.location(name)
        if where is None:
            raise ValueError(f"Table {name} is not in {self.root}.")
        if not self._known_at(name, where):
            self._forget(name)
            self._register(name, where)
        self._loaded[name] = where
        return self.spark.table(self.qualified(name))

    def stale(self, names: Sequence[str]) -> dict[str, list[str]]:
        """Those of the tables, and of the tables behind them, that were built from other
        versions than the present ones, with the inputs that changed."""
        tables, found, todo, seen = self.current(), {}, list(names), set()
        while todo:
            name = todo.pop()
            if name in seen or name not in tables:
                continue
            seen.add(name)
            inputs = tables[name]["inputs"]
            changed = [i for i, path in inputs.items() if tables.get(i, {}).get("path") != path]
            if changed:
                found[name] = changed
            todo += inputs
        return found

    def require_one_set(self, names: Sequence[str]) -> None:
        """Refuse tables of which one was built from a replaced version of another."""
        stale = self.stale(names)
        if stale:
            raise MixedVersionsError(stale)

    def vacuum(self, retain_seconds: float = RETAIN_SECONDS) -> list[str]:
        """Delete versions that were replaced so long ago that no reader holds them, and
        what failed writes left; returns their folders."""
        present = {str(entry["path"]) for entry in self.current().values()}
        before = time.time_ns() - int(retain_seconds * 1e9)
        gone = []
        for name in self._files(""):
            versions = [] if name.startswith("_") else self._files(name)
            for version, later in zip(versions, [*versions[1:], None], strict=False):
                path = f"{self.root}/{name}/{version}"
                replaced = (later or version).split("-")[0]
                if path not in present and replaced.isdigit() and int(replaced) < before:
                    _delete(self.spark, path)
                    gone.append(path)
        last = self._last_set()
        for name in self._files("_sets"):
            if last is not None and name < last.split("-")[0]:
                _delete(self.spark, f"{self.root}/_sets/{name}")
        return gone

    def _known_at(self, name: str, where: str) -> bool:
        if not self.spark.catalog.tableExists(self.qualified(name)):
            return False
        facts = self._facts(name)
        bare = where.split(":", 1)[-1].lstrip("/")
        return facts.get("Location", "").split(":", 1)[-1].lstrip("/") == bare

    def _facts(self, name: str) -> dict[str, str]:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.qualified(name)}").collect()
        return {row["col_name"]: row["data_type"] for row in rows}

    def _forget(self, name: str) -> None:
        """Take a name out of the catalogue; files stay."""
        if self.spark.catalog.tableExists(self.qualified(name)):
            if self._facts(name).get("Type") != "EXTERNAL":
                raise ValueError(f"{self.qualified(name)} is not a table of a store.")
            self.spark.sql(f"DROP TABLE {self.qualified(name)}")

    def _register(self, name: str, where: str) -> None:
        schema = self.spark.read.parquet(where).schema
        columns = ", ".join(
            f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema
        )
        layout = where.rstrip("/").rsplit("/", 1)[-1].split("-", 3)[2:]
        buckets = (
            f"CLUSTERED BY (`{layout[1]}`) SORTED BY (`{layout[1]}`) INTO {layout[0]} BUCKETS"
            if layout else ""
        )
        quoted = where.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {self.qualified(name)} ({columns}) USING parquet {buckets} "
            f"LOCATION '{quoted}'"
        )

    def exists(self, name: str) -> bool:
        """Whether the folder holds a completely written table, known to SQL or not."""
        return self.location(name) is not None

    def attach(self, names: Sequence[str]) -> None:
        """Make tables that an earlier session wrote known to this one."""
        for name in names:
            self.load(name)

    def run_steps(
        self,
        steps: Sequence[tuple[str, str]],
        args: Mapping[str, object] | None = None,
    ) -> dict[str, DataFrame]:
        """Run named SELECT statements in order; each result becomes a table."""
        if self.database != "default":
            self.spark.catalog.setCurrentDatabase(self.database)
        try:
            return {
                name: self.save(
                    name,
                    self.spark.sql(query, args=dict(args)) if args
                    else self.spark.sql(query),
                )
                for name, query in steps
            }
        finally:
            if self.database != "default":
                self.spark.catalog.setCurrentDatabase("default")


def register(df: DataFrame, name: str) -> None:
    """Make a frame known to SQL in this session."""
    df.createOrReplaceTempView(name)


def unregister(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the shared one that the cluster names.

    Where ``spark.checkpoint.dir`` is unset, it lies in the warehouse, which all
    executors share as well; that holds for every kind of session.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder that nothing was written to yet."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/ledgerlink-{app}/{uuid.uuid4().hex}/{name}"


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _read_text(spark: SparkSession, path: str) -> str:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it has its name only when it is complete."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    target, draft = make(path), make(f"{path}.draft")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files.rename(draft, target)


@contextmanager
def own_scratch(spark: SparkSession) -> Iterator[list[str]]:
    """What ``stored`` writes inside belongs to this run, and goes when it ends, also if
    it fails.  Runs side by side in one process, or one inside another, keep apart."""
    written: list[str] = []
    mark = _WRITTEN.set(written)
    try:
        yield written
    finally:
        _WRITTEN.reset(mark)
        drop_stored(spark, written)


def note_written(path: str) -> None:
    """Let a folder of intermediate tables go with the run that it belongs to."""
    _WRITTEN.get().append(path)


def drop_stored(spark: SparkSession, written: list[str] | None = None) -> None:
    """Delete what ``stored`` has written, outside of runs or in the given list; no frame
    may read it later."""
    paths = _OUTSIDE if written is None else written
    while paths:
        _delete(spark, paths.pop())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once, for plans that read it more than once.

    It belongs to the run whose ``own_scratch`` it is in; ``drop_stored`` deletes what was
    written outside of any.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # Noted first: a write that fails leaves nothing behind either.
    note_written(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
