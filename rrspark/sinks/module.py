"""Storage modules (K3, U2): records handed to a sink of the caller's, in two phases.

A module is made once a task, from a factory that travels to the executors. It takes records one by one
(``store``), then ``flush`` and ``close``; what ``close`` returns (a token) says what the task has prepared. Only
when every task has closed does the driver call the factory's ``commit`` with one token per task, and the counters of
these same tasks; of a task that failed, was killed or ran twice there is no token, and if the job fails ``abort``
gets the tokens there are. So a module that prepares in ``close`` and shows in ``commit`` stores a data set whole or
not at all. Spark calls all this through a data source of its own (``DataSourceArrowWriter``).

A record that ``store`` refuses (any exception) counts as ``failed_store`` and the others go on; an error of
``flush`` or ``close`` fails the task, which Spark runs again.
"""

from __future__ import annotations

import json
import uuid
from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..session import arrow_filesystem, ship_package

COUNTERS = ("records_stored", "failed_store")


class StorageModule(ABC):
    @abstractmethod
    def store(self, record: dict[str, Any]) -> None:
        """Take one record: its fields by name, absent ones left out."""

    def flush(self) -> None:
        """Called after the last record, and before ``close``."""

    def close(self) -> Any:
        """Prepare what was stored, release what the module holds; the token for ``commit``."""

    def discard(self) -> None:
        """Called in place of ``close`` when the task fails; a killed task can't call it."""


class ModuleFactory(ABC):
    """Travels to the tasks, so it must pickle; ``conf`` is the caller's settings and ``job``, the id of this write."""

    @abstractmethod
    def create(self, conf: dict[str, str]) -> StorageModule:
        """A module for one task."""

    def commit(self, conf: dict[str, str], tokens: list[Any], counters: dict[str, int]) -> None:
        """Show what the tasks prepared; once, after all of them."""

    def abort(self, conf: dict[str, str], tokens: list[Any]) -> None:
        """Undo what the tasks prepared; the tokens of those that failed are missing."""

    def counters(self, conf: dict[str, str]) -> dict[str, int]:
        """The counters that were committed, if the factory keeps them."""
        return {}


@dataclass
class Prepared(WriterCommitMessage):
    token: Any
    counts: tuple[int, ...]


def _source(factory: ModuleFactory) -> type[DataSource]:
    class Writer(DataSourceArrowWriter):
        def __init__(self, conf: dict[str, str]) -> None:
            self.conf = conf

        def write(self, iterator: Iterator[pa.RecordBatch]) -> Prepared:
            module = factory.create(self.conf)
            stored = failed = 0
            try:
                for batch in iterator:
                    for row in batch.to_pylist():
                        if set(row) == {"fields"}:  # records with any keys
                            row = dict(row["fields"] or ())
                        try:
                            module.store({k: v for k, v in row.items() if v is not None})
                            stored += 1
                        except Exception:  # noqa: BLE001  counted, as the module's answer
                            failed += 1
                module.flush()
                return Prepared(module.close(), (stored, failed))
            except BaseException:
                module.discard()
                raise

        def commit(self, messages: list[Prepared | None]) -> None:
            done = [m for m in messages if m is not None]
            totals = dict(zip(COUNTERS, map(sum, zip(*(m.counts for m in done))))) if done else dict.fromkeys(COUNTERS, 0)
            factory.commit(self.conf, [m.token for m in done], totals)

        def abort(self, messages: list[Prepared | None]) -> None:
            factory.abort(self.conf, [m.token for m in messages if m is not None])

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return "rrspark_module"

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            return Writer(dict(self.options))

    return Source


def store_records(records: DataFrame, factory: ModuleFactory, conf: dict[str, str] | None = None) -> dict[str, int]:
    """Hand every record to the factory's modules, one a task, and commit. Rows with the single column ``fields`` (a map)
    are records with any keys, other rows records of their columns. Returns the counters kept with the output."""
    spark = records.sparkSession
    ship_package(spark)
    spark.dataSource.register(_source(factory))
    conf = {"job": uuid.uuid4().hex, **(conf or {})}
    records.write.format("rrspark_module").mode("append").options(**conf).save()
    return factory.counters(conf)


class _ParquetModule(StorageModule):
    """Writes its task's records to a file of its own in the job's staging folder, ``rows`` a row group."""

    def __init__(self, fs, folder: str, schema: pa.Schema, rows: int) -> None:
        fs.create_dir(folder, recursive=True)
        self.fs, self.schema, self.rows = fs, schema, rows
        self.name = f"part-{uuid.uuid4().hex}.parquet"
        self.path = f"{folder}/{self.name}"
        self.file = pq.ParquetWriter(self.path, schema, compression="zstd", filesystem=fs)
        self.held: list[dict[str, Any]] = []

    def store(self, record: dict[str, Any]) -> None:
        if missing := [f.name for f in self.schema if not f.nullable and f.name not in record]:
            raise ValueError(f"record lacks {missing}")
        self.held.append(record)
        if len(self.held) >= self.rows:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self.file.write_table(pa.Table.from_pylist(self.held, self.schema))
            self.held = []

    def close(self) -> str:
        self.file.close()
        return self.name

    def discard(self) -> None:
        self.file.close()
        self.fs.delete_file(self.path)


@dataclass
class ParquetFactory(ModuleFactory):
    """Records under ``path`` (a setting) as Parquet, each write a folder ``job=<id>`` that appears with its counters in
    one rename. Fields not in the schema are left out; a record without a field that mustn't be null is refused."""

    schema: pa.Schema
    rows: int = 50_000

    def _at(self, conf: dict[str, str]) -> tuple[Any, str, str]:
        fs, path = arrow_filesystem(conf["path"])
        return fs, f"{path}/_staging/{conf['job']}", f"{path}/job={conf['job']}"

    def create(self, conf: dict[str, str]) -> StorageModule:
        fs, staging, _ = self._at(conf)
        return _ParquetModule(fs, staging, self.schema, self.rows)

    def commit(self, conf: dict[str, str], tokens: list[str], counters: dict[str, int]) -> None:
        from pyarrow import fs as pafs

        fs, staging, shown = self._at(conf)
        fs.create_dir(staging, recursive=True)
        for info in fs.get_file_info(pafs.FileSelector(staging)):
            if info.base_name not in tokens:  # of an attempt that died, or of a second one
                fs.delete_file(info.path)
        with fs.open_output_stream(f"{staging}/_counters.json") as out:
            out.write(json.dumps(counters).encode())
        fs.move(staging, shown)

    def abort(self, conf: dict[str, str], tokens: list[str]) -> None:
        fs, staging, _ = self._at(conf)
        fs.delete_dir_contents(staging, missing_dir_ok=True)

    def counters(self, conf: dict[str, str]) -> dict[str, int]:
        fs, _, shown = self._at(conf)
        with fs.open_input_stream(f"{shown}/_counters.json") as f:
            return json.loads(f.read())


CELLS = pa.schema([pa.field(c, pa.string(), nullable=False) for c in ("table_name", "row", "cf", "cq", "value")])
