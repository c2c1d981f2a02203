"""Sinks (K1-K5): compressed columnar output, per-type directories, JSON text, SequenceFiles,
cells by table and run, and a pluggable store step (``store.py``: the keyed store, ``module.py``: modules).

Writes are whole-DataFrame jobs committed by Spark's output committer, so a lost executor
only re-runs its tasks; nothing is written from the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.cells import Generator, generate_cells, map_cells
from ..operators.records import fields_from_json
from ..sources.sequence import write_sequence
from .hadoop import Folder
from .store import CellStore


def write_records(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "zstd") -> None:
    """Records as compressed Parquet (the engine's stage output form)."""
    df.write.mode(mode).option("compression", compression).parquet(path)


def write_by_type(df: DataFrame, path: str, types: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """One directory per record type (``type=MX/`` ...) in one pass instead of one filter job
    per type; readers then prune whole directories. ``types`` limits the output to those.
    Rows are rebalanced by type first, so a type's rows meet in few files; AQE splits a type that holds
    many of the rows over as many tasks as its size needs."""
    if types:
        df = df.where(F.col("type").isin(list(types)))
    df.hint("rebalance", "type").write.mode(mode).partitionBy("type").parquet(path)


COUNTERS = "_counters.json"


def write_counted(spark: SparkSession, path: str, write: Callable[[str], None], counters: Callable[[], dict]) -> dict:
    """A stage's output and the counters of the pass that made it, in one commit: ``write`` fills a folder beside
    ``path``, the counters go into it, and one rename shows both. A job or driver that dies before leaves what was
    there. The counters come from an ``Observation``, so from the tasks' own pass; Spark may count rows of a task
    twice that it ran again after its executor was lost in a later stage."""
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}.staging"
    write(beside)
    found = dict(counters())
    Folder(spark, beside).create(COUNTERS, json.dumps(found))
    parent, _, name = path.rstrip("/").rpartition("/")
    folder = Folder(spark, parent)
    folder.delete(name)
    if not folder.rename(beside.rpartition("/")[2], name):
        raise OSError(f"could not move {beside} to {path}")
    return found


def read_counters(spark: SparkSession, path: str) -> dict:
    """The counters that were committed with a stage's output."""
    return json.loads(Folder(spark, path).read(COUNTERS))


def write_responses(df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite") -> None:
    """Raw responses ``question, wire``. ``format="sequence"`` writes Hadoop SequenceFiles of
    (Text, BytesWritable) for tools that expect them."""
    if format == "parquet":
        df.select("question", "wire").write.mode(mode).parquet(path)
    elif format == "sequence":
        if not _ready(df.sparkSession, path, mode):
            return
        write_sequence(df.select("question", "wire"), path)
    else:
        raise ValueError(f"unknown format {format!r}")


def _ready(spark: SparkSession, path: str, mode: str) -> bool:
    """Apply a save mode to a path that a Hadoop output format will write; whether to write."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return True
    if mode == "overwrite":
        fs.delete(where, True)
        return True
    if mode == "ignore":
        return False
    raise FileExistsError(f"{path} exists; sequence output can't use mode {mode!r}")


def write_cells(cells: DataFrame, path: str, run: str = "0") -> None:
    """Cells as they are, one directory per destination table and run; ``CellStore`` keeps one a key. Writing a
    run again replaces that run's directories and nothing else, so a repeated job changes nothing and other data
    sets stay. Every task writes what it has, so a hot table spreads over all of them."""
    writer = cells.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "zstd").partitionBy("table_name", "run").parquet(path)


def store_json(lines: DataFrame, generators: Sequence[Callable[[DataFrame], DataFrame]],
               sink: Callable[[DataFrame], None], column: str = "json") -> dict[str, int]:
    """Storage step over JSON record text with any keys: cells of the map generators (``cells.
    map_event_generator``, ``map_edge_generator``) of every record that can be stored go to ``sink``.
    Returns the counters of that same pass: ``bad_records`` (no JSON object), ``failed_store`` (an explicit
    null), ``records_stored`` and ``total`` (the last two together)."""
    cells, seen = _observed_cells(lines, generators, column)
    sink(cells)
    return dict(seen.get)


def _observed_cells(lines: DataFrame, generators: Sequence[Callable[[DataFrame], DataFrame]],
                    column: str) -> tuple[DataFrame, Observation]:
    seen = Observation("store")
    bad, failed = F.col("fields").isNull(), F.col("failed")
    records = fields_from_json(lines, column).observe(
        seen, F.count_if(bad).alias("bad_records"), F.count_if(failed).alias("failed_store"),
        F.count_if(~bad & ~failed).alias("records_stored"), F.count_if(~bad).alias("total"))
    return map_cells(records.where(~bad & ~failed).select("fields"), generators), seen


def store_json_run(lines: DataFrame, generators: Sequence[Callable[[DataFrame], DataFrame]], into: CellStore, run: str,
                   column: str = "json") -> dict[str, int]:
    """``store_json`` into a keyed store as one run, its counters committed with its cells. A run that is
    stored already is neither read nor counted again; its counters are returned."""
    if not into.has(run):
        cells, seen = _observed_cells(lines, generators, column)
        into.add(cells, run, counters=lambda: dict(seen.get))
    return into.counters(run)


def store(df: DataFrame, generators: Sequence[Generator], sink: Callable[[DataFrame], None] | None = None,
          path: str | None = None) -> DataFrame:
    """Make the cells of all generators and hand them to ``sink`` (any writer: a table,
    a Python data source, ``write_cells``). Returns the cells DataFrame."""
    cells = generate_cells(df, generators)
    if sink is not None:
        sink(cells)
    elif path is not None:
        write_cells(cells, path)
    return cells
