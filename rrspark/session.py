"""Session helpers: building a session for tests/bench and locating shared scratch space."""

from __future__ import annotations

import atexit
import hashlib
import io
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rrspark") -> SparkSession:
    """A local session for tests and the benchmark. On a cluster, build the session with
    the cluster's own settings and pass it to the operators instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only where the setting is absent in local mode (tests) a private temporary folder is set; on a
    cluster that would be a folder other machines don't see, so it is an error.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share (master {master})")
        path = tempfile.mkdtemp(prefix="rrspark-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set(CHECKPOINT_CONF, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir for intermediate tables; it stays there unless
    it was made in a ``scratch_scope``."""
    path = named_path(spark, f"{name}-{uuid.uuid4().hex}")
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at the end, so write the result before. Scopes nest; DataFrames that
    still read such a table can't be used any more."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def named_path(spark: SparkSession, name: str) -> str:
    """The folder of this name under the shared checkpoint dir, the same in every run."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


@contextmanager
def settings(spark: SparkSession, **conf: object) -> Iterator[None]:
    """Session settings that hold inside, dots in their names written ``__``. What other threads of the session plan meanwhile
    gets them too, so only such are meant that change no result."""
    names = {k.replace("__", "."): str(v) for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shuffles_removed(spark: SparkSession):
    """The shuffle files of what is written inside are removed as each write ends, not when the driver's heap is next collected."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


# Bytes of stored files that a task takes which sorts what it makes of them: its spills then stay few, at any size of the files.
SPLIT_BYTES = 32 << 20


def small_splits(spark: SparkSession):
    """Tasks that are planned inside read at most ``SPLIT_BYTES`` of files each."""
    return settings(spark, spark__sql__files__maxPartitionBytes=SPLIT_BYTES)


def staged(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """``df`` written once to shared scratch and read back, so what it took is never done twice. ``options``: of the writer."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_filesystem(uri: str):
    """pyarrow's file system for a folder that Spark names, and its path there. Tasks use it for files that Spark's
    writers don't make; ``s3a`` and ``s3n`` are Hadoop's names for what pyarrow calls ``s3``."""
    from pyarrow import fs

    scheme, found, rest = uri.partition(":")
    if not found or "/" in scheme:
        return fs.LocalFileSystem(), os.path.abspath(uri)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")


_SHIPPED: set[tuple[str, str]] = set()
PACKAGE_DIR = os.path.dirname(os.path.abspath(__file__))


@lru_cache(maxsize=1)  # the code doesn't change while it runs
def _package_zip() -> tuple[bytes, str]:
    buf = io.BytesIO()
    root = os.path.dirname(PACKAGE_DIR)
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in sorted(os.walk(PACKAGE_DIR)):
            for f in sorted(files):
                if f.endswith(".py"):
                    p = os.path.join(d, f)
                    z.write(p, os.path.relpath(p, root))
    data = buf.getvalue()
    return data, hashlib.sha1(data).hexdigest()[:12]


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (as ``--py-files`` would), once per
    application. The zip is written where the driver keeps its own files: the checkpoint dir
    when it is a local path, else next to the package; Spark then serves it to executors."""
    sc = spark.sparkContext
    data, digest = _package_zip()
    key = (sc.applicationId, digest)
    if key in _SHIPPED:
        return
    ckpt = spark.conf.get(CHECKPOINT_CONF, None) or ""
    local_ckpt = ckpt.startswith("file:") or (ckpt and "://" not in ckpt)
    base = ckpt.replace("file:", "", 1) if local_ckpt else os.path.join(os.path.dirname(PACKAGE_DIR), ".pyfiles")
    try:
        os.makedirs(base, exist_ok=True)
    except OSError:  # read-only code directory: a private folder, only the source for addPyFile
        base = tempfile.mkdtemp(prefix="rrspark-pyfiles-")
    path = os.path.join(base, f"rrspark-{digest}.zip")
    if not os.path.exists(path):
        with open(path, "wb") as fh:
            fh.write(data)
    sc.addPyFile(path)
    _SHIPPED.add(key)
