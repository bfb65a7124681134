"""Session settings and lineage cuts.

Intermediate tables that several jobs read (prepared texts, training sets) are
written as Parquet under the cluster's shared ``spark.checkpoint.dir`` and read
back, so a lost executor never forces a recompute from the raw scan and later
per-collection reads prune by partition.  The directory is taken from the
session; one is only created when the setting is absent (local tests).
"""

from __future__ import annotations

import atexit
import json
import tempfile
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings applied by ``get_session`` (a cluster's own spark-defaults win for
# anything not listed here).
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "relevo", conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the setting is absent and the master is local (tests) a fresh
    folder is made; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder every executor shares "
                "(a machine-local temporary folder is not safe on a cluster)"
            )
        path = tempfile.mkdtemp(prefix="relevo-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


_LOCK = threading.Lock()
#: (folder, its file system and path) of the runs under way, by application;
#: the last is in use.
_RUNS: dict[str, list[tuple]] = {}


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of a folder in whatever store holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.getFileStatus(at).isDirectory()


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Put a completely written folder in the place of ``path``, by one
    rename; readers see the old or the new one, never a part."""
    fs, source = _file_system(spark, written)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs.mkdirs(target.getParent())
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    replaced = fs.exists(target) and fs.rename(target, old)
    if not fs.rename(source, target):
        raise OSError(f"{written} could not be renamed to {path}")
    if replaced:
        fs.delete(old, True)


def _new_run(spark: SparkSession) -> tuple:
    folder = f"{checkpoint_dir(spark).rstrip('/')}/relevo/run-{uuid.uuid4().hex}"
    manifest = {"application": spark.sparkContext.applicationId, "started": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())}
    fs, at = _file_system(spark, f"{folder}/manifest.json")
    out = fs.create(at, True)
    try:
        out.write(bytearray(json.dumps(manifest).encode()))
    finally:
        out.close()
    return folder, fs, at.getParent()


def work_folder(spark: SparkSession) -> str:
    """Folder of the run under way.  Outside a ``workspace`` it is the
    session's own, which goes when Python ends (or by ``release``): a query's
    result is lazy and still reads it after the query has returned."""
    app = spark.sparkContext.applicationId
    with _LOCK:
        if app not in _RUNS:
            _RUNS[app] = []
            atexit.register(_release, app)
        if not _RUNS[app]:
            _RUNS[app].append(_new_run(spark))
        return _RUNS[app][-1][0]


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """One run: what is materialised inside lies in a folder of its own, with
    a manifest, and is deleted when the run ends or fails.  Results that are
    to stay are written elsewhere before."""
    app = spark.sparkContext.applicationId
    work_folder(spark)
    run = _new_run(spark)
    with _LOCK:
        _RUNS[app].append(run)
    try:
        yield run[0]
    finally:
        with _LOCK:
            _RUNS[app].remove(run)
        run[1].delete(run[2], True)


def _release(app: str, at_exit: bool = True) -> None:
    """``at_exit`` the session, and what holds its files, may be gone."""
    with _LOCK:
        runs = _RUNS.pop(app, [])
    for _, fs, at in runs:
        try:
            fs.delete(at, True)
        except Exception:
            if not at_exit:
                raise


def release(spark: SparkSession) -> None:
    """Delete the session's own folder; earlier results can't be read then."""
    _release(spark.sparkContext.applicationId, at_exit=False)


def abandoned_runs(spark: SparkSession) -> list[tuple[str, dict]]:
    """(folder, manifest) of runs of other applications in the checkpoint
    folder: such as were killed, or are still under way elsewhere."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/relevo"
    fs, at = _file_system(spark, root)
    if not fs.exists(at):
        return []
    out = []
    for status in fs.listStatus(at):
        folder = status.getPath().toString()
        if status.getPath().getName().startswith("run-"):
            text = spark.read.option("wholetext", True).text(f"{folder}/manifest.json").first()
            own = json.loads(text[0]) if text else {}
            if own.get("application") != spark.sparkContext.applicationId:
                out.append((folder, own))
    return out


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the run's folder below the checkpoint folder
    and read it back.

    This cuts the lineage (a lost executor re-reads the written files instead
    of recomputing) and, with ``partition_by``, lets per-collection reads prune
    partitions.  The written schema is read back as it was, so partition
    values keep their type (id ``007`` stays a string).  ``schema`` reads
    columns as a user type of the type they were written in.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if partition_by:
        # REBALANCE: AQE groups each partition value into few output files and
        # splits a hot value (say a third of all rows) into advisory-size
        # pieces, instead of one file per (input task, value).
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread an input that can't be split before CPU-heavy row work.

    A table in one file of one row group (or any unsplittable file) is scanned
    by one task; its rows are redistributed round-robin.  An input of several
    splits is returned as it is, however many cores there are: its scan is
    already parallel, and a shuffle of raw text would cost more."""
    if df.rdd.getNumPartitions() < 2:
        return df.repartition(min_partitions or df.sparkSession.sparkContext.defaultParallelism)
    return df
