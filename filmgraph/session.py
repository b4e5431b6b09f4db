"""Session settings and the shared working folder.

Everything the library writes besides the graph itself (staged inputs, quarantine tables,
streaming checkpoints, scratch copies for tests) lives below the folder the cluster names in
``spark.checkpoint.dir``: a shared file system or object store that every executor can reach.
"""

from __future__ import annotations

import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins from runtime sizes (broadcast only when the
# measured side is small, skew splitting for popular movies); UTC keeps epoch arithmetic
# independent of the client; duplicate JSON keys resolve to the last value, as a map-based JSON
# reader does.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # key lists up to this size reach Parquet as IN filters (usable by bloom filters) instead
    # of a min..max range
    "spark.sql.parquet.pushdown.inFilterThreshold": "100",
}


def build_session(master: str | None = None, app_name: str = "filmgraph",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    # checkpoints (traversal frontiers, violating-key sets) are deleted once unreferenced
    settings = {"spark.ui.enabled": "false",
                "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
                **SESSION_CONF, **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that functions which run
    there find it even where only the driver has it on its path."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="filmgraph-py-"), "filmgraph.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, top))
    sc.addPyFile(archive)   # the driver serves it; executors keep their own copy
    _shipped.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only a local-mode session without the setting (tests, a laptop) gets a
    fresh temporary folder of its own. On a cluster an unset value is an error, since a
    machine-local folder is not visible to other executors and does not survive their loss.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    folder = tempfile.mkdtemp(prefix="filmgraph-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared folder: ``<spark.checkpoint.dir>/filmgraph/<parts...>``."""
    return "/".join([checkpoint_root(spark), "filmgraph", *parts])


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared folder."""
    return shared_path(spark, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Sorted names directly below a folder (one metadata call; empty if it does not exist)."""
    fs, hpath = _hadoop(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hpath))


def file_facts(spark: SparkSession, path: str) -> list[str]:
    """``name:size:mtime`` of a file, or of the files directly below a folder, on any file system
    (empty if it does not exist)."""
    fs, hpath = _hadoop(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}"
                  for s in fs.listStatus(hpath))


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file on any file system."""
    fs, hpath = _hadoop(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see all of it or none: under another name first, then renamed.
    An existing file is an error."""
    fs, hpath = _hadoop(spark, path)
    folder, name = path.rsplit("/", 1)
    _, part = _hadoop(spark, f"{folder}/_{name}-{uuid.uuid4().hex[:12]}")
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(hpath) or not fs.rename(part, hpath):
        fs.delete(part, False)
        raise RuntimeError(f"{path} was written by another job meanwhile")


# Seconds after which a lock is taken to be left behind by a job that died.
STALE_LOCK = 3600.0


@contextmanager
def lock(spark: SparkSession, path: str, wait: float = 1800.0) -> Iterator[None]:
    """One holder at a time over all jobs: a file that only its creator may have. Needs a file system
    that creates files exclusively (HDFS, local); elsewhere writers must not overlap by themselves."""
    fs, hpath = _hadoop(spark, path)
    give_up = time.monotonic() + wait
    while True:
        try:
            fs.create(hpath, False).close()
            break
        except Py4JJavaError:
            if not fs.exists(hpath):
                raise
            age = time.time() - fs.getFileStatus(hpath).getModificationTime() / 1000
            if age > STALE_LOCK:
                fs.delete(hpath, False)
            elif time.monotonic() > give_up:
                raise TimeoutError(f"{path} is held by another job") from None
            else:
                time.sleep(0.2)
    try:
        yield
    finally:
        fs.delete(hpath, False)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote (a missing one is fine)."""
    fs, hpath = _hadoop(spark, path)
    fs.delete(hpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists (any Hadoop-compatible file system).

    Asks the file system directly - one metadata call, no listing of the files below a table
    folder; sessions without a JVM gateway (Spark Connect) fall back to resolving a reader.
    """
    from pyspark.errors import AnalysisException

    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
                    .exists(hpath))
    except Exception:  # noqa: BLE001 - no gateway: use the reader below
        pass
    try:
        spark.read.format("text").load(path)
        return True
    except AnalysisException:
        return False
