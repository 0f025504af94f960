"""Shared storage folder for written layers, control tables and models.

On a cluster the folder is the one the cluster names in
``spark.checkpoint.dir`` (a shared filesystem or object store), so every
executor and a restarted driver see the same files.  Only a local-mode
session without that setting gets a folder of its own (tests, laptops).

Scratch tables live in one folder per application, which the driver's JVM
deletes when it ends.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

_CONF = "spark.checkpoint.dir"
_LOCAL_ROOTS: dict[str, str] = {}
_MARKED: set[str] = set()


def shared_root(spark: SparkSession) -> str:
    """Root folder for everything this library writes."""
    root = spark.conf.get(_CONF, None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no local context
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get(_CONF, None)
    if root:
        return root.rstrip("/")
    if sc is None:
        raise RuntimeError(f"{_CONF} is not set; name a shared folder for tables and checkpoints")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{_CONF} is not set; a cluster run needs a shared folder for tables and checkpoints"
        )
    app = sc.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="demandlake-")
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(_LOCAL_ROOTS[app] + "/checkpoints")
    return _LOCAL_ROOTS[app]


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _file_system(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder before the end of the application."""
    if "/demandlake/scratch" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    where, fs = _file_system(spark, path)
    fs.delete(where, True)


def scratch_root(spark: SparkSession) -> str:
    """The application's scratch folder, marked for deletion at the end."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - a Spark Connect session has no local context
        return f"{shared_root(spark)}/demandlake/scratch"
    root = f"{shared_root(spark)}/demandlake/scratch-{app}"
    if root not in _MARKED:
        where, fs = _file_system(spark, root)
        fs.mkdirs(where)  # only a folder that exists can be marked
        fs.deleteOnExit(where)
        _MARKED.add(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and modification times of the files of a table, from
    one listing: equal as long as nobody has changed the table."""
    where, fs = _file_system(spark, path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(where)))


def bytes_of(spark: SparkSession, files: Iterable[str]) -> int:
    """Total size of files, from one listing of each folder they lie in."""
    uri = spark.sparkContext._jvm.java.net.URI
    folders: dict[str, set[str]] = {}
    for f in files:
        folder, _, name = f.rpartition("/")
        folders.setdefault(folder, set()).add(name)
    total = 0
    for folder, names in folders.items():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri(folder))
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        total += sum(f.getLen() for f in fs.listStatus(path) if uri("file", None, "/" + f.getPath().getName(), None).getRawPath()[1:] in names)
    return total
