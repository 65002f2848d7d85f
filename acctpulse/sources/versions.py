"""Tables that are refreshed whole and can be read at any time.

A refresh writes a new folder under ``<root>/versions`` and then replaces the
file ``<root>/CURRENT``, which names it, by one rename.  A reader resolves the
name once and reads that folder: during a refresh, and after one that failed, it
sees the version before.  Old versions stay until ``prune`` removes them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER, FOLDER = "CURRENT", "versions"


def _hadoop(spark: SparkSession, path: str):
    """(file system, path, classes) of a path."""
    fs = spark._jvm.org.apache.hadoop.fs
    own = fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()), own, fs


def _point(spark: SparkSession, root: str, version: str) -> None:
    """Replace the pointer by a rename, which the file system does as one step."""
    draft = f"{root}/{FOLDER}/{version}.pointer"
    system, path, fs = _hadoop(spark, draft)
    out = system.create(path, True)
    out.write(bytearray(version.encode()))
    out.close()
    context = fs.FileContext.getFileContext(system.makeQualified(path).toUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    context.rename(system.makeQualified(path), system.makeQualified(fs.Path(f"{root}/{POINTER}")), overwrite)


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that readers get, None before the first one."""
    system, path, _ = _hadoop(spark, f"{root.rstrip('/')}/{POINTER}")
    if not system.exists(path):
        return None
    return spark.read.text(f"{root.rstrip('/')}/{POINTER}").first()[0]


def stage_version(df: DataFrame, root: str) -> str:
    """Write a version that no reader gets yet; returns its name."""
    version = uuid.uuid4().hex
    df.write.mode("error").parquet(f"{root.rstrip('/')}/{FOLDER}/{version}")
    return version


def release(spark: SparkSession, root: str, version: str) -> None:
    """From now on, readers get this version."""
    root = root.rstrip("/")
    system, path, _ = _hadoop(spark, f"{root}/{FOLDER}/{version}/_SUCCESS")
    if not system.exists(path):
        raise FileNotFoundError(f"version {version} of {root} was not written to its end")
    _point(spark, root, version)


def refresh(df: DataFrame, root: str) -> str:
    """Write and release in one go."""
    version = stage_version(df, root)
    release(df.sparkSession, root, version)
    return version


def version_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/{FOLDER}/{version}"


def read_current(spark: SparkSession, root: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"{root} has no version yet")
    return spark.read.parquet(version_path(root, version))


def prune(spark: SparkSession, root: str, older_than_seconds: int = 7 * 86_400) -> list[str]:
    """Remove versions, other than the current one, that were written so long ago that none reads them any more."""
    root, removed = root.rstrip("/"), []
    current = current_version(spark, root)
    system, path, _ = _hadoop(spark, f"{root}/{FOLDER}")
    now = spark._jvm.java.lang.System.currentTimeMillis()
    for status in system.listStatus(path):
        name = status.getPath().getName()
        if status.isDirectory() and name != current and now - status.getModificationTime() >= older_than_seconds * 1000:
            system.delete(status.getPath(), True)
            removed.append(name)
    return removed
