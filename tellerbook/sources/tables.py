"""Folders of Parquet tables, and the file-system calls they need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.mkdirs(p)


def remove_folder(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def folder_names(spark: SparkSession, root: str) -> list[str]:
    p, fs = _path(spark, root)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    p, fs = _path(spark, path)
    return fs.getContentSummary(p).getLength()


def numbered(spark: SparkSession, root: str, prefix: str) -> list[tuple[int, bool]]:
    """Numbered folders under a folder and whether each one is complete."""
    p, fs = _path(spark, root)
    if not fs.exists(p):
        return []
    found = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith(prefix):
            done = exists(spark, f"{root}/{name}/_SUCCESS")
            found.append((int(name.removeprefix(prefix)), done))
    return sorted(found)


def complete(spark: SparkSession, root: str, prefix: str) -> list[int]:
    return [number for number, done in numbered(spark, root, prefix) if done]


def versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """Numbered versions under a folder and whether each one is complete."""
    return numbered(spark, root, "version=")


def current_version(spark: SparkSession, root: str) -> int:
    """Number of the newest complete version."""
    complete = [number for number, done in versions(spark, root) if done]
    if not complete:
        raise FileNotFoundError(f"no complete version under {root}")
    return complete[-1]


def next_version(spark: SparkSession, *roots: str) -> int:
    """A number no version under any of the folders has."""
    used = [number for root in roots for number, _ in versions(spark, root)]
    return max(used, default=0) + 1


def version_path(root: str, number: int) -> str:
    return f"{root}/version={number}"


def write_daily(
    rows: DataFrame,
    path: str,
    partition: str,
    cluster: str | None = None,
    mode: str = "overwrite",
    replace: str = "static",
) -> None:
    """Write one folder per day, or per value of another column.

    The rebalance puts a day's rows together so that a folder gets few files,
    and splits a day that is too large for one task.
    """
    together = rows.hint("rebalance", partition)
    if cluster:
        together = together.sortWithinPartitions(partition, cluster)
    (
        together.write.mode(mode)
        .option("partitionOverwriteMode", replace)
        .partitionBy(partition)
        .parquet(path)
    )
