"""Names and sizes under a path, by the cluster's own file system (any URI)."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if there is no such folder."""
    fs, p = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove_tree(spark: SparkSession, path: str) -> None:
    """Remove a folder this job has written."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def swap_in(spark: SparkSession, moves: list[tuple[str, str]], aside: str) -> None:
    """Put folders in place by renames: every ``(new, place)``.  What was in a place
    goes to the folder ``aside`` until all are in place; if a rename fails, all are
    taken back, so the old folders are there again."""
    done: list[tuple[str, str]] = []

    def rename(src: str, dst: str) -> None:
        fs, target = _path(spark, dst)
        fs.mkdirs(target.getParent())
        try:
            moved = fs.rename(_path(spark, src)[1], target)
        except Py4JError as exc:
            raise OSError(f"cannot rename {src} to {dst}") from exc
        if not moved:
            raise OSError(f"cannot rename {src} to {dst}")
        done.append((src, dst))

    try:
        for k, (new, place) in enumerate(moves):
            if exists(spark, place):
                rename(place, f"{aside}/{k}")
            rename(new, place)
    except BaseException:
        for src, dst in reversed(done):
            fs, p = _path(spark, dst)
            fs.rename(p, _path(spark, src)[1])
        raise
    remove_tree(spark, aside)
