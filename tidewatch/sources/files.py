"""Small files and folders on whatever file system a path names, through Spark's own Hadoop client, on the driver."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

#: Moves and deletes under way at once, each of which mostly waits for the file system.
AT_ONCE = 16


def _open(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and authority: one without them is on the cluster's default file system, for tasks as well."""
    system, jvm_path = _open(spark, path)
    return jvm_path.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    system, path = _open(spark, folder)
    if not system.exists(path):
        return []
    return _names(spark, system.listStatus(path))


def _names(spark: SparkSession, listed) -> list[str]:
    """Names of the listed files of one folder, which come from the JVM as one text rather than one by one. No name has a
    slash, so the folder's own path tells them apart."""
    if not len(listed):
        return []
    prefix = f"{listed[0].getPath().getParent().toString().rstrip('/')}/"
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(listed)
    text = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)
    return sorted(text[1 + len(prefix):-1].split(f",{prefix}"))


def read_text(spark: SparkSession, path: str) -> str:
    system, jvm_path = _open(spark, path)
    stream = system.open(jvm_path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that appears whole or not at all; FileExistsError if it is there already."""
    system, target = _open(spark, path)
    folder = target.getParent()
    draft = spark._jvm.org.apache.hadoop.fs.Path(folder, f".{target.getName()}-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if system.exists(target) or not system.rename(draft, target):
        system.delete(draft, False)
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    system, jvm_path = _open(spark, path)
    system.delete(jvm_path, True)


def replace_folders(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Each new folder in place of its old one, many at once; may be repeated until the new ones are gone."""
    if not moves:
        return
    system, path = _open(spark, moves[0][0])[0], spark._jvm.org.apache.hadoop.fs.Path
    for parent in {old.rsplit("/", 1)[0] for _, old in moves}:
        system.mkdirs(path(parent))

    def move(pair: tuple[str, str]) -> None:
        new, old = map(path, pair)
        if system.exists(new):
            system.delete(old, True)
            if not system.rename(new, old):
                raise OSError(f"cannot move {pair[0]} to {pair[1]}")

    _at_once(move, moves)


def delete_all(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders under one root, many at once."""
    if paths:
        system, path = _open(spark, paths[0])[0], spark._jvm.org.apache.hadoop.fs.Path
        _at_once(lambda name: system.delete(path(name), True), paths)


def _at_once(action, items: list) -> None:
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for _ in pool.map(action, items):
            pass
