"""File operations that Spark's readers and writers lack: rename, remove, modification times.

They go through the Hadoop file system of the path, so they work on whatever
store the session reads. All are metadata calls on the driver; no data passes it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class Store:
    """The file system that a path lies on."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def remove(self, path: str) -> bool:
        """Remove a file or a folder with all in it; False if there is none."""
        return self._fs.delete(self._path(path), True)

    def rename(self, path: str, to: str) -> None:
        """Rename; the folder that ``to`` lies in is made if need be. An existing ``to`` is an error."""
        if self.exists(to):
            raise FileExistsError(to)
        self._fs.mkdirs(self._path(to).getParent())
        if not self._fs.rename(self._path(path), self._path(to)):
            raise OSError(f"cannot rename {path} to {to}")

    def names(self, folder: str) -> list[str]:
        """Names of what lies in a folder, sorted."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder)))

    def set_modified(self, path: str, millis: int) -> None:
        self._fs.setTimes(self._path(path), millis, -1)


def hidden_sibling(path: str, kind: str) -> str:
    """A path beside ``path`` that Spark's readers of the folder above don't see."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{kind}"


def swap_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``; what was there goes last.

    Two renames on one file system. If the second fails the old folder is put back;
    if the process dies between them, :func:`recover_folder` does so.
    """
    store, old = Store(spark, path), hidden_sibling(path, "old")
    store.remove(old)
    had = store.exists(path)
    if had:
        store.rename(path, old)
    try:
        store.rename(new, path)
    except BaseException:
        if had:
            store.rename(old, path)
        raise
    store.remove(old)


def recover_folder(spark: SparkSession, path: str) -> bool:
    """Put back the folder that an interrupted :func:`swap_folder` had moved away; True if there was one."""
    store, old = Store(spark, path), hidden_sibling(path, "old")
    if store.exists(path) or not store.exists(old):
        return False
    store.rename(old, path)
    return True
