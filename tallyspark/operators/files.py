"""Folders and small files through Hadoop's file systems, so that any store Spark reads will do."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder where none is set and all tasks run on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {spark.sparkContext.master} share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="tallyspark-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


class Files:
    """The file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._fs = self._hadoop.Path(root).getFileSystem(self._conf)

    def path(self, name: str):
        return self._hadoop.Path(name)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        """What a folder holds, by name; nothing if there is none."""
        if not self.exists(folder):
            return []
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self.path(folder)))

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def move(self, name: str, to: str) -> bool:
        """Rename in one step; False if ``to`` is there already."""
        options = self._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf)
        if self.exists(to):
            return False
        try:
            context.rename(self.path(name), self.path(to), options)
        except Exception:
            if self.exists(to):
                return False
            raise
        return True
